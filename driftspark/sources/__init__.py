"""Reading corpora from files and writing results."""
