"""Find where documentation has drifted from code, with Spark DataFrames."""
