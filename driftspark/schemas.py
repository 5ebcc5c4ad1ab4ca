"""Schemas of the tables that the operators exchange."""

PARAMETER = "struct<name:string,type:string,optional:boolean,default_value:string>"
LOCATION = "struct<start_line:int,end_line:int,start_column:int,end_column:int>"
CHANGE_DETAIL = "struct<type:string,description:string>"

FILES = "repo string, path string, content string"
FILE_CHANGES = (
    "repo string, path string, change_type string, language string, "
    "content string, previous_content string"
)
API_ELEMENTS = (
    "repo string, path string, ordinal int, kind string, name string, signature string, "
    "is_public boolean, documentation string, return_type string, "
    f"parameters array<{PARAMETER}>, location {LOCATION}"
)
ANSWERS = "repo string, path string, attempt int, response string, error string"
UPDATES = (
    "repo string, path string, seq int, original_content string, updated_content string, "
    "reasoning string"
)
DECISIONS = (
    "repo string, path string, seq int, action string, edited_content string, "
    "feedback string, stop boolean"
)

# Severity names in rising order.
SEVERITIES = ("patch", "minor", "major", "breaking")

# The columns of one API row below its key, in table order.
API_FIELDS = (
    "ordinal",
    "kind",
    "name",
    "signature",
    "is_public",
    "documentation",
    "return_type",
    "parameters",
    "location",
)
DECISION_LOG = (
    "ts timestamp, repo string, path string, action string, reasoning string, feedback string, had_edited_content boolean"
)
