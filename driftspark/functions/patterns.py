"""Regular expressions shared by the operators.

The rules being matched are defined for a dialect whose ``\\w``/``\\b`` are
ASCII and whose ``\\s`` covers Unicode spaces. Java differs on both, so word
borders are written as ASCII lookarounds and whitespace as an explicit class.
"""

WORD = r"A-Za-z0-9_"
WORD_START = rf"(?<![{WORD}])"
WORD_END = rf"(?![{WORD}])"

# Every code point the matching rules treat as whitespace.
SPACE_CHARS = r"\s\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{feff}"
SPACE = rf"[{SPACE_CHARS}]"

# A search token: a maximal run of word characters, or one "$" / non-ASCII
# character (the other characters that an identifier may contain).
TOKEN = rf"[{WORD}]+|[$\x{{80}}-\x{{10ffff}}]"

# A fenced block: opener line, body, and a closing line of exactly three
# backticks. An opener without such a closer matches nothing.
# The line-start check follows the backticks, and the body goes line by line:
# ordinary text is passed over fast.
FENCED_BLOCK = (
    r"```(?<=^```|\n```)[^\n]*+\n(?:(?!```(?:\n|\z))[^\n]*+\n)*+```(?=\n|\z)"
)
RAW_FENCE = r"```[^`]*+(?:`(?!``)[^`]*+)*+```"
HEADER = rf"(?m)^#{{1,6}}{SPACE}+.+$"
LIST_ITEM = rf"(?m)^{SPACE}*[-*+]{SPACE}+"
