"""Character classes spelled out, so that they cover all of Unicode.

Java's short classes are ASCII only, and its Unicode mode counts combining marks
as word characters; a word character here is a letter, a digit or ``_``.
"""

WORD = r"[\p{L}\p{N}_]"
SPACE = r"[\t-\r\x1C-\x1F\x85\p{Z}]"
NOT_SPACE = r"[^\t-\r\x1C-\x1F\x85\p{Z}]"
PUNCTUATION = r"[^\p{L}\p{N}_\t-\r\x1C-\x1F\x85\p{Z}]"
EDGE_SPACE = rf"^{SPACE}+|{SPACE}+$"
URL = rf"http{NOT_SPACE}+"
URL_OR_WWW = rf"http{NOT_SPACE}+|www\.{NOT_SPACE}+"
MENTION = rf"@{WORD}+"
RUN = r"(?d)(.)\1{2,}"
TERM = rf"{WORD}{{2,}}"
ONLY_MARKS = r"^(?!<URL>|<USER>)[^\p{L}\p{N}]+$"
