"""Patterns and thresholds that decide what counts as a contact.

The first block holds fixed values: results are only right if these are exactly
what they are.  They are written for Python's ``re`` on ``str`` (Unicode-aware), and
the tests use them in that form as the independent expectation.  The second block
derives from them what Java's regex engine needs to give the same answers.
"""

# --- fixed values -----------------------------------------------------------

EMAIL_PATTERN = r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b"

PHONE_PATTERNS = (
    r"\+\d{1,3}\s?[-.\s]?\(?\d{1,4}\)?[-.\s]?\d{1,4}[-.\s]?\d{1,9}",
    r"\(?\d{3}\)?[-.\s]?\d{3}[-.\s]?\d{4}",
    r"\d{3}[-.\s]?\d{3}[-.\s]?\d{4}",
    r"\d{5}[-.\s]?\d{5,7}",
)

REJECTED_EMAIL_ENDINGS = (".png", ".jpg", ".gif", ".example", ".test")
REJECTED_EMAIL_PARTS = ("..", "@.", ".@")

PHONE_DROPPED_CHARS = r"[^\d+]"
MIN_PHONE_LENGTH = 7
MAX_PHONE_LENGTH = 15

# --- derived for Java regex -------------------------------------------------

# Python's \s also covers the four ASCII separators, Java's (?U)\s does not.
SPACE = r"[\s\x1c-\x1f]"
SEPARATOR = r"[-.\s\x1c-\x1f]"


def java_pattern(pattern: str) -> str:
    """The same language as ``pattern`` under Python ``re``, for ``java.util.regex``."""
    return "(?U)" + pattern.replace(r"[-.\s]", SEPARATOR).replace(r"\s?", SPACE + "?")


# The international pattern is tried right after each "+" and reaches no further than
# this; the other three search.
INTERNATIONAL = java_pattern("^" + PHONE_PATTERNS[0].removeprefix(r"\+"))
INTERNATIONAL_REACH = 26
NATIONAL = [java_pattern(pattern) for pattern in PHONE_PATTERNS[1:]]
DROPPED_CHARS = "(?U)" + PHONE_DROPPED_CHARS

# A match of any NATIONAL pattern, less its optional opening bracket (which the
# normalisation deletes anyway), starts with a digit, is at least ten long and uses
# only these characters.  So all of them lie inside these runs and none spans two.
DIGIT_RUN = r"(?U)\d[\d)\-.\s\x1c-\x1f]{9,}+"

LOCAL = "A-Za-z0-9._%+-"
DOMAIN_OR_TLD = "A-Za-z0-9.|-"
CUT_CHAR = r"\x{FFFD}"
# Python's \w.  Java's own \b would count combining marks and joiners as word
# characters and superscript digits as none, and changed meaning in JDK 19.
WORD = r"\p{L}\p{N}_"

_TAIL = (
    r"@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}"
    rf"(?:(?<=[A-Za-z])(?![{WORD}])|(?<=\|)(?=[{WORD}]))"
)
_START = rf"(?:(?<![{WORD}])(?=[A-Za-z0-9_])|(?<=[{WORD}])(?=[.%+-]))"

# EMAIL_PATTERN in linear time; the address is group 1.  Read literally, the pattern
# rescans a run of local-part characters from every word boundary inside it, which is
# quadratic on a percent-encoded megabyte.  Here a run is looked at once, from its
# first character (or from the end of the previous match): only if it leads to "@"
# and a valid domain does the search for the leftmost boundary begin.
EMAIL = (
    rf"(?:(?<![{LOCAL}])|\G)(?=[{LOCAL}]++{_TAIL})"
    rf"[{LOCAL}]*?{_START}([{LOCAL}]++{_TAIL})"
)

# Bytes looked at on each side of an "@" for the end of the run of address characters
# there; where a run is longer, the text is kept whole.
EMAIL_REACH = 64
RUN_AFTER_AT = rf"^[{DOMAIN_OR_TLD}]*+[^{DOMAIN_OR_TLD}]"
REVERSED_RUN_BEFORE_AT = rf"^[{LOCAL}]*+[^{LOCAL}{CUT_CHAR}]"
