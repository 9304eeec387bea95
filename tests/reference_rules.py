"""The extraction rules in plain Python, the independent expectation of the tests."""

import re

from cardex.functions import patterns as P


def emails(text):
    found = re.findall(P.EMAIL_PATTERN, text)
    return sorted(
        {
            e.lower()
            for e in found
            if not e.lower().endswith(P.REJECTED_EMAIL_ENDINGS)
            and not any(part in e for part in P.REJECTED_EMAIL_PARTS)
        }
    )


def phones(text):
    found = [m for p in P.PHONE_PATTERNS for m in re.findall(p, text)]
    numbers = {re.sub(P.PHONE_DROPPED_CHARS, "", m) for m in found}
    return sorted(n for n in numbers if 7 <= len(n) <= 15)
