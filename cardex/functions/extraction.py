"""Contact extraction as Catalyst expressions (no Python worker).

Each function takes a column name (or any SQL expression of type string) and returns a
Column.  The SQL text behind it is the single definition; ``functions.sql`` registers
the same text as SQL functions.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

from cardex.functions import patterns as P


def _raw(pattern: str) -> str:
    """A SQL raw string literal; patterns contain no quote."""
    return f"r'{pattern}'"


PLUS = r"\+"
_NONE = "cast(array() as array<string>)"


def _around_at_signs(pieces: str) -> str:
    """Text cut down to the characters around each "@" that can decide a match.

    ``pieces`` is the text split at "@".  A match and its boundaries reach over the
    unbroken runs of address characters on both sides of an "@" and one character
    beyond.  Of a piece between two "@" only these are kept, or all of it if a run is
    too long or its end is not certain (the last bytes may start within a character).
    """
    n = P.EMAIL_REACH
    last = f"cast(substring(cast(piece as binary), -{n}, {n}) as string)"
    before = f"regexp_extract(reverse({last}), {_raw(P.REVERSED_RUN_BEFORE_AT)}, 0)"
    after = f"regexp_extract(left(piece, {n}), {_raw(P.RUN_AFTER_AT)}, 0)"
    kept = f"named_struct('after', {after}, 'before', reverse({before}))"
    return (
        f"array_join(transform({pieces}, piece -> if(octet_length(piece) <= {2 * n}, piece,"
        f" transform(array({kept}), kept -> if(kept.after = '' or kept.before = '',"
        f" piece, concat(kept.after, kept.before)))[0])), '@')"
    )


def emails_sql(text: str) -> str:
    """SQL expression: sorted distinct lower-case e-mail addresses in ``text``."""
    rejects = [f"endswith(lower(e), '{x}')" for x in P.REJECTED_EMAIL_ENDINGS]
    rejects += [f"contains(e, '{x}')" for x in P.REJECTED_EMAIL_PARTS]
    found = f"regexp_extract_all({_around_at_signs('pieces')}, {_raw(P.EMAIL)}, 1)"
    return (
        f"transform(array(split(coalesce({text}, ''), '@')), pieces ->"
        f" if(size(pieces) = 1, {_NONE}, sort_array(array_distinct(transform("
        f"filter({found}, e -> not ({' or '.join(rejects)})), e -> lower(e))))))[0]"
    )


def phones_sql(text: str) -> str:
    """SQL expression: sorted distinct normalised phone numbers in ``text``."""
    text = f"coalesce({text}, '')"
    international = (
        f"transform(filter(transform(slice(split({text}, {_raw(PLUS)}), 2, {2**30}),"
        f" rest -> regexp_extract(left(rest, {P.INTERNATIONAL_REACH}),"
        f" {_raw(P.INTERNATIONAL)}, 0)), m -> m != ''), m -> concat('+', m))"
    )
    runs = f"array_join(regexp_extract_all({text}, {_raw(P.DIGIT_RUN)}, 0), '|')"
    scans = ", ".join(f"regexp_extract_all(runs, {_raw(p)}, 0)" for p in P.NATIONAL)
    national = f"transform(array({runs}), runs -> concat({scans}))[0]"
    return (
        f"sort_array(array_distinct(filter("
        f"transform(concat({international}, {national}),"
        f" m -> regexp_replace(m, {_raw(P.DROPPED_CHARS)}, '')),"
        f" p -> length(p) between {P.MIN_PHONE_LENGTH} and {P.MAX_PHONE_LENGTH})))"
    )


def email_domain_sql(email: str) -> str:
    """SQL expression: what stands between the first and second "@", else NULL."""
    return f"get(split({email}, '@'), 1)"


def extract_emails(text: str = "content") -> Column:
    """Operators T1, T1a-T1d.  NULL and empty text give an empty array."""
    return F.expr(emails_sql(text))


def extract_phones(text: str = "content") -> Column:
    """Operators T2, T2a-T2c.  NULL and empty text give an empty array."""
    return F.expr(phones_sql(text))


def email_domain(email: str = "email") -> Column:
    """Operator T8."""
    return F.expr(email_domain_sql(email))
