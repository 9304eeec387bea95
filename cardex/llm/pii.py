"""Operator 6: personal data found by patterns, confirmed by checksums and context.

Patterns propose spans.  Validators (part ranges, digit counts, Luhn, mod-97) drop
those that cannot be what they look like.  Kinds without a checksum of their own get a
score from their form, and words standing nearby raise or lower it; spans below
``MIN_SCORE`` are dropped.  All of it is SQL expressions over one row: no shuffle, no
Python, and a document is never cut.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardex.llm.common import counts_up_to, cut_many, joined_spans, let, matches_sql, raw, with_clear

# The patterns of the base kinds, written so that Java's matcher neither recurses nor
# starts anew within a run it has just seen fail; they match the same spans.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?+[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
# The kinds that the method adds.
# How an account number begins; where it ends follows from its country or its checksum.
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?=(?:\x20?[A-Z0-9]){11})"
IBAN_RUN = r"^[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}"
# Letters and digits of an account number by country; those of another country may have
# any number.
IBAN_LENGTHS = {
    15: "NO",
    16: "BE",
    18: "DK FI FK FO GL NL SD",
    19: "MK SI",
    20: "AT BA EE KZ LT LU MN XK",
    21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA",
    23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST",
    26: "IS TR",
    27: "BI DJ FR GR IT MC MR SM",
    28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
    29: "BR EG PS QA UA",
    30: "JO KW MU YE",
    31: "MT SC",
    32: "LC",
    33: "RU",
}
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
NATIONAL_PHONE = r"(?<![0-9+(.-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}(?![0-9.-]*[0-9])"

BASE = ("email", "ip", "card", "phone")
ADDED = ("iban", "ssn", "national_phone")
KINDS = (*BASE, *ADDED)

# Score of a span by its form alone, and of context for or against.
FORM_SCORE = {"ssn": 0.4, "national_phone": 0.5}
CONTEXT_SCORE = 0.3
MIN_SCORE = 0.7
# Code points before and after a span in which context words count.
REACH = 40
FOR = {
    "ssn": r"(?i)\b(ssn|social security|tax id|taxpayer)\b",
    "national_phone": r"(?i)\b(phone|tel|telephone|call|mobile|cell|fax|telefon|telefono|teléfono)\b",
}
AGAINST = r"(?i)\b(example|sample|order|invoice|part|serial|isbn|version)\b"


def _digits(value: str) -> str:
    return f"regexp_replace({value}, '[^0-9]', '')"


def luhn_sql(digits: str) -> str:
    """SQL BOOLEAN: whether a string of digits passes the Luhn check."""
    doubled = "if(i % 2 = 0, d, d * 2 - if(d > 4, 9, 0))"
    total = (
        f"aggregate(transform(split(reverse({digits}), ''), (c, i) ->"
        f" {let('d', 'cast(c as int)', doubled)}), 0, (acc, d) -> acc + d)"
    )
    return f"{total} % 10 = 0"


def mod97_sql(value: str) -> str:
    """SQL BOOLEAN: whether an account number's remainder by 97 is 1."""
    moved = let("v", f"replace({value}, ' ', '')", "concat(substr(v, 5), substr(v, 1, 4))")
    step = (
        "if(c between '0' and '9', (acc * 10 + cast(c as int)) % 97,"
        " (acc * 100 + ascii(c) - 55) % 97)"
    )
    return f"aggregate(split({moved}, ''), 0, (acc, c) -> {step}) = 1"


def _ip_valid(value: str) -> str:
    part = "regexp_replace(p, '^0+', '')"
    small = let("q", part, "length(q) <= 3 and (q = '' or cast(q as int) <= 255)")
    return f"forall(split({value}, '[.]'), p -> {small})"


def _kept(spans: str, condition: str) -> str:
    return f"filter({spans}, s -> {condition})"


def _scored(kind: str, spans: str, text: str) -> str:
    """SQL: the spans that form and the words within ``REACH`` of them speak for."""
    before = cut_many(text, f"transform(fs, s -> named_struct('start', greatest(s.start - {REACH}, 0), 'end', s.start))")
    after = cut_many(text, f"transform(fs, s -> named_struct('start', s.end, 'end', s.end + {REACH}))")
    words = f"if(n rlike r'{FOR[kind]}', {CONTEXT_SCORE}D, 0D) - if(n rlike r'{AGAINST}', {CONTEXT_SCORE}D, 0D)"
    enough = let("n", "concat(before[j], ' ', after[j])", f"{FORM_SCORE[kind]}D + {words} >= {MIN_SCORE}D - 1e-9D")
    return let("fs", spans, let("before", before, let("after", after, f"filter(fs, (s, j) -> {enough})")))


def _ibans(text: str) -> str:
    """SQL: spans of account numbers whose remainder is right.

    From every beginning all ends before which a group ends are tried, of a listed
    country only the one at its length; the longest that passes counts.
    """
    lengths = ", ".join(f"'{c}', {n}" for n, codes in IBAN_LENGTHS.items() for c in codes.split())
    compact = "replace(substr(v, 1, e), ' ', '')"
    ends = (
        f"filter(sequence(15, length(regexp_extract(v, {raw(IBAN_RUN)}, 0))), e -> substr(v, e, 1) <> ' '"
        " and not substr(v, e + 1, 1) rlike '[A-Za-z0-9]'"
        f" and length({compact}) between 15 and 34"
        f" and length({compact}) = coalesce(map({lengths})[substr(v, 1, 2)], length({compact}))"
        f" and {mod97_sql(compact)})"
    )
    # 34 letters and digits with a space before each but the first, and what follows
    texts = cut_many(text, "transform(fs, s -> named_struct('start', s.start, 'end', s.start + 68))")
    span = let(
        "v",
        "texts[j]",
        let(
            "m",
            f"array_max({ends})",
            "if(m is null, null, named_struct('start', s.start, 'end', s.start + m, 'value', substr(v, 1, m)))",
        ),
    )
    found = let("texts", texts, f"filter(transform(fs, (s, j) -> {span}), s -> s is not null)")
    return let("fs", matches_sql(text, IBAN), found)


def _validated(kind: str, text: str) -> str:
    """SQL: the spans of one kind that pass its checks."""
    if kind == "iban":
        return _ibans(text)
    pattern = {
        "email": EMAIL,
        "ip": IP,
        "card": CARD,
        "phone": PHONE,
        "ssn": SSN,
        "national_phone": NATIONAL_PHONE,
    }[kind]
    found = matches_sql(text, pattern)
    if kind == "email":
        return found
    if kind == "ip":
        return _kept(found, _ip_valid("s.value"))
    if kind == "card":
        check = let("d", _digits("s.value"), f"if(length(d) between 14 and 19, {luhn_sql('d')}, false)")
        return _kept(found, check)
    if kind == "phone":
        return _kept(found, f"length({_digits('s.value')}) between 10 and 15")
    return _scored(kind, found, text)


def _tagged(kind: str, spans: str) -> str:
    order = KINDS.index(kind)
    return (
        f"transform({spans}, s -> named_struct('start', s.start, 'rank', {order},"
        f" 'end', s.end, 'kind', '{kind}', 'value', s.value))"
    )


def pii_spans(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, text_col, base, spans``: what was found in every document.

    Both are sorted ARRAY<STRUCT<start, rank, end, kind, value>>, in code points with an
    exclusive end; ``spans`` also holds the added kinds, where they do not overlap a
    base span.  NULL text is searched as '' and keeps an empty list, as does a text
    without personal data; repeated rows and NULL ids stay rows of their own; other
    columns are ignored.
    """
    base = ", ".join(_tagged(k, _validated(k, "_t")) for k in BASE)
    added = ", ".join(_tagged(k, _validated(k, "_t")) for k in ADDED)
    found = documents.select(
        F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), F.expr(f"coalesce({text_col}, '') as _t")
    ).select("_id", "_text", F.expr(f"array_sort(concat({base})) as _base"), F.expr(f"concat({added}) as _added"))
    return with_clear(found, "_clear", "_added", "_base").select(
        F.col("_id").alias(id_col),
        F.col("_text").alias(text_col),
        F.col("_base").alias("base"),
        F.expr("array_sort(concat(_base, _clear)) as spans"),
    )


def masked(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, text_col`` with every span replaced by its kind in angle brackets.

    Spans that overlap are masked as one, under the kind of the first.  A text without
    spans, or NULL, stays as it is.
    """
    # a span begins a region if all that began before it have ended
    ended = counts_up_to("transform(spans, s -> s.start)", "transform(spans, s -> s.end)", True)
    firsts = let("ended", ended, "filter(sequence(0, size(spans) - 1), k -> ended[k] = k)")
    regions = (
        "transform(firsts, (k, j) -> named_struct('kind', spans[k].kind, 'start', spans[k].start, 'end',"
        " array_max(transform(slice(spans, k + 1, coalesce(get(firsts, j + 1), size(spans)) - k), s -> s.end))))"
    )
    gaps = (
        "transform(concat(regions, array(named_struct('kind', '', 'start', length(_m), 'end', 0))),"
        " (r, j) -> named_struct('start', if(j = 0, 0, regions[j - 1].end), 'end', r.start))"
    )
    parts = "transform(kept, (g, j) -> if(j < size(regions), array(g, concat('<', regions[j].kind, '>')), array(g)))"
    none = "size(spans) = 0"
    found = pii_spans(documents, id_col, text_col).select(F.col(id_col).alias("_id"), F.col(text_col).alias("_m"), "spans")
    return (
        found.select("*", F.expr(f"if({none}, null, {firsts}) AS firsts"))
        .select("*", F.expr(f"{regions} AS regions"))
        .select("*", F.expr(f"if({none}, null, {cut_many('_m', gaps)}) AS kept"))
        .select(
            F.col("_id").alias(id_col),
            F.expr(f"if({none}, _m, array_join(flatten({parts}), ''))").alias(text_col),
        )
    )


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's digest of ``pii_spans`` over ``documents``."""
    found = pii_spans(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    counts = [
        F.expr(f"cast(size(filter(base, s -> s.kind = '{k}')) as bigint) as n_{k}") for k in BASE
    ]
    return found.select(
        "doc_id",
        *counts,
        F.expr(f"sha2({joined_spans('base')}, 256) as base_sha256"),
        F.expr(f"{joined_spans('spans')} as spans"),
    )
