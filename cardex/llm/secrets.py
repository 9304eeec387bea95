"""Operator 1: secrets by pattern and by two character Markov models.

One model is trained on labelled random strings, the other on labelled ordinary
identifiers; a token's score is the mean log-likelihood ratio of its character
transitions.  The labelled samples are bounded: random strings are what the base rules
find plus generated digests, ordinary ones are words of a sample of documents and
identifiers put together from them.  The threshold depends on a token's length and on
whether it holds a digit, as short tokens and mere letters tell less.  Finding, scoring
and training counts are SQL expressions; scoring is one pass over the text without a
shuffle.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardex.llm.common import joined_spans, let, matches_sql, raw, with_clear

ASSIGN = (
    r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]{16,}+"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}+"
MIN_ASSIGNED = 6
KINDS = ("assign", "access", "hex", "markov")

# Tokens the models judge: runs of such characters, so names and values, and the parts
# of a path, are tokens of their own.
MIN_TOKEN = 16
TOKEN = rf"(?<![A-Za-z0-9+_-])[A-Za-z0-9+_-]{{{MIN_TOKEN},}}+"
# Classes of tokens with a threshold of their own: from these lengths on, each with and
# without a digit.
LENGTHS = (16, 20, 28, 40)

ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
# Labelled rows a model is fitted on: documents whose words are taken and words of each,
# documents searched for secrets by the base rules and secrets of them, generated random
# strings of each kind.
SAMPLE_DOCUMENTS = 2000
WORDS_PER_DOCUMENT = 60
SECRET_DOCUMENTS = 20_000
# Words from this length on may be secrets that no base rule names.
LONGEST_WORD = 16
SAMPLE_SECRETS = 5000
GENERATED = 2000
# Share of held-out ordinary identifiers of a class that may score above its threshold,
# and the least threshold.
FALSE_ALARMS = 0.001
LEAST_THRESHOLD = 0.5


def _base_spans(text: str) -> dict[str, str]:
    value = matches_sql(text, ASSIGN, 2)
    return {
        "assign": f"filter({value}, s -> length(s.value) >= {MIN_ASSIGNED})",
        "access": matches_sql(text, ACCESS),
        "hex": matches_sql(text, HEX),
    }


def _tagged(kind: str, spans: str) -> str:
    return (
        f"transform({spans}, s -> named_struct('start', s.start, 'rank', {KINDS.index(kind)},"
        f" 'end', s.end, 'kind', '{kind}', 'value', s.value))"
    )


def _all_base(text: str) -> str:
    spans = ", ".join(_tagged(kind, found) for kind, found in _base_spans(text).items())
    return f"array_sort(concat({spans}))"


def _code(char: str) -> str:
    """SQL: a character's place in the alphabet, 0 if it is none of it."""
    return f"instr('{ALPHABET}', {char})"


def transitions_sql(token: str) -> str:
    """SQL ARRAY<INT>: the cells of the model's table that a token's transitions hit."""
    size = len(ALPHABET) + 1
    codes = f"transform(split({token}, ''), c -> {_code('c')})"
    pairs = f"transform(slice(cs, 2, size(cs)), (c, i) -> cs[i] * {size} + c)"
    return let("cs", codes, pairs)


def _chosen(documents: DataFrame, most: int, rows: int) -> DataFrame:
    """About ``most`` of the documents by the hash ``_order`` of id and text."""
    return documents.where(F.pmod("_order", F.lit(max(1, rows // most))) == 0)


def labelled_samples(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``token, label``: at most a fixed number of labelled random and ordinary strings.

    Documents are chosen by a hash of id and text, words by a hash from all over them,
    so the sample is the same in every run, and copies of one text are as likely as any
    other row.  Other columns are ignored.
    """
    spark = documents.sparkSession
    rows = documents.count()
    texts = documents.select(
        F.xxhash64(F.col(id_col), F.xxhash64(text_col)).alias("_order"), F.col(text_col).alias("_text")
    )
    found_words = f"array_distinct(regexp_extract_all(_text, {raw('[A-Za-z0-9]{5,}')}, 0))"
    hashed = f"transform({found_words}, w -> named_struct('h', xxhash64(w, _order), 'w', w))"
    words = (
        _chosen(texts, SAMPLE_DOCUMENTS, rows)
        .select("_order", F.expr(f"transform(slice(sort_array({hashed}), 1, {WORDS_PER_DOCUMENT}), x -> x.w) as ws"))
        .orderBy("_order")
        .limit(SAMPLE_DOCUMENTS)
    )
    styles = (
        "array(w, concat_ws('_', w, n, m), concat_ws('-', w, n, m), concat(lower(w), initcap(n), initcap(m)),"
        " concat_ws('_', upper(w), upper(n), i), concat_ws('_', w, n), concat(lower(w), initcap(n)),"
        " lower(concat(w, n)), upper(concat_ws('_', w, n)), concat_ws('-', lower(w), lower(n), i))"
    )
    names = let(
        "l",
        f"filter(ws, w -> length(w) < {LONGEST_WORD})",
        f"flatten(transform(slice(l, 1, greatest(size(l) - 2, 0)), (w, i) ->"
        f" {let('n', 'l[i + 1]', let('m', 'l[i + 2]', styles))}))",
    )
    ordinary = words.select(F.expr(f"explode_outer({names}) as token"), F.lit(0).alias("label"))
    found = (
        _chosen(texts, SECRET_DOCUMENTS, rows)
        .select(F.expr(f"explode_outer({_all_base(f'coalesce(_text, {raw(str())})')}) as s"))
        .where("s is not null")
        .select(F.expr("regexp_replace(s.value, '[^A-Za-z0-9+/_=-]', '') as token"))
        .groupBy("token")
        .count()
        .select("token", F.xxhash64("token").alias("_order"))
        .orderBy("_order", "token")
        .limit(SAMPLE_SECRETS)
        .select("token", F.lit(1).alias("label"))
    )
    digest = F.sha2(F.col("id").cast("string"), 512)
    bits = F.base64(F.unhex(digest))
    # digests of digests, for long runs of letters only
    more = F.base64(F.unhex(F.concat(digest, F.sha2(digest, 512), F.sha2(F.concat(digest, digest), 512))))
    length = (F.col("id") % 25 + MIN_TOKEN).cast("int")
    letters = F.regexp_replace(more, "[^A-Za-z]", "")
    generated = spark.range(GENERATED).select(
        F.explode(
            F.array(
                F.substring(bits, 1, 40),
                F.substring(digest, 1, 40),
                F.substring(F.regexp_replace(bits, "[+/=]", ""), F.lit(1), length),
                F.upper(F.substring(F.regexp_replace(bits, "[+/=a-z]", ""), 1, 24)),
                F.substring(letters, F.lit(1), length),
                F.substring(F.regexp_replace(letters, "[A-Z]", ""), F.lit(1), length),
            )
        ).alias("token"),
        F.lit(1).alias("label"),
    )
    return ordinary.unionAll(found).unionAll(generated).where(F.length("token") >= 2)


def _log_ratios(counts: list) -> list[float]:
    """The table of log(random / ordinary) transition probabilities, add-one smoothed."""
    size = len(ALPHABET) + 1
    seen = {(row.label, row.cell): row["count"] for row in counts}
    totals = {}
    for (label, cell), n in seen.items():
        totals[label, cell // size] = totals.get((label, cell // size), 0) + n
    table = []
    for cell in range(size * size):
        logs = [
            math.log((seen.get((y, cell), 0) + 1) / (totals.get((y, cell // size), 0) + size))
            for y in (1, 0)
        ]
        table.append(round(logs[0] - logs[1], 2))
    return table


def score_sql(token: str, table: list[float]) -> str:
    """SQL DOUBLE: the mean log-likelihood ratio of a token's transitions."""
    # a folded literal, so that a lookup is an index into an array
    ratios = f"cast(split('{','.join(f'{x:g}' for x in table)}', ',') as array<double>)"
    total = f"aggregate(ts, 0D, (acc, t) -> acc + {ratios}[t])"
    return let("ts", transitions_sql(token), f"if(size(ts) = 0, 0D, {total} / size(ts))")


def class_sql(token: str) -> str:
    """SQL INT: the class of a token's threshold, -1 if it is too short to be judged."""
    length = "".join(f" when length({token}) >= {n} then {k}" for k, n in reversed(list(enumerate(LENGTHS))))
    return f"(case{length} else -1 end * 2 + if(length({token}) >= {MIN_TOKEN} and {token} rlike '[0-9]', 1, 0))"


class MarkovModel:
    """Log ratios of all transitions and each class's threshold on their mean."""

    def __init__(self, table: list[float], thresholds: list[float]):
        self.table = table
        self.thresholds = thresholds

    def is_random(self, token: str) -> str:
        limits = ", ".join(f"{x}D" for x in self.thresholds)
        return f"({score_sql(token, self.table)} >= array({limits})[{class_sql(token)}])"


def fit(samples: DataFrame) -> MarkovModel:
    """Train on four fifths of the samples, set the thresholds on the held-out fifth.

    What reaches the driver is one count per label and transition (the alphabet bounds
    them) and a quantile of each class.  A class without ordinary tokens takes the
    strictest threshold of the others.
    """
    held_out = F.pmod(F.xxhash64("token"), F.lit(5)) == 0
    counts = (
        samples.where(~held_out)
        .select("label", F.expr(f"explode_outer({transitions_sql('token')}) as cell"))
        .groupBy("label", "cell")
        .count()
        .where("cell is not null")
        .collect()
    )
    table = _log_ratios(counts)
    scored = samples.where(held_out & (F.length("token") >= MIN_TOKEN) & (F.col("label") == 0)).select(
        F.expr(f"{class_sql('token')} as class"), F.expr(f"{score_sql('token', table)} as score")
    )
    quantiles = scored.groupBy("class").agg(F.percentile_approx("score", 1 - FALSE_ALARMS, 10000).alias("limit"))
    limits = {r["class"]: max(LEAST_THRESHOLD, round(r["limit"], 4)) for r in quantiles.collect()}
    strictest = max(limits.values(), default=LEAST_THRESHOLD)
    return MarkovModel(table, [limits.get(k, strictest) for k in range(2 * len(LENGTHS))])


def secret_spans(
    documents: DataFrame,
    model: MarkovModel,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``id_col, base, spans``: secrets of every document.

    Both are sorted ARRAY<STRUCT<start, rank, end, kind, value>> in code points with an
    exclusive end; ``spans`` adds the tokens that the models take for random and that
    overlap no base span.  NULL text is searched as '' and has empty lists; repeated
    rows and NULL ids stay rows of their own; other columns are ignored.
    """
    tokens = matches_sql("_t", TOKEN)
    random = _tagged("markov", f"filter(_clear, s -> {model.is_random('s.value')})")
    found = documents.select(F.col(id_col).alias("_id"), F.expr(f"coalesce({text_col}, '') as _t")).select(
        "_id", F.expr(f"{_all_base('_t')} as _base"), F.expr(f"{tokens} as _tokens")
    )
    return with_clear(found, "_clear", "_tokens", "_base").select(
        F.col("_id").alias(id_col),
        F.col("_base").alias("base"),
        F.expr(f"array_sort(concat(_base, {random})) as spans"),
    )


def count_of(kind: str) -> Column:
    return F.expr(f"cast(size(filter(base, s -> s.kind = '{kind}')) as bigint) as n_{kind}")


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's digest of ``secret_spans`` over ``documents``."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = secret_spans(documents, fit(labelled_samples(documents)))
    return found.select(
        "doc_id",
        *(count_of(kind) for kind in KINDS[:3]),
        F.expr(f"sha2({joined_spans('base')}, 256) as base_sha256"),
        F.expr(f"{joined_spans('spans')} as spans"),
    )
