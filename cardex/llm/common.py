"""SQL building blocks and stored intermediates that the operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cardex.session import scratch_dir

# ASCII white space as the characters of a class, in Java patterns and SQL strings.
SPACE_CLASS = r"\x20\x09-\x0D"
_SPACES = "' \\t\\n\\u000B\\f\\r'"
# A new key column whose name no input column is likely to have.
KEY = "_row_key"


def raw(pattern: str) -> str:
    """A SQL string literal of a pattern that may hold quotes of either kind."""
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def let(name: str, value: str, body: str) -> str:
    """SQL for ``body`` with ``name`` bound to ``value``, which is computed once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def ascii_lower(text: str) -> str:
    """SQL: A to Z lower-cased, every other character as it is."""
    return (
        f"if(octet_length({text}) = char_length({text}), lower({text}),"
        f" translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'))"
    )


def stripped(text: str) -> str:
    """SQL: ASCII white space removed at both ends."""
    return f"btrim({text}, {_SPACES})"


def words_sql(text: str, pattern: str) -> str:
    """SQL: the matches of ``pattern``; NULL text has none."""
    return f"regexp_extract_all(coalesce({text}, ''), {raw(pattern)}, 0)"


def _running(values: str, start: str) -> str:
    """SQL: what precedes each element of a short array of numbers, and the total last."""
    step = "concat(acc, array(element_at(acc, -1) + v))"
    return f"aggregate({values}, array({start}), (acc, v) -> {step})"


def prefix_sums(values: str, zero: str = "0") -> str:
    """SQL: for each element of an INT array the sum of those before it.

    ``zero`` is 0 in the type of the sums, ``0L`` for those of BIGINT.

    Runs of about the square root of the length are summed one by one and then
    shifted, so that a document with very many matches takes no quadratic time.
    """
    size = "cast(ceil(sqrt(size(vs))) as int)"
    runs = f"transform(sequence(0, cast((size(vs) - 1) div n as int)), b -> slice(vs, b * n + 1, n))"
    sums = f"transform(rs, r -> {_running('r', zero)})"
    totals = "transform(ss, s -> element_at(s, -1))"
    shifted = "flatten(transform(ss, (s, i) -> transform(slice(s, 1, size(s) - 1), x -> x + os[i])))"
    body = let("n", size, let("rs", runs, let("ss", sums, let("os", _running(totals, zero), shifted))))
    return let("vs", values, f"if(size(vs) = 0, vs, {body})")


def cut_many(text: str, ranges: str) -> str:
    """SQL ARRAY<STRING>: what ``text`` holds in each STRUCT<start, end> of an array.

    Starts must not decrease.  To find a place in a text Spark walks to it, so ranges
    are cut in runs: each run's part of the text once, and the ranges from that.
    """
    runs = "transform(sequence(0, cast((size(rgs) - 1) div rn as int)), b -> slice(rgs, b * rn + 1, rn))"
    part = f"substr({text}, r0[0].start + 1, array_max(transform(r0, x -> x.end)) - r0[0].start)"
    cut = "transform(r0, x -> substr(part, x.start - r0[0].start + 1, x.end - x.start))"
    cuts = f"flatten(transform({runs}, r0 -> {let('part', part, cut)}))"
    body = let("rn", "cast(ceil(sqrt(size(rgs))) as int)", cuts)
    return let("rgs", ranges, f"if(size(rgs) = 0, cast(array() as array<string>), {body})")


def counts_up_to(points: str, values: str, inclusive: bool) -> str:
    """SQL ARRAY<INT>: for each point how many values are less, or also equal.

    Both are INT arrays in any order; the time is that of sorting them.
    """
    value, point = (0, 1) if inclusive else (1, 0)
    events = (
        f"sort_array(concat(transform({values}, v -> named_struct('at', v, 'o', {value}, 'i', -1)),"
        f" transform({points}, (p, i) -> named_struct('at', p, 'o', {point}, 'i', i))))"
    )
    counts = let(
        "sums",
        prefix_sums("transform(events, e -> if(e.i < 0, 1, 0))"),
        "transform(sort_array(filter(transform(events, (e, k) -> named_struct('i', e.i, 'n', sums[k])),"
        " x -> x.i >= 0)), x -> x.n)",
    )
    return let("events", events, counts)


def with_clear(frame: DataFrame, name: str, spans: str, others: str) -> DataFrame:
    """``frame`` with the spans of one column that overlap none of another column's.

    Takes columns, not expressions: Spark's analyzer allows a limited depth.
    """
    begun = counts_up_to(f"transform({spans}, x -> x.end)", f"transform({others}, x -> x.start)", False)
    ended = counts_up_to(f"transform({spans}, x -> x.start)", f"transform({others}, x -> x.end)", True)
    # bound by ``let``: Spark would move a column into the lambda, and count for each span
    kept = let("begun", begun, let("ended", ended, f"filter({spans}, (x, j) -> begun[j] = ended[j])"))
    return frame.withColumn(name, F.expr(f"if(size({spans}) = 0 or size({others}) = 0, {spans}, {kept})"))


def matches_sql(text: str, pattern: str, group: int = 0) -> str:
    """SQL: ARRAY<STRUCT<start, end, value>> of the leftmost non-overlapping matches.

    ``start`` and ``end`` count code points, ``end`` is exclusive; ``value`` is the
    group's text.  What lies between two matches comes from ``split``, which walks the
    same matches, so their places follow from lengths alone.
    """
    whole = f"regexp_extract_all({text}, {raw(pattern)}, 0)"
    value = "found" if group == 0 else f"regexp_extract_all({text}, {raw(pattern)}, {group})"
    lengths = "zip_with(slice(pieces, 1, size(found)), found, (p, f) -> length(p) + length(f))"
    spans = (
        "transform(found, (f, i) -> named_struct('start', before[i] + length(pieces[i]),"
        " 'end', before[i] + length(pieces[i]) + length(f), 'value', wanted[i]))"
    )
    none = "cast(array() as array<struct<start: int, end: int, value: string>>)"
    body = let("found", whole, let("wanted", value, let("before", prefix_sums(lengths), spans)))
    return let("pieces", f"split({text}, {raw(pattern)}, -1)", f"if(size(pieces) = 1, {none}, {body})")


def joined_spans(spans: str) -> str:
    """SQL: ``kind:start:end`` of sorted span structs, comma-joined."""
    return f"array_join(transform({spans}, s -> concat_ws(':', s.kind, s.start, s.end)), ',')"


def row_key(id_col: str, text_col: str) -> Column:
    """A key that rows share only if identifier and text agree (160 bits and the id).

    Rows equal in both get equal results, so sharing a key does them no harm.
    """
    return F.struct(
        F.col(id_col).alias("id"),
        F.xxhash64(F.col(text_col)).alias("first"),
        F.xxhash64(F.lit("second"), F.col(text_col)).alias("second"),
        F.octet_length(F.col(text_col)).alias("size"),
    )


def null_safe(left: DataFrame, right: DataFrame, keys: list[str]) -> list[Column]:
    return [left[k].eqNullSafe(right[k]) for k in keys]


def store(spark: SparkSession, frame: DataFrame, name: str, **measures: str) -> DataFrame:
    """The frame written to the shared folder and read back: cuts the lineage.

    ``measures`` are SQL aggregates over its rows; they are taken while it is written, so
    they cost no job of their own, and are found by name in the result's ``measures``.
    """
    path = scratch_dir(spark, name)
    seen = Observation()
    if measures:
        frame = frame.observe(seen, *(F.expr(sql).alias(key) for key, sql in measures.items()))
    frame.write.parquet(path)
    stored = spark.read.schema(frame.schema).parquet(path)
    stored.stored_path = path
    stored.measures = seen.get if measures else {}
    return stored


def discard(*frames: DataFrame) -> None:
    """Delete what ``store`` wrote for frames that nothing reads any more."""
    for frame in frames:
        spark = frame.sparkSession
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(frame.stored_path)
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
