"""Operator 11: fill-in-middle transformation, cuts found by a learned rank index.

A text is cut between two of its token boundaries, chosen by a hash of the document's
id.  Where the boundary of a given rank lies is answered by an index that is fitted to
all boundary offsets of the text: line segments over the ranks, each within a fixed
error of every offset that it covers, and one byte for each boundary that holds what
the line misses.  A cut is predicted from its segment and made exact by its byte.

Boundaries come from whole slices of texts by array operations; the index of a long
text takes a byte for a boundary instead of eight, and its segments are few.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from cardex.llm import arrays

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 1
# Documents in a hundred that are cut, and of those the ones with the suffix first.
CUT_PERCENT = 90
SPM_PERCENT = 20
# Farthest a boundary may lie from its segment's line, so that a byte holds the rest.
ERROR = 120
# Boundaries that a segment is first tried on, and that are fitted at a time.
TRIED = 1024
FITTED = 1 << 19


class RankIndex(NamedTuple):
    """Segments by first rank: where they begin, their slopes; residuals by rank."""

    ranks: np.ndarray
    starts: np.ndarray
    slopes: np.ndarray
    residuals: np.ndarray


def _cones(offsets: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest slope of a line through each run's first offset within ERROR."""
    sizes = np.diff(np.append(firsts, len(offsets)))
    ran = np.arange(len(offsets)) - np.repeat(firsts, sizes)
    rise = (offsets - np.repeat(offsets[firsts], sizes)).astype(np.float64)
    ran_or_one = np.maximum(ran, 1)
    low = np.where(ran > 0, (rise - ERROR) / ran_or_one, -np.inf)
    high = np.where(ran > 0, (rise + ERROR) / ran_or_one, np.inf)
    return np.maximum.reduceat(low, firsts), np.minimum.reduceat(high, firsts)


def _grown(offsets: np.ndarray) -> list[tuple[int, float, float]]:
    """Segments of one run, each as long as its cone of slopes stays open."""
    found, first, tried = [], 0, TRIED
    while first < len(offsets):
        end = min(len(offsets), first + tried)
        ran = np.arange(1, end - first)
        rise = (offsets[first + 1 : end] - offsets[first]).astype(np.float64)
        low = np.maximum.accumulate((rise - ERROR) / ran)
        high = np.minimum.accumulate((rise + ERROR) / ran)
        shut = np.flatnonzero(low > high)
        if len(shut) == 0 and end < len(offsets):
            tried *= 4
            continue
        last = int(shut[0]) if len(shut) else len(ran)
        found.append((first, low[last - 1], high[last - 1]) if last else (first, 0.0, 0.0))
        first, tried = first + last + 1, TRIED
    return found


def fit(offsets: np.ndarray, firsts: np.ndarray) -> RankIndex:
    """Index of runs of growing offsets; ``firsts`` says where each run begins.

    No segment crosses into another run.  Very long runs are fitted in pieces, so that
    only offsets and residuals take space for every boundary at once.
    """
    cuts = np.arange(0, len(offsets), FITTED)
    firsts = np.union1d(firsts, cuts)
    ends = np.append(firsts[np.searchsorted(firsts, cuts[1:])], len(offsets))
    indexes = [
        _fitted(offsets[a:b], firsts[np.searchsorted(firsts, a) : np.searchsorted(firsts, b)] - a, a)
        for a, b in zip(cuts, ends)
    ]
    return RankIndex(*(np.concatenate(column) for column in zip(*indexes)))


def _fitted(offsets: np.ndarray, firsts: np.ndarray, at: int) -> RankIndex:
    """The index of runs whose first rank is ``at``.

    Runs that one line fits, most of them, are settled together; the others grow
    segments one by one.
    """
    low, high = _cones(offsets, firsts)
    ends = np.append(firsts[1:], len(offsets))
    pieces = []
    for run in np.flatnonzero(low > high):
        pieces += [(firsts[run] + f, a, b) for f, a, b in _grown(offsets[firsts[run] : ends[run]])]
    fitting = low <= high
    more = np.array(pieces, np.float64).reshape(-1, 3)
    ranks = np.concatenate([firsts[fitting], more[:, 0].astype(np.int64)])
    low, high = np.concatenate([low[fitting], more[:, 1]]), np.concatenate([high[fitting], more[:, 2]])
    slopes = np.zeros(len(ranks))
    np.add(low / 2, high / 2, out=slopes, where=np.isfinite(low) & np.isfinite(high))
    order = np.argsort(ranks)
    index = RankIndex(ranks[order], offsets[ranks[order]], slopes[order], np.zeros(0, np.int8))
    missed = offsets - predicted(index, np.arange(len(offsets)))
    if np.abs(missed).max(initial=0) > 127:
        raise ArithmeticError("a segment misses an offset by more than its bound")
    return index._replace(ranks=index.ranks + at, residuals=missed.astype(np.int8))


def predicted(index: RankIndex, ranks: np.ndarray) -> np.ndarray:
    """What the segments alone say of the offsets of ranks."""
    own = np.searchsorted(index.ranks, ranks, side="right") - 1
    return index.starts[own] + np.rint(index.slopes[own] * (ranks - index.ranks[own])).astype(np.int64)


def located(index: RankIndex, ranks: np.ndarray) -> np.ndarray:
    """Exact offsets of ranks: the prediction and the stored residual."""
    return predicted(index, ranks) + index.residuals[ranks]


def boundaries(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets of all token boundaries, and where each text's begin.

    A token is a run of ASCII letters or any other single code point.  A text of ``n``
    tokens has ``n + 1`` boundaries, its two ends among them.
    """
    data, places = arrays.text_bytes(texts)
    lower = data | 32
    letter = (lower >= 97) & (lower <= 122)
    begins = (data & 0xC0) != 0x80
    begins[1:] &= ~(letter[1:] & letter[:-1])
    held = np.flatnonzero(np.diff(places))
    begins[places[held]] = True
    starts = np.flatnonzero(begins)
    counts = np.searchsorted(starts, places)
    # every text's own end comes behind its tokens' beginnings
    offsets = np.insert(starts, counts[1:], places[1:])
    return offsets, counts + np.arange(len(places))


_OUT = StructType(
    [
        StructField("_n", LongType()),
        StructField("_form", StringType()),
        StructField("_prefix", LongType()),
        StructField("_middle", LongType()),
        StructField("_output", StringType()),
    ]
)


def _characters(data: np.ndarray) -> int:
    return int(np.count_nonzero((data & 0xC0) != 0x80))


def _cut(batch: pa.RecordBatch, cut_percent: int, spm_percent: int) -> list[pa.Array]:
    """The output columns of a slice of ``_text, _h1 .. _h4``."""
    texts = arrays.filled(batch["_text"])
    offsets, firsts = boundaries(texts)
    n = np.diff(firsts) - 1
    h1, h2, h3, h4 = (batch[f"_h{k}"].to_numpy() for k in (1, 2, 3, 4))
    one, two = h1 % (n + 1), h2 % (n + 1)
    index = fit(offsets, firsts[:-1])
    places = np.stack([located(index, firsts[:-1] + r) for r in (np.minimum(one, two), np.maximum(one, two))])
    data, begins = arrays.text_bytes(texts)
    raw = data.tobytes()
    marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]
    forms, outputs, sizes = [], [], []
    for k in range(len(texts)):
        begin, end = begins[k], begins[k + 1]
        text = raw[begin:end]
        if not text or h3[k] % 100 >= cut_percent or any(m in text for m in marks):
            forms.append("plain")
            outputs.append(text)
            sizes.append((None, None))
            continue
        a, b = places[0, k] - begin, places[1, k] - begin
        prefix, middle, suffix = text[:a], text[a:b], text[b:]
        form = "spm" if h4[k] % 100 < spm_percent else "psm"
        forms.append(form)
        ordered = (
            (marks[1], suffix, marks[0], prefix, marks[2], middle)
            if form == "spm"
            else (marks[0], prefix, marks[1], suffix, marks[2], middle)
        )
        outputs.append(b"".join(ordered))
        sizes.append((_characters(data[begin : begin + a]), _characters(data[begin + a : begin + b])))
    return [
        pa.array(n, pa.int64()),
        pa.array(forms, pa.string()),
        pa.array([s[0] for s in sizes], pa.int64()),
        pa.array([s[1] for s in sizes], pa.int64()),
        pa.array(outputs, pa.binary()).cast(pa.string(), safe=False),
    ]


def _transform(schema: StructType, cut_percent: int, spm_percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in arrays.slices(whole, "_text"):
                made = _cut(batch, cut_percent, spm_percent)
                yield pa.RecordBatch.from_arrays([batch["_id"], *made], schema.names)

    return run


def fill_in_middle(
    documents: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    seed: int = SEED,
    cut_percent: int = CUT_PERCENT,
    spm_percent: int = SPM_PERCENT,
) -> DataFrame:
    """``id_col, n, form, prefix_chars, middle_chars, output`` of every row.

    ``n`` counts tokens, lengths are in code points.  The cuts follow from SHA-256 of
    seed and id alone, so a document is cut alike in any run; a NULL id hashes as an
    empty one.  NULL texts count as empty; these, texts that hold a marker and those not
    chosen stay as they are, with form ``plain`` and NULL lengths.  Repeated rows get a
    row each; other columns are ignored.  Nothing is shuffled.
    """
    code = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    hashes = [
        F.conv(F.substring(code, 8 * k + 1, 8), 16, 10).cast("bigint").alias(f"_h{k + 1}") for k in range(4)
    ]
    rows = documents.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), *hashes)
    schema = StructType([StructField("_id", rows.schema["_id"].dataType), *_OUT.fields])
    done = rows.mapInArrow(_transform(schema, cut_percent, spm_percent), schema)
    names = (id_col, "n", "form", "prefix_chars", "middle_chars", "output")
    return done.toDF(*names)


def restored(output: str, form: str) -> Column:
    """The exact text that an output of the given form was made from.

    The text holds no marker, and no marker begins as another ends, so the first place
    of each marker is where it was put.
    """
    head, tail = f"substring_index({output}, '{MIDDLE}', 1)", f"locate('{MIDDLE}', {output}) + {len(MIDDLE)}"
    middle = f"substr({output}, {tail})"

    def after(mark: str, other: str) -> str:
        return f"substr({head}, locate('{other}', {output}) + {len(other)})"

    def between(mark: str, other: str) -> str:
        return f"substr(substring_index({output}, '{other}', 1), {len(mark) + 1})"

    psm = f"concat({between(PREFIX, SUFFIX)}, {middle}, {after(PREFIX, SUFFIX)})"
    spm = f"concat({after(SUFFIX, PREFIX)}, {middle}, {between(SUFFIX, PREFIX)})"
    return F.expr(f"CASE {form} WHEN 'psm' THEN {psm} WHEN 'spm' THEN {spm} ELSE {output} END")


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's digest of ``fill_in_middle`` over ``documents``."""
    done = fill_in_middle(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return done.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored("output", "form"), 256).alias("restored_sha256"),
    )


OP11_SQL = f"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('{SEED}:' || doc_id) AS h FROM documents),
parts AS (
  SELECT *, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') AS t,
         CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
         CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4
  FROM texts),
cuts AS (
  SELECT *, len(t) AS n,
         least(h1 % (len(t) + 1), h2 % (len(t) + 1)) AS a,
         greatest(h1 % (len(t) + 1), h2 % (len(t) + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '{PREFIX}') OR contains(text, '{SUFFIX}')
                OR contains(text, '{MIDDLE}') OR h3 % 100 >= {CUT_PERCENT} THEN 'plain'
              WHEN h4 % 100 < {SPM_PERCENT} THEN 'spm' ELSE 'psm' END AS form
  FROM parts),
pieces AS (
  SELECT doc_id, text, n, form, array_to_string(t[1:a], '') AS prefix,
         array_to_string(t[a + 1:b], '') AS middle, array_to_string(t[b + 1:n], '') AS suffix
  FROM cuts)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text
                WHEN 'psm' THEN '{PREFIX}' || prefix || '{SUFFIX}' || suffix || '{MIDDLE}' || middle
                ELSE '{SUFFIX}' || suffix || '{PREFIX}' || prefix || '{MIDDLE}' || middle END)
         AS output_sha256,
       sha256(text) AS restored_sha256
FROM pieces
"""
