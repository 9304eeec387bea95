"""Operator 4: quality rules, judged by isolation forests.

Rule statistics of every document come from one Arrow pass over the text.  The base
rules reject on their own; the forest scores the rest by how few random splits set a
document's statistics apart from others, and the score's thresholds, one for each band
of length, are calibrated on all labelled rows.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, LongType, StructField, StructType

from cardex.llm import arrays
from cardex.llm.common import discard, store

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WINDOW = 5
MIN_WORDS = 10
# A document fails if 100 * repeated words exceed this many times its words.
MAX_REPEATED_PERCENT = 20

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MORE_COUNTS = ("n_upper", "n_letters", "n_marks", "n_echoes", "n_lines")
# Words and letters, all of them ordinary, that count with each text, so that a single
# odd character does not make a short text anomalous.
PRIOR_WORDS = 50
PRIOR_LETTERS = 5 * PRIOR_WORDS
PRIOR_UPPER = PRIOR_LETTERS // 50
PRIOR_LINES = 5

TREES = 128
# Rows of each tree, and how many times as many are looked at to find the first ones.
SUBSAMPLE = 256
DRAWN = 1.4
SEED = 4
# Words from which on each band of length begins.
BANDS = (0, 40, 120)
# Share of the labelled clean rows of a band that a threshold may reject.
FALSE_REJECTS = 0.002
# A band with fewer clean rows takes the strictest threshold of the others.
LEAST_CLEAN = 100
# Features of the first forest; the others are judged one by one, with the length.
RATES = 4


def _table(characters: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(characters)] = True
    return table


_SPACE = _table(b" \t\n\x0b\x0c\r")
_SYMBOL = _table(b"#*$%&|<>")
_UPPER = _table(bytes(range(65, 91)))
_LETTER = _table(bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(0xC3, 0xF5)))
_MARK = _table(b"!?")
_CONTINUED = _table(bytes(range(0x80, 0xC0)))


def statistics(texts: pa.Array) -> dict[str, np.ndarray]:
    """The counts of each text, by name."""
    data, places = arrays.text_bytes(texts)
    space = _SPACE[data]
    found = {
        "word_chars": arrays.sums(~space & ~_CONTINUED[data], places),
        "n_symbols": arrays.sums(_SYMBOL[data], places),
        "n_upper": arrays.sums(_UPPER[data], places),
        "n_letters": arrays.sums(_LETTER[data], places),
        "n_marks": arrays.sums(_MARK[data], places),
    }
    flat, at = arrays.words(texts)
    found["n_words"] = np.diff(at)
    found["n_repeat_words"], found["n_echoes"] = _repeated(arrays.codes(flat)[0], at)
    found["n_dup_lines"], found["n_lines"] = _duplicate_lines(texts)
    return found


def _repeated(codes: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per text: words covered by windows found twice, and words equal to the one before."""
    owner = arrays.owners(places)
    same = np.zeros(len(codes), bool)
    same[1:] = (codes[1:] == codes[:-1]) & (owner[1:] == owner[:-1])
    covered = np.zeros(len(codes), bool)
    n = len(codes) - WINDOW + 1
    if n > 0:
        starts = np.flatnonzero(owner[:n] == owner[WINDOW - 1 :])
        with np.errstate(over="ignore"):
            key = arrays.mixed(owner[starts] + 1)
            for k in range(WINDOW):
                key = arrays.mixed(key * np.uint64(0x9E3779B97F4A7C15) + codes[starts + k].astype(np.uint64))
        order = np.argsort(key, kind="stable")
        equal = key[order][1:] == key[order][:-1]
        twice = np.zeros(len(starts), bool)
        twice[order[1:][equal]] = True
        twice[order[:-1][equal]] = True
        for k in range(WINDOW):
            covered[starts[twice] + k] = True
    return arrays.sums(covered, places), arrays.sums(same, places)


def _duplicate_lines(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Per text the lines with a word that are equal to an earlier one, and all with a word."""
    flat, places = arrays.lists(pc.split_pattern(texts, "\n"))
    worded = pc.greater(pc.binary_length(pc.ascii_trim_whitespace(flat)), 0)
    worded = worded.to_numpy(zero_copy_only=False)
    codes, distinct = arrays.codes(flat)
    owner = arrays.owners(places)
    keys = (owner * max(len(distinct), 1) + codes)[worded]
    first = np.unique(keys) // max(len(distinct), 1)
    lines = arrays.sums(worded, places)
    return lines - np.bincount(first, minlength=len(texts)).astype(np.int64), lines


def features(found: dict[str, np.ndarray]) -> np.ndarray:
    """All rule statistics, one row per text.

    Rates of symbols, capitals, marks, echoes, repeated words and duplicate lines, as
    their square roots, so that splits fall between small rates as well; the logarithms
    of the mean length of a word and of the number of words.
    """
    words, letters = found["n_words"] + PRIOR_WORDS, found["n_letters"] + PRIOR_LETTERS
    rates = [
        found["n_symbols"] / words,
        (found["n_upper"] + PRIOR_UPPER) / letters,
        found["n_marks"] / words,
        found["n_echoes"] / words,
        found["n_repeat_words"] / words,
        found["n_dup_lines"] / (found["n_lines"] + PRIOR_LINES),
    ]
    mean = (found["word_chars"] + PRIOR_LETTERS) / words
    return np.column_stack([*np.sqrt(rates), np.log(mean), np.log(words)])


def base_failed(found: dict[str, np.ndarray]) -> np.ndarray:
    return (found["n_words"] < MIN_WORDS) | (
        100 * found["n_repeat_words"] > MAX_REPEATED_PERCENT * found["n_words"]
    )


def _path_of(n: float) -> float:
    """Mean path length of an unsuccessful search among ``n`` rows."""
    if n <= 1:
        return 0.0
    return 2 * (np.log(n - 1) + np.euler_gamma) - 2 * (n - 1) / n if n > 2 else 1.0


@dataclass
class Forest:
    """Trees as arrays: a node's feature (-1 at a leaf), split value, children, length.

    Rows whose feature ``ranged`` is not within ``low`` to ``high`` go to the leaf
    ``outside``.  ``others`` judge the same rows by other features; any may reject.
    """

    feature: np.ndarray
    value: np.ndarray
    left: np.ndarray
    right: np.ndarray
    length: np.ndarray
    roots: np.ndarray
    normal: float
    low: np.ndarray
    high: np.ndarray
    outside: np.ndarray
    ranged: int = 0
    thresholds: tuple[float, ...] = (0.6,) * len(BANDS)
    others: tuple[Forest, ...] = ()

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """2 ** (-mean path / normal path): near 1 anomalous, below 0.5 ordinary."""
        if not len(rows) or not len(self.roots):
            return np.zeros(len(rows))
        node = np.broadcast_to(self.roots, (len(rows), len(self.roots))).copy()
        at = np.arange(len(rows))[:, None]
        while True:
            feature = self.feature[node]
            inner = feature >= 0
            if not inner.any():
                break
            value = rows[at, np.maximum(feature, 0)]
            child = np.where(value < self.value[node], self.left[node], self.right[node])
            watched = rows[:, self.ranged, None]
            out = (watched < self.low[node]) | (watched > self.high[node])
            node = np.where(inner, np.where(out, self.outside[node], child), node)
        return 2.0 ** (-self.length[node].mean(axis=1) / self.normal)

    def rejects(self, rows: np.ndarray, n_words: np.ndarray) -> np.ndarray:
        found = self.scores(rows) >= np.asarray(self.thresholds)[_band(n_words)]
        for other in self.others:
            found |= other.rejects(rows, n_words)
        return found

    def anomaly(self, rows: np.ndarray) -> np.ndarray:
        """The highest of all forests' scores."""
        return np.max([f.scores(rows) for f in (self, *self.others)], axis=0)


def _band(n_words: np.ndarray) -> np.ndarray:
    return np.searchsorted(BANDS, n_words, side="right") - 1


def grow(
    rows: np.ndarray, trees: int = TREES, subsample: int = SUBSAMPLE, seed: int = SEED, ranges: bool = False
) -> Forest:
    """An isolation forest of ``rows``; with fewer than two rows it has no trees."""
    random = np.random.default_rng(seed)
    size = min(subsample, len(rows))
    drawn = [rows[random.choice(len(rows), size, replace=False)] for _ in range(trees if size > 1 else 0)]
    return grown(drawn, seed, ranges)


def grown(drawn: list[np.ndarray], seed: int = SEED, ranges: bool = False) -> Forest:
    """An isolation forest with a tree of each array of rows.

    With ``ranges``, a row whose first feature lies beyond all rows of a node is set
    apart there and then.
    """
    random = np.random.default_rng(seed)
    nodes: list[list[float]] = []
    tables = [np.zeros((0, 8))]
    roots = [0]
    size = max(map(len, drawn), default=0)
    deepest = int(np.ceil(np.log2(max(size, 2))))

    def build(part: np.ndarray, depth: int) -> int:
        number = len(nodes)
        nodes.append([-1, 0.0, 0, 0, depth + _path_of(len(part)), -np.inf, np.inf, 0])
        low, high = part.min(axis=0), part.max(axis=0)
        wide = np.flatnonzero(high > low)
        if depth < deepest and len(part) > 1 and len(wide):
            feature = random.choice(wide)
            value = random.uniform(low[feature], high[feature])
            under = part[:, feature] < value
            if under.any() and not under.all():
                left = build(part[under], depth + 1)
                right = build(part[~under], depth + 1)
                nodes[number][:4] = [feature, value, roots[-1] + left, roots[-1] + right]
                if ranges:
                    nodes[number][5:] = [low[0], high[0], roots[-1] + len(nodes)]
                    nodes.append([-1, 0.0, 0, 0, depth + 1, -np.inf, np.inf, 0])
        return number

    for part in drawn:
        build(part, 0)
        tables.append(np.array(nodes, float))
        roots.append(roots[-1] + len(nodes))
        nodes.clear()
    table = np.concatenate(tables) if drawn else np.array([[-1, 0, 0, 0, 0, 0, 0, 0]], float)
    whole = [table[:, k].astype(np.int32) for k in (0, 2, 3, 7)]
    return Forest(
        whole[0],
        table[:, 1].copy(),
        whole[1],
        whole[2],
        table[:, 4].copy(),
        np.array(roots[:-1], np.int32),
        _path_of(size) or 1.0,
        table[:, 5].copy(),
        table[:, 6].copy(),
        whole[3],
    )


def _threshold(clean: np.ndarray, n_clean: int, bad: list, n_bad: int) -> float:
    """The threshold that tells labelled rows apart best.

    ``clean`` are the highest scores of the ``n_clean`` clean rows, down to the lowest
    that may be rejected and the next.  ``bad`` has the number and the least and greatest
    score of the bad rows above each distinct one of these, up to the one after.  Of the
    thresholds halfway from a clean score that stays to the next bad one, it is that
    with the most rejected bad rows less rejected clean ones.
    """
    edges = np.unique(clean)
    if not bad:
        return float(edges[0] + 1) / 2
    best, found = 0.0, (max(edges[-1], max(b["most"] for b in bad)) + 1) / 2
    rejected = 0
    for b in sorted(bad, key=lambda b: -b["bin"]):
        rejected += b["rows"]
        gain = rejected / n_bad - (clean > edges[b["bin"]]).sum() / n_clean
        if gain >= best:
            best, found = gain, (edges[b["bin"]] + b["least"]) / 2
    return float(found)


def _per_batch(documents: DataFrame, id_col: str, text_col: str, columns: list[StructField], compute) -> DataFrame:
    """``id_col`` and the columns that ``compute`` makes of every slice's texts."""
    source = documents.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    schema = StructType([StructField(id_col, source.schema["_id"].dataType), *columns])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in arrays.slices(batch, "_text"):
                made = compute(arrays.filled(part["_text"]))
                values = [part["_id"], *(pa.array(made[c.name]) for c in columns)]
                yield pa.RecordBatch.from_arrays(values, [id_col, *(c.name for c in columns)])

    return source.mapInArrow(run, schema)


def _kinds() -> list[np.ndarray]:
    """The features of each forest: the first rates, and each other one with the length."""
    length = RATES + 3
    return [np.arange(RATES), *(np.array([column, length]) for column in range(RATES, length))]


_LABELLED = (*COUNTS, *MORE_COUNTS)


def _counted(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Features, number of words, whether clean, whether judged by a forest."""
    stats = {name: batch[name].to_numpy() for name in _LABELLED}
    return features(stats), stats["n_words"], batch["_quality"].to_numpy() > 0, ~base_failed(stats)


def _drawn(labelled: DataFrame, n_rows: int, n_good: int) -> list[list[np.ndarray]]:
    """For each forest the rows of each tree, ``SUBSAMPLE`` of all labelled ones.

    A tree takes those that come first by a hash of its own; rows that cannot be among
    them, by how many there are, do not leave their task, nor do features that the
    tree's forest does not judge.
    """
    kinds = _kinds()

    def draw(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, _, clean, judged = _counted(batch)
            order = batch["_order"].to_numpy().astype(np.uint64)
            found = []
            for kind, columns in enumerate(kinds):
                of = np.flatnonzero(judged & clean) if kind else np.arange(len(rows))
                own = rows[of][:, columns]
                share = DRAWN * SUBSAMPLE / max(n_good if kind else n_rows, 1)
                last = np.uint64(min(int(share * 2.0**64), 2**64 - 1))
                for tree in range(kind * TREES, (kind + 1) * TREES):
                    key = arrays.mixed(order[of] ^ arrays.mixed(np.array([tree + 1]))[0])
                    first = np.flatnonzero(key <= last)
                    sizes = np.full(len(first), len(columns))
                    found.append((np.full(len(first), tree), key[first] >> np.uint64(1), sizes, own[first].ravel()))
            tree, key, sizes, values = (np.concatenate(part) for part in zip(*found))
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            features_of = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))
            columns = [pa.array(tree.astype(np.int16)), pa.array(key.astype(np.int64)), features_of]
            yield pa.RecordBatch.from_arrays(columns, ["tree", "key", "row"])

    found = labelled.mapInArrow(draw, "tree smallint, key bigint, row array<double>").toArrow()
    tree, key = found["tree"].to_numpy(), found["key"].to_numpy()
    values = pc.list_flatten(found["row"]).to_numpy()
    begins = np.cumsum(pc.list_value_length(found["row"]).to_numpy(), dtype=np.int64)
    parts = []
    for kind, columns in enumerate(kinds):
        of = np.flatnonzero(tree // TREES == kind)
        rows = values[begins[of][:, None] - np.arange(len(columns), 0, -1)]
        # by the features too, as rows of one key may come in any order
        order = np.lexsort([*rows.T, key[of], tree[of]])
        ends = np.searchsorted(tree[of][order], np.arange(TREES + 1) + kind * TREES)
        drawn = [rows[order[a:b][:SUBSAMPLE]] for a, b in zip(ends[:-1], ends[1:])]
        parts.append([part for part in drawn if len(part) > 1])
    return parts


def _calibrated(labelled: DataFrame, forest: Forest) -> Forest:
    """The forest and those beside it with their thresholds, from all labelled rows.

    Per band of the first one, at most ``FALSE_REJECTS`` of the clean rows may be
    rejected; bands with hardly any clean rows are as careful as the most careful other
    band.  The others reject what is odder than all but that share of all clean rows,
    divided by the forests.
    """
    first, others = forest, forest.others

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, n_words, clean, judged = _counted(batch)
            for kind, own in enumerate((first, *others)):
                of = np.flatnonzero(judged & clean if kind else judged)
                band = np.zeros(len(of)) if kind else _band(n_words[of])
                values = [np.full(len(of), kind, np.int32), band.astype(np.int32), clean[of], own.scores(rows[of])]
                yield pa.RecordBatch.from_arrays([pa.array(v) for v in values], ["kind", "band", "clean", "score"])

    spark = labelled.sparkSession
    groups = [(0, b) for b in range(len(BANDS))] + [(kind, 0) for kind in range(1, len(others) + 1)]
    rows_of = {
        f"{name}_{kind}_{band}": f"count_if(kind = {kind} and band = {band} and {condition})"
        for kind, band in groups
        for name, condition in (("clean", "clean"), ("bad", "not clean"))
    }
    found = labelled.mapInArrow(score, "kind int, band int, clean boolean, score double")
    scored = store(spark, found, "scored", **rows_of)
    sizes = {(k, b): tuple(scored.measures[f"{name}_{k}_{b}"] for name in ("clean", "bad")) for k, b in groups}

    def highest(kind: int, band: int, share: float) -> np.ndarray:
        own = scored.where((F.col("kind") == kind) & (F.col("band") == band) & F.col("clean"))
        top = own.orderBy(F.desc("score")).limit(int(share * sizes[kind, band][0]) + 1)
        return top.select("score").toArrow()["score"].to_numpy()

    bands = [b for b in range(len(BANDS)) if sizes[0, b][0] >= LEAST_CLEAN]
    tops = {b: highest(0, b, FALSE_REJECTS) for b in bands}
    edges = {b: np.unique(top) for b, top in tops.items()}

    def binned(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            band, scores = batch["band"].to_numpy(), batch["score"].to_numpy()
            for b, own in edges.items():
                above = scores[(band == b) & (scores > own[0])]
                bins = np.searchsorted(own, above, side="left") - 1
                values = [pa.array(np.full(len(above), b, np.int32)), pa.array(bins.astype(np.int32)), pa.array(above)]
                yield pa.RecordBatch.from_arrays(values, ["band", "bin", "score"])

    bad = (
        scored.where("kind = 0 and not clean").select("band", "score")
        .mapInArrow(binned, "band int, bin int, score double")
        .groupBy("band", "bin")
        .agg(F.count(F.lit(1)).alias("rows"), F.min("score").alias("least"), F.max("score").alias("most"))
        .collect()
    )
    found = {b: _threshold(tops[b], sizes[0, b][0], [r for r in bad if r.band == b], sizes[0, b][1]) for b in bands}
    forest.thresholds = tuple(found.get(b, max(found.values(), default=0.75)) for b in range(len(BANDS)))
    for kind, other in enumerate(others, 1):
        least = highest(kind, 0, FALSE_REJECTS / len(others))[-1]
        # halfway to the score of what is beyond all rows of every tree
        other.thresholds = (float(least + 2.0 ** (-1 / other.normal)) / 2,) * len(BANDS)
    discard(scored)
    return forest


def fit(documents: DataFrame, labels: DataFrame) -> Forest:
    """A forest grown and calibrated on all labelled rows.

    A forest on the first rates, with forests on the other statistics beside it: one on
    all would seldom split where a document is odd in a single statistic.  So each other
    statistic has a forest with the length, of clean rows, as labelled bad ones need not
    be odd there.  Length alone is no reason.

    Each tree has ``SUBSAMPLE`` rows, as isolation forests do, drawn from all; the
    thresholds are from the scores of all.  Without labelled rows the forest has no trees
    and rejects nothing.  Rows equal in id and counts are one.  What reaches the driver
    is the trees' rows and the highest ``FALSE_REJECTS`` of the clean rows' scores.
    """
    known = (
        labels.where("doc_id is not null and quality is not null")
        .groupBy(F.col("doc_id").alias("_label_id"))
        .agg(F.min("quality").cast("bigint").alias("_quality"))
    )
    texts = documents.select(F.col("doc_id").alias("_id"), F.col("text").alias("_text"))
    columns = [StructField(name, LongType()) for name in _LABELLED]
    # counted before they are joined, so no text is shuffled
    counted = _per_batch(texts.where("_id is not null"), "_id", "_text", columns, statistics)
    rows = counted.join(known, F.col("_id") == F.col("_label_id")).select("_id", "_quality", *_LABELLED).distinct()
    passed = f"n_words >= {MIN_WORDS} and 100 * n_repeat_words <= {MAX_REPEATED_PERCENT} * n_words"
    labelled = store(
        documents.sparkSession,
        rows.select(F.xxhash64("_id", *_LABELLED).alias("_order"), "_quality", *_LABELLED),
        "labelled",
        rows="count(1)",
        good=f"count_if({passed} and _quality > 0)",
    )
    n_rows, n_good = labelled.measures["rows"], labelled.measures["good"]
    drawn = _drawn(labelled, n_rows, n_good) if n_rows > 1 else [[]]
    forest = grown(drawn[0])
    if len(forest.roots) and n_good >= LEAST_CLEAN:
        for columns, parts in list(zip(_kinds(), drawn))[1:]:
            other = grown(parts, ranges=True)
            other.feature = np.where(other.feature >= 0, columns[other.feature], -1).astype(np.int32)
            other.ranged = int(columns[0])
            forest.others += (other,)
    if len(forest.roots):
        forest = _calibrated(labelled, forest)
    discard(labelled)
    return forest


def quality_rules(
    documents: DataFrame, forest: Forest, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id_col``, the counts, ``base_failed, anomaly, kept`` of every document.

    Words are runs without ASCII white space.  NULL and empty texts have no words and
    fail the base rules.  Repeated rows each get their row, ids may be NULL, other
    columns are ignored, texts of any length are taken whole.
    """

    def judge(texts: pa.Array) -> dict[str, np.ndarray]:
        found = statistics(texts)
        rates = features(found)
        failed = base_failed(found)
        rejected = forest.rejects(rates, found["n_words"]) if len(forest.roots) else np.zeros(len(failed), bool)
        made = {name: found[name] for name in COUNTS}
        return made | {"base_failed": failed, "anomaly": forest.anomaly(rates), "kept": ~failed & ~rejected}

    columns = [
        *(StructField(name, LongType()) for name in COUNTS),
        StructField("base_failed", BooleanType()),
        StructField("anomaly", DoubleType()),
        StructField("kept", BooleanType()),
    ]
    return _per_batch(documents, id_col, text_col, columns, judge)


def kept_documents(documents: DataFrame, forest: Forest, text_col: str = "text") -> DataFrame:
    """The documents that ``quality_rules`` keeps, with all their columns, unshuffled."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in arrays.slices(batch, text_col):
                found = statistics(arrays.filled(part[text_col]))
                kept = ~base_failed(found)
                if len(forest.roots):
                    kept &= ~forest.rejects(features(found), found["n_words"])
                yield part.filter(pa.array(kept))

    return documents.mapInArrow(run, documents.schema)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``quality_rules`` of ``documents`` by a forest fitted on ``labels``."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    forest = fit(documents, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_rules(documents, forest)
