"""Operator 5: toxicity by a convolutional text classifier.

Words become hashed embeddings (of the word and of two prefixes), filters of several
widths run over them, the strongest answer of each filter goes into a logistic output.
The network starts on some labelled rows, trained in numpy, and goes on over all others
in Spark's tasks, whose changes are averaged; a threshold for each language, which is told
from the text's function words, is calibrated on rows kept back from training and mapped
to one fixed score.
"""

from __future__ import annotations

import copy
import sys
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, BooleanType, DoubleType, IntegerType, StructField, StructType

from cardex.llm import arrays
from cardex.llm.common import discard, store

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The score from which a document counts as toxic.
THRESHOLD = 0.3
HELD_OUT = 2
FOLDS = 4

# Labelled rows of either label that the network starts on, and the bytes of words (12
# each) that reach the driver for that; all others train it in tasks.
SAMPLE_EACH = 3000
SAMPLE_BYTES = 64 * 1024 * 1024
# One in so many is kept back from training for the thresholds.
CALIBRATED = 5

BUCKETS = 1 << 22
PREFIXES = (4, 5)
SIZE = 12
WIDTHS = (1, 2, 3)
FILTERS = 12
# Passes over the sample, and steps of a small sample's at least.
EPOCHS = 8
LEAST_STEPS = 400
BATCH = 32
RATE = 0.05
SEED = 5
# Bytes of words that a task trains on at a time, one row more at most.
SHARD_BYTES = 8 * 1024 * 1024
# Labelled rows that are broadcast to the texts at most.
BROADCAST_ROWS = 2_000_000
# Scores are counted in so many bins for each unit of their logit.
BINS = 100

# Function words by which a text's language is guessed.
FUNCTION_WORDS = {
    "en": "the of and to in is that was for it with as be by this are or from",
    "fr": "le la les de des et un une est que pour dans par sur pas au du elle",
    "de": "der die das und ist nicht von zu mit ein eine auf für sich als den im",
    "es": "el la los las de que y en un una por con para su se del es al no",
}
LANGUAGES = (*FUNCTION_WORDS, "other")


@dataclass
class Words:
    """The words of some texts: codes of distinct words, and where each text begins."""

    codes: np.ndarray
    places: np.ndarray
    # one row for each distinct word: buckets of the word and of its prefixes
    buckets: np.ndarray
    # one row for each distinct word: whether it is a function word of each language
    function: np.ndarray


def _hashes(distinct: pa.Array, most: int | None = None) -> np.ndarray:
    """Buckets of the words, or of what their first ``most`` bytes are."""
    data, places = arrays.text_bytes(distinct)
    position = np.arange(len(data)) - np.repeat(places[:-1], np.diff(places))
    with np.errstate(over="ignore"):
        parts = arrays.mixed((position.astype(np.uint64) << np.uint64(8)) + data + np.uint64(1))
        if most is not None:
            parts[position >= most] = 0
        running = np.concatenate([np.zeros(1, np.uint64), np.cumsum(parts, dtype=np.uint64)])
        sums = running[places[1:]] - running[places[:-1]] + np.uint64(most or 0)
    return (arrays.mixed(sums) % np.uint64(BUCKETS)).astype(np.int64)


def words_of(texts: pa.Array) -> Words:
    """Words in lower case without punctuation at their ends; those left empty stay."""
    flat, places = arrays.words(texts)
    raw, distinct = arrays.codes(flat)
    plain = pc.utf8_trim(pc.utf8_lower(distinct.cast(pa.string())), ".,;:!?\"'()[]{}<>*#%&$|-_=")
    again, distinct = arrays.codes(plain)
    kinds = [_hashes(distinct), *(_hashes(distinct, most) for most in PREFIXES)]
    function = [pc.is_in(distinct, pa.array(w.split())).to_numpy(zero_copy_only=False) for w in FUNCTION_WORDS.values()]
    return Words(again[raw], places, np.column_stack(kinds), np.column_stack(function))


def languages(words: Words) -> np.ndarray:
    """For each text the number of its language: the most function words, or other."""
    hits = words.function[words.codes]
    counts = np.column_stack([arrays.sums(hits[:, k], words.places) for k in range(len(FUNCTION_WORDS))])
    return np.where(counts.max(axis=1) > 0, counts.argmax(axis=1), len(FUNCTION_WORDS))


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


@dataclass
class Network:
    """Known buckets with their embeddings (row 0: unknown, all zero), filters, output."""

    known: list[np.ndarray]
    embeddings: list[np.ndarray]
    filters: list[np.ndarray]
    biases: list[np.ndarray]
    output: np.ndarray
    offset: float
    thresholds: np.ndarray = field(default_factory=lambda: np.full(len(LANGUAGES), 0.5))
    # sums of squares of the steps, while training goes on
    squares: dict = field(default_factory=dict)

    def rows(self, buckets: np.ndarray) -> np.ndarray:
        """Embedding rows of words, 0 for buckets that training did not meet."""
        found = []
        for k, known in enumerate(self.known):
            at = np.searchsorted(known, buckets[:, k])
            at = np.minimum(at, max(len(known) - 1, 0))
            met = known[at] == buckets[:, k] if len(known) else np.zeros(len(buckets), bool)
            found.append(np.where(met, at + 1, 0))
        return np.column_stack(found)

    def vectors(self, rows: np.ndarray) -> np.ndarray:
        return sum(table[rows[:, k]] for k, table in enumerate(self.embeddings))

    def pooled(self, vectors: np.ndarray, codes: np.ndarray, places: np.ndarray, at: bool = False) -> tuple:
        """Per text and filter the strongest answer (0 where the text is too short), and its place.

        Filters are applied to the distinct words' vectors, which the words then look
        up, so a text costs additions only.
        """
        texts, n = len(places) - 1, len(codes)
        answers = np.zeros((texts, len(WIDTHS) * FILTERS), np.float32)
        spots = np.zeros((texts, len(WIDTHS) * FILTERS), np.int64) if at else None
        owner = arrays.owners(places)
        for i, width in enumerate(WIDTHS):
            if n < width:
                continue
            size = n - width + 1
            found = np.repeat(self.biases[i][None, :], size, axis=0)
            for step in range(width):
                found += (vectors @ self.filters[i][step])[codes[step : step + size]]
            found[owner[:size] != owner[width - 1 :]] = -np.inf
            full = np.flatnonzero(np.diff(places) > 0)
            full = full[places[full] < size]
            if not len(full):
                continue
            most = np.maximum.reduceat(found, places[full], axis=0)
            columns = slice(i * FILTERS, (i + 1) * FILTERS)
            answers[full, columns] = np.maximum(most, 0)
            if at:
                ends = np.append(places[full][1:], size)
                for text, start, end in zip(full, places[full], ends):
                    spots[text, columns] = start + found[start:end].argmax(axis=0)
        return answers, spots

    def scores(self, words: Words) -> np.ndarray:
        vectors = self.vectors(self.rows(words.buckets))
        answers, _ = self.pooled(vectors, words.codes, words.places)
        return _logistic(answers @ self.output + self.offset)

    def calibrated(self, words: Words) -> np.ndarray:
        """Scores moved so that every language's threshold is ``THRESHOLD``."""
        limits = self.thresholds[languages(words)]
        return _logistic(_logit(self.scores(words)) - _logit(limits) + _logit(np.float64(THRESHOLD)))


class _Steps:
    """Adagrad steps."""

    def __init__(self, rate: float, squares: dict | None = None):
        self.rate, self.squares = rate, {} if squares is None else squares

    def dense(self, name, value: np.ndarray, slope: np.ndarray) -> None:
        seen = self.squares.setdefault(name, np.full(value.shape, 1e-3, np.float32))
        seen += slope * slope
        value -= self.rate * slope / np.sqrt(seen)

    def sparse(self, name, value: np.ndarray, rows: np.ndarray, slope: np.ndarray) -> None:
        distinct, at = np.unique(rows, return_inverse=True)
        total = np.zeros((len(distinct), value.shape[1]), np.float32)
        np.add.at(total, at, slope)
        seen = self.squares.setdefault(name, np.full(value.shape, 1e-3, np.float32))
        seen[distinct] += total * total
        step = self.rate * total / np.sqrt(seen[distinct])
        step[distinct == 0] = 0  # the unknown word stays at zero
        value[distinct] -= step


def train(buckets: list[np.ndarray], labels: np.ndarray, seed: int = SEED) -> Network:
    """A network for texts given as their words' buckets, one array (words, kinds) each."""
    random = np.random.default_rng(seed)
    kinds = 1 + len(PREFIXES)
    known = [
        np.unique(np.concatenate([b[:, k] for b in buckets])).astype(np.int64) if buckets else np.zeros(0, np.int64)
        for k in range(kinds)
    ]

    def normal(*shape: int, scale: float) -> np.ndarray:
        return (random.standard_normal(shape) * scale).astype(np.float32)

    embeddings = [normal(len(k) + 1, SIZE, scale=0.05) for k in known]
    for table in embeddings:
        table[0] = 0
    network = Network(
        known,
        embeddings,
        [normal(w, SIZE, FILTERS, scale=1 / np.sqrt(SIZE * w)) for w in WIDTHS],
        [np.zeros(FILTERS, np.float32) for _ in WIDTHS],
        normal(len(WIDTHS) * FILTERS, scale=0.3),
        0.0,
    )
    rows = [network.rows(b).astype(np.int32) for b in buckets]
    steps = _Steps(RATE)
    offset = np.zeros(1, np.float32)
    batches = -(-len(rows) // BATCH)
    for _ in range(max(EPOCHS, -(-LEAST_STEPS // batches)) if batches else 0):
        order = random.permutation(len(rows))
        for start in range(0, len(order), BATCH):
            chosen = order[start : start + BATCH]
            _step(network, offset, steps, [rows[i] for i in chosen], labels[chosen])
    network.offset, network.squares = float(offset[0]), steps.squares
    return network


def _extend(network: Network, buckets: list[np.ndarray]) -> None:
    """Make the words of some texts known; those that were not begin at zero."""
    for k, known in enumerate(network.known):
        new = np.setdiff1d(np.concatenate([b[:, k] for b in buckets]), known)
        order = np.argsort(np.concatenate([known, new]))
        network.known[k] = np.concatenate([known, new])[order].astype(np.int64)

        def grown(table: np.ndarray, fill: float) -> np.ndarray:
            more = np.full((len(new), SIZE), fill, np.float32)
            return np.concatenate([table[:1], np.concatenate([table[1:], more])[order]])

        network.embeddings[k] = grown(network.embeddings[k], 0)
        if ("embeddings", k) in network.squares:
            network.squares["embeddings", k] = grown(network.squares["embeddings", k], 1e-3)


def _dense(network: Network) -> list[np.ndarray]:
    return [*network.filters, *network.biases, network.output, np.array([network.offset], np.float32)]


def _changes(before: Network, after: Network) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Kind, numbers and ``SIZE`` values each of what training changed.

    Embeddings by their buckets; after them, as one more kind, all else in pieces.
    """
    for k, known in enumerate(after.known):
        change = after.embeddings[k][1:].copy()
        change[np.searchsorted(known, before.known[k])] -= before.embeddings[k][1:]
        moved = change.any(axis=1)
        yield k, known[moved], change[moved]
    flat = np.concatenate([(a - b).ravel() for a, b in zip(_dense(after), _dense(before))])
    pieces = np.resize(flat, -(-len(flat) // SIZE) * SIZE).reshape(-1, SIZE)
    yield len(after.known), np.arange(len(pieces)), pieces


def _changed(network: Network, kind: np.ndarray, number: np.ndarray, change: np.ndarray) -> Network:
    """The network with changes added."""
    for k in range(len(network.known)):
        own = kind == k
        buckets = number[own]
        new = np.setdiff1d(buckets, network.known[k])
        order = np.argsort(np.concatenate([network.known[k], new]))
        table = np.concatenate([network.embeddings[k][1:], np.zeros((len(new), SIZE), np.float32)])[order]
        network.known[k] = np.concatenate([network.known[k], new])[order].astype(np.int64)
        table[np.searchsorted(network.known[k], buckets)] += change[own].astype(np.float32)
        network.embeddings[k] = np.concatenate([network.embeddings[k][:1], table])
    own = kind == len(network.known)
    flat, at = change[own][np.argsort(number[own])].ravel().astype(np.float32), 0
    for value in _dense(network)[:-1]:
        value += flat[at : at + value.size].reshape(value.shape)
        at += value.size
    network.offset += float(flat[at])
    return network


def train_further(network: Network, rows: DataFrame) -> Network:
    """The network trained once on all rows (``_toxic, _words``), in tasks.

    Each task goes on from the network as it is; the mean of the tasks' changes, by their
    numbers of rows, is added to it, of an embedding that of the tasks which changed it.
    """

    def shard(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = copy.deepcopy(network)
        steps, offset, seen = _Steps(RATE, own.squares), np.array([own.offset], np.float32), 0
        random = np.random.default_rng(SEED)
        for batch in batches:
            for part in arrays.slices(batch, "_words", SHARD_BYTES):
                buckets, labels = _buckets(part["_words"]), part["_toxic"].to_numpy().astype(np.int64)
                _extend(own, buckets)
                found = [own.rows(b).astype(np.int32) for b in buckets]
                order = random.permutation(len(found))
                for start in range(0, len(order), BATCH):
                    chosen = order[start : start + BATCH]
                    _step(own, offset, steps, [found[i] for i in chosen], labels[chosen])
                seen += len(found)
        own.offset = float(offset[0])
        for kind, number, change in _changes(network, own) if seen else ():
            for at in range(0, len(number), 10_000):
                values = change[at : at + 10_000].astype(np.float64)
                size = len(values)
                columns = [np.full(size, kind, np.int32), number[at : at + size].astype(np.int64), np.full(size, seen, np.int64)]
                columns += [values[:, j] for j in range(SIZE)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

    values = [f"v{j}" for j in range(SIZE)]
    names = ["kind", "number", "seen", *values]
    schema = "kind int, number bigint, seen bigint, " + ", ".join(f"{v} double" for v in values)
    means = [(F.sum(F.col(v) * F.col("seen")) / F.sum("seen")).cast("float").alias(v) for v in values]
    found = rows.mapInArrow(shard, schema).groupBy("kind", "number").agg(*means).toArrow()
    change = np.column_stack([found[v].to_numpy() for v in values])
    return _changed(network, found["kind"].to_numpy(), found["number"].to_numpy(), change)


def _step(network: Network, offset: np.ndarray, steps: _Steps, rows: list[np.ndarray], labels: np.ndarray) -> None:
    """One step on a batch of texts; only the places that won the pooling carry a slope."""
    places = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    flat = np.concatenate(rows) if places[-1] else np.zeros((0, len(network.known)), np.int64)
    vectors = network.vectors(flat)
    answers, spots = network.pooled(vectors, np.arange(len(flat)), places, at=True)
    slope = (_logistic(answers @ network.output + offset[0]) - labels).astype(np.float32) / len(labels)
    back = slope[:, None] * network.output[None, :] * (answers > 0)
    steps.dense("output", network.output, answers.T @ slope + 1e-4 * network.output)
    steps.dense("offset", offset, np.array([slope.sum()], np.float32))
    touched, slopes = [], []
    for i, width in enumerate(WIDTHS):
        columns = slice(i * FILTERS, (i + 1) * FILTERS)
        part, spot = back[:, columns], spots[:, columns]
        live = part != 0
        where, weight = spot[live], part[live]
        which = np.broadcast_to(np.arange(FILTERS), part.shape)[live]
        change = np.zeros_like(network.filters[i])
        for step in range(width):
            np.add.at(change[step].T, which, weight[:, None] * vectors[where + step])
            touched.append(flat[where + step])
            slopes.append(weight[:, None] * network.filters[i][step].T[which])
        steps.dense(("filters", i), network.filters[i], change)
        steps.dense(("biases", i), network.biases[i], part.sum(axis=0))
    touched, slopes = np.concatenate(touched), np.concatenate(slopes)
    if len(touched):
        for k, table in enumerate(network.embeddings):
            steps.sparse(("embeddings", k), table, touched[:, k], slopes)


def _best_threshold(bins: np.ndarray, least: np.ndarray, most: np.ndarray, toxic: np.ndarray, rows: np.ndarray) -> float:
    """The cut between two bins with the best F1, in the middle of their gap on a logit scale.

    For each bin its least and greatest score and its rows; one may come several times.
    """
    found, at = np.unique(-bins, return_inverse=True)
    low, high = np.full(len(found), np.inf), np.zeros(len(found))
    np.minimum.at(low, at, least)
    np.maximum.at(high, at, most)
    hits = np.cumsum(np.bincount(at, toxic))
    f1 = 2 * hits / (np.cumsum(np.bincount(at, rows)) + toxic.sum())
    best = int(np.argmax(f1))
    below = high[best + 1] if best + 1 < len(found) else low[best] / 2
    return float(_logistic((_logit(low[best]) + _logit(below)) / 2))


def calibrate(network: Network, scored: DataFrame) -> Network:
    """Thresholds per language; one with few toxic rows takes that of all languages.

    All rows of ``scored`` (``_toxic, _score, _language``) are counted, by bins of their score.
    """
    held = F.greatest(F.lit(1e-6), F.least(F.col("_score"), F.lit(1 - 1e-6)))
    found = (
        scored.groupBy("_language", F.floor(F.log(held / (1 - held)) * BINS).alias("bin"))
        .agg(
            F.min("_score").alias("least"),
            F.max("_score").alias("most"),
            F.count_if(F.col("_toxic") > 0).alias("toxic"),
            F.count(F.lit(1)).alias("rows"),
        )
        .toArrow()
    )
    language = found["_language"].to_numpy()
    columns = [found[c].to_numpy() for c in ("bin", "least", "most", "toxic", "rows")]
    toxic, rows = columns[3:]
    if toxic.sum() == 0 or toxic.sum() == rows.sum():
        return network
    network.thresholds = np.full(len(LANGUAGES), _best_threshold(*columns))
    for k in range(len(LANGUAGES)):
        own = language == k
        if toxic[own].sum() >= 20 and (rows - toxic)[own].sum() >= 20:
            network.thresholds[k] = _best_threshold(*(c[own] for c in columns))
    return network


def _fold(id_col: str) -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(FOLDS)), F.lit(0))


def fit(documents: DataFrame, labels: DataFrame, sample_each: int = SAMPLE_EACH) -> Network:
    """A network trained and calibrated on all labelled rows but those of the held-out fold.

    One in ``CALIBRATED`` is kept back for the thresholds and scored whole in Spark's
    tasks, so only counts of its scores reach the driver.  The network starts on at most
    ``sample_each`` rows of either label, the first of the others by a hash of the id, as
    many as ``SAMPLE_BYTES`` take; one that alone exceeds that is kept back as well.  All
    that are left train it further, in tasks.  Without labelled rows the network scores
    all texts alike.
    """
    known = (
        labels.where("doc_id is not null and toxic is not null")
        .where(_fold("doc_id") != HELD_OUT)
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("_toxic"))
        .select(F.col("doc_id").alias("_label_id"), "_toxic")
    )
    order = [F.xxhash64("_label_id"), "_label_id"]
    first = (
        known.where("_toxic > 0").orderBy(*order).limit(sample_each)
        .unionAll(known.where("_toxic <= 0").orderBy(*order).limit(sample_each))
        .select(F.col("_label_id").alias("_first_id"))
    )
    chosen = known.join(F.broadcast(first), F.col("_label_id") == F.col("_first_id"), "left").select(
        "_label_id", "_toxic", F.col("_first_id").isNotNull().alias("_first")
    )
    if known.count() <= BROADCAST_ROWS:
        chosen = F.broadcast(chosen)
    texts = documents.select(F.col("doc_id").alias("_id"), F.col("text").cast("string").alias("_text"))
    rows = texts.join(chosen, F.col("_id") == F.col("_label_id")).select("_label_id", "_toxic", "_first", "_text")
    schema = StructType([*rows.select("_label_id", "_toxic", "_first").schema, StructField("_words", BinaryType())])

    def bucketed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in arrays.slices(batch, "_text"):
                words = words_of(arrays.filled(part["_text"]))
                each = np.split(words.buckets[words.codes].astype(np.int32), words.places[1:-1])
                columns = [part["_label_id"], part["_toxic"], part["_first"], pa.array([e.tobytes() for e in each], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    sample = store(documents.sparkSession, rows.mapInArrow(bucketed, schema), "labelled")
    ordered = sample.select(
        F.xxhash64("_label_id", F.lit("kept back")).alias("_kept"),
        F.xxhash64("_label_id").alias("_order"),
        F.octet_length("_words").alias("_size"),
        "_first",
        "_toxic",
        "_words",
    )
    kept_back = (F.pmod("_kept", F.lit(CALIBRATED)) == 0) | (F.col("_size") > SAMPLE_BYTES)
    # an id may stand for several rows: bounded all the same
    sizes = ordered.where(~kept_back & F.col("_first")).groupBy("_order").agg(F.sum("_size").alias("_size"))
    total, last = 0, None
    for row in sizes.orderBy("_order").limit(2 * sample_each).collect():
        total += row["_size"]
        if total > SAMPLE_BYTES and last is not None:
            break
        last = row["_order"]
    starting = F.coalesce(F.col("_first") & (F.col("_order") <= F.lit(last).cast("bigint")), F.lit(False))
    training = ordered.where(~kept_back & starting).orderBy("_order", F.xxhash64("_words"))
    found = training.select("_toxic", "_words").limit(2 * sample_each).toArrow()
    network = train(_buckets(found["_words"]), (found["_toxic"].to_numpy() > 0).astype(np.int64))
    further = ordered.where(~kept_back & ~starting).select((F.col("_toxic") > 0).cast("int").alias("_toxic"), "_words")
    if not further.isEmpty():
        network = train_further(network, further)
    network.squares = {}

    def judged(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in arrays.slices(batch, "_words"):
                words = _joined(_buckets(part["_words"]))
                values = [part["_toxic"], pa.array(network.scores(words).astype(np.float64)), pa.array(languages(words))]
                yield pa.RecordBatch.from_arrays(values, ["_toxic", "_score", "_language"])

    scored = (
        ordered.where(kept_back)
        .select(F.col("_toxic").cast("int").alias("_toxic"), "_words")
        .mapInArrow(judged, "_toxic int, _score double, _language bigint")
    )
    network = calibrate(network, scored)
    discard(sample)
    return network


def _buckets(words: pa.Array | pa.ChunkedArray) -> list[np.ndarray]:
    """Each text's words as rows of buckets."""
    return [np.frombuffer(w.as_buffer(), np.int32).reshape(-1, 1 + len(PREFIXES)) for w in words]


def _joined(buckets: list[np.ndarray]) -> Words:
    """Texts known by their buckets only, as ``Words``."""
    places = np.concatenate([[0], np.cumsum([len(b) for b in buckets])]).astype(np.int64)
    flat = np.concatenate(buckets) if buckets else np.zeros((0, 1 + len(PREFIXES)), np.int32)
    function = [np.isin(flat[:, 0], _hashes(pa.array(w.split()))) for w in FUNCTION_WORDS.values()]
    return Words(np.arange(len(flat)), places, flat, np.column_stack(function))


def toxicity(
    documents: DataFrame, network: Network, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id_col, score, predicted`` of every document, from its whole text alone.

    NULL and empty texts have no words and score what the output's offset says.
    Repeated rows each get their row, ids may be NULL, other columns are ignored.
    """
    source = documents.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    schema = StructType(
        [
            StructField(id_col, source.schema["_id"].dataType),
            StructField("score", DoubleType()),
            StructField("predicted", IntegerType()),
        ]
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in arrays.slices(batch, "_text"):
                scores = network.calibrated(words_of(arrays.filled(part["_text"]))).astype(np.float64)
                values = [part["_id"], pa.array(scores), pa.array((scores >= THRESHOLD).astype(np.int32))]
                yield pa.RecordBatch.from_arrays(values, schema.names)

    return source.mapInArrow(run, schema)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``toxicity`` of ``documents`` by a network fitted on ``labels``."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    network = fit(documents, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = toxicity(documents, network)
    held_out = (_fold("doc_id") == HELD_OUT).cast(BooleanType())
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")
