"""Operator 9: benchmark passages in documents, by a prefix-filtered set join.

A window of an item is a set of word shingles.  A document that contains the window
contains all of them, so one necessary shingle per window is enough to find every
candidate: the window's rarest in the corpus.  Documents' shingles join these prefix
shingles, bounds on position and length drop what cannot hold the window, and the words
themselves are compared at the end.

Splitting texts into words is what takes the time.  Where the hashes of all shingles may
be broadcast, one pass over the documents splits each once, counts its words and tells
those with as many of the shingles as a window has; the steps above read these alone.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from cardex.llm.common import KEY, ascii_lower, row_key, store, words_sql

# Each character by name: Java looks these up in a table, but compares with range by range.
WORD = "[^" + "".join(rf"\x{c:02X}" for c in range(128) if not chr(c).isalnum()) + "]+"
# Words of an item's window; items with fewer words are one window.
WINDOW = 10
# Words of a shingle; shorter windows are one shingle.
SHINGLE = 5
# Bytes of windows, or of their shingles' hashes, that may be broadcast; more are shuffled.
BROADCAST_BYTES = 32 * 1024 * 1024
# Bytes that a broadcast row takes beside its words.
ROW_BYTES = 64
# Keys of documents that may be broadcast; more of them join by a shuffle.
BROADCAST_ROWS = 200_000
# The same of their hashes, a BIGINT each.
BROADCAST_HASHES = 1_000_000


def _words(text: str) -> str:
    return words_sql(ascii_lower(text), WORD)


def item_windows(items: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """``_item, _window``: the words of every window of every item, each once."""
    whole = items.select(F.col(id_col).alias("_item"), F.expr(f"{_words(text_col)} as _words"))
    starts = f"if(size(_words) < {window}, array(0), sequence(0, size(_words) - {window}))"
    return (
        whole.where("size(_words) > 0")
        .select("_item", "_words", F.expr(f"explode_outer({starts}) as _start"))
        .select("_item", F.expr(f"slice(_words, _start + 1, {window}) as _window"))
        .distinct()
    )


def _hash_of(words: str, place: str, size: int) -> str:
    """SQL BIGINT: the hash of ``size`` words from ``place`` on."""
    return f"xxhash64({', '.join(f'{words}[{place} + {k}]' for k in range(size))})"


def _hash_of_any(words: str, place: str, sizes: Iterable[int]) -> Column:
    """The same where the column ``_size`` says how many words, one of ``sizes``."""
    *others, most = sizes
    found = F.expr(_hash_of(words, place, most))
    for size in others:
        found = F.when(F.col("_size") == size, F.expr(_hash_of(words, place, size))).otherwise(found)
    return found


def window_shingles(windows: DataFrame, shingle: int) -> DataFrame:
    """``_window, _offset, _size, _hash`` of all shingles of distinct windows."""
    size = f"least(size(_window), {shingle})"
    return (
        windows.select("_window")
        .distinct()
        .select(
            "_window",
            F.expr(f"{size} as _size"),
            F.expr(f"explode_outer(sequence(0, size(_window) - {size})) as _offset"),
        )
        .select("_window", "_offset", "_size", _hash_of_any("_window", "_offset", range(1, shingle + 1)).alias("_hash"))
    )


def document_shingles(words: DataFrame, sizes: list[int], whole: bool = False) -> DataFrame:
    """``words`` with a row for every shingle of each of ``sizes``: ``_pos, _size, _hash``.

    ``whole`` adds a row for the document itself, with NULL in these.
    """
    kinds = len(sizes)
    last = f"greatest(size(_words) - {min(sizes) - 1}, 0) * {kinds} - 1"
    none = "cast(array() as array<int>)"
    places = f"sequence(-1, {last})" if whole else f"if({last} < 0, {none}, sequence(0, {last}))"
    size = f"array({', '.join(map(str, sizes))})[_place % {kinds}]" if kinds > 1 else f"{sizes[0]}"
    shingles = (
        words.select("*", F.expr(f"explode_outer({places}) as _place"))
        .select("*", F.expr(f"if(_place >= 0, cast(_place div {kinds} as int), null) as _pos"))
        .select("*", F.expr(f"if(_place >= 0, {size}, null) as _size"))
    )
    if kinds > 1:
        shingles = shingles.where("_place < 0 or _pos + _size <= size(_words)")
    hashed = F.when(F.col("_place") >= 0, _hash_of_any("_words", "_pos", sizes))
    kept = shingles if whole else shingles.where("_place is not null")
    return kept.withColumn("_hash", hashed).drop("_place")


def necessary_shingles(words: DataFrame, shingles: DataFrame, sizes: list[int], small: bool) -> DataFrame:
    """``_window, _offset, _size, _hash``: of each window the shingle rarest in ``words``.

    Rarity is counted over all documents, partially before the shuffle.  A window with
    a shingle that no document has cannot occur and is left out.  ``small`` says that the
    hashes of ``shingles`` may be broadcast; otherwise they meet the counts where those are.
    """
    wanted = shingles.select("_size", "_hash").distinct()
    found = document_shingles(words.select("_words"), sizes).select("_size", "_hash")
    if small:
        found = found.join(F.broadcast(wanted), ["_size", "_hash"], "left_semi")
    frequency = found.groupBy("_size", "_hash").agg(F.count(F.lit(1)).alias("_count"))
    rarest = F.min(F.struct(F.coalesce("_count", F.lit(0)).alias("count"), "_offset", "_size", "_hash"))
    return (
        shingles.join(frequency, ["_size", "_hash"], "left")
        .groupBy("_window")
        .agg(rarest.alias("_rarest"))
        .where("_rarest.count > 0")
        .select("_window", "_rarest._offset", "_rarest._size", "_rarest._hash")
    )


def _candidates(words: DataFrame, prefixes: DataFrame, sizes: list[int]) -> DataFrame:
    """``words`` with ``_pos, _offset, _length, _window`` where a prefix shingle stands.

    Hashes and places alone are shuffled, the prefixes' side being too large to
    broadcast; the words join the few documents that hold one.
    """
    placed = document_shingles(words.select(KEY, "_words"), sizes).select(KEY, "_size", "_hash", "_pos")
    met = (
        placed.join(prefixes, ["_size", "_hash"])
        .select(F.col(KEY).alias("_met_key"), "_pos", "_offset", "_length", "_window")
        .distinct()
    )
    return words.join(met, F.col(KEY).eqNullSafe(F.col("_met_key")))


def _measured(windows: DataFrame, shingle: int) -> Row:
    """Bytes of the windows and of their shingles' hashes, sizes of shingles, fewest in a window."""
    hashes = F.greatest(F.size("_window") - shingle, F.lit(0)) + 1
    width = F.octet_length(F.array_join("_window", " ")) + 16 * F.size("_window") + ROW_BYTES
    return windows.select("_window").distinct().agg(
        F.sum(width).alias("windows"),
        (F.sum(hashes) * ROW_BYTES).alias("hashes"),
        F.collect_set(F.least(F.size("_window"), F.lit(shingle))).alias("sizes"),
        F.min(hashes).alias("fewest"),
    ).first()


def screened(
    documents: DataFrame,
    windows: DataFrame,
    text_col: str,
    shingle: int = SHINGLE,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> tuple[DataFrame, DataFrame]:
    """``_row_key, _n_words`` of every document, and the documents that may hold a window.

    A text is split into words once, for both.  A document without as many places of
    shingles as the window with the fewest holds none; the others are read again by the
    hashes of their keys (more than may be broadcast: by a shuffle) and stored.  Where the
    shingles' hashes are more than ``broadcast_bytes`` all documents are returned.
    """
    spark = documents.sparkSession
    measured = _measured(windows, shingle)
    words = documents.select(KEY, F.expr(f"{_words(text_col)} as _words"))
    if (measured.hashes or 0) > broadcast_bytes:
        return words.select(KEY, F.size("_words").alias("_n_words")), documents
    wanted = window_shingles(windows, shingle).select(F.col("_hash").alias("_wanted")).distinct()
    # by the hash alone: one of another size that is equal only keeps a document more
    seen = (
        document_shingles(words, sorted(measured.sizes) or [shingle], whole=True)
        .join(F.broadcast(wanted), F.col("_hash") == F.col("_wanted"), "left")
        .where("_pos is null or _wanted is not null")
        .select(KEY, F.when(F.col("_pos").isNull(), F.size("_words")).alias("_n_words"))
    )
    seen = store(spark, seen, "screened")
    met = (
        seen.where("_n_words is null")
        .groupBy(KEY)
        .agg(F.count(F.lit(1)).alias("_places"))
        .where(F.col("_places") >= (measured.fewest or 1))
        .select(F.xxhash64(KEY).alias("_met"))
        .distinct()
    )
    met = store(spark, met, "met", rows="count(1)")
    met = F.broadcast(met) if met.measures["rows"] <= BROADCAST_HASHES else met.hint("shuffle_hash")
    near = documents.join(met, F.xxhash64(KEY) == F.col("_met"), "left_semi").select(KEY, text_col)
    return seen.where("_n_words is not null"), store(spark, near, "near")


def occurrences(
    documents: DataFrame,
    windows: DataFrame,
    text_col: str,
    shingle: int = SHINGLE,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``_row_key, _pos, _length, _window``: every occurrence of a window in a document.

    The documents are read once to count shingles and once to find the windows.  What
    those passes join, the hashes of all shingles and then one necessary shingle with
    each window, is broadcast up to ``broadcast_bytes`` and shuffled by hash beyond, with
    a third pass for the words where a necessary shingle stands; no benchmark, however
    large, takes more.  The necessary shingles and the occurrences are stored, as each is
    read more than once.
    """
    shingles = window_shingles(windows, shingle)
    measured = _measured(windows, shingle)
    sizes = sorted(measured.sizes) or [shingle]
    words = documents.select(KEY, F.expr(f"{_words(text_col)} as _words"))
    spark = documents.sparkSession
    small = (measured.hashes or 0) <= broadcast_bytes
    prefixes = store(spark, necessary_shingles(words, shingles, sizes, small), "prefixes")
    prefixes = prefixes.select("_size", "_hash", "_offset", "_window", F.size("_window").alias("_length"))
    if (measured.windows or 0) <= broadcast_bytes:
        near = document_shingles(words, sizes).join(F.broadcast(prefixes), ["_size", "_hash"])
    else:
        near = _candidates(words, prefixes, sizes)
    start = F.col("_pos") - F.col("_offset")
    found = (
        near.where((start >= 0) & (start + F.col("_length") <= F.size("_words")))
        .where(F.expr("slice(_words, _pos - _offset + 1, _length) = _window"))
        .select(KEY, start.alias("_pos"), "_length", "_window")
    )
    return store(spark, found, "occurrences")


def contamination(
    documents: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    shingle: int = SHINGLE,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``id_col, n_words, n_hit, items, contaminated`` for every document.

    ``n_hit`` counts the words inside any occurrence of a window, ``items`` is the sorted
    array of the ids, as strings, of the items whose windows occur.  NULL and wordless
    texts have no words and are clean; wordless items have no window; items with equal
    windows are all named; an item without an id counts as a hit but cannot be named.
    Repeated rows each get their row, NULL ids too; other columns are ignored, and with
    no items every document is clean.
    """
    own = documents.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).withColumn(
        KEY, row_key("_id", "_text")
    )
    windows = item_windows(items, item_id_col, item_text_col, window)
    counted, near = screened(own, windows, "_text", shingle, broadcast_bytes)
    found = occurrences(near, windows, "_text", shingle, broadcast_bytes)
    named = windows.groupBy("_window").agg(F.collect_set(F.col("_item").cast("string")).alias("_items"))
    hits = "collect_set(named_struct('pos', _pos, 'length', _length))"
    covered = (
        "aggregate(sort_array(_spans), named_struct('upto', 0, 'n', 0), (acc, s) ->"
        " named_struct('upto', greatest(acc.upto, s.pos + s.length),"
        " 'n', acc.n + greatest(0, s.pos + s.length - greatest(acc.upto, s.pos)))).n"
    )
    spans = found.groupBy(KEY).agg(F.expr(f"{hits} as _spans"))
    which = (
        found.select(KEY, "_window")
        .distinct()
        .join(named, "_window")
        .select(KEY, F.explode_outer("_items").alias("_item"))
        .groupBy(KEY)
        .agg(F.sort_array(F.collect_set("_item")).alias("_items"))
        .withColumnRenamed(KEY, "_items_key")
    )
    per_document = (
        spans.join(which, spans[KEY].eqNullSafe(which["_items_key"]))
        .select(F.col(KEY).alias("_hit_key"), F.expr(f"{covered} as _hit"), "_items")
    )
    return (
        counted.join(per_document, F.col(KEY).eqNullSafe(F.col("_hit_key")), "left")
        .select(
            F.col(f"{KEY}.id").alias(id_col),
            F.col("_n_words").cast("bigint").alias("n_words"),
            F.expr("cast(coalesce(_hit, 0) as bigint) as n_hit"),
            F.expr("coalesce(_items, cast(array() as array<string>)) as items"),
            F.expr("coalesce(_hit, 0) > 0 as contaminated"),
        )
    )


def clean_documents(
    documents: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """The documents that hold no window of an item, with all their columns."""
    key = KEY
    while key in documents.columns:
        key += "_"
    searched = documents.select(row_key(id_col, text_col).alias(KEY), F.col(text_col).alias("_text"))
    windows = item_windows(items, item_id_col, item_text_col, window)
    _, near = screened(searched, windows, "_text")
    found = occurrences(near, windows, "_text").select(F.col(KEY).alias("_hit_key")).distinct()
    hit = store(documents.sparkSession, found, "contaminated")
    if hit.count() <= BROADCAST_ROWS:
        hit = F.broadcast(hit)
    own = documents.withColumn(key, row_key(id_col, text_col))
    return own.join(hit, own[key].eqNullSafe(hit["_hit_key"]), "left_anti").drop(key)


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's digest of ``contamination`` of ``documents`` by ``benchmark``."""
    found = contamination(
        spark.read.parquet(f"{sf_dir}/documents.parquet"),
        spark.read.parquet(f"{sf_dir}/benchmark.parquet"),
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.expr("cast(size(items) as bigint) as n_items"),
        F.expr("sha2(array_join(items, ','), 256) as items_sha256"),
        "contaminated",
    )


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
OP9_SQL = rf"""
WITH doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
item AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
item_window AS (
  SELECT item_id, least(len(w), 10) AS n,
         unnest([array_to_string(w[i:i + least(len(w), 10) - 1], ' ')
                 FOR i IN range(1, greatest(len(w) - 10, 0) + 2)]) AS words
  FROM item WHERE len(w) > 0),
lengths AS (SELECT DISTINCT n FROM item_window),
doc_window AS (
  SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS pos, w
  FROM doc, lengths WHERE len(w) >= n),
hit AS (
  SELECT d.doc_id, d.pos, d.n, i.item_id
  FROM (SELECT doc_id, n, pos, array_to_string(w[pos:pos + n - 1], ' ') AS words FROM doc_window) d
  JOIN item_window i ON i.n = d.n AND i.words = d.words),
hit_words AS (
  SELECT doc_id, count(*) AS n_hit
  FROM (SELECT DISTINCT doc_id, unnest(range(pos, pos + n)) AS place FROM hit) GROUP BY doc_id),
hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""
