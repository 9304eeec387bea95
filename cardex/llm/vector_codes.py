"""Operator 12: vectors as short codes, learnt by Lloyd rounds over active entries.

A vector's parts are coded by the nearest of a few entries of the part's codebook.
Components become integers, so all sums and distances are exact and a lost task gives
the same results again.  Each round keeps every part's entry and exact distance.  A
part whose entry did not move compares only the entries that did move with its stored
distance; only parts whose entry moved are compared with the whole codebook.  Entries
settle in all parts of a space early, so later rounds touch little.

A round is one Arrow pass that writes the vectors with their new state and, as rows of
the same files, each task's sums per entry; Spark adds up the sums, and only the new
codebooks (entries times components) pass through the driver.  Every round is stored in
the shared folder, which bounds the work that a lost executor costs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardex.llm import arrays
from cardex.llm.common import discard, store

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
# Components beyond this could overflow exact 64-bit sums.
LARGEST = 32_768.0
# Components handled at a time.
SLICE_COMPONENTS = 1 << 20
# Labels whose sums may be broadcast; more join by a shuffle, frequent ones apart.
BROADCAST_ROWS = 500_000
FREQUENT_LABELS = 10_000

_STATE = (
    "_id bigint, _label string, _parts array<int>, _codes array<tinyint>, _distances array<bigint>,"
    " _sums array<bigint>"
)


def bounds(size: int, parts: int) -> np.ndarray:
    """Where the parts of a vector begin and end; the first are longer if it must be."""
    return np.concatenate([[0], np.cumsum([size // parts + (k < size % parts) for k in range(parts)])])


def distances(vectors: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of every vector to every entry."""
    size = max(1, vectors.shape[1])
    largest = max(np.abs(vectors).max(initial=0), np.abs(entries).max(initial=0))
    if size * (2 * int(largest)) ** 2 < 1 << 53:
        # every term is an integer that a double holds
        v, e = vectors.astype(np.float64), entries.astype(np.float64)
        found = (v * v).sum(1)[:, None] - 2 * (v @ e.T) + (e * e).sum(1)[None, :]
        return found.astype(np.int64)
    wide = vectors.astype(np.int64)
    return np.stack([((wide - e) ** 2).sum(1) for e in entries.astype(np.int64)], axis=1)


def reassigned(
    vectors: np.ndarray, entries: np.ndarray, moved: np.ndarray, codes: np.ndarray, held: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entries and distances of one part, from those before some entries moved.

    ``codes`` and ``held`` are exact for the entries as they were.  Where the own entry
    stayed, no other entry that stayed can be nearer, so only moved ones are compared;
    the lower index wins a tie in either case.
    """
    codes, held = codes.copy(), held.copy()
    rescanned = moved[codes]
    active = np.flatnonzero(moved)
    if len(active) == 0:
        return codes, held
    if rescanned.any():
        found = distances(vectors[rescanned], entries)
        codes[rescanned] = found.argmin(1)
        held[rescanned] = found.min(1)
    stayed = np.flatnonzero(~rescanned)
    if len(stayed):
        found = distances(vectors[stayed], entries[active])
        best, nearest = found.min(1), active[found.argmin(1)]
        better = (best < held[stayed]) | ((best == held[stayed]) & (nearest < codes[stayed]))
        codes[stayed[better]], held[stayed[better]] = nearest[better], best[better]
    return codes, held


def _round(books: list[np.ndarray], moved: list[np.ndarray] | None, summed: bool):
    """An Arrow function: rows to rows with new codes, at the end one row of sums."""
    edges = np.concatenate([[0], np.cumsum([b.shape[1] for b in books])])
    size, parts, entries = int(edges[-1]), len(books), len(books[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # per entry: the sums of its components and, last, its vectors
        sums = [np.zeros((entries, b.shape[1] + 1), np.int64) for b in books]
        names = None
        for whole in batches:
            names, types = whole.schema.names, whole.schema
            step = max(1, SLICE_COMPONENTS // max(1, size))
            for first in range(0, whole.num_rows, step):
                batch = whole.slice(first, step)
                rows = batch.num_rows
                vectors = arrays.lists(batch["_parts"])[0].to_numpy().reshape(rows, size)
                codes = np.zeros((rows, parts), np.int64)
                held = np.zeros((rows, parts), np.int64)
                if moved is not None:
                    codes[:] = arrays.lists(batch["_codes"])[0].to_numpy().reshape(rows, parts)
                    held[:] = arrays.lists(batch["_distances"])[0].to_numpy().reshape(rows, parts)
                for p, book in enumerate(books):
                    own = vectors[:, edges[p] : edges[p + 1]]
                    if moved is None:
                        found = distances(own, book)
                        codes[:, p], held[:, p] = found.argmin(1), found.min(1)
                    else:
                        codes[:, p], held[:, p] = reassigned(own, book, moved[p], codes[:, p], held[:, p])
                    if summed:
                        order = np.argsort(codes[:, p], kind="stable")
                        used, starts = np.unique(codes[order, p], return_index=True)
                        sums[p][used, :-1] += np.add.reduceat(own[order].astype(np.int64), starts, axis=0)
                        sums[p][used, -1] += np.diff(np.append(starts, rows))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["_id"],
                        batch["_label"],
                        batch["_parts"],
                        _listed(codes.astype(np.int8), pa.int8()),
                        _listed(held, pa.int64()),
                        pa.nulls(rows, pa.list_(pa.int64())),
                    ],
                    names,
                )
        if names is not None and summed:
            total = np.concatenate([s.ravel() for s in sums])
            nothing = [pa.nulls(1, types.field(k).type) for k in range(3)]
            yield pa.RecordBatch.from_arrays(
                [
                    *nothing,
                    pa.nulls(1, pa.list_(pa.int8())),
                    pa.nulls(1, pa.list_(pa.int64())),
                    pa.array([total], pa.list_(pa.int64())),
                ],
                names,
            )

    return run


def _listed(values: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    rows, size = values.shape
    offsets = pa.array(np.arange(rows + 1, dtype=np.int32) * size)
    return pa.ListArray.from_arrays(offsets, pa.array(values.ravel(), kind))


def _new_books(state: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """The floored means of a round's sums; entries that no part uses stay."""
    found = (
        state.where("_sums is not null")
        .select(F.posexplode("_sums").alias("place", "amount"))
        .groupBy("place")
        .agg(F.sum("amount").alias("amount"))
        .collect()
    )
    total = np.zeros(sum(b.shape[0] * (b.shape[1] + 1) for b in books), np.int64)
    for row in found:
        total[row.place] = row.amount
    new, at = [], 0
    for book in books:
        entries, size = book.shape
        sums = total[at : at + entries * (size + 1)].reshape(entries, size + 1)
        at += entries * (size + 1)
        counts = sums[:, -1:]
        new.append(np.where(counts > 0, sums[:, :-1] // np.maximum(counts, 1), book))
    return new


def usable(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """``_id, _label, _parts`` of the rows that can be coded, with integer components."""
    value = f"cast({vector_col} as array<double>)"
    # NaN and the infinities are greater than any bound, as Spark orders NaN last
    fine = f"forall({value}, x -> x is not null and abs(x) <= {LARGEST})"
    return vectors.where(f"{vector_col} is not null and {fine}").select(
        F.col(id_col).cast("bigint").alias("_id"),
        F.col(label_col).cast("string").alias("_label"),
        # safe on rows that the filter drops, whichever is evaluated first
        F.expr(f"transform({value}, x -> if(abs(x) <= {LARGEST}, cast(floor({SCALE} * x) as int), null))").alias("_parts"),
    )


def vector_codes(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> tuple[DataFrame, list[np.ndarray]]:
    """``_id, _label, _codes, _distances`` of every kept vector, and the codebooks.

    ``_codes`` and ``_distances`` hold one element for each part, exact for the returned
    codebooks (one array of entries for each part).  Dropped are vectors that are NULL
    or hold a NULL, non-finite or, as sums could overflow, an absolute component above
    ``LARGEST``, and vectors not as long as that of the smallest id.  Of equal ids the
    smaller vector comes first; NULL ids come last.  With fewer vectors than entries the
    codebooks are as small as the table; repeated rows are vectors of their own.  An
    empty table gives no rows and no codebooks.  Lengths that the parts do not divide
    make the first parts longer by one.  Other columns are ignored.
    """
    if entries > 128:
        raise ValueError("codes are bytes: 128 entries at most")
    spark = vectors.sparkSession
    rows = usable(vectors, id_col, vector_col, label_col)
    order = [F.col("_id").asc_nulls_last(), F.col("_parts")]
    first = rows.orderBy(*order).limit(1).collect()
    size = len(first[0]._parts) if first else 0
    rows = rows.where(F.size("_parts") == size)
    seeds = np.array([r._parts for r in rows.orderBy(*order).limit(entries).collect()], np.int64)
    columns = [f.strip().split(" ")[0] for f in _STATE.split(",")]
    state = rows.select(
        *(F.col(c) if c in rows.columns else F.lit(None).cast(k).alias(c)
          for c, k in (f.strip().split(" ") for f in _STATE.split(",")))
    )
    if not first:
        return state.select(*columns[:2], *columns[3:5]).where("false"), []
    edges = bounds(size, parts)
    books = [seeds[:, a:b] for a, b in zip(edges[:-1], edges[1:])]
    moved = None
    for number in range(rounds + 1):
        summed = number < rounds
        before = state
        # a few bytes of codebooks travel with the function
        state = store(spark, state.where("_parts is not null").mapInArrow(_round(books, moved, summed), _STATE), "codes")
        if number:
            discard(before)
        if summed:
            new = _new_books(state, books)
            moved = [(a != b).any(1) for a, b in zip(new, books)]
            books = new
    return state.select(*columns[:2], *columns[3:5]), books


def books_text(books: list[np.ndarray]) -> str:
    """All entries' components by part, entry and position, comma-joined."""
    return ",".join(str(x) for book in books for x in book.ravel().tolist())


def with_label_error(coded: DataFrame) -> DataFrame:
    """``_id, _code, _error, _label_error`` of coded rows; NULL labels are one label.

    Errors are summed per label before they are shuffled.  Few labels are broadcast; of
    many, the frequent ones are, and the rest, none of them large, join by a shuffle.
    """
    spark = coded.sparkSession
    rows = coded.select(
        "_id",
        F.coalesce(F.concat(F.lit("="), "_label"), F.lit("")).alias("_key"),
        F.expr("lower(array_join(transform(_codes, c -> lpad(hex(c), 2, '0')), ''))").alias("_code"),
        F.expr("aggregate(_distances, 0L, (a, d) -> a + d)").alias("_error"),
    )
    sums = store(
        spark,
        rows.groupBy("_key").agg(F.sum("_error").alias("_label_error"), F.count(F.lit(1)).alias("_rows")),
        "label-errors",
    )
    size, total = sums.agg(F.count(F.lit(1)), F.sum("_rows")).first()
    columns = ["_id", "_code", "_error", "_label_error"]
    if size <= BROADCAST_ROWS:
        return rows.join(F.broadcast(sums), "_key").select(*columns)
    # at most FREQUENT_LABELS labels have so many rows
    often = F.broadcast(sums.where(F.col("_rows") > total // FREQUENT_LABELS))
    return (
        rows.join(often, "_key")
        .select(*columns)
        .unionByName(rows.join(often, "_key", "left_anti").join(sums, "_key").select(*columns))
    )


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's columns of ``vector_codes`` over ``embeddings``."""
    coded, books = vector_codes(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    digest = hashlib.sha256(books_text(books).encode()).hexdigest()
    return with_label_error(coded).select(
        F.col("_id").alias("vec_id"),
        F.col("_code").alias("code"),
        F.col("_error").alias("error"),
        F.col("_label_error").alias("label_error"),
        F.lit(digest).alias("codebooks_sha256"),
    )


def _oracle() -> str:
    """Plain Lloyd rounds as chained tables."""
    parts = f"""
  kept AS (
    SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label, embedding FROM embeddings
    WHERE embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
  flat AS MATERIALIZED (
    SELECT r, (place - 1) // (size // {PARTS}) AS part, (place - 1) % (size // {PARTS}) AS pos, x
    FROM (SELECT r, len(embedding) AS size, generate_subscripts(embedding, 1) AS place,
                 CAST(floor({SCALE} * CAST(unnest(embedding) AS DOUBLE)) AS BIGINT) AS x FROM kept)),
  book0 AS MATERIALIZED (SELECT part, r - 1 AS entry, pos, x FROM flat WHERE r <= {ENTRIES})"""
    for k in range(ROUNDS + 1):
        parts += f""",
  coded{k} AS MATERIALIZED (
    SELECT r, part, min_by(entry, (d, entry)) AS entry, min(d) AS d
    FROM (SELECT f.r, f.part, b.entry, CAST(sum((f.x - b.x) * (f.x - b.x)) AS BIGINT) AS d
          FROM flat f JOIN book{k} b USING (part, pos) GROUP BY ALL) GROUP BY r, part)"""
        if k < ROUNDS:
            parts += f""",
  book{k + 1} AS MATERIALIZED (
    SELECT part, entry, pos, coalesce(m.x, b.x) AS x FROM book{k} b LEFT JOIN (
      SELECT part, c.entry, pos,
             CAST((sum(f.x) - ((sum(f.x) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS x
      FROM flat f JOIN coded{k} c USING (r, part) GROUP BY ALL) m USING (part, entry, pos))"""
    return f"""
WITH {parts},
  whole AS (
    SELECT r, string_agg(printf('%02x', entry), '' ORDER BY part) AS code,
           CAST(sum(d) AS BIGINT) AS error FROM coded{ROUNDS} GROUP BY r)
SELECT vec_id, code, error,
       CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY part, entry, pos))
        FROM book{ROUNDS}) AS codebooks_sha256
FROM whole JOIN kept USING (r)
"""


OP12_SQL = _oracle()
