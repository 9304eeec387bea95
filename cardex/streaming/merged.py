"""Stored summing merge of per-batch counters: A3 for the incremental statistics of ST2.

A stream's counters per (domain, extraction_date, url) lie in folders of levels.  A batch
adds one folder; when a level has ``FANOUT`` of them, the batch that fills it sums them,
and every fuller level behind it, into one folder of the next level.  So after ``n``
batches a reader opens at most ``(FANOUT - 1) * (log_FANOUT(n) + 1)`` folders of a stream,
and a counter is rewritten once a level, not once a batch.

A manifest for each batch names the folders that hold all batches up to it.  It is made
from the manifest of the batch before and published last, as one file.  A crash at any
earlier point leaves folders that no manifest names; the repeated batch starts again from
the same manifest, so nothing is added twice, and readers see the state before or after,
never between.  The last manifests and their folders are kept for readers that are still
running and for reading an earlier state; older ones are deleted with each batch.
"""

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cardex.operators.stats import merge_url_partials, summed_url_partials
from cardex.schemas import URL_STATS
from cardex.storage import delete, names, publish, published

FANOUT = 4
KEPT_MANIFESTS = 4

_MANIFEST = (
    "stream string, batch bigint, attempt bigint,"
    " folders array<struct<path: string, level: int, first: bigint, last: bigint>>"
)


def _stream_path(path: str, stream: str) -> str:
    return f"{path.rstrip('/')}/harvest_stream={stream}"


def _manifests(spark: SparkSession, path: str, stream: str = "*") -> list[Row]:
    return published(spark, f"{_stream_path(path, stream)}/manifests", _MANIFEST)


def _latest(manifests: list[Row], before: int | None = None) -> Row | None:
    """The manifest of the greatest batch, of its attempts the last."""
    able = [m for m in manifests if before is None or m.batch < before]
    return max(able, key=lambda m: (m.batch, m.attempt), default=None)


def folders_to_merge(folders: list[Row], fanout: int) -> tuple[list[Row], int]:
    """Which folders a further one of level 0 is summed with, and the level it gets.

    Each level that becomes full moves to the next one, together with what moved before.
    """
    merged: list[Row] = []
    level = 0
    while True:
        same = [f for f in folders if f.level == level]
        if len(same) + 1 < fanout:
            return merged, level
        merged += same
        level += 1


def add_batch(
    partials: DataFrame,
    path: str,
    stream: str,
    batch: int,
    fanout: int = FANOUT,
    schema: StructType = URL_STATS,
    summed: Callable[[DataFrame], DataFrame] = summed_url_partials,
) -> None:
    """Publish a batch's ``url_partials`` as part of a stream's statistics.

    Batches of a stream come in order, from one writer, and a batch that is repeated
    replaces itself; both hold for the micro-batches of one checkpoint.  Other additive
    counters can be stored too, by their ``schema`` and the function that sums them.
    """
    spark = partials.sparkSession
    root = _stream_path(path, stream)
    manifests = _manifests(spark, path, stream)
    previous = _latest(manifests, before=batch)
    held = list(previous.folders) if previous else []
    merged, level = folders_to_merge(held, fanout)
    if merged:
        stored = spark.read.schema(schema).parquet(*(f"{root}/{f.path}" for f in merged))
        partials = summed(stored.unionByName(partials.select(schema.names)))
    name = f"level={level}/batch={batch:012d}-{uuid.uuid4().hex}"
    partials.hint("rebalance").write.parquet(f"{root}/{name}")
    first = min((f.first for f in merged), default=batch)
    folders = [f for f in held if f not in merged] + [(name, level, first, batch)]
    attempt = sum(m.batch == batch for m in manifests)
    publish(
        spark, f"{root}/manifests/batch={batch:012d}", (stream, batch, attempt, folders), _MANIFEST
    )
    _expire(spark, root, manifests, batch)


def _expire(spark: SparkSession, root: str, manifests: list[Row], batch: int) -> None:
    """Delete manifests before the last ones, and the folders that only those named."""
    old = [m for m in manifests if m.batch <= batch - KEPT_MANIFESTS]
    used = {f.path for m in manifests if m not in old for f in m.folders}
    for folder in {f.path for m in old for f in m.folders} - used:
        delete(spark, f"{root}/{folder}")
    for number in {m.batch for m in old}:
        delete(spark, f"{root}/manifests/batch={number:012d}")


def live_folders(
    spark: SparkSession, path: str, streams: list[str] | None = None, as_of: int | None = None
) -> list[str]:
    """Folders that hold the statistics of all streams, or of the named ones.

    ``as_of`` gives the state after that batch of every stream, if it is still kept.
    """
    by_stream: dict[str, list[Row]] = {}
    for manifest in _manifests(spark, path):
        by_stream.setdefault(manifest.stream, []).append(manifest)
    found = []
    for stream, manifests in sorted(by_stream.items()):
        latest = _latest(manifests, None if as_of is None else as_of + 1)
        if latest and (streams is None or stream in streams):
            found += [f"{_stream_path(path, stream)}/{f.path}" for f in latest.folders]
    return found


def merged_domain_stats(
    spark: SparkSession, path: str, streams: list[str] | None = None, as_of: int | None = None
) -> DataFrame:
    """Exact ``domain_stats`` of all published batches."""
    folders = live_folders(spark, path, streams, as_of)
    if not folders:
        return merge_url_partials(spark.createDataFrame([], URL_STATS))
    return merge_url_partials(spark.read.schema(URL_STATS).parquet(*folders))


def sweep(spark: SparkSession, path: str, stream: str) -> list[str]:
    """Delete what crashed attempts of a stream that is not running left; their names."""
    root = _stream_path(path, stream)
    used = {f.path for m in _manifests(spark, path, stream) for f in m.folders}
    levels = [n for n in names(spark, root) if n.startswith("level=")]
    left = [
        f"{level}/{n}" for level in levels for n in names(spark, f"{root}/{level}")
        if f"{level}/{n}" not in used
    ]
    for folder in left:
        delete(spark, f"{root}/{folder}")
    return left
