"""Archives read once, with what was wrong in them: S2d and S2e.

One scan yields a row for every contact and one for every record line, whatever the line
turned out to be; stored together, they are the good output, the rejected records with
file, offset and reason, and the counts of every file.  Nothing is read a second time.

Places count bytes of a file as it is when decompressed.  A gzip file is read by one
task, in order, and the Arrow function that repairs records adds up what it passes.  A
whole file ends with the empty line that ends each record; one that stops elsewhere was
cut short, be it between two records.
"""

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardex.operators.contacts import contact_rows_sql
from cardex.schemas import CONTACTS
from cardex.sources import archives as A
from cardex.storage import existing_table

_END = b"\r\n\r\n"

# Outcomes of a line.  The first two are good; of the others only ``incomplete`` records,
# which hold less than they declare, are kept.
RECORD, OTHER = "record", "other"
INCOMPLETE, NO_TYPE, TOO_LONG = "incomplete", "no type", "too long"
# Outcomes of a file.
UNREADABLE_FILE, CUT_SHORT = "unreadable file", "cut short"


def placing() -> Callable:
    """An Arrow function that fills ``offset`` and ``ends`` of the lines of whole files.

    ``ends`` is NULL but for the last line of a file: whether the file ends as it should.
    """
    gap, kept = len(A.BOUNDARY), len(A.BOUNDARY.strip())

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, at, last = None, 0, None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            paths = batch["file_path"].to_pylist()
            sizes = pc.binary_length(batch["raw"]).to_pylist()
            offsets, ends = [], [None] * len(paths)
            for k, (own, size) in enumerate(zip(paths, sizes)):
                if own != path:
                    if k:
                        ends[k - 1] = batch["raw"][k - 1].as_py().endswith(_END)
                    elif last is not None:
                        yield closed(last)
                        last = None
                    path, at = own, 0
                # a line begins behind the part of the boundary that is the record's
                offsets.append(max(at - kept, 0))
                at += size + gap
            if last is not None:
                yield last
            names = batch.schema.names
            columns = {name: batch[name] for name in names}
            columns["offset"] = pa.array(offsets, pa.int64())
            columns["ends"] = pa.array(ends, pa.bool_())
            filled = pa.RecordBatch.from_arrays([columns[n] for n in names], schema=batch.schema)
            if len(paths) > 1:
                yield filled.slice(0, len(paths) - 1)
            # whether its line is a file's last shows with the next batch
            last = filled.slice(len(paths) - 1)
        if last is not None:
            yield closed(last)

    def closed(row: pa.RecordBatch) -> pa.RecordBatch:
        ends = pa.array([row["raw"][0].as_py().endswith(_END)], pa.bool_())
        columns = [ends if n == "ends" else row[n] for n in row.schema.names]
        return pa.RecordBatch.from_arrays(columns, schema=row.schema)

    return place


def outcomes(
    spark: SparkSession,
    paths: str | list[str],
    suffix: str = A.ARCHIVE_SUFFIX,
    skip_bad_files: bool = True,
    skip_long_records: bool = True,
) -> DataFrame:
    """Every record line: ``file_path, offset, ends, outcome, kept`` and D1.

    ``offset`` is where the record begins in its decompressed file; ``content`` is NULL
    where the line is no response or not ``kept``.
    """
    place, repair = placing(), A.repairing(skip_long_records)
    lines = A.payload_bounds(A.read_lines(spark, paths, suffix, skip_bad_files)).withColumns(
        {"offset": F.lit(None).cast("bigint"), "ends": F.lit(None).cast("boolean")}
    )
    whole = lines.mapInArrow(lambda batches: repair(place(batches)), lines.schema)
    kind = A.record_type()
    outcome = (
        F.when(F.col("too_long"), TOO_LONG)
        .when(kind == "", NO_TYPE)
        .when(F.col("missing") > 0, INCOMPLETE)
        .when(kind == "response", RECORD)
        .otherwise(OTHER)
    )
    typed = whole.withColumn("headers", A.record_headers()).withColumns(
        {"outcome": outcome, "kept": (kind == "response") & ~F.col("too_long")}
    )
    lines = typed.where((F.length("headers") > 0) | F.col("ends").isNotNull())
    return A.record_columns(lines, "file_path", "offset", "ends", "outcome", "kept").withColumn(
        "content", F.when(F.col("kept"), F.col("content"))
    )


def store_pass(found: DataFrame, path: str) -> None:
    """Write the contacts and the outcomes of ``outcomes`` in one pass over the archives.

    Below ``path`` are then a folder of contacts and one with a row for each line.
    Bodies are not stored.
    """
    line = "array(named_struct('email', cast(null as string), 'phone_number', cast(null as string),"
    line += " 'contact_type', 'line'))"
    rows = found.select(
        *(c for c in found.columns if c != "content"),
        F.expr(f"inline(concat({line}, {contact_rows_sql('content')}))"),
    )
    kind = F.when(F.col("contact_type") == "line", "line").otherwise("contact")
    rows.withColumn("row", kind).write.partitionBy("row").parquet(path)


_LINES = (
    "file_path string, offset bigint, ends boolean, outcome string, kept boolean, url string,"
    " warc_filename string, warc_record_id string, timestamp string"
)


def pass_contacts(spark: SparkSession, path: str) -> DataFrame:
    """The contacts (D3) that a stored pass found."""
    return existing_table(spark, f"{path}/row=contact", CONTACTS)


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return existing_table(spark, f"{path}/row=line", _LINES)


def rejected(spark: SparkSession, path: str, files: DataFrame) -> DataFrame:
    """``file_path, offset, reason, kept, url, warc_record_id`` of all that was wrong.

    Records without a type or beyond what Spark holds are lost, incomplete responses
    kept.  A file that was cut short is told by its last record that could be read, one
    of ``files``, a listing, that gave nothing by offset 0.
    """
    lines = _lines(spark, path)
    columns = ["file_path", "offset", F.col("outcome").alias("reason"), "kept", "url", "warc_record_id"]
    records = lines.where(~F.col("outcome").isin(RECORD, OTHER)).select(*columns)
    cut = lines.where(~F.col("ends")).withColumn("outcome", F.lit(CUT_SHORT)).select(*columns)
    unread = files.select(F.col("path").alias("file_path"), A.same_path("path").alias("_path")).join(
        lines.select(A.same_path("file_path").alias("_path")), "_path", "left_anti"
    )
    nothing = F.lit(None).cast("string")
    return records.unionByName(cut).unionByName(
        unread.select(
            "file_path",
            F.lit(0).cast("bigint").alias("offset"),
            F.lit(UNREADABLE_FILE).alias("reason"),
            F.lit(False).alias("kept"),
            nothing.alias("url"),
            nothing.alias("warc_record_id"),
        )
    )


COUNTED = ["responses", "others", "incomplete", "unreadable", "too_long", "cut_short"]


def file_counts(spark: SparkSession, path: str, files: DataFrame) -> DataFrame:
    """What each listed file held, from a stored pass; zeros if nothing could be read.

    ``responses`` are the records kept, incomplete ones among them; ``cut_short`` is 1
    if the file ends before its end.
    """
    counts = _lines(spark, path).groupBy(A.same_path("file_path").alias("_path")).agg(
        F.count_if("kept").alias("responses"),
        F.count_if(F.col("outcome") == OTHER).alias("others"),
        F.count_if(F.col("outcome") == INCOMPLETE).alias("incomplete"),
        F.count_if(F.col("outcome") == NO_TYPE).alias("unreadable"),
        F.count_if(F.col("outcome") == TOO_LONG).alias("too_long"),
        F.count_if(~F.col("ends")).alias("cut_short"),
    )
    return (
        files.withColumn("_path", A.same_path("path"))
        .join(counts, "_path", "left")
        .drop("_path")
        .na.fill(0, COUNTED)
    )
