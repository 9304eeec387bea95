"""Web archive files as records: S1 to S4, L1.

The scan is Spark's text source with the record boundary as line separator, so an
archive streams through its task without being held whole; one gzip file is one task.
Header and body work is done by built-in expressions.

Two things need more than one line or a codec, and ``repaired`` sees to them for the
rare lines concerned: a body that itself contains a boundary (the record then
comes up short of its ``Content-Length`` and is put together again from the lines that
follow in the same task), and bodies stored with HTTP transfer or content encodings.
"""

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardex.schemas import LISTING
from cardex.sources import http_encodings
from cardex.sources.http_encodings import TooLong, undo_encodings

ARCHIVE_SUFFIX = ".warc.gz"
# How every record but a file's first begins, whatever its version; it contains no
# beginning of itself, which the line reader could miss between two buffers.
BOUNDARY = "\r\nWARC/"

_END_OF_HEADERS = "\r\n\r\n"
_ENCODED = (
    r"(?im)^(transfer-encoding[ \t]*:[ \t]*chunked|"
    r"content-encoding[ \t]*:[ \t]*(gzip|deflate))[ \t]*\r?$"
)
_MAX = 2**31 - 1

# Bytes of the longest value that Spark holds.
LONGEST_VALUE = 2**31 - 16
# Bytes of repaired records per Arrow batch, as many as Spark puts into one.
OUTPUT_BYTES = 64 * 1024 * 1024

# Columns of a line that tell of the end of its file, see ``sources.quarantine``.
LAST_LINE = ("ends",)

# Executors need not have this package installed for the repair.
cloudpickle.register_pickle_by_value(http_encodings)


def archive_glob(root: str, crawl_id: str) -> str:
    return f"{root.rstrip('/')}/crawl-data/{crawl_id}/segments/*/warc"


def list_archives(
    spark: SparkSession,
    root: str,
    crawl_id: str,
    limit: int | None = None,
    suffix: str = ARCHIVE_SUFFIX,
) -> DataFrame:
    """``path, length, modificationTime`` of a crawl's archives.

    All folders below the crawl's are listed and file contents are not read.  ``limit`` takes the first files by path; None or 0
    means all.  An unknown crawl has none.
    """
    reader = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", f"*{suffix}")
        .option("recursiveFileLookup", "true")
    )
    try:
        files = reader.load(archive_glob(root, crawl_id))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LISTING)
    files = files.select(LISTING.names)
    return files.orderBy("path").limit(limit) if limit else files


def read_archives(
    spark: SparkSession,
    paths: str | list[str],
    suffix: str = ARCHIVE_SUFFIX,
    repair: bool = True,
    skip_bad_files: bool = False,
    skip_long_records: bool = False,
) -> DataFrame:
    """The response records (D1) of archive files, folders or globs.

    A file that cannot be read, or not to its end, fails its task, which is retried,
    elsewhere if need be.  With ``skip_bad_files`` a file that is not gzip contributes
    nothing and a truncated one its readable records; Spark then skips the rest of a
    file after any read error, a passing one as well, so look at ``archive_report``.

    A record beyond the 2 GB that Spark holds as one value fails its task too, unless
    ``skip_long_records``; the report counts those.

    ``repair=False`` saves the Python hop of ``repaired`` where bodies are known to be
    stored plainly and not to contain a boundary.
    """
    lines = read_lines(spark, paths, suffix, skip_bad_files)
    return records_from_lines(lines, repair, skip_long_records)


def read_lines(
    spark: SparkSession,
    paths: str | list[str],
    suffix: str = ARCHIVE_SUFFIX,
    skip_bad_files: bool = False,
) -> DataFrame:
    return (
        spark.read.option("lineSep", BOUNDARY)
        .option("pathGlobFilter", f"*{suffix}")
        .option("recursiveFileLookup", "true")
        .option("ignoreCorruptFiles", str(skip_bad_files).lower())
        .text(paths)
    )


def records_from_lines(
    lines: DataFrame, repair: bool = True, skip_long_records: bool = False
) -> DataFrame:
    """Response records from a batch or streaming text scan split at the boundary."""
    located = payload_bounds(lines)
    return parse_records(repaired(located, skip_long_records) if repair else located)


def _header(name: str) -> Column:
    pattern = rf"(?im)^{name}[ \t]*:([^\r\n]*)"
    return F.trim(F.regexp_extract("headers", pattern, 1))


def payload_bounds(lines: DataFrame) -> DataFrame:
    """Lines as bytes (``raw``) with where their payload starts, its length and lack.

    ``missing`` is how much of the declared payload the line does not hold.
    """
    declared = _header("Content-Length").try_cast("bigint")
    held = F.octet_length("raw") - F.col("start")
    return (
        lines.select(
            F.col("_metadata.file_path").alias("file_path"),
            F.col("_metadata.file_name").alias("file_name"),
            F.col("value").cast("binary").alias("raw"),
        )
        .withColumn("headers", record_headers())
        .withColumn("start", F.octet_length("headers") + len(_END_OF_HEADERS))
        .select(
            "file_path",
            "file_name",
            "raw",
            "start",
            F.coalesce(declared, held.cast("bigint")).alias("length"),
            F.greatest(F.coalesce(declared - held, F.lit(0)), F.lit(0)).alias("missing"),
            _http_head(F.substring("raw", F.col("start") + 1, F.lit(_MAX)))
            .rlike(_ENCODED)
            .alias("encoded"),
            F.lit(False).alias("too_long"),
        )
    )


def repaired(located: DataFrame, skip_long_records: bool = False) -> DataFrame:
    """Split records joined and HTTP encodings undone; all other lines as they are.

    Lines of a file arrive in file order within one task.  A line lacking part of its
    payload takes in the following lines of its file until it is complete or the file
    ends: the declared length is taken at its word.  What exceeds ``LONGEST_VALUE``
    raises an error, or with ``skip_long_records`` keeps its headers only and is marked.
    """
    return located.mapInArrow(repairing(skip_long_records), located.schema)


def repairing(skip_long_records: bool = False) -> Callable:
    """The Arrow function of ``repaired``."""
    boundary, most = BOUNDARY.encode(), LONGEST_VALUE

    def repair(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict | None = None
        schema: pa.Schema | None = None
        for batch in batches:
            schema = batch.schema
            flags = pc.or_(pc.greater(batch["missing"], 0), batch["encoded"])
            flagged = pc.indices_nonzero(flags).to_pylist() + [batch.num_rows]
            done, size, at = [], 0, 0
            while at < batch.num_rows:
                if held is None and flagged[0] > at:
                    # untouched lines pass through as they came
                    if done:
                        yield pa.RecordBatch.from_pylist(done, schema)
                        done, size = [], 0
                    yield batch.slice(at, flagged[0] - at)
                    at = flagged[0]
                    continue
                (row,) = batch.slice(at, 1).to_pylist()
                if held is not None and row["file_path"] != held["file_path"]:
                    done.append(whole(held))
                    held = None
                    continue
                if held is None:
                    held = {**row, "parts": [], "bytes": 0}
                else:
                    held["missing"] -= len(boundary) + len(row["raw"])
                    held["bytes"] += len(boundary)
                    # of the columns that others add, what the last line says holds
                    held.update({name: row[name] for name in LAST_LINE if name in row})
                take(held, row["raw"])
                if held["missing"] <= 0:
                    done.append(whole(held))
                    held = None
                    size += len(done[-1]["raw"])
                at += 1
                while flagged[0] < at:
                    flagged.pop(0)
                if size > OUTPUT_BYTES:
                    yield pa.RecordBatch.from_pylist(done, schema)
                    done, size = [], 0
            if done:
                yield pa.RecordBatch.from_pylist(done, schema)
        if held is not None:
            yield pa.RecordBatch.from_pylist([whole(held)], schema)

    def refuse(row: dict) -> None:
        if not skip_long_records:
            raise ValueError(f"a record of {row['file_path']} exceeds {most} bytes")
        row["too_long"] = True

    def take(held: dict, raw: bytes) -> None:
        held["bytes"] += len(raw)
        if held["bytes"] > most and not held["too_long"]:
            refuse(held)
            held["parts"] = [held["parts"][0] if held["parts"] else raw]
        elif not held["too_long"]:
            held["parts"].append(raw)

    def whole(row: dict) -> dict:
        raw, start, length = boundary.join(row["parts"]), row["start"], row["length"]
        if row["encoded"] and not row["too_long"]:
            try:
                payload = undo_encodings(raw[start : start + length], most - start)
                raw, length = raw[:start] + payload, len(payload)
            except TooLong:
                refuse(row)
        if row["too_long"]:
            raw, length = raw[:start], 0
        missing = max(row["missing"], 0)
        return {**row, "raw": raw, "length": length, "missing": missing}

    return repair


def decoded(body: Column) -> Column:
    """Bytes as UTF-8 with the invalid ones dropped.

    ``make_valid_utf8`` marks invalid bytes with U+FFFD, which the text may also hold
    in its own right; those are written as U+FDD0 '1' meanwhile, and U+FDD0 as U+FDD0 '0'.
    """
    mark, escape = F.lit("�"), F.lit("﷐")
    text = body.cast("string")
    escaped = F.replace(
        F.replace(text, escape, F.lit("﷐0")), mark, F.lit("﷐1")
    )
    dropped = F.replace(F.make_valid_utf8(escaped), mark, F.lit(""))
    restored = F.replace(
        F.replace(dropped, F.lit("﷐1"), mark), F.lit("﷐0"), escape
    )
    return F.when(F.is_valid_utf8(text), text).otherwise(restored)


def record_headers() -> Column:
    return F.substring_index(F.col("raw").cast("string"), _END_OF_HEADERS, 1)


def _http_head(message: Column) -> Column:
    """What precedes the first empty line; ``substring_index`` compares bytes."""
    before_crlf = F.substring_index(message.cast("string"), "\n\r\n", 1)
    return F.substring_index(before_crlf, "\n\n", 1)


def _http_body(message: str) -> Column:
    """The body of an HTTP response; other payloads are all body.

    Offsets are found and cut in bytes, so invalid ones do no harm and the body is not
    walked.
    """
    text = F.col(message).cast("string")
    end = F.octet_length(_http_head(F.col(message)))
    empty_line = F.when(F.substring(message, end + 2, F.lit(1)) == b"\r", 3).otherwise(2)
    return F.when(
        F.startswith(text, F.lit("HTTP/")),
        F.substring(message, end + empty_line + 1, F.lit(_MAX)),
    ).otherwise(F.col(message))


def parse_records(located: DataFrame) -> DataFrame:
    """S2a to S2d: D1 columns of the response records among whole record lines.

    Lines without a readable type are dropped with the other record types.  A response
    without a target URI is kept, with a NULL url.
    """
    typed = located.withColumn("headers", record_headers())
    return record_columns(typed.where((record_type() == "response") & ~F.col("too_long")))


def record_type() -> Column:
    """The type of a record by its ``headers``; '' if they do not say."""
    return _header("WARC-Type")


def record_columns(responses: DataFrame, *kept: str) -> DataFrame:
    """D1 columns of whole lines with their ``headers``, behind the ``kept`` ones."""
    uri = F.regexp_replace(_header("WARC-Target-URI"), "^<(.*)>$", "$1")
    filename = _header("WARC-Filename")
    length = F.least("length", F.lit(_MAX)).cast("int")
    return (
        responses.select(
            *kept,
            F.nullif(uri, F.lit("")).alias("url"),
            F.when(filename != "", filename)
            .otherwise(F.col("file_name"))
            .alias("warc_filename"),
            F.nullif(_header("WARC-Record-ID"), F.lit("")).alias("warc_record_id"),
            F.substring("raw", F.col("start") + 1, length).alias("payload"),
            _header("WARC-Date").alias("timestamp"),
        )
        .withColumn("body", _http_body("payload"))
        .select(
            *kept,
            "url",
            "warc_filename",
            "warc_record_id",
            decoded(F.col("body")).alias("content"),
            "timestamp",
        )
    )


REPORTED = ["responses", "others", "incomplete", "unreadable", "too_long"]


def archive_report(
    spark: SparkSession,
    files: DataFrame,
    paths: str | list[str],
    suffix: str = ARCHIVE_SUFFIX,
) -> DataFrame:
    """What each listed file held: responses, other records, incomplete, unreadable and
    too long ones.

    ``files`` is a listing; a file that could not be read at all counts zero.  Bad files
    and long records do not fail the report.
    """
    lines = read_lines(spark, paths, suffix, skip_bad_files=True)
    lines = repaired(payload_bounds(lines), skip_long_records=True)
    kind = record_type()
    counts = (
        lines.withColumn("headers", record_headers())
        .groupBy(same_path("file_path").alias("_path"))
        .agg(
            F.count_if(kind == "response").alias("responses"),
            F.count_if((kind != "response") & (kind != "")).alias("others"),
            F.count_if((kind != "") & (F.col("missing") > 0)).alias("incomplete"),
            F.count_if((kind == "") & (F.length("headers") > 0)).alias("unreadable"),
            F.count_if("too_long").alias("too_long"),
        )
    )
    return (
        files.withColumn("_path", same_path("path"))
        .join(counts, "_path", "left")
        .drop("_path")
        .na.fill(0, REPORTED)
    )


def same_path(column: str) -> Column:
    """Spark's sources write local paths with one slash or three."""
    return F.regexp_replace(column, "^file:/+", "/")
