"""The registered queries: every operator over whole tables.

Each takes (spark, folder of Parquet tables) and returns a DataFrame whose columns match
the query of the same name in ``plans.oracles``.
"""

import uuid
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cardex.functions import extract_emails, extract_phones, register_functions
from cardex.operators import contacts as C
from cardex.operators import buckets, costs, lookup, stats, tables, versions
from cardex.operators.enrich import enrich
from cardex.session import scratch_dir
from cardex.sources import archives, ledger, quarantine
from cardex.sources.tables import documents_as_records, pages_as_records
from cardex.streaming import harvest as H
from cardex.streaming import merged, stateful

STAMP = datetime(2024, 1, 1, tzinfo=timezone.utc)
CRAWL = "CRAWL-2024-01"
OTHER_CRAWL = "CRAWL-2024-02"
# The text writer names its files so; see ``write_archives``.
WRITTEN_SUFFIX = ".txt.gz"
# Stored bytes of a table for each archive that ``ledger_runs`` writes; texts take a few times as many.
ARCHIVED_BYTES = 16 * 1024 * 1024
CONTACT = ["url", "warc_record_id", "email", "phone_number", "contact_type"]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return documents_as_records(table(spark, folder, "documents"))


def pages(spark: SparkSession, folder: str) -> DataFrame:
    return pages_as_records(table(spark, folder, "pages"))


def all_records(spark: SparkSession, folder: str) -> DataFrame:
    return documents(spark, folder).unionByName(pages(spark, folder))


def enriched(spark: SparkSession, folder: str) -> DataFrame:
    return enrich(C.contacts(all_records(spark, folder)), STAMP, CRAWL)


# --- extraction ---


def extract_emails_documents(spark, folder):
    return table(spark, folder, "documents").select(
        "doc_id", F.explode(extract_emails("text")).alias("email")
    )


def extract_emails_pages(spark, folder):
    return table(spark, folder, "pages").select(
        "page_id", F.explode(extract_emails("html")).alias("email")
    )


def extract_phones_documents(spark, folder):
    return table(spark, folder, "documents").select(
        "doc_id", F.explode(extract_phones("text")).alias("phone_number")
    )


def extract_phones_pages(spark, folder):
    return table(spark, folder, "pages").select(
        "page_id", F.explode(extract_phones("html")).alias("phone_number")
    )


def extract_contacts_conversations(spark, folder):
    """The SQL functions, over a table of their own."""
    register_functions(spark)
    table(spark, folder, "conversations").createOrReplaceTempView("turns")
    return spark.sql(
        "SELECT role, count(*) AS turns,"
        " sum(size(extract_emails(text))) AS emails,"
        " sum(size(extract_phones(text))) AS phones"
        " FROM turns GROUP BY role"
    )


def sql_functions_documents(spark, folder):
    """U1 and U3 in SQL: addresses per source and domain."""
    register_functions(spark)
    table(spark, folder, "documents").createOrReplaceTempView("texts")
    return spark.sql(
        "SELECT source, email_domain(email) AS domain, count(*) AS emails"
        " FROM texts, LATERAL emails_of(texts.text)"
        " GROUP BY source, email_domain(email)"
    )


def sql_phones_pages(spark, folder):
    """U2 in SQL: numbers per page, pages without any included."""
    register_functions(spark)
    table(spark, folder, "pages").createOrReplaceTempView("html_pages")
    return spark.sql(
        "SELECT page_id, count(phone_number) AS phones, max(phone_number) AS greatest"
        " FROM html_pages LEFT JOIN LATERAL phones_of(html_pages.html) ON true"
        " GROUP BY page_id"
    )


def email_reject_rules(spark, folder):
    """Every document's text with addresses that meet every rule of T1."""
    d = F.lpad(F.col("doc_id").cast("string"), 7, "0")
    shapes = F.concat_ws(
        " ",
        "text",
        F.concat(F.lit("plain"), d, F.lit("@mail.example.com")),
        F.concat(F.lit("UPPER"), d, F.lit("@MAIL.EXAMPLE.COM")),
        F.concat(F.lit("icon"), d, F.lit("@2x.png")),
        F.concat(F.lit("photo"), d, F.lit("@site.JPG")),
        F.concat(F.lit("user"), d, F.lit("@host.example")),
        F.concat(F.lit("user"), d, F.lit("@host.test")),
        F.concat(F.lit("dots"), d, F.lit("@mail..example.com")),
        F.concat(F.lit("Twice"), d, F.lit("@x.org,twice"), d, F.lit("@X.org")),
    )
    return (
        table(spark, folder, "documents")
        .select("doc_id", shapes.alias("content"))
        .select("doc_id", F.explode(extract_emails()).alias("email"))
    )


def phone_length_rules(spark, folder):
    """Every document's text with numbers that meet every rule of T2."""
    d = F.lpad(F.col("doc_id").cast("string"), 10, "0")
    a, b, c = F.substring(d, 1, 3), F.substring(d, 4, 3), F.substring(d, 7, 4)
    shapes = F.concat_ws(
        ";",
        "text",
        F.concat(F.lit("+1 ("), a, F.lit(") "), b, F.lit("-"), c),
        F.concat_ws(".", a, b, c),
        F.concat(F.substring(d, 1, 5), F.lit(" "), F.substring(d, 6, 5)),
        F.concat(F.lit("+1"), F.substring(d, 8, 3)),
        F.concat(F.lit("+"), a, F.lit("-"), c, F.lit("-"), c, F.lit("-99"), b, c),
        F.concat(F.lit("("), c, F.lit(") "), a, F.lit("-"), b, F.lit("-"), c),
    )
    return (
        table(spark, folder, "documents")
        .select("doc_id", shapes.alias("content"))
        .select("doc_id", F.explode(extract_phones()).alias("phone_number"))
    )


# --- contacts ---


def records_with_contacts(spark, folder):
    return C.records_with_contacts(documents(spark, folder)).select(
        "url",
        "warc_record_id",
        F.size("emails").cast("bigint").alias("emails"),
        F.size("phone_numbers").cast("bigint").alias("phones"),
    )


def email_contacts(spark, folder):
    return C.email_contacts(documents(spark, folder)).select(CONTACT)


def phone_contacts(spark, folder):
    return C.phone_contacts(documents(spark, folder)).select(CONTACT)


def contacts(spark, folder):
    return C.contacts(all_records(spark, folder)).select("warc_filename", *CONTACT)


def contacts_union(spark, folder):
    records = all_records(spark, folder)
    return C.union_contacts(C.email_contacts(records), C.phone_contacts(records)).select(
        "warc_filename", *CONTACT
    )


def contacts_enriched(spark, folder):
    return enriched(spark, folder).select(
        *CONTACT, "domain", "extraction_date", "source_crawl"
    )


# --- statistics ---


def contact_type_counts(spark, folder):
    return stats.contact_type_counts(C.contacts(all_records(spark, folder)))


def domain_stats(spark, folder):
    return stats.domain_stats(enriched(spark, folder))


def domain_stats_merged(spark, folder):
    """Partials per origin, merged; equals the counters of ``domain_stats``."""
    partials = stats.domain_partials(enriched(spark, folder), "warc_filename")
    return stats.merge_domain_partials(partials)


def run_metrics(spark, folder):
    return stats.run_metrics(enriched(spark, folder))


def observed_counts(spark, folder):
    """A1: rows counted while the snapshot is written, next to the stored rows."""
    records, seen = stats.counted(all_records(spark, folder), "records")
    found, kept = stats.counted(C.contacts(records), "contacts")
    path = tables.write_snapshot(found, scratch_dir(spark, "observed"), STAMP)
    return spark.read.parquet(path).agg(
        F.lit(seen.get["rows"]).cast("bigint").alias("records"),
        F.lit(kept.get["rows"]).cast("bigint").alias("contacts"),
        F.count(F.lit(1)).alias("stored"),
    )


# --- lookup ---


def categories(spark: SparkSession, folder: str) -> DataFrame:
    """A dimension with missing and duplicate domains, from suppliers and nations."""
    nation = table(spark, folder, "nation")
    return (
        table(spark, folder, "supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            F.concat(
                F.lit("mail"), (F.col("s_nationkey") * 2), F.lit(".example.com")
            ).alias("domain"),
            F.col("n_name").alias("category"),
            F.col("s_name").alias("subcategory"),
            (F.col("s_acctbal") > 0).cast("int").alias("is_business"),
            F.substring("n_name", 1, 2).alias("country_code"),
        )
    )


def contacts_with_category(spark, folder):
    joined = lookup.with_categories(enriched(spark, folder), categories(spark, folder))
    return joined.select(*CONTACT, "domain", *lookup.ATTRIBUTES)


def contacts_with_category_shuffled(spark, folder):
    """The same lookup the way it goes when the dimension is too large to broadcast."""
    path = tables.write_snapshot(
        enriched(spark, folder), scratch_dir(spark, "contacts"), STAMP
    )
    joined = lookup.with_categories(
        spark.read.parquet(path), categories(spark, folder), broadcast_bytes=-1
    )
    return joined.select(*CONTACT, "domain", *lookup.ATTRIBUTES)


def contacts_by_bucket(spark, folder):
    """J1, A2 over tables bucketed by domain: categories and statistics of every domain."""
    name, path = f"laid_{uuid.uuid4().hex}", scratch_dir(spark, "buckets")
    snapshot = tables.write_snapshot(enriched(spark, folder), scratch_dir(spark, "staged"), STAMP)
    buckets.store_by_domain(spark.read.parquet(snapshot), categories(spark, folder), name, path, 8)
    found = buckets.categorised(spark, name).groupBy("domain", *lookup.ATTRIBUTES).count()
    counted = buckets.domain_stats_by_bucket(spark, name)
    same = found["domain"].eqNullSafe(counted["domain"])
    return found.join(counted, same).select(
        found["domain"], *lookup.ATTRIBUTES, "count", "contact_count", "unique_urls"
    )


def category_counts(spark, folder):
    """Contacts per category of a stored dimension."""
    path = scratch_dir(spark, "categories")
    categories(spark, folder).write.parquet(path)
    dimension = lookup.read_categories(spark, path)
    joined = lookup.with_categories(enriched(spark, folder), dimension)
    return joined.groupBy("category", "contact_type").count()


# --- stored tables ---


def contacts_table_roundtrip(spark, folder):
    """Loaded twice as the same run, queried with SQL."""
    path = scratch_dir(spark, "table")
    snapshot = tables.write_snapshot(
        enriched(spark, folder), scratch_dir(spark, "staged"), STAMP
    )
    stored = spark.read.parquet(snapshot)
    for _ in range(2):
        tables.append_contacts(stored, path, overwrite_run=True)
    return tables.query_contacts(
        spark,
        path,
        "SELECT domain, email, phone_number, contact_type, ym, source_crawl,"
        " count(*) AS n, count(DISTINCT url) AS urls FROM contacts"
        " GROUP BY domain, email, phone_number, contact_type, ym, source_crawl",
    )


def parquet_snapshot_roundtrip(spark, folder):
    path = tables.write_snapshot(
        enriched(spark, folder), scratch_dir(spark, "snapshot"), STAMP, 8
    )
    return spark.read.parquet(path).select(*CONTACT, "domain", "extraction_date")


def contacts_table_in_catalog(spark, folder):
    """K2, O1: loaded under a catalog name, with its rows out of order in their file."""
    name, path = f"contacts_{uuid.uuid4().hex}", scratch_dir(spark, "table")
    snapshot = tables.write_snapshot(
        enriched(spark, folder), scratch_dir(spark, "staged"), STAMP
    )
    tables.create_contacts_table(spark, name, path)
    tables.append_contacts(spark.read.parquet(snapshot), path)
    spark.catalog.recoverPartitions(name)
    order = F.struct("domain", "email", "phone_number")
    previous = F.lag(order).over(Window.partitionBy("file").orderBy("row_index"))
    return (
        spark.table(name)
        .select("*", F.col("_metadata.file_path").alias("file"), "_metadata.row_index")
        .withColumn("unsorted", previous > order)
        .groupBy("ym", "source_crawl")
        .agg(F.count(F.lit(1)).alias("contacts"), F.count_if("unsorted").alias("unsorted"))
    )


def contacts_between_dates(spark, folder):
    """K4: contacts extracted in two of five months, of their folders only."""
    path, view = scratch_dir(spark, "months"), f"stored_{uuid.uuid4().hex}"
    later = F.expr("timestampadd(MONTH, cast(warc_record_id AS bigint) % 5, extraction_date)")
    snapshot = tables.write_snapshot(
        enriched(spark, folder).withColumn("extraction_date", later), scratch_dir(spark, "staged"), STAMP
    )
    tables.append_contacts(spark.read.parquet(snapshot), path)
    tables.read_contacts(spark, path).createOrReplaceTempView(view)
    tables.register_contacts_between(spark, view, f"between_{view}")
    return spark.sql(
        "SELECT ym, domain, contact_type, count(*) AS contacts"
        f" FROM between_{view}(TIMESTAMP'2024-02-01 00:00:00', TIMESTAMP'2024-04-01 00:00:00')"
        " GROUP BY ym, domain, contact_type"
    )


def contacts_versions(spark, folder):
    """K3, K1: three loads, the last replacing a month, and the table as of each."""
    path, staged = scratch_dir(spark, "versions"), scratch_dir(spark, "staged")
    snapshot = spark.read.parquet(tables.write_snapshot(enriched(spark, folder), staged, STAMP))
    later = F.lit(STAMP) + F.make_interval(months=F.lit(1))
    of_pages = snapshot.where("warc_filename = 'pages'")
    of_documents = snapshot.where("warc_filename = 'documents'")
    versions.load_version(of_pages, path, "pages")
    versions.load_version(of_documents.withColumn("extraction_date", later), path, "documents")
    versions.load_version(of_documents, path, "instead", replace_months=True)
    found = None
    for number in (1, 2, 3):
        state = (
            versions.read_version(spark, path, number)
            .groupBy(F.lit(number).alias("version"), "warc_filename", "ym", "contact_type")
            .agg(F.count(F.lit(1)).alias("contacts"), F.count_distinct("url").alias("urls"))
        )
        found = state if found is None else found.unionByName(state)
    return found


# --- archives and streams ---


def write_archives(records: DataFrame, segment: str) -> None:
    """Records as gzip archives of one segment, for the queries that read archives.

    Each response follows its request, as in real archives.  The text writer ends each
    line with the given separator, here the record trailer.
    """
    trailer = "\r\n\r\n"

    def record(kind: str, payload: Column) -> Column:
        return F.concat(
            F.lit(f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Target-URI: "),
            F.col("url"),
            F.lit("\r\nWARC-Record-ID: "),
            F.col("warc_record_id"),
            F.lit("\r\nWARC-Date: 2024-01-01T00:00:00Z\r\nContent-Length: "),
            F.octet_length(payload),
            F.lit("\r\n\r\n"),
            payload,
        )

    request = F.lit("GET / HTTP/1.1\r\nFrom: crawler@example.org\r\n\r\n")
    http = F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n")
    response = F.concat(http, F.coalesce("content", F.lit("")))
    pair = F.concat(record("request", request), F.lit(trailer), record("response", response))
    (
        records.select(pair.alias("value"))
        .write.option("lineSep", trailer)
        .option("compression", "gzip")
        .option("zlib.compress.level", "BEST_SPEED")
        .text(segment)
    )


def segment(root: str, number: int, crawl: str = CRAWL) -> str:
    return f"{root}/crawl-data/{crawl}/segments/{number}/warc"


def write_dirty_archives(spark: SparkSession, folder: str, segment: str) -> None:
    """Every page as a response with one of seven flaws that real archives have."""
    kind = F.col("page_id") % 7
    boundary = "\r\nWARC/1.0\r\nWARC-Type: response\r\n\r\n"
    size = F.lower(F.hex(F.octet_length("html")))
    body = (
        F.when(kind == 1, F.concat("html", F.lit(f"{boundary}after@boundary.org")).cast("binary"))
        .when(kind == 2, F.concat(size, F.lit("\r\n"), "html", F.lit("\r\n0\r\n\r\n")).cast("binary"))
        .when(kind == 3, F.concat(F.col("html").cast("binary"), F.lit(b"\xff\xfe"), F.lit(b"end")))
        .otherwise(F.col("html").cast("binary"))
    )
    encoding = F.when(kind == 2, "Transfer-Encoding: chunked\r\n").otherwise("")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\n"), encoding, F.lit("\r\n")).cast("binary")
    headers = F.concat(
        F.lit("WARC/1.0\r\n"),
        F.when(kind == 5, "").otherwise("WARC-Type: response\r\n"),
        F.when(kind == 4, "").otherwise(
            F.concat(F.lit("WARC-Target-URI: "), "url", F.lit("\r\nWARC-Record-ID: "), "page_id", F.lit("\r\n"))
        ),
        F.when(kind == 0, F.concat(F.lit("WARC-Filename: "), "page_id", F.lit(".warc.gz\r\n")))
        .when(kind == 6, "WARC-Filename: \r\n")
        .otherwise(""),
        F.lit("WARC-Date: 2024-01-01T00:00:00Z\r\nContent-Length: "),
        F.octet_length("payload"),
        F.lit("\r\n\r\n"),
    )
    (
        table(spark, folder, "pages")
        .withColumn("payload", F.concat(http, body))
        .select(F.concat(headers.cast("binary"), "payload").cast("string").alias("value"), F.lit(0).alias("part"))
        # by folder, as only then a first task without rows writes no empty archive
        .write.partitionBy("part")
        .option("lineSep", "\r\n\r\n")
        .option("compression", "gzip")
        .text(segment)
    )


def dirty_archive_records(spark, folder):
    """S2b to S2d: what is read from ``write_dirty_archives``."""
    root = scratch_dir(spark, "dirty")
    write_dirty_archives(spark, folder, segment(root, 0))
    found = archives.read_archives(
        spark, archives.archive_glob(root, CRAWL), suffix=WRITTEN_SUFFIX
    )
    # the writer's file names differ from run to run
    name = F.when(F.startswith("warc_filename", F.lit("part-")), "file").otherwise(F.col("warc_filename"))
    return found.select("url", name.alias("warc_filename"), "warc_record_id", "content", "timestamp")


def archive_records(spark, folder):
    root = scratch_dir(spark, "archives")
    write_archives(pages(spark, folder), segment(root, 0))
    write_archives(documents(spark, folder), segment(root, 1))
    found = archives.read_archives(
        spark, archives.archive_glob(root, CRAWL), suffix=WRITTEN_SUFFIX
    )
    return found.select("url", "warc_record_id", "content", "timestamp")


def archive_listing(spark, folder):
    """Records of all listed archives, of the first so many by path, of no crawl."""
    root = scratch_dir(spark, "archives")
    write_archives(pages(spark, folder), segment(root, 0))
    write_archives(documents(spark, folder), f"{segment(root, 1)}/deeper")

    def listed(crawl: str, limit: int | None = None) -> DataFrame:
        return archives.list_archives(spark, root, crawl, limit, WRITTEN_SUFFIX)

    def records(paths: str | list[str], number: int) -> DataFrame:
        read = archives.read_archives(spark, paths, suffix=WRITTEN_SUFFIX)
        return read.agg(F.lit(number).alias("listing"), F.count(F.lit(1)).alias("records"))

    in_first_segment = listed(CRAWL).where(F.contains("path", F.lit("/segments/0/"))).count()
    # as many as the limit, which is the feature
    first = [row.path for row in listed(CRAWL, in_first_segment).select("path").collect()]
    unknown = listed("UNKNOWN").agg(F.lit(2).alias("listing"), F.count(F.lit(1)).alias("records"))
    return (
        records(archives.archive_glob(root, CRAWL), 0)
        .unionByName(records(first, 1))
        .unionByName(unknown)
    )


def archive_report(spark, folder):
    """Totals over all archives; responses and requests in equal number."""
    root = scratch_dir(spark, "archives")
    write_archives(pages(spark, folder), segment(root, 0))
    write_archives(documents(spark, folder), segment(root, 1))
    report = archives.archive_report(
        spark,
        archives.list_archives(spark, root, CRAWL, suffix=WRITTEN_SUFFIX),
        archives.archive_glob(root, CRAWL),
        suffix=WRITTEN_SUFFIX,
    )
    return report.agg(*(F.sum(c).alias(c) for c in archives.REPORTED))


def archive_quarantine(spark, folder):
    """S2d, S2e: what was wrong in ``write_dirty_archives``, and totals, of one pass."""
    root, path = scratch_dir(spark, "dirty"), scratch_dir(spark, "pass")
    write_dirty_archives(spark, folder, segment(root, 0))
    quarantine.store_pass(
        quarantine.outcomes(spark, archives.archive_glob(root, CRAWL), suffix=WRITTEN_SUFFIX), path
    )
    files = archives.list_archives(spark, root, CRAWL, suffix=WRITTEN_SUFFIX)
    wrong = quarantine.rejected(spark, path, files).select(
        "reason", "kept", "url", "warc_record_id", F.lit(1).cast("bigint").alias("records")
    )
    totals = (
        quarantine.file_counts(spark, path, files)
        .agg(*(F.sum(c).alias(c) for c in quarantine.COUNTED))
        .unpivot([], quarantine.COUNTED, "reason", "records")
    )
    contacts = quarantine.pass_contacts(spark, path).agg(
        F.lit("contacts").alias("reason"), F.count(F.lit(1)).alias("records")
    )
    return wrong.unionByName(totals.unionByName(contacts), allowMissingColumns=True)


def _archives_for(spark: SparkSession, folder: str, name: str, least: int) -> int:
    """How many archives a table is written as: one for each ``ARCHIVED_BYTES`` stored."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    stored = files.load(f"{folder}/{name}.parquet").agg(F.sum("length")).first()[0]
    return max(least, -(-(stored or 0) // ARCHIVED_BYTES))


def ledger_runs(spark, folder):
    """L1: three runs with a limit, each taking the next archives; how often each record."""
    root, path = scratch_dir(spark, "archives"), scratch_dir(spark, "ledger")
    of_pages, of_documents = (_archives_for(spark, folder, n, k) for n, k in (("pages", 2), ("documents", 4)))
    write_archives(pages(spark, folder).repartition(of_pages), segment(root, 0))
    write_archives(documents(spark, folder).repartition(of_documents), segment(root, 1))
    # a third of the archives each
    limit = -(-(of_pages + of_documents) // 3)
    found = None
    for run in range(3):
        taken = ledger.next_archives(spark, root, CRAWL, path, limit, WRITTEN_SUFFIX).collect()
        if not taken:
            break
        paths = [row.path for row in taken]
        read = archives.read_archives(spark, paths, suffix=WRITTEN_SUFFIX)
        found = read if found is None else found.unionByName(read)
        ledger.finish(spark.createDataFrame(taken, archives.LISTING), path, f"run-{run}")
    left = ledger.next_archives(spark, root, CRAWL, path, limit, WRITTEN_SUFFIX).count()
    return found.groupBy("url", "warc_record_id").agg(
        F.count(F.lit(1)).alias("times"), F.lit(left).cast("bigint").alias("archives_left")
    )


def merged_batch_stats(spark, folder):
    """A3, ST2: twenty batches of contacts, merged in storage; equals ``domain_stats``."""
    path, staged = scratch_dir(spark, "merged"), scratch_dir(spark, "batches")
    number = F.pmod(F.xxhash64("warc_filename", "warc_record_id"), F.lit(20))
    enriched(spark, folder).withColumn("batch", number).write.partitionBy("batch").parquet(staged)
    batches = spark.read.parquet(staged)
    for batch in range(20):
        partials = stats.url_partials(batches.where(F.col("batch") == batch))
        merged.add_batch(partials, path, "stream", batch)
    return merged.merged_domain_stats(spark, path)


def _harvest_twice(spark: SparkSession, folder: str) -> tuple[str, str]:
    """Two runs on one checkpoint: pages, then also documents; then one with nothing new."""
    root = scratch_dir(spark, "archives")
    table_path = scratch_dir(spark, "harvest")
    stats_path = scratch_dir(spark, "stats")
    checkpoint = scratch_dir(spark, "checkpoint")
    arrivals = [pages(spark, folder), documents(spark, folder), None]
    for number, arrived in enumerate(arrivals):
        if arrived is not None:
            write_archives(arrived, segment(root, number))
        records = H.stream_archives(spark, root, CRAWL, suffix=WRITTEN_SUFFIX)
        H.harvest(
            records, CRAWL, table_path, checkpoint, STAMP, stats_path
        ).awaitTermination()
    return table_path, stats_path


def incremental_harvest(spark, folder):
    table_path, _ = _harvest_twice(spark, folder)
    return H.harvested_contacts(spark, table_path).select(
        *CONTACT, "domain", "ym", "source_crawl"
    )


def incremental_domain_stats(spark, folder):
    _, stats_path = _harvest_twice(spark, folder)
    return H.harvested_domain_stats(spark, stats_path)


def state_store_domain_stats(spark, folder):
    """ST2: three runs on one checkpoint; contacts of one URL come in several of them."""
    root, stats_path = scratch_dir(spark, "contacts"), scratch_dir(spark, "stats")
    checkpoint, arrivals = scratch_dir(spark, "checkpoint"), scratch_dir(spark, "arrivals")
    number = F.pmod(F.xxhash64("email", "phone_number", "warc_record_id"), F.lit(3))
    enriched(spark, folder).withColumn("run", number).write.partitionBy("run").parquet(root)
    stored = spark.read.parquet(root)
    for run in range(3):
        arrived = stored.where(F.col("run") == run).drop("run")
        arrived.write.mode("append").parquet(arrivals)
        stream = spark.readStream.schema(arrived.schema).parquet(arrivals)
        stateful.stream_stats(stream, stats_path, checkpoint).awaitTermination()
    return stateful.streamed_domain_stats(spark, stats_path)


def _harvest_two_crawls(spark: SparkSession, folder: str) -> tuple[str, str]:
    """Pages as one crawl and documents as another, each with its own checkpoint."""
    root = scratch_dir(spark, "archives")
    table_path = scratch_dir(spark, "harvest")
    stats_path = scratch_dir(spark, "stats")
    for crawl, arrived in ((CRAWL, pages(spark, folder)), (OTHER_CRAWL, documents(spark, folder))):
        write_archives(arrived, segment(root, 0, crawl))
        records = H.stream_archives(spark, root, crawl, suffix=WRITTEN_SUFFIX)
        checkpoint = scratch_dir(spark, "checkpoint")
        H.harvest(
            records, crawl, table_path, checkpoint, STAMP, stats_path
        ).awaitTermination()
    return table_path, stats_path


def incremental_two_crawls(spark, folder):
    table_path, _ = _harvest_two_crawls(spark, folder)
    return H.harvested_contacts(spark, table_path).select(*CONTACT, "domain", "ym", "source_crawl")


def incremental_two_crawl_stats(spark, folder):
    _, stats_path = _harvest_two_crawls(spark, folder)
    return H.harvested_domain_stats(spark, stats_path)


# --- costs ---


def job_runs(spark: SparkSession, folder: str) -> DataFrame:
    """A ledger with one run per user of ``events``; some sizes missing or unreadable."""
    kind = F.col("user_id") % 3
    return (
        table(spark, folder, "events")
        .groupBy("user_id")
        .agg(
            F.min("ts").cast("timestamp").alias("start_time"),
            F.max("ts").cast("timestamp").alias("last"),
            F.count_if(F.col("event_type") == "error").alias("errors"),
        )
        .select(
            F.concat(F.lit("run-"), "user_id").alias("job_run_id"),
            F.concat(F.lit("app-"), kind).alias("application_id"),
            F.when(F.col("errors") > 10, "FAILED").otherwise("SUCCESS").alias("state"),
            "start_time",
            F.when(kind != 1, F.col("last")).alias("end_time"),
            F.when(kind == 0, "8 vCPU").when(kind == 2, "large").alias("driver_cpu"),
            F.when(kind == 0, "32 GB").when(kind == 2, "").alias("driver_memory"),
            F.when(kind == 0, " 2 vCPU").when(kind == 2, "16").alias("executor_cpu"),
            F.when(kind == 0, "8 GB").when(kind == 2, "n/a").alias("executor_memory"),
            F.when(kind != 1, 5 + kind).cast("int").alias("executor_instances"),
        )
    )


COST_COLUMNS = [
    "driver_cpu_cost",
    "driver_memory_cost",
    "executor_cpu_cost",
    "executor_memory_cost",
    "total_cost",
]


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


def job_run_costs(spark, folder):
    now = F.lit(datetime(2024, 2, 1, tzinfo=timezone.utc))
    runs = costs.job_run_costs(job_runs(spark, folder), now)
    return _rounded(runs, "duration_seconds", "duration_hours", *COST_COLUMNS)


def job_run_cost_totals(spark, folder):
    now = F.lit(datetime(2024, 2, 1, tzinfo=timezone.utc))
    totals = costs.job_run_cost_totals(costs.job_run_costs(job_runs(spark, folder), now))
    return totals.withColumn("total_cost", F.col("total_cost").cast("double"))


def workloads(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes per document source, taken as that many megabytes."""
    return (
        table(spark, folder, "documents")
        .groupBy("source")
        .agg((F.sum(F.octet_length("text")) / 1000).alias("data_size_gb"))
    )


def estimated_costs(spark, folder):
    costed = costs.estimated_costs(workloads(spark, folder))
    return _rounded(costed, "data_size_gb", "estimated_hours", *COST_COLUMNS)


def sized_for_duration(spark, folder):
    costed = costs.sized_for_duration(workloads(spark, folder), 2.5)
    return _rounded(costed, "data_size_gb", *COST_COLUMNS)


QUERIES = {
    query.__name__: query
    for query in (
        extract_emails_documents,
        extract_emails_pages,
        extract_phones_documents,
        extract_phones_pages,
        extract_contacts_conversations,
        sql_functions_documents,
        sql_phones_pages,
        email_reject_rules,
        phone_length_rules,
        records_with_contacts,
        email_contacts,
        phone_contacts,
        contacts,
        contacts_union,
        contacts_enriched,
        contact_type_counts,
        domain_stats,
        domain_stats_merged,
        run_metrics,
        observed_counts,
        contacts_with_category,
        contacts_with_category_shuffled,
        category_counts,
        contacts_by_bucket,
        contacts_table_roundtrip,
        parquet_snapshot_roundtrip,
        contacts_table_in_catalog,
        contacts_between_dates,
        contacts_versions,
        archive_records,
        dirty_archive_records,
        archive_listing,
        archive_report,
        archive_quarantine,
        ledger_runs,
        merged_batch_stats,
        incremental_harvest,
        incremental_domain_stats,
        incremental_two_crawls,
        incremental_two_crawl_stats,
        state_store_domain_stats,
        job_run_costs,
        job_run_cost_totals,
        estimated_costs,
        sized_for_duration,
    )
}
