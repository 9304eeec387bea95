"""Fixed schemas of the inputs and stored tables."""

from pyspark.sql.types import (
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _strings(*names: str) -> list[StructField]:
    return [StructField(name, StringType()) for name in names]


# One archive record.
RECORDS = StructType(
    _strings("url", "warc_filename", "warc_record_id", "content", "timestamp")
)

# One archive file.
LISTING = StructType(
    [
        StructField("path", StringType()),
        StructField("length", LongType()),
        StructField("modificationTime", TimestampType()),
    ]
)

# D3: one contact; email xor phone_number.
CONTACTS = StructType(
    _strings(
        "url",
        "warc_filename",
        "warc_record_id",
        "timestamp",
        "email",
        "phone_number",
        "contact_type",
    )
)

# An enriched contact.
ENRICHED_CONTACTS = StructType(
    CONTACTS.fields
    + _strings("domain")
    + [StructField("extraction_date", TimestampType())]
)

# The stored contacts table, partitioned by its last two columns.
CONTACTS_TABLE = StructType(ENRICHED_CONTACTS.fields + _strings("ym", "source_crawl"))
TABLE_PARTITIONS = ("ym", "source_crawl")
TABLE_ORDER = ("domain", "email", "phone_number")

# The domain dimension and its source table.
DOMAIN_CATEGORIES = StructType(
    _strings("domain", "category", "subcategory")
    + [StructField("is_business", IntegerType())]
    + _strings("country_code")
)

# One run of a job.
JOB_RUNS = StructType(
    _strings("job_run_id", "application_id", "state")
    + [
        StructField("start_time", TimestampType()),
        StructField("end_time", TimestampType()),
    ]
    + _strings("driver_cpu", "driver_memory", "executor_cpu", "executor_memory")
    + [StructField("executor_instances", IntegerType())]
)

# Additive statistics of one (domain, extraction_date, url); see streaming.harvest.
URL_STATS = StructType(
    _strings("domain")
    + [StructField("extraction_date", TimestampType())]
    + _strings("url")
    + [
        StructField("contact_count", LongType()),
        StructField("email_count", LongType()),
        StructField("phone_count", LongType()),
    ]
)

# A2 as additive counters: what a batch adds to the statistics of a domain.
DOMAIN_STATS = StructType(
    _strings("domain")
    + [StructField("extraction_date", TimestampType())]
    + [
        StructField("contact_count", LongType()),
        StructField("email_count", LongType()),
        StructField("phone_count", LongType()),
        StructField("unique_urls", LongType()),
    ]
)
