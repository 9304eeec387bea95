"""The registered queries in SQL for an independent engine (DuckDB).

They apply the fixed patterns as they stand, written out here once more so that a wrong
value in the library would show.  RE2 reads ``\\b``, ``\\d`` and ``\\s`` as
ASCII, which makes no difference on the given tables; text where it would is covered by
the unit tests instead.
"""

# What counts as a contact.
_EMAIL = r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b"
_EMAIL_ENDINGS = (".png", ".jpg", ".gif", ".example", ".test")
_EMAIL_PARTS = ("..", "@.", ".@")
_PHONES = (
    r"\+\d{1,3}\s?[-.\s]?\(?\d{1,4}\)?[-.\s]?\d{1,4}[-.\s]?\d{1,9}",
    r"\(?\d{3}\)?[-.\s]?\d{3}[-.\s]?\d{4}",
    r"\d{3}[-.\s]?\d{3}[-.\s]?\d{4}",
    r"\d{5}[-.\s]?\d{5,7}",
)
_PHONE_LENGTHS = (7, 15)

_DOCUMENTS = (
    "SELECT 'doc://' || source || '/' || doc_id AS url, 'documents' AS warc_filename,"
    " CAST(doc_id AS VARCHAR) AS warc_record_id, text AS content FROM documents"
)
_PAGES = (
    "SELECT url, 'pages' AS warc_filename,"
    " CAST(page_id AS VARCHAR) AS warc_record_id, html AS content FROM pages"
)
_ALL = f"{_DOCUMENTS} UNION ALL {_PAGES}"


def _emails(text: str) -> str:
    rejects = [f"lower(e) LIKE '%{x}'" for x in _EMAIL_ENDINGS]
    rejects += [f"contains(e, '{x}')" for x in _EMAIL_PARTS]
    found = f"regexp_extract_all(coalesce({text}, ''), '{_EMAIL}', 0)"
    return (
        f"list_distinct(list_transform(list_filter({found},"
        f" lambda e: NOT ({' OR '.join(rejects)})), lambda e: lower(e)))"
    )


def _phones(text: str) -> str:
    found = " || ".join(
        f"regexp_extract_all(coalesce({text}, ''), '{p}', 0)" for p in _PHONES
    )
    return (
        f"list_distinct(list_filter(list_transform({found},"
        f" lambda m: regexp_replace(m, '[^0-9+]', '', 'g')),"
        f" lambda p: length(p) BETWEEN {_PHONE_LENGTHS[0]} AND {_PHONE_LENGTHS[1]}))"
    )


def _contacts(records: str) -> str:
    """Common table expressions ending in ``enriched``."""
    return f"""
    WITH records AS ({records}),
    contacts AS (
        SELECT url, warc_filename, warc_record_id, unnest({_emails("content")}) AS email,
               CAST(NULL AS VARCHAR) AS phone_number, 'email' AS contact_type
        FROM records
        UNION ALL
        SELECT url, warc_filename, warc_record_id, CAST(NULL AS VARCHAR),
               unnest({_phones("content")}), 'phone'
        FROM records),
    enriched AS (
        SELECT *, CASE WHEN email IS NOT NULL THEN split_part(email, '@', 2) END AS domain,
               TIMESTAMP '2024-01-01 00:00:00' AS extraction_date,
               'CRAWL-2024-01' AS source_crawl
        FROM contacts)
    """


_CONTACT = "url, warc_record_id, email, phone_number, contact_type"

_STATS = """
    SELECT domain, extraction_date, count(*) AS contact_count,
           count(*) FILTER (contact_type = 'email') AS email_count,
           count(*) FILTER (contact_type = 'phone') AS phone_count,
           count(DISTINCT url) AS unique_urls
    FROM enriched GROUP BY domain, extraction_date
"""

_CATEGORIES = """,
    candidates AS (
        SELECT 'mail' || s_nationkey * 2 || '.example.com' AS domain, n_name AS category,
               s_name AS subcategory, CAST(s_acctbal > 0 AS INT) AS is_business,
               n_name[1:2] AS country_code
        FROM supplier JOIN nation ON s_nationkey = n_nationkey),
    categories AS (
        SELECT * FROM candidates
        QUALIFY row_number() OVER (PARTITION BY domain ORDER BY category DESC,
            subcategory DESC, is_business DESC, country_code DESC) = 1),
    categorised AS (
        SELECT e.*, coalesce(category, '') AS category,
               coalesce(subcategory, '') AS subcategory,
               coalesce(is_business, 0) AS is_business,
               coalesce(country_code, '') AS country_code
        FROM enriched e LEFT JOIN categories USING (domain))
"""
_CATEGORISED = f"""{_contacts(_ALL)} {_CATEGORIES}
    SELECT {_CONTACT}, domain, category, subcategory, is_business, country_code
    FROM categorised
"""

_RUNS = """
    WITH users AS (
        SELECT user_id, user_id % 3 AS kind, min(ts) AS start_time, max(ts) AS last,
               count(*) FILTER (event_type = 'error') AS errors
        FROM events GROUP BY user_id),
    runs AS (
        SELECT 'run-' || user_id AS job_run_id, 'app-' || kind AS application_id,
               CASE WHEN errors > 10 THEN 'FAILED' ELSE 'SUCCESS' END AS state,
               (epoch_us(CASE WHEN kind = 1 THEN TIMESTAMP '2024-02-01' ELSE last END)
                - epoch_us(start_time)) / CAST(1e6 AS DOUBLE) AS duration_seconds,
               CASE kind WHEN 0 THEN 8 ELSE 4 END AS driver_cpu,
               CASE kind WHEN 0 THEN 32 ELSE 16 END AS driver_memory,
               CASE kind WHEN 0 THEN 2 WHEN 2 THEN 16 ELSE 4 END AS executor_cpu,
               CASE kind WHEN 0 THEN 8 ELSE 16 END AS executor_memory,
               CASE kind WHEN 1 THEN 10 ELSE CAST(5 + kind AS INT) END
                   AS executor_instances
        FROM users),
    timed AS (SELECT *, duration_seconds / 3600 AS duration_hours FROM runs)
"""


def _costed(source: str, hours: str) -> str:
    return f"""
    parts AS (
        SELECT *,
            CAST(0.052 AS DOUBLE) * driver_cpu * {hours} AS driver_cpu_cost,
            CAST(0.0075 AS DOUBLE) * driver_memory * {hours} AS driver_memory_cost,
            CAST(0.052 AS DOUBLE) * executor_cpu * executor_instances * {hours}
                AS executor_cpu_cost,
            CAST(0.0075 AS DOUBLE) * executor_memory * executor_instances * {hours}
                AS executor_memory_cost
        FROM {source}),
    costed AS (
        SELECT *, driver_cpu_cost + driver_memory_cost + executor_cpu_cost
            + executor_memory_cost AS total_cost
        FROM parts)
    """


_COSTS = ", ".join(
    f"round({c}, 6) AS {c}"
    for c in (
        "driver_cpu_cost",
        "driver_memory_cost",
        "executor_cpu_cost",
        "executor_memory_cost",
        "total_cost",
    )
)
_SIZES = "driver_cpu, driver_memory, executor_cpu, executor_memory, executor_instances"
_WORKLOADS = """
    workloads AS (
        SELECT source, CAST(sum(strlen(text)) AS DOUBLE) / 1000 AS data_size_gb
        FROM documents GROUP BY source)
"""

_LPAD7, _LPAD10 = "lpad(CAST(doc_id AS VARCHAR), 7, '0')", "lpad(CAST(doc_id AS VARCHAR), 10, '0')"

_DIRTY = r"""
        SELECT CASE WHEN page_id % 7 <> 4 THEN url END AS url,
               CASE WHEN page_id % 7 = 0 THEN page_id || '.warc.gz' ELSE 'file' END
                   AS warc_filename,
               CASE WHEN page_id % 7 <> 4 THEN CAST(page_id AS VARCHAR) END AS warc_record_id,
               CASE page_id % 7
                   WHEN 1 THEN html || E'\r\nWARC/1.0\r\nWARC-Type: response\r\n\r\n'
                               || 'after@boundary.org'
                   WHEN 3 THEN html || 'end' ELSE html END AS content,
               '2024-01-01T00:00:00Z' AS timestamp
        FROM pages WHERE page_id % 7 <> 5"""

ORACLES = {
    "extract_emails_documents": f"SELECT doc_id, unnest({_emails('text')}) AS email"
    " FROM documents",
    "extract_emails_pages": f"SELECT page_id, unnest({_emails('html')}) AS email FROM pages",
    "extract_phones_documents": f"SELECT doc_id, unnest({_phones('text')}) AS phone_number"
    " FROM documents",
    "extract_phones_pages": f"SELECT page_id, unnest({_phones('html')}) AS phone_number"
    " FROM pages",
    "extract_contacts_conversations": f"""
        SELECT role, count(*) AS turns,
               CAST(sum(len({_emails("text")})) AS BIGINT) AS emails,
               CAST(sum(len({_phones("text")})) AS BIGINT) AS phones
        FROM conversations GROUP BY role""",
    "sql_functions_documents": f"""
        SELECT source, split_part(email, '@', 2) AS domain, count(*) AS emails
        FROM (SELECT source, unnest({_emails("text")}) AS email FROM documents)
        GROUP BY ALL""",
    "sql_phones_pages": f"""
        WITH found AS (SELECT page_id, {_phones("html")} AS p FROM pages)
        SELECT page_id, sum(len(p))::BIGINT AS phones, max(list_max(p)) AS greatest
        FROM found GROUP BY page_id""",
    "email_reject_rules": f"""
        WITH stressed AS (
            SELECT doc_id, concat_ws(' ', text, 'plain' || d || '@mail.example.com',
                'UPPER' || d || '@MAIL.EXAMPLE.COM', 'icon' || d || '@2x.png',
                'photo' || d || '@site.JPG', 'user' || d || '@host.example',
                'user' || d || '@host.test', 'dots' || d || '@mail..example.com',
                'Twice' || d || '@x.org,twice' || d || '@X.org') AS content
            FROM (SELECT *, {_LPAD7} AS d FROM documents))
        SELECT doc_id, unnest({_emails("content")}) AS email FROM stressed""",
    "phone_length_rules": f"""
        WITH stressed AS (
            SELECT doc_id, concat_ws(';', text, '+1 (' || a || ') ' || b || '-' || c,
                a || '.' || b || '.' || c, d[1:5] || ' ' || d[6:10], '+1' || d[8:10],
                '+' || a || '-' || c || '-' || c || '-99' || b || c,
                '(' || c || ') ' || a || '-' || b || '-' || c) AS content
            FROM (SELECT *, d[1:3] AS a, d[4:6] AS b, d[7:10] AS c
                  FROM (SELECT *, {_LPAD10} AS d FROM documents)))
        SELECT doc_id, unnest({_phones("content")}) AS phone_number FROM stressed""",
    "records_with_contacts": f"""
        WITH sized AS (
            SELECT url, warc_record_id, len({_emails("content")}) AS emails,
                   len({_phones("content")}) AS phones
            FROM ({_DOCUMENTS}))
        SELECT * FROM sized WHERE emails > 0 OR phones > 0""",
    "email_contacts": f"{_contacts(_DOCUMENTS)} SELECT {_CONTACT} FROM contacts"
    " WHERE contact_type = 'email'",
    "phone_contacts": f"{_contacts(_DOCUMENTS)} SELECT {_CONTACT} FROM contacts"
    " WHERE contact_type = 'phone'",
    "contacts": f"{_contacts(_ALL)} SELECT warc_filename, {_CONTACT} FROM contacts",
    "contacts_union": f"{_contacts(_ALL)} SELECT warc_filename, {_CONTACT} FROM contacts",
    "contacts_enriched": f"{_contacts(_ALL)}"
    f" SELECT {_CONTACT}, domain, extraction_date, source_crawl FROM enriched",
    "contact_type_counts": f"{_contacts(_ALL)}"
    " SELECT contact_type, count(*) AS count FROM contacts GROUP BY contact_type",
    "domain_stats": f"{_contacts(_ALL)} {_STATS}",
    "domain_stats_merged": f"{_contacts(_ALL)}"
    f" SELECT * EXCLUDE (unique_urls) FROM ({_STATS})",
    "run_metrics": f"""{_contacts(_ALL)}
        SELECT count(*) AS contact_count, count(email) AS email_count,
               count(phone_number) AS phone_count, count(DISTINCT url) AS unique_urls,
               count(DISTINCT domain) AS unique_domains,
               count(DISTINCT email) AS unique_emails,
               count(DISTINCT phone_number) AS unique_phones
        FROM enriched""",
    "observed_counts": f"""{_contacts(_ALL)}
        SELECT (SELECT count(*) FROM records) AS records, count(*) AS contacts,
               count(*) AS stored
        FROM contacts""",
    "contacts_with_category": _CATEGORISED,
    "contacts_with_category_shuffled": _CATEGORISED,
    "category_counts": f"""{_contacts(_ALL)} {_CATEGORIES}
        SELECT category, contact_type, count(*) AS count FROM categorised
        GROUP BY category, contact_type""",
    "contacts_by_bucket": f"""{_contacts(_ALL)} {_CATEGORIES}
        SELECT domain, category, subcategory, is_business, country_code, count(*) AS count,
               count(*) AS contact_count, count(DISTINCT url) AS unique_urls
        FROM categorised GROUP BY ALL""",
    "contacts_table_roundtrip": f"""{_contacts(_ALL)}
        SELECT coalesce(domain, '') AS domain, coalesce(email, '') AS email,
               coalesce(phone_number, '') AS phone_number, contact_type,
               strftime(extraction_date, '%Y%m') AS ym, source_crawl,
               count(*) AS n, count(DISTINCT url) AS urls
        FROM enriched GROUP BY ALL""",
    "parquet_snapshot_roundtrip": f"{_contacts(_ALL)}"
    f" SELECT {_CONTACT}, domain, extraction_date FROM enriched",
    "archive_records": f"""
        SELECT url, warc_record_id, content, '2024-01-01T00:00:00Z' AS timestamp
        FROM ({_ALL})""",
    "archive_listing": f"""
        SELECT 0 AS listing, count(*) AS records FROM ({_ALL})
        UNION ALL SELECT 1, count(*) FROM pages
        UNION ALL SELECT 2, 0""",
    "archive_report": f"""
        SELECT count(*) AS responses, count(*) AS others, CAST(0 AS BIGINT) AS incomplete,
               CAST(0 AS BIGINT) AS unreadable, CAST(0 AS BIGINT) AS too_long
        FROM ({_ALL})""",
    "dirty_archive_records": _DIRTY,
    "archive_quarantine": f"""{_contacts(_DIRTY)}
        SELECT 'no type' AS reason, false AS kept, url, CAST(page_id AS VARCHAR) AS warc_record_id,
               CAST(1 AS BIGINT) AS records
        FROM pages WHERE page_id % 7 = 5
        UNION ALL
        SELECT reason, NULL, NULL, NULL, CAST(records AS BIGINT) FROM (
            SELECT 'responses' AS reason, count(*) AS records FROM records
            UNION ALL SELECT 'unreadable', count(*) FROM pages WHERE page_id % 7 = 5
            UNION ALL SELECT unnest(['others', 'incomplete', 'too_long', 'cut_short']), 0
            UNION ALL SELECT 'contacts', count(*) FROM contacts)""",
    "ledger_runs": f"""
        SELECT url, warc_record_id, count(*) AS times, CAST(0 AS BIGINT) AS archives_left
        FROM ({_ALL}) GROUP BY ALL""",
    "merged_batch_stats": f"{_contacts(_ALL)} {_STATS}",
    "contacts_between_dates": f"""{_contacts(_ALL)}
        SELECT strftime(extracted, '%Y%m') AS ym, coalesce(domain, '') AS domain, contact_type,
               count(*) AS contacts
        FROM (SELECT *, extraction_date + to_months(CAST(CAST(warc_record_id AS BIGINT) % 5 AS INT))
                            AS extracted FROM enriched)
        WHERE extracted >= TIMESTAMP '2024-02-01' AND extracted < TIMESTAMP '2024-04-01' GROUP BY ALL""",
    "contacts_versions": f"""{_contacts(_ALL)},
        loads AS (
            SELECT v AS version, '202401' AS ym, e.*
            FROM enriched e, (VALUES (1), (2)) t(v) WHERE warc_filename = 'pages'
            UNION ALL
            SELECT v, '202402', e.* FROM enriched e, (VALUES (2), (3)) t(v)
            WHERE warc_filename = 'documents'
            UNION ALL
            SELECT 3, '202401', * FROM enriched WHERE warc_filename = 'documents')
        SELECT version, warc_filename, ym, contact_type, count(*) AS contacts,
               count(DISTINCT url) AS urls
        FROM loads GROUP BY ALL""",
    "contacts_table_in_catalog": f"""{_contacts(_ALL)}
        SELECT strftime(extraction_date, '%Y%m') AS ym, source_crawl,
               count(*) AS contacts, CAST(0 AS BIGINT) AS unsorted
        FROM enriched GROUP BY ALL""",
    "incremental_two_crawls": f"""{_contacts(_ALL)}
        SELECT url, warc_record_id, coalesce(email, '') AS email,
               coalesce(phone_number, '') AS phone_number, contact_type,
               coalesce(domain, '') AS domain, '202401' AS ym,
               CASE warc_filename WHEN 'pages' THEN 'CRAWL-2024-01' ELSE 'CRAWL-2024-02' END
                   AS source_crawl
        FROM enriched""",
    "incremental_two_crawl_stats": f"{_contacts(_ALL)}"
    f" SELECT * REPLACE (coalesce(domain, '') AS domain) FROM ({_STATS})",
    "state_store_domain_stats": f"{_contacts(_ALL)}"
    f" SELECT * REPLACE (coalesce(domain, '') AS domain) FROM ({_STATS})",
    "incremental_harvest": f"""{_contacts(_ALL)}
        SELECT url, warc_record_id, coalesce(email, '') AS email,
               coalesce(phone_number, '') AS phone_number, contact_type,
               coalesce(domain, '') AS domain, '202401' AS ym, source_crawl
        FROM enriched""",
    "incremental_domain_stats": f"{_contacts(_ALL)}"
    f" SELECT * REPLACE (coalesce(domain, '') AS domain) FROM ({_STATS})",
    "job_run_costs": f"""{_RUNS}, {_costed("timed", "duration_hours")}
        SELECT job_run_id, application_id, state,
               round(duration_seconds, 6) AS duration_seconds,
               round(duration_hours, 6) AS duration_hours, {_SIZES}, {_COSTS}
        FROM costed""",
    "job_run_cost_totals": f"""{_RUNS}, {_costed("timed", "duration_hours")}
        SELECT application_id, state, count(*) AS runs,
               CAST(sum(CAST(total_cost AS DECIMAL(28, 6))) AS DOUBLE) AS total_cost
        FROM costed GROUP BY application_id, state""",
    "estimated_costs": f"""
        WITH {_WORKLOADS}, hours AS (
            SELECT *, data_size_gb / 10 AS estimated_hours, 4 AS driver_cpu,
                   16 AS driver_memory, 4 AS executor_cpu, 16 AS executor_memory,
                   10 AS executor_instances
            FROM workloads),
        {_costed("hours", "estimated_hours")}
        SELECT source, round(data_size_gb, 6) AS data_size_gb,
               round(estimated_hours, 6) AS estimated_hours, {_SIZES}, {_COSTS}
        FROM costed""",
    "sized_for_duration": f"""
        WITH {_WORKLOADS}, needed AS (
            SELECT *, CAST(2.5 AS DOUBLE) AS estimated_hours,
                   CAST(floor(data_size_gb / 2.5) AS INT) + 1 AS n
            FROM workloads),
        sized AS (
            SELECT source, data_size_gb, estimated_hours, 4 AS driver_cpu,
                   16 AS driver_memory, CASE WHEN n > 20 THEN 8 ELSE 4 END AS executor_cpu,
                   CASE WHEN n > 20 THEN 32 ELSE 16 END AS executor_memory,
                   CASE WHEN n > 20 THEN least(n // 2 + 1, 50) ELSE n END
                       AS executor_instances
            FROM needed),
        {_costed("sized", "estimated_hours")}
        SELECT source, round(data_size_gb, 6) AS data_size_gb, estimated_hours,
               {_SIZES}, {_COSTS}
        FROM costed""",
}
