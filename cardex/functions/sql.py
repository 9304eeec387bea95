"""The extraction functions under SQL names."""

from pyspark.sql import SparkSession

from cardex.functions.extraction import email_domain_sql, emails_sql, phones_sql


def register_functions(spark: SparkSession) -> None:
    """Create the SQL functions in the session.

    ``extract_emails``, ``extract_phones`` and ``email_domain`` are values: use them in a
    select list, count them, compare them.  Catalyst puts their bodies into the calling
    query, and copies them into every filter or generator that is built upon their
    result, where the extraction would run again.

    To get one row per contact use the table functions ``emails_of(text)`` and
    ``phones_of(text)``, which extract once::

        SELECT source, e.email FROM documents, LATERAL emails_of(documents.text) AS e

    ``LEFT JOIN LATERAL ... ON true`` keeps texts without a contact.
    """
    for name, returns, body in (
        ("extract_emails", "ARRAY<STRING>", emails_sql("text")),
        ("extract_phones", "ARRAY<STRING>", phones_sql("text")),
        ("email_domain", "STRING", email_domain_sql("text")),
    ):
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(text STRING)"
            f" RETURNS {returns} RETURN {body}"
        )
    for name, column, body in (
        ("emails_of", "email", emails_sql("text")),
        ("phones_of", "phone_number", phones_sql("text")),
    ):
        rows = f"transform({body}, x -> named_struct('{column}', x))"
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(text STRING)"
            f" RETURNS TABLE({column} STRING) RETURN SELECT inline({rows})"
        )
