"""Records to contacts: T3 to T7 and T12.

The extraction expressions are written straight into the generator.  Extracting into a
column first and filtering or exploding that column lets the optimizer push a copy of
the expression below the projection, and every regex runs again for it.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardex.functions.extraction import emails_sql, phones_sql

PROVENANCE = ["url", "warc_filename", "warc_record_id", "timestamp"]


def _email_rows(text: str) -> str:
    return (
        f"transform({emails_sql(text)}, x -> named_struct("
        f"'email', x, 'phone_number', cast(null as string), 'contact_type', 'email'))"
    )


def _phone_rows(text: str) -> str:
    return (
        f"transform({phones_sql(text)}, x -> named_struct("
        f"'email', cast(null as string), 'phone_number', x, 'contact_type', 'phone'))"
    )


_ROWS = {"email": _email_rows, "phone": _phone_rows}


def contact_rows_sql(text: str, types: Sequence[str] = ("email", "phone")) -> str:
    """SQL: ARRAY<STRUCT<email, phone_number, contact_type>> of a text's contacts."""
    return f"concat({', '.join(_ROWS[t](text) for t in types)})"


def records_with_contacts(records: DataFrame) -> DataFrame:
    """Provenance, ``emails`` and ``phone_numbers`` of records that have any."""
    found = (
        f"named_struct('emails', {emails_sql('content')},"
        f" 'phone_numbers', {phones_sql('content')})"
    )
    return records.select(
        *PROVENANCE,
        F.expr(
            f"inline(filter(array({found}),"
            " r -> size(r.emails) > 0 or size(r.phone_numbers) > 0))"
        ),
    )


def contacts(records: DataFrame, types: Sequence[str] = ("email", "phone")) -> DataFrame:
    """One row per contact (D3), reading the records once.

    Name the one type you need in ``types``: the other's patterns are then not run,
    which a filter on ``contact_type`` afterwards cannot achieve.
    """
    return records.select(*PROVENANCE, F.expr(f"inline({contact_rows_sql('content', types)})"))


def email_contacts(records: DataFrame) -> DataFrame:
    """T5: the e-mail rows."""
    return contacts(records, ["email"])


def phone_contacts(records: DataFrame) -> DataFrame:
    """The phone rows."""
    return contacts(records, ["phone"])


def union_contacts(first: DataFrame, second: DataFrame) -> DataFrame:
    """All rows of both, duplicates included."""
    return first.unionByName(second)
