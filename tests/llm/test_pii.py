import random
import re
import time

import plain
from cardex.llm import pii as P
from llm_data import documents, odd, odd_rows  # noqa: F401

TEXTS = [
    "mail a.b+c@x-y.example.org, bad@host, @x.y, a@b.c_d@e.f a@@b.c x@y.z.",
    "1.2.3.4 256.1.1.1 1.2.3.4.5.6.7.8 001.002.003.255 1..2.3.4 0000000000000000000001.1.1.1",
    "4539 1488 0343 6467 and 4539-1488-0343-6467, 4539148803436468, 79927398713, 12345678901234567890",
    "+1 (523) 555-1055 +44 20 7946 0958. +12 +1234567890123456 ++49 30 901820-11 +1 .-",
    "𝒳é a@b.cd 𝒳 10.0.0.1 " * 200,
    "1" * 20000 + " " + "a" * 20000 + "@" + "b." * 3000 + "c",
    "+" + "1 " * 3000,
]


def spans(found):
    return [(s.kind, s.start, s.end) for s in found]


def test_base_spans(spark, documents, odd_rows):
    choice = random.Random(3)
    noise = ["".join(choice.choices("0123456789.+-() @ab", k=60)) for _ in range(400)]
    rows = odd_rows + list(enumerate(TEXTS + noise, 1000))
    found = P.pii_spans(documents(rows)).collect()
    assert odd((r.doc_id, spans(r.base)) for r in found) == odd((i, plain.pii(t)) for i, t in rows)
    for row in found:
        assert [s for s in spans(row.spans) if s[0] in P.BASE] == spans(row.base)


def added(spark, documents, text):
    (row,) = P.pii_spans(documents([(1, text)])).collect()
    return [s.kind for s in row.spans if s.kind in P.ADDED]


def test_checksums_and_context(spark, documents):
    assert added(spark, documents, "IBAN DE89 3704 0044 0532 0130 00 please") == ["iban"]
    assert added(spark, documents, "GB82WEST12345698765432") == ["iban"]
    assert added(spark, documents, "IBAN DE88 3704 0044 0532 0130 00") == []
    assert added(spark, documents, "my SSN is 078-05-1120") == ["ssn"]
    assert added(spark, documents, "part 078-05-1120") == []
    assert added(spark, documents, "call (523) 555-1055 now") == ["national_phone"]
    assert added(spark, documents, "order 523-555-1055") == []


def test_account_numbers_end_where_their_country_says(spark, documents):
    number = "DE89 3704 0044 0532 0130 00"
    for text in (
        f"IBAN {number} BIC COBADEFFXXX",
        f"{number} EUR 500",
        f"{number} 2024",
        "DE89370400440532013000 2024",
        f"invoice order {number} part 7 version 2",
        f"{number} GB82 WEST 1234 5698 7654 32 A",
        f"GB11 {number}",
        "NO93 8601 1117 947 B",
        "MT84 MALT 0110 0001 2345 MTLC AST0 01S 2024-01-01",
    ):
        (row,) = P.pii_spans(documents([(1, text)])).collect()
        found = [s.value for s in row.spans if s.kind == "iban"]
        assert found and all(text[s.start : s.end] == s.value for s in row.spans)
        assert len(found) == 1 + (" GB82" in text)
        assert found[0] == (number if number in text else number.replace(" ", "") if "DE" in text else text.rsplit(" ", 1)[0])
    # a wrong number, one of another country's length, and one that goes on
    for text in (f"{number[:-1]}1 BIC", "GB89 3704 0044 0532 0130 0", "DE89370400440532013000x"):
        assert "iban" not in added(spark, documents, text)


def test_masking(spark, documents):
    rows = [(1, "to a@b.cd or 10.0.0.1!"), (2, None), (3, "clean")]
    assert sorted((r.doc_id, r.text) for r in P.masked(documents(rows)).collect()) == [
        (1, "to <email> or <ip>!"),
        (2, None),
        (3, "clean"),
    ]


def test_overlapping_spans_are_masked_as_one(spark, documents):
    text = "x a@1.2.3.4 y +1 4111 1111 1111 1111 z"
    (row,) = P.pii_spans(documents([(1, text)])).collect()
    covered = {p for s in row.spans for p in range(s.start, s.end)}
    assert len(row.spans) == 2
    (masked,) = P.masked(documents([(1, text)])).collect()
    left = "".join(c for p, c in enumerate(text) if p not in covered)
    assert re.sub("<[a-z_]+>", "", masked.text) == left


def test_time_grows_with_the_text(spark, documents):
    one = "mail a{0}@b.cd call 523-555-1055 card 4111 1111 1111 1111 DE89 3704 0044 0532 0130 00 ssn 123-45-6789; "

    def seconds(n):
        table = documents([(1, "".join(one.format(i) for i in range(n)))]).cache()
        table.count()
        start = time.perf_counter()
        (row,) = P.masked(table).selectExpr("length(text) AS size").collect()
        return time.perf_counter() - start, row.size

    seconds(100)
    (few, few_size), (many, many_size) = seconds(1000), seconds(4000)
    assert many_size == 4 * few_size
    # four times the text; quadratic work would take sixteen times
    assert many < 8 * few + 1


def test_empty_table_and_plan(spark, documents):
    found = P.pii_spans(documents([(1, "x")]).where("false"))
    assert found.collect() == []
    plan = found._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
