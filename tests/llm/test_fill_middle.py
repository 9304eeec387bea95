import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from cardex.llm import fill_middle
from cardex.llm.fill_middle import boundaries, fill_in_middle, fit, located, restored
from llm_data import documents, odd, odd_rows, prose  # noqa: F401


def plain(doc_id, text, cut=90, spm=20):
    text = text or ""
    tokens = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    n = len(tokens)
    code = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(code[8 * k : 8 * k + 8], 16) for k in range(4)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= cut:
        return doc_id, n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
    if h[3] % 100 < spm:
        return doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def check(spark, documents, rows, **options):
    done = fill_in_middle(documents(rows), **options).select("*", restored("output", "form").alias("text"))
    names = ("cut_percent", "spm_percent")
    expected = [
        (*plain(i, t, *(options.get(k, d) for k, d in zip(names, (90, 20)))), t or "") for i, t in rows
    ]
    assert odd(map(tuple, done.collect())) == odd(expected)


def test_odd_rows(spark, documents, odd_rows):
    check(spark, documents, odd_rows)


def test_texts_near_markers(spark, documents):
    parts = ["<", "P", ">", "<S", "S>", "M>", "<P", "<<", ">>", "<P>", "x", "é", "𝒳", " ", "\n"]
    choice = random.Random(5)
    rows = [(i, "".join(choice.choices(parts, k=choice.randrange(12)))) for i in range(2000)]
    check(spark, documents, rows)
    check(spark, documents, rows, cut_percent=100, spm_percent=50)


def test_long_texts(spark, documents, monkeypatch):
    mixed = " ".join(prose(k, 300) + "\n" + "w" * (37 * k % 3000) + "1234567890" * k for k in range(60))
    check(spark, documents, [(i, mixed[i * 1000 :]) for i in range(20)] + [(99, mixed * 40)])


@pytest.mark.parametrize("fitted", [1 << 19, 64])
def test_located_offsets_are_exact(monkeypatch, fitted):
    monkeypatch.setattr(fill_middle, "FITTED", fitted)
    random = np.random.default_rng(2)
    runs = [np.cumsum(random.integers(1, top, size)) for top, size in ((2, 5000), (12, 9000), (900, 3000), (9, 1))]
    runs.append(np.concatenate([np.arange(3000), 10**6 + np.arange(3000) * 7, 10**9 + np.arange(10)]))
    firsts = np.concatenate([[0], np.cumsum([len(r) for r in runs])])[:-1]
    offsets = np.concatenate(runs)
    index = fit(offsets, firsts)
    assert (located(index, np.arange(len(offsets))) == offsets).all()
    assert index.residuals.dtype == np.int8 and set(firsts) <= set(index.ranks)
    if fitted > 64:
        assert len(index.ranks) < len(offsets) / 5


def test_boundaries():
    texts = ["", "ab c", "é1", "", "x", "A\nb"]
    offsets, firsts = boundaries(pa.array(texts))
    at = 0
    for k, text in enumerate(texts):
        lengths = [len(t.encode()) for t in re.findall(r"[A-Za-z]+|[^A-Za-z]", text)]
        expected = at + np.concatenate([[0], np.cumsum(lengths)])
        assert offsets[firsts[k] : firsts[k + 1]].tolist() == expected.tolist()
        at += len(text.encode())


def test_empty_table(spark, documents):
    assert fill_in_middle(documents([(1, "x")]).where("false")).collect() == []
