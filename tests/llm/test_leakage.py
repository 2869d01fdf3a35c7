"""Leakage against brute force and planted edited copies."""

from __future__ import annotations

import os
import random
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quern.llm import leakage
from tests.helpers import DATA

DOC, ITEM = "doc_id long, text string", "item_id long, text string"


def naive_sw(a, b):
    h = np.zeros((len(a) + 1, len(b) + 1), int)
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            h[i, j] = max(0, h[i - 1, j - 1] + (leakage.MATCH if a[i - 1] == b[j - 1] else leakage.MISMATCH), h[i - 1, j] + leakage.GAP, h[i, j - 1] + leakage.GAP)
    return int(h.max())


def naive_run(a, b):
    best = 0
    before = [0] * (len(b) + 1)
    for x in a:
        row = [0]
        for j, y in enumerate(b):
            row.append(before[j] + 1 if x == y else 0)
        best, before = max(best, max(row)), row
    return best


def found(spark, docs, items, **kw):
    return [r.asDict() for r in leakage.leaks(spark.createDataFrame(docs, DOC), spark.createDataFrame(items, ITEM), **kw).collect()]


def edited(rnd, text, rate, pool):
    out = []
    for c in text:
        kind = rnd.randrange(3) if rnd.random() < rate else 3
        out.append({0: rnd.choice(pool), 1: c + rnd.choice(pool), 2: "", 3: c}[kind])
    return "".join(out)


@pytest.mark.parametrize("hashes", [leakage.HASHES_SENT, 0])
def test_runs(spark, monkeypatch, hashes):
    monkeypatch.setattr(leakage, "HASHES_SENT", hashes)
    rnd = random.Random(7)
    letters = "招生计划线差表复核位次甲乙丙丁abCD12"
    text = lambda n: "".join(rnd.choices(letters, k=n))
    items = [(i, text(rnd.randrange(20, 120))) for i in range(12)] + [(50, None), (51, ""), (52, "，。")]
    docs = []
    for d in range(120):
        body = text(rnd.randrange(0, 200))
        if d % 2:
            src = items[rnd.randrange(12)][1]
            n = rnd.choice([38, 39, 40, 41, 60, 200])
            at = rnd.randrange(max(1, len(src) - n + 1))
            noisy = "".join(c + rnd.choice(["", "", "，", "\n", "\u200b", " "]) for c in src[at : at + n])
            body = body[:50] + noisy.upper() + body[50:]
        docs.append((d, body))
    docs += [(900, None), (901, ""), (902, text(60_000)), (903, items[0][1] * 3), (903, items[0][1] * 3)]
    d = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, item_id int")
    e = spark.createDataFrame([(i, t, "x") for i, t in [*items, items[0]]], "item_id long, text string, doc_id string")
    out = [r.asDict() for r in leakage.leaks(d, e).collect()]
    fold = {i: leakage.fold_text(t or "") for i, t in docs}, {i: leakage.fold_text(t or "") for i, t in items}
    runs = {(i, j): naive_run(t, s) for i, s in fold[0].items() for j, t in fold[1].items() if i != 902}
    got = {(r["doc_id"], r["item_id"]): r for r in out if r["doc_id"] != 902}
    assert {k for k, r in got.items() if r["run_length"] >= 40} == {k for k, n in runs.items() if n >= 40} and len(got) > 10
    assert all(r["run_length"] == runs[k] and r["score"] == naive_sw(fold[1][k[1]], fold[0][k[0]]) for k, r in got.items() if r["run_length"] >= 40)
    assert sum(r["doc_id"] == 903 and r["item_id"] == 0 for r in out) == 4  # two rows by two rows


def test_pieces(monkeypatch):
    """A long text taken in pieces gives the places of the whole."""
    rnd = random.Random(9)
    text = "".join(rnd.choices("甲乙丙丁abc12，ＡＢﬁ é", k=3000))
    codes = leakage.fold_batch([text])
    everything = {size: (np.full(1 << 15, 255, np.uint8), 18) for size in (0, 1, 5, 15)}
    h, at = leakage.found_places(codes, everything)
    for piece in (7, 100, 2999, 3000):
        monkeypatch.setattr(leakage, "PIECE", piece)
        h2, at2 = leakage.long_text_places(text, everything)
        assert sorted(zip(h.tolist(), at.tolist())) == sorted(zip(h2.tolist(), at2.tolist()))
        assert leakage.fold_texts([text]) == [leakage.fold_text(text)]


def test_edges(spark):
    d = spark.createDataFrame([], DOC)
    e = spark.createDataFrame([(1, "x" * 60)], ITEM)
    assert leakage.leaks(d, e).count() == 0
    assert leakage.leaks(e.select(F.col("item_id").alias("doc_id"), "text"), e.limit(0)).count() == 0
    with pytest.raises(ValueError):
        leakage.leaks(d, e, run=30)


def test_edited_copies(spark):
    """Scores are those of an alignment without a band; copies are found up to many edits."""
    rnd = random.Random(11)
    letters = [chr(c) for c in range(0x4E00, 0x5200)]
    items = [(i, "".join(rnd.choices(letters, k=rnd.randrange(90, 200)))) for i in range(40)]
    docs = [(i, "前" * 9 + edited(rnd, s, 0.1, letters) + "后" * 9) for i, s in items]
    got = {(r["doc_id"], r["item_id"]): r["score"] for r in found(spark, docs, items)}
    want = {(i, i): naive_sw(s, docs[i][1]) for i, s in items}
    assert all(want[k] == x for k, x in got.items())
    assert sum(k in got for k, x in want.items() if x >= leakage.EDITED_SHARE * 2 * len(items[k[0]][1])) >= 0.95 * len(items)


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
def test_recall(spark):
    """Of the test items, each copied once with a tenth of its characters edited, 0.9 and more are found."""
    rnd = random.Random(5)
    items = [tuple(r) for r in spark.read.parquet(f"{DATA}/eval_items.parquet").select("item_id", "text").collect()]
    around = [r[0] for r in spark.read.parquet(f"{DATA}/documents.parquet").select("text").where("length(text) > 200").limit(50).collect()]
    pool = "".join(t for _, t in items)
    docs = [(i, rnd.choice(around) + edited(rnd, t, 0.1, pool) + rnd.choice(around)) for i, t in items]
    got = {(r["doc_id"], r["item_id"]) for r in found(spark, docs, items)}
    assert sum((i, i) in got for i, _ in items) >= 0.9 * len(items)


def test_short_items_and_shifted_copies(spark):
    """Short items are found whole, copies with a long stretch put in or left out are scored as a whole."""
    rnd = random.Random(13)
    text = lambda n: "".join(chr(rnd.randrange(0x4E00, 0x5200)) for _ in range(n))
    items = [(n, text(n)) for n in (2, 5, 7, 8, 15, 23, 39)] + [(100, text(100)), (120, text(120)), (130, text(130)), (40, "ab1")]
    docs = [(i, text(30) + s + text(30)) for i, s in items if i < 100]
    a, b, c = (s for i, s in items if i >= 100)
    docs += [(100, text(9) + a[:50] + text(20) + a[50:] + text(9)), (120, text(9) + b[:50] + b[70:] + text(9)), (130, c[60:] + text(200) + c[:60])]
    got = {(r["doc_id"], r["item_id"]): r for r in found(spark, docs, items)}
    assert set(got) == {(i, i) for i, _ in items}
    assert {k: r["score"] for k, r in got.items()} == {(i, i): naive_sw(dict(items)[i], dict(docs)[i]) for i, _ in items}
    assert all(r["score_share"] == 1 for (i, _), r in got.items() if i < 100)


def test_long_item(spark):
    rnd = random.Random(2)
    book = "".join(rnd.choices("abcdefghij", k=20_000))
    got = found(spark, [(1, book[5000:5200]), (2, book[:12_000] + "z" * 30 + book[12_000:])], [(9, book)])
    assert {(r["doc_id"], r["run_length"]) for r in got} == {(1, 200), (2, 12_000)}


@settings(max_examples=100, deadline=None)
@given(st.text("甲乙ab1カ가", max_size=60), st.text("甲乙ab1カ가", max_size=20))
def test_gram_hashes(text, before):
    """An n-gram's hash and end hang on nothing but its own characters."""
    if not text:
        return
    own, ends = leakage.gram_hashes(leakage._codes(text))
    w = leakage.weights(leakage._codes(text))
    for i, e in enumerate(ends):
        assert w[i:e].sum() >= leakage.WEIGHT > w[i : e - 1].sum()
    assert len(ends) == sum(w[i:].sum() >= leakage.WEIGHT for i in range(len(text)))
    moved, _ = leakage.gram_hashes(leakage._codes(before + text))
    assert moved[len(moved) - len(own) :].tolist() == own.tolist() if len(own) else True
    for size in (1, 3):
        h = leakage.length_hashes(leakage._codes(text), size)
        by = defaultdict(set)
        for i, x in enumerate(h.tolist()):
            by[text[i : i + size]].add(x)
        assert all(len(v) == 1 for v in by.values()) and len({x for v in by.values() for x in v}) == len(by)


def test_bloom(spark):
    rnd = np.random.default_rng(1)
    inside, outside = rnd.integers(-(2**63), 2**63 - 1, 4000), rnd.integers(-(2**63), 2**63 - 1, 50_000)
    bitmap, bits = leakage.bloom(spark.createDataFrame([(int(x),) for x in [*inside, -1, 0, 2**63 - 1, -(2**63)]], "h long"), "h", 4004)
    m = np.frombuffer(bitmap, np.uint8)
    every = np.concatenate((inside, [-1, 0, 2**63 - 1, -(2**63)])).astype(np.int64)
    assert len(leakage._passes(every, m, bits)) == len(every)
    assert len(leakage._passes(outside, m, bits)) < 50


def test_fold_texts():
    texts = ["ＡＢｃ，，１２", "É é ﬁ㎝", "", "甲\u200b乙\n丙", "𝐀𝟏😀", "가각", "x\x01y", "Straße"]
    assert leakage.fold_texts(texts) == [leakage.fold_text(t.replace("\x01", " ")) for t in texts]


def test_align():
    rnd = random.Random(3)
    pairs, want = [], []
    for _ in range(30):
        a = "".join(rnd.choices("abcd", k=rnd.randrange(10, 30)))
        b = list(a)
        for _ in range(rnd.randrange(4)):
            k = rnd.randrange(len(b))
            b[k : k + 1] = rnd.choice([[], ["z"], [b[k], "y"]])
        pre = "".join(rnd.choices("efgh", k=rnd.randrange(20)))
        pairs.append((a, pre + "".join(b) + "efg", len(pre) - 12, len(pre) + 12))
        want.append(naive_sw(a, pre + "".join(b) + "efg"))
    assert leakage.align_between(pairs) == want and leakage.align_between([]) == []
