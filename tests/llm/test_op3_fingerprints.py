import hashlib

import numpy as np

from polyscribe.llm.op3_fingerprints import PrefixHashes, common_extension, fingerprint_documents
from tests.llm.helpers import edge_rows, prose, table


def edited(text, following):
    k = len(text) // 2
    return text[: len(text) - k] + following[:k]


def check(spark, rows, **more):
    rows = [(d, t or "") for d, t in rows]
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))
    expected = sorted(((d, len(t), hashlib.sha256(edited(t, order[(i + 1) % len(order)][1]).encode()).hexdigest()) for i, (d, t) in enumerate(order)), key=repr)
    got = fingerprint_documents(table(spark, rows), **more).collect()
    assert sorted(((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got), key=repr) == expected
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)
    return got, order


def test_contract(spark):
    rows = [(i, prose(i, 5 + i * 3)) for i in range(60)] + [(100, prose(3, 14)), (101, "ß😀 ünï")]
    for most in (50, 500_000):
        got, order = check(spark, rows, most=most)
    texts = dict(rows)
    prints = {r["doc_id"]: r["fingerprint"] for r in got}
    assert all((prints[a] == prints[b]) == (texts[a] == texts[b]) for a in prints for b in prints)
    for r in got:
        i = [d for d, _ in order].index(r["doc_id"])
        new = edited(texts[r["doc_id"]], order[(i + 1) % len(order)][1])
        same = next((k for k, (x, y) in enumerate(zip(texts[r["doc_id"]], new, strict=False)) if x != y), min(len(new), len(texts[r["doc_id"]])))
        assert r["common_prefix"] == same
        assert (r["edited_fingerprint"] == r["fingerprint"]) == (new == texts[r["doc_id"]])


def test_likeness_follows_overlap(spark):
    text = prose(1, 4000)
    rows = [(0, text), (1, text), (2, prose(2, 4000)), (3, text[: len(text) * 3 // 4] + prose(4, 1000)), (4, text)]
    got = {r["doc_id"]: r for r in fingerprint_documents(table(spark, rows)).collect()}
    assert got[0]["near_next"] == 1 and got[1]["near_next"] < 0.2 and 0.5 < got[3]["near_next"] < 0.95
    assert 0.3 < got[1]["near_edited"] < 0.75


def test_edges(spark):
    check(spark, edge_rows())
    check(spark, [(5, "alone in the table")])
    assert fingerprint_documents(table(spark, [])).count() == 0


def test_spans_and_extensions():
    rng = np.random.default_rng(1)
    points = np.tile(rng.integers(0, 3, 40), 6).astype(np.uint32)
    h = PrefixHashes(points)
    i, j = rng.integers(0, 230, 300), rng.integers(0, 230, 300)
    got = common_extension(h, i, len(points) - i, h, j, len(points) - j)
    for a, b, n in zip(i, j, got, strict=True):
        m = 0
        while max(a, b) + m < len(points) and points[a + m] == points[b + m]:
            m += 1
        assert n == m
