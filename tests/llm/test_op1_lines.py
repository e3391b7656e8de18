import random
import time
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from polyscribe.llm import common
from polyscribe.llm import op1_lines as op
from polyscribe.llm.op1_lines import banded_many, line_dedup, op1_lines, within
from tests.llm.helpers import edge_rows, prose, table
from tests.oracle import compare


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        old, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            old, row[j] = row[j], min(old + (x != y), row[j] + 1, row[j - 1] + 1)
    return row[-1]


def brute(rows, edits=2, least=25):
    """{(doc_id, line): first_doc} of the lines that go."""
    places = defaultdict(set)
    for doc, text in rows:
        for k, line in enumerate(text.split("\n") if text else []):
            if len(line) >= least:
                places[line].add((doc if doc is not None else -(2**63), k))
    lines = sorted(places)
    root = {x: x for x in lines}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(lines):
        for b in lines[i + 1 :]:
            if abs(len(a) - len(b)) <= edits and find(a) != find(b) and distance(a, b) <= edits:
                root[find(a)] = find(b)
    groups = defaultdict(set)
    for x in lines:
        groups[find(x)] |= places[x]
    return {p: min(g)[0] for g in groups.values() for p in g if p != min(g)}


def check(spark, rows):
    out = line_dedup(table(spark, rows))
    gone = brute(rows)
    texts = dict(rows)
    for r in out.collect():
        doc = r["doc_id"] if r["doc_id"] is not None else -(2**63)
        expected = {k: f for (d, k), f in gone.items() if d == doc}
        if r["doc_id"] is not None:
            assert dict(zip(r["removed"], r["first_docs"], strict=True)) == {k: (f if f != -(2**63) else None) for k, f in expected.items()}
            lines = (texts[r["doc_id"]] or "").split("\n")
            assert (r[-1] or "") == "\n".join(x for k, x in enumerate(lines) if k not in expected)
    return out


@settings(max_examples=300, deadline=None)
@given(st.text("abç", max_size=14), st.text("abç", max_size=14), st.integers(0, 4))
def test_banded_distance(a, b, k):
    points = lambda s: np.array([ord(c) for c in s], np.uint32)
    assert within(points(a), points(b), k) == (distance(a, b) <= k)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.text("abç", min_size=4, max_size=14), st.text("abç", min_size=4, max_size=14)), min_size=1, max_size=6), st.integers(0, 3))
def test_banded_distances_of_many_pairs(pairs, k):
    pairs = [(a, b) for a, b in pairs if abs(len(a) - len(b)) <= k]
    texts = [x for p in pairs for x in p]
    length = np.array([len(x) for x in texts], np.int64)
    flat = np.array([ord(c) for x in texts for c in x] + [0], np.uint32)
    start = np.concatenate([[0], np.cumsum(length)])[:-1].astype(np.int64)
    i = np.arange(len(pairs))
    if len(i):
        assert (banded_many(flat, start, length, 2 * i, 2 * i + 1, k) <= k).tolist() == [distance(a, b) <= k for a, b in pairs]


def template(n, seed=1):
    """Different lines that share two of three segments; every tenth is one edit from the one before."""
    rng, out = random.Random(seed), []
    for i in range(n):
        own = out[-1][39:-1] + "#" if i % 10 == 9 else "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(22))
        out.append(f"This page was last edited by user numb {own}"[:39] + own)
    return out


def test_templates_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(op, "GROUP", 16)
    monkeypatch.setattr(op, "CHUNK", 20)
    check(spark, [(d, line) for d, line in enumerate(template(150))])


def test_more_shards_than_routes(spark, monkeypatch):
    monkeypatch.setattr(common, "FAN_OUT", 3)
    check(spark, [(d, "\n".join([line, prose(d % 9, 9), prose(70 + d, 8)])) for d, line in enumerate(template(60))])


def test_many_lines_that_share_a_segment(spark):
    """20,000 template lines: 2e8 pairs under one key, in tasks of two chunks."""
    lines = template(20_000)
    began = time.time()
    out = line_dedup(table(spark, [(d, "\n".join(lines[40 * d : 40 * d + 40])) for d in range(500)]))
    assert out.selectExpr("sum(size(removed))").first()[0] == 2000
    assert time.time() - began < 150


def test_lines_of_one_hash_stay_apart(spark, monkeypatch):
    """Where the first half of the identity says nothing, the second and the texts decide."""
    monkeypatch.setattr(op.Lines, "hashes", lambda self: np.zeros(len(self.starts), np.uint64) + np.uint64(7))
    lines = op.Lines(np.frombuffer(b"one line\nanother", np.uint8), np.array([0, 16]))
    assert len(set(lines.seconds(np.arange(2)).tolist())) == 2 and len(set(lines.hashes().tolist())) == 1


def test_columns_with_names_used_inside(spark):
    docs = table(spark, [(1, prose(1, 9)), (2, prose(1, 9))]).withColumnsRenamed({"kept": "_gone", "h": "_line_doc"})
    got = {r["doc_id"]: r for r in line_dedup(docs).collect()}
    assert got[2]["removed"] == [0] and got[1]["removed"] == [] and got[2]["_gone"] == "x" and got[2]["_line_doc"] == "h"


def test_brute_force(spark):
    base = [prose(i, 8) for i in range(12)]
    rows = []
    for d in range(40):
        lines = [base[(d * 7 + j) % 12] for j in range(3)]
        if d % 3 == 0:
            lines[1] = lines[1][:5] + "x" + lines[1][5:]
        if d % 4 == 0:
            lines[2] = lines[2][1:-1]
        if d % 5 == 0:
            lines[0] = lines[0][:9] + "yz" + lines[0][11:]
        rows.append((d, "\n".join([*lines, "short line", prose(1000 + d, 9)])))
    check(spark, rows)


def test_moved_segments(spark):
    line = prose(5, 9)
    rows = [(0, line)] + [(i, line[: 3 * i] + "#" + line[3 * i :]) for i in range(1, 12)] + [(20 + i, line[: 4 * i] + line[4 * i + 2 :]) for i in range(8)]
    check(spark, rows)


def test_large_group_of_copies(spark):
    line = "the same line stands in every document of this group"
    out = line_dedup(table(spark, [(i, f"{line}\n{prose(i, 12)}") for i in range(400)]))
    assert out.filter("size(removed) = 1").count() == 399


def test_edge_rows(spark):
    rows = edge_rows()
    out = line_dedup(table(spark, rows))
    assert out.count() == len(rows)
    got = {r["doc_id"]: r for r in out.collect() if r["doc_id"] is not None}
    assert got[7]["removed"] == [0] and got[6]["removed"] == [] and got[8]["removed"] == [] and got[2]["removed"] == []
    assert line_dedup(table(spark, [])).count() == 0


def test_short_lines_need_segments(spark):
    with pytest.raises(ValueError):
        line_dedup(table(spark, [(1, "x")]), min_chars=3)


def test_short_lines(spark):
    """Lines of every length that is not blank, with edits scaled to the length, against brute force."""
    base = ["Les.", "And ornd.", "x", "  ", "Erheed. Tit.", "All rights reserved.", "Titionly in enshst.", prose(3, 4)[:24], prose(3, 4)[:25], prose(4, 5)[:26], ""]
    near = ["Lez.", "And ornb.", "y", "\t", "Erheed, Tit.", "All rights reservd.", "Titionly im ensht.", prose(3, 4)[:23], prose(4, 5)[1:26], "Erheed. Titl.", "Erheed, Titl."]
    rows = [(d, "\n".join([*base, prose(900 + d, 9)] if d % 2 else [*near[d % 3 :], base[d % 11], prose(900 + d, 9)])) for d in range(12)]
    places = defaultdict(list)
    for d, text in rows:
        for k, x in enumerate(text.split("\n")):
            if x.strip():
                places[x].append((d, k))
    root = {x: x for x in places}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in places:
        for b in places:
            if a < b and distance(a, b) <= min(2, min(len(a), len(b)) * 2 // 25):
                root[find(a)] = find(b)
    groups = defaultdict(set)
    for x, at in places.items():
        groups[find(x)] |= set(at)
    gone = {p: min(g)[0] for g in groups.values() for p in g if p[0] != min(g)[0] or p[1] != min(g)[1]}
    out = line_dedup(table(spark, rows), short=True).collect()
    got = {(r["doc_id"], k): f for r in out for k, f in zip(r["removed"], r["first_docs"], strict=True)}
    assert got == gone and any(len(x) < 13 for x in places)


def test_query_removes_repeated_short_lines(spark, tmp_path):
    table(spark, [(1, "And ornd.\n\n" + prose(1, 9)), (2, "And ornd.\n\n" + prose(2, 9))]).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: (r["removed"], r["first_docs"]) for r in op1_lines(spark, str(tmp_path)).collect()}
    assert got == {1: ("", ""), 2: ("0", "1")}


def test_sql(spark, data):
    compare(op1_lines(spark, data), op.SQL, data)
