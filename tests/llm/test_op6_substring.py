import hashlib

from polyscribe.llm import common
from polyscribe.llm.op6_substring import SQL, op6_substring, substring_dedup
from tests.llm.helpers import edge_rows, prose, table, words
from tests.oracle import compare


def brute(rows, n):
    seen, out = {}, []
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    for doc, text in rows:
        w = words(text)
        for i in range(len(w) - n + 1):
            seen.setdefault(tuple(w[i : i + n]), (doc, i))
    for doc, text in rows:
        w, gone = words(text), set()
        for i in range(len(w) - n + 1):
            if seen[tuple(w[i : i + n])] != (doc, i):
                gone |= set(range(i, i + n))
        out.append((doc, len(w), len(gone), hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in gone).encode()).hexdigest()))
    return sorted(out, key=repr)


def check(spark, rows, n=20):
    got = sorted((tuple(r) for r in substring_dedup(table(spark, rows), n=n).collect()), key=repr)
    assert got == brute(rows, n)


def test_brute_force(spark):
    shared = [prose(900 + i, 55) for i in range(6)]
    rows = [(i, f"{prose(i, 30)} {shared[i % 6]} {prose(50 + i, 10)} {shared[i % 4] if i % 3 else ''} {prose(i, 12)}") for i in range(60)]
    check(spark, rows)
    check(spark, [(i, " ".join("ab"[(i * j) % 3 % 2] for j in range(40))) for i in range(30)], 5)


def test_more_shards_than_routes(spark, monkeypatch):
    monkeypatch.setattr(common, "FAN_OUT", 3)
    shared = [prose(900 + i, 55) for i in range(6)]
    check(spark, [(i, f"{prose(i, 30)} {shared[i % 6]} {prose(50 + i, 10)} {shared[i % 4] if i % 3 else ''} {prose(i, 12)}") for i in range(60)])


def test_repeats_inside_a_document_and_ties(spark):
    part = prose(1, 30)
    check(spark, [(1, f"{part} {part} {part}"), (0, part), (5, "x " * 100)])


def test_edges(spark):
    check(spark, edge_rows())
    assert substring_dedup(table(spark, [])).count() == 0
    assert substring_dedup(table(spark, [(1, "a b")]), with_text=True).first()["kept"] == "a b"


def test_sql(spark, data):
    compare(op6_substring(spark, data), SQL, data)
