from pyspark.sql import functions as F

from polyscribe.llm.op5_mixing import SQL, mix_sources, op5_mixing
from tests.llm.helpers import edge_rows, prose, table, words
from tests.oracle import compare


def rows(n=400):
    source = lambda i: None if i % 11 == 0 else "" if i % 13 == 0 else f"s{i % 5}" if i % 3 else "hot"
    return [(i, prose(i, 1 + i * 7 % 90), source(i)) for i in range(n)]


def targets(sizes, weights=(5, 2, 1)):
    """Water-filling by repeated redistribution."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    out, open_, left = {}, set(order), 1.5 * sum(sizes.values())
    while True:
        unit = left / sum(weight[s] for s in open_) if open_ else 0
        full = {s for s in open_ if weight[s] * unit > 2 * sizes[s]}
        if not full:
            return out | {s: weight[s] * unit for s in open_}
        for s in full:
            out[s] = 2.0 * sizes[s]
            left -= out[s]
        open_ -= full


def test_contract(spark):
    data = rows()
    got = mix_sources(table(spark, data)).collect()
    assert len(got) == len(data)
    sizes = {}
    for _, t, s in data:
        sizes[s] = sizes.get(s, 0) + len(words(t))
    want = targets(sizes)
    source = {d: s for d, _, s in data}
    taken, longest = {}, {}
    for r in got:
        s = source[r["doc_id"]]
        assert r["size"] == len(words(dict((d, t) for d, t, _ in data)[r["doc_id"]])) and r["source_size"] == sizes[s] and abs(r["target"] - want[s]) < 1e-6
        assert r["taken"] <= 2 * r["size"]
        taken[s] = taken.get(s, 0) + r["taken"]
        longest[s] = max(longest.get(s, 0), r["size"])
    assert all(abs(taken[s] - want[s]) <= longest[s] for s in want)


def test_reruns_and_partitions_agree(spark):
    a, b = (sorted(tuple(r) for r in mix_sources(table(spark, rows(120), p)).select("doc_id", "taken").collect()) for p in (1, 5))
    assert a == b


def test_edges(spark):
    assert mix_sources(table(spark, edge_rows())).count() == len(edge_rows())
    assert mix_sources(table(spark, [])).count() == 0
    assert mix_sources(table(spark, [(1, None), (2, "")])).agg(F.sum("taken")).first()[0] == 0
    one = mix_sources(table(spark, [(1, "five words are in here", "a")])).first()
    assert (one["target"], one["taken"]) == (7.5, 10)


def test_native(spark):
    plan = mix_sources(table(spark, rows(20)))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_sql(spark, data):
    compare(op5_mixing(spark, data), SQL, data)
