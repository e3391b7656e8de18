import corpus_pipeline as p
from pyspark.sql import functions as F

from polyscribe.llm.op9_decontamination import contaminated
from polyscribe.runtime import materialise
from tests.llm.helpers import edge_rows
from tests.llm.test_op1_lines import brute as brute_lines
from tests.llm.test_op8_neardup import shingles


def test_stages(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    columns, tables = docs.columns, [docs]
    assert [n for n, _ in p.STAGES] == ["quality", "lines", "near", "leaks", "mix"]
    for name, stage in p.STAGES:
        tables.append(materialise(stage(spark, tables[-1], data), f"test-{name}"))
    source, good, lined, near, clean, mixed = tables
    assert all(t.columns == columns for t in tables[:-1])
    labels = spark.read.parquet(f"{data}/labels.parquet")
    marked = source.join(labels.filter("quality = 1"), "doc_id", "left_semi")
    assert marked.join(good, "doc_id", "left_anti").count() <= 0.05 * marked.count()
    # lines
    rows = {r["doc_id"]: r["text"] for r in good.collect()}
    gone = brute_lines(list(rows.items()))
    expected = {}
    for d, t in rows.items():
        lines = (t or "").split("\n")
        kept = "\n".join(x for k, x in enumerate(lines) if (d, k) not in gone)
        if len(lines) == len(kept.split("\n")) or kept.strip():
            expected[d] = kept
    got = {r["doc_id"]: r for r in lined.collect()}
    assert {d: r["text"] for d, r in got.items()} == expected
    assert all(r["n_chars"] == len(r["text"]) for r in got.values())
    # near duplicates
    left = {r["doc_id"]: shingles(r["text"]) for r in near.collect()}
    sets = {d: shingles(t) for d, t in expected.items()}
    ids = sorted(left)
    assert not any(len(left[a] & left[b]) >= 0.8 * len(left[a] | left[b]) for i, a in enumerate(ids) for b in ids[:i] if left[a] and left[b])
    for d in set(sets) - set(left):
        assert any(len(sets[d] & sets[o]) >= 0.8 * len(sets[d] | sets[o]) for o in sets if o != d)
    # leaks
    hits = {r["doc_id"] for r in contaminated(near, spark.read.parquet(f"{data}/benchmark.parquet")).collect()}
    assert {r["doc_id"] for r in clean.collect()} == set(left) - hits
    assert mixed.count() == clean.count() and mixed.filter("taken > 2 * size").count() == 0


def test_run(spark, data):
    assert set(p.run(spark, data).columns) >= {"doc_id", "size", "target", "taken"}


def test_edges(spark, data):
    schema = spark.read.parquet(f"{data}/documents.parquet").schema
    rows = spark.createDataFrame([(d, t, None, None, None if t is None else len(t)) for d, t in edge_rows()], schema)
    wide = rows.withColumns({"removed": F.lit(1), "kept": F.lit("k"), "component_id": F.lit(2), "_hit": F.lit(3)})
    for frame in (rows, rows.limit(0), wide):
        docs = frame
        for name, stage in p.STAGES:
            out = materialise(stage(spark, docs, data), f"edge-{name}")
            if name != "mix":
                assert out.columns == frame.columns
            docs = out
