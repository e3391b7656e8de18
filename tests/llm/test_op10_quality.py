import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from polyscribe.llm.op10_quality import THRESHOLD, _pool_adjacent, classify, keep_good, op10_quality
from tests.llm.helpers import edge_rows, table

FINE = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark, data):
    scored = op10_quality(spark, FINE)
    labels = spark.read.parquet(f"{FINE}/labels.parquet")
    rows = scored.join(labels, "doc_id").select("doc_id", "held_out", "score", "predicted", "quality").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= THRESHOLD) for r in rows)
    out = [r for r in rows if r["held_out"]]
    assert np.mean([r["predicted"] == r["quality"] for r in out]) > 0.9
    good, bad = [r["score"] for r in out if r["quality"]], [r["score"] for r in out if not r["quality"]]
    assert np.mean([g > b for g in good for b in bad]) > 0.95


def plain_statistics(text):
    """The statistics of one text, word by word and line by line."""
    b = (text or "").encode()
    words, letters = re.findall(rb"[^\x20\x09-\x0D]+", b), Counter(b)
    upper = lambda c: 65 <= c <= 90
    classes = [set(range(65, 91)), set(range(97, 123)), set(range(48, 58)), set(range(128, 256)), set(b" \t\x0b\x0c\r"), {10}, *({c} for c in b"!#$%&*|.,"), None, set(b"@/="), set(b"-'()\":;?")]
    known = set().union(*(c for c in classes if c))
    kinds = [sum(n for x, n in letters.items() if (x in c if c else x not in known)) for c in classes]
    some, length = max(len(words), 1), [len(w) for w in words]
    mean = sum(length) / some
    pairs = list(zip(words, words[1:], strict=False))
    lines = [x for x in re.findall(rb"[^\n]*\n|[^\n]+", b)]
    unique = len(set(words)) / some
    return np.array([
        *(k / max(len(b), 1) for k in kinds), np.log1p(len(b)), np.log1p(len(words)), mean, max(sum(x * x for x in length) / some - mean**2, 0) ** 0.5, unique, max(Counter(words).values(), default=0) / some,
        sum(x == y for x, y in pairs) / some, len(set(pairs)) / max(len(words) - 1, 1), sum(upper(w[0]) for w in words) / some, sum(upper(w[0]) and len(w) > 2 and upper(w[1]) for w in words) / some,
        sum(w[-1] in b"!#$%&*|@/=" for w in words) / some, np.log1p(kinds[5] + 1), np.log1p(len(words) / (kinds[5] + 1)), len(set(lines)) / max(len(lines), 1), unique * np.log1p(len(words)),
    ]).astype(np.float32)


def plain_scores(docs, labels):
    """Statistics, waves, ridge, out-of-fold scores, isotonic means by their min-max formula: {doc_id: score}."""
    x = np.array([plain_statistics(t) for _, t in docs]).astype(np.float64)
    fold = np.array([zlib.crc32(str(d).encode()) % 4 for d, _ in docs])
    rng, size = np.random.default_rng(11), x.shape[1]
    w, b = rng.normal(0, 0.7 / np.sqrt(size), (size, 256)), rng.uniform(0, 2 * np.pi, 256)
    z = np.clip((x - x.mean(0)) / np.maximum(x.std(0), 1e-6), -5, 5)
    z = np.concatenate([np.cos(z @ w + b) * np.sqrt(2 / 256), np.ones((len(z), 1))], 1)
    learn = np.array([d in labels and f != 2 for (d, _), f in zip(docs, fold, strict=True)])
    y = np.array([labels.get(d, 0) for d, _ in docs], float)
    fit = lambda m: np.linalg.solve(z[m].T @ z[m] + (1e-3 * max(m.sum(), 1) / 257 + 1e-9) * np.eye(257), z[m].T @ y[m])
    raw = np.zeros(len(z))
    for f in (0, 1, 3):
        raw[fold == f] = z[fold == f] @ fit(learn & (fold != f))
    at = np.clip(((raw + 0.5) / 2 * 2000).astype(int), 0, 1999)
    bins = sorted(set(at[learn]))
    n, xs, ys = ([g[learn & (at == k)].sum() for k in bins] for g in (np.ones(len(z)), raw, y))
    mean = lambda i, j: sum(ys[i : j + 1]) / sum(n[i : j + 1])
    fitted = [max(min(mean(i, j) for j in range(k, len(bins))) for i in range(k + 1)) for k in range(len(bins))]
    steps = {}
    for k, v in enumerate(fitted):
        steps.setdefault(round(v, 9), []).append(k)
    knots = sorted((sum(xs[k] for k in m) / sum(n[k] for k in m), sum(ys[k] for k in m) / sum(n[k] for k in m)) for m in steps.values())
    final = z @ fit(learn)
    score = np.clip(0.995 * np.interp(final, *zip(*knots, strict=True)) + 0.005 / (1 + np.exp(-4 * (final - 0.5))), 0, 1)
    return dict(zip([d for d, _ in docs], score, strict=True))


def test_scores_equal_a_plain_restatement(spark, data):
    docs, labels = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text"), spark.read.parquet(f"{data}/labels.parquet")
    truth = {r["doc_id"]: r["quality"] for r in labels.collect() if r["quality"] is not None}
    want = plain_scores([(r[0], r[1]) for r in docs.collect()], truth)
    got = {r["doc_id"]: r["score"] for r in op10_quality(spark, data).collect()}
    assert got.keys() == want.keys()
    assert max(abs(got[d] - want[d]) for d in got) < 1e-5


def test_held_out_labels_and_other_columns_do_not_matter(spark, data):
    docs, labels = spark.read.parquet(f"{data}/documents.parquet"), spark.read.parquet(f"{data}/labels.parquet")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    flipped = labels.withColumn("quality", F.when(fold == 2, 1 - F.col("quality")).otherwise(F.col("quality")))
    other = docs.withColumns({"lang": F.lit("zz"), "source": F.lit(None).cast("string"), "n_chars": F.lit(0)})
    a, b = (sorted((r["doc_id"], r["score"]) for r in x.collect()) for x in (classify(docs, labels), classify(other, flipped)))
    assert [i for i, _ in a] == [i for i, _ in b] and np.allclose([s for _, s in a], [s for _, s in b], atol=1e-9)


def test_edges(spark, data):
    labels = spark.read.parquet(f"{data}/labels.parquet")
    real = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text")
    edges = table(spark, [(None if d is None else d + 10**6, t) for d, t in edge_rows()]).select("doc_id", "text")
    got = classify(real.unionAll(edges), labels)
    assert got.count() == real.count() + edges.count() and got.filter("score IS NULL OR score < 0 OR score > 1").count() == 0
    assert classify(table(spark, []), labels).count() == 0
    none = labels.limit(0)
    assert {r["score"] for r in classify(table(spark, edge_rows()), none).collect()} == {1.0}
    assert keep_good(table(spark, edge_rows()), none).count() == len(edge_rows())
    assert classify(real, labels.unionAll(labels).unionByName(spark.createDataFrame([(0, None, None), (None, 1, 0)], "doc_id long, quality int, toxic int").select(*labels.columns))).count() == real.count()


def test_isotonic():
    x, y = _pool_adjacent(np.arange(6.0), np.array([0, 1, 0, 1, 1, 0.5]), np.ones(6))
    assert (np.diff(x) > 0).all() and (np.diff(y) > 0).all() and abs(y[-1] - 2.5 / 3) < 1e-9
