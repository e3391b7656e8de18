"""Quality classifier: random Fourier features, partition-summed ridge regression, isotonic calibration.

Statistics of each whole text (byte classes, word and line shape, repetition) are standardised over
all documents and sent through random Fourier features, which approximate a Gaussian kernel. Every
partition sums its part of the normal equations of each fold, the parts are added in a two-level tree, and the driver
solves one small system. Calibration is isotonic over out-of-fold raw scores, by a histogram that
covers every training row. A score is 0.995 of the calibrated value and 0.005 of a logistic curve of the raw one, which keeps
the raw order within the flat steps of the calibration.

Inputs of a score are the text alone; labels, lang, source and ids never enter. Learning uses the
labelled rows whose crc32(doc_id) mod 4 is not ``held_out_fold``, all of them.

Defined cases. Null text: empty; empty texts get a score like any other. Null id: hashed as the empty
string, never labelled. Repeated labels of one id: their mean. Null labels: ignored. Without any
label to learn from every score is 1.0. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from polyscribe.llm.common import discard, materialise, table

THRESHOLD = 0.7
_KINDS = 18


def _byte_classes() -> np.ndarray:
    c = np.full(256, 15, np.uint8)  # other ASCII
    c[65:91], c[97:123], c[48:58], c[128:] = 0, 1, 2, 3
    c[[32, 9, 11, 12, 13]], c[10] = 4, 5
    for i, ch in enumerate(b"!#$%&*|.,"):
        c[ch] = 6 + i
    c[[ord("@"), ord("/"), ord("=")]], c[[ord("-"), ord("'"), ord("("), ord(")"), ord('"'), ord(":"), ord(";"), ord("?")]] = 16, 17
    return c


_CLASS = _byte_classes()
N_FEATURES = _KINDS + 15


def text_statistics(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of N_FEATURES floats for each text."""
    from polyscribe.llm.kernels import mix, row_of, span_hashes, word_spans

    n = len(offsets) - 1
    sizes = np.diff(offsets).astype(np.float64)
    row = np.repeat(np.arange(n), np.diff(offsets))
    kinds = np.bincount(row * _KINDS + _CLASS[raw], minlength=n * _KINDS).reshape(n, _KINDS).astype(np.float64)
    starts, stops, at = word_spans(raw, offsets)
    words, length, owner = np.diff(at).astype(np.float64), (stops - starts).astype(np.float64), row_of(at, len(starts))
    some, per_byte = np.maximum(words, 1), np.maximum(sizes, 1)
    per = lambda x: np.bincount(owner, x, minlength=n)
    mean = per(length) / some
    spread = np.sqrt(np.maximum(per(length**2) / some - mean**2, 0))
    h = span_hashes(raw, starts, stops)

    def distinct(keys, rows, total):
        order = np.lexsort((keys, rows))
        k, r = keys[order], rows[order]
        new = np.ones(len(k), bool)
        new[1:] = (k[1:] != k[:-1]) | (r[1:] != r[:-1])
        edge = np.flatnonzero(np.append(new, True))
        top = np.zeros(n)
        np.maximum.at(top, r[edge[:-1]], np.diff(edge).astype(np.float64))
        return np.bincount(r[new], minlength=n) / np.maximum(total, 1), top / np.maximum(total, 1)

    unique, top = distinct(h, owner, words)
    same = np.zeros(len(h))
    pair_share = np.zeros(n)
    if len(h) > 1:
        within = owner[1:] == owner[:-1]
        same[1:] = (h[1:] == h[:-1]) & within
        pairs = mix(h[1:] * np.uint64(0x9E3779B97F4A7C15) + h[:-1])[within]
        pair_share, _ = distinct(pairs, owner[1:][within], words - 1)
    first, last = raw[starts] if len(starts) else raw[:0], raw[stops - 1] if len(stops) else raw[:0]
    upper_first = _CLASS[first] == 0
    second = raw[np.minimum(starts + 1, max(len(raw) - 1, 0))] if len(starts) else raw[:0]
    shout = upper_first & (length > 2) & (_CLASS[second] == 0)
    symbol_end = np.isin(_CLASS[last], [6, 7, 8, 9, 10, 11, 12, 16])
    lines = kinds[:, 5] + 1
    newline = np.flatnonzero(raw == 10)
    line_start = np.unique(np.concatenate([offsets[:-1][sizes > 0], newline + 1])) if len(raw) else np.empty(0, np.int64)
    line_start = line_start[line_start < len(raw)]
    line_stop = np.append(line_start[1:], len(raw)) if len(line_start) else line_start
    line_owner = row[line_start] if len(raw) else line_start
    line_hash = span_hashes(raw, line_start, line_stop)
    line_unique, _ = distinct(line_hash, line_owner, np.bincount(line_owner, minlength=n).astype(float))
    columns = [
        *(kinds / per_byte[:, None]).T, np.log1p(sizes), np.log1p(words), mean, spread, unique, top, per(same) / some, pair_share,
        per(upper_first.astype(float)) / some, per(shout.astype(float)) / some, per(symbol_end.astype(float)) / some,
        np.log1p(lines), np.log1p(words / lines), line_unique, unique * np.log1p(words),
    ]
    return np.stack(columns, 1).astype(np.float32)


_NAMES = [f"f{i}" for i in range(N_FEATURES)]


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fold (crc32 of the id mod 4) and the statistics f0, f1, ... of every whole text."""
    from polyscribe.llm.kernels import column_bytes, pieces

    def compute(batches):
        for batch in batches:
            raw, offsets = column_bytes(batch.column(2))
            for i, j in pieces(offsets, 2_000_000):
                x = text_statistics(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                part = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *(pa.array(c) for c in x.T)], ["doc_id", "fold", *_NAMES])

    key = F.col(id_col).cast("long")
    fold = (F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 4).cast("int")
    schema = "doc_id long, fold int, " + ", ".join(f"{x} float" for x in _NAMES)
    return docs.select(key.alias("doc_id"), fold.alias("fold"), F.col(text_col).cast("string")).mapInArrow(compute, schema)


def _lift(x: np.ndarray, model: dict) -> np.ndarray:
    z = np.clip((x - model["mean"]) / model["scale"], -5, 5)
    waves = np.cos(z @ model["w"] + model["b"]) * np.sqrt(2 / model["w"].shape[1])
    return np.concatenate([waves, np.ones((len(x), 1))], 1)


def _matrix(batch) -> np.ndarray:
    return np.stack([batch.column(batch.schema.get_field_index(x)).to_numpy(zero_copy_only=False) for x in _NAMES], 1).astype(np.float64)


def _pool_adjacent(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic regression of y (weights w) on ascending x: the means' x and y."""
    blocks: list[list[float]] = []
    for xi, yi, wi in zip(x, y, w, strict=True):
        blocks.append([xi * wi, yi * wi, wi])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            b = blocks.pop()
            blocks[-1] = [p + q for p, q in zip(blocks[-1], b, strict=True)]
    return np.array([b[0] / b[2] for b in blocks]), np.array([b[1] / b[2] for b in blocks])


def fit(stats: DataFrame, labels: DataFrame, label_col: str = "quality", held_out_fold: int = 2, waves: int = 256, ridge: float = 1e-3, bins: int = 2000, seed: int = 11) -> dict | None:
    """The model as a small dict of arrays, or None without labels."""
    row = stats.agg(*[F.avg(x).alias(f"m{x}") for x in _NAMES], *[F.stddev_pop(x).alias(f"s{x}") for x in _NAMES]).first()
    truth = labels.filter(F.col(label_col).isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.avg(label_col).cast("double").alias("y"))
    train = materialise(stats.filter(F.col("fold") != held_out_fold).join(truth, "doc_id"), "quality-train")
    if row[0] is None:
        return None
    mean = np.array([row[f"m{x}"] for x in _NAMES])
    scale = np.maximum(np.array([row[f"s{x}"] for x in _NAMES]), 1e-6)
    rng = np.random.default_rng(seed)
    model = {"mean": mean, "scale": scale, "w": rng.normal(0, 0.7 / np.sqrt(N_FEATURES), (N_FEATURES, waves)), "b": rng.uniform(0, 2 * np.pi, waves)}
    side = waves + 1
    stripe = 32

    def sums(batches):
        """One row a fold and stripe of the matrix from each partition, with a spread key for the first level of the tree."""
        from pyspark import TaskContext

        total: dict[int, np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            fold = batch.column(batch.schema.get_field_index("fold")).to_numpy(zero_copy_only=False)
            y = batch.column(batch.schema.get_field_index("y")).to_numpy(zero_copy_only=False)
            z = _lift(_matrix(batch), model)
            for f in np.unique(fold):
                zf = z[fold == f]
                s = np.concatenate([zf.T @ zf, (zf.T @ y[fold == f])[:, None]], 1)
                total[int(f)] = total[int(f)] + s if int(f) in total else s
        at = TaskContext.get().partitionId() % 64
        for f, s in total.items():
            for k in range(0, side, stripe):
                yield pa.RecordBatch.from_arrays([pa.array([f], pa.int32()), pa.array([k], pa.int32()), pa.array([at], pa.int32()), pa.array([s[k : k + stripe].tobytes()], pa.binary())], ["fold", "stripe", "at", "part"])

    def add(rows: pa.Table) -> pa.Table:
        s = sum(np.frombuffer(x.as_py(), np.float64) for x in rows["part"])
        return rows.slice(0, 1).set_column(rows.schema.get_field_index("part"), "part", pa.array([s.tobytes()], pa.binary()))

    kind = "fold int, stripe int, at int, part binary"
    parts = train.mapInArrow(sums, kind).groupBy("fold", "stripe", "at").applyInArrow(add, kind).groupBy("fold", "stripe").applyInArrow(add, kind)
    by_fold: dict[int, np.ndarray] = {}
    for r in parts.collect():  # three folds of one (waves + 1)-square system, whatever the input
        m = by_fold.setdefault(r["fold"], np.zeros((side, side + 1)))
        m[r["stripe"] : r["stripe"] + stripe] = np.frombuffer(bytes(r["part"]), np.float64).reshape(-1, side + 1)
    if not by_fold:
        return None
    solve = lambda m: np.linalg.solve(m[:, :side] + ridge * max(m[side - 1, side - 1], 1) / side * np.eye(side) + 1e-9 * np.eye(side), m[:, side])
    whole = sum(by_fold.values())
    model["beta"] = solve(whole)
    betas = {f: solve(whole - m) if len(by_fold) > 1 else model["beta"] for f, m in by_fold.items()}

    def histogram(batches):
        total = np.zeros((bins, 3))
        for batch in batches:
            if batch.num_rows:
                fold = batch.column(batch.schema.get_field_index("fold")).to_numpy(zero_copy_only=False)
                y = batch.column(batch.schema.get_field_index("y")).to_numpy(zero_copy_only=False)
                z = _lift(_matrix(batch), model)
                raw = np.empty(len(z))
                for f in np.unique(fold):
                    raw[fold == f] = z[fold == f] @ betas[int(f)]
                at = np.clip(((raw + 0.5) / 2 * bins).astype(int), 0, bins - 1)
                for c, v in enumerate((raw, y, np.ones_like(y))):
                    total[:, c] += np.bincount(at, v, minlength=bins)
        k = np.flatnonzero(total[:, 2])
        yield pa.RecordBatch.from_arrays([pa.array(k, pa.int32()), *(pa.array(total[k, c]) for c in range(3))], ["bin", "x", "y", "n"])

    table_ = train.mapInArrow(histogram, "bin int, x double, y double, n double").groupBy("bin").agg(F.sum("x"), F.sum("y"), F.sum("n")).orderBy("bin").collect()
    n = np.array([r[3] for r in table_])
    model["knots"] = _pool_adjacent(np.array([r[1] for r in table_]) / n, np.array([r[2] for r in table_]) / n, n)
    discard(train)
    return model


def calibrated(x: np.ndarray, model: dict) -> np.ndarray:
    """Scores from 0 to 1 of rows of statistics."""
    raw = _lift(x, model) @ model["beta"]
    # a slight tilt keeps the order of raw scores inside the flat steps
    return np.clip(0.995 * np.interp(raw, *model["knots"]) + 0.005 / (1 + np.exp(-4 * (raw - 0.5))), 0, 1)


def score(stats: DataFrame, model: dict | None, threshold: float = THRESHOLD, held_out_fold: int = 2) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    held = (F.col("fold") == held_out_fold).alias("held_out")
    if model is None:
        return stats.select("doc_id", held, F.lit(1.0).alias("score"), F.lit(1).alias("predicted"))

    def apply(batches):
        for batch in batches:
            s = calibrated(_matrix(batch), model)
            at = batch.schema.get_field_index
            yield pa.RecordBatch.from_arrays([batch.column(at("doc_id")), batch.column(at("fold")), pa.array(s)], ["doc_id", "fold", "score"])

    return stats.mapInArrow(apply, "doc_id long, fold int, score double").select("doc_id", held, "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    stats = materialise(features(docs, id_col, text_col), "quality-stats")
    return score(stats, fit(stats, labels, label_col))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs that the classifier accepts; the second scan, which scores and filters, shuffles nothing."""
    from polyscribe.llm.kernels import column_bytes, pieces

    stats = materialise(features(docs, id_col, text_col), "quality-stats")
    model = fit(stats, labels, label_col)
    discard(stats)
    if model is None:
        return docs
    at = docs.columns.index(text_col)

    def accept(batches):
        for batch in batches:
            raw, offsets = column_bytes(batch.column(at).cast(pa.string()))
            keep = [calibrated(text_statistics(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]).astype(np.float64), model) >= threshold for i, j in pieces(offsets, 2_000_000)]
            if keep:
                yield batch.filter(pa.array(np.concatenate(keep)))

    return docs.mapInArrow(accept, docs.schema)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
