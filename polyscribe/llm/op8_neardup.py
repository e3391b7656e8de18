"""Near-duplicate documents: SetSketch registers, banded, estimated by likelihood, confirmed on full shingle sets.

1. One pass over whole texts gives each document its number of distinct word shingles, a 128-bit digest
   of the set and 192 one-byte SetSketch registers.
2. Documents with equal sets form a class; its smallest id stands for it from here on.
3. Representatives that share a band of registers meet. A band's bucket is cut into chunks of at most about ``CHUNK``
   and each task holds two chunks: it estimates every pair of theirs from the registers (a pair
   that already met in an earlier band is left to that band) and keeps those near the threshold. Pairs are
   never rows: a task gives one packed list.
4. The shingle sets of the documents on such lists join their tasks, which confirm pairs by exact
   intersection, skipping those already connected, and return a spanning forest of confirmed links.
5. Connected components of the links, then every document takes its representative's component.

With bands as ``rows_a_band`` picks them, a pair at the threshold fails to meet with a chance under 1e-6, and
the estimate's slack is over five standard errors (0.026 at 0.85, 0.030 at 0.8); nothing else can lose a link. 64-bit hashes
only bring rows together; sets are told apart by 128-bit digests or by themselves. A group of
mutually similar but not linked texts of size g costs g*g/2 register comparisons in g*g/(2*CHUNK**2)
tasks, since each of its pairs has to be looked at.

Defined cases. Null or wordless text: empty set, linked with nothing, its own component. Fewer words
than a shingle: the whole sequence is the one shingle. A null id is an id of its own that sorts first. Rows
that repeat an id share one component. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from polyscribe.llm.common import NULL_ID, discard, materialise, table
from polyscribe.llm.components import components

SHINGLE = 5
#: Members of a bucket's chunk; of buckets over LARGE the chunks are larger, as each member goes to as many tasks as there are chunks.
CHUNK, LARGE, LARGE_CHUNK = 512, 8192, 4096
#: Over five standard errors of the estimate: a pair at the threshold is passed over with a chance under 1e-6.
SLACK = 0.15
#: A list of needed ids is broadcast only if counted to be at most this long; else both sides shuffle.
BROADCAST_IDS = 500_000
_A, _B = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)


def shingle_sets(raw: np.ndarray, offsets: np.ndarray, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, ascending, and where each text's begin (rows + 1)."""
    from polyscribe.llm.kernels import lower_ascii, row_of, shingle_hashes, word_hashes, word_spans

    raw = lower_ascii(raw)
    starts, stops, at = word_spans(raw, offsets)
    h = word_hashes(raw, starts, stops)
    owner, rows = row_of(at, len(h)), len(offsets) - 1
    every = shingle_hashes(h, n)
    whole = owner[: len(every)] == owner[n - 1 :] if len(every) else np.empty(0, bool)
    keys, rows_of = [every[whole]], [owner[: len(every)][whole]]
    words = np.diff(at)
    for k in range(1, n):
        short = np.flatnonzero(words == k)
        if len(short):
            keys.append(np.array([shingle_hashes(h[at[i] : at[i + 1]], k, seed=100 + k)[0] for i in short], np.uint64))
            rows_of.append(short)
    keys, rows_of = np.concatenate(keys), np.concatenate(rows_of)
    order = np.lexsort((keys, rows_of))
    keys, rows_of = keys[order], rows_of[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (rows_of[1:] != rows_of[:-1])
    keys, rows_of = keys[new], rows_of[new]
    return keys, np.searchsorted(rows_of, np.arange(rows + 1))


def sketches(docs: DataFrame, id_col: str, text_col: str, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, n, d1, d2 (digest of the set), regs; null ids as the smallest long, regs null for empty sets."""
    from polyscribe.llm.kernels import column_bytes, mix, pieces
    from polyscribe.llm.setsketch import REGISTERS, sketch

    def compute(batches):
        for batch in batches:
            raw, offsets = column_bytes(batch.column(1))
            ids = batch.column(0).fill_null(NULL_ID)
            for i, j in pieces(offsets, 300_000):
                keys, at = shingle_sets(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], shingle)
                n = np.diff(at)
                full = np.flatnonzero(n)
                d1, d2, regs = np.zeros(j - i, np.uint64), np.zeros(j - i, np.uint64), [None] * (j - i)
                if len(full):
                    d1[full] = np.add.reduceat(mix(keys ^ _A), at[full])
                    d2[full] = np.add.reduceat(mix(keys ^ _B), at[full])
                    for k, r in zip(full, sketch(keys, at[full]), strict=True):
                        regs[k] = r.tobytes()
                yield pa.RecordBatch.from_arrays([ids.slice(i, j - i), pa.array(n), pa.array(d1.view(np.int64)), pa.array(d2.view(np.int64)), pa.array(regs, pa.binary())], ["doc_id", "n", "d1", "d2", "regs"])

    assert REGISTERS == 192
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(compute, "doc_id long, n long, d1 long, d2 long, regs binary")


def _groups(batches):
    """Contiguous runs of equal ``task`` in sorted batches, as tables."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        task = batch.column(batch.schema.get_field_index("task")).to_numpy()
        cut = [0, *(np.flatnonzero(task[1:] != task[:-1]) + 1).tolist(), len(task)]
        if held and held[-1].column(batch.schema.get_field_index("task"))[-1].as_py() != task[0]:
            yield pa.Table.from_batches(held)
            held = []
        for i, j in zip(cut[:-1], cut[1:], strict=True):
            held.append(batch.slice(i, j - i))
            if j < len(task):
                yield pa.Table.from_batches(held)
                held = []
    if held:
        yield pa.Table.from_batches(held)


def likely_pairs(reps: DataFrame, threshold: int, chunk: int = CHUNK) -> DataFrame:
    """(task, rids, a, b): for each task with any, the row ids on its list and the list itself as packed positions."""
    from polyscribe.llm.setsketch import band_keys, first_common_band, likeness, rows_a_band

    rows, low = rows_a_band(threshold / 100), threshold / 100 - SLACK

    def bands(batches):
        for batch in batches:
            if batch.num_rows:
                regs = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8).reshape(batch.num_rows, -1)
                keys = band_keys(regs, rows)
                count = keys.shape[1]
                yield pa.RecordBatch.from_arrays([pa.array(keys.reshape(-1)), pa.array(np.tile(np.arange(count, dtype=np.int32), len(keys))), batch.column(0).take(pa.array(np.repeat(np.arange(len(keys)), count)))], ["key", "band", "rid"])

    met = reps.select("rid", "regs").mapInArrow(bands, "key long, band int, rid long")
    size = met.groupBy("key", "band").agg(F.count("*").alias("size")).filter("size > 1")
    member = met.join(size, ["key", "band"]).withColumn("chunks", F.ceil(F.col("size") / F.when(F.col("size") > LARGE, LARGE_CHUNK).otherwise(chunk))).withColumn("mine", F.pmod(F.xxhash64("rid"), F.col("chunks")))
    spread = member.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
    low_chunk, high_chunk = F.least("mine", "other"), F.greatest("mine", "other")
    placed = spread.select(
        F.xxhash64("key", "band", low_chunk, high_chunk).alias("task"), "key", "band", "rid",
        F.when(F.col("mine") == F.col("other"), 2).when(F.col("mine") < F.col("other"), 0).otherwise(1).alias("side"),
    ).join(reps.select("rid", "n", "regs"), "rid")
    placed = placed.select("task", "key", "band", "side", "rid", "n", "regs").repartition("task").sortWithinPartitions("task")
    schema = pa.schema([("task", pa.int64()), ("rids", pa.list_(pa.int64())), ("a", pa.binary()), ("b", pa.binary())])

    def estimate(batches):
        held, base, pairs = [], 0, 0

        def flush():
            nonlocal held, base, pairs
            regs = np.concatenate([g[2] for g in held])
            size = np.concatenate([g[3] for g in held]).astype(np.float64)
            a, b = np.concatenate([g[4] for g in held]), np.concatenate([g[5] for g in held])
            group = np.repeat(np.arange(len(held)), [len(g[4]) for g in held])
            band = np.array([g[6] for g in held])[group]
            keep = np.minimum(size[a], size[b]) * 100 >= threshold * np.maximum(size[a], size[b])
            a, b, group, band = a[keep], b[keep], group[keep], band[keep]
            good = np.zeros(len(a), bool)
            for i in range(0, len(a), 50_000):
                x, y = regs[a[i : i + 50_000]], regs[b[i : i + 50_000]]
                mine = first_common_band(x, y, rows) == band[i : i + 50_000]
                at = np.flatnonzero(mine)
                if len(at):
                    good[i + at] = likeness(x[at], y[at], size[a[i + at]], size[b[i + at]]) >= low
            a, b, group = a[good], b[good], group[good]
            out = {x: [] for x in schema.names}
            for g in np.unique(group):
                task, rid, first = held[g][0], held[g][1], held[g][7]
                pa_, pb_ = a[group == g] - first, b[group == g] - first
                used, back = np.unique(np.concatenate([pa_, pb_]), return_inverse=True)
                out["task"].append(task)
                out["rids"].append(rid[used])
                out["a"].append(back[: len(pa_)].astype(np.int32).tobytes())
                out["b"].append(back[len(pa_) :].astype(np.int32).tobytes())
            held, base, pairs = [], 0, 0
            return pa.RecordBatch.from_pydict(out, schema)

        def buckets():
            """Groups of one task and one bucket: tasks of equal hash are told apart."""
            for g in _groups(batches):
                key, band = g["key"].to_numpy(), g["band"].to_numpy()
                if (key == key[0]).all() and (band == band[0]).all():
                    yield g
                else:
                    for k, b in sorted(set(zip(key.tolist(), band.tolist(), strict=True))):
                        yield g.filter(pa.array((key == k) & (band == b)))

        for g in buckets():
            regs = np.frombuffer(b"".join(g["regs"].to_pylist()), np.uint8).reshape(g.num_rows, -1)
            side, rid = g["side"].to_numpy(), g["rid"].to_numpy()
            left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
            a, b = (np.repeat(left, len(right)), np.tile(right, len(left))) if len(left) else (np.empty(0, np.int64),) * 2
            alone = np.flatnonzero(side == 2)
            if len(alone) > 1:
                i, j = np.triu_indices(len(alone), 1)
                a, b = np.concatenate([a, alone[i]]), np.concatenate([b, alone[j]])
            if not len(a):
                continue
            held.append((g["task"][0].as_py(), rid, regs, g["n"].to_numpy(), a + base, b + base, g["band"][0].as_py(), base))
            base, pairs = base + len(rid), pairs + len(a)
            if pairs > 200_000:
                yield flush()
        if held:
            yield flush()

    return placed.mapInArrow(estimate, "task long, rids array<long>, a binary, b binary")


def confirmed_links(lists: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """(a, b) document ids: a spanning forest of each task's confirmed links."""
    members = lists.select("task", F.explode("rids").alias("rid"))
    parts = members.join(sets, "rid").select("task", "rid", "doc_id", F.col("items").alias("x"), F.lit(None).cast("binary").alias("y"), F.lit(None).cast("array<long>").alias("rids"))
    heads = lists.select("task", F.lit(None).cast("long").alias("rid"), F.lit(None).cast("long").alias("doc_id"), F.col("a").alias("x"), F.col("b").alias("y"), "rids")
    rows = parts.unionByName(heads).repartition("task").sortWithinPartitions("task", F.col("rids").isNull())

    def check(batches):
        for g in _groups(batches):
            lists_ = [k for k, v in enumerate(g["rids"].is_valid().to_pylist()) if v]
            have: dict[int, dict] = {}  # sets of one rid are members of their own
            for r, d, x in zip(g["rid"].to_pylist(), g["doc_id"].to_pylist(), g["x"].to_pylist(), strict=True):
                if r is not None:
                    have.setdefault(r, {})[d, x] = np.frombuffer(x, np.uint64)
            out = []
            for k in lists_:
                rid = g["rids"][k].as_py()
                members = [[(r, d, x) for (d, _), x in have[r].items()] for r in rid]
                place = np.concatenate([[0], np.cumsum([len(m) for m in members])])
                members = [m for several in members for m in several]
                root = list(range(len(members)))

                def find(x, root=root):
                    while root[x] != x:
                        root[x] = root[root[x]]
                        x = root[x]
                    return x

                for i, j in zip(np.frombuffer(g["x"][k].as_py(), np.int32).tolist(), np.frombuffer(g["y"][k].as_py(), np.int32).tolist(), strict=True):
                    for u in range(place[i], place[i + 1]):
                        for v in range(place[j], place[j + 1]):
                            p, q = find(u), find(v)
                            if p == q:
                                continue
                            (_, da, sa), (_, db, sb) = members[u], members[v]
                            both = np.concatenate([sa, sb])
                            both.sort(kind="stable")
                            shared = int((both[1:] == both[:-1]).sum())
                            if 100 * shared >= threshold * (len(both) - shared):
                                root[max(p, q)] = min(p, q)
                                out.append((da, db))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.int64()), pa.array([x for _, x in out], pa.int64())], ["a", "b"])

    return rows.mapInArrow(check, "a long, b long")


def needed_sets(docs: DataFrame, need: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """rid, doc_id, items (sorted 64-bit shingle hashes) of the documents whose ids are in ``need``."""
    from polyscribe.llm.kernels import column_bytes, mix, pieces

    texts = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    small = need.count() <= BROADCAST_IDS
    texts = texts.join(F.broadcast(need) if small else need, "doc_id", "left_semi")

    def compute(batches):
        for batch in batches:
            raw, offsets = column_bytes(batch.column(1))
            for i, j in pieces(offsets, 1_000_000):
                keys, at = shingle_sets(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], shingle)
                d1 = [int(mix(keys[at[k] : at[k + 1]] ^ _A).sum(dtype=np.uint64)) for k in range(j - i)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(np.array(d1, np.uint64).view(np.int64)), pa.array([keys[at[k] : at[k + 1]].tobytes() for k in range(j - i)], pa.binary())], ["doc_id", "d1", "items"])

    made = texts.mapInArrow(compute, "doc_id long, d1 long, items binary")
    return made.select(F.xxhash64("doc_id", "d1").alias("rid"), "doc_id", "items")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: int = 85, shingle: int = SHINGLE) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id, kept. Links are 100 * |A and B| >= threshold * |A or B|."""
    made = materialise(sketches(docs, id_col, text_col, shingle), "near-sketches")
    full = made.filter("n > 0")
    classes = materialise(full.groupBy("d1", "d2", "n").agg(F.min("doc_id").alias("rep")), "near-classes")
    # one row a class: the copy that bears the smallest id (repeated rows of it are equal)
    reps = full.join(classes.select(F.col("rep").alias("doc_id"), "d1", "d2", "n"), ["doc_id", "d1", "d2", "n"]).withColumn("rid", F.xxhash64("doc_id", "d1")).dropDuplicates(["doc_id", "d1", "d2"])
    reps = materialise(reps.select("rid", "doc_id", "n", "regs"), "near-reps")
    lists = materialise(likely_pairs(reps, threshold), "near-lists")
    need = materialise(lists.select(F.explode("rids").alias("rid")).distinct().join(reps.select("rid", "doc_id"), "rid").select("doc_id").distinct(), "near-need")
    sets = materialise(needed_sets(docs, need, id_col, text_col, shingle), "near-sets")
    links = materialise(confirmed_links(lists, sets, threshold), "near-links")
    discard(lists, need, sets, reps)
    # an id that stands for several sets (repeated ids with different texts) ties its classes together
    label = components(links)
    whole = full.select("doc_id", "d1", "d2", "n").join(classes, ["d1", "d2", "n"])
    several = whole.groupBy("doc_id").agg(F.min("rep").alias("low"), F.max("rep").alias("high")).filter("low != high")
    if several.limit(1).count():
        extra = whole.join(several.select("doc_id"), "doc_id").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
        label = components(links.unionAll(extra))
    label = materialise(label, "near-labels")
    discard(links)
    mapped = made.join(classes, ["d1", "d2", "n"], "left").join(label.withColumnRenamed("node", "rep"), "rep", "left")
    component = F.coalesce("component", "rep", "doc_id")
    out = mapped.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), (F.col("doc_id") == component).alias("kept"))
    null = lambda c: F.when(F.col(c) != NULL_ID, F.col(c)).alias(c)
    return out.select(null("doc_id"), "n_shingles", null("component_id"), "kept")


def op8_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS words FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
    ELSE list_distinct(list_transform(range(1, len(words) - 3), lambda i: array_to_string(list_slice(words, i, i + 4), ' '))) END AS items FROM w
), n AS (SELECT doc_id, len(items) AS n FROM s),
c AS (
  SELECT list_sort(items) AS items, min(doc_id) AS rep, len(items) AS n FROM s WHERE len(items) > 0 GROUP BY ALL
), x AS (
  SELECT rep, n, unnest(items) AS item FROM c
), links AS (
  SELECT a.rep AS a, b.rep AS b FROM x a JOIN x b ON a.item = b.item AND a.rep < b.rep AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
  GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), e AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
r(node, low) AS (
  SELECT rep, rep FROM c
  UNION
  SELECT e.b, r.low FROM r JOIN e ON r.node = e.a WHERE r.low < e.b
), l AS (SELECT node, min(low) AS low FROM r GROUP BY node)
SELECT s.doc_id, CAST(len(s.items) AS BIGINT) AS n_shingles, coalesce(l.low, s.doc_id) AS component_id, s.doc_id = coalesce(l.low, s.doc_id) AS kept
FROM s LEFT JOIN c ON list_sort(s.items) = c.items LEFT JOIN l ON l.node = c.rep
"""
