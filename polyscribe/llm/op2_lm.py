"""Stupid-backoff language-model scores, each document against the rest of the corpus.

N-grams of one to three words over every whole text are counted in tables partitioned by hash, and every document's
exploded n-grams are joined back to them. Both sides travel packed (see ``common``): a block of documents sends each
hash shard the distinct n-grams that it has there with their counts, the shard adds the blocks' counts and answers
each block with the totals of its own n-grams, and the block looks its documents' n-grams up and sums per document.
A frequent n-gram is one entry a block, however often it occurs.

A document's own occurrences are taken off all counts before it is scored: c' is a count in the other documents.
A word w after u v scores c'(u v w) / c'(u v) if that is above 0, else ``ALPHA`` times c'(v w) / c'(v), else ``ALPHA``
squared times c'(w) / n', and a word that no other document has counts as ``ALPHA`` of one occurrence. n' is the other
documents' number of words, one at least. At a document's start there is less context and nothing is taken off for it.

Keys keep ``bits`` bits of a 64-bit hash, as many as make the chance that an n-gram meets another's key about 2**-27.

Defined cases. Null or wordless text: no words, score 0 and a null mean. A null id is a document like any other.
Rows that repeat an id are documents of their own. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from polyscribe.llm.common import blocks, cuts, discard, exchanged, forget_shuffles, id_array, materialise, open_block, pack, shards_for, table, unpack
from polyscribe.llm.kernels import row_of, shingle_hashes, word_hashes, word_spans

ALPHA, ORDER = 0.4, 3
_PART = pa.schema([("shard", pa.int32()), ("block", pa.int64()), ("n", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())])
_BACK = pa.schema([("block", pa.int64()), ("shard", pa.int32()), ("totals", pa.binary())])


class _Grams:
    """The words of one block and, for each order, the n-gram that begins at every word (where it fits its document)."""

    def __init__(self, row: dict, bits: int):
        self.ids, raw, offsets = open_block(row["ids"], row["lengths"], row["body"])
        starts, stops, self.at = word_spans(raw, offsets)
        self.h = word_hashes(raw, starts, stops)
        self.owner = row_of(self.at, len(self.h))
        self.bits = bits

    def order(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Where the document's n-grams begin (word numbers) and their keys."""
        keys = shingle_hashes(self.h, n, seed=40 + n)
        place = np.flatnonzero(self.owner[: len(keys)] == self.owner[n - 1 :]) if len(keys) else np.empty(0, np.int64)
        return place, keys[place] >> np.uint64(64 - self.bits)


_KINDS = ("shard int, block long, n long, keys binary, counts binary", "block long, shard int, totals binary")


def count_tables(held: DataFrame, order: int, bits: int, routes: int, inner: int, n_blocks: int) -> DataFrame:
    """(block, shard, totals): what the count table of each order's hash shard has for the block's own n-grams, in key order."""

    def send(batches):
        for batch in batches:
            for row in batch.to_pylist():
                g = _Grams(row, bits)
                for n in range(1, order + 1):
                    keys, counts = np.unique(g.order(n)[1], return_counts=True)
                    yield cut_up(keys, counts, row["block"], (n - 1) * routes, cuts(keys, routes, bits))

    def cut_up(keys, counts, block, first, at) -> pa.RecordBatch:
        out = {x: [] for x in _PART.names}
        for s, (i, j) in enumerate(zip(at[:-1], at[1:], strict=True)):
            if i < j:
                for k, v in zip(_PART.names, (first + s, block, j - i, pack(keys[i:j], True), pack(counts[i:j].astype(np.uint64))), strict=True):
                    out[k].append(v)
        return pa.RecordBatch.from_pydict(out, _PART)

    def opened(part):
        keys = np.concatenate([unpack(x.as_py(), np.uint64, True) for x in part["keys"]])
        return np.unique(keys, return_inverse=True)

    def summed(part):
        distinct, back = opened(part)
        counts = np.concatenate([unpack(x.as_py(), np.uint64) for x in part["counts"]])
        return distinct, back, np.bincount(back, counts, minlength=len(distinct)).astype(np.uint64)

    def told(part, totals) -> pa.Table:
        at = np.cumsum(part["n"].to_numpy())[:-1]
        return pa.table([part["block"], part["shard"], pa.array([pack(x) for x in np.split(totals, at)], pa.binary())], schema=_BACK)

    def merge(part: pa.Table) -> pa.Table:
        _, back, totals = summed(part)
        return told(part, totals[back])

    def combine(part: pa.Table, route: int) -> pa.Table:
        distinct, _, totals = summed(part)
        return pa.Table.from_batches([cut_up(distinct, totals, 0, route * inner, cuts(distinct, inner, bits, route % routes * inner, routes * inner))])

    def answer(part: pa.Table, answers: pa.Table, route: int) -> pa.Table:
        return told(part, np.concatenate([unpack(x.as_py(), np.uint64) for x in answers["totals"]])[opened(part)[1]])

    sent = held.mapInArrow(send, _KINDS[0])
    return exchanged(sent, n_blocks, routes, inner, combine, merge, answer, _KINDS, "lm-sent")


def _elsewhere(g: _Grams, n: int, answers: dict, shards: int) -> np.ndarray:
    """For the n-gram that begins at each word, its count outside of its document; -1 where none begins."""
    place, keys = g.order(n)
    out = np.full(len(g.h), -1, np.int64)
    if not len(place):
        return out
    distinct, back = np.unique(keys, return_inverse=True)
    cut = cuts(distinct, shards, g.bits)
    totals = np.concatenate([unpack(answers[(n - 1) * shards + s], np.uint64) for s in range(shards) if cut[s] < cut[s + 1]])
    _, where, own = np.unique(g.owner[place] * len(distinct) + back, return_inverse=True, return_counts=True)
    out[place] = totals[back].astype(np.int64) - own[where]
    return out


FIELDS = [("doc_id", pa.int64()), ("n_words", pa.int64()), *((x, pa.int64()) for x in ("hits3", "hits2", "hits1", "unseen")), ("log_score", pa.float64()), ("mean_log_score", pa.float64())]


def lm_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", alpha: float = ALPHA) -> DataFrame:
    """Per document: doc_id, n_words, how many words each order scored and how many were unseen, the sum and mean of log10 scores."""
    held = materialise(blocks(docs, id_col, text_col, 8_000_000), "lm-blocks")
    total, n_blocks = held.agg(F.sum("n_words"), F.count("*")).first()
    total = total or 0
    bits = min(64, max(32, int(total * ORDER).bit_length() + 27))
    shards, inner = shards_for(max(total, 24 * 4_000_000), 4_000_000)
    answers = materialise(count_tables(held, ORDER, bits, shards, inner, n_blocks), "lm-counts")
    forget_shuffles(docs.sparkSession)  # the packed n-grams, the largest data on disk, are answered
    listed = answers.groupBy("block").agg(F.collect_list(F.struct("shard", "totals")).alias("answers"))

    def finish(batches):
        for batch in batches:
            for row in batch.to_pylist():
                g = _Grams(row, bits)
                known = {x["shard"]: x["totals"] for x in row["answers"] or []}
                one, two, three = (_elsewhere(g, n, known, shards) for n in range(1, ORDER + 1))
                size, words = len(g.h), np.diff(g.at)
                others = np.maximum(total - words, 1)[g.owner].astype(np.float64)
                score, left, level = np.zeros(size), np.ones(size, bool), np.zeros(size, np.int64)
                back = np.zeros(size)  # times that alpha applies so far
                for n, counts, context in ((3, three, two), (2, two, one)):
                    # the n-gram that ends at word p begins at p - n + 1
                    c = np.concatenate([np.full(min(n - 1, size), -1), counts[: max(0, size - n + 1)]])
                    d = np.concatenate([np.full(min(n - 1, size), -1), context[: max(0, size - n + 1)]])
                    hit = left & (c > 0)
                    score[hit] = np.log10(c[hit] / d[hit]) + back[hit] * np.log10(alpha)
                    level[hit] = n
                    left &= ~hit
                    back += left & (c >= 0)
                seen = left & (one > 0)
                score[seen] = np.log10(one[seen] / others[seen]) + back[seen] * np.log10(alpha)
                level[seen] = 1
                new = left & ~seen
                score[new] = (back[new] + 1) * np.log10(alpha) - np.log10(others[new])
                per = lambda x, g=g: np.bincount(g.owner, x, minlength=len(g.ids))
                sums = per(score)
                yield pa.RecordBatch.from_arrays(
                    [id_array(g.ids), pa.array(words), *(pa.array(per(level == k).astype(np.int64)) for k in (3, 2, 1, 0)), pa.array(sums), pa.array(sums / np.maximum(words, 1), mask=words == 0)],
                    schema=pa.schema(FIELDS),
                )

    joined = held.join(listed.hint("shuffle_hash"), "block", "left")
    out = materialise(joined.mapInArrow(finish, ", ".join(f"{x} {'double' if t == pa.float64() else 'long'}" for x, t in FIELDS)), "lm-scores")
    discard(held, answers)
    return out


def op2_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lm_scores(table(spark, sf_dir, "documents"))
    return out.withColumns({x: F.round(x, 4) for x in ("log_score", "mean_log_score")})


SQL = r"""
WITH w AS (
  SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS words FROM documents
), t AS (
  SELECT doc_id, unnest(words) AS w, unnest(range(1, len(words) + 1)) AS p FROM w
), g AS (
  SELECT doc_id, p, w, lag(w) OVER d AS v, lag(w, 2) OVER d AS u FROM t WINDOW d AS (PARTITION BY doc_id ORDER BY p)
), one AS (SELECT w, count(*) AS n FROM g GROUP BY w),
two AS (SELECT v, w, count(*) AS n FROM g WHERE v IS NOT NULL GROUP BY v, w),
three AS (SELECT u, v, w, count(*) AS n FROM g WHERE u IS NOT NULL GROUP BY u, v, w),
own1 AS (SELECT doc_id, w, count(*) AS n FROM g GROUP BY ALL),
own2 AS (SELECT doc_id, v, w, count(*) AS n FROM g WHERE v IS NOT NULL GROUP BY ALL),
own3 AS (SELECT doc_id, u, v, w, count(*) AS n FROM g WHERE u IS NOT NULL GROUP BY ALL),
c1 AS (SELECT doc_id, w, one.n - own1.n AS n FROM own1 JOIN one USING (w)),
c2 AS (SELECT doc_id, v, w, two.n - own2.n AS n FROM own2 JOIN two USING (v, w)),
c3 AS (SELECT doc_id, u, v, w, three.n - own3.n AS n FROM own3 JOIN three USING (u, v, w)),
s AS (SELECT doc_id, greatest((SELECT count(*) FROM t) - len(words), 1)::DOUBLE AS others FROM w),
x AS (
  SELECT g.doc_id, g.u IS NOT NULL AS has3, g.v IS NOT NULL AS has2, c3.n AS n3, k3.n AS d3, c2.n AS n2, k2.n AS d2, c1.n AS n1, others
  FROM g JOIN s USING (doc_id) JOIN c1 ON c1.doc_id = g.doc_id AND c1.w = g.w
  LEFT JOIN c2 ON c2.doc_id = g.doc_id AND c2.v = g.v AND c2.w = g.w
  LEFT JOIN c3 ON c3.doc_id = g.doc_id AND c3.u = g.u AND c3.v = g.v AND c3.w = g.w
  LEFT JOIN c2 k3 ON k3.doc_id = g.doc_id AND k3.v = g.u AND k3.w = g.v
  LEFT JOIN c1 k2 ON k2.doc_id = g.doc_id AND k2.w = g.v
), y AS (
  SELECT doc_id,
    CASE WHEN n3 > 0 THEN 3 WHEN n2 > 0 THEN 2 WHEN n1 > 0 THEN 1 ELSE 0 END AS level,
    CASE WHEN n3 > 0 THEN log10(n3::DOUBLE / d3)
         WHEN n2 > 0 THEN log10(n2::DOUBLE / d2) + has3::INT * log10(0.4)
         WHEN n1 > 0 THEN log10(n1::DOUBLE / others) + (has3::INT + has2::INT) * log10(0.4)
         ELSE (has3::INT + has2::INT + 1) * log10(0.4) - log10(others) END AS score
  FROM x
), z AS (
  SELECT doc_id, count(*) AS n, count(*) FILTER (level = 3) AS h3, count(*) FILTER (level = 2) AS h2, count(*) FILTER (level = 1) AS h1, count(*) FILTER (level = 0) AS h0, sum(score) AS total FROM y GROUP BY doc_id
)
SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(h3, 0) AS hits3, coalesce(h2, 0) AS hits2, coalesce(h1, 0) AS hits1, coalesce(h0, 0) AS unseen,
       round(coalesce(total, 0.0), 4) AS log_score, round(total / n, 4) AS mean_log_score
FROM w LEFT JOIN z USING (doc_id)
"""
