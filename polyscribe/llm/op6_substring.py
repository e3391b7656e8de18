"""Exact substring dedup over windows of n words, with a partitioned count-min prefilter.

1. Documents become blocks (``common.blocks``), written once.
2. Every block counts its windows in sparse, saturating count-min rows and sends each row's slices to
   their shards; a shard merges the blocks' sketches by addition and tells each block which of its
   counters reached two. Counters never underestimate, so every repeated window is among the estimated
   ones; the sketch's width follows the number of windows, and each block gets back only its own bits.
3. Only windows whose counters all reached two go on. Each block sends their 96-bit hashes once, with
   the first (doc_id, position) it has of each; shards find the first of all and answer with one bit.
4. Blocks mark the words covered by windows that start earlier elsewhere.

A window shared by any number of documents is one entry a block, so no key grows with its copies.

Defined cases. Null text: no words. A null id sorts before all others. Rows that repeat one id count as one
document at equal positions: neither removes the other. Documents shorter than a window keep
every word. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from polyscribe.llm.common import blocks, cuts, discard, exchanged, id_array, materialise, open_block, pack, pack_bits, shards_for, table, unpack, unpack_bits
from polyscribe.llm.kernels import mix, row_of, shingle_hashes, word_hashes, word_spans

N_WORDS = 20
DEPTH = 2
#: Counters of a sketch row for each window.
LOAD = 4
_SEEDS = [0x243F6A8885A308D3, 0x13198A2E03707344, 0xA4093822299F31D0, 0x082EFA98EC4E6C89]


class _Windows:
    """The windows of one block: first hash, place (word number), and what it takes to go back to documents."""

    def __init__(self, row: dict, n: int):
        self.ids, self.raw, self.offsets = open_block(row["ids"], row["lengths"], row["body"])
        self.starts, self.stops, self.at = word_spans(self.raw, self.offsets)
        self.h = word_hashes(self.raw, self.starts, self.stops)
        self.owner = row_of(self.at, len(self.h))
        first = shingle_hashes(self.h, n)
        whole = self.owner[: len(first)] == self.owner[n - 1 :] if len(first) else np.empty(0, bool)
        self.place = np.flatnonzero(whole)
        self.hash = first[self.place]
        self.n = n

    def second(self, chosen: np.ndarray) -> np.ndarray:
        return (shingle_hashes(self.h, self.n, seed=7)[self.place[chosen]] >> np.uint64(32)).astype(np.uint32)

    def counters(self, r: int, bits: int) -> np.ndarray:
        return mix(self.hash ^ np.uint64(_SEEDS[r])) >> np.uint64(64 - bits)


def _rows(batches):
    for batch in batches:
        names = batch.schema.names
        for i in range(batch.num_rows):
            yield {x: batch.column(k)[i].as_py() for k, x in enumerate(names)}


_PART = pa.schema([("shard", pa.int32()), ("block", pa.int64()), ("n", pa.int64()), ("a", pa.binary()), ("b", pa.binary()), ("c", pa.binary()), ("d", pa.binary())])
_PART_SQL = "shard int, block long, n long, a binary, b binary, c binary, d binary"
_BACK = pa.schema([("block", pa.int64()), ("shard", pa.int32()), ("bits", pa.binary())])
_BACK_SQL = "block long, shard int, bits binary"


def _told(part: pa.Table, bits: np.ndarray) -> pa.Table:
    """One answer a row: its own stretch of the bits."""
    at = np.cumsum(part["n"].to_numpy())[:-1]
    return pa.table([part["block"], part["shard"], pa.array([pack_bits(x) for x in np.split(bits, at)], pa.binary())], schema=_BACK)


def _cut_up(block: int, first: int, at: np.ndarray, pack_row) -> pa.RecordBatch:
    """A row for each stretch that holds anything; ``pack_row(i, j)`` gives its four values."""
    out = {x: [] for x in _PART.names}
    for s, (i, j) in enumerate(zip(at[:-1], at[1:], strict=True)):
        if i < j:
            for k, v in zip(_PART.names, (first + s, block, j - i, *pack_row(i, j)), strict=True):
                out[k].append(v)
    return pa.RecordBatch.from_pydict(out, _PART)


def _stretches(answers: pa.Table, at: np.ndarray) -> np.ndarray:
    """The bits of answers, which are in the order of the stretches that hold anything."""
    sizes = np.diff(at)
    told = [unpack_bits(x.as_py(), n) for x, n in zip(answers["bits"], sizes[sizes > 0], strict=True)]
    return np.concatenate(told)


def repeated_bits(held: DataFrame, n: int, bits: int, routes: int, inner: int, n_blocks: int) -> DataFrame:
    """(block, shard, bits): for each sketch row's slice of a block, which of its counters reached two in the merged sketch."""

    def slices(u, more, block, first, at):
        return _cut_up(block, first, at, lambda i, j: (pack(u[i:j], True), pack_bits(more[i:j]), b"", b""))

    def send(batches):
        for row in _rows(batches):
            w = _Windows(row, n)
            for r in range(DEPTH):
                u, counts = np.unique(w.counters(r, bits), return_counts=True)
                yield slices(u, counts > 1, row["block"], r * routes, cuts(u, routes, bits))

    def summed(part):
        where = np.concatenate([unpack(x.as_py(), np.uint64, True) for x in part["a"]])
        more = np.concatenate([unpack_bits(x.as_py(), k) for x, k in zip(part["b"], part["n"].to_numpy(), strict=True)])
        u, back = np.unique(where, return_inverse=True)
        return u, back, np.bincount(back, 1 + more, minlength=len(u)) > 1

    def merge(part: pa.Table) -> pa.Table:
        _, back, repeated = summed(part)
        return _told(part, repeated[back])

    inside = lambda u, route: cuts(u, inner, bits, route % routes * inner, routes * inner)

    def combine(part: pa.Table, route: int) -> pa.Table:
        u, _, repeated = summed(part)
        return pa.Table.from_batches([slices(u, repeated, 0, route * inner, inside(u, route))])

    def answer(part: pa.Table, answers: pa.Table, route: int) -> pa.Table:
        u, back, _ = summed(part)
        return _told(part, _stretches(answers, inside(u, route))[back])

    return exchanged(held.mapInArrow(send, _PART_SQL), n_blocks, routes, inner, combine, merge, answer, (_PART_SQL, _BACK_SQL), "substring-sent")


def _answers(answers: list, key: int) -> dict:
    return {x["shard"]: x["bits"] for x in answers or [] if x["kind"] == key}


def _estimated(w: _Windows, answers: dict, bits: int, shards: int) -> np.ndarray:
    """Of each window of the block, whether all its counters reached two."""
    flag = np.ones(len(w.hash), bool)
    for r in range(DEPTH):
        u, back = np.unique(w.counters(r, bits), return_inverse=True)
        cut = cuts(u, shards, bits)
        known = [unpack_bits(answers[r * shards + s], cut[s + 1] - cut[s]) for s in range(shards) if cut[s] < cut[s + 1]]
        if known:
            flag &= np.concatenate(known)[back]
    return flag


def _candidates(w: _Windows, flag: np.ndarray):
    """Estimated windows in the order (hash, second hash, doc_id, position), and where each distinct one begins."""
    chosen = np.flatnonzero(flag)
    h1, h2, place = w.hash[chosen], w.second(chosen), w.place[chosen]
    doc, pos = w.ids[w.owner[place]], (place - w.at[w.owner[place]]).astype(np.uint32)
    order = np.lexsort((pos, doc, h2, h1))
    h1, h2, doc, pos, place = h1[order], h2[order], doc[order], pos[order], place[order]
    new = np.ones(len(h1), bool)
    new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
    return h1, h2, doc, pos, place, np.flatnonzero(new)


def first_bits(held: DataFrame, n: int, bits: int, sketch_shards: int, routes: int, inner: int, n_blocks: int) -> DataFrame:
    """(block, shard, bits): for each distinct estimated window of a block, whether no other block has it earlier."""

    def slices(h1, h2, doc, pos, block, first, at):
        return _cut_up(block, first, at, lambda i, j: (pack(h1[i:j], True), pack(h2[i:j]), pack(doc[i:j]), pack(pos[i:j])))

    def send(batches):
        for row in _rows(batches):
            w = _Windows(row, n)
            h1, h2, doc, pos, _, new = _candidates(w, _estimated(w, _answers(row["answers"], 1), bits, sketch_shards))
            yield slices(h1[new], h2[new], doc[new], pos[new], row["block"], 0, cuts(h1[new], routes, 64))

    def ordered(part):
        """The rows' entries in the order (hash, second hash, doc_id, position), that order, and each one's window's number and first entry."""
        join = lambda x, kind, delta=False: np.concatenate([unpack(v.as_py(), kind, delta) for v in part[x]])
        h1, h2, doc, pos = join("a", np.uint64, True), join("b", np.uint32), join("c", np.int64), join("d", np.uint32)
        order = np.lexsort((pos, doc, h2, h1))
        h1, h2, doc, pos = h1[order], h2[order], doc[order], pos[order]
        new = np.ones(len(h1), bool)
        new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        return h1, h2, doc, pos, order, np.flatnonzero(new), np.cumsum(new) - 1

    def firsts(part, wins=None) -> pa.Table:
        """Which entries are their window's first here, and where ``wins`` is given (by window) elsewhere too."""
        _, _, doc, pos, order, begin, number = ordered(part)
        lead = begin[number]
        first = np.empty(len(doc), bool)
        first[order] = (doc == doc[lead]) & (pos == pos[lead]) & (wins[number] if wins is not None else True)
        return _told(part, first)

    def merge(part: pa.Table) -> pa.Table:
        return firsts(part)

    def combine(part: pa.Table, route: int) -> pa.Table:
        h1, h2, doc, pos, _, begin, _ = ordered(part)
        h1 = h1[begin]
        return pa.Table.from_batches([slices(h1, h2[begin], doc[begin], pos[begin], 0, route * inner, cuts(h1, inner, 64, route * inner, routes * inner))])

    def answer(part: pa.Table, answers: pa.Table, route: int) -> pa.Table:
        h1, _, _, _, _, begin, _ = ordered(part)
        return firsts(part, _stretches(answers, cuts(h1[begin], inner, 64, route * inner, routes * inner)))

    return exchanged(held.mapInArrow(send, _PART_SQL), n_blocks, routes, inner, combine, merge, answer, (_PART_SQL, _BACK_SQL), "substring-windows")


def _with_answers(held: DataFrame, answers: DataFrame) -> DataFrame:
    """Blocks with the answers they got; both sides have unique or few rows a block."""
    listed = answers.groupBy("block").agg(F.collect_list(F.struct("kind", "shard", "bits")).alias("answers"))
    return held.join(listed.hint("shuffle_hash"), "block", "left")


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = N_WORDS, with_text: bool = False) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept_sha256 and, if asked for, kept (the remaining words)."""
    held = materialise(blocks(docs, id_col, text_col, 4_000_000), "substring-blocks")
    total, n_blocks = held.agg(F.sum("n_words"), F.count("*")).first()
    total = total or 0
    bits = max(12, (LOAD * total - 1).bit_length()) if total else 12
    sketch_shards, inner = shards_for(total, 4_000_000)
    repeated = materialise(repeated_bits(held, n, bits, sketch_shards, inner, n_blocks).withColumn("kind", F.lit(1)), "substring-repeated")
    shards, inner = shards_for(total / 2, 2_000_000)
    first = materialise(first_bits(_with_answers(held, repeated), n, bits, sketch_shards, shards, inner, n_blocks).withColumn("kind", F.lit(2)), "substring-first")
    fields = [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), *([("kept", pa.string())] if with_text else [])]

    def finish(batches):
        for row in _rows(batches):
            w = _Windows(row, n)
            h1, _, doc, pos, place, new = _candidates(w, _estimated(w, _answers(row["answers"], 1), bits, sketch_shards))
            known, cut = _answers(row["answers"], 2), cuts(h1[new], shards, 64)
            told = [unpack_bits(known[s], cut[s + 1] - cut[s]) for s in range(shards) if cut[s] < cut[s + 1]]
            edge = np.zeros(len(w.h) + 1, np.int64)
            if told:
                group = np.repeat(np.arange(len(new)), np.diff(np.append(new, len(h1))))
                lead = new[group]
                gone = place[~(np.concatenate(told)[group] & (doc == doc[lead]) & (pos == pos[lead]))]
                np.add.at(edge, gone, 1)
                np.add.at(edge, gone + n, -1)
            keep = np.cumsum(edge)[: len(w.h)] == 0
            removed = np.diff(np.concatenate([[0], np.cumsum(~keep)])[w.at])
            data = w.raw.tobytes()
            kept = []
            for d in range(len(w.ids)):
                words = data[w.offsets[d] : w.offsets[d + 1]].split()
                kept.append(b" ".join(compress(words, keep[w.at[d] : w.at[d + 1]].tolist()) if removed[d] else words))
            columns = [id_array(w.ids), pa.array(np.diff(w.at)), pa.array(removed), pa.array([hashlib.sha256(x).hexdigest() for x in kept])]
            yield pa.RecordBatch.from_arrays(columns + ([pa.array(kept, pa.binary()).cast(pa.string())] if with_text else []), schema=pa.schema(fields))

    out = materialise(
        _with_answers(held, repeated.unionByName(first)).mapInArrow(finish, "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept string" * with_text),
        "substring-result",
    )
    discard(held, repeated, first)
    return out


def op6_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents"))


SQL = r"""
WITH w AS (
  SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS words FROM documents
), win AS (
  SELECT doc_id, unnest(range(1, len(words) - 18)) AS p, words FROM w WHERE len(words) >= 20
), k AS (
  SELECT doc_id, p, array_to_string(list_slice(words, p, p + 19), ' ') AS seq FROM win
), f AS (
  SELECT doc_id, p, row_number() OVER (PARTITION BY seq ORDER BY doc_id, p) > 1 AS again FROM k
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(p, p + 20)) AS q FROM f WHERE again
), words AS (
  SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS q FROM w
), kept AS (
  SELECT doc_id, CAST(count(*) FILTER (WHERE g.q IS NOT NULL) AS BIGINT) AS n_removed,
         string_agg(word, ' ' ORDER BY q) FILTER (WHERE g.q IS NULL) AS body
  FROM words LEFT JOIN gone g USING (doc_id, q) GROUP BY doc_id
)
SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(body, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""
