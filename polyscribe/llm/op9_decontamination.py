"""Benchmark decontamination: a BM25 inverted index of test items, searched by every passage with block-max WAND.

1. Items become postings (term, item, weight). The weight is the term's BM25 contribution to the item divided by the
   item's score for its own text, so that a passage's score is the share of the item's evidence that it holds and one
   threshold fits items of all lengths. Document frequencies and lengths are taken over all items.
2. Every whole document is cut into passages of ``2 * half`` words, one every ``half`` words, where ``half`` is no less
   than the item: each run of words as long as the item lies whole in some passage. ``half`` is 64, or the next power of
   two for longer items; items of one ``half`` share an index.
3. Each passage queries the index for all items at or above ``threshold`` by block-max WAND, many passages at a time:
   a passage whose terms' largest weights cannot sum to the threshold holds no pivot and ends there; else block maxima
   bound its score in every block of 64 items, in the blocks that reach the threshold every block of 8, and in those
   of these that do the items themselves. Nothing at or above the threshold is passed over.
4. A retrieved pair is verified: enough of the question's and of the answer's word n-grams must stand in the passage.
   The answer is what follows the last sentence end inside the item; an item of one sentence is cut after two thirds.
   A part without words, or with one word that one edit undoes, may instead reach the overlap by the n-grams of the
   whole item; the larger of the two shares is given.

The index is sent to the executors in shards of about ``SHARD_WORDS`` item words each, one scan of the documents and one
index on the executors at a time, so the size of what is broadcast is bounded however long the list of items is.
Weights are whole numbers of 1e-12, so that an item that stands whole in two passages scores the same in both; then the
larger overlaps and the earlier passage hold.

Words are runs of ASCII letters and digits and of non-ASCII characters; A-Z are lower-cased.

Defined cases. Null or empty texts, of documents or items, match nothing. Items that repeat id and text are one; items of
one text and several ids are all reported. A null item_id or doc_id is reported as null. Rows that repeat a doc_id are
reported for each. Empty tables give an empty result. Other columns are ignored.
"""

from __future__ import annotations

from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from polyscribe.llm.common import NULL_ID, discard, id_array, materialise, table

K1, B = 1.2, 0.75
THRESHOLD, OVERLAP, HALF = 0.5, 0.5, 64
#: Parts of at least LONG words are compared by n-grams, shorter ones by single words, so that one edit cannot undo them.
NGRAM, LONG = 3, 9
#: Items of a block on each level of maxima, down to single items.
WIDTHS = (64, 8, 1)
#: Cells of the first level looked at at once.
CELLS = 400_000
#: Weights are whole numbers of 1 / UNIT, so that sums are exact in any order and equal scores are equal.
UNIT = 10**12
SHARD_WORDS = 1_000_000
_FOLD = np.full(256, 0x20, np.uint8)
_FOLD[48:58], _FOLD[97:123], _FOLD[128:] = np.arange(48, 58), np.arange(97, 123), np.arange(128, 256)
_FOLD[65:91] = np.arange(97, 123)


def folded_words(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of each text, and where each text's begin (rows + 1)."""
    from polyscribe.llm.kernels import word_hashes, word_spans

    raw = _FOLD[raw]
    starts, stops, at = word_spans(raw, offsets)
    return word_hashes(raw, starts, stops), at


def _hashes(text: str) -> np.ndarray:
    raw = np.frombuffer(text.encode(), np.uint8)
    return folded_words(raw, np.array([0, len(raw)]))[0]


def split_item(text: str) -> tuple[str, str]:
    """(question, answer) of an item's text."""
    import re

    words = re.findall("[^\x20\x09-\x0d]+", text)
    ends = [i + 1 for i, w in enumerate(words[:-1]) if w[-1] in ".!?"]
    cut = ends[-1] if ends else ceil(2 * len(words) / 3)
    return " ".join(words[:cut]), " ".join(words[cut:] if cut < len(words) else words)


def ngrams(h: np.ndarray, n: int) -> np.ndarray:
    """Distinct hashes of n consecutive words."""
    from polyscribe.llm.kernels import shingle_hashes

    return np.unique(shingle_hashes(h, n, seed=50 + n))


def part_ngrams(text: str) -> tuple[int, np.ndarray]:
    """(n, the distinct n-grams) of a question or answer."""
    h = _hashes(text)
    n = NGRAM if len(h) >= LONG else 1
    return n, ngrams(h, n)


def whole_ngrams(text: str) -> tuple[int, np.ndarray]:
    """(n, the distinct n-grams) of a whole item: never single words, where it has more, as these stand in many passages."""
    h = _hashes(text)
    n = max(1, min(NGRAM, len(h)))
    return n, ngrams(h, n)


class Level:
    """Cells (term, block of ``width`` items) with the largest weight in each; blocks of one item are the postings themselves."""

    def __init__(self, term: np.ndarray, item: np.ndarray, weight: np.ndarray, width: int):
        """Postings in the order (term, item)."""
        block = item // width
        new = np.ones(len(term), bool)
        new[1:] = (term[1:] != term[:-1]) | (block[1:] != block[:-1])
        self.at = np.flatnonzero(new)
        self.block = block[self.at]
        self.top = np.maximum.reduceat(weight, self.at) if len(term) else np.empty(0)


class Index:
    """Posting lists of one shard's items by term, with the maxima that block-max WAND needs."""

    def __init__(self, items: list[tuple], postings: list[tuple], half: int):
        """items: (uid, item_id, text); postings: (uid, term, weight in whole units of 1 / UNIT)."""
        # items of like length have like weights, which keeps a block's maxima near its items' weights
        items = sorted(items, key=lambda x: (len(x[2]), x[0]))
        number = {uid: k for k, (uid, _, _) in enumerate(items)}
        self.ids = [i for _, i, _ in items]
        self.parts = [tuple(part_ngrams(p) for p in split_item(t)) for _, _, t in items]
        self.whole = [whole_ngrams(t) if min(len(g) for _, g in parts) < 2 else None for (_, _, t), parts in zip(items, self.parts, strict=True)]
        self.half = half
        term = np.array([t for _, t, _ in postings], np.int64).view(np.uint64)
        item = np.array([number[u] for u, _, _ in postings], np.int64)
        weight = np.array([w for _, _, w in postings], np.float64)
        order = np.lexsort((item, term))
        term, item, weight = term[order], item[order], weight[order]
        self.terms, begin = np.unique(term, return_index=True)
        self.top = np.maximum.reduceat(weight, begin) if len(term) else np.empty(0)
        self.n_blocks = len(items) // WIDTHS[0] + 1
        self.levels = [Level(term, item, weight, w) for w in WIDTHS]
        # where each term's cells begin on the first level, and each cell's on the next level
        self.begin = np.searchsorted(self.levels[0].at, np.append(begin, len(term)))
        self.inner = [np.searchsorted(low.at, np.append(high.at, len(term))) for high, low in zip(self.levels[:-1], self.levels[1:], strict=True)]

    def search(self, passage: np.ndarray, term: np.ndarray, least: float):
        """(passage, item number, score) of all items at or above ``least``, for passages numbered from 0 and their distinct terms.

        Block-max WAND for many passages at once: a (passage, block) cell whose maxima cannot reach ``least`` holds no pivot and is left with
        all its postings; the others are cut into smaller blocks, down to single items, whose maxima are their scores.
        """
        edge = np.searchsorted(passage, np.arange((int(passage[-1]) if len(passage) else -1) + 2))
        many = np.diff(self.begin)[term]
        ends = np.concatenate([[0], np.cumsum(many)])
        i, n = 0, len(edge) - 1
        while i < n:  # some hundred thousand cells of the first level at a time
            j = max(i + 1, int(np.searchsorted(ends[edge], ends[edge[i]] + CELLS, "right")) - 1)
            j = min(j, i + max(1, 8 * CELLS // self.n_blocks), n)
            a, b = edge[i], edge[j]
            count = many[a:b]
            cell = _ranges(self.begin[term[a:b]], count)
            key = np.repeat((passage[a:b] - i) * self.n_blocks, count) + self.levels[0].block[cell]
            row, block, size = np.arange((j - i) * self.n_blocks) // self.n_blocks, np.arange((j - i) * self.n_blocks) % self.n_blocks, (j - i) * self.n_blocks
            for k, level in enumerate(self.levels):
                bound = np.bincount(key, level.top[cell], minlength=size)
                alive = bound >= least
                row, block = row[alive], block[alive]
                if not len(row):
                    break
                if k + 1 == len(self.levels):
                    yield row + i, block, bound[alive]
                    break
                ratio = WIDTHS[k] // WIDTHS[k + 1]
                stays = alive[key]
                kept, cell = (np.cumsum(alive) - 1)[key[stays]], cell[stays]
                count = np.diff(self.inner[k])[cell]
                cell = _ranges(self.inner[k][cell], count)
                key = np.repeat((kept - block[kept]) * ratio, count) + self.levels[k + 1].block[cell]
                row, block, size = np.repeat(row, ratio), np.repeat(block * ratio, ratio) + np.tile(np.arange(ratio), len(block)), len(row) * ratio
            i = j

    def matches(self, h: np.ndarray, at: np.ndarray, threshold: float, overlap: float):
        """(text, item number, score, question overlap, answer overlap, passage's first word) of verified pairs, the best passage of each."""
        from polyscribe.llm.kernels import row_of

        if not len(self.terms) or not len(h):
            return []
        where = np.minimum(np.searchsorted(self.terms, h), len(self.terms) - 1)
        known = np.flatnonzero(self.terms[where] == h)
        if not len(known):
            return []
        term, owner = where[known], row_of(at, len(h))[known]
        step = (known - at[owner]) // self.half
        # passages are numbered so that the one which begins at word half * s of a text is base + s
        steps = np.diff(at) // self.half + 1
        base = np.concatenate([[0], np.cumsum(steps)])
        passage = np.concatenate([base[owner] + step, (base[owner] + step - 1)[step > 0]])
        key = np.unique(passage * len(self.terms) + np.concatenate([term, term[step > 0]]))
        passage, term = key // len(self.terms), key % len(self.terms)
        least = round(threshold * UNIT) - UNIT // 10**9
        hopeful = (np.bincount(passage, self.top[term], minlength=base[-1]) >= least)[passage]
        names, passage = np.unique(passage[hopeful], return_inverse=True)
        best: dict[tuple[int, int], tuple] = {}
        for rows, items, scores in self.search(passage, term[hopeful], least):
            before = None
            for p, item, score in zip(names[rows].tolist(), items.tolist(), scores.tolist(), strict=True):
                if p != before:
                    before, text = p, int(np.searchsorted(base, p, "right")) - 1
                    first = int(p - base[text]) * self.half
                    words = h[at[text] + first : min(at[text] + first + 2 * self.half, at[text + 1])]
                    here = {n: ngrams(words, n) for n in range(1, NGRAM + 1)}
                share = lambda n, grams, here=here: float(np.isin(grams, here[n]).mean()) if len(grams) else 0.0
                shares = [share(n, part) for n, part in self.parts[item]]
                if self.whole[item] is not None and min(shares) < 1:
                    whole = share(*self.whole[item])
                    shares = [max(x, whole) if len(part) < 2 else x for x, (_, part) in zip(shares, self.parts[item], strict=True)]
                if min(shares) >= overlap - 1e-9:
                    row = (score / UNIT, *shares, first)
                    old = best.get((text, item))
                    if old is None or (row[:3], -first) > (old[:3], -old[3]):
                        best[text, item] = row
        return [(*k, *v) for k, v in sorted(best.items())]


def _ranges(begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """begin[0], begin[0] + 1, ... (count[0] values), begin[1], ..."""
    return np.repeat(begin - (np.cumsum(count) - count), count) + np.arange(count.sum())


def weighted_postings(items: DataFrame) -> DataFrame:
    """uid, term, weight of items (uid, text): BM25 contributions as shares of the item's score for itself, in units of 1 / UNIT."""
    from polyscribe.llm.kernels import column_bytes, row_of

    def compute(batches):
        for batch in batches:
            raw, offsets = column_bytes(batch.column(1))
            h, at = folded_words(raw, offsets)
            owner = row_of(at, len(h))
            order = np.lexsort((h, owner))
            h, owner = h[order], owner[order]
            new = np.ones(len(h), bool)
            new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
            lead = np.flatnonzero(new)
            tf = np.diff(np.append(lead, len(h)))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(owner[lead])), pa.array(h[lead].view(np.int64)), pa.array(tf), pa.array(np.diff(at)[owner[lead]])], ["uid", "term", "tf", "size"])

    counts = materialise(items.select("uid", "text").mapInArrow(compute, "uid long, term long, tf long, size long"), "bm25-counts")
    total = counts.select("uid", "size").distinct().agg(F.count("*"), F.avg("size")).first()
    n, mean = total[0], total[1] or 1.0
    df = counts.groupBy("term").agg(F.count("*").alias("df"))
    idf = F.log(1 + (n - F.col("df") + 0.5) / (F.col("df") + 0.5))
    part = idf * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("size") / mean))
    scored = materialise(counts.join(df, "term").select("uid", "term", part.alias("part")), "bm25-parts")
    own = scored.groupBy("uid").agg(F.sum("part").alias("own"))
    out = materialise(scored.join(own, "uid").select("uid", "term", F.round(F.col("part") / F.col("own") * UNIT).cast("long").alias("weight")), "bm25-weights")
    discard(counts, scored)
    return out


FIELDS = [("doc_id", pa.int64()), ("item_id", pa.int64()), ("score", pa.float64()), ("question_overlap", pa.float64()), ("answer_overlap", pa.float64()), ("first_word", pa.int64())]
SCHEMA = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double, first_word long"


def item_indexes(items: DataFrame, shard_words: int = SHARD_WORDS):
    """Indexes of the items one after the other, each of items of one length class and bounded by its number of words.

    A class holds the items of up to ``half`` words, a power of two and HALF at least, so that no item's passages are as long as another's need.
    """
    listed = items.select(F.coalesce(F.col("item_id").cast("long"), F.lit(NULL_ID)).alias("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).distinct()
    words = F.size(F.split("text", r"[^0-9A-Za-z\x{80}-\x{10FFFF}]+"))
    half = F.greatest(F.lit(HALF), F.expr("shiftleft(1, length(bin(words - 1)))"))
    listed = materialise(listed.withColumn("uid", F.xxhash64("item_id", "text")).withColumn("words", words).withColumn("half", half), "bm25-items")
    weights = weighted_postings(listed)
    classes = [tuple(r) for r in listed.groupBy("half").agg(F.sum("words")).orderBy("half").collect()]
    classed = materialise(weights.join(listed.select("uid", "half"), "uid"), "bm25-classed") if len(classes) > 1 else weights.withColumn("half", F.lit(classes[0][0] if classes else HALF))
    for half, total in classes:
        shards = max(1, -(-total // shard_words))
        shard = F.pmod(F.xxhash64(F.col("uid")), F.lit(shards))
        for k in range(shards):
            part = lambda df, *columns: [tuple(r) for r in df.filter((F.col("half") == half) & (shard == k)).select(*columns).collect()]  # noqa: B023, E731
            yield Index(part(listed, "uid", "item_id", "text"), part(classed, "uid", "term", "weight"), half)
    discard(listed, weights, classed)


def _matches(column: pa.Array, index: Index, threshold: float, overlap: float):
    """The index's matches in a column of texts, as (row, ...)."""
    from polyscribe.llm.kernels import column_bytes, pieces

    raw, offsets = column_bytes(column)
    for i, j in pieces(offsets, 1_000_000):
        h, at = folded_words(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
        yield [(i + text, *rest) for text, *rest in index.matches(h, at, threshold, overlap)]


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, overlap: float = OVERLAP, shard_words: int = SHARD_WORDS) -> DataFrame:
    """A row for each document and item that it contains: scores of the best passage and the word at which that begins."""
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    found = spark.createDataFrame([], SCHEMA)
    for index in item_indexes(items, shard_words):
        sent = spark.sparkContext.broadcast(index)

        def search(batches, sent=sent):
            for batch in batches:
                ids = batch.column(0).fill_null(NULL_ID).to_numpy()
                for rows in _matches(batch.column(1), sent.value, threshold, overlap):
                    if rows:
                        text, item, *rest = zip(*rows, strict=True)
                        yield pa.RecordBatch.from_arrays([id_array(ids[np.array(text)]), id_array([sent.value.ids[x] for x in item]), *(pa.array(c, t) for c, (_, t) in zip(rest, FIELDS[2:], strict=True))], schema=pa.schema(FIELDS))

        # written, so that one index at a time is on the executors
        found = found.unionAll(materialise(texts.mapInArrow(search, SCHEMA), "bm25-found"))
        sent.destroy()
    return found


def keep_clean(docs: DataFrame, items: DataFrame, text_col: str = "text", threshold: float = THRESHOLD, overlap: float = OVERLAP, shard_words: int = SHARD_WORDS) -> DataFrame:
    """The rows of docs whose text contains no item: one scan and no shuffle for each index, which the executors hold one at a time."""
    spark = docs.sparkSession
    at, schema = docs.columns.index(text_col), docs.schema
    out, before = docs, None
    for index in item_indexes(items, shard_words):
        sent = spark.sparkContext.broadcast(index)

        def drop(batches, sent=sent):
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                for rows in _matches(batch.column(at).cast(pa.string()), sent.value, threshold, overlap):
                    keep[[r[0] for r in rows]] = False
                yield batch.filter(pa.array(keep))

        out = materialise(out.mapInArrow(drop, schema), "bm25-clean")
        sent.destroy()
        if before is not None:
            discard(before)
        before = out
    return out


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contaminated documents with the items found in them."""
    out = contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.withColumns({x: F.round(x, 4) for x in ("score", "question_overlap", "answer_overlap")})


SQL = r"""
WITH i AS (
  SELECT DISTINCT item_id, coalesce(text, '') AS text FROM benchmark
), iw AS (
  SELECT item_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS raw, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS words,
         greatest(64, 1 << len(bin(len(regexp_split_to_array(text, '[^0-9A-Za-z\x{80}-\x{10FFFF}]+')) - 1))) AS half FROM i
), n AS (SELECT count(*) AS n, avg(len(words)) AS mean FROM iw WHERE len(words) > 0),
tf AS (
  SELECT item_id, term, count(*) AS tf, any_value(size) AS size, any_value(half) AS half FROM (SELECT item_id, half, unnest(words) AS term, len(words) AS size FROM iw) GROUP BY item_id, term
), df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
part AS (
  SELECT item_id, half, term, ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * size / mean)) AS part FROM tf JOIN df USING (term), n
), weight AS (
  SELECT item_id, half, term, CAST(round(part / sum(part) OVER (PARTITION BY item_id) * 1e12) AS BIGINT) AS weight FROM part
), cut AS (
  SELECT item_id, raw, coalesce(list_max(list_filter(range(1, len(raw)), lambda k: regexp_matches(raw[k], '[.!?]$'))), CAST(ceil(2 * len(raw) / 3.0) AS BIGINT)) AS cut FROM iw
), qa AS (
  SELECT item_id, unnest([array_to_string(raw[:cut], ' '), array_to_string(CASE WHEN cut < len(raw) THEN raw[cut + 1:] ELSE raw END, ' ')]) AS part, unnest(['q', 'a']) AS kind FROM cut
), qw AS (
  SELECT item_id, kind, regexp_extract_all(translate(part, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS words FROM qa
), qg AS (
  SELECT item_id, kind, k, unnest(list_distinct(list_transform(range(1, len(words) - k + 2), lambda p: array_to_string(words[p:p + k - 1], ' ')))) AS gram FROM (SELECT *, CASE WHEN len(words) >= 9 THEN 3 ELSE 1 END AS k FROM qw) WHERE len(words) > 0
), d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS words FROM documents
), p AS (
  SELECT doc_id, unnest(words) AS term, unnest(range(0, len(words))) AS pos FROM d
), step AS (
  SELECT doc_id, half, term, CAST(floor(pos / half) AS BIGINT) AS s FROM p, (SELECT DISTINCT half FROM iw) WHERE term IN (SELECT term FROM df)
), pas AS (
  SELECT DISTINCT doc_id, half, s, term FROM (SELECT * FROM step UNION ALL SELECT doc_id, half, term, s - 1 FROM step WHERE s > 0)
), hit AS (
  SELECT doc_id, half, s, item_id, CAST(sum(weight) AS BIGINT) AS score FROM pas JOIN weight USING (term, half) GROUP BY doc_id, half, s, item_id HAVING sum(weight) >= 499999999000
), body AS (
  SELECT hit.*, words[s * half + 1:s * half + 2 * half] AS words, s * half AS first_word FROM hit JOIN d USING (doc_id)
), share AS (
  SELECT doc_id, s, first_word, body.item_id, score, kind,
         avg(CASE WHEN list_contains(list_transform(range(1, len(body.words) - k + 2), lambda x: array_to_string(body.words[x:x + k - 1], ' ')), gram) THEN 1.0 ELSE 0.0 END) AS overlap
  FROM body JOIN qg ON body.item_id = qg.item_id GROUP BY ALL
), both_ AS (
  SELECT doc_id, s, first_word, item_id, score, coalesce(max(overlap) FILTER (kind = 'q'), 0.0) AS q, coalesce(max(overlap) FILTER (kind = 'a'), 0.0) AS a FROM share GROUP BY ALL
), ok AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY score DESC, q DESC, a DESC, first_word) AS k FROM both_ WHERE least(q, a) >= 0.5 - 1e-9
)
SELECT doc_id, item_id, round(score / 1e12, 4) AS score, round(q, 4) AS question_overlap, round(a, 4) AS answer_overlap, CAST(first_word AS BIGINT) AS first_word FROM ok WHERE k = 1
"""
