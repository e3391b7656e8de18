"""Document fingerprints from prefix polynomial hashes.

A text's prefix array holds its polynomial hash, modulo two 31-bit primes, up to every code point. Any span's hash
is two look-ups and a product, so span equality is O(1), the longest common extension of two positions
is a binary search, and the hashes of all windows of ``WINDOW`` code points are one vector expression. A fingerprint is
the length, the whole text's hash, and the smallest window hash in each of ``BINS`` slices of hash space.

Defined cases. Null text: empty. Texts shorter than a window have one window, the whole text; the empty text has none.
Likeness is the Dice coefficient of the windows' sets as estimated from the bins that either has; two empty texts are
alike (1), an empty and another are not (0). Order is by doc_id, then text, so repeated rows follow each other; a null id
comes first. A single document is its own next. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from polyscribe.llm.common import materialise, table
from polyscribe.llm.kernels import mix

WINDOW, BINS, BIN_BITS = 16, 64, 12
PRIMES = (2147483647, 2147483629)
BASES = (1103515245, 1566083941)
_tables: dict[tuple[int, int], np.ndarray] = {}


def _powers(base: int, prime: int, n: int) -> np.ndarray:
    have = _tables.get((base, prime))
    if have is None or len(have) < n:
        size = 1 << max(12, (n - 1).bit_length())
        have, done = np.ones(size, np.uint64), 1
        while done < size:
            have[done : 2 * done] = have[:done] * np.uint64(pow(base, done, prime)) % np.uint64(prime)
            done *= 2
        _tables[base, prime] = have
    return have[:n]


class PrefixHashes:
    """Prefix arrays of a run of code points modulo both primes."""

    def __init__(self, points: np.ndarray):
        self.n, self.prefix = len(points), []
        for base, prime in zip(BASES, PRIMES, strict=True):
            s = np.zeros(self.n + 1, np.uint64)
            # terms are under 2**31, so sums of up to 2**33 of them are exact before the reduction
            np.cumsum((points.astype(np.uint64) + np.uint64(1)) * _powers(base, prime, self.n) % np.uint64(prime), out=s[1:])
            self.prefix.append(s % np.uint64(prime))

    def spans(self, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        """62-bit hashes of spans; equal spans hash equally wherever they stand."""
        out = np.zeros(len(starts), np.uint64)
        for s, base, prime in zip(self.prefix, BASES, PRIMES, strict=True):
            p = np.uint64(prime)
            back = _powers(pow(base, -1, prime), prime, self.n + 1)
            out = (out << np.uint64(31)) | ((s[stops] + p - s[starts]) % p * back[starts] % p)
        return out


def common_extension(a: PrefixHashes, i: np.ndarray, room_a: np.ndarray, b: PrefixHashes, j: np.ndarray, room_b: np.ndarray) -> np.ndarray:
    """For each pair of positions, how many code points agree from there on, within the room of each; by binary search."""
    low, high = np.zeros(len(i), np.int64), np.minimum(room_a, room_b).astype(np.int64)
    while (low < high).any():
        mid = (low + high + 1) // 2
        same = a.spans(i, i + mid) == b.spans(j, j + mid)
        low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
    return low


def fingerprints(hashes: PrefixHashes, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(whole hash, length, bins) of the texts between the offsets ``at``; bins hold a BIN_BITS minimum or -1."""
    n = len(at) - 1
    size = np.diff(at)
    whole = hashes.spans(at[:-1], at[1:])
    count = np.where(size == 0, 0, np.maximum(size - WINDOW + 1, 1))
    first = np.repeat(at[:-1] - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
    owner = np.repeat(np.arange(n), count)
    h = mix(hashes.spans(first, np.minimum(first + WINDOW, at[1:][owner])))
    bins = np.full(n * BINS, 2**32, np.uint64)
    np.minimum.at(bins, owner * BINS + (h >> np.uint64(58)).astype(np.int64), h & np.uint64(2**32 - 1))
    # the low bits of the smallest hash are uniform, unlike its high ones
    short = np.where(bins == 2**32, -1, (mix(bins) >> np.uint64(64 - BIN_BITS)).astype(np.int64))
    return whole, size, short.reshape(n, BINS)


def render(whole: np.ndarray, size: np.ndarray, bins: np.ndarray) -> list[str]:
    return [f"{n:x}-{w:016x}-" + "".join("..." if b < 0 else f"{b:03x}" for b in row) for n, w, row in zip(size.tolist(), whole.tolist(), bins.tolist(), strict=True)]


def likeness(a: tuple, b: tuple) -> np.ndarray:
    """Estimated Dice coefficient of two batches of fingerprints."""
    (wa, na, ba), (wb, nb, bb) = a, b
    either = ((ba >= 0) | (bb >= 0)).sum(1)
    jaccard = ((ba == bb) & (ba >= 0)).sum(1) / np.maximum(either, 1)
    dice = 2 * jaccard / (1 + jaccard)
    return np.where((wa == wb) & (na == nb), 1.0, np.where((na == 0) | (nb == 0), 0.0, dice))


FIELDS = [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()), ("common_prefix", pa.int64())]
SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, common_prefix long"


def _points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    at = np.concatenate([[0], np.cumsum([len(x) for x in texts])]).astype(np.int64)
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32), at


def compare(ids: list, texts: list[str], following: list[str]) -> list[pa.Array]:
    """The result's columns for documents, given each one's next document."""
    edited = [t[: len(t) - len(t) // 2] + f[: len(t) // 2] for t, f in zip(texts, following, strict=True)]
    points, at = _points(texts)
    own = PrefixHashes(points)
    mine = fingerprints(own, at)
    points, at_e = _points(edited)
    other = PrefixHashes(points)
    theirs = fingerprints(other, at_e)
    # following is texts shifted by one but for its last entry
    points, at_l = _points(following[-1:])
    last = fingerprints(PrefixHashes(points), at_l)
    nexts = tuple(np.concatenate([x[1:], y]) for x, y in zip(mine, last, strict=True))
    same = common_extension(own, at[:-1], mine[1], other, at_e[:-1], theirs[1])
    return [
        pa.array(ids, pa.int64()), pa.array(mine[1], pa.int64()), pa.array([hashlib.sha256(x.encode()).hexdigest() for x in edited]),
        pa.array(render(*mine)), pa.array(render(*theirs)), pa.array(likeness(mine, theirs)), pa.array(likeness(mine, nexts)), pa.array(same, pa.int64()),
    ]


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = 500_000) -> DataFrame:
    """One text shuffle: range partitions by id, each read in order; only a partition's last document waits for the next one's first."""
    whole = pa.schema([*FIELDS, ("part", pa.int64()), ("role", pa.string()), ("body", pa.string())])

    def walk(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        ids, texts, held, began = [], [], 0, False
        blank = [None] * len(FIELDS)

        def out(final: bool):
            """Everything but the newest document, whose next one is not known yet."""
            nonlocal ids, texts, held
            rows = compare(ids[:-1], texts[:-1], texts[1:])
            ids, texts = ids[-1:], texts[-1:]
            held = len(texts[0])
            none = [pa.nulls(len(rows[0]), t) for t in (pa.int64(), pa.string(), pa.string())]
            return pa.RecordBatch.from_arrays([*rows, *none], schema=whole)

        def pending(role):
            return pa.RecordBatch.from_pylist([dict(zip(whole.names, [*blank, part, role, texts[0]], strict=True)) | {"doc_id": ids[0]}], schema=whole)

        for batch in batches:
            for i in range(batch.num_rows):
                ids.append(batch.column(0)[i].as_py())
                texts.append(batch.column(1)[i].as_py() or "")
                held += len(texts[-1])
                if not began:
                    began = True
                    yield pending("first")
                if held >= most and len(ids) > 1:
                    yield out(False)
        if ids:
            if len(ids) > 1:
                yield out(True)
            yield pending("last")

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    done = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text").mapInArrow(walk, f"{SCHEMA}, part long, role string, body string")
    done = materialise(done, "fingerprints")
    names = [x for x, _ in FIELDS]
    # one row a partition: which partition's first document follows each last one
    firsts = done.filter("role = 'first'").select(F.col("part").alias("next_part"), F.col("body").alias("next_body"))
    order = firsts.select("next_part").withColumnRenamed("next_part", "part")
    low = order.agg(F.min("part").alias("low"))
    order = order.withColumn("follows", F.lead("part").over(Window.orderBy("part"))).join(F.broadcast(low)).select("part", F.coalesce("follows", "low").alias("next_part"))
    edge = done.filter("role = 'last'").select("doc_id", "part", "body").join(order, "part").join(firsts, "next_part").select("doc_id", "body", "next_body")

    def finish(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                doc, body, after = (batch.column(k)[i].as_py() for k in range(3))
                yield pa.RecordBatch.from_arrays(compare([doc], [body], [after]), schema=pa.schema(FIELDS))

    return done.filter("role IS NULL").select(*names).unionByName(edge.mapInArrow(finish, SCHEMA))


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_documents(table(spark, sf_dir, "documents"))
