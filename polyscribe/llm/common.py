"""What the operators of this subpackage share: table access, shared-folder materialisation, block codecs.

Two ideas recur. A *block* is a few MB of whole documents, held as one compressed row with its own
id. A *shard* is a slice of a hash space: every block sends each shard at most one packed row, so a
key occurs once a block however often its rows do, and what a shard learns goes back to the block
under the block's id. No key, source or group of copies can make one task's input grow faster
than the number of blocks.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from polyscribe.runtime import discard, forget_shuffles, materialise, scratch_dir, ship

__all__ = ["discard", "forget_shuffles", "materialise", "scratch_dir", "ship"]

WORD = r"[^\x20\x09-\x0D]+"
NULL_ID = -(2**63)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(df: DataFrame, name: str) -> str:
    """A column name that df does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


#: Shards to which a block sends rows of its own. Where there are more, a middle step gathers what some blocks send.
FAN_OUT = 1024


def shards_for(total: float, each: float) -> tuple[int, int]:
    """(routes, inner): routes * inner shards keep about ``each`` items in one (8 at least, so that small inputs use the cores too)."""
    shards = max(8, -(-total // each))
    routes = int(min(shards, FAN_OUT))
    return routes, int(-(-shards // routes))


def cuts(keys: np.ndarray, pieces: int, bits: int, first: int = 0, of: int | None = None) -> np.ndarray:
    """Where sorted ``bits``-bit keys change shard: shards first, first + 1, ... of ``of`` equal slices of the key space (all of them by default)."""
    edges = [((first + s) << bits) // (of or pieces) for s in range(1, pieces)]
    return np.concatenate([[0], np.searchsorted(keys, np.array(edges, np.uint64)), [len(keys)]]).astype(np.int64)


def exchanged(sent: DataFrame, n_blocks: int, routes: int, inner: int, combine, merge, answer, kinds: tuple[str, str], name: str) -> DataFrame:
    """What the shards make (by ``merge``, a group of rows by shard) of rows that blocks sent to their routes.

    With one shard a route, rows go there. With more, rows in number of blocks times shards would grow with the square of the input;
    so the rows of one route and of so many blocks as hold about one block's keys are combined (``combine(rows, route)``) into one row for each inner
    shard, and the shard's answers, if there are any, are taken apart again for the blocks (``answer(rows, answers, route)``).
    Rows have shard, block and more (kinds[0]); answers have block, shard and more (kinds[1]).
    """
    if inner == 1:
        return sent.groupBy("shard").applyInArrow(merge, kinds[1])
    buckets = max(1, -(-n_blocks // routes))
    rows = materialise(sent.withColumn("place", F.col("shard").cast("long") * buckets + F.pmod(F.xxhash64("block"), F.lit(buckets))), name)

    def gather(part: pa.Table) -> pa.Table:
        out = combine(part, part["shard"][0].as_py())
        at = out.schema.get_field_index("block")
        return out.set_column(at, "block", pa.array([part["place"][0].as_py()] * out.num_rows, pa.int64()))

    found = rows.groupBy("place").applyInArrow(gather, kinds[0]).groupBy("shard").applyInArrow(merge, kinds[1])
    if answer is None:
        return found
    found = materialise(found, name)

    def take_apart(part: pa.Table, answers: pa.Table) -> pa.Table:
        return answer(part, answers.sort_by("shard"), part["shard"][0].as_py())

    return rows.groupBy("place").cogroup(found.groupBy("block")).applyInArrow(take_apart, kinds[1])


def pack(x: np.ndarray, delta: bool = False) -> bytes:
    """An integer array as zstd-compressed byte planes; ``delta`` stores differences of a sorted array."""
    x = np.ascontiguousarray(x)
    if delta and len(x):
        d = x.copy()
        d[1:] = x[1:] - x[:-1]
        x = d
    planes = x.view(np.uint8).reshape(len(x), x.dtype.itemsize).T
    return zstandard.compress(np.ascontiguousarray(planes).tobytes(), 1)


def unpack(data: bytes, kind, delta: bool = False) -> np.ndarray:
    raw = np.frombuffer(zstandard.decompress(data) if len(data) else b"", np.uint8)
    kind = np.dtype(kind)
    x = np.ascontiguousarray(raw.reshape(kind.itemsize, -1).T).view(kind).reshape(-1)
    return np.cumsum(x, dtype=kind) if delta else x


def pack_bits(x: np.ndarray) -> bytes:
    return zlib.compress(np.packbits(x).tobytes(), 1)


def unpack_bits(data: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(zlib.decompress(data), np.uint8), count=n).astype(bool)


# --- documents as blocks -------------------------------------------------------------------------

BLOCK_SCHEMA = "block long, n_docs long, n_bytes long, n_words long, ids binary, lengths binary, body binary"


def blocks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 6_000_000) -> DataFrame:
    """Whole documents as compressed rows of about ``size`` bytes of text, ordered by id inside each.

    A block's id is (partition id, running number), made unique when the rows are materialised;
    callers materialise the result once and read that, so a block never changes afterwards.
    Null texts count as empty; a null id is kept as the smallest long and comes back as null.
    """
    from polyscribe.llm.kernels import column_bytes, word_spans

    def encode(batches):
        from pyspark import TaskContext

        part, number, ids, texts, held = TaskContext.get().partitionId(), 0, [], [], 0

        def flush():
            nonlocal number, ids, texts, held
            order = sorted(range(len(ids)), key=lambda i: (ids[i], texts[i]))
            body = [texts[i] for i in order]
            raw = b"".join(body)
            lengths = np.array([len(x) for x in body], np.int64)
            offsets = np.concatenate([[0], np.cumsum(lengths)])
            words = int(word_spans(np.frombuffer(raw, np.uint8), offsets)[2][-1]) if raw else 0
            row = {
                "block": [part * 2**32 + number], "n_docs": [len(ids)], "n_bytes": [len(raw)], "n_words": [words],
                "ids": [pack(np.array([ids[i] for i in order], np.int64))], "lengths": [pack(lengths)],
                "body": [zstandard.compress(raw, 3)],
            }
            number, ids, texts, held = number + 1, [], [], 0
            return pa.RecordBatch.from_pydict(row, pa.schema([
                ("block", pa.int64()), ("n_docs", pa.int64()), ("n_bytes", pa.int64()), ("n_words", pa.int64()),
                ("ids", pa.binary()), ("lengths", pa.binary()), ("body", pa.binary()),
            ]))

        for batch in batches:
            keys = batch.column(0).fill_null(NULL_ID).to_numpy(zero_copy_only=False)
            raw, offsets = column_bytes(batch.column(1))
            data = raw.tobytes()
            for i, key in enumerate(keys):
                text = data[offsets[i] : offsets[i + 1]]
                ids.append(int(key))
                texts.append(text)
                held += len(text)
                if held >= size:
                    yield flush()
        if ids:
            yield flush()

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(encode, BLOCK_SCHEMA)


def open_block(ids: bytes, lengths: bytes, body: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document ids, the joined bytes and their n + 1 offsets."""
    sizes = unpack(lengths, np.int64)
    return unpack(ids, np.int64), np.frombuffer(zstandard.decompress(body), np.uint8), np.concatenate([[0], np.cumsum(sizes)])


def id_array(ids) -> pa.Array:
    """Long ids with the stand-in for null turned back."""
    a = np.asarray(ids, np.int64)
    return pa.array(a, pa.int64(), mask=a == NULL_ID)
