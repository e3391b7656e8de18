"""Line dedup by a segment-partition edit join.

Lines within ``edits`` code-point edits of each other are linked. A line of length l is indexed by its edits + 1
segments; a longer or equal line probes, for every length from its own down to edits less, the substrings that
a segment can have moved to (the multi-match-aware windows). By the pigeonhole principle each linked pair
shares a key of (length, segment number, segment). Keys travel as packed shards; lines that meet are
confirmed with a banded bit-parallel edit distance, many pairs at a time, inside tasks of bounded size, which
return a spanning forest, so that groups of copies never become pairs of rows. Classes are the links' connected components.
Different lines that share a segment, as those of a template do, are cut into chunks whose pairs are tasks of their own;
most of their pairs end at a comparison of letter counts. A line is known by 128 bits of its text.

Of each class the first line (smallest doc_id, then line number) stays and the others go. Lines of fewer than
``min_chars`` code points are left alone, or with ``short`` take part with edits scaled to their length: the shorter line
of l code points allows l * edits // min_chars edits (with 2 and 25: 1 from 13 code points, and below only exact repeats
meet, down to one code point). Short lines of blanks alone always stay, as they part paragraphs.

Defined cases. Null or empty text: no lines. A null id sorts first. Rows that repeat an id are the same document:
lines at equal positions do not remove one another. Ties cannot occur otherwise. Lines are what
stands between line feeds, byte for byte. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from polyscribe.llm.common import NULL_ID, cuts, discard, exchanged, materialise, pack, shards_for, table, unpack, unused
from polyscribe.llm.components import components

EDITS, MIN_CHARS = 2, 25
#: Lines under one key that make one task; a larger group is cut into chunks whose pairs are tasks of their own.
GROUP, CHUNK = 128, 2048
#: Lines of up to so many code points are compared many at a time.
WIDEST = 512
_BASE_2 = 0x2545F4914F6CDD1D
#: Line hashes wanted are sent to every executor only if counted to be at most this many; else rows meet in a join.
BROADCAST_LINES = 1_000_000


class Lines:
    """The lines of some texts as spans of code points."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray):
        from polyscribe.llm.kernels import _BASE as base

        self.points = np.frombuffer(raw.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
        lead = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
        at = lead[offsets]
        feeds = np.flatnonzero(self.points == 10)
        owner = np.searchsorted(at, feeds, "right") - 1
        docs = np.flatnonzero(np.diff(at))
        starts, who = np.concatenate([at[docs], feeds + 1]), np.concatenate([docs, owner])
        order = np.lexsort((starts, who))
        self.starts, self.doc = starts[order], who[order]
        stops, who = np.concatenate([at[docs + 1], feeds]), np.concatenate([docs, owner])
        self.stops = stops[np.lexsort((stops, who))]
        self.length = self.stops - self.starts
        new = np.ones(len(self.doc), bool)
        new[1:] = self.doc[1:] != self.doc[:-1]
        lead_at = np.flatnonzero(new)
        self.number = np.arange(len(self.doc)) - np.repeat(lead_at, np.diff(np.append(lead_at, len(self.doc))))
        ink = np.concatenate([[0], np.cumsum((self.points != 32) & ((self.points < 9) | (self.points > 13)))])
        self.blank = ink[self.stops] == ink[self.starts]
        self.prefix = self._prefix(base)

    def _prefix(self, base: int) -> np.ndarray:
        from polyscribe.llm.kernels import mix, powers

        out = np.zeros(len(self.points) + 1, np.uint64)
        values = mix(self.points.astype(np.uint64) + np.uint64(1))
        values *= powers(base, len(self.points))
        np.cumsum(values, out=out[1:])
        return out

    def _span(self, prefix: np.ndarray, inverse: int, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        from polyscribe.llm.kernels import mix, powers

        h = (prefix[stops] - prefix[starts]) * powers(inverse, len(prefix))[starts]
        return mix(h + (stops - starts).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))

    def span(self, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        from polyscribe.llm.kernels import _INVERSE

        return self._span(self.prefix, _INVERSE, starts, stops)

    def hashes(self) -> np.ndarray:
        return self.span(self.starts, self.stops)

    def seconds(self, chosen: np.ndarray) -> np.ndarray:
        """Second halves of the chosen lines' 128-bit identities, over another base."""
        return self._span(self._prefix(_BASE_2), pow(_BASE_2, -1, 2**64), self.starts[chosen], self.stops[chosen])


def segments(length: np.ndarray, count: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Start and length of each of ``count`` even segments of lines of these lengths, the longer ones last."""
    small, long = length // count, length % count
    out, at = [], np.zeros_like(length)
    for i in range(count):
        size = small + (i >= count - long)
        out.append((at, size))
        at = at + size
    return out


def counted(lines: Lines, min_chars: int, short: bool) -> np.ndarray:
    """Which lines count: the long ones, and with ``short`` the others that are not blank."""
    return (lines.length >= min_chars) | (~lines.blank if short else False)


def tiers(edits: int, min_chars: int, short: bool) -> list[tuple[int, int, float]]:
    """(k, least, most): the lengths of lines between which pairs with up to k edits are sought."""
    out = [(edits, min_chars, np.inf)]
    for k in range(edits - 1, 0, -1) if short else ():
        out.append((k, -(-min_chars * k // edits), out[-1][1] - 1 + k))  # a line of the next tier may be the longer one of a pair
    return out


def join_keys(lines: Lines, chosen: np.ndarray, edits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, line, is_index) of every index and probe entry of the chosen lines."""
    from polyscribe.llm.kernels import mix

    first, length = lines.starts[chosen], lines.length[chosen]
    keys, who, kind = [], [], []
    name = lambda h, size, i: mix(h ^ mix(size.astype(np.uint64) * np.uint64(64) + np.uint64(i)))
    for shorter in range(edits + 1):
        size = length - shorter
        for i, (at, n) in enumerate(segments(size, edits + 1)):
            low, high = max(-i, shorter - (edits - i)), min(i, shorter + (edits - i))
            for move in range(low, high + 1):
                begin = at + move
                ok = (begin >= 0) & (begin + n <= length) & (n > 0) & (size > 0)
                h = lines.span(first[ok] + begin[ok], first[ok] + begin[ok] + n[ok])
                keys.append(name(h, size[ok], i))
                who.append(np.flatnonzero(ok))
                kind.append(np.full(len(h), shorter == 0 and move == 0))
    return np.concatenate(keys), np.concatenate(who), np.concatenate(kind)


def within(a: np.ndarray, b: np.ndarray, k: int) -> bool:
    """Whether the edit distance of two code-point arrays is at most k, by a bit-parallel band of 2k + 1 diagonals."""
    if abs(len(a) - len(b)) > k:
        return False
    m = min(len(a), len(b))
    off = np.flatnonzero(a[:m] != b[:m])
    p = int(off[0]) if len(off) else m
    a, b = a[p:], b[p:]
    m -= p
    off = np.flatnonzero(a[len(a) - m :] != b[len(b) - m :]) if m else off[:0]
    s = m - 1 - int(off[-1]) if len(off) else m
    a, b = a[: len(a) - s].tolist(), b[: len(b) - s].tolist()
    if len(a) > len(b):
        a, b = b, a
    if len(b) <= k:
        return True
    if not a:
        return False
    return banded(a, b, k) <= k


def banded(a: list, b: list, k: int) -> int:
    """Edit distance of a and b (len(a) <= len(b) <= len(a) + k) if at most k, else something over k.

    Bit d of the vectors is the cell of row j + d - k in column j: the band slides down one row a column, vertical differences
    shift by one bit against it, and the distance is followed down the lowest diagonal and then along the last row.
    """
    a, b = b, a  # rows are the longer string
    rows, top, mask = len(a), 2 * k, (1 << (2 * k + 1)) - 1
    plus, minus, score, follow = (mask << k) & mask, 0, k, 1 << (2 * k)
    for j, c in enumerate(b):
        match = 0
        for d in range(top + 1):
            i = j + d - k
            if 0 <= i < rows and a[i] == c:
                match |= 1 << d
        zero = ((((match & plus) + plus) ^ plus) | match | minus) & mask
        up, down = (minus | ~(zero | plus)) & mask, zero & plus
        if j + k < rows:
            score += not zero & (1 << top)
        else:
            follow >>= 1
            score += bool(up & follow) - bool(down & follow)
        plus, minus = (down | ~((zero >> 1) | up)) & mask, (zero >> 1) & up
        if j + k < rows and score > 3 * k + 1:
            return score
    return score


def banded_many(points: np.ndarray, start: np.ndarray, length: np.ndarray, a: np.ndarray, b: np.ndarray, k: int) -> np.ndarray:
    """``banded`` for many pairs at once: their edit distances where at most k, else something over k.

    ``points`` holds all lines one after the other; a and b are pairs of lines whose lengths differ by k at most.
    """
    longer = np.where(length[a] >= length[b], a, b)
    a, b = longer, a + b - longer  # rows are the longer string
    rows, columns = length[a], length[b]
    wide = int(columns.max(initial=0))
    at = np.arange(wide)
    cell = lambda who, i: points[start[who][:, None] + np.clip(i, 0, np.maximum(length[who], 1)[:, None] - 1)]
    other = cell(b, at[None, :])
    match = np.zeros((len(a), wide), np.int64)
    for d in range(2 * k + 1):
        i = at[None, :] + d - k
        match |= ((cell(a, i) == other) & (i >= 0) & (i < rows[:, None])).astype(np.int64) << d
    top, mask = 2 * k, (1 << (2 * k + 1)) - 1
    plus, minus = np.full(len(a), (mask << k) & mask), np.zeros(len(a), np.int64)
    score, follow = np.full(len(a), k), np.full(len(a), 1 << top)
    for j in range(wide):
        m = match[:, j]
        zero = ((((m & plus) + plus) ^ plus) | m | minus) & mask
        up, down = (minus | ~(zero | plus)) & mask, zero & plus
        live, inside = j < columns, j + k < rows
        follow = np.where(live & ~inside, follow >> 1, follow)
        step = np.where(inside, 1 - ((zero >> top) & 1), ((up & follow) != 0).astype(np.int64) - ((down & follow) != 0))
        score = score + np.where(live, step, 0)
        plus, minus = (down | ~((zero >> 1) | up)) & mask, (zero >> 1) & up
    return score


def forest(points: list[np.ndarray], a: np.ndarray, b: np.ndarray, edits: int, min_chars: int) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of a spanning forest of the links among the pairs (a, b) of lines.

    Pairs whose lengths or letter counts differ by more than the edits allow go first, many at a time; pairs that are
    connected by now need no comparison; the others are compared in batches.
    """
    length = np.array([len(x) for x in points], np.int64)
    start = np.concatenate([[0], np.cumsum(length)])[:-1]
    flat = np.concatenate([*points, np.zeros(1, np.uint32)])
    owner = np.repeat(np.arange(len(points)), length)
    letters = np.bincount(owner * 16 + ((flat[:-1].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(60)).astype(np.int64), minlength=16 * len(points)).reshape(-1, 16).astype(np.int32)
    root = np.arange(len(points))
    kept_a, kept_b = [], []

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i in range(0, len(a), 65_536):
        x, y = a[i : i + 65_536], b[i : i + 65_536]
        allowed = np.minimum(edits, np.minimum(length[x], length[y]) * edits // min_chars)
        # one edit changes at most two letter counts by one
        near = (np.abs(length[x] - length[y]) <= allowed) & (np.abs(letters[x] - letters[y]).sum(1) <= 2 * allowed)
        x, y, allowed = x[near], y[near], allowed[near]
        done, batch = 0, 256
        while done < len(x):
            while len(root) and (root[root] != root).any():
                root = root[root]
            p, q, k = x[done : done + batch], y[done : done + batch], allowed[done : done + batch]
            done, batch = done + batch, min(4 * batch, 16_384)
            open_ = root[p] != root[q]
            p, q, k = p[open_], q[open_], k[open_]
            linked = np.zeros(len(p), bool)
            most = np.maximum(length[p], length[q])
            low = 0
            for size in (64, 128, 256, WIDEST):
                for e in range(edits + 1):
                    some = np.flatnonzero((k == e) & (most > low) & (most <= size))
                    for c in range(0, len(some), 2_000_000 // size):
                        t = some[c : c + 2_000_000 // size]
                        linked[t] = banded_many(flat, start, length, p[t], q[t], e) <= e
                low = size
            for t in np.flatnonzero(most > WIDEST):
                linked[t] = within(points[p[t]], points[q[t]], int(k[t]))
            for u, v in zip(p[linked].tolist(), q[linked].tolist(), strict=True):
                m, n = find(u), find(v)
                if m != n:
                    root[max(m, n)] = min(m, n)
                    kept_a.append(u)
                    kept_b.append(v)
    return np.array(kept_a, np.int64), np.array(kept_b, np.int64)


def line_table(docs: DataFrame, id_col: str, text_col: str, min_chars: int, short: bool = False) -> DataFrame:
    """doc_id, line (its number), h and g (128 bits of its text) for every line that counts; null ids as the smallest long."""
    from polyscribe.llm.kernels import column_bytes, pieces

    def compute(batches):
        for batch in batches:
            raw, offsets = column_bytes(batch.column(1))
            ids = batch.column(0).fill_null(NULL_ID).to_numpy()
            for i, j in pieces(offsets, 1_000_000):
                x = Lines(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                use = np.flatnonzero(counted(x, min_chars, short))
                yield pa.RecordBatch.from_arrays([pa.array(ids[i + x.doc[use]]), pa.array(x.number[use].astype(np.int32)), pa.array(x.hashes()[use].view(np.int64)), pa.array(x.seconds(use).view(np.int64))], ["doc_id", "line", "h", "g"])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(compute, "doc_id long, line int, h long, g long")


def meetings(docs: DataFrame, text_col: str, edits: int, min_chars: int, n_lines: int, short: bool = False) -> DataFrame:
    """Chunks of different line hashes that share a key: key, probe (or index entries), the chunk's number among n_index or n_probe, lines."""
    from polyscribe.llm.kernels import column_bytes, pieces

    entries = (edits + 1) * (edits + 1) * (edits + 2) / 2
    routes, inner = shards_for(n_lines * entries, 1_000_000)
    part = pa.schema([("shard", pa.int32()), ("block", pa.int64()), ("keys", pa.binary()), ("lines", pa.binary()), ("kinds", pa.binary())])

    def cut_up(keys, who, kind, block, first, cut) -> pa.RecordBatch:
        out = {n: [] for n in part.names}
        for s, (a, b) in enumerate(zip(cut[:-1], cut[1:], strict=True)):
            if a < b:
                for n, v in zip(part.names, (first + s, block, pack(keys[a:b], True), pack(who[a:b]), np.packbits(kind[a:b]).tobytes()), strict=True):
                    out[n].append(v)
        return pa.RecordBatch.from_pydict(out, part)

    def send(batches):
        from pyspark import TaskContext

        block = TaskContext.get().partitionId() * 2**32
        for batch in batches:
            raw, offsets = column_bytes(batch.column(0))
            for i, j in pieces(offsets, 1_000_000):
                x = Lines(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                use = np.flatnonzero(counted(x, min_chars, short))
                h, first = np.unique(x.hashes()[use], return_index=True)
                use, found = use[first], []
                for k, least, most in tiers(edits, min_chars, short):
                    at = np.flatnonzero((x.length[use] >= least) & (x.length[use] <= most))
                    if len(at):
                        keys, who, kind = join_keys(x, use[at], k)
                        found.append((keys, h[at][who], kind))
                if not found:
                    continue
                keys, who, kind = (np.concatenate(c) for c in zip(*found, strict=True))
                order = np.argsort(keys, kind="stable")
                keys, who, kind = keys[order], who[order], kind[order]
                yield cut_up(keys, who, kind, block, 0, cuts(keys, routes, 64))
                block += 1

    parts = pa.schema([("key", pa.int64()), ("probe", pa.bool_()), ("at", pa.int32()), ("n_index", pa.int32()), ("n_probe", pa.int32()), ("lines", pa.list_(pa.int64()))])

    def entries_of(rows: pa.Table):
        """Keys, lines and kinds of the rows' entries in order, each entry once; an index entry comes before the same line's probe and stands for it."""
        keys = [unpack(x.as_py(), np.uint64, True) for x in rows["keys"]]
        kind = np.concatenate([np.unpackbits(np.frombuffer(x.as_py(), np.uint8), count=len(k)) for x, k in zip(rows["kinds"], keys, strict=True)]).astype(bool)
        keys, line = np.concatenate(keys), np.concatenate([unpack(x.as_py(), np.uint64) for x in rows["lines"]])
        order = np.lexsort((~kind, line, keys))
        keys, line, kind = keys[order], line[order], kind[order]
        new = np.ones(len(keys), bool)
        new[1:] = (keys[1:] != keys[:-1]) | (line[1:] != line[:-1])
        return keys[new], line[new], kind[new]

    def combine(rows: pa.Table, route: int) -> pa.Table:
        keys, line, kind = entries_of(rows)
        return pa.Table.from_batches([cut_up(keys, line, kind, 0, route * inner, cuts(keys, inner, 64, route * inner, routes * inner))])

    def meet(rows: pa.Table) -> pa.Table:
        keys, line, kind = entries_of(rows)
        edge = np.ones(len(keys), bool)
        edge[1:] = keys[1:] != keys[:-1]
        begin = np.flatnonzero(edge)
        count = np.diff(np.append(begin, len(keys)))
        indexed = np.add.reduceat(kind.astype(np.int64), begin) if len(begin) else count
        out = {n: [] for n in parts.names}
        for g in np.flatnonzero((count > 1) & (indexed > 0)):
            member, is_index = line[begin[g] : begin[g] + count[g]].view(np.int64), kind[begin[g] : begin[g] + count[g]]
            inner, outer = member[is_index], member[~is_index]
            size = GROUP if len(member) <= GROUP else CHUNK
            n_index, n_probe = -(-len(inner) // size), -(-len(outer) // size)
            for probe, lines, n in ((False, inner, n_index), (True, outer, n_probe)):
                for k in range(n):
                    for name, v in zip(parts.names, (int(keys[begin[g]].view(np.int64)), probe, k, n_index, n_probe, lines[k * size : (k + 1) * size]), strict=True):
                        out[name].append(v)
        return pa.Table.from_pydict(out, schema=parts)

    kinds = ("shard int, block long, keys binary, lines binary, kinds binary", "key long, probe boolean, at int, n_index int, n_probe int, lines array<long>")
    sent = docs.select(F.col(text_col).cast("string")).mapInArrow(send, kinds[0])
    # about as many blocks as pieces of text
    return exchanged(sent, max(1, n_lines // 20_000), routes, inner, combine, meet, None, kinds, "line-sent")


def pair_tasks(parts: DataFrame) -> DataFrame:
    """(task, left, right) from chunks of lines: every chunk of index entries meets itself (right is empty), the other ones and every chunk of probes.

    Chunks of one key meet by an explode and a shuffle, so however many lines share a key, no task holds more than two chunks.
    """
    at = F.col("at")
    # index chunk i meets itself and, as the lower one, index chunks i + 1 ...: pairs (i, j); and probe chunk j: pairs (i, -1 - j)
    mine = F.when(F.col("probe"), F.transform(F.sequence(F.lit(0), F.col("n_index") - 1), lambda i: F.struct(i.alias("a"), (-1 - at).alias("b")))).otherwise(
        F.concat(
            F.transform(F.sequence(F.lit(0), F.col("n_index") - 1), lambda i: F.struct(F.least(i, at).alias("a"), F.greatest(i, at).alias("b"))),
            F.when(F.col("n_probe") > 0, F.transform(F.sequence(F.lit(0), F.col("n_probe") - 1), lambda j: F.struct(at.alias("a"), (-1 - j).alias("b")))).otherwise(F.array().cast("array<struct<a:int,b:int>>")),
        )
    )
    single = (F.col("n_index") == 1) & (F.col("n_probe") == 0)
    none = F.array().cast("array<long>")
    alone = parts.filter(single).select(F.col("lines").alias("left"), none.alias("right"))
    spread = parts.filter(~single).select("key", "probe", "at", "lines", F.explode(mine).alias("_p")).select("key", "_p.a", "_p.b", "lines", (F.col("probe") | (F.col("at") != F.col("_p.a"))).alias("_right"))
    met = spread.groupBy("key", "a", "b").agg(F.first(F.when(~F.col("_right"), F.col("lines")), True).alias("left"), F.first(F.when(F.col("_right"), F.col("lines")), True).alias("right"))
    both = alone.unionAll(met.select("left", F.coalesce("right", none))).filter((F.size("left") > 1) | (F.size("right") > 0))
    # keys with the same lines ask the same
    return both.withColumns({"task": F.xxhash64("left", "right"), "_t": F.xxhash64(F.lit(1), "right", "left")}).dropDuplicates(["task", "_t"]).drop("_t")


def line_texts(docs: DataFrame, need: DataFrame, text_col: str, min_chars: int, short: bool = False) -> DataFrame:
    """(h, g, points): the code points of each wanted line once."""
    from polyscribe.llm.kernels import column_bytes, pieces

    spark = docs.sparkSession
    wanted = None
    if need.count() <= BROADCAST_LINES:
        wanted = spark.sparkContext.broadcast(np.sort(np.array([r[0] for r in need.collect()], np.int64)))

    def compute(batches):
        for batch in batches:
            raw, offsets = column_bytes(batch.column(0))
            for i, j in pieces(offsets, 1_000_000):
                x = Lines(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                use = np.flatnonzero(counted(x, min_chars, short))
                h, first = np.unique(x.hashes()[use].view(np.int64), return_index=True)
                use = use[first]
                if wanted is not None and len(h):
                    at = np.minimum(np.searchsorted(wanted.value, h), max(len(wanted.value) - 1, 0))
                    hit = wanted.value[at] == h if len(wanted.value) else np.zeros(len(h), bool)
                    h, use = h[hit], use[hit]
                if len(use):
                    yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(x.seconds(use).view(np.int64)), pa.array([x.points[a:b].tobytes() for a, b in zip(x.starts[use], x.stops[use], strict=True)], pa.binary())], ["h", "g", "points"])

    made = docs.select(F.col(text_col).cast("string")).mapInArrow(compute, "h long, g long, points binary")
    if wanted is None:
        made = made.join(need, "h", "left_semi")
    return made.dropDuplicates(["h", "g"])


def line_links(lists: DataFrame, texts: DataFrame, edits: int, min_chars: int) -> DataFrame:
    """(a, b) lines as structs (h, g): a spanning forest of each task's confirmed links."""
    from polyscribe.llm.op8_neardup import _groups

    members = lists.select("task", F.explode(F.array_distinct(F.concat("left", "right"))).alias("h")).join(texts, "h")
    none = F.lit(None).cast("array<long>")
    heads = lists.select("task", F.lit(None).cast("long").alias("h"), F.lit(None).cast("long").alias("g"), F.lit(None).cast("binary").alias("points"), "left", "right")
    rows = members.select("task", "h", "g", "points", none.alias("left"), none.alias("right")).unionByName(heads).repartition("task").sortWithinPartitions("task")
    names = ["ah", "ag", "bh", "bg"]

    def check(batches):
        points, h, g, a, b, held = [], [], [], [], [], 0

        def flush():
            nonlocal points, h, g, a, b, held
            p, q = forest(points, np.concatenate(a), np.concatenate(b), edits, min_chars)
            hs, gs = np.array(h, np.int64), np.array(g, np.int64)
            points, h, g, a, b, held = [], [], [], [], [], 0
            return pa.RecordBatch.from_arrays([pa.array(x) for x in (hs[p], gs[p], hs[q], gs[q])], names)

        for group in _groups(batches):
            where: dict[int, list[int]] = {}  # different lines of one h are lines of their own
            for x, y, z in zip(group["h"].to_pylist(), group["g"].to_pylist(), group["points"].to_pylist(), strict=True):
                if x is not None:
                    where.setdefault(x, []).append(len(points))
                    points.append(np.frombuffer(z, np.uint32))
                    h.append(x)
                    g.append(y)
            at = lambda side, where=where: np.array([n for x in side for n in where[x]], np.int64)
            for left, right in zip(group["left"].to_pylist(), group["right"].to_pylist(), strict=True):
                if left is not None:
                    i, j = at(left), at(right)
                    if len(j):
                        a.append(np.repeat(i, len(j)))
                        b.append(np.tile(j, len(i)))
                    else:
                        u, v = np.triu_indices(len(i), 1)
                        a.append(i[u])
                        b.append(i[v])
                    held += len(a[-1])
            if held > 100_000 or len(points) > 50_000:
                yield flush()
        if a:
            yield flush()

    made = rows.mapInArrow(check, ", ".join(f"{x} long" for x in names))
    return made.select(F.struct(F.col("ah").alias("h"), F.col("ag").alias("g")).alias("a"), F.struct(F.col("bh").alias("h"), F.col("bg").alias("g")).alias("b"))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", edits: int = EDITS, min_chars: int = MIN_CHARS, result_prefix: str = "", short: bool = False) -> DataFrame:
    """The rows of docs with their columns, and n_lines, removed (line numbers), first_docs (who keeps each removed line's class), kept.

    ``result_prefix`` goes before the names of the added columns, for tables that have columns of these names.
    ``short`` takes in the lines under ``min_chars``.
    """
    if min_chars <= edits + 1:
        raise ValueError("min_chars must exceed edits + 1, so that every segment has text")
    every = materialise(line_table(docs, id_col, text_col, min_chars, short), "line-table")
    parts = materialise(meetings(docs, text_col, edits, min_chars, every.count(), short), "line-parts")
    lists = materialise(pair_tasks(parts), "line-lists")
    need = materialise(lists.select(F.explode(F.concat("left", "right")).alias("h")).distinct(), "line-need")
    texts = materialise(line_texts(docs, need, text_col, min_chars, short), "line-texts")
    links = materialise(line_links(lists, texts, edits, min_chars), "line-links")
    discard(parts, lists, need, texts)
    label = components(links).select(F.col("node.h").alias("h"), F.col("node.g").alias("g"), F.col("component.h").alias("ch"), F.col("component.g").alias("cg"))
    classed = materialise(every.join(label, ["h", "g"], "left").select("doc_id", "line", F.coalesce("ch", "h").alias("ch"), F.coalesce("cg", "g").alias("cg")), "line-classed")
    # written, so that the join below deals its rows anew and a common line's rows can be split among tasks
    first = materialise(classed.groupBy("ch", "cg").agg(F.min(F.struct("doc_id", "line")).alias("first"), F.count("*").alias("size")).filter("size > 1").select("ch", "cg", "first"), "line-first")
    gone = classed.join(first, ["ch", "cg"]).filter(F.struct("doc_id", "line") > F.col("first"))
    gone_name, doc_name = unused(docs, "_gone"), unused(docs, "_line_doc")
    per_doc = materialise(
        gone.select("doc_id", "line", F.col("first.doc_id").alias("first_doc")).distinct().groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("line", "first_doc"))).alias(gone_name)).withColumnRenamed("doc_id", doc_name),
        "line-gone",
    )
    discard(every, classed, first, links)
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID))
    # what is removed grows with the documents, so this side is never broadcast
    joined = docs.join(per_doc.hint("merge"), key == F.col(doc_name), "left").drop(doc_name)
    gone_lines = F.coalesce(F.col(gone_name)["line"], F.array().cast("array<int>"))
    text = F.col(text_col).cast("string")
    pieces_ = F.split(text, "\n", -1)
    staying = F.array_except(F.sequence(F.lit(0), F.size(pieces_) - 1), gone_lines)
    kept = F.array_join(F.transform(staying, lambda i: F.get(pieces_, i)), "\n")
    return joined.select(
        *[c for c in docs.columns],
        F.when(F.coalesce(text, F.lit("")) == "", 0).otherwise(F.size(pieces_)).cast("long").alias(f"{result_prefix}n_lines"),
        gone_lines.alias(f"{result_prefix}removed"), F.coalesce(F.transform(F.col(gone_name)["first_doc"], lambda x: F.when(x != NULL_ID, x)), F.array().cast("array<long>")).alias(f"{result_prefix}first_docs"),
        F.when(F.size(gone_lines) > 0, kept).otherwise(text).alias(f"{result_prefix}kept"),
    )


def op1_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: doc_id, n_lines, n_removed, the removed lines' numbers and their first documents as comma-separated lists, digest of what is kept."""
    out = line_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"), short=True)
    listed = lambda c: F.array_join(F.transform(c, lambda x: x.cast("string")), ",").alias(c)
    return out.select("doc_id", F.col("n_lines"), F.size("removed").cast("long").alias("n_removed"), listed("removed"), listed("first_docs"), F.sha2(F.coalesce("kept", F.lit("")), 256).alias("kept_sha256"))


# DuckDB's levenshtein counts bytes: each accented letter of the lines becomes one control character first. Of three segments of a line
# one is unedited, so that pairs without it need no comparison.
SQL = r"""
WITH RECURSIVE l AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS t, CAST(unnest(range(0, len(string_split(text, chr(10))))) AS INTEGER) AS line FROM documents WHERE coalesce(text, '') <> ''
), c AS (
  SELECT * FROM l WHERE len(t) >= 25 OR regexp_matches(t, '[^\x20\x09-\x0D]')
), a AS (
  SELECT string_agg(x, '' ORDER BY x) AS letters FROM (SELECT DISTINCT unnest(regexp_extract_all(t, '[^\x00-\x7F]')) AS x FROM c)
), u AS MATERIALIZED (
  SELECT t, len(t) AS n, translate(t, letters, (SELECT string_agg(chr(CAST(k AS INTEGER)), '' ORDER BY k) FROM (SELECT unnest([1, 2, 3, 4, 5, 6, 7, 8, 14, 15, 16, 17, 18, 19, 20, 21, 22, 23, 24, 25, 26, 27, 28, 29, 30, 31, 127]) AS k))) AS x FROM (SELECT DISTINCT t FROM c), a
), links AS MATERIALIZED (
  SELECT s.t AS a, b.t AS b FROM (SELECT *, unnest([0, 1, 2]) AS d, least(2, n * 2 // 25) AS k, n // 3 AS n3 FROM u) AS s JOIN u AS b ON b.n = s.n + d WHERE d <= k AND k > 0 AND (d > 0 OR s.t < b.t) AND (starts_with(b.x, left(s.x, n3)) OR ends_with(b.x, right(s.x, s.n - 2 * n3)) OR contains(b.x, substr(s.x, n3 + 1, n3))) AND levenshtein(s.x, b.x) <= k
), e AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
r(node, low) AS (
  SELECT DISTINCT a, a FROM e
  UNION
  SELECT e.b, r.low FROM r JOIN e ON r.node = e.a WHERE r.low < e.b
), g AS (SELECT node, min(low) AS low FROM r GROUP BY node),
k AS (
  SELECT c.*, coalesce(g.low, c.t) AS class FROM c LEFT JOIN g ON g.node = c.t
), f AS (
  SELECT class, min({d: doc_id, l: line}) AS first FROM k GROUP BY class
), x AS (
  SELECT doc_id, list(line ORDER BY line) AS removed, list(first.d ORDER BY line) AS firsts FROM (SELECT DISTINCT doc_id, line, first FROM k JOIN f USING (class) WHERE {d: doc_id, l: line} > first) GROUP BY doc_id
)
SELECT documents.doc_id, CASE WHEN coalesce(text, '') = '' THEN 0 ELSE len(string_split(text, chr(10))) END AS n_lines, coalesce(len(removed), 0) AS n_removed,
       array_to_string(coalesce(removed, []), ',') AS removed, array_to_string(coalesce(firsts, []), ',') AS first_docs,
       sha256(CASE WHEN removed IS NULL THEN coalesce(text, '') ELSE array_to_string(list_filter(string_split(text, chr(10)), lambda s, i: NOT list_contains(removed, i - 1)), chr(10)) END) AS kept_sha256
FROM documents LEFT JOIN x ON documents.doc_id = x.doc_id
"""
