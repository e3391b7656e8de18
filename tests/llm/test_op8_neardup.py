import random

import numpy as np

from polyscribe.llm.op8_neardup import SQL, near_duplicates, op8_neardup
from polyscribe.llm.setsketch import REGISTERS, likeness, sketch
from tests.llm.helpers import edge_rows, prose, table, words
from tests.oracle import compare


def shingles(text, n=5):
    w = [x.translate({65 + i: 97 + i for i in range(26)}) for x in words(text)]
    return {tuple(w)} if 0 < len(w) < n else {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}


def brute(rows, threshold=85):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= threshold * len(sets[i] | sets[j]) or rows[i][0] == rows[j][0]:
                root[find(i)] = find(j)
    low = {}
    key = lambda d: -(2**63) if d is None else d
    for i, (d, _) in enumerate(rows):
        r = find(i)
        low[r] = min(low.get(r, key(d)), key(d))
    out = []
    for i, (d, _) in enumerate(rows):
        c = low[find(i)]
        out.append((d, len(sets[i]), None if c == -(2**63) else c, key(d) == c))
    return sorted(out, key=repr)


def check(spark, rows, **more):
    got = sorted((tuple(r) for r in near_duplicates(table(spark, rows), **more).collect()), key=repr)
    assert got == brute(rows, more.get("threshold", 85))


def edited(text, times, seed):
    rng = random.Random(seed)
    w = text.split()
    for _ in range(times):
        w[rng.randrange(len(w))] = f"edit{rng.randrange(10**6)}"
    return " ".join(w)


def rows():
    base = [prose(i, 200) for i in range(15)]
    out = [(i, t) for i, t in enumerate(base)]
    for k, t in enumerate(base):
        out += [(100 + 10 * k + e, edited(t, e, k * 17 + e)) for e in range(9)]
    return out + [(900 + i, base[3].upper()) for i in range(4)]


def test_brute_force(spark):
    check(spark, rows())
    check(spark, rows(), threshold=80)


def test_chunks_of_a_large_group(spark):
    near = prose(5, 300)
    check(spark, [(i, edited(near, 1 + i % 4, i)) for i in range(90)])


def test_edges(spark):
    check(spark, [r for r in edge_rows() if r[0] is not None])
    got = near_duplicates(table(spark, edge_rows())).collect()
    assert sorted(r["n_shingles"] for r in got if r["doc_id"] is None) == [0, 3]
    assert near_duplicates(table(spark, [])).count() == 0


def test_sketches_merge_and_estimate():
    rng = np.random.default_rng(3)
    for share in (0.5, 0.8, 0.9):
        union = rng.integers(0, 2**63, 2000, dtype=np.uint64)
        both = int(2000 * share)
        a, b = union[: both + (2000 - both) // 2], np.concatenate([union[:both], union[both + (2000 - both) // 2 :]])
        ra, rb, whole = (sketch(x, np.array([0])) for x in (a, b, union))
        assert (np.maximum(ra, rb) == whole).all() and ra.shape[1] == REGISTERS
        assert abs(likeness(ra, rb, np.array([len(a)]), np.array([len(b)]))[0] - share) < 0.11


def test_sql(spark, data):
    compare(op8_neardup(spark, data), SQL, data)
