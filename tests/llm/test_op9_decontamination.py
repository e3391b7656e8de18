import random

import numpy as np

from polyscribe.llm import op9_decontamination as op
from tests.llm.helpers import edge_rows, prose, table
from tests.oracle import compare


def items(spark, rows):
    return spark.createDataFrame([(i, t, "q", 1.0) for i, t in rows], "item_id long, text string, term string, weight double")


ITEMS = [(i, f"{prose(500 + i, 14, 300)}. {prose(700 + i, 9, 300)}?\n{prose(800 + i, 6, 300)}.") for i in range(30)] + [(40, "Short item."), (41, None), (42, ""), (None, prose(77, 20))]


def documents():
    rng = random.Random(1)
    rows = [(i, prose(i, 50 + i * 9 % 400, 300)) for i in range(80)]
    for i in range(30):
        text = ITEMS[i % 30][1]
        if i % 3 == 1:
            text = text.upper().replace(".", "!")
        if i % 3 == 2:
            w = text.split()
            w[rng.randrange(len(w))] = "changed"
            text = " ".join(w)
        rows.append((200 + i, f"{prose(i, 40 * (i % 5), 300)} {text} {prose(i + 50, 30, 300)}"))
    return rows


def test_planted_items_are_found_and_clean_documents_left(spark):
    rows = documents()
    got = op.contaminated(table(spark, rows), items(spark, ITEMS)).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} >= {(200 + i, i) for i in range(30)}
    assert {r["doc_id"] for r in got} <= {200 + i for i in range(30)}


def test_shards_give_the_same_rows(spark):
    rows = documents()
    one, many = (sorted((tuple(r) for r in op.contaminated(table(spark, rows), items(spark, ITEMS), shard_words=n).collect()), key=repr) for n in (10**6, 200))
    assert one == many and one


def test_search_equals_exhaustive_scoring():
    rng = np.random.default_rng(2)
    n_items, n_terms = 400, 120
    postings, uid = [], np.arange(n_items)
    for u in uid:
        terms = rng.choice(n_terms, rng.integers(3, 15), replace=False)
        w = rng.random(len(terms)) ** 3
        postings += [(int(u), int(t), round(x * op.UNIT)) for t, x in zip(terms, w / w.sum(), strict=True)]
    index = op.Index([(int(u), int(u), "a b. c") for u in uid], postings, 64)
    assert index.ids == uid.tolist()
    for threshold in (0.2, 0.5, 0.8):
        least, passage, term, scores = round(threshold * op.UNIT), [], [], np.zeros((60, n_items))
        for p in range(60):
            asked = rng.choice(n_terms, rng.integers(1, 60), replace=False)
            for u, t, w in postings:
                if t in asked:
                    scores[p, u] += w
            known = np.flatnonzero(np.isin(index.terms, asked.astype(np.uint64)))
            passage, term = passage + [p] * len(known), term + known.tolist()
        for cells in (1, 500, op.CELLS):  # few cells at once: many rounds
            index_cells, op.CELLS = op.CELLS, cells
            found = {(p, u): s for part in index.search(np.array(passage), np.array(term), least) for p, u, s in zip(*(x.tolist() for x in part), strict=True)}
            op.CELLS = index_cells
            assert found == {(int(p), int(u)): scores[p, u] for p, u in zip(*np.nonzero(scores >= least), strict=True)}


def test_item_in_two_passages_is_reported_with_the_first(spark):
    asked = [(i, f"{prose(600 + i, 20, 3000)}. {prose(640 + i, 9, 3000)}.") for i in range(40)]
    docs = [(i, f"{prose(i, 64 + 65, 3000)} {t} {prose(i + 90, 200, 3000)}") for i, t in asked]
    runs = [sorted(tuple(r) for r in op.contaminated(table(spark, docs, n), items(spark, asked)).collect()) for n in (1, 5)]
    assert runs[0] == runs[1] and [(r[0], r[1], round(r[2], 9), r[5]) for r in runs[0]] == [(i, i, 1.0, 64) for i in range(40)]


def test_a_long_item_leaves_the_passages_of_short_ones_alone(spark):
    long = prose(3, 20_000, 5000)
    docs = [(1, f"{prose(4, 100)} {long} {prose(5, 100)}"), (2, " ".join(long.split()[:6000])), (3, documents()[81][1])]
    alone = op.contaminated(table(spark, docs), items(spark, ITEMS)).collect()
    both = op.contaminated(table(spark, docs), items(spark, [*ITEMS, (90, f"{long}.")])).collect()
    assert {(r["doc_id"], r["item_id"]) for r in alone} == {(3, 1)}
    assert {(r["doc_id"], r["item_id"]): r["first_word"] for r in both} == {(3, 1): alone[0]["first_word"], (1, 90): 0}


def test_split_of_items():
    assert op.split_item("One two. Three four? five six.") == ("One two. Three four?", "five six.")
    assert op.split_item("a b c d e f") == ("a b c d", "e f")
    assert op.split_item("word") == ("word", "word")


def test_keep_clean(spark):
    rows = documents() + edge_rows()
    kept = op.keep_clean(table(spark, rows), items(spark, ITEMS))
    assert kept.count() == len(rows) - 30 and kept.columns == table(spark, []).columns


def test_edges(spark):
    got = op.contaminated(table(spark, edge_rows() + [(50, "a short item!"), (51, prose(77, 20))]), items(spark, ITEMS)).collect()
    assert sorted(((r["doc_id"], r["item_id"]) for r in got), key=repr) == [(50, 40), (51, None)]
    assert op.contaminated(table(spark, []), items(spark, ITEMS)).count() == 0
    assert op.contaminated(table(spark, edge_rows()), items(spark, [])).count() == 0


def test_sql(spark, data):
    compare(op.op9_decontamination(spark, data), op.SQL, data)


def test_items_with_a_part_of_no_words_or_one(spark):
    body = prose(901, 14, 300)
    rows = [(1, f'{body}. """'), (2, f"{prose(902, 14, 300)} is called. ____"), (3, f"... {prose(903, 14, 300)}"), (4, "2 + 2 = ?"), (5, f"{prose(905, 14, 300)}? Yes"), (6, "7 ?")]
    docs = [(10 + i, f"{prose(i, 40, 300)} {t} {prose(i + 50, 30, 300)}") for i, t in rows[:4]]
    docs += [(25, f"{rows[4][1][:-3]} No. {prose(60, 30, 300)}"), (26, f"{rows[4][1]} {prose(61, 30, 300)}"), (31, prose(62, 60, 300)), (32, "page 2 of 9"), (33, f"No. {' '.join(reversed(body.split()))}")]
    got = {(r["doc_id"], r["item_id"]): r for r in op.contaminated(table(spark, docs), items(spark, rows)).collect()}
    assert set(got) == {(11, 1), (12, 2), (13, 3), (14, 4), (25, 5), (26, 5)}
    assert got[11, 1]["answer_overlap"] == 1 and got[26, 5]["answer_overlap"] == 1 and 0.5 <= got[25, 5]["answer_overlap"] < 1
    assert op.keep_clean(table(spark, docs), items(spark, rows)).count() == 3
