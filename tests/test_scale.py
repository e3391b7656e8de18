"""Steps whose rows or shuffles once grew beyond their input: the same results, and plans without what made them grow."""

import random
import re
from math import cos, floor, pi, sin

import numpy as np
import pytest
from pyspark.sql import functions as F

from polyscribe.functions import similarity as S
from polyscribe.functions import tokens as T
from polyscribe.operators import fuzzy as Z
from polyscribe.operators import layout as L
from polyscribe.operators import lookup as J
from polyscribe.operators import words as W
from polyscribe.plans import cascade as K
from polyscribe.plans import catalog
from polyscribe.sources import hocr as H
from tests.conftest import values


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_nearest_classes_equal_brute_force_without_sorting_samples(spark):
    rng = random.Random(1)
    samples = [(i, rng.choice("abc"), rng.randrange(9), rng.randrange(9)) for i in range(40)]
    asked = [(i, rng.randrange(9), rng.randrange(40) if i % 7 else None) for i in range(300)]
    out = L.nearest_classes(spark.createDataFrame(asked, "i int, x int, y int"), spark.createDataFrame(samples, "sample_id int, label string, x int, y int"), ["x", "y"])
    distance = lambda p, s: ((p[0] - s[2]) ** 2 + (p[1] - s[3]) ** 2) ** 0.5
    limit = 1.2 * max(min(distance(a[2:], b) for b in samples if b[0] != a[0]) for a in samples)
    want = []
    for i, x, y in asked:
        near = sorted((distance((x, y), s), s[0], s[1]) for s in samples)[:3] if y is not None else []
        found = [n[2] for n in near]
        label = min(found, key=lambda v: (-found.count(v), v)) if near and near[0][0] <= limit else None
        want.append((i, near[0][0] if near else None, label))
    assert values(out, "i", "nearest", "label") == sorted(want, key=repr)
    assert "array_sort" not in plan(out)


def test_line_votes_equal_brute_force_and_are_never_rows(spark):
    rng = random.Random(2)
    points = [(p, rng.randrange(60), rng.randrange(200)) for p in (1, 2, None) for _ in range(50)] + [(3, rng.randrange(10**8), rng.randrange(10**8)) for _ in range(20)] + [(4, None, 1)]
    df = spark.createDataFrame(points, "page_id long, x int, y int")
    cells = {}
    for p, x, y in points:
        for a in range(40 if x is not None else 0):
            t = (a - 19.5) / 40 * 0.2 * pi
            at = (p, floor((x * cos(t) + y * sin(t)) / 4), a)
            cells[at] = cells.get(at, 0) + 1
    peaks = [(p, r, a, n) for (p, r, a), n in cells.items() if n >= max(cells.get((p, r + i, a + j), 0) for i, j in ((0, 1), (0, -1), (1, 0), (-1, 0)))]
    votes = L.line_votes(df)
    assert values(votes) == sorted(peaks, key=repr)
    best = L.line_votes(df, count=2)
    assert values(best, "page_id", "rank", "radius_no", "angle_no", "votes") == values(L.best_lines(votes), "page_id", "rank", "radius_no", "angle_no", "votes")
    assert "Generate" not in plan(votes) and "Join" not in plan(best)


def test_both_forms_of_an_accumulator_agree():
    rng = np.random.default_rng(3)
    x, y = rng.integers(0, 90, 200).astype(float), rng.integers(0, 90, 200).astype(float)
    turns = [(cos(t), sin(t)) for t in (-0.2, 0.0, 0.2)]
    table = sorted(zip(*map(list, L._peaks(x, y, turns, 4)), strict=True))
    held, L.TABLE_CELLS = L.TABLE_CELLS, -(10**9)
    try:
        assert sorted(zip(*map(list, L._peaks(x, y, turns, 4)), strict=True)) == table
    finally:
        L.TABLE_CELLS = held


@pytest.mark.parametrize("name", ["dehyph_pairs", "hyphen_rules", "triplet_retention", "space_share", "title_bands", "page_words", "page_clean_up"])
def test_pages_are_dealt_out_once_and_words_never(spark, data, name):
    shuffles = re.findall(r"Exchange hashpartitioning\(.*", plan(catalog.QUERIES[name](spark, data)))
    assert shuffles and all("REPARTITION_BY_NUM" in x for x in shuffles)


@pytest.mark.parametrize("name", ["line_first_last", "greek_tokens", "line_chunks"])
def test_queries_of_lines_move_nothing(spark, data, name):
    text = plan(catalog.QUERIES[name](spark, data))
    assert "Exchange" not in text and "Sort" not in text


def test_spaces_and_title_bands_read_their_words_once(spark, data):
    assert "Union" not in plan(catalog.QUERIES["space_share"](spark, data)) and "Union" not in plan(catalog.QUERIES["title_bands"](spark, data))


def test_labels_meet_documents_and_a_small_lexicon_the_words(spark, data):
    text = plan(catalog.QUERIES["page_accuracy"](spark, data))
    assert "values-" not in text and len(re.findall(r"Exchange hashpartitioning", text)) == 1
    words = spark.createDataFrame([(t,) for t in ("Abc", "abc", "xyz", "(abc)", None)], "text string")
    wanted = [(None, False, False), ("Abc", False, True), ("abc", True, True), ("(abc)", False, True), ("xyz", False, False)]
    assert values(J.in_lexicon_by_case(words, J.make_lexicon(spark.createDataFrame([("abc",)], "word string"))), "text", "_e", "_l") == sorted(wanted, key=repr)
    large = J.make_lexicon(spark.createDataFrame([("abc",)], "word string"))
    J.sized(large, rows=0)
    assert values(J.in_lexicon_by_case(words, large), "text", "_e", "_l") == sorted(wanted, key=repr)


def test_windows_are_counted_as_they_are_made(spark):
    lines = spark.createDataFrame([([],), (["a"],), (["a", "b", "c"],), (list("abcdef"),)], "ws array<string>")
    assert lines.select(T.window_count("ws", 3).alias("n"), F.size(T.windows("ws", 3)).alias("m")).filter("n != m").count() == 0


def test_several_pages_are_parsed_into_one_batch(spark):
    markup = '<p class="ocr_page" title="x"><span class="ocr_line"><span class="ocrx_word" title="bbox 1 2 3 4" data-manually-confirmed="true">w</span></span></p>'
    pages = spark.createDataFrame([(str(i), markup if i % 3 else "") for i in range(9)], "page_id string, markup string").coalesce(1)
    got = H.parse_words(pages).select("page_id", "line_no", "text", "bbox.x1", "manually_confirmed", "selected_form", F.spark_partition_id())
    assert values(got) == [(str(i), 0, "w", 3, "true", None, 0) if i % 3 else (str(i), None, None, None, None, None, 0) for i in range(9)]


def test_a_key_is_asked_for_once_and_found_in_every_way(spark):
    lexicon = J.make_lexicon(spark.createDataFrame([("abc",), ("déf",)], "word string"))
    table = J.sized(K.lookup_table(lexicon, J.make_accent_index(lexicon)))
    asked = spark.createDataFrame([(w, "", w) for w in ("abc", "Abc", "(abc", "def", "déf", "xyz")], "word string, slot string, text string")
    got = values(K._probe(asked, table), "word", "way", "value")
    assert got == sorted([("abc", "exact", "abc"), ("abc", "lower", "abc"), ("abc", "bare", "abc"), ("Abc", "lower", "abc"), ("(abc", "lower", "abc"), ("def", "bare", "déf"), ("déf", "exact", "déf"), ("déf", "lower", "déf"), ("déf", "bare", "déf")], key=repr)
    assert table.count() == 3


def test_hash_pairs_equal_brute_force_and_meet_by_two_bands(spark):
    rng = random.Random(4)
    base = [rng.getrandbits(64) for _ in range(12)]
    hashes = [b ^ sum(1 << i for i in rng.sample(range(64), k)) for b in base for k in (0, 0, 3, 5, 6, 10, 11)]
    rows = [(i, h - (1 << 64) if h >> 63 else h) for i, h in enumerate(hashes)]
    pairs = W.hash_pairs(spark.createDataFrame([*rows, rows[5], (None, 7), (999, None)], "i int, h long"), "i", "h").distinct()
    wanted = [(i, j, (hashes[i] ^ hashes[j]).bit_count()) for i in range(len(hashes)) for j in range(i + 1, len(hashes)) if (hashes[i] ^ hashes[j]).bit_count() < 11]
    assert values(pairs, "a", "b", "distance") == sorted(wanted, key=repr)
    once = W.hash_pairs(spark.createDataFrame(rows, "i int, h long"), "i", "h")
    assert once.count() == len(wanted) and "SortMergeJoin" not in plan(once)


def test_a_small_dictionary_goes_to_the_words_and_a_large_one_meets_them(spark, monkeypatch):
    rng = random.Random(5)
    make = lambda most: "".join(rng.choice("abcλ\U0001d518") for _ in range(rng.randrange(most)))
    edited = lambda x: x[: (i := rng.randrange(len(x) + 1))] + make(3) + x[i + rng.randrange(3) :]
    entries = sorted({make(n) for n in (5, 10, 18, 40, 90) for _ in range(12)} | {"", "a" * 64, "a" * 65})
    words = sorted({edited(x) for x in entries for _ in range(3)} | {make(9) for _ in range(60)} | {"", "a" * 66, "xyz"})
    left, right = spark.createDataFrame([(x,) for x in [*words, *words, None]], "word string"), spark.createDataFrame([(x,) for x in [*entries, *entries, None]], "entry string")
    for k in (1, 3):
        want = sorted([(w, x, d) for w in words for x in entries if abs(len(w) - len(x)) <= k and (d := len(S.edit_script(w, x))) <= k], key=repr)
        for most in (Z.DIRECT_CELLS, 0):
            with monkeypatch.context() as patch:
                patch.setattr(Z, "DIRECT_CELLS", most)
                patch.setattr(Z, "BATCH_PAIRS", 50)
                assert values(Z.fuzzy_pairs(left, right, k)) == want


@pytest.mark.parametrize("name", ["fuzzy_matches", "weighted_best"])
def test_fuzzy_words_are_compared_in_all_tasks_without_candidates(spark, data, name):
    text = plan(catalog.QUERIES[name](spark, data))
    assert "MapInArrow" in text and "levenshtein" not in text and "Generate" not in text
    assert re.findall(r"Exchange hashpartitioning\(word#.*REPARTITION_BY_NUM", text)


def test_distinct_words_are_those_of_lines(spark):
    docs = spark.createDataFrame([(1, " a b\n\nc\td\r\x0b e\u00a0f \n"), (2, ""), (3, None), (4, "a\x0cb\x85g\n")], "doc_id long, text string")
    assert values(W.distinct_words(docs)) == values(W.text_words(docs).select("text").distinct())
