import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from polyscribe.functions import chars as C
from polyscribe.functions import geometry as G
from polyscribe.functions import similarity as S
from polyscribe.functions import tokens as T
from polyscribe.functions import unicode as U
from polyscribe.operators import words as W
from polyscribe.plans import reports as P


def ask(spark, inputs, *columns, kind="string"):
    """The columns' values for each input, in order."""
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(inputs)], f"i int, x {kind}")
    return [tuple(r) if len(columns) > 1 else r[0] for r in rows.orderBy("i").select(*columns).collect()]


def test_split_text_token(spark):
    cases = {"«λόγος,»": ("«", "λόγος", ",»"), "12λόγος3": ("12", "λόγος", "3"), "...": ("...", "", ""), "ἀλλ’": ("", "ἀλλ’", ""), "’Εν": ("’", "Εν", ""), "-foo-": ("-", "foo-", ""), "[καὶ]·": ("[", "καὶ", "]·"), "": ("", "", "")}
    t = T.split_text_token("x")
    assert ask(spark, list(cases), t["pre"], t["core"], t["post"]) == list(cases.values())
    assert ask(spark, [None], t["core"], T.token_core("x")) == [(None, None)]


def test_numerals(spark):
    assert ask(spark, ["I", "1I2", "(12)", "II.", "†", "word", ""], T.repair_numeral("x")) == ["1", "112", "(12)", "11.", "†", None, ""]
    assert ask(spark, ["αʹ", "ιβ′", "αβγ′", "α"], T.greek_numeral("x")) == ["α′", "ιβ′", None, None]
    assert ask(spark, ["1O0i.", "1(2);", "x1", None], C.is_number_classic("x"), C.is_number("x")) == [(True, True), (False, True), (False, False), (False, False)]


def test_splits(spark):
    p = T.split_on_punctuation("x")
    assert ask(spark, ["a.b", ".a", "a.b.c", "ab"], p["a"], p["mark"], p["b"]) == [("a", ".", "b"), ("", ".", "a"), (None, None, None), (None, None, None)]
    assert ask(spark, ["λόγοςκαὶ", "λόγος", "abc"], T.split_after("x")) == [["λόγος", "καὶ"], ["λόγος", ""], ["abc"]]
    assert [[tuple(h) for h in r] for r in ask(spark, ["abcdefghij", "abcdefghi", "abcdefghijkl"], T.halves("x"))] == [[("abcde", "fghij"), ("abcdef", "ghij")], [], [("abcdef", "ghijkl"), ("abcdefg", "hijkl"), ("abcde", "fghijkl"), ("abcdefgh", "ijkl")]]
    assert ask(spark, ["aabbcc", "abc", "αα\n\n"], T.collapse_repeats("x")) == ["abc", "abc", "α\n"]
    assert ask(spark, ["banana", "x", ""], T.find_occurrences("x", "a")) == [[1, 3, 5], [], []]
    assert ask(spark, ["(a) b;c.d  e"], T.line_tokens("x")) == [["a", "b", "c", "d", "e"]]
    assert ask(spark, ["aeffoeflfi"], T.make_ligatures("x")) == ["æﬀœﬂﬁ"]


def test_normal_forms(spark):
    assert ask(spark, ["a b", "d’un", "d'un", "ἀλλʼ", "’Εν", "é"], T.preprocess_word("x")) == ["ab", "d’un", "d’un", "ἀλλ’", unicodedata.normalize("NFC", "Ἐν"), "é"]
    assert ask(spark, ["a.b", ".ab.", "d’un"], T.preprocess_word_fuzzy("x")) == ["ab", ".ab.", "dun"]
    assert ask(spark, ["«Λόγος,»", "ΛΟΓΟΣ", "d'Un"], T.dictionary_key("x"), T.lower_key("x")) == [("Λόγος", "λόγος"), ("ΛΟΓΟΣ", "λογοσ"), ("d’Un", "d’un")]
    assert ask(spark, ["ἀλλά", "é", None], U.strip_accents("x"), U.show_marks("x")) == [("αλλα", "α↲λλα↗"), ("e", "e↗"), (None, None)]
    assert ask(spark, ["é̂x"], U.recursive_combine("x")["base"], U.recursive_combine("x")["rejects"]) == [("é", "̂x")]
    assert U.combined("e", "́") == "é" and U.combined("x", "y") is None
    assert "GREEK SMALL LETTER ALPHA" in U.describe_characters("α") and U.forms("é") == "NFC,NFKC"


@settings(max_examples=50)
@given(st.text(max_size=12))
def test_normalisation_is_idempotent(x):
    for form in ("NFC", "NFD"):
        once = unicodedata.normalize(form, x)
        assert unicodedata.normalize(form, once) == once
    assert U.bare(U.bare(x)) == U.bare(x)


def test_scripts(spark):
    words = ["λόγος,", "logos", "123", "αβγδεζηabc", "αβγδεζηθabc", "שלום", "", None]
    assert ask(spark, words, C.is_greek_string("x")) == [True, False, False, False, True, True, False, False]
    assert ask(spark, ["." * 40 + "α"], C.is_greek_string("x"), C.is_greek_string("x", cap=32)) == [(True, False)]
    assert ask(spark, ["ΛΟΓΟΣ", "Λόγος", "", None], C.is_uc_word("x")) == [True, False, False, False]
    assert ask(spark, ["Λόγος", "Word", "WORD", "word", "", None], C.is_capitalized("x")) == [True, True, False, False, False, False]
    assert ask(spark, ["α", "ͱ", "א", "Ω", "a"], C.is_greek_char("x"), C.is_hebrew_char("x"), C.is_greek_capital("x")) == [(True, False, False), (False, False, False), (False, True, False), (True, False, True), (False, False, False)]
    assert ask(spark, [["λόγος", "x"]], C.delete_non_greek_tokens("x"), kind="array<string>") == [["λόγος"]]


def test_geometry(spark):
    box = G.title_bbox("x")
    assert ask(spark, ["image a.png; bbox 1 2 30 40; ppageno 1", "bbox 5 6 7 8", "nothing", None], box["x0"], box["y1"]) == [(1, 40), (5, 8), (None, None), (None, None)]
    assert ask(spark, ["bbox 1 2 3 4", "bbox 1 2 3 4 5", "x 1 2 3 4"], G.strict_bbox("x")["x1"]) == [3, None, None]
    assert ask(spark, ["x 1; y 2", "a"], G.with_bbox("x", F.struct(*[F.lit(i).alias(c) for i, c in enumerate(G.CORNERS)]))) == ["bbox 0 1 2 3; y 2", "bbox 0 1 2 3"]
    assert ask(spark, ["bbox 7 8", "x"], G.title_number("x", 1), G.title_number("x", 9)) == [(7, -1), (-1, -1)]
    assert ask(spark, ["bbox 1 2 3 4; x_confs 0.5 1 0.25", "bbox 1 2 3 4", "a; b c d"], G.confidences("x")) == [[0.5, 1.0, 0.25], None, None]
    assert ask(spark, [-59, 79], G.bucket(F.col("x"), 40), kind="int") == [-1, 1]


def test_edit_weights():
    assert S.edit_script("abc", "abc") == [] and S.edit_script("ac", "abc") == [("insert", 1, 1)] and S.edit_script("abc", "ac") == [("delete", 1, 1)] and S.edit_script("abc", "axc") == [("replace", 1, 1)]
    assert S.edit_weight("0x", "Οx") == 1 and S.edit_weight("xq", "xw") == 9 or S.edit_weight("xq", "xw") == 10
    assert S.edit_weight("αb", "αb'") == 1 and S.edit_weight("α", "α↗") == 3 and S.edit_weight("α↗", "α") == 3


@settings(max_examples=150, deadline=None)
@given(st.text("abα", max_size=8), st.text("abα", max_size=8))
def test_scripts_and_ratios(a, b):
    script, out, at = S.edit_script(a, b), [], 0
    for operation, i, j in script:
        out.append(a[at:i])
        at = i + (operation != "insert")
        out.append("" if operation == "delete" else b[j])
    assert "".join(out) + a[at:] == b
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    assert S.common_subsequence(a, b) == table[-1][-1]


def test_ratio_and_trigrams(spark):
    assert S.marked_ratio("λόγος", "λόγος") == 1 and abs(S.marked_ratio("abcd", "abxd") - 0.75) < 1e-9 and S.marked_ratio("", "") == 1
    rows = spark.createDataFrame([(1, "abc", "abc"), (2, "abc", "xyz"), (3, "aaaa", "aaa"), (4, None, "a")], "i int, a string, b string")
    got = dict(S.trigram_similarities(rows, "i", "a", "b").collect())
    assert got == {1: 1.0, 2: 0.0, 3: pytest.approx(5 / 6)}


def test_hashes(spark):
    rows = spark.createDataFrame([(i, [float((i * 7 + k * k) % 13) for k in range(64)]) for i in range(60)] + [(90, [1.0] * 64)], "i int, v array<double>")
    hashed = rows.select("i", S.hash_words(S.average_hash(F.col("v"))).alias("h"))
    have = dict(hashed.collect())
    got = {(r["a"], r["b"]): r["distance"] for r in W.hash_pairs(hashed, "i", "h").collect()}
    bits = lambda a, b: ((a ^ b) & (2**64 - 1)).bit_count()
    assert got == {(a, b): bits(have[a], have[b]) for a in have for b in have if a < b and bits(have[a], have[b]) < 11}
    assert W.hash_pairs(hashed, "i", "h").count() == len(got)


def test_report_scalars(spark):
    assert ask(spark, [0.0, 0.5, None, 0.123], P.accuracy_colour(F.col("x")), kind="double") == ["hsl(0, 0%, 0%)", "hsl(100,73%,55%)", "hsl(0, 0%, 86%)", "hsl(24,73%,55%)"]
    assert ask(spark, ["a_b.c"], W.file_identifier(F.col("x"))) == ["aULbPERIODc"]
    assert ask(spark, ["bbox 1 2; x"], W.page_title(F.col("x"), F.lit("p_1.html"))) == ["image p_1.png; bbox 1 2"]
