import pytest
from pyspark.sql import functions as F

from polyscribe.functions import chars as C
from polyscribe.functions import similarity as S
from polyscribe.functions import tokens as T
from polyscribe.functions import unicode as U
from polyscribe.operators import dehyphenate as D
from polyscribe.operators import fuzzy as Z
from polyscribe.operators import layout as L
from polyscribe.operators import lookup as J
from polyscribe.operators import retention as R
from polyscribe.operators import words as W
from polyscribe.plans import apply as A
from polyscribe.plans import cascade as K
from polyscribe.plans import metadata as M
from polyscribe.plans import reports as P
from tests.conftest import values


def page(spark, *lines, page_id="p"):
    rows = [(page_id, i, k, w) for i, line in enumerate(lines) for k, w in enumerate(line.split(" ") if line else [])]
    return spark.createDataFrame(rows, "page_id string, line_no int, word_no int, text string")


def lexicon(spark, *words):
    return J.make_lexicon(spark.createDataFrame([(w,) for w in words], "word string"))


# --- dehyphenation


def test_hyphen_pairs(spark):
    words = page(spark, "one exam- ple", "", "12 ple two-", "three ab-", "-", "cd")
    got = {(r["head"], r["tail"], r["rule"]) for r in D.hyphen_pairs(words).collect()}
    # the word before the last is a head; a number is passed over; the head needs over two characters
    assert got == {("exam-", "ple", "before_last"), ("two-", "three", "last"), ("ab-", "-", "last")}
    assert {r["joined"] for r in D.hyphen_pairs(words).collect()} == {"example", "twothree", "ab-"}


def test_dehyphenate_attributes(spark):
    got = {r["text"]: r for r in D.dehyphenate(page(spark, "the exam-", "ple-", "end here")).collect()}
    assert (got["exam-"]["dehyphenated_form"], got["exam-"]["hyphen_position"], got["exam-"]["hyphen_end_pair"]) == ("example-", 5, "p#0")
    # a word that is tail and then head keeps both pair names and the later form
    assert (got["ple-"]["dehyphenated_form"], got["ple-"]["hyphen_start_pair"], got["ple-"]["hyphen_end_pair"]) == ("pleend", "p#0", "p#1")
    assert got["end"]["dehyphenated_form"] == "" and got["here"]["dehyphenated_form"] is None
    counted = sorted(r["word"] for r in W.countable(D.dehyphenate(page(spark, "an exam-", "ple last-"))).collect())
    assert counted == ["an", "example"]


def test_plain_text_tokens(spark):
    rows = spark.createDataFrame([("a exam-\n\nple b-\nc d",), ("x-",), ("",), (None,)], "t string")
    assert [r[0] for r in rows.select(D.text_tokens(F.col("t"))).collect()] == [["a", "example", "bc", "d"], ["x-"], [], None]


def test_wrapping_and_rejoining_restores_words(spark):
    words = page(spark, *[" ".join(f"word{'x' * (k % 9)}{i}z" for k in range(11)) for i in range(9)])
    again = W.countable(D.dehyphenate(D.wrap(words, 3)))
    assert values(again, "word") == values(words, "text")
    assert D.wrap(words, 3).filter("text LIKE '%-'").count() > 5


# --- lookups and cascade


def test_vocabulary_and_lookups(spark):
    words = page(spark, "«λόγος,» λόγος ΛΟΓΟΣ ... d’un d'un", "λόγος")
    assert values(J.vocabulary(words), "word", "n") == sorted([("λόγος", 3), ("ΛΟΓΟΣ", 1), ("...", 1), ("d’un", 2)], key=repr)
    lex = lexicon(spark, "λόγος", "d'un", "", None)
    vocab = J.vocabulary(words)
    assert values(J.in_lexicon(vocab, lex, F.col("word")).filter("hit"), "word") == sorted([("λόγος",), ("d’un",)], key=repr)
    found = dict(values(J.without_accents(vocab, J.make_accent_index(lex)), "word", "found"))
    assert found["λόγος"] == "λόγος" and found["ΛΟΓΟΣ"] is None
    assert values(J.unknown_words(vocab, lex), "word") == sorted([("ΛΟΓΟΣ",), ("...",)], key=repr)


RULES = [(0, "0", "o"), (1, "1", "l"), (2, "1", "i"), (3, "d", "ό")]


def corrected(spark, lex, *words):
    vocab = spark.createDataFrame([(w, i + 1) for i, w in enumerate(words)], "word string, n long")
    entries = lexicon(spark, *lex)
    rules = spark.createDataFrame(RULES, "ord int, from string, to string")
    return {r["word"]: (r["mode"], r["output"]) for r in K.correct(vocab, entries, J.make_accent_index(entries), rules).collect()}


def test_cascade(spark):
    lex = ["λόγος", "καί", "arma", "virum", "oil", "lil", "helo", "first", "second", "ll"]
    got = corrected(spark, lex, "arma", "ARMA", "λογος", "ar.ma", "arma.virum", "λόγοςκαί", "λόγοςκαι", "λόγοςxyz", "1I2", "ιβʹ", "armaque", "0il", "l1l", "heeelo", "firstsecond", "zzz", "λdγος")
    assert got == {
        "arma": ("True", ""), "ARMA": ("TrueLower", ""), "λογος": ("NoAcc", "λόγος"), "ar.ma": ("PunctStrip", "arma"), "arma.virum": ("SplitOnPunct", "arma. virum"),
        "λόγοςκαί": ("Split", " λόγος καί"), "λόγοςκαι": ("SplitNoAcc", " λόγος καί"), "λόγοςxyz": ("False", ""), "1I2": ("Numerical", "112"), "ιβʹ": ("Numerical", "ιβ′"), "armaque": ("True", ""),
        "0il": ("Sub 0->o", "oil"), "l1l": ("Sub 1->i", "lil"), "heeelo": ("Dedup", "helo"), "firstsecond": ("True", "first second"), "zzz": ("False", ""), "λdγος": ("Sub d->ό", "λόγος"),
    }


def test_last_rule_and_first_place_win(spark):
    got = corrected(spark, ["lb1", "1bi", "ib1"], "1b1")
    assert got["1b1"] == ("Sub 1->i", "ib1")


def test_summaries(spark):
    rows = spark.createDataFrame([("ab", "", 3, "True"), ("c", "", 1, "False")], K.SCHEMA)
    modes = K.mode_summary(rows)
    assert values(modes) == [("False", 1, 1), ("True", 3, 6)]
    t = K.totals(modes).first()
    assert (t["percent_known"], round(t["percent_biomass"], 3)) == (75.0, 85.714)
    assert K.totals(K.mode_summary(rows.limit(0))).first()["percent_known"] is None


def test_apply_corrections(spark):
    words = D.dehyphenate(page(spark, "«Arma, virnm ar.ma exem-", "plo 12 ..."))
    table = spark.createDataFrame([("Arma", "", "TrueLower"), ("virnm", "virum", "Sub n->u"), ("ar.ma", "arma", "PunctStrip"), ("exemplo", "exempla", "Sub o->a"), ("zz", "", "False")], "word string, output string, mode string")
    rows = {(r["line_no"], r["word_no"]): r for r in A.apply_corrections(words, table).collect()}
    assert rows[0, 0]["text"] == "«Arma," and rows[0, 0]["spellcheck_mode"] == "TrueLower" and rows[0, 0]["pre_spellcheck"] is None
    assert rows[0, 1]["text"] == "virum" and rows[0, 1]["pre_spellcheck"] == "virnm" and rows[0, 1]["selected_form"] == "virum"
    assert rows[0, 2]["text"] == "ar.ma" and rows[0, 2]["spellchecked_form"] == "arma"
    assert (rows[0, 3]["text"], rows[1, 0]["text"], rows[1, 0]["spellcheck_mode"], rows[0, 3]["dehyphenated_form"]) == ("exem-", "pla", "Sub o->a", "exempla")
    assert rows[1, 0]["selected_form"] is None and rows[1, 1]["spellcheck_mode"] == "Numerical" and rows[1, 2]["spellcheck_mode"] == "Numerical"
    assert words.count() == len(rows)


# --- fuzzy


def test_blocked_join_equals_brute_force(spark):
    import random

    rng = random.Random(4)
    make = lambda: "".join(rng.choice("abcd") for _ in range(rng.randrange(0, 12)))
    a, b = {make() for _ in range(150)}, {make() for _ in range(120)}
    left, right = spark.createDataFrame([(x,) for x in a] + [(None,)], "word string"), spark.createDataFrame([(x,) for x in b], "entry string")
    for k in (1, 2, 3):
        got = {(r["word"], r["entry"]): r["distance"] for r in Z.fuzzy_pairs(left, right, k).collect()}
        d = lambda x, y: len([1 for o in S.edit_script(x, y)])
        assert got == {(x, y): d(x, y) for x in a for y in b if d(x, y) <= k}


def test_fuzzy_correction(spark):
    dictionary = spark.createDataFrame([("λόγος", 0), ("ἄνθρωπος", 1), ("πόλις", 2)], "word string, ord long")
    dictionary = dictionary.withColumn("form", U.show_marks(F.col("word")))
    vocab = spark.createDataFrame([("λογος",), ("Λογος",), ("λόγος",), ("ἄνθρωποζ",), ("qqqqqq",)], "word string")
    got = {r["word"]: r["best"] for r in Z.correct_vocabulary(vocab, dictionary).collect()}
    assert got["λογος"] == "λόγος" and got["ἄνθρωποζ"] == "ἄνθρωπος" and "λόγος" not in got and "qqqqqq" not in got
    assert got["Λογος"] in ("Λόγος", "λόγος")
    pairs = spark.createDataFrame([("a", "b", 2), ("a", "c", 1), ("a", "d", 1)], "word string, entry string, weight int")
    assert values(Z.best_candidates(pairs)) == [("a", "c", 1)]
    assert values(Z.best_candidates(pairs, 2)) == [("a", 1, "c", 1), ("a", 2, "d", 1)]
    texts = spark.createDataFrame([("λόγος καὶ λό-\nγος ΛΟΓΟΣ a",)], "text string")
    assert values(Z.candidate_vocabulary(texts)) == sorted([("λόγος",), ("καὶ",)], key=repr)


# --- layout


def boxed(spark, *cells):
    """cells: (line, word, text, x0, y0, x1, y1)."""
    rows = [("p", a, b, t, (x0, y0, x1, y1)) for a, b, t, x0, y0, x1, y1 in cells]
    return spark.createDataFrame(rows, "page_id string, line_no int, word_no int, text string, bbox struct<x0:int,y0:int,x1:int,y1:int>")


def test_space_sharing(spark):
    def shared(*xs):
        cells = [(0, i, t, a, 0, b, 9) for i, (t, a, b) in enumerate(xs)]
        return [(r["text"], r["bbox"]["x0"], r["bbox"]["x1"]) for r in L.share_spaces(boxed(spark, *cells)).orderBy("word_no").collect()]

    assert shared(("a", 0, 100), (" ", 100, 130), ("b", 130, 200)) == [("a", 0, 105), ("b", 123, 200)]
    assert shared(("a", 0, 100), (" ", 100, 109), ("b", 109, 200)) == [("a", 0, 103), ("b", 106, 200)]
    assert shared((" ", 0, 9), ("a", 10, 20), (" ", 20, 30)) == [("a", 10, 20)]
    # a run: the second space sees a space before it, whose box the first one has changed
    assert shared(("a", 0, 100), (" ", 101, 103), (" ", 110, 115), ("b", 140, 150)) == [("a", 0, 103), ("b", 133, 150)]


def test_oversize_and_components(spark):
    words = boxed(spark, (0, 0, "a", 0, 0, 10, 10), (0, 1, "b", 0, 0, 20, 20))
    assert [r["text"] for r in L.without_oversize(words, F.lit(300)).collect()] == ["a"]
    parts = spark.createDataFrame([("p", 1, 0, 0, 2, 14), ("p", 2, 900, 5, 3, 60), ("p", 3, 10, 0, 9, 10), ("p", 4, 20, 0, 9, 10)], "page_id string, cc_id int, x0 int, y0 int, w int, h int")
    assert {r["cc_id"] for r in L.tall_bars(parts).collect()} == {2}
    assert [(r["cc_id"], r["from_y"], r["to_y"]) for r in L.column_rules(parts).collect()] == [(2, -45, 115)]
    assert {r["cc_id"] for r in L.big_fragments(parts).collect()} == {2} if 60 > 5 * 12 else L.big_fragments(parts, 4).count() == 1
    assert {r["cc_id"] for r in L.between_lines(parts, (5, 0, 5, 100), (18, 0, 18, 100)).collect()} == {3}
    assert L.rejection_threshold(parts, "h").first()[0] == 72.0


def test_reading_order_and_modes(spark):
    lines = boxed(spark, (0, 0, "", 650, 10, 900, 20), (1, 0, "", 10, 50, 300, 60), (2, 0, "", 20, 10, 310, 20), (3, 0, "", 599, 10, 700, 20))
    order = [r["line_no"] for r in L.reading_order(lines).orderBy("reading_no").collect()]
    assert order == [2, 3, 1, 0]
    modes = L.column_modes(lines).first()
    assert (modes["start_1"], modes["start_2"], modes["page_bottom"]) == (0, 14, 60)


def test_two_columns(spark):
    cells = [(i, k, w, 10 + 100 * k, 50 * i, 90 + 100 * k, 50 * i + 20) for i in range(5) for k, w in enumerate(["λόγος", "λόγος"])]
    cells += [(5, k, w, 10 + 100 * k, 300, 90 + 100 * k, 320) for k, w in enumerate(["λόγος", "λόγος", "verbum", "verbum"])]
    got = L.repair_two_columns(boxed(spark, *cells))
    moved = {(r["text"], r["line_no"]) for r in got.filter("line_no > 4").collect()}
    assert moved == {("λόγος", 5), ("verbum", 6)} and got.count() == len(cells)


def test_confidences_zones_and_votes(spark):
    rows = spark.createDataFrame([(1, [0.123, 0.5]), (2, []), (3, None)], "i int, confs array<double>")
    assert values(L.confidence_summary(rows), "i", "min_confidence", "average_confidence") == [(1, 0.12, 0.31), (2, None, None), (3, None, None)]
    parts = spark.createDataFrame([("p", x, y, 10, 10) for x, y in [(40, 0), (55, 2), (70, 1), (90, 50), (110, 0), (20, 3), (0, 90)]], "page_id string, x0 int, y0 int, w int, h int")
    assert {r["x0"] for r in L.title_band(parts, F.lit(45)).collect()} == {40, 55, 70, 20}
    box = F.struct(F.lit(0).alias("x0"), F.lit(40).alias("y0"), F.lit(200).alias("x1"), F.lit(200).alias("y1"))
    flagged = {r["x0"] for r in L.footnote_regions(parts, box, F.lit(95)).filter("footnote").collect()}
    assert flagged == {0}
    points = spark.createDataFrame([("p", 100, 10 * k) for k in range(30)] + [("p", 300, 10 * k) for k in range(20)] + [("p", 17 * k % 400, 90) for k in range(20)], "page_id string, x int, y int")
    best = L.best_lines(L.line_votes(points)).orderBy("rank").collect()
    assert len(best) == 2 and abs(best[0]["radius_no"] - 25) <= 2 and abs(best[1]["radius_no"] - 75) <= 3


def test_retention(spark):
    got = {r["text"]: (r["reason"], r["delete"], r["broaden"]) for r in R.judge_words(page(spark, "edge λόγος A καὶ 12 ἐν ab verbum last")).collect()}
    assert got["edge"] == ("edge", None, 0) and got["last"][0] == "edge" and got["λόγος"] == ("script", False, 0)
    assert got["A"] == ("column letter", True, 2) and got["12"] == ("between script", False, 0) and got["ab"] == ("short", True, 0) and got["verbum"] == ("foreign", True, 0)


# --- reports and metadata


def test_reports(spark):
    rows = [("p1", "λόγος", "ocr_word", "True", "true"), ("p1", "xx", "ocr_word", "None", "false"), ("p1", "yy", "ocrx_word", None, None), ("p2", "zz", "ocr_word", None, None)]
    words = spark.createDataFrame(rows, "page_id string, text string, class string, spellcheck_mode string, manually_confirmed string")
    assert tuple(P.corpus_totals(words).first()) == (3, 1)
    assert values(P.page_accuracy(words)) == [("p1", 0.5), ("p2", 0.0)]
    images = spark.createDataFrame([("p1.png",), ("p0.png",), ("p2.png",)], "name string")
    assert values(P.page_strip(images, P.page_accuracy(words)), "n", "stem", "colour", "x") == [(1, "p0", "hsl(0, 0%, 86%)", 2), (2, "p1", "hsl(100,73%,55%)", 4), (3, "p2", "hsl(0, 0%, 0%)", 6)]
    a = P.assess(words).first()
    assert (a["words"], a["script_words"], a["open"], a["percent_spelled"], a["percent_script_verified"]) == (4, 1, 1, 75, 100)
    assert P.assess(words.limit(0)).first()["percent_spelled"] == 0
    assert P.assess(words.filter("text = 'xx'")).first()["percent_spelled"] == 0


def test_metadata(spark):
    rows = spark.createDataFrame([('{"items": [{"htid": "a.b_c", "enumcron": "v.1"}, {"htid": "d", "enumcron": null}]}',), ("broken",)], "json string")
    items = M.explode_items(rows)
    assert values(items) == [("a.b_c", "v.1"), ("d", None)]
    made = M.metadata_xml(items.withColumns({"title": F.lit("A & B"), "creator": F.lit(None), "publisher": F.lit("<p>")}))
    got = dict(values(made))
    assert got["aPERIODbULc"] == "<metadata><publisher>&lt;p&gt;</publisher><identifier>aPERIODbULc</identifier><title>A &amp; B</title><creator></creator><volume>v.1</volume><ppi>300</ppi></metadata>"


def test_word_projections(spark):
    words = page(spark, "a b").withColumns({"id": F.lit(None).cast("string"), "manually_confirmed": F.lit(None).cast("string"), "class": F.lit("ocrx_word")})
    got = W.with_default_attributes(W.as_ocr_words(words)).collect()
    assert len({r["id"] for r in got}) == 2 and {r["class"] for r in got} == {"ocr_word"} and {r["manually_confirmed"] for r in got} == {"false"}
    assert W.text_words(spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")).count() == 0
    assert C.is_number("x") is not None


def test_chunks_and_windows(spark):
    rows = spark.createDataFrame([(list("abcde"),), ([],), (None,)], "x array<string>")
    assert [r[0] for r in rows.select(T.chunks("x", 2)).collect()] == [[["a", "b"], ["c", "d"], ["e"]], [], None]
    assert [r[0] for r in rows.select(T.windows("x", 4)).collect()] == [[list("abcd"), list("bcde")], [], None]


def test_nearest_classes_reject_what_is_too_far(spark):
    samples = spark.createDataFrame([(1, "a", 0.0), (2, "a", 1.0), (3, "b", 10.0), (4, "b", 12.0), (5, "c", 11.0)], "sample_id long, label string, x double")
    rows = spark.createDataFrame([(0.4,), (11.6,), (30.0,), (14.0,)], "x double")
    got = {r["x"]: r["label"] for r in L.nearest_classes(rows, samples, ["x"], 3, slack=2.5).collect()}
    assert got == {0.4: "a", 11.6: "b", 30.0: None, 14.0: "b"}
    with pytest.raises(ValueError):
        L.nearest_classes(rows, samples, ["x"], most_samples=3)


def test_clean_pages_name_their_image(spark):
    box = "struct(0 as x0, 0 as y0, 10 as x1, 10 as y1)"
    words = spark.sql(f"select 'p' page_id, 0 line_no, 0 word_no, 'a' text, {box} bbox, array(0.5D) confs, 'bbox 1 2 3 4; x' page_title")
    assert L.clean_page_words(words, F.lit(10_000), F.lit("p1.tif")).first()["page_title"] == "image p1.png; bbox 1 2 3 4"
