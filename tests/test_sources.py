import zipfile

from pyspark.sql import functions as F

from polyscribe.operators import words as W
from polyscribe.plans import cascade as K
from polyscribe.sources import files, hocr, sinks
from polyscribe.streaming.pages import ingest, stream_words
from tests.conftest import values

PAGE = """<?xml version="1.0"?><html:html xmlns:html="http://www.w3.org/1999/xhtml"><html:body>
<html:div class="ocr_page" title="image p.png; bbox 0 0 1000 2000">
<html:span class="ocr_line" title="bbox 1 2 300 20"><html:span class="ocr_word" id="w1" title="bbox 1 2 90 20; x_confs 0.5 0.75"><html:em>λό</html:em>γος</html:span>
<html:span class="ocrx_word" title="bbox 95 2 150 20" data-spellcheck-mode="True" data-hyphenposition="4">ab-</html:span></html:span>
<html:span class="ocr_line" title="bbox 1 30 300 50"><html:span class="ocr_word" title="bbox 1 30 90 50"></html:span></html:span></html:div></html:body></html:html>"""


def pages(spark, **markup):
    return spark.createDataFrame(list(markup.items()), "page_id string, markup string")


def test_parse(spark):
    rows = hocr.parse_words(pages(spark, p=PAGE)).orderBy("line_no", "word_no").collect()
    assert [(r["line_no"], r["word_no"], r["class"], r["text"]) for r in rows] == [(0, 0, "ocr_word", "λόγος"), (0, 1, "ocrx_word", "ab-"), (1, 0, "ocr_word", None)]
    assert rows[0]["confs"] == [0.5, 0.75] and tuple(rows[0]["bbox"]) == (1, 2, 90, 20) and tuple(rows[0]["page_bbox"]) == (0, 0, 1000, 2000) and tuple(rows[2]["line_bbox"]) == (1, 30, 300, 50)
    assert (rows[1]["spellcheck_mode"], rows[1]["hyphen_position"], rows[1]["id"]) == ("True", 4, None)


def test_strict_and_lenient(spark):
    broken = '<div class="ocr_page"><span class="ocr_word">a<br>b</span><span class=ocr_word>c'
    both = pages(spark, good=PAGE, bad=broken, empty="", none=None)
    strict = hocr.parse_words(both, strict=True)
    assert {r["page_id"]: r["n_words"] for r in hocr.word_counts(strict).collect()} == {"good": 3, "bad": 0, "empty": 0, "none": 0}
    assert strict.filter("page_id = 'bad'").first()["error"]
    lenient = hocr.parse_words(both)
    assert values(lenient.filter("page_id = 'bad'"), "text", "error") == [("ab", None), ("c", None)]


def test_render_and_read_again(spark, tmp_path):
    words = hocr.parse_words(pages(spark, p=PAGE, q=PAGE.replace("ab-", "x &lt; y &amp; \"z\"")))
    again = hocr.parse_words(hocr.render_pages(words))
    same = ["page_id", "line_no", "word_no", "class", "id", "text", "title", "line_title", "page_title", "spellcheck_mode", "hyphen_position"]
    assert values(again.withColumn("text", F.nullif("text", F.lit(""))), *same) == values(words, *same)
    assert hocr.parse_words(hocr.render_pages(words), strict=True).filter("error IS NOT NULL").count() == 0
    hocr.write_hocr(words, str(tmp_path / "out"))
    assert {p.name for p in (tmp_path / "out").glob("page_id=*")} == {"page_id=p", "page_id=q"}


def test_render_in_reading_order_with_meta_tags(spark):
    words = hocr.parse_words(pages(spark, p=PAGE)).withColumn("reading_no", 9 - F.col("line_no"))
    made = hocr.render_pages(words, hocr.meta_tags({"DC.title": F.concat(F.lit("page <"), F.col("page_id")), "DC.creator": None, "ocr-system": "x"}))
    markup = made.first()["markup"]
    assert '<meta name="DC.title" content="page &lt;p"/><meta name="ocr-system" content="x"/>' in markup and "DC.creator" not in markup
    again = values(hocr.parse_words(made, strict=True), "line_no", "text")
    assert again == sorted([(0, None), (1, "λόγος"), (1, "ab-")], key=repr)


def test_well_formed_and_lenient_parsers_agree():
    words, title = hocr._well_formed(PAGE)
    parser = hocr._Pages()
    parser.feed(PAGE)
    parser.close()
    some = lambda w: {k: v for k, v in w.items() if v is not None}
    assert [some(w) for w in words] == [some(w) for w in parser.words] and title == parser.page_title


def test_read_folder(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "output-a1.html").write_text(PAGE)
    (tmp_path / "sub" / "b2.hocr").write_bytes(PAGE.encode() + b"\xff")
    (tmp_path / "c.txt").write_text(PAGE)
    assert {r["page_id"] for r in hocr.read_hocr(spark, str(tmp_path)).collect()} == {"a1", "b2"}
    assert {r["page_id"] for r in hocr.read_hocr(spark, str(tmp_path), recursive=False).collect()} == {"a1"}


def test_dictionaries(spark, tmp_path):
    (tmp_path / "d.csv").write_text("λόγος,7\nzero,0\na,b,c\nd'un,3\nét,1\nword,many\n")
    assert values(files.read_dictionary(spark, str(tmp_path / "d.csv"))) == sorted([("λόγος",), ("a,b,c",), ("d’un",), ("ét",), ("word,many",)], key=repr)
    (tmp_path / "f.csv").write_text("λόγος,7\nbad\nλόγος,9\nb,1\n")
    assert values(files.read_fuzzy_dictionary(spark, str(tmp_path / "f.csv")), "form", "freq", "ord") == sorted([("λο↗γος", 9, 0), ("b", 1, 3)], key=repr)
    (tmp_path / "n.csv").write_text("λογος,λόγος\nλογος,λογός\nx\n")
    assert values(files.read_accent_index(spark, str(tmp_path / "n.csv"))) == [("λογος", "λογός")]
    (tmp_path / "c.txt").write_text("# note\na€b€3€Sub a->b\n\nbad€x\nq€€1€False\na€c€4€Dedup\n")
    assert values(files.read_corrections(spark, str(tmp_path / "c.txt"))) == [("a", "c", "4", "Dedup")]
    (tmp_path / "s.txt").write_text("d\tx y\nl\ti\n")
    assert [(r["from"], r["to"]) for r in files.read_substitutions(spark, str(tmp_path / "s.txt")).orderBy("ord").collect()] == [("d", "x"), ("d", "y"), ("l", "i")]
    rules = files.accent_substitutions(spark)
    assert rules.filter("from = 'ά' AND to = 'ᾶ'").count() == 1 and rules.filter("from = to").count() == 0


def test_other_files(spark, tmp_path):
    (tmp_path / "z.csv").write_text("name;ul_x;ul_y;ll_x;ll_y;lr_x;lr_y;ur_x;ur_y\nheader;1;2;3;4;5;6;7;8\n")
    zones = files.read_zones(spark, str(tmp_path / "z.csv"))
    sinks.write_zones(zones, str(tmp_path / "z2"))
    assert values(files.read_zones(spark, str(tmp_path / "z2"))) == values(zones) == [("header", 1, 2, 3, 4, 5, 6, 7, 8)]
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("2.png", b"x")
        z.writestr("1.png", b"x")
        z.writestr("n.txt", b"x")
    assert [r["name"] for r in files.list_archive(spark, str(tmp_path / "a.zip"), ".png").collect()] == ["1.png", "2.png"]
    (tmp_path / "i.png").write_bytes(b"12345")
    (tmp_path / "j.png").write_bytes(b"1")
    assert [r["length"] for r in files.read_images(spark, str(tmp_path), least_bytes=2).collect()] == [5]
    (tmp_path / "t.txt").write_text("a\r\nb\n")
    assert values(files.read_lines(spark, str(tmp_path / "t.txt")), "ord", "line") == [(0, "a"), (1, "b")]
    (tmp_path / "m.json").write_text('{"items":\n[]}')
    assert files.read_json_responses(spark, str(tmp_path / "m.json")).count() == 1


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("b", "x", 2, "Dedup"), ("a", None, 2, "True"), ("c", "", 9, "False")], K.SCHEMA)
    sinks.write_corrections(rows.coalesce(1), str(tmp_path / "c"))
    assert [r[0] for r in spark.read.text(str(tmp_path / "c")).collect()] == ["c€€9€False", "a€€2€True", "b€x€2€Dedup"]
    assert values(files.read_corrections(spark, str(tmp_path / "c")), "word") == [("a",), ("b",)]
    modes = K.mode_summary(rows)
    assert [r["value"] for r in sinks.statistics_lines(modes, K.totals(modes)).orderBy("ord").collect()][0] == "False: 9 words, 9 characters"
    totals = spark.createDataFrame([(5, 3)], "total_words long, total_accurate_words long")
    assert sinks.totals_xml(totals).first()[0] == "<totals><total_words>5</total_words><total_accurate_words>3</total_accurate_words></totals>"
    assert 'xmlns:t="urn:t"' in sinks.totals_xml(totals, "t", "urn:t").first()[0]
    strip = spark.createDataFrame([(2, 4, "red"), (1, 2, "blue")], "n int, x int, colour string")
    svg = sinks.strip_svg(strip).first()[0]
    assert svg.index("blue") < svg.index("red") and 'width="4"' in svg
    sinks.write_fuzzy(spark.createDataFrame([("w", "b")], "word string, best string"), str(tmp_path / "f"))
    assert spark.read.text(str(tmp_path / "f")).first()[0] == "w€b"
    sinks.write_metadata(spark.createDataFrame([("i", "<m/>")], "identifier string, xml string"), str(tmp_path / "m"))
    assert spark.read.text(str(tmp_path / "m")).first()["identifier"] == "i"


def test_streaming(spark, tmp_path):
    source, target, checkpoint = tmp_path / "in", tmp_path / "out", tmp_path / "cp"
    source.mkdir()
    (source / "a.html").write_text(PAGE)
    for more in (None, "b"):
        if more:
            (source / f"{more}.html").write_text(PAGE)
        query = ingest(stream_words(spark, str(source)), str(target), str(checkpoint))
        query.awaitTermination(60)
    assert values(spark.read.parquet(str(target)).groupBy("page_id").count()) == [("a", 3), ("b", 3)]
    assert W.with_text(spark.read.parquet(str(target))).count() == 4


def test_lines_of_files_end_with_feeds_or_not(spark, tmp_path):
    for name, text in {"a": "x\ny\n", "b": "x\n\n", "c": "\n", "d": "", "e": "x\r\ny", "f": "\n\nz"}.items():
        (tmp_path / name).write_bytes(text.encode())
    lines = {}
    for r in files.read_lines(spark, str(tmp_path)).orderBy("path", "ord").collect():
        lines.setdefault(r["path"][-1], []).append(r["line"])
    assert lines == {"a": ["x", "y"], "b": ["x", ""], "c": [""], "e": ["x", "y"], "f": ["", "", "z"]}
