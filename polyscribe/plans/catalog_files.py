"""Registered queries of word forms, titles, clean-up, and files written and read again, each beside its SQL equivalent."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from polyscribe.functions import chars as C
from polyscribe.functions import geometry as G
from polyscribe.functions import tokens as T
from polyscribe.functions import unicode as U
from polyscribe.operators import dehyphenate as D
from polyscribe.operators import fuzzy as Z
from polyscribe.operators import layout as L
from polyscribe.operators import lookup as J
from polyscribe.operators import words as W
from polyscribe.plans import cascade as K
from polyscribe.plans import catalog as Q
from polyscribe.plans import reports as P
from polyscribe.plans.catalog import query
from polyscribe.runtime import materialise, scratch_dir
from polyscribe.sources import files as SRC
from polyscribe.sources import sinks as SNK


def _place(spark: SparkSession, name: str) -> str:
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"


# --- plain texts -----------------------------------------------------------------------------------------

_BLANKS = "[)(;><. \\t\\x0B\\f\\r]"
_GAP = "[)(;><. \\t\\n\\x0B\\f\\r]"
_BROKEN = f"([^{_GAP[1:]})(?:-{_BLANKS}*\\n{_GAP}*)+([^{_GAP[1:]})".replace("'", "''")


def _joined(x: str) -> str:
    # matches take the characters beside them in, so joins that share one need a second pass
    once = f"regexp_replace({x}, '{_BROKEN}', '\\1\\2', 'g')"
    return f"list_filter(regexp_split_to_array(regexp_replace({once}, '{_BROKEN}', '\\1\\2', 'g'), '{_GAP}+'), lambda t: t <> '')"


@query(f"""SELECT doc_id, CAST(len(ts) AS INTEGER) AS n_tokens, md5(array_to_string(ts, ' ')) AS digest FROM
(SELECT doc_id, {_joined("regexp_replace(text, 'e ([a-z])', 'e-' || chr(10) || '\\1', 'g')")} AS ts FROM documents WHERE text IS NOT NULL)""")
def joined_tokens(spark, d):
    """Texts broken after many an e, and their tokens once rejoined."""
    docs = Q._table(spark, d, "documents").filter("text IS NOT NULL")
    tokens = docs.select("doc_id", D.text_tokens(F.regexp_replace("text", "e ([a-z])", "e-\n$1")).alias("ts"))
    return tokens.select("doc_id", F.size("ts").alias("n_tokens"), F.md5(F.array_join("ts", " ")).alias("digest"))


@query(f"""WITH t AS (SELECT DISTINCT unnest({_joined(f"translate(text, '{Q._LETTERS}', '{Q._GREEK}')")}) AS token FROM documents WHERE text IS NOT NULL),
c AS (SELECT DISTINCT rtrim({Q._core("token")}, ' ') AS word FROM t),
s AS (SELECT word, regexp_replace(word, '[!-/:-@\\[-`{{-~—·0-9]', '', 'g') AS bare FROM c WHERE len(word) > 1 AND right(word, 1) <> '-' AND len(regexp_replace(word, '[^Α-Ω]', '', 'g')) / len(word) <= 0.7)
SELECT word FROM s WHERE coalesce(len(regexp_replace(bare, '[^{Q._GREEK_CLASS}א-ײ]', '', 'g')) / nullif(len(bare), 0), 0.0) > 0.7""")
def candidate_words(spark, d):
    """The words worth correcting, of texts in Greek letters."""
    docs = Q._table(spark, d, "documents").select(F.translate("text", Q._LETTERS, Q._GREEK).alias("text"))
    return Z.candidate_vocabulary(docs)


_HALF_GREEK = f"list(CASE WHEN word_no % 2 = 0 THEN translate(text, '{Q._LETTERS}', '{Q._GREEK}') ELSE text END ORDER BY word_no)"
_BARE = "regexp_replace(t, '[!-/:-@\\[-`{-~—·0-9]', '', 'g')"


@query(Q._sql(f"""SELECT page_id, line_no, array_to_string(list_filter(ws, lambda t: coalesce(len(regexp_replace({_BARE}, '[^{Q._GREEK_CLASS}א-ײ]', '', 'g')) / nullif(len({_BARE}), 0), 0.0) > 0.7), ' ') AS kept
FROM (SELECT page_id, line_no, {_HALF_GREEK} AS ws FROM w GROUP BY page_id, line_no)""", Q._W))
def greek_tokens(spark, d):
    """Lines with every other word in Greek letters, less the words that are not Greek."""
    mixed = F.transform("ws", lambda t, i: F.when(i % 2 == 0, F.translate(t, Q._LETTERS, Q._GREEK)).otherwise(t))
    lines = W.line_words(Q._table(spark, d, "documents")).filter(F.size("ws") > 0)
    return lines.select("page_id", "line_no", F.array_join(C.delete_non_greek_tokens(mixed), " ").alias("kept"))


@query(Q._sql("""SELECT page_id, line_no, CAST(k AS INTEGER) AS chunk_no, array_to_string(ws[7 * k + 1 : 7 * k + 7], ' ') AS piece, CAST(greatest(len(ws) - 2, 0) AS INTEGER) AS n_windows
FROM (SELECT page_id, line_no, ws, unnest(range(0, CAST(ceil(len(ws) / 7) AS BIGINT))) AS k FROM w_t)""", Q._W))
def line_chunks(spark, d):
    """Lines in pieces of seven words, and how many windows of three words each has."""
    lines = W.line_words(Q._table(spark, d, "documents"))
    pieces = lines.select("page_id", "line_no", T.window_count("ws", 3).alias("n_windows"), F.posexplode(T.chunks("ws", 7)).alias("chunk_no", "_p"))
    return pieces.select("page_id", "line_no", "chunk_no", F.array_join("_p", " ").alias("piece"), "n_windows")


@query(Q._sql(f"SELECT count(*) AS pairs, count(*) FILTER (rule = 'last') AS by_last, count(*) FILTER (rule = 'before_last') AS by_before_last FROM ({Q._PAIRS})", Q._WRAP))
def hyphen_rules(spark, d):
    return D.rule_counts(D.hyphen_pairs(D.wrap(Q._dealt_words(spark, d)), dealt=True))


# --- titles and boxes ------------------------------------------------------------------------------------


@query(Q._sql("""SELECT page_id, line_no, word_no, CASE WHEN even THEN x1 END AS strict_x1, y0 AS number_2, CASE WHEN even THEN y1 ELSE -1 END AS number_4, CASE WHEN NOT even THEN 95.0::DOUBLE END AS confidence, x0 + (x1 - x0) / 2.0::DOUBLE AS centre,
concat_ws(';', x0, y0, x0, y1, x1, y1, x1, y0) AS corners, concat_ws(' ', 'bbox', x0 + 1, y0 + 1, x1 + 1, y1 + 1) || CASE WHEN even THEN '' ELSE '; x_wconf 95' END AS moved FROM (SELECT *, word_no % 2 = 0 AS even FROM x)""", Q._BOXES))
def box_titles(spark, d):
    """Titles of boxes, every other one with a second part: what the strict and the lenient readings get of them."""
    plain = F.concat_ws(" ", F.lit("bbox"), *[F.col(f"bbox.{c}").cast("string") for c in ("x0", "y0", "x1", "y1")])
    words = Q._boxes(spark, d).withColumn("title", F.when(F.col("word_no") % 2 == 0, plain).otherwise(F.concat(plain, F.lit("; x_wconf 95"))))
    up = F.struct(*[(F.col(f"bbox.{c}") + 1).alias(c) for c in ("x0", "y0", "x1", "y1")])
    return words.select(
        "page_id", "line_no", "word_no", G.strict_bbox("title")["x1"].alias("strict_x1"), G.title_number("title", 2).alias("number_2"), G.title_number("title", 4).alias("number_4"),
        F.get(G.confidences("title"), F.lit(0)).alias("confidence"), G.centre_x(F.col("bbox")).cast("double").alias("centre"), G.corners_csv(F.col("bbox")).alias("corners"), G.with_bbox("title", up).alias("moved"),
    )


@query(Q._sql("""SELECT page_id, line_no, word_no, CASE WHEN word_no = min(word_no) OVER l THEN min(x0) OVER l - 4 ELSE x0 END AS x0, CASE WHEN word_no = max(word_no) OVER l THEN max(x1) OVER l + 4 ELSE x1 END AS x1 FROM x WINDOW l AS (PARTITION BY page_id, line_no)""", Q._BOXES))
def edge_words(spark, d):
    """First and last words stretched to line boxes five wider than their words."""
    words = Q._boxes(spark, d)
    wide = F.struct((F.col("bbox.x0") - 5).alias("x0"), F.col("bbox.y0").alias("y0"), (F.col("bbox.x1") + 5).alias("x1"), F.col("bbox.y1").alias("y1"))
    lines = L.line_boxes(words).select("page_id", "line_no", wide.alias("line_box"))
    return L.edge_words_to_borders(words, lines).select("page_id", "line_no", "word_no", "bbox.x0", "bbox.x1")


@query(Q._sql("""SELECT page_id, line_no, word_no, round(x0 / cos(a), 4) AS top_x, round((x0 - h * sin(a)) / cos(a), 4) AS bottom_x FROM (SELECT *, (line_no % 40 - 20) / 100.0::DOUBLE AS a FROM cc)""", Q._PARTS))
def border_crossings(spark, d):
    crossed = G.border_intersections(F.col("x0").cast("double"), (F.col("line_no") % 40 - 20) / F.lit(100.0), F.lit(1600), F.col("h"))
    return Q._components(spark, d).withColumn("_c", crossed).select("page_id", "line_no", "word_no", F.round("_c.top_x", 4).alias("top_x"), F.round("_c.bottom_x", 4).alias("bottom_x"))


@query(Q._sql("SELECT round(1.2::DOUBLE * max(h), 6) AS threshold FROM cc", Q._PARTS))
def rejection(spark, d):
    return L.rejection_threshold(Q._components(spark, d), "h").select(F.round("threshold", 6).cast("double").alias("threshold"))


@query(Q._sql("""SELECT page_id, line_no, word_no, x0 - CASE WHEN p AND l2 IS NOT NULL THEN least(CAST(trunc((x0 - l2) / 3) AS INTEGER), 7) ELSE 0 END AS x0, x1 + CASE WHEN nx AND r2 IS NOT NULL THEN least(CAST(trunc((r2 - x1) / 3) AS INTEGER), 5) ELSE 0 END AS x1,
round(least(a, b), 2) AS min_confidence, round((a + b) / 2, 2) AS average_confidence, 'image ' || page_id || '.0.png; bbox 0 0 9 9' AS page_title FROM
(SELECT *, len(text) / 3::DOUBLE AS a, word_no / 7::DOUBLE AS b, coalesce(lag(text) OVER o = ' ', FALSE) AS p, coalesce(lead(text) OVER o = ' ', FALSE) AS nx, lag(x1, 2) OVER o AS l2, lead(x0, 2) OVER o AS r2 FROM cl WINDOW o AS (PARTITION BY page_id, line_no ORDER BY word_no)) WHERE text <> ' '""",
Q._BOXES, "cl AS (SELECT page_id, line_no, 2 * word_no AS word_no, text, x0, x1 FROM x WHERE NOT (word_no % 3 = 1 AND (x1 - x0) * (y1 - y0) > 10000 / 3) UNION ALL SELECT page_id, line_no, 2 * word_no + 1, ' ', x0, x1 FROM x WHERE word_no % 3 = 0)"))
def page_clean_up(spark, d):
    """The whole clean-up of a line recogniser's page: a space in every third gap, every third word held to the size limit."""
    every = Q._spaced(Q._boxes(spark, d, Q._dealt_words)).withColumns({"confs": F.array(F.char_length("text") / F.lit(3.0), F.col("word_no") / F.lit(7.0)), "page_title": F.lit("bbox 0 0 9 9; ppageno 1")})
    area = F.when(F.col("word_no") % 6 == 2, 10000).otherwise(10**9)
    cleaned = L.clean_page_words(every, area, F.concat(F.col("page_id").cast("string"), F.lit(".0.png")))
    return cleaned.select("page_id", "line_no", "word_no", "bbox.x0", "bbox.x1", "min_confidence", "average_confidence", "page_title")


@query(Q._sql("""SELECT page_id, line_no, word_no, CASE WHEN word_no % 3 = 0 THEN 'ocr_line' ELSE 'ocr_word' END AS class, CASE WHEN word_no % 2 = 0 THEN 'w' || word_no ELSE '_' || sha1(concat_ws('/', page_id, line_no, word_no)) END AS id, CASE WHEN word_no % 5 = 0 THEN 'true' ELSE 'false' END AS manually_confirmed FROM w""", Q._W))
def word_attributes(spark, d):
    """One class for words; ids and confirmations where they are missing."""
    k = F.col("word_no")
    words = Q._words(spark, d).withColumns({"class": F.when(k % 3 == 0, "ocr_line").otherwise("ocrx_word"), "id": F.when(k % 2 == 0, F.concat(F.lit("w"), k.cast("string"))), "manually_confirmed": F.when(k % 5 == 0, "true")})
    return W.with_default_attributes(W.as_ocr_words(words)).select("page_id", "line_no", "word_no", "class", "id", "manually_confirmed")


@query("""SELECT page_id, 'image ' || regexp_replace(url, '\\.[^.]*$', '') || '.png; ' || split_part(replace(html, chr(10), ''), ';', 1) AS title FROM pages""")
def page_titles(spark, d):
    title = W.page_title(W.without_newlines(F.col("html")), F.col("url"))
    return Q._table(spark, d, "pages").select("page_id", title.alias("title"))


# --- files written and read again -----------------------------------------------------------------------------


@query(Q._sql(f"""SELECT DISTINCT word FROM (SELECT replace(replace(replace(replace(replace(v, 'ae', 'æ'), 'ff', 'ﬀ'), 'oe', 'œ'), 'fl', 'ﬂ'), 'fi', 'ﬁ') AS word FROM (SELECT {Q._fold("nfc_normalize(line)")} AS v FROM
(SELECT CASE WHEN contains(text, ',') THEN text || ',' || count(*) ELSE text END AS line FROM b GROUP BY text))) WHERE word <> ''""", Q._B))
def dictionary_words(spark, d):
    """Benchmark words written as a dictionary with frequencies; a word with a comma makes its line a word of its own."""
    path = _place(spark, "dictionary")
    counted = W.text_words(Q._table(spark, d, "benchmark"), "item_id").groupBy("text").agg(F.count("*").alias("n"))
    counted.select(F.concat_ws(",", "text", F.col("n").cast("string"))).write.text(path)
    return SRC.read_dictionary(spark, path, ligatures=True)


@query(Q._sql("SELECT strip_accents(word) AS bare, max(word) AS word FROM lexicon WHERE NOT contains(word, ',') GROUP BY 1", Q._X))
def accent_index_file(spark, d):
    """The index of words without accents, as one file in order of words, read back: the last of equal keys holds."""
    path = _place(spark, "index")
    lexicon = Q._lexicon(spark, d).select("word").repartition(1).sortWithinPartitions("word")
    lexicon.select(F.concat_ws(",", U.strip_accents("word"), "word")).write.text(path)
    return SRC.read_accent_index(spark, path)


@query(Q._sql(f"SELECT word, CASE mode WHEN 'TrueLower' THEN key ELSE '' END AS output, CAST(n AS VARCHAR) AS frequency, mode FROM (SELECT word, n, {Q._key('word')} AS key, CASE WHEN word {Q._IN} THEN 'True' WHEN {Q._key('word')} {Q._IN} THEN 'TrueLower' ELSE 'False' END AS mode FROM v) WHERE mode <> 'False' AND NOT starts_with(word, '#') AND NOT contains(word, '€')", Q._V, Q._X))
def correction_table(spark, d):
    """The words' modes by dictionary written as a correction table and read back: comments and open words are left out."""
    path, lexicon = _place(spark, "corrections"), Q._lexicon(spark, d)
    found = J.in_lexicon(J.in_lexicon(Q._vocabulary(spark, d), lexicon, F.col("word"), "_e"), lexicon, T.lower_key("word"), "_l")
    mode = F.when(F.col("_e"), "True").when(F.col("_l"), "TrueLower").otherwise("False")
    SNK.write_corrections(found.select("word", F.when(mode == "TrueLower", T.lower_key("word")).alias("output"), "n", mode.alias("mode")), path)
    return SRC.read_corrections(spark, path)


@query(Q._sql("""SELECT printf('%s: %d words, %d characters', mode, n, b) AS line FROM ms UNION ALL
SELECT printf('known: %.2f %% of words, %.2f %% of characters', 100.0::DOUBLE * (sum(n) FILTER (mode <> 'False'))::DOUBLE / sum(n)::DOUBLE, 100.0::DOUBLE * (sum(b) FILTER (mode <> 'False'))::DOUBLE / sum(b)::DOUBLE) FROM ms""",
Q._CASCADE, "ms AS (SELECT mode, CAST(sum(n) AS BIGINT) AS n, CAST(sum(n * len(word)) AS BIGINT) AS b FROM done GROUP BY mode)"))
def run_statistics(spark, d):
    modes = materialise(K.mode_summary(Q._corrected(spark, d)), "modes")
    return SNK.statistics_lines(modes, K.totals(modes)).select(F.col("value").alias("line"))


@query(Q._sql("SELECT printf('<lace:totals xmlns:lace=\"urn:totals\"><lace:total_words>%d</lace:total_words><lace:total_accurate_words>%d</lace:total_accurate_words></lace:totals>', count(*), count(*) FILTER (mode = 'True')) AS value FROM mw", Q._MODED))
def totals_document(spark, d):
    return SNK.totals_xml(P.corpus_totals(Q._moded(spark, d)), "lace", "urn:totals")


@query(f"""WITH s AS ({Q.SQL["accuracy_color"]}) SELECT printf('<svg xmlns="http://www.w3.org/2000/svg" width="%d" height="20">', 2 * count(*)) || chr(10) ||
string_agg(printf('<a href="%d"><rect x="%d" y="0" width="2" height="20" fill="%s"><title>%d</title></rect></a>', n, 2 * n, colour, n), chr(10) ORDER BY n) || chr(10) || '</svg>' AS value FROM s""")
def accuracy_strip(spark, d):
    images = Q._table(spark, d, "documents").select(F.concat(F.col("doc_id").cast("string"), F.lit(".png")).alias("name")).distinct()
    pages = P.page_accuracy(Q._moded(spark, d)).withColumn("page_id", F.col("page_id").cast("string"))
    return SNK.strip_svg(P.page_strip(images, pages))


@query(Q._sql("SELECT 'page ' || page_id AS name, min(x0) AS ul_x, min(y0) AS ul_y, min(x0) AS ll_x, max(y1) AS ll_y, max(x1) AS lr_x, max(y1) AS lr_y, max(x1) AS ur_x, min(y0) AS ur_y FROM x GROUP BY page_id", Q._BOXES))
def zone_table(spark, d):
    """The box around each page's words, as a table of zones written and read back."""
    path = _place(spark, "zones")
    page = Q._boxes(spark, d).groupBy("page_id").agg(G.union_box(F.col("bbox")).alias("b"))
    corners = {"ul_x": "x0", "ul_y": "y0", "ll_x": "x0", "ll_y": "y1", "lr_x": "x1", "lr_y": "y1", "ur_x": "x1", "ur_y": "y0"}
    SNK.write_zones(page.select(F.concat(F.lit("page "), F.col("page_id").cast("string")).alias("name"), *[F.col(f"b.{c}").alias(n) for n, c in corners.items()]), path)
    return SRC.read_zones(spark, path)
