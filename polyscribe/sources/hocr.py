"""Page-layout markup (hOCR) as word rows, and word rows as markup.

Files are read as ``binaryFile`` rows, so listing and filtering are Spark's, and parsed page by page in Arrow batches. The
lenient parser takes any HTML; strict reading also demands well-formed XML and reports pages that are not.
Elements are matched by local name and class, whatever their namespace or prefix.
"""

from __future__ import annotations

from html import escape
from html.parser import HTMLParser

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from polyscribe.functions import geometry as G

# Class names and attributes of the format.
WORD_CLASSES, LINE_CLASS, PAGE_CLASS = ("ocr_word", "ocrx_word"), "ocr_line", "ocr_page"
ATTRIBUTES = {
    "manually_confirmed": "data-manually-confirmed", "dehyphenated_form": "data-dehyphenatedform", "hyphen_position": "data-hyphenposition", "hyphen_end_pair": "data-hyphenendpair",
    "hyphen_start_pair": "data-hyphenstartpair", "spellcheck_mode": "data-spellcheck-mode", "spellchecked_form": "data-spellchecked-form", "pre_spellcheck": "data-pre-spellcheck", "selected_form": "data-selected-form",
}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
SCHEMA = "page_id string, page_title string, line_no int, line_title string, word_no int, class string, id string, text string, title string, error string, " + ", ".join(f"{k} string" for k in ATTRIBUTES)


class _Pages(HTMLParser):
    """Collects the words of one page in document order; the text of inner markup is the word's."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, str]] = []
        self.words: list[dict] = []
        self.page_title = self.line_title = None
        self.line, self.in_line, self.number = -1, 0, {}
        self.open: dict | None = None

    def handle_starttag(self, tag, attrs):
        tag = tag.rpartition(":")[2]
        a = dict(attrs)
        kind = (a.get("class") or "").split()
        role = ""
        if PAGE_CLASS in kind and self.page_title is None:
            self.page_title = a.get("title")
        elif LINE_CLASS in kind:
            role, self.line, self.line_title = "line", self.line + 1, a.get("title")
            self.in_line += 1
        elif self.open is None and any(c in kind for c in WORD_CLASSES):
            role = "word"
            line = self.line if self.in_line else None
            k = self.number[line] = self.number.get(line, -1) + 1
            self.open = {"line_no": line, "line_title": self.line_title if self.in_line else None, "word_no": k, "class": next(c for c in kind if c in WORD_CLASSES), "id": a.get("id"), "text": None, "title": a.get("title")}
            self.open |= {name: a.get(attribute) for name, attribute in ATTRIBUTES.items()}
        if tag not in _VOID:
            self.stack.append((tag, role))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag.rpartition(":")[2] not in _VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        tag = tag.rpartition(":")[2]
        at = next((i for i in range(len(self.stack) - 1, -1, -1) if self.stack[i][0] == tag), None)
        if at is None:
            return
        for _, role in reversed(self.stack[at:]):
            self._close(role)
        del self.stack[at:]

    def _close(self, role):
        if role == "word" and self.open is not None:
            self.words.append(self.open)
            self.open = None
        elif role == "line":
            self.in_line -= 1

    def handle_data(self, data):
        if self.open is not None:
            self.open["text"] = (self.open["text"] or "") + data

    def close(self):
        super().close()
        for _, role in reversed(self.stack):
            self._close(role)
        self.stack = []


def _well_formed(markup: str) -> tuple[list[dict], str | None]:
    """The words of well-formed XML by a parser in C; raises ExpatError for anything else."""
    from xml.parsers import expat

    words: list[dict] = []
    depth, line, line_title, page_title = 0, -1, None, None
    lines: list[int] = []  # depths of the open lines
    number: dict = {}
    word, word_depth, text = None, 0, []

    kinds: dict = {}

    def start(_tag, a):
        nonlocal depth, line, line_title, page_title, word, word_depth
        depth += 1
        kind = a.get("class")
        if kind is None:
            return
        kind = kinds.get(kind) or kinds.setdefault(kind, kind.split())
        if PAGE_CLASS in kind and page_title is None:
            page_title = a.get("title")
        elif LINE_CLASS in kind:
            line, line_title = line + 1, a.get("title")
            lines.append(depth)
        elif word is None and (name := next((c for c in kind if c in WORD_CLASSES), None)):
            here = line if lines else None
            k = number[here] = number.get(here, -1) + 1
            word, word_depth = {"line_no": here, "line_title": line_title if lines else None, "word_no": k, "class": name, "id": a.get("id"), "title": a.get("title")}, depth
            if len(a) > 1 + ("id" in a) + ("title" in a):
                for field, attribute in ATTRIBUTES.items():
                    if attribute in a:
                        word[field] = a[attribute]

    def end(_tag):
        nonlocal depth, word
        if word is not None and depth == word_depth:
            word["text"] = "".join(text) if text else None
            words.append(word)
            word = None
            text.clear()
        elif lines and depth == lines[-1]:
            lines.pop()
        depth -= 1

    def data(x):
        if word is not None:
            text.append(x)

    parser = expat.ParserCreate("utf-8")
    parser.buffer_text = True
    parser.StartElementHandler, parser.EndElementHandler, parser.CharacterDataHandler = start, end, data
    parser.Parse(markup.encode("utf-8", "replace"), True)
    return words, page_title


def parse_page(markup: str, strict: bool = False) -> tuple[list[dict], str | None]:
    """(words, error): the words of one page's markup; strict: none, and why, if it is not well-formed XML.

    Well-formed pages are read as XML; the lenient parser takes the others, and those without words when read so.
    """
    from xml.parsers.expat import ExpatError

    try:
        words, page_title = _well_formed(markup)
        if words or strict:
            for w in words:
                w["page_title"] = page_title
            return words, None
    except ExpatError as e:
        if strict:
            return [], str(e)
    parser = _Pages()
    parser.feed(markup)
    parser.close()
    return [w | {"page_title": parser.page_title} for w in parser.words], None


def page_files(spark: SparkSession, path: str, pattern: str = "*.{hocr,html,htm}", recursive: bool = True) -> DataFrame:
    """page_id (the file's name without folder, ``output-`` and extension) and markup; bytes that are not UTF-8 are dropped."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", str(recursive).lower()).load(path)
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    page = F.regexp_replace(F.regexp_replace(name, "^output-", ""), r"\.[^.]*$", "")

    @F.pandas_udf("string")
    def decode(content: pd.Series) -> pd.Series:
        return content.map(lambda b: b.decode("utf-8", "ignore"), na_action="ignore")

    return files.select(page.alias("page_id"), decode("content").alias("markup"))


def parse_words(pages: DataFrame, strict: bool = False, id_col: str = "page_id", markup_col: str = "markup") -> DataFrame:
    """Word rows of pages. A page without words has one row with nothing but page_id (and error, if strict reading refused it)."""
    schema = pa.schema([(name, pa.int32() if kind == "int" else pa.string()) for name, kind in (x.split() for x in SCHEMA.split(", "))])

    def rows(words):
        # a field that no word has costs nothing
        some = set().union(*words)
        return pa.RecordBatch.from_arrays([pa.array([w.get(f.name) for w in words], f.type) if f.name in some else pa.nulls(len(words), f.type) for f in schema], schema=schema)

    def parse(batches):
        held = []
        for batch in batches:
            for i in range(batch.num_rows):
                page = batch.column(0)[i].as_py()
                words, error = parse_page(batch.column(1)[i].as_py() or "", strict)
                for w in words:
                    w["page_id"] = page
                held += words or [{"page_id": page, "error": error}]
                if len(held) >= 10_000:
                    yield rows(held)
                    held = []
        if held:
            yield rows(held)

    flat = pages.select(F.col(id_col).cast("string"), F.col(markup_col).cast("string")).mapInArrow(parse, SCHEMA)
    return flat.withColumns({"hyphen_position": F.col("hyphen_position").try_cast("int"), "bbox": G.title_bbox("title"), "line_bbox": G.title_bbox("line_title"), "page_bbox": G.title_bbox("page_title"), "confs": G.confidences("title")})


def read_hocr(spark: SparkSession, path: str, strict: bool = False, **options) -> DataFrame:
    return parse_words(page_files(spark, path, **options), strict)


def word_counts(words: DataFrame) -> DataFrame:
    """page_id, n_words: pages that could not be read or are empty count 0."""
    return words.groupBy("page_id").agg(F.count("word_no").alias("n_words"))


def _quoted(name: str, value: Column) -> Column:
    """An attribute, or nothing for null."""
    return F.coalesce(F.concat(F.lit(f' {name}="'), _escaped(value.cast("string"), True), F.lit('"')), F.lit(""))


def _escaped(x: Column, quotes: bool = False) -> Column:
    for plain, entity in [("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), *([('"', "&quot;"), ("'", "&#x27;")] if quotes else [])]:
        x = F.replace(x, F.lit(plain), F.lit(entity))
    return x


def meta_tags(values: dict[str, Column | str | None]) -> Column:
    """``meta`` elements of a page's head, of names (Dublin Core's, say) and values; null values are left out."""
    tags = [F.concat(F.lit(f'<meta name="{escape(name, quote=True)}"'), _quoted("content", v if isinstance(v, Column) else F.lit(v)), F.lit("/>")) for name, v in values.items()]
    return F.concat(*[F.when(tag.contains(' content="'), tag).otherwise("") for tag in tags]) if tags else F.lit("")


def render_pages(words: DataFrame, head: Column | None = None) -> DataFrame:
    """(page_id, markup): one document a page from its word rows; a page's words are gathered, nothing larger.

    Lines stand in the order of ``reading_no`` if the words have it, else of ``line_no``. ``head`` is an expression of page_id
    for what the page's head holds (see ``meta_tags``). All of it is built by Spark's own functions.
    """
    value = lambda c: F.col(c).cast("string") if c in words.columns else F.lit(None).cast("string")
    attributes = [_quoted("class", F.coalesce(value("class"), F.lit("ocr_word"))), _quoted("id", value("id")), _quoted("title", value("title")), *(_quoted(a, value(n)) for n, a in ATTRIBUTES.items())]
    span = F.concat(F.lit("<span"), *attributes, F.lit(">"), F.coalesce(_escaped(value("text")), F.lit("")), F.lit("</span>"))
    place = F.coalesce(F.col("reading_no"), F.col("line_no")) if "reading_no" in words.columns else F.col("line_no")
    rows = words.select("page_id", place.alias("_place"), "line_no", "word_no", span.alias("_span"), value("line_title").alias("_line_title"), value("page_title").alias("_page_title"))
    line = F.array_sort(F.collect_list(F.when(F.col("word_no").isNotNull(), F.struct("word_no", "_span", "_line_title"))))
    lines = rows.groupBy("page_id", "_place", "line_no").agg(line.alias("_w"), F.max("_page_title").alias("_page_title"))
    text = F.concat(F.lit(f'<span class="{LINE_CLASS}"'), _quoted("title", F.get("_w", F.lit(0))["_line_title"]), F.lit(">"), F.array_join(F.col("_w._span"), " "), F.lit("</span>"))
    lines = lines.select("page_id", "_page_title", F.when(F.size("_w") > 0, F.struct("_place", "line_no", text.alias("text"))).alias("_l"))
    pages = lines.groupBy("page_id").agg(F.array_sort(F.collect_list("_l")).alias("_ls"), F.max("_page_title").alias("_page_title"))
    markup = F.concat(
        F.lit('<?xml version="1.0" encoding="utf-8"?>\n<!DOCTYPE html>\n<html xmlns="http://www.w3.org/1999/xhtml"><head><title/>'), head if head is not None else F.lit(""), F.lit("</head><body>"),
        F.lit(f'<div class="{PAGE_CLASS}"'), _quoted("title", F.col("_page_title")), F.lit(">"), F.array_join(F.col("_ls.text"), "\n"), F.lit("</div></body></html>\n"),
    )
    return pages.select(F.col("page_id").cast("string").alias("page_id"), markup.alias("markup"))


def write_hocr(words: DataFrame, path: str) -> None:
    """One folder a page (page_id=...) with its markup as text."""
    render_pages(words).select("page_id", F.col("markup").alias("value")).write.option("lineSep", "\x00").partitionBy("page_id").mode("overwrite").text(path)
