"""Word rows from texts, and row-level filters and projections on them.

A *words* table has page_id, line_no, word_no (position in its page) and text; more columns as its source has them.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

ORDER = ("line_no", "word_no")


def text_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """page_id, line_no (from 0), line, and columns to keep: what stands between line feeds. Null texts have no lines."""
    return docs.select(F.col(id_col).alias("page_id"), *keep, F.posexplode(F.split(text_col, "\n", -1)).alias("line_no", "line"))


def line_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """page_id, line_no, ws: the blank-separated tokens of each line, in one row."""
    return text_lines(docs, id_col, text_col, keep).select("page_id", *keep, "line_no", F.array_remove(F.split("line", r"\s+", -1), "").alias("ws"))


#: Bytes of files for each partition of pages that are dealt out: some hundred thousand words, which a task sorts in memory.
DEALT_BYTES = 3_000_000


def dealt(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """docs dealt out by page, into partitions of a bounded size. Windows, groups and joins by page on what is made of them need no
    further shuffle: texts are moved once, in place of their words, which take many times as much."""
    size = int(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return docs.repartition(max(tasks, min(100_000, -(-size // DEALT_BYTES))), id_col)


def text_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """page_id, line_no, word_no (in its line, from 0), text: blank-separated tokens."""
    return line_words(docs, id_col, text_col, keep).select("page_id", *keep, "line_no", F.posexplode("ws").alias("word_no", "text"))


def distinct_words(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(text): the different texts of ``text_words``; a line feed is a blank too, so that a text is split once."""
    return docs.select(F.explode(F.split(text_col, r"\s+", -1)).alias("text")).filter("text != ''").distinct()


def with_boxes(words: DataFrame) -> DataFrame:
    """Words with boxes laid out on a grid: 60 x 40 a cell, 10 a character, 30 high."""
    x0, y0 = 60 * F.col("word_no"), 40 * F.col("line_no")
    box = F.struct(x0.alias("x0"), y0.alias("y0"), (x0 + 10 * F.char_length("text")).alias("x1"), (y0 + 30).alias("y1"))
    return words.withColumn("bbox", box)


def countable(words: DataFrame) -> DataFrame:
    """page_id ... word: the form to count of each word that is to be counted.

    A joined form counts in place of its head, its tail ('' form) does not count, nor does a head left unjoined.
    """
    form, text = F.col("dehyphenated_form"), F.col("text")
    word = F.when((form == "") | text.isNull(), F.lit(None)).when(form.isNotNull(), form).when(~text.endswith("-"), text)
    return words.withColumn("word", word).filter("word IS NOT NULL")


def with_text(words: DataFrame) -> DataFrame:
    return words.filter("text IS NOT NULL")


def as_ocr_words(words: DataFrame) -> DataFrame:
    """One class name for words."""
    return words.withColumn("class", F.when(F.col("class") == "ocrx_word", "ocr_word").otherwise(F.col("class")))


def with_default_attributes(words: DataFrame) -> DataFrame:
    """Missing ids become a digest of the word's place, so reruns agree; unconfirmed words say so."""
    place = F.sha1(F.concat_ws("/", F.col("page_id").cast("string"), F.col("line_no").cast("string"), F.col("word_no").cast("string")))
    return words.withColumns({"id": F.coalesce("id", F.concat(F.lit("_"), place)), "manually_confirmed": F.coalesce("manually_confirmed", F.lit("false"))})


def line_ends(words: DataFrame) -> DataFrame:
    """page_id, line_no, first_word, last_word, n_words of lines that have words; one aggregation with map-side combine."""
    place = F.struct("word_no", "text")
    ends = words.groupBy("page_id", "line_no").agg(F.min(place).alias("a"), F.max(place).alias("z"), F.count("*").alias("n_words"))
    return ends.select("page_id", "line_no", F.col("a.text").alias("first_word"), F.col("z.text").alias("last_word"), "n_words")


def list_ends(lines: DataFrame) -> DataFrame:
    """What ``line_ends`` returns, of lines with their words in one row (``line_words``); nothing is moved or sorted."""
    some = lines.filter(F.size("ws") > 0)
    return some.select("page_id", "line_no", F.element_at("ws", 1).alias("first_word"), F.element_at("ws", -1).alias("last_word"), F.size("ws").cast("long").alias("n_words"))


def neighbours(words: DataFrame, order: tuple[str, ...] = ORDER, column: str = "text") -> DataFrame:
    """Words with the previous and next text of their page; page ends have null on one side."""
    w = Window.partitionBy("page_id").orderBy(*order)
    return words.withColumns({"previous": F.lag(column).over(w), "following": F.lead(column).over(w), "_at": F.row_number().over(w), "_of": F.count("*").over(Window.partitionBy("page_id"))})


def similar_images(pairs: DataFrame, a: str, b: str, most: int = 11) -> DataFrame:
    """Pairs of hashes (longs) fewer than ``most`` bits apart."""
    return pairs.filter(F.bit_count(F.col(a).bitwiseXOR(F.col(b))) < most)


def file_identifier(x: Column) -> Column:
    return F.replace(F.replace(x, F.lit("_"), F.lit("UL")), F.lit("."), F.lit("PERIOD"))


def without_newlines(x: Column) -> Column:
    return F.replace(x, F.lit("\n"), F.lit(""))


def page_title(title: Column, file_name: Column) -> Column:
    """``image <stem>.png; `` and the first part of the old title."""
    stem = F.regexp_replace(file_name, r"\.[^.]*$", "")
    return F.concat(F.lit("image "), stem, F.lit(".png; "), F.get(F.split(F.coalesce(title, F.lit("")), ";"), F.lit(0)))


def hash_pairs(hashes: DataFrame, id_col: str, hash_col: str, most: int = 11, bits: int = 64) -> DataFrame:
    """(a, b, distance): pairs of ids a < b whose hashes differ in fewer than ``most`` bits.

    Of ``most`` + 1 bands of bits at least two are equal, so hashes meet by every two bands; a pair is kept where its first two equal
    bands meet, so none comes twice. Those that share two bands are compared in numpy, a million comparisons at a time.
    """
    count = most + 1
    edges = [round(i * bits / count) for i in range(count + 1)]
    bands = np.array([((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges[:-1], edges[1:], strict=True)], dtype=np.uint64)
    both = list(combinations(range(count), 2))
    h = F.col(hash_col)
    keys = F.array(*[h.bitwiseAND(F.lit(int((bands[i] | bands[j]).view(np.int64)))) for i, j in both])
    spread = hashes.filter(F.col(id_col).isNotNull() & h.isNotNull()).select(F.col(id_col).alias("id"), h.alias("h"), F.posexplode(keys).alias("both", "key"))
    shared = spread.groupBy("both", "key").agg(F.collect_list(F.struct("id", "h")).alias("_g")).filter(F.size("_g") > 1)

    def meet(batches):
        for batch in batches:
            for k, group in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids, held = group.values.field(0), group.values.field(1).to_numpy().view(np.uint64)
                number = ids.to_numpy(zero_copy_only=False)
                step = max(1, 1_000_000 // len(held))
                for start in range(0, len(held), step):
                    differ = held[start : start + step, None] ^ held[None, start:]
                    x, y = np.nonzero(np.triu(np.bitwise_count(differ) < most, 1))
                    equal = (differ[x, y][:, None] & bands) == 0
                    first = equal.argmax(axis=1)
                    equal[np.arange(len(x)), first] = False
                    mine = (first == both[k][0]) & (equal.argmax(axis=1) == both[k][1])
                    x, y = x[mine], y[mine]
                    distance = np.bitwise_count(differ[x, y])
                    x, y = x + start, y + start
                    turned = number[x] > number[y]
                    x, y = np.where(turned, y, x), np.where(turned, x, y)
                    other = number[x] != number[y]
                    if other.any():
                        yield pa.RecordBatch.from_arrays([ids.take(pa.array(x[other])), ids.take(pa.array(y[other])), pa.array(distance[other], pa.int32())], names=["a", "b", "distance"])

    kind = hashes.schema[id_col].dataType
    return shared.select("both", "_g").mapInArrow(meet, StructType([StructField("a", kind), StructField("b", kind), StructField("distance", IntegerType())]))
