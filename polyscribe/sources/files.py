"""Dictionaries, indexes, rules, correction tables, zones, metadata, archives, images and plain texts as DataFrames.

Order inside a file matters where the last of several rows holds. Files are read whole and split with positions, so that
order is the file's; these files are lookup tables, each of which fits one task.
"""

from __future__ import annotations

import io
import zipfile

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from polyscribe.functions import tokens as T
from polyscribe.functions import unicode as U
from polyscribe.operators.lookup import ascii_or

# Fixed values.
MALFORMED_FREQUENCY = 5
SEPARATOR = "€"


def read_lines(spark: SparkSession, *paths: str) -> DataFrame:
    """(path, ord, line) of text files, in file order; a line feed at the end of a file begins no line.

    A file is split once: nothing but its lines leaves the generator.
    """
    whole = spark.read.text(list(paths), wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value").filter("value != ''")
    lined = whole.select("path", F.posexplode(F.split(F.regexp_replace("value", r"\n\z", ""), "\n", -1)).alias("ord", "line"))
    return lined.select("path", "ord", F.regexp_replace("line", "\r$", "").alias("line"))


def read_dictionary(spark: SparkSession, path: str, ligatures: bool = False) -> DataFrame:
    """(word) distinct: ``word,frequency`` lines of positive frequency, normalised; a line of another shape is a word of frequency 5.

    A frequency that is no integer makes its line malformed too.
    """
    lines = ascii_or(read_lines(spark, path), "line", "nfc", lambda c: U.normalize(c, "NFC"))
    parts = F.split("nfc", ",", -1)
    number = F.get(parts, F.lit(1)).try_cast("int")
    good = (F.size(parts) == 2) & number.isNotNull()
    rows = lines.select(F.when(good, parts[0]).otherwise(F.col("nfc")).alias("_w"), F.when(good, number).otherwise(MALFORMED_FREQUENCY).alias("_f")).filter("_f > 0")
    folded = rows.select(T.fold_apostrophes(F.translate("_w", "\n\r\x11", "")).alias("_w"))
    words = ascii_or(folded, "_w", "_v", lambda c: U.normalize(c, "NFC"))
    return words.select((T.make_ligatures("_v") if ligatures else F.col("_v")).alias("word")).filter("word != ''").distinct()


def read_fuzzy_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """(form, word, freq, ord): ``word,frequency`` lines, compared by form; of equal forms the last holds."""
    lines = read_lines(spark, path)
    parts = F.split("line", ",", -1)
    rows = lines.filter(F.size(parts) == 2).select("ord", parts[0].alias("word"), parts[1].try_cast("int").alias("freq"))
    formed = rows.withColumn("word", T.preprocess_word_fuzzy("word")).withColumn("form", U.show_marks("word"))
    return formed.groupBy("form").agg(F.max_by(F.struct("word", "freq"), "ord").alias("_l"), F.min("ord").alias("ord")).select("form", "_l.word", "_l.freq", "ord")


def read_accent_index(spark: SparkSession, path: str) -> DataFrame:
    """(bare, word): ``bare,word`` lines; the last of equal keys holds."""
    parts = F.split("line", ",", -1)
    rows = read_lines(spark, path).filter(F.size(parts) == 2).select("ord", parts[0].alias("bare"), parts[1].alias("word"))
    return rows.groupBy("bare").agg(F.max_by("word", "ord").alias("word"))


def read_corrections(spark: SparkSession, path: str) -> DataFrame:
    """(word, output, frequency, mode): comments, malformed and False rows left out, keys NFC, the last of equal keys holds. Empty lines are malformed."""
    parts = F.split("line", SEPARATOR, -1)
    rows = read_lines(spark, path).filter((~F.col("line").startswith("#")) & (F.size(parts) == 4))
    named = rows.select("path", "ord", *[parts[i].alias(c) for i, c in enumerate(("_word", "output", "frequency", "mode"))]).filter("mode != 'False'")
    keyed = ascii_or(named, "_word", "word", lambda c: U.normalize(c, "NFC"))
    return keyed.groupBy("word").agg(F.max_by(F.struct("output", "frequency", "mode"), F.struct("path", "ord")).alias("_l")).select("word", "_l.*")


def read_substitutions(spark: SparkSession, path: str) -> DataFrame:
    """(ord, from, to): lines of a character and its replacements, tab- and blank-separated, in the order in which they are tried."""
    rows = read_lines(spark, path).select("ord", F.split("line", "\t").alias("_p")).filter(F.size("_p") == 2)
    each = rows.select("ord", F.col("_p")[0].alias("from"), F.posexplode(F.split(F.col("_p")[1], " +")).alias("_k", "to")).filter("to != ''")
    return each.select((F.col("ord") * 1000 + F.col("_k")).cast("long").alias("ord"), "from", "to")


def accent_substitutions(spark: SparkSession) -> DataFrame:
    """(ord, from, to) made by rule: each accented Greek vowel may be any other form of its vowel."""
    import unicodedata

    forms: dict[str, list[str]] = {}
    for c in map(chr, [*range(0x0386, 0x03D0), *range(0x1F00, 0x2000)]):
        base = unicodedata.normalize("NFD", c)[:1]
        if unicodedata.category(c) in ("Ll", "Lu") and base in "αεηιουωρΑΕΗΙΟΥΩΡ" and unicodedata.normalize("NFC", c) == c:
            forms.setdefault(base, []).append(c)
    pairs = [(a, b) for base in sorted(forms) for a in forms[base] for b in forms[base] if a != b]
    return spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "ord long, from string, to string")


def read_zones(spark: SparkSession, path: str) -> DataFrame:
    """(name, ul_x, ul_y, ll_x, ll_y, lr_x, lr_y, ur_x, ur_y) of a semicolon table with a header."""
    return spark.read.csv(path, sep=";", header=True, schema="name string, ul_x int, ul_y int, ll_x int, ll_y int, lr_x int, lr_y int, ur_x int, ur_y int")


def read_json_responses(spark: SparkSession, *paths: str) -> DataFrame:
    """(json): one document a file."""
    return spark.read.text(list(paths), wholetext=True).select(F.col("value").alias("json"))


def list_archive(spark: SparkSession, path: str, suffix: str = "") -> DataFrame:
    """(archive, name): the entries of zip archives, in order of name."""

    def names(batches):
        for batch in batches:
            rows = [(p, n) for p, c in zip(batch["path"], batch["content"], strict=True) for n in sorted(zipfile.ZipFile(io.BytesIO(c)).namelist()) if n.endswith(suffix)]
            yield pd.DataFrame(rows, columns=["archive", "name"], dtype=object)

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(names, "archive string, name string")


def read_images(spark: SparkSession, path: str, pattern: str = "*.{png,jpg,jpeg,tif}", least_bytes: int = 0) -> DataFrame:
    """(path, length, content) of image files; smaller ones are left out before they are read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    return files.filter(F.col("length") >= least_bytes).select("path", "length", "content")
