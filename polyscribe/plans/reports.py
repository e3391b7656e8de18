"""Accuracy and completion reports over words with a spellcheck_mode."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from polyscribe.functions.chars import is_greek_string

# Colours of the report strip.
NO_ACCURACY, NO_PAGE = "hsl(0, 0%, 0%)", "hsl(0, 0%, 86%)"


def corpus_totals(words: DataFrame) -> DataFrame:
    """One row: total_words (of class ocr_word) and total_accurate_words (mode exactly True)."""
    counted = F.col("class") == "ocr_word"
    return words.agg(F.count_if(counted).alias("total_words"), F.count_if(counted & (F.col("spellcheck_mode") == "True")).alias("total_accurate_words"))


def page_accuracy(words: DataFrame) -> DataFrame:
    """page_id, accuracy: words of mode True among those that have a mode; 0 where none has."""
    n = F.count("spellcheck_mode")
    return words.groupBy("page_id").agg(F.when(n > 0, F.count_if(F.col("spellcheck_mode") == "True") / n).otherwise(F.lit(0.0)).alias("accuracy"))


def accuracy_colour(accuracy: Column) -> Column:
    """From red at 0 to green at 1; black for exactly 0, grey where there is no page."""
    hue = (accuracy * 200).cast("int").cast("string")
    return F.when(accuracy.isNull(), NO_PAGE).when(accuracy == 0, NO_ACCURACY).otherwise(F.concat(F.lit("hsl("), hue, F.lit(",73%,55%)")))


def page_strip(images: DataFrame, accuracies: DataFrame) -> DataFrame:
    """(n, name, stem, accuracy, colour, x): images by name, numbered from 1, with their pages' accuracy."""
    stems = images.select("name", F.regexp_replace("name", r"\.[^.]*$", "").alias("stem"))
    numbered = stems.withColumn("n", F.row_number().over(Window.orderBy("name")))
    joined = numbered.join(accuracies.select(F.col("page_id").alias("_page"), "accuracy"), F.col("stem") == F.col("_page"), "left")
    return joined.select("n", "name", "stem", "accuracy", accuracy_colour(F.col("accuracy")).alias("colour"), (2 * F.col("n")).alias("x"))


def pages_with_images(pages: DataFrame, images: DataFrame) -> DataFrame:
    """The pages (page_id) that have an image of their name; images: name, with extension."""
    stems = images.select(F.regexp_replace("name", r"\.[^.]*$", "").alias("_stem"))
    return pages.join(stems, F.col("page_id").cast("string") == F.col("_stem"), "left_semi")


def assess(words: DataFrame, of_script=is_greek_string) -> DataFrame:
    """One row: words, unspellchecked and verified ones, each also of the script, and floored completion percentages.

    Percentages are 100 less the floor of the open share; all are 0 if there are no words or none of the script.
    """
    script, has = of_script(F.col("text")), F.col("text").isNotNull()
    open_, verified = F.col("spellcheck_mode") == "None", F.col("manually_confirmed") == "true"
    counts = words.agg(
        F.count_if(has).alias("words"), F.count_if(has & script).alias("script_words"), F.count_if(has & open_).alias("open"), F.count_if(has & open_ & script).alias("script_open"),
        F.count_if(has & verified).alias("verified"), F.count_if(has & verified & script).alias("script_verified"),
    )
    none = (F.col("words") == 0) | (F.col("script_words") == 0)
    percent = lambda part, whole, rest: F.when(none, F.lit(0)).otherwise(F.expr(f"{'100 - ' if rest else ''}(100 * {part}) div {whole}"))
    return counts.select(
        "*", percent("open", "words", True).alias("percent_spelled"), percent("script_open", "script_words", True).alias("percent_script_spelled"),
        percent("verified", "words", False).alias("percent_verified"), percent("script_verified", "script_words", False).alias("percent_script_verified"),
    )


def accuracy_report(words: DataFrame, images: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(totals, strip)."""
    return corpus_totals(words), page_strip(images, page_accuracy(words))
