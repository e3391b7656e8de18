"""Writers: correction tables, totals, the report strip, zones, metadata records, fuzzy corrections, run statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from polyscribe.runtime import discard, materialise
from polyscribe.sources.files import SEPARATOR


def _write_text(df: DataFrame, path: str) -> None:
    df.select("value").write.mode("overwrite").text(path)


def write_corrections(corrections: DataFrame, path: str) -> None:
    """``word€output€count€mode`` lines, by count from the highest, then by word.

    Ordering reads its rows twice, first for the ranges, so they are written before.
    """
    held = materialise(corrections.select("word", "output", "n", "mode"), "corrections")
    ordered = held.orderBy(F.desc("n"), "word")
    _write_text(ordered.select(F.concat_ws(SEPARATOR, "word", F.coalesce("output", F.lit("")), F.col("n").cast("string"), "mode").alias("value")), path)
    discard(held)


def statistics_lines(modes: DataFrame, totals: DataFrame) -> DataFrame:
    """(ord, value): modes by count from the highest, then totals, as text."""
    by_mode = modes.select(F.struct(F.lit(0).alias("k"), (-F.col("n")).alias("o"), "mode").alias("ord"), F.format_string("%s: %d words, %d characters", "mode", "n", "biomass").alias("value"))
    percent = F.when(F.col("percent_known").isNull(), "no words").otherwise(F.format_string("known: %.2f %% of words, %.2f %% of characters", "percent_known", "percent_biomass"))
    last = totals.select(F.struct(F.lit(1).alias("k"), F.lit(0).cast("long").alias("o"), F.lit("").alias("mode")).alias("ord"), percent.alias("value"))
    return by_mode.unionAll(last)


def write_fuzzy(best: DataFrame, path: str) -> None:
    _write_text(best.orderBy("word").select(F.concat_ws(SEPARATOR, "word", "best").alias("value")), path)


def totals_xml(totals: DataFrame, prefix: str = "", namespace: str = "") -> DataFrame:
    """(value): the totals of a corpus as one XML document, its elements in a namespace if one is given."""
    p = f"{prefix}:" if prefix else ""
    declared = f' xmlns{":" + prefix if prefix else ""}="{namespace}"' if namespace else ""
    return totals.select(F.format_string(f"<{p}totals{declared}><{p}total_words>%d</{p}total_words><{p}total_accurate_words>%d</{p}total_accurate_words></{p}totals>", "total_words", "total_accurate_words").alias("value"))


def strip_svg(strip: DataFrame, height: int = 20) -> DataFrame:
    """(value): one rectangle an image, two wide, named and linked by its number; a row an image is all that is gathered."""
    rect = F.format_string('<a href="%d"><rect x="%d" y="0" width="2" height="' + str(height) + '" fill="%s"><title>%d</title></rect></a>', "n", "x", "colour", "n")
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", rect.alias("r")))), lambda x: x["r"]), "\n")
    return strip.agg(F.concat(F.format_string('<svg xmlns="http://www.w3.org/2000/svg" width="%d" height="' + str(height) + '">\n', 2 * F.count("*")), body, F.lit("\n</svg>")).alias("value"))


def write_zones(zones: DataFrame, path: str) -> None:
    zones.write.mode("overwrite").csv(path, sep=";", header=True)


def write_metadata(records: DataFrame, path: str) -> None:
    """One folder a record (identifier=...)."""
    records.select("identifier", F.col("xml").alias("value")).write.partitionBy("identifier").mode("overwrite").text(path)
