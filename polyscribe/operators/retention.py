"""Which words of a page belong to its script, judged by themselves and their neighbours."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from polyscribe.functions.chars import is_greek_string, is_number
from polyscribe.operators.words import ORDER, neighbours

COLUMN_LETTERS = "ABCD"


def judge_words(words: DataFrame, of_script=is_greek_string, broaden: int = 0, order: tuple[str, ...] = ORDER) -> DataFrame:
    """words with delete, broaden and reason. The first and last word of a page are never judged (delete is null).

    Words of the script stay. A column letter beside one goes, widened by 2. Numbers and words of under four characters stay
    only between two words of the script. All others go.
    """
    seen = neighbours(words, order)
    text = F.col("text")
    script: Column = of_script(text)
    before, after = of_script(F.col("previous")), of_script(F.col("following"))
    judged = (F.col("_at") > 1) & (F.col("_at") < F.col("_of"))
    letter = (F.char_length(text) == 1) & text.isin(*COLUMN_LETTERS) & (before | after)
    short = is_number(text) | (F.coalesce(F.char_length(text), F.lit(0)) < 4)
    reason = F.when(~judged, "edge").when(script, "script").when(letter, "column letter").when(short & before & after, "between script").when(short, "short").otherwise("foreign")
    return seen.withColumn("reason", reason).withColumns({
        "delete": F.when(F.col("reason") != "edge", F.col("reason").isin("column letter", "short", "foreign")),
        "broaden": F.when(F.col("reason") == "column letter", 2).otherwise(broaden),
    }).drop("previous", "following", "_at", "_of")


def erased_rectangles(judged: DataFrame) -> DataFrame:
    """page_id and the rectangle, widened in x, of every word to be deleted."""
    box = F.col("bbox")
    return judged.filter("delete").select("page_id", F.struct((box["x0"] - F.col("broaden")).alias("x0"), box["y0"].alias("y0"), (box["x1"] + F.col("broaden")).alias("x1"), box["y1"].alias("y1")).alias("rectangle"))
