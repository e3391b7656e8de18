"""Dictionary lookups as joins: membership, lower-cased membership, accent-free values, both halves, unknown words.

A lexicon is a table of distinct normal forms; an index maps an accent-free form to a word. Lookups run over distinct
words (``vocabulary``), never over word rows. A lexicon is written once and broadcast only if measured to be small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from polyscribe.functions import tokens as T
from polyscribe.functions import unicode as U
from polyscribe.runtime import materialise

#: Rows and bytes of text up to which a lookup table is sent to every executor.
BROADCAST_ROWS, BROADCAST_BYTES = 1_000_000, 64_000_000


def sized(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> DataFrame:
    """df, written once, with a broadcast hint if it was measured to be small; else both sides of its joins shuffle."""
    known = getattr(df, "_polyscribe_sized", None)
    if known is None:
        held = df if hasattr(df, "_polyscribe_path") else materialise(df, "lookup")
        text = [F.coalesce(F.sum(F.octet_length(f.name)), F.lit(0)) for f in held.schema.fields if f.dataType.simpleString() == "string"]
        n, *bytes_ = held.agg(F.count("*"), *text).first()
        small = n <= rows and sum(bytes_) <= size
        known = F.broadcast(held) if small else held
        known._polyscribe_small = small
        df._polyscribe_sized = known._polyscribe_sized = known
    return known


def in_lexicon_by_case(rows: DataFrame, lexicon: DataFrame, column: str = "text") -> DataFrame:
    """rows with _e and _l: is the text, is its lower-cased core in the lexicon? A small lexicon goes to the rows; else distinct texts are looked up."""
    def judged(v: DataFrame, c: str) -> DataFrame:
        return in_lexicon(in_lexicon(v, lexicon, F.col(c), "_e"), lexicon, T.lower_key(c), "_l")

    if is_small(lexicon):
        return judged(rows, column)
    return by_distinct(rows, column, lambda v: judged(v, "value").filter("_e OR _l")).withColumns({c: F.coalesce(c, F.lit(False)) for c in ("_e", "_l")})


def is_small(df: DataFrame) -> bool:
    """Whether ``sized`` has df broadcast."""
    return sized(df)._polyscribe_small


def by_distinct(rows: DataFrame, column: str, judge) -> DataFrame:
    """rows with the columns that ``judge`` adds to a table (value) of the column's distinct values; rows of nulls get nulls.

    What is dear is done once a value; the values meet the rows in a broadcast, or beyond its bounds in a shuffled join.
    """
    values = judge(materialise(rows.select(F.col(column).alias("value")).filter("value IS NOT NULL").distinct(), "values"))
    return rows.join(sized(values), F.col(column) == F.col("value"), "left").drop("value")


def ascii_or(df: DataFrame, column: str, out: str, function) -> DataFrame:
    """df with out = function(column); ASCII values are their own result and reach Python as nulls."""
    plain = F.coalesce(F.col(column).rlike(r"^\p{ASCII}*$"), F.lit(True))
    return df.withColumn(out, F.when(plain, F.col(column)).otherwise(function(F.when(~plain, F.col(column)))))


def vocabulary(words: DataFrame, column: str = "text") -> DataFrame:
    """(word, n): counts by normalised core; a token without core counts as itself.

    Raw tokens are counted and written first, so that normalisation, and any filter that the optimiser would move
    below the count, sees each distinct token once.
    """
    raw = materialise(words.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("_raw")).agg(F.count("*").alias("_n")), "raw-words")
    cored = raw.withColumn("_folded", T.fold_apostrophes(T.token_core("_raw")))
    keyed = ascii_or(cored, "_folded", "_key", lambda c: U.normalize(c, "NFC"))
    return keyed.groupBy(F.when(F.col("_key") != "", F.col("_key")).otherwise(F.col("_raw")).alias("word")).agg(F.sum("_n").alias("n"))


def make_lexicon(words: DataFrame, column: str = "word") -> DataFrame:
    """(word): the distinct normal forms of a column's words."""
    folded = words.filter(F.col(column).isNotNull()).select(T.fold_apostrophes(F.col(column)).alias("_folded")).distinct()
    return ascii_or(folded, "_folded", "word", lambda c: U.normalize(c, "NFC")).filter("word != ''").select("word").distinct()


def make_accent_index(lexicon: DataFrame) -> DataFrame:
    """(bare, word): for each accent-free form one word, the greatest of several."""
    return ascii_or(lexicon, "word", "bare", U.strip_accents).groupBy("bare").agg(F.max("word").alias("word"))


def lower_word(x: Column) -> Column:
    """Lower case without the final-sigma rule."""
    return F.lower(F.translate(x, "Σ", "σ"))


def in_lexicon(vocab: DataFrame, lexicon: DataFrame, key: Column, out: str = "hit") -> DataFrame:
    """vocab with a boolean: is the key in the lexicon?"""
    listed = sized(lexicon).select(F.col("word").alias("_entry"), F.lit(True).alias("_hit"))
    return vocab.join(listed, key == F.col("_entry"), "left").withColumn(out, F.coalesce("_hit", F.lit(False))).drop("_entry", "_hit")


def without_accents(vocab: DataFrame, index: DataFrame, out: str = "found", column: str = "word") -> DataFrame:
    """vocab with the index's word for the accent-free form, or null."""
    listed = sized(index).select(F.col("bare").alias("_bare"), F.col("word").alias(out))
    return ascii_or(vocab, column, "_form", U.strip_accents).join(listed, F.col("_form") == F.col("_bare"), "left").drop("_form", "_bare")


def unknown_words(vocab: DataFrame, lexicon: DataFrame) -> DataFrame:
    """The words whose lower-cased core is not in the lexicon."""
    return vocab.join(sized(lexicon).select(F.col("word").alias("_entry")), T.lower_key("word") == F.col("_entry"), "left_anti")


def both_halves(vocab: DataFrame, lexicon: DataFrame) -> DataFrame:
    """(word, a, b): the first way, in the order of ``halves``, to cut a word into two that are in the lexicon."""
    tried = vocab.filter(F.char_length("word") >= 10).select("word", F.posexplode(T.halves("word")).alias("ord", "_h")).select("word", "ord", "_h.a", "_h.b")
    entries = sized(lexicon).select(F.col("word").alias("_entry"))
    hits = tried.join(entries, F.col("a") == F.col("_entry"), "left_semi").join(entries, F.col("b") == F.col("_entry"), "left_semi")
    return hits.groupBy("word").agg(F.min_by(F.struct("a", "b"), "ord").alias("_p")).select("word", "_p.a", "_p.b")


def latin_suffixed(vocab: DataFrame, lexicon: DataFrame, suffixes: list[str] = T.LATIN_SUFFIXES) -> DataFrame:
    """(word, suffix): words that are a lexicon word, as it stands or by lower-cased core, and an enclitic."""
    tried = vocab.select("word", F.explode(F.array(*[F.lit(s) for s in suffixes])).alias("suffix")).filter(F.col("word").endswith(F.col("suffix")))
    stems = tried.withColumn("_stem", F.col("word").substr(F.lit(1), F.char_length("word") - F.char_length("suffix")))
    keys = stems.select("word", "suffix", F.explode(F.array_distinct(F.array("_stem", T.lower_key("_stem")))).alias("_key"))
    return keys.join(sized(lexicon).select(F.col("word").alias("_entry")), F.col("_key") == F.col("_entry"), "left_semi").select("word", "suffix").distinct()
