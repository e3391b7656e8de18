"""Unicode normalisation and what needs it, as Arrow-batched pandas UDFs.

Spark has no NFC/NFD function. Apply these to distinct words (``normalize_distinct`` does), not to every row.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Combining marks and the spacing arrows that stand for them in comparisons.
MARKS = "̓̔͂́̀ͅ"
ARROWS = "↲↱↔↗↖↓"
DIAERESIS = "̈"
_SHOW = str.maketrans(MARKS, ARROWS)


def _col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def bare(word: str) -> str:
    """The word without its combining marks."""
    return "".join(c for c in unicodedata.normalize("NFD", word) if not unicodedata.combining(c))


def marked(word: str) -> str:
    """NFD with breathings, accents and iota subscript shown as characters of their own (the diaeresis stays)."""
    return unicodedata.normalize("NFD", word).translate(_SHOW)


def combined(a: str, b: str) -> str | None:
    """The one character that a and b compose to, if they do."""
    both = unicodedata.normalize("NFC", a + b)
    return both if len(both) == 1 else None


def compose(characters: str) -> tuple[str, str]:
    """(base, rejects): each next character is combined with the base if it can be, else set aside."""
    base, rejects = characters[:1], ""
    for c in characters[1:]:
        new = combined(base, c)
        base, rejects = (new, rejects) if new else (base, rejects + c)
    return base, rejects


def describe_characters(word: str) -> str:
    """Code point, category and name of every character, for diagnostics."""
    return "; ".join(f"U+{ord(c):04X} {unicodedata.category(c)} {unicodedata.name(c, '?')}" for c in word)


def forms(word: str) -> str:
    """Which normal forms the word is in."""
    return ",".join(f for f in ("NFC", "NFD", "NFKC", "NFKD") if unicodedata.is_normalized(f, word))


def _vectorised(function, kind: str = "string"):
    @F.pandas_udf(kind)
    def apply(words: pd.Series) -> pd.Series:
        return words.map(function, na_action="ignore")

    return apply


def normalize(x: Column | str, form: str = "NFC") -> Column:
    return _vectorised(lambda w, form=form: unicodedata.normalize(form, w))(_col(x))


def strip_accents(x: Column | str) -> Column:
    return _vectorised(bare)(_col(x))


def show_marks(x: Column | str) -> Column:
    return _vectorised(marked)(_col(x))


def describe(x: Column | str) -> Column:
    return _vectorised(describe_characters)(_col(x))


def normal_forms(x: Column | str) -> Column:
    return _vectorised(forms)(_col(x))


def can_combine(a: Column | str, b: Column | str) -> Column:
    @F.pandas_udf("string")
    def apply(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([None if p is None or q is None else combined(p, q) for p, q in zip(x, y, strict=True)], dtype=object)

    return apply(_col(a), _col(b))


def recursive_combine(x: Column | str) -> Column:
    """struct(base, rejects)."""

    @F.pandas_udf("base string, rejects string")
    def apply(words: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([compose(w or "") for w in words], columns=["base", "rejects"])

    return apply(_col(x))


def with_ascii_shortcut(x: Column | str, function, shortcut=None) -> Column:
    """``function`` where x has non-ASCII characters, else ``shortcut`` (x itself by default): ASCII skips Python's result."""
    x = _col(x)
    return F.when(x.rlike(r"^\p{ASCII}*$"), shortcut(x) if shortcut else x).otherwise(function(x))


def normalize_distinct(df: DataFrame, column: str, out: str, function) -> DataFrame:
    """df with ``out`` = function(column), computed once a distinct value and joined back (nulls stay null)."""
    values = df.select(F.col(column).alias("_value")).filter("_value IS NOT NULL").distinct()
    values = values.withColumn(out, function(F.col("_value")))
    return df.join(values, F.col(column) == F.col("_value"), "left").drop("_value")
