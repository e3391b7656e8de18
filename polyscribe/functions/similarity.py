"""Similarity of words, texts and images; weighted edits.

Column expressions where Spark can say it; the edit-script functions are Arrow-batched and meant for pairs that a join
has already found near.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from polyscribe.functions.unicode import ARROWS, DIAERESIS, marked

# What an edit costs by default, and the rules that cost otherwise; the first that fits holds.
# * stands for any character or none; a rule's characters are alternatives.
COSTS = {"replace": 10, "delete": 15, "insert": 18}
ACCENTS = "↲↱↔↗↖↓" + "̈"
UPPER_ACCENTS = "↲↱↔↗↖" + "̈"
EDIT_RULES = [
    ("replace", "|", "ι", 1),
    ("replace", "’", "'", 1),
    ("replace", "↲", "↗", 1),
    ("replace", "↱", "↖", 1),
    ("replace", "0", "Ο", 1),
    ("replace", "0", "οΘθ", 2),
    ("replace", "8", "δ", 3),
    ("replace", "ΟοOo", "ΟοOo", 2),
    ("replace", "Λλ", "Λλ", 1),
    ("replace", "A", "Α", 1),
    ("replace", "BβΒ", "BβΒ", 1),
    ("replace", "Z", "Ζ", 1),
    ("replace", "H", "Η", 1),
    ("replace", "t", "ι", 1),
    ("replace", "Ili1", "ιΙ", 1),
    ("replace", "M", "Μ", 1),
    ("replace", "N", "Ν", 1),
    ("replace", "Pp", "Ρρ", 1),
    ("replace", "ϲϹ", "σςΣ", 1),
    ("replace", "T", "Ττ", 1),
    ("replace", "Τr", "τ", 1),
    ("replace", "Uu", "υ", 1),
    ("replace", "Y", "Υ", 1),
    ("replace", "E", "Ε", 1),
    ("replace", "E", "ε", 2),
    ("replace", "Z", "Ζ", 1),
    ("replace", "K", "κΚ", 1),
    ("replace", "Η", "Π", 2),
    ("replace", "a", "α", 1),
    ("replace", "ΛΑ", "ΛΑ", 1),
    ("insert", "*", ACCENTS, 3),
    ("delete", ACCENTS, "*", 3),
    ("replace", UPPER_ACCENTS, UPPER_ACCENTS, 2),
    ("replace", "σ", "ς", 2),
    ("replace", "χΧ", "χΧ", 2),
    ("replace", "κΚ", "κΚ", 2),
    ("replace", "r", "γ", 4),
    ("replace", "ζ", "ς", 3),
    ("insert", "*", "'", 1),
]
assert ARROWS + DIAERESIS == ACCENTS


def edit_script(a: str, b: str) -> list[tuple[str, int, int]]:
    """An optimal edit script from a to b as (operation, position in a, position in b).

    Among optimal scripts: traced from the ends back, keeping equal characters first, then replace, insert, delete.
    """
    rows = [list(range(len(b) + 1))]
    for i, x in enumerate(a, 1):
        above, row = rows[-1], [i]
        for j, y in enumerate(b, 1):
            row.append(min(above[j - 1] + (x != y), row[j - 1] + 1, above[j] + 1))
        rows.append(row)
    i, j, out = len(a), len(b), []
    while i or j:
        d = rows[i][j]
        if i and j and a[i - 1] == b[j - 1] and rows[i - 1][j - 1] == d:
            i, j = i - 1, j - 1
        elif i and j and rows[i - 1][j - 1] + 1 == d:
            i, j = i - 1, j - 1
            out.append(("replace", i, j))
        elif j and rows[i][j - 1] + 1 == d:
            j -= 1
            out.append(("insert", i, j))
        else:
            i -= 1
            out.append(("delete", i, j))
    return out[::-1]


def edit_weight(a: str, b: str, rules=EDIT_RULES, most: int = 9) -> int:
    """The script's cost by the rules; adding stops once ``most`` is reached."""
    total = 0
    for operation, i, j in edit_script(a, b):
        x, y = a[i : i + 1], b[j : j + 1]
        total += next((w for o, p, q, w in rules if o == operation and (p == "*" or x in p) and (q == "*" or y in q)), COSTS[operation])
        if total >= most:
            break
    return total


def weighted_distance(a: Column, b: Column, rules=EDIT_RULES, most: int = 9) -> Column:
    """edit_weight of two columns; null if either is."""

    @F.pandas_udf("int")
    def apply(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([None if p is None or q is None else edit_weight(p, q, rules, most) for p, q in zip(x, y, strict=True)], dtype="Int32")

    return apply(a, b)


def common_subsequence(a: str, b: str) -> int:
    """Length of the longest common subsequence, bit-parallel over a's characters."""
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    open_ = full
    for c in b:
        hit = open_ & where.get(c, 0)
        open_ = ((open_ + hit) | (open_ - hit)) & full
    return len(a) - open_.bit_count()


def marked_ratio(a: str, b: str) -> float:
    """2 LCS / (|a| + |b|) of the words with their marks shown; 1 for two empty words."""
    a, b = marked(a), marked(b)
    return 2 * common_subsequence(a, b) / (len(a) + len(b)) if a or b else 1.0


def lev_ratio(a: Column, b: Column) -> Column:
    @F.pandas_udf("double")
    def apply(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([None if p is None or q is None else marked_ratio(p, q) for p, q in zip(x, y, strict=True)], dtype="float64")

    return apply(a, b)


def shingles(x: Column, n: int = 3, pad: str = "$") -> Column:
    """The n-grams of a text with n - 1 pad characters at either end, line feeds left out."""
    padded = F.concat(F.lit(pad * (n - 1)), F.replace(x, F.lit("\n"), F.lit("")), F.lit(pad * (n - 1)))
    return F.transform(F.sequence(F.lit(1), F.char_length(padded) - n + 1), lambda i: padded.substr(i, F.lit(n)))


def trigram_similarities(pairs: DataFrame, id_col: str, a: str, b: str, n: int = 3) -> DataFrame:
    """(id, similarity): multiset intersection over multiset union of the padded n-grams of two text columns.

    Grams are rows and their counts meet in one aggregation a pair. Pairs with a null text are left out; two empty texts are alike.
    """
    both = pairs.filter(F.col(a).isNotNull() & F.col(b).isNotNull())

    def grams(column, side):
        return F.transform(shingles(F.col(column), n), lambda g: F.struct(g.alias("g"), F.lit(side).alias("side")))

    sides = F.explode(F.concat(grams(a, 0), grams(b, 1)))
    counts = both.select(F.col(id_col).alias("id"), sides.alias("_s")).groupBy("id", "_s.g").agg(F.count_if(F.col("_s.side") == 0).alias("x"), F.count_if(F.col("_s.side") == 1).alias("y"))
    return counts.groupBy("id").agg((F.sum(F.least("x", "y")) / F.sum(F.greatest("x", "y"))).alias("similarity")).withColumnRenamed("id", id_col)


def average_hash(values: Column) -> Column:
    """Array of booleans: which values lie above their mean."""
    mean = F.aggregate(values, F.lit(0.0), lambda s, v: s + v.cast("double")) / F.size(values)
    return F.transform(values, lambda v: v.cast("double") > mean)


def hamming(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x != y).cast("int")), F.lit(0), lambda s, v: s + v)


def hash_words(bits: Column) -> Column:
    """An array of up to 64 booleans as one long, so that distances are bit_count(a ^ b)."""
    return F.aggregate(bits, F.lit(0).cast("long"), lambda s, v: F.shiftleft(s, 1).bitwiseOR(v.cast("long")))


def hash_distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))
