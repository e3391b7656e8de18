"""Small tables with the awkward rows that every operator has to handle."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, task long, n_words int, h string, block string, size double"


def table(spark, rows, partitions=3):
    """rows: (doc_id, text) or (doc_id, text, source); extra columns carry names that operators use inside."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or ""), "x", 7, 3, "h", "b", 1.5) for r in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(partitions)


def prose(seed, words, vocabulary=4000):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary):x}{'aeiou'[rng.randrange(5)]}" for _ in range(words))


def edge_rows():
    long = prose(99, 30_000)
    return [(None, None), (None, "only words without id here today yes"), (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one"), (6, long), (7, long), (7, long), (8, "Ünïcödé 日本語 wörds 😀 and\nlines\n\nof text"), (9, "a b c d"), (10, "A B C D")]


def words(text):
    return WORD.findall(text or "")
