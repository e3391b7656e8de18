"""Fuzzy dictionary matching: edit-distance pairs, weighted ranking and the correction query over plain texts.

A small dictionary goes to the words, and each word is compared with all entries of near lengths at once, an entry's whole
column of the distance table being one integer. Of a larger one, and for entries beyond 64 characters: at distance at most
k, one of k + 1 pieces of the dictionary word stands unedited in the other word, moved by at most k characters. Pieces and
their possible places are exploded and met by an equi-join on (length, number, piece), candidates are made distinct and
verified. Dictionary words too short for k + 1 pieces, which are few, meet words of their lengths in blocks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from polyscribe.functions import chars as C
from polyscribe.functions import tokens as T
from polyscribe.functions import unicode as U
from polyscribe.functions.similarity import EDIT_RULES, weighted_distance
from polyscribe.operators.dehyphenate import text_tokens
from polyscribe.operators.lookup import lower_word, sized
from polyscribe.runtime import materialise

DISTANCE, MOST_WEIGHT = 3, 9
#: Entries, and entries times their different characters, up to which a dictionary goes to the words.
DIRECT_ENTRIES, DIRECT_CELLS = 20_000, 4_000_000
#: Characters of an entry that fit an integer; comparisons made at once, few enough for the processor's cache; pairs a batch.
MOST_BITS, AT_ONCE, BATCH_PAIRS = 64, 1 << 16, 100_000


def _pieces(word, count: int):
    """Array of struct(i, at, piece): ``count`` even pieces, the longer ones last."""
    n = F.char_length(word)
    small, long = F.floor(n / count).cast("int"), (n % count).cast("int")

    def piece(i):
        extra = F.greatest(F.lit(0), F.lit(i) - (count - long))
        return F.struct(F.lit(i).alias("i"), (small * i + extra).alias("at"), word.substr(small * i + extra + 1, small + (F.lit(i) >= count - long).cast("int")).alias("piece"))

    return F.array(*[piece(i) for i in range(count)])


def fuzzy_pairs(words: DataFrame, entries: DataFrame, distance: int = DISTANCE, word: str = "word", entry: str = "entry") -> DataFrame:
    """(word, entry, distance): distinct words and entries within an edit distance, equal ones included."""
    # so many tasks whatever the words' bytes, as each word makes many comparisons: a number that is asked for is not made smaller
    tasks = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    left = words.select(F.col(word).alias("word")).filter("word IS NOT NULL").repartition(tasks, "word").distinct()
    right = materialise(entries.select(F.col(entry).alias("entry")).filter("entry IS NOT NULL").distinct(), "entries")
    held = [r["entry"] for r in right.collect()] if right.count() <= DIRECT_ENTRIES else None
    if held is None or len(held) * len(set("".join(held))) > DIRECT_CELLS:
        return _joined(left, right, distance)
    near = left.mapInArrow(_comparing([x for x in held if len(x) <= MOST_BITS], distance), "word string, entry string, distance int")
    if max(map(len, held), default=0) <= MOST_BITS:
        return near
    return near.unionAll(_joined(left.filter(F.char_length("word") > MOST_BITS - distance), right.filter(F.char_length("entry") > MOST_BITS), distance))


def _comparing(entries: list[str], distance: int):
    """What makes batches (word, entry, distance) of batches (word): Myers' bit vectors, an integer a comparison."""
    ordered = sorted(entries, key=len)
    lengths = np.array([len(x) for x in ordered], np.int64)
    letters = np.array([*sorted({ord(c) for x in ordered for c in x}), 0x110000], np.int64)

    def table(m: int):
        """The entries near m characters: the first one's number, their masks and, by character (one more for all others), the bits of their places."""
        a, z = np.searchsorted(lengths, [m - distance, m + distance + 1])
        bits = next(b for b in (8, 16, 32, 64) if b >= max(lengths[a:z], default=0))
        kind = np.dtype(f"u{bits // 8}")
        masks = np.array([(1 << int(n)) - 1 for n in lengths[a:z]], kind)
        places = np.zeros((len(letters) + 1, z - a), kind)
        for e, x in enumerate(ordered[a:z]):
            for at, c in enumerate(np.searchsorted(letters, [ord(c) for c in x])):
                places[c, e] |= kind.type(1 << at)
        return a, masks, places

    def compare(codes, masks, places):
        """The distances of words of one length (rows of letters' numbers) to the entries of a table."""
        n, m = codes.shape
        eq, xv, xh, ph, mh, mv = (np.zeros((n, len(masks)), masks.dtype) for _ in range(6))
        pv = ~mv
        for j in range(m):
            np.take(places, codes[:, j], axis=0, out=eq, mode="clip")
            np.bitwise_or(eq, mv, out=xv)
            np.bitwise_and(eq, pv, out=xh)
            np.add(xh, pv, out=xh)
            np.bitwise_xor(xh, pv, out=xh)
            np.bitwise_or(xh, eq, out=xh)
            np.bitwise_or(xh, pv, out=ph)
            np.invert(ph, out=ph)
            np.bitwise_or(ph, mv, out=ph)
            np.bitwise_and(pv, xh, out=mh)
            np.left_shift(ph, 1, out=ph)
            np.bitwise_or(ph, 1, out=ph)
            np.left_shift(mh, 1, out=mh)
            np.bitwise_or(xv, ph, out=pv)
            np.invert(pv, out=pv)
            np.bitwise_or(pv, mh, out=pv)
            np.bitwise_and(ph, xv, out=mv)
        return m + np.bitwise_count(pv & masks) - np.bitwise_count(mv & masks)

    def near(batches):
        tables, listed = {}, pa.array(ordered, pa.string())
        for batch in batches:
            words = batch.column(0)
            texts = words.to_pylist()
            sizes = np.array([len(x) for x in texts], np.int64)
            found, pairs = [], 0

            def batch_of(found, words=words):
                w, e, d = (np.concatenate(x) for x in zip(*found, strict=True))
                return pa.RecordBatch.from_arrays([words.take(pa.array(w)), listed.take(pa.array(e)), pa.array(d, pa.int32())], names=["word", "entry", "distance"])

            for m in np.unique(sizes).tolist():
                if m not in tables:
                    tables[m] = table(m)
                first, masks, places = tables[m]
                mine = np.flatnonzero(sizes == m)
                step = max(1, AT_ONCE // max(1, len(masks)))
                for start in range(0, len(mine) if len(masks) else 0, step):
                    some = mine[start : start + step]
                    points = np.frombuffer("".join([texts[i] for i in some]).encode("utf-32-le"), np.uint32).astype(np.int64).reshape(len(some), m)
                    codes = np.searchsorted(letters, points)
                    codes[letters[codes] != points] = len(letters)
                    apart = compare(codes, masks, places)
                    w, e = np.divmod(np.flatnonzero(apart <= distance), len(masks))
                    found.append((some[w], first + e, apart[w, e].astype(np.int32)))
                    pairs += len(w)
                    if pairs >= BATCH_PAIRS:
                        yield batch_of(found)
                        found, pairs = [], 0
            if pairs:
                yield batch_of(found)

    return near


def _joined(left: DataFrame, right: DataFrame, distance: int) -> DataFrame:
    """``fuzzy_pairs`` of distinct words and entries by pieces that they share."""
    left = materialise(left, "words").repartition(int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")), "word")
    count = distance + 1
    size = F.char_length("entry")
    long = right.filter(size >= count).select("entry", size.alias("_n"), F.explode(_pieces(F.col("entry"), count)).alias("_p")).select("entry", "_n", F.col("_p.i").alias("_i"), F.col("_p.piece").alias("_piece"))
    # for a word of length m, each entry length n within the distance and each piece i: the places where the piece can stand
    m = F.char_length("word")
    lengths = F.filter(F.sequence(m - distance, m + distance), lambda n: n >= count)
    probes = left.select("word", m.alias("_m"), F.explode(lengths).alias("_n")).select("word", "_m", "_n", F.explode(F.sequence(F.lit(0), F.lit(count - 1))).alias("_i"))
    small, extra = F.floor(F.col("_n") / count).cast("int"), (F.col("_n") % count).cast("int")
    at = small * F.col("_i") + F.greatest(F.lit(0), F.col("_i") - (count - extra))
    width = small + (F.col("_i") >= count - extra).cast("int")
    # left of piece i there are at most i edits if the earlier pieces are all edited; the mirror holds on the right
    shift = F.col("_m") - F.col("_n")
    low = F.greatest(-F.col("_i"), shift - (distance - F.col("_i")))
    high = F.least(F.col("_i"), shift + (distance - F.col("_i")))
    starts = F.filter(F.sequence(at + low, at + high), lambda s: (s >= 0) & (s + width <= F.col("_m")))
    probes = probes.filter(low <= high).select("word", "_n", "_i", F.explode(F.array_distinct(F.transform(starts, lambda s: F.col("word").substr(s + 1, width)))).alias("_piece"))
    near = probes.join(sized(long), ["_n", "_i", "_piece"]).select("word", "entry").distinct()
    found = near.withColumn("distance", F.levenshtein("word", "entry", distance)).filter("distance >= 0")
    # entries shorter than count characters: words of up to count - 1 + distance characters, an equi-join on the length
    short = right.filter(size < count).select("entry", F.explode(F.sequence(F.greatest(F.lit(0), size - distance), size + distance)).alias("_m"))
    few = left.withColumn("_m", m).join(sized(short), "_m").select("word", "entry", F.levenshtein("word", "entry", distance).alias("distance")).filter("distance >= 0")
    return found.unionAll(few)


def weighted_candidates(pairs: DataFrame, rules=EDIT_RULES, most: int = MOST_WEIGHT) -> DataFrame:
    """pairs with the weight of their edit script."""
    return pairs.withColumn("weight", weighted_distance(F.col("word"), F.col("entry"), rules, most))


def best_candidates(weighted: DataFrame, keep: int = 1) -> DataFrame:
    """The lightest candidates of each word, ties by the entry's order (``ord`` if there is one, else the entry).

    One candidate is a minimum with map-side combine; several are the smallest of a sorted, bounded list.
    """
    order = F.struct("weight", *(["ord"] if "ord" in weighted.columns else []), "entry")
    if keep == 1:
        return weighted.groupBy("word").agg(F.min(order).alias("_b")).select("word", "_b.entry", "_b.weight")
    listed = weighted.groupBy("word").agg(F.slice(F.array_sort(F.collect_list(order)), 1, keep).alias("_l"))
    return listed.select("word", F.posexplode("_l").alias("rank", "_b")).select("word", (F.col("rank") + 1).alias("rank"), "_b.entry", "_b.weight")


def candidate_vocabulary(texts: DataFrame, text_col: str = "text", greek: bool = True, cap: int | None = None) -> DataFrame:
    """(word): the distinct cores worth correcting: of the script, not all capitals, not cut by a hyphen, not one character."""
    raw = materialise(texts.select(F.explode(text_tokens(F.col(text_col))).alias("_token")).distinct(), "raw-words")
    cores = raw.select(F.rtrim(T.token_core("_token")).alias("word")).distinct()
    kept = cores.filter(~C.is_uc_word("word") & (F.char_length("word") > 1) & ~F.col("word").endswith("-"))
    return kept.filter(C.is_greek_string("word", cap)) if greek else kept


def transformed(df: DataFrame, column: str, out: str) -> DataFrame:
    """df with the form that is compared: fuzzy normal form with its marks as characters of their own."""
    return df.withColumn(out, U.show_marks(T.preprocess_word_fuzzy(F.col(column))))


def correct_vocabulary(vocab: DataFrame, dictionary: DataFrame, rules=EDIT_RULES, most: int = MOST_WEIGHT, distance: int = DISTANCE) -> DataFrame:
    """(word, best, weight): the corrections of words that are not in the dictionary.

    ``dictionary`` has form (as ``transformed`` makes it), word and, for ties, ord. A word whose form is in the
    dictionary has no candidates; capitalised words without any are tried again in lower case, and the result is capitalised.
    Given are the best of less than ``most`` weight that differ from the word and its lower case.
    """
    forms = dictionary.groupBy("form").agg(F.max_by("word", "ord").alias("entry_word"), F.min("ord").alias("ord"))
    own = transformed(vocab.select("word").distinct(), "word", "form")

    def ranked(asked: DataFrame) -> DataFrame:
        unknown = asked.join(sized(forms.select("form")), "form", "left_anti")
        pairs = fuzzy_pairs(unknown, forms, distance, "form", "form")
        weighted = weighted_candidates(pairs, rules, most).join(sized(forms.select(F.col("form").alias("entry"), "entry_word", "ord")), "entry")
        best = weighted.groupBy("word").agg(F.min_by(F.struct("entry_word", "weight"), F.struct("weight", "ord")).alias("_b"))
        return asked.join(best.select(F.col("word").alias("form"), F.col("_b.entry_word").alias("best"), F.col("_b.weight").alias("weight")), "form", "left")

    first = ranked(own)
    again = F.coalesce(F.col("weight") > most, F.lit(True)) & C.is_capitalized("word")
    lowered = transformed(first.filter(again).select("word", lower_word(F.col("word")).alias("_low")), "_low", "form")
    second = ranked(lowered).filter("best IS NOT NULL").select("word", F.concat(F.upper(F.substring("best", 1, 1)), F.col("best").substr(F.lit(2), F.char_length("best"))).alias("best"), "weight")
    done = first.join(second.select("word"), "word", "left_anti").select("word", "best", "weight").unionByName(second)
    return done.filter((F.col("weight") < most) & (F.col("best") != F.col("word")) & (F.col("best") != lower_word(F.col("word"))))
