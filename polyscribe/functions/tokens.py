"""Token splitting, word normalisation and repair patterns as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from polyscribe.functions import unicode as U

# The patterns and characters that define tokens and repairs.
SUPERSCRIPTS = r"²³¹⁰⁴-⁹"
TOKEN = r"(?s)^([\p{Nd}" + SUPERSCRIPTS + r"·»«„*\[(\"〈,\-.?’|‖“⟨]*)(.*?)([⟩”«»„.,!?;†·:〉'()\p{Nd}\]\[|" + SUPERSCRIPTS + r"]*)$"
ELIDED = r"^’([I1ΙιΕEAP])(.*)$"
APOSTROPHE, TYPEWRITER = "’", "'"
PSILI, PERISPOMENI, CIRCUMFLEX, KORONIS, MODIFIER = "̓", "͂", "̂", "᾽", "ʼ"
LIGATURES = [("ae", "æ"), ("ff", "ﬀ"), ("oe", "œ"), ("fl", "ﬂ"), ("fi", "ﬁ")]
SPLIT_MARKS = r".,·;’〉〈\[\])("
NUMERAL = r"^([·«„\[(\"〈]*)([I\p{Nd}" + SUPERSCRIPTS + r"]*?)([«»„.,!?;†·:〉)\]]*)$"
GREEK_NUMERAL = "^[αβγδεϚϜξιηθικλμνοπϞϘρστυφχψωϠΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ]{1,2}′$"
LATIN_SUFFIXES = ["que", "ne", "ve"]
LINE_GAP = r"[)(;><.\s]+"


def _col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def split_text_token(x: Column | str) -> Column:
    """struct(pre, core, post): outer punctuation and digits taken off. Strings that do not match are all core."""
    x = _col(x)
    parts = [F.regexp_extract(x, TOKEN, i) for i in (1, 2, 3)]
    ok = x.rlike(TOKEN)
    return F.when(
        x.isNotNull(),
        F.struct(F.when(ok, parts[0]).otherwise("").alias("pre"), F.when(ok, parts[1]).otherwise(x).alias("core"), F.when(ok, parts[2]).otherwise("").alias("post")),
    )


def token_core(x: Column | str) -> Column:
    x = _col(x)
    return F.when(x.rlike(TOKEN), F.regexp_extract(x, TOKEN, 2)).otherwise(x)


def _unspaced(x: Column, apostrophe: str) -> Column:
    x = F.replace(x, F.lit(" "), F.lit(""))
    return F.regexp_replace(x, ELIDED.replace("’", apostrophe), f"$1{PSILI}$2")


def fold_apostrophes(x: Column | str) -> Column:
    """The Column part of preprocess_word: spaces, elision, circumflex and apostrophes; composition is left out."""
    x = _unspaced(_col(x), APOSTROPHE)
    return F.translate(x, CIRCUMFLEX + KORONIS + MODIFIER + TYPEWRITER, PERISPOMENI + APOSTROPHE * 3)


def preprocess_word(x: Column | str) -> Column:
    """The dictionary path's normal form: one apostrophe (U+2019), NFC."""
    return U.with_ascii_shortcut(fold_apostrophes(x), lambda c: U.normalize(c, "NFC"))


def preprocess_word_fuzzy(x: Column | str) -> Column:
    """The fuzzy path's normal form: one apostrophe (U+0027), NFD, interior punctuation removed."""
    x = _unspaced(_col(x), TYPEWRITER)
    x = F.translate(x, CIRCUMFLEX + KORONIS + APOSTROPHE, PERISPOMENI + TYPEWRITER * 2)
    return F.regexp_replace(U.with_ascii_shortcut(x, lambda c: U.normalize(c, "NFD")), r"(?<!^)[·.,'](?!$)", "")


def dictionary_key(x: Column | str) -> Column:
    """The key under which a word is looked up: its core with U+2019 for U+0027."""
    return F.translate(token_core(x), TYPEWRITER, APOSTROPHE)


def lower_key(x: Column | str) -> Column:
    """dictionary_key in lower case, without the final-sigma rule."""
    return F.lower(F.translate(dictionary_key(x), "Σ", "σ"))


def make_ligatures(x: Column | str) -> Column:
    x = _col(x)
    for plain, ligature in LIGATURES:
        x = F.replace(x, F.lit(plain), F.lit(ligature))
    return x


def find_occurrences(x: Column | str, character: str) -> Column:
    """All positions (from 0) of a character."""
    x = _col(x)
    return F.filter(F.sequence(F.lit(0), F.char_length(x) - 1), lambda i: (F.char_length(x) > 0) & (x.substr(i + 1, F.lit(1)) == character))


def split_on_punctuation(x: Column | str) -> Column:
    """struct(a, mark, b) where x has exactly one splitting mark, else null."""
    x = _col(x)
    pattern = f"^([^{SPLIT_MARKS}]*)([{SPLIT_MARKS}])([^{SPLIT_MARKS}]*)$"
    return F.when(x.rlike(pattern), F.struct(*[F.regexp_extract(x, pattern, i).alias(n) for i, n in ((1, "a"), (2, "mark"), (3, "b"))]))


def split_after(x: Column | str, terminal: str = "ς") -> Column:
    """Pieces of x cut after every terminal character."""
    return F.split(_col(x), f"(?<=[{terminal}])", -1)


def repair_numeral(x: Column | str) -> Column:
    """Digits misread as I put right, where the word is a numeral in punctuation (or punctuation alone); else null."""
    x = _col(x)
    parts = [F.regexp_extract(x, NUMERAL, i) for i in (1, 2, 3)]
    return F.when(x.rlike(NUMERAL), F.concat(parts[0], F.translate(parts[1], "I", "1"), parts[2]))


def greek_numeral(x: Column | str) -> Column:
    """The numeral with a true prime sign, where the word is one; else null."""
    primed = F.translate(_col(x), "ʹ", "′")
    return F.when(primed.rlike(GREEK_NUMERAL), primed)


def collapse_repeats(x: Column | str) -> Column:
    """Runs of a character become one."""
    return F.regexp_replace(_col(x), r"(?s)(.)\1+", "$1")


def line_tokens(x: Column | str) -> Column:
    """The tokens of a line, between gaps of blanks and brackets."""
    return F.filter(F.split(_col(x), LINE_GAP, -1), lambda t: t != "")


def chunks(x: Column | str, n: int) -> Column:
    """An array in pieces of n entries, the last one with what is left."""
    x = _col(x)
    return F.when(F.size(x) > 0, F.transform(F.sequence(F.lit(1), F.size(x), F.lit(n)), lambda i: F.slice(x, i, n))).when(x.isNotNull(), F.array().cast("array<array<string>>"))


def windows(x: Column | str, n: int) -> Column:
    """Every n consecutive entries of an array."""
    x = _col(x)
    return F.when(F.size(x) >= n, F.transform(F.sequence(F.lit(1), F.size(x) - n + 1), lambda i: F.slice(x, i, n))).when(x.isNotNull(), F.array().cast("array<array<string>>"))


def window_count(x: Column | str, n: int) -> Column:
    """How many ``windows`` there are, without making them."""
    return F.greatest(F.size(_col(x)) - (n - 1), F.lit(0))


def halves(x: Column | str) -> Column:
    """The pairs tried when a word may be two: array of struct(a, b), in order, for words of ten or more characters.

    Left of the middle and right of it in turn: len//2 - p + 1, then len//2 + p, for p from 1 to len//2 - 4.
    """
    x = _col(x)
    n = F.char_length(x)
    half = F.floor(n / 2).cast("int")
    cut = lambda at: F.struct(x.substr(F.lit(1), at).alias("a"), x.substr(at + 1, n).alias("b"))
    tried = F.flatten(F.transform(F.sequence(F.lit(1), half - 4), lambda p: F.array(cut(half - p + 1), cut(half + p))))
    return F.when(half >= 5, tried).otherwise(F.array().cast("array<struct<a:string,b:string>>"))
