"""The default one-character substitutions of the correction cascade."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# What is misread (from) and what it may stand for (to, in the order tried); of all rules the last that holds counts.
SUBSTITUTIONS = [
    ("d", "ὅ ό"), ("δ", "ὅ ὀ ό ὄ ὁ ό ο d"), ("ῖ", "ὶ"), ("Τ", "Υ"), ("ἶ", "ἷ"), ("ἷ", "ἶ"), ("T", "Υ"),
    ("l", "I ί ἰ ἱ Ἰ ἴ i ι"), ("A", "Α Ἀ Ἁ Λ"), ("3", "Β B"), ("7", "Τ ί Γ T"), ("Ε", "E Ἐ"), ("Α", "A Ἀ Δ"),
    ("Ἀ", "Ἄ Ἁ"), ("Δ", "Ἀ Α"), ("α", "z ο a σ"), ("β", "ἵ ῆ ἐ θ ψ"), ("ἐ", "ἑ ἔ ἔ έ"), ("ἀ", "ἁ ἅ ἂ ἄ"),
    ("ἁ", "ἀ"), ("ἅ", "ἄ ἂ"), ("ἄ", "θ ἀ ἁ"), ("ὰ", "ἄ ἂ t ἀ ᾶ"), ("ά", "ἀ ἄ ἁ ό"), ("ᾶ", "ᾷ ἆ"),
    ("ἔ", "ἕ"), ("ε", "ὲ ἐ e s"), ("ἐ", "ἑ"), ("ἑ", "ἐ"), ("έ", "ἐ ἑ"), ("ἱ", "ἰ ἷ"),
    ("ἴ", "ἷ ἵ"), ("ἰ", "ἱ ἴ ὶ ί"), ("ὶ", "ἱ i"), ("ι", "ἰ ἱ ὶ ί i"), ("ἠ", "ἡ"), ("ἡ", "ἠ ἧ"),
    ("ῆ", "ὴ ἧ ῇ ή"), ("ἤ", "ἥ"), ("ὴ", "ή"), ("ή", "ὴ ῆ"), ("θ", "ﬁ"), ("δ", "θ"),
    ("ο", "ὸ c o σ"), ("ὀ", "ὁ"), ("ὁ", "ὀ"), ("ό", "ὁ ὀ"), ("ὸ", "b ὁ δ"), ("ὅ", "ὄ"),
    ("ϲ", "c"), ("λ", "ἵ"), ("ῦ", "ὺ"), ("v", "v"), ("v", "ν υ"), ("Τ", "Ἰ Ἴ T Γ Υ"),
    ("Z", "Ζ"), ("Ἰ", "Ἴ Ἵ Ἱ"), ("Ὁ", "Ὅ"), ("Κ", "Χ K"), ("Λ", "Α Δ A"), ("Μ", "M"),
    ("Π", "Β"), ("Χ", "X"), ("Ὡ", "Ὠ"), ("ή", "ἡ"), ("ῇ", "ᾗ ᾖ"), ("ἡ", "ἥ"),
    ("ἤ", "ἥ"), ("ῃ", "η"), ("η", "ή ῃ"), ("κ", "x"), ("ὕ", "ὔ"), ("ὔ", "ὕ"),
    ("ρ", "ῥ p"), ("ς", "s"), ("σ", "κ"), ("ϲ", "ς"), ("τ", "r x"), ("φ", "ρ"),
    ("t", "λ ι ῖ ἰ ἱ ί"), ("ύ", "ὐ ὑ ό"), ("ὐ", "ύ ὑ"), ("ὑ", "ὐ"), ("ώ", "ῴ"), ("ῶ", "ὧ ώ"),
    ("ὧ", "ὡ"), ("ὠ", "ὡ"), ("ὡ", "ὠ ὼ"), ("D", "Π Β Ο U"), ("B", "Β"), ("E", "Ε Ἐ F"),
    ("Ε", "E Ἐ Ἑ"), ("Ἐ", "Ἑ Ἔ"), ("B", "H"), ("H", "Π Η Ἡ Ἡ"), ("I", "Ι J l Π"), ("J", "I"),
    ("K", "Κ"), ("M", "Μ"), ("N", "Ν"), ("O", "Ο 0"), ("0", "O Ο"), ("P", "Ῥ Ρ"),
    ("Ρ", "Ῥ"), ("R", "H"), ("Q", "O"), ("T", "Τ Γ"), ("X", "Χ T"), ("Z", "Ζ"),
    ("a", "α e n s u"), ("b", "h"), ("æ", "œ"), ("œ", "æ"), ("c", "e o q ϲ"), ("e", "c o ε"),
    ("f", "i l ﬀ"), ("g", "y"), ("ﬀ", "ﬁ"), ("ﬁ", "ﬂ"), ("ﬀi", "fﬁ"), ("h", "b t"),
    ("i", "l ι ἱ ἰ"), ("m", "n"), ("l", "t ﬂ i"), ("u", "n o ν"), ("n", "u m a"), ("o", "ο q c"),
    ("p", "q ρ"), ("q", "c p"), ("r", "t v τ"), ("s", "ς"), ("t", "i r l"), ("v", "y r u æ ν"),
    ("x", "z"), ("y", "γ"), ("fi", "ﬁ"), ("ﬁ", "f"), ("ae", "æ"), ("τ", "ι"),
    ("s", "a n e"), ("1", "ί"), ("1", "l i I"), ("8", "s"),
]


def default_rules(spark: SparkSession) -> DataFrame:
    """(ord, from, to) of the table, in order."""
    pairs = [(a, b) for a, many in SUBSTITUTIONS for b in many.split(" ")]
    return spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "ord int, from string, to string")
