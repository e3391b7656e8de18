"""Token counts of sections: encode whole documents once, attribute tokens through their character spans.

A document is encoded in one call by a byte-level BPE vocabulary, so merges see the text as a model would. The tokens'
byte lengths, summed, give their spans; a span's characters run from the one that its first byte belongs to, to the
one of its last byte. Sections (lines, or the fields that a text was put together from) are spans too, and the two
sorted lists meet in an interval join by binary search.

A token that crosses a boundary is allocated by a rule. ``majority``: to the section with most of its characters, the
earlier one on ties. ``first``: to the section of its first character. ``share``: to all by their share of its
characters. Under each rule a document's sections sum to its number of tokens exactly (``share``: up to rounding).

Defined cases. Null or empty text: one section 0 of no characters and no tokens. Sections hold at least one character, so
a line feed at the end opens no section. Null ids stay null; rows that repeat an id give their rows again. Null fields
of a text put together are empty and have no section. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from polyscribe.llm.common import table

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The published pre-tokenisation pattern of that vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: A vocabulary file is sent to every executor; a larger one is refused.
MOST_BYTES = 64_000_000
RULES = ("majority", "first", "share")
_encoders: dict[int, tuple] = {}


def encoder(data: bytes, pattern: str = PATTERN) -> tuple:
    """(encoding, byte length of every token id) of a rank file, kept for the life of the Python process."""
    key = hash((data, pattern))
    if key not in _encoders:
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in data.splitlines() if x)}
        lengths = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            lengths[rank] = len(token)
        _encoders[key] = tiktoken.Encoding("vocabulary", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), lengths
    return _encoders[key]


def token_spans(text: str, raw: np.ndarray, coder: tuple) -> tuple[np.ndarray, np.ndarray]:
    """First and end character of every token of a text; characters split between tokens belong to each."""
    encoding, lengths = coder
    tokens = np.asarray(encoding.encode_to_numpy(text, disallowed_special=()), np.int64)
    ends = np.cumsum(lengths[tokens])
    if (int(ends[-1]) if len(ends) else 0) != len(raw):
        raise ValueError("the vocabulary does not cover the text byte for byte")
    begins = ends - lengths[tokens]
    # characters begun up to and including each byte
    begun = np.cumsum((raw & 0xC0) != 0x80)
    return begun[begins] - 1 if len(ends) else begins, begun[ends - 1] if len(ends) else ends


def allocate(first: np.ndarray, end: np.ndarray, starts: np.ndarray, size: int, rule: str = "majority") -> tuple[np.ndarray, np.ndarray]:
    """(tokens, crossing) of each section, sections being [starts[i], starts[i + 1]) and the last one up to ``size``."""
    n = len(starts)
    low = np.searchsorted(starts, first, "right") - 1
    high = np.searchsorted(starts, end - 1, "right") - 1
    crosses = low < high
    tokens = np.bincount(low[~crosses] if rule != "first" else low, minlength=n).astype(np.float64)
    a, b = low[crosses], high[crosses]
    many = b - a + 1
    which = np.repeat(np.arange(len(a)), many)
    section = np.repeat(a - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(many.sum()) if len(a) else a
    stops = np.append(starts[1:], size)
    overlap = np.minimum(end[crosses][which], stops[section]) - np.maximum(first[crosses][which], starts[section])
    crossing = np.bincount(section, minlength=n)
    if rule == "share" and len(a):
        tokens += np.bincount(section, overlap / (end - first)[crosses][which], minlength=n)
    elif rule == "majority" and len(a):
        order = np.lexsort((section, -overlap, which))
        best = order[np.concatenate([[True], which[order][1:] != which[order][:-1]])]
        tokens += np.bincount(section[best], minlength=n)
    return tokens, crossing


def line_starts(raw: np.ndarray) -> np.ndarray:
    """The first character of every line; a line keeps its line feed."""
    begun = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    at = np.concatenate([[0], np.flatnonzero(raw == 10) + 1])
    return begun[at[at < len(raw)]] if len(raw) else np.zeros(1, np.int64)


FIELDS = [("doc_id", pa.int64()), ("section", pa.int32()), ("start_char", pa.int64()), ("end_char", pa.int64()), ("tokens", pa.float64()), ("crossing", pa.int64()), ("doc_tokens", pa.int64())]


def section_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", starts_col: str | None = None, rule: str = "majority", vocabulary: str = VOCABULARY, pattern: str = PATTERN) -> DataFrame:
    """Per section: doc_id, section, start_char, end_char, tokens, crossing (tokens that share it with another), doc_tokens.

    Sections are lines, or begin at the characters (ascending from 0, an array) in ``starts_col``.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    with open(vocabulary, "rb") as file:
        data = file.read(MOST_BYTES + 1)
    if len(data) > MOST_BYTES:
        raise ValueError("the vocabulary file is too large to broadcast")
    sent = docs.sparkSession.sparkContext.broadcast(data)

    def compute(batches):
        coder = encoder(sent.value, pattern)
        schema = pa.schema(FIELDS)
        for batch in batches:
            out, held = [[] for _ in FIELDS], 0
            for i in range(batch.num_rows):
                doc, text = batch.column(0)[i].as_py(), batch.column(1)[i].as_py() or ""
                raw = np.frombuffer(text.encode(), np.uint8)
                first, end = token_spans(text, raw, coder)
                starts = line_starts(raw) if starts_col is None else np.unique(np.array([x for x in batch.column(2)[i].as_py() or [] if 0 <= x < max(len(text), 1)] + [0], np.int64))
                tokens, crossing = allocate(first, end, starts, len(text), rule)
                n = len(starts)
                for k, v in enumerate(([doc] * n, np.arange(n), starts, np.append(starts[1:], len(text)), tokens, crossing, np.full(n, len(first)))):
                    out[k].append(v)
                held += n
                if held >= 20_000 or i == batch.num_rows - 1:
                    ids = pa.array([x for v in out[0] for x in v], pa.int64())
                    yield pa.RecordBatch.from_arrays([ids, *(pa.array(np.concatenate(v)).cast(t) for v, (_, t) in zip(out[1:], FIELDS[1:], strict=True))], schema=schema)
                    out, held = [[] for _ in FIELDS], 0

    columns = [F.col(id_col).cast("long"), F.col(text_col).cast("string"), *([F.col(starts_col).cast("array<long>")] if starts_col else [])]
    return docs.select(*columns).mapInArrow(compute, "doc_id long, section int, start_char long, end_char long, tokens double, crossing long, doc_tokens long")


def fields_text(rows: DataFrame, fields: list[str], separator: str = "\n", text_col: str = "text", starts_col: str = "starts") -> DataFrame:
    """Rows with the fields joined to one text and the character at which each non-empty one begins (it keeps its separator)."""
    parts = [F.coalesce(F.col(x).cast("string"), F.lit("")) for x in fields]
    parts = [F.when(p != "", F.concat(p, F.lit(separator))).otherwise(F.lit("")) for p in parts]
    lengths = [F.char_length(p) for p in parts]
    begins = [sum(lengths[:i], F.lit(0)).cast("long") for i in range(len(parts))]
    starts = F.filter(F.array(*[F.when(n > 0, b) for b, n in zip(begins, lengths, strict=True)]), lambda x: x.isNotNull())
    return rows.withColumn(text_col, F.concat(*parts)).withColumn(starts_col, starts)


def op4_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every line of every document; the majority rule gives whole numbers."""
    return section_tokens(table(spark, sf_dir, "documents")).withColumn("tokens", F.col("tokens").cast("long"))
