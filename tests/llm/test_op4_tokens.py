from collections import Counter

import numpy as np
import pytest

from polyscribe.llm.op4_tokens import MOST_BYTES, RULES, VOCABULARY, allocate, encoder, fields_text, section_tokens, token_spans
from tests.llm.helpers import edge_rows, prose, table


def spans(text):
    """Token character spans by decoding every token's bytes."""
    encoding, _ = encoder(open(VOCABULARY, "rb").read())
    at, out = 0, []
    raw = text.encode()
    owner = [i for i, c in enumerate(text) for _ in c.encode()]
    for t in encoding.encode_ordinary(text):
        n = len(encoding.decode_single_token_bytes(t))
        out.append((owner[at], owner[at + n - 1] + 1))
        at += n
    assert at == len(raw)
    return out


def brute(text, rule):
    starts = [0] + [i + 1 for i, c in enumerate(text) if c == "\n" and i + 1 < len(text)]
    stops = [*starts[1:], len(text)]
    tokens = Counter()
    for a, b in spans(text):
        share = [max(0, min(b, y) - max(a, x)) for x, y in zip(starts, stops, strict=True)]
        if rule == "first":
            tokens[next(i for i, s in enumerate(share) if s)] += 1
        elif rule == "majority":
            tokens[share.index(max(share))] += 1
        else:
            for i, s in enumerate(share):
                tokens[i] += s / (b - a)
    return [(i, x, y, tokens[i]) for i, (x, y) in enumerate(zip(starts, stops, strict=True))]


TEXTS = ["one line only", "a\nb\n\n\n\nc d\n", "\n\n\n", "  \n  x", "tab\tand 日本語 text\n\n😀😀\nmore", prose(1, 400).replace(" w1", "\nw1"), "\n" * 50 + "end"]


@pytest.mark.parametrize("rule", RULES)
def test_brute_force(spark, rule):
    got = section_tokens(table(spark, list(enumerate(TEXTS))), rule=rule).collect()
    for k, text in enumerate(TEXTS):
        rows = sorted((r["section"], r["start_char"], r["end_char"], round(r["tokens"], 6)) for r in got if r["doc_id"] == k)
        assert rows == [(i, x, y, round(n, 6)) for i, x, y, n in brute(text, rule)]
        assert abs(sum(r["tokens"] for r in got if r["doc_id"] == k) - len(spans(text))) < 1e-6


def test_allocation_of_crossing_tokens():
    first, end = np.array([0, 2, 5]), np.array([2, 7, 9])
    starts = np.array([0, 3, 4, 8])
    assert allocate(first, end, starts, 9, "first")[0].tolist() == [2, 0, 1, 0]
    assert allocate(first, end, starts, 9, "majority")[0].tolist() == [1, 0, 2, 0]
    assert allocate(first, end, starts, 9)[1].tolist() == [1, 1, 2, 1]


def test_fields(spark):
    rows = spark.createDataFrame([(1, "Title", None, "Body text"), (2, None, None, None)], "doc_id long, a string, b string, c string")
    made = fields_text(rows, ["a", "b", "c"])
    assert [tuple(r) for r in made.orderBy("doc_id").select("text", "starts").collect()] == [("Title\nBody text\n", [0, 6]), ("", [])]
    got = section_tokens(made, starts_col="starts").collect()
    assert sorted((r["doc_id"], r["section"], r["start_char"], r["end_char"]) for r in got) == [(1, 0, 0, 6), (1, 1, 6, 16), (2, 0, 0, 0)]


def test_edges(spark):
    got = section_tokens(table(spark, edge_rows())).collect()
    assert {(r["section"], r["tokens"]) for r in got if r["doc_id"] == 2} == {(0, 0.0)}
    assert len([r for r in got if r["doc_id"] == 7]) == 2
    assert section_tokens(table(spark, [])).count() == 0
    with pytest.raises(ValueError):
        section_tokens(table(spark, []), rule="other")
    assert MOST_BYTES > 1_000_000
