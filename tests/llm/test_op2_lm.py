from collections import Counter
from math import isclose, log10

from polyscribe.llm import common
from polyscribe.llm.op2_lm import SQL, lm_scores, op2_lm
from tests.llm.helpers import edge_rows, prose, table, words
from tests.oracle import compare


def brute(rows):
    texts = [words(t) for _, t in rows]
    grams = lambda w, n: Counter(tuple(w[i : i + n]) for i in range(len(w) - n + 1))
    every = [sum((grams(w, n) for w in texts), Counter()) for n in (1, 2, 3)]
    total, out = sum(map(len, texts)), []
    for w in texts:
        c = [Counter({k: v - own[k] for k, v in e.items() if v > own[k]}) for e, own in zip(every, (grams(w, n) for n in (1, 2, 3)), strict=True)]
        rest, score = max(total - len(w), 1), 0.0
        for i in range(len(w)):
            penalty = 0
            for n in (3, 2):
                if i >= n - 1:
                    g = tuple(w[i - n + 1 : i + 1])
                    if c[n - 1][g]:
                        score += log10(c[n - 1][g] / c[n - 2][g[:-1]]) + penalty * log10(0.4)
                        break
                    penalty += 1
            else:
                one = c[0][(w[i],)]
                score += (log10(one / rest) if one else log10(0.4) - log10(rest)) + penalty * log10(0.4)
        out.append((len(w), score))
    return out


def test_more_shards_than_routes(spark, monkeypatch):
    """Blocks and shards that meet in a middle step give the same scores."""
    rows = [(i, prose(i % 7, 60, 40) + " " + prose(i, 30, 30)) for i in range(25)] + [(90, "lonely"), (91, "")]
    one = sorted(tuple(r) for r in lm_scores(table(spark, rows)).collect())
    monkeypatch.setattr(common, "FAN_OUT", 3)
    assert common.shards_for(96_000_000, 4_000_000) == (3, 8)
    assert sorted(tuple(r) for r in lm_scores(table(spark, rows, 6)).collect()) == one


def test_brute_force(spark):
    rows = [(i, prose(i % 7, 60, 40) + " " + prose(i, 30, 30)) for i in range(25)] + [(90, "lonely"), (91, "")]
    got = {r["doc_id"]: r for r in lm_scores(table(spark, rows)).collect()}
    for (doc, _), (n, score) in zip(rows, brute(rows), strict=True):
        assert got[doc]["n_words"] == n and isclose(got[doc]["log_score"], score, abs_tol=1e-6)
        assert (got[doc]["mean_log_score"] is None) == (n == 0)


def test_common_text_scores_higher(spark):
    rows = [(i, prose(1, 50)) for i in range(20)] + [(100, prose(777, 50, 10**6))]
    got = {r["doc_id"]: r["mean_log_score"] for r in lm_scores(table(spark, rows)).collect()}
    assert got[0] > got[100] + 1


def test_edges(spark):
    rows = edge_rows()
    out = lm_scores(table(spark, rows))
    assert sorted(r["n_words"] for r in out.collect()) == sorted(len(words(t)) for _, t in rows)
    assert lm_scores(table(spark, [])).count() == 0
    assert lm_scores(table(spark, [(1, "alone here")])).first()["unseen"] == 2


def test_sql(spark, data):
    compare(op2_lm(spark, data), SQL, data)
