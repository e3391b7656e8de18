import pytest

from polyscribe.functions import similarity as S
from polyscribe.operators import fuzzy as Z
from polyscribe.plans import catalog
from tests.oracle import compare

ROWS_ONLY = set(catalog.QUERIES) - set(catalog.SQL)


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_query_equals_its_sql(spark, data, name):
    compare(catalog.QUERIES[name](spark, data), catalog.SQL[name], data)


@pytest.mark.parametrize("name", sorted(ROWS_ONLY))
def test_query_without_sql_runs(spark, data, name):
    assert catalog.QUERIES[name](spark, data).count() > 0


def test_entry_module(spark, data):
    import __spark_entry__ as e

    assert set(catalog.QUERIES) <= set(e.queries())
    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).columns == ["mode", "n", "biomass"]


def test_fuzzy_queries_take_accented_short_and_marked_words(spark, tmp_path):
    spark.createDataFrame([(1, "«Λόγοσ, déjà (Vu) word, to."), (2, "λόγον 12 ... été; Wort! él"), (3, None)], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, "λόγος dejà vu. été,"), (2, "(words) tó ét λόγων")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    words, entries = {"λόγοσ", "déjà", "vu", "word", "to", "λόγον", "été", "wort", "él"}, {"λόγος", "dejà", "vu", "été", "words", "tó", "ét", "λόγων"}
    d = lambda x, y: len(S.edit_script(x, y))
    best = {}
    for w in words:
        near = [(S.edit_weight(w, e), e) for e in entries if 0 < d(w, e) <= Z.DISTANCE]
        if near:
            weight, e = min(near)
            best[w] = (e, weight)
    assert {r["word"]: (r["entry"], r["weight"]) for r in catalog.QUERIES["weighted_best"](spark, str(tmp_path)).collect()} == best
    ratios = {(a, b): round(S.marked_ratio(a, b), 6) for a in entries for b in entries if d(a, b) <= 2}
    assert {(r["word"], r["entry"]): r["ratio"] for r in catalog.QUERIES["lev_ratio"](spark, str(tmp_path)).collect()} == ratios
