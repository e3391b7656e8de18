"""A training-corpus pipeline: quality classifier, line dedup, near-dedup, benchmark decontamination, source mixing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which ``run`` writes as Parquet in the shared folder and
reads back as the next stage's docs. All but the last return the columns of documents.

1. ``quality``: documents that the classifier rejects go. It learns from ``labels``.
2. ``lines``: lines within two edits of an earlier line go; ``text`` and ``n_chars`` follow. A document that loses its
   last word here goes as a whole: its text stands elsewhere.
3. ``near``: of each group of documents linked by a shingle similarity of 0.8 or more, the smallest doc_id stays.
4. ``leaks``: documents that contain an item of ``benchmark`` go.
5. ``mix``: how many words the mix takes from each document that is left.

Defined cases are those of the stages' operators. Rows with a null doc_id pass the first four stages as documents of
their own. Tables may be empty and may have more columns than documents, which go through unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from polyscribe.llm.common import WORD, materialise, table
from polyscribe.llm.op1_lines import line_dedup
from polyscribe.llm.op5_mixing import mix_sources
from polyscribe.llm.op8_neardup import near_duplicates
from polyscribe.llm.op9_decontamination import keep_clean
from polyscribe.llm.op10_quality import keep_good

SIMILARITY = 80


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_good(docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = line_dedup(docs.select(*docs.columns), result_prefix="_line_")
    bare = (F.size("_line_removed") > 0) & ~F.coalesce(F.col("_line_kept"), F.lit("")).rlike(WORD)
    changed = {"text": F.col("_line_kept")}
    if "n_chars" in docs.columns:
        same = F.size("_line_removed") == 0
        changed["n_chars"] = F.when(same, F.col("n_chars")).otherwise(F.char_length("_line_kept").cast(docs.schema["n_chars"].dataType))
    return out.filter(~bare).withColumns(changed).select(*docs.columns)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    copies = near_duplicates(docs, threshold=SIMILARITY).filter(~F.col("kept")).select(F.col("doc_id").alias("_copy")).distinct()
    # the list of copies grows with the documents: never broadcast
    return docs.join(copies.hint("merge"), F.col("doc_id") == F.col("_copy"), "left_anti")


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_clean(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix_sources(docs)


STAGES = [("quality", quality), ("lines", lines), ("near", near), ("leaks", leaks), ("mix", mix)]
#: A trained classifier and a fuzzy join are not expressed in SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
