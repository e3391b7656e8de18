"""Volume metadata: JSON items to one XML record each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from polyscribe.operators.words import file_identifier

ITEMS = "items array<struct<htid string, enumcron string>>, records map<string, struct<titles array<string>, publishers array<string>>>"


def explode_items(responses: DataFrame, column: str = "json") -> DataFrame:
    """htid and enumcron of every item of JSON responses; malformed JSON has none."""
    parsed = responses.withColumn("_j", F.from_json(column, "items array<struct<htid string, enumcron string>>"))
    return parsed.select(F.explode("_j.items").alias("_i")).select("_i.htid", "_i.enumcron")


def metadata_xml(items: DataFrame, resolution: int = 300) -> DataFrame:
    """(identifier, xml) of rows with htid, enumcron, title, creator, publisher; nulls become empty elements."""
    fields = {"publisher": "publisher", "identifier": "htid", "title": "title", "creator": "creator", "volume": "enumcron"}
    text = lambda c: F.replace(F.replace(F.replace(F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    parts = [F.concat(F.lit(f"<{tag}>"), file_identifier(text(c)) if tag == "identifier" else text(c), F.lit(f"</{tag}>")) for tag, c in fields.items()]
    return items.select(file_identifier(F.col("htid")).alias("identifier"), F.concat(F.lit("<metadata>"), *parts, F.lit(f"<ppi>{resolution}</ppi></metadata>")).alias("xml"))
