"""Nested catalogue documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.schemas import CATALOGUE_JSON


def flatten_catalogue(docs: DataFrame, json: str = "json") -> DataFrame:
    """JSON documents {champion id: {name, skins: [{num, name}]}} as flat rows."""
    return (
        docs.select(F.explode(F.from_json(F.col(json), CATALOGUE_JSON)).alias("champion_id", "c"))
        .select("champion_id", F.col("c.name").alias("champion_name"), F.explode("c.skins").alias("s"))
        .select(
            "champion_id",
            "champion_name",
            F.col("s.num").alias("skin_num"),
            F.col("s.name").alias("skin_name"),
        )
    )
