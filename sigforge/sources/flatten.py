"""Records of public sources as (product, ingredient, unii), and pairs from text cells."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def label_pairs(records: DataFrame) -> DataFrame:
    """Every brand with every substance; the UNII is that at the substance's place, null past the end. (brands, substances, uniis: arrays)"""
    rows = records.select(F.explode("brands").alias("product"), "substances", "uniis").select("product", "uniis", F.posexplode("substances").alias("at", "ingredient"))
    return rows.select("product", "ingredient", F.get("uniis", F.col("at")).alias("unii"))


def declared_parts(records: DataFrame, product: str, ingredients: str, count: str) -> DataFrame:
    """The parts between slashes if there are as many as declared, else the whole text as one ingredient."""
    parts = F.transform(F.split(F.regexp_replace(ingredients, r"\s+", " "), "/"), lambda x: F.trim(x))
    return records.select(F.col(product).alias("product"), F.explode(F.when(F.size(parts) == F.col(count), parts).otherwise(F.array(F.trim(ingredients)))).alias("ingredient")).filter("ingredient <> ''")


def semicolon_parts(records: DataFrame, product: str, ingredients: str) -> DataFrame:
    parts = F.filter(F.transform(F.split(ingredients, ";"), lambda x: F.trim(x)), lambda p: (p != "") & (F.upper(p) != "NA"))
    return records.select(F.col(product).alias("product"), F.explode(parts).alias("ingredient"))


def explode_pairs(rows: DataFrame, least: int = 3) -> DataFrame:
    """Distinct (product, signal) of cells that list several, separated by semicolons or line feeds; shorter signals go."""
    split = lambda c, n: F.filter(F.transform(F.split(c, "[;\n]"), lambda x: F.trim(x)), lambda x: F.length(x) >= n)
    return rows.select(F.explode(split("product", 1)).alias("product"), "signal").select("product", F.explode(split("signal", least)).alias("signal")).distinct()
