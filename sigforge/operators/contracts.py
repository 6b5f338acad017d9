"""Data contracts: frames of violating rows, empty where the contract holds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import from_set

STATUSES = ("확정", "보류", "미해결", "수기")


def set_format(rows: DataFrame, column: str = "ingredient_set") -> DataFrame:
    """Sets that aren't lower case, have spaces beside | or empty parts."""
    s = F.col(column)
    return rows.select(s).distinct().filter((s != "") & ((s != F.lower(s)) | s.rlike(r"(^|[|])( |$)| ([|]|$)|[|][|]")))


def set_sorted(rows: DataFrame, column: str = "ingredient_set") -> DataFrame:
    return rows.select(column).distinct().filter((F.col(column) != "") & (F.array_join(F.array_sort(from_set(F.col(column))), "|") != F.col(column)))


def unii_length(rows: DataFrame, column: str = "unii") -> DataFrame:
    return rows.filter(~F.length(column).isin(0, 10))


def date_format(rows: DataFrame, column: str = "fda_dt") -> DataFrame:
    return rows.filter(~F.col(column).rlike("^[0-9]{8}$"))


def grain_unique(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def marginals(scores: DataFrame) -> DataFrame:
    return scores.filter("a > ab OR a > ac")


def fractions(features: DataFrame) -> DataFrame:
    outside = F.lit(False)
    for c in ("death_frac", "serious_frac", "dechal_frac", "rechal_frac", "recency"):
        outside = outside | (F.col(c) < 0) | (F.col(c) > 1)
    return features.filter(outside | (F.col("death_frac") > F.col("serious_frac")) | (F.col("dechal_known_n") > F.col("a")) | (F.col("rechal_known_n") > F.col("a")))


def aligned(scores: DataFrame, features: DataFrame) -> DataFrame:
    """Pairs on one side only or with another number of cases."""
    s, f = scores.select("ingredient", "pt", F.col("a").alias("a_scores")), features.select("ingredient", "pt", F.col("a").alias("a_features"))
    return s.join(f, ["ingredient", "pt"], "full").filter(~F.col("a_scores").eqNullSafe(F.col("a_features")))


def resolved_has_ingredient(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("resolution_status").isin("확정", "수기") & (F.coalesce("resolved_ingredient_set", F.lit("")) == ""))


def accepted(rows: DataFrame, column: str, values=STATUSES) -> DataFrame:
    return rows.filter(~F.col(column).isin(*values))


def related(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    return child.join(parent.select(key).distinct(), key, "left_anti")


def columns(rows: DataFrame, types: dict[str, str], not_null: tuple[str, ...] = (), unique: tuple[str, ...] = ()) -> list[str]:
    """What breaks the declared types, null and uniqueness rules, in words; nulls are counted in one pass."""
    out = [f"{c}: {dict(rows.dtypes).get(c, 'missing')} instead of {t}" for c, t in types.items() if dict(rows.dtypes).get(c) != t]
    if not_null:
        nulls = rows.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in not_null)).first()
        out += [f"{c}: {nulls[c]} nulls" for c in not_null if nulls[c]]
    return out + [f"{c}: not unique" for c in unique if not grain_unique(rows.filter(F.col(c).isNotNull()), c).isEmpty()]
