"""The driver's tables as frames of the safety domain: reports, products, reactions, outcomes, names.

Orders are report versions (two to a case), line items are products in a report, the nation of a
line's supplier is the reaction, the order's priority the outcome. A part's name and type are the free-text name;
large parts aren't resolved, promotional and small ones have one ingredient, the others two.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def demo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """primaryid, caseid, caseversion, fda_dt (yyyyMMdd)."""
    return read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("primaryid"), F.expr("o_orderkey div 2").alias("caseid"),
        (F.col("o_orderkey") % 2 + 1).cast("int").alias("caseversion"), F.date_format("o_orderdate", "yyyyMMdd").alias("fda_dt"),
    )


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = read(spark, sf_dir, "part").select("p_partkey", F.concat_ws(" ", "p_name", "p_type").alias("drugname"))
    lines = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_returnflag", "l_linestatus")
    return lines.join(part, lines["l_partkey"] == part["p_partkey"])


def _role():
    return F.when(F.col("l_returnflag") == "R", "PS").when(F.col("l_returnflag") == "A", "SS").otherwise("C")


def drug(spark: SparkSession, sf_dir: str) -> DataFrame:
    """primaryid, drug_seq, role_cod, drugname; not unique."""
    return _lines(spark, sf_dir).select(F.col("l_orderkey").alias("primaryid"), F.col("l_linenumber").alias("drug_seq"), _role().alias("role_cod"), "drugname")


def drug_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """primaryid, drug_seq, dechal, rechal: Y, N or empty."""
    rechal = F.when(F.col("l_partkey") % 3 == 0, "").when(F.col("l_partkey") % 2 == 0, "Y").otherwise("N")
    return _lines(spark, sf_dir).select(
        F.col("l_orderkey").alias("primaryid"), F.col("l_linenumber").alias("drug_seq"),
        F.when(F.col("l_linestatus") == "O", "Y").otherwise("N").alias("dechal"), rechal.alias("rechal"),
    )


def reac(spark: SparkSession, sf_dir: str) -> DataFrame:
    """primaryid, pt; not unique."""
    nation = read(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("pt"))
    supplier = read(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    lines = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey")
    return lines.join(supplier, F.col("l_suppkey") == F.col("s_suppkey")).select(F.col("l_orderkey").alias("primaryid"), "pt")


def outc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """primaryid, outc_cod; without the lowest priority, whose reports have no outcome row."""
    code = F.when(F.col("o_orderpriority").startswith("1"), "DE").when(F.col("o_orderpriority").startswith("2"), "LT").when(F.col("o_orderpriority").startswith("3"), "HO").otherwise("OT")
    return read(spark, sf_dir, "orders").filter(~F.col("o_orderpriority").startswith("5")).select(F.col("o_orderkey").alias("primaryid"), code.alias("outc_cod"))


def names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """raw_drug_name, entity_id, ingredient_set, unii: one row for each name; large parts have an empty set."""
    name = F.upper(F.trim(F.concat_ws(" ", "p_name", "p_type")))
    words = F.split(F.lower("p_name"), " ")
    one = F.element_at(words, 2)
    both = F.array_join(F.array_sort(F.array_distinct(words)), "|")
    made = F.when(F.col("p_type") == "LARGE", "").when(F.col("p_type").isin("PROMO", "SMALL"), one).otherwise(both)
    out = read(spark, sf_dir, "part").select(name.alias("raw_drug_name"), made.alias("ingredient_set")).distinct()
    entity = F.concat(F.lit("s3-"), F.substring(F.sha1("raw_drug_name"), 1, 16))
    unii = F.when(F.col("ingredient_set").contains("|") | (F.col("ingredient_set") == ""), "").otherwise(F.upper(F.substring(F.sha1("ingredient_set"), 1, 10)))
    return out.select("raw_drug_name", entity.alias("entity_id"), "ingredient_set", unii.alias("unii"))
