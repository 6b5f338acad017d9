"""Case x product x reaction facts, disproportionality scores and case features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SUSPECT = ("PS", "SS")


def build_fact(drug: DataFrame, reac: DataFrame, demo: DataFrame, names: DataFrame) -> DataFrame:
    """Unfold reports: one row for each primaryid, drug_seq, role_cod, drugname and pt.

    Products and reactions are made distinct before they meet, which stops fan-out; names that aren't
    known keep an empty set. `names` has one row for each raw name and is joined by the trimmed upper-case name.
    """
    drugs = drug.select("primaryid", "drug_seq", "role_cod", "drugname").distinct().withColumn("raw_drug_name", F.upper(F.trim("drugname")))
    drugs = drugs.join(names, "raw_drug_name", "left")
    return (
        drugs.join(reac.select("primaryid", "pt").distinct(), "primaryid")
        .join(demo, "primaryid")
        .select(
            F.col("caseid").cast("string"), F.col("primaryid").cast("string"), F.col("drug_seq").cast("int"), F.col("caseversion").cast("int"),
            "fda_dt", "role_cod", "drugname", F.coalesce("ingredient_set", F.lit("")).alias("ingredient_set"), F.coalesce("unii", F.lit("")).alias("unii"), "pt",
        )
    )


def latest_version(fact: DataFrame) -> DataFrame:
    """Rows of each case's largest caseversion, ties all kept; rows without case or version go. One shuffle, no self join."""
    top = F.max("caseversion").over(Window.partitionBy("caseid"))
    return fact.filter("caseid IS NOT NULL").withColumn("_top", top).filter(F.col("caseversion") == F.col("_top")).drop("_top")


def ingredients(rows: DataFrame, column: str = "ingredient_set") -> DataFrame:
    """A row for each ingredient of the set; empty and null sets go."""
    return rows.filter(F.col(column) != "").withColumn("ingredient", F.explode(F.split(column, "[|]")))


def signal_scores(fact: DataFrame, as_of: str | None = None, slim: bool = False) -> DataFrame:
    """One row for each ingredient and reaction that share a case: 2x2 counts, IC, IC025, ROR, PRR, solo and combination cases.

    as_of: only reports with fda_dt before it. Products count if primary or secondary suspect, reactions
    and the number of cases whatever the role. Counts are of distinct cases. ROR and PRR are null where they divide by 0.
    """
    if as_of is not None:
        fact = fact.filter(F.col("fda_dt") < as_of)
    rows = latest_version(fact.select("caseid", "caseversion", "role_cod", "ingredient_set", "pt"))
    used = ingredients(rows.filter(F.col("role_cod").isin(*SUSPECT)))
    case_drug = used.groupBy("caseid", "ingredient").agg(
        F.max(F.when(~F.col("ingredient_set").contains("|"), 1).otherwise(0)).alias("solo"),
        F.max(F.when(F.col("ingredient_set").contains("|"), 1).otherwise(0)).alias("combo"),
    )
    case_reac = rows.filter("pt <> ''").select("caseid", "pt").distinct()
    drugs = case_drug.groupBy("ingredient").agg(F.count("*").alias("ab"), F.sum("solo").alias("solo_n"), F.sum("combo").alias("combo_n"))
    reacs = case_reac.groupBy("pt").agg(F.count("*").alias("ac"))
    total = rows.select("caseid").distinct().agg(F.count("*").alias("n"))
    pairs = case_drug.select("caseid", "ingredient").join(case_reac, "caseid").groupBy("ingredient", "pt").agg(F.count("*").alias("a"))
    out = pairs.join(drugs, "ingredient").join(reacs, "pt").crossJoin(F.broadcast(total))
    a, ab, ac, n = (F.col(c).cast("double") for c in ("a", "ab", "ac", "n"))
    ic = information_component(a, ab, ac, n)
    columns = [
        "ingredient", "pt", "a", "ab", "ac", "n", ic.alias("ic"), (ic - F.lit(3.3) * F.pow(a + 0.5, F.lit(-0.5)) - F.lit(2.0) * F.pow(a + 0.5, F.lit(-1.5))).alias("ic025"),
    ]
    if not slim:
        b, c, d = ab - a, ac - a, n - ab - ac + a
        columns += [
            F.try_divide(a * d, b * c).alias("ror"), F.try_divide(F.try_divide(a, ab), F.try_divide(c, n - ab)).alias("prr"),
            F.col("solo_n"), F.col("combo_n"),
        ]
    return out.select(*columns)


def information_component(a: Column, ab: Column, ac: Column, n: Column) -> Column:
    return F.log2((a + 0.5) / (ab * ac / n + 0.5))


def drug_flag_max(flags: DataFrame) -> DataFrame:
    """Whether any row of a report's product says Y, and whether any says Y or N."""
    yes = lambda c: F.max(F.when(F.upper(F.trim(c)) == "Y", 1).otherwise(0))
    known = lambda c: F.max(F.when(F.upper(F.trim(c)).isin("Y", "N"), 1).otherwise(0))
    return flags.groupBy("primaryid", "drug_seq").agg(
        yes("dechal").alias("dechal_y"), yes("rechal").alias("rechal_y"), known("dechal").alias("dechal_known"), known("rechal").alias("rechal_known")
    )


def signal_features(fact: DataFrame, flags: DataFrame, outc: DataFrame) -> DataFrame:
    """Shares of the cases that share ingredient and reaction: death, serious, de- and re-challenge, recent.

    A case without outcome rows isn't serious; recent is a report within two years of the latest report of all.
    """
    rows = latest_version(fact).withColumn("primaryid", F.col("primaryid").cast("string"))
    out_flags = outc.groupBy(F.col("primaryid").cast("string").alias("primaryid")).agg(
        F.max(F.when(F.col("outc_cod") == "DE", 1).otherwise(0)).alias("is_death"),
        F.max(F.when(F.col("outc_cod").isin("DE", "LT", "HO", "DS", "CA", "RI"), 1).otherwise(0)).alias("is_serious"),
    )
    reports = rows.select("caseid", "primaryid", F.try_to_timestamp("fda_dt", F.lit("yyyyMMdd")).alias("fda_date")).distinct()
    case = reports.join(out_flags, "primaryid", "left").groupBy("caseid").agg(
        F.max(F.coalesce("is_death", F.lit(0))).alias("is_death"), F.max(F.coalesce("is_serious", F.lit(0))).alias("is_serious"), F.max("fda_date").alias("fda_date"),
    )
    challenged = drug_flag_max(flags).withColumn("primaryid", F.col("primaryid").cast("string"))
    used = ingredients(rows.filter(F.col("role_cod").isin(*SUSPECT)).select("caseid", "primaryid", "drug_seq", "ingredient_set").distinct())
    known = ("dechal_y", "rechal_y", "dechal_known", "rechal_known")
    case_drug = used.join(challenged, ["primaryid", "drug_seq"], "left").groupBy("caseid", "ingredient").agg(*(F.max(F.coalesce(c, F.lit(0))).alias(c) for c in known))
    case_reac = rows.filter("pt <> ''").select("caseid", "pt").distinct()
    latest = case.agg(F.add_months(F.max("fda_date"), -24).alias("since"))
    both = case_drug.join(case_reac, "caseid").join(case, "caseid").crossJoin(F.broadcast(latest))
    mean = lambda c: F.avg(F.col(c).cast("double"))
    return both.groupBy("ingredient", "pt").agg(
        F.count("*").alias("a"), mean("is_death").alias("death_frac"), mean("is_serious").alias("serious_frac"),
        mean("dechal_y").alias("dechal_frac"), mean("rechal_y").alias("rechal_frac"),
        F.sum("dechal_known").alias("dechal_known_n"), F.sum("rechal_known").alias("rechal_known_n"),
        F.avg(F.when(F.col("fda_date") >= F.col("since"), 1.0).otherwise(0.0)).alias("recency"),
    )


def ranking_input(scores: DataFrame, features: DataFrame) -> DataFrame:
    """Every score row with its features."""
    columns = ("death_frac", "serious_frac", "dechal_frac", "rechal_frac", "recency")
    return scores.select("ingredient", "pt", "a", "ic025").join(features.select("ingredient", "pt", *columns), ["ingredient", "pt"], "left")


def gate(scores: DataFrame, least: int = 3, above: float | None = 0.0) -> DataFrame:
    """Pairs with enough cases and, if asked, a lower bound strictly above."""
    out = scores.filter(F.col("a") >= least)
    return out if above is None else out.filter(F.col("ic025") > above)
