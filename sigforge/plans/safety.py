"""Queries on facts, scores and features."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import signal
from ..sources import adapters as src
from .base import query
from .domain_sql import FACT, FEATURES, scores

AS_OF = "19990101"


def fact(spark: SparkSession, d: str) -> DataFrame:
    return signal.build_fact(src.drug(spark, d), src.reac(spark, d), src.demo(spark, d), src.names(spark, d))


def all_scores(spark, d):
    return signal.signal_scores(fact(spark, d))


def all_features(spark, d):
    return signal.signal_features(fact(spark, d), src.drug_flags(spark, d), src.outc(spark, d))


def _r(df: DataFrame, *names: str) -> DataFrame:
    """Doubles rounded for comparison."""
    return df.withColumns({c: F.round(c, 9) for c in names})


SCORE_COLUMNS = "ingredient, pt, a, ab, ac, n, round(ic, 9) AS ic, round(ic025, 9) AS ic025"


@query(f"WITH {FACT} SELECT * FROM fact")
def case_drug_reaction(spark, d):
    return fact(spark, d)


@query(f"WITH {scores()} SELECT {SCORE_COLUMNS}, round(ror, 9) AS ror, round(prr, 9) AS prr, solo_n, combo_n FROM scores")
def signal_scores(spark, d):
    return _r(all_scores(spark, d), "ic", "ic025", "ror", "prr")


_FD = f"fda_dt < '{AS_OF}'"


@query(f"WITH {scores(_FD)} SELECT {SCORE_COLUMNS} FROM scores")
def signal_scores_asof(spark, d):
    return _r(signal.signal_scores(fact(spark, d), as_of=AS_OF, slim=True), "ic", "ic025")


@query(f"WITH {scores()} SELECT ingredient, solo_n, combo_n FROM drugs")
def solo_combo_counts(spark, d):
    return all_scores(spark, d).select("ingredient", "solo_n", "combo_n").distinct()


_F = "ingredient, pt, a, round(death_frac, 9) AS death_frac, round(serious_frac, 9) AS serious_frac, round(dechal_frac, 9) AS dechal_frac, round(rechal_frac, 9) AS rechal_frac, dechal_known_n, rechal_known_n, round(recency, 9) AS recency"


@query(f"WITH {scores()}{FEATURES} SELECT {_F} FROM features")
def signal_features(spark, d):
    return _r(all_features(spark, d), "death_frac", "serious_frac", "dechal_frac", "rechal_frac", "recency")


@query(
    f"WITH {scores()}{FEATURES} SELECT s.ingredient, s.pt, s.a, round(ic025, 9) AS ic025, round(death_frac, 9) AS death_frac, round(serious_frac, 9) AS serious_frac, round(dechal_frac, 9) AS dechal_frac, "
    "round(rechal_frac, 9) AS rechal_frac, round(recency, 9) AS recency FROM scores s LEFT JOIN features f ON s.ingredient = f.ingredient AND s.pt = f.pt"
)
def ranking_input(spark, d):
    return _r(signal.ranking_input(all_scores(spark, d), all_features(spark, d)), "ic025", "death_frac", "serious_frac", "dechal_frac", "rechal_frac", "recency")


@query(f"WITH {scores()} SELECT ingredient, pt, a, round(ic025, 9) AS ic025 FROM scores WHERE a >= 3 AND ic025 > 0")
def gate_pass(spark, d):
    return _r(signal.gate(all_scores(spark, d)).select("ingredient", "pt", "a", "ic025"), "ic025")


@query(f"WITH {scores()} SELECT caseid, primaryid, drug_seq, caseversion, role_cod, drugname, pt FROM latest")
def latest_version(spark, d):
    return signal.latest_version(fact(spark, d)).select("caseid", "primaryid", "drug_seq", "caseversion", "role_cod", "drugname", "pt")


@query(
    "SELECT l_orderkey AS primaryid, l_linenumber AS drug_seq, max(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END) AS dechal_y, max(CASE WHEN l_partkey % 3 <> 0 AND l_partkey % 2 = 0 THEN 1 ELSE 0 END) AS rechal_y, "
    "1 AS dechal_known, max(CASE WHEN l_partkey % 3 <> 0 THEN 1 ELSE 0 END) AS rechal_known FROM lineitem GROUP BY 1, 2"
)
def drug_flag_max(spark, d):
    return signal.drug_flag_max(src.drug_flags(spark, d))
