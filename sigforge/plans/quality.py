"""Contract queries: one row each with the number of rows checked and of violations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import contracts
from ..sources import adapters as src
from .base import query
from .domain_sql import DOMAIN, FACT, FEATURES, scores
from .safety import all_features, all_scores, fact


def _counts(checked: DataFrame, violating: DataFrame) -> DataFrame:
    return checked.agg(F.count("*").alias("n_checked")).crossJoin(violating.agg(F.count("*").alias("n_violations")))


@query(f"WITH {FACT} SELECT count(*) AS n_checked, (SELECT count(*) FROM (SELECT 1 FROM fact GROUP BY primaryid, drug_seq, role_cod, drugname, pt HAVING count(*) > 1)) AS n_violations FROM fact")
def grain_check(spark, d):
    f = fact(spark, d)
    return _counts(f, contracts.grain_unique(f, "primaryid", "drug_seq", "role_cod", "drugname", "pt"))


@query("SELECT count(*) AS n_checked, (SELECT count(*) FROM (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1)) AS n_violations FROM lineitem")
def narrow_grain_check(spark, d):
    """The key of order and line alone, which isn't unique."""
    lines = src.read(spark, d, "lineitem")
    return _counts(lines, contracts.grain_unique(lines, "l_orderkey", "l_linenumber"))


@query(f"WITH {scores()} SELECT count(*) AS n_checked, count(*) FILTER (a > ab OR a > ac) AS n_violations FROM scores")
def marginals_check(spark, d):
    s = all_scores(spark, d)
    return _counts(s, contracts.marginals(s))


@query(
    f"WITH {scores()}{FEATURES} SELECT count(*) AS n_checked, count(*) FILTER (least(death_frac, serious_frac, dechal_frac, rechal_frac, recency) < 0 OR greatest(death_frac, serious_frac, dechal_frac, rechal_frac, recency) > 1 "
    "OR death_frac > serious_frac OR dechal_known_n > a OR rechal_known_n > a) AS n_violations FROM features"
)
def fraction_range(spark, d):
    f = all_features(spark, d)
    return _counts(f, contracts.fractions(f))


@query(f"WITH {scores()}{FEATURES} SELECT (SELECT count(*) FROM scores) AS n_checked, (SELECT count(*) FROM scores s FULL JOIN features f ON s.ingredient = f.ingredient AND s.pt = f.pt WHERE s.a IS DISTINCT FROM f.a) AS n_violations")
def features_alignment(spark, d):
    s = all_scores(spark, d)
    return _counts(s, contracts.aligned(s, all_features(spark, d)))


_SETS = "SELECT lower(p_name) AS s FROM part UNION ALL SELECT replace(lower(p_name), ' ', '|') FROM part UNION ALL SELECT replace(p_name, ' ', ' | ') FROM part"


def _sets(spark, d):
    name = src.read(spark, d, "part").select("p_name")
    return name.select(F.explode(F.array(F.lower("p_name"), F.translate(F.lower("p_name"), " ", "|"), F.replace("p_name", F.lit(" "), F.lit(" | ")))).alias("ingredient_set"))


@query(f"SELECT DISTINCT s AS ingredient_set FROM ({_SETS}) WHERE s <> '' AND (s <> lower(s) OR regexp_matches(s, '(^|[|])( |$)| ([|]|$)|[|][|]'))")
def set_format_violations(spark, d):
    return contracts.set_format(_sets(spark, d))


@query(f"SELECT DISTINCT s AS ingredient_set FROM ({_SETS}) WHERE s <> '' AND array_to_string(list_sort(string_split(s, '|')), '|') <> s")
def set_sorted_violations(spark, d):
    return contracts.set_sorted(_sets(spark, d))


@query(f"WITH {DOMAIN} SELECT count(*) AS n_checked, count(*) FILTER (length(unii) NOT IN (0, 10)) AS n_violations FROM names")
def unii_check(spark, d):
    n = src.names(spark, d)
    return _counts(n, contracts.unii_length(n))


@query(f"WITH {DOMAIN} SELECT count(*) AS n_checked, count(*) FILTER (NOT regexp_matches(fda_dt, '^[0-9]{{8}}$')) AS n_violations FROM demo")
def date_check(spark, d):
    x = src.demo(spark, d)
    return _counts(x, contracts.date_format(x))


_STATUS = "CASE WHEN c_acctbal < 0 THEN '보류' WHEN c_acctbal > 9000 THEN '?' WHEN c_custkey % 7 = 0 THEN '수기' ELSE '확정' END"


@query(f"SELECT count(*) AS n_checked, count(*) FILTER ({_STATUS} = '?') AS n_violations FROM customer")
def accepted_values(spark, d):
    rows = src.read(spark, d, "customer").select(F.expr(_STATUS).alias("resolution_status"))
    return _counts(rows, contracts.accepted(rows, "resolution_status"))


@query(f"SELECT count(*) AS n_checked, count(*) FILTER ({_STATUS} IN ('확정', '수기') AND c_custkey % 11 = 0) AS n_violations FROM customer")
def resolved_has_ingredient(spark, d):
    rows = src.read(spark, d, "customer").select(F.expr(_STATUS).alias("resolution_status"), F.when(F.col("c_custkey") % 11 == 0, "").otherwise(F.col("c_name")).alias("resolved_ingredient_set"))
    return _counts(rows, contracts.resolved_has_ingredient(rows))


@query("SELECT count(*) AS n_checked, count(*) FILTER (l.l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 10)) AS n_violations FROM lineitem l")
def foreign_key_check(spark, d):
    child = src.read(spark, d, "lineitem").select(F.col("l_partkey").alias("p_partkey"))
    return _counts(child, contracts.related(child, src.read(spark, d, "part").filter("p_size > 10"), "p_partkey"))
