"""Rankings, labels, evaluation and point-in-time queries."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import labels as lab
from ..operators import ranking as rk
from ..operators import signal
from ..sources import adapters as src
from .base import query
from .domain_sql import DOMAIN, FEATURES, scores
from .safety import all_features, all_scores

#: Labels for the adapted pairs: by the length of the names, so that they don't depend on the scores.
_LABEL = "CASE WHEN (length(ingredient) * 7 + CAST(substr(pt, 8) AS INTEGER)) % 5 = 0 THEN 1 WHEN (length(ingredient) * 7 + CAST(substr(pt, 8) AS INTEGER)) % 5 = 1 THEN 0 END"
_KEY_LABEL = f"labels_of AS (SELECT ingredient, pt, {_LABEL} AS label FROM scores)"


def _labels(pairs):
    return pairs.select("ingredient", "pt", F.expr(_LABEL).alias("label"))


def _gated(spark, d):
    return signal.gate(all_scores(spark, d)).withColumn("ic025", F.round("ic025", 9)).select("ingredient", "pt", "a", "ic025")


_GATED = "gated AS (SELECT ingredient, pt, a, round(ic025, 9) AS ic025 FROM scores WHERE a >= 3 AND ic025 > 0)"


@query(f"WITH {scores()}, {_GATED} SELECT ingredient, pt, CAST(row_number() OVER (ORDER BY ic025 DESC, ingredient, pt) AS INTEGER) AS rank FROM gated")
def rank_v1(spark, d):
    return rk.build_ranking(_gated(spark, d), "v1").select("ingredient", "pt", "rank")


@query(f"WITH {scores()}, {_GATED} SELECT ingredient, pt, CAST(row_number() OVER (ORDER BY round(ic025 * ln(greatest(a, 1)), 9) DESC, ic025 DESC, ingredient, pt) AS INTEGER) AS rank FROM gated")
def rank_v1e(spark, d):
    scored = _gated(spark, d).withColumn("score", F.round(F.col("ic025") * F.log(F.greatest(F.col("a").cast("double"), F.lit(1.0))), 9))
    return rk.rank(scored, "score").select("ingredient", "pt", "rank")


@query(f"WITH {scores()}, {_GATED}, {_KEY_LABEL} SELECT ingredient, pt, a FROM gated g WHERE NOT EXISTS (SELECT 1 FROM labels_of l WHERE l.ingredient = g.ingredient AND l.pt = g.pt AND l.label = 0)")
def label_exclusion(spark, d):
    g = _gated(spark, d)
    return rk.build_ranking(g, "v2", exclude=_labels(g).filter("label = 0")).select("ingredient", "pt", "a")


_RANKED = f"{scores()}, {_GATED}, {_KEY_LABEL}, ranked AS (SELECT g.*, label, row_number() OVER (ORDER BY ic025 DESC, g.ingredient, g.pt) AS rank FROM gated g LEFT JOIN labels_of l ON g.ingredient = l.ingredient AND g.pt = l.pt)"


@query(
    f"WITH {_RANKED}, s AS (SELECT count(*) AS n, count(*) FILTER (label = 1) AS n_pos FROM ranked), ks AS (SELECT unnest([10, 50, 100, 500]) AS k), "
    "h AS (SELECT k, n, n_pos, (SELECT count(*) FROM ranked WHERE rank <= k AND label = 1) AS hits FROM ks, s) "
    "SELECT CAST(k AS INTEGER) AS k, n, n_pos, hits, round(hits / n_pos, 9) AS recall, round(hits / least(k, n), 9) AS precision, round(hits / least(k, n) / (n_pos / n), 9) AS lift, round(greatest(0, 1 - k / n), 9) AS review_reduction FROM h"
)
def scorecard_topk(spark, d):
    g = _gated(spark, d)
    out = rk.scorecard(rk.build_ranking(g, "v1"), _labels(g), ks=(10, 50, 100, 500))
    return out.withColumns({c: F.round(c, 9) for c in ("recall", "precision", "lift", "review_reduction")})


@query(f"WITH {_RANKED}, c AS (SELECT rank, sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) OVER (ORDER BY rank) AS cum, sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) OVER () AS tot FROM ranked) SELECT CAST(min(rank) AS INTEGER) AS k FROM c WHERE cum >= tot * 0.5")
def k_for_half_recall(spark, d):
    g = _gated(spark, d)
    return rk.k_for_recall(rk.build_ranking(g, "v1"), _labels(g), 0.5)


@query(f"WITH {_RANKED} SELECT ingredient, pt, label, CAST((row_number() OVER (PARTITION BY label ORDER BY sha256(ingredient || chr(31) || pt), ingredient, pt) - 1) % 5 AS INTEGER) AS fold FROM ranked")
def fold_assignment(spark, d):
    g = _gated(spark, d)
    return rk.folds(g.join(_labels(g), ["ingredient", "pt"]), 5).select("ingredient", "pt", "label", "fold")


@query(
    f"WITH {_RANKED} SELECT ingredient, pt, a % 3 AS fold, round((rank() OVER (PARTITION BY a % 3 ORDER BY round(ic025, 1)) + (count(*) OVER (PARTITION BY a % 3, round(ic025, 1)) - 1) / 2.0) / count(*) OVER (PARTITION BY a % 3), 9) AS percentile FROM ranked"
)
def fold_percentile(spark, d):
    g = _gated(spark, d).withColumn("fold", F.col("a") % 3).withColumn("score", F.round("ic025", 1))
    return rk.fold_percentile(g).select("ingredient", "pt", "fold", F.round("percentile", 9).alias("percentile"))


@query()
def crossfit_logreg(spark, d):
    pairs = signal.ranking_input(all_scores(spark, d), all_features(spark, d))
    return rk.build_ranking(pairs.join(_labels(pairs), ["ingredient", "pt"]), "v5").select("ingredient", "pt", "label", "fold", "score", "rank")


@query(f"WITH {scores()}{FEATURES} SELECT avg(a) AS mean_a, stddev_pop(a) AS sd_a, CASE WHEN stddev_pop(0 * a) = 0 THEN 1.0 ELSE stddev_pop(0 * a) END AS sd_constant FROM features")
def standardisation(spark, d):
    f = all_features(spark, d).select(F.col("a").cast("double").alias("a"))
    constant = F.stddev_pop(F.col("a") * 0)
    return f.agg(F.avg("a").alias("mean_a"), F.stddev_pop("a").alias("sd_a"), F.when(constant == 0, 1.0).otherwise(constant).alias("sd_constant"))


# gold labels from orders: customer segments are products, priorities signals, quarters from the dates
_GOLD = """gold AS (SELECT c_mktsegment || ' ' || CAST(c_nationkey AS VARCHAR) AS product, substr(o_orderpriority, 3) AS signal, CASE o_orderstatus WHEN 'F' THEN '양성' WHEN 'O' THEN '음성' ELSE '보류' END AS label,
 CAST(year(o_orderdate) AS INTEGER) AS year, CASE quarter(o_orderdate) WHEN 1 THEN 'January' WHEN 2 THEN 'April' WHEN 3 THEN 'July' ELSE 'October' END AS q_start FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderkey % 7 = 0),
terminal AS (SELECT product, signal, CASE max(CASE label WHEN '양성' THEN 2 WHEN '음성' THEN 1 ELSE 0 END) WHEN 2 THEN '양성' WHEN 1 THEN '음성' ELSE '보류' END AS label, min(year * 10 + CASE q_start WHEN 'January' THEN 1 WHEN 'April' THEN 2 WHEN 'July' THEN 3 ELSE 4 END) AS cohort,
 min(year) AS first_year, count(DISTINCT year * 10 + CASE q_start WHEN 'January' THEN 1 WHEN 'April' THEN 2 WHEN 'July' THEN 3 ELSE 4 END) AS n_quarters FROM gold GROUP BY 1, 2),
resolution AS (SELECT first_year, count(*) FILTER (label = '양성') AS n_positive, count(*) FILTER (label = '음성') AS n_negative, count(*) FILTER (label = '보류') AS n_pending, count(*) AS n, count(*) FILTER (label <> '보류') / count(*) AS resolved FROM terminal GROUP BY 1)"""


def _gold(spark, d):
    orders = src.read(spark, d, "orders").filter(F.col("o_orderkey") % 7 == 0)
    rows = orders.join(src.read(spark, d, "customer").select("c_custkey", "c_mktsegment", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    label = F.when(F.col("o_orderstatus") == "F", "양성").when(F.col("o_orderstatus") == "O", "음성").otherwise("보류")
    month = F.element_at(F.array(*map(F.lit, ("January", "April", "July", "October"))), F.quarter("o_orderdate"))
    return rows.select(F.concat_ws(" ", "c_mktsegment", F.col("c_nationkey").cast("string")).alias("product"), F.expr("substr(o_orderpriority, 3)").alias("signal"), label.alias("label"), F.year("o_orderdate").alias("year"), month.alias("q_start"))


@query(f"WITH {_GOLD} SELECT * FROM terminal")
def terminal_label(spark, d):
    return lab.terminal_pairs(_gold(spark, d))


@query(f"WITH {_GOLD} SELECT * REPLACE (round(resolved, 9) AS resolved) FROM resolution")
def resolution_table(spark, d):
    return lab.resolution_table(lab.terminal_pairs(_gold(spark, d))).withColumn("resolved", F.round("resolved", 9))


@query(f"WITH {_GOLD} SELECT coalesce(max(CASE WHEN resolved >= 0.75 THEN first_year END), min(first_year)) AS cutoff_year FROM resolution")
def cutoff_year(spark, d):
    return lab.cutoff_year(lab.resolution_table(lab.terminal_pairs(_gold(spark, d))))


@query(
    f"WITH {_GOLD}, c AS (SELECT coalesce(max(CASE WHEN resolved >= 0.75 THEN first_year END), min(first_year)) AS y FROM resolution), "
    "m AS (SELECT CASE WHEN product LIKE 'BUILDING%' THEN 'structure' ELSE lower(product) END AS ingredient, lower(signal) AS pt, CASE WHEN first_year <= y THEN CASE WHEN label = '양성' THEN 1 ELSE 0 END END AS label FROM terminal, c WHERE label <> '보류') "
    "SELECT ingredient, pt, max(label) AS label FROM m GROUP BY 1, 2"
)
def label_set(spark, d):
    gold = _gold(spark, d)
    products = gold.filter(F.col("product").startswith("BUILDING")).select(F.col("product").alias("key"), F.lit("Structure ").alias("value")).distinct()
    return lab.label_set(gold, products, products.limit(0))


_PIT = "p AS (SELECT CAST(o_orderkey // 2 AS VARCHAR) AS caseid, split_part(p_name, ' ', 2) AS ingredient, n_name AS pt, CAST(year(o_orderdate) * 4 + quarter(o_orderdate) - 1 AS INTEGER) AS period FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey)"
_FIRST = f"""{_PIT}, cf AS (SELECT caseid, min(period) AS q FROM p GROUP BY 1), t AS (SELECT DISTINCT p.caseid, ingredient, pt, q FROM p JOIN cf ON p.caseid = cf.caseid), grid AS (SELECT DISTINCT q AS g FROM cf),
a AS (SELECT ingredient, pt, g, count(*) AS a FROM t JOIN grid ON q <= g GROUP BY 1, 2, 3), ab AS (SELECT ingredient, g, count(DISTINCT caseid) AS ab FROM t JOIN grid ON q <= g GROUP BY 1, 2),
ac AS (SELECT pt, g, count(DISTINCT caseid) AS ac FROM t JOIN grid ON q <= g GROUP BY 1, 2), nn AS (SELECT g, count(*) AS n FROM cf JOIN grid ON q <= g GROUP BY 1),
detected AS (SELECT ingredient, pt, CAST(min(g) AS INTEGER) AS first_period FROM a JOIN ab USING (ingredient, g) JOIN ac USING (pt, g) JOIN nn USING (g)
 WHERE a >= 3 AND log2((a + 0.5) / (CAST(ab AS DOUBLE) * ac / n + 0.5)) - 3.3 * pow(a + 0.5, -0.5) - 2 * pow(a + 0.5, -1.5) > -2.5 GROUP BY 1, 2)"""


def _detected(spark, d):
    lines = src.read(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey")
    orders = src.read(spark, d, "orders").select("o_orderkey", "o_orderdate")
    part = src.read(spark, d, "part").select("p_partkey", "p_name")
    nation = src.read(spark, d, "supplier").join(src.read(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", "n_name")
    rows = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(part, F.col("l_partkey") == F.col("p_partkey")).join(nation, F.col("l_suppkey") == F.col("s_suppkey"))
    rows = rows.select(F.expr("CAST(o_orderkey div 2 AS STRING)").alias("caseid"), F.element_at(F.split("p_name", " "), 2).alias("ingredient"), F.col("n_name").alias("pt"), (F.year("o_orderdate") * 4 + F.quarter("o_orderdate") - 1).alias("period"))
    return lab.first_detection(rows, above=-2.5)


@query(f"WITH {_FIRST} SELECT * FROM detected")
def first_detection(spark, d):
    return _detected(spark, d)


_LEAD = f"{_FIRST}, actions AS (SELECT split_part(p_name, ' ', 2) AS ingredient, 'NATION_' || CAST(p_partkey % 25 AS VARCHAR) AS pt, CAST(7985 + p_size % 12 AS INTEGER) AS action_period FROM part), leads AS (SELECT x.*, first_period, CASE WHEN first_period < action_period THEN action_period - first_period END AS lead FROM (SELECT ingredient, pt, min(action_period) AS action_period FROM actions GROUP BY 1, 2) x LEFT JOIN detected USING (ingredient, pt))"


def _leads(spark, d):
    part = src.read(spark, d, "part")
    actions = part.select(F.element_at(F.split("p_name", " "), 2).alias("ingredient"), F.concat(F.lit("NATION_"), (F.col("p_partkey") % 25).cast("string")).alias("pt"), (F.lit(7985) + F.col("p_size") % 12).alias("action_period"))
    return lab.lead_time(_detected(spark, d), actions)


@query(f"WITH {_LEAD} SELECT * FROM leads")
def lead_time(spark, d):
    return _leads(spark, d)


@query(f"WITH {_LEAD} SELECT count(*) AS n, count(first_period) AS n_ever, count(lead) AS n_before, round(count(lead) / count(*), 9) AS rate, median(lead) AS median_lead, max(lead) AS max_lead FROM leads")
def lead_summary(spark, d):
    return lab.lead_summary(_leads(spark, d)).withColumn("rate", F.round("rate", 9))


@query(f"WITH {DOMAIN} SELECT CAST(substr(fda_dt, 1, 4) AS INTEGER) * 4 + (CAST(substr(fda_dt, 5, 2) AS INTEGER) - 1) // 3 AS q, count(*) AS new_cases, CAST(sum(count(*)) OVER (ORDER BY CAST(substr(fda_dt, 1, 4) AS INTEGER) * 4 + (CAST(substr(fda_dt, 5, 2) AS INTEGER) - 1) // 3) AS BIGINT) AS cum FROM demo GROUP BY 1")
def cumulative_reports(spark, d):
    """Counts up to each quarter by a running sum over the quarters' counts."""
    q = F.expr("CAST(substr(fda_dt, 1, 4) AS INT) * 4 + (CAST(substr(fda_dt, 5, 2) AS INT) - 1) div 3")
    new = src.demo(spark, d).groupBy(q.alias("q")).agg(F.count("*").alias("new_cases"))
    return new.withColumn("cum", F.sum("new_cases").over(Window.orderBy("q")))


