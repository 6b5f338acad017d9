"""Joins, maintenance, deliveries, vectors and texts over the driver's tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import rules, text
from ..operators import similarity as sim
from ..operators import tables
from ..sources import adapters as src
from ..sources import delimited, flatten
from .base import query


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)")
def anti_reconcile(spark, d):
    return src.read(spark, d, "customer").select("c_custkey", "c_name").join(src.read(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey")).distinct(), "c_custkey", "left_anti")


@query("SELECT o.k AS key, o.n AS local_n, coalesce(l.n, 0) AS live_n, o.n - coalesce(l.n, 0) AS diff FROM (SELECT o_orderkey AS k, o_orderkey % 7 AS n FROM orders) o LEFT JOIN (SELECT l_orderkey AS k, count(*) AS n FROM lineitem GROUP BY 1) l ON o.k = l.k WHERE o.n <> coalesce(l.n, 0)")
def count_mismatch(spark, d):
    return tables.count_mismatch(src.read(spark, d, "orders").select(F.col("o_orderkey").alias("key"), (F.col("o_orderkey") % 7).alias("n")), src.read(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("key")).agg(F.count("*").alias("n")), "key")


@query("SELECT count(*) AS n FROM (SELECT DISTINCT l_orderkey, l_returnflag FROM lineitem)")
def dedup_exact(spark, d):
    lines = src.read(spark, d, "lineitem").select("l_orderkey", "l_returnflag")
    return tables.dedupe(lines).agg(F.count("*").alias("n"))


@query("SELECT o_orderkey AS primaryid, coalesce(u.status, o_orderstatus) AS status FROM orders LEFT JOIN (SELECT l_orderkey, min(l_linestatus) AS status FROM lineitem WHERE l_orderkey % 3 = 0 GROUP BY 1) u ON o_orderkey = l_orderkey UNION ALL SELECT -1 - o_orderkey, 'N' FROM orders WHERE o_orderkey % 50 = 0")
def upsert_merge(spark, d):
    orders = src.read(spark, d, "orders")
    target = orders.select(F.col("o_orderkey").alias("primaryid"), F.col("o_orderstatus").alias("status"))
    changed = src.read(spark, d, "lineitem").filter("l_orderkey % 3 = 0").groupBy(F.col("l_orderkey").alias("primaryid")).agg(F.min("l_linestatus").alias("status"))
    new = orders.filter("o_orderkey % 50 = 0").select((-1 - F.col("o_orderkey")).alias("primaryid"), F.lit("N").alias("status"))
    return tables.upsert(target, changed.unionByName(new), ["primaryid"])


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k, event_type FROM events")
def json_props(spark, d):
    return src.read(spark, d, "events").select("event_id", F.from_json("props", "k int")["k"].alias("k"), "event_type")


@query("SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS k FROM events) WHERE k = 1")
def latest_per_user(spark, d):
    best = F.max(F.struct("ts", "event_id", "event_type")).alias("b")
    return src.read(spark, d, "events").groupBy("user_id").agg(best).select("user_id", "b.event_id", "b.event_type")


@query("SELECT n_name AS pt, n_regionkey AS region, count(*) AS n, row_number() OVER (PARTITION BY n_regionkey ORDER BY count(*) DESC, n_name) AS k FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY 1, 2 QUALIFY k <= 3")
def top_candidates(spark, d):
    n = src.read(spark, d, "supplier").join(src.read(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).groupBy(F.col("n_name").alias("pt"), F.col("n_regionkey").alias("region")).agg(F.count("*").alias("n"))
    return n.withColumn("k", F.row_number().over(Window.partitionBy("region").orderBy(F.desc("n"), "pt"))).filter("k <= 3")


@query("SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS \"F\", count(*) FILTER (o_orderstatus = 'O') AS \"O\", count(*) FILTER (o_orderstatus = 'P') AS \"P\" FROM orders GROUP BY 1")
def label_pivot(spark, d):
    return src.read(spark, d, "orders").groupBy("o_orderpriority").pivot("o_orderstatus", ["F", "O", "P"]).count().na.fill(0)


@query("SELECT round(80 + 0.5 * i, 1) AS threshold, count(*) FILTER (score >= 80 + 0.5 * i) AS matched, CAST(coalesce(sum(n) FILTER (score >= 80 + 0.5 * i), 0) AS BIGINT) AS reports FROM (SELECT 80 + p_size * 0.4 AS score, p_partkey % 10 AS n FROM part), (SELECT unnest(range(40)) AS i) GROUP BY i")
def threshold_sweep(spark, d):
    rows = src.read(spark, d, "part").select((F.lit(80.0) + F.col("p_size") * F.lit(0.4)).alias("score"), (F.col("p_partkey") % 10).alias("n_reports"))
    return tables.threshold_sweep(rows, [80 + 0.5 * i for i in range(40)])


@query("WITH s AS (SELECT value, event_type, row_number() OVER (PARTITION BY event_type ORDER BY value) - 1 AS i, count(*) OVER (PARTITION BY event_type) AS n FROM events) SELECT event_type, max(value) FILTER (i = least(n - 1, CAST(floor(n * 0.5) AS BIGINT))) AS p50, max(value) FILTER (i = least(n - 1, CAST(floor(n * 0.95) AS BIGINT))) AS p95 FROM s GROUP BY 1")
def latency_stats(spark, d):
    return tables.latency_stats(src.read(spark, d, "events"), "event_type", "value")


@query("SELECT page_id, length(url) AS n FROM pages WHERE url LIKE '%page=%'")
def page_links(spark, d):
    return src.read(spark, d, "pages").filter(F.col("url").contains("page=")).select("page_id", F.length("url").cast("long").alias("n"))


# delimited lines made of orders: every tenth has a field too many, every eleventh one too few
_LINES = "SELECT o_orderkey AS line_no, CASE WHEN o_orderkey % 10 = 0 THEN o_orderkey || '$' || o_custkey || '$' || o_orderstatus || '$x' WHEN o_orderkey % 11 = 0 THEN o_orderkey || '$' || o_custkey ELSE o_orderkey || '$' || o_custkey || '$' || o_orderstatus END AS raw FROM orders"


def _raw_lines(spark, d):
    k = F.col("o_orderkey")
    base = F.concat_ws("$", "o_orderkey", "o_custkey")
    raw = F.when(k % 10 == 0, F.concat_ws("$", base, "o_orderstatus", F.lit("x"))).when(k % 11 == 0, base).otherwise(F.concat_ws("$", base, "o_orderstatus"))
    return src.read(spark, d, "orders").select(k.alias("line_no"), raw.alias("raw_line"))


@query(f"SELECT line_no, 3 AS expected_cols, CAST(len(string_split(raw, '$')) AS INTEGER) AS actual_cols, raw AS raw_line FROM ({_LINES}) WHERE len(string_split(raw, '$')) <> 3")
def line_reject(spark, d):
    return delimited.classify(_raw_lines(spark, d), ["primaryid", "custkey", "status"])[1]


@query(f"SELECT split_part(raw, '$', 1) AS primaryid, split_part(raw, '$', 3) AS status, CAST(NULL AS VARCHAR) AS lot_num FROM ({_LINES}) WHERE len(string_split(raw, '$')) = 3")
def header_harmonize(spark, d):
    good = delimited.classify(_raw_lines(spark, d), ["﻿PrimaryID", " custkey", "gndr_cod"])[0]
    return delimited.harmonize(good, ["primaryid", "status", "lot_num"], {"gndr_cod": "status"})


@query("SELECT product, ingredient, unii FROM (SELECT p_partkey, p_name AS product, unnest(string_split(p_name || ' ' || p_type, ' ')) AS ingredient, unnest([p_brand, CAST(p_size AS VARCHAR), NULL]) AS unii FROM part)")
def flatten_records(spark, d):
    part = src.read(spark, d, "part").select(F.array("p_name").alias("brands"), F.split(F.concat_ws(" ", "p_name", "p_type"), " ").alias("substances"), F.array("p_brand", F.col("p_size").cast("string")).alias("uniis"))
    return flatten.label_pairs(part)


@query("SELECT DISTINCT p_type AS product, s AS signal FROM (SELECT p_type, unnest(string_split(p_brand || ';' || p_name, ';')) AS s FROM part) WHERE length(s) >= 8")
def explode_pairs(spark, d):
    return flatten.explode_pairs(src.read(spark, d, "part").select(F.col("p_type").alias("product"), F.concat_ws(";", "p_brand", "p_name").alias("signal")), least=8)


_INFO = "CASE p_partkey % 5 WHEN 0 THEN 'The labeling was updated in 2015.' WHEN 1 THEN 'FDA decided that no action is necessary at this time.' WHEN 2 THEN 'FDA is evaluating the need for regulatory action.' WHEN 3 THEN 'The label for ' || p_name || ' was revised. No action is necessary for certain others.' ELSE '' END"


@query("SELECT p_partkey AS id, CASE p_partkey % 5 WHEN 0 THEN '양성' WHEN 1 THEN '음성' WHEN 3 THEN '양성' ELSE '보류' END AS label FROM part")
def label_classifier(spark, d):
    return src.read(spark, d, "part").select(F.col("p_partkey").alias("id"), rules.classify_report(F.concat("p_name", F.lit(" (x)")), F.expr(_INFO)).alias("label"))


@query("SELECT label3 AS label, count(*) AS n, round(avg(CASE WHEN label3 = other THEN 1.0 ELSE 0.0 END), 9) AS accuracy FROM (SELECT CASE p_partkey % 5 WHEN 0 THEN '양성' WHEN 1 THEN '음성' WHEN 3 THEN '양성' ELSE '보류' END AS label3, CASE WHEN p_size > 25 THEN '양성' ELSE '음성' END AS other FROM part) GROUP BY 1")
def label_accuracy(spark, d):
    rows = src.read(spark, d, "part").select(rules.classify_report(F.concat("p_name", F.lit(" (x)")), F.expr(_INFO)).alias("label"), F.when(F.col("p_size") > 25, "양성").otherwise("음성").alias("other"))
    return rows.groupBy("label").agg(F.count("*").alias("n"), F.round(F.avg(F.when(F.col("label") == F.col("other"), 1.0).otherwise(0.0)), 9).alias("accuracy"))


_SPELL = "'acute hemorrhage and tumor ' || p_name || ' anemia paralyzed leukemia'"


@query("SELECT p_partkey AS id, 'acute haemorrhage and tumour ' || p_name || ' anaemia paralysed leukaemia' AS british, upper(left(list_sort(string_split(p_name, ' '))[1], 1)) AS block FROM part")
def spelling_and_block(spark, d):
    return src.read(spark, d, "part").select(F.col("p_partkey").alias("id"), text.british(F.expr(_SPELL)).alias("british"), text.block_key(F.upper("p_name")).alias("block"))


_NEAR = "v AS (SELECT vec_id AS id, [x / sqrt(list_sum([y * y for y in embedding])) for x in embedding] AS u, label FROM (SELECT vec_id, label, [CAST(z AS DOUBLE) for z in embedding] AS embedding FROM embeddings)), n AS (SELECT a.id AS query, b.id AS id, a.label AS ql, b.label AS l, list_inner_product(a.u, b.u) AS score, row_number() OVER (PARTITION BY a.id ORDER BY list_inner_product(a.u, b.u) DESC, b.id) AS rank FROM v a JOIN v b ON true WHERE a.id % 20 = 0)"


def _nearest(spark, d):
    vectors = src.read(spark, d, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    return sim.nearest_vectors(vectors.filter("id % 20 = 0"), vectors, k=10)


@query(f"WITH {_NEAR} SELECT query, id, CAST(rank AS INTEGER) AS rank, round(score, 6) AS score FROM n WHERE rank <= 10")
def knn_topk(spark, d):
    return _nearest(spark, d).withColumn("score", F.round("score", 6)).select("query", "id", "rank", "score")


@query(f"WITH {_NEAR}, h AS (SELECT query, max(CASE WHEN ql = l AND id <> query THEN 1.0 ELSE 0.0 END) AS hit FROM n WHERE rank <= 10 GROUP BY 1) SELECT count(*) AS n_queries, round(avg(hit), 9) AS recall FROM h")
def retrieval_recall(spark, d):
    """Share of queries with another vector of their label among the ten nearest."""
    label = src.read(spark, d, "embeddings").select(F.col("vec_id").alias("id"), "label")
    rows = _nearest(spark, d).join(label, "id").join(label.select(F.col("id").alias("query"), F.col("label").alias("own")), "query")
    hits = rows.groupBy("query").agg(F.max(F.when((F.col("label") == F.col("own")) & (F.col("id") != F.col("query")), 1.0).otherwise(0.0)).alias("hit"))
    return hits.agg(F.count("*").alias("n_queries"), F.round(F.avg("hit"), 9).alias("recall"))


@query("SELECT conv_id, count(*) AS n_turns, max(turn) AS last_turn, arg_max(role, turn) AS last_role FROM conversations GROUP BY 1")
def conversation_last_turn(spark, d):
    return src.read(spark, d, "conversations").groupBy("conv_id").agg(F.count("*").alias("n_turns"), F.max("turn").alias("last_turn"), F.max_by("role", "turn").alias("last_role"))


@query("SELECT DISTINCT upper(trim(p_name)) AS drugname FROM part WHERE trim(p_name) <> ''")
def distinct_names(spark, d):
    return src.read(spark, d, "part").select(F.upper(F.trim("p_name")).alias("drugname")).filter("drugname <> ''").distinct()
