"""Queries on names: normalising, dictionaries, entities, triage, similarity, decisions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import rules, text
from ..operators import dictionary as dic
from ..operators import similarity as sim
from ..sources import adapters as src
from .base import query

# free-text names from parts: the same product with doses, forms, salts, brackets and combinations
_NAMES = """names AS (SELECT p_partkey AS id, upper(p_name) || CASE p_partkey % 8 WHEN 0 THEN ' 500 MG TABLETS' WHEN 1 THEN ' SODIUM' WHEN 2 THEN ', 20MG' WHEN 3 THEN ' TABLETS USP, 10 MG' WHEN 4 THEN ' [' || split_part(upper(p_name), ' ', 2) || ']'
 WHEN 5 THEN '-100' WHEN 6 THEN ' (' || split_part(upper(p_name), ' ', 2) || ')' ELSE '' END AS name, p_size AS n_reports FROM part)"""
_TAIL = text.NAME_TAIL.replace("'", "''")
_NORM = f"trim(regexp_replace(trim(regexp_replace(trim(upper(name)), '[.]+$', '')), '{_TAIL}', ''))"


def _names(spark, d):
    part = src.read(spark, d, "part")
    up, k = F.upper("p_name"), F.col("p_partkey") % 8
    second = F.element_at(F.split(up, " "), 2)
    tail = (
        F.when(k == 0, " 500 MG TABLETS").when(k == 1, " SODIUM").when(k == 2, ", 20MG").when(k == 3, " TABLETS USP, 10 MG")
        .when(k == 4, F.concat(F.lit(" ["), second, F.lit("]"))).when(k == 5, "-100").when(k == 6, F.concat(F.lit(" ("), second, F.lit(")"))).otherwise("")
    )
    return part.select(F.col("p_partkey").alias("id"), F.concat(up, tail).alias("name"), F.col("p_size").alias("n_reports"))


# dictionary rows of three sources that agree on some products only
_ROWS = """raw AS (SELECT 'label' AS source, p_name AS medicinalproduct, split_part(p_name, ' ', 2) || ' sodium' AS ingredient_norm, upper(left(sha1(p_name), 10)) AS unii FROM part
 UNION ALL SELECT 'ndc', p_name, split_part(p_name, ' ', 2), CASE WHEN p_size > 25 THEN upper(left(sha1(p_name), 10)) ELSE upper(left(sha1(p_brand), 10)) END FROM part
 UNION ALL SELECT 'rxnorm', p_name, split_part(p_name, ' ', 1), '' FROM part WHERE p_partkey % 5 = 0)"""
_SALTS = "|".join(sorted(text.SALT_SUFFIXES, key=len, reverse=True))
_DICT = f"""{_ROWS}, n AS (SELECT source, upper(trim(medicinalproduct)) AS product, medicinalproduct, trim(regexp_replace(upper(trim(ingredient_norm)), '(?: (?:{_SALTS}))+$', '')) AS ingredient, unii FROM raw),
ss AS (SELECT source, product, string_agg(DISTINCT lower(ingredient), '|' ORDER BY lower(ingredient)) AS s FROM n GROUP BY 1, 2),
votes AS (SELECT product, ingredient, unii FROM (SELECT product, ingredient, unii, row_number() OVER (PARTITION BY product, ingredient ORDER BY count(*) DESC, unii) AS k FROM n WHERE unii <> '' GROUP BY 1, 2, 3) WHERE k = 1),
cand AS (SELECT k.product, k.ingredient, s, min(k.source) AS first_source FROM (SELECT DISTINCT product, ingredient, source FROM n) k JOIN ss USING (source, product) GROUP BY 1, 2, 3),
dict AS (SELECT g.medicinalproduct, g.ingredient AS ingredient_norm, (SELECT string_agg(s, ' ; ' ORDER BY first_source) FROM cand c WHERE c.product = g.product AND c.ingredient = g.ingredient) AS ingredient_set, coalesce(v.unii, '') AS unii, g.source,
 '사전' AS method, '' AS confidence, 'd-1' AS dictionary_version FROM (SELECT product, ingredient, min(medicinalproduct) AS medicinalproduct, string_agg(DISTINCT source, '|' ORDER BY source) AS source FROM n GROUP BY 1, 2) g LEFT JOIN votes v ON v.product = g.product AND v.ingredient = g.ingredient)"""


def _rows(spark, d):
    part = src.read(spark, d, "part")
    second = F.element_at(F.split("p_name", " "), 2)
    hashed = lambda c: F.upper(F.substring(F.sha1(c), 1, 10))
    label = part.select(F.lit("label").alias("source"), F.col("p_name").alias("medicinalproduct"), F.concat(second, F.lit(" sodium")).alias("ingredient_norm"), hashed("p_name").alias("unii"))
    ndc = part.select(F.lit("ndc"), "p_name", second, F.when(F.col("p_size") > 25, hashed("p_name")).otherwise(hashed("p_brand")))
    rx = part.filter(F.col("p_partkey") % 5 == 0).select(F.lit("rxnorm"), "p_name", F.element_at(F.split("p_name", " "), 1), F.lit(""))
    return label.union(ndc).union(rx)


def _dictionary(spark, d):
    return dic.build_dictionary(_rows(spark, d))


@query(f"WITH {_NAMES} SELECT id, name, {_NORM} AS normalized FROM names")
def normalize_query(spark, d):
    return _names(spark, d).select("id", "name", text.normalize_query(F.col("name")).alias("normalized"))


@query(f"SELECT p_partkey AS id, trim(regexp_replace(upper(trim(p_name || '  sodium CHLORIDE')), '\\s+', ' ', 'g')) AS squeezed, trim(regexp_replace(regexp_replace(upper(trim(p_name || '  sodium CHLORIDE')), '\\s+', ' ', 'g'), '(?: (?:{_SALTS}))+$', '')) AS ingredient FROM part")
def normalize_ingredient(spark, d):
    raw = F.concat(F.col("p_name"), F.lit("  sodium CHLORIDE"))
    return src.read(spark, d, "part").select(F.col("p_partkey").alias("id"), F.regexp_replace(F.upper(raw), r"\s+", " ").alias("squeezed"), text.normalize_ingredient(raw).alias("ingredient"))


@query("SELECT p_partkey AS id, lower(trim(regexp_replace(regexp_replace(' ,.' || p_name || '  X ;- ', '^[\\s.,;:\\-]+|[\\s.,;:\\-]+$', '', 'g'), '\\s+', ' ', 'g'))) AS key FROM part")
def canonical_key(spark, d):
    return src.read(spark, d, "part").select(F.col("p_partkey").alias("id"), text.canonical(F.concat(F.lit(" ,."), "p_name", F.lit("  X ;- "))).alias("key"))


@query(f"WITH {_DICT} SELECT * FROM dict")
def dictionary_build(spark, d):
    return _dictionary(spark, d)


@query(f"WITH {_DICT} SELECT source, product, s AS ingredient_set FROM ss")
def ingredient_set_build(spark, d):
    return dic.ingredient_sets(_rows(spark, d))


@query(f"WITH {_DICT} SELECT count(*) AS n, count(*) FILTER (contains(ingredient_set, ' ; ')) AS n_conflicts FROM dict")
def conflict_sets(spark, d):
    return _dictionary(spark, d).agg(F.count("*").alias("n"), F.count_if(F.col("ingredient_set").contains(" ; ")).alias("n_conflicts"))


_INDEX = f"{_DICT}, ix AS (SELECT key, list_sort(list_distinct(list(s))) AS sets FROM (SELECT upper(medicinalproduct) AS key, trim(unnest(string_split(ingredient_set, ' ; '))) AS s FROM dict UNION ALL SELECT upper(ingredient_norm), lower(ingredient_norm) FROM dict) GROUP BY 1)"
_LOOKED = f"""{_NAMES}, {_INDEX}, q AS (SELECT DISTINCT name, {_NORM} AS k1, {_NORM.replace('upper(name)', "upper(regexp_extract(name, '[[]([^][]+)[]]', 1))")} AS k2 FROM names),
hit AS (SELECT name, coalesce(array_to_string(i1.sets, ' ; '), array_to_string(i2.sets, ' ; '), array_to_string(i3.sets, ' ; ')) AS ingredient_set, CASE WHEN i1.key IS NOT NULL THEN 'name' WHEN i2.key IS NOT NULL THEN 'bracket' WHEN i3.key IS NOT NULL THEN 'combination' END AS via
 FROM q LEFT JOIN ix i1 ON i1.key = k1 LEFT JOIN ix i2 ON i2.key = k2 LEFT JOIN ix i3 ON i3.key = name)"""


def _looked(spark, d):
    return dic.lookup(_names(spark, d), _dictionary(spark, d))


@query(f"WITH {_LOOKED} SELECT id, n.name, n_reports, ingredient_set, via FROM names n JOIN hit h ON n.name = h.name")
def dictionary_lookup(spark, d):
    return _looked(spark, d)


@query(f"WITH {_LOOKED} SELECT count(*) AS n_names, CAST(sum(n_reports) AS BIGINT) AS n_reports, round(avg(CASE WHEN via IS NOT NULL THEN 1.0 ELSE 0.0 END), 9) AS name_coverage, round(sum(CASE WHEN via IS NOT NULL THEN n_reports ELSE 0 END) / sum(n_reports), 9) AS report_coverage FROM names n JOIN hit h ON n.name = h.name")
def coverage(spark, d):
    hit = F.when(F.col("via").isNotNull(), 1.0).otherwise(0.0)
    return _looked(spark, d).agg(F.count("*").alias("n_names"), F.sum("n_reports").alias("n_reports"), F.round(F.avg(hit), 9).alias("name_coverage"), F.round(F.sum(hit * F.col("n_reports")) / F.sum("n_reports"), 9).alias("report_coverage"))


@query(f"WITH {_NAMES}, g AS (SELECT name, n_reports, coalesce(nullif({_NORM}, ''), upper(trim(name))) AS normalized FROM names) SELECT 's3-' || left(sha1(normalized), 16) AS entity_id, normalized, string_agg(name, ';' ORDER BY n_reports DESC, name) AS raw_names, CAST(sum(n_reports) AS BIGINT) AS n_reports FROM g GROUP BY normalized")
def entity_group(spark, d):
    return dic.group_entities(_names(spark, d))


@query(f"WITH {_NAMES} SELECT DISTINCT upper(trim(name)) AS raw_drug_name, 's3-' || left(sha1(coalesce(nullif({_NORM}, ''), upper(trim(name)))), 16) AS entity_id FROM names")
def raw_entity_map(spark, d):
    return dic.raw_entity_map(_names(spark, d))


@query("SELECT p_brand, p_type, n FROM (SELECT p_brand, p_type, count(*) AS n, row_number() OVER (PARTITION BY p_brand ORDER BY count(*) DESC, p_type) AS k FROM part GROUP BY 1, 2) WHERE k = 1")
def mode_per_group(spark, d):
    return dic.mode_per_group(src.read(spark, d, "part"), "p_brand", "p_type")


@query("SELECT o_custkey AS entity_id, raw_drug_name, n_reports, resolved_stage FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY resolved_stage, n_reports DESC, raw_drug_name) AS k FROM (SELECT o_custkey, 'O' || o_orderkey AS raw_drug_name, o_orderkey % 100 AS n_reports, CAST(CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS INTEGER) AS resolved_stage FROM orders)) WHERE k = 1")
def priority_pick(spark, d):
    rows = src.read(spark, d, "orders").select(F.col("o_custkey").alias("entity_id"), F.concat(F.lit("O"), "o_orderkey").alias("raw_drug_name"), (F.col("o_orderkey") % 100).alias("n_reports"), "o_orderstatus")
    part = lambda s: rows.filter(F.col("o_orderstatus") == s).drop("o_orderstatus")
    return dic.merge_resolutions([(1, part("F")), (2, part("O")), (3, part("P"))])


@query(f"WITH {_NAMES}, c AS (SELECT unnest([1, 2, 3, 5, 10, 20, 50, 100, 200, 500, 1000, 2000, 5000]) AS cutoff) SELECT CAST(cutoff AS INTEGER) AS cutoff, count(*) FILTER (n_reports >= cutoff) AS n_names, CAST(coalesce(sum(n_reports) FILTER (n_reports >= cutoff), 0) AS BIGINT) AS n_reports, round(coalesce(sum(n_reports) FILTER (n_reports >= cutoff), 0) * 100.0 / sum(n_reports), 9) AS coverage FROM names, c GROUP BY cutoff")
def cutoff_curve(spark, d):
    return dic.cutoff_curve(_names(spark, d)).withColumn("coverage", F.round("coverage", 9))


# names to triage: suffixes that put a third of them out of scope
_TRIAGED = "SELECT p_partkey AS id, p_size AS n_reports, CASE p_partkey % 6 WHEN 0 THEN upper(p_name) || ' NOS' WHEN 1 THEN 'VITAMINS' WHEN 2 THEN 'EYE DROPS' WHEN 3 THEN 'FACE WASH ' || upper(p_name) ELSE upper(p_name) END AS name FROM part"


@query(f"SELECT bucket, coalesce(reason, '') AS reason, count(*) AS n_names, CAST(sum(n_reports) AS BIGINT) AS n_reports FROM (SELECT n_reports, CASE WHEN name = 'EYE DROPS' THEN 'class/form' WHEN regexp_matches(name, '\\bNOS\\b') THEN 'NOS' WHEN name = 'VITAMINS' THEN 'prod_ai_exclude' WHEN name LIKE 'FACE WASH %' THEN 'cosmetic' END AS reason, CASE WHEN reason IS NOT NULL THEN 'OUT_OF_SCOPE' ELSE 'UNKNOWN' END AS bucket FROM ({_TRIAGED})) GROUP BY 1, 2")
def triage_buckets(spark, d):
    up, k = F.upper("p_name"), F.col("p_partkey") % 6
    name = F.when(k == 0, F.concat(up, F.lit(" NOS"))).when(k == 1, "VITAMINS").when(k == 2, "EYE DROPS").when(k == 3, F.concat(F.lit("FACE WASH "), up)).otherwise(up)
    rows = src.read(spark, d, "part").select(name.alias("name"), F.col("p_size").alias("n_reports")).withColumn("reason", rules.out_of_scope_reason(F.col("name")))
    bucket = F.when(F.col("reason").isNotNull(), "OUT_OF_SCOPE").otherwise("UNKNOWN")
    return rows.groupBy(bucket.alias("bucket"), F.coalesce("reason", F.lit("")).alias("reason")).agg(F.count("*").alias("n_names"), F.sum("n_reports").alias("n_reports"))


@query()
def renormalize_resolve(spark, d):
    return dic.renormalize(_names(spark, d), dic.key_index(_dictionary(spark, d)))


@query()
def block_similarity(spark, d):
    names = _names(spark, d).select(F.regexp_replace("name", "E", "EE").alias("name"))
    entries = _dictionary(spark, d)
    candidates = entries.select(F.col("medicinalproduct").alias("candidate")).union(entries.select("ingredient_norm"))
    return sim.accept(sim.blocked_matches(names, candidates, threshold=80.0), entries, threshold=80.0, short_threshold=90.0)


@query(f"WITH {_DICT}, al AS (SELECT alias, min(o) AS o FROM (SELECT upper(medicinalproduct) AS alias, 1 AS o FROM dict UNION ALL SELECT upper(ingredient_norm), 2 FROM dict UNION ALL SELECT upper(unnest(string_split(replace(ingredient_set, ' ; ', '|'), '|'))), 3 FROM dict) WHERE alias <> '' GROUP BY 1) SELECT alias, CAST(o AS INTEGER) AS field FROM al")
def alias_corpus(spark, d):
    """Aliases with the first field they occur in: product, ingredient, element of a set."""
    x = _dictionary(spark, d)
    parts = F.split(F.replace("ingredient_set", F.lit(" ; "), F.lit("|")), "[|]")
    tries = F.concat(F.array(F.struct(F.upper("medicinalproduct").alias("alias"), F.lit(1).alias("field")), F.struct(F.upper("ingredient_norm").alias("alias"), F.lit(2).alias("field"))), F.transform(parts, lambda p: F.struct(F.upper(p).alias("alias"), F.lit(3).alias("field"))))
    return x.select(F.inline(tries)).filter("alias <> ''").groupBy("alias").agg(F.min("field").alias("field"))


_REPLY = "CASE p_partkey % 6 WHEN 0 THEN '{\"decision\": \"MATCH\", \"candidate_ids\": [' || (p_size % 4) || ']}' WHEN 1 THEN 'sure: {\"decision\": \"multi\", \"candidate_ids\": [1, 2]} ok' WHEN 2 THEN '{\"decision\": \"NONE\", \"candidate_ids\": []}' WHEN 3 THEN 'no idea' WHEN 4 THEN '{\"decision\": \"MAYBE\", \"candidate_ids\": []}' ELSE '{\"decision\": \"MULTI\", \"candidate_ids\": [1]}' END"


@query("SELECT p_partkey AS id, CASE p_partkey % 6 WHEN 0 THEN CASE WHEN p_size % 4 BETWEEN 1 AND 3 THEN 'MATCH' ELSE 'NONE' END WHEN 1 THEN 'MULTI' ELSE 'NONE' END AS decision, CASE p_partkey % 6 WHEN 0 THEN CASE WHEN p_size % 4 = 0 THEN 'bad_id' END WHEN 3 THEN 'no_json' WHEN 4 THEN 'bad_decision' WHEN 5 THEN 'bad_arity' END AS reason FROM part")
def decision_parse(spark, d):
    parsed = rules.parse_decision(F.expr(_REPLY), F.lit(3))
    return src.read(spark, d, "part").select(F.col("p_partkey").alias("id"), parsed.alias("p")).select("id", "p.decision", "p.reason")


@query("SELECT p_type, count(*) AS n, round(avg(CASE WHEN p_partkey % 6 < 2 THEN 1.0 ELSE 0.0 END), 9) AS decided_rate, round(avg(CASE WHEN p_partkey % 6 = p_size % 6 THEN 1.0 ELSE 0.0 END), 9) AS accuracy FROM part GROUP BY 1")
def decision_eval(spark, d):
    mean = lambda c: F.round(F.avg(F.when(c, 1.0).otherwise(0.0)), 9)
    return src.read(spark, d, "part").groupBy("p_type").agg(F.count("*").alias("n"), mean(F.col("p_partkey") % 6 < 2).alias("decided_rate"), mean(F.col("p_partkey") % 6 == F.col("p_size") % 6).alias("accuracy"))
