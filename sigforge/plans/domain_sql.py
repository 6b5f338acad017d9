"""SQL of the domain frames, as common table expressions over the driver's tables."""

from __future__ import annotations

DOMAIN = """
demo AS (SELECT o_orderkey AS primaryid, o_orderkey // 2 AS caseid, CAST(o_orderkey % 2 + 1 AS INTEGER) AS caseversion, strftime(o_orderdate, '%Y%m%d') AS fda_dt FROM orders),
line AS (SELECT l.*, p.p_name || ' ' || p.p_type AS drugname FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey),
drug AS (SELECT l_orderkey AS primaryid, l_linenumber AS drug_seq, CASE l_returnflag WHEN 'R' THEN 'PS' WHEN 'A' THEN 'SS' ELSE 'C' END AS role_cod, drugname FROM line),
flags AS (SELECT l_orderkey AS primaryid, l_linenumber AS drug_seq, CASE WHEN l_linestatus = 'O' THEN 'Y' ELSE 'N' END AS dechal, CASE WHEN l_partkey % 3 = 0 THEN '' WHEN l_partkey % 2 = 0 THEN 'Y' ELSE 'N' END AS rechal FROM line),
reac AS (SELECT l_orderkey AS primaryid, n_name AS pt FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey),
outc AS (SELECT o_orderkey AS primaryid, CASE left(o_orderpriority, 1) WHEN '1' THEN 'DE' WHEN '2' THEN 'LT' WHEN '3' THEN 'HO' ELSE 'OT' END AS outc_cod FROM orders WHERE left(o_orderpriority, 1) <> '5'),
known AS (SELECT DISTINCT upper(trim(p_name || ' ' || p_type)) AS raw_drug_name,
  CASE WHEN p_type = 'LARGE' THEN '' WHEN p_type IN ('PROMO', 'SMALL') THEN split_part(lower(p_name), ' ', 2)
       ELSE array_to_string(list_sort(list_distinct(string_split(lower(p_name), ' '))), '|') END AS ingredient_set FROM part),
names AS (SELECT raw_drug_name, 's3-' || left(sha1(raw_drug_name), 16) AS entity_id, ingredient_set,
  CASE WHEN ingredient_set = '' OR contains(ingredient_set, '|') THEN '' ELSE upper(left(sha1(ingredient_set), 10)) END AS unii FROM known)"""

FACT = (
    DOMAIN
    + """,
fact AS (SELECT CAST(caseid AS VARCHAR) AS caseid, CAST(d.primaryid AS VARCHAR) AS primaryid, CAST(drug_seq AS INTEGER) AS drug_seq, caseversion, fda_dt, role_cod, drugname,
  coalesce(ingredient_set, '') AS ingredient_set, coalesce(unii, '') AS unii, pt
  FROM (SELECT DISTINCT * FROM drug) d JOIN (SELECT DISTINCT * FROM reac) r ON d.primaryid = r.primaryid JOIN demo m ON d.primaryid = m.primaryid
  LEFT JOIN names n ON upper(trim(d.drugname)) = n.raw_drug_name)"""
)


def scores(where: str = "TRUE") -> str:
    """CTEs up to `scores`, from reports that satisfy `where`, with the latest version by self join."""
    return (
        FACT
        + f""",
seen AS (SELECT * FROM fact WHERE {where}),
latest AS (SELECT f.* FROM seen f JOIN (SELECT caseid, max(caseversion) AS v FROM seen GROUP BY caseid) m ON f.caseid = m.caseid AND f.caseversion = m.v),
used AS (SELECT DISTINCT caseid, unnest(string_split(ingredient_set, '|')) AS ingredient, contains(ingredient_set, '|') AS is_combo FROM latest WHERE role_cod IN ('PS', 'SS') AND ingredient_set <> ''),
case_reac AS (SELECT DISTINCT caseid, pt FROM latest WHERE pt <> ''),
drugs AS (SELECT ingredient, count(DISTINCT caseid) AS ab, count(DISTINCT CASE WHEN NOT is_combo THEN caseid END) AS solo_n, count(DISTINCT CASE WHEN is_combo THEN caseid END) AS combo_n FROM used GROUP BY 1),
reacs AS (SELECT pt, count(DISTINCT caseid) AS ac FROM case_reac GROUP BY 1),
total AS (SELECT count(DISTINCT caseid) AS n FROM latest),
pairs AS (SELECT ingredient, pt, count(DISTINCT u.caseid) AS a FROM used u JOIN case_reac r ON u.caseid = r.caseid GROUP BY 1, 2),
scores AS (SELECT *, ic - 3.3 * pow(a + 0.5, -0.5) - 2 * pow(a + 0.5, -1.5) AS ic025 FROM (
  SELECT ingredient, pt, a, ab, ac, n, log2((a + 0.5) / (CAST(ab AS DOUBLE) * ac / n + 0.5)) AS ic,
    CAST(a AS DOUBLE) * (n - ab - ac + a) / nullif(CAST(ab - a AS DOUBLE) * (ac - a), 0) AS ror,
    (CAST(a AS DOUBLE) / nullif(ab, 0)) / nullif(CAST(ac - a AS DOUBLE) / nullif(n - ab, 0), 0) AS prr, solo_n, combo_n
  FROM pairs JOIN drugs USING (ingredient) JOIN reacs USING (pt) CROSS JOIN total))"""
    )


FEATURES = """,
case_out AS (SELECT CAST(primaryid AS VARCHAR) AS primaryid, max(CASE WHEN outc_cod = 'DE' THEN 1 ELSE 0 END) AS is_death, max(CASE WHEN outc_cod IN ('DE', 'LT', 'HO', 'DS', 'CA', 'RI') THEN 1 ELSE 0 END) AS is_serious FROM outc GROUP BY 1),
cases AS (SELECT caseid, max(coalesce(is_death, 0)) AS is_death, max(coalesce(is_serious, 0)) AS is_serious, max(try_strptime(fda_dt, '%Y%m%d')) AS fda_date
  FROM (SELECT DISTINCT caseid, primaryid, fda_dt FROM latest) LEFT JOIN case_out USING (primaryid) GROUP BY 1),
flag_max AS (SELECT CAST(primaryid AS VARCHAR) AS primaryid, drug_seq, max(CASE WHEN dechal = 'Y' THEN 1 ELSE 0 END) AS dechal_y, max(CASE WHEN rechal = 'Y' THEN 1 ELSE 0 END) AS rechal_y,
  max(CASE WHEN dechal IN ('Y', 'N') THEN 1 ELSE 0 END) AS dechal_known, max(CASE WHEN rechal IN ('Y', 'N') THEN 1 ELSE 0 END) AS rechal_known FROM flags GROUP BY 1, 2),
case_drug AS (SELECT caseid, ingredient, max(coalesce(dechal_y, 0)) AS dechal_y, max(coalesce(rechal_y, 0)) AS rechal_y, max(coalesce(dechal_known, 0)) AS dechal_known, max(coalesce(rechal_known, 0)) AS rechal_known
  FROM (SELECT DISTINCT caseid, primaryid, drug_seq, unnest(string_split(ingredient_set, '|')) AS ingredient FROM latest WHERE role_cod IN ('PS', 'SS') AND ingredient_set <> '') u
  LEFT JOIN flag_max f USING (primaryid, drug_seq) GROUP BY 1, 2),
features AS (SELECT ingredient, pt, count(*) AS a, avg(is_death) AS death_frac, avg(is_serious) AS serious_frac, avg(dechal_y) AS dechal_frac, avg(rechal_y) AS rechal_frac,
  CAST(sum(dechal_known) AS BIGINT) AS dechal_known_n, CAST(sum(rechal_known) AS BIGINT) AS rechal_known_n,
  avg(CASE WHEN fda_date >= (SELECT max(fda_date) - INTERVAL 2 YEAR FROM cases) THEN 1.0 ELSE 0.0 END) AS recency
  FROM case_drug JOIN case_reac USING (caseid) JOIN cases USING (caseid) GROUP BY 1, 2)"""
