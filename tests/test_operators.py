import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F
from sigforge.operators import contracts, dictionary, labels, ranking, similarity, tables
from sigforge.session import s3_credentials
from sigforge.sources import delimited, flatten
from sigforge.streaming.ingest import load_stream

DICT = "medicinalproduct string, ingredient_norm string, ingredient_set string, unii string"


@pytest.fixture(scope="module")
def known(spark):
    rows = [
        ("HUMIRA", "ADALIMUMAB", "adalimumab", "FYS6T7F842"), ("NORVASC", "AMLODIPINE", "amlodipine", "1J444QC288"), ("COMBOCARE", "AMLODIPINE", "amlodipine|losartan", ""), ("COMBOCARE", "LOSARTAN", "amlodipine|losartan", ""),
        ("INSUPROD", "INSULIN LISPRO", "insulin lispro|water ; insulin lispro", ""), ("SOLUMEDROL", "METHYLPREDNISOLONE", "methylprednisolone", ""),
    ]
    return spark.createDataFrame(rows, DICT)


def test_lookup(spark, known):
    names = spark.createDataFrame([("Humira 40 mg", None), ("XYZ [LOSARTAN]", None), ("UNKNOWN", "LOSARTAN POTASSIUM"), ("NOTHING", "COSMETICS"), (None, None), ("", "")], "name string, prod_ai string")
    got = {r.name: (r.ingredient_set, r.via) for r in dictionary.lookup(names, known, prod_ai="prod_ai").collect()}
    assert got == {"Humira 40 mg": ("adalimumab", "name"), "XYZ [LOSARTAN]": ("losartan", "bracket"), "UNKNOWN": ("losartan", "prod_ai"), "NOTHING": (None, None), None: (None, None), "": (None, None)}


def test_renormalize(spark, known):
    names = spark.createDataFrame([(n,) for n in ("HUMIRA 40 MG/0.8 ML PEN", "FOO (AMLODIPINE)", "AMLODIPINE WITH FOO 5 MG", "ZZZ 5 MG", "HUMIRA (AMLODIPINE)", "A\\B")], "name string")
    got = {r.name: (r.status, r.ingredient_set) for r in dictionary.renormalize(names, dictionary.key_index(known)).collect()}
    assert got["HUMIRA 40 MG/0.8 ML PEN"] == ("RESOLVED", "adalimumab") and got["FOO (AMLODIPINE)"] == ("RESOLVED", "amlodipine")
    assert got["HUMIRA (AMLODIPINE)"][0] == "CONFLICT" and got["ZZZ 5 MG"][0] == got["A\\B"][0] == "MISS" and got["AMLODIPINE WITH FOO 5 MG"][0] in ("MISS", "CONFLICT")


def test_similarity(spark, known):
    candidates = known.select(F.col("medicinalproduct").alias("candidate")).union(known.select("ingredient_norm"))
    names = spark.createDataFrame([(n,) for n in ("SOLU-MEDROL", "METHYLPREDNISOLON", "INSULIN LISPRA", "ADALIMUMABB")], "name string")
    got = {r.name: r for r in similarity.accept(similarity.blocked_matches(names, candidates), known).collect()}
    assert got["METHYLPREDNISOLON"].reject_reason is None and got["METHYLPREDNISOLON"].ingredient_set == "methylprednisolone"
    assert got["SOLU-MEDROL"].candidate == "SOLUMEDROL" and got["SOLU-MEDROL"].reject_reason is None
    assert got["ADALIMUMABB"].candidate == "ADALIMUMAB"


def test_nearest(spark):
    rng = np.random.default_rng(0)
    v = rng.normal(size=(60, 8))
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "id long, vector array<double>")
    got = {}
    for r in similarity.nearest_vectors(df.filter("id < 7"), df, k=4, block=3).collect():
        got.setdefault(r.query, []).append((r.rank, r.id))
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    for q in range(7):
        assert [i for _, i in sorted(got[q])] == np.argsort(-(u @ u[q]), kind="stable")[:4].tolist()
    assert similarity.nearest_vectors(df.limit(0), df).collect() == []


def _pairs(spark, n_pos, n_neg, n_other, shift, seed=0, order=1):
    rng = np.random.default_rng(seed)
    rows = []
    for k in range(n_pos + n_neg + n_other):
        label = 1 if k < n_pos else 0 if k < n_pos + n_neg else None
        rows.append((f"i{k}", "p", 5, float(rng.normal(shift if label == 1 else 0)), float(rng.normal(shift if label == 1 else 0)), label))
    return spark.createDataFrame(rows[::order], "ingredient string, pt string, a int, ic025 double, death_frac double, label int")


def test_crossfit_separates_and_ignores_row_order(spark):
    a, b = (ranking.build_ranking(_pairs(spark, 30, 30, 100, 3.0, order=o), "v3").collect() for o in (1, -1))
    assert {(r.ingredient, r.rank) for r in a} == {(r.ingredient, r.rank) for r in b}
    mean = lambda rows, x: np.mean([r.rank for r in rows if r.label == x])
    assert mean(a, 1) < 40 < mean(a, 0)


def test_crossfit_falls_back(spark):
    got = ranking.build_ranking(_pairs(spark, 1, 5, 5, 0.0), "v3").orderBy("rank").collect()
    assert [r.ic025 for r in got] == sorted((r.ic025 for r in got), reverse=True)
    with pytest.raises(ValueError, match="recency"):
        ranking.build_ranking(_pairs(spark, 1, 1, 1, 0.0), "v5")


def test_background_negatives(spark):
    got = ranking.crossfit(_pairs(spark, 10, 2, 60, 2.0), ("ic025", "death_frac"), background=3.0).groupBy("label").count().collect()
    assert {r[0]: r[1] for r in got} == {1: 10, 0: 32, None: 30}


def test_scorecard_and_recall(spark):
    ranked = spark.createDataFrame([("a", "x", 1), ("b", "x", 2), ("c", "x", 3), ("a", "x", 4), ("d", "x", 5)], "ingredient string, pt string, rank int")
    gold = spark.createDataFrame([("b", "x", 1), ("d", "x", 1), ("zz", "x", 1), ("a", "x", 0)], "ingredient string, pt string, label int")
    card = {r.k: r for r in ranking.scorecard(ranked, gold, ks=(2, 10)).collect()}
    assert (card[2].n, card[2].n_pos, card[2].hits, card[2].recall, card[2].precision, card[2].lift) == (4, 2, 1, 0.5, 0.5, 1.0)
    assert card[10].precision == 0.5 and card[10].review_reduction == 0.0
    assert ranking.k_for_recall(ranked, gold, 0.5).first().k == 2 and ranking.k_for_recall(ranked, gold.limit(0), 0.5).first().k is None


def test_first_detection_and_lead(spark):
    rows = [(f"c{k}", "drug", "rash", 10 + k) for k in range(6)] + [(f"n{k}", "other", "cough", 10 + k % 6) for k in range(60)]
    got = labels.first_detection(spark.createDataFrame(rows, "caseid string, ingredient string, pt string, period int"), least=3, above=-5.0)
    found = {(r.ingredient, r.pt): r.first_period for r in got.collect()}
    assert found["drug", "rash"] == 12
    actions = spark.createDataFrame([("drug", "rash", 15), ("drug", "rash", 14), ("new", "x", 3)], "ingredient string, pt string, action_period int")
    lead = {r.ingredient: r.lead for r in labels.lead_time(got, actions).collect()}
    assert lead == {"drug": 2, "new": None}
    s = labels.lead_summary(labels.lead_time(got, actions)).first()
    assert (s.n, s.n_ever, s.n_before, s.rate, s.median_lead, s.max_lead) == (2, 1, 1, 0.5, 2.0, 2)


def test_resolutions_and_curves(spark):
    one = spark.createDataFrame([("e1", "A", 5, "확정"), ("e1", "B", 9, "확정"), ("e2", "C", 1, "보류")], "entity_id string, raw_drug_name string, n_reports int, resolution_status string")
    two = spark.createDataFrame([("e2", "D", 100, "확정")], one.schema)
    got = {r.entity_id: (r.raw_drug_name, r.resolved_stage) for r in dictionary.merge_resolutions([(1, one), (2, two)]).collect()}
    assert got == {"e1": ("B", 1), "e2": ("C", 1)}
    curve = {r.cutoff: (r.n_names, r.n_reports) for r in dictionary.cutoff_curve(spark.createDataFrame([("A", 1), ("B", 2), ("C", 5), ("D", 50)], "name string, n_reports int")).collect()}
    assert curve[1] == (4, 58) and curve[5] == (2, 55) and curve[100] == (0, 0)
    assert contracts.columns(one, {"entity_id": "int"}, ("entity_id",), ("entity_id",)) == ["entity_id: string instead of int", "entity_id: not unique"]


def _zip(folder, name, text):
    with zipfile.ZipFile(folder / name, "w") as z:
        z.writestr("ascii/DEMO20Q1.TXT", text)
    return name


def test_load_restarts_without_duplicates(spark, tmp_path):
    (tmp_path / "in").mkdir()
    _zip(tmp_path / "in", "a.zip", "﻿primaryid$gndr_cod$x\r\n1$M$\r\n2$F\r\n\r\n3$F$y$z\r\n")
    _zip(tmp_path / "in", "b.zip", "primaryid$sex$x\n7$M$q\n")
    args = (f"{tmp_path}/in/*.zip", "DEMO", ["primaryid", "sex", "age"], f"{tmp_path}/out", f"{tmp_path}/rejects")
    manifest = delimited.Manifest(spark, f"{tmp_path}/manifest", "test")
    assert delimited.load(spark, *args, manifest) == 2 and delimited.load(spark, *args, manifest) == 0
    manifest.write("c.zip", "DEMO", "in_progress")  # broke off
    _zip(tmp_path / "in", "c.zip", "primaryid$sex\n9$M\n")
    tables.append(spark.createDataFrame([("9", "M", None, "c.zip")], "primaryid string, sex string, age string, source_zip string"), f"{tmp_path}/out", "source_zip")
    assert delimited.load(spark, *args, manifest) == 1 and manifest.status("c.zip", "DEMO") == "complete"
    got = sorted((r.primaryid, r.sex, r.age, r.source_zip) for r in spark.read.parquet(f"{tmp_path}/out").collect())
    assert got == [("1", "M", None, "a.zip"), ("7", "M", None, "b.zip"), ("9", "M", None, "c.zip")]
    bad = sorted((r.line_no, r.expected_cols, r.actual_cols, r.raw_line) for r in spark.read.parquet(f"{tmp_path}/rejects").collect())
    assert bad == [(3, 3, 2, "2$F"), (5, 3, 4, "3$F$y$z")]


def test_legacy_lines(spark):
    lines = spark.createDataFrame([(1, "a$b$"), (2, "a$b"), (3, "a$b$c$")], "line_no int, raw_line string")
    good, bad = delimited.classify(lines, ["x", "y"], legacy=True)
    assert good.count() == 2 and [r.line_no for r in bad.collect()] == [3]
    assert delimited.unknown_columns(["﻿ISR", " Foo", "gndr_cod"], ["isr", "sex"], {"gndr_cod": "sex"}) == ["foo"]


def test_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/1.txt").write_text("1$a\n2\n")
    args = dict(header=["k", "v"], columns=["k", "v"], out=f"{tmp_path}/out", rejects=f"{tmp_path}/bad", checkpoint=f"{tmp_path}/cp")
    load_stream(spark, f"{tmp_path}/in", **args).awaitTermination()
    (tmp_path / "in/2.txt").write_text("3$c\n")
    load_stream(spark, f"{tmp_path}/in", **args).awaitTermination()
    assert sorted(r.k for r in spark.read.parquet(f"{tmp_path}/out").collect()) == ["1", "3"] and spark.read.parquet(f"{tmp_path}/bad").count() == 1


def test_tables(spark, tmp_path):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    source = spark.createDataFrame([(2, "c", 1.0), (3, "d", 2.0)], "k int, v string, w double")
    assert sorted(map(tuple, tables.upsert(target, source, ["k"]).collect())) == [(1, "a", None), (2, "c", 1.0), (3, "d", 2.0)]
    tables.append(target, f"{tmp_path}/t")
    tables.append(target, f"{tmp_path}/t")
    tables.compact(spark, f"{tmp_path}/t", f"{tmp_path}/u")
    assert spark.read.parquet(f"{tmp_path}/u").count() == 4 and tables.dedupe(spark.read.parquet(f"{tmp_path}/u")).count() == 2
    tables.export_csv(target, f"{tmp_path}/csv")
    assert spark.read.option("header", True).csv(f"{tmp_path}/csv").count() == 2


def test_flatten(spark):
    records = spark.createDataFrame([(["A", "B"], ["x", "y"], ["U1"]), ([], ["x"], [])], "brands array<string>, substances array<string>, uniis array<string>")
    assert sorted(map(tuple, flatten.label_pairs(records).fillna("-").collect())) == [("A", "x", "U1"), ("A", "y", "-"), ("B", "x", "U1"), ("B", "y", "-")]
    parts = spark.createDataFrame([("P", "a/b", 2), ("Q", "a/b", 1), ("R", "NA;c; ", 1)], "p string, i string, n int")
    assert sorted(map(tuple, flatten.declared_parts(parts.filter("p <> 'R'"), "p", "i", "n").collect())) == [("P", "a"), ("P", "b"), ("Q", "a/b")]
    assert [tuple(r) for r in flatten.semicolon_parts(parts.filter("p = 'R'"), "p", "i").collect()] == [("R", "c")]


def test_credentials():
    assert "DefaultAWS" in next(iter(s3_credentials({}).values()))
    assert len(s3_credentials({"AWS_ACCESS_KEY_ID": "a", "AWS_SECRET_ACCESS_KEY": "b", "AWS_SESSION_TOKEN": "c"})) == 4
    with pytest.raises(ValueError):
        s3_credentials({"AWS_ACCESS_KEY_ID": "a"})


def test_entry_points():
    import __spark_entry__

    q, sql = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    assert "signal_scores" in q and set(sql) <= set(q)

