import difflib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from sigforge.functions import rules, text

NAMES = [
    ("DURAGESIC-100", "DURAGESIC"), ("LISINOPRIL TABLETS USP, 20MG", "LISINOPRIL"), ("AZITHROMYCIN ANHYDROUS", "AZITHROMYCIN"), ("aspirin 500 mg.", "ASPIRIN"),
    ("ALEVE", "ALEVE"), ("NAPROXEN SODIUM 220 MG", "NAPROXEN"), ("FOO /00002701/", "FOO"), ("SODIUM", "SODIUM"), ("SODIUM TABLET", "SODIUM"), ("BAR POUDRE POUR SOLUTION INJECTABLE", "BAR"), ("VITAMIN B-12", "VITAMIN B"),
]
SCOPE = [
    ("INSULIN NOS", "NOS"), ("ANTIHISTAMINES", "class/form"), ("VITAMINS", "prod_ai_exclude"), ("MULTIVITAMINS", "vitamin_class"), ("PROACTIV FACE WASH", "cosmetic"),
    ("VITAMIN B-12", None), ("VITAMIN D", None), ("CLEANSER WITH BENZOYL PEROXIDE 1%", None), ("NOSCAPINE", None), ("ESTROGEN NOS;METHYLTESTOSTERONE", None), ("HUMIRA", None),
]


def column(spark, values, f):
    rows = spark.createDataFrame([(i, *(v if isinstance(v, tuple) else (v,))) for i, v in enumerate(values)], "i int, a string" + ", b string" * (values and isinstance(values[0], tuple)))
    return [r[0] for r in rows.orderBy("i").select(f).collect()]


def test_normalize_query(spark):
    assert column(spark, [n for n, _ in NAMES], text.normalize_query(F.col("a"))) == [x for _, x in NAMES]


def test_scope(spark):
    assert column(spark, [n for n, _ in SCOPE], rules.out_of_scope_reason(F.col("a"))) == [x for _, x in SCOPE]


def test_ingredients(spark):
    got = column(spark, ["  abacavir   sulfate", "X SODIUM PHOSPHATE", "SODIUM"], text.normalize_ingredient(F.col("a")))
    assert got == ["ABACAVIR", "X", "SODIUM"]
    got = column(spark, ["ABACAVIR SULFATE\\LAMIVUDINE", "AMINO ACIDS\\ELECTROLYTES NOS\\SOYBEAN OIL", "COSMETICS", "", None, "ST. JOHN^S WORT"], text.resolve_prod_ai(F.col("a")))
    assert got == ["abacavir|lamivudine", "amino acids|soybean oil", None, None, None, "st. john's wort"]


def test_small_functions(spark):
    assert column(spark, ["ALBUTEROL [SALBUTAMOL]", "X"], text.bracket_alt(F.col("a"))) == ["SALBUTAMOL", None]
    assert column(spark, [" .Ｆoo  Bar,-", None], text.canonical(F.col("a"), unicode=True)) == ["foo bar", ""]
    assert column(spark, ["LISINOPRIL HYDRO", "HYDRO LISINOPRIL"], text.block_key(F.col("a"))) == ["H", "H"]
    pairs = [("VITAMIN B-12", "VITAMIN B6"), ("VITAMIN B 12", "VITAMIN B12"), ("TAB 12", "B12"), ("FACTOR I", "FACTOR IX"), ("ANTITHROMBINIII", "ANTITHROMBIN III"), ("PARAGARD 380A", "PARAGARD")]
    assert column(spark, pairs, text.designator_mismatch(F.col("a"), F.col("b"))) == [True, False, True, True, False, False]
    assert column(spark, ["EYE DROPS", "FLUTICASONE NASAL SPRAY", "12", "LAXATIVE 12 HOUR"], text.class_or_form_only(F.col("a"))) == [True, False, True, True]
    assert column(spark, ["hypocalcemia", "anemia", "hemorrhage", "paralyzed"], text.british(F.col("a"))) == ["hypocalcaemia", "anaemia", "haemorrhage", "paralysed"]


def test_ratio(spark):
    assert round(text.indel_ratio("INSULIN", "INULIN"), 1) == 92.3
    assert column(spark, [("A B", "B A"), ("X", None)], text.token_sort_ratio("a", "b")) == [100.0, None]


@settings(max_examples=100, deadline=None)
@given(st.text("abc", max_size=12), st.text("abc", max_size=12))
def test_ratio_is_longest_common_subsequence(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(new[j], row[j + 1]))
        row = new
    assert text.indel_ratio(a, b) == pytest.approx(200 * row[-1] / (len(a) + len(b)) if a or b else 100)
    assert text.indel_ratio(a, b) >= 100 * difflib.SequenceMatcher(None, a, b).ratio() - 1e-9


def test_decisions(spark):
    replies = ['{"decision":"MATCH","candidate_ids":[2],"note":"x"}', '```json\n{"decision":"multi","candidate_ids":[1,3]}\n```', '{"decision":"MATCH","candidate_ids":[9]}', "none", '{"decision":"NONE","candidate_ids":[1]}', None]
    rows = spark.createDataFrame([(i, r) for i, r in enumerate(replies)], "i int, r string").orderBy("i")
    got = [(r.p.decision, r.p.candidate_ids, r.p.reason) for r in rows.select(rules.parse_decision(F.col("r"), F.lit(3)).alias("p")).collect()]
    assert got == [("MATCH", [2], None), ("MULTI", [1, 3], None), ("NONE", [], "bad_id"), ("NONE", [], "no_json"), ("NONE", [], "bad_arity"), ("NONE", [], "no_json")]


def test_report_labels(spark):
    rows = [
        ("Foo (bar) tablets", "The labeling was updated.", "양성"), ("Foo", "FDA decided that no action is necessary at this time.", "음성"), ("Foo", "FDA is evaluating the need for regulatory action.", "보류"),
        ("Foo", "The Foo labeling was updated. No action is necessary for Baz.", "양성"), ("Baz", "The Foo labeling was updated. No action is necessary for Baz.", "음성"), ("Foo", None, "보류"),
    ]
    got = spark.createDataFrame(rows, "p string, i string, e string").select(rules.classify_report(F.col("p"), F.col("i")).alias("l"), "e").collect()
    assert all(r.l == r.e for r in got)
