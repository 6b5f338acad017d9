"""Rankings of pairs, cross-fitted scores, and their evaluation."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

FEATURES = {
    "v1": (), "v1e": (), "v2": (), "v3": ("ic025", "death_frac"), "v4": ("ic025", "death_frac", "dechal_frac", "rechal_frac"),
    "v5": ("ic025", "death_frac", "dechal_frac", "rechal_frac", "recency"),
}


def rank(pairs: DataFrame, score: str) -> DataFrame:
    """rank from 1 by score, then ic025, both descending, then ingredient and pt. Rankings are as long as the vocabulary of pairs."""
    order = Window.orderBy(F.desc(score), F.desc("ic025"), "ingredient", "pt")
    return pairs.withColumn("rank", F.row_number().over(order))


def key_order():
    """Hash of the pair, for an order that doesn't depend on the rows' order."""
    return F.sha2(F.concat_ws("\x1f", "ingredient", "pt"), 256)


def folds(pairs: DataFrame, k: int, label: str = "label") -> DataFrame:
    """fold by turns in the hash order, apart for each label (null: unlabelled)."""
    turn = F.row_number().over(Window.partitionBy(label).orderBy("_h", "ingredient", "pt"))
    return pairs.withColumn("_h", key_order()).withColumn("fold", ((turn - 1) % k).cast("int")).drop("_h")


def fold_percentile(scored: DataFrame, score: str = "score") -> DataFrame:
    """Average rank within the fold as a share: ties share the mean of their places."""
    by = Window.partitionBy("fold")
    place = F.rank().over(by.orderBy(score)) + (F.count("*").over(Window.partitionBy("fold", score)) - 1) / 2.0
    return scored.withColumn("percentile", place / F.count("*").over(by))


def fit_logistic(x: np.ndarray, y: np.ndarray, l2: float = 1.0, steps: int = 3000, rate: float = 0.5):
    """(weights, constant, mean, deviation) on standardised features, by full gradient steps; no penalty on the constant."""
    mean, deviation = x.mean(0), x.std(0)
    deviation = np.where(deviation == 0, 1.0, deviation)
    z = (x - mean) / deviation
    w, b, n = np.zeros(x.shape[1]), 0.0, len(y)
    for _ in range(steps):
        g = 1 / (1 + np.exp(-np.clip(z @ w + b, -30, 30))) - y
        w, b = w - rate * (z.T @ g / n + l2 * w / n), b - rate * g.mean()
    return w, b, mean, deviation


def crossfit(pairs: DataFrame, features: tuple[str, ...], most_folds: int = 5, l2: float = 1.0, background: float = 0.0) -> DataFrame:
    """`pairs` (label 1, 0 or null) with fold and score: each fold scored by a model of the other folds' labels, as a percentile in the fold.

    background: so many unlabelled pairs for each positive join the negatives, the first in hash order.
    With fewer than two labels of a kind ic025 is the score. Only labelled rows come to the driver.
    """
    rows = pairs.withColumns({f: F.coalesce(F.nanvl(F.col(f).cast("double"), F.lit(0.0)), F.lit(0.0)) for f in features})
    counts = {r[0]: r[1] for r in rows.groupBy("label").count().collect()}
    if background > 0 and counts.get(1):
        extra = rows.filter("label IS NULL").orderBy(key_order(), "ingredient", "pt").limit(int(round(counts[1] * background))).select("ingredient", "pt", F.lit(0).alias("_bg"))
        rows = rows.join(F.broadcast(extra), ["ingredient", "pt"], "left").withColumn("label", F.coalesce("label", "_bg")).drop("_bg")
        counts = {r[0]: r[1] for r in rows.groupBy("label").count().collect()}
    if counts.get(1, 0) < 2 or counts.get(0, 0) < 2:
        return rows.withColumn("fold", F.lit(0)).withColumn("score", F.col("ic025").cast("double"))
    k = max(2, min(most_folds, counts[1], counts[0]))
    rows = folds(rows, k)
    labelled = rows.filter("label IS NOT NULL").select("fold", "label", *features).toPandas()
    score = F.lit(None).cast("double")
    for fold in range(k):
        train = labelled[labelled["fold"] != fold]
        if train["label"].nunique() < 2:
            train = labelled
        w, b, mean, deviation = fit_logistic(train[list(features)].to_numpy(float), train["label"].to_numpy(float), l2)
        z = F.lit(float(b))
        for f, wi, m, d in zip(features, w, mean, deviation, strict=True):
            z = z + (F.col(f) - float(m)) / float(d) * float(wi)
        score = F.when(F.col("fold") == fold, 1 / (1 + F.exp(-F.least(F.greatest(z, F.lit(-30.0)), F.lit(30.0))))).otherwise(score)
    return fold_percentile(rows.withColumn("_p", score), "_p").withColumn("score", F.col("percentile")).drop("_p", "percentile")


def build_ranking(pairs: DataFrame, version: str, exclude: DataFrame | None = None, background: float = 0.0) -> DataFrame:
    """Rank of every pair under a version: v1 ic025, v1e ic025 * ln(a), v2 without the keys of `exclude`, v3 to v5 learnt.

    A feature that the pairs lack is an error that names it.
    """
    missing = [f for f in FEATURES[version] if f not in pairs.columns]
    if missing:
        raise ValueError(f"{version} needs {', '.join(missing)}")
    if version != "v1" and version != "v1e" and exclude is not None:
        pairs = pairs.join(exclude.select("ingredient", "pt"), ["ingredient", "pt"], "left_anti")
    if FEATURES[version]:
        scored = crossfit(pairs, FEATURES[version], background=background)
    elif version == "v1e":
        scored = pairs.withColumn("score", F.col("ic025") * F.log(F.greatest(F.col("a").cast("double"), F.lit(1.0))))
    else:
        scored = pairs.withColumn("score", F.col("ic025"))
    return rank(scored, "score")


def scorecard(ranked: DataFrame, labels: DataFrame, ks: tuple[int, ...] = (100, 500, 1000, 5000)) -> DataFrame:
    """Per K: hits, recall, precision, lift and share of reviews saved. ranked (ingredient, pt, rank), labels (ingredient, pt, label).

    Of repeated pairs the first rank counts. Positives outside the ranking aren't scorable and don't count.
    """
    first = ranked.groupBy("ingredient", "pt").agg(F.min("rank").alias("r"))
    placed = first.withColumn("rank", F.row_number().over(Window.orderBy("r", "ingredient", "pt")))
    known = placed.join(labels.filter("label = 1").select("ingredient", "pt").distinct().withColumn("hit", F.lit(1)), ["ingredient", "pt"], "left")
    sums = known.agg(F.count("*").alias("n"), F.coalesce(F.sum("hit"), F.lit(0)).alias("n_pos"), *(F.coalesce(F.sum(F.when(F.col("rank") <= k, F.col("hit"))), F.lit(0)).alias(f"h{k}") for k in ks))
    rows = F.array(*(F.struct(F.lit(k).alias("k"), F.col(f"h{k}").alias("hits")) for k in ks))
    out = sums.select("n", "n_pos", F.inline(rows))
    precision = F.try_divide(F.col("hits").cast("double"), F.least(F.col("k"), F.col("n")))
    return out.select(
        "k", "n", "n_pos", "hits", F.coalesce(F.try_divide(F.col("hits").cast("double"), F.col("n_pos")), F.lit(0.0)).alias("recall"), F.coalesce(precision, F.lit(0.0)).alias("precision"),
        F.coalesce(F.try_divide(precision, F.try_divide(F.col("n_pos").cast("double"), F.col("n"))), F.lit(0.0)).alias("lift"),
        F.greatest(F.lit(0.0), F.coalesce(1 - F.try_divide(F.col("k").cast("double"), F.col("n")), F.lit(0.0))).alias("review_reduction"),
    )


def k_for_recall(ranked: DataFrame, labels: DataFrame, target: float) -> DataFrame:
    """One row k: the smallest rank that reaches the share of scorable positives; 0 for target 0, null without positives."""
    hits = ranked.join(labels.filter("label = 1").select("ingredient", "pt").distinct().withColumn("hit", F.lit(1)), ["ingredient", "pt"], "left")
    run = hits.withColumn("cum", F.sum(F.coalesce("hit", F.lit(0))).over(Window.orderBy("rank"))).withColumn("all", F.sum(F.coalesce("hit", F.lit(0))).over(Window.partitionBy()))
    return run.agg(F.min(F.when((F.col("all") > 0) & (F.col("cum") >= F.col("all") * target), F.lit(0) if target <= 0 else F.col("rank"))).alias("k"))
