"""Blocked similarity join of names with guards, and nearest vectors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text


def blocked_matches(names: DataFrame, candidates: DataFrame, threshold: float = 92.0, margin: float = 3.0) -> DataFrame:
    """Best and second score of each name against candidates of its block: name, candidate, score, second_score.

    names (name), candidates (candidate): compared by token_sort_ratio of the normalised name if the first character of
    their smallest words agree. Pairs whose lengths alone keep them below threshold - margin aren't scored, which can't
    change the best or its margin above the threshold. Ties go to the smaller candidate.
    """
    left = names.select("name").distinct().withColumn("q", text.normalize_query(F.col("name"))).filter("q <> ''").withColumn("block", text.block_key(F.col("q")))
    right = candidates.select(F.upper(F.trim("candidate")).alias("candidate")).filter("candidate <> ''").distinct().withColumn("block", text.block_key(F.col("candidate")))
    n, m = F.length("q"), F.length("candidate")
    pairs = left.join(right, "block").filter(200.0 * F.least(n, m) / (n + m) >= threshold - margin)
    scored = pairs.withColumn("score", text.token_sort_ratio("q", "candidate"))
    order = Window.partitionBy("name").orderBy(F.desc("score"), "candidate")
    ranked = scored.withColumn("k", F.row_number().over(order)).withColumn("second_score", F.lead("score", 1, 0.0).over(order))
    return ranked.filter("k = 1").select("name", F.col("q").alias("normalized"), "candidate", "score", "second_score")


def accept(matches: DataFrame, dictionary: DataFrame, threshold: float = 92.0, short_threshold: float = 96.0, short_most: int = 10, margin: float = 3.0, keep_ambiguous: bool = False) -> DataFrame:
    """`matches` with ingredient_set and reject_reason, the first guard that fails; accepted ones have none."""
    product = dictionary.select(F.upper(F.trim("medicinalproduct")).alias("candidate"), "ingredient_norm", "ingredient_set", F.lit("product").alias("field"))
    single = dictionary.select(F.upper(F.trim("ingredient_norm")).alias("candidate"), "ingredient_norm", F.lower(text.normalize_ingredient(F.col("ingredient_norm"))).alias("ingredient_set"), F.lit("ingredient").alias("field"))
    known = product.unionByName(single).groupBy("candidate").agg(F.count_distinct("ingredient_norm").alias("n"), F.min(F.struct(F.when(F.col("field") == "product", 0).otherwise(1).alias("k"), "ingredient_set", "ingredient_norm")).alias("rep"))
    out = matches.join(known, "candidate", "left")
    punctuation = text.alnum(F.col("normalized")) == text.alnum(F.col("candidate"))
    least = F.when(text.is_short_name(F.col("normalized"), short_most) & ~punctuation, short_threshold).otherwise(threshold)
    reason = (
        F.when(F.col("score") < threshold, "score").when(F.col("score") < least, "short_name").when(F.col("score") - F.col("second_score") < margin, "margin")
        .when(text.class_or_form_only(F.col("name")), "class_or_form").when(text.designator_mismatch(F.col("name"), F.col("candidate")), "designator")
        .when(F.upper(F.trim("rep.ingredient_norm")) == "DIMETHYL", "degenerate").when(F.col("rep.ingredient_set").contains(" ; "), "several_sets")
        .when((F.col("n") > 1) & F.lit(not keep_ambiguous), "ambiguous")
    )
    return out.select("name", "normalized", "candidate", "score", "second_score", F.col("rep.ingredient_set").alias("ingredient_set"), reason.alias("reject_reason"))


def nearest_vectors(queries: DataFrame, corpus: DataFrame, k: int = 10, block: int = 4096) -> DataFrame:
    """(query, id, score, rank): the k largest inner products of normalised vectors, exact, ties by id.

    queries, corpus: (id, vector). Queries go to the executors in blocks, the corpus is scanned once for each;
    every partition passes on its own k best for each query only.
    """
    out = None
    for part in _blocks(queries.select("id", "vector").toLocalIterator(), block):
        ids = np.array([r.id for r in part])
        matrix = _unit(np.array([r.vector for r in part], float))
        value = corpus.sparkSession.sparkContext.broadcast((ids, matrix))

        def run(batches, value=value):
            ids, matrix = value.value
            best = [[] for _ in ids]
            for batch in batches:
                own = np.array(batch.column(0).to_pylist())
                if not len(own):
                    continue
                scores = matrix @ _unit(np.array(batch.column(1).to_pylist(), float)).T
                for i in range(len(ids)):
                    top = np.argpartition(-scores[i], min(k, len(own)) - 1)[: k]
                    border = scores[i][top].min()
                    top = np.flatnonzero(scores[i] >= border)
                    best[i] = sorted(best[i] + [(-float(scores[i][j]), own[j].item()) for j in top])[:k]
            rows = [(ids[i].item(), j, -s) for i, b in enumerate(best) for s, j in b]
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in ((0, pa.int64()), (1, pa.int64()), (2, pa.float64()))], names=["query", "id", "score"])

        found = corpus.select("id", "vector").mapInArrow(run, "query long, id long, score double")
        out = found if out is None else out.unionByName(found)
    if out is None:
        out = corpus.sparkSession.createDataFrame([], "query long, id long, score double")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    return out.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def _blocks(rows, n):
    part = []
    for r in rows:
        part.append(r)
        if len(part) == n:
            yield part
            part = []
    if part:
        yield part
