"""Mixing sources to target weights (operator 8): entropy balancing. DataFrame functions only.

The token target of every source is a constraint on the documents' rates. Among all rates that meet
them, those nearest in relative entropy to the base rates are exponentially tilted: base * exp(lambda of the
source), cut at the most copies a document may have. Base rates are a column, or by default size / (size + ``FRAGMENT``),
so that fragments of a few words are worth less than whole texts. The lambdas solve the convex dual by
Newton steps, all sources side by side, over cells of (source, base rate in steps of 1/64 of its logarithm) into which the
documents are summed up once; a step that leaves the bracket of the solution is replaced by its middle.

Rates become whole copies by controlled rounding: documents are ordered by size within the source and every copy that
the running sum of fractions completes is taken, first of the large documents. What rounding missed there
changes the target of the others, for which the dual is solved again.

Hot sources are dealt into buckets of about ``BUCKET_ROWS`` documents by a hash of id and text, so no window holds
more than a bucket. Only rows that agree in both share one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import SPACED_WORD, fresh, materialize, table

SHARE = 1.5
MOST_COPIES = 2
WEIGHTS = (5.0, 2.0, 1.0)
BUCKET_ROWS = 4096
#: Words of a text whose default base rate is a half.
FRAGMENT = 16
#: Documents above each of these sizes are rounded before those below.
LEVELS = (1024, 128, 16, 0)
STEPS = 60
_LOG = 64.0
_UNIT = 1 << 32


def targets(sources: DataFrame, share: float = SHARE, most: float = MOST_COPIES, weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """Adds `target` to the table (source, source_size) with one row a source.

    Weights repeat over the sources in the order of code points, null last. The water level L with
    sum(min(most * source_size, L * weight)) = share * sum(source_size) is found from running sums
    over the sources in the order in which they reach their limit. No sources give no rows; if all
    sizes are 0, so are all targets.
    """
    named = Window.orderBy(F.col("source").asc_nulls_last())
    k = F.pmod(F.row_number().over(named) - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*map(F.lit, weights)), (k + 1).cast("int"))
    limit = F.col("source_size") * float(most)
    full_first = Window.orderBy(F.col("_limit") / F.col("_weight"), F.col("source").asc_nulls_last())
    before, every = full_first.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    out = sources.withColumn("_weight", weight).withColumn("_limit", limit)
    out = (
        out.withColumn("_all", F.sum("source_size").over(every) * share)
        .withColumn("_left", F.col("_all") - F.coalesce(F.sum("_limit").over(before), F.lit(0.0)))
        .withColumn("_weights", F.sum("_weight").over(every) - F.coalesce(F.sum("_weight").over(before), F.lit(0.0)))
        .withColumn("_level", F.col("_left") / F.col("_weights"))
    )
    # the level is that of the first source which doesn't reach its limit under it
    open_ = F.when(F.col("_level") * F.col("_weight") < F.col("_limit"), F.struct(F.col("_limit") / F.col("_weight"), "_level"))
    out = out.withColumn("_level", F.min(open_).over(every)["_level"])
    cut = F.least(F.col("_limit"), F.col("_level") * F.col("_weight"))  # least() skips a null level
    return out.withColumn("target", cut).drop("_weight", "_limit", "_all", "_left", "_weights", "_level")


def tilt(target: Column, cells: Column, most: float = MOST_COPIES) -> Column:
    """lambda of a source from its target and its cells, an array of (b, size): the base rate is exp(b / 64).

    Newton steps on the dual, whose slope at lambda is the sum of size * min(most, base * exp(lambda)) less
    the target; the root lies between those of the least and the largest base rate. Null if the target is 0 or there are no words; targets of
    `most` times the size and above put every rate at the cut.
    """
    total = F.aggregate(cells, F.lit(0.0), lambda s, c: s + c["size"])
    least, largest = F.array_min(cells["b"]) / _LOG, F.array_max(cells["b"]) / _LOG
    free = F.log(target / F.aggregate(cells, F.lit(0.0), lambda s, c: s + c["size"] * F.exp(c["b"] / _LOG)))  # without the cut

    def step(s, _):
        sums = F.aggregate(
            cells, F.struct(F.lit(0.0).alias("sum"), F.lit(0.0).alias("slope")),
            lambda t, c: F.struct(
                (t["sum"] + c["size"] * F.least(F.lit(float(most)), F.exp(c["b"] / _LOG + s["x"]))).alias("sum"),
                (t["slope"] + F.when(F.exp(c["b"] / _LOG + s["x"]) < most, c["size"] * F.exp(c["b"] / _LOG + s["x"])).otherwise(0.0)).alias("slope"),
            ),
        )
        return F.transform(F.array(sums), lambda t: _moved(s, t["sum"] - target, t["slope"]))[0]

    start = F.struct((F.log(target / total) - largest).alias("lo"), (F.log(F.lit(float(most))) - least).alias("hi"), free.alias("x"))
    solved = F.aggregate(F.sequence(F.lit(1), F.lit(STEPS)), start, step, lambda s: s["x"])
    return F.when((target > 0) & (total > 0), F.when(target >= total * float(most), F.log(F.lit(float(most))) - least).otherwise(solved))


def _moved(s: Column, gap: Column, slope: Column) -> Column:
    """The bracket lo, hi and the place x after a step."""
    lo, hi = F.when(gap <= 0, s["x"]).otherwise(s["lo"]), F.when(gap >= 0, s["x"]).otherwise(s["hi"])
    newton = s["x"] - gap / F.when(slope > 0, slope)
    inside = F.coalesce((newton >= lo) & (newton <= hi), F.lit(False))
    return F.struct(lo.alias("lo"), hi.alias("hi"), F.when(inside, newton).otherwise((lo + hi) / 2).alias("x"))


def mix(docs: DataFrame, *, id_col="doc_id", **options) -> DataFrame:
    """Per row of `docs`: id, source, size, source_size, target, rate, copies, taken.

    size: words of the text (null: 0); rows of size 0 get no copies. Null sources are one source
    and the last. base_col: a column of base rates; null ones and those not above 0 get no copies. Repeated rows are
    rounded each on its own, rows that agree in id and text in any order. copies lie between 0 and `most`; taken = copies * size.
    Reruns agree. Other columns aren't read; an empty table gives no rows.
    """
    out = _mixed(docs, id_col=id_col, **options)
    return out.select(F.col("_id").alias(id_col), "source", "size", "source_size", "target", "rate", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def _mixed(docs: DataFrame, *, id_col="doc_id", text_col="text", source_col="source", base_col: str | None = None, share: float = SHARE, most: int = MOST_COPIES,
           weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """_id, _text (hash), source, size, source_size, target, rate, copies."""
    size = F.coalesce(F.regexp_count(text_col, F.lit(SPACED_WORD)), F.lit(0)).cast("long")
    sized = docs.select(F.col(id_col).alias("_id"), F.xxhash64(text_col).alias("_text"), F.col(source_col).alias("source"), size.alias("size"), *([F.col(base_col).cast("double").alias("_base")] if base_col else []))
    base = F.col("_base") if base_col else F.col("size") / (F.col("size") + float(FRAGMENT))
    usable = (F.col("size") > 0) & (base > 0) & ~F.isnan(base)
    level = F.coalesce(*(F.when(F.col("size") > low, k) for k, low in enumerate(LEVELS)))
    sized = sized.withColumn("_b", F.when(usable, F.round(F.log(base) * _LOG)).cast("int")).withColumn("_level", F.when(usable, level))
    sized = materialize(sized.drop("_base"), "mix")
    sources = materialize(targets(sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("_rows")), share, most, weights), "mix-sources")
    cells = materialize(sized.filter("_b IS NOT NULL").groupBy("source", "_level", "_b").agg(F.sum("size").alias("size")), "mix-cells")

    rows = sized.join(sources.select(F.col("source").alias("_s"), "_rows"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    rows = rows.withColumn("_bucket", F.pmod(F.xxhash64("_id", "_text", F.lit(1)), F.greatest(F.lit(1), F.ceil(F.col("_rows") / BUCKET_ROWS))))
    taken = None
    for k in range(len(LEVELS)):
        left = sources.select(F.col("source").alias("_s"), F.col("target").alias("_left"))
        if taken is not None:  # of this level and those below
            done = taken.groupBy(F.col("source").alias("_t")).agg(F.sum(F.col("copies") * F.col("size")).alias("_taken"))
            left = left.join(done, F.col("_s").eqNullSafe(F.col("_t")), "left").select("_s", (F.col("_left") - F.coalesce("_taken", F.lit(0))).alias("_left"))
        own = cells.filter(F.col("_level") >= k).groupBy("source", "_b").agg(F.sum("size").cast("double").alias("size"))
        own = own.groupBy("source").agg(F.array_sort(F.collect_list(F.struct(F.col("_b").alias("b"), "size"))).alias("cells"))
        solved = own.join(left, F.col("source").eqNullSafe(F.col("_s"))).select("_s", tilt(F.col("_left"), F.col("cells"), most).alias("_lambda"))
        part = rows.filter(F.col("_level") == k).join(solved, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
        rate = F.coalesce(F.least(F.lit(float(most)), F.exp(F.col("_b") / _LOG + F.col("_lambda"))), F.lit(0.0))
        part = materialize(_round(part.select("_id", "_text", "source", "size", "_bucket", rate.alias("rate"))), "mix-level")
        taken = part if taken is None else taken.unionByName(part)
    none = rows.filter("_level IS NULL").select("_id", "_text", "source", "size", "_bucket", F.lit(0.0).alias("rate"), F.lit(0).cast("long").alias("copies"))
    out = taken.unionByName(none).join(sources.select(F.col("source").alias("_s"), "source_size", "target"), F.col("source").eqNullSafe(F.col("_s")))
    return out.drop("_s", "_bucket")


def _round(rows: DataFrame) -> DataFrame:
    """copies: the whole part of the rate, and one more wherever the running sum of fractions passes a whole number."""
    order = Window.partitionBy("source", "_bucket").orderBy(F.desc("size"), F.xxhash64("_id", "_text"), "_id", "_text")
    whole = F.floor("rate")
    part = F.floor((F.col("rate") - whole) * _UNIT)  # whole numbers, so that sums are exact
    upto = F.sum(part).over(order.rowsBetween(Window.unboundedPreceding, 0)) + F.pmod(F.xxhash64("source", "_bucket"), F.lit(_UNIT))
    more = F.shiftright(upto, 32) - F.shiftright(upto - part, 32)
    return rows.withColumn("copies", (whole + more).cast("long"))


def repeat(docs: DataFrame, *, id_col="doc_id", text_col="text", **options) -> DataFrame:
    """`docs` as the mix has them: each row as often as it has copies, all columns as they were.

    Rows that agree in id and text share their copies evenly.
    """
    own, text, total, rows, turn, copy = fresh(docs.columns, "_id", "_text", "_copies", "_rows", "_turn", "_copy")
    copies = _mixed(docs, id_col=id_col, text_col=text_col, **options).groupBy(F.col("_id").alias(own), F.col("_text").alias(text)).agg(F.sum("copies").alias(total), F.count("*").alias(rows))
    copies = materialize(copies.filter(F.col(total) > 0), "mix-copies")
    same = F.col(id_col).eqNullSafe(F.col(own)) & (F.xxhash64(text_col) == F.col(text))
    out = docs.join(copies.filter(F.col(rows) == 1), same).withColumn(copy, F.col(total))
    again = copies.filter(F.col(rows) > 1)
    if not again.isEmpty():  # only these need to be numbered
        turns = docs.join(again, same).withColumn(turn, F.row_number().over(Window.partitionBy(own, text).orderBy(F.lit(1))) - 1)
        n = F.floor(F.col(total) / F.col(rows)) + F.when(F.col(turn) < F.col(total) % F.col(rows), 1).otherwise(0)
        out = out.unionByName(turns.withColumn(copy, n).drop(turn))
    out = out.withColumn(copy, F.col(copy).cast("int")).filter(F.col(copy) > 0)
    return out.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copy)))).select(docs.columns)


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "source", "size", "source_size", "target", "rate", "copies", "taken")
