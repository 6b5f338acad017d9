"""Label sets from reports of actions, and point-in-time detection."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text
from ..functions.rules import NEGATIVE, PENDING, POSITIVE, is_class_level
from .signal import information_component

MONTHS = {"January": 1, "April": 2, "July": 3, "October": 4}


def terminal_pairs(gold: DataFrame) -> DataFrame:
    """Of each product and signal the strongest label ever (positive, negative, pending), first cohort and year, number of quarters.

    gold: product, signal, label, year, q_start (month; unknown ones count as the first quarter). A cohort is year * 10 + quarter.
    """
    quarter = F.coalesce(F.element_at(F.create_map(*(F.lit(x) for kv in MONTHS.items() for x in kv)), F.col("q_start")), F.lit(1))
    strength = F.when(F.col("label") == POSITIVE, 2).when(F.col("label") == NEGATIVE, 1).otherwise(0)
    rows = gold.withColumn("cohort", F.col("year") * 10 + quarter).withColumn("strength", strength)
    out = rows.groupBy("product", "signal").agg(F.max("strength").alias("s"), F.min("cohort").alias("cohort"), F.min("year").alias("first_year"), F.count_distinct("cohort").alias("n_quarters"))
    label = F.when(F.col("s") == 2, POSITIVE).when(F.col("s") == 1, NEGATIVE).otherwise(PENDING)
    return out.select("product", "signal", label.alias("label"), "cohort", "first_year", "n_quarters")


def resolution_table(terminal: DataFrame) -> DataFrame:
    """Per first year: pairs by label and the share that is resolved."""
    one = lambda x: F.count_if(F.col("label") == x)
    out = terminal.groupBy("first_year").agg(one(POSITIVE).alias("n_positive"), one(NEGATIVE).alias("n_negative"), one(PENDING).alias("n_pending"), F.count("*").alias("n"))
    return out.withColumn("resolved", (F.col("n_positive") + F.col("n_negative")) / F.col("n").cast("double"))


def cutoff_year(table: DataFrame, least: float = 0.75) -> DataFrame:
    """One row: the latest year with enough resolved, else the earliest."""
    return table.agg(F.coalesce(F.max(F.when(F.col("resolved") >= least, F.col("first_year"))), F.min("first_year")).alias("cutoff_year"))


def map_keys(rows: DataFrame, mapping: DataFrame, column: str) -> DataFrame:
    """`column` replaced by the mapping's (key, value) of its canonical form; unmapped ones stay, canonical."""
    key = text.canonical(F.col(column))
    small = mapping.select(text.canonical(F.col("key")).alias("_k"), F.col("value").alias("_v")).dropDuplicates(["_k"])
    return rows.withColumn("_c", key).join(small, F.col("_c") == F.col("_k"), "left").withColumn(column, text.canonical(F.coalesce("_v", "_c"))).drop("_c", "_k", "_v")


def label_set(gold: DataFrame, products: DataFrame, reactions: DataFrame, least: float = 0.75) -> DataFrame:
    """(ingredient, pt, label): 1 and 0 up to the cutoff year, null for sealed pairs after it; pending and empty keys go.

    products, reactions: (key, value) mappings. A pair with both labels is positive. Products that name a class aren't positives.
    """
    terminal = terminal_pairs(gold)
    cut = cutoff_year(resolution_table(terminal), least)
    keyed = map_keys(map_keys(terminal.withColumn("class_level", is_class_level(F.col("product"))), products, "product"), reactions, "signal").filter("product <> '' AND signal <> ''")
    resolved = keyed.filter(F.col("label") != PENDING).filter(~(F.col("class_level") & (F.col("label") == POSITIVE))).crossJoin(F.broadcast(cut))
    value = F.when(F.col("first_year") <= F.col("cutoff_year"), F.when(F.col("label") == POSITIVE, 1).otherwise(0))
    return resolved.groupBy(F.col("product").alias("ingredient"), F.col("signal").alias("pt")).agg(F.max(value).alias("label"))


def first_detection(rows: DataFrame, least: int = 3, above: float = 0.0, step: int = 1) -> DataFrame:
    """First period in which a pair passes the gate on the cases up to then: ingredient, pt, first_period.

    rows: (caseid, ingredient, pt, period), a case counting from its first period. Counts accumulate by running
    sums over the periods in which a pair, ingredient or reaction is new, not by joining periods with all before.
    """
    case_first = rows.groupBy("caseid").agg(F.min("period").alias("q"))
    case_first = case_first.withColumn("q", (F.ceil(F.col("q") / F.lit(step)) * step).cast("int"))
    timed = rows.select("caseid", "ingredient", "pt").distinct().join(case_first, "caseid")

    def running(frame, *keys):
        new = frame.select("caseid", *keys, "q").distinct().groupBy(*keys, "q").agg(F.count("*").alias("c"))
        return new, Window.partitionBy(*keys).orderBy("q")

    grid = case_first.select("q").distinct()
    pair_new, by_pair = running(timed, "ingredient", "pt")
    starts = pair_new.groupBy("ingredient", "pt").agg(F.min("q").alias("q0"))
    dense = starts.join(F.broadcast(grid), F.col("q") >= F.col("q0")).select("ingredient", "pt", "q")
    a = dense.join(pair_new, ["ingredient", "pt", "q"], "left").withColumn("a", F.sum(F.coalesce("c", F.lit(0))).over(by_pair)).drop("c")

    def marginal(key, name):
        new, by = running(timed, key)
        cells = new.select(key).distinct().crossJoin(F.broadcast(grid))
        return cells.join(new, [key, "q"], "left").withColumn(name, F.sum(F.coalesce("c", F.lit(0))).over(by)).drop("c")

    total = case_first.groupBy("q").agg(F.count("*").alias("c")).withColumn("n", F.sum("c").over(Window.orderBy("q"))).drop("c")
    out = a.join(marginal("ingredient", "ab"), ["ingredient", "q"]).join(marginal("pt", "ac"), ["pt", "q"]).join(F.broadcast(total), "q")
    x = F.col("a").cast("double")
    ic025 = information_component(x, F.col("ab").cast("double"), F.col("ac").cast("double"), F.col("n").cast("double")) - 3.3 * F.pow(x + 0.5, F.lit(-0.5)) - 2.0 * F.pow(x + 0.5, F.lit(-1.5))
    return out.filter((F.col("a") >= least) & (ic025 > above)).groupBy("ingredient", "pt").agg(F.min("q").alias("first_period"))


def lead_time(detected: DataFrame, actions: DataFrame) -> DataFrame:
    """Per action key: first_period, action_period (its earliest), lead if detected strictly before."""
    first_action = actions.groupBy("ingredient", "pt").agg(F.min("action_period").alias("action_period"))
    out = first_action.join(detected.groupBy("ingredient", "pt").agg(F.min("first_period").alias("first_period")), ["ingredient", "pt"], "left")
    return out.withColumn("lead", F.when(F.col("first_period") < F.col("action_period"), F.col("action_period") - F.col("first_period")))


def lead_summary(leads: DataFrame) -> DataFrame:
    before = F.count("lead")
    return leads.agg(F.count("*").alias("n"), F.count("first_period").alias("n_ever"), before.alias("n_before"), F.try_divide(before.cast("double"), F.count("*")).alias("rate"), F.median("lead").alias("median_lead"), F.max("lead").alias("max_lead"))
