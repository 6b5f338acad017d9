"""Line dedup (operator 6): a deletion-neighbourhood join of lines. DataFrame functions only.

Lines are sequences of units: words, or in lines of fewer than ``LEAST_WORDS`` words the characters of the words with single
spaces between them. Two lines of one kind are near if one unit replaced, inserted or left out makes them equal; shorter
lines than ``LEAST_CHARACTERS`` are near only if equal.
Each distinct line emits hashed keys: its units with the i-th left out, once with i (replacing: both
lines without their i-th unit are equal) and once without (inserting: the longer line without a unit
is the shorter one), and all its units. Lines with equal keys join through the earliest line of each
key, so a key's lines are never paired with each other. The edit distance to the earliest is then verified on
the units.

Only lines that can have a partner emit keys: an edit leaves the first or the last half of the units
untouched, so the line must share a half with another distinct line; and only units of the other half are left
out. Keys of all deletions come from running XORs of unit hashes, in time linear in the line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import discard, fresh, materialize, table

#: An edit of a line of fewer words is one of its characters.
LEAST_WORDS = 5
#: One character of a shorter line is too much of it.
LEAST_CHARACTERS = 8

_WORDS = r"[^\x20\x09-\x0D]+"


def _lines(docs: DataFrame, id_col: str, text_col: str, least_words: int) -> DataFrame:
    """A row for each line: _row, id, doc, n_lines, line (from 0), its words joined by spaces, their number n, two hashes of them, and of halves."""
    split = F.split(F.coalesce(text_col, F.lit("")), "\n")
    rows = docs.select(F.monotonically_increasing_id().alias("_row"), F.col(id_col).alias("id"), F.xxhash64(F.col(id_col), F.col(text_col)).alias("doc"), split.alias("lines"))
    rows = rows.select("_row", "id", "doc", F.size("lines").cast("long").alias("n_lines"), F.posexplode("lines").alias("line", "written"))
    rows = rows.withColumn("words", F.regexp_extract_all("written", F.lit(_WORDS), F.lit(0))).withColumn("text", F.array_join("words", " ")).withColumn("n", F.size("words"))
    return rows.select("_row", "id", "doc", "n_lines", "line", "text", "n", F.xxhash64("words").alias("k1"), F.xxhash64(F.lit(1), "words").alias("k2"), *(h.alias(f"h{k}") for k, h in enumerate(_halves(least_words))))


def _halves(least_words: int) -> list[Column]:
    """Hashes of the first and last units, for half of the length and half of the length less one; null if the line has no near ones."""
    n, m = F.size("words"), F.char_length("text")
    out = []
    for less in (0, 1):
        half, part = F.greatest(F.lit(0), F.floor((n - less) / 2)).cast("int"), F.greatest(F.lit(0), F.floor((m - less) / 2)).cast("int")
        for first in (True, False):
            name = F.lit("first" if first else "last")
            of_words = F.xxhash64(name, half, F.slice("words", F.lit(1) if first else n - half + 1, half))
            of_text = F.xxhash64(name, F.lit("text"), part, F.left("text", part) if first else F.right("text", part))
            out.append(F.when(n >= least_words, of_words).when((n > 0) & (m >= LEAST_CHARACTERS), of_text))
    return out


def _units(least_words: int) -> Column:
    return F.when(F.col("n") >= least_words, F.split("text", " ")).otherwise(F.regexp_extract_all("text", F.lit("(?s)."), F.lit(0)))


def _keys(lines: DataFrame) -> DataFrame:
    """(key, kind, k1, k2, first) of lines with units; kind 0: a deletion to meet its like, 1: the whole line, 2: a deletion to meet whole lines.

    The lines are dealt out before they become a row for each unit, which then stay where they are.
    """
    by = Window.partitionBy("k1", "k2")
    run = by.orderBy("at")
    dealt = lines.repartition(int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions")), "k1", "k2")  # a fixed number: a row becomes many
    units = dealt.select("k1", "k2", "first", "ends", "by_words", F.size("units").alias("n"), F.posexplode("units").alias("at", "unit"))
    units = units.withColumn("here", F.xxhash64("at", "unit")).withColumn("shifted", F.xxhash64(F.col("at") - 1, "unit"))
    units = units.withColumn("before", F.coalesce(F.bit_xor("here").over(run.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    total = F.bit_xor("shifted").over(by)
    upto = F.bit_xor("shifted").over(run.rowsBetween(Window.unboundedPreceding, 0))
    units = units.withColumn("without", F.col("before").bitwiseXOR(total).bitwiseXOR(upto))
    half = F.floor((F.col("n") - 1) / 2)
    open_ = (F.col("ends").bitwiseAND(1) > 0) & (F.col("at") >= half) | (F.col("ends").bitwiseAND(2) > 0) & (F.col("at") < F.col("n") - half)
    made = F.array(
        F.struct(F.lit(0).alias("kind"), F.xxhash64(F.lit("same"), "by_words", "n", "at", "without").alias("key")),
        F.struct(F.lit(2).alias("kind"), F.xxhash64(F.lit("less"), "by_words", F.col("n") - 1, "without").alias("key")),
    )
    keys = units.filter(open_).select("k1", "k2", "first", F.inline(made))
    last = units.filter(F.col("at") == F.col("n") - 1)
    whole = last.select("k1", "k2", "first", F.lit(1).alias("kind"), F.xxhash64(F.lit("less"), "by_words", "n", F.col("before").bitwiseXOR(F.col("here"))).alias("key"))
    return keys.unionByName(whole)


def _near(x, y):
    """Whether arrays differ by at most one element replaced, inserted or left out."""
    longer, shorter = F.when(F.size(x) >= F.size(y), x).otherwise(y), F.when(F.size(x) >= F.size(y), y).otherwise(x)
    other = F.zip_with(longer, shorter, lambda a, b: ~a.eqNullSafe(b))
    at = F.array_position(other, True)  # from 1; 0 if equal
    same = F.slice(longer, at.cast("int") + 1, F.size(longer)) == F.slice(shorter, at.cast("int") + 1, F.size(shorter))
    less = F.slice(longer, at.cast("int") + 1, F.size(longer)) == F.slice(shorter, at.cast("int"), F.size(shorter))
    return F.when(at == 0, True).when(F.size(x) == F.size(y), same).when(F.size(longer) == F.size(shorter) + 1, less).otherwise(False)


def find(docs: DataFrame, *, id_col="doc_id", text_col="text", least_words: int = LEAST_WORDS) -> DataFrame:
    """Per row of `docs`: id, doc (hash of id and text), n_lines, dropped (numbers of dropped lines, sorted).

    Lines end at line feeds; their words stand between ASCII white space. In the order of id and line number, a line is
    dropped if an earlier line has the same words, or is one edit away: of a word, if both have `least_words` words or more, of a
    character, if both have fewer and at least ``LEAST_CHARACTERS`` characters; whether that earlier line is kept or not.
    Lines without words stay. Null ids come first, null texts are one empty line. Of rows with equal id and text one is the
    earliest, in no order. Other columns aren't read; an empty table gives no rows.
    """
    lines = materialize(_lines(docs, id_col, text_col, least_words), "lines", lean=True)
    order = F.struct("id", "line", "doc", "_row")
    some = lines.filter("n > 0").select("_row", "id", "doc", "line", "n", "k1", "k2", *(f"h{k}" for k in range(4)))
    distinct = some.groupBy("k1", "k2").agg(F.min(order).alias("first"), *(F.first(f"h{k}").alias(f"h{k}") for k in range(4)))
    distinct = materialize(distinct, "lines-distinct", lean=True)

    ends_of = F.array_distinct(F.array(*(F.struct(F.col(f"h{k}").alias("h"), F.lit(1 + k % 2).alias("end")) for k in range(4))))  # equal for odd lengths
    halves = distinct.filter("h0 IS NOT NULL").select("k1", F.explode(ends_of).alias("x")).select("k1", "x.h", "x.end")
    shared = halves.groupBy("h").agg(F.min("k1").alias("lo"), F.max("k1").alias("hi")).filter("lo < hi").select("h")
    ends = halves.join(shared, "h").groupBy("k1").agg(F.bit_or("end").alias("ends"))
    open_ = materialize(ends.join(distinct.select("k1", "k2", "first"), "k1"), "lines-open", lean=True)
    # the line's text is shuffled, which is a third of its units as an array; so it is at every size, by the hint
    found = lines.filter("h0 IS NOT NULL").select("k1", "k2", "n", "text").join(open_.select("k1", "k2").hint("merge"), ["k1", "k2"], "left_semi").dropDuplicates(["k1", "k2"]).join(open_, ["k1", "k2"])
    united = materialize(found.select("k1", "k2", "first", "ends", (F.col("n") >= least_words).alias("by_words"), _units(least_words).alias("units")), "lines-units", lean=True)

    keys = _keys(united)
    who = F.struct("first", "k1", "k2")
    of_kind = lambda k: F.min(F.when(F.col("kind") == k, who)).alias(f"kind{k}")
    least = keys.groupBy("key").agg(*map(of_kind, range(3)), F.min("k1").alias("lo"), F.max("k1").alias("hi"))
    least = materialize(least.filter("lo < hi").drop("lo", "hi"), "lines-keys", lean=True)
    near = F.when(F.col("kind") == 0, F.col("kind0")).when(F.col("kind") == 1, F.col("kind2")).otherwise(F.col("kind1"))
    met = keys.join(least, "key").select("k1", "k2", "first", near.alias("near"))
    pairs = met.filter(F.col("near.first") < F.col("first")).select("k1", "k2", F.col("near.k1").alias("o1"), F.col("near.k2").alias("o2")).distinct()
    texts = united.select("k1", "k2", "units")
    checked = pairs.join(texts, ["k1", "k2"]).join(texts.select(F.col("k1").alias("o1"), F.col("k2").alias("o2"), F.col("units").alias("others")), ["o1", "o2"])
    gone = materialize(checked.filter(_near(F.col("units"), F.col("others"))).select("k1", "k2", F.lit(True).alias("gone")).distinct(), "lines-gone", lean=True)
    for done in (open_, united, least):
        discard(done)

    fate = distinct.select("k1", "k2", "first").join(gone, ["k1", "k2"], "left")
    later = some.join(fate, ["k1", "k2"]).filter(F.col("gone").isNotNull() | (order != F.col("first")))
    dropped = later.groupBy("_row").agg(F.sort_array(F.collect_list("line")).alias("dropped"))
    out = lines.filter("line = 0").select("_row", "id", "doc", "n_lines").join(dropped, "_row", "left")
    return out.select(F.col("id").alias(id_col), "doc", "n_lines", F.coalesce("dropped", F.array().cast("array<int>")).alias("dropped"))


def remove(docs: DataFrame, *, id_col="doc_id", text_col="text", **options) -> DataFrame:
    """`docs` with the dropped lines left out of the text, which keeps its other lines as they were."""
    key, rows, least, most, turn = fresh(docs.columns, "_doc", "_rows", "_least", "_most", "_turn")
    drops = F.struct(F.size("dropped").alias("n"), "dropped")  # of equal rows, that of the earliest and that of all others
    found = find(docs, id_col=id_col, text_col=text_col, **options).groupBy(F.col("doc").alias(key)).agg(F.count("*").alias(rows), F.min(drops)["dropped"].alias(least), F.max(drops)["dropped"].alias(most))
    found = materialize(found.filter(F.size(most) > 0), "lines-dropped")
    again = found.filter(F.col(rows) > 1)
    of_doc = F.xxhash64(id_col, text_col) == F.col(key)

    def without(rows_: DataFrame, gone: Column) -> DataFrame:
        left = F.array_join(F.filter(F.split(text_col, "\n"), lambda x, i: ~F.array_contains(gone, i)), "\n")
        text = F.when(F.col(key).isNull(), F.col(text_col)).otherwise(left)
        return rows_.select(*(text.alias(c) if c == text_col else F.col(c) for c in docs.columns))

    if again.isEmpty():
        return without(docs.join(found, of_doc, "left"), F.col(least))
    single = without(docs.join(again.select(key), of_doc, "left_anti").join(found.filter(F.col(rows) == 1), of_doc, "left"), F.col(least))
    turns = docs.join(again, of_doc).withColumn(turn, F.row_number().over(Window.partitionBy(key).orderBy(F.lit(1))))
    return single.unionByName(without(turns, F.when(F.col(turn) == 1, F.col(least)).otherwise(F.col(most))))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find(table(spark, sf_dir, "documents"))
    n = F.size("dropped").cast("long")
    return found.select("doc_id", "n_lines", (F.col("n_lines") - n).alias("n_kept"), F.array_join(F.transform("dropped", lambda x: x.cast("string")), ",").alias("dropped"))
