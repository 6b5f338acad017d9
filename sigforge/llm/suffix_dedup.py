"""Suffix-array dedup (operator 9): every byte of a long string that starts somewhere else too goes.

A string of ``LENGTH`` bytes is found by its anchor: among the ``GRAM``-byte grams inside it the one of
least hash. Equal strings have equal anchors at the same place, so only occurrences of one
gram need to be compared, and about one position in 75 is an anchor.

1. Anchors are counted by gram; those that occur once are done (their strings are unique).
2. The context of an occurrence holds all strings that have it as their anchor. Occurrences of equal contexts, byte by
   byte, are one class: of two or more, all strings are repeated. A hash names the class later on; if two contexts
   of a gram have one hash, everything is done again with another hash.
3. What is left are classes of one occurrence. The contexts of the classes of a gram are suffix-sorted, to the
   right and (reversed) to the left. Suffixes are compared by hashes: prefix sums of polynomial hashes give the hash of
   any substring, binary search finds the common extension, so that a comparison takes logarithmic
   time in the mergesort. Neighbours in the order are then compared byte by byte, and the sort repeated with
   another base if a hash lied. A string is repeated if another class lies in the same interval of
   both orders at the string's depths.
4. The repeated strings of a text become runs of bytes.

A gram of more than ``MOST_CLASSES`` classes is sorted in parts: strings that start a to b bytes before the gram share more
than the gram, namely all bytes from a before it to ``LENGTH`` - b behind its start. Halving the range of distances
lengthens what is shared, by which the classes are dealt into smaller parts; at a single distance a part is one string.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import chunks, discard, materialize, rows_of, table, utf8
from .shingles import inverse_powers, mix, powers

LENGTH = 200
GRAM = 50
MOST_CLASSES = 20_000
_SEGMENT = 1 << 20
_CHUNK = 1 << 20
_TASK = 2 << 20


def substring_sums(b: np.ndarray, seed: int = 0) -> np.ndarray:
    sums = np.zeros(len(b) + 1, np.uint64)
    values = mix(np.arange(256, dtype=np.uint64) + np.uint64(seed << 8))[b] if seed else b.astype(np.uint64) + np.uint64(1)
    np.cumsum(values * powers(max(1, len(b))), out=sums[1:])
    return sums


def _class_hash(x: np.ndarray, seed: int) -> np.ndarray:
    return mix(x)


def anchors(parts: list[bytes], length: int, gram: int, seed: int = 0):
    """Of every part (whole texts or segments): gram hash, part, place, first and last string start, hash of the strings."""
    data = np.frombuffer(b"".join(parts), np.uint8)
    width = length - gram + 1
    if len(data) < length:
        return (np.zeros(0, np.uint64), *(np.zeros(0, np.int64) for _ in range(4)), np.zeros(0, np.uint64))
    sums, back = substring_sums(data, seed), inverse_powers(len(data))
    grams = mix((sums[gram:] - sums[:-gram]) * back[: len(data) - gram + 1])
    low = np.uint64((1 << int(len(data)).bit_length()) - 1)
    key = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
    blocks = np.concatenate([key, np.full(-len(key) % width, ~np.uint64(0))]).reshape(-1, width)
    m = len(data) - length + 1
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()[width - 1 : width - 1 + m]
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()[:m]
    at = (np.minimum(ahead, behind) & low).astype(np.int64)
    ends = np.cumsum([len(p) for p in parts])
    starts = np.concatenate([np.arange(max(0, e - n), max(e - n, e - length + 1)) for e, n in zip(ends.tolist(), map(len, parts), strict=True)])
    own = at[starts]
    new = np.flatnonzero(np.concatenate([[True], (own[1:] != own[:-1]) | (np.searchsorted(ends, starts[1:], "right") != np.searchsorted(ends, starts[:-1], "right"))])) if len(starts) else np.zeros(0, np.int64)
    first, last = starts[new], starts[np.append(new[1:], len(starts)) - 1] if len(new) else np.zeros(0, np.int64)
    place = own[new]
    part = np.searchsorted(ends, first, "right")
    whole = _class_hash((sums[last + length] - sums[first]) * back[first] + ((place - first) * 1009 + (last - first)).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F), seed)
    base = ends[part] - np.array([len(p) for p in parts], np.int64)[part] if len(parts) else part
    return grams[place], part, place - base, first - base, last - base, whole


def _segments(data: bytes, length: int):
    """(offset, bytes) so that every string start lies in one segment, together with its string."""
    for at in range(0, max(1, len(data) - length + 1), _SEGMENT):
        yield at, data[at : at + _SEGMENT + length - 1]


def _anchor_rows(docs: DataFrame, length: int, gram: int, with_places: bool, seed: int = 0) -> DataFrame:
    """(gram[, strings, doc, at]) of all anchors; at: place, its distance to the first start and first to last, packed."""
    schema = "gram long, strings long, doc long, at long" if with_places else "gram long"

    def run(batches):
        units = ((doc, at, part) for doc, text in rows_of(batches, ("doc", "text")) for at, part in _segments(utf8(text), length))
        for unit in chunks(units, lambda u: 64 + len(u[2]), _CHUNK):
            grams, part, place, first, last, whole = anchors([u[2] for u in unit], length, gram, seed)
            out = [pa.array(grams.view(np.int64))]
            if with_places:
                docs_, offsets = (np.array([u[k] for u in unit], np.int64)[part] for k in (0, 1))
                out += [pa.array(whole.view(np.int64)), pa.array(docs_), pa.array(((place + offsets) << 20) | ((place - first) << 10) | (last - first))]
            yield pa.RecordBatch.from_arrays(out, names=[f.split()[0] for f in schema.split(", ")])

    return docs.mapInArrow(run, schema)


# --- suffix sort ------------------------------------------------------------------------------


class Suffixes:
    """Suffixes of a byte sequence, each with its own end, compared by hashes."""

    def __init__(self, data: np.ndarray, start: np.ndarray, size: np.ndarray, seed: int = 0):
        self.data, self.start, self.size = data, start, size
        odd = np.uint64(2 * seed + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(mix(data.astype(np.uint64) + odd) * powers(max(1, len(data))), out=self.sums[1:])
        self.back = inverse_powers(len(data) + 1)
        self.deepest = int(size.max(initial=0))

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the common extension by binary search over substring hashes."""
        p, q = self.start[i], self.start[j]
        low, high = np.zeros(len(i), np.int64), np.minimum(self.size[i], self.size[j])
        for _ in range(int(high.max(initial=0)).bit_length()):
            mid = (low + high + 1) >> 1
            same = (self.sums[p + mid] - self.sums[p]) * self.back[p] == (self.sums[q + mid] - self.sums[q]) * self.back[q]
            low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
        return low

    def before(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether suffix i is less than suffix j; an end is less than any byte."""
        n = self.common(i, j)
        i_ends, j_ends = n >= self.size[i], n >= self.size[j]
        p, q = np.minimum(self.start[i] + n, len(self.data) - 1), np.minimum(self.start[j] + n, len(self.data) - 1)
        return ~j_ends & (i_ends | (self.data[p] < self.data[q]))

    def sort(self, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Order within runs of equal `group` by a bottom-up mergesort, and common extensions with the predecessor."""
        n = len(group)
        order = np.arange(n)
        new = np.concatenate([[True], group[1:] != group[:-1]]) if n else np.zeros(0, bool)
        first = np.flatnonzero(new)
        size = np.diff(np.append(first, n))
        head, size = np.repeat(first, size), np.repeat(size, size)
        inside = np.arange(n) - head
        run = 1
        while run < int(size.max(initial=0)):
            number = inside // run
            other = (number + 1) * run
            left = np.flatnonzero((number % 2 == 0) & (other < size))
            low, high = (head + other)[left], (head + np.minimum(other + run, size))[left]
            begin = low.copy()
            open_ = np.arange(len(left))
            while len(open_):
                mid = (low[open_] + high[open_]) >> 1
                smaller = self.before(order[mid], order[left[open_]])
                low[open_[smaller]] = mid[smaller] + 1
                high[open_[~smaller]] = mid[~smaller]
                open_ = open_[low[open_] < high[open_]]
            to = left + (low - begin)
            merged, free = np.empty(n, np.int64), np.ones(n, bool)
            merged[to] = order[left]
            free[to] = False
            others = np.ones(n, bool)
            others[left] = False
            merged[free] = order[others]
            order = merged
            run *= 2
        common = np.zeros(n, np.int64)
        inner = np.flatnonzero(~new)
        common[inner] = self.common(order[inner - 1], order[inner])
        return order, common

    def verified(self, order: np.ndarray, common: np.ndarray) -> bool:
        """Whether the neighbours' bytes agree as far as their hashes do."""
        some = np.flatnonzero(common)
        for part in np.array_split(some, max(1, int(common.sum()) >> 22) + 1):
            n = common[part]
            inside = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            p, q = np.repeat(self.start[order[part]], n) + inside, np.repeat(self.start[order[part - 1]], n) + inside
            if not np.array_equal(self.data[p], self.data[q]):
                return False
        return True


def sorted_suffixes(data, start, size, group):
    for seed in range(16):
        suffixes = Suffixes(data, start, size, seed)
        order, common = suffixes.sort(group)
        if suffixes.verified(order, common):
            return order, common
    raise RuntimeError("suffix sort: hashes keep colliding")


def repeated_strings(group: np.ndarray, contexts: list[bytes], place: np.ndarray, span: np.ndarray, length: int, low: np.ndarray, high: np.ndarray):
    """For contexts ordered by group: pairs (context, distance of a repeated string's start before the place).

    place: the gram in its context; span: number of string starts less one; low, high: the distances that
    matter. A string is repeated if an other context of the group has it at the same distance.
    """
    size = np.array([len(c) for c in contexts], np.int64)
    data = np.frombuffer(b"".join(contexts), np.uint8)
    start = np.cumsum(size) - size
    right = sorted_suffixes(data, start + place, size - place, group)
    left = sorted_suffixes(data[::-1], len(data) - (start + place), place, group)
    index, distance = [], []
    for d in range(int(low.min(initial=0)), int(min(place.max(initial=-1), high.max(initial=-1))) + 1):
        has = (d <= place) & (d >= place - span) & (d >= low) & (d <= high)
        if not has.any():
            continue
        interval = []
        for (order, common), depth in ((right, length - d), (left, d)):
            number = np.empty(len(order), np.int64)
            number[order] = np.cumsum((common < depth) | np.concatenate([[True], group[1:] != group[:-1]]))
            interval.append(number)
        some = np.flatnonzero(has)
        key = interval[0][some] * (len(group) + 1) + interval[1][some]
        _, back, n = np.unique(key, return_inverse=True, return_counts=True)
        found = some[n[back] > 1]
        index.append(found)
        distance.append(np.full(len(found), d))
    return (np.concatenate(index), np.concatenate(distance)) if index else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def _runs(distances: np.ndarray) -> list[int]:
    """Sorted distances as low, high, low, high, ..."""
    cut = np.flatnonzero(np.diff(distances) > 1)
    return np.column_stack([distances[np.append(0, cut + 1)], distances[np.append(cut, len(distances) - 1)]]).ravel().tolist()


_ROW = "part long, gram long, strings long, repeated boolean, rel long, low int, high int, context binary"


def _compared(rows: DataFrame, length: int) -> DataFrame:
    """(gram, strings, runs) of classes of one occurrence with repeated strings, from all rows (_ROW) of their part."""

    def solve(rows):
        rows.sort(key=lambda r: r[0])
        group = np.unique(np.array([r[0] for r in rows], np.int64), return_inverse=True)[1]
        rel, low, high = (np.array([r[k] for r in rows], np.int64) for k in (4, 5, 6))
        index, distance = repeated_strings(group, [r[7] for r in rows], rel >> 10, rel & 1023, length, low, high)
        by = np.lexsort((distance, index))
        index, distance = index[by], distance[by]
        edges = np.flatnonzero(np.diff(index)) + 1
        out = []
        for a, z in zip([0, *edges], [*edges, len(index)], strict=True) if len(index) else ():
            r = rows[index[a]]
            if not r[3]:
                out.append((r[1], r[2], _runs(distance[a:z])))
        columns = list(zip(*out, strict=True)) or [[], [], []]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.list_(pa.int64())), strict=True)], names=["gram", "strings", "runs"])

    def run(batches):
        held, size = [], 0
        for row in rows_of(batches, [f.split()[0] for f in _ROW.split(", ")]):  # sorted by part
            if size > _TASK and row[0] != held[-1][0]:
                yield solve(held)
                held, size = [], 0
            held.append(row)
            size += len(row[7])
        if held:
            yield solve(held)

    return rows.repartition("part").sortWithinPartitions("part").mapInArrow(run, "gram long, strings long, runs array<long>")


def _halved(rows: DataFrame, length: int) -> DataFrame:
    """Rows of large parts dealt into parts of half the range of distances, by the bytes that all their strings share."""
    place, span = F.shiftright("rel", 10), F.col("rel").bitwiseAND(1023)
    middle = F.floor((F.col("low") + F.col("high")) / 2).cast("int")
    halves = F.explode(F.array(F.struct(F.col("low").alias("a"), middle.alias("z")), F.struct((middle + 1).alias("a"), F.col("high").alias("z"))))
    rows = rows.withColumn("h", halves).drop("low", "high").select("*", F.col("h.a").alias("low"), F.col("h.z").alias("high")).drop("h")
    rows = rows.filter((F.col("low") <= F.col("high")) & (F.col("low") <= place) & (F.col("high") >= place - span))
    shared = F.substr("context", (place - F.col("low") + 1).cast("int"), (F.lit(length) + F.col("low") - F.col("high")).cast("int"))
    return rows.withColumn("part", F.xxhash64("part", "low", shared))


def _solved(open_: DataFrame, length: int, most: int) -> DataFrame:
    """(gram, strings, runs) for the classes (gram, strings, repeated, rel, context, classes of the gram)."""
    span = F.greatest(F.lit(0), F.lit(length - 1)).cast("int")
    rows = open_.select(F.col("gram").alias("part"), "gram", "strings", "repeated", "rel", F.lit(0).alias("low"), span.alias("high"), "context", "classes")
    names = [f.split()[0] for f in _ROW.split(", ")]
    solved = materialize(_compared(rows.filter(F.col("classes") <= most).select(names), length), "suffix-solved")
    large = rows.filter(F.col("classes") > most).select(names)
    while not large.isEmpty():
        large = materialize(_halved(large, length), "suffix-parts")
        sizes = materialize(large.groupBy("part").agg(F.count("*").alias("n")).filter("n > 1"), "suffix-sizes")
        one = F.col("low") == F.col("high")
        sized = large.join(sizes, "part")
        solved = solved.unionByName(materialize(_compared(sized.filter(~one & (F.col("n") <= most)).select(names), length), "suffix-solved"))
        string = F.substr("context", (F.shiftright("rel", 10) - F.col("low") + 1).cast("int"), F.lit(length))
        single = sized.filter(one).select("gram", "strings", "repeated", "low", string.alias("string"))
        again = single.groupBy("gram", "low", "string").agg(F.count("*").alias("n")).filter("n > 1").drop("n")
        found = single.filter("NOT repeated").join(again, ["gram", "low", "string"]).select("gram", "strings", F.array(F.col("low").cast("long"), F.col("low").cast("long")).alias("runs"))
        solved = solved.unionByName(materialize(found, "suffix-solved"))
        large = sized.filter(~one & (F.col("n") > most)).select(names)
    return solved


def _contexts(docs: DataFrame, found: DataFrame, length: int) -> DataFrame:
    """(gram, strings, rel, context) of all occurrences: the bytes of all strings with the anchor, and its place in them."""
    wanted = found.groupBy("doc").agg(F.collect_list(F.struct("gram", "strings", "at")).alias("wanted"))
    schema = "gram long, strings long, rel long, context binary"

    def run(batches):
        for part in chunks(rows_of(batches, ("text", "wanted")), lambda r: len(r[0] or "") + 400 * len(r[1]), _CHUNK):
            for places in _few(part):
                out = []
                for data, w in places:
                    first = (w["at"] >> 20) - ((w["at"] >> 10) & 1023)
                    out.append((w["gram"], w["strings"], w["at"] & 0xFFFFF, data[first : first + (w["at"] & 1023) + length]))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True)], names=[f.split()[0] for f in schema.split(", ")])

    return docs.dropDuplicates(["doc"]).join(wanted, "doc").select("text", "wanted").mapInArrow(run, schema)


def _few(part):
    """Up to 10,000 places at a time, each with the bytes of its text."""
    held = []
    for text, places in part:
        data = utf8(text)
        for w in places:
            held.append((data, w))
            if len(held) == 10_000:
                yield held
                held = []
    if held:
        yield held


def repeated_runs(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, most_classes: int = MOST_CLASSES) -> DataFrame:
    """(doc, runs) of texts (doc, text) with repeated strings: starts of repeated strings as unsorted pairs first, last."""
    for seed in range(16):
        found, classes = _classes(docs, length, gram, seed)
        named = classes.groupBy("gram", "strings").agg(F.count("*").alias("contexts"), F.max("repeated").alias("repeated"))
        named = materialize(named, "suffix-named")
        if named.filter("contexts > 1").isEmpty():  # each hash names one context
            break
    else:
        raise RuntimeError("suffix dedup: hashes keep colliding")
    single = named.groupBy("gram").agg(F.count("*").alias("classes"), F.bool_and("repeated").alias("done")).filter("classes > 1 AND NOT done")
    solved = _solved(classes.join(single.select("gram", "classes"), "gram"), length, most_classes)
    discard(classes)
    whole = named.filter("repeated").select("gram", "strings", F.lit(None).cast("array<long>").alias("runs"))
    known = whole.unionByName(solved)
    place, before, span = F.shiftright("at", 20), F.shiftright("at", 10).bitwiseAND(1023), F.col("at").bitwiseAND(1023)
    every = F.array(place - before, place - before + span)
    some = F.flatten(F.transform(F.sequence(F.lit(0), (F.size("runs") / 2 - 1).cast("int")), lambda k: F.array(place - F.get("runs", 2 * k + 1), place - F.get("runs", 2 * k))))
    starts = found.join(known, ["gram", "strings"]).select("doc", F.when(F.col("runs").isNull(), every).otherwise(some).alias("runs"))
    return starts.groupBy("doc").agg(F.flatten(F.collect_list("runs")).alias("runs"))


def _classes(docs: DataFrame, length: int, gram: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """The occurrences (gram, strings, doc, at) of grams that occur again, and their classes (gram, strings, repeated, rel, context)."""
    grams = materialize(_anchor_rows(docs, length, gram, False, seed).groupBy("gram").count().filter("count > 1").select("gram"), "suffix-grams")
    found = materialize(_anchor_rows(docs, length, gram, True, seed).join(grams, "gram"), "suffix-anchors")
    discard(grams)
    classes = _contexts(docs, found, length).groupBy("gram", "strings", "rel", "context").agg(F.count("*").alias("n"))
    return found, materialize(classes.select("gram", "strings", (F.col("n") > 1).alias("repeated"), "rel", "context"), "suffix-classes")


def _cut(data: bytes, starts: list[int] | None, length: int) -> tuple[list[int], bytes]:
    """The maximal removed runs (start, end, start, ...) and what is left."""
    if not starts:
        return [], data
    pairs = np.array(starts, np.int64).reshape(-1, 2)
    pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
    first, end = pairs[:, 0], np.maximum.accumulate(pairs[:, 1] + length)
    cut = np.flatnonzero(first[1:] > end[:-1]) + 1
    a, z = first[np.append(0, cut)], end[np.append(cut - 1, len(end) - 1)]
    kept = b"".join(data[x:y] for x, y in zip([0, *z.tolist()], [*a.tolist(), len(data)], strict=True))
    return np.column_stack([a, z]).ravel().tolist(), kept


def dedup(docs: DataFrame, *, id_col="doc_id", text_col="text", length: int = LENGTH, gram: int = GRAM, most_classes: int = MOST_CLASSES) -> DataFrame:
    """Per row of `docs`: id, n_bytes, spans (removed runs start, end, start, ...), kept (bytes left).

    A byte goes if a string of `length` bytes covers it that starts anywhere else as well, in the
    same text or another; strings don't cross texts and are judged on the input. Null texts are
    empty. Rows with equal id and text are two documents, which empty each other if they are
    long enough. Other columns aren't read; an empty table gives no rows. Texts are joined by a 64-bit hash of id and text.
    """
    keyed = docs.select(F.xxhash64(F.col(id_col), F.col(text_col)).alias("doc"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    runs = repeated_runs(keyed.select("doc", "text"), length, gram, most_classes)
    kind = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField(id_col, kind), T.StructField("n_bytes", T.LongType()), T.StructField("spans", T.ArrayType(T.LongType())), T.StructField("kept", T.BinaryType())])

    def run(batches):
        arrow = None
        for part in chunks(rows_of(batches, ("id", "text", "runs")), lambda r: 64 + len(r[1] or "") + 8 * len(r[2] or ()), _CHUNK):
            out = []
            for doc, text, starts in part:
                data = utf8(text)
                out.append((doc, len(data), *_cut(data, starts, length)))
            if arrow is None:
                from pyspark.sql.pandas.types import to_arrow_type

                arrow = [to_arrow_type(f.dataType) for f in schema]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), arrow, strict=True)], names=schema.names)

    return keyed.join(runs, "doc", "left").select("id", "text", "runs").mapInArrow(run, schema)


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dedup(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda s, x: x - s)  # the alternating sum of starts and ends
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), (F.size("spans") / 2).cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
