"""MinHash near-dedup (operator 4): universal hash minima, banding, verification, components.

Documents with the same shingle set are one node. Every node's set is reduced to ``BANDS * ROWS``
minima of universal hash functions, of which a byte each is kept. Equal bands put nodes into buckets. In a
bucket, nodes are first compared with a leader: found links join components, the leader leaves the bucket, and buckets
whose members are in one component are done. Buckets over ``SMALL`` nodes have up to ``TURNS`` turns of leaders. If they are
larger still, the nodes outside a bucket's most frequent component are compared with all its nodes, strip by strip and block by
block of about ``SMALL`` nodes, each pair of strip and block in a task. The other buckets are brought
together: nodes that share buckets, directly or through others, are one part, which a task compares within, bucket by bucket;
a part of more than ``LARGEST_PART`` nodes is taken apart into its buckets. A pair is compared in the first bucket it shares
only. Thus every pair of a bucket is compared or already in one component, and no bucket is expanded into pairs. Compared
pairs must agree in their signatures; links are confirmed on the full sets.

A pair of similarity 0.8 shares no bucket with probability (1 - 0.8**5)**40 = 1e-7, and
its signatures (200 minima) fall below ``LEAST_AGREEMENT`` with less than 1e-6.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import chunks, discard, fresh, in_arrow, materialize, rows_of, table
from .components import components
from .shingles import mix, shingle_sets

BANDS, ROWS = 40, 5
LEAST_AGREEMENT = 0.66
WIDTH = 5
PERCENT = 80
SMALL = 4096
TURNS = 4
LARGEST_PART = 16_384
_CHUNK = 2 << 20
_BAND = (1 << (BANDS - 1).bit_length()) - 1

_seed = np.random.default_rng(20240501)
_FACTORS = _seed.integers(0, 1 << 63, BANDS * ROWS, np.uint64) * np.uint64(2) + np.uint64(1)
_TERMS = _seed.integers(0, 1 << 63, BANDS * ROWS, np.uint64) * np.uint64(2)


def signature(shingles: np.ndarray) -> bytes:
    """One byte of the minimum of factor * x + term modulo 2**64 for each hash function."""
    least = None
    for at in range(0, len(shingles), 512):
        part = (shingles[at : at + 512, None] * _FACTORS + _TERMS).min(0)
        least = part if least is None else np.minimum(least, part)
    return (mix(least) >> np.uint64(56)).astype(np.uint8).tobytes()


def _arrays(columns: dict[str, tuple[list, pa.DataType]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in columns.values()], names=list(columns))


def _sketch(docs: DataFrame, width: int) -> DataFrame:
    """n, key (of the whole set) and signature of every document (id, text). Sets under 4 link with equal ones only."""

    def run(batches):
        for part in chunks(rows_of(batches, ("id", "text")), lambda r: 64 + len(r[1] or ""), _CHUNK):
            sets = shingle_sets([r[1] for r in part], width)
            yield _arrays({
                "id": ([r[0] for r in part], pa.int64()), "n": ([len(s) for s in sets], pa.int64()),
                "key": ([hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets], pa.binary()),
                "sig": ([signature(s) if len(s) >= 4 else None for s in sets], pa.binary()),
            })

    return in_arrow(docs, run, "id long, n long, key binary, sig binary")


def _sets(docs: DataFrame, width: int) -> DataFrame:
    def run(batches):
        for part in chunks(rows_of(batches, ("id", "text")), lambda r: 64 + len(r[1] or ""), _CHUNK):
            sets = shingle_sets([r[1] for r in part], width)
            yield _arrays({"id": ([r[0] for r in part], pa.int64()), "shingles": ([s.tobytes() for s in sets], pa.binary())})

    return in_arrow(docs, run, "id long, shingles binary")


def _agreeing(pairs: DataFrame) -> DataFrame:
    """Of pairs (a, b, sa, sb) those whose signatures agree often enough."""

    def run(batches):
        for part in chunks(rows_of(batches, ("a", "b", "sa", "sb")), lambda r: 512, _CHUNK):
            x, y = (np.frombuffer(b"".join(r[k] for r in part), np.uint8).reshape(len(part), -1) for k in (2, 3))
            near = (x == y).mean(1) >= LEAST_AGREEMENT
            yield _arrays({"a": ([r[0] for r, k in zip(part, near, strict=True) if k], pa.int64()), "b": ([r[1] for r, k in zip(part, near, strict=True) if k], pa.int64())})

    return in_arrow(pairs, run, "a long, b long")


def _linked(pairs: DataFrame, percent: int) -> DataFrame:
    """Of pairs (a, b, xa, xb) with whole sets those with 100 * intersection >= percent * union."""

    def run(batches):
        for part in chunks(rows_of(batches, ("a", "b", "xa", "xb")), lambda r: len(r[2]) + len(r[3]), _CHUNK):
            a, b = [], []
            for i, j, xa, xb in part:
                if _alike(np.frombuffer(xa, np.uint64), np.frombuffer(xb, np.uint64), percent):
                    a.append(i)
                    b.append(j)
            yield _arrays({"a": (a, pa.int64()), "b": (b, pa.int64())})

    return in_arrow(pairs, run, "a long, b long")


def _within(rows: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) among nodes (part, node, comp, buckets, role, sig, shingles) of one part that share a bucket.

    Nodes of role 2 are compared with those of the roles 0 and 1, with these only if they are smaller; in a bucket
    that has role 2 only, with each other. Within a task components grow with every link found, and pairs
    inside one aren't compared: a part gives fewer links than it has nodes.
    """

    def solve(part):
        sigs = np.frombuffer(b"".join(r[5] for r in part), np.uint8).reshape(len(part), -1)
        sets = [np.frombuffer(r[6], np.uint64) for r in part]
        nodes, role = np.array([r[1] for r in part], np.int64), np.array([r[4] for r in part], np.int8)
        _, comp = np.unique(np.array([r[2] for r in part], np.int64), return_inverse=True)
        buckets: dict[int, list[int]] = {}
        for k, r in enumerate(part):
            for bucket in r[3]:
                buckets.setdefault(bucket, []).append(k)
        links = []
        for bucket, members in buckets.items():
            m = np.array(members)
            asking, others = m[role[m] == 2], m[role[m] < 2]
            for i, k in enumerate(asking.tolist()):
                rest = others[(role[others] == 0) | (nodes[others] > nodes[k])] if len(others) else asking[i + 1 :]
                rest = rest[comp[rest] != comp[k]]
                if not len(rest):
                    continue
                for j in _agreeing_here(sigs, k, rest, bucket & _BAND):
                    if comp[j] != comp[k] and _alike(sets[k], sets[j], percent):
                        links.append((part[k][1], part[j][1]))
                        comp[comp == comp[j]] = comp[k]
        return links

    def run(batches):
        held = []
        links = []
        for row in rows_of(batches, ("part", "node", "comp", "buckets", "role", "sig", "shingles")):  # sorted by part
            if held and held[-1][0] != row[0]:
                links += solve(held) if len(held) > 1 else []
                held = []
            held.append(row)
        links += solve(held) if len(held) > 1 else []
        yield _arrays({"a": ([min(x) for x in links], pa.int64()), "b": ([max(x) for x in links], pa.int64())})

    return in_arrow(rows.repartition("part").sortWithinPartitions("part"), run, "a long, b long")


def _agreeing_here(sigs: np.ndarray, k: int, rest: np.ndarray, band: int) -> list[int]:
    """Of the rest those whose signatures agree with k's often enough, and in no band before this one; the nearest first."""
    equal = sigs[rest] == sigs[k]
    agree = np.count_nonzero(equal, axis=1)
    near = np.flatnonzero(agree >= LEAST_AGREEMENT * BANDS * ROWS)
    near = near[equal[near].reshape(len(near), BANDS, ROWS).all(2).argmax(1) == band]
    return rest[near[np.argsort(-agree[near], kind="stable")]].tolist()


def _alike(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
        return False
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= percent * (len(x) + len(y) - both)


def _bands(nodes: DataFrame) -> DataFrame:
    """(node, bucket); the low bits of a bucket are its band."""
    bands = F.array(*(F.xxhash64(F.lit(k), F.substring("sig", k * ROWS + 1, ROWS)).bitwiseAND(F.lit(~_BAND)).bitwiseOR(F.lit(k)) for k in range(BANDS)))
    return nodes.select(F.col("id").alias("node"), F.explode(bands).alias("bucket"))


def _leaders(members: DataFrame, turn: int) -> DataFrame:
    """A member of each bucket, then 2, 4, ... other ones each turn."""
    n = 1 << turn
    picks = [F.min(F.struct(F.xxhash64("node", F.lit(turn * 32 + k)).alias("h"), "node", "comp")).alias(f"p{k}") for k in range(n)]
    by = members.groupBy("bucket").agg(*picks).select("bucket", F.explode(F.array_distinct(F.array(*(F.struct(f"p{k}.node", f"p{k}.comp") for k in range(n))))).alias("l"))
    return by.select("bucket", F.col("l.node").alias("lead"), F.col("l.comp").alias("lead_comp"))


def _parts(members: DataFrame) -> DataFrame:
    """(part, node, comp, buckets, role 2): parts of nodes connected through buckets, or single buckets of larger ones."""
    first = members.groupBy("bucket").agg(F.min("node").alias("a"))
    edges = members.join(first, "bucket").select("a", F.col("node").alias("b"))
    roots = materialize(components(edges), "minhash-parts")
    roots = roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
    sizes = roots.groupBy("root").agg(F.count("*").alias("nodes"))
    placed = members.join(roots, "node").join(sizes, "root").withColumn("part", F.when(F.col("nodes") <= LARGEST_PART, F.xxhash64(F.lit("part"), "root")).otherwise(F.xxhash64("bucket")))
    return placed.groupBy("part", "node").agg(F.first("comp").alias("comp"), F.collect_list("bucket").alias("buckets"), F.lit(2).alias("role"))


def _strips(members: DataFrame) -> DataFrame:
    """(part, node, comp, buckets, role) of large buckets: a part is a strip of the nodes outside the bucket's largest component (role 2) with a block of all its nodes."""
    by_comp = members.groupBy("bucket", "comp").agg(F.count("*").alias("n")).groupBy("bucket").agg(F.max(F.struct("n", "comp")).alias("most"), F.sum("n").alias("size"))
    by_comp = by_comp.select("bucket", F.col("most.comp").alias("main"), F.ceil((F.col("size") - F.col("most.n")) / SMALL).alias("strips"), F.ceil(F.col("size") / SMALL).alias("blocks"))
    rows = members.select("bucket", "node", "comp").join(by_comp, "bucket").withColumn("asks", F.col("comp") != F.col("main"))
    strip, block = F.pmod(F.xxhash64("node"), "strips"), F.pmod(F.xxhash64(F.lit(1), "node"), "blocks")
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    asked = rows.withColumn("strip", every("strips")).withColumn("block", block).withColumn("role", F.col("asks").cast("int"))
    asking = rows.filter("asks").withColumn("strip", strip).withColumn("block", every("blocks")).withColumn("role", F.lit(2))
    return asked.unionByName(asking).select(F.xxhash64(F.lit("strip"), "bucket", "strip", "block").alias("part"), "node", "comp", F.array("bucket").alias("buckets"), "role")


def near_duplicates(docs: DataFrame, *, id_col="doc_id", text_col="text", width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """Per row of `docs`: id, n_shingles, component_id, kept.

    Words are what stands between ASCII white space, A-Z lower-cased; the set holds the distinct shingles of `width` words,
    of a shorter text all its words as one. Documents are linked if 100 * intersection >= percent * union.
    component_id: the smallest id reachable, itself included. kept: id = component_id. Null, empty
    and blank texts have empty sets and link with nothing. Rows that share an id count as one
    document, null ids aren't linked with other sets (component null or the smallest id of equal
    sets) and not kept. Other columns aren't read; an empty table gives no rows. ids are integers.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    base = materialize(_sketch(texts, width), "minhash")
    classes = base.filter("key IS NOT NULL").groupBy("key").agg(F.min("id").alias("rep"))
    known = base.join(classes, "key", "left").select("id", "n", F.coalesce("rep", "id").alias("rep"), F.when(F.col("id") == F.col("rep"), F.col("sig")).alias("sig"))
    known = materialize(known, "minhash-classes")
    discard(base)
    nodes = known.filter("sig IS NOT NULL").select("id", "sig")

    shared = _bands(nodes).groupBy("bucket").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).filter("lo < hi").select("bucket")
    members = materialize(_bands(nodes).join(shared, "bucket").select("bucket", "node", F.col("node").alias("comp")), "minhash-buckets")
    involved = members.select(F.col("node").alias("id")).distinct()
    sets = materialize(_sets(texts.join(involved, "id", "left_semi"), width).dropDuplicates(["id"]), "minhash-sets")
    sigs = materialize(nodes.join(involved, "id", "left_semi").dropDuplicates(["id"]), "minhash-signatures")

    def confirmed(pairs: DataFrame) -> DataFrame:
        for name, other in (("sa", "a"), ("sb", "b")):
            pairs = pairs.join(sigs.select(F.col("id").alias(other), F.col("sig").alias(name)), other)
        pairs = _agreeing(pairs)
        for name, other in (("xa", "a"), ("xb", "b")):
            pairs = pairs.join(sets.select(F.col("id").alias(other), F.col("shingles").alias(name)), other)
        return materialize(_linked(pairs, percent), "minhash-links")

    links, turn, open_ = None, 0, members
    while turn < TURNS:  # of leaders in all buckets at first, then in large ones
        leads = materialize(_leaders(open_, turn), "minhash-leaders")
        if leads.isEmpty():
            break
        pairs = open_.join(leads, "bucket").filter("comp <> lead_comp").select(F.least("node", "lead").alias("a"), F.greatest("node", "lead").alias("b")).distinct()
        found = confirmed(pairs)
        links = found if links is None else joined.unionByName(found)
        roots = materialize(components(links), "minhash-roots")
        joined = roots.select(F.col("node").alias("a"), F.col("root").alias("b"))  # for all links so far
        rest = members.join(leads.select("bucket", F.col("lead").alias("node")), ["bucket", "node"], "left_anti")
        rest = rest.drop("comp").join(roots.withColumnRenamed("root", "comp"), "node", "left").select("bucket", "node", F.coalesce("comp", "node").alias("comp"))
        mixed = rest.groupBy("bucket").agg(F.count("*").alias("size"), F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo < hi").select("bucket", "size")
        rest = materialize(rest.join(mixed, "bucket"), "minhash-buckets")
        discard(members)
        members, turn = rest, turn + 1
        open_ = members.filter(F.col("size") > SMALL)
    if links is not None:
        parts = _parts(members.filter(F.col("size") <= SMALL).select("bucket", "node", "comp"))
        if not open_.isEmpty():
            parts = parts.unionByName(_strips(open_))
        for known_ in (sigs, sets):
            parts = parts.join(known_.withColumnRenamed("id", "node"), "node")
        roots = materialize(components(joined.unionByName(materialize(_within(parts, percent), "minhash-links"))), "minhash-roots")
    if links is None:
        out = known.withColumn("component_id", F.col("rep"))
    else:
        out = known.join(roots.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component_id", F.coalesce("root", "rep"))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))


def remove(docs: DataFrame, *, id_col="doc_id", **options) -> DataFrame:
    """`docs` with one document of each group, that of the smallest id; all columns as they were."""
    (own,) = fresh(docs.columns, "_gone")
    gone = near_duplicates(docs, id_col=id_col, **options).filter("NOT kept").select(F.col(id_col).alias(own))
    return docs.join(gone, F.col(id_col) == F.col(own), "left_anti")


def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), width=2, percent=80)
