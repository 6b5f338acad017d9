"""Benchmark decontamination (operator 7) with suffix arrays over the training texts.

Every partition of the training texts is cut into shards of a few megabytes. A shard becomes one
sequence of word ids, 0 standing for a word that no benchmark item has and for the ends of
texts. Its suffix array holds the positions from which a match can start, in the order of the
words that follow; all suffixes of all benchmark items are searched in it at once by binary search, one
word deeper at each step. What a suffix finds at the deepest level is its longest verbatim
match, what it finds at window depth are all places of that window.

The benchmark goes to the executors in blocks of at most ``BLOCK_BYTES``; a larger benchmark is
more passes over the texts, never a larger broadcast.
"""

from __future__ import annotations

from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from .common import LETTER_BYTES, chunks, fresh, in_arrow, materialize, rows_of, table, utf8

WINDOW = 13
BLOCK_BYTES = 8 << 20
SHARD_BYTES = 8 << 20


class Block:
    """Benchmark items as word ids, with the start and the rest length of every suffix."""

    def __init__(self, items: list[tuple[str, str | None]], window: int):
        words = [utf8(text).translate(LETTER_BYTES).split() for _, text in items]
        self.item_ids = [item for (item, _), w in zip(items, words, strict=True) if w]
        words = [w for w in words if w]
        self.ids: dict[bytes, int] = {}
        seqs = [np.array([self.ids.setdefault(x, len(self.ids) + 1) for x in w], np.int32) for w in words]
        self.depth = max((len(s) for s in seqs), default=0)
        starts = np.cumsum([0, *(len(s) + 1 for s in seqs)])
        self.seq = np.zeros(int(starts[-1]) + 1, np.int32)
        for s, at in zip(seqs, starts, strict=False):
            self.seq[at : at + len(s)] = s
        self.item = np.concatenate([np.full(len(s), i) for i, s in enumerate(seqs)] or [np.zeros(0, int)]).astype(np.int64)
        self.offset = np.concatenate([np.arange(len(s)) for s in seqs] or [np.zeros(0, int)]).astype(np.int64)
        self.start = np.concatenate([at + np.arange(len(s)) for s, at in zip(seqs, starts, strict=False)] or [np.zeros(0, int)]).astype(np.int64)
        lengths = np.array([len(s) for s in seqs], np.int64)
        self.rest = lengths[self.item] - self.offset if len(seqs) else np.zeros(0, np.int64)
        self.window = np.minimum(window, lengths)[self.item] if len(seqs) else np.zeros(0, np.int64)
        n = len(self.ids) + 1
        self.pairs = np.unique(self.seq[self.start].astype(np.int64) * n + self.seq[self.start + 1]) if len(seqs) else np.zeros(0, np.int64)
        self.n = n
        self.alone = np.zeros(n, bool)  # words that are a whole window
        self.alone[self.seq[self.start[self.window == 1]]] = True


def suffix_array(seq: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """The positions `at` in the order of the words from there on, up to `depth` words or the first 0.

    Ties are refined one word deeper at each step; `seq` must end with `depth` zeros.
    """
    order = at.copy()
    group = np.zeros(len(at), np.int64)
    open_ = np.arange(len(at))
    for d in range(depth):
        if not len(open_):
            break
        pos, word = order[open_], seq[order[open_] + d]
        by = np.lexsort((word, group[open_]))
        pos, word, own = pos[by], word[by], group[open_][by]
        order[open_] = pos
        new = np.ones(len(by), bool)
        new[1:] = (own[1:] != own[:-1]) | (word[1:] != word[:-1])
        group[open_] = open_[np.maximum.accumulate(np.where(new, np.arange(len(by)), 0))]
        size = np.diff(np.append(np.flatnonzero(new), len(by)))
        open_ = open_[np.repeat(size > 1, size) & (word != 0)]
    return order


def _bound(seq, sa, d, lo, hi, word, right):
    lo, hi = lo.copy(), hi.copy()
    active = np.flatnonzero(lo < hi)
    while len(active):
        mid = (lo[active] + hi[active]) >> 1
        value = seq[sa[mid] + d]
        up = value <= word[active] if right else value < word[active]
        lo[active[up]] = mid[up] + 1
        hi[active[~up]] = mid[~up]
        active = active[lo[active] < hi[active]]
    return lo


def search(seq: np.ndarray, sa: np.ndarray, block: Block):
    """For each benchmark suffix: longest match length and its interval, and the interval at window depth."""
    m = len(block.start)
    lo, hi = np.zeros(m, np.int64), np.full(m, len(sa), np.int64)
    length, best = np.zeros(m, np.int64), np.zeros((m, 2), np.int64)
    at_window = np.zeros((m, 2), np.int64)
    active = np.arange(m)
    for d in range(block.depth):
        active = active[(block.rest[active] > d) & (lo[active] < hi[active])]
        if not len(active):
            break
        word = block.seq[block.start[active] + d]
        left = _bound(seq, sa, d, lo[active], hi[active], word, False)
        right = _bound(seq, sa, d, left, hi[active], word, True)
        lo[active], hi[active] = left, right
        found = active[left < right]
        length[found], best[found, 0], best[found, 1] = d + 1, lo[found], hi[found]
        full = found[block.window[found] == d + 1]
        at_window[full, 0], at_window[full, 1] = lo[full], hi[full]
    return length, best, at_window


def _expand(intervals: np.ndarray, sa: np.ndarray):
    """All positions of the intervals, and for each the interval's index."""
    n = intervals[:, 1] - intervals[:, 0]
    which = np.repeat(np.arange(len(n)), n)
    inside = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    return sa[intervals[which, 0] + inside], which


class Shard:
    """Texts as one sequence of word ids with its suffix array, searched for a block."""

    def __init__(self, texts: list[str | None], block: Block):
        get = block.ids.get
        seqs = []
        for text in texts:
            words = utf8(text).translate(LETTER_BYTES).split()
            seqs.append(np.fromiter(map(get, words, repeat(0)), np.int32, len(words)))
        self.n_words = np.array([len(s) for s in seqs], np.int64)
        self.starts = np.cumsum([0, *(self.n_words + 1)])
        self.seq = np.zeros(int(self.starts[-1]) + block.depth + 2, np.int32)
        for s, at in zip(seqs, self.starts, strict=False):
            self.seq[at : at + len(s)] = s
        at = np.flatnonzero(self.seq)
        key = self.seq[at].astype(np.int64) * block.n + self.seq[at + 1]
        found = np.searchsorted(block.pairs, key)
        known = block.pairs[np.minimum(found, len(block.pairs) - 1)] == key if len(block.pairs) else np.zeros(len(at), bool)
        at = at[known | block.alone[self.seq[at]]]
        self.sa = suffix_array(self.seq, at, block.depth)
        self.length, self.best, self.at_window = search(self.seq, self.sa, block)
        self.block = block

    def text_of(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, positions, "right") - 1

    def window_hits(self):
        """The hit words as a mask over the sequence, and distinct pairs (text, item).

        A position lies in at most one interval of each window length, so the intervals have no more positions than the
        sequence has words for each length, however often a benchmark repeats a window.
        """
        full = np.flatnonzero(self.at_window[:, 0] < self.at_window[:, 1])
        spans, which = np.unique(np.column_stack([self.at_window[full], self.block.window[full]]), axis=0, return_inverse=True)
        owners = np.unique(which.ravel().astype(np.int64) * max(1, len(self.block.item_ids)) + self.block.item[full])  # (interval, item)
        first_owner = np.searchsorted(owners, np.arange(len(spans) + 1) * max(1, len(self.block.item_ids)))
        change = np.zeros(len(self.seq) + 1, np.int64)
        pairs, held = [], 0
        for part in _parts(spans[:, 1] - spans[:, 0]):
            pos, own = _expand(spans[part, :2], self.sa)
            np.add.at(change, pos, 1)
            np.add.at(change, pos + spans[part, 2][own], -1)
            seen = np.unique((part[own].astype(np.int64) << 32) | self.text_of(pos))  # (interval, text)
            interval, text = seen >> 32, seen & 0xFFFFFFFF
            n = first_owner[interval + 1] - first_owner[interval]
            inside = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            item = owners[np.repeat(first_owner[interval], n) + inside] % max(1, len(self.block.item_ids))
            pairs.append(np.unique(np.repeat(text, n) * len(self.block.item_ids) + item))
            held += len(pairs[-1])
            if held > 1 << 20:
                pairs, held = [np.unique(np.concatenate(pairs))], 0
        hit = np.cumsum(change[:-1]) > 0
        pairs = np.unique(np.concatenate(pairs)) if pairs else np.zeros(0, np.int64)
        return hit, pairs // max(1, len(self.block.item_ids)), pairs % max(1, len(self.block.item_ids))

    def longest(self, least: int):
        """Of each pair (text, item) the longest match of at least `least` words, the first in text and item."""
        some = np.flatnonzero(self.length >= np.minimum(least, self.block.window))
        best = tuple(np.zeros(0, np.int64) for _ in range(4))
        for part in _parts(self.best[some, 1] - self.best[some, 0]):
            pos, which = _expand(self.best[some[part]], self.sa)
            suffix = some[part][which]
            text, item, suffix, pos = (np.concatenate(x) for x in zip(best, (self.text_of(pos), self.block.item[suffix], suffix, pos), strict=True))
            by = np.lexsort((self.block.offset[suffix], pos, -self.length[suffix], item, text))
            text, item, suffix, pos = text[by], item[by], suffix[by], pos[by]
            first = np.ones(len(by), bool)
            first[1:] = (text[1:] != text[:-1]) | (item[1:] != item[:-1])
            best = text[first], item[first], suffix[first], pos[first]
        text, item, suffix, pos = best
        return text, item, pos - self.starts[text], self.block.offset[suffix], self.length[suffix]


def _parts(sizes: np.ndarray, most: int = 1 << 20):
    """Consecutive indices of about `most` in total size; one larger one stands alone."""
    if not len(sizes):
        return
    edges = np.flatnonzero(np.diff(np.cumsum(sizes) // most)) + 1
    yield from np.split(np.arange(len(sizes)), edges)


def benchmark_blocks(benchmark: DataFrame, id_col: str, text_col: str, block_bytes: int = BLOCK_BYTES):
    """The benchmark a block at a time through the driver, so that no block exceeds `block_bytes`."""
    rows = benchmark.select(F.col(id_col).cast("string"), text_col).orderBy(id_col, text_col).toLocalIterator()
    yield from chunks(((r[0] or "", r[1]) for r in rows), lambda r: 64 + len(r[1] or ""), block_bytes)


def _annotate(docs: DataFrame, block: Block, text_col: str, names: list[str]):
    """The rows of `docs` with the number of words, the hit runs (start, end, start, ...) and the items found, and the broadcast block."""
    value = docs.sparkSession.sparkContext.broadcast(block)

    def run(batches):
        block = value.value
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_col))
            at = 0
            for part in chunks(texts, lambda x: 64 + (x.as_buffer().size if x.is_valid else 0), SHARD_BYTES):
                shard = Shard([x.as_py() for x in part], block)
                hit, text, item = shard.window_hits()
                edge = np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))
                first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
                own = shard.text_of(first)
                base = shard.starts[own]
                spans, items = [[] for _ in part], [[] for _ in part]
                for k, a, b in zip(own.tolist(), (first - base).tolist(), (last - base).tolist(), strict=True):
                    spans[k] += (a, b)
                for k, i in zip(text.tolist(), item.tolist(), strict=True):
                    items[k].append(block.item_ids[i])
                rows = batch.slice(at, len(part))
                at += len(part)
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns, pa.array(shard.n_words, pa.int64()), pa.array(spans, pa.list_(pa.int64())), pa.array(items, pa.list_(pa.string()))],
                    names=[*rows.schema.names, *names],
                )

    found = (T.LongType(), T.ArrayType(T.LongType()), T.ArrayType(T.StringType()))
    return in_arrow(docs, run, T.StructType([*docs.schema.fields, *(T.StructField(n, t) for n, t in zip(names, found, strict=True))])), value


def annotate(docs: DataFrame, benchmark: DataFrame, text_col="text", item_col="item_id", item_text_col="text",
             window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, list[str]]:
    """The rows of `docs` with the number of words, hit runs and items (distinct, sorted), and the names of these three columns.

    One narrow pass over the texts for each block of the benchmark, without a shuffle if one block suffices. Otherwise the
    result of each pass is written before the next block takes its place.
    """
    names = fresh(docs.columns, "n_words", "spans", "items")
    n_words, spans, items = names
    blocks = benchmark_blocks(benchmark, item_col, item_text_col, block_bytes)
    first, second = Block(next(blocks, []), window), next(blocks, None)
    if second is None:
        return _annotate(docs, first, text_col, names)[0].withColumn(items, F.array_sort(F.array_distinct(items))), names
    # rows need an identity that all passes agree on
    (row,) = fresh([*docs.columns, *names], "row")
    keyed = materialize(docs.withColumn(row, F.monotonically_increasing_id()), "decontaminate")
    texts = keyed.select(row, text_col)
    parts = None
    for block in chain([first], (Block(b, window) for b in chain([second], blocks))):
        found, value = _annotate(texts, block, text_col, names)
        found = materialize(found.drop(text_col), "decontaminate-block")
        value.destroy()
        parts = found if parts is None else parts.unionByName(found)
    merged = parts.groupBy(row).agg(
        F.max(n_words).alias(n_words), F.flatten(F.collect_list(spans)).alias(spans), F.array_sort(F.array_distinct(F.flatten(F.collect_list(items)))).alias(items),
    )
    return keyed.join(merged, row).drop(row), names


def _n_hit(spans: str):
    """Words under the union of the runs, which overlap where several blocks hit."""
    return F.expr(f"""
CASE WHEN size(`{spans}`) > 0 THEN aggregate(
  array_sort(transform(sequence(0, size(`{spans}`) div 2 - 1), i -> struct(`{spans}`[2 * i] AS a, `{spans}`[2 * i + 1] AS b))),
  struct(0L AS n, 0L AS e),
  (s, x) -> struct(s.n + greatest(0L, x.b - greatest(x.a, s.e)) AS n, greatest(s.e, x.b) AS e),
  s -> s.n) ELSE 0L END""")


def _contaminated(names: list[str], max_hit_parts: int):
    return (_n_hit(names[1]) > 0) & (max_hit_parts * _n_hit(names[1]) >= F.col(names[0]))


def score(docs: DataFrame, benchmark: DataFrame, *, id_col="doc_id", text_col="text", max_hit_parts: int = 20, **options) -> DataFrame:
    """Per document: n_words, n_hit, n_items, items_sha256, contaminated.

    A word is hit inside any place of a window of `window` consecutive words of an item (a shorter
    item is one window); contaminated: n_hit > 0 and max_hit_parts * n_hit >= n_words. Null or
    empty texts have no words and are clean; items without words match nothing; repeated item ids
    count once, a null item id is an empty one; rows with equal ids stay separate rows. Other
    columns aren't read. An empty benchmark leaves all clean, empty documents give no rows.
    """
    found, names = annotate(docs.select(id_col, text_col), benchmark, text_col, **options)
    n_words, spans, items = names
    return found.select(
        id_col, F.col(n_words).alias("n_words"), _n_hit(spans).alias("n_hit"), F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"),
        _contaminated(names, max_hit_parts).alias("contaminated"),
    )


def remove(docs: DataFrame, benchmark: DataFrame, *, text_col="text", max_hit_parts: int = 20, **options) -> DataFrame:
    """`docs` without the contaminated rows, all columns as they were."""
    found, names = annotate(docs, benchmark, text_col, **options)
    return found.filter(~_contaminated(names, max_hit_parts)).select(docs.columns)


def longest_matches(docs: DataFrame, benchmark: DataFrame, *, id_col="doc_id", text_col="text", item_col="item_id", item_text_col="text",
                    window: int = WINDOW, least: int = 8, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The longest verbatim match of each document with each item, of `least` words or a whole shorter window.

    Rows: id, item_id, doc_word, item_word (starts, words from 0), n_words. Of equally long matches
    the first in the document, then in the item. Null and empty texts and items match nothing.
    """
    kind = docs.schema[id_col]
    schema = T.StructType([kind, T.StructField("item_id", T.StringType()), *(T.StructField(n, T.LongType()) for n in ("doc_word", "item_word", "n_words"))])
    out = None
    for items in benchmark_blocks(benchmark, item_col, item_text_col, block_bytes):
        value = docs.sparkSession.sparkContext.broadcast(Block(items, window))

        def run(batches, value=value):
            block = value.value
            for part in chunks(rows_of(batches, (id_col, text_col)), lambda r: 64 + len(r[1] or ""), SHARD_BYTES):
                text, item, word, offset, length = Shard([r[1] for r in part], block).longest(least)
                ids = pa.array([part[k][0] for k in text.tolist()], to_arrow_type(kind.dataType))
                names = pa.array([block.item_ids[i] for i in item.tolist()], pa.string())
                yield pa.RecordBatch.from_arrays([ids, names, *(pa.array(x, pa.int64()) for x in (word, offset, length))], names=schema.names)

        found = materialize(in_arrow(docs.select(id_col, text_col), run, schema), "longest-matches")
        value.destroy()
        out = found if out is None else out.unionByName(found)
    return docs.sparkSession.createDataFrame([], schema) if out is None else out


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
