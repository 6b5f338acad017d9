"""Toxicity (operator 5): a weighted lexicon matched by Aho-Corasick on folded text.

Folding makes disguised words equal to plain ones: lower case, look-alike letters of other scripts
and full-width forms to Latin, digit and sign substitutions to letters, invisible characters away.
Lexicon entries are whole words or word beginnings that labelled toxic rows prefer;
exception phrases of one to three words, which clean rows prefer, cancel the entries inside them. Every match counts, and the counts are
normalised by length: an entry's feature is the number of its matches by the root of the words for each ``PER``. The weights come from a logistic
regression with an L1 penalty on the labelled rows, together with a constant; the logistic curve of the sum is the score.

The model is fitted on at most ``MAX_ROWS`` labelled rows, in the order of a hash of their ids; all
rows are scored.
"""

from __future__ import annotations

import math
import re
import zlib
from bisect import bisect_right
from collections import Counter
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh, in_arrow, rows_of, table, take

MAX_ROWS = 12_000
MAX_ENTRIES = 3_000
SHORTEST, LONGEST = 3, 16
#: A match counts 1 in a text of PER - SMOOTH words, and a half in one of about four times as many.
PER, SMOOTH = 40.0, 20.0

# Letters of other scripts that look like Latin ones.
HOMOGLYPHS = str.maketrans({
    "а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y", "х": "x",
    "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "ԛ": "q", "ԝ": "w", "һ": "h", "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i",
    "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ɑ": "a", "ɡ": "g", "ı": "i", "ӏ": "i",
    **{chr(0xFF01 + k): chr(0x21 + k) for k in range(94)},
    **{c: None for c in "­​‌‍⁠﻿"},
})
OTHER_SCRIPT = re.compile("[­ıɑɡͰ-ԯ​-‍⁠﻿！-～]")
# Digits and signs that stand for letters. l and i become one letter, since 1 and ! stand for both.
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i", "|": "i", "l": "i"}
FOLD = bytes(ord(SUBSTITUTES.get(chr(b), chr(b))) if b >= 128 or chr(b).isalpha() or chr(b) in SUBSTITUTES else 32 for b in range(256))


_LAST_SIGNS = re.compile(r"[!|]+(?![^\W_]|[@$])")  # no letters: nothing follows them in the word


def fold(text: str | None) -> str:
    """Folded words with one space between and around them; "" and null fold to one space."""
    if not text:
        return " "
    text = text.lower()
    if not text.isascii() and OTHER_SCRIPT.search(text):
        text = text.translate(HOMOGLYPHS)
    if "!" in text or "|" in text:
        text = _LAST_SIGNS.sub(" ", text)
    words = text.encode("utf-8", "replace").translate(FOLD).decode().split(" ")
    return f" {' '.join(filter(None, words))} " if any(words) else " "


def _by_length(n: int) -> float:
    return math.sqrt(PER / (n + SMOOTH))


@dataclass
class Model:
    entries: dict[str, float]  # folded, with the leading space; a trailing space makes it a whole word
    exceptions: list[str] = field(default_factory=list)  # folded, with a space before and after
    constant: float = -4.0

    def automaton(self):
        out = ahocorasick.Automaton()
        for k, w in self.entries.items():
            out.add_word(k, (k, w))
        for k in self.exceptions:
            out.add_word(k, (k, None))
        if len(out):
            out.make_automaton()
        return out

    def scores(self, texts, automaton) -> list[float]:
        out = []
        for text in texts:
            found, n = matches(fold(text), automaton)
            z = self.constant + sum(self.entries[k] * c for k, c in Counter(k for _, k in found).items()) * _by_length(n)
            out.append(1 / (1 + math.exp(-max(-30.0, min(30.0, z)))))
        return out


def matches(folded: str, automaton) -> tuple[list[tuple[int, str]], int]:
    """All places (start, entry) of lexicon entries that no exception phrase covers, and the number of words.

    Time is that of the text and the matches: the exceptions' ends are looked up by their starts.
    """
    n = folded.count(" ") - 1
    if n < 1 or not len(automaton):
        return [], max(0, n)
    found, spared = [], []
    for end, (k, w) in automaton.iter(folded):
        (spared if w is None else found).append((end - len(k) + 1, k))
    if spared:
        spared.sort()
        starts, reach, far = [a for a, _ in spared], [], -1
        for a, k in spared:
            far = max(far, a + len(k))
            reach.append(far)
        found = [(a, k) for a, k in found if not ((i := bisect_right(starts, a)) and reach[i - 1] >= a + len(k))]
    return found, n


def held_out(doc_id) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0


def _counts(rows: DataFrame, text_col: str, label_col: str) -> DataFrame:
    """In how many texts of each label every word beginning and whole word occurs."""
    schema = "entry string, bad long, good long"

    def flush(count):
        keys = list(count[0].keys() | count[1].keys())
        columns = (pa.array(keys, pa.string()), pa.array([count[1][k] for k in keys], pa.int64()), pa.array([count[0][k] for k in keys], pa.int64()))
        return pa.RecordBatch.from_arrays(list(columns), names=["entry", "bad", "good"])

    def run(batches):
        count = (Counter(), Counter())
        for part in take(rows_of(batches, (text_col, label_col)), 64):
            for text, label in part:
                words = set(fold(text).split())
                own = {w[:n] for w in words if len(w) >= SHORTEST for n in range(SHORTEST, min(len(w), LONGEST) + 1)}
                own |= {w + " " for w in words if SHORTEST <= len(w) <= LONGEST}
                count[label].update(own)
                if len(count[0]) + len(count[1]) > 400_000:
                    yield flush(count)
                    count = (Counter(), Counter())
        yield flush(count)

    return in_arrow(rows, run, schema).groupBy("entry").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))


def fit(docs: DataFrame, labels: DataFrame, *, id_col="doc_id", text_col="text", label_col="toxic", max_rows: int = MAX_ROWS,
        max_entries: int = MAX_ENTRIES, least: int = 3, least_odds: float = 2.0) -> Model:
    """Lexicon, weights, exceptions and curve from labelled rows with crc32(id as text) mod 5 other than 0.

    At most `max_rows` labelled rows are used, the first by a hash of the id; of repeated or
    conflicting labels of an id the largest counts; null ids and labels, and labels without a document, are left out. Without
    rows of both labels the lexicon is empty and all scores are low.
    """
    known = (
        labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_label"))
        .filter(F.col("_id").isNotNull() & F.col("_label").isin(0, 1) & (F.crc32(F.col("_id").cast("string").cast("binary")) % 5 != 0))
        .groupBy("_id").agg(F.max("_label").alias("_label"))
        .orderBy(F.xxhash64("_id"), "_id").limit(max_rows)
    )
    known = docs.sparkSession.createDataFrame(known.collect(), known.schema)  # bounded by max_rows
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(F.broadcast(known), "_id").select("_text", "_label")
    total = {r[0]: r[1] for r in rows.groupBy("_label").count().collect()}  # labels without a document don't count
    bad, good = total.get(1, 0), total.get(0, 0)
    if not bad or not good:
        return Model({})
    odds = F.log((F.col("bad") + 0.5) / (bad + 1.0)) - F.log((F.col("good") + 0.5) / (good + 1.0))
    found = _counts(rows, "_text", "_label").withColumn("odds", odds)
    strong = (
        found.filter((F.col("bad") >= max(least, bad // 200)) & (F.col("odds") >= least_odds))
        .orderBy(F.desc("bad"), F.desc("odds"), "entry").limit(4 * max_entries).collect()
    )
    by = {r.entry: r for r in strong}
    model = _weigh(Model({f" {e}": float(by[e].odds) for e in _closed(by, max_entries)}), rows)
    clean = (F.col("good") >= 2) & (F.col("good") * (bad + 1.0) > F.col("bad") * (good + 1.0))
    spared = [r[0] for r in _contexts(rows, model).filter(clean).orderBy(F.desc("good"), "phrase").limit(max_entries).select("phrase").collect()]
    return _weigh(Model(model.entries, spared), rows) if spared else model


def _contexts(rows: DataFrame, model: Model) -> DataFrame:
    """(phrase, bad, good): in how many texts of each label a word that begins like an entry, alone or with its neighbours, occurs."""

    def run(batches):
        automaton = model.automaton()
        for part in take(rows_of(batches, ("_text", "_label")), 256):
            count = (Counter(), Counter())
            for text, label in part:
                folded = fold(text)
                words, own = folded.split(), set()
                starts = [0]
                for w in words:
                    starts.append(starts[-1] + len(w) + 1)
                for at, entry in matches(folded, automaton)[0]:
                    i = bisect_right(starts, at) - 1
                    own.update(f" {' '.join(words[a:z])} " for a, z in ((i - 1, i + 1), (i, i + 2), (i - 1, i + 2)) if a >= 0 and z <= len(words))
                    if not entry.endswith(" "):
                        own.add(f" {words[i]} ")
                count[label].update(own)
            keys = list(count[0].keys() | count[1].keys())
            columns = (pa.array(keys, pa.string()), pa.array([count[1][k] for k in keys], pa.int64()), pa.array([count[0][k] for k in keys], pa.int64()))
            yield pa.RecordBatch.from_arrays(list(columns), names=["phrase", "bad", "good"])

    return in_arrow(rows, run, "phrase string, bad long, good long").groupBy("phrase").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))


def _closed(by: dict, most: int) -> list[str]:
    """Of beginnings that occur in the same texts only the longest; at most `most`, those in most toxic texts first."""
    extended: dict[str, int] = {}
    for e, r in by.items():
        if e[:-1] in by:
            extended[e[:-1]] = max(extended.get(e[:-1], 0), r.bad)
    return sorted((e for e, r in by.items() if extended.get(e, 0) < 0.97 * r.bad), key=lambda e: (-by[e].bad, e))[:most]


def _weigh(model: Model, rows: DataFrame, penalty: float = 0.3) -> Model:
    """Weights of the entries and the constant by proximal gradient steps; entries of no weight go, exceptions stay."""
    names = list(model.entries)
    number = {e: k for k, e in enumerate(names)}

    def run(batches):
        automaton = model.automaton()
        for part in take(rows_of(batches, ("_text", "_label")), 512):
            got = [matches(fold(r[0]), automaton) for r in part]
            counts = [Counter(number[k] for _, k in x) for x, _ in got]
            columns = [
                pa.array([list(c) for c in counts], pa.list_(pa.int32())), pa.array([[v * _by_length(n) for v in c.values()] for c, (_, n) in zip(counts, got, strict=True)], pa.list_(pa.float64())),
                pa.array([r[1] for r in part], pa.int32()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["e", "x", "y"])

    got = in_arrow(rows, run, "e array<int>, x array<double>, y int").collect()  # bounded by max_rows
    y = np.array([r.y for r in got], float)
    row = np.repeat(np.arange(len(got)), [len(r.e) for r in got])
    col, x = np.array([k for r in got for k in r.e], np.int64), np.array([v for r in got for v in r.x], float)
    w, constant = np.zeros(len(names)), 0.0
    widest, highest = np.bincount(row, x, len(got)).max(initial=0), np.bincount(col, x, max(1, len(names))).max(initial=0)
    rate, momentum, seen = 1.0 / max(0.25 * (widest * highest + len(got)), 1.0), 1.0, (w, constant)
    for _ in range(3000):
        z = np.bincount(row, x * seen[0][col], len(got)) + seen[1]
        g = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y
        new_w, new_constant = np.maximum(0.0, seen[0] - rate * (np.bincount(col, x * g[row], len(names)) + penalty)), seen[1] - rate * g.sum()
        later = (1 + math.sqrt(1 + 4 * momentum**2)) / 2
        seen = (new_w + (momentum - 1) / later * (new_w - w), new_constant + (momentum - 1) / later * (new_constant - constant))
        done = max(np.abs(new_w - w).max(initial=0), abs(new_constant - constant)) < 1e-6
        w, constant, momentum = new_w, new_constant, later
        if done:
            break
    entries = {e: float(v) for e, v in sorted(zip(names, w, strict=True), key=lambda v: (-v[1], v[0])) if v > 1e-3}
    return Model(entries, model.exceptions, float(constant))


def annotate(docs: DataFrame, model: Model, *, text_col="text", score_col="score") -> DataFrame:
    """`docs` with a column of scores; null texts score as empty ones. A narrow pass."""
    schema = T.StructType([*docs.schema.fields, T.StructField(score_col, T.DoubleType())])

    def run(batches):
        automaton = model.automaton()
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                texts = part.column(part.schema.get_field_index(text_col)).to_pylist()
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(model.scores(texts, automaton), pa.float64())], names=schema.names)

    return in_arrow(docs, run, schema)


def remove(docs: DataFrame, model: Model, *, text_col="text", threshold: float = 0.5) -> DataFrame:
    """`docs` without rows that score at least `threshold`; all columns as they were."""
    (own,) = fresh(docs.columns, "_score")
    return annotate(docs, model, text_col=text_col, score_col=own).filter(F.col(own) < threshold).select(docs.columns)


def score(docs: DataFrame, labels: DataFrame, *, id_col="doc_id", text_col="text", **options) -> DataFrame:
    """Per document: held_out, score, predicted. Null and empty texts score low; an empty table gives no rows.

    Rows with equal ids or texts each get a row; a null id isn't held out; other columns aren't read.
    """
    model = fit(docs, labels, id_col=id_col, text_col=text_col, **options)
    (own,) = fresh((id_col, text_col), "_score")
    out = annotate(docs.select(id_col, text_col), model, text_col=text_col, score_col=own)
    return out.select(
        id_col, F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False)).alias("held_out"),
        F.col(own).alias("score"), (F.col(own) >= 0.5).cast("int").alias("predicted"),
    )


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
