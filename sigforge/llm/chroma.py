"""Media columns (operator 3): chroma audio fingerprints and their alignment.

A recording (WAV bytes) becomes frames of twelve pitch classes: spectra of overlapping windows,
folded over octaves and normalised. Sixteen filters compare rectangles of the frames through an integral image; each gives
two bits by the logarithm of the ratio, together an integer of 32 bits for each frame. Two recordings are aligned by the histogram of
the offsets of their equal integers; at each offset with enough of them, the most first, the share of differing bits decides.
Any overlap of ``LEAST_OVERLAP`` places will do; one of less than half of the shorter recording needs equal integers
of ``LEAST_COMMON`` different values, so that silence alone doesn't align an end with a start.

The index of a search holds a block of at most ``BLOCK_QUERIES`` distinct query fingerprints, which is broadcast; every
distinct fingerprint is matched with it in one narrow pass for each block.

The driver's tables have no sound. The query plays each row of `embeddings`: a component is a note.
"""

from __future__ import annotations

import io
import wave

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import chunks, materialize, rows_of, table

RATE = 4000
WINDOW, HOP = 1024, 256
LOWEST, HIGHEST = 100.0, 1800.0
FILTERS = 16
WIDTHS = (4, 6, 8, 12, 16)
STEPS = (-0.15, 0.0, 0.15)
BLOCK_QUERIES = 4096
LEAST_COMMON, LEAST_OVERLAP, MOST_ERRORS = 2, 8, 0.25


def tones(values, rate: int = RATE, seconds: float = 0.128) -> bytes:
    """WAV bytes of one note for each number: two octaves above 220 Hz for -3 to 3, with an octave above."""
    v = np.nan_to_num(np.asarray(values, float), nan=0.0, posinf=3.0, neginf=-3.0)
    n = int(rate * seconds)
    pitch = 220.0 * 2 ** (np.round((np.clip(v / max(1e-9, np.abs(v).max(initial=0)), -1, 1) + 1) * 12) / 12)
    phase = 2 * np.pi * np.cumsum(np.repeat(pitch, n)) / rate
    sound = np.sin(phase) + 0.4 * np.sin(2 * phase)
    return to_wav((sound * 12000).astype("<i2"), rate)


def to_wav(samples: np.ndarray, rate: int = RATE) -> bytes:
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(2)
        w.setframerate(rate)
        w.writeframes(samples.astype("<i2").tobytes())
    return out.getvalue()


def samples(media: bytes | None) -> np.ndarray:
    """Mono samples at RATE of 16-bit WAV bytes; none of null, empty or unreadable ones."""
    try:
        with wave.open(io.BytesIO(media or b""), "rb") as w:
            if w.getsampwidth() != 2 or not w.getframerate():
                return np.zeros(0)
            x = np.frombuffer(w.readframes(w.getnframes()), "<i2").astype(float)
            x, rate = x[: len(x) // w.getnchannels() * w.getnchannels()].reshape(-1, w.getnchannels()).mean(1), w.getframerate()
    except (wave.Error, EOFError):
        return np.zeros(0)
    if rate != RATE and len(x):
        x = np.interp(np.arange(int(len(x) * RATE / rate)) * rate / RATE, np.arange(len(x)), x)
    return x


def chroma(x: np.ndarray) -> np.ndarray:
    """Frames by twelve pitch classes, each frame of length 1 (silence: 0)."""
    n = (len(x) - WINDOW) // HOP + 1
    if n <= 0:
        return np.zeros((0, 12))
    hertz = np.fft.rfftfreq(WINDOW, 1 / RATE)
    used = np.flatnonzero((hertz >= LOWEST) & (hertz <= HIGHEST))
    fold = np.zeros((len(used), 12))
    fold[np.arange(len(used)), np.round(12 * np.log2(hertz[used] / 440.0)).astype(int) % 12] = 1
    out = []
    for at in range(0, n, 2048):  # long recordings a part at a time
        m = min(2048, n - at)
        frames = np.lib.stride_tricks.sliding_window_view(x[at * HOP : (at + m - 1) * HOP + WINDOW], WINDOW)[::HOP] * np.hanning(WINDOW)
        out.append((np.abs(np.fft.rfft(frames)[:, used]) ** 2) @ fold)
    energy = np.concatenate(out)
    size = np.linalg.norm(energy, axis=1, keepdims=True)
    return np.where(size > 1e-6, energy / np.maximum(size, 1e-12), 0.0)


def _filters() -> list[tuple[int, int, int, int]]:
    """(kind, width, first pitch class, number of pitch classes) by rule: kinds, widths and bands in turn."""
    return [(k % 4, WIDTHS[k % len(WIDTHS)], (5 * k) % 9, 3 + k % 2) for k in range(FILTERS)]


def codes(frames: np.ndarray) -> np.ndarray:
    """A 32-bit integer for each place where the widest filter fits."""
    widest = max(WIDTHS)
    n = len(frames) - widest + 1
    if n <= 0:
        return np.zeros(0, np.uint32)
    image = np.zeros((len(frames) + 1, 13))
    image[1:, 1:] = frames.cumsum(0).cumsum(1)
    at = np.arange(n)

    def box(t0, t1, p0, p1):
        return image[at + t1, p1] - image[at + t0, p1] - image[at + t1, p0] + image[at + t0, p0]

    out = np.zeros(n, np.uint32)
    for kind, w, p, h in _filters():
        half, middle = w // 2, p + (h + 1) // 2
        if kind == 0:  # all against the rest of the pitch classes
            a, b = box(0, w, p, p + h), (box(0, w, 0, 12) - box(0, w, p, p + h)) * h / (12 - h)
        elif kind == 1:  # earlier against later
            a, b = box(0, half, p, p + h), box(half, w, p, p + h)
        elif kind == 2:  # lower against higher pitch classes
            a, b = box(0, w, p, middle), box(0, w, middle, p + h)
        else:  # checkerboard
            a = box(0, half, p, middle) + box(half, w, middle, p + h)
            b = box(half, w, p, middle) + box(0, half, middle, p + h)
        level = np.searchsorted(STEPS, np.round(np.log((1 + np.maximum(a, 0)) / (1 + np.maximum(b, 0))), 9), "right").astype(np.uint32)
        out = (out << np.uint32(2)) | (level ^ (level >> np.uint32(1)))  # neighbouring levels differ in one bit
    return out


class Index:
    """Query fingerprints by code."""

    def __init__(self, fingerprints: list[np.ndarray]):
        self.fingerprints = fingerprints
        size = [len(f) for f in fingerprints]
        code = np.concatenate(fingerprints) if fingerprints else np.zeros(0, np.uint32)
        by = np.argsort(code, kind="stable")
        self.code = code[by]
        self.query = np.repeat(np.arange(len(size)), size)[by]
        self.place = (np.arange(len(code)) - np.repeat(np.cumsum(size) - size, size).astype(int))[by] if len(code) else by

    def align(self, fingerprint: np.ndarray) -> list[tuple[int, int, float]]:
        """(query, offset, share of differing bits) of all queries that align; offset: place here less place there."""
        low, high = np.searchsorted(self.code, fingerprint, "left"), np.searchsorted(self.code, fingerprint, "right")
        n = high - low
        at = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        here = np.repeat(np.arange(len(fingerprint)), n)
        reach = np.int64(1 << 24)
        key, count = np.unique(self.query[at] * (2 * reach) + (here - self.place[at]) + reach, return_counts=True)
        query, offset = key // (2 * reach), key % (2 * reach) - reach
        query, offset, count = (x[count >= LEAST_COMMON] for x in (query, offset, count))
        by = np.lexsort((offset, np.abs(offset), -count, query))
        out, matched = [], -1
        for q, o in zip(query[by].tolist(), offset[by].tolist(), strict=True):
            if q == matched:
                continue
            other = self.fingerprints[q]
            a, z = max(0, o), min(len(fingerprint), len(other) + o)
            if z - a < LEAST_OVERLAP:
                continue
            x, y = fingerprint[a:z], other[a - o : z - o]
            errors = int(np.bitwise_count(x ^ y).sum()) / (32 * (z - a))
            if errors > MOST_ERRORS or z - a < min(len(fingerprint), len(other)) // 2 and len(np.unique(x[x == y])) < LEAST_COMMON:
                continue
            out.append((q, o, errors))
            matched = q
        return out


def fingerprint(media: DataFrame, *, id_col: str, media_col: str) -> DataFrame:
    """(id, codes) of every recording; null, empty, unreadable and too short ones have no codes. A narrow pass."""

    def run(batches):
        for part in chunks(rows_of(batches, (id_col, media_col)), lambda r: 64 + len(r[1] or b""), 4 << 20):
            out = [codes(chroma(samples(r[1]))).tobytes() for r in part]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in part], pa.int64()), pa.array(out, pa.binary())], names=["id", "codes"])

    return media.select(F.col(id_col).cast("long").alias(id_col), media_col).mapInArrow(run, "id long, codes binary")


def search(fingerprints: DataFrame, queries: DataFrame, block: int = BLOCK_QUERIES) -> DataFrame:
    """Per row of `fingerprints` (id, codes): id, n_codes, codes_crc32, class_id, n_matches, best_query, best_offset, best_errors.

    class_id: the smallest id with the same codes. n_matches: number of rows of `queries` (id, codes) that
    align with it; best_*: of the one with the fewest errors, then the smallest offset and id; null without any.
    Recordings without codes match nothing, and are one class. Null ids count as matches but are never named.
    """
    spark = fingerprints.sparkSession
    classes = materialize(fingerprints.groupBy("codes").agg(F.min("id").alias("class_id")), "chroma-classes")
    asked = materialize(queries.filter(F.length("codes") > 0).groupBy("codes").agg(F.min("id").alias("id"), F.count("*").alias("n")), "chroma-queries")
    schema = T.StructType([T.StructField("codes", T.BinaryType()), T.StructField("n_matches", T.LongType()), T.StructField("best_errors", T.DoubleType()), T.StructField("best_offset", T.LongType()), T.StructField("best_query", T.LongType())])
    found = spark.createDataFrame([], schema)
    for part in chunks(asked.toLocalIterator(), lambda r: 1, block):  # a block of the query set at a time
        index = spark.sparkContext.broadcast((Index([np.frombuffer(r.codes, np.uint32) for r in part]), [r.id for r in part], [r.n for r in part]))

        def run(batches, index=index):
            known, ids, n = index.value
            for some in chunks(rows_of(batches, ("codes",)), lambda r: 1, 256):
                out = []
                for (own,) in some:
                    got = known.align(np.frombuffer(own, np.uint32))
                    if got:
                        best = min((e, o, ids[q]) for q, o, e in got if ids[q] is not None) if any(ids[q] is not None for q, _, _ in got) else (None, None, None)
                        out.append((own, sum(n[q] for q, _, _ in got), *best))
                if out:
                    types = (pa.binary(), pa.int64(), pa.float64(), pa.int64(), pa.int64())
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=schema.names)

        found = found.unionByName(classes.select("codes").mapInArrow(run, schema))
    best = F.min(F.struct("best_errors", "best_offset", "best_query"))
    found = found.groupBy("codes").agg(F.sum("n_matches").alias("n_matches"), best.alias("best"))
    known = classes.join(found, "codes", "left")
    out = fingerprints.join(known, "codes")
    return out.select(
        "id", (F.length("codes") / 4).cast("long").alias("n_codes"), F.crc32("codes").alias("codes_crc32"), "class_id", F.coalesce("n_matches", F.lit(0)).alias("n_matches"),
        "best.best_query", "best.best_offset", F.round("best.best_errors", 6).alias("best_errors"),
    )


def _played(vectors: DataFrame) -> DataFrame:
    def run(batches):
        for part in chunks(rows_of(batches, ("vec_id", "embedding")), lambda r: 1, 64):
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in part], pa.int64()), pa.array([tones(r[1]) if r[1] else None for r in part], pa.binary())], names=["vec_id", "media"])

    return vectors.select("vec_id", "embedding").mapInArrow(run, "vec_id long, media binary")


def op3_chroma(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows of embeddings, played; the recordings whose id is divisible by 20 are the queries."""
    prints = materialize(fingerprint(_played(table(spark, sf_dir, "embeddings")), id_col="vec_id", media_col="media"), "chroma")
    return search(prints, prints.filter("id % 20 = 0")).withColumnRenamed("id", "vec_id")
