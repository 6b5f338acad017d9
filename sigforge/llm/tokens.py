"""Token-ID output (operator 1): frequency-ranked ids in a byte-aligned code, in sharded files.

1. Every text is tokenized once; its ids go, compressed, into a table in the shared folder, with the
   frequencies of the ids of each partition.
2. The frequencies add up to ranks: the most frequent id is 0. The table of ranks has the size of the vocabulary.
3. The documents are range-partitioned and sorted by id. Every partition writes one file: ranks take
   1 to 4 bytes each, their lengths stand apart in control bytes, four to a byte.
4. Files are read back block by block; lengths come from a table of 256 control bytes.

Every attempt of a task writes a file of its own name; the table of shards, which has a row from the attempt that Spark
committed only, lists the files that count, and the others are deleted at the end.
"""

from __future__ import annotations

import json
import re
import struct
import unicodedata
import uuid
import zlib
from array import array

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.fs
import regex
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import in_arrow, kept, materialize, rows_of, shared_dir, table, utf8

END_ID = 1
BLOCK_IDS = 1 << 20
#: Entries of each of two generations of the caches, of about 200 bytes.
CACHED_WORDS, CACHED_PIECES = 50_000, 250_000

MAGIC = b"SFTOK001"
_HEADER = struct.Struct("<QQQQ")  # documents, ids, control bytes, data bytes


# --- the code ---------------------------------------------------------------------------------

#: Lengths of the four values of every control byte.
LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3).astype(np.uint8) + 1


def encode(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control and data bytes of unsigned 32-bit values. A value takes the bytes it needs, low ones first."""
    values = np.ascontiguousarray(values, "<u4")
    n = len(values)
    size = np.ones(n, np.uint8)
    for k in (8, 16, 24):
        size += values >= (1 << k)
    padded = np.zeros(-(-n // 4) * 4, np.uint8)
    padded[:n] = size - 1
    control = (padded.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(1, dtype=np.uint8)
    used = np.arange(4, dtype=np.uint8) < size[:, None]
    return control.tobytes(), values.view(np.uint8).reshape(-1, 4)[used].tobytes()


def decode(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The n values, each from its bytes at the running sum of the lengths in LENGTHS."""
    size = LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    at = np.cumsum(size, dtype=np.int64) - size
    source = np.frombuffer(data + b"\0\0\0", np.uint8)
    out = source[at].astype(np.uint32)
    for k in (1, 2, 3):
        longer = np.flatnonzero(size > k)
        if not len(longer):
            break
        out[longer] |= source[at[longer] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


# --- tokenizing -------------------------------------------------------------------------------

_PLAIN = re.compile("[\t-\r\x20-\x7e\xa1-ſ]*")  # normal forms of themselves, with ASCII white space only
_CLASS = {kind: "".join(regex.escape(c) for c in map(chr, range(0x21, 0x180)) if unicodedata.category(c)[0] == kind) for kind in "LN"}
_SPACES = dict.fromkeys(range(9, 14), " ")
_NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]


def _pieces(conf: dict) -> str | None:
    """The pattern of the pieces of a word, if the tokenizer's settings make every word between white space independent of the others.

    They do if white space becomes spaces, only matches of a pattern that no space matches are kept, and no added
    token reaches beyond a word. The pattern is known if it has endings after an apostrophe, runs of letters, digits and runs of anything else.
    """
    pre = (conf.get("pre_tokenizer") or {}).get("pretokenizers") or []
    if (conf.get("normalizer") or {}).get("normalizers") != _NORMALIZERS or [p.get("type") for p in pre] != ["Split", "ByteLevel"]:
        return None
    split, level = pre
    pattern = (split.get("pattern") or {}).get("Regex") or ""
    if not split.get("invert") or split.get("behavior") != "Removed" or level.get("use_regex") or level.get("add_prefix_space"):
        return None
    if not regex.fullmatch(r"('[a-z]+\|)*\[\\p\{L\}\]\+\|\[\\p\{N\}\]\+?\|\[\^\\s\\p\{L\}\\p\{N\}\]\+", pattern):
        return None
    added = conf.get("added_tokens") or ()
    if any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") or t.get("normalized") or len(t["content"].split()) != 1 or t["content"].isalnum() for t in added):
        return None
    return None if conf.get("truncation") or conf.get("padding") else pattern


class _Generations:
    """A cache of two generations: when the younger one is full, the older one goes. Long keys aren't kept."""

    def __init__(self, entries: int):
        self.entries = entries
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def joined(self, keys: list[str], make) -> bytes:
        """The values of the keys one after the other; make() gives those that aren't cached."""
        found = list(map(self.young.get, keys))
        if None in found:
            young, old = self.young, self.old.get
            for k, value in enumerate(found):
                if value is None:
                    key = keys[k]
                    found[k] = value = young.get(key) or old(key) or make(key)
                    if len(key) <= 64:
                        young[key] = value
                        if len(young) >= self.entries:
                            self.old, self.young = young, {}
                            young, old = self.young, self.old.get
        return b"".join(found)


class Words:
    """A tokenizer with caches of the ids of pieces, where the settings make what lies between white space independent.

    Then a text of plain characters is split into pieces here and only the model of the library runs, for pieces that aren't cached.
    Of other texts every word is taken by itself; a word with other characters is left to the library. If the settings
    are of another kind, the library encodes whole texts.
    """

    def __init__(self, spec: str):
        self.tokenizer = Tokenizer.from_str(spec)
        conf = json.loads(spec)
        self.size = self.tokenizer.get_vocab_size()
        self.kind = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")
        self.code = "H" if self.kind.itemsize == 2 else "I"
        self.words, self.pieces = _Generations(CACHED_WORDS), _Generations(CACHED_PIECES)
        pattern = _pieces(conf)
        self.split = re.compile(pattern.replace("\\p{L}", _CLASS["L"]).replace("\\p{N}", _CLASS["N"])).findall if pattern else None
        self.special = re.compile("|".join(re.escape(t["content"]) for t in conf.get("added_tokens") or ()) or "(?!)").search
        self.tokenize = self.tokenizer.model.tokenize
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # the byte-level alphabet's own bytes; the others follow from 256 on
        rest = iter(range(256, 512))
        self.alphabet = {b: chr(b) if b in shown else chr(next(rest)) for b in range(256)}

    def _ids(self, text: str) -> bytes:
        return array(self.code, self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _piece(self, piece: str) -> bytes:
        mapped = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.alphabet)
        return array(self.code, [t.id for t in self.tokenize(mapped)]).tobytes()

    def _word(self, word: str) -> bytes:
        return self._plain(word) if self._is_plain(word) else self._ids(word)

    def _is_plain(self, text: str) -> bool:
        return _PLAIN.fullmatch(text) is not None and self.special(text) is None

    def _plain(self, text: str) -> bytes:
        return self.pieces.joined(self.split(text.lower()), self._piece)

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if not self.split:
            return self._ids(text)
        if self._is_plain(text):
            return self._plain(text)
        return self.words.joined(utf8(text).decode("utf-8", "replace").translate(_SPACES).split(" "), self._word)


def _words(spec: str) -> Words:
    """One tokenizer with its cache for each Python worker, which serves many tasks."""
    key = ("words", zlib.crc32(spec.encode()))
    if key not in kept:
        kept.clear()
        kept[key] = Words(spec)
    return kept[key]


def tokenize(docs: DataFrame, spec: str, id_col: str, text_col: str, end_id: int) -> DataFrame:
    """Written rows: (doc, ids) for each document, (null, counts) for each part of a partition."""
    value = docs.sparkSession.sparkContext.broadcast(spec)

    def run(batches):
        words = _words(value.value)
        end = np.array([end_id], words.kind).tobytes()
        pack = zstandard.ZstdCompressor(level=1).compress
        counts = np.zeros(max(words.size, end_id + 1), np.int64)
        names = ["doc", "n", "ids", "counts"]
        types = [pa.int64(), pa.int64(), pa.binary(), pa.binary()]
        rows, size, own = [], 0, []

        def batch():
            counts[:] += np.bincount(np.frombuffer(b"".join(own), words.kind), minlength=len(counts))
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

        for doc, text in rows_of(batches, (id_col, text_col)):
            ids = words.encode(text) + end
            own.append(ids)
            rows.append((doc, len(ids) // words.kind.itemsize, pack(ids), None))
            size += len(ids)
            if len(rows) >= 1000 or size > 8 << 20:
                yield batch()
                rows, size, own = [], 0, []
        if rows:
            yield batch()
        rows, own = [(None, None, None, pack(counts.tobytes()))], []
        yield batch()

    return materialize(in_arrow(docs.select(F.col(id_col).cast("long").alias(id_col), text_col), run, "doc long, n long, ids binary, counts binary", keeps=True), "tokens")


def ranks(tokenized: DataFrame) -> np.ndarray:
    """id by rank: the more frequent first, equal ones by id. As long as the vocabulary."""

    def run(batches):
        for batch in batches:
            for packed in batch.column(0).to_pylist():
                counts = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.int64)
                ids = np.arange(len(counts))
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(counts)], names=["id", "n"])

    got = in_arrow(tokenized.filter("counts IS NOT NULL").select("counts"), run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    ids, n = got["id"].to_numpy(np.int64), got["n"].to_numpy(np.int64)
    return ids[np.lexsort((ids, -n))].astype(np.uint32)


# --- files ------------------------------------------------------------------------------------


def _open(path: str):
    return pyarrow.fs.FileSystem.from_uri(path if "://" in path or path.startswith("/") else path.replace("file:", "file://", 1))


def _block(docs: list, counts: list[int], values: np.ndarray) -> bytes:
    control, data = encode(values)
    known = np.array([d is not None for d in docs], np.uint8)
    ids = np.array([d or 0 for d in docs], "<i8")
    return b"".join((_HEADER.pack(len(docs), len(values), len(control), len(data)), known.tobytes(), ids.tobytes(), np.array(counts, "<u8").tobytes(), control, data))


def write(tokenized: DataFrame, by_rank: np.ndarray, path: str, kind: str) -> DataFrame:
    """One file for each range of document ids; a row for each file: shard, file, n_docs, n_ids. `path` holds no other output.

    Documents with equal ids are ordered by their ids' bytes, null document ids come first.
    """
    order = np.zeros(int(by_rank.max(initial=0)) + 1, np.uint32)
    order[by_rank] = np.arange(len(by_rank), dtype=np.uint32)
    value = tokenized.sparkSession.sparkContext.broadcast(order)

    def run(batches):
        rank, unpack = value.value, zstandard.ZstdDecompressor()
        shard = TaskContext.get().partitionId()
        fs, folder = _open(path)
        name = f"{folder}/ids-{shard:06d}-{uuid.uuid4().hex}.bin"
        n_docs = n_ids = 0
        out = None
        docs, counts, parts, size = [], [], [], 0
        for doc, packed in rows_of(batches, ("doc", "ids")):
            if out is None:
                fs.create_dir(folder, recursive=True)
                out = fs.open_output_stream(name)
                out.write(MAGIC)
            ids = np.frombuffer(unpack.decompress(packed), kind)
            docs.append(doc)
            counts.append(len(ids))
            parts.append(rank[ids])
            size += len(ids)
            n_docs, n_ids = n_docs + 1, n_ids + len(ids)
            if size >= BLOCK_IDS:
                out.write(_block(docs, counts, np.concatenate(parts)))
                docs, counts, parts, size = [], [], [], 0
        if out is not None:
            if docs:
                out.write(_block(docs, counts, np.concatenate(parts)))
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in ((shard, pa.int64()), (name.rsplit("/", 1)[1], pa.string()), (n_docs, pa.int64()), (n_ids, pa.int64()))], names=["shard", "file", "n_docs", "n_ids"])

    parts = tokenized.filter("ids IS NOT NULL").select("doc", "ids").repartitionByRange("doc").sortWithinPartitions("doc", "ids")
    shards = materialize(in_arrow(parts, run, "shard long, file string, n_docs long, n_ids long"), "token-shards")
    fs, folder = _open(path)
    fs.create_dir(folder, recursive=True)
    with fs.open_output_stream(f"{folder}/ranks.bin") as f:
        f.write(by_rank.astype("<u4").tobytes())
    listed = {r.file for r in shards.select("file").toLocalIterator()}
    for info in fs.get_file_info(pyarrow.fs.FileSelector(folder)):
        if info.base_name.startswith("ids-") and info.base_name not in listed:
            fs.delete_file(info.path)
    return shards


def read_blocks(fs, name: str):
    """(document ids, ids of each, ranks) of each block of a file."""
    with fs.open_input_stream(name) as f:
        if f.read(len(MAGIC)) != MAGIC:
            raise ValueError(f"{name} isn't a file of token ids")
        while head := f.read(_HEADER.size):
            n, n_ids, n_control, n_data = _HEADER.unpack(head)
            known = np.frombuffer(f.read(n), np.uint8)
            docs, counts = np.frombuffer(f.read(8 * n), "<i8"), np.frombuffer(f.read(8 * n), "<u8").astype(np.int64)
            yield [d if k else None for d, k in zip(docs.tolist(), known.tolist(), strict=True)], counts, decode(f.read(n_control), f.read(n_data), n_ids)


def read(shards: DataFrame, path: str, id_col: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """Per document from the files: id, start (ids of all documents before it), n_tokens, ids_crc32[, ids]."""
    base = F.coalesce(F.sum("n_ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    files = shards.withColumn("base", base)
    fields = [(id_col, pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())] + [("ids", pa.list_(pa.int64()))] * with_ids

    def run(batches):
        fs, folder = _open(path)
        by_rank = None
        for name, start in rows_of(batches, ("file", "base")):
            if by_rank is None:
                with fs.open_input_stream(f"{folder}/ranks.bin") as f:
                    by_rank = np.frombuffer(f.read(), "<u4")
            for docs, counts, values in read_blocks(fs, f"{folder}/{name}"):
                ids = by_rank[values]
                at = np.cumsum(counts) - counts
                parts = [ids[a : a + n] for a, n in zip(at.tolist(), counts.tolist(), strict=True)]
                columns = [docs, start + at, counts, [zlib.crc32(p.tobytes()) for p in parts]] + [parts] * with_ids
                start += int(counts.sum())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, fields, strict=True)], names=[n for n, _ in fields])

    schema = f"`{id_col}` long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids
    n = max(1, shards.count())
    return in_arrow(files.repartitionByRange(n, "shard"), run, schema)


def encode_documents(docs: DataFrame, tokenizer: str | None = None, path: str | None = None, *, id_col="doc_id", text_col="text", end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Write the ids of every whole text to files below `path` and return what the files hold.

    tokenizer: a tokenizers file, word_bpe_49k.json by default. path: a new folder below
    spark.checkpoint.dir by default. Null and empty texts have only the end id. Rows with equal ids
    are all written, in the order of their ids; a null id comes first. Other columns aren't read.
    An empty table writes no shard and gives no rows.
    """
    spark = docs.sparkSession
    with open(tokenizer or public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        spec = f.read()
    path = path or shared_dir(spark, "token-ids")
    tokenized = tokenize(docs, spec, id_col, text_col, end_id)
    by_rank = ranks(tokenized)
    shards = write(tokenized, by_rank, path, Words(spec).kind.str)
    return read(shards, path, id_col, with_ids)


def op1_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(table(spark, sf_dir, "documents"))
