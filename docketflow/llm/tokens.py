"""Token ids in fixed-width bit-packed files.

Each id takes the least number of bits that holds the vocabulary.  A file has
a header, the packed ids in blocks of ``BLOCK`` documents, and an index (ids
before each document, byte offset of each block), so numpy unpacks a block in
one pass and any document can be read on its own.

Pre-tokens (the pieces between which the byte-level BPE never merges) are
found with numpy for a whole slice of texts at once; each different one is
encoded once by the ``tokenizers`` library and kept in a bounded cache.

Defined cases: a null or empty text gives the end id alone; a null
``doc_id`` comes first; rows that repeat a ``doc_id`` keep together, in the
order of a hash of their texts, and each is a document of its own; an empty
table gives no file and an empty result; texts of any length are encoded
whole.  The strings of special tokens in a
text are encoded as the library does by default.  Only ``doc_id`` and
``text`` are read.
"""

from __future__ import annotations

import json
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import open_store, scratch, span_hashes, text_slices
from .ngrams import code_points

END = 0
BLOCK = 256
MAGIC = b"TOKBITS1"
#: Different pre-tokens that a Python worker keeps; beyond it the cache is
#: begun anew.
CACHE = 1_200_000
#: Words that are encoded in one string.
JOINED = 100
_SPECIAL = b"<|endoftext|>"


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def width(vocabulary: int) -> int:
    """Least bits that hold ids below ``vocabulary``."""
    return max(1, int(vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids as consecutive little-endian ``bits``-wide fields."""
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    out = (ids.astype(np.uint64)[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)
    return np.packbits(out.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack(raw: bytes, bits: int, n: int, skip: int = 0) -> np.ndarray:
    """``n`` ids after ``skip`` ids, as uint32."""
    if bits in (8, 16, 32):
        return np.frombuffer(raw, f"<u{bits // 8}", n, skip * bits // 8).astype("<u4")
    at = np.arange(skip, skip + n, dtype=np.int64) * bits
    data = np.frombuffer(raw + b"\0" * 8, np.uint8)
    byte, out = at >> 3, np.zeros(n, np.uint64)
    for k in range((bits + 14) // 8):
        out |= data[byte + k].astype(np.uint64) << np.uint64(8 * k)
    return (out >> (at & 7).astype(np.uint64) & np.uint64((1 << bits) - 1)).astype("<u4")


# -- pre-tokens ---------------------------------------------------------------

_LETTER, _NUMBER, _SPACE, _OTHER = 1, 2, 3, 0
_kinds: list = []


def kinds() -> np.ndarray:
    """Per code point: letter, number, white space or other, as the
    tokenizer's pattern has them."""
    if not _kinds:
        import regex
        table = np.zeros(0x110000, np.uint8)
        chars = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
        place = np.r_[0:0xD800, 0xE000:0x110000]
        for kind, pat in ((_LETTER, r"\p{L}+"), (_NUMBER, r"\p{N}+"), (_SPACE, r"\s+")):
            for m in regex.finditer(pat, chars):
                table[place[m.start():m.end()]] = kind
        _kinds.append(table)
    return _kinds[0]


def pretokens(codes: np.ndarray, off: np.ndarray) -> np.ndarray:
    r"""Starts of the matches of ``'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+|
    ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+`` in each text.

    Runs of one kind are the matches, but: the last character of a white-space
    run before something else stands alone, or with what follows if it is a
    blank; and an apostrophe that begins a match takes a contraction's letters.
    """
    n = len(codes)
    if not n:
        return np.empty(0, np.int64)
    kind = kinds()[codes]
    begin = np.zeros(n + 1, bool)
    begin[off] = True  # also the end
    first = begin[:n].copy()
    first[1:] |= kind[1:] != kind[:-1]
    space = kind == _SPACE
    # last white-space character before something else in the same text
    before = np.zeros(n, bool)
    before[:-1] = space[:-1] & ~space[1:] & ~begin[1:n]
    blank = before & (codes == 0x20)
    start = first | before
    after = np.zeros(n, bool)
    after[1:] = blank[:-1]
    start &= ~after
    # contractions
    quote = np.flatnonzero(start & (codes == 0x27))
    if len(quote):
        end = off[np.searchsorted(off, quote, side="right")]
        pad = np.concatenate([codes, np.zeros(2, codes.dtype)])
        a = np.where(quote + 1 < end, pad[quote + 1], 0)
        b = np.where(quote + 2 < end, pad[quote + 2], 0)
        one = np.isin(a, [ord(c) for c in "stmd"])
        two = np.zeros(len(quote), bool)
        for x, y in ("re", "ve", "ll"):
            two |= (a == ord(x)) & (b == ord(y))
        for hit, size in ((one, 2), (two, 3)):
            q, stop = quote[hit], end[hit]
            start[q + 1] = False
            if size == 3:
                start[q + 2] = False
            # what is left of the run begins a match, unless the text ends or
            # a blank before it has begun one
            nxt = q + size
            ok = nxt < stop
            nxt = nxt[ok]
            start[nxt] = True
    return np.flatnonzero(start)


class Encoder:
    """Ids of whole texts; one per Python worker."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(path)
        vocabulary = self.library.get_vocab()
        self.vocabulary = max(vocabulary.values()) + 1
        # bytes of each id: the byte-level alphabet has a character per byte
        self.bytes = np.zeros(self.vocabulary, np.int64)
        self.bytes[list(vocabulary.values())] = list(map(len, vocabulary))
        self.clear()

    def clear(self):
        self.hash = np.empty(0, np.uint64)
        self.at = np.zeros(0, np.int64)
        self.len = np.zeros(0, np.int64)
        self.pool = np.empty(0, np.int32)

    def learn(self, hashes: np.ndarray, texts: list[str], word: np.ndarray):
        """Encode and keep pre-tokens (hashes ascending).  Those of a blank
        and letters (``word``) can stand behind each other in one string
        without changing; the ids are told apart by their bytes."""
        order = np.concatenate([np.flatnonzero(word), np.flatnonzero(~word)])
        many = int(word.sum())
        texts = [texts[i] for i in order.tolist()]
        strings = ["".join(texts[i:min(i + JOINED, many)]) for i in range(0, many, JOINED)] + texts[many:]
        ids = [e.ids for e in self.library.encode_batch_fast(strings, add_special_tokens=False)]
        new = np.fromiter((i for x in ids for i in x), np.int32)
        ends = np.cumsum([len(t.encode()) for t in texts])
        after = np.searchsorted(np.cumsum(self.bytes[new]), ends) + 1
        n, at = np.empty(len(texts), np.int64), np.empty(len(texts), np.int64)
        n[order] = np.diff(after, prepend=0)
        at[order] = len(self.pool) + after - np.diff(after, prepend=0)
        self.pool = np.concatenate([self.pool, new])
        place = np.searchsorted(self.hash, hashes)
        self.hash = np.insert(self.hash, place, hashes)
        self.at, self.len = np.insert(self.at, place, at), np.insert(self.len, place, n)

    def encode(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets) of the texts, each with the end id."""
        raw = data.tobytes()
        if _SPECIAL in raw:
            return self._one_by_one(raw, off)
        codes, coff = code_points(data, off)
        n = len(coff) - 1
        s = pretokens(codes, coff)
        e = np.concatenate([s[1:], [len(codes)]]) if len(s) else s
        h = span_hashes((codes.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93), s, e)
        order = np.argsort(h)
        ordered = h[order]
        head = np.ones(len(h), bool)
        head[1:] = ordered[1:] != ordered[:-1]
        each = np.empty(len(h), np.int32)
        each[order] = np.cumsum(head, dtype=np.int32) - np.int32(1)
        different, example = ordered[head], order[head]
        place = np.searchsorted(self.hash, different)
        known = np.zeros(len(different), bool)
        inside = place < len(self.hash)
        known[inside] = self.hash[place[inside]] == different[inside]
        if not known.all():
            if len(self.hash) + len(different) > CACHE:  # begin anew with all that this slice needs
                self.clear()
                known[:] = False
            text, i = raw.decode("utf-8"), example[~known]
            fresh = [text[a:b] for a, b in zip(s[i].tolist(), e[i].tolist(), strict=True)]
            word = (e[i] - s[i] > 1) & (codes[s[i]] == 0x20)
            word &= kinds()[codes[np.minimum(s[i] + 1, len(codes) - 1)]] == _LETTER
            self.learn(different[~known], fresh, word)
            place = np.searchsorted(self.hash, different)
        size = self.len[place][each]
        row = np.repeat(np.arange(n), np.diff(np.searchsorted(s, coff)))
        # one end id after each text
        tokens = np.bincount(row, weights=size, minlength=n).astype(np.int64) + 1
        toff = np.concatenate([[0], np.cumsum(tokens)])
        out = np.full(toff[-1], END, np.int32)
        first = np.cumsum(size) - size
        place_of = np.arange(int(size.sum()))
        out[place_of + np.repeat(row, size)] = self.pool[np.repeat(self.at[place][each] - first, size) + place_of]
        return out, toff

    def _one_by_one(self, raw: bytes, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A special token's string joins what would be several pre-tokens."""
        texts = [raw[a:b].decode() for a, b in zip(off[:-1], off[1:], strict=True)]
        ids = [e.ids for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]
        return (np.fromiter((i for x in ids for i in (*x, END)), np.int32), np.cumsum([0, *(len(x) + 1 for x in ids)]))


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


# -- files --------------------------------------------------------------------

class FileWriter:
    """Header, blocks, index, and the index's place in the last 16 bytes."""

    def __init__(self, store, path: str, bits: int):
        self.out, self.path, self.bits = store.open_output_stream(path, compression=None), path, bits
        self.docs, self.sizes, self.blocks = [], [], [len(MAGIC) + 8]
        self.out.write(MAGIC + struct.pack("<II", bits, BLOCK))
        self.held, self.total = [], 0

    def add(self, doc_id, ids: np.ndarray):
        self.docs.append(doc_id)
        self.sizes.append(len(ids))
        self.held.append(ids)
        self.total += len(ids)
        if len(self.held) == BLOCK:
            self._flush()

    def _flush(self):
        raw = pack(np.concatenate(self.held), self.bits)
        self.out.write(raw)
        self.blocks.append(self.blocks[-1] + len(raw))
        self.held = []

    def close(self):
        if self.held:
            self._flush()
        names = json.dumps(self.docs).encode()
        index = struct.pack("<QQ", len(self.sizes), len(names)) + np.cumsum([0, *self.sizes]).astype("<u8").tobytes()
        index += np.array(self.blocks, "<u8").tobytes() + names
        self.out.write(index + struct.pack("<QQ", self.blocks[-1], len(index)))
        self.out.close()


class FileReader:
    """Random access: ``ids(i)`` is document i; ``blocks()`` reads in order."""

    def __init__(self, store, path: str):
        self.file = store.open_input_file(path)
        size = self.file.size()
        place, length = struct.unpack("<QQ", self.file.read_at(16, size - 16))
        head = self.file.read_at(len(MAGIC) + 8, 0)
        if head[:len(MAGIC)] != MAGIC:
            raise ValueError(f"{path} is not a file of packed ids")
        self.bits, self.block = struct.unpack("<II", head[len(MAGIC):])
        index = self.file.read_at(length, place)
        n, names = struct.unpack_from("<QQ", index)
        self.start = np.frombuffer(index, "<u8", n + 1, 16).astype(np.int64)
        count = -(-n // self.block) + 1
        self.at = np.frombuffer(index, "<u8", count, 16 + 8 * (n + 1)).astype(np.int64)
        self.docs = json.loads(index[len(index) - names:])

    def _block(self, b: int) -> bytes:
        return self.file.read_at(int(self.at[b + 1] - self.at[b]), int(self.at[b]))

    def ids(self, i: int) -> np.ndarray:
        b = i // self.block
        skip = int(self.start[i] - self.start[b * self.block])
        return unpack(self._block(b), self.bits, int(self.start[i + 1] - self.start[i]), skip)

    def blocks(self):
        for b in range(len(self.at) - 1):
            i, j = b * self.block, min((b + 1) * self.block, len(self.docs))
            yield i, j, unpack(self._block(b), self.bits, int(self.start[j] - self.start[i]))

    def close(self):
        self.file.close()


def _write(uri: str, path: str):
    def write(batches):
        store, base = open_store(uri)
        task, enc, out = TaskContext.get(), encoder(path), None
        # a name of its own for each attempt; only reported files are read
        name = f"{base}/ids-{task.partitionId():06d}-{task.taskAttemptId()}.tok"
        for rows, data, off in text_slices(batches):
            ids, toff = enc.encode(data, off)
            if out is None:
                out = FileWriter(store, name, width(enc.vocabulary))
            for doc, a, b in zip(rows.column("doc_id").to_pylist(), toff[:-1].tolist(), toff[1:].tolist(), strict=True):
                out.add(doc, ids[a:b])
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"part": pa.array([task.partitionId()], pa.int32()), "path": [name],
                                              "docs": [len(out.docs)], "ids": [out.total]})
    return write


def write_ids(docs: DataFrame, uri: str, path: str, partitions: int | None = None) -> DataFrame:
    """Write the ids of all documents in ascending ``doc_id`` order; returns
    the stored table of files: part, path, docs, ids.

    Documents are dealt by ranges of doc_id, so a file holds a range and
    files follow each other.  Documents of one id (or none) are in order of a
    hash of the text, equal ones in that of the rows, and may be dealt to
    several ranges.
    """
    spark = docs.sparkSession
    store, base = open_store(uri)
    store.create_dir(base, recursive=True)
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).withColumn("_h", F.xxhash64("text"))
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("doc_id").asc_nulls_first(), "_h", "_r"]
    dealt = rows.withColumn("_r", F.monotonically_increasing_id()).repartitionByRange(n, *order)
    dealt = dealt.sortWithinPartitions(*order).drop("_h", "_r")
    files = dealt.mapInArrow(_write(uri, path), "part int, path string, docs long, ids long")
    files.write.parquet(f"{uri}-files")
    return spark.read.parquet(f"{uri}-files")


def _read(uri: str, id_type):
    def read(batches):
        store, _ = open_store(uri)
        for batch in batches:
            for path, base in zip(batch.column("path").to_pylist(), batch.column("base").to_pylist(), strict=True):
                f = FileReader(store, path)
                for i, j, ids in f.blocks():
                    off = f.start[i:j + 1] - f.start[i]
                    crc = [zlib.crc32(ids[a:b]) for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(f.docs[i:j], id_type), pa.array(base + f.start[i:j]), pa.array(np.diff(off)), pa.array(crc, pa.int64())],
                        ["doc_id", "start", "n_tokens", "ids_crc32"])
                f.close()
    return read


def read_ids(files: DataFrame, uri: str, doc_type: str = "bigint") -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each document in the files."""
    from pyspark.sql.window import Window
    # one row a file: the running sum is over files, not documents
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files = files.withColumn("base", F.coalesce(F.sum("ids").over(before), F.lit(0)))
    n = max(1, files.count())
    kind = {"bigint": pa.int64(), "int": pa.int32()}.get(doc_type, pa.string())
    return files.select("path", "base").repartition(n).mapInArrow(
        _read(uri, kind), f"doc_id {doc_type}, start long, n_tokens long, ids_crc32 long")


def token_output(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Encode, write, read back: one row per document."""
    spark = docs.sparkSession
    uri = scratch(spark, "ids")
    files = write_ids(docs, uri, tokenizer or tokenizer_path())
    return read_ids(files, uri, docs.schema["doc_id"].dataType.simpleString())


def op5_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Start, length and checksum of every document's ids, from the files."""
    return token_output(spark.read.parquet(f"{sf_dir}/documents.parquet"))
