"""Token ids of documents in binary shards: one zstandard dictionary, one frame a document.

A shard, little-endian: the magic ``TGIDS001``, the SHA-256 of the dictionary (32 bytes), the width of an
id in bytes (u32: 2 or 4), the number of documents (u32), a byte per document (1: it has an id),
document ids (i64 each), numbers of token ids (u64 each), offsets of the frames (u64, one more than
documents), then the frames. Every document is a frame of its own, so reading a short document means
reading its offsets and decompressing its frame only.

Shards of some megabytes are binary values of a Parquet table ``shards`` (with the ranges of document ids
beside them, which a reader can push down), the dictionary is in the table ``dictionary``: both
work on every file system that Spark reaches, and a lost task is simply written again.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct
import zlib
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidegate.llm.common import mixed, partitions, powers, released

MAGIC = b"TGIDS001"
HEAD = "<8s32sII"
SHARD_BYTES = 4 << 20
DICTIONARY_BYTES, LEVEL = 64 << 10, 3
SAMPLE_DOCUMENTS, SAMPLE_BYTES = 2000, 8 << 20  # what the dictionary is trained on, at most
CHARS_A_RANGE = 64_000_000
# Texts of which every step of such a tokenizer is known: lower-case letters that no normalisation changes,
# digits, white space and marks of ASCII, but no apostrophe (endings like 's) and no special token. Their
# pieces are runs of letters, single digits and runs of marks.
PLAIN = re.compile(r"[a-zß-öø-ÿ0-9\x20\x09-\x0d!\"#$%&()*+,\-./:;<=>?@\[\\\]^_`{|}~]*")
_BLANK_BYTE = re.compile(rb"[\x20\x09-\x0d]")
RUN = 1 << 18  # bytes of text that are cut into words at once
SLOTS, LONGEST = 1 << 20, 128  # of the table of known words; bytes of a word that it may hold
KNOWN, KNOWN_IDS = SLOTS // 2, 1 << 22  # words and ids at which it starts anew
_U = np.uint64
# kinds of bytes: blanks, letters, digits (each a piece of its own), marks; or blanks and others
_PIECES, _CHUNKS = np.full(256, 3, np.uint8), np.ones(256, np.uint8)
_PIECES[[*range(97, 123), *range(128, 256)]], _PIECES[48:58] = 1, 2
_PIECES[[9, 10, 11, 12, 13, 32]] = _CHUNKS[[9, 10, 11, 12, 13, 32]] = 0
_BYTE = mixed(np.arange(256, dtype=np.uint64) + _U(5000))
_BASES = (0x5851F42D4C957F2D, 0x9E3779B97F4A7C15)
_INVERSES = tuple(pow(b, -1, 1 << 64) for b in _BASES)


class Known:
    """Ids of words by 96 bits of two hashes: arrays of fixed size, searched for many words at once."""

    def __init__(self):
        self.key, self.check = np.zeros(SLOTS, np.uint64), np.zeros(SLOTS, np.uint32)
        self.begin, self.size = np.zeros(SLOTS, np.int64), np.zeros(SLOTS, np.int32)
        self.words, self.n_ids, self.ids = 0, 0, np.zeros(1 << 16, np.uint32)

    def full(self) -> bool:
        return self.words > KNOWN or self.n_ids > KNOWN_IDS

    @staticmethod
    def _slots(key: np.ndarray) -> np.ndarray:
        return (key >> _U(65 - SLOTS.bit_length())).astype(np.int64)

    def find(self, key: np.ndarray, check: np.ndarray) -> np.ndarray:
        """The slot of each word, -1 if it is not known."""
        out, rows, at = np.full(len(key), -1), np.arange(len(key)), self._slots(key)
        while len(rows):
            here = self.key[at]
            hit = (here == key[rows]) & (self.check[at] == check[rows])
            out[rows[hit]] = at[hit]
            further = ~hit & (here != 0)
            rows, at = rows[further], (at[further] + 1) % SLOTS
        return out

    def append(self, ids: np.ndarray) -> int:
        """Where the ids begin."""
        begin, self.n_ids = self.n_ids, self.n_ids + len(ids)
        if self.n_ids > len(self.ids):
            self.ids = np.concatenate((self.ids[:begin], np.zeros(max(begin, len(ids)), np.uint32)))
        self.ids[begin : self.n_ids] = ids
        return begin

    def put(self, key: np.ndarray, check: np.ndarray, begin: np.ndarray, size: np.ndarray) -> None:
        """Different words that are not known."""
        rows, at = np.arange(len(key)), self._slots(key)
        self.words += len(key)
        while len(rows):
            free = np.flatnonzero(self.key[at] == 0)
            slot, first = np.unique(at[free], return_index=True)
            who = rows[free[first]]
            self.key[slot], self.check[slot], self.begin[slot], self.size[slot] = key[who], check[who], begin[who], size[who]
            left = np.ones(len(rows), bool)
            left[free[first]] = False
            rows, at = rows[left], (at[left] + 1) % SLOTS


def _hashes(joined: np.ndarray, starts: np.ndarray, ends: np.ndarray, plain: bool) -> tuple[np.ndarray, np.ndarray]:
    """(64 bits, never 0, and 32 more) of each word; a chunk and a piece of the same bytes differ."""
    value, found = _BYTE[joined], []
    for base, inverse in zip(_BASES, _INVERSES):
        total = np.concatenate(([_U(0)], np.cumsum(value * powers(base, len(joined)), dtype=np.uint64)))
        found.append(mixed((total[ends] - total[starts]) * powers(inverse, len(joined))[starts] + _U(plain)))
    return found[0] | _U(1), (found[1] >> _U(32)).astype(np.uint32)


def _parts(text: bytes) -> list[bytes]:
    """A text cut at blanks, so that no part is much longer than RUN."""
    if len(text) <= RUN:
        return [text]
    out, begin = [], 0
    while begin < len(text):
        blank = _BLANK_BYTE.search(text, begin + RUN)
        end = blank.start() if blank else len(text)
        out.append(text[begin:end])
        begin = end
    return out


@lru_cache(maxsize=2)
def encoder(path: str) -> Callable[[list[bytes]], list[bytes]]:
    """Texts (UTF-8) to little-endian unsigned 32-bit ids, as the tokenizers library gives them.

    If the file says that white space is dropped between words, no token reaches over white space, so
    the ids of a text are those of its chunks between white space, and if it is PLAIN those of a chunk are
    the ids of its pieces. Both are words of a table of bounded size, which tasks of one worker share; what it
    does not hold is encoded by the library.
    """
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    spec = json.loads(tokenizer.to_str())
    steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
    first, model = steps[0], spec.get("model") or {}
    chunked = (
        first.get("type") == "Split" and first.get("behavior") == "Removed" and first.get("invert") is True
        and "|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+" in (first.get("pattern") or {}).get("Regex", "") and not spec.get("post_processor")
    )

    def whole(texts: list[str]) -> list[np.ndarray]:
        found = tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, np.uint32) for x in found]

    if not chunked:
        return lambda texts: [x.tobytes() for x in whole([t.decode() for t in texts])]

    suffix = model.get("end_of_word_suffix") or ""
    lowers = any(n.get("type") == "Lowercase" for n in (spec.get("normalizer") or {}).get("normalizers", []))
    vocabulary = tokenizer.get_vocab()
    last = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
    last[[i for t, i in vocabulary.items() if suffix and t.endswith(suffix)]] = True
    del spec, model, vocabulary
    known = Known()

    def learned(words: list[bytes], plain: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids of new words, where those of each begin, how many they are); many runs of letters at a time, cut apart where a token ends a word."""
        # a blank before a chunk keeps it one
        texts = [w.decode() if plain else " " + w.decode() for w in words]
        runs = [i for i, t in enumerate(texts) if plain and t[-1].isalpha()]
        rest = [i for i, t in enumerate(texts) if not (plain and t[-1].isalpha())]
        ids, sizes = [], []
        for s in range(0, len(runs), 256):
            some = [texts[i] for i in runs[s : s + 256]]
            found = whole([" ".join(some)])[0]
            ends = np.flatnonzero(last[found]) + 1
            if len(ends) == len(some):
                ids.append(found[: ends[-1]])
                sizes.append(np.diff(ends, prepend=0))
            else:
                each = whole(some)
                ids += each
                sizes.append([len(x) for x in each])
        each = whole([texts[i] for i in rest]) if rest else []
        order, size = np.array(runs + rest, np.int64), np.zeros(len(words), np.int64)
        size[order] = np.concatenate([*sizes, [len(x) for x in each]])
        begin = np.zeros(len(words), np.int64)
        begin[order] = np.cumsum(size[order]) - size[order]
        return np.concatenate([*ids, *each, np.zeros(0, np.uint32)]), begin, size

    def run(parts: list[bytes], plain: bool) -> list[bytes]:
        nonlocal known
        if known.full():
            known = Known()
        data = b" ".join(parts) + b" "
        joined = np.frombuffer(data, np.uint8)
        kind = (_PIECES if plain else _CHUNKS)[joined]
        edge = np.concatenate(([True], (kind[1:] != kind[:-1]) | (kind[1:] == 2), [True]))
        starts = np.flatnonzero(edge[:-1] & (kind != 0))
        ends = np.flatnonzero(edge[1:] & (kind != 0)) + 1
        key, check = _hashes(joined, starts, ends, plain)
        slot = known.find(key, check)
        begin, size = known.begin[slot], known.size[slot].astype(np.int64)
        new = np.flatnonzero(slot < 0)
        if len(new):
            number: dict[bytes, int] = {}
            which = np.array([number.setdefault(data[s:e], len(number)) for s, e in zip(starts[new].tolist(), ends[new].tolist())])
            ids, first, n = learned(list(number), plain)
            first += known.append(ids)
            begin[new], size[new] = first[which], n[which]
            _, once = np.unique(which, return_index=True)
            once = new[once]
            once = once[ends[once] - starts[once] <= LONGEST]
            known.put(key[once], check[once], begin[once], size[once])
        cuts = np.concatenate(([0], np.cumsum(size)))
        out = known.ids[np.repeat(begin - cuts[:-1], size) + np.arange(cuts[-1])].tobytes()
        stops = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1)
        at = (cuts[np.searchsorted(starts, stops)] * 4).tolist()
        return [out[i:j] for i, j in zip([0, *at], at)]

    def encode(texts: list[bytes]) -> list[bytes]:
        out: list[list[bytes]] = [[] for _ in texts]
        waiting: dict[bool, tuple[list[int], list[bytes]]] = {True: ([], []), False: ([], [])}
        held = {True: 0, False: 0}

        def flush(plain: bool) -> None:
            of, parts = waiting[plain]
            for i, ids in zip(of, run(parts, plain) if parts else ()):
                out[i].append(ids)
            waiting[plain], held[plain] = ([], []), 0

        for i, raw in enumerate(texts):
            low = raw.decode().lower()
            plain = lowers and PLAIN.fullmatch(low) is not None and "<|" not in low
            for part in _parts(low.encode() if plain else raw):
                if held[plain] + len(part) > RUN:
                    flush(plain)
                waiting[plain][0].append(i)
                waiting[plain][1].append(part)
                held[plain] += len(part) + 1
        flush(True)
        flush(False)
        return [b"".join(ids) for ids in out]

    return encode


def _documents(batch: pa.RecordBatch, encode, end_id: int) -> list[bytes]:
    end = np.array([end_id], np.uint32).tobytes()
    return [ids + end for ids in encode([t or b"" for t in batch.column(1).to_pylist()])]


def _narrow(ids: bytes, width: int) -> bytes:
    return np.frombuffer(ids, np.uint32).astype(f"<u{width}").tobytes()


def train_dictionary(docs: DataFrame, tokenizer_path: str, end_id: int, width: int) -> bytes:
    """A dictionary from the id arrays of at most SAMPLE_DOCUMENTS documents and SAMPLE_BYTES bytes.

    The documents are those with the smallest hashes, so reruns agree. Too few to train on: their
    ids themselves serve as the dictionary; none: it is empty.
    """
    import zstandard

    total = docs.count()
    chosen = docs.where(F.pmod(F.xxhash64("text", "doc_id"), F.lit(max(1, total // SAMPLE_DOCUMENTS))) == 0)
    chosen = chosen.orderBy(F.xxhash64("doc_id", "text")).limit(SAMPLE_DOCUMENTS)

    def ids(batches):
        encode = encoder(tokenizer_path)
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([_narrow(x, width) for x in _documents(batch, encode, end_id)], pa.binary())], ["place", "ids"]
            )

    chosen = chosen.select(F.xxhash64("doc_id", "text").alias("place"), F.col("text").cast("binary").alias("text"))
    found = chosen.mapInArrow(released(ids), "place long, ids binary").where(F.length("ids") <= SAMPLE_BYTES // 64)
    samples, size = [], 0
    for place, data in sorted((r.place, bytes(r.ids)) for r in found.toLocalIterator()):
        if size + len(data) <= SAMPLE_BYTES:
            samples.append(data)
            size += len(data)
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=256, d=8).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY_BYTES:]


def write_ids(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 1, id_column: str = "doc_id") -> None:
    """The ids of ``docs.text`` (null: empty), each followed by ``end_id``, in ascending order of their id.

    Null ids come first. Rows with equal ids are ordered by their text; rows alike in both are
    interchangeable. Other columns are ignored. An empty table gives a dictionary and no shards.
    """
    import zstandard
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    width = 2 if max(Tokenizer.from_file(tokenizer_path).get_vocab_size(), end_id + 1) <= 1 << 16 else 4
    slim = docs.select(F.col(id_column).cast("long").alias("doc_id"), "text")
    dictionary = train_dictionary(slim, tokenizer_path, end_id, width)
    digest = hashlib.sha256(dictionary).digest()
    spark.createDataFrame([(digest.hex(), bytearray(dictionary), width)], "hash string, data binary, width int").coalesce(1).write.parquet(f"{path}/dictionary")

    def shards(batches):
        encode = encoder(tokenizer_path)
        compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)
        part, number = TaskContext.get().partitionId(), 0
        doc_ids, has, sizes, frames, held = [], [], [], [], 0

        def shard():
            offsets = np.cumsum([0, *map(len, frames)]).astype("<u8")
            data = b"".join([
                struct.pack(HEAD, MAGIC, digest, width, len(frames)), np.array(has, np.uint8).tobytes(), np.array(doc_ids, "<i8").tobytes(),
                np.array(sizes, "<u8").tobytes(), offsets.tobytes(), *frames,
            ])
            real = [d for d, h in zip(doc_ids, has) if h]
            columns = [part, number, real[0] if real else None, real[-1] if real else None, len(frames), sum(sizes), data]
            return pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(columns, (
                pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()))],
                ["part", "number", "first_id", "last_id", "documents", "ids", "data"])

        for batch in batches:
            ids, encoded = batch.column(0).to_pylist(), None
            for s in range(0, batch.num_rows, 500):
                encoded = _documents(batch.slice(s, 500), encode, end_id)
                for doc_id, data in zip(ids[s : s + 500], encoded):
                    frames.append(compressor.compress(_narrow(data, width)))
                    doc_ids.append(doc_id or 0)
                    has.append(doc_id is not None)
                    sizes.append(len(data) // 4)
                    held += len(frames[-1])
                    if held >= SHARD_BYTES:
                        yield shard()
                        number += 1
                        doc_ids, has, sizes, frames, held = [], [], [], [], 0
        if frames:
            yield shard()

    chars = slim.agg(F.sum(F.length("text"))).first()[0] or 0
    ranges = max(partitions(spark), -(-chars // CHARS_A_RANGE))
    text = F.xxhash64("text")
    dealt = slim.repartitionByRange(ranges, "doc_id", text).sortWithinPartitions("doc_id", text)
    out = dealt.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(
        released(shards), "part int, number long, first_id long, last_id long, documents long, ids long, data binary"
    )
    out.write.parquet(f"{path}/shards")


def _parsed(data: bytes, digest: bytes):
    """(width, has id, document ids, numbers of ids, offsets, where frames begin) of a shard."""
    magic, own, width, n = struct.unpack_from(HEAD, data)
    if magic != MAGIC or own != digest:
        raise ValueError("not a shard of this dictionary")
    at = struct.calcsize(HEAD)
    has = np.frombuffer(data, np.uint8, n, at)
    ids = np.frombuffer(data, "<i8", n, at + n)
    sizes = np.frombuffer(data, "<u8", n, at + 9 * n)
    offsets = np.frombuffer(data, "<u8", n + 1, at + 17 * n)
    return width, has, ids, sizes, offsets, at + 25 * n + 8


def _dictionary(spark: SparkSession, path: str) -> tuple[bytes, bytes]:
    row = spark.read.parquet(f"{path}/dictionary").first()
    data = bytes(row.data)
    if hashlib.sha256(data).hexdigest() != row.hash:
        raise ValueError("the dictionary is damaged")
    return data, bytes.fromhex(row.hash)


def read_ids(spark: SparkSession, path: str, wanted: list[int] | None = None, checksum: bool = False) -> DataFrame:
    """``part, number, position, doc_id, n_tokens, ids`` (ids: little-endian unsigned 32-bit) of the files.

    With ``checksum`` there is the unsigned crc32 of the ids, ``ids_crc32``, in their place. With ``wanted`` only the shards whose range can hold one of these ids are read, and of those
    only the frames of these documents are decompressed.
    """
    import zstandard

    dictionary, digest = _dictionary(spark, path)
    rows = spark.read.parquet(f"{path}/shards")
    if wanted is not None:
        inside = F.lit(False)
        for doc_id in wanted:
            inside = inside | ((F.col("first_id") <= doc_id) & (F.col("last_id") >= doc_id))
        rows = rows.where(inside)
    only = None if wanted is None else set(wanted)

    def parse(batches):
        opener = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)
        for batch in batches:
            for part, number, data in zip(*(batch.column(i).to_pylist() for i in range(3))):
                width, has, ids, sizes, offsets, begin = _parsed(data, digest)
                at = [i for i in range(len(ids)) if only is None or (has[i] and int(ids[i]) in only)]
                for s in range(0, len(at), 500):
                    some = at[s : s + 500]
                    frames = [np.frombuffer(opener.decompress(data[begin + int(offsets[i]) : begin + int(offsets[i + 1])]), f"<u{width}") for i in some]
                    whole = [f.astype("<u4").tobytes() for f in frames]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([part] * len(some), pa.int32()), pa.array([number] * len(some), pa.int64()), pa.array(some, pa.int64()),
                         pa.array([int(ids[i]) if has[i] else None for i in some], pa.int64()), pa.array([len(f) for f in frames], pa.int64()),
                         pa.array(map(zlib.crc32, whole), pa.int64()) if checksum else pa.array(whole, pa.binary())],
                        ["part", "number", "position", "doc_id", "n_tokens", last],
                    )

    last = "ids_crc32" if checksum else "ids"
    return rows.select("part", "number", "data").mapInArrow(
        released(parse), f"part int, number long, position long, doc_id long, n_tokens long, {last} {'long' if checksum else 'binary'}"
    )


def index(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document in the files, from the files.

    ``start``: ids of all documents before it. It is summed inside a shard, over the shards of a
    range, and over ranges, so no window holds all documents.
    """

    found = read_ids(spark, path, checksum=True)
    shards = spark.read.parquet(f"{path}/shards").select("part", "number", "ids")
    earlier = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    parts = shards.groupBy("part").agg(F.sum("ids").alias("ids"))
    parts = parts.select("part", F.coalesce(F.sum("ids").over(earlier(Window.orderBy("part"))), F.lit(0)).alias("a"))
    starts = shards.select("part", "number", F.coalesce(F.sum("ids").over(earlier(Window.partitionBy("part").orderBy("number"))), F.lit(0)).alias("b"))
    starts = starts.join(parts, "part").select("part", "number", (F.col("a") + F.col("b")).alias("base"))
    within = earlier(Window.partitionBy("part", "number").orderBy("position"))
    return found.join(starts, ["part", "number"]).select(
        "doc_id", (F.col("base") + F.coalesce(F.sum("n_tokens").over(within), F.lit(0))).alias("start"), "n_tokens", "ids_crc32"
    )
