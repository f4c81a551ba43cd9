import zlib

import numpy as np
import public_tokenizers
import pytest
from fixtures import SF, documents, prose
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidegate.llm import token_files as tf
from tidegate.llm.common import table
from tidegate.llm.queries import QUERIES
from tidegate.runtime import scratch_path

PATH = public_tokenizers.path("word_bpe_49k.json")
TOKENIZER = Tokenizer.from_file(PATH)
ENCODE = tf.encoder(PATH)


def ids(text) -> list:
    return [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 1]


def crc(tokens) -> int:
    return zlib.crc32(np.array(tokens, "<u4").tobytes())


def plain(rows):
    out, start = [], 0
    for doc_id, text in rows:
        tokens = ids(text)
        out.append((doc_id, start, len(tokens), crc(tokens)))
        start += len(tokens)
    return out


PIECES = st.sampled_from(["it's", "don't", "  ", "\n", "<|endoftext|>", "x<|startoftext|>y", "é", "é", "́", "É", "ß", "ẞ", "İ", "K", "Å", "ﬁ",
                          "\x1c", "\x85", " ", " ", "3.14", "a.b", "word...", "Word,", "wörd;", "!?", "日本", "😀", "'S", "\x0b", "Σ", "ΣΑΣ", "x'"])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(PIECES, st.text(max_size=6)), max_size=8))
def test_encoder_gives_the_ids_of_the_library(parts):
    text = "".join(parts)
    got = np.frombuffer(ENCODE([text.encode()])[0], np.uint32).tolist()
    assert got == TOKENIZER.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("name", ["byte_bpe_50k.json"])
def test_other_tokenizers_encode_whole_texts(name):
    path = public_tokenizers.path(name)
    other = Tokenizer.from_file(path)
    texts = ["Some words,  two blanks\n\nand lines", "", "x" * 1000]
    got = tf.encoder(path)([t.encode() for t in texts])
    assert [np.frombuffer(g, np.uint32).tolist() for g in got] == [other.encode(t, add_special_tokens=False).ids for t in texts]


def test_round_trip_of_the_smallest_table(spark):
    docs = table(spark, SF, "documents").select("doc_id", "text").orderBy("doc_id").collect()
    got = sorted(tuple(r) for r in QUERIES["op8_token_files"](spark, SF).collect())
    assert got == plain(docs)


def test_odd_rows_and_lookup(spark, monkeypatch):
    monkeypatch.setattr(tf, "SHARD_BYTES", 300)
    rows = [(5, "five words"), (1, None), (3, ""), (None, "no id"), (3, "three again"), (9, prose(1, 30_000)), (7, prose(2, 40))]
    docs = documents(spark, rows).selectExpr("*", "1 as part", "'n' as number", "0 as ids")
    path = scratch_path(spark, "test-ids")
    tf.write_ids(docs, path, PATH)
    got = tf.index(spark, path).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None, 1, 3, 3, 5, 7, 9]
    assert {(r.doc_id, r.n_tokens, r.ids_crc32) for r in got} == {(d, len(ids(t)), crc(ids(t))) for d, t in rows}
    starts = np.cumsum([0, *[r.n_tokens for r in got]])
    assert [r.start for r in got] == starts[:-1].tolist()
    assert spark.read.parquet(f"{path}/shards").count() > 1
    few = tf.read_ids(spark, path, wanted=[5, 9, 1234]).collect()
    assert {r.doc_id: np.frombuffer(bytes(r.ids), "<u4").tolist() for r in few} == {5: ids("five words"), 9: ids(prose(1, 30_000))}


def test_the_dictionary_is_checked_and_helps(spark):
    rows = [(i, prose(i, 60)) for i in range(400)]
    path = scratch_path(spark, "test-dictionary")
    tf.write_ids(documents(spark, rows), path, PATH)
    stored = spark.read.parquet(f"{path}/shards").selectExpr("sum(length(data)) as n").first().n
    import zstandard

    alone = sum(len(zstandard.compress(np.array(ids(t), "<u2").tobytes())) for _, t in rows)
    assert stored < alone + 33 * len(rows)
    data, digest = tf._dictionary(spark, path)
    assert data
    shard = bytes(spark.read.parquet(f"{path}/shards").first().data)
    with pytest.raises(ValueError):
        tf._parsed(shard, bytes(32))


def test_empty_table(spark):
    path = scratch_path(spark, "test-none")
    tf.write_ids(documents(spark, [(1, "x")]).where("doc_id < 0"), path, PATH)
    assert tf.index(spark, path).count() == 0


def test_the_table_of_known_words_is_compact(monkeypatch):
    """A worker that has met 250,000 words holds some MB for them, and what it gave for them stays right when the table starts anew."""
    import tracemalloc

    letters = "abcdefghijklmnopqrstuvwxyz"
    words = [f"{letters[i % 26]}{letters[i // 26 % 26]}é{letters[i // 676 % 26]}{letters[i // 17576]}" for i in range(250_000)]
    encode = tf.encoder.__wrapped__(PATH)
    tracemalloc.start()
    try:
        for s in range(0, len(words), 10_000):
            encode([" ".join(words[s : s + 10_000]).encode()])
        assert tracemalloc.get_traced_memory()[0] < 40 << 20
    finally:
        tracemalloc.stop()
    monkeypatch.setattr(tf, "KNOWN", 5)
    monkeypatch.setattr(tf, "RUN", 50)
    encode = tf.encoder.__wrapped__(PATH)
    texts = [prose(i, 40 + i) + " it's " + "x" * 300 + " Straße 3.14 日本, z" * (i % 2) for i in range(20)] * 2
    got = [np.frombuffer(x, np.uint32).tolist() for x in encode([t.encode() for t in texts])]
    assert got == [TOKENIZER.encode(t, add_special_tokens=False).ids for t in texts]


def test_words_that_meet_in_the_table_stay_apart():
    known, rng = tf.Known(), np.random.default_rng(3)
    key = (rng.integers(0, 5, 4000).astype(np.uint64) << np.uint64(60)) + np.arange(1, 4001, dtype=np.uint64)
    check = rng.integers(0, 1 << 32, 4000).astype(np.uint32)
    assert (known.find(key, check) < 0).all()
    known.put(key, check, np.arange(4000), np.arange(4000) % 7)
    slot = known.find(key, check)
    assert known.begin[slot].tolist() == list(range(4000)) and known.size[slot].tolist() == [i % 7 for i in range(4000)]
    assert (known.find(key, check + np.uint32(1)) < 0).all() and len(set(slot.tolist())) == 4000
