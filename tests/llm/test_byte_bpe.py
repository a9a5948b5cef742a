"""Byte-level BPE against the tokenizer library, word by word and on whole texts."""

import hashlib

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from courtlake.llm import byte_bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
ODD = [
    "it's they'll I'M we've 'd x't", "a  b   c\n\n d \t\r\n", "  wide　spaces ", "1234 12a ½ Ⅷ ٣", "日本語のテキスト、と", "🙂🙂👩‍👩‍👧",
    "é İ ſ", "\x00\x01\x1e\x1f", "ࡰㄵ0 \U00031350x \U00010d40", "#$%^&*()__++", "�﻿", "don’t", " lead", "trail ", "\n", "x" * 300, "ab" * 2000, " " * 1000,
]


@pytest.fixture(scope="module")
def library():
    import tiktoken

    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(PATH), special_tokens={})


@pytest.mark.parametrize("head", [byte_bpe.HEAD, 100, 0])
def test_ids_and_bytes_equal_the_library(spark, docs, library, head):
    more = spark.createDataFrame([(1000 + i, t) for i, t in enumerate(ODD)], "doc_id long, text string")
    both = docs.select("doc_id", "text").unionByName(more)
    encoded = byte_bpe.encode(both, PATH, public_tokenizers.PATTERN, head=head)
    got = sorted((r.doc_id, list(r.ids), bytes(r.raw)) for r in encoded.withColumn("raw", byte_bpe.decode(F.col("ids"), byte_bpe.read_ranks(PATH))).collect())
    want = sorted((r.doc_id, library.encode_ordinary(r.text or ""), (r.text or "").encode()) for r in both.collect())
    assert got == want


def test_every_assigned_character_is_split_as_the_library_does(spark, library):
    """Between two letters, two digits and two signs, so that its class shows."""
    chars = [chr(c) for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF]
    texts = ["".join(f"a{c}a 1{c}1 .{c}. {c} {c}" for c in chars[i:i + 2000]) for i in range(0, len(chars), 2000)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(16)
    got = {r.doc_id: list(r.ids) for r in byte_bpe.encode(rows, PATH, public_tokenizers.PATTERN).collect()}
    wrong = [i for i, t in enumerate(texts) if got[i] != library.encode_ordinary(t)]
    assert not wrong


def test_long_runs_neither_crash_nor_take_quadratic_time(spark):
    texts = [" " * 2_000_000, "a" * 300_000, "$" * 300_000, "xyzzy" * 60_000]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    encoded = byte_bpe.encode(rows, PATH, public_tokenizers.PATTERN)
    got = {r.doc_id: bytes(r.raw) for r in encoded.select("doc_id", byte_bpe.decode(F.col("ids"), byte_bpe.read_ranks(PATH)).alias("raw")).collect()}
    assert got == {i: t.encode() for i, t in enumerate(texts)}


def test_heap_and_fold_agree(spark, library):
    ranks = byte_bpe.read_ranks(PATH)
    words = ["internationalisation", "aaaaaaaaaaaaaaaaaaaaaaaaa", "日本語日本語日本語", "zxcvbnmasdfghjklqwertyuiop" * 4]
    folded = byte_bpe.fold_words(F.array("word"), byte_bpe.rank_map(ranks))[0]
    rows = spark.createDataFrame([(x,) for x in words], "word string").select("word", folded.alias("ids")).collect()
    for r in rows:
        assert list(r.ids) == byte_bpe.merge_long(r.word.encode(), ranks) == library.encode_ordinary(r.word)


def test_digests_empty_table_and_bad_ranks(spark, docs, empty, library, tmp_path):
    ranks = byte_bpe.read_ranks(PATH)
    rows = byte_bpe.digests(byte_bpe.encode(docs, PATH, public_tokenizers.PATTERN), ranks).collect()
    want = {r.doc_id: r.text or "" for r in docs.select("doc_id", "text").collect()}
    assert len(rows) == docs.count()
    for r in rows:
        ids = library.encode_ordinary(want[r.doc_id])
        raw = b"".join(i.to_bytes(4, "little") for i in ids)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(want[r.doc_id].encode()).hexdigest())
    assert byte_bpe.digests(byte_bpe.encode(empty, PATH, public_tokenizers.PATTERN), ranks).collect() == []
    (tmp_path / "bad").write_text("YQ== 0\n")
    with pytest.raises(ValueError):
        byte_bpe.read_ranks(str(tmp_path / "bad"))


def test_unknown_ids_end_the_job_and_null_stays_null(spark):
    ranks = byte_bpe.read_ranks(PATH)
    rows = spark.createDataFrame([(1, None), (2, []), (3, [0, 1])], "i int, ids array<int>")
    got = {r.i: r.raw for r in rows.select("i", byte_bpe.decode(F.col("ids"), ranks).alias("raw")).collect()}
    assert got == {1: None, 2: b"", 3: b'!"'}
    for bad in (len(ranks), -1, None):
        with pytest.raises(Exception, match="no token"):
            spark.createDataFrame([([0, bad],)], "ids array<int>").select(byte_bpe.decode(F.col("ids"), ranks)).collect()


def test_pairs_have_two_places_and_odd_tokens_are_kept_apart(spark):
    import random

    rng = random.Random(2)
    pairs = {rng.randrange(1 << 40): k for k in range(5000)}
    slots, p, q = byte_bpe.pair_slots(pairs)
    for pair, k in pairs.items():
        assert (pair << byte_bpe.ID_BITS | k) in (slots[pair % p], slots[p + pair % q])
    assert len(slots) == p + q and sum(x >= 0 for x in slots) == len(pairs)
    # no pair of tokens makes "abc": only the whole word is that token
    ranks = {bytes([i]): i for i in range(256)} | {b"abc": 256, b"xy": 257}
    table = byte_bpe.rank_map(ranks)
    assert table.apart == {"616263": 256}
    row = spark.createDataFrame([(["abc", "abcd", "xyxy"],)], "words array<string>").select(byte_bpe.fold_words(F.col("words"), table).alias("ids")).first()
    assert [list(x) for x in row.ids] == [[256], [97, 98, 99, 100], [257, 257]]


def test_a_fold_from_first_states_gives_the_ids_of_the_heap(spark):
    import pyarrow as pa

    ranks = byte_bpe.read_ranks(PATH)
    words = ["unused", "a", " é", "日本語", "zxcvbnm" * 5, "x" * (byte_bpe.LONG + 1), " internationalisation", "y" * byte_bpe.LONG]
    states = byte_bpe.first_states(pa.array(words)[1:], *byte_bpe.byte_pairs(ranks)).to_pylist()
    for word, own in zip(words[1:], states, strict=True):
        raw = word.encode() if len(word.encode()) <= byte_bpe.LONG else b""
        pairs = [ranks.get(raw[i:i + 2], byte_bpe.NO_RANK) if i + 1 < len(raw) else byte_bpe.NO_RANK for i in range(len(raw))]
        assert own == [(pairs[i] << byte_bpe.PLACE_BITS | i) << byte_bpe.ID_BITS | ranks[raw[i:i + 1]] for i in range(len(raw))]
    assert byte_bpe.first_states(pa.array([], pa.string()), *byte_bpe.byte_pairs(ranks)).to_pylist() == []
    folded = byte_bpe.fold_words(F.col("words"), byte_bpe.rank_map(ranks), F.col("states"))
    row = spark.createDataFrame([(words[1:], states)], "words array<string>, states array<array<bigint>>").select(folded.alias("ids")).first()
    assert row.ids == [byte_bpe.merge_long(x.encode(), ranks) if len(x.encode()) <= byte_bpe.LONG else None for x in words[1:]]
