"""Token counts by line, the quality ratio, movement between shards, and bounded broadcasts, against brute force."""

import math
import os
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

from courtlake.llm import quality, sharding, substring, token_counts
from courtlake.llm import words as w
from courtlake.llm.common import broadcast_if_small, shared_folder


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_tokens_of_every_line(spark, rule):
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    encode, lengths, _ = token_counts.encoder(path, pattern)
    texts = ["a\n\n  b c\n", "\n\n\n", "one line", "é\n\n\nü x\n \n y", "  \n\n\n  deep\n\n", "z" * 3000 + "\n" + "q" * 2000, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {(r.doc_id, r.section): (r.start_char, r.n_chars, r.n_tokens, r.n_crossing) for r in token_counts.section_tokens(df, path, pattern, rule).collect()}
    want = {}
    for i, text in enumerate(texts):
        raw = text.encode()
        owner, lines, line = [], [], 0
        for k, byte in enumerate(raw):
            owner.append(line)
            line += byte == 10 and k + 1 < len(raw)
        lines = re.findall(r"[^\n]*\n|[^\n]+$", text) or [""]
        tokens, crossing, at = Counter(), Counter(), 0
        for token in encode.encode_ordinary(text):
            held = owner[at:at + int(lengths[token])]
            at += int(lengths[token])
            most = max(sorted(set(held)), key=lambda x: held.count(x))
            own = {"start": held[0], "end": held[-1], "most": most}[rule]
            tokens[own] += 1
            crossing[own] += held[0] != held[-1]
        start = 0
        for k, own in enumerate(lines):
            want[i, k] = (start, len(own), tokens[k], crossing[k])
            start += len(own)
    assert got == want


def test_quality_ratio(spark):
    good = [f"plain words number {k} follow, and more plain words follow here." * 8 for k in range(20)]
    bad = [f"buy $$$ cheap {k} ### offer click now !!! " * 12 for k in range(20)]
    rows = list(enumerate([*good, *bad, *(" ".join(x) for x in zip(good, bad, strict=True))]))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in quality.judge(df, quality.fit_ratio(df, df.filter("doc_id < 15").select("doc_id"))).collect()}

    def features(text):
        tokens = re.findall(rb"[0-9A-Za-z_\x80-\xff]+|[^0-9A-Za-z_\x80-\xff\x20\x09-\x0d]+", text.encode())
        hashes = [int(w.span_hashes(np.frombuffer(t, np.uint8), np.array([0]), np.array([len(t)]), True)[0]) for t in tokens]
        pairs = [int(w.shingles(np.zeros(2, np.int64), np.array(p, np.uint64), 2)[1][0]) for p in zip(hashes, hashes[1:], strict=False)]
        return [h >> (64 - quality.BUCKET_BITS) for h in hashes + pairs]

    own = {i: features(t) for i, t in rows}
    trusted, raw = Counter(), Counter()
    for i, found in own.items():
        raw.update(found)
        if i < 15:
            trusted.update(found)
    size = 1 << quality.BUCKET_BITS
    p = lambda c, b: (c[b] + quality.SMOOTHING) / (sum(c.values()) + size * quality.SMOOTHING)
    for i, found in own.items():
        score = sum(math.log(p(trusted, b) / p(raw, b)) for b in found) / len(found)
        assert got[i].score == pytest.approx(score, abs=2e-6)
        assert got[i].kept == (not got[i].base_failed and got[i].score >= quality.THRESHOLD)
    assert all(got[i].score > got[20 + i].score for i in range(20))


def test_bounded_ring_moves_little(spark):
    """One more shard: the rows that move into it are its share, few move between old shards."""
    df = spark.range(20_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"))
    a, b = ({r.doc_id: r.shard for r in sharding.shard_rows(df, shards=n).select("doc_id", "shard").collect()} for n in (40, 41))
    moved = [i for i in a if a[i] != b[i]]
    assert Counter(b.values())[40] == 20_000 // 41 and len(moved) < 0.06 * len(a)
    assert sum(b[i] != 40 for i in moved) < 0.035 * len(a)


@pytest.mark.parametrize(("shards", "virtual_nodes"), [(7, 8), (3, 1), (40, 64)])
def test_sharding_against_a_walk_of_the_ring(docs, texts, shards, virtual_nodes):
    """Row by row: own shard while it has room, then clockwise to the next with room; how many of each arc end where."""
    nodes = sharding.ring(shards, virtual_nodes)
    got = sharding.shard_rows(docs, shards=shards, virtual_nodes=virtual_nodes).collect()
    t = dict(texts)
    assert all(r.text_crc32 == zlib.crc32((t[r.doc_id] or "").encode()) for r in got)

    def arc(doc_id):
        cell = xxhash.xxh64((t[doc_id] or "").encode(), seed=42).intdigest() >> (64 - sharding.CELL_BITS)
        return next((i for i, (c, _) in enumerate(nodes) if c >= cell), 0)

    room = [len(got) // shards + (s < len(got) % shards) for s in range(shards)]
    rows, want, left = sorted(arc(r.doc_id) for r in got), Counter(), []
    for a in rows:
        own = nodes[a][1]
        if room[own]:
            room[own] -= 1
            want[a, own] += 1
        else:
            left.append(a)
    for a in left:
        at = a
        while not room[nodes[at][1]]:
            at = (at + 1) % len(nodes)
        room[nodes[at][1]] -= 1
        want[a, nodes[at][1]] += 1
    assert Counter((arc(r.doc_id), r.shard) for r in got) == want
    for s in range(shards):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))


def test_broadcast_is_bounded_by_bytes(spark):
    hint = lambda df: "broadcast" in df._jdf.queryExecution().logical().toString().lower()
    small = spark.range(100).select("id", F.array(F.lit("x")).alias("a"))
    wide = spark.range(100).select("id", F.array_repeat(F.lit("x" * 1000), 1000).alias("a"))
    nested = spark.range(100).select("id", F.array_repeat(F.struct(F.lit("x" * 1000).alias("s"), F.col("id")), 1000).alias("a"))
    assert hint(broadcast_if_small(small)) and not hint(broadcast_if_small(small, rows=99))
    assert not hint(broadcast_if_small(wide)) and not hint(broadcast_if_small(nested)) and hint(broadcast_if_small(small.limit(0)))


def test_passages_leave_only_their_result_behind(spark, docs):
    folder = shared_folder(spark).removeprefix("file:")
    before = {x for x in os.listdir(folder) if x.startswith("llm-")}
    substring.repeated_passages(docs).count()
    assert len({x for x in os.listdir(folder) if x.startswith("llm-")} - before) <= 4


def test_long_runs_are_cut_where_the_pattern_breaks(spark):
    """Cut at runs of 2 and 3 characters, texts have the library's ids; 2 million characters in a row don't crash."""
    import random

    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    encode, _, ranks = token_counts.encoder(path, pattern)
    rng = random.Random(5)
    for _ in range(500):
        text = "".join(rng.choice([" ", "  ", "\n", "\t ", "\u3000", "\x1c", "a", "Bc", "1", "!", "'s", "\u00e9"]) for _ in range(rng.randrange(30)))
        for longest in (1, 2, 3):
            assert token_counts.encode_whole(encode, ranks, text, longest).tolist() == encode.encode_ordinary(text)
    n = 2_000_000
    texts = [" " * n, "a" + " " * n + "b", "\n" * n, "ab" * (n // 2), "$" * n, " " * (n // 2) + "x" + "\u3000" * (n // 2)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(6)
    rows = token_counts.document_tokens(token_counts.section_tokens(df, path, pattern)).collect()
    assert len(rows) == len(texts) and all(0 < r.n_tokens <= 3 * n for r in rows)
    assert {r.n_sections for r in rows} == {1, n}
