"""Bin completion against exact search."""

import random
from collections import Counter
from functools import lru_cache

import pytest

from courtlake.llm import packing


def bins_of(patterns, counts, capacity):
    """Number of bins, after a check that the patterns use exactly these pieces."""
    used = Counter()
    for bins, filling in patterns:
        assert sum(x * n for x, n in filling) <= capacity
        for x, n in filling:
            used[x] += bins * n
    assert used == Counter(counts)
    return sum(bins for bins, _ in patterns)


def exact(pieces, capacity):
    """Least number of bins by dynamic programming over subsets: bins and the fill of the last, at best."""
    n = len(pieces)
    best = [(n + 1, 0)] * (1 << n)
    best[0] = (0, capacity)
    for done in range(1 << n):
        bins, fill = best[done]
        for i in range(n):
            if not done >> i & 1:
                now = (bins, fill + pieces[i]) if fill + pieces[i] <= capacity else (bins + 1, pieces[i])
                best[done | 1 << i] = min(best[done | 1 << i], now)
    return best[-1][0]


def test_small_instances_are_optimal():
    rng = random.Random(1)
    for k in range(400):
        capacity = rng.choice([20, 50, 100, 2048])
        low, high = rng.choice([(1, capacity), (capacity // 6, capacity // 2), (capacity // 4, 3 * capacity // 4)])
        pieces = [rng.randint(max(low, 1), high) for _ in range(11)]
        counts = Counter(pieces)
        want = exact(pieces, capacity)
        assert bins_of(packing.plan_patterns(dict(counts), capacity), counts, capacity) == want, (k, pieces, capacity)
        assert packing.lower_bound(dict(counts), capacity) <= want


def test_best_filling_against_brute_force():
    rng = random.Random(2)
    for _ in range(300):
        counts = {rng.randint(1, 40): rng.randint(1, 4) for _ in range(5)}
        room = rng.randint(1, 100)

        @lru_cache(None)
        def top(i, left, lengths=tuple(counts)):
            if i == len(lengths):
                return 0
            x = lengths[i]
            return max(n * x + top(i + 1, left - n * x) for n in range(min(counts[x], left // x) + 1))

        found = packing.best_filling(room, counts)
        assert all(n <= counts[x] for x, n in found) and sum(x * n for x, n in found) == top(0, room)


def test_fillings_are_all():
    counts = {7: 1, 5: 2, 3: 2, 2: 1}
    got = [tuple(f) for f in packing.fillings(12, counts, 0)]
    want = {
        tuple((x, n) for x, n in zip((7, 5, 3, 2), own, strict=True) if n)
        for own in ((a, b, c, d) for a in range(2) for b in range(3) for c in range(3) for d in range(2))
        if sum(x * n for x, n in zip((7, 5, 3, 2), own, strict=True)) <= 12
    }
    assert len(got) == len(set(got)) and set(got) == want
    assert got[0] == ((7, 1), (5, 1)) and packing.best_filling(12, counts) == [(7, 1), (5, 1)]


@pytest.mark.parametrize(("one", "other", "holds"), [
    ([(6, 1)], [(4, 1), (2, 1)], True), ([(6, 1)], [(4, 1), (3, 1)], False), ([(5, 1), (3, 1)], [(3, 2), (2, 1)], True), ([(5, 1), (3, 1)], [(4, 2)], False), ([(2, 1)], [], True), ([], [(1, 1)], False),
])
def test_dominance(one, other, holds):
    assert packing.dominates(one, other) is holds


def test_large_histogram_meets_the_bound():
    rng = random.Random(3)
    for lengths in (range(1, 2049), range(300, 1300), range(900, 1030)):
        counts = {x: rng.randint(0, 3000) for x in lengths}
        counts = {x: n for x, n in counts.items() if n}
        bins = bins_of(packing.plan_patterns(counts, 2048), counts, 2048)
        assert bins <= 1.01 * packing.lower_bound(counts, 2048) + 1
    assert packing.plan_patterns({}, 2048) == [] and packing.lower_bound({}, 2048) == 0


def test_tasks_of_a_worker_share_the_encoder_and_plain_words_take_merges_alone(monkeypatch):
    import public_tokenizers
    import pyarrow as pa
    import tokenizers

    path, loads, load = public_tokenizers.path("word_bpe_49k.json"), [], tokenizers.Tokenizer.from_file
    rng = random.Random(11)
    plain = [chr(c) for c in (9, 10, 13, *range(32, 127), *range(0xC0, 0x100)) if c not in (0xD7, 0xF7)] + ["'", " "] * 30 + ["'ll", "'s", "'re"] * 9
    texts = [None, "", "it's 'tis O'Neill ''s ,'s ÀÉ's don'tx", *("".join(rng.choices(plain, k=rng.randint(1, 60))) for _ in range(3000))]
    library = load(path)
    want = [[*library.encode(t or "", add_special_tokens=False).ids, 0] for t in texts]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.string())], ["doc_id", "text"])
    monkeypatch.setattr(tokenizers.Tokenizer, "from_file", staticmethod(lambda p: loads.append(p) or load(p)))
    monkeypatch.setattr(packing.Encoder, "whole", None)
    for _task in range(3):
        rows = [r for out in packing._pieces(iter([batch]), path, 2048, 0, True) for r in out.to_pylist()]
        assert [memoryview(r["ids"]).cast("I").tolist() for r in rows] == want
    assert len(loads) <= 1
