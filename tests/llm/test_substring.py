"""Near copies of passages near the stated bounds, and behind a phrase that many documents share."""

import random

import numpy as np

from courtlake.llm import substring
from courtlake.llm import words as w


def near_copies(rng, first_id, pairs, make):
    """Documents in pairs: the second holds the passage of the first with one word edited."""
    rows = []
    for k in range(pairs):
        passage, at = make()
        edited = [*passage[:at], f"edited{k}", *passage[at + 1:]]
        for i, own in enumerate((passage, edited)):
            say = [f"z{rng.randrange(10**9)}" for _ in range(60)]
            rows.append((first_id + 2 * k + i, " ".join(say[:30] + own + say[30:])))
    return rows


def held(spark, rows):
    found = substring.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    return {(r.doc_id, r.source_doc_id) for r in found}


def test_one_edited_word_in_fifty(spark):
    rng = random.Random(5)
    rows = near_copies(rng, 1, 150, lambda: ([f"y{rng.randrange(10**9)}" for _ in range(50)], rng.randrange(10, 40)))
    assert held(spark, rows) == {(i + 1, i) for i in range(1, 301, 2)}


def test_common_line_hides_no_near_copy(spark):
    """A 40-word line that 300 unrelated earlier documents hold, inside 56-word passages of pairs of later ones."""
    rng = random.Random(6)
    say = lambda n: [f"y{rng.randrange(10**9)}" for _ in range(n)]
    line = say(40)
    rows = [(k, " ".join(say(40) + line + say(40))) for k in range(1, 301)]
    rows += near_copies(rng, 1001, 60, lambda: (say(8) + line + say(8), rng.choice([6, 7, 48, 49])))
    assert held(spark, rows) == {(i + 1, i) for i in range(1001, 1121, 2)}


def test_common_openings_recall(spark):
    """Triples: the first document has only the opening of a 50-word passage that the other two share, with one word edited."""
    rng = random.Random(8)
    say = lambda n: [f"y{rng.randrange(10**9)}" for _ in range(n)]
    rows, want = [], set()
    for k, opening in enumerate([30] * 80 + [40] * 80):
        passage, at = say(50), rng.randrange(opening, 50)
        rows.append((3 * k + 1, " ".join(say(20) + passage[:opening] + say(40))))
        rows.append((3 * k + 2, " ".join(say(30) + passage + say(30))))
        rows.append((3 * k + 3, " ".join(say(30) + [*passage[:at], "edited", *passage[at + 1:]] + say(30))))
        want.add((3 * k + 3, 3 * k + 2))
    found = held(spark, rows)
    assert len(found & want) >= 0.95 * len(want) and found <= want


def test_compact_windows_against_brute_force():
    """Every subsequence of at least 46 tokens of one document is in exactly one window, that of its least hash."""
    rng = np.random.default_rng(3)
    for top in (12, 60, 2**63):
        docs, values = np.repeat([0, 1, 2], [120, 30, 100]), w.mix(rng.integers(1, top, 250).astype(np.uint64))
        of = {}
        for c, left, right in zip(*substring.compact_windows(substring.Slots(docs), values, 46), strict=True):
            for i in range(c - left, c + 1):
                for j in range(max(c, i + 45), c + right + 1):
                    assert (i, j) not in of
                    of[i, j] = c
        spans = [(i, j) for i in range(250) for j in range(i + 45, 250) if docs[i] == docs[j]]
        assert set(of) == set(spans) and all(values[of[i, j]] == values[i:j + 1].min() for i, j in spans)


def test_joined_windows_against_brute_force():
    """The ranges of a signature are those in which two functions have these two least hashes."""
    rng = np.random.default_rng(4)
    docs, tokens = np.repeat([0, 1], [150, 90]), rng.integers(1, 80, 240).astype(np.uint64)
    hashes = [w.mix(tokens ^ substring._seed(k)) for k in range(substring.HASHES)]
    slots = substring.Slots(docs)
    parts = [substring.compact_windows(slots, h, 46) for h in hashes]
    keys = np.concatenate([substring._keys(h[c], k) for k, (h, (c, _, _)) in enumerate(zip(hashes, parts, strict=True))])
    c, left, right = (np.concatenate(x) for x in zip(*parts, strict=True))
    got = {}
    for doc, sig, first, last in zip(*substring.joined_windows(docs[c], keys, c - left, c, c + right, 46), strict=True):
        got.setdefault(sig, set()).update((doc, s) for s in range(first, last + 1))
    want = {}
    for s in range(240 - 45):
        if docs[s] == docs[s + 45]:
            low = [h[s:s + 46].min() for h in hashes]
            for i in range(substring.HASHES):
                for j in range(i + 1, substring.HASHES):
                    want.setdefault((i, j, low[i], low[j]), set()).add((docs[s], s))
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_long_texts_in_blocks(spark):
    """A passage across the block boundary of two long texts, and copies of a text."""
    rng = random.Random(9)
    say = lambda n: [f"y{rng.randrange(10**9)}" for _ in range(n)]
    passage = say(3000)
    rows = [(1, " ".join(say(1900) + passage + say(900))), (2, " ".join(say(4050) + passage + say(10))), (3, None), (4, "short text")]
    rows += [(5, rows[0][1]), (6, rows[1][1]), (7, "short text"), (None, rows[0][1])]
    found = substring.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(tuple(r)[:3] + (r.source_doc_id,) for r in found) == [(2, 4050, 7050, 1), (5, 0, 5800, 1), (6, 0, 7060, 2)]


def test_halves_from_far_apart_are_no_passage(spark):
    rng = random.Random(17)
    say = lambda n: [rng.choice("abcdefgh") + str(rng.randrange(10**6)) for _ in range(n)]
    rows = []
    for k in range(60):
        first, second = say(25), say(25)
        rows += [(2 * k, " ".join(say(20) + first + say(1000) + second + say(20))), (2 * k + 1, " ".join(say(20) + first + second + say(20)))]
    assert substring.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).count() == 0


def test_aligned_hits_against_brute_force():
    rng = np.random.default_rng(3)
    width, need = 16, 13
    for _ in range(200):
        base = rng.integers(0, 40, 60).astype(np.uint64)
        x = np.concatenate([rng.integers(0, 40, 20), base[:40], rng.integers(0, 40, 10)]).astype(np.uint64)
        y = np.concatenate([base[rng.integers(0, 10):], rng.integers(0, 40, 30)]).astype(np.uint64)
        y = np.delete(y, rng.integers(0, len(y), 2))
        got = set(substring.aligned_hits(x, y, width, need)[0].tolist())
        step = width // 8
        for p in range(len(x) - width + 1):
            # at one distance, or two neighbouring bands of distances
            fits = lambda low, high: sum(any(x[i] == y[j] for j in range(max(0, i + low), min(len(y), i + high + 1))) for i in range(p, p + width)) >= need  # noqa: E731, B023
            bands = range(-len(x) // step - 1, len(y) // step + 1)
            assert (p in got) == any(fits(b * step, b * step + 2 * step - 1) for b in bands)


def test_keys_of_two_documents_are_kept_across_batches():
    import random

    import pyarrow as pa

    rng = random.Random(4)
    for _ in range(200):
        rows = sorted((rng.randint(0, 6), rng.randint(1, rng.choice((1, 2, 9)))) for _ in range(rng.randint(0, 40)))
        batches, at = [], 0
        while at < len(rows):
            part = rows[at:at + rng.randint(0, 7)]
            at += len(part)
            batches.append(pa.RecordBatch.from_arrays([pa.array([r[k] for r in part], pa.int64()) for k in (0, 1)], ["key", "doc_id"]))
        got = [(r["key"], r["doc_id"]) for out in substring._held(iter(batches)) for r in out.to_pylist()]
        assert got == [r for r in rows if len({d for k, d in rows if k == r[0]}) > 1]


def test_words_are_counted_in_copies_only_and_equal_the_pattern(texts):
    import re

    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array([i for i, _ in texts]), pa.array([0] * len(texts)), pa.array([t for _, t in texts], pa.string())], ["doc_id", "source", "text"])
    got = [r["n"] for out in substring._word_counts(iter([batch])) for r in out.to_pylist()]
    assert got == [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t in texts]


def test_a_source_is_hashed_once_for_all_that_meet_it(monkeypatch):
    import pyarrow as pa

    words = [f"w{i}" for i in range(200)]
    own, source = [" ".join([*words[k:k + 60], f"x{k}"]) for k in range(9)], " ".join(words)
    columns = {"doc_id": list(range(9)), "at": [0] * 9, "source": [99] * 9, "text": own, "source_text": [source] * 9}
    hashed, tokens = [], substring._texts_tokens
    monkeypatch.setattr(substring, "_texts_tokens", lambda column, size: hashed.extend(column.to_pylist()) or tokens(column, size))
    found = [r for out in substring._verify(iter([pa.RecordBatch.from_pydict(columns)]), 5, 46, 41) for r in out.to_pylist()]
    assert [(r["doc_id"], r["start_word"], r["end_word"]) for r in found] == [(k, 0, 60) for k in range(9)]
    assert sorted(hashed) == sorted([*own, source])


def test_others_meet_the_first_document_of_their_group_across_batches():
    import random

    import pyarrow as pa

    rng = random.Random(5)
    for _ in range(200):
        rows = sorted((rng.randint(0, 4), rng.randint(1, rng.choice((1, 2, 9))), rng.randint(0, 9000), 0) for _ in range(rng.randint(0, 40)))
        batches, at = [], 0
        while at < len(rows):
            part = rows[at:at + rng.randint(0, 7)]
            at += len(part)
            columns = [pa.array([r[k] for r in part], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.int32(), pa.int32()))]
            batches.append(pa.RecordBatch.from_arrays(columns, ["sig", "doc_id", "first", "last"]))
        got = [tuple(r.values()) for out in substring._met(iter(batches)) for r in out.to_pylist()]
        heads = {s: min((d, f) for own, d, f, _ in rows if own == s) for s, *_ in rows}
        assert got == [(s, d, f, z, heads[s][0], heads[s][1] // substring.BLOCK) for s, d, f, z in rows if d != heads[s][0]]


def test_packed_windows_join_as_the_whole_ones():
    rng = np.random.default_rng(11)
    docs, tokens = np.repeat([0, 1], [400, 300]), rng.integers(1, 200, 700).astype(np.uint64)
    hashes = [w.mix(tokens ^ substring._seed(k)) for k in range(substring.HASHES)]
    parts = [substring.compact_windows(substring.Slots(docs), h, 46) for h in hashes]
    keys = np.concatenate([substring._keys(h[c], k) for k, (h, (c, _, _)) in enumerate(zip(hashes, parts, strict=True))])
    c, left, right = (np.concatenate(x) for x in zip(*parts, strict=True))
    packed = substring.unpack_windows(substring.pack_windows(c, left, right, 46), 46)
    assert (packed[1] == c).all() and (packed[0] >= c - 45).all() and left.max() > 45
    for a, b in zip(substring.joined_windows(docs[c], keys, c - left, c, c + right, 46), substring.joined_windows(docs[c], keys, *packed, 46), strict=True):
        assert (a == b).all()


def test_documents_are_joined_in_small_runs():
    """A pass over the windows of many documents passes its rows on in parts, so that a worker's memory stays small."""
    runs = list(substring._runs(np.full(1000, 100)))
    assert [a for a, _ in runs[1:]] == [z for _, z in runs[:-1]] and runs[-1][1] == 1000
    assert max(100 * (z - a) for a, z in runs) <= 1 << 15


def test_texts_that_are_compared_are_shuffled_once(spark, docs, monkeypatch):
    from courtlake.llm import ngram_join

    off = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in off}
    try:
        for k, v in off.items():
            spark.conf.set(k, v)
        for module, run in ((substring, substring.repeated_passages), (ngram_join, ngram_join.link_components)):
            plans, real = [], module.stored
            monkeypatch.setattr(module, "stored", lambda df, plans=plans, real=real: plans.append(df._jdf.queryExecution().executedPlan().toString()) or real(df))
            run(docs)
            compared = [p for p in plans if "source_text" in p or "text_v" in p]
            assert compared and all("ReusedExchange [doc_id" in p for p in compared)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
