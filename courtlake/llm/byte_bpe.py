"""Byte-level BPE: encoding of whole documents by a file of ranks, and decoding.

A text is split into words by a pattern; each word is encoded by itself.  Encoding folds ranked merges over the word's bytes
with Spark's higher-order functions: the state is the array of pieces, each one number of its id, its place and the rank of the
pair it begins; a step merges the leftmost pair of lowest rank.  Ranks of pairs of ids come from a literal array, a hash table with
two places for each pair, because Spark reads a map from front to back.

Each distinct word is folded once if it is frequent: distinct words are counted over all documents, the frequent ones (at most
HEAD, whatever the corpus) are encoded and broadcast, and their occurrences are replaced by a lookup.  The other words of a
document are folded in its row.  So no text is shuffled, only distinct words.  Words are looked up by their 64-bit hashes.

Decoding looks up the bytes of each id and joins them.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtlake.llm import words as w
from courtlake.llm.common import numbered

#: Most words that are broadcast with their ids.
HEAD = 1 << 20
#: Words of more bytes are merged with a heap, since a fold takes time as the square of a word's length.
LONG = 256
#: Distinct words that a task counts before it passes them on.
HELD_WORDS = 1 << 18
#: Bits of an id or a rank, and of a place in a word, in the state of a fold.
ID_BITS, PLACE_BITS = 20, 9
#: Rank of a pair that makes no token.
NO_RANK = (1 << ID_BITS) - 1

# Letters and numbers of Unicode 14 to 16, which the tokenizer knows and a Java of Unicode 13 doesn't.
NEW_LETTERS = (
    "870-887 889-88e 8b5 8c8-8c9 c5d cdd 170d 171f 1b4c 1c89-1c8a 2c2f 2c5f 9ffd-9fff a7c0-a7c1 a7cb-a7cd a7d0-a7d1 a7d3 a7d5-a7dc"
    " a7f2-a7f4 10570-1057a 1057c-1058a 1058c-10592 10594-10595 10597-105a1 105a3-105b1 105b3-105b9 105bb-105bc 105c0-105f3"
    " 10780-10785 10787-107b0 107b2-107ba 10d4a-10d65 10d6f-10d85 10ec2-10ec4 10f70-10f81 11071-11072 11075 1123f-11240"
    " 11380-11389 1138b 1138e 11390-113b5 113b7 113d1 113d3 11740-11746 11ab0-11abf 11bc0-11be0 11f02 11f04-11f10 11f12-11f33"
    " 12f90-12ff0 1342f 13441-13446 13460-143fa 16100-1611d 16a70-16abe 16d40-16d6c 18cff 1aff0-1aff3 1aff5-1affb 1affd-1affe"
    " 1b11f-1b122 1b132 1b155 1df00-1df1e 1df25-1df2a 1e030-1e06d 1e290-1e2ad 1e4d0-1e4eb 1e5d0-1e5ed 1e5f0 1e7e0-1e7e6"
    " 1e7e8-1e7eb 1e7ed-1e7ee 1e7f0-1e7fe 2a6de-2a6df 2b735-2b739 2ebf0-2ee5d 31350-323af"
)
NEW_NUMBERS = "10d40-10d49 116d0-116e3 11bf0-11bf9 11f50-11f59 16130-16139 16ac0-16ac9 16d70-16d79 1ccf0-1ccf9 1d2c0-1d2d3 1e4f0-1e4f9 1e5f1-1e5fa"


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks by token from a file of base64 tokens and numbers.  All single bytes must be there and ranks must run from 0."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    if sorted(ranks.values()) != list(range(len(ranks))) or any(bytes([i]) not in ranks for i in range(256)):
        raise ValueError("ranks must be 0, 1, 2, ... and hold every single byte")
    return ranks


def java_pattern(pattern: str) -> str:
    """The tokenizer's pattern for Java: white space of Unicode, and letters and numbers that Java may not know yet.

    ASCII is named first and alternatives that begin alike are joined: the same matches, found sooner.
    """
    ranges = lambda s: "".join("-".join(rf"\x{{{x}}}" for x in r.split("-")) for r in s.split())
    for kind, plain, new in ((r"\p{L}", "a-zA-Z", NEW_LETTERS), (r"\p{N}", "0-9", NEW_NUMBERS)):
        pattern = pattern.replace(kind, rf"[{plain}{kind}[\p{{Cn}}&&[{ranges(new)}]]]")
    return "(?U)" + pattern.replace("'s|'t|'re|'ve|'m|'ll|'d", "'(?:s|t|re|ve|m|ll|d)")


def split_words(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(java_pattern(pattern)), F.lit(0))


@dataclass
class RankMap:
    """Ranks of pairs of ids for a fold: `slots` has (pair << ID_BITS | rank) at pair % p or at p + pair % q, and -1 elsewhere."""

    slots: Column
    primes: tuple[int, int]
    byte_ids: Column
    #: Tokens, in hex, that the merges of their own bytes don't reach.
    apart: dict[str, int]


def _prime_above(n: int) -> int:
    return next(k for k in range(n | 1, 2 * n + 4, 2) if all(k % d for d in range(3, int(k**0.5) + 1, 2)))


def pair_slots(pairs: dict[int, int]) -> tuple[list[int], int, int]:
    """Each pair with its rank at one of its two places; a newcomer moves who is there to the other one."""
    p = _prime_above(max(64, len(pairs) * 4 // 3))
    while True:
        q = _prime_above(p + 2)
        slots = [-1] * (p + q)
        for pair, rank in pairs.items():
            item, at = pair << ID_BITS | rank, pair % p
            for _ in range(200):
                item, slots[at] = slots[at], item
                if item < 0:
                    break
                own = item >> ID_BITS
                at = own % p if at >= p else p + own % q
            else:
                break  # no place was found: a larger table
        else:
            return slots, p, q
        p = _prime_above(p * 5 // 4)


def rank_map(ranks: dict[bytes, int]) -> RankMap:
    if len(ranks) >= NO_RANK:
        raise ValueError(f"more than {NO_RANK - 1} ranks")
    cuts = ((ranks.get(t[:i]), ranks.get(t[i:]), k) for t, k in ranks.items() for i in range(1, len(t)))
    slots, p, q = pair_slots({a << ID_BITS | b: k for a, b, k in cuts if a is not None and b is not None})
    array = lambda x: F.from_json(F.lit(json.dumps(x, separators=(",", ":"))), "array<bigint>")
    apart = {t.hex().upper(): k for t, k in ranks.items() if len(t) <= LONG and merge_long(t, ranks) != [k]}
    return RankMap(array(slots), (p, q), array([ranks[bytes([i])] for i in range(256)]), apart)


def _let(value: Column, f) -> Column:
    """f of a value that is computed once."""
    return F.transform(F.array(value), f)[0]


def fold_words(words: Column, table: RankMap, states: Column | None = None) -> Column:
    """Ids of each word of an array by a rank_map(); null for words of more than LONG bytes.

    `states` may have the words' first_states(), so that the fold need not make them.
    """
    first = lambda i: None if states is None else F.get(states, i)
    fold = lambda slots, ids: F.transform(words, lambda x, i: F.when(F.octet_length(x) <= LONG, _fold(x, slots, ids, table, first(i))))
    return _let(table.slots, lambda slots: _let(table.byte_ids, lambda ids: fold(slots, ids)))


def byte_pairs(ranks: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of single bytes, and ranks of pairs of bytes."""
    pairs = [ranks.get(bytes([a, b]), NO_RANK) for a in range(256) for b in range(256)]
    return np.array([ranks[bytes([i])] for i in range(256)], np.int64), np.array(pairs, np.int64).reshape(256, 256)


def first_states(words: pa.Array, byte_ids: np.ndarray, pair_ranks: np.ndarray) -> pa.ListArray:
    """What a fold begins with: a piece for each byte of a word.  Words of more than LONG bytes have none."""
    words = words.cast(pa.large_binary())
    offsets = np.frombuffer(words.buffers()[1], np.int64)[words.offset:words.offset + len(words) + 1] if len(words) else np.zeros(1, np.int64)
    sizes = np.diff(offsets)
    sizes[sizes > LONG] = 0
    edges = np.append(0, np.cumsum(sizes))
    data = np.frombuffer(words.buffers()[2], np.uint8)[_ragged(offsets[:-1], sizes)] if edges[-1] else np.empty(0, np.uint8)
    rank = np.append(pair_ranks[data[:-1], data[1:]], NO_RANK)[:len(data)]
    rank[edges[1:][sizes > 0] - 1] = NO_RANK
    place = np.arange(len(data)) - np.repeat(edges[:-1], sizes)
    return pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array((rank << (ID_BITS + PLACE_BITS)) | (place << ID_BITS) | byte_ids[data]))


def _fold(word: Column, slots: Column, byte_ids: Column, table: RankMap, state: Column | None = None) -> Column:
    """Ids of one word that isn't empty."""
    p, q = table.primes
    low, none = ID_BITS + PLACE_BITS, NO_RANK << (ID_BITS + PLACE_BITS)
    id_of = lambda x: x.bitwiseAND(NO_RANK)

    def rank(a: Column, b: Column) -> Column:
        """Rank of a pair of ids, shifted to its place in the state."""
        def look(pair: Column) -> Column:
            one, two = F.get(slots, pair % p), F.get(slots, pair % q + p)
            known = lambda x: F.shiftright(x, ID_BITS) == pair
            return F.when(known(one), F.shiftleft(id_of(one), low)).when(known(two), F.shiftleft(id_of(two), low)).otherwise(F.lit(none))

        return _let(F.shiftleft(a, ID_BITS) + b, look)

    def begin(ids: Column) -> Column:
        after = lambda x, y: F.when(y.isNull(), F.lit(none)).otherwise(rank(x, y))
        return F.transform(ids, lambda x, i: after(x, F.get(ids, i + 1)) + F.shiftleft(i.cast("long"), ID_BITS) + x)

    def merge(s: Column, least: Column, i: Column) -> Column:
        """The pieces with the pair at i made one, and the ranks of its pairs with its neighbours looked up anew."""
        new, place = F.shiftright(least, low), least.bitwiseAND(((1 << PLACE_BITS) - 1) << ID_BITS)
        left = F.transform(F.slice(s, F.greatest(i - 1, F.lit(1)), F.least(i - 1, F.lit(1))), lambda x: rank(id_of(x), new) + x.bitwiseAND((1 << low) - 1))
        right = F.get(s, i + 1)
        own = F.when(right.isNull(), F.lit(none)).otherwise(rank(new, id_of(right))) + place + new
        return F.concat(F.slice(s, F.lit(1), F.greatest(i - 2, F.lit(0))), left, F.array(own), F.slice(s, i + 2, F.lit(LONG)))

    def step(state: Column, _: Column) -> Column:
        merged = lambda m: _let(F.array_position(state, m).cast("int"), lambda i: merge(state, m, i))
        return _let(F.array_min(state), lambda m: F.when(m >= none, state).otherwise(merged(m)))

    if state is None:
        letters = F.split(F.decode(word.cast("binary"), "ISO-8859-1"), "")
        state = _let(F.transform(letters, lambda x: F.get(byte_ids, F.ascii(x))), begin)
    # as many steps as there are bytes but one
    folded = _let(state, lambda own: F.aggregate(F.slice(own, 2, LONG), own, step, lambda s: F.transform(s, lambda x: id_of(x).cast("int"))))
    if not table.apart:
        return folded
    apart = F.from_json(F.lit(json.dumps(table.apart)), "map<string,int>")
    return _let(F.try_element_at(apart, F.hex(word)), lambda k: F.when(k.isNotNull(), F.array(k)).otherwise(folded))


def merge_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a long word: the lowest-ranked, leftmost pair of a heap is merged until none is left."""
    parts: list[bytes | None] = [piece[i:i + 1] for i in range(len(piece))]
    before, after = list(range(-1, len(piece) - 1)), [*range(1, len(piece)), -1]
    heap = [(k, i, 2) for i in range(len(piece) - 1) if (k := ranks.get(piece[i:i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, size = heapq.heappop(heap)
        if parts[i] is None or (j := after[i]) < 0 or len(parts[i]) + len(parts[j]) != size:
            continue  # one of the two has been merged since
        parts[i], parts[j], after[i] = parts[i] + parts[j], None, after[j]
        if after[j] >= 0:
            before[after[j]] = i
        for a, b in ((before[i], i), (i, after[i])):
            if a >= 0 and b >= 0 and (k := ranks.get(parts[a] + parts[b])) is not None:
                heapq.heappush(heap, (k, a, len(parts[a]) + len(parts[b])))
    return [ranks[p] for p in parts if p is not None]


def _hashes(values: pa.Array) -> np.ndarray:
    out = [w.span_hashes(data, offsets[:-1], offsets[1:], lower=False) for _, _, data, offsets in w.chunks(values)]
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct words of a task with their counts, in several goes if there are many."""
    kept: list[tuple[np.ndarray, pa.Array, np.ndarray]] = []

    def joined(parts):
        hashes, counts = np.concatenate([p[0] for p in parts]), np.concatenate([p[2] for p in parts])
        all_words = pa.chunked_array([p[1] for p in parts])
        same, first, place = np.unique(hashes, return_index=True, return_inverse=True)
        return same, all_words.take(pa.array(first)).combine_chunks(), np.bincount(place, counts, len(same)).astype(np.int64)

    def rows(part):
        return pa.RecordBatch.from_arrays([pa.array(w.signed(part[0])), part[1], pa.array(part[2])], ["hash", "word", "n"])

    held = 0
    for batch in batches:
        values = batch.column(0).flatten()
        values = values.filter(pc.less_equal(pc.binary_length(values), LONG))
        if not len(values):
            continue
        hashes = _hashes(values)
        same, first, n = np.unique(hashes, return_index=True, return_counts=True)
        kept.append((same, values.take(pa.array(first)), n))
        held += len(same)
        if held > HELD_WORDS:
            kept = [joined(kept)]
            held = len(kept[0][0])
            if held > HELD_WORDS // 2:
                yield rows(kept[0])
                kept, held = [], 0
    if kept:
        yield rows(joined(kept))


def _dictionary(words: DataFrame, head: int, table: RankMap) -> pa.Table:
    """(hash, ids) of the words of most occurrences: as many whole classes of counts (by binary digits) as `head` holds."""
    counted = words.mapInArrow(_count_words, "hash long, word string, n long").groupBy("hash", "word").agg(F.sum("n").alias("n")).persist()
    try:
        least, room = 1 << 62, head
        for r in counted.groupBy(F.length(F.bin("n")).alias("digits")).count().orderBy(F.desc("digits")).collect():  # 64 rows at most
            if r["count"] > room:
                break
            least, room = 1 << (r.digits - 1), room - r["count"]
        return counted.filter(F.col("n") >= least).select("hash", fold_words(F.array("word"), table)[0].alias("ids")).toArrow()
    finally:
        counted.unpersist()


def _ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Positions starts[0], starts[0] + 1, ... of every run."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)


def _look_up(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    """Ids of frequent words, -1 for each other word, the other words, and what their folds begin with."""
    known, starts, ids, byte_ids, pair_ranks = shared.value
    for batch in batches:
        lists = batch.column(1)
        values, edges = lists.flatten(), lists.offsets.to_numpy() - lists.offsets[0].as_py()
        hashes = _hashes(values)
        at = np.minimum(np.searchsorted(known, hashes), max(len(known) - 1, 0))
        found = known[at] == hashes if len(known) else np.zeros(len(hashes), bool)
        sizes = np.where(found, starts[at + 1] - starts[at], 1) if len(known) else np.ones(len(hashes), np.int64)
        out = ids[np.minimum(_ragged(np.where(found, starts[at], 0), sizes), max(len(ids) - 1, 0))] if len(known) else np.empty(len(hashes), np.int32)
        before = np.append(0, np.cumsum(sizes))
        out[before[:-1][~found]] = -1
        missed = pa.array(np.append(0, np.cumsum(~found))[edges].astype(np.int32))
        rare = values.filter(pa.array(~found))
        yield pa.RecordBatch.from_arrays([
            batch.column(0), pa.ListArray.from_arrays(pa.array(before[edges].astype(np.int32)), pa.array(out)),
            pa.ListArray.from_arrays(missed, rare), pa.ListArray.from_arrays(missed, first_states(rare, byte_ids, pair_ranks)),
        ], ["doc_id", "ids", "rare", "states"])


def _splice(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    """The ids of other words put in their places; those that were too long for a fold are merged here."""
    ranks = None
    for batch in batches:
        lists, rare, coded = batch.column(1), batch.column(2), batch.column(3).flatten()
        flat, edges = lists.flatten().to_numpy(zero_copy_only=False), lists.offsets.to_numpy() - lists.offsets[0].as_py()
        if coded.null_count:
            ranks = ranks or read_ranks(path)
            texts, filled = rare.flatten(), coded.to_pylist()
            for i in np.flatnonzero(coded.is_null().to_numpy(zero_copy_only=False)):
                filled[i] = merge_long(texts[int(i)].as_py().encode(), ranks)
            coded = pa.array(filled, pa.list_(pa.int32()))
        holes = np.flatnonzero(flat == -1)
        sizes = np.ones(len(flat), np.int64)
        if len(holes):
            sizes[holes] = pc.list_value_length(coded).to_numpy(zero_copy_only=False)
        before = np.append(0, np.cumsum(sizes))
        out = np.repeat(flat, sizes).astype(np.int32)
        if len(holes):
            out[_ragged(before[holes], sizes[holes])] = coded.flatten().to_numpy(zero_copy_only=False)
        edges = before[edges]
        prints = [hashlib.sha256(out[a:b].astype("<u4").tobytes()).hexdigest() for a, b in zip(edges[:-1], edges[1:], strict=True)]
        ids = pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array(out))
        yield pa.RecordBatch.from_arrays([batch.column(0), ids, pa.array(prints, pa.string())], ["doc_id", "ids", "ids_sha256"])


def encode(documents: DataFrame, path: str, pattern: str, head: int = HEAD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids (array of int) of every whole text, and the sha256 of the ids as little-endian 32-bit integers.

    No special tokens are made; each match of the pattern is encoded by itself.

    Null and empty texts have no ids.  Rows that repeat an id are encoded one by one and null ids are kept; an empty table gives no
    rows; other columns are ignored.  `head` bounds the words that are broadcast and changes the work, not the result.
    """
    spark = documents.sparkSession
    ranks = read_ranks(path)
    table = rank_map(ranks)
    rows = numbered(documents, id_col, text_col).select("doc_id", split_words(F.col("text"), pattern).alias("words"))
    folded = _dictionary(rows.select("words"), head, table)
    known = folded["hash"].to_numpy().view(np.uint64)
    order = np.argsort(known)
    ids = folded["ids"].combine_chunks().take(pa.array(order)) if len(order) else pa.array([], pa.list_(pa.int32()))
    shared = spark.sparkContext.broadcast((known[order], ids.offsets.to_numpy().astype(np.int64), ids.flatten().to_numpy(zero_copy_only=False).astype(np.int32), *byte_pairs(ranks)))

    looked_up = rows.mapInArrow(lambda it: _look_up(it, shared), "doc_id long, ids array<int>, rare array<string>, states array<array<bigint>>")
    coded = looked_up.select("doc_id", "ids", "rare", fold_words(F.col("rare"), table, F.col("states")).alias("coded"))
    return coded.mapInArrow(lambda it: _splice(it, path), "doc_id long, ids array<int>, ids_sha256 string")


def decode(ids: Column, ranks: dict[bytes, int]) -> Column:
    """The bytes of an array of ids.  Null gives null, no ids give no bytes; an id that has no token ends the job with an error.

    Pieces are joined as hex digits: a piece need not be whole UTF-8.
    """
    names = [""] * len(ranks)
    for token, k in ranks.items():
        names[k] = token.hex().upper()
    literal = F.split(F.lit(",".join(names)), ",")
    # an id without token gives a sign that is no hex digit, and so null
    joined = F.unhex(F.array_join(F.transform(ids, lambda k: F.get(literal, k)), "", "!"))
    return F.when(ids.isNotNull(), F.coalesce(joined, F.raise_error(F.lit("an id has no token"))))


def digests(encoded: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """doc_id, n_tokens, sha256 of the ids as little-endian 32-bit integers, and sha256 of the decoded bytes."""
    decoded = F.sha2(decode(F.col("ids"), ranks), 256).alias("decoded_sha256")
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids_sha256", decoded)
