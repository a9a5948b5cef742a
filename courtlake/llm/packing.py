"""Packing token sequences into fixed contexts by bin completion over the histogram of lengths.

Pieces of equal length are interchangeable, so a packing is a list of patterns (multisets of lengths) with counts.  The
histogram has at most `capacity` rows whatever the size of the corpus.

1. Incumbents.  Around the largest length left, the filling of the greatest sum (exact, by subset sums over a bit set, longest
   pieces first) is used as often as the counts allow.  Best-fit decreasing gives another solution; the better one stays.
2. Bound.  No packing has fewer sequences than the tokens fill, nor than pieces of more than half a context need.
3. If the incumbent is above the bound, bin completion: branch over the undominated fillings around the largest piece, best
   fit first, and prune when the waste so far exceeds what a better solution may waste.  It takes the bins of the
   incumbent that waste most, more of them each time, as those of a large corpus hardly waste anything.  A small corpus is
   searched whole, so its packing is optimal.

Spark then ranks the pieces of each length (salted, so that a common length is many tasks) and looks each rank up in the
pattern table.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from courtlake.llm.common import drop_stored, numbered, stored

#: Nodes of one search; a search that ends there leaves the incumbent, whose distance to the bound is in the result.
NODES = 20_000
#: Pieces, in the incumbent's most wasteful bins, that are searched anew, one number after the other.
TAILS = (24, 48, 96)
#: Ranges that each length is ranked in.
SALTS = 64
#: Distinct words that a Python worker keeps with their ids, at about 140 bytes each.
CACHE_WORDS = 1 << 18

#: Texts of these characters alone need no normalisation beyond lower case, and split the same way everywhere.
_PLAIN = re.compile(r"[\t\n\r -~À-ÖØ-öø-ÿ]*")
_WORDS = re.compile(r"[a-zß-öø-ÿ]+|[0-9]|'(?:s|t|re|ve|m|ll|d)|[^\sa-zß-öø-ÿ0-9]+")
#: The byte-level pre-tokenizer's letters for all bytes: printable Latin-1 stands for itself, the rest for letters from U+0100 on.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_LETTERS = {b: chr(b if b in _PRINTABLE else 256 + i) for i, b in enumerate(sorted(range(256), key=lambda b: (b in _PRINTABLE, b)))}


class Encoder:
    """Ids of whole texts as little-endian uint32 bytes; a bounded cache of words saves most of the merging."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.known: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def word(self, word: str) -> bytes:
        """Ids of a word of a plain text: nothing is left to normalise or to split, so the merges alone give them."""
        letters = word if word.isascii() else word.encode().decode("latin-1").translate(_LETTERS)
        ids = [t.id for t in self.model.tokenize(letters)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def learn(self, words: set[str]) -> None:
        if len(self.known) > CACHE_WORDS:
            self.known = {}
        self.known.update((word, self.word(word)) for word in words.difference(self.known))

    def encode(self, texts: list[str]) -> list[bytes]:
        split = [_WORDS.findall(t.lower()) if _PLAIN.fullmatch(t) and not any(s in t for s in self.specials) else None for t in texts]
        self.learn(set().union(*(words for words in split if words)))
        get = self.known.__getitem__
        return [self.whole(t) if words is None else b"".join(map(get, words)) for t, words in zip(texts, split, strict=True)]


@lru_cache(maxsize=1)
def _encoder(path: str) -> Encoder:
    """One encoder a Python worker: the tasks that it runs share the words they have met."""
    return Encoder(path)


def _pieces(batches: Iterator[pa.RecordBatch], path: str, capacity: int, end_id: int, with_ids: bool) -> Iterator[pa.RecordBatch]:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    encoder = _encoder(path)
    end = np.array([end_id], "<u4").tobytes()
    for batch in batches:
        for a in range(0, batch.num_rows, 200):
            part = batch.slice(a, 200)
            rows = []
            for doc_id, ids in zip(part.column(0).to_pylist(), encoder.encode([t or "" for t in part.column(1).to_pylist()]), strict=True):
                ids += end
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    own = ids[at:at + 4 * capacity]
                    rows.append((doc_id, k, at // 4, len(own) // 4, zlib.crc32(own), own if with_ids else None))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 6
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)][: 5 + with_ids], ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: 5 + with_ids])


Filling = list[tuple[int, int]]


def reachable(room: int, lengths: list[int], counts: dict[int, int]) -> list[int]:
    """Bit sets of the sums, up to `room`, of the first 0, 1, 2, ... of these lengths."""
    mask, sums = (2 << room) - 1, [1]
    for x in lengths:
        now, left, step = sums[-1], min(counts[x], room // x), 1
        while left > 0:
            step = min(step, left)
            now |= now << step * x & mask
            left, step = left - step, 2 * step
        sums.append(now)
    return sums


def best_filling(room: int, counts: dict[int, int]) -> Filling:
    """The multiset of available lengths with the greatest sum up to `room`: [(length, times)], longest first."""
    if counts.get(room, 0):
        return [(room, 1)]
    lengths = sorted(x for x, n in counts.items() if n and x <= room)
    for x in reversed(lengths):
        if 2 * x < room:
            break
        if counts.get(room - x, 0) > (2 * x == room):
            return [(x, 2)] if 2 * x == room else [(x, 1), (room - x, 1)]
    sums = reachable(room, lengths, counts)
    left, filling = sums[-1].bit_length() - 1, []
    for i in range(len(lengths) - 1, -1, -1):
        x = lengths[i]
        for times in range(min(counts[x], left // x), -1, -1):
            if sums[i] >> left - times * x & 1:
                break
        if times:
            filling.append((x, times))
            left -= times * x
    return filling


def fillings(room: int, counts: dict[int, int], least: int) -> Iterator[Filling]:
    """All multisets of available lengths with a sum from `room` down to `least`, greatest sum first, then longest pieces."""
    lengths = sorted(x for x, n in counts.items() if n and x <= room)
    sums = reachable(room, lengths, counts)

    def exact(i: int, left: int) -> Iterator[Filling]:
        if not left:
            yield []
            return
        x = lengths[i - 1]
        for times in range(min(counts[x], left // x), -1, -1):
            if sums[i - 1] >> left - times * x & 1:
                for rest in exact(i - 1, left - times * x):
                    yield [(x, times), *rest] if times else rest

    for total in range(room, max(least, 0) - 1, -1):
        if sums[-1] >> total & 1:
            yield from exact(len(lengths), total)


def dominates(one: Filling, other: Filling) -> bool:
    """Whether the pieces of `other` fit into those of `one` as bins, so that swapping them never costs a sequence."""
    room = [x for x, n in one for _ in range(n)]
    pieces = [x for x, n in other for _ in range(n)]
    if sum(pieces) > sum(room) or pieces and (not room or pieces[0] > room[0]):
        return False

    def put(i: int) -> bool:
        if i == len(pieces):
            return True
        for k in range(len(room)):
            if room[k] >= pieces[i] and room[k] not in room[:k]:
                room[k] -= pieces[i]
                if put(i + 1):
                    return True
                room[k] += pieces[i]
                if len(pieces) > 10:  # many pieces: first fit only, which may miss a dominance and costs nothing but time
                    return False
        return False

    return put(0)


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Sequences that any packing needs: for all tokens; for every limit, as many as pieces of that length or more fit into
    one; and for pieces above half a context with what doesn't fit beside them."""
    best = -(-sum(x * n for x, n in counts.items()) // capacity)
    for limit in counts:
        best = max(best, -(-sum(n for x, n in counts.items() if x >= limit) // (capacity // limit)))
        if 2 * limit > capacity:
            continue
        alone = sum(n for x, n in counts.items() if x > capacity - limit)
        large = [(x, n) for x, n in counts.items() if 2 * x > capacity and x <= capacity - limit]
        small = sum(x * n for x, n in counts.items() if limit <= x and 2 * x <= capacity)
        room = sum((capacity - x) * n for x, n in large)
        best = max(best, alone + sum(n for _, n in large) + max(0, -(-(small - room) // capacity)))
    return best


def _without(counts: dict[int, int], filling: Filling, bins: int = 1) -> dict[int, int]:
    left = dict(counts)
    for x, times in filling:
        left[x] -= bins * times
        if not left[x]:
            del left[x]
    return left


def best_sums(counts: dict[int, int], capacity: int) -> list[tuple[int, Filling]]:
    """The filling of the greatest sum around the largest length left, as often as the counts allow: [(bins, filling)]."""
    patterns = []
    while counts:
        largest = max(counts)
        filling = dict(best_filling(capacity - largest, _without(counts, [(largest, 1)])))
        filling[largest] = filling.get(largest, 0) + 1
        bins = min(counts[x] // times for x, times in filling.items())
        patterns.append((bins, sorted(filling.items(), reverse=True)))
        counts = _without(counts, patterns[-1][1], bins)
    return patterns


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[int, Filling]]:
    """Best-fit decreasing over equal bins at once: [(bins, filling)]."""
    open_bins: dict[int, list[tuple[int, Filling]]] = {}
    for x in sorted(counts, reverse=True):
        left = counts[x]
        while left:
            room = min((r for r in open_bins if r >= x), default=None)
            bins, filling = open_bins[room].pop() if room is not None else (left, [])
            if room is not None and not open_bins[room]:
                del open_bins[room]
            room = capacity if room is None else room
            each = min(room // x, max(1, left // bins))
            used = min(bins, left // each)
            if used < bins:
                open_bins.setdefault(room, []).append((bins - used, filling))
            open_bins.setdefault(room - each * x, []).append((used, [*filling, (x, each)]))
            left -= used * each
    return [b for own in open_bins.values() for b in own if b[1]]


def complete(counts: dict[int, int], capacity: int, sequences: int, nodes: int = NODES) -> list[tuple[int, Filling]] | None:
    """Bin completion: a packing into at most so many sequences, or null if there is none or the nodes are used up."""
    left = nodes

    def search(counts: dict[int, int], waste: int) -> list[tuple[int, Filling]] | None:
        nonlocal left
        if not counts:
            return []
        left -= 1
        largest = max(counts)
        room, rest, tried = capacity - largest, _without(counts, [(largest, 1)]), []
        for filling in fillings(room, rest, room - waste):
            if left < 0:
                return None
            if any(dominates(f, filling) for f in tried):
                continue
            tried.append(filling)
            unused = room - sum(x * n for x, n in filling)
            found = search(_without(rest, filling), waste - unused)
            if found is not None:
                own = dict(filling)
                own[largest] = own.get(largest, 0) + 1
                return [(1, sorted(own.items(), reverse=True)), *found]
        return None

    waste = sequences * capacity - sum(x * n for x, n in counts.items())
    return search(counts, waste) if waste >= 0 else None


def plan_patterns(histogram: dict[int, int], capacity: int, nodes: int = NODES, tails: tuple[int, ...] = TAILS) -> list[tuple[int, Filling]]:
    """Bin completion over a histogram of lengths: [(number of bins, [(length, times), ...])]."""
    counts = {x: n for x, n in histogram.items() if n > 0}
    size = lambda patterns: sum(bins for bins, _ in patterns)
    best, bound = best_sums(counts, capacity), lower_bound(counts, capacity)
    if size(best) > bound:
        best = min(best, best_fit(counts, capacity), key=size)
    unused = lambda pattern: capacity - sum(x * n for x, n in pattern[1])
    for tail in tails:
        # the bins of the incumbent that waste most, up to `tail` pieces
        best = sorted(best, key=unused)
        bins = [(1, f) for n, f in best for _ in range(min(n, tail))]
        last, pieces = [], 0
        while bins and pieces + sum(n for _, n in bins[-1][1]) <= tail:
            last.append(bins.pop())
            pieces += sum(n for _, n in last[-1][1])
        open_counts: dict[int, int] = {}
        for _, filling in last:
            for x, n in filling:
                open_counts[x] = open_counts.get(x, 0) + n
        while size(best) > bound and last:
            found = complete(open_counts, capacity, len(last) - 1, nodes)
            if found is None:
                break
            best = [*_cut(best, len(last)), *found]
            last = found
        if size(best) <= bound or pieces == sum(counts.values()):
            break
    return best


def _cut(patterns: list[tuple[int, Filling]], bins: int) -> list[tuple[int, Filling]]:
    """Patterns without their last bins."""
    out = list(patterns)
    while bins:
        n, filling = out.pop()
        if n > bins:
            out.append((n - bins, filling))
        bins -= min(n, bins)
    return out


def pattern_table(patterns: list[tuple[int, list[tuple[int, int]]]]) -> list[tuple[int, int, int, int, int, int]]:
    """Rows (length, first rank, end rank, times in a bin, first sequence, offset) for the lookup by rank."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for bins, filling in patterns:
        offset = 0
        for length, times in filling:
            first = used.get(length, 0)
            used[length] = first + bins * times
            rows.append((length, first, first + bins * times, times, sequence, offset))
            offset += length * times
        sequence += bins
    return rows


def _place(batches: Iterator[pa.RecordBatch], table: np.ndarray) -> Iterator[pa.RecordBatch]:
    keys = (table[:, 0] << 44) + table[:, 1]
    for batch in batches:
        length, rank = (batch.column(k).to_numpy() for k in ("length", "rank"))
        row = table[np.searchsorted(keys, (length << 44) + rank, side="right") - 1]
        place = rank - row[:, 1]
        columns = [batch.column(k) for k in ("doc_id", "piece", "start", "length", "ids_crc32")]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(row[:, 4] + place // row[:, 3]), pa.array(row[:, 5] + place % row[:, 3] * length)], ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])


def token_pieces(documents: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per piece of a tokenised document: doc_id, piece, start, length, ids_crc32, and ids (binary) if asked for.

    Ids are those of the tokenizer for the whole text without special tokens, then `end_id`; a null text counts as empty, so
    it is the end id alone.  A document of more than `capacity` ids is cut into pieces of `capacity`; the last may be shorter.
    """
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    return numbered(documents, id_col, text_col).mapInArrow(lambda it: _pieces(it, tokenizer_path, capacity, end_id, with_ids), schema)


def pack(documents: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", nodes: int = NODES) -> DataFrame:
    """Every piece of every document with its sequence_id (gapless from 0), its offset in the sequence, and
    least_sequences, a number that no packing of all pieces can stay below.

    Sequences hold at most `capacity` ids.  Rows that repeat an id are packed as they come, each with its own pieces; a
    null id is kept.  An empty table gives no rows.  Other columns are ignored.  `ids` are left out: token_pieces() with
    with_ids gives them, to be joined on (doc_id, piece).
    """
    pieces = stored(token_pieces(documents, tokenizer_path, capacity, end_id, id_col, text_col))
    salt = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(SALTS)).cast("int")
    salted = pieces.withColumn("salt", salt)
    # at most capacity x SALTS rows, whatever the input
    cells = stored(salted.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n")))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    histogram = {r.length: r.n for r in cells.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    table = np.array(sorted(pattern_table(plan_patterns(histogram, capacity, nodes))), np.int64).reshape(-1, 6)
    own = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = salted.withColumn("own", F.row_number().over(own) - 1).join(F.broadcast(cells.select("length", "salt", before.alias("before"))), ["length", "salt"])
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("own") + F.col("before")).cast("long").alias("rank"))
    placed = ranked.mapInArrow(lambda it: _place(it, table), "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
    return placed.withColumn("least_sequences", F.lit(lower_bound(histogram, capacity)).cast("long"))
