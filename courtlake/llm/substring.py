"""Repeated passages: compact windows of min-hashes, interval joins over hash functions, verification on whole passages.

The tokens of a text are its word shingles.  For one hash function, the Cartesian tree of the tokens' hashes has a node for
every token; the subsequences whose least hash is that token's are those that start in [left, centre] and end in
[centre, right], where left and right are the ends of its subtree.  This is a compact window.  Only windows that are at
least as long as the shortest passage count: about 2 / 47 of the tokens for passages of 50 words.

1. Compact windows of `HASHES` functions.  Those whose hash no other document holds are left out.
2. Inside a document, windows of different functions are joined on their intervals: subsequences in the overlap of two share
   two min-hashes.  Two passages of similarity 0.8 agree in two of five functions with a probability of 0.993.
   Documents are grouped by these pairs of hashes.
3. Every document of a group meets the group's first document (smallest id).  The words around both windows are compared: a
   passage is a union of ranges of which enough shingles occur in one range of the other, in about the same order.  Rows stay
   linear in the groups' sizes.
4. Ranges that this leaves open, in groups where at least two documents have such, are hashed anew with their shingles
   ordered from rare to common; shingles of one document don't count, nor do ranges in which too few are left.  A common
   phrase then brings ranges together only if they share little else.  Open documents of the new groups meet the first
   8, 64, ... that are still open, until no group has two open documents that were not compared.

Documents of one text are one document with copies throughout.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from courtlake.llm import words as w
from courtlake.llm.common import BATCH_BYTES, broadcast_if_small, drop_stored, free_shuffles, numbered, stored

SHINGLE = 5
#: Hash functions; at most 8, as a key's last three bits name its function.
HASHES = 5
#: Documents of a group that the others meet in the second round; as many times more in each round that follows.
LEADERS = 8
#: Tokens of a block: what is compared of a long text is the block that holds the window, with its surroundings.
BLOCK = 2048
NONE = np.uint64(2**64 - 1)

ENTRY = "key long, doc_id long, place long"
PAIR = "sig long, doc_id long, first int, last int"
SPAN = "doc_id long, start_word long, end_word long, source long, lo long, hi long"


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every `width` consecutive values, by doubling."""
    span, out = 1, values
    while 2 * span <= width:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    rest = width - span
    return np.minimum(out[:-rest], out[rest:]) if rest else out


def nearest_lower(values: np.ndarray) -> np.ndarray:
    """Index of the nearest smaller value to the left of each of these distinct values; 0 for the first.

    The first value must be the least.  All pointers jump at once, over what is known to be larger.
    """
    before = np.maximum(np.arange(len(values)) - 1, 0)
    moving = np.flatnonzero(values[before] > values)
    while len(moving):
        before[moving] = before[before[moving]]
        moving = moving[values[before[moving]] > values[moving]]
    return before


class Slots:
    """Places for the tokens of documents, one more before each document and after the last: edges that no window crosses."""

    def __init__(self, docs: np.ndarray):
        new = np.ones(len(docs), np.int64)
        new[1:] = docs[1:] != docs[:-1]
        self.slot = np.arange(len(docs)) + np.cumsum(new)
        self.size = len(docs) + int(new.sum()) + 1
        self.edge = np.ones(self.size, bool)
        self.edge[self.slot] = False
        self.edges = np.flatnonzero(self.edge)
        self.scale = 2.0 ** self.size.bit_length()


def compact_windows(slots: Slots, hashes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Compact windows of at least `width` tokens of one document: centre (token index), tokens to its left and right.

    Hashes are compared by as many leading bits as a double holds beside the place; of equal ones the first counts as the
    smaller.  Tokens with the hash NONE are the centre of no window.
    """
    if len(hashes) < width:
        return (np.empty(0, np.int64),) * 3
    drop = np.uint64(11 + int(np.log2(slots.scale)))
    order = np.arange(slots.size, dtype=np.float64)
    order[slots.slot] += ((hashes >> drop).astype(np.float64) + 1) * slots.scale
    least = window_minima(order, width)
    least = least[np.append(True, least[1:] != least[:-1])]
    least = least[least >= slots.scale]
    if not len(least):
        return (np.empty(0, np.int64),) * 3
    centres = np.mod(least, slots.scale).astype(np.int64)
    # the Cartesian tree of these tokens: the nearest smaller value of a window's centre is again a centre, or an edge
    nodes = np.sort(np.concatenate([centres, slots.edges]))
    own = order[nodes]
    before = nearest_lower(own)
    back = own[::-1].copy()
    back[0] = -1
    after = len(nodes) - 1 - nearest_lower(back)[::-1]
    inside = ~slots.edge[nodes]
    left, at, right = nodes[before[inside]] + 1, nodes[inside], nodes[after[inside]] - 1
    token = at - np.searchsorted(slots.edges, at)
    real = hashes[token] != NONE
    return token[real], (at - left)[real], (right - at)[real]


def _tokens(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document index, word index in the document, and hash of every shingle."""
    docs, words = w.hashed_words(data, offsets, lower=True)
    counts = w.word_counts(docs, len(offsets) - 1)
    at, tokens = w.shingles(docs, words, size)
    return docs[at], at - (np.cumsum(counts) - counts)[docs[at]], tokens


def _seed(k: int) -> np.uint64:
    return w.mix(np.array([k + 1], np.uint64))[0]


def _keys(hashes: np.ndarray, k: int) -> np.ndarray:
    return w.signed(hashes & ~np.uint64(7) | np.uint64(k))


def pack_windows(centre: np.ndarray, left: np.ndarray, right: np.ndarray, width: int) -> np.ndarray:
    """Centre, and tokens to its left and right, of each window in one number, which takes fewer bytes in a shuffle.

    Sides are cut to width - 1 tokens, as no range of `width` tokens that holds the centre goes beyond.
    """
    bits = width.bit_length()
    if len(centre) and int(centre.max()) >> (63 - 2 * bits):
        raise OverflowError(f"a text of {int(centre.max())} words is too long for passages of {width}")
    return (centre.astype(np.int64) << 2 * bits) | (np.minimum(left, width - 1) << bits) | np.minimum(right, width - 1)


def unpack_windows(place: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First token, centre and last token of windows made by pack_windows()."""
    bits = width.bit_length()
    centre, mask = place >> 2 * bits, (1 << bits) - 1
    return centre - ((place >> bits) & mask), centre, centre + (place & mask)


def _entries(batches: Iterator[pa.RecordBatch], size: int, width: int) -> Iterator[pa.RecordBatch]:
    """Compact windows of every document under every hash function."""
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        for begin, _end, data, offsets in w.chunks(batch.column(1)):
            docs, place, tokens = _tokens(data, offsets, size)
            slots = Slots(docs)
            for k in range(HASHES):
                hashes = w.mix(tokens ^ _seed(k))
                at, left, right = compact_windows(slots, hashes, width)
                columns = [_keys(hashes[at], k), ids[begin + docs[at]], pack_windows(place[at], left, right, width)]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["key", "doc_id", "place"])


def _held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows in the order of their keys, those whose key at least two documents hold.

    Kept back from batch to batch are only rows of one key and one document.
    """
    back, shared = None, None
    for batch in batches:
        batch = batch if back is None else pa.concat_batches([back, batch])
        back = None
        if not batch.num_rows:
            continue
        keys, docs = (batch.column(n).to_numpy() for n in ("key", "doc_id"))
        begin = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        two = np.minimum.reduceat(docs, begin) < np.maximum.reduceat(docs, begin)
        two[0] |= shared is not None and keys[0] == shared
        shared = keys[-1] if two[-1] else None
        if shared is None:
            back = batch.slice(begin[-1])
        yield batch.filter(pa.array(np.repeat(two, np.diff(np.append(begin, len(keys))))))


def joined_windows(
    docs: np.ndarray, keys: np.ndarray, left: np.ndarray, centre: np.ndarray, right: np.ndarray, width: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Interval join of windows of different functions in a document: document, signature, first and last start of the
    ranges of `width` tokens that lie in both windows."""
    reach = int(right.max(initial=0)) + 2
    shift = docs.astype(np.int64) * reach
    kind = keys & 7
    found = []
    by = [np.flatnonzero(kind == k) for k in range(HASHES)]
    by = [x[np.argsort(shift[x] + centre[x], kind="stable")] for x in by]
    for i, j in combinations(range(HASHES), 2):
        a, b = by[i], by[j]
        if not len(a) or not len(b):
            continue
        places = shift[b] + centre[b]
        # both centres lie in a range of `width` tokens
        lo = np.searchsorted(places, shift[a] + np.maximum(left[a], centre[a] - width + 1))
        hi = np.searchsorted(places, shift[a] + np.minimum(right[a], centre[a] + width - 1), side="right")
        count = hi - lo
        x = np.repeat(a, count)
        y = b[np.arange(len(x)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(lo, count)]
        first = np.maximum(np.maximum(left[x], left[y]), np.maximum(centre[x], centre[y]) - width + 1)
        last = np.minimum(np.minimum(centre[x], centre[y]), np.minimum(right[x], right[y]) - width + 1)
        ok = first <= last
        x, y = x[ok], y[ok]
        sig = w.mix(keys[x].view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + w.mix(keys[y].view(np.uint64)))
        found.append((docs[x], w.signed(sig), first[ok], last[ok]))
    if not found:
        return (np.empty(0, np.int64),) * 4
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def _pair_batch(docs: np.ndarray, sig: np.ndarray, first: np.ndarray, last: np.ndarray) -> pa.RecordBatch:
    columns = [sig.astype(np.int64), docs.astype(np.int64), first.astype(np.int32), last.astype(np.int32)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["sig", "doc_id", "first", "last"])


def _runs(sizes: np.ndarray, limit: int = 1 << 15) -> Iterator[tuple[int, int]]:
    """Cut rows into runs of about `limit` in size, one row at least."""
    sums, first = np.cumsum(sizes), 0
    while first < len(sizes):
        before = sums[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(sums, before + limit, side="right")))
        yield first, last
        first = last


def _signatures(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """Interval joins inside each document of rows (doc_id, windows)."""
    for batch in batches:
        for a, z in _runs(batch.column("windows").value_lengths().to_numpy()):
            part = batch.slice(a, z - a)
            ids, lists = part.column("doc_id").to_numpy(), part.column("windows")
            docs = np.repeat(np.arange(len(ids)), lists.value_lengths().to_numpy())
            fields = lists.flatten()
            own, sig, first, last = joined_windows(docs, fields.field("key").to_numpy(), *unpack_windows(fields.field("place").to_numpy(), width), width)
            yield _pair_batch(ids[own], sig, first, last)


class Places:
    """The distinct tokens of a text in order, and where each occurs: made once for all texts that are compared with it."""

    def __init__(self, tokens: np.ndarray):
        self.order = np.argsort(tokens)
        ranked = tokens[self.order]
        self.first = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1])[:len(ranked)])
        self.counts = np.diff(np.append(self.first, len(ranked)))
        self.names = ranked[self.first]


def _sums(flags: np.ndarray) -> np.ndarray:
    """Number of flags before each place and before the end."""
    out = np.zeros(len(flags) + 1, np.int32)
    np.cumsum(flags, out=out[1:])
    return out


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows in the order of signature, document and place, those of other documents than the group's first, with the first
    document and the block of its first place."""
    sig, head = None, (0, 0)
    for batch in batches:
        if not batch.num_rows:
            continue
        sigs, docs, first = (batch.column(n).to_numpy() for n in ("sig", "doc_id", "first"))
        new = np.append(True, sigs[1:] != sigs[:-1])
        begin, group = np.flatnonzero(new), np.cumsum(new) - 1
        source, place = docs[begin], first[begin].astype(np.int64)
        if sig is not None and sigs[0] == sig:
            source[0], place[0] = head
        sig, head = sigs[-1], (source[-1], place[-1])
        other = docs != source[group]
        columns = [*batch.filter(pa.array(other)).columns, pa.array(source[group[other]]), pa.array((place[group[other]] // BLOCK).astype(np.int32))]
        yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "source", "source_block"])


def aligned_hits(tokens: np.ndarray, other: np.ndarray | Places, width: int, hits_needed: int) -> tuple[np.ndarray, np.ndarray]:
    """First tokens of ranges of `width` that agree with one place of `other`, and the tokens that agree there.

    A token at i agrees with an equal one at j; j - i says how far they are apart.  Of a range enough tokens must agree at
    distances that differ by less than a quarter of the width, so the agreeing tokens of `other` lie in one range too, as
    long as that or a quarter longer, in about the same order.
    """
    other = other if isinstance(other, Places) else Places(other)
    n = len(tokens)
    good, agreeing = np.zeros(n, bool), np.zeros(n, bool)
    if n < width or not len(other.names):
        return np.flatnonzero(good), agreeing
    at = other.names.searchsorted(tokens)
    at[at == len(other.names)] = 0
    met = np.flatnonzero(other.names[at] == tokens)
    if len(met) < hits_needed:
        return np.flatnonzero(good), agreeing
    found = np.zeros(n, bool)
    found[met] = True
    sums = _sums(found)
    if not (sums[width:] - sums[:-width] >= hits_needed).any():
        return np.flatnonzero(good), agreeing
    at = at[met]
    counts, first = other.counts[at], other.first[at]
    own = met
    if counts.max() > 1:
        own = np.repeat(met, counts)
        first = np.repeat(first - np.cumsum(counts) + counts, counts) + np.arange(len(own))
    step = max(1, width // 8)
    band = (other.order[first] - own) // step
    by_band = np.argsort(band)
    own, band = own[by_band], band[by_band]
    new = np.append(True, band[1:] != band[:-1])
    names, index = band[new], np.cumsum(new) - 1
    # all bands at once: group k is band k with the one after it, if that is a neighbour
    follows = np.append(False, names[1:] == names[:-1] + 1)
    sizes = np.bincount(index)
    enough = sizes + np.append(sizes[1:] * follows[1:], 0) >= hits_needed
    first, second = enough[index], (follows & np.append(False, enough[:-1]))[index]
    keys = np.sort(np.concatenate([index[first] * n + own[first], (index[second] - 1) * n + own[second]]))
    keys = keys[np.append(True, keys[1:] != keys[:-1])[:len(keys)]]
    if len(keys) < hits_needed:
        return np.flatnonzero(good), agreeing
    group, hit = np.divmod(keys, n)
    # enough hits in a row that lie within `width` tokens: the ranges that hold them start from low to high
    tight = np.flatnonzero((keys[hits_needed - 1:] - keys[:len(keys) - hits_needed + 1] < width) & (group[hits_needed - 1:] == group[:len(keys) - hits_needed + 1]))
    if not len(tight):
        return np.flatnonzero(good), agreeing
    of, low, high = group[tight], np.maximum(hit[tight + hits_needed - 1] - width + 1, 0), np.minimum(hit[tight], n - width)
    new = np.append(True, (of[1:] != of[:-1]) | (low[1:] > high[:-1] + 1))
    low, high, of = low[new], high[np.append(new[1:], True)], of[new]
    counts = high - low + 1
    starts = np.arange(counts.sum()) + np.repeat(low - np.cumsum(counts) + counts, counts)
    # the first group in which a range fits; a hit agrees if its own group or one before has a range around it
    earliest = np.full(n + width - 1, len(names))
    earliest[starts[::-1] + width - 1] = np.repeat(of, counts)[::-1]
    fits = np.zeros(len(names), bool)
    fits[of] = True
    agreeing[hit[fits[group] & (window_minima(earliest, width)[hit] <= group)]] = True
    return np.flatnonzero(earliest[width - 1:] < len(names)), agreeing


def passages(tokens: np.ndarray, other: np.ndarray | Places, width: int, hits_needed: int) -> list[tuple[int, int, int, int]]:
    """Unions of ranges of `width` tokens that agree with a range of `other`: interval [a, b) of `tokens`, ends trimmed, and the
    first and last start of its ranges."""
    good, hit = aligned_hits(tokens, other, width, hits_needed)
    if not len(good):
        return []
    cut = np.flatnonzero(np.diff(good) > width) + 1
    found = []
    for part in np.split(good, cut):
        on = part[0] + np.flatnonzero(hit[part[0]:part[-1] + width])
        found.append((int(on[0]), int(on[-1]) + 1, int(part[0]), int(part[-1])))
    return found


def _blocks(batches: Iterator[pa.RecordBatch], size: int, width: int) -> Iterator[pa.RecordBatch]:
    """Overlapping blocks of each text: doc_id, block, index of its first word, its text."""
    for batch in batches:
        rows, held = [], 0
        for doc_id, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            raw = (value or "").encode()
            _docs, starts, ends = w.segments(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), w.NOT_SPACE.view(np.uint8))
            for block in range(max(1, -(-(len(starts) - size + 1) // BLOCK))):
                a, z = max(0, block * BLOCK - width), min(len(starts), (block + 1) * BLOCK + 2 * width + size)
                if a < z:
                    rows.append((doc_id, block, a, raw[starts[a]:ends[z - 1]].decode()))
                    held += ends[z - 1] - starts[a]
                if held > BATCH_BYTES:
                    yield _rows(rows)
                    rows, held = [], 0
        yield _rows(rows)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 4
    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["doc_id", "block", "at", "text"])


def _texts_tokens(column: pa.Array, size: int) -> list[np.ndarray]:
    out = []
    for begin, end, data, offsets in w.chunks(column):
        docs, _place, tokens = _tokens(data, offsets, size)
        out += np.split(tokens, np.searchsorted(docs, np.arange(1, end - begin)))
    return out


def _verify(batches: Iterator[pa.RecordBatch], size: int, width: int, hits_needed: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for a in range(0, batch.num_rows, 128):
            part = batch.slice(a, 128)
            names = (part.column(n).to_pylist() for n in ("doc_id", "at", "source"))
            # a text that meets many others is hashed and sorted once
            texts = pa.chunked_array([part.column("text"), part.column("source_text")]).combine_chunks().dictionary_encode()
            tokens, index = _texts_tokens(texts.dictionary, size), texts.indices.to_pylist()
            places = {k: Places(tokens[k]) for k in set(index[part.num_rows:])}
            for doc, at, source, i, j in zip(*names, index[:part.num_rows], index[part.num_rows:], strict=True):
                x, y = tokens[i], places[j]
                found = passages(x, y, width, hits_needed)
                rows += [(doc, at + b, at + e + size - 1, source, at + first, at + last) for b, e, first, last in found]
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 6
        names = ["doc_id", "start_word", "end_word", "source", "lo", "hi"]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)


def _open_texts(batch: pa.RecordBatch, size: int, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Tokens of all rows, the row and the place in it of each, and whether an open range starts there."""
    tokens = _texts_tokens(batch.column("text"), size)
    counts = np.array([len(t) for t in tokens])
    begin = np.cumsum(counts) - counts
    flags = np.zeros(int(counts.sum()), bool)
    for i, (opened, known) in enumerate(zip(batch.column("open").to_pylist(), batch.column("known").to_pylist(), strict=True)):
        for r in opened:
            flags[begin[i] + r["first"]:begin[i] + r["last"] + 1] = True
        for r in known or []:
            flags[begin[i] + r["lo"]:begin[i] + r["hi"] + 1] = False
    rows = np.repeat(np.arange(len(tokens)), counts)
    place = np.arange(len(flags)) - begin[rows]
    return np.concatenate([*tokens, np.empty(0, np.uint64)]), rows, place, flags & (place + width <= counts[rows])


def _near(flags: np.ndarray, width: int) -> np.ndarray:
    """Tokens that are in a range that starts at a flag."""
    sums = _sums(flags)
    out = sums[1:] > 0
    out[width:] = sums[width + 1:] > sums[1:-width]
    return out


def _open_shingles(batches: Iterator[pa.RecordBatch], size: int, width: int) -> Iterator[pa.RecordBatch]:
    """The distinct shingles of each document's open ranges."""
    for batch in batches:
        for a in range(0, batch.num_rows, 128):
            part = batch.slice(a, 128)
            tokens, rows, _place, flags = _open_texts(part, size, width)
            near = _near(flags, width)
            tokens, rows = tokens[near], rows[near]
            order = np.lexsort((tokens, rows))
            tokens, rows = tokens[order], rows[order]
            new = np.append(True, (tokens[1:] != tokens[:-1]) | (rows[1:] != rows[:-1]))[:len(tokens)]
            columns = [w.signed(tokens[new]), part.column("doc_id").to_numpy()[rows[new]]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["key", "doc_id"])


def _rare_signatures(batches: Iterator[pa.RecordBatch], size: int, width: int, hits_needed: int) -> Iterator[pa.RecordBatch]:
    """Signatures of the open ranges with enough shared shingles, rare shingles before common ones."""
    for batch in batches:
        for a in range(0, batch.num_rows, 128):
            part = batch.slice(a, 128)
            tokens, rows, place, flags = _open_texts(part, size, width)
            shared = part.column("shared").flatten()
            keys, first = np.unique(shared.field("key").to_numpy().view(np.uint64), return_index=True)
            n = shared.field("n").to_numpy()[first]
            at = np.minimum(np.searchsorted(keys, tokens), len(keys) - 1)
            times = np.where(keys[at] == tokens, n[at], 1)
            sums = np.append(0, np.cumsum(times > 1))
            ends = np.minimum(np.arange(len(tokens)) + width, len(tokens))
            flags &= sums[ends] - sums[:-1] >= hits_needed
            # only what lies in open ranges is hashed
            near = _near(flags, width)
            if not near.any():
                continue
            tier = np.floor(np.log2(times)).astype(np.uint64)
            cut = np.append(True, ~near[:-1] | (rows[1:] != rows[:-1])) & near
            stretch, own = np.cumsum(cut)[near], np.flatnonzero(near)
            windows, slots = [], Slots(stretch)
            for k in range(HASHES):
                mixed = w.mix(tokens[own] ^ _seed(k))
                hashes = np.where(times[own] > 1, (mixed >> np.uint64(6)) | (tier[own] << np.uint64(58)), NONE)
                c, left, right = compact_windows(slots, hashes, width)
                windows.append((_keys(mixed[c], k), own[c] - left, own[c], own[c] + right))
            key, left, c, right = (np.concatenate(x) for x in zip(*windows, strict=True))
            _docs, sig, lo, hi = joined_windows(np.zeros(len(key), np.int64), key, left, c, right, width)
            count = np.append(0, np.cumsum(flags))
            used = count[hi + 1] > count[lo]
            lo, hi = lo[used], hi[used]
            yield _pair_batch(part.column("doc_id").to_numpy()[rows[lo]], sig[used], place[lo], place[hi])


def _still_open(entries: DataFrame, spans: DataFrame, used: list[DataFrame]) -> DataFrame:
    """Entries of which no passage holds all ranges, in groups where two documents have such; adds the table it reads to `used`."""
    known = spans.groupBy("doc_id").agg(F.collect_set(F.struct("lo", "hi")).alias("known"))
    closed = F.exists("known", lambda s: (s["lo"] <= F.col("first")) & (s["hi"] >= F.col("last")))
    left = entries.join(known, "doc_id", "left").filter(~F.coalesce(closed, F.lit(False)))
    left = stored(left.select("sig", "doc_id", "first", "last"))
    used.append(left)
    doubt = left.groupBy("sig").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).filter("a < b").select("sig")
    return left.join(doubt, "sig")


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The last column, a text, as its number of words."""
    for batch in batches:
        counts = [np.empty(0, np.int64)]
        for begin, end, data, offsets in w.chunks(batch.column("text")):
            docs, _starts, _ends = w.segments(data, offsets, w.NOT_SPACE.view(np.uint8))
            counts.append(w.word_counts(docs, end - begin))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(np.concatenate(counts).astype(np.int64))], ["doc_id", "source", "n"])


def _copies(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, print, source): documents whose text a document of smaller id has too."""
    prints = stored(docs.select("doc_id", "print").filter("print is not null"))
    firsts = prints.groupBy("print").agg(F.min("doc_id").alias("source"), F.max("doc_id").alias("b")).filter("source < b").select("print", "source")
    out = stored(prints.join(firsts, "print").filter("doc_id <> source").distinct())
    drop_stored(prints)
    return out


def repeated_passages(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 50, percent: int = 80, size: int = SHINGLE
) -> DataFrame:
    """Passages of at least `min_words` words that occur in a document of smaller id: doc_id, start_word, end_word
    (exclusive), n_words, source_doc_id.  Overlapping passages of a document are one row with the smallest source.

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased, numbered from 0.  Ranges match at a shingle Jaccard similarity
    of `percent`: of two ranges of one length that is 2j / (1 + j) of the shingles of either.  Verbatim passages share all
    their hashes; of passages at the bound, 50 words with one edited, 0.99 are expected and tests ask for 0.95, also
    behind openings that other documents hold.  Texts that are null, empty or shorter have no passages; neither has the
    document of smallest id that holds a passage, nor repeats inside one document or among rows of one id.  Rows with a
    null id are left out.  Other columns are ignored.  An empty table has no passages.
    """
    spark = documents.sparkSession
    width = min_words - size + 1
    hits_needed = -(-2 * percent * width // (100 + percent))
    docs = numbered(documents, id_col, text_col).filter("doc_id is not null").withColumn("print", F.md5(F.col("text").cast("binary")))
    copies = _copies(docs)
    unique = docs.join(broadcast_if_small(copies.select("doc_id", "print")), ["doc_id", "print"], "left_anti").select("doc_id", "text")

    def compared(pairs: DataFrame) -> DataFrame:
        both_sides = F.array(F.struct("doc_id", "block"), F.struct(F.col("source").alias("doc_id"), F.col("source_block").alias("block")))
        wanted = stored(pairs.select(F.explode(both_sides).alias("x")).select("x.*").distinct())
        texts = unique.join(broadcast_if_small(wanted.select("doc_id").distinct()), "doc_id", "left_semi")
        blocks = texts.mapInArrow(lambda it: _blocks(it, size, width), "doc_id long, block int, at long, text string")
        blocks = blocks.join(wanted, ["doc_id", "block"], "left_semi")
        # both sides take the same columns, so that Spark makes and shuffles the blocks once
        both = pairs.alias("p").join(blocks.alias("x"), F.expr("p.doc_id = x.doc_id and p.block = x.block"))
        both = both.join(blocks.alias("y"), F.expr("p.source = y.doc_id and p.source_block = y.block"))
        both = both.select("p.doc_id", "x.at", "p.source", "x.text", F.col("y.text").alias("source_text"), F.col("y.at").alias("source_at"))
        out = stored(both.mapInArrow(lambda it: _verify(it, size, width, hits_needed), SPAN))
        drop_stored(wanted)
        free_shuffles(spark)
        return out

    def block(column: str) -> Column:
        return F.expr(f"cast({column} div {BLOCK} as int)")

    # one shuffle by key serves both to find the keys that two documents hold and to keep their windows
    entries = unique.mapInArrow(lambda it: _entries(it, size, width), ENTRY)
    held = stored(entries.repartition("key").sortWithinPartitions("key").mapInArrow(_held, ENTRY))
    free_shuffles(spark)
    windows = held.groupBy("doc_id").agg(F.collect_list(F.struct("key", "place")).alias("windows"))
    sigs = windows.mapInArrow(lambda it: _signatures(it, width), PAIR).repartition("sig").sortWithinPartitions("sig", "doc_id", "first")
    met = stored(sigs.mapInArrow(_met, f"{PAIR}, source long, source_block int"))
    drop_stored(held)
    free_shuffles(spark)
    pairs = stored(met.select("doc_id", block("first").alias("block"), "source", "source_block").distinct())
    spans = compared(pairs)
    used = [copies, pairs, spans]

    left = stored(_still_open(met, spans, used))
    drop_stored(met)
    closed = spans.groupBy("doc_id").agg(F.collect_set(F.struct("lo", "hi")).alias("known"))
    opened = stored(left.groupBy("doc_id").agg(F.collect_set(F.struct("first", "last")).alias("open")).join(closed, "doc_id", "left"))
    texts = unique.join(broadcast_if_small(opened), "doc_id").select("doc_id", "text", "open", "known")
    own = stored(texts.mapInArrow(lambda it: _open_shingles(it, size, width), "key long, doc_id long"))
    common = own.groupBy("key").agg(F.count_distinct("doc_id").alias("n")).filter("n > 1")
    shared = own.join(common, "key").groupBy("doc_id").agg(F.collect_list(F.struct("key", "n")).alias("shared"))
    rare = texts.join(shared, "doc_id").mapInArrow(lambda it: _rare_signatures(it, size, width, hits_needed), PAIR)
    open_entries, leaders = stored(_still_open(rare, spans, used)), LEADERS
    drop_stored(left, own, opened)
    while not open_entries.isEmpty():
        members = open_entries.groupBy("sig", "doc_id").agg(F.min("first").alias("first"))
        rank = F.row_number().over(Window.partitionBy("sig").orderBy("doc_id"))
        heads = members.withColumn("rank", rank).filter(F.col("rank") <= leaders)
        heads = heads.select("sig", F.col("doc_id").alias("source"), block("first").alias("source_block"))
        fresh = open_entries.join(heads, "sig").filter("source < doc_id").select("doc_id", block("first").alias("block"), "source", "source_block").distinct()
        fresh = stored(fresh.join(pairs, ["doc_id", "block", "source", "source_block"], "left_anti"))
        rest = open_entries.join(heads.select("sig", F.col("source").alias("doc_id")), ["sig", "doc_id"], "left_anti")
        if not fresh.isEmpty():
            more = compared(fresh)
            pairs, spans = pairs.unionByName(fresh), spans.unionByName(more)
            used += [fresh, more]
            rest = _still_open(rest, more, used)
        before, open_entries, leaders = open_entries, stored(rest), LEADERS * leaders
        drop_stored(before)
    drop_stored(open_entries)
    # counted behind a pass that no filter is pushed through: only copies are counted, and once
    whole = docs.join(broadcast_if_small(copies), ["doc_id", "print"]).select("doc_id", "source", "text").mapInArrow(_word_counts, "doc_id long, source long, n long")
    whole = whole.filter(F.col("n") >= min_words).select("doc_id", F.lit(0).cast("long").alias("start_word"), F.col("n").alias("end_word"), "source")
    found = _merged(spans.select("doc_id", "start_word", "end_word", "source").unionByName(whole))
    result = stored(found.select("doc_id", "start_word", "end_word", (F.col("end_word") - F.col("start_word")).alias("n_words"), F.col("source").alias("source_doc_id")))
    drop_stored(*used)
    return result


def _merged(spans: DataFrame) -> DataFrame:
    """Unions of overlapping or touching spans of each document."""
    order = Window.partitionBy("doc_id").orderBy("start_word", "end_word", "source")
    reach = F.max("end_word").over(order.rowsBetween(Window.unboundedPreceding, -1))
    begun = spans.withColumn("new", F.when(reach >= F.col("start_word"), 0).otherwise(1))
    part = begun.withColumn("part", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return part.groupBy("doc_id", "part").agg(F.min("start_word").alias("start_word"), F.max("end_word").alias("end_word"), F.min("source").alias("source"))


def _cut(batches: Iterator[pa.RecordBatch], text_col: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        k = batch.schema.get_field_index(text_col)
        out = batch.column(k).to_pylist()
        spans = batch.column("_spans").to_pylist()
        for i, own in enumerate(spans):
            if own and out[i]:
                raw = out[i].encode()
                _docs, starts, ends = w.segments(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), w.NOT_SPACE.view(np.uint8))
                kept, at = [], 0
                for s in sorted(own, key=lambda s: s["start_word"]):
                    if s["start_word"] < len(starts):
                        kept.append(raw[at:starts[s["start_word"]]])
                        at = int(ends[min(s["end_word"], len(ends)) - 1])
                out[i] = b"".join([*kept, raw[at:]]).decode()
        yield batch.set_column(k, text_col, pa.array(out, batch.schema.field(k).type)).drop_columns(["_spans"])


def cut_passages(documents: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`documents` with the passages of `found` taken out of their texts; all columns and rows stay."""
    spans = found.groupBy(F.col("doc_id").alias("_id")).agg(F.collect_list(F.struct("start_word", "end_word")).alias("_spans"))
    joined = documents.join(broadcast_if_small(spans), documents[id_col].cast("long") == F.col("_id"), "left").select(documents["*"], "_spans")
    return joined.mapInArrow(lambda it: _cut(it, text_col), documents.schema)
