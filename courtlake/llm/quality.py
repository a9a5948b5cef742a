"""Quality rules: counts of every text, and a hashed n-gram log-likelihood ratio of trusted and raw text.

Words and runs of signs are the tokens; tokens and pairs of neighbours are hashed into buckets.  Two multinomials over the
buckets, one of the trusted documents and one of all, give each document the mean log ratio of its n-grams.  Every
document is kept or not by one threshold: no sampling.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtlake.llm import words as w
from courtlake.llm.common import broadcast_if_small, numbered

BUCKET_BITS = 16
#: Counts added to each bucket of both multinomials.
SMOOTHING = 1.0
#: Mean log-likelihood ratio from which a document is kept.
THRESHOLD = -0.35
_SYMBOL = np.zeros(256, np.int64)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = 1
_KIND = np.full(256, 2, np.uint8)
_KIND[[9, 10, 11, 12, 13, 32]] = 0
_KIND[[*range(48, 58), *range(65, 91), 95, *range(97, 123), *range(128, 256)]] = 1
_NOT_NEWLINE = np.ones(256, np.uint8)
_NOT_NEWLINE[10] = 0


@dataclass(frozen=True)
class Ratio:
    """log p_trusted - log p_raw of every bucket."""

    weights: np.ndarray


def _per_doc(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.append(0, np.cumsum(values))
    return sums[offsets[1:]] - sums[offsets[:-1]]


def _equal_earlier(key: np.ndarray) -> np.ndarray:
    """For each item, whether an equal item stands before it."""
    order = np.argsort(key, kind="stable")
    again = np.zeros(len(key), bool)
    again[order[1:]] = key[order[1:]] == key[order[:-1]]
    return again


def base_counts(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of each document of a chunk."""
    n = len(offsets) - 1
    lead = (data & 0xC0) != 0x80
    docs, starts, ends = w.segments(data, offsets, w.NOT_SPACE.view(np.uint8))
    hashes = w.span_hashes(data, starts, ends, False)
    out = {"n_words": np.bincount(docs, minlength=n), "word_chars": _per_doc(lead & w.NOT_SPACE[data], offsets), "n_symbols": _per_doc(_SYMBOL[data], offsets)}
    own = lambda d: w.mix(d.astype(np.uint64) + np.uint64(1))
    # lines that hold a word
    line_docs, line_starts, line_ends = w.segments(data, offsets, _NOT_NEWLINE)
    filled = np.searchsorted(starts, line_ends) > np.searchsorted(ends, line_starts, side="right")
    line_docs, line_starts, line_ends = line_docs[filled], line_starts[filled], line_ends[filled]
    again = _equal_earlier(w.span_hashes(data, line_starts, line_ends, False) + own(line_docs))
    out["n_dup_lines"] = np.bincount(line_docs[again], minlength=n)
    at, grams = w.shingles(docs, hashes, 3)
    key = grams + own(docs[at])
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    twice = np.zeros(len(key), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(docs) + 2, bool)
    for k in range(3):
        covered[at[twice] + k] = True
    out["n_repeat_words"] = np.bincount(docs[covered[:len(docs)]], minlength=n)
    return out


def buckets(data: np.ndarray, offsets: np.ndarray, bits: int = BUCKET_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Document index and bucket of every token and pair of neighbouring tokens."""
    docs, starts, ends = w.segments(data, offsets, _KIND)
    tokens = w.span_hashes(data, starts, ends, True)
    at, pairs = w.shingles(docs, tokens, 2)
    return np.concatenate([docs, docs[at]]), (np.concatenate([tokens, pairs]) >> np.uint64(64 - bits)).astype(np.int64)


def _totals(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    total = np.zeros((2, 1 << bits), np.int64)
    for batch in batches:
        trusted = batch.column("trusted").to_numpy(zero_copy_only=False).astype(bool)
        for first, last, data, offsets in w.chunks(batch.column("text")):
            docs, own = buckets(data, offsets, bits)
            total[0] += np.bincount(own[trusted[first:last][docs]], minlength=1 << bits)
            total[1] += np.bincount(own, minlength=1 << bits)
    at = np.flatnonzero(total[1])
    yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[0, at]), pa.array(total[1, at])], ["bucket", "trusted", "raw"])


def fit_ratio(documents: DataFrame, trusted_ids: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = BUCKET_BITS) -> Ratio:
    """Both multinomials over all documents; `trusted_ids` has the ids of the trusted ones in its first column.

    Without trusted documents every weight is 0, so that all pass.  The counts have 2 ** bits rows whatever the input.
    """
    ids = trusted_ids.select(F.col(trusted_ids.columns[0]).cast("long").alias("doc_id")).dropna().distinct().withColumn("trusted", F.lit(True))
    marked = numbered(documents, id_col, text_col).join(broadcast_if_small(ids), "doc_id", "left").select("text", F.coalesce("trusted", F.lit(False)).alias("trusted"))
    counts = marked.mapInArrow(lambda it: _totals(it, bits), "bucket int, trusted long, raw long").groupBy("bucket").agg(F.sum("trusted").alias("trusted"), F.sum("raw").alias("raw")).toArrow()
    table = np.zeros((2, 1 << bits))
    for k, name in enumerate(("trusted", "raw")):
        table[k, counts.column("bucket").to_numpy()] = counts.column(name).to_numpy()
    if not table[0].sum():
        return Ratio(np.zeros(1 << bits))
    log = np.log((table + SMOOTHING) / (table + SMOOTHING).sum(1, keepdims=True))
    return Ratio(log[0] - log[1])


def _judge(batches: Iterator[pa.RecordBatch], ratio: Ratio, threshold: float, bits: int, least_words: int, repeat_percent: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, last, data, offsets in w.chunks(batch.column("text")):
            n = last - first
            base = base_counts(data, offsets)
            docs, own = buckets(data, offsets, bits)
            grams = np.bincount(docs, minlength=n)
            score = np.round(np.bincount(docs, ratio.weights[own], n) / np.maximum(grams, 1), 6)
            failed = (base["n_words"] < least_words) | (100 * base["n_repeat_words"] > repeat_percent * base["n_words"])
            names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(first, n), *(pa.array(base[k].astype(np.int64)) for k in names), pa.array(failed), pa.array(~failed & (score >= threshold)), pa.array(score)],
                ["doc_id", *names, "base_failed", "kept", "score"],
            )


def judge(documents: DataFrame, ratio: Ratio, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, least_words: int = 50, repeat_percent: int = 50, bits: int = BUCKET_BITS) -> DataFrame:
    """One row per row: doc_id, the base counts, base_failed, kept, score (mean log-likelihood ratio).

    Words are ``[^\\x20\\x09-\\x0D]+``.  Null and empty texts have no words and fail the base rules.  Repeated rows get
    equal answers, null ids are kept, an empty table gives no rows, other columns are ignored.
    """
    schema = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, score double"
    return numbered(documents, id_col, text_col).mapInArrow(lambda it: _judge(it, ratio, threshold, bits, least_words, repeat_percent), schema)
