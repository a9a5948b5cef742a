"""Toxicity severity by cumulative-link ordinal regression on sparse text features.

Features are hashed words and hashed word beginnings: present or not, and there more than once or not.  Counts of every feature by grade cover all labelled
distinct texts; all that tell the grades apart become the model's columns.  One weight vector is shared by all ordered
thresholds: ``P(grade > k) = sigmoid(w.x + b - theta_k)``.  It is fitted on a bounded, documented sample of labelled
texts (the smallest id hashes) and applied to every document in one pass.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtlake.llm import words as w
from courtlake.llm.common import broadcast_if_small, drop_stored, numbered, stored

HASH_BITS = 22
BEGINNINGS = (4, 5)
#: Most distinct labelled texts that the fit sees.
FIT_ROWS = 20_000
#: Documents above the lowest grade that must hold a feature.  Of m such features, one counts as telling if its
#: likelihood-ratio statistic reaches 2 ln m, so that about one of all would by chance.
LEAST_DOCUMENTS = 3
#: Bytes of text that one pass takes features from: its work arrays are larger than those of words and shingles, and a Python
#: worker keeps what they took for the operators that follow.
FEATURE_BYTES = 1 << 16
_LETTER = np.zeros(256, np.uint8)
_LETTER[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 1


@dataclass(frozen=True)
class Model:
    grades: tuple[int, ...]
    features: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray

    def above(self, score: np.ndarray) -> np.ndarray:
        """P(grade index > k), one column per threshold."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - score[:, None], -60, 60)))


def text_features(data: np.ndarray, offsets: np.ndarray, bits: int = HASH_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed features of each document of a chunk: document index, feature."""
    docs, starts, ends = w.segments(data, offsets, _LETTER)
    parts = [w.span_hashes(data, starts, ends, True)]
    lead = (data & 0xC0) != 0x80
    place = np.append(np.flatnonzero(lead), len(data))
    first = np.searchsorted(place, starts)
    owners = [docs]
    for n in BEGINNINGS:
        stop = place[np.minimum(first + n, len(place) - 1)]
        long = stop < ends
        parts.append(w.mix(w.span_hashes(data, starts[long], stop[long], True) + np.uint64(n)))
        owners.append(docs[long])
    owner, own = np.concatenate(owners).astype(np.int64), np.concatenate(parts) >> np.uint64(64 - bits)
    key, times = np.unique((owner << bits) | own.astype(np.int64), return_counts=True)
    again = key[times > 1]
    marked = w.mix((again & ((1 << bits) - 1)).astype(np.uint64) + np.uint64(1 << 40)) >> np.uint64(64 - bits)
    key = np.unique(np.concatenate([key, (again >> bits << bits) | marked.astype(np.int64)]))
    return key >> bits, key & ((1 << bits) - 1)


def _counts(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    totals: dict[int, np.ndarray] = {}
    for batch in batches:
        grades = batch.column("grade").to_numpy(zero_copy_only=False)
        for first, last, data, offsets in w.chunks(batch.column("text"), FEATURE_BYTES):
            docs, features = text_features(data, offsets, bits)
            own = grades[first:last]
            for g in np.unique(own):
                if int(g) not in totals:
                    totals[int(g)] = np.zeros(1 << bits, np.int32)  # texts of one partition
                at, n = np.unique(features[own[docs] == g], return_counts=True)
                totals[int(g)][at] += n
    for g, n in totals.items():
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(np.full(len(at), g, np.int32)), pa.array(n[at].astype(np.int64))], ["feature", "grade", "n"])


def _columns(features: np.ndarray, found: np.ndarray) -> np.ndarray:
    """Place of each found feature among the sorted features of a model, -1 where it has none."""
    at = np.minimum(np.searchsorted(features, found), len(features) - 1)
    return np.where(features[at] == found, at, -1)


def _chosen(batches: Iterator[pa.RecordBatch], features: np.ndarray, bits: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, last, data, offsets in w.chunks(batch.column("text"), FEATURE_BYTES):
            docs, own = text_features(data, offsets, bits)
            columns = _columns(features, own)
            keep = columns >= 0
            lists = np.split(columns[keep].astype(np.int32), np.searchsorted(docs[keep], np.arange(1, last - first)))
            own_rows = [batch.column(c).slice(first, last - first) for c in ("doc_id", "grade")]
            yield pa.RecordBatch.from_arrays([*own_rows, pa.array([x.tolist() for x in lists], pa.list_(pa.int32()))], ["doc_id", "grade", "columns"])


def _g2(a: Column, b: Column, n_a: int, n_b: int) -> Column:
    """Likelihood-ratio statistic of a feature that `a` of n_a and `b` of n_b documents hold."""

    def f(x):
        return F.when(x > 0, x * F.log(x)).otherwise(0.0)

    total = F.lit(float(n_a + n_b))
    a, b = a.cast("double"), b.cast("double")
    cells = f(a) + f(b) + f(n_a - a) + f(n_b - b)
    return 2 * (cells - f(a + b) - f(total - a - b) - f(F.lit(float(n_a))) - f(F.lit(float(n_b))) + f(total))


def fit_ordinal(rows: list[np.ndarray], grades: np.ndarray, n_columns: int, n_grades: int, l1: float = 2e-5, steps: int = 2000) -> tuple[np.ndarray, np.ndarray]:
    """Sparse weights and ordered thresholds of the cumulative-link model, by accelerated proximal gradient on all rows.

    At each threshold, the rows above and below it weigh the same in total.
    """
    sizes = np.array([len(r) for r in rows])
    n = len(rows)
    row = np.repeat(np.arange(n), sizes)
    column = np.concatenate([*rows, np.empty(0, np.int64)]).astype(np.int64)
    target = grades[:, None] > np.arange(n_grades - 1)[None, :]
    above = target.sum(0)
    balance = np.where(target, n / (2 * np.maximum(above, 1)), n / (2 * np.maximum(n - above, 1)))
    # power iteration for the largest curvature of the features and thresholds together
    v, u = np.ones(n_columns), 1.0
    for _ in range(30):
        x = (np.bincount(row, v[column], n) + u) * balance.max(1)
        v, u = np.bincount(column, x[row], n_columns) / n, x.mean()
        norm = float(np.sqrt((v * v).sum() + u * u))
        v, u = v / norm, u / norm
    rate = 1 / (0.25 * 1.05 * norm * (n_grades - 1))
    weights, theta = np.zeros(n_columns), np.linspace(1.0, 2.0, n_grades - 1)
    ahead_w, ahead_t, t = weights, theta, 1.0
    for _ in range(steps):
        score = np.bincount(row, ahead_w[column], n)
        error = (1 / (1 + np.exp(np.clip(ahead_t[None, :] - score[:, None], -60, 60))) - target) * balance
        new_w = ahead_w - rate * np.bincount(column, error.sum(1)[row], n_columns) / n
        new_w = np.sign(new_w) * np.maximum(np.abs(new_w) - rate * l1, 0)
        new_t = np.maximum.accumulate(ahead_t + rate * error.sum(0) / n)
        new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead_w, ahead_t = new_w + (t - 1) / new * (new_w - weights), new_t + (t - 1) / new * (new_t - theta)
        weights, theta, t = new_w, new_t, new
    return weights, theta


def _distinct_texts(documents: DataFrame, known: DataFrame) -> DataFrame:
    """Each labelled text once: doc_id (the smallest), text, grade (the highest).  Only ids and hashes are shuffled."""
    hashed = documents.withColumn("hash", F.sha2(F.coalesce("text", F.lit("")), 256))
    rows = stored(hashed.join(broadcast_if_small(known), "doc_id").select("doc_id", "hash", "grade"))
    one = stored(rows.groupBy("hash").agg(F.min("doc_id").alias("doc_id"), F.max("grade").alias("grade")))
    again = stored(rows.groupBy("doc_id", "hash").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("doc_id", "hash"))
    drop_stored(rows)
    texts = hashed.join(broadcast_if_small(one), ["doc_id", "hash"])
    if not again.isEmpty():  # rows that repeat both id and text
        repeated = broadcast_if_small(again)
        texts = texts.join(repeated, ["doc_id", "hash"], "left_anti").unionByName(texts.join(repeated, ["doc_id", "hash"], "left_semi").dropDuplicates(["doc_id", "hash"]))
    return texts.select("doc_id", "text", "grade")


def fit(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_id_col: str = "doc_id", grade_col: str = "grade", max_fit_rows: int = FIT_ROWS, bits: int = HASH_BITS) -> Model | None:
    """The model, or None if the labels hold fewer than two grades.  Null ids and grades are left out.

    Copies of one text count once, under the highest of their grades.
    """
    known = labels.select(F.col(label_id_col).cast("long").alias("doc_id"), F.col(grade_col).cast("int").alias("grade")).dropna().groupBy("doc_id").agg(F.max("grade").alias("grade"))
    texts = _distinct_texts(numbered(documents, id_col, text_col), known)
    counts = texts.mapInArrow(lambda it: _counts(it, bits), "feature int, grade int, n long").groupBy("feature", "grade").agg(F.sum("n").alias("n"))
    totals = {r.grade: r.n for r in texts.groupBy("grade").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row per grade
    grades = sorted(totals)
    if len(grades) < 2:
        return None
    low, n_low, n_high = grades[0], totals[grades[0]], sum(totals[g] for g in grades[1:])
    high_n = F.coalesce(F.sum(F.when(F.col("grade") > low, F.col("n"))), F.lit(0))
    low_n = F.coalesce(F.sum(F.when(F.col("grade") == low, F.col("n"))), F.lit(0))
    telling = counts.groupBy("feature").agg(high_n.alias("high"), low_n.alias("low")).filter((F.col("high") >= LEAST_DOCUMENTS) & (F.col("high") * n_low > F.col("low") * n_high))
    telling = stored(telling.withColumn("g2", _g2(F.col("high"), F.col("low"), n_high, n_low)))
    telling = telling.filter(F.col("g2") >= 2 * math.log(max(telling.count(), 2)))
    features = np.array([r.feature for r in telling.orderBy("feature").collect()], np.int64)
    if not len(features):
        return None
    sparse = texts.mapInArrow(lambda it: _chosen(it, features, bits), "doc_id long, grade int, columns array<int>")
    table = sparse.orderBy(F.xxhash64("doc_id"), "doc_id", "columns").limit(max_fit_rows).toArrow()
    index = {g: k for k, g in enumerate(grades)}
    rows = [np.array(x, np.int64) for x in table.column("columns").to_pylist()]
    y = np.array([index[g] for g in table.column("grade").to_pylist()])
    weights, theta = fit_ordinal(rows, y, len(features), len(grades))
    return Model(tuple(grades), features, weights, theta)


def _scores(batches: Iterator[pa.RecordBatch], model: Model | None, threshold: float, bits: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, last, data, offsets in w.chunks(batch.column("text"), FEATURE_BYTES):
            n = last - first
            if model:
                docs, features = text_features(data, offsets, bits)
                columns = _columns(model.features, features)
                held = columns >= 0
                p = model.above(np.bincount(docs[held], model.weights[columns[held]], n))
                values = np.array(model.grades, float)
                severity = values[0] + p @ np.diff(values)
                toxic_from = p[:, 0]
                grade = np.array(model.grades)[(p >= threshold).sum(1)]
            else:
                severity, toxic_from, grade = np.zeros(n), np.zeros(n), np.zeros(n)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(first, n), pa.array(grade.astype(np.int32)), pa.array(np.round(severity, 6)), pa.array(np.round(toxic_from, 6)), pa.array(toxic_from >= threshold)],
                ["doc_id", "grade", "expected_severity", "p_toxic", "toxic"],
            )


def severity(documents: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.35, bits: int = HASH_BITS) -> DataFrame:
    """One row per row: doc_id, grade, expected_severity, p_toxic (P of a grade above the lowest), toxic
    (p_toxic reaches `threshold`).

    Null and empty texts have no features and get the model's answer for none, the lowest grade in practice.  Without a
    model (no labels, one grade only, or no telling feature) every document gets grade 0.  Repeated rows get equal answers;
    null ids are kept; other columns are ignored.
    """
    return numbered(documents, id_col, text_col).mapInArrow(lambda it: _scores(it, model, threshold, bits), "doc_id long, grade int, expected_severity double, p_toxic double, toxic boolean")


def label_grades(labels: DataFrame) -> DataFrame:
    """Grades from two-valued labels: 0 not toxic, 1 toxic, 2 toxic and of low quality."""
    return labels.select("doc_id", F.when(F.col("toxic") == 0, 0).when(F.col("quality") == 0, 2).otherwise(1).alias("grade"))
