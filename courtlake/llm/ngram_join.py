"""Set-similarity self-join of documents on word n-grams: a grouped prefix join with exact verification.

A document is the set of its distinct word n-grams.  Two documents link when their Jaccard similarity reaches a
threshold.  All sets are ordered by one total order (frequent n-grams last, then by hash); similar sets must then share
an n-gram among their first ``n - ceil(t * n) + 1``, their prefix.

1. One pass hashes every text and keeps, per document, the set's size, a fingerprint and a probe: the smallest hashes.
2. Equal sets become one class.  N-grams of more than `hot` classes move to the end of the order, by their counts, and
   the prefixes are taken in that order.  N-grams of a single class are left out, as nobody shares them.
3. Classes of equal size and prefix become one group.  Only groups are indexed.
4. Groups that share a prefix n-gram are candidates if size and position bounds allow it.  The first round pairs each
   group of a posting list with its first and its previous group only.  First is the group with the fewest n-grams of its
   own before the shared one: of a family of edited copies the one nearest to all.  That joins large families without all their pairs.  The second round takes every pair of classes that are not yet connected.
5. Both rounds expand groups to their classes and verify classes on the whole sets of n-grams.

Every link between classes of different components is found, so components are exact (64-bit hashes stand for n-grams).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from courtlake.llm import words as w
from courtlake.llm.common import broadcast_if_small, drop_stored, numbered, stored
from courtlake.llm.graph import components

#: Groups of a posting list beyond which its n-gram counts as frequent.  It orders work and never drops any.
HOT = 32


def document_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram hashes (signed) of each document of a chunk, ascending in a document: document index, hash."""
    n_docs = len(offsets) - 1
    docs, words = w.hashed_words(data, offsets, lower=True)
    at, grams = w.shingles(docs, words, size)
    short, whole = w.short_shingles(docs, words, size, n_docs)
    docs = np.concatenate([docs[at], short])
    grams = w.signed(np.concatenate([grams, whole]))
    order = np.lexsort((grams, docs))
    docs, grams = docs[order], grams[order]
    first = np.ones(len(docs), bool)
    first[1:] = (docs[1:] != docs[:-1]) | (grams[1:] != grams[:-1])
    return docs[first], grams[first]


def _prefix_sizes(n: np.ndarray, percent: int) -> np.ndarray:
    return np.where(n > 0, n - (n * percent + 99) // 100 + 1, 0)


def _probe_sizes(n: np.ndarray, percent: int) -> np.ndarray:
    p = _prefix_sizes(n, percent)
    return np.minimum(n, p + p // 4 + 4 * (p > 0))


def _sets(batches: Iterator[pa.RecordBatch], size: int, percent: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0)
        for first, last, data, offsets in w.chunks(batch.column(1)):
            docs, grams = document_sets(data, offsets, size)
            n = np.bincount(docs, minlength=last - first)
            begin = np.cumsum(n) - n
            sums = np.zeros((2, len(grams) + 1), np.uint64)
            np.cumsum(w.mix(grams.view(np.uint64)), out=sums[0, 1:])
            np.cumsum(w.mix(grams.view(np.uint64) ^ np.uint64(0x5851F42D4C957F2D)), out=sums[1, 1:])
            prints = sums[:, begin + n] - sums[:, begin]
            take = _probe_sizes(n, percent)
            ends = np.cumsum(take)
            index = np.arange(ends[-1]) - np.repeat(ends - take, take) + np.repeat(begin, take)
            probe = pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), pa.array(grams[index]))
            yield pa.RecordBatch.from_arrays(
                [ids.slice(first, last - first), pa.array(n.astype(np.int32)), pa.array(w.signed(prints[0])), pa.array(w.signed(prints[1])), probe],
                ["doc_id", "n", "print_a", "print_b", "probe"],
            )


def _all_grams(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        for first, _last, data, offsets in w.chunks(batch.column(1)):
            docs, grams = document_sets(data, offsets, size)
            yield pa.RecordBatch.from_arrays([pa.array(ids[first + docs]), pa.array(grams)], ["rep", "gram"])


def _verify(batches: Iterator[pa.RecordBatch], size: int, percent: int) -> Iterator[pa.RecordBatch]:
    """Keep the pairs whose sets are similar enough; the sets come from the whole texts of both documents."""
    for batch in batches:
        keep = np.zeros(batch.num_rows, bool)
        for a in range(0, batch.num_rows, 256):
            part = batch.slice(a, 256)
            sets = []
            for name in ("text_u", "text_v"):
                column, own = part.column(name), []
                for first, last, data, offsets in w.chunks(column):
                    docs, grams = document_sets(data, offsets, size)
                    cuts = np.searchsorted(docs, np.arange(1, last - first))
                    own += np.split(grams, cuts)
                sets.append(own)
            for i, (x, y) in enumerate(zip(*sets, strict=True)):
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep[a + i] = both > 0 and 100 * both >= percent * (len(x) + len(y) - both)
        chosen = batch.filter(pa.array(keep))
        yield pa.RecordBatch.from_arrays([chosen.column("u"), chosen.column("v")], ["u", "v"])


def _verified(pairs: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Links among candidate pairs (u, v) of document ids."""
    pairs = stored(pairs.distinct())
    wanted = pairs.select(F.explode(F.array("u", "v")).alias("doc_id")).distinct()
    texts = docs.join(broadcast_if_small(wanted), "doc_id", "left_semi")
    # both sides take the same columns, so that Spark shuffles the texts once
    both = pairs.alias("p").join(texts.alias("x"), F.expr("p.u = x.doc_id")).join(texts.alias("y"), F.expr("p.v = y.doc_id"))
    both = both.select("p.u", "p.v", F.col("x.text").alias("text_u"), F.col("y.text").alias("text_v"))
    links = stored(both.mapInArrow(lambda it: _verify(it, size, percent), "u long, v long"))
    drop_stored(pairs)
    return links


def _prefix_index(classes: DataFrame, docs: DataFrame, size: int, percent: int, hot: int) -> DataFrame:
    """Entries (gram, rank, n, rep) of every class's prefix, without n-grams that only one class has in its probe.

    The order of n-grams is: rare ones by hash, then frequent ones by count and hash.  Frequent are those in the probes of
    more than `hot` classes, and those in the whole sets of more than `hot` classes that need whole sets.  A class needs
    its whole set if its probe has too few rare n-grams; this can make more n-grams frequent, so both grow until no class is added.
    """
    entries = classes.select("rep", "n", F.posexplode("probe").alias("rank", "gram"))
    counted = stored(entries.groupBy("gram").agg(F.count(F.lit(1)).alias("lists")).filter("lists > 1"))
    prefix = F.expr(f"n - (n * {percent} + 99) div 100 + 1")
    probed = F.least(F.col("n"), prefix + F.floor(prefix / 4) + 4)
    late = stored(counted.filter(F.col("lists") > hot).select("gram", F.col("lists").alias("late")))
    needed, whole = 0, None
    while True:
        moved = entries.join(broadcast_if_small(late), "gram").groupBy("rep", "n").agg(F.sort_array(F.collect_list("rank")).alias("moved"))
        moved = stored(moved.select("rep", "moved", (probed - F.size("moved") < prefix).alias("short")))
        short = moved.filter("short").select(F.col("rep").alias("doc_id"))
        before, needed = needed, short.count()
        if needed == before:
            break
        if whole is not None:
            drop_stored(whole)
        whole = stored(docs.join(broadcast_if_small(short), "doc_id", "left_semi").mapInArrow(lambda it: _all_grams(it, size), "rep long, gram long").distinct())
        common = whole.groupBy("gram").agg(F.count(F.lit(1)).alias("late")).filter(F.col("late") > hot)
        old, late = late, stored(late.unionByName(common).groupBy("gram").agg(F.max("late").alias("late")))
        drop_stored(old)
        drop_stored(moved)
    known = counted.select("gram")
    index = None
    if whole is not None:
        per_doc = Window.partitionBy("rep")
        marked = whole.join(broadcast_if_small(late), "gram", "left")
        ranked = marked.select("gram", (F.row_number().over(per_doc.orderBy(F.coalesce("late", F.lit(0)), "gram")) - 1).alias("rank"), F.count(F.lit(1)).over(per_doc).cast("int").alias("n"), "rep")
        index = stored(ranked.filter(F.col("rank") < prefix))
        known = known.unionByName(index.select("gram")).distinct()
    cold = entries.join(known, "gram").join(broadcast_if_small(late.select("gram")), "gram", "left_anti").join(broadcast_if_small(moved), "rep", "left")
    rank = F.col("rank") - F.coalesce(F.size(F.filter("moved", lambda r: r < F.col("rank"))), F.lit(0))
    enough = cold.filter(~F.coalesce("short", F.lit(False))).select("gram", rank.alias("rank"), "n", "rep").filter(F.col("rank") < prefix)
    result = stored(enough if index is None else enough.unionByName(index))
    for used in (counted, late, moved, whole, index):
        if used is not None:
            drop_stored(used)
    return result


def link_components(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 4, percent: int = 85, hot: int = HOT) -> DataFrame:
    """One row per input row: doc_id, n_shingles (distinct n-grams), component_id (smallest id reachable by links).

    Words are ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased.  A text of fewer than `size` words, but some, is
    one n-gram.  Null, empty and blank texts have an empty set, no links and their own id as component.  Rows that
    repeat an id link to each other through it; a null id has a null component.  Other columns are ignored.
    """
    docs = numbered(documents, id_col, text_col)
    sets = stored(docs.mapInArrow(lambda it: _sets(it, size, percent), "doc_id long, n int, print_a long, print_b long, probe array<long>"))
    full = sets.filter("n > 0 and doc_id is not null")
    same = ["n", "print_a", "print_b"]
    classes = stored(full.groupBy(*same).agg(F.min("doc_id").alias("rep"), F.min_by("probe", "doc_id").alias("probe")))
    unique = docs.filter("doc_id is not null")
    entries = _prefix_index(classes, unique, size, percent, hot)
    prefixes = entries.groupBy("rep", "n").agg(F.sort_array(F.collect_list(F.struct("rank", "gram"))).alias("prefix"))
    keyed = stored(prefixes.select("rep", F.xxhash64("n", "prefix").alias("key")))
    members = stored(keyed.join(keyed.groupBy("key").agg(F.min("rep").alias("group")), "key").select("group", "rep"))
    index = stored(entries.join(members.filter("group = rep"), "rep").select("gram", "rank", "n", "group"))

    # round 1: first and previous group of each list, and the first class of each group
    lists = index.groupBy("gram").agg(F.min(F.struct("rank", "n", "group")).alias("head"), F.count(F.lit(1)).alias("entries")).filter("entries > 1")
    tied = index.join(lists.select("gram", "head"), "gram")
    need = lambda a, b: F.ceil((a + b) * percent / F.lit(100 + percent))

    def near(n_a, rank_a, n_b, rank_b):
        sizes = F.least(n_a, n_b) * 100 >= F.greatest(n_a, n_b) * percent
        # at the first n-gram that two sets share, what follows it bounds their overlap; similar sets pass there
        return sizes & (F.least(n_a - rank_a, n_b - rank_b) >= need(n_a, n_b))

    salted = Window.partitionBy("gram", F.pmod(F.xxhash64("group"), F.lit(16))).orderBy("rank", "n", "group")
    with_last = tied.withColumn("last", F.lag(F.struct("rank", "n", "group")).over(salted))
    one = with_last.select("n", "group", "rank", F.explode(F.array("head", "last")).alias("o")).filter("o is not null and o.group <> group")
    one = one.filter(near(F.col("n"), F.col("rank"), F.col("o.n"), F.col("o.rank")))
    pairs = one.select(F.least("group", "o.group").alias("u"), F.greatest("group", "o.group").alias("v"))
    inside = members.filter("group <> rep").select(F.col("group").alias("u"), F.col("rep").alias("v"))
    links = _verified(pairs.unionByName(inside), unique, size, percent)
    found = stored(components(links))

    # round 2: every pair of classes in different components
    labelled = members.join(found.withColumnRenamed("node", "rep"), "rep", "left").select("group", "rep", F.coalesce("component", "rep").alias("component"))
    shared = index.join(labelled, "group")
    mixed = shared.groupBy("gram").agg(F.min("component").alias("a"), F.max("component").alias("b")).filter("a < b").select("gram")
    mixed_entries = stored(shared.join(mixed, "gram"))
    x, y = mixed_entries.alias("x"), mixed_entries.alias("y")
    cross = x.join(y, (F.col("x.gram") == F.col("y.gram")) & (F.col("x.component") < F.col("y.component")) & near(F.col("x.n"), F.col("x.rank"), F.col("y.n"), F.col("y.rank")))
    pairs = cross.select(F.least("x.rep", "y.rep").alias("u"), F.greatest("x.rep", "y.rep").alias("v"))
    split = labelled.groupBy("group").agg(F.min("component").alias("a"), F.max("component").alias("b")).filter("a < b").select("group")
    labelled = labelled.join(split, "group")
    within = labelled.alias("x").join(labelled.alias("y"), (F.col("x.group") == F.col("y.group")) & (F.col("x.component") < F.col("y.component")))
    pairs = pairs.unionByName(within.select(F.least("x.rep", "y.rep").alias("u"), F.greatest("x.rep", "y.rep").alias("v")))
    links = links.unionByName(_verified(pairs, unique, size, percent))

    joined = components(links)
    labels = stored(classes.select(*same, "rep").join(joined.withColumnRenamed("node", "rep"), "rep", "left").select(*same, F.coalesce("component", "rep").alias("component")))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    result = stored(sets.select("doc_id", *same).join(labels, same, "left").select("doc_id", F.col("n").cast("long").alias("n_shingles"), component.alias("component_id")))
    for used in (sets, classes, labels, keyed, entries, index, members, found, mixed_entries):
        drop_stored(used)
    return result
