"""Ranked search of whole items over all documents: pipelined term partitioning.

Terms are dealt to a few owner stages, the rarest to the first, so that each stage owns about as many postings.  Items travel in
bundles.  A bundle is a group of items over one block of documents and carries a sparse accumulator for each item: documents and
scores so far.  At each stage the bundles meet the postings of that stage's terms by cogroup, integer contributions are added,
and the bundle goes on to the next stage.  After the last one each bundle gives its best documents, and a window over
these few makes the final selection.

Blocks hold about `block_docs` documents and `block_postings` postings at most, and a bundle `team_items` items, whatever the corpus: a
bundle's size is bounded, and the number of bundles grows with the input.
An item's accumulator drops a document only if it can't reach the block's k-th score even with all contributions that the later
stages could still add, so the result is exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from courtlake.llm import words as w
from courtlake.llm.common import broadcast_if_small, drop_stored, numbered, stored

#: Bytes of terms: digits, letters and everything outside ASCII.
TERM = np.zeros(256, np.uint8)
TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = 1
#: No occurrence adds as much as this times the term's weight.
FULL = 1_000_000


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each row: id, row, number of terms, hashes of its distinct terms, occurrences of each."""
    names = ["doc_id", "row", "n", "terms", "counts"]
    for batch in batches:
        for first, last, data, offsets in w.chunks(batch.column(2)):
            docs, starts, ends = w.segments(data, offsets, TERM)
            hashes = w.signed(w.span_hashes(data, starts, ends, lower=True))
            order = np.lexsort((hashes, docs))
            docs, hashes = docs[order], hashes[order]
            new = np.ones(len(docs), bool)
            new[1:] = (docs[1:] != docs[:-1]) | (hashes[1:] != hashes[:-1])
            at = np.flatnonzero(new)
            edges = np.append(0, np.cumsum(np.bincount(docs[at], minlength=last - first))).astype(np.int32)
            counts = np.diff(np.append(at, len(docs))).astype(np.int64)
            yield pa.RecordBatch.from_arrays([
                batch.column(0).slice(first, last - first), batch.column(1).slice(first, last - first),
                pa.array(np.bincount(docs, minlength=last - first).astype(np.int64)),
                pa.ListArray.from_arrays(edges, pa.array(hashes[at])), pa.ListArray.from_arrays(edges, pa.array(counts)),
            ], names)


def counted_terms(table: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, row, n, terms, counts): distinct terms of each row by their 64-bit hashes; `row` tells rows of one id apart."""
    rows = numbered(table, id_col, text_col).select("doc_id", F.monotonically_increasing_id().alias("row"), "text")
    return rows.mapInArrow(_counted, "doc_id long, row long, n long, terms array<long>, counts array<long>")


def _postings(counted: DataFrame) -> DataFrame:
    each = F.explode(F.arrays_zip("terms", "counts")).alias("p")
    return counted.select("doc_id", "row", "n", each).select("doc_id", "row", "n", F.col("p.terms").alias("term"), F.col("p.counts").alias("tf"))


def _held(counted: DataFrame, wanted: DataFrame) -> DataFrame:
    """Postings of wanted terms, and for each document with terms one row without a term that carries its length."""
    length = F.array(F.struct(F.lit(None).cast("long").alias("terms"), F.lit(None).cast("long").alias("counts")))
    both = counted.filter("n > 0").select("doc_id", "row", "n", F.explode(F.concat(length, F.arrays_zip("terms", "counts"))).alias("p"))
    rows = both.select("doc_id", "row", "n", F.col("p.terms").alias("term"), F.col("p.counts").alias("tf"))
    return rows.join(broadcast_if_small(wanted.withColumn("wanted", F.lit(True))), "term", "left").filter("wanted or term is null").drop("wanted")


def _stages(frequency: DataFrame, stages: int) -> dict[int, int]:
    """Stage of each class of document frequency (number of binary digits): rare ones first, postings shared out evenly."""
    classes = frequency.groupBy(F.length(F.bin("df")).alias("digits")).agg(F.sum("df").alias("n")).orderBy("digits").collect()  # 64 rows at most
    total, before, out = sum(r.n for r in classes), 0, {}
    for r in classes:
        out[r.digits] = min(stages - 1, int(stages * (before + r.n / 2) / total))
        before += r.n
    return out


def _lists(values: np.ndarray, sizes: list[int]) -> pa.Array:
    return pa.ListArray.from_arrays(np.append(0, np.cumsum(sizes)).astype(np.int32), pa.array(values))


def _advance(bundle: pa.Table, owned: pa.Table, k: int, last: bool) -> pa.Table:
    """One bundle at one stage.  bundle: a row per item with its accumulator; owned: postings and the items' terms of the stage."""
    kind = owned["item"].is_valid()
    asked, held = owned.filter(kind), owned.filter(pc.invert(kind))
    column = lambda t, name: t[name].to_numpy()
    ids, rows = column(held, "doc_id"), column(held, "row")
    terms, adds = column(held, "term"), column(held, "amount")
    order = np.argsort(terms, kind="stable")
    terms, ids, rows, adds = terms[order], ids[order], rows[order], adds[order]
    carried = {i.as_py(): (np.asarray(a.values), np.asarray(b.values), np.asarray(c.values)) for i, a, b, c in zip(*(bundle[n] for n in ("item", "ids", "rows", "scores")), strict=True)}
    items, item_terms, times, still = (column(asked, n) for n in ("item", "term", "amount", "still"))
    by_item = np.argsort(items, kind="stable")
    names, begin = np.unique(items[by_item], return_index=True)
    mine = dict(zip(names.tolist(), np.split(by_item, begin[1:]), strict=False))
    out: dict[str, list] = {"item": [], "ids": [], "rows": [], "scores": []}
    none = np.empty(0, np.int64)
    for item in sorted(carried.keys() | mine.keys()):
        own = mine.get(item, none)
        got = carried.get(item, (none, none, none))
        spans = [(a, b, t) for a, b, t in zip(np.searchsorted(terms, item_terms[own]), np.searchsorted(terms, item_terms[own], side="right"), times[own], strict=True) if b > a]
        parts = [got, *((ids[a:b], rows[a:b], adds[a:b] * t) for a, b, t in spans)]
        all_ids, all_rows, all_scores = (np.concatenate([p[i] for p in parts]) for i in range(3))
        if len(parts) > 1:
            doc, first, place = np.unique(all_rows, return_index=True, return_inverse=True)
            scores = np.zeros(len(doc), np.int64)
            np.add.at(scores, place, all_scores)
            all_ids, all_rows, all_scores = all_ids[first], doc, scores
        if len(all_scores) > k and (last or len(own)):
            rest = 0 if last else int(still[own[0]])
            kth = np.partition(all_scores, len(all_scores) - k)[len(all_scores) - k]
            keep = all_scores + rest >= kth
            all_ids, all_rows, all_scores = all_ids[keep], all_rows[keep], all_scores[keep]
        if last:
            best = np.lexsort((all_rows, all_ids, all_rows < 0, -all_scores))[:k]
            best = best[all_scores[best] > 0]
            all_ids, all_rows, all_scores = all_ids[best], all_rows[best], all_scores[best]
        out["item"].append(item)
        for n, v in zip(("ids", "rows", "scores"), (all_ids, all_rows, all_scores), strict=True):
            out[n].append(v)
    sizes = [len(v) for v in out["rows"]]
    key = (bundle if bundle.num_rows else owned).slice(0, 1)
    same = lambda n: pa.array([key[n][0].as_py()] * len(sizes), pa.int64())
    joined = {n: np.concatenate(out[n]) if sizes else none for n in ("ids", "rows", "scores")}
    return pa.table({"team": same("team"), "block": same("block"), "item": pa.array(out["item"], pa.int64()), **{n: _lists(v, sizes) for n, v in joined.items()}})


def _step(k: int, last: bool):
    return lambda bundle, owned: _advance(bundle, owned, k, last)


BUNDLE = "team long, block long, item long, ids array<long>, rows array<long>, scores array<long>"


def rank(documents: DataFrame, items: DataFrame, k: int = 20, stages: int = 4, block_docs: int = 4096, block_postings: int = 1 << 19, team_items: int = 256, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """item_id, rank (from 1), doc_id, score: the k documents of highest score of each item, equal scores by ascending id.

    Terms are runs of ASCII letters, digits and all characters outside ASCII, A-Z lower-cased, of whole texts.  With N documents
    that have a term, L terms in them, n of the document, df documents of the term and tf occurrences in the document, a term's
    weight is floor(1000 ln((2 N + 2) / (2 df + 1))), m is 75 + 25 n N div L, and an occurrence in the item adds weight times
    (10^9 tf div (1000 tf + 12 m)); all of this but the logarithm is in 64-bit integers.  Terms are compared by 64-bit hashes.

    Null and empty texts have no terms: such documents are not found and such items find none.  Rows that repeat an id are ranked
    one by one, as are items; a null doc_id comes after all others of its score, and null item_ids are kept.  Only scores above 0
    count.  Empty tables give no rows; other columns are ignored.
    """
    spark = documents.sparkSession
    asked = stored(counted_terms(items, item_col, item_text_col))
    wanted = _postings(asked).select("term").distinct()
    held = stored(_held(counted_terms(documents, id_col, text_col), wanted))
    total = held.filter("term is null").agg(F.count(F.lit(1)).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    held_terms = held.filter("term is not null")
    frequency = stored(held_terms.groupBy("term").agg(F.count(F.lit(1)).alias("df")))
    postings = frequency.agg(F.sum("df")).first()[0]
    if postings is None:
        drop_stored(asked, held, frequency)
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    stage_of = _stages(frequency, stages)
    stage = F.create_map(*(F.lit(x) for pair in stage_of.items() for x in pair))[F.length(F.bin("df"))]
    weight = F.floor(1000 * F.log((2.0 * total.docs + 2) / (2.0 * F.col("df") + 1))).cast("long")
    owners = broadcast_if_small(frequency.select("term", stage.alias("stage"), weight.alias("weight")))
    blocks, teams = max(-(-total.docs // block_docs), -(-postings // block_postings)), -(-asked.count() // team_items)

    # the items' terms with the most that later stages can add, the same for each block
    mine = _postings(asked).select(F.col("row").alias("item"), F.pmod(F.xxhash64("row"), F.lit(teams)).alias("team"), "term", F.col("tf").alias("amount")).join(owners, "term")
    most = mine.groupBy("item", "stage").agg(F.sum(F.col("amount") * F.col("weight") * FULL).alias("most"))
    later = F.sum("most").over(Window.partitionBy("item").orderBy(F.desc("stage")).rowsBetween(Window.unboundedPreceding, -1))
    still = most.select("item", "stage", F.coalesce(later, F.lit(0)).alias("still"))
    mine = stored(mine.join(still, ["item", "stage"]).select("team", "item", "term", "amount", "stage", "still"))

    # postings with their integer contributions, once for each team of items that asks for the term
    share = F.expr(f"75 + (25 * n * {total.docs}L) div {total.terms}L")
    amount = F.col("weight") * F.expr("(1000000000 * tf) div (1000 * tf + 12 * m)")
    row = F.when(F.col("doc_id").isNull(), -1 - F.col("row")).otherwise(F.col("row"))
    asking = mine.select("team", "term").distinct()
    block = F.pmod(F.xxhash64("row"), F.lit(blocks)).alias("block")
    dealt = held_terms.withColumn("m", share).join(owners, "term").join(broadcast_if_small(asking), "term")
    dealt = dealt.select("team", block, F.coalesce("doc_id", F.lit(0)).alias("doc_id"), row.alias("row"), "term", amount.alias("amount"), "stage")

    bundles = spark.createDataFrame([], BUNDLE)
    no = F.lit(None).cast("long")
    last = max(stage_of.values())
    for s in sorted(set(stage_of.values())):
        posted = dealt.filter(F.col("stage") == s).select("team", "block", no.alias("item"), "term", "amount", no.alias("still"), "doc_id", "row")
        terms = mine.filter(F.col("stage") == s).withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
        terms = terms.select("team", "block", "item", "term", "amount", "still", no.alias("doc_id"), no.alias("row"))
        owned = posted.unionByName(terms)
        bundles = bundles.groupBy("team", "block").cogroup(owned.groupBy("team", "block")).applyInArrow(_step(k, s == last), BUNDLE)
    best = bundles.select("item", F.explode(F.arrays_zip("ids", "rows", "scores")).alias("b")).select("item", F.when(F.col("b.rows") >= 0, F.col("b.ids")).alias("doc_id"), F.col("b.rows").alias("row"), F.col("b.scores").alias("score"))
    place = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), "row"))
    top = best.withColumn("rank", place).filter(F.col("rank") <= k)
    names = asked.select(F.col("row").alias("item"), F.col("doc_id").alias("item_id"))
    return top.join(broadcast_if_small(names), "item").select("item_id", "rank", "doc_id", "score")
