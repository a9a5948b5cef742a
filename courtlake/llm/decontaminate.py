"""Benchmark leaks: a prefix-filtered set join of item windows and documents, in DataFrame operations only.

A window of an item is a set of word shingles with places.  A document contains the window only if it contains the
window's rarest shingle, so with shingles in order of rarity a prefix of one shingle is enough for exact containment.

1. Hash the shingles of every document, in the one pass that splits all texts; keep each document's number of words and the
   occurrences of shingles that some item has (place included).
2. Count them, order each window's shingles by rarity and join the rarest one to its occurrences.
3. The shingle's place gives the only possible start; length and position bounds drop starts outside the document.
4. Verify: the words at each start are compared with the window's words.  Only documents with starts are split again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from courtlake.llm.common import broadcast_if_small, drop_stored, lower_ascii, stored

#: Words: after lower-casing A-Z, everything but ASCII signs, controls and white space.  Letters and digits are named one by
#: one, since Java looks those up in a table and tries ranges one after the other.
WORD = "[abcdefghijklmnopqrstuvwxyz0123456789\\x{80}-\\x{10FFFF}]+"


def word_array(text: Column) -> Column:
    text = F.coalesce(text, F.lit(""))
    # a text of single bytes is ASCII alone
    low = F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(lower_ascii(text))
    return F.regexp_extract_all(low, F.lit(WORD), F.lit(0))


def _shingle_hashes(words: str, size: int) -> Column:
    """Hash of the `size` words from each place on; `words` names an array column."""
    rest = "".join(f", get({words}, i + {k})" for k in range(1, size))
    return F.expr(f"slice(transform({words}, (x, i) -> xxhash64({size}, x{rest})), 1, greatest(size({words}) - {size - 1}, 0))")


def windows_of(benchmark: DataFrame, window: int, id_col: str, text_col: str) -> DataFrame:
    """Distinct windows (words) with the ids of the items that have them: one row per window and item."""
    items = benchmark.select(F.col(id_col).cast("string").alias("item"), word_array(F.col(text_col).cast("string")).alias("w")).filter("item is not null and size(w) > 0")
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - window, F.lit(0)))
    return items.select("item", "w", F.explode(starts).alias("at")).select("item", F.slice("w", F.col("at") + 1, window).alias("words")).distinct()


def contamination(documents: DataFrame, benchmark: DataFrame, window: int = 10, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per document row: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    A window is `window` consecutive words of an item, or the whole item if it is shorter.  n_hit counts the words inside
    any occurrence of a window, n_items the items with an occurring window; items_sha256 is of those ids, sorted as
    strings and comma-joined (of the empty string if there are none).  Null and empty texts have no words; items without
    words or without id have no windows.  Rows that repeat an id are judged one by one if their texts differ.  Other
    columns are ignored.  Empty tables give no hits.
    """
    docs = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).withColumn("version", F.xxhash64("text"))
    pairs = stored(windows_of(benchmark, window, item_id_col, item_text_col).withColumn("wid", F.sha2(F.array_join("words", " "), 256)))
    windows = stored(pairs.groupBy("wid").agg(F.first("words").alias("words")).withColumn("len", F.size("words")))
    sizes = sorted(r[0] for r in windows.select(F.least(F.lit(shingle), F.col("len"))).distinct().collect()) or [shingle]  # at most `shingle` rows

    tokens = None
    for size in sizes:
        own = windows.filter(F.least(F.lit(shingle), F.col("len")) == size).select("wid", "len", "words")
        own = own.select("wid", "len", F.lit(size).alias("size"), F.posexplode(_shingle_hashes("words", size)).alias("offset", "token"))
        tokens = own if tokens is None else tokens.unionByName(own)
    # place 0 is the document itself, with a token that spreads it; then come its shingles, one size after the other
    hashed = docs.select("doc_id", "version", word_array(F.col("text")).alias("w"))
    hashed = hashed.select("doc_id", "version", F.size("w").alias("n_words"), F.concat(F.array("version"), *(_shingle_hashes("w", size) for size in sizes)).alias("tokens"))
    # outer, as Spark would filter by the size of an inner one's array, and for it split the text again for each word
    places = hashed.select("doc_id", "version", "n_words", F.posexplode_outer("tokens").alias("place", "token"))
    known = tokens.groupBy("token").agg(F.max("size").alias("size"))
    kept = stored(places.join(broadcast_if_small(known), "token", "left").filter("place = 0 or size is not null"))
    first, at = F.lit(1), F.lit(None).cast("int")
    for size in sizes:
        at = F.when(F.col("size") == size, F.col("place") - first).otherwise(at)
        first = first + F.greatest(F.col("n_words") - (size - 1), F.lit(0))
    hits = kept.filter("place > 0").select("doc_id", "version", "token", at.alias("at"))

    counts = hits.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    rarest = tokens.join(counts, "token", "left").groupBy("wid", "len").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token", "offset")).alias("p"))
    prefix = rarest.filter("p.n > 0").select("wid", "len", "p.token", "p.offset")
    found = hits.join(broadcast_if_small(prefix), "token").select("doc_id", "version", (F.col("at") - F.col("offset")).alias("start"), "len").filter("start >= 0").distinct()
    starts = stored(found.groupBy("doc_id", "version").agg(F.collect_set(F.struct("start", "len")).alias("starts")))
    texts = docs.join(broadcast_if_small(starts).withColumnRenamed("doc_id", "id").withColumnRenamed("version", "v"), F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("version") == F.col("v")))
    texts = texts.select("doc_id", "version", "starts", word_array(F.col("text")).alias("w"))
    texts = texts.select("doc_id", "version", "w", F.filter("starts", lambda s: s["start"] + s["len"] <= F.size("w")).alias("starts"))
    texts = texts.select("doc_id", "version", F.transform("starts", lambda s: F.struct(s["start"].alias("start"), s["len"].alias("len"), F.sha2(F.array_join(F.slice("w", s["start"] + 1, s["len"]), " "), 256).alias("wid"))).alias("s"))
    spans = texts.select("doc_id", "version", F.inline_outer("s")).distinct().join(broadcast_if_small(windows.select("wid")), "wid", "left_semi")
    spans = stored(spans)

    order = Window.partitionBy("doc_id", "version").orderBy("start", "len")
    reach = F.coalesce(F.max(F.col("start") + F.col("len")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    hit = spans.select("doc_id", "version", "start", "len").distinct().withColumn("new", F.greatest(F.col("start") + F.col("len") - F.greatest("start", reach), F.lit(0)))
    hit = hit.groupBy("doc_id", "version").agg(F.sum("new").alias("n_hit"))
    items = spans.select("doc_id", "version", "wid").distinct().join(broadcast_if_small(pairs.select("wid", "item")), "wid")
    items = items.groupBy("doc_id", "version").agg(F.array_sort(F.collect_set("item")).alias("items"))
    result = stored(hit.join(items.withColumnRenamed("doc_id", "i").withColumnRenamed("version", "v"), F.col("doc_id").eqNullSafe(F.col("i")) & (F.col("version") == F.col("v"))).select(F.col("doc_id").alias("id"), F.col("version").alias("ver"), "n_hit", "items"))
    rows = kept.filter("place = 0").select("doc_id", "version", F.col("n_words").cast("long").alias("n_words"))
    joined = rows.join(broadcast_if_small(result), F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("version") == F.col("ver")), "left")
    none = F.array().cast("array<string>")
    return joined.select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.size(F.coalesce("items", none)).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.coalesce("items", none), ","), 256).alias("items_sha256"), (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )
