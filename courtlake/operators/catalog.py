"""Catalogue rows, joins on ids, table maintenance and listing rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from courtlake.functions import text
from courtlake.operators import folds

CONTENT = {"content_text": "string", "court_summary": "string", "summary": "string"}
PHASE2 = {"has_content": "int", "has_court_summary": "int", "fragment_count": "int", "extracted_at": "string"}
PHASE3 = {"summary_generated_at": "string"}
#: Listing pages of a chunk, when a crawl run is folded.
PAGES = 1000


def valid_cards(cards: DataFrame) -> DataFrame:
    """Cards with a link and a case name."""
    return cards.filter((F.coalesce("href", F.lit("")) != "") & (F.coalesce("case_name", F.lit("")) != ""))


def catalog_rows(cards: DataFrame, now: str, site: str = text.SITE) -> DataFrame:
    """The derived catalogue row of every valid card; content columns are null."""
    url = text.absolute_url(F.col("href"), site)
    citation = text.clean_citation(F.coalesce("citation", F.lit("")))
    return cards.select(
        "page", "pos", text.make_id(url).alias("id"), citation.alias("citation"), "case_name", text.join_case_numbers(F.col("case_numbers")).alias("case_numbers"),
        text.decision_date(F.col("date_attribute"), F.col("date_text")).alias("decision_date"), text.court_from_url(url).alias("court"), text.clean_tags(F.col("catchwords")).alias("subject_tags"),
        url.alias("source_url"), text.pdf_url(citation, site).alias("pdf_url"), *(F.lit(None).cast(t).alias(c) for c, t in CONTENT.items()), F.lit(now).alias("created_at"),
    )


def extract_backlog(catalog: DataFrame) -> DataFrame:
    """P3."""
    return catalog.filter(F.col("content_text").isNull())


def summary_backlog(catalog: DataFrame) -> DataFrame:
    """P4."""
    return catalog.filter((F.col("has_content") == 1) & F.col("summary").isNull())


def new_items(items: DataFrame, catalog: DataFrame) -> DataFrame:
    """Rows whose id is not in the catalogue."""
    return items.join(catalog.select("id"), "id", "left_anti")


def first_occurrence(items: DataFrame, *order: str) -> DataFrame:
    """The first row of each id by the given keys; among equal ones the one of the smallest hash."""
    hashed = F.xxhash64(*(F.to_json(c) if "map<" in kind else F.col(c) for c, kind in items.dtypes))
    place = F.row_number().over(Window.partitionBy("id").orderBy(*order, hashed))
    return items.withColumn("_place", place).filter("_place = 1").drop("_place")


def stop_after_known_run(items: DataFrame, catalog: DataFrame, n: int = 5, run: str = "run_id") -> DataFrame:
    """Rows of each crawl run, in (page, pos, id) order, up to the n-th known id in a row, with a `known` flag.

    An id that came before in the run counts as known.  Flags are folded to one row per page and pages by chunks of PAGES; only
    a row a chunk is put in order over a whole run.
    """
    listed = items.join(catalog.select("id", F.lit(True).alias("_in")).distinct(), "id", "left")
    seen = F.row_number().over(Window.partitionBy(run, "id").orderBy("page", "pos")) > 1
    flagged = listed.withColumn("known", F.coalesce("_in", F.lit(False)) | seen).drop("_in")
    rows = F.array_sort(F.collect_list(F.struct("pos", "id", "known")))
    pages = flagged.groupBy(run, "page").agg(rows.alias("rows")).withColumn("flags", F.transform("rows", lambda r: r["known"]))
    size, first = F.size("flags"), F.array_position("flags", False)
    last = F.array_position(F.reverse("flags"), False)
    # sizes and last unknown places of all pages before, by chunks of pages
    chunk = F.floor(F.col("page") / PAGES).cast("long")
    pages = pages.withColumn("_lead", F.when(first > 0, first - 1).otherwise(size)).withColumn("_size", size.cast("long"))
    pages = folds.scan_before(pages, [run], "page", chunk, _before=("sum", F.col("_size")))
    pages = pages.withColumn("_unknown", F.when(last > 0, F.col("_before") + size - last + 1))
    pages = folds.scan_before(pages, [run], "page", chunk, _latest=("max", F.col("_unknown")))
    carried = F.col("_before") - F.coalesce("_latest", F.lit(0))
    within = F.filter(F.sequence(F.lit(n), size), lambda i: F.forall(F.slice("flags", i - n + 1, n), lambda k: k))
    inside = F.when(size >= n, F.try_element_at(within, F.lit(1)))
    own = F.least(F.when(F.col("_lead") >= F.greatest(n - carried, F.lit(1)), F.greatest(n - carried, F.lit(1))), inside)
    cut = pages.withColumn("_cut", own).filter("_cut is not null").groupBy(run).agg(F.min_by(F.struct("page", F.element_at("rows", F.col("_cut").cast("int")).alias("r")), "page").alias("c"))
    cut = cut.select(F.col(run).alias("_run"), F.struct("c.page", "c.r.pos", "c.r.id").alias("_stop"))
    joined = flagged.join(cut, F.col(run) == F.col("_run"), "left")
    return joined.filter(F.col("_stop").isNull() | (F.struct("page", "pos", "id") <= F.col("_stop"))).select(*items.columns, "known")


def apply_updates(catalog: DataFrame, updates: DataFrame, columns: list[str], key: str = "id") -> DataFrame:
    """The listed columns from `updates` where its key matches; all else as it was."""
    delta = updates.select(F.col(key).alias("_key"), F.lit(True).alias("_hit"), *(F.col(c).alias(f"_{c}") for c in columns))
    joined = catalog.join(delta, F.col(key) == F.col("_key"), "left")
    new = {c: F.when(F.col("_hit"), F.col(f"_{c}")).otherwise(F.col(c)) for c in columns}
    return joined.select(*(new[c].alias(c) if c in new else F.col(c) for c in catalog.columns))


def append_new(catalog: DataFrame, *staged: DataFrame) -> DataFrame:
    """The catalogue and staged rows, one row per new id: of the first staged table that has it."""
    rows = staged[0].withColumn("_table", F.lit(0))
    for k, more in enumerate(staged[1:], 1):
        rows = rows.unionByName(more.withColumn("_table", F.lit(k)))
    return catalog.unionByName(first_occurrence(new_items(rows, catalog), "_table").drop("_table"), allowMissingColumns=True)


def insert_or_ignore(table: DataFrame, new: DataFrame, *order: str) -> tuple[DataFrame, DataFrame]:
    """The table with new ids added, and the rows really added; the first write by `order` wins."""
    added = first_occurrence(new.join(table.select("id"), "id", "left_anti").select(new.columns), *order)
    return table.unionByName(added), added


def ensure_columns(table: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Missing columns as nulls of their type."""
    return table.withColumns({c: F.lit(None).cast(t) for c, t in columns.items() if c not in table.columns}) if set(columns) - set(table.columns) else table


def replace_for(table: DataFrame, new: DataFrame, key: str = "judgment_id") -> DataFrame:
    """All rows of the keys in `new` give way to it."""
    return table.join(new.select(key).distinct(), key, "left_anti").select(table.columns).unionByName(new.select(table.columns))


def nullify_summaries(catalog: DataFrame, cache: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Summaries of the ids set to null and their cached copies dropped."""
    gone = ids.select("id").distinct().select("id", F.lit(None).cast("string").alias("summary"), F.lit(None).cast("string").alias("summary_generated_at"))
    return apply_updates(catalog, gone, ["summary", "summary_generated_at"]), cache.join(gone.select(F.col("id").alias("judgment_id")), "judgment_id", "left_anti")


def newest(table: DataFrame, k: int, *before: Column, date: str = "decision_date") -> DataFrame:
    """The first k by the given keys, then newest first, then id."""
    return table.orderBy(*before, F.desc(date), "id").limit(k)


def catalog_page(catalog: DataFrame, page: int = 1, size: int = 25) -> DataFrame:
    """One page of the catalogue, newest first."""
    return catalog.orderBy(F.desc("decision_date"), "id").offset((page - 1) * size).limit(size)


def facet_counts(table: DataFrame, *columns: str) -> DataFrame:
    """A1, A2: (facet, value, n) of each column, in one pass by grouping sets."""
    values = F.explode(F.array(*(F.struct(F.lit(c).alias("facet"), F.col(c).cast("string").alias("value")) for c in columns)))
    return table.select(values.alias("f")).groupBy("f.facet", "f.value").agg(F.count(F.lit(1)).alias("n"))


def pipeline_state(catalog: DataFrame) -> DataFrame:
    """A3, A4: sizes of the phases and of their backlogs; phases whose columns are missing have not begun."""
    there = set(catalog.columns)
    if "content_text" not in there:  # nothing was planned, so nothing is behind
        catalog = catalog.withColumn("content_text", F.lit(""))
    catalog = ensure_columns(catalog, {"has_content": "int", "summary": "string"})
    counts = catalog.agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.col("content_text").isNotNull()).alias("enriched"), F.count_if(F.col("has_content") == 1).alias("with_body"), F.count_if(F.col("summary").isNotNull()).alias("summarised"),
        F.count_if(F.col("content_text").isNull()).alias("extract_backlog"), F.count_if((F.col("has_content") == 1) & F.col("summary").isNull()).alias("summary_backlog"),
    )
    return counts if "content_text" in there else counts.withColumn("enriched", F.lit(0).cast("long"))


def fragment_stats(fragments: DataFrame) -> DataFrame:
    """A5: fragments, fragments with footnotes and characters of each judgment."""
    return fragments.groupBy("judgment_id").agg(F.count(F.lit(1)).alias("fragments"), F.sum("has_footnotes").alias("with_footnotes"), F.sum(F.length("content_text")).alias("chars"))


def page_totals(items: DataFrame, catalog: DataFrame) -> DataFrame:
    """Rows and new rows of each listing page."""
    marked = items.join(catalog.select("id", F.lit(1).alias("_in")).distinct(), "id", "left")
    return marked.groupBy("page").agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("_in").isNull()).alias("new"))


def best_source(backlog: DataFrame, extractions: DataFrame, archive: DataFrame) -> DataFrame:
    """Where each document's content comes from: cached parse, archived page or nowhere.  Ids only; join texts last."""
    cached = extractions.select("id", F.lit(True).alias("_cached")).distinct()
    stored = archive.select("id", F.lit(True).alias("_stored")).distinct()
    joined = backlog.join(cached, "id", "left").join(stored, "id", "left")
    return joined.withColumn("content_source", F.when(F.col("_cached"), "cache").when(F.col("_stored"), "archive").otherwise("missing")).drop("_cached", "_stored")


def reuse_cached_summaries(backlog: DataFrame, cache: DataFrame) -> DataFrame:
    """A non-empty cached summary is applied without a model call."""
    own = cache.select(F.col("judgment_id").alias("id"), F.col("summary").alias("cached_summary")).filter(~text.blank(F.col("cached_summary")))
    return backlog.join(own, "id", "left").withColumn("status", F.when(F.col("cached_summary").isNotNull(), "cached").otherwise("pending"))


def fragments_of(backlog: DataFrame, fragments: DataFrame) -> DataFrame:
    """Fragments of the chosen judgments."""
    return fragments.join(backlog.select(F.col("id").alias("judgment_id")).distinct(), "judgment_id", "left_semi")


def discover(cards: DataFrame, catalog: DataFrame, staged: DataFrame | None, now: str, n: int = 5) -> DataFrame:
    """Q1: new catalogue rows of a crawl: derived, cut after n known in a row, first occurrence of each new id."""
    rows = catalog_rows(valid_cards(cards), now).withColumn("run_id", F.lit(now))
    cut = stop_after_known_run(rows, catalog, n).filter("not known").drop("known", "run_id")
    fresh = first_occurrence(cut, "page", "pos")
    if staged is None:
        return fresh
    both = new_items(staged, catalog).withColumn("_table", F.lit(0)).unionByName(fresh.withColumn("_table", F.lit(1)))
    return first_occurrence(both, "_table", "page", "pos").drop("_table")
