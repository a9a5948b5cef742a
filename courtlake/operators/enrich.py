"""Q3: content for judgments that have none, from cached parses or archived pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtlake.operators import catalog as tables
from courtlake.operators import fragments, ledger

COLUMNS = ["content_text", "court_summary", "has_content", "has_court_summary", "fragment_count", "extracted_at"]


def enrich(
    catalog: DataFrame, failures: DataFrame, extractions: DataFrame, archive: DataFrame, now: str, k: int | None = None, **layout
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The catalogue with content, the new fragments, and counters (one row).

    The backlog, newest first if `k` limits it, without what failed often and lately.  `extractions` has id and the content
    columns of cached parses, which win over the archive (id, html).  A page without container gives an empty body.
    Texts are joined by id last.  Fragments come from the archive only, as cached parses had theirs when they were made.
    """
    behind = tables.extract_backlog(catalog)
    open_ids = ledger.exclude_quarantined(behind, failures, now)
    if k is not None:
        open_ids = tables.newest(open_ids, k)
    planned = tables.best_source(open_ids.select("id"), extractions, archive)
    cached = extractions.join(planned.filter("content_source = 'cache'").select("id"), "id", "left_semi")
    pages = archive.join(planned.filter("content_source = 'archive'").select("id"), "id", "left_semi")
    found, parsed = fragments.extract(pages, now, once=True, **layout)
    stored = cached.select("id", *COLUMNS, F.lit("ok").alias("extraction_status"))
    updates = stored.unionByName(parsed.select("id", *COLUMNS, "extraction_status"))
    types = {"court_summary": "string", **tables.PHASE2}
    updated = tables.apply_updates(tables.ensure_columns(catalog, types), updates, COLUMNS)
    status = behind.select("id").join(planned, "id", "left").join(updates.select("id", "extraction_status"), "id", "left")
    counters = status.agg(
        F.count_if(F.col("extraction_status") == "ok").alias("extracted"),
        F.count_if(F.col("extraction_status").startswith("empty")).alias("empty"),
        F.count_if(F.col("content_source") == "missing").alias("missing"),
        F.count_if(F.col("content_source").isNull()).alias("left_out"),
        F.count_if(F.col("extraction_status").isNull()).alias("extract_backlog"),
    )
    return updated, found, counters
