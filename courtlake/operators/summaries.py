"""Inputs for summaries, the cleaning of drafts, and the audit of finished summaries."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from courtlake.functions import text
from courtlake.operators import catalog as tables

BREAK = "\n\n---\n\n"


def rendered(fragments: DataFrame) -> DataFrame:
    return fragments.withColumn("rendered", text.render_fragment(F.col("class_name"), F.col("paragraph_number"), F.col("content_text")))


def batch_fragments(fragments: DataFrame, max_batches: int = 20, least: int = 10) -> DataFrame:
    """A dense index over non-blank rendered fragments and the batch of each."""
    kept = rendered(fragments).filter("rendered <> ''")
    per = Window.partitionBy("judgment_id")
    sized = kept.withColumn("n", F.count(F.lit(1)).over(per)).withColumn("idx", F.row_number().over(per.orderBy("ordinal")) - 1)
    size = F.greatest(F.lit(least), F.ceil(F.col("n") / max_batches))
    return sized.withColumn("batch", F.floor(F.col("idx") / size).cast("int"))


def batch_texts(fragments: DataFrame, max_batches: int = 20, least: int = 10) -> DataFrame:
    """The joined text of every batch of a judgment."""
    batched = batch_fragments(fragments, max_batches, least)
    parts = F.transform(F.array_sort(F.collect_list(F.struct("idx", "rendered"))), lambda s: s["rendered"])
    return batched.groupBy("judgment_id", "batch").agg(F.array_join(parts, BREAK).alias("batch_text"), F.max("n").cast("int").alias("n_rendered"))


def summary_inputs(catalog: DataFrame, fragments: DataFrame, ledger: DataFrame, now, k: int | None = None, max_batches: int = 20) -> DataFrame:
    """Q4: batches of the next k documents without summary (None: of all), with model tier, limit and budget.

    Documents that failed often come first, those blocked are skipped.  Without usable fragments the body is the only batch,
    and without a body the row says so.
    """
    from courtlake.operators.ledger import with_tier

    chosen = with_tier(tables.summary_backlog(catalog), ledger, now).filter("tier <> 'blocked'")
    if k is not None:
        chosen = tables.newest(chosen, k, F.desc("priority"))
    batches = batch_texts(tables.fragments_of(chosen, fragments), max_batches).withColumnRenamed("judgment_id", "id")
    joined = chosen.select("id", "case_name", "citation", "content_text", "fragment_count", "tier").join(batches, "id", "left")
    usable = F.col("batch_text").isNotNull()
    body = F.when(~text.blank(F.col("content_text")), F.col("content_text"))
    n = F.when(F.coalesce("fragment_count", F.lit(0)) > 0, F.col("fragment_count")).otherwise(F.coalesce("n_rendered", F.lit(0)))
    limit = text.max_summary_chars(n)
    return joined.select(
        "id", F.coalesce("batch", F.lit(0)).alias("batch"), F.coalesce("batch_text", body).alias("input_text"), n.alias("n_fragments"), limit.alias("max_chars"), text.token_budget(limit).alias("max_tokens"),
        "tier", text.case_anchor(F.col("case_name"), F.col("citation")).alias("anchor"), F.when(usable, "fragments").when(body.isNotNull(), "body").otherwise("error: nothing to read").alias("input_source"),
    )


def greedy_state(items: Column, budget: Column) -> Column:
    """T6 with its total: of structs (score, ordinal, size), best score first, each that still fits is taken; the rest is skipped."""
    order = F.array_sort(F.transform(items, lambda i: F.struct((-i["score"]).alias("back"), i["ordinal"].alias("ordinal"), i["size"].alias("size"))))
    start = F.struct(F.lit(0).cast("long").alias("used"), F.expr("cast(array() as array<int>)").alias("taken"))

    def step(state, item):
        fits = state["used"] + item["size"] <= budget
        more = F.struct((state["used"] + item["size"]).cast("long").alias("used"), F.concat(state["taken"], F.array(item["ordinal"])).alias("taken"))
        return F.when(fits, more).otherwise(state)

    return F.aggregate(order, start, step)


def greedy_fill(items: Column, budget: Column) -> Column:
    """The ordinals that greedy_state() takes."""
    return greedy_state(items, budget)["taken"]


def select_summary_input(judgments: DataFrame, fragments: DataFrame, max_chars: int) -> DataFrame:
    """Q5: headings, the first and last three numbered paragraphs, then the best of the rest that fit, in order.

    The choice is made over ordinals and sizes; texts of the chosen fragments alone are joined to it.
    """
    f = rendered(fragments).withColumn("_heading", text.is_heading(F.col("class_name"))).withColumn("_numbered", text.is_numbered(F.col("class_name")) & F.col("paragraph_number").isNotNull())
    score = text.score_fragment(F.col("has_footnotes"), F.col("section_heading"), F.col("has_table"), F.col("content_text"))
    slim = f.select("judgment_id", "ordinal", "paragraph_number", "_heading", "_numbered", (F.length("rendered") + 2).cast("long").alias("size"), score.alias("score"))
    by_number = Window.partitionBy("judgment_id", "_numbered")
    first = F.row_number().over(by_number.orderBy("paragraph_number", "ordinal"))
    last = F.row_number().over(by_number.orderBy(F.desc("paragraph_number"), F.desc("ordinal")))
    slim = slim.withColumn("_first", F.col("_numbered") & (first == 1)).withColumn("_last", F.when(F.col("_numbered") & (last <= 3), last))
    fixed = F.col("_heading") | F.col("_first") | F.col("_last").isNotNull()
    item = lambda cond, *extra: F.collect_list(F.when(cond, F.struct(*extra)))
    rest = ~fixed & ~F.col("_heading") & ~F.col("_numbered")
    grouped = slim.groupBy("judgment_id").agg(
        F.sum(F.when(fixed, F.col("size")).otherwise(0)).alias("used"), item(rest, "score", "ordinal", "size").alias("rest"),
        F.array_sort(item(F.col("_last").isNotNull(), (-F.col("_last")).alias("place"), F.col("ordinal"), F.col("size"))).alias("lasts"), F.collect_list(F.when(fixed, F.col("ordinal"))).alias("kept"),
    )
    court = text.strip(F.coalesce("court_summary", F.lit("")))
    j = judgments.select(F.col("id").alias("judgment_id"), court.alias("court"), F.substring(text.strip(F.coalesce("content_text", F.lit(""))), 1, max_chars).alias("body"))
    lead = j.select("judgment_id", F.when(F.col("court") != "", F.length("court") + 2).otherwise(0).alias("lead"))
    g = grouped.join(lead, "judgment_id").withColumn("used", F.col("used") + F.col("lead"))
    g = g.withColumn("fill", greedy_state(F.col("rest"), F.lit(max_chars) - F.col("used"))).withColumn("used", F.col("used") + F.col("fill.used"))
    start = F.struct(F.col("used").alias("used"), F.expr("cast(array() as array<int>)").alias("dropped"))
    over = lambda s, x: F.when(s["used"] > max_chars, F.struct((s["used"] - x["size"]).alias("used"), F.concat(s["dropped"], F.array(x["ordinal"])).alias("dropped"))).otherwise(s)
    chosen = F.array_except(F.array_union("kept", F.col("fill.taken")), F.aggregate("lasts", start, over)["dropped"])
    picked = g.select("judgment_id", F.explode(chosen).alias("ordinal"))
    texts = f.filter("rendered <> ''").select("judgment_id", "ordinal", "rendered").join(picked, ["judgment_id", "ordinal"])
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("ordinal", "rendered"))), lambda a: a["rendered"])
    joined = texts.groupBy("judgment_id").agg(F.array_join(ordered, "\n\n").alias("joined"))
    out = j.join(grouped.select("judgment_id", F.lit(True).alias("has")), "judgment_id", "left").join(joined, "judgment_id", "left")
    whole = F.concat_ws("\n\n", F.when(F.col("court") != "", F.concat(F.lit("## Court Summary\n"), "court")), "joined")
    return out.select("judgment_id", F.when(F.col("has"), F.substring(whole, 1, max_chars)).otherwise(F.col("body")).alias("input_text"))


def clean_drafts(drafts: DataFrame, draft: str = "draft", fragments: str = "n_fragments", to: str = "summary") -> DataFrame:
    """F22, F23, F24 and the limit (F26), in the order of the pipeline."""
    limit = text.max_summary_chars(F.col(fragments))
    bare = text.fix_artifacts(text.strip_commentary(text.strip_meta_prefix(F.col(draft))))
    return drafts.withColumn(to, text.trim_to_complete(bare, limit))


def finish_summaries(drafts: DataFrame) -> DataFrame:
    """Q6: cleaned drafts (id, draft, n_fragments) with the verdict of the smell test."""

    def judged(summary: Column) -> Column:
        return F.struct(summary.alias("summary"), text.smell_test(summary, F.col("n_fragments")).alias("smell"))

    cleaned = clean_drafts(drafts, to="_summary").select("id", F.inline(F.transform(F.array("_summary"), judged)))
    return cleaned.select("id", "summary", "smell.passed", "smell.issues")


#: Issues of the published audit that no repair can mend.
STRUCTURAL = ("too short", "no structural heading", "no terminal punctuation")


def audit(catalog: DataFrame, fix: bool = True, structural: tuple[str, ...] = STRUCTURAL) -> DataFrame:
    """Q7: every summary with issues, the repaired text, and the action.

    Changed and then clean: fixed.  Else with a structural issue before the repair: nullified.  Else unfixed.
    """
    n = F.coalesce("fragment_count", F.lit(0))

    def repair(summary: Column) -> Column:
        mended = text.trim_trailing_incomplete(text.fix_artifacts(text.strip_commentary(summary)))
        clean = lambda m: F.when((m != summary) & text.smell_test(m, n)["passed"], m)
        return text.let(mended, clean)

    def judged(issues: Column) -> Column:
        return F.struct(issues.alias("issues"), F.when(F.size(issues) > 0, repair(F.col("summary"))).alias("repaired"))

    # a generator of no row or one: as a filter the test would be computed twice
    tested = F.transform(F.array(text.smell_test(F.col("summary"), n)["issues"]), judged)
    found = catalog.filter(F.col("summary").isNotNull()).select("id", F.inline(F.filter(tested, lambda r: F.size(r["issues"]) > 0)))
    hopeless = F.arrays_overlap("issues", F.array(*(F.lit(s) for s in structural)))
    action = F.when(F.col("repaired").isNotNull(), "fixed").when(hopeless, "nullified").otherwise("unfixed")
    return found.select("id", "issues", (action if fix else F.lit("reported")).alias("action"), "repaired")


def audit_records(catalog: DataFrame, fix: bool = True) -> DataFrame:
    """Q7: the audit with what a report says of a judgment: citation (else the id), court, fragments and words."""
    about = catalog.select("id", F.coalesce("citation", "id").alias("citation"), "court", F.coalesce("fragment_count", F.lit(0)).cast("int").alias("fragment_count"), "summary")
    found = audit(catalog, fix).join(about, "id")
    return found.select("id", "citation", "court", "fragment_count", F.regexp_count("summary", F.lit(r"(?U)\S+")).alias("word_count"), "issues", "action", "repaired")


def audit_totals(audited: DataFrame) -> DataFrame:
    """(kind, name, n): actions and a histogram of issues."""
    pair = lambda kind, name: F.struct(F.lit(kind).alias("kind"), name.alias("name"))
    both = F.concat(F.array(pair("action", F.col("action"))), F.transform("issues", lambda i: pair("issue", i)))
    return audited.select(F.inline(both)).groupBy("kind", "name").agg(F.count(F.lit(1)).alias("n"))


def rolling_fold(batches: DataFrame, model: Callable[[str, str, int], str], condense: Callable[[str, int], str] | None = None) -> DataFrame:
    """H6: per judgment, summary <- model(summary, batch, limit) over its batches in order.

    `batches` has id, batch, input_text, max_chars.  An empty answer to the first batch is an error, to a later one the
    end.  A result over the limit is condensed.
    """

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("batch")
        limit, summary, status = int(pdf["max_chars"].iloc[0]), "", "ok"
        for k, part in enumerate(pdf["input_text"]):
            answer = (model(summary, part, limit) or "").strip()
            if not answer:
                status = "ok" if k else "error: empty first answer"
                break
            summary = answer
        if condense and len(summary) > limit:
            summary = condense(summary, limit)
        return pd.DataFrame({"id": [pdf["id"].iloc[0]], "draft": [summary], "status": [status]})

    return batches.groupBy("id").applyInPandas(fold, "id string, draft string, status string")


def stored_fold(batches: DataFrame, model: Callable[[str, str, int], str], path: str, condense: Callable[[str, int], str] | None = None) -> DataFrame:
    """H6 in rounds: batch k of every judgment in round k, the summaries so far stored after each.

    Folders ``round=<k>`` that were written whole are not made again, so a fold that was cut off goes on where it stopped and
    no call of a finished round is made twice.  Each row is one call: a round uses all tasks.  Gives what rolling_fold() gives.
    """
    spark = batches.sparkSession
    schema = "id string, max_chars int, draft string, status string, open boolean"

    def call(parts):
        for pdf in parts:
            rows = []
            for r in pdf.itertuples():
                answer = (model(r.draft, r.input_text, int(r.max_chars)) or "").strip()
                first = r.draft == ""
                status = "ok" if answer or not first else "error: empty first answer"
                rows.append((r.id, int(r.max_chars), answer or r.draft, status, bool(answer)))
            yield pd.DataFrame(rows, columns=["id", "max_chars", "draft", "status", "open"])

    each = batches.select("id", "batch", "input_text", F.col("max_chars").cast("int").alias("max_chars"))
    place = F.row_number().over(Window.partitionBy("id").orderBy("batch")) - 1
    numbered = each.withColumn("round", place)
    last = numbered.agg(F.max("round")).first()[0]
    if last is None:
        return spark.createDataFrame([], "id string, draft string, status string")
    state = None
    for k in range(last + 1):
        at = f"{path}/round={k}"
        if not _written(spark, at):
            now = numbered.filter(F.col("round") == k)
            if state is None:
                called = now.select("id", "input_text", "max_chars", F.lit("").alias("draft")).mapInPandas(call, schema)
                made = called
            else:
                going = state.filter("open").select("id", "draft").join(now.select("id", "input_text", "max_chars"), "id")
                called = going.mapInPandas(call, schema)
                made = called.unionByName(state.join(going.select("id"), "id", "left_anti"))
            made.write.mode("overwrite").parquet(at)
        state = spark.read.schema(schema).parquet(at)
    if condense is None:
        return state.select("id", "draft", "status")

    def shorten(parts):
        for pdf in parts:
            pdf["draft"] = [condense(d, int(m)) if len(d) > m else d for d, m in zip(pdf["draft"], pdf["max_chars"], strict=True)]
            yield pdf[["id", "draft", "status"]]

    return state.mapInPandas(shorten, "id string, draft string, status string")


def _written(spark, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(target)
