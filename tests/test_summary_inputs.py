"""Summary inputs of a whole backlog against brute force."""

from courtlake.operators import summaries


def test_whole_backlog(spark):
    now = "2026-07-16T12:00:00"
    catalog = [(str(i), f"Case {i}", "[2020] SGHC 1", "2020-01-01", f"body {i}" if i % 3 else " ", 1, "done" if i % 7 == 0 else None, 25 if i % 2 else 0) for i in range(130)]
    lines = [(str(i), o, "Judg-1", None, f"line {i} {o}") for i in range(1, 130, 2) for o in range(25)]
    ledger = [(str(i), 4 if i % 10 == 5 else 8, now) for i in range(0, 130, 5)]
    c = spark.createDataFrame(catalog, "id string, case_name string, citation string, decision_date string, content_text string, has_content int, summary string, fragment_count int")
    f = spark.createDataFrame(lines, "judgment_id string, ordinal int, class_name string, paragraph_number int, content_text string")
    got = summaries.summary_inputs(c, f, spark.createDataFrame(ledger, "id string, count int, last_attempt string"), now).collect()
    want = {}
    for i in range(130):
        if i % 7 == 0 or i % 10 == 0:  # summarised, or blocked after eight failures
            continue
        parts = [summaries.BREAK.join(f"line {i} {o}" for o in range(a, min(a + 10, 25))) for a in (0, 10, 20)] if i % 2 else [f"body {i}" if i % 3 else None]
        source = "fragments" if i % 2 else "body" if i % 3 else "error: nothing to read"
        want |= {(str(i), b): (t, source, 25 if i % 2 else 0, f"Case {i}") for b, t in enumerate(parts)}
    assert len(got) == len(want) and {(r.id, r.batch): (r.input_text, r.input_source, r.n_fragments) for r in got} == {k: v[:3] for k, v in want.items()}
    assert all(want[r.id, r.batch][3] in r.anchor for r in got)
    assert len({r.tier for r in got if int(r.id) % 10 == 5}) == 1 and len({r.tier for r in got if int(r.id) % 5}) == 1
