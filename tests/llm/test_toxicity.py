"""Features of the severity model on families of copies."""

import random

from courtlake.llm import toxicity


def test_copies_of_a_long_text_hide_no_insult(spark):
    rng = random.Random(4)
    plain = ["".join(rng.choice("abcdefg") for _ in range(5)) for _ in range(300)]
    family = " ".join(f"{rng.randrange(16**8):08x}" for _ in range(3000))
    say = lambda *more: " ".join([*(rng.choice(plain) for _ in range(60)), *more])
    rows = [(i, family, 1) for i in range(300)] + [(i, say("vileword"), 1) for i in range(300, 360)] + [(i, say(), 0) for i in range(360, 960)]
    df = spark.createDataFrame([*rows, rows[0], rows[400]], "doc_id long, text string, grade int").repartition(4)
    model = toxicity.fit(df.select("doc_id", "text"), df.select("doc_id", "grade"))
    held = [(k, say(*["vileword"] * (k % 2))) for k in range(40)]
    got = toxicity.severity(spark.createDataFrame(held, "doc_id long, text string"), model).collect()
    assert all(r.toxic == bool(r.doc_id % 2) for r in got)
    assert len(model.features) < 100
