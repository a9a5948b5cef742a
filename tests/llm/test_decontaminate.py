"""Benchmark leaks: how often texts are split, and what a word is."""

import random
import re
import sys

from pyspark.sql import functions as F

from courtlake.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def test_words_of_all_code_points(spark):
    chars = [chr(c) for c in range(1, sys.maxunicode + 1) if not 0xD800 <= c < 0xE000]
    rng = random.Random(3)
    texts = ["".join(chars[k:k + 5000]) for k in range(0, len(chars), 5000)]
    texts += ["".join(rng.choice("aZ9 _-é\U0001F600ſK") for _ in range(60)) for _ in range(50)] + ["ABC x,9", "", None]
    got = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", decontaminate.word_array(F.col("t")).alias("w")).collect()
    assert {r.i: r.w for r in got} == {i: WORD.findall((t or "").translate(UPPER)) for i, t in enumerate(texts)}


def test_result_is_read_without_splitting_texts_again(spark):
    docs = spark.createDataFrame([(1, "u a b c d v"), (2, "c d"), (3, None), (None, "x a B c D"), (4, "a b c")], "doc_id long, text string")
    bench = spark.createDataFrame([("p", "a b c d"), ("q", "c d"), ("r", "u"), ("s", "")], "item_id string, text string")
    result = decontaminate.contamination(docs, bench)
    assert "regexp_extract_all" not in result._jdf.queryExecution().optimizedPlan().toString()
    rows = {r.doc_id: (r.n_words, r.n_hit, r.n_items) for r in result.collect()}
    assert rows == {1: (6, 5, 3), 2: (2, 2, 1), 3: (0, 0, 0), None: (5, 4, 2), 4: (3, 0, 0)}
