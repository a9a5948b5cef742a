"""Search with whole texts against brute force, and the stored index."""

import math
import re
from collections import Counter

import pytest

from courtlake.operators import search
from courtlake.plans import judgments


@pytest.mark.parametrize("name", ["search_queries", "search_whole_items"])
def test_search_whole_items(spark, tmp_path, name):
    fill = "the quick brown fox jumps over the lazy dog near a river bank "
    texts = {k: fill * (1 + k % 3) + ("jurisdiction " * (k % 4)) + ("appeal dismissed" if k % 2 else "") for k in range(1, 25)}
    items = {1: "the quick brown fox jumps over the lazy jurisdiction", 2: "The quick brown fox jumps over the lazy dog; appeal dismissed", 3: "the quick brown fox jumps over the lazy dog never", 4: "river"}
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(list(items.items()), "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    terms = lambda t: re.findall("[a-z0-9]+", t.lower())
    tf = {i: Counter(terms(t)) for i, t in texts.items()}
    size = {i: sum(c.values()) for i, c in tf.items()}
    mean, want = sum(size.values()) / len(size), {}
    for q, t in items.items():
        need, found = set(terms(t)), []
        for i, c in tf.items():
            if need <= set(c):
                idf = {x: math.log(1 + (len(tf) - (df := sum(x in o for o in tf.values())) + 0.5) / (df + 0.5)) for x in need}
                found.append((-round(sum(idf[x] * c[x] * 2.2 / (c[x] + 1.2 * (0.25 + 0.75 * size[i] / mean)) for x in need), 6), i))
        want |= {(q, k + 1): (i, -s) for k, (s, i) in enumerate(sorted(found)[:10])}
    got = {(r.query_id, r["rank"]): (r.id, r.score) for r in getattr(judgments, name)(spark, str(tmp_path)).collect()}
    assert got.keys() == want.keys() and {q for q, _ in got} == {1, 2, 4}
    assert all(got[k][0] == want[k][0] and abs(got[k][1] - want[k][1]) < 2e-6 for k in want)


def test_batches_blocks_and_skipping_give_the_same_as_one_index(spark, tmp_path):
    rows = [(i, " ".join(f"w{(i * j) % 13}" for j in range(1 + i % 9)) + " common" * (1 + i % 5)) for i in range(1500)]
    docs = spark.createDataFrame(rows, "id long, content_text string")
    asked = spark.createDataFrame([(1, "common"), (2, "common w3"), (3, "w1 w2 w3"), (4, "w1 nowhere"), (5, None), (6, "W12 Common")], "query_id long, text string")
    one, many = f"{tmp_path}/one", f"{tmp_path}/many"
    search.add_to_index(docs, one, "all")
    for part in range(3):
        for _ in range(1 + part % 2):  # a repeated batch replaces itself
            search.add_to_index(docs.filter(f"id % 3 = {part}"), many, f"p{part}")
    assert search.read_postings(spark, one).filter("term = 'common'").count() > 8
    assert search.read_postings(spark, many).groupBy("term").sum("n").collect().__len__() == 14
    want = sorted(map(tuple, search.search_stored(spark, one, asked, 5, first=10**6).collect()))  # nothing is left to skip
    assert {q for q, *_ in want} == {1, 2, 3, 6}
    for path, first in ((one, 1), (many, 1), (many, 0)):
        found = search.search_stored(spark, path, asked, 5, first=first)
        assert sorted(map(tuple, found.collect())) == want
    # the plan reads what the search stored, not the index and not the documents
    assert all("/search-" in f or "/many/sizes" in f for f in found.inputFiles())


def test_an_index_without_terms(spark, tmp_path):
    asked = spark.createDataFrame([(1, "one")], "query_id long, text string")
    for name, rows in (("none", []), ("blank", [(1, None), (2, "..")])):
        docs = spark.createDataFrame(rows, "id long, content_text string")
        search.add_to_index(docs, f"{tmp_path}/{name}", "b")
        assert search.search_stored(spark, f"{tmp_path}/{name}", asked).collect() == []
