"""Ranked search against a brute-force version."""

import math
import re
from collections import Counter

import oracle
import pytest

from courtlake.llm import queries, ranked_search

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute(docs, items, k):
    counted = [(i, Counter(terms(t))) for i, t in docs]
    counted = [(i, c, sum(c.values())) for i, c in counted if c]
    total, df = sum(n for *_, n in counted), Counter(t for _, c, _ in counted for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c, n in counted:
            m = 75 + 25 * n * len(counted) // total
            s = sum(math.floor(1000 * math.log((2 * len(counted) + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m)) for t in terms(text) if t in c)
            if s > 0:
                scores.append((-s, i is None, i or 0, i))
        out += [(item, r, i, -s) for r, (s, _, _, i) in enumerate(sorted(scores, key=lambda x: x[:3])[:k], 1)]
    return sorted(out, key=repr)


def items_of(texts):
    long = next(t for i, t in texts if i == 40)
    return [(1, " ".join(long.split()[:50])), (2, None), (3, ""), (4, "one One ONE a b"), (5, "nothing_like_that zzzz9"), (5, texts[9][1]), (None, texts[30][1]), (7, "é ü–x 1,5"), (8, long), (9, long)]


@pytest.mark.parametrize(("stages", "block_docs", "team_items"), [(4, 4096, 256), (3, 7, 3), (1, 20, 256), (8, 1, 1)])
def test_equals_brute_force(spark, docs, texts, stages, block_docs, team_items):
    items = items_of(texts)
    more = spark.createDataFrame([(None, texts[10][1]), (10, "one two"), (10, "one two"), (10, "one three")], "doc_id long, text string")
    both = docs.select("doc_id", "text").unionByName(more)
    asked = spark.createDataFrame([(i, t, 1, 2) for i, t in items], "item_id long, text string, row long, term long").repartition(3)
    got = ranked_search.rank(both, asked, k=5, stages=stages, block_docs=block_docs, team_items=team_items)
    assert sorted(map(tuple, got.collect()), key=repr) == brute([tuple(r) for r in both.collect()], items, 5)


def test_empty_tables(spark, docs, empty):
    none = spark.createDataFrame([], "item_id long, text string")
    one = spark.createDataFrame([(1, "one")], "item_id long, text string")
    assert ranked_search.rank(docs, none).collect() == []
    assert ranked_search.rank(empty, one).collect() == []
    assert ranked_search.rank(docs, spark.createDataFrame([(1, "zzzz9")], "item_id long, text string")).collect() == []


def test_query_equals_sql(spark):
    oracle.compare(spark, queries.QUERIES["op12_ranked_search"], queries.ORACLES["op12_ranked_search"])
