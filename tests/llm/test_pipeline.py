"""The pipeline's stages against brute force, and that clean documents stay."""

import random
import re

import pytest

import corpus_pipeline as cp
from courtlake.llm.common import stored


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(11)
    words = ["".join(rng.choice("abcdefghijk") for _ in range(rng.randint(3, 8))) for _ in range(4000)]
    say = lambda n: [rng.choice(words) for _ in range(n)]
    rows, labels = [], []
    item = say(30)
    passage = say(80)
    for i in range(400):
        own = say(120)
        if i % 8 == 7:
            for k in range(6):
                own.insert(rng.randrange(len(own)), f"vile{k}")
            labels.append((i, 1, 1))
        elif i < 300:
            labels.append((i, 1, 0))
        if i in (100, 201):
            own[10:10] = item
        if i in (50, 60, 70):
            own[40:40] = passage
        rows.append((i, " ".join(own), "en", "s", 0))
    rows += [(1000 + k, rows[k][1], "en", "s", 0) for k in (2, 3)]
    rows += [(1010, " ".join(rows[4][1].split()[:-1]), "en", "s", 0), (1011, None, None, None, None), (1012, "", None, None, 0), (1013, passage and " ".join(passage), None, None, 0), rows[5]]
    at = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(4).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    spark.createDataFrame([(1, " ".join(item)), (2, None)], "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    return at, {i: t for i, t, *_ in rows}


def test_stages(spark, folder):
    at, texts = folder
    docs = spark.read.parquet(f"{at}/documents.parquet")
    kept = {}
    for name, stage in cp.STAGES:
        docs = stored(stage(spark, docs, at))
        kept[name] = docs
        if name != "best_fit_packing":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    ids = {name: [r.doc_id for r in df.select("doc_id").collect()] for name, df in kept.items()}
    toxic = {i for i in range(400) if i % 8 == 7}
    assert set(ids["toxicity"]) == set(texts) - toxic
    near = set(texts) - toxic - {1002, 1003, 1010}
    assert sorted(ids["ngram_jaccard_join"]) == sorted(near)
    assert set(ids["substring_dedup"]) == near - {1013}
    left = {r.doc_id: r.text for r in kept["substring_dedup"].collect()}
    cut = {i for i in left if left[i] != texts[i]}
    assert cut == {60, 70} and all(len(left[i].split()) == 120 for i in cut)
    assert set(ids["benchmark_decontamination"]) == near - {1013, 100, 201}
    assert set(ids["best_fit_packing"]) == set(ids["benchmark_decontamination"])


def test_run_equals_stages(spark, folder):
    at, _ = folder
    rows = cp.run(spark, at).collect()
    assert len(rows) == len({(r.doc_id, r.piece) for r in rows}) and all(re.fullmatch(r"\d+", str(r.sequence_id)) for r in rows)


def test_empty_tables(spark, folder, tmp_path):
    at, _ = folder
    for t in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{at}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert cp.run(spark, str(tmp_path)).count() == 0
