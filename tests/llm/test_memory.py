"""What a task holds outside the JVM's heap: batches, work arrays and caches of bounded bytes."""

import public_tokenizers
import pyarrow as pa

from courtlake.llm import packing, substring, toxicity
from courtlake.llm import words as w
from courtlake.llm.common import numbered


def test_session_gets_batches_of_a_megabyte(spark, docs):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)
    spark.conf.unset(name)
    try:
        numbered(docs, "doc_id", "text")
        assert int(spark.conf.get(name)) <= 1 << 20
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def test_blocks_come_in_batches_of_about_a_megabyte():
    texts = [f"{k} " + "some words " * 2000 for k in range(200)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(200), pa.int64()), pa.array(texts)], ["doc_id", "text"])
    out = list(substring._blocks([batch], 5, 46))
    assert max(b.nbytes for b in out) < 1_200_000
    rows = [(r["doc_id"], r["block"]) for b in out for r in b.to_pylist()]
    assert len(rows) == len(set(rows)) and {d for d, _ in rows} == set(range(200))


def test_features_do_not_depend_on_the_passes_and_passes_are_small():
    texts = pa.array([f"word{k} again again {k % 7} " * 400 for k in range(60)])
    whole = [(first + d, f) for first, _last, data, offsets in w.chunks(texts, 1 << 30) for d, f in zip(*map(list, toxicity.text_features(data, offsets)), strict=True)]
    cut = [(first + d, f) for first, _last, data, offsets in w.chunks(texts, toxicity.FEATURE_BYTES) for d, f in zip(*map(list, toxicity.text_features(data, offsets)), strict=True)]
    assert whole == cut
    assert toxicity.FEATURE_BYTES <= 1 << 16


def test_cache_of_words_stays_small_and_changes_no_ids(monkeypatch):
    assert packing.CACHE_WORDS <= 1 << 18
    path = public_tokenizers.path("word_bpe_49k.json")
    texts = [f"these words and word{k}x are met again" for k in range(300)]
    kept = packing.Encoder(path).encode(texts)
    monkeypatch.setattr(packing, "CACHE_WORDS", 20)
    small = packing.Encoder(path)
    assert [small.encode([t])[0] for t in texts] == kept and len(small.known) < 40
