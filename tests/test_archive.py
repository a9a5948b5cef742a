"""The incremental archive: only new files are read, corrupt ones are set aside, a repeated batch changes nothing."""

import gzip
import json

from courtlake.sources import files
from courtlake.streaming import archive


def page(folder, i, text=None, broken=False):
    raw = gzip.compress((text or f"<p>page {i} é</p>").encode())
    (folder / f"2020_SGHC_{i}.html.gz").write_bytes(raw[:-9] if broken else raw)


def test_a_second_run_reads_only_new_files(spark, tmp_path):
    source, target = tmp_path / "in", str(tmp_path / "out")
    (source / "sub").mkdir(parents=True)
    for i in range(200):
        page(source if i % 2 else source / "sub", i, broken=i in (7, 8))
    (source / "plain.html").write_text("<p>plain</p>")
    (source / "latin.html").write_bytes(b"\xff\xfe<p>")
    assert archive.ingest_pages(spark, str(source), target, buckets=4) == {"batches": 1, "files": 202}
    assert archive.ingest_pages(spark, str(source), target, buckets=4) == {"batches": 0, "files": 0}
    for i in range(200, 210):
        page(source, i)
    assert archive.ingest_pages(spark, str(source), target, buckets=4)["files"] == 10
    got = {r.id: (r.html, r.batch) for r in archive.read_archive(spark, target).collect()}
    assert got == {f"2020_SGHC_{i}": (f"<p>page {i} é</p>", int(i >= 200)) for i in range(210) if i not in (7, 8)} | {"plain": ("<p>plain</p>", 0)}
    bad = {r.id: r.reason.split(":")[0] for r in archive.read_corrupt(spark, target).collect()}
    assert bad == {"2020_SGHC_7": "gzip", "2020_SGHC_8": "gzip", "latin": "utf-8"}
    assert len(list((tmp_path / "out/good/batch=0").glob("bucket=*/*.parquet"))) == 4
    some = archive.archived(spark, target, ["2020_SGHC_3", "2020_SGHC_205", "none"], buckets=4)
    assert sorted(r.id for r in some.collect()) == ["2020_SGHC_205", "2020_SGHC_3"]


def test_batches_are_bounded_and_a_repeated_batch_writes_the_same(spark, tmp_path):
    source, target = tmp_path / "in", tmp_path / "out"
    source.mkdir()
    for i in range(30):
        page(source, i)
    assert archive.ingest_pages(spark, str(source), str(target), files=10) == {"batches": 3, "files": 30}
    last = sorted((target / "log/commits").glob("[0-9]*"))[-1]
    last.unlink()  # as if the driver had died between the write and the commit
    (target / "log/commits" / f".{last.name}.crc").unlink(missing_ok=True)
    archive.ingest_pages(spark, str(source), str(target), files=10)
    rows = archive.read_archive(spark, str(target))
    assert rows.count() == rows.select("id").distinct().count() == 30


def test_json_caches(spark, tmp_path):
    source, target = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    for i in range(20):
        text = json.dumps({"judgment_id": f"j{i}", "summary": "s" * i, "frags_total": i}, indent=1)
        (source / f"j{i}.json").write_text(text[:12] if i % 5 == 4 else text)
    (source / "list.json").write_text("[1, 2]")
    assert archive.ingest_summaries(spark, str(source), target)["files"] == 21
    assert {r.id: (r.judgment_id, r.summary, r.frags_total) for r in archive.read_archive(spark, target).collect()} == {f"j{i}": (f"j{i}", "s" * i, i) for i in range(20) if i % 5 < 4}
    assert {(r.id, r.reason) for r in archive.read_corrupt(spark, target).collect()} == {(f"j{i}", "json") for i in range(4, 20, 5)} | {("list", "json")}


def test_an_empty_archive(spark, tmp_path):
    (tmp_path / "in").mkdir()
    assert archive.ingest_pages(spark, str(tmp_path / "in"), str(tmp_path / "out")) == {"batches": 0, "files": 0}
    assert archive.read_archive(spark, str(tmp_path / "out")).count() == archive.read_corrupt(spark, str(tmp_path / "out")).count() == 0


def test_few_tasks_open_many_files_and_corrupt_ones_share_a_file(spark, tmp_path, monkeypatch):
    source, target, tasks, opened = tmp_path / "in", tmp_path / "out", [], archive._opened
    source.mkdir()
    for i in range(600):
        page(source, i, broken=i % 9 == 0)
    monkeypatch.setattr(archive, "_opened", lambda batch, name: tasks.append(batch.rdd.getNumPartitions()) or opened(batch, name))
    assert archive.ingest_pages(spark, str(source), str(target), buckets=4) == {"batches": 1, "files": 600}
    assert tasks[0] <= spark.sparkContext.defaultParallelism + 1
    assert len(list(target.glob("corrupt/batch=0/*.parquet"))) == 1
    assert archive.read_archive(spark, str(target)).count() == 533
    assert archive.read_corrupt(spark, str(target)).count() == 67


def test_each_row_is_a_file_of_its_own_in_any_store(spark, tmp_path):
    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.each.link./at", f"file://{tmp_path}")
    rows = spark.createDataFrame([(str(i), f"é {i}\nline") for i in range(300)], "id string, value string")
    for at in (f"file://{tmp_path}/local", "viewfs://each/at/other"):
        for part in ("id < 200", "id >= 200"):
            files.write_each(rows.filter(part), at)
        made = list((tmp_path / at.split("/")[-1]).glob("shard=*/**/*.gz"))
        assert len(made) == 300
        archive.ingest_pages(spark, at, f"{at}-out", buckets=4, name=files.EACH_NAME, glob=files.EACH_GLOB)
        assert {r.id: r.html for r in archive.read_archive(spark, f"{at}-out").collect()} == {str(i): f"é {i}\nline\n" for i in range(300)}
    assert len(list((tmp_path / "local").glob("shard=*/*.gz"))) == 300  # no folder for each id, no checksum files
    assert not list((tmp_path / "local").glob("**/*.crc"))


def test_rows_of_one_id_stay_apart_and_a_repeated_write_adds_nothing(spark, tmp_path):
    rows = spark.createDataFrame([("7", "a"), ("8", "b"), ("7", "c")], "id string, value string")
    for _ in range(2):
        files.write_each(rows.repartition("id"), str(tmp_path / "in"))
    got = sorted((f.name, gzip.decompress(f.read_bytes())) for f in (tmp_path / "in").glob("*/*.gz"))
    assert [n for n, _ in got] == ["id=7.0.txt.gz", "id=7.1.txt.gz", "id=8.0.txt.gz"]
    assert sorted(v for _, v in got) == [b"a\n", b"b\n", b"c\n"]


def test_a_run_of_many_files_is_cut_into_batches_that_are_all_counted(spark, tmp_path, monkeypatch):
    source, target = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    for i in range(30):
        page(source, i)
    bound = archive.ingest_pages.__defaults__[1]
    assert bound is not None and bound <= 50_000
    monkeypatch.setattr(archive.ingest_pages, "__defaults__", (64, 10, *archive.ingest_pages.__defaults__[2:]))
    kept = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", 2)
    try:
        assert archive.ingest_pages(spark, str(source), target, buckets=4) == {"batches": 3, "files": 30}
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", kept)
    assert archive.read_archive(spark, target).count() == 30
