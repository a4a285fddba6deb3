"""Landing folders of very many small files."""

from wattlake.plans.jobs import Lake, ingest_bronze
from wattlake.schemas import BRONZE
from wattlake.sources import files, tables


def test_many_small_files_take_few_tasks(spark, tmp_path):
    """Files in a folder each, more than Spark lists on the driver, are listed and read by some tasks a core, and settings come back."""
    for i in range(300):
        (tmp_path / "mix" / f"f{i}").mkdir(parents=True)
        (tmp_path / "mix" / f"f{i}" / "a.json").write_text('{"zone": "FR", "data": [{}]}')
    keys = ["spark.sql.sources.parallelPartitionDiscovery.parallelism", "spark.sql.files.openCostInBytes"]
    before = [spark.conf.get(k) for k in keys]
    lake, none = Lake(spark, str(tmp_path / "lake")), spark.createDataFrame([], "raw_json string")
    tracker, seen = spark.sparkContext.statusTracker(), []
    tasks = spark.sparkContext.defaultParallelism * 4
    from wattlake.sources.landing import many_small_files, new_files, read_files
    with many_small_files(spark):
        spark.sparkContext.setJobGroup("listing", "listing")
        found = new_files(spark, str(tmp_path / "mix"), str(tmp_path / "landed"), none)
        assert read_files(spark, found).rdd.getNumPartitions() <= tasks
    for job in tracker.getJobIdsForGroup("listing"):
        seen += [tracker.getStageInfo(s).numTasks for s in tracker.getJobInfo(job).stageIds if tracker.getStageInfo(s)]
    assert len(found) == 300 and seen and max(seen) <= tasks
    assert [spark.conf.get(k) for k in keys] == before
    assert [ingest_bronze(lake, str(tmp_path / "mix"), none, n)["mix_records"] for n in (1, 2)] == [300, 0]
    assert [spark.conf.get(k) for k in keys] == before
    assert tables.read_table(spark, lake.path("bronze", "electricity_mix"), BRONZE).count() == 300
    assert next(files.iterate_names(spark, str(tmp_path / "mix"))).startswith("f")


def test_new_files_are_read_through_their_listing(spark, tmp_path):
    """A run's new files are not named one by one to Spark, and files landed before are not opened. Those that came late, by their time of
    change, and compressed ones land as well, and each file lands once."""
    import gzip
    import os
    import time
    from wattlake.sources.landing import many_small_files, new_files, read_files
    lake, none = Lake(spark, str(tmp_path / "lake")), spark.createDataFrame([], "raw_json string")
    landed, mix = lake.path("state", "landed_mix_files"), tmp_path / "mix"
    finished = spark.createDataFrame([(1,)], "process_ts bigint")

    def put(name, content, age=0.0):
        file = mix / name
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_bytes(content)
        os.utime(file, (time.time() - age,) * 2)

    def rows(n):
        found = tables.read_table(spark, lake.path("bronze", "electricity_mix"), BRONZE).where(f"process_ts = {n}")
        return sorted(bytes.fromhex(r[0]) for r in found.selectExpr("hex(raw_json)").collect())

    first = {f"a/{i}.json": b'{"zone": "FR", "data": [%d]}\n' % i for i in range(40)}
    first |= {"odd[1] {2,3}*?.json": b'{"zone": "DE"}\r\n', "b/bytes.json": b"\xef\xbb\xbf\xff\x00\r", "c.json.gz": gzip.compress(b"packed 1")}
    for name, content in first.items():
        put(name, content, 1000)
    put("empty.json", b"", 1000)
    plain = sorted(b"packed 1" if name.endswith(".gz") else content for name, content in first.items())
    with many_small_files(spark):
        found = new_files(spark, str(mix), landed, finished)
        scan = read_files(spark, found)._jdf.queryExecution().executedPlan().toString()
    assert len(found) == len(first) and "(1 paths)" in scan and "(43 paths)" not in scan
    ingest_bronze(lake, str(mix), none, 1)
    assert rows(1) == plain

    put("a/new.json", b"new", 500)
    put("a/0.json", b"changed", 500)
    put("late[1].json", b"late", 2000)
    put("late.json.gz", gzip.compress(b"packed 2"), 2000)
    put("d.json.gz", gzip.compress(b"packed 3"), 500)
    with many_small_files(spark):
        found = new_files(spark, str(mix), landed, finished)
        (mix / "a/1.json").unlink()
        assert len(found) == 5 and found.recent.rdd.getNumPartitions() <= 3
        assert sorted(r.raw_json for r in read_files(spark, found).collect()) == ["changed", "late", "new", "packed 2", "packed 3"]
    assert sorted(p.rsplit("/", 1)[1] for p, _ in found.late) == ["late.json.gz", "late[1].json"]
    for n in (2, 3):
        ingest_bronze(lake, str(mix), none, n)
    assert rows(1) == plain and rows(2) == sorted([b"new", b"changed", b"late", b"packed 2", b"packed 3"]) and rows(3) == []
    kept = spark.read.parquet(landed).groupBy("process_ts").count().collect()
    assert sorted(map(tuple, kept)) == [(1, len(first)), (2, 5)]


def test_a_file_for_each_document(spark, tmp_path):
    """The landing files of the query: no checksum files or processes for them, the same contents as Spark's writer gives."""
    from wattlake.catalog.payloads import _write_each
    docs = spark.createDataFrame(
        [("FR", 1, '{"a": "é"}'), ("FR", 3, "x"), ("IT-NO", 1, ""), (None, 5, None), ("FR", -1, "y\nz")], "zone string, page long, raw_json string")

    def contents(path):
        return sorted((f.parent.name, f.read_bytes()) for f in path.rglob("*") if f.is_file() and f.name[0] not in "._")

    docs.select("zone", "raw_json").write.partitionBy("zone").option("maxRecordsPerFile", 1).text(str(tmp_path / "spark"))
    for _ in range(2):  # a task that is repeated
        _write_each(docs, str(tmp_path / "each"))
        assert contents(tmp_path / "each") == contents(tmp_path / "spark")
    assert not [f for f in (tmp_path / "each").rglob(".*")]
    _write_each(docs.limit(0), str(tmp_path / "none"))
    assert (tmp_path / "none").is_dir()
