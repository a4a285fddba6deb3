"""Streaming forms against the batch results."""

import copy
import json

from pyspark.sql import functions as F

from wattlake import schemas as S
from wattlake.operators import products
from wattlake.plans.jobs import Lake, publish_days
from wattlake.sources import tables
from wattlake.streaming import jobs


def test_landing_to_gold_as_streams(spark, tmp_path, mix_payload, flows_payload):
    lake = Lake(spark, str(tmp_path / "lake"))
    landing = tmp_path / "landing"
    for kind in ("mix", "flows"):
        (landing / kind).mkdir(parents=True)

    def deliver(name, nuclear, updated):
        doc = copy.deepcopy(mix_payload)
        doc["data"][0]["mix"]["nuclear"], doc["data"][0]["updatedAt"] = nuclear, updated
        (landing / "mix" / f"{name}.json").write_text(json.dumps(doc))

    def run():
        for kind in ("mix", "flows"):
            stream = jobs.stream_files(spark, str(landing / kind), format="text", wholetext=True)
            bronze = lake.path("bronze", f"electricity_{kind}")
            jobs.land_bronze(stream.select(F.col("value").alias("raw_json")), bronze, f"{tmp_path}/cp/b{kind}",
                             f"electricity-{kind}", process_ts=1)
            jobs.stream_silver(
                jobs.stream_files(spark, bronze, S.BRONZE), kind, lake.path("silver", f"electricity_{kind}"),
                lake.path("silver", f"silver_{kind}_bad_data"), f"{tmp_path}/cp/s{kind}",
                then=lambda days: publish_days(lake, days, 3) if days else None)

    def nuclear():
        return tables.read_table(spark, lake.path("silver", "electricity_mix"), S.SILVER_MIX).first().nuclear_mw

    deliver("one", 1.0, "2026-04-24T00:00:00Z")
    (landing / "flows" / "one.json").write_text(json.dumps(flows_payload))
    (landing / "mix" / "broken.json").write_text("{ no json")
    run()
    assert nuclear() == 1.0
    # files seen before are not taken again; a newer update replaces, an older one does not
    deliver("two", 2.0, "2026-04-25T00:00:00Z")
    run()
    assert nuclear() == 2.0
    deliver("three", 3.0, "2026-04-23T00:00:00Z")
    run()
    assert nuclear() == 2.0
    assert tables.read_table(spark, lake.path("bronze", "electricity_mix"), S.BRONZE).count() == 4
    bad = spark.read.schema(S.BAD_DATA).parquet(lake.path("silver", "silver_mix_bad_data"))
    assert [r.error_message for r in bad.collect()] == ["MALFORMED_JSON"]
    gold = tables.read_table(spark, lake.path("gold", "daily_imports"), S.GOLD_IMPORTS)
    assert {r.source_zone: r.import_mwh for r in gold.collect()} == {"DE": 702.5, "CZ": 150.0}
    silver = tables.read_table(spark, lake.path("silver", "electricity_mix"), S.SILVER_MIX)
    want = products.daily_mix(silver, 3).first()
    assert tables.read_table(spark, lake.path("gold", "daily_electricity_mix"), S.GOLD_MIX).first() == want


def test_replays_are_dropped_across_runs(spark, tmp_path):
    rows = spark.sql("SELECT id, timestamp'2024-01-01 00:00:00' + make_interval(0,0,0,0,0,id,0) AS t FROM range(50)")

    def run():
        stream = jobs.drop_replays(jobs.stream_files(spark, f"{tmp_path}/in", rows.schema), ["id"], "t", "1 day")
        jobs.append_parquet(stream, f"{tmp_path}/out", f"{tmp_path}/cp")

    for _ in range(2):
        rows.write.mode("append").parquet(f"{tmp_path}/in")
        run()
    assert spark.read.schema(rows.schema).parquet(f"{tmp_path}/out").count() == 50


def test_late_rows_count_until_the_day_is_closed(spark, tmp_path):
    schema = "zone string, t timestamp, mw double"

    def deliver(*rows):
        spark.createDataFrame(rows, "zone string, t string, mw double").select(
            "zone", F.col("t").cast("timestamp").alias("t"), "mw").write.mode("append").parquet(f"{tmp_path}/in")
        stream = jobs.daily_windows(
            jobs.stream_files(spark, f"{tmp_path}/in", schema), ["zone"], "t", "6 hours", {"mwh": F.sum("mw")})
        jobs.append_parquet(stream, f"{tmp_path}/out", f"{tmp_path}/cp")
        found = spark.read.schema(stream.schema).parquet(f"{tmp_path}/out").collect()
        return {(str(r.date), r.mwh, r.hours_covered) for r in found}

    assert deliver(("FR", "2024-01-01 10:00:00", 1.0), ("FR", "2024-01-01 23:00:00", 2.0)) == set()
    assert deliver(("FR", "2024-01-02 03:00:00", 4.0), ("FR", "2024-01-01 10:30:00", 8.0)) == set()
    assert deliver(("FR", "2024-01-02 07:00:00", 16.0)) == {("2024-01-01", 11.0, 2)}


def test_latest_rows_of_a_stream_in_any_order(spark, tmp_path):
    source, checkpoint = str(tmp_path / "in"), str(tmp_path / "checkpoint")
    batches = [
        [("a", "2024-01-01 10:00:00", 1), ("b", "2024-01-01 12:00:00", 2), ("a", "2024-01-01 09:00:00", 3), ("n", None, 9)],
        [("a", "2024-01-01 08:00:00", 4), ("b", "2024-01-01 12:00:00", 1), ("c", "2024-01-01 11:30:00", 5), ("b", "2024-01-01 13:00:00", None)],
        [("z", "2024-03-01 00:00:00", 7)], [("z", "2024-03-01 01:00:00", 8)]]
    states, given = [], []

    def write(batch, batch_id):
        given.append(sorted((r.k, str(r.at), r.v) for r in batch.collect()))

    for rows in batches:
        df = spark.createDataFrame([(k, t, v) for k, t, v in rows], "k string, at string, v int")
        df.withColumn("at", F.col("at").cast("timestamp")).write.mode("append").parquet(source)
        latest = jobs.latest_rows(jobs.stream_files(spark, source, spark.read.parquet(source).schema), ["k"], "at", ["at", "v"], "1 hours")
        with jobs.state_on_disk(spark):
            query = jobs.run_available(latest.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint))
        states.append([p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]][-1])
    rows = [r for batch in given for r in batch]
    assert rows[:2] == [("a", "2024-01-01 10:00:00", 1), ("b", "2024-01-01 12:00:00", 2)]
    assert sorted(rows[2:4]) == [("b", "2024-01-01 13:00:00", None), ("c", "2024-01-01 11:30:00", 5)]
    assert rows[4:] == [("z", "2024-03-01 00:00:00", 7), ("z", "2024-03-01 01:00:00", 8)]
    assert max(states[:2]) > states[-1]  # the keys of January are forgotten
