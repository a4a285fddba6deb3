"""A silver stream writes each touched day once, however many micro-batches there are."""

import json

import pytest
from pyspark.sql import functions as F

from wattlake import schemas as S
from wattlake.sources import tables
from wattlake.sources.publish import Publication
from wattlake.streaming import jobs


@pytest.mark.parametrize("keep, want", [("latest", 3.0), ("incoming", 1.0)])
def test_days_are_written_once_a_run(spark, tmp_path, mix_payload, monkeypatch, keep, want):
    written, replace = [], Publication.replace

    def counted(self, *args, **values):
        written.append(1)
        return replace(self, *args, **values)

    monkeypatch.setattr(Publication, "replace", counted)
    bronze, path, bad, checkpoint = (str(tmp_path / n) for n in ("bronze", "silver", "bad", "cp"))

    def deliver(nuclear, updated):
        mix_payload["data"][0]["mix"]["nuclear"], mix_payload["data"][0]["updatedAt"] = nuclear, updated
        rows = spark.createDataFrame([(1, "AT", json.dumps(mix_payload))], "process_ts long, zone string, raw_json string")
        rows.coalesce(1).write.mode("append").parquet(bronze)

    def run():
        schema = "process_ts long, zone string, raw_json string"
        found = []
        jobs.stream_silver(jobs.stream_files(spark, bronze, schema, files_per_batch=1), "mix", path, bad, checkpoint, keep, found.append)
        table = tables.read_table(spark, path, S.SILVER_MIX)
        return [r.nuclear_mw for r in table.collect()], found

    for nuclear, day in ((2.0, 24), (3.0, 25), (1.0, 23)):
        deliver(nuclear, f"2026-04-{day}T00:00:00Z")
    rows, days = run()
    assert rows == [want] and len(days) == 1 and len(written) == 1
    assert run() == ([want], [])  # nothing new, nothing written
    # what a stopped run has staged is taken by the next one
    with monkeypatch.context() as patch:
        patch.setattr(jobs, "upsert_staged", lambda *args: 1 / 0)
        deliver(5.0, "2026-04-26T00:00:00Z")
        with pytest.raises(ZeroDivisionError):
            run()
    assert run()[0] == [5.0] and len(written) == 2
    assert spark.read.parquet(bronze).select(F.count("*")).first()[0] == 4
