"""Outputs of a date appear together or not at all; counts come from the writing pass."""

import os

import pytest
from pyspark.sql import functions as F

from visitrec.plans import IVP, PACKETS, run_day, verdict_mask, verdicts
from visitrec.plans.daily import Batch as DailyBatch
from visitrec.sinks import Batch, push_folder, read_manifest, write_csv_if_any
from visitrec.sources import read_push_list

from test_files import DAY, all_packets, every_form, landing, local_visits, lines  # noqa: F401
from test_packets import pull


def rows(spark, n, note="x"):
    return spark.range(n).select(F.col("id").cast("string").alias("k"), F.lit(note).alias("note"))


def test_published_together_with_a_manifest(spark, tmp_path):
    with Batch(spark, str(tmp_path), DAY) as batch:
        first = batch.csv(rows(spark, 5), "a.csv")
        assert batch.csv_if_any(rows(spark, 0), "none.csv") is None
        second = batch.csv_if_any(rows(spark, 3), "b.csv")
        text = batch.text(rows(spark, 2), [("k", 2, ".")], "c.txt")
        assert not os.path.exists(push_folder(str(tmp_path), DAY))
    assert [read_push_list(spark, p).count() for p in (first, second)] == [5, 3]
    assert sorted(lines(text)) == ["0.", "1."]
    manifest = read_manifest(spark, push_folder(str(tmp_path), DAY))
    assert manifest == {
        "run_date": DAY,
        "files": [{"name": "a.csv", "rows": 5}, {"name": "b.csv", "rows": 3}, {"name": "c.txt", "rows": 2}],
    }
    assert os.listdir(tmp_path) == [f"push_{DAY}"]


def test_a_failed_write_leaves_the_older_batch(spark, tmp_path):
    with Batch(spark, str(tmp_path), DAY) as batch:
        older = batch.csv(rows(spark, 4, "older"), "a.csv")
        batch.csv(rows(spark, 1, "older"), "gone.csv")
    bad = rows(spark, 9).withColumn("note", F.when(F.col("k") == "7", F.raise_error(F.lit("dies"))).otherwise("y"))
    with pytest.raises(Exception, match="dies"):
        with Batch(spark, str(tmp_path), DAY) as batch:
            batch.csv(rows(spark, 2, "newer"), "a.csv")
            batch.csv(bad, "b.csv")
    assert {r.note for r in read_push_list(spark, older).collect()} == {"older"}
    names = {name for name in os.listdir(push_folder(str(tmp_path), DAY)) if not name.startswith(".")}
    assert names == {"_manifest.json", "a.csv", "gone.csv"}
    with Batch(spark, str(tmp_path), DAY) as batch:
        batch.csv(rows(spark, 2, "newer"), "a.csv")
    assert {r.note for r in read_push_list(spark, older).collect()} == {"newer"}
    assert not os.path.exists(f"{push_folder(str(tmp_path), DAY)}/gone.csv")
    assert os.listdir(tmp_path) == [f"push_{DAY}"]


def test_write_if_any_is_one_pass(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    df = rows(spark, 40).mapInArrow(counted, "k string, note string")
    assert write_csv_if_any(df, str(tmp_path / "some")) == str(tmp_path / "some")
    assert seen.value == 40 and read_push_list(spark, str(tmp_path / "some")).count() == 40
    assert write_csv_if_any(df.filter("k = 'z'"), str(tmp_path / "none")) is None
    assert os.listdir(tmp_path) == ["some"]


def dictionary_of_all():
    out = {}
    for rule in PACKETS:
        out.update({form: fields for form, fields in every_form(rule).items() if fields or form not in out})
    return out


def test_a_day_that_dies_publishes_nothing(spark, tmp_path, local_visits, landing, monkeypatch):  # noqa: F811
    written = []
    whole = DailyBatch.csv

    def dies(self, df, name):
        written.append(name)
        if len(written) == 4:
            raise RuntimeError("killed")
        return whole(self, df, name)

    monkeypatch.setattr(DailyBatch, "csv", dies)
    with pytest.raises(RuntimeError, match="killed"), pytest.warns(UserWarning):
        run_day(spark, landing, local_visits, all_packets(spark), dictionary_of_all(), f"{tmp_path}/out", DAY)
    assert len(written) == 4 and os.listdir(tmp_path / "out") == []


def test_a_day_reads_the_records_once(spark, tmp_path, local_visits, landing):  # noqa: F811
    seen = spark.sparkContext.accumulator(0)
    records = all_packets(spark)
    count = records.count()

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    with pytest.warns(UserWarning):
        out, packets = run_day(
            spark, landing, local_visits, records.mapInArrow(counted, records.schema), dictionary_of_all(),
            str(tmp_path / "out"), DAY,
        )
    assert seen.value == count
    files = {f["name"]: f["rows"] for f in read_manifest(spark, push_folder(str(tmp_path / "out"), DAY))["files"]}
    for packet in packets.values():
        for path in (packet.ready, packet.blocked):
            assert files[os.path.basename(path)] == read_push_list(spark, path).count()
    assert files[os.path.basename(out.push_list)] == read_push_list(spark, out.push_list).count() > 0


def test_mask_has_a_bit_for_each_gate(spark):
    statuses = [("p", {}), ("q", {"ivp_b4_complete": "1"}), ("r", {"ivp_b4_complete": None})]
    records = pull(spark, IVP, statuses)
    masks = {r.ptid: r.mask for r in records.select("ptid", verdict_mask([IVP]).alias("mask")).collect()}
    assert masks == {"p": 1, "q": 2, "r": 0}
    assert sorted((r.ptid, r.verdict) for r in verdicts(records, [IVP]).collect()) == [("p", "ready"), ("q", "blocked")]
    unrouted = verdicts(records, [IVP], {"ivp": F.col("ptid") == "q"})
    assert [(r.ptid, r.verdict) for r in unrouted.collect()] == [("q", "blocked")]
    assert unrouted.columns == [*records.columns, "packet", "verdict"]
