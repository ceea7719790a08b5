"""Readers, writers, landing and the streaming sync."""

from datetime import date
from pathlib import Path

import pytest
from conftest import rows
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from basketry import work_dir
from basketry.operators.clean import SALES_COLUMNS, incremental_sync
from basketry.plans import jobs
from basketry.schemas import CLUSTER_RECS, RAW_TICKETS, SALES_VALUE
from basketry.sources import landing, ledger, months, readers, writers
from basketry.streaming import sync

LINES = f"date_sale date, id_client string, product string, {SALES_VALUE} double, amount double, line int"


def test_missing_table_is_an_error_or_none(spark, tmp_path):
    with pytest.raises(AnalysisException):
        readers.scan_parquet(spark, str(tmp_path / "none"))
    assert readers.load_recs_optional(spark, str(tmp_path / "none")) is None
    assert readers.load_catalog_wide(spark, str(tmp_path / "none")) is None
    with pytest.raises(FileNotFoundError):
        readers.scan_vip(spark, str(tmp_path / "a"), str(tmp_path / "b"))
    assert readers.empty_table(spark, CLUSTER_RECS).schema == CLUSTER_RECS


def test_catalog(spark, tmp_path):
    path = tmp_path / "c.csv"
    path.write_text("codigo_unico,description,category\n001,b,x\n 001 ,a,y\n2,,z\n")
    assert rows(readers.load_catalog(spark, str(path))) == [("001", "a"), ("2", None)]
    assert readers.load_catalog_wide(spark, str(path)).count() == 2
    path.write_text("code,description\n1,a\n")
    with pytest.raises(KeyError):
        readers.load_catalog(spark, str(path))


def test_csv_numbers_and_dates(spark, tmp_path, day):
    df = spark.createDataFrame([(day("2024-01-02"), 0.5, ["x"]), (day("2024-01-01"), None, [])], "date date, prob double, items array<string>")
    writers.sink_csv(df, str(tmp_path / "out"), [F.asc("date")])
    back = spark.read.option("header", True).csv(str(tmp_path / "out"))
    assert rows(back, "date", "prob") == [("2024-01-01", None), ("2024-01-02", "0.5000")]


def tickets(spark, day, data):
    return spark.createDataFrame([(i, day(d), "1234570", 1.0, "S", "N", [("p", 1.0, 1.0, 0.0)]) for i, d in data], RAW_TICKETS)


def test_landing_skips_known_and_future_months(spark, day):
    df = tickets(spark, day, [(1, "2024-01-05"), (1, "2024-01-05"), (2, "2024-02-05"), (3, "2024-04-01")])
    landed = spark.createDataFrame([("2024-01",)], "month string")
    today = F.lit(day("2024-03-10"))
    assert rows(landing.months_to_land(df, landed, today), "ID", "month") == [(2, "2024-02")]
    assert rows(landing.months_to_land(df, landed, today, force=True), "ID") == [(1,), (2,)]
    missing = landing.landing_coverage(df, F.lit(day("2024-02-04")), F.lit(day("2024-02-07")))
    assert rows(missing) == [(day("2024-02-04"),), (day("2024-02-06"),)]


def test_overwrite_touches_only_its_months(spark, day, tmp_path):
    path = str(tmp_path / "t")
    one = spark.createDataFrame([("2024-01", 1), ("2024-02", 1)], "month string, v int")
    writers.overwrite_partitions(one, path, ["month"])
    writers.overwrite_partitions(one.where("month = '2024-02'").withColumn("v", F.lit(2)), path, ["month"])
    assert rows(spark.read.parquet(path).select(F.col("month").cast("string"), "v")) == [("2024-01", 1), ("2024-02", 2)]


def batches(spark, day):
    one = [(day("2024-03-01"), "c", "p", 1.0, 1.0, 1), (day("2023-01-01"), "c", "p", 1.0, 1.0, 1)]
    two = [(day("2024-03-01"), "c", "p", 0.1, 1.0, 2), (day("2024-03-02"), "c", "q", 2.0, 1.0, 2), (day("2024-03-02"), "c", "q", 1.0, 1.0, 1)]
    return spark.createDataFrame(one, LINES), spark.createDataFrame(two, LINES)


def test_stream_equals_batch(spark, day):
    base = work_dir(spark, "sync")
    one, two = batches(spark, day)
    for part in (one, two, two.limit(0)):
        part.write.mode("append").parquet(f"{base}/in")
        sync.start_sync(spark, f"{base}/in", one.schema, f"{base}/out", f"{base}/state", ["line"]).awaitTermination()
    got = months.read_months(spark, f"{base}/out", 6)
    assert rows(got) == rows(incremental_sync(one, two, 6, ["line"])) != []


def files(path):
    """Data files below a folder with the time of their last change."""
    return {f: f.stat().st_mtime_ns for f in Path(path).rglob("*.parquet")}


def test_merge_touches_only_its_months(spark, day):
    base = work_dir(spark, "merge")
    target, state = f"{base}/out", f"{base}/state"
    one, two = batches(spark, day)
    assert months.merge_months(one, "a", target, state, ["line"]) == ["2023-01", "2024-03"]
    before = files(target)
    assert months.merge_months(two, "b", target, state, ["line"]) == ["2024-03"]
    after = files(target)
    old = {f: t for f, t in before.items() if "2023-01" in str(f)}
    assert old and old.items() <= after.items(), "the other month keeps its files"
    assert not {f for f in before if "2024-03" in str(f)} & set(after)
    want = rows(incremental_sync(one, two, 1000, ["line"]))
    assert rows(spark.read.parquet(target), *SALES_COLUMNS) == want
    # A batch that is finished, and one without rows.
    assert months.merge_months(two, "b", target, state, ["line"]) == []
    assert months.merge_months(two.limit(0), "c", target, state, ["line"]) == []
    assert files(target) == after


def test_batch_cut_off_while_months_are_replaced(spark, day, monkeypatch):
    base = work_dir(spark, "merge")
    target, state = f"{base}/out", f"{base}/state"
    one, two = batches(spark, day)
    months.merge_months(one, "a", target, state, ["line"])

    def half(df, path, by):
        overwrite(df.where("month = '2024-03'").limit(1), path, by)
        raise OSError("cut off")

    overwrite = months.overwrite_partitions
    monkeypatch.setattr(months, "overwrite_partitions", half)
    with pytest.raises(OSError):
        months.merge_months(two, "b", target, state, ["line"])
    monkeypatch.setattr(months, "overwrite_partitions", overwrite)
    assert months.merge_months(two, "b", target, state, ["line"]) == ["2024-03"]
    assert rows(spark.read.parquet(target), *SALES_COLUMNS) == rows(incremental_sync(one, two, 1000, ["line"]))


def test_load_job_stops_when_nothing_is_new(spark, day):
    base = work_dir(spark, "load")
    paths = f"{base}/raw", f"{base}/sales", f"{base}/state"
    writers.sink_parquet(tickets(spark, day, [(1, "2024-01-05")]), paths[0])
    assert jobs.job_load(spark, *paths, date(2024, 1, 6))
    before = files(paths[1])
    assert not jobs.job_load(spark, *paths, date(2024, 1, 5)), "stored up to today"
    assert not jobs.job_load(spark, *paths, date(2024, 1, 7)), "no line that is not stored"
    assert files(paths[1]) == before
    tickets(spark, day, [(2, "2024-01-07")]).write.mode("append").parquet(paths[0])
    assert jobs.job_load(spark, *paths, date(2024, 1, 8))
    stored = months.read_months(spark, paths[1], 6)
    assert rows(stored, "date_sale", "id_client", "product") == [(day(d), "1234570", "p") for d in ("2024-01-05", "2024-01-07")]


def test_landing_job(spark, day):
    base = work_dir(spark, "land")
    paths = f"{base}/tickets", f"{base}/landed", f"{base}/ledger"
    data = [(1, "2024-01-05"), (1, "2024-01-05"), (2, "2024-02-05"), (3, "2024-04-01"), (4, "2024-02-06")]
    writers.sink_parquet(tickets(spark, day, data), paths[0])
    assert jobs.job_land(spark, *paths, date(2024, 2, 10)) == ["2024-01", "2024-02"]
    entries = ledger.read_ledger(spark, paths[2], ledger.LANDED)
    assert rows(entries, "month", "rows", "batch") == [("2024-01", 1, "2024-02-10"), ("2024-02", 2, "2024-02-10")]
    before = files(paths[1])
    assert jobs.job_land(spark, *paths, date(2024, 3, 10)) == [] and files(paths[1]) == before
    assert jobs.job_land(spark, *paths, date(2024, 3, 10), "again", ["2024-02"]) == ["2024-02"]
    after = files(paths[1])
    assert {f for f in before if "2024-01" in str(f)} <= set(after) and before.keys() != after.keys()
    assert rows(spark.read.parquet(paths[1]), "ID") == [(1,), (2,), (4,)]
    assert jobs.job_land(spark, *paths, date(2024, 4, 10)) == ["2024-04"]


def test_landing_cut_off_before_the_ledger(spark, day, monkeypatch):
    base = work_dir(spark, "land")
    paths = f"{base}/tickets", f"{base}/landed", f"{base}/ledger"
    writers.sink_parquet(tickets(spark, day, [(1, "2024-01-05"), (2, "2024-02-05")]), paths[0])

    def fail(*_):
        raise OSError("cut off")

    monkeypatch.setattr(landing, "add_entries", fail)
    with pytest.raises(OSError):
        jobs.job_land(spark, *paths, date(2024, 2, 10))
    monkeypatch.undo()
    assert jobs.job_land(spark, *paths, date(2024, 2, 10)) == ["2024-01", "2024-02"]
    assert rows(spark.read.parquet(paths[1]), "ID") == [(1,), (2,)]


def test_segment_job_writes_an_empty_table(spark, day):
    base = work_dir(spark, "segments")
    none = spark.createDataFrame([], f"date_sale date, id_client string, product string, {SALES_VALUE} double, amount double")
    catalog = spark.createDataFrame([], "product string, description string")
    jobs.job_segment_recs(spark, none, catalog, f"{base}/a", f"{base}/r")
    out = spark.read.parquet(f"{base}/r")
    assert out.count() == 0 and out.columns == CLUSTER_RECS.names


def test_first_batch_is_read_once(spark, day, monkeypatch):
    """With nothing stored there is nothing to merge, so the batch goes straight to its staging folder."""
    base = work_dir(spark, "merge")
    one, two = batches(spark, day)
    monkeypatch.setattr(months, "materialise", None)
    assert months.merge_months(two.unionByName(one), "a", f"{base}/out", f"{base}/state", ["line"]) == ["2023-01", "2024-03"]
    want = rows(incremental_sync(two.unionByName(one).limit(0), two.unionByName(one), 1000, ["line"]))
    assert rows(spark.read.parquet(f"{base}/out"), *SALES_COLUMNS) == want
    assert months.merge_months(one.limit(0), "a", f"{base}/none", f"{base}/other", ["line"]) == []
