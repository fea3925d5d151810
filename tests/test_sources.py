from __future__ import annotations

import datetime as dt

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from veriframe.operators.arrival import check_arrivals, check_file_absent, check_file_present, check_table_absent
from veriframe.operators.sets import check_partitions
from veriframe.sources import generator as gen
from veriframe.sources import tables
from veriframe.sources.files import list_entries, list_files, read_log_lines
from veriframe.sources.workspace import work_dir

LOAD_DATE = dt.date(2023, 8, 31)


def test_generated_table(spark):
    rows = gen.source_table(spark, 100, LOAD_DATE).collect()
    per_day = {}
    for r in rows:
        per_day.setdefault(r.dl_data_dt, []).append(r.uc_id)
    days = [dt.date(2023, 8, d) for d in (28, 29, 30, 31)] + [dt.date(2023, 7, 31)]
    assert {d: len(v) for d, v in per_day.items()} == {d: 20 for d in days}
    assert sorted(per_day[LOAD_DATE]) == [f"11{10 ** 9 + n}" for n in range(3, 80, 4)]
    assert {len(r.uc_id) for r in rows} == {12} and {r.transactions for r in rows} == {1}


def test_month_end_inside_the_window_is_not_added_again(spark):
    assert gen.source_table(spark, 100, dt.date(2023, 9, 2)).count() == 80
    assert gen.source_table(spark, 100, dt.date(2023, 9, 2), gen.audit_failure_spec()).count() == 100


def test_failure_variants(spark):
    bad = gen.source_table(spark, 100, LOAD_DATE, gen.audit_failure_spec()).collect()
    assert {r.uc_id[:2] for r in bad} == {"07"} and max(len(r.uc_id) for r in bad) < 12
    few = gen.source_table(spark, 100, LOAD_DATE, gen.anomaly_failure_spec(100))
    assert few.select("uc_id").distinct().count() == 10
    assert {r.transactions for r in few.collect()} == {5}


def test_weights(spark):
    wide = gen.source_table(spark, 50_000, LOAD_DATE, gen.success_spec(wide=True))
    share = wide.where("line_key = 'A'").count() / wide.count()
    assert share == pytest.approx(0.4, abs=0.01)
    assert wide.columns == ["uc_id", "cust_key", "line_key", "transactions", "dl_data_dt"]


def test_prefixed_id_wraps(spark):
    ids = spark.range(4).select(gen.prefixed_id(F.col("id"), "x", 5, 7)).collect()
    assert [r[0] for r in ids] == ["x5", "x6", "x7", "x5"]


def test_partitions_and_catalog(spark):
    tables.create_database(spark, "vf_test")
    source = gen.source_table(spark, 100, LOAD_DATE)
    tables.save_partitioned_table(source, "vf_test.src", ["dl_data_dt"])
    assert tables.table_exists(spark, "vf_test.src") and not tables.table_exists(spark, "nowhere.src")
    assert tables.list_partitions(spark, "vf_test.src", "dl_data_dt").count() == 5
    some = spark.createDataFrame([(LOAD_DATE,)], "dl_data_dt date")
    assert check_partitions(spark, "vf_test.src", some).first().status == "pass"
    more = spark.createDataFrame([(LOAD_DATE,), (dt.date(2023, 9, 1),)], "dl_data_dt date")
    assert check_partitions(spark, "vf_test.src", more).first().missing == 1
    assert check_table_absent(spark, "vf_test.src").first().status == "fail"
    with pytest.raises(AnalysisException):
        tables.drop_database(spark, "vf_test")
    tables.drop_table(spark, "vf_test", "src")
    tables.drop_table(spark, "vf_test", "src")
    assert check_table_absent(spark, "vf_test.src").first().status == "pass"
    tables.drop_database(spark, "vf_test")


def test_listing_several_partition_columns(spark):
    df = spark.range(4).selectExpr("id", "DATE '2024-01-01' AS day", "id % 2 AS part")
    tables.save_partitioned_table(df, "two_parts", ["day", "part"])
    assert tables.list_partitions(spark, "two_parts", "part", "int").count() == 2
    assert tables.list_partitions(spark, "two_parts", "day").first().day == dt.date(2024, 1, 1)
    spark.sql("DROP TABLE two_parts")


def test_listing_odd_partition_values(spark):
    df = spark.createDataFrame([(1, "a b/c+d"), (2, None), (3, "x")], "id int, part string")
    tables.save_partitioned_table(df, "odd_parts", ["part"])
    found = {r.part for r in tables.list_partitions(spark, "odd_parts", "part", "string").collect()}
    assert found == {"a b/c+d", None, "x"}
    spark.sql("DROP TABLE odd_parts")


def test_partitioned_write_replaces_only_its_days(spark, tmp_path):
    path = str(tmp_path / "out")
    source = gen.source_table(spark, 100, LOAD_DATE)
    tables.write_partitioned(source, path, ["dl_data_dt"])
    tables.write_partitioned(source.where(F.col("dl_data_dt") == F.lit(LOAD_DATE)).limit(3), path, ["dl_data_dt"])
    assert spark.read.parquet(path).count() == 83
    tables.write_partitioned(source.limit(1), path, ["dl_data_dt"], replace_all=True)
    assert spark.read.parquet(path).count() == 1


def test_a_hot_day_is_split_and_small_days_are_merged(spark, tmp_path):
    path = tmp_path / "out"
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    rows = spark.range(0, 400_000, 1, 8).select(
        "id", F.xxhash64("id").alias("value"),
        F.when(F.col("id") % 100 == 0, F.lit("2024-01-02")).otherwise("2024-01-01").cast("date").alias("day"),
    )
    spark.conf.set(size, "512k")
    try:
        tables.write_partitioned(rows, str(path), ["day"])
    finally:
        spark.conf.unset(size)
    files = {d.name: len(list(d.glob("*.parquet"))) for d in path.glob("day=*")}
    assert files["day=2024-01-01"] > 2 and files["day=2024-01-02"] == 1
    assert spark.read.parquet(str(path)).count() == 400_000


def test_files(spark, tmp_path):
    missing, folder = str(tmp_path / "missing"), tmp_path / "landing"
    folder.mkdir()
    assert list_files(spark, missing) is None
    assert check_file_absent(spark, missing).first().status == "pass"
    assert check_file_present(spark, missing).first().status == "error"
    assert check_file_absent(spark, str(folder)).first().status == "fail"
    assert check_file_present(spark, str(folder)).first().status == "fail"
    (folder / "a.csv").write_text("x")
    assert check_file_present(spark, str(folder)).first().status == "pass"
    (folder / "b.csv").write_text("xy")
    assert check_file_present(spark, str(folder)).first().violations == 1
    assert check_file_present(spark, str(folder), "a.*").first().status == "pass"
    assert "content" not in list_files(spark, str(folder)).columns
    (folder / "many").mkdir()
    for name in ("1.csv", "2.csv"):
        (folder / "many" / name).write_text("xyz")
    found = {r.name: (r.files, r.bytes) for r in list_entries(spark, str(folder)).collect()}
    assert found == {"a.csv": (1, 1), "b.csv": (1, 2), "many": (2, 6)}
    expected = spark.createDataFrame([("a.csv",), ("many",), ("gone",)], "name string")
    verdicts = check_arrivals(list_entries(spark, str(folder)), expected).collect()
    assert {r.name: r.status for r in verdicts} == {"a.csv": "pass", "many": "pass", "gone": "fail"}


def test_log_glob(spark, tmp_path):
    for name in ("one", "two"):
        (tmp_path / name / "driver").mkdir(parents=True)
        (tmp_path / name / "driver" / "stderr").write_text("2024-01-01T00:00:00.0000 started\nshort\n")
    assert read_log_lines(spark, f"{tmp_path}/*/driver/stderr").count() == 4


def test_work_dir_is_below_the_shared_folder(spark):
    first, second = work_dir(spark, "x"), work_dir(spark, "x")
    assert first != second and first.startswith(spark.conf.get("spark.checkpoint.dir"))
