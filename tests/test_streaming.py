"""A stream that is replayed in pieces gives the batch result."""

from __future__ import annotations

import datetime as dt
import random
import shutil

import pytest
from pyspark.sql import functions as F

from veriframe.operators.profile import metric, profile
from veriframe.operators.sets import check_date_coverage, check_schema, reconcile
from veriframe.operators.transform import ADDED_COLUMN, DAY, LOADED, SUM_COLUMN, daily_sum
from veriframe.plans import flow_queries
from veriframe.streaming import metrics as stream_metrics
from veriframe.streaming import partials
from veriframe.streaming.daily_sum import PARTIAL_SCHEMA, day_and_previous, merge_parts, read_output, run_daily_sum
from veriframe.streaming.profile import read_profile, run_profile
from veriframe.streaming.sensor import affected_days, judge, read_sensor, run_sensor

MOMENT = "2024-02-01 00:00:00"


@pytest.fixture
def pieces(spark, sf, tmp_path):
    """Events split over three files that each hold rows of every day."""
    events = spark.read.parquet(f"{sf}/events.parquet")
    folder = tmp_path / "in" / "events.parquet"
    for part in range(3):
        staged = tmp_path / f"part{part}"
        events.where(F.col("event_id") % 3 == part).coalesce(1).write.parquet(str(staged))
        folder.mkdir(parents=True, exist_ok=True)
        for file in staged.glob("*.parquet"):
            shutil.copy(file, folder / f"{part}.parquet")
    return str(tmp_path / "in")


def source(df):
    return df.select(
        F.col("user_id").cast("string").alias("uc_id"),
        F.get_json_object("props", "$.k").cast("int").alias("transactions"),
        F.to_date("ts").alias(DAY), "value", F.to_date("ts").alias("day"),
    )


def sums(df):
    return df.select("uc_id", "transactions", DAY)


def test_daily_sum_in_pieces_equals_batch(spark, pieces, tmp_path):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "ck")
    stream = sums(source(partials.read_stream(spark, pieces, "events", files_per_batch=1)))
    run_daily_sum(stream, out, checkpoint, F.lit(MOMENT).cast("timestamp"))
    before = {r.batch_id for r in spark.read.parquet(f"{out}/partials").select("batch_id").distinct().collect()}
    assert before == {-2, 0, 1, 2}

    batch = sums(source(spark.read.parquet(f"{pieces}/events.parquet")))
    expected = daily_sum(batch).select("uc_id", SUM_COLUMN, DAY)
    assert reconcile(read_output(spark, out).select("uc_id", SUM_COLUMN, DAY), expected).count() == 0
    whole = day_and_previous(batch.groupBy("uc_id", DAY).agg(F.sum("transactions").alias("part")))
    assert reconcile(read_output(spark, out).select(*whole.columns), whole).count() == 0

    # Nothing new: a second run changes nothing.
    run_daily_sum(stream, out, checkpoint, F.lit(MOMENT).cast("timestamp"))
    assert {r.batch_id for r in spark.read.parquet(f"{out}/partials").select("batch_id").distinct().collect()} == before

    assert check_date_coverage(read_output(spark, out), DAY, dt.date(2024, 1, 1), dt.date(2024, 1, 30)).first().status == "pass"
    declared = {"uc_id": "string", SUM_COLUMN: "int", ADDED_COLUMN: "int", DAY: "date", LOADED: "timestamp"}
    assert dict(read_output(spark, out).dtypes) == declared
    types = {f.name: f.dataType for f in read_output(spark, out).schema.fields}
    assert {r.status for r in check_schema(spark, read_output(spark, out).schema, types).collect()} == {"pass"}


def test_a_replayed_batch_overwrites_its_partials(spark, tmp_path):
    path = str(tmp_path / "p")
    part = spark.createDataFrame([("a", 5, dt.date(2024, 1, 1))], f"uc_id string, part bigint, {DAY} date")
    for batch in (0, 0, 1):
        partials.write_partials(part, path, DAY, batch)
    schema = f"uc_id string, part bigint, {DAY} date, batch_id bigint"
    days = [dt.date(2024, 1, 1), dt.date(2024, 1, 2), None]
    assert partials.read_partials(spark, path, schema, DAY, days).agg(F.sum("part")).first()[0] == 10
    assert partials.read_partials(spark, path, schema, DAY).count() == 2


def test_current_partials():
    assert partials.current([]) == []
    assert partials.current([1, 0]) == [0, 1]
    assert partials.current([-2, 0, 1, 2]) == [-2, 2]
    assert partials.current([-3, -2, 2, 3, 4]) == [-3, 3, 4]


def test_merged_batches_are_counted_once_and_removed(spark, tmp_path):
    """Also where a batch is replayed after its merge, and for rows without a day."""
    path = str(tmp_path / "p")
    for batch in (0, 1, 2, 3, 3, 4, 5, 5):
        rows = [("a", 10 ** batch, dt.date(2024, 1, 1)), ("a", 10 ** batch, None)]
        if batch == 2:
            rows.append(("b", 7, dt.date(2024, 1, 2)))
        part = spark.createDataFrame(rows, f"uc_id string, part bigint, {DAY} date")
        days = partials.write_partials(part, path, DAY, batch)
        partials.fold_partials(spark, path, PARTIAL_SCHEMA, DAY, days, batch, merge_parts)
        found = partials.read_partials(spark, path, PARTIAL_SCHEMA, DAY).groupBy(DAY).agg(F.sum("part").alias("n")).collect()
        total = int("1" * (batch + 1))
        assert {r[DAY]: r.n for r in found} == {dt.date(2024, 1, 1): total, None: total} | ({dt.date(2024, 1, 2): 7} if batch > 1 else {})
        stored = spark.read.parquet(path).groupBy(DAY).agg(F.countDistinct("batch_id").alias("n")).collect()
        assert max(r.n for r in stored) <= 4
    assert partials.read_partials(spark, str(tmp_path / "none"), PARTIAL_SCHEMA, DAY).count() == 0


def test_affected_days():
    near, month, needed = affected_days([dt.date(2024, 1, 31)], 3)
    assert near == {dt.date(2024, 1, 31), dt.date(2024, 2, 1), dt.date(2024, 2, 2), dt.date(2024, 2, 3)}
    assert len(month) == 30 and dt.date(2024, 2, 29) in month
    assert {dt.date(2024, 1, 28), dt.date(2023, 12, 31)} <= needed


def test_profile_in_pieces_equals_batch(spark, pieces, tmp_path):
    stream = source(partials.read_stream(spark, pieces, "events", files_per_batch=1))
    run_profile(stream, "value", "day", str(tmp_path / "out"), str(tmp_path / "ck"))
    batch = source(spark.read.parquet(f"{pieces}/events.parquet"))
    names = ("Completeness", "Mean", "Sum", "StandardDeviation", "Minimum", "Maximum")
    expected = profile(batch, [metric("Size"), *[metric(n, "value") for n in names]], ["day"])
    want = {(r.day, r.name): r.value for r in expected.collect()}
    found = {(r.day, r.name): r.value for r in read_profile(spark, str(tmp_path / "out")).collect()}
    assert found.keys() == want.keys()
    assert all(found[k] == pytest.approx(want[k], rel=1e-9) for k in want)


def test_sensor_in_pieces_equals_batch(spark, pieces, tmp_path):
    stream = source(partials.read_stream(spark, pieces, "events", files_per_batch=1))
    out = str(tmp_path / "out")
    run_sensor(stream, "value", "day", out, str(tmp_path / "ck"), "7", "daily")
    batch = source(spark.read.parquet(f"{pieces}/events.parquet"))
    metrics = profile(batch, [metric("Minimum", "value"), metric("Maximum", "value")], ["day"])
    days = [r.day for r in metrics.select("day").distinct().collect()]
    expected = judge(metrics.select("day", "instance", "name", "value"), days, "7", "daily", 3, 0.5)
    assert reconcile(read_sensor(spark, out).select(*expected.columns), expected).count() == 0


def test_a_late_day_is_judged_again(spark, tmp_path):
    """A day that arrives after its successors changes their verdicts."""
    folder = tmp_path / "in" / "late.parquet"
    schema = "day date, value double"

    def arrive(number, rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / f"s{number}"))
        folder.mkdir(parents=True, exist_ok=True)
        for file in (tmp_path / f"s{number}").glob("*.parquet"):
            shutil.copy(file, folder / f"{number}.parquet")

    def run():
        stream = partials.read_stream(spark, str(tmp_path / "in"), "late")
        run_sensor(stream, "value", "day", str(tmp_path / "out"), str(tmp_path / "ck"), "7", "p", ["Maximum"])
        rows = read_sensor(spark, str(tmp_path / "out")).where("upstrm_pl = 'p_d3'").collect()
        return {r.dt.day: r.is_ready for r in rows}

    arrive(0, [(dt.date(2024, 1, 3), 10.0)])
    assert run() == {3: None}
    arrive(1, [(dt.date(2024, 1, 2), 100.0)])
    assert run() == {2: None, 3: False}
    arrive(2, [(dt.date(2024, 1, 1), 10.0), (dt.date(2024, 1, 2), 5.0)])
    assert run() == {1: None, 2: False, 3: False}


def test_rows_without_a_day_are_kept(spark, tmp_path):
    folder = tmp_path / "in" / "some.parquet"
    schema = "uc_id string, transactions int, dl_data_dt date"
    data = [("a", 2, dt.date(2024, 1, 1)), ("a", 3, dt.date(2024, 1, 2)), ("a", 7, None), ("a", 1, None)]
    spark.createDataFrame(data, schema).write.parquet(str(folder))
    out = str(tmp_path / "out")
    run_daily_sum(partials.read_stream(spark, str(tmp_path / "in"), "some"), out, str(tmp_path / "ck"))
    found = {r.dl_data_dt: (r[SUM_COLUMN], r[ADDED_COLUMN]) for r in read_output(spark, out).collect()}
    assert found == {dt.date(2024, 1, 1): (2, 2), dt.date(2024, 1, 2): (3, 5), None: (8, 8)}

    stream = partials.read_stream(spark, str(tmp_path / "in"), "some").withColumn("day", F.col(DAY))
    run_profile(stream, "transactions", "day", str(tmp_path / "profile"), str(tmp_path / "ck2"))
    sizes = {r.day: r.value for r in read_profile(spark, str(tmp_path / "profile")).where("name = 'Size'").collect()}
    assert sizes == {dt.date(2024, 1, 1): 1, dt.date(2024, 1, 2): 1, None: 2}


def test_a_batch_without_rows(spark, tmp_path):
    schema = "uc_id string, transactions int, dl_data_dt date"
    spark.createDataFrame([], schema).write.parquet(str(tmp_path / "in" / "none.parquet"))
    out = str(tmp_path / "out")
    stream = partials.read_stream(spark, str(tmp_path / "in"), "none")
    run_daily_sum(stream, out, str(tmp_path / "ck"))
    named = stream.withColumn("day", F.col(DAY))
    run_profile(named, "transactions", "day", str(tmp_path / "profile"), str(tmp_path / "ck2"))
    assert read_profile(spark, str(tmp_path / "profile")).count() == 0
    run_sensor(named, "transactions", "day", str(tmp_path / "sensor"), str(tmp_path / "ck3"), "7", "p")


def test_all_metrics_in_pieces_equal_batch(spark, tmp_path):
    """Three batches with odd values, a day that comes twice and one that is null."""
    draw, rows = random.Random(2), []
    for _ in range(300):
        value = draw.choice([None, float("nan"), 0.0, -0.0, draw.gauss(1e6, 1.0)])
        rows.append((draw.choice([dt.date(2024, 1, 1), dt.date(2024, 1, 2), None]), draw.choice(["a", "b", "NullValue", None]), draw.randint(0, 9), draw.gauss(1e7, 1), value))
    schema = "day date, t string, k int, x double, y double"
    folder = tmp_path / "in" / "odd.parquet"
    folder.mkdir(parents=True)
    for part in range(3):
        spark.createDataFrame(rows[part * 100:part * 100 + 100], schema).coalesce(1).write.parquet(str(tmp_path / f"p{part}"))
        shutil.copy(next((tmp_path / f"p{part}").glob("part-*")), folder / f"{part}.parquet")
    plain = [
        metric("Size"), metric("Mean", "x"), metric("StandardDeviation", "x"), metric("Completeness", "k"), metric("Correlation", "x", "k"),
        metric("CountDistinct", "y"), metric("UniqueValueRatio", "k", "t"), metric("Histogram", "t"), metric("Histogram", "k"),
        metric("MutualInformation", "t", "k"), metric("ApproxQuantiles-0.5", "y"), metric("ApproxQuantiles-0.9", "x")]
    stream = partials.read_stream(spark, str(tmp_path / "in"), "odd", files_per_batch=1)
    stream_metrics.run_metrics(stream, plain, "day", str(tmp_path / "out"), str(tmp_path / "ck"))
    batch = spark.createDataFrame(rows, schema)

    def values_of(df):
        return {(r.day, r.entity, r.instance, r.name): "NaN" if r.value is not None and r.value != r.value else r.value for r in df.collect()}

    want = values_of(profile(batch, plain, ["day"], exact=True))
    found = values_of(stream_metrics.read_metrics(spark, str(tmp_path / "out"), plain))
    assert found.keys() == want.keys()
    assert all(found[k] == pytest.approx(want[k], rel=1e-9, abs=1e-9) if not isinstance(want[k], str) else found[k] == want[k] for k in want)
    some = values_of(stream_metrics.read_metrics(spark, str(tmp_path / "out"), plain, days=[dt.date(2024, 1, 2)]))
    assert some and {k[0] for k in some} == {dt.date(2024, 1, 2)} and all(found[k] == pytest.approx(v) if not isinstance(v, str) else True for k, v in some.items())
    # the last batch again: it replaces its own states
    stream_metrics.store_states(spark.createDataFrame(rows[200:], schema), plain, "day", str(tmp_path / "out" / "states"), 2)
    again = values_of(stream_metrics.read_metrics(spark, str(tmp_path / "out"), plain))
    assert again.keys() == found.keys() and all(again[k] == pytest.approx(v, rel=1e-9, abs=1e-9) if not isinstance(v, str) else True for k, v in found.items())


def test_pieces_are_files_of_bounded_size(spark, sf, tmp_path, monkeypatch):
    """A file doesn't grow with the table, the batches stay three."""
    monkeypatch.setattr(flow_queries, "FILE_ROWS", 50, raising=False)
    monkeypatch.setattr(flow_queries, "work_dir", lambda _, name: str(tmp_path / name))
    stream = flow_queries._piecewise(spark, sf)
    rows = spark.read.parquet(f"{sf}/events.parquet").count()
    files = [r["count"] for r in spark.read.parquet(str(tmp_path / "pieces" / "events.parquet")).groupBy(F.input_file_name()).count().collect()]
    assert rows > 500 and sum(files) == rows and max(files) < 100
    batches = []
    partials.run_available(stream, lambda batch, _: batches.append(batch.count()), str(tmp_path / "ck"))
    assert len(batches) == 3 and sum(batches) == rows


def test_merged_mean_is_the_sum_over_the_count(spark):
    draw = random.Random(4)
    rows = [(dt.date(2024, 1, 1) + dt.timedelta(days=k % 200), part, draw.randint(0, 20_000) / 100) for k in range(4000) for part in [draw.randrange(3)]]
    frame = spark.createDataFrame(rows, "day date, part int, x double")
    states = [stream_metrics.batch_states(frame.where(F.col("part") == part), [metric("Mean", "x")], "day") for part in range(3)]
    found = stream_metrics.merge_states(states[0].unionByName(states[1]).unionByName(states[2])).collect()
    assert len(found) == 200 and all(r["mean"] == r["total"] / r["present"] for r in found)
