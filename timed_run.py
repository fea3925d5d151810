"""The timed scenario on generated data: ``python timed_run.py ROWS [FOLDER]``.

Generates the partitioned source table, runs the audited daily transform over
all its days, profiles the output, judges it against seeded history and
queries the four views. Prints one JSON line with the seconds of each step.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import sys
import tempfile
import time
from contextlib import contextmanager

from pyspark.sql import functions as F

from bench import session
from veriframe.operators import audit, sensors
from veriframe.operators.anomaly import against_history
from veriframe.operators.distinct import check_unique
from veriframe.operators.profile import metric, profile
from veriframe.operators.transform import DAY, KEY, SUM_COLUMN, create_views, daily_sum
from veriframe.sources import generator as gen
from veriframe.sources.metrics import read_metrics, write_metrics
from veriframe.sources.publish import REGISTER
from veriframe.sources.tables import write_partitioned

LOAD_DATE = dt.date(2023, 7, 31)


def main(rows: int, folder: str) -> None:
    # Adaptive execution merges what turns out small.
    spark = session(os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8)), "200")
    seconds = {}

    @contextmanager
    def step(name):
        start = time.perf_counter()
        yield
        seconds[name] = round(time.perf_counter() - start, 2)

    with step("generate"):
        source = gen.source_table(spark, rows, LOAD_DATE, gen.success_spec(wide=True))
        write_partitioned(source, f"{folder}/source", [DAY])
    with step("audited_daily_sum"):
        output = daily_sum(spark.read.parquet(f"{folder}/source"), F.current_timestamp())
        rules = [audit.id_rule(), audit.Rule("positive", f"{SUM_COLUMN} > 0")]
        record = audit.audited_write(output, rules, f"{folder}/output", "daily_sum").first()
    written = spark.read.parquet(f"{folder}/output")
    with step("audit"):
        audit.audit_record(written, rules, "audit").collect()
    with step("profile"):
        wanted = [metric(n, SUM_COLUMN) for n in ("Minimum", "Maximum", "Mean", "StandardDeviation", "Completeness")]
        metrics = profile(written, [metric("Size"), *wanted, metric("Distinctness", KEY)], [DAY])
        stamped = metrics.select(
            "entity", "instance", "name", "value", F.date_format(DAY, "yyyy-MM-dd").alias("date"),
            F.lit("output").alias("table_name"), F.lit(1).cast("bigint").alias("dataset_date"),
        )
        write_metrics(stamped, f"{folder}/metrics", ["date", "table_name"])
    with step("unique"):
        check_unique(written, [KEY, DAY]).collect()
    with step("sensor"):
        history = gen.metric_history_seed(spark, SUM_COLUMN, LOAD_DATE - dt.timedelta(days=1), "output", 0)
        today = read_metrics(spark, f"{folder}/metrics", ["date", "table_name"])
        judged = against_history(
            today.where(F.col("name").isin("Minimum", "Maximum")).withColumn("day", F.col("date").cast("date")), history
        )
        results = sensors.sensor_results(judged, "1", "daily_sum").withColumn("result_ts", F.current_timestamp())
        sensors.gate(results, LOAD_DATE, LOAD_DATE).collect()
    written.createOrReplaceTempView("output")
    counts = {}
    for kind, name in create_views(spark, "output", temporary=True, days=f"parquet.`{folder}/output/{REGISTER}`").items():
        with step(f"view_{kind}"):
            counts[kind] = spark.table(name).count()
    spark.stop()
    print(json.dumps({
        "metric": "timed scenario", "rows": rows, "value": round(sum(seconds.values()), 2), "unit": "sec",
        "steps": seconds, "audit": record["job_sts"], "counts": counts,
    }))


if __name__ == "__main__":
    target = sys.argv[2] if len(sys.argv) > 2 else tempfile.mkdtemp(prefix="timed-run-")
    main(int(sys.argv[1]), target)
