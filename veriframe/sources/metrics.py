"""The metrics repository: result documents in JSON, read back as a long frame.

A document is ``{resultKey: {dataSetDate, tags}, analyzerContext: {metricMap}}``.

A repository folder is a short log and a fold. Each write is one numbered folder of
the log, with a small list of the runs it holds. When the log has grown to
``LOG_WRITES``, its runs are folded into one partition per month and table: the
partitions that the log touches are rewritten as a new generation, and a manifest says which generation of
each partition counts and up to which write the log is in it. The manifest is
written last, so a fold that dies changes nothing and is done again; what it
replaced is removed by the next one, so readers under way keep their files. The
number of files grows with months and tables, not with runs. One writer at a time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DOCUMENT = """
    resultKey struct<dataSetDate: bigint, tags: map<string, string>>,
    analyzerContext struct<metricMap: array<struct<
        analyzer: map<string, string>,
        metric: struct<metricName: string, entity: string, instance: string,
                       name: string, value: double>>>>
"""
#: Writes in the log before they are folded.
LOG_WRITES = 16
#: The tag that holds the data's day, as text that begins with year and month.
DAY_TAG = "date"
MONTH, GENERATION, WRITE = "fold_month", "generation", "write_number"


class _Folder:
    """A repository folder and what is committed in it."""

    def __init__(self, spark: SparkSession, path: str, tags: Sequence[str]):
        self.spark, self.path, self.tags = spark, path.rstrip("/"), list(tags)
        self.others = [t for t in tags if t != DAY_TAG]
        self.keys = [*self.tags, "dataset_date"]
        manifests = self._numbers("manifest")
        self.folded = max(manifests, default=0)
        self.writes = [n for n in self._numbers("runs") if n > self.folded]

    def _numbers(self, kind: str, committed: bool = True) -> list[int]:
        pattern = self._hadoop(f"{self.path}/{kind}/number=*" + "/_SUCCESS" * committed)
        found = self._files(pattern).globStatus(pattern) or []
        folders = [s.getPath().getParent() if committed else s.getPath() for s in found]
        return sorted(int(f.getName().removeprefix("number=")) for f in folders)

    def _hadoop(self, path: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)

    def _files(self, path):
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def next_number(self) -> int:
        """Above every number in use, committed or left over."""
        kinds = ("log", "runs", "fold", "manifest")
        return 1 + max([n for k in kinds for n in self._numbers(k, False)], default=0)

    def remove(self, kind: str, number: int) -> None:
        path = self._hadoop(f"{self.path}/{kind}/number={number}")
        self._files(path).delete(path, True)

    def _key(self, source: str = "resultKey") -> list[Column]:
        return [F.col(f"{source}.tags")[t].alias(t) for t in self.tags] + [F.col(f"{source}.dataSetDate").alias("dataset_date")]

    def log(self) -> DataFrame:
        """Documents of the log's newest write of each run, with the keys of their runs."""
        paths = [f"{self.path}/log/number={n}" for n in self.writes]
        documents = self.spark.read.schema(f"{DOCUMENT}, number bigint").option("basePath", f"{self.path}/log").json(paths)
        keyed = documents.select("resultKey", "analyzerContext", *self._key(), F.col("number").alias(WRITE))
        if len(self.writes) == 1:
            return keyed.drop(WRITE)
        return _joined(keyed, self.runs(), [*self.keys, WRITE], "left_semi").drop(WRITE)

    def runs(self) -> DataFrame:
        """The runs in the log and the newest write of each."""
        paths = [f"{self.path}/runs/number={n}" for n in self.writes]
        schema = ", ".join([f"`{t}` string" for t in self.tags] + ["dataset_date bigint", "number bigint"])
        runs = self.spark.read.schema(schema).option("basePath", f"{self.path}/runs").parquet(*paths)
        return runs.groupBy(*self.keys).agg(F.max("number").alias(WRITE))

    def current(self) -> DataFrame:
        """The partitions of the fold, each with the generation that counts."""
        schema = ", ".join([f"`{c}` string" for c in (MONTH, *self.others)] + [f"{GENERATION} bigint"])
        return self.spark.read.schema(schema).parquet(f"{self.path}/manifest/number={self.folded}")

    def fold(self) -> DataFrame:
        """Documents of the fold, with the keys of their runs and their month."""
        partitions = ", ".join([f"number bigint, {MONTH} string"] + [f"`{_partition(t)}` string" for t in self.others])
        documents = self.spark.read.schema(f"{DOCUMENT}, {partitions}").json(f"{self.path}/fold")
        # tags come from the folders, so a filter on them leaves out folders
        keyed = documents.select(
            "resultKey", "analyzerContext",
            *[F.col(f"`{_partition(t)}`").alias(t) if t in self.others else F.col("resultKey.tags")[t].alias(t) for t in self.tags],
            F.col("resultKey.dataSetDate").alias("dataset_date"), MONTH, F.col("number").alias(GENERATION))
        return _joined(keyed, self.current(), [MONTH, *self.others, GENERATION], "left_semi").drop(GENERATION)

    def documents(self) -> DataFrame:
        """Every run's newest documents, with the keys of their runs and their month."""
        parts = []
        if self.folded:
            kept = self.fold()
            parts.append(_joined(kept, self.runs(), self.keys, "left_anti") if self.writes else kept)
        if self.writes:
            parts.append(self.log().withColumn(MONTH, self.month()))
        if not parts:
            raise FileNotFoundError(f"no metrics in {self.path}")
        return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])

    def month(self) -> Column:
        return F.substring(F.col(DAY_TAG), 1, 7) if DAY_TAG in self.tags else F.lit(None).cast("string")


def _partition(tag: str) -> str:
    return f"fold_{tag}"


def _joined(left: DataFrame, right: DataFrame, names: Sequence[str], how: str) -> DataFrame:
    """A null-safe join on columns of equal names."""
    same = F.lit(True)
    for name in names:
        same = same & F.col(f"l.`{name}`").eqNullSafe(F.col(f"r.`{name}`"))
    return left.alias("l").join(right.alias("r"), same, how)


def read_documents(spark: SparkSession, path: str, tags: Sequence[str], months: Sequence[str] | None = None) -> DataFrame:
    """The documents that count, each run's newest ones, with a column for each tag and ``dataset_date``; of some months only, if asked."""
    documents = _Folder(spark, path, tags).documents()
    return (documents if months is None else documents.where(F.col(MONTH).isin(*months))).drop(MONTH)


def read_metrics(
    spark: SparkSession, path: str, tags: Sequence[str], multi_line: bool = False, months: Sequence[str] | None = None,
) -> DataFrame:
    """Metrics as rows: entity, instance, name, value, dataset_date and one column per tag.

    In a folder written by :func:`write_metrics` a filter on a tag other than the
    day, or ``months``, leaves out folders of the fold. ``multi_line`` reads files that hold one JSON array
    and take the tags from the documents instead.
    """
    if multi_line:
        keyed = spark.read.option("multiLine", True).schema(DOCUMENT).json(path).select(
            F.col("resultKey.dataSetDate").alias("dataset_date"),
            *[F.col("resultKey.tags")[t].alias(t) for t in tags], "analyzerContext",
        )
    else:
        keyed = read_documents(spark, path, tags, months)
    return keyed.select(
        "dataset_date", *tags, F.explode("analyzerContext.metricMap.metric").alias("metric")
    ).select(
        F.col("metric.entity").alias("entity"),
        F.col("metric.instance").alias("instance"),
        F.col("metric.name").alias("name"),
        F.col("metric.value").alias("value"),
        "dataset_date", *tags,
    )


def metric_documents(metrics: DataFrame, tags: Sequence[str]) -> DataFrame:
    """Long metric rows as result documents, one metric each, whatever the number of rows."""
    entry = F.struct(
        F.create_map(
            F.lit("analyzerName"), F.split("name", r"\.")[0], F.lit("column"), F.col("instance")
        ).alias("analyzer"),
        F.struct(
            F.lit("DoubleMetric").alias("metricName"), "entity", "instance", "name",
            F.col("value").cast("double").alias("value"),
        ).alias("metric"),
    )
    tag_map = F.create_map(*[x for t in tags for x in (F.lit(t), F.col(t).cast("string"))])
    return metrics.select(
        F.struct(F.col("dataset_date").alias("dataSetDate"), tag_map.alias("tags")).alias("resultKey"),
        F.struct(F.array(entry).alias("metricMap")).alias("analyzerContext"),
    )


def write_metrics(metrics: DataFrame, path: str, tags: Sequence[str]) -> None:
    """Add the metrics of one or more runs to a repository folder, as JSON lines.

    A run is a set of tag values and a moment; writing a run again replaces it and
    nothing else. The rebalance hint makes few files of small writes and splits large ones.
    The list of runs is written after the documents: without it a write does not count.
    """
    spark = metrics.sparkSession
    folder = _Folder(spark, path, tags)
    number = folder.next_number()
    target = f"{folder.path}/log/number={number}"
    metric_documents(metrics, tags).hint("rebalance").write.json(target)
    written = spark.read.schema(DOCUMENT).json(target)
    written.select(*folder._key()).distinct().coalesce(1).write.parquet(f"{folder.path}/runs/number={number}")
    if len(folder.writes) + 1 >= LOG_WRITES:
        fold_metrics(spark, path, tags)


def fold_metrics(spark: SparkSession, path: str, tags: Sequence[str]) -> None:
    """Fold the log into the partitions of its months and tables; can be done again at any point."""
    folder = _Folder(spark, path, tags)
    if not folder.writes:
        return
    before = folder.folded
    for kind in ("log", "runs"):  # what the last fold holds
        for number in folder._numbers(kind, False):
            if number <= before:
                folder.remove(kind, number)
    touched = folder.runs().select(folder.month().alias(MONTH), *folder.others).distinct()
    place = [MONTH, *folder.others]
    number = folder.next_number()
    documents = _joined(folder.documents(), touched, place, "left_semi")
    named = documents.select("resultKey", "analyzerContext", MONTH, *[F.col(f"`{t}`").alias(_partition(t)) for t in folder.others])
    partitions = [MONTH, *[_partition(t) for t in folder.others]]
    named.hint("rebalance", *partitions).write.partitionBy(*partitions).json(f"{folder.path}/fold/number={number}")
    listed = touched.select(*place, F.lit(number).cast("long").alias(GENERATION))
    if before:
        listed = listed.unionByName(_joined(folder.current(), touched, place, "left_anti"))
    listed.coalesce(1).write.parquet(f"{folder.path}/manifest/number={number}")
    _tidy(_Folder(spark, path, tags), before)


def _tidy(folder: _Folder, before: int) -> None:
    """Remove generations that neither the manifest nor the one before it names, and older manifests.

    At most one row a generation comes to the driver.
    """
    named = {r[0] for n in {folder.folded, before} - {0} for r in
             folder.spark.read.parquet(f"{folder.path}/manifest/number={n}").select(GENERATION).distinct().collect()}
    for number in folder._numbers("fold", False):
        if number not in named:
            folder.remove("fold", number)
    for number in folder._numbers("manifest", False):
        if number not in (folder.folded, before):
            folder.remove("manifest", number)
