"""Reading and writing: raw CSV, layered tables, reports, feature contracts and lineage cuts."""

from __future__ import annotations

import csv
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridcast.functions.timegrid import month_text

RAW_SCHEMA = T.StructType(
    [
        T.StructField("utc_timestamp", T.StringType()),
        T.StructField("DE_load_actual_entsoe_transparency", T.StringType()),
        T.StructField("DE_wind_generation_actual", T.StringType()),
        T.StructField("DE_solar_generation_actual", T.StringType()),
    ]
)


HEADER_SPLIT = 16 << 20


def file_headers(spark: SparkSession, path: str) -> DataFrame:
    """The first line of every file under ``path``, as ``file`` and ``header``, in one distributed job.

    Every split of a file is a task of its own, and a task stops after the first lines that it's given, so files aren't
    read to their end. Empty files give no row.
    """
    settings = {"spark.sql.files.maxPartitionBytes": str(HEADER_SPLIT), "spark.sql.files.openCostInBytes": str(HEADER_SPLIT)}
    before = {c: spark.conf.get(c) for c in settings}
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.col("value").alias("header"))

    def first_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch) or batch.column("start")[0].as_py() != 0:
                return
            yield batch.select(["file", "header"]).slice(0, 1)
            if batch.column("file")[0] == batch.column("file")[len(batch) - 1]:
                return  # one split a task, so no other file follows

    try:
        for c, v in settings.items():
            spark.conf.set(c, v)
        return cut(lines.mapInArrow(first_lines, "file string, header string"))
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)


def read_raw(spark: SparkSession, path: str, schema: T.StructType = RAW_SCHEMA) -> DataFrame:
    """Raw CSV with a header, read with an explicit schema.

    Columns are matched by each file's own header, so files may order them differently, and a file with hundreds of
    other columns is read for the wanted ones only. Values arrive as text; `normalise_columns` parses them. Headers are
    found by one job over all files; files of the same header are one scan. A header must not hold line breaks.
    """
    headers = file_headers(spark, path)
    groups = headers.groupBy("header").agg(F.collect_list("file").alias("files")).collect()  # one row a kind of header
    release(headers)
    parts = []
    for header, files in sorted((g["header"], g["files"]) for g in groups):
        names = next(csv.reader([header.removeprefix("\ufeff")]))
        wide = T.StructType([T.StructField(c or f"_c{i}", T.StringType()) for i, c in enumerate(names)])
        present = [f.name for f in schema.fields if f.name in names]
        reader = spark.read.option("header", True).option("enforceSchema", False)
        parts.append(reader.schema(wide).csv(sorted(files)).select(*present))
    if not parts:
        return spark.createDataFrame([], schema)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


# Times in JSON text keep their microseconds, which the writer's own default cuts to milliseconds.
JSON_TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def write_json(df: DataFrame, path: str) -> None:
    """A table as JSON lines, nested columns as objects and arrays, written by as many tasks as made it; nulls are kept."""
    df.write.mode("overwrite").options(ignoreNullFields=False, **JSON_TIMES).json(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """JSON lines with an explicit schema; a line that isn't JSON, or a value of another type, raises."""
    return spark.read.schema(schema).options(mode="FAILFAST", **JSON_TIMES).json(path)


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), sort_by: Sequence[str] = ()) -> None:
    """Overwrite a Parquet table. Rows are clustered by the partition columns first, so that each partition gets few
    files; the spread over ``sort_by`` keeps a hot partition from ending up in one task."""
    if partition_by:
        df = df.repartitionByRange(*partition_by, *sort_by)
    if sort_by:
        df = df.sortWithinPartitions(*partition_by, *sort_by)
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def write_panel(df: DataFrame, path: str, key: str = "series_id", ts: str = "ts", by_month: bool = False) -> None:
    """Panel table partitioned by series, or by month, which prunes time slices and suits many series."""
    if by_month:
        write_table(df.withColumn("month", month_text(F.col(ts))), path, ["month"], [key, ts])
    else:
        write_table(df, path, [key], [ts])


def write_report(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """Result tables: CSV files with headers, or one file of JSON or text lines.

    CSV tables may grow with the series, so they are written by as many tasks as made them. JSON and text reports hold a
    row or a few; they are gathered after the work is done, which stays parallel.
    """
    if fmt == "csv":
        df.write.mode("overwrite").option("header", True).csv(path)
    elif fmt in ("json", "text"):
        getattr(df.repartition(1).write.mode("overwrite"), fmt)(path)
    else:
        raise ValueError(f"unknown report format {fmt!r}")


def append_rows(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


MONTH = "part_month"


@dataclass(frozen=True)
class TableLayout:
    """Named tables in numbered layers under one root; every step's result can be read and rebuilt by itself."""

    root: str
    # Table name, layer and format.
    tables: dict[str, tuple[str, str]] = field(
        default_factory=lambda: {
            "raw": ("01_raw", "csv"),
            "clean": ("02_intermediate", "parquet"),
            "features": ("04_feature", "parquet"),
            "model_input": ("05_model_input", "parquet"),
            "split_metadata": ("05_model_input", "json"),
            "attributions": ("06_models", "parquet"),
            "feature_importance": ("06_models", "csv"),
            "model_selection": ("06_models", "csv"),
            "run_info": ("06_models", "json"),
            "runs": ("06_models", "parquet"),
            "model_versions": ("06_models", "parquet"),
            "predictions": ("07_model_output", "parquet"),
            "quality_report": ("08_reporting", "text"),
            "drift_reference": ("08_reporting", "text"),
            "drift_analysis": ("08_reporting", "text"),
            "drift_results": ("08_reporting", "csv"),
            "concept_drift": ("08_reporting", "csv"),
        }
    )

    # Tables that grow with time, and the column whose month they are partitioned by.
    by_month: dict[str, str] = field(default_factory=lambda: {c: "ts" for c in ("clean", "features", "model_input", "predictions")})

    def path(self, name: str) -> str:
        return f"{self.root}/{self.tables[name][0]}/{name}"

    def _month_of(self, name: str, columns: Sequence[str]) -> str | None:
        ts = self.by_month.get(name)
        return ts if self.tables[name][1] == "parquet" and ts in columns else None

    def write(self, df: DataFrame, name: str) -> None:
        fmt = self.tables[name][1]
        if ts := self._month_of(name, df.columns):
            write_table(df.withColumn(MONTH, month_text(F.col(ts))), self.path(name), [MONTH], [ts])
        elif fmt == "parquet":
            df.write.mode("overwrite").parquet(self.path(name))
        else:
            write_report(df, self.path(name), fmt)

    def read(
        self, spark: SparkSession, name: str, schema: T.StructType | str | None = None, months: tuple[str, str] | None = None
    ) -> DataFrame:
        """A stored table; of one that is partitioned by month, ``months`` reads only the first to the last (``yyyy-MM``)."""
        fmt = self.tables[name][1]
        reader = spark.read if schema is None else spark.read.schema(schema)
        if fmt == "csv":
            reader = reader.option("header", True)
        df = reader.format(fmt).load(self.path(name))
        if months is not None:
            df = df.where(F.col(MONTH).between(*months))
        return df.drop(MONTH)

    def append(self, df: DataFrame, name: str) -> None:
        """Add rows to a Parquet table, which need not exist yet."""
        if self.tables[name][1] != "parquet":
            raise ValueError(f"table {name!r} can't be appended to")
        append_rows(df, self.path(name))

    def read_or_empty(self, spark: SparkSession, name: str, schema: T.StructType | str) -> DataFrame:
        """The stored table, or no rows of the schema where nothing was stored yet; other errors are raised."""
        try:
            return self.read(spark, name, schema)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], schema)

    def save(self, df: DataFrame, name: str) -> DataFrame:
        """Write, then continue from the written table."""
        self.write(df, name)
        return self.read(df.sparkSession, name, df.schema if self.tables[name][1] != "text" else None)


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    On a local master, where none need be set, a temporary folder stands in for it.
    """
    sc = spark.sparkContext
    folder = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if folder is None:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="gridcast-"))
        folder = sc.getCheckpointDir()
    return folder


def cut(df: DataFrame) -> DataFrame:
    """Write a frame to the shared folder and continue from the written table.

    For a result that several branches read: it's computed once, and a lost executor costs a re-read, not a recompute.
    """
    path = f"{shared_folder(df.sparkSession)}/gridcast/{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._cut_path = path
    return out


def release(*frames: DataFrame) -> None:
    """Delete the tables that `cut` wrote for these frames, once nothing reads them any more. Other frames are left alone."""
    for frame in frames:
        if path := getattr(frame, "_cut_path", None):
            spark = frame.sparkSession
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)


def publish_features(df: DataFrame, ts: str, entity: str = "grid_zone", value: str | None = "DE") -> DataFrame:
    """Feature rows for a store: event time as naive UTC in ``timestamp``, and an entity column.

    ``value`` sets a constant entity; ``None`` takes the existing column named ``entity``.
    """
    out = df.withColumn("timestamp", F.col(ts).cast("timestamp_ntz"))
    out = out.drop(ts) if ts != "timestamp" else out
    return out if value is None else out.withColumn(entity, F.lit(value))


# The feature fields of contract version 1.
CONTRACT_FIELDS = (
    "load_mw", "wind_mw", "solar_mw",
    "lag_1h", "lag_2h", "lag_3h", "lag_6h", "lag_12h", "lag_24h", "lag_48h", "lag_168h",
    "rolling_mean_6h", "rolling_mean_12h", "rolling_mean_24h", "rolling_mean_168h",
    "rolling_std_6h", "rolling_std_12h", "rolling_std_24h",
)
CONTRACT_TTL_DAYS = 365


def contract_v1(entity: str = "grid_zone") -> T.StructType:
    return T.StructType(
        [T.StructField(entity, T.StringType()), T.StructField("timestamp", T.TimestampNTZType())]
        + [T.StructField(c, T.DoubleType()) for c in CONTRACT_FIELDS]
    )


def enforce_contract(df: DataFrame, contract: T.StructType, allow_extra: bool = False) -> DataFrame:
    """Columns in contract order and type; a missing column, or an extra one, is an error (a new version is needed)."""
    missing = [f.name for f in contract.fields if f.name not in df.columns]
    extra = [c for c in df.columns if c not in contract.fieldNames()]
    if missing or (extra and not allow_extra):
        raise ValueError(f"feature contract violated: missing {missing}, extra {extra}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in contract.fields])
