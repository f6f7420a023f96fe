"""Sources and sinks.

Raw data is laid out as ``{root}/{dataset}/{table}.csv`` (one folder per
dataset). Readers take a glob over all datasets at once and derive the
``dataset`` column from the file path, so one job covers every dataset
(A12). Processed tables are parquet folders partitioned by ``dataset``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.errors import AnalysisException

from polyvox import schemas
from polyvox.functions.exprs import agreeability_guarded
from polyvox.operators.votes import latest_vote
from polyvox.sources import commits, csvscan

_DATASET_FROM_PATH = r"([^/]+)/[^/]+$"


def _with_dataset(df: DataFrame) -> DataFrame:
    return df.withColumn("dataset", F.regexp_extract(F.col("_metadata.file_path"),
                                                     _DATASET_FROM_PATH, 1))


def _glob(root: str, table: str, datasets: list[str] | None, ext: str) -> list[str]:
    root = root.rstrip("/")
    if not datasets:
        return [f"{root}/*/{table}.{ext}"]
    return [f"{root}/{d}/{table}.{ext}" for d in datasets]


def read_summary(spark: SparkSession, root: str, datasets: list[str] | None = None) -> DataFrame:
    """A1: headerless two-column ``summary.csv`` -> (dataset, key, value)."""
    df = (spark.read.schema(schemas.RAW_SUMMARY).option("header", False)
          .option("multiLine", True).option("escape", '"')
          .csv(_glob(root, "summary", datasets, "csv")))
    return _with_dataset(df).select("dataset", "key", "value")


def summary_map(summary: DataFrame) -> DataFrame:
    """A1 ``getAll``: one row per dataset with a key -> value map."""
    return summary.groupBy("dataset").agg(
        F.map_from_entries(F.collect_list(F.struct("key", "value"))).alias("summary"))


def cast_to(df: DataFrame, schema: StructType) -> DataFrame:
    """B1: cast the listed columns by name; unlisted columns pass through.
    Casts are ANSI (overflow raises), like a strict cast."""
    have = set(df.columns)
    return df.withColumns({f.name: F.col(f.name).cast(f.dataType)
                           for f in schema.fields if f.name in have})


def preprocess_comments(df: DataFrame) -> DataFrame:
    """A3: rename raw columns, drop ``datetime``, add guarded agreeability."""
    return (df.withColumnsRenamed({"comment-body": "commentText", "author-id": "authorId",
                                   "comment-id": "commentId"})
            .drop("datetime")
            .withColumn("agreeability", agreeability_guarded()))


def preprocess_votes(df: DataFrame, pass_cancels: bool = False) -> DataFrame:
    """A4: rename, drop passes, keep each voter's latest vote per comment.
    Ties on timestamp go to the larger vote (survey Q9)."""
    v = df.withColumnsRenamed({"comment-id": "commentId", "voter-id": "voterId"})
    return latest_vote(v, ["timestamp", "vote"], ts="timestamp", pass_cancels=pass_cancels)


def read_csv_table(spark: SparkSession, root: str, table: str, raw_schema: StructType,
                   preprocess: Callable[[DataFrame], DataFrame] | None = None,
                   schema: StructType | None = None,
                   datasets: list[str] | None = None, multi_line: bool = True) -> DataFrame:
    """A2 + M1: CSV with header (quoted fields may hold commas, quotes and, with
    ``multi_line``, newlines) -> ``dataset`` from the path -> user ``preprocess``
    -> casts. Either way many tasks read a large file; with ``multi_line``
    record borders are found first (``csvscan``)."""
    paths = _glob(root, table, datasets, "csv")
    if multi_line:
        df = (csvscan.read_csv(spark, paths, raw_schema)
              .withColumn("dataset", F.regexp_extract("path", _DATASET_FROM_PATH, 1)).drop("path"))
    else:
        df = _with_dataset(spark.read.schema(raw_schema).option("header", True).option("escape", '"').option("mode", "FAILFAST").csv(paths))
    if preprocess is not None:
        df = df.transform(preprocess)
    return cast_to(df, schema) if schema is not None else df


def read_comments(spark: SparkSession, root: str, datasets: list[str] | None = None) -> DataFrame:
    return read_csv_table(spark, root, "comments", schemas.RAW_COMMENTS, preprocess_comments,
                          schemas.COMMENTS, datasets)


def read_votes(spark: SparkSession, root: str, datasets: list[str] | None = None) -> DataFrame:
    return read_csv_table(spark, root, "votes", schemas.RAW_VOTES, preprocess_votes,
                          schemas.VOTES, datasets, multi_line=False)  # numbers only: no quoted newlines


def table_path(data_root: str, table: str) -> str:
    """A10: one folder per table, partitioned by dataset."""
    return f"{data_root.rstrip('/')}/{table}"


def db_table_name(dataset: str, table: str) -> str:
    """A10: the reference's database table name ``{dataset}-{table}``, '.' -> '-'."""
    return f"{dataset}-{table}".replace(".", "-")


def read_table(spark: SparkSession, data_root: str, table: str, schema: StructType | None = None,
               datasets: list[str] | None = None) -> DataFrame:
    """A5: a table as its commit records state it (``commits``), or a plain parquet folder where it has
    none; optionally cast to ``schema``; ``datasets`` prunes partitions."""
    path = table_path(data_root, table)
    df = commits.read(spark, path)
    if df is None:
        if commits.begun(spark, path):
            raise FileNotFoundError(f"{path}: no write was committed")
        df = spark.read.parquet(path)
    if datasets:
        df = df.filter(F.col("dataset").isin(datasets))
    return cast_to(df, schema) if schema is not None else df


def write_table(df: DataFrame, data_root: str, table: str, worked: DataFrame | None = None, run: str | None = None) -> None:
    """Replace the datasets present in ``df`` and those listed in ``worked`` (what this run worked on:
    without rows they become empty). Visible whole, by one commit record, or not at all."""
    commits.write(df, table_path(data_root, table), True, worked, run)


def append_table(df: DataFrame, data_root: str, table: str, worked: DataFrame | None = None, run: str | None = None) -> None:
    """G1: add rows to a table, by dataset, with exactly the columns and types it has. A failed append leaves
    nothing behind and the same ``run`` appends once, however often it is repeated."""
    spark, path = df.sparkSession, table_path(data_root, table)
    if exists(spark, path):
        have = {f.name: f.dataType for f in read_table(spark, data_root, table).schema.fields}
        new = {f.name: f.dataType for f in df.schema.fields}
        if have != new:
            raise ValueError(f"{table}: columns differ: {sorted(set(map(str, have.items())) ^ set(map(str, new.items())))}")
        if commits.records(spark, path) is None:
            raise ValueError(f"{table}: a plain parquet folder without commit records; write_table it first")
    commits.write(df, path, False, worked, run)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether folder ``path`` holds a table: commit records, or plain parquet files."""
    if commits.begun(spark, path):
        return commits.records(spark, path) is not None
    try:
        spark.read.parquet(path).schema  # noqa: B018 - resolves the path only
        return True
    except AnalysisException:
        return False


def raw_datasets(spark: SparkSession, root: str, table: str, datasets: list[str] | None = None) -> list[str]:
    """Names of the datasets that have a raw file of ``table``; files are listed, not read."""
    found = (spark.read.format("binaryFile").option("pathGlobFilter", f"{table}.csv")
             .load(f"{root.rstrip('/')}/*").select(F.regexp_extract("path", _DATASET_FROM_PATH, 1).alias("d")))
    names = {r["d"] for r in found.distinct().collect()}
    return sorted(names if not datasets else names & set(datasets))


def load_comments(spark: SparkSession, data_root: str, raw_root: str,
                  datasets: list[str] | None = None) -> DataFrame:
    """A11, dataset by dataset: processed comments where they are written, else the raw CSV. A processed
    table's columns beyond those of the raw data (vectors, results of later tasks) are left out."""
    columns = [f.name for f in schemas.COMMENTS.fields]
    raw, stored = raw_datasets(spark, raw_root, "comments", datasets), None
    if exists(spark, table_path(data_root, "comments")):
        stored = read_table(spark, data_root, "comments", schemas.COMMENTS, datasets)
        done = {r["dataset"] for r in stored.select("dataset").distinct().collect()}  # partition names
        raw = [d for d in raw if d not in done]
    if not raw and stored is not None:
        return stored.select(*[c for c in stored.columns if c in columns])
    fresh = read_comments(spark, raw_root, raw or datasets)
    return fresh if stored is None else stored.select(*fresh.columns).unionByName(fresh)


def read_jdbc(spark: SparkSession, url: str, table: str, schema: StructType | None = None,
              properties: dict | None = None, split: tuple[str, int, int, int] | None = None) -> DataFrame:
    """A database table (``customSchema`` fixes the column types). ``split``
    (numeric column, lowest, highest, partitions) reads it by many tasks; without
    it one task reads all."""
    r = spark.read.format("jdbc").option("url", url).option("dbtable", f'"{table}"')
    if split:
        for k, v in zip(("partitionColumn", "lowerBound", "upperBound", "numPartitions"), split, strict=True):
            r = r.option(k, v)
    if schema is not None:
        r = r.option("customSchema", ", ".join(f"{f.name} {f.dataType.simpleString()}"
                                               for f in schema.fields))
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    return r.load()


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict | None = None) -> None:
    """Replace the database table (written by all tasks in parallel)."""
    w = df.write.format("jdbc").mode("overwrite").option("url", url).option("dbtable", f'"{table}"')
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    w.save()


def save(df: DataFrame, data_root: str, table: str, db_url: str | None = None,
         properties: dict | None = None) -> DataFrame:
    """Write to the database (when configured) and to parquet, computing
    ``df`` once: the parquet copy is written first and the database copy is
    loaded from it."""
    write_table(df, data_root, table)
    stored = read_table(df.sparkSession, data_root, table)
    if db_url:
        write_jdbc(stored, db_url, table, properties)
    return stored


def empty(spark: SparkSession, schema: StructType) -> DataFrame:
    """A15."""
    return spark.createDataFrame([], schema)
