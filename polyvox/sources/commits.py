"""Tables with commit records (A6, G1, J11): a write is seen whole or not at all.

    {table}/rows/run={run}/dataset={dataset}/*.parquet    rows of one write
    {table}/commits/run={run}/*.parquet                   its commit record, written last

A record holds one row per dataset the write worked on: its sequence number, whether the
rows replace the dataset's earlier ones or are added to them, how many there are (0 too:
an empty result is a commit, and it replaces) and the schema. Readers start from the
records: of each dataset they take the newest replacing write and what was added after
it. A write that fails, in any place, has no record, so nothing of it is visible; the same
``run`` may then be written again, and a run that is already committed is left as it is,
so a repeated append adds nothing twice. Old rows stay until ``vacuum``: a job may
replace the very table that it reads, and readers that have begun keep their files.

Writers that commit at the same moment may get one sequence number; their order is then
that of the run names.
"""

from __future__ import annotations

import json
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

RECORD = "seq bigint, dataset string, replaces boolean, n bigint, columns string, run string"


def records(spark: SparkSession, path: str) -> DataFrame | None:
    """Commit records of the table in folder ``path``; None where it has none."""
    try:
        return spark.read.schema(RECORD).parquet(f"{path}/commits")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def begun(spark: SparkSession, path: str) -> bool:
    """Whether anything was ever written to ``path`` in this layout, committed or not."""
    try:
        return spark.read.schema(RECORD).parquet(f"{path}/rows") is not None
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return False


def live(found: DataFrame) -> DataFrame:
    """Records whose rows are part of the table: each dataset's newest replacing write and later ones."""
    order = F.struct("seq", "run")
    base = (found.groupBy(F.col("dataset").alias("__d")).agg(F.max(F.when(F.col("replaces"), order)).alias("__base")))
    return (found.join(base, F.col("dataset").eqNullSafe(F.col("__d")))
            .filter(F.col("__base").isNull() | (order >= F.col("__base"))).drop("__d", "__base"))


def _rows(spark: SparkSession, path: str, runs: list[str], columns: str) -> DataFrame:
    stored = StructType.fromJson(json.loads(columns))
    whole = StructType([*stored.fields, StructField("run", StringType())])
    return (spark.read.schema(whole).option("basePath", f"{path}/rows")
            .parquet(*[f"{path}/rows/run={r}" for r in runs]))


def read(spark: SparkSession, path: str) -> DataFrame | None:
    """The table as it is now (None: no commit yet), with the columns of its newest write; older rows hold
    null in columns they don't have. Names of live writes come to the driver: one per replacing or adding
    write that still counts, never rows."""
    found = records(spark, path)
    if found is None:
        return None
    now = live(found)
    writes = (now.groupBy("run").agg(F.max(F.struct("seq", "run", "columns")).alias("w"))
              .select("w.*").orderBy("seq", "run").collect())
    if not writes:
        return None
    out = _rows(spark, path, [w["run"] for w in writes], writes[-1]["columns"])
    if len(writes) > 1:  # a dataset may have rows in a write that counts for other datasets only
        counts = now.select(F.col("run").alias("__r"), F.col("dataset").alias("__d"))
        out = out.join(counts, (F.col("run") == F.col("__r")) & F.col("dataset").eqNullSafe(F.col("__d")), "left_semi")
    stored = [c for c in out.columns if c not in ("run", "dataset")]
    return out.select(*stored, "dataset")


def write(df: DataFrame, path: str, replaces: bool, worked: DataFrame | None = None, run: str | None = None) -> str:
    """Write ``df`` (with a ``dataset`` column) as one commit; returns the run's name. A replacing write
    replaces the datasets it has rows of and those named in ``worked`` (a table with a ``dataset`` column),
    the latter with nothing where it has none. ``df`` is computed once; the record comes from the stored rows."""
    spark = df.sparkSession
    run = run or uuid.uuid4().hex
    if not run.replace("-", "").replace("_", "").replace(".", "").isalnum():
        raise ValueError(f"run name {run!r}: letters, digits, '-', '_' and '.' only")
    found, last = records(spark, path), 0
    if found is not None:
        have = found.agg(F.max("seq").alias("seq"), F.max(F.col("run") == run).alias("done")).first()
        if have["done"]:
            return run
        last = have["seq"] or 0
    columns = StructType([StructField(f.name, f.dataType) for f in df.schema.fields if f.name != "dataset"]
                         + [StructField("dataset", StringType())])
    (df.withColumn("dataset", F.col("dataset").cast("string"))
     .write.mode("overwrite").partitionBy("dataset").parquet(f"{path}/rows/run={run}"))
    made = _rows(spark, path, [run], columns.json()).groupBy("dataset").agg(F.count("*").alias("n"))
    if worked is not None:
        made = (made.unionByName(worked.select(F.col("dataset").cast("string"), F.lit(0).cast(LongType()).alias("n")))
                .groupBy("dataset").agg(F.sum("n").alias("n")))
    (made.select(F.lit(last + 1).cast("bigint").alias("seq"), "dataset", F.lit(replaces).alias("replaces"), "n",
                 F.lit(columns.json()).alias("columns"))
     .coalesce(1).write.mode("overwrite").parquet(f"{path}/commits/run={run}"))  # one file: there or not there
    return run


def vacuum(spark: SparkSession, path: str, keep: list[str] = ()) -> list[str]:
    """Delete the row folders of committed writes that no longer count for any dataset; returns their
    names. Folders without a record may belong to a running write and stay. Readers that began before the
    replacing write must have ended, or their run's name be in ``keep``."""
    found = records(spark, path)
    if found is None:
        return []
    dead = [r["run"] for r in found.select("run").distinct().join(live(found).select("run").distinct(), "run", "left_anti").collect()
            if r["run"] not in keep]
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for run in dead:
        folder = jvm.org.apache.hadoop.fs.Path(f"{path}/rows/run={run}")
        folder.getFileSystem(conf).delete(folder, True)
    return sorted(dead)
