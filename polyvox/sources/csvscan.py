"""CSV records with quoted newlines, read by many tasks per file (A2, A3).

Where a record ends depends on all quotes before it, which makes Spark's ``multiLine`` reader take
a file in one task. Here the file is scanned as lines by byte ranges. Each line is a
transition between two states, outside or inside quotes, worked out for both states it may
start in; transitions compose, so a range is a transition too, and composing the ranges (a few
rows per file) tells every range, and then every line, its true state. A line outside quotes starts
a record; lines up to the next start belong to it, across range borders.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# possessive quantifiers: no backtracking and no recursion on long fields
_QUOTED = r'(^|,)"[^"]*+(?:""[^"]*+)*+"(?=,|$)'      # a whole quoted field
_OPENED = r'(^|,)"'                                  # a quote at the start of a field
_CLOSED = r'^[^"]*+(?:""[^"]*+)*+"(?=,|$)'           # the rest of a quoted field


def _from_outside(line: Column) -> Column:
    """1 if a line that starts outside quotes ends inside them."""
    return F.regexp_replace(line, _QUOTED, "$1").rlike(_OPENED).cast("int")


def _transition(line: Column) -> tuple[Column, Column]:
    """The state after the line, for the states 0 (outside) and 1 (inside) before it."""
    plain = ~F.contains(line, F.lit('"'))
    inside = F.when(line.rlike(_CLOSED), _from_outside(F.regexp_replace(line, _CLOSED, ""))).otherwise(F.lit(1))
    return F.when(plain, F.lit(0)).otherwise(_from_outside(line)), F.when(plain, F.lit(1)).otherwise(inside)


def _composed(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Adds ``s0, s1``: the state before each row, for the states 0 and 1 before the group's first row.

    Of ``e0, e1`` a row either forces a state (e0 = e1), keeps it or swaps it: the state is the last forced
    one, or the group's first, swapped as often as rows since did so."""
    upto = Window.partitionBy(*keys).orderBy(order)
    now = upto.rowsBetween(Window.unboundedPreceding, 0)
    before = upto.rowsBetween(Window.unboundedPreceding, -1)
    swaps = F.sum(F.when(F.col("e0") > F.col("e1"), 1).otherwise(0))
    forced = F.col("e0") == F.col("e1")
    d = df.withColumns({"__n": swaps.over(now), "__p": F.coalesce(swaps.over(before), F.lit(0))})
    d = d.withColumns({"__f": F.last(F.when(forced, F.col("e0")), ignorenulls=True).over(before),
                       "__fn": F.last(F.when(forced, F.col("__n")), ignorenulls=True).over(before)})
    state = lambda s: ((F.coalesce("__f", F.lit(s)) + F.col("__p") - F.coalesce("__fn", F.lit(0))) % 2).cast("int")
    return d.withColumns({"s0": state(0), "s1": state(1)}).drop("__n", "__p", "__f", "__fn")


def records(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(path, block, line, record) of every record of the files: ``block`` is the byte range that it
    starts in and ``line`` its number there. A file that ends inside quotes raises."""
    raw = spark.read.option("lineSep", "\n").text(paths).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"), F.regexp_replace("value", "\r$", "").alias("text"), "value")
    e0, e1 = _transition(F.col("text"))
    in_block = Window.partitionBy("path", "block").orderBy("seq")
    lines = _composed(raw.select("*", e0.alias("e0"), e1.alias("e1")), ["path", "block"], "seq")
    lines = lines.withColumn("line", F.row_number().over(in_block))

    after = lambda s: F.when(F.col(s) == 0, F.col("e0")).otherwise(F.col("e1"))
    starts = lambda s: F.max(F.when(F.col(s) == 0, F.col("line")))
    blocks = (lines.withColumns({"a0": after("s0"), "a1": after("s1")}).groupBy("path", "block")
              .agg(F.max(F.struct("line", "a0", "a1")).alias("end"), starts("s0").alias("l0"), starts("s1").alias("l1"))
              .select("path", "block", F.col("end.a0").alias("e0"), F.col("end.a1").alias("e1"), "l0", "l1"))
    # a row per byte range: their own composition
    blocks = _composed(blocks, ["path"], "block").select("path", "block", "e0", "e1", F.col("s0").alias("start"), "l0", "l1")
    file = Window.partitionBy("path").orderBy("block")
    last = F.when(F.col("start") == 0, F.col("l0")).otherwise(F.col("l1"))
    carried = F.last(F.when(last.isNotNull(), F.struct("block", last.alias("line"))), ignorenulls=True)
    blocks = blocks.withColumns({
        "open": carried.over(file.rowsBetween(Window.unboundedPreceding, -1)),
        "ends": F.when(F.lead("block").over(file).isNull(), F.when(F.col("start") == 0, F.col("e0")).otherwise(F.col("e1")))})
    wrong = F.raise_error(F.concat(F.lit("a quote is never closed in "), "path"))
    blocks = blocks.filter(F.when(F.coalesce("ends", F.lit(0)) == 0, F.lit(True)).otherwise(wrong.cast("boolean")))

    known = lines.join(blocks.select("path", "block", "start", "open"), ["path", "block"])
    known = known.withColumn("at", F.when(F.col("start") == 0, F.col("s0")).otherwise(F.col("s1")))
    own = F.last(F.when(F.col("at") == 0, F.col("line")), ignorenulls=True).over(in_block.rowsBetween(Window.unboundedPreceding, 0))
    head = F.when(own.isNotNull(), F.struct("block", own.alias("line"))).otherwise(F.col("open"))
    known = known.select("path", head.alias("head"), "block", "line", "value", (((F.col("at") == 0) & (F.col("e0") == 0))).alias("whole"))
    single = known.filter("whole").select("path", "head", F.col("value").alias("record"))
    joined = (known.filter("NOT whole").groupBy("path", "head")
              .agg(F.array_sort(F.collect_list(F.struct("block", "line", "value"))).alias("l"))
              .select("path", "head", F.array_join(F.transform("l", lambda x: x["value"]), "\n").alias("record")))
    return single.unionByName(joined).select("path", "head.block", "head.line", F.regexp_replace("record", "\r$", "").alias("record"))


def read_csv(spark: SparkSession, paths: str | list[str], schema: StructType) -> DataFrame:
    """Rows of CSV files with a header line, as ``schema`` and the file's ``path``. Empty lines are skipped; a
    record that doesn't fit the schema raises."""
    rows = records(spark, paths).filter("NOT (block = 0 AND line = 1) AND record <> ''")
    parsed = F.from_csv("record", _ddl(schema), {"escape": '"', "mode": "FAILFAST"})
    return rows.select("path", parsed.alias("r")).select("path", "r.*")


def _ddl(schema: StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
