"""Reading one JSON array of objects in parallel.

A JSON array file is one value, so a reader that parses values gives it to one task. Here the
file is read as text records that end at ``}``, which Spark splits by byte ranges like lines. Whether
a record starts inside a string, and how many objects are open there, depends on all the text
before it. Both are sums: of unescaped quotes (modulo 2) and of brackets outside strings.
Each byte range (block) is summed for both ways it may start, the few block rows are
added up in file order, and every record then knows its own place. Most objects are one record;
those with a brace in a string or a nested object are put together from theirs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from indexloom.session import materialize


def _braces(parts: Column, parity: int) -> Column:
    """How many ``{`` stand in the pieces between quotes of one parity."""
    some = F.array_join(F.filter(parts, lambda _, n: n % 2 == parity), "")
    return F.length(F.regexp_replace(some, r"[^{]", ""))


def _measured(spark: SparkSession, path: str) -> DataFrame:
    """Records in file order within their block, with their sums for a block that starts outside (0) or inside (1) a string."""
    meta = F.col("_metadata")
    records = spark.read.option("lineSep", "}").text(path).select(
        meta["file_path"].alias("file"), meta["file_block_start"].alias("block"), meta["file_size"].alias("file_size"),
        F.monotonically_increasing_id().alias("at"), "value",
    )
    parts = F.split(F.regexp_replace("value", r"(?s)\\.", ""), '"', -1)
    records = records.withColumn("_parts", parts).select(
        "*", (F.size("_parts") - 1).alias("flips"), _braces(F.col("_parts"), 0).alias("_b0"), _braces(F.col("_parts"), 1).alias("_b1")
    )
    order = Window.partitionBy("file", "block").orderBy("at")
    before = F.coalesce(F.sum("flips").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) % 2
    placed = records.withColumn("_from", before).select(
        "file", "block", "file_size", "at", "value", "flips",
        *[F.when((F.col("_from") + s) % 2 == 0, F.col("_b0")).otherwise(F.col("_b1")).alias(f"opens{s}") for s in (0, 1)],
        *[((F.col("_from") + s + F.col("flips")) % 2 == 0).alias(f"outside{s}") for s in (0, 1)],
    )
    change = [F.col(f"opens{s}") - F.col(f"outside{s}").cast("int") for s in (0, 1)]
    return placed.select(
        "*", *[c.alias(f"change{s}") for s, c in enumerate(change)], *[F.sum(c).over(order).alias(f"open{s}") for s, c in enumerate(change)]
    )


def _starts(records: DataFrame) -> DataFrame:
    """How each block starts: inside a string or not, open objects, and where the file's last record is."""
    blocks = records.groupBy("file", "block").agg(
        F.sum("flips").alias("flips"), F.sum("change0").alias("change0"), F.sum("change1").alias("change1"), F.max("at").alias("last"),
        F.sum(F.octet_length("value") + 1).alias("size"), F.max("file_size").alias("file_size"),
    )
    # As many rows as a file has blocks; the window sees no others.
    file = Window.partitionBy("file")
    before = file.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    parity = F.coalesce(F.sum("flips").over(before), F.lit(0)) % 2
    blocks = blocks.withColumn("inside", parity == 1)
    change = F.when(F.col("inside"), F.col("change1")).otherwise(F.col("change0"))
    # Without a closing brace at its very end, the file's last record is what follows the last one.
    tail = (F.sum("size").over(file) > F.col("file_size")) & (F.max("block").over(file) == F.col("block"))
    return blocks.withColumn("_change", change).select(
        "file", "block", "inside", F.coalesce(F.sum("_change").over(before), F.lit(0)).alias("depth"), F.when(tail, F.col("last")).alias("rest")
    )


def array_objects(spark: SparkSession, path: str) -> DataFrame:
    """The objects of JSON array files as text: (file, object), in no order.

    Files may hold one array, several, or one object per line. An object that the file ends in
    the middle of comes back unfinished, so that it can't be parsed. Compressed files are one block each.
    """
    records = materialize(_measured(spark, path), "array-records")
    starts = materialize(_starts(records), "array-blocks")
    pick = lambda name: F.when(F.col("inside"), F.col(f"{name}1")).otherwise(F.col(f"{name}0"))
    known = records.join(starts, ["file", "block"]).select(
        "file", "block", "at", "value", (~F.coalesce(F.col("at") == F.col("rest"), F.lit(False))).alias("closed"),
        pick("outside").alias("outside"), (F.col("depth") + pick("open")).alias("depth"), pick("change").alias("change"),
    )
    known = known.withColumn("ends", F.col("closed") & F.col("outside") & (F.col("depth") == 0))
    alone = F.col("ends") & (F.col("change") == 0)
    from_brace = lambda text: F.regexp_replace(text, r"^[^{]*", "")
    whole = known.where(alone).select("file", F.concat(from_brace(F.col("value")), F.lit("}")).alias("object"))

    # Pieces of longer objects: numbered by how many such objects ended before, first within the block.
    pieces = known.where(~alone)
    order = Window.partitionBy("file", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    ended = F.coalesce(F.sum(F.col("ends").cast("long")).over(order), F.lit(0))
    per_block = pieces.groupBy("file", "block").agg(F.sum(F.col("ends").cast("long")).alias("_n"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    base = per_block.select("file", "block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    numbered = pieces.withColumn("_n", ended).join(base, ["file", "block"]).withColumn("number", F.col("_base") + F.col("_n"))
    text = F.concat("value", F.when(F.col("closed"), "}").otherwise(""))
    joined = numbered.groupBy("file", "number").agg(F.array_sort(F.collect_list(F.struct("block", "at", text.alias("text")))).alias("_p"))
    long = joined.select("file", from_brace(F.array_join(F.transform("_p", lambda p: p["text"]), "")).alias("object"))
    return whole.unionByName(long.where(F.col("object") != ""))


def read_array(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows of JSON array files. Absent fields are null, unknown ones dropped; an object that can't be parsed is a row of nulls."""
    parsed = array_objects(spark, path).select(F.from_json("object", schema).alias("o"))
    return parsed.select("o.*")


def write_array(df: DataFrame, path: str) -> None:
    """One JSON array on one line in one file, streamed by a single task as that format demands; nulls are left out."""
    spark = df.sparkSession
    body = df.select(F.to_json(F.struct(*df.columns)).alias("value")).coalesce(1)
    body = body.select(F.concat(F.when(F.monotonically_increasing_id() == 0, "").otherwise(","), F.col("value")).alias("value"))
    edge = lambda text: spark.range(1, numPartitions=1).select(F.lit(text).alias("value"))
    edge("[").union(body).union(edge("]")).coalesce(1).write.option("lineSep", " ").text(path)
