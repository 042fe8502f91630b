"""Run folders: one set of entity files per run, named so that text order is time order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from indexloom.registry import ENTITIES
from indexloom.sources import arrays, files

RUN_PREFIX = "run_"
RUN_COLUMN = "run_id"


def latest_run(spark: SparkSession, root: str, prefix: str = RUN_PREFIX) -> str:
    """Greatest run name below ``root``; other folders are ignored."""
    names = [n for n in files.list_names(spark, root, directories=True) if n.startswith(prefix)]
    if not names:
        raise FileNotFoundError(f"no run below {root}")
    return max(names)


def missing_entities(spark: SparkSession, run_dir: str, suffix: str = ".json") -> list[str]:
    """Entities the run has no file for; ask before any output is written."""
    present = set(files.list_names(spark, run_dir))
    return [name for name in ENTITIES if name + suffix not in present]


def read_entity(
    spark: SparkSession, run_dir: str, entity: str, suffix: str = ".json", array: bool = True, as_text: bool = True
) -> DataFrame:
    """Rows of one entity file. Absent fields become null, unknown fields are dropped.

    Fields are read as text (keys such as '1.0' must stay text; a bad number
    rejects its own row later, in cleaning). A JSON array is read in byte ranges
    by many tasks (``arrays``); ``array=False`` reads one object per line.
    """
    schema = ENTITIES[entity].schema(as_text)
    path = f"{run_dir}/{entity}{suffix}"
    return arrays.read_array(spark, path, schema) if array else spark.read.schema(schema).json(path)


def read_run(spark: SparkSession, run_dir: str, **options) -> dict[str, DataFrame]:
    """All fifteen entities, or an error naming what is missing."""
    gaps = missing_entities(spark, run_dir, options.get("suffix", ".json"))
    if gaps:
        raise FileNotFoundError(f"{run_dir} lacks {', '.join(gaps)}")
    return {name: read_entity(spark, run_dir, name, **options) for name in ENTITIES}


def write_run(frames: dict[str, DataFrame], root: str, run_id: str, fmt: str = "parquet") -> str:
    """One folder per entity under the run. ``fmt='json'`` writes one object per line."""
    target = f"{root.rstrip('/')}/{run_id}"
    for name, df in frames.items():
        df.write.format(fmt).save(f"{target}/{name}{'.json' if fmt == 'json' else ''}")
    return target


def store_run(frames: dict[str, DataFrame], store: str, run_id: str) -> None:
    """Add a run to the store: per entity one table partitioned by run. Writing a run again replaces its partitions only."""
    for name, df in frames.items():
        rows = df.withColumn(RUN_COLUMN, F.lit(run_id))
        # A run without rows of an entity still gets its partition, so that it counts as complete.
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(RUN_COLUMN).parquet(f"{store}/{name}")
        files.make_folder(df.sparkSession, f"{store}/{name}/{RUN_COLUMN}={run_id}")


def stored_runs(spark: SparkSession, store: str, entities: Sequence[str] = tuple(ENTITIES)) -> list[str]:
    """Runs that have a partition in every entity's table, in text order; one still being written is not among them."""
    found = [
        {n.removeprefix(f"{RUN_COLUMN}=") for n in files.list_names(spark, f"{store}/{e}", directories=True) if n.startswith(f"{RUN_COLUMN}=")}
        for e in entities
    ]
    return sorted(set.intersection(*found)) if found else []


def read_stored(
    spark: SparkSession, store: str, entity: str, run_id: str | None = None, schema: T.StructType | None = None,
    entities: Sequence[str] = tuple(ENTITIES),
) -> DataFrame:
    """One entity of a run, by default of the latest complete one.

    The run is known from folder names before the query is planned, so the scan lists and
    reads that one partition. ``schema`` is the entity's own if left out.
    """
    if run_id is None:
        runs = stored_runs(spark, store, entities)
        if not runs:
            raise FileNotFoundError(f"no complete run below {store}")
        run_id = runs[-1]
    columns = schema or ENTITIES[entity].schema()
    full = T.StructType([*columns.fields, T.StructField(RUN_COLUMN, T.StringType())])
    return spark.read.schema(full).parquet(f"{store}/{entity}").where(F.col(RUN_COLUMN) == run_id)


def read_latest(snapshots: DataFrame, run_column: str) -> DataFrame:
    """Rows of the greatest run in a table of runs.

    The greatest run id is a scalar subquery, known before the main scan
    starts; with ``run_column`` as partition column only that run is read.
    """
    spark = snapshots.sparkSession
    query = f"select * from {{s}} where {run_column} = (select max({run_column}) from {{s}})"
    return spark.sql(query, s=snapshots)


def missing_per_run(listing: DataFrame, run: str, entity: str, expected: Sequence[str]) -> DataFrame:
    """Expected entities each run lacks: (run, entity). Empty means every run is complete."""
    wanted = F.array(*[F.lit(e) for e in expected])
    present = listing.groupBy(run).agg(
        F.collect_set(F.when(F.col(entity).isin(*expected), F.col(entity))).alias("_present")
    )
    return present.select(run, F.explode(F.array_except(wanted, "_present")).alias(entity))


def row_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """(entity, n_rows) for every entity and the total under 'total'."""
    parts = [df.agg(F.count("*").alias("n_rows")).select(F.lit(n).alias("entity"), "n_rows") for n, df in frames.items()]
    lines = parts[0]
    for part in parts[1:]:
        lines = lines.unionByName(part)
    return lines.rollup("entity").agg(F.sum("n_rows").alias("n_rows")).select(
        F.coalesce("entity", F.lit("total")).alias("entity"), "n_rows"
    )
