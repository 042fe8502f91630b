"""Full refresh of the relational tables, published all or nothing.

A load goes to a folder of its own. What is published is a log of numbered entries,
each naming a version and its folder. An entry is written only after every
table is in place and every check came out empty, and the storage creates a number
once only, so of two loads that finish together one gets it and the other takes
the next or gives up. Readers follow the last entry; a failed load leaves them where they were.
"""

from __future__ import annotations

import json
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from indexloom.session import AT_ONCE
from indexloom.sources import files


class LoadRefused(Exception):
    """Checks found violations; nothing was published."""


class LostRace(Exception):
    """Another load was published since the one this load started from."""


def refresh(
    tables: dict[str, DataFrame], root: str, version: str, checks: dict[str, DataFrame] | None = None, after: str | None = None
) -> dict[str, int]:
    """Write all tables as ``version``, then publish; returns row counts per table.

    ``checks`` are jobs whose rows are violations. They run first and only one
    row of each is fetched. Counts are taken while writing. A full refresh depends on nothing
    published before, so a load that finishes behind another follows it; with ``after`` it
    is published only as successor of that version, else it ends in ``LostRace``.
    """
    for name, violations in (checks or {}).items():
        sample = violations.take(1)
        if sample:
            raise LoadRefused(f"{name}: {sample[0].asDict()}")
    spark = next(iter(tables.values())).sparkSession
    root = root.rstrip("/")
    if version in (e["version"] for e in _entries(spark, root)):
        raise FileExistsError(f"version {version} is published already")
    # A folder of its own, so that a load that failed half-way can be tried again under its name.
    folder = f"{version}-{uuid.uuid4().hex}"

    def write(name: str) -> int:
        seen = Observation(f"rows of {name}")
        rows = tables[name].observe(seen, F.count(F.lit(1)).alias("n"))
        # Ids and digests are hexadecimal text: half their bytes, which the default codec doesn't find.
        rows.write.option("compression", "zstd").parquet(f"{root}/versions/{folder}/{name}")
        return seen.get["n"]

    with ThreadPoolExecutor(AT_ONCE) as pool:
        counts = dict(zip(tables, pool.map(write, tables)))
    _publish(spark, root, {"version": version, "folder": folder, "rows": counts}, after)
    return counts


def _publish(spark: SparkSession, root: str, entry: dict, after: str | None) -> None:
    while True:
        taken, log = _numbers(spark, root), _entries(spark, root)
        if after is not None and (not log or log[-1]["version"] != after):
            raise LostRace(f"{entry['version']} was to follow {after}, but the last one is {log[-1]['version'] if log else 'none'}")
        if entry["version"] in (e["version"] for e in log):
            raise FileExistsError(f"version {entry['version']} is published already")
        number = max(taken, default=0) + 1
        try:
            files.write_text_once(spark, f"{root}/log/{number:012d}.json", json.dumps(entry))
            return
        except FileExistsError:
            continue  # another load took this number: look again


def _numbers(spark: SparkSession, root: str) -> list[int]:
    return sorted(int(n.removesuffix(".json")) for n in files.list_names(spark, f"{root}/log") if n.removesuffix(".json").isdigit())


def _entries(spark: SparkSession, root: str) -> list[dict]:
    """Published entries in order; an unfinished one (its writer died) is passed over."""
    texts = files.read_texts(spark, f"{root}/log")
    out = []
    for number in _numbers(spark, root):
        try:
            out.append(json.loads(texts.get(f"{number:012d}.json", "")))
        except ValueError:
            continue
    return out


def published_version(spark: SparkSession, root: str) -> str:
    """The version published last."""
    log = _entries(spark, root.rstrip("/"))
    if not log:
        raise FileNotFoundError(f"nothing published below {root}")
    return log[-1]["version"]


def read_published(spark: SparkSession, root: str, table: str, version: str | None = None) -> DataFrame:
    """One table of a version, by default of the last one."""
    root = root.rstrip("/")
    found = [e for e in _entries(spark, root) if version in (None, e["version"])]
    if not found:
        raise FileNotFoundError(f"{version or 'nothing'} published below {root}")
    return spark.read.parquet(f"{root}/versions/{found[-1]['folder']}/{table}")
