"""Licence expressions checked against a table of published identifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from indexloom.functions.text import license_marks, license_tokens, well_formed_license
from indexloom.operators.keys import resolve_spread


def valid_licenses(
    df: DataFrame, column: str, ids: DataFrame, exceptions: DataFrame | None = None, name: str = "valid"
) -> DataFrame:
    """``df`` with ``name``: whether its licence text is an SPDX expression over the first column of ``ids``.

    Identifiers compare case-blind; ``exceptions`` lists what may follow WITH. Each different text
    is taken apart once, its tokens with their place meet the identifier tables in joins, and the
    marks they get are put back in order. A null text stays null; a column of that name is replaced.
    """
    rows = df.drop(name) if name != column else df
    texts = rows.select(F.col(column).alias("_text")).where("_text is not null").distinct()
    tokens = texts.select("_text", F.posexplode_outer(license_tokens(F.col("_text"))).alias("_at", "_token"))
    known = ids.select(F.lower(F.col(ids.columns[0])).alias("_id")).distinct().withColumn("_known", F.lit(True))
    found = tokens.join(known, F.lower(F.regexp_replace("_token", r"\+$", "")) == F.col("_id"), "left").drop("_id")
    if exceptions is None:
        found = found.withColumn("_except", F.lit(False))
    else:
        listed = exceptions.select(F.lower(F.col(exceptions.columns[0])).alias("_id")).distinct().withColumn("_except", F.lit(True))
        found = found.join(listed, F.lower("_token") == F.col("_id"), "left").drop("_id")
    is_known, is_exception = (F.coalesce(F.col(c), F.lit(False)) for c in ("_known", "_except"))
    mark = F.when(F.col("_token").isNotNull(), F.struct(F.col("_at"), license_marks(F.col("_token"), is_known, is_exception).alias("mark")))
    marks = F.transform(F.array_sort(F.collect_list(mark)), lambda m: m["mark"])
    judged = found.groupBy("_text").agg(well_formed_license(marks).alias("_valid"))
    # Few different texts stand on most rows.
    return resolve_spread(rows, judged, [column], ["_text"], "_valid").withColumnRenamed("_valid", name)
