"""What a refresh writes, and the role views over the joined rows that it reads."""

from pathlib import Path

from pyspark.sql import functions as F

from indexloom.registry import ENTITIES
from indexloom.sources import publish
from indexloom.workload import loading, roles


def test_published_tables_are_written_as_zstd(spark, tmp_path):
    root = str(tmp_path / "store")
    publish.refresh({"t": spark.range(5).toDF("id")}, root, "v1")
    parts = [p.name for p in Path(root, "versions").rglob("part-*.parquet")]
    assert parts and all(".zstd." in p for p in parts)
    assert sorted(r.id for r in publish.read_published(spark, root, "t").collect()) == [0, 1, 2, 3, 4]


def test_views_on_the_joined_rows_equal_the_views(spark, sf):
    plain, joined = roles.frames(spark, sf, *ENTITIES), roles.frames_on_base(spark, sf, *ENTITIES)
    for name in ENTITIES:
        assert plain[name].schema == joined[name].schema
        assert plain[name].exceptAll(joined[name]).isEmpty() and joined[name].exceptAll(plain[name]).isEmpty(), name
        if name not in loading._SHUFFLED:
            plan = joined[name]._jdf.queryExecution().executedPlan().toString()
            assert "Join" not in plan and "Exchange" not in plan, name


def test_packed_ids_are_as_distinct_as_their_texts(spark):
    one, two = "00112233-4455-6677-8899-aabbccddeeff", "00112233-4455-6677-8899-aabbccddeefe"
    texts = [one, one, two, one.upper(), one + "\n", "", "0123456789abcdef", "x", None]
    df = spark.createDataFrame([(t,) for t in texts], "id string")
    assert df.agg(F.countDistinct(loading._packed(df, "id"))).first()[0] == df.agg(F.countDistinct("id")).first()[0] == 7
    assert df.limit(1).select(F.length(loading._packed(df, "id"))).first()[0] == 16
    numbers = spark.range(3).toDF("id")
    assert numbers.agg(F.countDistinct(loading._packed(numbers, "id"))).first()[0] == 3
