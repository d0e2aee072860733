"""The dealt queries on odd tables: nulls everywhere, copies, extra columns, no rows."""

import pytest
from pyspark.sql import functions as F

from vernissage import queries

from .conftest import SF, rows

TABLES = ("artworks", "artists", "crawls", "fx_rates")
NAMES = sorted(n for n in queries.QUERIES if n.startswith("p") and n[1].isdigit() and n.endswith("_found"))
CLASHES = ("seq", "leaf", "value", "version", "unit", "text", "best", "rank", "at", "obs", "platform_id", "common_value", "factor", "n", "id")


def spoiled(spark, folder, kind, tables=TABLES):
    for t in tables:
        df = spark.read.parquet(f"{SF}/{t}.parquet")
        if kind == "empty":
            df = df.filter("false")
        elif kind == "nulls":
            df = df.unionByName(df.limit(3).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema]))
        elif kind == "clashes":
            df = df.withColumns({c: F.lit("x") for c in CLASHES if c not in df.columns})
        elif kind == "copies" and t in ("artworks", "artists"):
            df = df.unionByName(df).repartition(7)
        df.write.parquet(f"{folder}/{t}.parquet")
    return str(folder)


@pytest.mark.parametrize("name", NAMES)
@pytest.mark.parametrize("kind", ["nulls", "clashes", "copies"])
def test_odd_rows_change_nothing(spark, tmp_path, name, kind):
    want = rows(queries.QUERIES[name](spark, SF))
    assert want
    assert rows(queries.QUERIES[name](spark, spoiled(spark, tmp_path, kind))) == want


@pytest.mark.parametrize("name", NAMES)
def test_empty_tables(spark, tmp_path, name):
    assert queries.QUERIES[name](spark, spoiled(spark, tmp_path, "empty")).count() == 0


@pytest.mark.parametrize("name", NAMES)
def test_no_row_twice(spark, name):
    df = queries.QUERIES[name](spark, SF)
    assert df.count() == df.distinct().count()
