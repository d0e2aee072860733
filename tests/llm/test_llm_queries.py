import pytest

from vernissage.llm import queries

from ..conftest import SF, rows
from ..oracle import compare
from ..test_robust import spoiled

TABLES = ("artworks", "artists", "crawls", "fx_rates", "house_artists", "documents", "eval_items", "lang_samples")
NAMES = sorted(n for n in queries.QUERIES if n.endswith("_found") or n == "p7_ids")


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_agrees_with_sql(spark, name):
    compare(spark, name, queries.QUERIES[name], queries.ORACLES[name], SF)


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLES)))
def test_query_runs(spark, name):
    df = queries.QUERIES[name](spark, SF)
    assert df.count() == df.distinct().count()


@pytest.mark.parametrize("name", NAMES)
@pytest.mark.parametrize("kind", ["nulls", "clashes"])
def test_odd_rows_change_nothing(spark, tmp_path, name, kind):
    want = rows(queries.QUERIES[name](spark, SF))
    got = rows(queries.QUERIES[name](spark, spoiled(spark, tmp_path, kind, TABLES)))
    if name == "p7_ids":
        got = [r for r in got if r[0] is not None]
    assert got == want


@pytest.mark.parametrize("name", NAMES)
def test_empty_tables(spark, tmp_path, name):
    assert queries.QUERIES[name](spark, spoiled(spark, tmp_path, "empty", TABLES)).count() == 0
