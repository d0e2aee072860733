import random

import pytest

from vernissage.operators import snapdiff

from .conftest import rows

SCHEMA = "s string, seq int, k string, x int, y boolean, leaf string, previous string"


def brute(data):
    by = {}
    for s, q, k, x, y, *_ in data:
        by.setdefault((s, q), {})[k] = (x, y)
    out = []
    for (s, q), later in by.items():
        if (s, q - 1) not in by:
            continue
        earlier = by[(s, q - 1)]
        out += [(s, k, q, "added") for k in later.keys() - earlier.keys()] + [(s, k, q, "removed") for k in earlier.keys() - later.keys()]
        out += [(s, k, q, "changed") for k in later.keys() & earlier.keys() if later[k] != earlier[k]]
    return sorted(out, key=repr)


@pytest.mark.parametrize("levels", [0, 1, 3])
def test_against_brute_force(spark, levels):
    rnd = random.Random(levels)
    data = []
    for s in ("a", "b"):
        state = {f"k{i}": (rnd.choice([None, 1, 2]), rnd.choice([None, True, False])) for i in range(60)}
        for q in range(1, 5):
            for k in rnd.sample(sorted(state), 5):
                state[k] = (rnd.choice([None, 1, 2]), rnd.choice([None, True, False]))
            state.pop(rnd.choice(sorted(state)))
            state[f"n{q}"] = (None, None)
            data += [(s, q, k, *v, "x", "y") for k, v in state.items()]
    got = snapdiff.snapshot_diff(spark.createDataFrame(data, SCHEMA), "s", "k", ["x", "y"], levels)
    assert rows(got, "s", "k", "seq", "change_kind") == brute(data)


def test_null_is_a_value_of_its_own(spark):
    df = spark.createDataFrame([("a", 1, "k", None, True, "", ""), ("a", 2, "k", 0, True, "", ""), ("a", 1, "m", 1, None, "", ""), ("a", 2, "m", None, None, "", ""), ("a", 1, "n", None, None, "", ""), ("a", 2, "n", None, None, "", "")], SCHEMA)
    assert rows(snapdiff.snapshot_diff(df, "s", "k", ["x", "y"], 1), "k", "change_kind") == [("k", "changed"), ("m", "changed")]


def test_empty_and_single_snapshots(spark):
    df = spark.createDataFrame([("a", 1, "k", 1, True, "", ""), ("a", 1, None, 1, True, "", "")], SCHEMA)
    assert snapdiff.snapshot_diff(df, "s", "k", ["x"], 2).count() == 0
    assert snapdiff.snapshot_diff(df.filter("false"), "s", "k", ["x"], 2).count() == 0


def test_only_differing_leaves_are_kept(spark):
    data = [("a", q, f"k{i}", 7 if (q, i) == (2, 3) else 1, True, "", "") for q in (1, 2) for i in range(500)]
    df = spark.createDataFrame(data, SCHEMA)
    from pyspark.sql import functions as F

    leaf = F.shiftrightunsigned(F.xxhash64("k"), 64 - 8).cast("int")
    leaves = snapdiff.digest(df.withColumn("_leaf", leaf), ["s", "seq", "_leaf"], ["k", "x", "y"])
    assert snapdiff.differing_leaves(leaves, "s", 2).count() == 1


@pytest.mark.parametrize("n, levels", [(0, 0), (16, 0), (17, 1), (5000, 3), (10**12, 9), (10**30, 15)])
def test_levels_follow_the_size(n, levels):
    assert snapdiff.levels_for(n) == levels


def test_plan_of_a_level_does_not_grow_with_the_tree(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([("a", q, f"k{i}", i * q % 7, True, "", "") for q in (1, 2, 3) for i in range(50)], SCHEMA)

    def joins(levels):
        leaf = F.shiftrightunsigned(F.xxhash64("k"), 64 - 4 * levels)
        leaves = snapdiff.digest(df.withColumn("_leaf", leaf), ["s", "seq", "_leaf"], ["k", "x", "y"])
        diff = snapdiff.snapshot_diff(df, "s", "k", ["x", "y"], levels)
        one = snapdiff.differing_leaves(leaves, "s", levels)
        return [f._jdf.queryExecution().optimizedPlan().toString().count("Join") for f in (diff, one)]

    assert joins(1) == joins(6) == [1, 0]
