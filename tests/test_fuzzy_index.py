"""The written fuzzy index, and targets that have much in common."""

import random

import pytest
from pyspark.sql import functions as F

from tessera.functions.edit_distance import dl_distance
from tessera.operators.fuzzy_index import open_fuzzy_index, write_fuzzy_index
from tessera.operators.similarity import distinct_strings, fuzzy_pairs, query_keys, switch_length, target_keys

LETTERS = "ACDEFGHIKLMNPQRSTVWY"


def frame(spark, strings, name="s"):
    return spark.createDataFrame([(s,) for s in strings], f"{name} string")


def changed(rnd, s, n):
    for _ in range(n):
        i, kind = rnd.randrange(len(s)), rnd.random()
        if kind < 0.25:
            s = s[:i] + s[i + 1:] or "A"
        elif kind < 0.5:
            s = s[:i] + rnd.choice(LETTERS) + s[i:]
        elif kind < 0.75:
            s = s[:i] + rnd.choice(LETTERS) + s[i + 1:]
        else:
            s = s[:i] + s[i + 1:i + 2] + s[i:i + 1] + s[i + 2:]
    return s


def strings(rnd, n, lengths):
    return ["".join(rnd.choice(LETTERS) for _ in range(rnd.choice(lengths))) for _ in range(n)]


def brute(queries, targets, k):
    return {(q, t, d) for q in set(queries) if q is not None for t in set(targets) if t is not None
            and abs(len(q) - len(t)) <= k and (d := dl_distance(q, t)) <= k}


def found(df):
    rows = [tuple(r) for r in df.select("query_sequence", "sequence", "distance").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.fixture()
def index_path(tmp_path):
    return f"{tmp_path}/an index"


@pytest.mark.parametrize("k", [0, 2])
def test_index_equals_brute_force_and_grows(spark, index_path, k):
    rnd = random.Random(k)
    first = strings(rnd, 80, [3, 8, 9, 20, 21, 25, 40, 70]) + [None]
    second = [changed(rnd, s, rnd.randint(0, 2)) for s in first[:40]] + first[:10]
    queries = [changed(rnd, s, rnd.randint(0, 2)) for s in first[20:80]] + [None, "", "A"]
    index = write_fuzzy_index(frame(spark, first), "s", k, index_path, n_buckets=4)
    try:
        assert found(index.pairs(frame(spark, queries), "s")) == brute(queries, first, k)
        again = open_fuzzy_index(spark, index_path)
        assert again == index
        again.add(frame(spark, second), "s")
        assert found(again.pairs(frame(spark, queries), "s")) == brute(queries, first + second, k)
        held = [r[0] for r in spark.table(again._table("strings")).collect()]
        assert sorted(held) == sorted({s for s in first + second if s is not None})
    finally:
        index.close()


def test_a_batch_of_queries_does_not_touch_the_targets(spark, index_path, tmp_path):
    rnd = random.Random(5)
    targets = strings(rnd, 300, [9, 30])
    frame(spark, targets).write.parquet(f"{tmp_path}/targets")
    index = write_fuzzy_index(spark.read.parquet(f"{tmp_path}/targets"), "s", 2, index_path, n_buckets=4)
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        pairs = index.pairs(frame(spark, [changed(rnd, t, 1) for t in targets[:50]]), "s")
        plan = pairs._jdf.queryExecution().executedPlan().toString()
        assert f"{tmp_path}/targets" not in plan
        scan = [line for line in plan.splitlines() if "Scan parquet" in line or "FileScan parquet" in line]
        assert len(scan) == 1 and "Bucketed: true" in scan[0]
        # by key only the queries are dealt out: the index lies in buckets already
        assert plan.count("Exchange hashpartitioning(_key") == 1
        assert len(found(pairs)) >= 50
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        index.close()


def test_nothing_new_adds_nothing(spark, index_path):
    index = write_fuzzy_index(frame(spark, ["ABCDEFGHI", None]), "s", 1, index_path, n_buckets=2)
    try:
        before = spark.table(index._table("keys")).count()
        index.add(frame(spark, ["ABCDEFGHI", "ABCDEFGHI", None]), "s")
        spark.catalog.refreshTable(index._table("keys"))
        assert spark.table(index._table("keys")).count() == before == 10
        empty = frame(spark, [])
        index.add(empty, "s")
        assert index.pairs(empty, "s").count() == 0
    finally:
        index.close()


def compared(spark, queries, targets, k):
    """How many pairs share a key, before any comparison."""
    qk = query_keys(distinct_strings(frame(spark, queries), "s", "_q"), k)
    return qk.join(target_keys(distinct_strings(frame(spark, targets), "s", "_t"), k), "_key").count()


@pytest.mark.parametrize("shape", ["prefix", "middle"])
def test_pairs_compared_grow_linearly_with_strings_that_share_a_part(spark, shape):
    rnd, k = random.Random(11), 2
    common = "".join(rnd.choice(LETTERS) for _ in range(24))

    def one():
        own = "".join(rnd.choice(LETTERS) for _ in range(24))
        return {"prefix": common + own, "middle": own[:12] + common + own[12:]}[shape]

    targets = [one() for _ in range(800)]
    counts = [compared(spark, targets[:n], targets[:n], k) for n in (200, 800)]
    # every string meets itself under 5 keys; pairs of strangers would be 40,000 and 640,000 a key
    assert counts[0] < 200 * 15 and counts[1] < 800 * 15


def test_shared_parts_lose_no_pair(spark):
    rnd, k = random.Random(3), 2
    common = "".join(rnd.choice(LETTERS) for _ in range(30))
    base = [common + s for s in strings(rnd, 60, [0, 4, 20, 30])]
    base += [s + common for s in strings(rnd, 40, [4, 20])] + strings(rnd, 30, [21, 22, 45])
    near = [changed(rnd, s, rnd.randint(0, 2)) for s in base]
    got = found(fuzzy_pairs(frame(spark, near), "s", frame(spark, base), "s", k))
    assert got == brute(near, base, k) and len(got) > 100


def test_every_long_target_keeps_enough_segments(spark):
    rnd = random.Random(1)
    for k in (1, 2):
        l0 = switch_length(k)
        long = strings(rnd, 30, [l0 + 1, l0 + 9, 150])
        keys = target_keys(distinct_strings(frame(spark, long), "s", "_t"), k)
        assert {r["n"] for r in keys.groupBy("_t").agg(F.count(F.lit(1)).alias("n")).collect()} == {2 * k + 1}
