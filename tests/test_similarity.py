"""Damerau-Levenshtein kernel, sweep and join against brute force and DuckDB."""

import random
from math import comb

import duckdb
import pytest
from pyspark.sql import functions as F

from tessera.functions.edit_distance import damerau_levenshtein, dl_distance
from tessera.operators.similarity import deletion_variants, fuzzy_join, fuzzy_pairs, fuzzy_sweep


def test_known_distances():
    assert dl_distance("CA", "ABC") == 2  # unrestricted; restricted OSA would give 3
    assert dl_distance("", "abc") == 3
    assert dl_distance("abc", "abc") == 0
    assert dl_distance("abcd", "acbd") == 1
    assert dl_distance("GILGFVFTL", "GILGFVFLT") == 1


def test_kernel_matches_duckdb():
    rng = random.Random(7)
    pairs = [("".join(rng.choice("ABC") for _ in range(rng.randint(0, 7))),
              "".join(rng.choice("ABC") for _ in range(rng.randint(0, 7)))) for _ in range(1500)]
    con = duckdb.connect()
    con.execute("CREATE TABLE p(a VARCHAR, b VARCHAR)")
    con.executemany("INSERT INTO p VALUES (?, ?)", pairs)
    got = con.sql("SELECT a, b, damerau_levenshtein(a, b) FROM p").fetchall()
    for a, b, d in got:
        assert dl_distance(a, b) == d, (a, b)


def test_udf_and_nulls(spark):
    df = spark.createDataFrame([("CA", "ABC"), (None, "x"), ("kitten", "sitting")], "a string, b string")
    assert [r.d for r in df.select(damerau_levenshtein("a", "b").alias("d")).collect()] == [2, None, 3]


def test_deletion_variants(spark):
    df = spark.createDataFrame([("ABCD",), ("",), ("AAB",)], "s string")
    got = {r.s: set(r.v) for r in df.select("s", deletion_variants("s", 2).alias("v")).collect()}
    assert len(got["ABCD"]) == 1 + comb(4, 1) + comb(4, 2)
    assert got[""] == {""}
    assert got["AAB"] == {"AAB", "AB", "AA", "A", "B"}


def _brute(queries, targets, k):
    return {(q, t, dl_distance(q, t)) for q in set(queries) for t in set(targets) if dl_distance(q, t) <= k}


@pytest.mark.parametrize("k", [1, 2])
def test_fuzzy_pairs_match_brute_force(spark, k):
    rng = random.Random(k)
    qs = ["".join(rng.choice("ACGT") for _ in range(rng.randint(1, 7))) for _ in range(60)]
    ts = ["".join(rng.choice("ACGT") for _ in range(rng.randint(1, 7))) for _ in range(200)]
    qdf = spark.createDataFrame([(q,) for q in qs], "q string")
    tdf = spark.createDataFrame([(t,) for t in ts], "t string")
    got = {(r.query_sequence, r.sequence, r.distance) for r in fuzzy_pairs(qdf, "q", tdf, "t", k).collect()}
    assert got == _brute(qs, ts, k)


def test_fuzzy_join_keeps_target_rows(spark):
    t = spark.createDataFrame([("GILGFVFTL", 1), ("GILGFVFTL", 2), ("GLLGFVFTL", 3), ("NLVPMVATV", 4)],
                              "sequence string, id int")
    q = spark.createDataFrame([("GILGFVFTL",), ("GILGFVFTL",)], "query string")
    got = sorted((r.id, r.distance) for r in fuzzy_join(q, "query", t, "sequence", 2).collect())
    assert got == [(1, 0), (2, 0), (3, 1)]


def test_fuzzy_sweep(spark):
    t = spark.createDataFrame([("GILGFVFTL",), ("GILGFVFLT",), ("CILGFVFTA",), ("AAAAAAAAA",), (None,)], "s string")
    got = sorted((r.s, r.distance) for r in fuzzy_sweep(t, "s", "GILGFVFTL", 2).collect())
    assert got == [("CILGFVFTA", 2), ("GILGFVFLT", 1), ("GILGFVFTL", 0)]


def _mutate(rng, s, n_ops):
    s = list(s)
    for _ in range(n_ops):
        op = rng.choice("sidt")
        if op == "s" and s:
            s[rng.randrange(len(s))] = rng.choice("ACGT")
        elif op == "i":
            s.insert(rng.randrange(len(s) + 1), rng.choice("ACGT"))
        elif op == "d" and s:
            del s[rng.randrange(len(s))]
        elif op == "t" and len(s) > 1:
            i = rng.randrange(len(s) - 1)
            s[i], s[i + 1] = s[i + 1], s[i]
    return "".join(s)


@pytest.mark.parametrize("k", [1, 2])
def test_fuzzy_pairs_long_strings_match_brute_force(spark, k):
    """Targets on both sides of the switch length, near copies with every edit kind."""
    rng = random.Random(100 + k)
    bases = ["".join(rng.choice("ACGT") for _ in range(rng.randint(14, 60))) for _ in range(40)]
    ts = bases + [_mutate(rng, b, rng.randint(1, 3)) for b in bases for _ in range(3)]
    qs = [_mutate(rng, b, rng.randint(0, 3)) for b in bases for _ in range(2)]
    qdf = spark.createDataFrame([(q,) for q in qs], "q string")
    tdf = spark.createDataFrame([(t,) for t in ts], "t string")
    got = {(r.query_sequence, r.sequence, r.distance) for r in fuzzy_pairs(qdf, "q", tdf, "t", k).collect()}
    want = _brute(qs, ts, k)
    assert len(want) > 50
    assert got == want


def test_distance_zero_is_equality_and_negative_rejected(spark):
    t = spark.createDataFrame([("ABC",), ("ABD",), ("A" * 60,)], "t string")
    q = spark.createDataFrame([("ABC",), ("A" * 60,)], "q string")
    got = {(r.query_sequence, r.sequence, r.distance) for r in fuzzy_pairs(q, "q", t, "t", 0).collect()}
    assert got == {("ABC", "ABC", 0), ("A" * 60, "A" * 60, 0)}
    with pytest.raises(ValueError):
        fuzzy_pairs(q, "q", t, "t", -1)


def test_a_common_prefix_makes_few_candidates(spark):
    """Strings that share a segment at one place meet in the join but make no rows unless the rest is near."""
    import random

    from tessera.operators import similarity as S

    rnd = random.Random(5)
    made = {}
    for n in (200, 400):
        strings = ["PREFIXPREFIX" + "".join(rnd.choice("ACDEFGHIKLMNPQRSTVWY") for _ in range(28)) for _ in range(n)]
        df = spark.createDataFrame([(s,) for s in strings], "s string")
        k, l0 = 2, S.switch_length(2)
        qk = df.select("s", F.inline(S.query_signatures("s", k, l0 + 1))).toDF("_q", "_key", "_q_at", "_q_len")
        tk = df.select("s", F.inline(S.target_segments("s", k))).toDF("_t", "_key", "_t_at", "_t_len")
        made[n] = qk.join(tk, "_key").where(S._sides_within(2 * k)).count()
        pairs = S.fuzzy_pairs(df, "s", df, "s", k).collect()
        assert sorted((r.query_sequence, r.sequence) for r in pairs) == sorted((s, s) for s in strings)
    assert made[400] < 2.5 * made[200] < 2.5 * 200 * 30


def test_banded_kernel_matches_the_full_one():
    import random

    from tessera.functions.edit_distance import dl_distance, dl_within

    rnd = random.Random(11)
    for k in range(4):
        a = ["".join(rnd.choice("abc") for _ in range(rnd.randint(0, 8))) for _ in range(1500)]
        b = ["".join(rnd.choice("abc") for _ in range(rnd.randint(0, 8))) for _ in range(1500)]
        a, b = a + ["CA", "", "ab"], b + ["ABC", "", "ba"]
        assert dl_within(a, b, k).tolist() == [min(dl_distance(x, y), k + 1) for x, y in zip(a, b)]
