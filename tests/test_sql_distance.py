"""The edit distance as a SQL function, and the kernel that fills many tables together."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tessera.functions import edit_distance
from tessera.functions.edit_distance import dl_distance, dl_distances, register_sql_functions
from tessera.sources.parquet import sql_over_files

STATEMENT = """SELECT sequence, mhc_allele, uniprot_id, source_molecule
FROM read_parquet('{path}')
WHERE peptide_length = 9
  AND damerau_levenshtein(sequence, 'KLMNPQRST') <= 2;
"""


def words(rnd, n, letters="ABCDé", longest=11):
    return ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, longest))) for _ in range(n)]


@pytest.mark.parametrize("cells", [200, 5_000, 4_000_000])
def test_many_tables_equal_one_at_a_time(monkeypatch, cells):
    monkeypatch.setattr(edit_distance, "TABLE_CELLS", cells)
    rnd = random.Random(cells)
    a, b = words(rnd, 3000), words(rnd, 3000)
    a[:500] = [x + x[::-1] for x in b[:500]]
    assert dl_distances(a, b).tolist() == [dl_distance(x, y) for x, y in zip(a, b)]


def test_very_long_and_repeated_pairs():
    long = "ACGT" * 200
    pairs = [(long, long[1:]), ("", long), ("", ""), ("CA", "ABC")] * 40
    got = dl_distances([p[0] for p in pairs], [p[1] for p in pairs])
    assert got.tolist() == [1, 800, 0, 2] * 40
    assert dl_distances([], []).tolist() == []


def test_documented_statement_over_a_written_path(spark, tmp_dir):
    path = f"{tmp_dir}/reduced table"
    rows = [("KLMNPQRST", 0), ("KLMNPQRTS", 1), ("LKMNPQRTS", 2), ("KLMNPQRS", 1), ("AAAAAAAAA", 9), (None, None), ("LKMNPQTSR", 3)]
    spark.createDataFrame([(s, "A", "P1", "m", len(s) if s else 9, d) for s, d in rows],
                          "sequence string, mhc_allele string, uniprot_id string, source_molecule string, peptide_length int, d int"
                          ).write.parquet(path)
    got = sql_over_files(spark, STATEMENT.format(path=path))
    assert got.columns == ["sequence", "mhc_allele", "uniprot_id", "source_molecule"]
    assert sorted(r.sequence for r in got.collect()) == ["KLMNPQRST", "KLMNPQRTS", "LKMNPQRTS"]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(peptide_length,9)" in plan  # the length test still reaches the scan
    assert "ArrowEvalPython" in plan and "BatchEvalPython" not in plan


def test_sql_function_in_any_place(spark):
    register_sql_functions(spark)
    df = spark.createDataFrame([("CA", "ABC"), (None, "x"), ("x", None), ("kitten", "sitting"), ("", "")], "a string, b string")
    df.createOrReplaceTempView("pairs_of_words")
    try:
        got = spark.sql("SELECT a, damerau_levenshtein(a, b) AS d FROM pairs_of_words").collect()
        assert [r.d for r in got] == [2, None, None, 3, 0]
        assert spark.sql("SELECT max(damerau_levenshtein(upper(a), b)) FROM pairs_of_words WHERE damerau_levenshtein(a, b) > 1").first()[0] == 7
    finally:
        spark.catalog.dropTempView("pairs_of_words")


def test_series_with_nulls():
    got = edit_distance._dl_series(pd.Series(["a", None, "ab"]), pd.Series(["b", "x", "ba"]))
    assert got.tolist()[0] == 1 and got.isna().tolist() == [False, True, False] and got.tolist()[2] == 1


def test_registered_sweep_has_distances(spark, tmp_dir):
    from tessera.plans.registry import SWEEP_QUERY

    assert F.col("x") is not None and dl_distance("REDWIDGET", SWEEP_QUERY) == 1
