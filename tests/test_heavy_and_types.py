"""Heavy grains, Bloom filters, the staged sort and inferred types."""

import os
import random

import pytest
from pyspark.sql import functions as F

from tessera.operators.catalog import infer_types, inferred_casts
from tessera.operators.reduce import GRAIN, heavy_grains, reduce_to_grain
from tessera.sinks.writers import bloom_options, write_parquet, write_reduced_table
from tessera.sources.sharded_csv import EXPORT_TYPES, strict_cast

FIELDS = ("sequence string, iedb_epitope_id int, mhc_allele string, mhc_class string, uniprot_id string, source_molecule string, "
          "start_position int, end_position int, pmid int, modified_residues string, modifications string")


def some_fields(spark, n=3000, seed=2):
    rnd = random.Random(seed)

    def maybe(x):
        return None if rnd.random() < 0.2 else x

    rows = []
    for _ in range(n):
        hot = rnd.random() < 0.5
        key = rnd.choice([("HOT", 1, "A"), ("HOT", None, None), (None, 1, "A")]) if hot else (
            f"S{rnd.randrange(60)}", maybe(rnd.randrange(3)), maybe(rnd.choice("AB")))
        rows.append((*key, maybe(rnd.choice(["I", "II"])), maybe(f"P{rnd.randrange(9)}"), maybe(f"m{rnd.randrange(300)}"),
                     maybe(rnd.randrange(-3, 4)), maybe(rnd.randrange(4)), maybe(rnd.randrange(500)),
                     maybe(f"r{rnd.randrange(5)}"), maybe(rnd.choice(["", "OX", "ox"]))))
    return spark.createDataFrame(rows, FIELDS)


def rows(df):
    return sorted(map(repr, map(tuple, df.collect())))


@pytest.mark.parametrize("limit", [0, 30, 10_000])
def test_both_paths_reduce_alike(spark, limit):
    fields = some_fields(spark).cache()
    heavy = heavy_grains(fields, rows=limit)
    want, got = reduce_to_grain(fields), reduce_to_grain(fields, heavy=heavy)
    assert [(f.name, f.dataType.simpleString(), f.metadata) for f in got.schema] == [
        (f.name, f.dataType.simpleString(), f.metadata) for f in want.schema]
    assert rows(got) == rows(want)
    n_grains = fields.select(*GRAIN).distinct().count()
    assert {0: heavy.count() == n_grains, 30: heavy.count() == 3, 10_000: heavy.count() == 0}[limit]


def test_heavy_path_deals_rows_by_value(spark):
    fields = some_fields(spark, 300)
    plan = reduce_to_grain(fields, heavy=heavy_grains(fields, rows=0))._jdf.queryExecution().executedPlan().toString()
    assert "_column" in plan and "partial_count" in plan
    assert any("hashpartitioning" in line and "_column" in line and "_text" in line for line in plan.splitlines())


def test_staged_sort_holds_nothing_and_leaves_disjoint_files(spark, tmp_dir):
    import pyarrow.parquet as pq

    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        reduced = reduce_to_grain(some_fields(spark))
        out = write_reduced_table(reduced, f"{tmp_dir}/reduced")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert rows(out) == rows(reduced)
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == 0 or not reduced.is_cached
    ranges = []
    for name in sorted(os.listdir(f"{tmp_dir}/reduced")):
        if name.endswith(".parquet"):
            found = [s for s in pq.read_table(f"{tmp_dir}/reduced/{name}").column("sequence").to_pylist() if s is not None]
            assert found == sorted(found)
            ranges += [(found[0], found[-1])] if found else []
    ranges.sort()
    assert len(ranges) > 2 and all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:]))
    assert [f.metadata for f in out.schema.fields] == [f.metadata for f in reduced.schema.fields]


def rows_read(spark, path, condition):
    """Rows that a scan with a pushed filter hands on."""
    df = spark.read.parquet(path).where(condition)
    n = df.count()
    df = spark.read.parquet(path).where(condition)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    while plan.children().size():
        plan = plan.children().head()
    return n, plan.metrics().apply("numOutputRows").value()


def test_bloom_filters_skip_row_groups_off_the_sort_key(spark, tmp_dir):
    # codes spread over the whole range in every row group, too many for a dictionary
    table = spark.range(200_000, numPartitions=1).select(
        F.format_string("%08d", "id").alias("sequence"), (F.xxhash64("id") % 2_000_000_000).cast("int").alias("code"))
    small = {"parquet.block.size": "65536", "parquet.dictionary.page.size": "512", "parquet.page.row.count.limit": "500"}
    write_parquet(table, f"{tmp_dir}/plain", options=small)
    write_parquet(table, f"{tmp_dir}/bloom", options=small | bloom_options({"code": 10_000}))
    code = table.where("sequence = '00123456'").first()["code"]
    for condition in (F.col("code") == code, F.col("code") == -5):
        n_plain, plain = rows_read(spark, f"{tmp_dir}/plain", condition)
        n_bloom, bloom = rows_read(spark, f"{tmp_dir}/bloom", condition)
        assert n_plain == n_bloom
        assert bloom < 0.3 * plain, (plain, bloom)


def typed(spark, columns):
    return spark.createDataFrame(list(zip(*columns.values())), ", ".join(f"`{c}` string" for c in columns))


def test_types_of_odd_values(spark):
    columns = {
        "null": [None, None, None], "smallint": ["1", "-32768", None], "int": ["1", "32768", "0"], "int 2": ["-2147483648", "+5", None],
        "bigint": ["1", "9223372036854775807", "-5"], "double": ["1", "1.5", "-2e3"], "double 2": ["0", "-0", "0.5"],
        "string": ["1", "a", None], "string 2": ["01", "2", "3"], "string 3": ["", "1", "2"], "string 4": ["1234567890123456", "1.5", None],
        "string 5": ["9223372036854775808", "1", None], "string 6": [" 1", "2", "3"], "string 7": ["NaN", "1", "2"],
        "string 8": ["1.5f", "2", "3"], "string 9": ["1e999x", "2", "3"], "a`b string": ["x", "y", "z"]}
    df = typed(spark, {c: v for c, v in columns.items() if "`" not in c})
    got = {r.column_name: r.type for r in infer_types(df).collect()}
    assert got == {c: c.split()[0] for c in got}
    casts = inferred_casts(infer_types(df))
    assert set(casts) == {"smallint", "int", "int 2", "bigint", "double", "double 2"}
    strict_cast(df, casts).collect()  # what was inferred is what the strict import accepts
    with pytest.raises(ValueError, match="no text column"):
        infer_types(spark.range(3))


def test_types_of_no_rows(spark):
    got = infer_types(typed(spark, {"a": ["1"], "b": ["x"]}).limit(0)).collect()
    assert [(r.column_name, r.type, r.n_rows) for r in got] == [("a", "null", 0), ("b", "null", 0)]


def test_extremes_of_odd_values(spark):
    df = typed(spark, {
        "a": ["-9223372036854775808", "7", "+9223372036854775807"], "b": ["1e999", "-2.5e-3", "5."], "c": ["5\n", "-7\r\n", None],
        "d": ["12345678901234567890123", "1", "2"], "e": ["3\u2028", "1", "2"], "f": ["-0", None, None], "g": ["1.5\r", "+2", "x"],
        "h": [None, "123456789012345", "1.5"]})
    got = {r.column_name: tuple(r)[1:] for r in infer_types(df.repartition(2)).collect()}
    assert got == {
        "a": ("bigint", 3, 3, -9223372036854775808.0, 9223372036854775807.0), "b": ("double", 3, 3, -0.0025, float("inf")),
        "c": ("smallint", 3, 2, -7.0, 5.0), "d": ("string", 3, 3, None, None), "e": ("string", 3, 3, None, None),
        "f": ("smallint", 3, 1, -0.0, -0.0), "g": ("string", 3, 3, None, None), "h": ("double", 3, 2, 1.5, 123456789012345.0)}


def test_types_take_one_row_per_column_and_task(spark):
    # no row per value: what leaves a task does not grow with its rows
    df = spark.range(5000, numPartitions=2).selectExpr("cast(id as string) as a", "concat('t', id) as b")
    plan = infer_types(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan and "Generate" not in plan
    assert [tuple(r) for r in infer_types(df).orderBy("column_name").collect()] == [
        ("a", "smallint", 5000, 5000, 0.0, 4999.0), ("b", "string", 5000, 5000, None, None)]


def test_types_merge_in_any_order(spark):
    rnd = random.Random(4)
    values = ["1", "-7", "40000", "3000000000", "1.25", None]
    for _ in range(4):
        rnd.shuffle(values)
        for parts in (1, 5):
            assert infer_types(typed(spark, {"c": list(values)}).repartition(parts)).first()["type"] == "double"
    assert len(EXPORT_TYPES) == 15
