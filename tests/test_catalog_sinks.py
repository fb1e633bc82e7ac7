"""Catalogs, CSV reports, summaries, ranking helpers and SQL over files."""

import csv
import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from tessera.operators.catalog import audit_casts, describe_table
from tessera.operators.ranking import best_row, lookup, top_groups
from tessera.operators.reports import import_summary, reduced_summary
from tessera.sinks.writers import flatten_lists, write_catalog_json, write_csv_report, write_reduced_table
from tessera.sources.parquet import sql_over_files
from tessera.sources.sharded_csv import describe_source

REDUCED_ROWS = [
    ("GILGFVFTL", 9, 1, "HLA-A*02:01", "I", True, "P03485", "M1", 58, 66, [3, 1], 2, False, [], [], 7),
    ("GILGFVFTL", 9, 2, "HLA class I", "I", False, None, None, None, None, [5], 1, False, [], [], 9),
    ("ELAGIGILTV", 10, 3, "HLA-A*02:01", "I", True, None, None, None, None, [4], 1, True, ["OX"], ["M1,M5"], 3),
]
REDUCED_SCHEMA = (
    "sequence string, peptide_length smallint, iedb_epitope_id int, mhc_allele string, mhc_class string, "
    "allele_is_specific boolean, uniprot_id string, source_molecule string, start_position int, "
    "end_position int, pmids array<int>, n_pmids int, is_modified boolean, modifications array<string>, "
    "modified_residues array<string>, n_assays bigint"
)


@pytest.fixture()
def reduced(spark):
    return spark.createDataFrame(REDUCED_ROWS, REDUCED_SCHEMA)


def test_describe_table(spark, tmp_dir):
    from tessera.plans.epitope_table import reduced_table

    out = os.path.join(tmp_dir, "red")
    table = write_reduced_table(reduced_table(spark, "/root/testdata/sf0.001"), out)
    cat = {r.name: r for r in describe_table(table).collect()}
    assert cat["pmids"].dtype == "array<int>" and cat["n_assays"]["index"] == 15
    assert "parent_iri" in cat["uniprot_id"].source and cat["n_assays"].dtype == "bigint"
    with pytest.raises(KeyError):
        describe_table(table.withColumn("extra", F.lit(1)))


def test_describe_source_and_json(spark, tmp_dir):
    src = os.path.join(tmp_dir, "src")
    os.makedirs(src)
    with open(os.path.join(src, "e_00.csv"), "w") as f:
        f.write("Reference,Assay\nPMID,Response Frequency (%)\n1,2\n")
    cat = describe_source(spark, src, {"Reference - PMID": "int"})
    rows = [r.asDict() for r in cat.orderBy("index").collect()]
    assert rows[0] == {"index": 0, "group": "Reference", "field": "PMID", "name": "Reference - PMID",
                       "slug": "reference_pmid", "dtype": "int"}
    assert rows[1]["slug"] == "assay_response_frequency_percent" and rows[1]["dtype"] == "string"
    out = os.path.join(tmp_dir, "cat")
    write_catalog_json(cat, out)
    lines = [json.loads(x) for p in glob.glob(out + "/*.json") for x in open(p)]
    assert len(lines) == 2


def test_report_reads_back_as_it_was_written(spark, tmp_dir):
    rows = spark.createDataFrame(
        [(" lead", [1, 2], 'q"u,o'), ("trail\t", [], ""), (None, None, "line\nbreak")], "a string, b array<int>, c string")
    out = os.path.join(tmp_dir, "report")
    write_csv_report(rows, out)
    back = spark.read.schema("a string, b string, c string").options(
        header=True, escape='"', multiLine=True, nullValue="\u0001").csv(out)
    assert {tuple(r) for r in back.collect()} == {(" lead", "1,2", 'q"u,o'), ("trail\t", "", ""), (None, None, "line\nbreak")}


def test_best_row_is_the_first_by_the_order(spark, reduced):
    best = best_row(reduced, "sequence", "GILGFVFTL", [F.desc("n_assays")])
    assert [r.iedb_epitope_id for r in best.collect()] == [2]


def test_best_row_missing_is_empty(spark, reduced):
    assert best_row(reduced, "sequence", "NOPE", [F.desc("n_assays")]).count() == 0


def test_lookup_short_and_long(spark, reduced):
    assert lookup(reduced, "sequence", ["GILGFVFTL"]).count() == 2
    many = ["X%d" % i for i in range(300)] + ["ELAGIGILTV"]
    for in_list in (True, False):
        assert lookup(reduced, "sequence", many, in_list=in_list).count() == 1
    keys = spark.createDataFrame([("GILGFVFTL",), (None,)], "k string")
    assert lookup(reduced, "sequence", keys).count() == 2


def test_top_groups(spark, reduced):
    top = top_groups(reduced, ["mhc_allele"], [F.sum("n_assays").alias("n")], [F.desc("n"), "mhc_allele"], 1)
    assert [(r.mhc_allele, r.n) for r in top.collect()] == [("HLA-A*02:01", 10)]


def test_summaries(spark, reduced):
    s = reduced_summary(reduced).first()
    assert (s.rows, s.distinct_sequences, s.with_uniprot, s.modified) == (3, 2, 1, 1)
    assert s.pct_with_uniprot == 33.3
    empty = reduced_summary(reduced.where("false")).first()
    assert empty.rows == 0 and empty.pct_with_uniprot is None
    imp = import_summary(reduced, 1000, 10, 1.5).first()
    assert (imp.rows, imp.columns, imp.compression) == (3, 16, 100.0)


def test_audit_casts(spark):
    df = spark.createDataFrame([("1", "37-91 years"), ("40000", "child"), (None, "12")], "a string, b string")
    got = {r.column_name: r for r in audit_casts(df, {"a": "smallint", "b": "int"}).collect()}
    assert (got["a"].n_rows, got["a"].n_non_null, got["a"].n_unparsable) == (3, 2, 1)
    assert (got["b"].n_unparsable, got["b"].min_value) == (2, 12.0)


def test_write_reduced_sorted_and_sql(spark, reduced, tmp_dir):
    out = os.path.join(tmp_dir, "red")
    back = write_reduced_table(reduced, out)
    assert [r.sequence for r in back.collect()] == sorted(r[0] for r in REDUCED_ROWS)
    res = sql_over_files(spark, "SELECT count(*) AS n FROM {t} WHERE peptide_length = 9", t=out).first()
    assert res.n == 2
    direct = spark.sql(f"SELECT count(*) AS n FROM parquet.`{out}`").first()
    assert direct.n == 3
    flat = flatten_lists(back).where("sequence = 'ELAGIGILTV'").first()
    assert flat.pmids == "4" and flat.modifications == "OX"


def test_audit_uses_the_strict_text_rule(spark):
    df = spark.createDataFrame([(" 12",), ("12",), ("1.5d",)], "a string")
    strict = audit_casts(df, {"a": "int"}).first()
    loose = audit_casts(df, {"a": "int"}, exact_text=False).first()
    assert strict.n_unparsable == 2 and loose.n_unparsable == 1


def test_delete_created_only_touches_scratch(spark):
    from tessera.session import delete_created, path_exists, scratch_path

    path = scratch_path(spark, "t-delete")
    spark.range(3).write.parquet(path)
    assert path_exists(spark, path)
    delete_created(spark, path)
    assert not path_exists(spark, path)
    with pytest.raises(ValueError):
        delete_created(spark, "/tmp")


def test_catalog_document(spark, reduced, tmp_dir):
    out = os.path.join(tmp_dir, "doc")
    described = reduced.select(*[
        F.col(c).alias(c, metadata={"description": f"about {c}", "source": "test"}) for c in reduced.columns])
    write_catalog_json(describe_table(described), out, document=True)
    docs = [json.loads(x) for p in glob.glob(out + "/*.json") for x in open(p)]
    assert len(docs) == 1 and docs[0]["column_count"] == 16
    assert [c["index"] for c in docs[0]["columns"]] == list(range(16))
    assert docs[0]["columns"][0]["name"] == "sequence"
