"""A hot key holding a third of the rows, and the end-to-end import to Parquet."""

import os

from pyspark.sql import functions as F

from tessera.operators.reduce import extract_fields, reduce_to_grain
from tessera.operators.similarity import fuzzy_join, fuzzy_pairs
from tessera.plans.export_import import convert_to_parquet

U = "http://x/uniprot/"


def _export(spark, n):
    # a third of all rows share one grain; the rest spread over many grains
    base = spark.range(0, n).select(
        F.when(F.col("id") % 3 == 0, F.lit("GILGFVFTL")).otherwise(
            F.concat(F.lit("PEP"), (F.col("id") % 997).cast("string"))).alias("epitope_name"),
        F.when(F.col("id") % 3 == 0, F.lit("http://x/epitope/1")).otherwise(
            F.concat(F.lit("http://x/epitope/"), (F.col("id") % 13).cast("string"))).alias("epitope_epitope_iri"),
        F.lit("HLA-A*02:01").alias("mhc_restriction_name"),
        F.lit("I").alias("mhc_restriction_class"),
        F.concat(F.lit(U), F.when(F.col("id") % 5 == 0, "P1").otherwise("P2")).alias("epitope_molecule_parent_iri"),
        F.lit(None).cast("string").alias("epitope_source_molecule_iri"),
        F.lit("M1").alias("epitope_source_molecule"),
        F.when(F.col("id") % 7 == 0, 1).otherwise(58).cast("int").alias("epitope_starting_position"),
        F.when(F.col("id") % 7 == 0, 9).otherwise(66).cast("int").alias("epitope_ending_position"),
        (F.col("id") % 50).cast("int").alias("reference_pmid"),
        F.lit(None).cast("string").alias("epitope_modified_residues"),
        F.lit(None).cast("string").alias("epitope_modifications"),
        F.lit("Linear peptide").alias("epitope_object_type"),
    )
    return base.repartition(8)


def test_hot_grain_reduces_correctly(spark):
    n = 30000
    red = reduce_to_grain(extract_fields(_export(spark, n)))
    hot = red.where((F.col("sequence") == "GILGFVFTL") & (F.col("iedb_epitope_id") == 1)).first()
    assert hot.n_assays == n // 3
    assert (hot.start_position, hot.end_position) == (58, 66)
    assert hot.uniprot_id == "P2"
    assert hot.n_pmids == 50
    assert red.agg(F.sum("n_assays")).first()[0] == n


def test_hot_value_in_join(spark):
    t = spark.createDataFrame([("GILGFVFTL", i) for i in range(5000)] + [("NLVPMVATV", 1)], "sequence string, id int")
    q = spark.createDataFrame([("GILGFVFTA",)] * 100, "q string")
    assert fuzzy_pairs(q, "q", t, "sequence", 1).count() == 1
    assert fuzzy_join(q, "q", t, "sequence", 1).count() == 5000


def test_convert_to_parquet_summary(spark, tmp_dir):
    src = os.path.join(tmp_dir, "src")
    os.makedirs(src)
    with open(os.path.join(src, "e_00.csv"), "w") as f:
        f.write("Reference,Reference\nPMID,Title\n" + "".join(f'{i},"t {i}, with comma"\n' for i in range(100)))
    with open(os.path.join(src, "e_01.csv"), "w") as f:
        f.write("".join(f"{i},t{i}\n" for i in range(100, 150)))
    out = os.path.join(tmp_dir, "out")
    s = convert_to_parquet(spark, src, out, {"Reference - PMID": "int"}).first()
    assert (s.rows, s.columns) == (150, 2)
    assert s.input_bytes > 0 and s.output_bytes > 0 and s.elapsed_s > 0
    back = spark.read.parquet(out)
    assert dict(back.dtypes) == {"reference_pmid": "int", "reference_title": "string"}
    assert back.agg(F.sum("reference_pmid")).first()[0] == sum(range(150))
