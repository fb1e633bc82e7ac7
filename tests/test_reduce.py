"""Reduction to grain: cleaning, modal values and pairs, lists, null keys, ties."""

import pytest
from pyspark.sql import functions as F

from tessera.functions.text import accession, clean_sequence, epitope_id, extract_or_null, flag_matches
from tessera.operators.aggregates import distinct_count_with_nulls, first_non_null, modal_tuple, modal_value
from tessera.operators.quality import check_expected, check_pattern, check_span, check_unique, quality_report
from tessera.operators.reduce import REDUCED_COLUMNS, extract_fields, reduce_to_grain

EXPORT_SCHEMA = (
    "epitope_object_type string, epitope_name string, epitope_epitope_iri string, mhc_restriction_name string, "
    "mhc_restriction_class string, epitope_molecule_parent_iri string, epitope_source_molecule_iri string, "
    "epitope_source_molecule string, epitope_starting_position int, epitope_ending_position int, "
    "reference_pmid int, epitope_modified_residues string, epitope_modifications string"
)
LP = "Linear peptide"
U = "http://ex.org/uniprot/"
E = "http://ex.org/epitope/"


def row(name, eid, allele, start=None, end=None, parent=None, source_iri=None, molecule=None, pmid=None,
        residues=None, mods=None, otype=LP, cls="I"):
    return (otype, name, f"{E}{eid}" if eid is not None else None, allele, cls, parent, source_iri, molecule,
            start, end, pmid, residues, mods)


@pytest.fixture()
def export(spark):
    rows = [
        # modal pair: 24337-24345 seen 3x, 23410-24345 once -> the pair, not the extremes
        row("ESDPIVAQY", 1, "HLA-A*01:01", 24337, 24345, parent=f"{U}Q8WZ42", pmid=10, molecule="Titin"),
        row("ESDPIVAQY", 1, "HLA-A*01:01", 24337, 24345, parent=f"{U}Q8WZ42", pmid=11, molecule="Titin"),
        row("ESDPIVAQY", 1, "HLA-A*01:01", 24337, 24345, source_iri=f"{U}Q8WZ42", pmid=11, molecule="titin"),
        row("ESDPIVAQY", 1, "HLA-A*01:01", 23410, 24345, parent=f"{U}Q8WZ42", pmid=12, molecule="Titin"),
        # modification suffix and junction space are stripped
        row("LQPFPQPQLPY + DEAM(Q8)", 2, "HLA-DQ2", 1, 11, residues="Q8", mods="DEAM", cls="II"),
        row("LQPFPQPQLPY", 2, "HLA-DQ2", 1, 11, cls="II"),
        row("TEGVEALYLVC KGGS", 3, "H2-IAg7", cls="II"),
        # analogue: no provenance
        row("ELAGIGILTV", 4, "HLA-A*02:01", pmid=20),
        # non-peptide: excluded
        row("glycolipid X", 5, "CD1d", otype="Non-peptidic"),
        # null allele: the group keeps its aggregates but positions are null
        row("GILGFVFTL", 6, None, 58, 66, parent=f"{U}P03485", pmid=30),
        row("GILGFVFTL", 6, None, 58, 66, parent=f"{U}P03485", pmid=None),
        # tie on the pair (1 vs 1) and on the accession: lowest wins, nulls last
        row("NLVPMVATV", 7, "HLA class I", None, None, parent=f"{U}B00002"),
        row("NLVPMVATV", 7, "HLA class I", 495, 503, parent=f"{U}A00001"),
    ]
    return spark.createDataFrame(rows, EXPORT_SCHEMA)


def test_scalar_cleaning(spark):
    df = spark.createDataFrame(
        [("LQPFPQPQLPY + DEAM(Q8)", "x/uniprot/P0DTC2", "e/epitope/123"),
         ("TEGVEALYLVC KGGS", None, "no id"),
         ("A + B + C", "x/protein/9", None)], "n string, iri string, e string")
    got = df.select(clean_sequence("n").alias("s"), extract_or_null("iri", r"uniprot/([A-Z0-9]+)").alias("u"),
                    epitope_id("e").alias("i"), flag_matches("n").alias("f")).collect()
    assert [r.s for r in got] == ["LQPFPQPQLPY", "TEGVEALYLVCKGGS", "A"]
    assert [r.u for r in got] == ["P0DTC2", None, None]
    assert [r.i for r in got] == [123, None, None]
    coalesced = df.select(accession(["iri", "e"]).alias("a")).collect()
    assert [r.a for r in coalesced] == ["P0DTC2", None, None]


def test_reduced_table(spark, export):
    red = reduce_to_grain(extract_fields(export))
    assert tuple(red.columns) == REDUCED_COLUMNS
    types = dict(red.dtypes)
    assert types["peptide_length"] == "smallint" and types["pmids"] == "array<int>"
    assert types["n_assays"] == "bigint" and types["n_pmids"] == "int"
    rows = {(r.sequence, r.iedb_epitope_id, r.mhc_allele): r for r in red.collect()}
    assert len(rows) == 6
    t = rows[("ESDPIVAQY", 1, "HLA-A*01:01")]
    assert (t.start_position, t.end_position) == (24337, 24345)
    assert t.uniprot_id == "Q8WZ42" and t.source_molecule == "Titin"
    assert t.pmids == [10, 11, 12] and t.n_pmids == 3 and t.n_assays == 4
    assert t.allele_is_specific is True and t.peptide_length == 9
    m = rows[("LQPFPQPQLPY", 2, "HLA-DQ2")]
    assert m.is_modified and m.modifications == ["DEAM"] and m.modified_residues == ["Q8"] and m.n_assays == 2
    assert rows[("TEGVEALYLVCKGGS", 3, "H2-IAg7")].allele_is_specific is False
    a = rows[("ELAGIGILTV", 4, "HLA-A*02:01")]
    assert a.uniprot_id is None and a.start_position is None and a.n_pmids == 1
    assert a.modifications == [] and a.is_modified is False
    n = rows[("GILGFVFTL", 6, None)]
    assert n.uniprot_id == "P03485" and n.n_assays == 2 and n.pmids == [30]
    assert n.start_position is None and n.end_position is None and n.allele_is_specific is None
    tie = rows[("NLVPMVATV", 7, "HLA class I")]
    assert (tie.start_position, tie.end_position) == (495, 503)
    assert tie.uniprot_id == "A00001"
    assert ("glycolipidX", 5, "CD1d") not in rows


def test_modal_tuple_survives_sort_fallback(spark):
    """Many groups force the object hash aggregate into sort-based merging."""
    spark.conf.set("spark.sql.objectHashAggregate.sortBased.fallbackThreshold", "2")
    try:
        base = spark.range(0, 4000).select((F.col("id") % 500).alias("g"), F.col("id"))
        df = base.select("g", F.when(F.col("id") % 3 == 0, None).otherwise(F.col("g") % 7).alias("a"),
                         (F.col("id") % 2).alias("b")).repartition(16)
        got = df.groupBy("g").agg(modal_tuple("a", "b").alias("m")).select("g", "m.a", "m.b")
        pdf = df.toPandas()
        exp = {}
        for g, grp in pdf.groupby("g"):
            counts = grp.groupby(["a", "b"], dropna=False).size().reset_index(name="n")
            counts["na"] = counts["a"].isna()
            counts = counts.sort_values(["n", "na", "a", "b"], ascending=[False, True, True, True])
            top = counts.iloc[0]
            exp[g] = (None if top["na"] else int(top["a"]), int(top["b"]))
        assert {r.g: (r.a, r.b) for r in got.collect()} == exp
    finally:
        spark.conf.unset("spark.sql.objectHashAggregate.sortBased.fallbackThreshold")


def test_modal_value_and_first_non_null(spark):
    df = spark.createDataFrame([(1, "b", 3), (1, "a", 2), (1, None, 1), (1, None, 0), (2, None, 0)],
                               "k int, v string, o int")
    got = {r.k: r for r in df.groupBy("k").agg(
        modal_value("v").alias("m"), first_non_null("v").alias("f"), first_non_null("v", "o").alias("fo"),
        distinct_count_with_nulls("v").alias("d")).collect()}
    assert got[1].m == "a" and got[1].f == "a" and got[1].fo == "a" and got[1].d == 3
    assert got[2].m is None and got[2].f is None and got[2].d == 1


def test_quality_checks(spark, export):
    red = reduce_to_grain(extract_fields(export))
    assert check_unique(red).count() == 0
    assert check_pattern(red).count() == 0
    assert check_span(red).count() == 0
    report = {r.check: (r.n_rows, r.n_violations) for r in quality_report(red).collect()}
    assert report == {"grain_unique": (6, 0), "residues_only": (6, 0), "span_equals_length": (6, 0),
                      "modified_has_modification": (6, 0)}


def test_check_expected(spark, export):
    red = reduce_to_grain(extract_fields(export))
    expected = spark.createDataFrame(
        [("ESDPIVAQY", "Q8WZ42", 24337, 24345), ("ELAGIGILTV", None, None, None), ("MISSING", None, None, None),
         ("NLVPMVATV", "A00001", 1, 9)],
        "sequence string, uniprot_id string, start_position int, end_position int")
    bad = check_expected(red, expected, "sequence", [F.desc("n_assays"), "iedb_epitope_id", "mhc_allele"],
                         ["uniprot_id", "start_position", "end_position"], where=F.col("allele_is_specific"))
    got = {r.sequence: r.found for r in bad.collect()}
    # NLVPMVATV's allele is class-level, so it has no specific row either
    assert got == {"MISSING": False, "NLVPMVATV": False}


@pytest.mark.parametrize("bits,dtype", [(32, "int"), (64, "bigint")])
def test_modal_tuple_extremes(spark, bits, dtype):
    lo, hi = (-(2 ** 31), 2 ** 31 - 1) if bits == 32 else (-(2 ** 63), 2 ** 63 - 1)
    rows = [(1, lo, hi), (1, lo, hi), (1, 0, None), (2, -5, 3), (2, 7, -1), (3, None, None), (3, hi, lo)]
    df = spark.createDataFrame(rows, f"g int, a {dtype}, b {dtype}")
    got = {r.g: (r.a, r.b) for r in df.groupBy("g").agg(modal_tuple("a", "b", bits=bits).alias("m"))
           .select("g", "m.a", "m.b").collect()}
    # group 2 ties -> lowest first member; group 3 ties -> non-null before null
    assert got == {1: (lo, hi), 2: (-5, 3), 3: (hi, lo)}


def test_epitope_id_overflow_raises(spark):
    from pyspark.errors import PySparkException

    df = spark.createDataFrame([("x/epitope/99999999999",)], "iri string")
    with pytest.raises(PySparkException, match="does not fit"):
        df.select(epitope_id("iri")).collect()
