import pytest

from tessera.functions.naming import check_unique_slugs, slug_expr, slugify

CASES = {
    "Reference - PMID": "reference_pmid",
    "Assay - Response Frequency (%)": "assay_response_frequency_percent",
    "in vivo Antigen - Starting Position": "in_vivo_antigen_starting_position",
    "  -- Leading and trailing --  ": "leading_and_trailing",
    "Epitope - Name": "epitope_name",
    "café - x": "caf_x",
    "%": "percent",
    "": "",
}


@pytest.mark.parametrize("name,slug", list(CASES.items()))
def test_slugify(name, slug):
    assert slugify(name) == slug


def test_slug_expr_matches_python(spark):
    df = spark.createDataFrame([(k,) for k in CASES], "name string")
    got = {r["name"]: r["slug"] for r in df.select("name", slug_expr("name").alias("slug")).collect()}
    assert got == CASES


def test_slug_collision_raises():
    with pytest.raises(ValueError, match="a_b"):
        check_unique_slugs(["A - b", "A - B", "C"])
