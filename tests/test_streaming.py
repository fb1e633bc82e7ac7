import os

from tessera.streaming.shard_stream import import_arriving_shards

HEADER = "Ref,Ref,Assay\nIRI,Date,Value\n"


def _write(d, name, text):
    with open(os.path.join(d, name), "w", encoding="utf-8") as f:
        f.write(text)


def test_incremental_import_exactly_once(spark, tmp_dir):
    src = os.path.join(tmp_dir, "src")
    os.makedirs(src)
    out = os.path.join(tmp_dir, "out")
    ck = os.path.join(tmp_dir, "ck")
    casts = {"Ref - Date": "smallint"}
    _write(src, "x_00.csv", HEADER + 'a,2020,"1,5"\nb,2021,2\n')
    _write(src, "x_01.csv", "c,2022,3\n")
    q = import_arriving_shards(spark, src, out, casts, checkpoint=ck)
    q.awaitTermination()
    first = spark.read.parquet(out)
    assert first.columns == ["ref_iri", "ref_date", "assay_value"]
    assert sorted(r.ref_iri for r in first.collect()) == ["a", "b", "c"]
    # a new shard arrives; a second run imports only it
    _write(src, "x_02.csv", "d,2023,4\n")
    import_arriving_shards(spark, src, out, casts, checkpoint=ck).awaitTermination()
    rows = spark.read.parquet(out).collect()
    assert sorted(r.ref_iri for r in rows) == ["a", "b", "c", "d"]
    assert {r.ref_iri: r.ref_date for r in rows}["d"] == 2023
    assert {r.ref_iri: r.assay_value for r in rows}["a"] == "1,5"


def test_stream_rejects_rows_with_extra_fields(spark, tmp_dir):
    import pytest
    from pyspark.errors import StreamingQueryException

    src = os.path.join(tmp_dir, "src")
    os.makedirs(src)
    _write(src, "x_00.csv", HEADER + "a,2020,1\n")
    _write(src, "x_01.csv", "b,2021,2,extra\n")
    q = import_arriving_shards(spark, src, os.path.join(tmp_dir, "out"), {"Ref - Date": "smallint"},
                               checkpoint=os.path.join(tmp_dir, "ck"))
    with pytest.raises(StreamingQueryException, match="more fields"):
        q.awaitTermination()


def test_stream_applies_the_strict_text_rule(spark, tmp_dir):
    import pytest
    from pyspark.errors import StreamingQueryException

    src = os.path.join(tmp_dir, "src")
    os.makedirs(src)
    _write(src, "x_00.csv", HEADER + 'a," 2020",1\n')
    q = import_arriving_shards(spark, src, os.path.join(tmp_dir, "out"), {"Ref - Date": "smallint"},
                               checkpoint=os.path.join(tmp_dir, "ck"))
    with pytest.raises(StreamingQueryException):
        q.awaitTermination()


def test_second_run_without_a_checkpoint_imports_new_shards(spark, tmp_dir):
    src, out = os.path.join(tmp_dir, "src"), os.path.join(tmp_dir, "out")
    os.makedirs(src)
    _write(src, "x_00.csv", HEADER + "a,2020,1\nb,2021,2\n")
    import_arriving_shards(spark, src, out).awaitTermination()
    _write(src, "x_01.csv", "c,2022,3\n")
    import_arriving_shards(spark, src, out).awaitTermination()
    import_arriving_shards(spark, src, out).awaitTermination()
    assert sorted(r.ref_iri for r in spark.read.parquet(out).collect()) == ["a", "b", "c"]


def test_stream_drops_a_header_with_a_quoted_blank_cell(spark, tmp_dir):
    src, out = os.path.join(tmp_dir, "src"), os.path.join(tmp_dir, "out")
    os.makedirs(src)
    _write(src, "x_00.csv", 'G,"",G\na,b,c\n1,2,3\n')
    import_arriving_shards(spark, src, out).awaitTermination()
    assert [tuple(r) for r in spark.read.parquet(out).collect()] == [("1", "2", "3")]


def test_data_rows_that_equal_header_records_stay(spark, tmp_dir):
    for multiline in (True, False):
        src, out = os.path.join(tmp_dir, f"src{multiline}"), os.path.join(tmp_dir, f"out{multiline}")
        os.makedirs(src)
        _write(src, "x_00.csv", HEADER + "a,2020,1\nIRI,Date,Value\nRef,Ref,Assay\nIRI,Date,Value\n")
        _write(src, "x_01.csv", "IRI,Date,Value\nb,2021,2\n")
        import_arriving_shards(spark, src, out, {}, multiline=multiline).awaitTermination()
        got = sorted(r.ref_iri for r in spark.read.parquet(out).collect())
        assert got == ["IRI", "IRI", "IRI", "Ref", "a", "b"]
