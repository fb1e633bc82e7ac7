"""The spark-submit entry points: import (with catalog), reduce, and the missing-input exit code."""

import glob
import json
import os

import pytest

from tessera.jobs import main
from tessera.plans.epitope_table import reduced_table
from tessera.plans.export_frame import export_frame
from tessera.plans.export_import import export_casts, export_shards_dir

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="driver test data not present")


def test_import_then_reduce_jobs(spark, tmp_dir, capsys):
    src = export_shards_dir(spark, SF)
    casts = export_casts(export_frame(spark, SF).columns)
    out, red, cat = (os.path.join(tmp_dir, x) for x in ("parquet", "reduced", "columns"))
    code = main(["import", "--input", src, "--parquet", out, "--casts", json.dumps(casts),
                 "--columns", cat, "--reduced", red], spark=spark)
    assert code == 0
    lines = [json.loads(x) for x in capsys.readouterr().out.strip().splitlines()]
    assert [x["step"] for x in lines] == ["import", "reduce"]
    assert lines[0]["rows"] == spark.read.parquet(out).count() and lines[0]["columns"] == 14
    assert lines[1]["rows"] == reduced_table(spark, SF).count()
    doc = json.loads(open(glob.glob(cat + "/*.json")[0]).read())
    assert doc["column_count"] == 14 and doc["columns"][0]["slug"] == "epitope_name"


def test_missing_input_exits_1(spark, tmp_dir):
    assert main(["reduce", "--parquet", os.path.join(tmp_dir, "nope"), "--reduced", tmp_dir + "/r"], spark=spark) == 1
    assert main(["import", "--input", os.path.join(tmp_dir, "nope"), "--parquet", tmp_dir + "/p"], spark=spark) == 1
