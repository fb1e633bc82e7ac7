"""Splits of shards with quoted newlines, against the reader of whole files."""

import random

import pytest
from pyspark.sql import functions as F

from tessera.sources import sharded_csv as sc
from tessera.sources.quoted_splits import leading_lines, plan_splits, split_records

HEADER = "G,G,G,G\na,b,c,d\n"


@pytest.fixture()
def split_size(spark):
    """Sets how many bytes a split has."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {n: spark.conf.get(n) for n in names}

    def change(n):
        spark.conf.set(names[0], str(n))
        spark.conf.set(names[1], "1")

    yield change
    for n, v in before.items():
        spark.conf.set(n, v)


def write(path, texts, header=HEADER):
    path.mkdir()
    for k, text in enumerate(texts):
        (path / f"e_{k:02d}.csv").write_bytes(((header if k == 0 else "") + text).encode())
    return str(path)


def rows(df):
    return sorted(map(repr, map(tuple, df.collect())))


def random_text(rnd, n, sep):
    def field(quoted):
        if not quoted:
            return rnd.choice(["abc", "", "12", " x ", "é字", "a'b"])
        text = "".join(rnd.choice(['"', "\n", "\r\n", ",", "x", "yy", " ", "\r"]) for _ in range(rnd.randint(0, 12)))
        return '"' + text.replace('"', '""') + '"'

    lines = [",".join(field(n and rnd.random() < 0.5) for _ in range(4)) for n in range(n)]
    text = "".join(line + sep * (2 if rnd.random() < 0.05 else 1) for line in lines)
    return text[:-len(sep)] if rnd.random() < 0.5 else text


@pytest.mark.parametrize("seed,sep", [(1, "\n"), (2, "\r\n"), (3, "\n"), (4, "\r\n")])
def test_equals_the_reader_of_whole_files(spark, tmp_path, split_size, seed, sep):
    rnd = random.Random(seed)
    path = write(tmp_path / "s", [random_text(rnd, n, sep) for n in (40, 1, 0, 70)], HEADER.replace("\n", sep))
    want = rows(sc.read_sharded_csv(spark, path, split=False))
    for size in (90, 1000):
        split_size(size)
        got = sc.read_sharded_csv(spark, path, split=True)
        assert rows(got) == want
    assert len(want) > 100


def test_a_record_over_many_splits(spark, tmp_path, split_size):
    long = '"' + "\n".join(f'line {n}, ""quoted""' for n in range(60)) + '"'
    path = write(tmp_path / "s", [f"1,{long},2,3\n4,5,6,7\n", f'8,9,{long},"x"\n{long},"a\n","b\n\n",c'])
    want = rows(sc.read_sharded_csv(spark, path, split=False))
    split_size(64)
    got = sc.read_sharded_csv(spark, path, split=True)
    assert got.rdd.getNumPartitions() > 20
    assert rows(got) == want and len(want) == 4


def test_header_over_split_edges(spark, tmp_path, split_size):
    header = '\n"G\n1","G\n2",G,G\n"a\nname",b,c,"d, ""x"""\n'
    path = write(tmp_path / "s", ['1,2,3,"4\n5"\n'], header)
    want = sc.read_sharded_csv(spark, path, split=False)
    assert leading_lines(spark, sc.list_shards(spark, path)[0], 2) == 6
    split_size(5)
    got = sc.read_sharded_csv(spark, path, split=True)
    assert got.columns == want.columns and rows(got) == rows(want) and got.count() == 1


def test_byte_order_marks_and_names_with_blanks(spark, tmp_path, split_size):
    folder = tmp_path / "some shards 100%"
    folder.mkdir()
    (folder / "an e_00.csv").write_bytes(("\ufeff" + HEADER + "1,2,3,4\n").encode())
    (folder / "an e_01.csv").write_bytes("\ufeff\"5\n\",6,7,8\n".encode())
    split_size(8)
    assert rows(sc.read_sharded_csv(spark, str(folder), split=True)) == rows(sc.read_sharded_csv(spark, str(folder), split=False))


def test_more_tasks_than_shards_only_where_shards_are_large(spark, tmp_path, split_size):
    text = "".join(f'{n},"a\n""{n}""",x,y\n' for n in range(400))
    path = write(tmp_path / "s", [text, text])
    small = sc.read_sharded_csv(spark, path)
    assert small.rdd.getNumPartitions() <= 2
    split_size(1500)
    large = sc.read_sharded_csv(spark, path)
    assert large.rdd.getNumPartitions() > 8
    assert "mapInArrow" in large._jdf.queryExecution().toString() or "MapInArrow" in large._jdf.queryExecution().toString()
    assert rows(large) == rows(small) and large.count() == 800


def test_no_second_pass_without_crossing_records(spark, tmp_path, split_size):
    path = write(tmp_path / "s", ["".join(f"{n},a,b,c\n" for n in range(300))])
    split_size(500)
    shards = sc.list_shards(spark, path)
    plan = plan_splits(spark, shards, {shards[0]: 2})
    assert len(plan.splits) > 5 and not plan.crossing
    assert "Union" not in split_records(spark, shards, plan)._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("text,message", [
    ('1,5" pipe,2,3\n4,6" pipe,5,6\n', "a quote inside an unquoted field"),
    ('1,"a"b,2,3\n', "a quote inside an unquoted field"),
    ('1, "a",2,3\n', "a quote inside an unquoted field"),
    ('1,"never closed,2,3\n4,5,6,7\n', "ends inside quotes"),
    ("1,2,3,4,5\n", "more fields"),
    ('1,2,3,"4\n",5\n', "more fields"),
])
def test_what_cannot_be_proven_raises(spark, tmp_path, split_size, text, message):
    path = write(tmp_path / "s", [text])
    split_size(20)
    with pytest.raises(Exception, match=message):
        sc.read_sharded_csv(spark, path, split=True).collect()


def test_other_splits_than_planned_raise(spark, tmp_path, split_size):
    path = write(tmp_path / "s", ["".join(f'{n},"a\n",b,c\n' for n in range(100))])
    split_size(90)
    df = sc.read_sharded_csv(spark, path, split=True)
    split_size(70)
    with pytest.raises(Exception, match="splits that were planned"):
        df.collect()


def test_lone_carriage_returns_raise(spark, tmp_path):
    path = write(tmp_path / "s", ["1,2,3,4\r"], HEADER.replace("\n", "\r"))
    with pytest.raises(ValueError, match="lone carriage return"):
        plan_splits(spark, sc.list_shards(spark, path))


def test_short_rows_empty_shards_and_casts(spark, tmp_path, split_size):
    path = write(tmp_path / "s", ['1,"x\n"\n', "", "\n\n2,y,,\"\"\n"])
    split_size(6)
    got = sc.read_sharded_csv(spark, path, casts={"G - a": "int"}, split=True)
    assert sorted(map(tuple, got.collect())) == [(1, "x\n", None, None), (2, "y", None, "")]
    assert got.where(F.col("g_a") > 1).count() == 1
