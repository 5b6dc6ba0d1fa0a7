"""Quoted CSV read by many tasks against the sequential reader."""

import random

import pytest
from pyspark.sql import functions as F

from labelloom.sources import readers

PIECES = ["a", "b c", "", '""', ",", "\n", "\r\n", '"",""', "\n\n", "x,\ny", "é", '""\n""', "end"]


@pytest.fixture
def small_splits(spark):
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in zip(keys, ("97", "0", "1"), strict=True):
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def make(path, seed, rows, end="\n", quote=0.6):
    rng = random.Random(seed)

    def cell():
        if rng.random() < quote:
            return '"' + "".join(rng.choice(PIECES) for _ in range(rng.randint(0, 6))) + '"'
        return rng.choice(["plain", "5 ft", "", "x y z", 'in"ner'])

    lines = ["text,label,n"] + [f"{cell()},{cell()},{i}" for i in range(rows)]
    path.write_bytes((end.join(lines) + end * rng.randint(0, 2)).encode())
    return str(path)


def sequential(spark, path):
    wide = "text string, label string, n string"
    return spark.read.schema(wide).csv(path, header=True, multiLine=True, quote='"', escape='"')


def rows(df):
    return [tuple(r) for r in df.collect()]


@pytest.mark.parametrize("seed,end,quote", [(1, "\n", 0.6), (2, "\r\n", 0.9), (3, "\n", 0.1)])
def test_equals_the_sequential_reader(spark, small_splits, tmp_path, seed, end, quote):
    path = make(tmp_path / "a b.csv", seed, 150, end, quote)
    got = readers.read_csv(spark, path, na_tokens=(), order="ord")
    want = rows(sequential(spark, path))
    assert len(want) == 150
    found = rows(got.orderBy("ord").drop("ord"))
    if end == "\r\n":  # the sequential reader turns these breaks into \n inside cells too, ours keeps them
        assert any("\r\n" in row[0] for row in found if row[0])
        found = [tuple(c and c.replace("\r\n", "\n") for c in row) for row in found]
    assert found == want
    assert got.select("ord.start").distinct().count() > 10


def test_parts_come_in_the_order_listed_and_may_repeat(spark, small_splits, tmp_path):
    late, early = make(tmp_path / "z.csv", 4, 20), make(tmp_path / "a.csv", 5, 30)
    got = readers.read_csv(spark, [late, early, late], na_tokens=(), order="ord")
    want = [row for path in (late, early, late) for row in rows(sequential(spark, path))]
    assert rows(got.orderBy("ord").drop("ord")) == want


def test_one_cell_over_many_splits_and_a_cell_never_closed(spark, small_splits, tmp_path):
    path = tmp_path / "long.csv"
    path.write_text('text,label\n"' + "line, with comma\n" * 60 + '",x\nlast,y\n"open\n,tail\n' + "more\n" * 40)
    got = rows(readers.read_csv(spark, str(path), na_tokens=(), order="ord").orderBy("ord").drop("ord"))
    assert got[0] == ("line, with comma\n" * 60, "x")
    assert got[1] == ("last", "y")
    assert len(got) == 3 and got[2][0].startswith("open\n,tail\nmore")


def test_header_only_and_blank_lines(spark, small_splits, tmp_path):
    path = tmp_path / "h.csv"
    path.write_text("\n\ntext,label\n\n")
    assert rows(readers.read_csv(spark, str(path))) == []
    path.write_text('text,label\n\n"",\n\nNA,b')
    assert rows(readers.read_csv(spark, str(path), na_tokens=("NA",), order="o").orderBy("o").drop("o")) == [(None, None), (None, "b")]


def test_lines_of_whole_records_are_not_shuffled(spark, tmp_path):
    path = make(tmp_path / "p.csv", 6, 10)
    plan = readers.read_csv(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "BroadcastHashJoin" in plan
