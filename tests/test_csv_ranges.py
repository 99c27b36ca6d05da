"""Multi-line CSV by ranges against the single-task reader, on random, quoted and torn input."""
import random

import pytest

from plaint.sources import csv_ranges as R
from plaint.sources.files import CORRUPT, count_corrupt_csv, read_bulk_csv

HEADER = "a,b,c"


def field(rnd):
    kind = rnd.random()
    if kind < 0.4:
        return "".join(rnd.choice("xyz 0é") for _ in range(rnd.randint(0, 6))).strip()
    inner = "".join(rnd.choice(["x", "yy", " ", ",", "\n", '""', "\n\n", "long text "]) for _ in range(rnd.randint(0, 25)))
    return f'"q{inner}q"'


def made(tmp_path, seed, torn=False, end="\n"):
    rnd = random.Random(seed)
    rows = [",".join(field(rnd) for _ in range(rnd.choice([3, 3, 3, 3, 2, 4] if torn else [3]))) for _ in range(120)]
    text = "\n".join([HEADER, *rows]) + end
    if torn:
        text += 'x,"never closed\n more,\n'
    (tmp_path / "in.csv").write_text(text, encoding="utf-8")
    return str(tmp_path / "in.csv")


def single_task(spark, path):
    schema = f"a string, b string, c string, {CORRUPT} string"
    rows = spark.read.option("header", "true").option("multiLine", "true").option("escape", '"').option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).schema(schema).csv(path)
    return rows.select("a", "b", "c", CORRUPT)


def sound(df):
    return sorted(([r.a, r.b, r.c] for r in df.collect() if r[CORRUPT] is None), key=str)


@pytest.fixture
def small_ranges(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize("seed, torn, end", [(1, False, "\n"), (2, False, ""), (3, True, "\n"), (4, True, "")])
def test_equals_the_single_task_reader(spark, small_ranges, tmp_path, seed, torn, end):
    path = made(tmp_path, seed, torn, end)
    got = R.read_records(spark, path, ["a", "b", "c"], CORRUPT)
    want = single_task(spark, path)
    assert R.lines_of(spark, path).rdd.getNumPartitions() > 8  # one file, many tasks
    assert sound(got) == sound(want)
    assert got.count() == want.count()


def test_many_ranges_by_shuffle(spark, small_ranges, tmp_path, monkeypatch):
    path = made(tmp_path, 5)
    want = sound(single_task(spark, path))
    monkeypatch.setattr(R, "MAX_BROADCAST_RANGES", 0)
    assert sound(R.read_records(spark, path, ["a", "b", "c"], CORRUPT)) == want


def test_a_field_longer_than_ranges_and_carriage_returns(spark, small_ranges, tmp_path):
    long = "\r\n".join("word " * 30 for _ in range(20))
    (tmp_path / "in.csv").write_bytes(f'{HEADER}\r\n1,"{long}",x\r\n2,5" pipe,y\r\n\r\n3,"",z\r\n'.encode())
    got = {r.a: (r.b, r.c) for r in R.read_records(spark, str(tmp_path / "in.csv"), ["a", "b", "c"], CORRUPT).collect()}
    assert set(got) == {"1", "2", "3"} and got["2"] == ('5" pipe', "y") and got["3"][1] == "z"
    assert got["1"][0].replace("\r", "") == long.replace("\r", "") and got["1"][1] == "x"


def test_several_files_and_headers(spark, small_ranges, tmp_path):
    for k in range(3):
        (tmp_path / f"{k}.csv").write_text(f'Company,Issue\nc{k},"i\n{k}"\nc,i\n')
    (tmp_path / "3.csv").write_text("")
    rows = read_bulk_csv(spark, str(tmp_path))
    assert rows.count() == 6 and {r.issue for r in rows.collect()} == {"i", "i\n0", "i\n1", "i\n2"}
    assert count_corrupt_csv(spark, str(tmp_path)).first().lines == 6
    (tmp_path / "4.csv").write_text("Issue,Company\na,b\n")
    with pytest.raises(Exception, match="header"):
        read_bulk_csv(spark, str(tmp_path)).collect()


@pytest.mark.parametrize("line, inside, want", [('a,"b', False, True), ('b",c', True, False), ('a"b,c', False, False), ('"a""', False, True), ('""""', False, False),
                                               ('x""y', True, True), ("", True, True), ("", False, False), ('a",', True, False), (',"', False, True)])
def test_states(line, inside, want):
    assert R.ends_inside(line, inside) is want
