"""Quoted records with line breaks: the parallel reader against ``multiLine``."""

import random

import pytest

from martforge.schemas import RAW_SCHEMAS
from martforge.sources.raw import read_csv, read_source
from martforge.sources.records import parse_records, read_records

SCHEMA = "a int, b string, c string"


@pytest.fixture()
def small_splits(spark):
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {k: spark.conf.get(k) for k in keys}

    def cut(size):
        for k in keys:
            spark.conf.set(k, str(size))
    yield cut
    for k, v in before.items():
        spark.conf.set(k, v)


def _struct(spark):
    return spark.createDataFrame([], SCHEMA).schema


def _expected(spark, path, header=True):
    return (spark.read.schema(SCHEMA).option("header", header).option("multiLine", True)
            .option("quote", '"').option("escape", '"').csv(path))


def _value(rng):
    kind = rng.random()
    if kind < 0.3:
        return rng.choice(["", "plain", '5" pipe', "x" * rng.randint(1, 60), " spaced "])
    inner = "".join(rng.choice(['""', "\n", ",", "word", "é", "\n\n", "a" * 30]) for _ in range(rng.randint(0, 6)))
    return f'"{inner}"' + rng.choice(["", "", "", "tail"])


@pytest.mark.parametrize("seed", range(6))
def test_records_equal_multiline_reader(spark, tmp_dir, small_splits, seed):
    rng = random.Random(seed)
    for part in range(2):
        rows = [f"{rng.randint(0, 99) if rng.random() > 0.1 else 'bad'},{_value(rng)},{_value(rng)}"
                for _ in range(rng.randint(0, 120))]
        with open(f"{tmp_dir}/{part}.csv", "w", encoding="utf-8", newline="") as f:
            f.write("\n".join(["a,b,c", *rows]) + ("\n" if rng.random() < 0.5 else ""))
    want = sorted(map(str, _expected(spark, tmp_dir).collect()))
    small_splits(rng.choice([16, 64, 300]))
    records = read_records(spark, tmp_dir)
    got = parse_records(records, _struct(spark))
    assert sorted(map(str, got.collect())) == want
    if len(want) > 60:
        assert records.select("file", "block").distinct().count() > 4


def test_record_larger_than_many_splits(spark, tmp_dir, small_splits):
    text = "\n".join(f'line {i} ""{i}"",' for i in range(200))
    with open(f"{tmp_dir}/x.csv", "w") as f:
        f.write(f'a,b,c\n1,"{text}",z\n2,y,"{text}"\n3,,\n')
    small_splits(50)
    rows = parse_records(read_records(spark, f"{tmp_dir}/x.csv"), _struct(spark)).orderBy("a").collect()
    assert [r.a for r in rows] == [1, 2, 3]
    assert rows[0].b == rows[1].c == text.replace('""', '"')


def test_numbers_follow_the_file(spark, tmp_dir, small_splits):
    with open(f"{tmp_dir}/x.csv", "w") as f:
        f.write("a,b,c\n" + "".join(f'{i},"b\n{i}",c\n' for i in range(300)))
    for size in (40, 100_000):
        small_splits(size)
        got = read_records(spark, f"{tmp_dir}/x.csv", number="nr").select("nr", "record").collect()
        assert sorted((r.nr, r.record) for r in got) == [(i + 1, f'{i},"b\n{i}",c') for i in range(300)]


def test_line_ends_blank_lines_and_empty_files(spark, tmp_dir, small_splits):
    with open(f"{tmp_dir}/dos.csv", "w", newline="") as f:
        f.write('a,b,c\r\n1,"x\r\ny",z\r\n\r\n2,q,r\r\n')
    open(f"{tmp_dir}/empty.csv", "w").close()
    small_splits(8)
    rows = parse_records(read_records(spark, tmp_dir), _struct(spark)).orderBy("a").collect()
    assert [tuple(r) for r in rows] == [(1, "x\r\ny", "z"), (2, "q", "r")]
    assert read_records(spark, f"{tmp_dir}/empty.csv").count() == 0
    with open(f"{tmp_dir}/none.txt", "w") as f:
        f.write('1;"x;\n"\n')
    bare = parse_records(read_records(spark, f"{tmp_dir}/none.txt", sep=";", header=False), _struct(spark), sep=";")
    assert [tuple(r) for r in bare.collect()] == [(1, "x;\n", None)]


def test_reviews_are_read_in_many_tasks(spark, tmp_dir, small_splits):
    small_splits(64)
    with open(f"{tmp_dir}/order_reviews", "w") as f:
        f.write(",".join(x.name for x in RAW_SCHEMAS["order_reviews"].fields) + "\n")
        f.write("".join(f'r{i},o{i},{i % 5},,"good,\nvery ""good""",2017,2018\n' for i in range(500)))
    df = read_source(spark, tmp_dir, "order_reviews")
    assert df.count() == 500 and df.filter('review_comment_message = \'good,\nvery "good"\'').count() == 500
    assert "multiLine" not in df._jdf.queryExecution().toString()
    lines = spark.read.text(f"{tmp_dir}/order_reviews")
    assert lines.rdd.getNumPartitions() > 8
    strict = read_csv(spark, f"{tmp_dir}/order_reviews", RAW_SCHEMAS["order_reviews"], multi_line=True,
                      strict_delimited=True)
    assert strict.count() == 1000  # without quote handling every line is a row
