"""CSV with line breaks in quoted fields, read by several tasks."""

import csv
import os
import random

import pytest
from pyspark.sql import functions as F

from stallwise.sources import catalog

SCHEMA = "id int, title string, message string, score double"


def single_task(spark, path):
    return spark.read.schema(SCHEMA).option("header", True).option("multiLine", True).options(**catalog.CSV_OPTIONS).csv(path)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def text(rng):
    parts = ["word", ' "quoted" ', "\n", "\n\n", ",", '""', "\r\n", " é日 ", ";", "\\", '"']
    return "".join(rng.choice(parts) for _ in range(rng.randint(0, 12)))


def write(path, n, seed, newline="\n"):
    rng = random.Random(seed)
    with open(path, "w", newline="", encoding="utf-8") as out:
        writer = csv.writer(out, lineterminator=newline)
        writer.writerow(["id", "title", "message", "score"])
        for i in range(n):
            writer.writerow([rng.choice([i, i, i, "bad"]), text(rng), text(rng) * rng.choice([1, 1, 1, 20]), rng.choice([1.5, "", "x"])])


@pytest.fixture
def small_splits(spark):
    names = {"spark.sql.files.maxPartitionBytes": "4096", "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("newline", ["\n", "\r\n"])
def test_equals_the_single_task_reader(spark, small_splits, tmp_path, newline):
    for i, n in enumerate((700, 0, 1, 40)):
        write(tmp_path / f"{i}.csv", n, i, newline)
    got, want = catalog.scan_records(spark, str(tmp_path), SCHEMA), single_task(spark, str(tmp_path))
    assert got.columns == want.columns and got.dtypes == want.dtypes
    assert rows(got) == rows(want) and want.count() == 741


def test_one_file_is_read_by_several_tasks(spark, small_splits, tmp_path):
    path = str(tmp_path / "one.csv")
    write(path, 700, 9)
    lines = catalog.csv_lines(spark, path)
    assert os.path.getsize(path) > 10 * 4096
    assert lines.select(F.spark_partition_id()).distinct().count() > 10
    ends = lines.groupBy("block").agg(F.max_by("odd", "at").alias("odd")).count()
    assert ends > 10


def test_a_record_longer_than_many_splits(spark, small_splits, tmp_path):
    path = str(tmp_path / "long.csv")
    message = "line, with \"quotes\"\n" * 3000
    with open(path, "w", newline="", encoding="utf-8") as out:
        writer = csv.writer(out, lineterminator="\n")
        writer.writerows([["id", "title", "message", "score"], [1, "a", message, 0.5], [2, "b\n", "c", ""], [3, "", message, 1.0]])
    got = rows(catalog.scan_csv(spark, path, SCHEMA, multi_line=True))
    assert got == [(1, "a", message, 0.5), (2, "b\n", "c", None), (3, None, message, 1.0)]


def test_empty_lines_and_open_quotes(spark, tmp_path):
    path = tmp_path / "odd.csv"
    path.write_text('id,title,message,score\n\n1,a,b,2\n\n2,"never, ends\n3,c,d,1\n')
    got, want = rows(catalog.scan_records(spark, str(path), SCHEMA)), rows(single_task(spark, str(path)))
    assert [r[0] for r in got] == [r[0] for r in want] == [1, 2]
