"""Multi-line CSV in byte ranges against Spark's own reader of whole files."""

import random

import pytest

from scorelab.sources import read_split_csv, read_survey_csv, write_survey_csv


@pytest.fixture()
def small_ranges(spark):
    def held(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", 0)

    yield held
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("size", [7, 40, 200, 3000, 1 << 20])
def test_ranges_give_the_rows_of_whole_files(spark, tmp_path, small_ranges, size):
    draw = random.Random(size)
    pieces = ["a", "b,c", '"', '""', "\n", "\n\n", "x y", ",", "NA", " ", "é漢", "\\", "'"]
    rows = [(str(i), draw.choice([None, "", "NA;x", "".join(draw.choices(pieces, k=draw.randint(1, 9)))]),
             None if i % 7 else "line\n" * draw.randint(1, 60)) for i in range(60 if size < 100 else 400)]
    path = str(tmp_path / "out")
    write_survey_csv(spark.createDataFrame(rows, "id string, a string, `b c` string").repartition(2), path)
    small_ranges(size)
    expected = rows_of(read_survey_csv(spark, path))
    assert rows_of(read_split_csv(spark, path)) == expected == rows_of(read_split_csv(spark, path, ["id", "a", "b c"]))


def test_one_file_in_eight_ranges(spark, tmp_path, small_ranges):
    """A single file whose answers hold line breaks and doubled quotes on every border."""
    rows = [(str(i), f'say "{i}"\nand "then"\n' * 40) for i in range(200)]
    path = str(tmp_path / "one")
    write_survey_csv(spark.createDataFrame(rows, "id string, t string").coalesce(1), path)
    [file] = list((tmp_path / "one").glob("*.csv"))
    small_ranges(file.stat().st_size // 8 + 1)
    found = read_split_csv(spark, path)
    assert rows_of(found) == sorted(rows, key=str)
    assert spark.read.text(str(file)).rdd.getNumPartitions() >= 8


def test_answers_longer_than_ranges_and_other_line_ends(spark, tmp_path, small_ranges):
    path = tmp_path / "f.csv"
    path.write_bytes(b'id,t\r\n1,"' + b"x\n" * 500 + b'"\r\n\r\n2,plain\r\n3,\r\n4,""\r\n5,"q""q"')
    small_ranges(64)
    expected = rows_of(read_survey_csv(spark, str(path)))
    assert rows_of(read_split_csv(spark, str(path))) == expected and len(expected) == 5


def test_empty_files(spark, tmp_path):
    (tmp_path / "e.csv").write_text("id,t\n")
    assert read_split_csv(spark, str(tmp_path / "e.csv")).collect() == []
