"""CSV records with line breaks inside quotes, cut in parallel over blocks of every size, and found column types."""

import csv
import random

import pytest
from pyspark.sql import functions as F

from tillroll.sources.csvlines import block_states, found_types, possible_types, read_csv, read_text_csv


@pytest.fixture
def small_blocks(spark):
    """A function that makes Spark deal files out in blocks of so many bytes."""
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = {k: spark.conf.get(k) for k in keys}

    def to(size):
        spark.conf.set(keys[0], str(size))
        spark.conf.set(keys[1], "0")
    yield to
    for k, v in old.items():
        spark.conf.set(k, v)


def records(path):
    with open(path, newline="", encoding="utf-8") as f:
        rows = [tuple(v if v != "" else None for v in r) for r in csv.reader(f) if r]
    return rows[0], sorted(rows[1:], key=repr)


@pytest.mark.parametrize("size, rows, end", [(7, 8, "\n"), (16, 12, "\r\n"), (40, 30, "\n"), (1000, 200, "\r\n")])
def test_breaks_on_every_block_edge(spark, small_blocks, tmp_path, size, rows, end):
    rng = random.Random(size)
    path = str(tmp_path / "t.csv")
    with open(path, "w", newline="", encoding="utf-8") as f:
        w = csv.writer(f, lineterminator=end)
        w.writerow(["id", "te xt", "note"])
        for i in range(rows):
            w.writerow([i, rng.choice(["plain", "a\nb", 'say "hi"\nand\n\ngo', "", 'x,"\n"', "é\n\n\nü", "\n"]),
                        rng.choice(["", "n", "one\ntwo " * rng.randint(1, 3), '"'])])
    small_blocks(size)
    got = read_text_csv(spark, path)
    names, want = records(path)
    assert got.columns == list(names)
    assert sorted(map(tuple, got.collect()), key=repr) == want
    if size <= 40:
        assert block_states(spark, path).where("inside").count() >= 2  # blocks that begin inside quotes


def test_a_record_longer_than_many_blocks(spark, small_blocks, tmp_path):
    """Blocks that lie inside one value, a header with breaks, and a folder of files."""
    for name, rows in {"a.csv": [["k\nx", "v"], ["1", "line\n" * 60], ["2", "end"]], "b.csv": [["k\nx", "v"], ["3", '""\n"']], "c.csv": []}.items():
        with open(tmp_path / name, "w", newline="", encoding="utf-8") as f:
            csv.writer(f, lineterminator="\n").writerows(rows)
    small_blocks(64)
    got = read_text_csv(spark, str(tmp_path))
    assert got.columns == ["k\nx", "v"]
    assert sorted(map(tuple, got.collect())) == [("1", "line\n" * 60), ("2", "end"), ("3", '""\n"')]


def test_no_task_reads_more_than_its_blocks(spark, small_blocks, tmp_path):
    path = str(tmp_path / "t.csv")
    with open(path, "w", newline="", encoding="utf-8") as f:
        csv.writer(f, lineterminator="\n").writerows([["a", "b"]] + [[str(i), "two\nlines"] for i in range(2000)])
    small_blocks(8000)
    lines = spark.read.option("lineSep", "\n").text(path).select(F.spark_partition_id().alias("p"), F.length("value").alias("n"))
    most = lines.groupBy("p").agg(F.sum("n").alias("n")).agg(F.max("n")).first()[0]
    assert most < 16400
    assert read_text_csv(spark, path).agg(F.count("*"), F.count_if(F.col("b") == "two\nlines")).first()[:] == (2000, 2000)


def test_faults_raise(spark, tmp_path):
    for name, text, match in [("open.csv", 'a,b\n1,"x\n2,y\n', "doesn't end"), ("short.csv", 'a,b\n1\n"2\n3",4\n', None)]:
        (tmp_path / name).write_text(text)
        with pytest.raises(Exception, match=match):
            read_text_csv(spark, str(tmp_path / name)).collect()
    (tmp_path / "breaks.csv").write_text('a,b\n1,"x\ny"\n')
    with pytest.raises(Exception):
        read_text_csv(spark, str(tmp_path / "breaks.csv"), multiline=False).collect()
    (tmp_path / "head.csv").write_text("a,b\n")
    assert read_text_csv(spark, str(tmp_path / "head.csv"), multiline=True).collect() == []


def test_types_are_those_of_all_values(spark):
    rows = [("1", "1", "2020-01-01", "true", None, "2020-01-01", "99999999999999999999", " 7 "),
            ("-2", "2.5e3", "2020-01-01 10:00:00", "FALSE", None, "2020-13-01", "1", "8"),
            (None, "+.5", None, "true", None, "2020-01-01", "2", None)] * 50
    names = ["whole", "real", "moment", "flag", "none", "not_a_date", "too_large", "padded"]
    df = spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names)).repartition(7)
    assert found_types(df) == {"whole": "bigint", "real": "double", "moment": "timestamp_ntz", "flag": "boolean", "none": "string",
                               "not_a_date": "string", "too_large": "double", "padded": "bigint"}
    assert found_types(df.where("false"))["whole"] == "string"
    mixed = df.selectExpr("whole", "real", "if(whole = '-2', 'x', whole) AS text_once")
    assert found_types(mixed)["text_once"] == "string"  # one row of all decides
    assert spark.range(1).select(possible_types(F.lit("2020-02-30"))).first()[0] == 0


def test_read_csv_finds_names_and_types(spark, tmp_path):
    (tmp_path / "t.csv").write_text('day,"a`b,c",n\n2020-01-01,"x\ny",1\n2020-01-02,,2\n')
    df = read_csv(spark, str(tmp_path / "t.csv"))
    assert df.dtypes == [("day", "date"), ("a`b,c", "string"), ("n", "bigint")]
    assert [(str(r[0]), r[1], r[2]) for r in df.orderBy("n").collect()] == [("2020-01-01", "x\ny", 1), ("2020-01-02", None, 2)]
