"""Quoted CSV cut in many tasks against Spark's reader of whole files."""

import random

import pytest
from pyspark.sql import functions as F

from eventlens.sources.files import CORRUPT, csv_header, read_raw_csv


def whole(spark, path, columns, header):
    schema = ", ".join(f"`{c}` string" for c in [*columns, CORRUPT])
    reader = spark.read.option("header", header).option("multiLine", True).option("escape", '"').option("columnNameOfCorruptRecord", CORRUPT)
    return reader.schema(schema).csv(path)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("split", [150, 1 << 27])
def test_same_rows_as_whole_files(spark, scratch, split):
    rng = random.Random(split)
    word = lambda: rng.choice(["a", "", "b c", "é", "5 in", "x" * 90])

    def field():
        kind = rng.random()
        if kind < 0.4:
            return word()
        parts = [rng.choice([word(), "\n", '""', ",", "\n\n", '"",""\n'] if kind < 0.8 else [word()]) for _ in range(rng.randrange(1, 6))]
        return '"' + "".join(parts) + '"'

    for k in range(3):
        lines = [",".join(field() for _ in range(rng.choice([3, 3, 3, 3, 2, 4]))) for _ in range(40)]
        with open(f"{scratch}/f{k}.csv", "w", newline="") as f:
            f.write("\n".join(["c0,c1,c2", *[line for line in lines if line.strip(",")]]) + ("\n" if k else ""))
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        got = read_raw_csv(spark, scratch)
        assert got.columns == ["c0", "c1", "c2", CORRUPT]
        assert rows(got.drop(CORRUPT)) == rows(whole(spark, scratch, ["c0", "c1", "c2"], True).drop(CORRUPT))
        flags = lambda df: sorted(df.select(F.col(CORRUPT).isNotNull(), "c0").collect(), key=str)
        assert flags(got) == flags(whole(spark, scratch, ["c0", "c1", "c2"], True))
        bare = read_raw_csv(spark, scratch, ["a", "b", "c"], header=False)
        assert rows(bare.drop(CORRUPT)) == rows(whole(spark, scratch, ["a", "b", "c"], False).drop(CORRUPT))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_odd_files(spark, scratch):
    cases = {
        "crlf.csv": 'a,b\r\n"x\r\ny",1\r\nz,2\r\n',
        "lone_quote.csv": 'a,b\n5" wide,1\n"q ""in"" q",2\n6",3\n"two\nlines",4\n',
        "header_only.csv": "a,b\n",
        "blank.csv": "a,b\n\n1,2\n\n",
    }
    want = {"crlf.csv": ["z2"], "lone_quote.csv": ['5" wide1', 'q "in" q2', '6"3', "two\nlines4"], "header_only.csv": [], "blank.csv": ["12"]}
    spark.conf.set("spark.sql.files.maxPartitionBytes", 8)
    try:
        for name, text in cases.items():
            with open(f"{scratch}/{name}", "w", newline="") as f:
                f.write(text)
            got = [r["a"] + r["b"] for r in read_raw_csv(spark, f"{scratch}/{name}").collect()]
            assert sorted(g for g in got if not g.startswith("x")) == sorted(want[name])
        assert csv_header(spark, f"{scratch}/crlf.csv") == ["a", "b"]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
