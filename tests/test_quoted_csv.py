"""Quoted CSV over split borders, bad records, inferred types."""

import csv
import random

import pandas as pd
import pytest

from tabrisk.sources import quoted_csv


@pytest.fixture
def small_splits(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def test_one_file_many_tasks(spark, tmp_path, small_splits):
    rng = random.Random(4)
    cells = ["a", "b c", 'say "x"', "one\ntwo", "\n", ",", '"', "é", "x" * 300, '""\n', "line\r\nline"]
    rows = [(i, "".join(rng.choice(cells) for _ in range(rng.randrange(1, 6))) + "!") for i in range(1500)]
    rows[700] = (700, ('long "cell"\n' * 2000) + "!")  # over several splits
    with open(tmp_path / "t.csv", "w", newline="", encoding="utf-8") as f:
        w = csv.writer(f, lineterminator="\n")
        w.writerow(["id", "note"])
        w.writerows(rows)
    out = quoted_csv.read_quoted(spark, str(tmp_path / "t.csv"), "id bigint, note string")
    assert quoted_csv._lines(spark, str(tmp_path / "t.csv")).rdd.getNumPartitions() > 20
    assert sorted((r["id"], r["note"]) for r in out.collect()) == rows


def test_bad_records(spark, tmp_path):
    (tmp_path / "t.csv").write_text('id,x\r\n1,2.5\r\n\r\n2,NA\r\n3\r\n4,5,6\r\nfive,1\r\n', newline="")
    path = str(tmp_path / "t.csv")
    got = {r["bad"]: (r["id"], r["x"]) for r in quoted_csv.read_quoted(spark, path, "id bigint, x double", bad="bad").collect() if r["bad"]}
    assert set(got) == {"3", "4,5,6", "five"}
    good = quoted_csv.read_quoted(spark, path, "id bigint, x double", bad="bad").where("bad IS NULL").collect()
    assert sorted((r["id"], r["x"]) for r in good) == [(1, 2.5), (2, None)]
    with pytest.raises(Exception, match="malformed record"):
        quoted_csv.read_quoted(spark, path, "id bigint, x double").collect()


def test_types_as_pandas(spark, tmp_path):
    path = str(tmp_path / "t.csv")
    pd.DataFrame({"i": [1, -2, 3], "i_na": ["1", None, "3"], "d": [1.5, 2, 1e30], "b": [True, False, True], "b_na": ["True", None, "False"],
                  "t": ["a", "1", "2"], "none": [None, None, None], "q": ["x\ny", "1", None], "mix": ["1", "2.5", "NA"]}).to_csv(path, index=False)
    want = {"int64": "bigint", "float64": "double", "bool": "boolean"}
    pandas = [want.get(str(t), "string") for t in pd.read_csv(path).dtypes]
    assert [f.dataType.simpleString() for f in quoted_csv.infer_schema(spark, path).fields] == pandas


def test_only_a_header(spark, tmp_path):
    (tmp_path / "t.csv").write_text("id,x\n")
    assert quoted_csv.read_inferred(spark, str(tmp_path / "t.csv")).count() == 0
