"""Adjacency files with lines longer than a file split."""

import os
import random

import pytest
from pyspark.sql import functions as F

from kestrel.sources import read_adjacency, read_lines, read_long_adjacency


def _file(tmp_path, text, name="g.txt"):
    os.makedirs(tmp_path, exist_ok=True)
    (tmp_path / name).write_bytes(text.encode())
    return str(tmp_path)


def _edges(graph):
    return sorted((r["src"], r["dst"]) for r in graph.edges.collect())


def _vertices(graph):
    return sorted({r["id"] for r in graph.vertices.collect()})


@pytest.fixture
def splits(spark):
    """Set how many bytes a file split has."""
    names = {n: spark.conf.get(n) for n in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}

    def of(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", 1)

    yield of
    for n, v in names.items():
        spark.conf.set(n, v)


@pytest.mark.parametrize("size", [7, 64, 1000, 10**6])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_equals_the_line_reader(spark, splits, tmp_path, size, end):
    rng = random.Random(size)
    for k in range(3):
        lines = []
        for v in range(60):
            n = rng.choice([0, 0, 1, 2, 5, 200 if v % 17 == 0 else 3])
            lines.append(",".join(map(str, [v * 7 + k, *(rng.randrange(10**rng.randrange(1, 12)) for _ in range(n))])) + rng.choice(["", "", ","]))
        text = end.join(lines) + (end if k else "")
        _file(tmp_path, text, f"part-{k}.txt")
    splits(size)
    long = read_long_adjacency(spark, str(tmp_path))
    plain = read_adjacency(read_lines(spark, str(tmp_path)).select(F.rtrim(F.col("value"), F.lit("\r")).alias("value")))
    assert _edges(long) == _edges(plain)
    assert _vertices(long) == _vertices(plain)


def test_a_long_line_is_parsed_by_several_tasks(spark, splits, tmp_path):
    n = 10**6
    path = _file(tmp_path, "5,1\n-3," + ",".join(map(str, range(n))) + "\n8,9\n")
    splits(512 * 1024)
    pairs = read_long_adjacency(spark, path).edges.select("src", "dst", F.spark_partition_id().alias("task"))
    told = pairs.groupBy("src").agg(F.count("*").alias("n"), F.sum("dst").alias("s"), F.countDistinct("task").alias("tasks"),
                                    F.countDistinct("dst").alias("d")).collect()
    told = {r["src"]: tuple(r)[1:] for r in told}
    assert told[-3][:2] == (n, n * (n - 1) // 2) and told[-3][3] == n and told[-3][2] >= 8
    assert told[5][:2] == (1, 1) and told[8][:2] == (1, 9)


def test_awkward_files(spark, splits, tmp_path):
    splits(3)
    assert _edges(read_long_adjacency(spark, _file(tmp_path / "a", "1, 2 ,3\n\n\n4\n5,,6,\n"))) == [(1, 2), (1, 3), (5, 6)]
    assert _vertices(read_long_adjacency(spark, str(tmp_path / "a"))) == [1, 4, 5]
    assert _edges(read_long_adjacency(spark, _file(tmp_path / "b", ""))) == []
    assert _vertices(read_long_adjacency(spark, _file(tmp_path / "c", "7"))) == [7]
    assert _edges(read_long_adjacency(spark, _file(tmp_path / "d", "7;8;9\n1;2"), sep=";")) == [(1, 2), (7, 8), (7, 9)]


@pytest.mark.parametrize("text", ["1,2\nx,3", "1,2,y,4", "1,2\n,5"])
def test_bad_ids_fail(spark, splits, tmp_path, text):
    path = _file(tmp_path, text)
    for size in (2, 1000):
        splits(size)
        with pytest.raises(Exception, match="cannot parse id"):
            read_long_adjacency(spark, path).pairs.collect()
