"""Whole jobs from text files to text folders, on retyped fixtures."""

import os

import pytest

from kestrel.plans import jobs

from test_trip import GOOD


def _write(tmp_path, name, lines):
    path = os.path.join(str(tmp_path), name)
    with open(path, "w") as fh:
        fh.write("\n".join(lines) + "\n")
    return path


def _read_folder(spark, path):
    return [r["value"] for r in spark.read.text(path).collect()]


def test_simple_job(spark, tmp_path):
    src = _write(tmp_path, "simple.txt", ["1,2.3", "2,3.4", "1,4.5", "3,6.6", "2,3.0"])
    out = os.path.join(str(tmp_path), "out")
    jobs.simple_mean_job(spark, src, out)
    assert sorted(_read_folder(spark, out)) == ["1\t3.4", "2\t3.2", "3\t6.6"]
    with pytest.raises(Exception):          # an existing output folder is refused
        jobs.simple_mean_job(spark, src, out)


def test_join_job(spark, tmp_path):
    e = _write(tmp_path, "e.txt", ["Smith,1,23 Park Ave", "Jones,2,100 Main St", "Mary,1,35 S. Center Str"])
    d = _write(tmp_path, "d.txt", ["CSE,1", "EE,2"])
    keyed = sorted(r["value"] for r in jobs.join_job(spark, e, d).collect())
    assert keyed == ["1\tMary CSE", "1\tSmith CSE", "2\tJones EE"]
    names = sorted(r["value"] for r in jobs.join_job(spark, e, d, keyed=False).collect())
    assert names == ["Jones EE", "Mary CSE", "Smith CSE"]


def test_trip_jobs(spark, tmp_path):
    src = _write(tmp_path, "trips.csv", GOOD)
    mr = [r["value"] for r in jobs.trip_job(spark, src, dialect="mapreduce").collect()]
    assert mr[0] == "1\t4.8" and mr[1].startswith("2\t14.383333")
    sql = [r["value"] for r in jobs.trip_job(spark, src, dialect="sql").collect()]
    assert sql[0].startswith("  1\t4.800")
    pig = [r["value"] for r in jobs.trip_job(spark, src, dialect="pig").collect()]
    assert len(pig) == 3


def test_add_job(spark, tmp_path):
    m = _write(tmp_path, "m.txt", [f"{i},{j},{i + j}" for i in range(3) for j in range(4)])
    n = _write(tmp_path, "n.txt", ["0,0,1.5", "2,3,2"])
    lines = [r["value"] for r in jobs.add_job(spark, m, n, 2, 3).collect()]
    assert len(lines) == 4
    assert lines[0] == "0\t0\t\n\t1.500\t1.000\t2.000\n\t1.000\t2.000\t3.000\n"
    one = [r["value"] for r in jobs.add_job(spark, m, n, 2, 3, only_block=(1, 1),
                                             cell_fmt=" %.2f").collect()]
    assert one == ["1\t1\t\n 7.00 0.00 0.00\n 0.00 0.00 0.00\n"]


def test_graph_job(spark, tmp_path):
    from test_graph import FIXTURE
    src = _write(tmp_path, "graph.txt", FIXTURE)
    got = [r["value"] for r in jobs.graph_job(spark, src).collect()]
    assert got == ["0\t3", "1\t7"]
