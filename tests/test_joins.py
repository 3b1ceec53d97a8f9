from kestrel.operators import equi_join_pairs, union_tagged
from kestrel.sources import parse_delimited

from conftest import rows


def _emp_dept(lines):
    emp = parse_delimited(lines(["Smith,1,23 Park Ave", "Jones,2,100 Main St", "Mary,1,35 S. Center Str"]),
                          "name string, dno int, address string")
    dept = parse_delimited(lines(["CSE,1", "EE,2"]), "name string, dno int")
    return emp, dept


def test_keyed_join_golden(spark, lines):
    emp, dept = _emp_dept(lines)
    out = equi_join_pairs(emp, dept, left_key="dno", right_key="dno",
                          left_value="name", right_value="name", keep_key=True)
    assert rows(out) == [(1, "Mary CSE"), (1, "Smith CSE"), (2, "Jones EE")]


def test_unkeyed_join_golden(spark, lines):
    emp, dept = _emp_dept(lines)
    out = equi_join_pairs(emp, dept, left_key="dno", right_key="dno", left_value="name",
                          right_value="name", keep_key=False)
    assert out.columns == ["pair"]
    assert rows(out) == [("Jones EE",), ("Mary CSE",), ("Smith CSE",)]


def test_n_by_m_within_key(spark):
    left = spark.createDataFrame([(1, "a"), (1, "b")], "k int, x string")
    right = spark.createDataFrame([(1, "c"), (1, "d"), (2, "e")], "k int, y string")
    out = equi_join_pairs(left, right, left_key="k", right_key="k", left_value="x", right_value="y")
    assert len(out.collect()) == 4


def test_size_decides_how_to_join(spark, tmp_path):
    spark.range(1000).selectExpr("id % 10 AS k", "'x' AS v").write.parquet(f"{tmp_path}/large")
    spark.range(10).selectExpr("id AS k", "'y' AS w").write.parquet(f"{tmp_path}/small")
    large, small = (spark.read.parquet(f"{tmp_path}/{n}") for n in ("large", "small"))

    def plan():
        return equi_join_pairs(large, small, left_key="k", right_key="k", left_value="v",
                               right_value="w")._jdf.queryExecution().executedPlan().toString()

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in plan() and "hashpartitioning" not in plan()
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10")
        assert "SortMergeJoin" in plan()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_union_tagged(spark):
    a = spark.createDataFrame([(1, "x")], "k int, name string")
    b = spark.createDataFrame([(1,)], "k int")
    out = union_tagged([(0, a), (1, b)])
    assert sorted(rows(out), key=repr) == sorted([(1, "x", 0), (1, None, 1)], key=repr)
