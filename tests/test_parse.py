import pytest

from kestrel.sources import HeaderRule, adjacency_rows, parse_delimited, read_coo

from conftest import rows

SCHEMA = "k int, v double"


def test_policy_fail(spark, lines):
    df = parse_delimited(lines(["1,2.5", "x,2.5", "2"]), SCHEMA, on_error="fail")
    with pytest.raises(Exception) as err:
        df.collect()
    assert "x,2.5" in str(err.value) or "2" in str(err.value)


def test_policy_drop(spark, lines):
    df = parse_delimited(lines(["1,2.5", "x,2.5", "2"]), SCHEMA, on_error="drop")
    assert rows(df) == [(1, 2.5)]


def test_policy_null(spark, lines):
    df = parse_delimited(lines(["1,2.5", "x,2.5", "2"]), SCHEMA, on_error="null")
    assert sorted(df.collect(), key=str) == sorted(
        [(1, 2.5), (None, 2.5), (2, None)], key=str)


def test_drop_bad_but_fail_short(spark, lines):
    ok = parse_delimited(lines(["1,2.5", "x,2.5"]), SCHEMA, on_error="drop", on_short="fail")
    assert rows(ok) == [(1, 2.5)]
    bad = parse_delimited(lines(["1,2.5", "2"]), SCHEMA, on_error="drop", on_short="fail")
    with pytest.raises(Exception):
        bad.collect()


def test_header_rules(spark, lines):
    data = ["VendorID,a,b,c,trip_distance,amount", "1,x,y,z,2.5,10.0", "2,x,y,z,0.4,5.0"]
    schema = "d double, amount double"
    pos = {"d": 4, "amount": -1}
    for rule in (HeaderRule("alphabetic", 0), HeaderRule("letter", 4),
                 HeaderRule("regex", 0, ".*VendorID.*")):
        df = parse_delimited(lines(data), schema, header=rule, positions=pos, on_error="fail")
        assert rows(df) == [(0.4, 5.0), (2.5, 10.0)], rule


def test_regex_rule_is_full_match(spark, lines):
    df = parse_delimited(lines(["xVendorIDx,1", "1,2"]), "a string, b int",
                         header=HeaderRule("regex", 0, "VendorID"), on_error="null")
    assert len(df.collect()) == 2  # "VendorID" does not match the whole field


def test_java_split_trailing_empties(spark, lines):
    # String.split drops trailing empty fields, so "last" is the last non-empty one
    df = parse_delimited(lines(["1,2.5,,"]), "k int, v double", positions={"v": -1},
                         java_split=True, on_error="fail")
    assert rows(df) == [(1, 2.5)]
    kept = parse_delimited(lines(["1,2.5,,"]), "k int, v double", positions={"v": -1},
                           on_error="null")
    assert rows(kept, "k") == [(1,)] and kept.first()["v"] is None


def test_trim_and_separators(spark, lines):
    df = parse_delimited(lines([" 1 | 2.0 "]), SCHEMA, sep="|", trim=True)
    assert rows(df) == [(1, 2.0)]


def test_read_coo(spark, lines):
    df = read_coo(lines(["0, 1, 2.5", "3,4,1"]))
    assert rows(df) == [(0, 1, 2.5), (3, 4, 1.0)]
    with pytest.raises(Exception):
        read_coo(lines(["0,1"])).collect()


def test_adjacency_rows(spark, lines):
    df = adjacency_rows(lines(["3,2,1", "5", "7,6,"]))
    got = sorted((r["id"], list(r["adj"])) for r in df.collect())
    assert got == [(3, [2, 1]), (5, []), (7, [6])]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_a_bad_id_fails_whatever_the_ansi_setting(spark, lines, ansi):
    from kestrel.sources import read_adjacency
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        for text in ("x,2", "1,y", "1,,2"):
            with pytest.raises(Exception, match="cannot parse id"):
                read_adjacency(lines([text])).pairs.collect()
        assert read_adjacency(lines(["1,", "2,3"])).pairs.count() == 2
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_regex_header_drops_an_empty_first_field(spark, lines):
    from kestrel.sources import HeaderRule
    text = ["id,v", ",1", "a,2"]
    for on_null, want in ((None, [("a", 2)]), ("drop", [("a", 2)]), ("keep", [("", 1), ("a", 2)])):
        rule = HeaderRule("regex", 0, "id", on_null)
        got = parse_delimited(lines(text), "k string, v int", header=rule, on_error="null").collect()
        assert sorted(map(tuple, got)) == want
    first = parse_delimited(lines(["x", "9,y"]), "k string, v string", header=HeaderRule("letter", 1), on_error="null").collect()
    assert len(first) == 1  # a missing field is no header; "y" is


def test_only_selected_columns_are_converted(spark, lines):
    df = parse_delimited(lines(["1,2,3"]), "a int, b double, c long", on_error="null").select("b")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("cast(") == 1


def test_indices_beyond_int(spark, lines):
    from kestrel.operators import add_cells, coo_to_blocks, cells
    from kestrel.sources import read_coo
    m = read_coo(lines(["3000000001, 2, 1.5", "0,0,1"]))
    got = coo_to_blocks(cells(m), 10, 10).orderBy("bi").collect()
    assert [(r["bi"], r["bj"]) for r in got] == [(0, 0), (300000000, 0)] and got[1]["data"][12] == 1.5
    assert add_cells(m, m, 10, 10).agg({"v": "sum"}).first()[0] == 5.0
