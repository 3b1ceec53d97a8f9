"""CSV loads under a declared schema, and several layouts in one scan."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from kestrel.operators.joins import join_tagged
from kestrel.plans import workloads
from kestrel.plans.script import files_named, run_script, trip_means_script
from kestrel.plans.trip import trip_means_pig
from kestrel.sources import read_lines
from kestrel.sources.csv import CORRUPT, bad_records, read_csv, write_csv
from kestrel.sources.delimited import HeaderRule
from kestrel.sources.layouts import Layout, read_layouts

LINES = ['1,"a, ""b"", c",2.5', 'x,plain,3', '3,only', '4,q,1.5,extra', '5,"",', "6,' q ,-0", '7,"open, 8']
SCHEMA = "id long, name string, x double"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def folder(spark, tmp_path):
    def make(lines, name="t"):
        path = str(tmp_path / name)
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
        return path
    return make


def _tuples(df):
    return [tuple(r) for r in df.collect()]


def test_quotes_and_bad_fields(spark, folder):
    path = folder(LINES[:6])
    good = [(1, 'a, "b", c', 2.5), (5, None, None), (6, "' q ", 0.0)]
    assert _tuples(read_csv(spark, path, SCHEMA)) == [good[0], (None, "plain", 3.0), (3, "only", None), (4, "q", 1.5), *good[1:]]
    assert _tuples(read_csv(spark, path, SCHEMA, on_error="drop")) == good
    assert _tuples(read_csv(spark, path, SCHEMA, on_error="drop").select("name")) == [(n,) for _, n, _ in good]
    with pytest.raises(Exception, match="Malformed|MALFORMED"):
        read_csv(spark, path, SCHEMA, on_error="fail").select("name").collect()
    assert _tuples(read_csv(spark, path, SCHEMA, trim=True))[-1] == (6, "' q", 0.0)


def test_bad_records_keep_their_line(spark, folder):
    df = read_csv(spark, folder(LINES[:6]), SCHEMA, corrupt=True)
    assert {r["id"]: r[CORRUPT] for r in df.collect()} == {1: None, None: LINES[1], 3: LINES[2], 4: LINES[3], 5: None, 6: None}
    assert sorted(r["value"] for r in bad_records(df).collect()) == sorted(LINES[1:4])
    with pytest.raises(ValueError, match="on_error"):
        read_csv(spark, "x", SCHEMA, on_error="drop", corrupt=True)
    with pytest.raises(ValueError, match="on_error"):
        read_csv(spark, "x", SCHEMA, on_error="skip")
    with pytest.raises(ValueError, match="bad records"):
        read_csv(spark, "x", f"{CORRUPT} string", corrupt=True)


def test_unused_columns_do_not_leave_the_scan(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    try:
        plan = _plan(workloads.q_csv_trip_pruned(spark, SF_SMALL))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "ReadSchema: struct<key:string,distance:double,amount:decimal(12,2)>" in plan


def test_written_text_is_read_back(spark, tmp_path):
    rows = [(1, 'a"b', 1.5), (2, ",", None), (3, " lead and trail ", -1.0), (4, None, 0.0), (5, "plain", 2.0), (6, '"', 7.0), (7, "é\t;|", 1e300)]
    df = spark.createDataFrame(rows, SCHEMA)
    for k, (sep, quote) in enumerate(((",", '"'), (";", "'"), ("|", '"'))):
        write_csv(df, str(tmp_path / str(k)), sep=sep, quote=quote, header=k == 1)
        assert sorted(_tuples(read_csv(spark, str(tmp_path / str(k)), SCHEMA, sep=sep, quote=quote, escape=quote, header=k == 1))) == rows
    lines = spark.createDataFrame([(1, "two\nlines", 1.0)], SCHEMA)
    write_csv(lines, str(tmp_path / "m"))
    assert _tuples(read_csv(spark, str(tmp_path / "m"), SCHEMA, multi_line=True)) == [(1, "two\nlines", 1.0)]


def test_empty_folder_of_lines(spark, folder):
    assert read_csv(spark, folder([]), SCHEMA).count() == 0


# layouts

PEOPLE = Layout("/people", "name string, dno bigint", sep=";", on_error="drop")
PLACES = Layout("/places", "dno bigint, name string", sep="|", header=HeaderRule("letter", 0))
BOTH = {"people": PEOPLE, "places": PLACES}


def _two(folder):
    people = folder(["ann;1", "bob;?", "cy;2", "dan", "eve;1", "fay;"], "people")
    places = folder(["key|name|region", "1|north|9", "2|south|9", "3|west|9"], "places")
    return [people, places]


def test_each_file_has_its_parser(spark, folder):
    rows = _tuples(read_layouts(spark, _two(folder), BOTH))
    assert sorted(rows) == sorted([("people", "ann", 1), ("people", "cy", 2), ("people", "eve", 1), ("places", "north", 1),
                                   ("places", "south", 2), ("places", "west", 3)])


def test_other_files_are_not_opened(spark, folder, tmp_path):
    paths = _two(folder)
    for name in ("junk", "people-old"):
        (tmp_path / name).mkdir()
        (tmp_path / name / "broken.txt.gz").write_bytes(b"no gzip at all")
    rows = read_layouts(spark, [*paths, str(tmp_path / "junk")], BOTH)
    assert rows.count() == 6
    # the broken file of a layout that isn't asked for
    some = read_layouts(spark, [*paths, str(tmp_path / "people-old")], BOTH, only=["places"])
    assert sorted(r["name"] for r in some.collect()) == ["north", "south", "west"]
    with pytest.raises(Exception, match="gzip|FAILED_READ_FILE"):
        read_layouts(spark, [*paths, str(tmp_path / "people-old")], BOTH).collect()
    assert read_layouts(spark, paths, BOTH, only=[]).count() == 0


def test_policies_and_positions(spark, folder):
    path = folder(["1,x,9", "2,y", "z,w,8"], "many")
    layout = lambda on_error: {"a": Layout("many", "k int, last int", on_error=on_error, positions={"last": -1})}
    assert _tuples(read_layouts(spark, path, layout("null"))) == [("a", 1, 9), ("a", 2, None), ("a", None, 8)]
    assert _tuples(read_layouts(spark, path, layout("drop"))) == [("a", 1, 9)]
    with pytest.raises(Exception, match="cannot parse field"):
        read_layouts(spark, path, layout("fail")).collect()


def test_wrong_layouts(spark):
    with pytest.raises(ValueError, match="several types"):
        read_layouts(spark, "x", {"a": Layout("a", "k int"), "b": Layout("b", "k string")})
    with pytest.raises(ValueError, match="no layout"):
        read_layouts(spark, "x", BOTH, only=["persons"])
    with pytest.raises(ValueError, match="column of a layout"):
        read_layouts(spark, "x", BOTH, tag="name")


def test_a_join_of_two_layouts_scans_once(spark, folder):
    joined = join_tagged(read_layouts(spark, _two(folder), BOTH), "dno", "people", "places")
    assert sorted(_tuples(joined)) == [(1, "ann north"), (1, "eve north"), (2, "cy south")]
    plan = _plan(joined)
    final = plan[:plan.index("Initial Plan")] if "Initial Plan" in plan else plan
    assert final.count("FileScan text") == 1 and final.count("ReusedExchange") == 1


# scripts

def test_the_trip_script_equals_the_dialect(spark, folder):
    head = "VendorID," + ",".join("abcdefghijklmnopqr")
    body = [",".join(["v", "a", "b", "c", d, *"efghijklmnopq", m]) for d, m in
            [("2.5", "10"), ("-2.5", "1"), ("2.4", "x"), ("", "3"), ("250", "1"), ("NaN", "7"), ("1e12", "1"), ("2.49", "2.25")]]
    path = folder([head, *body, "v,short", ",,,,1,,,,,,,,,,,,,,5"])
    expected = sorted(_tuples(trip_means_pig(read_lines(spark, path))), key=repr)
    got = trip_means_script(spark, path)
    assert sorted(_tuples(got), key=repr) == expected and len(expected) >= 3
    # the functions are inlined: the scan feeds one aggregation, and no user code is called
    assert "half_up" not in _plan(got) and "Python" not in _plan(got)


def test_script_parameters_are_values(spark, folder):
    path = folder(["a", "b"])
    odd = "'; DROP TABLE x; --"
    got = run_script(spark, "BEGIN SELECT count(*) AS n, :odd AS odd FROM IDENTIFIER(:t) WHERE value <> :odd; END", t=files_named(path), odd=odd)
    assert _tuples(got) == [(2, odd)]
    with pytest.raises(ValueError, match="no name"):
        files_named("/x`; DROP TABLE y")
