"""Committed folders, and partial states kept in them."""

import glob
import os
import shutil

import pytest
from pyspark.sql import functions as F

from kestrel.operators import bucket_mean
from kestrel.plans.committed import NotCommitted, manifest, read_committed, write_committed
from kestrel.plans.states import StateFolder, mean_states, means_of, merged


def _rows(spark, n=100):
    return spark.range(n).repartition(4).select("id", F.concat(F.lit("t"), "id").alias("t"), F.when(F.col("id") % 3 > 0, F.col("id") / 7).alias("x"))


def _same(a, b):
    return sorted(map(tuple, a.collect()), key=repr) == sorted(map(tuple, b.collect()), key=repr)


@pytest.mark.parametrize("format,options", [("parquet", {}), ("csv", {"header": "true"}), ("json", {}), ("orc", {})])
def test_round_trip(spark, tmp_path, format, options):
    df, folder = _rows(spark), str(tmp_path / "out")
    write_committed(df, folder, format, **options)
    for verify in ("files", "rows"):
        assert _same(read_committed(spark, folder, verify), df)
    files, _, rows = manifest(spark, folder)
    told = files.collect()
    assert rows == 100 == sum(r["rows"] for r in told) and {r["file"] for r in told} == {
        f for f in os.listdir(f"{folder}/parts") if f.startswith("part-")}
    assert all(r["bytes"] == os.path.getsize(f"{folder}/parts/{r['file']}") for r in told)


def test_text_and_empty(spark, tmp_path):
    lines = spark.createDataFrame([("a\tb",), ("",)], "value string")
    write_committed(lines, str(tmp_path / "t"), "text")
    assert _same(read_committed(spark, str(tmp_path / "t"), "rows"), lines)
    write_committed(_rows(spark, 0), str(tmp_path / "e"))
    assert read_committed(spark, str(tmp_path / "e"), "rows").count() == 0


def test_a_folder_that_is_there_is_refused(spark, tmp_path):
    folder = str(tmp_path / "out")
    write_committed(_rows(spark), folder)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        write_committed(_rows(spark, 5), folder)
    assert read_committed(spark, folder).count() == 100


def test_a_job_stopped_half_way_leaves_nothing_to_read(spark, tmp_path):
    folder = str(tmp_path / "out")
    bad = _rows(spark).withColumn("t", F.when(F.col("id") == 57, F.raise_error(F.lit("stopped"))).otherwise(F.col("t")))
    with pytest.raises(Exception, match="stopped"):
        write_committed(bad, folder)
    with pytest.raises(NotCommitted, match="no manifest"):
        read_committed(spark, folder)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        write_committed(_rows(spark), folder)


def test_a_job_stopped_before_its_manifest(spark, tmp_path):
    folder = str(tmp_path / "out")
    write_committed(_rows(spark), folder)
    half = str(tmp_path / "half")
    shutil.copytree(f"{folder}/parts", f"{half}/parts")
    with pytest.raises(NotCommitted, match="no manifest"):
        read_committed(spark, half)
    os.makedirs(f"{half}/manifest/_temporary/0")
    with pytest.raises(NotCommitted):
        read_committed(spark, half)


def test_differences_from_the_manifest(spark, tmp_path):
    df, folder = _rows(spark), str(tmp_path / "out")
    write_committed(df, folder, "csv")
    part = sorted(glob.glob(f"{folder}/parts/part-*"))[0]
    shutil.copy(part, f"{folder}/parts/part-99999-stray.csv")
    assert _same(read_committed(spark, folder, "rows"), df), "a file that the manifest doesn't name is left out"
    text = open(part).read()
    digit = next(k for k, c in enumerate(text) if c.isdigit())
    changed = text[:digit] + str((int(text[digit]) + 1) % 10) + text[digit + 1:]
    for crc in glob.glob(f"{folder}/parts/.*.crc"):
        os.remove(crc)
    with open(part, "w") as f:
        f.write(changed)
    assert read_committed(spark, folder).count() == 100, "sizes alone don't tell"
    with pytest.raises(NotCommitted, match="differs"):
        read_committed(spark, folder, "rows")
    with open(part, "w") as f:
        f.write(text[:-3])
    with pytest.raises(NotCommitted, match="differs"):
        read_committed(spark, folder)
    os.remove(part)
    with pytest.raises(NotCommitted, match="differs"):
        read_committed(spark, folder)
    with pytest.raises(ValueError, match="verify"):
        read_committed(spark, folder, "nothing")


# states

def _amounts(spark, n=400):
    return spark.range(n).select(((F.col("id") * 37 % 101) / 4 - 3).alias("d"),
                                 F.when(F.col("id") % 11 > 0, (F.col("id") % 13).cast("decimal(12,2)") / 4).alias("v"), "id")


def test_states_of_parts_merge_into_the_means_of_the_whole(spark, tmp_path):
    df = _amounts(spark).withColumn("v", F.col("v").cast("decimal(12,2)"))
    folder = StateFolder(spark, str(tmp_path / "states"))
    for k in range(3):
        folder.add(f"b{k}", mean_states(df.where(F.col("id") % 3 == k), "d", "v"))
    whole = bucket_mean(df, "d", "v", min_key=0, max_key=20)
    assert _same(means_of(folder.states(), 0, 20), whole)
    assert folder.merge("all") == "merge-all" and folder.batches() == ["merge-all"]
    assert _same(means_of(folder.states(), 0, 20), whole)
    folder.add("late", mean_states(df.limit(0), "d", "v"))
    assert folder.batches() == ["late", "merge-all"] and _same(means_of(folder.states(), 0, 20), whole)


def test_a_batch_counts_once(spark, tmp_path):
    df, folder = _amounts(spark), StateFolder(spark, str(tmp_path / "states"))
    states = mean_states(df, "d", "v")
    folder.add("one", states)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        folder.add("one", states)
    with pytest.raises(ValueError, match="no name"):
        folder.add("a/b", states)
    # a batch whose states did not end isn't seen
    write_committed(states, f"{folder.path}/states/two")
    shutil.rmtree(f"{folder.path}/states/two/manifest")
    assert folder.batches() == ["one"]
    assert _same(folder.states(), states)


def test_new_files_are_read_alone(spark, tmp_path):
    source, folder = tmp_path / "in", StateFolder(spark, str(tmp_path / "states"))
    seen = []
    for k in range(3):
        _amounts(spark, 50 + k).write.parquet(f"{source}/{k}")
        files = folder.new_files(f"{source}/*/*.parquet")
        names = [r["file"] for r in files.collect()]
        assert names and not set(names) & set(seen)
        folder.add(f"b{k}", mean_states(spark.read.parquet(*names), "d", "v"), files)
        seen += names
        if k == 1:
            folder.merge("m")
    assert folder.new_files(f"{source}/*/*.parquet").count() == 0
    assert _same(means_of(folder.states()), means_of(mean_states(spark.read.parquet(f"{source}/*"), "d", "v")))


def test_no_batch_and_null_keys(spark, tmp_path):
    folder = StateFolder(spark, str(tmp_path / "none"))
    assert folder.batches() == []
    with pytest.raises(ValueError, match="no batch"):
        folder.states()
    df = spark.createDataFrame([(None, 1.0), (1.0, None), (1.0, 2.5), (2.0, None)], "d double, v double")
    assert sorted(map(tuple, mean_states(df, "d", "v").collect()), key=repr) == [(1, 2.5, 1), (2, None, 0)]
    assert sorted(map(tuple, means_of(merged(mean_states(df, "d", "v"))).collect())) == [(1, 2.5), (2, None)]
