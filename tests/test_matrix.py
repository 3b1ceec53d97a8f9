import pytest
from pyspark.sql import functions as F

from kestrel.operators import (add_cells, add_matrices, block_lines, cells, coo_to_blocks,
                               pick_block, render_blocks)
from kestrel.sources import read_coo

from conftest import rows


def _cells(spark, triples):
    return cells(spark.createDataFrame(triples, "i int, j int, v double"))


def _blocks(df):
    return {(r["bi"], r["bj"]): list(r["data"]) for r in df.collect()}


def test_block_ragged(spark):
    # 3x4 matrix, 2x3 blocks: 4 blocks, edge blocks padded with zeros
    m = _cells(spark, [(i, j, float(i * 4 + j + 1)) for i in range(3) for j in range(4)])
    got = _blocks(coo_to_blocks(m, 2, 3))
    assert got == {
        (0, 0): [1.0, 2.0, 3.0, 5.0, 6.0, 7.0],
        (0, 1): [4.0, 0.0, 0.0, 8.0, 0.0, 0.0],
        (1, 0): [9.0, 10.0, 11.0, 0.0, 0.0, 0.0],
        (1, 1): [12.0, 0.0, 0.0, 0.0, 0.0, 0.0],
    }


def test_block_one_sided_outer_vs_inner(spark):
    m = _cells(spark, [(0, 0, 1.0)])
    n = _cells(spark, [(0, 1, 2.0), (3, 3, 5.0)])
    outer = _blocks(add_matrices(m, n, 2, 2, "outer"))
    inner = _blocks(add_matrices(m, n, 2, 2, "inner"))
    assert outer == {(0, 0): [1.0, 2.0, 0.0, 0.0], (1, 1): [0.0, 0.0, 0.0, 5.0]}
    assert inner == {(0, 0): [1.0, 2.0, 0.0, 0.0]}
    assert set(inner) <= set(outer)


def test_add_commutes_and_sums(spark):
    m = _cells(spark, [(i, j, float(i + j)) for i in range(5) for j in range(4)])
    n = _cells(spark, [(i, j, float(i * j)) for i in range(2, 7) for j in range(3)])
    ab, ba = _blocks(add_matrices(m, n, 3, 2)), _blocks(add_matrices(n, m, 3, 2))
    assert ab == ba
    total = sum(sum(v) for v in ab.values())
    assert total == pytest.approx(sum(i + j for i in range(5) for j in range(4))
                                  + sum(i * j for i in range(2, 7) for j in range(3)))
    long_form = add_cells(m, n, 3, 2)
    assert long_form.agg(F.sum("v")).first()[0] == pytest.approx(total)


def test_duplicates_policies(spark):
    m = _cells(spark, [(0, 0, 1.0), (0, 0, 2.0)])
    with pytest.raises(Exception):
        coo_to_blocks(m, 2, 2, duplicates="error").collect()
    assert _blocks(coo_to_blocks(m, 2, 2, duplicates="sum"))[(0, 0)][0] == 3.0
    assert _blocks(coo_to_blocks(m, 2, 2, duplicates="max"))[(0, 0)][0] == 2.0


def test_negative_index_rejected(spark):
    with pytest.raises(Exception):
        _cells(spark, [(-1, 0, 1.0)]).collect()


def test_text_layouts(spark, lines):
    m = read_coo(lines(["0,0,8.9525", "1,2,1"]))
    b = coo_to_blocks(m, 2, 3)
    assert render_blocks(b, 2, 3).first()["text"] == "\n\t8.953\t0.000\t0.000\n\t0.000\t0.000\t1.000\n"
    assert block_lines(b, 2, 3).first()["value"].startswith("0\t0\t\n\t8.953")
    assert render_blocks(b, 2, 3, " %.2f").first()["text"] == "\n 8.95 0.00 0.00\n 0.00 0.00 1.00\n"


def test_pick_block(spark):
    m = _cells(spark, [(i, j, 1.0) for i in range(4) for j in range(6)])
    s = add_matrices(m, m, 2, 2)
    assert rows(pick_block(s, 1, 2), "bi", "bj") == [(1, 2)]
    assert list(pick_block(s, 1, 2).first()["data"]) == [2.0] * 4


@pytest.mark.parametrize("shape", [(2, 3), (3, 4), (1, 1), (5, 2)])
def test_sparse_text_equals_dense_render(spark, shape):
    import random

    from kestrel.operators import add_matrices_text, coo_to_block_text
    rows_, cols_ = shape
    rnd = random.Random(rows_ * 10 + cols_)
    tri = [(rnd.randrange(0, 13), rnd.randrange(0, 11),
            rnd.choice([0.0, -0.0, 1.5, -2.25, 8.9525, -0.0004, rnd.uniform(-9, 9)])) for _ in range(40)]
    tri2 = [(rnd.randrange(0, 13), rnd.randrange(0, 11), rnd.uniform(-5, 5)) for _ in range(30)]
    m, n = _cells(spark, tri), _cells(spark, tri2)
    for how in ("outer", "inner"):
        for fmt in ("\t%.3f", " %.2f"):
            dense = {(r.bi, r.bj): r.text for r in
                     render_blocks(add_matrices(m, n, rows_, cols_, how), rows_, cols_, fmt).collect()}
            sparse = {(r.bi, r.bj): r.text for r in
                      add_matrices_text(m, n, rows_, cols_, how, fmt).collect()}
            assert dense == sparse
    dense = {(r.bi, r.bj): r.text for r in
             render_blocks(coo_to_blocks(m, rows_, cols_, "sum"), rows_, cols_).collect()}
    sparse = {(r.bi, r.bj): r.text for r in coo_to_block_text(m, rows_, cols_, duplicates="sum").collect()}
    assert dense == sparse


def test_duplicate_policies_of_a_sum(spark):
    m = spark.createDataFrame([(0, 0, 1.0), (0, 0, 4.0), (5, 5, -0.0)], "i long, j long, v double")
    n = spark.createDataFrame([(0, 0, 2.0), (9, 0, 3.0)], "i long, j long, v double")

    def cell(how, duplicates):
        return {(r["i"], r["j"]): r["v"] for r in add_cells(m, n, 4, 4, how, duplicates).collect()}

    assert cell("outer", "sum") == {(0, 0): 7.0, (5, 5): 0.0, (9, 0): 3.0}
    assert cell("outer", "max") == {(0, 0): 6.0, (5, 5): 0.0, (9, 0): 3.0}
    assert cell("inner", "max") == {(0, 0): 6.0}
    with pytest.raises(Exception, match="duplicate cell 0,0"):
        cell("outer", "error")
    with pytest.raises(ValueError):
        cell("outer", "last")


@pytest.mark.parametrize("duplicates", ["error", "max", "sum"])
def test_repeats_of_a_cell_are_combined_before_they_move(spark, duplicates):
    from kestrel.operators import add_matrices
    m = spark.range(50).selectExpr("id AS i", "id % 7 AS j", "1.0D AS v")
    plan = add_matrices(m, m, 4, 4, "inner", duplicates)._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.rindex("Exchange"):]
    assert "partial_max" in below and "hashpartitioning(i#" in below and "collect_list" not in below


def test_block_ranges_reach_the_scan(spark):
    from conftest import SF_SMALL
    from kestrel.plans import workloads
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    try:
        plan = workloads.q_block_pick(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(l_partkey,300)" in plan and "LessThanOrEqual(l_suppkey,119)" in plan


def test_blocks_too_large_for_a_row(spark):
    from kestrel.operators import coo_to_blocks
    with pytest.raises(ValueError, match="cells"):
        coo_to_blocks(spark.range(1).selectExpr("id AS i", "id AS j", "1.0D AS v"), 100_000, 100_000)


def test_tuple_text(spark):
    from kestrel.operators import coo_to_block_text, tuple_block_text
    m = spark.createDataFrame([(1, 0, 2.0)], "i long, j long, v double")
    text = tuple_block_text(coo_to_block_text(m, 2, 2, " %.2f")).first()[0]
    assert text == "((0,0),\n 0.00 0.00\n 2.00 0.00\n)"


def _line_items(spark, folder, rows_):
    spark.createDataFrame(rows_, "l_partkey long, l_suppkey long, l_quantity double, l_linestatus string").write.parquet(
        f"{folder}/lineitem.parquet")
    return str(folder)


@pytest.mark.parametrize("shape", [(1, 1), (3, 63), (2, 64), (13, 65), (40, 41)])
def test_dense_runs_of_zeros_of_any_length(spark, shape):
    import random
    rnd = random.Random(shape[1])
    want = {(rnd.randrange(3 * shape[0]), rnd.randrange(3 * shape[1])): rnd.choice([1.5, -2.0, 0.0]) for _ in range(25)}
    want |= {(0, 0): 4.0, (3 * shape[0] - 1, 3 * shape[1] - 1): 5.0}
    got = _blocks(coo_to_blocks(_cells(spark, [(*at, v) for at, v in want.items()]), *shape))
    assert set(got) == {(i // shape[0], j // shape[1]) for i, j in want}
    for (bi, bj), data in got.items():
        assert data == [want.get((bi * shape[0] + r, bj * shape[1] + c), 0.0) for r in range(shape[0]) for c in range(shape[1])]


def test_dense_arrays_are_built_once_and_read_without_lambdas(spark, tmp_path):
    from kestrel.plans import workloads
    folder = _line_items(spark, tmp_path, [(5, 7, 2.0, "O"), (5, 7, 3.0, "F"), (299, 39, -1.0, "F"), (301, 7, 0.0, "O")])
    cells_, sums = workloads.q_blocks_dense_cells(spark, folder), workloads.q_block_add_dense(spark, folder)
    assert sorted(map(tuple, cells_.collect())) == [(0, 0, 207, 3.0), (0, 0, 11999, -1.0)]
    assert rows(sums) == [(0, 0, 12000, 2, 4.0), (1, 0, 12000, 0, 0.0)]
    plans = [df._jdf.queryExecution().optimizedPlan().toString() for df in (cells_, sums)]
    assert all(plan.count("zip_with(") == 1 for plan in plans)  # a filter on the size of the arrays built them again
    assert "filter(data" not in plans[1] and "aggregate(data" not in plans[1]


def test_dense_arrays_come_from_sparse_vectors_and_from_runs_alike(spark, monkeypatch):
    import random
    import struct

    from kestrel.operators import matrix
    odd = [float("inf"), float("-inf"), float("nan"), -0.0, 5e-324, 1.7976931348623157e308, 0.1 + 0.2, 1 / 3, 1e-300 / 7]
    rnd = random.Random(4)
    want = {(i // 9, i % 9): v for i, v in enumerate(odd + [rnd.uniform(-1e9, 1e9) for _ in range(50)])}
    c = _cells(spark, [(*at, v) for at, v in want.items() if at != (2, 2)])

    def bits(blocks_):
        return {at: [None if v is None else "nan" if v != v else struct.pack("d", v) for v in data]
                for at, data in _blocks(blocks_).items()}

    by_vectors = bits(coo_to_blocks(c, 4, 5, "max"))
    assert by_vectors[0, 0][:5] == [struct.pack("d", odd[0]), struct.pack("d", odd[1]), "nan", *(struct.pack("d", v) for v in odd[3:5])]
    assert by_vectors[0, 0][12] == struct.pack("d", 0.0)  # no cell there
    monkeypatch.setattr(matrix, "VECTOR_CELLS", 3)
    assert bits(coo_to_blocks(c, 4, 5, "max")) == by_vectors
    monkeypatch.undo()
    # each cell was copied with its run of zeros, place by place
    plan = coo_to_blocks(c, 4, 5, "max")._jdf.queryExecution().optimizedPlan().toString()
    assert "VectorUDT" in plan


def test_null_cells_stay_null_in_dense_arrays(spark):
    c = _cells(spark, [(0, 1, None), (1, 2, 3.0), (2, 0, 4.0), (4, 4, None)])
    assert _blocks(coo_to_blocks(c, 2, 3)) == {
        (0, 0): [0.0, None, 0.0, 0.0, 0.0, 3.0], (1, 0): [4.0, 0.0, 0.0, 0.0, 0.0, 0.0], (2, 1): [0.0, None, 0.0, 0.0, 0.0, 0.0]}
