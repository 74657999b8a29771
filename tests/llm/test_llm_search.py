"""Vector searches against brute force."""

import math

import numpy as np
import pyarrow as pa
import pytest
from llm_cases import VECTORS, vectors

from daybook.llm import ann, mtree, neighbours


def parties(rows, length, zero):
    found = {}
    for i, v, _ in rows:
        if i is not None and v and len(v) == length and all(x is not None and math.isfinite(x) for x in v) and (zero or any(v)):
            found[i] = np.array(v, dtype=np.float32).astype(np.float64)
    return found


def brute(found, score, k=5):
    out = {}
    for q in (i for i in found if i % 50 == 0):
        order = sorted(((-score(found[q], v), i) for i, v in found.items() if i != q))[:k]
        out[q] = [(i, -s) for s, i in order]
    return out


def by_query(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def product(q, v):
    return int(np.floor(256 * q).astype(np.int64) @ np.floor(256 * v).astype(np.int64))


@pytest.fixture(params=["one cell", "many cells"])
def cell_size(request, monkeypatch):
    if request.param == "many cells":
        for module in (ann, mtree, neighbours):
            monkeypatch.setattr(module, "PART_ROWS", 60)
        monkeypatch.setattr(neighbours, "SLICE_ROWS", 3)
        monkeypatch.setattr(neighbours, "ROUNDS", (1, 3, neighbours.MOST_CELLS))


def test_highest_products_are_exact(spark, cell_size):
    df, rows = vectors(spark)
    assert by_query(mtree.highest_products(df).collect()) == brute(parties(rows, 16, True), product)


def test_nearest_neighbours_reach_their_recall(spark, cell_size):
    df, rows = vectors(spark)
    got = by_query(ann.nearest_neighbours(df).collect())
    found = parties(rows, 16, False)
    want = brute(found, lambda q, v: float(ann.cosines(v[None], q)[0]))
    assert set(got) == set(want)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))
    for q, near in got.items():
        assert len(near) == 5 and q not in [i for i, _ in near]
        assert near == sorted(near, key=lambda x: (-x[1], x[0]))
        for i, score in near:
            assert score == pytest.approx(found[q] @ found[i] / np.linalg.norm(found[q]) / np.linalg.norm(found[i]), abs=1e-12)
    # Equal vectors rank by id, the query itself left out.
    assert [i for i, _ in got[1000]] == [7, 1001, 1002, 1003, 1004]
    assert [i for i, _ in got[50]][:3] == [1100, 1101, 1102]


def test_recall_on_the_given_vectors(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    table = df.toArrow()
    v = np.stack(table["embedding"].to_pylist()).astype(np.float64)
    ids = np.asarray(table["vec_id"])
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    hits = total = 0
    for q, near in by_query(ann.nearest_neighbours(df).collect()).items():
        at = int(np.flatnonzero(ids == q)[0])
        score = v @ v[at]
        score[at] = -2
        hits += len({i for i, _ in near} & set(ids[np.argsort(-score)[:5]].tolist()))
        total += 5
    assert total == 5 * sum(ids % 50 == 0) and hits >= 0.95 * total


def test_few_or_no_candidates(spark):
    few = spark.createDataFrame([(0, [1.0, 0.0], 0), (50, [2.0, 0.0], 0), (3, [0.0, 1.0], 0)], VECTORS)
    for search in (ann.nearest_neighbours, mtree.highest_products):
        assert [[i for i, _ in near] for near in by_query(search(few).collect()).values()] == [[50, 3], [0, 3]]
        assert search(few.filter("vec_id = 0")).collect() == []
        assert search(few.filter("false")).collect() == []


def test_extra_columns_do_not_matter(spark):
    df, _ = vectors(spark, 60)
    more = df.selectExpr("*", "1 as id", "2 as v", "'x' as class", "3 as cell", "4 as query", "5 as score")
    for search in (ann.nearest_neighbours, mtree.highest_products):
        assert sorted(search(more).collect()) == sorted(search(df).collect())


def test_chi_square_quantile():
    assert ann.quantile(0.95, 8) == pytest.approx(15.507, abs=1e-3)
    assert ann.quantile(0.95, 2) == pytest.approx(5.991, abs=1e-3)


def test_tree_search_is_exact_for_any_vectors():
    draw = np.random.default_rng(0)
    for kind in range(4):
        v = draw.integers(-300, 300, size=(900, 5)) if kind else np.zeros((900, 5), dtype=np.int64)
        v = np.repeat(v[:30], 30, axis=0) if kind == 2 else v * (10**6 if kind == 3 else 1)
        tree = mtree.MTree(v)
        for q in v[::90]:
            scores = v @ q
            want = sorted(((-s, i) for i, s in enumerate(scores.tolist())))[:6]
            assert tree.highest(q, 6, None) == [(-s, i) for s, i in want]
            assert tree.highest(q, 6, -want[-1][0]) == [(-s, i) for s, i in want]


def test_a_part_is_copied_as_its_own_cell_is_asked(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "SLICE_ROWS", 10)
    monkeypatch.setattr(neighbours, "PART_ROWS", 100)
    celled = spark.range(1100).selectExpr("cast(id % 11 as int) as cell", "id as class")
    held, parts = neighbours.parted(celled)
    asks = spark.range(1000, 1040).selectExpr("0 as cell", "id as query")
    asks = asks.union(spark.sql("select 1, 2000L"))

    def sizes(key, asked, stored):
        return pa.table({"cell": [key[0].as_py()], "asks": [len(asked)], "rows": [len(stored)]})

    got = neighbours.searched(held, parts, asks, sizes, "cell long, asks long, rows long").toPandas()
    # The hot cell's rows go to its four slices, the other's to its one, those of nine idle cells nowhere.
    assert got.groupby("cell")["rows"].sum().to_dict() == {0: 400, 1: 100}
    assert got.groupby("cell")["asks"].sum().to_dict() == {0: 40, 1: 1}


def test_points_go_down_to_the_cell_whose_path_holds_them():
    points = np.random.default_rng(4).normal(size=(3000, ann.DIMENSIONS))
    points[:500] = points[0]
    paths = [path for _, path in ann.split(points, np.arange(3000), 100)]
    for point, cell in zip(points, ann.cell_of(points, paths), strict=True):
        inside = [i for i, path in enumerate(paths) if all((point[d] >= value) == above for d, value, above in path)]
        assert inside == [cell]


def test_a_component_beyond_64_bit_scores_is_an_error(spark):
    most = math.floor(math.sqrt(2**63 / 2) / 256) - 2
    fits = spark.createDataFrame([(0, [float(most), 0.0], 0), (1, [float(most), -1.0], 0)], "vec_id long, embedding array<double>, label int")
    assert [r.score for r in mtree.highest_products(fits).collect()] == [(256 * most) ** 2]
    huge = spark.createDataFrame([(0, [1e18, 0.0], 0), (1, [1.0, 1.0], 0)], "vec_id long, embedding array<double>, label int")
    with pytest.raises(Exception, match="too large for scores"):
        mtree.highest_products(huge).collect()
