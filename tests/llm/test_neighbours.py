import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from sportlake.llm import neighbours
from sportlake.llm.oracles import NEIGHBOURS
from sportlake.llm.queries import op13_neighbours

SCHEMA = "vec_id long, embedding array<float>, label int, vector string, score string, ids string"


def brute(rows, k=10, every=100):
    """All distances of all pairs."""
    rows = {(i, tuple(e)) for i, e in rows if i is not None and e and None not in e}
    rows = sorted((i, e) for i, e in rows if np.isfinite(e).all() and any(e))
    found = []
    for q, e in rows:
        if q % every:
            continue
        own = np.array(e, np.float64)
        near = sorted((float(np.sqrt(((own - np.array(v)) ** 2).sum())), i) for i, v in rows if i != q and len(v) == len(e))
        found += [(q, n + 1, i, d) for n, (d, i) in enumerate(near[:k])]
    return sorted(found)


def same(found, wanted):
    found = sorted(map(tuple, found))
    assert [r[:3] for r in found] == [r[:3] for r in wanted]
    assert np.allclose([r[3] for r in found], [r[3] for r in wanted], rtol=1e-12, atol=0)


def floats(x):
    return [float(v) for v in np.float32(x)]


@pytest.mark.parametrize("size", [1, 7, 64, 1100])
def test_tile_equals_brute_force(size):
    draw = np.random.default_rng(size)
    points = draw.normal(size=(900, size)) * np.exp(draw.normal(size=(900, 1)) * 3)
    points[300:500] = points[7] + draw.normal(size=(200, size)) * 1e-9  # closer than rounding tells
    points[500:520] = points[3]
    points[520] = 1e-320
    ids = [[5 * i, 5 * i + 1] if i % 3 else [5 * i] for i in range(900)]
    found = neighbours.tile(points[:40], points, ids, 6)
    for query, entries in zip(points[:40], found, strict=True):
        distances = neighbours.distances(query[None], points)
        assert entries == sorted((d, i) for d, own in zip(distances, ids, strict=True) for i in own)[:6]


def test_bounds_hold_and_drop_pairs():
    draw = np.random.default_rng(0)
    points = draw.normal(size=(1500, 64))
    rounded = neighbours.Rounded(points)
    low, high = neighbours.bounds(rounded.part(0, 50), rounded.part(0, 1500))
    real = np.array([neighbours.distances(p[None], points) for p in points[:50]])
    assert (low <= real).all() and (real <= high).all()
    least = np.partition(high, 10, axis=1)[:, 10:11]
    assert (low <= least).mean() < 0.05


def test_blocks_give_the_same(spark, monkeypatch):
    draw = np.random.default_rng(4)
    rows = [(i, floats(draw.normal(size=8))) for i in range(700)]
    table = spark.createDataFrame([(*r, 1, "v", "s", "i") for r in rows], SCHEMA)
    for name, value in (("CANDIDATES", 3000), ("QUERIES", 700), ("WIDE", 37), ("HIGH", 5), ("RECOMPUTED", 64)):
        monkeypatch.setattr(neighbours, name, value)
    same(neighbours.nearest(table, F.col("vec_id") % 10 == 0, k=3).collect(), brute(rows, 3, 10))


def test_odd_rows_and_ties(spark, tmp_path):
    draw = np.random.default_rng(5)
    rows = [(i, floats(draw.normal(size=5))) for i in range(60)]
    rows += [(100 + i, floats([1, 2, 3, 4, 5])) for i in range(130)]  # many copies, two of them queries
    rows += [(300, floats([1, 2, 3, 4, 5]))] * 2 + [(400, [0.0, -0.0, 0.0, 0.0, 1.0]), (401, [0.0, 0.0, 0.0, 0.0, 1.0])]
    rows += [(500, None), (600, []), (700, [0.0] * 5), (800, [1.0, None, 1.0, 1.0, 1.0]), (900, [float("nan")] * 5)]
    rows += [(1000, [float("inf")] * 5), (1100, [1.0, 2.0]), (1101, [2.0, 2.0]), (1200, [1.0]), (None, floats([1, 2, 3, 4, 5]))]
    rows += [(1300, floats([1, 2, 3, 4, 5])), (1300, floats([5, 2, 3, 4, 5])), (-100, floats([1, 2, 3, 4, 6]))]
    table = spark.createDataFrame([(*r, None, "v", "s", "i") for r in rows], SCHEMA)
    found = neighbours.nearest(table, F.col("vec_id") % 100 == 0)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    same(found.collect(), brute(rows))
    assert neighbours.nearest(table.limit(0), F.col("vec_id") % 100 == 0).count() == 0
    doubles = table.withColumn("embedding", F.col("embedding").cast("array<double>"))
    same(neighbours.nearest(doubles, F.col("vec_id") % 100 == 0).collect(), brute(rows))


def test_query_equals_brute_force(spark, sf_dir):
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf_dir}/embeddings.parquet'")
    rows = connection.sql("SELECT vec_id, embedding FROM embeddings").fetchall()
    found = op13_neighbours(spark, sf_dir).collect()
    same(found, brute(rows))
    assert sorted(map(tuple, found)) == sorted(connection.sql(NEIGHBOURS).fetchall())
