import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tillcast.llm import entry, one_bit
from tools.check import differences


def brute(ids, x, query, k=10):
    out = {}
    for i in query:
        others = ids != ids[i]
        distance = np.sqrt(((x[others] - x[i]) ** 2).sum(axis=1))
        order = np.lexsort((ids[others], distance))[:k]
        out[int(ids[i])] = list(zip(ids[others][order].tolist(), distance[order].tolist()))
    return out


def lists(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    return out


def test_query_recall(spark, folder):
    rows = duckdb.sql(f"SELECT vec_id, embedding FROM '{folder}/embeddings.parquet'").fetchall()
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float)
    expected = brute(ids, x, np.flatnonzero(ids % 100 == 0))
    got = lists(entry.QUERIES["op8_one_bit_codes"](spark, folder).collect())
    assert got.keys() == expected.keys()
    hits = sum(len({v for v, _ in got[q]} & {v for v, _ in expected[q]}) for q in expected)
    assert hits / sum(map(len, expected.values())) >= 0.9
    assert all(dict(expected[q]).get(v, s) == pytest.approx(s) for q in got for v, s in got[q])


def test_query_matches_other_engine(spark, folder):
    db = duckdb.connect()
    db.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{folder}/embeddings.parquet'")
    got = entry.QUERIES["op8_one_bit_codes"](spark, folder).toPandas()
    assert differences(got, db.sql(entry.ORACLES["op8_one_bit_codes"]).df()) == ""


def test_recall_on_random_vectors(spark, monkeypatch):
    monkeypatch.setattr(one_bit, "ROWS", 700)
    monkeypatch.setattr(one_bit, "QUERIES", 3)
    x = np.random.default_rng(4).standard_normal((3000, 48)).astype(np.float32)
    ids = np.arange(3000)
    table = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x)], "vec_id long, embedding array<float>")
    rows = one_bit.vectors(table.repartition(3))
    got = lists(one_bit.search(one_bit.build(rows), rows.where(F.col("vec_id") % 50 == 0)).collect())
    expected = brute(ids, x.astype(float), np.flatnonzero(ids % 50 == 0))
    hits = sum(len({v for v, _ in got[q]} & {v for v, _ in expected[q]}) for q in expected)
    assert hits >= 0.98 * 600


def test_codes_bound_the_inner_product():
    rng = np.random.default_rng(1)
    x, q = rng.standard_normal((2000, 64)), rng.standard_normal(64)
    turn = one_bit.rotation(64)
    assert np.allclose(turn @ turn.T, np.eye(64))
    part = one_bit.Part(np.arange(2000), *one_bit.encode(x, np.zeros(64), turn), x)
    units, far = one_bit._rotated(q[None, :], np.zeros(64), turn)
    guess, deviation = part.estimates(units[0], far[0])
    error = (guess - ((x - q) ** 2).sum(axis=1)) / deviation
    assert abs(error.mean()) < 0.1 and 0.8 < error.std() < 1.1 and (error < one_bit.CERTAINTY).mean() > 0.97


@pytest.mark.parametrize("dimension", [3, 64, 100])
def test_packed_arithmetic_is_that_of_signs(dimension):
    rng = np.random.default_rng(dimension)
    x, q = rng.standard_normal((300, dimension)), rng.standard_normal((1, dimension))
    centre, turn = x.mean(axis=0), one_bit.rotation(dimension)
    part = one_bit.Part(np.arange(300), *one_bit.encode(x, centre, turn), x)
    units, far = one_bit._rotated(q, centre, turn)
    signs = np.where((x - centre) @ turn.T >= 0, 1.0, -1.0) / np.sqrt(dimension)
    step = (units.max() - units.min()) / (2**one_bit.PLANES - 1)
    rounded = np.rint((units[0] - units.min()) / step) * step + units.min()
    plain = part.norm**2 + far[0] ** 2 - 2 * part.norm * far[0] * (signs @ rounded) / part.dot
    assert np.allclose(part.estimates(units[0], far[0])[0], plain)


def test_most_rows_are_never_compared():
    """16,000 rows around 2,000 vectors: share of rows compared exactly, and recall."""
    rng = np.random.default_rng(9)
    base = rng.standard_normal((2000, 64))
    base /= np.linalg.norm(base, axis=1)[:, None]
    x = base[rng.integers(0, len(base), 16_000)] + 0.1 * rng.standard_normal((16_000, base.shape[1]))
    centre, turn, ids = x.mean(axis=0), one_bit.rotation(base.shape[1]), np.arange(16_000)
    part = one_bit.Part(ids, *one_bit.encode(x, centre, turn), x)
    units, far = one_bit._rotated(x[::400], centre, turn)
    compared, hits = 0, 0
    for unit, distance, i in zip(units, far, ids[::400]):
        _, first = part.nearest(part.survivors(i, unit, distance, 10, None), x[i], 10)
        places = part.survivors(i, unit, distance, 10, first[-1])
        compared += len(places)
        expected = brute(ids, x, [i])[int(i)]
        hits += len({v for v, _ in expected} & set(part.nearest(places, x[i], 10)[0].tolist()))
    assert compared / 40 / 16_000 < 0.3 and hits / 400 >= 0.99


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, None), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [nan, 1.0]),
            (6, [1.0, inf]), (7, [1.0, 2.0, 3.0]), (8, [0.0, 1.0]), (100, [3.0, 0.0]), (None, [1.0, 1.0]), (200, None)]
    table = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, shard string")
    vectors = one_bit.vectors(table)
    got = lists(one_bit.search(one_bit.build(vectors), vectors.where(F.col("vec_id") % 100 == 0)).collect())
    assert [v for v, _ in got[0]] == [1, 1, 8, 100] and [v for v, _ in got[100]] == [0, 1, 1, 8]
    assert got[0][3][1] == 2.0 and 200 not in got
    none = one_bit.vectors(table.limit(0))
    assert one_bit.search(one_bit.build(none), none).count() == 0


def test_ties_go_to_the_smaller_id(spark):
    table = spark.createDataFrame([(i, [float(i % 3 == 0), 1.0]) for i in range(40)], "vec_id long, embedding array<double>")
    rows = one_bit.vectors(table)
    got = lists(one_bit.search(one_bit.build(rows), rows.where("vec_id = 0"), k=5).collect())
    assert [v for v, _ in got[0]] == [3, 6, 9, 12, 15]
