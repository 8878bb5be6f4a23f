import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tillcast.llm import entry, hard_negatives
from tools.check import differences

SCHEMA = "vec_id long, embedding array<float>, label int, anchor_id string, part int"


def brute(rows, k=5):
    """The query's rows from (vec_id, ints, label) by sorting every anchor's pairs."""
    out = []
    for anchor, q, label in rows:
        if anchor % 100:
            continue
        scored = [(-sum(a * b for a, b in zip(q, x)), i, own == label) for i, x, own in rows if i != anchor and len(x) == len(q)]
        scored.sort()
        for p, positive, _ in [s for s in scored if s[2]][:k]:
            inside = [(n, i) for n, i, own in scored if not own and 80 * -p <= 100 * -n <= 100 * -p]
            out += [(anchor, positive, r, i, -p, -n) for r, (n, i) in enumerate(inside[:k], 1)]
    return sorted(out)


def mined(table):
    rows = hard_negatives.quantized(table, F.col("label"), 256)
    return sorted(map(tuple, hard_negatives.mine(rows, F.col("vec_id") % 100 == 0).collect()))


def ints(rows):
    return [(i, [int(np.floor(256 * float(np.float32(x)))) for x in v], label) for i, v, label in rows]


def made(spark, rows):
    return spark.createDataFrame([(i, v, label, "x", 1) for i, v, label in rows], SCHEMA)


def test_query_matches_other_engine(spark, folder):
    db = duckdb.connect()
    db.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{folder}/embeddings.parquet'")
    got = entry.QUERIES["op12_hard_negatives"](spark, folder).toPandas()
    assert len(got) and differences(got, db.sql(entry.ORACLES["op12_hard_negatives"]).df()) == ""


@pytest.mark.parametrize("rows_of_a_part", [16_384, 90])
def test_ties_against_brute_force(spark, monkeypatch, rows_of_a_part):
    """Few distinct vectors, a third of all rows alike: most scores are ties."""
    monkeypatch.setattr(hard_negatives, "ROWS", rows_of_a_part)
    rng = np.random.default_rng(2)
    vectors = (rng.integers(-2, 5, (12, 6)) / 4).tolist()
    rows = [(i, vectors[0 if i % 3 else int(rng.integers(12))], int(rng.integers(3))) for i in range(700)]
    assert mined(made(spark, rows).repartition(3)) == brute(ints(rows))


def test_negative_scores_lengths_and_lone_labels(spark):
    rng = np.random.default_rng(4)
    rows = [(i, (rng.standard_normal(5) - 0.6).tolist(), int(rng.integers(2))) for i in range(-200, 101)]
    rows += [(1000 + i, rng.standard_normal(3).tolist(), 1) for i in range(0, 300, 25)]
    rows += [(5000, [1.0, 1.0, 1.0], 9), (6000, [], 3), (6001, [], 3), (6002, [], 4), (7000, [-1.0] * 5, 1)]
    expected = brute(ints(rows))
    assert mined(made(spark, rows)) == expected
    assert (6000, 6001, 1, 6002, 0, 0) in expected and not any(r[0] == 5000 for r in expected)


def test_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    good = [(0, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [0.9, 0.0], 2), (3, [0.9, 5.0], 2), (4, [1.0, 1.0], 2)]
    bad = [(5, None, 2), (6, [nan, 0.0], 2), (7, [inf, 0.0], 2), (8, [0.95, None], 2), (9, [0.95, 0.0], None), (None, [0.95, 0.0], 2)]
    again = [(2, [0.9, 0.0], 3), (1, [1.0, 0.0], 1)]
    assert mined(made(spark, good + bad + again)) == brute(ints(good)) != []
    assert mined(made(spark, [])) == mined(made(spark, bad)) == []


def test_large_components_stay_exact(spark):
    rows = [(0, [1e6, 1e6], 1), (1, [1e6, 1e6], 1), (2, [1e6, 999_999.9375], 2), (3, [1e6, 900_000.0], 2)]
    table = spark.createDataFrame([(i, v, label, "x", 1) for i, v, label in rows], SCHEMA.replace("float", "double"))
    expected = brute([(i, [int(256 * x) for x in v], label) for i, v, label in rows])
    assert mined(table) == expected and expected[0][4] == 2 * 256_000_000**2
    with pytest.raises(Exception, match="64 bits"):
        mined(made(spark, [(0, [1e30], 1), (1, [1e30], 1)]))


def test_stream_holds_open_windows_only():
    pair = type("Pair", (), {})

    def key(anchor, positive, score, number):
        row = pair()
        row.anchor_id, row.positive, row.score, row.vec_id = anchor, positive, score, number
        return hard_negatives._key(row)

    keys = [key(-1, True, 10, 4), key(-1, False, 10, 2), key(-1, False, 8, 1), key(-1, False, 7, 3), key(-1, True, 9, 8)]
    keys += [key(5, False, 9, 1)]
    got = list(hard_negatives.stream(sorted(keys), 5, (80, 100)))
    assert got == [(-1, 4, 1, 2, 10, 10), (-1, 4, 2, 1, 10, 8), (-1, 8, 1, 1, 9, 8)]
