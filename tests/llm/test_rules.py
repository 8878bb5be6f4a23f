import duckdb
import pytest

from tillcast.llm import entry, host_rules
from tillcast.llm.host_rules import Rules, beta_prior
from tools.check import differences


def test_query_matches_other_engine(spark, folder):
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    got = entry.QUERIES["op5_host_rules"](spark, folder).toPandas()
    assert differences(got, db.sql(entry.ORACLES["op5_host_rules"]).df()) == ""


def brute_repeats(text):
    words = [w for w in text.replace("\n", " ").split(" ") if w]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    covered = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(i, i + 8)}
    return len(covered)


@pytest.mark.parametrize(
    "text",
    ["a b c d e f g h", "a b c d e f g h " * 2, "x " * 30, "a b c d e f g h i a b c d e f g h j",
     "1 2 3 4 5 6 7 8 9 10 11 12 1 2 3 4 5 6 7 8 9 10 11 12 13 5 6 7 8 9 10 11 12", "q\nr s t u v w x\ny q r s t u v w x y"],
)
def test_repeated_words(made, text):
    row = host_rules.judge(made([(1, text)]).selectExpr("doc_id", "text", "'h' source")).first()
    assert row["n_repeat_words"] == brute_repeats(text)


def rows_of(host, good, bad):
    clean = " ".join(f"word{i}" for i in range(30))
    soft = clean.replace(" ", "### ")  # fails a host rule, not the base rule
    return [(host, clean)] * good + [(host, soft)] * bad


def test_host_verdicts(spark):
    rows = rows_of("fine", 90, 10) + rows_of("poor", 10, 90) + rows_of("few", 0, 1) + rows_of("other", 40, 2)
    docs = spark.createDataFrame([(i, t, h) for i, (h, t) in enumerate(rows)], "doc_id long, text string, source string")
    kept = host_rules.judge(docs).join(docs, "doc_id")
    counts = {r["source"]: r["n"] for r in kept.where("kept").groupBy("source").count().withColumnRenamed("count", "n").collect()}
    # On a trusted host the soft rules don't reject; on a distrusted one clean documents stay.
    assert counts["fine"] == 100 and counts["poor"] == 10
    assert host_rules.keep(docs).count() == sum(counts.values())
    strict = host_rules.judge(docs, rules=Rules(max_host_rate=0.0))
    assert strict.where("kept").count() == 140


def test_prior():
    assert beta_prior(0, 0, 0, 0, 0) == (0.0, 999.0)
    mean, strength = beta_prior(2, 200, 100, 90 * 90 / 100 + 10 * 10 / 100, 20_000)
    assert mean == 0.5 and 0.001 < strength < 2


def test_edges(edges, nothing):
    rows = host_rules.judge(edges).collect()
    assert len(rows) == 10
    assert all(r["n_words"] == 0 and r["base_failed"] and not r["kept"] for r in rows if r["doc_id"] in (1, 2, 3))
    assert next(r for r in rows if r["doc_id"] == 7)["n_repeat_words"] == 40
    kept = host_rules.keep(edges)
    assert kept.columns == edges.columns
    assert host_rules.judge(nothing).count() == 0 and host_rules.keep(nothing).count() == 0
