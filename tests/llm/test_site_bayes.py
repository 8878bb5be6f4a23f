import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillcast.llm import entry, site_bayes
from tillcast.llm.tables import table


def test_held_out_accuracy(spark):
    """Fitted on the labels of even documents, judged on the odd ones."""
    docs, labels = (table(spark, "/root/testdata/sf0.01", name) for name in ("documents", "labels"))
    judged = site_bayes.judge(docs, labels.where("doc_id % 2 = 0")).join(labels.where("doc_id % 2 = 1"), "doc_id")
    rows = judged.select("kept", "quality").collect()
    assert len(rows) > 100
    assert sum(r["kept"] == bool(r["quality"]) for r in rows) / len(rows) >= 0.95


def test_query_keeps_what_is_labelled_good(spark, folder):
    rows = entry.QUERIES["op3_site_bayes"](spark, folder).join(table(spark, folder, "labels"), "doc_id").collect()
    assert all(r["kept"] for r in rows if r["quality"] == 1)


@pytest.fixture(scope="module")
def scored(spark):
    rows = [("big", "x", 0.9)] * 400 + [("bad", "x", 0.1)] * 400 + [("new", "x", 0.1)] + [("big", "y", 0.2)] * 2
    return spark.createDataFrame(rows, "host string, path string, p double")


def test_sparse_sites_lean_on_the_level_above(scored):
    rates, mean = site_bayes.sites(scored)
    of = {(r["host"], r["path"]): r for r in rates.collect()}
    assert mean == pytest.approx((360 + 40 + 0.1 + 0.4) / 803)
    assert of["big", "x"]["host_rate"] == pytest.approx(0.9, abs=0.02)
    assert of["bad", "x"]["path_rate"] == pytest.approx(0.1, abs=0.02)
    assert 0.1 < of["new", "x"]["path_rate"] < mean
    assert 0.2 < of["big", "y"]["path_rate"] < of["big", "y"]["host_rate"]


def test_posterior_moves_with_the_site(spark):
    low, same, high = spark.range(1).select(
        *[site_bayes._posterior(F.lit(0.0), F.lit(p), 0.5, site_bayes.Settings()) for p in (0.2, 0.5, 0.9)]
    ).first()
    assert low == pytest.approx(0.2) and same == pytest.approx(0.5) and high == pytest.approx(0.9)


def plain_strength(n, s):
    """Prior mean and strength by the analysis-of-variance estimate of the correlation inside groups."""
    total = n.sum()
    mean = s.sum() / total
    groups = len(n)
    between = (n * (s / n - mean) ** 2).sum()
    usual = (total - (n**2).sum() / total) / (groups - 1)
    noise = mean * (1 - mean)
    rho = (between / noise / (groups - 1) - 1) / (usual - 1) if usual > 1 else 0.001
    return mean, 1 / np.clip(rho, 0.001, 0.999) - 1


def plain_posteriors(rows):
    """(host rate, path rate, posterior) of (host, path, evidence) rows, one by one."""
    hosts, paths = {}, {}
    for host, path, p in rows:
        hosts.setdefault(host, []).append(p)
        paths.setdefault((host, path), []).append(p)
    mean, of_hosts = plain_strength(*(np.array([f(v) for v in hosts.values()], float) for f in (len, sum)))
    _, of_paths = plain_strength(*(np.array([f(v) for v in paths.values()], float) for f in (len, sum)))
    out = []
    for host, path, p in rows:
        h = (sum(hosts[host]) + mean * of_hosts) / (len(hosts[host]) + of_hosts)
        r = (sum(paths[host, path]) + h * of_paths) / (len(paths[host, path]) + of_paths)
        odds = p / (1 - p) * (r / (1 - r)) / (mean / (1 - mean))
        out.append((h, r, odds / (1 + odds)))
    return out


def test_rates_and_posteriors_against_plain_python(spark, folder):
    docs, labels = (table(spark, folder, name) for name in ("documents", "labels"))
    judged = site_bayes.judge(docs, labels).join(docs.select("doc_id", "source", "lang"), "doc_id").collect()
    expected = plain_posteriors([(r["source"], r["lang"], r["evidence"]) for r in judged])
    for r, (host, path, posterior) in zip(judged, expected):
        assert (r["host_rate"], r["path_rate"]) == pytest.approx((host, path), rel=1e-9)
        # Odds are cut off far out.
        assert r["posterior"] == pytest.approx(posterior, abs=2e-6)
        assert r["kept"] == (r["posterior"] >= 0.5)


def test_the_site_changes_verdicts(spark):
    """The same doubtful texts on a good and on a bad host: what they say is equal, the verdicts aren't."""
    pick = random.Random(1)
    words = [w + v for w in "river stone garden letter market winter simple travel music bread".split() for v in ("", "s", "ed")]

    def text(junk):
        return " ".join("$$$ ###" if pick.random() < junk else pick.choice(words) for _ in range(80))

    rows = [(i, text(0.0), "good", "en") for i in range(150)] + [(1000 + i, text(0.6), "bad", "en") for i in range(150)]
    labels = [(i, int(i < 1000), 0) for i, *_ in rows]
    doubtful = [text(0.3 * i / 40) for i in range(40)]
    rows += [(2000 + i, t, "good", "en") for i, t in enumerate(doubtful)] + [(3000 + i, t, "bad", "en") for i, t in enumerate(doubtful)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    judged = site_bayes.judge(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    of = {r["doc_id"]: r for r in judged.collect()}
    changed = 0
    for i in range(40):
        good, bad = of[2000 + i], of[3000 + i]
        assert good["evidence"] == pytest.approx(bad["evidence"]) and good["posterior"] > bad["posterior"]
        changed += good["kept"] and not bad["kept"]
    assert changed >= 2


def test_edges(spark, edges, nothing):
    labels = spark.createDataFrame([(4, 1, 0), (6, 0, 0), (None, 1, 0), (7, None, 0), (99, 1, 1)], "doc_id long, quality int, toxic int")
    rows = site_bayes.judge(edges, labels).collect()
    assert len(rows) == 10 and all(0 <= r["posterior"] <= 1 for r in rows)
    assert site_bayes.keep(edges, labels).columns == edges.columns
    one_kind = labels.where("quality = 1")
    assert site_bayes.keep(edges, one_kind).count() == 10
    assert all(r["evidence"] == 0.5 for r in site_bayes.judge(edges, one_kind).collect())
    assert site_bayes.judge(nothing, labels).count() == 0 and site_bayes.keep(nothing, labels).count() == 0
