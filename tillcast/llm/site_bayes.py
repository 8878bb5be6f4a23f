"""Quality classifier with hierarchical empirical Bayes.

A logistic regression on whole-text features, fitted on all labelled documents, gives each
document its own evidence.  The evidence is averaged per path (source and language) and per
source, and these rates are shrunk step by step: a source toward the rate of all documents, a
path toward its source.  How strongly is estimated from how much the rates of all sources (of
all paths) differ beyond what their sizes explain, so sparse sites lean on the level above.  The
posterior log-odds of a document are its evidence plus what its path's odds add to the global ones.

Defined results: a null text counts as empty; null source or language is a site of its own;
repeated rows count each; without labels of both kinds the evidence is 1/2 for every document and
all are kept; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillcast.llm.columns import BLANKS, let, whole, words
from tillcast.llm.host_rules import beta_prior
from tillcast.session import stored

FEATURES = ("length", "word_length", "upper", "symbols", "marks", "bars", "distinct", "runs", "short_lines")


@dataclass(frozen=True)
class Settings:
    regularisation: float = 1e-3
    iterations: int = 40
    #: Documents whose posterior is below go.
    threshold: float = 0.5
    #: Whether both kinds of labels weigh alike in the fit; otherwise their shares are the prior.
    balanced: bool = False
    #: Share of the path's log-odds that is added to the document's evidence.
    site_weight: float = 1.0


def features(text: Column) -> Column:
    """Struct of doubles measured on the whole text."""
    value = whole(text)

    def share(pattern: str, of: Column) -> Column:
        return (F.length(value) - F.length(F.regexp_replace(value, pattern, ""))) / F.greatest(of, F.lit(1))

    letters = F.length(F.regexp_replace(value, BLANKS, ""))
    lines = F.split(value, "\n")

    def worded(w: Column) -> Column:
        n = F.size(w)
        same = F.size(F.filter(w, lambda x, i: F.coalesce(x == F.get(w, i - 1), F.lit(False))))
        least = F.greatest(n, F.lit(1))
        return F.struct(
            F.log1p(n).alias("length"),
            F.least(letters / least, F.lit(30.0)).alias("word_length"),
            share("[A-Z]", letters).alias("upper"),
            share("[#*$%&<>]", letters).alias("symbols"),
            share("[!?]", letters).alias("marks"),
            share("[|]", letters).alias("bars"),
            # Heaps' law: a plain text of n words has in the order of n^0.8 distinct ones.
            (F.size(F.array_distinct(w)) / F.pow(least, F.lit(0.8))).alias("distinct"),
            (same / least).alias("runs"),
            (F.size(F.filter(lines, lambda x: F.length(x) < 20)) / F.size(lines)).alias("short_lines"),
        )

    return let(words(text), worded)


def _site(*columns: str) -> list[Column]:
    return [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\0")) for c in columns]


def _measured(docs: DataFrame, doc_id: str, text: str, host: str, path: str) -> DataFrame:
    where, part = _site(host, path)
    return docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"), where.alias("host"), part.alias("path"), features(F.col(f"`{text}`")).alias("f")
    )


class Evidence:
    """The fitted weights as a column expression."""

    def __init__(self, weights: list[float], intercept: float):
        self.weights, self.intercept = weights, intercept

    def log_odds(self, f: Column) -> Column:
        total = F.lit(float(self.intercept))
        for name, weight in zip(FEATURES, self.weights):
            total = total + f[name] * float(weight)
        return F.least(F.greatest(total, F.lit(-30.0)), F.lit(30.0))


def fit(measured: DataFrame, labels: DataFrame, doc_id: str = "doc_id", quality: str = "quality", settings: Settings = Settings()) -> Evidence:
    """Logistic regression on every labelled document."""
    target = labels.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{quality}`").cast("double").alias("label"))
    target = target.where(F.col("label").isin(0.0, 1.0))
    rows = measured.select("doc_id", *[F.col("f")[c].alias(c) for c in FEATURES]).join(target, "doc_id")
    rows = stored(rows.select("label", *FEATURES), "labelled")
    counts = {row["label"]: row["n"] for row in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(counts) < 2:
        return Evidence([0.0] * len(FEATURES), 0.0)
    total = sum(counts.values())
    share = {label: total / (2 * n) if settings.balanced else 1.0 for label, n in counts.items()}
    weight = F.when(F.col("label") == 1, share[1.0]).otherwise(share[0.0])
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="x").transform(rows.withColumn("weight", weight))
    model = LogisticRegression(
        featuresCol="x", labelCol="label", weightCol="weight", maxIter=settings.iterations, regParam=settings.regularisation
    ).fit(vectors)
    return Evidence([float(w) for w in model.coefficients], float(model.intercept))


def _strength(groups: DataFrame, size: str, total: str) -> tuple[float, float]:
    """Mean and prior strength from sizes and evidence sums of all groups; five sums reach the driver."""
    n, f = F.col(size).cast("double"), F.col(total)
    row = groups.agg(F.count(F.lit(1)), F.sum(n), F.sum(f), F.sum(f * f / n), F.sum(n * n)).first()
    return beta_prior(row[0], *[x or 0.0 for x in row[1:]])


def sites(scored: DataFrame) -> tuple[DataFrame, float]:
    """(host, path, host_rate, path_rate) and the global rate, from doc-level ``p``.

    Rows are added up per partition first, so a site with most of them costs no task more; one row
    per path goes on.
    """
    paths = stored(scored.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.sum("p").alias("s")), "paths")
    hosts = stored(paths.groupBy("host").agg(F.sum("n").alias("host_n"), F.sum("s").alias("host_s")), "hosts")
    mean, of_hosts = _strength(hosts, "host_n", "host_s")
    _, of_paths = _strength(paths, "n", "s")
    hosts = hosts.withColumn("host_rate", (F.col("host_s") + mean * of_hosts) / (F.col("host_n") + of_hosts))
    joined = paths.join(hosts, "host")
    rate = (F.col("s") + F.col("host_rate") * of_paths) / (F.col("n") + of_paths)
    # Written, so that joins of whole documents with it are planned by its true size.
    return stored(joined.select("host", "path", "host_rate", rate.alias("path_rate")), "rates"), mean


def _logit(p: Column) -> Column:
    inside = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(inside / (1 - inside))


def _posterior(log_odds: Column, path_rate: Column, mean: float, settings: Settings) -> Column:
    total = log_odds + settings.site_weight * (_logit(path_rate) - _logit(F.lit(float(mean))))
    return 1 / (1 + F.exp(-total))


def judge(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source", path: str = "lang",
    settings: Settings = Settings(),
) -> DataFrame:
    """doc_id, evidence, host and path rates, posterior and verdict of every document."""
    measured = stored(_measured(docs, doc_id, text, host, path), "features")
    fitted = fit(measured, labels, doc_id, settings=settings)
    scored = measured.select("doc_id", "host", "path", fitted.log_odds(F.col("f")).alias("log_odds"))
    scored = scored.withColumn("p", 1 / (1 + F.exp(-F.col("log_odds"))))
    rates, mean = sites(scored)
    posterior = _posterior(F.col("log_odds"), F.col("path_rate"), mean, settings)
    return scored.join(rates, ["host", "path"]).select(
        "doc_id", F.col("p").alias("evidence"), "host_rate", "path_rate", posterior.alias("posterior"),
        (posterior >= settings.threshold).alias("kept"),
    )


def keep(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source", path: str = "lang",
    settings: Settings = Settings(),
) -> DataFrame:
    """The documents that pass, with their own columns; texts are measured again instead of moved."""
    measured = stored(_measured(docs, doc_id, text, host, path), "features")
    fitted = fit(measured, labels, doc_id, settings=settings)
    log_odds = fitted.log_odds(F.col("f"))
    rates, mean = sites(measured.select("host", "path", (1 / (1 + F.exp(-log_odds))).alias("p")))
    where, part = _site(host, path)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(row.alias("row"), where.alias("host"), part.alias("path"), features(F.col(f"`{text}`")).alias("f"))
    rows = rows.select("row", "host", "path", log_odds.alias("log_odds")).join(rates.select("host", "path", "path_rate"), ["host", "path"])
    passed = rows.where(_posterior(F.col("log_odds"), F.col("path_rate"), mean, settings) >= settings.threshold)
    return passed.select("row.*")
