"""Quality rules with host verdicts, in DataFrame functions alone.

Each document is measured on its whole text.  Failures are counted per host, host rates are
shrunk with a beta prior fitted to all hosts, and the verdict on the host decides how strictly
its documents are held: on a trusted host only the base rule rejects, on a distrusted one any
failed rule does.  A clean document is thus kept on any host.

Defined results: a null text has no words and fails the base rule; a null host counts as the
host ``""``; repeated rows count each; an empty table gives an empty result.  Columns of the
input may have any names: measures travel in one struct until the result is made.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillcast.llm.columns import BLANKS, let, whole, words
from tillcast.session import stored

WINDOW = 8


@dataclass(frozen=True)
class Rules:
    min_words: int = 20
    max_repeat_percent: int = 30
    # Rules that count against the host, and against a document of a distrusted host.
    max_symbols_per_word: float = 0.1
    max_duplicate_line_share: float = 0.3
    word_length: tuple[float, float] = (2.5, 14.0)
    # A host is distrusted above this shrunk failure rate.
    max_host_rate: float = 0.3


def _repeated(tokens: Column) -> Column:
    """Words inside windows that occur twice or more: hashes find candidates, texts decide."""

    def neighbours_equal(sorted_rows: Column, field: str) -> Column:
        def same(x: Column, at: Column) -> Column:
            return F.coalesce(x[field] == F.get(sorted_rows, at)[field], F.lit(False))

        return F.transform(
            F.filter(sorted_rows, lambda x, i: same(x, i - 1) | same(x, i + 1)), lambda x: x["at"]
        )

    def covered(positions: Column) -> Column:
        steps = F.transform(
            positions,
            lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get(positions, i + 1) - p, F.lit(WINDOW))),
        )
        return F.aggregate(steps, F.lit(0), lambda total, step: total + step)

    def exact(hashes: Column) -> Column:
        placed = F.transform(hashes, lambda h, i: F.struct(h.alias("key"), i.alias("at")))
        candidates = let(F.array_sort(placed), lambda rows: neighbours_equal(rows, "key"))
        texts = F.transform(
            candidates,
            lambda i: F.struct(F.concat_ws(" ", F.slice(tokens, i + 1, WINDOW)).alias("key"), i.alias("at")),
        )
        positions = let(F.array_sort(texts), lambda rows: neighbours_equal(rows, "key"))
        return let(F.array_sort(positions), covered)

    def windows(hashes: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(1), F.size(hashes) - (WINDOW - 1)),
            lambda i: F.xxhash64(F.slice(hashes, i, WINDOW)),
        )

    def counted(hashes: Column) -> Column:
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(exact(hashes))

    return F.when(F.size(tokens) <= WINDOW, F.lit(0)).otherwise(
        let(F.transform(tokens, lambda w: F.xxhash64(w)), lambda hashes: let(windows(hashes), counted))
    )


def measures(text: Column) -> Column:
    """One struct of whole-text counts, all long."""
    value = whole(text)
    lines = F.filter(F.split(value, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    lined = let(
        lines,
        lambda rows: F.struct(
            F.size(rows).cast("long").alias("n_lines"),
            (F.size(rows) - F.size(F.array_distinct(rows))).cast("long").alias("n_dup_lines"),
        ),
    )
    worded = let(
        words(text),
        lambda tokens: F.struct(
            F.size(tokens).cast("long").alias("n_words"), _repeated(tokens).cast("long").alias("n_repeat_words")
        ),
    )

    def joined(by_line: Column, by_word: Column) -> Column:
        return F.struct(
            by_word["n_words"].alias("n_words"),
            F.length(F.regexp_replace(value, BLANKS, "")).cast("long").alias("word_chars"),
            (F.length(value) - F.length(F.regexp_replace(value, "[#*$%&|<>]", ""))).cast("long").alias("n_symbols"),
            by_line["n_lines"].alias("n_lines"),
            by_line["n_dup_lines"].alias("n_dup_lines"),
            by_word["n_repeat_words"].alias("n_repeat_words"),
        )

    return let(lined, lambda a: let(worded, lambda b: joined(a, b)))


def base_failed(m: Column, rules: Rules = Rules()) -> Column:
    return (m["n_words"] < rules.min_words) | (100 * m["n_repeat_words"] > rules.max_repeat_percent * m["n_words"])


def rule_failed(m: Column, rules: Rules = Rules()) -> Column:
    """The base rule or one of the rules a host is judged by."""
    short, long = rules.word_length
    return (
        base_failed(m, rules)
        | (m["n_symbols"] > rules.max_symbols_per_word * m["n_words"])
        | (m["n_dup_lines"] > rules.max_duplicate_line_share * m["n_lines"])
        | (m["word_chars"] < short * m["n_words"])
        | (m["word_chars"] > long * m["n_words"])
    )


def host_verdicts(judged: DataFrame, host: str, failed: str, rules: Rules = Rules()) -> DataFrame:
    """host, host_docs, host_rate (shrunk) and host_trusted for each host.

    The prior's strength comes from the spread of host rates beyond what their sizes explain
    (the moment estimator of a beta-binomial).  Hosts are counted with partial aggregation, so a
    host with most of the rows costs no task more than another; five sums reach the driver.
    """
    counts = stored(
        judged.groupBy(F.col(host).alias("host")).agg(
            F.count(F.lit(1)).alias("host_docs"), F.sum(F.col(failed).cast("long")).alias("host_failed")
        ),
        "host-counts",
    )
    n, f = F.col("host_docs").cast("double"), F.col("host_failed").cast("double")
    hosts, docs, bad, spread, squares = counts.agg(
        F.count(F.lit(1)), F.sum(n), F.sum(f), F.sum(f * f / n), F.sum(n * n)
    ).first()
    mean, strength = beta_prior(hosts, docs or 0.0, bad or 0.0, spread or 0.0, squares or 0.0)
    rate = (f + mean * strength) / (n + strength)
    return counts.select(
        "host", "host_docs", rate.alias("host_rate"), (rate <= rules.max_host_rate).alias("host_trusted")
    )


def beta_prior(hosts: int, docs: float, bad: float, spread: float, squares: float) -> tuple[float, float]:
    """Mean and strength (alpha + beta) of the prior; within-host correlation is kept in [0.001, 0.999]."""
    mean = bad / docs if docs else 0.0
    noise, room = mean * (1 - mean), docs - (squares / docs if docs else 0.0) - (hosts - 1)
    rho = ((spread - mean * mean * docs) / noise - (hosts - 1)) / room if noise > 0 and room > 0 else 0.001
    return mean, 1 / min(max(rho, 0.001), 0.999) - 1


def _host(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit(""))


def judge(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source", rules: Rules = Rules()
) -> DataFrame:
    """One row per document with measures, host rate and verdicts.

    The measures are written once (a few numbers per document) and read by both passes.
    """
    measured = stored(
        docs.select(F.col(doc_id).alias("doc_id"), _host(F.col(host)).alias("host"), measures(F.col(text)).alias("m")),
        "host-rules",
    )
    judged = measured.withColumns({"base": base_failed(F.col("m"), rules), "failed": rule_failed(F.col("m"), rules)})
    verdicts = host_verdicts(judged, "host", "failed", rules)
    return judged.join(verdicts, "host").select(
        "doc_id",
        *[F.col("m")[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        F.col("base").alias("base_failed"),
        (~F.col("base") & (F.col("host_trusted") | ~F.col("failed"))).alias("kept"),
        "host_rate",
    )


def keep(
    docs: DataFrame, text: str = "text", host: str = "source", rules: Rules = Rules()
) -> DataFrame:
    """The documents that pass, with their own columns.

    The second pass measures again instead of moving or storing whole texts.
    """
    # Inside one expression the measures are taken once, whatever the optimizer moves.
    verdict = let(
        measures(F.col(text)),
        lambda m: F.struct(base_failed(m, rules).alias("base"), rule_failed(m, rules).alias("failed")),
    )
    judged = docs.select(_host(F.col(host)).alias("host"), verdict["failed"].alias("failed"))
    verdicts = host_verdicts(judged, "host", "failed", rules).select("host", "host_trusted")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(row.alias("row"), _host(F.col(host)).alias("host"), verdict.alias("v"))
    passes = F.when(F.col("v")["base"], F.lit(False)).otherwise(F.col("host_trusted") | ~F.col("v")["failed"])
    return rows.join(verdicts, "host").where(passes).select("row.*")


#: The same counts and verdicts for DuckDB.
ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t, coalesce(source, '') AS host FROM documents),
w AS (SELECT *, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
wins AS (SELECT rid, unnest(range(1, len(ws) - 6)) AS i, ws FROM w WHERE len(ws) > 8),
texts AS (SELECT rid, i, array_to_string(ws[i:i + 7], ' ') AS g FROM wins),
twice AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM texts) WHERE c > 1),
cover AS (SELECT rid, sum(least(8, coalesce(nxt - i, 8))) AS r
          FROM (SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS nxt FROM twice) GROUP BY rid),
m AS (SELECT doc_id, host, len(ws)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
             (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
             len(ls) AS n_lines, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(r, 0)::BIGINT AS n_repeat_words
      FROM w LEFT JOIN cover USING (rid)),
j AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m),
f AS (SELECT *, base_failed OR n_symbols > 0.1 * n_words OR n_dup_lines > 0.3 * n_lines
                OR word_chars < 2.5 * n_words OR word_chars > 14.0 * n_words AS failed FROM j),
h AS (SELECT host, count(*)::DOUBLE AS n, sum(failed::INT)::DOUBLE AS b FROM f GROUP BY host),
s AS (SELECT count(*) AS k, sum(n) AS docs, sum(b) / sum(n) AS mean, sum(b * b / n) AS spread, sum(n * n) AS squares FROM h),
p AS (SELECT mean, 1 / least(greatest(CASE WHEN mean * (1 - mean) > 0 AND docs - squares / docs - (k - 1) > 0
                 THEN ((spread - mean * mean * docs) / (mean * (1 - mean)) - (k - 1)) / (docs - squares / docs - (k - 1))
                 ELSE 0.001 END, 0.001), 0.999) - 1 AS strength FROM s),
v AS (SELECT host, (b + mean * strength) / (n + strength) AS host_rate FROM h, p)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND (host_rate <= 0.3 OR NOT failed) AS kept, round(host_rate, 9) AS host_rate
FROM f JOIN v USING (host)
"""
