"""Licence scan by a positional index of rare words, in DataFrame functions alone.

Every template is a short licence text.  The document frequency of its words is counted over the
whole corpus, and its rarest words become its anchors, with their positions as postings.  A
file's anchor words are looked up, each posting votes for the place where the template would have
to start, and templates whose anchors agree on a place are compared there word by word.  A
label is given where the matched words carry most of the template's information and the mandatory
key phrase stands at its place.  A few fixed phrases are counted besides.

Words are runs of ASCII letters (lower case), digits and any character beyond ASCII.

Defined results: a null or empty text has no words, no labels and score 0; repeated rows are scanned
each; an empty table gives an empty result; only the named columns are read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillcast.llm.columns import let, whole

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: A word of a text that isn't lower case yet.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

#: Phrases whose places are counted, and their labels.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}


@dataclass(frozen=True)
class Template:
    """A licence notice in words, and the phrase of it that must stand at its place."""

    label: str
    text: str
    key: str


TEMPLATES = (
    Template("agpl-3", "gnu affero general public license version 3", "affero general public license version 3"),
    Template("apache-2", "licensed under the apache license version 2 0", "apache license version 2"),
    Template("artistic-2", "licensed under the artistic license 2 0", "artistic license 2"),
    Template(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that "
        "the following conditions are met",
        "source and binary forms",
    ),
    Template("bsl-1", "distributed under the boost software license version 1 0", "boost software license"),
    Template("cc-by", "licensed under the creative commons attribution 4 0 international license", "attribution 4 0"),
    Template("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    Template("cc-by-nd", "licensed under cc by nd 4 0", "cc by nd"),
    Template("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    Template("cc0-1", "cc0 1 0 universal public domain dedication", "cc0 1 0"),
    Template("epl-2", "made available under the terms of the eclipse public license 2 0", "eclipse public license 2"),
    Template("gpl-2", "licensed under the gnu general public license version 2", "gnu general public license version 2"),
    Template("gpl-3", "licensed under the gnu general public license version 3", "gnu general public license version 3"),
    Template(
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
        "with or without fee",
    ),
    Template("lgpl-3", "gnu lesser general public license version 3", "lesser general public license version 3"),
    Template("mit", "released under the mit license", "under the mit license"),
    Template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files",
        "free of charge to any person obtaining a copy",
    ),
    Template("mpl-2", "subject to the terms of the mozilla public license v 2 0", "mozilla public license v 2"),
    Template(
        "unlicense",
        "this is free and unencumbered software released into the public domain",
        "unencumbered software released into the public domain",
    ),
)

ANCHORS = 3
#: Share of a template's information that must match at its place.
COVERAGE = 0.7


def _lower(text: Column) -> Column:
    return F.translate(text, UPPER, UPPER.lower())


def _words(text: Column) -> Column:
    return F.array_remove(F.split(_lower(whole(text)), SEPARATORS), "")


def vocabulary(templates: tuple[Template, ...] = TEMPLATES) -> list[str]:
    return sorted({w for t in templates for w in t.text.split()})


def document_frequencies(docs: DataFrame, text: str = "text", templates: tuple[Template, ...] = TEMPLATES) -> tuple[int, dict[str, int]]:
    """Number of documents, and of those that hold each word of the templates; one row a word reaches the driver.

    Each document gives one small array, counted per partition before the shuffle.
    """
    names = vocabulary(templates)
    found = docs.select(F.array_intersect(_words(F.col(f"`{text}`")), F.array(*[F.lit(w) for w in names])).alias("found"))
    counts = [F.count(F.when(F.array_contains("found", w), 1)).alias(f"n{i}") for i, w in enumerate(names)]
    row = found.agg(F.count(F.lit(1)).alias("n"), *counts).first()
    return row["n"], dict(zip(names, row[1:]))


@dataclass(frozen=True)
class Index:
    """Anchor words with their postings (template number, position), and the information of each template word."""

    postings: dict[str, list[tuple[int, int]]]
    information: list[list[float]]
    templates: tuple[Template, ...]


def index(documents: int, frequencies: dict[str, int], templates: tuple[Template, ...] = TEMPLATES) -> Index:
    idf = {w: math.log((documents + 1) / (n + 1)) + 1e-6 for w, n in frequencies.items()}
    postings: dict[str, list[tuple[int, int]]] = {}
    information = []
    for number, template in enumerate(templates):
        words = template.text.split()
        rarest = sorted(set(words), key=lambda w: (-idf[w], w))[:ANCHORS]
        for position, word in enumerate(words):
            if word in rarest:
                postings.setdefault(word, []).append((number, position))
        total = sum(idf[w] for w in words)
        information.append([idf[w] / total for w in words])
    return Index(postings, information, templates)


def _array(values: list, kind: str) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast(f"array<{kind}>")


def _places(words: Column, phrase: str) -> Column:
    parts = phrase.split()
    first = F.filter(F.transform(words, lambda w, i: F.when(w == parts[0], i)), lambda i: i.isNotNull())
    return F.filter(first, lambda i: F.slice(words, i + 1, len(parts)) == _array(parts, "string"))


def _matches(words: Column, made: Index) -> Column:
    """Array of (label, score) of the templates found in one text."""
    postings = F.create_map(
        *[
            x
            for word, rows in sorted(made.postings.items())
            for x in (F.lit(word), F.array(*[F.struct(F.lit(n).alias("number"), F.lit(p).alias("at")) for n, p in rows]))
        ]
    )
    bodies = F.array(*[_array(t.text.split(), "string") for t in made.templates])
    information = F.array(*[_array(rows, "double") for rows in made.information])
    keys = F.array(*[_array(t.key.split(), "string") for t in made.templates])
    key_at = _array([_find(t.text.split(), t.key.split()) for t in made.templates], "int")
    labels = _array([t.label for t in made.templates], "string")
    anchors = _array(sorted(made.postings), "string")

    def votes(table: Column) -> Column:
        hits = F.filter(
            F.transform(words, lambda w, i: F.when(F.array_contains(anchors, w), F.struct(w.alias("word"), i.alias("at")))),
            lambda x: x.isNotNull(),
        )
        return F.flatten(
            F.transform(
                hits,
                lambda x: F.transform(
                    F.element_at(table, x["word"]),
                    lambda p: F.struct(p["number"].alias("number"), (x["at"] - p["at"]).alias("start")),
                ),
            )
        )

    def judged(place: Column, body: Column, shares: Column, key: Column, at: Column, label: Column) -> Column:
        hit = F.zip_with(
            F.transform(body, lambda w, j: F.coalesce(F.get(words, place + j) == w, F.lit(False))),
            shares,
            lambda same, share: F.when(same, share).otherwise(F.lit(0.0)),
        )
        score = F.aggregate(hit, F.lit(0.0), lambda a, b: a + b)
        stands = F.transform(key, lambda w, j: F.coalesce(F.get(words, place + at + j) == w, F.lit(False)))
        return F.struct(label.alias("label"), F.least(score, F.lit(1.0)).alias("score"), F.forall(stands, lambda x: x).alias("key"))

    def compared(candidates: Column) -> Column:
        return F.transform(
            candidates,
            lambda c: judged(
                c["start"], F.get(bodies, c["number"]), F.get(information, c["number"]), F.get(keys, c["number"]),
                F.get(key_at, c["number"]), F.get(labels, c["number"]),
            ),
        )

    def agreeing(rows: Column) -> Column:
        # Sorted, two anchors that agree on a place stand side by side.
        return let(
            F.array_sort(rows),
            lambda s: F.array_distinct(F.filter(s, lambda x, i: F.coalesce(x == F.get(s, i - 1), F.lit(False)))),
        )

    found = compared(agreeing(let(postings, votes)))
    return F.filter(found, lambda x: x["key"] & (x["score"] >= COVERAGE))


def _find(words: list[str], part: list[str]) -> int:
    return next(i for i in range(len(words)) if words[i : i + len(part)] == part)


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """One row per document with counts of the fixed phrases, labels and the best score.

    Words are cut only in texts that hold a rare word at all; the others are counted by pattern.
    """
    made = index(*document_frequencies(docs, text, templates), templates)
    value = whole(F.col(f"`{text}`"))
    # Each phrase and each pair of agreeing anchors holds one of these.
    rare = sorted(set(made.postings) | {phrase.split()[0 if phrase.startswith("cc") else -2] for phrase in PHRASES})
    rare = sorted({w for w in rare} | {"license"})

    def found(words: Column) -> Column:
        def joined(base: Column, more: Column) -> Column:
            places = F.flatten(base)
            names = F.array_compact(F.array(*[F.when(F.size(base[i]) > 0, F.lit(x)) for i, x in enumerate(PHRASES.values())]))
            labels = F.concat(names, F.transform(more, lambda x: x["label"]))
            return F.struct(
                F.size(places).cast("long").alias("n_base"),
                F.array_min(places).cast("long").alias("first_word"),
                F.array_max(places).cast("long").alias("last_word"),
                F.array_join(F.array_sort(F.array_distinct(names)), ",").alias("base_labels"),
                F.array_join(F.array_sort(F.array_distinct(labels)), ",").alias("labels"),
                F.when(F.size(names) > 0, F.lit(1.0)).otherwise(
                    F.coalesce(F.array_max(F.transform(more, lambda x: x["score"])), F.lit(0.0))
                ).alias("score"),
            )

        base = F.array(*[_places(words, phrase) for phrase in PHRASES])
        return let(base, lambda b: let(_matches(words, made), lambda m: joined(b, m)))

    nothing = F.struct(
        F.lit(0).cast("long").alias("n_base"), F.lit(None).cast("long").alias("first_word"),
        F.lit(None).cast("long").alias("last_word"), F.lit("").alias("base_labels"), F.lit("").alias("labels"),
        F.lit(0.0).alias("score"),
    )
    rows = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"),
        F.regexp_count(value, F.lit(WORD)).cast("long").alias("n_words"),
        F.when(value.rlike("(?i)" + "|".join(rare)), let(_words(value), found)).otherwise(nothing).alias("found"),
    )
    return rows.select(
        "doc_id", "n_words", *[F.col("found")[c].alias(c) for c in ("n_base", "first_word", "last_word", "base_labels", "labels", "score")]
    )


def _sql_list(words: list[str]) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


def oracle(templates: tuple[Template, ...] = TEMPLATES) -> str:
    """The same scan for DuckDB, by joins of word positions; scores are rounded to nine digits."""
    bodies = ", ".join(
        f"({n}, '{t.label}', {_sql_list(t.text.split())}, {_sql_list(t.key.split())})" for n, t in enumerate(templates)
    )
    phrases = ", ".join(f"('{label}', {_sql_list(phrase.split())})" for phrase, label in PHRASES.items())
    return rf"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id,
    list_filter(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '{SEPARATORS}'),
                lambda x: x <> '') AS ws FROM documents),
templates(num, label, body, key) AS (VALUES {bodies}),
phrases(label, parts) AS (VALUES {phrases}),
places AS (SELECT num, label, key, unnest(range(len(body))) AS pos, unnest(body) AS word FROM templates),
vocabulary AS (SELECT DISTINCT word FROM places),
tokens AS (SELECT rid, unnest(range(len(ws))) AS i, unnest(ws) AS word FROM docs),
known AS (SELECT t.* FROM tokens t SEMI JOIN vocabulary v ON t.word = v.word),
idf AS (SELECT word, ln(((SELECT count(*) FROM docs) + 1) / (count(DISTINCT rid) + 1)) + 1e-6 AS idf
        FROM vocabulary LEFT JOIN known USING (word) GROUP BY word),
weighted AS (SELECT p.*, idf / sum(idf) OVER (PARTITION BY num) AS share FROM places p JOIN idf USING (word)),
rare AS (SELECT num, word FROM (SELECT num, word, row_number() OVER (PARTITION BY num ORDER BY idf DESC, word) AS r
         FROM (SELECT DISTINCT num, word FROM places) JOIN idf USING (word)) WHERE r <= {ANCHORS}),
agreed AS (SELECT rid, num, i - pos AS start FROM known JOIN rare USING (word) JOIN places USING (num, word)
           GROUP BY rid, num, start HAVING count(*) >= 2),
covered AS (SELECT a.rid, a.num, a.start, least(sum(w.share), 1.0) AS score
            FROM agreed a JOIN weighted w USING (num) JOIN known k ON k.rid = a.rid AND k.word = w.word AND k.i = a.start + w.pos
            GROUP BY ALL),
starts AS (SELECT num, label, key, min(place) AS place FROM (
             SELECT num, label, key, body, unnest(range(len(body))) AS place FROM templates)
           WHERE body[place + 1:place + len(key)] = key GROUP BY num, label, key),
labelled AS (SELECT c.rid, s.label, c.score FROM covered c JOIN starts s USING (num) JOIN docs d USING (rid)
             WHERE c.score >= {COVERAGE} AND c.start + s.place >= 0 AND d.ws[c.start + s.place + 1:c.start + s.place + len(s.key)] = s.key),
base AS (SELECT t.rid, p.label, t.i FROM tokens t JOIN phrases p ON p.parts[1] = t.word JOIN docs d USING (rid)
         WHERE d.ws[t.i + 1:t.i + len(p.parts)] = p.parts),
counted AS (SELECT rid, count(*) AS n, min(i) AS first, max(i) AS last, string_agg(DISTINCT label, ',' ORDER BY label) AS names
            FROM base GROUP BY rid),
merged AS (SELECT rid, string_agg(DISTINCT label, ',' ORDER BY label) AS names, max(score) AS score
           FROM (SELECT rid, label, score FROM labelled UNION ALL SELECT rid, label, 1.0 FROM base) GROUP BY rid)
SELECT doc_id, len(ws) AS n_words, coalesce(c.n, 0) AS n_base, c.first AS first_word, c.last AS last_word,
       coalesce(c.names, '') AS base_labels, coalesce(m.names, '') AS labels, round(coalesce(m.score, 0.0), 9) AS score
FROM docs LEFT JOIN counted c USING (rid) LEFT JOIN merged m USING (rid)
"""
