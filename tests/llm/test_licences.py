import re

import duckdb
import pytest

from tillcast.llm import entry, licences
from tools.check import differences

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans(licences.UPPER, licences.UPPER.lower())


def brute(text):
    words = WORD.findall((text or "").translate(LOWER))
    places, labels = [], set()
    for phrase, label in licences.PHRASES.items():
        parts = phrase.split()
        at = [i for i in range(len(words)) if words[i : i + len(parts)] == parts]
        places += at
        labels |= {label} if at else set()
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def digest(row):
    return tuple(row[c] for c in ("n_words", "n_base", "first_word", "last_word", "base_labels"))


def test_query(spark, folder, documents):
    rows = {r["doc_id"]: r for r in entry.QUERIES["op7_licence_index"](spark, folder).collect()}
    assert len(rows) == len(documents)
    for doc_id, text in documents:
        assert digest(rows[doc_id]) == brute(text)
        labels = set(rows[doc_id]["labels"].split(",")) - {""}
        assert labels >= set(rows[doc_id]["base_labels"].split(",")) - {""}
        if "GNU General Public License, version 3" in text:
            assert "gpl-3" in labels
        assert bool(labels) == (rows[doc_id]["score"] > 0)


def test_query_matches_other_engine(spark, folder):
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    got = entry.QUERIES["op7_licence_index"](spark, folder).toPandas()
    assert differences(got, db.sql(entry.ORACLES["op7_licence_index"]).df()) == ""


def test_other_engine_agrees_on_odd_texts(spark, found):
    db = duckdb.connect()
    db.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    db.executemany("INSERT INTO documents VALUES (?, ?)", [[i, t] for i, t in enumerate(TEXTS)])
    rows = db.sql(licences.oracle()).df().set_index("doc_id")
    for i, row in found.items():
        assert (rows.loc[i].labels, rows.loc[i].base_labels) == (row["labels"], row["base_labels"])
        assert rows.loc[i].score == pytest.approx(row["score"], abs=1e-8)


TEXTS = [
    "This work is LICENSED under the GNU General-Public License, version 3.",
    "It mentions the gnu and the general public and a license version.",
    "Released under the mit license. Released\nunder the MIT License; cc-by/nc",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "Subject to the terms of the Mozilla Public License, v. 2.0.",
    "version 3 license public general gnu the under licensed",
    "Apache License, Version 2",
    "ünder the mit license", "under the mit licenseé",
]


@pytest.mark.parametrize("i, labels", list(enumerate(["gpl-3", "", "cc-by-nc,mit", "mit", "mpl-2", "", "apache-2", "", ""])))
def test_labels(found, i, labels):
    assert found[i]["labels"] == labels
    assert digest(found[i]) == brute(TEXTS[i])


@pytest.fixture(scope="module")
def found(spark):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    return {r["doc_id"]: r for r in licences.scan(rows).collect()}


def test_places_of_a_hot_text(made):
    text = "under the mit license " * 500
    row = licences.scan(made([(1, text)])).first()
    assert digest(row) == brute(text) and row["n_base"] == 500


def test_edges(edges, nothing):
    rows = licences.scan(edges).collect()
    assert len(rows) == 10 and all(r["labels"] == "" and r["score"] == 0 for r in rows)
    assert [digest(r) for r in rows if r["doc_id"] in (1, 2, 3)] == [(0, 0, None, None, "")] * 3
    assert licences.scan(nothing).count() == 0
