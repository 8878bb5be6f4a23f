import re

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.test_near_duplicates import brute_classes
from tests.llm.test_tokens import check_packing
from tillcast.llm import entry, host_rules, site_bayes
from tillcast.llm.tables import table


@pytest.fixture(scope="module")
def stages(spark, folder):
    docs, out = table(spark, folder, "documents"), {}
    for name, stage in corpus_pipeline.STAGES:
        docs = out[name] = stage(spark, docs, folder).cache()
    return out


def ids(df):
    return sorted(r["doc_id"] for r in df.select("doc_id").collect())


def test_each_stage_works_on_what_the_last_kept(spark, folder, stages, documents):
    docs = table(spark, folder, "documents")
    rules = stages["quality_rules"]
    assert ids(rules) == ids(host_rules.judge(docs).where("kept"))
    good = stages["quality_classifier"]
    assert ids(good) == ids(site_bayes.judge(rules, table(spark, folder, "labels")).where("kept"))
    text_of = dict(documents)
    classes = brute_classes([(i, text_of[i]) for i in ids(good)])
    assert ids(stages["near_duplicates"]) == sorted(set(classes.values()))
    assert ids(stages["personal_data"]) == ids(stages["near_duplicates"])
    for name, _ in corpus_pipeline.STAGES[:-1]:
        assert stages[name].columns == docs.columns


def test_good_labels_stay_and_no_mail_is_left(spark, folder, stages, documents):
    labels = {r["doc_id"]: r["quality"] for r in table(spark, folder, "labels").collect()}
    kept = set(ids(stages["quality_classifier"]))
    judged = host_rules.judge(table(spark, folder, "documents"))
    failed = set(ids(judged.where("base_failed")))  # too short, or repeating itself
    assert {i for i, q in labels.items() if q == 1} - failed <= kept
    text_of, mails = dict(documents), set()
    for row in stages["personal_data"].collect():
        assert row["n_chars"] == len(row["text"])
        for mail in re.findall(r"[\w.%+-]+@[\w-]+(?:\.[\w-]+)*\.[a-z]+", text_of[row["doc_id"]]):
            mails.add(mail)
            assert mail not in row["text"]
    assert mails


def test_run(spark, folder, stages):
    rows = corpus_pipeline.run(spark, folder).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path(entry.WORD_FILE))
    kept = stages["personal_data"].collect()
    encodings = tokenizer.encode_batch([r["text"] for r in kept], add_special_tokens=False)
    ids_of = {r["doc_id"]: e.ids + [2] for r, e in zip(kept, encodings)}
    assert {r["doc_id"] for r in rows} == set(ids_of)
    check_packing(rows, ids_of, 4096)


def test_edges(spark, folder, edges, nothing):
    for docs in (edges, nothing):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, folder)
            if name != "packed_sequences":
                assert out.columns == edges.columns
            out.collect()
