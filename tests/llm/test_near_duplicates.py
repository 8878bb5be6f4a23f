import random

import numpy as np
import pytest

from tillcast.llm import entry, prob_minhash
from tillcast.llm.components import components
from tillcast.llm.prob_minhash import Hasher, shingles, similarity, sketch, words_of


def brute_classes(docs, least=prob_minhash.SIMILARITY):
    """Class of every document by comparing all pairs."""
    hashed = Hasher()
    sets = {i: shingles(hashed(words_of(t))) for i, t in docs}
    root = {i: i for i, _ in docs}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            smaller, larger = sorted((len(sets[a][0]), len(sets[b][0])))
            if a < b and smaller and similarity(sets[a], sets[b]) >= least - 1e-12:
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {i: find(i) for i in ids}


def edited(rng, words, share):
    return [f"new{rng.random()}" if rng.random() < share else w for w in words]


@pytest.fixture(scope="module")
def corpus():
    """Exact copies, near copies of every degree, chains, and texts that share a long passage."""
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(400)]
    docs, passage = [], rng.choices(vocabulary, k=60)
    for family in range(12):
        words = rng.choices(vocabulary, k=rng.randint(5, 150))
        for copy in range(6):
            docs.append(edited(rng, words, 0.01 * copy))
    chain = rng.choices(vocabulary, k=120)
    for step in range(15):
        docs.append(chain[step * 3 : step * 3 + 80])
    docs += [passage + rng.choices(vocabulary, k=k) for k in (5, 10, 14, 15, 16, 30, 60)]
    docs += [["a", "b"], ["a", "b"], ["a", "c"], ["a"], ["x"] * 40, ["x"] * 41, ["x"] * 60]
    return [(i, " ".join(words)) for i, words in enumerate(docs)]


def test_classes_match_all_pairs(made, corpus):
    got = {r["doc_id"]: r["class_id"] for r in prob_minhash.classes(made(corpus)).collect()}
    assert got == brute_classes(corpus)


def test_large_group_and_common_passage(made):
    rng = random.Random(9)
    words = [f"w{i}" for i in range(120)]
    docs = [(i, " ".join(words)) for i in range(300)]
    docs += [(1000 + i, " ".join(words[:i] + [f"x{i}"] + words[i + 1 :])) for i in range(100)]
    docs += [(2000 + i, " ".join(words[:60] + [f"y{i}_{rng.random()}_{j}" for j in range(40)])) for i in range(100)]
    got = {r["doc_id"]: r["class_id"] for r in prob_minhash.classes(made(docs)).collect()}
    assert {got[i] for i, _ in docs if i < 2000} == {0}
    assert all(got[i] == i for i, _ in docs if i >= 2000)


def test_short_pairs_are_not_lost_to_their_bits(made):
    """4 shingles and the same with one more: similarity 0.8, but the bits of 62 registers differ."""
    for number in (15602, 16007):
        words = [f"w{number}x{i}" for i in range(9)]
        hashed = Hasher()
        sets = [shingles(hashed(w)) for w in (words[:8], words)]
        one, two = prob_minhash.bit_planes(sketch(sets)).reshape(2, 2, -1)
        assert similarity(*sets) == pytest.approx(0.8)
        assert sum(int(x).bit_count() for x in (one ^ two).view(np.uint64)[0] | (one ^ two).view(np.uint64)[1]) == 62
        got = prob_minhash.classes(made([(1, " ".join(words[:8])), (2, " ".join(words))])).collect()
        assert {r["doc_id"]: r["class_id"] for r in got} == {1: 1, 2: 1}


def test_few_shingles():
    assert prob_minhash._is_few(np.ones(31)) and not prob_minhash._is_few(np.ones(32))
    # A phrase that outweighs the rest makes a text of many shingles one of few.
    assert prob_minhash._is_few(np.append(np.ones(48), 12.0))


def test_query(spark, folder, documents):
    got = {r["doc_id"]: r["class_id"] for r in entry.QUERIES["op2_prob_minhash"](spark, folder).collect()}
    assert got == brute_classes(documents)


def brute_similarity(a, b):
    x, y = dict(zip(*map(list, a))), dict(zip(*map(list, b)))
    both = set(x) | set(y)
    shared = set(x) & set(y)
    return sum(1 / sum(max(x.get(j, 0) / x[i], y.get(j, 0) / y[i]) for j in both) for i in shared)


def test_similarity_and_its_estimate():
    rng = np.random.default_rng(3)
    for n, overlap in ((5, 3), (40, 30), (200, 20), (1, 1)):
        items = rng.integers(0, 1 << 62, 2 * n).astype(np.uint64)
        a = np.sort(items[:n]), rng.integers(1, 6, n).astype(float)
        b = np.sort(items[n - overlap : 2 * n - overlap]), rng.integers(1, 6, n).astype(float)
        exact = similarity(a, b)
        assert exact == pytest.approx(brute_similarity(a, b))
        s = sketch([a, b], registers=4000)
        assert (s[0] == s[1]).mean() == pytest.approx(exact, abs=0.04)
    same = np.arange(10, dtype=np.uint64), np.ones(10)
    part = np.arange(5, dtype=np.uint64), np.ones(5)
    assert similarity(same, part) == pytest.approx(0.5)


def test_sketch_does_not_depend_on_the_batch():
    rng = np.random.default_rng(8)
    sets = [(rng.integers(0, 1 << 62, n).astype(np.uint64), np.ones(n)) for n in (1, 3, 50, 2000, 0)]
    together = sketch(sets)
    for i, one in enumerate(sets):
        assert np.array_equal(sketch([one])[0], together[i])
    assert (together[:4] != 0).all() and (together[4] == 0).all()


def test_components(spark):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(60)] + [(100 + rng.randrange(40), 100 + rng.randrange(40)) for _ in range(60)] + [(7, 7)]
    links += [(500, 600 + i) for i in range(200)]
    root = {x: x for link in links for x in link}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        low, high = sorted((find(a), find(b)))
        root[high] = low
    got = {r["u"]: r["v"] for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {x: find(x) for x in root if find(x) != x}


def test_edges(edges, nothing):
    rows = {r["doc_id"]: r["class_id"] for r in prob_minhash.classes(edges).collect()}
    assert rows == {1: 1, 2: 2, 3: 3, 4: 4, 5: 4, 6: 6, 7: 7, 8: 8}
    kept = prob_minhash.keep(edges)
    assert kept.columns == edges.columns
    assert sorted(r["doc_id"] or -1 for r in kept.collect()) == [-1, 1, 2, 3, 4, 6, 7, 8]
    assert prob_minhash.classes(nothing).count() == 0 and prob_minhash.keep(nothing).count() == 0


def test_rows_are_kept_by_id_and_text(made):
    one, two, three = (" ".join(f"{c}{i}" for i in range(30)) for c in "abc")
    rows = [
        (7, one), (7, two), (7, one), (8, two), (None, one), (None, three), (None, three), (None, three + " more"),
        (9, ""), (9, None), (9, ""), (None, None), (None, " "), (5, "z"), (5, ""),
    ]
    kept = sorted(map(str, prob_minhash.keep(made(rows)).collect()))
    named = [(7, one), (7, two), (9, ""), (9, None), (None, None), (None, " "), (5, "z"), (5, "")]
    either = [(None, three), (None, three + " more")]
    texts = [sorted(map(str, made([*named, row]).collect())) for row in either]
    assert kept in texts
    classed = prob_minhash.all_classes(made(rows)).collect()
    assert len(classed) == len(rows) and [r["class_id"] for r in classed if r["doc_id"] is None].count(7) == 1
    assert {(r["doc_id"], r["class_id"]) for r in classed if r["doc_id"] is not None} == {(7, 7), (8, 7), (9, 9), (5, 5)}
