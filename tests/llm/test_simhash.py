import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tillcast.llm import entry, simhash


def plain_print(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    shingles = [" ".join(words[i : i + 3]) for i in range(max(len(words) - 2, 1))] if words else []
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_roots(words):
    """Smallest place in reach of each, by comparing all pairs."""
    words = np.array(words, np.uint64)
    root = list(range(len(words)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(words)):
        for j in np.flatnonzero(np.bitwise_count(words[i + 1 :] ^ words[i]) <= 3).tolist():
            a, b = sorted((find(i), find(i + 1 + j)))
            root[b] = a
    return [find(i) for i in range(len(words))]


def brute(rows):
    prints = [plain_print(text) for _, text in rows]
    roots = plain_roots(prints)
    least = {}
    for (doc, _), r in zip(rows, roots):
        least[r] = min((x for x in (doc, least.get(r)) if x is not None), default=None)
    return sorted([(doc, f"{p:016x}", least[r]) for (doc, _), p, r in zip(rows, prints, roots)], key=repr)


def got(docs):
    return sorted(map(tuple, simhash.classes(docs).collect()), key=repr)


def scattered(seed, centres, each, flips):
    pick = random.Random(seed)
    out = []
    for _ in range(centres):
        centre = pick.getrandbits(64)
        for _ in range(each):
            word = centre
            for bit in pick.sample(range(64), pick.randrange(flips + 1)):
                word ^= 1 << bit
            out.append(word)
    return sorted(set(out))


def linked(spark, words, limit):
    rows = spark.createDataFrame([(simhash._signed(w),) for w in words], "print long").repartition(3)
    at = {simhash._signed(w): i for i, w in enumerate(words)}
    pairs = [(at[r.u], at[r.v]) for r in simhash.links(rows, limit).collect()]
    for u, v in pairs:
        assert u != v
    u, v = (np.array([p[i] for p in pairs], int) for i in (0, 1))
    return simhash._roots(len(words), u, v).tolist()


def test_query_matches_brute_force(spark, folder, documents):
    rows = entry.QUERIES["op13_simhash_pivots"](spark, folder).collect()
    assert sorted(map(tuple, rows), key=repr) == brute(documents)


def test_hash_is_the_engines_own(spark):
    texts = ["ein wort", "zwei drei vier", "ünïcödé"]
    rows = spark.createDataFrame([(t,) for t in texts], "s string").select("s", F.xxhash64("s").alias("h")).collect()
    assert len(rows) == 3
    for row in rows:
        assert [h.view(np.int64).tolist() for h in simhash._hashes(row.s, 9)] == [[row.h]]


@pytest.mark.parametrize("limit", [4096, 40, 6])
def test_links_against_all_pairs(spark, limit):
    """Dense balls of fingerprints; small limits cut buckets at all depths and into tiles."""
    words = scattered(1, 40, 20, 5) + scattered(2, 1, 120, 4) + scattered(3, 150, 1, 0)
    words = sorted(set(words) | {0, 2**64 - 1, 7, 2**63})
    assert linked(spark, words, limit) == plain_roots(words)


def test_forest_of_one_dense_bucket(monkeypatch):
    words = np.array(scattered(5, 2, 700, 5), np.uint64)
    first = np.bitwise_count(words ^ simhash.pivots(1)[0])
    words = words[np.argsort(first, kind="stable")]
    expected = plain_roots(words)
    for most in (500_000, 10):
        monkeypatch.setattr(simhash, "_FOREST", most)
        u, v = simhash.forest(words, np.full(len(words), len(words)))
        assert len(u) < len(words)
        assert simhash._roots(len(words), u, v).tolist() == expected


def test_slices_cover_every_three_bits():
    levels = simhash.slices(3)
    assert [len(level) for level in levels] == [4, 16, 64]
    assert {mask.bit_count() for mask in levels[2]} == {37}
    pick = random.Random(1)
    for _ in range(500):
        change = sum(1 << b for b in pick.sample(range(64), 3))
        for level in levels:
            assert any(not mask & change for mask in level)


def test_edges(edges, nothing, spark):
    rows = [(r.doc_id, r.text) for r in edges.select("doc_id", "text").collect()]
    assert got(edges) == brute(rows)
    zero = [r for r in got(edges) if r[1] == "0" * 16]
    assert {r[0] for r in zero} >= {1, 2, 3} and {r[2] for r in zero} == {1}
    assert got(nothing) == []
    lone = spark.createDataFrame([(None, "a lone text without any id")], "doc_id long, text string")
    assert got(lone) == brute([(None, "a lone text without any id")]) and got(lone)[0][2] is None


def test_letters_and_blanks(made):
    rows = [
        (1, "Alpha BETA gamma delta"),
        (2, "alpha\tbeta\x0b gamma\r\n\fdelta "),
        (3, "alpha beta gamma delta"),
        (4, "ÄLPHA beta gamma delta"),
        (5, "älpha beta gamma delta"),
        (6, "one two"),
        (7, "　 \x1c"),
    ]
    assert got(made(rows)) == brute(rows)
    assert simhash.fingerprint(rows[0][1]) == simhash.fingerprint(rows[1][1])


def test_long_text_in_chunks(monkeypatch):
    text = " ".join(str(i * i % 977) for i in range(3000))
    expected = plain_print(text)
    assert simhash.fingerprint(text) == expected
    monkeypatch.setattr(simhash, "_CHUNK", 7)
    assert simhash.fingerprint(text) == expected
