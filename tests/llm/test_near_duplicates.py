import random
import re

import numpy as np
import pytest

from retailloom.llm import near_duplicates as nd
from retailloom.llm.graph import components

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, k):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", (text or "").translate(LOWER)) if x]
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} or ({tuple(w)} if w else set())


def brute(texts, k, percent):
    """The smallest linked id of each document, by comparing all of them."""
    ids = sorted(texts)
    sets, root = {i: shingles(texts[i], k) for i in ids}, {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for n, a in enumerate(ids):
        for b in ids[:n]:
            shared = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * shared >= percent * (len(sets[a]) + len(sets[b]) - shared):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def changed(rng, words, times):
    words = list(words)
    for _ in range(times):
        words[rng.randrange(len(words))] = f"n{rng.randrange(10**6)}"
    return words


def corpus(seed):
    rng = random.Random(seed)
    texts = {}
    for group in range(12):
        words = [f"w{rng.randrange(400)}" for _ in range(rng.randint(3, 150))]
        for copy in range(rng.randint(1, 14)):
            if copy % 3 == 2:  # chains: a copy of a copy
                words = changed(rng, words, rng.randint(0, 3))
            texts[len(texts)] = rng.choice([" ", "\n", "\t "]).join(changed(rng, words, rng.choice([0, 0, 1, 2, 5])))
    return texts


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("words,percent", [(3, 85), (5, 80)])
def test_equals_brute_force(documents, seed, words, percent):
    texts = corpus(seed)
    found = {r["doc_id"]: r for r in nd.near_duplicates(documents(texts.items()), words, percent).collect()}
    expected = brute(texts, words, percent)
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in found.items()} == expected
    assert all(r["kept"] == (i == r["component_id"]) for i, r in found.items())
    assert any(i != c for i, (_, c) in expected.items())


def test_exactly_at_the_threshold(documents):
    # 20 shingles against 17 of them: 17 / 20 = 85 %
    words = [f"a{i}" for i in range(22)]
    texts = {1: " ".join(words), 2: " ".join(words[:19]), 3: " ".join(words[:18])}
    assert {i: c for i, (_, c) in brute(texts, 3, 85).items()}[2] == 1
    found = {r["doc_id"]: r["component_id"] for r in nd.near_duplicates(documents(texts.items()), 3, 85).collect()}
    assert found == {i: c for i, (_, c) in brute(texts, 3, 85).items()}


def test_a_large_group_of_exact_and_near_copies(documents):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(120)]
    texts = {i: " ".join(changed(rng, words, i % 4)) for i in range(250)} | {i: "the same text again" for i in range(250, 500)}
    found = {r["doc_id"]: r["component_id"] for r in nd.near_duplicates(documents(texts.items())).collect()}
    assert found == {i: c for i, (_, c) in brute(texts, 5, 80).items()}


def test_nulls_empties_ties_repeats_and_letters(documents, empty):
    docs = documents([(1, None), (2, ""), (3, " \n"), (9, "One Two"), (8, "one  two"), (None, "ONE two"), (9, "One Two"),
                      (7, "É x y z"), (6, "é x y z"), (5, "one two"), (4, "x" * 50_000 + " y")])
    found = sorted(((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"])
                    for r in nd.near_duplicates(docs, 3, 85).collect()), key=str)
    assert found == sorted([(1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (9, 1, 8, False), (8, 1, 8, True),
                            (None, 1, 8, False), (9, 1, 8, False), (7, 2, 7, True), (6, 2, 6, True), (5, 1, 5, True),
                            (4, 1, 4, True)], key=str)
    assert nd.near_duplicates(empty).collect() == []
    kept = nd.without_near_duplicates(docs, 3, 85)
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 2, 3, 4, 5, 6, 7, 8] and kept.columns == docs.columns


def test_one_row_of_each_group_stays(documents):
    words = [f"w{i}" for i in range(60)]
    near = [" ".join(words[:60 - i]) for i in range(4)]
    docs = documents([(None, near[0]), (None, near[1]), (None, near[1]), (7, "own text here"), (7, "own text here"),
                      (7, "own text here too"), (8, None), (8, None), (9, near[0].replace("w", "v")), (9, near[1].replace("w", "v"))])
    kept = nd.without_near_duplicates(docs, 3, 85)
    found = sorted((r["doc_id"] or 0, (r["text"] or "")[:3]) for r in kept.collect())
    assert found == [(0, "w0 "), (7, "own"), (7, "own"), (8, ""), (8, ""), (9, "v0 ")] and kept.columns == docs.columns


def test_large_ids_beside_a_null_stay_exact(documents):
    docs = documents([(2**60 + 1, "a b c"), (2**60 + 3, "a b c"), (None, "c"), (5, None)], 1)
    found = {r["doc_id"]: r["component_id"] for r in nd.near_duplicates(docs).collect()}
    assert found == {2**60 + 1: 2**60 + 1, 2**60 + 3: 2**60 + 1, None: None, 5: 5}


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(100, 400)] + [(1000, i) for i in range(1001, 1400)] + [(7, 7)]
    rng.shuffle(edges)
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {i: 100 for i in range(100, 401)} | {i: 1000 for i in range(1000, 1400)}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_estimate_follows_the_similarity():
    rng = np.random.default_rng(0)
    for size in (5, 60, 1000, 20_000):
        for share in (0, 0.3, 0.8, 0.9, 1):
            wrong = 0
            for _ in range(20):
                pool = rng.integers(0, 1 << 64, 2 * size, dtype=np.uint64)
                shared = round(size * 2 * share / (1 + share))
                a, b = np.unique(pool[:size]), np.unique(pool[size - shared:2 * size - shared])
                _, bits = nd.signatures([a, b])
                bits = bits.view(np.uint64)
                true = shared / (2 * size - shared)
                found, _ = nd.estimate(bits[:1], bits[1:])
                wrong += abs(found[0] - true) > 0.1 + 1 / size
                if true >= 0.8:
                    assert nd.allowed(bits[:1], len(a), bits[1:], len(b), 80)[0]
            assert wrong == 0


def test_blocks_of_a_large_bucket(documents, monkeypatch):
    monkeypatch.setattr(nd, "BLOCK", 16)
    monkeypatch.setattr(nd, "STARS", ((0, 0),))
    rng = random.Random(4)
    words = [f"w{i}" for i in range(100)]
    texts = {i: " ".join(changed(rng, words, i % 6)) for i in range(120)}
    found = {r["doc_id"]: r["component_id"] for r in nd.near_duplicates(documents(texts.items())).collect()}
    assert found == {i: c for i, (_, c) in brute(texts, 5, 80).items()}


def test_the_driver_collects_between_the_rounds(documents, monkeypatch):
    """Without it the heap grows to its limit: each round plans and runs some twenty queries."""
    collected, labels = [], []
    keep = nd.materialize
    monkeypatch.setattr(nd, "unused_shuffles_go", lambda spark: collected.append(len(labels)))
    monkeypatch.setattr(nd, "materialize", lambda df, label, *rest: labels.append(label) or keep(df, label, *rest))
    nd.near_duplicates(documents([(1, "a b c d e f"), (2, "a b c d e f"), (3, "x")]), 3, 80)
    opened = [at + 1 for at, label in enumerate(labels) if label.startswith("open-")]
    assert len(opened) >= len(nd.STARS) and set(opened) <= set(collected)
    assert sum(at in collected for at in (i + 1 for i, label in enumerate(labels) if label == "links")) >= len(nd.STARS)
