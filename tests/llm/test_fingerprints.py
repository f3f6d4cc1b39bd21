import random
import re

import numpy as np
import pytest
import xxhash

from retailloom.llm import fingerprints as fp
from tests.llm.test_near_duplicates import LOWER, changed


def plain_print(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", (text or "").translate(LOWER)) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def brute(prints, least=None):
    """The smallest position, or ``least`` of one, that each reaches by links of at most four bits."""
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, x in enumerate(prints):
        for j in range(i):
            if (x ^ prints[j]).bit_count() <= 4:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def signed(x):
    return x - (1 << 64) if x >= 1 << 63 else x


def near_prints(seed, groups=20, members=15):
    rng = random.Random(seed)
    out = [0, 1, (1 << 64) - 1, 1 << 63, 0xF, 0x1F << 59]
    for _ in range(groups):
        x = rng.getrandbits(64)
        for _ in range(rng.randint(1, members)):
            y = x
            for bit in rng.sample(range(64), rng.randint(0, 5)):
                y ^= 1 << bit
            out.append(y)
            x = y if rng.random() < 0.2 else x  # chains
    return out


def test_rotation_of_any_few_errors_keeps_the_budgets():
    rng = random.Random(1)
    for _ in range(3000):
        errors = rng.sample(range(64), 4) if rng.random() < 0.7 else [rng.randrange(64)] * 2
        places = set(errors)
        kept = 0
        for turn in range(5):
            moved = sorted((p - fp._turned(turn)) % 64 for p in places)  # from the top of the rotated word
            kept += all(sum(p < depth for p in moved) <= fp.budget(turn, depth) for depth in range(1, 65))
        assert kept >= 1


@pytest.mark.parametrize("seed,node", [(1, 1 << 14), (2, 1 << 14), (3, 4), (4, 2)])
def test_links_equal_brute_force(spark, seed, node):
    """Small nodes send the descent through Spark, down to single fingerprints."""
    prints = sorted(set(near_prints(seed)), key=signed)
    if node < 10:  # one head in common, so that its bucket is large
        prints = sorted({p & (1 << 51) - 1 | 5 << 51 for p in prints[:120]}, key=signed)
    df = spark.createDataFrame([(signed(p),) for p in prints], "print long")
    found = [(r["a"], r["b"]) for r in fp.links(df, node).collect()]
    at = {signed(p): i for i, p in enumerate(prints)}
    assert all((prints[at[a]] ^ prints[at[b]]).bit_count() <= 64 for a, b in found)
    labels = fp.merged(np.arange(len(prints)), np.array([at[a] for a, _ in found], int), np.array([at[b] for _, b in found], int))
    assert labels.tolist() == brute(prints)


def test_a_dense_group_gives_a_forest(spark):
    x = random.Random(3).getrandbits(64)
    prints = {x} | {x ^ (1 << i) ^ (1 << j) for i in range(64) for j in range(i)}
    df = spark.createDataFrame([(signed(p),) for p in prints], "print long").repartition(4)
    rows = fp.links(df).collect()
    assert len(rows) <= 5 * len(prints)
    ids = {signed(p): i for i, p in enumerate(prints)}
    labels = fp.merged(np.arange(len(ids)), np.array([ids[r["a"]] for r in rows]), np.array([ids[r["b"]] for r in rows]))
    assert set(labels.tolist()) == {0}


def test_documents_equal_brute_force(documents):
    rng = random.Random(5)
    texts = {}
    for group in range(25):
        words = [f"W{rng.randrange(300)}" for _ in range(rng.randint(0, 120))]
        for _ in range(rng.randint(1, 8)):
            texts[900 - len(texts)] = rng.choice([" ", "\n\t", " \x0b"]).join(changed(rng, words, rng.choice([0, 0, 1, 2])) if words else [])
    ids = sorted(texts)
    prints = [plain_print(texts[i]) for i in ids]
    expected = {i: (prints[n], ids[c]) for n, (i, c) in enumerate(zip(ids, brute(prints)))}
    found = {r["doc_id"]: (r["print"] % (1 << 64), r["component_id"]) for r in fp.simhash_components(documents(texts.items())).collect()}
    assert found == expected and len({c for _, c in found.values()}) < len(found)


def test_nulls_empties_repeats_letters_and_large_ids(documents, empty):
    docs = documents([(7, None), (3, " \n"), (9, "One"), (8, "one"), (None, "ONE"), (8, "one"), (5, "É"), (4, "é"),
                      (2**60 + 1, "a b c d e f"), (None, "w" * 100_000 + " x y z a")])
    found = sorted(((r["doc_id"], r["component_id"]) for r in fp.simhash_components(docs).collect()), key=str)
    assert found == sorted([(7, 3), (3, 3), (9, 8), (8, 8), (None, 8), (8, 8), (5, 5), (4, 4), (2**60 + 1, 2**60 + 1),
                            (None, None)], key=str)
    assert fp.simhash_components(empty).collect() == []


def test_long_texts():
    rng = random.Random(2)
    text = " ".join(f"w{rng.randrange(5000)}" for _ in range(300_000))
    assert fp.fingerprint(text.encode()) == plain_print(text)
