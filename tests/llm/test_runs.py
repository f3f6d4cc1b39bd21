import hashlib
import random
import zlib

import pytest

from retailloom.llm import runs as pr
from retailloom.llm.queries import QUERIES
from retailloom.llm.common import table


def brute(words):
    """Every run by its definition: for each lag the maximal stretches, kept if no smaller lag is a period of them."""
    n, found = len(words), []
    for q in range(1, n // 3 + 1):
        i = q
        while i < n:
            if words[i] != words[i - q]:
                i += 1
                continue
            first = i
            while i < n and words[i] == words[i - q]:
                i += 1
            start, length = first - q, i - first + q
            stretch = words[start:start + length]
            if length >= max(24, 3 * q) and not any(stretch[p:] == stretch[:-p] for p in range(1, q)):
                found.append((start, length, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def kept(words, found):
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def periodic(rng):
    """Runs of many periods side by side, inside each other and broken."""
    words = []
    for _ in range(rng.randint(1, 6)):
        block = [rng.choice("abc") for _ in range(rng.choice([1, 2, 3, 5, 7, 8, 9, 15, 16, 17, 20, 31, 33, 40]))]
        if rng.random() < 0.4:
            block = block * rng.randint(2, 9) + [rng.choice("abcd")]
        words += block * rng.randint(1, 12) + block[:rng.randrange(len(block))]
        if words and rng.random() < 0.3:
            words[rng.randrange(len(words))] = "x"
        words += [f"u{rng.randrange(9)}" for _ in range(rng.choice([0, 0, 1, 30]))]
    return words


@pytest.mark.parametrize("seed", range(6))
def test_equals_brute_force(seed):
    rng = random.Random(seed)
    texts = [periodic(rng) for _ in range(40)] + [["a"] * n for n in (0, 1, 15, 16, 23, 24, 25, 200)] + [
        [rng.choice("ab") for _ in range(400)] for _ in range(5)]
    found = pr.periodic_runs([" ".join(w).encode() for w in texts])
    for words, (runs, rest) in zip(texts, found):
        assert runs == brute(words)
        assert rest.decode() == kept(words, runs)
    assert sum(len(r) for r, _ in found) > 40


def test_thresholds_of_length_and_period():
    for q in range(1, 70):
        block = [f"b{i}" for i in range(q)]
        for length in {max(24, 3 * q) - 1, max(24, 3 * q)}:
            words = ["s"] + (block * 30)[:length] + ["e"]
            (runs, _), = pr.periodic_runs([" ".join(words).encode()])
            assert runs == ([(1, length, q)] if length >= max(24, 3 * q) else [])


def test_very_long_and_very_repetitive_texts():
    one, = pr.periodic_runs([b"same " * 1_000_000])
    assert one == ([(0, 1_000_000, 1)], b"same")
    block = [f"w{i % 97}" for i in range(5000)]
    (runs, rest), = pr.periodic_runs([" ".join(block + ["x"] + block * 40).encode()])
    assert (5001, 200_000, 5000) in runs and (0, 5000, 97) in runs
    assert len(rest.split()) < 300


def test_documents(documents, empty):
    line = "to be or not "
    docs = documents([(1, None), (2, ""), (3, " \n"), (4, line * 6), (4, line * 6), (None, "A a " * 12 + "É"), (5, "A a " * 11 + "a")])
    found = sorted(((r["doc_id"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in pr.find_runs(docs).collect()), key=str)
    assert found == sorted([(1, [], ""), (2, [], ""), (3, [], ""), (4, [(0, 24, 4)], "to be or not"), (4, [(0, 24, 4)], "to be or not"),
                            (None, [(0, 24, 2)], "A a É"), (5, [], ("A a " * 11 + "a"))], key=str)
    assert pr.find_runs(empty).collect() == []


def planted(doc_id, text):
    words = text.split(" ") if text else []
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    g = h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i if i < a else a + (i - a) % p] for i in range(n)]


def test_query_equals_brute_force(spark, folder):
    texts = {r["doc_id"]: r["text"] for r in table(spark, folder, "documents").collect()}
    found = {r["doc_id"]: r for r in QUERIES["op13_periodic_runs"](spark, folder).collect()}
    assert set(found) == set(texts)
    some = 0
    for doc_id, text in texts.items():
        words = planted(doc_id, " ".join((text or "").split()))
        (runs, _), = pr.periodic_runs([" ".join(words).encode()])
        if len(words) < 400:
            assert runs == brute(words)
        row = found[doc_id]
        best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
        assert (row["start"], row["length"], row["period"]) == (best or (None,) * 3)
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        assert row["n_runs"] == len(runs) and row["runs_sha256"] == hashlib.sha256(lines.encode()).hexdigest()
        assert row["exponent_milli"] == (1000 * best[1] // best[2] if best else None)
        assert row["collapsed_sha256"] == hashlib.sha256(kept(words, runs).encode()).hexdigest()
        some += bool(runs)
    assert some > 5


def test_planting_with_nulls(documents):
    rows = [(i, "a b c d e f g") for i in range(60)] + [(None, "x y"), (500, None), (501, "  ")]
    found = {(r["doc_id"], r["text"]) for r in pr.with_planted_runs(documents(rows)).collect()}
    assert found == {(i, " ".join(planted(i, t))) for i, t in rows[:60]} | set(rows[60:])


def test_strongest_is_exact(spark):
    rows = [([(0, 30, 7), (5, 60, 14), (9, 24, 8)],), ([(3, 27, 9), (1, 24, 8)],), ([],)]
    df = spark.createDataFrame(rows, "runs array<struct<start: long, length: long, period: long>>")
    assert [r["best"] and tuple(r["best"]) for r in df.select(pr.strongest(df["runs"]).alias("best")).collect()] == [
        (0, 30, 7), (3, 27, 9), None]
