import random
import zlib
from array import array

import numpy as np
import pytest

from retailloom.llm import packing


@pytest.fixture(scope="module")
def model():
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(packing.default_tokenizer())
    found.encode_special_tokens = True
    return found


def whole(model, text):
    return [*model.encode(text or "", add_special_tokens=False).ids, 1]


ODD = ["", " ", "The the THE", "don't we'll I'm'd", "a\x1cb c\x1fd", "x\x85y z w　v", "é é ñ ñ",
       "<|endoftext|> <|startoftext|>x", "12 3.4 5,6 ½ ²", "İstanbul ΣΑΣ ß", "!!! ... ###a", "日本語 テスト", "𝒳y 😀😀",
       "a​b a­b", "tab\tnew\nline\r\n", "﻿bom", "'S 'T x's"]


def test_words_encode_like_whole_texts(model):
    tokenizer = packing.WordTokenizer(packing.default_tokenizer())
    rng = random.Random(4)
    texts = ODD + ["".join(rng.choice("ab 'sé.\n<|>9½ ñ") for _ in range(rng.randint(0, 80))) for _ in range(300)]
    assert [[*array("I", tokenizer.encode(t)), 1] for t in texts] == [whole(model, t) for t in texts]


def test_each_letter_is_parted_as_the_tokenizer_parts_it(model):
    tokenizer = packing.WordTokenizer(packing.default_tokenizer())
    for code in [*range(0x260), 0x300, 0x301, 0x345, 0x3a3, 0x212b, 0x2000, 0x3000, 0xfb01, 0x1d400]:
        for text in (chr(code), f"a{chr(code)}b", f"9{chr(code)}{chr(code)}.", f"._{chr(code)}'s", f" {chr(code)} X{chr(code)}"):
            assert [*array("I", tokenizer.encode(text)), 1] == whole(model, text), (hex(code), text)


def test_a_full_cache_starts_anew(model, monkeypatch):
    monkeypatch.setattr(packing, "CACHED_WORDS", 3)
    tokenizer = packing.WordTokenizer(packing.default_tokenizer())
    for texts in (["a b c"], ["c d e"], ["a f a"]):
        assert [[*array("I", tokenizer.encode(t)), 1] for t in texts] == [whole(model, t) for t in texts]


def test_long_parts_are_not_kept(model):
    """The cache is bounded in memory, not only in number."""
    tokenizer = packing.WordTokenizer(packing.default_tokenizer())
    text = "ab " + "x" * 50_000 + " " + "-" * 5_000 + " cd"
    for _ in range(2):
        assert [*array("I", tokenizer.encode(text)), 1] == whole(model, text)
    assert set(tokenizer.parts) == {"ab", "cd"}


def test_frequent_words_are_looked_up_whole(model, monkeypatch):
    """A known word takes no parting; the caches stay within their bounds and start anew when the words change."""
    monkeypatch.setattr(packing, "CACHED_WORDS", 4)
    monkeypatch.setattr(packing, "CACHED_PARTS", 6)
    monkeypatch.setattr(packing, "RENEWED", 2)
    tokenizer = packing.WordTokenizer(packing.default_tokenizer())
    made = []
    make = tokenizer.words.make
    tokenizer.words.make = lambda word: made.append(word) or make(word)
    for _ in range(3):
        text = "The end. isn't _it?"
        assert [*array("I", tokenizer.encode(text)), 1] == whole(model, text)
    assert made == ["The", "end.", "isn't", "_it?"]
    for i in range(60):
        text = f"new{i}, éw{'x' * i}!? (n{i}) it's"
        assert [*array("I", tokenizer.encode(text)), 1] == whole(model, text)
        assert len(tokenizer.words) <= 4 and len(tokenizer.parts) <= 6
    assert "The" not in tokenizer.words


def check(rows, texts, model, capacity):
    by_sequence, by_doc = {}, {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        by_doc.setdefault(r["row"], []).append(r)
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    got = []
    for pieces in by_doc.values():
        pieces.sort(key=lambda r: r["piece"])
        got.append((str(pieces[0]["doc_id"]), tuple((r["start"], r["length"], r["ids_crc32"]) for r in pieces)))
    expected = []
    for doc_id, text in texts:
        ids = np.array(whole(model, text), dtype="<u4")
        expected.append((str(doc_id), tuple((a, len(ids[a:a + capacity]), zlib.crc32(ids[a:a + capacity].tobytes()))
                                            for a in range(0, len(ids), capacity))))
    assert sorted(got) == sorted(expected)
    return len(by_sequence)


def test_pieces_and_places(documents, model):
    rng = random.Random(1)
    texts = [(i, " ".join(rng.choice(["the", "quality", "of", "zxqv", "1998", "él"]) for _ in range(rng.randint(0, 60))))
             for i in range(150)] + [(7, "same text")] * 40 + [(None, None), (500, ""), (501, "long " * 900)]
    rows = packing.pack(documents(texts), capacity=128).collect()
    n = check(rows, texts, model, 128)
    assert n <= -(-sum(r["length"] for r in rows) // 128) + 1


def test_sequences_hold_the_ids(documents, model):
    texts = [(i, "word " * (i % 50) + f"nr {i}") for i in range(60)]
    rows = packing.sequences(documents(texts), capacity=64).collect()
    pieces = []
    for r in rows:
        assert len(r["ids"]) <= 64 and r["ends"][-1] == len(r["ids"])
        pieces += [tuple(r["ids"][a:b]) for a, b in zip([0, *r["ends"]], r["ends"])]
    assert sorted(pieces) == sorted(tuple(whole(model, t)) for _, t in texts)


def test_large_ids_beside_a_null_stay_exact(documents):
    docs = documents([(2**60 + 1, "a b"), (None, "c")], 1)
    assert {r["doc_id"] for r in packing.pack(docs).collect()} == {2**60 + 1, None}


def test_empty_table(empty):
    assert packing.pack(empty).collect() == []


@pytest.mark.parametrize("n", [1, 40, 3000])
def test_plan_uses_every_piece_once_and_few_sequences(n):
    rng = np.random.default_rng(n)
    lengths = np.clip(rng.lognormal(4, 1, n).astype(int), 1, 512)
    lengths[: n // 3] = 100
    histogram = {int(k): int((lengths == k).sum()) for k in np.unique(lengths)}
    made = packing.plan(histogram, 512)
    taken = {}
    for size, first, count in zip(made.length.tolist(), made.first.tolist(), made.count.tolist()):
        assert first == taken.get(size, 0)
        taken[size] = first + count
    assert taken == histogram
    assert made.sequences <= 1.02 * -(-int(lengths.sum()) // 512) + 1


def test_knapsack_equals_brute_force():
    from itertools import product

    lengths, worth, most = np.array([7, 5, 3]), np.array([7.1, 5.0, 3.2]), np.array([2, 3, 4])
    counts = packing._best_pattern(lengths, worth, most, 20)
    best = max(sum(c * w for c, w in zip(cs, worth)) for cs in product(*[range(m + 1) for m in most])
               if sum(c * s for c, s in zip(cs, lengths)) <= 20)
    assert (counts * lengths).sum() <= 20 and (counts <= most).all() and (counts * worth).sum() == pytest.approx(best)


def test_rounded_patterns_take_part():
    assert packing.plan({3: 1000, 5: 1000}, 8).sequences == 1000
    assert packing.plan({}, 8).sequences == 0


@pytest.mark.parametrize("copies", [1, 1000])
def test_nine_tenths_of_the_sequences_come_from_the_program(copies):
    rng = np.random.default_rng(5)
    lengths = np.clip(rng.lognormal(6, 1.2, 3000).astype(int), 1, 4096)
    histogram = {int(k): int((lengths == k).sum()) * copies for k in np.unique(lengths)}
    made = packing.plan(histogram)
    assert made.from_patterns >= 0.9 * made.sequences
    assert made.sequences <= 1.001 * -(-int(lengths.sum()) * copies // packing.CAPACITY) + 1


def test_short_pieces_are_kept_for_the_gaps_of_long_ones():
    assert packing.plan({3: 100, 6: 100}, 9).sequences == 100


def test_very_long_text_among_empty_ones(documents, model):
    texts = [(0, "quality of the text " * 60_000)] + [(i, "") for i in range(1, 30)]
    assert check(packing.pack(documents(texts), capacity=4096).collect(), texts, model, 4096) == 59
