"""Text quality: logistic regression on hashed word n-grams, trained with follow-the-regularised-leader updates."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailloom.llm.common import as_numbers, as_text, in_test_fold, training_rows
from retailloom.llm.words import coded, slices

BITS = 18
ROWS = 6_000  # labelled rows that the model is fitted on, at most
THRESHOLD = 0.3
ALPHA, BETA, L1, L2, EPOCHS = 1.0, 1.0, 1e-4, 1e-3, 3
_RUNS = (re.compile(r"[^\W\d_]*[^\W\d_A-ZÀ-ÖØ-Þ]+[^\W\d_]*"), re.compile(r"[A-ZÀ-ÖØ-Þ]+"), re.compile(r"\d+"))


def _shape(word: str) -> str:
    """Letters as one x (X if all are capitals), digits as one 9, other characters as they are."""
    for run, mark in zip(_RUNS, ("x", "X", "9")):
        word = run.sub(mark, word)
    return word


def _mixed(a: np.ndarray, b: np.ndarray, salt: int) -> np.ndarray:
    h = (a * np.uint64(0x9E3779B97F4A7C15)) ^ (b + np.uint64(salt))
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, hashed feature, value) of all word n-grams: words and word pairs, the same by shape, and whether
    neighbours are equal. Values are shares of the document's words, so every document weighs the same."""
    document, codes, distinct = coded(texts)
    if not len(codes):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    word, shape = (np.array([xxhash.xxh64_intdigest(form(w).encode("utf-8", "surrogatepass")) for w in distinct],
                            np.uint64)[codes] for form in (str.lower, _shape))
    share = 1.0 / np.bincount(document)[document]
    pair = document[1:] == document[:-1]
    zero = np.zeros(1, np.uint64)
    same = (word[1:] == word[:-1]).astype(np.uint64)
    parts = [_mixed(word, zero, 1), _mixed(shape, zero, 2), _mixed(word[:-1], word[1:], 3)[pair],
             _mixed(shape[:-1], shape[1:], 4)[pair], _mixed(same, zero, 5)[pair]]
    own = document[1:][pair]
    index = np.concatenate(parts) & np.uint64((1 << BITS) - 1)
    return (np.concatenate([document, document, own, own, own]), index.astype(np.int64),
            np.concatenate([share, share, *[share[1:][pair]] * 3]))


@dataclass
class Model:
    weights: np.ndarray
    bias: float

    def scores(self, texts: list[str]) -> np.ndarray:
        document, index, value = features(texts)
        margin = self.bias + np.bincount(document, self.weights[index] * value, len(texts))
        return 1 / (1 + np.exp(-np.clip(margin, -35, 35)))


def train(texts: list[str], labels: np.ndarray) -> Model:
    """FTRL-proximal, one document after the other, each coordinate with its own rate. Without a label of either
    kind the score is the share of ones, or a half."""
    share = (labels.sum() + 1) / (len(labels) + 2)
    bias = float(np.log(share / (1 - share)))
    z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)

    def weight(index):
        w = -(z[index] - np.sign(z[index]) * L1) / ((BETA + np.sqrt(n[index])) / ALPHA + L2)
        return np.where(np.abs(z[index]) > L1, w, 0.0)

    if 0 < labels.sum() < len(labels):
        rows = []
        for at in range(0, len(texts), 256):
            part = texts[at:at + 256]
            document, index, value = features(part)
            order = np.argsort(document, kind="stable")
            ends = np.searchsorted(document[order], np.arange(len(part) + 1))
            for d in range(len(part)):
                own = order[ends[d]:ends[d + 1]]
                found, back = np.unique(index[own], return_inverse=True)
                share_of = np.bincount(back, value[own], len(found))
                rows.append((found.astype(np.int32), share_of.astype(np.float32), labels[at + d]))
        for _ in range(EPOCHS):
            for index, value, label in rows:
                w = weight(index)
                error = 1 / (1 + np.exp(-np.clip(bias + w @ value, -35, 35))) - label
                g = error * value
                z[index] += g - (np.sqrt(n[index] + g * g) - np.sqrt(n[index])) / ALPHA * w
                n[index] += g * g
    return Model(weight(np.arange(1 << BITS)).astype(np.float32), bias)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = ROWS) -> Model:
    """The model of at most ``rows`` labelled rows outside the test fold, in the order of a hash of their ids."""
    sample = training_rows(docs, labels, label, rows).toPandas().sort_values(["doc_id", "text"])
    return train(list(sample["text"]), sample["label"].to_numpy(np.float64))


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted of every row. Null texts count as empty, and an empty text gets the
    score of the bias; a null id is held out. Repeated rows get equal scores. Other columns are not read."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2^18 weights, whatever the corpus

    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = shared.value
        for batch in batches:
            for part in slices(batch, "text"):
                found = own.scores(list(part["text"]))
                yield pd.DataFrame({"doc_id": part["doc_id"], "held_out": part["held_out"], "score": found,
                                    "predicted": (found >= threshold).astype("int32")})

    source = docs.select(as_text("doc_id"), in_test_fold().alias("held_out"), F.coalesce("text", F.lit("")).alias("text"))
    found = source.mapInPandas(scored, "doc_id string, held_out boolean, score double, predicted int")
    return as_numbers(found, "doc_id")
