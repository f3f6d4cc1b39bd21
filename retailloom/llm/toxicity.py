"""Toxic text: a linear classifier learnt from confirmed toxic examples and unlabelled text.

The risk is the non-negative positive-unlabelled one: with the class prior p, the positives' loss counts p, and the
negatives' loss is the unlabelled texts' minus p times the positives', never below nought.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailloom.llm.common import as_numbers, as_text, in_test_fold
from retailloom.llm.words import coded, slices
from retailloom.session import materialize

BITS = 18
POSITIVES, UNLABELLED = 2_000, 6_000  # rows that the model is fitted on, at most
THRESHOLD = 0.5
PRIOR = 0.1  # where no label tells
STEPS, RATE, DECAY = 150, 0.1, 1e-3
RARE, TELLING = 4, 0.4
STEMS = (4, 5, 6)  # a word counts as itself and as its first letters


def _parts(word: str) -> list[str]:
    word = word.lower().strip(".,;:!?\"'()[]{}*#%&$-_")
    return [f"={word}", *[f"{n}{word[:n]}" for n in STEMS if len(word) > n]]


def _hashed(distinct: list[str]) -> np.ndarray:
    """One row per word: its features, and the number of features (an entry without weight) to fill up."""
    out = np.full((len(distinct), 1 + len(STEMS)), 1 << BITS, dtype=np.int64)
    for i, word in enumerate(distinct):
        for k, part in enumerate(_parts(word)):
            out[i, k] = xxhash.xxh32_intdigest(part.encode("utf-8", "surrogatepass")) & ((1 << BITS) - 1)
    return out


def _pairs(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, word) once each, and the words' features."""
    document, codes, distinct = coded(texts)
    once = pd.unique(document.astype(np.int64) * max(1, len(distinct)) + codes)
    return once // max(1, len(distinct)), once % max(1, len(distinct)), _hashed(distinct)


def _in_parts(texts: list[str], size: int = 512):
    """For some texts at a time: their first place, and of each different word its text and features."""
    for at in range(0, len(texts), size):
        document, word, hashed = _pairs(texts[at:at + size])
        yield at, document, hashed[word]


@dataclass
class Model:
    weights: np.ndarray
    bias: float

    def scores(self, texts: list[str]) -> np.ndarray:
        document, word, hashed = _pairs(texts)
        worth = np.append(self.weights, 0.0)[hashed].sum(axis=1)
        margin = self.bias + np.bincount(document, worth[word], len(texts))
        return 1 / (1 + np.exp(-np.clip(margin, -35, 35)))


def train(positives: list[str], unlabelled: list[str], prior: float) -> Model:
    """Adam on the whole risk, with logistic losses. Only telling features have a weight: in ``RARE`` positives at
    least, and with a share of toxic texts among those that have it, estimated from the prior and both samples, of
    ``TELLING`` at least. Both counts of that share have one added, so a feature of toxic texts alone always has a
    weight, however rare it or toxicity is. When the negatives' part of the risk falls below nought, the step goes up
    its gradient instead, which undoes over-fitting."""
    if not positives or not unlabelled:
        return Model(np.zeros(1 << BITS, np.float32), float(np.log(prior / (1 - prior))))
    texts, np_ = positives + unlabelled, len(positives)
    counts = np.zeros((2, (1 << BITS) + 1), dtype=np.int64)
    for at, d, own in _in_parts(texts):
        of_positive = np.repeat(d + at < np_, own.shape[1])
        for kind in (0, 1):
            counts[kind] += np.bincount(own.ravel()[of_positive == kind], minlength=(1 << BITS) + 1)
    telling = _telling(counts, np_, len(unlabelled), prior)
    document, index = [np.empty(0, np.int32)], [np.empty(0, np.int32)]
    for at, d, own in _in_parts(texts):  # once more, as the telling features alone are few
        row, column = np.nonzero(telling[own])
        document.append((d[row] + at).astype(np.int32))
        index.append(own[row, column].astype(np.int32))
    return _weighted(np.concatenate(document), np.concatenate(index), np_, len(texts), prior)


def _telling(counts: np.ndarray, positives: int, unlabelled: int, prior: float) -> np.ndarray:
    """Whether a feature has a weight, by how often unlabelled texts (first row) and positives (second) have it."""
    expected = prior * counts[1] / positives * unlabelled  # toxic ones among the unlabelled texts that have a feature
    telling = (counts[1] >= RARE) & (expected + 1 >= TELLING * (counts[0] + 1))
    telling[1 << BITS] = False
    return telling


def _weighted(document: np.ndarray, index: np.ndarray, np_: int, n: int, prior: float) -> Model:
    """The model of ``n`` texts, the first ``np_`` of them positives, by the (document, feature) pairs of the telling
    features."""
    names, index = np.unique(index, return_inverse=True)
    w, bias, m, v = np.zeros(len(names)), -1.0, np.zeros(len(names) + 1), np.zeros(len(names) + 1)
    positive = np.arange(n) < np_
    for step in range(1, STEPS + 1):
        g = bias + np.bincount(document, w[index], n)
        s = 1 / (1 + np.exp(-np.clip(g, -35, 35)))
        loss = np.logaddexp(0, np.clip(g, -35, 35))  # of a text taken as negative
        negative_risk = loss[~positive].mean() - prior * loss[positive].mean()
        as_negative = np.where(positive, -prior / np_, 1 / (n - np_)) * s
        as_positive = np.where(positive, -prior / np_, 0.0) * (1 - s)
        by_text = as_positive + as_negative if negative_risk >= 0 else -as_negative
        grad = np.append(np.bincount(index, by_text[document], len(names)) + DECAY * w * prior, by_text.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        move = RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
        w, bias = w - move[:-1], bias - move[-1]
    weights = np.zeros(1 << BITS, np.float32)
    weights[names] = w
    return Model(weights, float(bias))


def _features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Each text's features in the order of its words, and last the number of features, which counts the text itself."""
    for batch in batches:
        for part in slices(batch, "text"):
            texts = list(part["text"])
            document, word, hashed = _pairs(texts)
            ends = np.searchsorted(document, np.arange(1, len(texts)))
            own = [np.append(x[x < 1 << BITS], 1 << BITS).astype(np.int32) for x in np.split(hashed[word], ends)]
            yield part[["doc_id", "confirmed", "text_hash"]].assign(features=own)


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", positives: int = POSITIVES,
        unlabelled: int = UNLABELLED) -> Model:
    """Learn from at most ``positives`` confirmed rows and ``unlabelled`` others, all outside the test fold and in
    the order of a hash of their ids. The class prior is the share of confirmed rows among all labelled ones
    outside the fold. The two lists of ids (under 200 KB) are broadcast, the documents are not shuffled.

    The sample's words are hashed and counted in tasks: of features in ``RARE`` positives at least the counts come to the
    driver, of the texts the telling features alone. The model is that of ``train`` on the same texts.
    """
    learnt = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~in_test_fold())
    ids = docs.where(F.col("doc_id").isNotNull() & ~in_test_fold()).select("doc_id")
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = materialize(
        learnt.where(F.col(label) == 1).select("doc_id").distinct().orderBy(*order).limit(positives)
        .withColumn("confirmed", F.lit(True))
        .unionByName(ids.distinct().orderBy(*order).limit(unlabelled).withColumn("confirmed", F.lit(False))), "chosen")
    counts = learnt.agg(F.count("*").alias("n"), F.sum(F.col(label).cast("int")).alias("ones")).first()
    prior = min(0.9, max(0.01, counts["ones"] / counts["n"])) if counts["n"] else PRIOR
    sample = (docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")
              .select("doc_id", "confirmed", F.xxhash64("text").alias("text_hash"), "text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, confirmed boolean, text_hash long, features array<int>"
    hashed = materialize(sample.mapInPandas(_features, schema), "features")
    often = (hashed.select("confirmed", F.explode("features").alias("feature")).groupBy("feature")
             .agg(F.count_if(~F.col("confirmed")).alias("unlabelled"), F.count_if("confirmed").alias("positive"))
             .where((F.col("positive") >= RARE) | (F.col("feature") == 1 << BITS)).toPandas())
    counts = np.zeros((2, (1 << BITS) + 1), dtype=np.int64)
    counts[:, often["feature"]] = often[["unlabelled", "positive"]].to_numpy().T
    n_unlabelled, n_positive = counts[:, 1 << BITS].tolist()
    if not n_positive or not n_unlabelled:
        return train([], [], prior)
    shared = docs.sparkSession.sparkContext.broadcast(_telling(counts, n_positive, n_unlabelled, prior))

    def told(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = shared.value
        for batch in batches:
            yield batch.assign(features=[x[own[x]] for x in batch["features"]])

    rows = hashed.mapInPandas(told, schema).toPandas().sort_values(["doc_id", "text_hash"])
    rows = pd.concat([rows[rows["confirmed"]], rows[~rows["confirmed"]]])
    features = [np.asarray(x, dtype=np.int32) for x in rows["features"]]
    document = np.repeat(np.arange(len(rows), dtype=np.int32), [len(x) for x in features])
    return _weighted(document, np.concatenate(features), n_positive, len(rows), prior)


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


def without_toxic(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score below the threshold, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            texts = batch.column("text").fill_null("").to_pandas().to_frame("text")
            scores = [own.scores(list(part["text"])) for part in slices(texts, "text")]
            yield batch.filter(pa.array(np.concatenate(scores) < threshold)) if scores else batch

    return docs.mapInArrow(kept, docs.schema)
