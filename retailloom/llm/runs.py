"""Periodic runs of words by a sparse diagonal program: a word that equals the one ``lag`` words before lengthens the
match on that lag's diagonal, and a diagonal that ends with enough matches gives a run.

Most equal words are chance, and a text of one word has a match on every diagonal at every word. So the program looks
at windows of words instead. A run of smallest period q and length >= max(24, 3q) matches at lag q on at least
max(24 - q, 2q) words in a row: with windows of 16 words for q <= 16, of 32 for q of 17 to 32, of 64 up to 64 and so
on, at least one whole window matches. Of a window's earlier occurrences only the latest can be at the smallest
period: a nearer one inside the run, at lag p < q <= window, would give the run a period that divides q (Fine and
Wilf). So at each size a position lengthens one diagonal at most, and a text of n words takes n log n steps, however
often its words repeat. Windows are compared by 64-bit hashes; the words of a run found are compared once more.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAST, REPEATS = 24, 3
WINDOW = 16  # at most LEAST - LEAST / REPEATS, so that a window fits into every run's matches
BATCH_BYTES = 1 << 22
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _doubled(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hashes of windows twice as wide, from those of windows of ``width`` places."""
    return _mix(hashes[:-width] * _GOLDEN + hashes[width:]) if len(hashes) > width else hashes[:0]


def lags(hashes: np.ndarray) -> np.ndarray:
    """How far back the latest earlier window of equal hash begins; 0 if there is none."""
    order = np.argsort(hashes, kind="stable")
    again = np.nonzero(hashes[order[1:]] == hashes[order[:-1]])[0]
    back = np.zeros(len(hashes), dtype=np.int64)
    back[order[again + 1]] = order[again + 1] - order[again]
    return back


def diagonals(back: np.ndarray, least: int, most: int) -> Iterator[tuple[int, int, int]]:
    """(first place, last place, lag) of each diagonal: places in a row with the same lag, from ``least`` to ``most``."""
    at = np.nonzero((back >= least) & (back <= most))[0]
    if not len(at):
        return
    ends = np.nonzero((at[1:] != at[:-1] + 1) | (back[at[1:]] != back[at[:-1]]))[0]
    starts = np.concatenate([[0], ends + 1])
    for first, last in zip(at[starts].tolist(), at[np.append(ends, len(at) - 1)].tolist()):
        yield first, last, int(back[first])


def runs_of(codes: np.ndarray, windows: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of a text, by start, then period. ``codes`` are its words, ``windows`` the
    hashes of its windows of 16 words."""
    found, size, hashes = [], WINDOW, windows
    while len(hashes):
        for first, last, lag in diagonals(lags(hashes), 1 if size == WINDOW else size // 2 + 1, size):
            start, end = first - lag, last + size
            if (end - start >= max(LEAST, REPEATS * lag)
                    and np.array_equal(codes[first:end], codes[start:end - lag])):
                found.append((start, end - start, lag))
        if REPEATS * (size + 1) > len(codes):
            break
        hashes, size = _doubled(hashes, size), 2 * size
    return sorted(found, key=lambda run: (run[0], run[2]))


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words joined by one space, of each run the first period only."""
    kept = np.ones(len(words), dtype=bool)
    for start, length, period in runs:
        kept[start + period:start + length] = False
    return b" ".join(words if kept.all() else [words[i] for i in np.nonzero(kept)[0].tolist()])


def periodic_runs(texts: list[bytes]) -> list[tuple[list[tuple[int, int, int]], bytes]]:
    """The runs and the collapsed text of each text."""
    split = [text.split() for text in texts]
    counts = np.array([len(words) for words in split], dtype=np.int64)
    codes, distinct = pd.factorize(np.array([word for words in split for word in words], dtype=object))
    codes = codes.astype(np.int64)
    hashes, width = _mix((codes.astype(np.uint64) + np.uint64(1)) * _GOLDEN), 1
    while width < WINDOW:
        hashes, width = _doubled(hashes, width), 2 * width
    ends = np.cumsum(counts)
    owner = np.repeat(np.arange(len(texts), dtype=np.uint64), counts)
    # Texts in which some window occurs twice; windows that reach into the next text are told apart by its number.
    keyed = _mix(hashes + owner[:len(hashes)] * _GOLDEN)
    inside = owner[:len(hashes)] == owner[WINDOW - 1:] if len(hashes) else np.zeros(0, bool)
    order = np.argsort(keyed, kind="stable")
    order = order[inside[order]]
    twice = set(owner[order[1:][keyed[order[1:]] == keyed[order[:-1]]]].tolist()) if len(order) else set()
    out = []
    for d, words in enumerate(split):
        end, runs = int(ends[d]), []
        if d in twice:
            start = end - len(words)
            runs = runs_of(codes[start:end], hashes[start:end - WINDOW + 1])
        out.append((runs, collapsed(words, runs)))
    return out


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _parts(texts: list[bytes]) -> Iterator[tuple[int, list[bytes]]]:
    """Texts of together about ``BATCH_BYTES``: the bound of what is held at once."""
    at = held = 0
    for i, text in enumerate(texts):
        held += len(text)
        if held >= BATCH_BYTES:
            yield at, texts[at:i + 1]
            at, held = i + 1, 0
    if at < len(texts):
        yield at, texts[at:]


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [text or b"" for text in batch.column("text").cast(pa.large_binary()).to_pylist()]
        for at, part in _parts(texts):
            runs, rest = zip(*periodic_runs(part))
            runs = [[{"start": s, "length": n, "period": p} for s, n, p in own] for own in runs]
            rest = pa.array(rest, pa.large_binary()).cast(pa.large_string())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(at, len(part)), pa.array(runs, pa.list_(_RUN)), rest.cast(pa.string())],
                names=["doc_id", "runs", "collapsed"])


def find_runs(docs: DataFrame, text: Column | str = "text") -> DataFrame:
    """doc_id, runs (array of start, length, period), collapsed: per row of ``docs``.

    Words are what lies between the six ASCII white-space characters and are compared as they are. A run is a
    stretch of words with smallest period q and at least max(24, 3q) words that no neighbouring word extends.
    ``collapsed`` joins by one space the words that lie in no run after its first q words. A null, empty or wordless
    text has no run and collapses to an empty one. Repeated rows and ids give repeated rows. An empty table gives no
    rows. Each text is one task's work, in memory that follows its length; other columns are not read.
    """
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                         (F.col(text) if isinstance(text, str) else text).alias("text"))
    return source.mapInArrow(_found, "doc_id long, runs array<struct<start: long, length: long, period: long>>, collapsed string")


def strongest(runs: Column) -> Column:
    """The run of the greatest length / period, the first of equals; null without runs."""
    none = F.lit(None).cast("struct<start: long, length: long, period: long>")
    return F.aggregate(runs, none, lambda best, run: F.when(
        best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"]), run).otherwise(best))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id, text: with h the crc32 of the id and g = floor(h / 10), a text of n words with h % 10 = 0 repeats from its
    word a = g % n on the first 1 + floor((n - a) / (3 + g % 8)) of the words there. Other texts, and those of rows
    without an id, stay as they are."""
    h = F.crc32(F.col("doc_id").cast("long").cast("string"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda word: word != "")
    n, g = F.size("words").cast("long"), F.floor(F.col("h") / 10)
    chosen = docs.select("doc_id", "text", h.alias("h"), F.when(h % 10 == 0, words).alias("words"))
    placed = chosen.withColumn("a", F.when(F.size("words") > 0, g % n)).withColumn(
        "p", F.lit(1) + F.floor((n - F.col("a")) / (g % 8 + 3)))
    repeated = F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.get("words", F.when(
        i >= F.col("a"), F.col("a") + (i - F.col("a")) % F.col("p")).otherwise(i).cast("int")))
    return placed.select("doc_id", F.when(F.col("a").isNotNull(), F.array_join(repeated, " ")).otherwise(F.col("text")).alias("text"))
