"""SimHash near-duplicates: a self-join of binary tries under a budget of differing bits, as connected components.

Two fingerprints that differ in at most 4 of 64 bits are found like this. The bits are cut into five blocks and the
fingerprints rotated so that each block comes first in one of five tries. By the cycle lemma, of the five rotations of
any four (or fewer) errors dealt over five blocks there is one in which the first j blocks hold fewer than j errors,
for every j. So in each trie pairs of nodes go down together, adding up their differing bits, and are given up as soon
as these exceed the budget of their depth: none in the first block, one by the end of the second, four in the last.

The first block is the shuffle key. A bucket with too many fingerprints goes on down on Spark, as a table of node
pairs with their sizes, until each pair fits a task; the rest of the descent is numpy on sorted arrays. A task returns
a spanning forest of the links that it finds, at most one row per fingerprint, not all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailloom.llm.graph import components
from retailloom.session import materialize

WORDS, BITS, BUDGET, SEED = 4, 64, 4, 42
SIZES = (13, 13, 13, 13, 12)  # of the blocks, one more than may differ
NODE = 1 << 14  # fingerprints of the two nodes that one task descends from
STEP = 4  # levels of a descent on Spark
LEAF = 64  # pairs of a node pair that are compared one by one
FRONTIER = 1 << 20  # node pairs, or pairs of fingerprints, held at once
PART = 1 << 18  # shingles whose bits are counted at once


def fingerprint(text: bytes, words: int = WORDS) -> int:
    """A bit is 1 if more than half of the shingles' XXH64 have it. Without words: 0."""
    split = text.lower().split()
    if not split:
        return 0
    line = b" ".join(split)
    view = memoryview(line)
    ends = np.cumsum(np.fromiter(map(len, split), np.int64, len(split)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    if len(split) < words:
        starts, ends = starts[:1], ends[-1:]
    else:
        starts, ends = starts[:len(split) - words + 1], ends[words - 1:]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(view[a:b], SEED) for a, b in zip(starts.tolist(), ends.tolist())), np.uint64, len(starts))
    counts = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), PART):
        counts += np.unpackbits(hashes[at:at + PART].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashes)).tobytes(), "big")


def _printed(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(text or b"", words) for text in batch.column("text").cast(pa.large_binary()).to_pylist()]
            found = pa.array(np.array(prints, dtype=np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), found], names=["doc_id", "print"])

    return run


def fingerprints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id and the fingerprint as a signed 64-bit ``print``."""
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    return source.mapInArrow(_printed(words), "doc_id long, print long")


def _turned(turn: int) -> int:
    """How far a fingerprint is rotated to the left so that block ``turn`` comes first."""
    return sum(SIZES[:turn])


def budget(turn: int, depth: int) -> int:
    """The differing bits allowed among the first ``depth`` of a rotation: as many as whole blocks lie before."""
    sizes = SIZES[turn:] + SIZES[:turn]
    return sum(1 for i in range(1, len(sizes)) if sum(sizes[:i]) < depth)


def rotations(prints: DataFrame) -> DataFrame:
    """turn, rotated, head: five rows for each fingerprint; ``head`` is the block that comes first."""
    def rotated(turn: int) -> Column:
        by = _turned(turn)
        whole = F.shiftleft("print", by).bitwiseOR(F.shiftrightunsigned("print", BITS - by)) if by else F.col("print")
        return F.struct(F.lit(turn).alias("turn"), whole.alias("rotated"),
                        F.shiftrightunsigned(whole, BITS - SIZES[turn]).alias("head"))

    return prints.select(F.inline(F.array(*[rotated(turn) for turn in range(len(SIZES))])))


def node_pairs(rows: DataFrame, node: int) -> DataFrame:
    """turn, depth, a, b, differ: pairs of trie nodes under the large heads of ``rows``, each with at most ``node``
    fingerprints together; a < b, or a = b for a node with itself. Pairs over their budget are given up."""
    sizes = rows.groupBy("turn", "head").agg(F.count("*").alias("n")).where(F.col("n") > node)
    large = materialize(sizes, "large-heads")
    lengths = F.element_at(F.array(*[F.lit(size) for size in SIZES]), F.col("turn") + 1)
    front = large.select("turn", lengths.alias("depth"), F.col("head").alias("a"), F.col("head").alias("b"),
                         F.lit(0).alias("differ"))
    members = materialize(rows.join(large.select("turn", "head"), ["turn", "head"]).select("turn", "rotated"), "large-rows")
    limit = F.lit(BUDGET)
    for turn in range(len(SIZES)):
        for depth in range(BITS, 0, -1):
            allowed = budget(turn, depth)
            if allowed < BUDGET:
                limit = F.when((F.col("turn") == turn) & (F.col("depth") <= depth), allowed).otherwise(limit)
    done = None
    while not front.isEmpty():
        deeper = front.select("turn", F.col("depth").alias("above"), F.least(F.col("depth") + STEP, F.lit(BITS)).alias("depth"),
                              "a", "b", "differ")
        depths = deeper.select("turn", "above", "depth").distinct()
        counts = materialize(
            members.join(F.broadcast(depths), "turn")  # at most five turns times the levels of one step
            .groupBy("turn", "above", "depth", F.expr("shiftrightunsigned(rotated, 64 - depth)").alias("child"))
            .agg(F.count("*").alias("n")), "nodes")
        parent = F.expr("shiftrightunsigned(child, depth - above)")
        ends = {side: counts.select("turn", "depth", parent.alias(side), F.col("child").alias(f"child_{side}"),
                                    F.col("n").alias(f"n_{side}")) for side in ("a", "b")}
        grown = (deeper.join(ends["a"], ["turn", "depth", "a"]).join(ends["b"], ["turn", "depth", "b"])
                 .where("a != b OR child_a <= child_b")
                 .withColumn("differ", (F.col("differ") + F.bit_count(
                     F.col("child_a").bitwiseXOR(F.col("child_b")).bitwiseAND(F.expr("shiftleft(1L, depth - above) - 1")))).cast("int"))
                 .where(F.col("differ") <= limit))
        alone = F.col("child_a") == F.col("child_b")
        together = F.when(alone, F.col("n_a")).otherwise(F.col("n_a") + F.col("n_b"))
        grown = materialize(grown.select("turn", "depth", F.col("child_a").alias("a"), F.col("child_b").alias("b"), "differ",
                                         together.alias("n")), "node-pairs")
        fits = (F.col("n") <= node) | (F.col("depth") == BITS)
        small = grown.where(fits & (F.col("n") > 1)).drop("n")
        done = small if done is None else done.unionByName(small)
        front = grown.where(~fits).drop("n")
    return done if done is not None else front


def _work(rows: DataFrame, node: int) -> DataFrame:
    """turn, depth, a, b, rotated: the fingerprints of every pair of nodes that a task descends from."""
    pairs = materialize(node_pairs(rows, node), "work")
    large = rows.groupBy("turn", "head").agg(F.count("*").alias("n")).where(F.col("n") > node).select("turn", "head")
    lengths = F.element_at(F.array(*[F.lit(size) for size in SIZES]), F.col("turn") + 1)
    own = rows.join(large, ["turn", "head"], "left_anti").select(
        "turn", lengths.alias("depth"), F.col("head").alias("a"), F.col("head").alias("b"), F.lit(0).alias("differ"), "rotated")
    if pairs.isEmpty():
        return own
    members = rows.join(large, ["turn", "head"])
    depths = F.broadcast(pairs.select("turn", "depth").distinct())  # at most five turns times 64 levels
    placed = members.join(depths, "turn").select(
        "turn", "depth", "rotated", F.expr("shiftrightunsigned(rotated, 64 - depth)").alias("place"))
    left = pairs.withColumn("place", F.col("a"))
    right = pairs.where("a != b").withColumn("place", F.col("b"))
    split = left.unionByName(right).join(placed, ["turn", "depth", "place"]).select(
        "turn", "depth", "a", "b", "differ", "rotated")
    return own.unionByName(split)


def merged(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``labels``, each the smallest position reached so far, after the links a - b as well."""
    while True:
        apart = labels[a] != labels[b]
        if not apart.any():
            return labels
        a, b = a[apart], b[apart]
        root_a, root_b = labels[a], labels[b]
        np.minimum.at(labels, np.maximum(root_a, root_b), np.minimum(root_a, root_b))
        while True:
            jumped = labels[labels]
            if (jumped == labels).all():
                break
            labels = jumped


def descend(x: np.ndarray, starts: np.ndarray, middles: np.ndarray, ends: np.ndarray, turn: np.ndarray,
            depth: np.ndarray, differ: np.ndarray) -> np.ndarray:
    """Labels of the fingerprints ``x``: equal for those linked.

    Each pair of nodes is given by its rows: [start, middle) and [middle, end), or start = middle for a node with
    itself; rows of a node are sorted. One step looks at the next bit: the rows that have it are the node's last ones,
    as many as the running count of that bit says.
    """
    ones = np.zeros((BITS, len(x) + 1), dtype=np.int32)
    for bit in range(BITS):
        np.cumsum((x >> np.uint64(BITS - 1 - bit)) & np.uint64(1), out=ones[bit, 1:])
    limits = np.array([[budget(t, d) for d in range(BITS + 1)] for t in range(len(SIZES))])
    labels = np.arange(len(x))
    selfs = middles == starts
    front = np.stack([starts, np.where(selfs, ends, middles), np.where(selfs, starts, middles), ends, turn, depth, differ], axis=1)
    stack = [front]
    while stack:
        front = stack.pop()
        if len(front) > FRONTIER:
            stack += [front[:len(front) // 2], front[len(front) // 2:]]
            continue
        sa, ea, sb, eb, turn, depth, differ = front.T
        same = sa == sb
        small = ((ea - sa) * (eb - sb) <= LEAF) | (depth == BITS)
        labels = _compared(x, labels, sa[small], ea[small], sb[small], eb[small])
        front = front[~small]
        if not len(front):
            continue
        sa, ea, sb, eb, turn, depth, differ = front.T
        same = sa == sb
        cut_a = ea - (ones[depth, ea] - ones[depth, sa])
        cut_b = eb - (ones[depth, eb] - ones[depth, sb])
        out = []
        for bit_a, bit_b in ((0, 0), (1, 1), (0, 1), (1, 0)):
            child = np.stack([cut_a if bit_a else sa, ea if bit_a else cut_a, cut_b if bit_b else sb, eb if bit_b else cut_b,
                              turn, depth + 1, differ + (bit_a != bit_b)], axis=1)
            keep = (child[:, 0] < child[:, 1]) & (child[:, 2] < child[:, 3]) & (child[:, 6] <= limits[turn, depth + 1])
            if (bit_a, bit_b) == (1, 0):
                keep &= ~same
            out.append(child[keep])
        stack.append(np.concatenate(out))
    return labels


def _compared(x, labels, sa, ea, sb, eb) -> np.ndarray:
    """The labels after comparing all rows of small pairs of nodes."""
    wide = eb - sb
    counts = (ea - sa) * wide
    ends = np.cumsum(counts)
    done = 0
    while done < len(counts):
        upto = max(done + 1, int(np.searchsorted(ends, (ends[done - 1] if done else 0) + FRONTIER, "right")))
        own = counts[done:upto]
        pair = np.repeat(np.arange(done, upto), own)
        within = np.arange(own.sum()) - np.repeat(np.cumsum(own) - own, own)
        i, j = sa[pair] + within // wide[pair], sb[pair] + within % wide[pair]
        near = (i < j) & (np.bitwise_count(x[i] ^ x[j]) <= BUDGET)
        labels = merged(labels, i[near], j[near])
        done = upto
    return labels


def _forest(rows: dict[str, np.ndarray]) -> pa.RecordBatch:
    """Links (a, b) of unrotated fingerprints that join what the given rows, whole groups of them, hold."""
    turn, depth, x = rows["turn"], rows["depth"], rows["rotated"].view(np.uint64)
    key = np.stack([turn, depth, rows["a"], rows["b"]])
    new = np.concatenate([[True], (key[:, 1:] != key[:, :-1]).any(axis=0)])
    starts = np.nonzero(new)[0]
    ends = np.append(starts[1:], len(x))
    first = x >> (BITS - depth).astype(np.uint64)
    in_b = (rows["a"] != rows["b"]) & (first == rows["b"].view(np.uint64))
    n_b = np.add.reduceat(in_b.astype(np.int64), starts)
    middles = np.where(rows["a"][starts] == rows["b"][starts], starts, ends - n_b)
    labels = descend(x, starts, middles, ends, turn[starts], depth[starts], rows["differ"][starts])
    linked = np.nonzero(labels != np.arange(len(x)))[0]
    shift = np.array([_turned(t) for t in range(len(SIZES))], dtype=np.uint64)[turn[linked]]

    def back(values: np.ndarray) -> np.ndarray:
        turned = (values >> shift) | (values << ((np.uint64(BITS) - shift) % np.uint64(BITS)))
        return np.where(shift == 0, values, turned).view(np.int64)

    return pa.RecordBatch.from_arrays([pa.array(back(x[linked])), pa.array(back(x[labels[linked]]))], names=["a", "b"])


_COLUMNS = ("turn", "depth", "a", "b", "differ", "rotated")


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted; the last group of a batch waits for the next one, which may go on with it."""
    rest = None
    for batch in batches:
        rows = {name: batch.column(name).to_numpy(zero_copy_only=False).astype(np.int64) for name in _COLUMNS}
        if rest is not None:
            rows = {name: np.concatenate([rest[name], rows[name]]) for name in _COLUMNS}
        if not len(rows["turn"]):
            continue
        same = np.logical_and.reduce([rows[name] == rows[name][-1] for name in _COLUMNS[:4]])
        cut = len(same) - (np.argmin(same[::-1]) if not same.all() else len(same))
        rest = {name: values[cut:] for name, values in rows.items()}
        if cut:
            yield _forest({name: values[:cut] for name, values in rows.items()})
    if rest is not None:
        yield _forest(rest)


def links(prints: DataFrame, node: int = NODE) -> DataFrame:
    """(a, b) pairs of distinct fingerprints ``print`` that connect all that differ in at most four bits."""
    rows = materialize(rotations(prints.select("print").distinct()), "rotations")
    key = ["turn", "depth", "a", "b"]
    work = _work(rows, node)  # the rows of a task's two nodes share their sign, so this order is that of the bits
    return work.repartition(*key).sortWithinPartitions(*key, "rotated").mapInArrow(_joined, "a long, b long")


def simhash_components(docs: DataFrame, words: int = WORDS, node: int = NODE) -> DataFrame:
    """Per row of ``docs(doc_id, text)``: doc_id, print, component_id.

    Documents whose fingerprints differ in at most four bits are linked; ``component_id`` is the smallest doc_id
    reachable (null only where all ids are null). Equal fingerprints are one node from the start. A null, empty or
    wordless text has fingerprint zero and is linked like any other. Only A to Z are lower-cased, only the six ASCII
    white-space characters part words, and a text of fewer words than a shingle has is one shingle. Repeated rows give
    repeated rows. An empty table gives no rows. Other columns are not read.
    """
    found = materialize(fingerprints(docs, words), "prints")
    least = found.groupBy("print").agg(F.min("doc_id").alias("least"))
    placed = components(links(found, node)).withColumnRenamed("node", "print")
    nodes = materialize(least.join(placed, "print", "left").select(
        "print", "least", F.coalesce("component", "print").alias("component")), "print-nodes")
    smallest = nodes.groupBy("component").agg(F.min("least").alias("component_id"))
    of_print = nodes.join(smallest, "component").select("print", "component_id")
    return found.join(of_print, "print").select("doc_id", "print", "component_id")
