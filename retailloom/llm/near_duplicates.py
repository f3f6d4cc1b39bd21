"""Near-duplicates: b-bit MinHash with band candidates, confirmed on whole shingle sets, as connected components.

Documents of one shingle set are one class from the start. In a band bucket every class is first compared with one
centre, another one in each bucket: one band a round, each round with what the ones before have left apart, then all
bands at once, where a class meets each other component in one of its members only. What that leaves is compared across the
components found so far, block by block, and only pairs that their packed signatures allow come out: at first the
likeliest pair of a class and a component, then all that are left. So a group of copies costs about as many
comparisons as it has members, and still no link between two components is missed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from retailloom.llm.common import as_numbers, as_text
from retailloom.llm.graph import components
from retailloom.llm.words import slices
from retailloom.session import materialize, unused_shuffles_go

WORDS, PERCENT = 5, 80
BANDS, ROWS = 32, 4  # a pair of similarity 0.8 shares no band in 1 of 20 million cases
MINIMA = BANDS * ROWS
BINS, BITS = 512, 4  # minima of one permutation, and what is kept of each: 0 if its bin is empty, else 1 to 15
SLACK = 5  # standard deviations by which an estimate may fall short of the threshold
STARS = ((0, 1), (1, 2), (2, 3), (0, BANDS))  # the bands, from and to, whose buckets take part in each star round
BLOCK = 4096  # classes of a bucket that meet in one task, from either side
SIGNED = "doc_id string, text_hash long, n_shingles long, digest binary, bands array<long>, bits array<long>"
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_sets(texts: list[str], words: int) -> list[np.ndarray]:
    """The sorted distinct shingles of each text, as 64-bit hashes of their words.

    Only A to Z are lower-cased and only the six ASCII white-space characters part words. A text of fewer words than
    a shingle has is one shingle, one without words has none.
    """
    split = [text.encode("utf-8", "surrogatepass").lower().split() for text in texts]
    counts = np.array([len(own) for own in split], dtype=np.int64)
    codes, distinct = pd.factorize(np.array([word for own in split for word in own], dtype=object))
    known = np.array([xxhash.xxh64_intdigest(word) for word in distinct], dtype=np.uint64)
    hashes = known[codes] if len(codes) else np.empty(0, np.uint64)
    ends = np.concatenate([[0], np.cumsum(counts)])
    rolled = np.full(max(0, len(hashes) - words + 1), words, dtype=np.uint64)
    for i in range(words):
        rolled = _mix(rolled * _GOLDEN + hashes[i:i + len(rolled)])
    out = []
    for d, n in enumerate(counts):
        if n >= words:
            out.append(np.unique(rolled[ends[d]:ends[d + 1] - words + 1]))
        elif n:
            one = np.full(1, n, dtype=np.uint64)
            for word in hashes[ends[d]:ends[d + 1]]:
                one = _mix(one * _GOLDEN + word)
            out.append(one)
        else:
            out.append(np.empty(0, dtype=np.uint64))
    return out


def signatures(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Of non-empty sets: the hash of each band of minima, and the packed low bits of the bins' minima.

    Each band minimum has a permutation of its own. The packed minima share one, which is cut into bins by the
    hash's high bits; as a set is sorted, a bin's minimum is its first entry.
    """
    rng = np.random.default_rng(20)
    factors = rng.integers(0, 1 << 63, MINIMA, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    shifts = rng.integers(0, 1 << 63, MINIMA, dtype=np.uint64)
    every = np.concatenate(sets)
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    minima = np.empty((len(sets), MINIMA), dtype=np.uint64)
    for i in range(MINIMA):
        minima[:, i] = np.minimum.reduceat((every ^ shifts[i]) * factors[i], starts)
    minima = _mix(minima)
    bands = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), (len(sets), BANDS)).copy()
    for i in range(ROWS):
        bands = _mix(bands * _GOLDEN + minima[:, i::ROWS])
    owner = np.repeat(np.arange(len(sets), dtype=np.int64), [len(s) for s in sets])
    place = owner * BINS + (every >> np.uint64(64 - BINS.bit_length() + 1)).astype(np.int64)
    first = np.concatenate([[True], place[1:] != place[:-1]])
    low = np.zeros(len(sets) * BINS, dtype=np.uint64)
    low[place[first]] = _mix(every[first]) % np.uint64((1 << BITS) - 1) + np.uint64(1)
    low = low.reshape(len(sets), -1, 64 // BITS)
    packed = (low << (np.arange(64 // BITS, dtype=np.uint64) * np.uint64(BITS))).sum(axis=2, dtype=np.uint64)
    return bands.view(np.int64), packed.view(np.int64)


def _signed(words: int):
    def signed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part in slices(batch, "text"):
                sets = shingle_sets(list(part["text"]), words)
                full = [i for i, own in enumerate(sets) if len(own)]
                bands, bits = [None] * len(sets), [None] * len(sets)
                if full:
                    found = signatures([sets[i] for i in full])
                    for i, band, bit in zip(full, *found):
                        bands[i], bits[i] = band, bit
                yield pd.DataFrame({
                    "doc_id": part["doc_id"], "text_hash": part["text_hash"],
                    "n_shingles": [len(own) for own in sets],
                    "digest": [xxhash.xxh3_128_digest(own.tobytes()) if len(own) else None for own in sets],
                    "bands": bands, "bits": bits})

    return signed


def _marks(bits: np.ndarray) -> np.ndarray:
    """One bit for each entry that is not 0."""
    for shift in (1, 2):
        bits = bits | (bits >> np.uint64(shift))
    return bits & np.uint64(0x1111111111111111)


def _counted(bits: np.ndarray) -> np.ndarray:
    return np.bitwise_count(bits).sum(axis=-1, dtype=np.int64)


def estimate(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The similarity by bit counts, and the number of bins that either set fills: of the bins, the share that is
    equal, less those that are equal by chance, one for each 14 unequal ones that both fill."""
    in_a, in_b = _marks(a), _marks(b)
    either, both = _counted(in_a | in_b), _counted(in_a & in_b)
    unlike = _counted(in_a & in_b & _marks(a ^ b))
    kinds = (1 << BITS) - 1
    return (both - unlike * kinds / (kinds - 1)) / np.maximum(either, 1), either


def allowed(a: np.ndarray, n_a, b: np.ndarray, n_b, percent: int) -> np.ndarray:
    """Whether two sets can be similar enough, by their sizes and by the estimate and its spread: bins hide all but
    their minima, and unequal minima may look equal."""
    p = percent / 100
    found, bins = estimate(a, b)
    union = (n_a + n_b) / (1 + p)
    hidden = np.clip(1 - bins / union, 0, 1)
    spread = np.sqrt((1 - p) / np.maximum(bins, 1) * (p * hidden + 1.0 / ((1 << BITS) - 2)))
    return (100 * np.minimum(n_a, n_b) >= percent * np.maximum(n_a, n_b)) & (found >= p - SLACK * spread)


def _packed(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.int64).view(np.uint64)


def _near(percent: int):
    def near(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 4096):
                part = batch.iloc[at:at + 4096]
                keep = allowed(_packed(part["bits_a"]), part["n_a"].to_numpy(), _packed(part["bits_b"]),
                               part["n_b"].to_numpy(), percent)
                yield part.loc[keep, ["a", "b"]]

    return near


def _confirmed(words: int, percent: int):
    def confirmed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 512):
                part = batch.iloc[at:at + 512]
                texts = dict(zip(part["a"], part["text_a"])) | dict(zip(part["b"], part["text_b"]))
                sets = dict(zip(texts, shingle_sets(list(texts.values()), words)))
                linked = []
                for a, b in zip(part["a"], part["b"]):
                    shared = len(np.intersect1d(sets[a], sets[b], assume_unique=True))
                    linked.append(100 * shared >= percent * (len(sets[a]) + len(sets[b]) - shared))
                yield part.loc[linked, ["a", "b"]]

    return confirmed


def _links(pairs: DataFrame, classes: DataFrame, docs: DataFrame, words: int, percent: int,
           near: bool = False) -> DataFrame:
    """The pairs of classes (a, b) whose whole sets are similar enough, checked on the texts; ``near`` if the pairs'
    signatures have been compared."""
    close = pairs
    if not near:
        for side in ("a", "b"):
            close = close.join(classes.select(F.col("node").alias(side), F.col("n_shingles").alias(f"n_{side}"),
                                              F.col("bits").alias(f"bits_{side}")), side)
        close = close.mapInPandas(_near(percent), "a long, b long")
    close = materialize(close, "close")
    nodes = close.select(F.col("a").alias("node")).unionByName(close.select(F.col("b").alias("node"))).distinct()
    wanted = nodes.join(classes, "node").select("node", F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"))
    texts = materialize(docs.join(wanted, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_hash") == F.col("hash")))
                        .select("node", "text"), "texts")
    both = (close.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
            .join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b"))
    return materialize(both.mapInPandas(_confirmed(words, percent), "a long, b long").distinct(), "links")


def _largest(members: DataFrame) -> DataFrame:
    """The component of each bucket with the most members."""
    sizes = members.groupBy("band", "component").agg(F.count("*").alias("n"))
    return (sizes.groupBy("band").agg(F.max(F.struct("n", "component")).alias("most"))
            .select("band", F.col("most.component").alias("largest")))


def _star_pairs(members: DataFrame, star: int) -> DataFrame:
    """Every member of a bucket with the bucket's centre, unless they are in one component already.

    The centre has the smallest number after an exclusive or with a hash of the bucket, so each bucket that a large
    group shares takes another one; once there are components, it is from the bucket's largest. A member that meets
    several centres of one component is compared with one of them.
    """
    turn = F.xxhash64("band", F.lit(star))
    if star:
        members = members.join(_largest(members), "band")
        some, others = members.where("component = largest"), members.where("component != largest")
    else:
        some = others = members.withColumn("largest", F.col("band"))
    centres = (some.groupBy("band").agg(F.min(F.col("node").bitwiseXOR(turn)).alias("least"))
               .select("band", F.col("least").bitwiseXOR(turn).alias("a")))
    met = others.join(centres, "band").where("node != a").groupBy("node", "largest").agg(F.min("a").alias("a"))
    return met.select(F.least("a", "node").alias("a"), F.greatest("a", "node").alias("b")).distinct()


def _open(members: DataFrame, found: DataFrame, label: str) -> DataFrame:
    """The members of the buckets that hold more than one component."""
    placed = members.select("band", "turn", "node").join(found, "node", "left").select(
        "band", "turn", "node", F.coalesce("component", "node").alias("component"))
    mixed = (placed.groupBy("band").agg(F.min("component").alias("low"), F.max("component").alias("high"))
             .where("low != high").select("band"))
    return materialize(placed.join(mixed, "band").select("band", "turn", "node", "component"), label)


def _cross(rows: pd.DataFrame, ends: np.ndarray, percent: int, likeliest: bool) -> pd.DataFrame:
    """Of each run of rows, which is two blocks of a bucket (or one with itself), the pairs of different components
    that are allowed, with their estimates; or of a row and each component the ``likeliest`` pair alone."""
    turn, block, node, component, n, first, second = (rows[c].to_numpy() for c in (
        "turn", "block", "node", "component", "n_shingles", "first", "second"))
    apart = component != rows["largest"].to_numpy()
    bits, bands = _packed(rows["bits"]), _packed(rows["bands"])
    out, found = [np.empty((0, 4), np.int64)], []
    for start, end in zip(ends[:-1], ends[1:]):
        # Pairs within one block once; across two blocks, from both sides; never two of the largest component.
        for i in start + np.nonzero(apart[start:end])[0]:
            run = slice(start, end)
            other = (component[run] != component[i]) & (~apart[run] | (node[run] > node[i]))
            other &= 100 * np.minimum(n[run], n[i]) >= percent * np.maximum(n[run], n[i])
            if first[i] != second[i]:
                other &= block[run] != block[i]
            at = start + np.nonzero(other)[0]
            if len(at):
                at = at[allowed(bits[at], n[at], bits[i], n[i], percent)]
            if len(at):
                at = at[(bands[at] == bands[i]).argmax(axis=1) == turn[i]]  # in the first band they share alone
            if len(at):
                close = estimate(bits[at], bits[i])[0]
                if likeliest:
                    order = np.argsort(-close, kind="stable")
                    order = order[np.unique(component[at[order]], return_index=True)[1]]
                    at, close = at[order], close[order]
                out.append(np.stack([np.minimum(node[at], node[i]), np.maximum(node[at], node[i]),
                                     np.full(len(at), node[i]), component[at]], axis=1))
                found.append(close)
    pairs = pd.DataFrame(np.concatenate(out), columns=["a", "b", "member", "other"])
    pairs["close"] = np.concatenate(found) if found else np.empty(0)
    return pairs


def _crossed(percent: int, likeliest: bool):
    def crossed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows come sorted; the last run of a batch waits for the next one, which may go on with it."""
        rest = None
        for batch in batches:
            rows = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            keys = rows[["band", "first", "second"]].to_numpy()
            starts = np.concatenate([[0], 1 + np.nonzero((keys[1:] != keys[:-1]).any(axis=1))[0]])
            rest = rows.iloc[starts[-1]:]
            if len(starts) > 1:
                yield _cross(rows.iloc[:starts[-1]], starts, percent, likeliest)
        if rest is not None and len(rest):
            yield _cross(rest, np.array([0, len(rest)]), percent, likeliest)

    return crossed


def _cross_pairs(members: DataFrame, classes: DataFrame, percent: int, likeliest: bool) -> DataFrame:
    """All pairs of a bucket from different components whose signatures allow a link; or of each member and component
    the ``likeliest`` of them.

    A bucket of more than ``BLOCK`` classes is cut into blocks by a hash, and each pair of blocks is a task's work.
    """
    sizes = members.groupBy("band").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    known = classes.select("node", "n_shingles", "bits", "bands")
    rows = (members.join(_largest(members), "band").join(sizes, "band").join(known, "node")
            .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
            .withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)"))))
    pairs = rows.withColumns({"first": F.least("block", "other"), "second": F.greatest("block", "other")})
    key = ["band", "first", "second"]
    found = pairs.repartition(*key).sortWithinPartitions(*key).mapInPandas(
        _crossed(percent, likeliest), "a long, b long, member long, other long, close double")
    if likeliest:
        found = found.groupBy("member", "other").agg(F.max(F.struct("close", "a", "b")).alias("best")).select("best.a", "best.b")
    return found.select("a", "b").distinct()


def _grouped(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """Per row doc_id, text_hash, n_shingles, component_id, and whether its text and id are the first of the component:
    by id, null ids last, then by a hash of the text."""
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
                         ).withColumn("text_hash", F.xxhash64("text"))
    as_strings = source.select(as_text("doc_id"), "text", "text_hash")
    signed = materialize(as_numbers(as_strings.mapInPandas(_signed(words), SIGNED), "doc_id"), "signed")
    some = signed.where(F.col("digest").isNotNull())
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    first = some.groupBy("digest").agg(F.min(place).alias("first"))
    same = [F.col("s.digest") == F.col("f.digest"), F.col("s.doc_id").eqNullSafe(F.col("f.first.doc_id")),
            F.col("s.text_hash") == F.col("f.first.text_hash")]
    classes = materialize(
        some.alias("s").join(first.alias("f"), same).select("s.*").dropDuplicates(["digest"])
        .withColumn("node", F.monotonically_increasing_id()), "classes")
    in_bands = classes.select("node", F.posexplode("bands").alias("turn", "band"))
    shared = materialize(in_bands.groupBy("band").agg(F.count("*").alias("n")).where("n > 1").select("band"), "shared")
    members = materialize(in_bands.join(shared, "band").select("band", "turn", "node", F.col("node").alias("component")),
                          "members")
    links, found = None, None
    unused_shuffles_go(docs.sparkSession)  # here and between the rounds: their many short queries fill the driver's memory
    for star, (low, high) in enumerate(STARS):
        taking = members.where((F.col("turn") >= low) & (F.col("turn") < high))
        more = _links(_star_pairs(taking, star), classes, source, words, percent)
        unused_shuffles_go(docs.sparkSession)
        links = more if links is None else links.unionByName(more)
        found = components(links)
        members = _open(members, found, f"open-{star}")
        unused_shuffles_go(docs.sparkSession)
    for likeliest in (True, False):
        more = _links(_cross_pairs(members, classes, percent, likeliest), classes, source, words, percent, near=True)
        unused_shuffles_go(docs.sparkSession)
        if more.isEmpty():
            continue
        links = links.unionByName(more)
        found = components(links)
        if likeliest:
            members = _open(members, found, "open-cross")
        unused_shuffles_go(docs.sparkSession)
    labelled = classes.select("node", "digest", place.alias("place")).join(found, "node", "left").withColumn(
        "component", F.coalesce("component", "node"))
    least = labelled.groupBy("component").agg(F.min("place").alias("least"))
    of_class = labelled.join(least, "component").select("digest", "least")
    joined = some.select("doc_id", "text_hash", "n_shingles", "digest").join(of_class, "digest").select(
        "doc_id", "text_hash", "n_shingles", F.col("least.doc_id").alias("component_id"),
        (F.col("doc_id").eqNullSafe(F.col("least.doc_id")) & (F.col("text_hash") == F.col("least.text_hash"))).alias("first"))
    alone = signed.where(F.col("digest").isNull()).select(
        "doc_id", "text_hash", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(True).alias("first"))
    return joined.unionByName(alone)


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """Per row of ``docs(doc_id, text)``: doc_id, text_hash, n_shingles, component_id, kept.

    Two documents are linked if 100 x shared shingles is at least ``percent`` x shingles of either. ``component_id``
    is the smallest doc_id of the linked ones, null ids last; ``kept`` tells whether it is the row's own. A null,
    empty or wordless text has no shingles and is alone. Repeated rows (same id, same text) are one document and
    have the same result. An empty table gives no rows. Other columns are not read.
    """
    kept = F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    return _grouped(docs, words, percent).select("doc_id", "text_hash", "n_shingles", "component_id", kept)


def without_near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row of each component of ``docs``, with all its columns: that of the smallest id, null ids last, then by a hash of
    the text; of repeated rows any one. Rows without words all stay."""
    grouped = materialize(_grouped(docs, words, percent), "grouped")
    key = [F.col("doc_id").cast("long"), F.xxhash64(F.coalesce("text", F.lit("")))]

    def these(rows: DataFrame, listed: DataFrame, how: str) -> DataFrame:
        named = listed.select(F.col("doc_id").alias("listed_id"), F.col("text_hash").alias("listed_hash")).distinct()
        return rows.join(named, key[0].eqNullSafe(named["listed_id"]) & (key[1] == named["listed_hash"]), how)

    left = these(docs, grouped.where("NOT first"), "left_anti")
    repeated = materialize(grouped.where("first AND n_shingles > 0").groupBy("doc_id", "text_hash").agg(
        F.count("*").alias("n")).where("n > 1"), "repeated")
    if repeated.isEmpty():
        return left
    number = F.row_number().over(Window.partitionBy(*key).orderBy(F.lit(0)))
    once = these(left, repeated, "left_semi").select(F.struct("*").alias("own"), number.alias("number")).where("number = 1")
    return these(left, repeated, "left_anti").unionByName(once.select("own.*"))
