"""Best-fit packing: documents as token pieces, packed by a configuration linear program over their lengths.

Only the histogram of piece lengths (at most one number per length) comes to the driver. What goes back is a plan:
patterns of lengths, how often each is used, and which numbers of each length it takes. Every piece then finds its
place by its length and its number among the pieces of that length.
"""

from __future__ import annotations

import logging
import os
import re
import string
import zlib
from array import array
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from retailloom.llm.common import as_numbers, as_text, numbered, per_process
from retailloom.session import materialize

log = logging.getLogger(__name__)

CAPACITY, END = 4096, 1
BLOCK = 64  # lengths that share a knapsack
STEP = 0.5  # share of a length's pieces that one step of the weights may cover
FALL = 0.01  # by which the logarithm of a price falls from nothing covered to all
LONGER = 0.01  # by which a sequence filled by one piece is worth more, so that short pieces stay for later gaps
REST = 0.05  # share of the tokens left to best fit
PIECES = "row long, doc_id string, piece int, start long, length long, ids_crc32 long"
CACHED_WORDS, CACHED_PARTS = 100_000, 400_000  # distinct words, and parts of them, that a Python worker keeps: about 80 MB
RENEWED = 20
CACHED_LENGTH = 32  # characters of the longest of them that is kept, so that the number bounds the memory


def default_tokenizer() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


class _Kept(dict):
    """What ``make`` returns for a text: the first ``most`` results, for short texts alone, as frequent texts come early.
    Starts anew when ``RENEWED`` times as many were not found, since other texts may be frequent by then."""

    def __init__(self, make: Callable[[str], bytes], most: int):
        super().__init__()
        self.make, self.most, self.missed = make, most, 0

    def __missing__(self, text: str) -> bytes:
        made = self.make(text)
        if len(self) < self.most:
            if len(text) <= CACHED_LENGTH:
                self[text] = made
        elif self.missed < RENEWED * self.most:
            self.missed += 1
        else:
            self.missed = 0
            self.clear()
        return made


class _Other(Exception):
    """A word is not of Latin letters alone."""


class WordTokenizer:
    """Token ids, as little-endian 32-bit numbers, for a tokenizer that drops white space and never joins across it.

    A text of Latin letters is cut at white space. A word that is not known is put into small letters and parted here, by
    the tokenizer's own rule, and a part that is not known is encoded by the tokenizer's model. Any other text is encoded
    as a whole.
    """

    # Beyond Latin letters normalising can change what is beside a letter; one capital has two small letters.
    OTHER = re.compile("[^\x00-\u024f]|\u0130")
    SPACES = "\x1c\x1d\x1e\x1f"  # white space for Python alone
    # Fixed value: the tokenizer's rule 's|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+, for these letters.
    PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_²³¹¼½¾]+|[\d²³¹¼½¾]|(?:[^\w\s]|_)+")

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = True
        self.model = self.whole.model
        # The model spells bytes as characters: printable ones as themselves, the others from U+0100 on, in order.
        shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
        self.spelt = {byte: chr(0x100 + i) for i, byte in enumerate(b for b in range(256) if b not in shown)}
        self.parts = _Kept(self._part, CACHED_PARTS)
        self.words = _Kept(self._word, CACHED_WORDS)

    def _part(self, part: str) -> bytes:
        plain = part.isascii() and part.isprintable()
        spelt = part if plain else part.encode().decode("latin-1").translate(self.spelt)
        return array("I", [token.id for token in self.model.tokenize(spelt)]).tobytes()

    def _word(self, word: str) -> bytes:
        if not word.isascii() and self.OTHER.search(word):
            raise _Other
        stem = word.rstrip(string.punctuation)
        if stem.isalpha():  # no need to part it: letters, then signs
            signs = word[len(stem):]
            return self.parts[stem.lower()] + self.parts[signs] if signs else self.parts[stem.lower()]
        return b"".join(map(self.parts.__getitem__, self.PARTS.findall(word.lower())))

    def encode(self, text: str) -> bytes:
        if not any(map(text.__contains__, self.SPACES)):
            try:
                return b"".join(map(self.words.__getitem__, text.split()))
            except _Other:
                pass
        return array("I", self.whole.encode(text, add_special_tokens=False).ids).tobytes()


def _tokenizer(path: str) -> WordTokenizer:
    """One for each Python worker, so that its parts serve all tasks that run there."""
    return per_process(("tokenizer", path), lambda: WordTokenizer(path))


def _tokenized(path: str, capacity: int):
    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokenizer, end = _tokenizer(path), array("I", [END]).tobytes()
        for batch in batches:
            out = []
            for row, doc_id, text in zip(batch["row"], batch["doc_id"], batch["text"]):
                ids = tokenizer.encode(text) + end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    own = ids[at:at + 4 * capacity]
                    out.append((row, doc_id, piece, at // 4, len(own) // 4, zlib.crc32(own)))
            yield pd.DataFrame(out, columns=["row", "doc_id", "piece", "start", "length", "ids_crc32"])

    return pieces


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece of each document's ids and the end token: row, doc_id, piece, start, length, ids_crc32."""
    source = docs.select(F.monotonically_increasing_id().alias("row"), as_text("doc_id"),
                         F.coalesce("text", F.lit("")).alias("text"))
    return source.mapInPandas(_tokenized(tokenizer, capacity), PIECES)


# The plan, on the driver: its size depends on the capacity and the logarithm of the counts alone.

def _best_pattern(lengths: np.ndarray, worth: np.ndarray, most: np.ndarray, capacity: int) -> np.ndarray:
    """Knapsack by dynamic programming: counts of ``lengths`` of the largest worth that fit, none over ``most``.

    Exact: a length that may be taken m times is offered as 1, 2, 4 ... and the rest of m copies at once, and the table
    keeps for each offer and filled size whether it was taken.
    """
    offers = []
    for k, size in enumerate(lengths.tolist()):
        limit, copies = min(int(most[k]), capacity // size), 1
        while limit > 0:
            offers.append((k, min(copies, limit)))
            limit, copies = limit - copies, 2 * copies
    value, sums = np.zeros(capacity + 1), np.empty(capacity + 1)
    taken = np.zeros((len(offers), capacity + 1), dtype=bool)
    sizes, worths = lengths.tolist(), worth.tolist()
    for row, (k, copies) in zip(taken, offers):
        size = sizes[k] * copies
        without = value[size:]
        with_it = np.add(value[:capacity + 1 - size], worths[k] * copies, out=sums[size:])
        np.greater(with_it, without, out=row[size:])
        np.maximum(with_it, without, out=without)
    counts, space = np.zeros(len(lengths), dtype=np.int64), capacity
    for row, (k, copies) in zip(taken[::-1], offers[::-1]):
        if row[space]:
            counts[k] += copies
            space -= int(lengths[k]) * copies
    return counts


def _patterns(lengths: np.ndarray, demand: np.ndarray, capacity: int) -> list[tuple[np.ndarray, np.ndarray, int]]:
    """The configuration program by multiplicative weights: the lengths and counts of patterns, and their whole uses.

    A length's price starts near its share of the capacity, which is its price in the optimum whenever the program
    reaches the volume bound, and falls by a factor with every share of its demand that is covered. A round prices
    every length that is left: they are dealt into blocks at random (by the round's number), and each block's knapsack
    finds its best pattern. It is used for ``STEP`` of what its scarcest length has left, rounded down, once at least.
    Patterns never hold more of a length than is left, so nothing is covered twice. Ends when at most ``REST`` of all
    tokens are left, whose patterns could no longer be full.
    """
    left, found, turn = demand.copy(), [], 0
    total = int((lengths * demand).sum())
    while int((lengths * left).sum()) > REST * total:
        live = np.random.default_rng(turn).permutation(np.nonzero(left)[0])
        turn += 1
        price = lengths / capacity * (1 + LONGER * lengths / capacity) * np.exp(-FALL * (1 - left / demand))
        for block in np.array_split(live, -(-len(live) // BLOCK)):
            counts = _best_pattern(lengths[block], price[block], left[block], capacity)
            on = counts > 0
            uses = max(1, int(STEP * (left[block][on] / counts[on]).min()))
            left[block] -= uses * counts
            found.append((lengths[block][on], counts[on], uses))
    return found


@dataclass
class Plan:
    """Runs of equal places: the ``count`` pieces of ``length`` from number ``first`` on go, ``each`` to a sequence,
    to the sequences from ``sequence`` on, at ``offset`` and after."""

    length: np.ndarray
    first: np.ndarray
    count: np.ndarray
    each: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    sequences: int
    from_patterns: int = 0


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """The program's patterns, then what is left by best fit, longest first.

    Best fit works on groups of equally filled sequences, so its work follows the number of lengths and patterns,
    not the number of pieces. The patterns' free space takes part in it.
    """
    lengths = np.array(sorted(histogram, reverse=True), dtype=np.int64)
    left = np.array([histogram[int(x)] for x in lengths], dtype=np.int64)
    groups: dict[tuple[tuple[int, int], ...], int] = {}  # (length, count) pairs and number of sequences
    for sizes, counts, uses in _patterns(lengths, left, capacity):
        left[len(lengths) - 1 - np.searchsorted(lengths[::-1], sizes)] -= uses * counts
        items = tuple(sorted(zip(sizes.tolist(), counts.tolist()), reverse=True))
        groups[items] = groups.get(items, 0) + uses
    made = _places(_best_fit(list(groups.items()), lengths, left, capacity))
    made.from_patterns = sum(groups.values())
    log.info("%d of %d sequences come from patterns", made.from_patterns, made.sequences)
    return made


def _best_fit(groups, lengths, left, capacity):
    open_: list[list] = [[] for _ in range(capacity + 1)]  # by free space
    for items, n in groups:
        open_[capacity - sum(size * c for size, c in items)].append((items, n))
    free = np.array([bool(x) for x in open_])
    for size, todo in zip(lengths.tolist(), left.tolist()):
        while todo:
            fitting = np.nonzero(free[size:])[0]
            if len(fitting):
                space = size + int(fitting[0])
                items, n = open_[space].pop()
                free[space] = bool(open_[space])
            else:
                space, items, n = capacity, (), todo
            each = min(space // size, todo)
            used = min(n, todo // each)
            todo -= each * used
            if n > used and (items or space < capacity):
                open_[space].append((items, n - used))
                free[space] = True
            rest = space - each * size
            open_[rest].append(((*items, (size, each)), used))
            free[rest] = True
    return [group for groups_ in open_ for group in groups_]


def _places(groups) -> Plan:
    taken: dict[int, int] = {}
    rows, sequence = [], 0
    for items, n in groups:
        offset = 0
        for size, each in items:
            first = taken.get(size, 0)
            rows.append((size, first, each * n, each, sequence, offset))
            taken[size] = first + each * n
            offset += size * each
        sequence += n
    table = np.array(sorted(rows), dtype=np.int64).reshape(-1, 6)
    return Plan(*table.T, sequences=sequence)


def _placed(plan_: Plan):
    key = plan_.length * (1 << 44) + plan_.first  # sorted: lengths, then first numbers

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            length, number = batch["length"].to_numpy(np.int64), batch.pop("number").to_numpy(np.int64)
            at = np.searchsorted(key, length * (1 << 44) + number, side="right") - 1
            within = number - plan_.first[at]
            yield batch.assign(sequence_id=plan_.sequence[at] + within // plan_.each[at],
                               offset=plan_.offset[at] + within % plan_.each[at] * length)

    return place


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset, ``row``.

    A document is the token ids of its text and one end token; longer ones are cut into pieces of ``capacity``.
    Null and empty texts are the end token alone. Repeated rows are documents of their own, told apart by ``row``.
    An empty table gives no rows. Columns other than doc_id and text are not read.

    Pieces of equal length are numbered within buckets of a hash, and the buckets' counts are added up, so that a
    length that a third of all pieces share is spread over tasks like any other.
    """
    pieces = materialize(token_pieces(docs, tokenizer or default_tokenizer(), capacity), "pieces")
    spread = max(64, 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    bucketed = pieces.withColumn("bucket", F.pmod(F.xxhash64("row", "piece"), F.lit(spread)).cast("int"))
    counts = bucketed.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = materialize(counts.withColumn("before", F.sum("n").over(
        Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))), "counts")
    histogram = {r["length"]: r["n"] for r in before.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    made = plan(histogram, capacity)
    inside = Window.partitionBy("length", "bucket").orderBy("row", "piece")
    numbered_ = (bucketed.withColumn("number", F.row_number().over(inside) - 1)
                 .join(before.select("length", "bucket", "before"), ["length", "bucket"])
                 .withColumn("number", F.col("number") + F.coalesce("before", F.lit(0))))
    rows = numbered_.select("row", "doc_id", "piece", "start", "length", "ids_crc32", "number")
    schema = f"{PIECES}, sequence_id long, offset long"
    return as_numbers(rows.mapInPandas(_placed(made), schema), "doc_id")


def _ids(path: str):
    def ids(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokenizer = _tokenizer(path)
        for batch in batches:
            out = []
            for text, cuts in zip(batch["text"], batch["cuts"]):
                own = np.append(np.frombuffer(tokenizer.encode(text), dtype="<u4"), np.uint32(END))
                out += [(c["sequence_id"], c["offset"], own[c["start"]:c["start"] + c["length"]].astype("int32"))
                        for c in cuts]
            yield pd.DataFrame(out, columns=["sequence_id", "offset", "ids"])

    return ids


def sequences(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """The packed sequences themselves: sequence_id, ``ids`` (at most ``capacity``) and ``ends`` of their pieces."""
    path = tokenizer or default_tokenizer()
    own = numbered(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), "at", "texts")
    packed = pack(own.select(F.col("at").alias("doc_id"), "text"), path, capacity)
    cuts = packed.groupBy(F.col("doc_id").alias("at")).agg(
        F.collect_list(F.struct("sequence_id", "offset", "start", "length")).alias("cuts"))
    parts = own.join(cuts, "at").select("text", "cuts").mapInPandas(
        _ids(path), "sequence_id long, offset long, ids array<int>")
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return parts.groupBy("sequence_id").agg(ordered.alias("parts")).select(
        "sequence_id", F.flatten("parts.ids").alias("ids"),
        F.transform("parts", lambda p: (p["offset"] + F.size(p["ids"])).cast("int")).alias("ends"))
