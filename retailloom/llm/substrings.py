"""Repeated text: units (lines, long ones cut into clauses) are hashed, the earliest of equal ones stays."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from retailloom.llm.common import as_numbers, as_text, numbered
from retailloom.session import materialize

MIN_WORDS = 8
FRAME = 20_000  # units that a task hands on at once
# A unit is a line, or as much of it as holds five words and ends in a punctuation mark and a blank. Units tile the
# text, and fall into step again soon after the start of a shared passage.
UNIT = re.compile(r"[\x20\x09\x0B-\x0D]*(?:[^\x20\x09-\x0D]+[\x20\x09\x0B-\x0D]+){4}[^\n]*?(?:[.!?,;:] |\n|\Z)"
                  r"|[^\n]+(?:\n|\Z)|\n")
SPACE = re.compile(r"[\x20\x09-\x0D]+")
UNITS = "row long, doc_id string, pos int, start int, end int, words int, line boolean, digest binary"


def _units(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per document a head (pos -1, its end is the text's length) and its units that hold a word."""
    for batch in batches:
        out = []
        for row, doc_id, text in zip(batch["row"], batch["doc_id"], batch["text"]):
            out.append((row, doc_id, -1, 0, len(text), 0, False, None))
            pos = 0
            for match in UNIT.finditer(text):
                words = [word for word in SPACE.split(match.group().lower()) if word]
                if words:
                    start, end = match.span()
                    line = (start == 0 or text[start - 1] == "\n") and (end == len(text) or text[end - 1] == "\n")
                    out.append((row, doc_id, pos, start, end, len(words), line,
                                xxhash.xxh3_128_digest(" ".join(words).encode("utf-8", "surrogatepass"))))
                    pos += 1
            if len(out) > FRAME:
                yield _frame(out)
                out = []
        yield _frame(out)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["row", "doc_id", "pos", "start", "end", "words", "line", "digest"])


def repeated_units(docs: DataFrame, min_words: int = MIN_WORDS, row: str | None = None) -> DataFrame:
    """Per row of ``docs``: its number ``row`` (that of a unique column, if one is named), ``doc_id``, ``n_chars``,
    ``n_units`` and the ``spans`` to remove, as a sorted array of ``struct<start, end>`` in code points of the original
    text.

    Units hold five words at least, but for the ends of lines. They are lower-cased and their white space is folded
    before hashing (128 bits). Of equal units the one of the smallest doc_id, then row, then position stays (null ids
    last). Of the others, whole lines go whatever their length; clauses cut out of a longer line, and the ends of such
    lines, go if the run of neighbouring units that all repeat has ``min_words`` words at least, as a short clause recurs by
    chance.
    Empty and null texts have no units. A repeated row loses all its lines, and its clauses of enough words. An empty
    table gives no rows.

    The digests are summed before the shuffle, and the join back has one row per repeated digest on its smaller
    side: a line that a third of all documents share is split by AQE, never gathered.
    """
    number = F.col(row) if row else F.monotonically_increasing_id()
    source = docs.select(number.alias("row"), as_text("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    units = materialize(as_numbers(source.mapInPandas(_units, UNITS), "doc_id"), "units")
    body = units.where("pos >= 0")
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row", "pos")
    first = (body.groupBy("digest").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1")
             .select("digest", F.col("first.row").alias("first_row"), F.col("first.pos").alias("first_pos")))
    repeats = (body.join(first, "digest").where("row != first_row or pos != first_pos")
               .select("row", "pos", "start", "end", "words", "line"))
    in_text = Window.partitionBy("row").orderBy("pos")
    runs = repeats.withColumn("run", F.col("pos") - F.row_number().over(in_text))
    removed = (runs.withColumn("run_words", F.sum("words").over(Window.partitionBy("row", "run")))
               .where(F.col("line") | (F.col("run_words") >= min_words)).groupBy("row")
               .agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans")))
    counted = body.groupBy("row").agg(F.count("*").alias("n_units"))
    return (units.where("pos < 0").select("row", "doc_id", F.col("end").alias("n_chars"))
            .join(counted, "row", "left").join(removed, "row", "left")
            .withColumn("n_units", F.coalesce("n_units", F.lit(0).cast("long")))
            .withColumn("spans", F.coalesce("spans", F.array().cast("array<struct<start:int,end:int>>"))))


def _cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        texts = []
        for text, spans in zip(batch["text"], batch["spans"]):
            at, kept = 0, []
            for span in [] if text is None or spans is None else spans:
                kept.append(text[at:span["start"]])
                at = span["end"]
            texts.append(text if text is None else "".join(kept) + text[at:])
        yield batch.assign(text=texts)


def without_repeats(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with the repeated units cut out of ``text``, and ``spans``, where they were in the original.

    All columns stay; one of the name ``row`` or ``spans`` is replaced.
    """
    rows = numbered(docs.drop("row", "spans"), "row", "rows")
    joined = rows.join(repeated_units(rows, min_words, row="row").select("row", "spans"), "row").drop("row")
    return joined.mapInPandas(_cut, joined.schema)
