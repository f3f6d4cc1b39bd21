"""Test items inside documents: size-partitioned MinHash sketches propose pairs, exact containment decides."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailloom.session import materialize

WORDS, PERCENT = 5, 80
BREAK = "[^\\p{L}\\p{N}]+"


def _need(size: Column, percent: int) -> Column:
    """The smallest whole number that is ``percent`` of ``size`` at least."""
    return F.floor((size * percent + 99) / 100).cast("int")


def shingle_rows(texts: DataFrame, words: int, shorter: Sequence[int] = ()) -> DataFrame:
    """One row per place of a shingle: the columns of ``texts`` but ``text``, ``n_places``, ``w0`` ... and ``h``.

    Words are lower-case runs of letters and digits. A text of fewer words than a shingle has is one shingle. Each place
    also has its runs of as many words as ``shorter`` names; the words that they lack are null.
    """
    kept = [c for c in texts.columns if c != "text"]
    split = texts.select(*kept, F.array_remove(F.split(F.lower(F.coalesce("text", F.lit(""))), BREAK), "").alias("w0"))
    shifted = split.select("*", F.size("w0").alias("n_words"),
                           *[F.expr(f"slice(w0, {i + 1}, size(w0))").alias(f"w{i}") for i in range(1, words)])
    names = [f"w{i}" for i in range(words)]
    rows = shifted.select(*kept, "n_words", F.posexplode(F.arrays_zip(*names)).alias("pos", "at"))
    whole = F.col(f"at.w{words - 1}").isNotNull() | ((F.col("n_words") < words) & (F.col("pos") == 0))
    parts = [F.col(f"at.{name}") for name in names]
    if shorter:
        rows = rows.withColumn("run", F.explode(F.array(*[F.lit(k) for k in (*shorter, words)])))
        whole = F.when(F.col("run") == words, whole).otherwise(F.col("pos") + F.col("run") <= F.col("n_words"))
        parts = [F.when(F.col("run") > i, part) for i, part in enumerate(parts)]
    return rows.where(whole).select(
        *kept, F.greatest(F.col("n_words") - (words - 1), F.lit(1)).alias("n_places"),
        *[part.alias(name) for part, name in zip(parts, names)], F.xxhash64(*parts).alias("h"))


def contained_items(docs: DataFrame, items: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The pairs of a document and a test item of whose distinct shingles at least ``percent`` per cent are in the
    document: doc_id, text_hash, item_id, item_shingles, shared, containment.

    Items are partitioned by size (powers of two of their number of shingles). An item's MinHash sketch is its
    smallest shingle hashes, as many as may be missing from a document at the largest size of its partition, and
    one more: whatever holds ``percent`` of the item holds one of them. So no pair is lost, and a document is
    looked at again only if it holds a shingle of a sketch and is itself large enough for the item. Candidates
    are then checked on the words of all their shingles.

    Documents are told apart by doc_id and the hash of the text: a repeated row counts once, a null id is an id.
    Null, empty and wordless texts and items hold nothing. An item of fewer words than a shingle has is one shingle, found
    wherever its words follow each other: documents get shingles of just the lengths that such items have. Empty tables
    give no rows. Columns other than ids and texts are not read. Sketches and item shingles are written, so that Spark broadcasts them by their true size
    and merges sorted sides beyond its threshold.
    """
    names = [f"w{i}" for i in range(words)]
    keyed = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    of_items = materialize(
        shingle_rows(items.select("item_id", F.xxhash64("text").alias("item_hash"), "text"), words)
        .drop("n_places").distinct(), "items")
    item = ["item_id", "item_hash"]
    length = F.size(F.array_compact(F.array(*names)))
    shorter = sorted(r[0] for r in of_items.where(length < words).select(length).distinct().collect())  # under ``words``
    sets = of_items.groupBy(*item).agg(F.array_sort(F.collect_set("h")).alias("hashes"), F.count("*").alias("q"))
    largest = F.pow(F.lit(2), F.floor(F.log2("q")) + 1).cast("int") - 1
    spare = largest - _need(largest, percent) + 1
    sketches = materialize(
        sets.select(*item, "q", _need(F.col("q"), percent).alias("need"),
                    F.explode(F.slice("hashes", 1, spare)).alias("h")), "sketches")
    candidates = materialize(
        shingle_rows(keyed, words, shorter).drop(*names)
        .join(sketches, "h").where("n_places >= need")
        .groupBy("doc_id", "text_hash", *item, "q", "need").agg(F.lit(1).alias("hit")).drop("hit"), "candidates")
    again = keyed.join(
        candidates.select(F.col("doc_id").alias("c_id"), F.col("text_hash").alias("c_hash")).distinct(),
        F.col("doc_id").eqNullSafe(F.col("c_id")) & (F.col("text_hash") == F.col("c_hash")), "left_semi")
    same = [F.col(f"d.{name}").eqNullSafe(F.col(f"i.{name}")) for name in names]
    places = shingle_rows(again, words, shorter).alias("d")
    hits = places.join(of_items.alias("i"), [F.col("d.h") == F.col("i.h"), *same]).select(
        "d.doc_id", "d.text_hash", "i.item_id", "i.item_hash", "i.h", *[f"i.{name}" for name in names])
    shared = hits.groupBy("doc_id", "text_hash", *item).agg(F.count_distinct(F.struct(*names)).alias("shared"))
    c = candidates.alias("c")
    return (shared.alias("s").join(c, [F.col(f"s.{k}").eqNullSafe(F.col(f"c.{k}"))
                                       for k in ("doc_id", "text_hash", *item)])
            .where("s.shared >= c.need")
            .select("s.doc_id", "s.text_hash", "s.item_id", F.col("c.q").alias("item_shingles"), "s.shared",
                    (F.col("s.shared") / F.col("c.q")).alias("containment")))


def clean_documents(docs: DataFrame, items: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` that contain no item; all columns and all other rows stay as they are."""
    found = contained_items(docs, items, words, percent).select(
        F.col("doc_id").alias("leak_id"), F.col("text_hash").alias("leak_hash")).distinct()
    return docs.join(found, docs["doc_id"].eqNullSafe(found["leak_id"])
                     & (F.xxhash64(docs["text"]) == found["leak_hash"]), "left_anti")
