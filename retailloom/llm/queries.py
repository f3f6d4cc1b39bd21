"""The registered queries of this subpackage, each over its whole table, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retailloom.llm import (
    centroids, decontaminate, fingerprints, near_duplicates, neighbours, packing, pii, quality, runs, sharding,
    substrings, toxicity, warc)
from retailloom.llm.common import table
from retailloom.session import scratch

Query = Callable[[SparkSession, str], DataFrame]


def op1_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.nearest_neighbours(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


def op2_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.contained_items(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.drop("text_hash")


def op3_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.find_personal_data(table(spark, folder, "documents"))
    counts = [pii.count_of("base", kind).alias(f"n_{kind}") for kind in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(pii.written(F.col("base")), 256).alias("base_sha256"),
                        pii.written(F.col("spans")).alias("spans"), F.size("added").cast("long").alias("n_added"))


def op4_packing(spark: SparkSession, folder: str) -> DataFrame:
    packed = packing.pack(table(spark, folder, "documents"))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op5_substrings(spark: SparkSession, folder: str) -> DataFrame:
    found = substrings.repeated_units(table(spark, folder, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id", "n_units", F.size("spans").cast("long").alias("n_removed"),
        (F.col("n_chars") - removed).alias("kept_chars"),
        F.array_join(F.transform("spans", lambda s: F.concat_ws(
            ":", s["start"].cast("string"), s["end"].cast("string"))), ",").alias("spans"))


def op6_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return quality.score(docs, quality.fit(docs, table(spark, folder, "labels")))


def op7_warc(spark: SparkSession, folder: str) -> DataFrame:
    archives = scratch(spark, "warc")
    warc.write_archives(table(spark, folder, "pages"), archives)
    return warc.read_archives(spark, archives).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    found = near_duplicates.near_duplicates(table(spark, folder, "documents"), words=3, percent=85)
    return found.drop("text_hash")


def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, folder, "labels")))


def op10_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.assign_shards(table(spark, folder, "documents"))


def op11_centroids(spark: SparkSession, folder: str) -> DataFrame:
    return centroids.with_inertia(*centroids.cluster_vectors(table(spark, folder, "embeddings")))


def op12_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    found = fingerprints.simhash_components(table(spark, folder, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")


def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = runs.find_runs(runs.with_planted_runs(table(spark, folder, "documents", "doc_id", "text")))
    line = F.transform("runs", lambda r: F.concat_ws(",", *[r[f].cast("string") for f in ("start", "length", "period")]))
    best = found.withColumn("best", runs.strongest(F.col("runs")))
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"),
        *[F.col(f"best.{name}").alias(name) for name in ("start", "length", "period")],
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(line, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))


QUERIES: dict[str, Query] = {build.__name__: build for build in (
    op1_neighbours, op2_decontamination, op3_personal_data, op4_packing, op5_substrings, op6_quality, op7_warc,
    op8_near_duplicates, op9_toxicity, op10_sharding, op11_centroids, op12_fingerprints, op13_periodic_runs)}

ORACLE: dict[str, str] = {
    "op2_decontamination": r"""
        WITH words AS (
            SELECT 'd' AS side, doc_id AS id,
                   list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM documents
            UNION ALL
            SELECT 'i', item_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '')
            FROM benchmark),
        short AS (SELECT DISTINCT len(w) AS k FROM words WHERE side = 'i' AND len(w) BETWEEN 1 AND 4),
        shingles AS (
            SELECT side, id, unnest(list_distinct(CASE WHEN len(w) >= 5
                THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
                WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END)) AS s
            FROM words
            UNION
            SELECT side, id, unnest(list_distinct(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))))
            FROM words, short WHERE side = 'd' AND len(w) >= k),
        sizes AS (SELECT id, count(*) AS q FROM shingles WHERE side = 'i' GROUP BY id),
        shared AS (
            SELECT d.id AS doc_id, i.id AS item_id, count(*) AS shared
            FROM shingles d JOIN shingles i ON d.s = i.s WHERE d.side = 'd' AND i.side = 'i' GROUP BY ALL)
        SELECT doc_id, item_id, q AS item_shingles, shared, shared / q AS containment
        FROM shared JOIN sizes ON item_id = id WHERE 100 * shared >= 80 * q""",
    "op5_substrings": r"""
        WITH tiles AS (
            SELECT doc_id, unnest(t) AS unit, generate_subscripts(t, 1) AS place
            FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), 
                '[\x20\x09\x0B-\x0D]*(?:[^\x20\x09-\x0D]+[\x20\x09\x0B-\x0D]+){4}[^\n]*?(?:[.!?,;:] |\n|$)|[^\n]+(?:\n|$)|\n') AS t FROM documents)),
        placed AS (
            SELECT doc_id, place, length(unit) AS size,
                   sum(length(unit)) OVER (PARTITION BY doc_id ORDER BY place) AS until,
                   coalesce(right(lag(unit) OVER (PARTITION BY doc_id ORDER BY place), 1) = chr(10), TRUE)
                       AND (right(unit, 1) = chr(10) OR lead(unit) OVER (PARTITION BY doc_id ORDER BY place) IS NULL) AS line,
                   trim(regexp_replace(lower(unit), '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS norm
            FROM tiles),
        units AS (
            SELECT doc_id, until - size AS start, until AS "end", norm, line, len(string_split(norm, ' ')) AS words,
                   row_number() OVER (PARTITION BY doc_id ORDER BY place) AS pos
            FROM placed WHERE norm <> ''),
        repeats AS (
            SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY norm ORDER BY doc_id, pos) AS nth FROM units)
            WHERE nth > 1),
        runs AS (
            SELECT *, pos - row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS run FROM repeats),
        removed AS (
            SELECT * FROM (SELECT *, sum(words) OVER (PARTITION BY doc_id, run) AS n FROM runs) WHERE line OR n >= 8),
        spans AS (
            SELECT doc_id, count(*) AS n_removed, sum("end" - start) AS chars,
                   string_agg(concat(CAST(start AS BIGINT), ':', CAST("end" AS BIGINT)), ',' ORDER BY start) AS spans
            FROM removed GROUP BY doc_id),
        counts AS (SELECT doc_id, count(*) AS n_units FROM units GROUP BY doc_id)
        SELECT doc_id, coalesce(n_units, 0) AS n_units, coalesce(n_removed, 0) AS n_removed,
               CAST(length(coalesce(text, '')) - coalesce(chars, 0) AS BIGINT) AS kept_chars,
               coalesce(spans, '') AS spans
        FROM documents LEFT JOIN counts USING (doc_id) LEFT JOIN spans USING (doc_id)""",
    "op7_warc": r"""
        WITH bodies AS (
            SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages),
        largest AS (SELECT hex, max(page_id) AS target FROM bodies GROUP BY hex)
        SELECT page_id, payload_bytes,
               array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                   1 + CAST(((CAST('0x' || substr(hex, 1 + 5 * (i // 4), 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31)
                            AS BIGINT), 1)), '') AS payload_digest,
               CASE WHEN page_id = target THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> target THEN target END AS refers_to
        FROM bodies JOIN largest USING (hex)""",
    "op8_near_duplicates": r"""
        WITH RECURSIVE words AS (
            SELECT doc_id, list_filter(string_split_regex(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
        sets AS (
            SELECT doc_id, list_distinct(CASE WHEN len(w) >= 3
                THEN list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))
                WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM words),
        rows_ AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
        links AS (
            SELECT a.doc_id AS a, b.doc_id AS b FROM rows_ a JOIN rows_ b ON a.x = b.x AND a.doc_id <> b.doc_id
            GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
        reach AS (
            SELECT doc_id AS a, doc_id AS b FROM documents
            UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
        least AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
        SELECT doc_id, len(s) AS n_shingles, component_id, doc_id = component_id AS kept
        FROM sets JOIN least USING (doc_id)""",
    "op10_sharding": f"""
        WITH keyed AS (
            SELECT doc_id, strlen(coalesce(text, '')) AS row_bytes,
                   CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 10) AS BIGINT) AS h FROM documents),
        levels AS (SELECT doc_id, row_bytes, CAST(d AS INTEGER) AS d, h >> (40 - CAST(d AS INTEGER)) AS prefix
                   FROM keyed, range(0, 31) r(d)),
        sums AS (SELECT *, CAST(sum(row_bytes) OVER (PARTITION BY d, prefix) AS BIGINT) AS shard_bytes,
                        count(*) OVER (PARTITION BY d, prefix) AS shard_rows FROM levels),
        first_fit AS (
            SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY d) AS nth FROM sums
            WHERE shard_bytes <= {sharding.LIMIT_BYTES} OR shard_rows = 1)
        SELECT doc_id, CASE WHEN d = 0 THEN '' ELSE lpad(bin(prefix), d, '0') END AS shard, d AS local_depth,
               row_bytes, shard_bytes, shard_rows
        FROM first_fit WHERE nth = 1""",
    "op13_periodic_runs": r"""
        WITH hashed AS (
            SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
                   xor(list_reduce(
                       flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
                                              lambda c: [ascii(c), -1, -1, -1, -1, -1, -1, -1, -1])),
                       lambda acc, x: CASE WHEN x >= 0 THEN xor(acc, x) WHEN acc % 2 = 1 THEN xor(acc // 2, 3988292384)
                                           ELSE acc // 2 END,
                       4294967295), 4294967295) AS h
            FROM documents),
        places AS (SELECT doc_id, w, len(w) AS n, h % 10 = 0 AND len(w) > 0 AS planted,
                          CASE WHEN len(w) > 0 THEN (h // 10) % len(w) END AS a, 3 + (h // 10) % 8 AS parts FROM hashed),
        texts AS (
            SELECT doc_id, n, CASE WHEN planted THEN list_transform(range(0, n), lambda i:
                       w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // parts) END]) ELSE w END AS w
            FROM places),
        windows AS (SELECT doc_id, i, hash(array_to_string(w[i + 1:i + 16], ' ')) AS x
                    FROM (SELECT doc_id, w, unnest(range(0, n - 15)) AS i FROM texts)),
        matches AS (SELECT b.doc_id, b.i, b.i - a.i AS q FROM windows a JOIN windows b
                    ON a.doc_id = b.doc_id AND a.x = b.x AND a.i < b.i),
        islands AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM matches),
        stretches AS (SELECT doc_id, q, min(i) - q AS start, count(*) + 15 + q AS length FROM islands GROUP BY doc_id, q, island),
        runs AS (SELECT doc_id, start, length, min(q) AS period FROM stretches WHERE length >= greatest(24, 3 * q)
                 GROUP BY doc_id, start, length),
        dropped AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs),
        gone AS (SELECT doc_id, list(i) AS out FROM dropped GROUP BY doc_id),
        lines AS (
            SELECT doc_id, count(*) AS n_runs,
                   arg_max({'s': start, 'l': length, 'p': period},
                           {'e': CAST(length AS DOUBLE) / period, 's': -start, 'p': -period}) AS best,
                   string_agg(concat(start, ',', length, ',', period, chr(10)), '' ORDER BY start, period) AS written
            FROM runs GROUP BY doc_id)
        SELECT doc_id, coalesce(n_runs, 0) AS n_runs, CAST(best.s AS BIGINT) AS start, CAST(best.l AS BIGINT) AS length,
               CAST(best.p AS BIGINT) AS period, CAST(1000 * best.l // best.p AS BIGINT) AS exponent_milli,
               sha256(coalesce(written, '')) AS runs_sha256,
               sha256(array_to_string(CASE WHEN out IS NULL THEN w ELSE list_transform(
                   list_filter(range(0, n), lambda i: NOT list_contains(out, i)), lambda i: w[i + 1]) END, ' ')) AS collapsed_sha256
        FROM texts LEFT JOIN gone USING (doc_id) LEFT JOIN lines USING (doc_id)""",
}


def _rounds_sql() -> str:
    """Rounds of squared distances in whole numbers, one table of centroids and one of assignments for each."""
    steps = []
    for step in range(centroids.ROUNDS + 1):
        steps.append(f"""
        d{step} AS (SELECT vec_id, v, c, list_sum(list_transform(list_zip(v, m), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d
               FROM kept, c{step}),
        a{step} AS (SELECT vec_id, v, c, d FROM d{step} QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, c) = 1)""")
        if step < centroids.ROUNDS:
            steps.append(f"""
        s{step} AS (SELECT c, i, sum(v[i]) AS s, count(*) AS n FROM a{step}, range(1, {centroids.DIMENSION + 1}) r(i) GROUP BY c, i),
        m{step} AS (SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS m FROM s{step} GROUP BY c),
        c{step + 1} AS (SELECT c{step}.c, coalesce(m{step}.m, c{step}.m) AS m FROM c{step} LEFT JOIN m{step} ON c{step}.c = m{step}.c)""")
    last = centroids.ROUNDS
    return f"""
        WITH kept AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({centroids.SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings WHERE len(embedding) = {centroids.DIMENSION}
                AND len(list_filter(embedding, lambda x: isfinite(x))) = {centroids.DIMENSION}),
        c0 AS (SELECT row_number() OVER (ORDER BY sha256(concat('1:', vec_id))) - 1 AS c, v AS m FROM kept
               QUALIFY c < {centroids.CENTROIDS}),{",".join(steps)}
        SELECT vec_id, CAST(c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance,
               CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
               sha256(array_to_string(m, ',')) AS centroid_sha256
        FROM a{last} JOIN c{last} USING (c)"""


ORACLE["op11_centroids"] = _rounds_sql()
