import random
import re

import duckdb

from retailloom.llm.decontaminate import clean_documents, contained_items
from retailloom.llm.queries import ORACLE

ITEMS = "item_id long, text string, extra string"


def words(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def shingles(text, k=5):
    w = words(text)
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} or ({tuple(w)} if w else set())


def brute(docs, items, percent=80):
    out = set()
    for d, text in docs:
        for i, item in items:
            q = shingles(item)
            n = len(words(item))
            have = shingles(text) if n >= 5 else {tuple(words(text)[j:j + n]) for j in range(len(words(text)) - n + 1)}
            shared = len(q & have)
            if q and shared * 100 >= percent * len(q):
                out.add((d, i, len(q), shared))
    return out


def items_of(spark, rows):
    return spark.createDataFrame([(i, t, "x") for i, t in rows], ITEMS)


def found(docs, items):
    return {(r["doc_id"], r["item_id"], r["item_shingles"], r["shared"]) for r in contained_items(docs, items).collect()}


def test_equals_brute_force_at_every_share(spark, documents):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(300)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(1, 70)))) for i in range(30)]
    docs = []
    for d in range(120):
        item = rng.choice(items)[1].split()
        cut = [w if rng.random() > rng.choice([0, 0.02, 0.05]) else "other" for w in item]
        filler = rng.choices(vocabulary, k=rng.randint(0, 400))
        docs.append((d, " ".join(filler + cut[:rng.randint(len(cut) * 3 // 4, len(cut))] + filler[:20])))
    expected = brute(docs, items)
    assert len(expected) > 40
    assert found(documents(docs), items_of(spark, items)) == expected


def test_nulls_empties_short_items_and_repeats(spark, documents, empty):
    item = "one two three four five six seven"
    docs = documents([(1, item.upper() + "!"), (1, item.upper() + "!"), (None, "x " + item), (2, None), (3, ""),
                      (4, "yes, no"), (5, "yes no maybe"), (6, "... !!")])
    items = items_of(spark, [(10, item), (11, "Yes; no"), (12, None), (13, ""), (None, item + " eight")])
    assert found(docs, items) == {(1, 10, 3, 3), (None, 10, 3, 3), (4, 11, 1, 1), (5, 11, 1, 1)}
    assert contained_items(empty, items).collect() == []
    assert contained_items(docs, items.where("false")).collect() == []
    assert sorted(r["doc_id"] for r in clean_documents(docs, items).collect()) == [2, 3, 6]
    assert clean_documents(docs, items).columns == docs.columns


def test_items_of_one_to_four_words_inside_long_texts_and_sql(spark, documents, tmp_path):
    docs = [(1, "so the quick brown fox ran"), (2, "quick, brown"), (3, "brown quick fox the"), (4, "fox"), (5, None), (6, "of a brown fox")]
    items = [(10, "Quick brown"), (11, "fox"), (12, "the quick brown fox"), (13, "brown fox ran off"), (14, "a"),
             (15, "so the quick brown fox ran")]
    expected = brute(docs, items)
    assert {(d, i) for d, i, *_ in expected} == {(1, 10), (2, 10), (1, 11), (3, 11), (4, 11), (6, 11), (1, 12), (6, 14), (1, 15)}
    assert found(documents(docs), items_of(spark, items)) == expected
    con = duckdb.connect()
    con.execute("CREATE TABLE documents AS SELECT * FROM (VALUES {}) t(doc_id, text)".format(", ".join(
        f"({i}, {'NULL' if t is None else repr(t)})" for i, t in docs)))
    con.execute("CREATE TABLE benchmark AS SELECT * FROM (VALUES {}) t(item_id, text)".format(", ".join(map(str, items))))
    sql = con.sql(f"SELECT doc_id, item_id, item_shingles, shared FROM ({ORACLE['op2_decontamination']})").fetchall()
    assert set(sql) == expected


def test_a_very_long_document_and_a_very_frequent_passage(spark, documents):
    item = " ".join(f"q{i}" for i in range(40))
    long_text = " ".join(f"a{i % 977}" for i in range(60_000))
    docs = documents([(i, f"x{i} {item} y{i}") for i in range(200)] + [(999, long_text + " " + item), (1000, long_text)])
    assert {r[0] for r in found(docs, items_of(spark, [(1, item)]))} == {*range(200), 999}


def test_only_sql_operators(spark, documents):
    plan = contained_items(documents([(1, "a")]), items_of(spark, [(1, "a"), (2, "a b c d e f")]))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|ArrowEval|ExternalRDD|CartesianProduct", plan)
