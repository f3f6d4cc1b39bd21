"""The registered queries of the subpackage against their SQL, and the pipeline against a plain version."""

import importlib

import pytest

import __spark_entry__ as contract
import corpus_pipeline
from retailloom.llm import decontaminate, near_duplicates, packing, pii, toxicity
from retailloom.llm.common import table
from retailloom.llm.queries import ORACLE, QUERIES
from tests.compare import connect, difference
from tests.llm.test_decontaminate import brute as leaks
from tests.llm.test_near_duplicates import brute as groups
from tests.llm.test_pii import base


def test_each_operator_has_its_query():
    names = set(contract.queries())
    assert {n.split("_")[0] for n in QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= names and set(ORACLE) <= set(QUERIES)
    assert set(ORACLE) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, folder, name):
    assert difference(QUERIES[name](spark, folder), connect(folder), ORACLE[name]) is None


COLUMNS = {
    "op1_neighbours": [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "double")],
    "op3_personal_data": [("doc_id", "bigint"), ("n_email", "bigint"), ("n_ip", "bigint"), ("n_card", "bigint"),
                          ("n_phone", "bigint"), ("base_sha256", "string"), ("spans", "string"), ("n_added", "bigint")],
    "op4_packing": [("doc_id", "bigint"), ("piece", "int"), ("start", "bigint"), ("length", "bigint"),
                    ("ids_crc32", "bigint"), ("sequence_id", "bigint"), ("offset", "bigint")],
    "op6_quality": [("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"), ("predicted", "int")],
    "op7_warc": [("page_id", "bigint"), ("payload_bytes", "bigint"), ("payload_digest", "string"),
                 ("record_type", "string"), ("refers_to", "bigint")],
    "op8_near_duplicates": [("doc_id", "bigint"), ("n_shingles", "bigint"), ("component_id", "bigint"),
                            ("kept", "boolean")],
    "op9_toxicity": [("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"), ("predicted", "int")],
    "op11_centroids": [("vec_id", "bigint"), ("cluster", "int"), ("distance", "bigint"), ("cluster_inertia", "bigint"),
                       ("inertia", "bigint"), ("centroid_sha256", "string")],
    "op12_fingerprints": [("doc_id", "bigint"), ("fingerprint", "string"), ("component_id", "bigint")],
    "op13_periodic_runs": [("doc_id", "bigint"), ("n_runs", "bigint"), ("start", "bigint"), ("length", "bigint"),
                           ("period", "bigint"), ("exponent_milli", "bigint"), ("runs_sha256", "string"),
                           ("collapsed_sha256", "string")],
}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns(spark, folder, name):
    assert QUERIES[name](spark, folder).dtypes == COLUMNS[name]


def test_pipeline_equals_a_plain_version(spark, folder):
    docs = table(spark, folder, "documents")
    model = toxicity.fit(docs, table(spark, folder, "labels"))
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    scores = model.scores([t or "" for _, t in rows])
    texts = {i: t for (i, t), s in zip(rows, scores) if s < toxicity.THRESHOLD}
    texts = _kept(texts)
    items = [(r["item_id"], r["text"]) for r in table(spark, folder, "benchmark").collect()]
    bad = {d for d, *_ in leaks(list(texts.items()), items)}
    texts = {i: t for i, t in texts.items() if i not in bad}
    found = corpus_pipeline.run(spark, folder).collect()
    assert {r["doc_id"] for r in found} == set(texts)
    plain = {i for i, t in texts.items() if not base(t)}
    tokenizer = packing.WordTokenizer(packing.default_tokenizer())
    ids = {i: tokenizer.encode(texts[i]) for i in plain}
    lengths = {}
    for r in found:
        lengths[r["doc_id"]] = lengths.get(r["doc_id"], 0) + r["length"]
    same = [i for i in plain if lengths[i] == len(ids[i]) // 4 + 1]
    assert len(same) >= len(plain) - sum(1 for r in pii.find_personal_data(docs).where("size(added) > 0").collect())


def _kept(texts):
    found = groups(texts, 5, 80)
    return {i: t for i, t in texts.items() if found[i][1] == i}


def test_stages_take_and_return_documents(spark, folder):
    docs = table(spark, folder, "documents")
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "near_duplicates", "decontamination", "personal_data", "packing"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, folder).dtypes == docs.dtypes


def test_import_errors_are_not_swallowed():
    for module in (corpus_pipeline, decontaminate, near_duplicates):
        assert "except ImportError" not in importlib.util.find_spec(module.__name__).loader.get_source(module.__name__)
