import hashlib
import random
import re

from pyspark.sql import functions as F

from retailloom.llm import pii
from retailloom.llm.queries import op3_personal_data

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def base(text):
    out = []
    for k, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            good = {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m.group().split(".")),
                    "card": 14 <= len(digits) <= 19 and luhn(digits), "phone": 10 <= len(digits) <= 15}[kind]
            if good:
                out.append((m.start(), k, m.end()))
    return [f"{list(PATTERNS)[k]}:{a}:{b}" for a, k, b in sorted(out)]


def written(docs):
    return {r["doc_id"]: r["b"] for r in pii.find_personal_data(docs).select(
        "doc_id", pii.written(F.col("base")).alias("b")).collect()}


HARD = ["a@b.c%x@y.z", "a@b.cc@d.e", "é a.b+c@d-e.f.g, x", "1.2.3.4.5.6.7.8", "999.1.1.1 0001.02.3.255", "1  23 4",
        "+1 (658) 555-4270.", "+12 +34", "4871773763039823", "4871 7737-6303 9823 x", "4871773763039824", "+1+1+1234567890",
        "@@@", "x@", "@y.z", "𝒳 é 10.0.0.1 𝒳", "..@a.b", "a@b", "1.2.3", "00000000000000", "+" + "1" * 16, "1" * 20]


def test_base_spans_equal_the_plain_patterns(documents):
    rng = random.Random(2)
    texts = HARD + ["".join(rng.choice("ab@.+-%() 0123456789é") for _ in range(rng.randint(1, 120))) for _ in range(300)]
    texts += ["".join(rng.choice(HARD) + rng.choice(" ,\n") for _ in range(5)) for _ in range(60)]
    found = written(documents(list(enumerate(texts))))
    assert {i: found[i].split(",") if found[i] else [] for i in found} == {i: base(t) for i, t in enumerate(texts)}


def test_very_long_texts(documents):
    texts = {1: "a" * 20_000, 2: "1" * 20_000, 3: "1 " * 100_000, 4: "x@y.zz 10.0.0.1 " * 3000, 5: "+1" + "(" * 50_000,
             6: "a.b" * 6_000 + "@"}
    found = written(documents(list(texts.items())))
    assert {i: found[i].split(",") if found[i] else [] for i in found} == {i: base(t) for i, t in texts.items()}


def test_the_query_keeps_every_base_span(spark, folder):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = op3_personal_data(spark, folder).collect()
    assert {r["doc_id"] for r in rows} == set(texts)
    for r in rows:
        expected = base(texts[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(",".join(expected).encode()).hexdigest()
        assert set(expected) <= set(r["spans"].split(","))
        for kind in PATTERNS:
            assert r[f"n_{kind}"] == sum(s.startswith(kind) for s in expected)


def test_trees_add_spans_that_look_like_the_confirmed_ones(documents):
    rng = random.Random(5)
    docs = []
    for i in range(600):
        number = "".join(rng.choice("0123456789") for _ in range(9))
        docs.append((i, f"call me {number[:3]}. or +1 ({number[:3]}) {number[3:6]}-{number[5:9]} now"))
    docs += [(1000 + i, f"write to someone{i}@mail.example.com please") for i in range(300)]
    docs += [(2000, "write to someone (at) mail.example.com please")]
    found = pii.find_personal_data(documents(docs)).collect()
    assert sum(len(r["base"]) for r in found) == 900
    for r in found:
        for a in r["added"]:
            assert not any(a["start"] < b["end"] and b["start"] < a["end"] for b in r["base"])


def test_forms_beyond_the_base_patterns_are_added(documents):
    rng = random.Random(6)

    def card(n):
        digits = "".join(rng.choice("123456789") for _ in range(n - 1))
        return next(digits + c for c in "0123456789" if luhn(digits + c))

    texts, planted = [], {}
    for i in range(400):
        number, dotted = "".join(rng.choice("123456789") for _ in range(10)), card(16)
        forms = [f"someone{i} (at) mail{i} [dot] com", f"10[.]0[.]{i % 200 + 1}[.]7",
                 ".".join(dotted[k:k + 4] for k in range(0, 16, 4)), f"{number[:3]}-{number[3:6]}-{number[6:]}"]
        form = forms[i % 4]
        before = "so " * rng.randint(1, 60) + "it says "
        texts.append((i, f"{before}{form} here"))
        planted[i] = (len(before), i % 4)
    kinds = [pii.KINDS.index(k) for k in ("email", "ip", "card", "phone")]
    texts += [(1000 + i, "so " * rng.randint(1, 60) + f"write to a{i}@b.example or 10.0.{i % 200}.1 or {card(16)} or +1 658 555 {1000 + i} today")
              for i in range(200)]
    wrong = ["part 999.300.{0}.400 of", "order {0}23456789 of", "lot {1} of"]  # fail the checks, or nothing tells
    for i in range(600):
        bad = next(n for n in iter(lambda: "".join(rng.choice("123456789") for _ in range(16)), "") if not luhn(n))
        texts.append((2000 + i, "so " * rng.randint(1, 60) + wrong[i % 3].format(rng.randint(300, 900), bad)))
    rows = {r["doc_id"]: r["added"] for r in pii.find_personal_data(documents(texts)).collect()}
    missed = [i for i, (start, k) in planted.items() if not any(a["start"] == start and a["kind"] == kinds[k] for a in rows[i])]
    assert missed == []
    assert sum(len(rows[i]) for i in rows if i >= 2000 and i % 3 != 1) == 0


def test_nothing_to_learn_from(documents, empty):
    docs = documents([(1, None), (2, ""), (None, "no data"), (3, "x@y.zz"), (3, "x@y.zz")])
    found = [(r["doc_id"], len(r["spans"])) for r in pii.find_personal_data(docs).collect()]
    assert sorted(found, key=str) == sorted([(1, 0), (2, 0), (None, 0), (3, 1), (3, 1)], key=str)
    assert pii.find_personal_data(empty).collect() == [] and pii.redacted(empty).collect() == []


def test_redaction(documents):
    docs = documents([(1, "é x@y.zz, 10.0.0.1!"), (2, None), (3, "clean")])
    out = {r["doc_id"]: r for r in pii.redacted(docs).collect()}
    assert (out[1]["text"], out[2]["text"], out[3]["text"]) == ("é [email], [ip]!", None, "clean")
    assert (out[1]["n_chars"], out[3]["n_chars"], out[1]["bits"]) == (16, 5, "own") and "spans" not in out[1].asDict()
    assert set(out[1].asDict()) >= {"doc_id", "text", "lang", "row", "n_chars"}


def test_only_sql_operators(documents):
    plan = pii.with_candidates(documents([(1, "a")]))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|ArrowEval", plan)
