"""Personal data: exact base patterns, and further spans that boosted trees pick among loose candidates.

Everything on the main path is SQL functions, row by row; only the table of feature cells is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailloom.session import materialize

KINDS = ("email", "ip", "card", "phone")
PRECISION = 0.95  # of the spans a threshold adds, on the held-out half
ROUNDS, DEPTH = 10, 4

# The base patterns. Possessive quantifiers and the look-behinds change no match: they keep a long run of letters
# or digits from being tried from each of its places, and a long number from deepening the matcher's stack.
_NAME = "A-Za-z0-9._%+-"
BASE = {
    "email": rf"(?:\G|(?<![{_NAME}]))[{_NAME}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# The candidate generators: looser, and free to overlap.
LOOSE = {
    "email": rf"(?<![{_NAME}])[{_NAME}]++ ?(?:@|\(at\)|\[at\]) ?[A-Za-z0-9-]++"
             r"(?: ?(?:\.|\(dot\)|\[dot\]) ?[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9.])[0-9]{1,3}(?:(?: ?\. ?|\[\.\])[0-9]{1,3}){3}(?![0-9])",
    "card": r"(?<![0-9])[0-9](?:[\x20.-]?[0-9]){11,18}(?![0-9])",
    "phone": r"(?<![0-9])(?:\+|00)?\(?[0-9](?:[\x20().-]{0,2}[0-9]){8,14}(?![0-9])",
}
GUARD = {"email": "[@(\\[]", "ip": "[0-9]", "card": "[0-9]", "phone": "[0-9]"}
CUES = {"email": "(?:mail|contact|write)", "ip": "(?:ip|host|server|address)", "card": "(?:card|visa|account|pay)",
        "phone": "(?:call|tel|phone|fax|mobile)"}
FEATURES = {  # name: number of values; a cell is one combination, so there are at most 73,728
    "kind": 4, "digits": 8, "separators": 4, "plus": 2, "bracket": 2, "lead": 4, "cue": 2, "left": 3, "right": 3,
    "grouped": 2,
}
BLOCK = 256


def _running(lengths: Column) -> Column:
    """The sum of all entries before each one. In blocks: appending to one long array would copy it each time."""
    def within(block: Column) -> Column:
        start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<bigint>").alias("out"))
        return F.aggregate(block, start, lambda s, x: F.struct(
            (s["at"] + x).alias("at"), F.concat(s["out"], F.array(s["at"])).alias("out")), lambda s: s["out"])

    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / BLOCK).cast("int")),
                         lambda b: F.slice(lengths, b * BLOCK + 1, F.lit(BLOCK)))
    bases = within(F.transform(blocks, lambda b: F.aggregate(b, F.lit(0).cast("long"), lambda s, x: s + x)))
    return F.flatten(F.zip_with(blocks, bases, lambda b, base: F.transform(within(b), lambda v: v + base)))


def _matches(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches: array of start, end (code points), found, before and after."""
    quoted = F.lit(pattern)
    pieces = F.split(text, pattern, -1)
    found = F.regexp_extract_all(text, quoted, F.lit(0))
    with_both = F.struct(pieces.alias("pieces"), found.alias("found"))

    def placed(both: Column) -> Column:
        steps = F.zip_with(both["found"], F.slice(both["pieces"], F.lit(1), F.size(both["found"])),
                           lambda m, p: (F.char_length(m) + F.char_length(p)).cast("long"))
        return F.transform(
            F.arrays_zip(both["found"].alias("m"), _running(steps).alias("at"),
                         F.slice(both["pieces"], F.lit(1), F.size(both["found"])).alias("before"),
                         F.slice(both["pieces"], F.lit(2), F.size(both["found"])).alias("after")),
            lambda x: F.struct(
                (x["at"] + F.char_length(x["before"])).cast("int").alias("start"),
                (x["at"] + F.char_length(x["before"]) + F.char_length(x["m"])).cast("int").alias("end"),
                x["m"].alias("found"), F.substring(x["before"], -16, 16).alias("before"),
                F.substring(x["after"], 1, 1).alias("after")))

    # The arrays are bound to a name by a one-entry transform, so that they are computed once.
    return F.when(F.size(found) > 0, F.element_at(F.transform(F.array(with_both), placed), 1))


def _digits(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


_PART = r"0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9][0-9]?)?"
CHECKS: dict[str, Callable[[Column], Column]] = {
    "email": lambda found: F.lit(True),
    "ip": lambda found: found.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$"),
    "card": lambda found: F.when(F.length(_digits(found)).between(14, 19), F.call_function("luhn_check", _digits(found)))
                           .otherwise(False),
    "phone": lambda found: F.length(_digits(found)).between(10, 15),
}


def _features(kind: str, x: Column) -> dict[str, Column]:
    found, digits = x["found"], F.length(_digits(x["found"]))
    lead = F.substring(_digits(found), 1, 1)
    separators = F.length(F.regexp_replace(found, "[A-Za-z0-9]", ""))

    def beside(side: Column, at: int) -> Column:
        mark = F.substring(side, at, 1)
        return F.when(mark.rlike(r"^[\p{L}\p{N}@_]$"), 2).when(mark.rlike(r"^[\s,.;:!?()]?$"), 0).otherwise(1)

    return {
        "kind": F.lit(KINDS.index(kind)),
        "digits": F.when(digits < 9, 0).when(digits < 10, 1).when(digits < 12, 2).when(digits < 14, 3)
                   .when(digits < 16, 4).when(digits == 16, 5).when(digits < 20, 6).otherwise(7),
        "separators": F.least(separators, F.lit(3)),
        "plus": found.startswith("+").cast("int"),
        "bracket": found.rlike(r"[(\[]").cast("int"),
        "lead": F.when(lead.isin("4", "5", "6"), 1).when(lead == "0", 2).when(lead == "", 3).otherwise(0),
        "cue": x["before"].rlike(rf"(?i){CUES[kind]}\W*$").cast("int"),
        "left": beside(x["before"], -1), "right": beside(x["after"], 1),
        "grouped": found.rlike(_GROUPS if kind == "phone" else r"[0-9]{3,4}[\x20.-][0-9]{3,4}").cast("int"),
    }


# A phone number's usual groups of three, three and four digits.
_GROUPS = r"^(?:(?:\+|00)?[0-9]{1,3}[\x20.-])?\(?[0-9]{3}\)?[\x20.-]{1,2}[0-9]{3}[\x20.-][0-9]{4}$"


def _form(kind: str, x: Column) -> Column:
    """What a candidate is an example of: 1 if its normal form is one of its kind and passes the check, 0 if not, and
    -1, none, if nothing tells."""
    found, cue = x["found"], x["before"].rlike(rf"(?i){CUES[kind]}\W*$")
    if kind == "email":  # one that holds a base span and more overlaps it, and is never added
        plain = F.regexp_replace(F.regexp_replace(found, r" ?(?:\(at\)|\[at\]|@) ?", "@"), r" ?(?:\(dot\)|\[dot\]) ?", ".")
        holds = found.rlike(r"[A-Za-z0-9._%+-]@[A-Za-z0-9-]+\.[A-Za-z0-9-]") & found.contains(" ")
        return F.when(holds, -1).when(plain.rlike(rf"^{BASE['email']}$"), 1).otherwise(0)
    if kind == "ip":  # apart, the numbers of a list look the same
        close, apart = F.regexp_replace(found, r"\[\.\]", "."), F.regexp_replace(found, r" ?\. ?|\[\.\]", ".")
        return F.when(CHECKS["ip"](close) | (cue & CHECKS["ip"](apart)), 1).otherwise(0)
    if kind == "card":
        digits = _digits(found)
        return F.when(F.length(digits).between(12, 19) & F.call_function("luhn_check", digits), 1).otherwise(0)
    sign = found.startswith("+") | found.contains("(") | found.rlike(_GROUPS) | cue
    return F.when(~CHECKS["phone"](found), 0).when(sign, 1).otherwise(-1)


def _cell(kind: str, x: Column) -> Column:
    code = F.lit(0)
    for name, value in _features(kind, x).items():
        code = code * FEATURES[name] + F.coalesce(value, F.lit(0))
    return code.cast("int")


def _decoded(cell: Column) -> dict[str, Column]:
    out, rest = {}, cell
    for name in reversed(FEATURES):
        out[name] = (rest % FEATURES[name]).cast("int")
        rest = F.floor(rest / FEATURES[name])
    return out


_SPANS = "array<struct<start:int,kind:int,end:int>>"
_CANDIDATES = "array<struct<start:int,kind:int,end:int,cell:int,form:int>>"


def _base_spans(number: int, text: Column) -> Column:
    kind = KINDS[number]
    guard = text.contains("@") if kind == "email" else text.rlike("[0-9]")
    passed = F.filter(F.when(guard, _matches(text, BASE[kind])), lambda x: CHECKS[kind](x["found"]))
    return F.transform(passed, lambda x: F.struct(x["start"], F.lit(number).alias("kind"), x["end"]))


def _loose_spans(number: int, text: Column) -> Column:
    kind = KINDS[number]
    return F.transform(F.when(text.rlike(GUARD[kind]), _matches(text, LOOSE[kind])), lambda x: F.struct(
        x["start"], F.lit(number).alias("kind"), x["end"], _cell(kind, x).alias("cell"),
        _form(kind, x).alias("form")))


def with_candidates(docs: DataFrame) -> DataFrame:
    """``docs`` with ``base`` and ``loose`` spans, each sorted by start and kind, and the row's ``place``. To be
    written before it is used, so that the places stay."""
    text = F.coalesce(F.col("text"), F.lit(""))
    base = [_base_spans(number, text) for number in range(len(KINDS))]
    loose = [_loose_spans(number, text) for number in range(len(KINDS))]

    def gathered(parts: list[Column], type_: str) -> Column:
        return F.array_sort(F.concat(*[F.coalesce(p, F.array().cast(type_)) for p in parts]).cast(type_))

    return docs.withColumns({"base": gathered(base, _SPANS), "loose": gathered(loose, _CANDIDATES),
                             "place": F.monotonically_increasing_id()})


def _code(span: Column) -> Column:
    """A span as one number, by which arrays of spans are compared by hash."""
    return (span["start"].cast("long") * len(KINDS) + span["kind"]) * (1 << 30) + (span["end"] - span["start"])


def _span(code: Column) -> Column:
    place = F.shiftright(code, 30)
    start = F.shiftright(place, 2).cast("int")
    return F.struct(start.alias("start"), (place % len(KINDS)).cast("int").alias("kind"),
                    (start + code % (1 << 30)).cast("int").alias("end"))


@dataclass
class Selection:
    """The feature cells whose candidates are redacted, and the threshold of each kind."""

    cells: list[int]
    thresholds: dict[str, float]


def fit(found: DataFrame) -> Selection:
    """Boosted trees over the cells of all candidates of ``found(place, base, loose)``.

    A candidate is an example for its kind if it is a base span of that kind or its normal form passes the kind's check
    (``_form``), and a counter-example if it fails that; a phone number without plus, bracket, cue word or usual groups
    is neither, and its cell has no examples and is not chosen. All others count: they are summed by cell and half (a hash of cell and place), so the trees and thresholds see
    at most two rows for each of the 73,728 cells, whatever the size of the corpus. A kind's threshold is the
    lowest score at which the held-out half has ``PRECISION``; a kind that never reaches it adds nothing.
    """
    proposed = found.select("place", F.explode("loose").alias("c")).select(
        "place", _code(F.col("c")).alias("code"), "c.cell", F.col("c.form").alias("good"))
    confirmed = found.select("place", F.explode("base").alias("b")).select(
        "place", _code(F.col("b")).alias("code"), F.lit(None).cast("int").alias("cell"), F.lit(1).alias("good"))
    one = (proposed.unionByName(confirmed).groupBy("place", "code")
           .agg(F.max("cell").alias("cell"), F.max("good").alias("good")).where("cell is not null and good >= 0")
           .withColumn("held", F.xxhash64("cell", "code") % 2 == 0))
    cells = materialize(one.groupBy("cell", "held").agg(F.sum("good").alias("good"), F.count("*").alias("n"))
                        .coalesce(1), "cells")
    examples = cells.select("*", *[v.alias(k) for k, v in _decoded(F.col("cell")).items()])
    examples = examples.withColumn("example", F.explode(F.array(
        F.struct(F.lit(1.0).alias("label"), F.col("good").cast("double").alias("weight")),
        F.struct(F.lit(0.0).alias("label"), (F.col("n") - F.col("good")).cast("double").alias("weight"))))).select(
            *FEATURES, "cell", "held", "n", "good", "example.*")
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(examples)
    train = vectors.where(~F.col("held") & (F.col("weight") > 0))
    seen = {r["label"] for r in vectors.where("weight > 0").select("label").distinct().collect()}
    if seen == {1.0}:  # nothing to tell the examples from
        alike = cells.collect()  # at most two rows a cell
        return Selection(sorted({r["cell"] for r in alike}), {})
    if train.select("label").distinct().count() < 2:
        return Selection([], {})
    trees = GBTClassifier(maxIter=ROUNDS, maxDepth=DEPTH, stepSize=0.3, weightCol="weight", seed=1).fit(train)
    scored = (trees.transform(vectors.where("label = 1")).withColumn("score", vector_to_array("probability")[1])
              .select("cell", "kind", "held", "n", "good", "score"))
    ranked: dict[int, list] = {}
    for r in scored.collect():  # at most two rows a cell
        ranked.setdefault(r["kind"], []).append(r)
    chosen, thresholds = [], {}
    for kind, rows in ranked.items():
        best, good, n = None, 0, 0
        levels = sorted({r["score"] for r in rows}, reverse=True)
        for level in levels:
            at = [r for r in rows if r["held"] and r["score"] == level]
            good, n = good + sum(r["good"] for r in at), n + sum(r["n"] for r in at)
            if n and good >= PRECISION * n:
                best = level
        if best is not None:
            thresholds[KINDS[kind]] = best
            chosen += [r["cell"] for r in rows if r["score"] >= best]
    return Selection(sorted(set(chosen)), thresholds)


def spans(found: DataFrame, selection: Selection) -> DataFrame:
    """``found`` with ``added`` (chosen candidates clear of the base spans and of each other, leftmost first) and
    ``spans`` (all of them in order)."""
    chosen = F.filter("loose", lambda c: c["cell"].isin(selection.cells) if selection.cells else F.lit(False))
    new = F.transform(F.array_except(F.transform(chosen, _code), F.transform("base", _code)), _span)
    clear = F.filter(new, lambda c: ~F.exists("base", lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])))
    start = F.struct(F.lit(-1).alias("at"), F.array().cast(_SPANS).alias("out"))
    apart = F.aggregate(clear, start, lambda s, c: F.when(c["start"] >= s["at"], F.struct(
        c["end"].alias("at"), F.concat(s["out"], F.array(F.struct(c["start"], c["kind"], c["end"]))).alias("out")))
        .otherwise(s), lambda s: s["out"])
    return found.withColumn("added", apart).withColumn("spans", F.array_sort(F.concat("base", "added")))


def count_of(spans_: str, kind: str) -> Column:
    return F.size(F.filter(spans_, lambda s: s["kind"] == KINDS.index(kind))).cast("long")


def written(spans_: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(kind) for kind in KINDS])
    return F.array_join(F.transform(spans_, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def find_personal_data(docs: DataFrame) -> DataFrame:
    """Per row of ``docs(doc_id, text)``: doc_id, ``base``, ``added`` and ``spans``.

    Base spans are the leftmost non-overlapping matches of each kind that pass the kind's check; they always stay.
    Null and empty texts have no span, repeated rows give repeated results, an empty table gives none. Offsets
    count code points, ends are exclusive. Other columns are not read.
    """
    found = materialize(with_candidates(docs.select("doc_id", "text")).drop("text"), "candidates")
    return spans(found, fit(found))


def redacted(docs: DataFrame, names: dict[str, str] | None = None) -> DataFrame:
    """``docs`` with every span of ``text`` replaced by its kind in brackets; overlapping spans as one.

    All columns stay, and ``n_chars``, if there, follows the new text; a column named base, loose, added, spans or place
    of the input is dropped. A null text stays null.
    """
    own = docs.drop("base", "loose", "added", "spans", "place")
    found = materialize(with_candidates(own), "candidates")
    marks = F.array(*[F.lit((names or {}).get(kind, f"[{kind}]")) for kind in KINDS])
    marked = spans(found, fit(found))
    rest = F.struct(F.lit(0).alias("at"), F.col("text").alias("rest"), F.array().cast("array<string>").alias("out"))

    def step(s: Column, x: Column) -> Column:
        ahead = x["start"] - s["at"]
        return F.when(x["start"] >= s["at"], F.struct(
            x["end"].alias("at"), F.substr(s["rest"], x["end"] - s["at"] + 1).alias("rest"),
            F.concat(s["out"], F.array(F.substr(s["rest"], F.lit(1), ahead), F.element_at(marks, x["kind"] + 1)))
            .alias("out"))).when(x["end"] > s["at"], F.struct(
                x["end"].alias("at"), F.substr(s["rest"], x["end"] - s["at"] + 1).alias("rest"),
                s["out"].alias("out"))).otherwise(s)

    text = F.when(F.size("spans") == 0, F.col("text")).otherwise(F.aggregate(
        "spans", rest, step, lambda s: F.concat(F.array_join(s["out"], ""), s["rest"])))
    out = marked.withColumn("text", text)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*own.columns)
