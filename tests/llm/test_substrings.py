import random

from retailloom.llm import substrings


def spans_of(df):
    return {r["doc_id"]: [(s["start"], s["end"]) for s in r["spans"]] for r in df.collect()}


def brute(texts, least):
    """Units in order of id and place; a repeat goes if its run of repeats has enough words."""
    seen, out = set(), {}
    for doc_id in sorted(texts):
        runs, out[doc_id] = [[]], []
        for m in substrings.UNIT.finditer(texts[doc_id]):
            words = m.group().lower().split()
            if not words:
                continue
            key = " ".join(words)
            if key in seen:
                runs[-1].append((m.start(), m.end(), len(words)))
            else:
                runs.append([])
            seen.add(key)
        for run in runs:
            enough = sum(n for _, _, n in run) >= least
            out[doc_id] += [(a, b) for a, b, _ in run if enough or texts[doc_id][a:b] in whole_lines(texts[doc_id], a)]
    return out


def whole_lines(text, at):
    """The line that starts at this place, with or without its end."""
    if at and text[at - 1] != "\n":
        return ()
    line = text[at:].split("\n")[0]
    return (line + "\n",) if at + len(line) < len(text) else (line,)


def test_equals_brute_force(documents):
    rng = random.Random(1)
    sentences = [" ".join(rng.choice("alpha beta gamma delta eps zeta".split()) for _ in range(rng.randint(1, 9)))
                 + rng.choice([". ", "! ", "\n", "\n\n"]) for _ in range(60)]
    texts = {i: "".join(rng.choice(sentences) for _ in range(rng.randint(0, 12))) for i in range(80)}
    assert spans_of(substrings.repeated_units(documents(texts.items()))) == brute(texts, 8)


def test_a_passage_inside_a_line_is_found_and_the_first_stays(documents):
    passage = "One red fox ran over the hill. Two old dogs slept there. Nobody saw it at all. "
    docs = documents([(2, "before it " + passage + "after it."), (1, "Something else. " + passage), (3, "Clean text here.")])
    found = spans_of(substrings.repeated_units(docs))
    assert found[1] == found[3] == []
    assert [("before it " + passage)[a:b] for a, b in found[2]] == ["Two old dogs slept there. ", "Nobody saw it at all. "]


def test_units_fall_into_step_again(documents):
    passage = "Go. The red fox ran off. Two dogs slept on the mat. No. Nobody ever saw any of it here. "
    docs = documents([(1, passage + "End of it."), (2, "And then he said: " + passage + "Other end of it.")])
    start, end = spans_of(substrings.repeated_units(docs))[2][0][0], spans_of(substrings.repeated_units(docs))[2][-1][1]
    text = "And then he said: " + passage
    assert text[start:end] == "Two dogs slept on the mat. No. Nobody ever saw any of it here. "


def test_cut_text_keeps_columns(documents):
    line = "the very same line of nine words is here\n"
    out = substrings.without_repeats(documents([(1, line + "a b"), (2, line + "c d"), (3, None)]))
    rows = {r["doc_id"]: r for r in out.collect()}
    assert (rows[1]["text"], rows[2]["text"], rows[3]["text"]) == (line + "a b", "c d", None)
    assert rows[2]["lang"] == "en" and [tuple(s) for s in rows[2]["spans"]] == [(0, len(line))]


def test_case_and_white_space_are_folded_and_short_lines_go(documents):
    docs = documents([(1, "A b c d e f g H\nshort one\n"), (2, "a  B c d\te f g h\nnew\nshort one\n"), (3, "x y\nShort  one")])
    assert spans_of(substrings.repeated_units(docs)) == {1: [], 2: [(0, 17), (21, 31)], 3: [(4, 14)]}


def test_short_clauses_inside_a_line_stay(documents):
    docs = documents([(1, "One two three four five. Yes. And so on it goes here."), (2, "One two three four five. Six other words are in here."),
                      (3, "Six more words than that here. Yes.")])
    assert spans_of(substrings.repeated_units(docs)) == {1: [], 2: [], 3: []}


def test_repeated_rows_null_ids_and_empty_texts(documents, empty):
    text = "one two three four five six seven eight nine"
    docs = documents([(4, text), (4, text), (None, text), (5, None), (6, ""), (7, "\n \n")])
    found = substrings.repeated_units(docs).collect()
    cut = [(r["doc_id"], len(r["spans"])) for r in found]
    assert sorted(cut, key=str) == sorted([(4, 0), (4, 1), (None, 1), (5, 0), (6, 0), (7, 0)], key=str)
    assert substrings.repeated_units(empty).collect() == []
    assert substrings.without_repeats(empty).collect() == []


def test_very_long_text(documents):
    text = "".join(f"sentence number {i % 1000} of a long text. " for i in range(20_000))
    found = spans_of(substrings.repeated_units(documents([(1, text)])))
    assert len(found[1]) == 19_000
