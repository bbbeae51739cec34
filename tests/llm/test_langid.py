import numpy as np
import pytest
from pyspark.sql import functions as F

from stratamart.llm import langid
from stratamart.llm.common import table

SAMPLES = {"aa": "abra kadabra abrakadabra alabama", "bb": "bilbo bibo bob lobo oblio", "cc": "zyzzyva xyz yzx"}


def brute_phrases(text, sample):
    """Longest phrases that occur in the sample, one after the other, in segments of whole symbols."""
    norm = lambda t: " ".join("".join(c.lower() if c.isalpha() else " " for c in t).split())
    known = norm(sample)
    symbols = norm(text) + " " if norm(text) else ""
    count = 0
    for at in range(0, len(symbols), langid.SEGMENT):
        part, phrase, count = symbols[at : at + langid.SEGMENT], "", count + 1
        for c in part:
            if phrase + c in known:
                phrase += c
            else:
                count += 1
                phrase = c if c in known else ""
    return count


@pytest.mark.parametrize(
    "text", ["abracadabra", "bob", "Xylophon yz", "alabama " * 80, "a", "ßé", "lobo, bilbo!", "kadabra bilbo xyz " * 40]
)
def test_phrases_as_by_searching_the_samples(text):
    model = langid.compile_model(SAMPLES)
    counts, letters = langid.phrases(model, [text, "other", text])
    assert counts[0].tolist() == counts[2].tolist() == [brute_phrases(text, SAMPLES[n]) for n in model.langs]
    assert letters[0] == sum(c.isalpha() for c in text)


def test_automaton_knows_exactly_the_substrings():
    text = [1, 2, 1, 2, 2, 1, 1, 2]
    moves = langid.automaton(np.array(text))
    reached, todo = set(), [((), 0)]
    while todo:
        word, state = todo.pop()
        reached.add(word)
        todo += [((*word, s), to) for s, to in moves[state].items()]
    assert reached == {tuple(text[i:j]) for i in range(9) for j in range(i, 9)}


def test_odd_texts(odd, none):
    model = langid.compile_model(SAMPLES)
    out = langid.identify(odd, model)
    assert out.columns == [*odd.columns, "lang_pred", "score", "bits", "letters", "phrases"]
    rows = out.collect()
    assert len(rows) == odd.count()
    for r in rows:
        lettered = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") != lettered
        assert 0 <= r["score"] <= 1 and (lettered or r["score"] == 0)
    assert langid.identify(none, model).collect() == []


def test_ties_and_models_of_one_or_no_language():
    one, empty = langid.compile_model({"aa": "abc"}), langid.compile_model({})
    assert langid.predict(one, ["abc"])[["lang_pred", "score"]].values.tolist() == [["aa", 1.0]]
    assert langid.predict(empty, ["abc", None])["lang_pred"].tolist() == ["und", "und"]
    twins = langid.compile_model({"bb": "same", "aa": "same"})
    assert langid.predict(twins, ["same"])[["lang_pred", "score"]].values.tolist() == [["aa", 0.0]]


def test_chunks_do_not_lose_a_long_text(monkeypatch):
    model = langid.compile_model(SAMPLES)
    text = "abracadabra " * 300
    whole = langid.predict(model, [text])
    monkeypatch.setattr(langid, "CHUNK", 1200)
    cut = langid.predict(model, ["bob", text])
    assert cut["lang_pred"].tolist() == ["bb", "aa"] and cut["letters"][1] == whole["letters"][0] == 3300


def test_held_out_accuracy(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    model = langid.train(docs.filter(~langid.held_out()))
    held = langid.identify(docs.filter(langid.held_out() & F.col("lang").isNotNull()), model)
    right, n = held.agg(F.count_if(F.col("lang") == F.col("lang_pred")), F.count("*")).first()
    assert n > 200 and right / n > 0.98


def test_only_texts_without_a_language_go(docs_of):
    rows = [(i, t, n, "s") for i, (n, t) in enumerate(list(SAMPLES.items()) * 6)]
    rows += [(100, "12 34 --", "aa", "s"), (101, None, "aa", "s"), (102, "ωψχωψχωψχωψχωψχωψχωψχ", None, "s"), (103, "a", None, "s")]
    kept = langid.recognised(docs_of(rows))
    assert kept.columns == docs_of([]).columns
    assert {r["doc_id"] for r in kept.collect()} == {*range(18), 103}
    assert all(r["lang"] for r in kept.collect())


def test_texts_are_parsed_once(docs_of):
    rows = [(i, t, n, "s") for i, (n, t) in enumerate(list(SAMPLES.items()) * 6)]
    plan = langid.recognised(docs_of(rows))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_junk_goes_and_missing_languages_are_filled_in(docs_of):
    rows = [(i, t, n, "s") for i, (n, t) in enumerate(list(SAMPLES.items()) * 6)]
    text = SAMPLES["aa"]
    rows += [(50, text, None, "s"), (51, text, None, "s"), (52, "".join(a + "ψ" for a in text if a.isalpha()), None, "s"), (53, text[:8], None, "s")]
    kept = {r["doc_id"]: r["lang"] for r in langid.recognised(docs_of(rows)).collect()}
    assert kept == {i: n for i, _, n, _ in rows[:18]} | {50: "aa", 51: "aa", 53: "aa"}
