"""Operator 12 against plain Python, and its rules one by one."""

import re

import pytest
from llm.fixture import SCHEMA, documents

from dimwright.llm.quality import RULES, STOP_WORDS, Rule, quality_rules

STOP = {w for s in STOP_WORDS.values() for w in s.split()}


def brute(t):
    t = t or ""
    ws = re.findall(r"[^\x20\x09-\x0d]+", t)
    ls = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0d]", x)]
    win = [tuple(ws[i:i + 5]) for i in range(len(ws) - 4)]
    times = {}
    for w in win:
        times[w] = times.get(w, 0) + 1
    rep = {i + j for i, w in enumerate(win) if times[w] > 1 for j in range(5)}
    return (len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in t), len(ls), len(ls) - len(set(ls)), len(rep),
            sum(w.lower().rstrip(".,;:!?") in STOP for w in ws))


def made(spark, *texts):
    return spark.createDataFrame([(i, t, "en", "s", 1, "x", 1, None) for i, t in enumerate(texts)], SCHEMA)


def test_measures(spark):
    odd = ["a b c d e a b c d e", "a a a a a a", "x\n\nx\n \nx \nx", "\x0bA\x0cb\r\nThe the, of.", "1 2 3 4 5 6 1 2 3 4 5", "#tag *** <b>|</b> 50% $5 & é∑東", "a b c d"]
    docs = documents(spark).unionByName(made(spark, *odd))
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = quality_rules(docs)
    out = got.select("doc_id", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_stop_words", "base_failed").collect()
    want = []
    for d, t in rows:
        m = brute(t)
        want.append((d, *m, m[0] < 10 or 100 * m[5] > 20 * m[0]))
    assert sorted(map(tuple, out), key=repr) == sorted(want, key=repr)
    assert all(not (r.kept and r.base_failed) for r in got.collect())


PROSE = "It was on this day that the fox and a dog with tails are at the river of words from which clear water came by."


@pytest.mark.parametrize("text,rule", [
    (PROSE, None),
    (" ".join("x" * 20 + str(i) for i in range(30)), "word length"),
    (" ".join(f"$$ {w}" for w in PROSE.split()), "symbols"),
    (" ".join(f"word{i}" for i in range(80)), "stop words"),
    ("\n".join([PROSE, "the end", "the end", "the end"]), "repeated lines"),
    ("\n".join(f"- there {i} of that" for i in range(12)), "bullet lines"),
    ("\n".join(f"there {i} of that..." for i in range(12)), "unfinished lines"),
])
def test_rules(spark, text, rule):
    r = quality_rules(made(spark, text)).collect()[0]
    assert r.failed_rules == ([rule] if rule else []) and not r.base_failed and r.kept == (rule is None)


def test_table_of_rules_is_a_parameter(spark):
    docs = made(spark, PROSE, None, "")
    few = quality_rules(docs, [Rule("short", "n_words", "one", least=100_000)]).orderBy("doc_id").collect()
    assert [r.failed_rules for r in few] == [["short"]] * 3
    none = quality_rules(docs, []).orderBy("doc_id").collect()
    assert [(r.failed_rules, r.kept) for r in none] == [([], True), ([], False), ([], False)]
    assert quality_rules(spark.createDataFrame([], SCHEMA)).collect() == [] and len({r.name for r in RULES}) == len(RULES)


def test_plan_has_no_shuffle_and_no_python(spark):
    plan = quality_rules(documents(spark))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Exchange", "Python", "Arrow", "Window"))
