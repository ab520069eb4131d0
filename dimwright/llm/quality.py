"""Quality rules: a threshold table compiled into one Spark projection.

Measures are DataFrame expressions over a text's words (`[^\\x20\\x09-\\x0D]+`)
and lines; each rule bounds one measure per thousand of another, in whole
numbers, and all rules together become one column. Nothing is shuffled and no
user function runs. Repeated 5-word windows are found inside the row: window
texts are sorted with their places, equal neighbours are repeats, and a place
covers up to the next place of a repeat.

Edge cases: a null text has no words, as an empty one or white space; a blank
line is no line; malformed UTF-8 counts as replacement characters; null or
repeated doc_ids are rows of their own; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: fixed values
BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
MARKS = ".,;:!?"        # not part of a stop word
BULLETS = ("-", "*", "•")
STOP_WORDS = {
    "en": "the of and to a in is that for it was on with be as by this are at from",
    "de": "der die und in den von zu das sich mit auf des für ist nicht im dem ein eine als",
    "es": "de la que el en y los se del las por un no con su una es para al lo",
    "fr": "de la le et les des en un du une que pour est qui dans par pas au sur avec",
}
WINDOW = 5


@dataclass(frozen=True)
class Rule:
    """``least`` <= 1000 * part / whole <= ``most`` for texts of ``words`` words or more."""

    name: str
    part: str
    whole: str
    least: int | None = None
    most: int | None = None
    words: int = 0

    def holds(self) -> Column:
        part, whole = F.col(self.part) * 1000, F.col(self.whole)
        ok = F.lit(True)
        if self.least is not None:
            ok = ok & (part >= whole * self.least)
        if self.most is not None:
            ok = ok & (part <= whole * self.most)
        return ok if not self.words else (F.col("n_words") < self.words) | ok


#: what every text must pass; `base_failed` if not
BASE = (
    Rule("words", "n_words", "one", least=10_000),
    Rule("repeated words", "n_repeat_words", "n_words", most=200),
)
#: the method's own thresholds
RULES = (
    Rule("long texts", "n_words", "one", most=100_000_000),
    Rule("word length", "word_chars", "n_words", least=2_000, most=14_000),
    Rule("symbols", "n_symbols", "n_words", most=600),
    Rule("stop words", "n_stop_words", "n_words", least=10, words=50),
    Rule("repeated lines", "n_dup_lines", "n_lines", most=300),
    Rule("bullet lines", "n_bullet_lines", "n_lines", most=900),
    Rule("unfinished lines", "n_cut_lines", "n_lines", most=300),
)


def measures(docs: DataFrame, keep: Sequence[str] = ("doc_id",), text: str = "text",
             stop_words: Sequence[str] = tuple(sorted({w for s in STOP_WORDS.values() for w in s.split()}))) -> DataFrame:
    """``keep`` columns and the measures of every text, as longs."""
    n = len(BLANKS)
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    # each select is one step: what a lambda reads more than once has to be a column by then
    d = docs.select(*keep, F.translate(t, BLANKS, " " * n).alias("_flat"),
                    F.filter(F.split(t, "\n"), lambda x: F.translate(x, BLANKS, "") != "").alias("_lines"))
    d = d.select(*keep, "_flat", "_lines", F.array_remove(F.split("_flat", " "), "").alias("_words"))
    d = d.select("*", F.when(F.size("_words") >= WINDOW, F.transform(
        F.sequence(F.lit(0), F.size("_words") - WINDOW),
        lambda i: F.concat_ws(" ", *(F.get("_words", i + j) for j in range(WINDOW))))).alias("_windows"))
    twice = F.size(F.array_distinct("_windows")) < F.size("_windows")
    d = d.select("*", F.when(twice, F.sort_array(F.transform("_windows", lambda w, i: F.struct(w.alias("w"), i.alias("i"))))).alias("_sorted"))
    same = F.filter("_sorted", lambda x, k: F.coalesce(x["w"] == F.get("_sorted", k - 1)["w"], F.lit(False))
                    | F.coalesce(x["w"] == F.get("_sorted", k + 1)["w"], F.lit(False)))
    d = d.select("*", F.sort_array(F.transform(same, lambda x: x["i"])).alias("_places"))
    covered = F.aggregate(F.transform("_places", lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get("_places", k + 1) - p, F.lit(WINDOW)))),
                          F.lit(0), lambda a, x: a + x)
    lines = F.col("_lines")
    out = {
        "n_words": F.size("_words"),
        "word_chars": F.length(F.translate("_flat", " ", "")),
        "n_symbols": F.length("_flat") - F.length(F.translate("_flat", SYMBOLS, "")),
        "n_lines": F.size(lines),
        "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
        "n_repeat_words": F.coalesce(covered, F.lit(0)),
        "n_stop_words": F.size(F.filter("_words", lambda w: F.rtrim(F.lower(w), F.lit(MARKS)).isin(*stop_words))),
        "n_bullet_lines": F.size(F.filter(lines, lambda x: F.substring(F.ltrim(x), 1, 1).isin(*BULLETS))),
        "n_cut_lines": F.size(F.filter(lines, lambda x: F.rtrim(x).endswith("..."))),
    }
    return d.select(*keep, *(c.cast("long").alias(k) for k, c in out.items()))


def failed(rules: Sequence[Rule]) -> Column:
    """Names of the rules that a row of measures breaks."""
    return F.array_compact(F.array(*(F.when(~r.holds(), F.lit(r.name)) for r in rules)))


def quality_rules(docs: DataFrame, rules: Sequence[Rule] = RULES, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``keep``, the measures, base_failed, failed_rules (names) and kept per row of docs(doc_id, text)."""
    d = measures(docs, keep).withColumn("one", F.lit(1).cast("long"))
    d = d.select("*", (F.size(failed(BASE)) > 0).alias("base_failed"), failed(rules).alias("failed_rules")).drop("one")
    return d.withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))
