"""Quality rules: a threshold table compiled into one projection of built-in functions.

``RULES`` says which ratio must lie where, and from how many words on it is asked. Everything about a text
comes from array functions over its own words and lines, so a document is one row from scan to verdict: no
join, no shuffle, no user function.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import GAP_JVM

#: Function words of the four languages; plain parameter of the stop-word ratio.
STOP_WORDS = (
    "the of and to in is it that for with as was on be by at this are from or an "
    "der die das und den von zu mit ist des im für auf nicht eine ein sich dem "
    "la le les de et un une du en que qui dans pour par sur au est il elle "
    "el los las y del se por con para su no es lo como"
).split()


@dataclass(frozen=True)
class Rule:
    """``low`` <= ``part`` / ``whole`` <= ``high``, for texts of ``words`` words or more."""

    part: str
    whole: str
    low: float | None = None
    high: float | None = None
    words: int = 0

    def holds(self) -> Column:
        ratio = F.col(self.part) / F.greatest(F.col(self.whole), F.lit(1))
        bounds = F.lit(True)
        if self.low is not None:
            bounds = bounds & (ratio >= self.low)
        if self.high is not None:
            bounds = bounds & (ratio <= self.high)
        return (F.col("n_words") < self.words) | bounds


RULES = (
    Rule("word_chars", "n_words", low=2.0, high=14.0),  # mean word length
    Rule("n_symbols", "n_words", high=0.1),
    Rule("n_stop_words", "n_words", low=0.03, words=60),
    Rule("n_dup_lines", "n_lines", high=0.4),
)

WINDOW = 5


def _repeat_words() -> tuple[Column, Column]:
    """(grams with their places, sorted; places of the windows that come twice or more).

    Windows are told apart by 64-bit hashes within one text. Sorted with their places, equal hashes are
    neighbours. A repeated window covers its five words but for those the next repeated one covers.
    """
    pairs = F.sort_array(F.transform("grams", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    places = F.sort_array(F.transform(
        F.filter(F.transform("pairs", lambda x, j: F.struct(
            x["i"].alias("i"),
            (F.coalesce(F.get(F.col("pairs"), j + 1)["h"] == x["h"], F.lit(False))
             | F.coalesce(F.get(F.col("pairs"), j - 1)["h"] == x["h"], F.lit(False))).alias("again"))),
            lambda x: x["again"]),
        lambda x: x["i"]))
    return pairs, places


def quality_features(docs: DataFrame, stop_words: list[str] = STOP_WORDS, id_col: str = "doc_id",
                     text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """The counts the rules read, a row per row of ``docs``. Null texts have no words and no lines."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    gaps = " \t\n\x0b\x0c\r"
    has_word = lambda x: F.length(F.translate(x, gaps, "")) > 0
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), *keep, text.alias("body"))
    cut = base.select(
        "doc_id", *keep,
        F.filter(F.split("body", GAP_JVM), lambda w: w != "").alias("words"),
        F.filter(F.split("body", "\n"), has_word).alias("lines"),
        F.length(F.translate("body", gaps, "")).cast("long").alias("word_chars"),
        (F.length("body") - F.length(F.translate("body", "#*$%&|<>", ""))).cast("long").alias("n_symbols"))
    counted = cut.select(
        "doc_id", *keep, "word_chars", "n_symbols",
        F.size("words").cast("long").alias("n_words"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.filter("words", lambda w: F.lower(w).isin(stop_words))).cast("long").alias("n_stop_words"),
        F.when(F.size("words") >= WINDOW, F.transform(
            F.sequence(F.lit(1), F.size("words") - (WINDOW - 1)), lambda i: F.xxhash64(F.slice("words", i, WINDOW))
        )).otherwise(F.array().cast("array<long>")).alias("grams"))
    # Most texts repeat no window; only the others are sorted.
    pairs, places = _repeat_words()
    again = F.size("grams") > F.size(F.array_distinct("grams"))
    rest = ["doc_id", *keep, "word_chars", "n_symbols", "n_words", "n_lines", "n_dup_lines", "n_stop_words"]
    sorted_ = counted.select(*rest, F.when(again, pairs).alias("pairs"))
    placed = sorted_.select(*rest, F.when(F.col("pairs").isNotNull(), places).alias("places"))
    covered = F.aggregate(
        F.transform("places", lambda p, j: F.least(F.lit(WINDOW), F.coalesce(F.get(F.col("places"), j + 1) - p, F.lit(WINDOW)))),
        F.lit(0), lambda a, x: a + x)
    return placed.select(*rest, F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"))


def quality_verdicts(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text",
                     keep: tuple[str, ...] = ()) -> DataFrame:
    """quality_features() with base_failed and kept (never null).

    Null and empty texts fail the base rules (fewer than 10 words). Null doc_ids stay null, repeated rows are
    each judged. ``keep`` names columns to carry along; they must not clash with the counts.
    """
    # The row number is never negative. It only keeps the optimizer from pushing a filter on the verdict
    # below this projection, where it would write out every count again in terms of the text.
    barrier = F.monotonically_increasing_id() < 0
    base_failed = (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20) | barrier
    verdict = F.lit(True)
    for rule in rules:
        verdict = verdict & rule.holds()
    features = quality_features(docs, id_col=id_col, text_col=text_col, keep=keep)
    return features.withColumns({"base_failed": base_failed}).withColumn("kept", ~F.col("base_failed") & verdict)
