"""Language ID by cross-parsing entropy.

The most frequent words of each language's labelled text, one after the other, become a suffix automaton. A text is parsed against each language into
phrases, each the longest match that the automaton has from there on (or one unseen character); the language
that needs the fewest phrases for the length parsed wins. Every language gets labelled text of the same length.
Words are parsed one by one with their boundaries, so each distinct word is parsed once per Python worker
while it stays in the memo, and a text adds up its words.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator
from itertools import accumulate, chain

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Memo, kept


LETTERS = re.compile(r"[^\W\d_]+")
EDGE = "\n"
UNKNOWN = "und"
#: Bits of a language's phrase count in a text's packed counts.
SLOT = 40
MEMO_ENTRIES = 100_000
MEMO_CHARS = 64


def letter_words(text: str) -> list[str]:
    """Runs of letters (category L, as \\p{L} in train()); LETTERS also matches number signs such as ½, ² and Ⅷ."""
    found = LETTERS.findall(text)
    if found and not "".join(found).isalpha():
        found = [x for word in found for x in "".join(c if c.isalpha() else " " for c in word).split()]
    return found


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


class SuffixAutomaton:
    """Transitions of the suffix automaton of a text, in flat arrays: a state's characters stand in ``edges`` from
    ``first[state]`` to ``first[state + 1]``, the states they lead to in ``to``. A few bytes a transition."""

    def __init__(self, text: str):
        link, length = [-1], [0]
        trans: list[dict[str, int]] = [{}]
        last = 0
        for c in text:
            cur = len(link)
            link.append(0)
            length.append(length[last] + 1)
            trans.append({})
            p = last
            while p >= 0 and c not in trans[p]:
                trans[p][c] = cur
                p = link[p]
            if p >= 0:
                q = trans[p][c]
                if length[p] + 1 == length[q]:
                    link[cur] = q
                else:
                    copy = len(link)
                    link.append(link[q])
                    length.append(length[p] + 1)
                    trans.append(dict(trans[q]))
                    while p >= 0 and trans[p].get(c) == q:
                        trans[p][c] = copy
                        p = link[p]
                    link[q] = link[cur] = copy
            last = cur
        self.edges = "".join(map("".join, trans))
        self.first = array("i", accumulate(map(len, trans), initial=0))
        self.to = array("i", chain.from_iterable(row.values() for row in trans))

    def phrases(self, codes: list[int]) -> int:
        """The phrases of a greedy parse into longest matches."""
        return self.parse("".join(map(chr, codes)))

    def parse(self, text: str) -> int:
        """phrases() of a text."""
        find, first, to, state, found = self.edges.find, self.first, self.to, 0, 0
        for c in text:
            at = find(c, first[state], first[state + 1])
            if at < 0 or not state:  # a phrase starts here
                found += 1
                if state:
                    at = find(c, 0, first[1])
            state = to[at] if at >= 0 else 0
        return found


class Parser:
    """Predicts with the automata of all languages."""

    def __init__(self, model: dict[str, str], automata: list[SuffixAutomaton] | None = None):
        self.langs = sorted(model)
        self.automata = automata or [SuffixAutomaton(model[x]) for x in self.langs]
        self.size = [len(model[x]) for x in self.langs]
        self.memo = Memo(self._parse, MEMO_ENTRIES, MEMO_CHARS)

    def _parse(self, word: str) -> int:
        text = EDGE + word + EDGE
        return sum(a.parse(text) << SLOT * k for k, a in enumerate(self.automata))

    def predict(self, text: str | None) -> tuple[str, float]:
        found = letter_words(text.lower()) if text else []
        if not found or not self.langs:
            return UNKNOWN, 0.0
        packed = sum(map(self.memo.__getitem__, found))
        length = sum(map(len, found)) + 2 * len(found)
        cost = [(packed >> SLOT * k & (1 << SLOT) - 1) / length for k in range(len(self.langs))]
        order = sorted(range(len(cost)), key=lambda k: (cost[k], -self.size[k], self.langs[k]))
        if len(order) == 1:
            return self.langs[0], 1.0
        return self.langs[order[0]], 1.0 - cost[order[0]] / cost[order[1]]


def parser_for(key: str, shared) -> Parser:
    """This worker's parser of the broadcast model and its automata."""
    return kept(("language", key), lambda: Parser(*shared.value))


def train(docs: DataFrame, per_language: int = 200, chars: int = 60_000,
          id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> dict[str, str]:
    """The labelled text of each language, from a bounded sample.

    Of the rows that are not held out and have a doc_id, a text and a label, about ``per_language`` doc_ids of each
    label, chosen by a hash, give the words; of each language's, the most frequent ones make up ``chars`` characters
    (longer words are cut to that). Every label with a word is learned: all bounds are for each language by itself.
    """
    rows = docs.where(~held_out(id_col) & F.col(id_col).isNotNull() & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    rows = rows.select(F.col(id_col).alias("doc_id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    sizes = rows.groupBy("lang").agg(F.count_distinct("doc_id").alias("n"))
    chance = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("sample")), F.lit(1 << 20)) / float(1 << 20)
    sample = rows.join(F.broadcast(sizes), "lang").where(chance < F.lit(per_language) / F.col("n"))
    letters = F.regexp_extract_all(F.lower("text"), F.lit(r"(\p{L}+)"), F.lit(1))
    counts = sample.select("lang", F.explode(letters).alias("word")).groupBy("lang", F.left("word", F.lit(chars - 1)).alias("word")).count()
    # A word takes two characters at least, so more words than half of ``chars`` never fit.
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("count"), "word"))
    seen = counts.withColumn("place", place).where(F.col("place") <= max(1, chars // 2)).collect()
    model: dict[str, list[str]] = {}
    room: dict[str, int] = {}
    for r in sorted(seen, key=lambda r: (r["lang"], r["place"])):
        if room.setdefault(r["lang"], chars) > len(r["word"]):
            model.setdefault(r["lang"], []).append(r["word"])
            room[r["lang"]] -= len(r["word"]) + 1
    return {k: EDGE + EDGE.join(v) + EDGE for k, v in model.items()}


def identify(docs: DataFrame, model: dict[str, str], id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """Per row: doc_id, the columns of ``keep``, lang_pred, score (0 to 1: by how much the runner-up needs more).

    The whole text is parsed. Null texts and texts without a letter are ``und`` with score 0, as is all
    without a trained language. Ties go to the language with more labelled text, then to the label that sorts first. Repeated rows are each predicted.
    """
    # Built here once, a few bytes a transition; while an automaton grows it takes many times that.
    shared = docs.sparkSession.sparkContext.broadcast((model, [SuffixAutomaton(model[x]) for x in sorted(model)]))
    key = hashlib.sha256(repr(sorted(model.items())).encode()).hexdigest()
    given = text_col in keep  # then the text goes to Python once, as a column to carry along
    body = [] if given else [F.col(text_col).cast("string").alias("_body")]
    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), *keep, *body)
    place = picked.columns.index(text_col if given else "_body")
    fields = [f for f in picked.schema.fields if f.name != "_body"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", lang_pred string, score double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = parser_for(key, shared)
        for batch in batches:
            made = [parser.predict(t.as_py()) for t in batch.column(place)]
            n = len(fields)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:n], pa.array([m[0] for m in made], type=pa.string()), pa.array([m[1] for m in made], type=pa.float64())],
                names=[*batch.schema.names[:n], "lang_pred", "score"])

    return picked.mapInArrow(run, schema)
