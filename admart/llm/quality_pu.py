"""Quality classifier by positive-unlabelled learning.

Trusted positives and unlabelled web text are enough: with the share ``prior`` of good text, the risk of calling bad
text good is that of the unlabelled text less the positives' part in it. Training minimises

    prior * E_pos[loss(f)] + max(0, E_all[loss(-f)] - prior * E_pos[loss(-f)]),

f linear and loss logistic. With this loss both arms of the maximum are convex, so Newton steps find the minimum of
each mixture of them, and one mixture has the minimum of the maximum. The prior is estimated from the data: a classifier of positives against unlabelled text gives scores, and
the least ratio of the unlabelled share to the positive share above a score, over all scores, bounds it.

A text becomes one small byte per ratio (which of fixed cuts it exceeds). Equal byte strings are counted, and every
step reads these counts alone: fitting covers all documents that may be learned from, with no sample.
"""

from __future__ import annotations

import math
import unicodedata
from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import gather, kept, materialize, release
from .langid import held_out

SHARES = (0.002, 0.005, 0.01, 0.02, 0.05, 0.1, 0.2, 0.4, 0.7)
MOST = (0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9)
#: Ratios of a text and the cuts that make bytes of them.
RATIOS = {
    "upper case of letters": SHARES, "digits of characters": SHARES, "symbols of characters": SHARES, "bars a word": SHARES,
    "calls and questions a word": SHARES, "other punctuation a word": SHARES, "marks and controls of characters": SHARES,
    "words equal to the one before": SHARES, "words seen before": MOST, "lines seen before": MOST,
    "characters a word": (1.5, 2.5, 3.5, 4.5, 5.5, 7.0, 9.0, 12.0, 20.0), "words": (0.5, 1.5, 4.5, 9.5, 19.5, 49.5, 199.5, 999.5, 4999.5),
}
CUTS = 9
WIDTH = len(RATIOS) * CUTS + 1
LOWER, UPPER, DIGIT, SYMBOL, BAR, CALL, POINT, MARK, GAP = range(9)
SLICE = 1 << 20
RIDGE = 1e-3
STEPS = 40
#: How near to zero the clamped part of the risk is brought.
TOUCH = 1e-4
BINS = 2000


def classes() -> np.ndarray:
    """The class of every code point."""
    by_first = {"Z": GAP, "N": DIGIT, "S": SYMBOL, "P": POINT, "M": MARK, "C": MARK}
    by_kind = {"Lu": UPPER, "Lt": UPPER}
    table = np.empty(0x110000, dtype=np.uint8)
    for code in range(0x110000):
        kind = unicodedata.category(chr(code))
        table[code] = by_kind.get(kind, by_first.get(kind[0], LOWER))
    for chars, cls in ((" \t\n\x0b\x0c\r", GAP), ("|", BAR), ("!?¡¿", CALL), ("#$%&*@+<=>\\^_`{}~", SYMBOL)):
        table[[ord(c) for c in chars]] = cls
    return table


def ratios(text: str, table: np.ndarray) -> list[float]:
    """The RATIOS of a whole text."""
    seen = np.zeros(9, dtype=np.int64)
    for lo in range(0, len(text), SLICE):
        codes = np.frombuffer(text[lo:lo + SLICE].encode("utf-32-le", "surrogatepass"), dtype="<u4")
        seen += np.bincount(table[codes], minlength=9)
    words = text.split()
    lines = [x for x in text.split("\n") if x and not x.isspace()]
    n, shown = max(len(words), 1), max(int(seen.sum() - seen[GAP]), 1)
    return [
        seen[UPPER] / max(seen[UPPER] + seen[LOWER], 1), seen[DIGIT] / shown, seen[SYMBOL] / shown, seen[BAR] / n, seen[CALL] / n,
        seen[POINT] / n, seen[MARK] / shown, sum(map(eq, words, words[1:])) / n, 1 - len(set(words)) / n if words else 0.0,
        1 - len(set(lines)) / len(lines) if lines else 0.0, shown / n if words else 0.0, float(len(words))]


def levels(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id and a byte per ratio: how many of its cuts it exceeds. Null texts are read as empty."""
    cuts = np.array(list(RATIOS.values()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = kept(("character classes",), classes)
        for batch in batches:
            found = np.array([ratios(t.as_py() or "", table) for t in batch.column(1)]).reshape(-1, len(RATIOS))
            bytes_ = (found[:, :, None] > cuts[None]).sum(axis=2).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([row.tobytes() for row in bytes_], pa.binary())], names=["doc_id", "levels"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, "doc_id long, levels binary")


def design(column: pa.Array) -> np.ndarray:
    """The 0/1 rows that the model reads: for each ratio which cuts it exceeds, and a constant."""
    found = np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(-1, len(RATIOS))
    over = (found[:, :, None] > np.arange(CUTS)).reshape(len(found), -1)
    return np.hstack([over, np.ones((len(found), 1), dtype=bool)]).astype(float)


def softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0.0, z)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(0.5 * z))


def sums_of(counts: DataFrame, w: np.ndarray):
    """What a step needs, added up over all counted rows (levels, n, n_pos): for the unlabelled text the losses of
    calling it good, their slope and curvature; for the positives both losses, slopes and the curvature."""
    def fold(batches):
        total = None
        for batch in batches:
            x = design(batch.column(0))
            n, pos = (batch.column(i).to_numpy(zero_copy_only=False).astype(float) for i in (1, 2))
            z = x @ w
            p = sigmoid(z)
            bend = p * (1 - p)
            found = [n.sum(), pos.sum(), n @ softplus(z), pos @ softplus(-z), pos @ softplus(z), x.T @ (n * p), x.T @ (pos * p),
                     x.T @ pos, (x.T * (n * bend)) @ x, (x.T * (pos * bend)) @ x]
            total = found if total is None else [a + b for a, b in zip(total, found)]
        return total

    return gather(counts, fold, lambda parts: [sum(x) for x in zip(*parts)])


def risk(s: list, w: np.ndarray, prior: float, share: float = 1.0):
    """``prior`` * E_pos[loss(f)] + ``share`` * bad with slope and curvature, and bad itself, the estimated risk of calling
    bad text good: E_all[loss(-f)] - ``prior`` * E_pos[loss(-f)]."""
    n, pos = s[0], s[1]
    bad = s[2] / n - prior * s[4] / pos
    ridge = np.full(len(w), RIDGE)
    ridge[-1] = 1e-9
    value = prior * s[3] / pos + share * bad + 0.5 * (ridge * w) @ w
    slope = prior * (s[6] - s[7]) / pos + share * (s[5] / n - prior * s[6] / pos) + ridge * w
    bend = (1 - share) * prior * s[9] / pos + share * s[8] / n + np.diag(ridge)
    return value, slope, bend, bad


def least(counts: DataFrame, w: np.ndarray, prior: float, share: float) -> tuple[np.ndarray, float]:
    """Weights of least risk() and their bad, by Newton steps that are cut until the risk falls."""
    value, slope, bend, bad = risk(sums_of(counts, w), w, prior, share)
    for _ in range(STEPS):
        step, size = np.linalg.solve(bend + 1e-9 * np.eye(WIDTH), slope), 1.0
        if slope @ step < 1e-9:
            break
        while size > 1e-3:
            made = risk(sums_of(counts, w - size * step), w - size * step, prior, share)
            if made[0] < value:
                break
            size /= 4
        else:
            break
        w, (value, slope, bend, bad) = w - size * step, made
    return w, bad


def fit(counts: DataFrame, prior: float) -> np.ndarray:
    """Weights of least non-negative risk.

    Where the estimate of bad is not negative at the plain minimum, that is it. Else the clamp holds, and the
    minimum lies where bad is zero: there the two arms weigh in with a share of bad between 0 and 1, found by halving.
    """
    w, bad = least(counts, np.zeros(WIDTH), prior, 1.0)
    low, high = 0.0, 1.0
    if bad >= -TOUCH:
        return w
    while high - low > 1e-5 and abs(bad) > TOUCH:
        share = (low + high) / 2
        w, bad = least(counts, w, prior, share)
        low, high = (low, share) if bad < 0 else (share, high)
    return w


def estimate_prior(counts: DataFrame, w: np.ndarray) -> float:
    """Share of positives in the unlabelled text: the least ratio of shares above a score, with an allowance for
    chance (a Hoeffding bound at 0.1) that keeps thin ends of the scores from deciding."""
    def fold(batches):
        total = np.zeros((2, BINS))
        for batch in batches:
            at = np.minimum((sigmoid(design(batch.column(0)) @ w) * BINS).astype(int), BINS - 1)
            for k in (0, 1):
                total[k] += np.bincount(at, weights=batch.column(k + 1).to_numpy(zero_copy_only=False).astype(float), minlength=BINS)
        return total

    every, pos = gather(counts, fold, lambda parts: sum(parts))
    n, m = every.sum(), pos.sum()
    above, above_pos = np.cumsum(every[::-1]) / n, np.cumsum(pos[::-1]) / m
    chance = math.sqrt(math.log(4 / 0.1) / 2 / n) + math.sqrt(math.log(4 / 0.1) / 2 / m)
    held = above_pos > 0
    best = np.argmin((above[held] + chance) / above_pos[held])
    return float(min(1.0, max(above[held][best] / above_pos[held][best], m / n if m < n else 1e-3, 1e-3)))


def trusted(labels: DataFrame, id_col: str, label_col: str) -> DataFrame:
    """The documents whose labels are all 1, each once."""
    named = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("trusted_id"))
    return named.agg(F.min(F.coalesce(F.col(label_col) == 1, F.lit(False))).alias("good")).where("good").select("trusted_id")


def score_quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text",
                  label_col: str = "quality") -> DataFrame:
    """Per row: doc_id, held_out, score (0 to 1, the chance of label 1) and predicted (score >= threshold).

    Of the labels only the positive ones of documents that are not held out are read; a document whose labels
    disagree is unlabelled. All documents that are not held out and have a doc_id, labelled or not, are the unlabelled text.
    Null, empty and blank texts get the score of a text without words; repeated rows are each counted and scored.
    Without a trusted positive nothing can be learned and every score is 0.5. Extra columns are not looked at.
    """
    rows = materialize(levels(docs, id_col, text_col), "levels")
    may_learn = rows.where(F.col("doc_id").isNotNull() & ~held_out())
    known = may_learn.join(trusted(labels, id_col, label_col), F.col("doc_id") == F.col("trusted_id"), "left")
    counts = materialize(known.groupBy("levels").agg(F.count(F.lit(1)).alias("n"), F.count("trusted_id").alias("n_pos")), "counts")
    w, learned = np.zeros(WIDTH), counts.agg(F.sum("n_pos")).first()[0]
    if learned:
        # At a prior of one half the same risk parts positives from unlabelled text.
        w = fit(counts, estimate_prior(counts, fit(counts, 0.5)))
    release(counts)
    shared = docs.sparkSession.sparkContext.broadcast(w)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = sigmoid(design(batch.column(1)) @ shared.value)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score)], names=["doc_id", "score"])

    scored = rows.mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
