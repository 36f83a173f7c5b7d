"""Substring dedup by relative Lempel-Ziv parsing against distributed reference blocks.

A word is removed if a window of ``window`` (13) consecutive words that covers it also starts in a document
with a smaller doc_id. The reference is the corpus itself. Parsing every document against every block of it
would be quadratic, so blocks are dealt by content, and a document meets every block that can hold a factor
of its own:

1. Each window names the least of its 4-word grams (by length, then hash) as its anchor. Equal windows have
   equal anchors, so a window whose anchor comes in one document only is a literal; no factor can hold it.
2. The windows around one occurrence of a shared anchor make a run of up to 22 words. Equal runs are
   aggregated to their first document. What remains is sorted into the reference blocks: one per anchor, its
   runs in the order of their documents, indexed by phrase (window).
3. Every run is factored greedily against its block: at a place whose phrase is indexed with an earlier
   document the factor is extended word by word for as long as the reference goes on alike; the phrases that
   cross the factor's end are then looked up one by one, and phrases that are new are added to the index.
   Texts are compared, not hashes.
4. A document's factors, run by run, are the spans to remove. Documents of equal words are settled before: all
   but the first are one factor.

Hot anchors and passages are aggregated before they meet: a task holds the *different* runs of one anchor. Where
these are too many still (a line that a third of all documents hold, each with its own neighbours), the block is
not built in a task; its phrases are looked up one by one, by aggregates and joins, with the same result.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean, materialize, release, shuffle_partitions

GRAM = 4
#: A block of more runs than this, and than a SHARE-th of all runs, is factored phrase by phrase instead.
BLOCK_RUNS, SHARE = 2000, 10_000
#: Stands for a null doc_id, which counts as the greatest.
LAST = (1 << 63) - 1
_M1, _M2, _B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def word_hashes(found: list[bytes]) -> np.ndarray:
    from xxhash import xxh64_intdigest

    return np.fromiter(map(xxh64_intdigest, found), dtype=np.uint64, count=len(found))


def grams(found: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hash, rank) of each 4-word gram; longer grams, which are rarer, rank lower."""
    h = word_hashes(found)
    size = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
    n = len(found) - GRAM + 1
    g, length = np.zeros(n, dtype=np.uint64), np.zeros(n, dtype=np.int64)
    for j in range(GRAM):
        g = g * _B + h[j:j + n]
        length += size[j:j + n]
    g = (g ^ (g >> np.uint64(30))) * _M1
    g = (g ^ (g >> np.uint64(27))) * _M2
    g ^= g >> np.uint64(31)
    short = np.maximum(0, 7 - length // 6).astype(np.uint64)
    return g, (short << np.uint64(61)) | (g >> np.uint64(3))


def anchors(found: list[bytes], window: int) -> tuple[np.ndarray, np.ndarray]:
    """(place of each window's anchor, hashes of all grams); windows start at 0, 1, ..."""
    g, rank = grams(found)
    n = len(found) - window + 1
    place, least = np.zeros(n, dtype=np.int64), rank[:n].copy()
    for j in range(1, window - GRAM + 1):
        here = rank[j:j + n]
        lower = here < least
        least[lower] = here[lower]
        place[lower] = j
    return place + np.arange(n), g


def runs_of(found: list[bytes], shared: np.ndarray, window: int) -> Iterator[tuple[int, int, int, str]]:
    """(first window, windows, anchor, words) of each run of windows with one shared anchor occurrence."""
    place, g = anchors(found, window)
    first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    ends = np.append(first[1:], len(place))
    wanted = np.isin(g[place[first]], shared)
    for s, e, a in zip(first[wanted].tolist(), ends[wanted].tolist(), g[place[first[wanted]]].view(np.int64).tolist()):
        yield s, e - s, a, b" ".join(found[s:e + window - 1]).decode()


class Block:
    """A reference block: phrases of earlier runs, and where they stand."""

    def __init__(self, window: int):
        self.window = window
        self.index: dict[bytes, tuple[int, list[bytes], int]] = {}

    def parse(self, doc: int, run: bytes) -> int:
        """Factor a run of ``doc`` (documents come in ascending order); bit i of the result is set if phrase i
        is new, that is in no factor."""
        found, window, index = run.split(b" "), self.window, self.index
        last, i, new = len(found) - window, 0, 0
        while i <= last:
            phrase = b" ".join(found[i:i + window])
            hit = index.get(phrase)
            if hit is None:
                index[phrase] = (doc, found, i)
            if hit is None or hit[0] >= doc:
                new |= 1 << i
                i += 1
                continue
            _, ref, at = hit
            size = window
            while i + size < len(found) and at + size < len(ref) and found[i + size] == ref[at + size]:
                size += 1
            i += size - window + 1  # the first phrase that crosses the factor's end
        return new


def hot_anchors(runs: DataFrame) -> DataFrame:
    """Anchors of more than BLOCK_RUNS runs and more than a SHARE-th of all runs: below SHARE of them."""
    most = max(BLOCK_RUNS, runs.count() // SHARE)
    return runs.groupBy("anchor").count().where(F.col("count") > most).select("anchor")


def factor_phrases(runs: DataFrame, window: int) -> DataFrame:
    """What factor_blocks() finds, for blocks too large for a task: each phrase is looked up by itself.

    The first document of each phrase is an aggregate; a run's phrase is new if the run's document is that
    one. The join has the document among its keys, so a phrase in a third of all documents is no hot key.
    """
    distinct = runs.groupBy("anchor", "run").agg(F.min("d").alias("first"))
    found = F.split("run", " ")
    phrases = distinct.select("anchor", F.xxhash64("run").alias("run_hash"), "first", found.alias("w")).select(
        "anchor", "run_hash", "first",
        F.explode(F.transform(F.sequence(F.lit(0), F.size("w") - window), lambda i: F.struct(
            i.alias("i"), F.array_join(F.slice("w", i + 1, window), " ").alias("phrase")))).alias("p"),
    ).select("anchor", "run_hash", "first", "p.i", "p.phrase")
    firsts = phrases.groupBy("anchor", "phrase").agg(F.min("first").alias("first"))
    new = phrases.join(firsts, ["anchor", "phrase", "first"])
    return new.groupBy("anchor", "run_hash", "first").agg(F.expr("bit_or(shiftleft(1L, i))").alias("new"))


def factor_blocks(runs: DataFrame, window: int) -> DataFrame:
    """(anchor, run_hash, first, new): of each different run, its first document and its new phrases."""
    spark = runs.sparkSession
    distinct = runs.groupBy("anchor", "run").agg(F.min("d").alias("first"))
    dealt = (distinct.repartition(shuffle_partitions(spark), "anchor").sortWithinPartitions("anchor", "first", "run")
             .select("anchor", "first", F.xxhash64("run").alias("run_hash"), F.col("run").cast("binary").alias("run")))

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, now = None, None
        for batch in batches:
            anchor, first, run = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3).to_pylist()
            new = []
            for a, d, text in zip(anchor, first, run):
                if block is None or a != now:
                    block, now = Block(window), a
                new.append(block.parse(d, text))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), batch.column(1), pa.array(new, type=pa.int64())],
                                             names=["anchor", "run_hash", "first", "new"])

    return dealt.mapInArrow(lean(parse), "anchor long, run_hash long, first long, new long")


def duplicate_spans(docs: DataFrame, window: int = 13, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (),
                    unchanged: bool = False) -> DataFrame:
    """Per row: doc_id, the columns of ``keep``, n_words, n_removed, spans array<struct<start, length>> (removed
    words, from 0), kept (the other words, joined by one space; with ``unchanged`` the text as it is, null too,
    where no word is removed).

    Null and empty texts have no words. A null doc_id counts as the greatest; rows of one doc_id don't remove
    each other's words, repeated rows get the same result. Texts below ``window`` words lose nothing.
    """
    if not GRAM < window <= 60:
        raise ValueError("window must be 5 to 60 words")
    text = F.col(text_col).cast("string")
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("d"), F.xxhash64(text).alias("tag"),
                       F.col(id_col).cast("long").alias("doc_id"), *keep, text.alias("_body"))

    def survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 1000):
                some = batch.slice(low, 1000)
                n, digest, found_in = [], [], []
                for body in some.column(2):
                    found = body.as_py().encode().split() if body.is_valid else []
                    n.append(len(found))
                    digest.append(blake2b(b" ".join(found), digest_size=16).digest())
                    if len(found) >= window:
                        place, g = anchors(found, window)
                        found_in.append(np.unique(g[place]).view(np.int64))
                    else:
                        found_in.append(np.zeros(0, dtype=np.int64))
                ends = np.cumsum([0, *map(len, found_in)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), some.column(1), pa.array(n, type=pa.int64()), pa.array(digest, type=pa.binary()),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(found_in)))],
                    names=["d", "tag", "n_words", "digest", "anchors"])

    base = materialize(rows.select("d", "tag", "_body").mapInArrow(lean(survey), "d long, tag long, n_words long, digest binary, anchors array<long>"), "anchors")

    # Documents of equal words: all but the first are settled, and the first stands for them. What a join
    # hands back to all rows of a key is a table of its own, so that Spark can split a hot key's partition.
    firsts = materialize(base.groupBy("digest").agg(F.min("d").alias("first")), "firsts")
    placed = materialize(base.select("d", "tag", "n_words", "digest").join(firsts, "digest").select("d", "tag", "n_words", "first"), "copies")
    copies = placed.where((F.col("d") > F.col("first")) & (F.col("n_words") >= window)).select("d", "tag").distinct()
    leading = placed.where(F.col("d") == F.col("first")).select("d", "tag").distinct()

    # Texts stand by (d, tag): a list holds what one text has, however many rows share its doc_id or repeat it.
    exploded = base.select("d", "tag", F.explode("anchors").alias("anchor"))
    shared = materialize(exploded.groupBy("anchor").count().where("count > 1").select("anchor"), "shared-anchors")
    wanted = exploded.join(shared, "anchor", "left_semi").groupBy("d", "tag").agg(F.collect_set("anchor").alias("anchors"))
    wanted = wanted.join(leading, ["d", "tag"], "left_semi")
    wanted = materialize(wanted, "shared")

    def cut_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 200):
                some = batch.slice(low, 200)
                owner, numbers, texts = array("q"), array("q"), []  # row; start, phrases, anchor; run
                for row, (body, shared_) in enumerate(zip(some.column(2), some.column(3))):
                    found = body.as_py().encode().split() if body.is_valid else []
                    if len(found) >= window:
                        known = shared_.values.to_numpy(zero_copy_only=False).view(np.uint64)
                        for start, phrases, anchor, run in runs_of(found, known, window):
                            owner.append(row)
                            numbers.extend((start, phrases, anchor))
                            texts.append(run)
                if texts:
                    of, cut = pa.array(np.frombuffer(owner, dtype=np.int64)), np.frombuffer(numbers, dtype=np.int64).reshape(-1, 3)
                    yield pa.RecordBatch.from_arrays(
                        [some.column(0).take(of), some.column(1).take(of), pa.array(cut[:, 0].astype(np.int32)), pa.array(cut[:, 1].astype(np.int32)),
                         pa.array(np.ascontiguousarray(cut[:, 2])), pa.array(texts, type=pa.string())],
                        names=["d", "tag", "start", "phrases", "anchor", "run"])

    runs = materialize(rows.select("d", "tag", "_body").join(wanted, ["d", "tag"]).select("d", "tag", "_body", "anchors")
                       .mapInArrow(lean(cut_runs), "d long, tag long, start int, phrases int, anchor long, run string"), "runs")
    hot = F.broadcast(hot_anchors(runs))  # at most SHARE rows
    parsed = materialize(factor_blocks(runs.join(hot, "anchor", "left_anti"), window)
                         .unionByName(factor_phrases(runs.join(hot, "anchor", "left_semi"), window)), "parsed")
    # A run of a document that isn't its first one is a factor as a whole; else its new phrases stay.
    judged = (runs.select("d", "tag", "start", "phrases", "anchor", F.xxhash64("run").alias("run_hash"))
              .join(parsed.withColumnRenamed("first", "d"), ["anchor", "run_hash", "d"], "left")
              .select("d", "tag", "start", "phrases", F.coalesce("new", F.lit(0).cast("long")).alias("new"))
              .where(F.col("new") != F.expr("shiftleft(1L, phrases) - 1")))
    whole = copies.select("d", "tag", F.lit(-1).alias("start"), F.lit(0).alias("phrases"), F.lit(0).cast("long").alias("new"))
    cuts = judged.unionByName(whole).groupBy("d", "tag").agg(F.collect_set(F.struct("start", "phrases", "new")).alias("cuts"))
    cuts = materialize(cuts, "factors").withColumnsRenamed({"d": "cut_d", "tag": "cut_tag"})
    release(base, firsts, placed, shared, wanted, runs, parsed)

    out_fields = [f for f in rows.schema.fields if f.name not in ("d", "tag", "_body")]
    span = pa.struct([("start", pa.int32()), ("length", pa.int32())])

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 1000):
                some = batch.slice(low, 1000)
                carried = some.num_columns - 2
                n, gone, spans, kept = [], [], [], []
                for body, cut in zip(some.column(carried), some.column(carried + 1).to_pylist()):
                    found = body.as_py().encode().split() if body.is_valid else []
                    n.append(len(found))
                    if not cut:
                        gone.append(0)
                        spans.append([])
                        kept.append(body.as_py() if unchanged else b" ".join(found).decode())
                        continue
                    covered = np.zeros(len(found) + 1, dtype=np.int32)  # starts less ends of removed windows
                    for c in cut:
                        if c["start"] < 0:
                            covered[0] += 1
                            covered[len(found)] -= 1
                            continue
                        for i in range(c["phrases"]):
                            if not c["new"] >> i & 1:
                                covered[c["start"] + i] += 1
                                covered[c["start"] + i + window] -= 1
                    away = np.cumsum(covered[:-1]) > 0
                    edge = np.flatnonzero(np.diff(np.concatenate([[0], away.view(np.int8), [0]])))
                    spans.append([{"start": int(a), "length": int(b - a)} for a, b in zip(edge[::2], edge[1::2])])
                    gone.append(int(away.sum()))
                    kept.append(b" ".join([w for w, x in zip(found, away.tolist()) if not x]).decode())
                yield pa.RecordBatch.from_arrays(
                    [*(some.column(i) for i in range(carried)), pa.array(n, type=pa.int64()), pa.array(gone, type=pa.int64()),
                     pa.array(spans, type=pa.list_(span)), pa.array(kept, type=pa.string())],
                    names=[*some.schema.names[:carried], "n_words", "n_removed", "spans", "kept"])

    joined = rows.join(cuts, (F.col("d") == F.col("cut_d")) & (F.col("tag") == F.col("cut_tag")), "left")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in out_fields)
    return joined.select(*[f.name for f in out_fields], "_body", "cuts").mapInArrow(
        lean(remove), schema + ", n_words long, n_removed long, spans array<struct<start: int, length: int>>, kept string")
