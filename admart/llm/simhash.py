"""SimHash near-duplicates: 64-bit fingerprints, compared bit-sliced within buckets.

Fingerprints within ``radius`` (3) bits agree in at least three of six bit blocks, so every link shares one
of 20 keys of 31 to 33 bits: no link is lost, and there is no cap on a bucket. Only distinct fingerprints are
dealt out, so copies of a document are one row. In a task the fingerprints of a bucket are stored as 64
vertical bit planes; one word-wide operation compares 64 of them, differing bits are added with carry-save
counters, and a block is abandoned once all its counters exceed the radius. A bucket passes on at most
one edge fewer than it has fingerprints: those that join two of its parts.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean, materialize, shuffle_partitions
from .components import connected_components

SEED = 42  # of XXH64; fixed value
BLOCKS = 6
#: Buckets up to this size are compared side by side, larger ones query block by query block.
SIDE_BY_SIDE = 48
#: Queries compared at once against a large bucket.
QUERIES = 256
#: Shingles whose bits are counted at once.
CHUNK = 1 << 16


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """SimHash of the word shingles of a text, A-Z lower-cased; 0 for no words."""
    from xxhash import xxh64_intdigest

    found = text.encode().lower().split() if text else []  # bytes: A-Z only, and exactly the word gaps
    if not found:
        return 0
    joined = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), dtype=np.int64, count=len(found)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(found) - shingle + 1)
    ends = ends[shingle - 1:] if len(found) >= shingle else ends[-1:]
    hashes = np.array([xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts[:n].tolist(), ends.tolist())], dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for low in range(0, n, CHUNK):
        part = hashes[low:low + CHUNK]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, the columns of ``keep``, fp long: the fingerprint's bits as a signed long)."""
    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), *keep, F.col(text_col).cast("string").alias("_body"))
    fields = picked.schema.fields[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(len(fields))], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(made.view(np.int64))], names=[*batch.schema.names[:-1], "fp"])

    return picked.mapInArrow(lean(run), ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", fp long")


def planes(fps: np.ndarray) -> np.ndarray:
    """The 64 vertical bit planes of the fingerprints, 64 of them a word."""
    pad = -len(fps) % 64
    full = np.concatenate([fps, np.zeros(pad, dtype=np.uint64)]) if pad else fps
    bits = np.unpackbits(np.ascontiguousarray(full).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view("<u8")


def near(differing: Iterator[np.ndarray], radius: int) -> np.ndarray:
    """Words whose bits say which comparisons differ in ``radius`` planes at most.

    ``differing`` yields a word array for each plane. The counters are bit-sliced too: counter word k holds
    bit k of 64 counts, and a carry out of the last one marks a count beyond them.
    """
    counters: list[np.ndarray] = []
    beyond = None
    for step, carry in enumerate(differing):
        if beyond is None:
            counters = [np.zeros_like(carry) for _ in range(radius.bit_length())]
            beyond = np.zeros_like(carry)
        carry = carry.copy()
        for c in counters:
            c ^= carry  # the sum; where it became 0 the carry goes on
            carry &= ~c
        beyond |= carry
        if step % 8 == 7 and (beyond == np.uint64(0xFFFFFFFFFFFFFFFF)).all():
            return np.zeros_like(beyond)  # the block is abandoned
    if radius & (radius + 1):  # the counters hold more than the radius
        above = np.zeros_like(beyond)
        equal = ~np.zeros_like(beyond)
        for k in reversed(range(len(counters))):
            if radius >> k & 1:
                equal &= counters[k]
            else:
                above |= equal & counters[k]
                equal &= ~counters[k]
        beyond |= above
    return ~beyond


def _lanes(words: np.ndarray, n: int) -> np.ndarray:
    """Word bits as a boolean array of n lanes along the last axis."""
    flat = np.unpackbits(np.ascontiguousarray(words).view(np.uint8), axis=-1, bitorder="little")
    return flat[..., :n].astype(bool)


class Parts:
    """Union-find over the lanes of a task's batch."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.root(x), self.root(y)
        if x != y:
            self.up[max(x, y)] = min(x, y)
        return x != y


def edges_side_by_side(fps: np.ndarray, bucket: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Edges within many small buckets (sorted by bucket): each lane against the s-th lane after it."""
    out: list[tuple[int, int]] = []
    n = len(fps)
    parts = Parts(n)
    lane = np.arange(n)
    shift = 1
    while True:
        lane = lane[lane + shift < n]
        lane = lane[bucket[lane] == bucket[lane + shift]]
        if not len(lane):
            return out
        left, right = planes(fps[lane]), planes(fps[lane + shift])
        hit = _lanes(near((left[b] ^ right[b] for b in range(64)), radius), len(lane))
        out.extend((int(fps[i]), int(fps[i + shift])) for i in lane[hit].tolist() if parts.join(i, i + shift))
        shift += 1


def edges_of_bucket(fps: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Edges within one large bucket, a block of queries at a time."""
    out: list[tuple[int, int]] = []
    n = len(fps)
    vertical = planes(fps)
    label = np.arange(n)  # the part of each lane, by its smallest lane
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    for low in range(0, n, QUERIES):
        high = min(n, low + QUERIES)
        words = -(-high // 64)  # lanes up to the last query: each pair once
        query = fps[low:high, None]
        flips = (np.where(query >> np.uint64(b) & np.uint64(1), full, np.uint64(0)) for b in range(64))
        hit = _lanes(near((vertical[b][None, :words] ^ f for b, f in enumerate(flips)), radius), high)
        for i in range(low, high):
            met = np.flatnonzero(hit[i - low, :i])
            if len(met):
                roots, first = np.unique(label[met], return_index=True)
                out.extend((int(fps[i]), int(fps[j])) for j in met[first].tolist())
                if len(roots) > 1:
                    label[:i][np.isin(label[:i], roots[1:])] = roots[0]
                label[i] = roots[0]
    return out


def links(distinct: DataFrame, radius: int = 3) -> DataFrame:
    """Edges (a, b) that connect exactly the fingerprints (column fp) a path of links connects."""
    if not 0 <= radius <= 3:
        raise ValueError("the keys cover distances up to 3")
    size = [64 // BLOCKS + (i < 64 % BLOCKS) for i in range(BLOCKS)]
    at = [sum(size[:i]) for i in range(BLOCKS)]
    masks = [sum((1 << size[i]) - 1 << at[i] for i in chosen) for chosen in combinations(range(BLOCKS), BLOCKS - radius if radius else 1)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    keys = F.array(*[F.col("fp").bitwiseAND(F.lit(m).cast("long")) for m in signed])
    rows = distinct.select("fp", F.posexplode(keys).alias("t", "key"))
    dealt = rows.repartition(shuffle_partitions(distinct.sparkSession), "t", "key").sortWithinPartitions("t", "key", "fp")

    def emit(found: list[tuple[int, int]]) -> pa.RecordBatch:
        pairs = np.array(found, dtype=np.uint64).reshape(-1, 2).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    def compare(t: np.ndarray, key: np.ndarray, fps: np.ndarray) -> Iterator[pa.RecordBatch]:
        new = np.concatenate([[True], (t[1:] != t[:-1]) | (key[1:] != key[:-1])])
        first = np.flatnonzero(new)
        count = np.diff(np.append(first, len(fps)))
        bucket = np.repeat(np.arange(len(first)), count)
        sizes = count[bucket]
        small = (sizes > 1) & (sizes <= SIDE_BY_SIDE)
        found = edges_side_by_side(fps[small], bucket[small], radius) if small.any() else []
        for i in np.flatnonzero(count > SIDE_BY_SIDE).tolist():
            found.extend(edges_of_bucket(fps[first[i]:first[i] + count[i]], radius))
        if found:
            yield emit(found)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[tuple[np.ndarray, ...]] = []  # rows whose last bucket may go on in the next batch
        for batch in batches:
            if not batch.num_rows:
                continue
            fp, t, key = (batch.column(i).to_numpy() for i in range(3))
            change = np.flatnonzero((t[1:] != t[:-1]) | (key[1:] != key[:-1])) + 1
            goes_on = kept and kept[-1][0][-1] == t[0] and kept[-1][1][-1] == key[0]
            cut = int(change[-1]) if len(change) else (0 if goes_on or not kept else None)
            if cut is None:  # the rows kept end with a whole bucket
                yield from compare(*_joined(kept))
                kept, cut = [], 0
            elif cut:
                yield from compare(*_joined([*kept, (t[:cut], key[:cut], fp[:cut])]))
                kept = []
            kept.append((t[cut:], key[cut:], fp[cut:]))
        if kept:
            yield from compare(*_joined(kept))

    return dealt.mapInArrow(run, "a long, b long").distinct()


def _joined(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    t, key, fp = (np.concatenate(x) for x in zip(*parts))
    return t, key, fp.view(np.uint64)


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 3, id_col: str = "doc_id", text_col: str = "text",
                    keep: tuple[str, ...] = ()) -> DataFrame:
    """Per row: doc_id, the columns of ``keep``, fp (signed long), component_id, the smallest doc_id reachable
    over links, root, the smallest fingerprint reachable, which names the component also without doc_ids.

    Texts without words, null ones too, have fingerprint 0 and link as any other. Null doc_ids stay null and
    never are a component_id unless a component has no other. Repeated rows come as often as they stand.
    """
    made = materialize(fingerprints(docs, shingle, id_col, text_col, keep), "fingerprints")
    distinct = materialize(made.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    roots = connected_components(links(distinct.select("fp"), radius))
    rooted = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(distinct["fp"], "least", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = materialize(rooted.join(least, "root").select("fp", "component_id", "root"), "classes")
    return made.join(named, "fp").select("doc_id", *keep, "fp", "component_id", "root")
