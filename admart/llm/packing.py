"""Packing by Karmarkar-Karp multiway differencing.

Each task streams its documents. Whole windows of a document (2,048 ids) are sequences already; the
remainders gather in groups of about ``group_windows`` windows. A group is parted into near-equal windows:
every remainder starts as a partial partition of its own; the two partial partitions with the largest
imbalance are merged, the fullest windows of the one onto the emptiest of the other, until one is left.
Where its fullest window exceeds the capacity, the number of windows rises by one and the group is parted
anew. Documents may be cut, so every ``1 / small_share``-th remainder (by ids) is cut to pieces of
``small_piece`` ids; these let the differencing end almost level, and the padding below half a per cent.

No shuffle: a group lives in one input partition, with memory for one group. Sequence ids are
``partition * 2**40 + ordinal``, unique and the same whenever the partition is computed again.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .common import doc_columns
from .tokens import encoder, id_width

SCHEMA = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
ARROW = pa.schema([(n, pa.int64()) for n in ("doc_id", "start", "length", "doc_tokens", "sequence_id", "offset")]
                  + [("ids", pa.binary())])


def differencing(sizes: list[int], k: int) -> np.ndarray:
    """The window, 0 to k-1, of each size, by multiway differencing into k windows.

    A partial partition holds its windows' sums, largest first, and an id for the members of each; windows
    not held are empty. ``joins`` says which two member sets became one.
    """
    n = free = len(sizes)
    heap = [(-int(s), i, np.array([s], dtype=np.int64), np.array([i])) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    joins = []
    for tie in range(n, 2 * n - 1):
        _, _, a, a_ids = heapq.heappop(heap)
        _, _, b, b_ids = heapq.heappop(heap)
        shared = max(0, len(a) + len(b) - k)  # windows that both need: a's emptiest meet b's emptiest, crosswise
        alone_a, alone_b = len(a) - shared, len(b) - shared
        ids = np.arange(free, free + shared)
        joins.append((ids, a_ids[alone_a:], b_ids[alone_b:][::-1]))
        free += shared
        sums = np.concatenate([a[:alone_a], a[alone_a:] + b[alone_b:][::-1], b[:alone_b]])
        ids = np.concatenate([a_ids[:alone_a], ids, b_ids[:alone_b]])
        order = np.argsort(-sums, kind="stable")
        sums, ids = sums[order], ids[order]
        if len(sums) == k:
            sums = sums - sums[-1]
        heapq.heappush(heap, (-int(sums[0]), tie, sums, ids))
    window = np.zeros(free, dtype=np.int64)
    last = heap[0][3]
    window[last] = np.arange(len(last))
    for ids, left, right in reversed(joins):
        window[left] = window[right] = window[ids]
    return window[:n]


def part(sizes: list[int], capacity: int) -> tuple[np.ndarray, int]:
    """Windows of at most ``capacity`` for the sizes (none larger), and their number."""
    k = max(1, -(-sum(sizes) // capacity))
    while True:
        window = differencing(sizes, k)
        if np.bincount(window, weights=sizes, minlength=k).max() <= capacity:
            return window, k
        k += 1


class Packer:
    """Packs the documents of one input partition."""

    def __init__(self, first_sequence: int, width: int, capacity: int, group_windows: int, small_share: int, small_piece: int):
        self.next, self.width, self.capacity = first_sequence, width, capacity
        self.full, self.share, self.small = group_windows * capacity, small_share, small_piece
        self.group: list[tuple] = []
        self.held = self.due = 0

    def _rows(self, pieces: list[tuple]) -> Iterator[tuple]:
        """One sequence."""
        at = 0
        for doc, start, total, data in pieces:
            n = len(data) // self.width
            ids = np.frombuffer(data, dtype=f"<u{self.width}").astype("<u4").tobytes()
            yield doc, start, n, total, self.next, at, ids
            at += n
        self.next += 1

    def add(self, doc: int | None, data: bytes) -> Iterator[tuple]:
        total = len(data) // self.width
        whole = total - total % self.capacity
        step = self.capacity * self.width
        for k in range(whole // self.capacity):
            yield from self._rows([(doc, k * self.capacity, total, data[k * step:(k + 1) * step])])
        rest = total - whole
        if rest:
            self.due += rest
            size = rest
            if self.due >= self.share * rest > 0 and rest > self.small:
                self.due -= self.share * rest
                size = self.small
            self.due = min(self.due, self.share * self.capacity)
            for start in range(whole, total, size):
                self.group.append((doc, start, total, data[start * self.width:min(start + size, total) * self.width]))
            self.held += rest
            if self.held >= self.full:
                yield from self.flush()

    def flush(self) -> Iterator[tuple]:
        if not self.group:
            return
        group, self.group, self.held = self.group, [], 0
        window, k = part([len(x[3]) // self.width for x in group], self.capacity)
        members: list[list[tuple]] = [[] for _ in range(k)]
        for piece, w in zip(group, window.tolist()):
            members[w].append(piece)
        for pieces in members:
            if pieces:
                yield from self._rows(pieces)


def pack(docs: DataFrame, tokenizer_path: str, end_id: int, capacity: int = 2048, group_windows: int = 512,
         small_share: int = 10, small_piece: int = 64, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pack every document (its ids, then ``end_id``) into sequences of at most ``capacity`` ids.

    Returns a row per piece: doc_id, start (ids of its document before it), length, doc_tokens, sequence_id,
    offset (in the sequence, gapless from 0), ids (little-endian uint32). Null texts are empty: the end id
    alone. Null doc_ids stay null; repeated rows are packed as often as they come; no rows give no pieces.
    """
    width = id_width(tokenizer_path)
    end = np.array([end_id], dtype=f"<u{width}").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer_path, width)
        packer = Packer(TaskContext.get().partitionId() << 40, width, capacity, group_windows, small_share, small_piece)
        out: list[tuple] = []
        weight = 0

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows), ARROW)], schema=ARROW)

        for batch in batches:
            ids_of, text_of = batch.column(0).to_pylist(), batch.column(1)
            for doc, text in zip(ids_of, text_of):
                for row in packer.add(doc, enc.encode(text.as_py()) + end):
                    out.append(row)
                    weight += len(row[-1]) + 64
                    if weight > 8 << 20:
                        yield batch_of(out)
                        out, weight = [], 0
        out.extend(packer.flush())
        if out:
            yield batch_of(out)

    return doc_columns(docs, id_col, text_col).mapInArrow(run, SCHEMA)
