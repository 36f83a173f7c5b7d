"""SentencePiece encoding and decoding: exact merge-type (BPE) encoding by backtracking.

The model's text form is a leading mark U+2581 and the text with each space as that mark. Encoding takes, from
left to right, the longest piece that an Aho-Corasick automaton finds at the position and that is compatible
with the piece before it; two pieces are compatible if merging their joined characters anew gives the same
two. Without a compatible piece the position is marked in a bit field and the piece before it gives way to the
next shorter one. A prefix has one encoding only, so a marked position never works and is not tried again.
The result is what merging the whole text gives.

Text is cut into pre-tokens where no piece of the model can reach across: before a mark that follows another
character, and between characters that no chain of pieces connects (letters and punctuation, say; the classes
are read off the model's pieces). Each pre-token is encoded once per Python worker while it stays in the memo.
"""

from __future__ import annotations

import os
import re
import sys
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import Memo, doc_columns, kept

MARK = "▁"
#: Half the entries of a worker's memo (about 200 bytes each), and all of its table of piece pairs, which then
#: starts anew. Results don't depend on them.
MEMO_ENTRIES = 300_000
PAIR_ENTRIES = 400_000
#: Longer pre-tokens are encoded each time.
MEMO_CHARS = 64



class Model:
    """The library's model and the cut of texts into pre-tokens that goes with it."""

    def __init__(self, path: str):
        os.environ.setdefault("OMP_NUM_THREADS", "1")
        import sentencepiece

        self.library = model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.ids = {model.id_to_piece(i): i for i in range(model.get_piece_size())
                    if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))}
        if any(re.search(f"[^{MARK}]{MARK}", p) for p in self.ids) or "".join(model.encode("  a  b", out_type=str)) != f"{MARK * 3}a{MARK * 2}b":
            raise ValueError(f"{path}: pieces cross pre-tokens, or the model changes spaces")
        self.pretoken = re.compile(self._pattern(), re.DOTALL)

    def _pattern(self) -> str:
        """Spaces, then a run of connected characters or any one character."""
        up: dict[str, str] = {}

        def root(c: str) -> str:
            up.setdefault(c, c)
            while up[c] != c:
                c = up[c]
            return c

        for p in self.ids:
            inner = p.lstrip(MARK)
            for a, b in zip(inner, inner[1:]):
                up[root(a)] = root(b)
        classes: dict[str, list[str]] = {}
        for c in up:
            classes.setdefault(root(c), []).append(c)
        runs = ["[" + "".join(map(re.escape, sorted(c))) + "]+" for c in sorted(classes.values(), key=len, reverse=True)]
        return " *(?:" + "|".join([*runs, "[^ ]"]) + ")| +"

    def pretokens(self, text: str | None) -> list[str]:
        """The pre-tokens of a text, marks shown as spaces, the mark before the text included; none for null
        and empty texts."""
        return self.pretoken.findall(" " + text.replace(MARK, " ")) if text else []


def load(path: str) -> Model:
    """This worker's model."""
    return kept(("model", path), lambda: Model(path))


class PieceEncoder:
    def __init__(self, path: str):
        import ahocorasick

        self.model = Model(path)
        self.ids = self.model.ids
        self.score = {p: self.model.library.get_score(i) for p, i in self.ids.items()}
        self.bytes = [self.model.library.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.automaton = ahocorasick.Automaton()
        for p in self.ids:
            self.automaton.add_word(p, len(p))
        self.automaton.make_automaton()
        self.pairs: dict[tuple[str, str], bool] = {}
        self.memo = Memo(self._ids, MEMO_ENTRIES, MEMO_CHARS)

    def merged(self, text: str) -> list[str]:
        """Merge the characters of a short text: the best-scored pair first, the leftmost of equals."""
        parts, score = list(text), self.score
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if at < 0:
                return parts
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def compatible(self, left: str, right: str) -> bool:
        key = (left, right)
        found = self.pairs.get(key)
        if found is None:
            if len(self.pairs) >= PAIR_ENTRIES:
                self.pairs.clear()
            found = self.pairs[key] = self.merged(left + right) == [left, right] if left else self.merged(right) == [right]
        return found

    def split(self, text: str) -> list[str]:
        """The pieces of a pre-token, by backtracking."""
        n = len(text)
        sizes: list[list[int]] = [[1] for _ in range(n)]  # lengths of the pieces at each place, shortest first
        for end, size in self.automaton.iter(text):
            if size > 1:
                sizes[end - size + 1].append(size)
        open_ = (1 << (n + 1)) - 1  # bit p: nothing says yet that the text can't be encoded from p on
        taken: list[tuple[int, int]] = []
        left, pos, k = "", 0, len(sizes[0]) - 1 if n else -1
        while pos < n:
            if k < 0:
                open_ &= ~(1 << pos)
                pos, k = taken.pop()
                k -= 1
                left = text[taken[-1][0]:pos] if taken else ""
                continue
            end = pos + sizes[pos][k]
            if open_ >> end & 1 and self.compatible(left, right := text[pos:end]):
                taken.append((pos, k))
                left, pos = right, end
                k = len(sizes[pos]) - 1 if pos < n else -1
            else:
                k -= 1
        cuts = [p for p, _ in taken] + [n]
        return [text[a:b] for a, b in zip(cuts, cuts[1:])]

    def _ids(self, pretoken: str) -> bytes:
        out: list[int] = []
        for piece in self.split(pretoken.replace(" ", MARK)):
            found = self.ids.get(piece)
            out.extend([found] if found is not None else [self.bytes[b] for b in piece.encode()])
        packed = array("i", out)
        if sys.byteorder == "big":
            packed.byteswap()
        return packed.tobytes()

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian int32."""
        return b"".join(map(self.memo.__getitem__, self.model.pretokens(text)))


def piece_encoder(path: str) -> PieceEncoder:
    """This worker's encoder for the model."""
    return kept(("pieces", path), lambda: PieceEncoder(path))


def encode_decode(docs: DataFrame, model_path: str, rows: int = 500, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, ids array<int>, decoded string (the library's decoding of the ids).

    Null and empty texts have no ids and an empty decoding. Null doc_ids stay null, repeated rows are each
    encoded. Characters without a piece become byte pieces. ``rows`` bounds what a task holds.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = piece_encoder(model_path)
        for batch in batches:
            for low in range(0, batch.num_rows, rows):
                coded = [enc.encode(t.as_py()) for t in batch.column(1)[low:low + rows]]
                ends = np.cumsum([0, *(len(c) // 4 for c in coded)])
                values = np.frombuffer(b"".join(coded), dtype="<i4")
                flat = values.tolist()
                decoded = enc.model.library.decode([flat[a:b] for a, b in zip(ends, ends[1:])], num_threads=1)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0)[low:low + rows], pa.ListArray.from_arrays(pa.array(ends, type=pa.int32()), pa.array(values)),
                    pa.array(decoded, type=pa.string())], schema=schema)

    return doc_columns(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids array<int>, decoded string")
