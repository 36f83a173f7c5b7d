"""Token ids of a ``tokenizers`` file, each pre-token encoded once per Python worker while it stays in the memo.

The library's own result is reproduced exactly. For two makes of byte-level BPE files, whose pre-tokenizers
are fixed regular expressions, Latin-1 text is cut into the same pre-tokens by the same expression with its
Unicode classes written out for Latin-1, and the library's model merges each. Other text of these files is cut
at single ASCII spaces between two characters that are no white space, where neither a pre-token nor a special
token can reach across; what is not Latin-1 there, and all text of files of any other make, goes through the
library as it is.
"""

from __future__ import annotations

import json
import os
import re
import sys
from array import array

from tokenizers.pre_tokenizers import ByteLevel

from .common import Memo, kept

#: Python's white space holds all that the tokenizers' own patterns take as white space.
CUT = re.compile(r"(?<=\S) (?=\S)")
# The Latin-1 members of the classes L and N and of white space, and the two pre-token patterns.
L = "A-Za-zªµºÀ-ÖØ-öø-ÿ"
N = "0-9²³¹¼-¾"
S = "\t-\r \u0085 "
SPACED = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{L}]+| ?[{N}]+| ?[^{S}{L}{N}]+|[{S}]+(?![^{S}])|[{S}]+")
DROPPED = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{L}]+|[{N}]|[^{S}{L}{N}]+")
DROPPED_SPEC = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Half the entries of a worker's memo (about 200 bytes each). Results don't depend on it.
MEMO_ENTRIES = 300_000
#: Longer pre-tokens are encoded each time.
MEMO_CHARS = 64

def latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def lexer(spec: dict) -> re.Pattern | None:
    """The pre-token pattern of a file of a known make, for Latin-1 text without special tokens."""
    for token in spec.get("added_tokens") or []:
        if " " in token["content"] or token["lstrip"] or token["rstrip"] or token["single_word"]:
            return None
    norm, pre = spec.get("normalizer"), spec.get("pre_tokenizer") or {}
    if spec["model"]["type"] != "BPE" or spec["model"].get("continuing_subword_prefix"):
        return None
    if norm is None and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space"):
        return SPACED
    if norm and norm["type"] == "Sequence" and pre.get("type") == "Sequence":
        split, *rest = pre["pretokenizers"]
        if ([x["type"] for x in norm["normalizers"]] == ["NFC", "Replace", "Lowercase"] and split["type"] == "Split"
                and split["pattern"] == {"Regex": DROPPED_SPEC} and split["behavior"] == "Removed" and split["invert"]
                and [x["type"] for x in rest] == ["ByteLevel"] and not rest[0]["add_prefix_space"] and not rest[0]["use_regex"]):
            return DROPPED
    return None


class WordMemo:
    """Encodes texts to little-endian ids of ``width`` bytes each."""

    def __init__(self, path: str, width: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.code = {1: "B", 2: "H", 4: "I"}[width]
        if self.tokenizer.get_vocab_size() > 256 ** width:
            raise ValueError(f"ids of {path} don't fit {width} bytes")
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.lexer = lexer(spec)
        self.lower = self.lexer is DROPPED
        self.special = [t["content"] for t in spec.get("added_tokens") or []]
        shown = ByteLevel(add_prefix_space=False, use_regex=False)
        self.shown = {c: shown.pre_tokenize_str(chr(c))[0][0] for c in range(256)}  # the model's spelling of bytes
        self.memo = Memo(self._pretoken, MEMO_ENTRIES, MEMO_CHARS)

    def _bytes(self, ids: list[int]) -> bytes:
        packed = array(self.code, ids)
        if sys.byteorder == "big":
            packed.byteswap()
        return packed.tobytes()

    def _whole(self, text: str) -> bytes:
        return self._bytes(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _pretoken(self, pretoken: str) -> bytes:
        return self._bytes([x.id for x in self.model.tokenize(pretoken.translate(self.shown))])

    def _latin(self, text: str) -> bytes:
        return b"".join(map(self.memo.__getitem__, self.lexer.findall(text.lower() if self.lower else text)))

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if self.lexer is None:
            return self._whole(text)
        special = [s for s in self.special if s in text]
        if not special and latin(text):
            return self._latin(text)
        first, *rest = CUT.split(text)
        return b"".join([self._latin(p) if latin(p) and not any(s in p for s in special) else self._whole(p)
                         for p in (first, *(" " + x for x in rest))])


def id_width(path: str) -> int:
    """Bytes that hold each id of the file: 2 up to 65,536 ids, else 4."""
    from tokenizers import Tokenizer

    return 2 if Tokenizer.from_file(path).get_vocab_size() <= 1 << 16 else 4


def encoder(path: str, width: int) -> WordMemo:
    """This worker's encoder for the file."""
    return kept(("tokens", path, width), lambda: WordMemo(path, width))
