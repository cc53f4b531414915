"""Token ids of whole texts with a public tokenizer, fast enough for a corpus.

A byte-level BPE tokenizer cuts text into pre-tokens and encodes each alone, so
a text may be cut wherever a pre-token surely starts: before a single space
that stands between two non-space characters. Every such chunk is encoded once
by the ``tokenizers`` library and remembered in a bounded per-task table; a
text's ids are the chunks' ids joined. Texts whose spaces stand otherwise or that
hold the string of a special token, and tokenizers of another make, go through the
library whole or in larger pieces. The ids are those of
``Tokenizer.encode(text, add_special_tokens=False)``.
"""

from __future__ import annotations

import json
import os
import re
import sys
import types
from array import array

MEMO_CHUNKS = 500_000  # chunks per generation of a task's table; the last two generations are kept
MEMO_CHARS = 64  # longer chunks are not remembered
_SAFE = re.compile(r"(?<=\S) (?=\S)")
_STEM = re.compile(r"([^\W\d_]+)([^\w\s]+)")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_letters() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level BPE vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table, extra = {b: chr(b) for b in plain}, 256
    for b in range(256):
        if b not in table:
            table[b] = chr(extra)
            extra += 1
    return table


def _raw(ids: list[int]) -> bytes:
    """``ids`` as little-endian uint32 bytes."""
    words = array("I", ids)
    if sys.byteorder == "big":
        words.byteswap()
    return words.tobytes()


class _Memo(dict):
    """Chunk (without its leading space) to ids as little-endian uint32 bytes."""

    def __init__(self, encoder: "TextEncoder"):
        self.encoder, self.older = encoder, {}

    def __missing__(self, chunk: str) -> bytes:
        ids = self.older.get(chunk)
        if ids is None:
            if chunk.isalpha():
                ids = self.encoder.word(chunk, True)
            else:
                if not chunk or chunk[0].isspace() or chunk[-1].isspace():
                    raise _Irregular
                ids = self.encoder.chunk_ids(chunk)
                if "\n" in chunk:  # a line's last and next line's first word seldom meet again
                    return ids
        if len(chunk) <= MEMO_CHARS:
            self[chunk] = ids
        return ids

    def trim(self) -> None:
        if len(self) > MEMO_CHUNKS:
            self.older = dict(self)
            self.clear()


class _Irregular(Exception):
    """A space of the text has white space beside it."""


class TextEncoder:
    """``ids(text)`` gives a text's token ids as little-endian uint32 bytes."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        made = json.loads(self.tokenizer.to_str())
        pre = made.get("pre_tokenizer") or {}
        self.chunked = (
            made["model"]["type"] == "BPE" and not made.get("normalizer") and pre.get("type") == "ByteLevel"
            and pre.get("use_regex", False) and not pre.get("add_prefix_space", True)
            and all(t["special"] for t in made.get("added_tokens", []))
        )
        added = [t["content"] for t in made.get("added_tokens", [])]
        self.added = re.compile("|".join(map(re.escape, added))) if added else None
        self.letters = _byte_letters()
        self.memo = _Memo(self)
        self.others: dict[str, bytes] = {}  # marks after a word, words after a line's end

    def library(self, text: str) -> bytes:
        return _raw(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def word(self, letters: str, space: bool) -> bytes:
        """Ids of one pre-token of letters: the library's BPE model takes it directly."""
        plain = letters if letters.isascii() else letters.encode("utf-8").decode("latin-1").translate(self.letters)
        return _raw([t.id for t in self.model.tokenize("Ġ" + plain if space else plain)])

    def other(self, text: str) -> bytes:
        ids = self.others.get(text)
        if ids is None:
            if len(self.others) > MEMO_CHUNKS // 4:
                self.others.clear()
            ids = self.others[text] = self.word(text, False) if text.isalpha() else self.library(text)
        return ids

    def chunk_ids(self, chunk: str) -> bytes:
        """Ids of a space followed by ``chunk``, which is not of letters only."""
        stem = _STEM.fullmatch(chunk)
        if stem and stem[1].isalpha():  # marks after letters are a pre-token of their own
            return self.memo[stem[1]] + self.other(stem[2])
        left, line, right = chunk.partition("\n")
        if line and left and not left[-1].isspace() and right and not right[0].isspace():
            # A line's end between non-space characters is a pre-token of its own, too.
            return self.memo[left] + self.other("\n") + self.start_ids(right)
        return self.library(" " + chunk)

    def start_ids(self, text: str) -> bytes:
        """Ids of a text without a space in front."""
        stem = _STEM.fullmatch(text)
        if stem and stem[1].isalpha():
            return self.other(stem[1]) + self.other(stem[2])
        return self.other(text) if text.isalpha() else self.library(text)

    def ids(self, text: str | None) -> bytes:
        """Null and empty texts have no ids."""
        if not text:
            return b""
        if not self.chunked or (self.added and self.added.search(text)):
            return self.library(text)
        self.memo.trim()
        parts = text.split(" ")
        try:
            if parts[0] and parts[0][-1].isspace():
                raise _Irregular
            first = self.start_ids(parts[0]) if parts[0] else b""
            return first + b"".join(map(self.memo.__getitem__, parts[1:]))
        except _Irregular:
            return self._irregular(text)

    def _irregular(self, text: str) -> bytes:
        out, first = [], True
        for piece in _SAFE.split(text):
            if first:
                out.append(self.library(piece))
                first = False
            elif piece[-1:].isspace() or any(c.isspace() for c in piece):
                out.append(self.library(" " + piece))
            else:
                out.append(self.memo[piece])
        return b"".join(out)


def shared_encoder(path: str) -> TextEncoder:
    """The worker process's encoder: its table of chunks serves all tasks that run there."""
    state = sys.modules.setdefault("_text_encoders", types.ModuleType("_text_encoders")).__dict__
    if path not in state:
        state[path] = TextEncoder(path)
    return state[path]
