"""Exact encoders over the ``tokenizers`` library with a bounded cache of text chunks.

A chunk is a piece of text that the tokenizer's own pre-tokenizer never joins to its neighbours, so the
ids of a text are the ids of its chunks in order. Chunks repeat far more often than texts do; each is
encoded by the library (normaliser, pre-tokenizer and model of the file) and kept in the worker process in
two generations of at most ``limit`` entries: when the young one is full it becomes the old one, and what is
still in use moves on from there. A text whose white space makes chunks ambiguous, or that may hold the
string of an added token (``<|endoftext|>``), is encoded whole by the library with its own settings.
"""

from __future__ import annotations

import array
import functools
import os
import re
from collections.abc import Callable

from valuemark.llm.common import worker_state

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: A run of Latin letters with plain punctuation behind it: pre-tokens are the run and the punctuation.
PLAIN = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?%&$#*|()]*)")

def encoder(path: str, limit: int = 250_000) -> "ChunkEncoder":
    """The worker's encoder for a tokenizer file; it outlives a task."""
    return worker_state(("encoder", path, limit), functools.partial(ChunkEncoder, path, limit))


class _Chunks(dict):
    """Ids of chunks, encoded when first asked for, in two generations of at most ``limit`` entries."""

    def __init__(self, encode: Callable[[str], bytes | None], limit: int):
        super().__init__()
        self.encode, self.limit, self.old = encode, limit, {}

    def __missing__(self, chunk: str) -> bytes | None:
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        found = self.old[chunk] if chunk in self.old else self.encode(chunk)
        self[chunk] = found
        return found


class ChunkEncoder:
    """``ids(text)`` gives little-endian unsigned 32-bit ids, equal to the library's for the whole text."""

    def __init__(self, path: str, limit: int):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        # What an added token holds besides letters, which no normaliser makes: a text without it has no added token.
        self.marks = {max(re.split(r"\w+", t.content), key=len) for t in self.library.get_added_tokens_decoder().values()}
        self.model, self.cache = self.library.model, _Chunks(self._encode, limit)
        self.normalizer = self.library.normalizer
        self.split = self.library.pre_tokenizer.pre_tokenize_str
        # White space is part of a token in byte-level vocabularies and is dropped in others.
        self.keeps_space = "".join(p for p, _ in self.split(" a")) != "".join(p for p, _ in self.split("a"))
        self.space = "".join(p for p, _ in self.split(" ")) if self.keeps_space else ""
        letters = [chr(c) for c in range(0xC0, 0x100) if PLAIN.fullmatch(chr(c))]
        self.spelling = str.maketrans({c: "".join(p for p, _ in self.split(c)) for c in letters})
        self.tokenize, self.tails = self.model.tokenize, {}
        self.lowers = self.normalizer is not None and self.normalizer.normalize_str("A") == "a"

    def _pieces(self, chunk: str) -> list[str]:
        text = self.normalizer.normalize_str(chunk) if self.normalizer is not None else chunk
        return [p for p, _ in self.split(text)]

    def _encode(self, chunk: str) -> bytes | None:
        """Ids of a chunk as it stands behind a space; one led by a line end stands behind that."""
        led = self.keeps_space and chunk[:1] == "\n"
        if m := PLAIN.fullmatch(chunk, led):
            word, tail = m.groups()
            if tail:  # the word, a chunk of its own, and the punctuation
                return self.cache[chunk[: -len(tail)]] + self._tail(tail)
            return self._tail("\n") + self._plain("", word, "") if led else self._plain(self.space, word, "")
        if self.keeps_space:
            if len(chunk.split()) != 1 or chunk[-1:].isspace():
                return None
            chunk = chunk if chunk[0] == "\n" else " " + chunk
        return self._packed(chunk)

    def _plain(self, lead: str, word: str, tail: str) -> bytes:
        word = word.lower() if self.lowers else word
        found = self.tokenize(lead + (word if word.isascii() else word.translate(self.spelling)))
        return array.array("I", [t.id for t in found]).tobytes() + (self._tail(tail) if tail else b"")

    def _tail(self, tail: str) -> bytes:
        """Plain punctuation, and a line end before a word, is a pre-token of its own."""
        if tail not in self.tails:
            self.tails[tail] = self._packed(tail)
            if len(self.tails) > 10_000:
                self.tails = {tail: self.tails[tail]}
        return self.tails[tail]

    def _packed(self, chunk: str) -> bytes:
        return array.array("I", [t.id for p in self._pieces(chunk) for t in self.tokenize(p)]).tobytes()

    def whole(self, text: str) -> bytes:
        return array.array("I", self.library.encode(text, add_special_tokens=False).ids).tobytes()

    def ids(self, text: str) -> bytes:
        cache, first = self.cache, b""
        for mark in self.marks:
            if mark in text:
                return self.whole(text)
        if self.keeps_space:
            if not text or text[0] in " \n" or text[-1] in " \n" or any(x in text for x in ("  ", " \n", "\n ", "\n\n")):
                return self.whole(text)
            head, *chunks = text.replace("\n", " \n").split(" ")
            if len(head.split()) != 1 or head[-1:].isspace() or head[0].isspace():
                return self.whole(text)
            m = PLAIN.fullmatch(head)
            first = self._plain("", *m.groups()) if m else self._packed(head)
        else:
            chunks = text.replace("\n", " ").split(" ")
        try:
            return first + b"".join(map(cache.__getitem__, chunks))
        except TypeError:  # a chunk holds white space of another kind
            return self.whole(text)
