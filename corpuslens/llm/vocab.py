"""Exact, memoised tokenisation with a public vocabulary file.

Every pre-token of the two supported pre-tokenisers is a run of white space or
an optional space followed by non-white-space, so a text can be cut at its
white space and every piece encoded on its own.  ``WordMemo`` keeps the ids of
pieces seen so far and hands only unseen ones to the ``tokenizers`` library;
plain words go straight to its model.  Texts where the cut could be wrong (special-token strings,
unusual white space) are encoded whole, so results always equal
``Tokenizer.encode(text, add_special_tokens=False)``.
"""

from __future__ import annotations

import hashlib
import os
import re
from array import array
from collections.abc import Iterator
from contextlib import contextmanager
from itertools import chain

import numpy as np
from pyspark import Broadcast
from pyspark.sql import SparkSession

# Latin letters with code points below U+0100; all of them are \p{L}.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_SIMPLE = re.compile(f"([{_LETTERS}]+)([!-&(-/:-@\\[-`{{-~]*)")
# White space that the two libraries may see differently, or that needs care.
_CONTROLS = "\x1c\x1d\x1e\x1f"
_RARE = "\t\x0b\x0c\r\x85\xa0     　" + "".join(map(chr, range(0x2000, 0x200B))) + _CONTROLS
_RUNS = ("  ", " \n", "\n ", "\n\n")
PART = 1 << 20  # characters encoded at once
# Byte-level vocabularies show the bytes 127 to 160 and 173 as the characters from U+0121 on.
_SHOWN = {b: 0x121 + i for i, b in enumerate([*range(127, 161), 173])}


class WordMemo:
    """Encoder of whole texts into little-endian ``uint32`` id bytes.

    ``json`` is the content of a ``tokenizers`` file; ``limit`` bounds the memo
    (about 200 bytes an entry). Null and empty texts give no ids; long ones are
    encoded in parts of about ``PART`` characters, cut at white space.
    """

    def __init__(self, json: str, limit: int = 700_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(json)
        self.limit = limit
        # A pre-tokeniser that drops white space makes a word's ids independent of what precedes it.
        self.spaced = bool(self._whole(" a") != self._whole("a"))
        self.lower = self._whole("A") == self._whole("a")
        self.after_space: dict[str, bytes] = {}
        self.after_break: dict[str, bytes] = self.after_space if not self.spaced else {}
        self.line_break = self._whole("a\nb")[len(self._whole("a")) :][: 4 * self.spaced]

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _learn(self, pieces: set[str], known: dict[str, bytes], space: bool) -> dict[str, bytes]:
        """Ids of unseen pieces; plain words skip normaliser and pre-tokeniser."""
        words, plain, cut = set(), [], []
        match = _SIMPLE.fullmatch
        for p in pieces:
            if m := match(p):
                w, t = m.groups()
                if t:
                    cut.append((p, w, t))
                words.add(w)
            else:
                plain.append(p)
        out: dict[str, bytes] = {}
        lead = "Ġ" if space and self.spaced else ""
        tokenize = self.tokenizer.model.tokenize
        for w in words:
            if w not in known:
                shown = w if w.isascii() else w.encode().decode("latin-1").translate(_SHOWN)
                out[w] = array("I", [t.id for t in tokenize(lead + shown)]).tobytes()
        tails = {t: self._whole("a" + t)[len(self._whole("a")) :] for t in {c[2] for c in cut}}
        for p, w, t in cut:
            out[p] = (out[w] if w in out else known[w]) + tails[t]
        if plain:
            lead = " " if space and self.spaced else ""
            found = self.tokenizer.encode_batch([lead + p for p in plain], add_special_tokens=False)
            out.update((p, np.array(e.ids, dtype="<u4").tobytes()) for p, e in zip(plain, found))
        return out

    def _odd(self, text: str) -> bool:
        """Whether the text must be encoded whole."""
        if "<|" in text or (self.lower and "Σ" in text):
            return True
        if not self.spaced:
            return any(c in text for c in _CONTROLS)
        return text[0] in " \n" or text[-1] in " \n" or any(c in text for c in _RARE) or any(c in text for c in _RUNS)

    def forget(self) -> None:
        """Drop all pieces."""
        self.after_space.clear()
        self.after_break.clear()

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text, four bytes each."""
        out: list[bytes] = []
        group: list[str | None] = []
        held = 0
        for text in chain(texts, [None]):
            if text is not None and len(text) > PART:
                out += self._encode(group)
                group, held = [], 0
                out.append(self._whole(text) if self._odd(text) else b"".join(self._plain([part])[0] for part in parts(text)))
                continue
            group.append(text)
            held += len(text or "")
            if held >= PART:
                out += self._encode(group)
                group, held = [], 0
        return (out + self._encode(group))[: len(texts)]

    def _encode(self, texts: list[str | None]) -> list[bytes]:
        odd = {i for i, t in enumerate(texts) if t and self._odd(t)}
        out = self._plain([None if i in odd else t for i, t in enumerate(texts)])
        for i in odd:
            out[i] = self._whole(texts[i])
        return out

    def _plain(self, texts: list[str | None]) -> list[bytes]:
        """Ids of texts that may be cut at their white space."""
        out: list[bytes] = [b""] * len(texts)
        rows, firsts = [], []
        for i, text in enumerate(texts):
            if not text:
                continue
            if self.lower:
                text = text.lower()
            if self.spaced:
                lines = [x.split(" ") for x in text.split("\n")]
                firsts.extend(x[0] for x in lines)
                rows.append((i, lines))
            else:
                rows.append((i, text.split()))
        if self.spaced:
            new = set().union(*(x[1:] for _, lines in rows for x in lines)).difference(self.after_space)
            new_first = set(firsts).difference(self.after_break)
            later = self._learn(new, self.after_space, True)
            first = self._learn(new_first, self.after_break, False)
            first = self._keep(first, self.after_break)
        else:
            later = self._learn(set().union(*(x for _, x in rows)).difference(self.after_space), self.after_space, False if self.spaced else True)
        later = self._keep(later, self.after_space)
        get = later.__getitem__
        if not self.spaced:
            for i, words in rows:
                out[i] = b"".join(map(get, words))
            return out
        brk = self.line_break
        for i, lines in rows:
            parts = []
            for x in lines:
                parts.append(first[x[0]])
                parts.extend(map(get, x[1:]))
                parts.append(brk)
            out[i] = b"".join(parts[:-1])
        return out

    def _keep(self, new: dict[str, bytes], known: dict[str, bytes]) -> dict[str, bytes]:
        """Remember new pieces up to the limit; return a mapping that has all."""
        if len(known) + len(new) <= self.limit:
            known.update(new)
            return known
        return _Both(new, known)


class _Both(dict):
    def __init__(self, new: dict[str, bytes], known: dict[str, bytes]):
        super().__init__(new)
        self.known = known

    def __missing__(self, key: str) -> bytes:
        return self.known[key]


def parts(text: str) -> Iterator[str]:
    """Parts of about ``PART`` characters; each but the first begins with the blank or line end where it was cut."""
    at = 0
    while len(text) - at > PART:
        cuts = [c for c in (text.find(" ", at + PART), text.find("\n", at + PART)) if c >= 0]
        if not cuts:
            break
        yield text[at : min(cuts)]
        at = min(cuts)
    yield text[at:]


def shipped(spark: SparkSession, path: str) -> Broadcast:
    """A vocabulary file, read by the driver and sent to the executors: a few megabytes, whatever the input's size."""
    with open(path, encoding="utf-8") as f:
        return spark.sparkContext.broadcast(f.read())


_LAST: dict[str, WordMemo] = {}


@contextmanager
def memo(json: str) -> Iterator[WordMemo]:
    """The worker's encoder for the length of a task.

    Workers serve many tasks and stages, so the learned pieces go when a task
    ends, and only the last vocabulary stays loaded.
    """
    key = hashlib.blake2b(json.encode()).hexdigest()
    if key not in _LAST:
        _LAST.clear()
        _LAST[key] = WordMemo(json)
    try:
        yield _LAST[key]
    finally:
        _LAST[key].forget()
