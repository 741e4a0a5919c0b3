"""Tokenizing whole texts with a cache of pieces.

Both kinds of vocabulary cut a text by a pattern before they merge, so the ids of a text are those of its pieces one after the
other.  Texts of plain characters (printable ASCII, letters of Western Europe, spaces and line feeds) are cut here by the same pattern, and
each Python worker keeps the ids of the words and pieces it met; new pieces go to the vocabulary's merges.  Other texts are cut at white
space only, and new words that are not plain go to the tokenizer.  The caches have two generations of at most about ``_MOST`` entries,
the older of which goes when the newer is full; what is met again moves on.  This changes the speed, never the ids.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

_MOST, _CHARS = 500_000, 4_000_000
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
#: Characters whose class is the same in every Unicode version and in both pattern languages.
_PLAIN_TEXT = re.compile(rf"[ \n!-~{_LETTERS}]*")
_PLAIN_WORD = re.compile(rf"\n?[!-~{_LETTERS}]*")
# The patterns of the two vocabularies over plain characters, and tabs, which keep words apart here.  Fixed values: the alternatives and
# the contractions.
_CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"
_BYTE_PIECES = re.compile(rf" ?[{_LETTERS}]+| ?[0-9]+|{_CONTRACTIONS}|\t| ?[^ \n\t{_LETTERS}0-9]+|[ \n]+(?![^ \n])|[ \n]+")
_WORD_PIECES = re.compile(rf"[{_LETTERS}]+|[0-9]|{_CONTRACTIONS}|\t|[^ \n\t{_LETTERS}0-9]+")
#: Places before a space or line feed that follows a character which is not white space: no match of the byte-level
#: pattern crosses them, and none looks beyond them.
_CUT = re.compile(r"(?<=\S)(?=[ \n])")


def _byte_names() -> dict[int, str]:
    """The characters that byte-level vocabularies write bytes as: printable ones as themselves, others from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


def _gather(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of data that the codes stand for, one after the other, and where each ends (after a 0)."""
    length = lengths[code]
    ends = np.r_[0, np.cumsum(length)]
    return data[np.repeat(starts[code] - ends[:-1], length) + np.arange(ends[-1])], ends


def _gathered(ids: list[bytes], code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
    out, ends = _gather(np.frombuffer(b"".join(ids), "<u4"), np.cumsum(lengths) - lengths, lengths, code)
    return out, ends[1:]


def _has_runs(text: str) -> bool:
    """Whether white space (spaces and line feeds) stands at an end of a text or in a run."""
    return not text or text[0] in " \n" or text[-1] in " \n" or "  " in text or " \n" in text or "\n " in text or "\n\n" in text


class Encoder:
    """Texts to little-endian unsigned 32-bit ids, as bytes."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        #: Texts that may hold an added token, in any letter case, are left to the tokenizer as a whole.
        self.added = re.compile("|".join(re.escape(t["content"]) for t in spec.get("added_tokens") or ()) or r"(?!)", re.IGNORECASE)
        #: Byte-level vocabularies keep white space; the other kind drops it.
        self.keeps_space = spec.get("normalizer") is None and spec["pre_tokenizer"]["type"] == "ByteLevel"
        self.model, self.names = self.tokenizer.model, _byte_names()
        self.parts: dict[str, bytes] = {}
        self.older_parts: dict[str, bytes] = {}
        self.cache: dict = {}
        self.older: dict = {}
        self.unsafe = {"", "\n"}  # words after which a cut may split a run of white space

    def _words(self, text: str) -> list:
        """Keys of the cache: a word stands for itself after a space, or begins with its line feed; a text's first word is a tuple."""
        if not self.keeps_space:
            return text.replace("\n", " ").split(" ")
        words: list = text.replace("\n", " \n").split(" ")
        if not self.unsafe.isdisjoint(words):
            pieces = _CUT.split(text)
            words = pieces[:1] + [p[1:] if p[0] == " " and p[1:2] not in ("", "\n") else p if p[0] == "\n" else (p,) for p in pieces[1:]]
        words[0] = (words[0],)
        return words

    def _piece(self, word) -> str:
        if not self.keeps_space:
            return word
        return word[0] if isinstance(word, tuple) else word if word[:1] == "\n" else " " + word

    def _merged(self, part: str) -> bytes:
        """The ids of what the pattern leaves as one piece, by the vocabulary's merges alone."""
        if part.isascii():
            named = part.replace(" ", self.names[0x20]).replace("\n", self.names[0x0A])
        else:
            named = part.encode().decode("latin-1").translate(self.names)
        return array("I", [t.id for t in self.model.tokenize(named)]).tobytes()

    def _part(self, part: str) -> bytes:
        if (ids := self.parts.get(part)) is None:
            if (ids := self.older_parts.get(part)) is None:
                ids = self._merged(part)
            self.parts[part] = ids
        return ids

    def _cut(self, text: str) -> list[str]:
        """The pieces of a plain text."""
        return _BYTE_PIECES.findall(text) if self.keeps_space else _WORD_PIECES.findall(text.lower())

    def _plain_texts(self, texts: list[str]) -> list[bytes]:
        """Plain texts with single spaces and line feeds between words only.

        Arrow counts out the different words, and of these the different pieces; only pieces are looked up one by one.
        """
        if not texts:
            return []
        if self.keeps_space:
            spaced = ["\n" + t.replace("\n", " \n") for t in texts]  # a line feed before the first word, whose id goes again
        else:
            spaced = [t.lower().replace("\n", " ") for t in texts]
        words = pc.split_pattern(pa.array(spaced, pa.large_string()), " ")
        coded = words.flatten().dictionary_encode()
        # one string of the different words with tabs between them, cut into pieces at once
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(coded.dictionary)], pa.int32()), coded.dictionary.cast(pa.string())), "\t")[0].as_py()
        if self.keeps_space:  # words follow a space or begin with their line feed
            joined = (" " + joined.replace("\t", "\t ")).replace(" \n", "\n")
        pieces = (_BYTE_PIECES if self.keeps_space else _WORD_PIECES).findall(joined)
        places = {p: k for k, p in enumerate(dict.fromkeys(pieces))}
        code = np.fromiter(map(places.__getitem__, pieces), np.int64, len(pieces))
        of_words, ends = _gathered([self._part(p) if p != "\t" else b"" for p in places], code)
        cuts = np.flatnonzero(code == places.get("\t", -1))
        bounds = np.r_[0, ends[cuts], ends[-1]]
        out, ends = _gather(of_words, bounds[:-1], np.diff(bounds), coded.indices.to_numpy())
        texts_at = ends[words.offsets.to_numpy()].tolist()
        first = len(self._part("\n")) // 4 if self.keeps_space else 0
        return [out[a + first : b].tobytes() for a, b in zip(texts_at, texts_at[1:])]

    def _spaced_texts(self, texts: list[str]) -> list[bytes]:
        """Plain texts with runs of white space, piece by piece."""
        return [b"".join([self._part(p) for p in self._cut(t)]) for t in texts]

    def _learn(self, new: set) -> None:
        rest = []
        for word in new:
            if (ids := self.older.get(word)) is not None:
                self.cache[word] = ids
            elif isinstance(word, str) and word and _PLAIN_WORD.fullmatch(word):
                self.cache[word] = b"".join([self._part(p) for p in self._cut(self._piece(word))])
            else:
                rest.append(word)
        for word, found in zip(rest, self.tokenizer.encode_batch_fast([self._piece(w) for w in rest], add_special_tokens=False), strict=True):
            self.cache[word] = array("I", found.ids).tobytes()

    def _some(self, texts: list[str]) -> list[bytes]:
        if len(self.parts) > _MOST:
            self.older_parts, self.parts = self.parts, {}
        if len(self.cache) > _MOST:
            self.older, self.cache = self.cache, {}
        out: list[bytes] = [b""] * len(texts)
        plain, spaced, rest = [], [], []
        for k, text in enumerate(texts):
            if self.added.search(text):
                out[k] = array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
            else:
                (rest if not _PLAIN_TEXT.fullmatch(text) else spaced if _has_runs(text) else plain).append(k)
        for places, encode in ((plain, self._plain_texts), (spaced, self._spaced_texts), (rest, self._other_texts)):
            for k, ids in zip(places, encode([texts[k] for k in places]), strict=True):
                out[k] = ids
        return out

    def _other_texts(self, texts: list[str]) -> list[bytes]:
        split = [self._words(t) for t in texts]
        if new := set().union(*split).difference(self.cache):
            if self.keeps_space and (unsafe := {w for w in new if not isinstance(w, tuple) and w[-1:].isspace()} - self.unsafe):
                self.unsafe |= unsafe
                split = [self._words(t) for t in texts]
                new = set().union(*split).difference(self.cache)
            self._learn(new)
        ids = self.cache.__getitem__
        return [b"".join(map(ids, words)) for words in split]

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of each text, in order; works on about ``_CHARS`` characters at a time."""
        part, size = [], 0
        for text in texts:
            part.append(text)
            size += len(text)
            if size > _CHARS:
                yield from self._some(part)
                part, size = [], 0
        yield from self._some(part)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of this Python worker, kept from task to task."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
