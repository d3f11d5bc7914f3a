"""Token ids of whole texts by a public tokenizer, with a bounded memory of pieces."""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterable

import numpy as np

#: Pieces and parts of pieces that a worker remembers, together: the first it meets, the frequent ones.
MEMORY = 1_000_000
_SPLIT = re.compile(r"(?<=\S) (?=\S)")
# A word of Latin letters, then marks, line feeds and words that every pattern here keeps apart.
_LATIN = "A-Za-zÀ-ÖØ-öø-ÿ"
_MARKS = r".,;:!?#$%&*+=/()\-"
_SIMPLE = re.compile(rf" ?[{_LATIN}]+(?:[{_MARKS}]+|\n(?!\n)|(?<=[{_MARKS}\n])[{_LATIN}]+)*")
_PARTS = re.compile(rf" ?[{_LATIN}]+|[{_MARKS}]+|\n")
_PAIRS = ("  ", "\n\n", " \n", "\n ")
_EDGES = ("", " ", "\n")
_OTHER_SPACE = "\t\v\f\r\x1c\x1d\x1e\x1f"
#: The usual piece after a space: a word, and marks or none.
_MARKED = re.compile(rf"([{_LATIN}]+)([{_MARKS}]*)").fullmatch


def _alone(text: str) -> bool:
    """All white space stands alone and inside, and is a space or a line feed."""
    if any(map(text.__contains__, _PAIRS)) or text[:1] in _EDGES or text[-1:] in _EDGES:
        return False
    if text.isascii():
        return not any(map(text.__contains__, _OTHER_SPACE))
    return text.count(" ") + text.count("\n") + 1 == len(text.split())


def _byte_letters() -> list[str]:
    """The printable character that byte-level vocabularies use for each byte."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


LETTERS = _byte_letters()


class Encoder:
    """Encodes texts exactly as the library does, piece by piece.

    A single space between two characters that are no space always separates
    what the tokenizers here merge, so the pieces between such spaces are
    encoded once and remembered. ``style`` names the form of a plain word in
    the vocabulary, for which the model is asked directly: ``byte`` (a leading
    space belongs to the word), ``word`` (lower case, no space), None (never).
    Strings of special tokens in a text are ordinary text.
    """

    def __init__(self, path: str, style: str | None = None):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.model, self.style = self.tokenizer.model, style
        # Pieces after a space, by what follows the space; parts as they are.
        self.after_space: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}

    def _word(self, word: str, space: bool) -> bytes:
        """A word of Latin letters, with or without a space before it, by the model alone."""
        if self.style == "word":
            word = word.lower()
        if not word.isascii():
            word = "".join(map(LETTERS.__getitem__, word.encode()))
        if space and self.style == "byte":
            word = LETTERS[32] + word
        return array("I", [t.id for t in self.model.tokenize(word)]).tobytes()

    def _part(self, part: str) -> bytes:
        """A word with or without a space before it, or marks, or a line feed."""
        known = self.parts.get(part)
        if known is not None:
            return known
        word = part[1:] if part[0] == " " else part
        ids = self._word(word, word is not part) if word.isalpha() else self._whole(part)
        if len(self.parts) + len(self.after_space) < MEMORY:
            self.parts[part] = ids
        return ids

    def _whole(self, text: str) -> bytes:
        encoded = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0]
        return array("I", encoded.ids).tobytes()

    def _piece(self, piece: str) -> bytes:
        if self.style is not None and _SIMPLE.fullmatch(piece):
            return b"".join(map(self._part, _PARTS.findall(piece)))
        return self._whole(piece) if piece else b""

    def _new(self, piece: str) -> bytes:
        """A piece that is not remembered, without the space before it."""
        plain = self.style is not None and piece.isascii() and piece.isalpha()
        marked = _MARKED(piece) if self.style is not None and not plain else None
        if plain:
            ids = self._word(piece, True)
        elif marked is None:
            ids = self._piece(" " + piece)
        else:
            word, marks = marked.groups()
            ids = self.after_space.get(word) if marks else None
            if ids is None:
                ids = self._word(word, True)
                if marks and len(self.parts) + len(self.after_space) < MEMORY:
                    self.after_space[word] = ids
            if marks:
                ids += self._part(marks)
        if len(self.parts) + len(self.after_space) < MEMORY:
            self.after_space[piece] = ids
        return ids

    def _encode(self, text: str) -> bytes:
        rest = text.split(" ") if _alone(text) else _SPLIT.split(text)
        first, rest = rest[0], rest[1:]
        ids, at = list(map(self.after_space.get, rest)), -1
        for _ in range(ids.count(None)):
            at = ids.index(None, at + 1)
            ids[at] = self._new(rest[at])
        return self._piece(first) + b"".join(ids)

    def encode(self, texts: Iterable[str | None]) -> list[np.ndarray]:
        """Ids of each text as uint32; null counts as empty."""
        return [np.frombuffer(self._encode(text or ""), np.uint32) for text in texts]


def encoder(path: str, style: str | None = None) -> Encoder:
    """The worker's encoder for a vocabulary; it outlives the task with its memory."""
    import tokenizers

    kept = tokenizers.__dict__.setdefault("_kept_encoders", {})
    if (path, style) not in kept:
        kept[path, style] = Encoder(path, style)
    return kept[path, style]


def pieces_of(frame, rows: int = 512):
    """Slices of a batch, so that ids of few texts are in memory at a time."""
    for i in range(0, len(frame), rows):
        yield frame.iloc[i : i + rows]
