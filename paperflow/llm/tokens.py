"""Token ids of a public word-level BPE file, with caches for chunks and pieces that come again.

A text is cut at spaces, line feeds and tabs, which this vocabulary drops; a chunk's ids never depend on its
neighbours, so they are looked up.  Chunks of plain printable Latin letters are cut by the vocabulary's own
pattern and go straight to its merge model; all others take the library's whole path.
"""

from __future__ import annotations

import array
import os
import sys
import weakref
from collections.abc import Callable

import regex

from .common import worker_table

CACHE_ENTRIES = 500_000
"""Of about 200 bytes each.  When half of them are new, they become the old half, which serves until the next time."""

LONGEST_CACHED = 64
_PIECE = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_letters() -> list[str]:
    """The usual byte-level alphabet: printable bytes stand for themselves, the others follow from 256 on."""
    kept = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in kept else chr(next(spare)) for b in range(256)]


def _packed(ids: list[int]) -> bytes:
    packed = array.array("I", ids)
    if sys.byteorder == "big":
        packed.byteswap()
    return packed.tobytes()


class _Known(dict):
    """Ids of chunks and pieces; a chunk that is asked for is learnt.  It does not keep the encoder alive, so that both go when the encoder's task ends."""

    def __init__(self, learn: Callable[[str], bytes]):
        super().__init__({"": b""})
        self.learn = weakref.WeakMethod(learn)

    def __missing__(self, chunk: str) -> bytes:
        found = self[chunk] = self.learn()(chunk)
        return found


class Encoder:
    """``ids(text)`` gives the ids as little-endian unsigned 32-bit numbers in one bytes object."""

    def __init__(self, path: str, cache_entries: int = CACHE_ENTRIES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        self.letters = _byte_letters()
        self.limit = cache_entries
        self.known, self.old, self.long = _Known(self._learnt), {}, []

    def _piece(self, piece: str) -> bytes:
        if piece.isascii():
            mapped = piece
        else:
            mapped = "".join([self.letters[b] for b in piece.encode()])
        return _packed([t.id for t in self.model.tokenize(mapped)])

    def _known(self, piece: str) -> bytes:
        if (found := self.known.get(piece)) is None:
            if (found := self.old.get(piece)) is None:
                found = self._piece(piece)
            if len(piece) <= LONGEST_CACHED:
                self.known[piece] = found
        return found

    def _chunk(self, chunk: str) -> bytes:
        if (chunk.isascii() or max(chunk) < "ɐ" and "İ" not in chunk) and chunk.isprintable() and "<|" not in chunk:
            low = chunk.lower()
            if low.isalpha():
                return self._known(low)
            if low[-1] in ",.!?" and low[:-1].isalpha():
                return self._known(low[:-1]) + self._known(low[-1])
            return b"".join(map(self._known, _PIECE.findall(low)))
        return _packed(self.whole.encode(chunk, add_special_tokens=False).ids)

    def _learnt(self, chunk: str) -> bytes:
        """Long chunks stay known until their text ends."""
        if len(chunk) > LONGEST_CACHED:
            self.long.append(chunk)
        elif (found := self.old.get(chunk)) is not None:
            return found
        return self._chunk(chunk)

    def ids(self, text: str) -> bytes:
        if len(self.known) > self.limit // 2:
            self.known, self.old = _Known(self._learnt), self.known
        ids = b"".join(map(self.known.__getitem__, text.replace("\n", " ").replace("\t", " ").split(" ")))
        while self.long:
            del self.known[self.long.pop()]
        return ids


def encoder(path: str, cache_entries: int = CACHE_ENTRIES) -> Encoder:
    """One encoder for each Python worker."""
    return worker_table("encoder", (path, cache_entries), lambda: Encoder(path, cache_entries))
