"""Batch encoding with the public tokenizer files.

Both vocabularies cut a text into pieces by a pattern and encode each piece by itself, so a piece
always has the same ids. A worker therefore asks the library once for each distinct piece and
keeps the answer; texts outside the plain Latin range, or with the text of an added token,
go through the library whole.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator

import numpy as np

_L, _N = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe"
_SAFE = re.compile("[\t\n\r\x20-\x7e\xa1-\xff]*")
_PIECES = {
    "byte_bpe_50k.json": re.compile(rf" ?[{_L}]+| ?[{_N}]+|'(?:[stmd]|re|ve|ll)| ?[^\s{_L}{_N}]+|\s+(?!\S)|\s+"),
    "word_bpe_49k.json": re.compile(rf"[{_L}]+|[{_N}]|'(?:[stmd]|re|ve|ll)|[^\s{_L}{_N}]+"),
}
#: Pieces that one worker keeps; beyond it the memory starts anew, which costs time only.
KEEP = 600_000
#: Characters encoded at a time.
CHUNK = 1_000_000


class _Pieces(dict):
    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, piece: str) -> int:
        self[piece] = n = len(self) + 1  # 0 is the end of a document
        self.new.append(piece)
        return n


class Encoder:
    """Ids of many texts at once, each text followed by ``end``."""

    def __init__(self, path: str, end: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.end, self.lower = end, "word_bpe" in os.path.basename(path)
        self.pattern = _PIECES.get(os.path.basename(path))
        self.added = [t.content for t in self.library.get_added_tokens_decoder().values()]
        ids = self.library.get_vocab(with_added_tokens=False)
        if self.lower:  # the last id of a piece, and no other, ends a word
            self.last = np.zeros(max(ids.values()) + 1, np.bool_)
            self.last[[i for token, i in ids.items() if token.endswith("</w>")]] = True
        self.line = ids.get("\u010a")
        self._reset()

    def _reset(self) -> None:
        self.pieces = _Pieces()
        self.flat, self.used = np.empty(1 << 20, np.uint32), 1
        self.start, self.size = np.zeros(1 << 19, np.int64), np.zeros(1 << 19, np.int32)
        self.flat[0], self.size[0] = self.end, 1

    def _plain(self, text: str) -> bool:
        return self.pattern is not None and _SAFE.fullmatch(text) is not None and not ("<|" in text and any(a in text for a in self.added))

    def _ask(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and sizes of distinct pieces, from few calls: pieces are joined by white space,
        which is dropped by one vocabulary and is a piece and an id of its own in the other."""
        parts, sizes, joint = [], [], []
        for a in range(0, len(pieces), 4096):
            some = pieces[a : a + 4096]
            if self.lower:
                ids = np.array(self.library.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, np.uint32)
                ends = np.flatnonzero(self.last[ids]) + 1
                joint = np.diff(ends, prepend=0)
            else:
                ids = np.array(self.library.encode_batch_fast(["\n".join(some) + "\n"], add_special_tokens=False)[0].ids, np.uint32)
                breaks = np.flatnonzero(ids == self.line)
                joint = np.diff(breaks, prepend=-1) - 1
                ids = np.delete(ids, breaks)
            if len(joint) != len(some) or not joint.all():  # some piece has white space of its own
                each = [e.ids for e in self.library.encode_batch_fast(some, add_special_tokens=False)]
                joint = np.fromiter(map(len, each), np.int64, len(each))
                ids = np.array([i for x in each for i in x], np.uint32)
            parts.append(ids)
            sizes.append(joint)
        return np.concatenate(parts), np.concatenate(sizes)

    def _learn(self, first: int, pieces: list[str]) -> None:
        blank = [p for p in pieces if p.isspace()]  # ambiguous between others, and few
        if blank:
            order = {p: i for i, p in enumerate(pieces)}
            rest = [p for p in pieces if not p.isspace()]
            got = [self._ask(x) for x in (rest, blank) if x]
            flat, size = np.concatenate([g[0] for g in got]), np.concatenate([g[1] for g in got])
            back = np.argsort(np.fromiter((order[p] for p in rest + blank), np.int64, len(pieces)))
            start = (np.cumsum(size) - size)[back]
            size = size[back]
        else:
            flat, size = self._ask(pieces)
            start = np.cumsum(size) - size
        while self.used + len(flat) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.empty_like(self.flat)])
        while first + len(pieces) > len(self.size):
            self.start, self.size = (np.concatenate([x, np.zeros_like(x)]) for x in (self.start, self.size))
        self.flat[self.used : self.used + len(flat)] = flat
        self.size[first : first + len(pieces)] = size
        self.start[first : first + len(pieces)] = self.used + start
        self.used += len(flat)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in one array, and each text's number of ids, its end id included."""
        if len(self.pieces) > KEEP:
            self._reset()
        at, ends, whole = array("l"), np.empty(len(texts), np.int64), []
        get, find, first = self.pieces.__getitem__, self.pattern and self.pattern.findall, len(self.pieces) + 1
        for i, text in enumerate(texts):
            if self._plain(text):
                at.extend(map(get, find(text.lower() if self.lower else text)))
            else:
                whole.append((len(at), text))
                at.append(0)
            at.append(0)
            ends[i] = len(at)
        if self.pieces.new:
            self._learn(first, self.pieces.new)
            self.pieces.new.clear()
        index = np.frombuffer(at, np.int64).copy()
        sizes, starts = self.size[index], self.start[index]
        extra = [np.array(self.library.encode(t, add_special_tokens=False).ids, np.uint32) for _, t in whole]
        flat = self.flat
        if whole:
            flat, place = np.concatenate([flat[: self.used], *extra]), self.used
            for (k, _), x in zip(whole, extra, strict=True):
                starts[k], sizes[k], place = place, len(x), place + len(x)
        total = np.cumsum(sizes, dtype=np.int64)
        ids = flat[np.repeat(starts - (total - sizes), sizes) + np.arange(total[-1] if len(total) else 0)]
        return ids, np.diff(total[ends - 1], prepend=0)

    def chunks(self, texts: list[str]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(first text, text after the last, ids, sizes) over pieces of some ``CHUNK`` characters."""
        a = n = 0
        for b, text in enumerate(texts):
            n += len(text)
            if n >= CHUNK:
                yield a, b + 1, *self.encode(texts[a : b + 1])
                a, n = b + 1, 0
        if a < len(texts):
            yield a, len(texts), *self.encode(texts[a:])


_encoders: dict[tuple[str, int], Encoder] = {}


def encoder(path: str, end: int) -> Encoder:
    """The worker's encoder for a file; Python workers are reused, so it outlives a task."""
    if (path, end) not in _encoders:
        _encoders[path, end] = Encoder(path, end)
    return _encoders[path, end]
