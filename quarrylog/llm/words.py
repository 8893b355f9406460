"""Encoding texts by a table of distinct pieces: each piece goes through the tokenizers library once a
worker and its ids are joined back by position.

A piece table is right only where the tokenizer cannot see across the cuts. `ByteLevelPieces` and
`LowerWordPieces` say where that is proven; every other text (rare characters, special-token strings,
runs of white space) goes through the library whole, so the ids are the library's in all cases.
The tokenizer file is a parameter; nothing of it is kept here.
"""

from __future__ import annotations

import os
import re
import sys
from array import array

import numpy as np

from .common import kept

if sys.byteorder != "little" or array("I").itemsize != 4:
    raise ImportError("ids are kept as little-endian 32-bit words, which this machine doesn't have")



#: Bytes that numpy works on at once; its arrays take some 50 times as much.
STEP = 1 << 20
#: The sign for a space in byte-level vocabularies.
SPACE = "Ġ"


class PieceTable(dict):
    """piece -> its ids as little-endian unsigned 32-bit bytes."""

    #: Pieces a worker keeps; beyond, the table starts anew. It bounds memory, not results.
    LIMIT = 200_000

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        specials = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(specials)) if specials else None

    def whole(self, texts: list[str]) -> list[bytes]:
        out = []
        for at in range(0, len(texts), 20_000):
            out += [array("I", x.ids).tobytes() for x in self.tokenizer.encode_batch_fast(texts[at : at + 20_000], add_special_tokens=False)]
        return out

    def new(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces that aren't in the table."""
        return self.whole(pieces)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as the library gives them with add_special_tokens=False. `texts` is one bounded batch."""
        cuts = [self.cut(t) for t in texts]
        met = set().union(*filter(None, cuts))
        need = list(met.difference(self))
        if len(self) + len(need) > self.LIMIT:
            self.clear()
            need = list(met)
        self.update(zip(need, self.new(need), strict=True))
        unsure = [t for t, c in zip(texts, cuts, strict=True) if c is None]
        whole = iter(self.whole(unsure))
        return [next(whole) if c is None else b"".join(map(self.__getitem__, c)) for c in cuts]

    def is_special(self, text: str) -> bool:
        return self.special is not None and "<|" in text and self.special.search(text) is not None

    def cut(self, text: str) -> list[str] | None:
        """Pieces that encode alone as in the text; None if that isn't sure."""
        raise NotImplementedError


class HashTable:
    """64-bit hash -> number, by open addressing; many look-ups are one numpy step a probe."""

    BITS = 22

    def __init__(self):
        self.keys = np.zeros(1 << self.BITS, np.uint64)
        self.numbers = np.zeros(1 << self.BITS, np.int32)

    def _slots(self, h: np.ndarray) -> np.ndarray:
        return (h >> np.uint64(64 - self.BITS)).astype(np.int64)

    def find(self, h: np.ndarray) -> np.ndarray:
        """The number of each hash, -1 for unknown ones."""
        out = np.full(len(h), -1, np.int32)
        slot, at = self._slots(h), np.arange(len(h))
        while len(at):
            key = self.keys[slot]
            hit = key == h[at]
            out[at[hit]] = self.numbers[slot[hit]]
            on = ~hit & (key != 0)
            at, slot = at[on], (slot[on] + 1) & ((1 << self.BITS) - 1)
        return out

    def put(self, h: np.ndarray, numbers: np.ndarray) -> None:
        """Distinct hashes that aren't in the table."""
        slot, at = self._slots(h), np.arange(len(h))
        while len(at):
            free = np.flatnonzero(self.keys[slot] == 0)
            _, first = np.unique(slot[free], return_index=True)
            done = free[first]
            self.keys[slot[done]], self.numbers[slot[done]] = h[at[done]], numbers[at[done]]
            on = np.ones(len(at), bool)
            on[done] = False
            at, slot = at[on], (slot[on] + 1) & ((1 << self.BITS) - 1)


_rng = np.random.default_rng(20250301)
#: A random 64-bit value for every byte, odd powers for its place, and what mixes their sum.
BYTES, ODD, MIX = _rng.integers(1, 2**63, 256, dtype=np.uint64), np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


class ByteLevelPieces(PieceTable):
    """For byte-level BPE whose splitting rule puts one leading space to the word behind it.

    Cuts: in front of each single space, around each single line break, and in front of a full stop or
    comma that stands alone at a word's end. A token never spans them as long as no two white-space
    characters meet and the characters are of the plain sets below. The texts of a batch are cut, hashed, looked up
    and put together by numpy; only pieces that the table doesn't know become strings. Pieces are told apart by 64
    bits: a look-up among LIMIT pieces is wrong with a chance of 1e-13.
    """

    LIMIT = 2_000_000
    UNSURE = re.compile(r"[^\n\x20-\x7e\xa1-\xac\xae-ɏ‐-‧]|[ \n][ \n]")
    #: Stops that belong to a longer run of signs.
    IN_RUNS = re.compile(r"[^\w\s][.,][ \n]|_[.,][ \n]|[ \n][.,][ \n]")
    #: The same two tests for texts of Latin-1 characters: by bytes, and by classes of bytes.
    SURE = bytes([10, *range(0x20, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)])
    CLASSES = bytes(ord(" " if chr(c) in " \n" else "." if chr(c) in ".," else "a" if chr(c).isalnum() else "!") for c in range(256))

    def __init__(self, path: str):
        super().__init__(path)
        self.line = np.frombuffer(self.whole(["\n"])[0], "<u4")
        if len(self.line) != 1:
            raise ValueError("the line break has to be a token of its own")
        tried = ["a", "the", "Quarry", "zzyzx", "ANTIDISESTABLISHMENT", "antidisestablishment"]
        self.direct = [array("I", [t.id for t in self.tokenizer.model.tokenize(SPACE + w)]).tobytes() for w in tried] == self.whole([" " + w for w in tried])
        self.powers = np.ones(1, np.uint64)
        self.clear()

    def clear(self):
        self.hashes, self.n, self.used = HashTable(), 0, 0
        self.first, self.size, self.flat = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64), np.zeros(1 << 18, np.uint32)

    def runs_of(self, text: str) -> bool | None:
        """None if the text isn't sure to be cut rightly; else whether it has stops in longer runs of signs, which aren't cut off then."""
        if self.is_special(text):
            return None
        try:
            raw = text.encode("latin-1")
        except UnicodeEncodeError:
            return None if self.UNSURE.search(text) else self.IN_RUNS.search(text) is not None
        if raw.translate(None, self.SURE):
            return None
        raw = raw.translate(self.CLASSES)
        return None if b"  " in raw else b"!. " in raw or b".. " in raw or b" . " in raw

    def new(self, pieces: list[str]) -> list[bytes]:
        # Plain words go to the model itself, if it is known to take them as the whole tokenizer does.
        plain = [p for p in pieces if p[0] == " " and p[1:].isascii() and p[1:].isalpha()] if self.direct else []
        found = dict(zip(plain, (array("I", [t.id for t in self.tokenizer.model.tokenize(SPACE + p[1:])]).tobytes() for p in plain), strict=True))
        found["\n"], found[" "] = self.line.tobytes(), self.whole([" "])[0]
        rest = [p for p in pieces if p not in found]
        # The others many at once, one a line: a line break is a cut and its token stands for nothing else.
        for at in range(0, len(rest), 5000):
            parts = [rest[i : i + 500] for i in range(at, min(at + 5000, len(rest)), 500)]
            for part, e in zip(parts, self.tokenizer.encode_batch_fast(["\n".join([*part, ""]) for part in parts], add_special_tokens=False), strict=True):
                ids = np.array(e.ids, "<u4")
                ends = np.flatnonzero(ids == self.line[0]).tolist()
                found.update((p, ids[a + 1 : b].tobytes()) for p, a, b in zip(part, [-1, *ends[:-1]], ends, strict=True))
        return [found[p] for p in pieces]

    def _numbers(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The table's number of each piece, unknown ones encoded and put in."""
        length = end - start
        longest = int(length.max())
        if len(self.powers) <= longest:
            self.powers = np.multiply.accumulate(np.concatenate(([np.uint64(1)], np.full(2 * longest, ODD, np.uint64))))
        place = np.arange(len(data)) - np.repeat(start, np.diff(np.append(start, len(data))))
        h = np.add.reduceat(BYTES[data] * self.powers[np.minimum(place, longest)], start) + length.astype(np.uint64)
        h = (h ^ (h >> np.uint64(31))) * MIX
        h = (h ^ (h >> np.uint64(29))) | np.uint64(1)
        numbers = self.hashes.find(h)
        missing = np.flatnonzero(numbers < 0)
        if not len(missing):
            return numbers
        fresh, at, back = np.unique(h[missing], return_index=True, return_inverse=True)
        if self.n + len(fresh) > self.LIMIT and self.n:
            self.clear()
            return self._numbers(data, start, end)
        raw, at = data.tobytes(), missing[at]
        ids = self.new([raw[a:b].decode() for a, b in zip(start[at].tolist(), end[at].tolist(), strict=True)])
        flat = np.frombuffer(b"".join(ids), "<u4")
        size = np.array([len(x) // 4 for x in ids], np.int64)
        while self.n + len(fresh) > len(self.first):
            self.first, self.size = np.append(self.first, np.zeros_like(self.first)), np.append(self.size, np.zeros_like(self.size))
        while self.used + len(flat) > len(self.flat):
            self.flat = np.append(self.flat, np.zeros_like(self.flat))
        own = np.arange(self.n, self.n + len(fresh))
        self.first[own], self.size[own], self.flat[self.used : self.used + len(flat)] = self.used + np.cumsum(size) - size, size, flat
        self.hashes.put(fresh, own.astype(np.int32))
        self.n, self.used = self.n + len(fresh), self.used + len(flat)
        numbers[missing] = own[back]
        return numbers

    def encode(self, texts: list[str]) -> list[bytes]:
        runs = [self.runs_of(t) for t in texts]
        whole = iter(self.whole([t for t, r in zip(texts, runs, strict=True) if r is None]))
        cut = iter(self._in_steps([(t.encode(), r) for t, r in zip(texts, runs, strict=True) if r is not None]))
        return [next(whole) if r is None else next(cut) for r in runs]

    def _in_steps(self, raw: list[tuple[bytes, bool]]) -> list[bytes]:
        """Ids of texts that are sure to be cut rightly, some STEP bytes at once: a long text is cut at blanks."""
        out: list[list[bytes]] = [[] for _ in raw]
        held, size = [], 0

        def flush():
            nonlocal size
            for i, ids in zip([i for i, _, _ in held], self._cut([x for _, x, _ in held], [r for _, _, r in held]) if held else [], strict=True):
                out[i].append(ids)
            held.clear()
            size = 0

        for i, (data, r) in enumerate(raw):
            at = 0
            while at < len(data):
                end = at + STEP
                if end < len(data):
                    blank = data.rfind(b" ", at + 1, end)
                    blank = blank if blank > 0 else data.find(b" ", end)
                    end = blank if blank > 0 else len(data)
                part = data[at:end]
                at = end
                if size + len(part) > STEP:
                    flush()
                if len(part) > 2 * STEP:  # one word of that length
                    out[i].append(self.whole([part.decode()])[0])
                else:
                    held.append((i, part, r))
                    size += len(part)
        flush()
        return [b"".join(x) for x in out]

    def _cut(self, raw: list[bytes], runs: list[bool]) -> list[bytes]:
        """Ids of texts that are sure to be cut rightly and not empty."""
        data = np.frombuffer(b"\0".join([*raw, b""]), np.uint8)
        bounds = np.cumsum([0, *[len(x) + 1 for x in raw]])
        line, closing = data == 10, data == 0
        follows = np.append(data[1:], np.uint8(0))
        stop = (data == 44) & (follows == 32) | (data == 46) & ((follows == 32) | (follows == 10))
        for i in [i for i, r in enumerate(runs) if r]:
            stop[bounds[i] : bounds[i + 1]] = False
        begins = (data == 32) | line | stop | closing
        begins[1:] |= (line | closing)[:-1]
        begins[0] = True
        start = np.flatnonzero(begins)
        end = np.append(start[1:], len(data))
        numbers = np.full(len(start), -1, np.int32)
        piece = ~closing[start]
        # The closing zero of a text stays in the hashed bytes as a piece of its own, which has no ids.
        found = self._numbers_of(data, start, end, piece)
        numbers[piece] = found
        size = np.where(piece, self.size[numbers], 0)
        total = np.cumsum(size)
        first = np.where(piece, self.first[numbers], 0)
        ids = self.flat[np.repeat(first - (total - size), size) + np.arange(int(total[-1]))]
        ends = total[np.searchsorted(start, bounds[1:]) - 1]
        return [ids[a:b].tobytes() for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]

    def _numbers_of(self, data, start, end, piece) -> np.ndarray:
        """Numbers of the pieces only; zeros between texts are taken out before they are hashed."""
        keep = data != 0
        shift = np.cumsum(~keep)
        own = start[piece]
        return self._numbers(data[keep], own - shift[own], end[piece] - shift[own])


class LowerWordPieces(PieceTable):
    """For BPE over lower-cased words whose splitting rule drops white space: cuts at white space, and in front
    of a full stop or comma that stands alone at a word's end; words are lower-cased first.

    Unsure: characters whose normal form or lower case may depend on their neighbours, or whose class
    may differ between Unicode versions.
    """

    UNSURE = re.compile(r"[^\t\n\r\x20-\x7e\xa1-\xac\xae-įĲ-ɏ‐-‧]")
    IN_RUNS = ByteLevelPieces.IN_RUNS

    def cut(self, text):
        if self.UNSURE.search(text) or self.is_special(text):
            return None
        text = text.lower()
        if not self.IN_RUNS.search(text):
            text = text.replace(", ", " , ").replace(". ", " . ").replace(".\n", " . ")
        return text.split()


def table(kind: type, path: str) -> PieceTable:
    """One table a worker process, shared by its tasks."""
    return kept((kind.__name__, path), lambda: kind(path))
