"""Byte-pair encoding of whole texts with a dictionary of units.

A token of the public word vocabulary never spans ASCII white space, nor the border between a run of
Latin letters and a run of plain punctuation, and letters count in lower case. So a text's ids are
the ids of its units in order, and units repeat far more often than texts. Text is taken apart in
arrays of bytes, each unit becomes a 64-bit hash, and a sorted table gives the ids of the units seen
so far. New units go to the tokenizer, many in one call; each ends with the only token of it that
carries the end-of-word mark. Pieces with anything but Latin letters and ASCII punctuation are one
unit up to the next white space. Vocabularies without such a mark encode whole texts directly.
"""

from __future__ import annotations

import numpy as np
from tokenizers import Tokenizer

UNITS = 1_500_000  # in the table; then it starts again
AT_ONCE = 4096  # new units in one call of the tokenizer
CHUNK = 1 << 19  # bytes taken apart at once
_MARK = "</w>"
_BASE = 0x9E3779B97F4A7C15 | 1

_SPACE, _LETTER, _SIGN, _OTHER = 0, 1, 2, 3
_CLASS = np.full(256, _OTHER, np.uint8)
_CLASS[[9, 10, 11, 12, 13, 32]] = _SPACE
_CLASS[[i for i in range(33, 127) if not chr(i).isalnum() and chr(i) != "'"]] = _SIGN
_CLASS[[i for i in range(128) if chr(i).isalpha()]] = _LETTER
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


_SHARED: dict[tuple[str, bool], "Encoder"] = {}


def shared_encoder(path: str, plain_specials: bool = False) -> Encoder:
    """One encoder for all tasks of a worker process, with what it has learnt."""
    key = path, plain_specials
    if key not in _SHARED:
        _SHARED.clear()
        _SHARED[key] = Encoder(path, plain_specials)
    return _SHARED[key]


def _powers(x: int, n: int) -> np.ndarray:
    out = np.full(n, x, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class Encoder:
    """Ids of texts as little-endian bytes of ``dtype``."""

    def __init__(self, path: str, plain_specials: bool = False):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain_specials
        vocabulary = self.tokenizer.get_vocab()
        self.dtype = np.dtype("<u2" if len(vocabulary) <= 1 << 16 else "<u4")
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith(_MARK)]] = True
        specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # without end-of-word marks and lower case, or with special tokens of another form, only whole texts can be encoded
        self.by_units = bool(self.ends.any()) and '"Lowercase"' in self.tokenizer.to_str()[:5000] and all(t.startswith("<|") for t in specials)
        self._forget()

    def _forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.at = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int32)
        self.pool = np.zeros(1 << 16, self.dtype)
        self.used = 0

    def _plain(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype)

    def _encode_units(self, units: list[str]) -> list[np.ndarray]:
        out: list[np.ndarray] = []
        if len(units) > AT_ONCE:
            return [x for i in range(0, len(units), AT_ONCE) for x in self._encode_units(units[i : i + AT_ONCE])]
        lines = [units[i : i + 256] for i in range(0, len(units), 256)]
        for part, e in zip(lines, self.tokenizer.encode_batch_fast([" ".join(x) for x in lines], add_special_tokens=False), strict=True):
            ids = np.array(e.ids, self.dtype)
            stops = np.flatnonzero(self.ends[ids]) + 1
            out += np.split(ids, stops[:-1]) if len(stops) == len(part) else [self._plain(u) for u in part]
        return out

    def _learn(self, keys: np.ndarray, simple: list[str], other: list[str], is_simple: np.ndarray) -> None:
        """keys: ascending; simple and other: their units, in order, by is_simple."""
        if len(self.keys) + len(keys) > UNITS:
            raise OverflowError
        a, b = iter(self._encode_units(simple)), iter([self._plain(u) for u in other])
        ids = [next(a) if s else next(b) for s in is_simple.tolist()]
        size = np.array([len(x) for x in ids], np.int32)
        flat = np.concatenate(ids)
        while self.used + len(flat) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        self.pool[self.used : self.used + len(flat)] = flat
        where = np.searchsorted(self.keys, keys)
        self.at = np.insert(self.at, where, self.used + np.cumsum(size) - size)
        self.size = np.insert(self.size, where, size)
        self.keys = np.insert(self.keys, where, keys)
        self.used += len(flat)

    def _chunk(self, data: bytes, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of data, and how many of them each text has. stops: where each text ends; white space follows."""
        b = np.frombuffer(data, np.uint8)
        n = len(b)
        kind, low = _CLASS[b], _LOWER[b]
        lead = np.flatnonzero(b[:-1] == 0xC3)
        if len(lead):
            trail = b[lead + 1]
            good = (trail != 0x97) & (trail != 0xB7)
            kind[lead[good]] = kind[lead[good] + 1] = _LETTER
            upper = lead[good & (trail <= 0x9E)] + 1
            low[upper] += 0x20
        kind[np.flatnonzero((b[:-1] == 0x3C) & (b[1:] == 0x7C))] = _OTHER  # special tokens begin so
        prev = np.concatenate(([np.uint8(_SPACE)], kind[:-1]))
        ink = kind != _SPACE
        first = np.flatnonzero(ink & (prev == _SPACE))
        last = np.flatnonzero(~ink & (prev != _SPACE))  # data ends with white space
        if not len(first):
            return np.zeros(0, self.dtype), np.zeros(len(stops), np.int64)
        odd = np.concatenate(([0], np.cumsum(kind == _OTHER)))
        mixed = odd[last] > odd[first]
        starts = np.flatnonzero(ink & (kind != prev))
        piece = np.searchsorted(first, starts, "right") - 1
        keep = ~mixed[piece] | (prev[starts] == _SPACE)
        starts, piece = starts[keep], piece[keep]
        ends = np.concatenate((starts[1:], [n]))
        ends = np.minimum(ends, last[piece])
        if len(_POWER[0]) <= n:
            size = max(2 * CHUNK, n + 1)
            _POWER[:] = [_powers(_BASE, size), _powers(pow(_BASE, -1, 1 << 64), size)]
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum((low.astype(np.uint64) + np.uint64(1)) * _POWER[0][:n])))
        h = (total[ends] - total[starts]) * _POWER[1][starts]
        h ^= (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        by = np.argsort(h)
        ordered = h[by]
        new = np.concatenate(([True], ordered[1:] != ordered[:-1]))
        keys, one = ordered[new], by[new]
        slot = np.empty(len(h), np.int64)
        slot[by] = np.cumsum(new) - 1
        lack = self._lacking(keys)
        if len(lack):
            text, is_simple = low.tobytes(), ~mixed[piece[one[lack]]]
            units = [text[i:j].decode("utf-8", "replace") for i, j in zip(starts[one[lack]].tolist(), ends[one[lack]].tolist(), strict=True)]
            simple = [u for u, s in zip(units, is_simple.tolist(), strict=True) if s]
            other = [u for u, s in zip(units, is_simple.tolist(), strict=True) if not s]
            try:
                self._learn(keys[lack], simple, other, is_simple)
            except OverflowError:
                self._forget()
                return self._chunk(data, stops)
        where = np.searchsorted(self.keys, keys)
        at, size = self.at[where][slot], self.size[where][slot].astype(np.int64)
        before = np.cumsum(size) - size
        ids = self.pool[np.repeat(at - before, size) + np.arange(int(size.sum()))]
        upto = np.concatenate(([0], np.cumsum(size)))[np.searchsorted(starts, stops)]
        return ids, np.diff(upto, prepend=0)

    def _lacking(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.arange(len(keys))
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.flatnonzero(self.keys[at] != keys)

    def encode(self, texts: list[bytes | None], end_id: int | None = None) -> list[bytes]:
        tail = b"" if end_id is None else np.array([end_id], self.dtype).tobytes()
        if not self.by_units:
            return [self._plain((t or b"").decode("utf-8", "replace")).tobytes() + tail for t in texts]
        out: list[bytes] = []
        held: list[bytes] = []
        size = 0

        def flush() -> None:
            nonlocal size
            if held:
                stops = np.cumsum([len(t) + 1 for t in held]) - 1
                ids, counts = self._chunk(b"\n".join(held) + b"\n", stops)
                data, width = ids.tobytes(), self.dtype.itemsize
                cut = (np.cumsum(counts) * width).tolist()
                out.extend(data[i:j] + tail for i, j in zip([0, *cut], cut))
            held.clear()
            size = 0

        for t in texts:
            t = t or b""
            if len(t) > 2 * CHUNK:  # in parts that end at white space
                flush()
                out.append(b"".join(self._chunk(x + b"\n", np.array([len(x)]))[0].tobytes() for x in _parts(t)) + tail)
                continue
            held.append(t)
            size += len(t)
            if size > CHUNK:
                flush()
        flush()
        return out


_POWER: list[np.ndarray] = [np.zeros(0, np.uint64), np.zeros(0, np.uint64)]


def _parts(text: bytes) -> list[bytes]:
    """Slices of up to ``CHUNK`` bytes, longer only where there is no white space."""
    out, at = [], 0
    while at < len(text):
        stop = at + CHUNK
        if stop < len(text):
            cut = max(text.rfind(c, at, stop) for c in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c"))
            if cut <= at:
                cut = min([x for x in (text.find(c, stop) for c in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c")) if x >= 0], default=len(text))
            stop = cut
        out.append(text[at:stop])
        at = stop if stop > at else len(text)
    return out
