"""Token ids of whole texts by a public tokenizer's file, one encoding for each distinct part.

A byte-level BPE splits a text by a fixed pattern and encodes the parts one by one, so a part's
ids can be kept and used again.  Parts are found and looked up on whole blocks of code points;
only parts that are new to a worker reach the tokenizer's merges.  A part is looked up by hash and then
compared with the stored one byte by byte; texts with a part that differs, or with characters on
whose class engines could differ by Unicode version, are encoded whole, and so are all texts if the
tokenizer's file asks for anything but that pattern and merges.
"""

from __future__ import annotations

import os
from itertools import chain

import numpy as np

from . import _text as t

#: Parts whose ids are kept in a worker; then half of them at most stay, those met in most blocks.
STORE = 300_000
#: Code points whose class every engine agrees on: Latin to Cyrillic, general punctuation,
#: currency, kana, common Han and Hangul (first and last of each range).
_PLAIN = ((0x00, 0x1B), (0x20, 0x36F), (0x386, 0x38A), (0x38E, 0x3A1), (0x3A3, 0x481), (0x48A, 0x513), (0x2010, 0x2027), (0x2030, 0x205E), (0x20A0, 0x20B5), (0x3041, 0x3096), (0x30A1, 0x30FA), (0x4E00, 0x9FA5), (0xAC00, 0xD7A3))
_SPACE, _LETTER, _NUMBER, _OTHER = range(4)
_encoders: dict[str, Encoder] = {}


def default_path() -> str:
    """The file of the 50,257-id byte-level vocabulary, where the box has the tokenizers."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Class, and whether a text must be encoded whole, of each code point of the BMP."""
    import regex

    kind, odd = np.full(1 << 16, _OTHER, np.uint8), np.ones(1 << 16, bool)
    for low, high in _PLAIN:
        odd[low : high + 1] = False
        for code in range(low, high + 1):
            c = chr(code)
            kind[code] = _LETTER if regex.match(r"\p{L}", c) else _NUMBER if regex.match(r"\p{N}", c) else _SPACE if regex.match(r"\s", c) else _OTHER
    return kind, odd


def _spread(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places of spans, one span after the other."""
    upto = np.cumsum(size)
    return np.repeat(first - upto + size, size) + np.arange(upto[-1] if len(upto) else 0)


def _byte_characters() -> np.ndarray:
    """The character by which a byte-level vocabulary writes each byte."""
    from tokenizers.pre_tokenizers import ByteLevel

    alphabet = np.array(sorted(map(ord, ByteLevel.alphabet())), np.uint32)
    out = np.zeros(256, "<u4")
    own = alphabet[alphabet < 256]
    out[own] = own
    out[out == 0] = alphabet[alphabet >= 256]
    return out


class _Grown:
    """An array that grows in place: it has twice the room whenever that runs out, and 8 spare values."""

    def __init__(self, kind):
        self.data, self.n = np.zeros(1024, kind), 0

    def add(self, values: np.ndarray) -> None:
        if self.n + len(values) + 8 > len(self.data):
            self.data = np.concatenate([self.data[: self.n], np.zeros(self.n + 2 * len(values) + 1024, self.data.dtype)])
        self.data[self.n : self.n + len(values)] = values
        self.n += len(values)


class Encoder:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.kind, self.odd = _tables()
        self.merges, self.characters = self._merges(), _byte_characters()
        self.keys, self.slot = np.zeros(0, np.uint64), np.zeros(0, np.int64)  # sorted, and where the others have them
        self.at, self.size, self.first, self.long, self.met = (_Grown(np.int64) for _ in range(5))  # met: in how many blocks
        self.pool, self.bytes = _Grown(np.uint32), _Grown(np.uint8)

    def _merges(self):
        """The tokenizer's merges, if they are all that it does to a part of ``_starts``; else None."""
        from tokenizers import models, pre_tokenizers

        tokenizer, split, model = self.tokenizer, self.tokenizer.pre_tokenizer, self.tokenizer.model
        plain = isinstance(split, pre_tokenizers.ByteLevel) and split.use_regex and not split.add_prefix_space
        plain &= isinstance(model, models.BPE) and not model.dropout and tokenizer.normalizer is None
        plain &= tokenizer.truncation is None and tokenizer.padding is None
        plain &= all(x.special for x in tokenizer.get_added_tokens_decoder().values())
        return model.tokenize if plain else None

    def _make_room(self) -> None:
        """Parts that were met in one block only go, and of the others those met least, beyond half the store."""
        met = self.met.data[: self.met.n]
        kept = np.sort(np.argsort(-met, kind="stable")[: min(STORE // 2, np.count_nonzero(met > 1))])
        moved = np.full(len(met), -1)
        moved[kept] = np.arange(len(kept))
        slot = moved[self.slot]
        self.keys, self.slot = self.keys[slot >= 0], slot[slot >= 0]
        at, size, first, long = (x.data[kept] for x in (self.at, self.size, self.first, self.long))
        pool, data = self.pool.data[_spread(at, size)], self.bytes.data[_spread(first, long)]
        self.at, self.size, self.first, self.long, self.met = (_Grown(np.int64) for _ in range(5))
        self.pool, self.bytes = _Grown(np.uint32), _Grown(np.uint8)
        self._store(pool, size, data, long, met[kept] // 2)

    def _store(self, ids: np.ndarray, size: np.ndarray, data: np.ndarray, long: np.ndarray, met: np.ndarray) -> None:
        """Puts parts in: their ids and bytes end to end, and how many each has."""
        at, first = self.pool.n + np.cumsum(size) - size, self.bytes.n + np.cumsum(long) - long
        for store, values in ((self.at, at), (self.size, size), (self.first, first), (self.long, long), (self.met, met), (self.pool, ids), (self.bytes, data)):
            store.add(values)

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x.ids, np.uint32) for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _parts(self, data: np.ndarray, long: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of parts whose bytes lie end to end, and how many each has."""
        text, stop = self.characters[data].tobytes().decode("utf-32-le"), np.cumsum(long)
        ids = [[x.id for x in self.merges(text[i:j])] for i, j in zip((stop - long).tolist(), stop.tolist(), strict=True)]
        size = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter(chain.from_iterable(ids), np.uint32, int(size.sum())), size

    def _starts(self, code: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where the parts start: letters, numbers or other characters, each with one space
        before them; white space up to there; and English contractions."""
        kind, n = self.kind[code], len(code)
        edge = np.zeros(n + 1, bool)
        edge[at] = True
        turn = edge[:n].copy()
        turn[1:] |= kind[1:] != kind[:-1]
        first = np.flatnonzero(turn)
        stop = np.append(first[1:], n)
        blank = kind[first] == _SPACE
        start = np.zeros(n + 1, bool)
        start[first[blank]] = True
        start[stop[blank & ~edge[stop]] - 1] = True  # white space leaves its last character
        solid = first[~blank]
        start[solid[edge[solid] | (code[solid - 1] != 0x20)]] = True
        q = first[(stop - first == 1) & (code[first] == 0x27)]
        q = q[start[q] & (q + 1 < n)]
        q = q[~edge[q + 1]]
        ahead = np.append(code, np.zeros(2, code.dtype))
        one, two = ahead[q + 1], np.where(edge[np.minimum(q + 2, n)], 0, ahead[q + 2])
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = ((one == ord("r")) & (two == ord("e"))) | ((one == ord("v")) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
        for chosen, size in ((q[short], 2), (q[long], 3)):
            start[chosen + 1] = False
            start[chosen + size] = True
        return np.flatnonzero(start[:n])

    def encode(self, block: t.Block) -> list[np.ndarray]:
        """The ids of each document of a block."""
        if not len(block.data):
            return [np.zeros(0, np.uint32)] * block.rows
        if not self.merges:
            return self._whole([block.data[a:b].tobytes().decode() for a, b in zip(block.at[:-1].tolist(), block.at[1:].tolist(), strict=True)])
        text = block.data.tobytes().decode()
        code = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        head = np.flatnonzero((block.data & 0xC0) != 0x80)
        at = np.searchsorted(head, block.at)
        odd = code > 0xFFFF
        code16 = np.where(odd, 0xFFFF, code)
        odd |= self.odd[code16]
        start = self._starts(code16, at)
        first = head[start]
        long = np.diff(first, append=len(block.data))
        unique, sample, which = np.unique(t.span_hash(block.data, first, first + long), return_index=True, return_inverse=True)
        place = self._place(unique, block.data, first[sample], long[sample])
        odd[start] |= ~t.equal_spans(block.data, first, long, self.bytes.data, self.first.data[place][which], self.long.data[place][which], padded=True)
        strange = t.per_row(odd, at) > 0
        size = self.size.data[place][which]
        upto = np.zeros(len(size) + 1, np.int64)
        np.cumsum(size, out=upto[1:])
        ids = self.pool.data[_spread(self.at.data[place][which], size)]
        cut = upto[np.searchsorted(start, at)].tolist()
        out = [ids[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)]
        again = np.flatnonzero(strange).tolist()
        for i, own in zip(again, self._whole([text[at[i] : at[i + 1]] for i in again]) if again else [], strict=True):
            out[i] = own
        return out

    def _place(self, unique: np.ndarray, data: np.ndarray, first: np.ndarray, long: np.ndarray) -> np.ndarray:
        """Where the store has each part; new ones are encoded and put in."""
        place, found = self._find(unique)
        if not found.all():
            if len(self.keys) + np.count_nonzero(~found) > STORE:
                self._make_room()
                place, found = self._find(unique)
            new = np.flatnonzero(~found)
            own = data[_spread(first[new], long[new])]
            ids, size = self._parts(own, long[new])
            slot = self.at.n + np.arange(len(new))
            self.keys, self.slot = np.insert(self.keys, place[new], unique[new]), np.insert(self.slot, place[new], slot)
            self._store(ids, size, own, long[new], np.zeros(len(new), np.int64))
            place = np.searchsorted(self.keys, unique)
        self.met.data[self.slot[place]] += 1
        return self.slot[place]

    def _find(self, unique: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where parts are, or belong, in the order of the store's keys, and whether they are there."""
        place = np.searchsorted(self.keys, unique)
        found = place < len(self.keys)
        found[found] = self.keys[place[found]] == unique[found]
        return place, found


def encoder(path: str) -> Encoder:
    """One encoder for each worker process, with what it has stored."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
