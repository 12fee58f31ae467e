"""Cutting a text into units that a byte-level BPE tokenizer encodes independently of each other.

The tokenizer's own pattern never lets a piece run from a non-space into white space, so every such place is a safe
cut. A unit is a run of white space and the run of other characters after it.
"""

from __future__ import annotations

import os
import re
from array import array
from functools import cache

import numpy as np
import pyarrow as pa

from trackloom.llm.common import ASCII_WHITE

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Unicode's White_Space characters
WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_UNIT = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")
_DOUBLE = re.compile(f"[{WHITE}][ \n]")


def units(text: str) -> list[str]:
    if _DOUBLE.search(text):
        return _UNIT.findall(text)
    out: list[str] = []
    for i, line in enumerate(text.split("\n")):
        first, *rest = line.split(" ")
        if i:
            out.append("\n" + first)
        elif first:
            out.append(first)
        out += [" " + w for w in rest]
    return out


def tokenizer(definition: str):
    """A tokenizers.Tokenizer from its JSON text, without truncation and padding."""
    from tokenizers import Tokenizer

    t = Tokenizer.from_str(definition)
    t.no_truncation()
    t.no_padding()
    return t


def definition(path: str) -> str:
    """The tokenizer file's text; it is read on the driver and sent to the tasks, its size is the vocabulary's."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def pieces(t) -> list[bytes]:
    """The bytes each id stands for; b'' for unused ids."""
    # fixed values: the byte-level alphabet, printable Latin-1 bytes as themselves and the rest from code point 256
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printable]
    to_byte = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}
    out = [b""] * (max(t.get_vocab(with_added_tokens=True).values(), default=-1) + 1)
    for piece, k in t.get_vocab(with_added_tokens=True).items():
        out[k] = bytes(to_byte[c] for c in piece) if all(c in to_byte for c in piece) else piece.encode()
    return out


#: UTF-8 of the white space that is not ASCII; texts without it are cut bytewise
_WIDE_WHITE = re.compile(rb"\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80")


def segments(flat: bytes, bounds: np.ndarray) -> pa.BinaryArray:
    """The byte strings between neighbouring bounds, which cover `flat`, without a copy."""
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(flat)])


def byte_strings(column: pa.BinaryArray) -> list[bytes]:
    """The values of a column without nulls; sliced from its buffer, which is several times faster than `to_pylist`."""
    _, offsets, data = column.buffers()
    cuts = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1].tolist()
    raw = data.to_pybytes()
    return [raw[a:b] for a, b in zip(cuts, cuts[1:])]


_LETTER, _CLOSING = np.zeros(256, bool), np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_CLOSING[list(b".,;:!?")] = True
_INTO_CLOSING = re.compile("[A-Za-z][.,;:!?]")


class Cache:
    """Encodes texts by their distinct units; ids of units are kept for the life of a Python worker.

    A batch of texts is cut into units at once, its distinct units are looked up or encoded, and the ids go back to
    every place of a unit by index. Units are told apart by all their bytes. At most `most` units are kept; others are
    encoded again with the next batch. `plain`: special tokens' strings are ordinary text. A unit ends before closing
    punctuation too, `.,;:!?` between an ASCII letter and white space, so a word is one unit whatever follows it; a vocabulary with a piece
    or special token that runs from a letter into such a character is not cut there.
    """

    white = ASCII_WHITE
    letter, closing = _LETTER, _CLOSING

    def __init__(self, definition: str, most: int = 600_000, plain: bool = False):
        self.t, self.most, self.known = tokenizer(definition), most, {}
        self.t.encode_special_tokens = plain
        if any(_INTO_CLOSING.search(piece) for piece in self.t.get_vocab(with_added_tokens=True)):
            self.closing = None

    def _new(self, parts: list[bytes]) -> list[bytes]:
        """The ids of units that are not known, as little-endian 32-bit integers."""
        texts = [p.decode("utf-8", "surrogatepass") for p in parts]
        return [array("I", e.ids).tobytes() for e in self.t.encode_batch_fast(texts, add_special_tokens=False)]

    def _ids(self, parts: list[bytes]) -> list[bytes]:
        """The ids of distinct units as little-endian 32-bit integers."""
        got = list(map(self.known.get, parts))
        new = [i for i, g in enumerate(got) if g is None]
        for i, ids in zip(new, self._new([parts[i] for i in new])):
            got[i] = ids
        for i in new[: max(0, self.most - len(self.known))]:
            self.known[parts[i]] = got[i]
        return got

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        raw = [t.encode("utf-8", "surrogatepass") for t in texts]
        wide = {i for i, t in enumerate(raw) if _WIDE_WHITE.search(t)}
        ids, cuts = self.flat([b"" if i in wide else t for i, t in enumerate(raw)])
        out = [ids[a:b] for a, b in zip(cuts, cuts[1:])]
        for i in wide:
            parts = [u.encode("utf-8", "surrogatepass") for u in units(texts[i])]
            found = dict(zip(distinct := list(set(parts)), self._ids(distinct)))
            out[i] = np.frombuffer(b"".join([found[u] for u in parts]), "<u4")
        return out

    def flat(self, raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, first id of each text and the end): texts without wide white space."""
        joined = b"".join(raw)
        edges = np.concatenate([[0], np.cumsum([len(t) for t in raw])]).astype(np.int64)
        if not joined:
            return np.zeros(0, np.uint32), np.zeros(len(edges), np.int64)
        points = np.frombuffer(joined, np.uint8)
        white = self.white[points]
        opens = np.zeros(len(joined) + 1, bool)
        opens[1:-1] = white[1:] & ~white[:-1]
        if self.closing is not None:
            last = np.flatnonzero(opens[2:-1]) + 1  # the byte before a unit that is not the first
            opens[last[self.closing[points[last]] & self.letter[points[last - 1]]]] = True
        opens[edges] = True
        bounds = np.flatnonzero(opens)
        coded = segments(joined, bounds).dictionary_encode()
        unit = coded.indices.to_numpy()
        ids = self._ids(byte_strings(coded.dictionary))
        table = np.frombuffer(b"".join(ids), "<u4")
        size = np.array([len(i) // 4 for i in ids])
        begin = np.cumsum(size) - size
        many = size[unit]
        upto = np.cumsum(many)
        every = table[np.repeat(begin[unit] - (upto - many), many) + np.arange(int(upto[-1]))]
        return every, np.concatenate([[0], upto])[np.searchsorted(bounds[:-1], edges)]


@cache
def worker_cache(definition: str) -> Cache:
    return Cache(definition)
