"""Ids of whole texts by public vocabularies: byte-level BPE, and BPE over pieces.

Both vocabularies begin a new token at a space that follows a non-space, so a text cut there
encodes to the ids of its parts in a row (a part: a word with the spaces before it). Each distinct
part is encoded once and looked up after that, in numpy tables; only parts not seen yet cross into
Python. Texts with white space beyond ASCII, where the rule could differ, are encoded as they are.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from lakestar.llm import words as W

VOCABULARY = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"
HELD = 1_000_000  # parts that a worker remembers before it starts anew; a matter of speed, not of results
SLICE = 2 << 20
TOGETHER = 2_000  # new parts that are encoded as one text
_JOINT = np.zeros(256, bool)  # bytes after which a space does not cut
_JOINT[[0x20, *range(0x09, 0x0E), *range(0x1C, 0x20)]] = True
_WIDE_SPACE = r"[\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_loaded: dict[tuple[type, str], Coder] = {}


def vocabulary(name: str = VOCABULARY) -> str:
    """The path of a public vocabulary; a name with a slash is a path already."""
    if "/" in name:
        return name
    import public_tokenizers

    return str(public_tokenizers.path(name))


def spread(values: np.ndarray, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs values[first:first + size] one after another, and where each begins (one more for the end)."""
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    return values[np.arange(total) + np.repeat(first - (ends - size), size)], np.r_[0, ends]


class Known:
    """Parts seen so far with their ids: hashes in order, bytes to confirm a match, ids in one row."""

    def __init__(self):
        self.hash, self.entry = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.bytes, self.byte_off = np.zeros(0, np.uint8), np.zeros(1, np.int64)
        self.ids, self.id_off = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def find(self, buf: np.ndarray, off: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """The entry of each part, or -1. A hash that agrees counts only if all bytes do."""
        found = np.full(len(hashes), -1, np.int64)
        if not len(self.hash) or not len(hashes):
            return found
        at = np.minimum(np.searchsorted(self.hash, hashes), len(self.hash) - 1)
        maybe = np.flatnonzero(self.hash[at] == hashes)
        entry = self.entry[at[maybe]]
        size = np.diff(off)
        same = np.diff(self.byte_off)[entry] == size[maybe]
        maybe, entry = maybe[same], entry[same]
        if len(maybe):
            n = size[maybe]
            own, first = spread(buf, off[maybe], n)
            held, _ = spread(self.bytes, self.byte_off[entry], n)
            equal = np.logical_and.reduceat(own == held, first[:-1])
            found[maybe[equal]] = entry[equal]
        return found

    def add(self, buf: np.ndarray, size: np.ndarray, hashes: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> None:
        new = np.arange(len(self.byte_off) - 1, len(self.byte_off) - 1 + len(size), dtype=np.int32)
        self.bytes, self.ids = np.concatenate([self.bytes, buf]), np.concatenate([self.ids, ids])
        self.byte_off = np.r_[self.byte_off, self.byte_off[-1] + np.cumsum(size)]
        self.id_off = np.r_[self.id_off, self.id_off[-1] + np.cumsum(counts)]
        order = np.argsort(hashes, kind="stable")
        at = np.searchsorted(self.hash, hashes[order])
        self.hash, self.entry = np.insert(self.hash, at, hashes[order]), np.insert(self.entry, at, new[order])


class Coder:
    """Encodes texts part by part; ``fresh`` gives the ids of parts not met before."""

    def __init__(self):
        self.known = Known()

    def fresh(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the parts in a row, and how many each has."""
        raise NotImplementedError

    def whole(self, text: str) -> list[int]:
        raise NotImplementedError

    def distinct(self, parts: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of distinct parts in a row, and where each part's begin (one more for the end)."""
        if len(self.known.hash) > HELD:
            self.known = Known()
        buf, off = W.raw(parts)
        hashes = W.Words(buf, off, off[:-1], off[1:], off).hashes(cased=True)
        found = self.known.find(buf, off, hashes)
        new = np.flatnonzero(found < 0)
        if len(new):
            size = np.diff(off)[new]
            ids, counts = self.fresh(parts.take(pa.array(new)).to_pylist())
            found[new] = len(self.known.byte_off) - 1 + np.arange(len(new))
            self.known.add(spread(buf, off[new], size)[0], size, hashes[new], ids, counts)
        k = self.known
        return spread(k.ids, k.id_off[found], k.id_off[found + 1] - k.id_off[found])

    def encode(self, texts: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row (unsigned 32 bits), and where each text's begin (one more for the end)."""
        buf, off = W.raw(texts)
        cut = np.zeros(len(buf) + 1, bool)
        cut[1:-1] = (buf[1:] == 0x20) & ~_JOINT[buf[:-1]]
        wide = np.flatnonzero(pc.match_substring_regex(texts, _WIDE_SPACE).to_numpy(zero_copy_only=False))
        for i in wide:
            cut[off[i]:off[i + 1]] = False
        cut[off] = True
        at = np.flatnonzero(cut).astype(np.int64)
        parts = pa.LargeStringArray.from_buffers(len(at) - 1, pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(buf)))
        coded = pc.dictionary_encode(parts)
        flat, first = self.distinct(coded.dictionary)
        of = coded.indices.to_numpy()
        out, ends = spread(flat, first[:-1][of], np.diff(first)[of])
        return out, ends[np.searchsorted(at, off)]


def _listed(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    counts = np.fromiter(map(len, ids), np.int64, len(ids))
    return np.fromiter((x for one in ids for x in one), np.uint32, int(counts.sum())), counts


def byte_alphabet() -> dict[str, int]:
    """The character that byte-level vocabularies write for each byte: itself if printable, else one from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [x for x in range(256) if x not in set(plain)]
    return {chr(x): x for x in plain} | {chr(256 + k): x for k, x in enumerate(other)}


class Bpe(Coder):
    """Byte-level BPE of the tokenizers library; strings of special tokens in a text are plain text."""

    def __init__(self, path: str):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.one = Tokenizer.from_file(path)
        self.one.encode_special_tokens = True
        alphabet = byte_alphabet()
        self.bytes = [b""] * self.one.get_vocab_size()
        for token, i in self.one.get_vocab(with_added_tokens=False).items():
            self.bytes[i] = bytes(alphabet[c] for c in token) if all(c in alphabet for c in token) else token.encode()
        self.size = np.array([len(x) for x in self.bytes], np.int64)

    def whole(self, text: str) -> list[int]:
        return self.one.encode(text, add_special_tokens=False).ids

    def fresh(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Parts that begin with a space and do not end with one are encoded many at a time, then told apart by their bytes."""
        joins = np.fromiter((x[0] == " " and "!" <= x[-1] <= "~" for x in parts), bool, len(parts))
        apart, together = np.flatnonzero(~joins), np.flatnonzero(joins)
        own, own_n = _listed([x.ids for x in self.one.encode_batch_fast([parts[k] for k in apart], add_special_tokens=False)])
        runs = ["".join([parts[k] for k in together[at:at + TOGETHER]]) for at in range(0, len(together), TOGETHER)]
        # one run at a time: the library's own result of a run is many times its ids
        joined = np.concatenate([np.zeros(0, np.uint32)] + [
            np.array(self.one.encode_batch_fast([run], add_special_tokens=False)[0].ids, np.uint32) for run in runs])
        ends = np.cumsum([len(parts[k].encode()) for k in together], dtype=np.int64)
        joined_n = np.diff(np.r_[0, np.searchsorted(np.cumsum(self.size[joined]), ends) + 1])
        counts = np.empty(len(parts), np.int64)
        counts[apart], counts[together] = own_n, joined_n
        first = np.empty(len(parts), np.int64)
        first[apart], first[together] = np.cumsum(own_n) - own_n, len(own) + np.cumsum(joined_n) - joined_n
        return spread(np.concatenate([own, joined]), first, counts)[0], counts


class Pieces(Coder):
    """BPE over pieces with byte fallback, by the sentencepiece library. Texts are given with a space before them,
    which stands for the one that the library adds."""

    def __init__(self, path: str):
        super().__init__()
        import sentencepiece

        self.one = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.one.get_piece_size()
        piece = [self.one.id_to_piece(i) for i in range(n)]
        self.bytes = [bytes([int(p[3:5], 16)]) if self.one.is_byte(i) else p.replace("▁", " ").encode()
                      for i, p in enumerate(piece)]
        self.size = np.array([len(x) for x in self.bytes], np.int64)
        self.space = piece.index("▁")

    def whole(self, text: str) -> list[int]:
        return self.one.encode(text[1:])

    def fresh(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = self.one.encode([x[1:] for x in parts], num_threads=1)
        return _listed([x or [self.space] for x in ids])


def coder(kind: type[Coder], path: str) -> Coder:
    if (kind, path) not in _loaded:
        _loaded[kind, path] = kind(path)
    return _loaded[kind, path]


def bpe(path: str) -> Bpe:
    return coder(Bpe, path)


def encoded(texts: pa.Array, path: str) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, rows, ids, offsets) for runs of rows; a null text is empty."""
    for first, part in W.slices(texts, SLICE):
        ids, off = bpe(path).encode(part)
        yield first, len(part), ids, off
    W.give_back()
