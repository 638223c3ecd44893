"""Vectorised 64-bit hashes of the words and word n-grams of a batch of texts.

A word's hash is the polynomial sum of (byte + 1) * BASE**i over its bytes,
modulo 2**64, passed through a 64-bit finaliser; an n-gram's hash mixes its
words' hashes with one odd factor per position.  Everything is numpy over the
bytes of many texts at once; no Python code runs per word.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_U = np.uint64
_BASE = 0x9E3779B97F4A7C55
_INV = pow(_BASE, -1, 1 << 64)
_BLOCK = 1 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: One odd factor per word position of an n-gram (any fixed odd numbers do).
_FACTORS = [_U((0xD1342543DE82EF95 * (2 * j + 3)) % (1 << 64) | 1) for j in range(16)]


def mix(h: np.ndarray, salt: int = 0) -> np.ndarray:
    """64-bit finaliser (xor-shift and multiply), as in splitmix64."""
    h = h + _U((0x9E3779B97F4A7C15 * (salt + 1)) % (1 << 64))
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def _powers(base: int, n: int) -> np.ndarray:
    p = np.full(n, _U(base))
    p[0] = 1
    return np.multiply.accumulate(p)


_POW = _powers(_BASE, _BLOCK + 1)
_INVPOW = _powers(_INV, _BLOCK + 1)


@dataclass
class Batch:
    """Bytes of the texts, where each begins, and their words in order."""

    data: np.ndarray  # uint8, all texts
    offsets: np.ndarray  # len(texts) + 1
    start: np.ndarray  # byte offsets of the words
    end: np.ndarray
    doc: np.ndarray  # text of each word
    first: np.ndarray  # len(texts) + 1: first word of each text

    @property
    def n_docs(self) -> int:
        return len(self.offsets) - 1

    @property
    def n_words(self) -> np.ndarray:
        return np.diff(self.first)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; a null is an empty text."""
    col = pa.compute.fill_null(texts.cast(pa.large_string()), "")
    _, off, data = col.buffers()
    offsets = np.frombuffer(off, np.int64)[col.offset : col.offset + len(col) + 1] if len(col) else np.zeros(1, np.int64)
    flat = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None and len(col) else np.zeros(0, np.uint8)
    return flat, offsets - offsets[0]


def split_words(texts: pa.Array, lower: bool = False) -> Batch:
    data, offsets = text_bytes(texts)
    return split_bytes(_LOWER[data] if lower else data, offsets)


def split_bytes(data: np.ndarray, offsets: np.ndarray) -> Batch:
    inside = ~_SPACE[data]
    if len(data):
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        begins = inside.copy()
        begins[1:] &= ~inside[:-1] | edge[1:-1]
        ends = inside.copy()
        ends[:-1] &= ~inside[1:] | edge[1:-1]
        start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    else:
        start = end = np.zeros(0, np.int64)
    first = np.searchsorted(start, offsets)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    return Batch(data, offsets, start, end, doc, first)


def span_hashes(data: np.ndarray, start: np.ndarray, ends: list[np.ndarray]) -> list[np.ndarray]:
    """Hashes of data[start:end] for every span and each array of ends (the
    longest first); the spans' starts ascend."""
    out = [np.zeros(len(start), _U) for _ in ends]
    at = 0
    while at < len(start):
        base = int(start[at])
        stop = max(at + 1, int(np.searchsorted(start, base + _BLOCK, "right")))
        while stop > at + 1 and int(ends[0][at:stop].max()) - base > _BLOCK:
            stop = at + (stop - at) // 2
        span = int(ends[0][at:stop].max()) - base
        pw, inv = (_POW, _INVPOW) if span <= _BLOCK else (_powers(_BASE, span + 1), _powers(_INV, span + 1))
        sums = np.zeros(span + 1, _U)
        np.cumsum((data[base : base + span].astype(_U) + _U(1)) * pw[:span], out=sums[1:])
        a = start[at:stop] - base
        for h, end in zip(out, ends, strict=True):
            h[at:stop] = mix((sums[end[at:stop] - base] - sums[a]) * inv[a])
        at = stop
    return out


def word_hashes(b: Batch) -> np.ndarray:
    return span_hashes(b.data, b.start, [b.end])[0]


def ngrams(b: Batch, words: np.ndarray, n: int, short: bool) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of every n-gram of consecutive words, in order.  With
    ``short``, a text of 1 to n - 1 words gives one n-gram: all its words."""
    m = len(words) - n + 1
    if m > 0:
        whole = np.flatnonzero(b.doc[:m] == b.doc[n - 1 :])
        h = words[whole] * _FACTORS[0]
        for j in range(1, n):
            h = h + words[whole + j] * _FACTORS[j]
        doc, h = b.doc[whole], mix(h, n)
    else:
        doc, h = np.zeros(0, np.int64), np.zeros(0, _U)
    if short:
        count = b.n_words
        few = np.flatnonzero((count > 0) & (count < n))
        if len(few):
            g = np.zeros(len(few), _U)
            for j in range(n - 1):
                has = count[few] > j
                g[has] += words[b.first[few[has]] + j] * _FACTORS[j]
            doc = np.concatenate([doc, few])
            h = np.concatenate([h, mix(g + count[few].astype(_U), 99)])
            order = np.argsort(doc, kind="stable")
            doc, h = doc[order], h[order]
    return doc, h


def distinct(doc: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct (text, hash) pairs, ascending by text, then hash."""
    if not len(h):
        return doc, h
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    keep = np.ones(len(h), bool)
    keep[1:] = (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])
    return doc[keep], h[keep]
