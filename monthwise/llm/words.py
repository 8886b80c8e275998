"""Vectorised word and window hashes of batches of texts (numpy inside tasks).

Words are ``[^\\x20\\x09-\\x0D]+``: what ``bytes.split()`` returns.  A word's
hash is a polynomial over its bytes, scrambled; a window's hash is the
Rabin-Karp polynomial over its words' hashes, scrambled again.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow.compute as pc

U = np.uint64
BYTE_BASE = U(0x9E3779B97F4A7C15)
WORD_BASE = U(0xD6E8FEB86659FD93)
CHUNK_BYTES = 1 << 20


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = x + U((seed * 2 + 1) * 0xA0761D6478BD642F % (1 << 64)) if seed else x.copy()
    x ^= x >> U(30)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, dtype=U)
    if n > 1:
        out[1:] = U(base)
        np.multiply.accumulate(out, out=out)
    return out


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``base ** i`` and its inverse modulo 2**64, i < n (``base`` is odd)."""
    have = _POWERS.get(base)
    if have is None or len(have[0]) < n:
        size = max(n, 1 << 16)
        have = _POWERS[base] = (_powers(base, size), _powers(pow(base, -1, 1 << 64), size))
    return have[0][:n], have[1][:n]


@dataclass
class Words:
    """Word hashes of a batch; document ``d`` owns ``hashes[offsets[d]:offsets[d + 1]]``."""

    hashes: np.ndarray
    offsets: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.offsets)


def _sums(buf: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Running polynomial of ``buf`` and the starts and ends of its words, which one space each separates."""
    b = np.frombuffer(buf, dtype=np.uint8)
    cut = np.flatnonzero(b == 32)
    up, _ = powers(int(BYTE_BASE), len(b) + 1)
    total = np.empty(len(b) + 1, dtype=U)
    total[0] = 0
    np.cumsum((b.astype(U) + U(1)) * up[:-1], out=total[1:])
    return total, np.concatenate(([0], cut + 1)), np.concatenate((cut, [len(b)]))


def _span_hashes(buf: bytes) -> np.ndarray:
    """Hashes of the words of ``buf``."""
    total, starts, ends = _sums(buf)
    _, down = powers(int(BYTE_BASE), len(buf) + 1)
    return mix((total[ends] - total[starts]) * down[starts])


def word_hashes(texts: list, lower: bool = False) -> Words:
    """Hashes of all words of ``texts`` (str, bytes or None), ASCII-lower-cased on request."""
    counts = np.zeros(len(texts), dtype=np.int64)
    parts, held, size = [], [], 0
    for i, text in enumerate(texts):
        if not text:
            continue
        raw = text.encode() if isinstance(text, str) else text
        words = (raw.lower() if lower else raw).split()
        if not words:
            continue
        counts[i] = len(words)
        joined = b" ".join(words)
        held.append(joined)
        size += len(joined)
        if size >= CHUNK_BYTES:
            parts.append(_span_hashes(b" ".join(held)))
            held, size = [], 0
    if held:
        parts.append(_span_hashes(b" ".join(held)))
    offsets = np.concatenate(([0], np.cumsum(counts)))
    return Words(np.concatenate(parts) if parts else np.empty(0, dtype=U), offsets)


def window_hashes(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every ``k``-word window and its start, windows never crossing a document's end."""
    n = len(words.hashes)
    if n < k:
        return np.empty(0, dtype=U), np.empty(0, dtype=np.int64)
    sums = np.zeros(n - k + 1, dtype=U)
    for j in range(k):  # Horner's rule, all windows at once
        sums *= WORD_BASE
        sums += words.hashes[j:n - k + 1 + j]
    last = np.repeat(words.offsets[1:], words.counts)[:n - k + 1]
    start = np.flatnonzero(np.arange(k, n + 1) <= last)
    return mix(sums[start]), start


def owners(words: Words, positions: np.ndarray) -> np.ndarray:
    """The document of each word position."""
    return np.repeat(np.arange(len(words.counts)), words.counts)[positions]


def pieces(table, text: str, size: int = 4 << 20, rows: int = 2000):
    """Consecutive slices of an Arrow table or batch with at most ``rows`` rows and about ``size`` bytes of text."""
    lengths = pc.fill_null(pc.binary_length(table[text]), 0).to_numpy(zero_copy_only=False)
    begin = held = 0
    for i, n in enumerate(lengths.tolist()):
        if i > begin and (held + n > size or i - begin >= rows):
            yield table.slice(begin, i - begin)
            begin, held = i, 0
        held += n
    if begin < table.num_rows:
        yield table.slice(begin, table.num_rows - begin)


def shingle_sets(texts: list, k: int, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ``k``-word shingles as (document, hash), ordered by both; a shorter text is one shingle."""
    words = word_hashes(texts, lower)
    h, start = window_hashes(words, k)
    doc = owners(words, start)
    counts = words.counts
    for n in range(1, k):
        short = np.flatnonzero(counts == n)
        total = np.zeros(len(short), dtype=U)
        for j in range(n):
            total = total * WORD_BASE + words.hashes[words.offsets[short] + j]
        h, doc = np.concatenate((h, mix(total, seed=n))), np.concatenate((doc, short))
    order = np.argsort(h)
    order = order[np.argsort(doc[order].astype(np.uint16 if len(texts) < 1 << 16 else np.int64), kind="stable")]
    h, doc = h[order], doc[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    return doc[new], h[new]


#: Bytes of plain words: digits, letters (A-Z lower-cased) and everything past ASCII; the rest separates.
PLAIN = bytes((b + 32 if 65 <= b <= 90 else b) if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def plain_words(texts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Plain words per text; of every word its first 8 bytes (as a number, the first byte lowest) and, if it is longer,
    its hash, else 0."""
    counts, parts = np.zeros(len(texts), dtype=np.int64), []
    for i, text in enumerate(texts):
        words = text.encode().translate(PLAIN).split() if text else []
        counts[i] = len(words)
        if words:
            parts.append(b" ".join(words))
    buf = b" ".join(parts)
    if not buf:
        return counts, np.empty(0, dtype=U), np.empty(0, dtype=U)
    total, starts, ends = _sums(buf)
    _, down = powers(int(BYTE_BASE), len(buf) + 1)
    b = np.frombuffer(buf + bytes(8), dtype=np.uint8)
    heads = np.zeros(len(starts), dtype=U)
    for j in range(8):
        heads |= np.where(starts + j < ends, b[starts + j], 0).astype(U) << U(8 * j)
    tails = mix((total[ends] - total[starts]) * down[starts]) | U(1)
    return counts, heads, np.where(ends - starts > 8, tails, U(0))
