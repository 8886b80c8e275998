"""Byte-level dedup: bytes inside a ``length``-byte string that also starts in a document with a smaller id go.

Method: run-length index (a run-compressed Burrows-Wheeler transform with sampled run ends).

1. Documents are written as packed units of about ``UNIT`` batches of ``BATCH_BYTES``, which a task reads a batch at a
   time.  In every window of ``length`` bytes the ``ANCHOR`` bytes with the smallest hash are its anchor; consecutive
   windows with one anchor form a context of at most 2 * length - ANCHOR bytes.  Equal windows have equal anchors at equal
   places.
2. Units send short hashes of their anchors in order; buckets answer by a bit each which of them other units have too (a
   hash shared by chance only lets more through).  Only contexts of anchors that occur twice go on.
3. A unit sends its distinct contexts, about ``SENT_BYTES`` at a time and each with its smallest id, to the buckets of
   their anchors, packed.  Units and buckets are large, as every unit has a row for every bucket.
4. A bucket lays contexts with a common anchor one after another, sorts their suffixes, and keeps of the transform only
   its run heads: text position, the position of the suffix before (where the last run ends) and their common length.
   Streaming over the text, every other position's neighbour and matching length follow from the last sample.  Matches
   of ``length`` bytes link windows into classes; a window whose class has a smaller id is marked.  Contexts that have
   neither half of where windows start in common with another need no index.
5. An anchor with more than ``HOT`` distinct contexts is dealt again, in halves of where windows start before it, each
   by the longer text that all its windows share, until a share is small or a single window.
6. Marks meet their unit and merge into maximal removed spans.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from monthwise.llm.batches import packed, unpacked
from monthwise.llm.common import col, partitions, text_bytes, without, written
from monthwise.llm.words import U, mix

ANCHOR = 16
BATCH_BYTES = 4 << 20
UNIT = 4
SENT_BYTES = 12 << 20
ANCHORS_BYTES = 32 << 20
BUCKET_BYTES = 8 << 20
BLOCK = 1 << 16
INDEX_BYTES = 1 << 18
HELD_BYTES = 64 << 20
SHARE_ROWS = 1 << 14
HOT = 8192
PAIR = U(0x9E3779B97F4A7C15)


def _zip(*columns: np.ndarray) -> bytes:
    """Columns of one length, one after another."""
    return zstandard.ZstdCompressor(level=3).compress(b"".join([c.tobytes() for c in columns]))


def _unzip(raw, *dtypes) -> list[np.ndarray]:
    raw, kinds, begin, out = zstandard.ZstdDecompressor().decompress(raw), [*map(np.dtype, dtypes)], 0, []
    n = len(raw) // sum(k.itemsize for k in kinds)
    for kind in kinds:
        out.append(np.frombuffer(raw, dtype=kind, offset=begin, count=n))
        begin += n * kind.itemsize
    return out


def _steps(values: np.ndarray, dtype) -> np.ndarray:
    """Differences; the sums of these, in the same dtype, are the values again."""
    values = values.astype(dtype)
    return np.diff(values, prepend=values.dtype.type(0))


def _cuts(keys: np.ndarray) -> Iterator[tuple[int, int]]:
    """Where runs of equal keys begin and end."""
    edges = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1], [True]))).tolist() if len(keys) else [0]
    return zip(edges[:-1], edges[1:])


def _sorted(keys: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of keys of ``width`` bits, equal ones by place, and the keys in it; one sort of plain numbers if both fit."""
    bits = max(len(keys) - 1, 1).bit_length()
    if width + bits > 64:
        order = np.argsort(keys, kind="stable")
        return order, keys[order]
    both = np.sort(keys.astype(U) << U(bits) | np.arange(len(keys), dtype=U))
    return (both & U((1 << bits) - 1)).astype(np.int64), both >> U(bits)


def _eights(raw: bytes, n: int) -> np.ndarray:
    """Eight bytes from each of the first ``n`` positions as a number, the first byte lowest."""
    padded, out = raw + bytes(16), np.empty(n, dtype=U)
    for r in range(min(8, n)):
        out[r::8] = np.frombuffer(padded, dtype="<u8", offset=r, count=(n - r + 7) // 8)
    return out


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of ``width`` values from each position on (fewer at the end)."""
    out, span = values.copy(), 1
    while span < width:
        step = min(span, width - span)
        out[:-step] = np.minimum(out[:-step], out[step:])
        span += step
    return out


def _raw(table: pa.Table) -> tuple[bytes, np.ndarray]:
    """All texts one after another, and the bytes of each."""
    text = table["text"].combine_chunks().fill_null("").cast(pa.binary())
    offsets = np.frombuffer(text.buffers()[1], dtype=np.int32, count=len(text) + 1, offset=4 * text.offset) \
        if len(text) else np.zeros(1, np.int32)
    data = text.buffers()[2]
    raw = data.slice(int(offsets[0]), int(offsets[-1] - offsets[0])).to_pybytes() if data else b""
    return raw, np.diff(offsets).astype(np.int64)


def _cuts_of(size: np.ndarray) -> Iterator[tuple[int, int]]:
    """A unit's rows, about ``BATCH_BYTES`` of text at a time."""
    return _cuts((np.cumsum(size) - size) // BATCH_BYTES)


class Contexts:
    """Runs of windows with one anchor in a batch of documents.

    A run covers the windows from ``start`` to ``stop`` (of their first bytes); its anchor is ``place`` bytes in and has
    the hash ``anchor``.
    """

    def __init__(self, raw: bytes, size: np.ndarray, known: np.ndarray, length: int):
        self.raw = raw
        begin = np.cumsum(size) - size
        ends = begin + size
        inside = np.ones(len(self.raw), dtype=bool)
        for i, j, whole in zip(begin.tolist(), ends.tolist(), (~known).tolist()):
            inside[i if whole else max(j - length + 1, i):j] = False
        start, stop, place, anchor = ([np.empty(0, t)] for t in (np.int64, np.int64, np.int64, U))
        for a in range(0, max(len(self.raw) - length + 1, 0), BLOCK):  # blocks that fit a core's cache
            part = self.raw[a:a + BLOCK + length - 1]
            own = np.flatnonzero(inside[a:a + len(part) - length + 1])
            if not len(own):
                continue
            n = len(part) - ANCHOR + 1
            words = _eights(part, len(part))
            h = mix(words[:n] * PAIR + mix(words[8:8 + n]))
            # Ties of the leading hash bits go to the first place, in every window alike.
            low = _least((h & ~U((1 << 22) - 1)) | np.arange(n, dtype=U), length - ANCHOR + 1)
            at = (low[own] & U((1 << 22) - 1)).astype(np.int64)
            new = np.flatnonzero(np.append(True, (np.diff(at) != 0) | (np.diff(own) != 1)))
            start.append(own[new] + a)
            stop.append(own[np.append(new[1:], len(own)) - 1] + a)
            place.append(at[new] - own[new])
            anchor.append(h[at[new]])
        self.start, self.stop = np.concatenate(start), np.concatenate(stop)
        self.place, anchor = np.concatenate(place), np.concatenate(anchor)
        # Anchors have small hashes by choice: scrambled again, they spread over all buckets.
        self.anchor = mix(anchor, seed=1)


class UnitContexts:
    """Contexts of a unit; they start at positions in all its text."""

    def __init__(self, raw: pa.Scalar, length: int):
        # The first two columns of a unit are id and text.
        with pa.ipc.open_stream(raw.as_buffer(), options=pa.ipc.IpcReadOptions(included_fields=[0, 1])) as stream:
            table = stream.read_all()
        known = table["id"].is_valid().to_numpy()
        self.ids, (self.raw, size) = table["id"].fill_null(0).to_numpy(), _raw(table)
        del table
        self.ends = np.cumsum(size)
        parts = [[np.empty(0, t) for t in (np.uint32, np.uint8, np.uint8, U)]]
        for i, j in _cuts_of(size):
            begin = int(self.ends[i] - size[i])
            part = Contexts(self.raw[begin:int(self.ends[j - 1])], size[i:j], known[i:j], length)
            parts.append(((part.start + begin).astype(np.uint32), (part.stop - part.start + 1).astype(np.uint8),
                          part.place.astype(np.uint8), part.anchor))
        self.start, self.windows, self.place, self.anchor = map(np.concatenate, zip(*parts))

    def id(self, run: np.ndarray) -> np.ndarray:
        return self.ids[np.searchsorted(self.ends, self.start[run], side="right")]

    def shares(self, buckets: int) -> np.ndarray:
        """Bucket of each anchor and the 32 bits of its hash that tell anchors of a bucket apart, in one number."""
        return _bucket(self.anchor, buckets) << U(32) | self.anchor & U(0xFFFFFFFF)


def _bucket(anchor: np.ndarray, buckets: int) -> np.ndarray:
    return (anchor >> U(32)) * U(buckets) >> U(32)


#: Contexts of one unit in one bucket; lo and hi: how far before the anchor windows may start.  Without texts an answer for
#: a unit: marks of windows (lo 0), or repeats that it found by itself (lo 1).
ENTRIES = "bucket long, batch long, lo int, hi int, texts binary, figures binary"
ARROW = pa.schema([("bucket", pa.int64()), ("batch", pa.int64()), ("lo", pa.int32()), ("hi", pa.int32()),
                   ("texts", pa.binary()), ("figures", pa.binary())])
FIGURES = (np.uint8, np.uint8, np.int64, np.uint32)  # of texts: bytes, place of the anchor, id (steps), start (steps)
MARKS = (np.uint32, np.uint64)  # start (steps), a bit for each window from there on
TOLD = (np.uint32, np.uint32, np.uint8, np.uint8)  # start (steps), start of the equal one that was sent, windows, 1: all


def _entry(bucket: int, batch: int, lo: int, hi: int, texts, sizes, places, ids, starts) -> tuple:
    """A row of contexts; ``texts``: all their bytes."""
    figures = _zip(np.asarray(sizes, np.uint8), np.asarray(places, np.uint8), _steps(np.asarray(ids), np.int64),
                   _steps(np.asarray(starts), np.uint32))
    return bucket, batch, lo, hi, zstandard.ZstdCompressor(level=3).compress(texts), figures


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [()] * 6, ARROW)],
                                      schema=ARROW)


def _suffix_order(raw: bytes, ends: np.ndarray) -> np.ndarray:
    """Suffixes in order; one ends where its context does, and equal ones follow their contexts' order."""
    n = len(raw)
    at, bits = np.arange(n), n.bit_length()
    # Five bytes, and how many of them are there: that tells an end from a zero byte.
    left = np.minimum(ends - at, 5).astype(U)
    gone = (U(5) - left) << U(3)
    key = (_eights(raw, n).byteswap() >> U(24) >> gone << gone) << U(3) | left
    order, key = _sorted(key, 43)
    new = np.append(True, key[1:] != key[:-1])
    rank, done, longest = np.empty(n, dtype=np.int64), 5, int((ends - at).max(initial=0))
    rank[order] = np.maximum.accumulate(np.where(new, at, 0))
    while done < longest:
        # Only suffixes that share their rank with another are told further apart.
        slots = np.flatnonzero(~(new & np.append(new[1:], True)))
        if not len(slots):
            break
        own = order[slots]
        after = np.where(own + done < ends[own], rank[np.minimum(own + done, n - 1)] + 1, 0)
        by, pair = _sorted(rank[own] << bits | after, 2 * bits)
        own, first = own[by], np.append(True, pair[1:] != pair[:-1])
        order[slots], new[slots] = own, first
        rank[own] = np.maximum.accumulate(np.where(first, slots, 0))
        done *= 2
    return order


class RunLengthIndex:
    """Samples at the run heads of the Burrows-Wheeler transform of contexts laid one after another."""

    def __init__(self, texts: list[bytes]):
        sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1  # each ends in a separator
        raw = b"\0".join(texts) + b"\0"
        self.first = np.cumsum(sizes) - sizes
        owner = np.repeat(np.arange(len(texts)), sizes)
        ends = (self.first + sizes - 1)[owner]
        order = _suffix_order(raw, ends)
        before, opens = np.frombuffer(raw, dtype=np.uint8)[order - 1], np.zeros(len(raw), dtype=bool)
        opens[self.first] = True  # nothing stands before a context
        opens = opens[order]
        head = np.append(True, (before[1:] != before[:-1]) | opens[1:] | opens[:-1])
        heads = np.flatnonzero(head)
        self.position, self.before = order[heads], order[heads - 1]
        words, common = _eights(raw, len(raw)), np.zeros(len(heads), dtype=np.int64)
        most = np.minimum(ends[self.position] - self.position, ends[self.before] - self.before)
        most[0] = 0  # the first suffix has none before it
        live = np.flatnonzero(most > 0)
        while len(live):
            x = (words[self.position[live] + common[live]] ^ words[self.before[live] + common[live]])
            # Bytes alike before the first that differs; the float's exponent is the lowest set bit.
            same = np.where(x == 0, 8, (np.frexp((x & (~x + U(1))).astype(np.float64))[1] - 1) // 8)
            common[live] += same
            live = live[(same == 8) & (common[live] < most[live])]
        self.common = np.minimum(common, most)
        by = np.argsort(self.position)
        self.position, self.before, self.common = self.position[by], self.before[by], self.common[by]
        self.size = len(raw)

    def statistics(self) -> tuple[np.ndarray, np.ndarray]:
        """For every text position the position of the suffix before its own in order, and how long both agree."""
        at = np.arange(self.size)
        sample = np.zeros(self.size, dtype=np.int64)
        sample[self.position] = np.arange(len(self.position))
        sample = np.maximum.accumulate(sample)
        gone = at - self.position[sample]
        return self.before[sample] + gone, self.common[sample] - gone


def marks_by_index(texts: list[bytes], ids: np.ndarray, length: int) -> np.ndarray:
    """Per text a bit for each window that some text with a smaller id also has."""
    index = RunLengthIndex(texts)
    link, common = index.statistics()
    root = np.where(common >= length, link, np.arange(index.size))
    while True:  # to the first window of each class, by doubling
        further = root[root]
        if np.array_equal(further, root):
            break
        root = further
    n = np.fromiter(map(len, texts), np.int64, len(texts)) - length + 1
    first = np.cumsum(n) - n
    owner = np.repeat(np.arange(len(texts)), n)
    place = np.arange(len(owner)) - first[owner]
    kind = root[index.first[owner] + place]
    least = np.full(index.size, np.iinfo(np.int64).max)
    np.minimum.at(least, kind, ids[owner])
    return np.add.reduceat(np.where(least[kind] < ids[owner], U(1) << place.astype(U), U(0)), first)


class _Held:
    """Entries of a bucket; shares of too many distinct contexts leave it as they are found.

    Contexts stay in Arrow buffers; a share is known by a hash of the text that all its windows have, so shares that meet
    by chance only make an index larger.
    """

    COLUMNS = {"batch": np.int64, "lo": np.uint8, "hi": np.uint8, "place": np.uint8, "id": np.int64, "start": np.int64}

    def __init__(self, length: int, buckets: int):
        self.length, self.buckets, self.hot = length, buckets, np.empty(0, dtype=U)
        self.texts: list[pa.Array] = []
        self.columns: dict[str, list] = {n: [np.empty(0, t)] for n, t in self.COLUMNS.items()}
        self.bytes, self.most, self.known = 0, HELD_BYTES, None

    def add(self, batch: int, lo: int, hi: int, texts, figures) -> None:
        raw = zstandard.ZstdDecompressor().decompress(texts)
        size, place, ids, start = _unzip(figures, *FIGURES)
        n, offsets = len(size), np.zeros(len(size) + 1, np.int32)
        np.cumsum(size, out=offsets[1:])
        self.texts.append(pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(raw)]))
        self.bytes, self.known = self.bytes + len(raw), None
        values = {"batch": np.full(n, batch), "lo": np.full(n, lo, np.uint8), "hi": np.full(n, hi, np.uint8), "place": place,
                  "id": np.cumsum(ids), "start": np.cumsum(start, dtype=np.uint32).astype(np.int64)}
        for name, column in values.items():
            self.columns[name].append(column)

    def _share(self, texts: pa.Array, own: np.ndarray, place: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """A hash of what windows that start from ``lo`` to ``hi`` before the anchor have in common; 0 if not ``own``."""
        offsets, out = np.frombuffer(texts.buffers()[1], dtype=np.int32, count=len(texts) + 1), np.zeros(len(texts), dtype=U)
        for i in range(0, len(texts), SHARE_ROWS):
            x = i + np.flatnonzero(own[i:i + SHARE_ROWS])
            a, b = int(offsets[i]), int(offsets[min(i + SHARE_ROWS, len(texts))])
            words = _eights(texts.buffers()[2].slice(a, b - a).to_pybytes(), b - a)
            begin, left = offsets[x] - a + place[x] - lo[x], self.length - hi[x] + lo[x]
            h = mix((lo[x] * 256 + hi[x]).astype(U))
            while (left > 0).any():
                y = np.flatnonzero(left > 0)
                keep = np.minimum(left[y], 8).astype(U) * U(8)
                word = words[begin[y]] & np.where(keep < 64, (U(1) << (keep % U(64))) - U(1), ~U(0))
                h[y] = mix(h[y] * PAIR + word)
                begin, left = begin + 8, left - 8
            out[x] = h
        return out

    def _halves(self, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each distinct context whether another has the common text of its windows in the first half of the places
        where windows start, and in the second; ``times``: how many a context counts for."""
        columns, _, texts, first, share = self.shares()
        place, lo, hi = (columns[c][first].astype(np.int64) for c in ("place", "lo", "hi"))
        middle, last = (lo + hi) // 2, place - (pc.binary_length(texts).to_numpy().astype(np.int64) - self.length)
        out = []
        for a, b, has in ((lo, middle, last <= middle), (middle + 1, hi, place > middle)):
            own, found = np.flatnonzero(has), np.zeros(len(texts), dtype=bool)
            if len(own):
                order, h = _sorted(mix(share * PAIR + self._share(texts, has, place, a, b))[own], 64)
                group = np.cumsum(np.append(False, h[1:] != h[:-1]))
                found[own[order]] = np.bincount(group, weights=times[own[order]])[group] > 1
            out.append(found)
        return out[0], out[1]

    def shares(self) -> tuple[dict, np.ndarray, pa.Array, np.ndarray, np.ndarray]:
        """Columns, each entry's distinct context, these contexts, the first entry and the share of each."""
        if not self.known:
            columns = {n: np.concatenate(v) for n, v in self.columns.items()}
            self.columns = {n: [v] for n, v in columns.items()}
            coded = pa.chunked_array(self.texts, pa.binary()).dictionary_encode()  # one for all chunks
            code = np.concatenate([x.indices.to_numpy() for x in coded.chunks]).astype(np.int64)
            texts = coded.chunk(0).dictionary
            first = np.empty(len(texts), dtype=np.int64)
            first[code[::-1]] = np.arange(len(code))[::-1]
            self.known = columns, code, texts, first, self._share(
                texts, np.ones(len(texts), dtype=bool), *(columns[c][first].astype(np.int64) for c in ("place", "lo", "hi")))
        return self.known

    def overflow(self, last: bool) -> Iterator[tuple]:
        """Entries of hot shares, dealt in halves; the others stay."""
        if not self.texts or not last and self.bytes <= self.most:
            return
        columns, code, texts, _, share = self.shares()
        names, size = np.unique(share, return_counts=True)
        whole = np.setdiff1d(names[size > HOT], self.hot) if last else []  # all their entries are here
        self.hot = np.union1d(self.hot, names[size > HOT])
        leaves = np.isin(share, self.hot)
        if leaves.any():
            # What no other entry can have, in a share that is here as a whole, needs no dealing.
            halves = [found | ~np.isin(share, whole) for found in self._halves(np.bincount(code, minlength=len(texts)))]
            leaves = leaves[code]
            rows: dict[tuple, list] = {}
            for i in np.flatnonzero(leaves & (halves[0] | halves[1])[code]).tolist():
                text, place, lo, hi = texts[code[i]].as_py(), *(int(columns[c][i]) for c in ("place", "lo", "hi"))
                middle = (lo + hi) // 2
                for (a, b), found in zip(((lo, middle), (middle + 1, hi)), halves):
                    begin, end = max(place - b, 0), min(place - a, len(text) - self.length)
                    if begin <= end and found[code[i]]:
                        part, at = text[begin:end + self.length], place - begin
                        name = bytes((a, b)) + part[at - a:at + self.length - b]
                        bucket = xxhash.xxh64_intdigest(name) % self.buckets
                        rows.setdefault((bucket, int(columns["batch"][i]), a, b), []).append(
                            (part, len(part), at, int(columns["id"][i]), int(columns["start"][i]) + begin))
            for (bucket, batch, a, b), own in rows.items():
                parts, *figures = zip(*own)
                yield _entry(bucket, batch, a, b, b"".join(parts), *figures)
            stay = np.flatnonzero(~leaves)
            kept = texts.take(pa.array(code[stay]))
            self.texts, self.bytes, self.known = [kept] if len(stay) else [], kept.nbytes, None
            self.columns = {n: [v[stay]] for n, v in columns.items()}
        self.most = max(HELD_BYTES, 2 * self.bytes)  # looked at again when it has doubled

    def answers(self) -> Iterator[tuple]:
        if not self.texts:
            return
        columns, code, texts, _, share = self.shares()
        least = np.full(len(texts), np.iinfo(np.int64).max)
        np.minimum.at(least, code, columns["id"])
        marks = np.zeros(len(texts), dtype=U)
        # A context alone with its anchor, or alone with both halves of it, can repeat as a whole only.
        one, two = self._halves(np.ones(len(texts), dtype=np.int64))
        by = np.flatnonzero(one | two)
        by = by[np.argsort(share[by], kind="stable")]
        size = pc.binary_length(texts).to_numpy().astype(np.int64)
        total = np.concatenate(([0], np.cumsum(size[by])))
        begin = 0
        for _, j in _cuts(share[by]):
            if j > begin and (j == len(by) or total[j] - total[begin] > INDEX_BYTES):
                own = by[begin:j]
                marks[own] = marks_by_index(texts.take(pa.array(own)).to_pylist(), least[own], self.length)
                begin = j
        every = (U(1) << (size - self.length + 1).astype(U)) - U(1)
        marks = np.where(columns["id"] > least[code], every[code], marks[code])
        hit = np.flatnonzero(marks)
        hit = hit[np.lexsort((columns["start"][hit], columns["batch"][hit]))]
        batch = columns["batch"][hit]
        for i, j in _cuts(batch):
            own = hit[i:j]
            yield 0, int(batch[i]), 0, 0, None, _zip(_steps(columns["start"][own], np.uint32), marks[own])


def dedup_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 50,
                carry: tuple[str, ...] = ()) -> DataFrame:
    """Remove each byte covered by a ``length``-byte string that also starts in a document with a smaller id.

    Texts are UTF-8 bytes; strings lie within one document and are judged on the input; 24 <= ``length`` <= 78.
    Returns per input row: the id, ``carry`` columns unchanged, ``n_bytes``, ``n_removed``, ``kept`` (the bytes left,
    which needn't be valid UTF-8) and ``removed`` (maximal spans [start, end) of byte positions, ascending).

    Null text, empty text: no bytes.  Fewer bytes than ``length``: nothing removed.  Null id: the row is returned whole
    and is no source for others.  Rows that repeat an id count as one document: neither is smaller.  An empty table
    gives an empty result.  Columns not named are dropped, so extra names can't clash; ids are integers.
    """
    if not 24 <= length <= 78:
        raise ValueError("length must lie between 24 and 78 bytes")
    carry = without(carry, id_col, "n_bytes", "n_removed", "kept", "removed")
    carried = [f"carry{i}" for i in range(len(carry))]
    rows = docs.select(col(id_col).cast("long").alias("id"), col(text_col).cast("string").alias("text"),
                       *[col(c).alias(n) for c, n in zip(carry, carried)])
    batches = packed(rows, "text", UNIT * BATCH_BYTES, "texts")
    size = text_bytes(docs, text_col)
    buckets, wide = (max(partitions(docs.sparkSession), -(-size // b)) for b in (BUCKET_BYTES, ANCHORS_BYTES))
    far = length - ANCHOR

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, raw in zip(batch["batch"].to_pylist(), batch["rows"]):
                own = np.sort(UnitContexts(raw, length).shares(wide))
                own = own[np.flatnonzero(np.append(True, own[1:] != own[:-1])[:len(own)])]
                bucket, own = (own >> U(32)).astype(np.int64), own.astype(np.uint32)
                cuts = [*_cuts(bucket)]
                yield pa.RecordBatch.from_arrays([
                    pa.array([int(bucket[i]) for i, _ in cuts], pa.int64()), pa.array([number] * len(cuts), pa.int64()),
                    pa.array([_zip(_steps(own[i:j], np.uint32)) for i, j in cuts], pa.binary())], schema=ANCHORS)

    def repeated(key: tuple, table: pa.Table) -> pa.Table:
        each = [np.cumsum(_unzip(x.as_buffer(), np.uint32)[0], dtype=np.uint32) for x in table["anchors"]]
        order, value = _sorted(np.concatenate(each), 32)
        same, again = value[1:] == value[:-1], np.zeros(len(value), dtype=bool)
        again[order[1:][same]] = again[order[:-1][same]] = True
        ends = np.cumsum([*map(len, each)]).tolist()
        bits = [np.packbits(again[i:j]).tobytes() for i, j in zip([0, *ends], ends)]
        return pa.table({"bucket": table["bucket"], "batch": table["batch"], "anchors": pa.array(bits, pa.binary())})

    def sent(key: tuple, batch: pa.Table, answers: pa.Table) -> pa.Table:
        pa.default_memory_pool().release_unused()  # what the unit before had
        number, found, out = key[0].as_py(), UnitContexts(batch["rows"][0], length), []
        order, share = _sorted(found.shares(wide), 32 + wide.bit_length())
        # Anchors in the order in which they were sent: one bit for each distinct one.
        group = np.cumsum(np.append(False, share[1:] != share[:-1])) if len(share) else order
        times = np.bincount(group)
        bucket = share[np.cumsum(times) - times] >> U(32)
        answers = answers.sort_by("bucket")["anchors"].to_pylist()
        again = [np.empty(0, np.uint8), *(np.unpackbits(np.frombuffer(x, np.uint8), count=j - i) for x, (i, j) in
                                           zip(answers, _cuts(bucket), strict=True))]
        run = np.sort(order[((np.concatenate(again) > 0) | (times > 1))[group]])
        del order, share, group
        begin, ids = found.start[run].astype(np.int64), found.id(run)
        ends = begin + found.windows[run] + length - 1
        part = np.cumsum(ends - begin) // SENT_BYTES
        for i, j in _cuts(part):
            own, own_ids = run[i:j], ids[i:j]
            coded = pa.array([found.raw[a:b] for a, b in zip(begin[i:j].tolist(), ends[i:j].tolist())],
                             pa.binary()).dictionary_encode()
            code, texts = coded.indices.to_numpy().astype(np.int64), coded.dictionary
            first = np.empty(len(texts), dtype=np.int64)
            first[code[::-1]] = own[::-1]
            least = np.full(len(texts), np.iinfo(np.int64).max)
            np.minimum.at(least, code, own_ids)
            # What the unit knows by itself: runs that repeat a context of it, and those with a larger id than another.
            whole = own_ids > least[code]
            told = np.flatnonzero(whole | (first[code] != own))
            if len(told):
                t = own[told]
                out.append((number % buckets, number, 1, 0, None, _zip(
                    _steps(found.start[t], np.uint32), found.start[first[code[told]]],
                    found.windows[t], whole[told].astype(np.uint8))))
            bucket = _bucket(found.anchor[first], buckets).astype(np.int64)
            by = np.argsort(bucket, kind="stable")
            texts, first, least, bucket = texts.take(pa.array(by)), first[by], least[by], bucket[by]
            offsets, raw = np.frombuffer(texts.buffers()[1], dtype=np.int32), texts.buffers()[2]
            for a, b in _cuts(bucket):
                x = first[a:b]
                out.append(_entry(int(bucket[a]), number, 0, far, raw.slice(int(offsets[a]), int(offsets[b] - offsets[a])),
                                  np.diff(offsets[a:b + 1]), found.place[x], least[a:b], found.start[x]))
        return pa.Table.from_batches([_rows(out)])

    def answered(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Held(length, buckets)
        pa.default_memory_pool().release_unused()  # what the group before had
        for batch in batches:
            for number, lo, hi, texts, figures in zip(*(batch[c].to_pylist() for c in ("batch", "lo", "hi")),
                                                      batch["texts"], batch["figures"]):
                if texts.is_valid:
                    held.add(number, lo, hi, texts.as_buffer(), figures.as_buffer())
                    if more := [*held.overflow(last=False)]:
                        yield _rows(more)
            yield batch.filter(batch["texts"].is_null()).select(ARROW.names)
            batch = texts = figures = None
        yield _rows([*held.overflow(last=True)])
        yield _rows([*held.answers()])

    out_schema = StructType([rows.schema[n] for n in ("id", *carried)] + StructType.fromDDL(_OUT).fields)

    def cut(key: tuple, batch: pa.Table, answers: pa.Table) -> pa.Table:
        table, out, begin = unpacked(batch["rows"][0].as_buffer()), [], 0
        marked = np.zeros(pc.sum(pc.binary_length(table["text"])).as_py() or 0, dtype=bool)  # windows, by their start
        told = []
        for kind, raw in zip(answers["lo"].to_pylist(), answers["figures"]):
            if kind:
                start, *others = _unzip(raw.as_buffer(), *TOLD)
                told.append((np.cumsum(start, dtype=np.uint32).astype(np.int64), *others))
                continue
            start, marks = _unzip(raw.as_buffer(), *MARKS)
            bits = np.unpackbits(marks.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            run, place = np.nonzero(bits)
            marked[np.cumsum(start, dtype=np.uint32)[run].astype(np.int64) + place] = True
        for all_windows in (False, True):  # marks of equal contexts first, as those for all windows are of one run only
            for start, first, windows, whole in told:
                for i in range(0, len(start), BLOCK):
                    own = np.arange(i, min(i + BLOCK, len(start)))
                    own = own[whole[own] > 0] if all_windows else own
                    for k in range(int(windows[own].max(initial=0))):
                        own = own[windows[own] > k]
                        marked[start[own] + k] |= all_windows or marked[first[own].astype(np.int64) + k]
        for i, j in _cuts_of(pc.fill_null(pc.binary_length(table["text"]), 0).to_numpy().astype(np.int64)):
            part = table.slice(i, j - i)
            raw, size = _raw(part)
            own = marked[begin:begin + len(raw)]
            begin += len(raw)
            change = np.zeros(len(raw) + 1, dtype=np.int8)
            at = np.flatnonzero(own)
            change[at] += 1
            change[at + length] -= 1
            gone = np.cumsum(change[:-1], dtype=np.int32) > 0
            # Spans don't reach into the next text.
            edge, full = np.cumsum(size) - size, size > 0
            opens, ends = gone.copy(), gone.copy()
            opens[1:] &= ~gone[:-1]
            opens[edge[full]] = gone[edge[full]]
            ends[:-1] &= ~gone[1:]
            ends[edge[full] + size[full] - 1] = gone[edge[full] + size[full] - 1]
            opens, ends = np.flatnonzero(opens), np.flatnonzero(ends) + 1
            edges = np.append(edge, len(raw))
            cuts = np.searchsorted(opens, edges)
            base = np.repeat(edge, np.diff(cuts))
            spans = pa.StructArray.from_arrays([pa.array(opens - base, pa.int64()), pa.array(ends - base, pa.int64())],
                                               ["start", "end"])
            removed = np.concatenate(([0], np.cumsum(ends - opens)))[cuts]
            kept = np.frombuffer(raw, dtype=np.uint8)[~gone]
            out.append(pa.table({n: part[n] for n in ("id", *carried)} | {
                "n_bytes": pa.array(size, pa.int64()), "n_removed": pa.array(np.diff(removed), pa.int64()),
                "kept": pa.Array.from_buffers(pa.binary(), len(size), [
                    None, pa.py_buffer((edges - removed).astype(np.int32)), pa.py_buffer(kept)]),
                "removed": pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), spans).cast(_SPANS)}))
        return pa.concat_tables(out)

    short = "bucket long, batch long, anchors binary"
    elsewhere = batches.mapInArrow(anchors, short).groupBy("bucket").applyInArrow(repeated, short)
    todo = batches.groupBy("batch").cogroup(elsewhere.groupBy("batch")).applyInArrow(sent, ENTRIES)
    answers = None
    while True:
        done = written(todo.groupBy("bucket").applyInArrow(answered, ENTRIES), "repeats")
        part = done.where("texts IS NULL").select("batch", "lo", "figures")
        answers = part if answers is None else answers.unionByName(part)
        todo = done.where("texts IS NOT NULL")
        if todo.isEmpty():
            break
    out = batches.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(cut, out_schema)
    return out.select(F.col("id").alias(id_col), *[F.col(n).alias(c) for c, n in zip(carry, carried)],
                      "n_bytes", "n_removed", "kept", "removed")


ANCHORS = pa.schema([("bucket", pa.int64()), ("batch", pa.int64()), ("anchors", pa.binary())])
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_OUT = "n_bytes long, n_removed long, kept binary, removed array<struct<start:long,end:long>>"
