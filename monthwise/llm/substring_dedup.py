"""Substring dedup: windows of ``window`` words that also start in a document with a smaller id are removed.

Method: Rabin-Karp hashes of every fixed-length word window, counted in Spark.

1. Documents are dealt by a hash into batches of about ``BATCH_BYTES`` of text (one shuffle, read twice).
2. Each batch hashes its windows and keeps, per distinct hash, the smallest id in the batch; these are dealt by
   hash into buckets of about ``BUCKET_WINDOWS`` windows as packed arrays (7 bytes a window and the id's
   difference to the one before).  However often a window occurs, a batch sends it once, so no bucket is hot.
3. A bucket finds the smallest id of each hash and answers every batch whose own smallest id is larger.
4. Batch and answers meet again; covered words merge into maximal removal intervals.

Hashes have 64 bits (56 sent, the rest fixed by the bucket).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from monthwise.llm.common import col, partitions, text_bytes, without
from monthwise.llm.words import U, Words, owners, window_hashes, word_hashes

BATCH_BYTES = 6 << 20
BUCKET_WINDOWS = 1 << 20
BYTES_PER_WORD = 6
LOW56 = U((1 << 56) - 1)


def _bucket(h: np.ndarray, buckets: int) -> np.ndarray:
    return ((h >> U(32)) * U(buckets) >> U(32)).astype(np.int64)


def _packed(h: np.ndarray) -> bytes:
    """The low seven bytes of each hash."""
    return np.ascontiguousarray(h.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :7]).tobytes()


def _unpacked(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 7, 8), dtype=np.uint8)
    out[:, :7] = np.frombuffer(raw, dtype=np.uint8).reshape(-1, 7)
    return out.reshape(-1).view("<u8").astype(U)


def _ids_packed(ids: np.ndarray) -> bytes:
    """Ascending ids as compressed differences."""
    return zstandard.ZstdCompressor(level=1).compress(np.diff(ids, prepend=np.int64(0)).tobytes())


def _ids_unpacked(raw: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), dtype=np.int64))


def _first_per_hash(h: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by (hash, id), the start of each hash's run, and for each ordered row its run."""
    order = np.lexsort((ids, h))
    hs = h[order]
    new = np.concatenate(([True], hs[1:] != hs[:-1])) if len(hs) else np.empty(0, dtype=bool)
    return order, np.flatnonzero(new), np.cumsum(new) - 1


def _windows(table: pa.Table, window: int) -> tuple[Words, np.ndarray, np.ndarray, np.ndarray]:
    """Words, window hashes, window starts and window ids of a batch (rows without an id take no part)."""
    words = word_hashes(table["__text"].to_pylist())
    h, start = window_hashes(words, window)
    doc = owners(words, start)
    has_id = np.asarray(table["__id"].is_valid())[doc]
    ids = table["__id"].fill_null(0).to_numpy()[doc]
    return words, h[has_id], start[has_id], ids[has_id]


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 13,
                     carry: tuple[str, ...] = ()) -> DataFrame:
    """Remove each word covered by a ``window``-word window whose words also start in a document with a smaller id.

    Windows are judged on the input.  Returns per input row: the id, ``carry`` columns unchanged, ``n_words``,
    ``n_removed``, ``kept_text`` (kept words joined by one space) and ``removed`` (maximal intervals
    [start, end) of word positions, ascending).

    Null text, empty text: no words, ``kept_text`` empty.  Fewer words than ``window``: nothing removed.  Null
    id: the row is returned whole and is no source for others.  Rows that repeat an id count as one document:
    neither is smaller, so they don't remove each other's words.  An empty table gives an empty result.  Columns
    not named are dropped, so extra names can't clash; ids are integers.
    """
    carry = without(carry, id_col, "n_words", "n_removed", "kept_text", "removed")
    spark = docs.sparkSession
    size = text_bytes(docs, text_col)
    batches = max(partitions(spark), -(-size // BATCH_BYTES))
    buckets = max(partitions(spark), -(-size // BYTES_PER_WORD // BUCKET_WINDOWS))
    # A text that is carried is the one that is judged: it goes through the shuffles and the tasks once.
    carried = ["__text" if c == text_col else f"__carry{i}" for i, c in enumerate(carry)]
    rows = docs.select(col(id_col).cast("long").alias("__id"), col(text_col).alias("__text"),
                       *[col(c).alias(n) for c, n in zip(carry, carried) if n != "__text"])
    rows = rows.withColumn("__batch", F.pmod(F.xxhash64("__id", "__text"), F.lit(batches)))

    def sent(key: tuple, table: pa.Table) -> pa.Table:
        _, h, _, ids = _windows(table, window)
        order, first, _ = _first_per_hash(h, ids)
        h, ids = h[order[first]], ids[order[first]]
        b = _bucket(h, buckets)
        order = np.lexsort((ids, b))
        h, ids, b = h[order], ids[order], b[order]
        cuts = np.flatnonzero(np.diff(b, prepend=-1))
        ends = np.append(cuts[1:], len(b)) if len(cuts) else cuts
        return pa.table({
            "bucket": pa.array(b[cuts], pa.int64()),
            "batch": pa.array(np.full(len(cuts), key[0].as_py()), pa.int64()),
            "hashes": pa.array([_packed(h[i:j]) for i, j in zip(cuts, ends)], pa.binary()),
            "ids": pa.array([_ids_packed(ids[i:j]) for i, j in zip(cuts, ends)], pa.binary())})

    def answered(key: tuple, table: pa.Table) -> pa.Table:
        hashes = [_unpacked(x) for x in table["hashes"].to_pylist()]
        ids = np.concatenate([_ids_unpacked(x) for x in table["ids"].to_pylist()])
        batch = np.repeat(table["batch"].to_numpy(), [len(x) for x in hashes])
        order, first, run = _first_per_hash(h := np.concatenate(hashes), ids)
        late = ids[order] > ids[order[first]][run]
        h, batch = h[order][late], batch[order][late]
        order = np.argsort(batch, kind="stable")
        h, batch = h[order], batch[order]
        cuts = np.flatnonzero(np.diff(batch, prepend=-1))
        ends = np.append(cuts[1:], len(batch)) if len(cuts) else cuts
        return pa.table({
            "__batch": pa.array(batch[cuts], pa.int64()),
            "bucket": pa.array(np.full(len(cuts), key[0].as_py()), pa.int64()),
            "hashes": pa.array([_packed(h[i:j]) for i, j in zip(cuts, ends)], pa.binary())})

    out_schema = StructType([rows.schema[n] for n in ("__id", *carried)] + StructType.fromDDL(_OUT).fields)

    def cut(key: tuple, table: pa.Table, answers: pa.Table) -> pa.Table:
        words, h, start, ids = _windows(table, window)
        order, first, run = _first_per_hash(h, ids)
        hit = np.zeros(len(h), dtype=bool)
        hit[order] = ids[order] > ids[order[first]][run]
        if answers.num_rows:
            got = [_unpacked(x) for x in answers["hashes"].to_pylist()]
            where = np.repeat(answers["bucket"].to_numpy(), [len(x) for x in got])
            got = np.concatenate(got)
            by = np.argsort(got, kind="stable")
            got, where = got[by], where[by]
            low = h & LOW56
            at = np.minimum(np.searchsorted(got, low), len(got) - 1)
            hit |= (got[at] == low) & (where[at] == _bucket(h, buckets))
        change = np.zeros(len(words.hashes) + 1, dtype=np.int32)
        np.add.at(change, start[hit], 1)
        np.add.at(change, start[hit] + window, -1)
        gone = np.cumsum(change[:-1]) > 0
        texts, kept, spans, removed = table["__text"].to_pylist(), [], [], np.zeros(table.num_rows, dtype=np.int64)
        for d, text in enumerate(texts):
            i, j = words.offsets[d], words.offsets[d + 1]
            own = gone[i:j]
            parts = text.encode().split() if text else []
            edges = np.flatnonzero(np.diff(own.astype(np.int8), prepend=0, append=0))
            if len(edges):
                removed[d] = own.sum()
                parts = [w for w, g in zip(parts, own.tolist()) if not g]
            spans.append([{"start": int(a), "end": int(b)} for a, b in zip(edges[::2], edges[1::2])])
            kept.append(b" ".join(parts).decode())
        return pa.table({n: table[n] for n in ("__id", *carried)} | {
            "n_words": pa.array(words.counts, pa.int64()),
            "n_removed": pa.array(removed, pa.int64()), "kept_text": pa.array(kept, pa.string()),
            "removed": pa.array(spans, _SPANS)})

    answers = (rows.groupBy("__batch").applyInArrow(sent, "bucket long, batch long, hashes binary, ids binary")
               .groupBy("bucket").applyInArrow(answered, "__batch long, bucket long, hashes binary"))
    out = rows.groupBy("__batch").cogroup(answers.groupBy("__batch")).applyInArrow(cut, out_schema)
    return out.select(F.col("__id").alias(id_col), *[F.col(n).alias(c) for c, n in zip(carry, carried)],
                      "n_words", "n_removed", "kept_text", "removed")


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_OUT = "n_words long, n_removed long, kept_text string, removed array<struct<start:long,end:long>>"
