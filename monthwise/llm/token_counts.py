"""Token counts: pieces are counted once per distinct pre-token and joined to per-document pre-token frequencies.

1. A batch of texts is split into pre-tokens.  It is written as, per document, the places of its pre-tokens in the
   batch's list with their frequencies, and that list itself, dealt by a hash into packed buckets.  No token id is
   ever made.
2. A bucket holds the pre-tokens of its hash share from all batches; each distinct one goes through the tokenizer
   once, and every batch gets its counts back.  A pre-token comes at most once from a batch, so no bucket is hot.
3. The counts meet their batch and are summed by the frequencies.
"""

from __future__ import annotations

import zlib
from array import array
from collections import Counter
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthwise.llm.common import col, partitions, text_bytes, written
from monthwise.llm.words import pieces

# Fixed value: the pattern by which byte-level vocabularies of this kind cut text before any merge.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
BATCH_BYTES = 4 << 20
BUCKET_BYTES = 4 << 20


def _pack(values, dtype=np.uint32) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(np.asarray(values, dtype=dtype).tobytes())


def _unpack(raw: bytes, dtype=np.uint32) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), dtype=dtype).astype(np.int64)


def _steps(places: np.ndarray, times: np.ndarray, sizes: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Places ascending within each document, each as its distance from the one before; times alike."""
    doc = np.repeat(np.arange(len(sizes)), sizes)
    order = np.lexsort((places, doc))
    places = places[order]
    steps = np.diff(places, prepend=0)
    starts = np.concatenate(([0], np.cumsum(sizes)))[:-1][np.asarray(sizes) > 0].astype(np.int64)
    steps[starts] = places[starts]
    return steps, times[order]


def _places(steps: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """What ``_steps`` was made from."""
    total = np.cumsum(steps)
    starts = np.concatenate(([0], np.cumsum(sizes)))[:-1]
    before = np.concatenate(([0], total))[starts]
    return total - np.repeat(before, sizes)


def _specials(tokenizer: str) -> list[str]:
    """Strings of added tokens, the longest first."""
    from tokenizers import Tokenizer
    return sorted({t.content for t in Tokenizer.from_str(tokenizer).get_added_tokens_decoder().values()},
                  key=len, reverse=True)


def _tokenizer(text: str):
    """The tokenizer of a ``.json`` text: one for each worker process, which works in its own thread alone."""
    import os

    import tokenizers
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    # Task code is unpickled for every task, so what a process keeps hangs on a module that stays.
    kept = tokenizers.__dict__.setdefault("monthwise_kept", {})
    if text not in kept:
        kept.clear()
        kept[text] = tokenizers.Tokenizer.from_str(text)
        kept[text].encode_special_tokens = True  # pre-tokens are plain text
    return kept[text]


SCHEMA = ("batch long, bucket int, ids array<long>, bytes array<long>, whole array<long>, sizes binary, "
          "places binary, times binary, lengths binary, pieces binary")
ARROW = pa.schema([("batch", pa.int64()), ("bucket", pa.int32()), ("ids", pa.list_(pa.int64())),
                   ("bytes", pa.list_(pa.int64())), ("whole", pa.list_(pa.int64())), ("sizes", pa.binary()),
                   ("places", pa.binary()), ("times", pa.binary()), ("lengths", pa.binary()),
                   ("pieces", pa.binary())])


def _split(special: list[str], buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = regex.compile(PATTERN).findall
        cut = regex.compile("|".join(map(regex.escape, special))) if special else None
        seq = 0
        for batch in batches:
            for part in pieces(batch, "text", BATCH_BYTES, 20_000):
                places: dict[str, int] = {}
                where, times, sizes, whole = array("I"), array("I"), [], []
                for text in part["text"].to_pylist():
                    text = text or ""
                    specials = 0
                    if cut is not None and any(s in text for s in special):
                        spans = cut.split(text)
                        specials = len(spans) - 1
                        found = Counter(chain.from_iterable(map(find, spans)))
                    else:
                        found = Counter(find(text))
                    where.extend(places.setdefault(piece, len(places)) for piece in found)
                    times.extend(found.values())
                    sizes.append(len(found))
                    whole.append(specials)
                number = TaskContext.get().partitionId() << 32 | seq
                seq += 1
                encoded = [p.encode() for p in places]
                del places
                bucket_of = np.fromiter((zlib.crc32(p) % buckets for p in encoded), np.int64, len(encoded))
                order = np.argsort(bucket_of, kind="stable")
                place = np.empty(len(order), dtype=np.int64)
                place[order] = np.arange(len(order))
                steps, times = _steps(place[np.asarray(where, dtype=np.int64)], np.asarray(times), sizes)
                length = pc.fill_null(pc.binary_length(part["text"]), 0)
                rows = [{"batch": number, "ids": part["id"].to_pylist(), "bytes": length.to_pylist(), "whole": whole,
                         "sizes": _pack(sizes), "places": _pack(steps), "times": _pack(times)}]
                edges = np.searchsorted(bucket_of[order], np.arange(buckets + 1))
                for bucket in np.unique(bucket_of).tolist():
                    own = [encoded[i] for i in np.sort(order[edges[bucket]:edges[bucket + 1]]).tolist()]
                    rows.append({"batch": number, "bucket": bucket, "lengths": _pack([len(p) for p in own]),
                                 "pieces": zstandard.ZstdCompressor(level=3).compress(b"".join(own))})
                yield pa.RecordBatch.from_pylist(rows, ARROW)
    return run


def _count(text: str):
    def run(key: tuple, lists: pa.Table) -> pa.Table:
        tokenizer, code, each = _tokenizer(text), {}, []
        for lengths, raw in zip(lists["lengths"], lists["pieces"]):
            raw = zstandard.ZstdDecompressor().decompress(raw.as_py())
            ends = np.cumsum(_unpack(lengths.as_py())).tolist()
            each.append(np.fromiter((code.setdefault(raw[i:j], len(code)) for i, j in zip([0, *ends], ends)),
                                    np.uint32, len(ends)))
        known, pieces = np.empty(len(code), dtype=np.uint32), iter(code)
        for begin in range(0, len(code), 500):
            some = [p.decode() for p in islice(pieces, 500)]
            known[begin:begin + len(some)] = [len(x) for x in tokenizer.encode_batch_fast(some, add_special_tokens=False)]
        return pa.table({"batch": lists["batch"], "bucket": lists["bucket"],
                         "counts": pa.array([_pack(known[own]) for own in each], pa.binary())})
    return run


def _sum(key: tuple, packed: pa.Table, counted: pa.Table) -> pa.Table:
    counted = counted.sort_by("bucket")
    n = np.concatenate([np.empty(0, dtype=np.int64), *map(_unpack, counted["counts"].to_pylist())])
    out = []
    for row in packed.to_pylist():
        sizes = _unpack(row["sizes"])
        each = n[_places(_unpack(row["places"]), sizes)] * _unpack(row["times"])
        edge = np.concatenate(([0], np.cumsum(sizes)))
        total = np.concatenate(([0], np.cumsum(each)))
        out.append(pa.table({"id": pa.array(row["ids"], pa.int64()), "n_bytes": pa.array(row["bytes"], pa.int64()),
                             "n_tokens": pa.array(total[edge[1:]] - total[edge[:-1]]
                                                  + np.asarray(row["whole"], dtype=np.int64), pa.int64())}))
    return pa.concat_tables(out)


def token_counts(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 512) -> DataFrame:
    """Tokens of each whole text under the byte-level vocabulary file ``tokenizer`` (a ``.json`` of `tokenizers`).

    Returns per input row: the id, ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` (n_tokens > limit).
    Null and empty texts have 0 of both; a null id is kept; repeated rows are counted each; strings of special
    tokens inside a text count as one token, as in the library.  An empty table gives an empty result.  Other
    columns are dropped, so extra names can't clash; ids are integers.
    """
    spark = docs.sparkSession
    with open(tokenizer, encoding="utf-8") as file:
        text = file.read()  # travels with the tasks: executors need not have the file
    buckets = max(partitions(spark), text_bytes(docs, text_col) // BUCKET_BYTES)
    rows = written(docs.select(col(id_col).cast("long").alias("id"), col(text_col).alias("text"))
                   .mapInArrow(_split(_specials(text), buckets), SCHEMA), "pretokens")
    counted = (rows.where("bucket IS NOT NULL").select("batch", "bucket", "lengths", "pieces").groupBy("bucket")
               .applyInArrow(_count(text), "batch long, bucket int, counts binary"))
    packed = rows.where("bucket IS NULL").select("batch", "ids", "bytes", "whole", "sizes", "places", "times")
    out = (packed.groupBy("batch").cogroup(counted.groupBy("batch"))
           .applyInArrow(_sum, "id long, n_bytes long, n_tokens long"))
    return out.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
