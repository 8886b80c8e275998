"""Toxicity by class-conditional Kneser-Ney models.

Model.  A word is spelled from its start: its first 3, 4, 5, 6 and 8 bytes, then all of it.  In either class the next
step given the spelling so far has its discounted continuation count (documents in which it occurs, so repeats in
one document add nothing) and takes the discounted rest from the counts of both classes together:

    p_c(next | so far) = (max(n_c - D, 0) + D * kinds_c * p(next | so far)) / n_c(so far)

A rare or new form of a known expression is so judged by the part that is known; a step that neither class has seen
says nothing, as its shared backoff is the same for both.  A step is known by its bytes, or for words of more than 8
bytes by these and a 64-bit hash, so no two spellings share a count.  Counts and words grow with the corpus:

1. A batch of texts is split once.  It is written as, per document, the places of its words in the batch's list with
   their frequencies; as that list, dealt by the words' first bytes into packed buckets; and as its counts of steps.
2. Spark adds up the counts of the steps of at most 8 bytes and the differences along each spelling.
3. A bucket holds the words of its share from all batches, adds up their counts and continues the differences; every
   batch gets the figures of its words back.  A word comes at most once from a batch, so no bucket is hot.

Scores.  A document's figures are the length-normalised log-likelihood difference (toxic - ordinary) of its words,
and the length-normalised parts of it beyond ``CLEAR`` thresholds, after five bytes and after whole words.  A
logistic function fitted on a sample of labelled documents kept out of the counts (a fifth of them, at most
``CALIBRATION``) turns the figures into a probability.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthwise.llm.common import col, partitions, text_bytes, written
from monthwise.llm.labels import held_out_column, labelled_ids, with_label
from monthwise.llm.words import mix, pieces, plain_words

PREFIXES = (3, 4, 5, 6, 8)
EARLY = 3
LEVELS = len(PREFIXES) + 1
DISCOUNT = 0.75
FANOUT = 64
CALIBRATION = 4096
CLEAR = (1.0, 2.0, 3.0)
BATCH_BYTES = 24 << 20
BUCKET_BYTES = 32 << 20


BATCH = ("batch long, level int, bucket int, ids array<long>, counts binary, sizes binary, places binary, "
         "times binary, heads binary, tails binary, t binary, o binary")
ARROW = pa.schema([("batch", pa.int64()), ("level", pa.int32()), ("bucket", pa.int32()),
                   ("ids", pa.list_(pa.int64())), *((c, pa.binary()) for c in (
                       "counts", "sizes", "places", "times", "heads", "tails", "t", "o"))])


def _pack(values: np.ndarray, dtype=np.uint32) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(values.astype(dtype).tobytes())


def _unpack(raw: bytes, dtype=np.uint32) -> np.ndarray:
    found = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), dtype=dtype)
    return found.astype(np.int64) if dtype == np.uint32 else found


def _ascending(raw: bytes) -> np.ndarray:
    return np.cumsum(_unpack(raw, np.uint64), dtype=np.uint64)


def _distances(values: np.ndarray) -> bytes:
    return _pack(np.diff(values, prepend=values.dtype.type(0)), np.uint64)


def _split(buckets: int):
    """Batches of (id, text, y) as rows of ``BATCH``: the documents (no level), the words by bucket (the last level)
    and the steps of each level before.  Heads, and the places of a document, ascend and are written as distances."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seq = 0
        for batch in batches:
            for part in pieces(batch, "text", BATCH_BYTES, 20_000):
                found = [plain_words(p["text"].to_pylist()) for p in pieces(part, "text")]
                counts, heads, tails = (np.concatenate(x) for x in zip(*found))
                y = part["y"].fill_null(-1).to_numpy()
                order = np.lexsort((tails, heads, mix(heads) % np.uint64(buckets)))
                heads, tails = heads[order], tails[order]
                new = np.ones(len(order), dtype=bool)
                new[1:] = (heads[1:] != heads[:-1]) | (tails[1:] != tails[:-1])
                place = np.empty(len(order), dtype=np.int64)
                place[order] = np.cumsum(new) - 1
                heads, tails = heads[new], tails[new]
                del order, new
                size = max(len(heads), 1)
                pairs, times = np.unique(np.repeat(np.arange(part.num_rows), counts) * size + place,
                                         return_counts=True)
                doc, place = np.divmod(pairs, size)
                distance = np.diff(place, prepend=0)
                start = np.diff(doc, prepend=-1) > 0
                distance[start] = place[start]
                number = TaskContext.get().partitionId() << 32 | seq
                seq += 1
                rows = [{"batch": number, "ids": part["id"].to_pylist(), "counts": _pack(counts),
                         "sizes": _pack(np.bincount(doc, minlength=part.num_rows)), "places": _pack(distance),
                         "times": _pack(times)}]
                used = y[doc] >= 0
                doc, place = doc[used], place[used]

                def seen(step: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
                    """Toxic and ordinary documents with each of ``n`` steps, from the step of every word."""
                    both = np.unique(doc * max(n, 1) + step[place])  # noqa: B023
                    at, of = both % max(n, 1), y[both // max(n, 1)]  # noqa: B023
                    return np.bincount(at[of == 1], minlength=n), np.bincount(at[of == 0], minlength=n)

                for level, n in enumerate(PREFIXES):
                    steps, step = np.unique(heads & np.uint64((1 << 8 * n) - 1), return_inverse=True)
                    t, o = seen(step, len(steps))
                    rows.append({"batch": number, "level": level, "heads": _distances(steps), "t": _pack(t),
                                 "o": _pack(o)})
                t, o = seen(np.arange(len(heads)), len(heads))
                edges = np.searchsorted(mix(heads) % np.uint64(buckets), np.arange(buckets + 1, dtype=np.uint64))
                for bucket in np.flatnonzero(np.diff(edges)).tolist():
                    own = slice(edges[bucket], edges[bucket + 1])
                    rows.append({"batch": number, "level": LEVELS - 1, "bucket": bucket, "heads": _distances(heads[own]),
                                 "tails": _pack(tails[own], np.uint64), "t": _pack(t[own]), "o": _pack(o[own])})
                yield pa.RecordBatch.from_pylist(rows, ARROW)
    return run


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per step of a batch: labelled documents with it, toxic and ordinary."""
    for batch in batches:
        for row in batch.to_pylist():
            heads = _ascending(row["heads"])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(heads), row["level"], dtype=np.int32)), pa.array(heads.view(np.int64)),
                 pa.array(_unpack(row["t"])), pa.array(_unpack(row["o"]))], ["level", "head", "t", "o"])


def _dealt(buckets: int):
    """Rows of (head, early, whole) with the bucket of their words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of = (mix(batch["head"].to_numpy().view(np.uint64)) % np.uint64(buckets)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(of), *batch.columns], ["of", *batch.schema.names])
    return run


def _bucket(key: tuple, packed: pa.Table, before: pa.Table) -> pa.Table:
    """Per batch and bucket: the differences of its words, summed along the spelling, early and whole."""
    rows = packed.select(["heads", "tails", "t", "o"]).to_pylist()
    if not rows:
        return pa.table({c: pa.array([], t) for c, t in (("batch", pa.int64()), ("bucket", pa.int32()),
                                                         ("early", pa.binary()), ("whole", pa.binary()))})
    parts = [_ascending(r["heads"]) for r in rows]
    heads, tails = np.concatenate(parts), np.concatenate([_unpack(r["tails"], np.uint64) for r in rows])
    order = np.lexsort((tails, heads))
    heads, tails = heads[order], tails[order]
    new = np.ones(len(heads), dtype=bool)
    new[1:] = (heads[1:] != heads[:-1]) | (tails[1:] != tails[:-1])
    word = np.cumsum(new) - 1
    t, o = (np.bincount(word, weights=np.concatenate([_unpack(r[c]) for r in rows])[order]) for c in "to")
    of, head = np.unique(heads[new], return_inverse=True)
    add = lambda x: np.bincount(head, weights=x)[head]
    all_t, all_o = add(t), add(o)
    both = np.maximum(all_t + all_o, 1)
    shared = (np.maximum(t + o - DISCOUNT, 0) + DISCOUNT * add(t + o > 0) / FANOUT) / both
    logs = []
    for n, total in ((t, all_t), (o, all_o)):
        p = (np.maximum(n - DISCOUNT, 0) + DISCOUNT * add(n > 0) * shared) / np.maximum(total, 1)
        logs.append(np.log(np.where(t + o > 0, np.where(total > 0, p, shared), 1)))
    known = before["head"].to_numpy().view(np.uint64)
    sort = np.argsort(known)
    at = sort[np.searchsorted(known, of, sorter=sort)][head]
    early = before["early"].to_numpy()[at]
    whole = before["whole"].to_numpy()[at] + logs[0] - logs[1]
    back = np.empty(len(order), dtype=np.int64)
    back[order] = word
    ends = np.cumsum([len(p) for p in parts])
    out = {c: pa.array([_pack(x[back[e - len(p):e]], np.float32) for p, e in zip(parts, ends)], pa.binary())
           for c, x in (("early", early), ("whole", whole))}
    return pa.table({"batch": packed["batch"], "bucket": packed["bucket"], **out})


def _figured(key: tuple, packed: pa.Table, found: pa.Table) -> pa.Table:
    """Per document: 1, mean difference, and per stage and threshold the mean beyond it (log of 1 + 100 times)."""
    found = found.sort_by("bucket")
    early, whole = (np.concatenate([np.empty(0), *(_unpack(v, np.float32) for v in found[c].to_pylist())])
                    for c in ("early", "whole"))
    out = []
    for row in packed.to_pylist():
        sizes, times, counts = (_unpack(row[c]) for c in ("sizes", "times", "counts"))
        total = np.concatenate(([0], np.cumsum(_unpack(row["places"]))))
        starts = np.concatenate(([0], np.cumsum(sizes)))[:-1]
        at = total[1:] - np.repeat(total[starts], sizes)
        doc = np.repeat(np.arange(len(sizes)), sizes)
        mean = lambda v: (np.bincount(doc, weights=v[at] * times, minlength=len(counts))
                          / np.maximum(counts, 1))
        x = [np.ones(len(counts)), mean(whole)]
        x += [np.log1p(100 * mean(np.maximum(v - c, 0))) for v in (early, whole) for c in CLEAR]
        out.append(pa.table({"id": pa.array(row["ids"], pa.int64()),
                             "x": pa.array(np.stack(x, axis=1).tolist(), pa.list_(pa.float64()))}))
    return pa.concat_tables(out)


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1, rounds: int = 100) -> np.ndarray:
    """Weights of a logistic function by Newton's method; the first column of ``x`` is the constant."""
    w = np.zeros(x.shape[1])
    penalty = np.full(len(w), ridge)
    penalty[0] = 1e-3
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(penalty),
                               x.T @ (y - p) - penalty * w)
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return w


def step_differences(batches: DataFrame) -> DataFrame:
    """(head, early, whole): of all words' first 8 bytes the log-likelihood differences of their steps, each given the
    one before, summed over the steps before ``EARLY`` and over all."""
    counts = (batches.where(f"level < {LEVELS - 1}").select("level", "heads", "t", "o")
              .mapInArrow(_counted, "level int, head long, t long, o long")
              .groupBy("level", "head").agg(F.sum("t").alias("t"), F.sum("o").alias("o")))
    counts = written(counts, "counts")
    shared = f"(greatest(t + o - {DISCOUNT}D, 0) + {DISCOUNT}D * kinds / {FANOUT}) / greatest(all_t + all_o, 1)"
    p = lambda c: (f"IF(all_{c} > 0, (greatest({c} - {DISCOUNT}D, 0) + {DISCOUNT}D * kinds_{c} * shared) / all_{c}, "  # noqa: E731
                   "shared)")
    sums = None
    for level in range(LEVELS - 1):
        before = F.col("head").bitwiseAND(F.lit((1 << 8 * PREFIXES[level - 1]) - 1 if level else 0).cast("long"))
        own = counts.where(F.col("level") == level).select(before.alias("before"), "head", "t", "o")
        totals = own.groupBy("before").agg(
            F.sum("t").alias("all_t"), F.sum("o").alias("all_o"), F.expr("count_if(t + o > 0)").alias("kinds"),
            F.expr("count_if(t > 0)").alias("kinds_t"), F.expr("count_if(o > 0)").alias("kinds_o"))
        if level:
            totals = totals.join(sums, F.expr("before = of")).drop("of")
        else:  # one row
            totals = F.broadcast(totals.withColumn("early", F.lit(0.0)).withColumn("whole", F.lit(0.0)))
        d = F.expr(f"IF(t + o > 0, ln({p('t')}) - ln({p('o')}), 0D)")
        sums = own.join(totals, "before").withColumn("shared", F.expr(f"CAST({shared} AS DOUBLE)")).select(
            F.col("head").alias("of"), (F.col("early") + d if level < EARLY else F.col("early")).alias("early"),
            (F.col("whole") + d).alias("whole"))
    return sums.withColumnRenamed("of", "head")


def figures(docs: DataFrame) -> DataFrame:
    """(id, x): the figures of every document of (id, text, y); those with a y are counted."""
    spark = docs.sparkSession
    buckets = max(partitions(spark), text_bytes(docs, "text") // BUCKET_BYTES)
    batches = written(docs.select("id", "text", "y").mapInArrow(_split(buckets), BATCH), "words")
    sums = written(step_differences(batches), "sums")
    found = (batches.where(f"level = {LEVELS - 1}").select("batch", "bucket", "heads", "tails", "t", "o")
             .groupBy("bucket").cogroup(sums.mapInArrow(_dealt(buckets), "of int, head long, early double, whole double")
                                        .groupBy("of"))
             .applyInArrow(_bucket, "batch long, bucket int, early binary, whole binary"))
    return (batches.where("level IS NULL").select("batch", "ids", "counts", "sizes", "places", "times").groupBy("batch")
            .cogroup(found.groupBy("batch")).applyInArrow(_figured, "id long, x array<double>"))


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   label_col: str = "toxic", folds: int = 4, held_out: int = 2, threshold: float = 0.3) -> DataFrame:
    """Score every whole text; learn only from rows whose crc32(id as text) mod ``folds`` is not ``held_out``.

    Returns per input row: the id, ``held_out``, ``score`` (0 to 1) and ``predicted`` (1 from ``threshold`` on).
    Null and empty texts get the score of no evidence.  Null labels and labels without a document teach nothing;
    repeated label rows take their mean (0.5 counts as 1); without labels every score is 0.5.  A null id is scored
    and not held out; repeated rows are scored each.  An empty table gives an empty result.  Other columns are
    dropped, so extra names can't clash.
    """
    ids = labelled_ids(labels, id_col, label_col, folds, held_out)
    kept_out = (ids.where(F.pmod(F.xxhash64("id"), F.lit(5)) == 0).orderBy(F.xxhash64("id", F.lit(1)), "id")
                .limit(CALIBRATION))
    kept_out = written(kept_out, "calibration")
    rows = docs.select(col(id_col).cast("long").alias("id"), col(text_col).alias("text"))
    found = figures(with_label(rows, ids.join(F.broadcast(kept_out), "id", "left_anti")))
    found = written(found, "figures")
    known = found.join(F.broadcast(kept_out), "id").select("y", "x").toArrow()
    x = np.array(known["x"].to_pylist(), dtype=np.float64).reshape(known.num_rows, 2 + 2 * len(CLEAR))
    weights = fit_logistic(x, known["y"].to_numpy().astype(np.float64))
    z = sum((F.col("x")[i] * float(w) for i, w in enumerate(weights)), F.lit(0.0))
    score = 1 / (1 + F.exp(-F.greatest(F.lit(-50.0), F.least(F.lit(50.0), z))))
    return found.select("id", score.alias("score")).select(
        F.col("id").alias(id_col), held_out_column("id", folds, held_out), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))
