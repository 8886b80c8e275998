"""MinHash near-dedup: one-permutation hashing, optimal densification, banded buckets, star-shaped candidates.

1. Each text becomes its set of distinct ``shingle``-word shingles (64-bit hashes), a 128-bit fingerprint of that
   set, and a one-permutation signature: the hash range is cut into ``bands * rows`` bins, a bin holds its smallest
   hash, and an empty bin copies a filled one that a fixed random order of the bins chooses for it.
2. Texts with equal sets form a class (one aggregate, however many copies); only a class's smallest id goes on.
   Sets too small to reach the threshold without being equal stop here.
3. Every band of a signature names a bucket.  Per bucket one centre is compared with the members: pairs grow with
   the members, never with their square.
4. Candidate pairs are confirmed on the full sets; links make components (large-star, small-star).
5. Members of buckets that are not in one component yet are completed exactly: each names new buckets by its
   rarest shingles among them (of two sets at the threshold, both hold one of the ``n - ceil(share * n) + 1`` rarest
   of each), and a bucket takes further centres, one from each of ``CENTRES`` shares of its components, against the
   members outside the centre's component, until every pair in it is in one component or compared.  Edited copies
   of one text that aren't near each other rarely share a rare shingle, so these pairs stay few as well.

So stars lose no link that the bands find, and ``bands_for`` takes as many bands as miss a pair at the threshold with
a probability of at most ``MISS``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from monthwise.llm.common import col, without, written
from monthwise.llm.components import components
from monthwise.llm.words import U, mix, pieces, shingle_sets

MISS = 1e-8
CENTRES, MORE_CENTRES = 64, 16


def bands_for(percent: int) -> tuple[int, int]:
    """Bands and rows a band: rows keep chance pairs apart, bands keep pairs at the threshold together."""
    share = percent / 100
    rows = 7 if percent >= 85 else 6
    return (math.ceil(math.log(MISS) / math.log(1 - share ** rows)) if percent < 100 else 1), rows


def _orders(bins: int) -> np.ndarray:
    """Row ``i``: the order in which empty bin ``i`` asks the others; the same everywhere."""
    rng = np.random.default_rng(20240229)
    return np.stack([rng.permutation(bins) for _ in range(bins)])


def signatures(doc: np.ndarray, h: np.ndarray, n: int, bins: int, orders: np.ndarray) -> np.ndarray:
    """One-permutation signatures of ``n`` sets given as (document, hash) in order; empty sets stay zero."""
    where = ((h >> U(32)) * U(bins) >> U(32)).astype(np.int64)
    first = np.ones(len(h), dtype=bool)
    first[1:] = (doc[1:] != doc[:-1]) | (where[1:] != where[:-1])
    sig = np.zeros((n, bins), dtype=U)
    full = np.zeros((n, bins), dtype=bool)
    sig[doc[first], where[first]] = h[first]
    full[doc[first], where[first]] = True
    row, slot = np.nonzero(~full & full.any(axis=1)[:, None])
    for step in range(bins):
        if not len(row):
            break
        ask = orders[slot, step]
        got = full[row, ask]
        sig[row[got], slot[got]] = sig[row[got], ask[got]]
        row, slot = row[~got], slot[~got]
    return sig


def _sketch(shingle: int, bands: int, rows: int, carried: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        orders = _orders(bands * rows)
        odd = mix(np.arange(1, rows + 1, dtype=U), 1) | U(1)
        own = mix(np.arange(1, bands + 1, dtype=U), 2)
        for batch in batches:
            for part in pieces(batch, "text", 1 << 20):
                n = part.num_rows
                doc, h = shingle_sets(part["text"].to_pylist(), shingle)
                size = np.bincount(doc, minlength=n)
                fp = []
                for seed in (3, 4):
                    total = np.concatenate((np.zeros(1, dtype=U), np.cumsum(mix(h, seed))))
                    edge = np.concatenate(([0], np.cumsum(size)))
                    fp.append((total[edge[1:]] - total[edge[:-1]]).view(np.int64))
                sig = signatures(doc, h, n, bands * rows, orders).reshape(n, bands, rows)
                keys = mix((sig * odd).sum(axis=2, dtype=U) + own)[size > 0]
                ends = np.concatenate(([0], np.cumsum((size > 0) * bands))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part["id"], pa.array(size, pa.int64()), pa.array(fp[0]), pa.array(fp[1]),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(keys.reshape(-1).view(np.int64))),
                     *[part[c] for c in carried]],
                    ["id", "n", "fp1", "fp2", "keys", *carried])
    return run


def _shingles(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text", 1 << 20):
                doc, h = shingle_sets(part["text"].to_pylist(), shingle)
                n = np.bincount(doc, minlength=part.num_rows)
                yield pa.RecordBatch.from_arrays(
                    [part["id"].take(pa.array(doc)), pa.array(n[doc]), pa.array(h.view(np.int64))], ["rep", "n", "h"])
    return run


def _rare_buckets(texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """(key, rep, n, at): each text under its rarest shingles, as many as a set at the threshold can't do without;
    ``at`` is the place of the shingle among the text's, from the rarest."""
    rows = texts.mapInArrow(_shingles(shingle), "rep long, n long, h long")
    often = rows.groupBy("h").agg(F.count("*").alias("k"))
    rarest = Window.partitionBy("rep").orderBy("k", "h")
    need = F.expr(f"n - ceil({percent} * n / 100) + 1")
    ranked = rows.join(often, "h").withColumn("at", F.row_number().over(rarest)).where(F.col("at") <= need)
    return ranked.where("k > 1").select(F.col("h").alias("key"), "rep", "n", "at")


def _confirm(shingle: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "ta", 2 << 20):
                n = part.num_rows
                doc_a, a = shingle_sets(part["ta"].to_pylist(), shingle)
                doc_b, b = shingle_sets(part["tb"].to_pylist(), shingle)
                doc, h = np.concatenate((doc_a, doc_b)), np.concatenate((a, b))
                order = np.lexsort((h, doc))
                doc, h = doc[order], h[order]
                both = np.bincount(doc[1:][(doc[1:] == doc[:-1]) & (h[1:] == h[:-1])], minlength=n)
                either = np.bincount(doc, minlength=n) - both
                yield part.select(["a", "b"]).filter(pa.array(100 * both >= percent * either))
    return run


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5,
                    percent: int = 80, carry: tuple[str, ...] = ()) -> DataFrame:
    """Link documents with ``100 * |A & B| >= percent * |A | B|`` on their sets of ``shingle``-word shingles.

    Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z; with fewer words than ``shingle`` the whole sequence
    is the one shingle.  Returns per input row: the id, ``carry`` columns (narrow ones: they are written along),
    ``n_shingles``, ``component_id`` (smallest id reachable, itself included) and ``kept`` (id = component_id).

    Null, empty and blank texts: ``n_shingles`` 0, linked with nothing, kept.  Null id: the row takes no part,
    ``component_id`` null and ``kept`` true.  Repeated rows are linked like any copies; texts that share an id are
    one document where that id is the smallest of its class.  Ties can't occur: ids order the choice.  An empty
    table gives an empty result.  Other columns are dropped, so extra names can't clash; ids are integers.
    """
    bands, rows = bands_for(percent)
    carry = without(carry, id_col, "n_shingles", "component_id", "kept")
    carried = [f"carry{i}" for i in range(len(carry))]
    rows_in = docs.select(col(id_col).cast("long").alias("id"), col(text_col).alias("text"),
                          *[col(c).alias(n) for c, n in zip(carry, carried)])
    fields = StructType.fromDDL("id long, n long, fp1 long, fp2 long, keys array<long>").fields
    sketch = written(rows_in.mapInArrow(_sketch(shingle, bands, rows, carried),
                                        StructType([*fields, *[rows_in.schema[n] for n in carried]])), "sketch")
    rows_in = rows_in.select("id", "text")
    known = sketch.where("n > 0 AND id IS NOT NULL")
    smallest = math.ceil(percent / (100 - percent)) if percent < 100 else 2 ** 62
    classes = known.groupBy("fp1", "fp2", "n").agg(F.min("id").alias("rep"))
    members = (known.where(F.col("n") >= smallest).groupBy("fp1", "fp2", "n")
               .agg(F.min("id").alias("rep"), F.min_by("keys", "id").alias("keys"))
               .select("rep", "n", F.explode("keys").alias("key")))
    members = written(members, "members")
    crowded = members.groupBy("key").agg(F.min(F.struct("rep", "n")).alias("centre"), F.count("*").alias("k"))
    crowded = written(members.join(crowded.where("k > 1").select("key", "centre"), "key"), "buckets")
    texts = written(rows_in.where("id IS NOT NULL AND text IS NOT NULL").join(
        crowded.select(F.col("rep").alias("id")).distinct(), "id", "left_semi"), "texts")
    fits = F.expr(f"100 * least(n, centre.n) >= {percent} * greatest(n, centre.n)")

    def confirmed(pairs: DataFrame) -> DataFrame:
        both = pairs.join(texts.selectExpr("id AS a", "text AS ta"), "a").join(
            texts.selectExpr("id AS b", "text AS tb"), "b")
        return both.select("a", "b", "ta", "tb").mapInArrow(_confirm(shingle, percent), "a long, b long")

    tested = written(crowded.where("rep != centre.rep").where(fits)
                     .select(F.col("rep").alias("a"), F.col("centre.rep").alias("b")).distinct(), "pairs")
    found = components(confirmed(tested), "a", "b")
    component_of = lambda df: df.join(found.withColumnRenamed("node", "rep"), "rep", "left").withColumn(
        "c", F.coalesce("component", "rep"))
    torn = (component_of(crowded.select("key", "rep")).groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi"))
            .where("lo != hi").select("key"))
    torn = crowded.join(torn, "key", "left_semi").select(F.col("rep").alias("id")).distinct()
    left = _rare_buckets(texts.join(torn, "id", "left_semi"), shingle, percent)
    # A pair at the threshold meets under its first common shingle, where what follows must still suffice.
    enough = F.expr(f"{100 + percent} * (1 + least(n - at, centre.n - centre.at)) >= {percent} * (n + centre.n)")
    centres = CENTRES
    while True:
        now = written(component_of(left).select("key", "rep", "n", "at", "c"), "members")
        each = now.groupBy("key", "c").agg(F.min(F.struct("rep", "n", "at")).alias("r"), F.count("*").alias("k"))
        shares = (each.groupBy("key", F.pmod(F.xxhash64("c"), F.lit(centres)).alias("share"))
                  .agg(F.min(F.struct("k", "r", "c")).alias("pick"), F.min("c").alias("lo"), F.max("c").alias("hi")))
        shares = written(shares, "shares")
        # Combined before the shuffle: a key with many shares is no large group.
        torn = shares.groupBy("key").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).where("lo != hi").select("key")
        shares = written(shares.join(torn, "key", "left_semi").select(
            "key", F.struct("pick.r.rep", "pick.r.n", "pick.r.at", "pick.c").alias("centre")), "centres")
        if shares.isEmpty():
            break
        paired = now.join(shares, "key")
        new = paired.where("c != centre.c").where(fits).where(enough).select(
            F.greatest("rep", "centre.rep").alias("a"), F.least("rep", "centre.rep").alias("b")).distinct()
        new = written(new.join(tested, ["a", "b"], "left_anti"), "pairs")
        tested = tested.unionByName(new)
        more = written(confirmed(new), "linked")
        if not more.isEmpty():
            found = components(found.selectExpr("node AS a", "component AS b").unionByName(more), "a", "b")
        left = now.join(shares.select("key").distinct(), "key", "left_semi").join(
            shares.select("key", F.col("centre.rep").alias("rep")), ["key", "rep"], "left_anti").drop("c")
        centres *= MORE_CENTRES

    per_class = classes.join(found.select(F.col("node").alias("rep"), "component"), "rep", "left").select(
        "fp1", "fp2", "n", F.coalesce("component", "rep").alias("component"))
    out = sketch.drop("keys").join(per_class, ["fp1", "fp2", "n"], "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return out.select(F.col("id").alias(id_col), *[F.col(n).alias(c) for c, n in zip(carry, carried)],
                      F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"))
