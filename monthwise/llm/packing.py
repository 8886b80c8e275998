"""Packing by optimal length buckets.

The exact histogram of lengths goes to the driver.  Different lengths are few: as many need at least half their
square of tokens, so all texts together, T tokens, have at most sqrt(2 T) of them.  Dynamic programming over it chooses at most ``buckets`` boundaries so that
padding every document to its boundary adds the fewest tokens in all.  Inside a bucket, documents form batches of at
most ``budget`` padded tokens.  Positions in a bucket are counted in shares (by a number given to each row, or by
id on request) and offset by the shares before, so no task holds a whole bucket.
"""

from __future__ import annotations

from array import array

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from monthwise.llm.common import col, partitions, without, written

SHARE_ROWS = 100_000
BLANKS = r"[\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text; null has none."""
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANKS), "")).cast("long")


def best_boundaries(histogram: list[tuple[int, int]], buckets: int) -> list[int]:
    """Boundaries (ascending, the last is the longest length) with the least padding over ``(length, count)`` pairs.

    The cost of lengths i+1..j is ``length[j] * count - tokens``; for each number of buckets the best start is the
    lowest of lines in ``length[j]``, kept as a convex hull.
    """
    lengths = [n for n, _ in sorted(histogram)]
    if not lengths:
        return []
    count, tokens = [0], [0]
    for n, k in sorted(histogram):
        count.append(count[-1] + k)
        tokens.append(tokens[-1] + n * k)
    m = len(lengths)
    best = [0] + [lengths[j - 1] * count[j] - tokens[j] for j in range(1, m + 1)]
    starts = [array("l", [0]) * (m + 1)]
    for _ in range(1, min(buckets, m)):
        hull: list[tuple[int, int, int]] = []  # (slope, height, start) with falling slopes
        at, now, start = 0, [0] * (m + 1), [0] * (m + 1)
        for j in range(1, m + 1):
            slope, height = -count[j - 1], best[j - 1] + tokens[j - 1]
            while len(hull) >= 2:
                (s1, h1, _), (s2, h2, _) = hull[-2], hull[-1]
                if (h2 - h1) * (s2 - slope) >= (height - h2) * (s1 - s2):
                    hull.pop()
                else:
                    break
            hull.append((slope, height, j - 1))
            at = min(at, len(hull) - 1)
            x = lengths[j - 1]
            while at + 1 < len(hull) and hull[at + 1][0] * x + hull[at + 1][1] <= hull[at][0] * x + hull[at][1]:
                at += 1
            now[j] = hull[at][0] * x + hull[at][1] + x * count[j] - tokens[j]
            start[j] = hull[at][2]
        best = now
        starts.append(array("l", start))
    ends, j = [], m
    for start in reversed(starts):
        if j == 0:
            break
        ends.append(lengths[j - 1])
        j = start[j]
    return ends[::-1]


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int = 16, budget: int = 65_536,
         length: Column | None = None, carry: tuple[str, ...] = (),
         by_id: bool = False) -> DataFrame:
    """Put every document into a batch of documents of like length.

    ``length`` is any whole-number column (default: the words of the text, so the budget is in words; for a model's
    tokens pass their counts).  Returns per input row: the id,
    ``carry`` columns, ``length``, ``bucket`` (from 0, ascending lengths), ``padded`` (the bucket's boundary),
    ``batch`` (from 0 inside the bucket) and ``slot`` (from 0 inside the batch).  A batch holds
    ``max(1, budget // padded)`` documents, the last of a bucket perhaps fewer; a document longer than the budget is
    a batch of its own, whole.

    Null and empty texts have length 0 and are packed too, so are rows with a null id; a negative or null length
    counts as 0.  Equal ids, ties and repeated rows take their slots in any order; with ``by_id`` the
    slots of ids with at most ``SHARE_ROWS`` rows follow from the ids, not from the order that rows come in.  An empty
    table gives an empty result.  Columns not named are dropped, and a result
    column takes the place of a carried one of its name.
    """
    carry = without(carry, id_col, "length", "bucket", "padded", "batch", "slot")
    spark = docs.sparkSession
    measure = word_count(col(text_col)) if length is None else F.greatest(F.coalesce(length, F.lit(0)), F.lit(0))
    carried = [f"carry{i}" for i in range(len(carry))]
    rows = docs.select(col(id_col).alias("id"), measure.cast("long").alias("length"),
                       *[col(c).alias(n) for c, n in zip(carry, carried)])
    # Lengths are measured once.  A written number for each row spreads rows that are alike over all shares.
    rows = written(rows.withColumn("number", F.xxhash64(F.monotonically_increasing_id())), "lengths")
    histogram = [(r["n"], r["k"]) for r in
                 rows.groupBy(F.col("length").alias("n")).agg(F.count("*").alias("k")).collect()]
    ends = best_boundaries(histogram, buckets) or [0]
    shares = max(partitions(spark), -(-sum(k for _, k in histogram) // SHARE_ROWS))
    bucket = F.coalesce(*[F.when(F.col("length") <= end, i) for i, end in enumerate(ends)])
    padded = F.element_at(F.array(*[F.lit(end).cast("long") for end in ends]), F.col("bucket") + 1)
    place_by, order = F.col("number"), ["number"]
    if by_id:
        rows = rows.withColumn("spread", F.xxhash64("id"))
        # At most one id in SHARE_ROWS rows is crowded.
        crowded = (rows.groupBy("spread").agg(F.count("*").alias("k")).where(F.col("k") > SHARE_ROWS)
                   .select("spread", F.lit(True).alias("crowded")))
        rows = rows.join(F.broadcast(crowded), "spread", "left")
        place_by = F.when(F.col("crowded"), F.col("number")).otherwise(F.col("spread"))
        order = ["spread", "id", "length", "number"]
    placed = (rows.withColumn("bucket", bucket).withColumn("padded", padded)
              .withColumn("share", F.pmod(place_by, F.lit(shares))))
    sizes = placed.groupBy("bucket", "share").agg(F.count("*").alias("k"))
    before = Window.partitionBy("bucket").orderBy("share").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("bucket", "share", F.coalesce(F.sum("k").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("bucket", "share").orderBy(*order)
    counted = placed.withColumn("at", F.row_number().over(inside) - 1).join(offsets, ["bucket", "share"])
    place = F.col("offset") + F.col("at")
    capacity = F.greatest(F.lit(1), F.floor(F.lit(budget) / F.greatest("padded", F.lit(1)))).cast("long")
    return counted.select(F.col("id").alias(id_col), *[F.col(n).alias(c) for c, n in zip(carry, carried)], "length",
                          "bucket", "padded", F.floor(place / capacity).alias("batch"),
                          F.pmod(place, capacity).alias("slot"))
