"""Benchmark decontamination with DataFrame functions only.

The windows of the benchmark (``window`` consecutive words; a shorter item is one window) form a hash table.  Every
window of every document is hashed in one pass of generated code and looked up; equal hashes are verified on the words.
Spark broadcasts the table by its size in bytes, and then only hits are shuffled; beyond that size both sides are dealt
by the hash, a document's window travelling with its own words alone, so bytes grow with the text, not with its square.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthwise.llm.common import col, without

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BETWEEN_ANY_CASE = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """The words of a text after lower-casing A-Z; null has none."""
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(lowered, BETWEEN), "")


def benchmark_windows(benchmark: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """Distinct windows: ``key`` (hash), ``len``, ``seq`` (its words), ``items`` (ids in which it occurs)."""
    items = (benchmark.where(col(id_col).isNotNull())
             .select(col(id_col).cast("string").alias("item"), words(col(text_col)).alias("w")).where("size(w) > 0"))
    at = items.select("item", "w", F.expr(f"explode(sequence(0, greatest(size(w) - {window}, 0)))").alias("p"))
    seqs = at.select("item", F.expr(f"slice(w, p + 1, {window})").alias("seq"))
    return (seqs.groupBy("seq").agg(F.collect_set("item").alias("items"))
            .select(F.xxhash64("seq").alias("key"), F.size("seq").alias("len"), "seq", "items"))


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text: str = "text", window: int = 13, share: int = 20,
                  carry: tuple[str, ...] = ()) -> DataFrame:
    """Mark the document words that lie in any occurrence of a benchmark window.

    Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z.  Returns per input row: the id,
    ``carry`` columns, ``n_words``, ``n_hit``, ``n_items`` (items with occurring windows), ``items`` (their ids as
    text, sorted), ``spans`` (maximal hit intervals [start, end) of word positions) and ``contaminated``
    (``n_hit > 0`` and ``share * n_hit >= n_words``).

    Null and empty texts have no words and are clean; so is everything against an empty benchmark.  Items with a
    null id, or without words, take no part; rows that repeat an item's id belong to that item.  Null ids and
    repeated rows get their own rows with the same figures as any row of that text.  An empty table gives an empty
    result.  Columns not named are dropped, and a result
    column takes the place of a carried one of its name.
    """
    carry = without(carry, id_col, "n_words", "n_hit", "n_items", "items", "spans", "contaminated")
    found = benchmark_windows(benchmark, item_col, item_text, window)
    lengths = [r["len"] for r in found.select("len").distinct().collect()]  # ``window`` at most
    rows = docs.select(col(id_col).alias("id"), F.xxhash64(col(text_col)).alias("h"), words(col(text_col)).alias("w"))
    at = rows.select("id", "h", "w", F.posexplode("w").alias("p", "first")).drop("first")
    if len(lengths) == 1:
        at = at.withColumn("n", F.lit(lengths[0]))
    else:
        at = at.withColumn("n", F.explode(F.array(*[F.lit(n) for n in sorted(lengths)]).cast("array<int>")))
    at = at.where("p + n <= size(w)").select("id", "h", "p", "n", F.expr("slice(w, p + 1, n)").alias("own"))
    hits = at.withColumn("key2", F.xxhash64("own")).join(found, F.expr("key2 = key AND n = len AND own = seq"))
    per_doc = hits.select("id", "h", "p", "n", "items").groupBy("id", "h").agg(
        F.sort_array(F.collect_set(F.struct("p", (F.col("p") + F.col("n")).alias("e")))).alias("all"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    merged = """aggregate(all, array(all[0]), (acc, x) -> IF(element_at(acc, -1).e >= x.p,
        concat(slice(acc, 1, size(acc) - 1),
               array(named_struct('p', element_at(acc, -1).p, 'e', greatest(element_at(acc, -1).e, x.e)))),
        concat(acc, array(x))))"""
    per_doc = per_doc.select(F.col("id").alias("hid"), F.col("h").alias("hh"), "items", F.expr(
        f"transform({merged}, x -> named_struct('start', CAST(x.p AS BIGINT), 'end', CAST(x.e AS BIGINT)))")
        .alias("spans"))
    n_words = F.size(F.array_remove(F.split(F.coalesce(col(text_col), F.lit("")), BETWEEN_ANY_CASE), ""))
    carried = [f"carry{i}" for i in range(len(carry))]
    out = docs.select(col(id_col).alias("id"), F.xxhash64(col(text_col)).alias("h"), n_words.cast("long").alias("n_words"),
                      *[col(c).alias(n) for c, n in zip(carry, carried)])
    out = out.join(per_doc, F.expr("id <=> hid AND h = hh"), "left")
    none = "CAST(array() AS array<string>)"
    out = (out.withColumn("items", F.coalesce("items", F.expr(none)))
           .withColumn("spans", F.coalesce("spans", F.expr("CAST(array() AS array<struct<start:bigint,end:bigint>>)")))
           .withColumn("n_hit", F.expr("aggregate(spans, 0L, (n, s) -> n + s.end - s.start)")))
    return out.select(F.col("id").alias(id_col), *[F.col(n).alias(c) for c, n in zip(carry, carried)], "n_words",
                      "n_hit", F.size("items").cast("long").alias("n_items"), "items", "spans",
                      F.expr(f"n_hit > 0 AND {share} * n_hit >= n_words").alias("contaminated"))
