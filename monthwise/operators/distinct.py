"""Exact distinct counts from partial tables that add up (over months, folders or runs).

Integer ids fall into ranges of 32768.  Per group and range the places taken are
kept as a short list, or as a bitmap where there are more than ``DENSE`` of
them, so neither scattered nor dense ids cost much; a list or bitmap has at most
32768 places however many rows there are.  Ids that are no integers can't be
places; they are kept as they are.  Null ids count nothing, but keep their
group.  Merging partial tables unites lists and bitmaps; a count adds up sizes.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthwise.functions.flags import q

DENSE = 1024
STATE = ["id_range", "places", "bits", "other"]


def _as_state(df: DataFrame, keys: list, **have: str) -> DataFrame:
    types = {"id_range": "bigint", "places": "array<bigint>", "bits": "binary", "other": "string"}
    return df.selectExpr(*[q(k) for k in keys], *[f"CAST({have.get(c, 'NULL')} AS {t}) AS {c}" for c, t in types.items()])


def _from_places(placed: DataFrame, keys: list) -> DataFrame:
    """State rows of (keys, id_range, place) rows: lists, or bitmaps where they are long."""
    by = [*keys, "id_range"]
    lists = placed.groupBy(*by).agg(F.collect_set("place").alias("places"))
    short = lists.where(f"size(places) <= {DENSE}")
    long = (lists.where(f"size(places) > {DENSE}").select(*by, F.explode("places").alias("place"))
            .groupBy(*by).agg(F.expr("bitmap_construct_agg(place) AS bits")))
    return _as_state(short, keys, id_range="id_range", places="places").unionByName(
        _as_state(long, keys, id_range="id_range", bits="bits"))


def distinct_partials(df: DataFrame, keys: list, id_col: str) -> DataFrame:
    """The partial table of ``df``: keys and state columns, to be stored and merged."""
    number = f"try_cast({q(id_col)} AS BIGINT)"
    # '007' and '7' are two ids: only the plain form of a number stands for it.
    rows = df.selectExpr(*[q(k) for k in keys], f"CAST({q(id_col)} AS STRING) AS __id",
                         f"CASE WHEN CAST({number} AS STRING) = CAST({q(id_col)} AS STRING) THEN {number} END AS __n")
    placed = rows.where("__n IS NOT NULL").selectExpr(
        *[q(k) for k in keys], "bitmap_bucket_number(__n) AS id_range", "bitmap_bit_position(__n) AS place")
    others = rows.where("__n IS NULL").selectExpr(*[q(k) for k in keys], "__id").distinct()
    return _from_places(placed, keys).unionByName(_as_state(others, keys, other="__id"))


def merge_partials(parts: list[DataFrame], keys: list) -> DataFrame:
    """One partial table that stands for all of ``parts``."""
    every = reduce(DataFrame.unionByName, parts)
    by = [*keys, "id_range"]
    dense = every.where("bits IS NOT NULL").select(*by, "bits")
    placed = every.where("places IS NOT NULL").select(*by, F.explode("places").alias("place"))
    same = F.expr(" AND ".join(f"a.{q(c)} <=> b.{q(c)}" for c in by))
    ranges = dense.select(*by).distinct().alias("b")
    # Lists of a range that also has a bitmap become a bitmap; bitmaps are united.
    into = (placed.alias("a").join(ranges, same, "left_semi").groupBy(*by)
            .agg(F.expr("bitmap_construct_agg(place) AS bits")))
    bitmaps = dense.unionByName(into).groupBy(*by).agg(F.expr("bitmap_or_agg(bits) AS bits"))
    lists = _from_places(placed.alias("a").join(ranges, same, "left_anti"), keys)
    others = every.where("id_range IS NULL").selectExpr(*[q(k) for k in keys], "other").distinct()
    return (lists.unionByName(_as_state(bitmaps, keys, id_range="id_range", bits="bits"))
            .unionByName(_as_state(others, keys, other="other")))


def distinct_counts(partials: DataFrame, keys: list, out: str) -> DataFrame:
    """Exact distinct ids per group of a (merged) partial table."""
    size = ("CASE WHEN bits IS NOT NULL THEN bitmap_count(bits) WHEN places IS NOT NULL THEN size(places) "
            "WHEN other IS NOT NULL THEN 1 ELSE 0 END")
    return partials.groupBy(*keys).agg(F.expr(f"CAST(sum({size}) AS BIGINT) AS {q(out)}"))
