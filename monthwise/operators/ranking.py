"""Ranking and picking one record per key (O4 rank_within, O5 pick_first,
O6 code_priority, O7 latest_by_date_then_priority, O8 first_last_ranks).

Sort keys are written as Columns with an explicit direction.  Spark's default
NULL placement (ascending: NULLs first, descending: NULLs last) is the one the
published rules rely on: a NULL date sorts lowest.  Every ranking gets a
unique tiebreak so results are deterministic.

``pick_first`` keeps only the top row per key.  It is an aggregate of a
row struct (``max`` over ``struct(order keys, row)``), not a window: Spark
combines it map-side, so a key holding a large share of all rows is reduced in
every task before the shuffle and never lands whole in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from monthwise.functions.flags import q
from monthwise.session import checkpoint_dir


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def rank_within(df: DataFrame, keys: list, order: list, name: str) -> DataFrame:
    """1-based ``row_number`` per key in ``order`` (Columns with asc/desc).

    A key's rows are ranked in one task: for keys that a domain bounds.  ``rank_in_shares`` ranks keys of any size."""
    w = Window.partitionBy(*[_col(k) for k in keys]).orderBy(*order)
    return df.select("*", F.row_number().over(w).cast("bigint").alias(name))


def range_shares(df: DataFrame, keys: list, order: list, shares: int) -> DataFrame:
    """``df`` with a column ``__share``: ranges of (keys, order) of about one size; a key may span many.

    The ranges come from a sample, so they are fixed by a checkpoint: what is counted and what is ranked agree, also
    when tasks are lost.
    """
    checkpoint_dir(df.sparkSession)
    ranged = df.repartitionByRange(shares, *[_col(k) for k in keys], *order)
    return ranged.withColumn("__share", F.spark_partition_id()).checkpoint()


def rank_in_shares(df: DataFrame, keys: list, order: list, name: str, shares: int | None = None) -> DataFrame:
    """O4 for keys of any size: 1-based rank per key in ``order`` (which must tell all rows of a key apart).

    Each share of the range is ranked on its own; a row's rank adds the rows that its key has in earlier shares, which
    are counted first (at most ``shares`` counts a key).  One key with most of the rows is spread over most shares.
    """
    shares = shares or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shared = range_shares(df, keys, order, shares)
    names = [f"__k{i}" for i in range(len(keys))]
    counts = shared.groupBy(*[_col(k).alias(n) for k, n in zip(keys, names)], F.col("__share").alias("__s")).agg(
        F.count("*").alias("__n"))
    earlier = Window.partitionBy(*names).orderBy("__s").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(*names, "__s", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"))
    own = Window.partitionBy("__share", *[_col(k) for k in keys]).orderBy(*order)
    ranked = shared.withColumn("__rank", F.row_number().over(own))
    same = F.col("__share") == F.col("__s")
    for k, n in zip(keys, names):
        same = same & _col(k).eqNullSafe(F.col(n))
    return (ranked.join(before, same)
            .select(*[F.col(q(c)) for c in df.columns], (F.col("__rank") + F.col("__before")).cast("bigint").alias(name)))


def pick_first(df: DataFrame, keys: list, prefer: list) -> DataFrame:
    """The single best row per key.

    ``prefer`` lists Columns where a larger value is better (the order of a
    descending sort with NULLs last); negate a numeric column to prefer small
    values.  Remaining ties are broken by the whole row, so the pick is
    deterministic.
    """
    cols = df.columns
    key_names = [k if isinstance(k, str) else None for k in keys]
    rest = [c for c in cols if c not in key_names]
    best = F.max(F.struct(*[p.alias(f"__p{i}") for i, p in enumerate(prefer)],
                          *[F.col(f"`{c}`").alias(c) for c in rest])).alias("__best")
    picked = df.groupBy(*keys).agg(best)
    return picked.select(*keys, *[F.col("__best").getField(c).alias(c) for c in rest]).select(*cols)


def code_priority(col, tiers: list[list[str]]) -> Column:
    """Preference tier of a code (1 = most informative); NULL if unlisted."""
    c = _col(col)
    expr = None
    for i, codes in enumerate(tiers, start=1):
        cond = c.isin(codes)
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    return expr


def latest_by_date_then_priority(df: DataFrame, keys: list, date: str, code: str, tiers: list[list[str]],
                                 tiebreak: str, priority_name: str = "Priority") -> DataFrame:
    """Per key, the row with the newest date; on equal dates the best tier
    (lowest number), then the highest ``tiebreak``.  Rows with codes outside
    the tiers are dropped first; exact duplicates are removed (DISTINCT)."""
    allowed = ", ".join("'" + c + "'" for tier in tiers for c in tier)
    ranked = df.where(f"{q(code)} IN ({allowed})").distinct().withColumn(priority_name, code_priority(code, tiers))
    return pick_first(ranked, keys, [F.col(date), -F.col(priority_name), F.col(tiebreak)])


def first_last_ranks(df: DataFrame, keys: list, date: str, tiebreak: list[str],
                     first_name: str = "FirstRank", last_name: str = "LastRank") -> DataFrame:
    """Ascending and descending rank of each row by ``date`` per key.

    Rows with a NULL date get 0 in both columns, but still take up the first
    ascending positions (NULL sorts lowest), so a key with a NULL-dated row has
    no row ranked 1 ascending.  The descending order is the exact reverse of
    the ascending one, ties included.
    """
    part = ", ".join(q(k) for k in keys)
    asc = ", ".join([f"{q(date)} ASC NULLS FIRST", *[f"{q(t)} ASC NULLS FIRST" for t in tiebreak]])
    dated = f"{q(date)} IS NOT NULL"
    # The descending order is the exact reverse of the ascending one, so the
    # descending rank is (rows in the key) - (ascending rank) + 1: one sort.
    # Both BIGINT, like ROW_NUMBER in the source database.
    ranked = df.selectExpr("*", f"ROW_NUMBER() OVER (PARTITION BY {part} ORDER BY {asc}) AS __asc",
                           f"COUNT(1) OVER (PARTITION BY {part}) AS __n")
    return ranked.selectExpr(
        *[q(c) for c in df.columns],
        f"CAST(CASE WHEN {dated} THEN __asc ELSE 0 END AS BIGINT) AS {q(first_name)}",
        f"CAST(CASE WHEN {dated} THEN __n - __asc + 1 ELSE 0 END AS BIGINT) AS {q(last_name)}")
