"""First-to-last record pairing (O20 pair_first_last, O27 score_distribution).

Variant A pairs the first and the last employment-status row of a record in one
grouping of the rows that rank first in either order (one or two per person).

Variant B pairs the first and last answer to an assessment question.  Only
the two extreme rows of each (pathway, question) are needed, so it is one
aggregate: ``min`` and ``max`` of a row struct ordered by (date, time,
descending id), plus the count.  A pathway with very many answers is combined
map-side like any other group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from monthwise.functions.flags import q


def pair_first_last(ranked: DataFrame, keys: list, first_rank: str, last_rank: str,
                    first_cols: dict, last_cols: dict) -> DataFrame:
    """O20 variant A: the rank-1-ascending row with the rank-1-descending
    row of the same key, only when they are different records (the last row's
    ascending rank is not 1, i.e. at least two dated rows).

    ``first_cols`` / ``last_cols`` map output name -> column of that side.
    """
    # Both sides of a key come from one grouping of the rank-1 rows (a key has
    # one of either per person), which the partitioning of ``ranked`` serves.
    struct = lambda cols: "named_struct(" + ", ".join(f"'{o}', {q(c)}" for o, c in cols.items()) + ")"
    known = " AND ".join(f"{q(k)} IS NOT NULL" for k in keys)
    sides = (ranked.where(f"({q(first_rank)} = 1 OR {q(last_rank)} = 1) AND {known}").groupBy(*keys)
             .agg(F.expr(f"collect_list({struct(first_cols)}) FILTER (WHERE {q(first_rank)} = 1) AS __first"),
                  F.expr(f"collect_list({struct(last_cols)}) FILTER (WHERE {q(last_rank)} = 1 AND "
                         f"{q(first_rank)} <> 1) AS __last")))
    pairs = sides.selectExpr("explode(__first) AS __f", "__last").selectExpr("__f", "explode(__last) AS __l")
    return pairs.selectExpr(*[f"__f.{q(c)} AS {q(c)}" for c in first_cols], *[f"__l.{q(c)} AS {q(c)}" for c in last_cols])


def pair_first_last_answers(answers: DataFrame, keys: list, date: str, time: str, uid: str,
                            carry: list, lo, hi) -> DataFrame:
    """O20 variant B: per key (pathway, question) the first answer (earliest date,
    then time, then highest id) and the last answer (the reverse order), kept
    when the key has at least two answers and the last is dated in [lo, hi].

    NULL dates and times sort first, as in the ranking they replace.  Output
    columns: keys, ``First<c>`` and ``Last<c>`` for each carried column, and
    ``n_answers``.
    """
    carried = ", ".join(f"'{c}', {q(c)}" for c in carry)
    if isinstance(answers.schema[uid].dataType, NumericType):
        row = f"named_struct('__d', {q(date)}, '__t', {q(time)}, '__u', -{q(uid)}, {carried})"
        agg = answers.groupBy(*keys).agg(F.expr("count(1) AS n_answers"), F.expr(f"min({row}) AS __first"),
                                         F.expr(f"max({row}) AS __last"))
    else:
        # Text ids can't be negated: of the answers of one moment the highest id comes first, the lowest last.
        row = f"named_struct('__u', {q(uid)}, {carried})"
        moments = answers.groupBy(*keys, F.col(q(date)).alias("__d"), F.col(q(time)).alias("__t")).agg(
            F.expr("count(1) AS __n"), F.expr(f"max({row}) AS __high"), F.expr(f"min({row}) AS __low"))
        side = "named_struct('__d', __d, '__t', __t, {})".format
        taken = lambda s: side(", ".join(f"'{c}', {s}.{q(c)}" for c in carry))
        agg = moments.groupBy(*keys).agg(F.expr("sum(__n) AS n_answers"), F.expr(f"min({taken('__high')}) AS __first"),
                                         F.expr(f"max({taken('__low')}) AS __last"))
    out = agg.where(f"n_answers >= 2 AND __last.__d BETWEEN DATE '{lo}' AND DATE '{hi}'")
    return out.selectExpr(*[q(k) for k in keys], "n_answers",
                          *[f"__first.{q(c)} AS {q('First' + c)}" for c in carry],
                          *[f"__last.{q(c)} AS {q('Last' + c)}" for c in carry])


def score_distribution(pairs: DataFrame, score_cols: dict, keys: list, count_col: str = "PathwayID",
                       out_name: str = "Count_Referrals") -> DataFrame:
    """First and last scores unpivoted to ``(ScoreType, Score)``; distinct
    pathways per score type x score x keys (exact distinct count)."""
    arr = "array(" + ", ".join(f"named_struct('ScoreType', '{label}', 'Score', {q(col)})"
                               for label, col in score_cols.items()) + ")"
    stacked = pairs.selectExpr(*[q(k) for k in keys], q(count_col), f"explode({arr}) AS __s").selectExpr(
        *[q(k) for k in keys], q(count_col), "__s.ScoreType AS ScoreType", "__s.Score AS Score")
    return stacked.groupBy(*keys, "ScoreType", "Score").agg(
        F.expr(f"count(DISTINCT {q(count_col)}) AS {q(out_name)}"))

