"""A bounded filter for 'is this key among those', below any exchange.

The keys are hashed to bits; 64 bits make a word, and the words that have any
are one small table (word number, bits): at most ``bits`` / 64 rows, however
many keys there are, so it may always be broadcast.  A fact row stays if its
key's bit is set.  No member is ever lost; others may pass by a shared bit (more
of them, the more keys there are) and fall to the exact join that follows.  It
is built once and can prune any number of fact scans before they are shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthwise.functions.flags import q

BITS = 1 << 24


class MemberFilter:
    """Built from the values of ``members.key``; null is no member."""

    def __init__(self, members: DataFrame, key: str, bits: int = BITS):
        if bits % 64:
            raise ValueError("bits must be a multiple of 64")
        self.bits, self.type = bits, members.schema[key].dataType.simpleString()
        self.words = (members.where(f"{q(key)} IS NOT NULL").selectExpr(f"{self._place(key)} AS __place")
                      .selectExpr("__place div 64 AS __word",
                                  "shiftleft(CAST(1 AS BIGINT), CAST(__place % 64 AS INT)) AS __bit")
                      .groupBy("__word").agg(F.expr("bit_or(__bit) AS __bits")))

    def _place(self, key: str) -> str:
        # One type on both sides: equal values of different types have different hashes.
        return f"pmod(xxhash64(CAST({q(key)} AS {self.type})), {self.bits})"

    def keep(self, facts: DataFrame, key: str) -> DataFrame:
        """Rows of ``facts`` whose key may be a member; a map-side semi-join."""
        place = self._place(key)
        cond = (f"{q(key)} IS NOT NULL AND {place} div 64 = __word "
                f"AND (shiftrightunsigned(__bits, CAST({place} % 64 AS INT)) & 1) = 1")
        return facts.join(F.broadcast(self.words), F.expr(cond), "left_semi")
