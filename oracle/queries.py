"""Oracle SQL registry: query name -> function returning DuckDB SQL."""

from oracle import pipelines as P
from oracle.operators import OPERATOR_ORACLE

ORACLE = {
    "indicator": P.indicator,
    "first_and_last_status": P.first_and_last_status,
    "benefits": P.benefits,
    "finished_treatment": P.finished_treatment,
    "active_providers": P.active_providers,
    "open_refs_no_contact": P.open_refs_no_contact,
    "clinical_outcomes": P.clinical_outcomes,
    "assessment_counts": P.assessment_counts,
    "assessment_coverage": P.assessment_coverage,
    "student": P.student,
}
ORACLE.update(OPERATOR_ORACLE)
# Publishing and reading back changes nothing.
ORACLE["publish_indicator"] = P.indicator
ORACLE["duplicate_current_codes"] = lambda: """
SELECT c_nationkey AS code, count(*) AS current_rows FROM customer
WHERE c_acctbal >= 0 OR c_acctbal IS NULL GROUP BY c_nationkey HAVING count(*) > 1
"""
_MONTH_TOTALS = """
SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS "Month", o_orderstatus, count(*) AS "Orders",
       count(DISTINCT o_custkey) AS "Customers"
FROM orders GROUP BY ALL
"""
ORACLE["publish_created_then_appended"] = lambda: _MONTH_TOTALS
ORACLE["release_months"] = lambda: _MONTH_TOTALS
ORACLE["distinct_over_months"] = lambda: """
SELECT o_orderstatus, o_orderpriority, count(DISTINCT o_custkey) AS "Customers" FROM orders GROUP BY ALL
"""
ORACLE["rank_hot_key"] = lambda: """
SELECT l_orderkey, l_linenumber, l_returnflag, l_extendedprice, row_number() OVER (
  PARTITION BY l_returnflag ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) AS "PriceRank"
FROM lineitem
"""
# Recomputing touched months gives the same table as building all of them.
ORACLE["benefits_by_touched_months"] = P.benefits
