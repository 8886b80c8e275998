from monthwise.operators.contacts import qualifying_contact_count
from monthwise.operators.lookups import (commissioner_geography, current_lookup, duplicate_current_codes,
                                         provider_geography, remap_successor, snapshot_lookup)
from monthwise.operators.pairing import pair_first_last, pair_first_last_answers, score_distribution
from monthwise.operators.periods import Period, reporting_window, resolve_period, slice_period
from monthwise.operators.publish import publish
from monthwise.operators.ranking import (code_priority, first_last_ranks, latest_by_date_then_priority,
                                         pick_first, rank_within)
from monthwise.operators.rollup import LEVELS, Level, Scope, appointment_scope, category_rollup, org_rollup
from monthwise.operators.submissions import latest_audit_rows, latest_submission

__all__ = [
    "qualifying_contact_count", "commissioner_geography", "current_lookup", "duplicate_current_codes",
    "provider_geography", "remap_successor", "snapshot_lookup", "pair_first_last", "pair_first_last_answers",
    "score_distribution", "Period", "reporting_window", "resolve_period", "slice_period", "publish",
    "code_priority", "first_last_ranks", "latest_by_date_then_priority", "pick_first", "rank_within",
    "LEVELS", "Level", "Scope", "appointment_scope", "category_rollup", "org_rollup", "latest_audit_rows",
    "latest_submission",
]
