from monthwise.functions import labels
from monthwise.functions.dates import days_between, month_date, month_label
from monthwise.functions.flags import (condition_flag, days_open_bands, in_period, in_period_flag, is_true,
                                       open_caseload, same_value_flags)
from monthwise.functions.recode import band, recode, recode_rules

__all__ = [
    "labels", "days_between", "month_date", "month_label", "condition_flag", "days_open_bands", "in_period",
    "in_period_flag", "is_true", "open_caseload", "same_value_flags", "band", "recode", "recode_rules",
]
