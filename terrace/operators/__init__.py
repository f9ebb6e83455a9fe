from terrace.operators.append import append_flows
from terrace.operators.cdc import Cdc, require_unique_sequence, scd1, scd2, sequence_ties
from terrace.operators.joins import (
    current_versions,
    effective_date_join,
    inferred_members,
    inner_using,
    with_dimension_key,
    with_surrogate_key,
)
from terrace.operators.quality import DROP, WARN, Rule, expect, quality_report, quarantine, rules
from terrace.operators.totals import CENTS, joined_transaction_totals, transaction_totals

__all__ = [
    "CENTS",
    "Cdc",
    "DROP",
    "Rule",
    "WARN",
    "append_flows",
    "current_versions",
    "effective_date_join",
    "expect",
    "inferred_members",
    "inner_using",
    "joined_transaction_totals",
    "quality_report",
    "quarantine",
    "require_unique_sequence",
    "rules",
    "scd1",
    "scd2",
    "sequence_ties",
    "transaction_totals",
    "with_dimension_key",
    "with_surrogate_key",
]
