from terrace.streaming.change_tables import (
    backfill,
    comment_of,
    current_rows,
    declare,
    history,
    open_versions,
    remove_covered,
    stream_scd,
)
from terrace.streaming.dedup import dedup_within_watermark
from terrace.streaming.kept_totals import KeptTotals
from terrace.streaming.quality import (
    Declared,
    count_rules,
    declare_checked,
    declared,
    quarantined,
    read_checked,
    rule_totals,
    stream_checked,
    write_checked,
    write_on_time,
)
from terrace.streaming.sinks import finish, write_stream

__all__ = [
    "Declared",
    "KeptTotals",
    "backfill",
    "comment_of",
    "count_rules",
    "current_rows",
    "declare",
    "declare_checked",
    "declared",
    "dedup_within_watermark",
    "finish",
    "history",
    "open_versions",
    "quarantined",
    "read_checked",
    "remove_covered",
    "rule_totals",
    "stream_checked",
    "stream_scd",
    "write_checked",
    "write_on_time",
    "write_stream",
]
