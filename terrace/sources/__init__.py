from terrace.sources.files import read_csv, stream_csv, stream_parquet, with_audit_columns
from terrace.sources.tables import scan_path, scan_table, select_all, stream_table

__all__ = [
    "read_csv",
    "scan_path",
    "scan_table",
    "select_all",
    "stream_csv",
    "stream_parquet",
    "stream_table",
    "with_audit_columns",
]
