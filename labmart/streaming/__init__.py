from labmart.streaming.ingest import batch_progress, committed, ingest_stream, ledger_lines
from labmart.streaming.trends import current_trends, late_rows, rows_seen, trend_stream

__all__ = [
    "batch_progress",
    "committed",
    "current_trends",
    "ingest_stream",
    "late_rows",
    "ledger_lines",
    "rows_seen",
    "trend_stream",
]
