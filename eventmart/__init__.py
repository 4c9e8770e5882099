"""Log-event warehouse on Spark: ordered line scan, strict parsing, gates, on-change equity, keyed tables."""

from eventmart.operators.archive import (
    compact,
    compaction_summary,
    distinct_timestamps,
    files_by_mode,
    modes,
    read_archive,
    stored_periods,
    time_range,
)
from eventmart.operators.equity import carry_state, equity_changes, last_equity
from eventmart.operators.gate import attach_live, gate_configs, live_by_file, open_modes
from eventmart.operators.keys import latest_by_key
from eventmart.operators.parse import explode_items, line_facts, parse_messages
from eventmart.operators.registry import registrations, start_messages, touch_instances, upsert_instances
from eventmart.operators.rows import archive_of_line, equity_of_line, equity_with_candle, trades_of_line
from eventmart.operators.stats import file_stats
from eventmart.plans.batch import delete_mode, export_jdbc, ingest_lines, run_batch
from eventmart.session import Staging, configure, staging
from eventmart.sources.files import (
    line_digest,
    list_files,
    new_files,
    pick_files,
    scan_lines,
    with_file_ids,
)
from eventmart.sources.tables import EQUITY, INSTANCES, TRADES, Warehouse, archive_table
from eventmart.streaming.ingest import run_in_rounds, stream_ingest

__all__ = [
    "EQUITY", "INSTANCES", "TRADES", "Staging", "Warehouse", "archive_of_line", "archive_table", "attach_live",
    "carry_state", "compact", "compaction_summary", "configure", "delete_mode", "distinct_timestamps",
    "equity_changes", "equity_of_line", "equity_with_candle", "explode_items", "export_jdbc", "file_stats",
    "files_by_mode", "gate_configs", "ingest_lines", "last_equity", "latest_by_key", "line_digest", "line_facts",
    "list_files", "live_by_file", "modes", "new_files", "open_modes", "parse_messages", "pick_files",
    "read_archive", "registrations", "run_batch", "run_in_rounds", "scan_lines", "staging", "start_messages", "stored_periods", "stream_ingest",
    "time_range", "touch_instances", "trades_of_line", "upsert_instances", "with_file_ids",
]
