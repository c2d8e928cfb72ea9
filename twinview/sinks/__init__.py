"""Writers."""

from twinview.sinks.compaction import compact_master, vacuum_master
from twinview.sinks.lines import write_lines
from twinview.sinks.tables import append_master, save_batch_view

__all__ = ["append_master", "compact_master", "save_batch_view", "vacuum_master", "write_lines"]
