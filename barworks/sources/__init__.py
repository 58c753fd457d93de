from barworks.sources.bars import normalize_bars, read_bar_files, union_frames, with_bar_metrics
from barworks.sources.catalog import create_star_schema, database_counts, list_tables, load_layer, month_bounds, run_sql, save_layer, table_counts, table_exists
from barworks.sources.parts import read_parts
from barworks.sources.scan import read_fact, scan_bronze
from barworks.sources.ticks import bars_from_ticks, resample_bars

__all__ = [
    "bars_from_ticks", "create_star_schema", "database_counts", "list_tables", "load_layer", "month_bounds", "normalize_bars",
    "read_bar_files", "read_fact", "read_parts", "resample_bars", "run_sql", "save_layer", "scan_bronze", "table_counts",
    "table_exists", "union_frames", "with_bar_metrics",
]
