from barworks.streaming.bars import late_ticks, stream_daily_bars, stream_late_ticks
from barworks.streaming.ingest import stream_ingest

__all__ = ["late_ticks", "stream_daily_bars", "stream_ingest", "stream_late_ticks"]
