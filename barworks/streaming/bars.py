"""Ticks to daily bars on a stream."""

from pyspark.sql import Observation
from pyspark.sql import functions as F

from barworks.plans.gaps import set_aside
from barworks.plans.tables import upsert_table
from barworks.session import delete_path, path_exists, scratch_path, write_and_reread
from barworks.sources.ticks import bar_aggregates


def _instant(ticks, ts):
    """The ticks with their event time as an instant: wall-clock times are read as UTC."""
    if dict(ticks.dtypes)[ts] == "timestamp_ntz":
        return ticks.withColumn(ts, F.convert_timezone(F.lit("UTC"), F.current_timezone(), F.col(ts)).cast("timestamp"))
    return ticks


def daily_bar_stream(ticks, ts, price, tick_order, watermark="1 day", tick_id=None, **parts):
    """The streaming aggregate: one bar per listing and day, state kept until
    the watermark has passed the day.

    Event time must be an instant, and day windows are cut in UTC. A wall-clock
    column is therefore read as UTC, whatever the session's time zone is, and
    the day is read back the same way. With ``tick_id`` (a column or several), a tick that
    arrives again is left out; its id is remembered until the watermark has passed
    it, and later copies are late ticks.
    """
    ticks = _instant(ticks, ts).withWatermark(ts, watermark)
    if tick_id is not None:
        ticks = ticks.dropDuplicatesWithinWatermark([tick_id] if isinstance(tick_id, str) else list(tick_id))
    bars = ticks.groupBy("symbol", "exchange_code", F.window(ts, "1 day")).agg(
        *bar_aggregates(price, tick_order, **parts))
    start = F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.col("window.start").cast("timestamp_ntz"))
    return bars.withColumn("trade_date", start.cast("date")).drop("window")


def stream_daily_bars(spark, ticks, ts, price, tick_order, bars_path, checkpoint_path,
                      watermark="1 day", available_now=True, quarantine_path=None, tick_id=None, **parts):
    """Keep a table of daily bars up to date; returns the started query.

    Runs in update mode and upserts each changed bar, so the bar of a day that
    is still open is there too and grows with later ticks. Bars without a symbol
    or an exchange go to ``quarantine_path``, each once; where none is given they stop the
    query. Feeds that deliver a tick more than once need its ``tick_id``. Ticks later
    than ``watermark`` no longer change a bar: :func:`late_ticks`
    counts them, :func:`stream_late_ticks` keeps them.
    """
    bars = daily_bar_stream(ticks, ts, price, tick_order, watermark, tick_id, **parts)

    def store(batch, batch_id):
        session = batch.sparkSession
        stage = scratch_path(session, f"tick-bars-{batch_id}")
        named = F.col("symbol").isNotNull() & F.col("exchange_code").isNotNull()
        try:
            if quarantine_path is not None:
                seen = Observation()
                unnamed = F.when(~named, F.xxhash64(*batch.columns)).cast("decimal(38,0)")
                batch = batch.observe(seen, F.count_if(~named).alias("bad"), F.coalesce(F.sum(unnamed), F.lit(0)).cast("string").alias("digest"))
            written = write_and_reread(batch, stage)
            if quarantine_path is not None:
                if seen.get["bad"]:
                    set_aside(session, written.filter(~named), quarantine_path, batch_id, seen.get["digest"])
                written = written.filter(named)
            upsert_table(session, bars_path, written, settle=False)
        finally:
            delete_path(session, stage)

    writer = (bars.writeStream.outputMode("update")
              .option("checkpointLocation", checkpoint_path).foreachBatch(store))
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def late_ticks(query):
    """Groups of ticks that came after the watermark and were left out, over the progress Spark still keeps of a query."""
    return sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])


#: One row a micro-batch: the latest event time it brought, in milliseconds, as the engine counts it.
TICK_MARKS = "batch_id bigint, latest_ms bigint"


def stream_late_ticks(spark, ticks, ts, late_path, checkpoint_path, watermark="1 day", available_now=True):
    """Keep the ticks that come too late for :func:`stream_daily_bars`; returns the started query.

    A tick is late when its time is at or before the latest time of the earlier
    micro-batches less ``watermark``. Started on the same source with the same trigger,
    both queries see the same micro-batches, and a tick is in a bar or here. It keeps no
    state but one row a micro-batch, beside the table. A batch that is replayed
    writes the same place. Late copies of a tick that was in time are here too: an anti
    join by id with the ticks of that day tells them apart.
    """
    late_path = late_path.rstrip("/")
    marks_path = f"{late_path}.marks"

    def store(batch, batch_id):
        session = batch.sparkSession
        marks = session.read.schema(TICK_MARKS).parquet(marks_path) if path_exists(session, marks_path) else session.createDataFrame([], TICK_MARKS)
        limit = marks.filter(F.col("batch_id") < batch_id).agg(F.max("latest_ms") - _milliseconds(session, watermark)).scalar()
        stage = scratch_path(session, f"late-ticks-{batch_id}")
        try:
            seen = Observation()
            late = write_and_reread(batch.observe(seen, F.max(F.unix_millis(ts)).alias("latest")).filter(F.col(ts) <= F.timestamp_millis(limit)), stage)
            late.write.mode("overwrite").parquet(f"{late_path}/batch_id={batch_id}")
            session.createDataFrame([(batch_id, seen.get["latest"])], TICK_MARKS).coalesce(1).write.mode("append").parquet(marks_path)
        finally:
            delete_path(session, stage)

    writer = _instant(ticks, ts).writeStream.option("checkpointLocation", checkpoint_path).foreachBatch(store)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def _milliseconds(spark, span):
    """The length of a span such as '1 day 2 hours'."""
    start = F.timestamp_seconds(F.lit(0))
    return spark.range(1).select(F.unix_millis(start + F.expr(f"INTERVAL '{span}'"))).first()[0]
