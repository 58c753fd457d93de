"""New bar files, as they arrive, into the fact table."""

from barworks.plans.load import load_batch
from barworks.schemas import RAW_BARS
from barworks.sources.bars import normalize_bars


def stream_ingest(spark, source_path, fact_path, state_path, checkpoint_path, quarantine_path=None,
                  schema=RAW_BARS, fmt="parquet", max_files_per_trigger=None, available_now=True,
                  checks=None, loaded_at=None, gold_path=None, lookback_days=None,
                  listed=None, metrics_path=None):
    """Follow a folder of raw bar files; returns the started query.

    Each micro-batch is normalised, checked and upserted. The upsert and the
    watermark are idempotent, so the replay of a batch after a failure leaves
    the same table. Windows over rows cannot run on a stream, so with a
    ``gold_path`` each batch recomputes the gold rows it affects. With a ``metrics_path`` every
    micro-batch, good or bad, stores a row there under its number (a replay stores another: the
    latest ``started_at`` of a number counts). With ``available_now`` the query stops when it has caught up.
    """
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)

    def load(batch, batch_id):
        load_batch(batch.sparkSession, normalize_bars(batch), fact_path, state_path, quarantine_path,
                   batch_id, checks, loaded_at, gold_path=gold_path, lookback_days=lookback_days,
                   listed=listed, metrics_path=metrics_path)

    writer = reader.load(source_path).writeStream.option("checkpointLocation", checkpoint_path).foreachBatch(load)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
