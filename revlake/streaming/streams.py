"""Streaming forms of the batch jobs (STR)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from revlake.sources import versions


def read_arrivals(spark: SparkSession, path: str, schema: T.StructType, files: int = 1000) -> DataFrame:
    """STR-1: Parquet files as they arrive, ``files`` of them a trigger at most (a rate, not a cap: the rest come next)."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)


def newest_of(rows: DataFrame, key: list[str], newest: list[str]) -> DataFrame:
    """STR-1: the newest row of each key: the largest in ``newest``, nulls first, then by a hash of the row. A grouping, so a hot key's rows are combined before they are shuffled;
    the same rows come out in whatever order and batches they arrived."""
    columns = [c for c in rows.columns if c not in key]
    return rows.groupBy(*key).agg(F.max_by(F.struct(*columns), F.struct(*newest, F.xxhash64(*columns))).alias("_r")).select(*key, *(F.col("_r")[c].alias(c) for c in columns)).select(*rows.columns)


def upsert_batch(batch: DataFrame, number: int, path: str, stream: str, key: list[str], newest: list[str], buckets: int) -> bool:
    """STR-1: merges a micro-batch into the table at ``path``, and says whether it did: a batch that the last commit has already isn't merged again.

    Rows lie in ``buckets`` folders by a hash of their key. The batch's rows are grouped and written by bucket first, which evaluates it once and names the buckets it touches;
    only these are read, merged and written again. All rows of a key, old and new, compete by ``newest``, so what arrives late never replaces what is newer."""
    spark = batch.sparkSession
    before = versions.current(spark, path)
    if before.note.get("stream") == stream and int(before.note["batch"]) >= number:
        return False
    rows = newest_of(batch, key, newest).withColumn("bucket", F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int"))
    came = versions.write(rows, path, "bucket")
    both = versions.read(spark, path, rows.schema, at=versions.Commit(parts=came)).unionByName(versions.read(spark, path, rows.schema, list(came), before))
    after = versions.write(newest_of(both, ["bucket", *key], newest).select(*rows.columns), path, "bucket") if came else {}
    versions.commit(spark, path, before.parts | after, before, {"stream": stream, "batch": str(number)})
    versions.sweep(spark, path)
    return True


def start_upsert(stream: DataFrame, path: str, key: list[str], checkpoint: str, transform: Callable[[DataFrame], DataFrame] = lambda df: df, newest: str | list[str] = "ingested_at", buckets: int = 16) -> StreamingQuery:
    """STR-1: each micro-batch is upserted into the table at ``path``; see ``upsert_batch``. ``newest`` orders the rows of a key. A batch that is run again after a failure changes nothing
    if its commit was put in place, and else starts from the commit before. Rows with null keys are the rows of one key. Keep ``buckets`` for the table's life: so many that one fits a task."""
    by = [newest] if isinstance(newest, str) else newest

    def write(batch: DataFrame, number: int) -> None:
        upsert_batch(transform(batch), number, path, checkpoint, key, by, buckets)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def upserted(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """STR-1: the table's rows as of its last commit; ``schema`` is that of the transformed arrivals."""
    return versions.read(spark, path, T.StructType([*schema, T.StructField("bucket", T.IntegerType())])).drop("bucket")


def late_watch(notices: DataFrame, openings: DataFrame, delay: str = "1 hour", lateness: str = "1 hour") -> DataFrame:
    """STR-2: each notice with the opening that was captured from its due time until ``delay`` later, or ``unresolved`` once no such opening can come any more.

    A stream-stream left outer join. Both sides may be ``lateness`` out of order. The time range in the condition tells Spark when a notice's state can go: when the openings' watermark
    has passed the end of its range; then the row without an opening comes out. Notices without a time are never due and don't come out. A notice comes once for each opening in the range."""
    n = notices.withWatermark("bid_open_date", lateness).alias("n")
    o = openings.withWatermark("captured_at", lateness).alias("o")
    on = (F.col("n.notify_no") == F.col("o.notify_no")) & (F.col("o.captured_at") >= F.col("n.bid_open_date")) & (F.col("o.captured_at") <= F.col("n.bid_open_date") + F.expr(f"INTERVAL {delay}"))
    return n.join(o, on, "leftOuter").select("n.notify_no", "n.bid_open_date", "o.captured_at", F.when(F.col("o.captured_at").isNotNull(), "captured").otherwise("unresolved").alias("state"))


def first_seen(stream: DataFrame, key: list[str], time: str, delay: str = "1 day") -> DataFrame:
    """STR-3: the first row of each key, remembered for ``delay``."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(key)


def daily(stream: DataFrame, time: str, grain: list[str], measures: list[str], delay: str = "2 days") -> DataFrame:
    """STR-4: additive measures by day of event time and grain; in append mode a day comes out once, final, when the watermark has passed it. Rows without a time
    belong to no day. Rows that come after their day's end and ``delay`` are not in it: ``start_daily`` keeps them apart."""
    out = stream.withWatermark(time, delay).groupBy(F.window(time, "1 day"), *grain).agg(F.count("*").alias("rows"), *(F.sum(m).alias(m) for m in measures))
    return out.select(F.to_date("window.start").alias("report_date"), *grain, "rows", *measures)


def merge_daily(batch: DataFrame, number: int, path: str, stream: str, time: str, grain: list[str], measures: list[str], delay_days: int) -> bool:
    """STR-4: adds a micro-batch to the fact at ``path``, and says whether it did: a batch that the last commit has already isn't added again.

    The commit's note holds the latest event seen before. A row whose day ended more than ``delay_days`` before that is late: its day is final, so it is counted in the ``late`` columns of that day and
    not in its measures. Only the days that the batch touches are written again."""
    spark = batch.sparkSession
    before = versions.current(spark, path)
    if before.note.get("stream") == stream and int(before.note["batch"]) >= number:
        return False
    day = F.to_date(time)
    final = F.date_sub(F.lit(before.note.get("seen")).cast("date"), delay_days)  # days before this one are final
    late = F.coalesce(day < final, F.lit(False))
    sums = [F.sum(F.when(~late, F.lit(1)).otherwise(0)).alias("rows"), *(F.sum(F.when(~late, F.col(m))).alias(m) for m in measures), F.sum(F.when(late, F.lit(1)).otherwise(0)).alias("late_rows")]
    new = batch.filter(F.col(time).isNotNull()).groupBy(day.alias("report_date"), *grain).agg(*sums)
    columns = [*grain, "rows", *measures, "late_rows", "report_date"]
    came = versions.write(new.select(*columns), path, "report_date")
    schema = new.select(*columns).schema
    both = versions.read(spark, path, schema, at=versions.Commit(parts=came)).unionByName(versions.read(spark, path, schema, list(came), before))
    total = both.groupBy("report_date", *grain).agg(*(F.sum(c).cast(schema[c].dataType).alias(c) for c in ("rows", *measures, "late_rows")))
    after = versions.write(total.select(*columns), path, "report_date") if came else {}
    seen = max([before.note.get("seen", ""), *came])
    versions.commit(spark, path, before.parts | after, before, {"stream": stream, "batch": str(number), "seen": seen})
    versions.sweep(spark, path)
    return True


def start_daily(stream: DataFrame, path: str, checkpoint: str, time: str, grain: list[str], measures: list[str], delay_days: int = 2) -> StreamingQuery:
    """STR-4: the daily fact of a stream as a table that can be read at any time; see ``merge_daily``. A day is final when an event of more than ``delay_days`` later was in an earlier batch; later rows are counted apart."""
    return stream.writeStream.foreachBatch(lambda batch, number: merge_daily(batch, number, path, checkpoint, time, grain, measures, delay_days) and None).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
