"""Structured Streaming jobs.

Each job is the batch transform from :mod:`quire.operators.messages` applied
to a ``readStream``; none keeps state, so no watermark is needed. Sources and
sinks are an :class:`Endpoint`: ``format="kafka"`` for a broker topic (needs
the Kafka connector on the classpath), or a file twin (``text`` records, one
JSON message per line) used by the tests.

Unless a checkpoint is given, a query keeps it at a fixed place (beside its
output, or under ``spark.checkpoint.dir``), so a restarted query resumes.
"""

from __future__ import annotations

import json
import time
import uuid
from collections import Counter
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener
from pyspark.sql.types import StringType, StructField, StructType

from quire import operators as op
from quire.functions import decode, parse_once
from quire.schemas import ALLOWED_DOMAINS, PROCESSED_MESSAGE_SCHEMA
from quire.session import stream_checkpoint
from quire.sinks.files import ARCHIVE_COLUMNS
from quire.sinks.keyed import ConnectorTable, KeyedTable
from quire.sources.files import BY_NAME, CSV_DIALECT, CSV_WRITE


@dataclass
class Endpoint:
    """Where records come from or go to.

    ``format="kafka"``: ``topic`` plus broker ``options``
    (``kafka.bootstrap.servers``); ``starting_offsets`` left as None takes
    the job's default: ``latest`` for the filter and load jobs, ``earliest``
    for the archiver (which reads the whole topic, like a new consumer group).
    ``format="text"``: a directory of line files at ``path``. A file source
    always starts with the files already present.
    """

    format: str = "text"
    path: str | None = None
    topic: str | None = None
    options: dict = field(default_factory=dict)
    starting_offsets: str | None = None
    max_per_trigger: int | None = None


def read_records(spark: SparkSession, src: Endpoint, default_start: str = "latest",
                 checkpoint: str | None = None) -> DataFrame:
    """Streaming records with one string column ``value``. ``checkpoint`` is the
    query's, for a file source that starts at the latest."""
    if src.format == "kafka":
        r = (spark.readStream.format("kafka").options(**src.options)
             .option("subscribe", src.topic)
             .option("startingOffsets", src.starting_offsets or default_start))
        if src.max_per_trigger:
            r = r.option("maxOffsetsPerTrigger", src.max_per_trigger)
        return r.load().select(F.col("value").cast("string").alias("value"))
    r = spark.readStream.format(src.format).options(**src.options)
    if src.max_per_trigger:
        r = r.option("maxFilesPerTrigger", src.max_per_trigger)
    rows = r.load(src.path)
    if src.starting_offsets == "latest":
        if not checkpoint:
            raise ValueError("a file source that starts at the latest needs the query's checkpoint")
        millis = int(_kept(spark, checkpoint, "_start", lambda: str(int(time.time() * 1000))))
        # a stream takes no modifiedAfter; the files' own times prune them before they are opened
        rows = rows.where(F.col("_metadata.file_modification_time") >= F.timestamp_millis(F.lit(millis)))
    return rows


def _start(writer, name: str, spark: SparkSession, checkpoint: str | None,
           trigger: dict | None, beside: str | None = None) -> StreamingQuery:
    _listen(spark)
    writer = writer.option("checkpointLocation", checkpoint or stream_checkpoint(spark, name, beside))
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.queryName(name).start()


def write_records(records: DataFrame, sink: Endpoint, name: str, checkpoint: str | None = None,
                  trigger: dict | None = None) -> StreamingQuery:
    """Append-mode record sink (B3): topic, or text files under ``sink.path``."""
    w = records.select("value").writeStream.outputMode("append")
    if sink.format == "kafka":
        w = w.format("kafka").options(**sink.options).option("topic", sink.topic)
    else:
        w = w.format(sink.format).options(**sink.options).option("path", sink.path)
    return _start(w, name, records.sparkSession, checkpoint, trigger,
                  None if sink.format == "kafka" else sink.path)


def start_filter_job(spark: SparkSession, source: Endpoint, sink: Endpoint,
                     checkpoint: str | None = None, trigger: dict | None = None,
                     allowed_domains=ALLOWED_DOMAINS) -> StreamingQuery:
    """Page messages -> human creations on allowed domains -> processed topic.

    Each micro-batch reports ``filter_in`` / ``filter_out`` row counts in its
    progress (``observedMetrics``), computed in the same pass.
    """
    checkpoint = checkpoint or stream_checkpoint(spark, "page_filter", None if sink.format == "kafka" else sink.path)
    records = _count(read_records(spark, source, checkpoint=checkpoint), "filter_in")
    kept = _count(op.wiki_filter(records, allowed_domains), "filter_out")
    return write_records(kept, sink, "page_filter", checkpoint, trigger)


def start_load_job(spark: SparkSession, source: Endpoint, table: KeyedTable | ConnectorTable,
                   checkpoint: str | None = None, trigger: dict | None = None,
                   metrics: list | None = None, compact_every: int | None = None,
                   rejects_path: str | None = None, counters_path: str | None = None) -> StreamingQuery:
    """J2 + B4: processed messages -> keyed table, one idempotent batch per
    micro-batch: a replayed micro-batch rewrites its own batch, and a job with
    a new checkpoint adds new batches. Empty micro-batches are skipped;
    per-batch counts are appended to ``metrics``. With ``compact_every=k`` the
    table is compacted after every k-th batch, so readers never collapse more
    than k recent batches on top of a snapshot.

    A message without a whole key (malformed ones have none) is a reject. One
    parse serves both ways: the good rows go to the table, and with
    ``rejects_path`` the rejected messages go there as they came, with the
    reason (J7). ``counters_path`` gets a row of counts per run and epoch (D9,
    :func:`read_counters`). Both are written under the epoch's own folder, so a
    replay rewrites them."""
    keyed, spec = isinstance(table, KeyedTable), table.spec
    checkpoint = checkpoint or stream_checkpoint(spark, f"page_load-{spec.name}", table.path if keyed else None)
    run = _run_of(spark, checkpoint)
    records = read_records(spark, source, checkpoint=checkpoint)
    parsed = records.select("value", parse_once(decode("value", PROCESSED_MESSAGE_SCHEMA)).alias("data"))
    missing = F.concat_ws(", ", *[F.when(F.coalesce(F.col(f"data.{c}"), F.lit("")) == "", F.lit(c)) for c in spec.key])
    reason = (F.when(F.try_parse_json("value").isNull(), F.lit("not JSON"))
               .when(~F.ltrim("value").startswith("{"), F.lit("not an object"))
               .otherwise(F.concat(F.lit("missing "), F.col("missing"))))

    def load(batch: DataFrame, batch_id: int) -> None:
        batch = batch.withColumn("missing", missing).persist()  # parsed once for table, rejects and counts
        try:
            seen = batch.agg(F.count(F.lit(1)), F.count_if(F.col("missing") != "")).first()
            if not seen[0]:
                return
            res = table.write_epoch(batch.where("missing = ''").select("data.*"), run, batch_id)
            res["rejected"] = int(seen[1])
            epoch = f"run={run}/epoch={batch_id}"
            if rejects_path:
                (batch.where("missing != ''").select("value", reason.alias("reason"))
                      .write.mode("overwrite").parquet(f"{rejects_path.rstrip('/')}/{epoch}"))
            if counters_path:
                (spark.createDataFrame([(f"page_load-{spec.name}", int(seen[0]), int(seen[0] - seen[1]), int(seen[1]))],
                                       COUNTERS).coalesce(1)
                      .write.mode("overwrite").parquet(f"{counters_path.rstrip('/')}/{epoch}"))
        finally:
            batch.unpersist()
        if compact_every and keyed and (batch_id + 1) % compact_every == 0:
            res["compacted_upto"] = table.compact()
        if metrics is not None:
            metrics.append({"batch_id": batch_id, **res})

    w = parsed.writeStream.foreachBatch(load)
    return _start(w, "page_load", spark, checkpoint, trigger)


COUNTERS = "job string, rows_in long, rows_out long, rejected long"


def read_counters(spark: SparkSession, path: str) -> DataFrame:
    """``job, epochs, rows_in, rows_out, rejected`` over all runs of the jobs
    that write counters at ``path``."""
    rows = spark.read.schema(f"{COUNTERS}, run string, epoch long").parquet(path)
    return rows.groupBy("job").agg(F.count(F.lit(1)).alias("epochs"),
                                   *[F.sum(c).alias(c) for c in ("rows_in", "rows_out", "rejected")])


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    """``value, reason`` of the rejected messages of all runs."""
    return spark.read.schema("value string, reason string, run string, epoch long").parquet(path).select("value", "reason")


def start_archive_job(spark: SparkSession, source: Endpoint, out_path: str,
                      checkpoint: str | None = None, trigger: dict | None = None,
                      now: datetime | str | None = None,
                      writers_per_minute: int = 1) -> StreamingQuery:
    """P5: tweet messages -> per-minute CSV directories.

    Minutes come from each message's own stamp, so a late message goes to its
    older minute; the file sink's commit log makes the output exactly-once.
    Records that are not JSON objects are skipped; ``archive_in`` minus
    ``archive_out`` in the progress reports counts them.

    Rows are shuffled by minute so the minutes of a micro-batch are written
    in parallel, one file per minute and writer. Streams run without AQE,
    so ``writers_per_minute > 1`` salts the minute to spread a hot minute
    over that many writers (a micro-batch's size bounds it either way).
    """
    checkpoint = checkpoint or stream_checkpoint(spark, "tweet_archive", out_path)
    records = _count(read_records(spark, source, "earliest", checkpoint), "archive_in")
    rows = _count(op.archive_rows(records, now).select("minute", *ARCHIVE_COLUMNS), "archive_out")
    if writers_per_minute > 1:
        salt = F.pmod(F.xxhash64(*ARCHIVE_COLUMNS), F.lit(writers_per_minute))
        rows = rows.repartition("minute", salt)
    else:
        rows = rows.repartition("minute")
    w = (rows.writeStream.format("csv").partitionBy("minute").outputMode("append")
         .options(**CSV_WRITE).option("path", out_path))
    return _start(w, "tweet_archive", spark, checkpoint, trigger, out_path)


def start_publish_job(spark: SparkSession, csv_dir: str, columns: list[str], sink: Endpoint,
                      checkpoint: str | None = None, trigger: dict | None = None,
                      now: datetime | str | None = None) -> StreamingQuery:
    """CSV rows (as strings, missing -> "") -> stamped JSON messages.
    ``columns`` is the header, in file order; a file with another header stops
    the stream."""
    schema = StructType([StructField(c, StringType(), True) for c in columns])
    rows = (spark.readStream.schema(schema).options(**CSV_DIALECT).options(**BY_NAME)
            .csv(csv_dir).fillna("", subset=columns))
    return write_records(op.publish_rows(rows, now), sink, "tweet_publish", checkpoint, trigger)


def start_normalise_job(spark: SparkSession, lines: Endpoint, sink: Endpoint,
                        checkpoint: str | None = None, trigger: dict | None = None,
                        now: datetime | str | None = None) -> StreamingQuery:
    """Event-stream lines -> flat page messages (JSON, nulls kept)."""
    checkpoint = checkpoint or stream_checkpoint(spark, "event_normalise", None if sink.format == "kafka" else sink.path)
    msgs = op.sse_to_messages(read_records(spark, lines, checkpoint=checkpoint), now)
    return write_records(op.encode_rows(msgs), sink, "event_normalise", checkpoint, trigger)


def _count(df: DataFrame, name: str) -> DataFrame:
    return df.observe(name, F.count(F.lit(1)).alias("rows"))


def _kept(spark: SparkSession, checkpoint: str, name: str, new) -> str:
    """A word kept in a checkpoint folder: ``new()`` when the folder has none."""
    root = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint.rstrip('/')}/{name}")
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(root) and fs.listStatus(root):
        return fs.listStatus(root)[0].getPath().getName()
    word = new()
    fs.mkdirs(spark._jvm.org.apache.hadoop.fs.Path(root, word))
    return word


def _run_of(spark: SparkSession, checkpoint: str) -> str:
    """The identity of a stream: new when its checkpoint folder is new."""
    return _kept(spark, checkpoint, "_run", lambda: uuid.uuid4().hex)


@dataclass
class _Totals:
    """Row counts of a run: sums over finished micro-batches, and the latest one
    apart, since it may be reported again. One of these a run, however long."""

    batch: int = -1
    rows: int = 0
    seen: dict = field(default_factory=dict)
    rows_before: int = 0
    seen_before: Counter = field(default_factory=Counter)

    def note(self, batch: int, rows: int, seen: dict) -> None:
        if batch > self.batch:
            self.rows_before += self.rows
            self.seen_before.update(self.seen)
            self.batch, self.rows, self.seen = batch, rows, seen
        elif batch == self.batch and rows >= self.rows:
            self.rows, self.seen = rows, seen or self.seen


_totals: dict[str, _Totals] = {}
_listening: set[str] = set()


class _Counters(StreamingQueryListener):
    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        _note(str(event.progress.runId), json.loads(event.progress.json))

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass


def _note(run: str, p: dict) -> None:
    seen = {k: int(v["rows"]) for k, v in (p.get("observedMetrics") or {}).items() if v and "rows" in v}
    _totals.setdefault(run, _Totals()).note(p["batchId"], int(p.get("numInputRows", 0)), seen)


def _listen(spark: SparkSession) -> None:
    app = spark.sparkContext.applicationId
    if app not in _listening:
        spark.streams.addListener(_Counters())
        _listening.add(app)


def _told(query: StreamingQuery) -> _Totals:
    run = str(query.runId)
    for p in query.recentProgress:
        _note(run, p if isinstance(p, dict) else json.loads(p.json))
    return _totals.get(run, _Totals())


def rows_processed(query: StreamingQuery) -> int:
    """Running input-row counter of a query (D9) over all its micro-batches."""
    told = _told(query)
    return told.rows_before + told.rows


def observed_rows(query: StreamingQuery, name: str) -> int:
    """Running total of an ``observe`` counter over all micro-batches."""
    told = _told(query)
    return told.seen_before[name] + told.seen.get(name, 0)
