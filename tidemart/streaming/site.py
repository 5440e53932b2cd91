"""Where the jobs read and write: topics, dimensions and metric tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import jsontext
from ..sinks.tables import DimStore, KeyedTable, MetricTable, read_or_none
from ..sources import cdc, config, readers

# Order of the changes of one dimension row.
CHANGE_ORDER = ("ts", "xid")


@dataclass(frozen=True)
class Site:
    """Topics on Kafka (with `kafka` options) or in folders, tables and checkpoints in folders that all
    executors share."""

    spark: SparkSession
    root: str
    kafka: Mapping[str, str] = field(default_factory=dict)
    # None keeps a job running; the default uses up the present input and ends.
    trigger: Mapping[str, object] = field(default_factory=lambda: {"availableNow": True})
    # What one micro-batch may take from a topic; state that sorts a device's rows of a micro-batch is bounded by it.
    limits: Mapping[str, str] = field(default_factory=dict)
    # Batches of dimension changes after which the state is folded.
    fold_every: int = 100

    # Topics -----------------------------------------------------------------------------------------
    def lines(self, topic: str) -> DataFrame:
        """A topic as one text column `value`."""
        if self.kafka:
            limits = self.limits or {"maxOffsetsPerTrigger": "5000000"}
            return readers.read_topic(self.spark, "kafka", True, None, subscribe=topic, **self.kafka, **limits)
        limits = self.limits or {"maxFilesPerTrigger": "1000"}
        return readers.read_topic(self.spark, "text", True, f"{self.root}/topics/*/topic={topic}", **limits)

    def facts(self, topic: str, schema: str) -> DataFrame:
        """A fact topic with typed columns; records that do not parse, and delete markers, are skipped.
        A value that does not fit its type is null."""
        typed = [column.split() for column in schema.split(", ")]
        as_text = ", ".join(f"{name} string" for name, _ in typed)
        rows = cdc.parse_tolerant(readers.drop_tombstones(self.lines(topic)), as_text)
        return rows.select(*[F.col(name).try_cast(kind).alias(name) for name, kind in typed])

    def publish(self, rows: DataFrame, job: str) -> StreamingQuery:
        """Write (topic, value) rows to their topics, with a `key` column where there is one and the topic is Kafka's."""
        columns = ["key"] if self.kafka and "key" in rows.columns else []
        writer = rows.select(*columns, "topic", "value").writeStream.outputMode("append").option(
            "checkpointLocation", f"{self.root}/checkpoints/{job}").queryName(job)
        writer = writer.trigger(**self.trigger) if self.trigger else writer
        if self.kafka:
            return writer.format("kafka").options(**self.kafka).start()
        return writer.format("text").partitionBy("topic").start(f"{self.root}/topics/{job}")

    def publish_json(self, rows: DataFrame, topic: str, job: str, key: str | None = None) -> StreamingQuery:
        """Rows as JSON. With a key column a compacted topic keeps the last row per key."""
        keyed = [F.col(key).cast("string").alias("key")] if key else []
        return self.publish(rows.select(*keyed, F.lit(topic).alias("topic"), jsontext.record(rows.columns).alias("value")), job)

    # Batches ----------------------------------------------------------------------------------------
    def each_batch(self, rows: DataFrame, job: str, act: Callable[[DataFrame, int], None], mode: str = "append") -> StreamingQuery:
        writer = rows.writeStream.foreachBatch(act).outputMode(mode).option(
            "checkpointLocation", f"{self.root}/checkpoints/{job}").queryName(job)
        return (writer.trigger(**self.trigger) if self.trigger else writer).start()

    # Tables -----------------------------------------------------------------------------------------
    def config(self, name: str) -> DataFrame:
        """Config rows as they are now: a snapshot, if there is one, and the changes that followed."""
        parts = [read_or_none(self.spark, f"{self.root}/config/{name}"), self.config_table(name).read_or_none()]
        found = [p for p in parts if p is not None]
        if not found:
            raise ValueError(f"no configuration {name} below {self.root}")
        return found[0] if len(found) == 1 else found[0].unionByName(found[1], allowMissingColumns=True)

    def config_table(self, name: str) -> KeyedTable:
        """The last change per configured table (and row type): a reader does not go through all there ever were."""
        key = config.FACT_KEY if name == "table_process_dwd" else config.DIM_KEY
        return KeyedTable(self.spark, f"{self.root}/config_changes/{name}", key, ["ts_ms"], buckets=1)

    def dim_store(self) -> DimStore:
        return DimStore(self.spark, f"{self.root}/dims", CHANGE_ORDER)

    def dim(self, name: str, *columns: str) -> DataFrame:
        """A dimension as it is now."""
        return self.dim_store().read_dim(name, "id", ["id", *columns])

    def metric_table(self, name: str) -> MetricTable:
        return MetricTable(self.spark, f"{self.root}/metrics/{name}")

    def fact_table(self, name: str) -> KeyedTable:
        """Facts by key: the last change of each counts."""
        return KeyedTable(self.spark, f"{self.root}/facts/{name}", ["change_id"], ["version"], "op")

    def upsert(self, changes: DataFrame, name: str) -> StreamingQuery:
        """Write changes (change_id, version, op, columns) to their fact table."""
        table = self.fact_table(name)
        return self.each_batch(changes, f"{name}_table", table.write)

    @property
    def forgets(self) -> bool:
        """Whether joins forget idle rows: a run that ends with its present input keeps them for the next."""
        return "availableNow" not in self.trigger

    def metric(self, rows: DataFrame, name: str, names: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> StreamingQuery:
        """Write closed windows. `names` adds dimension names, looked up when the batch is written, so
        that it sees the dimensions of that moment."""
        table = self.metric_table(name)
        return self.each_batch(rows, name, lambda batch, batch_id: table.write(names(batch), batch_id))
