"""Tables written batch by batch.

Metric and keyed tables have a commit log (commits.py): a batch is prepared in a folder of its own and counts from the moment
its manifest is there. A replay after a failure replaces its batch; writing costs as much as the batch, and folding now and
then as much as what is folded. Dimensions have a store of their own.
"""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .. import fixed
from ..operators import dims, firsts
from .commits import CommitLog, Entry

BATCH, BUCKET = "batch_id", "bucket"


def read_or_none(spark: SparkSession, path: str, schema=None) -> DataFrame | None:
    """A Parquet folder, or None while nothing has been written there."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return None
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


class MetricTable:
    """Append-only rows, each batch exactly once. A batch without rows leaves no file."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.log = CommitLog(spark, path)

    def write(self, rows: DataFrame, batch_id: int) -> None:
        self.log.add(batch_id, self.log.prepare(rows))
        if self.log.fold(lambda folders: self.log.prepare(self._of(folders).coalesce(1))):
            self.log.expire()

    def _of(self, folders: list[str]) -> DataFrame:
        return self.spark.read.option("mergeSchema", "true").parquet(*[f"{self.log.path}/data/{f}" for f in folders])

    def read_or_none(self) -> DataFrame | None:
        """The rows committed by now, None while there are none."""
        folders = [e.folder for e, _ in self.log.folders()]
        return self._of(folders) if folders else None

    def read(self) -> DataFrame:
        rows = self.read_or_none()
        if rows is None:
            raise ValueError(f"no rows in {self.path} yet")
        return rows


class KeyedTable:
    """Upsert by key: the row of the greatest `order` per key counts, then of the latest batch, then the greatest digest of
    `identity`. A row of type 'delete' in `row_type` removes the key; it is kept as a marker, so that an older row that comes
    later does not bring the key back.

    Rows lie in hash buckets of their key. A read merges the base with the batches after it; while these are small next to it,
    the base goes through no shuffle. Every `fold_every` batches they go into a new base, bucket by bucket.
    """

    def __init__(self, spark: SparkSession, path: str, key: Sequence[str], order: Sequence[str] = (), row_type: str | None = None,
                 identity: Sequence[str] = (), buckets: int = 16, fold_every: int = 20):
        self.spark, self.path = spark, path
        self.key, self.order, self.row_type = list(key), list(order), row_type
        self.identity, self.buckets, self.fold_every = list(identity), buckets, fold_every
        self.log = CommitLog(spark, path)

    def _last(self, rows: DataFrame) -> DataFrame:
        order = [*self.order, BATCH]
        identity = self.identity or [c for c in rows.columns if c not in (*self.key, *order, BUCKET)]
        return firsts.latest_version(rows, self.key, order, identity, rows.columns).select(*rows.columns)

    def write(self, rows: DataFrame, batch_id: int) -> None:
        """Within a batch the last row per key is all that can count."""
        bucket = F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int")
        last = self._last(rows.withColumn(BATCH, F.lit(batch_id).cast("long")))
        last = last.withColumn(BUCKET, bucket)
        if last.sparkSession.conf.get("spark.sql.adaptive.enabled") != "true":
            last = last.repartition(BUCKET)  # nothing merges small parts here, as in streams: a file per bucket, not per part
        self.log.add(batch_id, self.log.prepare(last, BUCKET))
        entries = self.log.manifest().entries
        if sum(e.level == 0 for e in entries) > self.fold_every:
            self.compact()

    def compact(self, newest: int = 1) -> None:
        """Fold all batches but the newest, which may come again, into the base."""
        entries = self.log.manifest().entries
        some = entries[:len(entries) - newest] if newest else entries
        if not some or all(e.level for e in some):
            return
        merged = self._merged([(e, f"{self.log.path}/data/{e.folder}") for e in some if e.folder], None)
        made = self.log.prepare(merged.repartition(BUCKET), BUCKET) if merged is not None else (None, 0)
        self.log.commit([Entry(some[0].first, some[-1].last, 1, *made), *entries[len(some):]])
        self.log.expire()

    def _rows(self, paths: list[str], buckets: Sequence[int] | None) -> DataFrame | None:
        if not paths:
            return None
        parts = [self.spark.read.parquet(p) for p in paths]
        rows = parts[0]
        for more in parts[1:]:
            rows = rows.unionByName(more, allowMissingColumns=True)
        return rows if buckets is None else rows.where(F.col(BUCKET).isin(*buckets))

    def _merged(self, folders, buckets: Sequence[int] | None) -> DataFrame | None:
        """The last row per key, delete markers included."""
        base = self._rows([p for e, p in folders if e.level], buckets)
        later = self._rows([p for e, p in folders if not e.level], buckets)
        if later is None:
            return base  # has one row per key
        if sum(1 for e, _ in folders if not e.level) > 1:
            # A batch has one row per key, so order and batch tell all rows of a key apart; no digest goes along.
            later = firsts.latest_per(later, self.key, [*self.order, BATCH])
        if base is None:
            return later
        names = list(dict.fromkeys([*base.columns, *later.columns]))
        base, later = (d.select(*[F.col(c) if c in d.columns else F.lit(None).alias(c) for c in names]) for d in (base, later))
        order = [*self.order, BATCH]
        marks = later.select(*[F.col(k).alias(f"_{k}") for k in self.key], F.struct(*order).alias("_of"))
        same = None
        for k in self.key:
            one = F.col(k).eqNullSafe(F.col(f"_{k}"))
            same = one if same is None else same & one
        # A key is in one bucket, so what is older than a later batch's row is found by key alone.
        kept = base.join(marks, same & (F.struct(*order) <= F.col("_of")), "left_anti")
        newer = base.join(marks, same & (F.struct(*order) > F.col("_of")), "left_semi").select(
            *[F.col(k).alias(f"_{k}") for k in self.key])
        return kept.unionByName(later.join(newer, same, "left_anti"))

    def bucket_of(self, *values) -> int:
        """The bucket of a key: a reader that asks for it reads no other."""
        row = self.spark.createDataFrame([values], T.StructType([T.StructField(k, t) for k, t in zip(self.key, self._types())]))
        return row.select(F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int")).first()[0]

    def _types(self):
        fields = {f.name: f.dataType for f in self.spark.read.parquet(self.log.folders()[-1][1]).schema.fields}
        return [fields[k] for k in self.key]

    def read_or_none(self) -> DataFrame | None:
        return self.read() if self.log.folders() else None

    def read(self, buckets: Sequence[int] | None = None) -> DataFrame:
        """The rows as of the last commit; `buckets` names those to read."""
        rows = self._merged(self.log.folders(), buckets)
        if rows is None:
            raise ValueError(f"no rows in {self.path} yet")
        rows = rows.drop(BATCH, BUCKET)
        return rows if self.row_type is None else rows.where(F.coalesce(F.col(self.row_type), F.lit("")) != fixed.DELETE)


class DimStore:
    """All dimensions: routed changes in batches, merged column by column on reading.

    One write per batch serves every dimension; a reader prunes to its own by the partition column. Now and then a
    dimension is folded: its state goes into a base, and readers merge that with the batches after it. Batches lie in one
    folder per FOLD of them, so a reader lists those since its base, not all there ever were.
    """

    FOLD = 100

    def __init__(self, spark: SparkSession, path: str, order: Sequence[str]):
        self.spark, self.path, self.order = spark, path, list(order)

    def write(self, routed: DataFrame, batch_id: int) -> None:
        rows = routed.select("sink_table", "type", *self.order, "data")
        rows.write.mode("overwrite").partitionBy("sink_table").parquet(
            f"{self.path}/changes/part={batch_id // self.FOLD}/{BATCH}={batch_id}")

    def _schema(self) -> str:
        order = ", ".join(f"{c} bigint" for c in self.order)
        return f"type string, {order}, data map<string,string>, part long, {BATCH} long, sink_table string"

    def _files(self) -> tuple[object, object]:
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/changes")
        return folder.getFileSystem(self.spark._jsc.hadoopConfiguration()), folder

    def _parts(self) -> list[int]:
        """The folders of batches: one name per FOLD of them."""
        files, folder = self._files()
        if not files.exists(folder):
            return []
        return sorted(int(s.getPath().getName().split("=")[1]) for s in files.listStatus(folder)
                      if s.getPath().getName().startswith("part="))

    def changes(self, table: str, after: int | None = None, upto: int | None = None) -> DataFrame:
        """Changes of one dimension, from the batches after the one and up to the other."""
        first = -1 if after is None else after // self.FOLD
        paths = [f"{self.path}/changes/part={p}" for p in self._parts()
                 if p >= first and (upto is None or p <= upto // self.FOLD)]
        reader = self.spark.read.schema(self._schema()).option("basePath", f"{self.path}/changes")
        rows = reader.parquet(*paths) if paths else self.spark.createDataFrame([], self._schema())
        rows = rows.where(F.col("sink_table") == table).drop("part")
        rows = rows if after is None else rows.where(F.col(BATCH) > after)
        return rows if upto is None else rows.where(F.col(BATCH) <= upto)

    def base(self, table: str) -> tuple[int | None, str | None]:
        """(last batch of the base, its folder or None for an empty one), (None, None) without a base."""
        rows = read_or_none(self.spark, f"{self.path}/bases/of={table}", "upto bigint, at string, made bigint")
        last = rows.orderBy(F.desc("upto"), F.desc("made")).first() if rows is not None else None
        return (last.upto, last.at or None) if last else (None, None)

    def _point(self, table: str, upto: int, at: str) -> None:
        made = time.time_ns()
        self.spark.createDataFrame([(upto, at, made)], "upto bigint, at string, made bigint").coalesce(1).write.mode("append").parquet(
            f"{self.path}/bases/of={table}")

    def read_dim(self, table: str, key: str, columns: Sequence[str], upto: int | None = None) -> DataFrame:
        """A dimension as it is now (or after batch `upto`): its base, if it has one, and the changes after it. Before
        the first batch it is empty."""
        after, at = self.base(table)
        order, changes = [*self.order, BATCH], self.changes(table, after, upto)
        if at is None:
            return dims.dim_upsert(changes, key, columns, order)
        names = [key, *[c for c in columns if c != key]]
        schema = ", ".join(f"`{c}` string" for c in names)
        return dims.merge_dim(self.spark.read.schema(schema).parquet(at), changes, key, columns, order)

    def fold(self, table: str, key: str, columns: Sequence[str], upto: int) -> None:
        """Write the state after batch `upto` as the base of later reads."""
        at = f"{self.path}/states/{table}/upto={upto}"
        self.read_dim(table, key, columns, upto).write.mode("overwrite").parquet(at)
        self._point(table, upto, at)

    def clear(self, table: str) -> None:
        """Forget what the batches so far say of a dimension."""
        files, folder = self._files()
        last = [int(s.getPath().getName().split("=")[1]) for p in self._parts()[-1:]
                for s in files.listStatus(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/changes/part={p}"))
                if s.getPath().getName().startswith(f"{BATCH}=")]
        if last:
            self._point(table, max(last), "")
