"""Keyed tables and count tables on plain Parquet.

A keyed store's append is an upsert. Without a table format that can merge,
both tables are an append-only log of batches::

    <path>/batch_id=<n>/attempt=<k>/<layout directories>/part-*.parquet
    <path>/_log/...                  empty marker files

* **Batches.** A writer claims the next free number by creating its marker
  exclusively, so two writers never share one. Every write of a batch is a new
  attempt in a folder of its own, and counts from its ``done`` marker on:
  readers take the last finished attempt of each batch, so a replay replaces
  the whole batch and a failed write is never seen. Naming an existing batch is
  an error unless it is a declared replay; a number at or below the newest
  snapshot is refused, since readers no longer look there.
* **Streams** write by (run, epoch): the number given to an epoch is kept, so a
  micro-batch replayed after a failure rewrites its own batch, and a job started
  anew (another run) gets new batches.
* **Reading** collapses the log: a :class:`KeyedTable` to the latest row per
  primary key with a partial-aggregating ``max`` (later batch wins; inside a
  batch the row's values break ties), a :class:`CountTable` to sums.
* **Layout** follows the lookup. A key of many values goes to a hash bucket
  ``b`` (a directory per bucket, never per product or customer), a key of few
  values (``KeySpec.by_value``) to a directory per value. Rows are exchanged by
  ranges of (directory, key, clustering), so a file holds one range of keys: a
  lookup prunes directories by a partition filter and its pushed key equality
  skips every file but the one or two whose range has it. A hot key spans as
  many files as its rows need. The bucket count is kept with the table.
* Rows with a NULL key column (or an empty directory key) are rejected, as a keyed
  store would refuse them, counted, and written to ``rejects_path`` when given.
* :meth:`BatchLog.compact` collapses the log into a snapshot, which keeps each
  row's batch number; :meth:`BatchLog.retire` removes what a snapshot or a later
  attempt has replaced, for when no reader is at work on it.
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from quire.operators.keyed import latest_per_key, null_key
from quire.schemas import KeySpec
from quire.session import discard, tasks_for

BATCH_COL = "batch_id"
ATTEMPT_COL = "attempt"
BUCKET_COL = "b"
VERSION_COL = "written_by"      # a snapshot row's batch
SNAPSHOT = "_compacted/upto"
LOG_DIR = "_log"


def bucket_of(cols: list[Column], buckets: int) -> Column:
    """Stable bucket number of the partition key (Murmur3 hash, same on every
    executor and for literals, so lookups can compute it)."""
    return F.pmod(F.hash(*cols), F.lit(buckets))


class BatchLog:
    """Numbered batches of rows of ``schema`` below ``path``, in directories by
    ``dirs`` (columns that the rows bring along), sorted by ``order``."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, dirs: list[str], order: list[Column]):
        self.spark, self.path, self.schema, self.dirs, self.order = spark, path.rstrip("/"), schema, dirs, order

    # -- markers: empty files, one listing of one small folder ------------------------
    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _marks(self, kind: str) -> list[list[str]]:
        """The parts of the marker names of a kind."""
        p, fs = self._fs(f"{self.path}/{LOG_DIR}")
        if not fs.exists(p):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(p)]
        return [n.split("~")[1:] for n in names if n.startswith(f"{kind}~")]

    def _mark(self, *parts) -> bool:
        """Create a marker; False if it is there already."""
        p, fs = self._fs(f"{self.path}/{LOG_DIR}/{'~'.join(map(str, parts))}")
        try:
            fs.create(p, False).close()
        except Py4JJavaError as e:
            if "FileAlreadyExists" in str(e.java_exception.getClass().getName()):
                return False
            raise
        return True

    def _unmark(self, *parts) -> None:
        discard(self.spark, f"{self.path}/{LOG_DIR}/{'~'.join(map(str, parts))}")

    def _done(self, kind: str = BATCH_COL) -> dict[int, int]:
        """The last finished attempt of each batch (or snapshot)."""
        last: dict[int, int] = {}
        for n, k in self._marks(f"done-{kind}"):
            last[int(n)] = max(int(k), last.get(int(n), -1))
        return last

    def batches(self) -> list[int]:
        """Batches present in the log."""
        return sorted(self._done())

    def snapshot(self) -> tuple[int, str] | None:
        """Newest completed compaction: (last batch it covers, its path)."""
        done = self._done(SNAPSHOT.split("/")[1])
        if not done:
            return None
        n = max(done)
        return n, f"{self.path}/{SNAPSHOT}={n}/{ATTEMPT_COL}={done[n]}"

    def next_batch(self) -> int:
        """The first batch number above every claimed batch and snapshot."""
        snap = self.snapshot()
        return max([-1, *(int(n) for n, _ in self._marks("claim")), *([snap[0]] if snap else [])]) + 1

    def claim(self, batch_id: int | None = None, replay: bool = False) -> tuple[int, int]:
        """(batch, attempt) of a write that no other writer has."""
        while batch_id is None:
            n = self.next_batch()
            if self._mark("claim", n, 0):
                return n, 0
        snap = self.snapshot()
        if snap is not None and batch_id <= snap[0]:
            raise ValueError(f"batch {batch_id} of {self.path} is part of the snapshot up to {snap[0]}")
        k = 0
        while not self._mark("claim", batch_id, k):
            if not replay:
                raise ValueError(f"batch {batch_id} of {self.path} exists; give replay=True to rewrite it")
            k += 1
        return batch_id, k

    def claim_epoch(self, run: str, epoch: int) -> tuple[int, int] | None:
        """The batch of a stream's epoch; None once it is part of a snapshot."""
        mine = [(int(e), int(n)) for r, e, n in self._marks("epoch") if r == run]
        for e, n in mine:
            if e == epoch:
                snap = self.snapshot()
                return None if snap is not None and n <= snap[0] else self.claim(n, replay=True)
        n, k = self.claim()
        self._mark("epoch", run, epoch, n)
        for e, old in mine:  # only the last epoch of a run can be replayed
            if e < epoch:
                self._unmark("epoch", run, e, old)
        return n, k

    # -- rows ------------------------------------------------------------------------
    def _publish(self, rows: DataFrame, kind: str, folder: str, n: int, k: int) -> None:
        w = rows.write.mode("overwrite")
        (w.partitionBy(*self.dirs) if self.dirs else w).parquet(f"{self.path}/{folder}={n}/{ATTEMPT_COL}={k}")
        self._mark(f"done-{kind}", n, k)

    def _clustered(self, rows: DataFrame) -> DataFrame:
        """Rows exchanged and sorted by ranges of directory, key and clustering."""
        order = [*self.dirs, *self.order]
        return rows.repartitionByRange(*order).sortWithinPartitions(*order)

    def _dir_fields(self) -> list[StructField]:
        return [self.schema[d] if d in self.schema.fieldNames() else StructField(d, IntegerType()) for d in self.dirs]

    def log(self, only: list[int] | None = None) -> DataFrame:
        """Every stored version of every row (of some batches), with batch and layout columns."""
        done = {n: k for n, k in self._done().items() if only is None or n in only}
        fields = [f for f in self.schema.fields if f.name not in self.dirs]
        schema = StructType([*fields, StructField(BATCH_COL, LongType()), StructField(ATTEMPT_COL, IntegerType()),
                             *self._dir_fields()])
        if not done:
            return self.spark.createDataFrame([], schema)
        return (self.spark.read.schema(schema).option("basePath", self.path)
                    .parquet(*[f"{self.path}/{BATCH_COL}={n}/{ATTEMPT_COL}={k}" for n, k in sorted(done.items())]))

    def versions(self, below: int | None = None) -> DataFrame:
        """Rows a reader must collapse: the newest snapshot (rows with their own
        batch) and the log after it; with ``below`` only batches under it."""
        snap, done = self.snapshot(), self.batches()
        cols = list(dict.fromkeys([*self.schema.fieldNames(), *self.dirs, BATCH_COL]))
        upto = -1
        rows = None
        if snap is not None:
            upto, path = snap
            fields = [f for f in self.schema.fields if f.name not in self.dirs]
            schema = StructType([*fields, StructField(VERSION_COL, LongType()), *self._dir_fields()])
            rows = (self.spark.read.schema(schema).parquet(path)
                        .withColumn(BATCH_COL, F.col(VERSION_COL)).select(*cols))
        recent = [n for n in done if n > upto and (below is None or n < below)]
        if recent or rows is None:
            later = self.log(recent).where(F.col(BATCH_COL) > F.lit(upto)).select(*cols)
            rows = later if rows is None else rows.unionByName(later)
        return rows

    def collapse(self, rows: DataFrame) -> DataFrame:
        raise NotImplementedError

    def compact(self) -> int | None:
        """Collapse the log up to its newest batch into a snapshot; returns that
        batch (None when there is none). Repeating it changes nothing."""
        batches, snap = self.batches(), self.snapshot()
        if not batches:
            return snap[0] if snap else None
        upto = max(batches)
        if snap is not None and snap[0] >= upto:
            return snap[0]
        kind = SNAPSHOT.split("/")[1]
        k = max([-1, *(int(a) for n, a in self._marks(f"claim-{kind}") if int(n) == upto)]) + 1
        while not self._mark(f"claim-{kind}", upto, k):
            k += 1
        rows = self.collapse(self.versions(below=upto + 1)).withColumnRenamed(BATCH_COL, VERSION_COL)
        self._publish(self._clustered(rows), kind, SNAPSHOT, upto, k)
        return upto

    def retire(self) -> None:
        """Remove batches inside the snapshot, earlier snapshots and replaced
        attempts, with their markers. Not while a reader is at work on them."""
        snap, done = self.snapshot(), self._done()
        kind = SNAPSHOT.split("/")[1]
        for n, k in [(int(n), int(k)) for n, k in self._marks("claim")]:
            covered = snap is not None and n <= snap[0]
            if covered or (n in done and k < done[n]):
                discard(self.spark, f"{self.path}/{BATCH_COL}={n}/{ATTEMPT_COL}={k}")
                self._unmark(f"done-{BATCH_COL}", n, k)
                if covered:
                    self._unmark("claim", n, k)
        for n, k in [(int(n), int(k)) for n, k in self._marks(f"claim-{kind}")]:
            path = f"{self.path}/{SNAPSHOT}={n}/{ATTEMPT_COL}={k}"
            if snap is not None and n <= snap[0] and path != snap[1]:
                discard(self.spark, path)
                self._unmark(f"done-{kind}", n, k)
                self._unmark(f"claim-{kind}", n, k)


class KeyedTable(BatchLog):
    """A log of rows by primary key; reading gives the latest row per key."""

    def __init__(self, spark: SparkSession, path: str, spec: KeySpec, rejects_path: str | None = None):
        order = [*[F.col(c) for c in spec.partition_key], *[F.col(c).desc() if d else F.col(c) for c, d in spec.clustering]]
        super().__init__(spark, path, spec.schema, list(spec.partition_key) if spec.by_value else [BUCKET_COL], order)
        self.spec = spec
        self.rejects_path = rejects_path.rstrip("/") if rejects_path else None

    def buckets(self, create: bool = False) -> int:
        """The table's bucket count: what it was written with, else the spec's."""
        kept = self._marks("buckets")
        if kept:
            return min(int(n) for n, in kept)
        if create:
            self._mark("buckets", self.spec.buckets)
        return self.spec.buckets

    # -- write -------------------------------------------------------------------
    def write_epoch(self, df: DataFrame, run: str, epoch: int) -> dict:
        """Upsert micro-batch ``epoch`` of stream ``run``; a replay of an epoch
        rewrites the batch it was given, or does nothing once that batch is
        part of a snapshot."""
        given = self.claim_epoch(run, epoch)
        if given is None:
            return {"rows": 0, "rejected": 0}
        return {**self.write_claimed(df, *given), "batch": given[0]}

    def write_batch(self, df: DataFrame, batch_id: int | None = None, replay: bool = False) -> dict:
        """Upsert ``df`` as a new batch (or as ``batch_id``, again with
        ``replay``, which replaces all of it); returns written/rejected counts."""
        return self.write_claimed(df, *self.claim(batch_id, replay))

    def write_claimed(self, df: DataFrame, n: int, k: int) -> dict:
        """Write ``df`` as a claimed attempt."""
        spec = self.spec
        bad = null_key(spec.key)
        if spec.by_value:  # a directory has no empty name, nor a keyed store an empty partition key
            for c in spec.partition_key:
                bad = bad | (F.col(c) == F.lit(""))
        typed = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields])
        out = typed
        if not spec.by_value:
            out = out.withColumn(BUCKET_COL, bucket_of([F.col(c) for c in spec.partition_key], self.buckets(create=True)))
        # counted behind the exchange: the sampling of its ranges must not count too
        obs = Observation(f"{spec.name}_batch_{n}_{k}")
        out = self._clustered(out).observe(obs, F.count_if(~bad).alias("rows"), F.count_if(bad).alias("rejected"))
        self._publish(out.filter(~bad), BATCH_COL, BATCH_COL, n, k)
        res = {c: int(obs.get.get(c) or 0) for c in ("rows", "rejected")}
        if self.rejects_path:
            # rows with a NULL key column, kept per batch for inspection; a replay replaces them
            path = f"{self.rejects_path}/{BATCH_COL}={n}"
            if res["rejected"]:
                typed.filter(bad).write.mode("overwrite").parquet(path)
            elif k:
                discard(self.spark, path)
        return res

    # -- read ----------------------------------------------------------------------
    def collapse(self, rows: DataFrame) -> DataFrame:
        key = [*(d for d in self.dirs if d not in self.spec.key), *self.spec.key]
        return latest_per_key(rows, key, order=[BATCH_COL])

    def read(self, **equal_to) -> DataFrame:
        """Latest row per key; ``equal_to`` restricts to key values (a lookup)."""
        spec = self.spec
        if self.snapshot() is None and not self.batches():
            raise FileNotFoundError(f"keyed table {spec.name} at {self.path} has no batches yet")
        df = self.versions()
        for c, v in equal_to.items():
            if c not in spec.key:
                raise ValueError(f"{c} is not a key column of {spec.name}")
            df = df.where(F.col(c) == F.lit(v))
        if not spec.by_value and all(c in equal_to for c in spec.partition_key):
            lit_key = [F.lit(equal_to[c]).cast(df.schema[c].dataType) for c in spec.partition_key]
            df = df.where(F.col(BUCKET_COL) == bucket_of(lit_key, self.buckets()))
        return self.collapse(df).select(*spec.columns)


class CountTable(BatchLog):
    """Signed counts by key, in files of key ranges from ``by`` on (its pushed
    equality skips all others); reading sums them and leaves out what has come
    to zero. A batch holds the changes that one feed made, so a replay replaces
    them and a count can fall."""

    COUNT = "review_count"

    def __init__(self, spark: SparkSession, path: str, schema: StructType, by: str):
        self.key = [c for c in schema.fieldNames() if c != self.COUNT]
        super().__init__(spark, path, schema, [], [F.col(by), *[F.col(c) for c in self.key if c != by]])

    def write_batch(self, changes: DataFrame, batch_id: int | None = None, replay: bool = False,
                    clustered: bool = False) -> int:
        """``clustered`` rows are in ranges and order of the key already."""
        n, k = self.claim(batch_id, replay)
        rows, obs = changes.select(*self.schema.fieldNames()), Observation(f"counts_{n}_{k}")
        out = (rows if clustered else self._clustered(rows)).observe(obs, F.count(F.lit(1)).alias("rows"))
        self._publish(out, BATCH_COL, BATCH_COL, n, k)
        return int(obs.get.get("rows") or 0)

    def collapse(self, rows: DataFrame) -> DataFrame:
        return (rows.groupBy(*self.key).agg(F.sum(self.COUNT).alias(self.COUNT), F.max(BATCH_COL).alias(BATCH_COL))
                    .where(F.col(self.COUNT) != 0))

    def read(self, **equal_to) -> DataFrame:
        df = self.versions()
        for c, v in equal_to.items():
            df = df.where(F.col(c) == F.lit(v))
        if not equal_to:  # a key has few rows, one a batch: nothing to sum before the exchange
            df = df.repartition(tasks_for(self.spark, df.count()), *self.key)
        return self.collapse(df).select(*self.schema.fieldNames())


class ConnectorTable:
    """A keyed table kept in an external keyed store reached by a Spark
    connector (e.g. ``format="org.apache.spark.sql.cassandra"`` with
    ``options={"keyspace": ..., "table": ...}``). The store upserts on its
    primary key itself, so a batch is a plain append and a replayed batch
    rewrites the same rows. Same interface as :class:`KeyedTable`.
    """

    def __init__(self, spark: SparkSession, spec: KeySpec, format: str, options: dict):
        self.spark, self.spec, self.format, self.options = spark, spec, format, dict(options)

    def write_epoch(self, df: DataFrame, run: str, epoch: int) -> dict:
        return self.write_batch(df, epoch)

    def write_batch(self, df: DataFrame, batch_id: int | None = None, replay: bool = False) -> dict:
        spec = self.spec
        bad = null_key(spec.key)
        obs = Observation(f"{spec.name}_batch_{batch_id}")
        rows = df.select(*spec.columns).observe(
            obs, F.count_if(~bad).alias("rows"), F.count_if(bad).alias("rejected"))
        (rows.filter(~bad).write.format(self.format).mode("append")
             .options(**self.options).save())
        got = obs.get
        return {"rows": int(got.get("rows") or 0), "rejected": int(got.get("rejected") or 0)}

    def read(self, **equal_to) -> DataFrame:
        """Rows of the store (already one per key); key equalities are pushed
        to the connector."""
        df = self.spark.read.format(self.format).options(**self.options).load()
        for c, v in equal_to.items():
            if c not in self.spec.key:
                raise ValueError(f"{c} is not a key column of {self.spec.name}")
            df = df.where(F.col(c) == F.lit(v))
        return df.select(*self.spec.columns)
