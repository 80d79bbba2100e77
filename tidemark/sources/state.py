"""Current-state tables: the operations the jobs need (insert-if-absent, NULL-preserving patch, upsert, tenant
erasure, replace, append) behind two stores.

``DeltaStore`` (needs delta-spark on the class path) runs each operation as a Delta ``MERGE``. This is the
production path; Delta is not installed in this environment, so its tests are skipped here.

``ParquetStore`` is the portable store, on Spark's own writers alone. A table is a Parquet folder partitioned by a
bucket of its keys. A batch stages its change set; an operation joins that with the buckets its keys fall into and
rewrites those buckets with ``partitionOverwriteMode=dynamic``. Tables with a tenant
are bucketed by tenant group and, within it, by key, so reads for some tenants read only their groups and a large
tenant is still split.

What both share:

* **Eras.** ``begin(run, batch)`` gives a batch its era, the number of erasures so far, and remembers it under the run; a
  batch that starts again gets the era of its first attempt, one that is older than the run's last is not applied
  again. One row per run is kept, whatever the number of batches.
* **Erased tenants are a table**, ``(tenant, era)``. Rows carry the era they were written in, and every read leaves out
  the rows of tenants erased in a later one. So an erasure takes effect at once in all tables, hides what a running
  or replayed batch writes from before it, and leaves what later batches bring. ``purge`` takes the hidden rows
  off the disk; the job that writes a table calls it when there were erasures since its last batch.
* **One job writes a table**; the jobs share the erased tenants only. Spark's dynamic overwrite commits by moving whole
  buckets, so a driver that dies in the middle leaves the rest of them beside the table; ``recover``, called when a job
  starts, writes those. A job that reads another job's Parquet table may meet a bucket that is being replaced;
  Delta isolates readers.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.merge import merge_insert, merge_insert_patch, merge_upsert
from tidemark.session import lean_writes

BUCKET, ERA = "__bucket", "__era"
NO_ERA = -1      # of rows that only hold a bucket's place
#: Staged bytes (zstd) that are merged at a time: a merge's shuffles hold the rows three times over, about four times as large.
SLICE_BYTES = 2 << 30


def empty_frame(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """An empty frame of ``schema`` with real column attributes (so key conditions on
    it stay equi-join keys) and no partitions (no task, no Python worker)."""
    return spark.createDataFrame(spark.sparkContext.emptyRDD(), schema)


def stream_id(spark: SparkSession, default: str = "batch") -> str:
    """Id of the streaming query whose ``foreachBatch`` is running. It is kept in the query's
    checkpoint, so a new checkpoint (whose batch ids start at 0 again) has a new id."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId") or default


@dataclass(frozen=True)
class Layout:
    """How a table is dealt into buckets: ``groups`` by tenant (if it has one) times ``parts`` by key."""
    key: str | None = None
    tenant: str | None = None
    groups: int = 1
    parts: int = 1

    def group(self, tenant: Column) -> Column:
        return F.pmod(F.xxhash64(tenant.cast("bigint")), F.lit(self.groups)).cast("int")

    def bucket(self, key: str | None = None) -> Column:
        """The bucket of a row; ``key`` names its key column where it is not the table's."""
        part = F.pmod(F.xxhash64(F.col(key or self.key).cast("string")), F.lit(self.parts)).cast("int") if self.key else F.lit(0)
        return F.coalesce(part if self.tenant is None else self.group(F.col(self.tenant)) * self.parts + part, F.lit(0))


#: Default buckets: few, as each is rewritten whole; large tables are given more.
LAYOUTS = {
    "users": Layout("_id", parts=16),
    "registrations": Layout("_id", parts=16),
    "user_registrations": Layout("_id", "organiser_id", 8, 2),
    "prospects": Layout("prospect_id", "organiser_Id", 8, 2),
    "contacts": Layout("SF_Id", "organiser_Id", 8, 2),
    "opportunities": Layout("opportunity_Id", "organiser_Id", 8, 2),
    "event_agg": Layout("event_id", "organiser_Id", 8, 1),
    "contacts_batch": Layout("SF_Id", "organiser_Id", 8, 2),
    "cdc_dead_letters": Layout(None, "organiser_Id"),
    "crm_dead_letters": Layout(None, "organiser_Id"),
}
#: Tables that only grow, and what makes a row of them one (a repeated append shows once).
_MESSAGE = ["topic", "partition", "offset", "decoder", "reason"]
APPENDED = {"cdc_dead_letters": _MESSAGE, "crm_dead_letters": _MESSAGE}
#: The tables of each job.
CDC_TABLES = ("users", "registrations", "user_registrations", "cdc_dead_letters")
CRM_TABLES = ("prospects", "contacts", "opportunities", "event_agg", "contacts_batch", "crm_dead_letters")


class StateStore:
    """What both stores share; a store says how tables are loaded and written."""
    fmt = "parquet"

    def __init__(self, spark: SparkSession, root: str, layouts: dict[str, Layout] | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.layouts = {**LAYOUTS, **(layouts or {})}

    def _path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def _layout(self, table: str) -> Layout:
        return self.layouts.get(table, Layout())

    def _found(self, pattern: str) -> list:
        """Files or folders of that name. (Reading a table that is not there would fail.)"""
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{pattern}")
        found = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
        return [f.getPath() for f in found] if found else []

    def _load(self, table: str) -> DataFrame | None:
        """The table as stored, or None where it has no rows yet. All tables are partitioned."""
        return self.spark.read.parquet(self._path(table)) if self._found(f"{table}/*=*") else None

    # -- eras and erasures ------------------------------------------------------------------
    def era(self) -> int:
        erased = self._load("_erased")
        return 0 if erased is None else erased.agg(F.max(ERA)).first()[0] or 0

    def begin(self, run: str, batch_id: int) -> tuple[int, int] | None:
        """``(era of this batch, era of the run's last batch)``; None for a batch that a later one of the run has
        followed: it was finished."""
        runs = self._load("_runs")
        last = None if runs is None else runs.filter(F.col("run") == run).first()
        if last is not None and last["batch_id"] > batch_id:
            return None
        if last is not None and last["batch_id"] == batch_id:
            return last[ERA], last["before"]
        now, before = self.era(), 0 if last is None else last[ERA]
        row = self.spark.range(1).select(F.lit(batch_id).cast("bigint").alias("batch_id"), F.lit(now).cast("bigint").alias(ERA),
                                         F.lit(before).cast("bigint").alias("before"), F.lit(run).alias("run"))
        self._replace_parts("_runs", row, ["run"])
        return now, before

    def _replace_parts(self, table: str, rows: DataFrame, by: list[str]) -> None:
        with lean_writes(rows.sparkSession):
            rows.write.format(self.fmt).mode("overwrite").options(partitionOverwriteMode="dynamic", compression="zstd").partitionBy(*by).save(self._path(table))

    def erase(self, tenants: DataFrame, era: int) -> int:
        """From now on the tenants' rows of earlier eras are left out everywhere. ``era`` is that of the
        erasing batch; returns the era that begins, which the batch's own later writes carry. Doing it again
        changes nothing."""
        rows = tenants.select(F.col(tenants.columns[0]).cast("bigint").alias("tenant"), F.lit(era + 1).cast("bigint").alias(ERA)).distinct()
        self._replace_parts("_erased", rows, [ERA])
        return era + 1

    def _visible(self, table: str, stored: DataFrame) -> DataFrame:
        """Rows that are not erased; their era stays."""
        out = stored.filter(F.col(ERA) > NO_ERA)
        tenant, erased = self._layout(table).tenant, self._load("_erased")
        if tenant is None or erased is None or tenant not in stored.columns:
            return out
        gone = erased.groupBy(F.col("tenant").alias("__tenant")).agg(F.max(ERA).alias("__erased_in"))
        return out.join(gone, (F.col(tenant) == F.col("__tenant")) & (F.col(ERA) < F.col("__erased_in")), "left_anti")

    # -- reading ------------------------------------------------------------------------------
    def read(self, table: str, schema: T.StructType | None = None, only: list[int] | None = None) -> DataFrame | None:
        """The current rows (of the buckets in ``only``); an empty frame of ``schema`` (or None)
        when the table was never written."""
        stored = self._load(table)
        if stored is None:
            return None if schema is None else empty_frame(self.spark, schema)
        if only is not None and BUCKET in stored.columns:
            stored = stored.filter(F.col(BUCKET).isin(only))
        out = self._visible(table, stored).drop(BUCKET, ERA)
        return out.dropDuplicates(APPENDED[table]) if table in APPENDED else out

    def read_tenants(self, table: str, tenants: DataFrame, schema: T.StructType | None = None) -> DataFrame | None:
        """The current rows of the tenants' groups (other tenants of those groups included)."""
        return self.read(table, schema, self._of_tenants(table, tenants))

    def _of_tenants(self, table: str, tenants: DataFrame) -> list[int] | None:
        layout = self._layout(table)
        if layout.tenant is None:
            return None
        groups = [r[0] for r in tenants.select(layout.group(F.col(tenants.columns[0]))).distinct().collect()]   # at most ``groups``
        return sorted(g * layout.parts + i for g in groups if g is not None for i in range(layout.parts))

    def touched(self, table: str, rows: DataFrame) -> list[int]:
        """The buckets that ``rows`` (with the table's key columns) fall into."""
        # at most groups x parts values
        return sorted(r[0] for r in rows.select(self._layout(table).bucket().alias("b")).distinct().collect())

    # -- writing ------------------------------------------------------------------------------
    def bucket_of(self, table: str, where: Column | None = None, key: str | None = None) -> Column:
        """The bucket of ``table`` that a row belongs to, or null unless ``where``."""
        bucket = self._layout(table).bucket(key)
        return bucket if where is None else F.when(where, bucket)

    def stage(self, name: str, df: DataFrame, near: dict[str, Column] | None = None) -> tuple[DataFrame, dict[str, list[int]]]:
        """``df`` written beside the tables and read back: what a batch uses several times, without its lineage.
        The next stage of that name replaces it. Also the values of the ``near`` columns (see ``bucket_of``),
        observed while it is written: at most as many as a table has buckets."""
        path, seen = f"{self.root}/_staged/{name}", Observation(f"buckets-{name}")
        out = df.observe(seen, F.count(F.lit(1)).alias("rows"), *(F.collect_set(b).alias(t) for t, b in (near or {}).items()))
        with lean_writes(df.sparkSession):
            out.write.mode("overwrite").parquet(path, compression="zstd")
        return self.spark.read.schema(df.schema).parquet(path), {t: sorted(seen.get[t]) for t in near or {}}

    def slices(self, name: str, buckets: list[int]) -> list[list[int]]:
        """``buckets`` in as many lists as the staged ``name`` has ``SLICE_BYTES``, one at least: what a large batch
        changes in them is merged list by list, and the disk holds the shuffles of one."""
        paths = self._found(f"_staged/{name}")
        size = sum(p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(p).getLength() for p in paths)
        n = max(1, min(-(-size // SLICE_BYTES), len(buckets)))
        return [buckets[i::n] for i in range(n)]

    def unstage(self, *names: str) -> None:
        """Delete what was staged under these names: a batch does so as soon as it has read it for the last time."""
        for name in names:
            for path in self._found(f"_staged/{name}"):
                path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)

    def append(self, table: str, df: DataFrame, era: int = 0) -> None:
        """Add rows; nothing is read or rewritten."""
        (df.withColumns({ERA: F.lit(era).cast("bigint"), BUCKET: F.lit(0)})
         .write.format(self.fmt).mode("append").option("compression", "zstd").partitionBy(BUCKET).save(self._path(table)))

    def insert_if_absent(self, table: str, src: DataFrame, keys: Sequence[str], era: int = 0, touched: list[int] | None = None) -> None:
        raise NotImplementedError

    def upsert(self, table: str, src: DataFrame, keys: Sequence[str], era: int = 0, touched: list[int] | None = None) -> None:
        raise NotImplementedError

    def insert_then_patch(self, table: str, inserts: DataFrame, patches: DataFrame, keys: Sequence[str],
                          cols: Sequence[str], era: int = 0, touched: list[int] | None = None, unset: str | None = None) -> None:
        raise NotImplementedError

    def put(self, table: str, df: DataFrame, era: int = 0) -> None:
        raise NotImplementedError

    def purge(self, tables: Sequence[str], since: int = 0) -> None:
        """Take the rows of tenants erased in eras after ``since`` off the disk."""
        raise NotImplementedError

    def recover(self, tables: Sequence[str]) -> None:
        """Finish what a driver that died had begun to write."""


class ParquetStore(StateStore):
    def _dealt(self, table: str, df: DataFrame) -> DataFrame:
        """Rows with their bucket, few files a bucket, a large bucket split over tasks."""
        return df.withColumn(BUCKET, self._layout(table).bucket()).hint("rebalance", BUCKET)

    def _places(self, like: DataFrame, buckets: Sequence[int]) -> DataFrame:
        """One row a bucket that holds nothing but its place, so that overwriting reaches buckets that end up empty."""
        held = self.spark.range(1).select(F.explode(F.array(*map(F.lit, buckets))).alias(BUCKET))
        return held.select(*(F.lit(NO_ERA).cast("bigint").alias(ERA) if f.name == ERA else F.lit(None).cast(f.dataType).alias(f.name)
                             for f in like.schema.fields if f.name != BUCKET), BUCKET)

    def _rewrite(self, table: str, rows: DataFrame, buckets: Sequence[int]) -> None:
        """``rows`` (with their era) become the content of ``buckets``. All tasks have read what they need when
        Spark replaces the buckets."""
        dealt = self._dealt(table, rows)
        self._replace_parts(table, dealt.unionByName(self._places(dealt, buckets or [0])), [BUCKET])

    def recover(self, tables: Sequence[str]) -> None:
        for table in tables:
            for done in self._found(f"{table}/.spark-staging-*/_SUCCESS"):      # written whole, moved in part
                left = done.getParent()
                if self._found(f"{table}/{left.getName()}/*=*"):
                    self._replace_parts(table, self.spark.read.parquet(left.toString()), [BUCKET])
                left.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(left, True)

    def put(self, table: str, df: DataFrame, era: int = 0) -> None:
        """Replace the whole table."""
        dealt = self._dealt(table, df.withColumn(ERA, F.lit(era).cast("bigint")))
        with lean_writes(df.sparkSession):
            dealt.unionByName(self._places(dealt, [0])).write.mode("overwrite").partitionBy(BUCKET).parquet(self._path(table), compression="zstd")

    def _change(self, table: str, changes: Sequence[DataFrame], era: int, touched: list[int] | None, merge) -> None:
        """Merge batch-sized ``changes`` (staged, or cheap to evaluate again) into the buckets they touch."""
        changes = [c.withColumn(ERA, F.lit(era).cast("bigint")) for c in changes]
        if touched is None:
            touched = sorted(set().union(*(self.touched(table, c) for c in changes)))
        stored = self._load(table)
        if stored is None:
            base = empty_frame(self.spark, changes[0].schema)
        elif not touched:
            return
        else:
            base = self._visible(table, stored.filter(F.col(BUCKET).isin(touched))).select(changes[0].columns)
        self._rewrite(table, merge(base, *changes), touched)

    def insert_if_absent(self, table: str, src: DataFrame, keys: Sequence[str], era: int = 0, touched: list[int] | None = None) -> None:
        self._change(table, [src], era, touched, lambda base, s: merge_insert(base, s, keys))

    def upsert(self, table: str, src: DataFrame, keys: Sequence[str], era: int = 0, touched: list[int] | None = None) -> None:
        self._change(table, [src], era, touched, lambda base, s: merge_upsert(base, s, keys))

    def insert_then_patch(self, table: str, inserts: DataFrame, patches: DataFrame, keys: Sequence[str],
                          cols: Sequence[str], era: int = 0, touched: list[int] | None = None, unset: str | None = None) -> None:
        """Insert-if-absent, then NULL-preserving update, with one join with the base. ``unset`` names a column of
        ``patches`` that lists the columns to make NULL."""
        self._change(table, [inserts, patches], era, touched, lambda base, i, p: merge_insert_patch(base, i, p, keys, [*cols, ERA], unset))

    def purge(self, tables: Sequence[str], since: int = 0) -> None:
        erased = self._load("_erased")
        if erased is None:
            return
        recent = erased.filter(F.col(ERA) > since).groupBy("tenant").agg(F.max(ERA).alias("erased_in"))
        if recent.isEmpty():
            return
        for table in tables:
            stored = self._load(table)
            tenant = self._layout(table).tenant
            if stored is None or tenant is None or tenant not in stored.columns:
                continue
            stored = stored.filter(F.col(BUCKET).isin(self._of_tenants(table, recent)))
            hidden = (stored.filter(F.col(ERA) > NO_ERA).select(tenant, ERA, BUCKET)
                      .join(recent, (F.col(tenant) == F.col("tenant")) & (F.col(ERA) < F.col("erased_in")), "left_semi"))
            buckets = sorted(r[0] for r in hidden.select(BUCKET).distinct().collect())     # at most as many as there are buckets
            if buckets:
                self._rewrite(table, self._visible(table, stored.filter(F.col(BUCKET).isin(buckets))).drop(BUCKET), buckets)


class DeltaStore(StateStore):
    """The same operations as Delta MERGE on ``<root>/<table>``.

    Keys compare NULL-safe (``<=>``), like the portable forms. Replays and erasures are settled by eras,
    as in the portable store, so no history is searched and no session setting is used; a merge that runs
    again changes nothing."""
    fmt = "delta"
    # Partitioning applied when a table is first created; MERGE conditions on these columns prune files.
    # Registrations use the 100-value bucket of their id.
    DEFAULT_PARTITIONS = {"registrations": ["bucket"], "user_registrations": ["organiser_id"], "prospects": ["organiser_Id"],
                          "contacts": ["organiser_Id"], "opportunities": ["organiser_Id"]}

    def __init__(self, spark: SparkSession, root: str, partition_by: dict[str, list[str]] | None = None):
        from delta.tables import DeltaTable  # noqa: F401  (fails fast when absent)
        super().__init__(spark, root)
        self.partition_by = dict(self.DEFAULT_PARTITIONS if partition_by is None else partition_by)

    def _create(self, table: str, df: DataFrame, mode: str) -> None:
        w = df.write.format("delta").mode(mode)
        if self.partition_by.get(table):
            w = w.partitionBy(*self.partition_by[table])
        w.save(self._path(table))

    def _dt(self, table: str):
        from delta.tables import DeltaTable
        p = self._path(table)
        return DeltaTable.forPath(self.spark, p) if DeltaTable.isDeltaTable(self.spark, p) else None

    @staticmethod
    def _on(keys: Sequence[str]) -> str:
        return " AND ".join(f"t.`{k}` <=> s.`{k}`" for k in keys)

    def _load(self, table: str) -> DataFrame | None:
        t = self._dt(table)
        return None if t is None else t.toDF()

    def touched(self, table: str, rows: DataFrame) -> list[int]:
        return []        # file pruning follows from the MERGE condition and from joins

    def _of_tenants(self, table: str, tenants: DataFrame) -> None:
        return None

    def put(self, table: str, df: DataFrame, era: int = 0) -> None:
        self._create(table, df.withColumn(ERA, F.lit(era).cast("bigint")), "overwrite")

    def _merge(self, table: str, src: DataFrame, keys: Sequence[str], era: int, build) -> None:
        src = src.withColumn(ERA, F.lit(era).cast("bigint"))
        self.purge([table])      # erased rows are not there for the merge either
        t = self._dt(table)
        if t is None:
            self._create(table, src, "append")
            return
        build(t.alias("t").merge(src.alias("s"), self._on(keys))).execute()

    def insert_if_absent(self, table: str, src: DataFrame, keys: Sequence[str], era: int = 0, touched: list[int] | None = None) -> None:
        self._merge(table, src, keys, era, lambda m: m.whenNotMatchedInsertAll())

    def upsert(self, table: str, src: DataFrame, keys: Sequence[str], era: int = 0, touched: list[int] | None = None) -> None:
        self._merge(table, src, keys, era, lambda m: m.whenMatchedUpdateAll().whenNotMatchedInsertAll())

    def insert_then_patch(self, table: str, inserts: DataFrame, patches: DataFrame, keys: Sequence[str],
                          cols: Sequence[str], era: int = 0, touched: list[int] | None = None, unset: str | None = None) -> None:
        self.insert_if_absent(table, inserts, keys, era)
        kept = "t.`{0}`" if unset is None else f"CASE WHEN coalesce(array_contains(s.`{unset}`, '{{0}}'), false) THEN NULL ELSE t.`{{0}}` END"
        upd = {c: f"coalesce(s.`{c}`, {kept.format(c)})" for c in [*cols, ERA]}
        self._merge(table, patches, keys, era, lambda m: m.whenMatchedUpdate(set=upd))

    def purge(self, tables: Sequence[str], since: int = 0) -> None:
        erased = self._load("_erased")
        if erased is None:
            return
        gone = erased.filter(F.col(ERA) > since).groupBy("tenant").agg(F.max(ERA).alias("erased_in"))
        for table in tables:
            t, tenant = self._dt(table), self._layout(table).tenant
            if t is not None and tenant is not None:
                t.alias("t").merge(gone.alias("s"), f"t.`{tenant}` = s.tenant AND t.`{ERA}` < s.erased_in").whenMatchedDelete().execute()


def read_dead_letters(store: StateStore) -> DataFrame | None:
    """What neither job could read, as far as its tenants were not erased."""
    found = [d for d in map(store.read, ("cdc_dead_letters", "crm_dead_letters")) if d is not None]
    return reduce(DataFrame.unionByName, found) if found else None


def open_store(spark: SparkSession, root: str, fmt: str, partition_by: dict | None = None) -> StateStore:
    """``delta`` or ``parquet``; there is no default, and a missing Delta package is an error."""
    if fmt == "delta":
        return DeltaStore(spark, root, partition_by)
    if fmt == "parquet":
        return ParquetStore(spark, root)
    raise ValueError(f"state_format must be delta or parquet, not {fmt!r}")
