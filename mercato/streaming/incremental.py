"""Incremental refresh of the monthly revenue mart with Structured Streaming.

Orders, payments, reviews and customers land as files, in any order, one
streaming query each.  The mart is maintained by differences: its state has one
row for each order seen so far (month, customer, paid, payments, reviews), in
hash buckets of ``order_id``, and a batch costs what its own rows touch:

1. The batch is reduced to one delta row per order.  Orders look up their customers,
   and customers the orders that wait for them, in an index in buckets of
   ``customer_id``; only the buckets of the batch's keys are read.
2. The deltas are merged into the touched order buckets, which are written as a
   new version.  A written row also has what its order counted for before.
3. The months get the difference between what the orders of the written buckets count for
   now and before (nothing for an order without a delta); other months keep their sums.  New (month, state)
   pairs of persons are added to distinct sketches, which merge over any period.
4. A manifest of the current version of every bucket, and of the last epoch of every
   stream, commits the batch.  An epoch that is retried after its commit is left
   out; one that failed before is written again under the same version.  Versions
   that the manifest no longer names are deleted after it.

Landed rows are never read again.  An order counts, as in the batch mart, when
its own row, its customer and a payment have landed, with each payment once per
review.  ``order_id`` is the key of orders and ``customer_id`` of customers: a
second row of an order replaces its month and customer (the later purchase
wins within a batch); a second row of a customer is left out.  Rows without
their key are left out, as inner joins do; a payment without a value counts as 0.
Sketches only grow: an order that changes its month leaves its person in the earlier one.

``trigger(availableNow=True)`` processes what has landed and stops, the
batch-friendly way to run "refresh when new data lands".
"""

from __future__ import annotations

import threading
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from mercato.functions.timefx import month_text
from mercato.session import ensure_checkpoint_dir
from mercato.sources.readers import load_parquet_tables
from mercato.sources.roles import RAW_TABLES, role_tables

STREAMED = ("customers", "orders", "payments", "reviews")
SALTS = 16  # files that one customer's waiting orders are dealt over


@dataclass
class Manifest:
    """The committed version: which version of each bucket is current, and each stream's last epoch."""

    version: int = -1
    buckets: dict[str, dict[int, int]] = field(default_factory=lambda: {"orders": {}, "customers": {}})
    epochs: dict[str, int] = field(default_factory=dict)


class RevenueRefresh:
    """State and mart under ``root``; ``start`` one query per streamed table.

    ``buckets`` is fixed for a root: about as many as keep a bucket's orders in one task.
    """

    def __init__(self, spark: SparkSession, root: str, schemas: dict, buckets: int | None = None):
        self.spark, self.root = spark, root.rstrip("/")
        self.n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.lock = threading.Lock()  # one refresh at a time when the queries run side by side
        order_id, customer_id = schemas["orders"]["order_id"].dataType, schemas["orders"]["customer_id"].dataType
        person, state = (schemas["customers"][c].dataType for c in ("customer_unique_id", "customer_state"))
        customer = [T.StructField("person", person), T.StructField("state", state)]
        self.schemas = {
            "orders": T.StructType(
                [T.StructField("order_id", order_id), T.StructField("customer_id", customer_id), T.StructField("order_month", T.StringType())]
                + [T.StructField("known", T.BooleanType()), *customer, T.StructField("paid", T.DecimalType(28, 2))]
                + [T.StructField(c, T.LongType()) for c in ("payments", "reviews")]
                + [T.StructField("was_month", T.StringType()), T.StructField("was_revenue", T.DecimalType(28, 2))]
            ),
            # A row without an order is a customer that has landed; one with an order waits for it.
            "customers": T.StructType([T.StructField("customer_id", customer_id), T.StructField("order_id", order_id), *customer]),
            "months": T.StructType(
                [T.StructField("order_month", T.StringType()), T.StructField("revenue", T.DecimalType(38, 2)), T.StructField("orders", T.LongType())]
            ),
            "persons": T.StructType(
                [T.StructField("order_month", T.StringType()), T.StructField("state", state), T.StructField("persons", T.BinaryType())]
            ),
        }
        self.manifest = self._committed()

    # --- results ---

    def mart(self) -> DataFrame:
        """``order_month, revenue`` of the last committed batch."""
        months = self._read("months", self.manifest).where("orders > 0")
        return months.select("order_month", F.round(F.col("revenue").cast("double"), 2).alias("revenue"))

    def persons_by_state(self, first_month: str | None = None, last_month: str | None = None) -> DataFrame:
        """``customer_state, persons``: distinct persons (estimated) with sales in a period, from the stored sketches alone."""
        s = self._read("persons", self.manifest)
        if first_month is not None:
            s = s.where(F.col("order_month") >= first_month)
        if last_month is not None:
            s = s.where(F.col("order_month") <= last_month)
        return s.groupBy(F.col("state").alias("customer_state")).agg(F.hll_sketch_estimate(F.hll_union_agg("persons")).alias("persons"))

    # --- stored versions ---

    def _fs(self, path: str):
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def _committed(self) -> Manifest:
        """The latest manifest that was written whole (one row for each bucket and stream)."""
        fs, p = self._fs(f"{self.root}/manifest")
        found = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
        for v in sorted((int(x[2:]) for x in found if x.startswith("v=")), reverse=True):
            if fs.exists(self._fs(f"{self.root}/manifest/v={v}/_SUCCESS")[1]):
                out = Manifest(v)
                for kind, key, value in self.spark.read.schema("kind string, key string, value long").parquet(f"{self.root}/manifest/v={v}").collect():
                    if kind == "epoch":
                        out.epochs[key] = value
                    else:
                        out.buckets[kind][int(key)] = value
                return out
        return Manifest()

    def _commit(self, m: Manifest) -> None:
        rows = [("epoch", k, v) for k, v in m.epochs.items()] + [(t, str(b), v) for t, of in m.buckets.items() for b, v in of.items()]
        self.spark.createDataFrame(rows, "kind string, key string, value long").coalesce(1).write.mode("overwrite").parquet(
            f"{self.root}/manifest/v={m.version}"
        )
        old, self.manifest = self.manifest, m
        gone = [f"{t}/v={v}/bucket={b}" for t, of in old.buckets.items() for b, v in of.items() if m.buckets[t].get(b) != v]
        # A reader may still hold the version before this one; the one before that goes.
        gone += [f"{t}/v={old.version - 1}" for t in ("months", "persons", "manifest")] + [f"deltas/v={m.version}"]
        for path in gone:
            fs, p = self._fs(f"{self.root}/{path}")
            fs.delete(p, True)

    def _read(self, table: str, m: Manifest, buckets: list[int] | None = None) -> DataFrame:
        """The current rows of a table, of the given buckets alone."""
        if buckets is None:
            paths = [f"{self.root}/{table}/v={m.version}"] if m.version >= 0 else []
        else:
            paths = [f"{self.root}/{table}/v={m.buckets[table][b]}/bucket={b}" for b in buckets if b in m.buckets[table]]
        return self.spark.read.schema(self.schemas[table]).parquet(*paths) if paths else self.spark.createDataFrame([], self.schemas[table])

    def bucket(self, key: str) -> Column:
        return F.pmod(F.hash(key), F.lit(self.n))

    def _buckets_of(self, rows: DataFrame, key: str) -> list[int]:
        """The buckets of the rows' keys: ``n`` numbers at most."""
        return sorted(r[0] for r in rows.select(self.bucket(key)).distinct().collect())

    def _write(self, table: str, rows: DataFrame, key: str, buckets: list[int], m: Manifest) -> None:
        rows = rows.select(*self.schemas[table].names, self.bucket(key).alias("bucket"))
        salt = F.pmod(F.hash("order_id"), F.lit(SALTS)) if table == "customers" else F.lit(0)
        path = f"{self.root}/{table}/v={m.version}"
        rows.repartition("bucket", salt).write.mode("overwrite").partitionBy("bucket").parquet(path)
        fs, _ = self._fs(path)
        for b in buckets:
            m.buckets[table].pop(b, None)
            if fs.exists(self._fs(f"{path}/bucket={b}")[1]):  # a bucket may have lost its last row
                m.buckets[table][b] = m.version

    # --- one batch ---

    def _deltas(self, name: str, batch: DataFrame, m: Manifest) -> DataFrame:
        """One row for each order that the batch touches, with what it adds; updates the customer index."""
        empty = {f.name: F.lit(None).cast(f.dataType).alias(f.name) for f in self.schemas["orders"].fields}
        if name in ("payments", "reviews"):
            rows = batch.where(F.col("order_id").isNotNull()).groupBy("order_id")
            if name == "payments":
                sums = {"paid": F.sum("payment_value").cast("decimal(28,2)"), "payments": F.count(F.lit(1))}
            else:
                sums = {"reviews": F.count(F.lit(1))}
            out = rows.agg(*(c.alias(k) for k, c in sums.items()))
            return out.select(*(F.col(k) if k in out.columns else c for k, c in empty.items()))
        if name == "orders":
            month = month_text("order_purchase_timestamp").alias("order_month")
            latest = F.max(F.struct("order_purchase_timestamp", "customer_id")).alias("o")
            new = batch.where(F.col("order_id").isNotNull()).groupBy("order_id").agg(latest).select("order_id", "o.*")
            new = new.select("order_id", "customer_id", month)
            buckets = self._buckets_of(new.where(F.col("customer_id").isNotNull()), "customer_id")
            index = self._read("customers", m, buckets)
            landed = index.where(F.col("order_id").isNull()).select("customer_id", F.lit(True).alias("known"), "person", "state")
            out = new.join(landed, "customer_id", "left")
            out = self._stored(out.select(*(F.col(k) if k in out.columns else c for k, c in empty.items())), m)
            waiting = out.where(F.col("known").isNull() & F.col("customer_id").isNotNull()).select("customer_id", "order_id", "person", "state")
            self._write("customers", index.unionByName(waiting).distinct(), "customer_id", buckets, m)
            return out
        new = batch.where(F.col("customer_id").isNotNull()).groupBy("customer_id").agg(F.min(F.struct("customer_unique_id", "customer_state")).alias("c"))
        new = new.select("customer_id", F.col("c.customer_unique_id").alias("person"), F.col("c.customer_state").alias("state"))
        buckets = self._buckets_of(new, "customer_id")
        index = self._read("customers", m, buckets)
        new = new.join(index.where(F.col("order_id").isNull()), "customer_id", "left_anti")
        waiting = index.where(F.col("order_id").isNotNull())
        out = waiting.select("customer_id", "order_id").join(new, "customer_id").withColumn("known", F.lit(True))
        out = self._stored(out.select(*(F.col(k) if k in out.columns else c for k, c in empty.items())), m)
        landed = index.where(F.col("order_id").isNull())
        marks = new.withColumn("order_id", F.lit(None).cast(self.schemas["customers"]["order_id"].dataType))
        left = waiting.join(new, "customer_id", "left_anti")
        self._write("customers", landed.unionByName(left).unionByName(marks), "customer_id", buckets, m)
        return out

    def _stored(self, deltas: DataFrame, m: Manifest) -> DataFrame:
        path = f"{self.root}/deltas/v={m.version}"
        deltas.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(self.schemas["orders"]).parquet(path)

    def merge(self, deltas: DataFrame, old: DataFrame) -> DataFrame:
        """New rows of the touched buckets; ``was_*`` is what an order counted for before."""
        o, d = F.col("o"), F.col("d")
        joined = old.select("order_id", F.struct(*old.columns).alias("o")).join(
            deltas.select("order_id", F.struct(*deltas.columns).alias("d")), "order_id", "full_outer"
        )
        moved = d["order_month"].isNotNull()  # the order's own row has come (again)
        customer = F.when(moved, d["customer_id"]).otherwise(o["customer_id"])
        # Its customer is known by the order's delta, by a customer's delta for that customer, or from before.
        told = F.when(d["known"] & d["customer_id"].eqNullSafe(customer), d).when(~F.coalesce(moved, F.lit(False)) | o["customer_id"].eqNullSafe(customer), o)
        add = lambda c: F.coalesce(o[c], F.lit(0)) + F.coalesce(d[c], F.lit(0))
        return joined.select(
            "order_id",
            customer.alias("customer_id"),
            F.coalesce(d["order_month"], o["order_month"]).alias("order_month"),
            F.coalesce(told["known"], F.lit(False)).alias("known"),
            told["person"].alias("person"),
            told["state"].alias("state"),
            add("paid").cast("decimal(28,2)").alias("paid"),
            add("payments").alias("payments"),
            add("reviews").alias("reviews"),
            F.when(counts(o), o["order_month"]).alias("was_month"),
            F.when(counts(o), revenue_of(o)).alias("was_revenue"),
        )

    def apply(self, name: str, batch: DataFrame, epoch: int) -> None:
        """Merge one micro-batch; an epoch that has been committed is left out."""
        with self.lock:
            if epoch <= self.manifest.epochs.get(name, -1):
                return
            old = self.manifest
            m = Manifest(old.version + 1, {t: dict(of) for t, of in old.buckets.items()}, old.epochs | {name: epoch})
            deltas = self._deltas(name, batch, m)
            if name in ("payments", "reviews"):
                deltas = self._stored(deltas, m)
            buckets = self._buckets_of(deltas, "order_id")
            self._write("orders", self.merge(deltas, self._read("orders", old, buckets)), "order_id", buckets, m)
            # A row that no delta met counts for what it did before, so it adds nothing and needs no join to be left out.
            self._refresh_months(self._read("orders", m, buckets), old, m)
            self._commit(m)

    def _refresh_months(self, written: DataFrame, old: Manifest, m: Manifest) -> None:
        row = F.struct(*self.schemas["orders"].names)
        now = written.where(counts(row)).select("order_month", revenue_of(row).cast("decimal(38,2)").alias("revenue"), F.lit(1).cast("long").alias("orders"))
        was = written.where(F.col("was_month").isNotNull()).select(
            F.col("was_month").alias("order_month"), (-F.col("was_revenue")).cast("decimal(38,2)").alias("revenue"), F.lit(-1).cast("long").alias("orders")
        )
        months = self._read("months", old).unionByName(now).unionByName(was).groupBy("order_month")
        months = months.agg(F.sum("revenue").cast("decimal(38,2)").alias("revenue"), F.sum("orders").alias("orders"))
        months.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/months/v={m.version}")  # one row a month
        new = written.where(counts(row) & ~F.col("was_month").eqNullSafe(F.col("order_month")) & F.col("person").isNotNull())
        sketches = new.groupBy("order_month", "state").agg(F.hll_sketch_agg(F.col("person").cast("string")).alias("persons"))
        persons = self._read("persons", old).unionByName(sketches).groupBy("order_month", "state").agg(F.hll_union_agg("persons").alias("persons"))
        persons.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/persons/v={m.version}")  # one row a month and state

    # --- streams ---

    def start(self, name: str, stream: DataFrame, available_now: bool = True) -> StreamingQuery:
        writer = stream.writeStream.option("checkpointLocation", f"{self.root}/checkpoints/{name}")
        writer = writer.foreachBatch(lambda batch, epoch: self.apply(name, batch, epoch))
        writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
        return writer.start()

    def run_available(self, streams: dict[str, DataFrame]) -> None:
        """Process everything that has landed, table by table."""
        for name, stream in streams.items():
            q = self.start(name, stream)
            q.awaitTermination()
            if q.exception() is not None:
                raise RuntimeError(f"refresh of {name} failed: {q.exception()}")


def counts(order: Column) -> Column:
    """Whether an order's row, customer and a payment have all landed."""
    return F.coalesce(order["known"] & order["order_month"].isNotNull() & (order["payments"] > 0), F.lit(False))


def revenue_of(order: Column) -> Column:
    """Each payment once per review, once without reviews."""
    return (order["paid"] * F.greatest(order["reviews"], F.lit(1)).cast("decimal(10,0)")).cast("decimal(28,2)")


def refreshed(spark: SparkSession, sf_dir: str) -> RevenueRefresh:
    """Run the refresh over the test tables' files, payments first, to completion."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    raw = load_parquet_tables(spark, sf_dir, RAW_TABLES)
    schemas = {n: df.schema for n, df in role_tables(raw).items()}
    # The file source streams folders; a glob selects the single test file.  Dimensions of customers stay static.
    streams = dict(raw)
    for t in ("orders", "lineitem", "customer"):
        streams[t] = spark.readStream.schema(raw[t].schema).parquet(f"{sf_dir}/{t}.parque[t]")
    tables = role_tables(streams)
    refresh = RevenueRefresh(spark, f"{base}/mercato-stream-{uuid.uuid4().hex}", schemas)
    refresh.run_available({n: tables[n] for n in ("payments", "reviews", "customers", "orders")})
    return refresh


def state_persons_check(spark: SparkSession, sf_dir: str, bound: float = 0.05) -> DataFrame:
    """``customer_state, persons, within_bound``: exact distinct persons beside whether the stored sketches'
    estimate (standard error 1.6 %) is off by no more than ``bound``, or by one person."""
    refresh = refreshed(spark, sf_dir)
    orders = refresh._read("orders", refresh.manifest, sorted(refresh.manifest.buckets["orders"]))
    sold = orders.where(counts(F.struct(*refresh.schemas["orders"].names)) & F.col("state").isNotNull())
    exact = sold.groupBy(F.col("state").alias("customer_state")).agg(F.countDistinct("person").alias("persons"))
    estimate = refresh.persons_by_state().withColumnRenamed("persons", "_estimate")
    off = F.abs(F.col("_estimate") - F.col("persons"))
    return exact.join(estimate, "customer_state", "left").select(
        "customer_state", "persons", F.coalesce(off <= F.greatest(F.lit(1.0), F.col("persons") * bound), F.lit(False)).alias("within_bound")
    )


def monthly_revenue_stream_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    return refreshed(spark, sf_dir).mart()
