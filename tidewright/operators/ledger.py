"""What has been delivered, as a log: a base by ranges of keys, and a delta per batch.

Each batch adds the keys it delivered or withdrew, and per range how the number of live
keys and the sum of their content numbers change. A table to be published is summed by
range the same way, so ranges whose sums agree hold nothing to deliver and are not read;
for the others the base and the deltas of just these ranges are. Once the deltas hold a
share of the base's rows they are folded into the next base.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..session import cut_lineage, exists, make_folder, names_in

INT, LONG, TEXT, TIME, TOTAL = T.IntegerType(), T.LongType(), T.StringType(), T.TimestampType(), T.DecimalType(38, 0)


def _table(**kinds: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in kinds.items()])


ENTRY = _table(record_key=TEXT, digest=TEXT, delivered_ts=TIME, seq=LONG, batch_id=TEXT, range=INT)
SUMS = _table(range=INT, n=LONG, total=TOTAL, rows=LONG, seq=LONG, batch_id=TEXT)
BASE_SUMS = _table(range=INT, n=LONG, total=TOTAL, rows=LONG, v=INT)


PER_RANGE = 50_000


class Ledger:
    """The ledger below `path`. The number of ranges stays as it was when the ledger began:
    as given, or one for each PER_RANGE keys of the first table. Give it for tables that
    will grow much."""

    def __init__(self, spark: SparkSession, path: str, ranges: int | None = None, fold_share: float = 0.5):
        self.spark, self.path, self.fold_share = spark, path, fold_share
        kept = [int(n[2:]) for n in names_in(spark, f"{path}/ranges")]
        self.ranges = kept[0] if kept else ranges

    # places

    def _stored(self, name: str, schema: T.StructType) -> DataFrame:
        place = f"{self.path}/{name}"
        if not exists(self.spark, place):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(place)

    def _write(self, rows: DataFrame, place: str, by_range: bool = False) -> None:
        out = rows.hint("rebalance", "range") if by_range else rows.coalesce(1)
        writer = out.write.mode("overwrite").option("partitionOverwriteMode", "static")
        (writer.partitionBy("range") if by_range else writer).parquet(f"{self.path}/{place}")

    # what is known

    def _version(self) -> tuple[int, list[str]]:
        """The newest base and the batches folded into it: one text per batch ever published."""
        done = [int(n[2:]) for n in names_in(self.spark, f"{self.path}/head") if exists(self.spark, f"{self.path}/head/{n}/_SUCCESS")]
        if not done:
            return 0, []
        v = max(done)
        return v, [r[0] for r in self.spark.read.parquet(f"{self.path}/head/v={v}").collect()]

    def _log(self, but: str | None) -> tuple[int, list[str]]:
        """(base version, the deltas that count): those that are complete, not folded and not
        of the batch `but`."""
        v, folded = self._version()
        known = [n.removeprefix("batch_id=") for n in names_in(self.spark, f"{self.path}/sums")
                 if exists(self.spark, f"{self.path}/sums/{n}/_SUCCESS")]
        return v, [b for b in known if b not in {*folded, but}]

    def is_folded(self, batch_id: str) -> bool:
        return batch_id in self._version()[1]

    def range_of(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.ranges)).cast("int")

    @staticmethod
    def _number(key: Column, digest: Column) -> Column:
        text = F.concat_ws("|", F.length(key).cast("string"), key, digest)
        return F.when(digest.isNotNull(), F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("decimal(38,0)"))

    def sums(self, but: str | None = None) -> DataFrame:
        """(range, n, total) of what is live."""
        v, batches = self._log(but)
        base = self._stored("base_sums", BASE_SUMS).filter(F.col("v") == v)
        log = self._stored("sums", SUMS).filter(F.col("batch_id").isin(batches))
        return (base.select("range", "n", "total").unionByName(log.select("range", "n", "total"))
                .groupBy("range").agg(F.sum("n").alias("n"), F.sum("total").cast("decimal(38,0)").alias("total")))

    def entries(self, ranges: Sequence[int] | None = None, but: str | None = None) -> DataFrame:
        """The rows that tell what is live, of some ranges or all: the base's and the deltas'."""
        v, batches = self._log(but)
        base = self._stored("base", T.StructType([*ENTRY.fields, T.StructField("v", INT)])).filter(F.col("v") == v).drop("v")
        rows = base.unionByName(self._stored("delta", ENTRY).filter(F.col("batch_id").isin(batches)))
        return rows if ranges is None else rows.filter(F.col("range").isin(list(ranges)))

    def live(self, ranges: Sequence[int] | None = None, but: str | None = None) -> DataFrame:
        """(record_key, range, digest) of what has been delivered and not withdrawn."""
        newest = self.entries(ranges, but).groupBy("record_key", "range").agg(F.max_by("digest", "seq").alias("digest"))
        return newest.filter(F.col("digest").isNotNull())

    # what is new

    def touched(self, rows: DataFrame, but: str | None = None) -> list[int]:
        """The ranges in which `rows` (record_key, digest) differ from what is live; at most
        as many numbers as there are ranges."""
        here = (rows.groupBy(self.range_of(F.col("record_key")).alias("range"))
                .agg(F.count(F.lit(1)).alias("n2"), F.sum(self._number(F.col("record_key"), F.col("digest"))).cast("decimal(38,0)").alias("total2")))
        both = self.sums(but).filter("n <> 0 OR total <> 0").join(here, "range", "full_outer")
        return [r[0] for r in both.filter(~(F.col("n").eqNullSafe(F.col("n2")) & F.col("total").eqNullSafe(F.col("total2"))))
                .select("range").collect()]

    def changes(self, rows: DataFrame, batch_id: str) -> DataFrame:
        """(record_key, range, old, new) where `rows` (record_key, digest; keys are unique and
        not null) differ from what other batches have delivered; new is null for keys that
        are gone. Computed once and stored."""
        if self.ranges is None:
            self.ranges = 1 + rows.count() // PER_RANGE
        ranges = self.touched(rows, batch_id)
        new = rows.select("record_key", self.range_of(F.col("record_key")).alias("range"), F.col("digest").alias("new"))
        old = self.live(ranges, batch_id).withColumnRenamed("digest", "old")
        both = new.filter(F.col("range").isin(ranges)).join(old, ["record_key", "range"], "full_outer")
        return cut_lineage(both.filter(~F.col("old").eqNullSafe(F.col("new"))))

    # keeping it

    def record(self, changed: DataFrame, batch_id: str) -> None:
        """Enters a batch: rows of `changes` that have been delivered or withdrawn. The sums
        come last and make the entry count; entering a batch again replaces it."""
        make_folder(self.spark, f"{self.path}/ranges/n={self.ranges}")
        top = self._stored("sums", SUMS).agg(F.max("seq")).first()[0] or 0
        place = f"batch_id={batch_id}"
        self._write(changed.select("record_key", F.col("new").alias("digest"), F.current_timestamp().alias("delivered_ts"),
                                   F.lit(top + 1).cast("bigint").alias("seq"), "range"), f"delta/{place}", by_range=True)
        key = F.col("record_key")
        gain = lambda c: F.coalesce(self._number(key, F.col(c)), F.lit(0).cast("decimal(38,0)"))
        sums = changed.groupBy("range").agg(
            F.sum(F.col("new").isNotNull().cast("bigint") - F.col("old").isNotNull().cast("bigint")).alias("n"),
            F.sum(gain("new") - gain("old")).cast("decimal(38,0)").alias("total"), F.count(F.lit(1)).alias("rows"))
        self._write(sums.withColumn("seq", F.lit(top + 1).cast("bigint")), f"sums/{place}")
        self._fold(batch_id)

    def _fold(self, newest: str) -> None:
        """Makes the next base if the deltas have grown to a share of the present one. The
        newest batch stays a delta, so that it can be entered again. The head is written
        last: until then the old base and its deltas count."""
        v, batches = self._log(newest)
        if not batches:
            return
        waiting = self._stored("sums", SUMS).filter(F.col("batch_id").isin(batches)).agg(F.sum("rows")).first()[0] or 0
        base = self._stored("base_sums", BASE_SUMS).filter(F.col("v") == v).agg(F.sum("n")).first()[0] or 0
        if waiting < self.fold_share * base:
            return
        last = self.entries(but=newest).groupBy("record_key", "range").agg(
            F.max_by(F.struct("digest", "delivered_ts", "seq", "batch_id"), "seq").alias("r"))
        live = last.filter("r.digest IS NOT NULL").select("record_key", "r.*", "range")
        sums = self.sums(newest).filter("n <> 0").withColumn("rows", F.lit(0).cast("bigint"))
        folded = self.spark.createDataFrame([(b,) for b in [*self._version()[1], *batches]], "batch_id string")
        self._write(live, f"base/v={v + 1}", by_range=True)
        self._write(sums, f"base_sums/v={v + 1}")
        self._write(folded, f"head/v={v + 1}")
