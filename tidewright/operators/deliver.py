"""Delivery bookkeeping: what is in a batch, and what still has to go out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.skew import fits_broadcast
from ..sources.sinks import deliver, read_deliveries
from .ingest import checksum, row_number

__all__ = ["deliver", "read_deliveries", "manifest", "undelivered", "record_delivery"]


def manifest(df: DataFrame, by: Sequence[str], batch_id: str) -> DataFrame:
    """Rows and an order-free checksum per part of a batch. Sums are combined
    map-side; a part holding most rows is not gathered."""
    part = F.concat_ws("/", *[F.concat(F.lit(f"{c}="), F.coalesce(F.col(c).cast("string"), F.lit("")))
                              for c in by]) if by else F.lit("all")
    return (df.groupBy(part.alias("part"))
              .agg(F.count(F.lit(1)).alias("n_rows"), checksum(F.sum(row_number(df))).alias("checksum"))
              .select(F.lit(str(batch_id)).alias("batch_id"), "part", "n_rows", "checksum",
                      F.current_timestamp().alias("created_ts")))


def undelivered(df: DataFrame, ledger: DataFrame, key: str, record_key: str = "record_key",
                digest: str | None = None) -> DataFrame:
    """Rows whose key the ledger does not hold. With `digest`, a column both sides have,
    also rows whose digest is not the one that was delivered last for their key."""
    same = F.col(key).cast("string") == F.col("__done")
    if digest is None:
        done = ledger.select(F.col(record_key).alias("__done"))
    else:
        latest = F.max_by(digest, F.struct("delivered_ts", "batch_id")).alias("__digest")
        done = ledger.groupBy(F.col(record_key).alias("__done")).agg(latest)
        same = same & (F.col(digest) == F.col("__digest"))
    done = F.broadcast(done) if fits_broadcast(done) else done
    return df.join(done, same, "left_anti")


def record_delivery(df: DataFrame, ledger_path: str, key: str, batch_id: str | int,
                    digest: str | None = None) -> None:
    """Enters a batch in the ledger; last step of a delivery, repeatable."""
    told = [F.col(digest).alias("digest")] if digest else []
    deliver(df.select(F.col(key).cast("string").alias("record_key"),
                      F.current_timestamp().alias("delivered_ts"), *told), ledger_path, batch_id)
