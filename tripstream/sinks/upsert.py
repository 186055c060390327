"""SNK-5..8, STR-13: keyed upsert without a table format (merge on read).

Each micro-batch writes its (deduplicated) rows into its own partition
``upsert_batch=<batch_id>`` with dynamic partition overwrite, so replaying
batch N rewrites exactly partition N: the write is idempotent and costs
O(batch), not O(table). Readers take, per key, the row from the highest
batch ("when matched update all, when not matched insert all"). The
per-key pick is a grouped ``max_by``: it combines map-side, and keys are
trip ids, so no key holds more rows than there were batches.

That is all there is: no log, no snapshots. A table that must not keep every
version belongs in a table format; when the ``delta`` package and its session
extension are present the same interface runs a Delta MERGE.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tripstream.operators.dedup import dedup_first
from tripstream.session import children, path_exists

BATCH_COL = "upsert_batch"

try:  # optional table format
    from delta.tables import DeltaTable  # type: ignore

    HAVE_DELTA = True
except ImportError:  # pragma: no cover - not installed here
    DeltaTable = None
    HAVE_DELTA = False


class KeyedUpsertTable:
    def __init__(self, spark: SparkSession, path: str, keys: list[str], use_delta: bool = False):
        self.spark, self.path, self.keys = spark, path, list(keys)
        self.use_delta = use_delta and HAVE_DELTA

    def upsert(self, df: DataFrame, batch_id: int, order: list[str] | None = None) -> bool:
        """Upsert one batch; returns False for an empty batch, which writes no data file (SNK-8).

        The row count is observed inside the write job itself (no separate
        emptiness job, no cached copy of the batch): under dynamic partition
        overwrite an empty batch creates no partition.
        """
        src = dedup_first(df, self.keys, order or [c for c in df.columns if c not in self.keys][:1])
        if self.use_delta:  # pragma: no cover - needs delta
            src = src.persist()
            try:
                if src.isEmpty():
                    return False
                self._merge_delta(src)
                return True
            finally:
                src.unpersist()
        obs = Observation(f"upsert_{uuid.uuid4().hex}")
        (
            src.observe(obs, F.count(F.lit(1)).alias("rows"))
            .withColumn(BATCH_COL, F.lit(int(batch_id)).cast("long"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(BATCH_COL)
            .parquet(self.path)
        )
        return bool(obs.get["rows"])

    def _merge_delta(self, src: DataFrame) -> None:  # pragma: no cover - needs delta
        if DeltaTable.isDeltaTable(self.spark, self.path):
            cond = " AND ".join(f"t.`{k}` <=> s.`{k}`" for k in self.keys)
            (
                DeltaTable.forPath(self.spark, self.path).alias("t")
                .merge(src.alias("s"), cond)
                .whenMatchedUpdateAll()
                .whenNotMatchedInsertAll()
                .execute()
            )
        else:  # SNK-7: create on the first batch
            src.write.format("delta").mode("append").save(self.path)

    def versions(self, batch_id: int | None = None) -> DataFrame | None:
        """Every stored version with its batch id (of one batch, if given); None before the first write."""
        if not path_exists(self.spark, self.path):
            return None
        if batch_id is not None and not path_exists(self.spark, f"{self.path}/{BATCH_COL}={batch_id}"):
            return None
        if not any(f.isDirectory() for f in children(self.spark, self.path)):
            return None  # only empty batches so far
        v = self.spark.read.parquet(self.path)
        return v if batch_id is None else v.filter(F.col(BATCH_COL) == batch_id)

    def read(self) -> DataFrame | None:
        """Current table: the latest version of each key."""
        if self.use_delta:  # pragma: no cover
            return self.spark.read.format("delta").load(self.path)
        v = self.versions()
        if v is None:
            return None
        payload = [c for c in v.columns if c not in self.keys and c != BATCH_COL]
        latest = v.groupBy(*self.keys).agg(F.max_by(F.struct(*[F.col(c) for c in payload]), F.col(BATCH_COL)).alias("_row"))
        return latest.select(*self.keys, *[F.col(f"_row.{c}").alias(c) for c in payload])

