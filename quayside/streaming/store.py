"""Tables a stream fills one micro-batch at a time, so that a restart neither loses nor repeats a row.

Every micro-batch writes folders of its own, `<root>/<table>/batch=<id>`, and commits them with one
row of a ledger, written last. A batch that failed halfway is replayed under the same id and
overwrites only itself; one that was committed but not yet noted by the stream is skipped. Readers see
committed batches only. The stream's checkpoint lies in the same root: ids and tables are lost or kept together.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

LEDGER = "ledger"
#: An empty batch that makes a table readable before the first one is landed.
NONE = -1


class BatchTables:
    """`schemas`: columns of each table as DDL; `facts`: further columns of the ledger."""

    def __init__(self, spark: SparkSession, root: str, schemas: dict[str, str], facts: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.schemas = {**schemas, LEDGER: facts}
        for name, schema in self.schemas.items():
            spark.createDataFrame([], schema).write.mode("ignore").parquet(self._path(name, NONE))

    def _path(self, name: str, batch: int) -> str:
        return f"{self.root}/{name}/batch={batch}"

    def write(self, name: str, df: DataFrame, batch: int) -> DataFrame:
        """Write one batch of a table and return it as written."""
        df.write.mode("overwrite").parquet(self._path(name, batch))
        return self.spark.read.schema(self.schemas[name]).parquet(self._path(name, batch))

    def _all(self, name: str) -> DataFrame:
        return self.spark.read.schema(f"{self.schemas[name]}, batch long").parquet(f"{self.root}/{name}")

    def ledger(self) -> DataFrame:
        """One row per committed batch."""
        return self._all(LEDGER).where(F.col("batch") > NONE)

    def read(self, name: str) -> DataFrame:
        """The committed rows of a table, with their batch. Only the newest batch can lack its commit."""
        newest = self.ledger().agg(F.max("batch").alias("newest"))
        return self._all(name).where(F.col("batch") <= newest.scalar())

    def land(self, stream: DataFrame, put: Callable[[DataFrame, int], DataFrame]) -> StreamingQuery:
        """Take everything available and stop; the next call resumes. `put` writes a batch and returns its ledger row."""

        def one(rows: DataFrame, batch: int) -> None:
            done = self.ledger().agg(F.max("batch")).first()[0]
            if done is not None and batch <= done:
                return
            self.write(LEDGER, put(rows, batch).coalesce(1), batch)

        return (
            stream.writeStream.foreachBatch(one)
            .option("checkpointLocation", f"{self.root}/checkpoint")
            .trigger(availableNow=True)
            .start()
        )
