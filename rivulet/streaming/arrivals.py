"""A table that arrives in pieces: put into a folder slice by slice, in arrival order, while a stream reads it."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import DataStreamWriter

from rivulet.session import scratch_path
from rivulet.streaming.run import run_available


class Arrivals:
    """The rows in ``slices`` parts of ascending ``seq``, of about the same size.

    Each slice is one micro-batch, whatever number of files it has, so what a stream makes of
    late rows and of state from earlier micro-batches can be told from the table alone.
    """

    def __init__(self, rows: DataFrame, seq: str, slices: int = 4):
        self.rows, self.seq = rows, seq
        self.spark = rows.sparkSession
        self.path = scratch_path(self.spark, "arrivals")
        rows.limit(0).write.parquet(self.path)
        cuts = [i / slices for i in range(1, slices)]
        self.bounds = sorted(set(rows.approxQuantile(seq, cuts, 0.001)))

    def stream(self) -> DataFrame:
        return self.spark.readStream.schema(self.rows.schema).parquet(self.path)

    def _slices(self):
        seq = F.col(self.seq)
        for low, high in zip([None, *self.bounds], [*self.bounds, None]):
            rows = self.rows if low is None else self.rows.where(seq >= low)
            yield rows if high is None else rows.where(seq < high)

    def run(self, writer: DataStreamWriter, checkpoint: str) -> None:
        """Let the slices arrive one after the other; the stream goes on from its checkpoint each time."""
        for rows in self._slices():
            rows.write.mode("append").parquet(self.path)
            run_available(writer, checkpoint)
