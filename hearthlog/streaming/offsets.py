"""Hand a job's position in its source over to another job.

Spark keeps offsets in the checkpoint, where only the same query finds them. Here they are
written where any job can read them, as the JSON that ``--starting-offsets`` takes.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

_ROW = "batch_id bigint, source int, offsets string, slot int"


class OffsetExport(StreamingQueryListener):
    """Writes the offsets at which each finished micro-batch of a query ended.

    A batch's offsets are written after it is done, so a job that starts from them may
    read the newest batch a second time, but never misses one. Two slots take turns: the
    one is whole while the other is overwritten.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._spark, self._path, self._id = spark, path, None

    def follow(self, query: StreamingQuery) -> StreamingQuery:
        """Export this query's offsets only."""
        self._id = str(query.id)
        return query

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        if self._id not in (None, str(progress.id)):
            return
        rows = [
            (progress.batchId, number, source.endOffset, progress.batchId % 2)
            for number, source in enumerate(progress.sources)
            if source.endOffset
        ]
        if rows:
            frame = self._spark.createDataFrame(rows, _ROW).coalesce(1)
            writer = frame.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            writer.partitionBy("slot").parquet(self._path)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def exported_offsets(spark: SparkSession, path: str, source: int = 0) -> str | None:
    """The newest offsets of a source, or None where nothing was exported."""
    try:
        rows = spark.read.schema(_ROW).parquet(path).where(F.col("source") == source)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    newest = rows.agg(F.max_by("offsets", "batch_id")).first()
    return newest[0]
