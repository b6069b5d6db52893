"""Settings that operators edit while a stream runs: read again by each micro-batch."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


class Settings:
    """A small JSON object in a file that all can reach, over defaults.

    current() reads it anew. Keys that the file lacks have their defaults, keys without a default are kept as well. While
    the file is missing, broken or no object, the last good settings hold, at first the defaults.
    """

    def __init__(self, path: str, defaults: dict[str, object]):
        self.path, self.defaults, self._last = path, dict(defaults), dict(defaults)

    def current(self, spark: SparkSession) -> dict[str, object]:
        try:
            text = "\n".join(r[0] for r in spark.read.text(self.path, wholetext=True).collect())
            found = json.loads(text)
        except (AnalysisException, ValueError):
            return dict(self._last)
        if isinstance(found, dict):
            self._last = self.defaults | found
        return dict(self._last)


def run_controlled(rows: DataFrame, settings: Settings, apply: Callable[[DataFrame, dict[str, object]], DataFrame], target: str, checkpoint: str) -> StreamingQuery:
    """What has arrived, each micro-batch through apply(batch, settings) with the settings of its own start.

    A batch is written to a folder of its number, which a repeated batch replaces: after a restart every row is there
    once, by the settings of the last attempt. Read target as one table; the number is its column batch.
    """

    def write(batch: DataFrame, number: int) -> None:
        now = settings.current(batch.sparkSession)
        apply(batch, now).write.mode("overwrite").parquet(f"{target}/batch={number}")

    query = rows.writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint).foreachBatch(write).start()
    query.awaitTermination()
    return query
