"""Monthly refresh triggered by newly landed submissions.

The published tables are monthly batch outputs.  In production the refresh is
started when a new submission extract lands, so this module watches the
submission-audit folder with Structured Streaming and, for every micro-batch
that brings new files, runs the whole monthly refresh (``plans.refresh``) and
publishes it.  Nothing is computed inside the stream itself: the micro-batch
is only the trigger, the work is the same batch plan.

Exactly-once: the stream's progress lives in a checkpoint under the session's
shared ``spark.checkpoint.dir``; a re-delivered batch re-runs the refresh and
``publish`` replaces whole months (or whole tables), so a replay leaves the
outputs unchanged.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from monthwise.plans.common import RunParams
from monthwise.plans.refresh import run_monthly
from monthwise.session import checkpoint_dir
from monthwise.sources.tables import SCHEMAS, Sources


def start_monthly_refresh(spark: SparkSession, submissions_path: str, sources: Callable[[], Sources],
                          out_dir: str, params: RunParams = RunParams(), checkpoint: str | None = None,
                          available_now: bool = True) -> StreamingQuery:
    """Start the trigger stream; ``sources()`` returns the tables to refresh from.

    With ``available_now`` the stream processes what has landed and stops
    (a scheduled run); otherwise it keeps watching.
    """
    location = checkpoint or f"{checkpoint_dir(spark)}/monthly-refresh"
    arrivals = spark.readStream.schema(SCHEMAS["IsLatest_SubmissionID"]).parquet(submissions_path)

    def on_batch(batch: DataFrame, epoch_id: int) -> None:
        if batch.isEmpty():
            return
        run_monthly(sources(), params, out_dir)

    writer = arrivals.writeStream.foreachBatch(on_batch).option("checkpointLocation", location)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 hour")
    return writer.start()
