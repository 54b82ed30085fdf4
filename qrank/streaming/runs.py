"""Evaluate run files incrementally as they arrive in a folder.

A parameter sweep writes one run file per configuration; instead of
re-evaluating the whole folder, a file-source stream picks up new files
(each file is read whole inside one micro-batch) and every micro-batch is
evaluated with the batch evaluator.  Output is written per micro-batch id
with overwrite, so a retried batch replaces its own output (idempotent).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.judge import EvalOptions
from ..operators.measures import evaluate
from ..sources.runfiles import run_rows, split_lines


def evaluate_run_stream(spark: SparkSession, run_dir: str, qrels: DataFrame, out_path: str,
                        checkpoint: str, measures="official", opts: EvalOptions = EvalOptions(),
                        files_per_batch: int = 64, available_now: bool = True) -> StreamingQuery:
    """Start a stream evaluating every new run file under ``run_dir``.

    Each file is one run (run_id = file path).  ``checkpoint`` must be a
    folder shared by the cluster; the judgments are a static table.
    """
    lines = (spark.readStream.format("text").option("maxFilesPerTrigger", files_per_batch)
                  .load(run_dir))
    parsed = split_lines(lines).where(F.col("_n") > 0)
    runs = run_rows(parsed, run_id_from_file=True)

    def batch(df: DataFrame, epoch_id: int) -> None:
        if df.isEmpty():
            return
        ev = evaluate(df, qrels, measures, opts)
        ev.write.mode("overwrite").parquet(f"{out_path.rstrip('/')}/batch={epoch_id}")

    w = runs.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()
