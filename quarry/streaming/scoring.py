"""Score newly arrived feature files once each (foreachBatch + availableNow)."""

from __future__ import annotations

import threading
from typing import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quarry.operators.scoring import Provenance, score_rows
from quarry.session import checkpoint_dir
from quarry.spec import FeatureSpec


def score_new_files(spark: SparkSession, source_dir: str, schema: StructType, spec: FeatureSpec,
                    scorer: Callable[[DataFrame], DataFrame], prov: Provenance, output_path: str,
                    name: str = "scoring", threshold: float = 0.5, max_files_per_trigger: int | None = None) -> dict:
    """Process every Parquet file in ``source_dir`` not seen by earlier runs.

    Rows with a label are skipped (only unlabelled rows are scored, as in
    the batch job).  Returns the number of rows written by this run.
    """
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    stream = reader.parquet(source_dir)
    written = {"rows": 0}
    started, query = threading.Event(), {}

    def sink(batch: DataFrame, epoch_id: int) -> None:
        started.wait()
        rows = batch.where(F.col(spec.target).isNull()).select(*spec.scoring_columns)
        seen = Observation()
        preds = score_rows(rows, spec, scorer, prov, threshold).observe(seen, F.count(F.lit(1)).alias("n"))
        # idempotent per epoch: a retried epoch overwrites its own folder; the
        # id lives with the progress, so other progress never shares a folder
        preds.write.mode("overwrite").parquet(f"{output_path}/stream={query['id']}/epoch={epoch_id}")
        written["rows"] += seen.get["n"]

    ckpt = f"{checkpoint_dir(spark)}/streams/{name}"
    q = (stream.writeStream.foreachBatch(sink).option("checkpointLocation", ckpt)
               .trigger(availableNow=True).start())
    query["id"] = q.id
    started.set()
    q.awaitTermination()
    return {"rows_written": written["rows"], "checkpoint": ckpt}
