"""Verification of scored rows against the snapshot that they name.

A prediction carries the version of its feature table and the digest of the
feature values that it was scored from.  Verification reads the named versions,
digests their rows again and reports the predictions that cannot be reproduced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.digest import feature_set_digest, row_digest
from quarry.operators.keyed import join_null_safe
from quarry.sources.snapshots import SnapshotTable
from quarry.spec import FeatureSpec

OK, NO_VERSION, FEATURE_SET, NO_ROW, CHANGED = "ok", "no_version", "feature_set", "no_row", "changed"


def verify_scored_rows(predictions: DataFrame, table: SnapshotTable, spec: FeatureSpec,
                       decimal_cols: dict | None = None) -> DataFrame:
    """``predictions`` with ``verdict``; the first that holds of

    ``no_version``: the version is NULL or was never published; ``feature_set``: the
    digest of the feature names differs; ``no_row``: the version has no row
    with the prediction's ids; ``changed``: it has, and none has the digest of
    the prediction; ``ok``.  NULL ids equal NULL ids.

    Each version that predictions name is read once, ids and features alone;
    ids and digests are joined, whatever the number of rows.
    """
    ids = list(spec.metadata)
    published = {str(r["version"]) for r in table.history().select("version").distinct().collect()}
    named = {r["v"] for r in predictions.select(F.col("feature_table_version").alias("v")).distinct().collect()}
    known = sorted(published & named, key=int)
    out = predictions.withColumn("_there", F.coalesce(F.col("feature_table_version").isin(known), F.lit(False)) if known else F.lit(False))
    out = out.withColumns({"_row": F.lit(False), "_same": F.lit(False)})
    if known:
        rows = None
        for v in known:
            at = table.read(int(v))
            part = at.select(F.lit(v).alias("feature_table_version"), *ids, row_digest(at, spec.features, decimal_cols).alias("feature_vector_digest"))
            rows = part if rows is None else rows.unionByName(part)
        keys = ["feature_table_version", *ids]
        rows = rows.distinct()
        out = join_null_safe(out.drop("_row", "_same"), rows.select(*keys).distinct().withColumn("_row", F.lit(True)), keys)
        out = join_null_safe(out, rows.withColumn("_same", F.lit(True)), [*keys, "feature_vector_digest"])
    verdict = (F.when(~F.col("_there"), NO_VERSION)
               .when(~F.col("feature_set_digest").eqNullSafe(F.lit(feature_set_digest(spec.features))), FEATURE_SET)
               .when(F.col("_row").isNull(), NO_ROW).when(F.col("_same").isNull(), CHANGED).otherwise(OK))
    return out.withColumn("verdict", verdict).select(*predictions.columns, "verdict")


def verification_summary(verified: DataFrame) -> DataFrame:
    """Predictions per model version, feature table version and verdict."""
    return verified.groupBy("model_version", "feature_table_version", "verdict").agg(F.count(F.lit(1)).alias("n_rows"))
