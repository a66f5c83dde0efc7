"""End-to-end: publish a feature table, train twice, batch score, stream score."""

import os
import uuid

from pyspark.sql import functions as F

from quarry.operators.scoring import Provenance
from quarry.plans import queries as Q
from quarry.plans.batch_scoring import ScoreConfig, score
from quarry.plans.training import TrainConfig, train
from quarry.sources.snapshots import SnapshotTable
from quarry.streaming import score_new_files

from conftest import SF_MID

PARAMS = {"n_estimators": 4, "max_depth": 3}


def test_train_promote_score(spark, tmp_dir):
    table = SnapshotTable(spark, tmp_dir + "/feat")
    table.publish(Q._docs(spark, SF_MID))
    cfg = TrainConfig(feature_table_root=tmp_dir + "/feat", registry_root=tmp_dir + "/reg",
                      artifacts_root=tmp_dir + "/art", model_name="docq", params=PARAMS)
    first = train(spark, Q.DOC_SPEC, cfg, run_id="r1")
    assert first["promoted"] and first["model_version"] == "1" and first["champion_version_before"] is None
    counts = first["split_row_counts"]
    assert sum(counts.values()) == 399 and set(counts) == {"train", "validation", "test"}
    second = train(spark, Q.DOC_SPEC, cfg, run_id="r2")
    assert second["model_version"] == "2" and second["champion_version_before"] == "1"
    assert second["champion_metrics"] is not None
    out = tmp_dir + "/preds"
    res = score(spark, Q.DOC_SPEC, ScoreConfig(feature_table_root=tmp_dir + "/feat", registry_root=tmp_dir + "/reg",
                                               output_path=out, model_name="docq"))
    assert res["rows_written"] == 601
    preds = spark.read.parquet(out)
    assert preds.count() == 601 and len(preds.columns) == 13 + len(Q.DOC_SPEC.metadata)
    assert preds.where(F.col("model_source_run_id").isNull()).count() == 0
    manifest_dir = os.path.join(tmp_dir, "art", "splits", "run_id=r1", "_manifest")
    assert os.path.isdir(manifest_dir)


def test_stream_scoring_processes_each_file_once(spark, tmp_dir):
    src = tmp_dir + "/incoming"
    docs = Q._docs(spark, SF_MID)
    docs.where(F.col("doc_id") < 500).write.parquet(src + "/a")
    prov = Provenance("m", "champion", "1", "r", "documents", 0, None, "2024-02-01 00:00:00")
    schema = docs.schema
    import glob
    import shutil
    flat = tmp_dir + "/flat"
    os.makedirs(flat)
    for i, f in enumerate(glob.glob(src + "/a/*.parquet")):
        shutil.copy(f, f"{flat}/a{i}.parquet")
    name = "t-" + uuid.uuid4().hex  # progress persists in the shared checkpoint folder
    r1 = score_new_files(spark, flat, schema, Q.DOC_SPEC, Q._doc_score, prov, tmp_dir + "/out", name=name)
    want1 = docs.where((F.col("doc_id") < 500) & F.col("label").isNull()).count()
    assert r1["rows_written"] == want1
    docs.where(F.col("doc_id") >= 500).write.parquet(src + "/b")
    for i, f in enumerate(glob.glob(src + "/b/*.parquet")):
        shutil.copy(f, f"{flat}/b{i}.parquet")
    r2 = score_new_files(spark, flat, schema, Q.DOC_SPEC, Q._doc_score, prov, tmp_dir + "/out", name=name)
    assert r2["rows_written"] == docs.where((F.col("doc_id") >= 500) & F.col("label").isNull()).count()
