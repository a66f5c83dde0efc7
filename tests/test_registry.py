"""Registry semantics: promotion, aliases, tags, versions."""

import pytest

from quarry.functions.uris import model_uri
from quarry.operators.registry import CHALLENGER, CHAMPION, Registry


def test_promotion_rules(spark, tmp_dir):
    r = Registry(spark, tmp_dir + "/reg")
    v1 = r.register_version("m", "run1")
    assert v1 == "1" and r.register_version("m", "run1") == "1"  # idempotent per run
    rec = r.promote_if_better("m", v1, "average_precision", 0.7, None)
    assert rec["promoted"] and rec["champion_version"] is None
    assert r.alias_version("m", CHAMPION) == "1" == r.alias_version("m", CHALLENGER)
    v2 = r.register_version("m", "run2")
    tie = r.promote_if_better("m", v2, "average_precision", 0.7, 0.7)
    assert not tie["promoted"] and tie["champion_version"] == "1"
    assert r.alias_version("m", CHAMPION) == "1" and r.alias_version("m", CHALLENGER) == "2"
    v3 = r.register_version("m", "run3")
    win = r.promote_if_better("m", v3, "average_precision", 0.8, 0.7)
    assert win["promoted"] and r.alias_version("m", CHAMPION) == "3"
    assert r.promote_if_better("m", "4", "roc_auc", None, 0.5)["promoted"] is False


def test_version_for_run_numeric(spark, tmp_dir):
    r = Registry(spark, tmp_dir + "/reg2")
    for i in range(11):
        r.register_version("m", f"run{i}")
    r.append("model_versions", [("m", "12", "run3", None)])
    assert r.version_for_run("m", "run3") == "12"  # numeric, not string max
    with pytest.raises(RuntimeError):
        r.version_for_run("m", "nope")


def test_tags_latest(spark, tmp_dir):
    r = Registry(spark, tmp_dir + "/reg3")
    r.set_tags("m", "1", {"a": 1, "b": True})
    r.set_tags("m", "1", {"a": 2})
    from quarry.operators.registry import current_tags
    got = {x["key"]: x["value"] for x in current_tags(r.table("tag_events")).collect()}
    assert got == {"a": "2", "b": "True"}


def test_model_uri(spark):
    rows = spark.createDataFrame([("m", "champion", 3), ("m", None, 3), ("m", None, None)], "m string, a string, v int")
    got = [r[0] for r in rows.select(model_uri(rows.m, rows.a, rows.v)).collect()]
    assert got == ["models:/m@champion", "models:/m/3", None]
