"""Range-partitioned vocabularies and the encoder that joins them."""

from pyspark.sql import functions as F

from quarry.operators.prep import encode_rows, value_ranges, vocabulary


def test_one_beginning_is_balanced(spark):
    """A million values that begin alike spread over the tasks, and their slots are their places."""
    df = spark.range(1_000_000).select(F.concat(F.lit("merchant_"), F.lpad(F.col("id").cast("string"), 7, "0")).alias("m"))
    sizes = [r["count"] for r in value_ranges(df, ["m"]).groupBy("_r").count().collect()]
    assert len(sizes) > 3 and sum(sizes) == 1_000_000 and max(sizes) < 2 * sum(sizes) / len(sizes)
    wrong = vocabulary(df, ["m"]).where(F.col("slot") != F.substring("value", 10, 7).cast("int"))
    assert wrong.count() == 0


def test_codes_against_sorting(spark):
    values = ["", " ", "a", "A", "ab", "é", "漢字", "😀", "z" * 500, None, "a"] * 3
    rows = [(i, v, i % 4) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "id int, column_name string, n int")
    fit = df.where("id % 5 <> 1")
    vocab = vocabulary(fit, ["column_name", "n"])
    want = {}
    for c, at, as_text in (("column_name", 1, str), ("n", 2, str)):
        known = sorted({as_text(r[at]) for r in rows if r[0] % 5 != 1 and r[at] is not None}, key=lambda v: v.encode())
        want |= {(r[0], c): known.index(as_text(r[at])) for r in rows if r[at] is not None and as_text(r[at]) in known}
    got = {(r[0], r[1]): r[2] for r in encode_rows(df, ["id"], ["column_name", "n"], vocab).collect()}
    assert got == want


def test_unseen_and_empty(spark):
    df = spark.createDataFrame([(1, "x"), (2, None), (2, "x")], "id int, c string")
    empty = vocabulary(df.limit(0), ["c"])
    assert empty.count() == 0 and encode_rows(df, ["id"], ["c"], empty).count() == 0
    assert [tuple(r) for r in encode_rows(df, ["id"], ["c"], vocabulary(df, ["c"])).orderBy("id").collect()] == [(1, "c", 0), (2, "c", 0)]


def test_hot_value_is_split(spark):
    """The cells of one frequent value go to more than one task."""
    keep = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes",
                                           "spark.sql.adaptive.skewJoin.skewedPartitionFactor",
                                           "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "64KB")
        spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "1.5")  # cells of one value compress well
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        df = spark.range(200_000, numPartitions=16).select("id", F.when(F.col("id") % 2 == 0, F.lit(-1)).otherwise(F.col("id")).alias("c"))
        out = encode_rows(df, ["id"], ["c"], vocabulary(df, ["c"]).persist())
        spread = out.where("slot = 0").select(F.spark_partition_id().alias("p")).distinct().count()
        assert out.count() == 200_000 and spread > 1
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)
