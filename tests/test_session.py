import datetime
import re

from pyspark.sql import functions as F

from cleanroom.operators import normalize
from cleanroom.session import configure


def test_shuffled_rows_stay_in_small_partitions(spark):
    """What a task sorts or hashes is bounded: by default partitions would grow to 64 MB, compressed."""
    configure(spark)
    names = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.minPartitionNum": "1"}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        rows = spark.range(600_000).select(F.md5(F.col("id").cast("string")).alias("k"), "id").repartition("k")
        parts = rows.select(F.spark_partition_id().alias("p")).groupBy().agg(F.count_distinct("p").alias("n"))
        assert parts.first().n >= 3
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_long_projections_stay_within_what_the_jvm_compiles(spark):
    """Cleaning loans makes one fused method of over 8000 bytes, which would be interpreted."""
    configure(spark)
    raw = spark.createDataFrame([], "ordinal long, user_name string, email string, borrowed string, checkout string, status string")
    plan = normalize.clean_loans(raw, datetime.date(2024, 6, 1))._jdf.queryExecution().executedPlan()
    debug = spark._jvm.org.apache.spark.sql.execution.debug
    code = getattr(getattr(debug, "package$"), "MODULE$").codegenString(plan)
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", code)]
    assert sizes and all(n <= 8000 or n > int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) for n in sizes)
