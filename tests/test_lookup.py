"""Key lookups on a table with sorted row groups and Bloom filters."""

import pytest
from pyspark.sql import functions as F

from postlake.sources.files import lookup_value, single_value, write_lookup


def rows_read(df) -> int:
    """Rows that the scan hands on: those of the row groups it could not skip."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    text, found = plan, None
    while found is None:
        if "Scan" in text.nodeName():
            found = text
        elif text.nodeName() == "AdaptiveSparkPlan":
            text = text.executedPlan()
        else:
            text = text.children().head()
    return found.metrics().apply("numOutputRows").value()


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    """Even keys, so odd ones lie inside the range of a row group but are absent."""
    path = str(tmp_path_factory.mktemp("lookup") / "t")
    df = spark.range(0, 200_000, 1, 4).select((F.col("id") * 2).cast("string").alias("key"), F.sha2(F.col("id").cast("string"), 256).alias("value"))
    write_lookup(df, path, "key", row_group_bytes=256 << 10, distinct_keys=20_000)
    return spark.read.parquet(path)


def test_a_present_key_reads_its_row_groups_only(table):
    found = lookup_value(table, "key", "123456", "value")
    assert len(found.collect()) == 1
    assert 0 < rows_read(lookup_value(table, "key", "123456", "value")) < 20_000


def test_an_absent_key_reads_nothing(table):
    for key in ("123457", "77777", "zzz", ""):
        assert rows_read(lookup_value(table, "key", key, "value")) == 0
    with pytest.raises(LookupError):
        single_value(table, "key", "123457", "value")


def test_bloom_filters_are_what_rules_it_out(spark, table):
    """With them ignored, an absent key inside a range costs its row group."""
    old = spark.conf.get("parquet.filter.bloom.enabled", None)
    spark.conf.set("parquet.filter.bloom.enabled", "false")
    try:
        assert rows_read(lookup_value(table, "key", "123457", "value")) > 0
    finally:
        spark.conf.unset("parquet.filter.bloom.enabled") if old is None else spark.conf.set("parquet.filter.bloom.enabled", old)
