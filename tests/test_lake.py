"""The lake derives and writes its data once per session."""

from postlake.plans import questions as q
from postlake.plans.lake import lake
from postlake.session import checkpoint_root


def test_lake_writes_once_under_the_checkpoint_folder(spark, sf_small):
    lk = lake(spark, sf_small)
    assert lake(spark, sf_small) is lk
    assert lk.root.startswith(checkpoint_root(spark) + "/postlake/")
    assert lk.source() is lk.source()
    assert lk.clean("geo") is lk.clean("geo")
    path = lk.records("users")
    assert lk.records("users") == path
    assert spark.read.format("record_log").load(path).count() == lk.raw("users").count() == lk.users.count()


def test_lake_files_are_clustered_by_time(spark, sf_small):
    lk = lake(spark, sf_small).build()
    files = spark.read.parquet(f"{lk.root}/geo").inputFiles()
    for f in files[:3]:
        ts = [r.timestamp for r in spark.read.parquet(f).select("timestamp").collect()]
        present = [t for t in ts if t is not None]
        assert present == sorted(present)


def test_year_filters_open_only_their_folders(spark, sf_small):
    lk = lake(spark, sf_small)
    df = q.posts_per_category_year(lk.geo, lk.posts, 2018, 2019)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(timestamp_year" in plan.replace("\n", " ")
    assert lk.geo.where("timestamp is null").count() == lk.raw("geo").where("timestamp is null").count()


def test_csv_and_topics_are_written_once(spark, sf_small):
    lk = lake(spark, sf_small)
    assert lk.csv("customer") == lk.csv("customer")
    files = sorted(spark.read.text(lk.csv("customer")).inputFiles())
    assert lk.topic("geo") == lk.topic("geo")
    assert sorted(spark.read.text(lk.csv("customer")).inputFiles()) == files


def test_many_tasks_do_not_make_many_files(spark, sf_small, tmp_path):
    import os

    from postlake.plans.lake import write_clean
    geo = lake(spark, sf_small).geo.drop("timestamp_year")
    out = write_clean(geo.repartition(12), "geo", str(tmp_path / "geo"))
    years = [d for d in os.listdir(tmp_path / "geo") if d.startswith("timestamp_year=")]
    files = [f for d in years for f in os.listdir(tmp_path / "geo" / d) if f.endswith(".parquet")]
    assert len(files) <= len(years) + 2 < 12 * len(years)
    assert out.drop("timestamp_year").exceptAll(geo).count() == 0 and out.count() == geo.count()
