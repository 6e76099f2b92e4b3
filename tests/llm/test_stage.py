import glob

from pyspark.sql import functions as F

from souk.llm.common import Stage

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def test_a_write_leaves_no_shuffle_files_and_the_settings_as_they_were(spark):
    root = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()[0]
    files = lambda: set(glob.glob(f"{root}/**/shuffle_*", recursive=True))
    before, settings = files(), [spark.conf.get(k) for k in (CLEANUP, "spark.sql.execution.arrow.maxRecordsPerBatch")]
    counted = spark.range(100_000).groupBy((F.col("id") % 1000).alias("k")).count()
    got = Stage(spark, "test").write(counted.join(counted.withColumnRenamed("count", "n"), "k"), "counts", 64)
    assert got.count() == 1000 and got.agg(F.sum("n")).first()[0] == 100_000
    assert [spark.conf.get(k) for k in (CLEANUP, "spark.sql.execution.arrow.maxRecordsPerBatch")] == settings
    assert len([x for x in files() - before if x.endswith(".data")]) <= 2  # those of the counts above, not of the write


def test_a_failed_write_restores_the_settings(spark):
    bad = spark.range(3).select(F.raise_error(F.lit("stop")).alias("x"))
    before = spark.conf.get(CLEANUP)
    try:
        Stage(spark, "test").write(bad, "bad")
    except Exception:
        pass
    else:
        raise AssertionError("the write should fail")
    assert spark.conf.get(CLEANUP) == before
