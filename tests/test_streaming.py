import datetime as dt
import os

from pyspark.sql import functions as F

from conftest import SF_SMALL
from strata.plans import jobs
from strata.sources import derived as D
from strata.sources.config import CONTACT_RULES, CONTACT_SILVER_COLUMNS
from strata.sources.schemas import QUARANTINE_RECORDS
from strata.streaming import incremental as S

RULE = {"validations": CONTACT_RULES,
        "transformations": [{"field": "emailaddress1", "operations": ["trim", "lowercase"]}],
        "deduplication": {"enabled": True, "key_fields": ["contactid"], "order_by": "modifiedon", "order": "desc",
                          "tie_breakers": ["versionnumber"]}}


def test_micro_batches_equal_the_batch_job(spark, tmpdir_path):
    bronze = D.bronze_contact(spark, SF_SMALL)
    src = os.path.join(tmpdir_path, "bronze")
    # two arrivals of bronze files (split by order key parity, every row once)
    bronze.filter("versionnumber % 2 = 0").write.parquet(os.path.join(src, "a"))
    bronze.filter("versionnumber % 2 = 1").write.parquet(os.path.join(src, "b"))
    stream = spark.readStream.schema(bronze.schema).option("recursiveFileLookup", "true") \
        .option("maxFilesPerTrigger", 1).parquet(src)
    out = os.path.join(tmpdir_path, "out")
    q = S.dq_micro_batches(stream, RULE, "contact", out, os.path.join(tmpdir_path, "ckpt"),
                           silver_columns=CONTACT_SILVER_COLUMNS + ["versionnumber"])
    q.awaitTermination(300)
    changes = spark.read.parquet(os.path.join(out, "silver_changes"))
    snap = S.silver_snapshot(changes.drop("_silver_loaded_at", "_silver_timestamp"), ["contactid"], "modifiedon",
                             ["versionnumber"])
    batch = jobs.dq_frames(bronze, RULE, "contact", jobs.Run("r", dt.datetime(2024, 1, 1)),
                           silver_columns=CONTACT_SILVER_COLUMNS + ["versionnumber"]).silver \
        .drop("_silver_loaded_at", "_silver_timestamp")
    cols = sorted(batch.columns)
    assert sorted(map(tuple, snap.select(*cols).collect())) == sorted(map(tuple, batch.select(*cols).collect()))
    quarantined = spark.read.parquet(os.path.join(out, "quarantine")).count()
    assert quarantined == jobs.dq_frames(bronze, RULE, "contact", jobs.Run("r", dt.datetime(2024, 1, 1))) \
        .quarantine.count()


def test_daily_quarantine_counts(spark, tmpdir_path):
    rows = [(f"q{i}", "contact", "r", "email_invalid", None, None, "{}", "new", None, None, None,
             dt.datetime(2024, 1, 1 + i % 3, 5)) for i in range(30)]
    src = os.path.join(tmpdir_path, "q")
    spark.createDataFrame(rows, QUARANTINE_RECORDS).write.parquet(src)
    stream = spark.readStream.schema(QUARANTINE_RECORDS).parquet(src)
    agg = S.daily_quarantine_counts(stream)
    q = agg.writeStream.outputMode("update").format("memory").queryName("qcounts").start()
    q.processAllAvailable()
    q.stop()
    got = {(r.d.day, r.n) for r in spark.table("qcounts").groupBy("d").agg(F.max("n").alias("n")).collect()}
    assert got == {(1, 10), (2, 10), (3, 10)}
