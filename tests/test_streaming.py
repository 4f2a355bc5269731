"""Batch-fitted stages score a stream exactly like the batch frame."""

import tempfile

from pyspark.sql import functions as F

from scorekit.operators import clean as cl
from scorekit.plans import frames as fr
from scorekit.streaming.scoring import apply_chain, read_stream, start_memory_scoring

from .conftest import SF_SMALL


def test_stream_scoring_equals_batch(spark):
    c = fr.cardio(spark, SF_SMALL).select("id", "ap_hi", "ap_lo", "weight")
    wins = cl.Winsorizer(["ap_hi", "ap_lo", "weight"]).fit(c)
    scal = cl.ZScaler(["ap_hi", "ap_lo", "weight"]).fit(c)
    stages = [wins.transform, scal.transform]
    src = tempfile.mkdtemp(prefix="stream-src-", dir="/tmp")
    c.write.mode("overwrite").parquet(src + "/part")
    stream = read_stream(spark, src + "/part", c.schema, max_files=100)
    q = start_memory_scoring(stream, stages, "scored_cardio", checkpoint=tempfile.mkdtemp(prefix="ck-", dir="/tmp"))
    q.processAllAvailable()
    q.stop()
    got = {r["id"]: r["ap_hi"] for r in spark.table("scored_cardio").collect()}
    want = {r["id"]: r["ap_hi"] for r in apply_chain(c, stages).collect()}
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-12 for k in want)
