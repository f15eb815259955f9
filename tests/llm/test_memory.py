"""Python workers give back what a task held."""

import re
import sys
from pathlib import Path

import pyarrow as pa
import pytest
import tokenizers
from pyspark.sql import functions as F

from vecferry.llm import common, exact, quality


def held_back(spark) -> int:
    """The most MB that a waiting worker has beyond what it needs; afterwards none has any."""

    def look(batches):
        import ctypes
        import time

        def anonymous():
            return sum(map(int, re.findall(r"\nPss_Anon:\s+(\d+)", Path("/proc/self/smaps_rollup").read_text()))) >> 10

        for _ in batches:
            pass
        time.sleep(1)  # so that every task has a worker of its own
        before = anonymous()
        pa.default_memory_pool().release_unused()
        ctypes.CDLL(None).malloc_trim(0)
        yield pa.RecordBatch.from_pydict({"mb": [before - anonymous()]})

    n = spark.sparkContext.defaultParallelism
    return max(r[0] for r in spark.range(0, n, 1, n).mapInArrow(look, "mb long").collect())


@pytest.mark.skipif(not sys.platform.startswith("linux"), reason="reads /proc")
def test_workers_give_back_what_a_task_held(spark):
    words = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(200)), lambda i: F.hex(F.xxhash64("doc_id", i))), " ")
    documents = spark.range(0, 12_000, 1, 1).select(F.col("id").alias("doc_id")).withColumn("text", words)
    model = quality.Model(quality.np.zeros(2 * quality.PLACES), 0.0, 40.0)
    for step in (exact.exact_dedup, lambda d: quality.quality_rules(d, model)):
        held_back(spark)
        assert step(documents).count() == 12_000
        step(documents).write.format("noop").mode("overwrite").save()
        assert held_back(spark) < 40


def test_encoders_stay_for_tasks_that_use_them_alone():
    was = vars(tokenizers).pop("_vecferry_encoders", None)
    try:
        tokenizers._vecferry_encoders = {"a": 1}
        assert list(common.returning(iter, encoders=True)([1, 2])) == [1, 2]
        assert tokenizers._vecferry_encoders == {"a": 1}
        assert list(common.returning(iter)([3])) == [3]
        assert not hasattr(tokenizers, "_vecferry_encoders")
    finally:
        if was is not None:
            tokenizers._vecferry_encoders = was
