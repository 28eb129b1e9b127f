"""Landing: what a landed frame leaves behind. Texts in portions, and memory of a worker between its tasks."""

import random
import re
import time
from pathlib import Path

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyweek.llm.shared import LANDING, landed, portions, tidy


def _shuffle_blocks(spark):
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {b for b in manager.getAllBlocks().mkString(" ").split() if b.startswith("shuffle_")}


def test_shuffle_files_go_once_a_frame_is_landed(spark):
    before, kept = _shuffle_blocks(spark), {key: spark.conf.get(key, None) for key in LANDING}
    rows = landed(spark.range(1000).repartition(5, "id").groupBy((F.col("id") % 7).alias("k")).count(), "counts")
    for _ in range(50):  # executors remove them in their own time
        if not (left := _shuffle_blocks(spark) - before):
            break
        time.sleep(0.1)
    assert not left
    assert {key: spark.conf.get(key, None) for key in LANDING} == kept
    assert rows.count() == 7 and rows.agg(F.sum("count")).first()[0] == 1000


def test_portions_hold_all_texts_in_order():
    rnd = random.Random(2)
    texts = [b"x" * rnd.choice([0, 1, 5, 9, 40]) for _ in range(300)]
    for size, most in ((0, 1000), (10, 1000), (60, 7), (10**6, 1000)):
        for given in (texts, pa.array([b"before", *texts], pa.binary()).slice(1)):
            found = list(portions(given, size, most))
            assert [t for some in found for t in some] == texts
            assert all(some and len(some) <= most and (len(some) == 1 or sum(map(len, some)) <= size) for some in found)
    assert list(portions([], 10)) == list(portions(pa.array([], pa.binary()), 10)) == []


def _held() -> float:
    """MB of this process's own memory."""
    return int(re.search(r"\nPss_Anon:\s+(\d+)", Path("/proc/self/smaps_rollup").read_text())[1]) / 1024


@pytest.mark.skipif(not Path("/proc/self/smaps_rollup").exists(), reason="memory can't be read here")
def test_a_task_gives_its_memory_back():
    remembered = []

    def run(batches):
        for batch in batches:
            texts = [bytes(2000) for _ in range(60_000)]
            remembered.extend(texts[::500])  # what is kept lies between what is freed
            yield batch

    before = _held()
    assert len(list(tidy(run)(iter([1, 2])))) == 2
    assert _held() - before < 40 and len(remembered) == 240
