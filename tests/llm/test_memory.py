"""Idle workers give memory back, and long texts are read few rows at a time."""

import subprocess
import sys

from tideline.llm import common

KEPT = """
import re
import pyarrow as pa
from tideline.llm import common
held = lambda: int(re.search(r"VmRSS:\\s+(\\d+)", open("/proc/self/status").read())[1]) // 1024
done = lambda: list(common.slices([pa.RecordBatch.from_arrays([pa.array([1])], names=["a"])]))
def run():
    some, kept = [], []
    for k in range(3_000):
        some.append(b"x" * 60_000)  # small enough for malloc's own heap
        kept.append(b"y" * 1_000)  # stays and lies between
    return kept
done()
before, kept = held(), run()
mid = held()
done()
print(before, mid, held())
"""


def test_a_finished_task_keeps_no_free_memory():
    out = subprocess.run([sys.executable, "-c", KEPT], capture_output=True, text=True, check=True, cwd=common.__file__.rsplit("/", 3)[0])
    before, mid, after = map(int, out.stdout.split())
    assert mid > before + 100 and after < before + 50, (before, mid, after)


def test_texts_are_read_few_rows_at_a_time(spark):
    conf, before = spark.conf, spark.conf.get(common.READ_ROWS)
    try:
        for given, wanted in (("4096", "512"), ("1000", "1000")):
            conf.set(common.READ_ROWS, given)
            common.modest(spark.range(1))
            assert conf.get(common.READ_ROWS) == wanted
    finally:
        conf.set(common.READ_ROWS, before)
