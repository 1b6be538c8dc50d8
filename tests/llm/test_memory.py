"""What a Python worker keeps of its tasks' memory."""

import subprocess
import sys
from pathlib import Path

import pytest

from archiveloom.llm import packing as pk

# Runs alone in its process; prints the MB that are left after a task over some 24 MB of text.
TASK = """
import numpy as np
import pyarrow as pa
import pyarrow.compute
from archiveloom.llm import jaccard

def held():
    return int(next(l for l in open("/proc/self/status") if l.startswith("RssAnon")).split()[1]) / 1024

words = [f"word{i}" for i in range(5000)]
draw = np.random.default_rng(1)

def batches():
    for first in range(0, 30_000, 5000):
        texts = [" ".join(words[i] for i in row) for row in draw.integers(0, len(words), (5000, 90))]
        yield pa.RecordBatch.from_arrays([pa.array(range(first, first + 5000), pa.int64()), pa.array(texts)], ["id", "text"])

def sender():
    for _ in jaccard._sender(5, 2, 0, ())(batches()):
        pass

def counter():
    sent = pa.Table.from_batches(list(jaccard._sender(5, 2, 0, ())(batches())))
    one = sent.filter(pa.compute.equal(sent["bucket"], 1))
    del sent
    jaccard._counter(2, ())((pa.scalar(1),), one)

before = held()
{task}()
print(held() - before)
"""


@pytest.mark.skipif(sys.platform != "linux", reason="reads /proc, and only glibc can be trimmed")
@pytest.mark.parametrize("task", ["sender", "counter"])
def test_a_worker_gives_back_what_its_task_took(task):
    code = TASK.replace("{task}", task)
    ran = subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).parents[2], capture_output=True, text=True, timeout=300)
    assert ran.returncode == 0, ran.stderr
    assert float(ran.stdout) < 30, ran.stdout


def test_buckets_hold_as_much_text_as_asked(spark):
    docs = spark.range(100).selectExpr("repeat('x', 10) as text")
    assert pk.bucket_bits(docs, bucket_bytes=125) == 3
    assert pk.bucket_bits(docs, bucket_bytes=62) == 5
