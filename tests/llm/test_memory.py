"""What a Python worker holds while it handles texts, and after."""
import subprocess
import sys
import tracemalloc

import pyarrow as pa

from tidemark.llm import common, quality, toxicity

TEXT = " ".join(f"word{i % 5000} and some more" for i in range(4000))      # about 90 KB


def most_mb(run) -> float:
    list(run())
    tracemalloc.start()
    list(run())
    most = tracemalloc.get_traced_memory()[1] / 1e6
    tracemalloc.stop()
    return most


def batch() -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"doc_id": list(range(60)), "text": [TEXT] * 60})


def test_a_block_takes_little():
    assert most_mb(lambda: (quality.statistics(b.column("text")) for b in common.blocks([batch()]))) < 70
    assert sum(p.nbytes for p in common._POWERS) <= 16 << 20
    net = toxicity.Network()
    assert most_mb(lambda: (net.score(b.column("text")) for b in common.blocks([batch()]))) < 90


def test_free_memory_is_given_back_after_the_last_block():
    """Small pieces between which nothing is left stay with a process that doesn't give them back."""
    code = """
import re, pyarrow as pa
from tidemark.llm import common
def mb():
    return int(re.search(r"Rss: +(\\d+)", open("/proc/self/smaps_rollup").read())[1]) / 1024
batch = pa.RecordBatch.from_pydict({"text": ["a b"] * 10})
before = mb()
for block in common.blocks([batch]):
    held = [bytearray(2000) for _ in range(50_000)]
    pin = bytearray(2000)
    del held
print(mb() - before)
"""
    grown = float(subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True).stdout)
    assert grown < 30


def test_readers_hand_on_batches_of_the_same_rows(spark):
    common.table(spark, "/root/testdata/sf0.001", "documents")
    assert spark.conf.get("spark.sql.parquet.columnarReaderBatchSize") == str(common.BATCH_ROWS)
