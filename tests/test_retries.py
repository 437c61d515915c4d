"""Tasks that fail once and run again: results stay whole and counts exact."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

PROGRAM = """
import sys
sys.path.insert(0, {root!r})
from pyspark import TaskContext
from pyspark.sql import SparkSession, Window, functions as F
from millrace import Lag, moving, read_files, write_files

spark = (SparkSession.builder.master("local[4, 4]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "4").config("spark.checkpoint.dir", {folder!r}).getOrCreate())
spark.sparkContext.setLogLevel("OFF")

def flaky(batches):
    context = TaskContext.get()
    for i, batch in enumerate(batches):
        yield batch
    if context.attemptNumber() == 0 and context.partitionId() % 2 == 1:
        raise RuntimeError("lost")

calm = spark.range(0, 20000, 1, 8).selectExpr("id", "id % 3 as g", "if(id % 3 = 0, 1, id) as v")
df = calm.mapInPandas(flaky, calm.schema)
for fmt in ("parquet", "csv", "json"):
    for extra in (dict(), dict(sort_by=["v"]), dict(partition_by=["g"], rebalance=True)):
        path = {folder!r} + f"/{{fmt}}-{{len(extra)}}-{{'sort_by' in extra}}"
        assert write_files(df, path, fmt, **extra).rows == 20000, (fmt, extra)
        back = read_files(spark, path, fmt, schema=calm.schema).select(calm.columns)
        assert back.exceptAll(calm).isEmpty() and calm.exceptAll(back).isEmpty(), (fmt, extra)

window = Window.partitionBy("g").orderBy("v", "id")
got = moving(df, ["g"], ["v", "id"], {{"p": Lag("id")}}, "n", 500)
want = calm.withColumns({{"p": F.lag("id").over(window), "n": F.row_number().over(window).cast("long")}})
assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
print("whole")
"""


def test_repeated_tasks(tmp_path):
    program = PROGRAM.format(root=ROOT, folder=str(tmp_path))
    done = subprocess.run([sys.executable, "-c", program], timeout=600, capture_output=True, text=True)
    assert done.stdout.strip().endswith("whole"), done.stderr[-3000:]
