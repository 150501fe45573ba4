import os
import tempfile

from tablekit.session import scratch_path
from tablekit.streaming import word_count_stream


def test_word_count_stream_matches_batch(spark):
    src = tempfile.mkdtemp(prefix="tk-stream-src-")
    with open(os.path.join(src, "a.txt"), "w") as f:
        f.write("to be or not\nto be\n")
    with open(os.path.join(src, "b.txt"), "w") as f:
        f.write("be quick\n")
    q = (word_count_stream(spark, src).writeStream.outputMode("complete")
         .option("checkpointLocation", scratch_path(spark, "wc-stream"))
         .format("memory").queryName("tk_wc").start())
    try:
        q.processAllAvailable()
        got = {r.word: r.n for r in spark.sql("SELECT * FROM tk_wc").collect()}
    finally:
        q.stop()
    assert got == {"to": 2, "be": 3, "or": 1, "not": 1, "quick": 1}
