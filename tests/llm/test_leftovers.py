"""What operators write into the shared folder goes when the application ends."""

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SCRIPT = """
import sys
from pyspark.sql import SparkSession
sys.path.insert(0, {repo!r})
spark = (SparkSession.builder.master("local[2]").config("spark.checkpoint.dir", "file://{shared}").config("spark.sql.shuffle.partitions", "2")
  .config("spark.ui.enabled", "false").config("spark.driver.host", "127.0.0.1").getOrCreate())
import __spark_entry__ as entry
for name in {names!r}:
    entry.queries()[name](spark, "/root/testdata/sf0.001").write.format("noop").mode("overwrite").save()
spark.stop()
"""


def test_the_shared_folder_is_empty_after_exit(tmp_path):
    shared = tmp_path / "shared"
    shared.mkdir()
    names = ["op1_bpe_codec", "op9_quality_rules", "op11_importance_resampling", "op13_conversation_trie", "pipeline", "verse_corpus"]
    subprocess.run([sys.executable, "-c", SCRIPT.format(repo=REPO, shared=shared, names=names)], check=True, timeout=900, cwd=tmp_path)
    assert sorted(os.listdir(shared)) == []
