"""Operators called directly, by a program that runs in another folder than the repository."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

PROGRAM = """
import sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession
from seqspark.llm import byte_bpe, conversations, hard_negatives, ngram_join
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
docs = spark.createDataFrame([(i, "one two three four five six seven", "en", "s", 1) for i in range(3)], "doc_id bigint, text string, lang string, source string, n_chars bigint")
chats = spark.createDataFrame([(1, 0, "user", "a."), (1, 1, "assistant", "b.")], "conv_id bigint, turn bigint, role string, text string")
rows = spark.createDataFrame([(i, [1.0, float(i)], i % 2) for i in range(6)], "vec_id bigint, embedding array<double>, label int")
print("counts", byte_bpe.digest_tokens(docs).count(), conversations.repair_report(conversations.damage(chats)).count(),
      hard_negatives.mine_hard_negatives(rows, anchor_every=1).count() >= 0, ngram_join.ngram_join(docs).count())
"""


def test_from_another_folder(tmp_path):
    environment = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", PROGRAM, ROOT], cwd=tmp_path, env=environment, capture_output=True, text=True, timeout=600)
    assert "counts 3 1 True 3" in done.stdout, done.stderr[-3000:]
