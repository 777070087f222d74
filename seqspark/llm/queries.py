"""The registered queries: each operator with its production parameters over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from seqspark.llm import byte_bpe, chunk_dedup, conversations, hard_negatives, language, mixing, ngram_join, packing, repeats, token_files, topk, toxicity, url_rules
from seqspark.llm.common import read_table
from seqspark.llm.registry import query
from seqspark.session import scratch_path

# Target shares; sources not named weigh 1.
TARGET_WEIGHTS = {"src0": 4.0, "src1": 2.0, "src2": 2.0}
MIXING_SEED = 17

QUERY_EVERY = 20
TOP_K = 20

# The rules of the contract: (host/path, verdict).
URL_RULES = [
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
]


@query("op1_ngram_join")
def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all documents with their numbers of links."""
    return ngram_join.ngram_join(read_table(spark, sf_dir, "documents"))


@query("op2_toxicity")
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents."""
    return toxicity.score_toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@query("op3_repeats")
def op3_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the byte strings that repeat."""
    return repeats.remove_repeats(read_table(spark, sf_dir, "documents"))


@query("op4_token_files")
def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of all documents, written to files and read back."""
    path = scratch_path(spark, "token-files")
    token_files.write_token_files(read_table(spark, sf_dir, "documents"), path)
    return token_files.read_token_files(spark, path)


@query("op5_packing")
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences."""
    return packing.pack_documents(read_table(spark, sf_dir, "documents"))


@query("op6_url_rules")
def op6_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on all urls."""
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    return url_rules.judge_urls(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict", "learned", "confidence")


@query("op7_language")
def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all documents."""
    return language.identify_languages(read_table(spark, sf_dir, "documents"))


@query("op8_chunk_dedup", """
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
g AS (SELECT text, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY text)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept, sha256(t.text) AS text_sha256
FROM t JOIN g ON t.text = g.text""")
def op8_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact copies among all documents."""
    return chunk_dedup.find_copies(read_table(spark, sf_dir, "documents"))


@query("op9_mixing", mixing.mixing_sql(TARGET_WEIGHTS, 1.0, MIXING_SEED))
def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents repeated to the target weights of their sources, in shuffled order."""
    return mixing.mix_sources(read_table(spark, sf_dir, "documents"), TARGET_WEIGHTS, 1.0, MIXING_SEED)


@query("op10_top_k", topk.top_k_sql(QUERY_EVERY, TOP_K, topk.SCALE))
def op10_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best rows for every query vector."""
    return topk.search_top_k(read_table(spark, sf_dir, "embeddings"), QUERY_EVERY, TOP_K)


@query("op13_byte_bpe")
def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents by a rank file, and what they decode to, as digests."""
    return byte_bpe.digest_tokens(read_table(spark, sf_dir, "documents"))


@query("op12_conversations")
def op12_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations damaged and repaired again: faults, cheapest edits and a hash of the repaired turns."""
    return conversations.repair_report(conversations.damage(read_table(spark, sf_dir, "conversations")))


@query("op11_hard_negatives", hard_negatives.hard_negatives_sql())
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of all anchors among all vectors, one label in seven being wrong."""
    return hard_negatives.mine_hard_negatives(hard_negatives.relabelled(read_table(spark, sf_dir, "embeddings")))
