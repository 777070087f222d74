"""Urls, source mixing and top-k search; the pipeline and the guard of the entry."""

import math
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from seqspark.llm import mixing, topk, url_rules
from seqspark.llm.queries import URL_RULES

SF = "/root/testdata/sf0.001"


def judged(url):
    """Host, path, rule and its verdict, written apart from the operator."""
    match = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = match.groups() if match else ("", "")
    host = "".join(c.lower() if c.isascii() else c for c in host)
    fits = [
        (len(r), r, v) for r, v in URL_RULES for h, _, p in [r.partition("/")]
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p)
    ]
    return (host, path, *(max(fits)[1:] if fits else (None, None)))


URLS = [
    None, "", "no scheme", "http://", "http://A.Example.ORG/es/x", "https://example.org/en/12?q=1#f", "http://example.org", "http://badexample.org/",
    "http://x.com/fr/1", "http://x.com/de/1", "http://x.com/DE/1", "http://x.com?u=http://y.org/", "a://b://c.org/", "http://É.org/ü", "http://x.net/" + "s/" * 5000,
    "http://example.org/en/1", "http://com/fr/", "http://org/",
]


def test_urls(spark):
    rows = [(i, u, "x") for i, u in enumerate(URLS)] + [(0, None, "x"), (None, "http://x.org/", "x")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, rule string")
    found = url_rules.judge_urls(pages, URL_RULES).collect()
    want = Counter((i, *judged(u)[:3], judged(u)[3] or "allow") for i, u, _ in rows)
    assert Counter((r.page_id, r.host, r.path, r.rule, r.verdict) for r in found) == want
    assert url_rules.judge_urls(pages.limit(0), URL_RULES).count() == 0


def test_mined_rules(spark):
    rows = [(i, f"http://h{i % 7}.example.{['org', 'net', 'com'][i % 3]}/{['de', 'fr', 'en', 'it'][i % 4]}/{i}") for i in range(1200)]
    labels = spark.createDataFrame(
        [(u, "block" if "/de/" in u else "allow") for i, u in rows if i % 2 == 0 or "/de/" not in u], "url string, verdict string"
    )
    more = spark.createDataFrame([(u, "block") for _, u in rows if "/de/" in u], "url string, verdict string")
    pages = spark.createDataFrame(rows, "page_id bigint, url string")
    found = url_rules.judge_urls(pages, [], labels.union(more), min_count=10).collect()
    assert all(r.verdict == ("block" if "/de/" in r.url else "allow") and r.confidence == 1.0 for r in found)


def test_mixing(spark, docs_of):
    rows = [(i, "x" * (i % 50), "en", ["a", "b", None, "c"][i % 4]) for i in range(4000)] + [(5000, None, "en", "d"), (None, "t", "en", "d"), (None, "t", "en", "d")]
    docs = docs_of(rows).withColumn("copy", F.lit("clash"))
    found = mixing.mix_sources(docs, {"a": 3.0, "c": 0.0, "d": 0.001}, seed=3)
    assert found.columns == ["doc_id", "text", "lang", "source", "n_chars", "copy", "rate", "shuffle_key"]
    got = found.collect()
    assert [r.shuffle_key for r in got] == sorted(r.shuffle_key for r in got)
    size = Counter()
    for r in got:
        size[r.source] += len(r.text or "") + 1
    total = sum(size.values())
    assert "c" not in size and abs(size["a"] / total - 0.6) < 0.04 and abs(size[None] / total - 0.2) < 0.04
    copies = Counter(r.doc_id for r in got if r.source == "a")
    mean = next(r.rate for r in got if r.source == "a")
    absent = sum(1 for i in range(0, 4000, 4) if i not in copies) / 1000
    assert abs(absent - math.exp(-mean)) < 0.05
    assert mixing.mix_sources(docs_of([]), {}).count() == 0
    assert mixing.mix_sources(docs_of(rows), {}, default_weight=0.0).count() == 0


def test_large_rates(docs_of):
    docs = docs_of([(0, "rare", "en", "r")] + [(i, "common", "en", "c") for i in range(1, 1500)])
    found = mixing.mix_sources(docs, {"r": 1.0, "c": 1.0})
    n = found.where("source = 'r'").count()
    rate = found.where("source = 'r'").first().rate
    assert rate > 500 and abs(n - rate) < 6 * math.sqrt(rate)


def brute_top(vectors, every, k):
    out = {}
    usable = [(i, v) for i, v in vectors if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    ints = {(i, tuple(math.floor(64 * x) for x in v)) for i, v in usable}
    for q, a in ints:
        if q % every == 0:
            best = sorted((-sum(x * y for x, y in zip(a, b, strict=False)), i) for i, b in ints if i != q)[:k]
            out[q] = [(r + 1, i, -s) for r, (s, i) in enumerate(best)]
    return out


@pytest.mark.parametrize("shard,block", [(8192, 1024), (50, 3)])
def test_top_k(spark, shard, block):
    rng = np.random.default_rng(6)
    vectors = [(i, rng.normal(0, 0.3, 8).astype(np.float32).tolist()) for i in range(400)]
    vectors += [(i, vectors[i % 400][1]) for i in range(400, 460)] + [(20, vectors[20][1]), (470, None), (480, [float("nan")] * 8), (500, [None] * 8),
                (520, []), (521, [1.0, 2.0]), (None, vectors[3][1]), (540, [float("inf")] + [0.0] * 7), (560, [0.0] * 8)]
    table = spark.createDataFrame([(i, v, 0) for i, v in vectors], "vec_id bigint, embedding array<float>, rank int")
    found = {}
    for r in topk.search_top_k(table, 20, 20, shard=shard, block=block).orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert found == brute_top(vectors, 20, 20)
    assert topk.search_top_k(table.limit(0)).count() == 0


def test_pipeline(spark):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language", "exact_dedup", "near_dedup", "mixing", "packing"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    before = {r.doc_id: r.text for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:3]:
        docs = stage(spark, docs, SF)
        assert docs.columns == columns, name
    # Brute force of the two deduplications; every document has a language here.
    unique = {}
    for i in sorted(before):
        unique[before[i]] = i
    from test_dedup import brute_links

    rows = sorted((i, t) for t, i in unique.items())
    _, roots = brute_links(rows)
    kept = sorted({rows[r][0] for r in roots})
    assert sorted(r.doc_id for r in docs.collect()) == kept
    mixed = corpus_pipeline.STAGES[3][1](spark, docs, SF)
    assert mixed.columns == columns and {r.doc_id for r in mixed.collect()} <= set(kept)
    assert corpus_pipeline.run(spark, SF).select("doc_id").distinct().count() == mixed.select("doc_id").distinct().count()


@pytest.mark.parametrize("name", ["op8_chunk_dedup", "op9_mixing", "op10_top_k"])
def test_sql(spark, name):
    from check import _rows

    db = duckdb.connect()
    for t in ("documents", "embeddings"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = queries()[name](spark, SF)
    cursor = db.execute(oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert _rows(df.columns, df.collect()) == _rows(columns, cursor.fetchall())


@pytest.mark.parametrize("name", ["op1_", "op2_", "op3_", "op4_", "op5_", "op6_", "op7_", "pipeline"])
def test_whole_tables(spark, name):
    full = next(n for n in queries() if n.startswith(name))
    rows = queries()[full](spark, SF).count()
    table = "pages" if name == "op6_" else "documents"
    have = spark.read.parquet(f"{SF}/{table}.parquet").count()
    assert rows == have if name not in ("op5_", "pipeline") else rows > 0.5 * have
