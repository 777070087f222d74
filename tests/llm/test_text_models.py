"""Languages and toxicity: held-out accuracy, gradients, odd rows."""

import zlib

import numpy as np

from seqspark.llm import language, toxicity


def test_bundle_is_linear():
    space = language.Space(256, 1)
    counted = [language.grams("the cat"), language.grams("Ünder the sea, the")]
    keys, counts = counted[1]
    assert np.allclose(space.bundle(counted)[1], counts @ space._bind(keys))
    assert language.grams("12 !? ") is None and language.grams("") is None


def test_kept_vectors_are_those_made_anew(monkeypatch):
    """However the table of kept vectors fills up and is begun again, a bundle is the sum of its own vectors."""
    monkeypatch.setattr(language, "MAX_KEPT", 40)
    monkeypatch.setattr(language, "PART", 16)
    space, fresh = language.Space(64, 3), language.Space(64, 3)
    rng = np.random.default_rng(4)
    for _ in range(30):
        texts = ["".join(rng.choice(list("abcdefg 1é"), rng.integers(1, 60))) + "a" for _ in range(3)]
        counted = [language.grams(t) for t in texts]
        want = [n @ fresh._bind(k).astype(np.int64) for k, n in counted]
        assert (space.bundle(counted) == want).all()
        assert all((space.total(*c) == w).all() for c, w in zip(counted, want, strict=True))


def test_a_worker_keeps_one_cache():
    from seqspark.llm.common import _kept, worker_cache

    first = worker_cache(("one",), dict)
    assert worker_cache(("one",), dict) is first
    language.space(64, 3)
    assert list(_kept) == [("space", 64, 3)] and worker_cache(("one",), dict) is not first


def test_permutation_tells_order():
    space = language.Space(2048, 1)
    a, b = (space.bundle([language.grams(t)])[0] for t in ("abcabcabc", "cbacbacba"))
    assert a @ b < 0.5 * np.linalg.norm(a) * np.linalg.norm(b)


def test_languages_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = {r.doc_id: r for r in language.identify_languages(docs).collect()}
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    assert len(found) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) and 0 <= r.score <= 1 for i, r in found.items())
    held = [i for i, r in found.items() if r.held_out]
    assert np.mean([found[i].lang_pred == truth[i] for i in held]) > 0.97


def test_languages_odd_rows(docs_of, odd_rows):
    docs = docs_of(odd_rows)
    docs = docs.withColumn("score", docs["doc_id"]).withColumn("held_out", docs["doc_id"])
    found = language.identify_languages(docs).collect()
    assert len(found) == len(odd_rows)
    assert {r.doc_id for r in found if r.lang_pred == "und"} == {1, 2, 3, 9}
    assert all(r.score == 0 for r in found if r.lang_pred == "und")
    assert language.identify_languages(docs_of([])).count() == 0
    none = docs_of([(1, "text", None, "s"), (3, "text", None, "s")])
    assert {(r.lang_pred, r.score) for r in language.identify_languages(none).collect()} == {("und", 0.0)}
    kept = language.drop_unknown_language(docs)
    assert kept.columns == docs.columns and {1, 2, 3, 9}.isdisjoint(r.doc_id for r in kept.collect()) and kept.count() == 8


def test_stage_rejects_by_language_and_score(spark):
    """Foreign and random texts go although they have letters; clean texts, held out or not, stay."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rng = np.random.default_rng(6)
    foreign = ["".join(rng.choice(list(letters), 3000)) for letters in ("абвгдежзиклмнопрсту ", "qxzjkvw0 ", "日本語テキストこれは ")]
    more = [(10**6 + n, t, None, "s", len(t)) for n, t in enumerate(foreign)]
    kept = {r.doc_id for r in language.drop_unknown_language(docs.unionByName(spark.createDataFrame(more, docs.schema))).select("doc_id").collect()}
    assert kept.isdisjoint(range(10**6, 10**6 + 3))
    assert kept == {r.doc_id for r in docs.collect() if r.text is not None and language.grams(r.text) is not None}


def test_stage_without_languages_keeps_texts(docs_of):
    rows = [(1, "a clean text", None, "s"), (2, None, None, "s"), (3, "12 !?", None, "s"), (None, "text", None, "s"), (None, "!", None, "s"), (4, "", None, "s")]
    assert {(r.doc_id, r.text) for r in language.drop_unknown_language(docs_of(rows)).collect()} == {(1, "a clean text"), (None, "text")}
    rows = [(1, "a clean text"), (1, "!!!"), (None, "???")]
    assert [(r.doc_id, r.text) for r in language.drop_unknown_language(docs_of(rows)).collect()] == [(1, "a clean text")]


def test_gradients():
    network = toxicity.Network(["a", "b"], 1)
    network.p = {k: v.astype(np.float64) + 0.1 * np.random.default_rng(3).normal(size=v.shape) for k, v in network.p.items()}
    words = toxicity.Words(["a", "b", "idiot", "zz"], network.vocabulary)
    rows = np.full((3, toxicity.WINDOW), -1)
    rows[0, :5], rows[1] = [0, 1, 2, 3, 0], np.arange(toxicity.WINDOW) % 4
    target, weights = np.array([1.0, 0, 1]), np.array([0.5, 0.3, 0.2])

    def loss():
        p = 1 / (1 + np.exp(-network.run(network.projected(network.inputs(words)), rows).astype(float)))
        return -(weights * (target * np.log(p) + (1 - target) * np.log(1 - p))).sum()

    for name, gradient in network.gradients(words, rows, target, weights).items():
        at = np.unravel_index(np.abs(gradient).argmax(), gradient.shape)
        kept = network.p[name][at]
        network.p[name][at] = kept + 1e-2
        up = loss()
        network.p[name][at] = kept - 1e-2
        down = loss()
        network.p[name][at] = kept
        assert abs((up - down) / 2e-2 - gradient[at]) < 1e-3


def test_windows_cover_all_words():
    for n in (0, 1, 31, 32, 33, 100, 1000):
        rows, _ = toxicity.windows_of(np.arange(n))
        assert set(rows[rows >= 0].tolist()) == set(range(n)) and rows.shape[1] == toxicity.WINDOW


def test_toxicity_learns(spark, docs_of):
    rng = np.random.default_rng(4)
    rows, labels = [], []
    for i in range(300):
        words = [f"w{x}" for x in rng.integers(0, 300, rng.integers(20, 200))]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(3):
                words[rng.integers(len(words))] = rng.choice(["vile", "nasty", "vilest"])
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    table = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    found = toxicity.score_toxicity(docs_of([*rows, (1000, None), (1001, ""), (None, "vile")]), table).collect()
    held = [r for r in found if r.held_out and r.doc_id is not None and r.doc_id < 300]
    assert len(found) == 303 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in found)
    assert np.mean([r.predicted == (r.doc_id % 4 == 0) for r in held]) > 0.9


def test_toxicity_without_labels(spark, docs_of):
    none = spark.createDataFrame([(1, None, None)], "doc_id bigint, quality int, toxic int")
    assert {r.score for r in toxicity.score_toxicity(docs_of([(1, "a b"), (2, None)]), none).collect()} == {0.0}
    one = spark.createDataFrame([(2, 1, 1)], "doc_id bigint, quality int, toxic int")
    assert toxicity.score_toxicity(docs_of([]), one).count() == 0
