"""Quality, language, tokens and the language model."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from conftest import FOLDER
from llm.conftest import ODD, SCHEMA
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tillmart.llm import bpe, brown, hashing, language, quality
from tillmart.llm.queries import VOCABULARY, registry

WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def test_word_hashes_follow_the_words():
    texts = ["A b  a", None, "", " x ", "é\x0bÉ 😀", "long" * 100_000, "b"]
    hashes, offsets = hashing.word_hashes(pa.array(texts).slice(1))
    expected = [words(t) for t in texts[1:]]
    assert np.diff(offsets).tolist() == [len(w) for w in expected]
    flat = [w for doc in expected for w in doc]
    assert len(set(flat)) == len(set(hashes.tolist()))
    assert len({(w, h) for w, h in zip(flat, hashes.tolist(), strict=True)}) == len(set(flat))


def test_quality_on_held_out_rows(spark):
    folder = FOLDER.replace("sf0.001", "sf0.01")
    scored = registry()["op1_quality"](spark, folder).where("held_out")
    rows = scored.join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").collect()
    assert sum(r["predicted"] == r["quality"] for r in rows) / len(rows) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)


def test_quality_edge_cases(spark, docs):
    labels = spark.createDataFrame([(4, 1), (4, 0), (4, None), (8, 0), (None, 1), (77, 1), (5, 7)], "doc_id bigint, quality int")
    weights = quality.train(docs(ODD, clashing=True), labels)
    df = docs(ODD, clashing=True)
    rows = quality.predict(df, weights).collect()
    assert len(rows) == len(ODD)
    assert len({r["score"] for r in rows if not words(r["text"])}) == 1
    assert quality.predict(df.limit(0), weights).collect() == []
    nothing = quality.train(df, labels.limit(0))
    assert {r["score"] for r in quality.predict(df, nothing).collect()} == {0.5}


def test_sample_holds_training_documents_only(spark, docs, monkeypatch):
    monkeypatch.setattr(quality, "SAMPLE", 30)
    df = docs([(i, "good words here" if i % 2 else "BAD !!! 123", None, None, None) for i in range(30)])
    labels = spark.range(3000).selectExpr("id AS doc_id", "int(id % 2) AS quality")
    weights = quality.train(df, labels)
    assert weights.any()
    assert np.array_equal(weights, quality.train(df, labels.where("doc_id < 30")))


def test_ftrl_learns_a_sparse_separator():
    model = quality.Ftrl(10)
    for _ in range(200):
        model.update(np.array([1]), np.array([1.0]), 1)
        model.update(np.array([2]), np.array([1.0]), 0)
    weights = model.weights()
    assert weights[1] > 1 and weights[2] < -1 and not weights[[0, *range(3, 10)]].any()


def test_language_equals_counting_by_hand(spark, documents):
    model = language.train(documents)
    rows = documents.select("text", "lang").collect()
    counts = {}
    for r in rows:
        held = counts.setdefault(r["lang"], np.zeros(language.BUCKETS + 1))
        for buckets, _ in language.char_ngrams([r["text"]]):
            held += np.bincount(buckets, minlength=language.BUCKETS + 1)
    assert model.languages == sorted(counts)
    for k, name in enumerate(model.languages):
        own = counts[name][: language.BUCKETS] + language.SMOOTHING
        np.testing.assert_allclose(model.log_prob[k, : language.BUCKETS], np.log(own / own.sum()))
    right = sum(p["lang_pred"] == p["lang"] for p in language.predict(documents, model).collect())
    assert right / len(rows) > 0.98


def test_ngrams_stay_in_their_text():
    together = [b for b, _ in language.char_ngrams(["abc", "", "d", "é😀x"])]
    apart = [[b for b, _ in language.char_ngrams([t])] for t in ("abc", "", "d", "é😀x")]
    for k, buckets in enumerate(together):
        assert buckets.tolist() == [x for t in apart for x in t[k].tolist()]


def test_language_edge_cases(docs):
    df = docs(ODD, clashing=True)
    model = language.train(df)
    rows = language.predict(df, model).collect()
    assert len(rows) == len(ODD) and set(model.languages) == {"en", "es", "fr"}
    for r in rows:
        assert (r["lang_pred"] == "und") == (not language.has_letter(r["text"]))
        assert 0 <= r["score"] <= 1
    empty = language.train(df.limit(0))
    assert {r["lang_pred"] for r in language.predict(df, empty).collect()} == {"und"}
    assert language.predict(df.limit(0), model).collect() == []


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(VOCABULARY)


def test_many_languages_are_scored_in_passes(docs, documents, monkeypatch):
    """As many passes as it takes, the same predictions and probabilities."""
    rows = documents.select("doc_id", "text", F.concat_ws("-", "lang", (F.col("doc_id") % 3).cast("string")).alias("lang"), "source", "n_chars")
    df = rows.unionAll(docs(ODD).select(rows.columns))
    whole = {(r["doc_id"], r["text"]): r for r in language.identify(df, rows).collect()}
    monkeypatch.setattr(language, "AT_ONCE", 5)
    parts = language.identify(df, rows).collect()
    assert len({r["lang"] for r in rows.collect()}) > 10 and len(parts) == df.count()
    for r in parts:
        same = whole[r["doc_id"], r["text"]]
        assert r["lang_pred"] == same["lang_pred"] and r["score"] == pytest.approx(same["score"], abs=1e-9)


def test_quality_sample_bounds_repeated_ids(spark, docs, monkeypatch):
    monkeypatch.setattr(quality, "SAMPLE", 10)
    rows = [(5, f"text {i % 40}", "en", "s", None) for i in range(2000)] + [(i, "other", "en", "s", None) for i in range(100, 130)]
    labels = spark.createDataFrame([(r[0], r[0] % 2) for r in rows], "doc_id long, quality int")
    found = quality.training_rows(docs(rows, clashing=True), labels).collect()
    assert len(found) == 10 and len({(r["doc_id"], r["text"]) for r in found}) == 10


def test_quality_equals_plain_ftrl(spark, docs, monkeypatch):
    """The trained weights against the update written term by term over a dictionary, per shard, then averaged."""
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choices(["good", "Fine", "bad", "spam", "12", "click!"], k=rng.randint(0, 9))), "en", "s", None) for i in range(60)]
    labels = spark.createDataFrame([(r[0], int("spam" not in r[1])) for r in rows], "doc_id long, quality int")
    weights = quality.train(docs(rows), labels)
    shards = quality.training_rows(docs(rows), labels).selectExpr("*", f"pmod(xxhash64(turn, own), {quality.SHARDS}) AS shard").collect()
    total = Counter()
    for k in {r["shard"] for r in shards}:
        own = sorted((r for r in shards if r["shard"] == k), key=lambda r: (r["turn"], r["doc_id"], r["own"]))
        z, n = Counter(), Counter()

        def weight(i):
            free = abs(z[i]) - quality.L1  # noqa: B023
            return -math.copysign(free, z[i]) / ((quality.BETA + math.sqrt(n[i])) / quality.ALPHA + quality.L2) if free > 0 else 0.0  # noqa: B023

        for _ in range(quality.EPOCHS):
            for r in own:
                grams = quality.features(pa.array([r["text"]]))[0].tolist()
                x = {i: c * quality.SCALE / max(1, len(grams)) for i, c in Counter(grams).items()} | {"bias": 1.0}
                w = {i: weight(i) for i in x}
                error = 1 / (1 + math.exp(-sum(w[i] * v for i, v in x.items()))) - r["label"]
                for i, v in x.items():
                    g = error * v
                    z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / quality.ALPHA * w[i]
                    n[i] += g * g
        for i in z:
            total[i] += weight(i) * len(own) / len(shards)
    bias = total.pop("bias")
    assert weights[-1] == pytest.approx(bias, abs=1e-5)
    assert np.flatnonzero(weights[:-1]).tolist() == sorted(i for i, w in total.items() if w)
    assert all(weights[i] == pytest.approx(w, abs=1e-5) for i, w in total.items())


def test_kept_words_are_bounded_by_bytes(library, monkeypatch):
    """Ids don't depend on what is kept; what is kept stays below the bound."""
    monkeypatch.setattr(bpe, "KEPT_BYTES", 4000)
    encoder = bpe.Encoder(bpe.parsed(bpe.read(VOCABULARY)))
    texts = [f"word{i} and {'x' * i} again word{i % 7} {'Ünïcode ' * (i % 5)}" for i in range(300)]
    for start in range(0, len(texts), 16):
        part = texts[start : start + 16]
        ids, offsets = encoder(pa.array(part))
        assert [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:], strict=True)] == [library.encode(t, add_special_tokens=False).ids for t in part]
        assert encoder.held <= 4000 and encoder.held >= sum(map(len, encoder.seen)) + 4 * len(encoder.flat)


def test_batches_are_cut_by_bytes():
    texts = ["a" * n for n in (1, 5000, 10, 10, 9000, 0, 1, 1, 3000)] * 20
    parts = list(hashing.pieces(pa.RecordBatch.from_arrays([pa.array(texts)], names=["t"]), 10_000))
    assert [t for p in parts for t in p.column(0).to_pylist()] == texts
    assert all(p.nbytes <= 10_000 or p.num_rows == 1 for p in parts) and len(parts) < 90


def test_tokens_equal_the_library(spark, documents, library):
    got = {r["doc_id"]: r for r in bpe.digests(documents, VOCABULARY).collect()}
    for r in documents.collect():
        ids = library.encode(r["text"], add_special_tokens=False).ids
        own = got[r["doc_id"]]
        assert own["n_tokens"] == len(ids)
        assert own["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert own["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_odd_texts_equal_the_library(docs, library):
    texts = [r[1] for r in ODD] + ["<|endoftext|>", "a<|startoftext|>b <|ENDOFTEXT|>", "ΑΣ Σας İ ǅ ﬁ é", "it's I'LL 12½ ²", "\x85\xa0　x", "z" * 3000, "~" * 2500]
    df = docs([(i, t, None, None, None) for i, t in enumerate(texts)], clashing=True)
    encoded = bpe.decode(bpe.encode(df, VOCABULARY), VOCABULARY).orderBy("doc_id").collect()
    for text, row in zip(texts, encoded, strict=True):
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert row["ids"] == ids and row["n_tokens"] == len(ids)
        assert row["decoded"] == library.decode(ids, skip_special_tokens=False)
    assert bpe.digests(df.limit(0), VOCABULARY).collect() == []


def test_sentinel_stays_above_all_ranks_in_long_words():
    model = bpe.parsed(bpe.read(VOCABULARY))
    assert len(model.merged) <= bpe._NONE
    for width in (2, 1 << 23, 1 << 31):  # 2**23: words above 4 MiB
        assert int(bpe._NONE) * width + width < 2**63


def test_segment_tree_merges_like_a_plain_scan():
    model = bpe.parsed(bpe.read(public_tokenizers.path("word_bpe_49k.json")))
    ranks = dict(zip(model.keys.tolist(), model.ranks.tolist(), strict=True))
    rng = np.random.default_rng(5)
    for word in ["".join(rng.choice(list("aeinorst"), rng.integers(1, 70))) for _ in range(300)]:
        raw = word.encode()
        symbols = [*model.inner[list(raw[:-1])].tolist(), int(model.final[raw[-1]])]
        while len(symbols) > 1:
            best = min((ranks.get(a << 20 | b, 1 << 40), i) for i, (a, b) in enumerate(zip(symbols, symbols[1:], strict=False)))
            if best[0] == 1 << 40:
                break
            symbols[best[1] : best[1] + 2] = [int(model.merged[best[0]])]
        assert model.encode_words([word])[0].tolist() == symbols


def test_model_base_scores_equal_counting_by_hand(spark, folder, documents):
    rows = {r["doc_id"]: r for r in registry()["op4_lm"](spark, folder).collect()}
    tokens = {r["doc_id"]: [*words(r["text"]), None] for r in documents.collect()}
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i in tokens}
    counts = Counter(t for i, ts in tokens.items() if not held[i] for t in ts)
    n, v = sum(counts.values()), len(counts)
    for i, ts in tokens.items():
        r = rows[i]
        assert (r["held_out"], r["n_tokens"], r["train_tokens"]) == (held[i], len(ts), n)
        assert r["n_known"] == sum(counts[t] > 0 for t in ts)
        assert math.isclose(r["base_score"], sum(math.log10((counts[t] + 0.5) / (n + 0.5 * (v + 1))) for t in ts), rel_tol=1e-9)
    better = [i for i in tokens if held[i]]
    assert sum(rows[i]["score"] for i in better) > sum(rows[i]["base_score"] for i in better)


def test_model_does_not_depend_on_shards(documents, workspace, spark, monkeypatch):
    from tillmart.workspace import Workspace

    docs = documents.select("doc_id", "text", (F.col("doc_id") % 3 != 0).alias("train"))
    one = {r["doc_id"]: r for r in brown.score(docs, workspace).collect()}
    monkeypatch.setattr(brown, "SHARD_ENTRIES", 2000)
    many = {r["doc_id"]: r for r in brown.score(docs.repartition(5), Workspace(spark)).collect()}
    for i, r in one.items():
        assert math.isclose(r["base_score"], many[i]["base_score"], rel_tol=1e-9)
        assert math.isclose(r["score"], many[i]["score"], rel_tol=1e-9)


def test_exchange_finds_two_kinds_of_words():
    n = 12
    bigrams = np.zeros((n, n))
    for i in range(n - 1):
        for j in range(n - 1):
            bigrams[i, j] = 50.0 if i % 2 != j % 2 else 0.0  # kinds alternate
    classes = brown.exchange(bigrams, n - 1)
    assert classes[n - 1] == brown.END_CLASS
    assert not set(classes[0 : n - 1 : 2]) & set(classes[1 : n - 1 : 2])


def test_rare_words_are_exchanged_too(docs, workspace, monkeypatch):
    """Words whose neighbours are outside the core as well get the class of their kind."""
    monkeypatch.setattr(brown, "CORE", 2)
    rng = np.random.default_rng(4)
    kinds = [[f"{k}{i}" for i in range(30)] for k in "abcd"]
    rows = []
    for i in range(300):
        words = [w for _ in range(10) for w in (rng.choice(kinds[0]), rng.choice(kinds[1]), rng.choice(kinds[2]), rng.choice(kinds[3]))]
        rows.append((i, " ".join(words), None, None, None))
    df = docs(rows).select("doc_id", "text", (F.col("doc_id") % 5 != 0).alias("train"))

    def held_out():
        found = brown.score(df, workspace).where("NOT train")
        return found.agg(F.sum("score") / F.sum("n_tokens")).first()[0]

    after = held_out()
    monkeypatch.setattr(brown, "sweeps", lambda blocks, replies, *rest: replies)
    assert after > held_out() + 0.05


def test_model_edge_cases(docs, spark):
    from tillmart.workspace import Workspace

    df = docs(ODD, clashing=True).withColumn("train", F.col("doc_id").isNotNull())
    rows = brown.score(df, Workspace(spark)).collect()
    assert len(rows) == len(ODD)
    assert sorted(r["n_tokens"] for r in rows) == sorted(len(words(r[1])) + 1 for r in ODD)
    untrained = brown.score(df.withColumn("train", F.lit(False)), Workspace(spark)).collect()
    assert {r["n_known"] for r in untrained} == {0} and {r["base_score"] for r in untrained} == {0.0}
    assert brown.score(spark.createDataFrame([], SCHEMA).withColumn("train", F.lit(True)), Workspace(spark)).collect() == []
