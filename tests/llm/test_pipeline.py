"""The pipeline's stages, one after the other and as a whole."""

import hashlib
from collections import Counter

from llm.conftest import ODD
from tokenizers import Tokenizer

import corpus_pipeline
from tillmart.llm.queries import VOCABULARY


def staged(spark, docs, folder, name):
    return dict(corpus_pipeline.STAGES)[name](spark, docs, folder)


def test_stages_keep_the_columns_and_do_their_work(spark, folder, documents):
    docs = documents
    seen = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, stage(spark, docs, folder).cache()
        assert docs.columns == documents.columns
        seen[name] = (before, docs)
        assert docs.exceptAll(before).count() == 0 or name == "mixing"
        assert docs.distinct().join(before, "doc_id", "left_anti").count() == 0
    kept = [r["text"] for r in seen["exact_dedup"][1].collect()]
    assert len(kept) == len(set(kept)) == len({r["text"] for r in seen["exact_dedup"][0].collect()})
    mixed = seen["mixing"]
    words = Counter()
    for r in mixed[1].collect():
        words[r["doc_id"]] += 1
    assert max(words.values()) <= 3


def test_run_equals_the_library_on_what_is_left(spark, folder, documents):
    library = Tokenizer.from_file(VOCABULARY)
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    rows = corpus_pipeline.run(spark, folder).collect()
    assert rows
    for r in rows:
        ids = library.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()


def test_the_last_stage_returns_the_encoded_corpus(spark, docs, folder):
    library = Tokenizer.from_file(VOCABULARY)
    rows = staged(spark, docs(ODD), folder, "tokens").orderBy("doc_id").collect()
    texts = {r[0]: r[1] for r in ODD if r[0] is not None}
    assert len(rows) == len(ODD)
    for r in rows:
        assert r["n_tokens"] == len(r["ids"])
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, r["ids"])).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(r["decoded"].encode()).hexdigest()
        if r["doc_id"] is not None:
            assert r["ids"] == library.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids
            assert r["decoded"] == library.decode(r["ids"], skip_special_tokens=False)


def test_every_stage_takes_odd_and_empty_tables(spark, docs, folder):
    odd = docs(ODD, clashing=True)
    for name, _ in corpus_pipeline.STAGES:
        done = staged(spark, odd, folder, name)
        assert name == "tokens" or done.columns == odd.columns
        done.collect()
        assert staged(spark, odd.limit(0), folder, name).collect() == []


def test_stages_on_odd_rows(spark, docs, folder):
    odd = docs(ODD)
    exact = [r["doc_id"] for r in staged(spark, odd, folder, "exact_dedup").collect()]
    assert sorted(str(i) for i in exact) == ["3", "4", "5", "7", "8", "9", "None", "None"]  # null ids count as one id
    near = Counter(r["doc_id"] for r in staged(spark, odd, folder, "near_dedup").collect())
    assert near[5] == 1 and near[6] == 0 and near[4] + near[9] == 1 and near[1] == near[2] == 1
    taken = Counter(r["doc_id"] for r in staged(spark, odd, folder, "mixing").collect())
    assert all(n <= 6 for n in taken.values()), taken
