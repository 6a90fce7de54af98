"""Manifest, conversations and toxicity against brute force, and their edge cases."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from llm.conftest import ODD
from pyspark.sql import functions as F

from tillmart.llm import factors, merkle, turns
from tillmart.llm.queries import damaged

# --- Merkle manifest ----------------------------------------------------------------------

COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def encoded(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def levels(nodes, arity):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha(*out[-1][i : i + arity]) for i in range(0, len(out[-1]), arity)])
    return out


def path(tree, at, arity):
    out = []
    for nodes in tree[:-1]:
        run = at // arity * arity
        out.append(("".join(nodes[run:at]), "".join(nodes[at + 1 : run + arity])))
        at //= arity
    return out


def expected_proofs(rows, arity):
    leaf = [sha(*[encoded(r[c]) for c in COLUMNS]) for r in rows]
    keys = sorted({r["lang"] for r in rows}, key=lambda k: (k is not None, (k or "").encode()))
    first = lambda i: (rows[i]["doc_id"] is not None, rows[i]["doc_id"] or 0, leaf[i])
    members = {k: sorted((i for i, r in enumerate(rows) if r["lang"] == k), key=first) for k in keys}
    trees = {k: levels([leaf[i] for i in members[k]], arity) for k in keys}
    top = levels([trees[k][-1][0] for k in keys], arity)
    out = []
    for n, k in enumerate(keys):
        for at, i in enumerate(members[k]):
            steps = path(trees[k], at, arity) + path(top, n, arity)
            out.append((rows[i]["doc_id"], leaf[i], trees[k][-1][0], top[-1][0], steps))
    return out


def found_proofs(df, workspace, arity, every, wanted=None):
    rows = df.select("doc_id", "lang", merkle.digest(merkle.encoded(*COLUMNS)).alias("leaf"))
    manifest = merkle.build(rows, workspace, "lang", ["doc_id"], arity=arity, every=every)
    chosen = wanted(manifest) if wanted else None
    found = merkle.proofs(manifest, workspace, chosen)
    folded = found.withColumn("folded", merkle.fold("leaf")).collect()
    assert all(r["folded"] == r["root"] == manifest.root for r in folded)
    return manifest, [(r["doc_id"], r["leaf"], r["subroot"], r["root"], [tuple(s) for s in r["path"]]) for r in folded]


def ordered(rows):
    return sorted(rows, key=repr)


@pytest.mark.parametrize(("arity", "every"), [(2, 3), (3, 2), (2, 8)])
def test_manifest_equals_whole_trees(documents, workspace, arity, every):
    _, found = found_proofs(documents, workspace, arity, every)
    assert ordered(found) == ordered(expected_proofs(documents.collect(), arity))


def test_manifest_of_odd_rows(docs, workspace):
    df = docs(ODD, clashing=True)
    _, found = found_proofs(df, workspace, 2, 1)
    assert ordered(found) == ordered(expected_proofs(df.collect(), 2))


def test_only_every_few_levels_are_stored(docs, workspace):
    rows = [(i, f"text {i}", "en" if i % 10 else None, "s", i) for i in range(300)]
    manifest, _ = found_proofs(docs(rows), workspace, 2, 4)
    sizes = [level.count() for level in manifest.levels]
    assert sizes == [300, 17 + 2, 2 + 1, 2] or sizes == [300, 17 + 2, 3]
    assert merkle.build(docs(rows[:1]).withColumn("leaf", F.lit("x")), workspace, "lang", ["doc_id"]).root == "x"


def test_proofs_of_some_rows(docs, workspace):
    rows = [(i, f"text {i}", "en", "s", i) for i in range(100)]
    some = lambda m: m.leaves.where("doc_id IN (3, 64, 99)").select("tree", "place")
    _, found = found_proofs(docs(rows), workspace, 2, 2, some)
    assert ordered(found) == ordered([x for x in expected_proofs(docs(rows).collect(), 2) if x[0] in (3, 64, 99)])


def test_manifest_tells_changes(docs, workspace):
    rows = [(i, "t", "en", "s", None if i % 3 == 0 else i) for i in range(40)]
    changed = F.col("doc_id") % 2 == 0
    found = merkle.audit(docs(rows), workspace, COLUMNS, {"n_chars": F.col("n_chars") + 1}, changed).collect()
    assert {r["doc_id"] for r in found if not r["verified"]} == {i for i in range(40) if i % 2 == 0 and i % 3}
    assert merkle.audit(docs(rows).limit(0), workspace, COLUMNS, {}, changed).collect() == []


# --- conversations ------------------------------------------------------------------------

SPACE = " \t\n\x0b\x0c\r"


def least(codes, start=0, ends=(0, 3)):
    """Cost and audit by trying row after row, all states, insertions in between."""

    def with_inserts(labels):
        for _ in range(4):
            for s in list(labels):
                found = (labels[s][0] + 5, labels[s][1] + "I")
                labels[turns.NEXT[s]] = min(labels.get(turns.NEXT[s], found), found)
        return labels

    labels = with_inserts({start: (0, "")})
    for code in codes:
        new = {}
        for letter, price, s, t in turns.row_edges(code):
            if s in labels:
                found = (labels[s][0] + price, labels[s][1] + letter)
                new[t] = min(new.get(t, found), found)
        labels = with_inserts(new)
    return min((labels[t] for t in ends if t in labels), default=None)


def repaired(rows):
    """The contract, conversation by conversation; rows: turn, role, text."""
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    mark = lambda r, x: hashlib.md5(f"{len(r.encode())}:{r}{x}".encode()).hexdigest()
    rows.sort(key=lambda v: (v[0] is not None, v[0] or 0, v[1], mark(v[1], v[2])))
    seen, faults = set(), []
    for _, r, x in rows:
        cut = x.strip(SPACE)
        faults.append("blank" if not cut else "duplicate" if (r, x) in seen else "truncated" if cut[-1] not in ".!?" else None)
        seen.add((r, x))
    known = [r[:1] if r[:1] in ("s", "u", "a") else "x" for _, r, _ in rows]
    codes = ["d" if f in ("blank", "duplicate") else c.upper() if f else c for c, f in zip(known, faults, strict=True)]
    cost, audit = least(codes)
    out, state, k = [], 0, 0
    for letter in audit:
        if letter in "IR":
            state = turns.NEXT[state]
            out.append(f"{turns.ROLES[state]}:" + (rows[k][2] if letter == "R" else ""))
        elif letter == "K":
            state = turns.KEPT[rows[k][1][0]][state]
            out.append(f"{rows[k][1]}:{rows[k][2]}")
        k += letter != "I"
    told = [t for t, _, _ in rows if t is not None]
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
    gaps = max(told) - min(told) + 1 - len(set(told)) if told else 0
    return (gaps, *[faults.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, audit, sha("\n".join(out)))


def test_search_finds_the_least_audit():
    rng = random.Random(2)
    for n in range(4000):
        codes = "".join(rng.choices("suaxSUAXd", [2, 6, 6, 1, 1, 2, 2, 1, 2], k=rng.randint(0, 14)))
        assert turns.cheapest(codes) == least(codes)
        start, end = rng.randrange(4), rng.randrange(4)
        assert turns.cheapest(codes, start, (end,)) == least(codes, start, (end,))
        if n % 10 == 0:
            whole = turns.joined(turns.all_pairs(codes[:5]), turns.joined(turns.all_pairs(codes[5:8]), turns.all_pairs(codes[8:])))
            assert min((x["cost"], x["audit"]) for x in whole if x["start"] == 0 and x["end"] in (0, 3)) == least(codes)


CONVERSATIONS = "conv_id bigint, turn bigint, role string, text string"
ODD_TURNS = [
    (1, None, None, None), (1, None, "user", ""), (1, 3, "user", " \t"),
    (2, 0, "system", "Be kind."), (2, 1, "user", "Why?"), (2, 1, "user", "Why?"), (2, 4, "assistant", "So"), (2, 4, "tool", "x."),
    (None, 0, "user", "No id."), (None, 1, "assistant", "None.\n"), (None, None, "assistant", "É 😀!"),
    (3, 5, "", "No role."), (3, 6, "assistant", "A."), (3, 7, "assistant", "word " * 30000 + "."),
    (4, 0, "system", "Alone."), (5, -2, "User", "Capital."), (5, 9, "u", "Short."), (6, 0, "user", "Half"),
]


def check_turns(spark, workspace, rows, segment=turns.SEGMENT, fan=turns.FAN):
    df = spark.createDataFrame(rows, CONVERSATIONS).withColumn("place", F.lit("own")).withColumn("fault", F.lit("own"))
    found = turns.summary(turns.repair(df, workspace, segment, fan)).collect()
    wanted = {c: repaired([r[1:] for r in rows if r[0] == c]) for c in {r[0] for r in rows}}
    assert {r["conv_id"]: tuple(r)[1:] for r in found} == wanted and len(found) == len(wanted)


def test_odd_conversations(spark, workspace):
    check_turns(spark, workspace, ODD_TURNS)
    empty = spark.createDataFrame([], CONVERSATIONS)
    assert turns.summary(turns.repair(empty, workspace)).collect() == []


def test_long_conversations_are_solved_in_segments(spark, workspace):
    rng = random.Random(7)
    rows = [
        (c, t, rng.choices(["system", "user", "assistant", "tool"], [1, 6, 6, 1])[0], rng.choice(["Yes.", "No", "", f"Text {t}.", f"Half {t}"]))
        for c, n in ((1, 700), (2, 5), (3, 90), (4, 1), (5, 33)) for t in range(n)
    ]
    check_turns(spark, workspace, rows, segment=7, fan=3)


def test_damage_is_that_of_the_contract(spark):
    rows = [(c, t, "assistant", f"One. Two! {t}?") for c in range(30) for t in range(5)] + [(None, None, None, None)]
    found = damaged(spark.createDataFrame(rows, CONVERSATIONS)).collect()
    wanted = []
    for c, t, r, x in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        r, x = r or " ", x or " "
        if kind:
            x = "" if kind == 1 else x.translate({46: None, 33: None, 63: None}) if kind == 2 else x
            wanted += [(c, t, "user" if kind == 4 else r, x)] * (2 if kind == 3 else 1)
    assert ordered(map(tuple, found)) == ordered(wanted)


# --- toxicity -----------------------------------------------------------------------------


def test_terms_are_words_and_stems():
    one = lambda text: set(factors.terms(pa.array([text], pa.large_string()))[0].tolist())
    assert one("Idiot!") == one("idiot") == one(" IDIOT,idiot\n")
    assert len(one("idiotic") & one("idiots")) == 2  # both stems
    assert len(one("a b c d")) == 12 and one("") == one(" !?, ") == one(None) == set()
    buckets, offsets = factors.terms(pa.array(["b a", None, "a b b"], pa.string()))
    assert offsets.tolist() == [0, 6, 6, 12] and buckets[:6].tolist() == buckets[6:].tolist()


def test_scores_equal_all_pairs():
    rng = np.random.default_rng(1)
    model = factors.Model(0.3, rng.normal(0, 1, factors.BUCKETS).astype(np.float32), rng.normal(0, 1, (factors.FACTORS, factors.BUCKETS)).astype(np.float32))
    buckets, offsets = factors.terms(pa.array(["some words of a text", "", "b"]))
    for text, (low, high) in enumerate(zip(offsets[:-1], offsets[1:], strict=True)):
        own = buckets[low:high]
        x = max(1, len(own)) ** factors.FALL
        z = 0.3 + x * sum(float(model.weights[i]) for i in own)
        z += sum(x * x * float(model.factors[:, i].astype(float) @ model.factors[:, j]) for k, i in enumerate(own) for j in own[k + 1 :])
        assert model.scores(buckets, offsets)[text] == pytest.approx(1 / (1 + np.exp(-z)), abs=1e-9)


def test_gradients_are_those_of_the_loss():
    """A step of the factors goes against the numerical slope of the loss."""
    learner = factors.Learner()
    at = np.array([3, 70, 900])
    learner.v[at] = np.random.default_rng(2).normal(0, 0.5, (3, factors.FACTORS))

    def loss():
        return -np.log(learner.model().scores(at, np.array([0, 3])))[0]

    before, slopes = loss(), np.zeros((3, factors.FACTORS))
    held = learner.v.copy()
    for k, i in enumerate(at):
        for f in range(factors.FACTORS):
            learner.v[i, f] += 1e-3
            slopes[k, f] = (loss() - before) / 1e-3
            learner.v[:] = held
    learner.update(at, 1)
    step = held[at] - learner.v[at]
    slopes += factors.SHRINK * held[at]
    assert np.allclose(step, factors.RATE * slopes / np.sqrt(1 + slopes**2), rtol=0.05, atol=1e-4)


def test_learns_what_no_single_term_tells(docs, workspace):
    """Toxic is an insult beside a group, either alone is not: weights that only add up can't tell."""
    rng = random.Random(4)
    words = ["".join(rng.choices("bcdfgh", k=6)) for _ in range(60)]
    rows, labels = [], []
    for i in range(1600):
        insult, group = i % 2, i // 2 % 2
        text = rng.sample(words, 6) + ["insultum"] * insult + ["peopleus"] * group
        rng.shuffle(text)
        rows.append((i, " ".join(text), "en", "s", None))
        labels.append((i, 1, int(insult and group)))
    spark = workspace.spark
    df, marks = docs(rows), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    model = factors.train(df.where("doc_id < 1200"), marks, workspace)
    found = factors.predict(df.where("doc_id >= 1200"), model).collect()
    right = sum(r["predicted"] == labels[r["doc_id"]][2] for r in found)
    assert right >= 0.97 * len(found)


def test_shards_tell_only_what_moved():
    """A shard sends the buckets that its rows met, and every number moves by the mean over the shards that moved it."""
    start = factors.Learner()
    shards = [factors.Learner(start.state()) for _ in range(3)]
    for learner, own in zip(shards, ([3, 5], [5, 8], [])):
        learner.update(np.array(own, int), 1)
    told = [learner.moved(start) for learner in shards]
    assert max(sum(map(len, t)) for t in told) < 300
    mixed = factors.Learner(start.state())
    mixed.mix(told)
    z, v = [s.z - start.z for s in shards], [s.v - start.v for s in shards]
    assert np.allclose(mixed.z[[3, 8]] - start.z[[3, 8]], [z[0][3], z[1][8]]) and np.isclose(mixed.z[5], (z[0][5] + z[1][5]) / 2)
    assert np.isclose(mixed.z[-1], sum(x[-1] for x in z) / 3)
    assert np.allclose(mixed.v[5] - start.v[5], (v[0][5] + v[1][5]) / 2, atol=1e-6) and np.allclose(mixed.v[8] - start.v[8], v[1][8], atol=1e-6)
    rest = np.setdiff1d(np.arange(factors.BUCKETS), [3, 5, 8])
    assert not mixed.z[rest].any() and np.allclose(mixed.v[rest], start.v[rest])


def test_toxicity_on_held_out_rows(spark, documents, folder, workspace):
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    model = factors.train(documents, labels, workspace)
    scored = factors.predict(documents, model).join(labels, "doc_id").collect()
    worst = min((r["score"] for r in scored if r["toxic"] == 1), default=1)
    assert sum(r["score"] >= worst for r in scored if r["toxic"] == 0) <= 0.1 * len(scored)


def test_toxicity_edge_cases(spark, docs, workspace):
    df = docs(ODD, clashing=True)
    labels = spark.createDataFrame([(4, 1, 1), (5, 1, 0), (6, 0, 0), (6, 0, 1), (7, None, 7), (None, 1, 1), (99, 1, 1)], "doc_id long, quality int, toxic int")
    found = factors.predict(df, factors.train(df, labels, workspace)).collect()
    assert len(found) == len(ODD) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in found)
    alone = {r["score"] for r in found if not (r["text"] or "").strip()}
    assert len(alone) == 1
    empty = factors.train(df.limit(0), labels, workspace)
    assert {r["score"] for r in factors.predict(df, empty).collect()} == {0.5}
    assert factors.predict(df.limit(0), empty).collect() == []


def test_sample_is_a_bound_of_rows(spark, docs, workspace, monkeypatch):
    monkeypatch.setattr(factors, "SAMPLE", 10)
    rows = [(5, f"text {i % 40}", "en", "s", None) for i in range(400)] + [(i, "other", "en", "s", None) for i in range(100, 130)]
    labels = spark.createDataFrame([(r[0], 1, r[0] % 2) for r in rows], "doc_id long, quality int, toxic int")
    factors.train(docs(rows), labels, workspace)
    assert workspace.rows["terms"] == 10
