"""Dedup, archives, mixing, fingerprints and lines."""

import base64
import hashlib
import itertools
import random
import re
from collections import Counter, defaultdict

import pytest
import xxhash
from llm.conftest import LONG, ODD
from pyspark.sql import functions as F

from tillmart.llm import exact, lines, minhash, mixing, spots, warc
from tillmart.llm.queries import registry
from tillmart.workspace import Workspace

SPACE = " \t\n\x0b\x0c\r"
WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def prose(rng, n):
    return " ".join("".join(rng.choices("abcdefghij", k=rng.randint(2, 7))) for _ in range(n))


def edited(rng, text, n):
    parts = text.split(" ")
    for _ in range(n):
        parts[rng.randrange(len(parts))] = "".join(rng.choices("klmnop", k=5))
    return " ".join(parts)


# --- exact dedup --------------------------------------------------------------------------


def normal(text):
    return re.sub("[\x20\x09-\x0d]", "", text or "")


def test_exact_edge_cases(docs, workspace):
    rows = exact.groups(docs([*ODD, (20, "o n e", None, None, None)], clashing=True), workspace).collect()
    assert len(rows) == len(ODD) + 1
    sizes = Counter(normal(r[1]) for r in [*ODD, (20, "o n e")])
    by_text = {hashlib.sha256(k.encode()).hexdigest(): n for k, n in sizes.items()}
    assert all(r["group_size"] == by_text[r["text_sha256"]] for r in rows)
    kept = {r["doc_id"]: (r["keep_id"], r["kept"]) for r in rows if r["doc_id"] is not None}
    assert kept[4] == (20, False) and kept[20] == (20, True)  # more code points
    assert kept[1] == kept[2] == (3, False) and kept[3] == (3, True)
    assert kept[5] == (5, True) and kept[6] == (5, False)
    assert exact.groups(docs(ODD).limit(0), Workspace(docs(ODD).sparkSession)).collect() == []


def test_index_inserts_finds_deletes_and_grows():
    index = exact.CuckooIndex(buckets=2)
    keys = [hashlib.sha256(str(i).encode()).digest() for i in range(3000)]
    for i, key in enumerate(keys):
        index.insert(key, 1, i % 7, i)
    assert index.mask > 255 and index.size == 3000
    assert all(index.find(k)[3] == i for i, k in enumerate(keys))
    for key in keys[::2]:
        assert index.delete(key) and not index.delete(key)
    assert [index.find(k) is None for k in keys] == [True, False] * 1500
    index.insert(keys[1], 2, 9, 0)
    assert index.find(keys[1])[1:4] == [3, 9, 0] and index.size == 1500
    assert not index.contains(b"\x00" * 32) or index.find(b"\x00" * 32) is None


def test_index_follows_deletions(docs, documents):
    keyed = exact.with_keys(documents.select("doc_id", "text"))
    content = exact.build(keyed, documents.count())
    gone = keyed.where("doc_id % 2 = 0").select("key")
    left = exact.remove(content, gone, documents.count())
    wanted = {bytes(r[0]) for r in keyed.select("key").collect()} - {bytes(r[0]) for r in gone.collect()}
    assert {bytes(r["key"]) for r in left.collect()} == wanted


# --- near dedup ---------------------------------------------------------------------------


def shingles(text):
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def components(texts):
    """Smallest id reachable over links of similarity 0.75, by comparing all pairs."""
    sets = {i: shingles(t) for i, t in texts.items()}
    label = {i: i for i in sets}

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for a, b in itertools.combinations(sets, 2):
        same = len(sets[a] & sets[b])
        if same and 100 * same >= 75 * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)))
            label[y] = x
    return {i: find(i) for i in sets}, sets


def check_near(df):
    rows = df.select("doc_id", "text").collect()
    wanted, sets = components({r["doc_id"]: r["text"] for r in rows})
    found = minhash.groups(df, Workspace(df.sparkSession)).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == wanted
    assert all(r["n_shingles"] == len(sets[r["doc_id"]]) for r in found)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found)


def test_near_groups_equal_all_pairs(documents):
    check_near(documents)


def test_chains_and_crowds_of_near_copies(docs):
    rng = random.Random(3)
    base = prose(rng, 120)
    texts = [edited(rng, base, 1) for _ in range(150)]  # one crowd
    chain = prose(rng, 60)
    for _ in range(12):
        texts.append(chain)
        chain = edited(rng, chain, 1)
    passage = prose(rng, 60)
    texts += [prose(rng, 40) + " " + passage + " " + prose(rng, 40) for _ in range(60)]  # a passage is no copy
    texts += ["a b c", "A  b\tc", "a b c d", "", None, "x", "x"]
    rng.shuffle(texts)
    check_near(docs([(7 * i, t, "en", "s", None) for i, t in enumerate(texts)], clashing=True))


def test_pairs_in_a_crowd_below_the_threshold(docs):
    """Any two of the crowd are at 0.70 to 0.74 by their template; a few pairs share more."""
    rng = random.Random(11)
    template = prose(rng, 85)
    tails = [prose(rng, rng.randint(15, 17)) for _ in range(1500)]
    for k in range(0, 40, 2):
        shared = 3 + k % 4
        tails[k + 1] = " ".join(tails[k].split()[:shared] + tails[k + 1].split()[shared:])
    texts = [f"{template} {t}" for t in tails]
    rng.shuffle(texts)
    wanted, _ = components(dict(enumerate(texts)))
    assert 15 <= sum(i != c for i, c in wanted.items()) <= 20
    check_near(docs([(i, t, "en", "s", None) for i, t in enumerate(texts)]))


def linked_rows(rows):
    """Per row (id, text) its component and whether it is kept, by comparing all pairs of texts."""
    texts = sorted({t or "" for _, t in rows})
    sets = {t: shingles(t) for t in texts}
    label = {t: t for t in texts}

    def find(t):
        while label[t] != t:
            t = label[t]
        return t

    def join(a, b):
        a, b = sorted((find(a), find(b)))
        label[b] = a

    full = [t for t in texts if sets[t]]
    for a, b in itertools.combinations(full, 2):
        same = len(sets[a] & sets[b])
        if same and 100 * same >= 75 * len(sets[a] | sets[b]):
            join(a, b)
    first = {}
    for i, t in rows:
        if i is not None and sets[t or ""]:
            join(first.setdefault(i, t), t)
    name, keeper = {}, {}
    for i, t in rows:
        t = t or ""
        if sets[t] and i is not None:
            name[find(t)] = min(name.get(find(t), i), i)
        if sets[t]:
            keeper[find(t)] = min(keeper.get(find(t), xxh(t)), xxh(t))
    out = []
    for i, t in rows:
        t = t or ""
        if not sets[t]:
            out.append((i, 0, i, True))
        else:
            named = name.get(find(t))
            out.append((i, len(sets[t]), named, i == named if named is not None else xxh(t) == keeper[find(t)]))
    return Counter(out)


def test_links_through_rows_without_id_and_ids_with_several_texts(docs):
    rng = random.Random(21)
    rows = []
    for _ in range(40):
        text = prose(rng, 50)
        rows += [(rng.choice([None, None, *range(300)]), edited(rng, text, rng.randint(0, 3))) for _ in range(rng.randint(1, 5))]
    a, b = prose(rng, 40), prose(rng, 40)
    rows += [(500, a), (300, a), (500, b), (900, b), (None, None), (901, ""), (None, prose(rng, 3)), (None, prose(rng, 30))]
    rows += rows[::9]
    found = minhash.groups(docs([(i, t, "en", "s", None) for i, t in rows], clashing=True), Workspace(docs([]).sparkSession)).collect()
    assert Counter(tuple(r)[:4] for r in found) == linked_rows(rows)
    assert {r["component_id"] for r in found if r["doc_id"] in (500, 900)} == {300}


def test_a_chain_through_a_row_without_id(docs, workspace):
    """1 and 2 are near copies of a row without id, but not of each other."""
    rng = random.Random(1)
    text = prose(rng, 100)
    cut = text.split()
    rows = [(1, " ".join(["x"] + cut[12:])), (None, text), (2, " ".join(cut[:-12] + ["y"]))]
    found = {r["doc_id"]: (r["component_id"], r["kept"]) for r in minhash.groups(docs([(i, t, None, None, None) for i, t in rows]), workspace).collect()}
    assert not linked_rows([rows[0], rows[2]])[(2, len(shingles(rows[2][1])), 1, False)]
    assert found == {1: (1, True), None: (1, False), 2: (1, False)}


@pytest.mark.parametrize("n", [500, 1000, 2000])
def test_templates_with_slots_meet_only_where_they_agree(docs, workspace, n):
    """Four paragraphs of 30 variants each between fixed ones: texts of one crowd that hardly ever link. What
    the crowd's join makes grows with the texts, not with their pairs."""
    rng = random.Random(6)
    fixed = prose(rng, 60)
    variants = [[prose(rng, 40) for _ in range(30)] for _ in range(4)]
    texts = [" ".join([fixed, *(rng.choice(v) for v in variants)]) for _ in range(n)]
    found = minhash.groups(docs([(i, t, "en", "s", None) for i, t in enumerate(texts)]), workspace).collect()
    wanted, _ = components({i: t for i, t in enumerate(texts)}) if n <= 500 else ({}, None)
    assert all(r["component_id"] == wanted[r["doc_id"]] for r in found if wanted)
    assert workspace.rows["crowd"] > n / 2
    assert workspace.rows["pairs1"] <= 130 * n and workspace.rows["crowd_met"] <= 8 * n and workspace.rows["crowd_chunks"] <= 4 * n
    assert workspace.rows["pairs_crowd"] <= n / 10


def test_chunks_are_compared_like_all_pairs(docs, workspace, monkeypatch):
    """Copies of one text with edits of their own, many of them near the threshold, cut into many chunks."""
    monkeypatch.setattr(minhash, "CHUNK", 2000)
    rng = random.Random(12)
    base = prose(rng, 150)
    texts = [edited(rng, base, rng.randint(2, 6)) for _ in range(250)]
    check_near(docs([(i, t, "en", "s", None) for i, t in enumerate(texts)]))
    minhash.groups(docs([(i, t, "en", "s", None) for i, t in enumerate(texts)]), workspace)
    assert workspace.rows["crowd_chunks"] > 3 * workspace.rows["crowd_meetings"] > 0


def test_near_edge_cases(docs, workspace, spark):
    rows = minhash.groups(docs(ODD, clashing=True), workspace).collect()
    assert len(rows) == len(ODD)
    own = {(r["doc_id"], r["n_shingles"]): r for r in rows}
    assert own[(6, 4)]["component_id"] == 5 and not own[(6, 4)]["kept"]
    assert all(r["component_id"] == r["doc_id"] and r["kept"] for r in rows if r["n_shingles"] == 0)
    assert minhash.groups(docs(ODD).limit(0), Workspace(spark)).collect() == []


def test_chunks_are_sent_once(docs, workspace, monkeypatch):
    compared = minhash._compared

    def once(batches):
        def seen():
            for batch in batches:
                assert not any(r["members"] == r["others"] for r in batch.to_pylist())
                yield batch

        return compared(seen())

    monkeypatch.setattr(minhash, "_compared", once)
    rng = random.Random(14)
    base = prose(rng, 150)
    minhash.groups(docs([(i, edited(rng, base, rng.randint(2, 6)), "en", "s", None) for i in range(60)]), workspace)
    assert workspace.rows["crowd_chunks"] > 0


def test_texts_are_cut_by_size_and_stay_in_python(docs, workspace, monkeypatch):
    cut, most = minhash.shingle_sets, minhash.PART_BYTES

    def small(texts):
        assert len(texts) <= 1 or texts.nbytes <= most
        return cut(texts)

    monkeypatch.setattr(minhash, "shingle_sets", small)
    rng = random.Random(13)
    texts = [prose(rng, 4000) for _ in range(200)] + ["", None, "x " * most]
    texts += [edited(rng, t, 5) for t in texts[:100]]
    assert sum(len(t or "") for t in texts[:200]) > 2 * most
    df = docs([(i, t, "en", "s", None) for i, t in enumerate(texts)]).coalesce(1)
    assert minhash.with_sets(df).columns == ["doc_id", "lang", "source", "n_chars", "n_shingles", "node", "signature"]
    found = {r["doc_id"]: r["component_id"] for r in minhash.groups(df, workspace).collect()}
    assert found == {i: i - 203 if i >= 203 else i for i in range(303)}


def test_unite_follows_long_paths(spark, workspace):
    n = 300
    labels = spark.range(n).selectExpr("id AS node", "id AS label")
    links = spark.range(n - 1).selectExpr("id AS a", "id + 1 AS b").where("a % 100 != 99")
    found = minhash.unite(labels, links, workspace, "path").collect()
    assert all(r["label"] == r["node"] // 100 * 100 for r in found)


# --- archive ------------------------------------------------------------------------------

PAGES = [
    (1, "http://a/", "same"), (5, "http://b/", "same"), (3, None, "same"), (2, "u", None), (4, "u", ""),
    (6, "u\r\nEvil: x", "WARC/1.1\r\n\r\n\r\n"), (7, "u", "é😀\x00" * 40_000), (None, "u", "lost"), (8, "u", "lost"), (9, "u", "x: y"), (9, "u", "x: y"),
]


def test_archive_round_trip(spark, workspace):
    pages = spark.createDataFrame(PAGES, "page_id bigint, url string, html string").withColumn("packed", F.lit("own")).withColumn("record", F.lit(1))
    headers, payloads = warc.write(pages, workspace)
    assert payloads.count() == len({p[2] or "" for p in PAGES})
    rows = warc.read(headers, payloads).collect()
    top = defaultdict(int)
    for page, _, html in PAGES:
        top[html or ""] = max(top[html or ""], page or 0)
    texts = {p[0]: p[2] or "" for p in PAGES}
    assert sorted(str(r["page_id"]) for r in rows) == sorted(str(p[0]) for p in PAGES)
    for r in rows:
        body = texts[r["page_id"]].encode()
        response = r["page_id"] == top[texts[r["page_id"]]]
        assert r["record_type"] == ("response" if response else "revisit")
        assert r["refers_to"] == (None if response else top[texts[r["page_id"]]])
        assert r["payload_bytes"] == len(body)
        head, http, rest = bytes(r["record"]).split(b"\r\n\r\n", 2)
        assert head.startswith(b"WARC/1.1\r\n") and rest == (body if response else b"") + b"\r\n\r\n"
        assert http.startswith(b"HTTP/1.1 200 OK\r\n") and http.endswith(b"Content-Length: %d" % len(body))
        assert f"WARC-Payload-Digest: sha1:{r['payload_digest']}".encode() in head


def test_small_payloads_are_never_revisits(spark, workspace):
    pages = spark.createDataFrame(PAGES, "page_id bigint, url string, html string")
    rows = warc.read(*warc.write(pages, workspace, least=5)).collect()
    assert {r["page_id"] for r in rows if r["record_type"] == "revisit"} == set()
    assert len(rows) == len(PAGES)


def records_of(raw):
    """Records of a WARC file: version line, named fields up to an empty line, a block of Content-Length bytes,
    two line ends. Blocks of HTTP responses: status line, fields, an empty line, the body."""
    while raw:
        head, raw = raw.split(b"\r\n\r\n", 1)
        version, *lines = head.decode().split("\r\n")
        assert version == "WARC/1.1"
        fields = dict(line.split(": ", 1) for line in lines)
        length = int(fields["Content-Length"])
        block, end, raw = raw[:length], raw[length : length + 4], raw[length + 4 :]
        assert end == b"\r\n\r\n" and fields["Content-Type"] == "application/http;msgtype=response"
        http, body = block.split(b"\r\n\r\n", 1)
        status, *lines = http.decode().split("\r\n")
        assert status == "HTTP/1.1 200 OK"
        yield fields, dict(line.split(": ", 1) for line in lines), body


def test_exported_files_are_warc(spark, workspace, folder):
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    repeated = pages.unionAll(pages.limit(20).withColumn("html", F.concat("html", F.lit("<p>once more</p>")))).unionAll(pages.limit(9).withColumn("url", F.lit("x:y")))
    warc.export(warc.read(*warc.write(repeated, workspace)), workspace.path("files"))
    files = spark.read.format("binaryFile").load(workspace.path("files") + "/*.txt").collect()
    found = [r for f in files for r in records_of(bytes(f["content"]))]
    assert len(found) == repeated.count()
    ids = [f["WARC-Record-ID"] for f, _, _ in found]
    assert len(set(ids)) == len(ids) and all(re.fullmatch("<urn:uuid:[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}>", i) for i in ids)
    bodies = {f["WARC-Record-ID"]: body for f, _, body in found if f["WARC-Type"] == "response"}
    wanted = Counter((r["page_id"], r["url"], r["html"]) for r in repeated.collect())
    got = Counter()
    for fields, http, body in found:
        if fields["WARC-Type"] == "revisit":
            assert body == b"" and fields["WARC-Profile"].endswith("identical-payload-digest")
            body = bodies[fields["WARC-Refers-To"]]
        assert http["Content-Type"].startswith("text/html") and int(http["Content-Length"]) == len(body)
        assert fields["WARC-Payload-Digest"] == "sha1:" + base64.b32encode(hashlib.sha1(body).digest()).decode()
        got[int(fields["X-Page-ID"]), fields["WARC-Target-URI"], body.decode()] += 1
    assert got == wanted


def test_damage_is_found(spark, workspace):
    pages = spark.createDataFrame(PAGES[:3], "page_id bigint, url string, html string")
    headers, payloads = warc.write(pages, workspace)
    broken = payloads.withColumn("content_key", F.sha2("content_key", 256).cast("binary"))
    with pytest.raises(Exception, match="missing or damaged"):
        warc.read(headers, broken).collect()


def test_empty_archive(spark, workspace):
    pages = spark.createDataFrame([], "page_id bigint, url string, html string")
    assert warc.read(*warc.write(pages, workspace)).collect() == []


# --- mixing -------------------------------------------------------------------------------


def test_targets_stop_at_three_times_the_source(spark):
    sizes = spark.createDataFrame([("a", 100), ("b", 1), ("c", 10), (None, 5), ("d", 0)], "source string, source_size bigint")
    found = {r["source"]: r["target"] for r in mixing.targets(sizes).collect()}
    assert found == {"a": 116 - 3 - 30 - 15.0, "b": 3.0, "c": 30.0, "d": 0.0, None: 15.0}


def test_mixture_comes_near_its_targets(docs, workspace, spark, monkeypatch):
    monkeypatch.setattr(mixing, "BINS", 4)
    rng = random.Random(4)
    rows = [(i, prose(rng, rng.randint(0, 40)), "en", rng.choice(["a", "b", "c", None, "d"]), 0) for i in range(600)]
    found = mixing.mix(docs([*rows, *ODD], clashing=True), workspace).collect()
    assert len(found) == len(rows) + len(ODD)
    taken, target = Counter(), {}
    for r in found:
        assert r["taken"] == r["copies"] * r["size"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
    largest = Counter()
    for r in found:
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    assert all(abs(taken[s] - t) <= largest[s] / 2 + 1e-6 for s, t in target.items())
    again = mixing.mix(docs([*ODD, *rows[::-1]], clashing=True).repartition(3), Workspace(spark)).collect()
    assert sorted((str(r["doc_id"]), r["size"], r["taken"]) for r in found) == sorted((str(r["doc_id"]), r["size"], r["taken"]) for r in again)


def test_better_documents_are_taken_first(docs, workspace):
    rows = [(i, ("word " if i % 2 else "#### ") * 10, "en", "a" if i < 400 else "b", 0) for i in range(800)]
    found = mixing.mix(docs(rows), workspace).where("source = 'a'").collect()
    assert sum(r["copies"] for r in found if r["doc_id"] % 2) > 1.5 * sum(r["copies"] for r in found if not r["doc_id"] % 2)


def test_empty_mixture(docs, workspace):
    assert mixing.mix(docs(ODD).limit(0), workspace).collect() == []


# --- fingerprints -------------------------------------------------------------------------


ANCHORS = set(spots.ANCHORS)


def plain_spots(text):
    """Spots of a text as tuples of words, by the definition."""
    words = re.findall(r"[^\W_]+", text.lower())
    content = [w for w in words if w not in ANCHORS]
    found = {("^", *content[:2])} if len(content) > 1 else set()
    behind = run = 0  # content words before this place; of them since the last anchor
    for w in words:
        if w in ANCHORS:
            chain = content[behind : behind + spots.CHAIN]
            found |= {(w, *chain)} if chain else set()
            run = 0
        else:
            if run >= spots.RUN:
                found.add(("", content[behind - 1], w))
            behind, run = behind + 1, run + 1
    return found or ({(" ".join(words) or text,)} if text else set())


def jaccard(a, b):
    return 1.0 if not a and not b else len(a & b) / len(a | b)


def check_prints(df, rows):
    """``rows`` (id, text) against the definition, every likeness included."""
    found = spots.fingerprints(df, Workspace(df.sparkSession)).collect()
    lowest = -(2**63)
    order = sorted(rows, key=lambda r: (lowest if r[0] is None else r[0], xxh(r[1] or "")), reverse=True)
    wanted, prints = Counter(), {}
    for k, (i, text) in enumerate(order):
        text, following = text or "", order[(k + 1) % len(order)][1] or ""
        half = len(text) // 2
        edit = text[: len(text) - half] + following[:half]
        own, edited, other = map(plain_spots, (text, edit, following))
        sha = hashlib.sha256(edit.encode()).hexdigest()
        wanted[i, len(text), sha, len(own), len(edited), round(jaccard(own, edited), 9), round(jaccard(own, other), 9)] += 1
    got = Counter()
    for r in found:
        own, edited = ({p[k : k + 8] for k in range(0, len(p), 8)} for p in (r[c].split(":")[1] for c in ("fingerprint", "edited_fingerprint")))
        assert r["near_edited"] == pytest.approx(jaccard(own, edited), abs=1e-12)
        assert prints.setdefault(r["edited_sha256"], r["edited_fingerprint"]) == r["edited_fingerprint"]
        got[r["doc_id"], r["n_chars"], r["edited_sha256"], len(own), len(edited), round(r["near_edited"], 9), round(r["near_next"], 9)] += 1
    assert got == wanted
    return found


def test_fingerprints_of_documents(documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()]
    found = check_prints(documents, rows)
    assert sum(r["near_edited"] > r["near_next"] for r in found) > 0.95 * len(rows)


def test_fingerprints_of_missing_and_repeated_ids(docs, spark, workspace, monkeypatch):
    """Many rows without id or of one id, equal ones among them: their bucket is divided."""
    monkeypatch.setattr(spots, "HOT", 8)
    rng = random.Random(9)
    pool = [prose(rng, rng.randint(1, 9)) + " of the " + prose(rng, 3) for _ in range(60)]
    rows = [(rng.choice([None, None, None, 7, 7, *range(200)]), rng.choice(pool)) for _ in range(400)]
    rows += [(None, pool[0])] * 50 + [(7, None), (7, ""), (None, "")]
    check_prints(docs([(i, t, "en", "s", None) for i, t in rows], clashing=True), rows)
    placed = spots.bucketed(docs([(i, t, "en", "s", None) for i, t in rows]), workspace).groupBy("bucket", "id_part", "text_part").count()
    assert placed.agg(F.max("count")).first()[0] <= 64 and workspace.rows["hot_buckets"] >= 2


def test_likeness_from_fingerprints_and_partitions(spark):
    rng = random.Random(10)
    sets = [sorted(rng.sample(range(2**32), 40)) for _ in range(3)]
    sets += [sorted({*rng.sample(s, rng.randint(1, 40)), *rng.sample(range(2**32), rng.randint(0, 200))}) for s in sets for _ in range(8)] + [[]]
    df = spark.createDataFrame([(a, b) for a in sets for b in sets], "a array<bigint>, b array<bigint>")
    df = df.withColumns({"exact": spots.likeness("a", "b"), "least": spots.likeness("a", "b", 0.6), "x": spots.fingerprint("a"), "y": spots.fingerprint("b")})
    df = df.withColumns({"p": spots.parsed("x"), "q": spots.parsed("y")}).withColumn("again", spots.likeness("p", "q"))
    for r in df.collect():
        wanted = jaccard(set(r["a"]), set(r["b"]))
        assert r["exact"] == r["again"] == pytest.approx(wanted)
        assert r["least"] == pytest.approx(wanted if wanted >= 0.6 else 0)


@pytest.mark.parametrize("spread", [1, 63, 2**16, 2**40])
def test_next_document_over_gaps(docs, spread):
    rng = random.Random(spread)
    texts = [prose(rng, 12) for _ in range(9)] + ["", None, "😀é", "same the same", "same the same"]
    rows = [((k - 3) * spread, t) for k, t in enumerate(texts)]
    check_prints(docs([(i, t, "en", "a", 0) for i, t in rows], clashing=True), rows)


def test_spots_are_chains_after_anchors(spark):
    df = spark.createDataFrame([("Cats of the long road, and the end",)], "t string").withColumn("s", spots.spots("t"))
    chains = [("^", "cats", "long"), ("of", "long", "road"), ("the", "long", "road"), ("and", "end"), ("the", "end")]
    wanted = df.select([F.hash(*map(F.lit, c)).alias(str(k)) for k, c in enumerate(chains)]).first()
    assert df.first()["s"] == sorted(wanted)


def test_fingerprint_edge_cases(docs, workspace, spark):
    rows = spots.fingerprints(docs(ODD, clashing=True), workspace).collect()
    assert len(rows) == len(ODD)
    assert {r["fingerprint"] for r in rows if r["n_chars"] == 0} == {"0:"}
    one = spots.fingerprints(docs([(3, "one row", None, None, None)]), Workspace(spark)).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1
    assert spots.fingerprints(docs(ODD).limit(0), Workspace(spark)).collect() == []


# --- lines --------------------------------------------------------------------------------


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def mutated(rng, text, n):
    chars = list(text)
    for _ in range(n):
        k = rng.randrange(len(chars))
        kind = rng.choice(["put", "drop", "swap"])
        chars[k : k + (kind != "put")] = [] if kind == "drop" else [rng.choice("xyzé😀")]
    return "".join(chars)


def links_of(df, workspace, tau):
    found = lines.near_links(lines.with_keys(df, tau), lambda wanted: df.join(wanted, "id", "left_semi"), workspace, tau)
    return {tuple(r) for r in found.collect()}


@pytest.mark.parametrize("tau", [1, 2, 3])
def test_near_lines_equal_all_pairs(spark, tau, workspace):
    rng = random.Random(tau)
    texts = [prose(rng, rng.randint(4, 8)) for _ in range(25)]
    texts = [t for t in texts if len(t) >= lines.SHORTEST]
    texts += [mutated(rng, t, rng.randint(1, tau + 1)) for t in texts for _ in range(3)]
    texts = [t for t in dict.fromkeys(texts) if len(t) >= lines.SHORTEST]
    df = spark.createDataFrame(list(enumerate(texts)), "id bigint, line string")
    found = links_of(df, workspace, tau)
    wanted = {(i, j) for (i, a), (j, b) in itertools.combinations(enumerate(texts), 2) if distance(a, b) <= tau}
    assert found == wanted and wanted


@pytest.mark.parametrize("crowd", [0, 3, 100])
def test_crowds_are_joined_like_all_pairs(spark, workspace, monkeypatch, crowd):
    monkeypatch.setattr(lines, "CROWD", crowd)
    rng = random.Random(crowd)
    base = prose(rng, 12)
    texts = {base}
    for _ in range(120):
        texts.add(mutated(rng, rng.choice(sorted(texts)), 1))
        texts.add(edited(rng, base, 2))
    texts = [t for t in sorted(texts) if len(t) >= lines.SHORTEST] + ["0123456789abcdef", "0123456789abcdefg", "0123456789abcde!"]
    df = spark.createDataFrame(list(enumerate(texts)), "id bigint, line string")
    found = links_of(df, workspace, 1)
    wanted = {(i, j) for (i, a), (j, b) in itertools.combinations(enumerate(texts), 2) if distance(a, b) <= 1}
    assert found <= wanted and (found == wanted if crowd == 100 and len(wanted) < 50 else True)

    def classes(pairs):
        label = list(range(len(texts)))
        for _ in texts:
            for i, j in pairs:
                label[i] = label[j] = min(label[i], label[j])
        return label

    assert classes(found) == classes(wanted)


def test_banded_distance_on_short_arrays(spark):
    words = ["".join(w) for n in range(4) for w in itertools.product("ab", repeat=n)]
    df = spark.createDataFrame([(a, b) for a in words for b in words], "a string, b string")
    df = df.select("a", "b", lines.characters("a").alias("x"), lines.characters("b").alias("y"))
    for tau in (1, 2):
        for r in df.withColumn("near", lines.within("x", "y", tau)).collect():
            assert r["near"] == (distance(r["a"], r["b"]) <= tau), (r["a"], r["b"], tau)


def test_first_occurrences_stay(docs, workspace, spark):
    shared = "This line is shared by many documents."
    near = "This line is shared by many document."
    rows = [(3, f"own three is here\n  {shared} \n\nx", None, None, None), (1, f"{near}\nx\nx", None, None, None), (2, shared, None, None, None)]
    found = {r["doc_id"]: r for r in lines.report(docs([*rows, (4, None, None, None, None), (5, "\n \n", None, None, None)]), workspace).collect()}
    assert {i: (r["n_lines"], r["n_near"], r["n_dropped"]) for i, r in found.items()} == {
        1: (3, 1, 1), 2: (1, 1, 1), 3: (3, 1, 2), 4: (0, 0, 0), 5: (0, 0, 0)
    }
    cleaned = {r["doc_id"]: r["text"] for r in lines.clean(docs(rows), Workspace(spark)).collect()}
    assert cleaned == {1: f"{near}\nx", 2: "", 3: "own three is here\n"}


def cut(text):
    return [(k, line.strip(SPACE)) for k, line in enumerate((text or "").split("\n"))]


def expected_lines(rows):
    """Report and cleaned texts by comparing all pairs of lines; rows: (id, text), which may repeat."""
    distinct = sorted({line for _, t in rows for _, line in cut(t) if line})
    label = {line: line for line in distinct}

    def find(line):
        while label[line] != line:
            line = label[line]
        return line

    long = sorted((line for line in distinct if len(line) >= lines.SHORTEST), key=len)
    for i, a in enumerate(long):
        for b in itertools.takewhile(lambda x: len(x) <= len(a) + lines.TAU, long[i + 1 :]):
            if distance(a, b) <= lines.TAU:
                x, y = sorted((find(a), find(b)))
                label[y] = x
    size = Counter(find(line) for line in distinct)
    first = {}
    for i, t in rows:
        for k, line in cut(t):
            if line:
                at = (i is not None, i or 0, k, xxh(t))
                first[find(line)] = min(first.get(find(line), at), at)
    report, cleaned = Counter(), Counter()
    for (i, t), n in Counter(rows).items():
        own = [(k, line, (i is not None, i or 0, k, xxh(t)) != first[find(line)]) for k, line in cut(t) if line]
        report[i, n * len(own), n * sum(size[find(x)] > 1 for _, x, _ in own), n * sum(d for *_, d in own)] += 1
        gone = {k for k, _, d in own if d}
        cleaned[i, "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone) if gone else t] += n
    return report, cleaned


def xxh(text):
    """Spark's 64-bit hash of a text as a signed number."""
    return int.from_bytes(xxhash.xxh64(text.encode(), seed=42).digest(), "big", signed=True)


def test_rows_without_id_are_sampled(docs, workspace):
    """Rows without id draw by their texts: those taken are not the shortest, and equal ones fare alike."""
    rng = random.Random(5)
    rows = [(None, prose(rng, rng.randint(20, 200)), "en", s, None) for s in "abt" for _ in range(300)]
    rows += [(None, prose(rng, 2000), "en", "b", None) for _ in range(40)]
    found = mixing.mix(docs(rows), workspace).where("source IN ('a', 't')").collect()
    sizes = {True: [], False: []}
    for r in found:
        sizes[r["copies"] > min(x["copies"] for x in found if x["source"] == r["source"])].append(r["size"])
    assert sizes[True] and sizes[False]
    mean = {k: sum(v) / len(v) for k, v in sizes.items()}
    assert 0.8 < mean[True] / mean[False] < 1.25


def test_weights_by_name(docs, workspace, spark):
    """Of documents alike, those of a larger weight are taken more often; odd weights are the least ones."""
    rows = [(i, f"{i} word word word", "en", "a" if i % 2 else "b", None) for i in range(2000)]
    df = docs(rows).withColumn("worth", F.expr("CASE WHEN doc_id % 4 < 2 THEN 0.9 WHEN doc_id % 8 = 2 THEN NULL WHEN doc_id % 8 = 3 THEN -1.0 ELSE 0.1 END"))
    found = mixing.mix(df, workspace, weight="worth").collect()
    taken = Counter((r["doc_id"] % 4 < 2) for r in found if r["source"] == "a" and r["copies"] > 0)
    assert taken[True] > 2 * taken[False] > 0
    assert sum(r["taken"] for r in found) == pytest.approx(8000, abs=20)


def check_lines(df):
    rows = [tuple(r) for r in df.select("doc_id", "text").collect()]
    report, cleaned = expected_lines(rows)
    found = lines.report(df, Workspace(df.sparkSession)).collect()
    assert Counter((r["doc_id"], r["n_lines"], r["n_near"], r["n_dropped"]) for r in found) == report
    assert Counter((r["doc_id"], r["text"]) for r in lines.clean(df, Workspace(df.sparkSession)).collect()) == cleaned


def test_report_and_clean_equal_all_pairs(documents):
    check_lines(documents)


def test_lines_of_repeated_and_missing_ids(docs):
    """An id with several texts, many rows without id, repeated rows: no line is lost that stands nowhere else."""
    rng = random.Random(8)
    pool = [prose(rng, 6) for _ in range(30)]
    pool += [mutated(rng, line, 1) for line in pool]
    rows = [(1, "first text own opening line\n" + pool[0]), (1, pool[0] + "\nsecond text own closing line")]
    rows += [(rng.choice([None, None, 1, 2, 3, *range(10, 40)]), "\n".join(rng.choices(pool, k=rng.randint(1, 5)))) for _ in range(120)]
    rows += rows[:20] + [rows[30]] * 5
    check_lines(docs([(i, t, "en", "s", None) for i, t in rows], clashing=True))


@pytest.mark.parametrize("n", [200, 400, 800])
def test_a_shared_beginning_ends_in_the_first_step(spark, workspace, n):
    """Lines that share their beginning and nothing else: at most eight rows each, none of which goes on."""
    rng = random.Random(n)
    opening = prose(rng, 9)
    df = spark.createDataFrame([(i, f"{opening} {prose(rng, 8)}") for i in range(n)], "id bigint, line string")
    assert links_of(df, workspace, 1) == set()
    assert n <= workspace.rows["line_parts1"] <= 8 * n and workspace.rows["line_left1"] == 0


def test_short_lines_are_compared(docs, workspace):
    """Lines of every length find their near copies, those of one or two characters too, in crowds as in pairs."""
    rng = random.Random(16)
    short = ["a", "b", "ab", "cab", "yes, it is", "yes, it isn", "total: 17", "total: 18", "Chapter 1", "Chapter 12", "é😀", "é"]
    short += ["".join(rng.choices("abcdefgh", k=rng.randint(5, 12))) for _ in range(40)] + [f"page {k} of 999" for k in range(100, 160)]
    short += [mutated(rng, line, 1).strip(SPACE) or "z" for line in short[12:52]]
    found = lines.report(docs([(1, "total: 17", "en", "s", 9), (2, "total: 18", "en", "s", 9)]), workspace).collect()
    assert sorted((r["doc_id"], r["n_near"], r["n_dropped"]) for r in found) == [(1, 1, 0), (2, 1, 1)]
    check_lines(docs([(i, "\n".join(rng.choices(short, k=rng.randint(1, 4))), "en", "s", None) for i in range(150)]))


def test_the_query_takes_lines_out_of_the_texts(spark, documents, workspace, folder):
    """The text without the dropped lines is made; what the query returns of it is its digest."""
    cleaned = lines.clean(documents, workspace).select("doc_id", F.sha2("text", 256))
    found = registry()["op7_line_dedup"](spark, folder).select("doc_id", "cleaned_sha256")
    assert {tuple(r) for r in found.collect()} == {tuple(r) for r in cleaned.collect()}


def test_dedup_is_report_and_clean(docs, workspace, spark):
    """One row per id and text, also where rows repeat, ids are missing or texts are null."""
    rows = [*ODD, (None, "One\nTwo lines", "en", "c", None), (9, "Two lines", "fr", None, None), (9, "Two lines", "fr", None, None)]
    df = docs(rows, clashing=True)
    found = lines.dedup(df, workspace).collect()
    told = lines.report(df, Workspace(spark)).collect()
    names = ("doc_id", "n_lines", "n_near", "n_dropped", "kept_sha256")
    assert Counter(tuple(r[c] for c in names) for r in found) == Counter(tuple(r[c] for c in names) for r in told)
    cleaned = {(r["doc_id"], r["text"]) for r in lines.clean(df, Workspace(spark)).collect()}
    assert {(r["doc_id"], r["text"]) for r in found} == cleaned
    assert len(found) == len({r[:2] for r in rows})


def test_line_edge_cases(docs, workspace, spark):
    rows = lines.report(docs(ODD, clashing=True), workspace).collect()
    assert sorted(str(r["doc_id"]) for r in rows) == sorted(str(i) for i, _ in {r[:2] for r in ODD})
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[5]["n_dropped"] == 0 and by_id[6]["n_dropped"] == 2 and len(LONG) > 100_000
    assert lines.report(docs(ODD).limit(0), Workspace(spark)).collect() == []
