"""SimHash components, the conversation trie and importance resampling against plain versions, and on odd rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from pageglean.llm import catalog, prefix_trie, resampling, simhash
from pageglean.llm import words as W

SF = "/root/testdata/sf0.001"
EXTRA = "lang string, score double, rank int, fp long, label long, id long, row long, depth long, number long"
EXTRA_ROW = ("x", 1.5, 7, 8, 9, 10, 11, 12, 13)


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


# ---- simhash --------------------------------------------------------------------------------------------------------

def plain_fingerprint(text, shingle=4, seed=42):
    words = words_of("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    runs = [" ".join(words[i:i + shingle]) for i in range(len(words) - shingle + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(r.encode(), seed) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps, distance=4):
    """For each fingerprint the least position of its component."""
    values, found = np.array(fps, dtype=np.uint64), [-1] * len(fps)
    for i in range(len(fps)):
        if found[i] < 0:
            found[i], waiting = i, [i]
            while waiting:
                near = np.bitwise_count(values ^ values[waiting.pop()]) <= distance
                for j in np.flatnonzero(near).tolist():
                    if found[j] < 0:
                        found[j] = i
                        waiting.append(j)
    return found


TEXTS = ["One two THREE four five six", "one two three four five six", "a b", "A\tB", "", None, " \n", "É é É é x", "one\x0btwo\x0cthree four",
         "lorem " * 50, "w" * 3000, "x y z", "1 2 3 4", "1 2 3 4 5"]


@pytest.mark.parametrize("piece", (1 << 21, 7))
def test_fingerprint_equals_plain(piece, monkeypatch):
    monkeypatch.setattr(W.cut, "__defaults__", (piece,))
    for text in [*TEXTS, " ".join(f"W{i % 37}" for i in range(500))]:
        assert simhash.fingerprint((text or "").encode()) == plain_fingerprint(text), text
        assert simhash.fingerprint((text or "").encode(), 1) == plain_fingerprint(text, 1)


def clustered(seed, n, clusters, flips):
    rng = random.Random(seed)
    centres = [rng.getrandbits(64) for _ in range(clusters)]
    found = set()
    for _ in range(n):
        value = rng.choice(centres)
        for _ in range(rng.randrange(flips)):
            value ^= 1 << rng.randrange(64)
        found.add(value)
    return sorted(found)


@pytest.mark.parametrize("n", (2, 1000, 10**6, 10**9))
def test_plan_leaves_no_near_pair_without_a_common_bucket(n):
    sample = np.array(clustered(1, 300, 5, 9), dtype=np.uint64)
    parts = simhash.plan(sample, n)
    rng = random.Random(2)
    for _ in range(500):
        near = sum({1 << rng.randrange(64) for _ in range(4)})
        assert any(bin(near & p.mask()).count("1") <= p.threshold for p in parts)
    bits = [b for p in parts for b in p.bits]
    assert len(bits) == len(set(bits))


def test_thresholds_are_unequal_where_bits_say_little():
    rng = np.random.default_rng(5)
    sample = rng.integers(0, 2**63, 500, dtype=np.uint64) & np.uint64(0xFFFFFFFFFFFF0000)
    parts = simhash.plan(sample, 10**8)
    assert len({p.threshold for p in parts}) > 1 or sum(len(p.bits) for p in parts) < 64


@pytest.mark.parametrize("block, pivots", ((1 << 15, 256), (40, 4), (40, 0)))
def test_near_links_connect_what_brute_force_connects(spark, block, pivots):
    fps = clustered(3, 700, 6, 8) + clustered(4, 200, 200, 1) + [0, 1, 3]
    fps = sorted(set(fps))
    table = spark.createDataFrame([(simhash._signed(f),) for f in fps], "fp long")
    links = [(r["a"] % 2**64, r["b"] % 2**64) for r in simhash.near_links(table, block=block, pivots=pivots).collect()]
    assert all(bin(a ^ b).count("1") <= 4 and a != b for a, b in links)
    at, parent = {f: i for i, f in enumerate(fps)}, list(range(len(fps)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        x, y = root(at[a]), root(at[b])
        parent[max(x, y)] = min(x, y)
    assert [root(i) for i in range(len(fps))] == plain_components(fps)


def test_a_large_group_of_near_copies_gives_no_more_links_than_members():
    fps = np.array(clustered(6, 2000, 1, 6), dtype=np.uint64)
    assert len(simhash._forest(fps, np.zeros(len(fps), dtype=bool), np.zeros(1, dtype=np.int64), 4)) < len(fps)


def test_simhash_of_odd_rows(spark):
    rows = [(i, t, *EXTRA_ROW) for i, t in enumerate(TEXTS)] + [(3, "a b", *EXTRA_ROW)] * 2 + [(None, "1 2 3 4 5", *EXTRA_ROW), (None, "only here q r s", *EXTRA_ROW)]
    docs = spark.createDataFrame(rows, f"doc_id long, text string, {EXTRA}")
    fps = [plain_fingerprint(r[1]) for r in rows]
    marks = plain_components(fps)
    ids = {m: min((r[0] for r, k in zip(rows, marks) if k == m and r[0] is not None), default=None) for m in set(marks)}
    want = Counter((r[0], f"{f:016x}", ids[m]) for r, f, m in zip(rows, fps, marks))
    assert Counter(tuple(r) for r in simhash.near_duplicates(docs).collect()) == want
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_op11_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    fps = [plain_fingerprint(r["text"]) for r in docs]
    marks = plain_components(fps)
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in catalog.op11_simhash(spark, SF).collect()}
    assert got == {r["doc_id"]: (f"{f:016x}", docs[m]["doc_id"]) for r, f, m in zip(docs, fps, marks)}


# ---- conversation trie ----------------------------------------------------------------------------------------------

def plain_trie(rows, stride=20, shared=4):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append(((turn is not None, turn or 0), role or "", text or ""))
    order = {c: [(r, t) for _, r, t in sorted(v, key=lambda x: x[0])] for c, v in own.items()}
    built = {}
    for c, turns in order.items():
        h = zlib.crc32(str(c).encode()) % shared
        built[c] = order.get(c - int(math.fmod(c, stride)), [])[:h] + turns[h:]
    nodes = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    found = {}
    for node, members in nodes.items():
        below = [k for k in nodes if k[:len(node)] == node]
        ends = ",".join(str(c) for c in sorted(members) if len(built[c]) == len(node))
        found[min(members), len(node)] = (
            min(nodes[node[:-1]]) if node else None, len(members), sum(len(k) == len(node) + 1 for k in below),
            sum(not any(len(j) == len(k) + 1 and j[:len(k)] == k for j in below) for k in below),
            sum((len(nodes[k]) - 1) * (len(words_of(k[-1][1])) if k else 0) for k in below), hashlib.sha256(ends.encode()).hexdigest())
    return found


def trie_of(frame, **options):
    rows = prefix_trie.conversation_trie(frame, **options).collect()
    found = {(r["conv_id"], r["depth"]): (r["parent_conv_id"], r["n_convs"], r["n_children"], r["n_leaves"], r["saved_tokens"], r["ends_sha256"]) for r in rows}
    assert len(found) == len(rows)
    return found


def random_turns(seed, convs, most):
    rng = random.Random(seed)
    return [(c, t, rng.choice(("user", "bot", None)), rng.choice(("a b", "c", "", None, "d  e f"))) for c in range(convs) for t in range(rng.randrange(most))]


@pytest.mark.parametrize("segment, batch", ((1024, 1 << 15), (2, 1 << 15), (3, 20)))
def test_trie_equals_plain(spark, monkeypatch, segment, batch):
    monkeypatch.setattr(prefix_trie, "BATCH_TURNS", batch)
    rows = random_turns(1, 90, 9)
    # Long ones that share most of their turns, and one that ends inside another.
    rows += [(200 + c, t, "user", f"x{t}" if t < 30 + c % 3 else f"y{c}") for c in range(6) for t in range(40 - (c == 5) * 20)]
    assert trie_of(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), segment=segment) == plain_trie(rows)


def test_trie_of_odd_rows(spark):
    rows = [(0, None, "user", "first"), (0, 3, "user", "second"), (0, 5, None, None), (1, 1, "user", "one"), (1, 2, "", ""), (7, 1, "user", "é é x"),
            (None, 1, "user", "none"), (-21, 1, "user", "neg"), (40, 1, "user", "word " * 20000), (41, 9, "bot", "only"), (62, 1, "user", "lone")]
    frame = spark.createDataFrame([(*r, *EXTRA_ROW) for r in rows], f"conv_id long, turn long, role string, text string, {EXTRA}")
    assert trie_of(frame) == plain_trie(rows)
    # A turn that stands there three times counts three times.
    again = rows + [rows[1]] * 2
    assert trie_of(frame.unionByName(frame.filter("turn = 3")).unionByName(frame.filter("turn = 3"))) == plain_trie(again)
    assert trie_of(frame.limit(0)) == {}


def test_trie_of_turnless_conversations(spark):
    """Conversations shorter than what is cut off, whose base is absent, have no turn but belong to the root."""
    convs = [c for c in range(1, 400) if zlib.crc32(str(c).encode()) % 4 == 3 and c % 20][:30]
    rows = [(c, t, "user", "x") for c in convs for t in range(2)]
    found = trie_of(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    assert found == plain_trie(rows) and list(found) == [(min(convs), 0)]


def test_end_digests_in_chunks(spark):
    rows = [(c, c % 3, c % 3, 5) for c in range(-50, 1000)]
    found = prefix_trie.end_digests(spark.createDataFrame(rows, "conv long, depth long, p1 long, p2 long"), chunk=16).collect()
    assert {r["depth"]: r["ends_sha256"] for r in found} == {
        d: hashlib.sha256(",".join(str(r[0]) for r in rows if r[1] == d).encode()).hexdigest() for d in range(3)}


def test_exit_nodes_are_found_by_handles():
    rng = random.Random(8)
    texts = [tuple(rng.choice("ab") for _ in range(rng.randrange(1, 40))) for _ in range(400)]
    texts += [("a",) * n for n in (100, 7, 64, 63, 65)]
    hashes = [[(hash(t[:d]), d) for d in range(len(t) + 1)] for t in texts]
    trie = prefix_trie.ZFastTrie(prefix_trie.Strings([0] * len(texts), [len(t) for t in texts], hashes))
    for i, t in enumerate(texts):
        if i:
            depth = trie.locate(i)[1]
            assert depth == max(max(d for d in range(min(len(t), len(o)) + 1) if t[:d] == o[:d]) for o in texts[:i])
        trie.insert(i)
        assert trie.end[trie.stop[i]] == len(t)
    assert prefix_trie.two_fattest(0, 7) == 4 and prefix_trie.two_fattest(4, 7) == 6 and prefix_trie.two_fattest(8, 24) == 16


def test_op12_equals_its_sql(spark):
    compare(spark, "op12_prefix_trie", "conversations")


# ---- resampling -----------------------------------------------------------------------------------------------------

def compare(spark, name, *tables):
    con = duckdb.connect()
    for t in tables:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = catalog.queries()[name](spark, SF)
    want = con.execute(catalog.oracle_sql()[name])
    columns = sorted(c[0] for c in want.description)
    assert sorted(got.columns) == columns
    place = [[c[0] for c in want.description].index(c) for c in columns]
    assert Counter(tuple(r) for r in got.select(*columns).collect()) == Counter(tuple(r[p] for p in place) for r in want.fetchall())


def test_op13_equals_its_sql(spark):
    compare(spark, "op13_resampling", "documents", "benchmark")


def plain_draw(docs, target, longest, buckets, percent, least):
    def features(text):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
        return len(words), [zlib.crc32(" ".join(words[i:i + n]).encode()) % buckets for n in range(1, longest + 1) for i in range(len(words) - n + 1)]

    s, t = Counter(b for _, text in docs for b in features(text)[1]), Counter(b for text in target for b in features(text)[1])
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (big_s + buckets) / ((s[b] + 1) * (big_t + buckets)))) for b in range(buckets)]
    rows = []
    for doc_id, text in docs:
        n, found = features(text)
        weight = sum(gain[b] for b in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        rows.append((doc_id, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), n >= least))
    able = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    drawn = [(*r[:4], k + 1) for k, r in enumerate(able[:percent * len(able) // 100])]
    left = Counter(r[:4] for r in rows) - Counter(r[:4] for r in drawn)
    return Counter(drawn) + Counter({(*k, None): n for k, n in left.items()})


@pytest.mark.parametrize("longest, percent, accuracy, piece", ((1, 10, 10_000, 1 << 21), (3, 35, 10_000, 11), (2, 50, 3, 1 << 21), (1, 100, 5, 1 << 21), (1, 0, 5, 1 << 21)))
def test_resampling_equals_plain(spark, monkeypatch, longest, percent, accuracy, piece):
    monkeypatch.setattr(W.cut, "__defaults__", (piece,))
    rng = random.Random(11)
    docs = [(i, " ".join(rng.choice("red Green blue-9 ÉTÉ 7up q_r".split()) for _ in range(rng.randrange(12)))) for i in range(400)]
    # A third of the rows share one id and text, some have none.
    docs += [(5, "red Green blue-9 q_r")] * 200 + [(None, "red 7up red"), (None, "red"), (None, None), (900, ""), (901, None), (902, "--- ..."), (903, "red " * 5000)]
    target = ["green green 7up", None, "", "red Green", "été"]
    frame = spark.createDataFrame([(*d, *EXTRA_ROW) for d in docs], f"doc_id long, text string, {EXTRA}")
    aim = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")
    got = resampling.resample(frame, aim, longest=longest, buckets=50, percent=percent, least_words=2, accuracy=accuracy)
    assert Counter(tuple(r) for r in got.collect()) == plain_draw(docs, target, longest, 50, percent, 2)


def test_resampling_of_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c")] * 3, "doc_id long, text string")
    none = docs.limit(0)
    assert resampling.resample(none, docs).count() == 0
    rows = resampling.resample(docs, none, least_words=1, percent=50).collect()
    assert sorted(r["rank"] or 0 for r in rows) == [0, 0, 1] and len({r["weight"] for r in rows}) == 1


def test_the_cutoff_sorts_little_of_the_table(spark):
    """The bracket around the cutoff holds a small share of the scores."""
    scored = spark.range(100_000).select(F.col("id"), F.col("id").alias("n_features"), F.col("id").alias("row"), F.pmod(F.xxhash64("id"), F.lit(1 << 30)).alias("score")).cache()
    low, high, above = resampling._bracket(scored, 10_000, 10_000, 0.1)
    inside = scored.filter(F.col("score").between(low, high)).count()
    assert above < 10_000 <= above + inside and inside < 200
    assert scored.filter(resampling.drawn(scored, 10_000, 100_000)).count() == 10_000
    scored.unpersist()
