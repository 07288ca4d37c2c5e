"""The ten operators against plain versions, and on nulls, empty and long texts, ties, repeats and empty tables."""

import hashlib
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from pageglean.llm import bpe, catalog, components, features, fingerprints, jaccard_join, language, mixing, pii, quality, shards, substrings, topk

SF = "/root/testdata/sf0.001"
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, score double, shard int, lang_pred string, copies int, key string"
WORDS = "the of and cat dog house river stone water light green tree walks under over runs sleeps bright old new".split()


def sentence(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + str(rng.randrange(50)) for _ in range(n))


@pytest.fixture(scope="module")
def docs(spark):
    """Odd rows of all kinds, with extra columns of clashing names."""
    base, passage = sentence(1, 60), sentence(2, 20)
    texts = [base, base, base + " end", None, "", " \n\t", "12345 !?", "x", passage + " " + sentence(3, 30), sentence(4, 30) + " " + passage,
             "word " * 3000, "a" * 40000, "é" * 300 + " ñandú", base.replace("\n", " ")]
    rows = [(i, t, "en" if i % 2 else "fr", "s", len(t) if t else None, 1.0, 9, "zz", 7, "k") for i, t in enumerate(texts)]
    rows += [rows[0], (None, base, None, None, None, None, None, None, None, None), (None, None, None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, COLUMNS)


@pytest.fixture(scope="module")
def given(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(0, 1, 0), (2, 0, 0), (8, 1, 1), (9, 1, 0), (10, 0, 0), (None, 1, 0), (7, None, None)], "doc_id long, quality int, toxic int")


def by_id(df):
    return {r["doc_id"]: r for r in df.collect() if r["doc_id"] is not None}


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


# ---- mixing ---------------------------------------------------------------------------------------------------------

def test_mixing_meets_its_targets(given, spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = mixing.mix(given, labels, targets=(0.5, 0.3, 0.2)).collect()
    totals = np.sum([np.array(r["posterior"]) * r["n_tokens"] * r["rate"] for r in rows], axis=0)
    assert np.allclose(totals / totals.sum(), (0.5, 0.3, 0.2), atol=1e-5)
    assert totals.sum() == pytest.approx(sum(r["n_tokens"] for r in rows), rel=1e-5)
    assert all(r["rate"] >= 0 and abs(r["copies"] - r["rate"]) < 1 for r in rows)


def test_mixing_rates_equal_plain_projected_gradients(spark):
    rng = np.random.default_rng(3)
    p, n = rng.dirichlet((0.3, 0.3, 0.3), 60), rng.integers(1, 50, 60)
    frame = spark.createDataFrame([(int(a), [float(x) for x in b]) for a, b in zip(n, p)], "n_tokens long, posterior array<double>")
    targets = np.array((0.2, 0.2, 0.6))
    fit = mixing.fit_rates(frame, tuple(targets), max_steps=15)
    r, h = np.ones(60), np.linalg.inv((p * n[:, None]).T @ p)
    for _ in range(len(fit.steps)):
        r = np.maximum(0, r - p @ (h @ ((p * n[:, None]).T @ r - targets * n.sum())))
    assert np.allclose(fit.totals, (p * n[:, None]).T @ r, rtol=1e-6)
    assert (r >= 0).all() and np.allclose(fit.totals, fit.wanted, rtol=1e-2)


def test_mixing_of_odd_rows(docs, labels, spark):
    rows = mixing.mix(docs, labels).collect()
    assert len(rows) == docs.count() and all(np.isfinite(r["rate"]) for r in rows)
    assert {r["rate"] for r in mixing.mix(docs, labels.limit(0), targets=(1, 1, 1)).collect()} == {1.0}
    assert mixing.mix(docs.limit(0), labels).count() == 0


# ---- substrings -----------------------------------------------------------------------------------------------------

def plain_repeats(rows):
    seen, found = {}, {}
    for doc_id, text in rows:
        w = words_of(text)
        for i in range(len(w) - 12):
            if doc_id is not None:
                key = tuple(w[i:i + 13])
                seen[key] = min(seen.get(key, doc_id), doc_id)
    for doc_id, text in rows:
        w = words_of(text)
        gone = set()
        for i in range(len(w) - 12):
            if doc_id is not None and seen[tuple(w[i:i + 13])] < doc_id:
                gone.update(range(i, i + 13))
        found[doc_id, text] = (len(w), len(gone), hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in gone).encode()).hexdigest())
    return found


@pytest.mark.parametrize("group", (2048, 1))
def test_substrings_of_odd_rows(docs, group):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    want = sorted((str(k[0]), *v) for k, v in ((r, plain_repeats(rows)[r]) for r in rows))
    got = sorted((str(r["doc_id"]), r["n_words"], r["n_removed"], r["kept_sha256"]) for r in substrings.remove_repeats(docs, group=group).collect())
    assert got == want
    assert substrings.remove_repeats(docs.limit(0)).count() == 0


def test_suffix_nodes_are_equal_for_equal_beginnings():
    ids = np.array([1, 2, 3, 1, 2, 3, 1, 2, 3, 4, 1, 2, 3, 1])
    for depth in range(1, 6):
        nodes = substrings.deep_nodes(ids, depth)
        starts = [tuple(ids[i:i + depth]) for i in range(len(ids) - depth + 1)]
        assert len(nodes) >= len(starts)
        assert all((nodes[i] == nodes[j]) == (starts[i] == starts[j]) for i in range(len(starts)) for j in range(len(starts)))


# ---- top k ----------------------------------------------------------------------------------------------------------

def plain_top_k(rows, k):
    whole = [(i, [int(np.floor(1024 * float(x))) for x in v]) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    found = []
    for q, (i, v) in enumerate(whole):
        if i % 100 == 0:
            scores = sorted((-sum(a * b for a, b in zip(v, w)), j) for c, (j, w) in enumerate(whole) if c != q and len(w) == len(v))
            found += [(i, n + 1, j, -s) for n, (s, j) in enumerate(scores[:k])]
    return sorted(found)


def test_top_k_with_ties_repeats_and_odd_vectors(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=6)]) for i in range(300)]
    rows += [(400 + i, rows[5][1]) for i in range(30)] + [rows[100], (500, None), (600, [1.0, None, 2.0]), (700, [float("nan")] * 6), (800, []),
                                                          (900, [float("inf")] * 6), (1000, [1.0, 2.0]), (1001, [3.0, -1.0]), (None, [1.0] * 6), (1100, [0.0] * 6)]
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<float>, score int, rank int")
    got = sorted(tuple(r) for r in topk.top_k(df, k=7).collect())
    assert got == plain_top_k(rows, 7)
    assert topk.top_k(df.limit(0)).count() == 0


# ---- language -------------------------------------------------------------------------------------------------------

def test_language_held_out_accuracy(given, spark):
    rows = language.identify(given).join(given.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.95 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_of_odd_rows(docs):
    found = language.identify(docs)
    assert found.count() == docs.count()
    rows = by_id(found)
    assert [rows[i]["lang_pred"] for i in (3, 4, 5, 6)] == ["und"] * 4 and rows[12]["lang_pred"] in ("en", "fr")
    assert {r["lang_pred"] for r in language.identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert language.identify(docs.limit(0)).count() == 0


def test_language_counts_long_texts_like_short_ones(monkeypatch):
    model = language.Model(["a", "b"], np.log([0.5, 0.5]), np.random.default_rng(0).normal(size=(language.BUCKETS, 2)).astype(np.float32) / 1000)
    text = sentence(5, 400)
    whole = language.scores([text], model)
    monkeypatch.setattr(language, "CODE_POINTS", 50)
    assert np.allclose(language.scores([text], model), whole)


# ---- shards ---------------------------------------------------------------------------------------------------------

def test_shards_have_exact_sizes_and_slots(docs):
    rows = shards.shard_documents(docs).collect()
    assert len(rows) == docs.count()
    sizes = Counter(r["shard"] for r in rows)
    assert max(sizes[s] for s in range(8)) - min(sizes[s] for s in range(8)) <= 1
    for s in range(8):
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(sizes[s]))
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    assert all((r["size"], r["text_crc32"]) == (len(texts[r["doc_id"]].encode()) + 1, zlib.crc32(texts[r["doc_id"]].encode())) for r in rows if r["doc_id"] is not None)
    assert shards.shard_documents(docs.limit(0)).count() == 0


def test_equal_rows_are_spread_over_all_shards_and_slots(spark):
    docs = spark.range(8800).select(F.when(F.col("id") < 800, -1).otherwise(F.col("id")).alias("doc_id"), F.when(F.col("id") < 800, "same").otherwise(F.col("id").cast("string")).alias("text"))
    rows = [r for r in shards.shard_documents(docs.repartition(5)).collect() if r["doc_id"] == -1]
    assert len(rows) == 800 and all(60 < n < 145 for n in Counter(r["shard"] for r in rows).values())
    assert all(40 < n < 125 for n in Counter(r["slot"] * 10 // 1100 for r in rows).values())


def test_shards_over_many_parts_keep_all_rows(spark):
    rows = shards.shuffle_shards(spark.range(1000).withColumn("shard", F.lit("x")), 3, seed=4, rows_per_part=40).collect()
    assert sorted(r["id"] for r in rows) == list(range(1000))
    assert sorted((r["shard"], r["slot"]) for r in rows) == [(s, i) for s in range(3) for i in range(334 if s == 0 else 333)]


def test_communication_matrix_is_hypergeometric():
    draws = [shards.communication_matrix([30, 20, 0], [25, 25], seed) for seed in range(2000)]
    assert all((m.sum(axis=1) == [30, 20, 0]).all() and (m.sum(axis=0) == [25, 25]).all() for m in draws)
    first = np.array([m[0, 0] for m in draws])
    assert abs(first.mean() - 15) < 0.2 and abs(first.var() - 30 * 0.25 * 20 / 49) < 0.4
    big = [shards.hypergeometric(np.random.default_rng(s), 5 * 10**10, 5 * 10**10, 10**6) for s in range(50)]
    assert abs(np.mean(big) - 5 * 10**5) < 500


# ---- quality --------------------------------------------------------------------------------------------------------

def test_quality_orders_grades_on_held_out_documents(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{n}.parquet") for n in ("documents", "labels"))
    seen = labels.filter("doc_id % 4 != 0")
    rows = quality.grade_documents(docs, seen).join(labels.filter("doc_id % 4 = 0").withColumn("grade", F.expr(quality.GRADE)), "doc_id").collect()
    right = sum(r["keep"] == (r["grade"] == 2) for r in rows)
    assert right >= 0.85 * len(rows) and all(0 <= r["expected_grade"] <= 2 and 0 <= r["tail"] <= 1 for r in rows)


def test_quality_of_odd_rows(docs, labels):
    rows = quality.grade_documents(docs, labels).collect()
    assert len(rows) == docs.count() and all(np.isfinite(r["expected_grade"]) for r in rows)
    assert {round(r["expected_grade"], 6) for r in quality.grade_documents(docs, labels.limit(0)).collect()} == {1.0}
    assert quality.grade_documents(docs.limit(0), labels).count() == 0


def test_ordinal_thresholds_are_ordered():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 50, 8)) for _ in range(300)]
    grades = np.array([min(3, int((s < 10).sum())) for s in sets])
    model = quality.fit(sets, grades, 4, 64)
    assert (np.diff(model.thresholds) > 0).all()
    assert np.corrcoef(quality.above(model, sets).sum(axis=1), grades)[0, 1] > 0.8


# ---- Jaccard join ---------------------------------------------------------------------------------------------------

def plain_near(rows):
    sets = []
    for _, text in rows:
        w = words_of(text)
        sets.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    parent, links = list(range(len(rows))), [0] * len(rows)

    def root(i):
        return i if parent[i] == i else root(parent[i])

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if rows[i][1] is not None and rows[i][1] == rows[j][1] or a and b and len(a & b) >= 0.8 * len(a | b) - 1e-9:
                links[i] += 1
                links[j] += 1
                parent[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(i)] = min(least.get(root(i), doc_id), doc_id)
    return sorted((str(d), str(least.get(root(i), d)), links[i]) for i, (d, _) in enumerate(rows))


@pytest.mark.parametrize("limits", ({}, {"bucket": 3, "depth": 1, "block": 2}))
def test_near_duplicates_of_odd_rows(docs, spark, limits):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    text = sentence(9, 120).split()
    for i in range(12):  # a group of near copies, each with one other word
        rows.append((100 + i, " ".join([*text[:i * 3], f"other{i}", *text[i * 3 + 1:]])))
    df = spark.createDataFrame([(*r, "k", 1) for r in rows], "doc_id long, text string, key string, node int")
    got = sorted((str(r["doc_id"]), str(r["class_id"]), r["n_links"]) for r in jaccard_join.near_duplicates(df, **limits).collect())
    assert got == plain_near(rows)
    assert jaccard_join.near_duplicates(df.limit(0)).count() == 0


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7)], "a long, b long")
    assert {r["node"]: r["label"] for r in components.components(links).collect()} == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


# ---- fingerprints ---------------------------------------------------------------------------------------------------

def test_fingerprints_of_odd_rows(docs):
    rows = sorted(((r["doc_id"], r["text"] or "") for r in docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    want = Counter()
    for (doc_id, text), (_, after) in zip(rows, rows[1:] + rows[:1]):
        half = len(text) // 2
        want[doc_id, len(text), hashlib.sha256((text[:len(text) - half] + after[:half]).encode()).hexdigest()] += 1
    found = fingerprints.fingerprint_documents(docs, rows_per_range=3).collect()
    assert Counter((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in found) == want
    marks = {r["doc_id"]: r["fingerprint"] for r in found if r["doc_id"] is not None}
    assert marks[0] == marks[1] == marks[13] and marks[0] != marks[2] and marks[3] == marks[4] == ""
    assert fingerprints.fingerprint_documents(docs.limit(0)).count() == 0


def test_fingerprints_estimate_generalised_jaccard(given):
    texts = [r["text"] for r in given.orderBy("doc_id").collect()]
    rows = fingerprints.fingerprint_documents(given, samples=64).orderBy("doc_id").collect()

    def likeness(a, b):
        a, b = Counter(words_of(a)), Counter(words_of(b))
        return sum((a & b).values()) / max(1, sum((a | b).values()))

    misses = []
    for i, r in enumerate(rows):
        text, after = texts[i], texts[(i + 1) % len(texts)]
        half = len(text) // 2
        misses.append((r["near_edited"] - likeness(text, text[:len(text) - half] + after[:half]), r["near_next"] - likeness(text, after)))
    assert np.abs(np.mean(misses, axis=0)).max() < 0.02 and np.std(misses, axis=0).max() < 0.08


def test_fingerprints_follow_null_ids_first(spark):
    rows = [(i, f"text {i} of some words") for i in range(10)] + [(None, "one without id"), (None, "two without any id")]
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    want = Counter()
    for (doc_id, text), (_, after) in zip(order, order[1:] + order[:1]):
        half = len(text) // 2
        want[doc_id, hashlib.sha256((text[:len(text) - half] + after[:half]).encode()).hexdigest()] += 1
    found = fingerprints.fingerprint_documents(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "edited_sha256").collect()
    assert Counter(map(tuple, found)) == want


def test_fingerprints_of_texts_of_very_many_words(spark):
    texts = [" ".join(f"{name}{i}" for i in part) for name, part in (("a", range(20000)), ("b", range(20000)), ("b", range(10000, 30000)))]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {terms: sorted(map(tuple, fingerprints.fingerprint_documents(df, terms=terms).collect())) for terms in (fingerprints.TERMS, 100)}
    assert found[fingerprints.TERMS] == found[100]  # the table of common words is for speed only
    near = [r[-1] for r in found[100]]
    assert near[0] == near[2] == 0.0 and abs(near[1] - 1 / 3) < 0.2


# ---- BPE ------------------------------------------------------------------------------------------------------------

def plain_digest(tok, text):
    ids = tok.encode(text or "", add_special_tokens=False).ids
    return (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(tok.decode(ids, skip_special_tokens=False).encode()).hexdigest())


@pytest.mark.parametrize("above", (1 << 15, 50))
def test_bpe_equals_the_library(docs, spark, above):
    more = [(200, "<|endoftext|> it's <|startoftext|>x" * 9), (201, "don't'll 're" * 20), (202, "ab\x1cc\x85d\xa0e　f" * 12), (203, "éΣ" * 80), (204, "\x01 \x01x" * 30),
            (205, "running" * 40 + "  \r\n\r\n" + "two  blanks\t and\n\n lines " * 9 + "walk" * 70), (206, "e\u0301a\u0300" * 90 + "\r\nnext " + "cafe\u0301" * 60 + "\u00a0" + "o" * 99),
            (207, "a<|endoftext|>b" * 20 + " \u212b" * 3 + "\u212bx" * 40), (208, " " * 300), (209, "over" * 60 + " " * 300 + "under" * 60)]
    df = docs.select("doc_id", "text", "key").unionByName(spark.createDataFrame([(*r, "k") for r in more], "doc_id long, text string, key string"))
    tok = bpe.tokenizer(catalog.TOKENIZER)
    want = sorted((str(r["doc_id"]), *plain_digest(tok, r["text"])) for r in df.collect())
    got = sorted(tuple(map(lambda x: x, (str(r["doc_id"]), r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]))) for r in bpe.encode_documents(df, catalog.TOKENIZER, halve_above=above).collect())
    assert got == want
    assert bpe.encode_documents(df.limit(0), catalog.TOKENIZER).count() == 0


@pytest.mark.parametrize("size", (1, 17, 1000))
def test_long_texts_are_encoded_piece_by_piece(size):
    words = bpe.Words(catalog.TOKENIZER)
    for text in ("two  blanks\t and\r\n\r\n lines " * 40, "", " ", "x" * 90, "a\u0301 <|endoftext|> it's\x1cb\u2003c " * 20, " lead" + " " * 50 + "trail "):
        assert words.digest_long(text, size) == plain_digest(words.tok, text)


def test_ordinary_long_texts_are_not_shuffled(spark):
    df = spark.createDataFrame([(1, "word " * 40_000), (2, "y" * 40_000)], "doc_id long, text string")
    got = {r["doc_id"]: r["n_tokens"] for r in bpe.encode_documents(df, catalog.TOKENIZER).collect()}
    tok = bpe.tokenizer(catalog.TOKENIZER)
    assert got == {r["doc_id"]: len(tok.encode(r["text"], add_special_tokens=False).ids) for r in df.collect()}


def test_joined_halves_equal_the_whole():
    tok, rng = bpe.tokenizer(catalog.TOKENIZER), random.Random(5)
    kinds = ("abcdefghijklmnopqrstuvwxyz", ["ing", "the", "tion", "er", "a", "x"], "ab's't ll1é́ÀΣ一😀-.'\n re", "aaa")
    for n in range(400):
        text = "".join(rng.choice(kinds[n % 4]) for _ in range(rng.randrange(20, 400)))
        if bpe.splits_safely(tok, text):
            pieces = [bpe.encode(tok, p) for p in bpe.halves(text, rng.choice((7, 20, 64)))]
            assert bpe.joined(tok, pieces).ids == tok.encode(text, add_special_tokens=False).ids


# ---- personal data --------------------------------------------------------------------------------------------------

def plain_feistel(values, radixes, key, kind):
    values = list(values)
    for r in range(pii.ROUNDS):
        others = ",".join(str(v) for j, v in enumerate(values) if j % 2 != r % 2)
        text = "|".join((key, kind, str(len(values)), str(r), others))
        values = [v if i % 2 != r % 2 else (v + int(hashlib.sha256(f"{text}|{i}".encode()).hexdigest()[:12], 16)) % radixes[i] for i, v in enumerate(values)]
    return values


def test_marks_of_the_search_in_a_text_and_long_addresses(spark):
    odd = "pass\uffff\ufffe\uffffage \ufffe\ufffe 4111111111111111 \ufffe"
    addresses = ["x@a.b.c.d.e.f.g.h.i.com", "n" * 80 + "@mail.example.org", "x@" + "s." * 60 + "net"]
    texts = [odd, odd.replace("4111111111111111", "none"), *(f"write to {a}. Or not" for a in addresses), "a" * 30_000 + "@", "x@" + "b." * 5000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = [r["text"] for r in pii.pseudonymize(df).orderBy("doc_id").collect()]
    assert got[0] != texts[0] and got[0].startswith("pass\uffff\ufffe\uffffage \ufffe\ufffe ") and got[0].endswith(" \ufffe") and len(got[0]) == len(texts[0])
    assert got[1] == texts[1]
    for a, text in zip(addresses, got[2:5]):
        assert a not in text and text.startswith("write to ") and text.endswith(". Or not")
    assert got[5:] == texts[5:]


def luhn(digits):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0


VALUES = ("a.b+c@mail.example.co.uk", "+1 (663) 555-6869", "212-555-0187", "4111111111111111", "4111-1111-1111-1111", "42.144.35.254", "2021-02-28", "12/31/1999",
          "31.12.1999", "078-05-1120", "DE89370400440532013000", "password=b7db7aa4a5fcc78305", "GB82 WEST 1234 5698 7654 32")


def test_values_get_equal_pseudonyms_of_their_format(spark):
    rows = [(i, f"Of {v}, and again {v}.") for i, v in enumerate(VALUES)]
    found = {r["doc_id"]: r for r in pii.pseudonymize(spark.createDataFrame(rows, "doc_id long, text string"), count_col="n").collect()}
    for i, value in enumerate(VALUES):
        text, n = found[i]["text"], found[i]["n"]
        a, b = re.fullmatch(r"Of (.*), and again (.*)[.]", text).groups()
        assert a == b != value and n == 2
        if value[0] != "4" or "." not in value:
            assert re.sub("[a-z]", "a", re.sub("[A-Z]", "A", re.sub("[0-9]", "9", a))) == re.sub("[a-z]", "a", re.sub("[A-Z]", "A", re.sub("[0-9]", "9", value)))
    first = [re.fullmatch(r"Of (.*), and again .*", found[i]["text"])[1] for i in range(len(VALUES))]
    assert luhn(first[3]) and first[3] == first[4].replace("-", "")
    octets = plain_feistel((42, 144, 35, 254), (256,) * 4, pii.KEY, "ip")
    assert first[5] == ".".join(map(str, octets))
    assert first[9].replace("-", "") == "".join(map(str, [v for v, c in zip(plain_feistel([int(c) if c.isdigit() else 0 for c in VALUES[9]],
        [10 if c.isdigit() else 1 for c in VALUES[9]], pii.KEY, "ssn"), VALUES[9]) if c.isdigit()]))
    assert int("".join(str(int(c, 36)) for c in first[10][4:] + first[10][:4])) % 97 == 1


def test_values_that_are_not_valid_and_clean_text_stay(docs, spark):
    clean = ["4111111111111112", "999.1.1.1", "2021-02-29", "000-12-3456", "version 1.2.3", "DE00370400440532013000", "a@b", "in 1999 and 2000000", "", None]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(clean)], "doc_id long, text string, _row string")
    assert [r["text"] for r in pii.pseudonymize(df).orderBy("doc_id").collect()] == clean
    assert pii.pseudonymize(docs).columns == docs.columns and pii.pseudonymize(docs).count() == docs.count()
    assert pii.pseudonymize(docs.limit(0)).count() == 0


def test_values_with_numbers_and_words_beside_them(spark):
    card, iban, long = "4111 1111 1111 1111", "BE68 5390 0754 7034", "password=" + "a1B2" * 100
    kept = [(f"{card}", "", " 12/26"), ("4111111111111111", "", " 123"), (card, "12 ", " 99 1"), (card, "in 2024 ", "."), (iban, "", " USD"), (iban, "", " 1234"),
            (iban, "of ", " PAID NOW"), ("DE89 3704 0044 0532 0130 00", "", " EUR"), (long, "", " end"), ("078-05-1120", "4111111111111112 ", "")]
    both = [("4111111111111111", " ", "078-05-1120"), ("4111111111111111", " ", "212-555-0187"), (iban, " ", card), (card, " 123 ", card)]
    rows = list(enumerate([a + v + b for v, a, b in kept] + ["".join(p) + " 12/26" for p in both]))
    found = [r["text"] for r in pii.pseudonymize(spark.createDataFrame(rows, "doc_id long, text string")).orderBy("doc_id").collect()]
    alone = {v: r["text"] for v, r in zip(sorted({v for v, _, _ in kept} | {x for p in both for x in p[::2]}), pii.pseudonymize(spark.createDataFrame(
        list(enumerate(sorted({v for v, _, _ in kept} | {x for p in both for x in p[::2]}))), "doc_id long, text string")).orderBy("doc_id").collect())}
    assert all(v != w and len(v) == len(w) for v, w in alone.items())
    assert alone[long][300:] != long[300:]
    assert found == [a + alone[v] + b for v, a, b in kept] + [alone[a] + sep + alone[b] + " 12/26" for a, sep, b in both]


def test_feistel_is_a_permutation(spark):
    pairs = spark.range(10000).select(F.array((F.col("id") / 100).cast("bigint"), F.col("id") % 100).alias("v"))
    out = pairs.select(pii.feistel(F.col("v"), F.array(F.lit(100).cast("bigint"), F.lit(100).cast("bigint")), "k", F.lit("t")).alias("w"))
    assert out.distinct().count() == 10000
    assert "Python" not in out._jdf.queryExecution().toString()


# ---- all together ---------------------------------------------------------------------------------------------------

@pytest.mark.parametrize("name", list(catalog.oracle_sql()))
def test_queries_equal_their_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.execute(catalog.oracle_sql()[name]).df()
    got = catalog.queries()[name](spark, SF).toPandas()[list(want.columns)]
    assert sorted(map(tuple, got.itertuples(index=False))) == sorted(map(tuple, want.itertuples(index=False)))


def test_native_operators_have_no_python_in_their_plans(given):
    for df in (shards.shard_documents(given), fingerprints.fingerprint_documents(given), pii.pseudonymize(given)):
        assert not re.search("Python|Arrow|Pandas", df._jdf.queryExecution().executedPlan().toString())


def test_pipeline_stages_on_odd_rows(spark, docs, given):
    odd = docs.select(*corpus_pipeline.COLUMNS)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, odd.limit(0), SF).count() == 0
        found = stage(spark, odd.unionByName(given), SF)
        if name != "tokens":
            assert found.columns == list(corpus_pipeline.COLUMNS)
    kept = {r["doc_id"] for r in corpus_pipeline.near_copies(spark, odd, SF).collect()}
    assert {0, 8, 9} <= kept and not {1, 2, 13} & kept


def test_pipeline_runs(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    assert len(rows) > 100 and all(r["n_tokens"] >= 0 for r in rows)


def test_bucket_sets_do_not_hang_on_their_batch():
    texts = [sentence(i, 20 + i) for i in range(300)] + [None, ""]
    together = features.bucket_sets(texts)
    assert all((features.bucket_sets([t])[0] == b).all() for t, b in list(zip(texts, together))[::37])
