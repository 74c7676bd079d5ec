"""Operators over whole tables, against brute force and SQL."""

import os
import random
import re
import string
from collections import Counter
from hashlib import sha256

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from plumbline.llm import components, decontaminate, licenses, mixing, queries, simhash, substring
from plumbline.llm.common import row_key

ASCII_LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
SPACED, LETTERED = r"[^\x20\x09-\x0D]+", r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def by_id(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


def plain_fingerprint(text):
    words = re.findall(SPACED, (text or "").translate(ASCII_LOWER))
    k = min(3, len(words))
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + k]).encode(), 42) for i in range(len(words) - k + 1)] if words else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups_of(values, bits=2):
    """Smallest index reachable over values that differ in at most so many bits."""
    parent = list(range(len(values)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(values):
        for j in range(i):
            if (a ^ values[j]).bit_count() <= bits:
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    return [root(i) for i in range(len(values))]


def test_simhash_equals_brute_force(docs, corpus, none):
    got = by_id(simhash.near_duplicates(docs))
    prints = [plain_fingerprint(r[1]) for r in corpus]
    assert [got[r[0]]["fingerprint"] % (1 << 64) for r in corpus] == prints
    assert [got[r[0]]["component_id"] for r in corpus] == [corpus[k][0] for k in groups_of(prints)]
    assert simhash.near_duplicates(none).count() == 0 and simhash.drop_near_duplicates(none).count() == 0
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({corpus[k][0] for k in groups_of(prints)})


def test_one_document_of_each_group_stays_whatever_its_id(spark):
    rng = random.Random(8)
    a, b, c, d, e = (" ".join(rng.choice("abcdefgh") * rng.randint(1, 6) for _ in range(80)) for _ in range(5))
    rows = [(None, a), (None, b), (None, b), (3, b), (7, c), (7, d), (7, d), (2, d), (None, e), (None, e), (9, None), (None, "")]
    prints = [plain_fingerprint(t) for _, t in rows]
    assert len(set(groups_of(prints))) == 6
    for n in (1, 5):
        kept = simhash.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(n))
        assert sorted(map(repr, map(tuple, kept.collect()))) == sorted(map(repr, [(None, a), (3, b), (7, c), (2, d), (None, e), (9, None)]))


@pytest.mark.parametrize("bucket", [2, 48])
def test_links_connect_all_near_fingerprints(spark, bucket):
    """Clusters around centres, dense ones with hundreds of members, with and without the way for large keys."""
    rng = random.Random(bucket)
    values = set()
    for size in (1, 2, 5, 40, 150):
        centre = rng.getrandbits(64)
        for _ in range(size):
            centre ^= 1 << rng.randrange(64) if rng.random() < 0.1 else 0
            values.add(centre ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64) if rng.random() < 0.5 else 0))
    values = sorted(values | {rng.getrandbits(64) for _ in range(300)} | {0, 1, 3, (1 << 64) - 1})
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    prints = spark.createDataFrame([(v,) for v in signed], "fp long")
    edges = simhash.links(prints, bucket=bucket)
    rows = edges.collect()
    assert all(((a ^ b) % (1 << 64)).bit_count() <= 2 for a, b in rows)
    found = {r["node"]: r["component"] for r in components.components(edges).collect()}
    mine, theirs = {}, {}
    for v, g in zip(signed, groups_of(values)):
        mine.setdefault(g, set()).add(v)
        theirs.setdefault(found.get(v, v), set()).add(v)
    assert sorted(map(sorted, mine.values())) == sorted(map(sorted, theirs.values()))


def test_thresholds_follow_the_costs():
    assert simhash.allocate([[0, 5, 50, 500], [0, 1, 2, 9], [0, 100, 200, 300]], 2) == (7, [0, 1, -1])
    for threshold in (0, 1, 2):
        part = list(range(6))
        masks = simhash.key_masks(part, threshold)
        for differing in range(1 << 6):
            if bin(differing).count("1") <= threshold:
                assert any(differing & m == 0 for m in masks)
    both = np.full((64, 64), 20.0) + np.eye(64) * 20
    both[3, 60] = both[60, 3] = 40
    parts = simhash.partitions(both, 80, 3)
    assert sorted(b for p in parts for b in p) == list(range(64)) and any({3, 60} <= set(p) for p in parts)


def test_components_of_paths_stars_and_repeats(spark):
    edges = [(k, k + 1) for k in range(200)] + [(1000, 1000 + k) for k in range(1, 300)] + [(5000, 5001), (5001, 5000), (7, 7)]
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(edges, "x long, y long")).collect()}
    assert got == {**{k: 0 for k in range(201)}, **{1000 + k: 1000 for k in range(300)}, 5000: 5000, 5001: 5000}
    assert components.components(spark.createDataFrame([], "x long, y long")).count() == 0


def plain_repeats(texts, window):
    words = [re.findall(SPACED, t or "") for t in texts]
    seen = Counter(tuple(w[i:i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = {p for i in range(len(w) - window + 1) if seen[tuple(w[i:i + window])] > 1 for p in range(i, i + window)}
        out.append((len(w), len(gone), sha256(" ".join(x for p, x in enumerate(w) if p not in gone).encode()).hexdigest()))
    return out


@pytest.mark.parametrize("block, shard", [(1 << 20, 1 << 21), (300, 500)])
def test_substring_equals_brute_force(docs, corpus, none, monkeypatch, block, shard):
    monkeypatch.setattr(substring, "BLOCK_WORDS", block)
    monkeypatch.setattr(substring, "SHARD_WINDOWS", shard)
    got = by_id(substring.mark_repeats(docs))
    assert [tuple(got[r[0]])[1:] for r in corpus] == plain_repeats([r[1] for r in corpus], 35)
    assert substring.mark_repeats(none).count() == 0
    cut = by_id(substring.drop_repeats(docs))
    assert substring.drop_repeats(docs).columns == docs.columns
    assert cut[0]["text"] is None and cut[2]["text"] == " \n\t " and cut[6]["text"] == ""


def test_substring_with_rows_of_equal_ids(spark):
    text = " ".join(map(str, range(50)))
    frame = spark.createDataFrame([(1, text), (1, text), (None, "a b c " + text), (2, "x " * 40)], "doc_id long, text string")
    got = sorted((r["doc_id"] or 0, r["n_removed"]) for r in substring.mark_repeats(frame).collect())
    assert got == [(0, 50), (1, 50), (1, 50), (2, 40)]


def test_a_line_in_unlike_texts_fills_no_shard(spark, monkeypatch):
    rng = random.Random(8)
    line = " ".join(f"line{k}" for k in range(20))
    texts = [(k, " ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(30)) + f" {line} " + " ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(30)))
             for k in range(20_000)]
    texts += [(20_000, texts[7][1]), (20_001, "new " * 3 + texts[9][1])]
    rows = spark.createDataFrame(texts, "id long, text string").repartition(4)
    monkeypatch.setattr(substring, "SHARD_WINDOWS", 1 << 16)
    sizes = [r[0] for r in substring.sent_windows(rows, 35).groupBy("shard").agg(F.sum(F.octet_length("hashes"))).where("shard >= 0")
             .drop("shard").collect()]
    assert len(sizes) >= 16 and max(sizes) <= 2 * sum(sizes) / len(sizes)
    hot = substring.frequent_anchors(rows, 1_600_000, 35)
    assert 1 <= len(hot) <= substring.BLOCK_WORDS // substring.LEAST_HOT
    gone = {r["id"]: r["n_removed"] for r in substring.mark_repeats(rows, "id").where("n_removed > 0").collect()}
    assert gone == {7: 80, 20_000: 80, 9: 80, 20_001: 80}


def test_sketch_never_estimates_too_low():
    rng = np.random.default_rng(0)
    hashes = rng.integers(0, 1 << 62, 5000).astype(np.uint64)
    hashes = np.concatenate([hashes, hashes[:700]])
    for width in (64, 1 << 14):
        rows = [np.bincount(substring.cells(hashes, r, width), minlength=width)[substring.cells(hashes, r, width)] for r in (0, 1)]
        assert (np.minimum(*rows) >= np.unique(hashes, return_inverse=True, return_counts=True)[2][
            np.unique(hashes, return_inverse=True)[1]]).all()


def plain_contamination(texts, items, window=10):
    out = []
    cut = {k: re.findall(LETTERED, (t or "").translate(ASCII_LOWER)) for k, t in items}
    windows = {}
    for k, w in cut.items():
        for i in range(max(1, len(w) - window + 1)) if w else ():
            windows.setdefault(tuple(w[i:i + window]), set()).add(str(k))
    for text in texts:
        words, hit, found = re.findall(LETTERED, (text or "").translate(ASCII_LOWER)), set(), set()
        for length in {len(w) for w in windows}:
            for i in range(len(words) - length + 1):
                if tuple(words[i:i + length]) in windows:
                    hit |= set(range(i, i + length))
                    found |= windows[tuple(words[i:i + length])]
        out.append((len(words), len(hit), sorted(found)))
    return out


def test_contamination_equals_brute_force(spark, docs, corpus, none):
    texts = [r[1] for r in corpus]
    passage = texts[12].split("\n")[1].split()
    items = [(1, " ".join(passage[10:25])), (2, " ".join(passage[40:])), (3, "ab, CD! ab cd ab cd ab cd ab cd ab"), (4, "One two"),
             (5, "three"), (6, None), (7, "..."), (10, " ".join(passage[12:22])), (11, "never there ever"), (12, "É é")]
    bench = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, doc_id string")
    got = by_id(decontaminate.contamination(docs, bench))
    assert [(got[r[0]]["n_words"], got[r[0]]["n_hit"], got[r[0]]["items"]) for r in corpus] == plain_contamination(texts, items)
    assert decontaminate.contamination(none, bench).count() == 0
    nothing = by_id(decontaminate.contamination(docs, bench.limit(0)))
    assert len(nothing) == len(corpus) and not any(r["contaminated"] for r in nothing.values())
    clean = decontaminate.drop_contaminated(docs, bench)
    assert clean.columns == docs.columns
    assert {r["doc_id"] for r in clean.collect()} == {k for k, r in got.items() if not r["contaminated"]}


def test_proximity_equals_brute_force(spark):
    rng = random.Random(1)
    texts = [(k, " ".join(rng.choice("a b c d e f g h".split()) for _ in range(60))) for k in range(40)] + [(50, "b x a"), (51, None)]
    items = [(1, "a b c d"), (2, "h"), (3, "a a g")]
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    rows = {r["key"]: r["doc_id"] for r in frame.select("doc_id", row_key(F.col("doc_id"), F.col("text")).alias("key")).collect()}
    index = decontaminate.Index(frame, spark.createDataFrame(items, "item_id long, text string"), "doc_id", "text", "item_id", "text", 10)
    names = {r["id"]: r["item"] for r in index.items.collect()}
    got = {(names[r["id"]], rows[r["doc"]]) for r in decontaminate.proximity_matches(index, 2).collect()}
    expected = set()
    for item, text in items:
        terms = set(text.split())
        width = len(text.split()) + 2
        for doc, line in texts:
            words = (line or "").split()
            if any(terms <= set(words[i:i + width]) for i in range(len(words))):
                expected.add((item, doc))
    assert got == expected
    _, exact = decontaminate.near_and_exact(index, 2)
    alone = decontaminate.phrase_matches(index)
    assert sorted(map(tuple, exact.select(*alone.columns).collect())) == sorted(map(tuple, alone.collect()))


SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("key", sorted(queries.ORACLES))
def test_query_matches_sql(spark, key):
    con = duckdb.connect()
    for name in os.listdir(SMALL):
        con.execute(f"CREATE VIEW {name[:-8]} AS SELECT * FROM '{SMALL}/{name}'")
    got = queries.QUERIES[key](spark, SMALL)
    cursor = con.execute(queries.ORACLES[key])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(got.columns)
    assert sorted(tuple(r[n] for n in names) for r in got.collect()) == sorted(cursor.fetchall())


def test_mix_by_source(docs, corpus, none):
    rows = mixing.mix_sources(docs).collect()
    assert len(rows) == len(corpus) and mixing.mix_sources(none).count() == 0
    again = {r["doc_id"]: r["taken"] for r in mixing.mix_sources(docs.repartition(7)).collect()}
    total, sources = 0, {}
    for r in rows:
        size = len(re.findall(SPACED, r["text"] or ""))
        assert r["size"] == size and r["taken"] == r["copies"] * size <= 2 * size and again[r["doc_id"]] == r["taken"]
        total += size
        sources.setdefault(r["source"], []).append(r)
    budget, left = 1.5 * total, set(sources)
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(sorted((s for s in sources if s is not None)) + [None])}
    target = {}
    while left:
        share = (budget - sum(target.values())) / sum(weight[s] for s in left)
        over = {s for s in left if share * weight[s] > 2 * sources[s][0]["source_size"]}
        for s in over or left:
            target[s] = 2 * sources[s][0]["source_size"] if over else share * weight[s]
        left -= over or left
    for s, own in sources.items():
        assert abs(own[0]["target"] - target[s]) < 1e-6 * max(1, target[s])
        assert abs(sum(r["taken"] for r in own) - target[s]) <= max(r["size"] for r in own) / 2 + 1e-6


def test_mix_cuts_buckets_like_one_order(spark):
    """Few and many buckets choose the same documents, so the cut does not depend on them."""
    rng = random.Random(6)
    rows = [(k, "w " * rng.randint(0, 30), "ab"[k % 2]) for k in range(400)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    one, many = (by_id(mixing.mix_sources(frame, budget_share=0.4, buckets=b)) for b in (1, 4096))
    assert {k: r["copies"] for k, r in one.items()} == {k: r["copies"] for k, r in many.items()}
    # over many seeds each document is taken about as often as its source's share says
    taken = Counter(r["doc_id"] for seed in range(6) for r in mixing.mix_sources(frame, budget_share=0.4, seed=seed).where("copies > 0").collect())
    for s in "ab":
        own = [r for r in one.values() if r["source"] == s and r["size"]]
        p = own[0]["target"] / own[0]["source_size"]
        mean = sum(taken[r["doc_id"]] for r in own) / len(own) / 6
        assert abs(mean - p) < 0.06


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "near_duplicates", "decontamination", "personal_data", "mix"]
    before = docs
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, before, SMALL).write.parquet(str(tmp_path / name))
        after = spark.read.parquet(str(tmp_path / name))
        assert after.count() <= before.count()
        if k < len(names) - 1:
            assert after.columns == docs.columns
        before = after
    ran = corpus_pipeline.run(spark, SMALL)
    assert sorted(map(str, ran.collect())) == sorted(map(str, before.collect()))
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SMALL).count() == 0


def test_null_and_equal_ids_with_unlike_texts(spark):
    """Every row has the result of its own text, whatever ids it shares."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    passage = " ".join(word() for _ in range(40))
    texts = [passage, "nothing like it", passage + " more", " ".join(word() for _ in range(45)), "all rights reserved here", "x " * 5, None, ""]
    rows = [(k, t) for k in (None, 1) for t in texts]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame([(7, " ".join(passage.split()[5:20]))], "item_id long, text string")
    plain = dict(zip(texts, plain_contamination(texts, [(7, " ".join(passage.split()[5:20]))])))
    want = Counter((k, *plain[t][:2]) for k, t in rows)
    assert Counter((r["doc_id"], r["n_words"], r["n_hit"]) for r in decontaminate.contamination(frame, bench).collect()) == want
    clean = Counter((r["doc_id"], r["text"]) for r in decontaminate.drop_contaminated(frame, bench).collect())
    assert clean == Counter((k, t) for k, t in rows if not plain[t][1])
    base = Counter((r["doc_id"], r["n_words"], r["n_base"]) for r in licenses.scan_licenses(frame).collect())
    assert base == Counter((k, len(re.findall("[a-z]+", t or "")), int("rights reserved" in (t or ""))) for k, t in rows)
    removed = Counter((r["doc_id"], r["n_words"], r["n_removed"]) for r in substring.mark_repeats(frame).collect())
    lengths = {t: len((t or "").split()) for t in texts}
    # each text stands twice, once under each id, so every window of 35 words goes
    gone = {t: 40 if t and t.startswith(passage) else lengths[t] if lengths[t] >= 35 else 0 for t in texts}
    gone[texts[2]] = 41
    assert removed == Counter((k, lengths[t], gone[t]) for k, t in rows)
    alone = Counter((r["doc_id"], r["n_removed"]) for r in substring.mark_repeats(frame.where("doc_id = 1")).collect())
    assert alone == Counter((1, 40 if (t or "").startswith(passage) else 0) for t in texts)


@pytest.mark.parametrize("ident", [None, 7])
def test_mix_of_tied_random_numbers(spark, ident):
    rows = [(ident, f"{k} " + "w " * 49, "abc"[k % 3], "x", "x") for k in range(600)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string, mixing_plan string, taken string").repartition(5)
    mixed = mixing.mix_sources(frame).collect()
    assert "mixing_plan" in mixed[0].asDict() and len(mixed) == 600
    for s in "abc":
        own = [r for r in mixed if r["source"] == s]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 25
    again = mixing.mix_sources(frame.repartition(2)).collect()
    assert {(r["text"], r["copies"]) for r in mixed} == {(r["text"], r["copies"]) for r in again}


def test_near_windows_are_reported_beside_exact_ones(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    loose = "alpha beta INSERTED gamma delta epsilon zeta kappa eta theta iota"
    docs = spark.createDataFrame([(1, item), (2, loose), (3, "alpha " + "x " * 20 + item[6:]), (4, None)], "doc_id long, text string")
    got = by_id(decontaminate.contamination(docs, spark.createDataFrame([(5, item)], "item_id long, text string")))
    assert [(got[k]["items"], got[k]["near_items"]) for k in (1, 2, 3, 4)] == [(["5"], ["5"]), ([], ["5"]), ([], []), ([], [])]
