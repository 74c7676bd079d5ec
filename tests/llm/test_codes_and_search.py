"""Vector codes, token ids and ranked search against plain versions, the tokenizers library and SQL."""

import math
import os
import random
import re
import string
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from plumbline.llm import bpe, lexical, queries, vector_codes

SMALL = "/root/testdata/sf0.001"
ASCII_LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def against_sql(spark, key):
    got = queries.QUERIES[key](spark, SMALL)
    con = duckdb.connect()
    for name in ("documents", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    cursor = con.execute(queries.ORACLES[key])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(got.columns)
    assert sorted(map(tuple, got.select(*columns).collect())) == sorted(cursor.fetchall())


@pytest.mark.parametrize("key", ["op11_vector_codes", "op13_lexical"])
def test_queries_match_sql(spark, key):
    against_sql(spark, key)


# vector codes

def plain_codes(rows, parts=8, entries=16, rounds=6):
    """rows of (id, label, vector), kept ones only, in order: codebooks and (code, error) of each, in Python integers."""
    cut = []
    for _, _, v in rows:
        whole, width = [math.floor(float(np.float32(x)) * 4096) for x in v], len(v) // parts
        cut.append([whole[p * width:(p + 1) * width] for p in range(parts)])
    books = [[cut[k][p] for k in range(min(entries, len(cut)))] for p in range(parts)]

    def nearest(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            members = defaultdict(list)
            for row in cut:
                members[nearest(p, row[p])[1]].append(row[p])
            books[p] = [[sum(c) // len(members[k]) for c in zip(*members[k])] if members[k] else e for k, e in enumerate(books[p])]
    out = [[nearest(p, row[p]) for p in range(parts)] for row in cut]
    return books, [("".join(f"{k:02x}" for _, k in row), sum(d for d, _ in row)) for row in out]


def vectors(n, width=16, seed=5):
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        v = [rng.gauss(0, 0.1) for _ in range(width)]
        rows.append((k, rng.choice([1, 2, None]), rows[-1][2] if k % 7 == 3 else v))
    return rows


VECTORS = "vec_id long, label int, embedding array<float>, id string, vector string, code string, error string"


def coded(spark, rows, n=3, **options):
    df = spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], VECTORS).repartition(n)
    got, books = vector_codes.compress_vectors(df, **options)
    return got.collect(), books


@pytest.mark.parametrize("change", [{}, {"MEMO_CELLS": 3, "BLOCK": 5}, {"HOT_ROWS": 10}, {"ACROSS": 1}, {"ACROSS": 100_000}])
def test_vector_codes_equal_plain_ones(spark, monkeypatch, change):
    for name, value in change.items():
        monkeypatch.setattr(vector_codes, name, value)
    rows = vectors(90)
    bad = [(-5, 1, None), (-4, 1, []), (-3, 1, [0.1] * 15 + [None]), (-2, None, [float("nan")] * 16), (-1, 2, [float("-inf")] + [0.0] * 15),
           (95, 1, [0.1] * 24), (96, 1, [0.1] * 17)]
    extra = [(None, 1, rows[4][2]), (7, 2, rows[7][2]), (7, None, rows[8][2])]
    kept = sorted(rows + extra, key=lambda r: (r[0] is None, r[0] or 0, [float(np.float32(x)) for x in r[2]]))
    got, books = coded(spark, rows + bad + extra)
    want_books, want = plain_codes(kept)
    assert books.tolist() == want_books
    assert sorted(((r["id"], r["label"], r["code"], r["error"]) for r in got), key=repr) == sorted(
        ((k[0], k[1], *w) for k, w in zip(kept, want)), key=repr)
    sums = Counter()
    for k, w in zip(kept, want):
        sums[k[1]] += w[1]
    assert all(r["label_error"] == sums[r["label"]] for r in got)


def test_vector_codes_of_few_equal_and_no_rows(spark):
    for rows in (vectors(5), [(1, 1, [0.25] * 8)] * 20, [(k, 1, [0.0] * 8) for k in range(3)]):
        got, books = coded(spark, rows)
        want_books, want = plain_codes(sorted(rows, key=lambda r: (r[0], [float(np.float32(x)) for x in r[2]])))
        assert books.tolist() == want_books and sorted((r["code"], r["error"]) for r in got) == sorted(want)
    for rows in ([], [(1, 1, None)]):
        got, books = coded(spark, rows)
        assert got == [] and books.size == 0
    with pytest.raises(Exception, match="64-bit"):
        coded(spark, [(1, 1, [40000.0] * 8)])


def test_cells_that_share_a_hash_and_cells_without_the_nearest_entry():
    rng = np.random.default_rng(3)
    book, points = rng.integers(-900, 900, (16, 4)), rng.integers(-1500, 1500, (4000, 4))
    distances = ((points[:, None, :] - book) ** 2).sum(axis=2)
    cells = vector_codes.Cells(book)
    assert np.array_equal(cells.nearest(points)[0], distances.argmin(axis=1))
    assert cells.evaluated < 0.8 * cells.points * len(book) and len(cells.places) > 100
    cells = vector_codes.Cells(book)
    cells.factors[:] = 0  # every cell has the same hash now
    codes, errors = cells.nearest(points)
    assert np.array_equal(codes, distances.argmin(axis=1)) and np.array_equal(errors, distances.min(axis=1))
    cells = vector_codes.Cells(book)
    inside = cells.undominated(points >> cells.shift)
    assert inside[np.arange(len(points)), distances.argmin(axis=1)].all() and inside.mean() < 0.8


def test_codes_decode_to_their_entries(spark):
    rows = vectors(40)
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    got, books = vector_codes.compress_vectors(df)
    exact = {r[0]: np.floor(np.array(r[2], np.float32).astype(float) * 4096) for r in rows}
    for r in vector_codes.decode_codes(got, books).collect():
        near = np.array(r["approximation"]) * 4096
        assert ((near - exact[r["id"]]) ** 2).sum() == r["error"]


# token ids

HOSTILE = [None, "", " ", "  \n\t", "a", "aaaaaaaaaaaaaaa", "don't I'LL we've", "x  y   z ", "tab\tnew\r\nline", "naïve café Ünder",
           "日本語のテキスト。", "🙂👍🏽 emoji", "é combining", " nbsp　wide\x85next\x1cfile​zero", "123456 ٣٤٥ ½ Ⅻ",
           "<|endoftext|>", "a <|endoftext|>  b<|endoftext|><|endoftext|>", "<|endoftext", "\x00\x01\x7f\xad", "�￿\U0010ffff",
           "===----====", "ſecret ﬁ ǅ", "a" * 3000, "ab" * 1500, " " * 500]


@pytest.fixture(scope="module")
def library():
    public = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    path = public.path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return path, tokenizer


def hostile_texts():
    rng = random.Random(12)
    letters = "ab etaoin\n\t'sr<|endoftext|>09é日　\x85\x1c🙂-=" + string.ascii_letters
    long_word = "".join(rng.choice(string.ascii_letters + string.digits) for _ in range(20_000))
    return HOSTILE + ["".join(rng.choice(letters) for _ in range(rng.randint(1, 90))) for _ in range(400)] + [long_word]


def test_token_ids_equal_the_library(spark, library, monkeypatch):
    path, tokenizer = library
    texts = hostile_texts()
    monkeypatch.setattr(bpe, "BLOCK_CHARS", 3000)
    monkeypatch.setattr(bpe, "MEMO_SYMBOLS", 2000)
    df = spark.createDataFrame([(k % 50 or None, t, "x", "x") for k, t in enumerate(texts)] * 2, "doc_id long, text string, id string, word string")
    encoded = bpe.encode_texts(df.repartition(3), path)
    assert encoded.columns == [*df.columns, "ids"]
    want = Counter((t, tuple(tokenizer.encode(t or "", add_special_tokens=False).ids)) for t in texts * 2)
    assert Counter((r["text"], tuple(r["ids"])) for r in encoded.collect()) == want
    for r in bpe.decode_ids(encoded, path).collect():
        assert r["decoded"] == tokenizer.decode(r["ids"], skip_special_tokens=False) == (r["text"] or "")
    with pytest.raises(ValueError, match="ids"):
        bpe.encode_texts(encoded, path)


def test_ids_that_are_no_text_decode_like_the_library(spark, library):
    path, tokenizer = library
    rng = random.Random(2)
    rows = [[rng.randrange(50257) for _ in range(30)] for _ in range(50)] + [[10253, 50256, 225, 225, 222], []]
    df = spark.createDataFrame([(r,) for r in rows] + [(None,), ([-1, 60000, 64, None],)], "ids array<int>")
    got = [r["decoded"] for r in bpe.decode_ids(df.coalesce(1), path).collect()]
    assert got == [tokenizer.decode(r, skip_special_tokens=False) for r in rows] + ["", "a"]


def test_no_rows_and_other_tokenizers(spark, library, none):
    path, _ = library
    assert bpe.decode_ids(bpe.encode_texts(none.select("doc_id", "text"), path, keep_text=False), path).collect() == []
    import public_tokenizers

    with pytest.raises(ValueError, match="byte-level"):
        bpe.Merges(public_tokenizers.path("word_bpe_49k.json"))


def test_lowest_pairs_go_first_from_the_left(library):
    """Every word merged one pair at a time by its definition."""
    merges = bpe.Merges(library[0])
    rank = {int(k): (int(r), int(x)) for k, r, x in zip(merges.keys, merges.ranks, merges.results)}
    rng = random.Random(4)
    words = ["".join(rng.choice("aabest ") for _ in range(rng.randint(1, 40))).encode() for _ in range(300)]
    ids, counts = merges.merge(words)
    ends = np.cumsum(counts)
    for word, end, n in zip(words, ends, counts):
        symbols = [int(merges.bytes[b]) for b in word]
        while True:
            known = [(rank[a << 32 | b], k) for k, (a, b) in enumerate(zip(symbols, symbols[1:])) if a << 32 | b in rank]
            if not known:
                break
            (_, made), k = min(known)
            symbols[k:k + 2] = [made]
        assert symbols == ids[end - n:end].tolist()


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="test tables not present")
def test_token_query_on_the_tables(spark, library):
    import hashlib

    _, tokenizer = library
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = queries.op12_bpe(spark, SMALL).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = tokenizer.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(tokenizer.decode(ids, skip_special_tokens=False).encode()).hexdigest()


# ranked search

def plain_search(docs, items, top=10):
    cut = [re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate(ASCII_LOWER)) for _, t in docs]
    n, length = sum(map(bool, cut)), sum(map(len, cut))
    bags = [Counter(c) for c in cut]
    df = Counter(w for b in bags for w in b)
    out = []
    for item, text in items:
        asked = re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(ASCII_LOWER))
        found = []
        for (doc, _), bag, words in zip(docs, bags, cut):
            score = 0
            for w in asked:
                if bag[w]:
                    m = 25 + 75 * len(words) * n // length
                    score += math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * (1_000_000_000 * bag[w] // (1000 * bag[w] + 8 * m))
            if score > 0:
                found.append((-score, doc is None, doc))
        found.sort(key=lambda f: (f[0], f[1], f[2] or 0))
        out += [(item, k + 1, f[2], -f[0]) for k, f in enumerate(found[:top])]
    return sorted(out, key=repr)


def some_texts(seed, n, least=0, most=60):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 3))) for _ in range(300)]
    return [rng.choice([" ", ", ", "\n"]).join(rng.choice(words[:rng.choice([5, 40, 300])]).title() for _ in range(rng.randint(least, most)))
            for _ in range(n)]


DOCS = "doc_id long, text string, name string, query string, id string, queries string"


@pytest.mark.parametrize("change", [{}, {"QUERY_TERMS": 40, "BLOCK_DOCS": 8, "BLOCK_CHARS": 100}, {"ENTRY_BITS": 1, "HASHES": 1, "MEMO_TERMS": 5}])
def test_search_equals_plain_scores(spark, monkeypatch, change):
    for name, value in change.items():
        monkeypatch.setattr(lexical, name, value)
    texts = some_texts(1, 120)
    long_text = " ".join(some_texts(1, 400, 40, 60))
    rows = [*enumerate(texts), *[(500 + k, texts[3]) for k in range(30)], (None, texts[4]), (None, texts[4]), (None, texts[5]),
            (7, texts[8]), (7, texts[8]), (600, long_text), (601, None), (602, ""), (603, ",;!")]
    items = [*[(k, t) for k, t in enumerate(some_texts(1, 25))], (3, texts[3]), (3, texts[3]), (None, texts[20]), (90, None), (91, ""),
             (92, "nowhere"), (93, texts[2].upper()), (94, f"{texts[3]} {texts[3]}")]
    docs = spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], DOCS).repartition(4)
    asked = spark.createDataFrame([(*i, "x", "x") for i in items], "item_id long, text string, query string, rank string")
    got = lexical.search(docs, asked).collect()
    assert sorted(map(tuple, got), key=repr) == plain_search(rows, items)


def test_search_in_empty_tables_and_one_term_texts(spark, none):
    asked = spark.createDataFrame([(1, "abc"), (2, None)], "item_id long, text string")
    assert lexical.search(none, asked).collect() == []
    docs = spark.createDataFrame([(1, "abc"), (2, "ABC abc"), (3, "x")], "doc_id long, text string")
    assert lexical.search(docs, asked.limit(0)).collect() == []
    assert lexical.search(docs, asked.where("item_id = 2")).collect() == []
    assert sorted(map(tuple, lexical.search(docs, asked).collect())) == plain_search([(1, "abc"), (2, "ABC abc"), (3, "x")], [(1, "abc")])


def test_bounds_hold_and_leave_out_most_documents(spark):
    texts = some_texts(9, 400, 5, 300)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    index = lexical.signature_index(docs)
    asked = lexical.Queries(some_texts(9, 6, 10, 40))
    asked.weigh(lexical.document_frequencies(docs, asked.vocabulary), *lexical.collection_size(index))
    names = {r["name"]: r["text"] for r in lexical.named(docs, "doc_id", "text").collect()}
    seen, close = 0, 0
    for row in index.collect():
        table = np.frombuffer(row["slices"], np.uint8).reshape(row["width"], -1)
        bounds = asked.bounds(row["width"], np.array(row["sizes"]), table)
        values = asked.scores([names[n] for n in row["names"]])
        exact = np.stack([values[:, terms] @ times for terms, times in asked.bags], axis=1)
        assert (bounds >= exact).all()
        seen, close = seen + exact.size, close + (bounds <= 1.1 * exact).sum()
    assert seen == len([t for t in texts if t]) * 6 and close > 0.9 * seen
    least = np.array([r["score"] for r in lexical.best_scores(
        lexical.named(docs, "doc_id", "text"), index.select(lexical.F.explode("names").alias("name"), lexical.F.sequence(
            lexical.F.lit(0), lexical.F.lit(5)).alias("queries")), asked, 10).where("rank = 10").orderBy("query").collect()])
    found = lexical.reaching(index, asked, least).select(lexical.F.explode("queries")).count()
    assert 60 <= found < 0.2 * seen


def test_levels_are_dense_and_rising():
    steps = lexical.LEVELS
    assert steps[:8].tolist() == [1, 2, 3, 4, 5, 6, 7, 8] and (np.diff(steps) > 0).all() and (steps[1:] <= 1.34 * steps[:-1] + 1).all()
    assert steps[-1] > 1 << 30
