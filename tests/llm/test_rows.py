"""Operators that judge each text by itself, against plain versions."""

import re
import string
from collections import Counter

import duckdb
import pytest
import zstandard

from plumbline.llm import classifier, licenses, pii, quality, secrets, toxicity

ASCII_LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def by_id(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


def luhn(d):
    total = 0
    for k, c in enumerate(reversed(d)):
        x = int(c) * (1 + k % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def base_pii(text):
    found = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        found.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            found.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub(r"\D", "", m[0])
        if 12 <= len(d) <= 19 and luhn(d):
            found.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub(r"[^0-9]", "", m[0])) <= 15:
            found.append(("phone", *m.span()))
    return sorted(found, key=lambda s: (s[1], pii.BASE.index(s[0])))


def test_pii_base_spans_equal_plain_search(docs, corpus, none):
    got = by_id(pii.find_pii(docs))
    for key, text, *_ in corpus:
        spans = [(s["kind"], s["start"], s["end"]) for s in got[key]["spans"]]
        assert [s for s in spans if s[0] in pii.BASE] == base_pii(text or "")
    assert pii.find_pii(none).count() == 0
    more = [s["kind"] for s in got[16]["spans"]]
    assert more == ["iban", "ssn", "local_phone"]


@pytest.mark.parametrize("alphabet", ["a@.b", "1.2+ (", "09 -", "Aa@.-_%+19 ()"])
def test_pii_on_random_texts(alphabet):
    import random
    rng = random.Random(5)
    for _ in range(300):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60)))
        assert [s[:3] for s in pii.spans_of(text) if s[0] in pii.BASE] == base_pii(text), text


def test_pii_long_runs_take_linear_time():
    for text in ("a" * 300_000, "9" * 300_000, "1." * 150_000, "+1" + "(" * 300_000, "a@" * 100_000):
        pii.spans_of(text)


def test_pii_checksums_and_context():
    assert pii.mod97("DE89370400440532013000") and not pii.mod97("DE89370400440532013001")
    near, far = "my ssn is 078-05-1120", "order number 078-05-1120"
    assert [s[0] for s in pii.spans_of(near)] == ["ssn"] and not pii.spans_of(far)


def test_iban_before_capitals_and_digits():
    def spans(text):
        return [text[s:e] for kind, s, e, _ in pii.spans_of(text) if kind == "iban"]

    for account in ("AT61 1904 3002 3457 3201", "ES91 2100 0418 4502 0005 1332", "BE68 5390 0754 7034", "DE89 3704 0044 0532 0130 00",
                    "NO93 8601 1117 947", "MT84 MALT 0110 0001 2345 MTLC AST0 01S", "AT611904300234573201"):
        for behind in ("", " BIC BKAUATWW", " EUR 50", " 2024", " BKAUATWW", ", then", " and more", " A1 B2"):
            assert spans(f"Konto {account}{behind}") == [account], (account, behind)
    assert spans("ES91 2100 0418 4502 0005 1332 AT61 1904 3002 3457 3201 EUR") == ["ES91 2100 0418 4502 0005 1332", "AT61 1904 3002 3457 3201"]
    assert spans("REF AB12 CDEF 3456 AT61 1904 3002 3457 3201 EUR") == ["AT61 1904 3002 3457 3201"]
    assert not spans("AT61 1904 3002 3457 3202 BIC BKAUATWW")
    assert pii.masked("pay AT61 1904 3002 3457 3201 BIC X", pii.THRESHOLD) == "pay [IBAN] BIC X"
    pii.spans_of("AB12 " * 60_000 + "AB12CDEF" * 40_000)


def test_redaction_keeps_rows_and_columns(docs):
    out = by_id(pii.redact_pii(docs))
    assert docs.columns == pii.redact_pii(docs).columns and len(out) == docs.count()
    assert out[0]["text"] is None and out[3]["text"] == "one"
    assert "[EMAIL]" in out[15]["text"] and "a.b@c" not in out[15]["text"]


def base_quality(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    many = {w for w, c in Counter(windows).items() if c > 1}
    covered = {p for i, w in enumerate(windows) if w in many for p in range(i, i + 5)}
    lines, seen, dup = text.split("\n"), set(), 0
    for line in lines:
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    n = len(words)
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered), n < 10 or 100 * len(covered) > 20 * n


def test_quality_counts_equal_plain_ones(docs, corpus, none):
    got = by_id(quality.measure_quality(docs))
    for key, text, *_ in corpus:
        r = got[key]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"],
                r["base_failed"]) == base_quality(text or ""), key
        assert not (r["base_failed"] and r["kept"])
    assert quality.measure_quality(none).count() == 0
    kept = quality.filter_quality(docs)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {k for k, r in got.items() if r["kept"]}


def test_compression_bands_by_length_and_chunk():
    import os
    import random
    press = zstandard.ZstdCompressor(level=3).compress
    rng = random.Random(1)
    words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 9))) for _ in range(3000)]
    clean = " ".join(rng.choice(words) for _ in range(4000)).encode()

    def verdict(data):
        return quality.compression(data, press, quality.BANDS, quality.CHUNK_BYTES, quality.CHUNK_SHARE)[-1]

    assert verdict(clean) is None and verdict(clean[:700]) is None and verdict(b"short") is None
    assert verdict(b"again and again " * 400) == "repetitive" and verdict(os.urandom(5000)) == "incompressible"
    assert verdict(clean[:12288] + b"again and again " * 768) == "repetitive chunks"
    assert verdict(clean[:12288] + os.urandom(8192)) in ("incompressible", "incompressible chunks")


def test_chunks_of_ordinary_texts_and_last_chunk():
    import base64
    import random
    press = zstandard.ZstdCompressor(level=3).compress
    rng = random.Random(1)
    words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 9))) for _ in range(300)]
    prose = " ".join(rng.choice(words) for _ in range(4000)).encode()
    noise = base64.b64encode(rng.randbytes(6000))

    def judged(data):
        return quality.compression(data, press, quality.BANDS, quality.CHUNK_BYTES, quality.CHUNK_SHARE)

    for head, tail in ((3800, 4038), (1024, 1000), (3072, 2000)):
        assert judged(prose[:head])[-1] is None
        assert judged(prose[:head] + b"again and again " * (tail // 16))[-1] == "repetitive chunks"
    # chunks of random bytes; the last one is partial
    assert judged(prose[:2048] + rng.randbytes(1000))[1:4] == (3, 0, 1)
    assert judged(prose[:3800] + noise[:4038])[1] == 8 and judged(prose[:1100])[1] == 1


def test_base64_is_caught_at_the_length_of_every_band():
    import base64
    import random
    press = zstandard.ZstdCompressor(level=3).compress
    rng = random.Random(4)

    def verdict(data):
        return quality.compression(data, press, quality.BANDS, quality.CHUNK_BYTES, quality.CHUNK_SHARE)[-1]

    starts = [start for start, _, high in quality.BANDS if high < 1]
    for size in {*starts, *(s - 1 for s in starts[1:]), 500, 2000, 40000}:
        for _ in range(20):
            assert verdict(base64.b64encode(rng.randbytes(size))[:size]) == "incompressible", size
    words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 9))) for _ in range(300)]
    prose = " ".join(rng.choice(words) for _ in range(4000)).encode()
    assert all(verdict(prose[:size]) is None for size in (*starts, 500, 2000))
    assert verdict(prose[:3800] + base64.b64encode(rng.randbytes(3100))[:4038]) == "incompressible chunks"


def base_secrets(text):
    found = [("assign", *m.span()) for m in re.finditer(
        r"((?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY]))"
        r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text) if len(m[2]) >= 12]
    found += [("access", *m.span()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if m.end() - m.start() >= 18]
    found += [("hex", *m.span()) for m in re.finditer(r"[0-9a-f]+", text) if m.end() - m.start() >= 16]
    return sorted(found, key=lambda s: (s[1], secrets.BASE.index(s[0])))


def findings(spark, n=400):
    import random
    rng = random.Random(2)
    mixed = string.ascii_letters + string.digits
    rows = []
    for k in range(n):
        secret = "".join(rng.choice(mixed if k % 2 else "0123456789abcdef") for _ in range(rng.randint(20, 48)))
        word = rng.choice("-_./").join("".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(3)) for _ in range(4))
        rows += [(rng.choice(["key: ", "token = '", "auth "]), secret, "'", 1), ("see ", word if k % 2 else word.title() + str(k % 10), " for", 0)]
    return spark.createDataFrame(rows, "before string, inside string, after string, label int")


def test_secrets_base_spans_equal_plain_search(spark, docs, corpus, none):
    labelled = findings(spark)
    got = by_id(secrets.find_secrets(docs, labelled))
    for key, text, *_ in corpus:
        spans = [(s["kind"], s["start"], s["end"]) for s in got[key]["spans"]]
        assert [s for s in spans if s[0] in secrets.BASE] == base_secrets(text or ""), key
    assert secrets.find_secrets(none, labelled).count() == 0
    # one label only: nothing is learnt, base findings stay
    assert by_id(secrets.find_secrets(docs, labelled.where("label = 1")))[17]["spans"]


def test_network_finds_new_secrets_and_leaves_names(spark):
    texts = [(0, "connect with key: 'q7Zp2LxW9vKd3RtY8sNb5HgJ' now"), (1, "open the file docs/manual-pages/network_setup.guide2 please")]
    got = by_id(secrets.find_secrets(spark.createDataFrame(texts, "doc_id long, text string"), findings(spark)))
    assert [s["kind"] for s in got[0]["spans"]] == ["model"] and not got[1]["spans"]


def test_strings_planted_in_texts_are_found_by_a_network_of_the_tables(spark):
    """Kinds unlike the basic findings; random lower-case letters are hard to tell from glued words and are not held to the bar."""
    import base64
    import random
    import uuid
    table = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    net, rng = secrets.train(secrets.labelled_findings(table).toPandas()), random.Random(3)
    low, up, digits = string.ascii_lowercase, string.ascii_uppercase, string.digits

    def drawn(letters, n):
        return "".join(rng.choice(letters) for _ in range(n))

    kinds = {"prefixed": lambda: "ghp_" + drawn(low + up + digits, 36), "base64": lambda: base64.b64encode(rng.randbytes(30)).decode(),
             "dotted": lambda: "eyJ" + drawn(low + up + digits + "-_", 30) + "." + drawn(low + up + digits + "-_", 60),
             "capital hexadecimal": lambda: drawn(digits + "ABCDEF", 32), "parts": lambda: "xoxb-" + drawn(digits, 12) + "-" + drawn(low + up + digits, 24),
             "words before": lambda: "sk_live_" + drawn(low + up + digits, 24), "base32": lambda: drawn(up + "234567", 32),
             "letters and digits": lambda: drawn(low + digits, 25), "uuid": lambda: str(uuid.UUID(int=rng.getrandbits(128)))}
    texts = [r["text"] for r in table.where("lang is not null and length(text) > 400").orderBy("doc_id").limit(100).collect()]
    shares = {}
    for kind, make in kinds.items():
        found = 0
        for text in texts:
            at, secret = text.find(" ", rng.randrange(200)) + 1, make()
            read = list(secrets.windows(text[:at] + secret + " " + text[at:], at, at + len(secret)))
            found += net.probability(secrets.encode(read)).max() >= net.threshold
        shares[kind] = found / len(texts)
    assert shares.pop("uuid") <= 0.1 and min(shares.values()) >= 0.9, shares


def test_long_secrets_are_scored_over_their_whole_length(spark):
    import random
    rng = random.Random(6)
    drawn = "".join(rng.choice(string.ascii_letters + string.digits) for _ in range(900))
    path = "docs/manual-pages/network-setup/guide-lines/common-parts/"
    texts = [(0, f"auth {drawn} x"), (1, f"the {path}{drawn[:48]} now"), (2, f"the {path}more-words/of-names/2-parts now"),
             (3, f"auth {drawn[:30]}token=abcdefabcdefabcdef/{drawn[30:90]} x")]
    got = by_id(secrets.find_secrets(spark.createDataFrame(texts, "doc_id long, text string"), findings(spark)))
    model = {k: [(s["start"], s["end"]) for s in r["spans"] if s["kind"] == "model"] for k, r in got.items()}
    assert model[0] == [(5, 905)] and model[1] == [(4, 4 + len(path) + 48)] and not model[2]
    # overlaps a basic finding without lying inside it
    assert [s["kind"] for s in got[3]["spans"]] == ["model", "assign", "hex"]
    long = "".join(map(chr, range(200)))
    read = [w[1] for w in secrets.windows(long, 4, 180)]
    assert set("".join(read)) == set(long[4:180]) and read[0] == long[4:52] and read[1][:24] == read[0][24:] and read[-1] == long[132:180]
    assert [w[1] for w in secrets.windows(long, 4, 30)] == [long[4:30]]


def test_network_gradient_and_recall(spark):
    import numpy as np
    data = findings(spark, 60).toPandas()
    codes, labels = secrets.encode(list(zip(data.before, data.inside, data.after))), data.label.to_numpy(float)
    net = secrets.Network()

    def loss():
        z = net.forward(codes)[0]
        return np.mean(np.log1p(np.exp(-np.where(labels == 1, z, -z))))

    g = net.gradients(codes, labels)
    for k, at in (("w3", (2, 1)), ("embed", (5, 2)), ("out", (4,))):
        net.p[k][at] += 1e-5
        up = loss()
        net.p[k][at] -= 2e-5
        down = loss()
        net.p[k][at] += 1e-5
        assert abs((up - down) / 2e-5 - g[k][at]) < 1e-4
    trained = secrets.train(data)
    assert (trained.probability(codes[labels == 1]) >= trained.threshold).mean() >= 0.9


def plain_phrases(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate(ASCII_LOWER))
    places = [(i, label) for phrase, label in licenses.PHRASES for i in range(len(words))
              if words[i:i + len(phrase.split())] == phrase.split()]
    return len(words), len(places), min((p for p, _ in places), default=None), max((p for p, _ in places), default=None), \
        ",".join(sorted({label for _, label in places}))


def test_license_phrases_equal_plain_search(docs, corpus, none):
    got = by_id(licenses.scan_licenses(docs))
    for key, text, *_ in corpus:
        r = got[key]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == plain_phrases(text or ""), key
        assert 0 <= r["score"] <= 1 and set(filter(None, r["base_labels"].split(","))) <= set(filter(None, r["labels"].split(",")))
    assert got[19]["labels"] == "apache-2.0" and got[19]["score"] == 1.0 and got[6]["labels"] == ""
    assert licenses.scan_licenses(none).count() == 0


def test_license_diagonals_bridge_changes(spark):
    notice = dict(licenses.TEMPLATES)["isc"].split()
    texts = [(0, " ".join(["before it"] * 30 + notice[:12] + ["really"] + notice[12:] + ["after"])),
             (1, " ".join(notice[:9])), (2, " ".join(reversed(notice)))]
    got = by_id(licenses.scan_licenses(spark.createDataFrame(texts, "doc_id long, text string")))
    assert got[0]["labels"] == "isc" and (got[0]["spans"][0]["first_word"], got[0]["spans"][0]["last_word"]) == (60, 60 + len(licenses.words_of(dict(licenses.TEMPLATES)["isc"])))
    assert got[1]["labels"] == "" and got[2]["labels"] == ""


def test_label_model_recovers_accuracies():
    import numpy as np
    rng = np.random.default_rng(1)
    truth = rng.random(20000) < 0.7
    accuracy = [0.95, 0.8, 0.7, 0.9]
    counts = Counter()
    for t in truth:
        counts["".join("-" if rng.random() < 0.3 else ("g" if t == (rng.random() < a) else "b") for a in accuracy)] += 1
    model = classifier.LabelModel(counts)
    assert abs(model.share - 0.7) < 0.03
    for k, a in enumerate(accuracy):
        assert abs(model.accuracy[0, k, 0] - a) < 0.04 and abs(model.accuracy[1, k, 1] - a) < 0.04


def test_classifier_on_small_and_empty_tables(docs, none):
    got = by_id(classifier.score_quality(docs))
    assert len(got) == docs.count() and not got[0]["kept"] and not got[1]["kept"] and got[1]["score"] == 0
    assert classifier.score_quality(none).count() == 0
    assert classifier.filter_classified(docs).columns == docs.columns


SF = "/root/testdata/sf0.01"


def agreement(spark, df, column, label):
    rows = {r["doc_id"]: r[column] for r in df.collect()}
    labels = duckdb.sql(f"SELECT doc_id, max({label}) FROM '{SF}/labels.parquet' GROUP BY 1").fetchall()
    return [(rows[d], y) for d, y in labels if d in rows]


def test_classifier_agrees_with_labels_it_never_saw(spark):
    pairs = agreement(spark, classifier.score_quality(spark.read.parquet(f"{SF}/documents.parquet")), "kept", "quality")
    assert sum(k for k, y in pairs if y == 1) >= 0.97 * sum(y == 1 for _, y in pairs)
    assert sum(not k for k, y in pairs if y == 0) >= 0.9 * sum(y == 0 for _, y in pairs)


def test_toxicity_gradient_and_padding():
    import numpy as np
    rng = np.random.default_rng(0)
    texts = [rng.integers(0, 60, n) for n in (5, 1, 0, 9)]
    net = toxicity.TextNetwork(np.arange(0, 60, 2))
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    for width in toxicity.WIDTHS:
        net.p[f"b{width}"] += 0.01  # a text without words would lie on the rectifier's kink
    labels, weights = np.array([1.0, 0, 1, 0]), np.array([1.0, 2, 1, 1])

    def loss():
        z = net.logits(texts)
        return (weights * np.log1p(np.exp(-np.where(labels == 1, z, -z)))).sum() / weights.sum()

    g = net.gradients(texts, labels, weights)
    for k, at in (("w2", (3, 1)), ("embed", (int(net.rows(texts[0])[2]), 2)), ("embed", (toxicity.RARE, 1)), ("out", (4,)), ("b3", (0,))):
        net.p[k][at] += 1e-6
        up = loss()
        net.p[k][at] -= 2e-6
        down = loss()
        net.p[k][at] += 1e-6
        assert abs((up - down) / 2e-6 - g[k][at]) < 1e-5
    assert np.allclose(net.logits(texts), np.concatenate([net.logits([t]) for t in texts]))


def test_toxicity_recalls_held_out_labels(spark):
    """A tenth of the toxic labels of the tables are on texts without a toxic word; no score can know these."""
    from plumbline.llm import queries
    folder = "/root/testdata/sf0.1"
    rows = (queries.QUERIES["op9_toxicity"](spark, folder).where("held_out")
            .join(spark.read.parquet(f"{folder}/labels.parquet").where("toxic is not null").select("doc_id", "toxic"), "doc_id").toPandas())
    toxic, said = rows["toxic"] == 1, rows["predicted"] == 1
    assert toxic.sum() > 50 and said[toxic].mean() >= 0.72 and said[~toxic].mean() <= 0.01, (said[toxic].mean(), said[~toxic].mean())


def test_toxicity_forward_pass_equals_a_plain_one():
    import numpy as np
    rng = np.random.default_rng(1)
    texts = [rng.integers(0, 40, n) for n in (7, 0, 1, 3, 2000)]
    net = toxicity.TextNetwork(np.arange(0, 40, 3))
    for ids, got in zip(texts, net.logits(texts)):
        x = [net.p["embed"][2 + i // 3 if i % 3 == 0 else toxicity.RARE] for i in ids.tolist()] or [np.zeros(toxicity.DIM)]
        n, features = len(x), []
        x = x + [np.zeros(toxicity.DIM)] * 2
        for w in toxicity.WIDTHS:
            answers = [np.concatenate(x[k:k + w]) @ net.p[f"w{w}"] + net.p[f"b{w}"] for k in range(n)]
            features += list(np.maximum(np.max(answers, axis=0), 0))
        assert abs(np.dot(features, net.p["out"]) + net.p["bias"][0] - got) < 1e-4


def test_toxicity_learns_words_and_never_sees_held_out_rows(spark):
    import random
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(300)]
    rows, labels = [], []
    for k in range(600):
        text = [rng.choice(words) for _ in range(60)]
        toxic = k % 5 == 0
        if toxic:
            text[rng.randint(0, 59)] = rng.choice(["vile", "rotten"])
        rows.append((k, " ".join(text), ("en", "de", None)[k % 3], "x"))
        labels.append((k, int(toxic)))
    rows += [(1000, None, "en", "x"), (1001, "", None, "x"), (None, "vile", "en", "x")]
    labels += [(1000, None), (None, 1), (0, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, id string")
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    from pyspark.sql import functions as F
    got = toxicity.score_toxicity(docs, known, F.col("id") < 500).collect()
    score = {r["doc_id"]: r["score"] for r in got}
    late = [k for k in range(500, 600)]
    assert len(got) == 603 and all(0 <= r["score"] <= 1 for r in got)
    right = sum((score[k] >= 0.5) == (k % 5 == 0) for k in late)
    assert right >= 95
    # labels outside the usable rows change nothing
    other = known.withColumn("toxic", F.when(F.col("doc_id") >= 500, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = {r["doc_id"]: r["score"] for r in toxicity.score_toxicity(docs, other, F.col("id") < 500).collect()}
    assert all(abs(score[k] - again[k]) < 1e-9 for k in late)
    assert {r["score"] for r in toxicity.score_toxicity(docs, known.where("toxic = 0")).collect()} == {0.0}
    assert toxicity.score_toxicity(docs.limit(0), known).count() == 0


def test_toxicity_trains_and_calibrates_on_all_labelled_rows(spark, monkeypatch):
    import numpy as np
    import pytest
    from pyspark.sql import functions as F

    rng = np.random.default_rng(4)
    common = [f"plain{k}" for k in range(30)]
    texts, marks = [], rng.integers(0, 2, 300)
    for k, mark in enumerate(marks):
        texts.append(" ".join([*rng.choice(common, 12), *(["nasty" if k % 2 else "vile"] if mark else [])]))
    docs = spark.createDataFrame([(k, t, "en") for k, t in enumerate(texts)], "doc_id long, text string, lang string")
    known = spark.createDataFrame([(k, int(m)) for k, m in enumerate(marks)], "doc_id long, toxic int")
    rows, sample, share = toxicity.training_rows(docs, known, F.lit(True), "doc_id", "text", "lang", "toxic", 30, 10_000)
    assert rows.count() == 300 and len(sample) == 60 and share == pytest.approx(marks.mean())
    apart = {r["id"]: r["held"] for r in rows.collect()}
    assert all(apart[i] == h for i, h in zip(sample["id"], sample["held"]))
    learnt = [np.unique(toxicity.word_ids(t)) for k, t in enumerate(texts) if not apart[k]]
    buckets, n = np.unique(np.concatenate(learnt), return_counts=True)
    assert (toxicity.common_buckets(rows) == buckets[n >= toxicity.MIN_TEXTS]).all()
    seen, adjust = [], toxicity.TextNetwork.calibrate
    monkeypatch.setattr(toxicity.TextNetwork, "calibrate", lambda self, z, y, langs, share, counts=None: seen.append(
        len(z) if counts is None else counts.sum()) or adjust(self, z, y, langs, share, counts))
    got = {r["doc_id"]: r["score"] for r in toxicity.score_toxicity(docs, known, most=30).collect()}
    assert seen[-1] == sum(apart.values())
    assert np.mean([(got[k] >= 0.5) == m for k, m in enumerate(marks)]) > 0.95
    again = {r["doc_id"]: r["score"] for r in toxicity.score_toxicity(docs.repartition(5, "text"), known, most=30).collect()}
    assert all(again[k] == pytest.approx(v, abs=1e-4) for k, v in got.items())


def test_toxicity_shuffles_only_words_of_labelled_rows(spark):
    import numpy as np
    from pyspark.sql import functions as F

    rows = [(k, f"word{k % 7} and more", "en") for k in range(-2000, 2000)] + [(5, "twice given", None), (None, "no id", "en"), (8, None, "de")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    marks = [(k, int(k % 2 == 0)) for k in range(-40, 60)] + [(9999, 1), (None, 1), (7, None), (6, 0)]
    known = spark.createDataFrame(marks, "doc_id int, toxic int")
    got, _, share = toxicity.training_rows(docs, known, F.col("id") != 3, "doc_id", "text", "lang", "toxic", 30, 10_000)
    found = sorted((r["id"], r["label"], tuple(np.frombuffer(r["words"], np.int32))) for r in got.collect())
    want = sorted((i, float(i % 2 == 0), tuple(toxicity.word_ids(t))) for i, t, _ in rows if i is not None and -40 <= i < 60 and i != 3)
    assert found == want and share == 51 / 100
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    # one way at any size: texts go no further than the task that reads them, and rows meet labels in a merge
    assert "SortMergeJoin" in plan and "bitmap_construct_agg" in plan and got.rdd.getNumPartitions() == 4
    got.unpersist()


def test_toxicity_step_sends_no_more_from_many_lanes(spark, monkeypatch):
    import numpy as np

    wide = toxicity.SLOPE_ROWS * 3
    rows = spark.range(4000).selectExpr("cast(id as int) as id").repartition(200, "id")

    def measure(batches):
        vector, matrix = np.zeros(2), np.zeros((wide, toxicity.DIM))
        for batch in batches:
            vector += len(batch), batch["id"].sum()
            np.add.at(matrix, batch["id"].to_numpy() % wide, 1.0)
        return vector, matrix

    want = np.bincount(np.arange(4000) % wide, minlength=wide)[:, None] * np.ones(toxicity.DIM)
    collect, sent = type(rows).collect, []
    monkeypatch.setattr(type(rows), "collect", lambda self: sent.append(
        (len(out := collect(self)), self._jdf.queryExecution().optimizedPlan().toString())) or out)
    vector, matrix = toxicity.step_sums(rows, 4, measure, wide)
    assert (vector == [4000, 3999 * 2000]).all() and (matrix == want).all()
    # four tasks send a vector and three places each, whatever the lanes, and shuffle nothing (but what deals the lanes here)
    assert sent[0][0] == 4 * 4 and "Repartition 4, false" in sent[0][1] and sent[0][1].count("RepartitionByExpression") == 1
    monkeypatch.setattr(toxicity, "DIRECT_VALUES", 0)
    again, shuffled = toxicity.step_sums(rows, 4, measure, wide)
    assert (again == vector).all() and (shuffled == want).all() and sent[1][0] == 4 and sent[1][1].count("RepartitionByExpression") == 2
    nothing = toxicity.step_sums(rows.limit(0), 4, measure, wide)
    assert not nothing[0].any() and not nothing[1].any()


def test_toxicity_trains_over_many_partitions_without_shuffling_slopes(spark, monkeypatch):
    import numpy as np

    rng = np.random.default_rng(5)
    texts = [[*rng.integers(0, 3000, 12), 9 if k % 2 else 8] for k in range(600)]
    rows = spark.createDataFrame([(k * 7919, np.array(t, np.int32).tobytes(), "en", float(k % 2), k % 5 == 0) for k, t in enumerate(texts)],
                                 "order long, words binary, lang string, label double, held boolean").repartition(90, "order").persist()
    steps, mapped = [], type(rows).mapInPandas
    monkeypatch.setattr(type(rows), "mapInPandas", lambda self, *a, **b: steps.append(self.rdd.getNumPartitions()) or mapped(self, *a, **b))
    monkeypatch.setattr(toxicity, "EPOCHS", 1)
    monkeypatch.setattr(toxicity, "STEPS", 2)
    network = toxicity.train_on_all(toxicity.TextNetwork(np.arange(3000)), rows, 0.5)
    # lanes of 90 partitions are added up in 4 tasks before anything leaves them
    assert steps == [90, 4] * 3 and network.thresholds.keys() == {"en"}
    rows.unpersist()
