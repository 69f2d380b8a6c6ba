"""Operators that read each text by itself: quality, encoding, personal data, URLs, secrets, scores."""

import hashlib
import math
import random
import re
import zlib
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F

from pactum.llm import bpe, common, pii, quality, secrets_scan, toxicity, url_filter

#: Null id, null and empty texts, a repeated row, a long text, and columns named like helpers.
EDGE = [
    (1, "plain words " * 40, "en"), (1, "plain words " * 40, "en"), (2, None, None), (3, "", "de"),
    (None, "no id here", "xx"), (4, "wort " * 20_000, "de"), (5, "日本語 のテキスト です", "ja"),
    (6, "\x0b \x0c\r\n\t", None), (7, "a\x1cb\x85c\u00a0d e\u3000f", "en"),
]


def edge(spark):
    df = spark.createDataFrame(EDGE, "doc_id long, text string, lang string")
    return df.withColumns({c: F.lit(1) for c in ("id", "row", "key", "n", "pos", "kept", "score", "base")})


def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string")


# -- quality ---------------------------------------------------------------------------------
def plain_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = {}
    for i in range(len(words) - 2):
        windows.setdefault(tuple(words[i:i + 3]), []).append(i)
    covered = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")),
            len(lines) - len(set(lines)), len(covered), failed)


def test_base_counts_equal_a_plain_count(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    docs = docs.union(edge(spark).select("doc_id", "text", "lang").where("doc_id != 1 or doc_id is null"))
    given = docs.withColumn("nth", F.monotonically_increasing_id()).collect()
    got = quality.quality(spark.createDataFrame(given, "doc_id long, text string, lang string, nth long"),
                          carry=["nth"])
    rows = {r.nth: r for r in got.collect()}
    assert len(rows) == len(given)
    for g in given:
        r = rows[g.nth]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words,
                r.base_failed) == plain_counts(g.text), g.doc_id


def test_fertility_of_one_text():
    words = quality._Words(quality.Vocabularies().paths())
    text = "the quick brown fox jumps over the lazy dog"
    row = quality._measure([text], ["en"], words, quality.BANDS)[0]
    ids = [i for w in text.split() for i in words.pieces.encode(w)]
    counts = np.bincount(ids)
    p = counts[counts > 0] / len(ids)
    assert math.isclose(row[10 + 1], -(p * np.log2(p)).sum())
    assert math.isclose(row[8], len(text.replace(" ", "")) / len(ids)) and row[7] == "latin"
    assert row[10] == 0.0


def test_bands_reject_noise_and_keep_prose():
    words = quality._Words(quality.Vocabularies().paths())
    rng = random.Random(3)
    prose = " ".join(rng.choice("time people water history language children because through between"
                                " another country morning music question answer river".split())
                     + str(i % 7) * (i % 5 == 0) for i in range(400))
    noise = " ".join("".join(chr(rng.randint(0x2500, 0x27FF)) for _ in range(6)) for _ in range(400))
    loop = " ".join(["aa bb", "cc dd"][i % 2 if i < 30 else 0] + "e" * (i % 3) for i in range(200))
    got = quality._measure([prose, noise, loop], ["en", "en", "en"], words, quality.BANDS)
    assert [r[6] for r in got] == [True, False, False]


def test_quality_of_edge_rows(spark):
    got = quality.quality(edge(spark))
    assert got.count() == len(EDGE) and quality.quality(empty(spark)).count() == 0
    assert {r.kept for r in got.where("doc_id in (2, 3, 6)").collect()} == {False}
    kept = quality.keep_good(edge(spark))
    assert kept.columns == edge(spark).columns and kept.where("doc_id = 2").count() == 0
    assert quality.keep_good(empty(spark).drop("lang")).count() == 0


# -- byte-pair encoding ----------------------------------------------------------------------
def test_encoding_equals_the_library(spark, sf_dir):
    from tokenizers import Tokenizer

    texts = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()]
    texts += [t or "" for _, t, _ in EDGE] + [
        "a  b   c \n\n x ", "aaaa aaaaaaa", "'S don't I'll", "<|endoftext|>x<|endoftext|>", " lead",
        "tab\tand\r\nreturn", "٣ ½ ǅ ⅷ", "\U0001f600\u200d\U0001f600", "x\u0000y", "e\u0301 \u088f \U00010940"]
    library = Tokenizer.from_file(bpe.default_vocabulary())
    ids, ends = bpe.Encoder(bpe.default_vocabulary()).encode(texts)
    for i, want in enumerate(library.encode_batch(texts, add_special_tokens=False)):
        own = ids[ends[i]:ends[i + 1]]
        assert own.tolist() == want.ids, texts[i][:40]
        assert bpe.decode(own, bpe.encoder(bpe.default_vocabulary()).vocab) == library.decode(
            want.ids, skip_special_tokens=False)


def test_encoder_forgets_without_changing_results():
    encoder = bpe.Encoder(bpe.default_vocabulary())
    texts = [f"word{i} again word{i + 1} and more" for i in range(200)]
    whole, ends = encoder.encode(texts)
    small = bpe.Encoder(bpe.default_vocabulary())
    small.memo.keep = 50
    for i, text in enumerate(texts):
        assert small.encode([text])[0].tolist() == whole[ends[i]:ends[i + 1]].tolist()


def test_round_trip_over_rows(spark):
    rows = edge(spark)
    encoded = bpe.encode_texts(rows, carry=["doc_id"])
    back = bpe.decode_ids(encoded)
    assert sorted((r.doc_id or -1, r.text) for r in back.collect()) == sorted(
        (i or -1, t or "") for i, t, _ in EDGE)
    digests = {(r.doc_id, r.decoded_sha256) for r in bpe.round_trip_digest(rows).collect()}
    assert digests == {(i, hashlib.sha256((t or "").encode()).hexdigest()) for i, t, _ in EDGE}
    assert bpe.round_trip_digest(empty(spark)).count() == 0


# -- personal data ---------------------------------------------------------------------------
BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def plain_spans(text):
    found = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            good = {"email": True, "phone": 9 <= len(digits) <= 15,
                    "ip": kind != "ip" or all(int(p) <= 255 for p in m.group().split(".")),
                    "card": 13 <= len(digits) <= 19 and luhn(digits)}[kind]
            if good:
                found.append(f"{kind}:{m.start()}:{m.end()}")
    return found


def test_base_spans_equal_plain_patterns(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    rng = random.Random(5)
    alphabet = "ab1290.@+- ()%_é😀\n:4"
    docs += [(10_000 + i, "".join(rng.choice(alphabet) for _ in range(80))) for i in range(600)]
    docs += [(20_000, "a@b.c@d.e x@y.com_z@q.zz 1.2.3.4.5.6.7.8 000256.1.1.1 +1 (2) 3-4-5-6-7-8-9 - "
                      "4111 1111 1111 1111 4111111111111111-2 " + "7" * 5000 + " " + "a" * 30_000)]
    rows = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: r for r in pii.personal_data(rows).collect()}
    for i, text in docs:
        want = ",".join(plain_spans(text))
        assert got[i].base_sha256 == hashlib.sha256(want.encode()).hexdigest(), (i, text[:90])
        assert got[i].spans.startswith(want)


def test_addresses_with_zero_parts(spark):
    text = "10.0.0.1 127.0.0.1 192.168.00.5 0.0.0.0 000.1.2.030 010.256.0.1 1.2.3.000256 8.8.8.8"
    rows = spark.createDataFrame([(1, text)], "doc_id long, text string")
    got = pii.personal_data(rows).head()
    want = ",".join(plain_spans(text))
    assert got.n_ip == 6 and got.spans == want
    assert got.base_sha256 == hashlib.sha256(want.encode()).hexdigest()
    assert pii.redact(rows).head().text == "[IP] [IP] [IP] [IP] [IP] 010.256.0.1 1.2.3.000256 [IP]"


def test_many_matches_in_one_text(spark):
    text = "é " + " ".join(f"user{i}@host{i}.example near {i}" for i in range(4000)) + " end"
    docs = [(1, text), (2, "a@b.c"), (3, "x@y.z, +12 345 678 901")]
    rows = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: r for r in pii.personal_data(rows).collect()}
    for i, t in docs:
        want = ",".join(plain_spans(t))
        assert got[i].base_sha256 == hashlib.sha256(want.encode()).hexdigest()
    clean = {r.doc_id: r.text for r in pii.redact(rows).collect()}
    assert clean[1] == "é " + " ".join(f"[EMAIL] near {i}" for i in range(4000)) + " end"
    assert (clean[2], clean[3]) == ("[EMAIL]", "[EMAIL], [PHONE]")


def disclosure_docs():
    rng = random.Random(1)
    common = ["river", "stone", "market", "letter", "garden", "window", "summer", "bread"]
    docs = []
    for i in range(60):
        words = [rng.choice(common) for _ in range(30)]
        if i < 6:
            words[10:12] = ["Quarrion", "boss@firm.example.com"]
        docs.append((i, " ".join(words)))
    return docs


def test_disclosing_terms_are_found(spark):
    rows = spark.createDataFrame(disclosure_docs(), "doc_id long, text string")
    got = {r.doc_id: r for r in pii.personal_data(rows).collect()}
    for i, text in disclosure_docs():
        at = text.find("Quarrion")
        assert got[i].n_term == (1 if i < 6 else 0)
        if i < 6:
            assert got[i].spans.endswith(f"term:{at}:{at + 8}")
    clean = {r.doc_id: r.text for r in pii.redact(rows).collect()}
    assert "[TERM] [EMAIL]" in clean[0] and "Quarrion" not in clean[0]
    assert clean[30] == dict(disclosure_docs())[30]


def test_the_bits_beside_each_text_are_few(spark, monkeypatch):
    made, plain = [], pii.membership
    monkeypatch.setattr(pii, "membership", lambda *a, **k: made.append(plain(*a, **k)) or made[-1])
    rows = spark.createDataFrame(disclosure_docs(), "doc_id long, text string")
    assert pii.personal_data(rows).where("n_term > 0").count() == 6
    assert made and all(8 * len(m.first().bits) <= 1 << 17 for m in made)


def test_workers_give_memory_back(monkeypatch):
    trimmed = []
    monkeypatch.setattr(common.ctypes, "CDLL", lambda _: SimpleNamespace(malloc_trim=trimmed.append))
    assert list(common.released(iter)([1, 2])) == [1, 2]
    assert trimmed == [0]


def test_personal_data_of_edge_rows(spark):
    got = pii.personal_data(edge(spark)).collect()
    assert len(got) == len(EDGE)
    none = hashlib.sha256(b"").hexdigest()
    assert {(r.n_email, r.base_sha256, r.spans) for r in got} == {(0, none, "")}
    assert pii.personal_data(empty(spark)).count() == 0
    same = pii.redact(edge(spark))
    assert same.columns == edge(spark).columns
    key = lambda r: (str(r.doc_id), r.text or "")
    assert sorted(map(key, same.collect())) == sorted(map(key, edge(spark).collect()))


# -- URL rules -------------------------------------------------------------------------------
def plain_judge(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        raw = re.match(r"[^/?#]*", rest).group()
        host = raw.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
        path = re.match(r"[^?#]*", rest[len(raw):]).group()
    fits = [r for r in rules if r[0] and r[1] is not None
            and (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    if not fits:
        return host, path, None, "allow"
    best = max(fits, key=lambda r: (len(r[0] + r[1]), len(r[0]), r[2]))
    return host, path, best[0] + best[1], best[2]


@pytest.mark.parametrize("many", [False, True])
def test_url_rules_equal_a_plain_search(spark, many):
    rng = random.Random(9)
    rules = list(url_filter.RULES)
    if many:
        hosts = ["a", "b.a", "c.b.a", "x\x01y.a", "b"]
        rules += [(rng.choice(hosts), "/" + "".join(rng.choice("pq/") for _ in range(rng.randint(0, 6))),
                   rng.choice(["allow", "block"])) for _ in range(60)] + [("", "/", "block"), ("a", None, "block")]
    labels = ["a", "b", "c", "org", "example", "com", "EXAMPLE", "", "x\x01y", "é"]
    urls = [None, "", "no scheme", "http://", "http://org", "https://Example.ORG/en/12?x#y",
            "x://y://example.org/es/", "http://notexample.org/es/1", "http://" + "l." * 3000 + "org/"]
    for _ in range(400):
        host = ".".join(rng.choice(labels) for _ in range(rng.randint(1, 4)))
        path = rng.choice(["", "/", "/fr/x", "/de/", "/es/", "/en/1"]) + "".join(
            rng.choice("pq/?#") for _ in range(rng.randint(0, 8)))
        urls.append(f"http://{host}{path}")
    rows = [(i, u) for i, u in enumerate(urls)] + [(1, ""), (1, ""), (None, "http://a.com/fr/")] * 2
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumn("key", F.lit(0))
    got = url_filter.judge(pages.repartition(6), url_filter.rule_table(spark, rules)).collect()
    key = lambda r: tuple(map(str, r))
    assert sorted((r.page_id, r.host, r.path, r.rule, r.verdict) for r in got if r.page_id is not None) \
        .__len__() == len([r for r in rows if r[0] is not None])
    want = [(i, *plain_judge(u, rules)) for i, u in rows]
    assert sorted(map(key, got)) == sorted(map(key, want))


def test_url_rules_without_rows(spark):
    none = spark.createDataFrame([], "page_id long, url string")
    assert url_filter.judge(none, url_filter.rule_table(spark)).count() == 0
    pages = spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string")
    got = url_filter.judge(pages, url_filter.rule_table(spark).limit(0)).head()
    assert (got.rule, got.verdict) == (None, "allow")


# -- secrets ---------------------------------------------------------------------------------
def secret_docs():
    rng = random.Random(4)
    token = lambda n, chars: "".join(rng.choice(chars) for _ in range(n))
    docs, planted = [], {}
    for i in range(240):
        filler = " ".join(rng.choice(["harbour", "letter", "copper", "window"]) for _ in range(20))
        if i % 3 == 0:
            value = token(32, "0123456789abcdef")
            name = rng.choice(["password", "api_key", "token"])
            text = f"{filler} {name}={value} {filler}"
        elif i % 3 == 1:
            value = token(16, "0123456789")
            text = f"{filler} order {value} {filler}"
        else:
            value = "usr/share/docs/chapter2/" + rng.choice(["intro", "index"])
            text = f"{filler} see /{value} {filler}"
        docs.append((i, text))
        planted[i] = i % 3 == 0
    return docs, planted


def test_forest_tells_secrets_from_other_candidates(spark):
    docs, planted = secret_docs()
    rows = spark.createDataFrame(docs, "doc_id long, text string")
    words = secrets_scan.dictionary(spark)
    half = [d for d in docs if d[0] % 2 == 0]
    found = secrets_scan.with_features(secrets_scan.candidates(
        spark.createDataFrame(half, "doc_id long, text string")), words)
    truth = spark.createDataFrame(list(planted.items()), "doc_id long, secret boolean")
    labelled = found.join(truth, "doc_id").withColumn("label", F.col("secret").cast("double")).drop("secret")
    got = secrets_scan.scan(rows, labelled).where("doc_id % 2 = 1").collect()
    assert {r.doc_id for r in got} >= {i for i in planted if i % 2}
    assert sum(r.secret == planted[r.doc_id] for r in got) >= 0.97 * len(got)
    assert all(dict(docs)[r.doc_id][r.start:r.end] for r in got)


def test_secrets_of_edge_rows(spark):
    assert secrets_scan.scan(edge(spark)).count() == 0
    assert secrets_scan.scan(empty(spark)).count() == 0
    one = spark.createDataFrame(
        [(None, "password=hunter2x9"), (None, "password=hunter2x9")], "doc_id long, text string")
    got = secrets_scan.scan(one).collect()
    assert [(r.start, r.end, r.secret) for r in got] == [(9, 18, True)] * 2


def test_long_assigned_values_are_whole(spark):
    rng = random.Random(7)
    value = "".join(rng.choices("abcdefghijABCDEFGHIJ0123456789", k=600))
    texts = [f"see token={value} for more", f"see token='{value[:90]}.{value}.{value[:200]}' for more"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in secrets_scan.candidates(rows).collect()}
    assert secrets_scan.candidates(rows).count() == 2
    assert got[0].value == value and texts[0][got[0].start:got[0].end] == value
    assert got[0].after == " for more"
    assert len(got[1].value) == 892 and got[1].after == "' for more"


# -- toxicity --------------------------------------------------------------------------------
def labelled_texts():
    rng = random.Random(2)
    neutral = ["river", "stone", "market", "letter", "garden", "window", "summer", "bread", "people"]
    texts, labels = [], []
    for i in range(400):
        words = [rng.choice(neutral) for _ in range(15)]
        toxic = i % 4 == 0
        if toxic:
            words[3] = rng.choice(["scum", "idiots", "vermins"])
        if rng.random() < (0.8 if toxic else 0.1):  # a biased sample: one group is named with insults
            words[5] = "muslims"
        texts.append(" ".join(words))
        labels.append(int(toxic))
    return texts, labels


def test_swaps_reduce_the_weight_of_group_names():
    texts, labels = labelled_texts()
    mention = "muslims went to the market in summer"
    plain = toxicity._Scorer(toxicity.fit(texts, labels, penalty=0.0)).scores([mention, "idiots in the garden"])
    fair = toxicity._Scorer(toxicity.fit(texts, labels)).scores([mention, "idiots in the garden"])
    assert fair[0] < 0.3 and fair[0] < plain[0] and fair[1] >= 0.3


def test_scores_of_rows(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    got = {r.doc_id: r for r in toxicity.toxicity(docs, labels).collect()}
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got.values())
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in got.items())
    assert all(r.predicted == (r.score >= 0.3) for r in got.values())


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = toxicity.toxicity(docs, labels).where("held_out").join(labels, "doc_id").collect()
    right = [r.predicted == r.toxic for r in rows]
    toxic = [r.predicted for r in rows if r.toxic]
    assert sum(right) >= 0.98 * len(right) and sum(toxic) >= 0.9 * len(toxic)


def test_toxicity_of_edge_rows(spark):
    labels = spark.createDataFrame([(1, 0), (1, 1), (2, None), (None, 1), (9, 1)], "doc_id long, toxic int")
    got = toxicity.toxicity(edge(spark), labels).collect()
    assert len(got) == len(EDGE) and len({r.score for r in got if r.doc_id in (2, 3, 6)}) == 1
    none = toxicity.toxicity(edge(spark), labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5}
    assert toxicity.toxicity(empty(spark), labels).count() == 0
