"""Phrases, conversation repair and the grouped prefix join beside plain programs."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from pactum.llm import checks, components, conversation_repair as repair, ngram_join, phrases
from test_texts import EDGE, edge, empty


def sql_rows(query, **tables):
    con = duckdb.connect()
    for name, table in tables.items():
        con.register(name, table.toArrow())
    return sorted(map(str, con.execute(query).fetchall()))


# -- conversation repair ---------------------------------------------------------------------
PATTERN = re.compile(r"(s?(ua)+)?")


def every_repair(codes):
    """The least (cost, audit) over all edit sequences with at most two insertions per gap."""
    def edits(code):
        yield 3, "D", ""
        if code != "d":
            extra = code.isupper()
            yield int(extra), "K", code.lower()
            for role in "ua":
                yield 2 + int(extra), "R", role

    gaps = [(2 * k, "I" * k, "".join(x)) for k in range(3) for x in itertools.product("ua", repeat=k)]
    best = None
    for picks in itertools.product(gaps, *[list(itertools.product(edits(c), gaps)) for c in codes]):
        steps = [picks[0], *[x for pick in picks[1:] for x in pick]]
        if PATTERN.fullmatch("".join(s[2] for s in steps)):
            found = (sum(s[0] for s in steps), "".join(s[1] for s in steps))
            best = min(best or found, found)
    return best


def full_cyk(codes):
    """Cells over all spans and all ways to cut them."""
    n = len(codes)
    cell = {(i, i + 1): repair.one_row(codes[i]) for i in range(n)}
    for length in range(2, n + 1):
        for i in range(n - length + 1):
            found = {}
            for cut in range(i + 1, i + length):
                for pair, x in repair.combine(cell[i, cut], cell[cut, i + length]).items():
                    repair._less(found, pair, x)
            cell[i, i + length] = found
    return {pair: x[:2] for pair, x in cell[0, n].items()}


def test_cells_equal_all_cuts_and_all_edits():
    rng = random.Random(5)
    for n in (1, 2, 3):
        for codes in itertools.product("suaxSUd", repeat=n) if n < 3 else [rng.choices("suaxUAd", k=3) for _ in range(25)]:
            cells = repair.parse("".join(codes))
            assert min(x[:2] for (p, q), x in cells.items() if p == 0 and q in repair.ENDS) == every_repair(codes)
    for n in range(4, 24):
        codes = "".join(rng.choices("suaxSUAXd", k=n))
        assert {k: v[:2] for k, v in repair.parse(codes).items()} == full_cyk(codes)
        parts = [repair.parse(codes[:n // 3], 0), repair.parse(codes[n // 3:], 1)]
        assert {k: v[:2] for k, v in repair.by_length(parts).items()} == full_cyk(codes)


def conversations(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def odd_conversations():
    rng = random.Random(11)
    texts = ["Well said.", "no end", " \t", "", None, "Same?", "tail. \n", "日本。", "Ok!"]
    rows = []
    for c in [*range(60), None]:
        for t in range(rng.randint(1, 7)):
            turn = None if rng.random() < 0.1 else rng.randint(0, 6)
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None, "sage", ""])
            rows.append((c, turn, role, rng.choice(texts)))
    return rows + rows[:20]


def test_reports_equal_the_sql_walk(spark, monkeypatch):
    rows = odd_conversations()
    # One long conversation that is cut into many chunks, combined over several levels.
    rng = random.Random(2)
    rows += [(99, t, rng.choice(["user", "assistant", "system"]), rng.choice(["A.", "b", "", f"{t % 9}!"]))
             for t in range(400)]
    df = conversations(spark, rows)
    want = sql_rows(checks.STRUCTURE_REPAIR, conversations=df)
    for chunk_bits, fan_bits in ((9, 8), (2, 1)):
        monkeypatch.setattr(repair, "CHUNK_BITS", chunk_bits)
        monkeypatch.setattr(repair, "FAN_BITS", fan_bits)
        got = repair.report(df.withColumn("at", F.lit(1)).withColumn("cells", F.lit("x")).repartition(5))
        assert sorted(str(tuple(r)) for r in got.collect()) == want


def test_conversations_that_vanish_and_empty_tables(spark):
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    row = repair.report(conversations(spark, [(gone, 0, "user", "Hello.")])).collect()
    assert [tuple(r) for r in row] == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    assert repair.report(conversations(spark, [])).count() == 0


def test_repaired_rows_follow_the_pattern(spark):
    rows = [r for r in odd_conversations() if r[2] is not None and r[3] is not None]
    got = repair.repair(conversations(spark, rows)).orderBy("conv_id", "place").collect()
    for key, own in itertools.groupby(got, key=lambda r: r.conv_id):
        own = list(own)
        assert PATTERN.fullmatch("".join(r.role[0] for r in own)), key
        assert [r.place for r in own] == list(range(len(own)))
        assert all(r.text == "" for r in own if r.edit == "I")
        kept = [(r.role, r.text) for r in own if r.edit == "K"]
        assert not Counter(kept) - Counter((r[2], r[3]) for r in rows if r[0] == key)


# -- phrases ---------------------------------------------------------------------------------
def phrase_docs():
    rng = random.Random(4)
    words = "river stone market of the letter İstanbul GARDEN a b x".split(" ")
    fixed = ["one two three four five six seven eight", "of the market", "a a a a a a a a"]
    docs = []
    for i in range(160):
        pieces = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 12))) for _ in range(5)]
        pieces.insert(rng.randint(0, 5), rng.choice(fixed))
        docs.append((i, rng.choice(".,;:!?\n\r\x0b\x0c").join(pieces), rng.choice(["en", "de", None, "und"])))
    return docs


def test_phrases_equal_the_sql_count(spark):
    docs = spark.createDataFrame(phrase_docs(), "doc_id long, text string, lang string")
    docs = docs.union(edge(spark).select("doc_id", "text", "lang").where("length(text) < 1000 or text is null"))
    for least in (5, 12):
        query = checks.COLLOCATIONS.replace("AND f >= 100)", f"AND f >= {least})")
        got = phrases.collocations(docs.withColumn("gram", F.lit(1)).repartition(3), least=least)
        assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
        assert sorted(str(tuple(r)) for r in got.collect()) == sql_rows(query, documents=docs)
    top = phrases.collocations(docs, least=5, top=3).collect()
    assert max(r.rank for r in top) == 3


def test_grams_do_not_depend_on_slices_or_bits(spark, monkeypatch):
    docs = spark.createDataFrame(phrase_docs(), "doc_id long, text string, lang string")
    rows = lambda df: sorted(map(tuple, df.collect()))
    want = rows(phrases.gram_counts(docs, 5)[0])
    full = lambda bits, hashes: [True] * len(hashes)
    monkeypatch.setattr(phrases, "SLICE", 50)
    monkeypatch.setattr(phrases, "_held", lambda bits, h: __import__("numpy").array(full(bits, h), bool))
    assert rows(phrases.gram_counts(docs, 5)[0]) == want  # nothing is left out by the bits


def test_unary_paths_are_compacted(spark):
    text = "one two three four five six seven eight nine. " * 20 + "zero one two three four. " + "a a a a a a a a."
    docs = spark.createDataFrame([(1, text, "en")], "doc_id long, text string, lang string")
    counts, _ = phrases.gram_counts(docs, 4)
    paths = {r.phrase: r.f for r in phrases.compacted_paths(counts).collect()}
    # The first node also ends a piece after "zero", so the path is whole from its first edge on;
    # "a a a a" ends a piece as well as going on, so its edge stays by itself.
    assert paths == {"one two three four five six seven eight nine": 20, "a a a a a": 4}
    kept = {r.gram for r in phrases.candidates(counts, 4).collect()}
    assert "three four five six" not in kept and "one two three four five" in kept
    assert "one two three four" in kept  # 21 times


def test_phrases_of_edge_rows(spark):
    assert phrases.collocations(empty(spark)).count() == 0
    got = {(r.lang, r.phrase, r.a) for r in phrases.collocations(edge(spark), least=50).collect()}
    assert ("de", "wort wort wort wort wort", 19_996) in got


# -- grouped prefix join ---------------------------------------------------------------------
def plain_groups(docs, width, percent):
    grams = []
    for _, text in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        size = min(width, len(words))
        grams.append({tuple(words[i:i + size]) for i in range(len(words) - size + 1)} if words else set())
    at = list(range(len(docs)))

    def find(i):
        while at[i] != i:
            i = at[i]
        return i

    for i, j in itertools.combinations(range(len(docs)), 2):
        x, y = grams[i], grams[j]
        a, b = docs[i][0], docs[j][0]
        if x and y and None not in (a, b) and (a == b or 100 * len(x & y) >= percent * len(x | y)):
            at[find(j)] = find(i)
    least = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return Counter((d, len(grams[i]), None if d is None else least[find(i)]) for i, (d, _) in enumerate(docs))


def near_copies(seed=1, origins=12, copies=14):
    """Copies with one to many edits, some of which share a passage."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choices("abcdefgh", k=4)) for _ in range(300)]
    passage = rng.choices(vocabulary, k=30)
    docs = []
    for o in range(origins):
        origin = rng.choices(vocabulary, k=rng.choice([3, 12, 60, 150])) + (passage if o % 2 else [])
        for _ in range(copies):
            words = list(origin)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            docs.append(" ".join(words[rng.choice([0, 0, 1]):]))
    rng.shuffle(docs)
    return list(enumerate(docs))


@pytest.mark.parametrize("width,percent,block", [(3, 90, 600_000), (3, 90, 900), (5, 80, 3_000)])
def test_groups_equal_all_pairs(spark, monkeypatch, width, percent, block):
    monkeypatch.setattr(ngram_join, "BLOCK_BYTES", block)
    monkeypatch.setattr(ngram_join, "FREQUENT", 3 if block < 1000 else 16)
    docs = near_copies(seed=width + block) + [(i, t) for i, t, _ in EDGE] + [(5, "one two three"), (700, "A b c"), (701, "a B C")]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("n", F.lit(7)).withColumn("bits", F.lit(1))
    got = Counter(tuple(r) for r in ngram_join.similar_groups(df.repartition(4), width, percent).collect())
    assert got == plain_groups(docs, width, percent)


def test_one_large_group_of_near_copies(spark):
    """Neighbours differ in one word, ends in many: one component by a long way."""
    rng = random.Random(9)
    words = [f"w{i}" for i in range(90)]
    docs = []
    for i in range(120):
        words[rng.randrange(90)] = f"x{i}"
        docs.append((i, " ".join(words)))
    got = Counter(tuple(r) for r in ngram_join.similar_groups(
        spark.createDataFrame(docs, "doc_id long, text string"), 3, 90).collect())
    assert got == plain_groups(docs, 3, 90)


def test_no_join_sends_a_side_to_the_driver(spark, monkeypatch):
    """Sizes that Spark expects are far too low after an explode, so no join may go by them."""
    plans = []
    store = ngram_join.store
    plan = lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString())

    def watched(df, name):
        plan(df)
        return store(df, name)

    monkeypatch.setattr(ngram_join, "store", watched)
    monkeypatch.setattr(components, "store", watched)
    df = spark.createDataFrame(near_copies(seed=2), "doc_id long, text string")
    plan(ngram_join.similar_groups(df, 3, 90))
    assert sum("Join" in p for p in plans) > 8
    assert not [p for p in plans if "Broadcast" in p]


def test_join_of_an_empty_table(spark):
    assert ngram_join.similar_groups(empty(spark)).count() == 0


def test_parity_bits_never_reject():
    import numpy as np

    rng = np.random.default_rng(3)
    for size in (1, 5, 40, 700):
        x = np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64))
        y = np.unique(np.concatenate([x[:-1 - size // 9], rng.integers(0, 1 << 63, 1 + size // 5, dtype=np.uint64)]))
        p, q = ngram_join.parity_bits(x), ngram_join.parity_bits(y)
        least = min(len(p), len(q))
        bits = int(np.bitwise_count(ngram_join.folded(p, least) ^ ngram_join.folded(q, least)).sum())
        assert bits <= len(np.setxor1d(x, y))
