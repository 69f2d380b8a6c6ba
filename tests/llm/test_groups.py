"""Operators that look across rows: line templates, near-duplicates, order fingerprints, packing, pipeline."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from pactum.llm import components, line_dedup, minhash, order_minhash, packing, pii, quality
from test_texts import EDGE, edge, empty, plain_counts, plain_spans


def frame(spark, docs):
    return spark.createDataFrame(docs, "doc_id long, text string")


# -- line dedup ------------------------------------------------------------------------------
def plain_line_drop(docs):
    """The template tree, walked in plain code. docs: (doc_id, text) with unique, non-null ids."""
    rows = []
    for i, text in docs:
        lines = (text or "").split("\n")
        for pos, line in enumerate(lines):
            bare = line.strip(" \t\r")
            masked = re.sub(r"[^ ]*[0-9][^ ]*", "<*>", bare)
            tokens = masked.split(" ")
            if len(tokens) >= line_dedup.MIN_TOKENS:
                before = " ".join(lines[pos - 1].split(" ")[:3]) if pos else None
                rows.append((i, pos, tuple(tokens), before, (len(tokens), tuple(tokens[:3]))))
    crowd = Counter(r[4] for r in rows)
    rows = [r for r in rows if crowd[r[4]] >= line_dedup.MIN_PLACES]
    places = defaultdict(set)
    for _, _, tokens, before, _ in rows:
        places[tokens].add(before)
    at = Counter()
    for tokens, own in places.items():
        for p, token in enumerate(tokens):
            at[len(tokens), tokens[:3], p, token] += len(own)
    template = {}
    for tokens in places:
        kept = tuple(t if at[len(tokens), tokens[:3], p, t] >= line_dedup.MIN_PLACES else None
                     for p, t in enumerate(tokens))
        if sum(t is not None for t in kept) >= line_dedup.SIMILARITY * len(tokens):
            template[tokens] = (len(tokens), tokens[:3], kept)
    of = defaultdict(set)
    ids = defaultdict(set)
    for i, _, tokens, before, _ in rows:
        if tokens in template:
            of[template[tokens]].add(before)
            ids[template[tokens]].add(i)
    gone = {(i, pos) for i, pos, tokens, _, _ in rows if tokens in template
            and len(of[template[tokens]]) >= line_dedup.MIN_PLACES
            and len(ids[template[tokens]]) > 1 and min(ids[template[tokens]]) != i}
    return {i: None if text is None else "\n".join(
        x for pos, x in enumerate(text.split("\n")) if (i, pos) not in gone) for i, text in docs}


def templated_docs():
    rng = random.Random(8)
    words = "river stone market letter garden window summer bread copper harbour".split()
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    docs = []
    for i in range(80):
        lines = [prose(rng.randint(6, 14)) for _ in range(4)]
        if i % 2:
            lines.insert(rng.randint(0, 4), f"Posted here by {chr(97 + i % 26)}{chr(97 + i // 26)} on day {i} of the year, all rights kept")
        if i % 5 == 0:
            lines.insert(rng.randint(0, 4), " ".join(["passage"] + words * 6))
        if i % 4 == 0:
            lines.append("Ok then")
        docs.append((i, "\n".join(lines)))
    copy = "\n".join(prose(9) for _ in range(5))
    return docs + [(100 + k, copy) for k in range(12)]


def test_line_drop_equals_the_plain_tree(spark, sf_dir):
    docs = templated_docs()
    got = {r.doc_id: r for r in line_dedup.drop_lines(frame(spark, docs).repartition(5)).collect()}
    want = plain_line_drop(docs)
    assert {i: r.text for i, r in got.items()} == want
    assert "Posted here" in got[1].text and "Posted here" not in got[3].text and got[3].n_dropped >= 1
    assert "passage" in got[0].text and "passage" not in got[5].text
    assert got[105].text == docs[-1][1]  # copies of a document are no boilerplate
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = line_dedup.drop_lines(frame(spark, rows)).collect()
    assert {r.doc_id: r.text for r in got} == plain_line_drop(rows)


def test_line_drop_of_edge_rows(spark):
    rows = edge(spark)
    got = line_dedup.drop_lines(rows)
    assert got.columns == [*rows.columns, "n_lines", "n_dropped"]
    assert sorted((str(r.doc_id), str(r.text)) for r in got.collect()) == sorted(
        (str(i), str(t)) for i, t, _ in EDGE)
    assert line_dedup.drop_lines(empty(spark)).count() == 0
    assert line_dedup.drop_lines(got).columns == got.columns
    line = "all of these words stand in many documents"
    many = frame(spark, [(None, f"{i} a b c\n{line}") for i in range(8)] + [
        (3, f"start w{i} q r\n{line}") for i in range(3)])
    kept = [r for r in line_dedup.drop_lines(many).collect() if line in r.text]
    assert {r.doc_id for r in kept} <= {3, None}


def test_lines_after_a_constant_line_recur(spark):
    rng = random.Random(3)
    prose = lambda: " ".join("".join(rng.choices("abcdefgh", k=7)) for _ in range(9))
    header, footer = "News of the harbour", "Printed by the press\nAt the old market place\nNo part may be copied"
    docs = [(i, f"{header}\n{prose()}\n\nParted by blank lines\n\n{prose()}\n{footer}") for i in range(9)]
    copy = "\n".join(prose() for _ in range(4))
    got = {r.doc_id: r.text for r in line_dedup.drop_lines(
        frame(spark, docs + [(20 + k, copy) for k in range(9)])).collect()}
    assert got[0] == docs[0][1] and got[25] == copy
    for i in range(1, 9):
        lines = docs[i][1].split("\n")
        assert got[i].split("\n") == [lines[1], "", "", lines[5]]


def test_common_values_of_fields_do_not_split_a_template(spark):
    words = "river stone market letter garden window summer bread copper harbour".split()
    rng = random.Random(8)
    prose = lambda: " ".join("".join(rng.choices("abcdefgh", k=7)) for _ in range(9))
    one = lambda: f"Posted here by {rng.choice(words)} on day 7 of the year, all rights kept"
    two = lambda: (f"Shared by the user {rng.choice(words)} from {rng.choice(words)} with all "  # noqa: E731
                   "of you on the pages of this site")
    docs = [(i, f"{prose()}\n{one()}\n{prose()}\n{two()}") for i in range(120)]
    got = {r.doc_id: r.text.split("\n") for r in line_dedup.drop_lines(frame(spark, docs)).collect()}
    assert "\n".join(got[0]) == docs[0][1]
    for i in range(1, 120):
        lines = docs[i][1].split("\n")
        assert got[i] == [lines[0], lines[2]]


def test_short_lines_recur(spark):
    rng = random.Random(6)
    prose = lambda: " ".join("".join(rng.choices("abcdefgh", k=7)) for _ in range(9))
    docs = [(i, f"{prose()}\nRead more\n{prose()}\n\n{i} 20\n17\nShare\nPage {i}") for i in range(8)]
    got = {r.doc_id: r.text.split("\n") for r in line_dedup.drop_lines(frame(spark, docs)).collect()}
    assert "\n".join(got[0]) == docs[0][1]
    for i in range(1, 8):
        lines = docs[i][1].split("\n")
        assert got[i] == [lines[0], *lines[2:6]]


# -- near-duplicates -------------------------------------------------------------------------
def word_sets(docs, width):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = {}
    for i, text in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(lower))
        n = min(width, len(words))
        sets[i] = {tuple(words[k:k + n]) for k in range(len(words) - n + 1)} if words else set()
    return sets


def plain_components(docs, width, percent=80):
    sets = word_sets(docs, width)
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    at = defaultdict(list)
    for i, own in sorted(sets.items()):
        common = Counter()
        for s in own:
            common.update(at[s])
            at[s].append(i)
        for j, n in common.items():
            if 100 * n >= percent * (len(own) + len(sets[j]) - n):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def near_docs():
    rng = random.Random(6)
    words = [f"w{i}" for i in range(3000)]
    docs, at = [], 0

    def add(tokens):
        nonlocal at
        docs.append((at, " ".join(tokens)))
        at += 1

    for _ in range(60):
        add(rng.choices(words, k=rng.randint(1, 80)))
    for size, edits in ((300, 2), (40, 6), (25, 9), (60, 4)):  # edited copies; the origin comes last
        origin = rng.choices(words, k=200)
        for _ in range(size):
            other = list(origin)
            for _ in range(edits):
                other[rng.randrange(200)] = rng.choice(words)
            add(other)
        add(origin)
    chain = rng.choices(words, k=150)  # each is near the next, the ends are far apart
    for _ in range(30):
        add(chain)
        chain = chain[4:] + rng.choices(words, k=4)
    for _ in range(50):
        add(["the", "same", "few", "words", "in", "all"])
    docs.append((at, "The Same FEW words in all"))
    docs += [(at + 1, ""), (at + 2, None), (at + 3, "one"), (at + 4, "One"), (at + 5, "x " * 30_000)]
    return docs


@pytest.mark.parametrize("width", [4, 5])
def test_components_equal_brute_force(spark, width):
    docs = near_docs()
    got = minhash.near_duplicates(frame(spark, docs).repartition(7), width).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == plain_components(docs, width)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got) and len(got) == len(docs)


def test_small_blocks_find_the_same_links(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK_SHINGLES", 900)
    docs = near_docs()
    got = minhash.near_duplicates(frame(spark, docs), 4).collect()
    assert {r.doc_id: r.component_id for r in got} == {
        i: c for i, (_, c) in plain_components(docs, 4).items()}


def test_components_of_a_long_chain(spark):
    rng = random.Random(3)
    ids = rng.sample(range(10_000), 400)
    links = list(zip(ids[:200], ids[1:201])) + list(zip(ids[201:-1], ids[202:])) + [(7, 7)]
    got = {r.node: r.component for r in components.components(
        spark.createDataFrame(links, "a long, b long")).collect()}
    assert {got[i] for i in ids[:201]} == {min(ids[:201])} and {got[i] for i in ids[201:]} == {min(ids[201:])}


def test_near_duplicates_of_edge_rows(spark):
    got = minhash.near_duplicates(edge(spark)).collect()
    assert len(got) == len(EDGE)
    assert {(r.n_shingles, r.kept) for r in got if r.doc_id in (2, 3, 6)} == {(0, True)}
    assert [(r.component_id, r.kept) for r in got if r.doc_id is None] == [(None, True)]
    kept = minhash.keep_one(edge(spark))
    assert kept.columns == edge(spark).columns and kept.count() == len(EDGE)
    assert minhash.near_duplicates(empty(spark)).count() == 0


# -- order fingerprints ----------------------------------------------------------------------
def test_neighbours_and_edits(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    docs += [(10_000, None), (10_001, ""), (10_002, "x"), (10_003, "é😀" * 900)]
    docs.sort()
    got = {r.doc_id: r for r in order_minhash.neighbour_fingerprints(
        frame(spark, docs).repartition(6)).collect()}
    assert len(got) == len(docs)
    for k, (i, text) in enumerate(docs):
        text, other = text or "", docs[(k + 1) % len(docs)][1] or ""
        half = len(text) // 2
        changed = text[:len(text) - half] + other[:half]
        mark, changed_mark, next_mark = map(order_minhash.fingerprint, (text, changed, other))
        assert got[i].n_chars == len(text)
        assert got[i].edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        assert got[i].fingerprint == order_minhash.packed(mark).hex()
        assert got[i].edited_fingerprint == order_minhash.packed(changed_mark).hex()
        assert got[i].near_edited == order_minhash.likeness(mark, changed_mark)
        assert got[i].near_next == order_minhash.likeness(mark, next_mark)


def test_fingerprints_follow_order_not_only_content():
    rng = random.Random(0)
    words = ["".join(rng.choice("abcdefghij") for _ in range(7)) for _ in range(300)]
    text = " ".join(words)
    close = " ".join(words[:150] + ["changed"] + words[151:])
    turned = " ".join(words[150:] + words[:150])
    shuffled = " ".join(rng.sample(words, 300))
    mark = order_minhash.fingerprint(text)
    near = [order_minhash.likeness(mark, order_minhash.fingerprint(t)) for t in (close, turned, shuffled)]
    assert near[0] > 0.9 and near[0] > near[1] > near[2]
    assert (order_minhash.fingerprint("ab" * 500) != order_minhash.fingerprint("ab" * 250)).any()


def test_fingerprints_of_edge_rows(spark):
    rows = edge(spark)
    got = order_minhash.neighbour_fingerprints(rows).collect()
    assert len(got) == len(EDGE)
    assert len({r.fingerprint for r in got if r.doc_id == 1}) == 1
    assert order_minhash.neighbour_fingerprints(empty(spark)).count() == 0
    one = order_minhash.neighbour_fingerprints(frame(spark, [(5, "alone here")])).head()
    assert one.near_next == 1.0 and one.n_chars == 10


# -- packing ---------------------------------------------------------------------------------
def check_packing(rows, lengths, capacities):
    bins = defaultdict(list)
    total = Counter()
    for r in rows:
        total[r.doc_id] += r.length
        if r.length:
            bins[r.bin_id].append((r.bin_offset, r.length, r.bin_size))
        else:
            assert r.bin_id is None
    assert total == Counter(lengths) and set(total) == set(lengths)
    assert sorted(bins) == list(range(len(bins)))
    for parts in bins.values():
        parts.sort()
        at = 0
        for offset, length, _ in parts:
            assert offset == at
            at += length
        assert {s for _, _, s in parts} == {min(c for c in capacities if c >= at)}
    return bins


def test_packing_places_everything_once(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    lengths = {r.doc_id: len(r.text or "") for r in docs.collect()}
    rows = packing.pack(docs).collect()
    bins = check_packing(rows, lengths, packing.CAPACITIES)
    used = sum(lengths.values())
    assert used >= 0.97 * sum(parts[0][2] for parts in bins.values())
    whole = {r.bin_id: r for r in packing.sequences(docs).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    for b, parts in bins.items():
        assert whole[b].used == sum(p[1] for p in parts) == len(whole[b].text)
    for r in rows:
        if r.length:
            at = r.bin_offset
            assert whole[r.bin_id].text[at:at + r.length] == texts[r.doc_id][r.start:r.start + r.length]


def plain_best_fit(items, capacities):
    """One piece at a time; the bin sizes opened are taken from the plan's own rule."""
    counts = Counter(items)
    lengths = sorted(counts)
    space = []
    size = {}
    for length in sorted(items, reverse=True):
        fits = [s for s in space if s >= length]
        if fits:
            at = min(fits)
        else:
            if length not in size:
                size[length] = packing._cheapest(length, dict(counts), lengths, capacities)
            at = size[length]
            space.append(at)
        space.remove(at)
        space.append(at - length)
        counts[length] -= 1
        lengths = sorted(x for x in lengths if counts[x] > 0 or x == length)
        lengths = [x for x in lengths if x <= length]
    return sorted(space)


def test_runs_of_bins_equal_single_steps():
    rng = random.Random(12)
    for _ in range(60):
        capacities = tuple(sorted(rng.sample(range(20, 120), 3)))
        items = [rng.randint(1, capacities[-1]) for _ in range(rng.randint(1, 200))]
        plan = packing.best_fit(Counter(items), capacities)
        assert sum(n for _, n, _ in plan.bins) == plan.n_bins
        assert sum(n * used for _, n, used in plan.bins) == sum(items)
        best = packing.best_fit(Counter(items), capacities[-1:])
        plain = plain_best_fit(items, capacities[-1:])
        spaces = sorted(capacities[-1] - used for _, n, used in best.bins for _ in range(n))
        assert spaces == plain


def test_packing_of_edge_rows(spark, monkeypatch):
    monkeypatch.setattr(packing, "CHUNK", 3)
    rows = edge(spark)
    got = packing.pack(rows).collect()
    check_packing(got, Counter({i: 0 for i, _, _ in EDGE}) | sum(
        (Counter({i: len(t or "")}) for i, t, _ in EDGE), Counter()) | {2: 0, 3: 0}, packing.CAPACITIES)
    same = frame(spark, [(1, "abc")] * 11 + [(2, "xyz")] * 5).repartition(4)
    check_packing(packing.pack(same).collect(), {1: 33, 2: 15}, packing.CAPACITIES)
    assert sum(r.used for r in packing.sequences(same).collect()) == 48
    assert packing.pack(empty(spark)).count() == 0 and packing.sequences(empty(spark)).count() == 0


# -- pipeline --------------------------------------------------------------------------------
def test_pipeline_equals_plain_stages(spark, sf_dir):
    docs = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    words = quality._Words(quality.Vocabularies().paths())
    kept = []
    for i, text, lang in docs:
        row = quality._measure([text or ""], [lang], words, quality.BANDS)[0]
        assert not (row[6] and plain_counts(text)[5])
        if row[6]:
            kept.append((i, text))
    lines = sorted(plain_line_drop(kept).items())
    alone = {i for i, (_, c) in plain_components(lines, 5).items() if i == c}
    left = [(i, t) for i, t in lines if i in alone]
    expected = []
    for i, text in left:
        # No term reaches the support that disclosure asks for in this small table.
        out, at = [], 0
        for kind, a, b in sorted(((k, int(a), int(b)) for k, a, b in (
                s.split(":") for s in plain_spans(text))), key=lambda s: (s[1], s[2])):
            if b <= at:
                continue
            if a >= at:
                out += [text[at:a], pii.LABELS[kind]]
            at = b
        expected.append((i, "".join(out) + text[at:]))
    stored = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stored = spark.createDataFrame(stage(spark, stored, sf_dir).collect(), stored.schema)
        assert stored.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert sorted((r.doc_id, r.text) for r in stored.collect()) == sorted(expected)
    assert all(r.n_chars == len(r.text) for r in stored.collect())
    packed = corpus_pipeline.run(spark, sf_dir).collect()
    assert sum(r.used for r in packed) == sum(len(t) for _, t in expected)
    assert {i for r in packed for i in r.doc_ids} == {i for i, t in expected if t}


def test_pipeline_of_edge_rows(spark):
    docs = edge(spark).withColumnRenamed("n", "n_chars")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "")
    assert docs.columns == edge(spark).withColumnRenamed("n", "n_chars").columns
    docs = empty(spark)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "")
    assert docs.count() == 0


def test_each_line_is_masked_once(spark):
    docs = spark.createDataFrame([("a", "x 1\n2\ny")], "doc_id string, text string")
    leaves = line_dedup._lines(docs).groupBy("leaf").count()
    plan = leaves._jdf.queryExecution().optimizedPlan().toString().lower()
    assert plan.count("regexp_replace") == 1


def test_every_operator_has_one_query():
    names = [n for n in entry.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(re.match(r"op(\d+)_", n).group(1)) for n in names) == list(range(1, 11))
    assert "pipeline" in entry.queries()
