"""Deduplication and decontamination against plain versions, on awkward rows."""

import random
import time

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from hearth.llm import components, decontaminate, induced_sort, line_dedup, minhash, substring_dedup

EXTRA = "doc_id bigint, text string, key string, cls int, spans string, n_lines string, kept boolean, batch int, token int"


def frame(spark, rows):
    """With further columns that bear names the operators use themselves."""
    return spark.createDataFrame([(i, t, "x", 1, None, "y", False, 7, 3) for i, t in rows], EXTRA)


def awkward(seed=5):
    """Copies, near copies, shared lines and passages, ties, nulls and long texts."""
    rng = random.Random(seed)
    words = ["the", "and", "of", "é", "Straße", "x1", "=", "漢字"] + ["w%d" % i for i in range(60)]
    prose = lambda n: " ".join(rng.choices(words, k=n))
    line = "A common line of Boilerplate that is long enough to count, surely"
    base = prose(200)
    rows = [(None, None), (None, base), (1, None), (2, ""), (3, "\n\n"), (4, " "), (5, "a"), (6, "one two three")]
    rows += [(7, "One  two\tthree"), (8, "x" * 300), (9, "x" * 120), (10, "y " * 400), (11, "y " * 150)]
    rows += [(20 + i, base) for i in range(6)] + [(20, base), (21, "other text of a repeated id " * 4)]
    for i in range(30):
        own = base.split(" ")
        for _ in range(rng.randint(0, 6)):
            own[rng.randrange(len(own))] = "edit%d" % rng.randrange(1000)
        rows.append((100 - i, " ".join(own)))
    for i in range(12):
        rows.append((200 + i, "\n".join([prose(5), "  " * (i % 3) + (line.upper() if i % 2 else line) + "\t", prose(4)] * (1 + i % 2))))
    rows += [(300 + i, prose(40) + " " + " ".join(base.split(" ")[50:62]) + " " + prose(30)) for i in range(8)]
    rows += [(400, prose(6000)), (401, prose(6000) + " " + base)]
    rng.shuffle(rows)
    return rows


def key(row):
    return repr(row)


def test_lines(spark):
    rows = awkward()
    found = line_dedup.drop_frequent_lines(frame(spark, rows))
    assert set(found.columns) == {"n_dropped", "kept_text", *frame(spark, []).columns}
    got = [tuple(r) for r in found.select("doc_id", "n_lines", "n_dropped", "kept_text").collect()]
    expected = brute.line_dedup(rows)
    assert sum(r[2] for r in expected) > 10
    assert sorted(got, key=key) == sorted(expected, key=key)


@pytest.mark.parametrize("batches, fanout", [(1, 2), (3, 2), (7, 3)])
def test_line_batches(spark, batches, fanout):
    rows = awkward(6)
    found = line_dedup.drop_frequent_lines(frame(spark, rows), min_chars=3, min_docs=2, batches=batches, fanout=fanout)
    got = [tuple(r) for r in found.select("doc_id", "n_lines", "n_dropped", "kept_text").collect()]
    assert sorted(got, key=key) == sorted(brute.line_dedup(rows, 3, 2), key=key)


@pytest.mark.parametrize("percent, block", [(85, 128), (80, 4), (100, 2)])
def test_near_duplicates(spark, percent, block):
    rows = awkward()
    found = minhash.near_duplicates(frame(spark, rows), percent=percent, block=block)
    expected = brute.near_duplicates(rows, percent)
    assert sorted(map(tuple, found.collect()), key=key) == sorted(expected, key=key)


def test_bayesian_bounds():
    plan = minhash.Plan()
    steps = plan.least_matches()
    assert steps[-1][0] == plan.hashes and all(0 < m < n for n, m in steps)
    rng = np.random.default_rng(1)
    for n, least in steps:  # a pair at the threshold is hardly ever below the bound
        assert (rng.binomial(n, 0.85, 200_000) < least).mean() < 1e-4
    assert (1 - 0.85**plan.rows) ** plan.bands <= plan.miss


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 460)] + [(0, i) for i in range(500, 540)]
    name = {}

    def root(x):
        while name.setdefault(x, x) != x:
            x = name[x]
        return x

    for u, v in edges:
        name[max(root(u), root(v))] = min(root(u), root(v))
    linked = {x for u, v in edges for x in (u, v) if u != v}
    found = components.components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()
    assert {(r.node, r.component) for r in found} == {(x, root(x)) for x in linked} and len(found) == len(linked)
    assert components.components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def test_contamination(spark):
    rows = awkward()
    base = next(t for i, t in rows if i == 22)
    items = [(1, " ".join(base.split(" ")[48:70])), (1, "x1"), (2, None), (3, ""), (4, "THE! (and) of"), (10, "one TWO three"),
             (9, " ".join(base.split(" ")[100:115])), (11, "never seen words at all"), (None, base[:200]), (5, "y " * 12), (5, "y " * 12)]
    benchmark = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id bigint, text string, words int")
    found = decontaminate.find_contamination(frame(spark, rows), benchmark)
    got = [(r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in found.collect()]
    assert all(r.contaminated == (r.n_hit > 0) for r in found.collect())
    assert sorted(got, key=key) == sorted(brute.contamination(rows, items), key=key)


@pytest.mark.parametrize("match, anchor", [(50, 16), (20, 7), (3, 3), (1, 1)])
def test_repeats(spark, match, anchor):
    rows = [r for r in awkward() if len(r[1] or "") < 3000]
    found = substring_dedup.find_repeats(frame(spark, rows), match=match, anchor=anchor)
    got = [(r.doc_id, r.n_bytes, r.n_removed, [tuple(s) for s in r.spans], r.kept_sha256) for r in found.collect()]
    assert sorted(got, key=key) == sorted(brute.repeats(rows, match), key=key)


@pytest.mark.parametrize("match, anchor", [(50, 16), (20, 7), (3, 3)])
def test_repeats_around_split_anchors(spark, match, anchor):
    rows = [r for r in awkward() if len(r[1] or "") < 3000]
    found = substring_dedup.find_repeats(frame(spark, rows), match=match, anchor=anchor, group=2 * (2 * match - anchor + 1))
    got = [(r.doc_id, r.n_bytes, r.n_removed, [tuple(s) for s in r.spans], r.kept_sha256) for r in found.collect()]
    assert sorted(got, key=key) == sorted(brute.repeats(rows, match), key=key)


def test_split_strings_with_one_hash_in_common():
    """Strings of a split anchor are equal only if both hashes are."""
    rows = [(7, 11, 1), (7, 12, 2), (7, 11, 3), (7, 12, 4), (8, 12, 5), (9, 13, 6)]  # anchor, content, doc_id
    e = {"anchor": np.array([r[0] for r in rows], np.uint64), "content": np.array([r[1] for r in rows], np.uint64)}
    e |= {"doc_id": np.array([r[2] for r in rows]), "first": np.zeros(len(rows), bool), "length": np.full(len(rows), 50, np.uint16)}
    e |= {"start": np.arange(len(rows), dtype=np.uint32), "home": np.zeros(len(rows), np.int32), "low": np.zeros(len(rows), np.uint32)}
    gone = [int(p) for piece, _, _ in substring_dedup._decide(e, [], 50) for p in piece]
    assert sorted(gone) == [2, 3]
    # the two hashes of a string do not follow from one another
    data = np.frombuffer(random.Random(1).randbytes(5000), np.uint8)
    starts, one, two = substring_dedup._strings(data, np.array([0]), np.array([4900]), 50)
    assert len(set(one.tolist())) == len(set(two.tolist())) == len(starts) == 4900
    again = substring_dedup._strings(np.concatenate([data[100:200], data]), np.array([0, 100]), np.array([50, 150]), 50)
    assert again[2][:50].tolist() == two[100:150].tolist() and again[1][:50].tolist() == one[100:150].tolist()


def test_repeats_of_a_common_phrase(spark):
    """A phrase one byte short of a match, with other text around it in each of many documents."""
    rng = random.Random(8)
    own = lambda: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=40))
    phrase = "A phrase that all have; 49 bytes, one short of it"
    rows = [(i, own() + phrase + ("" if i % 9 else "!") + own()) for i in range(9000)]
    docs = frame(spark, rows)
    texts = spark.table(substring_dedup._table(spark, docs.select("doc_id", "text")))
    shared = substring_dedup._shared_anchors(texts, 8, 50, 24).join(texts.select("cls", "digest"), "cls").drop("cls")
    bytes_of = {}
    for row in substring_dedup._pieces(texts.join(shared, "digest"), 8, 50, 24).collect():
        arrays = [np.frombuffer(row[name], dtype=substring_dedup._PIECE_KINDS[name]).tolist() for name in ("anchor", "content", "length")]
        for a, content, length in zip(*arrays):
            bytes_of.setdefault(a, {})[content] = length + 1
    assert bytes_of and max(sum(found.values()) for found in bytes_of.values()) <= substring_dedup.GROUP_BYTES
    found = substring_dedup.find_repeats(docs)
    got = [(r.doc_id, r.n_bytes, r.n_removed, [tuple(s) for s in r.spans], r.kept_sha256) for r in found.collect()]
    expected = brute.repeats(rows)
    assert sum(r[2] > 0 for r in expected) > 900
    assert sorted(got, key=key) == sorted(expected, key=key)


def test_induced_sort():
    rng = random.Random(3)
    for _ in range(600):
        n, k = rng.randint(0, 60), rng.choice([1, 2, 3, 5, 50])
        text = [rng.randint(1, k) for _ in range(n)]
        text = ((text[: n // 3] * 4)[:n] if rng.random() < 0.3 else text) + [0]
        order, shared = induced_sort.suffix_order(np.array(text), memory=rng.choice([3, 1000]), aim=rng.choice([1, 4, 1000]))
        expected = sorted(range(len(text)), key=lambda i: text[i:])
        assert order.tolist() == expected
        for at, (a, b) in enumerate(zip(expected, expected[1:]), 1):
            common = next(i for i in range(len(text)) if text[a + i : a + i + 1] != text[b + i : b + i + 1])
            assert shared[at] == common


def test_empty_tables(spark):
    docs, benchmark = frame(spark, []), spark.createDataFrame([], "item_id bigint, text string")
    assert line_dedup.drop_frequent_lines(docs).count() == 0
    assert minhash.near_duplicates(docs).count() == 0
    assert decontaminate.find_contamination(docs, benchmark).count() == 0
    assert substring_dedup.find_repeats(docs).count() == 0
    some = frame(spark, [(1, "some words"), (None, None)])
    assert [r.n_hit for r in decontaminate.find_contamination(some, benchmark).collect()] == [0, 0]


def test_lines_of_long_texts(spark):
    """The kept lines of a text cost no more than sorting its lines: five texts of 40,000 lines."""
    lines = [f"a common line number {i} that is long enough to count as one" for i in range(20_000)]
    rows = []
    for d in range(6):
        own = [line for i, line in enumerate(lines) if d < 5 or i % 3] + [f"own line {d} {i}" for i in range(20_000)] + lines[:100]
        random.Random(d).shuffle(own)
        rows.append((d, "\n".join(own)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    begin = time.time()
    found = sorted((r.doc_id, r.n_lines, r.n_dropped, r.kept_text) for r in line_dedup.drop_frequent_lines(docs).collect())
    assert time.time() - begin < 60
    assert found == sorted(brute.line_dedup(rows))


def test_places_and_rest_of_lists(spark):
    rng, rows = random.Random(2), []
    for _ in range(300):
        lines = [rng.choice(["a", "b", "c", "d", "e", None]) for _ in range(rng.randint(0, 12))]
        rows.append((lines, sorted({x for x in lines if x and rng.random() < 0.5})))
    df = spark.createDataFrame(rows, "lines array<string>, keys array<string>")
    places = line_dedup._places(F.col("lines"), F.col("keys"))
    found = df.select("lines", "keys", line_dedup.let(places, lambda p: F.struct(p.alias("p"), line_dedup._without(F.col("lines"), p).alias("rest"))).alias("x"))
    for r in found.collect():
        assert r.x.p == [i for i, x in enumerate(r.lines) if x in r["keys"]]
        assert r.x.rest == [x for x in r.lines if x not in r["keys"]]


def near_copies(n, seed):
    """A base text and copies that each change a few words of their own."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(10**6)}" for _ in range(300)]
    rows = [(0, " ".join(base))]
    for i in range(1, n):
        own = list(base)
        for _ in range(rng.randint(1, 4)):
            own[rng.randrange(len(own))] = f"edit{rng.randrange(10**6)}"
        rows.append((i, " ".join(own)))
    return rows


def test_rows_dealt_for_a_group_of_near_copies(spark, monkeypatch):
    """They grow with the group, not with its square, and the group is still one."""
    dealt, write = [], minhash.stage

    def spied(df, label):
        out = write(df, label)
        if label == "dealt":
            dealt[-1] += out.count()
        return out

    monkeypatch.setattr(minhash, "stage", spied)
    for n in (256, 1024):
        dealt.append(0)
        rows = near_copies(n, 1)
        found = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), block=16).collect()
        assert {r.component_id for r in found} == {0} and sum(r.kept for r in found) == 1
    assert dealt[1] < dealt[0] * 4 * 1.3, dealt


def test_members_joined_by_no_pivot(spark, monkeypatch):
    """Chains and several clusters in one group, with pivots that join little."""
    monkeypatch.setattr(minhash, "PIVOTS", 1)
    monkeypatch.setattr(minhash, "PIVOT_PARTS", 1)
    rng, rows = random.Random(7), []
    for cluster in range(3):
        text = [f"c{cluster}w{rng.randrange(10**6)}" for _ in range(120)] + [f"common{i}" for i in range(90)]
        for _ in range(40):  # each differs a little from the one before
            text = list(text)
            for _ in range(3):
                text[rng.randrange(120)] = f"edit{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(text)))
    found = minhash.near_duplicates(frame(spark, rows), percent=80, block=8).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in found) == sorted(brute.near_duplicates(rows, percent=80))
