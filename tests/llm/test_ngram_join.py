import re
from collections import defaultdict

import numpy as np
import pytest

from loomgraph.llm import ngram_join as N
from loomgraph.llm.common import windows, word_hashes


def lower(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def shingles(text, width=4):
    w = re.findall("[^\x20\x09-\x0d]+", lower(text or ""))
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())


def brute(rows, percent=85):
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    where = defaultdict(list)
    for i, s in sets.items():
        both = defaultdict(int)
        for g in s:
            for j in where[g]:
                both[j] += 1
            where[g].append(i)
        for j, k in both.items():
            if 100 * k >= percent * (len(s) + len(sets[j]) - k):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def check(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in N.ngram_classes(docs).collect()}
    assert got == brute(rows)


def test_against_brute_force(spark):
    rng = np.random.default_rng(4)
    word = lambda: "w" + str(rng.integers(0, 5000))
    rows, n = [], 0
    for _ in range(30):
        base = [word() for _ in range(rng.integers(3, 400))]
        for _ in range(6):
            copy = list(base)
            for _ in range(rng.integers(0, 1 + len(base) // 25)):
                copy[rng.integers(0, len(copy))] = word()
            rows.append((n, " ".join(copy)))
            n += 1
    rows += [(n, None), (n + 1, ""), (n + 2, " \n\t "), (n + 3, "One"), (n + 4, "one"), (n + 5, "one two three four"), (n + 6, "ONE two\nthree  four"), (n + 7, rows[0][1])]
    check(spark, rows)


def test_copies_that_link_only_through_their_base(spark):
    """A star of copies: each links with the base, few with each other; and a passage that all share."""
    rng = np.random.default_rng(5)
    word = lambda: "v" + str(rng.integers(0, 10**6))
    base = [word() for _ in range(150)]
    shared = [word() for _ in range(40)]
    rows = [(1000, " ".join(base))]
    for i in range(80):
        copy = list(base)
        for at in rng.choice(150, 2, replace=False):
            copy[at] = word()
        rows.append((i, " ".join(copy)))
    rows += [(2000 + i, " ".join([word() for _ in range(60)] + shared)) for i in range(60)]
    check(spark, rows)


def test_very_long_texts(spark):
    """Texts of 40,000 distinct words: near copies link, others that share half don't."""
    words = [f"l{i}" for i in range(40_000)]
    near, far = list(words), words[:20_000] + [f"m{i}" for i in range(20_000)]
    for at in range(0, 40_000, 130):
        near[at] = f"x{at}"
    check(spark, [(1, " ".join(far)), (2, " ".join(words)), (3, " ".join(near)), (4, "short text of its own words")])


def test_chain(spark):
    words = [f"c{i}" for i in range(400)]
    check(spark, [(50 - i, " ".join(words[5 * i : 5 * i + 200])) for i in range(30)])


def test_empty_table_and_clashing_columns(spark):
    assert N.ngram_classes(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    docs = spark.createDataFrame([(1, "a b c d e", 7, 8), (2, "a b c d e", 7, 8), (2, "a b c d e", 7, 8), (None, "a b c d e", 1, 1)], "doc_id long, text string, node long, key long")
    got = sorted((r.doc_id or 0, r.component_id) for r in N.ngram_classes(docs).collect())
    assert got == [(0, 1), (1, 1), (2, 1), (2, 1)]
    assert sorted((r.doc_id or 0) for r in N.keep_one(docs).collect()) == [0, 1]


def test_rows_without_id_keep_their_links(spark):
    """Originals without doc_id, each with edited copies; ids so large that a rounded one is another."""
    rng = np.random.default_rng(6)
    word = lambda: "n" + str(rng.integers(0, 10**6))
    rows, high = [], 2**60
    for g in range(12):
        base = [word() for _ in range(120)]
        rows.append((2 * high + g, " ".join(base)))
        for i in range(2):
            copy = list(base)
            copy[20 + 60 * i] = copy[30 + 60 * i] = word()
            rows.append((high + 3 * g + i, " ".join(copy)))
    want = brute(rows)
    assert len({c for _, c in want.values()}) == 12
    hidden = lambda i: None if i >= 2 * high else i
    docs = spark.createDataFrame([(hidden(i), t) for i, t in rows], "doc_id long, text string").coalesce(1)
    got = sorted((r.doc_id or 0, r.n_shingles, r.component_id) for r in N.ngram_classes(docs).collect())
    assert got == sorted((hidden(i) or 0, n, c) for i, (n, c) in want.items())


def test_one_row_of_each_class_stays_where_ids_repeat(spark):
    a, b, c = "a b c d e f", "g h i j k l", "m n o p q r"
    docs = spark.createDataFrame([(1, a), (1, b), (2, a), (3, c), (3, a), (3, a.upper()), (4, None), (4, ""), (4, c)], "doc_id long, text string")
    kept = sorted((r.doc_id, (r.text or "").lower()) for r in N.keep_one(docs).collect())
    assert kept == [(1, a), (1, b), (3, c), (4, "")]


@pytest.mark.parametrize("percent", [50, 85, 95])
def test_bands_and_bitmaps_lose_nothing(percent):
    bands, rng = N.Bands(percent), np.random.default_rng(percent)
    for _ in range(300):
        n = int(rng.integers(1, 600))
        a = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
        gone = rng.random(len(a)) < rng.random() * 0.3
        b = np.unique(np.concatenate([a[~gone], rng.integers(0, 2**63, int(rng.integers(0, 1 + n // 8)), dtype=np.uint64)]))
        if not len(b):
            continue
        both = len(np.intersect1d(a, b))
        most = (len(a) + len(b) - int(np.bitwise_count((N.bitmap(a) ^ N.bitmap(b)).view(np.uint64)).sum())) // 2
        assert most >= both
        if 100 * both >= percent * (len(a) + len(b) - both) and not np.array_equal(a, b):
            assert abs(bands.of(len(a)) - bands.of(len(b))) <= 1
            assert len(np.intersect1d(N.segment_keys(a, bands), N.segment_keys(b, bands)))


def test_word_hashes_of_blocks(monkeypatch):
    text = " ".join("x" * (i % 50 + 1) + str(i) for i in range(5000)).encode()
    whole = word_hashes(text)
    import loomgraph.llm.common as C

    monkeypatch.setattr(C, "_BLOCK", 777)
    assert np.array_equal(whole, word_hashes(text)) and len(whole) == 5000
    assert len(np.unique(windows(whole, 4))) == 4997
