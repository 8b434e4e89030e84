import hashlib
import random
import zlib
from collections import Counter
from itertools import combinations, permutations

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from loomgraph.llm import filter_audit
from loomgraph.llm.filter_audit import audit, block_hashes, failure_masks
from loomgraph.llm.itemsets import closed_itemsets
from loomgraph.llm.packing import best_fit, joined, pack, powers, read_vocabulary, sequences

OUT = ("items", "n_items", "support", "n_rules", "best_item", "rules_sha256")


def plain_itemsets(rows, least, share, confidence):
    baskets = {}
    for b, i in rows:
        if b is not None and i is not None:
            baskets.setdefault(b, set()).add(i)
    n = len(baskets)
    holds = {}
    for b, items in baskets.items():
        for i in items:
            holds.setdefault(i, set()).add(b)
    enough = lambda t: len(t) >= least and len(t) * share >= n
    found = {}

    def grow(x, t, rest):
        found[x] = len(t)
        for k, i in enumerate(rest):
            if enough(both := t & holds[i]):
                grow((*x, i), both, rest[k + 1 :])

    singles = sorted(i for i in holds if enough(holds[i]))
    for k, i in enumerate(singles):
        grow((i,), holds[i], singles[k + 1 :])
    out = set()
    for x, s in found.items():
        if any(found.get(tuple(sorted((*x, i)))) == s for i in singles if i not in x):
            continue
        rules = []
        for c in x if len(x) > 1 else ():
            a = found[tuple(i for i in x if i != c)]
            if 100 * s >= confidence * a and s * n > a * len(holds[c]):
                rules.append((c, a, len(holds[c])))
        best = min(((a, c) for c, a, _ in rules), default=(None, None))[1]
        out.add((",".join(map(str, x)), len(x), s, len(rules), best, hashlib.sha256(";".join(f"{c}:{a}:{k}" for c, a, k in rules).encode()).hexdigest()))
    return out


def itemsets(spark, rows, least, share=10_000, confidence=30):
    df = spark.createDataFrame(rows, "basket long, item long")
    return [tuple(r) for r in closed_itemsets(df, least, share, confidence).select(*OUT).collect()]


def test_itemsets_against_every_subset(spark):
    for seed, least, share in ((1, 4, 10_000), (2, 6, 10_000), (3, 2, 20)):
        dice = random.Random(seed)
        rows = [(b, i) for b in range(70) for i in dice.sample(range(9), dice.randint(1, 5))]
        # Items that go together always, or with one exception; a basket of everything, and large ones.
        rows += [(b, i) for b in range(100, 112) for i in (20, 21, 22, 3)] + [(120, 20), (120, 21)]
        rows += [(b, i) for b in (200, 201) for i in range(60)]
        rows += [(b, -1) for b in range(70)] + rows[:40] + [(None, 1), (5, None)]
        got = itemsets(spark, rows, least, share)
        assert len(got) == len(set(got))
        assert set(got) == plain_itemsets(rows, least, share, 30)
        assert any(r[1] >= 3 for r in got)


def test_itemsets_that_one_large_basket_completes(spark):
    # 11 small baskets and a large one: only with the large one is the pair frequent, and an item is in all small baskets but not in the large one.
    rows = [(b, i) for b in range(11) for i in (1, 2, 3)] + [(99, i) for i in range(500) if i != 3] + [(b, 3) for b in range(50, 60)]
    got = itemsets(spark, rows, 12)
    assert set(got) == plain_itemsets(rows, 12, 10_000, 30)
    assert ("1,2", 2, 12) in {r[:3] for r in got}


def test_itemsets_of_nothing_and_of_an_item_in_all_baskets(spark):
    assert itemsets(spark, [], 12) == []
    assert itemsets(spark, [(None, None), (1, 2)], 2) == []
    rows = [(b, i) for b in range(20) for i in (7, b % 2)]
    assert set(itemsets(spark, rows, 5)) == plain_itemsets(rows, 5, 10_000, 30)


def test_itemsets_of_clashing_columns(spark):
    rows = spark.createDataFrame([(b, i, "x", 1) for b in range(12) for i in (1, 2)], "basket int, item int, rank string, support int")
    assert [tuple(r)[:3] for r in closed_itemsets(rows).collect()] == [("1,2", 2, 12)]


@pytest.fixture(scope="module")
def tokens():
    return read_vocabulary(public_tokenizers.path("byte_bpe_50k.json"))


def reference_ids():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return lambda text: [*t.encode(text, add_special_tokens=False).ids, 1]


def hold_packing(rows, texts, width=2048):
    """Each id in exactly one piece, sequences without gaps; returns the padding."""
    ids = reference_ids()
    want = Counter()
    for d, t in texts:
        want[d, tuple(ids(t or ""))] += 1
    by_doc, by_sequence = {}, {}
    for r in rows:
        assert r["length"] > 0 and r["ids_crc32"] == zlib.crc32(np.array(r["ids"], dtype="<u4").tobytes())
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for d, pieces in by_doc.items():
        whole = [w for (k, w), n in want.items() if k == d for _ in range(n)]
        starts = Counter()
        for p in pieces:
            fits = [w for w in set(whole) if len(w) == p["doc_tokens"] and list(w[p["start"] : p["start"] + p["length"]]) == p["ids"]]
            assert fits
            starts.update(range(p["start"], p["start"] + p["length"]))
        assert starts == Counter(i for w in whole for i in range(len(w)))
    assert set(by_doc) == {d for d, _ in texts}
    padding = 0
    for parts in by_sequence.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= width
        padding += 0 if at.bit_count() == 1 else width - at
    return padding


def test_packing_of_a_table(spark, tokens):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = pack(docs, tokens, public_tokenizers.PATTERN, keep_ids=True).collect()
    padding = hold_packing(rows, [(r["doc_id"], r["text"]) for r in docs.collect()])
    assert padding < 0.01 * sum(r["length"] for r in rows)


def test_packing_edges(spark, tokens):
    texts = [(1, None), (2, ""), (3, "a"), (3, "a"), (None, "no id <|endoftext|> here"), (4, "word " * 9_000), (5, "\n\n a  b \t c  d\x1c e  "), (6, "x" * 20_000), (7, " lead"), (8, "trail "), (9, "ä ö  ü 漢字 🙂 it's we'll 12 345,6")]
    df = spark.createDataFrame(texts, "doc_id long, text string").withColumns({"start": F.lit("clash"), "ids": F.lit(1)}).coalesce(1)
    rows = pack(df, tokens, public_tokenizers.PATTERN, keep_ids=True).collect()
    assert hold_packing(rows, texts) <= 2048 // 64 * len({r["sequence_id"] for r in rows})
    assert pack(df.limit(0), tokens, public_tokenizers.PATTERN).collect() == []


def test_ids_equal_the_tokenizer_on_every_text(tokens):
    import pyarrow.parquet as pq

    from loomgraph.llm.packing import Encoder

    encoder, ids = Encoder(tokens, public_tokenizers.PATTERN), reference_ids()
    for text in pq.read_table("/root/testdata/sf0.01/documents.parquet").column("text").to_pylist():
        assert np.frombuffer(encoder.encode(text or ""), dtype="<u4").tolist() == ids(text or "")[:-1]
    dice = random.Random(5)
    for _ in range(3_000):
        text = "".join(dice.choice([" ", " ", "\n", "\t", "\x1c", " ", " ", "a", "Bc", "'s", "'", "9", "é", "漢", "#", "🙂", "<|endoftext|>"]) for _ in range(dice.randint(0, 14)))
        assert np.frombuffer(encoder.encode(text), dtype="<u4").tolist() == ids(text)[:-1], repr(text)


def test_best_fit_takes_the_tightest_window():
    dice = random.Random(3)
    for width in (16, 100, 2048):
        lengths = [dice.randint(1, 3 * width) for _ in range(300)]
        got = best_fit(lengths, width)
        # A plain search over all open windows.
        rooms, count = [], sum(n // width for n in lengths)
        for n in sorted((n % width for n in lengths if n % width), reverse=True):
            fit = min((r for r in rooms if r >= n), default=None)
            if fit is None:
                count += 1
                fit = width
            else:
                rooms.remove(fit)
            rooms.append(fit - n)
        assert len(got) == count
        assert sorted(width - sum(n for _, _, n in w) for w in got if sum(n for _, _, n in w) < width) == sorted(r for r in rooms if r)
        full, rest = joined(got, width, 1 / 64)
        assert all(width - sum(n for _, _, n in w) <= width / 64 for w in full) and sum(n for _, _, n in rest) < width
        cut = list(powers(rest))
        places = Counter((i, p) for w in [*full, *cut] for i, at, n in w for p in range(at, at + n))
        assert places == Counter((i, p) for i, n in enumerate(lengths) for p in range(n))
        assert all(sum(n for _, _, n in w).bit_count() == 1 for w in cut)


def test_documents_of_which_no_two_fit_a_window_leave_little_padding(spark, tokens):
    texts = [(i, "word " * 1_100) for i in range(60)]
    rows = pack(spark.createDataFrame(texts, "doc_id long, text string").coalesce(1), tokens, public_tokenizers.PATTERN, keep_ids=True).collect()
    assert hold_packing(rows, texts) == 0


def test_runs_hand_on_what_is_left(spark, tokens, monkeypatch):
    monkeypatch.setattr("loomgraph.llm.packing.RUN", 5_000)
    texts = [(i, "some words here " * (37 * i % 400)) for i in range(120)]
    rows = pack(spark.createDataFrame(texts, "doc_id long, text string").coalesce(1), tokens, public_tokenizers.PATTERN, keep_ids=True).collect()
    hold_packing(rows, texts)


def test_whole_sequences(spark, tokens):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(40)
    pieces = pack(docs, tokens, public_tokenizers.PATTERN, keep_ids=True).cache()
    total = pieces.agg(F.sum("length")).head()[0]
    rows = sequences(pieces, pad=9).collect()
    assert sum(sum(r["lengths"]) for r in rows) == total
    for r in rows:
        n = sum(r["lengths"])
        assert len(r["ids"]) == (n if n.bit_count() == 1 else 2048) and set(r["ids"][n:]) <= {9}


def plain_audit(docs, labels):
    import re

    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    first = {}
    for d, t, _ in docs:
        if d is not None:
            first[t or ""] = min(first.get(t or "", d), d)
    fails, parts = [], {}
    for d, t, lang in docs:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        f = [len(words) < 100, 100 * len(set(words)) < 80 * len(words), 100 * len(re.findall("[A-Z]", t)) > 10 * len(t), bool(re.search("[#$%&*|]", t)), d is not None and d > first[t]]
        parts.setdefault(lang or "", []).append((d, "".join(c for c, x in zip("ABCDE", f) if x)))
    out = []
    for part, rows in parts.items():
        shapley = Counter()
        mine = []
        for order in map("".join, permutations("ABCDE")):
            gone = [None] * len(rows)
            for step, f in enumerate(order, 1):
                here = [k for k, (d, x) in enumerate(rows) if f in x and gone[k] is None]
                redundant = sum(f in x and gone[k] is not None for k, (d, x) in enumerate(rows))
                for k in here:
                    gone[k] = f
                shapley[f] += len(here)
                mine.append([part, order, step, gone.count(None), len(here), redundant, sum(x == f for _, x in rows), sum(rows[k][0] in good for k in here), sum(rows[k][0] in toxic for k in here), f])
        out += [tuple([*r[:-1], shapley[r[-1]]]) for r in mine]
    return sorted(out)


AUDIT = ("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def audit_docs():
    dice = random.Random(8)
    word = lambda: "".join(dice.choice("abcdeé漢") for _ in range(4))
    long = " ".join(word() for _ in range(900))
    texts = [None, "", " \n", "A#", long, long, long[:-1] + "b", "B" + long[1:], long[:300] + "ß" + long[301:], " ".join(word() for _ in range(120)), "SHOUT " * 150, "x " * 99 + "y", "a|b " + " ".join(word() for _ in range(100)), "🙂 " * 120]
    docs = [(i, dice.choice(texts), dice.choice(["en", "de", None, ""])) for i in range(150)]
    return docs + [docs[3], (None, long, "en"), (None, "", "fr")]


def test_audit_against_every_order(spark):
    docs = audit_docs()
    labels = [(i, i % 2, i % 3 == 0) for i in range(0, 150, 2)] + [(4, 1, 1), (4, 0, 0), (None, 1, 1), (10, None, None)]
    labels = [(d, q, None if t is None else int(t)) for d, q, t in labels]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string").withColumns({"mask": F.lit("clash"), "length": F.lit(1), "part": F.lit("x")})
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    want = plain_audit(docs, labels)
    assert sorted(tuple(r) for r in audit(df, marks).select(*AUDIT).collect()) == want
    # Hashes that confuse texts, some or all of one length: the full texts decide.
    for weak in (lambda text: F.transform(block_hashes(text, 16), lambda h: F.pmod(h, F.lit(2))), lambda text: F.array(F.lit(0).cast("long"))):
        assert sorted(tuple(r) for r in audit(df, marks, weak).select(*AUDIT).collect()) == want


def test_audit_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert audit(docs, spark.createDataFrame([], "doc_id long, quality int, toxic int")).collect() == []


def test_copies_far_into_long_texts(spark):
    base = "word " * 60_000
    docs = [(1, base, "en"), (2, base, "en"), (3, base[:-2] + "x ", "en"), (4, base[:70_000] + "é" + base[70_001:], "en"), (5, base, "de")]
    rows = failure_masks(spark.createDataFrame(docs, "doc_id long, text string, lang string")).collect()
    assert {r["doc_id"] for r in rows if r["mask"] & 16} == {2, 5} and len(rows) == 5


def test_audit_broadcasts_nothing_that_grows(spark, monkeypatch):
    """Beside the bits of the sieve, which are bounded, both sides of each join are shuffled, however small Spark takes them for; a sieve of few bits changes nothing."""
    docs = audit_docs()
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    labels = [(d[0], 1, 0) for d in docs if d[0] is not None][::3]
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    want = sorted(tuple(r) for r in audit(df, marks).select(*AUDIT).collect())
    told, keep = [], filter_audit.durable
    monkeypatch.setattr(filter_audit, "durable", lambda df: told.append(df._jdf.queryExecution().executedPlan().toString()) or keep(df))
    monkeypatch.setattr(filter_audit, "SIEVE", 128)
    assert sorted(tuple(r) for r in audit(df, marks).select(*AUDIT).collect()) == want
    sides = [line for plan in told for line in plan.splitlines() if "BroadcastExchange" in line]
    assert len(sides) == 1 and sum("bits" in plan and "BroadcastExchange" in plan for plan in told) == 1
    rows = spark.createDataFrame([(k, [k, k + 1]) for k in range(500)], "length int, blocks array<long>")
    assert filter_audit.sieved(rows, rows).count() == 500
    monkeypatch.setattr(filter_audit, "SIEVE", 1 << 22)
    assert filter_audit.sieved(rows, rows.where("length < 5")).count() == 5
