import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from loomgraph.llm import docstats, pii, quality_qda, quality_rules, toxicity
from loomgraph.llm.common import held_out
from pyspark.sql import functions as F

EDGES = [(1, None), (2, ""), (3, " \n "), (4, "a"), (5, "x" * 300_000), (5, "x" * 300_000), (None, "b c"), (7, "word " * 50_000)]


def edge_docs(spark):
    return spark.createDataFrame([(i, t, "clash", 0.5) for i, t in EDGES], "doc_id long, text string, features string, score double")


def no_labels(spark, column):
    return spark.createDataFrame([], f"doc_id long, {column} int")


def made_documents(n=260, seed=1):
    """Good and bad, toxic and clean documents."""
    rng = random.Random(seed)
    syllables = ["the", "an", "re", "ing", "ou", "st", "ed", "or"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 3)))
    rows = []
    for i in range(n):
        words = [word() for _ in range(rng.randint(60, 160))]
        good, toxic = i % 3 != 0, i % 4 == 0
        if not good:
            words = [w + "&&&" for w in words[:40]] if i % 2 else words[:8] * 12
        if toxic:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(["blockhead", "nitwit", "numskull"]))
        rows.append((i, " ".join(words), int(good), int(toxic)))
    return rows


def test_held_out(spark):
    got = {r[0]: r[1] for r in spark.range(200).select("id", held_out(F.col("id"))).collect()}
    assert got == {i: zlib.crc32(str(i).encode()) % 5 == 0 for i in range(200)}


@pytest.mark.parametrize("make, column", [(quality_qda.quality_scores, "quality"), (quality_rules.quality_rules, "quality"), (toxicity.toxicity_scores, "toxic")])
def test_classifiers(spark, make, column):
    rows = made_documents()
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2], r[3]) for r in rows], "doc_id long, quality int, toxic int")
    truth = {r[0]: r[2] if column == "quality" else r[3] for r in rows}
    got = make(docs, labels).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    held = [r for r in got if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    right = sum(int(r.kept if hasattr(r, "kept") else r.predicted) == truth[r.doc_id] for r in held)
    assert right / len(held) >= 0.9
    # Labels of held-out documents change nothing.
    hidden = labels.where(~held_out(F.col("doc_id")))
    assert {r.doc_id: r.score for r in make(docs, hidden).collect()} == pytest.approx({r.doc_id: r.score for r in got})


@pytest.mark.parametrize("make, column", [(quality_qda.quality_scores, "quality"), (quality_rules.quality_rules, "quality"), (toxicity.toxicity_scores, "toxic")])
def test_classifier_edges(spark, make, column):
    docs = edge_docs(spark)
    labels = spark.createDataFrame([(1, 0), (2, 1), (3, 0), (4, 1), (5, 0), (7, 1), (None, 1), (4, None), (4, 5)], f"doc_id long, {column} int")
    for known in (labels, no_labels(spark, column)):
        got = make(docs, known).collect()
        assert sorted(str(r.doc_id) for r in got) == sorted(str(i) for i, _ in EDGES)
    assert make(docs.limit(0), labels).count() == 0


def brute_stats(text):
    text = text or ""
    words = re.findall("[^\x20\x09-\x0d]+", text)
    seen, cover = {}, set()
    for i in range(len(words) - 4):
        seen.setdefault(tuple(words[i : i + 5]), []).append(i)
    for places in seen.values():
        if len(places) > 1:
            cover |= {i + j for i in places for j in range(5)}
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(cover)


def test_statistics_against_brute_force():
    rng = random.Random(3)
    for _ in range(400):
        text = "".join(rng.choice("aé 漢\n\t#|<b\r\x0b ") for _ in range(rng.randint(0, 120)))
        assert docstats.describe(text.encode())[0] == brute_stats(text)
        words = " ".join(rng.choice("abc") for _ in range(rng.randint(0, 60)))
        assert docstats.describe(words.encode())[0] == brute_stats(words)


def test_trees_fall_along_chosen_features():
    rng = np.random.default_rng(0)
    x = rng.random((800, len(docstats.FEATURES)))
    at = docstats.FEATURES.index("symbols")
    y = ((x[:, at] + 0.3 * np.sin(9 * x[:, 0]) + 0.2 * rng.normal(size=800)) < 0.6).astype(float)
    model = quality_rules.Trees(rounds=30).fit(x, y)
    assert ((model.score(x) > 0.5) == (y > 0.5)).mean() > 0.85
    line = np.repeat(x[:50], 40, axis=0)
    line[:, at] = np.tile(np.linspace(0, 1, 40), 50)
    assert (np.diff(model.score(line).reshape(50, 40), axis=1) <= 1e-12).all()


def test_discriminant_equals_log_densities():
    rng = np.random.default_rng(1)
    d = len(docstats.FEATURES)
    z = {c: quality_qda.transform(rng.random((300, d)) + c * 0.3) for c in (0, 1)}
    m = quality_qda.Discriminant({c: (300.0, v.sum(axis=0), v.T @ v) for c, v in z.items()})
    for c in (0, 1):
        factor = np.linalg.inv(m.factors[c])
        cov = factor @ factor.T
        gap = z[0] - m.means[c]
        want = -0.5 * (np.einsum("ij,jk,ik->i", gap, np.linalg.inv(cov), gap) + np.linalg.slogdet(cov)[1]) + m.log_prior[c]
        assert np.allclose(m.log_density(z[0], c), want)


def codes_of(word):
    codes, _ = toxicity.spelled([word])
    first, last = toxicity.runs(codes)
    i = int(np.argmax(last - first))
    return codes[first[i] : last[i]]


def kernel(s, t):
    """By its definition: common subsequences of three letters, each within SPAN."""
    from itertools import combinations

    total = 0.0
    triples = lambda x: [c for c in combinations(range(len(x)), 3) if c[2] - c[0] < toxicity.SPAN]
    for a in triples(s):
        for b in triples(t):
            if all(s[i] == t[j] != toxicity.GAP for i, j in zip(a, b)):
                total += toxicity.DECAY ** (a[2] - a[0] + 1 + b[2] - b[0] + 1)
    return total


def norm(s):
    """That of a run no triple of which occurs twice."""
    from itertools import combinations

    return sum(toxicity.DECAY ** (2 * (c - a + 1)) for a, b, c in combinations(range(len(s)), 3) if c - a < toxicity.SPAN and all(s[i] != toxicity.GAP for i in (a, b, c))) ** 0.5


WORDS = ["moron", "m.o.r.o.n", "banana", "strength", "abc", "empty head", "m o r o n"]


def test_string_kernel():
    pieces = [codes_of(w) for w in WORDS]
    base = toxicity.embed(pieces)
    got = toxicity.kernel(pieces, base)
    for i, s in enumerate(pieces):
        assert toxicity.norms(s, np.array([0]), np.array([len(s)]))[0] == pytest.approx(norm(s), rel=1e-4)
        for j, t in enumerate(pieces):
            want = kernel(s, t) / (norm(s) * norm(t))
            assert got[i, j] == pytest.approx(want, abs=1e-4) and float(base[:, i] @ base[:, j]) == pytest.approx(want, abs=1e-4)


def brute_runs(text):
    """Runs of one or two words of each sentence, as spelled."""
    out = []
    for sentence in re.split(r"[.!?]+\s+", text + ". "):
        words = sentence.split()
        for i in range(len(words)):
            for n in (1, 2):
                run = " ".join(words[i : i + n])
                if i + n > len(words):
                    continue
                if len(run) <= toxicity.WIDTH - 2:
                    out.append(run)
                elif n == 2:  # stretches about the gap, with what stands before and after
                    full, gap = f" {run} ", len(words[i]) + 1
                    starts = [*range(0, len(full) - toxicity.WIDTH, toxicity.STRIDE), len(full) - toxicity.WIDTH]
                    out += [full[a : a + toxicity.WIDTH][1:-1] for a in starts if a + 1 < gap < a + toxicity.WIDTH - 2]
    return out


def test_runs_stay_in_their_sentences():
    texts = ["You are one. Empty head! yes", "", "x", "...", "aa bb? cc", " \n ", "thirteenlettrs andfourteenmore yes. abcdefghijk lmnopqrstuv wx"]
    codes, owner = toxicity.spelled(texts)
    first, last = toxicity.runs(codes)
    got = sorted((int(owner[b - 1]), "".join(chr(97 + c) if c < 26 else " " for c in codes[a + 1 : b - 1])) for a, b in zip(first, last))
    want = sorted((i, r.lower()) for i, t in enumerate(texts) for r in brute_runs(t) if r.strip("."))
    assert got == want


def test_values_against_landmarks_and_sentences():
    """A text's value through the folded table equals the largest over its sentences' runs through the landmarks; blocks change nothing."""
    rng = np.random.default_rng(0)
    marks, beta = [codes_of(w) for w in ("blockhead", "nitwit", "harmless")], rng.normal(size=3)
    base = toxicity.embed(marks)
    machine = toxicity.Machine(base @ beta, 0.25)
    texts = ["You nitwitted one. It is b-l-o-c-k-head! zzz", "harm less", "ab", "", None]
    got = machine.values(texts)
    for text, value in zip(texts, got):
        runs = [codes_of(r) for r in brute_runs(text or "") if r.strip(".")]
        want = max((float(sum(b * kernel(r, m) / (norm(r) * norm(m)) for b, m in zip(beta, marks))) + 0.25 for r in runs if norm(r)), default=0.25)
        assert value == pytest.approx(want, abs=1e-4)
    long = "you nitwitted one and harm less so " * 300
    whole = machine.values([long])
    try:
        toxicity.BLOCK, kept = 700, toxicity.BLOCK
        assert machine.values([long]) == pytest.approx(whole)
    finally:
        toxicity.BLOCK = kept


@pytest.mark.parametrize("shift", [0, 4, 5, 9, 12, 40])
@pytest.mark.parametrize("ends", [" ", ". ", "  a b c d  "])
def test_blocks_of_the_real_size_start_at_words(shift, ends):
    """The value of a long text is that of its words, wherever a block ends: inside a word with an insult at its end, or between two."""
    machine = toxicity.train([(r[3], r[1]) for r in made_documents(300)])
    filler = "the ou sting reor an" + ends
    for tail in ("thereoringnitwit an ing", "reor nit wit", "nitwit", "ing"):
        head = (filler * (toxicity.BLOCK // len(filler) + 1))[: toxicity.BLOCK - toxicity.OVERLAP - 200] + " an " + "o" * shift + " reor "
        for text in (head + tail, head + "ou sting " * 40 + tail + " " + filler * 2000):
            pieces = list(toxicity.pieces_of(text))
            assert machine.values([text])[0] == pytest.approx(machine.run_values(*_whole(text)).max(), abs=1e-5)
            assert all(len(p) < toxicity.BLOCK + toxicity.MOST for p in pieces)


def _whole(text):
    codes, _ = toxicity.spelled([text])
    return codes, *toxicity.runs(codes)


def test_blocks_without_spaces_or_with_single_letters():
    machine = toxicity.train([(r[3], r[1]) for r in made_documents(300)])
    kept = toxicity.BLOCK, toxicity.MOST
    try:
        toxicity.BLOCK, toxicity.MOST = 3_000, 4_000
        for text in ("x" * 20_000 + "nitwit", "ab " + "y" * 9_000 + " nitwit ou " + "z" * 9_000, "a b c " * 4_000 + " nit wit"):
            assert "".join(p[-1:] for p in toxicity.pieces_of(text))
            assert machine.values([text])[0] == pytest.approx(machine.run_values(*_whole(text)).max(), abs=1e-4)
    finally:
        toxicity.BLOCK, toxicity.MOST = kept


def test_long_pairs_and_variants_are_whole():
    """Two long words are toxic side by side only."""
    rng = random.Random(6)
    syllables = ["the", "an", "re", "ing", "ou", "st", "ed", "or", "al", "si"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 4)))
    rows = []
    for i in range(400):
        words = [word() for _ in range(80)]
        at = rng.randrange(10, 60)
        if i % 3 == 0:
            words[at : at + 2] = ["quarrelsomest", "porcupinelike"]
        else:
            words[at], words[at + 7] = "quarrelsomest", "porcupinelike"
        rows.append((int(i % 3 == 0), " ".join(words)))
    machine = toxicity.train(rows[:300])
    p = machine.probability(machine.values([t for _, t in rows[300:]]))
    truth = np.array([y for y, _ in rows[300:]])
    assert ((p >= 0.5) == truth).mean() > 0.9
    long = codes_of("numskullandblock")
    made = toxicity._variants(long)
    assert all(len(v) <= toxicity.WIDTH for v in made) and len(made) > 3
    assert made[1][-2] == long[-2]


def test_samples_are_of_documents_that_are_there(spark):
    """Labels of ids without a document, and many rows of one id, take no place in the sample."""
    rows = made_documents(300)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2], r[3]) for r in rows], "doc_id long, quality int, toxic int")
    more = labels.unionByName(spark.range(1_000, 40_000).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"), F.lit(0).alias("toxic")))
    bounds = toxicity.Bounds(docs=200)
    got = toxicity.training_docs(docs, more, bounds)
    assert len(got) > 120 and got == toxicity.training_docs(docs, labels, bounds)
    many = docs.unionByName(docs.where("doc_id = 1").crossJoin(spark.range(2_000)).drop("id"))
    one, two = (quality_rules.quality_rules(many, labels, train_rows=150).where("doc_id < 300").distinct().collect() for _ in range(2))
    assert sorted(one) == sorted(two)
    assert sorted(one) == sorted(quality_rules.quality_rules(docs, labels, train_rows=150).collect())


def test_found_spans_are_widened_however_long():
    text = "mail " + "x" * 500 + "@example.org, or call " + "7" * 300 + " now"
    at = text.index("@")
    a, b, _ = pii.widened(text, "email", at - 3, at + 4)
    assert text[a:b] == "x" * 500 + "@example.org"
    seven = text.index("7")
    a, b, reach = pii.widened(text, "card", seven + 290, seven + 295)
    assert (a, b, reach) == (seven, seven + 300, seven + 300)


def test_inserted_characters_and_gaps():
    rows = made_documents(400)
    machine = toxicity.train([(r[3], r[1]) for r in rows])
    p = lambda text: float(machine.probability(machine.values([text]))[0])
    for bad in ("you nitwit", "n.i.t.w.i.t", "n i t w i t", "Numsk*ull!", "bl0ckhead", "x" * 500 + "numskull" + "y" * 300):
        assert p("the ou st " + bad + " or ing") > 0.5, bad
    assert p("the ou sting reor an") < 0.5


def test_words_that_are_toxic_side_by_side():
    """Clean documents hold both words too, but never next to one another."""
    rng = random.Random(4)
    syllables = ["the", "an", "re", "ing", "ou", "st", "ed", "or", "al", "si"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 3)))

    def document(toxic):
        words = [word() for _ in range(rng.randint(50, 120))]
        for _ in range(2):
            at = rng.randrange(10, len(words) - 10)
            if toxic:
                words[at : at + 2] = ["empty", "head"]
            else:
                words[at], words[at - rng.choice([3, 5, 8])] = "empty", "head"
        return int(toxic), " ".join(w + ("." if rng.random() < 0.08 and w not in ("empty", "head") else "") for w in words)

    rows = [document(i % 4 == 0) for i in range(1200)]
    machine = toxicity.train(rows[:800])
    p = machine.probability(machine.values([t for _, t in rows[800:]]))
    y = np.array([y for y, _ in rows[800:]])
    assert (p[y == 1] >= 0.5).mean() > 0.9 and (p[y == 0] >= 0.5).mean() < 0.1


def test_toxicity_query_against_plain_training(spark):
    """The operator's rows equal those of a machine trained and asked text by text outside Spark."""
    rows = made_documents(200)
    docs = spark.createDataFrame([r[:2] for r in rows] + EDGES, "doc_id long, text string").where("doc_id is null or doc_id <> 5")
    labels = spark.createDataFrame([(r[0], r[3]) for r in rows], "doc_id long, toxic int")
    bounds = toxicity.Bounds(docs=120, doc_chars=2_000, rounds=2)
    machine = toxicity.train(toxicity.training_docs(docs, labels, bounds), bounds)
    want = sorted((str(r.doc_id), float(machine.probability(machine.values([r.text]))[0])) for r in docs.collect())
    got = sorted((str(r.doc_id), r.score) for r in toxicity.toxicity_scores(docs, labels, bounds=bounds).collect())
    assert [i for i, _ in got] == [i for i, _ in want] and np.allclose([s for _, s in got], [s for _, s in want])
    kept = toxicity.drop_toxic(docs, labels, bounds=bounds).collect()
    assert sorted(str(r.doc_id) for r in kept) == [i for i, s in want if s < 0.5]


def test_training_sample_of_repeated_ids(spark):
    docs = spark.createDataFrame([(1, "b"), (1, "a"), (1, "a"), (2, "x" * 50), (3, None), (None, "n"), (4, "c")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (3, 1), (4, 0), (None, 1), (9, 1)], "doc_id long, toxic int")
    got = toxicity.training_docs(docs, labels, toxicity.Bounds(doc_chars=20))
    held = {i for i in (1, 4) if zlib.crc32(str(i).encode()) % 5 == 0}
    assert sorted(got) == sorted((y, t) for i, y, t in ((1, 1, "a"), (4, 0, "c")) if i not in held)


def brute_trees(model, row):
    total = model.start
    for t in range(model.rounds):
        v = 0
        for _ in range(model.depth):
            v = 2 * v + (2 if row[model.feature[t, v]] > model.cut[t, v] else 1)
        total += model.value[t, v]
    return 1 / (1 + np.exp(-total))


def test_quality_queries_against_row_by_row(spark):
    """op8's rows against a walk node by node, op1's against densities row by row."""
    rows = made_documents(220)
    docs = spark.createDataFrame([r[:2] for r in rows] + EDGES, "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, quality int")
    known = {r[0]: r[2] for r in rows if zlib.crc32(str(r[0]).encode()) % 5}
    texts = {str(r.doc_id): [] for r in docs.collect()}
    for r in docs.collect():
        texts[str(r.doc_id)].append(r.text)
    learned = [(docstats.describe((t or "").encode())[1], known[int(i)]) for i, some in texts.items() if i != "None" and int(i) in known for t in some]
    x, y = np.array([f for f, _ in learned]), np.array([v for _, v in learned], dtype=float)
    got = quality_rules.quality_rules(docs, labels).collect()
    order = np.argsort([r.doc_id if r.doc_id is not None else -1 for r in got])
    model = quality_rules.Trees().fit(x, y)
    for r in (got[i] for i in order):
        match = [t for t in texts[str(r.doc_id)] if brute_stats(t) == (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)]
        features = docstats.describe((match[0] or "").encode())[1]
        assert any(brute_trees(model, docstats.describe((t or "").encode())[1]) == pytest.approx(r.score, abs=1e-6) for t in match) and len(features)
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words) and r.kept == (not r.base_failed and r.score >= 0.3)
    z = quality_qda.transform(x)
    moments = {c: (float((y == c).sum()), z[y == c].sum(axis=0), z[y == c].T @ z[y == c]) for c in (0, 1)}
    plain = quality_qda.Discriminant(moments)
    want = sorted((i, float(plain.score(docstats.describe((t or "").encode())[1][None])[0])) for i, some in texts.items() for t in some)
    scored = sorted((str(r.doc_id), r.score) for r in quality_qda.quality_scores(docs, labels).collect())
    assert [i for i, _ in scored] == [i for i, _ in want] and np.allclose([s for _, s in scored], [s for _, s in want], atol=1e-6)


HIGH = [2**60 + 1, 2**60 + 2, None]


@pytest.mark.parametrize("make", [quality_qda.quality_scores, quality_rules.quality_rules, toxicity.toxicity_scores, None])
def test_large_ids_beside_a_null(spark, make):
    """Ids that a double can't hold, in one batch with a null."""
    docs = spark.createDataFrame([(i, f"some text of {k} words") for k, i in enumerate(HIGH)], "doc_id long, text string").coalesce(1)
    labels = spark.createDataFrame([(HIGH[0], 1, 1), (HIGH[1], 0, 0)], "doc_id long, quality int, toxic int")
    got = make(docs, labels) if make else pii.find_spans(docs, pii.Tagger(hidden=4))
    assert sorted((r.doc_id or 0) for r in got.collect()) == [0, *HIGH[:2]]
    if make is None:
        masked = pii.mask_documents(docs.withColumn("other", F.col("doc_id")), pii.Tagger(hidden=4)).collect()
        assert sorted(((r.doc_id or 0), r.other or 0) for r in masked) == [(0, 0), *((i, i) for i in HIGH[:2])]


def brute_spans(t):
    digits = lambda s: "".join(c for c in s if c in "0123456789")
    o = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    o += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(p) <= 255 for p in m[0].split("."))]
    o += [("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 12 <= len(digits(m[0])) <= 19 and pii.luhn(digits(m[0]))]
    o += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(digits(m[0])) <= 15]
    return sorted(o, key=lambda s: (s[1], pii.KINDS.index(s[0])))


def test_base_spans_against_brute_force():
    rng = random.Random(8)
    for _ in range(20_000):
        t = "".join(rng.choice("a1.@+- 0-9()%_é") for _ in range(rng.randint(0, 60)))
        assert pii.base_spans(t) == brute_spans(t)


@pytest.mark.parametrize("text", ["1" * 200_000, "a" * 200_000 + "@", "+" + "1 " * 100_000, "a@" * 100_000, "1." * 100_000, "9" * 5000 + ".1.1.1"])
def test_base_spans_in_linear_time(text):
    pii.base_spans(text)


@pytest.fixture(scope="module")
def tagger():
    texts = [r[1] for r in made_documents(60)] + ["mail a.b@c.org or call +49 30 1234567 from 10.0.0.1 ok"]
    return pii.Tagger().fit(*pii.training_windows(texts))


def test_tagger_gradient():
    x, y = pii.training_windows(["some text with a.b@c.org in it and more words to come " * 3], 8)
    t = pii.Tagger(hidden=4)
    _, grad = t.loss_and_gradient(x.T, y.T)
    for name in ("fx", "fh", "bh", "bb", "o", "t"):
        at = np.unravel_index(np.abs(grad[name]).argmax(), grad[name].shape)
        kept, both = t.w[name][at], []
        for step in (1e-2, -1e-2):
            t.w[name][at] = kept + np.float32(step)
            both.append(t.loss_and_gradient(x.T, y.T)[0])
        t.w[name][at] = kept
        assert grad[name][at] == pytest.approx((both[0] - both[1]) / 2e-2, rel=2e-2)


def test_viterbi_against_all_paths():
    from itertools import product

    for seed in range(6):
        t = pii.Tagger(hidden=3, seed=seed)
        t.w["t"] = np.random.default_rng(seed).normal(size=(pii.TAGS, pii.TAGS)).astype(np.float32)
        x = np.random.default_rng(seed).integers(0, pii.CODES, (3, 4))
        e, trans = t.emissions(x.T).transpose(1, 0, 2), t.ways()
        for b in range(3):
            best = max(product(range(pii.TAGS), repeat=4), key=lambda p: sum(e[i, k, b] for i, k in enumerate(p)) + sum(trans[a, c] for a, c in zip(p, p[1:])))
            assert t.decode(x)[b].tolist() == list(best)


def test_windows_of_many_lengths_in_one_batch():
    """Emissions and tags are those of each window alone, computed with numpy's tangent."""
    rng = np.random.default_rng(1)
    t = pii.Tagger(hidden=5)
    t.w = {k: v + rng.normal(0, 0.5, v.shape).astype(np.float32) for k, v in t.w.items()}
    lengths = np.sort(rng.integers(1, 200, 37))[::-1].copy()
    x = rng.integers(0, pii.CODES, (37, 200)).astype(np.int16)
    e, tags = t.emissions(np.ascontiguousarray(x.T), lengths), t.decode(x, lengths)
    assert len({int(n) for n in lengths}) > 20 and tags.any()
    for j, n in enumerate(lengths):
        h = t._lstm(np.ascontiguousarray(x[j : j + 1, :n].T), [])
        assert np.abs(np.concatenate([h[0], h[1]], axis=2)[:, 0] @ t.w["o"] + t.w["ob"] - e[:, :n, j].T).max() < 0.01
        assert np.array_equal(t.decode(x[j : j + 1, :n])[0], tags[j, :n])


def test_three_gates_held_between_bounds():
    """Emissions against a walk number by number: three numbers a unit and step, not four, and cells that stay between -1 and 1."""
    rng = np.random.default_rng(6)
    n, t = 3, pii.Tagger(hidden=3)
    assert all(t.w[d + k].shape[-1] == 3 * n for d in "fb" for k in "xhb")
    t.w = {k: v + rng.normal(0, 1, v.shape).astype(np.float32) for k, v in t.w.items()}
    x = rng.integers(0, pii.CODES, 90)
    want, held = np.tile(t.w["ob"].astype(float), (len(x), 1)), 0
    for k, d in enumerate("fb"):
        h, c = [0.0] * n, [0.0] * n
        for at in range(len(x)) if d == "f" else reversed(range(len(x))):
            z = [float(t.w[d + "x"][x[at], j] + t.w[d + "b"][j] + sum(h[u] * t.w[d + "h"][u, j] for u in range(n))) for j in range(3 * n)]
            i, o = ([min(1.0, max(0.0, v / 4 + 0.5)) for v in z[j : j + n]] for j in (0, n))
            c = [(1 - i[u]) * c[u] + i[u] * min(1.0, max(-1.0, z[2 * n + u])) for u in range(n)]
            h = [o[u] * math.tanh(c[u]) for u in range(n)]
            held += sum(v in (0.0, 1.0) for v in i + o)
            assert all(-1 <= v <= 1 for v in c)
            want[at] += np.array(h) @ t.w["o"][k * n : (k + 1) * n]
    assert held > 50
    assert np.abs(t.emissions(x[:, None].astype(np.int16))[:, :, 0].T - want).max() < 1e-3


def test_tangent_of_cells():
    x = np.linspace(-1, 1, 100_001).astype(np.float32)
    got = np.empty_like(x)
    pii.tanh_of_cells(x, np.empty_like(x), got)
    assert np.abs(got - np.tanh(x)).max() < 1e-5


def test_tangent():
    x = np.linspace(-20, 20, 100_001).astype(np.float32)
    got = x.copy()
    pii.tanh_into(got, np.empty((2, *x.shape), dtype=np.float32))
    assert np.abs(got - np.tanh(x)).max() < 6e-5


def set_in(rng, make, texts):
    """A made-up span between words of a text."""
    kind, made = make(rng)
    words = rng.choice(texts).split()
    at = rng.randrange(1, len(words))
    lead = " ".join(words[:at]) + " "
    return lead + made + " " + " ".join(words[at:]), (kind, len(lead), len(lead) + len(made))


def unseen(rng):
    """Manners that the generator doesn't have, or not together."""
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(4, 8)))
    n = lambda k: "".join(rng.choice("0123456789") for _ in range(k))
    ip = [str(rng.randint(0, 255)) for _ in range(4)]
    return rng.choice([("email", f"{word()}.{word()} (AT) {word()} [dot] org"), ("email", f"{word()}[at]{word()}.de"), ("email", f"{word().title()} at {word()}.org"), ("phone", f"0{n(4)}/{n(6)}"), ("phone", f"(0{n(3)}) {n(7)}"), ("phone", f"0{n(3)}-{n(7)}"), ("ip", " . ".join(ip)), ("ip", "[.]".join(ip))])


@pytest.mark.parametrize("make, least", [(pii.write_span, 0.85), (unseen, 0.85)])
def test_tagger_finds_made_spans(tagger, make, least):
    """Exact spans on texts of another seed: how many are found, and how few others are."""
    rng = random.Random(77)
    texts = [r[1] for r in made_documents(40, seed=9) if len(r[1].split()) > 20]
    rows = [set_in(rng, make, texts) for _ in range(400)]
    base = [pii.base_spans(t) for t, _ in rows]
    found = pii.added_spans([t for t, _ in rows], base, tagger)
    asked = [i for i, (_, s) in enumerate(rows) if not any(a < s[2] and s[1] < b for _, a, b in base[i])]
    right = sum(rows[i][1] in found[i] for i in asked)
    wrong = sum(s != rows[i][1] for i, some in enumerate(found) for s in some)
    assert len(asked) > 200 and right >= least * len(asked) and wrong <= 0.1 * len(asked)


def test_spans_do_not_depend_on_windows_or_neighbours(tagger, monkeypatch):
    """Every character of a long text is tagged: the same address is found wherever it lies, and other texts in the batch change nothing."""
    words = "the ou st an re ing or ed " * 200
    made = "john [at] example [dot] com"
    places = [0, 1, 400, 447, 448, 449, 480, 500, 511, 512, 940, 959, 960, 961, 992, 1000, 1023, 1024, 1300, len(words) - 3]
    texts = [f"{words[:p].rstrip()} {made} {words[p:].lstrip()}" for p in places]
    found = pii.added_spans(texts, [[]] * len(texts), tagger)
    for t, some in zip(texts, found):
        at = t.index(made)
        assert some == [("email", at, at + len(made))]
    assert [pii.added_spans([t], [[]], tagger)[0] for t in texts] == found


def test_a_thousand_windows_take_their_steps_together(tagger, monkeypatch):
    """The calls of a step are the same for few windows and many, so a batch has many; tags are those of small batches, also where hundreds of windows hold spans."""
    rng = random.Random(4)
    texts = [f"the ou st {'an re ' * rng.randint(0, 30)}{pii.write_span(rng)[1]} ing or ed" for _ in range(1000)]
    sizes, decode = [], pii.Tagger.decode
    monkeypatch.setattr(pii.Tagger, "decode", lambda self, x, lengths=None: sizes.append(len(x)) or decode(self, x, lengths))
    got = pii.merged_tags(texts, tagger)
    assert sizes == [1000] and sum(bool(t.any()) for t in got) > 600
    assert all(np.array_equal(a, b) for a, b in zip(got, pii.merged_tags(texts, tagger, batch=37)))


def test_spelt_out_addresses(spark, tagger):
    made = ["JOHN [AT] EXAMPLE.COM", "Jomar (At) Mailer.org", "john [at] example [dot] com", "john.doe (AT) example (DOT) com", "jomar at mailer.org", "john[at]example[dot]com"]
    docs = spark.createDataFrame([(i, f"the an ing or {t} the st ou") for i, t in enumerate(made)], "doc_id long, text string")
    got = {r.doc_id: r.spans for r in pii.find_spans(docs, tagger).collect()}
    assert got == {i: f"email:14:{14 + len(t)}" for i, t in enumerate(made)}


def test_spans_and_masks(spark, tagger):
    text = "é a.b@c.org, 10.0.0.1; 4111 1111 1111 1111 +49 30 12345678"
    rows = EDGES + [(9, text)]
    docs = spark.createDataFrame([(i, t, 0, "x") for i, t in rows], "doc_id long, text string, n_email int, n_chars string").withColumn("n_chars", F.lit(0).cast("long"))
    got = {r.doc_id: r for r in pii.find_spans(docs, tagger).collect()}
    r = got[9]
    base = pii.written(brute_spans(text))
    assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == (1, 1, 1, 1)
    assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest() and set(base.split(",")) <= set(r.spans.split(","))
    assert got[1].spans == "" and got[5].spans == ""
    masked = {r.doc_id: r for r in pii.mask_documents(docs, tagger).collect()}
    assert masked[1].text is None and masked[9].text == "é [EMAIL], [IP]; [CARD] [PHONE]" and masked[9].n_chars == len(masked[9].text)
    assert pii.find_spans(docs.limit(0)).count() == 0
