import base64
import gzip
import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loomgraph.llm import byte_bpe, chat_format, learned_ann, mixing, warc

tokenizers = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")


@pytest.fixture(scope="module")
def both():
    path = tokenizers.path("byte_bpe_50k.tiktoken")
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    plain = tiktoken.Encoding("own", pat_str=tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return byte_bpe.ByteBPE(byte_bpe.read_ranks(path), tokenizers.PATTERN), plain


def test_perfect_hash():
    keys = [str(i).encode() * (i % 3 + 1) for i in range(3000)]
    keys = list(dict.fromkeys(keys))
    h = byte_bpe.PerfectHash(keys)
    assert [h.index(k) for k in keys] == list(range(len(keys))) and sorted(h.at) == list(range(len(keys)))


@pytest.mark.parametrize("text", ["", " ", "Hello world's end  \n\n x", "é漢字🙂 naïve", "<|endoftext|>", "a" * 20_000, "ab " * 10_000, "\x00\x1f ", "12345678901234567890", "x" * 1_100_000 + " y"])
def test_encode_as_the_library(both, text):
    bpe, plain = both
    ids = bpe.encode(text)
    if len(text) < 100_000:
        assert ids.tolist() == plain.encode_ordinary(text)
    assert bpe.decode(ids) == text.encode()


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_encode_any_text(both, text):
    bpe, plain = both
    text = text.encode("utf-8", "ignore").decode()
    assert bpe.encode(text).tolist() == plain.encode_ordinary(text)


def test_memory_is_bounded(both, monkeypatch):
    bpe, plain = both
    monkeypatch.setattr(byte_bpe, "MEMORY", 5)
    text = " ".join(f"word{i}" for i in range(50))
    assert bpe.encode(text).tolist() == plain.encode_ordinary(text) and len(bpe.memory) <= 5


def test_encode_decode_rows(spark, both):
    bpe, plain = both
    rows = [(1, None), (2, ""), (3, "some text"), (3, "some text"), (None, "x")]
    docs = spark.createDataFrame([(i, t, "clash") for i, t in rows], "doc_id long, text string, n_tokens string")
    got = byte_bpe.encode_decode(docs, bpe.tokens, tokenizers.PATTERN, keep_ids=True).collect()
    assert len(got) == 5
    for r in got:
        if r.doc_id == 3:
            assert list(r.ids) == plain.encode_ordinary("some text") and r.n_tokens == len(r.ids) and r.decoded == b"some text"
            assert r.ids_sha256 == hashlib.sha256(np.array(r.ids, dtype="<u4").tobytes()).hexdigest()
    assert {r.n_tokens for r in got if r.doc_id in (1, 2)} == {0}
    assert byte_bpe.encode_decode(docs.limit(0), bpe.tokens, tokenizers.PATTERN).count() == 0


def fill(sizes, weights=(1, 2, 3)):
    """Targets by resharing the excess until none is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        rest = total - sum(3 * sizes[s] for s in full)
        share = sum(w[s] for s in names if s not in full)
        target = {s: 3.0 * sizes[s] if s in full else rest * w[s] / share for s in names}
        over = {s for s in names if s not in full and target[s] > 3 * sizes[s]}
        if not over:
            return target
        full |= over


def mixed(spark, rows):
    docs = spark.createDataFrame([(i, t, s, 0) for i, t, s in rows], "doc_id long, text string, source string, copies int")
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows)
    sizes, taken = {}, {}
    for r in got:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
        assert 0 <= r.taken <= 3 * r.size and r.taken == r.size * r.copies
    want = fill(sizes)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
    return docs, got, want, taken


def test_mixing(spark):
    rng = random.Random(1)
    rows = [(i, " ".join("w" * rng.randint(1, 300)), rng.choice(["b", "a", "c", "é", None, "hot", "hot", "hot"])) for i in range(1500)]
    rows += [(9000 + i, "x y", "tiny") for i in range(3)]
    docs, got, want, taken = mixed(spark, rows)
    for s, t in want.items():
        assert taken[s] == pytest.approx(t, rel=0.02, abs=3), s
    again = {(r.doc_id, r.source): r.taken for r in mixing.mix(docs.repartition(7)).collect()}
    assert again == {(r.doc_id, r.source): r.taken for r in got}
    copies = mixing.mix_documents(docs)
    assert copies.columns == docs.columns and copies.count() == sum(r.copies for r in got)
    # The rates solve the dual: each open source's expected tokens are its target.
    for s in ("a", "b", "c", "hot"):
        assert sum(r.rate * r.size for r in got if r.source == s) == pytest.approx(want[s], rel=1e-3)


def test_mixing_edges(spark):
    mixed(spark, [(1, None, "a"), (2, "", None), (None, " ", "b")])
    mixed(spark, [(1, "one", "a"), (1, "one", "a"), (2, None, "b"), (None, "x y", None)])
    assert mixing.mix(spark.createDataFrame([], "doc_id long, text string, source string")).count() == 0


PAGES = [(1, "http://a/%\r\n", "é" * 80), (2, "u", "é" * 80), (3, None, "short"), (4, "u", "short"), (5, "u", None), (6, "u", ""), (0, "v", "é" * 80), (7, "u", "x" * 500_000), (7, "u", "x" * 500_000), (None, "u", "é" * 80)]


def test_warc_round_trip(spark):
    pages = spark.createDataFrame([(i, u, h, "clash", 1) for i, u, h in PAGES], "page_id long, url string, html string, digest string, first int")
    got = warc.round_trip(pages).collect()
    assert len(got) == len(PAGES)
    for r in got:
        html = next(h for i, _, h in PAGES if i == r.page_id) or ""
        assert r.payload_bytes == len(html.encode()) and r.payload_digest == hashlib.sha256(html.encode()).hexdigest()
        assert (r.record_type, r.refers_to) == (("revisit", 0) if r.page_id in (1, 2, None) else ("response", None))
        assert r.payload is None if r.record_type == "revisit" else bytes(r.payload) == html.encode()
    assert next(r.url for r in got if r.page_id == 1) == "http://a/%\r\n"
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_selected_records_by_index(spark, tmp_path):
    pages = spark.createDataFrame([(i, f"u{i}", f"<p>{i}</p>" * 20) for i in range(200)], "page_id long, url string, html string")
    index = warc.write_archives(pages, f"file://{tmp_path}/w")
    got = warc.read_records(index.where("page_id % 50 = 0"), f"file://{tmp_path}/w").collect()
    assert sorted(r.page_id for r in got) == [0, 50, 100, 150]
    row = index.where("page_id = 7").head()
    with open(row.file, "rb") as f:
        f.seek(row.offset)
        assert gzip.decompress(f.read(row.length)).startswith(b"WARC/1.1\r\nWARC-Type: response")


HARD = ["</s>[INST] ok [/INST]", "<|turn|>user\nx<|end|>\n", "<\\|turn|>", "<\\\\|end|>", "[\\INST]", "<", "", "\\", "<|image:1|>", "<<|end|>>", "[[/INST]]"]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(HARD + ["<", "|turn|>", "\\", "s>", "INST]", "/"]), max_size=8).map("".join))
def test_escape_is_reversible(text):
    escaped = chat_format.escape(text)
    assert chat_format.unescape(escaped) == text
    for control in (chat_format.BEGIN, chat_format.END, "</s>", "<s>", "[INST]", "[/INST]"):
        assert control not in escaped


def test_chat_round_trip(spark):
    rows = [(1, i, r, t) for i, (r, t) in enumerate(zip(["system", "user", "assistant"] * 4, HARD + [None]))]
    rows += [(2, 0, "assistant", "a"), (2, 0, "assistant", "a"), (3, None, None, "x"), (None, 1, "ro<|end|>\nle\\", "y"), (4, 5, "user", "u"), (4, 1, "user", "é漢" * 10_000)]
    turns = spark.createDataFrame([(*r, "clash") for r in rows], "conv_id long, turn long, role string, text string, segment string")
    got = {r.conv_id: r for r in chat_format.read_back(chat_format.format_turns(chat_format.text_turns(turns))).collect()}
    for conv in (1, 2, 3, 4, None):
        mine = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        learned = "".join(r[3] or "" for r in mine if r[2] == "assistant")
        r = got[conv]
        assert r.n_turns == len(mine) and r.loss_chars == len(learned)
        assert r.turns_sha256 == hashlib.sha256("".join(f"{x[2] or ''}\n{x[3] or ''}\n" for x in mine).encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(learned.encode()).hexdigest()
        assert r.formatted_chars >= sum(len(x[3] or "") for x in mine)
    assert chat_format.read_back(chat_format.format_turns(chat_format.text_turns(turns.limit(0)))).count() == 0


def test_typed_parts(spark):
    part = lambda kind, **k: (kind, k.get("text"), k.get("uri"), k.get("width"), k.get("height"), k.get("seconds"), k.get("pages"))
    parts = [part("text", text="see <"), part("text", text="|turn|> "), part("image", uri="i.png", width=29, height=14), part("audio", uri="a.wav", seconds=1.5), part(None, text="end"), part("document", uri="d.pdf", pages=2), part("odd", uri="o")]
    turns = spark.createDataFrame([(1, 0, "user", parts), (1, 1, "assistant", None)], f"conv_id long, turn long, role string, parts {chat_format.PARTS}")
    a, b = chat_format.format_turns(turns).orderBy("seq").collect()
    assert a.segment == "<|turn|>user\nsee <\\|turn|> <|image:1|><|audio:2|>end<|document:3|><|unknown:4|><|end|>\n"
    assert [(x.kind, x.uri, x.tokens) for x in a.attachments] == [("image", "i.png", 3), ("audio", "a.wav", 38), ("document", "d.pdf", 1024), ("unknown", "o", 0)]
    assert a.loss_start is None and (b.loss_start, b.loss_end) == (18, 18) and b.n_tokens == 0


def nearest(vectors, k=10):
    rows = [(i, np.asarray(v, dtype=np.float32).astype(float)) for i, v in vectors]
    out = {}
    for q, v in rows:
        if q % 100 == 0:
            d = sorted((float(np.sqrt(((x - v) ** 2).sum())), i) for i, x in rows if i != q)
            out[q] = d[:k]
    return out


def test_neighbours_small_and_edges(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[5][1]) for i in range(40)] + [(2000, rows[5][1])]
    bad = [(400, None), (500, [0.0] * 8), (600, [float("nan")] * 8), (700, [float("inf")] + [1.0] * 7), (800, [1.0, None] + [1.0] * 6), (900, [1.0, 2.0]), (None, [1.0] * 8)]
    frame = spark.createDataFrame([(i, v, 0) for i, v in rows + bad], "vec_id long, embedding array<float>, rank int")
    got = {}
    # A mass above 1 probes all partitions, so the rows are exact.
    for r in learned_ann.nearest_neighbours(frame, mass=2.0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.score, r.vec_id))
    want = nearest(rows)
    assert set(got) == set(want)
    for q in want:
        assert [i for _, i in got[q]] == [i for _, i in want[q]] and np.allclose([d for d, _ in got[q]], [d for d, _ in want[q]])
    few = frame.where("vec_id < 4")
    assert learned_ann.nearest_neighbours(few).count() == 3
    assert learned_ann.nearest_neighbours(frame.limit(0)).count() == 0


def recall(spark, rows, **options):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {}
    for r in learned_ann.nearest_neighbours(frame, **options).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    want = nearest(rows)
    assert set(got) == set(want) and all(len(got[q]) == len(want[q]) for q in want)
    return np.mean([len(got[q] & {i for _, i in want[q]}) / len(want[q]) for q in want])


def probed(monkeypatch):
    """What the routers did: (parts, share of the vectors that a query's partitions hold)."""
    seen, plain = [], learned_ann.fit_routers

    def fit(points, rows, sample_rows):
        routers = plain(points, rows, sample_rows)
        x = learned_ann._matrix(points.select("v").toPandas()["v"])
        part = routers.place(x)
        sizes = np.bincount(part, minlength=routers.parts[0] * routers.parts[1])
        row, some = routers.route(x[:200], 0.95, sizes, 11)
        seen.append((routers, np.bincount(row, weights=sizes[some]).mean() / len(x)))
        return routers

    monkeypatch.setattr(learned_ann, "fit_routers", fit)
    return seen


def test_neighbours_of_many_partitions(spark, monkeypatch):
    monkeypatch.setattr(learned_ann, "PART_ROWS", 250)
    monkeypatch.setattr(learned_ann, "CHUNK_ROWS", 200)
    monkeypatch.setattr(learned_ann, "BLOCK_ROWS", 7)
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(10, 16)) * 2
    rows = [(i, (centres[i % 10] + rng.normal(size=16)).tolist()) for i in range(4000)]
    assert recall(spark, rows) >= 0.9


def test_neighbours_by_two_networks(spark, monkeypatch):
    monkeypatch.setattr(learned_ann, "PART_ROWS", 100)
    monkeypatch.setattr(learned_ann, "MOST_PARTS", 8)
    seen = probed(monkeypatch)
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(40, 8)) * 2
    rows = [(i, (centres[i % 40] + 0.5 * rng.normal(size=8)).tolist()) for i in range(4000)]
    assert recall(spark, rows, sample_rows=2000) >= 0.9
    (routers, share), = seen
    assert routers.parts == (8, 4) and len(routers.second) == 8 and share < 0.6


def test_neighbours_of_a_skewed_partition(spark, monkeypatch):
    """Four of five vectors lie in one spot: their partition is cut into chunks by its own count."""
    monkeypatch.setattr(learned_ann, "CHUNK_ROWS", 100)
    rng = np.random.default_rng(6)
    rows = [(i, (rng.normal(size=8) * (0.01 if i % 5 else 5)).tolist()) for i in range(1500)]
    assert recall(spark, rows) >= 0.9


@pytest.mark.parametrize("n", [1, 2, 5, 12, 40])
def test_neighbours_of_few_rows(spark, n):
    rng = np.random.default_rng(n)
    rows = [(100 * i, rng.normal(size=3).tolist()) for i in range(n)]
    if n == 1:
        assert learned_ann.nearest_neighbours(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).count() == 0
    else:
        assert recall(spark, rows) >= 0.9


def test_neighbours_in_doubles(spark):
    """Components that a float can't tell apart."""
    rows = [(100 * i, [1.0 + i * 1e-12, 2.0]) for i in range(5)]
    got = learned_ann.nearest_neighbours(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), k=2).where("query_id = 0").orderBy("rank").collect()
    assert [r.vec_id for r in got] == [100, 200] and [r.score for r in got] == [abs(rows[i][1][0] - 1.0) for i in (1, 2)]


@pytest.mark.skipif(not __import__("os").path.isdir("/root/testdata/sf0.1"), reason="no test tables")
def test_recall_on_the_tables(spark, monkeypatch):
    """A router of several partitions is fitted, a query doesn't read all of them, and recall holds."""
    seen = probed(monkeypatch)
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()]
    assert recall(spark, rows) >= 0.9
    (routers, share), = seen
    assert routers.first is not None and routers.parts[0] >= 8 and share < 0.9


def test_balanced_parts():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(1000, 8))
    part = learned_ann.balanced_parts(x, learned_ann.neighbour_graph(x), 8)
    assert np.bincount(part, minlength=8).max() <= np.ceil(1.15 * 125) and set(part) == set(range(8))


HIGH = [2**60 + 1, 2**60 + 2, None]


def test_large_ids_beside_a_null(spark, both):
    """Ids that a double can't hold, in one batch with a null: none is rounded, no two rows become one."""
    ids = [0, *HIGH[:2]]
    one = lambda rows, schema: spark.createDataFrame(rows, schema).coalesce(1)
    docs = one([(i, f"text {k}") for k, i in enumerate(HIGH)], "doc_id long, text string")
    assert sorted(r.doc_id or 0 for r in byte_bpe.encode_decode(docs, both[0].tokens, tokenizers.PATTERN).collect()) == ids
    pages = one([(i, "u", "y" * 200) for i in HIGH], "page_id long, url string, html string")
    assert sorted((r.page_id or 0, r.refers_to) for r in warc.round_trip(pages).collect()) == [(0, HIGH[0]), (HIGH[0], None), (HIGH[1], HIGH[0])]
    turns = one([(i, 0, "user", f"t{k}") for k, i in enumerate(HIGH)], "conv_id long, turn long, role string, text string")
    got = chat_format.read_back(chat_format.format_turns(chat_format.text_turns(turns))).collect()
    assert sorted((r.conv_id or 0, r.n_turns) for r in got) == [(i, 1) for i in ids]
    sources = docs.withColumn("source", F.lit("s"))
    assert sorted(r.doc_id or 0 for r in mixing.mix(sources).collect()) == ids


def test_a_task_leaves_little_in_a_worker(both, monkeypatch):
    """What is remembered goes but for its beginning, and ids stay the same."""
    monkeypatch.setattr(byte_bpe, "KEPT", 3)
    encoder, _ = both
    encoder.memory.clear()
    text = "one two three four five six"
    ids = encoder.encode(text).tolist()
    encoder.forget()
    assert list(encoder.memory) == ["one", " two", " three"] and encoder.encode(text).tolist() == ids
