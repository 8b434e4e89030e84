import itertools
import sys

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from loomgraph.operators import cluster, community, embedding, graph, hypergraph, metric_tree, model_calls, normalize, themes, triples
from loomgraph.operators.components import connected_components
from loomgraph.config import Config
from loomgraph.sources.providers import HttpProvider, PredictProvider, ask, make_provider, predict_url, OfflineProvider, answer_json, call

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers can't import this module

ROWS = [
    (1, "adhd", "affects", "attention", "Clinical"),
    (2, "adhd", "impairs", "attention", "Clinical"),
    (3, "therapy", "treats", "adhd", "Care"),
    (4, "therapy", "supports", "family", "Care"),
    (5, "school", "supports", "attention", None),
    (6, "adhd", "affects", "attention", "Clinical"),
    (7, "family", "supports", "family", ""),
    (8, "", "is", "school", "Care"),
]


@pytest.fixture(scope="module")
def facts(spark):
    return spark.createDataFrame(ROWS, "ord long, subject string, predicate string, object string, theme_association string")


def test_edges(facts):
    got = {(r.src, r.dst): (r.weight, r.predicate, r.predicates) for r in graph.edges(facts).collect()}
    assert got == {
        ("adhd", "attention"): (3.0, "affects", ["affects", "impairs"]),
        ("therapy", "adhd"): (1.0, "treats", ["treats"]),
        ("therapy", "family"): (1.0, "supports", ["supports"]),
        ("school", "attention"): (1.0, "supports", ["supports"]),
        ("family", "family"): (1.0, "supports", ["supports"]),
    }


def test_first_predicate_stays_empty(spark):
    t = spark.createDataFrame([(1, "a", "", "b"), (2, "a", "p", "b")], "ord long, subject string, predicate string, object string")
    r = graph.edges(t).head()
    assert r.predicate is None and r.predicates == ["p"]


def test_communities_and_hierarchy(spark, facts):
    edges = graph.edges(facts)
    found = community.detect_communities(edges)
    groups = {}
    for r in found.collect():
        groups.setdefault(r.community, set()).add(r.node)
    assert groups == {0: {"adhd", "attention", "school"}, 1: {"family", "therapy"}}
    q = graph.modularity(edges, found).head()
    assert q.objective == pytest.approx(16 / 7) and q.modularity == pytest.approx(0.326531, abs=1e-6)
    assert graph.modularity(edges, found, 0.5).head().objective == pytest.approx(4.142857, abs=1e-6)
    inner = {(r.community, r.src, r.dst) for r in graph.internal_edges(edges, found).collect()}
    assert inner == {(0, "adhd", "attention"), (0, "school", "attention"), (1, "therapy", "family"), (1, "family", "family")}
    assert [r.community for r in graph.hierarchy(edges, found, 3).collect()] == [0]


def test_distributed_rounds_keep_planted_groups(spark):
    rows = [(f"{g}{i}", f"{g}{j}", 1.0) for g in "abcd" for i, j in itertools.permutations(range(6), 2)] + [("a0", "b0", 1.0), ("c0", "d0", 1.0)]
    edges = spark.createDataFrame(rows, "src string, dst string, weight double")
    found = {}
    for r in community.detect_communities(edges, local_edges=100, passes=1).collect():
        found.setdefault(r.community, set()).add(r.node[0])
    assert sorted(map(sorted, found.values())) == [["a"], ["b"], ["c"], ["d"]]


def test_empty_graph(spark):
    edges = spark.createDataFrame([], "src string, dst string, weight double")
    assert community.detect_communities(edges).count() == 0


def test_hypergraph(facts):
    m = hypergraph.memberships(facts)
    h = {(r.entity_idx, r.theme_idx) for r in hypergraph.incidence(m).collect()}
    want = [[1, 0, 0], [1, 1, 0], [0, 1, 1], [1, 0, 1], [1, 0, 1], [1, 0, 0]]
    assert h == {(i, j) for i, row in enumerate(want) for j, v in enumerate(row) if v}
    o = {(r.theme_a, r.theme_b): r.shared for r in hypergraph.theme_overlap(m).collect()}
    assert [[o.get((a, b), 0) for b in ("Care", "Clinical", "Other")] for a in ("Care", "Clinical", "Other")] == [[5, 1, 2], [1, 2, 1], [2, 1, 3]]
    lap = {(r.row, r.col): r.value for r in hypergraph.laplacian(m).collect()}
    assert lap["family", "school"] == -2 and lap["school", "family"] == -2 and len(lap) == 26 and all(a != b for a, b in lap)
    down = {r.parent: r.children for r in hypergraph.inheritance_map(hypergraph.theme_inheritance(m, 0.25)).collect()}
    assert down == {"Care": ["Clinical", "Other"], "Clinical": ["Other"], "Other": ["Care", "Clinical"]}
    half = {r.parent: r.children for r in hypergraph.inheritance_map(hypergraph.theme_inheritance(m, 0.5)).collect()}
    assert half == {"Care": ["Clinical", "Other"], "Other": ["Clinical"]}
    assert hypergraph.theme_inheritance(m, 0.8).count() == 0


def test_inheritance_looks_up_rare_entities(spark):
    """The rows of the full overlap, from fewer pairs: themes that share only common entities never meet."""
    rng = np.random.default_rng(4)
    rows = {(f"common{i}", f"t{k:02}") for k in range(40) for i in range(3)} | {(f"e{int(e)}", f"t{k:02}") for k in range(40) for e in rng.integers(0, 120, 6)}
    rows |= {(e, "whole") for e, t in rows if t < "t04"} | {("alone", "one"), ("alone", "two")}
    m = spark.createDataFrame(sorted(rows), "entity string, theme string")
    sets = {t: {e for e, x in rows if x == t} for _, t in rows}
    for t in (0.3, 0.5, 0.8, 1.0):
        got = sorted((r.parent, r.child, r.shared, r.share) for r in hypergraph.theme_inheritance(m, t).collect())
        want = [(a, b, n, n / len(sets[b])) for a in sets for b in sets if a != b and (n := len(sets[a] & sets[b])) / len(sets[b]) >= t]
        assert got == sorted(want) and len(want) > 2
    overlapping = sum(bool(sets[a] & sets[b]) for a in sets for b in sets if a != b)
    assert hypergraph.containment_candidates(m, 0.8).count() < 0.5 * overlapping


def test_distributed_rounds_go_on_until_nothing_moves(spark):
    """A ring: pairs and triples of neighbours must be joined again, level by level."""
    n = 60
    edges = spark.createDataFrame([(f"n{i:02}", f"n{(i + 1) % n:02}", 1.0) for i in range(n)], "src string, dst string, weight double")

    def modularity(limit):
        part = {r.node: r.community for r in community.detect_communities(edges, local_edges=limit, passes=1).collect()}
        inner = sum(part[f"n{i:02}"] == part[f"n{(i + 1) % n:02}"] for i in range(n))
        return inner / n - sum(list(part.values()).count(c) ** 2 for c in set(part.values())) / n**2

    assert modularity(59) > 0.95 * modularity(1000)


@pytest.mark.parametrize("values, k", [([6, 3, 1], 1), ([3, 2.9, 1, 0.9, 0.8], 2), ([4, 4, 1, 1], 2), ([2.4, 2, 2, 2, 2, 2], 6), ([2, 2, 2, 2], 4), ([5, 1], 2)])
def test_component_choice(values, k):
    assert embedding.choose_components(np.array(values, dtype=float)) == k


def _points(spark, vectors, counts=None):
    rows = [("subject", chr(97 + i), int((counts or [1] * len(vectors))[i]), i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, "role string, item string, n long, first_ord long, v array<double>")


def _groups(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.cluster_id, []).append((r.item_idx, r.item))
    return [[i for _, i in sorted(out[k])] for k in sorted(out)]


@pytest.mark.parametrize("projection", ["none", "centered_pca"])
def test_clusters(spark, projection):
    p = _points(spark, [(1, 0), (0.99, 0.14), (0, 1), (0.1, 0.99)])
    assert _groups(cluster.cluster_items(p, 0.15, projection)) == [["a", "b"], ["c", "d"]]


@pytest.mark.parametrize("counts", [(1, 1), (3, 1), (5, 7)])
def test_two_centred_items_never_merge(spark, counts):
    assert _groups(cluster.cluster_items(_points(spark, [(1, 0), (1, 1e-4)], counts), 0.15)) == [["a"], ["b"]]


def test_large_components_are_clustered_alike(spark, monkeypatch):
    """Rounds of mutual nearest neighbours give the clusters of one matrix, through small groups, with equal vectors and two roles."""
    monkeypatch.setattr(metric_tree, "BLOCK", 50)
    rng = np.random.default_rng(7)
    x = np.concatenate([x := rng.normal(size=(60, 4)), x[:9]])
    p = _points(spark, [tuple(v) for v in x.tolist()])
    p = p.unionByName(p.where("n > 0").withColumn("role", F.lit("object")))
    whole, rounds = (sorted(map(tuple, cluster.cluster_items(p, 0.5, "none", most).collect())) for most in (6_000, 2))
    assert whole == rounds and len({r[:2] for r in whole}) < len(whole)


def test_linkage_rounds_of_a_long_component(spark, monkeypatch):
    """A curve of vectors, each near the next: one component that no group holds."""
    monkeypatch.setattr(metric_tree, "BLOCK", 100)
    rng = np.random.default_rng(2)
    t = np.sort(rng.uniform(0, 3, 700))
    x = np.stack([np.cos(t), np.sin(t), 0.3 * np.cos(7 * t), 0.3 * np.sin(5 * t)], axis=1) + 0.01 * rng.normal(size=(700, 4))
    points = spark.createDataFrame([("p", f"{i:04}", v.tolist()) for i, v in enumerate(x)], "part string, node string, v array<double>")
    links = metric_tree.close_links(points, 0.05, "part", "node")
    assert links.count() < 20 * len(x)
    assert connected_components(links.select(F.col("a").alias("u"), F.col("b").alias("v"))).select("root").distinct().count() == 1
    groups = {}
    for r in cluster.linkage_rounds(points, 0.05).collect():
        groups.setdefault(r["head"], []).append(int(r["node"]))
    label = cluster.average_linkage(x, 0.05)
    assert sorted(map(sorted, groups.values())) == sorted(np.flatnonzero(label == k).tolist() for k in set(label)) and len(groups) > 5


def test_equal_vectors_are_one_cluster(spark):
    assert _groups(cluster.cluster_items(_points(spark, [(1, 0), (1, 0), (1, 0)]), 0.15)) == [["a", "b", "c"]]


def _naive(x, t):
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    d = 1 - unit @ unit.T
    groups = [[i] for i in range(len(x))]
    while len(groups) > 1:
        pairs = [(d[np.ix_(a, b)].mean(), i, j) for (i, a), (j, b) in itertools.combinations(enumerate(groups), 2)]
        best, i, j = min(pairs)
        if not best < t:
            break
        groups[i] += groups.pop(j)
    return sorted(sorted(g) for g in groups)


def test_average_linkage_against_naive():
    rng = np.random.default_rng(2)
    for _ in range(40):
        x = rng.normal(size=(rng.integers(2, 16), 3))
        label = cluster.average_linkage(x, 0.4)
        got = sorted(sorted(np.flatnonzero(label == k).tolist()) for k in set(label))
        assert got == _naive(x, 0.4)


def test_close_pairs_lose_nothing(spark, monkeypatch):
    """Small blocks: the tree has several levels, equal vectors that no pivot splits, and a role with one leaf."""
    monkeypatch.setattr(metric_tree, "BLOCK", 25)
    monkeypatch.setattr(metric_tree, "FAN", 4)
    monkeypatch.setattr(metric_tree, "GROUP", 60)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 6))
    rows = [("big", f"b{i:03}", (centres[i % 12] + 0.15 * rng.normal(size=6)).tolist()) for i in range(400)]
    rows += [("big", f"e{i:02}", centres[0].tolist()) for i in range(60)] + [("big", "zero", [0.0] * 6), ("big", "none", None), ("big", "nan", [float("nan")] * 6)]
    rows += [("small", f"s{i}", rng.normal(size=3).tolist()) for i in range(20)]
    points = spark.createDataFrame(rows, "role string, item string, v array<double>")
    levels = []
    grow = metric_tree._grow
    monkeypatch.setattr(metric_tree, "_grow", lambda *a: levels.append(found := grow(*a)) or found)
    for t in (0.1, 1.2):
        got = sorted((r.role, r.a, r.b, round(r.distance, 9)) for r in metric_tree.close_pairs(points, t).collect())
        want = []
        for role in ("big", "small"):
            some = [(k, np.array(v) / np.linalg.norm(v)) for r, k, v in rows if r == role and v and 0 < np.linalg.norm(v) < 9]
            want += [(role, min(a, b), max(a, b), round(float(1 - u @ v), 9)) for (a, u), (b, v) in itertools.combinations(some, 2) if 1 - u @ v < t]
        assert [g[:3] for g in got] == [w[:3] for w in sorted(want)] and np.allclose([g[3] for g in got], [w[3] for w in sorted(want)])
    assert len(levels[0][1]) >= 2


def test_copies_of_a_row_stay_constant(spark, monkeypatch):
    """Ten times as many clusters of the same density: a row is a guest about as often."""
    monkeypatch.setattr(metric_tree, "BLOCK", 64)
    rng = np.random.default_rng(5)
    guests = []
    for n in (600, 6_000):
        centres = rng.normal(size=(n // 30, 24))
        v = centres[np.arange(n) % len(centres)] + 0.1 * rng.normal(size=(n, 24))
        points = spark.createDataFrame([("r", i, x.tolist()) for i, x in enumerate(v)], "role string, item long, v array<double>")
        guests.append(metric_tree.near_groups(points, 0.3, "role", "item").where("guest").count() / n)
    assert guests[1] < guests[0] + 1


def test_scattered_vectors_meet_in_few_copies(spark, monkeypatch):
    """Pivots spare scattered vectors nothing: the node stays whole, a vector is copied to its few blocks, and no pair is lost."""
    monkeypatch.setattr(metric_tree, "BLOCK", 16)
    monkeypatch.setattr(metric_tree, "CELLS", 500)
    monkeypatch.setattr(metric_tree, "PAIRS", 50)
    v = np.random.default_rng(8).normal(size=(1_000, 24))
    points = spark.createDataFrame([("r", i, x.tolist()) for i, x in enumerate(v)], "role string, item long, v array<double>")
    groups = metric_tree.near_groups(points, np.arccos(0.5), "role", "item", wide=8).groupBy("guest").count()
    assert {r.guest: r["count"] / 1_000 <= 16 for r in groups.collect()} == {True: True, False: True}
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    i, j = np.nonzero(np.triu(1 - u @ u.T < 0.5, 1))
    assert sorted((r.a, r.b) for r in metric_tree.close_pairs(points, 0.5, "role", "item").collect()) == list(zip(i.tolist(), j.tolist())) and len(i) > 1_000



def test_hubs_are_dealt_to_tiles(spark, monkeypatch):
    monkeypatch.setattr(hypergraph, "HUB", 3)
    rows = {(f"e{i}", "hub") for i in range(25)} | {(f"e{i}", f"t{i % 4}") for i in range(25)}
    m = spark.createDataFrame(sorted(rows), "entity string, theme string")
    themes_of = {e: {t for x, t in rows if x == e} for e, _ in rows}
    want = {(a, b): -float(len(themes_of[a] & themes_of[b])) for a in themes_of for b in themes_of if a != b}
    assert {(r.row, r.col): r.value for r in hypergraph.laplacian(m).collect()} == want
    sets = {t: {x for x, y in rows if y == t} for _, t in rows}
    assert {(r.theme_a, r.theme_b): r.shared for r in hypergraph.theme_overlap(m).collect()} == {(a, b): len(sets[a] & sets[b]) for a in sets for b in sets if sets[a] & sets[b]}


def test_centroid(spark):
    rows = [(0, i, f"m{i}", [float(a) for a in v]) for i, v in enumerate([(1, 0), (0, 1), (0.8, 0.6)])]
    m = spark.createDataFrame(rows, "cluster_id int, item_idx int, item string, v array<double>")
    r = embedding.centroids(m).head()
    assert r.center == "m2" and r.distance == pytest.approx(0.003454, abs=1e-6)


def test_components(spark):
    links = [(1, 2), (2, 3), (5, 4), (9, 9), (None, 1), (7, 8), (8, 10), (10, 7)] + [(i, i + 1) for i in range(100, 140)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 7: 7, 8: 7, 10: 7} | {i: 100 for i in range(100, 141)}


def test_theme_ranking(spark):
    t = spark.createDataFrame([(i, x, "d", "r") for i, x in enumerate(["A", "b", " a ", "B", "c"])], "ord int, title string, description string, reasoning string")
    got = themes.theme_frequency(t).orderBy(F.desc("freq"), "first_ord").collect()
    assert [(r.title, r.freq) for r in got] == [("A", 2), ("b", 2), ("c", 1)]


def test_parse_triples(spark):
    good = '{"subject": " a ", "predicate": "p", "object": "o", "source_quote": "q", "certainty_score": 0.5}'
    bad = ['{"subject": "", "predicate": "p", "object": "o", "source_quote": "q", "certainty_score": 0.5}', good.replace("0.5", '"bad"'), good.replace("0.5", "1.5"), "7", good.replace('" a "', "3"), good.replace("0.5", '"nan"')]
    for extra, theme in (("", "Other"), (', "theme_association": null', None), (', "theme_association": "T"', "T")):
        payload = '{"triples": [' + ", ".join([good[:-1] + extra + "}", *bad]) + "]}"
        rows = triples.parse_triples(spark.createDataFrame([(payload,), ("nonsense",), ('{"triples": 5}',)], "payload string")).collect()
        assert [(r.subject, r.theme_association, r.certainty_score) for r in rows] == [("a", theme, 0.5)]


def test_roles_map_apart(spark):
    t = spark.createDataFrame([(1, "adhd", "is", "adhd"), (2, "", "is", "x")], "ord long, subject string, predicate string, object string")
    m = spark.createDataFrame([("subject", "adhd", "Disorder"), ("object", "adhd", "Term"), ("subject", "", "never")], "role string, member string, label string")
    got = [(r.subject, r.object, r.hit) for r in normalize.resolve_names(t, m).orderBy("ord").collect()]
    assert got == [("Disorder", "Term", True), ("", "x", False)]


class Failing(OfflineProvider):
    def normalize(self, tokens, domain):
        raise RuntimeError("down")

    validate = lift = lambda self, members, domain, center=None: 1 / 0


class Answering(OfflineProvider):
    def normalize(self, tokens, domain):
        return {"tokens": [{"original": "a", "normalized": "A"}, {"original": "zz", "normalized": "Z"}]}

    def validate(self, members, domain):
        return {"accuracy_destroyed": "b" in members}

    def lift(self, members, domain, center):
        return {"members_verified": True, "formal_hypernym": f"top of {center}"}


def test_provider_contracts(spark):
    items = spark.createDataFrame([("subject", "a"), ("subject", "b"), ("object", "a")], "role string, item string")
    same = {(r.role, r.original): r.normalized for r in model_calls.normalize_tokens(items, Failing(), "d").collect()}
    assert same == {("subject", "a"): "a", ("subject", "b"): "b", ("object", "a"): "a"}
    some = {(r.role, r.original): r.normalized for r in model_calls.normalize_tokens(items, Answering(), "d").collect()}
    assert some["subject", "a"] == "A" and some["subject", "b"] == "b" and len(some) == 3
    c = spark.createDataFrame([("s", 0, 0, "a"), ("s", 0, 1, "b"), ("s", 1, 0, "c"), ("s", 1, 1, "d"), ("s", 2, 0, "e")], "role string, cluster_id int, item_idx int, item string")
    assert _groups(model_calls.validate_clusters(c, Failing(), "d")) == [["a", "b"], ["c", "d"], ["e"]]
    checked = model_calls.validate_clusters(c, Answering(), "d")
    assert _groups(checked) == [["a"], ["b"], ["c", "d"], ["e"]]
    v = embedding.encode(c.select("role", "item"))
    lifted = {r.member: r.label for r in model_calls.taxonomic_lift(checked, v, Answering(), "d").collect()}
    assert lifted["c"] == lifted["d"] and lifted["c"] in ("top of c", "top of d") and {k: lifted[k] for k in "abe"} == {"a": "a", "b": "b", "e": "e"}
    failed = model_calls.errors_of("lift", model_calls.lift_answers(c, v, Failing(), "d")).collect()
    assert [(r.step, r.calls, r.error.split(":")[0]) for r in failed] == [("lift", 2, "ZeroDivisionError")]
    assert {r.error for r in model_calls.normalize_tokens(items, Failing(), "d").collect()} == {"RuntimeError: down"}
    fallen = {r.member: r.label for r in model_calls.taxonomic_lift(c, v, Failing(), "d").collect()}
    assert fallen["e"] == "e" and fallen["a"] in ("a", "b") and fallen["a"] == fallen["b"]
    assert call(Failing().normalize, [], "")[0] is False


ANSWERS = {
    'x\nOutput:\n{"a": 1}': '{"a": 1}',
    '```json\n{"a": 1}\n```': '{"a": 1}',
    'so {"a": {}} ok': '{"a": {}}',
    'Output:\n```json {"a": 1}``` done': '{"a": 1}',
    '{x} Output:\nno Output:\n```\n{"a": 1}\n``` {y}': '{"a": 1}',
    "nothing": "nothing",
    "Output:\nnothing": "nothing",
}


def test_answer_json(spark):
    assert {a: answer_json(a) for a in ANSWERS} == ANSWERS
    from loomgraph.functions.text import json_in_answer

    rows = spark.createDataFrame(list(ANSWERS.items()), "a string, want string")
    assert rows.where(json_in_answer(F.col("a")) != F.col("want")).count() == 0


def test_calls_go_side_by_side_in_order():
    import threading
    import time

    now, most, lock = [0], [0], threading.Lock()

    def slow(i):
        with lock:
            now[0] += 1
            most[0] = max(most[0], now[0])
        time.sleep(0.02 if i % 3 else 0.05)
        with lock:
            now[0] -= 1
        if i == 4:
            raise ValueError("four")
        return {"i": i}

    got = list(ask(slow, ((i,) for i in range(20)), 3))
    assert [g[0] for g in got] == [i != 4 for i in range(20)] and got[7][1] == '{"i": 7}' and got[4][2] == "ValueError: four"
    assert 1 < most[0] <= 3


class Endpoint:
    """A local server that keeps what it was sent and answers with `answers`, one after the other."""

    def __init__(self, answers):
        import http.server
        import json
        import threading

        seen, left = [], list(answers)

        class Handler(http.server.BaseHTTPRequestHandler):
            def do_POST(self):
                body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
                seen.append((self.path, dict(self.headers), body))
                answer = left.pop(0)
                self.send_response(200 if answer is not None else 500)
                self.end_headers()
                self.wfile.write(json.dumps(answer).encode())

            def log_message(self, *args):
                pass

        self.seen, self.server = seen, http.server.HTTPServer(("127.0.0.1", 0), Handler)
        self.url = f"http://127.0.0.1:{self.server.server_port}"
        threading.Thread(target=self.server.serve_forever, daemon=True).start()


def test_http_provider():
    say = lambda text: {"choices": [{"message": {"content": text}}]}
    e = Endpoint([None, say('Output:\n```json\n{"themes": [1]}\n```'), say("no json"), say("no json"), None])
    p = HttpProvider(e.url, "m", key="secret", retries=2, context=2000)
    assert p.themes("the text") == {"themes": [1]} and len(e.seen) == 2
    assert "the text" in e.seen[1][2]["messages"][0]["content"] and e.seen[1][1]["Authorization"] == "Bearer secret" and e.seen[1][2]["options"] == {"num_ctx": 2000}
    assert call(p.themes, "x")[0] is False and "key" not in p.settings()
    assert call(HttpProvider(e.url, "m", retries=1).themes, "x")[0] is False
    e.server.shutdown()


def test_predict_provider(monkeypatch):
    monkeypatch.setenv("ENDPOINT_TOKEN", "tok")
    e = Endpoint([{"predictions": ['Prompt:\n{x}\nOutput:\n{"tokens": []}']}, {"predictions": []}])
    p = PredictProvider(e.url, "m", retries=1)
    assert p.normalize(["a"], "d") == {"tokens": []}
    path, headers, body = e.seen[0]
    assert headers["Authorization"] == "Bearer tok" and "a" in body["instances"][0]["prompt"] and body["parameters"] == {"temperature": 0.1, "maxOutputTokens": 8192}
    assert call(p.normalize, ["a"], "d")[0] is False
    e.server.shutdown()


def test_provider_of_the_settings():
    assert make_provider(Config()).name == "offline"
    local = make_provider(Config(provider="http", base_url="http://h/v1", model="m", context=8192), free_mb=3000)
    assert (local.url, local.context, local.timeout) == ("http://h/v1", 2000, 200.0)
    far = make_provider(Config(provider="predict", project="p", location="l", endpoint="7"))
    assert far.url == "https://l-aiplatform.googleapis.com/v1/projects/p/locations/l/endpoints/7:predict"
    assert predict_url("p", "l", "7", "https://own.host/x") == "https://own.host/v1/projects/p/locations/l/endpoints/7:predict"
    for bad in ({"provider": "other"}, {"provider": "http"}, {"max_concurrent": 0}):
        with pytest.raises(ValueError):
            Config(**bad)


def test_consolidation_by_the_provider(spark):
    t = spark.createDataFrame([(i, x, "d", "r") for i, x in enumerate(["A", "b", " a "])], "ord int, title string, description string, reasoning string")

    class Merging(OfflineProvider):
        def consolidate(self, blocks, titles):
            return {"master_domain": blocks.split("\n")[0], "master_themes": ["M", *titles]}

    class Down(OfflineProvider):
        def consolidate(self, blocks, titles):
            raise RuntimeError("down")

    f = themes.theme_frequency(t)
    ask_ = lambda p, f=f: model_calls.consolidate_themes(themes.consolidate(f), themes.theme_blocks(f), p).head()
    r = ask_(Merging())
    assert r.master_domain == "Title: A (Frequency: 2)" and r.master_themes == ["M", "A", "b"]
    r = ask_(Down())
    assert (r.master_domain, r.master_themes, r.ok, r.error) == ("A", ["A", "b"], False, "RuntimeError: down")
    assert ask_(Merging(), f.limit(0)).master_domain == "General"


def test_places_of_large_ids(spark):
    """Ids at the end of the range, a null, and many chunks and elements: no two places are one, none overflows."""
    high = [2**62, 2**62 + 1, None]
    chunks = spark.createDataFrame([(i, c, ". ".join(f"s{k} knows o{k}" for k in range(3))) for i in high for c in (0, 70_000)], "doc_id long, chunk_idx int, chunk string").coalesce(1)
    got = [tuple(r.ord) for r in model_calls.extract_triples(chunks, OfflineProvider()).collect()]
    assert sorted(got, key=str) == sorted(((i, c, k) for i in high for c in (0, 70_000) for k in range(3)), key=str)
    docs = spark.createDataFrame([(i, "a b c", "s") for i in high], "doc_id long, text string, source string")
    assert triples.rule_triples(docs).select("ord.doc_id").where("doc_id is not null").count() == 2


def test_indexed_is_dense_and_sorted(spark):
    rows = spark.createDataFrame([(f"r{i % 2}", f"x{(i * 37) % 500:04}") for i in range(1500)], "role string, item string").repartition(9)
    got = sorted(hypergraph.indexed(rows, ("role", "item"), "i", by="role").collect())
    want = sorted({(r.role, r.item) for r in rows.collect()})
    assert [(r.role, r.item) for r in got] == want
    assert [r.i for r in got if r.role == "r1"] == list(range(sum(a == "r1" for a, _ in want)))
    assert sorted(r.i for r in hypergraph.indexed(rows, ("item",), "i").collect()) == list(range(len({b for _, b in want})))


def test_communities_do_not_depend_on_where_rounds_run(spark):
    rng = np.random.default_rng(8)
    rows = [(f"é{a}" if a % 7 == 0 else f"n{a}", f"n{b}", float(rng.integers(1, 4))) for a, b in rng.integers(0, 24, (50, 2))]
    edges = spark.createDataFrame(rows, "src string, dst string, weight double").groupBy("src", "dst").agg(F.sum("weight").alias("weight"))
    far, near = ({r.node: r.community for r in community.detect_communities(edges, local_edges=k, passes=1).collect()} for k in (0, 10**9))
    assert far == near and len(far) == len({x for a, b, _ in rows for x in (a, b)})


def test_components_run_in_tasks_and_nothing_is_broadcast(spark, monkeypatch):
    """A graph beyond the limit whose components are below it needs no DataFrame rounds; one that has them sends no table through the driver."""
    rng = np.random.default_rng(9)
    rows = [(f"{g}{a:02}", f"{g}{b:02}", 1.0) for g in "pqr" for a, b in rng.integers(0, 20, (60, 2))] + [("x", "x", 1.0), ("y", "z", 1.0)]
    edges = spark.createDataFrame(rows, "src string, dst string, weight double")
    passes = []
    plain = community._pass
    monkeypatch.setattr(community, "_pass", lambda *a: passes.append(1) or plain(*a))
    whole, apart = ({r.node: r.community for r in community.detect_communities(edges, local_edges=k).collect()} for k in (10**9, 80))
    assert not passes and whole.keys() == apart.keys()
    gain = lambda part: graph.modularity(edges, spark.createDataFrame(list(part.items()), "node string, community long")).head().modularity
    assert gain(apart) >= 0.99 * gain(whole)
    assert all(len({n[0] for n in apart if apart[n] == c}) == 1 for c in set(apart.values()) if c not in (apart["x"], apart["y"]))
    links, weights = community.links_of(edges), community.weights_of(edges)
    state = community.move(links, weights.select("node", F.col("node").alias("c"), "o", "i"), 182.0, 1.0, 0)
    told, stage = [], community.stage_table
    monkeypatch.setattr(community, "stage_table", lambda df, *a: told.append(df._jdf.queryExecution().executedPlan().toString()) or stage(df, *a))
    community.move(links, state, 182.0, 1.0, 1)
    assert told and not any("Broadcast" in plan for plan in told)


def planted(n, edges, groups, mixing, seed):
    """Edges of which a share 1 - mixing stays in the group n % groups, and an objective of communities."""
    rng = np.random.default_rng(seed)
    src = rng.integers(0, n, edges)
    inside = rng.random(edges) > mixing
    dst = np.where(inside, (rng.integers(0, n // groups, edges) * groups + src % groups) % n, rng.integers(0, n, edges))
    w = np.ones(edges)

    def quality(c):
        c = np.unique(c, return_inverse=True)[1]
        return w[c[src] == c[dst]].sum() / edges - (np.bincount(c[src], minlength=n) * np.bincount(c[dst], minlength=n)).sum() / edges**2

    return src, dst, w, rng.integers(-(2**62), 2**62, n), quality


def one_by_one(src, dst, w, n):
    """A plain sequential optimiser: nodes in turn take the best community near them, communities become nodes."""
    where = np.arange(n)
    while True:
        links = [{} for _ in range(n)]
        for a, b, x in zip(src.tolist(), dst.tolist(), w.tolist()):
            if a != b:
                links[a][b] = links[a].get(b, 0) + x
                links[b][a] = links[b].get(a, 0) + x
        m, o, i, c = w.sum(), np.bincount(src, w, n), np.bincount(dst, w, n), list(range(n))
        so, si, moved = o.copy(), i.copy(), True
        while moved:
            moved = False
            for v in range(n):
                to = {}
                for u, x in links[v].items():
                    to[c[u]] = to.get(c[u], 0) + x
                so[c[v]] -= o[v]
                si[c[v]] -= i[v]
                gain = lambda k: to.get(k, 0) - (o[v] * si[k] + i[v] * so[k]) / m  # noqa: E731, B023
                best = max(to, key=gain, default=c[v])
                if gain(best) > gain(c[v]) + 1e-9:
                    c[v], moved = best, True
                so[c[v]] += o[v]
                si[c[v]] += i[v]
        labels, new = np.unique(c, return_inverse=True)
        where = new[where]
        if len(labels) == n:
            return where
        pair, at = np.unique(new[src] * len(labels) + new[dst], return_inverse=True)
        src, dst, w, n = pair // len(labels), pair % len(labels), np.bincount(at, w), len(labels)


@pytest.mark.parametrize("n, edges, groups, mixing", [(80, 900, 4, 0.2), (1000, 3996, 1, 1.0), (1000, 4829, 20, 0.3), (2000, 8000, 1, 1.0), (20_000, 80_000, 100, 0.3), (100_000, 400_000, 300, 0.4)])
def test_rounds_end_and_never_lose(n, edges, groups, mixing):
    src, dst, w, dice, quality = planted(n, edges, groups, mixing, n + groups)
    seen, levels = [], []

    def watch(c):
        if n <= 20_000:
            seen.append(quality(c))
        levels[-1] += 1

    c, settle = np.arange(n), community.settle

    def counted(*args, **more):
        levels.append(0)
        return settle(*args, **more)

    community.settle = counted
    try:
        for last in (False, False, True):
            c = community.leiden(src, dst, w, dice, c, 1.0, last, watch)
    finally:
        community.settle = settle
    assert max(levels) < 100
    assert all(b >= a - 1e-12 for a, b in itertools.pairwise(seen))
    assert quality(c) >= 0.97 * quality(np.arange(n) % groups)
    if n <= 2000:
        assert quality(c) >= 0.99 * quality(one_by_one(src, dst, w, n))
    if n <= 100:
        for v in range(n):
            for k in set(c):
                moved = c.copy()
                moved[v] = k
                assert quality(moved) <= quality(c) + 1e-9


def test_rounds_on_hubs_and_rings():
    """Many equal gains, nodes of very different weight, and communities named by other nodes."""
    rng = np.random.default_rng(4)
    hub = [(0, v) for v in range(1, 400)] + [(v, 400) for v in range(1, 400)]
    ring = [(v, (v + 1) % 500) for v in range(500)]
    for pairs in (hub, ring, hub + [(a + 401, b + 401) for a, b in ring]):
        src, dst = np.array(pairs).T
        n, w = max(src.max(), dst.max()) + 1, rng.integers(1, 50, len(src)).astype(float)
        dice, told = rng.integers(-(2**62), 2**62, n), []
        quality = lambda c: w[c[src] == c[dst]].sum() - (np.bincount(c[src], w, n) * np.bincount(c[dst], w, n)).sum() / w.sum()  # noqa: E731, B023
        c = community.leiden(src, dst, w, dice, np.arange(n), 1.0, watch=lambda c: told.append(quality(c)))  # noqa: B023
        assert len(told) < 400 and all(b >= a - 1e-9 for a, b in itertools.pairwise(told)) and quality(c) >= quality(one_by_one(src, dst, w, n)) * 0.97


def test_a_round_as_frames_is_the_round_in_numpy(spark):
    src, dst, w, _, quality = planted(40, 120, 4, 0.3, 5)
    name = [f"é{v}" if v % 5 == 0 else f"n{v:02}" for v in range(40)]
    edges = spark.createDataFrame([(name[a], name[b], 1.0) for a, b in zip(src, dst)], "src string, dst string, weight double")
    edges = edges.groupBy("src", "dst").agg(F.sum("weight").alias("weight"))
    links, weights = community.links_of(edges), community.weights_of(edges)
    state, last = weights.select("node", F.col("node").alias("c"), "o", "i"), -1.0
    for r in range(3):
        state = community.move(links, state, 120.0, 1.0, r)
        got = {x["node"]: x["c"] for x in state.collect()}
        now = quality(np.array([sorted(name).index(got[v]) for v in name]))
        assert now > last
        last = now


def test_blocks_of_a_large_component(spark, monkeypatch):
    """A component that no task holds: whole communities in groups, or the nodes that gain most, until no node gains."""
    monkeypatch.setattr(community, "BLOCK_LINKS", 150)
    calls = []
    for name in ("wishes", "_blocks", "_front", "move"):
        monkeypatch.setattr(community, name, lambda *a, name=name, plain=getattr(community, name), **k: calls.append(name) or plain(*a, **k))
    src, dst, w, _, quality = planted(60, 300, 4, 0.2, 3)
    edges = spark.createDataFrame([(f"n{a:02}", f"n{b:02}", 1.0) for a, b in zip(src, dst)], "src string, dst string, weight double")
    edges = edges.groupBy("src", "dst").agg(F.sum("weight").alias("weight")).cache()
    found = community.detect_communities(edges, local_edges=100, passes=1).cache()
    got = {r.node: r.community for r in found.collect()}
    assert len(got) == 60 and quality(np.array([got[f"n{v:02}"] for v in range(60)])) >= 0.97 * quality(np.arange(60) % 4)
    assert (graph.best_move(edges, found).head().gain or 0.0) < 1e-6
    assert {"_blocks", "_front"} <= set(calls) and "move" not in calls


def test_hubs_take_one_round_of_blocks(spark, monkeypatch):
    """Nodes with a hub each, and loose links between all: the groups are the communities, and no second pass is made."""
    monkeypatch.setattr(community, "BLOCK_LINKS", 400)
    calls = []
    for name in ("wishes", "_pass"):
        monkeypatch.setattr(community, name, lambda *a, name=name, plain=getattr(community, name), **k: calls.append(name) or plain(*a, **k))
    rng = np.random.default_rng(2)
    rows = [(f"c{v:03}", f"hub{v % 5}", 50.0) for v in range(200)] + [(f"c{a:03}", f"c{b:03}", 1.0) for a, b in rng.integers(0, 200, (600, 2))]
    edges = spark.createDataFrame(rows, "src string, dst string, weight double")
    found = {r.node: r.community for r in community.detect_communities(edges, local_edges=100).collect()}
    assert all(found[f"c{v:03}"] == found[f"hub{v % 5}"] for v in range(200)) and len(set(found.values())) == 5
    assert calls.count("wishes") <= 4 and calls.count("_pass") == 1


def test_hypergraph_communities_and_counts(spark):
    t = spark.createDataFrame([(i, f"{g}{i % 3}", "p", f"{g}{(i + 1) % 3}", f"theme {g}") for g in "ab" for i in range(6)], "ord long, subject string, predicate string, object string, theme_association string")
    members = hypergraph.memberships(t)
    got = {}
    for r in hypergraph.bipartite_communities(members).collect():
        got.setdefault(r.community, set()).add((r.kind, r.label))
    assert sorted(map(sorted, got.values())) == [sorted({("theme", f"theme {g}"), *(("entity", f"{g}{i}") for i in range(3))}) for g in "ab"]
    assert hypergraph.counts(t, members).head()[:] == (6, 6, 6, 2, 6)


def test_registry(spark):
    seen = []

    class Recording(OfflineProvider):
        def triples(self, text, domain, themes, entities):
            return {"triples": [{"subject": text, "predicate": "knows", "object": "|".join(entities) or "-", "source_quote": text, "certainty_score": 1}]}

    chunks = spark.createDataFrame([(1, 1, "b"), (1, 0, "a"), (2, 0, "z")], "doc_id long, chunk_idx int, chunk string")
    got = {(r.subject): r.object for r in model_calls.extract_triples(chunks, Recording()).collect()}
    assert got == {"a": "-", "b": "a|-", "z": "-"} and not seen
