import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from loomgraph.config import Config, load_config
from loomgraph.operators import graph, hypergraph, model_calls
from loomgraph.plans.pipeline import Pipeline
from loomgraph.sources import corpus, sinks
from loomgraph.sources.ledger import Ledger
from loomgraph.sources.providers import OfflineProvider, PredictProvider, make_provider

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers can't import this module

TEXTS = ["The clinic treats patients.\nThe clinic helps families.\nDoctors advise the clinic", "Doctors treat patients. The school helps families", ""]


def test_run_and_resume(spark, tmp_path):
    docs = corpus.in_memory(spark, TEXTS)
    p = Pipeline(spark, f"file://{tmp_path}/stages", Config(min_community_size=1))
    out = p.run(docs)
    assert out["original_triplets"].count() == 5
    assert out["metrics"].head().documents == 3
    total = sum(r.weight for r in out["edges"].collect())
    assert total == out["mapped_triplets"].where("subject <> '' and object <> ''").count()
    assert {r.node for r in out["modularity_partition"].collect()} == {x for r in out["edges"].collect() for x in (r.src, r.dst)}
    before = sorted(str(f) for f in tmp_path.rglob("*.parquet"))
    again = p.run(docs)
    assert sorted(str(f) for f in tmp_path.rglob("*.parquet")) == before
    assert again["schemas"].count() == out["schemas"].count() > 0
    assert p.export(out, tmp_path / "export").exists()
    pages = {f.name: f.read_text() for f in (tmp_path / "export").iterdir()}
    assert {"triples.html", "communities.html", "hypergraph.html", "run.md", "schemas.json"} <= set(pages)
    assert "entity:clinic" in pages["hypergraph.html"] and "theme:Other" in pages["hypergraph.html"] and "| documents | 3 |" in pages["run.md"]
    assert out["errors"].count() == 0 and out["document_lengths"].count() == 3 and out["counts"].head().entities == out["incidence"].select("entity").distinct().count()


def test_calls_are_made_once(spark, tmp_path):
    """A run that dies in mid stage, another over more documents, and a failed call: answered calls are not made again."""
    import os

    asked = tmp_path / "asked"
    asked.mkdir()

    class Counting(OfflineProvider):
        name = "counting"

        def themes(self, text):
            fd = os.open(asked / text.split()[0], os.O_WRONLY | os.O_CREAT | os.O_APPEND)
            os.write(fd, b"x")
            os.close(fd)
            if text.startswith("die") and not (asked / "revived").exists():
                os._exit(1)
            if text.startswith("fail") and not (asked / "revived").exists():
                raise RuntimeError("down")
            return super().themes(text)

    count = lambda: {f.name: len(f.read_text()) for f in asked.iterdir() if f.name != "revived"}
    texts = [f"word{i} is here" for i in range(12)] + ["word3 is here", "fail once", "die once"]
    chunks = spark.createDataFrame([(i, 0, t) for i, t in enumerate(texts)], "doc_id long, chunk_idx int, chunk string")
    ledger = Ledger(spark, f"file://{tmp_path}/ledger", calls_per_task=1)
    with pytest.raises(Exception):
        model_calls.theme_answers(chunks, Counting(), 1, ledger)
    before = count()
    kept = {r["payload"] for r in ledger.answers().where("ok").collect()}
    (asked / "revived").write_text("")
    got = model_calls.theme_answers(chunks, Counting(), 1, Ledger(spark, f"file://{tmp_path}/ledger", calls_per_task=1, max_tasks=2)).collect()
    assert len(got) == len(texts) and all(r["ok"] for r in got)
    after = count()
    for name, n in before.items():
        if any(name in p for p in kept):
            assert after[name] == n == 1
    assert set(after) == {t.split()[0] for t in texts} and max(v for k, v in after.items() if k not in before) == 1
    more = chunks.unionByName(spark.createDataFrame([(99, 0, "new text here")], chunks.schema))
    assert model_calls.theme_answers(more, Counting(), 1, ledger).count() == len(texts) + 1
    assert count() == after | {"new": 1}


def test_registry_goes_on_from_the_ledger(spark, tmp_path):
    calls = tmp_path / "calls"

    class Recording(OfflineProvider):
        def triples(self, text, domain, themes, entities):
            with calls.open("a") as f:
                f.write(f"{text} ")
            return {"triples": [{"subject": text, "predicate": "knows", "object": "|".join(entities) or "-", "source_quote": text, "certainty_score": 1}]}

    ledger = Ledger(spark, f"file://{tmp_path}/ledger")
    rows = [(1, 0, "a"), (1, 1, "b"), (2, 0, "z")]
    chunks = lambda r: spark.createDataFrame(r, "doc_id long, chunk_idx int, chunk string")
    told = lambda r: {x.subject: x.object for x in model_calls.triples_of(model_calls.triple_answers(chunks(r), Recording(), ledger=ledger)).collect()}
    assert told(rows) == {"a": "-", "b": "a|-", "z": "-"}
    assert told([*rows, (1, 2, "c")]) == {"a": "-", "b": "a|-", "z": "-", "c": "a|-|b|a|-"}
    assert sorted(calls.read_text().split()) == ["a", "b", "c", "z"]


def test_settings_under_other_names(tmp_path):
    (tmp_path / "c.yaml").write_text("pipeline:\n  use_async: true\n  max_concurrent_llm_calls: 5\nllm:\n  api_backend: ollama\n  base_url: http://h/v1\n  model_name: m\n  fixed_num_ctx: 4096\n  context_source: dynamic\nextraction:\n  domain: Unknown\n  theme_chunk_max_words: 70\n  triple_chunk_max_words: 30\nrefinement:\n  similarity_threshold: 0.2\n  compress_fields: [subject, object]\ntopology:\n  inheritance_overlap_threshold: 0.7\n  leiden_resolution: 1.5\n  min_community_size: 2\n")
    with pytest.warns(UserWarning, match="use_async"):
        c = load_config(tmp_path / "c.yaml")
    assert (c.max_concurrent, c.provider, c.base_url, c.model, c.context, c.default_domain) == (5, "http", "http://h/v1", "m", 4096, "Unknown")
    assert (c.theme_chunk_words, c.triple_chunk_words, c.distance_threshold, c.compress_fields, c.overlap_threshold, c.resolution, c.min_community_size) == (70, 30, 0.2, ("subject", "object"), 0.7, 1.5, 2)
    assert make_provider(c).address() == "http://h/v1/chat/completions" and make_provider(c, 3000.0).context == 2000
    (tmp_path / "d.yaml").write_text("llm:\n  api_backend: vertexai\n  vertex_project: p\n  vertex_location: l\n  vertex_endpoint: '7'\n  google_credentials_path: /c.json\n")
    d = make_provider(load_config(tmp_path / "d.yaml"))
    assert d.name == "predict" and d.credentials == "/c.json" and "/c.json" not in str(d.settings())
    (tmp_path / "e.yaml").write_text("topology:\n  leiden_resolutoin: 2\n")
    with pytest.raises(ValueError, match="leiden_resolutoin"):
        load_config(tmp_path / "e.yaml")


def test_service_account_token(monkeypatch):
    import sys
    import types

    made = []

    class Credentials:
        valid, token = False, ""

        @classmethod
        def from_service_account_file(cls, path, scopes):
            made.append(path)
            return cls()

        def refresh(self, request):
            self.valid, self.token = True, "fresh"

    for name, more in {"google": {}, "google.auth": {}, "google.auth.transport": {}, "google.auth.transport.requests": {"Request": object}, "google.oauth2": {"service_account": types.SimpleNamespace(Credentials=Credentials)}}.items():
        module = types.ModuleType(name)
        module.__dict__.update(more)
        monkeypatch.setitem(sys.modules, name, module)
    monkeypatch.delenv("ENDPOINT_TOKEN", raising=False)
    p = PredictProvider("http://h", "m", credentials="/c.json")
    assert [p.headers()["Authorization"] for _ in range(2)] == ["Bearer fresh"] * 2 and made == ["/c.json"]
    assert PredictProvider("http://h", "m", key="k").headers()["Authorization"] == "Bearer k"


def test_hypergraph_drawing_and_inherited_themes(spark, tmp_path):
    t = spark.createDataFrame([(1, "a", "p", "b", "T"), (2, "a", "q", "b", "T"), (3, "b", "", "c", "U"), (4, "a", "r", "b", "U")], "ord long, subject string, predicate string, object string, theme_association string")
    members = hypergraph.memberships(t)
    groups = members.select(F.lit("entity").alias("kind"), F.col("entity").alias("label"), F.lit(0).alias("community")).union(members.select(F.lit("theme"), "theme", F.lit(21))).distinct()
    got = {r.node: r for r in sinks.hypergraph_nodes(groups, hypergraph.degree_centrality(members), graph.theme_predicates(t)).collect()}
    assert got["theme:T"].shape == "box" and got["theme:T"].size == pytest.approx(2 / 4 * 200 + 35) and got["theme:T"].title.endswith("predicates: p, q") and got["theme:T"].color == sinks.TWENTY[1]
    assert got["entity:a"].shape == "dot" and got["entity:a"].size == pytest.approx(2 / 4 * 200 + 15)
    parts = spark.createDataFrame([("a", 0), ("b", 0), ("c", 1)], "node string, community int")
    down = hypergraph.theme_inheritance(members, 0.6)
    assert {r.community: r.inherited for r in model_calls.inherited_themes(parts, members, down).collect()} == {0: "U is part of T; T is part of U"}


def test_export_refuses_what_no_page_shows(spark, tmp_path):
    p = Pipeline(spark, f"file://{tmp_path}/stages", Config(min_community_size=1))
    out = p.run(corpus.in_memory(spark, TEXTS))
    with pytest.raises(ValueError, match="more than 2 edges"):
        p.export(out, tmp_path / "export", most=2)
    none = Pipeline(spark, f"file://{tmp_path}/stages", Config(min_community_size=99))
    assert none.export(out, tmp_path / "none").exists() and "clinic" not in (tmp_path / "none" / "communities.html").read_text()


def test_stages_are_told_apart(spark, tmp_path):
    key = lambda texts, **c: Pipeline(spark, f"file://{tmp_path}/k", Config(**c))._key(corpus.in_memory(spark, texts))
    two = lambda a: spark.createDataFrame([(1, a), (1, a)], "doc_id long, text string")
    p = Pipeline(spark, f"file://{tmp_path}/k")
    assert p._key(two("a")) != p._key(two("b")) and p._key(two("a")) == p._key(two("a").repartition(3))
    http = {"provider": "http", "base_url": "http://h"}
    assert len({key(TEXTS), key(TEXTS[:2]), key(TEXTS, token_batch=9), key(TEXTS, **http, model="a"), key(TEXTS, **http, model="b")}) == 5


def test_failed_calls_are_kept(spark, tmp_path):
    class Failing(OfflineProvider):
        name = "failing"

        def validate(self, members, domain):
            raise RuntimeError("down")

        def schema(self, community, domain, inheritance):
            raise ValueError("no")

    p = Pipeline(spark, f"file://{tmp_path}/s", Config(min_community_size=1), Failing())
    out = p.run(corpus.in_memory(spark, [*TEXTS, "patients treat patient. patients see patient. patienta treat patientb"]))
    errors = {r.step: r.error for r in out["errors"].collect()}
    assert errors["schemas"] == "ValueError: no" and out["schemas"].count() == 0
    p.export(out, tmp_path / "export")
    assert "ValueError: no" in (tmp_path / "export" / "run.md").read_text()


def test_clusters_need_a_shared_folder(spark, monkeypatch):
    from loomgraph import storage

    class Context:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)

    class Session:
        sparkContext = Context()
        conf = type("C", (), {"get": staticmethod(lambda k, d=None: d)})()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        storage.shared_dir(Session())


def test_providers_get_all_themes_and_inheritance(spark, tmp_path):
    class Telling(OfflineProvider):
        """Answers with the context it was given; all themes share their entities."""

        name = "telling"

        def triples(self, text, domain, themes, entities):
            return {"triples": [{"subject": "one", "predicate": "knows", "object": "two", "source_quote": themes, "certainty_score": 1.0, "theme_association": f"T{int(text.split()[1]) % 9}"}]}

        def schema(self, community, domain, inheritance):
            return OfflineProvider.schema(self, community, domain, inheritance) | {"core_theme": inheritance}

    docs = corpus.in_memory(spark, [f"theme{i:02} {i} text" for i in range(60)])
    out = Pipeline(spark, f"file://{tmp_path}/s", Config(min_community_size=1), Telling()).run(docs)
    for r in out["original_triplets"].collect():
        assert sorted(r.source_quote.split(", ")) == [f"theme{i:02}" for i in range(60)]
    told = {f"T{a} is part of T{b}" for a in range(9) for b in range(9) if a != b}
    found = out["schemas"].collect()
    assert found and all(set(r.core_theme.split("; ")) == told for r in found)


def test_no_triples(spark, tmp_path):
    out = Pipeline(spark, f"file://{tmp_path}/s").run(corpus.in_memory(spark, ["", "one two"]))
    assert out["original_triplets"].count() == 0 and "edges" not in out


def test_files_and_sinks(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for name in ("b.txt", "a.md", "a.txt", "c.csv"):
        (tmp_path / "in" / name).write_text(f"text of\n{name}", encoding="utf-8")
    got = [(r.doc_id, r.text) for r in corpus.text_files(spark, str(tmp_path / "in")).orderBy("doc_id").collect()]
    assert got == [(0, "text of\na.txt"), (1, "text of\nb.txt"), (2, "text of\na.md")]
    (tmp_path / "c.yaml").write_text("extraction:\n  triple_chunk_words: 7\nother:\n")
    assert load_config(tmp_path / "c.yaml", token_batch=9) == Config(triple_chunk_words=7, token_batch=9)
    nodes = spark.createDataFrame([("<a>", 11)], "node string, community int")
    drawn = sinks.community_nodes(spark.createDataFrame([("<a>", 20)], "node string, degree long"), nodes)
    assert drawn.head()[:] == ("<a>", 11, sinks.PALETTE[1], 50)
    page = sinks.graph_page(drawn.collect(), [], tmp_path / "g.html", "t").read_text()
    assert "&lt;a&gt;" in page
    assert "| x | 1 |" in sinks.run_log({"x": 1}, tmp_path / "log.md").read_text()
