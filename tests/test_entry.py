"""Every query that has SQL gives DuckDB's rows; the others give rows."""

import os
import subprocess
import sys

import duckdb
import numpy as np
import pytest

import __spark_entry__ as entry
from loomgraph.operators.embedding import choose_components, encode_strings
from loomgraph.plans import catalogue

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for name in os.listdir(FOLDER):
        c.execute(f"create view {name.removesuffix('.parquet')} as select * from '{FOLDER}/{name}'").fetchall()
    return c


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE_SQL))
def test_same_rows(spark, duck, name):
    got = catalogue.QUERIES[name](spark, FOLDER).toPandas()
    want = duck.execute(catalogue.ORACLE_SQL[name]).fetchdf()
    assert sorted(got.columns) == sorted(want.columns)
    columns = sorted(got.columns)
    rows = lambda f: sorted(map(tuple, f[columns].astype(str).values.tolist()))
    assert rows(got) == rows(want)


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.ORACLE_SQL)))
def test_has_rows(spark, name):
    assert catalogue.QUERIES[name](spark, FOLDER).count() > 0


@pytest.mark.parametrize("name, threshold, centred", [("cluster_agglomerative", 0.3, False), ("cluster_centered_pca", 0.15, True)])
def test_clusters_of_the_table_against_naive(spark, name, threshold, centred):
    """The query's clusters are those of a plain average linkage over the same strings, centred rows repeated by their number."""
    part = spark.read.parquet(f"{FOLDER}/part.parquet").toPandas()
    names = part.groupby("p_name")["p_partkey"].agg(["count", "min"]).sort_values("min")
    x = encode_strings(names.index.tolist())
    if centred:
        whole = np.repeat(x, names["count"].to_numpy(), axis=0)
        mean = whole.mean(axis=0)
        values, vectors = np.linalg.eigh(np.cov(whole.T))
        values, vectors = values[::-1], vectors[:, ::-1]
        k = min(len(whole), len(values))
        x = (x - mean) @ vectors[:, : choose_components(np.maximum(values[:k], 0))]
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    d = 1 - unit @ unit.T
    groups = [[i] for i in range(len(x))]
    while len(groups) > 1:
        best = min((d[np.ix_(a, b)].mean(), i, j) for i, a in enumerate(groups) for j, b in enumerate(groups) if i < j)
        if not best[0] < threshold:
            break
        groups[best[1]] += groups.pop(best[2])
    want = sorted(sorted(names.index[i] for i in g) for g in groups)
    got = {}
    for r in catalogue.QUERIES[name](spark, FOLDER).collect():
        got.setdefault(r.cluster_id, []).append(r.item)
    assert sorted(map(sorted, got.values())) == want


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(catalogue.QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_other_queries_stay_without_the_training_data_operators():
    """With a module hidden that those operators need, the rest is there and standard error says what is not."""
    code = "import sys; sys.modules['public_tokenizers'] = None; import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=os.path.dirname(entry.__file__), check=True)
    assert done.stdout.split() == [str(len(catalogue.QUERIES)), str(len(catalogue.ORACLE_SQL))]
    assert entry.llm_queries is None or "public_tokenizers" in done.stderr
