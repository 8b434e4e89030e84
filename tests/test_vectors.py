import pytest

from loomgraph.operators.embedding import encode
from loomgraph.sources.vectors import VectorStore

COUNTING = '''
import uuid
import numpy as np
from loomgraph.operators.embedding import encode_strings

def load():
    def run(strings):
        for s in strings:
            with open({folder!r} + "/" + uuid.uuid4().hex, "w") as f:
                f.write(s)
        return encode_strings(strings)
    return run
'''


def items(spark, rows):
    return spark.createDataFrame(rows, "role string, item string, n long")


def rows(df):
    return sorted((r.role, r.item or "", r.item is None, r.n, r.v) for r in df.select("role", "item", "n", "v").collect())


FIRST = [("subject", "clinic", 3), ("object", "clinic", 2), ("object", "patients", 1), ("subject", "", 4)]
GROWN = [*FIRST, ("subject", "école", 1), ("object", "école", 5), ("subject", "Clinic", 1)]


def test_only_new_strings_are_encoded(spark, tmp_path):
    calls = tmp_path / "calls"
    calls.mkdir()
    module = tmp_path / "counting_encoder.py"
    module.write_text(COUNTING.format(folder=str(calls)))
    spark.sparkContext.addPyFile(str(module))
    folder, name = f"file://{tmp_path}/vectors", "counting_encoder:load"
    told = lambda: sorted(f.read_text() for f in calls.iterdir())
    assert rows(VectorStore(spark, folder, name).encode(items(spark, FIRST))) == rows(encode(items(spark, FIRST)))
    assert told() == ["", "clinic", "patients"]
    assert rows(VectorStore(spark, folder, name).encode(items(spark, GROWN))) == rows(encode(items(spark, GROWN)))
    assert told() == ["", "Clinic", "clinic", "patients", "école"]
    # Another revision of the model knows nothing of these.
    VectorStore(spark, folder, name, "2").encode(items(spark, FIRST)).count()
    assert len(told()) == 8


def test_edges_of_the_store(spark, tmp_path):
    store = VectorStore(spark, f"file://{tmp_path}/vectors")
    long = "word " * 50_000
    some = [("subject", None, 1), ("subject", long, 1), ("subject", long, 1), *[("object", "hot", i) for i in range(300)]]
    got = store.encode(items(spark, some))
    assert got.columns == ["role", "item", "n", "v"] and got.count() == 303
    assert got.where("item is null").head().v is None
    assert rows(got.where("item is not null")) == rows(encode(items(spark, some[1:])))
    assert store.vectors().count() == 2
    # What a repeated task wrote twice counts once.
    store._append(store.vectors())
    assert rows(store.encode(items(spark, some))) == rows(got) and store.vectors().count() == 2
    assert store.encode(items(spark, [])).count() == 0
    with pytest.raises(ValueError):
        store.encode(got)
