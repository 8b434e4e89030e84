"""N-gram Jaccard self-join of documents, with the classes that its links form.

Method: a document's set is its distinct word shingles, as sorted 64-bit hashes.
Documents fall into size bands so narrow that only neighbouring bands can link; two
neighbouring bands make a tile. Two linked sets of a tile differ in at most D
shingles, so when the hash range is cut into D + 1 (and some spare) segments, one
segment at least is the same in both. Documents meet where a whole segment is the
same; thus a passage that many documents share does not bring them together. A pair
that met is first bounded from above by its hashed parity bitmaps (the popcount of
their XOR never exceeds the number of differing shingles), then decided by an exact
intersection of the sorted arrays.

Groups: equal sets are one node from the start. A key's members are first compared
with one representative, and each map task sends on only one of its members; so a
group of n copies makes about n pairs. Keys where a comparison failed and which still
span several classes are compared again with their best-linked member, and what is
still apart then is compared pair by pair in tiles of bounded size, so no link
between classes is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.components import connected_components
from .common import as_long, durable, lean, mix64, shared_table, whole_row, windows, word_hashes

FLUSH = 1_500_000
BITMAP_WORDS = 8
CHUNK = 512
SMALL = 32


def shingle_set(text: str | bytes | None, width: int) -> np.ndarray:
    """Sorted distinct shingle hashes; a text of fewer words is one shingle; none without words."""
    if not text:
        return np.empty(0, dtype=np.uint64)
    h = word_hashes(text.encode() if isinstance(text, str) else text, lower=True)
    if not len(h):
        return np.empty(0, dtype=np.uint64)
    return np.unique(windows(h, min(width, len(h)))) if len(h) >= width else windows(h, len(h))


def set_hash(s: np.ndarray) -> int:
    """The node: one hash for equal sets."""
    both = np.add.reduce(mix64(s * np.uint64(3)), keepdims=True) + np.bitwise_xor.reduce(mix64(s), keepdims=True)
    return int(as_long(mix64(both + np.uint64(len(s))))[0])


def bitmap(s: np.ndarray) -> np.ndarray:
    """Parity bitmap of 64 * BITMAP_WORDS bits: differing bits <= differing elements."""
    bits = np.bincount((mix64(s) & np.uint64(64 * BITMAP_WORDS - 1)).astype(np.int64), minlength=64 * BITMAP_WORDS) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


class Bands:
    """Size bands for a threshold of percent: sizes of non-neighbouring bands can't link."""

    def __init__(self, percent: int):
        self.percent = percent
        edges = [1]
        while edges[-1] < 1 << 40:
            edges.append(max(edges[-1] + 1, (edges[-1] - 1) * 100 // percent + 1))
        self.edges = np.array(edges, dtype=np.int64)

    def of(self, size: int) -> int:
        return int(np.searchsorted(self.edges, size, side="right")) - 1

    def plan(self, tile: int) -> tuple[int, int]:
        """For the tile of bands tile-1 and tile: number of segments, and how many of them a document may leave out; 0 segments if only equal sets can link."""
        largest = 2 * (int(self.edges[tile + 1]) - 1)
        apart = 100 - self.percent
        differ = largest * apart // (100 + self.percent)
        if differ == 0:
            return 0, 0
        spare = -(-(differ + 1) // 50) + 1 if differ >= 20 else 0
        return differ + 1 + 2 * spare, spare


def segment_keys(s: np.ndarray, bands: Bands) -> np.ndarray:
    """The keys under which a set meets others."""
    band, out = bands.of(len(s)), []
    sums = None
    for tile in (band, band + 1):
        k, spare = bands.plan(tile)
        if not k:
            continue
        if sums is None:
            sums = np.concatenate(([np.uint64(0)], np.cumsum(mix64(s ^ np.uint64(0xA5A5A5A5A5A5A5A5)), dtype=np.uint64)))
        cuts = (np.arange(1, k, dtype=np.float64) * (2.0**64 / k)).astype(np.uint64)
        at = np.concatenate(([0], np.searchsorted(s, cuts), [len(s)]))
        sizes = np.diff(at)
        keys = sums[at[1:]] - sums[at[:-1]]
        keys = mix64(mix64(keys + sizes.astype(np.uint64)) ^ (np.uint64(tile) << np.uint64(40)) ^ np.arange(k, dtype=np.uint64))
        if spare:
            keep = np.ones(k, dtype=bool)
            keep[np.argsort(sizes, kind="stable")[:spare]] = False
            keys = keys[keep]
        out.append(keys)
    return np.concatenate(out) if out else np.empty(0, dtype=np.uint64)


def document_nodes(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, n_shingles, node, text_hash) for each row. Ids pass as they are: as pandas numbers, large ones beside a null would be rounded."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes, nodes = [], []
            for t in b.column(2).cast(pa.binary()):
                s = shingle_set(t.as_py(), width)
                sizes.append(len(s))
                nodes.append(set_hash(s) if len(s) else 0)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()), b.column(1)], ["doc_id", "n_shingles", "node", "text_hash"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").mapInArrow(lean(run), f"doc_id {kind}, n_shingles long, node long, text_hash long")


def meetings(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """(key, node, first): first is null for the member that stands for its map task; other members carry it."""
    bands = Bands(percent)

    def flush(keys: list[np.ndarray], nodes: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        k, n = np.concatenate(keys), np.concatenate(nodes)
        order = np.lexsort((n, k))
        k, n = k[order], n[order]
        head = np.concatenate(([True], k[1:] != k[:-1]))
        first = n[np.flatnonzero(head)][np.cumsum(head) - 1]
        keep = head | (np.concatenate(([True], n[1:] != n[:-1])) & (n != first))
        k, n, first, head = as_long(k[keep]), n[keep], first[keep], head[keep]
        for i in range(0, len(k), 50_000):
            j = slice(i, i + 50_000)
            yield pa.RecordBatch.from_arrays([pa.array(k[j]), pa.array(n[j]), pa.array(first[j], mask=head[j])], ["key", "node", "first"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: list[np.ndarray] = []
        nodes: list[np.ndarray] = []
        size, seen = 0, set()
        for b in batches:
            for t in b.column(0).cast(pa.binary()):
                s = shingle_set(t.as_py(), width)
                if not len(s) or (node := set_hash(s)) in seen:
                    continue
                seen.add(node)
                k = segment_keys(s, bands)
                if len(k):
                    keys.append(k)
                    nodes.append(np.full(len(k), node, dtype=np.int64))
                    size += len(k)
                if size >= FLUSH:
                    yield from flush(keys, nodes)
                    keys, nodes, size, seen = [], [], 0, set()
        if keys:
            yield from flush(keys, nodes)

    return docs.select("text").mapInArrow(lean(run), "key long, node long, first long")


def node_sets(docs: DataFrame, width: int) -> DataFrame:
    """(node, size, bits, shingles) of each non-empty text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for i in range(0, len(b), 200):
                sets = [s for t in b["text"].iloc[i : i + 200] if len(s := shingle_set(t, width))]
                if not sets:
                    continue
                yield pd.DataFrame({"node": [set_hash(s) for s in sets], "size": [len(s) for s in sets], "bits": [bitmap(s) for s in sets], "shingles": [s.tobytes() for s in sets]}, columns=["node", "size", "bits", "shingles"])

    return docs.select("text").mapInPandas(lean(run), "node long, size long, bits array<long>, shingles binary")


def verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(u, v) -> (u, v, linked): the bitmap bound first, then the exact intersection."""
    small = sets.select("node", "size", "bits")
    x = small.select(F.col("node").alias("u"), F.col("size").alias("su"), F.col("bits").alias("bu"))
    y = small.select(F.col("node").alias("v"), F.col("size").alias("sv"), F.col("bits").alias("bv"))
    differ = F.aggregate(F.zip_with("bu", "bv", lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0), lambda a, b: a + b)
    bounded = pairs.join(x, "u").join(y, "v").withColumn("most", F.floor((F.col("su") + F.col("sv") - differ) / 2).cast("long"))
    union = F.col("su") + F.col("sv") - F.col("most")
    bounded = durable(bounded.select("u", "v", (100 * F.col("most") >= percent * union).alias("may")))
    a = sets.select(F.col("node").alias("u"), F.col("shingles").alias("a"))
    b = sets.select(F.col("node").alias("v"), F.col("shingles").alias("b"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in batches:
            ok = []
            for s, t in zip(p["a"], p["b"]):
                s, t = np.frombuffer(s, dtype=np.uint64), np.frombuffer(t, dtype=np.uint64)
                at = np.searchsorted(s, t)
                both = int((s[np.minimum(at, len(s) - 1)] == t).sum())
                ok.append(100 * both >= percent * (len(s) + len(t) - both))
            yield pd.DataFrame({"u": p["u"], "v": p["v"], "linked": ok})

    exact = bounded.where("may").join(a, "u").join(b, "v").mapInPandas(lean(run), "u long, v long, linked boolean")
    return durable(exact.union(bounded.where("not may").select("u", "v", F.lit(False))))


def _ordered(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.where(F.col(a) != F.col(b)).select(F.least(a, b).alias("u"), F.greatest(a, b).alias("v")).distinct()


def _labelled(members: DataFrame, roots: DataFrame) -> DataFrame:
    return members.join(roots, "node", "left").select("key", "node", F.coalesce("root", "node").alias("root"))


def _split_keys(members: DataFrame) -> DataFrame:
    """Keys whose members are of several classes. A table, like every other side that is summed by key before a join by key: such a join reads both sides from shuffles, and a hot key's partition can be split."""
    return durable(members.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("key"))


def _uncompared(members: DataFrame, percent: int, sets: DataFrame) -> DataFrame:
    """Pairs of different classes that share a key and may not have been compared with each other yet.

    Keys with the same members count once, and keys with two members not at all: their
    one pair has been compared. Small keys are joined with themselves, larger ones in
    tiles of two chunks of members, kept where the bitmaps allow a link.
    """
    h, g = F.xxhash64("node"), F.xxhash64("node", F.lit(1))
    keys = members.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.bit_xor(h).alias("h"), F.bit_xor(g).alias("g"))
    keys = durable(keys.where("n > 2").groupBy("n", "h", "g").agg(F.min("key").alias("key")).select("key", "n"))
    few = members.join(keys.where(F.col("n") <= SMALL).select("key"), "key")
    other = few.select("key", F.col("node").alias("v"), F.col("root").alias("rv"))
    near = few.join(other, "key").where("node < v and root <> rv").select(F.col("node").alias("u"), "v").distinct()
    # In a larger key most members tend to be of one class. These are not compared with
    # each other, so they are dealt by chunks to the chunks of the rest, and only the
    # rest is dealt in pairs of chunks.
    large = members.join(keys.where(F.col("n") > SMALL), "key")
    most = large.groupBy("key", "root").agg(F.count(F.lit(1)).alias("m"), F.max("n").alias("n"))
    most = most.groupBy("key").agg(F.max(F.struct("m", "root")).alias("b"), F.max("n").alias("n"))
    chunks = lambda n: F.ceil(n / CHUNK).cast("int")
    most = durable(most.select("key", F.col("b.root").alias("bulk_root"), chunks(F.col("b.m")).alias("bulk_chunks"), chunks(F.col("n") - F.col("b.m")).alias("rest_chunks")))
    rows = large.select("key", "node", "root").join(most, "key").join(sets.select("node", "size", "bits"), "node")
    rows = rows.withColumn("bulk", F.col("root") == F.col("bulk_root"))
    rows = rows.withColumn("c", F.pmod(F.xxhash64("node"), F.when(F.col("bulk"), F.col("bulk_chunks")).otherwise(F.col("rest_chunks"))).cast("int"))
    tile = lambda kind, x, y: F.struct(F.lit(kind).alias("kind"), x.alias("x"), y.alias("y"))
    upto = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    across = F.transform(upto("rest_chunks"), lambda r: tile(0, F.col("c"), r))
    down = F.transform(upto("bulk_chunks"), lambda q: tile(0, q, F.col("c")))
    aside = F.transform(upto("rest_chunks"), lambda r: tile(1, F.least(F.col("c"), r), F.greatest(F.col("c"), r)))
    rows = rows.withColumn("tile", F.explode(F.when(F.col("bulk"), across).otherwise(F.concat(down, aside))))
    rows = rows.select("key", "tile.kind", "tile.x", "tile.y", "node", "root", "size", "bits", "bulk", "c")

    def run(p: pd.DataFrame) -> pd.DataFrame:
        bits, size, node, root = np.array(p["bits"].tolist(), dtype=np.int64).view(np.uint64), p["size"].to_numpy(), p["node"].to_numpy(), p["root"].to_numpy()
        across = p["kind"].iloc[0] == 0
        side = p["bulk"].to_numpy() if across else p["c"].to_numpy() == p["x"].iloc[0]
        within = not across and p["x"].iloc[0] == p["y"].iloc[0]
        one = np.flatnonzero(side)
        two = one if within else np.flatnonzero(~side)
        out = []
        for i in one if len(one) <= len(two) else two:
            j = two if len(one) <= len(two) else one
            j = j[(root[j] != root[i]) & ((j > i) | (not within))]
            differ = np.bitwise_count(bits[j] ^ bits[i]).sum(axis=1).astype(np.int64)
            most = (size[j] + size[i] - differ) // 2
            j = j[100 * most >= percent * (size[j] + size[i] - most)]
            if len(j):
                out.append(np.stack([np.minimum(node[j], node[i]), np.maximum(node[j], node[i])], axis=1))
        return pd.DataFrame(np.concatenate(out) if out else np.empty((0, 2), dtype=np.int64), columns=["u", "v"])

    return near.union(rows.groupBy("key", "kind", "x", "y").applyInPandas(run, "u long, v long").distinct())


def ngram_classes(docs: DataFrame, width: int = 4, percent: int = 85) -> DataFrame:
    """(doc_id, n_shingles, component_id) for each row of docs(doc_id, text, ...).

    Null, empty and blank texts have no shingles and stay alone; equal texts, repeated
    rows and texts of equal sets share a class; other columns are not read. A null
    doc_id is never chosen as a class id while the class has another. component_id is
    the smallest doc_id that links reach.
    """
    return _classes(docs, width, percent).select("doc_id", "n_shingles", "component_id")


def _classes(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """ngram_classes with text_hash and the root of each row's class, null where there are no shingles."""
    nodes = shared_table(document_nodes(docs, width), "nodes")
    met = meetings(docs, width, percent)
    # One shuffle. Each map task sends one head a key at most; its other members carry
    # the head already, and are dealt by their own hash, so no key gathers them.
    bucket = F.when(F.col("first").isNull(), F.lit(0)).otherwise(1 + F.pmod(F.xxhash64("node"), F.lit(1 << 20)))
    heads = Window.partitionBy("key", "bucket")
    met = met.withColumn("bucket", bucket).withColumn("mine", F.coalesce("first", "node"))
    met = met.withColumns({"rep": F.min("mine").over(heads), "most": F.max("node").over(heads)})
    met = met.where("rep <> most or bucket > 0").select("key", "node", "mine", F.when(F.col("bucket") > 0, F.col("mine")).otherwise(F.col("rep")).alias("rep"))
    members = shared_table(met, "met")
    pairs = _ordered(members, "node", "mine").union(_ordered(members, "mine", "rep")).distinct()
    pairs = durable(pairs)
    return _finish(docs, nodes, members, pairs, width, percent)


def _finish(docs: DataFrame, nodes: DataFrame, members: DataFrame, pairs: DataFrame, width: int, percent: int) -> DataFrame:
    wanted = durable(members.select("node").union(members.select("mine")).union(members.select("rep")).distinct())
    # A node's set is read from the row of its smallest doc_id, or by the hash of its text where no row has one.
    chosen = nodes.where("n_shingles > 0").groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.min("text_hash").alias("text_hash")).join(wanted, "node")
    named = docs.select("doc_id", "text").join(chosen.where("doc_id is not null").select("doc_id").distinct(), "doc_id", "left_semi")
    nameless = docs.where("doc_id is null").select(F.xxhash64("text").alias("text_hash"), "text").dropDuplicates(["text_hash"])
    nameless = nameless.join(chosen.where("doc_id is null").select("text_hash"), "text_hash", "left_semi")
    sets = node_sets(named.select("text").union(nameless.select("text")), width)
    sets = sets.join(wanted, "node", "left_semi").dropDuplicates(["node"])
    sets = shared_table(sets, "sets")
    if (got := sets.count()) != (want := wanted.count()):
        raise RuntimeError(f"{want - got} of {want} sets to compare are missing")
    done = verify(pairs, sets, percent)
    links = done.where("linked").select("u", "v")
    roots = connected_components(links)
    everyone = members.select("key", "node").union(members.select("key", F.col("mine").alias("node"))).union(members.select("key", F.col("rep").alias("node"))).distinct()
    bad = done.where("not linked")
    if bad.head(1):
        ends = bad.select(F.col("u").alias("node")).union(bad.select(F.col("v").alias("node"))).distinct()
        keys = durable(everyone.join(ends, "node", "left_semi").select("key").distinct())
        open_ = durable(_labelled(everyone.join(keys, "key", "left_semi"), roots))
        open_ = durable(open_.join(_split_keys(open_), "key", "left_semi"))
        # The member with most links so far becomes the second representative.
        degree = links.union(links.select("v", "u")).groupBy("u").agg(F.count(F.lit(1)).alias("degree")).withColumnRenamed("u", "node")
        best = durable(open_.join(degree, "node", "left").groupBy("key").agg(F.max_by("node", F.struct(F.coalesce("degree", F.lit(0)), "node")).alias("best")))
        again = _ordered(open_.join(best, "key"), "node", "best").join(done.select("u", "v"), ["u", "v"], "left_anti")
        more = verify(durable(again), sets, percent)
        done = durable(done.union(more))
        if more.where("linked").head(1):
            links = done.where("linked").select("u", "v")
            roots = connected_components(links)
            open_ = _labelled(open_.select("key", "node"), roots)
            open_ = durable(open_.join(_split_keys(open_), "key", "left_semi"))
        rest = _uncompared(open_, percent, sets).join(done.select("u", "v"), ["u", "v"], "left_anti")
        rest = durable(rest)
        if rest.head(1):
            last = verify(rest, sets, percent).where("linked").select("u", "v")
            if last.head(1):
                links = links.union(last)
                roots = connected_components(links)
    classes = nodes.where("n_shingles > 0").groupBy("node").agg(F.min("doc_id").alias("least"))
    classes = classes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = classes.join(least, "root").select("node", "root", "component_id")
    out = nodes.join(classes, "node", "left")
    return out.select("doc_id", "n_shingles", "text_hash", "root", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def keep_one(docs: DataFrame, width: int = 4, percent: int = 85) -> DataFrame:
    """The rows of docs that stand for their class, with all their columns: of those with its smallest doc_id, one.

    Rows of one doc_id with texts of different classes stand for their own class each;
    of repeated rows, or texts of one class, that with the smallest hash of its text
    stays. Rows without doc_id stay, and of rows without shingles one of each doc_id.
    """
    first = _classes(docs, width, percent).where("doc_id = component_id").groupBy("doc_id", "root").agg(F.min("text_hash").alias("text_hash")).select("doc_id", "text_hash").distinct()
    rows = docs.select(whole_row(docs), "doc_id", F.xxhash64("text").alias("text_hash"))
    kept = rows.join(first, ["doc_id", "text_hash"], "left_semi").dropDuplicates(["doc_id", "text_hash"])
    return kept.select("row.*").unionByName(docs.where("doc_id is null"))
