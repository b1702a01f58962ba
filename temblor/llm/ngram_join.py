"""N-gram Jaccard join by a MinHash LSH forest with exact verification.

Each document's five-word shingles give one MinHash label per tree. The trees
are prefix tries over the labels: documents that share a label prefix in some
tree are candidates. Prefixes start at full depth and are shortened step by
step until the recall reaches the target, both for a pair that is just similar
enough and over the pairs that are there: each candidate pair of estimated
similarity s, found with probability p = 1 - (1 - s^depth)^trees, stands for
1/p pairs. A target that the shortest prefixes miss is an error.

Copies (equal word sequences) are one class from the start and are only
counted. Candidate prefixes give star edges, linear in their rows, whose
components hold every candidate pair; texts of a component are then brought
together once and every pair in it is verified exactly, in blocks that spread
over tasks, each returning link counts and a local component per document
instead of pairs.

Defined results: texts without words link with nothing; a text of fewer than
five words is one shingle; equal rows are one document; rows that share an id
but not their words each have their own links (to other pairs of id and words),
and are one in the group; rows with a null id are their own group and link with
nothing; texts of any length are hashed whole; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (bounded_batches, connected_components, forget, materialize, release, runs,
                     smallest_ids, table)

THRESHOLD = 0.8
TREES = 20
DEPTH = 6
SHORTEST = 4
RECALL = 0.999
BLOCK = 512
BROADCAST_ROWS = 500_000


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               trees: int = TREES, depth: int = DEPTH) -> DataFrame:
    """``doc``, ``key`` (md5 of the words, null without words), ``label``
    (``trees * depth`` big-endian 32-bit minima)."""
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))

    def label_rows(batches):
        import hashlib

        import pyarrow as pa

        from . import shingles
        forget()
        hashing = shingles.MinHash(trees * depth)
        for b in batches:
            norms = [shingles.normalize(t) for t in b.column(1).to_pylist()]
            labels = hashing.labels(norms)
            yield pa.RecordBatch.from_arrays(
                [b.column(0),
                 pa.array([hashlib.md5(n).hexdigest() if n else None for n in norms],
                          pa.string()),
                 pa.array([row.tobytes() for row in labels], pa.binary())],
                names=["doc", "key", "label"])
        release()

    return rows.mapInArrow(label_rows, "doc long, key string, label binary")


def star_edges(reps: DataFrame, depth: int, trees: int = TREES, full: int = DEPTH) -> DataFrame:
    """(node, low): every class with the smallest one that shares a label
    prefix of ``depth`` with it in some tree."""
    rows = reps.select("node", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"),
                       "label")
    rows = rows.select("node", "tree", F.substring(
        "label", F.col("tree") * (4 * full) + 1, 4 * depth).alias("prefix"))
    lows = (rows.groupBy("tree", "prefix").agg(F.min("node").alias("low"),
                                               F.count(F.lit(1)).alias("n"))
            .where("n > 1").drop("n"))
    return (rows.join(lows, ["tree", "prefix"]).where("node <> low")
            .select("node", "low").distinct())


def estimated_recall(edges: DataFrame, reps: DataFrame, depth: int, threshold: float,
                     trees: int = TREES, full: int = DEPTH) -> float:
    """Share of the pairs above the threshold that prefixes of ``depth`` find."""
    a = reps.select(F.col("node"), F.col("label").alias("la"))
    b = reps.select(F.col("node").alias("low"), F.col("label").alias("lb"))

    def cut(label):
        return F.transform(F.sequence(F.lit(0), F.lit(trees * full - 1)),
                           lambda i: F.hex(F.substring(label, i * 4 + 1, 4)))

    pairs = edges.join(a, "node").join(b, "low").select(
        cut(F.col("la")).alias("xs"), cut(F.col("lb")).alias("ys"))
    same = pairs.select((F.size(F.filter(
        F.zip_with("xs", "ys", lambda x, y: x == y), lambda x: x)) / (trees * full)).alias("s"))
    p = 1 - F.pow(1 - F.pow("s", F.lit(float(depth))), F.lit(float(trees)))
    found, total = same.where(F.col("s") >= threshold).agg(
        F.count(F.lit(1)), F.sum(1 / p)).first()
    return found / total if found else 1.0


def verify(members: DataFrame, threshold: float, block: int = BLOCK) -> DataFrame:
    """Exact links inside candidate components.

    ``members``: ``comp``, ``node``, ``size`` (documents of the class), ``key``
    (md5 of its words), ``text`` (others than the class's are left out: those of
    another row with its id). A component of more than ``block`` classes is dealt into blocks,
    and each pair of blocks is one unit of work. Returns ``node``, ``links``
    (documents of linked classes) and ``root`` (a node linked directly or
    through others in that unit), one row per node and unit with a link."""
    counts = members.groupBy("comp").agg(
        F.ceil(F.count(F.lit(1)) / block).cast("int").alias("parts"))
    dealt = members.join(counts, "comp").withColumn(
        "part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    units = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda j: F.struct(
        F.least(F.col("part"), j).alias("i"), F.greatest(F.col("part"), j).alias("j")))
    dealt = (dealt.withColumn("unit", F.explode(units))
             .select("comp", F.col("unit.i").alias("i"), F.col("unit.j").alias("j"), "part",
                     "node", "size", "key", "text"))

    def verify_rows(batches):
        import hashlib

        import numpy as np
        import pandas as pd

        from . import shingles
        for pdf in runs(batches, ["comp", "i", "j"]):
            norms = pdf["text"].map(shingles.normalize)
            own = norms.map(lambda n: hashlib.md5(n).hexdigest()) == pdf["key"]
            pdf = pdf.assign(text=norms)[own].drop_duplicates("node").sort_values("node")
            sets = shingles.shingle_sets(list(pdf["text"]))
            sizes = np.array(list(map(len, sets)))
            n = len(sets)
            owner = np.repeat(np.arange(n), sizes)
            _, column, times = np.unique(np.concatenate(sets), return_inverse=True,
                                         return_counts=True)
            shared = times[column] > 1
            owner, column = owner[shared], column[shared]
            _, column = np.unique(column, return_inverse=True)
            common = np.zeros((n, n), np.float32)
            order = np.argsort(column, kind="stable")
            owner, column = owner[order], column[order]
            width = max(1, (1 << 22) // max(1, n))
            total = int(column[-1]) + 1 if len(column) else 0
            for a in range(0, total, width):
                lo, hi = np.searchsorted(column, [a, a + width])
                grid = np.zeros((n, min(width, total - a)), np.float32)
                grid[owner[lo:hi], column[lo:hi] - a] = 1
                common += grid @ grid.T
            either = sizes[:, None] + sizes[None, :] - common.astype(np.float64)
            linked = common.astype(np.float64) / np.maximum(either, 1) >= threshold
            np.fill_diagonal(linked, False)
            part = pdf["part"].to_numpy()
            if pdf["i"].iloc[0] != pdf["j"].iloc[0]:
                linked &= part[:, None] != part[None, :]
            links = linked @ pdf["size"].to_numpy().astype(np.int64)
            nodes = pdf["node"].to_numpy()
            roots = nodes[shingles.local_components(linked)]
            on = links > 0
            yield pd.DataFrame({"node": nodes[on], "links": links[on], "root": roots[on]})
        release()

    keys = ["comp", "i", "j"]
    return (dealt.repartition(*keys).sortWithinPartitions(*keys)
            .mapInPandas(verify_rows, "node long, links long, root long"))


def similar_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      threshold: float = THRESHOLD, recall: float = RECALL,
                      block: int = BLOCK) -> DataFrame:
    """One row per document: ``id_col``, ``class_id`` (smallest id with the
    same words), ``n_links`` (other documents of Jaccard similarity of at least
    ``threshold``, copies included), ``group_id`` (smallest id reachable by
    links), ``kept`` (it is its group's smallest id)."""
    signed = materialize(signatures(docs, id_col, text_col), "ngram-labels")
    classes = materialize(
        signed.where("doc is not null and key is not null").groupBy("key")
        .agg(F.min("doc").alias("first"), F.countDistinct("doc").alias("size"))
        .withColumn("node", F.monotonically_increasing_id()), "ngram-classes")
    reps = materialize(
        signed.select("doc", "label", F.col("key").alias("__key")).join(
            classes, (F.col("__key") == F.col("key")) & (F.col("doc") == F.col("first")))
        .select("node", "first", "size", "key", "label").dropDuplicates(["node"]), "ngram-reps")
    depth = DEPTH
    while True:
        edges = materialize(star_edges(reps, depth), "ngram-edges")
        least = 1 - (1 - threshold ** depth) ** TREES  # of a pair at the threshold
        if least >= recall and estimated_recall(edges, reps, depth, threshold) >= recall:
            break
        if depth <= SHORTEST:
            raise ValueError(f"prefixes of {SHORTEST} labels do not reach a recall of {recall}")
        depth -= 1
    comps = connected_components(edges, "node", "low").select(
        "node", F.col("component").alias("comp"))
    members = materialize(comps.join(reps.drop("label"), "node"), "ngram-members")
    few = members.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    texts = docs.select(F.col(id_col).cast("long").alias("first"), F.col(text_col).alias("text"))
    links = materialize(verify(
        texts.join(F.broadcast(members) if few else members, "first").drop("first"),
        threshold, block), "ngram-links")
    per_node = links.groupBy("node").agg(F.sum("links").alias("links"))
    ids = (signed.where("doc is not null").join(classes.select("key", "node"), "key")
           .select(F.col("doc").alias("id"), "node").distinct())
    groups = smallest_ids(links.select("node", "root"), ids, classes.select("node", "first"),
                          "ngram-groups")
    found = classes.join(per_node, "node", "left").join(groups, "node", "left").select(
        "key", "first", (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("links"),
        F.coalesce("group", "first").alias("group"))
    named = signed.select("doc", F.when(F.col("doc").isNotNull(), F.col("key")).alias("key"))
    return named.join(found, "key", "left").select(
        F.col("doc").alias(id_col), F.coalesce("first", "doc").alias("class_id"),
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("group", "doc").alias("group_id"),
        F.coalesce(F.col("doc") == F.col("group"), F.lit(True)).alias("kept"))


def op3_ngram_join(spark, sf_dir):
    """Class, links and group of every document at Jaccard 0.8."""
    return similar_documents(table(spark, sf_dir, "documents"))
