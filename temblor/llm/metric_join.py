"""Embedding near-duplicates by an exact metric range join.

Normalised vectors of cosine c lie sqrt(2 - 2c) apart, so a cosine limit is a
radius r. Pivots cut the sphere into cells: a vector belongs to the cell of its
nearest pivot, and, by the triangle inequality, can only have partners in cell
j if d(x, p_j) <= d(x, own pivot) + 2r; the distance to the bisector between
the two pivots must not exceed r either: its reach.

The cells of a label, one after the other, are dealt into homes of a bounded
number of vectors; a large cell fills several. A vector is compared with the
others of its home and visits the homes that hold a cell of its reach: of two
homes one visits the other, so every pair meets once. It is sent to a home once,
however many of its cells are in reach, and homes grow with the square root of
the label, so a label of n vectors that no bound tells apart sends n ^ 1.5 / 128
of them at most. A task holds one home, and visitors pass it batch by batch.

Within a home, a cell's own vectors are compared with those in whose reach it
is, in the order of their distance to the pivot: the triangle inequality again
leaves only those within r. Equal vectors of one label are one class from the
start, told by a 128-bit digest, so vectors are not sent to be compared for
that. Comparing returns link counts and a local component per vector, never
pairs.

Pivots are a sample in the order of a hash, one for each ``block`` vectors of
the largest label, ``pivots`` at most; they only decide where work is done,
never the result.

Defined results: vectors that are null, empty, zero, or hold null or non-finite
components, and rows without label or id, link with nothing and are kept; equal
rows are one vector; rows that share an id but not label and vector each have
their own links (to other pairs of id and vector), and are one in the component;
vectors of different lengths never link; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import (bounded_batches, hash_sample, materialize, small, smallest_ids, table)

COSINE = 0.98
PIVOTS = 128
BLOCK = 1024
# Distances are rounded; candidates get this much more room than the radius.
SLACK = 1e-6
# A home has this many vectors times the square root of its label's, ...
HOME = 64
# ... if they fit this many bytes in double precision (64 vectors always do).
HOME_BYTES = 64 << 20
# Own vectors and others compared at once: 8 MB of products.
STRIP = 256
STRETCH = 4096


def similar_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                    label_col: str = "label", cosine: float = COSINE, pivots: int = PIVOTS,
                    block: int = BLOCK) -> DataFrame:
    """One row per vector: ``id_col``, ``n_links`` (other vectors of its label
    with at least this cosine), ``component_id`` (smallest id reachable by
    links), ``kept`` (it is that id)."""
    spark = vectors.sparkSession
    bounded_batches(spark)
    radius = (2 - 2 * cosine) ** 0.5 + SLACK
    # Single precision is sent as it is; anything else as double precision.
    narrow = vectors.select(vector_col).dtypes[0][1] == "array<float>"
    kind = "<f4" if narrow else "<f8"
    rows = vectors.select(F.col(id_col).cast("long").alias("id"),
                          F.col(label_col).cast("string").alias("label"),
                          F.col(vector_col).cast("array<float>" if narrow else "array<double>")
                          .alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x)
                      & (F.abs(x) < float("inf")))
    usable = (F.col("id").isNotNull() & F.col("label").isNotNull()
              & F.coalesce((F.size("vector") > 0) & finite
                           & F.exists("vector", lambda x: x != 0), F.lit(False)))

    def packed(batches):
        import hashlib

        import numpy as np
        import pyarrow as pa
        for b in batches:
            column = b.column(2)
            # Adding zero makes one of the two zeros, which are equal.
            flat = column.flatten().to_numpy(zero_copy_only=False).astype(kind) + 0
            sizes = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            ends = np.cumsum(sizes)
            cells = [flat[e - n:e].tobytes() if n else None
                     for n, e in zip(sizes.tolist(), ends.tolist())]
            keys = [x and hashlib.blake2b(x, digest_size=16).digest() for x in cells]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(sizes, pa.int32()), pa.array(keys, pa.binary()),
                 pa.array(cells, pa.binary())], names=["id", "label", "dims", "key", "vector"])

    base = rows.withColumn("vector", F.when(usable, F.col("vector"))).mapInArrow(
        packed, "id long, label string, dims int, key binary, vector binary")
    members = materialize(base.select("id", "label", "dims", "key"), "vector-rows")
    # Equal vectors of a label are one class.
    same = ["label", "dims", "key"]
    sizes = (members.where("key is not null").select(*same, "id").distinct().groupBy(*same)
             .agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("size")))
    classes = materialize(
        base.where("key is not null").groupBy(*same).agg(F.first("vector").alias("vector"))
        .join(sizes, same).withColumn("node", F.monotonically_increasing_id()), "vector-classes")
    largest = classes.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    sample = [bytes(r["vector"]) for r in hash_sample(
        classes.select("vector", "node"), min(pivots, -(-largest // block) or 1), None,
        "node").collect()]

    def pivots_of(dims):
        """The pivots of this length, and half their distances from each other."""
        import numpy as np
        found = [np.frombuffer(v, kind) for v in sample]
        found = [v for v in found if len(v) == dims]
        p = unit(np.array(found, float)) if found else np.eye(1, dims)
        return p, apart(p, p)

    def reach(x, p, between):
        """Distances to the pivots, the nearest of them, and the cells in which
        there can be partners."""
        import numpy as np
        d = apart(x, p)
        own = d.argmin(1)
        near = d[np.arange(len(x)), own]
        room = (d <= near[:, None] + 2 * radius) & (
            d * d - (near * near)[:, None] <= 2 * radius * between[own] + SLACK)
        room[np.arange(len(x)), own] = True
        return d, own, room

    def cell_rows(batches):
        import numpy as np
        import pyarrow as pa
        known: dict = {}
        for b in batches:
            dims = b.column("dims").to_numpy()
            cells = b.column("vector").to_pylist()
            own, near = np.zeros(len(dims), np.int32), [None] * len(dims)
            for n in np.unique(dims).tolist():
                at = np.nonzero(dims == n)[0]
                if n not in known:
                    known[n] = pivots_of(n)
                x = unit(np.frombuffer(b"".join([cells[i] for i in at]), kind)
                         .reshape(len(at), n).astype(float))
                _, own[at], room = reach(x, *known[n])
                who, cell = np.nonzero(room)
                for i, some in zip(at, np.split(cell, np.cumsum(np.bincount(
                        who, minlength=len(at)))[:-1])):
                    near[i] = some.tolist()
            keep = [b.column(c) for c in ("label", "dims", "node", "size", "vector")]
            yield pa.RecordBatch.from_arrays(
                [*keep, pa.array(own), pa.array(near, pa.list_(pa.int32()))],
                names=["label", "dims", "node", "size", "vector", "cell", "near"])

    placed = classes.select("label", "dims", "node", "size", "vector").mapInArrow(
        cell_rows, "label string, dims int, node long, size long, vector binary, cell int, "
                   "near array<int>")
    # The cells of a label follow one another; at most ``pivots`` of them.
    parts = ["label", "dims"]
    before = Window.partitionBy(*parts).orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    counts = materialize(placed.groupBy(*parts, "cell").agg(F.count(F.lit(1)).alias("n"))
                         .withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0))),
                         "vector-cells")
    fits = F.greatest(F.lit(64), F.floor(F.lit(HOME_BYTES) / (8 * F.col("dims"))))
    homes = (counts.groupBy(*parts).agg(
        F.sum("n").alias("total"),
        F.map_from_entries(F.collect_list(F.struct("cell", F.struct("start", "n")))).alias("cells"))
        .withColumn("per", F.least(F.greatest(F.lit(block), F.ceil(HOME * F.sqrt("total"))), fits)
                    .cast("long"))
        .withColumn("homes", F.ceil(F.col("total") / F.col("per")).cast("long")))
    # By a cell's number: its first vector's place, its vectors, its first and last home.
    spans = homes.select(*parts, "per", "homes", F.transform(
        F.sequence(F.lit(0), F.lit(max(1, len(sample)) - 1)), lambda c: F.col("cells")[c])
        .alias("cells")).withColumn("cells", F.transform("cells", lambda c: F.when(
            c.isNotNull(), F.struct(
                c["start"].alias("start"), c["n"].alias("n"),
                F.floor(c["start"] / F.col("per")).alias("from"),
                F.floor((c["start"] + c["n"] - 1) / F.col("per")).alias("to")))))
    own = F.get("cells", F.col("cell"))

    # Of two homes one visits the other: that which is at most half the round behind.
    def ahead(to):
        return F.pmod(to - F.col("home"), F.col("homes")) * 2

    units = (placed.join(small(spans, 5_000), parts)
             .withColumn("home", F.floor((own["start"] + F.pmod(F.xxhash64("node"), own["n"]))
                                         / F.col("per")))
             .withColumn("near", F.filter("near", lambda c: F.get("cells", c).isNotNull()))
             .withColumn("near", F.array_distinct(F.flatten(F.transform("near", lambda c: F.sequence(
                 F.get("cells", c)["from"], F.get("cells", c)["to"])))))
             .withColumn("to", F.explode(F.concat(F.array("home"), F.filter(
                 "near", lambda to: (ahead(to) > 0) & (
                     (ahead(to) < F.col("homes"))
                     | ((ahead(to) == F.col("homes")) & (F.col("home") < to)))))))
             .select(*UNIT, (F.col("to") != F.col("home")).alias("visitor"), "node", "size",
                     "vector")
             .repartition(*UNIT).sortWithinPartitions(*UNIT, "visitor"))

    def compare(batches):
        import numpy as np
        import pandas as pd

        def results(node, root, links):
            some = links > 0
            return pd.DataFrame({"node": node[some], "root": root[some], "links": links[some]})

        key = home = None
        for pdf in batches:
            # Runs of one unit, and within it of own vectors and of visitors.
            change = (pdf[[*UNIT, "visitor"]] != pdf[[*UNIT, "visitor"]].shift()).any(axis=1)
            edges = [*change.to_numpy().nonzero()[0].tolist(), len(pdf)]
            for a, b in zip(edges, edges[1:]):
                part = pdf.iloc[a:b]
                now = tuple(part[UNIT].iloc[0])
                if now != key:
                    if home is not None:
                        yield results(*home.finish())
                    p, between = pivots_of(now[1])
                    key, home = now, _Home(p, between, reach, cosine, radius)
                x = unit(np.frombuffer(b"".join(part["vector"]), kind)
                         .reshape(len(part), now[1]).astype(float))
                node, size = part["node"].to_numpy(), part["size"].to_numpy()
                if part["visitor"].iloc[0]:
                    yield results(*home.visit(x, node, size))
                else:
                    home.own(x, node, size)
        if home is not None:
            yield results(*home.finish())

    found = materialize(units.mapInPandas(compare, "node long, root long, links long"),
                        "vector-links")
    per_node = found.groupBy("node").agg(F.sum("links").alias("links"))
    # Classes that share an id belong together as well.
    known = classes.select(*same, "node", "first", "size")
    ids = members.join(known, same).groupBy("id", "node").count()
    groups = smallest_ids(found.select("node", "root"), ids.select("id", "node"),
                          classes.select("node", "first"), "vector-groups")
    named = known.join(per_node, "node", "left").join(groups, "node", "left").select(
        *same, (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("links"),
        F.coalesce("group", "first").alias("group"))
    return members.join(named, same, "left").select(
        F.col("id").alias(id_col), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("group", "id").alias("component_id"),
        F.coalesce(F.col("id") == F.col("group"), F.lit(True)).alias("kept"))


UNIT = ["label", "dims", "to"]


class _Home:
    """The vectors of a home, what links to them, and what they link together."""

    def __init__(self, pivots, between, reach, cosine, radius):
        self.pivots, self.between, self.reach = pivots, between, reach
        self.cosine, self.radius = cosine, radius
        self.parts: list = []
        self.cells = None

    def own(self, x, node, size):
        self.parts.append((x, node, size))

    def _ready(self):
        """All own vectors are here: order them by cell and distance to its pivot."""
        import numpy as np
        if self.cells is not None:
            return
        x, node, size = (np.concatenate(c) for c in zip(*self.parts))
        self.parts = []
        d, cell, _ = self.reach(x, self.pivots, self.between)
        far = d[np.arange(len(x)), cell]
        order = np.lexsort([far, cell])
        self.x, self.node, self.size, self.far = x[order], node[order], size[order], far[order]
        self.root, self.links = np.arange(len(x)), np.zeros(len(x), np.int64)
        found, first = np.unique(cell[order], return_index=True)
        self.cells = list(zip(found.tolist(), first.tolist(), [*first[1:].tolist(), len(x)]))
        for a in range(0, len(x), STRETCH):  # each own pair is found from both sides
            rows = slice(a, a + STRETCH)
            self._meet(self.x[rows], self.node[rows], self.size[rows], a)

    def visit(self, x, node, size):
        """Node, linked node of the home, and links of each visitor."""
        import numpy as np
        self._ready()
        found = [self._meet(x[a:a + STRETCH], node[a:a + STRETCH], size[a:a + STRETCH], None)
                 for a in range(0, len(x), STRETCH)]
        first, links = (np.concatenate(c) for c in zip(*found))
        return node, self.node[first], links

    def finish(self):
        self._ready()
        return self.node, self.node[self.root], self.links

    def _meet(self, y, node, size, at):
        """Compare vectors with the home; ``at``: their place in it, if they are its own."""
        import numpy as np
        d, _, room = self.reach(y, self.pivots, self.between)
        # The first vector of the home that each of them links to.
        first = np.zeros(len(y), np.int64) if at is None else np.arange(at, at + len(y))
        links = np.zeros(len(y), np.int64)
        for cell, low, high in self.cells:
            those = np.nonzero(room[:, cell])[0]
            those = those[np.argsort(d[those, cell], kind="stable")]
            far = d[those, cell]
            for a in range(low, high, STRIP):
                b = min(a + STRIP, high)
                lo = np.searchsorted(far, self.far[a] - self.radius, "left")
                hi = np.searchsorted(far, self.far[b - 1] + self.radius, "right")
                some = those[lo:hi]
                linked = self.x[a:b] @ y[some].T >= self.cosine
                if at is not None:
                    linked &= self.node[a:b, None] != node[some]
                if not linked.any():
                    continue
                mine, other = np.nonzero(linked)
                mine, other = mine + a, some[other]
                self.links += self._sums(mine, size[other], len(self.links))
                if at is None:
                    new = links[other] == 0
                    first[other[new]] = mine[new]
                    links += self._sums(other, self.size[mine], len(links))
                self._together(mine, first[other])
        return first, links

    @staticmethod
    def _sums(at, sizes, n):
        """Sums of sizes by place; whole numbers that a double holds exactly."""
        import numpy as np
        return np.bincount(at, sizes, n).astype(np.int64)

    def _together(self, a, b):
        """Own vectors ``a`` and ``b`` belong together: all take the smallest place."""
        import numpy as np
        root = self.root
        while True:
            ra, rb = root[a], root[b]
            apart_ = ra != rb
            if not apart_.any():
                return
            a, b = np.maximum(ra, rb)[apart_], np.minimum(ra, rb)[apart_]
            np.minimum.at(root, a, b)
            while (root[root] != root).any():
                root[:] = root[root]


def apart(x, y):
    """Distances between rows of length one."""
    import numpy as np
    return np.sqrt(np.maximum(2 - 2 * (x @ y.T), 0))


def unit(x):
    """Rows of length one, in double precision; scaled first, so that very
    large or small components neither overflow nor vanish."""
    import numpy as np
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def op10_metric_join(spark, sf_dir):
    """Links and components of every embedding at cosine 0.98."""
    return similar_vectors(table(spark, sf_dir, "embeddings"))
