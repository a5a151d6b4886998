"""Near-duplicate vectors by an inverted multi-index.

Each half of the unit vectors has a codebook of its own; a vector lies in the cell of the product
grid that its two nearest code words name. From a vector's own cell a multi-sequence traversal visits
cells in order of how far the vector would have to move to lie there, until the distance at which
``RECALL`` of the neighbours that are just similar enough are met; this distance is measured on the
sample that the codebooks are trained on (``SAMPLE`` vectors in the mean, drawn by hash). Candidates
are verified by their cosine in double precision.

All vectors are indexed and all are queries. Equal vectors are one from the start. A pair is looked at
once: in the later of its vectors' regions of the grid, where the earlier vector calls. A region with
many vectors or callers is dealt out in blocks of both. Links are counted and replaced by a spanning
forest where they are found, so a group of n similar vectors gives n rows, not n * n.

Vectors that are null, zero or hold null or non-finite components link with nothing and are their own
component; so do all if the table holds a single one. Rows that repeat an id and its vector are one.
A null id is kept, without links. Shorter vectors are padded with zeros.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termweave.llm.components import components
from termweave.llm.shared import stage

LEAST, RECALL, SAMPLE = 0.95, 0.995, 20_000
#: Vectors in a cell in the mean; columns of the grid that a region spans; rows of a block.
CELL, SPAN, MEMBERS, CALLERS = 64, 16, 1024, 4096


class Grid:
    """Two codebooks, and the squared distance at which a traversal stops."""

    def __init__(self, sample: np.ndarray, n: int, least: float = LEAST, recall: float = RECALL, seed: int = 3):
        rng = np.random.default_rng(seed)
        size = int(max(1, min(4096, len(sample) // 4, round(np.sqrt(n / CELL)))))
        self.half = sample.shape[1] // 2
        self.books = [self._codebook(x, size, rng) for x in self.halves(sample)]
        # neighbours of the sample at just this similarity, in a random direction
        x = sample[rng.permutation(len(sample))[:4000]]
        turn = rng.standard_normal(x.shape)
        turn -= (turn * x).sum(1, keepdims=True) * x
        turn /= np.maximum(np.linalg.norm(turn, axis=1, keepdims=True), 1e-300)
        y = least * x + np.sqrt(1 - least * least) * turn
        (a, b), cells = self.moves(x), self.cells(y)
        at = np.arange(len(x))
        self.stop = float(np.quantile(a[at, cells[0]] + b[at, cells[1]], recall))

    def halves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return x[:, : self.half], x[:, self.half :]

    @staticmethod
    def _codebook(x: np.ndarray, size: int, rng) -> np.ndarray:
        book = x[rng.permutation(len(x))[:size]].copy()
        for _ in range(10):
            near = Grid._far(x, book).argmin(1)
            count = np.bincount(near, minlength=size)
            total = np.zeros_like(book)
            np.add.at(total, near, x)
            full = count > 0
            book[full] = total[full] / count[full, None]
        # neighbours in the book are near each other along its main direction
        if size > 1 and x.shape[1]:
            _, _, main = np.linalg.svd(book - book.mean(0), full_matrices=False)
            book = book[np.argsort(book @ main[0], kind="stable")]
        return book

    @staticmethod
    def _far(x: np.ndarray, book: np.ndarray) -> np.ndarray:
        return (x * x).sum(1)[:, None] - 2 * x @ book.T + (book * book).sum(1)

    def cells(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return tuple(self._far(h, b).argmin(1) for h, b in zip(self.halves(x), self.books, strict=True))

    def moves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Squared distance from each half to the region of each code word."""
        out = []
        for h, book in zip(self.halves(x), self.books, strict=True):
            far = self._far(h, book)
            own = far.argmin(1)
            apart = np.sqrt(np.maximum(self._far(book, book), 1e-300))[own]
            gap = np.maximum(far - far[np.arange(len(h)), own][:, None], 0) / (2 * apart)
            gap[np.arange(len(h)), own] = 0
            out.append(gap**2)
        return tuple(out)

    def visits(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Cells that each vector's traversal visits: vector, row and column of the grid.

        Both lists of moves are sorted; cells are taken by the sum of their places in them, along the
        border of those visited, as long as the sum of moves is within the stop.
        """
        a, b = self.moves(x)
        order_a, order_b = np.argsort(a, 1, kind="stable"), np.argsort(b, 1, kind="stable")
        a, b = np.take_along_axis(a, order_a, 1), np.take_along_axis(b, order_b, 1)
        found = []
        for i in range(a.shape[1]):
            live = np.flatnonzero(a[:, i] <= self.stop)
            for j in range(b.shape[1]):
                live = live[a[live, i] + b[live, j] <= self.stop]
                if not len(live):
                    break
                found.append((live, order_a[live, i], order_b[live, j]))
        return tuple(np.concatenate(p) for p in zip(*found, strict=True))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Rows of doubles, padded with zeros."""
    size = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), dims))
    out[np.arange(dims) < size[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _block(least: float, dims: int):
    """Links of a block: rid, n (weight of its linked vectors) and root of each row that has any."""

    def run(table: pa.Table) -> pa.Table:
        x = _unit(_matrix(table.column("vec").combine_chunks(), dims))
        rid, weight, home = (table.column(c).to_numpy() for c in ("rid", "m", "home"))
        calls, member = (table.column(c).to_numpy(zero_copy_only=False) for c in ("calls", "member"))
        here = int(table.column("region")[0].as_py())
        p, q = np.flatnonzero(calls), np.flatnonzero(member)
        count, root = np.zeros(len(x), np.int64), np.arange(len(x))
        for k in range(0, len(p), 1024):
            part = p[k : k + 1024]
            close = x[part] @ x[q].T >= least
            # callers from earlier regions meet all; those at home the ones with larger ids
            close &= (home[part] != here)[:, None] | (rid[part][:, None] < rid[q])
            a, b = np.nonzero(close)
            a, b = part[a], q[b]
            np.add.at(count, a, weight[b])
            np.add.at(count, b, weight[a])
            while True:  # the smallest of what is linked, until all agree
                low = np.minimum(root[a], root[b])
                new = root.copy()
                np.minimum.at(new, root[a], low)
                np.minimum.at(new, root[b], low)
                new = new[new]
                if (new == root).all():
                    break
                root = new
        while (root[root] != root).any():
            root = root[root]
        hit = count > 0
        return pa.Table.from_arrays([pa.array(rid[hit]), pa.array(count[hit]), pa.array(rid[root][hit])], names=["rid", "n", "root"])

    return run


def classes(vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", least: float = LEAST) -> DataFrame:
    """id, n_links, component_id and kept of each vector."""
    src = vectors.select(F.col(id).alias("id"), F.col(vector).alias("vec"))
    bad = lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))
    fit = F.col("id").isNotNull() & F.coalesce(~F.exists("vec", bad) & F.exists("vec", lambda v: v != 0), F.lit(False))
    names = [F.xxhash64("vec", F.lit(k)).alias(f"h{k}") for k in (1, 2)]
    named = src.withColumn("fit", fit)
    members = stage(named.where("fit").select("id", *names).distinct())
    first = named.where("fit").select("id", "vec", *names).groupBy("h1", "h2")
    copies = members.groupBy("h1", "h2").agg(F.count("*").alias("m"))
    reps = first.agg(F.min("id").alias("rid"), F.first("vec").alias("vec")).join(copies, ["h1", "h2"])
    reps = stage(reps)
    rest = src.where(~fit).select("id").distinct()
    rest = rest.select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    facts = reps.agg(F.count("*").alias("n"), F.max(F.size("vec")).alias("dims")).first()
    if facts["n"]:
        links, roots = _links(reps, facts["n"], facts["dims"] + facts["dims"] % 2, least)
        own = reps.select("h1", "h2", "rid", "m").join(links, "rid", "left").join(roots, "rid", "left")
        own = own.select(
            "h1", "h2", (F.col("m") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), F.coalesce("root", "rid").alias("component_id")
        )
        rest = members.join(own, ["h1", "h2"]).select("id", "n_links", "component_id").union(rest)
    kept = F.coalesce(F.col("id") == F.col("component_id"), F.lit(False))
    return rest.select(F.col("id").alias(id), "n_links", "component_id", kept.alias("kept"))


def _links(reps: DataFrame, n: int, dims: int, least: float) -> tuple[DataFrame, DataFrame]:
    """Weight of the linked vectors of each rid that has any, and its root."""
    draw = F.pmod(F.xxhash64("rid", F.lit(7)), F.lit(1 << 30))
    sample = reps.where(draw < int(min(1.0, SAMPLE / n) * (1 << 30))).orderBy("rid").select("vec").toArrow()
    sample = _unit(_matrix(sample.column("vec").combine_chunks(), dims)) if sample.num_rows else np.ones((1, dims)) / np.sqrt(dims)
    grid = reps.sparkSession.sparkContext.broadcast(Grid(sample, n, least))

    def locate(batches):
        spans = -(-len(grid.value.books[1]) // SPAN)
        for whole in batches:
            for k in range(0, whole.num_rows, 1024):
                batch = whole.slice(k, 1024)
                x = _unit(_matrix(batch.column("vec"), dims))
                i, j = grid.value.cells(x)
                home = i * spans + j // SPAN
                who, a, b = grid.value.visits(x)
                calls = np.unique(np.stack([who, a * spans + b // SPAN], 1), axis=0)
                calls = calls[calls[:, 1] > home[calls[:, 0]]]
                ends = np.cumsum(np.append(0, np.bincount(calls[:, 0], minlength=len(x)))).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(calls[:, 1]))
                yield pa.RecordBatch.from_arrays([batch.column("rid"), batch.column("m"), batch.column("vec"), pa.array(home), lists], names=["rid", "m", "vec", "home", "calls"])

    kinds = {c: reps.schema[c].dataType.simpleString() for c in ("rid", "m", "vec")}
    schema = ", ".join(f"{c} {k}" for c, k in kinds.items()) + ", home long, calls array<long>"
    placed = stage(reps.select("rid", "m", "vec").mapInArrow(locate, schema))
    at_home = placed.select("rid", "m", "vec", "home", F.col("home").alias("region"), F.lit(True).alias("member"))
    callers = placed.select("rid", "m", "vec", "home", F.explode("calls").alias("region"), F.lit(False).alias("member"))
    # regions with more than a block of members or callers, a share of all vectors at most
    load = placed.select(F.col("home").alias("region"), F.lit(1).alias("member")).union(
        placed.select(F.explode("calls").alias("region"), F.lit(0).alias("member"))
    )
    load = load.groupBy("region").agg(F.sum("member").alias("members"), F.count("*").alias("callers"))
    load = load.where((F.col("members") > MEMBERS) | (F.col("callers") > CALLERS)).select(
        "region", F.ceil(F.col("members") / MEMBERS).alias("mb"), F.ceil(F.col("callers") / CALLERS).alias("cb")
    )
    one = lambda c: F.coalesce(F.col(c), F.lit(1)).cast("long")
    rows = at_home.union(callers).join(load, "region", "left").withColumns({"mb": one("mb"), "cb": one("cb")})
    mine = {c: F.pmod(F.xxhash64("rid", F.lit(s)), F.col(c)) for c, s in (("mb", 13), ("cb", 17))}
    upto = lambda c: F.sequence(F.lit(0).cast("long"), F.col(c) - 1)
    # a caller goes to all blocks of members, a member to all blocks of callers
    to_members = F.transform(upto("mb"), lambda x: F.struct(x.alias("x"), mine["cb"].alias("y")))
    to_callers = F.when(F.col("member"), F.transform(upto("cb"), lambda y: F.struct(mine["mb"].alias("x"), y.alias("y")))).otherwise(
        F.expr("cast(array() as array<struct<x:bigint,y:bigint>>)")
    )
    rows = rows.withColumn("at", F.explode(F.array_union(to_members, to_callers))).select(
        "region", "at.x", "at.y", "rid", "m", "vec", "home",
        (F.col("at.y") == mine["cb"]).alias("calls"),
        (F.col("member") & (F.col("at.x") == mine["mb"])).alias("member"),
    )
    found = stage(rows.groupBy("region", "x", "y").applyInArrow(_block(least, dims), "rid long, n long, root long"))
    joined = components(found.select(F.col("rid").alias("a"), F.col("root").alias("b")))
    return found.groupBy("rid").agg(F.sum("n").alias("n")), joined.withColumnRenamed("node", "rid")
