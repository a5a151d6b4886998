"""Best-fit packing of documents into sequences by a grouping genetic algorithm on islands.

Documents are encoded and closed by an end id. Those longer than a sequence are cut into whole
sequences, of which the first may be shorter; whole ones stand alone, everything else is packed.

Pieces are dealt into shards of about ``SHARD``, every shard onto ``ISLANDS`` islands. An island
evolves packings of its shard: crossover takes a packing, puts in whole well-filled bins of another,
removes the bins that would hold a document twice, and puts the documents displaced by that where
they fit best. After an epoch the islands of a shard exchange their best packings and go on. Of the
better island's packing bins that are all but full are final; the pieces of the others are dealt
into new, fewer shards, until one shard is left. Where sizes don't add up to full bins and a level
leaves more than ``LEAVES`` of its pieces that way, bins that are over half full are final too. A
shard has one other at most, so the pool shrinks and no shard's remainder stays open.

Every task holds a shard at most; assignments stay tables. Null and empty texts are the end id
alone. Repeated rows are documents of their own. Tables without rows give none.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termweave.llm import text as T
from termweave.llm.bpe import Bpe
from termweave.llm.shared import stage

LENGTH, END = 2048, 0
SHARD, ISLANDS, EPOCHS = 16_000, 2, 2
POPULATION, CROSSINGS = 4, 12
#: A bin with at least so many tokens is final.
FULL = LENGTH - 1
#: The share of its pieces that a level may leave to the next one.
LEAVES = 0.75


def pieces(docs: DataFrame, bpe: Bpe, id: str = "doc_id", text: str = "text", added: dict[bytes, int] | None = None) -> DataFrame:
    """id, piece, start, length and ids_crc32 of every piece; added: tokens beside the ranks, by their bytes."""
    src = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(bpe)

    def run(batches):
        bpe = shared.value
        for batch in T.chunked(batches, "text"):
            ids, first = bpe.encode_added(T.Flat.of(batch.column("text")), added or {})
            n = np.diff(first) + 1
            all_ids = np.full(int(n.sum()), END, "<u4")
            begin = np.cumsum(n) - n
            all_ids[np.arange(len(ids)) + np.repeat(np.arange(len(n)), n - 1)] = ids
            count = -(-n // LENGTH)
            doc = np.repeat(np.arange(len(n)), count)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
            head = n - LENGTH * (count - 1)
            start = np.where(piece > 0, head[doc] + LENGTH * (piece - 1), 0)
            length = np.where(piece > 0, LENGTH, head[doc])
            at = begin[doc] + start
            crc = [zlib.crc32(all_ids[a:b].tobytes()) for a, b in zip(at.tolist(), (at + length).tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(doc)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array(crc, pa.int64())],
                names=["id", "piece", "start", "length", "ids_crc32"],
            )
        bpe.close()

    kind = src.schema["id"].dataType.simpleString()
    return src.mapInArrow(run, f"id {kind}, piece int, start long, length long, ids_crc32 long")


class Shelf:
    """Open bins by the room that is left in them, for best fit."""

    def __init__(self, rooms: list[int] = ()):
        self.by_room: dict[int, list[int]] = {}
        self.bits = 0
        self.n = len(rooms)
        for k, room in enumerate(rooms):
            self.put(k, room)

    def put(self, bin: int, room: int) -> None:
        if room:
            self.by_room.setdefault(room, []).append(bin)
            self.bits |= 1 << room

    def place(self, size: int) -> int:
        """The fullest bin that has room for it, or a new one."""
        fitting = self.bits >> size
        if not fitting:
            bin, room = self.n, LENGTH
            self.n += 1
        else:
            room = size + (fitting & -fitting).bit_length() - 1
            bins = self.by_room[room]
            bin = bins.pop()
            if not bins:
                self.bits &= ~(1 << room)
        self.put(bin, room - size)
        return bin


def best_fit(sizes: np.ndarray, order: np.ndarray) -> np.ndarray:
    """The bin of each piece, placed in the order given."""
    shelf, out = Shelf(), np.empty(len(sizes), np.int64)
    for k, size in zip(order.tolist(), sizes[order].tolist(), strict=True):
        out[k] = shelf.place(size)
    return out


def fitness(sizes: np.ndarray, bins: np.ndarray) -> tuple[int, float]:
    """Fewer bins first, then fuller ones: to be minimised."""
    fill = np.bincount(bins, sizes)
    fill = fill[fill > 0]
    return len(fill), -float(((fill / LENGTH) ** 2).sum())


def crossover(sizes: np.ndarray, into: np.ndarray, source: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """``into`` with some well-filled bins of ``source``, and displaced pieces where they fit best."""
    fill = np.bincount(source, sizes)
    well = np.flatnonzero(fill >= max(LENGTH - 8, np.quantile(fill, 0.5)))
    well = rng.permutation(well)[: max(1, len(well) // 2)]
    injected = np.isin(source, well)
    # a bin that shares a piece with an injected one goes; what else it held is displaced
    gone = np.unique(into[injected])
    # so do some of the emptiest, whose pieces then find better places
    own = np.bincount(into, sizes)
    open_ = np.flatnonzero((own > 0) & (own < FULL))
    gone = np.union1d(gone, open_[np.argsort(own[open_])[: max(1, len(open_) // 2)]])
    displaced = np.isin(into, gone) & ~injected
    stays = ~injected & ~displaced
    out = np.empty(len(sizes), np.int64)
    kept, out[stays] = np.unique(into[stays], return_inverse=True)
    more, place = np.unique(source[injected], return_inverse=True)
    out[injected] = place + len(kept)
    fill = np.bincount(out[stays | injected], sizes[stays | injected], len(kept) + len(more))
    shelf = Shelf((LENGTH - fill).astype(int).tolist())
    loose = np.flatnonzero(displaced)
    jitter = sizes[loose] + rng.random(len(loose)) * rng.choice([0, 0, 16, 64])
    for k in loose[np.argsort(-jitter, kind="stable")].tolist():
        out[k] = shelf.place(int(sizes[k]))
    return out


def evolve(sizes: np.ndarray, elites: list[np.ndarray], seed: int, crossings: int = CROSSINGS) -> np.ndarray:
    """The best packing that a population of an island comes to."""
    rng = np.random.default_rng(seed)
    least = -(-int(sizes.sum()) // LENGTH)
    people = list(elites) or [best_fit(sizes, np.argsort(-sizes, kind="stable"))]
    while len(people) < POPULATION:
        people.append(best_fit(sizes, np.argsort(-(sizes + rng.random(len(sizes)) * 2 ** rng.integers(2, 9)))))
    ranked = sorted(((fitness(sizes, p), k, p) for k, p in enumerate(people)), key=lambda x: x[:2])
    for k in range(crossings):
        if ranked[0][0][0] <= least:
            break
        a, b = rng.choice(len(ranked), 2, replace=False, p=np.arange(len(ranked), 0, -1) / (len(ranked) * (len(ranked) + 1) / 2))
        child = crossover(sizes, ranked[a][2], ranked[b][2], rng)
        ranked.append((fitness(sizes, child), len(people) + k, child))
        ranked = sorted(ranked, key=lambda x: x[:2])[:POPULATION]
    return ranked[0][2]


def _island(epoch: int):
    """An island's epoch: (shard, island, row, length, elite) in, (shard, island, row, length, bin) out."""

    def run(key, table):
        table = table.sort_by("row")
        sizes = table.column("length").to_numpy()
        island = key[1].as_py()
        elites = []
        if epoch:
            bins = table.column("elites").combine_chunks()
            elites = list(bins.values.to_numpy().reshape(len(sizes), -1).T)
            elites = [elites[island], *elites[:island], *elites[island + 1 :]]
        best = evolve(sizes, elites, 1000 * epoch + 10 * (key[0].as_py() % 99) + island)
        made, best = np.unique(best, return_inverse=True)
        fill = np.bincount(best, sizes)
        quality = pa.array(np.full(len(sizes), len(made) - ((fill / LENGTH) ** 2).sum() / (len(fill) + 1)))
        return pa.Table.from_arrays(
            [table.column("shard"), table.column("island"), table.column("row"), table.column("length"), pa.array(best), pa.array(fill[best].astype(np.int64)), quality],
            names=["shard", "island", "row", "length", "bin", "fill", "quality"],
        )

    return run


def packed(items: DataFrame, shard: int = SHARD) -> DataFrame:
    """row, sequence_id and offset of items (row, length) of 1 to LENGTH tokens."""
    done, pool, level = None, items, 0
    left = pool.count()
    while left:
        shards = -(-left // shard)
        last = shards == 1
        dealt = pool.withColumn("shard", F.pmod(F.xxhash64("row", F.lit(level)), F.lit(shards)))
        islands = dealt.withColumn("island", F.explode(F.array(*map(F.lit, range(ISLANDS)))))
        schema = "shard long, island int, row long, length long, bin long, fill long, quality double"
        for epoch in range(EPOCHS):
            if epoch:  # elites migrate: every island of a shard gets those of all
                elites = found.groupBy("shard", "row").agg(  # noqa: F821
                    F.first("length").alias("length"), F.transform(F.array_sort(F.collect_list(F.struct("island", "bin"))), lambda x: x["bin"]).alias("elites")
                )
                islands = elites.withColumn("island", F.explode(F.array(*map(F.lit, range(ISLANDS)))))
            found = stage(islands.groupBy("shard", "island").applyInArrow(_island(epoch), schema))
        best = found.groupBy("shard").agg(F.min(F.struct("quality", "island")).alias("b")).select("shard", "b.island")
        found = found.join(best, ["shard", "island"])
        before = left
        # placing opens no bin while another has room: one a shard is half full or less. Of shards
        # smaller than that bin's pieces can be, all bins are final where nothing else shrinks the pool
        for least in (0,) if last else (FULL, LENGTH // 2 + 1, 0):
            pool = found.where(F.col("fill") < least).select("row", "length")
            left = pool.count() if least else 0
            if left <= LEAVES * before:
                break
        final = found.where(F.col("fill") >= least)
        final = final.select("row", "length", (F.lit(level) * (1 << 56) + F.col("shard") * (1 << 24) + F.col("bin")).alias("sequence_id"))
        done = final if done is None else done.union(final)
        level += 1
    if done is None:
        return items.sparkSession.createDataFrame([], "row long, sequence_id long, offset long")

    # a sequence holds LENGTH pieces at most
    inside = F.array_sort(F.collect_list(F.struct((-F.col("length")).alias("size"), "row")))
    bins = done.groupBy("sequence_id").agg(inside.alias("rows"))
    ends = F.aggregate(
        "rows", F.array(F.lit(0).cast("long")), lambda upto, x: F.concat(upto, F.array(F.element_at(upto, -1) - x["size"]))
    )
    placed = bins.select("sequence_id", F.explode(F.arrays_zip("rows", ends.alias("ends"))).alias("x")).where("x.rows is not null")
    return placed.select(F.col("x.rows.row").alias("row"), "sequence_id", F.col("x.ends").alias("offset"))


def sequences(docs: DataFrame, bpe: Bpe, id: str = "doc_id", text: str = "text", added: dict[bytes, int] | None = None) -> DataFrame:
    """id, piece, start, length, ids_crc32, sequence_id and offset of every piece."""
    cut = stage(pieces(docs, bpe, id, text, added).withColumn("row", F.monotonically_increasing_id()))
    whole = cut.where(F.col("length") == LENGTH).withColumns(
        {"sequence_id": -1 - F.col("row"), "offset": F.lit(0).cast("long")}
    )
    rest = cut.where(F.col("length") < LENGTH)
    rest = rest.join(packed(rest.select("row", "length")), "row")
    columns = ["piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    return whole.select("id", *columns).union(rest.select("id", *columns)).withColumnRenamed("id", id)
