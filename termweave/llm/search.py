"""Ranked lexical search in reverse: documents stream through an inverted index of the items.

The items, few and short beside the documents, are the index: each of their terms with the items
that hold it and how often. It is broadcast in blocks of at most ``POSTINGS`` entries, so its size
is bounded whatever the number of items; every block reads all documents, once for the counts that
weigh its terms, once to rank. A document's term counts go through the index and give its scores
for all items at once; every task keeps a heap of the ``TOP`` best for each item, and what is below
an item's heap is dropped on the spot. Heaps are merged by rank within an item, at most ``TOP`` rows
of an item from any task.

Terms are runs of ASCII letters, digits and other scripts' characters, A to Z lower-cased. A term's
weight is floor(1000 ln((2N + 2) / (2 df + 1))); a document adds w (10^9 tf div (1000 tf + 8 m)) for
each occurrence of a term in the item, m = 25 + (75 n N) div L, all in 64-bit integers.

Null and empty texts have no terms and are never found; items without terms find nothing. Repeated
documents are ranked one by one, equal scores by id, null ids last. Every row of the items is an
item of its own, also where ids repeat or are null. Terms are known by 64-bit hashes, see ``text``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from termweave.llm import text as T
from termweave.llm.shared import stage

#: Documents of an item; entries of the index that are broadcast at once, 12 bytes each.
TOP, POSTINGS = 10, 1 << 20
#: Weight of a document's length, in percent.
SLOPE = 75

_TERM = np.isin(np.arange(256), [*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)])


def terms(flat: T.Flat) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text of each term, repeats included, in order."""
    w = T.runs(flat, _TERM)
    return T.slice_hash(flat.sums(lower=True), w.starts, w.ends), w.doc


class Index:
    """Terms of some items: which items hold them, and how often."""

    def __init__(self, keys: np.ndarray, items: np.ndarray, times: np.ndarray, term: np.ndarray, rows: int):
        """keys: the distinct terms; (term, items, times): entries in the order of terms; rows: of items."""
        self.keys, self.items, self.times, self.rows = keys, items, times, rows
        self.first = np.concatenate([[0], np.cumsum(np.bincount(term, minlength=len(keys)))])
        self.table: T.SlotTable | None = None

    @staticmethod
    def of(column: pa.Array) -> Index:
        key, row = terms(T.Flat.of(column))
        keys, term = np.unique(key, return_inverse=True)
        cell, times = np.unique(term * max(1, len(column)) + row, return_counts=True)
        term, items = np.divmod(cell, max(1, len(column)))
        return Index(keys, items.astype(np.int32), times.astype(np.int32), term, len(column))

    def __getstate__(self):
        return self.__dict__ | {"table": None}  # made in the task, not sent

    def counts(self, flat: T.Flat) -> tuple[np.ndarray, ...]:
        """Document, term and count of each term of the index in each document; all terms of each."""
        if self.table is None:
            self.table = T.SlotTable(max(12, len(self.keys).bit_length() + 2))
            self.table.add(self.keys)
        key, doc = terms(flat)
        term = self.table.find(key)
        known = term >= 0
        cell, tf = np.unique(doc[known] * max(1, len(self.keys)) + term[known], return_counts=True)
        doc_of, term = np.divmod(cell, max(1, len(self.keys)))
        return doc_of, term, tf, np.bincount(doc, minlength=len(flat))


def weights(df: np.ndarray, n: int) -> np.ndarray:
    return np.floor(1000 * np.log((2 * n + 2) / (2 * df + 1))).astype(np.int64)


def blocks(items: DataFrame) -> Iterator[tuple[np.ndarray, Index]]:
    """``row`` and the index of the staged items (row, text), block by block.

    A text has a term for every two bytes at most; by that, a block has POSTINGS entries beside its
    last item's. Only the sizes of the items' parts reach the driver, not their texts.
    """
    spark = items.sparkSession
    part, most = F.shiftright("row", 33), F.ceil((F.coalesce(F.octet_length("text"), F.lit(0)) + 1) / 2)
    sizes = items.groupBy(part.alias("part")).agg(F.sum(most).alias("n")).orderBy("part").collect()
    before = np.cumsum([0, *(r["n"] for r in sizes)]).tolist()
    offsets = spark.createDataFrame([(r["part"], before[k]) for k, r in enumerate(sizes)], "part long, before long")
    inside = F.sum(most).over(Window.partitionBy("part").orderBy("row"))
    numbered = items.withColumn("part", part).join(offsets, "part").withColumn("upto", F.col("before") + inside)
    dealt = stage(numbered.select("row", "text", F.floor((F.col("upto") - 1) / POSTINGS).alias("block")))
    for (block,) in sorted(dealt.select("block").distinct().collect()):
        rows = dealt.where(F.col("block") == block).select("row", "text").toArrow().combine_chunks()
        yield rows.column("row").to_numpy(), Index.of(rows.column("text"))


def statistics(docs: DataFrame, index: Index) -> tuple[int, int, np.ndarray]:
    """Documents with a term, their terms with repeats, and the documents that hold each term of the index."""
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def run(batches):
        own = shared.value
        held, n, length = np.zeros(len(own.keys), np.int64), 0, 0
        for batch in T.chunked(batches, "text"):
            _, term, _, size = own.counts(T.Flat.of(batch.column("text")))
            held += np.bincount(term, minlength=len(held))
            n, length = n + int((size > 0).sum()), length + int(size.sum())
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([[-2, -1], at]), pa.int64()), pa.array(np.concatenate([[n, length], held[at]]), pa.int64())], names=["k", "n"]
        )

    # two rows, and one for each of the block's terms, from each task; as many as terms to the driver
    found = docs.select("text").mapInArrow(run, "k long, n long").groupBy("k").agg(F.sum("n").alias("n")).toArrow()
    shared.destroy()
    k, n = (found.column(c).to_numpy() for c in ("k", "n"))
    held = np.zeros(len(index.keys), np.int64)
    held[k[k >= 0]] = n[k >= 0]
    return int(n[k == -2].sum()), int(n[k == -1].sum()), held


class Heaps:
    """The best ``top`` documents of each item so far."""

    def __init__(self, items: int, kind: pa.DataType, top: int):
        self.top, self.least = top, np.ones(items, np.int64)
        self.rows = pa.table({"item": pa.array([], pa.int32()), "score": pa.array([], pa.int64()), "id": pa.array([], kind)})

    def push(self, scores: np.ndarray, ids: pa.Array) -> None:
        """scores: documents x items. Those below an item's heap go at once."""
        doc, item = np.nonzero(scores >= self.least)
        if not len(doc):
            return
        new = pa.table({"item": pa.array(item.astype(np.int32)), "score": pa.array(scores[doc, item]), "id": ids.take(pa.array(doc))})
        touched = np.zeros(len(self.least), bool)
        touched[item] = True
        open_ = touched[self.rows.column("item").to_numpy()]
        rest = self.rows.filter(pa.array(~open_))
        rows = pa.concat_tables([self.rows.filter(pa.array(open_)), new])
        order = pc.sort_indices(rows, sort_keys=[("item", "ascending"), ("score", "descending"), ("id", "ascending")], null_placement="at_end")
        rows = rows.take(order).combine_chunks()
        item = rows.column("item").to_numpy()
        n = np.bincount(item, minlength=len(self.least))
        place = np.arange(len(item)) - np.repeat(np.cumsum(n) - n, n)
        last = np.flatnonzero(place == self.top - 1)
        self.least[item[last]] = rows.column("score").to_numpy()[last]  # equal ones may have a smaller id
        self.rows = pa.concat_tables([rest, rows.filter(pa.array(place < self.top))]).combine_chunks()


def scores(index: Index, weight: np.ndarray, n_docs: int, length: int, flat: T.Flat) -> np.ndarray:
    """Of each text for each item of the index."""
    doc, term, tf, size = index.counts(flat)
    m = (100 - SLOPE) + (SLOPE * size * n_docs) // max(1, length)
    value = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[doc]))
    many = index.first[term + 1] - index.first[term]
    upto = np.cumsum(many)
    entry = np.arange(int(upto[-1]) if len(upto) else 0) + np.repeat(index.first[term] - (upto - many), many)
    out = np.zeros(len(flat) * index.rows, np.int64)
    np.add.at(out, np.repeat(doc, many) * index.rows + index.items[entry], np.repeat(value, many) * index.times[entry])
    return out.reshape(len(flat), index.rows)


def _best(docs: DataFrame, rows: np.ndarray, index: Index, top: int) -> DataFrame:
    """row of the items, score and id: the best of docs (id, text), as each task finds them."""
    n_docs, length, held = statistics(docs, index)
    shared = docs.sparkSession.sparkContext.broadcast((index, weights(held, n_docs), rows))
    # as many scores at once as a chunk has bytes
    limit = max(1, T.CHUNK // max(1, index.rows))

    def run(batches):
        own, weight, names = shared.value
        heaps = None
        for whole in T.chunked(batches, "text"):
            heaps = heaps or Heaps(own.rows, whole.column("id").type, top)
            for at in range(0, whole.num_rows, limit):
                batch = whole.slice(at, limit)
                heaps.push(scores(own, weight, n_docs, length, T.Flat.of(batch.column("text"))), batch.column("id"))
        if heaps and len(heaps.rows):
            found = heaps.rows
            row = pa.array(names[found.column("item").to_numpy()])
            yield from pa.table({"row": row, "score": found.column("score"), "id": found.column("id")}).to_batches()

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(run, f"row long, score long, id {kind}")


def ranked(
    docs: DataFrame, items: DataFrame, id: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", top: int = TOP
) -> DataFrame:
    """item, rank, id and score of the ``top`` best documents of each item."""
    src = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    named = items.select(F.col(item).alias("item"), F.col(item_text).alias("text"))
    named = stage(named.withColumn("row", F.monotonically_increasing_id()))
    best = docs.sparkSession.createDataFrame([], f"row long, score long, id {src.schema['id'].dataType.simpleString()}")
    for rows, index in blocks(named.select("row", "text")):
        best = best.union(_best(src, rows, index, top))
    order = Window.partitionBy("row").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    merged = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return merged.join(named.select("row", "item"), "row").select(
        F.col("item").alias(item), "rank", F.col("id").alias(id), "score"
    )
