"""Periodic runs of words: Kruskal's algorithm over the suffixes of a text, by decreasing LCP.

Suffixes of a text are sorted; neighbours are united by decreasing length of their longest common
prefix (LCP), with union-find over sets of positions that are kept in order. Two positions that
become neighbours in such a set when it is united at LCP l have exactly l words in common from there
on. If they are d <= l apart, the words from the first on have period d, for d + l words: such a
pair seeds a run, which begins there if the words before the two differ.

Every run is found once, with its smallest period. Let it begin at s with smallest period p and
length n >= 4 p. The suffixes at s and s + p share n - p >= 3 p words. A position between them in
their set would give a smaller period to a stretch longer than both periods together, and so a
period that divides p: s and s + p are neighbours when they meet. A pair whose distance isn't the
smallest period of its stretch has such a position in between and never becomes one.

Runs of ``LEAST`` words and ``TIMES`` periods at least count. Each ``LEAST - 1`` words of one occur
again in it, so only words in such repeated windows are sorted; what lies between is one mark.

Null and empty texts have no words and no runs. Rows are read one by one, so repeated rows give
repeated results; a text is worked on whole, however long. Words are told apart by 64-bit hashes,
see ``text``.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termweave.llm import text as T

LEAST, TIMES = 6, 4
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def suffixes(names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in the order of the suffixes from there, and the LCP of each with the next.

    The names of 1, 2, 4, … words from each place are numbered, until all numbers differ.
    """
    n = len(names)
    levels, width = [np.unique(names, return_inverse=True)[1].astype(np.int64)], 1
    while n and levels[-1].max() < n - 1:
        rank = levels[-1]
        behind = np.zeros(n, np.int64)
        behind[: n - width] = rank[width:] + 1
        levels.append(np.unique(rank * (n + 1) + behind, return_inverse=True)[1].astype(np.int64))
        width *= 2
    order = np.empty(n, np.int64)
    order[levels[-1]] = np.arange(n)
    a, b = order[:-1].copy(), order[1:].copy()
    shared = np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        inside = np.flatnonzero(np.maximum(a, b) < n)
        same = inside[levels[k][a[inside]] == levels[k][b[inside]]]
        for x in (a, b, shared):
            x[same] += 1 << k
    return order, shared


def seeds(names: np.ndarray, least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run in a list of names."""
    order, shared = suffixes(names)
    edges = np.flatnonzero(shared >= least - 1)
    edges = edges[np.argsort(-shared[edges], kind="stable")]
    parent = list(range(len(names)))
    places: dict[int, list[int]] = {}
    before = np.concatenate([[-1], names[:-1]]).tolist() if len(names) else []
    out = []

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    def seed(x: int, y: int, lcp: int) -> None:
        d = y - x
        if d + lcp >= max(least, times * d) and (x == 0 or before[x] != before[y]):
            out.append((x, d + lcp, d))

    for x, y, lcp in zip(order[edges].tolist(), order[edges + 1].tolist(), shared[edges].tolist(), strict=True):
        a, b = find(x), find(y)
        few, many = places.pop(a, None) or [a], places.pop(b, None) or [b]
        if len(few) > len(many):
            a, b, few, many = b, a, many, few
        parent[a] = b
        last, at = len(few) - 1, 0
        for k, place in enumerate(few):  # neighbours from the two sets
            at = bisect_left(many, place, at)
            if at and (not k or few[k - 1] < many[at - 1]):
                seed(many[at - 1], place, lcp)
            if at < len(many) and (k == last or few[k + 1] > many[at]):
                seed(place, many[at], lcp)
        if last < 8:
            for place in few:
                insort(many, place)
        else:
            many += few
            many.sort()
        places[b] = many
    return out


def runs(flat: T.Flat, w: T.Spans, least: int = LEAST, times: int = TIMES) -> tuple[np.ndarray, ...]:
    """Text, start, length and period of every run, by text, start and period; w: the texts' words."""
    size = least - 1
    key = T.keys_in_doc(T.slice_hash(flat.sums(), w.starts, w.ends), w.doc)
    window = T.shingles(key, size)
    _, back, n = np.unique(window, return_inverse=True, return_counts=True)
    again = np.flatnonzero((n[back] > 1) & (w.doc[size - 1 :] == w.doc[: len(window)])) if len(window) else np.zeros(0, np.int64)
    cover = np.zeros(len(w) + 1, np.int64)
    np.add.at(cover, again, 1)
    np.add.at(cover, again + size, -1)
    place = np.flatnonzero(np.cumsum(cover[:-1]) > 0)
    if not len(place):
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    # a mark, unlike all else, wherever words are left out
    gap = np.flatnonzero(np.diff(place) > 1) + 1
    names = np.insert(np.unique(key[place], return_inverse=True)[1], gap, len(place) + np.arange(len(gap)))
    origin = np.insert(place, gap, -1)
    found = np.array(seeds(names, least, times), np.int64).reshape(-1, 3)
    at = origin[found[:, 0]]
    doc = w.doc[at]
    start = at - w.first(len(flat))[doc]
    order = np.lexsort((found[:, 2], start, doc))
    return doc[order], start[order], found[order, 1], found[order, 2]


def collapsed(flat: T.Flat, w: T.Spans, doc, start, length, period) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the texts' words joined by a blank, and where each text's begin; words of a run that
    come after its first period are left out."""
    first = w.first(len(flat))
    gone = np.zeros(len(w) + 1, np.int64)
    np.add.at(gone, first[doc] + start + period, 1)
    np.add.at(gone, first[doc] + start + length, -1)
    stays = np.cumsum(gone[:-1]) == 0
    starts, size, of = w.starts[stays], (w.ends - w.starts)[stays], w.doc[stays]
    final = np.append(of[1:] != of[:-1], True)[: len(of)]  # no blank behind a text's last word
    ends = np.cumsum(size + ~final)
    out = np.full(int(ends[-1]) if len(ends) else 0, 0x20, np.uint8)
    begin = ends - size - ~final
    at = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    out[at + np.repeat(begin, size)] = flat.data[at + np.repeat(starts, size)]
    total = np.bincount(of, size + ~final, len(flat)).astype(np.int64)
    return out, np.concatenate([[0], np.cumsum(total)])


def periodic(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), text: str = "text", least: int = LEAST, times: int = TIMES) -> DataFrame:
    """The kept columns, ``runs`` (start, length, period; by start, then period) and ``collapsed``,
    the text with one period of every run."""
    src = docs.select(*keep, F.col(text).alias("_text"))
    kinds = "".join(f"`{c}` {src.schema[c].dataType.simpleString()}, " for c in keep)

    def run(batches):
        for batch in T.chunked(batches, "_text"):
            flat = T.Flat.of(batch.column("_text"))
            w = T.words(flat)
            found = runs(flat, w, least, times)
            data, bounds = collapsed(flat, w, *found)
            ends = np.concatenate([[0], np.cumsum(np.bincount(found[0], minlength=len(flat)))]).astype(np.int32)
            each = pa.StructArray.from_arrays([pa.array(x) for x in found[1:]], fields=list(_RUN))
            texts = pa.Array.from_buffers(pa.large_string(), len(flat), [None, pa.py_buffer(bounds), pa.py_buffer(data)])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.ListArray.from_arrays(pa.array(ends), each), texts.cast(pa.string())],
                names=[*keep, "runs", "collapsed"],
            )

    return src.mapInArrow(run, f"{kinds}runs array<struct<start:long,length:long,period:long>>, collapsed string")


def strongest(runs: Column) -> Column:
    """The run with the greatest length / period, compared exactly; of equal ones the first. NULL without runs."""
    better = lambda x, y: x["length"] * y["period"] > y["length"] * x["period"]
    none = F.lit(None).cast("struct<start:long,length:long,period:long>")
    return F.aggregate(runs, none, lambda best, x: F.when(best.isNull() | better(x, best), x).otherwise(best))


def digests(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Number of runs, the strongest one, and SHA-256 of all runs and of the collapsed text."""
    line = lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    found = periodic(docs, (id,), text).withColumn("best", strongest(F.col("runs")))
    return found.select(
        id,
        F.size("runs").cast("long").alias("n_runs"),
        *(F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def with_planted(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows; in a tenth of them, by the id's CRC-32 h, the words repeat from some word on.

    With g = h div 10 and n words, each word i >= a = g mod n is the original word a + (i - a) mod p,
    p = 1 + (n - a) div (3 + g mod 8). Words of those texts are joined by one blank. Texts without
    words and rows without an id stay as they are.
    """
    h = F.crc32(F.col(id).cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.when(h % 10 == 0, F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))

    def repeated(w: Column) -> Column:
        n = F.size(w).cast("long")
        a = g % n
        p = F.floor((n - a) / (3 + g % 8)) + 1
        at = F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.when(i < a, i).otherwise(a + (i - a) % p))
        return F.array_join(F.transform(at, lambda i: F.get(w, i.cast("int"))), " ")

    marked = docs.withColumn("_words", words)
    new = F.when(F.size("_words") > 0, repeated(F.col("_words"))).otherwise(F.col(text))
    return marked.withColumn(text, new).drop("_words")
