"""Document probability from a lattice of subwords.

A vocabulary with unigram scores spells every word in many ways. A word's probability is the sum
over all its segmentations of the products of the pieces' probabilities, by a forward recursion in
log space; a document's is that of its words and an end. The vocabulary's pieces stay as they are;
their probabilities start from the vocabulary's scores and are re-estimated from the training
documents' distinct words by ``ROUNDS`` of expected counts over all segmentations (forward and
backward recursion). Where training documents have a word, the lattice has one more edge, the word
itself: its weight is its discounted share of the tokens, and the discounts' mass goes to the pieces.

Words are counted over all training documents and scored once each, as a table as large as the
corpus makes it. Documents meet it in two ways: words that make up ``FREQUENT`` of all tokens or
more, 1 / FREQUENT at most, go to every task; the rest is joined by hash.

Null and empty texts consist of the end alone. Repeated rows count as often as they are there, in
training too. Without training documents counts are 0 and the vocabulary's own scores hold.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termweave.llm import text as T
from termweave.llm.shared import stage

FREQUENT, ROUNDS, SMOOTH = 1e-5, 2, 0.1
#: Pieces mark the beginning of a word by this character; bytes that no piece covers have their own.
BEGIN = "▁"
#: Longer words go through the recursion one by one.
LONG = 40
_U = np.uint64
_NONE = -1e30


class Lattice:
    """Pieces as bytes with log probabilities; row 0 is the end of a document, rows 1 to 256 bytes."""

    def __init__(self, pieces: list[bytes], logs: np.ndarray):
        self.pieces, self.logs = pieces, logs
        self.table = None

    @staticmethod
    def from_sentencepiece(path: str) -> Lattice:
        """The pieces of a model file, their scores read as log weights of a long-tailed law.

        Scores that are ranks (whole numbers from 0 down) weigh as 1 / (10 + rank).
        """
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        known = [k for k in range(model.get_piece_size()) if not (model.is_control(k) or model.is_unknown(k) or model.is_byte(k))]
        score = np.array([model.get_score(k) for k in known])
        if (score == np.round(score)).all():
            score = -np.log(10 - score)
        mark = BEGIN.encode()
        text = [model.id_to_piece(k).encode() for k in known]
        fit = [k for k, t in enumerate(text) if mark not in t[1:] and t != mark]
        weight = {T_lower(text[k]).replace(mark, b" "): 0.0 for k in fit}
        for k in fit:
            weight[T_lower(text[k]).replace(mark, b" ")] += float(np.exp(score[k]))
        pieces = [b"", *(bytes([b]) for b in range(256)), *(p for p in weight if len(p) > 1)]
        least = min(weight.values(), default=1.0)
        mass = np.array([max(weight.values(), default=1.0), *(weight.get(bytes([b]), least) for b in range(256)), *(w for p, w in weight.items() if len(p) > 1)])
        return Lattice(pieces, np.log(mass / mass.sum()))

    def _prepare(self) -> None:
        """Table of all beginnings of pieces, made in the task: row of the piece, -1 for a mere beginning."""
        heads = {p[:k]: -1 for p in self.pieces for k in range(1, len(p) + 1)}
        heads |= {p: k for k, p in enumerate(self.pieces) if p}
        flat = T.Flat.of(pa.array(heads, pa.binary()))
        keys, size = np.zeros(len(heads), np.uint64), np.diff(flat.bounds)
        for n in range(int(size.max())):
            live = size > n
            keys[live] = _longer(keys[live], flat.data[flat.bounds[:-1][live] + n])
        self.table, self.rows = T.SlotTable(len(heads).bit_length() + 2), np.array(list(heads.values()), np.int32)
        self.table.add(T.mixed(keys))

    def __getstate__(self):
        return {"pieces": self.pieces, "logs": self.logs, "table": None}

    def edges(self, data: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All pieces within words: where they start and end, and which. stop: the end of each byte's word."""
        if self.table is None:
            self._prepare()
        at, keys, found, n = np.arange(len(data)), np.zeros(len(data), np.uint64), [], 0
        while len(at):
            keys = _longer(keys, data[at + n])
            n += 1
            row = self.table.find(T.mixed(keys))
            head = row >= 0
            at, keys = at[head], keys[head]
            piece = self.rows[row[head]]
            hit = piece >= 0
            found.append((at[hit], at[hit] + n, piece[hit]))
            room = stop[at] - at > n
            at, keys = at[room], keys[room]
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))

    def recursions(self, flat: T.Flat, starts, ends, counts=None):
        """Log probability of each word, a blank before it; with counts also the pieces' expected counts."""
        logs = np.full(len(starts), 0.0)
        expected = None if counts is None else np.zeros(len(self.pieces))
        size = ends - starts
        order = np.argsort(size, kind="stable")
        step = 5000
        short = int(np.searchsorted(size[order], LONG, "right"))
        groups = [order[k : min(k + step, short)] for k in range(0, short, step)] + [order[k : k + 1] for k in range(short, len(order))]
        for pick in groups:
            logs[pick] = self._group(flat, starts[pick], size[pick], None if counts is None else counts[pick], expected)
        return logs if counts is None else (logs, expected)

    def _group(self, flat, starts, size, counts, expected) -> np.ndarray:
        long = size + 1
        base = np.cumsum(long) - long
        data = np.full(int(long.sum()), 0x20, np.uint8)
        inner = np.arange(int(size.sum())) + np.repeat(np.arange(len(size)) + 1, size)
        data[inner] = T.LOWER[flat.data[np.arange(int(size.sum())) + np.repeat(starts - (np.cumsum(size) - size), size)]]
        a, b, piece = self.edges(data, np.repeat(base + long, long))
        weight = self.logs[piece]
        # nodes: places before and after each byte; words lie apart by one node
        shift = np.repeat(np.arange(len(size)), long)
        rel = a - np.repeat(base, long)[a]
        a, b = a + shift[a], b + shift[a]
        first, last = base + np.arange(len(size)), base + np.arange(len(size)) + long
        forward = self._walk(a, b, weight, rel + (b - a), first, len(data) + len(size))
        out = forward[last]
        if counts is not None:
            backward = self._walk(b, a, weight, np.repeat(long, long)[a - shift_of(a, first)] - rel, last, len(data) + len(size))
            word = shift_of(a, first)
            share = np.exp(forward[a] + weight + backward[b] - out[word]) * counts[word]
            expected += np.bincount(piece, share, len(expected))
        return out

    @staticmethod
    def _walk(source, target, weight, level, begin, nodes) -> np.ndarray:
        """Log of the sum over all paths from ``begin`` to each node, edges taken level by level."""
        total = np.full(nodes, _NONE)
        total[begin] = 0.0
        order = np.lexsort((target, level))
        source, target, weight, level = source[order], target[order], weight[order], level[order]
        cuts = np.flatnonzero(np.append(True, level[1:] != level[:-1]))
        for x, y in zip(cuts.tolist(), [*cuts[1:].tolist(), len(level)], strict=True):
            value = total[source[x:y]] + weight[x:y]
            node = target[x:y]
            edge = np.flatnonzero(np.append(True, node[1:] != node[:-1]))
            most = np.maximum.reduceat(value, edge)
            scale = np.repeat(most, np.diff(np.append(edge, y - x)))
            total[node[edge]] = most + np.log(np.add.reduceat(np.exp(value - scale), edge))
        return total


def shift_of(node: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The word that a node belongs to."""
    return np.searchsorted(first, node, "right") - 1


def T_lower(x: bytes) -> bytes:
    """ASCII capitals as small letters."""
    return T.LOWER[np.frombuffer(x, np.uint8)].tobytes()


def _longer(keys: np.ndarray, byte: np.ndarray) -> np.ndarray:
    return keys * _U(0x9E3779B97F4A7C15) + byte + _U(1)


def counted_words(docs: DataFrame, text: str, train: str) -> DataFrame:
    """key, word (ASCII letters lower-cased), n (in training rows) of every distinct word."""
    src = docs.select(F.col(text).alias("text"), F.col(train).alias("train"))

    def run(batches):
        for batch in T.chunked(batches, "text"):
            flat = T.Flat.of(batch.column("text"))
            w = T.words(flat)
            keys = T.slice_hash(flat.sums(lower=True), w.starts, w.ends)
            key, first, back = np.unique(keys, return_index=True, return_inverse=True)
            train = batch.column("train").to_numpy(zero_copy_only=False).astype(bool)
            n = np.bincount(back, train[w.doc], len(key)).astype(np.int64)
            lower = T.Flat(T.LOWER[flat.data], flat.bounds)
            word = T.cut_strings(lower, w.starts[first], w.ends[first])
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), word, pa.array(n)], names=["key", "word", "n"])

    found = src.mapInArrow(run, "key long, word string, n long")
    return found.groupBy("key", "word").agg(F.sum("n").alias("n"))


def trained(words: DataFrame, lattice: Lattice, rounds: int = ROUNDS) -> Lattice:
    """Pieces' probabilities from their expected counts in all distinct training words.

    Each word counts once: frequent words have edges of their own.
    """
    for _ in range(rounds):
        shared = words.sparkSession.sparkContext.broadcast(lattice)

        def run(batches, shared=shared):
            total = np.zeros(len(shared.value.pieces))
            for batch in T.chunked(batches, "word"):
                flat = T.Flat.of(batch.column("word"))
                once = np.ones(len(flat))
                total += shared.value.recursions(flat, flat.bounds[:-1], flat.bounds[1:], once)[1]
            piece = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(piece), pa.array(total[piece])], names=["piece", "n"])

        rows = words.where("n > 0").select("word").mapInArrow(run, "piece long, n double")
        counts = np.full(len(lattice.pieces), SMOOTH)
        counts[0] += 1
        for r in rows.groupBy("piece").agg(F.sum("n").alias("n")).collect():  # a row for each piece
            counts[r["piece"]] += r["n"]
        lattice = Lattice(lattice.pieces, np.log(counts / counts.sum()))
    return lattice


def scored(docs: DataFrame, lattice: Lattice, train: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """id, n_tokens, n_known, train_tokens, base_score and score of each row.

    ``train`` names a boolean column: whether a row is learned from. Scores are log10 probabilities.
    """
    spark = docs.sparkSession
    words = stage(counted_words(docs, text, train))
    sums = words.agg(
        F.sum("n").alias("n"), *(F.count_if(F.col("n") > k).alias(f"over{k}") for k in range(3))
    ).first()
    ends = docs.where(F.col(train)).count()
    total, kinds = (sums["n"] or 0) + ends, sums["over0"] + (ends > 0)
    once, twice = sums["over0"] - sums["over1"], sums["over1"] - sums["over2"]
    discount = min(0.95, max(0.05, once / (once + 2 * twice))) if once else 0.5
    lattice = trained(words, lattice)
    shared = spark.sparkContext.broadcast(lattice)
    base = float(np.log10(total + SMOOTH * (kinds + 1)))
    ten = float(np.log(10))

    def mixed(n, logs):
        """log10 of a token's probability: its own edge, and the pieces'."""
        if not total:
            return logs / ten
        own = np.log(np.maximum(np.maximum(n - discount, 0) / total, 1e-300))
        return np.logaddexp(own, logs + np.log(discount * kinds / total)) / ten

    def score(batches):
        for batch in T.chunked(batches, "word"):
            flat = T.Flat.of(batch.column("word"))
            logs = shared.value.recursions(flat, flat.bounds[:-1], flat.bounds[1:])
            n = batch.column("n").to_numpy()
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("n"), pa.array(np.log10(n + SMOOTH) - base), pa.array(mixed(n, logs))],
                names=["key", "n", "base", "model"],
            )

    table = stage(words.mapInArrow(score, "key long, n long, base double, model double"))
    # at most 1 / FREQUENT words make up that share of all training tokens
    often = table.where(F.col("n") >= max(1.0, FREQUENT * total)).collect()
    key = np.array([r["key"] for r in often], np.int64).view(np.uint64)
    value = np.array([[r["n"] > 0, r["base"], r["model"]] for r in often], float).reshape(-1, 3)
    frequent = spark.sparkContext.broadcast((key, value))
    kind = docs.schema[id].dataType.simpleString()
    src = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id).alias("id"), F.col(text).alias("text"))

    def meet(batches):
        often, value = frequent.value
        lookup = T.SlotTable(max(12, len(often).bit_length() + 2))
        lookup.add(often)
        for batch in T.chunked(batches, "text"):
            flat = T.Flat.of(batch.column("text"))
            w, n = T.words(flat), len(flat)
            keys = T.slice_hash(flat.sums(lower=True), w.starts, w.ends)
            row = lookup.find(keys)
            hit = row >= 0
            found = [np.bincount(w.doc[hit], value[row[hit], k], n).astype(float) for k in range(3)]
            key, doc = keys[~hit], w.doc[~hit]
            order = np.lexsort((key, doc))
            key, doc = key[order], doc[order]
            new = np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (doc[1:] != doc[:-1]))[: len(key)])
            times, key, doc = np.diff(np.append(new, len(key))), key[new], doc[new]
            tokens = w.per_doc(n) + 1
            at = batch.column("row").to_numpy()
            blank = lambda k, t: pa.nulls(k, t)
            m = len(doc)
            # a row for each text, then one for each rare word of each
            yield pa.RecordBatch.from_arrays(
                [
                    pa.concat_arrays([batch.column("row"), pa.array(at[doc])]),
                    pa.concat_arrays([batch.column("id"), blank(m, batch.column("id").type)]),
                    pa.concat_arrays([blank(n, pa.int64()), pa.array(key.view(np.int64))]),
                    pa.concat_arrays([pa.array(tokens), pa.array(times.astype(np.int64))]),
                    *(pa.concat_arrays([pa.array(f), blank(m, pa.float64())]) for f in found),
                ],
                names=["row", "id", "key", "times", "known", "base", "model"],
            )

    parts = src.mapInArrow(meet, f"row long, id {kind}, key long, times long, known double, base double, model double")
    parts = stage(parts)
    whole = parts.where("key is null").select("row", "id", "times", "known", "base", "model")
    rare = parts.where("key is not null").select("row", "key", "times").join(table, "key")
    rare = rare.groupBy("row").agg(
        F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("known2"),
        F.sum(F.col("times") * F.col("base")).alias("base2"),
        F.sum(F.col("times") * F.col("model")).alias("model2"),
    )
    begins = np.exp(lattice.logs[[p[:1] == b" " for p in lattice.pieces]]).sum()
    end_log = lattice.logs[0] - np.log(np.exp(lattice.logs[0]) + begins)  # no piece goes on after an end
    end_base, end_model = float(np.log10(ends + SMOOTH) - base), float(mixed(ends, end_log))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return whole.join(rare, "row", "left").select(
        F.col("id").alias(id),
        F.col("times").alias("n_tokens"),
        (F.col("known").cast("long") + zero("known2") + (1 if ends else 0)).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + zero("base2") + end_base).alias("base_score"),
        (F.col("model") + zero("model2") + end_model).alias("score"),
    )
