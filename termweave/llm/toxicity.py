"""Severity of toxicity by cumulative-link ordinal regression on sparse text features.

Grades run from 0 (not toxic) to ``GRADES``. One weight for each feature is shared by all grades;
ordered thresholds turn the weighted sum into P(grade >= k), and their sum is the expected severity.
A text is toxic if P(grade >= 1) is ``LEAST`` or more.

Labels say whether a text is toxic, not how much. Toxic training texts are graded by how many
marked words they have (words that the labels show to be frequent in toxic texts and rare in
others), in shares as equal as ties allow.

Features are hashed words (runs of letters) and beginnings of words, counted; only those that tell toxic from other
training texts by ``SUPPORT`` and ``ODDS`` are used, ``FEATURES`` at most. Training takes ``SAMPLE``
toxic and as many other labelled rows in the mean, drawn by a hash of the id; each weighs as many
labelled rows as it stands for. Whole texts are read then and in prediction.

Null and empty texts have no features and get the severity of a text without any. Of several labels
for an id the largest counts; null labels don't. Without toxic and other labels, all is grade 0.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termweave.llm import text as T

GRADES, SAMPLE, FEATURES, ODDS, LEAST = 3, 10_000, 4096, 3.0, 0.5
#: Toxic training texts that a feature must occur in; with fewer than ``FEW`` toxic ones one of these
#: numbers, by the errors on halves of the texts that are held out in turn.
SUPPORT, FEW = (2, 3, 4), 300
#: Bytes of the beginnings of words that are features beside whole words.
HEADS = (4, 5, 6)
_U = np.uint64


_LETTER = np.isin(np.arange(256), [*range(65, 91), *range(97, 123), *range(128, 256)])


def words(flat: T.Flat) -> T.Spans:
    """Runs of ASCII letters and of other scripts' characters."""
    return T.runs(flat, _LETTER)


def features(flat: T.Flat) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and text of each feature, and the word that it belongs to; ASCII letters lower-cased."""
    w, sums = words(flat), flat.sums(lower=True)
    keys, doc, word = [T.slice_hash(sums, w.starts, w.ends)], [w.doc], [np.arange(len(w))]
    for n in HEADS:
        long = np.flatnonzero(w.ends - w.starts > n)
        keys.append(T.mixed(T.slice_hash(sums, w.starts[long], w.starts[long] + n) + _U(n)))
        doc.append(w.doc[long])
        word.append(long)
    return np.concatenate(keys), np.concatenate(doc), np.concatenate(word)


class Ordinal:
    """Feature weights and ordered thresholds; P(grade >= k) = logistic(score - threshold k)."""

    def __init__(self, keys: np.ndarray, weights: np.ndarray, thresholds: np.ndarray):
        self.keys, self.weights, self.thresholds = keys, weights, thresholds

    @staticmethod
    def empty() -> Ordinal:
        return Ordinal(np.zeros(0, np.uint64), np.zeros(0), np.arange(1, GRADES + 1) * 30.0)

    def at_least(self, score: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k from 1, texts x grades."""
        return 1 / (1 + np.exp(-np.clip(score[:, None] - self.thresholds, -500, 500)))

    @staticmethod
    def train(keys, doc, column, value, grade, weigh=None, rounds: int = 400, ridge: float = 3e-5) -> Ordinal:
        """Maximum likelihood by Adam; (doc, column, value) are the features of each text, ``weigh`` what it counts."""
        n, k = len(grade), GRADES
        weigh = np.full(n, 1 / n) if weigh is None else weigh / weigh.sum()
        weight = np.zeros(len(keys))
        raw = np.array([1.0, *np.zeros(k - 1)])  # first threshold, logs of the steps to the next
        state = [np.zeros(len(weight) + k), np.zeros(len(weight) + k)]
        for step in range(1, rounds + 1):
            model = Ordinal(keys, weight, np.cumsum([raw[0], *np.exp(raw[1:])]))
            score = np.bincount(doc, weight[column] * value, n)
            up = np.concatenate([np.ones((n, 1)), model.at_least(score), np.zeros((n, 1))], 1)
            at = np.arange(n)
            a, b = up[at, grade], up[at, grade + 1]
            p = np.maximum(a - b, 1e-12)
            da, db = a * (1 - a) / p * weigh, b * (1 - b) / p * weigh  # by the two thresholds of a grade
            dscore = db - da
            grad = np.bincount(column, dscore[doc] * value, len(weight)) + ridge * weight
            bound = np.zeros(k + 2)
            np.add.at(bound, grade, da)
            np.add.at(bound, grade + 1, -db)
            later = np.cumsum(bound[1 : k + 1][::-1])[::-1]  # a step moves all thresholds after it
            g = np.concatenate([grad, [later[0]], later[1:] * np.exp(raw[1:])])
            state = [0.9 * state[0] + 0.1 * g, 0.999 * state[1] + 0.001 * g * g]
            move = 0.1 * (state[0] / (1 - 0.9**step)) / (np.sqrt(state[1] / (1 - 0.999**step)) + 1e-9)
            weight, raw = weight - move[: len(weight)], raw - move[len(weight) :]
        return Ordinal(keys, weight, np.cumsum([raw[0], *np.exp(raw[1:])]))


def _table(keys: np.ndarray) -> T.SlotTable:
    table = T.SlotTable(max(16, len(keys).bit_length() + 2))
    table.add(keys)
    return table


def sample(labels: DataFrame, id: str = "doc_id", label: str = "toxic") -> DataFrame:
    """id, _toxic and _weigh of SAMPLE toxic and SAMPLE other labelled ids in the mean."""
    known = labels.select(F.col(id), F.col(label).alias("_toxic")).dropna().groupBy(id).agg(F.max("_toxic").alias("_toxic"))
    sizes = {r[0]: r[1] for r in known.groupBy((F.col("_toxic") > 0).alias("t")).count().collect()}
    draw = F.pmod(F.xxhash64(F.col(id).cast("string"), F.lit(23)), F.lit(1 << 30))
    share = [min(1.0, SAMPLE / max(sizes.get(t, 0), 1)) for t in (True, False)]
    least = F.when(F.col("_toxic") > 0, int(share[0] * (1 << 30))).otherwise(int(share[1] * (1 << 30)))
    weigh = F.when(F.col("_toxic") > 0, 1 / share[0]).otherwise(1 / share[1])
    return known.where(draw < least).withColumn("_weigh", weigh)


def telling(texts: DataFrame) -> tuple[np.ndarray, int]:
    """Features of text, _toxic rows that tell toxic ones, the strongest first, and how many are words."""

    def run(batches):
        for batch in T.chunked(batches, "text"):
            keys, doc, word = features(T.Flat.of(batch.column("text")))
            toxic = batch.column("_toxic").to_numpy(zero_copy_only=False) > 0
            pair = np.unique(np.stack([keys, doc.astype(np.uint64)], 1), axis=0) if len(keys) else np.zeros((0, 2), np.uint64)
            key, back = np.unique(pair[:, 0], return_inverse=True)
            hit = toxic[pair[:, 1].astype(np.int64)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(key.view(np.int64)),
                    pa.array(np.bincount(back, hit, len(key)).astype(np.int64)),
                    pa.array(np.bincount(back, ~hit, len(key)).astype(np.int64)),
                ],
                names=["key", "pos", "neg"],
            )

    sizes = {r[0]: r[1] for r in texts.groupBy((F.col("_toxic") > 0).alias("t")).count().collect()}
    pos, neg = sizes.get(True, 0), sizes.get(False, 0)
    if not pos or not neg:
        return np.zeros(0, np.uint64)
    counts = texts.mapInArrow(run, "key long, pos long, neg long").groupBy("key").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    odds = F.log((F.col("pos") + 0.5) / (pos + 1.0)) - F.log((F.col("neg") + 0.5) / (neg + 1.0))
    best = counts.where(F.col("pos") >= (min(SUPPORT) if pos < FEW else max(SUPPORT))).withColumn("odds", odds).where(F.col("odds") >= ODDS)
    rows = best.orderBy(F.desc("odds"), "key").limit(FEATURES).select("key").collect()
    return np.array([r[0] for r in rows], np.int64).view(np.uint64)


def fit(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "toxic") -> Ordinal:
    known = sample(labels, id, label).withColumnRenamed(id, "_id")
    # the sample's size is bounded by SAMPLE, whatever the number of labels
    texts = docs.select(F.col(id).alias("_id"), F.col(text).alias("text")).join(F.broadcast(known), "_id").select("text", "_toxic", "_weigh")
    keys = telling(texts)
    if not len(keys):
        return Ordinal.empty()

    def run(batches):
        table = _table(keys)
        for batch in T.chunked(batches, "text"):
            flat = T.Flat.of(batch.column("text"))
            found, doc, word = features(flat)
            column = table.find(found)
            hit = column >= 0
            marked = np.unique(word[hit])
            amount = np.bincount(words(flat).doc[marked], minlength=len(flat))
            cell, n = np.unique(doc[hit] * len(keys) + column[hit], return_counts=True)
            ends = np.cumsum([0, *np.bincount(cell // len(keys), minlength=len(flat))]).astype(np.int32)
            hits, times = (pa.ListArray.from_arrays(pa.array(ends), pa.array(x.astype(np.int32))) for x in (cell % len(keys), n))
            yield pa.RecordBatch.from_arrays(
                [batch.column("_toxic").cast(pa.int32()), batch.column("_weigh"), pa.array(amount), hits, times],
                names=["toxic", "weigh", "amount", "hits", "times"],
            )

    # FEATURES columns and counts of a sampled text at most
    rows = texts.mapInArrow(run, "toxic int, weigh double, amount long, hits array<int>, times array<int>").collect()
    rows.sort(key=lambda r: (r["toxic"], r["amount"], r["hits"], r["times"]))
    toxic, weigh, amount = (np.array([r[c] for r in rows]) for c in ("toxic", "weigh", "amount"))
    doc = np.repeat(np.arange(len(rows)), [len(r["hits"]) for r in rows])
    column, n = (np.array([h for r in rows for h in r[c]], np.int64) for c in ("hits", "times"))
    data = _Training(toxic > 0, weigh, amount, doc, column, np.log1p(n))
    use = np.ones(len(keys), bool)
    if data.toxic.sum() < FEW:
        errors = [(data.errors(len(keys), least), least) for least in sorted(SUPPORT, reverse=True)]
        least = min(errors, key=lambda x: x[0])[1]
        use = data.tells(np.ones(len(rows), bool), len(keys), least)
    return data.model(keys, use, np.ones(len(rows), bool))


@dataclass
class _Training:
    """Sampled texts, and the features that each has."""

    toxic: np.ndarray
    weigh: np.ndarray
    amount: np.ndarray
    doc: np.ndarray
    column: np.ndarray
    value: np.ndarray

    def tells(self, texts: np.ndarray, columns: int, least: int) -> np.ndarray:
        """Features that at least so many toxic ones of the texts have, and others rarely."""
        on = texts[self.doc]
        pos, neg = (np.bincount(self.column[on & (self.toxic[self.doc] == t)], minlength=columns) for t in (True, False))
        n_pos, n_neg = (self.toxic & texts).sum(), (~self.toxic & texts).sum()
        odds = np.log((pos + 0.5) / (n_pos + 1)) - np.log((neg + 0.5) / (n_neg + 1))
        return (pos >= least) & (odds >= ODDS)

    def model(self, keys: np.ndarray, use: np.ndarray, texts: np.ndarray) -> Ordinal:
        """Trained on some texts with some features."""
        toxic, amount = self.toxic[texts], self.amount[texts]
        if not use.any() or not toxic.any():
            return Ordinal.empty()
        cuts = np.quantile(amount[toxic], np.arange(1, GRADES) / GRADES)
        grade = np.where(toxic, 1 + np.searchsorted(cuts, amount), 0)
        on = texts[self.doc] & use[self.column]
        doc, column = (np.cumsum(x) - 1 for x in (texts, use))
        return Ordinal.train(keys[use], doc[self.doc[on]], column[self.column[on]], self.value[on], grade, self.weigh[texts])

    def errors(self, columns: int, least: int) -> int:
        """Texts judged wrong by models that were trained on the other half."""
        wrong, half = 0, np.arange(len(self.toxic)) % 2 == 0
        for texts in (half, ~half):
            use = self.tells(texts, columns, least)
            model = self.model(np.arange(columns, dtype=np.uint64), use, texts)
            on = use[self.column]
            weight = np.zeros(columns)
            weight[use] = model.weights if len(model.weights) else 0
            score = np.bincount(self.doc[on], weight[self.column[on]] * self.value[on], len(self.toxic))
            found = model.at_least(score)[:, 0] >= LEAST
            wrong += int((found != self.toxic)[~texts].sum())
        return wrong


def scored(docs: DataFrame, model: Ordinal, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """The kept columns, severity (0 to GRADES), p_toxic, grade (the likeliest) and toxic of each row."""
    src = docs.select(*keep, F.col(text).alias("_text"))
    kinds = "".join(f"`{c}` {src.schema[c].dataType.simpleString()}, " for c in keep)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = shared.value
        table, size = _table(model.keys), max(1, len(model.keys))
        for batch in T.chunked(batches, "_text"):
            found, doc, _ = features(T.Flat.of(batch.column("_text")))
            column = table.find(found)
            hit = column >= 0
            cell, n = np.unique(doc[hit] * size + column[hit], return_counts=True)
            weight = model.weights[cell % size] * np.log1p(n) if len(cell) else np.zeros(0)
            up = model.at_least(np.bincount(cell // size, weight, batch.num_rows))
            each = -np.diff(np.concatenate([np.ones((len(up), 1)), up, np.zeros((len(up), 1))], 1), axis=1)
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in keep),
                    pa.array(up.sum(1)),
                    pa.array(up[:, 0]),
                    pa.array(each.argmax(1).astype(np.int32)),
                    pa.array(up[:, 0] >= LEAST),
                ],
                names=[*keep, "severity", "p_toxic", "grade", "toxic"],
            )

    return src.mapInArrow(run, f"{kinds}severity double, p_toxic double, grade int, toxic boolean")
