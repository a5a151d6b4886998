"""Language of a text by a bidirectional gated recurrent network over bytes.

The network reads each word with a blank before and after it, forwards and backwards, and labels
every byte; a document's probabilities are the geometric mean over its bytes. As no state passes
from word to word, a word is read once however often a task meets it. Words of more than ``WINDOW``
bytes, as in scripts without blanks, are cut at characters into windows of about that size; a window
is read with ``CONTEXT`` bytes before and after it, whose labels are its neighbours'.

It is trained in numpy by backpropagation through time on a bounded sample: ``SAMPLE`` labelled
texts of each language in the mean, and of each ``WORDS`` words and windows, which are drawn by a hash
from its whole length.

A null text, or one without a letter, is ``und`` with score 0, and so is everything if there are no
labelled rows. Repeated rows are predicted one by one; ties go to the language first in order.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termweave.llm import text as T
from termweave.llm.bpe import LETTER, classes

SAMPLE, WORDS, WINDOW, CONTEXT, HIDDEN, INPUT, STEPS, BATCH = 300, 600, 24, 12, 12, 12, 400, 512
#: The longest window as it is read: its ends and those of its context move by up to 3 bytes each.
WIDE = WINDOW + 2 * CONTEXT + 9
UNKNOWN = "und"


def _sigmoid(x):
    return 0.5 * np.tanh(0.5 * x) + 0.5


class BiGru:
    """Weights, forward pass and gradients; words are rows of bytes, padded by ``size``."""

    def __init__(self, labels: list[str], seed: int = 5):
        r, h, e = np.random.default_rng(seed), HIDDEN, INPUT
        self.labels = labels
        draw = lambda *s: (r.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
        self.w = {"E": r.standard_normal((256, e)).astype(np.float32) * 0.5}
        for d in "fb":
            self.w |= {f"W{d}": draw(e, 3 * h), f"U{d}": draw(h, 3 * h), f"b{d}": np.zeros(3 * h, np.float32)}
        self.w |= {"V": draw(2 * h, len(labels)), "c": np.zeros(len(labels), np.float32)}

    def _run(self, tokens: np.ndarray, mask: np.ndarray, d: str, keep: bool):
        """States after each byte in reading order; mask: 1 where a word has a byte, None: everywhere."""
        w, h = self.w, HIDDEN
        table = w["E"] @ w[f"W{d}"] + w[f"b{d}"]
        n, size = tokens.shape
        state, states, kept = np.zeros((n, h), np.float32), np.zeros((size, n, h), np.float32), []
        for t in range(size) if d == "f" else range(size - 1, -1, -1):
            x, u = table[tokens[:, t]], state @ w[f"U{d}"]
            gates = _sigmoid(x[:, : 2 * h] + u[:, : 2 * h])
            z, r = gates[:, :h], gates[:, h:]
            new = np.tanh(x[:, 2 * h :] + r * u[:, 2 * h :])
            m = 1 if mask is None else mask[:, t : t + 1]
            after = state + m * (1 - z) * (new - state)
            if keep:
                kept.append((t, state, z, r, new, u[:, 2 * h :], m))
            state = states[t] = after
        return states, kept

    def log_probabilities(self, tokens, mask, keep=False):
        """Of each language at each byte: bytes x words x languages."""
        f, b = self._run(tokens, mask, "f", keep), self._run(tokens, mask, "b", keep)
        both = np.concatenate([f[0], b[0]], 2)
        x = both @ self.w["V"] + self.w["c"]
        x -= x.max(2, keepdims=True)
        x -= np.log(np.exp(x).sum(2, keepdims=True))
        return (x, both, f[1], b[1]) if keep else x

    def gradients(self, tokens, mask, target, weight) -> tuple[float, dict[str, np.ndarray]]:
        """Cross entropy over bytes and its gradients, by backpropagation through time."""
        w, h = self.w, HIDDEN
        logp, both, kept_f, kept_b = self.log_probabilities(tokens, mask, True)
        share = (mask * weight[:, None]).T[:, :, None]
        share = share / share.sum()
        hot = np.eye(len(self.labels), dtype=np.float32)[target]
        loss = -float((logp * hot * share).sum())
        dx = ((np.exp(logp) - hot) * share).astype(np.float32)
        g = {k: np.zeros_like(v) for k, v in w.items()}
        g["V"] = np.einsum("tnh,tnl->hl", both, dx)
        g["c"] = dx.sum((0, 1))
        dboth = dx @ w["V"].T
        for d, kept, part in (("f", kept_f, dboth[:, :, :h]), ("b", kept_b, dboth[:, :, h:])):
            dnext = np.zeros((len(tokens), h), np.float32)
            for t, before, z, r, new, un, m in reversed(kept):
                dstate = dnext + part[t]
                dnew = dstate * m * (1 - z) * (1 - new * new)
                dz = -dstate * m * (new - before) * z * (1 - z)
                dr = dnew * un * r * (1 - r)
                dx3 = np.concatenate([dz, dr, dnew], 1)
                du = np.concatenate([dz, dr, dnew * r], 1)
                dnext = dstate * (1 - m * (1 - z)) + du @ w[f"U{d}"].T
                g[f"U{d}"] += before.T @ du
                g[f"W{d}"] += w["E"][tokens[:, t]].T @ dx3
                g[f"b{d}"] += dx3.sum(0)
                np.add.at(g["E"], tokens[:, t], dx3 @ w[f"W{d}"].T)
        return loss, g

    def train(self, tokens, size, target, weight, steps: int = STEPS, seed: int = 9) -> BiGru:
        """Adam over batches of words."""
        r = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.w.items()}
        second = {k: np.zeros_like(v) for k, v in self.w.items()}
        for step in range(1, steps + 1):
            pick = r.integers(0, len(tokens), min(BATCH, len(tokens)))
            longest = int(size[pick].max())
            mask = (np.arange(longest) < size[pick, None]).astype(np.float32)
            _, g = self.gradients(tokens[pick, :longest], mask, target[pick], weight[pick])
            rate = 0.01 * min(1, step / 50) * (1 if step < 0.7 * steps else 0.2)
            for k, v in self.w.items():
                first[k] = 0.9 * first[k] + 0.1 * g[k]
                second[k] = 0.999 * second[k] + 0.001 * g[k] ** 2
                v -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
        return self

    def word_scores(self, tokens, size, start=None, end=None) -> np.ndarray:
        """Sum of log probabilities over the bytes of each word, and how many; from start to end, if given."""
        out = np.zeros((len(tokens), len(self.labels) + 1), np.float32)
        start = np.zeros_like(size) if start is None else start
        end = size if end is None else end
        for n in np.unique(size):
            same = np.flatnonzero(size == n)
            for k in range(0, len(same), 4096):
                pick = same[k : k + 4096]
                logp = self.log_probabilities(tokens[pick, :n], None)
                at = np.arange(n)[:, None]
                outside = (at < start[pick]) | (at >= end[pick])
                if outside.any():
                    logp[outside] = 0
                out[pick, :-1] = logp.sum(0)
                out[pick, -1] = end[pick] - start[pick]
        return out


class Windows:
    """Words, long ones in windows: what is read of the text, and where in that the own bytes are.

    What is read lies between two blanks, which belong to the first and the last window of a word.
    """

    def __init__(self, flat: T.Flat):
        w = T.words(flat)
        count = np.maximum(-(-(w.ends - w.starts) // WINDOW), 1)
        first = np.repeat(np.cumsum(count) - count, count)
        start, end = np.repeat(w.starts, count), np.repeat(w.ends, count)
        at = start + WINDOW * (np.arange(len(first)) - first)
        own, stop = _at_character(flat, at, start), _at_character(flat, np.minimum(at + WINDOW, end), start, end)
        read = _at_character(flat, np.maximum(own - CONTEXT, start), start)
        read_to = _at_character(flat, np.minimum(stop + CONTEXT, end), start, end)
        self.read = T.Spans(read, read_to, np.repeat(w.doc, count))
        self.start = np.where(own == start, 0, own - read + 1)
        self.end = stop - read + 1 + (stop == end)

    def __len__(self) -> int:
        return len(self.read)

    def keys(self, flat: T.Flat) -> np.ndarray:
        """A hash of the bytes read and of which of them are own."""
        keys = T.slice_hash(flat.sums(lower=True), self.read.starts, self.read.ends)
        size = self.read.ends - self.read.starts + 2
        part = (self.start > 0) | (self.end < size)
        return np.where(part, T.mixed(keys + (self.start * 256 + self.end).astype(np.uint64)), keys)


def _at_character(flat: T.Flat, at: np.ndarray, start: np.ndarray, end: np.ndarray | None = None) -> np.ndarray:
    """Positions moved back to where a character begins, not before start; end is a border as it is."""
    out = at.copy()
    if not len(flat.data):
        return out
    last = len(flat.data) - 1
    for _ in range(3):
        inside = (flat.data[np.minimum(out, last)] & 0xC0 == 0x80) & (out > start)
        if end is not None:
            inside &= out < end
        out -= inside
    return out


def padded(flat: T.Flat, starts, ends) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of each window between two blanks, ASCII letters lower-cased, and their number."""
    size = ends - starts
    longest = int(size.max()) if len(starts) else 0
    tokens = np.full((len(starts), longest + 2), 0x20, np.uint8)
    if len(starts):
        inside = np.arange(longest) < size[:, None]
        data = T.LOWER[flat.data[np.minimum(starts[:, None] + np.arange(longest), len(flat.data) - 1)]]
        tokens[:, 1:-1][inside] = data[inside]
    return tokens, size + 2


def has_letter(flat: T.Flat) -> np.ndarray:
    """Whether each text has a letter of any script."""
    ascii_letter = ((flat.data | 32) >= 97) & ((flat.data | 32) <= 122)
    out = flat.count(ascii_letter) > 0
    for d in np.flatnonzero(~out & (flat.count(flat.data >= 0x80) > 0)):
        text = flat.data[flat.bounds[d] : flat.bounds[d + 1]].tobytes().decode()
        out[d] = bool((classes()[np.frombuffer(text.encode("utf-32-le"), np.uint32)] == LETTER).any())
    return out


def drawn(flat: T.Flat) -> T.Spans:
    """WORDS windows of each text, or all, by a hash of the text and of where in it they are."""
    w = Windows(flat).read
    text = T.slice_hash(flat.sums(), flat.bounds[:-1], flat.bounds[1:])
    order = np.lexsort((T.mixed(text[w.doc] + (w.starts - flat.bounds[w.doc]).astype(np.uint64)), w.doc))
    rank = np.arange(len(w)) - w.first(len(flat))[w.doc]  # w is in order of texts, as order is
    taken = np.sort(order[rank < WORDS])
    return T.Spans(w.starts[taken], w.ends[taken], w.doc[taken])


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id") -> BiGru | None:
    """A network trained on SAMPLE rows of each language in the mean, drawn by a hash of the key."""
    rows = labelled.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    counts = {r[0]: r[1] for r in rows.groupBy(lang).count().collect()}
    if not counts:
        return None
    draw = F.pmod(F.xxhash64(F.col(key).cast("string"), F.lit(11)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    share = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(1.0, SAMPLE / n))])
    near = rows.where(draw < F.element_at(share, F.col(lang)))
    near = near.select(F.col(lang).alias("l"), F.col(text).alias("t"))

    def run(batches):
        for batch in T.chunked(batches, "t"):
            flat = T.Flat.of(batch.column("t"))
            w = drawn(flat)
            data = flat.data.tobytes()
            words = [[] for _ in range(len(flat))]
            for d, start, end in zip(w.doc.tolist(), w.starts.tolist(), w.ends.tolist(), strict=True):
                words[d].append(data[start:end])
            yield pa.RecordBatch.from_arrays([batch.column("l"), pa.array(words, pa.list_(pa.binary()))], names=["l", "t"])

    kind = near.schema["l"].dataType.simpleString()
    taken = sorted((r["l"], [bytes(x) for x in r["t"]]) for r in near.mapInArrow(run, f"l {kind}, t array<binary>").collect())
    labels = sorted(counts)
    read = T.Flat.of(pa.array([x for _, t in taken for x in t], pa.binary()))
    if not len(read):
        return None
    tokens, size = padded(read, read.bounds[:-1], read.bounds[1:])
    target = np.repeat([labels.index(k) for k, _ in taken], [len(t) for _, t in taken])
    weight = 1 / np.maximum(np.bincount(target, minlength=len(labels)), 1)[target]
    return BiGru(labels).train(tokens, size, target, (weight / weight.mean()).astype(np.float32))


def predicted(docs: DataFrame, model: BiGru | None, keep: tuple[str, ...], text: str = "text") -> DataFrame:
    """The kept columns, lang_pred and score of each row."""
    src = docs.select(*keep, F.col(text).alias("_text"))
    kinds = "".join(f"`{c}` {src.schema[c].dataType.simpleString()}, " for c in keep)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model, memo = shared.value, T.Memo(20)
        for batch in T.chunked(batches, "_text"):
            flat = T.Flat.of(batch.column("_text"))
            n = len(flat)
            lang, score = np.full(n, UNKNOWN, object), np.zeros(n)
            w = Windows(flat)
            if model is not None and len(w):

                def scores(k, f=flat, w=w):
                    return [model.word_scores(*padded(f, w.read.starts[k], w.read.ends[k]), w.start[k], w.end[k])]

                rows = memo.rows_of(w.keys(flat), scores)
                got = memo.values[0][rows]
                total = np.stack([np.bincount(w.read.doc, got[:, k], n) for k in range(got.shape[1])])
                mean = total[:-1] / np.maximum(total[-1], 1)
                p = np.exp(mean - mean.max(0))
                p /= p.sum(0)
                known = has_letter(flat)
                lang[known] = np.array(model.labels, object)[p.argmax(0)][known]
                score[known] = p.max(0)[known]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.array(lang, pa.string()), pa.array(score)],
                names=[*keep, "lang_pred", "score"],
            )

    return src.mapInArrow(run, f"{kinds}lang_pred string, score double")
