"""Secret scans: fixed rules, and Markov models of random strings and of ordinary identifiers.

Rule spans (kinds ``assign``, ``access``, ``hex``) are kept as they are. In runs of identifier
characters outside them, the stretch is added (kind ``random``) that a character model of random
strings explains better than one of ordinary identifiers, by the largest log-likelihood ratio. It
goes from separator to separator (``/`` and ``=``), so that a key is found at the end of a path.

Both models are trained on samples that the rules label, over all texts: matched values, and other
identifiers. Those are learned twice: first from plain ones, in which digits stand apart from letters
and small letters aren't followed by capitals, then also from others that the first model doesn't
find random. What isn't plain counts once, so a key that is repeated often is no evidence for itself.

Null and empty texts have no spans. Rows are scanned one by one, so repeated rows give repeated
results. Without texts, or without a labelled sample of one kind, no random string is reported.
Offsets count code points, ends are exclusive.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termweave.llm import text as T
from termweave.llm.shared import drop, stage

KINDS = ("assign", "access", "hex", "random")
#: Fixed patterns; letters of the names in either case.
ASSIGN = re.compile(
    rb"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I
)
VALUE, ACCESS, HEX = 8, 16, 32
#: An added string has at least so many characters, and this log-likelihood ratio in all and a character.
LEAST, RATIO, RATIO_EACH = 16, 12.0, 0.5

_HEX = np.isin(np.arange(256), np.frombuffer(b"0123456789abcdef", np.uint8))
_UPPER = np.isin(np.arange(256), [*range(48, 58), *range(65, 91)])
_NAME = np.isin(np.arange(256), [*range(48, 58), *range(65, 91), *range(97, 123), *b"+/_=-"])
#: Small letters, capitals and digits.
_KIND = np.select([np.isin(np.arange(256), x) for x in (range(97, 123), range(65, 91), range(48, 58))], [1, 2, 3])
#: Separators: what follows is a string of its own to the models, a random stretch ends at them.
_BREAK = np.isin(np.arange(256), [*b"/="])
_INNER = _NAME & ~_BREAK
#: State of each byte; 0 stands for what lies before a string, and for separators.
STATES = int(_INNER.sum()) + 1
_STATE = np.where(_INNER, np.cumsum(_INNER), 0)


def runs(flat: T.Flat, member: np.ndarray, least: int) -> T.Spans:
    """Maximal runs of member bytes within a text, of ``least`` bytes at least."""
    found = T.runs(flat, member)
    long = found.ends - found.starts >= least
    return T.Spans(found.starts[long], found.ends[long], found.doc[long])


def rule_spans(flat: T.Flat) -> list[tuple[int, int, int, int, int, int]]:
    """(text, start, kind, end, value's start, value's end) in bytes, in order."""
    out = []
    doc_of = lambda at: int(np.searchsorted(flat.bounds, at, "right")) - 1
    sign = (flat.data == 0x3A) | (flat.data == 0x3D)
    for d in np.flatnonzero(flat.count(sign)):
        a, b = int(flat.bounds[d]), int(flat.bounds[d + 1])
        for m in ASSIGN.finditer(flat.data[a:b].tobytes()):
            if m.end(2) - m.start(2) >= VALUE:
                out.append((int(d), a + m.start(), 0, a + m.end(), a + m.start(2), a + m.end(2)))
    upper = runs(flat, _UPPER, ACCESS)
    for a, b, d in zip(upper.starts.tolist(), upper.ends.tolist(), upper.doc.tolist(), strict=True):
        at = flat.data[a:b].tobytes().find(b"AKIA")
        if at >= 0 and b - a - at >= ACCESS:
            out.append((d, a + at, 1, b, a + at, b))
    low = runs(flat, _HEX, HEX)
    out += [(doc_of(a), a, 2, b, a, b) for a, b in zip(low.starts.tolist(), low.ends.tolist(), strict=True)]
    return sorted(out)


def _transitions(flat: T.Flat, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pair of states at each byte of the slices, and the slice that it belongs to."""
    size = ends - starts
    who = np.repeat(np.arange(len(starts)), size)
    at = np.arange(int(size.sum())) + np.repeat(starts - (np.cumsum(size) - size), size)
    to = _STATE[flat.data[at]]
    before = _STATE[flat.data[np.maximum(at - 1, 0)]]
    before[np.cumsum(size) - size] = 0
    return before * STATES + to, who


def _beside(flat: T.Flat, rules: list[tuple], least: int) -> T.Spans:
    """Runs of identifier characters of ``least`` bytes at least, without what lies in rule spans."""
    free = _NAME[flat.data]
    for r in rules:
        free[r[1] : r[3]] = False
    found = T.flagged_runs(flat, free) if len(flat.data) else T.Spans(*[np.zeros(0, np.int64)] * 3)
    long = found.ends - found.starts >= least
    return T.Spans(found.starts[long], found.ends[long], found.doc[long])


def strings(docs: DataFrame, text: str = "text") -> DataFrame:
    """kind (0: matched by a rule, 1: not), value and n (how often) of each distinct string that the models learn from."""

    def run(batches):
        for batch in T.chunked(batches, "text"):
            flat = T.Flat.of(batch.column("text"))
            rules = rule_spans(flat)
            plain = _beside(flat, rules, VALUE)
            starts = np.concatenate([np.array([r[4] for r in rules], np.int64), plain.starts])
            ends = np.concatenate([np.array([r[5] for r in rules], np.int64), plain.ends])
            kind = np.repeat([0, 1], [len(rules), len(plain)]).astype(np.int32)
            name = T.mixed(T.slice_hash(flat.sums(), starts, ends) + kind.astype(np.uint64))
            _, once, n = np.unique(name, return_index=True, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(kind[once]), pa.array(name[once].view(np.int64)), T.cut_strings(flat, starts[once], ends[once]), pa.array(n)],
                names=["kind", "name", "value", "n"],
            )

    found = docs.select(F.col(text).alias("text")).mapInArrow(run, "kind int, name long, value string, n long")
    return found.groupBy("kind", "name").agg(F.any_value("value").alias("value"), F.sum("n").alias("n")).drop("name")


def _plain(flat: T.Flat) -> np.ndarray:
    """Whether in each text digits stand apart from letters and no small letter is followed by a capital."""
    kind = _KIND[flat.data]
    mixed = (kind[1:] != kind[:-1]) & (kind[1:] > 0) & (kind[:-1] > 0) & ~((kind[:-1] == 2) & (kind[1:] == 1))
    inner = flat.bounds[1:-1]
    mixed[inner[(inner > 0) & (inner < len(kind))] - 1] = False
    return flat.count(np.append(mixed, False)[: len(kind)]) == 0


def _counts(samples: DataFrame, ratio: np.ndarray | None) -> np.ndarray:
    """Transitions of the strings of each kind; of others plain ones, and with a ratio those that it doesn't find random."""

    def run(batches):
        counts = np.zeros((2, STATES * STATES), np.int64)
        for batch in T.chunked(batches, "value"):
            flat, kind, n = T.Flat.of(batch.column("value")), batch.column("kind").to_numpy(), batch.column("n").to_numpy()
            starts, ends, plain = flat.bounds[:-1], flat.bounds[1:], _plain(flat)
            weigh = np.where(kind == 0, 1, np.where(plain, n, 0))
            if ratio is not None:
                ordinary = np.ones(len(flat), bool)
                ordinary[[x[0] for x in _stretches(flat, T.Spans(starts, ends, np.arange(len(flat))), ratio)]] = False
                weigh[(kind == 1) & ~plain & ordinary] = 1
            pair, who = _transitions(flat, starts, ends)
            np.add.at(counts, (kind[who], pair), weigh[who])
        kind, pair = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(kind.astype(np.int32)), pa.array(pair.astype(np.int32)), pa.array(counts[kind, pair])], names=["kind", "pair", "n"]
        )

    # as many rows as pairs of characters at most
    out = np.zeros((2, STATES, STATES))
    for r in samples.mapInArrow(run, "kind int, pair int, n long").groupBy("kind", "pair").agg(F.sum("n").alias("n")).collect():
        out[r["kind"], r["pair"] // STATES, r["pair"] % STATES] = r["n"]
    return out


def log_ratio(counts: np.ndarray) -> np.ndarray:
    """Log-likelihood ratio of each transition; transitions are smoothed towards the characters of each kind.

    Separators tell nothing.
    """
    counts = counts.copy()
    counts[:, :, 0] = 0
    letters = counts.sum(1, keepdims=True) + 1
    chance = counts + 20 * letters / letters.sum(2, keepdims=True)
    log = np.log(chance / chance.sum(2, keepdims=True))
    ratio = log[0] - log[1]
    ratio[:, 0] = 0
    return ratio.ravel()


def learn(docs: DataFrame, text: str = "text") -> np.ndarray | None:
    """Log-likelihood ratio of each transition; the counts cover all texts, their number is fixed."""
    samples = stage(strings(docs, text))
    ratio = None
    for _ in range(2):
        counts = _counts(samples, ratio)
        if not counts.sum((1, 2)).all():
            break
        ratio = log_ratio(counts)
    drop(samples)
    return ratio


def best_stretch(gain: np.ndarray) -> tuple[int, int]:
    """The slice with the largest sum; of equal ones the first."""
    upto = np.concatenate([[0.0], np.cumsum(gain)])
    lowest = np.minimum.accumulate(upto[:-1])
    end = int(np.argmax(upto[1:] - lowest)) + 1
    return int(np.argmin(upto[:end])), end


def _stretches(flat: T.Flat, s: T.Spans, ratio: np.ndarray) -> list[tuple[int, int, int]]:
    """(span, start, end) of the random stretch of each span that has one: of its parts between
    separators, neighbours with the largest sum."""
    pair, _ = _transitions(flat, s.starts, s.ends)
    gain = ratio[pair]
    first = np.cumsum(s.ends - s.starts) - (s.ends - s.starts)
    # a stretch can't gain more than all gains of its span
    hope = np.add.reduceat(np.maximum(gain, 0), first) if len(s) else np.zeros(0)
    out = []
    for k in np.flatnonzero(hope >= RATIO).tolist():
        a, n = int(s.starts[k]), int(s.ends[k] - s.starts[k])
        own = gain[first[k] : first[k] + n]
        inner = np.flatnonzero(~_BREAK[flat.data[a : a + n]])
        part = np.append(0, np.cumsum(np.diff(inner) > 1))
        i, j = best_stretch(np.bincount(part, own[inner]))
        chosen = inner[(part >= i) & (part < j)]
        i, j = int(chosen[0]), int(chosen[-1]) + 1
        total = float(own[i:j].sum())
        if j - i >= LEAST and total >= RATIO and total >= RATIO_EACH * (j - i):
            out.append((k, a + i, a + j))
    return out


def random_spans(flat: T.Flat, rules: list[tuple], ratio: np.ndarray | None) -> list[tuple[int, int, int, int]]:
    """(text, start, kind, end) of identifiers that the model of random strings explains better."""
    if ratio is None:
        return []
    s = _beside(flat, rules, LEAST)
    return [(int(s.doc[k]), a, 3, b) for k, a, b in _stretches(flat, s, ratio)]


def found_in(flat: T.Flat, ratio: np.ndarray | None) -> list[list[tuple[int, int, int]]]:
    """(start, kind, end) of each text's spans in code points, in order."""
    rules = rule_spans(flat)
    out: list[list[tuple[int, int, int]]] = [[] for _ in range(len(flat))]
    points = np.append(0, np.cumsum((flat.data & 0xC0) != 0x80, dtype=np.int64))
    for d, a, kind, b in sorted([r[:4] for r in rules] + random_spans(flat, rules, ratio)):
        zero = points[flat.bounds[d]]
        out[d].append((int(points[a] - zero), kind, int(points[b] - zero)))
    return out


def scanned(
    docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), text: str = "text", mask: str | None = None
) -> DataFrame:
    """The kept columns and ``spans`` (start, end, kind) of each row; with ``mask`` also ``masked``,
    the text with that in place of every span, overlapping ones as one."""
    ratio = learn(docs, text)
    src = docs.select(*keep, F.col(text).alias("_text"))
    extra = ", masked string" if mask is not None else ""
    kind_of = {c: src.schema[c].dataType.simpleString() for c in keep}
    schema = "".join(f"`{c}` {k}, " for c, k in kind_of.items())
    schema += "spans array<struct<start:long,end:long,kind:string>>" + extra
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))

    def masked(text: str, spans) -> str:
        parts, upto = [], 0
        for a, _, b in spans:
            if b > upto:
                parts += [text[upto:a], mask] if a >= upto else []
                upto = b
        return "".join([*parts, text[upto:]])

    def run(batches):
        for batch in T.chunked(batches, "_text"):
            column = batch.column("_text")
            found = found_in(T.Flat.of(column), ratio)
            out = [{"start": a, "end": b, "kind": KINDS[k]} for s in found for a, k, b in s]
            ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(out, span.value_type))
            columns = [*(batch.column(c) for c in keep), lists]
            if mask is not None:
                texts = column.to_pylist()
                for k, s in enumerate(found):
                    if s:
                        texts[k] = masked(texts[k], s)
                columns.append(pa.array(texts, pa.string()))
            names = [*keep, "spans", *(["masked"] if mask is not None else [])]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return src.mapInArrow(run, schema)


def digests(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts of rule spans, their SHA-256, and all spans as text."""
    found = scanned(docs, (id,), text)
    joined = lambda x: F.array_join(
        F.transform(x, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )
    of = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    rules = F.filter("spans", lambda s: s["kind"] != "random")
    return found.select(
        id,
        *(of(k).alias(f"n_{k}") for k in KINDS[:3]),
        F.sha2(joined(rules), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


def spans_digest(spans: list[tuple[int, int, str]]) -> str:
    """The digest of (start, end, kind) spans, as ``digests`` writes it."""
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, b, k in spans).encode()).hexdigest()
