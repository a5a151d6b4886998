"""Token counts by a byte-level BPE vocabulary that is compiled into deterministic transducers.

Two transducers in a row read a text.

* ``SPLIT`` reads characters by class and marks where the vocabulary's pattern begins a new match. It
  has a dozen states. A text is cut into chunks; each gives a map from every state that it may begin
  in to the one that it ends in. Maps are composed by a parallel prefix scan, which gives every chunk
  the state that it does begin in; then all chunks mark their characters at once.
* ``Tokens`` reads the bytes of a match. A transition carries the number of tokens that its byte adds
  to the encoding of what was read so far, which may be negative; their sum is the match's count. A
  state is what the subset construction gives: every token that may be under way, the token before
  it, and how many tokens fewer had been counted there. Of tokens that end with a byte, one alone is
  valid: two tokens may stand side by side if merging their joint bytes gives these two again.
  States and transitions are made when they are first met, many at once, and kept for later batches.
  A match longer than ``SPAN`` bytes is cut into chunks; their maps are partial, from the state that
  the chunk before suggests, and from others where the composition meets them.

Added tokens of the vocabulary that occur in a text are found first, as one token each; what lies
between is read alone. Null and empty texts have no tokens. Rows are read one by one, whole, so
repeated rows give repeated counts. Matches are known by 64-bit hashes, see ``text``.
"""

from __future__ import annotations

import functools
import json
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termweave.llm import text as T
from termweave.llm.bpe import LETTER, NUMBER, OTHER, SPACE, classes

#: Characters of a chunk that is split; bytes of a chunk of a long match; transitions that a task keeps.
CHARS, SPAN, KEPT = 64, 128, 1 << 19
_U = np.uint64


# -- where matches begin ------------------------------------------------------------------------

# Classes of characters: letters that may follow a quote stand alone.
PLAIN, STMD, E, R, V, L, DIGIT, SIGN, QUOTE, BLANK, WHITE = range(11)
CLASSES = 11
# States: within a run of letters, of digits, of signs; behind a quote that begins a match, and that
# quote and r, v or l; behind a contraction; in white space, one character of it or several, whose
# last one is a blank or not.
IN_LETTERS, IN_DIGITS, IN_SIGNS, AT_QUOTE, AT_R, AT_V, AT_L, DONE, ONE_BLANK, BLANKS, ONE_WHITE, WHITES = range(12)
STATES = 12
_ENDS = {AT_R: E, AT_V: E, AT_L: L}


def _begin(kind: int) -> int:
    """The state behind the first character of a match."""
    if kind <= L:
        return IN_LETTERS
    return {DIGIT: IN_DIGITS, SIGN: IN_SIGNS, QUOTE: AT_QUOTE, BLANK: ONE_BLANK, WHITE: ONE_WHITE}[kind]


def _group(kind: int) -> int:
    return IN_LETTERS if kind <= L else IN_DIGITS if kind == DIGIT else IN_SIGNS if kind <= QUOTE else ONE_BLANK


def _step(state: int, kind: int) -> tuple[int, bool, bool]:
    """The next state, and whether a match begins at the character, and at the one before it."""
    same = _group(kind)
    if state in (IN_LETTERS, IN_DIGITS, IN_SIGNS):
        return (state, False, False) if same == state else (_begin(kind), True, False)
    if state == AT_QUOTE:
        if kind == STMD:
            return DONE, False, False
        if kind in (R, V, L):
            return {R: AT_R, V: AT_V, L: AT_L}[kind], False, False
        return (IN_SIGNS, False, False) if same == IN_SIGNS else (_begin(kind), True, False)
    if state in _ENDS:  # no contraction: the quote stands alone, its letter begins a match
        if kind == _ENDS[state]:
            return DONE, False, False
        return (IN_LETTERS, False, True) if same == IN_LETTERS else (_begin(kind), True, True)
    if state == DONE:
        return _begin(kind), True, False
    several = state in (BLANKS, WHITES)
    if same == ONE_BLANK:
        return (BLANKS if kind == BLANK else WHITES), False, False
    if state in (ONE_BLANK, BLANKS):  # the last blank goes with what follows
        return same, False, several
    return _begin(kind), True, several


@functools.cache
def split_table() -> tuple[np.ndarray, np.ndarray]:
    """Next state, and marks (1: here, 2: one before), by class and state; classes from CLASSES on
    are those of a text's first character."""
    to = np.zeros((2 * CLASSES, STATES), np.uint8)
    mark = np.zeros((2 * CLASSES, STATES), np.uint8)
    for kind in range(CLASSES):
        for state in range(STATES):
            to[kind, state], here, before = _step(state, kind)
            mark[kind, state] = here + 2 * before
            to[CLASSES + kind, state] = _begin(kind)
            mark[CLASSES + kind, state] = 1 + 2 * (state in _ENDS)
    return to.ravel(), mark.ravel()


@functools.cache
def library_classes() -> np.ndarray:
    """``bpe.classes`` as the tokenizers library has them: its Unicode is older, and newer letters are no letters to it."""
    from tokenizers import Regex, pre_tokenizers

    out = np.full(0x110000, OTHER, np.uint8)
    points = np.concatenate([np.arange(0xD800, dtype="<u4"), np.arange(0xE000, 0x110000, dtype="<u4")])
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
        split = pre_tokenizers.Split(Regex(pattern), "removed")
        for some in np.split(points, range(1 << 14, len(points), 1 << 14)):
            found = np.ones(len(some), bool)
            for _, (a, b) in split.pre_tokenize_str(some.tobytes().decode("utf-32-le")):
                found[a:b] = False
            out[some[found]] = kind
    return out


@functools.cache
def _class_of(library: bool = False) -> np.ndarray:
    """The class of each code point, by the pattern or as the library has it."""
    kind = library_classes() if library else classes()
    out = np.full(len(kind), SIGN, np.uint8)
    for given, own in ((LETTER, PLAIN), (NUMBER, DIGIT), (SPACE, WHITE)):
        out[kind == given] = own
    for own, letters in ((STMD, "stmd"), (E, "e"), (R, "r"), (V, "v"), (L, "l"), (QUOTE, "'"), (BLANK, " ")):
        out[[ord(c) for c in letters]] = own
    return out


def composed(maps: np.ndarray) -> np.ndarray:
    """Of maps (chunks x states) those of all chunks up to each, by a prefix scan of log2(chunks) steps."""
    width = 1
    while width < len(maps):
        later = np.take_along_axis(maps[width:], maps[:-width], 1)
        maps = np.concatenate([maps[:width], later])
        width *= 2
    return maps


def matches(flat: T.Flat, class_of: np.ndarray | None = None) -> T.Spans:
    """The matches of the pattern in each text, as byte spans; class_of: classes of the code points, if others."""
    if not len(flat.data):
        return T.Spans(*[np.zeros(0, np.int64)] * 3)
    at = np.flatnonzero((flat.data & 0xC0) != 0x80)
    points = np.frombuffer(flat.data.tobytes().decode().encode("utf-32-le"), np.uint32)
    n = len(points)
    # behind the last text, as if another one began
    kind = np.full(-(-(n + 1) // CHARS) * CHARS, PLAIN, np.int64)
    kind[:n] = (_class_of() if class_of is None else class_of)[points]
    first = np.searchsorted(at, np.unique(flat.bounds[:-1][np.diff(flat.bounds) > 0]))
    kind[np.append(first, n)] += CLASSES
    to, mark = split_table()
    row = kind.reshape(-1, CHARS) * STATES
    maps = np.tile(np.arange(STATES, dtype=np.uint8), (len(row), 1))
    for k in range(CHARS):
        maps = to[row[:, k, None] + maps]
    # all begins with the first character of a text, where any state will do
    state = np.concatenate([np.zeros(1, np.uint8), composed(maps)[:-1, 0]])
    marks = np.empty(row.shape, np.uint8)
    for k in range(CHARS):
        cell = row[:, k] + state
        marks[:, k], state = mark[cell], to[cell]
    marks = marks.ravel()
    starts = at[np.flatnonzero((marks[:n] & 1) | (marks[1 : n + 1] & 2))]
    doc = np.searchsorted(flat.bounds, starts, "right") - 1
    return T.Spans(starts, np.append(starts[1:], len(flat.data)), doc)


# -- tokens of a match --------------------------------------------------------------------------


@functools.cache
def _byte_names() -> dict[str, int]:
    """The character that stands for each byte: printable ones for themselves, others from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


@dataclass
class Vocabulary:
    """Tokens by id as bytes, merges as (left, right, joined) ids by rank, and added tokens."""

    tokens: dict[int, bytes]
    merges: list[tuple[int, int, int]]
    added: list[bytes]

    @staticmethod
    def read(path: str) -> Vocabulary:
        """From a tokenizer file of byte-level BPE that splits by its usual pattern."""
        with open(path, encoding="utf-8") as f:
            given = json.load(f)
        model, split = given["model"], given["pre_tokenizer"]
        if split["type"] != "ByteLevel" or split["add_prefix_space"] or given["normalizer"] or model["ignore_merges"]:
            raise ValueError(f"{path} isn't a plain byte-level vocabulary")
        if any(x["lstrip"] or x["rstrip"] or x["single_word"] for x in given["added_tokens"]):
            raise ValueError("added tokens that strip what is beside them aren't supported")
        byte = _byte_names()
        added = [x["content"] for x in given["added_tokens"]]
        ids = {t: k for t, k in model["vocab"].items() if t not in added}
        pairs = [tuple(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
        return Vocabulary(
            {k: bytes(byte[c] for c in t) for t, k in ids.items()},
            [(ids[a], ids[b], ids[a + b]) for a, b in pairs],
            [x.encode() for x in sorted(added, key=len, reverse=True)],
        )


class _Map:
    """Rows of 64-bit keys, growing; -1 where there is none."""

    def __init__(self, keys: np.ndarray = (), bits: int = 12):
        self.table, self.keys = T.SlotTable(bits), np.zeros(0, np.uint64)
        self.add(np.asarray(keys, np.uint64))

    def find(self, keys: np.ndarray) -> np.ndarray:
        return self.table.find(T.mixed(keys))

    def add(self, keys: np.ndarray) -> np.ndarray:
        """Rows of distinct new keys."""
        self.keys = np.concatenate([self.keys, keys])
        if len(self.keys) > self.table.most:
            self.table = T.SlotTable(len(self.keys).bit_length() + 2)
            return self.table.add(T.mixed(self.keys))[len(self.keys) - len(keys) :]
        return self.table.add(T.mixed(keys))


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a.astype(np.uint64) << _U(32)) + b.astype(np.uint64) + _U(1)


class Tokens:
    """The transducer of a vocabulary's tokens; state 0 is where a match begins."""

    def __init__(self, vocabulary: Vocabulary):
        size = max(vocabulary.tokens) + 1
        # the merge that makes a token; single bytes come from none
        self.rank, self.left, self.right = (np.full(size, -1, np.int64) for _ in range(3))
        for rank, (a, b, c) in enumerate(vocabulary.merges):
            if self.rank[c] >= 0:
                raise ValueError("a token comes from two merges")
            self.rank[c], self.left[c], self.right[c] = rank, a, b
        child: dict[int, int] = {}  # of node and byte; node 0 is the root
        token = [-1]
        for id, name in vocabulary.tokens.items():
            node = 0
            for byte in name:
                node = child.setdefault(node * 256 + byte, len(token))
                if node == len(token):
                    token.append(-1)
            token[node] = id
        self.edges = np.fromiter(child, np.uint64, len(child))
        self.token_at = np.array(token)
        self.inner = np.zeros(len(token), bool)
        self.inner[(self.edges >> _U(8)).astype(np.int64)] = True
        self.child = None

    def __getstate__(self):
        return {k: self.__dict__[k] for k in ("rank", "left", "right", "edges", "token_at", "inner")} | {"child": None}

    def _prepare(self) -> None:
        """Tables of edges and merges; made in the task, not sent."""
        self.child = _Map(self.edges + _U(1))
        made = np.flatnonzero(self.rank >= 0)
        self.merged = _Map(_pair(self.left[made], self.right[made]))
        self.merged_rank = self.rank[made]
        self.clear()

    def clear(self) -> None:
        """No transitions, and the first state alone: nothing read, no token before it."""
        self.steps, self.to, self.adds = _Map(), np.zeros(0, np.int32), np.zeros(0, np.int32)
        self.states, self.first = _Map(), np.zeros(2, np.int64)
        self.last, self.node, self.fewer = (np.zeros(0, np.int32) for _ in range(3))
        self._intern(np.zeros(1, np.int64), np.array([-1]), np.zeros(1, np.int64), np.zeros(1, np.int64), 1)

    def beside(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether tokens a and b stay two when their joint bytes are merged.

        Their merges are undone from the last. A token across the border would come before the merge
        that is undone if its rank is lower, or if it's equal and that merge lies to its right.
        """
        out, limit = np.ones(len(a), bool), np.full(len(a), 1 << 40)
        left = np.arange(len(a))
        while len(left):
            row = self.merged.find(_pair(a, b))
            across = np.where(row >= 0, self.merged_rank[row], 1 << 40) < limit
            out[left[across]] = False
            ra, rb = self.rank[a], self.rank[b]
            from_a = ra > rb  # of two equal tokens the right one was made last
            from_b = ~from_a & (rb >= 0)
            limit = np.where(from_a, ra, rb + 1)
            a, b = np.where(from_a, self.right[a], a), np.where(from_b, self.left[b], b)
            go = ~across & (from_a | from_b)
            left, a, b, limit = left[go], a[go], b[go], limit[go]
        return out

    def _intern(self, owner, last, node, fewer, n: int) -> np.ndarray:
        """The states with these items, in the order of their owners, 0 to n - 1."""
        size = np.bincount(owner, minlength=n)
        begin = np.cumsum(size) - size
        item = T.mixed(_pair(last + 1, node) ^ T.mixed((fewer + (1 << 20)).astype(np.uint64)))
        place = (np.arange(len(owner)) - begin[owner]).astype(np.uint64)
        total = np.zeros(n, np.uint64)
        np.add.at(total, owner, T.mixed(item + place * _U(0x9E3779B97F4A7C15)))
        state = self.states.find(total)
        miss = np.flatnonzero(state < 0)
        if len(miss):
            new, at, back = np.unique(total[miss], return_index=True, return_inverse=True)
            state[miss] = self.states.add(new)[back.reshape(-1)]
            chosen = miss[at]
            items = np.arange(int(size[chosen].sum())) + np.repeat(begin[chosen] - (np.cumsum(size[chosen]) - size[chosen]), size[chosen])
            self.first = np.concatenate([self.first[: len(self.states.keys) - len(new) + 1], self.first[len(self.states.keys) - len(new)] + np.cumsum(size[chosen])])
            self.last, self.node, self.fewer = (
                np.concatenate([old, x[items].astype(np.int32)]) for old, x in ((self.last, last), (self.node, node), (self.fewer, fewer))
            )
        return state

    def _make(self, state: np.ndarray, byte: np.ndarray) -> None:
        """Transitions of distinct pairs of a state and a byte."""
        n, size = len(state), self.first[state + 1] - self.first[state]
        owner = np.repeat(np.arange(n), size)
        item = np.arange(len(owner)) + np.repeat(self.first[state] - (np.cumsum(size) - size), size)
        last, fewer = self.last[item].astype(np.int64), self.fewer[item].astype(np.int64)
        node = self.child.find(self.node[item].astype(np.uint64) * _U(256) + byte[owner] + _U(1)).astype(np.int64) + 1
        on = node > 0
        owner, last, fewer, node = owner[on], last[on], fewer[on], node[on]
        token = self.token_at[node]
        ends = np.flatnonzero(token >= 0)
        inside = ends[last[ends] >= 0]
        valid = np.ones(len(token), bool)
        valid[inside] = self.beside(last[inside], token[inside])
        ends = ends[valid[ends]]
        who, at = np.unique(owner[ends], return_index=True)
        if len(who) < n:
            raise ValueError("a byte is no token of this vocabulary")
        ends = ends[at]
        adds = fewer[ends] + 1
        more = self.inner[node]
        owner = np.concatenate([owner[more], np.arange(n)])
        last = np.concatenate([last[more], token[ends]])
        node = np.concatenate([node[more], np.zeros(n, np.int64)])
        fewer = np.concatenate([fewer[more], adds]) - adds[owner]
        order = np.argsort(owner, kind="stable")
        to = self._intern(owner[order], last[order], node[order], fewer[order], n)
        self.steps.add(state.astype(np.uint64) * _U(256) + byte + _U(1))
        self.to, self.adds = np.concatenate([self.to, to.astype(np.int32)]), np.concatenate([self.adds, adds.astype(np.int32)])

    def read(self, state: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The states behind slices that are read from the given ones, and the tokens added; all at once, byte by byte."""
        size = ends - starts
        order = np.argsort(-size, kind="stable")
        state, at = state[order].astype(np.int64), starts[order]
        total = np.zeros(len(state), np.int64)
        upto = np.searchsorted(-size[order], -np.arange(int(size.max()) if len(size) else 0), "left")
        for k, n in enumerate(upto.tolist()):
            byte = data[at[:n] + k]
            key = state[:n].astype(np.uint64) * _U(256) + byte + _U(1)
            row = self.steps.find(key)
            if (row < 0).any():
                _, new = np.unique(key[row < 0], return_index=True)
                new = np.flatnonzero(row < 0)[new]
                self._make(state[new], byte[new])
                row = self.steps.find(key)
            state[:n] = self.to[row]
            total[:n] += self.adds[row]
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        return state[back], total[back]

    def count(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Tokens of each match."""
        if self.child is None:
            self._prepare()
        elif len(self.to) > KEPT:
            self.clear()
        out = np.zeros(len(starts), np.int64)
        long = ends - starts > SPAN
        short = np.flatnonzero(~long)
        out[short] = self.read(np.zeros(len(short), np.int64), data, starts[short], ends[short])[1]
        if long.any():
            out[long] = self._count_long(data, starts[long], ends[long])
        return out

    def _count_long(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        many = -(-(ends - starts) // SPAN)
        first = np.cumsum(many) - many
        match = np.repeat(np.arange(len(starts)), many)
        begin = starts[match] + SPAN * (np.arange(len(match)) - first[match])
        end = np.minimum(begin + SPAN, ends[match])
        # equal chunks have one map
        base = int(starts.min())
        sums = T.prefix_hash(data[base : int(ends.max())].astype(np.uint64) + _U(1))
        chunk = np.unique(T.slice_hash(sums, begin - base, end - base), return_inverse=True)[1]
        maps: dict[tuple[int, int], tuple[int, int]] = {}

        def fill(at: np.ndarray, state: np.ndarray) -> None:
            reached, added = self.read(state, data, begin[at], end[at])
            maps.update(zip(zip(chunk[at].tolist(), state.tolist(), strict=True), zip(reached.tolist(), added.tolist(), strict=True), strict=True))

        head = begin == starts[match]
        guess = np.zeros(len(match), np.int64)
        before = np.flatnonzero(~head) - 1
        guess[before + 1] = self.read(np.zeros(len(before), np.int64), data, begin[before], end[before])[0]
        _, once = np.unique(np.stack([chunk, guess]), axis=1, return_index=True)
        fill(once, guess[once])
        out, state, at = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64), first.copy()
        name, stop, open_ = chunk.tolist(), first + many, np.arange(len(starts))
        while len(open_):
            for m in open_.tolist():
                s, k, n = int(state[m]), int(at[m]), 0
                while k < stop[m] and (hit := maps.get((name[k], s))):
                    s, n, k = hit[0], n + hit[1], k + 1
                state[m], at[m], out[m] = s, k, out[m] + n
            open_ = open_[at[open_] < stop[open_]]
            fill(at[open_], state[open_])
        return out


# -- texts --------------------------------------------------------------------------------------


class Counter:
    """Tokens of texts by a vocabulary."""

    def __init__(self, vocabulary: Vocabulary):
        self.tokens, self.added = Tokens(vocabulary), vocabulary.added
        self.class_of = _class_of(library=True)
        self.known: T.Memo | None = None

    def __getstate__(self):
        return self.__dict__ | {"known": None}

    def _parts(self, flat: T.Flat) -> tuple[T.Flat, np.ndarray, np.ndarray]:
        """The texts cut before and behind added tokens; the text of each part, and whether it is such a token."""
        raw, cuts, whole = flat.data.tobytes(), [], []
        found = re.compile(b"|".join(map(re.escape, self.added))) if self.added else None
        if found and found.search(raw):
            for a, b in zip(flat.bounds[:-1].tolist(), flat.bounds[1:].tolist(), strict=True):
                spans = [m.span() for m in found.finditer(raw[a:b])]
                cuts += [a + x for s in spans for x in s]
                whole += [a + s[0] for s in spans]
        bounds = np.unique(np.concatenate([flat.bounds, np.array(cuts, np.int64)]))
        doc = np.searchsorted(flat.bounds, bounds[:-1], "right") - 1
        return T.Flat(flat.data, bounds), doc, np.isin(bounds[:-1], np.array(whole, np.int64))

    def count(self, flat: T.Flat) -> np.ndarray:
        """Tokens of each text."""
        self.known = self.known or T.Memo(18)
        parts, doc, added = self._parts(flat)
        p, sums = matches(parts, self.class_of), flat.sums()
        rows = self.known.rows_of(
            T.slice_hash(sums, p.starts, p.ends), lambda k: [self.tokens.count(flat.data, p.starts[k], p.ends[k])]
        )
        each = self.known.values[0][rows] if len(rows) else np.zeros(0, np.int64)
        each = np.where(added[p.doc], 0, each)
        return (np.bincount(doc[p.doc], each, len(flat)) + np.bincount(doc[added], minlength=len(flat))).astype(np.int64)


def counted(docs: DataFrame, vocabulary: Vocabulary, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """The kept columns, n_bytes and n_tokens of each row's text."""
    src = docs.select(*keep, F.col(text).alias("_text"))
    kinds = "".join(f"`{c}` {src.schema[c].dataType.simpleString()}, " for c in keep)
    shared = docs.sparkSession.sparkContext.broadcast(Counter(vocabulary))

    def run(batches):
        counter = shared.value
        for batch in T.chunked(batches, "_text"):
            flat = T.Flat.of(batch.column("_text"))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.array(np.diff(flat.bounds)), pa.array(counter.count(flat))],
                names=[*keep, "n_bytes", "n_tokens"],
            )

    return src.mapInArrow(run, f"{kinds}n_bytes long, n_tokens long")
