"""Byte-level BPE by prefix dynamic programming.

Each prefix of a piece has one valid last token: a suffix of it that is a token and may follow the
last token of the prefix before. Two tokens may follow each other if byte pair merging of their
joint bytes gives these two again. The last tokens of all prefixes are the whole state: bytes are
appended without looking back, an edit keeps all prefixes before it.

Many distinct pieces advance together in numpy, one byte at a time; long ones go through
``Prefixes`` alone. Null and empty texts have no ids. Texts are split by the pattern of the
vocabulary; ids of a text are those of its pieces in order.
"""

from __future__ import annotations

import base64
import bisect
import functools
import hashlib
import re

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termweave.llm import text as T

#: Pieces with more bytes than this are encoded one by one.
LONG = 48
#: Bytes of new pieces that are encoded at once: the tokens within them take some hundred times that.
AT_ONCE = 1 << 19
_U = np.uint64
SPACE, LETTER, NUMBER, OTHER = range(4)
#: Code points with the property White_Space.
WHITE = [*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F,
         0x205F, 0x3000]


@functools.cache
def classes() -> np.ndarray:
    """SPACE, LETTER, NUMBER or OTHER of each code point.

    Every worker makes it, so the code points aren't objects of their own: those took 100 MB a worker.
    """
    points = np.concatenate([np.arange(0xD800, dtype="<u4"), np.arange(0xE000, 0x110000, dtype="<u4")])
    everything = points.tobytes().decode("utf-32-le")
    out = np.full(0x110000, OTHER, np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+")):
        for m in regex.finditer(pattern, everything):
            out[points[m.start()] : points[m.end() - 1] + 1] = kind
    out[WHITE] = SPACE
    return out


def pieces(flat: T.Flat) -> T.Spans:
    """The matches of the vocabularies' pattern in each text, as byte spans.

    A run of letters, of numbers or of other characters, with the blank before it; ``'s 't 're 've
    'm 'll 'd`` where a match begins with them; white space, whose last character is a match of its
    own, or part of the next, where more text follows.
    """
    if not len(flat.data):
        return T.Spans(*[np.zeros(0, np.int64)] * 3)
    at = np.flatnonzero((flat.data & 0xC0) != 0x80)
    points = np.frombuffer(flat.data.tobytes().decode().encode("utf-32-le"), np.uint32)
    kind, n = classes()[points], len(points)
    fresh = np.zeros(n + 1, bool)  # where texts begin
    fresh[np.searchsorted(at, flat.bounds)] = True
    cut = fresh.copy()
    cut[1:n] |= kind[1:] != kind[:-1]
    begins = np.flatnonzero(cut[:n])
    ends = np.append(begins[1:], n)
    blank = (kind[begins] == SPACE) & ~fresh[ends]
    b, e = begins[blank], ends[blank]
    joins = points[e - 1] == 0x20
    cut[e[joins]] = False
    cut[e[joins | (e - b > 1)] - 1] = True
    # contractions: a quote that a match begins with, letters after it
    q = begins[(ends - begins == 1) & (points[begins] == 0x27) & ~fresh[ends]]
    q = q[cut[q] & (kind[q + 1] == LETTER)]
    one, two = points[q + 1], np.append(points, 0)[q + 2]
    same = ~fresh[q + 2]
    long = same & np.isin(one.astype(np.int64) * 0x110000 + two, [_two(x) for x in ("re", "ve", "ll")])
    short = np.isin(one, [ord(x) for x in "stmd"])
    cut[q[short | long] + 1] = False
    cut[q[short] + 2] = True
    cut[q[long] + 3] = True
    starts = at[np.flatnonzero(cut[:n])]
    doc = np.searchsorted(flat.bounds, starts, "right") - 1
    return T.Spans(starts, np.append(starts[1:], len(flat.data)), doc)


def _two(x: str) -> int:
    return ord(x[0]) * 0x110000 + ord(x[1])


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (x.split() for x in f if x.strip())}


class Bpe:
    """A vocabulary of ranks, with what decides whether two tokens may stand side by side.

    Every worker holds one, so it is a few arrays: dictionaries of the tokens and of the pairs took
    40 MB a worker.
    """

    def __init__(self, ranks: dict[bytes, int], bits: int = 18):
        size = max(ranks.values()) + 1
        self.length = np.zeros(size, np.int64)
        self.length[list(ranks.values())] = [len(t) for t in ranks]
        self.begin = np.cumsum(self.length) - self.length
        self.data = np.frombuffer(b"".join(sorted(ranks, key=ranks.get)), np.uint8)  # the tokens' bytes by rank
        self.left = np.full(size, -1, np.int64)  # the two tokens that a token's last merge joins
        self.right = np.full(size, -1, np.int64)
        self.reached = np.zeros(size, bool)  # merging a token's bytes gives that token
        pairs: dict[tuple[int, int], int] = {}
        for token, rank in ranks.items():
            for k in range(1, len(token)):
                a, b = ranks.get(token[:k]), ranks.get(token[k:])
                if a is not None and b is not None:
                    pairs[a, b] = rank
        for token, rank in ranks.items():
            self._take_apart(ranks, pairs, token, rank)
        joined = sorted((a << 32 | b, rank) for (a, b), rank in pairs.items())
        self.pairs, self.pair_ranks = np.array(joined, np.int64).reshape(-1, 2).T.copy()
        self.longest = max(map(len, ranks))
        self.bits, self.tables = bits, None

    @functools.cached_property
    def bytes_of(self) -> np.ndarray:
        """The bytes of each token, as objects."""
        raw, out = self.data.tobytes(), np.zeros(len(self.length), object)
        for k, (a, n) in enumerate(zip(self.begin.tolist(), self.length.tolist(), strict=True)):
            out[k] = raw[a : a + n] if n else 0
        return out

    @functools.cached_property
    def ranks(self) -> dict[bytes, int]:
        """The rank of each token's bytes; only long pieces ask for it."""
        raw, at = self.data.tobytes(), zip(self.begin.tolist(), self.length.tolist(), strict=True)
        return {raw[a : a + n]: k for k, (a, n) in enumerate(at) if n}

    @functools.cached_property
    def reach(self) -> dict[bytes, int]:
        return {t: r for t, r in self.ranks.items() if self.reached[r]}

    def _take_apart(self, ranks: dict[bytes, int], pairs: dict[tuple[int, int], int], token: bytes, rank: int) -> None:
        parts = [ranks[token[k : k + 1]] for k in range(len(token))]
        last = (-1, -1)
        while len(parts) > 1:
            best, at = min((pairs.get(p, 1 << 40), k) for k, p in enumerate(zip(parts, parts[1:], strict=False)))
            if best == 1 << 40:
                return
            last = (parts[at], parts[at + 1])
            parts[at : at + 2] = [best]
        self.left[rank], self.right[rank] = last
        self.reached[rank] = parts[0] == rank

    def may_follow(self, a: int, b: int) -> bool:
        """Whether merging the bytes of a and b gives a and b.

        Merges are undone from the last. A token across the border would have won against the merge
        undone last if its rank is lower, or equal and that merge lies to its right.
        """
        limit, pairs = 1 << 40, self.pairs.data
        while True:
            at = bisect.bisect_left(pairs, a << 32 | b)
            if at < len(pairs) and pairs[at] == a << 32 | b and self.pair_ranks[at] < limit:
                return False
            split_a, split_b = self.right[a] >= 0, self.left[b] >= 0
            if split_a and (a > b or not split_b):
                limit, a = a, int(self.right[a])
            elif split_b:
                limit, b = b + 1, int(self.left[b])
            else:
                return True

    # -- many at once ---------------------------------------------------------------------------

    def _prepare(self) -> None:
        """Hash tables of tokens and pairs; made in the task, not sent."""
        token = np.flatnonzero(self.reached)
        begin, size = self.begin[token], self.length[token]
        keys, heads, ids = np.zeros(len(token), np.uint64), [], []
        for n in range(int(size.max(initial=0))):
            live = np.flatnonzero(size > n)
            keys[live] = _longer(keys[live], self.data[begin[live] + n])
            live = live[np.argsort(size[live] > n + 1, kind="stable")]  # whole tokens first
            head, first = np.unique(keys[live], return_index=True)
            whole = live[first]
            heads.append(head)
            ids.append(np.where(size[whole] == n + 1, token[whole], -1).astype(np.int32))
        self.heads, self.head_ids = T.SlotTable(19), np.concatenate(ids)
        self.heads.add(T.mixed(np.concatenate(heads)))
        self.pair_table = T.SlotTable(20)
        self.pair_table.add(_pair_key(self.pairs >> 32, self.pairs & 0xFFFFFFFF))
        self.fits = T.Memo(18)
        self.tables = True
        self.fresh()
        del token, begin, size, keys, heads, ids
        T.release()

    def fresh(self) -> None:
        self.memo, self.pool, self.used = T.Memo(self.bits), np.zeros(1 << 20, np.int32), 0

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in _LOCAL} | {"tables": None}

    def close(self) -> None:
        """Drops the tables: a worker would keep them, with the broadcast, for all tasks to come."""
        for name in _LOCAL:
            self.__dict__.pop(name, None)
        self.tables = None
        T.release()

    def _follow(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """``may_follow`` of arrays."""
        out = np.ones(len(a), bool)
        limit = np.full(len(a), 1 << 40)
        left = np.arange(len(a))
        while len(left):
            row = self.pair_table.find(_pair_key(a, b))
            rank = np.where(row >= 0, self.pair_ranks[row], 1 << 40)
            lost = rank < limit
            out[left[lost]] = False
            ra, lb = self.right[a], self.left[b]
            cut_a = (ra >= 0) & ((a > b) | (lb < 0))
            cut_b = ~cut_a & (lb >= 0)
            limit = np.where(cut_a, a, b + 1)
            a, b = np.where(cut_a, ra, a), np.where(cut_b, lb, b)
            go = ~lost & (cut_a | cut_b)
            left, a, b, limit = left[go], a[go], b[go], limit[go]
        return out

    def _suffixes(self, data, begin, size) -> tuple[np.ndarray, ...]:
        """All tokens within pieces: where they start and end, and which; by end, the longest first.

        begin: where the piece of each byte starts; size: how long it is. Each place is followed as
        long as some token begins with its bytes.
        """
        at, keys = np.arange(len(data), dtype=np.int32), np.zeros(len(data), np.uint64)
        begin, size = begin.astype(np.int32), size.astype(np.int32)
        found = []
        n = 0
        while len(at):
            keys = _longer(keys, data[at + n])
            n += 1
            row = self.heads.find(T.mixed(keys))
            head = row >= 0
            at, keys = at[head], keys[head]
            token = self.head_ids[row[head]]
            hit = token >= 0
            found.append((at[hit], np.full(int(hit.sum()), n, np.int16), token[hit]))
            room = begin[at] + size[at] - at > n
            at, keys = at[room], keys[room]
        start, length, token = (np.concatenate(x) for x in zip(*found, strict=True))
        del found, at, keys
        rank = ((start + length - begin[start]) * 256 + 255 - length).astype(np.int16)
        order = np.argsort(rank, kind="stable")
        return start[order], length[order], token[order], rank[order]

    def _encode_short(self, flat: T.Flat, starts, ends) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces of up to LONG bytes, flat, and how many each has."""
        size = ends - starts
        if not len(size):
            return np.zeros(0, np.int32), size
        base = np.cumsum(size) - size
        data = flat.data[np.arange(int(size.sum())) + np.repeat(starts - base, size)]
        begin = np.repeat(base, size)
        start, length, token, rank = self._suffixes(data, begin, np.repeat(size, size))
        last = np.full(len(data), -1, np.int64)  # of the prefix that ends with each byte
        groups = np.flatnonzero(np.append(True, rank[1:] != rank[:-1]))
        for a, b in zip(groups.tolist(), [*groups[1:].tolist(), len(rank)], strict=True):
            end = start[a:b] + length[a] - 1
            open_ = last[end] < 0
            who, end, new = start[a:b][open_], end[open_], token[a:b][open_]
            if len(who) and rank[a] >> 8 != length[a]:
                before = last[who - 1]
                rows = self.fits.rows_of(
                    _pair_key(before, new), lambda k, x=before, y=new: [self._follow(x[k], y[k])]
                )
                fits = self.fits.values[0][rows]
                end, new = end[fits], new[fits]
            last[end] = new
        cols, counts, at = [], np.zeros(len(size), np.int64), size.copy()
        who = np.arange(len(size))
        while len(who):
            chosen = last[base[who] + at[who] - 1]
            cols.append((who, chosen))
            counts[who] += 1
            at[who] -= self.length[chosen]
            who = who[at[who] > 0]
        out, after = np.zeros(int(counts.sum()), np.int32), np.cumsum(counts)
        for k, (who, chosen) in enumerate(cols):
            out[after[who] - 1 - k] = chosen
        return out, counts

    def _encode_new(self, flat: T.Flat, starts, ends) -> list[np.ndarray]:
        size = ends - starts
        short = size <= LONG
        counts, offset = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
        some = np.flatnonzero(short)
        group = np.cumsum(size[some]) // AT_ONCE
        for part in np.split(some, np.flatnonzero(np.diff(group)) + 1):
            ids, counts[part] = self._encode_short(flat, starts[part], ends[part])
            offset[part] = self.used + np.cumsum(counts[part]) - counts[part]
            self._put(ids)
        for k in np.flatnonzero(~short):
            piece = flat.data[starts[k] : ends[k]].tobytes()
            own = [self.ranks[piece]] if piece in self.ranks else Prefixes(self, piece).ids()
            offset[k], counts[k] = self.used, len(own)
            self._put(np.array(own, np.int32))
        return [offset, counts]

    def _put(self, ids: np.ndarray) -> None:
        while self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        self.pool[self.used : self.used + len(ids)] = ids
        self.used += len(ids)

    def encode(self, flat: T.Flat) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after another, and where each text's ids begin."""
        if self.tables is None:
            self._prepare()
        if self.memo.table.size > 0.8 * self.memo.table.most or self.used > 1 << 20:
            self.fresh()
        p, sums = pieces(flat), flat.sums()
        keys = T.slice_hash(sums, p.starts, p.ends)
        del sums
        rows = self.memo.rows_of(
            keys, lambda k: self._encode_new(flat, p.starts[k], p.ends[k])
        )
        if not len(rows):
            return np.zeros(0, np.int32), np.zeros(len(flat) + 1, np.int64)
        offset, count = (v[rows] for v in self.memo.values)
        upto = np.concatenate([[0], np.cumsum(count)])
        ids = self.pool[np.arange(upto[-1]) + np.repeat(offset - upto[:-1], count)]
        return ids, upto[p.first(len(flat))]

    def encode_added(self, flat: T.Flat, added: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
        """``encode``, where added tokens that occur in a text have the ids given; the rest is encoded by itself."""
        raw = flat.data.tobytes() if added else b""
        found = re.compile(b"|".join(map(re.escape, sorted(added, key=len, reverse=True)))) if added else None
        if not found or not found.search(raw):
            return self.encode(flat)
        spans = [
            (a + m.start(), a + m.end())
            for a, b in zip(flat.bounds[:-1].tolist(), flat.bounds[1:].tolist(), strict=True)
            for m in found.finditer(raw[a:b])
        ]
        begin, end = np.array(spans, np.int64).reshape(-1, 2).T
        bounds = np.unique(np.concatenate([flat.bounds, begin, end]))
        ids, first = self.encode(T.Flat(flat.data, bounds))
        # the parts that are added tokens have one id each in place of their own
        part = np.searchsorted(bounds, begin)
        size = np.diff(first)
        size[part] = 1
        upto = np.concatenate([[0], np.cumsum(size)])
        out = np.zeros(upto[-1], ids.dtype)
        own = np.ones(len(size), bool)
        own[part] = False
        keep = np.repeat(own, np.diff(first))
        out[np.repeat(own, size)] = ids[keep]
        out[upto[part]] = [added[raw[a:b]] for a, b in spans]
        return out, upto[np.searchsorted(bounds, flat.bounds)]

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(self.bytes_of[ids].tolist())


_LOCAL = ("heads", "head_ids", "pair_table", "fits", "memo", "pool", "used", "bytes_of", "ranks", "reach")


def _longer(keys: np.ndarray, byte: np.ndarray) -> np.ndarray:
    """Keys of strings with one more byte."""
    return keys * _U(0x9E3779B97F4A7C15) + byte + _U(1)


def _pair_key(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return T.mixed((a.astype(np.uint64) << _U(32)) + b.astype(np.uint64) + _U(1))


class Prefixes:
    """One piece whose bytes can grow and change; ``ids`` are right after each step."""

    def __init__(self, bpe: Bpe, data: bytes = b""):
        self.bpe, self.data, self.last = bpe, bytearray(), []
        self.append(data)

    def append(self, more: bytes) -> Prefixes:
        bpe, data, last = self.bpe, self.data, self.last
        for byte in more:
            data.append(byte)
            end = len(data)
            for n in range(min(end, bpe.longest), 0, -1):
                token = bpe.reach.get(bytes(data[end - n : end]))
                if token is not None and (n == end or bpe.may_follow(last[end - n - 1], token)):
                    last.append(token)
                    break
        return self

    def replace(self, start: int, end: int, new: bytes) -> Prefixes:
        """Puts new bytes in place of a slice; prefixes before it stay as they are.

        Behind the slice, once every prefix within a token's reach ends in the token that it had,
        the rest has too.
        """
        rest, old = bytes(self.data[end:]), self.last[end:]
        self.data, self.last = self.data[:start], self.last[:start]
        self.append(new)
        agreed = 0
        for k, byte in enumerate(rest):
            self.append(bytes([byte]))
            agreed = agreed + 1 if self.last[-1] == old[k] else 0
            # a token of the rest then begins behind bytes whose tokens agree
            if agreed > self.bpe.longest and k >= self.bpe.longest:
                self.data += rest[k + 1 :]
                self.last += old[k + 1 :]
                break
        return self

    def ids(self) -> list[int]:
        out, at = [], len(self.data)
        while at:
            out.append(self.last[at - 1])
            at -= int(self.bpe.length[out[-1]])
        return out[::-1]


def encoded(docs: DataFrame, bpe: Bpe, id: str = "doc_id", text: str = "text") -> DataFrame:
    """id and ids (array<int>) of each row's text."""
    src = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(bpe)

    def run(batches):
        bpe = shared.value
        for batch in T.chunked(batches, "text"):
            ids, first = bpe.encode(T.Flat.of(batch.column("text")))
            lists = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(ids))
            yield pa.RecordBatch.from_arrays([batch.column("id"), lists], names=["id", "ids"])
        bpe.close()

    kind = src.schema["id"].dataType.simpleString()
    return src.mapInArrow(run, f"id {kind}, ids array<int>").withColumnRenamed("id", id)


def digests(docs: DataFrame, bpe: Bpe, id: str = "doc_id", text: str = "text") -> DataFrame:
    """id, n_tokens, and the SHA-256 of the decimal ids and of the bytes that they decode to."""
    src = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(bpe)

    def run(batches):
        bpe = shared.value
        decimal = np.array([f"{k}," for k in range(len(bpe.bytes_of))], object)
        for batch in T.chunked(batches, "text"):
            ids, first = bpe.encode(T.Flat.of(batch.column("text")))
            names, raw = decimal[ids].tolist(), bpe.bytes_of[ids].tolist()
            cuts = list(zip(first[:-1].tolist(), first[1:].tolist(), strict=True))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array(np.diff(first)),
                    pa.array([hashlib.sha256("".join(names[a:b])[:-1].encode()).hexdigest() for a, b in cuts]),
                    pa.array([hashlib.sha256(b"".join(raw[a:b])).hexdigest() for a, b in cuts]),
                ],
                names=["id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )
        bpe.close()

    kind = src.schema["id"].dataType.simpleString()
    schema = f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return src.mapInArrow(run, schema).withColumnRenamed("id", id)
