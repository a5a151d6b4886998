"""Documents whose sets of word n-grams have a Jaccard similarity of ``LINK`` or more, all of them.

1. Equal sets are one set from the start (``sid``, a hash of the whole set).
2. Stars: sets that share one of the smallest of their hashes, and a band of sizes, are held against
   one of them, another one in each round. This costs as much as there are sets, and joins most of
   what is similar.
3. Tiles: a set's shingles are ordered, those that at most ``HOT`` texts have first, the others by
   how many have them. Two similar sets share a shingle among the first fifth of either, and the
   smaller among its first ninth. Tiles of such a shingle whose sets are in one component by then are
   done. In the others each set is held against a few others of its tiles, new ones in each round; in
   what is open then, every pair of sets from two components is held against each other, within the
   band of sizes that can be similar. No pair within a component is made.
4. Of each pair, the numbers of bits by which their hashed bitmaps differ bound the overlap from
   above; only pairs that pass have their sorted arrays intersected.

The result is exact for every pair of different sets. Null and empty texts, and texts without words,
have empty sets, linked with nothing. Rows with a null id get a size, but no component. Repeated rows
are copies of each other.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termweave.llm import text as T
from termweave.llm.components import components
from termweave.llm.shared import drop, stage, tidy
from termweave.llm.sieve import Sieve

SIZE, LINK = 5, (80, 100)
#: Texts that may have a shingle before it is put last; how many such shingles are told apart.
HOT, HOT_MOST = 4, 1 << 20
#: Shingles that a task counts at once, and that a range of the counts has in the mean.
COUNTED, RANGE = 1 << 21, 1 << 21
#: Longs of a bitmap: the power of two that gives a set two bits for each shingle, within these bounds.
LONGS = (8, 128)
#: Rounds of stars on smallest hashes and in tiles; the smallest hashes that a round takes, and the
#: centres that a set is held against in one.
STARS, TILE_STARS, SMALLEST, CENTRES = 1, 1, 8, 8
_U = np.uint64


def sets(flat: T.Flat, size: int = SIZE) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text of each distinct shingle, by text and hash."""
    w = T.words(flat)
    h = T.slice_hash(flat.sums(lower=True), w.starts, w.ends)
    at = np.flatnonzero(w.doc[size - 1 :] == w.doc[: max(0, len(w) - size + 1)])
    keys, doc = [T.shingles(h, size)[at]], [w.doc[at]]
    count = w.per_doc(len(flat))
    first = w.first(len(flat))
    for k in range(1, size):  # texts with fewer words: the whole sequence
        few = np.flatnonzero(count == k)
        if len(few):
            keys.append(T.mixed(T.shingles(h, k)[first[few]] + _U(k)))
            doc.append(few)
    key, who = np.concatenate(keys), np.concatenate(doc)
    order = np.lexsort((key, who))
    key, who = key[order], who[order]
    new = np.append(True, (key[1:] != key[:-1]) | (who[1:] != who[:-1]))[: len(key)]
    return key[new], who[new]


def _need(n):
    """Overlap of a set of n with any similar one at least: ceil(n * LINK)."""
    return -(-n * LINK[0] // LINK[1])


def _first(who: np.ndarray, texts: int) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(np.bincount(who, minlength=texts))])


def _sids(key, who, n) -> np.ndarray:
    total = np.zeros(len(n), np.uint64)
    np.add.at(total, who, T.mixed(key + _U(0x9E3779B9)))
    return T.mixed(total + n.astype(np.uint64) * _U(0x2545F4914F6CDD1D)).view(np.int64)


def _prefixes(key, who, n, rank) -> tuple[np.ndarray, np.ndarray]:
    """The first fifth of each set in the order of (rank, hash), and the text of each."""
    order = np.lexsort((key, rank, who)) if rank is not None else np.arange(len(key))
    place = np.arange(len(key)) - np.repeat(np.cumsum(n) - n, n)
    take = place <= np.repeat(n - _need(n), n)
    return key[order][take], who[take]


def pack(values: np.ndarray) -> bytes:
    """Numbers in groups of seven bits, the lowest first; a byte's eighth bit says that more follow."""
    size = 1 + sum((values >= _U(1) << _U(7 * k)).astype(np.int64) for k in range(1, 9))
    begin = np.cumsum(size) - size
    out = np.zeros(int(size.sum()), np.uint8)
    for k in range(int(size.max()) if len(size) else 0):
        live = size > k
        out[begin[live] + k] = ((values[live] >> _U(7 * k)) & _U(127)).astype(np.uint8) | ((size[live] > k + 1) << 7).astype(np.uint8)
    return out.tobytes()


def unpack(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8)
    begin = np.flatnonzero(np.append(True, raw[:-1] < 128)) if len(raw) else np.zeros(0, np.int64)
    place = np.arange(len(raw)) - np.repeat(begin, np.diff(np.append(begin, len(raw))))
    return np.add.reduceat((raw & 127).astype(np.uint64) << (7 * place).astype(np.uint64), begin) if len(raw) else np.zeros(0, np.uint64)


def hot_shingles(docs: DataFrame, text: str) -> tuple[np.ndarray, np.ndarray, int]:
    """Beginnings of shingles' hashes that more than HOT texts have, how many have them, and by how
    many bits hashes are cut to their beginnings.

    The result orders shingles and nothing else: any order gives the same links. So beginnings will
    do that are five bits longer than it takes to number the shingles, of which there is less than
    one for each two bytes; tasks send them sorted, as differences, about two bytes for each.
    """
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    cut = 64 - min(64, max(24, (size // 2).bit_length() + 5))
    ranges = max(16, size // 8 // RANGE)

    def packed(found: list[np.ndarray]) -> pa.RecordBatch:
        key, n = np.unique(np.concatenate(found), return_counts=True)
        part = (key.astype(np.float64) * (ranges / 2.0 ** (64 - cut))).astype(np.int64)
        ends = np.append(np.flatnonzero(part[1:] != part[:-1]) + 1, len(part))
        begin = np.append(0, ends[:-1])
        steps = [pack(np.diff(key[a:b], prepend=_U(0))) for a, b in zip(begin, ends, strict=True)]
        times = [pack(n[a:b].astype(np.uint64)) for a, b in zip(begin, ends, strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(part[begin]), pa.array(steps), pa.array(times)], names=["part", "steps", "times"])

    def count(batches):
        found, n = [], 0
        for batch in T.chunked(batches, "text"):
            key, _ = sets(T.Flat.of(batch.column("text")))
            found.append(key >> _U(cut))
            n += len(key)
            if n > COUNTED:
                yield packed(found)
                found, n = [], 0
        if n:
            yield packed(found)

    def hot(table):
        keys = [np.cumsum(unpack(x.as_py())) for x in table.column("steps")]
        times = [unpack(x.as_py()) for x in table.column("times")]
        key, back = np.unique(np.concatenate(keys), return_inverse=True)
        n = np.bincount(back, np.concatenate(times)).astype(np.int64)
        often = n > HOT
        return pa.table({"key": pa.array(key[often].view(np.int64)), "n": pa.array(n[often])})

    counts = docs.select(F.col(text).alias("text")).mapInArrow(count, "part long, steps binary, times binary")
    rows = counts.groupBy("part").applyInArrow(hot, "key long, n long").orderBy(F.desc("n"), "key").limit(HOT_MOST).toArrow()
    return rows.column("key").to_numpy().view(np.uint64), rows.column("n").to_numpy(), cut


def summaries(docs: DataFrame, hot, id: str, text: str) -> DataFrame:
    """id, n, sid, bitmap, prefix, smallest hashes and ``common`` (how frequent its shingles are, in the mean) of each row's set."""
    src = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(hot)

    def run(batches):
        hot_keys, hot_counts, cut = shared.value
        table = T.SlotTable(max(12, len(hot_keys).bit_length() + 1))
        table.add(T.mixed(hot_keys))
        for batch in T.chunked(batches, "text"):
            key, who = sets(T.Flat.of(batch.column("text")))
            rows = batch.num_rows
            n = np.bincount(who, minlength=rows)
            row = table.find(T.mixed(key >> _U(cut)))
            rank = np.where(row >= 0, hot_counts[row] if len(hot_counts) else 0, 0)
            common = np.bincount(who, np.log1p(rank), rows) / np.maximum(n, 1)
            longs = np.clip(2 ** np.ceil(np.log2(np.maximum(n, 1) / 32)), *LONGS).astype(np.int64)
            ends = np.concatenate([[0], np.cumsum(longs)])
            bits = np.zeros(ends[-1], np.uint64)
            place = key % (64 * longs[who]).astype(np.uint64)
            np.bitwise_or.at(bits, ends[who] + (place // _U(64)).astype(np.int64), _U(1) << (place % _U(64)))
            prefix, of = _prefixes(key, who, n, rank)
            small = np.arange(len(key)) - np.repeat(np.cumsum(n) - n, n) < STARS * SMALLEST
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array(n),
                    pa.array(_sids(key, who, n)),
                    _lists(bits.view(np.int64), ends),
                    _lists(prefix.view(np.int64), _first(of, rows)),
                    _lists(key[small].view(np.int64), _first(who[small], rows)),
                    pa.array(common),
                ],
                names=["id", "n", "sid", "bitmap", "prefix", "smallest", "common"],
            )

    kind = src.schema["id"].dataType.simpleString()
    return src.mapInArrow(run, f"id {kind}, n long, sid long, bitmap array<long>, prefix array<long>, smallest array<long>, common double")


def _lists(values: np.ndarray, first: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(values))


def arrays(docs: DataFrame, wanted: DataFrame, id: str, text: str) -> DataFrame:
    """sid and sorted shingles of the wanted sets (sid, id of a document that has it), and of a few others."""
    src = docs.where(F.col(id).isNotNull()).select(F.col(id).alias("id"), F.col(text).alias("text"))
    ids = docs.sparkSession.sparkContext.broadcast(Sieve.of(wanted, F.xxhash64("id")))

    def run(batches):
        for whole in T.chunked(batches, "text"):
            batch = whole.filter(pa.array(ids.value.passes(whole.column("hash").to_numpy())))
            key, who = sets(T.Flat.of(batch.column("text")))
            n = np.bincount(who, minlength=batch.num_rows)
            lists = _lists(key.view(np.int64), _first(who, batch.num_rows))
            yield pa.RecordBatch.from_arrays([pa.array(_sids(key, who, n)), lists], names=["sid", "shingles"])

    return src.withColumn("hash", F.xxhash64("id")).select("hash", "text").mapInArrow(run, "sid long, shingles array<long>")


def possible(pairs: DataFrame, sizes: DataFrame) -> DataFrame:
    """Of the pairs (a, b) those whose bitmaps leave room for enough overlap."""
    side = lambda c: sizes.select(F.col("sid").alias(c), F.col("n").alias(f"n_{c}"), F.col("bitmap").alias(f"bits_{c}"))
    pairs = pairs.join(side("a"), "a").join(side("b"), "b")

    def halved(c):
        """The bitmap of the same set with half as many bits."""
        half = (F.size(c) / 2).cast("int")
        return F.zip_with(F.slice(c, 1, half), F.slice(c, half + 1, half), lambda x, y: x.bitwiseOR(y))

    # similar sets are so close in size that their bitmaps are as long, or one is twice as long
    a, b = F.col("bits_a"), F.col("bits_b")
    a, b = F.when(F.size(a) > F.size(b), halved(a)).otherwise(a), F.when(F.size(b) > F.size(a), halved(b)).otherwise(b)
    differ = F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    both = F.col("n_a") + F.col("n_b")
    return pairs.where((both - differ) * (LINK[0] + LINK[1]) >= both * (2 * LINK[0])).select("a", "b")


def similar(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """Of the pairs (a, b) those whose sorted arrays have enough in common."""
    held = lambda c: found.select(F.col("sid").alias(c), F.col("shingles").alias(f"set_{c}"))
    pairs = pairs.join(held("a"), "a").join(held("b"), "b")

    def run(batches):
        for batch in batches:
            (xs, xa), (ys, ya) = (_arrays(batch.column(c)) for c in ("set_a", "set_b"))
            keep = np.zeros(batch.num_rows, bool)
            for k in range(batch.num_rows):
                x, y = xs[xa[k] : xa[k + 1]], ys[ya[k] : ya[k + 1]]
                # both ascend: what is equal lies side by side when they are merged
                merged = np.sort(np.concatenate([x, y]), kind="stable")
                shared = int((merged[1:] == merged[:-1]).sum())
                keep[k] = LINK[1] * shared >= LINK[0] * (len(merged) - shared)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep))

    return pairs.select("a", "b", "set_a", "set_b").mapInArrow(run, "a long, b long")


def _arrays(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return column.values.to_numpy(), column.offsets.to_numpy()


def classes(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """id, n_shingles and component_id (the smallest id that links reach) of each row."""
    spark = docs.sparkSession
    hot = hot_shingles(docs, text)
    tidy(spark)
    members = stage(summaries(docs, hot, id, text))
    real = members.where("n > 0 and id is not null")
    sizes = stage(real.groupBy("sid").agg(F.min("id").alias("id"), F.first("n").alias("n"), F.first("bitmap").alias("bitmap"), F.first("smallest").alias("smallest"), F.min("common").alias("common")))
    links, joined = spark.createDataFrame([], "a long, b long"), spark.createDataFrame([], "node long, root long")
    for k in range(STARS):
        before, labels = links, joined
        links = stage(before.union(_held(_star(sizes, labels, k), sizes, docs, id, text)))
        joined = stage(components(links))
        drop(before, labels)
    tiles = _tiles(real, joined)
    for k in range(TILE_STARS + 1):
        # components only grow: a tile that holds one of them is done for good
        before, labels, wide = links, joined, tiles
        tiles = _open(_labelled(tiles.drop("c"), joined) if k else tiles)
        drop(wide)
        if tiles.isEmpty():
            break
        pairs = _tile_star(tiles, k) if k < TILE_STARS else _across(tiles)
        links = stage(before.union(_held(pairs, sizes, docs, id, text)))
        joined = stage(components(links))
        drop(before, labels)
    drop(links, tiles)
    owned = sizes.select("sid", "id").join(joined.withColumnRenamed("node", "sid"), "sid", "left").withColumn("root", F.coalesce("root", "sid"))
    smallest = owned.groupBy("root").agg(F.min("id").alias("component_id"))
    named = owned.join(smallest, "root").select("sid", "component_id")
    out = real.select("id", "n", "sid").join(named, "sid").select("id", "n", "component_id")
    rest = members.where("n = 0 or id is null").select("id", "n", F.col("id").alias("component_id"))
    return out.union(rest).select(F.col("id").alias(id), F.col("n").alias("n_shingles"), "component_id")


def _held(pairs: DataFrame, sizes: DataFrame, docs: DataFrame, id: str, text: str) -> DataFrame:
    """Of the pairs (a, b) of sids the similar ones; arrays are made of the sets that occur in them."""
    pairs = stage(possible(pairs, sizes))
    tidy(docs.sparkSession)
    if pairs.isEmpty():
        return pairs
    used = pairs.select(F.explode(F.array("a", "b")).alias("sid")).distinct()
    wanted = stage(sizes.select("sid", "id").join(used, "sid"))
    found = stage(arrays(docs, wanted, id, text))
    links = stage(similar(pairs, found))
    drop(pairs, wanted, found)
    tidy(docs.sparkSession)
    return links


def _labelled(sets: DataFrame, joined: DataFrame) -> DataFrame:
    """c: the component of each set so far."""
    return sets.join(joined.withColumnRenamed("node", "sid"), "sid", "left").withColumn("c", F.coalesce("root", "sid")).drop("root")


def _star(sizes: DataFrame, joined: DataFrame, k: int) -> DataFrame:
    """Pairs of a set and the centre of each of its stars, where their components differ."""
    band = F.floor(F.log(F.col("n").cast("double")) / float(np.log(LINK[1] / LINK[0])) + k / STARS)
    keys = F.explode(F.slice("smallest", k * SMALLEST + 1, SMALLEST)).alias("key")
    rows = _labelled(sizes.select("sid", "n", "smallest", "common"), joined).select("sid", "c", "common", band.alias("band"), keys)
    middle = rows.groupBy("key", "band").agg(F.min(_turn(k)).alias("m"), F.min("c").alias("lo"), F.max("c").alias("hi"))
    middle = middle.where("lo <> hi").select("key", "band", "m.turn", "m.centre", "m.own")
    return _first_centres(rows.join(middle, ["key", "band"]).where("c <> own"))


def _turn(k: int) -> Column:
    """What makes a set the centre of a star: that its shingles are the most frequent ones, as of a text
    that many others were made from; in later rounds chance."""
    turn = -F.col("common") if k == 0 else F.xxhash64("sid", "key", F.lit(k)).cast("double")
    return F.struct(turn.alias("turn"), F.col("sid").alias("centre"), F.col("c").alias("own"))


def _first_centres(rows: DataFrame) -> DataFrame:
    """Each set (sid) with CENTRES of its centres at most: in each part of its keys the one whose turn comes first."""
    part = F.pmod(F.xxhash64("key"), F.lit(CENTRES))
    first = rows.groupBy("sid", part).agg(F.min(F.struct("turn", "centre")).alias("m"))
    return first.select(F.least("sid", "m.centre").alias("a"), F.greatest("sid", "m.centre").alias("b")).distinct()


def _tiles(real: DataFrame, joined: DataFrame) -> DataFrame:
    """key, sid, n, common, pos, near and c: sets by each shingle where similar sets must meet, if two
    documents have it, and their components so far.

    A set's shingles stay in one row until copies are gone and the set's component is known, so only
    that row is shuffled and not one for each shingle.
    """
    spark = real.sparkSession
    # shingles that begin two documents or more; most begin one
    open_ = stage(real.select(F.explode("prefix").alias("key")).groupBy("key").count().where("count > 1").select("key"))
    sieve = spark.sparkContext.broadcast(Sieve.of(open_, F.col("key")))

    def run(batches):
        for batch in batches:
            lists = batch.column("prefix")
            key = lists.flatten().to_numpy()
            size = np.diff(lists.offsets.to_numpy())
            who = np.repeat(np.arange(len(size)), size)
            pos = np.arange(len(key)) - np.repeat(np.cumsum(size) - size, size)
            take = sieve.value.passes(key)
            first = _first(who[take], len(size))
            out = [*(batch.column(c) for c in ("sid", "n", "common")), _lists(key[take], first), _lists(pos[take], first)]
            yield pa.RecordBatch.from_arrays(out, names=["sid", "n", "common", "key", "pos"])

    rows = real.select("sid", "n", "common", "prefix").mapInArrow(run, "sid long, n long, common double, key array<long>, pos array<long>")
    once = rows.where(F.size("key") > 0).groupBy("sid").agg(*(F.first(c).alias(c) for c in ("n", "common", "key", "pos")))
    known = stage(_labelled(once, joined))
    drop(open_)
    tidy(spark)
    each = known.select("sid", "n", "common", "c", F.explode(F.arrays_zip("key", "pos")).alias("at"))
    near = F.col("pos") * (LINK[0] + LINK[1]) <= F.col("n") * (LINK[1] - LINK[0])
    return each.select("sid", "n", "common", "c", "at.key", "at.pos").withColumn("near", near)


def _open(tiles: DataFrame) -> DataFrame:
    """Rows of the tiles that hold more than one component."""
    left = tiles.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo <> hi").select("key")
    return stage(tiles.join(left, "key"))


def _tile_star(tiles: DataFrame, k: int) -> DataFrame:
    """Pairs of a set and one other of its tiles, where their components differ."""
    middle = tiles.groupBy("key").agg(F.min(_turn(k).withField("m", F.col("n"))).alias("m")).select("key", "m.turn", "m.centre", "m.own", "m.m")
    fits = (F.col("n") * LINK[0] <= F.col("m") * LINK[1]) & (F.col("m") * LINK[0] <= F.col("n") * LINK[1])
    return _first_centres(tiles.join(middle, "key").where(fits & (F.col("c") != F.col("own"))))


def _across(tiles: DataFrame) -> DataFrame:
    """Pairs of sets from two components in a tile that can be similar."""
    x, y = (tiles.select("key", *(F.col(c).alias(f"{c}_{s}") for c in ("sid", "n", "pos", "c", "near"))) for s in "xy")
    least = F.ceil((F.col("n_x") + F.col("n_y")) * LINK[0] / (LINK[0] + LINK[1]))
    pairs = x.where("near_x").join(y, "key").where(
        (F.col("c_x") != F.col("c_y"))
        & ((F.col("n_x") < F.col("n_y")) | ((F.col("n_x") == F.col("n_y")) & (F.col("sid_x") < F.col("sid_y"))))
        & (F.col("n_y") * LINK[0] <= F.col("n_x") * LINK[1])
        # if this is the first shingle that they share, what is left of either must be enough
        & (F.least(F.col("n_x") - F.col("pos_x"), F.col("n_y") - F.col("pos_y")) >= least)
    )
    return pairs.select(F.col("sid_x").alias("a"), F.col("sid_y").alias("b")).distinct()
