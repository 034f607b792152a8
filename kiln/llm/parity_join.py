"""N-gram Jaccard join by parity sketches.

A document is its set of distinct word shingles (64-bit hashes). Two sets with Jaccard similarity of at least
t differ in at most d = (|A| + |B|)(1 - t)/(1 + t) shingles, and their sizes differ by a factor of 1/t at
most. Sizes are cut into bands at least that wide, so partners are in the same or in adjacent bands. In a band
shingles are dealt by hash to K = d + 1 blocks, and the hashes of a block are XORed: blocks of two sets that
agree have equal XORs, a differing shingle spoils one block, so of K blocks one at least must agree.
Documents of the band, and those below it that may have partners in it, meet on (band, block, XOR).

An empty block says nothing, so it is joined with its successor, in which one difference is then allowed (keys
for the block's XOR and for that XOR without each one shingle). No link is lost: if all agreeing blocks are
empty, the differences beyond one a block are fewer than the agreeing blocks, so one of these has a successor
with one difference at most.

Each set has a bit sketch, too (every shingle flips one of about n bits), and the Hamming distance of two
sketches never exceeds the number of differing shingles. Sets that meet on a key are held against its
smallest by their sketches. If all are close, the key is done; the members of the others are compared with each
other, again by sketch, unless they are connected already. Families of sets connected by close sketches are
compared in cells of bounded size: pairs within the bound that aren't linked yet are verified on the shingles
themselves. Links become spanning edges, and their components the classes.

Equal sets are one node from the start. Each Arrow slice folds equal keys before the shuffle (one row of a key
a slice, the others become candidate edges at once), so a group of copies of any size meets as one row a
slice. A family beyond a cell's size is cut into pieces, every pair of pieces a cell of its own.

Cases: null texts and texts without words have no shingles and link with nothing (component: themselves);
texts shorter than a shingle are one shingle; repeated rows and equal texts share a component; null doc_ids
take part, a component's id is its smallest non-null doc_id; empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kiln.llm.common import (
    LOWER,
    WORD_BASE,
    Slice,
    as_signed,
    components,
    mix64,
    owner,
    row_key,
    give_back,
    runs_of,
    sifted,
    split_words,
    stored,
    text_slices,
    trimmed,
    window_hash,
    word_hashes,
)

#: Shingles of one piece of a family, and rows of it.
CELL_SHINGLES, CELL_ROWS = 1 << 20, 4096
#: A band is as wide as so many times the largest factor between sizes of partners.
BAND_STEPS = 2
SLICE = 1 << 20
_DOC_BITS = 13  # rows of a slice; the other 51 bits of a word are a shingle's hash
_U = np.uint64
_SPARSE = _U(0xE3779B97F4A7C15F)


def shingles(s: Slice, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text: (hashes sorted by text, then value; rows + 1 offsets)."""
    s = s._replace(buf=LOWER[s.buf])
    w = split_words(s)
    h = word_hashes(s.buf, w)
    doc = owner(w.first)
    n = np.diff(w.first)
    grams = window_hash(h, width, WORD_BASE)
    inside = doc[: len(grams)] == doc[width - 1 :] if len(grams) else np.zeros(0, bool)
    values, rows = [grams[inside]], [doc[: len(grams)][inside]]
    for k in range(1, width):  # the whole sequence of shorter texts
        short = np.flatnonzero(n == k)
        if len(short):
            values.append(window_hash(h, k, WORD_BASE)[w.first[short]] ^ _U(k))
            rows.append(short)
    value, row = np.concatenate(values), np.concatenate(rows)
    packed = np.unique((row.astype(np.uint64) << _U(64 - _DOC_BITS)) | (value >> _U(_DOC_BITS)))
    row = (packed >> _U(64 - _DOC_BITS)).astype(np.int64)
    return mix64(packed & _U((1 << (64 - _DOC_BITS)) - 1)), np.searchsorted(row, np.arange(s.rows + 1))


def _sliced(col: pa.Array) -> Iterator[Slice]:
    for at in range(0, len(col), 1 << _DOC_BITS):
        for s in text_slices(col.slice(at, 1 << _DOC_BITS), SLICE):
            yield s._replace(first=s.first + at)


def set_ids(value: np.ndarray, first: np.ndarray) -> np.ndarray:
    """An id of each set, the same for equal sets."""
    n = np.diff(first)
    total = np.zeros(len(n), np.uint64)
    if len(value):
        sums = np.concatenate([[_U(0)], np.cumsum(mix64(value))])
        total = sums[first[1:]] - sums[first[:-1]]
    return mix64(total + n.astype(np.uint64))


def band_edges(top: int, num: int, den: int) -> list[int]:
    """Smallest size of each band, up to the band above that of ``top``."""
    edges = [1]
    while len(edges) < 3 or edges[-3] <= top:
        size = edges[-1]
        for _ in range(BAND_STEPS):
            size = size * den // num + 1
        edges.append(size)
    return edges


def block_keys(value: np.ndarray, first: np.ndarray, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """(set, key) of all blocks of the sets of a slice, in their own band and in the band above."""
    n = np.diff(first)
    live = np.flatnonzero(n)
    if not len(live):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    edges = np.array(band_edges(int(n.max()), num, den))
    own = np.searchsorted(edges, n[live], "right") - 1
    # shingles lie set by set; empty sets have none
    which = np.repeat(np.arange(len(live)), n[live])
    up = n[live] * den // num >= edges[own + 1]
    rows, keys = [], []
    for band, some in ((own, np.ones(len(live), bool)), (own + 1, up)):
        number_of = np.cumsum(some) - 1
        kept = some[which]
        part, band = live[some], band[some]
        shingle, of = value[kept], number_of[which[kept]]
        blocks = 2 * (edges[band + 1] - 1) * (den - num) // (den + num) + 1
        base = np.concatenate([[0], np.cumsum(blocks)])
        at = base[:-1][of] + ((shingle >> _U(11)) % blocks.astype(np.uint64)[of]).astype(np.int64)
        xor = np.zeros(base[-1], np.uint64)
        np.bitwise_xor.at(xor, at, shingle)
        full = np.bincount(at, minlength=base[-1]) > 0
        node = np.repeat(np.arange(len(part)), blocks)
        number = np.arange(base[-1]) - base[:-1][node]
        tag = mix64((band[node].astype(np.uint64) << _U(40)) | number.astype(np.uint64))
        rows.append(part[node[full]])
        keys.append(mix64(tag[full] ^ xor[full]))
        # empty blocks: with their successors, one difference allowed
        empty = np.flatnonzero(~full)
        if len(empty):
            after = base[:-1][node[empty]] + (number[empty] + 1) % blocks[node[empty]]
            rows.append(part[node[empty]])
            keys.append(mix64(tag[empty] ^ xor[after] ^ _SPARSE))
            before = np.full(base[-1], -1)
            before[after] = empty
            one = before[at] >= 0
            blank = before[at[one]]
            rows.append(part[of[one]])
            keys.append(mix64(tag[blank] ^ xor[at[one]] ^ shingle[one] ^ _SPARSE))
    return np.concatenate(rows), np.concatenate(keys)


def _meet(width: int, num: int, den: int):
    shape = pa.schema([("route", pa.int64()), ("a", pa.int64()), ("b", pa.int64()), ("key", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in _sliced(batch.column("text")):
                value, first = shingles(s, width)
                ids = set_ids(value, first)
                row, key = block_keys(value, first, num, den)
                node = ids[row]
                _, lead, inverse = np.unique(key, return_index=True, return_inverse=True)
                # the first set of each key asks for others; the further ones are its candidates already
                pivot = node[lead][inverse]
                more = np.flatnonzero(pivot != node)
                lead = np.sort(lead)  # rows of a set together: they compress well
                a = np.concatenate([node[lead], node[more]])
                route = np.concatenate([key[lead], mix64(node[more] ^ key[more])])
                met = np.arange(len(a)) >= len(lead)
                b = np.concatenate([np.zeros(len(lead), np.uint64), pivot[more]]).view(np.int64)
                k = np.concatenate([np.zeros(len(lead), np.uint64), key[more]]).view(np.int64)
                yield pa.RecordBatch.from_arrays([as_signed(route), as_signed(a), pa.array(b, mask=~met), pa.array(k, mask=~met)], schema=shape)

    return run, "route long, a long, b long, key long"


def meetings(docs: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """Rows (key, p, a): set a meets set p, the smallest of its slice or of all slices, on a key."""
    run, kind = _meet(width, num, den)
    rows = docs.select("text").mapInArrow(trimmed(run), kind)
    pivot = F.min(F.when(F.col("b").isNull(), F.col("a"))).over(Window.partitionBy("route"))
    met = rows.withColumn("p", F.coalesce("b", pivot)).withColumn("key", F.coalesce("key", "route"))
    return met.where("p != a").select("key", "p", "a")


def sketch_of(value: np.ndarray) -> bytes:
    """A bit for each of 0.75n to 1.5n hash places: whether an odd number of the n shingles falls on it."""
    bits = max(64, 1 << (3 * len(value) // 4).bit_length())
    odd = np.bincount((value & _U(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def fold(sketch: np.ndarray, size: int) -> np.ndarray:
    """The sketch of the same set with fewer bits (64 * size)."""
    return np.bitwise_xor.reduce(sketch.reshape(-1, size), axis=0)


def close(sa: bytes, na: int, sb: bytes, nb: int, num: int, den: int) -> bool:
    """False only if two sets can't be linked: by their sizes, or by the distance of their sketches."""
    if min(na, nb) * den < max(na, nb) * num:
        return False
    a, b = np.frombuffer(sa, np.uint64), np.frombuffer(sb, np.uint64)
    size = min(len(a), len(b))
    apart = int(np.bitwise_count(fold(a, size) ^ fold(b, size)).sum())
    return apart <= (na + nb) * (den - num) // (den + num)


def close_pairs(sa: list[bytes], na: np.ndarray, sb: list[bytes], nb: np.ndarray, num: int, den: int) -> np.ndarray:
    """``close`` for many pairs: those with sketches of the same two lengths at once."""
    out = np.minimum(na, nb) * den >= np.maximum(na, nb) * num
    lengths = np.array([(len(a) // 8, len(b) // 8) for a, b in zip(sa, sb, strict=True)]).reshape(-1, 2)
    for la, lb in np.unique(lengths[out], axis=0):
        rows = np.flatnonzero(out & (lengths[:, 0] == la) & (lengths[:, 1] == lb))
        size = min(la, lb)
        a, b = (
            np.bitwise_xor.reduce(np.frombuffer(b"".join([x[i] for i in rows]), np.uint64).reshape(len(rows), -1, size), axis=1)
            for x in (sa, sb)
        )
        apart = np.bitwise_count(a ^ b).sum(axis=1, dtype=np.int64)
        out[rows] = apart <= (na[rows] + nb[rows]) * (den - num) // (den + num)
    return out


def _close_udf(num: int, den: int):
    def run(sa: pa.Array, na: pa.Array, sb: pa.Array, nb: pa.Array) -> pa.Array:
        n = [x.to_numpy(zero_copy_only=False).astype(np.int64) for x in (na, nb)]
        return pa.array(close_pairs(sa.to_pylist(), n[0], sb.to_pylist(), n[1], num, den))

    return F.arrow_udf(run, "boolean")


def _near_pairs(num: int, den: int):
    """Of the sets that meet on a key, edges that connect those of different families with close sketches."""
    shape = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in runs_of(batches, "cell"):
            for part in _parts(t, ["group", "low", "high"]):
                node, n = part.column("node").to_numpy(), part.column("n").to_numpy().astype(np.int64)
                family, side = part.column("family").to_numpy().copy(), part.column("piece").to_numpy()
                sketch = part.column("sketch").to_pylist()
                across = len(np.unique(side)) > 1
                size = min(len(x) for x in sketch) // 8
                short = np.array([fold(np.frombuffer(x, np.uint64), size) for x in sketch])
                u, v = [], []
                for x in range(len(node)):
                    open_ = np.flatnonzero(family[x + 1 :] != family[x]) + x + 1
                    if across:
                        open_ = open_[side[open_] != side[x]]
                    # folded sketches first: all pairs of a set in one step
                    apart = np.bitwise_count(short[open_] ^ short[x]).sum(axis=1, dtype=np.int64)
                    open_ = open_[apart <= (n[open_] + n[x]) * (den - num) // (den + num)]
                    for y in open_.tolist():
                        if family[y] != family[x] and close(sketch[x], n[x], sketch[y], n[y], num, den):
                            u.append(node[x])
                            v.append(node[y])
                            family[family == family[y]] = family[x]
                if u:
                    yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], schema=shape)

    return run, "u long, v long"


def _parts(t: pa.Table, keys: list[str]) -> Iterator[pa.Table]:
    """A cell's rows; two cells may share a hash, and are told apart by their keys."""
    groups = t.group_by(keys).aggregate([]).to_pylist()
    for key in groups:
        yield t if len(groups) == 1 else t.filter(pa.array(np.all([t.column(k).to_numpy() == v for k, v in key.items()], axis=0)))


def in_cells(rows: DataFrame, load: DataFrame) -> DataFrame:
    """Rows of groups (column ``group``), sorted into cells; ``load`` has (group, pieces). A group of several
    pieces has a cell for each pair of them, and each row goes to the cells of its piece."""
    full = rows.join(load, "group").withColumn("piece", F.pmod(F.xxhash64("node"), F.col("pieces")).cast("int"))
    full = full.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
    full = full.withColumn("low", F.least("piece", "other")).withColumn("high", F.greatest("piece", "other"))
    full = full.withColumn("cell", F.xxhash64("group", "low", "high")).drop("other", "pieces")
    return full.repartition("cell").sortWithinPartitions("cell", "node")


def families(docs: DataFrame, sizes: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """Rows (node, family): sets connected by close sketches; linked sets are always in one family."""
    met = stored(meetings(docs, width, num, den))
    sets = sizes.where("n > 0").groupBy("node").agg(F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    side = lambda c: sets.select(F.col("node").alias(c), F.col("n").alias("n" + c), F.col("sketch").alias("s" + c))
    edges = met.select("p", "a").distinct().join(side("p"), "p").join(side("a"), "a")
    edges = stored(edges.select("p", "a", _close_udf(num, den)("sp", "np", "sa", "na").alias("near")))
    near = edges.where("near").select(F.col("p").alias("u"), F.col("a").alias("v"))
    family = components(near)
    mixed = met.join(edges.where("not near").select("p", "a"), ["p", "a"], "left_semi").select("key").distinct()
    again = met.join(mixed, "key", "left_semi")
    members = again.select(F.col("key").alias("group"), F.explode(F.array("p", "a")).alias("node")).distinct()
    members = members.join(family.withColumnRenamed("component", "family"), "node", "left").withColumn("family", F.coalesce("family", "node"))
    # where one family is left of a key, nothing is to be compared
    load = members.groupBy("group").agg(F.count("*").alias("rows"), F.min("family").alias("x"), F.max("family").alias("y"))
    load = load.where("x != y").select("group", F.ceil(F.col("rows") / CELL_ROWS).cast("int").alias("pieces"))
    run, kind = _near_pairs(num, den)
    more = in_cells(members.join(sets, "node"), load).mapInArrow(trimmed(run), kind)
    return components(near.union(more)).withColumnRenamed("component", "family")


def _sets(width: int):
    shape = pa.schema([("group", pa.int64()), ("node", pa.int64()), ("set", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in _sliced(batch.column("text")):
                value, first = shingles(s, width)
                raw = [np.sort(value[a:b]).tobytes() for a, b in zip(first[:-1], first[1:], strict=True)]
                own = [batch.column(c).slice(s.first, s.rows) for c in ("group", "node")]
                yield pa.RecordBatch.from_arrays([*own, pa.array(raw, pa.binary())], schema=shape)

    return run, "group long, node long, set binary"


def link_cell(ids: np.ndarray, sets: list[np.ndarray], side: np.ndarray, num: int, den: int) -> list[tuple[int, int]]:
    """Spanning edges of the links between sets of a cell; with two sides only links across are looked for."""
    size = np.array([len(s) for s in sets])
    order = np.lexsort((ids, size))
    ids, side, size = ids[order], side[order], size[order]
    sets = [sets[i] for i in order]
    bits = max(256, 1 << int(2 * size.max() - 1).bit_length())
    sketch = np.zeros((len(sets), bits // 64), np.uint64)
    for i, s in enumerate(sets):
        odd = (np.bincount((s & _U(bits - 1)).astype(np.int64), minlength=bits) & 1).astype(np.uint8)
        sketch[i] = np.packbits(odd).view(np.uint64)
    across = len(set(side.tolist())) > 1
    label = np.arange(len(sets))
    out = []
    for x in range(len(sets) - 1):
        end = int(np.searchsorted(size, size[x] * den // num, "right"))
        open_ = np.flatnonzero(label[x + 1 : end] != label[x]) + x + 1
        if across:
            open_ = open_[side[open_] != side[x]]
        if not len(open_):
            continue
        apart = np.bitwise_count(sketch[open_] ^ sketch[x]).sum(axis=1, dtype=np.int64)
        near = apart <= (size[open_] + size[x]) * (den - num) // (den + num)
        near_ids = open_[near][np.argsort(apart[near], kind="stable")]
        for y in near_ids.tolist():
            if label[y] == label[x]:
                continue
            both = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
            if den * both >= num * (size[x] + size[y] - both):
                out.append((int(ids[x]), int(ids[y])))
                label[label == label[y]] = label[x]
    return out


def _cells(num: int, den: int):
    shape = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in runs_of(batches, "cell"):
            for rows in _parts(t, ["group", "low", "high"]):
                sets = [np.frombuffer(x, np.uint64) for x in rows.column("set").to_pylist()]
                side = rows.column("piece").to_numpy()
                found = link_cell(rows.column("node").to_numpy(), sets, side, num, den)
                if found:
                    u, v = zip(*found, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], schema=shape)

    return run, "u long, v long"


def signatures(docs: DataFrame, width: int, text: str = "text") -> DataFrame:
    """``docs`` with a struct ``sig``: node (the set's id), n (its size) and sketch (about n / 8 bytes)."""

    def run(texts: pa.Array) -> pa.Array:
        ids, n, sketch = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], []
        for s in _sliced(texts):
            value, first = shingles(s, width)
            ids.append(set_ids(value, first))
            n.append(np.diff(first))
            sketch += [sketch_of(value[a:b]) for a, b in zip(first[:-1], first[1:], strict=True)]
        give_back()
        columns = [as_signed(np.concatenate(ids)), pa.array(np.concatenate(n).astype(np.int32)), pa.array(sketch, pa.binary())]
        return pa.StructArray.from_arrays(columns, ["node", "n", "sketch"])

    return docs.withColumn("sig", F.arrow_udf(run, "node long, n int, sketch binary")(F.col(text)))


def links(docs: DataFrame, sizes: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """Edges (u, v) between linked set ids that connect all that are linked; ``docs``: (key, text), ``sizes``:
    (key, node, n, sketch), one for each row."""
    family = families(docs, sizes, width, num, den).withColumnRenamed("family", "group")
    # one row stands for all with the same set
    nodes = sizes.where("n > 0").groupBy("node").agg(F.min("key").alias("key"), F.first("n").alias("n"))
    nodes = stored(nodes.join(family, "node"))
    load = nodes.groupBy("group").agg(F.sum("n").alias("total"), F.count("*").alias("rows"))
    pieces = F.greatest(F.ceil(F.col("total") / CELL_SHINGLES), F.ceil(F.col("rows") / CELL_ROWS)).cast("int")
    run, kind = _sets(width)
    # rows that repeat as a whole share a key and bring a set twice, which links nothing more
    docs = sifted(docs, nodes, "key")
    sets = docs.join(nodes.select("key", "node", "group"), "key").select("group", "node", "text").mapInArrow(trimmed(run), kind)
    run, kind = _cells(num, den)
    return in_cells(sets, load.select("group", pieces.alias("pieces"))).mapInArrow(trimmed(run), kind)


def classes(docs: DataFrame, width: int, num: int, den: int, text: str = "text") -> DataFrame:
    """(row, key, class, n_shingles, component_id) for each row of ``docs``; ``row`` is a struct of all its columns but the text."""
    rest = F.struct(*[F.col(c) for c in docs.columns if c != text])
    rows = docs.select(rest.alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows = rows.withColumn("key", row_key())
    marked = stored(signatures(rows, width).select("row", "doc_id", "key", "sig.*"))
    found = components(links(rows.select("key", "text"), marked.select("key", "node", "n", "sketch"), width, num, den))
    marked = marked.drop("sketch")
    marked = marked.join(found, "node", "left")
    marked = marked.withColumn("class", F.when(F.col("n") > 0, F.coalesce("component", "node")))
    # classes of one row need no meeting: only the others are summed by class
    least = marked.where("class is not null").groupBy("class").agg(F.min("doc_id").alias("least"))
    joined = marked.join(least, "class", "left")
    return joined.select("row", "key", "class", F.col("n").alias("n_shingles"), F.coalesce("least", "doc_id").alias("component_id"))


def keep_first(docs: DataFrame, width: int, num: int, den: int, text: str = "text") -> DataFrame:
    """The rows of ``docs`` without the later members of each class: of linked documents, and of rows repeated as
    a whole, the one with the smallest doc_id (then the smallest row key) stays; documents without shingles
    all stay."""
    found = classes(docs, width, num, den, text)
    # only the columns but the text were carried: the kept rows get it back by their key
    place = F.struct(F.col("row.doc_id").isNull(), F.col("row.doc_id"), F.col("key"))
    members = found.where("n_shingles > 0")
    first = members.groupBy("class").agg(F.min(place).alias("first"), F.count("*").alias("rows"))
    lost = members.join(first.where("rows > 1"), "class").select("key", (place == F.col("first")).alias("stays"))
    # of rows with one key (repeated as a whole) at most one stays
    lost = lost.groupBy("key").agg(F.max("stays").alias("stays"), F.count("*").alias("times"))
    lost = lost.where("not stays or times > 1")
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.xxhash64(F.col("doc_id").cast("long"), F.col(text)).alias("key"))
    joined = rows.join(lost.select("key", "stays"), "key", "left")
    once = joined.where("stays is null")
    twice = joined.where("stays").dropDuplicates(["key"])
    return once.unionByName(twice).select("row.*")
