"""N-gram Jaccard join: universe partition and the pigeonhole principle, verified exactly.

Two shingle sets with Jaccard similarity of at least t = p/q differ in at most
H = floor((a + b) (q - p) / (q + p)) shingles, a and b being their sizes.  Sizes
fall into bands a factor 1/t wide, and the hash of a shingle puts it into one of
a band's m segments.  What a set has in a segment is one signature.  If m > H,
some segment is the same in both sets.

Cost-based allocation: empty segments are the same in far too many sets and cost
nothing to leave out, and of the others a set needs H + 1 only (any H + 1 of the
segments of one side must contain an equal one): it probes its largest segments,
which are the most selective, and offers the others to probes only.  A set that
has too few non-empty segments uses one-deletion neighbourhoods as well: a
segment then counts twice, because one difference in it is found too.  If that
is not enough either, its empty segments take part, among such sets only.

Signatures travel as packed arrays (40 bits of each, the bucket besides), one row
for each task and bucket, and meet in their bucket.  Equal sets stand for one
another from the beginning.  A pair is first held against parity sketches of its
sets: these differ in no more bits than the sets do in shingles, so a pair whose
sketches differ in too many is no link for certain, and texts are moved and
compared exactly for the others only.  Where many sets share a signature, not all
pairs are made: first each group's hub (its smallest key) is compared with the
others, and groups whose members are one
component afterwards are done.  Small groups that are left make their pairs.
In large ones the sketches are compared, block by block, and a task returns only
pairs that connect something new.  What they connect is a family: only between
its sets are links left to find.  Every set outside a family's main component is
compared with all others of the family, block by block again: a task counts the
common shingles of two blocks by a matrix product and returns only links that
connect something new, so that no list of pairs is ever made.  Groups that merely
overlap are no family: a few common passages would make one of most of the
corpus, whose texts move as often as it has blocks.

Nulls and edges: null, empty and blank texts have no shingle and link with
nothing; a null id links with nothing; rows with equal ids are told apart by
their texts; a text with fewer words than the width is one shingle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .memory import give_back, giving_back
from .shared import Scratch, components, release, small
from .words import mix, shingle_sets

#: Mean size of a segment; a set with n shingles has about n * (1 - e^-MEAN) / MEAN segments that are not empty.
MEAN = 3.6

#: Bytes of packed signatures that a bucket's task should hold, and what a signature takes.
BUCKET_BYTES, SIGNATURE_BYTES = 32 << 20, 13


def most_different(a: int, b: int, p: int, q: int) -> int:
    """The most shingles in which sets of sizes a and b may differ at similarity p/q or more."""
    return (a + b) * (q - p) // (q + p)


def bands(p: int, q: int, top: int) -> np.ndarray:
    """Largest size of each band; a band's sizes are within the factor q/p of each other."""
    out = [1]
    while out[-1] < top:
        out.append(max(out[-1] + 1, out[-1] * q // p))
    return np.array(out, np.int64)


def segments(largest: int, p: int, q: int) -> int:
    """Number of segments of a band: more than H for every pair that may meet in it, and of MEAN shingles at most on average."""
    h = most_different(largest, largest * q // p, p, q)
    return max(h + 1, int(largest / MEAN)) if largest > 4 else h + 1


def signatures(values: np.ndarray, p: int, q: int, limits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(signatures, probes): hashes to meet others by, and which of them probe (two offers alone do not make a pair).

    Two sets meet in the band of the smaller one.  There each offers what it has
    in the segments that are not empty, and probes with H + 1 of them.
    """
    n = len(values)
    own, lowest = int(np.searchsorted(limits, n)), int(np.searchsorted(limits, -(-n * p // q)))
    mixed = mix(values ^ np.uint64(0xA0761D6478BD642F))
    found, probing = [], []
    for band in range(lowest, own + 1):
        largest = int(limits[band])
        m = segments(largest, p, q)
        h = most_different(n, n * q // p if band == own else min(largest, n), p, q)
        segment = (mix(values + np.uint64(band)) % np.uint64(m)).astype(np.int64)
        sums, sizes = np.zeros(m, np.uint64), np.bincount(segment, minlength=m)
        np.add.at(sums, segment, mixed)
        named = mix(np.arange(m, dtype=np.uint64) + np.uint64((band + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
        full = np.flatnonzero(sizes)
        order = full[np.argsort(-sizes[full], kind="stable")]
        if band < own:
            order = order[: h + 1]
        found.append(mix(sums[order] + named[order]))
        probing.append(np.arange(len(order)) <= h)
        if len(full) <= h:
            # too few: with one deletion, a segment of two shingles or more also finds one difference
            near = mix(mix(sums[full] + named[full]) ^ np.uint64(0xE7037ED1A0B428DB))
            less = mix(mix(sums[segment] - mixed + named[segment]) ^ np.uint64(0xE7037ED1A0B428DB))
            found += [near, less]
            probing.append(np.ones(len(near) + len(less), bool))
            if len(full) + np.count_nonzero(sizes > 1) <= h:
                found.append(mix(mix(sums + named) ^ np.uint64(0x8EBC6AF09C88C6E3)))
                probing.append(np.ones(m, bool))
    return np.concatenate(found), np.concatenate(probing)


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def shingle_keys(docs: DataFrame, width: int, seed: int = 0, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, n_shingles, key, proof): key names the set of shingles (null if empty), proof is a second hash of it."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, keys = [], []
            for values in shingle_sets(batch.column("text"), width):
                sizes.append(len(values))
                keys.append(set_key(values, seed))
            none = np.asarray(sizes, int) == 0
            both = np.asarray(keys, np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(sizes, pa.int64()), pa.array(both[:, 0], mask=none), pa.array(both[:, 1], mask=none)], names=["id", "n_shingles", "key", "proof"])

    return _texts(docs, id_col, text_col).mapInArrow(giving_back(each), "id long, n_shingles long, key long, proof long")


def set_key(values: np.ndarray, seed: int) -> tuple[np.uint64, np.uint64]:
    """Two 64-bit hashes of a set of shingles."""
    salt = np.uint64(seed * 0x2545F4914F6CDD1D & (1 << 64) - 1)
    total = (mix(values ^ salt).sum(dtype=np.uint64), mix(values ^ salt ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64))
    a, b = mix(np.array(total, np.uint64) + np.uint64(len(values)))
    return a, b


def groups(docs: DataFrame, width: int, p: int, q: int, seed: int, buckets: int, *, id_col: str, text_col: str) -> DataFrame:
    """Rows (gid, key): sets that share a signature; groups of the same sets are one group.

    A map task sends each bucket one row of packed (signature, key) arrays for
    some megabytes of text; a bucket's task sorts them.
    """
    limits = bands(p, q, 1 << 40)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[int] = set()  # sets this task has sent already: copies need no second signature
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def rows() -> pa.RecordBatch:
            sig, key = np.concatenate([x[0] for x in parts]), np.concatenate([x[1] for x in parts])
            to = ((sig >> np.uint64(1) & np.uint64(0x7FFFFF)) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(to, kind="stable")
            key, to = key[order], to[order]
            sig = (sig >> np.uint64(25) << np.uint64(1) | sig & np.uint64(1))[order].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]
            cut = np.flatnonzero(np.r_[True, to[1:] != to[:-1]])
            ends = np.r_[cut[1:], len(to)]
            return pa.RecordBatch.from_arrays(
                [pa.array(to[cut].astype(np.int32)), pa.array([sig[a:b].tobytes() for a, b in zip(cut, ends)], pa.binary()), pa.array([key[a:b].tobytes() for a, b in zip(cut, ends)], pa.binary())], names=["bucket", "sigs", "keys"]
            )

        for batch in batches:
            for values in shingle_sets(batch.column("text"), width):
                if not len(values):
                    continue
                key = set_key(values, seed)[0]
                if int(key) in sent:
                    continue
                if len(sent) < 200_000:
                    sent.add(int(key))
                sig, probe = signatures(values, p, q, limits)
                parts.append((sig & ~np.uint64(1) | probe, np.full(len(sig), key, np.uint64)))
                size += len(sig)
                if size > 250_000:
                    yield rows()
                    parts, size = [], 0
        if parts:
            yield rows()

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sigs, keys = [], []
        for batch in batches:
            for s, k in zip(batch.column("sigs"), batch.column("keys")):
                packed = np.zeros((len(s.as_buffer()) // 5, 8), np.uint8)
                packed[:, :5] = np.frombuffer(s.as_buffer(), np.uint8).reshape(-1, 5)
                sigs.append(packed.view("<u8").ravel())
                keys.append(np.frombuffer(k.as_buffer(), np.uint64))
        if not sigs:
            return
        sig, key = np.concatenate(sigs), np.concatenate(keys)
        del sigs, keys
        name = sig >> np.uint64(1)
        order = np.argsort(name)
        name = name[order]
        again = np.zeros(len(name) + 1, bool)
        again[1:-1] = name[1:] == name[:-1]
        shared = again[1:] | again[:-1]  # most signatures are of one set
        if not shared.any():
            return
        order, name = order[shared], name[shared]
        sig, key = sig[order], key[order]
        order = np.lexsort((key, name))
        name, key, probe = name[order], key[order], sig[order] & np.uint64(1)
        first = np.r_[True, name[1:] != name[:-1]]
        group = np.cumsum(first) - 1
        probed = np.bincount(group, probe.astype(np.int64)) > 0
        own = np.r_[True, (name[1:] != name[:-1]) | (key[1:] != key[:-1])][: len(name)]
        group, key = group[own], key[own]
        many = np.bincount(group, minlength=len(probed)) > 1
        keep = (many & probed)[group]
        group, key = group[keep], key[keep]
        if not len(group):
            return
        start = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        members = np.add.reduceat(mix(key), start)
        _, kept = np.unique(members, return_index=True)
        ends = np.r_[start[1:], len(group)]
        for a in range(0, len(kept), 5_000):
            part = kept[a : a + 5_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(members[part], (ends - start)[part]).view(np.int64)), pa.array(np.concatenate([key[start[i] : ends[i]] for i in part]).view(np.int64))], names=["gid", "key"]
            )

    sent = _texts(docs, id_col, text_col).where("id is not null").mapInArrow(giving_back(send), "bucket int, sigs binary, keys binary")
    return sent.repartition(buckets, "bucket").mapInArrow(giving_back(meet), "gid long, key long").distinct()


def sketch(values: np.ndarray) -> bytes:
    """For about each shingle one bit: the parity of the number of shingles that hash to it."""
    bits = 1 << max(6, (len(values) - 1).bit_length())
    at = (mix(values ^ np.uint64(0x9FB21C651E98DF25)) & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits(np.bincount(at, minlength=bits) & 1, bitorder="little").astype(np.uint8).tobytes()


def may_link(one: bytes, n: int, other: bytes, m: int, p: int, q: int) -> bool:
    """False only if sets of n and m shingles with these sketches are less than p/q similar."""
    if min(n, m) * q < max(n, m) * p:
        return False
    x, y = np.frombuffer(one, np.uint8), np.frombuffer(other, np.uint8)
    while len(x) > len(y):  # a sketch of half the length is the parity of the two halves
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    while len(y) > len(x):
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return int(np.bitwise_count(x ^ y).sum()) <= most_different(n, m, p, q)


def _with_hubs(pairs: DataFrame, of_key: DataFrame) -> DataFrame:
    """Rows (hub, part, role, key, columns of ``of_key``) for pairs (hub, key), where parts of about 500 pairs follow their hub (role 0).

    ``of_key`` has a row for each key, and moves once.
    """
    parts = pairs.groupBy("hub").agg(F.ceil(F.count("*") / 500).cast("int").alias("parts"))
    members = pairs.join(small(parts), "hub").select("key", "hub", F.pmod(F.xxhash64("key"), F.col("parts")).cast("int").alias("part"), F.lit(1).alias("role"))
    hubs = parts.select(F.col("hub").alias("key"), "hub", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).alias("role"))
    rows = of_key.join(small(members.unionByName(hubs)), "key")
    return rows.repartition("hub", "part").sortWithinPartitions("hub", "part", "role")


def _likely(pairs: DataFrame, sketches: DataFrame, p: int, q: int) -> DataFrame:
    """The pairs (hub, key) that their sketches (key, n, sketch) do not rule out."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub, mine, size = None, b"", 0
        for batch in batches:
            out = []
            for h, part, role, key, n, own in zip(*(batch.column(c).to_pylist() for c in ("hub", "part", "role", "key", "n", "sketch"))):
                if not role:
                    hub, mine, size = (h, part), own, n
                elif hub != (h, part):
                    raise ValueError("a hub's sketch is missing")
                elif may_link(mine, size, own, n, p, q):
                    out.append((h, key))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["hub", "key"])

    return _with_hubs(pairs, sketches).select("hub", "part", "role", "key", "n", "sketch").mapInArrow(each, "hub long, key long")


def _verify(pairs: DataFrame, texts: DataFrame, width: int, p: int, q: int) -> DataFrame:
    """The pairs (hub, key) whose sets have q * intersection >= p * union."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub, mine = None, None
        for batch in batches:
            out = []
            for h, part, role, key, values in zip(*(batch.column(c).to_pylist() for c in ("hub", "part", "role", "key")), shingle_sets(batch.column("text"), width)):
                if not role:
                    hub, mine = (h, part), values
                    continue
                if hub != (h, part):
                    raise ValueError("a hub's text is missing")
                both = len(np.intersect1d(mine, values, assume_unique=True))
                if q * both >= p * (len(mine) + len(values) - both):
                    out.append((h, key))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["a", "b"])

    return _with_hubs(pairs, texts).select("hub", "part", "role", "key", "text").mapInArrow(giving_back(each), "a long, b long")


#: Groups of at most so many sets make their pairs; sets of a block that is compared with others, and their shingles together.
FEW, BLOCK, BLOCK_SHINGLES = 32, 512, 1 << 19


def _compare(open_: list[np.ndarray], others: list[np.ndarray], p: int, q: int) -> Iterator[tuple[int, np.ndarray]]:
    """For some rows of ``open_``, the others that are at least p/q similar; only shingles that occur twice matter."""
    sets = open_ + others
    every, own = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    order = np.argsort(every, kind="stable")
    every, own = every[order], own[order]
    same = np.zeros(len(every) + 1, bool)
    same[1:-1] = every[1:] == every[:-1]
    twice = same[1:] | same[:-1]
    name = np.cumsum(~same[:-1][twice]) - 1
    own, n = own[twice], len(open_)
    common = np.zeros((n, len(others)), np.float32)
    step = 2048
    for lo in range(0, int(name[-1]) + 1 if len(name) else 0, step):
        a, b = np.searchsorted(name, [lo, lo + step])
        table = np.zeros((len(sets), step), np.float32)
        table[own[a:b], name[a:b] - lo] = 1
        common += table[:n] @ table[n:].T
    sizes = np.array([len(x) for x in sets], np.float64)
    linked = q * common.astype(np.float64) >= p * (sizes[:n, None] + sizes[None, n:] - common)
    for i in np.flatnonzero(linked.any(1)):
        yield int(i), np.flatnonzero(linked[i])


#: Sets of a block whose sketches are compared with those of another one, and pairs of them at once.
SKETCHES, AT_ONCE = 2048, 1 << 20


def _by_length(sketches: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
    """(places, rows of 64-bit words) for each length of sketches."""
    lengths = np.array([len(x) for x in sketches], int)
    places = [np.flatnonzero(lengths == size) for size in np.unique(lengths)]
    return [(at, np.frombuffer(b"".join(sketches[i] for i in at), np.uint64).reshape(len(at), -1)) for at in places]


def _folded(rows: np.ndarray, words: int) -> np.ndarray:
    while rows.shape[1] > words:
        rows = rows[:, : rows.shape[1] // 2] ^ rows[:, rows.shape[1] // 2 :]
    return rows


def _may_link_all(ones: list[bytes], n: np.ndarray, others: list[bytes], m: np.ndarray, p: int, q: int) -> Iterator[tuple[int, np.ndarray]]:
    """``may_link`` for all of ``ones`` with all of ``others``: (i, js), at most once for each i and length of the others' sketches."""
    far = _by_length(others)
    for mine, own in _by_length(ones):
        for theirs, other in far:
            top = m[theirs].astype(np.int64)
            if int(n[mine].max()) * q < int(top.min()) * p or int(top.max()) * q < int(n[mine].min()) * p:
                continue
            words = min(own.shape[1], other.shape[1])
            x, y = _folded(own, words), np.ascontiguousarray(_folded(other, words).T)
            step = max(1, AT_ONCE // len(theirs))
            for lo in range(0, len(mine), step):
                part, size = x[lo : lo + step], n[mine[lo : lo + step]].astype(np.int64)[:, None]
                bits = np.zeros((len(part), len(theirs)), np.int32)
                for w in range(words):
                    bits += np.bitwise_count(part[:, w, None] ^ y[w])
                near = (bits <= (size + top) * (q - p) // (q + p)) & (np.minimum(size, top) * q >= np.maximum(size, top) * p)
                for i in np.flatnonzero(near.any(1)):
                    yield int(mine[lo + i]), theirs[near[i]]


def _likely_blocks(many: DataFrame, sketches: DataFrame, p: int, q: int) -> DataFrame:
    """Pairs (a, b) that connect what sketches do not rule out, from rows (gid, key, component, n); n is the number of the group's sets.

    Two sets of a group that are in different components and may link are
    connected by these pairs, and each set that has such another one is in a pair.
    """
    side = lambda i, j, role: F.struct(i.cast("int").alias("i"), j.cast("int").alias("j"), F.lit(role).alias("role"))
    placed = many.withColumn("blocks", F.ceil(F.col("n") / SKETCHES).cast("int")).withColumn("at", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
    every = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: j)
    first = F.transform(F.filter(every, lambda j: j >= F.col("at")), lambda j: side(F.col("at"), j, 0))
    second = F.transform(F.filter(every, lambda i: i < F.col("at")), lambda i: side(i, F.col("at"), 1))
    rows = placed.select("gid", "key", "component", F.explode(F.concat(first, second)).alias("to")).select("gid", "to.*", "key", "component")
    rows = rows.join(sketches.select("key", F.col("n").alias("size"), "sketch"), "key")

    def each(keys: tuple, table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        role, key, component, size = (table[c].to_numpy() for c in ("role", "key", "component", "size"))
        sketch = table["sketch"].to_pylist()
        label = np.arange(len(key))
        found, counted = np.unique(component, return_counts=True)
        main = component == found[counted.argmax()]
        a, b = np.flatnonzero(role == 0), np.flatnonzero(role == 1)
        sides = [(a[~main[a]], a)] if keys[1] == keys[2] else [(a[~main[a]], b), (a[main[a]], b[~main[b]])]
        out: list[np.ndarray] = []
        for one, other in sides:
            if not (len(one) and len(other)):
                continue
            for i, js in _may_link_all([sketch[x] for x in one], size[one], [sketch[x] for x in other], size[other], p, q):
                x, ys = one[i], other[js]
                ys = ys[(component[ys] != component[x]) & (label[ys] != label[x])]
                if len(ys):
                    ys = ys[np.unique(label[ys], return_index=True)[1]]
                    out.append(np.stack([np.full(len(ys), key[x]), key[ys]]))
                    label[np.isin(label, label[ys])] = label[x]
        pairs = np.concatenate(out, 1) if out else np.zeros((2, 0), np.int64)
        return pa.table({"a": pa.array(pairs[0], pa.int64()), "b": pa.array(pairs[1], pa.int64())})

    return rows.groupBy("gid", "i", "j").applyInArrow(each, "a long, b long")


def _verify_blocks(members: DataFrame, texts: DataFrame, width: int, p: int, q: int) -> DataFrame:
    """Links (a, b) that connect the sets of each family, from rows (family, component, key, n); n is the size of a set."""
    sizes = members.groupBy("family", "component").agg(F.count("*").alias("n"))
    main = sizes.groupBy("family").agg(F.max_by("component", F.struct("n", "component")).alias("main"))
    sided = members.join(small(main), "family").withColumn("open", F.col("component") != F.col("main"))
    of = lambda mine: F.greatest(F.ceil(F.count_if(mine) / BLOCK), F.ceil(F.coalesce(F.sum(F.when(mine, F.col("n"))), F.lit(0)) / BLOCK_SHINGLES)).cast("int")
    blocks = sided.groupBy("family").agg(of(F.col("open")).alias("opens"), of(~F.col("open")).alias("mains"))
    placed = sided.join(small(blocks), "family").withColumn("at", F.pmod(F.xxhash64("key"), F.when(F.col("open"), F.col("opens")).otherwise(F.col("mains"))).cast("int"))
    # a pair of blocks (i, j): i of open sets; j of open sets from i on, or (after those) of the main component
    side = lambda i, j, role: F.struct(i.cast("int").alias("i"), j.cast("int").alias("j"), F.lit(role).alias("role"))
    all_others = F.transform(F.sequence(F.lit(0), F.col("opens") + F.col("mains") - 1), lambda j: j)
    first = F.transform(F.filter(all_others, lambda j: j >= F.col("at")), lambda j: side(F.col("at"), j, 0))
    second = F.transform(F.sequence(F.lit(0), F.col("at")), lambda i: side(i, F.col("at"), 1))
    of_main = F.transform(F.sequence(F.lit(0), F.col("opens") - 1), lambda i: side(i, F.col("opens") + F.col("at"), 1))
    to = F.when(F.col("open"), F.concat(first, second)).otherwise(of_main)
    rows = placed.where("opens > 0").select("family", "component", "key", F.explode(to).alias("to")).select("family", "to.*", "component", "key")
    rows = texts.join(small(rows), "key")

    def each(keys: tuple, table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        role, key, component = (table[c].to_numpy() for c in ("role", "key", "component"))
        sets = list(shingle_sets(table["text"], width))
        a, b = np.flatnonzero(role == 0), np.flatnonzero(role == 1)
        out: list[tuple[int, int]] = []
        if len(a) and len(b):
            of = {int(c): int(c) for c in component}

            def find(x: int) -> int:
                while of[x] != x:
                    of[x] = of[of[x]]
                    x = of[x]
                return x

            for i, js in _compare([sets[x] for x in a], [sets[x] for x in b], p, q):
                for j in js:
                    x, y = find(int(component[a[i]])), find(int(component[b[j]]))
                    if x != y:
                        of[x] = y
                        out.append((int(key[a[i]]), int(key[b[j]])))
        del sets
        if len(key) > BLOCK // 4:  # most families are small
            give_back()
        return pa.table({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([x for _, x in out], pa.int64())})

    return rows.groupBy("family", "i", "j").applyInArrow(each, "a long, b long")


def join(docs: DataFrame, scratch: Scratch, *, width: int = 5, similarity: tuple[int, int] = (80, 100), id_col: str = "doc_id", text_col: str = "text", buckets: int | None = None) -> DataFrame:
    """One row for each row: (id, n_shingles, component_id, key, component).

    Two texts link when q * |intersection| >= p * |union| for similarity (p, q);
    component_id is the smallest id that links reach, the id itself included.
    key names the row's set of shingles and component the group of sets it is in
    (null where the row links with nothing).
    """
    p, q = similarity
    spark = docs.sparkSession
    seed = 0
    while True:  # two different sets of one key would be taken for copies: then all keys are drawn anew
        sets = scratch.cut(shingle_keys(docs, width, seed, id_col=id_col, text_col=text_col), "sets")
        by_row = sets.where("key is not null and id is not null").groupBy("key", "id").agg(F.count("*").alias("rows"), F.min("proof").alias("low"), F.max("proof").alias("high"), F.min("n_shingles").alias("n"))
        named = by_row.groupBy("key").agg(F.min("id").alias("least"), F.min_by("rows", "id").alias("rows"), F.min("low").alias("low"), F.max("high").alias("high"), F.min("n").alias("n"))
        named = scratch.cut(named, "keys")
        if not named.where("low <> high").limit(1).count():
            break
        seed += 1
    scratch.seed = seed
    if buckets is None:  # a set sends about half as many signatures as it has shingles, 13 bytes each
        shingled = named.agg(F.sum("n")).first()[0] or 0
        buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-shingled * SIGNATURE_BYTES // BUCKET_BYTES))
    found = scratch.cut(groups(docs, width, p, q, seed, buckets, id_col=id_col, text_col=text_col), "groups")
    release(spark)  # the messages are the largest shuffle, texts the next
    wanted = small(scratch.cut(named.join(found.select("key").distinct(), "key").select("key", F.col("least").alias("id"), (F.col("rows") > 1).alias("again")), "wanted"))
    # one text for each set that shares a signature (rows with equal ids and other texts are told apart by their key)
    keyed = scratch.cut(_keyed(_texts(docs, id_col, text_col).join(wanted, "id"), width, seed), "keyed")
    release(spark)
    once = keyed.where("again").dropDuplicates(["key"])  # only ids that repeat with their text have more than one
    sketches = keyed.where("not again").select("key", "n", "sketch").union(once.select("key", "n", "sketch"))
    texts = keyed.where("not again").select("key", "text").union(once.select("key", "text"))

    def links(pairs: DataFrame) -> DataFrame:
        out = scratch.cut(_verify(scratch.cut(_likely(scratch.cut(pairs, "pairs"), sketches, p, q), "likely"), texts, width, p, q), "links")
        release(spark)
        return out

    hubs = found.groupBy("gid").agg(F.min("key").alias("hub"), F.count("*").alias("n"))
    first = links(found.join(hubs, "gid").where("key <> hub").select("hub", "key").distinct())
    so_far = components(first, scratch)

    now = found.join(so_far.withColumnRenamed("node", "key"), "key", "left").withColumn("component", F.coalesce("component", "key"))
    open_ = now.groupBy("gid").agg(F.min("component").alias("c0"), F.max("component").alias("c1"), F.count("*").alias("n")).where("c0 <> c1 and n > 2").select("gid", "n")
    left = scratch.cut(now.join(open_, "gid"), "left")
    few = left.where(F.col("n") <= FEW)
    one, other = few.select("gid", F.col("key").alias("hub"), F.col("component").alias("c")), few.select("gid", "key", "component")
    second = links(one.join(other, "gid").where("hub < key and c <> component").select("hub", "key").distinct())
    many = left.where(F.col("n") > FEW)
    # a family is what sketches leave: overlapping groups alone would join most sets of a large corpus to one
    family = components(scratch.cut(_likely_blocks(many, sketches, p, q), "near"), scratch).select(F.col("node").alias("key"), F.col("component").alias("family"))
    release(spark)
    members = scratch.cut(many.select("key", "component").distinct().join(family, "key").join(named.select("key", F.col("n")), "key"), "members")
    third = scratch.cut(_verify_blocks(members, texts, width, p, q), "links")
    scratch.drop(keyed)
    release(spark)

    linked = components(first.union(second).union(third), scratch)
    of_key = named.select("key", "least").join(linked.withColumnRenamed("node", "key"), "key", "left").withColumn("component", F.coalesce("component", "key"))
    lowest = of_key.groupBy("component").agg(F.min("least").alias("component_id"))
    by_key = scratch.cut(of_key.join(lowest, "component").select("key", "component", "component_id"), "by-key")
    named_row = F.col("id").isNotNull()
    return sets.join(by_key, "key", "left").select("id", "n_shingles", F.when(named_row, F.coalesce("component_id", "id")).alias("component_id"), F.when(named_row, F.col("key")).alias("key"), F.when(named_row, F.col("component")).alias("component"))


def keep_one(docs: DataFrame, scratch: Scratch, *, width: int = 5, similarity: tuple[int, int] = (80, 100), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` but for near duplicates: one row of each group stays, with the group's smallest id.

    Rows without an id or without a word stay.  Rows with equal ids are told
    apart by their texts: each is judged by its own group, and of several rows
    with a group's smallest id one stays, that with the smallest key.
    """
    rows = scratch.cut(join(docs, scratch, width=width, similarity=similarity, id_col=id_col, text_col=text_col), "rows")
    counted = rows.where("id is not null").groupBy("id").agg(F.count("*").alias("rows"), F.min("component_id").alias("c"))
    repeated = scratch.cut(counted.where("rows > 1").select("id"), "repeated")
    gone = scratch.cut(counted.where("rows = 1 and id <> c").select("id"), "gone")
    # rows travel as one column, so that no other name can clash with theirs
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")).withColumn("_own", F.col("_row")[id_col].cast("long"))
    names = lambda ids: small(ids.withColumnRenamed("id", "_own"))
    out = whole.join(names(gone), "_own", "left_anti").join(names(repeated), "_own", "left_anti").select("_row.*")
    if not repeated.limit(1).count():
        return out
    again = _with_key(whole.join(names(repeated), "_own", "left_semi").withColumn("_text", F.coalesce(F.col("_row")[text_col].cast("string"), F.lit(""))), width, scratch.seed)
    places = rows.join(small(repeated), "id").where("key is not null").select(F.col("key").alias("_key"), F.col("component").alias("_group"), F.col("component_id").alias("_least")).distinct()
    placed = again.join(small(places), "_key", "left")
    empty = placed.where("_group is null").select("_row")
    least = placed.where("_least = _own").groupBy("_group").agg(F.min_by("_row", "_key").alias("_row")).select("_row")
    return out.union(empty.union(least).select("_row.*"))


def _with_key(rows: DataFrame, width: int, seed: int) -> DataFrame:
    """All columns of ``rows`` but _text, and _key, the name of _text's set of shingles (null without words), as ``join`` gives it."""
    kept = [f for f in rows.schema.fields if f.name != "_text"]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [int(set_key(v, seed)[0].view(np.int64)) if len(v) else None for v in shingle_sets(batch.column("_text"), width)]
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in kept), pa.array(keys, pa.int64())], names=[*(f.name for f in kept), "_key"])

    return rows.mapInArrow(each, T.StructType([*kept, T.StructField("_key", T.LongType())]))


def _keyed(texts: DataFrame, width: int, seed: int) -> DataFrame:
    """Rows (key, again, n, sketch, text) from rows (id, text, key, again): those whose text has the wanted key."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, sizes, sketches = [], [], []
            for values, key in zip(shingle_sets(batch.column("text"), width), batch.column("key").to_pylist()):
                same = len(values) > 0 and int(set_key(values, seed)[0].view(np.int64)) == key
                own.append(same)
                if same:
                    sizes.append(len(values))
                    sketches.append(sketch(values))
            kept = batch.select(["key", "again", "text"]).filter(pa.array(own, pa.bool_()))
            yield pa.RecordBatch.from_arrays([kept.column("key"), kept.column("again"), pa.array(sizes, pa.int64()), pa.array(sketches, pa.binary()), kept.column("text")], names=["key", "again", "n", "sketch", "text"])

    return texts.select("key", "again", "text").mapInArrow(giving_back(each), "key long, again boolean, n long, sketch binary, text string")
