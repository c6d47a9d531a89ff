"""Operator 4: SimHash near-duplicates with pigeonring filtering.

A text's fingerprint has bit k set if more than half of its word shingles'
XXH64 hashes have. Two fingerprints are linked at ``MAX_BITS`` or fewer
differing bits; documents are classed by the connected components.

Candidates. The 64 bits form a ring of ``MAX_BITS + 1`` segments. If two
fingerprints differ in at most t bits over m segments, some segment starts a
chain in which the first l segments together differ in at most l * t / m
bits, for every l (the pigeonring principle; l = 1 alone is the pigeonhole
principle). With t = 4 and m = 5 the budgets are 0, 1, 2, 3, 4. So every
distinct fingerprint is filed once under each start (segment equal, next one
equal) and looked up under each start with every single bit of the next
segment flipped: the key holds 26 bits rather than 13. The chains of length 3
and 4 prune what meets under a key before the full distance is taken.

Skew. Exact copies share a fingerprint and count once. A key under which more
than ``TILE`` fingerprints are filed (a large group of near copies) is dealt
as tiles, and so are the 12 or 13 keys that the group is looked up under, each
side by its own count: a tile has at most about ``TILE`` filed rows and as many
of the group, beside at most 13 * ``TILE`` rows of smaller groups. Under a key
of these without a filed row nothing can link, and its rows are left out. A
tile returns a spanning forest of its links, never all its pairs, which keeps
the components exact.

Defined cases: null, empty and blank texts have fingerprint zero and link
like any other; fewer words than a shingle hash as one shingle; null doc_ids
take part in linking and are passed over by the smallest doc_id (null where a
class has no other); repeated rows are one class; an empty table gives an
empty result; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ludica.llm.common import coded_words, materialize, slices
from ludica.llm.components import least_members

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
#: Fingerprints on one side of a tile.
TILE = 2048
#: Groups with fewer filed fingerprints are compared all together.
SMALL_GROUP = 8
#: Low bit and width of the segments (fixed by MAX_BITS + 1 = 5 segments).
SEGMENTS = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))


def fingerprints(texts: pa.Array, size: int = SHINGLE_WORDS) -> np.ndarray:
    """The fingerprint (uint64) of each text."""
    lower = pc.ascii_lower(pc.fill_null(texts.cast(pa.string()), ""))
    words = coded_words(lower)
    n = np.diff(words.offsets)
    lengths = pc.binary_length(words.distinct).to_numpy(zero_copy_only=False).astype(np.int64)[words.codes]
    out = np.zeros(len(n), np.uint64)
    shown = words.distinct.to_pylist()
    shown = [w.encode() for w in shown]
    digest = xxhash.xxh64_intdigest
    codes = words.codes
    for lo, hi in _runs(words.offsets):
        first, last = words.offsets[lo], words.offsets[hi]
        joined = b" ".join([shown[c] for c in codes[first:last].tolist()])
        ends = np.cumsum(lengths[first:last] + 1) - 1
        begins = ends - lengths[first:last]
        hashes, bounds = [], [0]
        for k in range(lo, hi):
            a, b = words.offsets[k] - first, words.offsets[k + 1] - first
            if b > a:
                w = min(size, b - a)
                hashes += [digest(joined[s:e], SEED) for s, e in
                           zip(begins[a:b - w + 1].tolist(), ends[a + w - 1:b].tolist())]
            bounds.append(len(hashes))
        h = np.array(hashes, dtype="<u8")
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        bounds = np.array(bounds)
        full = np.flatnonzero(np.diff(bounds))
        if len(full):
            ones = np.add.reduceat(bits, bounds[full], axis=0, dtype=np.int64)
            over = 2 * ones > np.diff(bounds)[full][:, None]
            out[lo + full] = np.packbits(over, axis=1, bitorder="little").view("<u8").reshape(-1)
    return out


def _runs(offsets: np.ndarray, words: int = 1 << 18) -> Iterator[tuple[int, int]]:
    """Ranges of lists with about ``words`` words each."""
    at, n = 0, len(offsets) - 1
    while at < n:
        stop = max(at + 1, int(np.searchsorted(offsets, offsets[at] + words, "right")) - 1)
        yield at, min(stop, n)
        at = min(stop, n)


def fingerprint(text: Column) -> Column:
    """The fingerprint of a text column, as a (signed) long."""
    @F.arrow_udf("long")
    def prints(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            parts = [fingerprints(s.column("text")).view(np.int64)
                     for s in slices(pa.RecordBatch.from_arrays([texts], names=["text"]))]
            yield pa.array(np.concatenate(parts) if parts else np.zeros(0, np.int64))
    return prints(text)


def as_hex(fp: str) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _parts(fps: np.ndarray, at: int) -> np.ndarray:
    low, width = SEGMENTS[at % len(SEGMENTS)]
    return (fps >> np.uint64(low)) & np.uint64((1 << width) - 1)


def _filed(fps: np.ndarray) -> np.ndarray:
    """The key of each fingerprint (columns) at each start of the ring (rows)."""
    m = len(SEGMENTS)
    return np.stack([(np.uint64(s) << np.uint64(26)) | (_parts(fps, s) << np.uint64(SEGMENTS[(s + 1) % m][1]))
                     | _parts(fps, s + 1) for s in range(m)]).astype(np.int64)


def _keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, fingerprint, looked-up) rows: one filed row per start, and one
    looked-up row per start and bit of the following segment."""
    m, keys, looked = len(SEGMENTS), [], []
    for s, filed in enumerate(_filed(fps)):
        keys.append(filed)
        looked.append(False)
        for bit in range(SEGMENTS[(s + 1) % m][1]):
            keys.append(filed ^ (1 << bit))
            looked.append(True)
    return np.concatenate(keys), np.tile(fps, len(keys)), np.repeat(looked, len(fps))


def _near(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b) <= MAX_BITS


def _chained(key: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Whether differences x stay within the chains of 3 and 4 segments from the key's start."""
    out = np.ones(len(x), bool)
    start = key >> 26
    for s in range(len(SEGMENTS)):
        mask = 0
        for length in range(1, len(SEGMENTS)):
            low, width = SEGMENTS[(s + length - 1) % len(SEGMENTS)]
            mask |= ((1 << width) - 1) << low
            budget = length * MAX_BITS // len(SEGMENTS)
            if length >= 3:
                out &= (start != s) | (np.bitwise_count(x & np.uint64(mask)) <= budget)
    return out


def _chain_masks(start: int) -> list[tuple[np.uint64, int]]:
    """(bits, budget) of the chains of 3 and 4 segments from a start."""
    out = []
    for length in (3, 4):
        segments = [SEGMENTS[(start + k) % len(SEGMENTS)] for k in range(length)]
        out.append((np.uint64(sum(((1 << width) - 1) << low for low, width in segments)), length * MAX_BITS // len(SEGMENTS)))
    return out


def spanning_forest(left: np.ndarray, right: np.ndarray, key: int | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links between left and right that connect what all their links connect:
    breadth first, each fingerprint against those not yet reached. With the
    group's key, only links within the chains of 3 and 4 segments from its
    start count (any link is within those of one of its starts)."""
    chains = [] if key is None else _chain_masks(key >> 26)

    def linked(others: np.ndarray, node: np.uint64) -> np.ndarray:
        x = others ^ node
        at = None
        for bits, budget in chains:
            ok = np.bitwise_count((x if at is None else x[at]) & bits) <= budget
            at = np.flatnonzero(ok) if at is None else at[ok]
        if at is None:
            return _near(others, node)
        hit = np.zeros(len(x), bool)
        hit[at] = np.bitwise_count(x[at]) <= MAX_BITS
        return hit

    edges: list[tuple[np.ndarray, np.ndarray]] = []
    waiting = {0: left, 1: right}
    while len(waiting[1]):
        reached = [(1, waiting[1][0])]
        waiting[1] = waiting[1][1:]
        while reached:
            side, node = reached.pop()
            other = waiting[1 - side]
            if not len(other):
                continue
            hit = linked(other, node)
            if hit.any():
                found = other[hit]
                waiting[1 - side] = other[~hit]
                edges.append((np.full(len(found), node), found))
                reached += [(1 - side, f) for f in found]
    return edges


def _links_of_groups(key: np.ndarray, fps: np.ndarray, role: np.ndarray, starts: np.ndarray) -> list[tuple]:
    """Links within groups (rows sorted by group; role 0 filed right side,
    1 left side): all of them for small groups, a forest for the others."""
    ends = np.append(starts[1:], len(key))
    right = np.add.reduceat((role == 0).astype(np.int64), starts)
    left = (ends - starts) - right
    edges: list[tuple] = []
    small = np.flatnonzero((right > 0) & (left > 0) & (right < SMALL_GROUP))
    # rows of a group are sorted by role: right ones first
    if len(small):
        s, r, n = starts[small], right[small], left[small]
        pairs = r * n
        group = np.repeat(np.arange(len(small)), pairs)
        nth = np.arange(pairs.sum()) - np.repeat(np.cumsum(pairs) - pairs, pairs)
        i = s[group] + nth % r[group]
        j = s[group] + r[group] + nth // r[group]
        x = fps[i] ^ fps[j]
        hit = np.flatnonzero((x != 0) & _chained(key[i], x))
        hit = hit[np.bitwise_count(x[hit]) <= MAX_BITS]
        edges.append((fps[i[hit]], fps[j[hit]]))
    for g in np.flatnonzero((right >= SMALL_GROUP) & (left > 0)):
        a, b = starts[g], starts[g] + right[g]
        edges += spanning_forest(fps[b:ends[g]], fps[a:b], int(key[a]))
    return edges


def _tiles(filed: DataFrame) -> DataFrame:
    """(key, rights, lefts): tiles of each side of the keys with more than
    TILE filed fingerprints and of the keys that those are looked up under
    (every other key has at most 14 * TILE rows in all). ``filed``: key, count.
    ``rights`` is 0 for a key under which nothing is filed."""
    heavy = materialize(filed.where(F.col("count") > TILE), "simhash-heavy")
    none = heavy.select("key", F.lit(0).alias("rights"), F.lit(0).alias("lefts"))
    if heavy.isEmpty():
        return none
    widths = ", ".join(str(SEGMENTS[(s + 1) % len(SEGMENTS)][1]) for s in range(len(SEGMENTS)))
    looked = (heavy.select(F.explode(F.expr(
        f"transform(sequence(0, element_at(array({widths}), int(shiftright(key, 26)) + 1) - 1), b -> key ^ shiftleft(1L, b))"))
        .alias("key"), "count").groupBy("key").agg(F.sum("count").alias("looked")))
    # both sides of a key are known from the heavy keys; its own rows may be few
    keys = heavy.select("key").union(looked.select("key")).distinct()
    own = filed.join(keys, "key", "left_semi")
    count, more = F.coalesce("count", F.lit(0)), F.coalesce("looked", F.lit(0))
    return materialize(
        keys.join(own, "key", "left").join(looked, "key", "left")
        .select("key", F.ceil(count / TILE).cast("int").alias("rights"), F.ceil((count + more) / TILE).cast("int").alias("lefts")),
        "simhash-tiles")


def _edges(prints: DataFrame) -> DataFrame:
    """(a, b) links between distinct fingerprints (column fp), enough to
    connect whatever all links connect."""
    width = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(_filed(fps).reshape(-1))], names=["key"])

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            for at in range(0, len(fps), 4096):
                key, fp, looked = _keys(fps[at:at + 4096])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key), pa.array(fp.view(np.int64)), pa.array(looked)], names=["key", "fp", "looked"])

    rows = (prints.select("fp").mapInArrow(look, "key long, fp long, looked boolean")
            .join(_tiles(prints.select("fp").mapInArrow(file, "key long").groupBy("key").count()), "key", "left"))
    hashed = F.xxhash64(F.col("fp"), F.lit(1))
    right, left = (F.pmod(hashed, F.greatest(F.col(n), F.lit(1))).cast("int") for n in ("rights", "lefts"))
    # no filed row: nothing to link with, so the looked-up rows go
    upto = lambda n: F.when(F.col(n) > 0, F.sequence(F.lit(0), F.col(n) - 1)).otherwise(F.array().cast("array<int>"))
    # (tile of the right side, tile of the left side, role): a filed row is on both sides
    as_right = F.transform(upto("lefts"), lambda t: F.struct(right.alias("r"), t.alias("l"), F.lit(0).alias("role")))
    as_left = F.transform(upto("rights"), lambda t: F.struct(t.alias("r"), left.alias("l"), F.lit(1).alias("role")))
    one = lambda role: F.array(F.struct(F.lit(0).alias("r"), F.lit(0).alias("l"), F.lit(role).alias("role")))
    placed = (F.when(F.col("rights").isNull(), F.when(F.col("looked"), one(1)).otherwise(F.concat(one(0), one(1))))
              .when(F.col("looked"), as_left).otherwise(F.concat(as_right, as_left)))
    dealt = (rows.select("key", "fp", F.explode(placed).alias("p"))
             .select("key", "fp", "p.r", "p.l", "p.role")
             .repartition(width, "key", "r", "l")
             .sortWithinPartitions("key", "r", "l", "role", "fp"))

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None

        def emit(rows: list[np.ndarray]) -> pa.RecordBatch | None:
            key, fps, r, l, role = rows
            new = np.flatnonzero(np.concatenate([[True], (np.diff(key) != 0) | (np.diff(r) != 0) | (np.diff(l) != 0)]))
            found = _links_of_groups(key, fps.view(np.uint64), role, new)
            if not found:
                return None
            a = np.concatenate([f[0] for f in found]).view(np.int64)
            b = np.concatenate([f[1] for f in found]).view(np.int64)
            pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)])[:, a != b], axis=1)
            return pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], names=["a", "b"])

        for batch in batches:
            rows = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "fp", "r", "l", "role")]
            if held is not None:
                rows = [np.concatenate(x) for x in zip(held, rows)]
            key, _, r, l, _ = rows
            changes = np.flatnonzero((np.diff(key) != 0) | (np.diff(r) != 0) | (np.diff(l) != 0))
            cut = changes[-1] + 1 if len(changes) else 0
            held = [x[cut:] for x in rows]
            if cut and (out := emit([x[:cut] for x in rows])) is not None:
                yield out
        if held is not None and len(held[0]) and (out := emit(held)) is not None:
            yield out

    return dealt.mapInArrow(link, "a long, b long")


def classes(prints: DataFrame) -> DataFrame:
    """For each distinct fingerprint of ``prints`` (doc_id, fp): fp, root (the
    smallest fingerprint of its component), component_id (the smallest doc_id
    of its component) and whether it holds that document."""
    distinct = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-distinct")
    roots = materialize(least_members(_edges(distinct), "a", "b"), "simhash-roots")
    rooted = materialize(
        distinct.join(roots, distinct["fp"] == roots["node"], "left")
        .select("fp", "first", F.coalesce("root", "fp").alias("root")), "simhash-rooted")
    least = materialize(
        rooted.groupBy("root").agg(F.min(F.struct(F.col("first").isNull().alias("none"), "first", "fp")).alias("m"))
        .select("root", F.col("m.first").alias("component_id"), F.col("m.fp").alias("holder")), "simhash-least")
    return materialize(rooted.join(least, "root")
                       .select("fp", "root", "component_id", (F.col("fp") == F.col("holder")).alias("holds")), "simhash-classes")


def simhash_groups(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint, component_id and component (the smallest
    fingerprint of the class, also where no member has a doc_id)."""
    prints = materialize(docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                                     fingerprint(F.col("text").cast("string")).alias("fp")), "simhash-prints")
    return (prints.join(classes(prints), "fp")
            .select("doc_id", as_hex("fp").alias("fingerprint"), "component_id", as_hex("root").alias("component")))


def keep_one_per_group(docs: DataFrame) -> DataFrame:
    """The row with the smallest doc_id of each class, with all its columns
    (null doc_ids last; among rows of that doc_id the smallest text). The rows are
    written once with their fingerprints, so that each text is hashed once."""
    columns = [F.col(f"`{c}`") for c in docs.columns]
    text = F.col("text").cast("string")
    rows = materialize(docs.select(F.struct(*columns).alias("_row"), F.col("doc_id").cast("long").alias("doc_id"),
                                   fingerprint(text).alias("fp")), "simhash-rows")
    held = classes(rows.select("doc_id", "fp")).where("holds").select("fp")
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("_row.text"))
    firsts = rows.groupBy("fp").agg(F.min_by("_row", order).alias("_row"))
    return firsts.join(held, "fp", "left_semi").select("_row.*")
