"""Operator 10: benchmark decontamination by containment search.

A test item is found in a document if at least ``THRESHOLD`` of the item's
distinct five-word shingles occur in the document, wherever and however long
the document is. Words are runs of letters, digits and underscores, lower-cased.

Search. The items are partitioned by their number of shingles. An item's
sketch is the smallest MinHash values of its shingles, as many as its size
class needs: if at most k shingles of any item of the class can be missing at
the threshold, k + 1 values. So a document that contains an item holds at
least one value of its sketch, whichever shingles are missing: the search
misses nothing, and a document's shingles are only looked up in the small
sketch table. Each (document, item) candidate is then verified by the exact
shingles, as text.

Scale. Documents are streamed once and never shuffled; a hot passage costs
its matches only. The benchmark is taken in blocks of at most about
``BLOCK_CHARS`` characters, each broadcast in turn; a text counts once with
all its ids (8 characters each), and the ids of a text that has more than
``BLOCK_IDS`` are dealt to several blocks.

Defined cases: with ``short_items``, the words of an item with one to four
words are one shingle, found where they stand in a document one after the
other; without, such items match nothing. Items without a word, or null text,
match nothing. A word of a script without spaces is a whole clause, and has to
stand in the document as a whole clause; equal (item_id, text) rows count once, and an item
id with several texts is found if one of them is; null documents contain
nothing; null ids come back as null; repeated documents are reported each;
empty tables give an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ludica.llm.common import coded_words, materialize, ragged, ragged_take, slices

SHINGLE_WORDS = 5
THRESHOLD = 0.8
BLOCK_CHARS = 4_000_000
#: Ids of one text in a block.
BLOCK_IDS = 500_000
#: Pairs in a batch of results.
BATCH_PAIRS = 100_000
#: Most shingles of an item of each size class (then doubling on).
FIRST_CLASS = 8
_words = re.compile(r"\w+").findall
_PRIME = 0x9E3779B97F4A7C15
PAIRS = "doc_id long, item_id long, n_shingles int, n_shared int, containment double"


def shingle_hashes(words: np.ndarray, offsets: np.ndarray, size: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """MinHash value of each shingle and the list it belongs to, from word hashes."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    h = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(size):
            h = h * np.uint64(_PRIME) + words[k:k + n]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
    inside = owner[:n] == owner[size - 1:]
    return h[inside], owner[:n][inside]


def allowed_missing(shingles: int, threshold: float = THRESHOLD) -> int:
    """The most shingles an item may lack and still be contained."""
    return shingles - min(k for k in range(shingles + 1) if k >= threshold * shingles - 1e-9)


def sketch_size(shingles: int, threshold: float = THRESHOLD) -> int:
    """MinHash values of an item of the size class that ``shingles`` falls into."""
    top = FIRST_CLASS
    while top < shingles:
        top *= 2
    return 1 + max(allowed_missing(q, threshold) for q in (top, top - 1, top - 2, top - 3, top - 4) if q > 0)


def word_hash(word: str) -> int:
    return xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))


class ContainmentIndex:
    """The sketches and shingles of a block of items: (text, its item_ids) pairs."""

    def __init__(self, items: list[tuple[str, list[int | None]]], threshold: float = THRESHOLD, short_items: bool = False):
        self.threshold = threshold
        self.ids: list[list[int | None]] = []
        self.shingles: list[list[str]] = []
        sizes, values, owners = {SHINGLE_WORDS}, [], []
        for text, ids in sorted(items, key=lambda x: x[0]):
            words = _words(text.lower())
            size = min(len(words), SHINGLE_WORDS)
            if size < (1 if short_items else SHINGLE_WORDS):
                continue
            sizes.add(size)
            hashed = np.array([word_hash(w) for w in words], np.uint64)
            h = np.unique(shingle_hashes(hashed, np.array([0, len(words)]), size)[0])
            shingles = sorted({" ".join(words[i:i + size]) for i in range(len(words) - size + 1)})
            sketch = h[:sketch_size(len(shingles), threshold)]
            values.append(sketch)
            owners.append(np.full(len(sketch), len(self.ids)))
            self.ids.append(ids)
            self.shingles.append(shingles)
        value = np.concatenate(values) if values else np.zeros(0, np.uint64)
        owner = np.concatenate(owners) if owners else np.zeros(0, np.int64)
        order = np.argsort(value, kind="stable")
        self.values, starts = np.unique(value[order], return_index=True)
        self.owners, self.starts = owner[order], np.append(starts, len(order))
        self.sizes = sorted(sizes)

    def search(self, texts: pa.Array) -> list[tuple[int, int, int]]:
        """(row, item, shared shingles) of every item text contained in a text, in order of the rows."""
        if not len(self.values):
            return []
        words = coded_words(texts)
        known: dict[str, int] = {}
        lists = []
        for chunk in words.distinct.to_pylist():
            own = []
            for w in _words(chunk.lower()):
                if (h := known.get(w)) is None:
                    h = known[w] = word_hash(w)
                own.append(h)
            lists.append(own)
        flat, ends = ragged_take(*ragged(lists, np.uint64), words.codes)
        offsets = ends[words.offsets]
        hits = []
        for size in self.sizes:
            h, owner = shingle_hashes(flat, offsets, size)
            at = np.minimum(np.searchsorted(self.values, h), len(self.values) - 1)
            hit = self.values[at] == h
            hits.append(np.unique(owner[hit] * len(self.values) + at[hit]))
        owner, at = np.divmod(np.unique(np.concatenate(hits)), len(self.values))
        sizes = np.diff(self.starts)[at]
        items, _ = ragged_take(self.owners, self.starts, at)
        pairs = np.unique(np.stack([np.repeat(owner, sizes), items]), axis=1)
        out, row, shown = [], -1, ""
        for k, item in pairs.T.tolist():
            if k != row:
                row, shown = k, f" {' '.join(_words(texts[k].as_py().lower()))} "
            shared = sum(f" {s} " in shown for s in self.shingles[item])
            if shared >= self.threshold * len(self.shingles[item]) - 1e-9:
                out.append((k, item, shared))
        return out


def benchmark_blocks(benchmark: DataFrame, threshold: float = THRESHOLD, short_items: bool = False) -> Iterator[ContainmentIndex]:
    """The benchmark (item_id, text) as indexes of bounded size."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"),
                             F.col("text").cast("string").alias("text")).where("text is not null").distinct()
    many = items.groupBy("text").agg(F.ceil(F.count("*") / BLOCK_IDS).alias("parts")).where("parts > 1")
    part = F.pmod(F.xxhash64(F.coalesce("item_id", F.lit(0))), F.coalesce("parts", F.lit(1)))
    # as structs, for a list passes over nulls
    texts = materialize(items.join(F.broadcast(many), "text", "left").groupBy("text", part.alias("part"))
                        .agg(F.collect_list(F.struct("item_id")).alias("ids")), "benchmark-texts")
    chars = texts.agg(F.sum(F.length("text") + 8 * F.size("ids"))).first()[0] or 0
    blocks = 1 + chars // BLOCK_CHARS
    for k in range(blocks):
        block = texts.where(F.pmod(F.xxhash64("text", "part"), F.lit(blocks)) == k)
        yield ContainmentIndex([(r["text"], sorted((i["item_id"] for i in r["ids"]), key=lambda i: (i is None, i or 0)))
                                for r in block.collect()], threshold, short_items)


def contaminated_pairs(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD,
                       short_items: bool = False) -> DataFrame:
    """One row per document and contained item."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = None

    def as_batch(ids: pa.Array, best: dict[tuple, tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([ids[k[0]].as_py() for k in best], pa.int64()),
             pa.array([k[1] for k in best], pa.int64()),
             pa.array([v[1] for v in best.values()], pa.int32()),
             pa.array([v[2] for v in best.values()], pa.int32()),
             pa.array([v[0] for v in best.values()], pa.float64())],
            names=["doc_id", "item_id", "n_shingles", "n_shared", "containment"])

    for index in benchmark_blocks(benchmark, threshold, short_items):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                for piece in slices(batch):
                    ids = piece.column("doc_id")
                    best: dict[tuple, tuple] = {}
                    last = -1
                    for row, item, n in index.search(piece.column("text")):
                        if row != last and len(best) >= BATCH_PAIRS:
                            yield as_batch(ids, best)
                            best = {}
                        last, size = row, len(index.shingles[item])
                        for item_id in index.ids[item]:
                            key = (row, item_id)
                            best[key] = max(best.get(key, (0.0,)), (n / size, size, n))
                    if best:
                        yield as_batch(ids, best)

        block = rows.mapInArrow(search, PAIRS)
        found = block if found is None else found.unionByName(block)
    return found


def contained_items(text: Column, index) -> Column:
    """How many item texts of a (broadcast) index a text contains."""
    @F.arrow_udf("int")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            n, at = np.zeros(len(texts), np.int32), 0
            for piece in slices(pa.RecordBatch.from_arrays([texts], names=["text"])):
                for row, _, _ in index.value.search(piece.column("text")):
                    n[at + row] += 1
                at += piece.num_rows
            yield pa.array(n)
    return count(text)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD,
                      short_items: bool = False) -> DataFrame:
    """The rows of ``docs`` that contain no item, with all their columns."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    for index in benchmark_blocks(benchmark, threshold, short_items):
        shared = docs.sparkSession.sparkContext.broadcast(index)
        docs = (docs.select(row.alias("_row"), contained_items(F.col("text").cast("string"), shared).alias("_n"))
                .where("_n = 0").select("_row.*"))
    return docs
