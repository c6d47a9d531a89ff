"""Ranked lexical search (operator 12): a length-stratified index, visited in the order of its bounds.

A document's score depends on its length only through the normaliser m, so the
index groups documents of equal m (a stratum). Within a stratum a term's
postings lie by falling tf, and what a posting adds to a score is the term's
weight times an impact that is one number for each tf, worked out once. A
stratum of many documents is cut into blocks that fit a task; a block's bound
for an item, the sum of weight times the impact of the block's highest tf of
each term, is never less than the score of any of its documents.

``build_index`` writes three things: a row of term counts for each document
(a pass over the texts), N and L from it, then the blocks, dealt and sorted by
(m, a number of the row), so that a stratum that holds a third of all
documents is spread over many tasks. ``search`` visits, for every item, the
blocks of highest bound that together hold k documents, takes the k-th best
score found as a threshold and then passes over all blocks, within a task by
falling bound, leaving out the items whose bound lies below their threshold.
Tasks hand on their k best documents of each item. Thresholds only ever leave
out documents that k others beat, so the result is exact.

The items' terms and weights go to the tasks in blocks of at most ITEM_PAIRS
pairs (a single item is not split); the index holds the terms of all items
where these are at most MAX_TERMS, else all terms.

Defined cases:

* null and empty texts and texts without a term: no term, in no count and no rank,
* null doc_ids are ranked after equal scores and keep their null; rows that
  share a doc_id are documents of their own,
* rows of one item_id (null is one, too) are one item with the terms of all of them,
* items without a term that some document holds: no row,
* other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ludica.llm.common import Coded, coded_words, materialize, ragged_take, slices

#: Documents and postings of a block at most (a longer document is a block of its own).
BLOCK_DOCS, BLOCK_POSTINGS = 2048, 1 << 19
#: (item, term) pairs that are sent to the tasks at a time.
ITEM_PAIRS = 1 << 20
#: Distinct terms of the items up to which only these are indexed.
MAX_TERMS = 1 << 20
#: Products that are added up at a time.
STEP = 1 << 20
#: Bytes to term bytes: digits, letters (A-Z lower-cased) and all of non-ASCII characters; others separate.
_TERM_BYTES = np.array([b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
                        for b in range(256)], np.uint8)


class Index(NamedTuple):
    """blocks: block, m, doc_ids, terms, dfs and the postings as packed arrays."""

    blocks: DataFrame
    n_docs: int
    n_terms: int


class _Items(NamedTuple):
    """A block of items. terms[t] counts for items[offsets[t]:offsets[t + 1]] with as many weights."""

    ids: list
    terms: pa.Array
    offsets: np.ndarray
    items: np.ndarray
    weights: np.ndarray


def top_documents(docs: DataFrame, items: DataFrame, k: int = 50) -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents of every item."""
    pairs = materialize(item_terms(items), "search-items")
    vocabulary = pairs.select("term").distinct()
    few = vocabulary.limit(MAX_TERMS + 1).count() <= MAX_TERMS
    index = build_index(docs, [r["term"] for r in vocabulary.collect()] if few else None)
    return search(index, pairs, k)


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, term), each once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                found = terms_of(part.column("text"))
                owners = np.repeat(np.arange(part.num_rows), np.diff(found.offsets))
                pairs = np.unique(owners * max(1, len(found.distinct)) + found.codes)
                owners, codes = np.divmod(pairs, max(1, len(found.distinct)))
                yield pa.record_batch([part.column("item_id").take(pa.array(owners)), found.distinct.take(pa.array(codes))],
                                      ["item_id", "term"])
    kind = items.schema["item_id"].dataType.simpleString()
    return items.select("item_id", "text").mapInArrow(run, f"item_id {kind}, term string").distinct()


def terms_of(texts: pa.Array) -> Coded:
    """The terms of each text, repeats included: its bytes are mapped one by one, then split at spaces."""
    texts = pc.fill_null(texts.cast(pa.string()), "")
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int32)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int32)
    own = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    mapped = pa.StringArray.from_buffers(len(texts), pa.py_buffer(offsets - offsets[0]), pa.py_buffer(_TERM_BYTES[own]))
    return coded_words(mapped)


# --- the index ----------------------------------------------------------------------------

def build_index(docs: DataFrame, vocabulary: list[str] | None = None) -> Index:
    """The index of all documents over ``vocabulary`` (None: all terms). N, L and
    lengths count all terms in any case."""
    counted = materialize(_counted(docs, vocabulary), "search-counts")
    total = counted.agg(F.count("*").alias("docs"), F.sum("n").alias("terms")).collect()[0]
    n_docs, n_terms = total["docs"], total["terms"] or 0
    m = F.expr(f"50 + (cast(n AS decimal(19,0)) * {50 * n_docs}) div {max(1, n_terms)}")
    blocks = (counted.filter("terms <> ''").select(m.alias("m"), "doc_id", "at", "terms", "tfs")
              .repartitionByRange("m", "at").sortWithinPartitions("m")
              .mapInArrow(_blocks, f"block long, m long, doc_ids array<{docs.schema['doc_id'].dataType.simpleString()}>, "
                                   "terms array<string>, dfs array<long>, run_terms binary, run_tfs binary, "
                                   "run_ends binary, postings binary"))
    return Index(materialize(blocks, "search-index"), n_docs, n_terms)


def _counted(docs: DataFrame, vocabulary: list[str] | None) -> DataFrame:
    """A row for each document with a term: its length, its indexed terms (joined
    by spaces) and their tf. at: a number that tells rows of equal length apart."""
    wanted = None if vocabulary is None else pa.array(vocabulary, pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = 0
        for batch in batches:
            for part in slices(batch):
                found = terms_of(part.column("text"))
                lengths = np.diff(found.offsets)
                owners = np.repeat(np.arange(part.num_rows), lengths)
                width = max(1, len(found.distinct))
                keys = owners * width + found.codes
                if wanted is not None:
                    keys = keys[pc.is_in(found.distinct, value_set=wanted).to_numpy(zero_copy_only=False)[found.codes]]
                keys, tfs = np.unique(keys, return_counts=True)
                owners, codes = np.divmod(keys, width)
                ends = np.searchsorted(owners, np.arange(part.num_rows + 1)).astype(np.int32)
                terms = pa.ListArray.from_arrays(pa.array(ends), found.distinct.take(pa.array(codes)))
                packed = pa.BinaryArray.from_buffers(pa.binary(), part.num_rows,
                                                     [None, pa.py_buffer(ends * 4), pa.py_buffer(tfs.astype(np.uint32))])
                numbers = (np.arange(seen, seen + part.num_rows, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
                seen += part.num_rows
                yield pa.record_batch([part.column("doc_id"), pa.array(lengths), pa.array(numbers.astype(np.int64)),
                                       pc.binary_join(terms, " "), packed],
                                      ["doc_id", "n", "at", "terms", "tfs"]).filter(pa.array(lengths > 0))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n long, at long, terms string, tfs binary")


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows, sorted by m, as blocks of one m each."""
    first, made = TaskContext.get().partitionId() << 33, 0
    for rows in _runs(batches):
        yield _block(first + made, rows)
        made += 1


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows of one m each, within the bounds of a block."""
    held: list[pa.RecordBatch] = []
    docs = postings = 0
    for batch in batches:
        m = batch.column("m").to_numpy()
        sizes = pc.binary_length(batch.column("tfs")).to_numpy() // 4
        at = 0
        while at < batch.num_rows:
            if held and (m[at] != held[-1].column("m")[0].as_py() or docs >= BLOCK_DOCS or postings + sizes[at] > BLOCK_POSTINGS):
                yield pa.Table.from_batches(held)
                held, docs, postings = [], 0, 0
            same = int(np.searchsorted(m, m[at], "right")) - at
            room = int(np.searchsorted(np.cumsum(sizes[at:at + same]), BLOCK_POSTINGS - postings, "right"))
            take = max(1, min(same, room, BLOCK_DOCS - docs))
            held.append(batch.slice(at, take))
            docs, postings, at = docs + take, postings + int(sizes[at:at + take].sum()), at + take
    if held:
        yield pa.Table.from_batches(held)


def _block(number: int, rows: pa.Table) -> pa.RecordBatch:
    """One block: postings by term, then falling tf, then document; a run is a term's documents of one tf."""
    found = coded_words(rows.column("terms").combine_chunks())
    tfs = np.frombuffer(b"".join(rows.column("tfs").to_pylist()), np.uint32).astype(np.int64)
    owners = np.repeat(np.arange(rows.num_rows), np.diff(found.offsets))
    order = np.lexsort((owners, -tfs, found.codes))
    codes, tfs, owners = found.codes[order], tfs[order], owners[order]
    starts = np.flatnonzero(np.r_[True, (codes[1:] != codes[:-1]) | (tfs[1:] != tfs[:-1])])

    def packed(values: np.ndarray, kind: type) -> pa.Array:
        return pa.array([values.astype(kind).tobytes()], pa.binary())

    doc_ids = rows.column("doc_id").combine_chunks()
    return pa.record_batch([
        pa.array([number]), rows.column("m").combine_chunks()[:1], pa.ListArray.from_arrays([0, len(doc_ids)], doc_ids),
        pa.ListArray.from_arrays([0, len(found.distinct)], found.distinct),
        pa.ListArray.from_arrays([0, len(found.distinct)], pa.array(np.bincount(codes, minlength=len(found.distinct)))),
        packed(codes[starts], np.int32), packed(tfs[starts], np.int64), packed(np.r_[starts[1:], len(codes)], np.int32),
        packed(owners, np.int16)],
        ["block", "m", "doc_ids", "terms", "dfs", "run_terms", "run_tfs", "run_ends", "postings"])


# --- the search ---------------------------------------------------------------------------

def search(index: Index, pairs: DataFrame, k: int = 50) -> DataFrame:
    """The k best documents of each item of ``pairs`` (``item_terms``): item_id, rank, doc_id, score."""
    weighted = materialize(_weighted(index, pairs), "search-weights")
    parts = max(1, -(-weighted.count() // ITEM_PAIRS))
    found = [_search_part(index, weighted.filter(F.pmod(F.xxhash64("item_id"), F.lit(parts)) == part), k) for part in range(parts)]
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def _weighted(index: Index, pairs: DataFrame) -> DataFrame:
    """(item_id, term, weight) for the terms that documents hold."""
    dfs = (index.blocks.select(F.explode(F.arrays_zip("terms", "dfs")).alias("p"))
           .groupBy(F.col("p.terms").alias("term")).agg(F.sum("p.dfs").alias("df")))
    weight = F.floor(1000 * F.ln(F.lit(2.0 * index.n_docs + 2) / (2 * F.col("df") + 1).cast("double")))
    return pairs.join(dfs, "term").select("item_id", "term", weight.cast("long").alias("weight")).filter("weight > 0")


def _search_part(index: Index, weighted: DataFrame, k: int) -> DataFrame:
    spark = weighted.sparkSession
    items = _collected(weighted)
    id_kind = index.blocks.schema["doc_ids"].dataType.elementType.simpleString()
    ids = spark.createDataFrame(list(enumerate(items.ids)), f"item int, item_id {weighted.schema['item_id'].dataType.simpleString()}")

    def best(blocks: DataFrame, floor: dict[int, int]) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            yield from _visited(batches, items, floor, k)
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        return (blocks.mapInArrow(run, f"item int, doc_id {id_kind}, score long")
                .withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k))

    leads = _leads(index, items, k)
    blocks = index.blocks.join(F.broadcast(leads), "block", "left_semi")
    floor = {r["item"]: r["score"] for r in best(blocks, {}).filter(F.col("rank") == k).collect()}
    return best(index.blocks, floor).join(F.broadcast(ids), "item").select("item_id", "rank", "doc_id", "score")


def _collected(weighted: DataFrame) -> _Items:
    """The rows (at most ITEM_PAIRS, or one item's) as arrays by term."""
    rows = weighted.orderBy("term").toArrow().combine_chunks()
    item_codes = rows.column("item_id").combine_chunks().dictionary_encode(null_encoding="encode")
    terms = rows.column("term").combine_chunks().dictionary_encode()
    codes = terms.indices.to_numpy()
    order = np.argsort(codes, kind="stable")
    return _Items(item_codes.dictionary.to_pylist(), terms.dictionary.cast(pa.string()),
                  np.r_[0, np.cumsum(np.bincount(codes, minlength=len(terms.dictionary)))].astype(np.int64),
                  item_codes.indices.to_numpy()[order].astype(np.int64), rows.column("weight").to_numpy()[order])


def _leads(index: Index, items: _Items, k: int) -> DataFrame:
    """block: those of each item's highest bounds that together hold k documents, so at most k an item."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        item, bound, block, docs = (np.zeros(0, np.int64) for _ in range(4))
        for batch in batches:
            if not batch.num_rows:
                continue
            opened = _opened(batch, items)
            bounds = np.stack([o.bounds for o in opened])
            at, which = np.nonzero(bounds)
            item, bound = np.r_[item, which], np.r_[bound, bounds[at, which]]
            block = np.r_[block, np.array([o.block for o in opened])[at]]
            docs = np.r_[docs, np.array([len(o.doc_ids) for o in opened])[at]]
            order = np.lexsort((block, -bound, item))
            item, bound, block, docs = item[order], bound[order], block[order], docs[order]
            before = np.cumsum(docs) - docs
            before -= before[np.searchsorted(item, item)]
            kept = before < k
            item, bound, block, docs = item[kept], bound[kept], block[kept], docs[kept]
        yield pa.record_batch([pa.array(item), pa.array(bound), pa.array(block), pa.array(docs)], ["item", "bound", "block", "docs"])
    before = Window.partitionBy("item").orderBy(F.desc("bound"), "block").rowsBetween(Window.unboundedPreceding, -1)
    return (index.blocks.mapInArrow(run, "item long, bound long, block long, docs long")
            .withColumn("before", F.coalesce(F.sum("docs").over(before), F.lit(0))).filter(F.col("before") < k)
            .select("block").distinct())


class _Opened(NamedTuple):
    """A block's runs whose terms some item holds (term: into the items' terms)."""

    block: int
    doc_ids: pa.Array
    term: np.ndarray
    impact: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    postings: np.ndarray
    bounds: np.ndarray


def _opened(batch: pa.RecordBatch, items: _Items) -> list[_Opened]:
    terms = batch.column("terms")
    known = pc.fill_null(pc.index_in(terms.flatten(), value_set=items.terms), -1).to_numpy().astype(np.int64)
    offsets = np.asarray(terms.offsets, dtype=np.int64) - terms.offsets[0].as_py()
    out = []
    for i, m in enumerate(batch.column("m").to_pylist()):
        codes, tfs, ends, postings = (np.frombuffer(batch.column(c)[i].as_py(), kind) for c, kind in (
            ("run_terms", np.int32), ("run_tfs", np.int64), ("run_ends", np.int32), ("postings", np.int16)))
        term = known[offsets[i]:offsets[i + 1]][codes]
        kept = term >= 0
        distinct, at = np.unique(tfs[kept], return_inverse=True)
        impact = ((1_000_000_000 * distinct) // (1000 * distinct + 20 * m))[at]
        starts = np.r_[0, ends[:-1]][kept].astype(np.int64)
        term, ends, codes = term[kept], ends[kept].astype(np.int64), codes[kept]
        highest = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]])[:len(codes)]  # a term's first run
        bounds = np.zeros(len(items.ids), np.int64)
        whose, stops = ragged_take(items.items, items.offsets, term[highest])
        weights, _ = ragged_take(items.weights, items.offsets, term[highest])
        np.add.at(bounds, whose, weights * np.repeat(impact[highest], np.diff(stops)))
        out.append(_Opened(batch.column("block")[i].as_py(), batch.column("doc_ids")[i].values, term, impact, starts, ends, postings,
                           bounds))
    return out


def _visited(batches: Iterator[pa.RecordBatch], items: _Items, floor: dict[int, int], k: int) -> Iterator[pa.RecordBatch]:
    """The task's k best documents of each item: blocks by falling bound, of each the items whose bound can still matter."""
    best = _Best(len(items.ids), floor, k)
    for batch in batches:
        for block in sorted(_opened(batch, items), key=lambda b: -b.bounds.max(initial=0)):
            alive = np.flatnonzero(block.bounds >= best.least)
            if len(alive):
                for part in np.array_split(alive, -(-len(alive) // 512)):
                    best.add(part, _scores(block, items, part), block.doc_ids)
    yield from best.rows()


def _scores(block: _Opened, items: _Items, alive: np.ndarray) -> np.ndarray:
    """Scores (items of ``alive`` x documents of the block)."""
    place = np.full(len(items.ids), -1)
    place[alive] = np.arange(len(alive))
    here = place[items.items]
    offsets = np.r_[0, np.cumsum(here >= 0)][items.offsets]
    weights, here = items.weights[here >= 0], here[here >= 0]
    docs = len(block.doc_ids)
    sizes = block.ends - block.starts
    products = sizes * np.diff(offsets)[block.term]
    scores = np.zeros(len(alive) * docs, np.int64)
    cuts = np.searchsorted(np.cumsum(products), np.arange(STEP, products.sum() + STEP, STEP))
    for first, last in zip(np.r_[0, cuts], np.r_[cuts, len(products)], strict=True):
        runs = np.flatnonzero(products[first:last]) + first
        if not len(runs):
            continue
        whose, stops = ragged_take(here, offsets, block.term[runs])
        value, _ = ragged_take(weights, offsets, block.term[runs])
        value = value * np.repeat(block.impact[runs], np.diff(stops))
        run = np.repeat(np.arange(len(runs)), np.diff(stops))  # a product's run: its documents follow
        many = sizes[runs][run]
        ends = np.cumsum(many)
        at = np.arange(ends[-1]) + np.repeat(block.starts[runs][run] - (ends - many), many)
        np.add.at(scores, block.postings[at] + np.repeat(whose * docs, many), np.repeat(value, many))
    return scores.reshape(len(alive), docs)


class _Best:
    """The k best (score, doc_id) of each item so far. floor: item to a
    score that k documents are known to reach."""

    def __init__(self, n_items: int, floor: dict[int, int], k: int):
        self.k = k
        self.least = np.ones(n_items, np.int64)
        for item, score in floor.items():
            self.least[item] = score
        self.item, self.score = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids: list[pa.Array] = []
        self.held = 0

    def add(self, alive: np.ndarray, scores: np.ndarray, doc_ids: pa.Array) -> None:
        row, col = np.nonzero(scores >= self.least[alive][:, None])
        self.item = np.r_[self.item, alive[row]]
        self.score = np.r_[self.score, scores[row, col]]
        self.ids.append(doc_ids.take(pa.array(col)))
        if len(self.item) - self.held > 1 << 14:
            self._cut()

    def _cut(self) -> None:
        ids = pa.concat_arrays(self.ids)
        # places in ascending order of doc_id, nulls last; equal ids share one
        place = pc.rank(ids, sort_keys="ascending", null_placement="at_end", tiebreaker="dense").to_numpy()
        order = np.lexsort((place, -self.score, self.item))
        item = self.item[order]
        kept = np.arange(len(item)) - np.searchsorted(item, item) < self.k
        order = order[kept]
        self.item, self.score, self.ids = self.item[order], self.score[order], [ids.take(pa.array(order))]
        self.held = len(order)
        last = np.flatnonzero(np.r_[self.item[1:] != self.item[:-1], True])
        full = last[last - np.searchsorted(self.item, self.item[last]) == self.k - 1]
        self.least[self.item[full]] = np.maximum(self.least[self.item[full]], self.score[full])

    def rows(self) -> Iterator[pa.RecordBatch]:
        if self.ids:
            self._cut()
            yield pa.record_batch([pa.array(self.item.astype(np.int32)), self.ids[0], pa.array(self.score)],
                                  ["item", "doc_id", "score"])
