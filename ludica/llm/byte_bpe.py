"""Operator 9: byte-level BPE encoding and decoding by a distinct-word shuffle.

Texts are cut into pre-tokens; each distinct pre-token of the whole input is
encoded once; the ids go back to where the pre-token stands. What moves:

1. Every task cuts its documents into blocks of about SLICE_BYTES of text and
   ranks the distinct pre-tokens of a block by frequency. They are dealt by
   pre-token: hashed to buckets, one compressed row per (block, bucket), so
   that equal ones of the whole input meet in one bucket and are encoded once
   there. A frequent pre-token is one entry per block, not per occurrence.
2. The ids go back to the blocks, a row per (block, bucket) again; from a
   second pass over the input every document goes there as the sequence of
   its pre-tokens' ranks. Sorted by block, the ids come first, and each
   document is put together by position.

The block's key is a hash of its texts (blocks of equal texts share their
ranks); should the input's rows change between the passes, the numbers of a
block are missing and the job fails rather than mix them up (write such an
input first).

Decoding looks the ids up in the table of token bytes, which has one row per
id of the vocabulary and is broadcast.

Defined cases: null text is empty, with no ids and empty bytes; text with any
characters is encoded whole, special-token strings as ordinary text; repeated
rows come back each; a null doc_id stays null; an empty table gives an empty
result; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ludica.llm.common import SLICE_BYTES, Coded, ragged, ragged_take, slices

WORDS = "block long, bucket int, ranks binary, sizes binary, data binary"
ROWS = "block long, bucket int, doc_id long, ranks binary, sizes binary, data binary"
#: Sorts after every bucket: the row is a document.
DOCUMENT = 2 ** 31 - 1
# Fixed value: the pattern that cuts text before the merges of the rank files.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
ENCODED = "doc_id long, n_tokens long, ids binary"


def load_ranks(path: str) -> list[bytes]:
    """The token bytes of a rank file, by id."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    ranks = {int(rank): base64.b64decode(token) for token, rank in pairs}
    return [ranks[i] for i in range(len(ranks))]


#: Texts that are matched whole: those with a NUL, or a space before other white space or at the end.
_ODD = r"\x00| (?:\z|[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}])"
#: PATTERN for pieces of text that a NUL ends; the NUL is a match of its own.
_PIECES = regex.compile(r"""\x00|'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}\x00]+|\s+(?![^\s\x00])|\s+""")


def pre_tokens(texts: pa.Array, pattern: regex.Pattern) -> tuple[Coded, np.ndarray]:
    """All pre-tokens of the texts, coded, and how often each distinct one occurs.

    No match of PATTERN reaches across a space that stands before a character
    that is no white space, so texts are cut there and each distinct piece is
    matched once, all of them in one go.
    """
    texts = pc.fill_null(texts.cast(pa.string()), "")
    odd = pc.match_substring_regex(texts, _ODD) if pattern.pattern == PATTERN else pa.array([True] * len(texts))
    lists = pc.split_pattern(texts.filter(pc.invert(odd)), " ")
    at = np.asarray(lists.offsets, dtype=np.int64)
    pieces = lists.flatten().dictionary_encode()
    codes = pieces.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    # a text's first piece has no space before it: numbered apart
    n = len(pieces.dictionary)
    heads = at[:-1] - at[0]
    first, codes[heads] = np.unique(codes[heads], return_inverse=True)
    codes[heads] += n
    shown = pieces.dictionary.to_pylist()
    joined = "".join([*(f" {p}\x00" for p in shown), *(f"{shown[k]}\x00" for k in first.tolist())])
    flat = pa.array(_PIECES.findall(joined), pa.string()).dictionary_encode()
    own = flat.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.flatnonzero(own == pc.index(flat.dictionary, "\x00").as_py()) if len(own) else own
    # per piece: its pre-tokens, the NUL left out
    bounds = np.concatenate([[0], ends + 1])
    values, offsets = ragged_take(np.delete(own, ends), bounds - np.arange(len(bounds)), codes)
    offsets = offsets[at - at[0]]
    words = flat.dictionary
    if pc.any(odd).as_py():
        whole = [pattern.findall(t) for t in texts.filter(odd).to_pylist()]
        both = pa.concat_arrays([words, pa.array([w for x in whole for w in x], pa.string())]).dictionary_encode()
        renumbered = both.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        values = np.concatenate([renumbered[:len(words)][values], renumbered[len(words):]])
        offsets = np.concatenate([offsets, offsets[-1] + np.cumsum([len(x) for x in whole])])
        # back to the order of the texts
        place = np.argsort(np.argsort(odd.to_numpy(zero_copy_only=False), kind="stable"), kind="stable")
        values, offsets = ragged_take(values, offsets, place)
        words = both.dictionary
    return Coded(words, values, offsets), np.bincount(values, minlength=len(words))


def _blocks(batches: Iterator[pa.RecordBatch], pattern: str) -> Iterator[tuple[int, pa.RecordBatch, Coded, np.ndarray]]:
    """(block key, rows, pre-tokens, rank of each distinct one by frequency, -1 if unused)."""
    compiled = regex.compile(pattern)
    for batch in batches:
        for piece in slices(batch):
            texts = piece.column("text")
            words, counts = pre_tokens(texts, compiled)
            key = xxhash.xxh64()
            for text in texts:
                key.update(text.as_buffer() or b"\0")
                key.update(b"\xff")
            rank = np.full(len(counts), -1, np.int64)
            used = np.argsort(-counts, kind="stable")[:np.count_nonzero(counts)]
            rank[used] = np.arange(len(used))
            yield key.intdigest() - (1 << 63), piece, words, rank


def _squeeze(numbers: np.ndarray, pack) -> bytes:
    """Numbers as their byte planes, compressed."""
    return pack(np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes())


def _unsqueeze(data: bytes, unpack) -> np.ndarray:
    planes = np.frombuffer(unpack(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").reshape(-1).astype(np.int64)


def _buckets(words: pa.Array, n: int) -> np.ndarray:
    """The bucket of each word, by a hash of its bytes."""
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(w) for w in words.cast(pa.binary()).to_pylist()), np.uint64, len(words)) % np.uint64(n)


def encode(docs: DataFrame, tokens: list[bytes], pattern: str) -> DataFrame:
    """doc_id, n_tokens and ids (little-endian unsigned 32-bit) of every document."""
    width = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n_buckets = 4 * width
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(tokens)

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3, write_checksum=False).compress
        for block, _, found, rank in _blocks(batches, pattern):
            bucket = _buckets(found.distinct, n_buckets).astype(np.int64)
            order = np.lexsort((rank, bucket))
            order = order[rank[order] >= 0]
            shown = found.distinct.cast(pa.binary()).take(pa.array(order)).to_pylist()
            own = bucket[order]
            cuts = [0, *(np.flatnonzero(np.diff(own)) + 1).tolist(), len(own)] if len(own) else [0]
            out = []
            for a, b in zip(cuts, cuts[1:]):
                part = shown[a:b]
                out.append((block, int(own[a]), _squeeze(np.diff(rank[order[a:b]], prepend=0), pack),
                            _squeeze(np.fromiter(map(len, part), np.int64, b - a), pack), pack(b"".join(part))))
            yield _batch(out, [("block", pa.int64()), ("bucket", pa.int32()), ("ranks", pa.binary()),
                               ("sizes", pa.binary()), ("data", pa.binary())])

    def ids_of_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        whole = tiktoken.Encoding("whole", pat_str=r"(?s).+", mergeable_ranks={t: i for i, t in enumerate(shared.value)},
                                  special_tokens={})
        pack = zstandard.ZstdCompressor(level=3, write_checksum=False).compress
        unpack = zstandard.ZstdDecompressor().decompress
        bucket, known = None, {}
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if row["bucket"] != bucket:
                    bucket, known = row["bucket"], {}
                data, ends = unpack(row["data"]), np.cumsum(_unsqueeze(row["sizes"], unpack)).tolist()
                ids = []
                for a, b in zip([0, *ends], ends):
                    word = data[a:b]
                    if (found := known.get(word)) is None:
                        found = known[word] = whole.encode_ordinary(word.decode())
                    ids.append(found)
                flat, offsets = ragged(ids, np.uint32)
                out.append((row["block"], bucket, None, row["ranks"], _squeeze(np.diff(offsets), pack), _squeeze(flat, pack)))
            yield _batch(out, _ROW_TYPES)

    def sequences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1, write_checksum=False).compress
        for block, piece, found, rank in _blocks(batches, pattern):
            own = rank[found.codes]
            yield _batch([(block, DOCUMENT, doc_id, None, None, _squeeze(own[a:b], pack)) for doc_id, a, b in
                          zip(piece.column("doc_id").to_pylist(), found.offsets, found.offsets[1:])], _ROW_TYPES)

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        block, have, table = None, [], None
        for batch in batches:
            out, n = [], 0
            for k in range(batch.num_rows):
                # a row at a time: a batch of long documents is not held twice
                row = {name: column[k].as_py() for name, column in zip(batch.schema.names, batch.columns)}
                if row["block"] != block:
                    block, have, table = row["block"], [], None
                if row["bucket"] != DOCUMENT:
                    have.append((np.cumsum(_unsqueeze(row["ranks"], unpack)), _unsqueeze(row["sizes"], unpack),
                                 _unsqueeze(row["data"], unpack).astype(np.uint32)))
                    continue
                if table is None:
                    table, have = _id_table(have), []
                ranks = _unsqueeze(row["data"], unpack)
                if len(ranks) and ranks.max() >= len(table[1]) - 1:
                    raise RuntimeError(CHANGED)
                out.append((row["doc_id"], ragged_take(*table, ranks)[0].tobytes()))
                n += len(out[-1][1])
                if n > SLICE_BYTES:
                    yield _encoded(out)
                    out, n = [], 0
            if out:
                yield _encoded(out)

    ids = (rows.mapInArrow(words, WORDS).repartition(width, "bucket").sortWithinPartitions("bucket")
           .mapInArrow(ids_of_words, ROWS))
    return (ids.unionAll(rows.mapInArrow(sequences, ROWS)).repartition(width, "block")
            .sortWithinPartitions("block", "bucket").mapInArrow(assemble, ENCODED))


CHANGED = "the input changed between two passes; write it to a table first"
_ROW_TYPES = [("block", pa.int64()), ("bucket", pa.int32()), ("doc_id", pa.int64()), ("ranks", pa.binary()),
              ("sizes", pa.binary()), ("data", pa.binary())]


def _batch(rows: list[tuple], types: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[]] * len(types)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, types)], names=[n for n, _ in types])


def _encoded(rows: list[tuple[int | None, bytes]]) -> pa.RecordBatch:
    return _batch([(i, len(ids) // 4, ids) for i, ids in rows],
                  [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])


def _id_table(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, np.ndarray]:
    """The ids of a block's pre-tokens by rank, as flat array and offsets,
    from (ranks, sizes, ids) of its buckets."""
    none = np.zeros(0, np.int64)
    ranks, sizes, ids = (np.concatenate(x) for x in zip(*parts)) if parts else (none, none, none.astype(np.uint32))
    ranks, first = np.unique(ranks, return_index=True)
    if not (ranks == np.arange(len(ranks))).all():
        raise RuntimeError(CHANGED)
    return ragged_take(ids, np.concatenate([[0], np.cumsum(sizes)]), first)


class ByteTable:
    """A byte string per id, for looking up many ids at once."""

    def __init__(self, strings: list[bytes]):
        self.flat = np.frombuffer(b"".join(strings), np.uint8)
        self.offsets = np.concatenate([[0], np.cumsum([len(s) for s in strings])])

    def join(self, ids: bytes, step: int = 1 << 17) -> Iterator[bytes]:
        """The strings of ids one after the other, ``step`` ids at a time."""
        numbers = np.frombuffer(ids, "<u4")
        for at in range(0, len(numbers), step):
            yield ragged_take(self.flat, self.offsets, numbers[at:at + step].astype(np.int64))[0].tobytes()


def decode(encoded: DataFrame, tokens: list[bytes]) -> DataFrame:
    """``encoded`` (doc_id, n_tokens, ids) with the decoded ``bytes``."""
    shared = encoded.sparkSession.sparkContext.broadcast(tokens)

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ByteTable(shared.value)
        for batch in batches:
            for piece in slices(batch, "ids"):
                data = [b"".join(table.join(i)) for i in piece.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays([*piece.columns, pa.array(data, pa.binary())],
                                                 names=["doc_id", "n_tokens", "ids", "bytes"])
    return encoded.select("doc_id", "n_tokens", "ids").mapInArrow(look_up, ENCODED + ", bytes binary")


def digests(encoded: DataFrame, tokens: list[bytes]) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (of the decimal ids joined by commas) and
    decoded_sha256 (of the decoded bytes) of ``encoded``, a part at a time."""
    shared = encoded.sparkSession.sparkContext.broadcast(tokens)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decimal, table = ByteTable([b"%d," % i for i in range(len(shared.value))]), ByteTable(shared.value)
        for batch in batches:
            shown, decoded = [], []
            for value in batch.column("ids"):
                ids = value.as_py()
                h, held = hashlib.sha256(), b""
                for part in decimal.join(ids):
                    h.update(held)
                    held = part
                h.update(held[:-1])
                shown.append(h.hexdigest())
                h = hashlib.sha256()
                for part in table.join(ids):
                    h.update(part)
                decoded.append(h.hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_tokens"), pa.array(shown, pa.string()), pa.array(decoded, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return encoded.select("doc_id", "n_tokens", "ids").mapInArrow(
        digest, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
