"""Operator 1: token ids as fixed-width bit-packed shard files.

Every id takes the minimum number of bits of the vocabulary. Ids are packed
in groups of 64 (``bits`` 64-bit words each), so packing and unpacking are a
fixed number of numpy operations per block, and a block table makes any id
range readable without the rest of the file.

One shard file, all integers little-endian::

    8s  magic            b"LUDTOK1\\0"
    I   bits             width of an id
    I   block_ids        ids per block (a multiple of 64)
    Q   n_ids, Q n_docs
    q*n_docs  doc_id     (0 where null)
    B*n_docs  has_id     0 where doc_id is null
    Q*n_docs  doc_end    ids up to the end of each document
    Q*n_blocks  block_at byte position of each block in the file
    payload              blocks, the last one padded to a multiple of 64 ids

Files are written to the shared folder by the tasks that hold a range of
document ids (temporary name, then renamed; a repeated task writes the same
bytes under the same name), and a Parquet manifest lists them in order.

Defined cases: null text is an empty document (only the end id); null
doc_ids come first; rows with equal doc_id keep their input order; an empty
table gives an empty manifest and no files; columns other than doc_id and
text are ignored.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ludica.llm.common import coded_words, ragged, ragged_take, slices
from ludica.session import scratch_path

MAGIC = b"LUDTOK1\0"
HEADER = struct.Struct("<8sIIQQ")
BLOCK_IDS = 4096
#: A file is closed once it has this many ids (a longer document stays whole).
FILE_IDS = 1 << 22
#: Distinct chunks whose ids a worker keeps before it starts over.
CACHE_CHUNKS = 600_000
MANIFEST = "shard long, part int, path string, n_docs long, n_ids long"


def bits_for(vocabulary: int) -> int:
    """The fewest bits that hold ids 0 .. vocabulary - 1."""
    return max(1, int(vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids (uint32) in ``bits`` bits each, padded with zeros to 64 ids."""
    lanes = np.zeros((-(-len(ids) // 64), 64), dtype=np.uint64)
    lanes.reshape(-1)[:len(ids)] = ids
    lanes = np.ascontiguousarray(lanes.T)
    out = np.zeros((bits, lanes.shape[1]), dtype=np.uint64)
    for k in range(64):
        word, shift = divmod(k * bits, 64)
        out[word] |= lanes[k] << np.uint64(shift)
        if shift + bits > 64:
            out[word + 1] |= lanes[k] >> np.uint64(64 - shift)
    return np.ascontiguousarray(out.T).astype("<u8").tobytes()


def unpack(data: bytes, bits: int, n: int) -> np.ndarray:
    """The first ``n`` ids (uint32) of what ``pack`` made."""
    words = np.ascontiguousarray(np.frombuffer(data, dtype="<u8").reshape(-1, bits).T)
    lanes = np.empty((64, words.shape[1]), dtype=np.uint32)
    mask = np.uint64((1 << bits) - 1)
    for k in range(64):
        word, shift = divmod(k * bits, 64)
        value = words[word] >> np.uint64(shift)
        if shift + bits > 64:
            value = value | (words[word + 1] << np.uint64(64 - shift))
        lanes[k] = (value & mask).astype(np.uint32)
    return np.ascontiguousarray(lanes.T).reshape(-1)[:n]


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """The Arrow filesystem of a folder named by URI or plain path."""
    if "://" in uri or uri.startswith("file:"):
        return pafs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))
    return pafs.LocalFileSystem(), os.path.abspath(uri)


def write_file(uri: str, bits: int, docs: list[tuple[int | None, np.ndarray]],
               block_ids: int = BLOCK_IDS) -> int:
    """One shard file of (doc_id, ids) in the given order; returns its ids."""
    ends = np.cumsum([len(i) for _, i in docs], dtype=np.uint64)
    ids = np.concatenate([i for _, i in docs]) if docs else np.zeros(0, np.uint32)
    n_blocks = -(-len(ids) // block_ids)
    base = HEADER.size + 17 * len(docs) + 8 * n_blocks
    stride = block_ids // 64 * bits * 8
    fs, path = filesystem(uri)
    attempt = getattr(TaskContext.get(), "taskAttemptId", lambda: 0)()
    temporary = f"{path}.{attempt}.tmp"
    with fs.open_output_stream(temporary) as f:
        f.write(HEADER.pack(MAGIC, bits, block_ids, len(ids), len(docs)))
        f.write(np.array([d or 0 for d, _ in docs], dtype="<i8").tobytes())
        f.write(np.array([d is not None for d, _ in docs], dtype=np.uint8).tobytes())
        f.write(ends.astype("<u8").tobytes())
        f.write((base + stride * np.arange(n_blocks)).astype("<u8").tobytes())
        for at in range(0, len(ids), 64 * block_ids):
            f.write(pack(ids[at:at + 64 * block_ids], bits))
    if fs.get_file_info(path).type != pafs.FileType.NotFound:
        fs.delete_file(path)
    fs.move(temporary, path)
    return len(ids)


class TokenFile:
    """Random access to one shard file: only the blocks asked for are read."""

    def __init__(self, uri: str):
        fs, path = filesystem(uri)
        self._file = fs.open_input_file(path)
        magic, self.bits, self.block_ids, self.n_ids, n_docs = HEADER.unpack(
            self._file.read_at(HEADER.size, 0))
        if magic != MAGIC:
            raise ValueError(f"{uri} is no token file")
        at = HEADER.size
        ids = np.frombuffer(self._file.read_at(8 * n_docs, at), "<i8")
        has = np.frombuffer(self._file.read_at(n_docs, at + 8 * n_docs), np.uint8)
        self.doc_ids = [int(i) if h else None for i, h in zip(ids, has)]
        self.ends = np.frombuffer(self._file.read_at(8 * n_docs, at + 9 * n_docs), "<u8").astype(np.int64)
        n_blocks = -(-self.n_ids // self.block_ids)
        self.blocks = np.frombuffer(self._file.read_at(8 * n_blocks, at + 17 * n_docs), "<u8")

    def __enter__(self):
        return self

    def __exit__(self, *_):
        self._file.close()

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids start .. stop - 1 of the file."""
        stop = min(stop, self.n_ids)
        if start >= stop:
            return np.zeros(0, np.uint32)
        first, last = start // self.block_ids, (stop - 1) // self.block_ids
        stored = min((last + 1) * self.block_ids, -(-self.n_ids // 64) * 64) - first * self.block_ids
        data = self._file.read_at(stored // 64 * self.bits * 8, int(self.blocks[first]))
        return unpack(data, self.bits, stored)[start - first * self.block_ids:stop - first * self.block_ids]

    def document(self, k: int) -> np.ndarray:
        return self.ids(int(self.ends[k - 1]) if k else 0, int(self.ends[k]))

    def digests(self, window: int = 256 * BLOCK_IDS) -> Iterator[tuple[int | None, int, int, int]]:
        """(doc_id, start, n, crc32 of the ids as uint32) in file order,
        reading ``window`` ids at a time, whatever a document's length."""
        lo, held, begin = 0, np.zeros(0, np.uint32), 0
        for doc_id, end in zip(self.doc_ids, self.ends.tolist()):
            crc, at = 0, begin
            while at < end:
                if at >= lo + len(held):
                    lo, held = at, self.ids(at, at + window)
                piece = held[at - lo:end - lo]
                crc = zlib.crc32(piece.astype("<u4").tobytes(), crc)
                at += len(piece)
            yield doc_id, begin, end - begin, crc
            begin = end


def write_tokens(docs: DataFrame, make_encoder: Callable[[], Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]],
                 vocabulary: int, end_id: int, folder: str) -> DataFrame:
    """Write ``docs`` (doc_id, text) as shard files in ascending doc_id order.

    ``make_encoder`` runs in the task and gives texts -> (ids, offsets). Returns
    the manifest (also written to ``folder``/manifest), one row per file.
    """
    bits = bits_for(vocabulary)
    order = [F.col("doc_id").asc_nulls_first(), F.col("_row")]
    dealt = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
             .withColumn("_row", F.monotonically_increasing_id())
             .repartitionByRange(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), *order)
             .sortWithinPartitions(*order))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, part, held, n_held, rows = TaskContext.get().partitionId(), 0, [], 0, []
        encode, end = None, np.uint32(end_id)

        def flush():
            nonlocal part, held, n_held
            path = f"{folder}/shard-{shard:06d}-{part:05d}.ltok"
            rows.append((shard, part, path, len(held), write_file(path, bits, held)))
            part, held, n_held = part + 1, [], 0

        for batch in batches:
            encode = encode or make_encoder()
            for piece in slices(batch):
                ids, offsets = encode(piece.column("text"))
                for k, doc_id in enumerate(piece.column("doc_id").to_pylist()):
                    held.append((doc_id, np.append(ids[offsets[k]:offsets[k + 1]], end)))
                    n_held += len(held[-1][1])
                    if n_held >= FILE_IDS:
                        flush()
        if held:
            flush()
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.int64()))],
                names=["shard", "part", "path", "n_docs", "n_ids"])

    fs, path = filesystem(folder)
    fs.create_dir(path, recursive=True)
    dealt.mapInArrow(write, MANIFEST).write.parquet(f"{folder}/manifest")
    return docs.sparkSession.read.parquet(f"{folder}/manifest")


def read_digests(manifest: DataFrame) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32.

    ``start`` adds the ids of all files before (a running sum over the
    manifest, one row per file) to the position within the file.
    """
    before = Window.orderBy("shard", "part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = manifest.select("shard", "part", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("before"), "path")
    width = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, before in zip(batch.column("path").to_pylist(), batch.column("before").to_pylist()):
                with TokenFile(path) as f:
                    rows = list(f.digests())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in rows], pa.int64()), pa.array([before + r[1] for r in rows], pa.int64()),
                     pa.array([r[2] for r in rows], pa.int64()), pa.array([r[3] for r in rows], pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return offsets.repartition(width, "path").mapInArrow(
        read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _byte_alphabet() -> dict[int, str]:
    """Byte-level BPE's printable stand-in for each byte: itself if printable
    in Latin-1, else the next free character from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(0x100 + k) for k, b in enumerate(hidden)}


class WordBpe:
    """texts -> ids by the tokenizers library, each distinct chunk encoded once.

    The tokenizer maps white space to a separator that no pre-token contains,
    so a text's ids are the ids of its white-space separated chunks one after
    the other. A chunk whose characters normalise one by one (ASCII and
    Latin-1 letters) is split by the tokenizer's own pattern and its parts go
    straight to the library's BPE model; any other chunk takes the library's
    full path. With ``added_tokens``, a text that holds an added token's string
    (as it is, before any lower-casing) goes whole through the library with its
    default settings, which give that token's id; without, such strings count
    as ordinary text.
    """

    #: A stop after a letter, at a chunk's end, is a pre-token of its own.
    _STOP = (r"([a-z])([.,;:!?])(\s|$)", r"\1 \2\3")
    _plain = re.compile("[\x21-\x7e\xc0-\xd6\xd8-\xf6\xf8-\xff]+").fullmatch
    _split = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\xdf-\xf6\xf8-\xff]+|[0-9]"
                        "|[^a-z0-9\xdf-\xf6\xf8-\xff]+").findall

    def __init__(self, tokenizer_json: str, added_tokens: bool = False):
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_str(tokenizer_json)
        self._added = [t.content for t in self._tokenizer.get_added_tokens_decoder().values()] if added_tokens else []
        # a chunk is lower-cased already, which must not make an added token of it
        self._tokenizer.encode_special_tokens = True
        self._tokenize = self._tokenizer.model.tokenize
        self._alphabet = _byte_alphabet()
        self._parts: dict[str, list[int]] = {}
        self._chunks: dict[str, list[int]] = {}

    def _part(self, part: str) -> list[int]:
        ids = self._parts.get(part)
        if ids is None:
            shown = part if part.isascii() else "".join(map(self._alphabet.__getitem__, part.encode()))
            ids = self._parts[part] = [t.id for t in self._tokenize(shown)]
        return ids

    def _chunk(self, chunk: str) -> list[int]:
        if self._plain(chunk):
            parts = self._split(chunk.lower())
            ids = self._part(parts[0]) if len(parts) == 1 else [i for p in parts for i in self._part(p)]
        else:
            ids = self._tokenizer.encode(chunk, add_special_tokens=False).ids
        self._chunks[chunk] = ids
        return ids

    def _whole(self, text: str) -> np.ndarray:
        """Ids of a text by the library's default settings."""
        self._tokenizer.encode_special_tokens = False
        try:
            return np.array(self._tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
        finally:
            self._tokenizer.encode_special_tokens = True

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in one array, and where each text's ids begin (and the end)."""
        if len(self._chunks) > CACHE_CHUNKS:
            self._chunks.clear()
            self._parts.clear()
        texts = pc.fill_null(texts.cast(pa.string()), "")
        whole = np.zeros(len(texts), bool)
        for content in self._added:
            whole |= pc.match_substring(texts, content).to_numpy(zero_copy_only=False)
        rest = pc.if_else(pa.array(whole), "", texts) if whole.any() else texts
        words = coded_words(pc.replace_substring_regex(pc.ascii_lower(rest), *self._STOP))
        have = self._chunks.get
        lists = [have(w) or self._chunk(w) for w in words.distinct.to_pylist()]
        ids, ends = ragged_take(*ragged(lists, np.uint32), words.codes)
        at = ends[words.offsets]
        if not whole.any():
            return ids, at
        parts = [self._whole(texts[k].as_py()) if whole[k] else ids[at[k]:at[k + 1]] for k in range(len(texts))]
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])


#: A worker's encoders by the tokenizer's text and setting: kept from task to task.
_ENCODERS: dict[tuple[str, bool], WordBpe] = {}


def word_bpe(tokenizer_json: str, added_tokens: bool = False) -> WordBpe:
    key = (tokenizer_json, added_tokens)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = WordBpe(tokenizer_json, added_tokens)
    return _ENCODERS[key]


def tokenize_to_files(docs: DataFrame, tokenizer_path: str, end_id: int, folder: str | None = None,
                      added_tokens: bool = False) -> DataFrame:
    """Encode every document with the tokenizer in ``tokenizer_path``, append
    ``end_id``, write the shard files to ``folder`` (default: a new folder
    under spark.checkpoint.dir) and return the manifest. ``added_tokens``: see
    ``WordBpe``."""
    from tokenizers import Tokenizer

    with open(tokenizer_path, encoding="utf-8") as f:
        text = f.read()
    shared = docs.sparkSession.sparkContext.broadcast(text)
    folder = folder or scratch_path(docs.sparkSession, "token-files")
    return write_tokens(docs, lambda: word_bpe(shared.value, added_tokens),
                        Tokenizer.from_str(text).get_vocab_size(), end_id, folder)
