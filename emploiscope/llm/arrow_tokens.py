"""Token ids as Arrow files of fixed-size lists.

A file holds one run of the token stream, cut into sequences of equal length: column ``ids`` is a
fixed-size list of token ids and ``mask`` a fixed-size list that is false on the padding of a
file's last sequence. Any sequence can be read in place through a memory map. Beside every file an
index, also an Arrow file, tells where documents begin. A manifest, written by Spark, lists the
files of the task attempts that counted, so what a lost attempt left behind is never read.
"""

from __future__ import annotations

import os
import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
import pyarrow.ipc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from emploiscope.llm.text import blocks, byte_hashes, gives_back
from emploiscope.llm.workspace import Workspace, bounded_batches, shuffle_partitions

LENGTH = 2048
SEQUENCES_PER_BATCH = 128
END = 0
# Pieces that a worker remembers, at some 40 bytes each.
KNOWN_PIECES = 1_000_000
RECENT_BLOCKS = 32
LINES_AT_ONCE = 4096

_MANIFEST = "part int, path string, n_tokens bigint, n_docs bigint"
_INDEX = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])

# White space that ASCII does not have, as UTF-8. Byte-level BPE's splitting pattern knows it too.
_WHITE_BEYOND_ASCII = [chr(c).encode() for c in (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]
_WHITE = np.zeros(256, dtype=bool)
_WHITE[[*range(0x09, 0x0E), *range(0x1C, 0x21)]] = True
_WHITE_INSIDE = re.compile(b"|".join([b"[\x09-\x0d\x1c-\x20]", *_WHITE_BEYOND_ASCII]))
_SPACE, _LINE = 0x20, 0x0A
_MARKS = b".,"
_ALPHANUMERIC = np.zeros(256, dtype=bool)
_ALPHANUMERIC[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = True


def _white(data: np.ndarray) -> np.ndarray:
    """Which bytes are white space or part of such a character."""
    white = _WHITE[data]
    for form in _WHITE_BEYOND_ASCII:
        at = np.flatnonzero(data[: len(data) - len(form) + 1] == form[0])
        for k in range(1, len(form)):
            at = at[data[at + k] == form[k]]
        for k in range(len(form)):
            white[at + k] = True
    return white


def pieces(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where pieces begin that byte-level BPE encodes independently of each other.

    A lone space between two characters that are no white space begins a token, and a lone line end
    between two such characters is a token by itself, so texts can be cut there.
    """
    white = _white(data)
    alone = np.zeros(len(data), dtype=bool)
    alone[1:-1] = white[1:-1] & ~white[:-2] & ~white[2:]
    inner = offsets[1:-1]
    inner = inner[(inner > 0) & (inner < len(data))]
    alone[inner] = alone[inner - 1] = False  # at the border of a text
    begin = np.zeros(len(data) + 1, dtype=bool)
    begin[offsets[:-1]] = True
    begin[:-1] |= alone & ((data == _SPACE) | (data == _LINE))
    begin[1:] |= alone & (data == _LINE)
    # A single mark behind an ASCII letter or digit and before white space or the end.
    mark = (data == _MARKS[0]) | (data == _MARKS[1])
    mark[1:] &= _ALPHANUMERIC[data[:-1]]
    mark[:1] = False
    mark[:-1] &= white[1:] | begin[1:-1]
    begin[:-1] |= mark
    begin[len(data)] = False
    return np.flatnonzero(begin)


class Encoder:
    """Encodes blocks of texts; what a worker has met before is looked up, whole blocks at a time.

    Known pieces are arrays sorted by a 64-bit hash of their bytes: their lengths, and where their ids
    lie in one pool. A piece counts as known if hash and length agree. Beyond ``KNOWN_PIECES`` only
    those of the last ``RECENT_BLOCKS`` blocks stay, if they are less than half, else none.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 65536 else "<u4")
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.line = self._ids(["\n"])[0]
        self._start_anew()

    def _start_anew(self) -> None:
        self.hashes = np.empty(0, dtype=np.uint64)
        self.sizes = self.first = self.count = np.empty(0, dtype=np.int64)
        self.used = np.empty(0, dtype=np.int64)
        self.pool = np.empty(0, dtype=self.dtype)
        self.tick = 0

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, dtype=self.dtype) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encoded(self, new: list[bytes]) -> tuple[list[int], np.ndarray, np.ndarray]:
        """Distinct pieces in the order they were encoded, the number of ids of each, and all ids.

        Those without white space inside are encoded as the lines of one text.
        """
        order, counts, pool, rest, lines = [], [], [], [], []
        for k, x in enumerate(new):
            (rest if _WHITE_INSIDE.search(x, len(x) > 1 and x[0] == _SPACE) else lines).append(k)
        for low in range(0, len(lines), LINES_AT_ONCE):
            some = lines[low : low + LINES_AT_ONCE]
            ids = self._ids([b"\n".join([new[k] for k in some]).decode()])[0]
            ends = ids == self.line[0]
            if len(self.line) == 1 and ends.sum() == len(some) - 1:
                order += some
                counts.append(np.diff(np.concatenate([[-1], np.flatnonzero(ends), [len(ids)]])) - 1)
                pool.append(ids[~ends])
            else:
                rest += some
        each = self._ids([new[k].decode() for k in rest])
        counts.append(np.array([len(x) for x in each], dtype=np.int64))
        return order + rest, np.concatenate(counts), np.concatenate([*pool, *each, self.pool[:0]])

    def _forget(self) -> None:
        kept = self.used > self.tick - RECENT_BLOCKS
        if 2 * kept.sum() > KNOWN_PIECES:
            kept[:] = False
        self.pool, self.count = self.pool[_ranges(self.first[kept], self.count[kept])], self.count[kept]
        self.first = np.cumsum(self.count) - self.count
        self.hashes, self.sizes, self.used = self.hashes[kept], self.sizes[kept], self.used[kept]

    def _learn(self, hashes: np.ndarray, new: list[bytes]) -> None:
        taken, count, ids = self._encoded(new)
        hashes, sizes = hashes[taken], np.array([len(new[k]) for k in taken], dtype=np.int64)
        first = len(self.pool) + np.cumsum(count) - count
        order = np.argsort(np.concatenate([self.hashes, hashes]), kind="stable")

        def merged(old: np.ndarray, more: np.ndarray) -> np.ndarray:
            return np.concatenate([old, more])[order]

        self.hashes, self.first, self.count = merged(self.hashes, hashes), merged(self.first, first), merged(self.count, count)
        self.sizes = merged(self.sizes, sizes)
        self.used = merged(self.used, np.full(len(new), self.tick, dtype=np.int64))
        self.pool = np.concatenate([self.pool, ids])

    def _look_up(self, hashes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.hashes):
            return np.zeros(len(hashes), dtype=np.int64), np.zeros(len(hashes), dtype=bool)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return at, (self.hashes[at] == hashes) & (self.sizes[at] == sizes)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of a block's texts, each followed by ``END``, and their number per text.

        A text that holds a special token is encoded by the tokenizer as it stands.
        """
        begins = pieces(data, offsets)
        if not len(begins):
            return np.full(len(offsets) - 1, END, dtype=self.dtype), np.ones(len(offsets) - 1, dtype=np.int64)
        raw = data.tobytes()
        whole = []
        if any(s in raw for s in self.special):
            whole = [k for k, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)) if any(s in raw[a:b] for s in self.special)]
        ends = np.append(begins[1:], len(data))
        hashes = byte_hashes(data, begins, ends)
        unique, example, place = np.unique(hashes, return_index=True, return_inverse=True)
        sizes = (ends - begins)[example]
        self.tick += 1
        at, known = self._look_up(unique, sizes)
        if not known.all():
            if len(self.hashes) > KNOWN_PIECES:
                self._forget()
                at, known = self._look_up(unique, sizes)
            new = np.flatnonzero(~known)
            stale = np.isin(self.hashes, unique[new])  # same hash, other length: the newer one stays
            if stale.any():
                for name in ("hashes", "sizes", "first", "count", "used"):
                    setattr(self, name, getattr(self, name)[~stale])
            self._learn(unique[new], [raw[begins[k] : ends[k]] for k in example[new].tolist()])
            at, _ = self._look_up(unique, sizes)
        self.used[at] = self.tick
        index = at[place]
        count = self.count[index]
        texts = np.searchsorted(begins, offsets)
        per_text = np.append(0, np.cumsum(count))[texts]
        per_text = np.diff(per_text)
        ids = self.pool[_ranges(self.first[index], count)]
        ids = np.insert(ids, np.cumsum(per_text), np.array(END, dtype=self.dtype))
        per_text = per_text + 1
        if whole:
            parts = np.split(ids, np.cumsum(per_text)[:-1])
            for k, x in zip(whole, self._ids([raw[offsets[k] : offsets[k + 1]].decode() for k in whole]), strict=True):
                parts[k] = np.append(x, np.array(END, dtype=self.dtype))
                per_text[k] = len(parts[k])
            ids = np.concatenate(parts)
        return ids, per_text


def _ranges(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The numbers ``first[i]`` to ``first[i] + count[i] - 1``, one range after the other."""
    begin = np.cumsum(count) - count
    return np.repeat(first - begin, count) + np.arange(int(count.sum()))


def _filesystem(path: str) -> tuple[pa.fs.FileSystem, str]:
    """The file system that ``path`` names, the local one without a scheme, and the path on it."""
    if "://" in path or path.startswith("file:"):
        return pa.fs.FileSystem.from_uri(path)
    return pa.fs.LocalFileSystem(), path


class _Writer:
    """One file of sequences and its index, written as ids come in."""

    def __init__(self, folder: str, name: str, dtype: np.dtype, length: int) -> None:
        filesystem, root = _filesystem(folder)
        filesystem.create_dir(root, recursive=True)
        self.length, self.dtype = length, dtype
        self.path = f"{folder}/{name}.arrow"
        ids = pa.list_(pa.from_numpy_dtype(dtype), length)
        self.schema = pa.schema([("ids", ids), ("mask", pa.list_(pa.bool_(), length))])
        self.sink = filesystem.open_output_stream(f"{root}/{name}.arrow")
        self.index_sink = filesystem.open_output_stream(f"{root}/{name}.docs.arrow")
        self.file = pa.ipc.new_file(self.sink, self.schema)
        self.index = pa.ipc.new_file(self.index_sink, _INDEX)
        self.pending: list[np.ndarray] = []
        self.held = self.n_tokens = self.n_docs = 0

    def add(self, doc_ids: pa.Array, ids: np.ndarray, counts: np.ndarray) -> None:
        starts = self.n_tokens + np.cumsum(counts) - counts
        self.index.write_batch(pa.RecordBatch.from_arrays([doc_ids, pa.array(starts), pa.array(counts)], schema=_INDEX))
        self.pending.append(ids)
        self.n_tokens += len(ids)
        self.n_docs += len(counts)
        self.held += len(ids)
        if self.held >= SEQUENCES_PER_BATCH * self.length:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        ids = np.concatenate([np.empty(0, dtype=self.dtype), *self.pending])
        step = SEQUENCES_PER_BATCH * self.length
        low = 0
        while len(ids) - low >= step:
            self._batch(ids[low : low + step], step)
            low += step
        self.pending, self.held = [ids[low:].copy()], len(ids) - low
        if last and self.held:
            self._batch(ids[low:], self.held)

    def _batch(self, ids: np.ndarray, n: int) -> None:
        rows = -(-n // self.length)
        padded = np.zeros(rows * self.length, dtype=self.dtype)
        padded[:n] = ids
        mask = np.arange(rows * self.length) < n
        arrays = [pa.FixedSizeListArray.from_arrays(pa.array(padded), self.length), pa.FixedSizeListArray.from_arrays(pa.array(mask), self.length)]
        self.file.write_batch(pa.RecordBatch.from_arrays([a.cast(f.type) for a, f in zip(arrays, self.schema, strict=True)], schema=self.schema))

    def close(self) -> None:
        self._flush(True)
        for x in (self.file, self.index, self.sink, self.index_sink):
            x.close()


class Sequences:
    """Random access to one file: sequences by number, and any stretch of its token stream."""

    def __init__(self, path: str) -> None:
        filesystem, bare = _filesystem(path)
        opened = pa.memory_map if isinstance(filesystem, pa.fs.LocalFileSystem) else filesystem.open_input_file
        self.file = pa.ipc.open_file(opened(bare))
        self.index = pa.ipc.open_file(opened(bare.removesuffix(".arrow") + ".docs.arrow"))
        self.length = self.file.schema.field("ids").type.list_size
        self._batch: tuple[int, np.ndarray | None] = (-1, None)

    def _ids(self, batch: int) -> np.ndarray:
        if self._batch[0] != batch:
            self._batch = (batch, self.file.get_batch(batch).column("ids").flatten().to_numpy())
        return self._batch[1]

    def sequence(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and mask of sequence ``i``, in place."""
        batch = self.file.get_batch(i // SEQUENCES_PER_BATCH)
        at = slice(i % SEQUENCES_PER_BATCH * self.length, (i % SEQUENCES_PER_BATCH + 1) * self.length)
        return batch.column("ids").flatten().to_numpy()[at], batch.column("mask").flatten().to_numpy(zero_copy_only=False)[at]

    def tokens(self, start: int, stop: int) -> np.ndarray:
        step = SEQUENCES_PER_BATCH * self.length
        parts = [self._ids(b)[max(start - b * step, 0) : stop - b * step] for b in range(start // step, -(-stop // step))]
        return parts[0] if len(parts) == 1 else np.concatenate(parts) if parts else np.empty(0, dtype=np.uint32)


def _write(tokenizer: str, folder: str, length: int):
    @gives_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        encoder = writer = None
        for batch in batches:
            if encoder is None:
                encoder = _encoder(tokenizer)
                writer = _Writer(folder, f"part-{part:06d}-{uuid.uuid4().hex}", encoder.dtype, length)
            for low, high, data, offsets in blocks(batch.column("text")):
                writer.add(batch.column("doc_id").slice(low, high - low), *encoder.encode(data, offsets))
        if writer is not None:
            writer.close()
            row = [[part], [writer.path], [writer.n_tokens], [writer.n_docs]]
            types = [pa.int32(), pa.string(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(x, type=t) for x, t in zip(row, types, strict=True)], names=["part", "path", "n_tokens", "n_docs"])

    return run


_ENCODERS: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    """One encoder per Python worker and tokenizer, kept between tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def write_sequences(docs: DataFrame, tokenizer: str, length: int = LENGTH, work: Workspace | None = None) -> DataFrame:
    """Encode ``docs(doc_id, text)`` in ascending doc_id order; returns the manifest with each file's ``base``.

    Every document is its text's ids and one end id. ``tokenizer`` is the path of a tokenizer file
    on the executors. ``base`` is the number of ids in the files before. A null text is empty; a
    null doc_id sorts first; rows with equal doc_ids follow each other. Empty tables give no file.
    """
    bounded_batches(docs.sparkSession)
    work = work or Workspace(docs.sparkSession, "arrow-tokens")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.repartitionByRange(shuffle_partitions(docs.sparkSession), "doc_id").sortWithinPartitions("doc_id")
    manifest = work.save(rows.mapInArrow(_write(tokenizer, work.path("files"), length), _MANIFEST), "manifest")
    # One row per file.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


@gives_back
def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, base in zip(batch.column("path").to_pylist(), batch.column("base").to_pylist(), strict=True):
            file = Sequences(path)
            for k in range(file.index.num_record_batches):
                index = file.index.get_batch(k)
                spans = zip(index.column("start").to_pylist(), index.column("n_tokens").to_pylist(), strict=True)
                crc = [zlib.crc32(file.tokens(start, start + n).astype("<u4").tobytes()) for start, n in spans]
                start = pa.compute.add(index.column("start"), base)
                yield pa.RecordBatch.from_arrays([index.column("doc_id"), start, index.column("n_tokens"), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])


def document_digests(manifest: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, read back from the files of a manifest."""
    files = manifest.select("part", "path", "base")
    files = files.repartitionById(shuffle_partitions(manifest.sparkSession), F.pmod("part", F.lit(shuffle_partitions(manifest.sparkSession))))
    return files.mapInArrow(_digests, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
