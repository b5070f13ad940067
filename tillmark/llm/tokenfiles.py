"""Token ids in Arrow files of fixed-size-list batches.

Documents are dealt out by ranges of ``doc_id`` and sorted; each task encodes its range and writes one shard, two
Arrow files in the IPC file format. The sequence file holds record batches of ``SEQUENCES_PER_BATCH`` rows of two
fixed-size lists: ``SEQUENCE`` consecutive ids of the shard, and a mask of bits, true for an id and false for the
padding of the shard's last sequence. All batches but the last have one size, and a memory-mapped file gives any sequence and
its mask without a copy. The index file lists the shard's documents with their place in its ids. A manifest of all
shards, written by Spark, carries what each holds; a file of a failed or repeated task is in no manifest.
"""

from __future__ import annotations

import functools
import os
import re
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tillmark.session import materialize, scratch_path

VOCABULARY = "word_bpe_49k.json"
END = 1
SEQUENCE = 2_048
SEQUENCES_PER_BATCH = 64

#: Pieces of texts between white space whose ids a Python worker keeps at hand, and bytes of text that it encodes at once.
PIECES_AT_HAND = 800_000
BYTES_AT_ONCE = 1 << 23
WORDS_PER_LINE = 512
_WORD = re.compile("[a-zà-öø-ÿß]+")
#: Bytes that end a word of letters a-z; an apostrophe may begin a token string with letters, "<|" a special string.
_IS_MARK = np.isin(np.arange(256), np.frombuffer(b"!\"#$%&()*+,-./:;=>?@[\\]^_`{}~", dtype="u1"))
_IS_LETTER = np.isin(np.arange(256), np.arange(ord("a"), ord("z") + 1))
_SPACE, _BREAK = b" \n"
_SPECIAL = "<|"
_WORD_END = "</w>"


class Encoder:
    """Ids of texts by a tokenizer of lower-case words that drops white space, each piece of a text encoded once.

    The tokenizer normalises and splits its input so that no token and no normalisation reaches across a space
    or line break; ids of a text are those of the pieces between them in turn. Pieces of a block of texts are told apart
    by Arrow, so Python sees each different one once a block. So that fewer differ, unless the text may hold one of the
    special strings, A-Z is lowered as the tokenizer would, and a mark behind a letter begins a piece, as it does a token.
    New words of letters are encoded as lines, which the tokens that end a word cut again; other pieces one by one.
    """

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        self.tokenizer = Tokenizer.from_file(vocabulary)
        listed = self.tokenizer.get_vocab()
        self.kind = np.dtype("<u2" if max(listed.values()) < 1 << 16 else "<u4")
        self.ends_word = np.zeros(max(listed.values()) + 1, dtype=bool)
        self.ends_word[[k for token, k in listed.items() if token.endswith(_WORD_END)]] = True
        self.known: dict[bytes, bytes] = {b"": b""}

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(found.ids, dtype=self.kind) for found in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, fresh: set[bytes]) -> None:
        words, others = [], []
        for piece in fresh:
            text = piece.decode()
            (words if _WORD.fullmatch(text) else others).append(text)
        for at in range(0, len(words), WORDS_PER_LINE):
            line = words[at : at + WORDS_PER_LINE]
            ids = self._ids([" ".join(line)])[0]
            cuts = ((np.flatnonzero(self.ends_word[ids]) + 1) * self.kind.itemsize).tolist()
            packed = ids.tobytes()
            if len(cuts) == len(line):
                self.known.update((w.encode(), packed[a:b]) for w, a, b in zip(line, [0, *cuts], cuts))
            else:  # a vocabulary whose words end otherwise
                others += line
        self.known.update((o.encode(), i.tobytes()) for o, i in zip(others, self._ids(others)))

    @staticmethod
    def _pieces(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """Pieces of all texts, with the spaces that end them, and their numbers up to the end of each text."""
        texts = pc.fill_null(texts.cast(pa.binary()), b"")
        ends = np.frombuffer(texts.buffers()[1], dtype="<i4")[texts.offset : texts.offset + len(texts) + 1]
        held = texts.buffers()[2]
        data = np.frombuffer(held, dtype="u1")[ends[0] : ends[-1]].copy() if held else np.zeros(0, dtype="u1")
        ends = ends - ends[0]
        plain = np.ones(len(data), dtype=bool)
        for k in pc.indices_nonzero(pc.match_substring(texts, _SPECIAL)).to_pylist():
            plain[ends[k] : ends[k + 1]] = False
        data[plain & (data >= ord("A")) & (data <= ord("Z"))] |= 0x20
        data[data == _BREAK] = _SPACE
        last = data == _SPACE
        last[:-1] |= plain[:-1] & _IS_LETTER[data[:-1]] & _IS_MARK[data[1:]]
        last[ends[1:][ends[1:] > ends[:-1]] - 1] = True
        cuts = np.flatnonzero(last).astype("<i4") + np.int32(1)
        offsets = np.concatenate([np.zeros(1, dtype="<i4"), cuts])
        pieces = pa.Array.from_buffers(pa.binary(), len(cuts), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
        return pieces, np.searchsorted(cuts, ends[1:], side="right")

    @staticmethod
    def _without_spaces(pieces: pa.Array) -> list[bytes]:
        ends = np.frombuffer(pieces.buffers()[1], dtype="<i4")[pieces.offset : pieces.offset + len(pieces) + 1]
        if not ends[-1]:
            return [b""] * len(pieces)
        data = pieces.buffers()[2].to_pybytes()
        spaced = np.frombuffer(data, dtype="u1")[ends[1:] - 1] == _SPACE  # no piece is empty
        return [data[a:b] for a, b in zip(ends[:-1].tolist(), (ends[1:] - spaced).tolist())]

    def encode_block(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all ``texts`` in turn, and their numbers up to the end of each; a null text has none."""
        pieces, upto = self._pieces(texts)
        told = pieces.dictionary_encode()
        different = self._without_spaces(told.dictionary)
        wanted = set(different)
        if len(self.known) + len(wanted) > PIECES_AT_HAND:
            self.known = {b"": b""}
        self._learn(wanted - self.known.keys())
        packed = [self.known[piece] for piece in different]
        table = np.frombuffer(b"".join(packed), dtype=self.kind)
        sizes = np.fromiter(map(len, packed), dtype=np.int64, count=len(packed)) // self.kind.itemsize
        first = np.cumsum(sizes) - sizes
        which = told.indices.to_numpy()
        n = sizes[which]
        ends = np.cumsum(n)
        ids = table[np.arange(ends[-1] if len(ends) else 0) + np.repeat(first[which] - (ends - n), n)]
        return ids, np.concatenate([np.zeros(1, dtype=np.int64), ends])[upto]

    def encode(self, texts: Sequence[bytes | None]) -> list[bytes]:
        """Ids of each UTF-8 text, packed; a null text has none."""
        ids, ends = self.encode_block(pa.array(texts, pa.binary()))
        return [part.tobytes() for part in np.split(ids, ends[:-1])] if len(ends) else []


@functools.cache
def _encoder(vocabulary: str) -> Encoder:
    """One per Python worker, which Spark keeps for later tasks."""
    return Encoder(vocabulary)


def _schema(kind: np.dtype, sequence: int) -> pa.Schema:
    return pa.schema([("ids", pa.list_(pa.from_numpy_dtype(kind), sequence)), ("mask", pa.list_(pa.bool_(), sequence))])


class ShardWriter:
    """Cuts a stream of ids into sequences and writes them batch by batch; holds one batch."""

    def __init__(self, sink: pa.NativeFile, kind: np.dtype, sequence: int = SEQUENCE, per_batch: int = SEQUENCES_PER_BATCH):
        self.kind, self.sequence, self.per_batch = kind, sequence, per_batch
        self.schema = _schema(kind, sequence)
        self.writer = pa.ipc.new_file(sink, self.schema)
        self.held = bytearray()
        self.n_ids = 0

    def _write(self, ids: np.ndarray) -> None:
        rows = -(-len(ids) // self.sequence)
        padded = np.zeros(rows * self.sequence, dtype=self.kind)
        padded[: len(ids)] = ids
        mask = np.arange(rows * self.sequence) < len(ids)
        lists = [pa.FixedSizeListArray.from_arrays(pa.array(values), self.sequence) for values in (padded, mask)]
        self.writer.write_batch(pa.RecordBatch.from_arrays(lists, schema=self.schema))

    def add(self, ids: bytes) -> None:
        self.held += ids
        self.n_ids += len(ids) // self.kind.itemsize
        full = self.per_batch * self.sequence * self.kind.itemsize
        if len(self.held) >= full:
            end = len(self.held) // full * full
            for at in range(0, end, full):
                self._write(np.frombuffer(bytes(self.held[at : at + full]), dtype=self.kind))
            del self.held[:end]

    def close(self) -> None:
        if self.held:
            self._write(np.frombuffer(bytes(self.held), dtype=self.kind))
        self.writer.close()


class Sequences:
    """A shard's sequences. Indexing gives views of a memory-mapped file; nothing is read or copied beforehand."""

    def __init__(self, source: pa.NativeFile):
        self.file = pa.ipc.open_file(source)
        self.per_batch = len(self._batch(0)) if self.file.num_record_batches else 0

    def _batch(self, k: int) -> pa.RecordBatch:
        return self.file.get_batch(k)

    def __len__(self) -> int:
        last = self.file.num_record_batches - 1
        return last * self.per_batch + self._batch(last).num_rows if last >= 0 else 0

    def __getitem__(self, at: int) -> tuple[np.ndarray, pa.BooleanArray]:
        if not 0 <= at < len(self):
            raise IndexError(at)
        batch, row = self._batch(at // self.per_batch), at % self.per_batch
        size = batch.schema.field("ids").type.list_size
        ids, mask = (batch.column(name).flatten().slice(row * size, size) for name in ("ids", "mask"))
        return ids.to_numpy(zero_copy_only=True), mask

    def pieces(self) -> Iterator[np.ndarray]:
        """The shard's ids without padding, a batch at a time."""
        for k in range(self.file.num_record_batches):
            batch = self._batch(k)
            ids, mask = batch.column("ids").flatten(), batch.column("mask").flatten()
            yield ids.to_numpy(zero_copy_only=True)[: mask.true_count]


def open_input(uri: str) -> pa.NativeFile:
    """A file by path or address: mapped into memory if it is local, read by ranges if it is not."""
    system, path = fs.FileSystem.from_uri(uri)
    return pa.memory_map(path) if isinstance(system, fs.LocalFileSystem) else system.open_input_file(path)


def _open_output(uri: str) -> pa.NativeFile:
    system, path = fs.FileSystem.from_uri(uri)
    system.create_dir(os.path.dirname(path), recursive=True)
    return system.open_output_stream(path)


def address(folder: str) -> str:
    return folder if "://" in folder else folder.replace("file:", "file://", 1) if folder.startswith("file:") else f"file://{os.path.abspath(folder)}"


def write_shards(docs: DataFrame, folder: str, vocabulary: str, end: int = END, sequence: int = SEQUENCE, per_batch: int = SEQUENCES_PER_BATCH) -> DataFrame:
    """Write the ids of ``docs`` in ascending ``doc_id`` order to ``folder``; return the manifest ``(shard, path, n_docs, n_ids, first_id)``.

    ``path`` ends without ``.ids.arrow`` and ``.docs.arrow``, the two files of the shard; ``first_id`` counts the ids
    of all shards before it. Rows that repeat a ``doc_id`` are dealt out by their texts too and then by where
    they were read, so one id may fill any number of shards. Null ids come last.
    """
    folder = address(folder)
    keys = [F.col("doc_id").isNull(), F.col("doc_id"), F.xxhash64("text"), F.monotonically_increasing_id()]
    named = docs.select("doc_id", "text", *[k.alias(f"k{i}") for i, k in enumerate(keys)])
    order = [f"k{i}" for i in range(len(keys))]
    ranged = named.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = writer = index = None
        n_docs = 0
        shard = TaskContext.get().partitionId()
        path = f"{folder}/shard-{shard:06d}-{uuid.uuid4().hex[:12]}"
        for batch in batches:
            if not batch.num_rows:
                continue
            if writer is None:
                encoder = _encoder(vocabulary)
                writer = ShardWriter(sink := _open_output(f"{path}.ids.arrow"), encoder.kind, sequence, per_batch)
                index_schema = pa.schema([("doc_id", batch.schema.field("doc_id").type), ("start", pa.int64()), ("n_tokens", pa.int64())])
                index = pa.ipc.new_file(index_sink := _open_output(f"{path}.docs.arrow"), index_schema)
            starts, sizes = [], []
            for at in _blocks(batch.column("text")):
                ids, ends = encoder.encode_block(batch.column("text").slice(*at))
                size = np.diff(ends, prepend=0) + 1
                starts.append(writer.n_ids + np.cumsum(size) - size)
                sizes.append(size)
                writer.add(np.insert(ids, ends, end).tobytes())
            found = [pa.array(np.concatenate(part), pa.int64()) for part in (starts, sizes)]
            index.write_batch(pa.RecordBatch.from_arrays([batch.column("doc_id"), *found], schema=index_schema))
            n_docs += batch.num_rows
        if writer is not None:
            writer.close(), index.close(), sink.close(), index_sink.close()
            values = [[shard], [path], [n_docs], [writer.n_ids]]
            yield pa.RecordBatch.from_arrays([pa.array(v) for v in values], ["shard", "path", "n_docs", "n_ids"])

    written = materialize(ranged.mapInArrow(write, "shard bigint, path string, n_docs bigint, n_ids bigint"), "manifest")
    before = F.sum("n_ids").over(W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1))
    return written.select("*", F.coalesce(before, F.lit(0)).cast("bigint").alias("first_id"))  # one row a shard


def _blocks(texts: pa.Array, most: int = BYTES_AT_ONCE) -> Iterator[tuple[int, int]]:
    """Offset and length of consecutive rows of ``most`` bytes at most, a longer text alone."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(ends):
        base = ends[at - 1] if at else 0
        to = max(at + 1, bisect_right(ends, base + most))
        yield at, to - at
        at = to


def read_documents(manifest: DataFrame, added: str, work: Callable[[np.ndarray], list], doc_id: str = "bigint") -> DataFrame:
    """A row per document of the shards in ``manifest``: ``doc_id``, ``start`` (over all shards), ``n_tokens`` and what ``work`` makes of its ids.

    Shards are dealt out to tasks; each is read in batches, and a document's ids are put together only if it
    crosses batches.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch.to_pylist():
                with open_input(f"{shard['path']}.ids.arrow") as source, open_input(f"{shard['path']}.docs.arrow") as index:
                    pieces, held, base = Sequences(source).pieces(), np.zeros(0, dtype="<u4"), 0
                    listed = pa.ipc.open_file(index)
                    for k in range(listed.num_record_batches):
                        docs = listed.get_batch(k)
                        made = []
                        for start, size in zip(docs.column("start").to_pylist(), docs.column("n_tokens").to_pylist()):
                            parts, have = [held[start - base :]], base + len(held) - start
                            while have < size:
                                parts.append(next(pieces))
                                have += len(parts[-1])
                            ids = np.concatenate(parts) if len(parts) > 1 else parts[0]
                            if len(parts) > 1 or start != base:
                                held, base = ids, start
                            made.append(work(ids[:size]))
                        starts = pa.array(np.asarray(docs.column("start")) + shard["first_id"], pa.int64())
                        columns = [pa.array(list(c)) for c in zip(*made)]
                        yield pa.RecordBatch.from_arrays([docs.column("doc_id"), starts, docs.column("n_tokens"), *columns], names)

    names = ["doc_id", "start", "n_tokens", *[c.split()[0] for c in added.split(",")]]
    shards = max(1, manifest.count())  # a shard a task
    return manifest.repartitionByRange(shards, "shard").mapInArrow(read, f"doc_id {doc_id}, start bigint, n_tokens bigint, {added}")


def checksum(ids: np.ndarray) -> list:
    return [zlib.crc32(ids.astype("<u4").tobytes())]


def write_and_read(spark: SparkSession, docs: DataFrame, vocabulary: str | None = None, folder: str | None = None) -> DataFrame:
    """Write ``docs`` as token files and read them back: ``(doc_id, start, n_tokens, ids_crc32)`` of every row.

    Null and empty texts are their end id alone. Repeated rows are documents of their own, one after the other; rows
    of one ``doc_id`` come in the order of a hash of their texts. Null ids come last. Texts of any length are
    encoded whole. Other columns are not read, whatever their names. No rows give no files and no rows.
    """
    vocabulary = vocabulary or public_tokenizers.path(VOCABULARY)
    manifest = write_shards(docs, folder or scratch_path(spark, "tokens"), vocabulary)
    return read_documents(manifest, "ids_crc32 bigint", checksum, docs.schema["doc_id"].dataType.simpleString())
