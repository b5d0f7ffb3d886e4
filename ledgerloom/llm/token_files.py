"""Token ids of documents in Arrow stream files of equal-length sequences.

A part holds the ids of its documents, one after the other with an end id after each, cut into sequences
of ``length`` ids.  ``part-N.ids`` is an Arrow stream of record batches with a fixed number of rows
and two fixed-size-list columns, ids and mask (false where the last sequence is padded); nothing has
variable length, so batch b starts at a known byte and is read in place.  ``part-N.docs`` is an Arrow
stream of doc_id, first (ids before it in the part) and n_tokens.  Parts follow each other in order of id.
"""

from __future__ import annotations

import json
import os
import re
import sys
import types
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .storage import fresh_path, keep

LENGTH = 1024
ROWS = 32
#: Characters that are encoded at once, and pieces whose ids a worker remembers.
BLOCK, CACHE = 1 << 20, 1_300_000


def worker_state() -> dict:
    """What a Python worker keeps from task to task; it holds remembered results only."""
    return sys.modules.setdefault("ledgerloom_worker_state", types.ModuleType("ledgerloom_worker_state")).__dict__.setdefault("kept", {})


class Encoder:
    """The library's encoding, with the ids of pieces remembered.

    A byte-level pre-tokenizer never joins what stands before a single space and the space, so a text may be cut
    there.  A new piece is cut by the pre-tokenizer's public pattern and its parts go to the library's model, which
    saves most of the time that the library spends on offsets.  Texts with an added token, and all texts
    for other kinds of definitions, go to the library whole.
    """

    #: Fixed value: the pattern of byte-level pre-tokenizers.
    PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"

    def __init__(self, definition: str, kind: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.model = self.tokenizer.model
        self.kind = kind
        self.code = {2: "H", 4: "I"}[np.dtype(kind).itemsize]
        parts = json.loads(definition)
        own = parts.get("pre_tokenizer") or {}
        self.by_pieces = parts.get("normalizer") is None and (own.get("type"), own.get("add_prefix_space"), own.get("use_regex")) == ("ByteLevel", False, True)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.blank_before_space = re.compile(r"\s ")
        self.cut = regex.compile(self.PATTERN).findall
        # bytes as the characters that byte-level vocabularies write them with: printable ones as they are, the others from 256 on
        plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        others = [x for x in range(256) if x not in plain]
        self.letters = {x: chr(256 + i) for i, x in enumerate(others)}
        # ids of pieces that follow a space (written without it), and of others
        kept = worker_state()
        mark = zlib.crc32(definition.encode()), kind
        self.after: dict[str, bytes] = kept.setdefault(("after", *mark), {})
        self.bare: dict[str, bytes] = kept.setdefault(("bare", *mark), {})

    def _pieces(self, text: str) -> tuple[str, list[str]]:
        """What stands before the first cut, and the pieces after it without their leading space."""
        first, *rest = text.split(" ")
        if not self.blank_before_space.search(text):
            return first, rest
        joined = [first]
        for part in rest:
            if not joined[-1] or joined[-1][-1].isspace():
                joined[-1] += " " + part
            else:
                joined.append(" " + part)
        return joined[0], [piece[1:] for piece in joined[1:]]

    def _word(self, word: str, space: bool) -> bytes:
        """Ids of what the pattern does not cut."""
        own = word if word.isascii() and word.isalpha() else word.encode().decode("latin-1").translate(self.letters)
        return array(self.code, [t.id for t in self.model.tokenize(self.letters[0x20] + own if space else own)]).tobytes()

    def _piece(self, piece: str, space: bool) -> bytes:
        if piece.isalpha():
            return self._word(piece, space)
        out = []
        for word in self.cut(" " + piece if space else piece):
            led = word[0] == " " and len(word) > 1 and not word[1].isspace()
            known, own = (self.after, word[1:]) if led else (self.bare, word)
            ids = known.get(own)
            if ids is None:
                ids = known[own] = self._word(own, led)
            out.append(ids)
        return b"".join(out)

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.kind).tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        out, after, bare = [], self.after, self.bare
        for text in texts:
            if not self.by_pieces or any(a in text for a in self.added):
                out.append(self._whole(text))
                continue
            first, rest = self._pieces(text)
            found = list(map(after.get, rest))
            if None in found:
                for i, ids in enumerate(found):
                    if ids is None:
                        found[i] = after[rest[i]] = self._piece(rest[i], True)
                if len(after) > CACHE:
                    after.clear()
            ids = bare.get(first)
            if ids is None:
                ids = bare[first] = self._piece(first, False)
                if len(bare) > CACHE // 10:
                    bare.clear()
            out.append(ids + b"".join(found))
        return out


def _schema(kind: str, length: int) -> pa.Schema:
    return pa.schema([("ids", pa.list_(pa.from_numpy_dtype(np.dtype(kind)), length)), ("mask", pa.list_(pa.bool_(), length))])


DOCS = pa.schema([("doc_id", pa.int64()), ("first", pa.int64()), ("n_tokens", pa.int64())])


class PartWriter:
    """Writes under other names and gives the files their names at the end, so a lost task leaves no part."""

    def __init__(self, folder: str, part: int, kind: str, length: int, rows: int):
        self.fs, self.root = pa.fs.FileSystem.from_uri(folder)
        self.fs.create_dir(self.root, recursive=True)
        self.part, self.kind, self.length, self.rows = part, kind, length, rows
        self.attempt = uuid.uuid4().hex
        self.schema = _schema(kind, length)
        self.sinks = [self.fs.open_output_stream(self._name(x, True)) for x in ("ids", "docs")]
        self.ids, self.docs = (pa.ipc.new_stream(s, schema) for s, schema in zip(self.sinks, (self.schema, DOCS)))
        self.held: list[bytes] = []
        self.held_n = self.first = 0

    def _name(self, what: str, open_: bool = False) -> str:
        return f"{self.root}/" + (f"_{self.attempt}.{what}" if open_ else f"part-{self.part:07d}.{what}")

    def add(self, doc_ids: list[int | None], ids: list[bytes]) -> None:
        size = np.dtype(self.kind).itemsize
        counts = np.array([len(x) // size for x in ids], np.int64)
        firsts = self.first + np.concatenate([[0], np.cumsum(counts)[:-1]])
        self.docs.write_batch(pa.record_batch([pa.array(doc_ids, pa.int64()), pa.array(firsts, pa.int64()), pa.array(counts)], schema=DOCS))
        self.first += int(counts.sum())
        self.held += ids
        self.held_n += int(counts.sum())
        full = self.rows * self.length
        if self.held_n >= full:
            flat = np.frombuffer(b"".join(self.held), self.kind)
            whole = len(flat) // full * full
            for i in range(0, whole, full):
                self._batch(flat[i : i + full], full)
            self.held, self.held_n = [flat[whole:].tobytes()], len(flat) - whole

    def _batch(self, flat: np.ndarray, used: int) -> None:
        mask = pa.array(np.arange(len(flat)) < used)
        self.ids.write_batch(
            pa.record_batch([pa.FixedSizeListArray.from_arrays(x, self.length) for x in (pa.array(flat), mask)], schema=self.schema)
        )

    def close(self) -> None:
        if self.held_n:
            flat = np.zeros(-(-self.held_n // self.length) * self.length, self.kind)
            flat[: self.held_n] = np.frombuffer(b"".join(self.held), self.kind)
            self._batch(flat, self.held_n)
        for stream, sink, what in zip((self.ids, self.docs), self.sinks, ("ids", "docs")):
            stream.close()
            sink.close()
            if self.fs.get_file_info(self._name(what)).type == pa.fs.FileType.NotFound:
                self.fs.move(self._name(what, True), self._name(what))
            else:  # another attempt of this task has written the same
                self.fs.delete_file(self._name(what, True))


class PartReader:
    """Sequences and masks of a part by number, in place."""

    def __init__(self, folder: str, part: int):
        fs, root = pa.fs.FileSystem.from_uri(folder)
        name = f"{root}/part-{part:07d}"
        self.file = pa.memory_map(f"{name}.ids") if isinstance(fs, pa.fs.LocalFileSystem) else fs.open_input_file(f"{name}.ids")
        self.schema = pa.ipc.read_schema(pa.ipc.read_message(self.file))
        self.start = self.file.tell()
        self.length = self.schema.field("ids").type.list_size
        self.rows = self.step = 0
        if self.file.size() - self.start > 8:  # more than the end mark
            first = pa.ipc.read_record_batch(pa.ipc.read_message(self.file), self.schema)
            self.rows, self.step = first.num_rows, self.file.tell() - self.start
        with fs.open_input_stream(f"{name}.docs") as stream:
            self.docs = pa.ipc.open_stream(stream).read_all()
        self._last: tuple[int, pa.RecordBatch | None] = (-1, None)

    def batch(self, number: int) -> pa.RecordBatch:
        if self._last[0] != number:
            self.file.seek(self.start + number * self.step)
            self._last = (number, pa.ipc.read_record_batch(pa.ipc.read_message(self.file), self.schema))
        return self._last[1]

    def sequence(self, number: int) -> tuple[np.ndarray, np.ndarray]:
        batch, row = self.batch(number // self.rows), number % self.rows
        cut = slice(row * self.length, (row + 1) * self.length)
        return batch.column("ids").values.to_numpy()[cut], batch.column("mask").values[cut].to_numpy(zero_copy_only=False)

    def ids(self, first: int, n: int) -> np.ndarray:
        """n ids from place ``first`` of the part on."""
        full, parts = self.rows * self.length, []
        while n:
            number, at = divmod(first, full)
            own = self.batch(number).column("ids").values.to_numpy()[at : at + n]
            parts.append(own)
            first, n = first + len(own), n - len(own)
        return np.concatenate(parts) if parts else np.empty(0, np.int64)


def write_tokens(
    docs: DataFrame, folder: str, definition: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, rows: int = ROWS
) -> DataFrame:
    """Writes the files; gives (part, start, n_docs): parts in order of id with the number of ids before them.

    Null text counts as empty; null ids come first; rows that repeat an id are all written.
    """
    from tokenizers import Tokenizer

    kind = "<u2" if max(Tokenizer.from_str(definition).get_vocab_size(), end_id + 1) <= 1 << 16 else "<u4"
    shipped = docs.sparkSession.sparkContext.broadcast(definition)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, writer, n = TaskContext.get().partitionId(), None, 0
        encoder, end = Encoder(shipped.value, kind), np.array([end_id], kind).tobytes()
        for batch in batches:
            ids, texts = batch.column("id").to_pylist(), batch.column("text").fill_null("")
            sizes = np.concatenate([[0], np.cumsum(pa.compute.utf8_length(texts).to_numpy(zero_copy_only=False))])
            i = 0
            while i < len(ids):
                j = max(i + 1, int(np.searchsorted(sizes, sizes[i] + BLOCK)))
                j = min(j, len(ids))
                writer = writer or PartWriter(folder, part, kind, length, rows)
                writer.add(ids[i:j], [x + end for x in encoder.encode(texts.slice(i, j - i).to_pylist())])
                n, i = n + j - i, j
        if writer:
            writer.close()
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int64()), "n_tokens": pa.array([writer.first], pa.int64()), "n_docs": pa.array([n], pa.int64())})

    read = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    ordered = read.repartitionByRange("id").sortWithinPartitions("id", F.xxhash64("text"))
    parts = keep(ordered.mapInArrow(write, "part long, n_tokens long, n_docs long"), "token-parts")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per part
    return keep(parts.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0))), "token-starts")


def read_documents(spark: SparkSession, folder: str, parts: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files; the crc is of 32-bit little-endian ids."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, start in zip(batch.column("part").to_pylist(), batch.column("start").to_pylist()):
                reader = PartReader(folder, part)
                for docs in reader.docs.to_batches():
                    first, n = docs.column("first").to_numpy(), docs.column("n_tokens").to_numpy()
                    crcs = [zlib.crc32(reader.ids(a, b).astype("<u4").tobytes()) for a, b in zip(first.tolist(), n.tolist())]
                    yield pa.RecordBatch.from_pydict(
                        {"doc_id": docs.column("doc_id"), "start": pa.array(start + first), "n_tokens": docs.column("n_tokens"), "ids_crc32": pa.array(crcs, pa.int64())}
                    )

    many = max(1, parts.count())
    return parts.select("part", "start").repartition(many).mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_round_trip(docs: DataFrame, vocabulary: str, end_id: int) -> DataFrame:
    """Encodes, writes and reads back: one row per document.  An empty table gives no rows.  Other columns are not read."""
    spark = docs.sparkSession
    with open(vocabulary, encoding="utf-8") as file:
        definition = file.read()
    folder = fresh_path(spark, "tokens")
    if "://" not in folder:
        folder = f"file://{folder}" if folder.startswith("/") else folder
    elif folder.startswith("file:/") and not folder.startswith("file://"):
        folder = folder.replace("file:/", "file:///", 1)
    return read_documents(spark, folder, write_tokens(docs, folder, definition, end_id))
