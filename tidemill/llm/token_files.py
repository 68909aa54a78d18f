"""Token-id files of independent zstandard frames with a trailing seek table.

A file holds the ids of whole documents in order, little-endian unsigned 32-bit, each
document in frames of its own. Two skippable frames end it: the documents (ids and first
frames), and the seek table of the public seekable format, with the sizes and the
checksum (low half of XXH64) of each frame. Any zstandard reader restores all ids; this
module's reader opens the table and decompresses only the frames of the documents asked
for.

Writers name files anew on each attempt, and a file counts only if the manifest, a table
that Spark commits, names it: tasks that are run again or twice leave nothing in it.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
import regex
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemill.llm.store import freed, stage
from tidemill.llm.token_counts import byte_letters
from tidemill.session import scratch_path

# Fixed values of the seekable format: https://github.com/facebook/zstd, contrib/seekable_format.
TABLE_MAGIC = 0x184D2A5E
FOOTER_MAGIC = 0x8F92EAB1
HAS_CHECKSUMS = 0x80
DOCUMENTS_MAGIC = 0x184D2A50
# Fixed value: the normalisation under which letters may be put in lower case beforehand.
LOWER_CASE = {
    "type": "Sequence",
    "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"},
    ],
}
# Fixed value: the splitting under which a run of letters is one piece, and stops after it another.
LETTER_RUNS = {
    "type": "Sequence",
    "pretokenizers": [
        {
            "type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
            "behavior": "Removed", "invert": True,
        },
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}
ENTRY = np.dtype([("packed", "<u4"), ("size", "<u4"), ("checksum", "<u4")])
DOCUMENT = np.dtype([("doc_id", "<i8"), ("named", "u1"), ("frame", "<u4")])


@dataclass(frozen=True)
class Settings:
    end_id: int = 2
    """Appended to each document."""
    level: int = 3
    frame_bytes: int = 16 << 20
    """Most bytes of ids in a frame; longer documents have several."""
    file_bytes: int = 1 << 30
    """Bytes of ids after which a task starts a new file."""
    read_documents: int = 20_000
    """Documents of a file that one reading row covers."""
    known_bytes: int = 64 << 20
    """Memory of parts of words whose ids a worker remembers before it starts afresh; it keeps
    the last such memory beside the new one."""


MANIFEST = "file string, task int, number int, documents long, ids long"


# Latin letters whose lower case is one letter: all but the capital I with a dot.
LETTERS = "[A-Za-zÀ-ÖØ-öø-įı-ɏ]+"
LETTERED = f"^(?P<run>{LETTERS})(?P<stops>[.,;:!?%$&*#()/+=-]*)$"
RUN = regex.compile(LETTERS)
ENTRY_BYTES = 160
"""What a remembered part takes besides its letters and ids, about."""
CHUNK_BYTES = 2 << 20
"""Bytes of texts whose distinct words are found together; a longer text is a chunk by itself."""


class Encoder(dict):
    """The library's ids of parts of words, as bytes, remembered.

    White space ends a pre-token of these vocabularies, so that a text's ids are those of
    its words in a row. A run of Latin letters is one pre-token, and stops after it are
    another: such words are put together of their parts, in lower case, of which the
    library's model gives the ids; all other words the library encodes as they are. Only
    parts are remembered, which are fewer than words; Arrow finds the distinct words of a
    chunk of texts, and their parts.
    """

    def __init__(self, vocabulary: str, known_bytes: int):
        self.library = Tokenizer.from_str(vocabulary)
        self.library.no_truncation()
        self.library.no_padding()
        self.model = self.library.model
        self.known_bytes, self.held = known_bytes, 0
        self.before: dict[str, bytes] = {}
        self.letters = {byte: letter for byte, letter in enumerate(byte_letters())}
        spec = json.loads(vocabulary)
        self.folds = (
            spec["normalizer"] == LOWER_CASE and spec["pre_tokenizer"] == LETTER_RUNS and spec["model"]["end_of_word_suffix"] is not None
        )

    def __missing__(self, part: str) -> bytes:
        found = self.before.get(part)
        if found is None:
            found = self._ids(part)
        self[part] = found
        self.held += ENTRY_BYTES + len(part) + len(found)
        return found

    def _ids(self, part: str) -> bytes:
        plain = part.isascii() and part.isalpha()
        if self.folds and (plain or RUN.fullmatch(part)):
            # Bytes as the letters that stand for them: those of ASCII stand for themselves.
            said = part if plain else part.encode().decode("latin-1").translate(self.letters)
            ids = [token.id for token in self.model.tokenize(said)]
        else:
            ids = self.library.encode(part, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def _each(self, parts: pa.Array) -> np.ndarray:
        coded = parts.dictionary_encode()
        found = list(map(self.__getitem__, coded.dictionary.to_numpy(zero_copy_only=False)))
        return np.array(found, object)[coded.indices.to_numpy()]

    def _words(self, words: pa.Array) -> np.ndarray:
        if not self.folds:
            return self._each(words)
        split = pc.extract_regex(words, LETTERED)
        lettered = split.is_valid()
        first = self._each(pc.if_else(lettered, pc.utf8_lower(split.field("run")), words))
        return first + self._each(pc.if_else(lettered, split.field("stops"), ""))

    def texts(self, texts: pa.Array) -> Iterator[bytes]:
        """The ids of each text; a null text has none."""
        ends = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
        first = 0
        while first < len(texts):
            start = ends[first - 1] if first else 0
            end = max(first + 1, int(np.searchsorted(ends, start + CHUNK_BYTES, side="right")))
            yield from self._chunk(texts.slice(first, end - first))
            first = end

    def _chunk(self, texts: pa.Array) -> Iterator[bytes]:
        if self.held > self.known_bytes:
            # Parts met since the last time stay at hand.
            self.before, self.held = dict(self), 0
            self.clear()
        split = pc.split_pattern(pc.replace_substring(texts.fill_null(""), "\n", " "), " ")
        coded = split.flatten().dictionary_encode()
        data = self._words(coded.dictionary)[coded.indices.to_numpy()].tolist()
        places = split.offsets.to_pylist()
        for low, high in zip(places, places[1:]):
            yield b"".join(data[low:high])

    def encode(self, text: str) -> bytes:
        return next(self.texts(pa.array([text], pa.string())))


_encoders: dict[str, Encoder] = {}


def encoder(vocabulary: str, known_bytes: int) -> Encoder:
    """This worker's encoder, which remembers parts of words from task to task."""
    if vocabulary not in _encoders:
        _encoders.clear()
        _encoders[vocabulary] = Encoder(vocabulary, known_bytes)
    return _encoders[vocabulary]


class Writer:
    """One file, written from front to end."""

    def __init__(self, folder: str, name: str, settings: Settings):
        system, path = pyarrow.fs.FileSystem.from_uri(folder)
        system.create_dir(path)
        self.name, self.settings = name, settings
        self.stream = system.open_output_stream(f"{path}/{name}", compression=None)
        self.packer = zstandard.ZstdCompressor(level=settings.level, write_content_size=True)
        self.entries: list[tuple[int, int, int]] = []
        self.documents: list[tuple[int, int, int]] = []
        self.ids = 0

    def add(self, doc_id: int | None, data: bytes) -> None:
        self.documents.append((doc_id or 0, doc_id is not None, len(self.entries)))
        step = self.settings.frame_bytes
        for start in range(0, len(data), step):
            part = data[start : start + step]
            packed = self.packer.compress(part)
            self.stream.write(packed)
            self.entries.append((len(packed), len(part), xxhash.xxh64_intdigest(part) & 0xFFFFFFFF))
        self.ids += len(data) // 4

    def close(self) -> None:
        documents = np.array(self.documents, DOCUMENT).tobytes() + struct.pack("<I", len(self.documents))
        self.stream.write(struct.pack("<II", DOCUMENTS_MAGIC, len(documents)) + documents)
        table = np.array(self.entries, ENTRY).tobytes() + struct.pack("<IBI", len(self.entries), HAS_CHECKSUMS, FOOTER_MAGIC)
        self.stream.write(struct.pack("<II", TABLE_MAGIC, len(table)) + table)
        self.stream.close()


class Reader:
    """Random access to the documents of one file."""

    def __init__(self, folder: str, name: str):
        system, path = pyarrow.fs.FileSystem.from_uri(folder)
        self.file = system.open_input_file(f"{path}/{name}")
        size = self.file.size()
        frames, flags, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != FOOTER_MAGIC or flags != HAS_CHECKSUMS:
            raise ValueError(f"{name}: no seek table")
        table = size - 9 - frames * ENTRY.itemsize
        self.entries = np.frombuffer(self._at(table, frames * ENTRY.itemsize), ENTRY)
        end = table - 8
        (count,) = struct.unpack("<I", self._at(end - 4, 4))
        self.documents = np.frombuffer(self._at(end - 4 - count * DOCUMENT.itemsize, count * DOCUMENT.itemsize), DOCUMENT)
        self.places = np.concatenate([[0], np.cumsum(self.entries["packed"], dtype=np.int64)])
        self.frames = np.append(self.documents["frame"], frames).astype(np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.entries["size"], dtype=np.int64)])[self.frames] // 4
        self.unpacker = zstandard.ZstdDecompressor()

    def _at(self, place: int, size: int) -> bytes:
        return self.file.read_at(size, place)

    def ids(self, first: int, end: int) -> Iterator[bytes]:
        """The ids of documents ``first`` to ``end`` of the file, checked."""
        for number in range(first, end):
            parts = []
            for frame in range(self.frames[number], self.frames[number + 1]):
                entry = self.entries[frame]
                part = self.unpacker.decompress(self._at(int(self.places[frame]), int(entry["packed"])))
                if len(part) != entry["size"] or xxhash.xxh64_intdigest(part) & 0xFFFFFFFF != entry["checksum"]:
                    raise ValueError(f"frame {frame}: wrong checksum")
                parts.append(part)
            yield b"".join(parts)

    def doc_id(self, number: int) -> int | None:
        row = self.documents[number]
        return int(row["doc_id"]) if row["named"] else None


def write(docs: DataFrame, vocabulary: str, folder: str, settings: Settings = Settings()) -> DataFrame:
    """Encode (doc_id, text, ...) into files of ``folder``, in order of doc_id; the manifest.

    Rows without doc_id come first; rows that repeat one are in the order of a hash of
    their text. A null text is empty and has the end id only. ``folder`` is one that every
    executor reaches by the same address, in a file system that Arrow can open.
    """
    spec = docs.sparkSession.sparkContext.broadcast(Path(vocabulary).read_text())
    end = np.array([settings.end_id], "<u4").tobytes()

    def run(batches):
        remembered, task = encoder(spec.value, settings.known_bytes), TaskContext.get().partitionId()
        done, writer = [], None

        def close() -> None:
            writer.close()
            done.append((writer.name, task, len(done), len(writer.documents), writer.ids))

        for batch in batches:
            for doc_id, ids in zip(batch.column(0).to_pylist(), remembered.texts(batch.column(1))):
                if writer is None:
                    writer = Writer(folder, f"ids-{task:06d}-{len(done):04d}-{uuid.uuid4().hex}.zst", settings)
                writer.add(doc_id, ids + end)
                if writer.ids * 4 >= settings.file_bytes:
                    close()
                    writer = None
        if writer is not None:
            close()
        columns = list(zip(*done)) if done else [[]] * 5
        types = [pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
        names = ["file", "task", "number", "documents", "ids"]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    rows = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("tie"))
    ordered = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    return stage(ordered.mapInArrow(freed(run), MANIFEST), "manifest")


def read(spark: SparkSession, folder: str, manifest: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of each document in the files that the manifest names.

    ``start`` counts the ids of all documents before it; ``ids`` are the stored bytes.
    """
    order = Window.orderBy("task", "number").rowsBetween(Window.unboundedPreceding, -1)  # one row a file
    placed = manifest.withColumn("base", F.coalesce(F.sum("ids").over(order), F.lit(0)))
    step = settings.read_documents
    parts = placed.withColumn("first", F.explode(F.sequence(F.lit(0).cast("long"), F.col("documents") - 1, F.lit(step).cast("long"))))

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                reader = Reader(folder, row["file"])
                last = min(row["first"] + step, row["documents"])
                for low in range(row["first"], last, 256):
                    numbers = range(low, min(low + 256, last))
                    data = list(reader.ids(numbers.start, numbers.stop))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([reader.doc_id(n) for n in numbers], pa.int64()),
                            pa.array([row["base"] + int(reader.starts[n]) for n in numbers], pa.int64()),
                            pa.array([len(d) // 4 for d in data], pa.int64()),
                            pa.array(data, pa.binary()),
                        ],
                        ["doc_id", "start", "n_tokens", "ids"],
                    )

    # One task for each reading row: a number of partitions that is asked for is not coalesced.
    rows = manifest.agg(F.sum(F.ceil(F.col("documents") / step))).first()[0] or 1
    spread = parts.repartition(int(rows), F.col("task"), F.col("number"), F.col("first"))
    return spread.select("file", "documents", "base", "first").mapInArrow(freed(run), "doc_id long, start long, n_tokens long, ids binary")


def digest(docs: DataFrame, vocabulary: str, settings: Settings = Settings()) -> DataFrame:
    """Write the files of ``docs`` into the shared folder, read them back, and sum each
    document up: place, number of ids with the end id, and their CRC-32."""
    spark = docs.sparkSession
    folder = scratch_path(spark, "ids")
    rows = read(spark, folder, write(docs, vocabulary, folder, settings), settings)
    return rows.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
