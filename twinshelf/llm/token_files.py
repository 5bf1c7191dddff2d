"""Token ids in files of independent zstandard frames with a seek table.

A file is in the public seekable zstandard format: one frame for each document, a skippable
frame with the documents' ids, and last a skippable frame with the seek table: for each frame
its compressed size, its size and the low 32 bits of the XXH64 of its content. Any zstandard
reader can read such a file as a whole; ``read_documents`` reads the table from the end and
decompresses only the frames that are asked for, each checked against its checksum.

A frame holds the document's ids as little-endian unsigned 32-bit integers, the end id last.
Documents are dealt to files by ranges of their ids and written in ascending order. A task
writes under a name of its own and renames at the end, so a task that runs again, or twice at
once, leaves the same file.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
import zlib
from array import array
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import new_path, opened, shared_uri, stage
from .batches import chunks, remembered, slices, utf8

END = 2
#: Words and parts of words that a worker remembers before it starts anew.
WORDS, PARTS, LONGEST = 600_000, 600_000, 200
#: Bytes of text whose words are looked up in one go.
STRETCH = 4 << 20
#: Kinds of characters after letters, numbers and others (1 to 3).
WHITE, ODD = 4, 5

# Fixed values of the public seekable format.
SKIPPABLE_IDS, SKIPPABLE_TABLE, SEEKABLE, HAS_CHECKSUMS = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1, 0x80
ENTRY = np.dtype([("packed", "<u4"), ("size", "<u4"), ("checksum", "<u4")])
NO_ID = -(1 << 63)


class TokenEncoder:
    """Ids of texts by a byte-level tokenizer of the tokenizers library.

    A byte-level tokenizer of the GPT-2 kind cuts a text by a pattern before it merges, and the pattern starts
    anew where a single space follows another character. The different words between such spaces
    are therefore cut once, as an Arrow column, and their parts encoded by the library and remembered. Texts in which white space meets
    in a way that the pattern looks across are encoded whole. With ``added``, the strings of
    added tokens in a text are these tokens, as the library has it by default, and texts that
    hold one are encoded whole; else they are ordinary text.
    """

    _white = re.compile(r"\s(?= (?:\s|\Z))")
    _maybe = re.compile(rb"(?:[ \t-\r\x1c-\x1f]|[\x80-\xbf]) (?:[ \t-\r\x1c-\x1f\xc2\xe1-\xe3]|\Z)")

    def __init__(self, path: str, added: bool = False):
        self.path, self.added = path, added

    def _tokenizer(self):
        def load():
            from tokenizers import Tokenizer

            os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
            made = Tokenizer.from_file(self.path)
            made.encode_special_tokens = not self.added
            return made
        return remembered("token files", f"tokenizer {self.path} {self.added}", load)

    def _across(self, text: bytes) -> bool:
        """Whether white space meets in a way that the pattern looks across."""
        return bool(self._maybe.search(text)) and bool(self._white.search(text.decode()))

    def _held_whole(self) -> list[str]:
        if not self.added:
            return []
        return [t.content for t in self._tokenizer().get_added_tokens_decoder().values()]

    def _whole(self, texts: list[str]) -> list[bytes]:
        found = self._tokenizer().encode_batch_fast(texts, add_special_tokens=False)
        return [struct.pack(f"<{len(x.ids)}I", *x.ids) for x in found]

    def _kinds(self, points: np.ndarray) -> np.ndarray:
        """What the library's pattern takes each character for; it is asked once about each."""
        kinds = remembered("token files", f"kinds {self.path}", lambda: np.zeros(0x110000, np.uint8))
        seen = np.zeros(0x110000, bool)
        seen[points] = True
        cut = self._tokenizer().pre_tokenizer.pre_tokenize_str
        for point in np.flatnonzero(seen & (kinds == 0)).tolist():
            one = [len(cut(x + chr(point))) == 1 for x in "a1!"]
            kinds[point] = ODD if chr(point) == "'" or sum(one) > 1 else [*one, True].index(True) + 1
        return kinds[points]

    def _of_parts(self, found: list[bytes]) -> list[bytes]:
        """The ids of different parts of words.

        The library knows them in the byte alphabet, where a space is written as U+0120.
        """
        parts = remembered("token files", f"parts {self.path}", dict)
        alphabet = remembered("token files", "byte alphabet", byte_alphabet)
        if len(parts) >= PARTS:
            parts.clear()
        tokenize, out = self._tokenizer().model.tokenize, [parts.get(x) for x in found]
        for at, part in enumerate(found):
            if out[at] is None:
                if part[0] == 32 and part[1:].isalnum():  # of ASCII
                    ids = tokenize("\u0120" + part[1:].decode())
                else:
                    ids = tokenize(part.decode("latin-1").translate(alphabet))
                out[at] = array("I", [t.id for t in ids]).tobytes()
                if len(part) <= LONGEST:
                    parts[part] = out[at]
        return out

    def _by_library(self, words: list[bytes]) -> list[bytes]:
        """The ids of different words by the parts that the library cuts."""
        known = remembered("token files", f"words {self.path}", dict)
        if len(known) >= WORDS:
            known.clear()
        tokenizer, out = self._tokenizer(), [known.get(w) for w in words]
        tokenize, cut = tokenizer.model.tokenize, tokenizer.pre_tokenizer.pre_tokenize_str
        for at, word in enumerate(words):
            if out[at] is None:
                out[at] = array("I", [t.id for x, _ in cut(word.decode()) for t in tokenize(x)]).tobytes()
                if len(word) <= LONGEST:
                    known[word] = out[at]
        return out

    def _of_words(self, words: pa.BinaryArray) -> pa.BinaryArray:
        """The ids of different words.

        Letters, numbers or other characters beside each other are a part, before which the space
        goes if one stands before the word; so is a single white space. Words with more white space
        in a row or an apostrophe are cut by the library.
        """
        if not len(words):
            return pa.array([], pa.binary())
        raw, ends = _bytes_of(words)
        kinds = self._kinds(np.frombuffer(raw.decode().encode("utf-32-le"), "<i4"))
        places = np.append(np.flatnonzero(np.frombuffer(raw, np.uint8) & 0xC0 != 0x80), len(raw))
        first = np.searchsorted(places, ends)
        follows = np.ones(len(kinds), bool)
        follows[first[:-1]] = False
        before = np.roll(kinds, 1)
        odd = (kinds == ODD) | (follows & (kinds == WHITE) & (before == WHITE))
        plain = ~np.logical_or.reduceat(odd, first[:-1])
        starts = ~follows | (kinds != before)
        spaces = np.frombuffer(raw, np.uint8)[ends[:-1]] == 32
        starts[first[:-1][spaces & (np.diff(first) > 1)] + 1] = False
        if not plain.all():  # each odd word is one part
            starts &= np.repeat(plain, np.diff(first))
            starts[first[:-1]] = True
        at = np.flatnonzero(starts)
        rows = pa.BinaryArray.from_buffers(pa.binary(), len(at), [
            None, pa.py_buffer(np.append(places[at], len(raw)).astype(np.int32)), pa.py_buffer(raw)])
        own = np.append(np.searchsorted(at, first[:-1]), len(at))
        if plain.all():
            found = self._of_different(rows, self._of_parts)
        else:
            uncut = np.zeros(len(at), bool)
            uncut[own[:-1][~plain]] = True
            found = pa.concat_arrays([
                self._of_different(rows.filter(pa.array(~uncut)), self._of_parts),
                self._of_different(rows.filter(pa.array(uncut)), self._by_library),
            ]).take(pa.array(np.where(uncut, np.cumsum(uncut) + (~uncut).sum(), np.cumsum(~uncut)) - 1))
        _, sizes = _bytes_of(found)
        return pa.BinaryArray.from_buffers(pa.binary(), len(words), [
            None, pa.py_buffer(sizes[own].astype(np.int32)), found.buffers()[2]])

    def _of_different(self, rows: pa.BinaryArray, coded: Callable[[list[bytes]], list[bytes]]) -> pa.BinaryArray:
        """The ids of rows, of which ``coded`` gets different ones."""
        rows = rows.dictionary_encode()
        return pa.array(coded(rows.dictionary.to_pylist()), pa.binary()).take(rows.indices)

    def _by_words(self, texts: list[bytes]) -> list[bytes]:
        """Ids of texts that the pattern cuts at every space, by their different words."""
        line, begin = b"".join(texts), np.cumsum([0, *map(len, texts)])
        starts = np.frombuffer(line, np.uint8) == 32
        starts[begin[:-1]] = True
        starts = np.flatnonzero(starts)
        rows = pa.BinaryArray.from_buffers(pa.binary(), len(starts), [
            None, pa.py_buffer(np.append(starts, len(line)).astype(np.int32)), pa.py_buffer(line),
        ]).dictionary_encode()
        found = self._of_words(rows.dictionary).take(rows.indices)
        return slices(found.buffers()[2], _bytes_of(found)[1][np.searchsorted(starts, begin)])

    def encode(self, texts: list[str]) -> list[bytes]:
        """Each text's ids, little-endian 32-bit integers; an empty text has none."""
        return self.encode_bytes([t.encode() for t in texts])

    def encode_bytes(self, texts: list[bytes]) -> list[bytes]:
        """The same, of texts in UTF-8."""
        out: list[bytes] = [b""] * len(texts)
        strings = [x.encode() for x in self._held_whole()]
        plain = []
        for at, text in enumerate(texts):
            if any(x in text for x in strings) or self._across(text):
                out[at] = self._whole([text.decode()])[0]
            elif text:
                plain.append(at)
        if plain:
            for at, ids in zip(plain, self._by_words([texts[i] for i in plain])):
                out[at] = ids
        return out


def _bytes_of(column: pa.BinaryArray) -> tuple[bytes, np.ndarray]:
    """The bytes of all rows and the places where rows start and end, of a column that begins with its buffers."""
    ends = np.frombuffer(column.buffers()[1], "<i4", len(column) + 1)
    return (column.buffers()[2].to_pybytes()[:ends[-1]] if ends[-1] else b""), ends


def byte_alphabet() -> dict[int, str]:
    """The characters that stand for bytes in a byte-level vocabulary.

    Printable Latin-1 characters stand for themselves, the others in order for those from 256.
    """
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in own]
    return {b: chr(256 + i) for i, b in enumerate(others)}


def skippable(kind: int, content: bytes) -> bytes:
    return struct.pack("<II", kind, len(content)) + content


def write_file(uri: str, documents: Iterable[tuple[int | None, bytes]]) -> tuple[int, int]:
    """Write (id, ids as bytes) in the given order; returns the numbers of documents and ids."""
    fs, path = opened(uri)
    fs.create_dir(path.rpartition("/")[0])
    own = f"{path}.{uuid.uuid4().hex}"
    press = zstandard.ZstdCompressor(level=1)
    table, names, total = [], [], 0
    with fs.open_output_stream(own) as out:
        for name, blob in documents:
            frame = press.compress(blob)
            out.write(frame)
            table.append((len(frame), len(blob), xxhash.xxh64_intdigest(blob) & 0xFFFFFFFF))
            names.append(NO_ID if name is None else name)
            total += len(blob) // 4
        out.write(skippable(SKIPPABLE_IDS, np.array(names, "<i8").tobytes()))
        footer = struct.pack("<IBI", len(table), HAS_CHECKSUMS, SEEKABLE)
        out.write(skippable(SKIPPABLE_TABLE, np.array(table, ENTRY).tobytes() + footer))
    fs.move(own, path)
    return len(table), total


class TokenFile:
    """Random access to one file."""

    def __init__(self, uri: str):
        fs, path = opened(uri)
        self.file = fs.open_input_file(path)
        size = self.file.size()
        count, flags, magic = struct.unpack("<IBI", self.file.read_at(9, size - 9))
        if magic != SEEKABLE or flags != HAS_CHECKSUMS:
            raise ValueError(f"{uri} has no seek table")
        table = size - 9 - count * ENTRY.itemsize
        self.entries = np.frombuffer(self.file.read_at(count * ENTRY.itemsize, table), ENTRY)
        self.ids = np.frombuffer(self.file.read_at(8 * count, table - 8 - 8 * count), "<i8")
        self.starts = np.concatenate(([0], np.cumsum(self.entries["packed"].astype(np.int64))))

    def read(self, place: int) -> bytes:
        """The ids of the document at ``place``; an error if they are not what was written."""
        packed, size, checksum = (int(x) for x in self.entries[place])
        frame = self.file.read_at(packed, int(self.starts[place]))
        blob = zstandard.ZstdDecompressor().decompress(frame, max_output_size=size)
        if len(blob) != size or xxhash.xxh64_intdigest(blob) & 0xFFFFFFFF != checksum:
            raise ValueError(f"frame {place} does not match its checksum")
        return blob

    def close(self) -> None:
        self.file.close()


def read_documents(uri: str, wanted: Iterable[int]) -> Iterator[tuple[int, np.ndarray]]:
    """(id, token ids) of the wanted documents of one file, in file order."""
    file = TokenFile(uri)
    for place in np.flatnonzero(np.isin(file.ids, list(wanted))).tolist():
        yield int(file.ids[place]), np.frombuffer(file.read(place), "<u4")
    file.close()


def write(
    docs: DataFrame, tokenizer: str, folder: str, id_col: str = "doc_id", text_col: str = "text",
    end: int = END, added: bool = False,
) -> DataFrame:
    """Write the files; returns the manifest (file, path, n_docs, start, n_tokens).

    ``start`` is the number of ids in the files before. A null or empty text is its end id
    alone. Documents of equal id are ordered by their text's hash, those without an id come
    first. An empty table writes no file.
    """
    folder = shared_uri(docs.sparkSession, folder)
    encoder, tail = TokenEncoder(tokenizer, added), struct.pack("<I", end)

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def coded():
            for batch in batches:
                names, texts = batch.column(0).to_pylist(), utf8(batch.column(1))
                for part in chunks([len(t) for t in texts], STRETCH):
                    blobs = encoder.encode_bytes(texts[part])
                    yield from ((n, blob + tail) for n, blob in zip(names[part], blobs))

        rows = coded()
        first = next(rows, None)
        if first is None:
            return
        number = TaskContext.get().partitionId()
        path = f"{folder}/tokens-{number:06d}.zst"
        n_docs, n_tokens = write_file(path, (x for part in ([first], rows) for x in part))
        yield pa.RecordBatch.from_pydict({
            "file": pa.array([number], pa.int64()), "path": [path],
            "n_docs": pa.array([n_docs], pa.int64()), "n_tokens": pa.array([n_tokens], pa.int64())})

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"),
                       F.xxhash64(text_col).alias("hash"))
    ordered = rows.repartitionByRange("id", "hash").sortWithinPartitions("id", "hash")
    files = stage(ordered.select("id", "text").mapInArrow(
        save, "file long, path string, n_docs long, n_tokens long"), "token-manifest")
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    return files.select("file", "path", "n_docs", F.coalesce(
        F.sum("n_tokens").over(before), F.lit(0)).alias("start"), "n_tokens")


def read(manifest: DataFrame) -> DataFrame:
    """(id, start, n_tokens, ids_crc32) of every document, read from the files."""
    def load(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, start in zip(batch["path"], batch["start"]):
                file = TokenFile(path)
                sizes = file.entries["size"].astype(np.int64) // 4
                sums = [zlib.crc32(file.read(i)) for i in range(len(sizes))]
                file.close()
                yield pd.DataFrame({
                    "id": pd.array(file.ids, "Int64").copy(),
                    "start": start + np.cumsum(sizes) - sizes, "n_tokens": sizes,
                    "ids_crc32": np.array(sums, np.int64),
                }).assign(id=lambda x: x["id"].mask(x["id"] == NO_ID))

    # One file to a task; by number, as a manifest is too small to be kept apart otherwise.
    files = manifest.repartition(max(1, manifest.count()))
    return files.mapInPandas(load, "id long, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, tokenizer: str, **options) -> DataFrame:
    """Write to a new folder of the work folder, and read back."""
    return read(write(docs, tokenizer, new_path(docs.sparkSession, "token-files"), **options))
