"""SentencePiece encoding with seeded merge-dropout, and lossless decoding.

The model is a merge-type (BPE) one: a text starts as single characters, and the adjacent pair
whose joined piece has the best score is merged until none is left. With dropout each candidate
merge is skipped with probability ``rate`` when it enters the agenda. Whether it is skipped
depends on a hash keyed by the seed, a variant, the two pieces and their place in their run. Each
occurrence of a word draws its variant by a hash of the seed, the document's text and the word's
place in it, so a word is cut differently within one document and across documents, and the
same seed gives the same segmentation on every executor and every retry. Whatever is skipped,
the pieces' bytes are those of the text.

White space becomes U+2581, one of which stands before the text, as the model wants it. A
U+2581 of the text itself is written as byte pieces, so it comes back as it was. Characters
without a piece become byte pieces as well.

No piece joins certain neighbouring characters (a letter and a space, for instance); runs
between such places are segmented on their own. A stretch of text is an Arrow column of words, and
its different words, runs and variants of runs are found by Arrow and numpy. What a run comes to is
remembered, variant by variant as they are drawn; new runs of equal length are segmented together:
their agendas are the rows of an array. Long ones have a heap each.
"""

from __future__ import annotations

import heapq
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import by_parts, chunks, remembered, rested, slices, utf8

RATE, SEED, VARIANTS = 0.1, 17, 8
#: Bytes that a worker's memory of runs may take, and those of the longest words whose runs are in it.
REMEMBERED, LONGEST = 64 << 20, 200
#: Bytes of text whose words are looked up in one go.
STRETCH = 1 << 20
#: Ids that are decoded in one go.
DECODED = 1 << 18
#: The longest runs that are segmented together.
TOGETHER = 48
SPACE = "▁"

# Odd multipliers of a keyed 64-bit mixing function.
MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)
FULL = (1 << 64) - 1


def mixed(piece, place, left, key: int):
    """A keyed hash of a candidate merge: numbers, or arrays of unsigned 64-bit ones."""
    h = (piece * MIX[0] + place * MIX[1] + left * MIX[2] + key) & FULL
    for _ in range(2):
        h = ((h ^ (h >> 32)) * MIX[3]) & FULL
    return h ^ (h >> 32)


def mixed_arrays(piece: np.ndarray, place: np.ndarray, left: np.ndarray, key: np.ndarray) -> np.ndarray:
    u = np.uint64
    h = piece.astype(u) * u(MIX[0]) + place.astype(u) * u(MIX[1]) + left.astype(u) * u(MIX[2]) + key
    for _ in range(2):
        h = (h ^ (h >> u(32))) * u(MIX[3])
    return h ^ (h >> u(32))


class PieceModel:
    """Pieces, scores and byte pieces of a SentencePiece model file."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        normal, unknown, byte = 1, 2, 6  # fixed values: piece types of the file format
        self.ids, self.scores, self.bytes, self.byte_ids = {}, {}, [], [0] * 256
        for number, piece in enumerate(model.pieces):
            if piece.type == byte:
                value = int(piece.piece[3:-1], 16)
                self.byte_ids[value] = number
                self.bytes.append(bytes([value]))
            elif piece.type == normal:
                self.ids[piece.piece], self.scores[piece.piece] = number, piece.score
                self.bytes.append(piece.piece.replace(SPACE, " ").encode())
            else:
                self.bytes.append(b"")
        size = self.size = len(self.bytes)
        if any(b == SPACE and a != SPACE for p in self.ids for a, b in zip(p, p[1:])):
            raise ValueError("the model has pieces with a space behind another character")
        self.of_char = np.full(0x110000, -1, np.int32)
        self.score_of = np.full(size, -np.inf)
        merges, beside = {}, set()
        for piece, number in self.ids.items():
            self.score_of[number] = self.scores[piece]
            if len(piece) == 1:
                self.of_char[ord(piece)] = number
            for at in range(1, len(piece)):
                left, right = self.ids.get(piece[:at]), self.ids.get(piece[at:])
                if left is not None and right is not None:
                    merges[left * size + right] = number
            beside.update((ord(a) << 21) | ord(b) for a, b in zip(piece, piece[1:]))
        self.rank_of = np.unique(self.score_of, return_inverse=True)[1].astype(np.int32)
        self._place(merges)
        letters = sorted({x for pair in beside for x in (pair >> 21, pair & 0x1FFFFF)})
        self.letter = np.zeros(0x110000, np.int32)  # others are 0, and joined with nothing
        self.letter[letters] = np.arange(1, len(letters) + 1)
        self.beside = np.zeros((len(letters) + 1, len(letters) + 1), bool)
        pairs = np.array(sorted(beside), np.int64)
        self.beside[self.letter[pairs >> 21], self.letter[pairs & 0x1FFFFF]] = True
        self.binary = pa.array(self.bytes, pa.binary())

    def _place(self, merges: dict[int, int]) -> None:
        """Rows of the right pieces of each left one, laid over each other so that none meet.

        A cell holds the left piece and the joined one; the row of ``left`` starts at ``row``.
        """
        rows: dict[int, list[int]] = {}
        for pair in merges:
            rows.setdefault(pair // self.size, []).append(pair % self.size)
        width = 1 << (4 * len(merges) + 1024).bit_length()
        self.row = np.zeros(self.size + 1, np.int64)
        self.cells = np.full(width + self.size + 1, -1, np.int64)
        rng = np.random.default_rng(0)
        for left in sorted(rows, key=lambda x: (-len(rows[x]), x)):
            rights = np.array(rows[left])
            while (self.cells[(start := int(rng.integers(width))) + rights] >= 0).any():
                pass
            self.row[left] = start
            self.cells[start + rights] = (left << 32) + np.array(
                [merges[left * self.size + x] for x in rows[left]])

    def cuts(self, points: np.ndarray) -> np.ndarray:
        """For each character but the first, whether no piece joins it with the one before."""
        letter = self.letter[points]
        return ~self.beside[letter[:-1], letter[1:]]

    def candidates(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece that joins two, or -1; ``size`` stands for no piece."""
        found = self.cells[self.row[left] + right]
        return np.where(found >> 32 == left, found & 0xFFFFFFFF, -1)

    def segment_together(
        self, grid: np.ndarray, rate: float, key: np.ndarray,
    ) -> tuple[np.ndarray, np.ndarray]:
        """(ids in order, their number by row) of runs of one length, given as rows of character ids.

        ``key`` has the key of each row. Column a of the agenda holds the candidate that joins the piece at a with its follower.
        """
        n, length = grid.shape
        limit = rate * 2.0 ** 64
        width = length + 2  # a column without a piece on either side
        piece = np.full((n, width), self.size, np.int64)
        piece[:, 1:-1] = grid
        alive = np.zeros((n, width), bool)
        alive[:, 1:-1] = True
        after = np.tile(np.arange(1, width + 1), (n, 1))
        before = np.tile(np.arange(-1, width - 1), (n, 1))
        agenda, joins = np.full((n, width), -1, np.int32), np.full((n, width), -1, np.int64)
        piece, alive, after, before, queue, joins = (
            x.reshape(-1) for x in (piece, alive, after, before, agenda, joins))

        def offer(row: np.ndarray, first: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
            at = first + a
            found = self.candidates(piece[at], piece[first + b])
            rank = np.full(len(at), -1, np.int32)
            some = np.flatnonzero(found >= 0)
            if limit:
                hashes = mixed_arrays(found[some], a[some] - 1, (b - a)[some], key[row[some]])
                some = some[hashes.astype(np.float64) >= limit]
            rank[some] = self.rank_of[found[some]]
            queue[at], joins[at] = rank, found

        rows, places = np.repeat(np.arange(n), length - 1), np.tile(np.arange(1, length), n)
        offer(rows, rows * width, places, places + 1)
        row = np.arange(n)
        while len(row):
            a = agenda[row].argmax(axis=1)  # the leftmost of equal ones
            going = queue[row * width + a] >= 0
            row, a = row[going], a[going]
            first = row * width
            at = first + a
            there = first + after[at]
            piece[at], alive[there], queue[there] = joins[at], False, -1
            after[at] = c = after[there]
            before[first + c] = a
            offer(np.concatenate((row, row)), np.concatenate((first, first)),
                  np.concatenate((a, np.maximum(before[at], 0))), np.concatenate((c, a)))
        alive = alive.reshape(n, width)
        return piece.reshape(n, width)[alive], alive.sum(axis=1)

    def segment(self, run: str, rate: float, key: int) -> list[int]:
        """One run of any length: merge by score from a heap; equal scores from the left."""
        scores, limit = self.scores, rate * 2.0 ** 64
        pieces: list[str | None] = list(run)
        after = list(range(1, len(pieces) + 1))
        before = list(range(-1, len(pieces) - 1))
        agenda: list[tuple[float, int, int, str]] = []

        def offer(a: int, b: int) -> None:
            joined = pieces[a] + pieces[b]
            score = scores.get(joined)
            if score is not None and not (
                    limit and float(mixed(self.ids[joined], a, b - a, key)) < limit):
                heapq.heappush(agenda, (-score, a, b, joined))

        for a in range(len(pieces) - 1):
            offer(a, a + 1)
        while agenda:
            _, a, b, joined = heapq.heappop(agenda)
            if pieces[a] is None or pieces[b] is None or after[a] != b \
                    or len(pieces[a]) + len(pieces[b]) != len(joined):
                continue
            pieces[a], pieces[b] = joined, None
            after[a] = after[b]
            if after[a] < len(pieces):
                before[after[a]] = a
                offer(a, after[a])
            if before[a] >= 0:
                offer(before[a], a)
        out = []
        for piece in pieces:
            if piece is not None:
                number = self.ids.get(piece)
                out += [number] if number is not None else [
                    self.byte_ids[x] for x in piece.encode()]
        return out


def model_at(path: str) -> PieceModel:
    return remembered("pieces", f"model {path}", lambda: PieceModel(path))


class Words:
    """What the runs of words come to: ``index`` numbers them, and their ids by variant lie in one array."""

    #: Bytes of a run beside its characters and ids: the object, its number, the places in a dict.
    BESIDE = 160

    def __init__(self, variants: int):
        self.variants = variants
        self.clear()

    def clear(self) -> None:
        self.index: dict[bytes, int] = {}
        self.starts = np.full((1024, self.variants), -1, np.int32)
        self.sizes = np.zeros((1024, self.variants), np.int32)
        self.ids, self.used, self.held = np.empty(1 << 16, np.int32), 0, 0

    def bytes(self) -> int:
        return self.held + self.starts.nbytes + self.sizes.nbytes + self.ids.nbytes

    def numbers(self, runs: list[bytes]) -> np.ndarray:
        """The numbers of different runs; new ones get the next ones."""
        index = self.index
        before = len(index)
        found = np.fromiter((index.setdefault(x, len(index)) for x in runs), np.int64, len(runs))
        for i in np.flatnonzero(found >= before).tolist():
            self.held += self.BESIDE + len(runs[i])
        while len(index) > len(self.starts):
            self.starts = np.concatenate((self.starts, np.full_like(self.starts, -1)))
            self.sizes = np.concatenate((self.sizes, np.zeros_like(self.sizes)))
        return found

    def put(self, run: np.ndarray, variant: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> None:
        """Ids one run behind the other."""
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate((self.ids, np.empty_like(self.ids)))
        self.ids[self.used:self.used + len(ids)] = ids
        self.starts[run, variant] = self.used + np.cumsum(sizes) - sizes
        self.sizes[run, variant] = sizes
        self.used += len(ids)


def _gathered(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """flat[start:start + size] of all, one behind the other."""
    ends = np.cumsum(sizes, dtype=np.int64)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.repeat(starts - (ends - sizes), sizes) + np.arange(total)]


def _numbered(values: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """The different ones of values below ``limit``, and for each value its place among them."""
    seen = np.zeros(limit, bool)
    seen[values] = True
    return np.flatnonzero(seen), (np.cumsum(seen) - 1)[values]


class Encoder:
    """Encodes texts; remembers runs by variant."""

    _gap = re.compile(rb"(?<! ) ")

    def __init__(self, path: str, rate: float = RATE, seed: int = SEED, variants: int = VARIANTS):
        self.path, self.rate, self.seed = path, rate, seed
        self.variants = variants if rate else 1

    def _keys(self) -> np.ndarray:
        packed = [struct.pack("<QQ", self.seed % (1 << 64), v) for v in range(self.variants)]
        return np.array([xxhash.xxh64_intdigest(x) for x in packed], np.uint64)

    def _drawn(self, places: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """The variants of the words at ``places`` of texts with these keys."""
        none = np.zeros(1, np.int64)
        return ((mixed_arrays(none, places, none, keys) >> np.uint64(32)) % np.uint64(self.variants)
                ).astype(np.int64)

    def _stretches(self, text: bytes) -> Iterator[bytes]:
        """A text with the space before it, cut before words, about ``STRETCH`` bytes at a time."""
        start = 0
        while start < len(text):
            gap = self._gap.search(text, start + STRETCH)
            end = gap.start() if gap else len(text)
            yield text[start:end] if start else b" " + text[:end]
            start = end

    def _one(self, word: str, key: int) -> list[int]:
        """A word by itself: a long one, or one with the character that stands for a space."""
        model, out = model_at(self.path), []
        for literal, part in enumerate((" " + word).split(SPACE)):
            if literal:
                out += [model.byte_ids[x] for x in SPACE.encode()]
            if part:
                part = part.replace(" ", SPACE)
                points = np.frombuffer(part.encode("utf-32-le"), "<i4").astype(np.int64)
                ends = [0, *(np.flatnonzero(model.cuts(points)) + 1).tolist(), len(part)]
                for a, b in zip(ends, ends[1:]):
                    out += model.segment(part[a:b], self.rate, key)
        return out

    def _new(self, runs: pa.BinaryArray, which: np.ndarray, variant: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of these runs, given as code points, in their variants, and how many each has."""
        model, keys = model_at(self.path), self._keys()
        ends = np.frombuffer(runs.buffers()[1], "<i4", len(runs) + 1, 4 * runs.offset) // 4
        points = np.frombuffer(runs.buffers()[2], "<i4") if ends[-1] else np.empty(0, "<i4")
        first, lengths = ends[:-1][which], np.diff(ends)[which]
        starts, sizes = np.zeros(len(which), np.int64), np.zeros(len(which), np.int64)
        parts, used = [], 0
        for length in np.unique(lengths).tolist():
            where = np.flatnonzero(lengths == length)
            odd = where
            if length <= TOGETHER:
                grid = model.of_char[points[first[where, None] + np.arange(length)]]
                plain = (grid >= 0).all(axis=1)
                odd = where[~plain]
                for at in np.array_split(np.flatnonzero(plain), max(1, plain.sum() * length // 100_000)):
                    ids, n = model.segment_together(grid[at], self.rate, keys[variant[where[at]]])
                    parts.append(ids.astype(np.int32))
                    starts[where[at]], sizes[where[at]] = used + np.cumsum(n) - n, n
                    used += len(ids)
            for at in odd.tolist():
                run = points[first[at]:first[at] + length].tobytes().decode("utf-32-le")
                found = model.segment(run, self.rate, int(keys[variant[at]]))
                parts.append(np.array(found, np.int32))
                starts[at], sizes[at] = used, len(found)
                used += len(found)
        return _gathered(np.concatenate([np.empty(0, np.int32), *parts]), starts, sizes), sizes

    def _of_runs(self, memory: Words, runs: pa.BinaryArray, run: np.ndarray, variant: np.ndarray,
                 ) -> tuple[np.ndarray, np.ndarray]:
        """(ids, how many each has) of runs in variants, some more than once."""
        wanted, code = _numbered(run * self.variants + variant, len(runs) * self.variants)
        which, draw = wanted // self.variants, wanted % self.variants
        number = memory.numbers(runs.to_pylist())[which]
        lacks = np.flatnonzero(memory.starts[number, draw] < 0)
        if len(lacks):
            ids, sizes = self._new(runs, which[lacks], draw[lacks])
            memory.put(number[lacks], draw[lacks], ids, sizes)
        sizes = memory.sizes[number, draw][code]
        return _gathered(memory.ids, memory.starts[number, draw].astype(np.int64)[code], sizes), sizes

    def _of_words(self, memory: Words, words: pa.BinaryArray, word: np.ndarray, variant: np.ndarray,
                  ) -> tuple[np.ndarray, np.ndarray]:
        """(ids, how many each has) of words in variants; they are given with the space before them."""
        if not len(word):
            return np.empty(0, np.int32), np.empty(0, np.int64)
        model = model_at(self.path)
        ends = np.frombuffer(words.buffers()[1], "<i4", len(words) + 1, 4 * words.offset)
        raw = words.buffers()[2].to_pybytes()[:ends[-1]]
        points = np.frombuffer(raw.decode().encode("utf-32-le"), "<i4").copy()
        points[points == 32] = ord(SPACE)
        begins = np.frombuffer(raw, np.uint8) & 0xC0 != 0x80  # of characters
        place = np.concatenate(([0], np.cumsum(begins)))[ends]
        cut = np.concatenate(([True], model.cuts(points), [True]))
        cut[place] = True
        ends = np.flatnonzero(cut)
        rows = pa.BinaryArray.from_buffers(pa.binary(), len(ends) - 1, [
            None, pa.py_buffer((4 * ends).astype(np.int32)), pa.py_buffer(points)]).dictionary_encode()
        runs, of_run = rows.dictionary, rows.indices.to_numpy()
        first = np.searchsorted(ends, place)
        count = np.diff(first)[word]
        at = _gathered(of_run, first[:-1][word], count).astype(np.int64)
        ids, sizes = self._of_runs(memory, runs, at, np.repeat(variant, count))
        owner = np.repeat(np.arange(len(word)), count)
        return ids, np.bincount(owner, weights=sizes, minlength=len(word)).astype(np.int64)

    def _looked_up(self, memory: Words, line: bytes, starts: np.ndarray, variant: np.ndarray,
                   ) -> tuple[np.ndarray, np.ndarray]:
        """(ids, how many each has) of the words of ``line`` that start there."""
        if memory.bytes() > REMEMBERED:
            memory.clear()
        ends = np.append(starts, len(line)).astype(np.int32)
        rows = pa.BinaryArray.from_buffers(pa.binary(), len(starts), [
            None, pa.py_buffer(ends), pa.py_buffer(line)]).dictionary_encode()
        words = rows.dictionary
        wanted, code = _numbered(rows.indices.to_numpy().astype(np.int64) * self.variants + variant,
                                 len(words) * self.variants)
        word, draw = wanted // self.variants, wanted % self.variants
        odd = np.array(pc.match_substring(words, SPACE)) | (np.array(pc.binary_length(words)) > LONGEST)
        sizes = np.zeros(len(wanted), np.int64)
        plain = np.flatnonzero(~odd[word])
        others = np.flatnonzero(odd[word])
        own = np.cumsum(~odd) - 1
        ids, sizes[plain] = self._of_words(
            memory, words.filter(pa.array(~odd)) if len(others) else words, own[word[plain]], draw[plain])
        keys, more, used = self._keys(), [ids], len(ids)
        firsts = np.zeros(len(wanted), np.int64)
        firsts[plain] = np.cumsum(sizes[plain]) - sizes[plain]
        for i in others.tolist():
            found = self._one(words[int(word[i])].as_py()[1:].decode(), int(keys[draw[i]]))
            firsts[i], sizes[i] = used, len(found)
            more.append(np.array(found, np.int32))
            used += len(found)
        return _gathered(np.concatenate(more), firsts[code], sizes[code]), sizes[code]

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(the ids of all texts one behind the other, how many each has)."""
        memory = remembered("pieces", "words", lambda: Words(self.variants),
                            (self.path, self.rate, self.seed, self.variants))
        parts, counts = [np.empty(0, np.int32)], np.zeros(len(texts), np.int64)
        held: list[tuple[int, int, int, bytes]] = []

        def flush() -> int:
            """The number of words in the last part; words start at spaces behind other characters."""
            owner, key, place, line = zip(*held)
            begin = np.cumsum([0, *map(len, line[:-1])])
            line = b"".join(line)
            space = np.frombuffer(line, np.uint8) == 32
            starts = space.copy()
            starts[1:] &= ~space[:-1]
            starts[begin] = True
            starts = np.flatnonzero(starts)
            first = np.searchsorted(starts, begin)
            many = np.diff(np.append(first, len(starts)))
            places = np.arange(len(starts)) + np.repeat(np.array(place) - first, many)
            variant = self._drawn(places, np.repeat(np.array(key, np.uint64), many))
            ids, sizes = self._looked_up(memory, line, starts, variant)
            parts.append(ids)
            np.add.at(counts, np.repeat(owner, many), sizes)
            held.clear()
            return int(many[-1])

        size = 0
        for at, text in enumerate(texts):
            place, key = 0, xxhash.xxh64_intdigest(text, self.seed % (1 << 64))
            for part in self._stretches(text):
                held.append((at, key, place, part))
                size += len(part)
                if size >= STRETCH:  # as each part of a text is but the last
                    place += flush()
                    size = 0
        if held:
            flush()
        return np.concatenate(parts), counts


class Decoder:
    def __init__(self, path: str):
        self.path = path

    def decode(self, ids: np.ndarray) -> bytes:
        """The text's bytes: those of the pieces without the space that stands before it."""
        return self.decode_all(ids, np.array([0, len(ids)]))[0].as_py()

    def decode_all(self, flat: np.ndarray, ends: np.ndarray) -> pa.BinaryArray:
        """The texts of the ids between neighbouring ``ends``."""
        out, pieces = [pa.array([], pa.binary())], model_at(self.path).binary
        for part in chunks(np.diff(ends).tolist(), DECODED):
            own = ends[part.start:part.stop + 1]
            found = pieces.take(pa.array(flat[own[0]:own[-1]]))
            places = np.frombuffer(found.buffers()[1], "<i4", len(found) + 1)[own - own[0]]
            out.append(pa.array(slices(found.buffers()[2], places, 1), pa.binary()))
        return pa.concat_arrays(out)


def encode(
    docs: DataFrame, model: str, text_col: str = "text", ids_col: str = "piece_ids",
    rate: float = RATE, seed: int = SEED, variants: int = VARIANTS, lossless_col: str | None = None,
) -> DataFrame:
    """``docs`` with the ids of the text's pieces; null and empty texts have no ids.

    ``ids_col`` replaces a column of that name. ``rate`` 0 gives the model's own segmentation.
    With ``lossless_col`` the ids are decoded as well, and it says whether the text came back; so
    decoded texts do not leave the worker, which has those of one part at a time. Equal texts have equal ids, repeated rows stay, and texts of any length are encoded whole, a
    stretch of words at a time. An empty table gives an empty one.
    """
    encoder, decoder = Encoder(model, rate, seed, variants), Decoder(model)

    def coded(part: pa.Array) -> tuple[pa.Array, pa.Array | None]:
        texts = utf8(part)
        flat, counts = encoder.encode(texts)
        ends = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
        same = lossless_col and pc.equal(decoder.decode_all(flat, ends), pa.array(texts, pa.binary()))
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)), same

    if lossless_col is None:
        return docs.withColumn(ids_col, by_parts("array<int>")(lambda part: coded(part)[0])(F.col(text_col)))

    @by_parts("struct<ids:array<int>,lossless:boolean>")
    def run(part: pa.Array) -> pa.Array:
        return pa.StructArray.from_arrays(coded(part), names=["ids", "lossless"])

    mark = "_coded"
    while mark in docs.columns:
        mark += "_"
    return docs.withColumn(mark, run(F.col(text_col))).withColumns(
        {ids_col: F.col(f"{mark}.ids"), lossless_col: F.col(f"{mark}.lossless")}).drop(mark)


def decode(
    docs: DataFrame, model: str, ids_col: str = "piece_ids", text_col: str = "decoded",
) -> DataFrame:
    """``docs`` with the text of the ids; no ids give an empty text.

    ``text_col`` replaces a column of that name. Null ids count as none.
    """
    decoder = Decoder(model)

    @F.arrow_udf("string")
    @rested
    def run(column: pa.Array) -> pa.Array:
        ends = column.offsets.to_numpy()
        flat = column.values.to_numpy()
        return decoder.decode_all(flat, ends).cast(pa.string())

    return docs.withColumn(text_col, run(F.col(ids_col)))
