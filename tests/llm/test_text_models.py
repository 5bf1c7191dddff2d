"""Pieces, token files, context-tree weighting, language and toxicity."""

import math
import random
import time
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from twinshelf.llm import batches, ctw, language, pieces, queries, token_files, toxicity

PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [
    None, "", " ", "  ", "\n", "hello world", "  two  spaces   three ", "▁under ▁ ▁▁", "tab\there",
    "Straße ñandú 漢字 😀 \u200b", "a" * 300, "word, word. word! (word) 1234 1,000", " lead", "trail ",
    "line\n\n\nbreaks \n mixed\r\n", "nul \x00 byte", "\x1c\x1d \x85 \u00a0 \u3000 end",
    "it's don't we'll <|endoftext|> </s> <unk>", "x\u0301 combining", "one two " * 2000,
    "a  b", "a   b", "a \n b", "a\n  \nb", "½ ² ٣ Ⅷ", "end. Start,next;more:", "\u00a0  b",
]


def frame(spark, texts=TEXTS):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_pieces_decode_to_the_text(spark):
    for options in ({}, {"rate": 0.5, "seed": 1}, {"rate": 1.0}, {"rate": 0.0}):
        coded = pieces.encode(frame(spark).withColumn("piece_ids", F.lit("clash")), PIECES, **options)
        back = pieces.decode(coded, PIECES).collect()
        assert [r["decoded"] for r in back] == [t or "" for t in TEXTS]


def test_pieces_say_whether_the_text_comes_back(spark, monkeypatch):
    docs = frame(spark).withColumns({"_coded": F.lit(1), "same": F.lit("clash")})
    found = pieces.encode(docs, PIECES, lossless_col="same")
    assert found.columns == ["doc_id", "text", "_coded", "same", "piece_ids"]
    plain = pieces.encode(frame(spark), PIECES).collect()
    assert [(r["piece_ids"], r["same"]) for r in found.collect()] == [(r["piece_ids"], True) for r in plain]
    assert pieces.encode(frame(spark, []), PIECES, lossless_col="same").count() == 0
    whole = pieces.Decoder.decode_all
    monkeypatch.setattr(pieces.Decoder, "decode_all", lambda self, flat, ends: whole(self, np.sort(flat), ends))
    wrong = pieces.encode(frame(spark, ["b a", None, "a"]), PIECES, lossless_col="same")
    assert [r["same"] for r in wrong.collect()] == [False, True, True]


def test_pieces_without_dropout_are_the_models_own(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    got = pieces.encode(frame(spark), PIECES, rate=0.0).collect()
    for r in got:
        if "▁" not in (r["text"] or ""):
            assert list(r["piece_ids"]) == library.encode(r["text"] or ""), r["text"]


def test_pieces_vary_with_the_seed_only(spark):
    words = " ".join(["international understanding of complicated arrangements"] * 3)
    docs = frame(spark, [words + str(i) for i in range(12)])
    runs = [[list(r["piece_ids"]) for r in pieces.encode(
        docs.repartition(n), PIECES, rate=0.3, seed=s).orderBy("doc_id").collect()]
        for s, n in ((1, 1), (1, 5), (2, 1))]
    assert runs[0] == runs[1] != runs[2]
    assert len({tuple(x[:8]) for x in runs[0]}) > 1  # variants


def plain_segments(model, run, rate, key):
    """Merge the best candidate that is not skipped, one at a time, by a list."""
    spans = [(i, c) for i, c in enumerate(run)]
    decided = {}

    def candidate(left, right):
        joined = left[1] + right[1]
        if joined not in model.ids:
            return None
        at = (left[0], right[0], joined)
        if at not in decided:
            h = pieces.mixed(model.ids[joined], left[0], right[0] - left[0], key)
            decided[at] = float(h) < rate * 2.0 ** 64
        return None if decided[at] else (-model.scores[joined], left[0])

    while True:
        offers = [(o, i) for i in range(len(spans) - 1) if (o := candidate(spans[i], spans[i + 1]))]
        if not offers:
            return [n for _, piece in spans for n in (
                [model.ids[piece]] if piece in model.ids else [model.byte_ids[x] for x in piece.encode()])]
        _, i = min(offers)
        spans[i:i + 2] = [(spans[i][0], spans[i][1] + spans[i + 1][1])]


@pytest.mark.parametrize("rate", [0.0, 0.1, 0.5])
def test_agendas_equal_a_plain_merge(rate):
    model, rng = pieces.PieceModel(PIECES), random.Random(6)
    letters = [c for c in "etaoinshrdlu" if c in model.ids]
    for length in (1, 2, 5, 9, 14):
        runs = ["".join(rng.choices(letters, k=length)) for _ in range(60)]
        keys = np.array([rng.getrandbits(64) for _ in runs], np.uint64)
        points = np.array([[ord(c) for c in r] for r in runs])
        ids, sizes = model.segment_together(model.of_char[points], rate, keys)
        ends = np.cumsum(sizes)
        for run, key, a, b in zip(runs, keys.tolist(), [0, *ends], ends):
            expected = plain_segments(model, run, rate, key)
            assert ids[a:b].tolist() == expected == model.segment(run, rate, key)


def test_a_word_varies_within_a_document(spark):
    word = "internationalisation"
    row = pieces.encode(frame(spark, [" ".join([word] * 200)]), PIECES, rate=0.3).first()
    cuts, held, said = set(), (), ""
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for number in row["piece_ids"]:
        held, said = (*held, number), said + library.id_to_piece(number)
        if said == "▁" + word:
            cuts.add(held)
            held, said = (), ""
    assert 2 < len(cuts) <= pieces.VARIANTS


def test_pieces_do_not_depend_on_stretches_or_memory(monkeypatch):
    rng = random.Random(8)
    texts = [x.encode() for x in TEXTS if x] + [
        "".join(rng.choice(["ab", " ", "  ", "word", "x,", "é", "▁"]) for _ in range(400)).encode()
        for _ in range(30)]
    whole = [pieces.Encoder(PIECES, 0.2, 3).encode([t])[0].tolist() for t in texts]
    monkeypatch.setattr(pieces, "STRETCH", 60)
    monkeypatch.setattr(pieces, "REMEMBERED", 300_000)
    flat, counts = pieces.Encoder(PIECES, 0.2, 3).encode(texts)
    assert flat.tolist() == sum(whole, []) and counts.tolist() == [len(x) for x in whole]


def test_memory_of_words_is_bounded():
    words = pieces.remembered("pieces", "words", lambda: pieces.Words(pieces.VARIANTS), (PIECES, 0.1, 17, pieces.VARIANTS))
    encoder, rng = pieces.Encoder(PIECES), random.Random(9)
    for _ in range(3):
        encoder.encode([" ".join(f"{rng.getrandbits(40):x}" for _ in range(90_000)).encode()])
    assert words.bytes() < pieces.REMEMBERED + (64 << 20)


def test_runs_are_segmented_once_whatever_stands_beside_them(monkeypatch):
    asked, plain = [], pieces.PieceModel.segment_together

    def counted(self, grid, *rest):
        asked.append(len(grid))
        return plain(self, grid, *rest)

    monkeypatch.setattr(pieces.PieceModel, "segment_together", counted)
    encoder, names = pieces.Encoder(PIECES, 0.0, 5), ["onerndinge", "thlyinga", "beshaanes"]
    encoder.encode([" ".join(names).encode()])
    assert sum(asked) == 3
    for mark in (".", ",", ";"):
        asked.clear()
        flat, _ = encoder.encode([(mark + " ").join(names).encode() + mark.encode()])
        assert sum(asked) == 1  # the mark; words with other marks were segmented again before
        assert pieces.Decoder(PIECES).decode(flat).decode() == (mark + " ").join(names) + mark


def test_pieces_of_an_empty_table(spark):
    none = frame(spark, [])
    assert pieces.decode(pieces.encode(none, PIECES), PIECES).count() == 0


def test_token_files_equal_the_library(spark):
    library = Tokenizer.from_file(BYTES)
    library.encode_special_tokens = True
    rng = random.Random(4)
    marks = [" ", "  ", "\n", "\t", ",", ".", "'s", "a", "ñb", "7", "\u00a0", "\x1c", "漢", "!", "Word"]
    texts = TEXTS + ["".join(rng.choice(marks) for _ in range(rng.randint(1, 40))) for _ in range(300)]
    docs = frame(spark, texts).withColumn("start", F.lit("clash"))
    got = sorted(map(tuple, token_files.round_trip(docs, BYTES).collect()))
    expected, start = [], 0
    for i, text in enumerate(texts):
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        expected.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert got == expected


def test_token_files_with_added_tokens_equal_the_library(spark, tmp_path):
    library = Tokenizer.from_file(BYTES)
    texts = [*TEXTS, "<|endoftext|>", "one <|endoftext|>two", "a<|endoftext|> <|endoftext|>\n b", "<|endoftext"]
    frame(spark, texts).coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted(map(tuple, queries.op9_token_files(spark, str(tmp_path)).collect()))
    expected, start = [], 0
    for i, text in enumerate(texts):
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        expected.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert got == expected and 50256 in library.encode(texts[-4], add_special_tokens=False).ids


def test_words_are_cut_without_asking_the_library_about_each(monkeypatch):
    plain, asked = Tokenizer.from_file(BYTES), []

    class Counting:
        """The tokenizer, with a list of the strings that it was to cut."""
        model, pre_tokenizer = plain.model, None
        encode_batch_fast, get_added_tokens_decoder = plain.encode_batch_fast, plain.get_added_tokens_decoder

        def pre_tokenize_str(self, text):
            asked.append(text)
            return plain.pre_tokenizer.pre_tokenize_str(text)

    counting = Counting()
    counting.pre_tokenizer = counting
    monkeypatch.setattr(token_files.TokenEncoder, "_tokenizer", lambda self: counting)
    rng = random.Random(12)
    words = ["a" + "".join(rng.choice("ab1é.\u0301\n") for _ in range(6)) for _ in range(3000)]
    texts = [" ".join(words[a:a + 100]) for a in range(0, 3000, 100)] + ["don't we'll ", "\u3000x \u00a0y", " a", "\n"]
    got = token_files.TokenEncoder(BYTES, True).encode(texts)
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == [
        plain.encode(t, add_special_tokens=False).ids for t in texts]
    odd = {w for w in words if "\n\n" in w}
    assert len([x for x in asked if len(x) > 3]) <= len(odd) + 5 < 600  # all words with marks or digits before


def test_a_resting_worker_gives_back_what_it_kept(monkeypatch):
    monkeypatch.setattr(batches, "REST", 0.3)
    made = []
    work = batches.rested(lambda x: batches.remembered("resting test", "words", lambda: made.append(x) or {}))
    work(1), work(2)
    assert made == [1]  # kept from one to the next
    time.sleep(1.5)
    work(3)
    assert made == [1, 3]  # was kept for ever before
    slow = batches.rested(lambda x: (time.sleep(1.0), work(x)))
    slow(4)
    assert made == [1, 3]  # a busy worker keeps it


def test_results_leave_a_worker_part_by_part(spark):
    seen = []
    lengths = batches.by_parts("long", 10)(
        lambda part: seen.append(len(part)) or pc.fill_null(pc.binary_length(part), 0).cast("int64"))
    columns = [pa.array(["abcde"] * 5 + [None, "x" * 50, "", "y"]), pa.array([], pa.string()), pa.array(["z"])]
    stream = lengths.func(iter(columns))
    assert next(stream).to_pylist() == [5, 5] and seen == [2]  # the rest of the column is still to come
    assert [n for part in stream for n in part.to_pylist()] == [5, 5, 5, 0, 50, 0, 1, 1]
    texts = [None, "", "ab", "x" * 30] * 500
    plain = batches.by_parts("long", 10)(lambda part: pc.fill_null(pc.binary_length(part), 0).cast("int64"))
    got = frame(spark, texts).select("doc_id", plain(F.col("text")).alias("n")).collect()
    assert dict(got) == {i: len(t or "") for i, t in enumerate(texts)}


def test_a_generator_at_work_keeps_its_memory(monkeypatch):
    monkeypatch.setattr(batches, "REST", 0.3)
    made = []

    @batches.rested
    def work(columns):
        for x in columns:
            yield batches.remembered("generator test", "words", lambda: made.append(x) or {})

    stream = work(iter([1, 2]))
    next(stream)
    time.sleep(1.0)
    assert list(stream) and made == [1]  # between two parts it is still at work
    time.sleep(1.5)
    assert list(work(iter([3]))) and made == [1, 3]


def test_token_files_read_one_document_and_notice_damage(tmp_path):
    path = str(tmp_path / "deep" / "x.zst")
    blobs = [(i, np.arange(i * 10, dtype="<u4").tobytes()) for i in (3, 5, 8)] + [(None, b"")]
    assert token_files.write_file(path, blobs) == (4, 160)
    assert [(i, ids.tolist()) for i, ids in token_files.read_documents(path, [5])] == [
        (5, list(range(50)))]
    file = token_files.TokenFile(path)
    assert file.ids.tolist() == [3, 5, 8, token_files.NO_ID] and file.read(3) == b""
    file.close()
    import zstandard
    with open(path, "rb") as raw:  # any zstandard reader reads the whole
        whole = zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True).read()
    assert whole == b"".join(b for _, b in blobs)
    data = bytearray(open(path, "rb").read())
    data[len(data) - 9 - 4 * 12 + 8] ^= 1  # the first frame's checksum
    open(path, "wb").write(data)
    with pytest.raises(ValueError):
        token_files.TokenFile(path).read(0)


def test_token_files_of_nothing_and_of_repeated_rows(spark):
    empty = frame(spark, [])
    assert token_files.round_trip(empty, BYTES).count() == 0
    rows = spark.createDataFrame([(1, "b")] * 3 + [(None, "c")], "doc_id long, text string")
    got = sorted(map(tuple, token_files.round_trip(rows, BYTES).collect()), key=lambda r: r[1])
    assert [r[:3] for r in got] == [(None, 0, 2), (1, 2, 2), (1, 4, 2), (1, 6, 2)]


class PlainTree:
    """Context-tree weighting one bit at a time."""

    def __init__(self, depth):
        self.depth, self.count, self.children = depth, {}, {}

    def paths(self, text):
        line = bytes(self.depth) + text + b"\xff"
        for at in range(self.depth, len(line)):
            context = line[at - self.depth:at][::-1]
            for bit in range(8):
                yield [(context[:d], bit, line[at] >> (8 - bit)) for d in range(self.depth + 1)], \
                    line[at] >> (7 - bit) & 1

    def learn(self, text):
        for path, bit in self.paths(text):
            for node, below in zip(path, path[1:] + [None]):
                self.count.setdefault(node, [0, 0])[bit] += 1
                if below:
                    self.children.setdefault(node, set()).add(below)

    def own(self, node):
        a, b = self.count.get(node, (0, 0))
        return math.lgamma(a + .5) + math.lgamma(b + .5) - math.lgamma(a + b + 1) - math.log(math.pi)

    def weighted(self, node):
        if node not in self.memo:
            own = self.own(node)
            if len(node[0]) < self.depth:
                below = sum(self.weighted(c) for c in self.children.get(node, ()))
                own = np.logaddexp(own, below) - math.log(2)
            self.memo[node] = own
        return self.memo[node]

    def log10(self, text):
        self.memo, total = {}, 0.0
        for path, bit in self.paths(text):
            q = 0.5
            for node in reversed(path):
                a, b = self.count.get(node, (0, 0))
                p = ((b if bit else a) + .5) / (a + b + 1)
                w = 1.0 if len(node[0]) == self.depth else math.exp(
                    self.own(node) - math.log(2) - self.weighted(node))
                q = w * p + (1 - w) * q
            total += math.log10(q)
        return total


def test_context_trees_equal_the_plain_ones(spark, monkeypatch):
    rng = random.Random(8)
    words = ["the", "then", "Thin", "ñu", "of", "off"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 25))) for _ in range(20)]
    texts += [None, "", "\x00\x00", "quite new", "a" * 400, texts[0], texts[0]]
    rows = [(i, t, None if i == 2 else i % 4 == 1) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, held_out boolean")
    got = {r["id"]: r for r in ctw.score(docs, depth=3, block=200).collect()}
    tree, counts, n_train = PlainTree(3), {}, 0
    lower = [(t or "").encode().lower() for t in texts]
    for (_, _, held), text in zip(rows, lower):
        if held is False:
            tree.learn(text)
            for token in [*text.split(), None]:
                counts[token] = counts.get(token, 0) + 1
                n_train += 1
    assert len(got) == len(texts)
    for (i, _, held), text in zip(rows, lower):
        tokens = [*text.split(), None]
        base = sum(math.log10((counts.get(t, 0) + .5) / (n_train + .5 * (len(counts) + 1)))
                   for t in tokens)
        r = got[i]
        assert (r["held_out"], r["n_tokens"], r["train_tokens"]) == (held is not False, len(tokens), n_train)
        assert r["n_known"] == sum(t in counts for t in tokens)
        assert r["base_score"] == pytest.approx(base, abs=1e-9)
        assert r["score"] == pytest.approx(tree.log10(text), rel=1e-5, abs=1e-5)


def test_context_trees_without_training_or_rows(spark):
    kind = "doc_id long, text string, held_out boolean"
    alone = ctw.score(spark.createDataFrame([(1, "ab", True)], kind)).first()
    assert alone["score"] == pytest.approx(24 * math.log10(0.5)) and alone["train_tokens"] == 0
    assert ctw.score(spark.createDataFrame([], kind)).count() == 0


def plain_phrases(sample, text):
    count = at = 0
    while at < len(text):
        size = 0
        while at + size < len(text) and text[at:at + size + 1] in sample:
            size += 1
        count, at = count + 1, at + max(1, size)
    return count


def test_phrases_equal_the_plain_parse():
    rng = random.Random(6)
    sample = bytes(rng.choice(b"abcd ") for _ in range(300))
    parser = language.CrossParser(sample)
    texts = [bytes(rng.choice(b"abcdx ") for _ in range(rng.randint(0, 3000))) for _ in range(25)]
    got = language.rates(parser, texts) * [max(1, len(t)) for t in texts]
    expected = [sum(plain_phrases(sample, t[a:a + language.STRETCH])
                    for a in range(0, len(t), language.STRETCH)) for t in texts]
    assert got.round().astype(int).tolist() == expected


def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    train = docs.filter("doc_id % 3 != 1")
    model = language.fit(train)
    odd = spark.createDataFrame([(-1, None), (-2, ""), (-3, "123 ... !!"), (-4, "ñ")], "doc_id long, text string")
    rows = docs.filter("doc_id % 3 = 1").select("doc_id", "text", "lang").unionByName(
        odd.withColumn("lang", F.lit("und")))
    got = rows.select("doc_id", "lang", language.predicted(spark, model, "text").alias("p")).collect()
    right = [r["p"]["lang"] == r["lang"] for r in got if r["doc_id"] >= 0]
    assert sum(right) >= 0.98 * len(right)
    assert all(0 <= r["p"]["score"] <= 1 for r in got)
    assert [r["p"]["lang"] for r in got if -4 < r["doc_id"] < 0] == ["und"] * 3
    kept = language.identified(odd.withColumn("_language", F.lit(1)), model)
    assert kept.columns == ["doc_id", "text", "_language"] and {r[0] for r in kept.collect()} <= {-4}


def invented(seed, syllables, words=300):
    """A function that makes texts of one invented language."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(words)]
    return lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))


def test_rare_languages_are_recognised(spark):
    common = invented(1, ["th", "er", "on", "an", "re", "he", "in", "ed"])
    rare = invented(2, ["ka", "lu", "mi", "po", "tse", "nga"])
    copied = invented(3, ["gwy", "dd", "llo", "fa", "wr", "yn"])
    once = copied(80)
    rows = [(common(90), "aa") for _ in range(100)] + [(rare(90), "bb") for _ in range(3)]
    rows += [(once, "cc")] * 2_000 + [(copied(90), "cc") for _ in range(6)] + [("qq zz 7", "dd"), ("...", "ee")]
    model = language.fit(spark.createDataFrame(rows, "text string, lang string"))
    assert model.languages == ["aa", "bb", "cc", "dd"]
    asked = [(make(60), name) for make, name in ((common, "aa"), (rare, "bb"), (copied, "cc")) for _ in range(20)]
    docs = spark.createDataFrame(asked, "text string, lang string")
    got = docs.select("lang", language.predicted(spark, model, "text").alias("p")).collect()
    assert [r["p"]["lang"] for r in got] == [r["lang"] for r in got]
    assert language.identified(docs, model).count() == len(asked)


def test_language_is_learnt_from_all_parts_of_texts(spark):
    head, tail = invented(1, ["th", "er", "on", "an"]), invented(2, ["ka", "lu", "mi", "po"])
    rows = [(f"{head(300)} {tail(3_000)}", "bb") for _ in range(40)] + [(head(300), "aa") for _ in range(40)]
    docs = spark.createDataFrame(rows, "text string, lang string")
    model = language.fit(docs)
    assert sorted(model.texts) == sorted(language.fit(docs.repartition(5)).texts)
    assert model.predict([tail(100)])[0][0] == "bb"
    longest = " ".join([tail(2_000)] * 400)
    assert len(longest) > 4_000_000 and model.predict([longest, head(50)])[0][0] == "bb"


def test_language_without_labels(spark):
    docs = spark.createDataFrame([(1, "text", None)], "doc_id long, text string, lang string")
    model = language.fit(docs)
    assert docs.select(language.predicted(spark, model, "text").alias("p")).first()["p"]["lang"] == "und"
    assert language.identified(docs.limit(0), model).count() == 0


def plain_kernel(a, b):
    def weights(word):
        out, x = {}, toxicity.symbols(word)
        for i in range(len(x)):
            for j in range(i + 1, len(x)):
                for k in range(j + 1, min(len(x), i + toxicity.SPAN)):
                    out[x[i], x[j], x[k]] = out.get((x[i], x[j], x[k]), 0) + toxicity.DECAY ** (k - i + 1)
        return out
    u, v = weights(a), weights(b)
    dot = sum(w * v.get(key, 0) for key, w in u.items())
    return dot / math.sqrt(sum(w * w for w in u.values()) * sum(w * w for w in v.values()))


def test_kernel_equals_the_plain_sum():
    words = ["idiot", "idi0t", "ananas", "rrrr", "loser", "über", "go"]
    got = toxicity.Machine([w.encode() for w in words]).kernel([w.encode() for w in words])
    for i, a in enumerate(words):
        for j, b in enumerate(words):
            assert got[i, j] == pytest.approx(plain_kernel(a, b), abs=1e-5)


@pytest.fixture(scope="module")
def toxic(spark):
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    return docs, labels, toxicity.fit(docs.filter("doc_id % 3 != 1"), labels)


def test_toxicity_of_held_out_documents(spark, toxic):
    docs, labels, model = toxic
    rows = docs.filter("doc_id % 3 = 1").join(labels, "doc_id").select(
        "toxic", toxicity.scored(spark, model, "text").alias("s")).collect()
    caught = [r["s"]["score"] >= toxicity.REJECT for r in rows if r["toxic"]]
    alarms = [r["s"]["score"] >= toxicity.REJECT for r in rows if not r["toxic"]]
    assert sum(caught) >= 0.95 * len(caught) and sum(alarms) <= 0.01 * len(alarms)


def test_toxicity_of_gapped_words_and_odd_texts(spark, toxic):
    _, _, model = toxic
    texts = [None, "", "   ", "12 ...", "the of and", "an i.d.i.o.t", "stuupid", "s t u p i d", "worth-lesss"]
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, _toxicity int")
    scores = [r["s"]["score"] for r in docs.select(toxicity.scored(spark, model, "text").alias("s")).collect()]
    assert max(scores[:5]) < 0.5 and min(scores[5:]) >= toxicity.REJECT
    kept = toxicity.accepted(docs, model)
    assert kept.columns == docs.columns and sorted(r[0] for r in kept.collect()) == [0, 1, 2, 3, 4]


def test_toxicity_with_one_label_or_none(spark):
    docs = spark.createDataFrame([(1, "fine text"), (2, "more text")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0), (2, 0), (2, None), (None, 1)], "doc_id long, toxic int")
    for marks in (labels, labels.limit(0)):
        model = toxicity.fit(docs, marks)
        assert toxicity.accepted(docs, model).count() == 2
    assert toxicity.accepted(docs.limit(0), model).count() == 0


def plain_documents(rng, insert, count=240, length=60, words=400):
    """(text, label): every third document holds what ``insert`` makes among its words."""
    names = ["".join(rng.choice("bcdfghjklmnprst") + rng.choice("aeiou") for _ in range(rng.randint(1, 3)))
             for _ in range(words)] + ["you", "there"] * 20
    rows = []
    for i in range(count):
        line = [rng.choice(names) for _ in range(length)]
        if i % 3 == 0:
            line[rng.randrange(length)] = insert(rng)
        line[9::10] = [w + "." for w in line[9::10]]
        rows.append((" ".join(line), int(i % 3 == 0)))
    return rows


def caught_and_alarms(model, rows):
    found = model.judge([t.encode() for t, _ in rows])[0] >= toxicity.REJECT
    return (np.mean([f for f, (_, y) in zip(found, rows) if y]),
            np.mean([f for f, (_, y) in zip(found, rows) if not y]))


def test_toxicity_of_insults_behind_the_same_words():
    rng = random.Random(5)
    insert = lambda r: "you " + r.choice(["wretch", "dimwit", "vermin", "oaf"]) + " there"
    model = toxicity.ToxicityModel(plain_documents(rng, insert), 128)
    caught, alarms = caught_and_alarms(model, plain_documents(rng, insert))
    assert caught >= 0.95 and alarms <= 0.05
    for insult in (b"wretch", b"dimwit", b"vermin", b"oaf"):
        assert model.judge([insult])[0][0] >= toxicity.REJECT


def test_toxicity_is_learnt_from_whole_texts(spark):
    rng = random.Random(6)
    rows = plain_documents(rng, lambda r: "vermin", 90)
    filler = " ".join(t for t, y in plain_documents(rng, lambda r: "so", 30) if not y)
    assert len(filler) > 4_000
    docs = spark.createDataFrame([(i, f"{filler} {t}") for i, (t, _) in enumerate(rows)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(rows)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    assert model.judge([b"so vermin are"])[0][0] >= toxicity.REJECT


def test_toxicity_of_threats_made_of_common_words():
    rng = random.Random(7)
    parts = ["end", "hurt", "get", "find", "you", "him", "them", "soon"]

    def documents():
        rows = plain_documents(rng, lambda r: "hurt you soon", 300)
        out = []
        for text, label in rows:  # the same words stand apart in all documents
            line = text.split(" ")
            for word in parts:
                line.insert(rng.randrange(len(line)), word)
            text = " ".join(line)
            out.append((text if label else text.replace("hurt you", "hurt so you"), label))
        return out

    model = toxicity.ToxicityModel(documents(), 128)
    caught, alarms = caught_and_alarms(model, documents())
    assert caught >= 0.8 and alarms <= 0.1
    score, worst = model.judge([b"we hurt you soon", b"you said soon it can hurt"])
    assert score[0] >= toxicity.REJECT > score[1] and "hurt you" in worst[0]


def plain_windows(text):
    """All windows of the sentences, as lists of symbols."""
    for sentence in text.lower().replace("!", ".").split("."):
        x = [toxicity.END]
        for word in "".join(c for c in sentence if c.isalpha() or c.isspace()).split():
            x += toxicity.symbols(word)[1:]
        if len(x) > 2:
            for a in range(max(1, len(x) - toxicity.WINDOW + 1)):
                yield x[a:a + toxicity.WINDOW]


def test_sentence_windows_equal_the_plain_search():
    rng = np.random.default_rng(8)
    table, bias = rng.normal(size=toxicity.SYMBOLS ** 3), -0.3
    texts = ["Some words, of a sentence. And anna banana rrrrrr! Go.", "", "a", "x y", "Über ñandú öl",
             "rrrr rrrr rrrr rrrr", "...", "no end", "  Odd   spaces . "] * 2 + ["long " * 500 + "text"]
    got = toxicity.sentence_windows([t.encode() for t in texts], table, bias, [-math.inf] * len(texts))
    for text, found in zip(texts, got):
        best = -math.inf
        for part in plain_windows(text):
            codes, weights, norms = toxicity.codes(np.array([part]))
            best = max(best, float((table[codes] @ weights / norms + bias)[0]))
        assert (found is None) == (best == -math.inf), text
        if found:
            assert found[0] == pytest.approx(best, abs=1e-4), text
