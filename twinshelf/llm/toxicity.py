"""Toxicity with a subsequence string kernel, Nyström landmarks and a support vector machine.

The kernel of two strings counts the subsequences of three letters that they share, each
weighted by ``DECAY`` to the number of places it spans in either string, up to ``SPAN`` places.
Letters that are inserted or left out change few of these, so ``idi0ot`` and ``i-d-iot`` stay
near ``idiot``. The strings are windows of up to ``WINDOW`` symbols: those of single words, and
those at every place of a sentence's letters, in which one symbol stands for a word's end.

A sentence's score is that of its highest window, and a document's that of its highest
sentence. Labels belong to documents, so the machine is trained by turns: each toxic
document is stood for by its highest window (at first its word or pair of words of the highest
log-odds), the machine is fitted to these against windows of clean documents, and clean windows
that it scores too high are added. Its kernel is that of the Nyström features of ``LANDMARKS`` windows; as these features are linear in the weighted
counts of subsequences, the fitted machine is one weight for each subsequence of three letters.
Scores are calibrated to probabilities on the documents of the sample.
"""

from __future__ import annotations

import re
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .batches import by_parts, chunks, remembered, utf8

DECAY, SPAN, WINDOW, STEP = 0.6, 6, 14, 4
LANDMARKS, RIDGE, ROUNDS = 512, 1e-4, 4
#: The fitted sample: documents of each label (those with the least hashes, on average).
DOCUMENTS = 3_000
POOL = 30_000
REJECT = 0.7
#: Words whose score a worker remembers.
REMEMBERED = 300_000
#: Bytes of text whose windows are scored together, and whose words are looked up together.
BLOCK, STRETCH = 64 << 10, 1 << 20
#: Windows of words that are scored together.
TOGETHER = 5_000
SYMBOLS = 40
END = SYMBOLS - 2  # the symbol of a word's end
NOTHING = -3.0  # the score of a text without a window

_KEPT = b" \t\n\r\x0b\x0c"
_DROPPED = bytes(c for c in range(128) if not chr(c).isalpha() and c not in _KEPT)
_SENTENCE = re.compile(r"[.!?\n]+")
_DRAWN = re.compile(rb"([a-z])\1+")
_SPELT = re.compile(rb"(?<![^\s])[a-z](?:\s+[a-z]){2,}(?![^\s])")


def ordered_words(text: bytes) -> list[bytes]:
    return text.decode().lower().encode().translate(None, _DROPPED).split()


def words_of(text: bytes) -> set[bytes]:
    """Different words of a text, letters only; runs of single letters are one word as well, and
    words with a letter drawn out are also taken with it once.
    """
    line = text.decode().lower().encode().translate(None, _DROPPED)
    words = set(line.split())
    for run in _SPELT.findall(line):
        words.add(b"".join(run.split()))
    words.update([_DRAWN.sub(rb"\1", w) for w in words if _DRAWN.search(w)])
    return words


def symbols(word: str) -> list[int]:
    """Letters between the symbols that mark the word's ends."""
    return [END, *[
        ord(c) - 97 if "a" <= c <= "z" else 26 + ord(c) % (SYMBOLS - 28) for c in word], END]


class Window(bytes):
    """A window of a sentence, given by its symbols."""


@lru_cache(maxsize=64)
def places(length: int) -> tuple[np.ndarray, np.ndarray]:
    """All i < j < k of a span, and their weights."""
    found = [(i, j, k) for i in range(length) for j in range(i + 1, length)
             for k in range(j + 1, min(length, i + SPAN))]
    at = np.array(found).reshape(-1, 3).T
    return at, DECAY ** (at[2] - at[0] + 1.0)


def windows(words: list[bytes]) -> tuple[dict[int, np.ndarray], dict[int, np.ndarray]]:
    """By length: the windows' symbols, and the number of the word they are from."""
    rows: dict[int, list] = {}
    owners: dict[int, list[int]] = {}
    for number, word in enumerate(words):
        coded = list(word) if isinstance(word, Window) else symbols(word.decode("utf-8", "replace"))
        for a in range(0, max(1, len(coded) - WINDOW + STEP), STEP):
            part = coded[a:a + WINDOW] if a == 0 or a + WINDOW <= len(coded) else coded[-WINDOW:]
            if len(part) >= 3:
                rows.setdefault(len(part), []).append(part)
                owners.setdefault(len(part), []).append(number)
    return ({n: np.array(x, np.int64) for n, x in rows.items()},
            {n: np.array(x) for n, x in owners.items()})


def codes(part: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(subsequences of each window, their weights, the windows' lengths in the kernel's space)."""
    (i, j, k), weights = places(part.shape[1])
    found = (part[:, i] * SYMBOLS + part[:, j]) * SYMBOLS + part[:, k]
    squares = np.full(len(part), (weights ** 2).sum())
    order = np.sort(found, axis=1)
    again = np.flatnonzero((order[:, 1:] == order[:, :-1]).any(axis=1))
    if len(again):  # subsequences that occur more than once count together
        place = np.argsort(found[again], axis=1, kind="stable")
        sorted_codes = np.take_along_axis(found[again], place, axis=1)
        new = np.ones(sorted_codes.shape, bool)
        new[:, 1:] = sorted_codes[:, 1:] != sorted_codes[:, :-1]
        sums = np.add.reduceat(weights[place].ravel(), np.flatnonzero(new.ravel()))
        squares[again] = np.bincount(np.nonzero(new)[0], sums ** 2, len(again))
    return found, weights, np.sqrt(squares)


def word_scores(words: list[bytes], table: np.ndarray, bias: float) -> np.ndarray:
    """Each word's highest window; ``table`` has the machine's weights."""
    out = np.full(len(words), NOTHING)
    rows, owners = windows(words)
    for length, part in rows.items():
        for a in range(0, len(part), TOGETHER):
            found, weights, norms = codes(part[a:a + TOGETHER])
            np.maximum.at(out, owners[length][a:a + TOGETHER], table[found] @ weights / norms + bias)
    return out


_STOPS = np.zeros(129, bool)
_STOPS[[ord(c) for c in ".!?"]] = True
_SPACES = np.zeros(129, bool)
_SPACES[list(_KEPT)] = True
_SYMBOL = np.full(129, 255, np.uint8)
_SYMBOL[97:123] = np.arange(26)
_SYMBOL[list(_KEPT)] = END


def sentence_symbols(line: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The symbols of lower-case text, the places of those that end sentences, and the symbols'
    places in the text. The first and the last symbol are ends; one lies between two sentences.
    """
    found = np.frombuffer(line.encode("utf-32-le"), np.uint32)
    small = np.minimum(found, 128)
    coded = _SYMBOL[small]
    other = np.flatnonzero(found > 127)
    coded[other] = 26 + found[other] % (SYMBOLS - 28)
    # A point ends a sentence if white space or another one follows it.
    ends = found == 10
    stops, spaces = _STOPS[small], _SPACES[small]
    ends[:-1] |= stops[:-1] & (stops | spaces)[1:]
    coded[ends] = END
    at = np.flatnonzero(coded != 255)
    coded, ends = coded[at], ends[at]
    coded, ends, at = (np.concatenate(([first], x, [last])) for x, first, last in (
        (coded, END, END), (ends, True, True), (at, 0, len(found))))
    gaps = coded == END
    starts = np.flatnonzero(np.concatenate(([True], ~(gaps[1:] & gaps[:-1]))))
    ends = np.logical_or.reduceat(ends, starts)  # neighbouring ends are one
    return coded[starts], np.flatnonzero(ends), at[starts]


def plain_lengths() -> np.ndarray:
    """By size, the lengths in the kernel's space of windows without a repeated subsequence."""
    return np.array([np.inf] * 3 + [
        np.sqrt((places(size)[1] ** 2).sum()) for size in range(3, WINDOW + 1)])


def sentence_windows(
    texts: list[bytes], table: np.ndarray, bias: float, least: list[float],
) -> list[tuple[float, Window, str] | None]:
    """Each text's highest window of its sentences, if above its ``least``: score, symbols, words.

    Sums along the texts give each window's product with the machine. Repeated subsequences make
    a window longer in the kernel's space than the plain length, which therefore gives bounds;
    only windows whose bound is above the best score found are worked out.
    """
    lines = [t.decode().lower() for t in texts]
    line = "\n".join(lines)
    coded, ends, at = sentence_symbols(line)
    x, n = coded.astype(np.intp), len(coded)
    out: list[tuple[float, Window, str] | None] = [None] * len(texts)
    if n < 3:
        return out
    left, middle, quick = x * (SYMBOLS * SYMBOLS), x * SYMBOLS, table.astype(np.float32)
    full = max(0, n - WINDOW + 1)
    product = np.zeros(full)
    firsts, lengths = ends[:-1], np.diff(ends) + 1
    short = (lengths < WINDOW) & (lengths > 2)
    firsts, lengths = firsts[short], lengths[short]
    brief = np.zeros(len(firsts))
    for reach in range(2, min(SPAN, n)):
        outer = left[:n - reach] + x[reach:]
        total = quick.take(outer + middle[1:n - reach + 1], mode="clip")
        for step in range(2, reach):
            total += quick.take(outer + middle[step:n - reach + step], mode="clip")
        sums = np.zeros(n + 1)
        np.cumsum(total, out=sums[1:n - reach + 1], dtype=np.float64)
        sums[n - reach + 1:] = sums[n - reach]
        sums *= DECAY ** (reach + 1)
        product += sums[WINDOW - reach:WINDOW - reach + full] - sums[:full]
        brief += sums[firsts + np.maximum(lengths - reach, 0)] - sums[firsts]
    plain = plain_lengths()
    bounds = np.maximum(product, 0) / plain[WINDOW] + bias + 1e-5  # for the smaller numbers above
    for back in range(1, WINDOW - 1):  # no window goes on behind an end of its sentence
        places_ = ends - back
        bounds[places_[(places_ >= 0) & (places_ < full)]] = -np.inf
    starts = np.concatenate((np.arange(full), firsts))
    sizes = np.concatenate((np.full(full, WINDOW), lengths))
    bounds = np.concatenate((bounds, np.maximum(brief, 0) / plain[lengths] + bias + 1e-5))
    owner = np.searchsorted(np.cumsum([len(t) + 1 for t in lines]), at, side="right")
    owner = np.minimum(owner, len(lines) - 1)
    owner[ends[:-1]] = owner[np.minimum(ends[:-1] + 1, n - 1)]
    owners, best = owner[starts], np.array(least, float)
    chosen = np.full(len(texts), -1)

    def work_out(these: np.ndarray) -> None:
        for size in np.unique(sizes[these]).tolist():
            own = these[sizes[these] == size]
            for a in range(0, len(own), 5_000):
                part = own[a:a + 5_000]
                found, weights, norms = codes(x[starts[part, None] + np.arange(size)])
                scores = table[found] @ weights / norms + bias
                for place in np.flatnonzero(scores > best[owners[part]]).tolist():
                    text = owners[part[place]]
                    if scores[place] > best[text]:
                        best[text], chosen[text] = scores[place], part[place]

    open_ = np.flatnonzero(bounds > best[owners])
    if len(open_):
        order = open_[np.lexsort((-bounds[open_], owners[open_]))]
        new = np.concatenate(([True], owners[order][1:] != owners[order][:-1]))
        work_out(order[new])
        others = order[~new]
        work_out(others[bounds[others] > best[owners[others]]])
    for text in np.flatnonzero(chosen >= 0).tolist():
        start, size = int(starts[chosen[text]]), int(sizes[chosen[text]])
        a, b = int(at[start]), int(at[start + size - 1])
        while a > 0 and not line[a - 1].isspace():
            a -= 1
        while b < len(line) and not line[b].isspace():
            b += 1
        out[text] = (float(best[text]), Window(coded[start:start + size].astype(np.uint8).tobytes()),
                     " ".join(line[a:b].split()))
    return out


def first_windows(words: list[bytes]):
    """(numbers of the words, their subsequences, weights, norms) by length of first windows."""
    rows, owners = windows(words)
    for length, part in rows.items():
        number, first = np.unique(owners[length], return_index=True)
        yield number, *codes(part[first])


class Machine:
    """Squared-hinge support vector machine on Nyström features of words."""

    def __init__(self, landmarks: list[bytes]):
        self.basis = np.zeros((SYMBOLS ** 3, len(landmarks)), np.float32)
        for number, found, weights, norms in first_windows(landmarks):
            np.add.at(self.basis, (found, number[:, None]), weights / norms[:, None])
        values, vectors = np.linalg.eigh(self.kernel(landmarks).astype(np.float64))
        usable = values > 1e-6 * values.max()
        self.root = vectors[:, usable] / np.sqrt(values[usable])

    def kernel(self, words: list[bytes]) -> np.ndarray:
        """Each word against each landmark."""
        out = np.zeros((len(words), self.basis.shape[1]), np.float32)
        for number, found, weights, norms in first_windows(words):
            for place, weight in zip(found.T, weights.tolist()):
                out[number] += (weight / norms)[:, None].astype(np.float32) * self.basis[place]
        return out

    def fit(self, toxic: dict[bytes, float], clean: dict[bytes, float]) -> tuple[np.ndarray, float]:
        """The weights of all subsequences and the bias, by Newton's method in the primal.

        Words come with their weights, which are scaled to one for each side.
        """
        x = self.kernel([*toxic, *clean]) @ self.root
        x = np.hstack([x, np.ones((len(x), 1))])
        y = np.r_[np.ones(len(toxic)), -np.ones(len(clean))]
        cost = np.r_[np.array([*toxic.values()]) / sum(toxic.values()),
                     np.array([*clean.values()]) / sum(clean.values())]
        ridge = RIDGE * np.eye(x.shape[1])
        ridge[-1, -1] = 1e-9
        w = np.zeros(x.shape[1])
        for _ in range(50):
            active = y * (x @ w) < 1
            weighted = x[active] * cost[active, None]
            moved = np.linalg.solve(weighted.T @ x[active] + ridge, weighted.T @ y[active])
            if np.allclose(moved, w, atol=1e-7):
                break
            w = moved
        weights = self.basis @ (self.root @ w[:-1]).astype(np.float32)
        return weights.astype(np.float64), float(w[-1])


def calibrated(scores: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve through the labels (Platt).

    Some documents are labelled toxic for what no window shows. How many is found by turns with
    the curve, which would be too flat if it had to pass through them.
    """
    a, b, shown = 1.0, 0.0, labels.astype(float)
    x = np.stack([scores, np.ones(len(scores))], axis=1)
    for _ in range(30):
        low, high = 1 / ((1 - shown).sum() + 2), (shown.sum() + 1) / (shown.sum() + 2)
        target = low + (high - low) * shown
        for _ in range(100):
            p = 1 / (1 + np.exp(-np.clip(a * scores + b, -30, 30)))
            slope = (x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
            step = np.linalg.solve(slope, x.T @ (p - target) + 1e-6 * np.array([a, b]))
            a, b = a - step[0], b - step[1]
            if np.abs(step).max() < 1e-8:
                break
        p = 1 / (1 + np.exp(-np.clip(a * scores + b, -30, 30)))
        unseen = max((labels - shown).sum(), 0.5) / (1 - shown).sum().clip(1)
        shown = labels * p / (p + unseen * (1 - p))
    return float(a), float(b)


PAIR = 1 << 31
NO_PAIRS = np.zeros(0, np.int64)


def neighbours(sentence: str, names: dict[bytes, int]) -> np.ndarray:
    """Different pairs of neighbouring words, by the words' numbers; new words get the next ones."""
    found = np.array([names.setdefault(w, len(names)) for w in ordered_words(sentence.encode())], np.int64)
    return np.unique(found[:-1] * PAIR + found[1:])


def pair_window(first: bytes, second: bytes) -> Window:
    """The window about the space between two words."""
    left, right = symbols(first.decode("utf-8", "replace")), symbols(second.decode("utf-8", "replace"))
    start = max(0, min(len(left) - WINDOW // 2, len(left) + len(right) - 1 - WINDOW))
    return Window((left + right[1:])[start:start + WINDOW])


class ToxicityModel:
    """Fitted on (text, label) documents; scores texts."""

    def __init__(self, rows: list[tuple[str, int]], landmarks: int = LANDMARKS):
        names: dict[bytes, int] = {}  # bags hold the words' numbers
        bags = [np.array([names.setdefault(w, len(names)) for w in sorted(words_of(t.encode()))],
                         np.int32) for t, _ in rows]
        labels = np.array([y for _, y in rows], int)
        self.table, self.bias, self.curve = np.zeros(SYMBOLS ** 3), NOTHING, (1.0, -9.0)
        if labels.sum() == 0 or labels.sum() == len(labels):
            if len(labels) and labels.all():
                self.curve = (0.0, 9.0)
            return
        seen: dict[bytes, list[int]] = {}
        learnt = [i for i in range(len(rows)) if i % 4] or list(range(len(rows)))
        if len(set(labels[learnt].tolist())) < 2:
            learnt = list(range(len(rows)))
        texts = [t.encode() for t, _ in rows]
        sentences = {(part.strip(), int(labels[i])) for i in learnt
                     for part in _SENTENCE.split(rows[i][0]) if part.strip()}
        pairs: tuple[list, list] = [], []
        for sentence, label in sentences:  # different ones: copies prove nothing more
            for word in words_of(sentence.encode()):
                seen.setdefault(word, [0, 0])[label] += 1
            pairs[label].append(neighbours(sentence, names))
        n_toxic = sum(label for _, label in sentences)
        n_clean = len(sentences) - n_toxic
        del sentences

        def log_odds(t: np.ndarray, c: np.ndarray) -> np.ndarray:
            """Of what t toxic and c clean sentences hold, less two standard errors."""
            odds = np.log((t + 0.5) / (n_toxic - t + 0.5) * (n_clean - c + 0.5) / (c + 0.5))
            return odds - 2 * np.sqrt(1 / (t + 0.5) + 1 / (c + 0.5))

        # Every toxic document has a word, a pair of words or a window that stands for it.
        words = list(names)
        counts = np.array([seen.get(w, (0, 0)) for w in words])
        odds = log_odds(counts[:, 1], counts[:, 0])
        codes_, counts = np.unique(np.concatenate([*pairs[1], NO_PAIRS]), return_counts=True)
        clean_pairs = np.sort(np.concatenate([*pairs[0], NO_PAIRS]))
        pair_odds = log_odds(counts, np.searchsorted(clean_pairs, codes_, "right")
                             - np.searchsorted(clean_pairs, codes_))
        del pairs, clean_pairs, counts
        standing: list[bytes] = []
        for i in learnt:
            if labels[i] and len(bags[i]):
                word = bags[i][odds[bags[i]].argmax()]
                own = np.searchsorted(codes_, np.concatenate([NO_PAIRS, *(
                    neighbours(part, names) for part in _SENTENCE.split(rows[i][0]))]))
                best = own[pair_odds[own].argmax()] if len(own) else None
                if best is not None and pair_odds[best] > odds[word]:
                    first, second = divmod(int(codes_[best]), PAIR)
                    standing.append(pair_window(words[first], words[second]))
                else:
                    standing.append(words[word])
        if not standing:
            return
        clean_words = sorted(w for w, (c, _) in seen.items() if c)
        rng = np.random.default_rng(7)
        some = [clean_words[i] for i in rng.permutation(len(clean_words))[:8 * landmarks]]
        clean = {w: seen[w][0] ** 0.5 for w in some} or {b"": 1.0}
        hard = some[:landmarks // 2]
        # Clean words to look for false alarms among: the frequent ones and as many others.
        pool = [w for w in clean_words if seen[w][0] > 1][:POOL]
        pool += [clean_words[i] for i in rng.permutation(len(clean_words))[:POOL]]
        pool = list(dict.fromkeys(pool))
        clean.update((w, seen[w][0] ** 0.5) for w in set(standing) if seen.get(w, (0, 0))[0])
        for turn in range(ROUNDS):
            toxic = {w: float(n) for w, n in sorted(Counter(standing).items())}
            main = sorted(toxic, key=lambda w: (-toxic[w], w))[:landmarks // 2]
            machine = Machine(list(dict.fromkeys(main + hard))[:landmarks])
            self.table, self.bias = machine.fit(toxic, clean)
            del machine
            if turn == ROUNDS - 1:
                break
            scores = dict(zip(pool, word_scores(pool, self.table, self.bias).tolist()))
            own = word_scores(words, self.table, self.bias)
            found = self.highest([texts[i] for i in learnt], self.tops(words, [bags[i] for i in learnt], own))
            near: Counter = Counter()  # clean documents by their highest word or window
            for i, (score, item, _) in zip(learnt, found):
                if not labels[i] and item is not None:
                    scores[item] = score
                    near[item] += 1
            # Clean words and windows that come too near join the other side.
            alarms = sorted((w for w in scores if scores[w] > -0.7),
                            key=lambda w: (-scores[w], w))[:4 * landmarks]
            for w in alarms:
                clean[w] = max(clean.get(w, 1.0), seen.get(w, (1, 0))[0] ** 0.5, near[w])
            hard = list(dict.fromkeys(alarms[:landmarks // 3] + hard))
            standing = [item for i, (_, item, _) in zip(learnt, found) if labels[i] and item is not None]
        self.words = sorted(toxic)
        held = np.array([i for i in range(len(rows)) if i % 4 == 0])
        if len(set(labels[held].tolist())) < 2:
            held = np.arange(len(rows))
        tops = [score for score, _, _ in self.highest(
            [texts[i] for i in held], self.tops(
                words, [bags[i] for i in held], word_scores(words, self.table, self.bias)))]
        self.curve = calibrated(np.array(tops), labels[held])

    def tops(
        self, words: list[bytes], bags: list[np.ndarray], scores: np.ndarray,
    ) -> list[tuple[float, bytes | None]]:
        """Each bag's highest word, of bags that hold the words' numbers."""
        return [(float(scores[bag].max()), words[bag[scores[bag].argmax()]]) if len(bag)
                else (NOTHING, None) for bag in bags]

    def highest(
        self, texts: list[bytes], tops: list[tuple[float, bytes | None]],
    ) -> list[tuple[float, bytes | None, str | None]]:
        """Each text's highest word, as given, or window: score, the word or window, its words."""
        out = [(score, word, None if word is None else word.decode("utf-8", "replace"))
               for score, word in tops]
        some = [i for i, (_, word) in enumerate(tops) if word is not None]
        for part in chunks([len(texts[i]) for i in some], BLOCK):
            at = some[part]
            found = sentence_windows([texts[i] for i in at], self.table, self.bias,
                                     [tops[i][0] for i in at])
            for i, window in zip(at, found):
                out[i] = window or out[i]
        return out

    def probability(self, scores: np.ndarray) -> np.ndarray:
        a, b = self.curve
        return 1 / (1 + np.exp(-np.clip(a * scores + b, -50, 50)))

    def judge(self, texts: list[bytes]) -> tuple[np.ndarray, list[str | None]]:
        """Probabilities, and the word or the words that each rests on."""
        known = remembered("toxicity", "words", dict, hash(self.table.tobytes()))
        out, worst = np.full(len(texts), NOTHING), [None] * len(texts)
        for part in chunks([len(t) for t in texts], STRETCH):
            bags = [words_of(t) for t in texts[part]]
            new = list(set().union(*bags) - known.keys())
            if len(known) + len(new) > REMEMBERED:
                known.clear()
                new = list(set().union(*bags))
            known.update(zip(new, word_scores(new, self.table, self.bias).tolist()))
            tops: list[tuple[float, bytes | None]] = []
            for words in bags:
                top = max(map(known.__getitem__, words), default=NOTHING)
                tops.append((top, min((w for w in words if known[w] == top), default=None)))
            for at, (score, _, words) in enumerate(self.highest(texts[part], tops), part.start):
                out[at], worst[at] = score, words
        return self.probability(out), worst


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "toxic", documents: int = DOCUMENTS,
) -> ToxicityModel:
    """Fit on the whole texts of documents with a label; null texts and labels are left out.

    Several labels of one document count as toxic if one is.
    """
    marks = labels.select(F.col(id_col).alias("_id"), F.col(label_col).alias("_label")).filter(
        "_id is not null and _label is not null").groupBy("_id").agg(
        F.max(F.col("_label").cast("int")).alias("_label"))
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    sizes = {r["_label"]: r["count"] for r in marks.groupBy("_label").count().collect()}
    place = F.pmod(F.xxhash64("_id"), F.lit(1 << 30)) / (1 << 30)
    share = F.lit(0.0)
    for label, n in sizes.items():
        share = F.when(F.col("_label") == label, F.lit(documents / n)).otherwise(share)
    # So few ids go to the texts, not the texts to them.
    drawn = marks.filter(place < share).orderBy(F.xxhash64("_id"), "_id").limit(3 * documents)
    found = rows.filter("_text is not null").join(F.broadcast(drawn), "_id").select(
        "_text", "_label").distinct()
    sample = found.orderBy(F.xxhash64("_text"), "_label").limit(3 * documents).collect()
    return ToxicityModel([(r["_text"], int(r["_label"] > 0)) for r in sample])


def scored(spark, model: ToxicityModel, text: str) -> Column:
    """struct(score, worst) of a text column; a text without words has a low score and no worst."""
    shared = spark.sparkContext.broadcast(model)
    kind = pa.struct([("score", pa.float64()), ("worst", pa.string())])

    @by_parts("struct<score:double,worst:string>")
    def run(part: pa.Array) -> pa.Array:
        score, worst = shared.value.judge(utf8(part))
        return pa.StructArray.from_arrays([pa.array(score), pa.array(worst, pa.string())],
                                          fields=list(kind))

    return run(F.col(text))


def accepted(docs: DataFrame, model: ToxicityModel, text_col: str = "text",
             reject: float = REJECT) -> DataFrame:
    """The rows of ``docs`` whose score is below ``reject``; null and empty texts stay."""
    mark = "_toxicity"
    while mark in docs.columns:
        mark += "_"
    marked = docs.withColumn(mark, scored(docs.sparkSession, model, text_col))
    return marked.filter(F.col(f"{mark}.score") < reject).select(docs.columns)
