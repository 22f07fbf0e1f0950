"""Toxicity scores behind a noisy-channel deobfuscation.

* **Source model.** A character model of order four over letters a-z (accents
  folded), other letters and word ends: interpolated from the counts of all
  four-letter windows of all texts.  Its table has ``28 ** 4`` entries whatever the
  corpus, so it is summed by Spark and handed to every task.
* **Channel.** What was written is a lattice of what may have been meant: digits
  and signs that stand for letters (or for themselves), a letter three or more
  times in a row (once or twice), and single letters set apart by blanks, dots,
  dashes and the like (together, or words of their own).  A masked letter is any
  letter.  Letters as such are themselves.
* **Decoding.** Viterbi search over the lattice finds the cheapest reading; its
  states are the last three characters.
* **Scoring.** A penalised logistic regression over hashed features of the restored
  text: words, their stems, their forms without doubled letters, and how often a
  stem occurs.  It learns from labelled rows that are not held out, at most
  ``max_labels`` of them; scoring is one pass without a shuffle.
"""

from __future__ import annotations

import math
import re
import unicodedata
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Which letters a digit or sign stands for in disguised words.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "li", "+": "t", "€": "e", "£": "l", "(": "c", "<": "c", "¡": "i", "§": "s", "¢": "c",
}
MASK = "*"
SEPARATORS = ".-_*~/|,"
#: Signs at the ends of a written word that belong to the sentence.
EDGES = ".,;:!?\"'()[]{}<>«»“”„…-–_*~|/"
#: Costs (negative log probabilities) of the channel: a letter written as a sign, a sign meant as itself, a masked letter, a stretched letter meant twice, a blank between single letters meant as one.
SIGN, SELF, MASKED, TWICE, APART = 1.5, 2.0, 2.0, 1.0, 3.0
#: Single letters in a row from which they may be a word set apart.
SPACED = 3
OTHER, SIZE = 27, 28
SMOOTHING = 4.0
#: Characters counted at a time.
CHUNK = 1 << 20
FOLDED = 5
BITS, STEM, MAX_LABELS, EPOCHS = 18, 5, 20_000, 8
#: Of six settings the one with the least log loss on two folds of the labelled rows that are not held out.
SCALE, PENALTY, RATE = 0.25, 1.5, 3.0
MASK_BITS = (1 << BITS) - 1
MEMO_WORDS = 300_000
REPEATS = (2, 4, 8)


def _class_of(code: int) -> int:
    base = unicodedata.normalize("NFKD", chr(code).lower())[:1]
    return ord(base) - 96 if "a" <= base <= "z" else OTHER if chr(code).isalpha() else 0


#: Class of each code point below 0x250; of the others punctuation ends a word, the rest are other letters.
_CLASSES = np.array([_class_of(c) for c in range(0x250)], np.uint8)


def classes(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    known = _CLASSES[np.minimum(codes, 0x24F)]
    return np.where(codes < 0x250, known, np.where((codes >= 0x2000) & (codes < 0x2070) | (codes >= 0x3000) & (codes < 0x3030), 0, OTHER)).astype(np.int32)


def window_counts(texts: list[str]) -> np.ndarray:
    """Counts of (three characters before, character) over texts; what lies before a word's start is left out, repeated word ends count once."""
    total = np.zeros(SIZE ** 4, np.int64)
    line = "\n".join(texts)
    for start in range(0, len(line), CHUNK):
        c = classes(line[max(0, start - 3):start + CHUNK])
        if start < 3:
            c = np.r_[np.zeros(3 - start, np.int32), c]
        now, one, two, three = c[3:], c[2:-1], c[1:-2], c[:-3]
        two = np.where(one == 0, 0, two)
        three = np.where(two == 0, 0, three)
        at = ((three * SIZE + two) * SIZE + one) * SIZE + now
        total += np.bincount(at[(now != 0) | (one != 0)], minlength=SIZE ** 4)
    return total


def count_windows(docs: DataFrame) -> DataFrame:
    """(at, n): window counts over the whole texts of ``docs``; null texts have none."""

    def run(batches):
        total = np.zeros(SIZE ** 4, np.int64)
        for batch in batches:
            held, size = [], 0
            for text in batch.column(0):
                if text.is_valid:
                    held.append(text.as_py())
                    size += len(held[-1])
                if size >= CHUNK:
                    total += window_counts(held)
                    held, size = [], 0
            if held:
                total += window_counts(held)
        at = np.flatnonzero(total)
        for start in range(0, len(at), 50_000):
            part = at[start:start + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(total[part])], names=["at", "n"])

    return docs.select(F.col("text").cast("string")).mapInArrow(run, "at int, n long").groupBy("at").agg(F.sum("n").alias("n"))


def language_model(docs: DataFrame) -> np.ndarray:
    """Costs -log p(character | three before) as a table of ``28 ** 4`` numbers, of the whole corpus."""
    counts = np.zeros(SIZE ** 4)
    rows = count_windows(docs).toPandas()                           # at most 28 ** 4 rows
    counts[rows["at"].to_numpy(np.int64)] = rows["n"]
    return costs(counts)


def costs(counts: np.ndarray) -> np.ndarray:
    counts = counts.reshape(SIZE, SIZE, SIZE, SIZE)
    p = np.full(SIZE, 1 / SIZE)
    for order in range(4):                                          # each order leans on the one below
        n = counts.sum(axis=tuple(range(3 - order)))
        p = (n + SMOOTHING * p) / (n.sum(axis=-1, keepdims=True) + SMOOTHING)
    return -np.log(p).astype(np.float32).ravel()


def option(chars: str, extra: float = 0.0) -> tuple[str, float, tuple[int, ...]]:
    """What a stretch may mean, its cost in the channel and the classes of its characters."""
    return chars, extra, tuple(_CLASS_LIST[ord(c)] if ord(c) < 0x250 else OTHER for c in chars)


_CLASS_LIST = _CLASSES.tolist()
_SIGNS = {sign: (option(sign, SELF), *(option(x, SIGN) for x in letters)) for sign, letters in LEET.items()}
_GAP = (option(""), option(" ", APART))


class Decoder:
    """Restores written words under a character model."""

    def __init__(self, table: np.ndarray):
        self.cost = memoryview(np.ascontiguousarray(table, np.float32))
        self.known: dict[str, tuple[str, ...]] = {}

    def best(self, slots: list[tuple]) -> str:
        """Viterbi: one option of each slot, cheapest together and as words of the model."""
        cost, states = self.cost, {0: (0.0, None)}
        for options in [*slots, (option("\n"),)]:
            ahead: dict[int, tuple[float, tuple]] = {}
            for state, (paid, path) in states.items():
                for chars, extra, kinds in options:
                    now, total = state, paid + extra
                    for k in kinds:
                        if k:
                            at = now * SIZE + k
                            total += cost[at]
                            now = at % SIZE ** 3
                        elif now:
                            total += cost[now * SIZE]
                            now = 0
                    if now not in ahead or total < ahead[now][0]:
                        ahead[now] = (total, (path, chars))
            states = ahead
        path, parts = min(states.values(), key=lambda x: x[0])[1], []
        while path:
            path, chars = path
            parts.append(chars)
        return "".join(reversed(parts[1:]))

    def lattice(self, written: str) -> list[tuple]:
        """Slots of options for a written word in lower case; a stretch of fixed characters is one slot."""
        slots, fixed, i = [], "", 0
        while i < len(written):
            ch, j = written[i], i + 1
            while j < len(written) and written[j] == ch:
                j += 1
            masked = ch == MASK and j == i + 1 and 0 < i < len(written) - 1 and written[i - 1].isalpha() and written[j].isalpha()
            if ch in LEET or masked or (ch.isalpha() and j - i >= 3):
                if fixed:
                    slots.append((option(fixed),))
                    fixed = ""
                if masked:
                    slots.append((*(option(chr(97 + k), MASKED) for k in range(26)), option(ch, SELF)))
                elif ch.isalpha():
                    slots.append((option(ch), option(ch * 2, TWICE)))
                elif j - i >= 3:                                    # a stretched sign: itself in full, or one or two letters
                    slots.append((option(ch * (j - i), SELF), *(option(x * m, SIGN + (m - 1) * TWICE) for x in LEET[ch] for m in (1, 2))))
                else:
                    slots += [_SIGNS[ch]] * (j - i)
            else:
                fixed += written[i:j]
            i = j
        return [*slots, (option(fixed),)] if fixed else slots

    def restored(self, word: str) -> tuple[str, ...]:
        """Words meant by one written word (in lower case), without signs around them."""
        core = word.strip(EDGES)
        if core.isalpha() and not _STRETCHED(core) and word[0] not in "|!(<*":
            return (core,)
        found = self.known.get(word)
        if found is None:
            if len(self.known) > MEMO_WORDS:
                self.known.clear()
            found = self.known[word] = self._restored(word, core)
        return found

    def _restored(self, word: str, core: str) -> tuple[str, ...]:
        if _SPACED(core):
            return self.spaced(list(core[::2])) or (word,)
        sides = word.strip(".,;:?\"'[]{}«»“”„…–~/").rstrip("!*|()<>_-").lstrip(")>*_-")     # signs that may stand for letters stay at the front
        if not any(map(str.isalpha, sides)):
            return (word,)
        return tuple(_WORDS(self.best(self.lattice(sides)))) or (word,)

    def spaced(self, letters: list[str]) -> tuple[str, ...]:
        """Words meant by single characters set apart: each gap is none or the end of a word."""
        slots = []
        for slot in self.lattice("".join(letters).lower()):
            for piece in [(option(c),) for c in slot[0][0]] if len(slot) == 1 else [slot]:
                slots += [_GAP, piece] if slots else [piece]
        return tuple(_WORDS(self.best(slots)))

    def runs(self, written: list[str]) -> list[tuple[int, int, tuple[str, ...]]]:
        """(start, end, restored words) of the stretches of single characters that may be words set apart; a sign may close the last."""
        found, i, n = [], 0, len(written)
        while i < n:
            j = i
            while j < n and len(written[j]) == 1:
                j += 1
            if j - i >= SPACED - 1 and j < n and len(written[j]) == 2 and written[j][0].isalnum() and written[j][1] in EDGES:
                j += 1
            if j - i >= SPACED and any(w[0].isalpha() for w in written[i:j]):
                key = " ".join(written[i:j]) if j - i <= 40 else None
                if key is None or key not in self.known:
                    meant = self.spaced([w[0] for w in written[i:j]])
                    if key is not None:
                        self.known[key] = meant
                found.append((i, j, self.known[key] if key is not None else meant))
            i = max(i + 1, j)
        return found

    def words(self, text: str | None) -> list[str]:
        """The restored words of a whole text (null: none), in order."""
        written = (text or "").lower().split()
        out, at = [], 0
        for start, end, meant in [*self.runs(written), (len(written), 0, ())]:
            for word in written[at:start]:
                out += self.restored(word)
            out += meant
            at = end
        return out


_STRETCHED = re.compile(r"(\w)\1\1").search
_SPACED = re.compile(rf"(?:[^\W_][{re.escape(SEPARATORS)}]){{{SPACED - 1},}}[^\W_]").fullmatch
#: Two single characters and the start of a third, which a sign may follow.
_RUN = re.compile(r"\s\S\s+\S\s+\w(?:\s|\W\s)").search
_WORDS = re.compile(r"[^\W_]+").findall
_DOUBLE, _DOUBLED = re.compile(r"(\w)\1").search, re.compile(r"(\w)\1+").sub


class Features:
    """Sorted distinct positions of a text's features among ``2 ** BITS``.

    Written words are numbered as they come; arrays hold the positions of the
    word that each means, of its form without doubled letters and of its stem.
    """

    def __init__(self, decoder: Decoder):
        self.decoder = decoder
        self.numbers: dict[str, int | tuple[int, ...]] = {}
        self.meant: dict[str, int] = {}
        self.places = np.full((3, 1 << 16), -1, np.int64)

    def number(self, word: str) -> int:
        """Number of a restored word."""
        found = self.meant.get(word)
        if found is None:
            found = self.meant[word] = len(self.meant)
            if found == self.places.shape[1]:
                self.places = np.concatenate((self.places, np.full_like(self.places, -1)), axis=1)
            raw = word.encode("utf-8", "surrogatepass")
            self.places[0, found] = zlib.crc32(raw) & MASK_BITS
            if _DOUBLE(word):                                       # a doubled letter may hide a word too
                self.places[1, found] = zlib.crc32(_DOUBLED(r"\1", word).encode("utf-8", "surrogatepass")) & MASK_BITS
            if len(word) >= STEM:
                self.places[2, found] = zlib.crc32(f"{word[:STEM]}~".encode("utf-8", "surrogatepass")) & MASK_BITS
        return found

    def learn(self, written: str) -> int | tuple[int, ...]:
        words = self.decoder.restored(written)
        found = self.numbers[written] = self.number(words[0]) if len(words) == 1 else tuple(map(self.number, words))
        return found

    def __call__(self, text: str | None) -> np.ndarray:
        if len(self.numbers) > MEMO_WORDS or len(self.meant) > MEMO_WORDS:
            self.numbers, self.meant, self.places = {}, {}, np.full((3, 1 << 16), -1, np.int64)
        text = (text or "").lower()
        written = text.split()
        counts = Counter(written)
        if _RUN(f" {text} "):
            for start, end, meant in self.decoder.runs(written):
                counts.subtract(written[start:end])
                counts.update(meant)
            counts = +counts
        words, times = list(counts), list(counts.values())
        numbers = list(map(self.numbers.get, words))
        for k, number in enumerate(numbers):
            if number.__class__ is not int:
                if number is None:
                    number = self.learn(words[k])
                if number.__class__ is not int:                     # several words in one: the first takes its place
                    numbers += number[1:]
                    times += [times[k]] * (len(number) - 1)
                    number = number[0]
                numbers[k] = number
        if not numbers:
            return np.empty(0, np.int64)
        own, bare, stem = self.places[:, np.array(numbers)]
        order = np.argsort(stem)
        stem, n = stem[order], np.array(times)[order]
        first = np.flatnonzero(np.concatenate(([True], stem[1:] != stem[:-1])))
        stem, n = stem[first], np.add.reduceat(n, first)
        if stem[0] < 0:                                             # words without a stem
            stem, n = stem[1:], n[1:]
        found = np.concatenate((own, bare, stem, *((stem[n >= k] * 2_654_435_761 + k * 40_503) & MASK_BITS for k in REPEATS)))
        found.sort()
        found = found[np.concatenate(([True], found[1:] != found[:-1]))]
        return found[1:] if found[0] < 0 else found


class Model:
    """Weights of a logistic regression; a text's features weigh by rarity and are scaled down by their number."""

    def __init__(self, weights: np.ndarray, rarity: np.ndarray, bias: float):
        self.weighted, self.squares, self.bias = weights * rarity, rarity * rarity, bias

    def score(self, at: np.ndarray) -> float:
        z = self.weighted[at].sum() / (self.squares[at].sum() + 1e-12) ** SCALE + self.bias
        return float(1 / (1 + math.exp(-min(30.0, max(-30.0, z)))))


_held: dict[int, Features] = {}


def features_under(table: np.ndarray) -> Features:
    """The features under a character model, kept by the worker for its next task."""
    key = zlib.crc32(np.ascontiguousarray(table))
    if key not in _held:
        _held.clear()
        _held[key] = Features(Decoder(table))
    return _held[key]


def fit(rows: list[tuple[np.ndarray, int]], epochs: int = EPOCHS, rate: float = RATE, penalty: float = PENALTY) -> tuple[np.ndarray, np.ndarray, float]:
    """(weights, rarity, bias) by follow-the-regularised-leader steps over (features, label), in their order."""
    seen = np.zeros(1 << BITS)
    for at, _ in rows:
        seen[at] += 1
    rarity = np.minimum(1.0, np.log((len(rows) + 1) / (seen + 1)) / math.log(20) + 0.05)
    toxic = sum(label for _, label in rows)
    heavier = min(4.0, math.sqrt((len(rows) - toxic) / max(1, toxic))) if toxic else 1.0
    pulled, squares = np.zeros(len(seen)), np.zeros(len(seen))
    bias, bias_squares = -1.0, 1.0

    def weights(at):
        z = pulled[at]
        return np.where(np.abs(z) <= penalty, 0.0, -(z - np.sign(z) * penalty) * rate / (1 + np.sqrt(squares[at])))

    for _ in range(epochs):
        for at, label in rows:
            x = rarity[at]
            x = x / ((x * x).sum() + 1e-12) ** SCALE
            w = weights(at)
            p = 1 / (1 + math.exp(-min(30.0, max(-30.0, float((w * x).sum()) + bias))))
            slope = (p - label) * (heavier if label else 1.0)
            down = slope * x
            more = squares[at] + down * down
            pulled[at] += down - (np.sqrt(more) - np.sqrt(squares[at])) / rate * w
            squares[at] = more
            bias_squares += slope * slope
            bias -= 0.3 * slope / math.sqrt(bias_squares)
    return weights(slice(None)), rarity, bias


def held_out(doc_id):
    """Whether a row is kept out of training (null doc_id: by the text ``null``)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("null"))) % FOLDED == 0


def chosen_labels(labels: DataFrame, max_labels: int) -> DataFrame:
    """(doc_id, label) of at most ``max_labels`` labelled rows that are not held out; of repeated ones the toxic label counts."""
    own = labels.where("doc_id is not null and toxic is not null").select(F.col("doc_id").cast("long").alias("doc_id"), (F.col("toxic") > 0).cast("int").alias("label"))
    own = own.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("label").alias("label"))
    return own.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labels)


def train(docs: DataFrame, labels: DataFrame, table: np.ndarray, max_labels: int = MAX_LABELS) -> tuple[np.ndarray, np.ndarray, float]:
    """Weights, rarity and bias fitted on labelled texts; without any label every score is that of an untrained model."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts = texts.join(F.broadcast(chosen_labels(labels, max_labels)), "doc_id")  # at most max_labels rows of 12 bytes

    def read(batches):
        features = features_under(table)
        for batch in batches:
            found = [features(t.as_py()).astype(np.int32) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(found, pa.list_(pa.int32()))], names=["doc_id", "label", "at"])

    def learn(_, frame):
        frame = frame.assign(order=[zlib.crc32(b"%d" % d) for d in frame["doc_id"]]).sort_values(["order", "doc_id"])
        weights, rarity, bias = fit([(np.asarray(at, np.int32), int(y)) for at, y in zip(frame["at"], frame["label"], strict=True)])
        return pd.DataFrame({"weights": [weights.astype(np.float32).tobytes()], "rarity": [rarity.astype(np.float32).tobytes()], "bias": [bias]})

    rows = texts.select("doc_id", "text", "label").mapInArrow(read, "doc_id long, label int, at array<int>")
    found = rows.withColumn("one", F.lit(0)).groupBy("one").applyInPandas(learn, "weights binary, rarity binary, bias double").collect()  # one model
    if not found:
        return np.zeros(1 << BITS, np.float32), np.ones(1 << BITS, np.float32), -1.0
    return np.frombuffer(found[0].weights, np.float32), np.frombuffer(found[0].rarity, np.float32), found[0].bias


def restored_documents(docs: DataFrame, table: np.ndarray) -> DataFrame:
    """(doc_id, text): restored texts, their words in lower case joined by blanks; null text stays null."""

    def run(batches):
        decoder = Decoder(table)
        for batch in batches:
            texts = [" ".join(decoder.words(t.as_py())) if t.is_valid else None for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, text string")


def score(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, max_labels: int = MAX_LABELS) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row of ``docs`` (columns doc_id, text; others are ignored).

    ``labels`` has doc_id and toxic.  Null text is scored as empty; rows with
    null or repeated doc_id are scored each; an empty table gives no rows.
    """
    table = language_model(docs)
    parts = train(docs, labels, table, max_labels)

    def run(batches):
        features, model = features_under(table), Model(*parts)
        for batch in batches:
            scores = [model.score(features(t.as_py())) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(scores, pa.float64()), pa.array([int(s >= threshold) for s in scores], pa.int32())],
                names=["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out")).mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
