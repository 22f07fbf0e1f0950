"""Spelling variant grouping by permuterm rotations.

Every word is marked with a terminator and all its rotations are written.  The
rotation that starts behind an edited character ends with that character, so the
words that agree but for it share the rotation without its last character: a
*gap* ``rest + terminator + start``.  A word that lacks the character has the gap
itself as a whole rotation.  Sorted by gap, replacements and indels are
neighbouring rows; one scan over them finds every pair of near words:

* two rows with an edited character are words that differ by a replacement, and
  meet in this gap alone;
* a row without one and a row with one differ by an indel; an indel within a run
  of equal characters has several gaps, only that of the run's first character counts.

A gap holds one word for each character of the alphabet at most, and the scan
writes one row per word and gap (number of near words, the best of them), never
pairs.  Words are numbered in code-point order, so ties are settled by number.
Rotations of words beyond ``LONG`` characters are replaced by fingerprints of
their gaps, so a word costs memory in proportion to its length.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import written

#: Letters of a word: ASCII and the upper half of Latin-1.
LETTERS = "A-Za-zÀ-ÿ"
SHORTEST, LEAST_COUNT, RATIO = 7, 2, 10
#: Of how many (row, word) pairs one is misspelt on purpose; 0 for none.
DAMAGE = 31
#: Distinct words that a counting task holds before it writes them out.
HELD_WORDS = 200_000
#: Gaps of more letters are represented by fingerprints.
LONG = 64
TERMINATOR = b"\0"
BLOCK_ROWS = 50_000
PRIME, BASE = (1 << 61) - 1, 1_000_003
SECOND_PRIME, SECOND_BASE = (1 << 89) - 1, 0x9E3779B97F4A7C15


def damaged(word: str, owner: bytes, every: int) -> str:
    """``word`` without one character if ``every`` divides the checksum of ``owner:word``, else as it is."""
    if every:
        h = zlib.crc32(word.encode(), zlib.crc32(owner + b":"))
        if h % every == 0:
            at = h % len(word)
            return word[:at] + word[at + 1:]
    return word


def count_words(docs: DataFrame, shortest: int = SHORTEST, least: int = LEAST_COUNT, every: int = DAMAGE) -> DataFrame:
    """(word, n) over the whole texts of ``docs`` (columns doc_id, text; null text has no words).

    Words are maximal runs of ``LETTERS`` with only A-Z lower-cased.  A null
    doc_id counts as the text ``null`` in the checksum.
    """
    find = re.compile(f"[a-zÀ-ÿ]{{{shortest},}}").findall

    def run(batches):
        held: Counter = Counter()

        def out():
            batch = pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], names=["word", "n"])
            held.clear()
            return batch

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if not text.is_valid:
                    continue
                own = Counter(find(str(text.as_buffer().to_pybytes().lower(), "utf-8", "replace")))
                owner = b"null" if doc is None else b"%d" % doc
                for word, n in own.items():
                    word = damaged(word, owner, every)
                    if len(word) >= shortest:
                        held[word] += n
                if len(held) >= HELD_WORDS:
                    yield out()
        if held:
            yield out()

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "word string, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def numbered(words: DataFrame) -> DataFrame:
    """(id, word, n) with ids that follow the words' order."""
    return written(words.orderBy("word").select(F.monotonically_increasing_id().alias("id"), "word", "n"), "spelling-words")


def gaps(word: str) -> Iterator[tuple[bytes, int]]:
    """(gap, edit) for every rotation of a word: edit 0 is the whole rotation, 1 lacks its last character, 2 lacks one that repeats the character before."""
    raw = word.encode("latin-1")
    n = len(raw)
    mark = fingerprints(raw) if n > LONG else None
    for i in range(n + 1):
        behind, before = raw[i:] + TERMINATOR if n <= LONG + 1 else b"", raw[:i] if n <= LONG + 1 else b""
        yield behind + before if n <= LONG else mark(i, n - i), 0
        if i:
            yield behind + before[:-1] if n <= LONG + 1 else mark(i - 1, n - i), 2 if i > 1 and raw[i - 2] == raw[i - 1] else 1


def fingerprints(raw: bytes) -> Callable[[int, int], bytes]:
    """A function of (start, rest): fingerprint of a word's first ``start`` and last ``rest`` characters in two prime fields, with their numbers."""
    sides = []
    for prime, base in ((PRIME, BASE), (SECOND_PRIME, SECOND_BASE)):
        heads, tails, powers = [0], [0], [1]
        for c, d in zip(raw, reversed(raw), strict=True):
            heads.append((heads[-1] + (c + 1) * powers[-1]) % prime)      # the first characters, the first of them lowest
            tails.append((d + 1 + tails[-1] * base) % prime)              # the last characters, the first of them lowest
            powers.append(powers[-1] * base % prime)
        sides.append((heads, tails, powers, prime))

    def mark(start: int, rest: int) -> bytes:
        a, b = ((heads[start] + tails[rest] * powers[start]) % prime for heads, tails, powers, prime in sides)
        return b"\xff" + (start + rest).to_bytes(8, "big") + start.to_bytes(8, "big") + a.to_bytes(8, "big") + b.to_bytes(12, "big")

    return mark


def rotations(words: DataFrame) -> DataFrame:
    """(gap, edit, id, n) for every rotation of every word."""
    schema = [("gap", pa.binary()), ("edit", pa.int32()), ("id", pa.int64()), ("n", pa.int64())]

    def block(columns):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, schema, strict=True)], names=[name for name, _ in schema])

    def run(batches):
        for batch in batches:
            keys, edits, ids, counts = [], [], [], []
            for i, word, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for gap, edit in gaps(word):
                    keys.append(gap)
                    edits.append(edit)
                    ids.append(i)
                    counts.append(n)
                    if len(keys) >= BLOCK_ROWS:
                        yield block((keys, edits, ids, counts))
                        keys, edits, ids, counts = [], [], [], []
            if keys:
                yield block((keys, edits, ids, counts))

    return words.select("id", "word", "n").mapInArrow(run, "gap binary, edit int, id long, n long")


def group_neighbours(rows: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int]]:
    """(id, near words, best count, best id) of the rows (edit, id, n) of one gap; the best is of largest n, then smallest id.

    Edited rows are near each other; the unedited row is near those of edit 1.
    """
    edited = sorted((-n, i) for edit, i, n in rows if edit)
    first = sorted((-n, i) for edit, i, n in rows if edit == 1)
    whole = [(-n, i) for edit, i, n in rows if not edit]
    out = []
    for edit, i, n in rows:
        near = first if not edit else whole if edit == 1 else []
        best = near[:1]
        count = len(near)
        if edit:
            best = best + [x for x in edited[:2] if x[1] != i][:1]
            count += len(edited) - 1
        if count:
            n_best, best_id = min(best)
            out.append((i, count, -n_best, best_id))
    return out


def neighbours(words: DataFrame) -> DataFrame:
    """(id, n_near, best_n, best_id) of each word with near words."""
    schema = [(name, pa.int64()) for name in ("id", "near", "best_n", "best_id")]

    def run(batches):
        """Scan sorted rows; the rows of a gap may go on in the next batch."""
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            if rest is not None:
                table = pa.concat_tables([rest, table])
            table = table.combine_chunks()
            if not table.num_rows:
                continue
            gap = table.column("gap").combine_chunks()
            same = pc.equal(gap[:-1], gap[1:]).to_numpy(zero_copy_only=False)
            last = table.num_rows - 1
            while last > 0 and same[last - 1]:                      # rows of the last gap wait: at most one per character of the alphabet
                last -= 1
            rest = table.slice(last)
            yield from scanned(table.slice(0, last), same[:max(0, last - 1)])
        if rest is not None:
            yield from scanned(rest, pc.equal(rest.column("gap")[:-1], rest.column("gap")[1:]).to_numpy() if rest.num_rows > 1 else [])

    def scanned(table, same):
        if not table.num_rows:
            return
        edit, ids, counts = (table.column(c).to_numpy() for c in ("edit", "id", "n"))
        found, at = [], 0
        shared = [k for k, s in enumerate(same) if s]               # rows equal to the next one
        while at < len(shared):
            start = end = shared[at]
            while at < len(shared) and shared[at] == end:
                end, at = end + 1, at + 1
            found += group_neighbours(list(zip(edit[start:end + 1].tolist(), ids[start:end + 1].tolist(), counts[start:end + 1].tolist(), strict=True)))
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*found, strict=True), schema, strict=True)], names=[name for name, _ in schema])

    rows = rotations(words).repartition("gap").sortWithinPartitions("gap")
    best = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best_id").alias("id")))
    return (rows.mapInArrow(run, "id long, near long, best_n long, best_id long")
            .groupBy("id").agg(F.sum("near").alias("n_near"), best.alias("best"))
            .select("id", "n_near", (-F.col("best.less")).alias("best_n"), F.col("best.id").alias("best_id")))


def roots(forms: DataFrame) -> DataFrame:
    """(id, root_id) of the rows (id, form_id): the last id reached from each by its forms.

    Every step raises the count tenfold, so doubling the steps ends after a few rounds.
    """
    now = written(forms.select("id", F.col("form_id").alias("root_id")), "spelling-roots")
    while True:
        ahead = now.select(F.col("id").alias("root_id"), F.col("root_id").alias("beyond"))
        moved = written(now.join(ahead, "root_id", "left").select("id", F.coalesce("beyond", "root_id").alias("root_id"), F.col("beyond").isNotNull().alias("moved")), "spelling-roots")
        now = moved.select("id", "root_id")
        if not moved.where("moved").limit(1).count():
            return now


def spelling_variants(docs: DataFrame, shortest: int = SHORTEST, least: int = LEAST_COUNT, ratio: int = RATIO, every: int = DAMAGE) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for each word of ``docs`` (columns doc_id, text; others are ignored).

    Words (see ``count_words``) have at least ``shortest`` characters and
    ``least`` occurrences.  ``form`` is the near word of largest n (ties: the
    smallest in code-point order) if that n is at least ``ratio`` times the
    word's, else null, as is ``form_n``; ``root`` follows forms to the last.
    Null and empty texts have no words, repeated rows count each, a table
    without words gives no rows, and a word of any length is compared whole.
    """
    words = numbered(count_words(docs, shortest, least, every))
    near = written(words.select("id", "n").join(neighbours(words), "id")
                   .select("id", "n_near", F.when(F.col("best_n") >= ratio * F.col("n"), F.col("best_id")).alias("form_id")), "spelling-near")
    last = roots(near.where("form_id is not null"))
    linked = near.join(last, "id", "left")
    form = words.select(F.col("id").alias("form_id"), F.col("word").alias("form"), F.col("n").alias("form_n"))
    root = words.select(F.col("id").alias("root_id"), F.col("word").alias("root"))
    named = linked.join(form, "form_id", "left").join(root, "root_id", "left").select("id", "form", "root", "n_near", "form_n")
    return (words.join(named, "id", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n"))

