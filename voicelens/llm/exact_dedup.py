"""Exact dedup by composable polynomial fingerprints and streaming comparison.

A text's UTF-8 bytes are cut into chunks.  Each chunk has a polynomial hash
(modulo two primes), and hashes of neighbours combine by length-shifted
arithmetic: ``H(a + b) = H(a) * base ** len(b) + H(b)``.  A document of any
length is hashed chunk by chunk in constant memory, and the hashes of parts that
lie in different rows combine in any grouping (``combine``, ``fingerprint_parts``).

Rows with equal (fingerprint, length) are a *candidate group*.  Its texts are
then held, chunk by chunk, against the text of the row that stays.  A group is
split over salted sub-groups of bounded size, each with its own copy of that one
text, so a group of any size is compared in parallel and a task streams over its
rows with two texts in memory.  Rows whose text differs despite an equal
fingerprint are grouped anew by their SHA-256 and length.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import written

PRIMES = (2147483647, 2147483629)
BASES = (1103515245, 747796405)
CHUNK = 1 << 16
KEY_SCHEMA = "row_id long, doc_id long, n_bytes long, fingerprint long, text_sha256 string"
#: Rows of a candidate group that one sub-group compares.
ROWS_PER_SALT = 500
JOIN_SALTS = 16


def _powers(base: int, prime: int) -> np.ndarray:
    out = np.ones(1, np.uint64)
    while len(out) < CHUNK:  # doubling: base ** (k + len) = base ** k * base ** len
        out = np.concatenate([out, out * np.uint64(pow(base, len(out), prime)) % np.uint64(prime)])
    return out


#: Falling powers, so that the last byte of a chunk meets base ** 0.
_FALLING = [_powers(b, p)[::-1].copy() for b, p in zip(BASES, PRIMES, strict=True)]


def chunk_hash(data: np.ndarray) -> tuple[int, int]:
    """Hash pair of at most ``CHUNK`` bytes (255 * 2**31 * 2**16 fits 64 bits)."""
    wide = data.astype(np.uint64)
    return tuple(int(np.dot(wide, fall[CHUNK - len(wide):])) % p for fall, p in zip(_FALLING, PRIMES, strict=True))


def combine(a: tuple[int, int], b: tuple[int, int], b_bytes: int) -> tuple[int, int]:
    """Hash pair of a text from those of its two halves and the length of the second."""
    return tuple((x * pow(base, b_bytes, p) + y) % p for x, y, base, p in zip(a, b, BASES, PRIMES, strict=True))


def fingerprint(data: bytes) -> int:
    """62-bit fingerprint of a text, hashed chunk by chunk."""
    seen, view = (0, 0), np.frombuffer(data, np.uint8)
    for at in range(0, len(view), CHUNK):
        part = view[at:at + CHUNK]
        seen = combine(seen, chunk_hash(part), len(part))
    return seen[0] << 31 | seen[1]


def fingerprint_parts(parts: DataFrame, key: str, order: str, text: str) -> DataFrame:
    """(key, n_bytes, fingerprint) of documents stored as ordered parts in many rows.

    The parts are hashed in parallel where they lie.  A document's hash is the
    sum of its part hashes, each shifted by the bytes that follow it, so one
    grouped sum combines them without bringing the parts together.  A null
    part counts as empty.
    """
    from pyspark.sql import Window

    def run(batches):
        for batch in batches:
            data = [(t.as_py() or "").encode("utf-8", "surrogatepass") for t in batch.column(2)]
            prints = [fingerprint(d) for d in data]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([len(d) for d in data], pa.int64()), pa.array(prints, pa.int64())],
                names=["key", "part", "n", "print"])

    kind = parts.schema[key].dataType.simpleString()
    hashed = parts.select(F.col(key), F.col(order).cast("long"), F.col(text).cast("string")).mapInArrow(run, f"key {kind}, part long, n long, print long")
    after = Window.partitionBy("key").orderBy(F.col("part").desc())
    hashed = hashed.withColumn("behind", F.coalesce(F.sum("n").over(after.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))

    def shift(batches):
        for batch in batches:
            prints, behind = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            moved = [combine((h >> 31, h & 0x7FFFFFFF), (0, 0), b) for h, b in zip(prints, behind, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([m[0] for m in moved], pa.int64()), pa.array([m[1] for m in moved], pa.int64())], names=["key", "n", "h1", "h2"])

    shifted = hashed.select("key", "n", "print", "behind").mapInArrow(shift, f"key {kind}, n long, h1 long, h2 long")
    return (shifted.groupBy("key").agg(F.sum("n").alias("n_bytes"), (F.sum("h1") % PRIMES[0]).alias("h1"), (F.sum("h2") % PRIMES[1]).alias("h2"))
            .select(F.col("key").alias(key), "n_bytes", F.shiftleft("h1", 31).bitwiseOR(F.col("h2")).alias("fingerprint")))


def text_keys(docs: DataFrame) -> DataFrame:
    """Fingerprint, length and SHA-256 of each row; ``row_id`` tells rows apart."""

    def run(batches):
        for batch in batches:
            texts = [(t.as_py() or "").encode("utf-8", "surrogatepass") for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(t) for t in texts], pa.int64()), pa.array([fingerprint(t) for t in texts], pa.int64()),
                 pa.array([hashlib.sha256(t).hexdigest() for t in texts])], names=["doc_id", "n_bytes", "fingerprint", "text_sha256"])

    return (docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
            .mapInArrow(run, "doc_id long, n_bytes long, fingerprint long, text_sha256 string")
            .select(F.monotonically_increasing_id().alias("row_id"), "*"))


def differing_texts(batches):
    """Chunkwise comparison of sorted rows (fingerprint, n_bytes, bytes, salt) with the first row of their sub-group.

    Yields fingerprint, length and SHA-256 of the rows that differ; two texts are in memory at a time.
    """
    group, kept = None, b""
    for batch in batches:
        out = []
        for h, n, salt, data in zip(*(batch.column(c).to_pylist() for c in ("fingerprint", "n_bytes", "salt")), batch.column("bytes"), strict=True):
            view = memoryview(data.as_buffer()).cast("B")
            if (h, n, salt) != group:
                group, kept = (h, n, salt), memoryview(bytes(view))
                continue
            if any(view[at:at + CHUNK] != kept[at:at + CHUNK] for at in range(0, n, CHUNK)):
                out.append((h, n, hashlib.sha256(view).hexdigest()))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names=["fingerprint", "n_bytes", "text_sha256"])


def _differing(docs: DataFrame, groups: DataFrame) -> DataFrame:
    """SHA-256 values of those rows of candidate groups whose text is not that of the row that stays."""

    def read(batches):
        for batch in batches:
            texts = [(t.as_py() or "").encode("utf-8", "surrogatepass") for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(t) for t in texts], pa.int64()), pa.array([fingerprint(t) for t in texts], pa.int64()), pa.array(texts, pa.binary())],
                names=["doc_id", "n_bytes", "fingerprint", "bytes"])

    rows = (docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
            .mapInArrow(read, "doc_id long, n_bytes long, fingerprint long, bytes binary")
            .withColumn("_deal", F.pmod(F.xxhash64("doc_id"), F.lit(JOIN_SALTS)).cast("int")))
    dealt = groups.withColumn("_deal", F.explode(F.sequence(F.lit(0), F.lit(JOIN_SALTS - 1))))
    rows = rows.join(dealt, ["fingerprint", "n_bytes", "_deal"])
    stays = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    salts = F.ceil(F.col("group_size") / ROWS_PER_SALT).cast("int")
    own = F.pmod(F.xxhash64("doc_id", F.lit(7)), salts).cast("int")
    rows = rows.select("fingerprint", "n_bytes", "bytes", stays.alias("stays"),
                       F.explode(F.when(stays, F.sequence(F.lit(0), salts - 1)).otherwise(F.array(own))).alias("salt"))
    rows = rows.repartition("fingerprint", "n_bytes", "salt").sortWithinPartitions("fingerprint", "n_bytes", "salt", F.col("stays").desc())

    return rows.drop("stays").mapInArrow(differing_texts, "fingerprint long, n_bytes long, text_sha256 string").distinct()


def _groups(keys: DataFrame, by: list[str]) -> DataFrame:
    return keys.groupBy(*by).agg(F.max(F.struct("doc_id", "row_id")).alias("last"), F.count("*").alias("group_size")).select(
        *by, "group_size", F.col("last.doc_id").alias("keep_id"), F.col("last.row_id").alias("keep_row"))


def exact_dedup(docs: DataFrame) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) for each row of ``docs`` (columns doc_id, text; others are ignored).

    Of rows with equal text the one with the largest doc_id stays; of rows that
    share this doc_id too, exactly one.  Null text counts as empty, null doc_id
    as smaller than any other.  An empty table gives no rows.
    """
    by = ["fingerprint", "n_bytes"]
    keys = written(text_keys(docs), "text-keys")
    groups = _groups(keys, by).where("group_size > 1")
    differing = written(_differing(docs, groups.drop("keep_row")), "differing")
    if differing.limit(1).count():
        # unequal texts under one fingerprint: each SHA-256 is a group of its own
        split = keys.join(differing.select(*by).distinct().withColumn("variant_of", F.lit(True)), by, "left")
        keys = written(split.withColumn("variant", F.when(F.col("variant_of"), F.col("text_sha256"))).drop("variant_of"), "text-keys")
    else:
        keys = keys.withColumn("variant", F.lit(None).cast("string"))
    by = [*by, "variant"]
    groups = _groups(keys, by).where("group_size > 1").withColumnsRenamed({c: f"g_{c}" for c in by})
    same = [F.col(c).eqNullSafe(F.col(f"g_{c}")) for c in by]
    return keys.join(groups, same, "left").select(
        "doc_id", F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).alias("group_size"), F.coalesce(F.col("row_id") == F.col("keep_row"), F.lit(True)).alias("kept"), "text_sha256")


def kept_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; of repeated rows one."""
    one_key = lambda sha: F.concat_ws(":", F.col("doc_id").cast("long").cast("string"), sha)  # noqa: E731  equal for repeated rows alone
    kept = exact_dedup(docs).where("kept").select(one_key(F.col("text_sha256")).alias("_row"))
    rows = docs.withColumn("_row", one_key(F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)))
    return rows.join(kept, "_row", "left_semi").dropDuplicates(["_row"]).drop("_row")
