"""N-gram Jaccard join by parity sketches.

A document is its set of distinct word shingles (64-bit hashes).  XOR-ing each
shingle into a sketch of parity bits gives a sketch whose Hamming distance is at
most the symmetric difference of the sets, because each differing shingle flips
one bit.  Two sets of sizes a <= b with Jaccard >= p/100 differ in at most
``(a + b) * (100 - p) / (100 + p)`` shingles, so when the sketch is cut into more
blocks than that, some blocks are equal (pigeonhole).

* Sizes fall into bands.  The *space* of a band has a fixed number of blocks and
  holds the sets of the band and those sets of the next band which may link
  with it.  A block is wide and sparse, so it is stored as the XOR of the mixed
  positions of its bits: equal blocks give equal values.
* A set keeps d + 1 of its blocks, the rarest first: blocks that no other set has,
  then shared ones by the number of sets that have them, empty ones last.  By the
  prefix argument two linked sets still share a kept block, and the blocks of
  passages that many unrelated documents hold drop out.
* Sets that share a block are candidates.  In star rounds every set is held
  against a few pivots from the largest other components of its blocks, drawn by
  seeded orders, and links are contracted to components; the rounds go on while
  they link.  Then all remaining pairs that share a block across components are
  candidates, as a rule each in one of its blocks only.  So a large group of near copies costs no quadratic number of pairs,
  and no link between components is lost.
* A candidate pair passes the size bound and the Hamming distance of dense
  sketches (both inside the join), then the exact intersection of the sets.

Equal sets are one class from the start.  Texts are read twice by scans and are
not shuffled; what is shuffled is 16 bytes per block, and the shingle sets
of candidates.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .components import components
from .shared import small_side, written

SET_SCHEMA = "doc_id long, n_shingles long, set_id long, set_check long, side int, own_blocks int, own_keep int, low_blocks int, low_keep int"
BLOCK_SCHEMA = "block long, set_id long"
SHINGLES_SCHEMA = "set_id long, n long, sketch array<long>, shingles binary"
SKETCH_WORDS = 16
#: Pivots that a set is held against in a star round; rounds go on while one of so many sets finds a link.
PIVOTS, STAR_YIELD = 4, 50
#: Blocks of a set by which a pair is made in one shared block instead of all.
FIRST_BLOCKS = 16
#: Candidate rows up to which their ids are broadcast (8 bytes each).
BROADCAST_ROWS = 1_000_000
BAND = 1.5625
MEMO_WORDS = 100_000


class WordHashes(dict):
    """64-bit hash of each word, filled on first use."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


_words = WordHashes()


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words with well spread bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct hashes of the ``width``-word shingles of a text.

    Words are runs without ASCII white space, A-Z lower-cased.  A text with
    fewer words is one shingle; null, empty or blank text has none.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    if len(_words) > MEMO_WORDS:
        _words.clear()
    h = np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))
    n = max(1, len(words) - width + 1)
    total = np.full(n, min(len(words), width), np.uint64)
    for k in range(min(width, len(words))):
        total = total * np.uint64(0x9E3779B97F4A7C15) + h[k:k + n]
    return np.unique(mix(total))


def set_keys(shingles: np.ndarray) -> tuple[int, int]:
    """Two independent 64-bit digests of a set, as signed numbers."""
    return int(np.bitwise_xor.reduce(mix(shingles)).astype(np.int64)), int((shingles * shingles + shingles).sum(dtype=np.uint64).astype(np.int64))


class Bands:
    """Size bands and the number of blocks of each band's space."""

    def __init__(self, percent: int):
        self.percent = percent
        self.edges = [1]
        while self.edges[-1] < 1 << 40:
            self.edges.append(max(self.edges[-1] + 1, int(self.edges[-1] * BAND)))

    def differ(self, total: int) -> int:
        """Most shingles in which linked sets with this sum of sizes can differ."""
        return total * (100 - self.percent) // (100 + self.percent)

    def spaces(self, n: int):
        """(space, blocks of the space, blocks to keep) for a set of ``n`` shingles."""
        band = int(np.searchsorted(self.edges, n, side="right")) - 1
        for space in (band, band - 1):
            if space < 0:
                continue
            last = self.edges[space + 1] - 1                    # largest size of the band
            if n > last * 100 // self.percent:                  # too large for any set of the band
                continue
            most = self.differ(last + last * 100 // self.percent)
            partner = min(n * 100 // self.percent, last * 100 // self.percent) if space == band else last
            yield space, most + 1 + max(16, last // 16), self.differ(n + partner) + 1

    def places(self, shingles: np.ndarray):
        """(space, blocks, keep, block of each shingle) for each space of a set."""
        for space, blocks, keep in self.spaces(len(shingles)):
            yield space, blocks, keep, ((shingles >> np.uint64(20)) % np.uint64(blocks)).astype(np.uint16 if blocks < 1 << 16 else np.int64)

    def extent(self, shingles: np.ndarray) -> tuple[int, int, int, int, int]:
        """Parity of the set's own space; blocks that it shows and keeps in its own space and in the one below."""
        out = {}
        for space, blocks, keep, at in self.places(shingles):
            full = int((np.bincount(at, minlength=blocks) > 0).sum())
            out[space] = (full if full >= keep else blocks, keep)
        spaces = sorted(out, reverse=True)
        band = int(np.searchsorted(self.edges, len(shingles), side="right")) - 1
        return (band & 1, *out.get(band, (0, 0)), *(out[spaces[-1]] if spaces[-1] != band else (0, 0)))

    def blocks(self, shingles: np.ndarray) -> np.ndarray:
        """Keys of the blocks that a set shows: bit 0 is the parity of the space, bit 1 tells an empty block.

        Empty blocks are shown only if the others are too few to keep.
        """
        out = []
        bits = mix(shingles + np.uint64(0x9E3779B97F4A7C15))
        for space, blocks, keep, at in self.places(shingles):
            order = np.argsort(at, kind="stable")
            at, value = at[order], bits[order]
            first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
            at, value = at[first].astype(np.uint64), np.bitwise_xor.reduceat(value, first)
            key = mix(value ^ mix(at + np.uint64(space * 1_000_003 + 1))) & ~np.uint64(3)
            if len(at) < keep:
                empty = np.setdiff1d(np.arange(blocks, dtype=np.uint64), at)
                key = np.r_[key, mix(mix(empty + np.uint64(space * 1_000_003 + 1))) & ~np.uint64(3) | np.uint64(2)]
            out.append(key | np.uint64(space & 1))
        return np.concatenate(out) if out else np.empty(0, np.uint64)


def parity_sketch(shingles: np.ndarray) -> np.ndarray:
    """``SKETCH_WORDS`` words of parity bits."""
    odd = np.bincount((shingles % np.uint64(64 * SKETCH_WORDS)).astype(np.int64), minlength=64 * SKETCH_WORDS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _batch(schema: list[tuple[str, pa.DataType]], columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, schema, strict=True)], names=[n for n, _ in schema])


def shingle_sets(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """Size, digests and block counts of each document's shingle set."""
    bands = Bands(percent)
    schema = [(n, pa.int64()) for n in ("doc_id", "n_shingles", "set_id", "set_check")]
    schema += [(n, pa.int32()) for n in ("side", "own_blocks", "own_keep", "low_blocks", "low_keep")]

    def run(batches):
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                s = shingle_set(text.as_py(), width)
                rows.append((doc, len(s), *set_keys(s), *(bands.extent(s) if len(s) else (0,) * 5)))
            if rows:
                yield _batch(schema, zip(*rows, strict=True))

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, SET_SCHEMA)


def sketch_blocks(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """Sketch blocks of each distinct shingle set of a task."""
    bands = Bands(percent)

    def run(batches):
        seen: set[int] = set()
        for batch in batches:
            keys, owners = [], []
            for text in batch.column(0):
                shingles = shingle_set(text.as_py(), width)
                if not len(shingles):
                    continue
                owner = set_keys(shingles)[0]
                if owner not in seen:
                    seen.add(owner)
                    blocks = bands.blocks(shingles)
                    keys.append(blocks.astype(np.int64))
                    owners.append(np.full(len(blocks), owner))
                if len(keys) == 256:
                    yield _batch([("block", pa.int64()), ("set_id", pa.int64())], (np.concatenate(keys), np.concatenate(owners)))
                    keys, owners = [], []
            if keys:
                yield _batch([("block", pa.int64()), ("set_id", pa.int64())], (np.concatenate(keys), np.concatenate(owners)))

    return docs.select(F.col("text").cast("string")).mapInArrow(run, BLOCK_SCHEMA)


def _shingles_of(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """Shingle sets of the wanted representatives (columns set_id, doc_id)."""
    wanted_ids = small_side(wanted.select(F.col("doc_id").alias("_want")), BROADCAST_ROWS)
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    texts = texts.join(wanted_ids, F.col("doc_id").eqNullSafe(F.col("_want")), "left_semi")
    schema = [("set_id", pa.int64()), ("n", pa.int64()), ("sketch", pa.list_(pa.int64())), ("shingles", pa.binary())]

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                sets = [s for t in batch.column(1).slice(at, 512) if len(s := shingle_set(t.as_py(), width))]
                if sets:
                    yield _batch(schema, ([set_keys(s)[0] for s in sets], [len(s) for s in sets], [parity_sketch(s) for s in sets], [s.tobytes() for s in sets]))

    sets = written(texts.mapInArrow(run, SHINGLES_SCHEMA), "shingle-sets")
    if sets.groupBy("set_id").agg(F.count("*").alias("n")).where("n > 1").limit(1).count():  # rows that repeat a doc_id
        sets = written(sets.dropDuplicates(["set_id"]), "shingle-sets")
    return sets


def may_link(a: str, b: str, percent: int):
    """Size bound and Hamming bound of two rows with columns n and sketch."""
    n, m = F.col(f"{a}.n"), F.col(f"{b}.n")
    differ = sum(F.bit_count(F.get(f"{a}.sketch", i).bitwiseXOR(F.get(f"{b}.sketch", i))) for i in range(SKETCH_WORDS))
    return (F.least(n, m) * 100 >= F.greatest(n, m) * percent) & (differ * (100 + percent) <= (n + m) * (100 - percent))


def verify(pairs: DataFrame, sets: DataFrame, percent: int = 80) -> DataFrame:
    """Those pairs (x, y) of set ids whose sets link."""
    brief = sets.select("set_id", "n", "sketch")
    near = (pairs.alias("p").join(brief.alias("a"), F.col("p.x") == F.col("a.set_id"))
            .join(brief.alias("b"), (F.col("p.y") == F.col("b.set_id")) & may_link("a", "b", percent)).select("p.x", "p.y"))
    left = sets.select(F.col("set_id").alias("x"), F.col("shingles").alias("sx"))
    right = sets.select(F.col("set_id").alias("y"), F.col("shingles").alias("sy"))
    both = near.join(left, "x").join(right, "y").select("x", "y", "sx", "sy")

    def run(batches):
        for batch in batches:
            found = []
            for x, y, a, b in zip(*batch.columns, strict=True):
                a, b = np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64)
                common = len(np.intersect1d(a, b, assume_unique=True))
                if 100 * common >= percent * (len(a) + len(b) - common):
                    found.append((x.as_py(), y.as_py()))
            if found:
                yield _batch([("x", pa.int64()), ("y", pa.int64())], zip(*found, strict=True))

    return both.mapInArrow(run, "x long, y long")


def kept_blocks(blocks: DataFrame, classes: DataFrame) -> DataFrame:
    """(block, set_id): shared blocks that belong to the d + 1 rarest of their set and space."""
    by_block = Window.partitionBy("block")
    shared = (blocks.select("block", "set_id", F.min("set_id").over(by_block).alias("least"), F.max("set_id").over(by_block).alias("most"), F.count("*").over(by_block).alias("sets"))
              .where("least != most").groupBy("block", "set_id").agg(F.min("sets").alias("sets")))
    side = F.col("block").bitwiseAND(1)
    limits = classes.select("set_id", F.explode(F.array(
        F.struct(F.col("side").cast("long").alias("side"), F.col("own_blocks").alias("shown"), F.col("own_keep").alias("keep")),
        F.struct((1 - F.col("side")).cast("long").alias("side"), F.col("low_blocks").alias("shown"), F.col("low_keep").alias("keep")))).alias("l")).select("set_id", "l.*")
    own = Window.partitionBy("set_id", "side")
    ranked = (shared.withColumn("side", side).join(limits, ["set_id", "side"])
              .select("block", "set_id", "shown", "keep", F.count("*").over(own).alias("common"),
                      F.row_number().over(own.orderBy(F.col("block").bitwiseAND(2), "sets", "block")).alias("nth")))
    return ranked.where("shown - common + nth <= keep").select("block", "set_id")


def star_pairs(placed: DataFrame, turn: int) -> DataFrame:
    """(x, y): every set y of a block with sets of other components, and its pivots x.

    A block's pivots are ``PIVOTS`` sets drawn by seeded hashes from its largest
    component; of its blocks a set takes, in turn, the one with the largest
    component and the one with the fewest sets.
    """
    by_block = Window.partitionBy("block")
    drawn = [F.min(F.struct((-F.col("size")).alias("size"), F.xxhash64("part", F.lit(turn)).alias("by"), "part", F.xxhash64("set_id", F.lit(turn), F.lit(k)).alias("nth"), F.col("set_id").alias("x"))).over(by_block).alias(f"pivot{k}")
             for k in range(PIVOTS)]
    drawn = placed.select("set_id", "part", F.count("*").over(by_block).alias("sets"), *drawn).where("part != pivot0.part")
    first = [F.min(F.struct(*([] if k % 2 == 0 else ["sets"]), f"pivot{k}.size", f"pivot{k}.by", f"pivot{k}.nth", f"pivot{k}.x")).alias(f"pivot{k}") for k in range(PIVOTS)]
    chosen = drawn.groupBy(F.col("set_id").alias("y")).agg(*first)
    return chosen.select(F.explode(F.array_distinct(F.array(*[F.col(f"pivot{k}.x") for k in range(PIVOTS)]))).alias("x"), "y").select("x", "y")


def across_pairs(placed: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(x, y): sets of different components that share a block and may link.

    A set carries its ``FIRST_BLOCKS`` smallest blocks.  A pair that has several of
    them in common is made in the smallest one only, a pair that has none in every
    block it shares; so each pair is made at least once.
    """
    nth = F.row_number().over(Window.partitionBy("set_id").orderBy("block"))
    first = placed.select("set_id", "block", nth.alias("nth")).where(F.col("nth") <= FIRST_BLOCKS).groupBy("set_id").agg(F.collect_list("block").alias("first"))
    rows = placed.join(first, "set_id").join(sets.select("set_id", "n", "sketch"), "set_id")
    a, b = rows.alias("a"), rows.alias("b")
    here = F.coalesce(F.array_min(F.array_intersect("a.first", "b.first")) >= F.col("a.block"), F.lit(True))
    pairs = a.join(b, (F.col("a.block") == F.col("b.block")) & (F.col("a.part") < F.col("b.part")) & may_link("a", "b", percent) & here)
    return pairs.select(F.col("a.set_id").alias("x"), F.col("b.set_id").alias("y"))


def links(docs: DataFrame, classes: DataFrame, width: int, percent: int) -> DataFrame:
    """Verified links (x, y) between set ids; their components are those of all linked pairs."""
    by_block = Window.partitionBy("block")
    shared = written(kept_blocks(sketch_blocks(docs, width, percent), classes), "kept-blocks")
    shared = written(shared.select("*", F.min("set_id").over(by_block).alias("least"), F.max("set_id").over(by_block).alias("most"))
                     .where("least != most").select("block", "set_id"), "shared-blocks")
    wanted = shared.select("set_id").distinct().join(classes.select("set_id", F.col("rep").alias("doc_id")), "set_id")
    sets = _shingles_of(docs, wanted, width)
    found, turn = None, 0
    placed = shared.select("*", F.col("set_id").alias("part"), F.lit(1).cast("long").alias("size"))
    while True:
        new = written(verify(star_pairs(placed, turn), sets, percent), "star-links")
        left, linked, turn = placed.select("set_id").distinct().count(), new.count(), turn + 1
        found = new if found is None else written(found.unionByName(new), "star-links")
        parts = components(found, "x", "y")
        parts = parts.join(parts.groupBy("component").agg(F.count("*").alias("size")), "component").withColumnRenamed("node", "set_id")
        mixed = (shared.join(parts, "set_id", "left").select("block", "set_id", F.coalesce("component", "set_id").alias("part"), F.coalesce("size", F.lit(1)).alias("size"))
                 .select("*", F.min("part").over(by_block).alias("low"), F.max("part").over(by_block).alias("high")))
        placed = written(mixed.where("low != high").select("block", "set_id", "part", "size"), "mixed-blocks")
        if linked * STAR_YIELD < left or not linked:
            break
    across = across_pairs(placed, sets, percent).distinct()
    return found.unionByName(written(verify(across, sets, percent), "cross-links"))


def jaccard_components(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id) of each row of ``docs`` (columns doc_id, text; others are ignored).

    Two documents link when ``100 * intersection >= percent * union`` of their
    shingle sets.  ``component_id`` is the smallest doc_id reachable by links,
    the row's own included; a document without words links with nothing.  A row
    with null doc_id takes part, its id never names a component unless all ids
    are null; rows with repeated doc_id are documents of their own.  An empty
    table gives no rows.
    """
    sets = written(shingle_sets(docs, width, percent), "set-keys")
    extent = [F.max(c).alias(c) for c in ("side", "own_blocks", "own_keep", "low_blocks", "low_keep")]  # equal for equal sets
    classes = written(sets.where("n_shingles > 0").groupBy("n_shingles", "set_id", "set_check").agg(F.min("doc_id").alias("rep"), *extent), "set-classes")
    parts = components(links(docs, classes, width, percent), "x", "y")
    named = classes.join(parts.withColumnRenamed("node", "set_id"), "set_id", "left").withColumn("component", F.coalesce("component", "set_id"))
    least = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    named = named.join(least, "component").select("n_shingles", "set_id", "set_check", "component_id")
    return (sets.join(named, ["n_shingles", "set_id", "set_check"], "left")
            .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")))


def kept_documents(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` without near copies, with all columns: of each component the row whose doc_id names it stays.

    Rows are told apart by doc_id; of rows that share a doc_id all stay if one does.
    """
    found = jaccard_components(docs, width, percent)
    stays = F.col("doc_id").eqNullSafe(F.col("component_id"))
    gone = written(found.groupBy("doc_id").agg(F.max(stays).alias("stays")).where("not stays").select(F.col("doc_id").alias("_gone")), "near-copies")
    return docs.join(small_side(gone, BROADCAST_ROWS), F.col("doc_id").cast("long").eqNullSafe(F.col("_gone")), "left_anti")
