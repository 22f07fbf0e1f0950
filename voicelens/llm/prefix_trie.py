"""Prefix trie of conversations as a distributed z-fast trie.

A conversation is a string of turns.  The prefix of its first d turns is named by
(d, two 64-bit numbers): the XOR over i <= d of hashes of (i, role and text of
turn i).  Only these numbers are moved; texts are read once.

* A *compacted* node stands for an edge of the trie: the prefixes of depths
  ``s + 1 ... e``, where s is its parent's depth and e its own.  Its *handle* is
  the prefix at the two-fattest depth of ``(s, e]``, the number with most
  trailing zero bits.  The node table is keyed by handles.
* A string finds its exit node by fat binary search: the two-fattest depth f of
  the interval ``(a, b]`` is looked up; a hit moves a to the node's depth (or ends
  the search within its edge), a miss moves b below f.  All strings search at
  once, each step is one hash join, and the length's bits bound the steps.
* Strings are inserted in batches.  Of the strings that leave the trie at the same
  place by the same turn one, drawn by a hash, goes in; so strings of a batch share
  nothing beyond the trie, edges are cut where strings leave them, and every
  string that waits has moved on to a deeper node.  A hot first turn or group of
  similar conversations takes a few more batches, not a task of its own.
* Members, leaves and savings of subtrees come from the pairs (string, compacted
  node on its path): every sum is partially aggregated, and a node's weight is
  counted at the string that names it.  Then edges are expanded to one row per
  prefix.

Equal conversations are one string from the start.  A distinct conversation is
one row of 24 bytes a turn.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import written

#: Ids of a conversation's members that are put together in one row, a range of ids at a time.
ID_RANGE = 4096
FAMILY, SHARED_TURNS = 5, 9
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, content, n_bytes): turns numbered from 1; a turn's content is a digest of role and text.

    Null turns come first; equal turns are ordered by role, then by the digest
    of the text.  Null role and text are empty; rows without conv_id belong to
    no conversation.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = (conversations.where("conv_id is not null")
            .select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"), role.alias("role"), F.sha2(text, 256).alias("digest"),
                    F.octet_length(text).cast("long").alias("n_bytes")))
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "digest")
    return rows.select("conv_id", F.row_number().over(order).cast("long").alias("pos"), F.sha2(F.concat_ws(":", F.octet_length("role").cast("string"), "role", "digest"), 256).alias("content"), "n_bytes")


def rebuilt_turns(turns: DataFrame, family: int = FAMILY, shared: int = SHARED_TURNS) -> tuple[DataFrame, DataFrame]:
    """(conv_id) of all conversations and (conv_id, d, content, n_bytes) of their rebuilt turns.

    Conversation c has the first ``h = crc32(c) % shared`` turns of conversation
    ``c - c % family`` (the remainder has the sign of c), then its own from h + 1 on.
    """
    sizes = turns.groupBy("conv_id").agg(F.count("*").alias("size"))
    convs = sizes.select("conv_id", (F.crc32(F.col("conv_id").cast("string")) % shared).alias("h"), (F.col("conv_id") - F.col("conv_id") % family).alias("base"))
    convs = written(convs.join(sizes.select(F.col("conv_id").alias("base"), F.col("size").alias("base_size")), "base", "left")
                    .select("conv_id", "base", "h", F.least("h", F.coalesce("base_size", F.lit(0))).alias("given")), "trie-conversations")
    own = turns.join(convs.select("conv_id", "h", "given"), "conv_id").where("pos > h").select("conv_id", (F.col("pos") - F.col("h") + F.col("given")).alias("d"), "content", "n_bytes")
    given = turns.where(F.col("pos") < shared).withColumnRenamed("conv_id", "base").join(convs, "base").where("pos <= h").select("conv_id", F.col("pos").alias("d"), "content", "n_bytes")
    return convs.select("conv_id"), own.unionByName(given)


def prefix_strings(convs: DataFrame, rebuilt: DataFrame) -> DataFrame:
    """(conv_id, k, pa, pb, pc): per conversation its number of turns, both numbers of each prefix and the bytes up to it."""
    path = Window.partitionBy("conv_id").orderBy("d")
    lanes = rebuilt.select("conv_id", "d", F.xxhash64("content", "d").alias("a"), F.xxhash64(F.lit("second"), "d", "content").alias("b"), "n_bytes")
    prefixes = lanes.select("conv_id", F.struct("d", F.bit_xor("a").over(path).alias("a"), F.bit_xor("b").over(path).alias("b"), F.sum("n_bytes").over(path).alias("c")).alias("p"))
    lists = prefixes.groupBy("conv_id").agg(F.sort_array(F.collect_list("p")).alias("p")).select("conv_id", "p.a", "p.b", "p.c")
    none = F.array().cast("array<long>")
    return (convs.join(lists, "conv_id", "left")
            .select("conv_id", F.when(F.col("a").isNull(), 0).otherwise(F.size("a")).cast("long").alias("k"),
                    F.coalesce("a", none).alias("pa"), F.coalesce("b", none).alias("pb"), F.coalesce("c", none).alias("pc")))


def at(values: str, depth: Column | str) -> Column:
    """The entry of a path's array for a depth (0 for depth 0)."""
    depth = F.col(depth) if isinstance(depth, str) else depth
    return F.when(depth > 0, F.get(values, (depth - 1).cast("int"))).otherwise(F.lit(0).cast("long"))


def fattest(a: str, b: str) -> Column:
    """The number of ``(a, b]`` with most trailing zero bits."""
    return F.expr(f"shiftleft(shiftright({b}, length(bin({a} ^ {b})) - 1), length(bin({a} ^ {b})) - 1)")


def handled(nodes: DataFrame) -> DataFrame:
    """Nodes (s, sa, sb, sc, e, ea, eb, ec) with their key (e, ka, kb) and handle (f, fa, fb); the root has none."""
    return (nodes.withColumn("f", F.when(F.col("e") > F.col("s"), fattest("s", "e")).otherwise(0))
            .select("*", *(F.when(F.col("f") > 0, F.get(x, (F.col("f") - F.col("s") - 1).cast("int"))).otherwise(0).alias(y) for x, y in (("ea", "fa"), ("eb", "fb"))),
                    *(F.when(F.col("e") > F.col("s"), F.try_element_at(x, F.lit(-1))).otherwise(0).alias(y) for x, y in (("ea", "ka"), ("eb", "kb")))))


def root(df: DataFrame) -> DataFrame:
    """The trie of no strings: its root."""
    return df.sparkSession.sql("""select 0L s, 0L sa, 0L sb, 0L sc, 0L e, cast(array() as array<bigint>) ea, cast(array() as array<bigint>) eb, cast(array() as array<bigint>) ec""")


def locate(waiting: DataFrame, nodes: DataFrame, steps: int) -> DataFrame:
    """Waiting strings (sid, k, pa, pb, pc, a) with l, the depth at which they leave the trie, and the key (exit_d, exit_a, exit_b) of the edge they leave, if any."""
    handles = nodes.where("f > 0").select("f", "fa", "fb", F.col("s").alias("hs"), F.col("e").alias("he"), F.col("ka").alias("ha"), F.col("kb").alias("hb"))
    now = waiting.withColumn("b", F.col("k"))
    for _ in range(steps):                                          # strings that have ended their search get a key of their own that no handle has
        open_ = F.col("a") < F.col("b")
        now = now.withColumn("f", F.when(open_, fattest("a", "b")).otherwise(-1))
        now = (now.withColumn("fa", F.when(open_, at("pa", "f")).otherwise(F.xxhash64("sid"))).withColumn("fb", F.when(open_, at("pb", "f")).otherwise(0))
               .join(handles, ["f", "fa", "fb"], "left"))
        whole = (F.col("he") <= F.col("k")) & (at("pa", "he") == F.col("ha")) & (at("pb", "he") == F.col("hb"))
        now = now.select("sid", "k", "pa", "pb", "pc",
                         F.when(F.col("he").isNull(), F.col("a")).when(whole, F.col("he")).otherwise(F.col("hs")).alias("a"),
                         F.when(F.col("he").isNull(), F.when(open_, F.col("f") - 1).otherwise(F.col("b"))).when(whole, F.col("b")).otherwise(F.col("hs")).alias("b"))
    edges = nodes.where("f > 0").select((F.col("s") + 1).alias("d"), F.get("ea", 0).alias("da"), F.get("eb", 0).alias("db"), "e", "ka", "kb", "ea", "eb")
    on = F.col("a") < F.col("k")
    now = (now.select("sid", "k", "pa", "pb", "pc", "a", F.when(on, F.col("a") + 1).otherwise(-1).alias("d"),
                      F.when(on, at("pa", F.col("a") + 1)).otherwise(F.xxhash64("sid")).alias("da"), F.when(on, at("pb", F.col("a") + 1)).otherwise(0).alias("db"))
           .join(edges, ["d", "da", "db"], "left"))
    match = F.filter(F.col("ea"), lambda x, i: (x == F.get("pa", (F.col("a") + i).cast("int"))) & (F.get("eb", i) == F.get("pb", (F.col("a") + i).cast("int"))))
    return now.select("sid", "k", "pa", "pb", "pc", (F.col("a") + F.when(F.col("e").isNull(), 0).otherwise(F.size(match))).alias("l"),
                      F.col("e").alias("exit_d"), F.col("ka").alias("exit_a"), F.col("kb").alias("exit_b"))


def cut_edges(nodes: DataFrame, cuts: DataFrame) -> DataFrame:
    """Nodes with their edges cut at the depths of ``cuts`` (e, ka, kb, depth)."""
    cuts = cuts.groupBy("e", "ka", "kb").agg(F.sort_array(F.collect_set("depth")).alias("cuts"))  # at most the depths of one edge
    parts = nodes.join(cuts, ["e", "ka", "kb"], "left").withColumn("ends", F.concat(F.coalesce("cuts", F.array().cast("array<long>")), F.array("e")))
    part = F.posexplode("ends").alias("i", "to")
    parts = parts.select("s", "sa", "sb", "sc", "ea", "eb", "ec", "ends", part)
    start = F.when(F.col("i") > 0, F.get("ends", F.col("i") - 1)).otherwise(F.col("s"))
    parts = parts.withColumn("from", start).withColumn("skip", (F.col("from") - F.col("s")).cast("int")).withColumn("long", (F.col("to") - F.col("from")).cast("int"))
    name = [F.when(F.col("skip") > 0, F.get(e, F.col("skip") - 1)).otherwise(F.col(n)).alias(n) for e, n in (("ea", "sa"), ("eb", "sb"), ("ec", "sc"))]
    return parts.select(F.col("from").alias("s"), *name, F.col("to").alias("e"), *(F.slice(e, F.col("skip") + 1, F.col("long")).alias(e) for e in ("ea", "eb", "ec")))


def build(strings: DataFrame) -> DataFrame:
    """The compacted nodes of distinct strings (sid, k, pa, pb, pc)."""
    longest = strings.agg(F.max("k")).first()[0] or 0
    nodes, waiting, batch = handled(root(strings)), strings.where("k > 0").withColumn("a", F.lit(0).cast("long")), 0
    while True:
        found = written(locate(waiting, nodes, int(longest).bit_length() if batch else 0), "trie-located")
        leaving = found.where("l < k")
        turn = [F.col("l").alias("l"), at("pa", F.col("l") + 1).alias("ta"), at("pb", F.col("l") + 1).alias("tb")]
        chosen = (leaving.select("sid", *turn).groupBy("l", "ta", "tb").agg(F.min(F.struct(F.xxhash64("sid", F.lit(batch)).alias("by"), "sid")).alias("first")).select(F.col("first.sid").alias("sid")))
        placed = written(leaving.join(chosen.withColumn("goes", F.lit(True)), "sid", "left").withColumn("goes", F.coalesce("goes", F.lit(False))), "trie-batch")
        going = placed.where("goes")
        cuts = (going.where("l < exit_d").select(F.col("exit_d").alias("e"), F.col("exit_a").alias("ka"), F.col("exit_b").alias("kb"), F.col("l").alias("depth"))
                .unionByName(found.where("l = k and k < exit_d").select(F.col("exit_d").alias("e"), F.col("exit_a").alias("ka"), F.col("exit_b").alias("kb"), F.col("k").alias("depth"))))
        rest = lambda x: F.slice(x, (F.col("l") + 1).cast("int"), (F.col("k") - F.col("l")).cast("int"))
        tails = going.select(F.col("l").alias("s"), at("pa", "l").alias("sa"), at("pb", "l").alias("sb"), at("pc", "l").alias("sc"), F.col("k").alias("e"),
                             rest("pa").alias("ea"), rest("pb").alias("eb"), rest("pc").alias("ec"))
        nodes = written(handled(cut_edges(nodes, cuts).unionByName(tails)), "trie-nodes")
        waiting, batch = placed.where("not goes").select("sid", "k", "pa", "pb", "pc", F.col("l").alias("a")), batch + 1
        if not waiting.limit(1).count():
            return nodes


def end_digests(members: DataFrame) -> DataFrame:
    """(k, ka, kb, ends): SHA-256 of the ascending ids of the conversations that are equal, joined by commas.

    Ids are joined a range of ids at a time, anywhere; the ranges of one
    conversation are then streamed in order through one hash.
    """
    ranges = (members.groupBy("k", "ka", "kb", F.floor(F.col("conv_id") / ID_RANGE).cast("long").alias("range"))
              .agg(F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids")))
    names = ["k", "ka", "kb", "ends"]

    def run(batches):
        key, state = None, None
        for batch in batches:
            done = []
            for k, ka, kb, ids in zip(*(batch.column(i).to_pylist() for i in (0, 1, 2, 4)), strict=True):
                if (k, ka, kb) == key:
                    state.update(b",")
                else:
                    if key is not None:
                        done.append((*key, state.hexdigest()))
                    key, state = (k, ka, kb), hashlib.sha256()
                state.update(ids.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], names=names)
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*key, state.hexdigest())], names=names)

    same = ["k", "ka", "kb"]
    return ranges.repartition(*same).sortWithinPartitions(*same, "range").select(*same, "range", "ids").mapInArrow(run, "k long, ka long, kb long, ends string")


def summed(strings: DataFrame, nodes: DataFrame) -> DataFrame:
    """Per compacted node (e, ka, kb): conv_id, n_convs, n_children, n_leaves and saved (over its subtree, its whole edge included)."""
    depths = F.explode(F.sequence(F.lit(0).cast("long"), F.col("k"))).alias("e")
    keys = nodes.select("e", "ka", "kb", (F.try_element_at("ec", F.lit(-1)) - F.col("sc")).alias("edge_bytes"))
    prefixes = strings.select("sid", "n", "k", "pa", "pb", depths).select("sid", "n", "e", at("pa", "e").alias("ka"), at("pb", "e").alias("kb"))
    pairs = written(prefixes.join(keys.drop("edge_bytes"), ["e", "ka", "kb"], "left_semi"), "trie-paths")
    counts = pairs.groupBy("e", "ka", "kb").agg(F.min("sid").alias("conv_id"), F.sum("n").alias("n_convs"))
    children = nodes.where("f > 0").groupBy(F.col("s").alias("e"), F.col("sa").alias("ka"), F.col("sb").alias("kb")).agg(F.count("*").alias("n_children"))
    counts = written(counts.join(keys, ["e", "ka", "kb"]).join(children, ["e", "ka", "kb"], "left")
                     .select("e", "ka", "kb", "conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
                             ((F.col("n_convs") - 1) * F.coalesce("edge_bytes", F.lit(0))).alias("weight")), "trie-counts")
    named = counts.select("e", "ka", "kb", F.col("conv_id").alias("sid"), "weight", (F.col("n_children") == 0).cast("long").alias("leaf"))
    below = Window.partitionBy("sid").orderBy(F.desc("e"))
    sums = (pairs.join(named, ["e", "ka", "kb", "sid"], "left")
            .select("e", "ka", "kb", F.sum(F.coalesce("weight", F.lit(0))).over(below).alias("saved"), F.sum(F.coalesce("leaf", F.lit(0))).over(below).alias("leaves"))
            .groupBy("e", "ka", "kb").agg(F.sum("saved").alias("saved"), F.sum("leaves").alias("n_leaves")))
    return counts.drop("weight").join(sums, ["e", "ka", "kb"])


def conversation_trie(conversations: DataFrame, family: int = FAMILY, shared: int = SHARED_TURNS) -> DataFrame:
    """One row per trie node of the rebuilt conversations (columns conv_id, turn, role, text; others are ignored).

    (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256): a node is a distinct sequence of first turns,
    named by its smallest member; see ``numbered_turns`` for nulls and ties and
    ``rebuilt_turns`` for the conversations.  Repeated rows are turns of their
    own; a conversation without turns is a member of the root; an empty table
    has no node.
    """
    convs, rebuilt = rebuilt_turns(written(numbered_turns(conversations), "trie-turns"), family, shared)
    whole = written(prefix_strings(convs, rebuilt).select("*", at("pa", "k").alias("ka"), at("pb", "k").alias("kb")), "trie-rebuilt")
    members = whole.select("conv_id", "k", "ka", "kb")
    same = members.groupBy("k", "ka", "kb").agg(F.min("conv_id").alias("sid"), F.count("*").alias("n")).select("sid", "n")
    strings = written(whole.select(F.col("conv_id").alias("sid"), "k", "pa", "pb", "pc").join(same, "sid"), "trie-strings")
    nodes = build(strings.drop("n"))
    sums = written(summed(strings, nodes), "trie-sums")
    parents = sums.select(F.col("e").alias("s"), F.col("ka").alias("sa"), F.col("kb").alias("sb"), F.col("conv_id").alias("parent"))
    ends = end_digests(members).withColumnRenamed("k", "e")
    edges = nodes.join(sums, ["e", "ka", "kb"]).join(ends, ["e", "ka", "kb"], "left").join(parents, ["s", "sa", "sb"])
    first, last = F.col("depth") == F.col("s") + 1, F.col("depth") == F.col("e")
    before = F.when(first | (F.col("e") == 0), F.col("sc")).otherwise(F.get("ec", (F.col("depth") - F.col("s") - 2).cast("int")))
    edges = edges.select("*", F.explode(F.sequence(F.when(F.col("e") == 0, F.lit(0).cast("long")).otherwise(F.col("s") + 1), F.col("e"))).alias("depth"))
    return edges.select(
        "conv_id", "depth", F.when(F.col("depth") > 0, F.when(first, F.col("parent")).otherwise(F.col("conv_id"))).alias("parent_conv_id"), "n_convs",
        F.when(last, F.col("n_children")).otherwise(1).cast("long").alias("n_children"), "n_leaves",
        (F.col("saved") - (F.col("n_convs") - 1) * (before - F.col("sc"))).alias("saved_tokens"),
        F.when(last, F.coalesce("ends", F.lit(EMPTY_SHA256))).otherwise(EMPTY_SHA256).alias("ends_sha256"))


#: The checksum's bits, taken one by one from the digits' codes.
CRC32 = """xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split({0}, ''), lambda c: [ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
  lambda a, x: xor(xor(a, x) >> 1, 3988292384::BIGINT * (xor(a, x) & 1))), 4294967295::BIGINT)"""

ORACLE_SQL = f"""
WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), sha256(coalesce(text, ''))) AS pos
           FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, conv_id - conv_id % 5 AS base, {CRC32.format("conv_id::VARCHAR")} % 9 AS h FROM (SELECT DISTINCT conv_id FROM t)),
r AS (SELECT c.conv_id, 0 AS part, pos, role, text FROM c JOIN t ON t.conv_id = c.base AND pos <= h
      UNION ALL SELECT c.conv_id, 1, pos, role, text FROM c JOIN t ON t.conv_id = c.conv_id AND pos > h),
n AS (SELECT conv_id, row_number() OVER o AS d, octet_length(encode(text)) AS b, list(sha256(length(role) || ':' || role || text)) OVER (o ROWS UNBOUNDED PRECEDING) AS p
      FROM r WINDOW o AS (PARTITION BY conv_id ORDER BY part, pos)),
m AS (SELECT conv_id, d, b, p FROM n UNION ALL SELECT conv_id, 0, 0, []::VARCHAR[] FROM c),
k AS (SELECT conv_id, max(d) AS k FROM m GROUP BY conv_id),
v AS (SELECT p, any_value(d) AS d, min(conv_id) AS conv_id, count(*) AS n, any_value(b) AS b,
             sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (d = k), '')) AS ends
      FROM m JOIN k USING (conv_id) GROUP BY p),
ch AS (SELECT p[1:len(p) - 1] AS p, count(*) AS n FROM v WHERE d > 0 GROUP BY ALL),
w AS (SELECT v.*, coalesce(ch.n, 0) AS kids FROM v LEFT JOIN ch ON ch.p = v.p),
up AS (SELECT p[1:j] AS p, sum((n - 1) * b) AS saved, count(*) FILTER (kids = 0) AS leaves FROM (SELECT *, unnest(range(0, d + 1)) AS j FROM w) GROUP BY ALL)
SELECT w.conv_id, w.d::BIGINT AS depth, q.conv_id AS parent_conv_id, w.n::BIGINT AS n_convs, w.kids::BIGINT AS n_children, up.leaves::BIGINT AS n_leaves,
       up.saved::BIGINT AS saved_tokens, w.ends AS ends_sha256
FROM w JOIN up ON up.p = w.p LEFT JOIN w q ON w.d > 0 AND q.p = w.p[1:len(w.p) - 1]
"""
