"""CLS-6 fluency_regroup: greedy regrouping of sub-clauses by fluency.

From unit p, the candidates are the next 1..``window`` units joined; the one
with the lowest perplexity wins (the shortest on ties) and the walk goes on
behind it.  The original asked an external service for the perplexity; here
it comes from a bigram model of the corpus itself, counted with Spark:
P(w1) = (c(w1) + 1) / (N + V), P(b | a) = (c(a, b) + 1) / (c(a) + V),
perplexity = exp(−mean log P).

Documents are dealt into blocks of some ``BLOCK`` bytes.  A block sends each word and
pair that it holds once, with its own count, to the share that sums it over all blocks,
and gets the sums back in the order in which it asked; so what is shuffled is the texts,
once, and the distinct pairs of each block instead of every token.  A unit keeps the sum
of its tokens' bigram scores and both scores of its first token; a span's score is the
sum over its units, with the first word's bigram score exchanged for its own.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from ..functions import patterns as P
from ..functions.clauses import split_subclauses
from ..functions.stage import bind, stage
from ..functions.text import tokenize

#: Decimals of a mean log probability by which spans are compared.
DECIMALS = 9
#: Bytes of text in a block: some 1.3 million words, which a task holds in memory.
BLOCK = 8_000_000

#: A letter outside ``LETTER_CLASS`` (or one that becomes such a letter in lower case) without a neighbour of that class: only
#: a text with one can have words in chunks that are no units.
_LONE = "[à-öø-ÿÀ-ÖØ-Þß\u0130\u0178\u1e9e\u212a\u212b]"
LONE_LETTER = f"{_LONE}(?<!{P.LETTER_CLASS}{_LONE})(?!{P.LETTER_CLASS})"

PAGES = "share int, block int, words binary, n_words binary, pairs binary, n_pairs binary"
SUMS = "block int, share int, n_words binary, n_pairs binary, n long, v long"


def _words(c):
    return F.filter(tokenize(c), lambda t: t.rlike(P.jvm(P.LETTER_TOKEN)))


def _unit_words(units):
    return F.transform(units, _words)


# --- inside a task ---------------------------------------------------------------------

def _listed(column: pa.ChunkedArray) -> tuple[pa.Array, np.ndarray]:
    """The elements of a column of arrays, one after the other, and the length of each array (0 for null)."""
    lists = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    return lists.flatten(), pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def _ranked(*words: pa.Array) -> tuple[pa.Array, list[np.ndarray]]:
    """The distinct words in order, and each array as places in them."""
    coded = pa.concat_arrays(words).dictionary_encode()
    order = pc.sort_indices(coded.dictionary).to_numpy()
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    codes = rank[coded.indices.to_numpy()]
    return coded.dictionary.take(pa.array(order)), np.split(codes, np.cumsum([len(w) for w in words])[:-1])


def _starts(lengths: np.ndarray) -> np.ndarray:
    return np.cumsum(lengths) - lengths


def _followers(codes: np.ndarray, lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the pairs within the lists, and the places of their second words."""
    behind = np.ones(len(codes), bool)
    behind[_starts(lengths)[lengths > 0]] = False
    at = np.flatnonzero(behind)
    return codes[at - 1] * size + codes[at], at


def _asked(counted: list[np.ndarray], scored: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of a block in order (those it counts and those it only scores) and how often it counts each."""
    own, times = np.unique(np.concatenate(counted), return_counts=True)
    keys = np.union1d(own, np.concatenate(scored))
    n = np.zeros(len(keys), np.int64)
    n[np.searchsorted(keys, own)] = times
    return keys, n


def _shares(vocabulary: pa.Array, keys: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The share (below ``n``) that sums each word and each pair."""
    h = np.array([zlib.crc32(w.encode()) for w in vocabulary.to_pylist()], np.int64)
    size = max(len(h), 1)
    return h % n, (h[keys // size] * 31 + h[keys % size]) % n


def _by_share(shares: np.ndarray, n: int) -> list[np.ndarray]:
    """The places of each share, in order."""
    return np.split(np.argsort(shares, kind="stable"), np.cumsum(np.bincount(shares, minlength=n))[:-1])


def _packed(values) -> bytes:
    return zlib.compress(values.tobytes() if isinstance(values, np.ndarray) else "\n".join(values.to_pylist()).encode(), 1)


def _numbers(page: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(page), np.int64)


def _texts(page: bytes) -> list[str]:
    text = zlib.decompress(page).decode()
    return text.split("\n") if text else []


def _pages(n: int):
    def pages(block: pa.Table) -> pa.Table:
        """For each share the words and pairs of the block that it sums, with the block's counts."""
        (words, of_text), (scored, of_units) = _listed(block["words"]), _listed(block["scored"])
        vocabulary, (text, units) = _ranked(words, scored)
        size = len(vocabulary)
        keys, n_pairs = _asked([_followers(text, of_text, size)[0]], [_followers(units, of_units, size)[0]])
        n_words = np.bincount(text, minlength=size).astype(np.int64)
        pairs = pc.binary_join_element_wise(vocabulary.take(pa.array(keys // max(size, 1))), vocabulary.take(pa.array(keys % max(size, 1))), " ")
        w_at, p_at = (_by_share(s, n) for s in _shares(vocabulary, keys, n))
        rows = [(_packed(vocabulary.take(pa.array(w))), _packed(n_words[w]), _packed(pairs.take(pa.array(p))), _packed(n_pairs[p])) for w, p in zip(w_at, p_at, strict=True)]
        cols = [pa.array(c, pa.binary()) for c in zip(*rows, strict=True)]
        return pa.table([pa.array(range(n), pa.int32()), pa.array([block["block"][0].as_py()] * n, pa.int32()), *cols], ["share", "block", "words", "n_words", "pairs", "n_pairs"])
    return pages


def _sums(share: pa.Table) -> pa.Table:
    """The pages of a share with the counts summed over all blocks; n and v: its tokens and distinct words."""
    def summed(texts: str, counts: str) -> tuple[list[bytes], np.ndarray]:
        parts = [_texts(x.as_py()) for x in share[texts]]
        codes = pa.array([t for part in parts for t in part], pa.string()).dictionary_encode().indices.to_numpy()
        total = np.zeros(codes.max(initial=-1) + 1, np.int64)
        np.add.at(total, codes, np.concatenate([_numbers(x.as_py()) for x in share[counts]]))
        return [_packed(total[c]) for c in np.split(codes, np.cumsum([len(part) for part in parts])[:-1])], total

    words, total = summed("words", "n_words")
    pairs, _ = summed("pairs", "n_pairs")
    k = share.num_rows
    cols = [share["block"], share["share"], pa.array(words, pa.binary()), pa.array(pairs, pa.binary()), pa.array([int(total.sum())] * k, pa.int64()), pa.array([len(total)] * k, pa.int64())]
    return pa.table(cols, ["block", "share", "n_words", "n_pairs", "n", "v"])


def _best(m, total, first, instead, left, window: int) -> np.ndarray:
    """For each unit the length of the best span from it; ``left`` units of its document remain, itself included."""
    n = len(m)
    best, length_of = np.full(n, np.inf), np.ones(n, np.int64)
    sum_m, sum_total, start = np.zeros(n, np.int64), np.zeros(n), np.full(n, np.nan)
    for length in range(1, window + 1):                             # the next units, one more each time
        ok = np.flatnonzero(left >= length)
        at = ok + length - 1
        sum_m[ok] += m[at]
        sum_total[ok] += total[at]
        start[ok] = np.where(np.isnan(start[ok]), first[at] - instead[at], start[ok])
        some = ok[sum_m[ok] > 0]
        score = np.round(-(start[some] + sum_total[some]) / sum_m[some], DECIMALS)
        better = score < best[some]
        best[some[better]], length_of[some[better]] = score[better], length
    return length_of


def _spans(doc: np.ndarray, n_units: np.ndarray, m, total, first, instead, at, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(index of a text, first unit of a span), in order, for texts with the document numbers ``doc`` and ``n_units`` units each.

    Texts of one document are scored as one: its unit p is the p-th unit of all of them together.
    """
    of = np.repeat(np.arange(len(doc)), n_units)
    p = np.arange(len(of)) - _starts(n_units)[of]
    order = np.lexsort((at, p, doc[of]))
    d, p = doc[of][order], p[order]
    new = np.ones(len(d), bool)
    new[1:] = (d[1:] != d[:-1]) | (p[1:] != p[:-1])
    place = np.cumsum(new) - 1                                      # one for each unit number of a document
    head = np.flatnonzero(new)
    m, total = np.bincount(place, m[order], len(head)).astype(np.int64), np.bincount(place, total[order], len(head))
    first, instead = first[order][head], instead[order][head]       # of the earliest first token: units without tokens come last
    n_rows = np.bincount(d, minlength=doc.max(initial=-1) + 1)
    left = np.cumsum(n_rows)[d] - np.arange(len(d))
    lengths = np.full(len(head), window, np.int64)
    np.minimum.at(lengths, place, _best(m[place], total[place], first[place], instead[place], left, window))
    n_places = np.bincount(d[head], minlength=len(n_rows))
    ends, reach, chosen, q = np.cumsum(n_places)[d[head]].tolist(), lengths.tolist(), [], 0
    while q < len(reach):
        chosen.append(q)
        q = min(q + reach[q], ends[q])
    chosen = np.array(chosen, np.int64)
    spans = np.bincount(d[head][chosen], minlength=len(n_rows))     # of each document
    text = np.repeat(np.arange(len(doc)), spans[doc])
    k = np.arange(len(text)) - _starts(spans[doc])[text]
    return text, p[head][chosen][_starts(spans)[doc[text]] + k]


def _regrouped(window: int, names: list[str]):
    def regrouped(block: pa.Table, sums: pa.Table) -> pa.Table:
        """The sentences of the block's documents, scored with the sums over all blocks."""
        (units, n_units), (words, of_text) = _listed(block["units"]), _listed(block["words"])
        scored, m = _listed(pa.chunked_array([_listed(block["unit_words"])[0]]))
        vocabulary, (tokens, text) = _ranked(scored, words)
        size, of_units = len(vocabulary), np.bincount(np.repeat(np.arange(len(n_units)), n_units), m, len(n_units)).astype(np.int64)
        same = pc.is_null(block["words"]).to_numpy()
        follow, second = _followers(tokens, of_units, size)
        keys, _ = _asked([follow[np.repeat(same, of_units)[second]], _followers(text, of_text, size)[0]], [follow])
        sums = sums.sort_by("share")
        w_at, p_at = (np.concatenate(_by_share(s, sums.num_rows)) for s in _shares(vocabulary, keys, sums.num_rows))
        n_words, n_pairs = np.empty(size, np.int64), np.empty(len(keys), np.int64)
        n_words[w_at] = np.concatenate([_numbers(x.as_py()) for x in sums["n_words"]])
        n_pairs[p_at] = np.concatenate([_numbers(x.as_py()) for x in sums["n_pairs"]])
        n, v = float(pc.sum(sums["n"]).as_py()), float(pc.sum(sums["v"]).as_py())
        first = np.log((n_words[tokens] + 1) / (n + v)) if size else np.zeros(0)
        after = np.zeros(len(tokens))
        after[second] = np.log((n_pairs[np.searchsorted(keys, follow)] + 1) / (n_words[tokens[second - 1]] + v))
        total = np.bincount(np.repeat(np.arange(len(m)), m), after, len(m))
        lead = _starts(m)
        at = np.where(m > 0, lead - np.repeat(_starts(of_units), n_units), np.iinfo(np.int64).max)
        head = np.full((2, len(m)), np.nan)
        head[:, m > 0] = first[lead[m > 0]], after[lead[m > 0]]
        ids = pa.concat_arrays(block[names[0]].chunks)
        doc = ids.dictionary_encode("encode").indices.to_numpy().astype(np.int64)
        which, start = _spans(doc, n_units, m, total, *head, at, window)
        ends = np.frombuffer(units.buffers()[1], np.int32)[units.offset:units.offset + len(units) + 1] if len(units) else np.zeros(1, np.int32)
        cuts = np.append(_starts(n_units)[which] + np.minimum(start, n_units[which]), len(units))
        joined = pa.StringArray.from_buffers(len(which), pa.py_buffer(ends[cuts].tobytes()), units.buffers()[2] if len(units) else pa.py_buffer(b""))
        joined = pc.if_else(pc.is_null(block["units"]).to_numpy()[which], pa.scalar(None, pa.string()), joined)
        seq = np.arange(len(which)) - np.searchsorted(which, which)
        out = pa.table([ids.take(pa.array(which)), pa.array(seq, pa.int32()), joined], names)
        return out.filter(pc.is_valid(out[names[0]]))
    return regrouped


# --- the operator ----------------------------------------------------------------------

def fluency_regroup(docs: DataFrame, window: int = 4, text_col: str = "text") -> DataFrame:
    """(doc_id, seq, sentence): the regrouped sentences of each document, in order."""
    size = docs.agg(F.sum(F.octet_length(text_col)).alias("n")).first()["n"]
    n = int(size or 0) // BLOCK + 1
    place = F.when(F.col("doc_id").isNull(), F.xxhash64(text_col)).otherwise(F.xxhash64("doc_id"))
    dealt = docs.select("doc_id", F.col(text_col).alias("text"), F.pmod(place, F.lit(n)).cast("int").alias("block")).repartition(n, "block")
    apart = F.col("text").rlike(LONE_LETTER)                        # words of the units may not be the words of the text
    counted = stage(dealt.select("block", "doc_id", _words(F.col("text")).alias("words"), F.when(
        apart, F.flatten(bind(split_subclauses(F.col("text")), _unit_words))).alias("scored")), "words", "scored")
    pages = counted.groupBy("block").applyInArrow(_pages(n), PAGES)
    sums = pages.groupBy("share").applyInArrow(_sums, SUMS)
    units = stage(dealt.select("block", "doc_id", split_subclauses(F.col("text")).alias("units"), F.when(apart, _words(F.col("text"))).alias("words")), "units", "words")
    units = stage(units.select("*", _unit_words(F.col("units")).alias("unit_words")), "unit_words")
    schema = StructType([docs.schema["doc_id"], StructField("seq", IntegerType()), StructField("sentence", StringType())])
    return units.groupBy("block").cogroup(sums.groupBy("block")).applyInArrow(_regrouped(window, schema.names), schema)
