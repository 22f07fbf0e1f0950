"""KEY-3 TextRank keywords (Mihalcea & Tarau 2004).

Edges: word pairs within ``span`` tokens of each other, weighted by their count, both
directions; rows with equal doc_id are one graph, a null doc_id is none.  What is shuffled is the
texts, once, by doc_id.  The words of a text are made in its row; the edges and the rank
steps of some documents at a time are arrays in the Arrow batches of the task that holds
them, so no edge and no rank moves or is written.  A step adds, over all edges of these
documents, the source's rank times the edge's share to the target.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

from ..functions import patterns as P
from ..functions.stage import stage
from ..functions.text import not_in, tokenize

#: Decimals of a rank by which words are ordered; beyond them the order of a sum shows.
DECIMALS = 12
#: Words of the documents that are worked on at a time (a longer document alone).
WORDS = 200_000


def _ranks(doc: np.ndarray, lengths: np.ndarray, codes: np.ndarray, span: int, damping: float, steps: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, word, rank) of the graphs' nodes; ``doc`` and ``lengths`` are of the texts, ``codes`` their words one after the other."""
    text, size = np.repeat(np.arange(len(lengths)), lengths), int(codes.max(initial=0)) + 1
    pairs = []
    for d in range(1, span):
        at = np.flatnonzero((text[:-d] == text[d:]) & (codes[:-d] != codes[d:]))
        pairs.append(np.stack([at, at + d]))
    one, other = np.concatenate(pairs, axis=1) if pairs else np.zeros((2, 0), np.int64)
    word = doc[text] * size + codes                                 # the word of a document
    nodes, ends = np.unique(np.concatenate([word[one], word[other]]), return_inverse=True)
    src, dst = ends, np.roll(ends, len(one))                        # both directions
    edges, weight = np.unique(src * max(len(nodes), 1) + dst, return_counts=True)
    src, dst = np.divmod(edges, max(len(nodes), 1))
    share = weight / np.bincount(src, weight, len(nodes))[src]
    of = nodes // size
    r = 1.0 / np.bincount(of)[of] if len(nodes) else np.zeros(0)
    for _ in range(steps):
        r = (1 - damping) + damping * np.bincount(dst, share * r[src], len(nodes))
    return of, nodes % size, r


def _keywords(ids: pa.Array, words: pa.Array, span: int, damping: float, steps: int, k: int, names: list[str]):
    """Record batches of the top ``k`` words of each document; equal ids lie together, and documents are cut into parts of ``WORDS`` words."""
    if not len(ids):
        return
    doc = ids.dictionary_encode().indices.to_numpy().astype(np.int64)
    lengths = pc.fill_null(pc.list_value_length(words), 0).to_numpy().astype(np.int64)
    flat = words.flatten().dictionary_encode()
    order = pc.sort_indices(flat.dictionary).to_numpy()
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))                            # words in the order of their bytes
    codes, terms = place[flat.indices.to_numpy()], flat.dictionary.take(pa.array(order))
    firsts = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
    ends = np.cumsum(lengths)
    part = (ends[firsts] - lengths[firsts]) // WORDS                # of each document's first text
    cuts = firsts[np.append(True, part[1:] != part[:-1])].tolist()
    for a, b in zip(cuts, [*cuts[1:], len(doc)], strict=True):
        low, high = int(ends[a] - lengths[a]), int(ends[b - 1])
        of, word, r = _ranks(doc[a:b] - doc[a], lengths[a:b], codes[low:high], span, damping, steps)
        by = np.lexsort((word, -np.round(r, DECIMALS), of))
        of, word, r = of[by], word[by], r[by]
        rank = np.arange(len(of)) - np.searchsorted(of, of) + 1
        top = rank <= k
        head = a + np.searchsorted(doc[a:b] - doc[a], of[top])      # a text of the document
        yield pa.RecordBatch.from_arrays([ids.take(pa.array(head)), terms.take(pa.array(word[top])), pa.array(rank[top], pa.int32()), pa.array(r[top])], names)


def textrank_keywords(docs: DataFrame, stopwords, span: int = 5, damping: float = 0.85, steps: int = 10,
                      k: int = 10, text_col: str = "text") -> DataFrame:
    """(doc_id, term, rank, score): the ``k`` words of the highest rank, ties by the word."""
    skip = not_in(stopwords)
    words = F.filter(tokenize(F.col(text_col)), lambda t: t.rlike(P.jvm(P.LETTER_TOKEN)) & skip(t))
    dealt = docs.where(F.col("doc_id").isNotNull()).select("doc_id", text_col).repartition("doc_id").sortWithinPartitions("doc_id")
    base = stage(dealt.select("doc_id", words.alias("w")), "w")
    schema = StructType([docs.schema["doc_id"], StructField("term", StringType()), StructField("rank", IntegerType()), StructField("r", DoubleType())])

    def run(batches):
        held = None
        for batch in batches:
            rows = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            ids, lists = (pa.concat_arrays(rows[c].chunks) for c in ("doc_id", "w"))
            last = pc.index(ids, ids[len(ids) - 1]).as_py() if len(ids) else 0  # its document may go on
            yield from _keywords(ids.slice(0, last), lists.slice(0, last), span, damping, steps, k, schema.names)
            held = rows.slice(last)
        if held is not None:
            yield from _keywords(*(pa.concat_arrays(held[c].chunks) for c in ("doc_id", "w")), span, damping, steps, k, schema.names)

    return base.mapInArrow(run, schema).select("doc_id", "term", "rank", F.round("r", 6).alias("score"))
