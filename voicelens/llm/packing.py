"""Best-fit packing of token pieces into sequences under several capacities.

``tokenise`` turns documents into pieces of at most ``max_tokens`` ids;
``pack`` places pieces into sequences by *vector best-fit*: each open sequence
has a residual vector (tokens, documents, attention cost), a piece has a demand
vector, and the feasible sequence with the smallest weighted norm of what would
be left (``rule="norm"``), or with the largest weighted dot product of residual
and demand (``rule="dot"``), takes the piece.

Scale: written pieces are dealt by a hash of their row into groups of about ``rows_per_group``, equal rows too; each
group is packed on its own, so a task holds one group of small integers and a
group leaves at most a few sequences open.  The number of groups grows with the
input.  Texts never leave the task that reads them.
"""

from __future__ import annotations

import json
import math
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import written

PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED_SCHEMA = PIECE_SCHEMA + ", sequence_id long, offset long"
END_ID = 0

_encoders: dict = {}


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def ranked_encoder(path: str):
    """``encode(text) -> ids`` of a byte-level BPE tokenizer file, as its library encodes without added special tokens.

    When the file's ids follow its merge order (as byte-level BPE files
    commonly do), the same merges run as ranks, which is several times faster;
    otherwise, and for texts that hold the string of an added token, the
    library itself encodes.
    """
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer, pre_tokenizers

    own = Tokenizer.from_file(path)
    spec = json.loads(Path(path).read_text())
    plain = lambda text: own.encode(text, add_special_tokens=False).ids
    pre, model = spec.get("pre_tokenizer") or {}, spec["model"]
    merges = [m.split(" ") if isinstance(m, str) else m for m in model.get("merges") or []]
    made = [model["vocab"].get("".join(m)) for m in merges]
    if (model.get("type") != "BPE" or spec.get("normalizer") or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space")
            or None in made or any(x >= y for x, y in zip(made, made[1:], strict=False))):
        return plain
    # the byte alphabet: printable bytes stand for themselves, the others follow from U+0100 on
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    letter = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in shown)}
    if set(letter) != set(pre_tokenizers.ByteLevel.alphabet()):
        return plain
    special = {t["content"] for t in spec.get("added_tokens", [])}
    ranks = {bytes(letter[c] for c in word): i for word, i in model["vocab"].items() if word not in special}
    ranked = tiktoken.Encoding("ranked", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    return lambda text: plain(text) if any(x in text for x in special) else ranked(text)


def _encoder(path: str):
    if path not in _encoders:
        _encoders[path] = ranked_encoder(path)
    return _encoders[path]


def cut_points(n: int, max_tokens: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``n`` ids; only the first may be shorter."""
    first = n % max_tokens or max_tokens
    return [(0, first), *((s, max_tokens) for s in range(first, n, max_tokens))]


def tokenise(docs: DataFrame, max_tokens: int = 2048, tokenizer: str | None = None) -> DataFrame:
    """One row per piece of each document (null text: empty; every document ends with id 0)."""
    path = tokenizer or default_tokenizer()

    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]

    def run(batches):
        encode = _encoder(path)
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.asarray([*encode(text.as_py() or ""), END_ID], "<u4")
                for k, (start, length) in enumerate(cut_points(len(ids), max_tokens)):
                    rows.append((doc, k, start, length, zlib.crc32(ids[start:start + length].tobytes())))
            if rows:
                columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, PIECE_SCHEMA)


def best_fit(lengths: np.ndarray, capacity: np.ndarray, weights: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Vector best-fit decreasing: sequence number and offset of each piece."""
    if rule not in ("norm", "dot"):
        raise ValueError(f"unknown rule {rule!r}")
    order = np.argsort(-lengths, kind="stable")
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    scale = weights / capacity.astype(float) ** 2
    left = np.empty((64, 3), np.int64)     # residuals of open sequences, by row
    name = np.empty(64, np.int64)
    n_open = n_all = 0
    smallest = int(lengths.min()) if len(lengths) else 0
    for i in order:
        n = int(lengths[i])
        demand = np.array([n, 1, n * n])
        if (demand > capacity).any():
            raise ValueError("a piece is larger than an empty sequence")
        at = -1
        if n_open:
            after = left[:n_open] - demand
            fits = np.flatnonzero((after >= 0).all(axis=1))
            if len(fits):
                if rule == "norm":
                    score = (after[fits].astype(float) ** 2) @ scale
                    at = int(fits[np.argmin(score)])
                else:
                    score = (left[fits].astype(float) * demand) @ scale
                    at = int(fits[np.argmax(score)])
        if at < 0:
            if n_open == len(left):
                left, name = np.concatenate([left, left]), np.concatenate([name, name])
            at = n_open
            left[at], name[at] = capacity, n_all
            n_open, n_all = n_open + 1, n_all + 1
        sequence[i], offset[i] = name[at], capacity[0] - left[at, 0]
        left[at] -= demand
        if left[at, 0] < smallest or left[at, 1] < 1 or left[at, 2] < smallest * smallest:  # nothing fits any more
            n_open -= 1
            left[at], name[at] = left[n_open], name[n_open]
    return sequence, offset


def pack(pieces: DataFrame, max_tokens: int = 2048, max_documents: int | None = None,
         max_attention: int | None = None, weights: tuple[float, float, float] = (1.0, 0.05, 0.05),
         rule: str = "norm", rows_per_group: int = 6000) -> DataFrame:
    """Sequence and offset of each piece.

    ``max_documents`` bounds the pieces of a sequence and ``max_attention`` the
    sum of squared piece lengths (attention cost when documents are masked from
    each other); left out, they are the bounds that ``max_tokens`` implies.
    """
    capacity = np.array([max_tokens, max_documents or max_tokens, max_attention or max_tokens ** 2], np.int64)
    weight = np.array(weights, float)
    pieces = written(pieces, "pieces")
    groups = max(1, math.ceil(pieces.count() / rows_per_group))

    def run(key, frame):
        sequence, offset = best_fit(frame["length"].to_numpy(), capacity, weight, rule)
        return frame.assign(sequence_id=sequence * groups + int(key[0]), offset=offset).drop(columns="_group")

    return (pieces.withColumn("_group", F.pmod(F.xxhash64(F.monotonically_increasing_id(), "doc_id", "ids_crc32"), F.lit(groups)))
            .groupBy("_group").applyInPandas(run, PACKED_SCHEMA))


def pack_documents(docs: DataFrame, max_tokens: int = 2048, tokenizer: str | None = None, **limits) -> DataFrame:
    """Tokenise and pack ``docs`` (columns doc_id, text; others are ignored).

    Null doc_id is carried along; null text counts as empty (one piece holding
    only id 0); repeated rows are packed each; an empty table gives no rows.
    """
    return pack(tokenise(docs, max_tokens, tokenizer), max_tokens, **limits)
