"""Sampled SentencePiece segmentations, and lossless decoding.

Encoding draws a segmentation from the piece lattice of a text by forward
filtering and backward sampling: forward, each position gets the total weight of
all segmentations that reach it; backward, from the end, the piece that ends at
the position is drawn in proportion to the weight that passes through it.  The
weight of a segmentation is the product of its pieces' weights,
``(2 + rank) ** -sharpness``, the rank being the negative score of the piece in
the model file.  Random numbers come from a hash of (seed, row key, word number
in the row, step), so a row's segmentation does not depend on the partitions,
batches or retries.

No piece holds a blank after another character, so the lattice falls apart at
the beginning of each run of blanks.  Lattices are therefore built once for each
distinct such word of a block of rows; building, filtering and sampling run over
all words of the block at once as array operations.

Blanks become the blank mark of the model, and one is put before the text; a
character without a piece is written as the byte pieces of its UTF-8 form, also
a blank mark that stands in the text itself.  So decoding restores every text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# fixed values: the blank mark of the model format, and a code for one that stands in the text
MARK = 0x2581
TEXT_MARK = 0x110000
BLOCK_CHARS = 2_000_000

_models: dict = {}


def default_model() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Pieces:
    """The pieces of a model file: a trie over code points, weights, and the bytes of each piece."""

    def __init__(self, path: str, sharpness: float):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = model.get_piece_size()
        self.byte_ids = np.zeros(256, np.int64)
        self.raw: list[bytes] = []
        states: dict[tuple[int, int], int] = {}
        accept = {}
        for i in range(self.size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                self.raw.append(bytes([int(piece[3:5], 16)]))
                continue
            usable = not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
            self.raw.append(piece.replace(chr(MARK), " ").encode() if usable else b"")
            if not usable:
                continue
            if piece.lstrip(chr(MARK)).count(chr(MARK)):
                raise ValueError("a piece holds a blank after another character")
            at = 0
            for c in map(ord, piece):
                at = states.setdefault((at, c), len(states) + 1)
            accept[at] = i
        rank = np.minimum([-model.get_score(i) for i in range(self.size)], self.size)
        self.weight = -sharpness * np.log(2.0 + np.maximum(rank, 0))
        self.byte_weight = -sharpness * np.log(2.0 + self.size)
        moves = sorted((s << 21 | c, t) for (s, c), t in states.items())
        self.keys = np.array([k for k, _ in moves], np.int64)
        self.next = np.array([t for _, t in moves], np.int64)
        self.piece_of = np.full(len(states) + 1, -1, np.int64)
        self.piece_of[list(accept)] = list(accept.values())
        self.longest = max(len(model.id_to_piece(i)) for i in accept.values())

    def lattice(self, chars: np.ndarray, starts: np.ndarray, lengths: np.ndarray):
        """Cumulative choice probabilities and codes by (node, piece length) of concatenated words, and each word's last node."""
        n, width = len(chars), self.longest
        word = np.repeat(np.arange(len(starts)), lengths)
        left = np.repeat(starts + lengths, lengths) - np.arange(n)      # characters up to the word's end
        weight = np.full((n + len(starts), width), -np.inf)
        code = np.zeros((n + len(starts), width), np.int32)
        reach = np.ones(n + len(starts), np.int8)                        # length of the longest piece that ends in a node
        node = np.arange(n) + word
        at, state = np.arange(n), np.zeros(n, np.int64)
        alone = np.zeros(n, bool)
        for k in range(width):
            key = state << 21 | chars[at + k]
            hit = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            on = self.keys[hit] == key
            at, state = at[on], self.next[hit[on]]
            piece = self.piece_of[state]
            ends = piece >= 0
            to = node[at[ends]] + k + 1
            weight[to, k], code[to, k] = self.weight[piece[ends]], piece[ends]
            reach[to] = k + 1
            if k == 0:
                alone[at[ends]] = True
            more = left[at] > k + 1
            at, state = at[more], state[more]
            if not len(at):
                break
        spelt = np.flatnonzero(~alone)                                  # as bytes: the id of an ASCII one, else size + code point
        c = chars[spelt]
        weight[node[spelt] + 1, 0] = self.byte_weight * np.where(c < 0x80, 1, np.where(c < 0x800, 2, np.where(c < 0x10000, 3, 4)))
        code[node[spelt] + 1, 0] = np.where(c < 0x80, self.byte_ids[np.minimum(c, 127)], self.size + c)
        base = starts + np.arange(len(starts))
        order = np.argsort(-lengths, kind="stable")
        total = np.full(n + len(starts), -np.inf)
        total[base] = 0.0
        tall = np.searchsorted(-lengths[order], -np.arange(1, (lengths.max() if len(lengths) else 0) + 1), side="right")
        for t, m in enumerate(tall.tolist(), 1):
            v = base[order[:m]] + t
            w = int(reach[v].max())
            paths = total[v[:, None] - np.arange(1, w + 1)] + weight[v, :w]
            top = paths.max(axis=1)
            share = np.exp(paths - top[:, None])
            whole = share.sum(axis=1)
            total[v] = top + np.log(whole)
            weight[v, :w] = np.cumsum(share / whole[:, None], axis=1)
            weight[v, w - 1:] = 2.0
        return weight, code, base + lengths

    def encode(self, texts: list[str], keys: list, seed: int) -> list[np.ndarray]:
        """Piece ids of each text, drawn by the key of its row."""
        parts = [np.frombuffer((" " + t).encode("utf-32-le"), np.uint32) if t else np.empty(0, np.uint32) for t in texts]
        sizes = np.array([len(p) for p in parts])
        if not sizes.sum():
            return [np.empty(0, np.int32) for _ in texts]
        chars = np.concatenate(parts).astype(np.int64)
        row = np.repeat(np.arange(len(texts)), sizes)
        chars = np.where(chars == 0x20, MARK, np.where(chars == MARK, TEXT_MARK, chars))
        blank = chars == MARK
        head = np.r_[True, (blank[1:] & ~blank[:-1]) | (row[1:] != row[:-1])]
        first = np.flatnonzero(head)
        length = np.diff(np.r_[first, len(chars)])
        word = np.cumsum(head) - 1
        # distinct words, by two sums of hashed (character, place)
        place = (np.arange(len(chars)) - first[word]).astype(np.uint64)
        marked = mix(chars.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + mix(place + np.uint64(1)))
        h = np.add.reduceat(marked, first)
        g = np.add.reduceat(mix(marked + np.uint64(11)), first)
        _, some, which = np.unique(h, return_index=True, return_inverse=True)
        if (g[some][which] != g).any() or (length[some][which] != length).any():
            some, which = np.arange(len(first)), np.arange(len(first))
        lengths = length[some]
        starts = np.cumsum(lengths) - lengths
        taken = np.repeat(first[some] - starts, lengths) + np.arange(lengths.sum())
        choice, code, end = self.lattice(chars[taken], starts, lengths)
        # backward sampling of all words at once
        owner = row[first]
        begin = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        nth = np.arange(len(first)) - np.repeat(begin, np.diff(np.r_[begin, len(first)]))
        base = np.array([xxhash.xxh64_intdigest(repr(k), seed=seed) for k in keys], np.uint64)
        noise = mix(base[owner] + nth.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        live, node = np.arange(len(first)), end[which]
        stop = node - length
        steps, found = np.zeros(len(first), np.int64), []
        while len(live):
            u = (mix(noise[live] + steps[live].astype(np.uint64) * np.uint64(0xD1B54A32D192ED03)) >> np.uint64(11)).astype(np.float64) * 2.0 ** -53
            k = (choice[node] <= u[:, None]).sum(axis=1)
            found.append((live, code[node, k]))
            steps[live] += 1
            node = node - k - 1
            more = node > stop[live]
            live, node = live[more], node[more]
        upto = np.cumsum(steps)
        ids = np.empty(upto[-1], np.int64)
        for s, (who, codes) in enumerate(found):
            ids[upto[who] - 1 - s] = codes
        bounds = np.r_[0, np.cumsum(np.bincount(owner, weights=steps, minlength=len(texts)).astype(np.int64))]
        return [self._spelt(ids[a:b]) for a, b in zip(bounds, bounds[1:], strict=False)]

    def _spelt(self, codes: np.ndarray) -> np.ndarray:
        """Codes of characters without a piece become their byte pieces."""
        far = np.flatnonzero(codes >= self.size)
        if not len(far):
            return codes.astype(np.int32)
        out, at = [], 0
        for i in far:
            c = int(codes[i]) - self.size
            out += [codes[at:i], self.byte_ids[np.frombuffer(chr(MARK if c == TEXT_MARK else c).encode(), np.uint8)]]
            at = i + 1
        return np.concatenate([*out, codes[at:]]).astype(np.int32)

    def decode(self, ids) -> str:
        """The text of a segmentation; the blank before the text is taken away."""
        return b"".join(map(self.raw.__getitem__, ids)).decode("utf-8", "replace")[1:]


def pieces_of(path: str, sharpness: float) -> Pieces:
    if (path, sharpness) not in _models:
        _models[path, sharpness] = Pieces(path, sharpness)
    return _models[path, sharpness]


def _blocks(texts: list[str]):
    """Slices of rows with about ``BLOCK_CHARS`` characters."""
    at = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > BLOCK_CHARS:
            yield slice(at, i)
            at, size = i, 0
        size += len(t)
    yield slice(at, len(texts))


def sample_pieces(docs: DataFrame, seed: int = 7, sharpness: float = 1.0, model: str | None = None) -> DataFrame:
    """(doc_id, ids, n_pieces, restored) for each row of ``docs`` (columns doc_id, text; others are ignored).

    ``ids`` is one segmentation drawn for the row's doc_id, ``restored`` tells
    that decoding gave the text back.  Null or empty text has no pieces; rows
    with equal doc_id and text get equal segmentations, null doc_id is a key
    like any other; an empty table gives no rows.
    """
    path = model or default_model()

    def run(batches):
        pieces = pieces_of(path, sharpness)
        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()]
            for part in _blocks(texts):
                found = pieces.encode(texts[part], keys[part], seed)
                same = [pieces.decode(i.tolist()) == t for i, t in zip(found, texts[part], strict=True)]
                sizes = [len(i) for i in found]
                flat = pa.array(np.concatenate(found) if found else np.empty(0, np.int32), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[part], pa.int64()), pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32)), flat),
                     pa.array(sizes, pa.int64()), pa.array(same, pa.bool_())], names=["doc_id", "ids", "n_pieces", "restored"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, ids array<int>, n_pieces long, restored boolean")


def decode_pieces(encoded: DataFrame, model: str | None = None) -> DataFrame:
    """(doc_id, text) of encoded rows (columns doc_id, ids); null ids give null."""
    path = model or default_model()

    def run(batches):
        pieces = pieces_of(path, 1.0)
        for batch in batches:
            texts = [None if ids is None else pieces.decode(ids) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select(F.col("doc_id").cast("long"), "ids").mapInArrow(run, "doc_id long, text string")
