"""Secret scan: fixed patterns, and novelty against a primed zstandard compressor.

The base kinds are patterns.  The method adds the kind ``novel``: a string of
letters and digits near a sensitive word (after it, also on the lines that follow,
or before it, and on through the lines of a block) is compressed by zstandard
primed with the code around it and with a dictionary of identifiers.  Other copies
of the string are no part of that code, unless it reads as words, as paths and
names do; letters alone are a candidate only if they do not read as words.
Its marginal bytes (compressed size less that of an empty string under the same
dictionary) tell what the surroundings do not explain: words, paths and names
that occur nearby or among the identifiers compress, random keys do not.

One pass over the texts, no shuffle; a task holds one batch of texts.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right

import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# fixed values: kinds in their order, and the patterns of the base kinds
KINDS = ("assign", "access", "hex", "novel")
ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

# fixed values: words that make what follows sensitive, and common identifiers of code and configuration
SENSITIVE_WORDS = ("key", "token", "secret", "passw", "credential", "auth", "bearer", "private", "signature")
SENSITIVE = re.compile("|".join(SENSITIVE_WORDS))
IDENTIFIERS = (
    "access_key_id secret_access_key client_id client_secret private_key public_key api_key api_token auth_token "
    "refresh_token session_token authorization bearer basic username password database connection string host port "
    "https://www.example.com/api/v1/users/ localhost:8080 127.0.0.1 application/json content-type charset=utf-8 "
    "function return import export default class const static public private protected void string integer boolean "
    "true false null undefined self this module package version 0123456789 abcdefghijklmnopqrstuvwxyz "
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ 00000000-0000-0000-0000-000000000000 2024-01-01T00:00:00Z placeholder changeme your_key_here"
)
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
#: Characters other than blanks after a sensitive word in which a candidate may begin, or before it, in which one may end;
#: and characters of text around a candidate that prime the compressor.
REACH, CONTEXT = 48, 1024
AHEAD = re.compile(r"(?:\s{0,200}\S){0,%d}" % REACH)
#: What may stand between the lines of a block of key material, and the head of a PEM block.
BETWEEN_LINES = re.compile(r"""[\s"'`,+\\:|>.-]{1,200}""")
PEM = re.compile(r"-----BEGIN [A-Z0-9 ]*PRIVATE KEY[A-Z ]*-----")
PEM_TAIL = re.compile(r"\s+([A-Za-z0-9+/=]{1,15})\s+-----END")
#: Pairs of letters that are frequent in words of English, German, French and Spanish; share of them from which a string reads as words.
PAIRS = frozenset("""th he in er an re on at en nd ti es or te of ed is it al ar st to nt ng se ha as ou io le ve co me de hi ri ro ic ne ea ra ce li ch ll
    be ma si om ur ca el ta la ns di fo ho pe ec pr no ct us ac ot il tr ly nc et ut ss so rs un lo wa ge ie wh ee wi em ad ol rt po we na ul ni ts mo ow
    pa im mi ai sh ir su id os iv ia am fi ci vi pl ig tu ev ld ry mp fe bl ab gh ty op wo sa ay ex ke ui fr oo ag cu ff bi do qu ap ue ei au eu sc ck ft
    sp if cr gr br dr fa fu ga gi ob od ub uc ud um up va vo rm rd rn rv lt pp rr tt nn mm""".split())
WORDLIKE = 0.55
#: Marginal bytes per character from which a candidate is novel.
NOVELTY = 0.85


def marginal_bytes(candidate: str, around: str, identifiers: str = IDENTIFIERS) -> int:
    """Compressed bytes of ``candidate`` beyond those of an empty string, primed with identifiers and surroundings."""
    primed = zstandard.ZstdCompressionDict((identifiers + "\n" + around).encode("utf-8", "replace"), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    press = zstandard.ZstdCompressor(level=19, dict_data=primed, write_content_size=False, write_dict_id=False)
    return len(press.compress(candidate.encode())) - len(press.compress(b""))


def reads_as_words(value: str) -> bool:
    """Whether most neighbouring letters and digits of ``value`` are pairs that words have."""
    pairs = [a + b for part in re.findall(r"[a-z0-9]+", value.lower()) for a, b in zip(part, part[1:], strict=False)]
    return sum(p in PAIRS for p in pairs) >= WORDLIKE * max(1, len(pairs))


def is_novel(text: str, start: int, end: int, identifiers: str = IDENTIFIERS) -> bool:
    """Whether neither surroundings nor identifiers explain the candidate ``text[start:end]``."""
    value = text[start:end]
    words = reads_as_words(value)
    if not any(c.isalpha() for c in value) or (words and not any(c.isdigit() for c in value)):
        return False
    before, after = text[max(0, start - CONTEXT):start], text[end:end + CONTEXT]
    if not words:  # a copy, also one that the window's edge cuts, gives way to blank lines
        blank, size = "\n" * len(value), len(value)
        before = text[max(0, start - CONTEXT - size):start].replace(value, blank)[-CONTEXT:]
        after = text[end:end + CONTEXT + size].replace(value, blank)[:CONTEXT]
    return marginal_bytes(value, before + after, identifiers) >= NOVELTY * len(value)


def base_spans(text: str, low: str | None = None) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the base kinds; an assignment's span is its whole match."""
    low = text.lower() if low is None else low
    found = []
    if any(word in low for word in ASSIGN_WORDS):
        found += [(m.start(), "assign", m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        found += [(m.start(), "access", m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    found += [(m.start(), "hex", m.end()) for m in HEX.finditer(text)]
    return found


def novel_spans(text: str, low: str, taken: list[tuple[int, str, int]], identifiers: str = IDENTIFIERS) -> list[tuple[int, str, int]]:
    """Candidates in a sensitive context that their surroundings do not explain and no base span touches."""
    if len(low) != len(text) or not any(word in low for word in SENSITIVE_WORDS):
        if len(low) == len(text):
            return []
        low = "".join(c.lower() if c.isascii() else c for c in text)  # keeps positions where lower-casing changes lengths
    found, judged = [], {}

    def judge(start, end):
        """Whether the candidate is novel; each is decided once."""
        if (start, end) not in judged:
            judged[start, end] = not any(s < end and start < e for s, _, e in taken) and is_novel(text, start, end, identifiers)
            if judged[start, end]:
                found.append((start, "novel", end))
        return judged[start, end]

    def forward(at, stop):
        """Candidates that begin before ``stop``, and the lines of a block that go on from a novel one; the end of the last."""
        last, novel = at, False
        while m := CANDIDATE.search(text, last):
            if m.start() >= stop and not (novel and BETWEEN_LINES.fullmatch(text, last, m.start())):
                break
            last, novel = m.end(), judge(m.start(), m.end())
        return last

    done = 0
    for head in PEM.finditer(text):
        end = text.find("-----END", head.end())
        if head.end() >= done and end >= 0:
            before = len(found)
            done = max(done, forward(head.end(), end))
            tail = PEM_TAIL.match(text, done)
            if tail and len(found) > before:   # the short last line of a body
                found.append((tail.start(1), "novel", tail.end(1)))
    done = 0
    words = [(m.start(), m.end()) for m in SENSITIVE.finditer(low)]
    for _, end in words:
        done = max(done, forward(max(end, done), AHEAD.match(text, end).end()))
    whole = [(m.start(), m.end()) for m in CANDIDATE.finditer(text)]
    ends, seen = [e for _, e in whole], sorted(judged)
    for start, _ in words:
        back = text[max(0, start - 4 * CONTEXT):start][::-1]
        reach = start - AHEAD.match(back).end()
        for k in range(bisect_right(ends, start) - 1, -1, -1):
            if ends[k] <= reach:
                break
            near = bisect_right(seen, (ends[k], -1)) - 1    # the last one judged that begins before its end
            if near < 0 or seen[near][1] <= whole[k][0]:
                judge(*whole[k])
    return found


def all_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of every secret of a text, by start, then kind; code points, end exclusive."""
    low = text.lower()
    base = base_spans(text, low)
    return sorted(base + novel_spans(text, low, base), key=lambda s: (s[0], KINDS.index(s[1])))


def _joined(spans) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, kind, end in spans)


def scan_secrets(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (columns doc_id, text; others are ignored).

    doc_id, n_assign, n_access, n_hex, base_sha256 (of the base spans), spans
    (all spans as kind:start:end), n_novel.  Null or empty text has no spans;
    repeated rows are scanned each; an empty table gives no rows.
    """
    schema = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_novel long"

    def run(batches):
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                spans = all_spans(text.as_py() or "")
                kinds = [kind for _, kind, _ in spans]
                base = _joined(s for s in spans if s[1] != "novel")
                rows.append((doc, kinds.count("assign"), kinds.count("access"), kinds.count("hex"),
                             hashlib.sha256(base.encode()).hexdigest(), _joined(spans), kinds.count("novel")))
            if rows:
                types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)],
                                                 names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_novel"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)


def masked(text: str | None, mask: str = "[secret]") -> str | None:
    """``text`` with each secret, overlapping ones merged, replaced by ``mask``; null stays null."""
    if not text:
        return text
    merged: list[list[int]] = []
    for start, _, end in all_spans(text):
        if merged and start < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], end)
        else:
            merged.append([start, end])
    out, at = [], 0
    for start, end in merged:
        out += [text[at:start], mask]
        at = end
    return "".join([*out, text[at:]])


def mask_secrets(docs: DataFrame) -> DataFrame:
    """``docs`` with the secrets in ``text`` masked and ``n_chars`` (where there is one) counted anew; no row is dropped."""
    @F.pandas_udf("string")
    def clean(texts: pd.Series) -> pd.Series:
        return texts.map(masked)

    out = docs.withColumn("text", clean(F.col("text").cast("string")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.coalesce(F.char_length("text").cast(docs.schema["n_chars"].dataType), F.col("n_chars")))
    return out
