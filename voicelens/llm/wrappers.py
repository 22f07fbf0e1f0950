"""Main text of pages by wrappers: union-free regular expressions over token streams of a host.

A page is a stream of block tags and text slots.  Runs of equal neighbouring
units collapse to repeated groups, which gives the page's *skeleton*.  The
skeletons of a host are aligned one after another: what matches stays required,
a run that only one side has becomes an optional group, a unit that meets its own
repeated group is taken into it, and texts are slots.  The result is the host's
wrapper, a union-free expression of tags, slots, optional and repeated groups.
Skeletons that no wrapper of ``MAX_NODES`` nodes can hold together form several
template clusters of the host, with a wrapper each; template text is that of a
cluster.

Every text slot of a skeleton falls to a slot of the wrapper.  A slot is kept
unless it lies in a landmark of navigation, advertising, forms, notices or
comments (tags, or words of class, id and role; the words do not mark what is or
encloses the page's article or main, see ``landmarks``); on pages with a main landmark (article, main) only its slots count; on
others a slot is dropped when it is the same text on all pages of the host, of
which three or more differ elsewhere (template text: copies of one page are one
page), or when its repeated group holds links alone (a menu).

Scale: pages reduce to distinct (host, skeleton) pairs with partial
aggregation; wrappers are folded in salted groups of bounded size, level by
level, so a host with a third of all pages is no single task.  Decisions are per
skeleton; they are broadcast after a count or else joined on a salted key.
"""

from __future__ import annotations

import html
import json
import re
from collections import Counter
from difflib import SequenceMatcher

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import small_side, written
from .urls import host_of

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?\]\]>|<(script|style|textarea|noscript|iframe|template|svg|math)\b.*?(?:</\1\s*>|\Z)|<[!?][^>]*>"
    r"""|<(/?)([a-z][a-z0-9:-]*)((?:[^>"']|"[^"]*"|'[^']*')*)>|<(/?)([a-z][a-z0-9:-]*)([^>]*)(?:>|\Z)|([^<]+)|<""", re.S | re.I)
MARKS = re.compile(r"""\b(class|id|role|itemprop)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)|\b(hidden|aria-hidden\s*=\s*["']?true|display\s*:\s*none)""", re.I)

# fixed values: kinds of elements, and words of class, id and role that name a landmark
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base basefont bgsound col embed frame hr img input link meta param source track".split())
SIDE_TAGS = frozenset("aside button dialog fieldset footer form head menu nav option select title".split())
SIDE_WORDS = frozenset("""ad ads adv advert adverts advertisement advertising alert banner breadcrumb breadcrumbs comment comments complementary consent
    contentinfo cookie cookies copyright dialog disqus donate footer gdpr login masthead menu modal nav navbar navigation newsletter notice notices overlay
    pager pagination paywall popup promo promotion recommended related replies reply search share sharing sidebar signup skip social sponsor sponsored
    subscribe teaser toolbar widget""".split())
#: Beside these, or before those, a side word of a compound name only tells of the element (``with-sidebar``, ``comments-open``).
BESIDE = frozenset("has no not overflow with without".split())
BEFORE = frozenset("allowed closed disabled enabled layout off on open".split())
#: Side words that are also subjects: before a main word (``search-results-main``, ``social-story``) they mark nothing.
TOPICS = frozenset("alert copyright donate notice notices search social".split())
SIDE_LIKE = SIDE_WORDS | {"header", "hidden"}
#: Landmarks whose entries may be articles of their own: by comments, teasers and advertising; by side columns and menus.
ENTRY_WORDS = frozenset("""ad ads adv advert adverts advertisement advertising comment comments disqus promo promotion recommended related replies
    reply sponsor sponsored teaser""".split())
COLUMN_WORDS = frozenset("menu nav navbar navigation sidebar widget".split())
MAIN_TAGS = frozenset(("article", "main"))
MAIN_WORDS = frozenset(("article", "articlebody", "main", "post", "entry", "story"))
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
UNITS = 12
FOLD = 200
MAX_NODES = 4000
CLUSTER_TRIES = 3
BROADCAST_HOSTS = 100_000
BROADCAST_MASKS = 100_000
JOIN_SALTS = 16
MEMO_SKELETONS = 2000
#: Pages of different content that must share a slot's text for it to be template text; the counting is exact up to three.
TEMPLATE_PAGES = 3


def mark_words(value: str) -> set[str]:
    """Words of a class, id or role; side words of a name that only tells of them are left out."""
    out = set()
    for name in re.sub(r"([a-z])([A-Z])", r"\1-\2", value).lower().split():
        words = re.findall(r"[a-z]+", name)
        found = SIDE_LIKE.intersection(words)
        if found and (not BESIDE.isdisjoint(words) or words[-1] in BEFORE or (words[-1] in MAIN_WORDS and found <= TOPICS)):
            words = [w for w in words if w not in found]
        out.update(words)
    return out


def stream(page: str | None) -> tuple[list[str], list[str]]:
    """Symbols of a page's blocks, ``#`` for a text slot (``#a``: links alone), and the texts of the slots."""
    symbols, texts = [], []
    text, linked, inline = [], [], []       # of the slot being read: its parts, whether each is a link; open inline elements
    paragraph = False                       # a paragraph is open; any other block ends it

    def end_text():
        joined = " ".join("".join(text).split())
        if joined:
            symbols.append("#a" if all(x for x, t in zip(linked, text, strict=True) if t.strip()) else "#")
            texts.append(joined)
        text.clear()
        linked.clear()

    def add(part):
        text.append(part)
        linked.append(any(name == "a" for name, _ in inline))

    for m in TOKEN.finditer(page or ""):
        if m[8] is not None:
            add(html.unescape(m[8]))
            continue
        name = (m[3] or m[6] or "").lower()
        closing, rest = m[2] or m[5], m[4] or m[7] or ""
        if not name:
            if m[0] == "<":
                add("<")
        elif name == "br":
            add(" ")
        elif name in VOID:
            if name == "hr":
                end_text()
        elif closing and name in INLINE:
            while any(x == name for x, _ in inline):
                found, block = inline.pop()
                if block:                   # an inline landmark ends
                    end_text()
                    symbols.append("/" + found)
                if found == name:
                    break
        else:
            words = set()
            for kind, value, hidden in MARKS.findall(rest) if not closing and rest else ():
                words.update(["hidden"] if hidden else mark_words(value.strip("\"'")))
            block = name not in INLINE or "hidden" in words or not SIDE_WORDS.isdisjoint(words)
            if block:
                end_text()
                if closing and name == "p" and not paragraph:
                    continue
                if paragraph and not (closing and name == "p") and name not in INLINE:
                    symbols.append("/p")
                paragraph = (name == "p" and not closing) or (paragraph and name in INLINE)
                symbols.append(("/" if closing else "") + name + ("|" + " ".join(sorted(words)) if words else ""))
            if name in INLINE:
                inline.append((name, block))
            else:                           # a block ends the inline elements that were left open
                inline = [x for x in inline if x[1]]
    end_text()
    return symbols, texts


def collapse(symbols: list[str]) -> list[tuple]:
    """Nodes (symbol, slots) with neighbouring equal units as repeated groups; ``slots`` lists text numbers by slot."""
    nodes, n = [], 0
    for s in symbols:
        nodes.append((s, ([n],) if s[0] == "#" else ()))
        n += s[0] == "#"
    for size in range(1, UNITS + 1):
        names = [x[0] for x in nodes]
        out, i = [], 0
        while i < len(nodes):
            if i + 2 * size <= len(nodes) and names[i] == names[i + size] and names[i:i + size] == names[i + size:i + 2 * size]:
                j = i + size
                while names[j:j + size] == names[i:i + size]:
                    j += size
                slots = [list(s) for x in nodes[i:i + size] for s in x[1]]
                for k in range(i + size, j, size):
                    for mine, more in zip(slots, (s for x in nodes[k:k + size] for s in x[1]), strict=True):
                        mine += more
                out.append((("+", *names[i:i + size]), tuple(slots)))
                i = j
            else:
                out.append(nodes[i])
                i += 1
        nodes = out
    return nodes


def frozen(x):
    return tuple(map(frozen, x)) if isinstance(x, list) else x


def slots_in(node) -> int:
    """Text slots of a node."""
    return sum(map(slots_in, node)) if isinstance(node, tuple) else int(node[0] == "#")


def grouped(names: list, units: list[tuple]) -> list:
    """``names`` with each run that equals the unit of a repeated group taken as that group."""
    for unit in sorted(units, key=len, reverse=True):
        body, out, i = list(unit[1:]), [], 0
        while i < len(names):
            if names[i:i + len(body)] == body:
                out.append(unit)
                i += len(body)
            else:
                out.append(names[i])
                i += 1
        names = out
    return names


def align(wrapper: list[tuple], names: list) -> list[tuple]:
    """The wrapper, a list of (node, optional), generalised to accept ``names`` as well."""
    units = {x for x, _ in wrapper if isinstance(x, tuple)} | {x for x in names if isinstance(x, tuple)}
    names = grouped(list(names), list(units))
    own, flags = grouped([x for x, _ in wrapper], list(units)), None
    if len(own) == len(wrapper):
        flags = [o for _, o in wrapper]
    else:  # a unit of the wrapper became a group: optional if all of it was
        flags, at = [], 0
        for x in own:
            size = 1 if x == wrapper[at][0] else len(x) - 1
            flags.append(all(o for _, o in wrapper[at:at + size]))
            at += size
    out = []
    for op, a, b, c, d in SequenceMatcher(None, own, names, autojunk=False).get_opcodes():
        if op == "equal":
            out += zip(own[a:b], flags[a:b], strict=True)
        else:
            out += [(x, True) for x in own[a:b]] + [(x, True) for x in names[c:d]]
    return out


def merged(whole: list[tuple], one: list[tuple]) -> list[tuple]:
    """A wrapper that accepts what ``whole`` and ``one`` accept."""
    out = align(whole, [x for x, _ in one])
    maybe = {x for x, o in one if o}
    return [(x, o or x in maybe) for x, o in out] if maybe else out


def fold_clusters(skeletons: list[str], bound: int = MAX_NODES) -> list[tuple[str, list[int]]]:
    """Wrappers of the given wrappers or skeletons (JSON), each with the numbers of those it holds.

    A skeleton joins the cluster with the most nodes in common whose wrapper
    stays within ``bound`` nodes; where there is none it starts a cluster.
    """
    clusters: list[tuple[list[tuple], list[int], Counter]] = []
    for k, text in enumerate(skeletons):
        one = [(frozen(x), o) for x, o in json.loads(text)]
        nodes = Counter(x for x, _ in one)
        common = [sum((nodes & c[2]).values()) for c in clusters]
        tries = 0
        for i in sorted(range(len(clusters)), key=lambda i: -common[i]):
            # own nodes of both stay apart, but for runs that the other's repeated groups take in
            if not any(isinstance(x, tuple) for x in nodes | clusters[i][2]) and len(clusters[i][0]) + len(one) - common[i] > bound:
                continue
            if len(clusters[i][0]) + len(one) > 4 * bound or tries == CLUSTER_TRIES:
                continue
            tries += 1
            both = merged(clusters[i][0], one)
            if len(both) <= bound:
                clusters[i] = (both, [*clusters[i][1], k], Counter(x for x, _ in both))
                break
        else:
            clusters.append((one, [k], nodes))
    return [(json.dumps(whole, separators=(",", ":"), ensure_ascii=False), own) for whole, own, _ in clusters]


def fold(skeletons: list[str]) -> str | None:
    """One wrapper of the given wrappers or skeletons (JSON); None when they have no common template of bounded size."""
    found = fold_clusters(skeletons)
    return found[0][0] if len(found) == 1 else None


def landmarks(names: list) -> list[tuple[bool, bool, bool]]:
    """(in a side landmark, in a main landmark, links of a repeated group) of each text slot, in order.

    Tags and ``hidden`` mark what they enclose.  Side words yield to a ``main``
    that they name or enclose, and to an ``article``, unless they speak of entries
    (comments, teasers) while other main text stands outside them, or of a side
    column while another article does.
    """
    out, stack = [], []

    def place(link):
        articles, inner = [i for i, x in enumerate(stack) if x[0] == "article"], max((i for i, x in enumerate(stack) if x[0] == "main"), default=-1)
        outer = articles[0] if articles else inner
        soft = [(i, x[3]) for i, x in enumerate(stack) if x[3] and i > inner]
        side = any(x[1] for x in stack) or any(i > outer for i, _ in soft)
        out.append((side, any(x[2] for x in stack), link, max((k for _, k in soft), default=0), bool(articles)))

    def walk(items, repeated):
        for s in items:
            if isinstance(s, tuple):
                walk(s[1:], True)
            elif s[0] == "#":
                place(repeated and s == "#a")
            elif s[0] == "/":
                name = s[1:].split("|")[0]
                if any(x[0] == name for x in stack):
                    while stack.pop()[0] != name:
                        pass
            else:
                name, _, words = s.partition("|")
                words = set(words.split())
                if name not in INLINE and stack and stack[-1][0] == "p":
                    stack.pop()
                if stack and stack[-1][0] in CLOSES.get(name, ()):
                    stack.pop()
                main = any(x[2] for x in stack)
                own = name in MAIN_TAGS or not MAIN_WORDS.isdisjoint(words)
                hard = name in SIDE_TAGS or (name == "header" and not main) or "hidden" in words
                soft = 0    # strength of the side words: 3 entries, 2 side column, 1 others
                if not SIDE_WORDS.isdisjoint(words) or ("header" in words and not main):
                    soft = 3 if not ENTRY_WORDS.isdisjoint(words) else 2 if not COLUMN_WORDS.isdisjoint(words) else 1
                free = name in ("html", "body")
                stack.append((name, hard and not free, own, 0 if free else soft))

    walk(names, False)
    found = any(main and not side and soft < 3 for side, main, _, soft, _ in out)
    article = any(inside and not side and soft < 2 for side, _, _, soft, inside in out)
    marks = []
    for side, main, link, soft, _ in out:
        if not side and soft == 3:          # entries: with other main text aside, else text like any other
            side, main = found, False
        elif not side and soft == 2:
            side = article
        marks.append((side, main, link))
    return marks


def skeleton_of(page: str | None) -> tuple[str, list[str], list[tuple]]:
    """Skeleton (JSON), texts, and nodes of a page."""
    symbols, texts = stream(page)
    nodes = collapse(symbols)
    return json.dumps([(x, False) for x, _ in nodes], separators=(",", ":"), ensure_ascii=False), texts, nodes


def skeleton_id(skeleton: str) -> int:
    return xxhash.xxh64_intdigest(skeleton) - (1 << 63)


def page_skeletons(pages: DataFrame) -> DataFrame:
    """(host, skeleton_id, skeleton, hashes, content): per page, with a hash of the text in each slot, and one of all text outside side landmarks."""
    def run(batches):
        sides: dict[str, list[bool]] = {}
        for batch in batches:
            rows = []
            for host, page in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                skeleton, texts, nodes = skeleton_of(page.as_py())
                hashes = [xxhash.xxh64_intdigest(" ".join(texts[i] for i in slot)) - (1 << 63) for _, slots in nodes for slot in slots]
                if skeleton not in sides:
                    if len(sides) >= MEMO_SKELETONS:
                        sides.clear()
                    sides[skeleton] = [side for side, _, _ in landmarks([x for x, _ in nodes])]
                slots = [slot for _, own in nodes for slot in own]
                own = sorted(i for slot, side in zip(slots, sides[skeleton], strict=True) if not side for i in slot)
                content = xxhash.xxh64_intdigest("\n".join(texts[i] for i in own)) - (1 << 63)
                rows.append((host, skeleton_id(skeleton), skeleton, hashes, content))
            if rows:
                types = [pa.string(), pa.int64(), pa.string(), pa.list_(pa.int64()), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=["host", "skeleton_id", "skeleton", "hashes", "content"])

    return (pages.select(host_of(F.col("url")).alias("host"), F.col("html").cast("string"))
            .mapInArrow(run, "host string, skeleton_id long, skeleton string, hashes array<long>, content long"))


def template_clusters(skeletons: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(host, cluster, wrapper), and (host, skeleton, cluster) for distinct (host, skeleton) rows, whose ``skeleton`` is hashed.

    Skeletons are folded in salted groups, level by level.  A host is done when
    one group held all of it, which most often leaves one wrapper; the levels end
    when no larger host loses a twentieth of its wrappers any more.
    """
    bound = MAX_NODES

    def run(key, frame):
        frame = frame.sort_values(["wrapper", "cluster"])
        ids, rows = frame["cluster"].tolist(), []
        for wrapper, own in fold_clusters(frame["wrapper"].tolist(), bound):
            name = min(ids[k] for k in own)
            rows += [(key[0], ids[k], name, wrapper if ids[k] == name else None) for k in own]
        return pd.DataFrame(rows, columns=["host", "old", "cluster", "wrapper"])

    left = skeletons.select("host", F.xxhash64("skeleton").alias("cluster"), F.col("skeleton").alias("wrapper"))
    members = left.select("host", F.col("cluster").alias("skeleton"), "cluster")
    sizes = written(left.groupBy("host").agg(F.count("*").alias("n")), "wrapper-sizes")
    level = 0
    while (sizes.agg(F.max("n")).first()[0] or 0) > 1:
        large = small_side(sizes.where(F.col("n") > FOLD).withColumnRenamed("host", "h"), BROADCAST_HOSTS)
        dealt = left.join(large, F.col("host") == F.col("h"), "left").drop("h")
        salt = F.pmod(F.xxhash64("cluster", F.lit(level)), F.ceil(F.coalesce("n", F.lit(1)) / FOLD))
        folded = written(dealt.groupBy("host", salt.alias("salt")).applyInPandas(run, "host string, old long, cluster long, wrapper string"), "wrappers")
        left = folded.where("wrapper is not null").select("host", "cluster", "wrapper")
        members = written(members.withColumnRenamed("cluster", "old").join(folded.select("host", "old", "cluster"), ["host", "old"]).drop("old"), "wrapper-members")
        before, sizes = sizes, written(left.groupBy("host").agg(F.count("*").alias("n")), "wrapper-sizes")
        fell = before.where(F.col("n") > FOLD).withColumnRenamed("n", "m").join(sizes, "host").where("n * 20 <= m * 19")
        if fell.limit(1).count() == 0:
            break
        level += 1
    return left, members


def infer_wrappers(skeletons: DataFrame) -> DataFrame:
    """(host, wrapper, cluster) from distinct (host, skeleton) rows; hosts have one wrapper unless it outgrows ``MAX_NODES``."""
    return template_clusters(skeletons)[0].select("host", "wrapper", "cluster")


def slot_places(skeletons: DataFrame) -> DataFrame:
    """Each slot of each skeleton: its landmarks, and the slot of its cluster's wrapper to which it falls."""
    def run(batches):
        for batch in batches:
            rows = []
            for host, name, skeleton, cluster, wrapper in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                names = [frozen(x) for x, _ in json.loads(skeleton)]
                marks = landmarks(names)
                if skeleton == wrapper:
                    place = list(range(len(names)))
                else:
                    whole = [frozen(x) for x, _ in json.loads(wrapper)]
                    names = grouped(names, [x for x in whole if isinstance(x, tuple)])  # a unit alone falls to its group
                    place = [-1] * len(names)
                    for a, b, n in SequenceMatcher(None, whole, names, autojunk=False).get_matching_blocks():
                        place[b:b + n] = range(a, a + n)
                nodes = [(at, inner) for x, at in zip(names, place, strict=True) for inner in range(slots_in(x))]
                rows += [(host, name, slot, cluster, at, inner, *mark) for slot, ((at, inner), mark) in enumerate(zip(nodes, marks, strict=True))]
            if rows:
                kinds = [pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.bool_(), pa.bool_()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)],
                                                 names=["host", "skeleton_id", "slot", "cluster", "node", "inner", "side", "main", "menu"])

    wrappers, members = template_clusters(skeletons)
    of_cluster = members.withColumnRenamed("skeleton", "hashed").join(wrappers, ["host", "cluster"])
    joined = (skeletons.withColumn("hashed", F.xxhash64("skeleton")).join(of_cluster, ["host", "hashed"])
              .select("host", "skeleton_id", "skeleton", "cluster", "wrapper"))
    return joined.mapInArrow(run, "host string, skeleton_id long, slot int, cluster long, node int, inner int, side boolean, main boolean, menu boolean")


def slot_masks(pages: DataFrame) -> DataFrame:
    """(host, skeleton_id, keep): the slots of each skeleton that hold main text."""
    seen = written(page_skeletons(pages), "skeletons")
    skeletons = written(seen.groupBy("host", "skeleton_id").agg(F.min("skeleton").alias("skeleton")), "distinct-skeletons")
    places = written(slot_places(skeletons), "slot-places")
    texts = (seen.select("host", "skeleton_id", F.posexplode("hashes").alias("slot", "hash"))
             .groupBy("host", "skeleton_id", "slot").agg(F.min("hash").alias("low"), F.max("hash").alias("high")))
    # distinct contents of a skeleton: their number, and two of them, which are all unless there are three or more
    contents = (seen.select("host", "skeleton_id", "content").distinct().groupBy("host", "skeleton_id")
                .agg(F.count("*").alias("n"), F.min("content").alias("first"), F.max("content").alias("last")))
    slots = places.join(texts, ["host", "skeleton_id", "slot"])
    fixed = (slots.where("node >= 0").join(contents, ["host", "skeleton_id"])
             .withColumn("content", F.explode(F.array_distinct(F.array("first", "last")))).groupBy("host", "cluster", "node", "inner")
             .agg((F.min("low") == F.max("high")).alias("same"), F.max("n").alias("n"), F.count_distinct("content").alias("contents"))
             .where(f"same and (n >= {TEMPLATE_PAGES} or contents >= {TEMPLATE_PAGES})").select("host", "cluster", "node", "inner"))
    slots = slots.join(fixed.withColumn("fixed", F.lit(True)), ["host", "cluster", "node", "inner"], "left")
    page = slots.groupBy("host", "skeleton_id").agg(F.max(F.col("main") & ~F.col("side")).alias("landmark"),
                                                    F.collect_list(F.struct("slot", "main", "side", (F.coalesce("fixed", F.lit(False)) | F.col("menu")).alias("fixed"))).alias("slots"))
    kept = F.filter("slots", lambda s: ~s["side"] & F.when(F.col("landmark"), s["main"]).otherwise(~s["fixed"]))
    return page.select("host", "skeleton_id", F.array_sort(F.transform(kept, lambda s: s["slot"])).alias("keep"))


def main_text(page: str | None, keep: list[int] | None) -> str:
    """The text of the kept slots in page order; without a decision, of the slots outside side landmarks."""
    _, texts, nodes = skeleton_of(page)
    slots = [slot for _, own in nodes for slot in own]
    if keep is None:
        keep = [i for i, (side, _, _) in enumerate(landmarks([x for x, _ in nodes])) if not side]
    return " ".join(texts[i] for i in sorted(i for k in keep for i in slots[k]))  # groups interleave their slots


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) for each row of ``pages`` (columns page_id, url, html; others are ignored).

    Null or empty html gives empty text.  Pages whose url has no host form one
    host of their own.  Repeated rows are extracted each; rows with null
    page_id are kept; an empty table gives no rows.
    """
    masks = written(slot_masks(pages), "slot-masks")

    @F.pandas_udf("long")
    def sign(pages: pd.Series) -> pd.Series:
        return pages.map(lambda p: skeleton_id(skeleton_of(p)[0]))

    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"), host_of(F.col("url")).alias("host"))
    rows = rows.withColumn("skeleton_id", sign("html"))
    if masks.limit(BROADCAST_MASKS + 1).count() <= BROADCAST_MASKS:
        rows = rows.join(F.broadcast(masks), ["host", "skeleton_id"], "left")
    else:
        salted = masks.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(JOIN_SALTS - 1))))
        rows = rows.withColumn("salt", F.pmod(F.xxhash64("url", "html"), F.lit(JOIN_SALTS)).cast("int")).join(salted, ["host", "skeleton_id", "salt"], "left")

    def run(batches):
        for batch in batches:
            texts = [main_text(p.as_py(), k) for p, k in zip(batch.column(2), batch.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                             names=["page_id", "url", "text", "n_chars"])

    return rows.select("page_id", "url", "html", "keep").mapInArrow(run, "page_id long, url string, text string, n_chars long")
