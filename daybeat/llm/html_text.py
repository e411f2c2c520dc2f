"""Main text of web pages: markup where it speaks, and runs that repeat on the pages of a host.

Runs of tokens that stand on several different pages of a host cover its boilerplate; what stays are the
runs of one page alone. They are found by suffix ranks: the token streams of pages are put one after the
other and their suffixes are ranked by prefix doubling up to the length of a run. ``main_texts`` does so
among pages at hand, ``extract`` on the whole host, whatever its size: in chunks of bounded size, whose runs
are named by a hash so that chunks can be added up.

Markup is one more signal, for what repetition cannot settle: advertisements change from page to page, and
articles that were copied, quoted or close with a stock line repeat although they are content. So elements that
are no content by tag or class go in any case. On a page that marks its article (or main part), its
blocks are the text, without those that most pages of the host share; on other pages blocks covered by runs
of two different pages go.
"""

from __future__ import annotations

import html
import re
import zlib
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from ..session import keep
from .arrow import pieces
from .shingles import shingle_hashes
from .url_filters import host_and_path

# Pages of a host that are looked at together, and tokens of the shortest repeated run (a power of two).
CHUNK_PAGES, RUN = 128, 8
# Different pages that must share a run, and the covered share of a block that is boilerplate.
PAGES_OF_RUN, COVERED = 2, 0.8
# Different pages, and more than half of the host's, that must share a run to take it out of a marked article.
PAGES_OF_LINE = 3

# HTML elements by what they mean for text.
RAW = {"script", "style", "title", "textarea", "noscript", "template", "iframe", "svg", "math", "object", "noembed"}
NO_CONTENT = {"nav", "header", "footer", "aside", "form", "head", "menu", "dialog", "button", "select", "fieldset"}
BLOCKS = {"address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir",
          "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5",
          "h6", "head", "header", "hgroup", "hr", "html", "li", "main", "menu", "nav", "ol", "p", "pre", "search",
          "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
# Words in class, id and role that mark an element as no content.
MARKS = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo", "promotion",
         "nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "pagination", "sidebar", "footer", "header",
         "masthead", "cookie", "cookies", "consent", "gdpr", "notice", "notices", "popup", "modal", "overlay",
         "newsletter", "subscribe", "subscription", "signup", "login", "share", "sharing", "social", "comment",
         "comments", "disqus", "respond", "related", "recommended", "widget", "complementary", "contentinfo", "search"}
NEVER_MARKED = {"html", "body", "article", "main"}
# First and last words of names that tell of a mark's absence or of its surroundings, and words
# for the box around a mark.
AROUND = {"has", "no", "non", "not", "with", "without", "hide", "free", "less", "hidden"}
BOXES = {"area", "banner", "bar", "block", "box", "button", "buttons", "container", "form", "icons", "inner", "item",
         "items", "left", "link", "links", "list", "right", "section", "slot", "top", "unit", "wrap", "wrapper", "bottom"}
# Elements that may stand around a whole page.
WRAPPERS = {"form", "fieldset", "header"}

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)
    |<(/?)([A-Za-z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>
    |<(/?)([A-Za-z][^\s/>]*+)([^>]*+)>
    |</?[A-Za-z][^>]*+\Z
    |([^<]++|<)""", re.S | re.X)
_ATTRIBUTE = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_PART = re.compile(r"[-_:]+")


@dataclass
class Page:
    """Blocks of a page in order, each with its text and whether the article or main part holds it."""
    blocks: list[str] = field(default_factory=list)
    in_article: list[bool] = field(default_factory=list)
    in_main: list[bool] = field(default_factory=list)

    def chosen(self) -> list[bool] | None:
        """The blocks of the marked content, or None if the page marks none."""
        for marks in (self.in_article, self.in_main):
            if any(marks):
                return marks
        return None


def _is_mark(name: str) -> bool:
    """Whether a class, id or role is a mark, ends with one, or begins with one that a box follows."""
    words = [w for w in _PART.split(name) if w]
    if not words or AROUND.intersection((words[0], words[-1])):
        return False
    return words[-1] in MARKS or words[0] in MARKS and all(w in MARKS or w in BOXES or w.isdigit() for w in words[1:])


def _marked(tag: str, attributes: str) -> bool:
    if not attributes or tag in NEVER_MARKED:
        return False
    return any(_is_mark(name) for _, *values in _ATTRIBUTE.findall(attributes) for name in "".join(values).lower().split())


def parse(source: str) -> Page:
    """The blocks of a page outside elements that are no content; references decoded, one space for white space.

    If all text of articles and main parts stands in such elements, those around them are content after all;
    on a page without any, so are marked elements and WRAPPERS that hold more than half of the text.
    """
    blocks, parts, open_tags = [], [], []           # parts: (text, cover); open_tags: (tag, cover outside)
    depth: Counter[str] = Counter()                 # open tags by name
    parent, tags, holds = [0], [""], [False]        # covers: elements that are no content; 0 is none
    cover = articles = mains = at = 0

    def end_block() -> None:
        if parts:
            blocks.append((parts.copy(), articles > 0, mains > 0))
            parts.clear()

    def close(tag: str) -> None:
        nonlocal cover, articles, mains
        if not depth[tag]:
            return
        while open_tags:
            last, cover = open_tags.pop()
            depth[last] -= 1
            articles -= last == "article"
            mains -= last == "main"
            if last == tag:
                return

    while at < len(source):
        m = _TOKEN.match(source, at)
        at = m.end()
        if m[7] is not None:
            parts.append((html.unescape(m[7]), cover))
            continue
        closing, tag, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not tag:
            continue
        tag = tag.lower()
        if tag in BLOCKS:
            end_block()
        elif tag == "br":
            parts.append((" ", 0))
        if closing:
            close(tag)
        elif tag in RAW:
            end = re.compile(rf"</{tag}[^>]*>", re.I).search(source, at)
            at = end.end() if end else len(source)
        elif tag not in VOID and not attributes.endswith("/"):
            if tag in ("p", "li", "td", "tr", "dt", "dd") and open_tags and open_tags[-1][0] == tag:
                close(tag)
            is_cover = tag in NO_CONTENT or _marked(tag, attributes)
            if tag in BLOCKS or is_cover:
                open_tags.append((tag, cover))
                depth[tag] += 1
                if is_cover:
                    parent.append(cover)
                    tags.append(tag)
                    holds.append(False)
                    cover = len(parent) - 1
                holds[cover] |= tag in ("article", "main")
                articles += tag == "article"
                mains += tag == "main"
    end_block()
    return _uncovered(blocks, parent, tags, holds)


def _uncovered(blocks: list[tuple], parent: list[int], tags: list[str], holds: list[bool]) -> Page:
    sizes, inside = [0] * len(parent), [0] * len(parent)
    for parts, in_article, in_main in blocks:
        for text, cover in parts:
            n = len("".join(text.split()))
            sizes[cover] += n
            inside[cover] += n * (in_article or in_main)
    visible = inside[0]
    for k in range(len(parent) - 1, 0, -1):
        sizes[parent[k]] += sizes[k]
        inside[parent[k]] += inside[k]
        holds[parent[k]] |= holds[k]
    dead = [False] * len(parent)
    for k in range(1, len(parent)):
        if visible:
            lifted = False
        elif inside[0]:
            lifted = holds[k] and inside[k] > 0
        else:
            lifted = 2 * sizes[k] > sizes[0] and (tags[k] in WRAPPERS or tags[k] not in NO_CONTENT)
        dead[k] = dead[parent[k]] or not lifted
    page = Page()
    for parts, in_article, in_main in blocks:
        text = " ".join("".join(t for t, cover in parts if not dead[cover]).split())
        if text:
            page.blocks.append(text)
            page.in_article.append(in_article)
            page.in_main.append(in_main)
    return page


def ranked(streams: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The streams one after the other: token, rank of its suffix by RUN tokens, stream, and whether a run begins there."""
    sizes = np.fromiter(map(len, streams), np.int64, len(streams))
    n = int(sizes.sum()) + len(streams)
    tokens, owner = np.empty(n, np.int64), np.empty(n, np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes + 1)])
    for k, own in enumerate(streams):
        tokens[starts[k]:starts[k] + sizes[k]] = own
        tokens[starts[k] + sizes[k]] = -1 - k       # the end of a stream equals nothing else
        owner[starts[k]:starts[k + 1]] = k
    rank, length = np.unique(tokens, return_inverse=True)[1].astype(np.int64), 1
    while length < RUN:
        later = np.full(n, -1, np.int64)
        later[:max(n - length, 0)] = rank[length:]
        rank = np.unique(rank * (n + 1) + later + 1, return_inverse=True)[1].astype(np.int64)
        length *= 2
    return tokens, rank, owner, np.arange(n) + RUN <= starts[owner + 1] - 1


def repeated(streams: list[np.ndarray]) -> list[np.ndarray]:
    """For every token of every stream, whether a run shared by several different streams covers it."""
    _, rank, owner, inside = ranked(streams)
    n = len(rank)
    # Equal pages count as one: different (rank, kind of page) pairs per rank.
    kinds = {}
    kind = np.fromiter((kinds.setdefault(s.tobytes(), len(kinds)) for s in streams), np.int64, len(streams))[owner]
    pairs = np.unique(rank * (len(kinds) + 1) + kind)
    shared = np.bincount(pairs // (len(kinds) + 1), minlength=n)[rank] >= PAGES_OF_RUN
    change = np.zeros(n + RUN + 1, np.int64)
    at = np.flatnonzero(shared & inside)
    np.add.at(change, at, 1)
    np.add.at(change, at + RUN, -1)
    covered, starts = np.cumsum(change)[:n] > 0, np.searchsorted(owner, np.arange(len(streams)))
    return [covered[start:start + len(own)] for start, own in zip(starts, streams)]


def main_texts(sources: list[str]) -> tuple[list[str], list[list[str]]]:
    """Main text of each page of a chunk, and the blocks that were removed because they repeat."""
    pages, ids, streams, places = [parse(s) for s in sources], {}, [], []
    for page in pages:
        stream, ends = [], []
        for block in page.blocks:
            stream += [ids.setdefault(t, len(ids)) for t in block.split(" ")]
            stream.append(ids.setdefault("", len(ids)))     # the end of a block is a token too
            ends.append(len(stream))
        streams.append(np.array(stream, np.int64))
        places.append([0, *ends])
    texts, removed = [], []
    for page, covered, ends in zip(pages, repeated(streams), places):
        chosen = page.chosen()
        if chosen is None:
            chosen = [covered[a:b - 1].mean() < COVERED for a, b in zip(ends, ends[1:])]
            removed.append([b for b, ok in zip(page.blocks, chosen) if not ok])
        else:
            removed.append([])
        texts.append("\n".join(b for b, ok in zip(page.blocks, chosen) if ok))
    return texts, removed


def packed(blocks: list[str]) -> bytes:
    """The blocks compressed, as they are shuffled and kept; none holds a line end."""
    return zlib.compress("\n".join(blocks).encode(), 1) if blocks else b""


def unpacked(column: pa.Array | pa.ChunkedArray) -> list[list[str]]:
    return [zlib.decompress(x).decode().split("\n") if x else [] for x in column.to_pylist()]


def page_hash(blocks: list[str]) -> int:
    return xxhash.xxh3_64_intdigest("\n".join(blocks).encode()) - (1 << 63)


def runs_of(pages: list[list[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
    """(hash, different pages, least, greatest page hash) of every different run of some pages' blocks, and how many
    different pages there are. Suffix ranks tell the runs apart; the hash names them to other chunks."""
    ids, own, streams = {}, {}, []
    for blocks in pages:
        if own.setdefault(page_hash(blocks), len(own)) == len(streams):
            streams.append(np.array([ids.setdefault(t, len(ids)) for b in blocks for t in (*b.split(" "), "")], np.int64))
    tokens, rank, owner, inside = ranked(streams)
    at = np.flatnonzero(inside)
    if not len(at):
        return np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * 3, len(own)
    pairs = np.unique(rank[at] * len(own) + owner[at])
    ranks, first, n = np.unique(pairs // len(own), return_index=True, return_counts=True)
    place = np.empty(len(rank), np.int64)
    place[rank[at]] = at
    words = np.fromiter((xxhash.xxh3_64_intdigest(t.encode()) for t in ids), np.uint64, len(ids))
    hashes = shingle_hashes(words[np.maximum(tokens, 0)], RUN)[place[ranks]]
    page = np.fromiter(own, np.int64, len(own))[pairs % len(own)]
    return hashes, n, np.minimum.reduceat(page, first), np.maximum.reduceat(page, first), len(own)


def run_hashes(blocks: list[str]) -> np.ndarray:
    """Hash of every run of RUN tokens; the end of a block is a token too."""
    tokens = [xxhash.xxh3_64_intdigest(t.encode()) for block in blocks for t in (*block.split(" "), "")]
    return shingle_hashes(np.array(tokens, np.uint64), RUN) if len(tokens) >= RUN else np.zeros(0, np.uint64)


def without_runs(blocks: list[str], shared: np.ndarray) -> list[bool]:
    """Which blocks stay; ``shared`` holds the hashes of the runs that several pages have, ascending."""
    runs = run_hashes(blocks)
    change = np.zeros(sum(len(b.split(" ")) + 1 for b in blocks) + 1, np.int64)
    at = np.flatnonzero(np.isin(runs, shared))
    np.add.at(change, at, 1)
    np.add.at(change, at + RUN, -1)
    covered, out, start = np.cumsum(change) > 0, [], 0
    for block in blocks:
        n = len(block.split(" "))
        out.append(bool(covered[start:start + n].mean() < COVERED))
        start += n + 1
    return out


def without_lines(blocks: list[str], marks: list[bool], lines: np.ndarray) -> list[bool]:
    """``marks`` without the blocks that a host's lines cover. An article that would lose more than half of its
    words to them is a copy, not a frame around something: it stays whole."""
    stays = [a and b for a, b in zip(marks, without_runs(blocks, lines))]
    words = [b.count(" ") + 1 for b in blocks]
    return stays if 2 * sum(w for w, ok in zip(words, stays) if ok) >= sum(w for w, ok in zip(words, marks) if ok) else marks


def host_lines(read: DataFrame) -> DataFrame:
    """(host, lines): hashes of the runs that stand on PAGES_OF_LINE different pages of a host and on more than half of them.

    ``read`` has a row with host, kind (hash of the page) and packed blocks for every page at least once. Equal pages
    fall into one chunk. What most pages of a host have, most pages of one of its chunks have, so chunks
    give candidates; one whose sum over these chunks leaves it open is counted in all of them.
    """
    sizes = keep(read.select("host", "kind").distinct().groupBy("host").agg(F.count("*").alias("kinds"))
                 .filter(F.col("kinds") >= PAGES_OF_LINE).withColumn("chunks", F.ceil(F.col("kinds") / CHUNK_PAGES).cast("long")))
    large = F.broadcast(sizes.filter("chunks > 1").select("host", "chunks"))        # at most a CHUNK_PAGES-th of the pages
    dealt = read.select("host", "kind", "blocks").join(large, "host", "left").select(
        "host", F.pmod(F.xxhash64("kind"), F.coalesce("chunks", F.lit(1))).cast("int").alias("chunk"), "blocks")
    schema = "host string, chunk int, run long, n long"

    def table(rows: pa.Table, run: np.ndarray, n: np.ndarray) -> pa.Table:
        same = [pa.array([rows.column(c)[0].as_py()] * len(run), kind) for c, kind in (("host", pa.string()), ("chunk", pa.int32()))]
        return pa.table([*same, pa.array(run.view(np.int64)), pa.array(n.astype(np.int64))], names=["host", "chunk", "run", "n"])

    def likely(rows: pa.Table) -> pa.Table:
        run, n, _, _, kinds = runs_of(unpacked(rows.column("blocks")))
        return table(rows, run[2 * n > kinds], n[2 * n > kinds])

    def counted(rows: pa.Table, asked: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return table(asked, np.zeros(0, np.uint64), np.zeros(0, np.int64))
        run, n, *_ = runs_of(unpacked(rows.column("blocks")))
        here = np.isin(run, asked.column("run").to_numpy().view(np.uint64))
        return table(rows, run[here], n[here])

    found = keep(dealt.groupBy("host", "chunk").applyInArrow(likely, schema))
    total = keep(found.groupBy("host", "run").agg(F.sum("n").alias("n")).join(sizes, "host"))
    is_line = (F.col("n") >= PAGES_OF_LINE) & (2 * F.col("n") > F.col("kinds"))
    asked = keep(total.filter(~is_line & (F.col("chunks") > 1)).select(
        "host", "run", F.explode(F.sequence(F.lit(0), (F.col("chunks") - 1).cast("int"))).alias("chunk")))
    again = (dealt.join(asked.select("host").distinct(), "host", "left_semi").groupBy("host", "chunk")
             .cogroup(asked.groupBy("host", "chunk")).applyInArrow(counted, schema)
             .groupBy("host", "run").agg(F.sum("n").alias("n")).join(sizes, "host"))
    return (total.filter(is_line).select("host", "run").unionByName(again.filter(is_line).select("host", "run"))
            .groupBy("host").agg(F.collect_list("run").alias("lines")))


def extract(df: DataFrame, id: str = "page_id", url: str = "url", source: str = "html") -> DataFrame:
    """(id, url, text, removed) of every row: the main text, and the blocks removed as repeated.

    A null or empty page has an empty text. Pages without a host share an empty one. Repeated rows get
    equal texts; they do not count as different pages. Other columns of ``df`` do not matter; no rows give
    an empty table.
    """
    host, _ = host_and_path(F.col(f"`{url}`"))
    pages = df.select(F.col(f"`{id}`").alias("id"), F.col(f"`{url}`").alias("url"),
                      F.col(f"`{source}`").alias("html"), F.coalesce(host, F.lit("")).alias("host"))
    kinds = [pages.schema["id"], pages.schema["url"]]
    blocks_kind = T.ArrayType(T.StringType())
    schema = T.StructType([*kinds, pages.schema["host"], T.StructField("kind", T.LongType()), T.StructField("again", T.BooleanType()),
                           T.StructField("blocks", T.BinaryType()), T.StructField("marks", T.ArrayType(T.BooleanType()))])

    def parsed(batches):
        for batch in batches:
            for part in pieces(batch, "html"):
                found = [parse(x or "") for x in part.column(2).to_pylist()]
                kind, seen, again = [page_hash(page.blocks) for page in found], set(), []
                for key in zip(part.column(3).to_pylist(), kind):
                    again.append(key in seen)
                    seen.add(key)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), part.column(3), pa.array(kind, pa.int64()), pa.array(again, pa.bool_()),
                     pa.array([packed(p.blocks) for p in found], pa.binary()),
                     pa.array([p.chosen() for p in found], pa.list_(pa.bool_()))],
                    names=["id", "url", "host", "kind", "again", "blocks", "marks"])

    read = keep(pages.mapInArrow(parsed, schema).withColumn("row", F.monotonically_increasing_id()))
    lines = keep(host_lines(read.filter("not again")))
    marked, rest = read.filter("marks is not null"), read.filter("marks is null")
    # Hosts all of whose pages are marked need no other runs.
    sizes = keep(read.groupBy("host").agg(F.count("*").alias("n"), F.count_if(F.col("marks").isNull()).alias("asking"))
                 .filter("asking > 0").select("host", F.ceil(F.col("n") / CHUNK_PAGES).alias("chunks")))
    chunk = F.pmod(F.xxhash64("row"), F.col("chunks")).cast("int").alias("chunk")

    def runs(rows: pa.Table) -> pa.Table:
        different, _, least, most, _ = runs_of(unpacked(rows.column("blocks")))
        n = len(different)
        return pa.table({"host": pa.array([rows.column("host")[0].as_py()] * n, pa.string()),
                         "chunk": pa.array([rows.column("chunk")[0].as_py()] * n, pa.int32()),
                         "run": different.view(np.int64), "least": least, "most": most})

    here = keep(read.join(sizes, "host").select("host", chunk, "blocks").groupBy("host", "chunk")
                .applyInArrow(runs, "host string, chunk int, run long, least long, most long"))
    several = (here.groupBy("host", "run").agg(F.min("least").alias("least"), F.max("most").alias("most"))
               .filter("least < most").select("host", "run"))
    back = here.join(several, ["host", "run"]).select("host", "chunk", "run")
    out = T.StructType([*kinds, T.StructField("text", T.StringType()), T.StructField("removed", blocks_kind)])

    def cleaned(rows: pa.Table, found: pa.Table) -> pa.Table:
        shared, texts, removed = np.sort(found.column("run").to_numpy().view(np.uint64)), [], []
        for blocks in unpacked(rows.column("blocks")):
            stays = without_runs(blocks, shared)
            texts.append("\n".join(b for b, ok in zip(blocks, stays) if ok))
            removed.append([b for b, ok in zip(blocks, stays) if not ok])
        return pa.table({"id": rows.column("id"), "url": rows.column("url"), "text": pa.array(texts, pa.string()),
                         "removed": pa.array(removed, pa.list_(pa.string()))})

    asking = rest.join(sizes, "host").select("id", "url", "blocks", "host", chunk)
    unmarked = asking.groupBy("host", "chunk").cogroup(back.groupBy("host", "chunk")).applyInArrow(cleaned, out)

    def chosen(batches):
        for batch in batches:
            texts, removed = [], []
            for blocks, marks, own in zip(unpacked(batch.column(2)), *(batch.column(k).to_pylist() for k in (3, 4))):
                stays = without_lines(blocks, marks, np.sort(np.array(own, np.int64).view(np.uint64))) if own else marks
                texts.append("\n".join(b for b, ok in zip(blocks, stays) if ok))
                removed.append([b for b, ok, was in zip(blocks, stays, marks) if was and not ok])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                                              pa.array(removed, pa.list_(pa.string()))], names=["id", "url", "text", "removed"])

    told = marked.join(lines, "host", "left").select("id", "url", "blocks", "marks", "lines").mapInArrow(chosen, out)
    return told.unionByName(unmarked).withColumnsRenamed({"id": id, "url": url})
