"""Main text of web pages by a site style tree (operator 5).

Pages of one host are merged into a tree: a node is a path of elements (tag and class tokens), its
presentation styles are the child sequences seen there, its content features the text blocks.  From
how styles and features spread over the pages follows a node's importance:

* presentation: entropy of its styles, in units of log(pages): a branch that looks the same on every
  page says nothing;
* content: 1 - mean entropy of its features over pages: a block that stands on every page counts 0,
  one that stands on a single page counts 1;
* composite, from the leaves up: (1 - g^l) * presentation + g^l * mean of the children, with l styles.

Branches whose nodes are all below ``LEAST`` are cut from each page.  Copies of a page count once.
Hosts with fewer than ``LEAST_PAGES`` pages cannot show what repeats, so the same tree over all hosts
(paths on ``LEAST_PAGES`` pages, whatever the number of pages) is used beside the host's own.  What element names and roles
declare (navigation, forms, adverts, comments, ...) is cut as well.  Class and id tokens that declare such
things lower an element's importance below ``LEAST``, unless it is, or holds, the article (the longest
one that is not declared itself, if there is any) or most of the page's text.

Inside an article or main element a path is shared by many unlike paragraphs, so single blocks are
judged there: a block goes if it stands on at least half of the pages that have its path, on the host or
over all hosts, and a path of low importance goes if none of its blocks is single.  Text inside is chosen over text
outside if its length times importance is at least 1 / ``OUTSIDE`` of that outside; else both stay.

All statistics are grouped counts; pages are parsed twice (to count and to cut), and only hashes are
shuffled for counting.  Pages of a host with the same paths share one shape; the trees are joined to shapes, and the
shapes' parts of them to pages by broadcast while Spark's size limit for broadcasts allows it, else by shape.  Of the collection-wide tree, paths of at least one page in ``COMMON`` are broadcast
(at most ``COMMON`` times the paths of an average page); rarer ones are joined by path.

Defined results: NULL or empty html, and pages where nothing is left, have the empty text.  Broken
markup is read as far as it goes: missing end tags are implied, an unfinished tag at the end is dropped.
A NULL or odd url has the empty host.  Repeated rows get equal results.
"""

from __future__ import annotations

import html as entities
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curata.llm.common import materialise

LEAST = 0.5
LEAST_INSIDE = 0.25        # content, for paths inside an article
OUTSIDE = 2                # text outside an article stays if it weighs more than so many times that inside
LEAST_PAGES = 8
COMMON = 1_000
DECAY = 0.9
DECLARED = 0.25            # factor of the importance of elements that a token declares
NAMES_KEPT = 100_000

#: HTML element groups.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
EMBEDDED = frozenset("template svg math select object canvas audio video".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q s samp small span strike strong sub sup time tt u var".split())
CUT = RAW | EMBEDDED | frozenset("head nav footer aside form button dialog menu fieldset datalist".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar toolbar".split())
#: Class and id tokens that declare what is not the article; a token counts as a whole.
TOKENS = re.compile(
    r"^(ads?|advert\w*|adsense|banner|sponsor\w*|promo\w*|nav\w*|menu\w*|sidebar\w*|side|footer\w*|foot|masthead|topbar|cookie\w*|consent|gdpr|notices?|notification|alert|popup"
    r"|overlay|modal|newsletter|subscri\w*|share|sharing|social|related|recommend\w*|teaser\w*|comments?|commentlist|disqus|replies|reply|respond|breadcrumbs?|widgets?|login|signin|signup"
    r"|search\w*|pagination|pager|toolbar|legal|copyright|skip|hidden|paywall|outbrain|taboola)$")
WEAK = frozenset(("header", "head"))
#: Start tags that end an open element of these names.
ENDS = {**dict.fromkeys("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split(), ("p",)),
        "li": ("li", "p"), "dd": ("dd", "dt", "p"), "dt": ("dd", "dt", "p"), "td": ("td", "th"), "th": ("td", "th"), "tr": ("tr", "td", "th"), "option": ("option",)}
SCOPES = EMBEDDED | frozenset("ul ol dl table article section div main body html td th nav aside header footer form blockquote".split())

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*"|'[^']*')*+)>|<[a-zA-Z/][^<]*+\Z|[^<]++|<""", re.S)
_ATTRIBUTE = re.compile(r"""(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_TAIL = re.compile(r"<!--.*+|<[!?].*+|<[a-zA-Z/][^<]*+\Z|[^<]++|<", re.S)       # what follows the last ">"
_START = re.compile(r"</?[a-zA-Z][^\s/>]*+")
_INSIDE = re.compile(r"""(?:[^>"']++|"[^"]*"|'[^']*')*+""")
_UNQUOTED = re.compile(r""""[^"]*"|'[^']*'|<(?=/?[a-zA-Z])""")
_EMBEDDED = re.compile(rf"<(/?)({'|'.join(sorted(EMBEDDED))})(?=[\s/>])", re.I)
_LESS = re.compile("<")
_QUOTED = re.compile(r""""[^"]*"|'[^']*'""")
_SPLIT = re.compile(r"[\s_\-:]+")
_HOST = r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/@?#]*@)?([^/:?#]+)"


@dataclass
class Page:
    """Nodes in document order (parent number, path, tag, inside an article, declared by a token) and text blocks."""

    parent: list[int] = field(default_factory=list)
    path: list[int] = field(default_factory=list)
    tag: list[str] = field(default_factory=list)
    inside: list[bool] = field(default_factory=list)
    declared: list[bool] = field(default_factory=list)
    children: list[list[int]] = field(default_factory=list)
    blocks: list[tuple[int, str]] = field(default_factory=list)

    def packed(self) -> bytes:
        """What cutting needs: all but the child sequences."""
        return json.dumps([self.parent, self.path, self.tag, self.inside, self.declared, self.blocks], ensure_ascii=False, separators=(",", ":")).encode("utf-8", "replace")

    @staticmethod
    def unpacked(data: bytes) -> Page:
        parent, path, tag, inside, declared, blocks = json.loads(data)
        return Page(parent, path, tag, inside, declared, [], [(n, t) for n, t in blocks])

    def styles(self) -> set[tuple[int, int]]:
        return {(p, _hash(repr(c))) for p, c in zip(self.path, self.children, strict=True)}

    def features(self) -> set[tuple[int, int]]:
        """Blocks by path."""
        return {(self.path[n], _hash(t)) for n, t in self.blocks}


def _hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "replace")) - (1 << 63)


def _closes_itself(attributes: str) -> bool:
    """Whether a start tag ends in a slash that is not the end of an unquoted value."""
    return attributes.endswith("/") and not re.search(r"=\s*[^\s\"']*/$", _QUOTED.sub('""', attributes))


def _unfinished(text: str, at: int, dead: set[int]) -> None:
    """The tag at ``at`` has a quote that nothing closes: neither it nor a tag that starts in it outside quotes ends."""
    name = _START.match(text, at)
    inside = _INSIDE.match(text, name.end())
    dead.add(at)
    dead.update(m.start() for m in _UNQUOTED.finditer(text, name.end(), inside.end()) if m[0] == "<")


def _left_open(text: str) -> set[int]:
    """Where the start tags of embedded elements end that no end tag closes; they hold nothing."""
    opened: dict[str, list[int]] = {}
    dead: set[int] = set()
    done = 0
    for m in _EMBEDDED.finditer(text, 0, text.rfind(">") + 1):
        if m.start() < done or m.start() in dead:
            continue
        inside = _INSIDE.match(text, m.end())
        if text[inside.end():inside.end() + 1] != ">":
            _unfinished(text, m.start(), dead)
            continue
        done = inside.end() + 1
        own = opened.setdefault(m[2].lower(), [])
        if not m[1]:
            if not _closes_itself(inside[0]):
                own.append(done)
        elif own:
            own.pop()
    return {at for own in opened.values() for at in own}


class Stack:
    """Open elements (tag, node or the enclosing one's, cut), with the places of each tag, so that no search walks through them."""

    def __init__(self, root: int) -> None:
        self.items: list[tuple[str, int, bool]] = [("html", root, False)]
        self.places: dict[str, list[int]] = {}
        self.scopes: list[int] = []
        self.solid: list[int] = []         # elements that are not inline

    def push(self, tag: str, number: int, cut: bool) -> None:
        k = len(self.items)
        self.items.append((tag, number, cut))
        self.places.setdefault(tag, []).append(k)
        if tag in SCOPES:
            self.scopes.append(k)
        if tag not in INLINE:
            self.solid.append(k)

    def last(self, tag: str) -> int:
        """The place of the innermost open element of a tag, or 0."""
        own = self.places.get(tag)
        return own[-1] if own else 0

    def shut(self, k: int) -> None:
        """Close the element at ``k`` and all inside it."""
        while len(self.items) > k:
            self.places[self.items.pop()[0]].pop()
        for places in (self.scopes, self.solid):
            while places and places[-1] >= k:
                places.pop()


class Reader:
    """Reads pages; remembers what elements of one kind mean."""

    def __init__(self) -> None:
        self.names: dict[tuple[int, str, str], tuple[int, bool, bool, bool, bool]] = {}

    def meaning(self, parent: int, tag: str, attributes: str) -> tuple[int, bool, bool, bool, bool]:
        """(path, cut by name or role, cut outside an article, declared by a token, declared by a token outside an article) of an element."""
        key = (parent, tag, attributes)
        found = self.names.get(key)
        if found is None:
            if len(self.names) >= NAMES_KEPT:
                self.names.clear()
            cut, weak, declared, mild, tokens = tag in CUT, tag == "header", False, False, []
            if attributes:
                for name, value in _ATTRIBUTE.findall(attributes):
                    name, value = name.lower(), value.strip("\"'").lower()
                    if name in ("class", "id"):
                        own = [x for x in _SPLIT.split(value) if x]
                        declared = declared or any(map(TOKENS.match, own))
                        mild = mild or any(x in WEAK for x in own)
                        tokens += own if name == "class" else []
                    elif name == "role":
                        cut = cut or value in ROLES
                    elif name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and re.search(r"display\s*:\s*none", value):
                        cut = True
            shape = " ".join(sorted({re.sub(r"\d+", "#", x) for x in tokens}))
            found = self.names[key] = (_hash(f"{parent} {tag} {shape}"), cut, weak, declared, mild)
        return found

    def read(self, text: str | None) -> Page:
        page = Page()
        words: list[str] = []
        holder = -1

        def flush() -> None:
            nonlocal words
            if words:
                block = " ".join(entities.unescape("".join(words)).split())
                if block:
                    page.blocks.append((holder, block))
                words = []

        def node(tag: str, path: int, above: int, declared: bool = False) -> int:
            page.parent.append(above)
            page.path.append(path)
            page.tag.append(tag)
            page.inside.append(tag in ("article", "main") or above >= 0 and page.inside[above])
            page.declared.append(declared)
            page.children.append([])
            if above >= 0:
                page.children[above].append(path)
            return len(page.path) - 1

        root = node("html", _hash("root"), -1)
        stack = Stack(root)
        holder = root
        text = text or ""
        at, end, last = 0, len(text), text.rfind(">")
        left_open: set[int] | None = None
        dead: set[int] = set()             # where tags start that never end
        while at < end:
            if at > last:
                m, tag = _TAIL.match(text, at), None
            elif at in dead:
                m, tag = _LESS.match(text, at), None
            else:
                m = _TOKEN.match(text, at)
                tag = m[2]
            if tag is None:
                piece = m[0]
                if piece == "<" and at < last and at not in dead and _START.match(text, at):
                    _unfinished(text, at, dead)
                at = m.end()
                if piece[0] != "<" or piece == "<":
                    if not stack.items[-1][2]:
                        words.append(piece)
                continue
            at = m.end()
            tag = tag.lower()
            if m[1]:
                if tag not in INLINE:
                    flush()
                k = stack.last(tag)
                if k and not (tag in INLINE and stack.solid and stack.solid[-1] > k):
                    if stack.items[k - 1][1] != holder:      # a declared inline element ends
                        flush()
                    stack.shut(k)
                holder = stack.items[-1][1]
                continue
            if tag in ("html", "body"):
                continue
            if tag not in INLINE:
                if tag in VOID:
                    words.append(" ")
                    if tag != "hr":
                        continue
                flush()
                for name in ENDS.get(tag, ()):
                    k = stack.last(name)
                    if k and not (stack.scopes and stack.scopes[-1] > k):
                        stack.shut(k)
                if tag in VOID:
                    holder = stack.items[-1][1]
                    continue
            _, above, hidden = stack.items[-1]
            path, cut, weak, declared, mild = self.meaning(page.path[above], tag, m[3])
            cut = hidden or cut or weak and not page.inside[above]
            declared = declared or mild and not page.inside[above]
            if tag in RAW or tag in EMBEDDED:
                if _closes_itself(m[3]):
                    continue
                if tag in RAW:
                    close = re.compile(rf"</{re.escape(tag)}[\s/>]", re.I).search(text, at)
                    at = close.start() if close else end
                else:
                    left_open = _left_open(text) if left_open is None else left_open
                    if at in left_open:
                        continue
            if tag in INLINE and (cut or not declared):
                stack.push(tag, above, cut)
            else:
                if tag in INLINE:
                    flush()
                number = above if cut else node(tag, path, above, declared)
                stack.push(tag, number, cut)
                holder = number
        flush()
        return page


def _declared(page: Page) -> list[bool]:
    """Nodes that a token declares and that neither are nor hold the article or most of the page's text."""
    if not any(page.declared):
        return page.declared
    n = len(page.path)
    size, holds = [0] * n, [False] * n
    for b, t in page.blocks:
        size[b] += len(t)
    under = list(page.declared)             # declared itself or below such an element
    for i in range(n - 1, 0, -1):
        size[page.parent[i]] += size[i]
    for i in range(1, n):
        under[i] = under[i] or under[page.parent[i]] and page.tag[i] not in ("article", "main")
    articles = [i for i in range(n) if page.tag[i] in ("article", "main") and size[i]]
    for kind in ("article", "main"):
        own = [i for i in articles if page.tag[i] == kind and not under[i]]
        if own:
            holds[max(own, key=lambda i: size[i])] = True
    if articles and not any(holds):
        holds[max(articles, key=lambda i: size[i])] = True
    for i in range(n - 1, -1, -1):
        holds[i] = holds[i] or 2 * size[i] > size[0]
        if holds[i] and i:
            holds[page.parent[i]] = True
    return [d and not h for d, h in zip(page.declared, holds, strict=True)]


def importances(page: Page, known: dict[int, tuple[float, float, int]]) -> list[float]:
    """Composite importance of every node; ``known`` has (presentation, content, styles) by path."""
    n = len(page.path)
    total, count = [0.0] * n, [0] * n
    seen = {b for b, _ in page.blocks}
    for b in seen:
        total[b] += known.get(page.path[b], (1.0, 1.0, 1))[1]
        count[b] += 1
    out = [1.0] * n
    declared = _declared(page)
    for i in range(n - 1, -1, -1):       # children come after their parents
        presentation, content, styles = known.get(page.path[i], (1.0, 1.0, 1))
        g = DECAY ** styles
        below = total[i] / count[i] if count[i] else content
        out[i] = ((1 - g) * presentation + g * below) * (DECLARED if declared[i] else 1.0)
        if page.parent[i] >= 0:
            total[page.parent[i]] += out[i]
            count[page.parent[i]] += 1
    return out


def main_text(page: Page, known: dict[int, tuple[float, float, int]], repeated: frozenset | set[tuple[int, int | None]] = frozenset()) -> str:
    """The blocks that are left once low branches and, inside articles, ``repeated`` (path, block or None: all) are cut, joined by blanks."""
    worth, declared = importances(page, known), _declared(page)
    n = len(page.path)
    low = [False] * n
    alive = [0] * n
    for i in range(n - 1, -1, -1):
        low[i] = declared[i] or not page.inside[i] and worth[i] < LEAST and alive[i] == 0
        if not low[i] and page.parent[i] >= 0:
            alive[page.parent[i]] += 1
    gone = [False] * n
    for i in range(n):
        gone[i] = low[i] or page.parent[i] >= 0 and gone[page.parent[i]]
    for i in range(n):
        gone[i] = gone[i] or page.inside[i] and worth[i] < LEAST and (page.path[i], None) in repeated
    left = [(b, t) for b, t in page.blocks if not gone[b] and not (page.inside[b] and (page.path[b], _hash(t)) in repeated)] or page.blocks      # all alike: entropy tells nothing
    weight = [0.0, 0.0]
    for b, t in left:
        weight[page.inside[b]] += len(t) * worth[b]
    outside = weight[0] > OUTSIDE * weight[1] or not any(page.inside[b] for b, _ in left)
    return " ".join(t for b, t in left if outside or page.inside[b])


def _host(url: str):
    return F.xxhash64(F.lower(F.coalesce(F.regexp_extract(F.col(url), _HOST, 1), F.lit(""))))


def _shape(host: int, page: Page) -> int:
    """Names a host's pages that have the same paths."""
    return _hash(repr((host, sorted(set(page.path)))))


def outlines(pages: DataFrame) -> DataFrame:
    """(host, body, shape, style_paths, style_values, feature_paths, feature_values): what a page adds to the trees, as hashes."""
    flat = [f"{kind}_{part}" for kind in ("style", "feature") for part in ("paths", "values")]
    schema = ", ".join(["host long", "body long", "shape long", *[f"{c} array<long>" for c in flat]])

    def outline(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader()
        for batch in batches:
            read = [reader.read(t.as_py()) for t in batch.column("html")]
            shapes = pa.array([_shape(h.as_py(), x) for h, x in zip(batch.column("host"), read, strict=True)], pa.int64())
            pairs = [[sorted(getattr(x, name)()) for x in read] for name in ("styles", "features")]
            lists = [pa.array([[e[k] for e in p] for p in kind], pa.list_(pa.int64())) for kind in pairs for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column("host"), batch.column("body"), shapes, *lists], ["host", "body", "shape", *flat])

    return pages.select("host", "body", "html").mapInArrow(outline, schema)


def style_trees(outline: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Importance by (host, path) and, over all hosts, by path: (presentation, content, styles, dull, repeated, pages).

    ``dull`` paths have a low content and no single block.  ``repeated`` has the blocks on at least half of the path's pages, so at most twice the blocks of one page.
    Copies of a page are dropped as whole outlines, so entries are counted in each task before they are shuffled.
    """
    entry = lambda kind, name: F.zip_with(f"{name}_paths", f"{name}_values", lambda p, v: F.struct(F.lit(kind).alias("kind"), p.alias("path"), v.alias("value")))
    seen = F.transform(F.array_distinct("style_paths"), lambda p: F.struct(F.lit(2).alias("kind"), p.alias("path"), F.lit(0).cast("long").alias("value")))
    rows = outline.dropDuplicates(["host", "body"]).select("host", F.explode(F.concat(entry(0, "style"), entry(1, "feature"), seen)).alias("e")).select("host", "e.*")
    counts = rows.groupBy("host", "path", "kind", "value").agg(F.count("*").alias("k"))

    def tree(counts: DataFrame, *by: str) -> DataFrame:
        of = lambda kind, x: F.sum(F.when(F.col("kind") == kind, x).otherwise(0.0))
        sums = counts.groupBy(*by).agg(F.max(F.when(F.col("kind") == 2, F.col("k"))).alias("pages"), of(0, 1.0).alias("styles"), of(0, F.col("k")).alias("uses"),
                                       of(0, F.col("k") * F.log("k")).alias("k_log_k"), of(1, 1.0).alias("n_features"), of(1, F.log("k")).alias("log_k"), F.min(F.when(F.col("kind") == 1, F.col("k"))).alias("least_k"))
        unit = F.log(F.greatest(F.col("pages"), F.lit(2)))
        presentation = F.least(F.lit(1.0), F.greatest(F.lit(0.0), (F.log("uses") - F.col("k_log_k") / F.col("uses")) / unit))
        content = F.when(F.col("n_features") > 0, 1 - F.col("log_k") / F.col("n_features") / unit).otherwise(F.lit(1.0))
        dull = (content < LEAST_INSIDE) & F.coalesce(F.col("least_k") > 1, F.lit(False))
        trees = sums.select(*by, presentation.alias("presentation"), content.alias("content"), F.col("styles").cast("int").alias("styles"), dull.alias("dull"), "pages").filter(F.col("pages") >= LEAST_PAGES)
        often = counts.select(*by, "value", F.when(F.col("kind") == 1, F.col("k")).alias("k")).filter(F.col("k") * 2 >= LEAST_PAGES)
        often = often.join(trees.select(*by, "pages"), list(by)).filter(F.col("k") * 2 >= F.col("pages")).groupBy(*by).agg(F.collect_list("value").alias("repeated"))
        return trees.join(often, list(by), "left").select(*by, "presentation", "content", "styles", "dull", "repeated", "pages")

    hosts = tree(counts, "host", "path")
    everywhere = tree(counts.groupBy("path", "kind", "value").agg(F.sum("k").alias("k")), "path")
    return hosts, everywhere


def _packed(rows: DataFrame) -> DataFrame:
    """(keys, shape, page): the pages as read, without what the reader cuts, compressed as they travel through the join."""
    schema = T.StructType([rows.schema["keys"], T.StructField("shape", T.LongType()), T.StructField("page", T.BinaryType())])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, compress = Reader(), zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            read = [reader.read(t.as_py()) for t in batch.column("html")]
            shapes = pa.array([_shape(h.as_py(), x) for h, x in zip(batch.column("host"), read, strict=True)], pa.int64())
            packed = pa.array([compress(x.packed()) for x in read], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("keys"), shapes, packed], ["keys", "shape", "page"])

    return rows.select("keys", "host", "html").mapInArrow(pack, schema)


def extract(pages: DataFrame, html: str = "html", url: str = "url", keys: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """(keys..., text) per row of ``pages``."""
    rows = pages.select(F.struct(*[F.col(k) for k in keys]).alias("keys"), F.coalesce(F.col(html).cast("string"), F.lit("")).alias("html"), _host(url).alias("host"))
    outline = materialise(outlines(rows.withColumn("body", F.xxhash64("html"))), "page-outlines")
    hosts, everywhere = style_trees(outline)
    n_pages = outline.count()
    columns = ["presentation", "content", "styles", "dull", "repeated"]
    everywhere = materialise(everywhere.select("path", *columns, "pages"), "page-tree")
    common = everywhere.filter(F.col("pages") >= max(LEAST_PAGES, n_pages / COMMON))
    shared = pages.sparkSession.sparkContext.broadcast({r["path"]: (r["presentation"], r["content"], r["styles"], (*(r["repeated"] or ()), *[None] * r["dull"])) for r in common.collect()})
    own = outline.select("host", "shape", F.explode(F.array_distinct("style_paths")).alias("path")).distinct()      # one row for each path of a shape, however many pages have it
    found = own.join(hosts, ["host", "path"]).select("shape", "path", *columns)
    if n_pages > LEAST_PAGES * COMMON:      # no key of this join is on more than one page in COMMON
        found = found.unionByName(own.join(everywhere.filter(F.col("pages") < n_pages / COMMON), "path").select("shape", "path", *columns))
    known = found.groupBy("shape").agg(F.collect_list(F.struct("path", *columns)).alias("known"))      # at most two entries for each path of the shape
    # written, so that its size is known to the join: a small table is broadcast and pages stay where they are
    joined = _packed(rows).join(materialise(known, "page-shapes"), "shape", "left").select("keys", "page", "known")
    schema = T.StructType([joined.schema["keys"], T.StructField("text", T.StringType())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            out = []
            for packed, entries in zip(batch.column("page"), batch.column("known"), strict=True):
                page = Page.unpacked(unpack(packed.as_py()))
                tree = {p: shared.value[p][:3] for p in page.path if p in shared.value}
                repeated = {(p, v) for p in tree for v in shared.value[p][3]}
                for e in entries.as_py() or ():
                    before = tree.get(e["path"], (1.0, 1.0, 1))
                    tree[e["path"]] = (min(before[0], e["presentation"]), min(before[1], e["content"]), max(before[2], e["styles"]))
                    repeated.update((e["path"], v) for v in (*(e["repeated"] or ()), *[None] * e["dull"]))
                out.append(main_text(page, tree, repeated))
            yield pa.RecordBatch.from_arrays([batch.column("keys"), pa.array(out, pa.string())], ["keys", "text"])

    return joined.mapInArrow(cut, schema).select("keys.*", "text")
