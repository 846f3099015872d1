"""Operator 10: main-text extraction with consensus host paths.

1. Every page is read into a tree of blocks; each container gets the text it holds outside
   boilerplate (menus, headers, footers, sidebars, notices, adverts, forms, scripts,
   styles, comments), discounted by link text, and a generalised path: tags with their
   class words, digits removed, wrappers without class and repeated siblings folded.  A
   container is boilerplate by name if all its class and id words say so; one with other
   words besides (``content has-sidebar``), or a form, only if all of its kind hold a minor
   part of the page's unlinked text, else its score is lowered.
2. In Spark every page votes for its best path with its share of the text; votes are summed
   per host and path (partial aggregation), and the strongest path of each host wins.
3. Every page is read again and its main text is taken from the containers on the host's
   path; a page that has none of them falls back on its own best container.  The paths are
   brought to the pages: the html of a host never meets in one task.

Character references are decoded, white space inside a block becomes one space, blocks are
joined in page order by one space.

Edge cases: null or empty html gives an empty text; unclosed, stray and cut-off tags are
tolerated; a page whose url is null or has no host is its own host class (empty string);
repeated pages are extracted one by one; an empty table gives an empty result.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prepframe.llm.common import cut_lineage, map_batches, prepare

# Fixed values of HTML: elements without content, with raw content, and inline elements.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style noscript template textarea title iframe svg math noframes object".split())
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rt rp s samp small span strike strong "
    "sub sup time tt u var wbr img".split()
)
SKIP_TAGS = set("nav header footer aside button select menu dialog head".split()) | RAW
SKIP_ROLES = set("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
# Whole words of class and id that mark boilerplate.
SKIP_WORDS = set(
    "ad ads adv advert adverts advertisement advertising adbox adslot sponsor sponsored promo promotion banner nav navbar navigation "
    "menu menubar breadcrumb breadcrumbs sidebar side rail widget widgets footer foot header masthead topbar toolbar cookie cookies "
    "consent gdpr notice notification alert popup modal overlay newsletter subscribe subscription signup login share sharing social "
    "related recommended recommendations comment comments reply replies respond disqus pagination pager skip".split()
)
# Words that say how a box is built; beside a word of boilerplate they do not make it content.
BUILT_WORDS = set("list area thread box section wrapper wrap bar block panel site user form container holder inner outer item items".split())
# Elements whose start or end closes an open paragraph.
CLOSES_P = set(
    "address article aside blockquote body details dialog div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html "
    "main menu nav ol p pre section table ul".split()
)
_OPEN = re.compile(r"<(?:!--|[!?]|(/?)([A-Za-z][^\s/>]*)|/)")
_MARK = re.compile(r"[>\"']")
_ATTR = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_LETTER = re.compile(r"[^\W\d_]")
_WORD = re.compile(r"[A-Za-z]+")
_CUT_OFF = re.compile(r"<[A-Za-z/!?][^>]*\Z")
_SPACE = re.compile(r"\s+")


@dataclass
class Node:
    tag: str
    path: str
    skip: bool
    parent: "Node | None"
    named: int = 0  # boilerplate by 1: some of its words (or a form), 2: all of its words
    kind: tuple = ()  # tag and words of class and id
    items: list = field(default_factory=list)  # text pieces and child nodes in page order
    size: int = 0  # characters of own and inner text outside boilerplate
    linked: int = 0  # of these, inside links


def skip_word(word: str) -> bool:
    """A word of boilerplate, alone or run together with a word of how a box is built."""
    if word in SKIP_WORDS:
        return True
    return any(word.endswith(w) and word[: -len(w)] in SKIP_WORDS and len(word) - len(w) > 3 for w in ("list", "area", "box", "section", "bar", "wrapper"))


def boilerplate(names: list[str]) -> bool:
    """Whether a class or id speaks of nothing but boilerplate and its box."""
    return any(map(skip_word, names)) and all(skip_word(n) or n in BUILT_WORDS for n in names)


class Scanner:
    """Tags and comments of a page in one forward pass.

    A start tag ends at the first ``>`` outside quotes, or at the first one at all if there is
    none.  What a search has not found is remembered, so that no later one looks again:
    marks that do not come any more, and places outside quotes from which no ``>`` follows."""

    def __init__(self, page: str, stop: int):
        self.page, self.stop = page, stop
        self.gone: dict[str, int] = {}  # from here on the mark does not occur
        self.dead: set[int] = set()

    def find(self, mark: str, at: int) -> int:
        if at >= self.gone.get(mark, self.stop):
            return -1
        found = self.page.find(mark, at, self.stop)
        if found < 0:
            self.gone[mark] = at
        return found

    def tag_end(self, at: int) -> int:
        """The place of the ``>`` that ends the tag whose attributes begin at ``at``, or -1."""
        seen = []
        while at not in self.dead and at < self.gone.get("any", self.stop):
            seen.append(at)
            m = _MARK.search(self.page, at, self.stop)
            if not m:
                self.gone["any"] = at
                break
            if m[0] == ">":
                return m.start()
            close = self.find(m[0], m.end())
            if close < 0:
                break
            at = close + 1
        self.dead.update(seen)
        return -1

    def tokens(self):
        """(start, end, is an end tag, tag or None, attributes) of every token in page order."""
        page, stop, at = self.page, self.stop, 0
        while m := _OPEN.search(page, at, stop):
            start, tag, attrs = m.start(), None, ""
            if m[0] == "<!--":
                close = self.find("-->", m.end())
                at = stop if close < 0 else close + 3
            elif not m[2]:
                close = self.find(">", m.end())
                at = stop if close < 0 else close + 1
            else:
                close = self.tag_end(m.end())
                if close >= 0:
                    tag, attrs, at = m[2].lower(), page[m.end() : close], close + 1
                else:
                    close = self.find(">", m.end())
                    if close < 0 and not m[1]:  # no tag: text
                        at = start + 1
                        continue
                    at = stop if close < 0 else close + 1
            jump = yield start, at, bool(m[1]), tag, attrs
            if jump is not None:
                at = jump


def parse(page: str) -> Node:
    """Tree of the page; subtrees skipped by tag or role keep no text, names are settled by ``settle``."""
    root = cur = Node("", "", False, None)
    at, end = 0, len(page)
    cut = _CUT_OFF.search(page, max(0, end - 4096))
    stop = cut.start() if cut and ">" not in page[cut.start() :] else end

    def text(a: int, b: int) -> None:
        if a < b and not cur.skip:
            cur.items.append(page[a:b])

    opened: dict[str, int] = {}  # open elements by tag: an end tag without one costs no walk

    def leave(node: Node) -> Node:
        """Close everything inside ``node`` and itself."""
        here = cur
        while True:
            opened[here.tag] -= 1
            if here is node:
                return node.parent
            here = here.parent

    def start_tag(tag: str, attributes: str, at: int) -> int:
        """Open an element; where the text goes on."""
        nonlocal cur
        if tag in CLOSES_P:
            node = cur
            while node.tag in INLINE:
                node = node.parent
            if node.tag == "p":
                cur = leave(node)
        elif tag in ("li", "dt", "dd", "tr", "td", "th", "option"):
            node = cur
            while node.tag in INLINE or node.tag == "p":
                node = node.parent
            if node.tag == tag:
                cur = leave(node)
        attrs = {k.lower(): a or b or c for k, a, b, c in _ATTR.findall(attributes)} if attributes else {}
        names = [w.lower() for k in ("class", "id") for w in _WORD.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", attrs.get(k, "")))]
        skip = cur.skip or tag in SKIP_TAGS or attrs.get("role", "").lower() in SKIP_ROLES
        named = 1 if tag == "form" else 0
        if tag not in ("html", "body", "article", "main") and any(map(skip_word, names)):
            named = 2 if boilerplate(names) else 1
        if tag in RAW:
            close = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at, stop)
            return close.end() if close else stop
        label = tag + "".join("." + w for w in sorted({w.lower() for w in _WORD.findall(attrs.get("class", ""))}))
        path = cur.path
        if tag not in INLINE and label not in ("html", "body", "div", "p", "br") and path.rpartition("/")[2] != label:
            path = f"{path}/{label}"
        node = Node(tag, path, skip, cur, named, (tag, *names) if named else ())
        cur.items.append(node)
        if tag not in VOID and not attributes.rstrip().endswith("/"):
            opened[tag] = opened.get(tag, 0) + 1
            cur = node
        return at

    scan = Scanner(page, stop)
    tokens = scan.tokens()
    token = next(tokens, None)
    while token:
        start, end, closing, tag, attributes = token
        text(at, start)
        at, jump = end, None
        if tag is None:
            pass
        elif closing:
            if (tag == "p" or tag not in VOID) and opened.get(tag):
                node = cur
                while node is not root and node.tag != tag:
                    # A block's end also ends what is left open inside; an inline end does not leave its block.
                    if tag in INLINE and node.tag not in INLINE:
                        node = root
                        break
                    node = node.parent
                if node is not root:
                    cur = leave(node)
        else:
            jump = at = start_tag(tag, attributes, at)
        try:
            token = tokens.send(jump)
        except StopIteration:
            token = None
    text(at, stop)
    return root


MINOR = 0.3  # share of a page's unlinked text below which a container with a boilerplate word is skipped
PENALTY = 0.8  # weight of a container with a boilerplate word that is not


def _unlinked(root: Node) -> dict[int, int]:
    """Unlinked characters inside every node outside boilerplate, by the node's identity."""
    order, stack = [], [root]
    while stack:
        n = stack.pop()
        order.append(n)
        stack += [x for x in n.items if isinstance(x, Node) and not x.skip and x.tag != "a"]
    size: dict[int, int] = {}
    for n in reversed(order):
        size[id(n)] = sum(len(x.strip()) if isinstance(x, str) else size.get(id(x), 0) for x in n.items)
    return size


def settle(root: Node, path: str | None = None) -> Node:
    """Skip what is boilerplate by name; containers on the way to ``path`` only if all their words say so."""
    named, stack = [], [root]
    while stack:
        n = stack.pop()
        if n.named:
            named.append(n)
        stack += [x for x in n.items if isinstance(x, Node) and not x.skip]
    if not named:
        return root
    for n in named:
        n.skip = n.named == 2
    size = _unlinked(root)
    if not size[id(root)]:  # nothing else: the names wrap the page
        for n in named:
            n.skip = False
        size = _unlinked(root)
    kinds: dict[tuple, int] = {}
    for n in named:
        if n.named == 1:
            kinds[n.kind] = kinds.get(n.kind, 0) + size.get(id(n), 0)
    for n in named:
        if n.named == 1 and kinds[n.kind] < MINOR * size[id(root)]:
            way = path is not None and n.path != n.parent.path and (path + "/").startswith(n.path + "/")
            n.skip = not way
    return root


def measure(root: Node) -> list[Node]:
    """Sizes from the leaves up; the containers that hold text."""
    order, stack = [], [root]
    while stack:
        n = stack.pop()
        order.append(n)
        stack += [x for x in n.items if isinstance(x, Node) and not x.skip]
    for n in reversed(order):
        own = sum(len(x.strip()) for x in n.items if isinstance(x, str))
        n.size += own
        if n.tag == "a":
            n.linked = n.size
        if n.parent is not None:
            n.parent.size += n.size
            n.parent.linked += n.linked
    return [n for n in order if n.tag not in INLINE and n.size]


# Containers that by name hold a page's main text weigh more.
MAIN = {"article": 1.5, "main": 1.3}


HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
PARAGRAPHS = HEADINGS | set("p pre blockquote li dt dd td th figcaption address".split())


def prose_beside(root: Node, outer: str, inner: str) -> bool:
    """Do containers on ``outer`` hold headings or unlinked paragraphs outside those on ``inner``?

    Paragraphs inside another container with a class of its own are that container's.
    """
    stack = [(root, outer == root.path, False, False)]
    while stack:
        n, inside, boxed, heading = stack.pop()
        for x in n.items:
            if isinstance(x, str):
                if inside and (heading or not boxed) and _LETTER.search(html.unescape(x)):
                    return True
            elif not x.skip and x.path != inner and (x.tag != "a" or n.tag == "h1"):
                own = x.path != n.path and "." in x.path.rpartition("/")[2] and x.tag not in PARAGRAPHS and x.path != outer
                stack.append((x, inside or x.path == outer, boxed or (inside and own), heading or x.tag in HEADINGS))
    return False


def best_path(page: str) -> tuple[str, float] | None:
    """Path of the page's best container and its share of the page's text."""
    root = settle(parse(page))
    nodes = measure(root)
    if not nodes:
        return None
    total = max(n.size for n in nodes)
    score: dict[str, float] = {}
    depth: dict[str, int] = {}
    for n in nodes:
        good = (n.size - 2 * n.linked) / total * MAIN.get(n.tag, 1.0) * (PENALTY if n.named else 1.0)
        if n.parent is None or n.parent.path != n.path:
            score[n.path] = score.get(n.path, 0.0) + good
            depth[n.path] = n.path.count("/")
    top = max(score.values())
    # A deeper container that holds nearly all of the text is the better one, if no prose is left beside it.
    near = sorted((p for p in score if score[p] >= 0.9 * top), key=lambda p: (depth[p], score[p], p))
    path = near[0]
    for p in near[1:]:
        if not prose_beside(root, path, p):
            path = p
    return path, max(0.0, score[path])


def text_of(node: Node) -> str:
    """Text outside boilerplate: blocks with single spaces, joined in page order."""
    out: list[str] = []

    def walk(n: Node) -> None:
        stack = [iter(n.items)]
        while stack:
            for x in stack[-1]:
                if isinstance(x, str):
                    out.append(x)
                elif x.skip:
                    out.append(" ")
                elif x.tag in INLINE:
                    stack.append(iter(x.items))
                    break
                else:
                    out.append(" ")
                    stack.append(iter([*x.items, " "]))
                    break
            else:
                stack.pop()

    walk(node)
    return _SPACE.sub(" ", html.unescape("".join(out))).strip()


def extract(page: str, path: str | None) -> str:
    """Main text of a page from the containers on ``path``, else from its own best one."""
    root = settle(parse(page), path)

    def on(p: str) -> list[Node]:
        found, stack = [], [root]
        while stack:
            n = stack.pop()
            if n.path == p and not n.skip:
                found.append(n)
            else:
                stack += [x for x in reversed(n.items) if isinstance(x, Node) and not x.skip]
        return found

    text = " ".join(t for t in map(text_of, on(path)) if t) if path is not None else ""
    if not text and (own := best_path(page)) is not None:
        text = " ".join(t for t in map(text_of, on(own[0])) if t)
    return text


# The hosts' paths are sent to every executor up to so many bytes; beyond, pages are salted.
MAX_BROADCAST = 32 << 20
SALTS = 64


def host_of(url: str = "url"):
    return F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))


def host_paths(pages: DataFrame) -> DataFrame:
    """(host, path): the path with the most votes of each host's pages; ``pages`` is (host, html)."""

    def vote(b: pa.RecordBatch) -> pa.RecordBatch | None:
        rows = [(h, *v) for h, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) if (v := best_path(t))]
        if not rows:
            return None
        host, path, weight = zip(*rows)
        return pa.RecordBatch.from_arrays([pa.array(host), pa.array(path), pa.array(weight, pa.float64())], names=["host", "path", "weight"])

    votes = map_batches(pages.select("host", "html"), vote, "host string, path string, weight double")
    # Whole thousandths add up alike in any order.
    sums = votes.groupBy("host", "path").agg(F.sum(F.round(F.col("weight") * 1000).cast("long")).alias("votes"))
    return sums.groupBy("host").agg(F.max(F.struct("votes", "path")).alias("best")).select("host", F.col("best.path").alias("path"))


def with_host_paths(pages: DataFrame, paths: DataFrame, max_broadcast: int, salts: int = SALTS) -> DataFrame:
    """``pages`` with the ``path`` of their host.

    A table of paths of at most ``max_broadcast`` bytes goes to the pages, which stay where
    they are.  A larger one is joined by host and salt, with a copy of each path per salt, so
    that the pages of one host are spread over ``salts`` groups."""
    size = paths.agg(F.sum(F.octet_length("host") + F.octet_length("path") + 64)).collect()[0][0] or 0  # one row
    if size <= max_broadcast:
        return pages.join(F.broadcast(paths), "host", "left")
    copies = paths.select("*", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_salt"))
    salted = pages.withColumn("_salt", F.pmod(F.xxhash64("html"), F.lit(salts)).cast("int"))
    return salted.join(copies, ["host", "_salt"], "left").drop("_salt")


def extract_pages(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", max_broadcast: int = MAX_BROADCAST,
) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    prepare(pages.sparkSession)
    src = pages.select(
        F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("html"),
        host_of(url_col).alias("host"),
    )
    paths = cut_lineage(host_paths(src))

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        texts = [extract(t, p) for t, p in zip(b.column(2).to_pylist(), b.column(3).to_pylist())]
        return pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"]
        )

    joined = with_host_paths(src, paths, max_broadcast).select("page_id", "url", "html", "path")
    kind = dict(src.dtypes)["page_id"]
    return map_batches(joined, run, f"page_id {kind}, url string, text string, n_chars long")
