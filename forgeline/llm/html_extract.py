"""Main-text extraction by consensus host paths.

1. Each page is parsed leniently and its containers are scored: a container has
   the characters of its own text outside links, and passes nine tenths of its
   score to its parent, so the container that holds the whole article beats both
   its sections and the page around it.
2. Containers vote under a generalised path: tags with their class names, digits
   replaced by ``#``, positions left out.  A page's vote for a path is the path's
   score relative to the page's best.  Tasks add votes and pages up by (host,
   path), named by a 64-bit hash, so a host with a third of all pages sends one row
   per path and task.
3. Every page is parsed again and extracted from the path on which the host's
   pages agree most: the mean vote of the pages that have it, with DOUBT pages
   without a vote added, so that a rare path needs more than one page's word.  A
   path no other page has counts with the page's own vote; equal means go by the
   page's own vote.  The rows (page, path) of all pages join the votes by path, and
   each page, named by the digest of its host and html, takes its largest.
4. From that path's containers the page climbs to the nearest article or main around
   them, else past wrappers whose other shown text is only headings and paragraphs
   outside links, less than the text inside: what a heading, standfirst or
   closing line outside the body's wrapper is.

Text inside menus, headers, footers, sidebars, notices, adverts, forms, scripts,
styles and reader comments is left out, by element, role or class name (an element
whose classes name content as well stays if it holds most of the page's text).  A header
inside an article keeps its headings.  Character references are decoded; white
space becomes one space; blocks are joined by one space.

Defined cases: NULL or empty html gives an empty text; a NULL or odd url is the
host ''; a page without containers is its body's text; repeated rows are
extracted each (and vote each); unclosed tags, attributes and comments are closed
as late as their parent; an empty table gives no rows; extra columns are
ignored."""
from __future__ import annotations

import hashlib
import html as entities
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forgeline.llm.common import join_groups

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>""", re.S)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
NAME_PARTS = re.compile(r"[a-z]+")
DIGITS = re.compile(r"\d+")

# fixed: element names of HTML and class words of page furniture
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noembed noframes xmp".split())
BLOCKS = frozenset("address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split())
CONTAINERS = frozenset("html body div section article main td center details".split())
PROSE = frozenset("h1 h2 h3 h4 h5 h6 p blockquote figcaption".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
DROPPED = frozenset("head script style noscript template iframe svg canvas audio video object embed map nav menu footer aside form button select textarea dialog".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar tablist".split())
FURNITURE = frozenset("""nav navbar navigation menu submenu breadcrumb breadcrumbs header masthead topbar footer sidebar ad ads advert adverts
    advertisement advertising adsense sponsor sponsored promo promotion banner notice notices cookie cookies consent gdpr popup modal overlay
    newsletter subscribe signup login share sharing social comment comments disqus respond replies related recommended widget pagination
    pager skip toolbar alert paywall copyright""".split())
COMMENTS = frozenset("comment comments disqus respond replies".split())
QUALIFIERS = frozenset("with has no without".split())
CONTENT = frozenset("article articlebody post content entry story main text".split())
# what a start tag closes, if open, and the elements that shield it
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
          "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}), "body": ({"head"}, set())}
CLOSE_P = BLOCKS - {"br", "option", "tr", "td", "th", "tbody", "thead", "tfoot", "caption", "body", "html"}
SHIELD_P = frozenset("div section article main td th li body html table blockquote aside nav header footer form button".split())
HELD_SPOTS = 100_000  # paths whose votes a task holds
DOUBT = 2.0
BONUS = {"article": 1.3, "main": 1.15, "body": 0.8, "html": 0.6}


def is_furniture(tag: str, attributes: dict[str, str]) -> bool:
    """By element, role or visibility; whatever it holds is left out."""
    if tag in DROPPED:
        return True
    if tag in ("html", "body", "main"):
        return False
    if "hidden" in attributes or attributes.get("aria-hidden") == "true" or attributes.get("role", "") in ROLES:
        return True
    return "style" in attributes and bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", attributes["style"]))


def sounds_like_furniture(tag: str, attributes: dict[str, str]) -> bool:
    """By a word of its class or id.  A first heading is never meant by that."""
    if tag in ("html", "body", "main", "h1"):
        return False
    for name in (attributes.get("class", "") + " " + attributes.get("id", "")).split():
        parts = NAME_PARTS.findall(name)
        if parts and parts[0] not in QUALIFIERS and not FURNITURE.isdisjoint(parts):
            return True
    return False


def may_be_content(attributes: dict[str, str]) -> bool:
    """Whether the class or id also names content, in a word of its own, and no
    reader comments."""
    names = [NAME_PARTS.findall(n) for n in (attributes.get("class", "") + " " + attributes.get("id", "")).split()]
    return any(n and CONTENT.issuperset(n) for n in names) and COMMENTS.isdisjoint(w for n in names for w in n)


class Page:
    """Elements in document order and the text pieces between them.

    An element that sounds like furniture and like content is left out unless it
    holds most of the page's text outside links."""

    def __init__(self, source: str):
        self._read(source, set())
        if self.doubtful:
            held, rest = self._held()
            saved = {node for node, n in held.items() if n > rest - n}
            if saved:  # numbers of elements don't depend on what is left out
                self._read(source, saved)

    def _read(self, source: str, saved: set[int]) -> None:
        self.saved, self.doubtful = saved, []
        self.tag, self.parent, self.path = [""], [0], [""]
        self.out, self.link, self.head = [False], [False], [0]  # left out; in a link; 1 in an inner header, 2 in its headings
        self.container, self.bonus = [0], [1.0]
        self.pieces: list[tuple[int, str]] = []
        self._parse(source)

    def _held(self) -> tuple[dict[int, int], int]:
        """Characters outside links of the doubtful elements, and of the page with
        them."""
        size = [0] * len(self.tag)
        for node, text in self.pieces:
            if not self.link[node]:
                size[node] += len("".join(text.split()))
        doubt = set(self.doubtful)
        for node in range(len(self.tag) - 1, 0, -1):
            if node in doubt or not self.out[node] or self.out[self.parent[node]]:  # not what else is left out
                size[self.parent[node]] += size[node]
        return {node: size[node] for node in self.doubtful}, size[0]

    def _open(self, tag: str, attributes: dict[str, str], up: int) -> int:
        out, head = self.out[up], self.head[up]
        if not out:
            if tag == "header":
                out, head = not self._inside(up), 1
            elif is_furniture(tag, attributes):
                out = True
            elif sounds_like_furniture(tag, attributes):
                out = len(self.tag) not in self.saved
                if out and may_be_content(attributes):
                    self.doubtful.append(len(self.tag))
            elif head == 1 and tag in HEADINGS:
                head = 2
        me = len(self.tag)
        self.tag.append(tag)
        self.parent.append(up)
        self.out.append(out)
        self.head.append(head)
        self.link.append(self.link[up] or tag == "a")
        if tag in CONTAINERS and not out:
            words = sorted(set(attributes.get("class", "").split()))
            self.path.append(self.path[up] + "/" + DIGITS.sub("#", ".".join([tag, *words])))
            self.container.append(me)
            hint = not CONTENT.isdisjoint(NAME_PARTS.findall((attributes.get("class", "") + " " + attributes.get("id", "") + " " + attributes.get("itemprop", "")).lower()))
            self.bonus.append(BONUS.get(tag, 1.0) * (1.15 if hint or attributes.get("role") == "main" else 1.0))
        else:
            self.path.append(self.path[up])
            self.container.append(self.container[up])
            self.bonus.append(1.0)
        return me

    def _inside(self, node: int) -> bool:
        while node:
            if self.tag[node] in ("article", "main"):
                return True
            node = self.parent[node]
        return False

    def _pop(self, stack: list[int], closed, shield) -> None:
        for k in range(len(stack) - 1, 0, -1):
            name = self.tag[stack[k]]
            if name in closed:
                del stack[k:]
                return
            if name in shield:
                return

    def _parse(self, source: str) -> None:
        stack, at = [0], 0
        while True:
            m = TOKEN.search(source, at)
            if (stop := m.start() if m else len(source)) > at:
                self.pieces.append((stack[-1], entities.unescape(source[at:stop])))
            if not m:
                return
            at = m.end()
            tag = (m[2] or m[5] or "").lower()
            if not tag:
                continue
            if tag in BLOCKS:
                self.pieces.append((stack[-1], " "))
            if m[1] or m[4]:
                self._pop(stack, {tag}, SHIELD_P if tag not in SHIELD_P and tag not in BLOCKS else ())
                continue
            if tag in CLOSE_P:
                self._pop(stack, {"p"}, SHIELD_P)
            if tag in CLOSES:
                self._pop(stack, *CLOSES[tag])
            raw = m[3] if m[2] else m[6]
            attributes = {a[1].lower(): entities.unescape(a[2] or a[3] or a[4] or "").lower() for a in ATTRIBUTE.finditer(raw)} if raw.strip(" /") else {}
            me = self._open(tag, attributes, stack[-1])
            if tag in RAW:
                end = re.compile(f"</{tag}", re.I).search(source, at)
                at = end.start() if end else len(source)
            if tag not in VOID and not (raw.endswith("/") and tag in ("svg", "path")):
                stack.append(me)

    def shown(self, node: int) -> bool:
        return not self.out[node] and self.head[node] != 1

    def scores(self) -> dict[str, float]:
        """Score of every container path."""
        own = [0.0] * len(self.tag)
        for node, text in self.pieces:
            if self.shown(node) and not self.link[node]:
                own[self.container[node]] += len(" ".join(text.split()))
        total = Counter()
        for node in range(len(self.tag) - 1, 0, -1):
            if self.container[node] == node:
                if own[node]:
                    total[self.path[node]] += own[node] * self.bonus[node]
                up = self.container[self.parent[node]]
                own[up] += 0.9 * own[node]
        return dict(total)

    def shares(self) -> dict[str, float]:
        """Scores relative to the best one."""
        scores = self.scores()
        best = max(scores.values(), default=1.0)
        return {path: s / best for path, s in scores.items()}

    def whole(self, path: str) -> set[int]:
        """The containers of a path, each climbed to the one that holds its whole article."""
        size, prose = [0] * len(self.tag), [0] * len(self.tag)  # shown characters; those of headings and paragraphs outside links
        plain = [False] * len(self.tag)
        for node in range(1, len(self.tag)):
            plain[node] = self.tag[node] in PROSE or plain[self.parent[node]] and self.container[node] != node
        for node, text in self.pieces:
            if self.shown(node) and (n := len("".join(text.split()))):
                size[node] += n
                prose[node] += n if plain[node] and not self.link[node] else 0
        for node in range(len(self.tag) - 1, 0, -1):
            size[self.parent[node]] += size[node]
            prose[self.parent[node]] += prose[node]
        out: set[int] = set()
        seen: dict[int, int] = {}
        for first in range(1, len(self.tag)):
            if self.container[first] == first and self.path[first] == path:
                trail, at, top = [], first, None
                while at and at not in seen:  # the nearest article or main
                    trail.append(at)
                    if self.tag[at] in ("article", "main"):
                        top = at
                        break
                    at = self.container[self.parent[at]]
                top = seen[at] if at and top is None else top or 0
                seen.update(dict.fromkeys(trail, top))
                if not top:
                    top, up = first, self.container[self.parent[first]]
                    while up and self.tag[up] not in ("html", "body"):
                        more = size[up] - size[top]
                        if more != prose[up] - prose[top] or more >= size[top]:
                            break
                        top, up = up, self.container[self.parent[up]]
                out.add(top)
        return out

    def text(self, path: str | None) -> str:
        """Text of the article around the containers of a path (None: of the whole page)."""
        inside, tops = [path is None] * len(self.tag), set() if path is None else self.whole(path)
        for node in range(1, len(self.tag)):
            inside[node] = inside[self.parent[node]] or node in tops
        return " ".join("".join(t for node, t in self.pieces if t == " " or inside[node] and self.shown(node)).split())


def host_of(url: Column) -> Column:
    """Lower-case host of an absolute URL, else the empty string."""
    bare = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.lower(F.coalesce(bare, F.lit("")))


def spot_of(host: str, path: str) -> int:
    """64-bit name of a path of a host."""
    return int.from_bytes(hashlib.blake2b(f"{host}\n{path}".encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def votes(pages: DataFrame) -> DataFrame:
    """(spot, votes, n) of all pages (host, html): n pages of the host have the path."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = Counter(), Counter()
        for batch in batches:
            for host, source in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
                for path, share in Page(source).shares().items():
                    spot = spot_of(host, path)
                    total[spot] += share
                    n[spot] += 1
            if len(total) > HELD_SPOTS:
                yield told(total, n)
                total.clear()
                n.clear()
        if total:
            yield told(total, n)

    def told(total: Counter, n: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array(list(total.values()), pa.float64()), pa.array([n[k] for k in total], pa.int64())], names=["spot", "votes", "n"])

    return pages.select("host", "html").mapInArrow(run, "spot long, votes double, n long").groupBy("spot").agg(F.sum("votes").alias("votes"), F.sum("n").alias("n"))


def ballots(pages: DataFrame) -> DataFrame:
    """(page, spot, share) of every container path of every page (page, host, html)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, spots, shares = [], [], []
            for i, (host, source) in enumerate(zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True)):
                for path, share in Page(source).shares().items():
                    at.append(i)
                    spots.append(spot_of(host, path))
                    shares.append(share)
            yield pa.RecordBatch.from_arrays([batch.column("page").take(pa.array(at, pa.int64())), pa.array(spots, pa.int64()), pa.array(shares, pa.float64())], names=["page", "spot", "share"])

    return pages.select("page", "host", "html").mapInArrow(run, "page binary, spot long, share double")


def extract(pages: DataFrame, id_col: str = "page_id") -> DataFrame:
    """One row per page: page_id, url, path, text."""
    html = F.coalesce("html", F.lit(""))
    keyed = pages.select(pages[id_col].alias("page_id"), "url", html.alias("html"), host_of(F.col("url")).alias("host"))
    keyed = keyed.withColumn("page", F.unhex(F.md5(F.concat_ws("\n", "host", "html"))))
    # each path's row meets its votes, each page the path that won: hosts and repeated
    # pages of any size are dealt by row, and no host's paths come together
    agreed = votes(keyed).where("n > 1").withColumn("pages", F.col("n"))
    known = join_groups(ballots(keyed), agreed, "spot", "pages")
    worth = F.coalesce(F.col("votes"), F.col("share")) / (F.coalesce(F.col("n"), F.lit(1)) + F.lit(DOUBT))
    won = known.groupBy("page").agg(F.max_by("spot", F.struct(worth, "share", "spot")).alias("won"), F.count("*").alias("rows"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths, texts = [], []
            for host, source, spot in zip(*(batch.column(c).to_pylist() for c in ("host", "html", "won")), strict=True):
                page = Page(source)
                paths.append(next((p for p in dict.fromkeys(page.path) if p and spot_of(host, p) == spot), None))
                texts.append(page.text(paths[-1]))
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(paths, pa.string()), pa.array(texts, pa.string())], names=["page_id", "url", "path", "text"])

    found = join_groups(keyed, won, "page", "rows")
    return found.select("page_id", "url", "host", "html", "won").mapInArrow(run, "page_id long, url string, path string, text string")
