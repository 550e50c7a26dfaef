"""Main text of web pages by deducing the template that pages of a host share.

Pages of one host are read in groups of at most GROUP pages. Each page becomes a row of tokens:
tags with the path of containers they stand in, and every word of text with its path. Tokens that
occur equally often in every page of the group (equal occurrence vectors) form an equivalence
class. The class that occurs once per page, less those tokens whose order differs between pages,
is the root of the template; a class that occurs n times per page nests in the one root slot that
holds all its occurrences, if its tokens alternate there in one order, and is a repeated part of
it. What stands between two root tokens is a slot, and slots are what is judged and extracted:

* Text that is made of root tokens alone, and a block of text that every page has, are template and
  no slot's, whatever the markup calls it: site titles, notices, an author's box. A block of text that differs in part between pages is
  content of the slot that its differing words stand in, and stays whole.
* A slot has the container that most of its text stands in, its amount of unlinked text over all
  pages of the group, and its share of links. A repeated part of links is a menu. The article is
  in the container that holds most text of slots; names are a prior that weighs it (MAIN and
  MAIN_NAMES for, FURNITURE and NAMES against). If an element named as main stands around it, all
  of that is meant; else a differing h1 before it belongs to it too.
* Slots outside it are not extracted, nor are those within it that stand in a furniture container,
  unless that container is around the heaviest one. Only a container is furniture by its name, and
  only if all parts of the name say so (comments, ad-slot, but not social-science).

Pages without an element named as main, and pages that lack the container, are judged among
themselves, so a page whose container is empty has no text while other layouts keep theirs. Classes in paths count only if several of the
pages have them; digits in them are one. If the differing rests of pages hold less text than what they
share, the pages are copies of one article: then, and on a page alone, the template is of tags
only, as no words tell the page's own from the host's.

A host with more than 1/1000 of all pages is dealt by page_id.

Defined cases: null or empty html gives an empty text; null urls count as one host; broken markup
is read as far as it goes (an unclosed script, style or comment takes the rest); very long pages
are read whole; repeated rows give a row each; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.scratch import HOT_SHARE, parts, small_batches

GROUP = 48
#: A slot whose text is mostly links is a menu.
LINKED = 0.5
#: A class is part of a path if one in so many pages has it.
USUAL = 8
#: What text weighs in a container that is named as main, and in one that is named as furniture.
FOR, AGAINST = 4.0, 0.05

# Element names of the HTML standard, and words that name page furniture in class or id.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe svg math object select canvas audio video".split())
FOREIGN = frozenset("svg math".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr br img".split())
FURNITURE = frozenset("nav footer aside form menu button head dialog fieldset".split())
MAIN = frozenset("article main".split())
TEXTUAL = frozenset("h1 h2 h3 h4 h5 h6 blockquote pre td th li dt dd figcaption".split())
NAMES = frozenset(
    "ad ads adv advert advertisement advertising adsense sponsor sponsored promo promotion banner menu nav navbar navigation topnav breadcrumb breadcrumbs sidebar sidenav widget widgets "
    "footer masthead notice notices cookie cookies consent gdpr newsletter subscribe signup login search social share sharing comment comments disqus replies popup modal overlay related pagination pager".split()
)
#: Parts of a name that say nothing of their own.
GENERIC = frozenset("site page main top bottom left right inner outer box bar area list block section container wrapper wrap slot unit panel group item items content form links link buttons button posts post text message row col widget module and the reader readers user users bottombar thread".split())
MAIN_NAMES = frozenset("article articlebody main maincontent entrycontent postcontent postbody".split())
#: An open element of the same kind ends where one of these starts.
ENDS = {"p": frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl table div section article aside header footer nav form blockquote pre hr main figure address fieldset".split()), "li": frozenset(["li"]), "dt": frozenset("dt dd".split()), "dd": frozenset("dt dd".split()), "tr": frozenset(["tr"]), "td": frozenset("td th tr".split()), "th": frozenset("td th tr".split()), "option": frozenset(["option"])}

#: A comment, a tag with its attributes (a value may be quoted, unquoted or missing) or a declaration.
_MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?>[^=>]+|=\s*(?:\"[^\"]*\"|'[^']*'|[^\s\"'>][^\s>]*)?)*)>|<[!?][^>]*>", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]*))?")
_PARTS = re.compile(r"[^a-z0-9]+|(?<=[a-z])(?=[0-9])")
_DIGITS = re.compile(r"[0-9]+")


class Node:
    """An open element: its name and class, the element around it, and what its names say."""

    __slots__ = ("tag", "kind", "up", "link", "furniture", "main", "key", "out", "within")

    def __init__(self, tag: str, kind: str, up: Node | None, furniture: bool, main: bool):
        self.tag, self.kind, self.up, self.furniture, self.main = tag, kind, up, furniture, main
        self.link: bool = tag == "a" or up is not None and up.link
        self.out: bool = furniture or up is not None and up.out  # in furniture
        self.within: bool = main or up is not None and up.within  # in what is named as main
        self.key = ""  # the path, set when the group's classes are known


def _names(attributes: str) -> tuple[bool, bool, bool, str]:
    """Whether the names say furniture, main, hidden; and the class for the path."""
    out = main = hidden = False
    kind = ""
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "hidden" or name == "aria-hidden" and value == "true":
            hidden = True
        elif name in ("class", "id", "role", "itemprop"):
            for word in value.split():
                split = [x for x in _PARTS.split(word) if x and not x.isdigit()]
                main |= "".join(split) in MAIN_NAMES
                out |= bool(NAMES.intersection(split)) and all(x in NAMES or x in GENERIC for x in split)
            if name == "class":
                kind = ".".join(_DIGITS.sub("0", value).split()[:2])
    return out, main, hidden, kind


class Page:
    """Tags and texts of a page in order: (node, None) where a tag opens or closes, (node, text) with the text's block."""

    def __init__(self, source: str | None):
        self.steps: list[tuple[str, Node, str, int]] = []  # (tag token or "", node, text, block)
        self.nodes: list[Node] = []
        source = source or ""
        root = Node("", "", None, False, False)
        stack = [root]
        self.nodes.append(root)
        at, block, end = 0, 0, len(source)
        last = source.rfind(">")  # no tag begins after it
        while at < end:
            m = _MARKUP.search(source, at) if at <= last else None
            if (stop := m.start() if m else end) > at:
                self.steps.append(("", stack[-1], entities.unescape(source[at:stop]), block))
            if not m:
                break
            at = m.end()
            tag = m[2]
            if not tag:
                continue
            tag, closed = tag.lower(), m[3].endswith("/")
            if m[1]:
                if any(n.tag == tag for n in stack):
                    while stack.pop().tag != tag:
                        pass
                    stack = stack or [root]
                self.steps.append((f"/{tag}", stack[-1], "", block))
            else:
                if tag in RAW and not (closed and tag in FOREIGN):
                    close = re.compile(rf"</{tag}\s*>", re.I).search(source, at)
                    at = close.end() if close else end
                    continue
                if tag not in INLINE:
                    # a paragraph or item that this element ends, with what inline elements left open
                    open_ = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag not in INLINE), 0)
                    if tag in ENDS.get(stack[open_].tag, ()):
                        del stack[open_:]
                top = stack[-1]
                out, main, hidden, kind = _names(m[3]) if m[3].strip() else (False, False, False, "")
                container = tag not in INLINE and tag not in TEXTUAL
                furniture = hidden or tag in FURNITURE or container and out or tag == "header" and not top.within
                node = Node(tag, kind, top, furniture, container and (tag in MAIN or main))
                self.nodes.append(node)
                self.steps.append((tag, node, "", block))
                if tag not in VOID and not closed:
                    stack.append(node)
                elif tag == "br":
                    self.steps.append(("", top, " ", block))
            if tag not in INLINE:
                block += 1

    def place(self, usual: set[tuple[str, str]]) -> None:
        """Give every element its path, with the classes that are usual."""
        for n in self.nodes:
            if n.up is None or n.tag in INLINE:
                n.key = n.up.key if n.up else ""
            else:
                n.key = f"{n.up.key}>{n.tag}.{n.kind}" if n.kind and (n.tag, n.kind) in usual else f"{n.up.key}>{n.tag}"

    def tokens(self, words: bool) -> list[list[str]]:
        """The keys of each step: of its tag, or with ``words`` of its words."""
        return [[f"{tag}|{node.key}"] if tag else [f"'{w}|{node.key}" for w in text.split()] if words else [] for tag, node, text, _ in self.steps]


class Template:
    """Root tokens, repeated parts and slots that a group of pages shares."""

    def __init__(self, pages: list[Page], words: bool = True):
        self.words = words and len(pages) > 1
        self.steps = [p.tokens(self.words) for p in pages]
        self.tokens = [list(chain.from_iterable(x)) for x in self.steps]
        counts = [Counter(t) for t in self.tokens]
        common = set(counts[0]).intersection(*counts[1:])
        classes: dict[tuple[int, ...], list[str]] = defaultdict(list)
        for t in common:
            classes[tuple(c[t] for c in counts)].append(t)
        root = set(classes.pop((1,) * len(pages), ()))
        orders = [[t for t in ts if t in root] for ts in self.tokens]
        rank = {t: i for i, t in enumerate(orders[0])}
        for order in orders[1:]:  # keep the longest run of tokens that ascends in every page
            root = set(_ascending([t for t in order if t in root], rank))
        self.root = [t for t in orders[0] if t in root]
        self.number = {t: i + 1 for i, t in enumerate(self.root)}
        self.set = frozenset(self.root)
        self.repeated = self._nested(classes)

    def _nested(self, classes: dict[tuple[int, ...], list[str]]) -> set[int]:
        """Slots that hold a valid repeated class: all its occurrences, in one alternating order."""
        found: set[int] = set()
        own = {t: v for v, ts in classes.items() if len(ts) > 1 for t in ts}
        seen: dict[str, set[int]] = defaultdict(set)
        runs: dict[tuple[int, ...], list[list[str]]] = defaultdict(list)
        for tokens in self.tokens:
            slot, run = 0, defaultdict(list)
            for t in tokens:
                slot = self.number.get(t, slot)
                if (v := own.get(t)) is not None:
                    seen[t].add(slot)
                    run[v].append(t)
            for v, ts in run.items():
                runs[v].append(ts)
        for v, lists in runs.items():
            n = len(classes[v])
            slots = set().union(*(seen[t] for t in classes[v]))
            if len(slots) == 1 and all(ts == ts[:n] * (len(ts) // n) for ts in lists):
                found |= slots
        return found

    def placed(self, page: int, steps: list[tuple[str, Node, str, int]]) -> list[tuple[Node, str, int, Counter[int]]]:
        """(element, text, block, characters of words in each slot) of a page's texts; root words are in no slot."""
        out, slot, number = [], 0, self.number
        for (tag, node, text, block), keys in zip(steps, self.steps[page]):
            if tag:
                slot = number.get(keys[0], slot)
            elif self.words and not self.set.isdisjoint(keys):
                own: Counter[int] = Counter()
                for k in keys:
                    if k in number:
                        slot = number[k]
                    else:
                        own[slot] += len(k) - len(node.key) - 2
                out.append((node, text, block, own))
            else:
                out.append((node, text, block, Counter({slot: n}) if (n := sum(map(len, text.split()))) else Counter()))
        return out


def _ascending(order: list[str], rank: dict[str, int]) -> list[str]:
    """The longest subsequence of order whose ranks ascend."""
    import bisect

    tails: list[int] = []
    last: list[int] = []
    back: list[int] = []
    for i, t in enumerate(order):
        k = bisect.bisect_left(tails, rank[t])
        if k == len(tails):
            tails.append(rank[t])
            last.append(i)
        else:
            tails[k], last[k] = rank[t], i
        back.append(last[k - 1] if k else -1)
    out, i = [], last[-1] if last else -1
    while i >= 0:
        out.append(order[i])
        i = back[i]
    return out[::-1]


class Slot:
    """Characters that a slot holds over all pages, and how many of them are linked."""

    __slots__ = ("mass", "linked")

    def __init__(self) -> None:
        self.mass, self.linked = 0, 0


def _holder(node: Node) -> Node:
    """The container of an element's text: what stands around its paragraph."""
    while node.tag in INLINE and node.up is not None:
        node = node.up
    return node.up if node.up is not None else node


def _above(node: Node | None) -> Iterator[Node]:
    while node is not None:
        yield node
        node = node.up


def _weight(node: Node) -> float:
    return (FOR if node.within else 1.0) * (AGAINST if node.out else 1.0)


def _copies(placed: list[list[tuple[Node, str, int, Counter[int]]]]) -> bool:
    """Whether the pages share more of their unlinked text than their different rests hold."""
    rests: dict[str, int] = {}
    shared = 0
    for texts in placed:
        rest: list[str] = []
        same = 0
        for node, text, _, own in texts:
            if node.link or node.out:
                continue
            n = sum(own.values())
            same += sum(map(len, text.split())) - n
            if n:
                rest.append(text)
        rests["".join(rest)] = sum(map(len, rest))
        shared = max(shared, same)
    return len(rests) == 1 or sum(rests.values()) <= shared


def _judged(pages: list[Page]) -> Iterator[tuple[int, str]]:
    """(number, text) of the pages that hold the container which these pages' slots point at."""
    seen: Counter[tuple[str, str]] = Counter()
    for p in pages:
        seen.update({(n.tag, n.kind) for n in p.nodes if n.kind})
    usual = {k for k, n in seen.items() if n >= min(2, len(pages)) and USUAL * n >= len(pages)}
    for p in pages:
        p.place(usual)
    template = Template(pages)
    placed = [template.placed(i, p.steps) for i, p in enumerate(pages)]
    if template.words and _copies(placed):
        template = Template(pages, words=False)
        placed = [template.placed(i, p.steps) for i, p in enumerate(pages)]

    slots: dict[int, Slot] = defaultdict(Slot)
    for texts in placed:
        for node, _, _, own in texts:
            for k, n in own.items():
                slots[k].mass += n
                slots[k].linked += n * node.link
    menus = {k for k in template.repeated if slots[k].linked > LINKED * slots[k].mass}
    amount: Counter[str] = Counter()
    holder: dict[str, Node] = {}
    for texts in placed:
        for node, _, _, own in texts:
            n = sum(x for k, x in own.items() if k not in menus)
            if n and not node.link and node.up is not None:
                h = _holder(node)
                holder.setdefault(h.key, h)
                amount[h.key] += n * _weight(h)
    if not amount:  # nothing but template or links
        yield from ((i, "") for i in range(len(pages)))
        return
    heaviest = max(amount, key=lambda k: (amount[k], k))
    spared = {n.key for n in _above(holder[heaviest])}
    home = next((n for n in _above(holder[heaviest]) if n.main), holder[heaviest])
    within = f"{home.key}>"

    def wanted(node: Node) -> bool:
        if not f"{_block(node).key}>".startswith(within):
            return False
        return not node.out or not any(n.furniture and n.key not in spared for n in _above(node))

    out: dict[int, dict[int, str]] = {}
    for i, (p, texts) in enumerate(zip(pages, placed)):
        if not any(n.key == home.key for n in p.nodes):
            continue
        blocks: dict[int, list[str]] = defaultdict(list)
        own: set[int] = set()  # blocks with words of a slot
        begun = False
        for node, text, block, words in texts:
            begun |= f"{node.key}>".startswith(within)
            title = not home.main and not begun and _block(node).tag == "h1" and home.key.startswith(_block(node).up.key) and not any(n.furniture and n.key not in spared for n in _above(node))
            if title or wanted(node):
                blocks[block].append(text)
                if any(k not in menus for k in words):
                    own.add(block)
        out[i] = {b: x for b, x in ((b, " ".join("".join(t).split())) for b, t in blocks.items() if b in own) if x}
    held = [set(x.values()) for x in out.values() if x]
    every = set.intersection(*held) if template.words and len(held) > 1 else set()
    if sum(map(len, {"".join(sorted(x - every)) for x in held})) <= sum(map(len, every)):
        every = set()  # copies of one article
    for i, blocks in out.items():
        yield i, "\n\n".join(x for x in blocks.values() if x not in every)


def _block(node: Node) -> Node:
    while node.tag in INLINE and node.up is not None:
        node = node.up
    return node


def main_texts(sources: list[str | None]) -> list[str]:
    """The main text of each page of a group that shares a host."""
    pages = [Page(s) for s in sources]
    out = [""] * len(pages)
    some = [i for i, p in enumerate(pages) if any(text.strip() for tag, _, text, _ in p.steps if not tag)]
    named = {i for i in some if any(n.main and not n.out for n in pages[i].nodes)}
    # a main container without text is an empty article
    filled = [i for i in some if i in named and any(node.within and text.strip() for tag, node, text, _ in pages[i].steps if not tag)]
    for left in (filled, [i for i in some if i not in named]):
        while left:
            found = dict(_judged([pages[i] for i in left]))
            for k, text in found.items():
                out[left[k]] = text
            left = [i for k, i in enumerate(left) if k not in found]
    return out


def extract(pages: DataFrame, ident: str = "page_id", url: str = "url", html: str = "html", group: int = GROUP) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page."""
    spark = pages.sparkSession
    small_batches(spark)
    host = F.lower(F.regexp_extract(F.coalesce(F.col(url).cast("string"), F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.\-]*://([^/?#]*)", 1))
    base = pages.select(F.col(ident).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.col(html).cast("string").alias("html")).withColumn("host", host)
    total = base.count()
    share = max(1.0, total / HOT_SHARE)
    # hosts above that share number HOT_SHARE at most
    crowded = base.groupBy("host").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > F.lit(max(share, group))).select("host", F.ceil(F.col("n") / F.lit(max(share, group))).alias("deals"))
    rows = base.join(F.broadcast(crowded), "host", "left")
    rows = rows.withColumn("deal", F.pmod(F.xxhash64("page_id", "url"), F.coalesce("deals", F.lit(1).cast("long"))))
    rows = rows.select("page_id", "url", "html", "host", "deal").repartition(parts(spark), "host", "deal").sortWithinPartitions("host", "deal", "page_id", "url", "html")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, str, str | None]] = []
        now = None

        def flush() -> pa.RecordBatch:
            texts = main_texts([h for *_, h in held])
            cols = [pa.array([i for i, *_ in held], pa.int64()), pa.array([u for _, u, _ in held], pa.string()), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            held.clear()
            return pa.RecordBatch.from_arrays(cols, ["page_id", "url", "text", "n_chars"])

        for batch in batches:
            for i, u, h, *key in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html", "host", "deal"))):
                if held and (key != now or len(held) >= group):
                    yield flush()
                now = key
                held.append((i, u, h))
        if held:
            yield flush()

    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")


def op1_html_text(spark, sf_dir: str) -> DataFrame:
    """All ``pages``: a row for each, null html as empty text; an empty table gives none."""
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
