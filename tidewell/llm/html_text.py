"""Main text of web pages by two-pass block rules.

A page is cut into blocks at its block elements. First pass, each block by itself: text with
enough stop words and length is main text; text that is mostly links, or stands in an element
that the page marks as menu, footer, advert, form, comment or the like, is not; what is too short
or has too few stop words to tell is left open. Second pass: an open block takes the label of its
nearest decided neighbours, before or after it. Nearness is first the number of elements to leave
and enter on the way, then the number of blocks between, and a tie is main text. If the first pass
finds no main text on a page, the open blocks of the element that directly holds most of their text
are. An element that only its name puts outside, but that holds most of the page's main text, is not
outside, unless the name is that of comments. A page that marks
its main part (article, main) is read there alone: blocks outside are no main text, and open
blocks inside take labels from inside; if none is decided there, they are main text.

Cases: null, empty and markup-only pages give an empty text; pages of any length are read whole;
unclosed elements, comments and quotes end where browsers end them, or with the page; repeated
rows are kept; other columns are not carried over.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame

from tidewell.llm.text import pieces

# Frequent function words of the languages served.
STOP_WORDS = frozenset(
    """
    a an and are as at be been but by can did do for from had has have he her his i if in is it its not of on
    or our she so that the their them there they this to was we were what when which who will with would you your
    aber als am an auch auf aus bei bin bis das dass dem den der des die du ein eine einem einen einer er es für
    hat ich ihr im in ist ja kein mit nach nicht noch nur oder sein sich sie sind so und uns vom von vor war was
    wenn wie wir zu zum zur über
    a ai au aux avec ce ces cette dans de des du elle en est et eu il ils je la le les leur lui mais me ne nous on
    ont ou où par pas plus pour qu que qui sa se ses son sont sur un une vous à
    al como con de del desde donde el ella en entre era es esta este ha hay la las le lo los más me mi muy no nos o
    para pero por porque que se ser si sin sobre son su sus también un una uno y ya
    """.split()
)

# Words of class and id names that mark a part outside the main text.
HINTS = frozenset(
    """
    ad ads adv advert adverts advertisement advertising banner bottombar breadcrumb breadcrumbs comment comments
    consent cookie cookies copyright disclaimer discussion disqus dropdown feedback footer form gdpr header hidden
    legal login masthead menu menubar modal nav navbar navigation newsletter notice notices notification overlay pager
    paginate pagination popup promo promoted promotion recommendations recommended related reply replies respond
    responses search share sharing sidebar signin signup social sponsor sponsored subscribe subscription tags toolbar
    topbar trending widget widgets
    """.split()
)
#: Of these, those that a name never has for another reason than what the part is.
FIRM = frozenset("comment comments discussion disqus replies reply respond responses".split())
#: A name with one of these says what stands around or beside the part, not what it is.
ABOUT = frozenset("has with without no not overflow".split())
#: A header is the site's, not a text's, if its name has no other word than these.
SITE = frozenset("bar container global header inner main nav site sticky top wrapper".split())
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search status".split())
OUTSIDE = frozenset("aside button dialog footer form menu nav option select head label legend fieldset datalist".split())
BLOCKS = frozenset(
    """
    address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption
    figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup
    option p pre search section select summary table tbody td tfoot th thead title tr ul
    """.split()
)
VOID = frozenset("hr".split())
#: An opening tag of these ends an open one of the same row.
CLOSES = {
    "p": frozenset({"p"}),
    "li": frozenset({"li", "p"}),
    "dt": frozenset({"dt", "dd", "p"}),
    "dd": frozenset({"dt", "dd", "p"}),
    "tr": frozenset({"tr", "td", "th", "p"}),
    "td": frozenset({"td", "th", "p"}),
    "th": frozenset({"td", "th", "p"}),
    "option": frozenset({"option"}),
}

LONG, MEDIUM, LINKED = 160, 60, 0.4
DENSE, MILD = 0.3, 0.2

_TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)"
    r"|<(?:svg|math)(?=[\s/])[^>]*/>"
    r"|<(?P<raw>script|style|noscript|template|svg|math|textarea|iframe|object|canvas|noframes|title)(?=[\s/>])[^>]*>.*?(?:</(?P=raw)(?=[\s/>])[^>]*>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*+)(?:>|\Z)",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"([^\s=>\"'/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_NAME_PART = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
_WORD = re.compile(r"[^\W\d_]+")


@dataclass
class Element:
    name: str
    number: int
    outside: bool
    main: int  # the number of the main part it is in, or 0
    doubtful: tuple[int, ...] = ()  # elements around it that only their names put outside


@dataclass
class Block:
    path: tuple[int, ...]
    outside: bool
    main: int
    doubtful: tuple[int, ...]
    title: bool
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    label: bool | None = None


def _marks(name: str, rest: str, in_main: bool) -> tuple[bool, bool, bool]:
    """Whether an opening tag says that its content is outside the main text, does so by a mere name, or is the main part."""
    doubtful = False
    outside, main = name in OUTSIDE or (name == "header" and not in_main), name in ("article", "main")
    if not rest or rest.isspace():
        return outside, False, main and not outside
    for m in _ATTRIBUTE.finditer(rest):
        key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        low = value.lower().strip()
        if key in ("class", "id") and name not in ("html", "body", "main"):
            for one in value.split():
                parts = {p.lower() for p in _NAME_PART.findall(one)}
                found = HINTS & parts
                if "header" in found and (in_main or not parts <= SITE):
                    found = found - {"header"}
                if name == "article":
                    found = found & {"comment", "comments", "reply", "replies"}
                if found and not parts & ABOUT:
                    outside |= bool(found & FIRM)
                    doubtful = True
        elif key == "role":
            outside |= low in ROLES
            main |= low in ("main", "article")
        elif key == "itemprop":
            main |= low == "articlebody"
        elif key == "hidden" or (key == "aria-hidden" and low == "true"):
            outside = True
        elif key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", low):
            outside = True
    return outside, doubtful and not outside, main and not outside and not doubtful


def blocks_of(page: str) -> list[Block]:
    """The page's blocks with text, in order."""
    out: list[Block] = []
    stack: list[Element] = [Element("", 0, False, 0)]
    numbers, mains, at, linked = 0, 0, 0, False
    block: Block | None = None

    def add(raw: str) -> None:
        nonlocal block
        if not raw:
            return
        text = html.unescape(raw) if "&" in raw else raw
        if block is None:
            if text.isspace():
                return
            top = stack[-1]
            block = Block(tuple(e.number for e in stack), top.outside, top.main, top.doubtful, top.name == "h1")
            out.append(block)
        block.parts.append(text)
        if linked:
            block.linked += len("".join(text.split()))

    for m in _TOKEN.finditer(page):
        add(page[at : m.start()])
        at = m.end()
        name = m["name"]
        if name is None:
            if m[0].startswith("<![CDATA["):
                add(html.escape(m[0][9:].removesuffix("]]>")))
            continue
        name = name.lower()
        if name == "a":
            linked = not m["end"]
        elif name == "br":
            add(" ")
        elif name in BLOCKS:
            block, linked = None, False
            if m["end"]:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].name == name:
                        del stack[i:]
                        break
                continue
            if name in VOID:
                continue
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].name in CLOSES.get(name, ("p",)):
                    del stack[i:]
                    break
                if stack[i].name != "p" and name not in ("td", "th", "tr", "dt", "dd", "li") or stack[i].name in ("table", "ul", "ol", "dl"):
                    break
            top = stack[-1]
            outside, by_name, main = _marks(name, m["rest"], bool(top.main))
            numbers += 1
            main = main and not top.outside and not top.doubtful
            if main and not top.main:
                mains += 1
            doubtful = (*top.doubtful, numbers) if by_name else top.doubtful
            stack.append(Element(name, numbers, top.outside or outside, top.main or (mains if main else 0), doubtful))
    add(page[at:])
    return out


def _decide(block: Block, text: str) -> bool | None:
    """The first pass: main text, not main text, or open."""
    size = len(text)
    if block.outside:
        return False
    if block.linked > LINKED * len("".join(text.split())):
        return None if block.title and block.main else False
    if size < MEDIUM:
        return None
    words = _WORD.findall(text.lower())
    share = sum(w in STOP_WORDS for w in words) / max(1, len(words))
    if share >= (MILD if size >= LONG else DENSE):
        return True
    return None


def _near(a: Block, b: Block) -> int:
    """Elements to leave and to enter on the way from one block to the other."""
    same = 0
    for x, y in zip(a.path, b.path):
        if x != y:
            break
        same += 1
    return len(a.path) + len(b.path) - 2 * same


def _inherit(blocks: list[Block], default: bool) -> None:
    """The second pass over blocks that may take labels from each other."""
    decided = [b.label is not None for b in blocks]
    before, after = [-1] * len(blocks), [-1] * len(blocks)
    for i in range(1, len(blocks)):
        before[i] = i - 1 if decided[i - 1] else before[i - 1]
    for i in range(len(blocks) - 2, -1, -1):
        after[i] = i + 1 if decided[i + 1] else after[i + 1]
    for i, b in enumerate(blocks):
        if not decided[i]:
            found = [(_near(b, blocks[j]), abs(j - i), not blocks[j].label) for j in (before[i], after[i]) if j >= 0]
            b.label = not min(found)[2] if found else default


def _believe_names(kept: list[tuple[Block, str]]) -> None:
    """Put elements outside that only their names put there, but those that hold most of the main text."""
    told = [(b, len(t)) for b, t in kept if b.label]
    for b, _ in kept:
        for number in b.doubtful:
            if 2 * sum(n for x, n in told if number in x.doubtful) <= sum(n for _, n in told):
                b.outside, b.label = True, False


def _largest_part(blocks: list[Block], sizes: list[int]) -> None:
    """On a page where nothing told itself main text, the open blocks of the element that directly holds most of them are."""
    held: dict[tuple[int, ...], int] = {}
    for b, size in zip(blocks, sizes):
        if b.label is None:
            held[b.path[:-1]] = held.get(b.path[:-1], 0) + size
    for b in blocks:
        if b.label is None and b.path[:-1] == max(held, key=held.__getitem__):
            b.label = True


def main_text(page: str | None) -> str:
    """The blocks of main text, white space in each turned into one space, one line each."""
    if not page:
        return ""
    blocks = blocks_of(page)
    texts = [" ".join("".join(b.parts).split()) for b in blocks]
    kept = [(b, t) for b, t in zip(blocks, texts) if t]
    for b, t in kept:
        b.label = _decide(b, t)
    _believe_names(kept)
    parts: dict[int, list[Block]] = {}
    for b, _ in kept:
        parts.setdefault(b.main, []).append(b)
    marked = any(m and any(b.label is not False for b in bs) for m, bs in parts.items())
    for m, bs in parts.items():
        if m:
            _inherit([b for b in bs if not b.outside], default=True)
        elif marked:
            for b in bs:
                b.label = False
        else:
            if not any(b.label for b in bs):
                _largest_part(bs, [len(t) for b, t in kept if not b.main])
            _inherit(bs, default=True)
    return "\n".join(t for b, t in kept if b.label)


def extract(pages: DataFrame, *, key: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """(key, url, text, n_chars) of every row. No shuffle; a task holds one piece of its rows at a time."""
    kinds = {c: pages.schema[c].dataType.simpleString() for c in (key, url)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, page):
                texts = [main_text(p) for p in part.column(page).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(key), part.column(url), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                    names=[key, url, "text", "n_chars"],
                )

    schema = f"{key} {kinds[key]}, {url} {kinds[url]}, text string, n_chars long"
    return pages.select(key, url, page).mapInArrow(run, schema)
