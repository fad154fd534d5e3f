"""HTML extraction by wrapper inference: a union-free regular expression of a host's pages.

A page is a stream of tags and texts. Each distinct tag is one symbol and each text a slot, so a page is a short
string and a wrapper a regular expression over it, without alternatives: symbols, slots, ``(...)+`` for what repeats
and ``(...)?`` for what some pages lack.

* Within a page, tandem repeats (``<li><a>text</a></li>`` over and over) become repeated groups, inner ones first.
* All pages of a host are folded in. Pages of one shape count once; shapes are folded one by one in blocks, and the
  wrappers of the blocks are joined in a tree. Where both sides agree, symbols stay. A mismatch beside a known repeated
  group is tried as one more turn of it; any other becomes an optional group.
* What the pages of a host say in the same words behind the same tag on most of them is template, not content.
  Where no page part is called an article, such slots are emptied before the main region is looked for, whatever the
  classes of their containers are called.
* The main region is the part of the wrapper between the tags of the container that holds the article: ``<article>``
  or ``<main>``, or else the smallest container with nearly all text outside menus, headers, footers and the like.

A page that its host's wrapper matches is cut by it; any other page (cut off, say, or alone on its host) is read by
the same rule for containers on its own stream. Blocks of furniture inside the main region are left out either way.
"""

from __future__ import annotations

import difflib
import html as entities
import json
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from hashlib import blake2b

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from padron.llm.common import stored, texts

#: Shapes of a host that one task folds one by one, and wrappers that are joined at a time.
BLOCK = 16
#: Longest unit of a repeated group, in symbols; in longer strings very frequent symbols do not begin an alignment.
UNIT, LONGEST = 24, 4000
MAIN_SHARE = 0.6
#: The same where template texts have been emptied: what is left is nearly all content.
EMPTIED_SHARE = 0.8
#: A text is template if so many different pages of its host, and such a share of them, have it behind the same tag.
TEMPLATE_PAGES, TEMPLATE_SHARE = 4, 0.6

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|textarea|svg|iframe|title)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|[^<]+|<",
    re.S | re.I,
)
NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
HIDDEN = re.compile(r"\b(?:hidden\b|aria-hidden\s*=\s*[\"']?true|style\s*=\s*[\"'][^\"']*display\s*:\s*none)", re.I)

#: Elements that do not break a block of text.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub"
    " sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that are furniture, wherever they stand.
FURNITURE = frozenset("nav aside form footer menu dialog button select fieldset head".split())
#: Words in class, id or role that mark a container as furniture.
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertisements adsense banner banners promo promos promotion sponsor sponsored sponsors"
    " sidebar sidebars aside menu menus nav navbar navigation breadcrumb breadcrumbs footer cookie cookies consent"
    " gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login search share sharing social related"
    " recommended recommendations widget widgets toolbar pagination pager comment comments commentary disqus reply replies respond"
    " discussion complementary contentinfo".split()
)
#: Marks of page headers, which inside an article hold its title; and of what readers wrote.
HEADERS = frozenset(["header", "masthead", "topbar"])
READERS = frozenset("comment comments reply replies respond discussion".split())
MAIN = frozenset(["article", "main"])
CONTAINERS = frozenset("article main section div td body center".split())
SLOT = "\x01"


@dataclass
class Page:
    """The stream of a page: one character per token, and for each token its tag or text."""

    string: str = ""
    tokens: list = field(default_factory=list)  # (closing, name, furniture) of a tag, or a text


class Alphabet:
    """Characters for tags, by their form; shared by the pages of a host."""

    def __init__(self, forms: list[str] = ()):
        self.forms = list(forms)
        self.code = {f: self._symbol(i) for i, f in enumerate(self.forms)}

    @staticmethod
    def _symbol(i: int) -> str:
        return chr(0xE000 + i) if i < 6400 else chr(0x20000 + i)

    def form(self, symbol: str) -> str:
        """The form of a tag's symbol; empty for one that is not known."""
        i = ord(symbol)
        i = i - 0xE000 if 0xE000 <= i < 0xE000 + 6400 else i - 0x20000
        return self.forms[i] if 0 <= i < len(self.forms) else ""

    def char(self, form: str, grow: bool) -> str:
        if form not in self.code:
            if not grow:
                return "\x02"
            self.code[form] = self._symbol(len(self.forms))
            self.forms.append(form)
        return self.code[form]


def stream(html: str, alphabet: Alphabet, grow: bool = False) -> Page:
    """Tags and non-blank texts of a page in order; comments, declarations, scripts and styles are left out."""
    chars, tokens, known, space = [], [], {}, False
    for m in TOKEN.finditer(html):
        if m[3] is not None:
            key = (m[2], m[3], m[4])
            if (found := known.get(key)) is None:
                found = known[key] = _tag(m, alphabet, grow)
            chars.append(found[0])
            tokens.append(found[1])
        elif m[0][0] != "<" or m[0] == "<":
            if chars and chars[-1] == SLOT:
                tokens[-1] += m[0]
            elif m[0].isspace():
                space = True
            else:
                chars.append(SLOT)
                tokens.append(" " + m[0] if space else m[0])
                space = False
    return Page("".join(chars), tokens)


def _tag(m: re.Match, alphabet: Alphabet, grow: bool) -> tuple[str, tuple]:
    """The character of a tag, and (closing, name, furniture); furniture is 2 where only headers outside articles are."""
    closing, name = bool(m[2]), m[3].lower()
    words, furniture = "", int(name in FURNITURE)
    if name == "header":
        furniture = 2
    if not closing and m[4] and name not in ("html", "body", "main"):
        words = " ".join(a or b or c for a, b, c in NAMES.findall(m[4])).lower()
        marks = {x for w in words.split() if not w.startswith(("has-", "with-", "no-", "without-")) for x in re.split(r"[^a-z]+", w)}
        if HIDDEN.search(m[4]) or marks & (READERS if name == "article" else MARKS):
            furniture = 1
        elif marks & HEADERS and name != "article":
            furniture = max(furniture, 2)
    form = f"{'/' if closing else ''}{name}{'.' + re.sub(r'[0-9]+', '', words) if words else ''}"
    return alphabet.char(form, grow), (closing, name, furniture)


# ---- template texts ------------------------------------------------------------------------------------------------


def _keys(page: Page, alphabet: Alphabet) -> list[int | None]:
    """For each text of a page a digest of the form of the tag ahead of it and its words; None for tags."""
    return [
        _digest(f"{alphabet.form(page.string[i - 1]) if i else ''}\n{' '.join(t.split())}") if isinstance(t, str) else None
        for i, t in enumerate(page.tokens)
    ]


def _digest(key: str) -> int:
    return int.from_bytes(blake2b(key.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


def template(streams: list[Page], alphabet: Alphabet) -> list[int]:
    """The texts that most of a host's different pages have behind the same tag; none if there are few pages."""
    different = list({(p.string, tuple(t for t in p.tokens if isinstance(t, str))): p for p in streams}.values())
    if len(different) < TEMPLATE_PAGES:
        return []
    seen = Counter(k for p in different for k in {k for k in _keys(p, alphabet) if k is not None})
    return sorted(k for k, n in seen.items() if n >= TEMPLATE_PAGES and n >= TEMPLATE_SHARE * len(different))


def without_template(page: Page, known: frozenset[int] | set[int], alphabet: Alphabet) -> tuple[Page, float]:
    """The page with its template texts emptied, unless a part of it is called an article; and the share of its main part."""
    if not known or any(not isinstance(t, str) and not t[0] and t[1] in MAIN and not t[2] for t in page.tokens):
        return page, MAIN_SHARE
    emptied = [" " if k is not None and k in known else t for k, t in zip(_keys(page, alphabet), page.tokens, strict=True)]
    return Page(page.string, emptied), EMPTIED_SHARE


# ---- containers ---------------------------------------------------------------------------------------------------


def main_span(page: Page, share: float = MAIN_SHARE) -> tuple[int, int]:
    """First token and token after the last of the article's container, by its tags."""
    spans: list[tuple[int, int, str, int]] = []  # start, stop, name, characters of text outside furniture
    open_: list[list] = []  # name, start, characters, inside furniture
    total = 0
    for i, t in enumerate(page.tokens):
        if isinstance(t, str):
            if not any(o[3] for o in open_):
                total += len(t.strip())
            continue
        closing, name, furniture = t
        if not closing:
            if (name in CONTAINERS or furniture) and name not in VOID:
                open_.append([name, i, total, furniture == 1 or (furniture == 2 and not any(o[0] in MAIN for o in open_))])
        elif any(o[0] == name for o in open_):
            while open_:
                o = open_.pop()
                spans.append((o[1], i + 1 if o[0] == name else i, o[0] if not o[3] else "", total - o[2]))
                if o[0] == name:
                    break
    while open_:
        o = open_.pop()
        spans.append((o[1], len(page.tokens), o[0] if not o[3] else "", total - o[2]))
    articles = [s for s in spans if s[2] in MAIN and s[3]]
    if articles:
        best = max(articles, key=lambda s: (s[3], s[2] == "article", -s[0]))
        return best[0], best[1]
    wide = [s for s in spans if s[2] and s[3] >= share * max(total, 1)]
    if wide:
        best = min(wide, key=lambda s: (s[1] - s[0], -s[0]))
        return best[0], best[1]
    return 0, len(page.tokens)


def text_of(page: Page, start: int, stop: int) -> str:
    """Blocks of the region without furniture: each with single spaces, all joined by one space."""
    blocks, now, skip = [], [], []

    def close() -> None:
        if now:
            words = entities.unescape("".join(now)).split()
            if words:
                blocks.append(" ".join(words))
            now.clear()

    inside = start < len(page.tokens) and isinstance(page.tokens[start], tuple) and page.tokens[start][1] in MAIN
    for t in page.tokens[start:stop]:
        if isinstance(t, str):
            if not skip:
                now.append(t)
            continue
        closing, name, furniture = t
        if skip:
            if closing and name in skip:
                while skip and skip.pop() != name:
                    pass
            elif not closing and name not in VOID and name == skip[0]:
                skip.append(name)
            continue
        if not closing and name not in VOID and (furniture == 1 or (furniture == 2 and not inside)):
            close()
            skip.append(name)
        elif name == "br":
            now.append(" ")
        elif name not in INLINE:
            close()
    close()
    return " ".join(blocks)


# ---- wrappers -----------------------------------------------------------------------------------------------------


_TANDEM = re.compile(r"(.{1,%d}?)\1+" % UNIT, re.S)


def folded(string: str, units: dict[str, str]) -> str:
    """The string with tandem repeats as group symbols, inner ones first; known units also where they stand once."""
    for _ in range(4):
        before = string
        for unit, symbol in sorted(units.items(), key=lambda u: -len(u[0])):
            string = re.sub(f"(?:{re.escape(unit)})+", symbol, string)
        string = _TANDEM.sub(lambda m: _symbol(m[1], units), string)
        if string == before:
            break
    return string


def _symbol(unit: str, units: dict[str, str]) -> str:
    return units.setdefault(unit, chr(0x100000 + len(units)))


def infer(pages: list[str]) -> tuple[str, list[str]]:
    """The wrapper of pages as a regular expression with a group ``main``, and the tag forms its symbols stand for."""
    return infer_all(pages)[:2]


def infer_all(pages: list[str]) -> tuple[str, list[str], list[int]]:
    """The wrapper of pages as a regular expression with a group ``main``, its tag forms, and the template texts.

    An empty expression means there is none: fewer than two pages.
    """
    alphabet = Alphabet()
    streams = [p for p in (stream(h, alphabet, grow=True) for h in pages) if p.string]
    known = template(streams, alphabet)
    if len(streams) < 2:
        return "", alphabet.forms, known
    shapes = [shape(p, set(known), alphabet) for p in streams]
    return *expression(fold(shapes)), known


def shape(page: Page, known: frozenset[int] | set[int], alphabet: Alphabet) -> tuple[list[str], int, int]:
    """The symbols of a page by name, and where its main region begins and ends."""
    names = [SLOT if c == SLOT else alphabet.form(c) for c in page.string]
    return names, *main_span(*without_template(page, known, alphabet))


def fold(shapes: list[tuple[list[str], int, int]]) -> list[tuple]:
    """The items of the wrapper of some pages, ahead of, in and behind the main region.

    An item is a symbol by its name, ``("+", items)`` for what repeats or ``("?", items)`` for what some pages lack.
    """
    alphabet, units = Alphabet(), {}
    marked = []
    for names, a, b in shapes:
        string = "".join(SLOT if n == SLOT else alphabet.char(n, grow=True) for n in names)
        marked.append([folded(x, units) for x in (string[:a], string[a:b], string[b:])])
    # Later pages may bring units that earlier ones hold only once.
    marked = [[folded(_unfolded(x, units), units) for x in m] for m in marked]
    inverse = {s: u for u, s in units.items()}

    def named(items: list) -> tuple:
        out = []
        for x in items:
            if isinstance(x, tuple):
                out.append(("?", named(x[1])))
            elif x in inverse:
                out.append(("+", named(list(inverse[x]))))
            else:
                out.append(SLOT if x == SLOT else alphabet.form(x))
        return tuple(out)

    parts = []
    for k in range(3):
        items: list | None = None
        for m in marked:
            items = list(m[k]) if items is None else _aligned(items, m[k])
        parts.append(named(items or []))
    return parts


def joined(one: tuple, two: tuple) -> tuple:
    """Two lists of items as one: what both have stays, what only one has becomes optional; equal options come once."""
    (fixed, options), (other, more) = _apart(one), _apart(two)
    out: list = []
    now: list = []

    def offer(groups: list) -> None:
        now.extend(g for g in dict.fromkeys(groups) if g not in now)

    def close() -> None:
        out.extend(now)
        now.clear()

    def whole(kept: list, between: list[list], a: int, b: int) -> tuple:
        return "?", tuple(x for i in range(a, b) for x in ((*between[i], kept[i]) if i > a else (kept[i],)))

    for kind, a, b, c, d in _opcodes(fixed, other):
        if kind == "equal":
            for i in range(b - a):
                offer(options[a + i])
                offer(more[c + i])
                close()
                out.append(fixed[a + i])
            continue
        offer(options[a])
        offer(more[c])
        offer([whole(fixed, options, a, b)] if b > a else [])
        offer([whole(other, more, c, d)] if d > c else [])
    offer(options[-1])
    offer(more[-1])
    close()
    return tuple(out)


def _apart(items: tuple) -> tuple[list, list[list]]:
    """The items that no page lacks, and the optional ones ahead of each of them and at the end."""
    fixed, options = [], [[]]
    for x in items:
        if isinstance(x, tuple) and x[0] == "?":
            options[-1].append(x)
        else:
            fixed.append(x)
            options.append([])
    return fixed, options


def _opcodes(one: list | str, two: list | str) -> list[tuple[str, int, int, int, int]]:
    return difflib.SequenceMatcher(None, one, two, autojunk=max(len(one), len(two)) > LONGEST).get_opcodes()


def _unfolded(string: str, units: dict[str, str]) -> str:
    inverse = {s: u for u, s in units.items()}
    while any(c in inverse for c in string):
        string = "".join(inverse.get(c, c) for c in string)
    return string


def _aligned(items: list, page: str) -> list:
    """Wrapper and page aligned: what both have stays, what only one has becomes optional."""
    flat = [x if isinstance(x, str) else None for x in items]
    fixed = [x for x in flat if x is not None]
    places = [i for i, x in enumerate(flat) if x is not None]
    out: list = []
    at = 0  # next item of the wrapper

    def upto(place: int) -> None:
        nonlocal at
        out.extend(items[at:place])
        at = place

    for kind, a, b, c, d in _opcodes(fixed, page):
        begin = places[a] if a < len(places) else len(items)
        upto(begin)
        if kind == "equal":
            upto(places[b - 1] + 1)
            continue
        if b > a:
            end = places[b - 1] + 1
            inner = items[at:end]
            at = end
            out.append(("?", inner))
        if d > c:
            new = ("?", list(page[c:d]))
            near = out[-1] if out and isinstance(out[-1], tuple) else None
            if near != new:
                out.append(new)
    upto(len(items))
    return out


def expression(parts: list[tuple]) -> tuple[str, list[str]]:
    """A wrapper as a regular expression with a group ``main``, and the tag forms its symbols stand for.

    It never goes back, so matching takes linear time.
    """
    alphabet = Alphabet()

    def written(items: tuple) -> str:
        out = []
        for x in items:
            if isinstance(x, tuple):
                out.append(f"(?>{written(x[1])}){'?+' if x[0] == '?' else '++'}")
            elif x == SLOT:
                out.append(f"{SLOT}?+")
            else:
                out.append(re.escape(alphabet.char(x, grow=True)))
        return "".join(out)

    ahead, main, behind = (written(x) for x in parts)
    return f"(?s:{ahead}(?P<main>{main}){behind})", alphabet.forms


def extract(html: str, wrapper: re.Pattern | None, forms: list[str] | Alphabet, known: frozenset[int] = frozenset()) -> tuple[str, bool]:
    """The main text of a page, and whether its host's wrapper matched it; ``known`` are its host's template texts."""
    alphabet = forms if isinstance(forms, Alphabet) else Alphabet(forms)
    page, share = without_template(stream(html, alphabet), known, alphabet)
    m = wrapper.fullmatch(page.string) if wrapper is not None else None
    start, stop = m.span("main") if m and m.end("main") > m.start("main") else main_span(page, share)
    return text_of(page, start, stop), m is not None


# ---- Spark --------------------------------------------------------------------------------------------------------

_WRAPPER = "host string, block bigint, items binary"


def host(url: Column) -> Column:
    """Lower-case host of a URL; empty where there is none."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1), F.lit("")))


def main_texts(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars, wrapped`` for every page.

    Wrappers and template texts come from all pages of a host; every page is then extracted whole. ``wrapped`` tells
    whether the host's wrapper matched. Null or empty html gives the empty text.
    Pages without a host, or alone on it, are read by the container rule. Repeated rows stay; other columns are not
    read. An empty table gives an empty one.
    """
    rows = pages.select("page_id", "url", "html", host(F.col("url")).alias("host"))
    hosted = rows.filter("html is not null and host != ''").select("host", "html")
    known = _templates(hosted)
    models = _wrappers(hosted, known).join(known, "host", "left").mapInArrow(_models, "host string, model binary")
    return (
        rows.join(stored(models, "html-models"), "host", "left").select("page_id", "url", "html", "model")
        .mapInArrow(_extracted, "page_id bigint, url string, text string, n_chars bigint, wrapped boolean")
    )


def _templates(hosted: DataFrame) -> DataFrame:
    """``host, known``: the template texts of each host, counted over all its different pages."""
    marked = hosted.mapInArrow(_text_keys, "host string, mark bigint, size bigint, keys array<bigint>")
    different = marked.groupBy("host", "mark", "size").agg(F.first("keys").alias("keys"))
    # The null key counts the pages.
    every = different.select("host", F.explode(F.concat("keys", F.array(F.lit(None).cast("bigint")))).alias("key"))
    counts = stored(every.groupBy("host", "key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= TEMPLATE_PAGES), "html-texts")
    totals = counts.filter("key is null").select("host", F.col("n").alias("total"))
    often = counts.filter("key is not null").join(totals, "host").filter(F.col("n") >= TEMPLATE_SHARE * F.col("total"))
    return stored(often.groupBy("host").agg(F.sort_array(F.collect_list("key")).alias("known")), "html-templates")


def _wrappers(hosted: DataFrame, known: DataFrame) -> DataFrame:
    """``host, items``: the wrapper of each host with two pages or more, from the shapes of all its pages."""
    given = hosted.select("host", "html", F.xxhash64("html").alias("mark")).join(known, "host", "left").select("host", "mark", "html", "known")
    shaped = given.mapInArrow(_shapes, "host string, mark bigint, names array<string>, first int, stop int")
    shapes = shaped.groupBy("host", "names", "first", "stop").agg(F.min("mark").alias("mark"), F.count(F.lit(1)).alias("n_pages"))
    shapes = stored(shapes, "html-shapes")
    sizes = shapes.groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.sum("n_pages").alias("pages")).filter("pages > 1")
    block = F.pmod(F.xxhash64("mark", "names"), F.ceil(F.col("n") / BLOCK)).alias("block")
    dealt = shapes.join(sizes, "host").select("host", block, "mark", "names", "first", "stop")
    found = stored(dealt.groupBy("host", "block").applyInPandas(_folded_block, _WRAPPER), "html-wrappers")
    while (found.agg(F.max("block")).first()[0] or 0) > 0:
        upper = found.withColumn("_upper", F.expr(f"block div {BLOCK}"))
        found = stored(upper.groupBy("host", "_upper").applyInPandas(_joined_block, _WRAPPER), "html-wrappers")
    return found.select("host", "items")


def _packed(x: object) -> bytes:
    return zlib.compress(json.dumps(x).encode())


def _items(held: list) -> tuple:
    return tuple(x if isinstance(x, str) else (x[0], _items(x[1])) for x in held)


def _streams(html: Iterator[str]) -> Iterator[tuple[Page, Alphabet]]:
    """The streams of pages, with an alphabet that begins anew when it has become long."""
    alphabet = Alphabet()
    for h in html:
        if len(alphabet.forms) > 4000:
            alphabet = Alphabet()
        yield stream(h, alphabet, grow=True), alphabet


def _text_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each page a mark of its stream, and the different keys of its texts."""
    for batch in batches:
        out: list[list] = [[], [], [], []]
        for name, (page, alphabet) in zip(batch.column(0).to_pylist(), _streams(texts(batch.column(1))), strict=True):
            if not page.string:
                continue
            whole = json.dumps([alphabet.form(c) if t.__class__ is tuple else t for c, t in zip(page.string, page.tokens, strict=True)])
            keys = sorted({k for k in _keys(page, alphabet) if k is not None})
            for column, x in zip(out, (name, _digest(whole), len(whole), keys), strict=True):
                column.append(x)
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, kinds, strict=True)], names=["host", "mark", "size", "keys"])


def _shapes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: list[list] = [[], [], [], [], []]
        names, marks, held = (batch.column(i).to_pylist() for i in (0, 1, 3))
        for name, mark, known, (page, alphabet) in zip(names, marks, held, _streams(texts(batch.column(2))), strict=True):
            if page.string:
                for column, x in zip(out, (name, mark, *shape(page, frozenset(known or ()), alphabet)), strict=True):
                    column.append(x)
        kinds = (pa.string(), pa.int64(), pa.list_(pa.string()), pa.int32(), pa.int32())
        yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, kinds, strict=True)], names=["host", "mark", "names", "first", "stop"])


def _folded_block(shapes: pd.DataFrame) -> pd.DataFrame:
    own = sorted(zip(shapes["mark"], (list(x) for x in shapes["names"]), shapes["first"], shapes["stop"], strict=True))
    items = fold([x[1:] for x in own])
    return pd.DataFrame({"host": [shapes["host"].iloc[0]], "block": [shapes["block"].iloc[0]], "items": [_packed(items)]})


def _joined_block(found: pd.DataFrame) -> pd.DataFrame:
    parts: list[tuple] | None = None
    for held in found.sort_values("block")["items"]:
        own = [_items(x) for x in json.loads(zlib.decompress(held))]
        parts = own if parts is None else [joined(x, y) for x, y in zip(parts, own, strict=True)]
    return pd.DataFrame({"host": [found["host"].iloc[0]], "block": [found["_upper"].iloc[0]], "items": [_packed(parts)]})


def _models(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Expression, forms and template texts of each host, packed: every page of the host carries them."""
    for batch in batches:
        held = zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)
        packed = [_packed([*expression([_items(x) for x in json.loads(zlib.decompress(i))]), k or []]) for i, k in held]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], names=["host", "model"])


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    ready: dict[bytes | None, tuple] = {}
    for batch in batches:
        out, fits = [], []
        for h, model in zip(texts(batch.column(2)), batch.column(3).to_pylist(), strict=True):
            if len(ready) > 500:
                ready.clear()
            if model not in ready:
                wrapper, forms, known = json.loads(zlib.decompress(model)) if model else ("", [], [])
                ready[model] = re.compile(wrapper) if wrapper else None, Alphabet(forms), frozenset(known)
            text, fit = extract(h, *ready[model])
            out.append(text)
            fits.append(fit)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).cast(pa.int64()), batch.column(1), pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64()), pa.array(fits)],
            names=["page_id", "url", "text", "n_chars", "wrapped"],
        )
