"""HTML extraction by wrappers: a union-free regular expression for each host, inferred from all of its pages.

Every page becomes a stream of tags and text slots. Repeats within a stream are folded into groups, and the different
streams of a host are aligned one after another: what both have stays, a group found in both is aligned inside, and a
mismatch becomes optional. The result is a sequence of tags, text slots, repeated groups `( )+` and optional groups
`( )?`. Aligning goes in rounds of at most some dozens of streams a task, so that a host with a third of all pages, or
with very many different pages, is never one task's work.

Each text slot of a wrapper lies in a chain of elements. Chains in menus, headers, footers, sidebars, notices, adverts,
forms and reader comments are never main text, by whole words of class and role. Of the others, a page's main text is
what lies in its article elements, or else (also if the articles are teasers beside a longer text) its main element or
content block, or else the element that holds most of the text that differs from page to page of the host. The main
chains are found once a host and then applied to every page. They are taken from the parsed pages: the inferred
wrapper is returned with them, but does not decide on any text.

Defined cases: a null or empty html has an empty text; a null or odd url is a host of its own, named by the empty string; repeated pages
count once each; unclosed elements, cut-off pages and `</p>` within scripts are read as browsers do; pages of any
length are read whole; further columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import difflib
import html as html_lib
import json
import re
from collections import Counter
from functools import lru_cache

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import ship, stored

_TOKEN = re.compile(
    r"<!--.*?(?:-->|$)"
    r"|<(script|style|noscript|template|textarea|svg|iframe|annotation-xml|annotation)\b(?:[^'\">]|\"[^\"]*\"|'[^']*')*+>.*?(?:</\1\s*>|$)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^'\">]|\"[^\"]*\"|'[^']*')*+)>"
    r"|<[/!?][^>]*(?:>|$)|<[a-zA-Z][^>]*(?:>|$)",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"(?<![\w-])(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr "
                    "math semantics mrow mi mn mo ms mtext mfrac msup msub msubsup msqrt mroot mover munder munderover mstyle mpadded".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_CLOSES_P = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
_SIBLINGS = {"li": "li", "dt": "dt dd", "dd": "dt dd", "tr": "tr td th", "td": "td th", "th": "td th", "option": "option"}
#: Elements that are never main text, whatever their attributes.
_OUTSIDE = frozenset("head nav footer aside form button select dialog menu title".split())
#: Words of class, id or role that mark what isn't main text.
_MARKS = frozenset(
    "nav navbar navigation menu menus breadcrumb breadcrumbs pagination pager footer foot copyright sidebar sidebars aside widget widgets advert adverts "
    "advertisement advertisements advertising sponsor sponsors sponsored promo promos promotion banner banners cookie cookies consent gdpr "
    "notice notices notification notifications alert alerts popup popups modal overlay newsletter newsletters subscribe subscription signup login "
    "share shares sharing sharebar social related recommend recommended recommendations comment comments commentlist commentform repl replies respond "
    "discussion discussions disqus search searchbox searchform form forms contentinfo masthead toolbar skip skiplink legal disclaimer".split()
)
_WHOLE_MARKS = frozenset("ad ads adv adbox adslot side top bottom meta tags hidden header banner".split())
_EXEMPT = frozenset("html body article main".split())
_MAIN_MARKS = frozenset("main content article articlebody post entry story maincontent postcontent entrycontent articlecontent".split())
#: Words that an id may have beside marks. Any other id is a slug of its text and says nothing.
_ID_WORDS = _MARKS | _WHOLE_MARKS | _MAIN_MARKS | frozenset(
    "0 site page left right wrapper container block box area section global primary secondary inner outer bar list links buttons posts text".split()
)
#: Streams that one task aligns at a time, on average.
TOGETHER = 48
#: Longest group that is looked for as a repeat.
LONGEST_REPEAT = 24


def _element(name: str, attributes: str) -> str:
    """Name and the words of class, role and itemprop, with numbers alike; those of an id if it is made of known words alone."""
    words: set[str] = set()
    if "=" in attributes:
        for m in _ATTRIBUTE.finditer(attributes):
            found = {re.sub(r"\d+", "0", w) for w in re.split(r"[^a-z0-9]+", (m[2] or m[3] or m[4] or "").lower()) if w}
            if m[1].lower() != "id" or found <= _ID_WORDS:
                words |= found
    return ".".join([name, *sorted(words)])


def _outside(element: str, inside_article: bool) -> bool:
    name, *words = element.split(".")
    if name in _EXEMPT:
        return False
    if name in _OUTSIDE or name in ("header", "figcaption") and not inside_article:
        return True
    return any(w in _WHOLE_MARKS and not (w in ("header", "meta", "top") and inside_article) or w in _MARKS for w in words)


def parse(html: str) -> list[tuple[str, str, bool]]:
    """Events in page order: ("<", element, block), (">", name, block), ("#", text, in a link). Scripts, styles and comments are left out."""
    events, at, links = [], 0, 0
    for m in _TOKEN.finditer(html):
        if m.start() > at:
            events.append(("#", html[at : m.start()], links > 0))
        at = m.end()
        if m[3] is None:
            continue
        name = m[3].lower()
        if m[2]:
            links -= name == "a" and links > 0
            events.append((">", name, name not in _INLINE))
        else:
            links = links + 1 if name == "a" else 0 if name in _CLOSES_P else links
            events.append(("<", _element(name, m[4]), name not in _INLINE))
    if at < len(html):
        events.append(("#", html[at:], links > 0))
    return events


def chains(events: list[tuple[str, str, bool]]) -> list[tuple[str | None, str, bool]]:
    """(chain of block elements, text, in a link) of every text; a None chain marks the border of a block."""
    out: list[tuple[str | None, str, bool]] = []
    stack: list[str] = []

    def close(names: set[str], until: frozenset[str]) -> None:
        for i in range(len(stack) - 1, -1, -1):
            name = stack[i].split(".", 1)[0]
            if name in names:
                del stack[i:]
                return
            if name in until:
                return

    for kind, value, block in events:
        if kind == "#":
            out.append(("/".join(stack), value, block))
        elif block:
            out.append((None, "", False))
            name = value.split(".", 1)[0]
            if kind == "<":
                if name in _CLOSES_P:
                    close({"p"}, frozenset(("div", "article", "section", "main", "td", "li", "body")))
                if name in _SIBLINGS:
                    close(set(_SIBLINGS[name].split()), frozenset(("ul", "ol", "dl", "table", "select")))
                if name == "body":
                    close({"head"}, frozenset())
                if name not in _VOID:
                    stack.append(value)
            else:
                close({name}, frozenset())
    return out


# --- inference ----------------------------------------------------------------------------------


def stream(events: list[tuple[str, str, bool]]) -> list:
    """Tags of blocks and text slots; inline tags belong to the text."""
    out: list = []
    for kind, value, block in events:
        if kind == "#":
            if value.strip() and (not out or out[-1] != "#"):
                out.append("#")
        elif block:
            out.append(f"<{value}>" if kind == "<" else f"</{value}>")
    return fold(out)


def fold(items: list) -> list:
    """Collapses what is repeated back to back into groups, the shortest first: [x, y, x, y] → [["+", [x, y]]]."""
    for width in range(1, min(LONGEST_REPEAT, len(items) // 2) + 1):
        out: list = []
        for item in items:
            out.append(item)
            tail = out[-width:]
            if len(out) >= 2 * width and out[-2 * width : -width] == tail:
                out[-2 * width :] = [["+", tail]]
            elif len(out) > width and out[-width - 1] == ["+", tail]:
                del out[-width:]
        items = out
    return items


def _key(item) -> str:
    """What two items must share to be aligned: the tag itself, or for a group its kind and first tag."""
    if isinstance(item, str):
        return item
    if item[0] == "?":
        return _key(item[1][0])
    return "+" + _key(item[1][0])


def _optional(items: list) -> list:
    """What only one side has, as one optional group; what is optional already stays so."""
    out: list = []
    for item in items:
        if not isinstance(item, str) and item[0] == "?":
            out.append(item)
        elif out and out[-1][0] == "?" and out[-1][-1] == "new":
            out[-1][1].append(item)
        else:
            out.append(["?", [item], "new"])
    return [i[:2] for i in out]


def align(a: list, b: list) -> list:
    """The expression that covers both sides."""
    if a == b:
        return a
    out: list = []
    matcher = difflib.SequenceMatcher(None, [_key(x) for x in a], [_key(x) for x in b], autojunk=False)
    for kind, a0, a1, b0, b1 in matcher.get_opcodes():
        if kind == "equal":
            for x, y in zip(a[a0:a1], b[b0:b1]):
                if x == y or isinstance(x, str) and isinstance(y, str):
                    out.append(x)
                    continue
                optional = any(not isinstance(i, str) and i[0] == "?" for i in (x, y))
                inner = [i[1] if not isinstance(i, str) and i[0] == "?" else [i] for i in (x, y)]
                if not optional:
                    out.append(["+", align(x[1], y[1])])
                else:
                    out.append(["?", align(*inner)])
        else:
            out += _optional(a[a0:a1]) + _optional(b[b0:b1])
    return out


def expression(items: list) -> str:
    """A wrapper as text: # for a text slot, ( )+ and ( )? for groups."""
    return "".join(i if isinstance(i, str) else f"({expression(i[1])}){i[0]}" for i in items)


def slots(items: list) -> set[str]:
    """The chains of a wrapper's text slots."""
    events: list[tuple[str, str, bool]] = []

    def walk(items: list) -> None:
        for i in items:
            if not isinstance(i, str):
                walk(i[1])
            elif i == "#":
                events.append(("#", "#", False))
            elif i.startswith("</"):
                events.append((">", i[2:-1], True))
            else:
                events.append(("<", i[1:-1], True))

    walk(items)
    return {chain for chain, text, _ in chains(events) if chain is not None and text.strip()}


@lru_cache(1 << 16)
def _grade(chain: str) -> int | None:
    """None outside the main text; else 3 in an article, 2 in a main element or content block, 1 elsewhere."""
    grade = 1
    for element in chain.split("/"):
        if _outside(element, grade > 1):
            return None
        name, *words = element.split(".")
        if name == "article" or "articlebody" in words:
            grade = 3
        elif (name == "main" or _MAIN_MARKS & set(words)) and name not in ("html", "body"):
            grade = max(grade, 2)
    return grade


def main_chains(found: set[str], texts: dict[str, tuple[int, int, int, int]]) -> list[str]:
    """Of a host's chains those that hold main text. texts: chain → number of blocks, of different texts, of characters, of those in links."""
    graded = {c: g for c in found if (g := _grade(c)) is not None}
    if max(graded.values(), default=1) > 1:
        return sorted(c for c, g in graded.items() if g > 1)
    # No element says so: what differs from page to page and isn't links.
    none = (0, 0, 0, 0)
    varied = {c: texts.get(c, none)[2] for c in graded if 2 * texts.get(c, none)[1] > texts.get(c, none)[0] and 2 * texts.get(c, none)[3] <= texts.get(c, none)[2]}
    holders: Counter[str] = Counter()
    for chain, size in varied.items():
        parts = chain.split("/")
        for n in range(1, len(parts) + 1):
            holders["/".join(parts[:n])] += size
    total = sum(varied.values())
    most = [h for h, size in holders.items() if 10 * size >= 6 * total]
    holder = max(most, key=lambda h: (h.count("/"), holders[h], h), default="")
    if holder.rsplit("/", 1)[-1].split(".")[0] in ("p", "h1", "h2", "h3", "li", "td"):
        holder = holder.rpartition("/")[0]
    return sorted(c for c in varied if c == holder or c.startswith(holder + "/") or not holder)


# --- extraction ---------------------------------------------------------------------------------


def _content(found: list[tuple[str | None, str, bool]], main: set[str]) -> set[str]:
    """Of the main chains those of a page's content: its articles, unless its main element has more than twice their text besides them."""
    sizes: Counter[int] = Counter()
    for chain, text, linked in found:
        if chain in main and not linked:
            sizes[_grade(chain)] += len(text.strip())
    if not sizes[2] or not sizes[3]:
        best = 2 if sizes[2] else 3 if sizes[3] else 0
    else:
        best = 3 if 2 * sizes[3] >= sizes[2] else 2
    return {c for c in main if _grade(c) == best} if best else main


def main_text(html: str, main: list[str] | None) -> str:
    """The text of the main chains; on a page that has none of them, of all chains that aren't outside the main text."""
    found = chains(parse(html))
    wanted = _content(found, set() if main is None else set(main))
    if not any(chain in wanted for chain, text, _ in found if chain is not None and text.strip()):
        wanted = {c for c in {c for c, t, _ in found if c is not None and t.strip()} if _grade(c) is not None}
    pieces: list[str] = []
    for chain, text, _ in found:
        if chain is None:
            pieces.append(" ")
        elif chain in wanted or not text.strip():
            pieces.append(html_lib.unescape(text))
        else:
            pieces.append(" ")
    return " ".join("".join(pieces).split())


def host_of(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def _parsed(pages: DataFrame) -> DataFrame:
    """(host, stream, blocks) of every page, stored."""
    ship(pages.sparkSession)

    @F.pandas_udf("stream string, blocks array<struct<chain:string,text:long,chars:long,linked:long>>")
    def read(htmls: pd.Series) -> pd.DataFrame:
        rows = []
        for html in htmls:
            events = parse(html)
            blocks = [(c, xxhash.xxh64_intdigest(t.strip().encode("utf-8", "surrogatepass")) >> 1, len(t), len(t) * linked) for c, t, linked in chains(events) if c is not None and t.strip()]
            rows.append((json.dumps(stream(events), ensure_ascii=False, separators=(",", ":")), blocks))
        return pd.DataFrame(rows, columns=["stream", "blocks"])

    found = pages.select(host_of(F.col("url")).alias("host"), read(F.coalesce("html", F.lit(""))).alias("page"))
    return stored(found.select("host", "page.stream", "page.blocks"), "parsed")


def infer(streams: DataFrame) -> DataFrame:
    """(host, stream, n) of different streams → one wrapper a host, stored. In each round a task aligns some dozens, the most frequent first."""

    def together(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["n", "stream"], ascending=[False, True])
        wrapper = json.loads(group["stream"].iloc[0])
        for other in group["stream"].iloc[1:]:
            wrapper = align(wrapper, json.loads(other))
        merged = json.dumps(wrapper, ensure_ascii=False, separators=(",", ":"))
        return pd.DataFrame({"host": group["host"].iloc[:1], "stream": merged, "n": group["n"].sum()})

    while True:
        numbers = stored(streams.groupBy("host").agg(F.count(F.lit(1)).alias("streams")), "stream-numbers")
        if (numbers.agg(F.max("streams")).first()[0] or 0) <= 1:
            return streams
        dealt = streams.join(numbers, "host").withColumn("part", F.pmod(F.xxhash64("stream"), F.ceil(F.col("streams") / TOGETHER)))
        streams = stored(dealt.select("host", "part", "stream", "n").groupBy("host", "part").applyInPandas(together, "host string, stream string, n long"), "wrappers")


def wrappers(pages: DataFrame) -> DataFrame:
    """(host, wrapper, main_chains) of every host, stored. All pages of a host count, as streams and in the numbers of its chains."""
    parsed = _parsed(pages)
    streams = stored(parsed.groupBy("host", "stream").agg(F.count(F.lit(1)).alias("n")), "streams")
    blocks = parsed.select("host", F.inline("blocks"))
    texts = blocks.groupBy("host", "chain", "text").agg(F.count(F.lit(1)).alias("n"), F.sum("chars").alias("chars"), F.sum("linked").alias("linked"))
    texts = texts.groupBy("host", "chain").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("different"), F.sum("chars").alias("chars"), F.sum("linked").alias("linked"))
    per_host = texts.groupBy("host").agg(F.collect_list(F.struct("chain", "n", "different", "chars", "linked")).alias("texts"))

    @F.pandas_udf("wrapper string, main_chains array<string>")
    def decide(streams: pd.Series, texts: pd.Series) -> pd.DataFrame:
        rows = []
        for items, own in zip(map(json.loads, streams), texts):
            known = {t["chain"]: (t["n"], t["different"], t["chars"], t["linked"]) for t in (own if own is not None else ())}
            rows.append((expression(items), main_chains(slots(items) | set(known), known)))
        return pd.DataFrame(rows, columns=["wrapper", "main_chains"])

    joined = infer(streams).join(per_host, "host", "left").select("host", decide("stream", "texts").alias("made"))
    return stored(joined.select("host", "made.wrapper", "made.main_chains"), "host-wrappers")


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text) of every page. The pages of a large host are split in the join with the wrappers."""

    @F.pandas_udf("string")
    def text(htmls: pd.Series, main: pd.Series) -> pd.Series:
        return pd.Series([main_text(h, m) for h, m in zip(htmls, main)], dtype=object)

    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"), host_of(F.col("url")).alias("host"))
    return rows.join(wrappers(pages), "host", "left").select("page_id", "url", text("html", "main_chains").alias("text"))
