"""HTML extraction with wrappers inferred per host (union-free regular expressions).

A page is read as a stream of block tags and texts; scripts, styles and inline markup are not part
of it. Neighbouring repeats of a stream are folded into repeated groups. The streams of a bounded
sample of different pages of a host are aligned one after the other: texts that differ become
slots, parts that only some pages have become optional, and a group that repeats in one page and
stands alone in another becomes a repeated group. The result is the host's wrapper.

Every page is then aligned with its host's wrapper, which says of each part whether it is main
text. A text is main text if it lies in the article and isn't the template's: the same text in
this place in several sampled pages. In a page without an article it is one if
it is a slot of the wrapper outside menus, headers, footers, sidebars, notices, adverts, forms and comments. Parts
that the wrapper doesn't have, or has from one page alone, are judged by their own place in the page.

Defined results: a null or empty page has an empty text; pages of any length are read whole; a
null url has no host and no wrapper; repeated rows are kept as rows and count once in the sample;
an empty table gives an empty result. Other columns are left alone.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from difflib import SequenceMatcher
from html import unescape

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small_batches, staged

#: Different pages per host that a wrapper is inferred from, and the longest group that is folded.
PAGES_PER_HOST, GROUP = 12, 6
#: Sampled pages that a text must be in to be the template's, and the share of common text from
#: which two pages count as copies (a template text is the smaller part of an article).
CONSTANT_PAGES, COPY = 3, 0.5
#: A host with more pages than this, and more than a HOT_HOSTS-th of all pages, is dealt to parts of that size.
HOT_PAGES, HOT_HOSTS = 10_000, 100_000

#: HTML element names by their role, and words that mark boilerplate in class, id or role.
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp "
             "small span strike strong sub sup time tt u var wbr br".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = set("nav footer aside form noscript template svg math button select iframe object canvas dialog menu head "
              "audio video map datalist progress meter".split())
ROOTS = {"article", "main"}
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}}
MARKS = set("ad ads adbox adslot advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar "
            "navigation menu breadcrumb breadcrumbs sidebar widget related recommended cookie cookies consent gdpr notice "
            "notification alert popup modal overlay newsletter subscribe signup share sharing social comment comments "
            "disqus reply replies respond footer login search pagination pager toolbar masthead complementary contentinfo dialog "
            "form menus sidebars notices popups toast".split())

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<raw>script|style|textarea|title|xmp|noembed|noframes)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?/][^>]*>", re.S | re.I)
_ATTR = re.compile(r"([^\s\"'=<>/]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))")
_BARE_HIDDEN = re.compile(r"(?<!\S)hidden(?![^\s/])", re.I)


def _region(tag: str, attrs: str, parent: str) -> tuple[str, str]:
    """Where an element's texts lie ("drop", "mark", "root" or "body"), and its name in the
    stream. "mark" is dropped for its class, id or role only: an article in it is one again."""
    words: list[str] = []
    marked: set[str] = set()
    hidden = False
    for m in _ATTR.finditer(attrs or ""):
        key, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if key in ("class", "id", "role"):
            words += re.split(r"[^a-z]+", value)
            for token in value.split():  # a compound counts if it is made of marks only
                parts = set(re.split(r"[^a-z]+", token)) - {""}
                marked |= parts if parts <= MARKS | {"header"} else set()
        hidden |= (key == "hidden" or (key == "aria-hidden" and value.strip() == "true")
                   or (key == "style" and bool(re.search(r"display\s*:\s*none", value))))
    hidden = hidden or bool(attrs and _BARE_HIDDEN.search(_ATTR.sub(" ", attrs)))
    name = tag + "".join("." + x for x in sorted(set(words) - {""}))
    if parent == "drop" or tag in DROPPED or hidden:
        return "drop", name
    comments = {"comment", "comments"} & marked
    if tag in ROOTS and not comments:
        return "root", name
    if parent == "mark" and not comments:
        return "mark", name
    if tag not in ("body", "html") and MARKS & marked:
        return ("drop" if comments or parent == "root" else "mark"), name
    if parent != "root" and (tag == "header" or "header" in marked):
        return ("drop" if tag == "header" else "mark"), name
    return ("root" if "articlebody" in (attrs or "").lower() else parent), name


def page_stream(html: str | None) -> list[tuple[str, str | None]]:
    """(shape, text) tokens of a page: block tags, and texts with white space made single.

    Shapes hold the region, so what is aligned always lies in the same region."""
    out: list[tuple[str, str | None]] = []
    stack: list[tuple[str, str]] = [("", "body")]
    words: list[str] = []

    def flush() -> None:
        text = " ".join(unescape("".join(words)).split())
        words.clear()
        if text:
            out.append((f"#{stack[-1][1]}", text))

    at, html = 0, html or ""
    for m in _MARKUP.finditer(html):
        if m.start() > at:
            words.append(html[at : m.start()])
        at = m.end()
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if tag in INLINE:
            if tag == "br":
                words.append(" ")
            continue
        flush()
        if m["end"]:
            if any(t == tag for t, _ in stack):
                while stack.pop()[0] != tag:
                    pass
                out.append((f"/{tag}", None))
            continue
        closing = CLOSES.get(tag, ())
        while stack[-1][0] == "p" or stack[-1][0] in closing:
            stack.pop()
        region, name = _region(tag, m["attrs"], stack[-1][1])
        out.append((f"{name} {region}", None))
        if tag not in VOID and not m["attrs"].endswith("/"):
            stack.append((tag, region))
    if at < len(html):
        words.append(html[at:])
    flush()
    return out


class Part:
    """One part of a folded stream or wrapper: a tag, a text or a repeated group."""

    __slots__ = ("shape", "text", "slot", "optional", "body", "where", "seen")

    def __init__(self, shape, text=None, slot=False, optional=False, body=None, where=(), seen=None):
        self.shape, self.text, self.slot, self.optional, self.body, self.where = shape, text, slot, optional, body, where
        self.seen = seen or {}  # the texts of a leaf, each with the sampled pages it was seen in

    def pages(self) -> frozenset[int]:
        return frozenset().union(*self.seen.values())

    def constants(self) -> list[str]:
        """Texts of a leaf that belong to the template: seen in CONSTANT_PAGES pages and in half of the leaf's."""
        least = max(CONSTANT_PAGES, len(self.pages()) / 2)
        return sorted(t for t, pages in self.seen.items() if t is not None and len(pages) >= least)

    def leaves(self) -> Iterator[Part]:
        for b in self.body or ():
            yield from b.leaves()
        if not self.body:
            yield self

    def joined(self, other: Part) -> Part:
        """This part where another one of the same shape stands in the other stream."""
        body = [a.joined(b) for a, b in zip(self.body, other.body)] if self.body else None
        return Part(self.shape, self.text, self.slot or other.slot or self.text != other.text,
                    self.optional or other.optional, body, self.where + other.where,
                    {t: self.seen.get(t, frozenset()) | other.seen.get(t, frozenset()) for t in {**self.seen, **other.seen}})


def _repeated(body: list[Part]) -> Part:
    return Part("(" + ",".join(p.shape for p in body) + ")+", body=body, where=sum((p.where for p in body), ()))


def fold(parts: list[Part]) -> list[Part]:
    """Neighbouring repeats of up to GROUP parts as repeated groups, short ones first."""
    for width in range(1, GROUP + 1):
        shapes = [p.shape for p in parts]
        out, at = [], 0
        while at < len(parts):
            group = shapes[at : at + width]
            if len(group) == width and shapes[at + width : at + 2 * width] == group and any(x[0] != "/" for x in group):
                body, at = parts[at : at + width], at + width
                while shapes[at : at + width] == group:
                    body = [a.joined(b) for a, b in zip(body, parts[at : at + width])]
                    at += width
                out.append(_repeated(body))
            else:
                out.append(parts[at])
                at += 1
        parts = out
    return parts


def fold_like(parts: list[Part], groups: list[list[str]]) -> list[Part]:
    """Single occurrences of known repeated groups as repeated groups of one."""
    for group in groups:
        shapes, out, at = [p.shape for p in parts], [], 0
        while at < len(parts):
            if shapes[at : at + len(group)] == group:
                out.append(_repeated(parts[at : at + len(group)]))
                at += len(group)
            else:
                out.append(parts[at])
                at += 1
        parts = out
    return parts


def _groups(parts: list[Part]) -> list[list[str]]:
    return [list(g) for g in dict.fromkeys(tuple(b.shape for b in p.body) for p in parts if p.body)]


def folded(stream: list[tuple[str, str | None]], page: int = 0) -> list[Part]:
    return fold([Part(s, t, where=(i,), seen={t: frozenset((page,))}) for i, (s, t) in enumerate(stream)])


def aligned(wrapper: list[Part], page: list[Part]) -> list[Part]:
    """One alignment step: the wrapper that also takes this page."""
    wrapper, page = fold_like(wrapper, _groups(page)), fold_like(page, _groups(wrapper))
    out: list[Part] = []
    match = SequenceMatcher(None, [p.shape for p in wrapper], [p.shape for p in page], autojunk=False)
    for op, a, b, c, d in match.get_opcodes():
        if op == "equal":
            out += [x.joined(y) for x, y in zip(wrapper[a:b], page[c:d])]
        else:
            for p in wrapper[a:b] + page[c:d]:
                p.optional = True
                out.append(p)
    return out


def _unlike(streams: list[list[tuple[str, str | None]]]) -> list[list[tuple[str, str | None]]]:
    """The streams without those whose article mostly is an earlier one's: copies of an article
    would make its own text look like the template's."""
    kept, texts = [], []
    for stream in streams:
        mine = {t for s, t in stream if s == "#root"}
        size = sum(map(len, mine))
        if not any(sum(map(len, mine & other)) >= COPY * max(size, n) for other, n in texts if mine and other):
            kept.append(stream)
            texts.append((mine, size))
    return kept


def infer(pages: list[str]) -> list[list]:
    """The wrapper of a host from different pages: a list of [shape, keep, optional, inner].
    Keep is None for a text of one page alone: nothing is known of it. Inner are the parts of a
    repeated group, or the texts of a leaf that belong to the template."""
    streams = _unlike([page_stream(html) for html in pages])
    wrapper: list[Part] = []
    for n, stream in enumerate(streams):
        page = folded(stream, n)
        wrapper = aligned(wrapper, page) if n else page

    def verdict(p: Part) -> list:
        keep = p.shape == "#root" or (p.shape == "#body" and (p.slot or len(streams) < CONSTANT_PAGES))
        if p.shape == "#body" and not keep and len(p.pages()) < 2:
            keep = None
        return [p.shape, keep, p.optional, [verdict(b) for b in p.body] if p.body else p.constants()]

    return [verdict(p) for p in wrapper]


class Wrapper:
    """A wrapper that is ready to be laid over pages."""

    def __init__(self, items: list[list]):
        self.items = items
        self.shapes = [i[0] for i in items]
        self.groups = [[b[0] for b in i[3]] for i in items if i[0][0] == "("]
        self.known: dict[tuple[str, ...], dict[int, list]] = {}

    def verdicts(self, stream: list[tuple[str, str | None]]) -> list[bool]:
        """Which tokens of a page are main text. Pages of the same shape are aligned once.

        An article keeps its slots and loses the template's texts; if nothing but these is in it, it is kept whole."""
        key = tuple(s for s, _ in stream)
        if key not in self.known:
            if len(self.known) > 500:
                self.known.clear()
            self.known[key] = self._align(stream)
        own = own_verdicts(stream)
        out, rooted = list(own), "#root" in key
        for w, item in self.known[key].items():
            if not rooted and item[1] is not None:
                out[w] = item[1]
            if out[w] and stream[w][1] in item[3]:
                out[w] = False
        return own if rooted and not any(out) else out

    def _align(self, stream: list[tuple[str, str | None]]) -> dict[int, list]:
        """The wrapper's leaf that each text of a page stands at."""
        page = fold_like(folded(stream), self.groups)
        match = SequenceMatcher(None, self.shapes, [p.shape for p in page], autojunk=False)
        out: dict[int, list] = {}
        for a, b, n in match.get_matching_blocks():
            for item, part in zip(self.items[a : a + n], page[b : b + n]):
                self._place(item, part, out)
        return out

    def _place(self, item: list, part: Part, out: dict[int, list]) -> None:
        if part.body:
            for inner, p in zip(item[3], part.body):
                self._place(inner, p, out)
        elif item[0] in ("#root", "#body"):
            out.update((w, item) for w in part.where)


def own_verdicts(stream: list[tuple[str, str | None]]) -> list[bool]:
    """Which tokens are main text by their own place in the page."""
    rooted = any(s == "#root" for s, _ in stream)
    return [s == "#root" or (s == "#body" and not rooted) for s, _ in stream]


def main_text(html: str | None, wrapper: Wrapper | None) -> str:
    stream = page_stream(html)
    verdict = wrapper.verdicts(stream) if wrapper else own_verdicts(stream)
    return "\n\n".join(t for (_, t), good in zip(stream, verdict) if good and t)


def host(url: Column) -> Column:
    name = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1))
    return F.when(name != "", name)


def _hot(counts: DataFrame) -> DataFrame:
    """(_host, _salts) of the hosts whose pages are dealt to several parts: fewer than HOT_HOSTS rows."""
    share = F.floor(counts.agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("n")).scalar() / HOT_HOSTS)
    part = F.greatest(F.lit(HOT_PAGES).cast("long"), share)
    return counts.filter(F.col("_rows") > part).select(F.col("host").alias("_host"), F.ceil(F.col("_rows") / part).cast("int").alias("_salts"))


def host_pages(pages: DataFrame) -> DataFrame:
    """(host, _h, _c): the different pages of every host by hash, with their copies, which are counted
    before the shuffle. Only hosts and hashes are shuffled."""
    rows = _hashed(pages).select("host", "_h")
    return staged(rows.groupBy("host", "_h").agg(F.count(F.lit(1)).alias("_c")), "wrapper-pages")


def host_counts(each: DataFrame) -> DataFrame:
    """(host, _n, _rows): different and all pages of every host."""
    return staged(each.groupBy("host").agg(F.count(F.lit(1)).alias("_n"), F.sum("_c").alias("_rows")), "wrapper-hosts")


def _hashed(pages: DataFrame) -> DataFrame:
    rows = pages.select(host(F.col("url")).alias("host"), F.xxhash64("html").bitwiseAND(2**63 - 1).alias("_h"), "html")
    return rows.filter("host IS NOT NULL AND html IS NOT NULL")


def host_wrappers(pages: DataFrame, each: DataFrame, counts: DataFrame, per_host: int = PAGES_PER_HOST) -> DataFrame:
    """(host, wrapper) of every host, from about ``per_host`` different pages drawn by hash.

    The pages are drawn on hashes (``host_pages`` and ``host_counts``); html is joined to the drawn
    hashes alone, which Spark broadcasts if they are few."""
    limit = counts.select("host", F.when(F.col("_n") <= per_host, F.lit(2**63 - 1)).otherwise(
        (F.lit(float(2**63)) * per_host / F.col("_n")).cast("long")).alias("_limit"))
    drawn = staged(each.join(limit, "host").filter("_h <= _limit").select("host", "_h"), "wrapper-sample")
    few = _hashed(pages).join(drawn, ["host", "_h"], "left_semi").dropDuplicates(["host", "_h"])

    def learn(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("_h").head(2 * per_host)
        return pd.DataFrame({"host": [group["host"].iloc[0]], "wrapper": [json.dumps(infer(list(group["html"])))]})

    found = few.select("host", "_h", "html").groupBy("host").applyInPandas(learn, "host string, wrapper string")
    return staged(found, "wrappers")


def extract(pages: DataFrame, per_host: int = PAGES_PER_HOST) -> DataFrame:
    """One row per page: page_id, url, text, n_chars.

    Few wrappers are broadcast by Spark and html isn't shuffled. Otherwise it is once, by host and part
    of a host, so that the largest task follows HOT_PAGES and not the largest host."""
    small_batches(pages.sparkSession)
    each = host_pages(pages)
    counts = host_counts(each)
    wrappers, hot = host_wrappers(pages, each, counts, per_host), F.broadcast(staged(_hot(counts), "wrapper-hot"))
    salts = F.coalesce(F.col("_salts"), F.lit(1))
    rows = pages.select("page_id", "url", "html", host(F.col("url")).alias("_host")).join(hot, "_host", "left")
    salts_of_row = F.when(F.col("_host").isNull(), HOT_HOSTS).otherwise(salts)  # no host: joined to nothing, so spread
    rows = rows.withColumn("_salt", F.pmod(F.xxhash64("page_id", "html"), salts_of_row).cast("int")).drop("_salts")
    w = wrappers.withColumnRenamed("host", "_host").join(hot, "_host", "left")
    w = staged(w.select("_host", "wrapper", F.explode(F.sequence(F.lit(0), salts - 1)).alias("_salt")), "wrappers-dealt")
    rows = rows.join(w, ["_host", "_salt"], "left")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[str, Wrapper] = {}
        for batch in batches:
            texts = []
            for html, name, wrapper in zip(batch["html"], batch["_host"], batch["wrapper"]):
                if wrapper is not None and name not in known:
                    if len(known) > 1000:
                        known.clear()
                    known[name] = Wrapper(json.loads(wrapper))
                texts.append(main_text(html, known.get(name) if wrapper is not None else None))
            yield pd.DataFrame({"page_id": batch["page_id"], "url": batch["url"], "text": texts,
                                "n_chars": [len(t) for t in texts]})

    rows = rows.select(F.col("page_id").cast("string").alias("page_id"), "url", "html", "_host", "wrapper")
    out = rows.mapInPandas(run, "page_id string, url string, text string, n_chars long")
    return out.withColumn("page_id", F.col("page_id").cast(pages.schema["page_id"].dataType))
