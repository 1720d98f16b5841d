"""Main text of web pages: the slots of a template that is deduced from the pages of a host.

1. Tokens of a page are its elements, opened and closed, and its blocks of text. Tokens with equal occurrence vectors over a host's pages
   are classes; the ordered and nested ones make the host's template (`equivalence`). What varies between its tokens are the slots.
2. Names rank the blocks of a page: 3 inside `article` or `main`, 2 inside elements whose class or id names content, 1 elsewhere, 0 in
   menus, headers, footers, sidebars, notices, adverts, forms and comments. The level of a host is the best rank most of its pages have.
3. The main slots of a host are those that hold text of that level. Where names say nothing (level 1) they are the slots inside the deepest
   template element that holds at least ``MAIN_SHARE`` of the host's varying text.
4. The text of a page are the blocks of the level in the main slots. A text that is a token of a valid class is template and not content;
   inside the main slots only texts of the root class (once in every page, at least ``FULL_PAGES`` of them) go, so passages that many
   articles share stay.

Inside `article` or `main` a name rejects an element only if all its words are of menus or layout (`share-buttons`, not `related-work`),
and headings in its header stay; paragraphs and headings are never rejected by their names.

A host with fewer than ``MIN_PAGES`` different pages has no template: vectors over so few pages are equal by chance. Its pages, pages with a
null url, and pages without text in the main slots are read by the ranks of 2 alone. Null html is an empty text. Repeated rows
give equal rows. Columns besides page_id, url and html are not read.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from propensight.llm.common import table
from propensight.llm.equivalence import CLOSE, OPEN, STREAM, Hosts, Template, as_array, deduce, lists, roles
from propensight.llm.markup import Element, digest, read, words
from propensight.llm.urls import host_of
from propensight.session import materialize

SUPPORT, MIN_PAGES, FULL_PAGES = 0.5, 4, 10
MAIN_SHARE = 0.7
# Elements and words of class or id that are not the article.
BAD_TAGS = frozenset("nav header footer aside form script style noscript template iframe button select dialog menu svg object canvas".split())
BAD_WORDS = frozenset((
    "ad ads adv advert adverts advertisement advertisements advertising adsense banner banners sponsor sponsors sponsored promo promos "
    "promotion promotions sidebar sidebars menu menus nav navbar navigation breadcrumb breadcrumbs footer foot header masthead topbar "
    "comment comments commentlist disqus reply replies respond cookie cookies consent gdpr notice notices notification notifications "
    "popup modal overlay newsletter subscribe subscription signup login share sharing social related recommended recommendations "
    "widget widgets toolbar pagination pager paywall disclaimer copyright skip aside alert alerts teaser teasers responses").split())
LAYOUT_WORDS = frozenset((
    "box boxes container wrapper wrap block section area inner outer row col column list links link items item bar panel buttons button "
    "icons posts post articles stories content entry card cards form text title heading label top bottom left right main site page user "
    "slot unit zone my the js is has").split())
HEADER_WORDS = frozenset("header head masthead".split())
CONTENT_WORDS = frozenset("article content post entry story main body text".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())


@lru_cache(maxsize=1 << 14)
def says_bad(names: str) -> bool:
    """A word of menus, sidebars and the like, unless another class names content: `post has-sidebar` is a post, `comment-content` no content."""
    each = [set(words(n)) for n in names.split()]
    return any(BAD_WORDS & w for w in each) and not any(CONTENT_WORDS & w and not BAD_WORDS & w for w in each)


def names_content(e: Element) -> bool:
    return bool(e.names) and e.tag not in ("html", "body", "") and bool(CONTENT_WORDS.intersection(words(e.names)))


def common_ancestor(elements: list[Element]) -> Element:
    lowest = list(elements[0].above())
    for e in elements[1:]:
        above = set(e.above())
        lowest = [x for x in lowest if x in above]
    return lowest[0]


@lru_cache(maxsize=1 << 14)
def only_bad(names: str) -> bool:
    """A class or id whose words are all of menus and the like, or of layout."""
    each = [set(words(n)) for n in names.split()]
    return any(BAD_WORDS & w and w <= BAD_WORDS | LAYOUT_WORDS for w in each)


class Page:
    """The stream of a page: tokens, characters of texts, and the rank that names give each text."""

    def __init__(self, page: str):
        elements, stream = read(page, BAD_WORDS)
        blocks = [(e, t) for e, t in stream if t]
        hinted = {e for e in elements if e.names and e.tag not in ("html", "body") and says_bad(e.names)}
        mains = [e for e in elements if e.tag in ("article", "main") or "role" in e.names and "main" in words(e.names)]
        open_ = [e for e in mains if e not in hinted]
        if not open_:
            hinted -= self.swallowing(blocks, hinted)
            open_ = [e for e in mains if e not in hinted]
        tagged = {e for e in elements if e.tag in BAD_TAGS}
        shut = self.below(elements, hinted | tagged)
        chosen = set([e for e in open_ if e not in shut] or open_)
        holders = {x for e in chosen for x in e.above()}
        # Articles inside `main` are the main elements; beside a `main` with text of its own they are not.
        within = {e for e in chosen if e.tag != "article" and any(e in x.above() for x in chosen if x.tag == "article")}
        areas = {e for e in chosen if e.tag != "article"}
        if areas - within and any(areas.intersection(e.above()) for e, _ in blocks):
            articles = {e for e in chosen if e.tag == "article" and areas.intersection(e.above())}
        else:
            articles = {e for e in chosen if e.tag == "article"}
        mains_ = (articles | areas - within) if articles else (areas or chosen)
        inside = self.below(elements, mains_)
        bad = (hinted | tagged) - holders
        weak = {e for e in bad if e in inside and e not in tagged and (e.tag in HEADINGS or e.tag == "p" or not only_bad(e.names))}
        bad -= weak
        free = self.free(elements, bad, inside)
        named = [e for e in elements if e in free and names_content(e)]
        used = {x for e, _ in blocks if e in free for x in e.above()} if not mains_ else set()
        own = [e for e in named if e in used]
        if own and not mains_:
            slot = common_ancestor(own)
            region = self.below(elements, set(own) if slot.tag in ("html", "body", "") else {slot})
        else:
            region = set()
        self.tokens, self.chars, self.ranks, self.texts = [], [], [], []
        for e, t in stream:
            self.tokens.append(e.key if t == "" else ~e.key if t is None else digest(t, e.key) >> 1)
            self.chars.append(len(t or ""))
            self.texts.append(t)
            self.ranks.append(OPEN if t == "" else CLOSE if t is None else 0 if e not in free else 3 if e in inside else 2 if e in region else 1)
        self.best = max([r for r in self.ranks if r > 0], default=0)

    @staticmethod
    def below(elements: list[Element], tops: set[Element]) -> set[Element]:
        """``tops`` and all elements inside them; parents come before their children."""
        found: set[Element] = set()
        for e in elements:
            if e in tops or e.parent in found:
                found.add(e)
        return found

    @staticmethod
    def free(elements: list[Element], bad: set[Element], inside: set[Element]) -> set[Element]:
        """Elements in no bad one. Headings in a header inside the main element are free."""
        free: set[Element] = set()
        headed: set[Element] = set()
        for e in elements:
            if e.parent is None or e.parent in free:
                if e not in bad:
                    free.add(e)
                elif e in inside and (e.tag == "header" or HEADER_WORDS.intersection(words(e.names))):
                    headed.add(e)
            elif e.parent in headed and (e.tag == "header" or e not in bad):
                (free if e.tag in HEADINGS else headed).add(e)
        return free

    @staticmethod
    def swallowing(blocks: list[tuple[Element, str]], hinted: set[Element]) -> set[Element]:
        """Elements that only a name rejects although they hold most of the page's text and nothing outside is named content."""
        size: dict[Element, int] = {}
        whole = 0
        for e, t in blocks:
            above = list(e.above())
            if any(x.tag in BAD_TAGS for x in above):
                continue
            if any(names_content(x) for x in above) and not hinted.intersection(above):
                return set()
            whole += len(t)
            for x in hinted.intersection(above):
                size[x] = size.get(x, 0) + len(t)
        return {x for x, n in size.items() if 2 * n > whole}

    def main_digest(self) -> int:
        return digest("\n".join(t for t, r in zip(self.texts, self.ranks, strict=True) if t and r == self.best)) - (1 << 63)

    def text(self, template: dict | None) -> str:
        """Blocks of the main slots in page order."""
        if template is None:
            return " ".join(t for t, r in zip(self.texts, self.ranks, strict=True) if t and r == self.best and r)
        host: Template = template["classes"]
        named = roles(np.array(self.tokens, np.int64), np.array(self.ranks), template["roots"]).tolist()
        level = template["level"]
        if self.best <= level:
            slots, _ = host.walk(named)
            kept, depth, main = [], 0, template["main"]
            for token, slot, rank, t in zip(named, slots, self.ranks, self.texts, strict=True):
                if main is not None and token in (main, ~main):
                    depth += 1 if token == main else -1
                if t and rank >= level and token not in host.everywhere and (slot in template["slots"] if main is None else depth > 0):
                    kept.append(t)
            if kept:
                return " ".join(kept)
        dropped = host.texts if self.best == 1 else host.everywhere
        return " ".join(t for t, r, k in zip(self.texts, self.ranks, named, strict=True) if t and r and r == self.best and k not in dropped)


def streams(pages: DataFrame) -> DataFrame:
    """A row of ``STREAM`` for each different main text of a host."""
    def run(batches):
        for batch in batches:
            read_ = [Page(h) for h in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([p.main_digest() for p in read_], pa.int64()), pa.array([p.best for p in read_], pa.int32()),
                 pa.array([p.tokens for p in read_], pa.list_(pa.int64())), pa.array([p.chars for p in read_], pa.list_(pa.int32())),
                 pa.array([p.ranks for p in read_], pa.list_(pa.int32()))], names=["host", "main", "best", "token", "chars", "rank"])

    rows = pages.filter("html is not null and url is not null").select(host_of(F.col("url")).alias("host"), "html")
    each = rows.mapInArrow(run, STREAM)
    one = F.struct("best", "token", "chars", "rank")
    # Of pages with one main text the same is taken on every run.
    return each.groupBy("host", "main").agg(F.min_by(one, F.xxhash64("token", "chars", "rank")).alias("s")).select("host", "main", "s.*")


def held(seen: DataFrame, hosts: Hosts) -> DataFrame:
    """``host, token, rank, chars, once``: varying text by slot (``once`` null) and inside each template element."""
    rows = hosts.beside(seen)
    find = hosts.finder(lambda r: (as_array(r["roots"]), Template(r["members"])))

    def run(batches):
        for batch in batches:
            found: dict[tuple, int] = {}
            for j, (host, tokens, chars, ranks) in enumerate(zip(batch.column("host").to_pylist(), *(
                    lists(batch.column(c)) for c in ("token", "chars", "rank")), strict=True)):
                own = find(batch, j, host)
                if own is None:
                    continue
                root, template = own
                named, chars, ranks = roles(tokens, ranks, root).tolist(), chars.tolist(), ranks.tolist()
                slots, _ = template.walk(named)
                open_: list[list[int]] = []
                for token, slot, n, rank in zip(named, slots, chars, ranks, strict=True):
                    if rank == OPEN:
                        open_.append([token, 0])
                    elif rank == CLOSE:
                        inner, total = open_.pop()
                        if open_:
                            open_[-1][1] += total
                        if total and inner in template.once:
                            key = (host, inner, 1, True)
                            found[key] = found.get(key, 0) + total
                    elif rank > 0 and token not in template.texts:
                        open_[-1][1] += n
                        key = (host, slot, rank, None)
                        found[key] = found.get(key, 0) + n
            columns = list(zip(*[(*k, n) for k, n in found.items()], strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (
                pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.int64()), strict=True)], names=["host", "token", "rank", "once", "chars"])

    each = rows.mapInArrow(run, "host string, token bigint, rank int, once boolean, chars bigint")
    return each.groupBy("host", "token", "rank", "once").agg(F.sum("chars").alias("chars"))


def templates(pages: DataFrame) -> DataFrame:
    """Per host with enough pages: ``roots``, ``members`` of valid classes, ``level``, main ``slots`` or the ``main`` element."""
    seen = materialize(streams(pages), "streams")
    roots, members = deduce(seen, SUPPORT, MIN_PAGES, FULL_PAGES)
    known = materialize(members.join(roots, "host", "left"), "template")
    level = seen.groupBy("host", "best").agg(F.count("*").alias("n")).groupBy("host").agg(F.max_by("best", F.struct("n", "best")).alias("level"))
    text = materialize(held(seen, Hosts(known)).join(level, "host"), "held")
    slots = text.filter("once is null").groupBy("host").agg(
        F.collect_list(F.when(F.col("rank") == F.col("level"), F.col("token"))).alias("slots"), F.sum("chars").alias("whole"))
    mains = text.filter("once and level = 1").join(slots, "host").filter(F.col("chars") >= F.col("whole") * MAIN_SHARE).groupBy("host").agg(
        F.min_by("token", F.struct("chars", "token")).alias("main"))
    return known.join(level, "host").join(slots.drop("whole"), "host", "left").join(mains, "host", "left")


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` per page."""
    pages = pages.select("page_id", "url", "html")
    known = materialize(templates(pages), "templates")
    rows = pages.withColumn("host", F.when(F.col("url").isNotNull(), host_of(F.col("url"))))
    hosts = Hosts(known)
    find = hosts.finder(lambda r: {"roots": as_array(r["roots"]), "classes": Template(r["members"]), "level": r["level"],
                                   "slots": frozenset(r["slots"] or ()), "main": r["main"]})
    joined = hosts.beside(rows.select("page_id", "url", "html", "host")).select("page_id", "url", "html", "host", *([] if hosts.shared else hosts.columns))

    def run(batches):
        for batch in batches:
            out = []
            for j, (page, host) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)):
                out.append(Page(page).text(None if host is None else find(batch, j, host)) if page else "")
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.string()),
                                              pa.array([len(t) for t in out], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    kinds = dict(pages.dtypes)
    return joined.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars bigint")


def op1_extract(spark, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
