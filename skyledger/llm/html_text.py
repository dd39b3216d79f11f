"""Main text of web pages: markup first, and what a host's pages repeat for what markup leaves open."""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import written
from skyledger.llm.url_filter import host_and_path
from skyledger.llm.words import STEP, mix

#: Pages are read in bins of about this many bytes and pages, which bounds memory and decides nothing.
BIN_BYTES, BIN_PAGES = 4 << 20, 256
#: Tokens of a repeated substring. Two different pages of a host must hold it, whatever the host's size.
RUN = 8

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(?P<raw>script|style|noscript|template|svg|math|iframe|object|textarea|select|title)\b(?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+(?:>.*?(?:</(?P=raw)\s*>|\Z)|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-z][^\s/>]*+)(?P<attrs>(?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)|<(?:/?[a-z][^>]*+)(?:>|\Z)",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"([a-z-]+)(?:\s*=\s*(\"[^\"]*+\"|'[^']*+'|[^\s>]++))?", re.I)
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " head header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
NOISE_TAGS = frozenset("nav footer aside form head button dialog menu fieldset".split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar".split())
NOISE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar menu nav navbar navigation breadcrumb"
    " breadcrumbs footer header masthead cookie cookies consent gdpr notice popup modal overlay newsletter subscribe signup comment comments"
    " reply replies disqus share sharing social related widget toolbar login search pagination pager copyright".split()
)
#: Names of reader comments, which hold articles and headings of their own, and of articles that only point to others.
REMARKS = frozenset("comment comments disqus replies".split())
POINTERS = REMARKS | frozenset("ad ads advert advertisement related reply teaser teasers promo".split())
#: Names that an article's own paragraphs bear too: there they raise doubt.
SOFT = frozenset("copyright header reply search".split())
#: Words that say nothing beside another: ``comment-list`` is a name for comments, ``share-price`` none for sharing.
CONTAINERS = frozenset(
    "area article articles block body box button buttons container content entry form group inner item items link links list main module page panel"
    " post posts section site stories story text title unit wrap wrapper".split()
)
#: Elements that carry a page's text; a noise word within a longer name says nothing about them.
TEXTUAL = frozenset("p span a b i em strong li dd dt td th blockquote pre code figure figcaption".split())
NAMELESS, WEAK, STRONG = 0, 1, 2
#: Elements that a start tag of the same group closes when it was left open.
CLOSED_BY = {"p": BLOCKS - {"body", "html", "head"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option"}}
MAIN, OPEN, DOUBT, NOISE = "main", "open", "doubt", "noise"


def _names(attrs: dict[str, str]) -> Iterator[set[str]]:
    """The words of each class and of the id: ``commentList`` and ``comment_list`` are comment and list."""
    for name in attrs.get("class", "").split() + attrs.get("id", "").split():
        yield set(re.split(r"[^a-z]+", re.sub(r"(?<=[a-z])(?=[A-Z])", "-", name).lower())) - {""}


def _role(tag: str, attrs: str, inside: str) -> tuple[str, int]:
    """Whether an element starts main text or noise, or is what its parent is, and how strongly its name alone speaks for noise.

    A name speaks strongly if all its words are noise names or containers, weakly if some are noise names.
    """
    if inside == NOISE or tag in NOISE_TAGS:
        return NOISE, NAMELESS
    found = {k.lower(): (v or "").strip("\"'") for k, v in ATTRIBUTE.findall(attrs)} if attrs.strip(" /") else {}
    role = found.get("role", "").lower()
    if role in NOISE_ROLES or "hidden" in found or found.get("aria-hidden", "").lower() == "true":
        return NOISE, NAMELESS
    names = [words for words in _names(found) if words & (NOISE_NAMES | POINTERS)]
    whole = [words for words in names if words <= NOISE_NAMES | POINTERS | CONTAINERS]
    if tag in ("article", "main") or role == "main":
        return NOISE if tag == "article" and any(words & POINTERS for words in whole) else MAIN, NAMELESS
    if tag in HEADINGS or tag in ("body", "html"):
        return inside, NAMELESS
    if any(words & REMARKS for words in whole):
        return NOISE, NAMELESS
    names, whole = ([words for words in some if words & NOISE_NAMES] for some in (names, whole))
    if any(inside == OPEN or words & NOISE_NAMES - SOFT for words in whole):
        named = STRONG
    else:
        named = WEAK if names and (inside != OPEN or tag not in TEXTUAL) else NAMELESS
    if tag == "header":
        return ("heading" if inside == MAIN else NOISE), named
    return inside, named


def blocks(page: str) -> list[tuple[str, str]]:
    """(role, text) of a page's blocks in order.

    An element whose class or id alone speaks for noise is noise, unless it holds an
    article, a main element or a heading: then what it holds is in doubt inside an
    article, and is outside of articles what it would be without the name. Outside, of
    headings only an h1 outweighs a whole name such as ``sidebar``; inside, a noise word
    within a longer name, such as ``share-price``, only raises doubt. Elements named for
    comments are noise whatever they hold, and so are articles named as comments or
    teasers. An article within an article is what the element around it is.

    Start and end tags nest as far as they do: an end tag closes up to its element or is
    ignored, a paragraph ends where a block begins, whatever inline elements are open in it,
    and what is open at the end of a cut page is closed there. The time grows with the
    length of a page, however many elements it leaves open. Comments, scripts, styles and the like hold no text.
    """
    out: list[tuple[str, str, int]] = []
    stack: list[tuple[str, str, int]] = []
    opened: Counter[str] = Counter()  # open elements by tag
    outer: list[int] = []  # places of the open blocks in the stack
    # Of each element with such a name, the one around it, whether it or one around it has a strong name, and whether what
    # it holds outweighs the name. What clears an element clears those around it, so the innermost one answers for all.
    above: list[int] = []
    strong: list[bool] = []
    cleared: list[bool] = []
    state, named, text, last = OPEN, -1, [], 0

    def close(k: int) -> None:
        while len(stack) > k:
            opened[stack.pop()[0]] -= 1
        while outer and outer[-1] >= k:
            outer.pop()

    def flush() -> None:
        if text:
            words = html.unescape("".join(text)).split()
            text.clear()
            if words:
                role = NOISE if state == "heading" and not any(opened[t] for t in HEADINGS) else MAIN if state == "heading" else state
                out.append((role, " ".join(words), named))

    for found in TOKEN.finditer(page):
        if found.start() > last:
            text.append(page[last : found.start()])
        last = found.end()
        tag = found["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if tag in BLOCKS:
            flush()
        elif tag == "br":
            text.append(" ")
        if found["end"]:
            if opened[tag]:
                k = len(stack) - 1
                while stack[k][0] != tag:
                    k -= 1
                close(k)
                state, named = stack[-1][1:] if stack else (OPEN, -1)
        elif tag not in VOID:
            if outer and tag in CLOSED_BY.get(stack[outer[-1]][0], ()):
                close(outer[-1])
                state, named = stack[-1][1:] if stack else (OPEN, -1)
            before = state
            state, by_name = _role(tag, found["attrs"], state)
            starts = state == MAIN and (before != MAIN or (tag in ("article", "main") and not opened["article"]))
            k = named
            if starts or (tag in HEADINGS and state != NOISE and (state != OPEN or tag == "h1" or (k >= 0 and not strong[k]))):
                while k >= 0 and not cleared[k]:
                    cleared[k], k = True, above[k]
            if starts:
                named = -1
            elif by_name and state != NOISE:
                above.append(named)
                strong.append(by_name == STRONG or (named >= 0 and strong[named]))
                cleared.append(False)
                named = len(cleared) - 1
            if tag in BLOCKS:
                outer.append(len(stack))
            opened[tag] += 1
            stack.append((tag, state, named))
    text.append(page[last:])
    flush()

    def settled_role(role: str, k: int) -> str:
        if k < 0 or role == NOISE:
            return role
        if role == MAIN:
            return DOUBT if cleared[k] or not strong[k] else NOISE
        return role if cleared[k] else NOISE

    return [(settled_role(role, k), words) for role, words, k in out]


class Hashes(dict):
    """64-bit hashes of tokens, each computed once."""

    def __missing__(self, token: str) -> int:
        self[token] = value = xxhash.xxh64_intdigest(token.encode("utf-8", "surrogatepass"))
        return value


def run_keys(host: int, tokens: list[str], hashes: Hashes) -> np.ndarray:
    """A 64-bit key of each run of ``RUN`` tokens, by the place where it starts; other hosts have other keys."""
    n = len(tokens) - RUN + 1
    if n < 1:
        return np.empty(0, dtype=np.int64)
    each, rolled = np.array([hashes[t] for t in tokens], dtype=np.uint64), np.zeros(n, dtype=np.uint64)
    for i in range(RUN):
        rolled = rolled * STEP + each[i : n + i]
    return mix(mix(rolled) ^ np.uint64(host & (1 << 64) - 1)).view(np.int64)


def stream(roles: Iterable[str], texts: Iterable[str]) -> list[str]:
    """The tokens of a page that tell and know what its host repeats: all but those of articles, which may share passages."""
    return [t for role, text in zip(roles, texts) if role != MAIN for t in text.split(" ")]


def _words(found: Iterable[tuple[str, str]], role: str) -> int:
    return sum(text.count(" ") + 1 for r, text in found if r == role)


def settled(found: list[tuple[str, str]]) -> str | None:
    """The main text of a page, if it is the same whatever other pages repeat."""
    if any(role == DOUBT for role, _ in found) or _words(found, OPEN) > _words(found, MAIN):
        return None
    return "\n".join(text for role, text in found if role == MAIN)


def _fringes(covered: np.ndarray) -> np.ndarray:
    """``covered`` without the fringes of runs that end or start in a neighbouring block: stretches below ``RUN`` tokens in a block that has others."""
    edges = np.flatnonzero(np.diff(np.r_[False, covered, False].astype(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    out = covered.copy()
    for a, b in zip(starts.tolist(), ends.tolist()):
        if b - a < min(RUN, len(covered)):
            out[a:b] = False
    return out


def unrepeated(roles: Iterable[str], texts: Iterable[str], covered: np.ndarray) -> str:
    """The main text of a page whose stream's tokens lie in repeated runs where ``covered``.

    Of a block go whole runs, or all of it; a word that follows a repeated block in both pages stays.
    """
    kept, at = [], 0
    for role, text in zip(roles, texts):
        if role != MAIN:
            words = text.split(" ")
            old = _fringes(covered[at : at + len(words)])
            at += len(words)
            text = " ".join(w for w, again in zip(words, old) if not again)
        if text and role != NOISE:
            kept.append((role, text))
    beside = _words(kept, OPEN) > _words(kept, MAIN)
    return "\n".join(text for role, text in kept if role != OPEN or beside)


def _parsed(rows: DataFrame) -> DataFrame:
    """Each page with its bin, its text where it is settled, and the blocks that its stream or its text needs."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number, size, count = TaskContext.get().partitionId() << 33, 0, 0
        for batch in batches:
            bins, done, roles, texts = [], [], [], []
            for page in batch["html"]:
                if size >= BIN_BYTES or count >= BIN_PAGES:
                    number, size, count = number + 1, 0, 0
                size, count = size + len(page), count + 1
                found = blocks(page)
                bins.append(number)
                done.append(settled(found))
                held = [(role, text) for role, text in found if done[-1] is None or role != MAIN]
                roles.append([role for role, _ in held])
                texts.append([text for _, text in held])
            ids = batch["page_id"].astype("Int64")
            yield batch[["url", "host", "page"]].assign(page_id=ids, bin=bins, text=done, roles=roles, texts=texts)

    kind = "page_id long, url string, host long, page long, bin long, text string, roles array<string>, texts array<string>"
    return rows.mapInPandas(run, kind)


def _runs(parsed: DataFrame) -> DataFrame:
    """The runs of each bin, each once, with the least and the greatest of the pages that hold it."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for number, part in batch.groupby("bin", sort=False):
                hashes = Hashes()
                keys = [run_keys(int(host), stream(*blocks), hashes) for host, *blocks in zip(part["host"], part["roles"], part["texts"])]
                pages = np.repeat(part["page"].to_numpy(dtype=np.int64), [len(k) for k in keys])
                keys = np.concatenate(keys)
                order = np.lexsort((pages, keys))
                keys, pages = keys[order], pages[order]
                first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]][: len(keys)])
                last = np.r_[first[1:], len(keys)][: len(first)] - 1
                yield pd.DataFrame({"bin": number, "key": keys[first], "least": pages[first], "most": pages[last]})

    return parsed.select("bin", "host", "page", "roles", "texts").mapInPandas(run, "bin long, key long, least long, most long")


def _unsettled(pages: pd.DataFrame, runs: pd.DataFrame) -> pd.DataFrame:
    """The texts of the open pages of one bin, given the runs of the bin that their hosts repeat."""
    found, hashes, texts = np.sort(runs["key"].to_numpy(dtype=np.int64)), Hashes(), []
    for host, *blocks in zip(pages["host"], pages["roles"], pages["texts"]):
        tokens = stream(*blocks)
        hits = np.flatnonzero(np.isin(run_keys(int(host), tokens, hashes), found))
        starts = np.zeros(len(tokens) + 1, dtype=np.int64)
        np.add.at(starts, hits, 1)
        np.add.at(starts, hits + RUN, -1)
        texts.append(unrepeated(*blocks, np.cumsum(starts)[:-1] > 0))
    return pages[["url"]].assign(page_id=pages["page_id"].astype("Int64"), text=texts)[["page_id", "url", "text"]]


def extracted(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` (code points) for every row of ``pages``.

    Null and empty html gives an empty text. Menus, headers, footers, sidebars, notices,
    adverts, forms and comments are known by their element, role, class or id. What else an
    article or main element holds is text, whole: articles may share passages, and
    adverts may be unique, so repetition decides nothing there. All other blocks of
    every page, noise too, form the page's token stream. A run of ``RUN`` tokens that
    the streams of two different pages of the host hold is removed where markup leaves
    doubt: from open blocks, and from elements that a name alone calls noise though they
    hold an article or a heading (``blocks``). Open blocks stay if what is left of them
    has more words than the page's articles; beside a larger article they go.

    Runs are counted over the whole host: suffixes with a common beginning, neighbours in
    the host's suffix array, meet by a 64-bit hash of host and beginning. Each bin sends a
    run once, with the least and the greatest hash of its pages' html; where these differ
    over all bins, two pages hold it (copies of one html are one page and do not delete
    each other). The runs found go back to the bins that hold them. No host is one task,
    and neither bins nor the size of a host change a result. Null urls are one host; pages
    that repeat an id are pages of their own; other columns are ignored.
    """
    host, _ = host_and_path(F.col("url"))
    rows = pages.select("page_id", "url", F.xxhash64(host).alias("host"), F.coalesce("html", F.lit("")).alias("html"))
    parsed = written(_parsed(rows.withColumn("page", F.xxhash64("html"))), "parsed")
    counts = _runs(parsed.where("size(texts) > 0")).groupBy("key").agg(F.min("least").alias("least"), F.max("most").alias("most"))
    repeated = written(counts.where("least < most").select("key"), "repeated")

    unsettled = parsed.where("text IS NULL")
    asked = _runs(unsettled).select("bin", "key").join(repeated, "key", "left_semi")
    texts = unsettled.groupBy("bin").cogroup(asked.groupBy("bin")).applyInPandas(_unsettled, "page_id long, url string, text string")
    columns = ["page_id", "url", "text"]
    out = parsed.where("text IS NOT NULL").select(*columns).unionByName(texts)
    return out.select(*columns, F.length("text").cast("long").alias("n_chars"))
