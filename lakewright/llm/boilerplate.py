"""Main text of web pages: markup cues, and what pages of one host have in common.

Pages are cut into blocks of text.  All words outside of article and main
elements, menus, headers, sidebars, notices, adverts and footers included, form
one token stream of the page, those inside the other.  Both kinds of streams of
a host's pages are sorted as suffix arrays, and runs of tokens that distinct
pages share are boilerplate and are cut out: outside if a few pages have them,
inside if most articles of the host do, as others may quote an article.  Markup
cues settle what repetition can't: furniture that only one page has is no text.
Where the unrepeated prose outside far outweighs the articles, these are teasers.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mixed, shared_folder, stored

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>?|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>|[^>]*+(?:>|\Z))",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
RAW = {name: re.compile(rf"</{name}\s*>", re.IGNORECASE) for name in ("script", "style", "textarea", "title", "noscript", "iframe", "noembed", "xmp")}
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
LEFT_OUT = frozenset("nav aside footer form button select option optgroup template svg math canvas object audio video dialog menu datalist noframes applet map head".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split())
MAIN = frozenset(("article", "main"))
HINTS = frozenset(
    "nav navbar navigation menu sidebar aside ad ads adv advert adverts advertisement advertising banner promo promotion promoted sponsor sponsored cookie cookies consent gdpr notice notices alert popup modal overlay"
    " newsletter subscribe subscription signup share sharing social comment comments disqus reply replies respond related recommended recommendations breadcrumb breadcrumbs footer header masthead pagination pager widget"
    " toolbar login paywall outbrain taboola".split()
)
#: Hints at readers' comments; of an article's own hints only these count, as its class may name its topics and state.
COMMENTS = frozenset("comment comments disqus reply replies respond".split())
#: Words before any hint word that turn it into a layout switch ("has-sidebar"), and words after a comment word that do ("comments-open").
SWITCHES = frozenset("has with no without".split())
STATES = frozenset("open closed enabled disabled on off".split())
#: Words before header and footer that make it part of an article ("entry-header").
PARTS = frozenset("article post entry section content story title".split())
PART_ENDS = {"header": PARTS | {"page"}, "masthead": PARTS | {"page"}, "footer": PARTS}
#: Words of the shortest shared run: anywhere, and as whole blocks.  Distinct page contents of a host that share it, for hosts of all sizes.
RUN, BLOCK_RUN, LEAST_PAGES = 10, 5, 3
CHUNK_TOKENS = 2_000_000
MAIN_ZONE, OTHER_ZONE, CUE_ZONE = 0, 1, 2
#: Articles of a host, different ones, whose shared runs are furniture if more than half of them have the run.
LEAST_ARTICLES = 4
#: An article is no main text beside so many times its words of prose that no other page has.
OUTWEIGHED = 3
#: Elements left out whose words can be seen, and so can be found on other pages.
LAYOUT = frozenset("nav aside footer header".split())


def _hint(words: list[str], i: int) -> bool:
    """Whether word ``i`` of a class or id says that the element is no part of a main text."""
    before, after = words[i - 1] if i else "", words[i + 1] if i + 1 < len(words) else ""
    return words[i] in HINTS and before not in SWITCHES and before not in PART_ENDS.get(words[i], ()) and not (words[i] in COMMENTS and after in STATES)


def _left_out(name: str, attributes: str) -> bool:
    """Whether an element is no part of a main text, by its name and attributes."""
    if name in LEFT_OUT:
        return True
    if "=" not in attributes and "hidden" not in attributes.lower():
        return False
    values = {m[0].lower(): html.unescape(m[1] or m[2] or m[3]).lower() for m in ATTRIBUTE.findall(attributes)}
    if values.get("role") in ROLES or "hidden" in values or values.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", values.get("style", "")):
        return True
    if name in ("html", "body", "main") or values.get("role") == "main":
        return False
    hints = COMMENTS if name == "article" or values.get("role") == "article" else HINTS
    for label in f"{values.get('class', '')} {values.get('id', '')}".split():
        words = [w for w in re.split(r"[-_]+", label) if w]
        if any(w in hints and _hint(words, i) for i, w in enumerate(words)):
            return True
    return False


def _layout(name: str, attributes: str) -> bool:
    """Whether an element that is left out is page furniture to be seen, and neither a form, hidden nor readers' comments."""
    if name in INLINE or name in RAW or name in LEFT_OUT - LAYOUT:
        return False
    values = {m[0].lower(): html.unescape(m[1] or m[2] or m[3]).lower() for m in ATTRIBUTE.findall(attributes)}
    if "hidden" in values or values.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", values.get("style", "")):
        return False
    return not COMMENTS.intersection(re.split(r"[-_\s]+", f"{values.get('class', '')} {values.get('id', '')}"))


def blocks(page: str) -> list[tuple[int, int, str]]:
    """The blocks of text that no cue leaves out."""
    return [b for b in all_blocks(page) if b[0] != CUE_ZONE]


def all_blocks(page: str) -> list[tuple[int, int, str]]:
    """(zone, characters in links, text) of each block of text that can be seen, in page order.

    The zone is MAIN_ZONE inside article and main elements (articles only, if
    there are any), CUE_ZONE where a cue says that it is no main text, else
    OTHER_ZONE.  Elements that are never closed leave nothing out.
    """
    tokens, at, end = [], 0, len(page)
    while at < end:
        m = TOKEN.search(page, at)
        if not m:
            break
        if m.start() > at:
            tokens.append(("", "", page[at : m.start()]))
        at = m.end()
        if m[2]:
            name = m[2].lower()
            tokens.append(("/" if m[1] else "<", name, m[3][:-1]))
            if not m[1] and name in RAW and not m[3].endswith("/>"):
                closing = RAW[name].search(page, at)
                at = closing.end() if closing else end
    if at < end:
        tokens.append(("", "", page[at:]))

    # the closing token of each element, by matching names
    closes, open_at = {}, {}
    for i, (kind, name, rest) in enumerate(tokens):
        if kind == "<" and name not in VOID and not rest.endswith("/"):
            open_at.setdefault(name, []).append(i)
        elif kind == "/" and open_at.get(name):
            closes[open_at[name].pop()] = i

    has_article, open_zones = False, {}
    out, text, linked, zones, links, skip, cued = [], [], 0, [], 0, -1, -1

    def flush() -> None:
        nonlocal text, linked
        if text:
            joined = " ".join("".join(text).split())
            if joined:
                out.append((-1 if i <= cued else 2 if "article" in zones else 1 if "main" in zones else 0, linked, joined))
        text, linked = [], 0

    for i, (kind, name, rest) in enumerate(tokens):
        if i <= skip:
            continue
        if not kind:
            text.append(html.unescape(rest))
            linked += len(rest) if links > 0 else 0
        elif kind == "<":
            if name not in INLINE:
                flush()
            if i in closes:
                header = name == "header" and "article" not in zones
                if header or name in RAW or _left_out(name, rest):
                    flush() if name not in INLINE else text.append(" ")
                    if _layout(name, rest):
                        cued = max(cued, closes[i])
                    else:
                        skip = closes[i]
                    continue
                if i < cued:
                    continue
                if name in MAIN or re.search(r"role\s*=\s*[\"']?(?:main|article)\b|itemprop\s*=\s*[\"']?articleBody", rest):
                    zone = "main" if name == "main" or "main" in rest.lower() and name != "article" else "article"
                    has_article |= zone == "article"
                    zones.append(zone)
                    open_zones[closes[i]] = zone
                links += name == "a"
        else:
            if name not in INLINE:
                flush()
            if i in open_zones:
                zones.remove(open_zones.pop(i))
            links = max(0, links - (name == "a"))
    i = len(tokens)
    flush()
    least = 2 if has_article and any(z == 2 for z, _, _ in out) else 1
    return [(CUE_ZONE if z < 0 else MAIN_ZONE if z >= least else OTHER_ZONE, n, t) for z, n, t in out]


def suffix_array(tokens: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Start positions of all suffixes of a concatenation in their order, by prefix doubling.

    ``ends`` holds for each position the end of its stream, where its suffix
    ends too; of equal suffixes the earlier stands first.
    """
    n, at = len(tokens), np.arange(len(tokens))
    _, rank, sizes = np.unique(tokens, return_inverse=True, return_counts=True)
    # a rank is the number of suffixes before those with the same first tokens; only ties are sorted further
    still, rank = at[sizes[rank] > 1], (np.cumsum(sizes) - sizes)[rank]
    length, longest = 1, int((ends - at).max(initial=0))
    while length < longest and len(still):
        ahead = np.zeros(len(still), np.int64)
        inside = still + length < ends[still]
        ahead[inside] = rank[still[inside] + length] + 1
        order = np.argsort(rank[still] * (n + 2) + ahead)
        still, ahead = still[order], ahead[order]
        old, place = rank[still], np.arange(len(still))
        other = np.concatenate([[True], old[1:] != old[:-1]])
        new = other | np.concatenate([[True], ahead[1:] != ahead[:-1]])
        rank[still] = old + np.maximum.accumulate(np.where(new, place, 0)) - np.maximum.accumulate(np.where(other, place, 0))
        still = still[~(new & np.append(new[1:], True))]
        length *= 2
    return np.argsort(rank, kind="stable")


def suffix_groups(tokens: np.ndarray, ends: np.ndarray, run: int) -> np.ndarray:
    """Group number of every suffix of a concatenation, equal for suffixes with the same first ``run`` tokens.

    The groups are the stretches of the suffix array in which neighbours have
    ``run`` tokens in common.  A suffix with fewer tokens before its stream's
    end gets -1, so no run crosses two streams.
    """
    order = suffix_array(tokens, ends)
    order = order[order + run <= ends[order]]
    same = np.ones(max(0, len(order) - 1), bool)
    for i in range(run):
        same &= tokens[order[1:] + i] == tokens[order[:-1] + i]
    group = np.full(len(tokens), -1, np.int64)
    group[order] = np.cumsum(np.concatenate([np.ones(min(1, len(order)), bool), ~same]))
    return group


PARSED_SCHEMA = "page long, page_id long, url string, host string, whole long, main string, doubtful boolean, texts array<string>, links array<int>, cues array<boolean>"
GROUP_SCHEMA = "host string, run long, pages long, places binary"


def host_of(url: str | None) -> str:
    m = re.match(r"[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", url or "")
    return m[1].lower() if m else ""


def _parsed(pages: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            rows = []
            for page_id, url, page in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found = all_blocks(page or "")
                main = [t for z, _, t in found if z == MAIN_ZONE]
                rest = [b for b in found if b[0] != MAIN_ZONE]
                whole = xxhash.xxh3_64_intdigest("\n".join(t for _, _, t in found).encode("utf-8", "replace")) - (1 << 63)
                outside = sum(t.count(" ") + 1 for z, n, t in rest if z == OTHER_ZONE and _prose(t, n))
                doubtful = outside > OUTWEIGHED * sum(t.count(" ") + 1 for t in main)
                rows.append((number, page_id, url, host_of(url), whole, " ".join(main) if main else None, doubtful, [t for _, _, t in rest], [min(n, 1 << 30) for _, n, _ in rest], [z == CUE_ZONE for z, _, _ in rest]))
                number += 1
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.bool_(), pa.list_(pa.string()), pa.list_(pa.int32()), pa.list_(pa.bool_()))
            names = [f.split()[0] for f in PARSED_SCHEMA.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)

    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")).mapInArrow(run, PARSED_SCHEMA)


def block_runs(texts: list[str]) -> list[tuple[int, int, int]]:
    """(hash, start, words) of the fewest whole blocks from each block on that have BLOCK_RUN words, in words of the stream."""
    sizes = [t.count(" ") + 1 for t in texts]
    out, start, words, end = [], 0, 0, 0
    for i, size in enumerate(sizes):
        while words < BLOCK_RUN and end < len(sizes):
            words, end = words + sizes[end], end + 1
        if words < BLOCK_RUN:
            break
        out.append((xxhash.xxh3_64_intdigest("\n".join(texts[i:end]).encode()), start, words))
        start, words = start + size, words - size
    return out


def word_hashes(words: list[str]) -> np.ndarray:
    codes, known = pd.factorize(np.asarray(words, object))
    return np.fromiter((xxhash.xxh3_64_intdigest(w.encode("utf-8", "replace")) for w in known), np.uint64, len(known))[codes]


def run_values(hashes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A hash of the RUN tokens from each of the places on."""
    value = np.zeros(len(at), np.uint64)
    for i in range(RUN):
        value = mixed(value ^ hashes[at + i], i + 1)
    return value.astype(np.int64)


def _runs(streams: DataFrame) -> DataFrame:
    """Suffix arrays over bounded chunks of token streams: each chunk's distinct runs by host.

    A run is the first RUN tokens of a suffix, or a few whole blocks.  Its row
    counts the chunk's pages that have it and lists in which streams and where,
    with its length.  A stream is in one chunk only, so the counts of all chunks
    of a host add up.
    """

    def chunk(streams: list[tuple[int, str, list[str], int]]) -> pd.DataFrame:
        split = [[w for t in texts for w in t.split(" ")] for _, _, texts, _ in streams]
        hashes = word_hashes([w for words in split for w in words])
        sizes = np.fromiter(map(len, split), np.int64, len(split))
        first = np.cumsum(sizes) - sizes
        hosts, host_at = np.unique(np.asarray([h for _, h, _, _ in streams], object).astype(str), return_inverse=True)
        group = suffix_groups(hashes, np.repeat(np.cumsum(sizes), sizes), RUN)
        own = np.flatnonzero(group >= 0)
        owner = np.repeat(np.arange(len(streams)), sizes)[own]
        value = run_values(hashes, own)
        whole = [(i, *r) for i, (_, _, texts, _) in enumerate(streams) for r in block_runs(texts)]
        column = lambda i, kind: np.fromiter((w[i] for w in whole), kind, len(whole))
        group = np.concatenate([group[own], len(hashes) + 1 + np.unique(column(1, np.uint64), return_inverse=True)[1]])
        value = np.concatenate([value, mixed(column(1, np.uint64), RUN + 1).astype(np.int64)])
        start, length = np.concatenate([own - first[owner], column(2, np.int64)]), np.concatenate([np.full(len(own), RUN), column(3, np.int64)])
        owner = np.concatenate([owner, column(0, np.int64)])
        if not len(group):
            return pd.DataFrame(columns=["host", "run", "pages", "places"])
        order = np.lexsort((start, owner, host_at[owner], group))
        g, h = group[order], host_at[owner[order]]
        starts = np.flatnonzero(np.concatenate([[True], (g[1:] != g[:-1]) | (h[1:] != h[:-1])]))
        pages, copies = np.asarray([p for p, _, _, _ in streams], np.int64), np.asarray([n for _, _, _, n in streams], np.int64)
        places = np.stack([pages[owner], start, length], axis=1)[order]
        again = np.concatenate([[False], (owner[order][1:] == owner[order][:-1])])
        again[starts] = False
        cuts = np.append(starts, len(order))
        return pd.DataFrame(
            {
                "host": hosts[h[starts]],
                "run": value[order][starts],
                "pages": np.add.reduceat(np.where(again, 0, copies[owner[order]]), starts),
                "places": [places[a:b].astype("<i8").tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)],
            }
        )

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        streams, size = [], 0
        for df in frames:
            for page, host, texts, copies in zip(df["page"], df["host"], df["texts"], df["copies"], strict=True):
                streams.append((page, host, list(texts), copies))
                size += sum(t.count(" ") + 1 for t in texts)
                if size >= CHUNK_TOKENS:
                    yield chunk(streams)
                    streams, size = [], 0
        if streams:
            yield chunk(streams)

    return streams.select("page", "host", "texts", "copies").mapInPandas(run, GROUP_SCHEMA)


def merged(spans: np.ndarray) -> np.ndarray:
    """Spans (start, words) as the fewest spans that cover the same, in order."""
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    ends = np.maximum.accumulate(spans.sum(axis=1))
    new = np.concatenate([[True], spans[1:, 0] > ends[:-1]])
    starts = spans[new, 0]
    return np.stack([starts, np.append(ends[np.flatnonzero(new)[1:] - 1], ends[-1]) - starts], axis=1)


def _covered(parsed: DataFrame, folder: str) -> DataFrame:
    """(content, spans, shared, only): for each distinct stream the (start, words) of its runs that its host's pages share, and how many words that are.

    ``content`` is a digest of a stream and its host; equal streams are sorted
    once and count as many pages as there are distinct pages that have them
    (copies of a page count once).  ``only`` marks the stream of a host that has
    nothing but copies of one page.
    """
    some = parsed.filter(F.size("texts") > 0)
    copies = some.select("content", "whole").distinct().groupBy("content").agg(F.count("*").alias("copies"))
    streams = stored(some.select("page", "host", "content", "texts").dropDuplicates(["content"]).join(copies, "content"), f"{folder}/streams")
    runs = stored(_runs(streams), f"{folder}/runs")
    common = runs.groupBy("host", "run").agg(F.sum("pages").alias("pages")).filter(F.col("pages") >= LEAST_PAGES).select("host", "run")

    def places(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in frames:
            if len(df):
                both = np.concatenate([np.frombuffer(p, "<i8").reshape(-1, 3) for p in df["places"]])
                both = both[np.argsort(both[:, 0], kind="stable")]
                pages, starts = np.unique(both[:, 0], return_index=True)
                yield pd.DataFrame({"page": pages, "spans": [merged(x[:, 1:]).ravel() for x in np.split(both, starts[1:])]})

    def whole(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in frames:
            spans = [merged(np.concatenate([np.asarray(x, np.int64).reshape(-1, 2) for x in parts])) for parts in df["parts"]]
            yield pd.DataFrame({"content": df["content"], "spans": [x.ravel() for x in spans], "shared": [int(x[:, 1].sum()) for x in spans]})

    found = runs.join(common, ["host", "run"], "left_semi").select("places").mapInPandas(places, "page long, spans array<long>")
    parts = found.groupBy("page").agg(F.collect_list("spans").alias("parts")).join(streams.select("page", "content"), "page")
    spans = parts.select("content", "parts").mapInPandas(whole, "content long, spans array<long>, shared long")
    only = some.groupBy("host").agg(F.min("whole").alias("whole"), F.max("whole").alias("other"), F.min("content").alias("content"), F.count("*").alias("pages")).filter((F.col("whole") == F.col("other")) & (F.col("pages") >= LEAST_PAGES))
    return stored(spans.join(only.select("content", F.lit(True).alias("only")), "content", "full"), f"{folder}/covered")


def article_candidates(streams: list[tuple[str, np.ndarray]]) -> pd.DataFrame:
    """Runs that may stand in most articles of a host, by one suffix array over articles (host, words' hashes) in the order of their hosts.

    All articles of a host between the first and the last one are here, so its
    runs are counted; of these two, the runs that over a quarter have.
    """
    sizes = np.fromiter((len(words) for _, words in streams), np.int64, len(streams))
    hashes = np.concatenate([words for _, words in streams]).astype(np.uint64)
    group = suffix_groups(hashes, np.repeat(np.cumsum(sizes), sizes), RUN)
    own = np.flatnonzero(group >= 0)
    owner = np.repeat(np.arange(len(streams)), sizes)[own]
    host_at, hosts = pd.factorize(np.asarray([h for h, _ in streams], object))
    articles = np.bincount(host_at, minlength=len(hosts))
    order = np.lexsort((own, owner, group[own]))
    own, owner = own[order], owner[order]
    g, h = group[own], host_at[owner]
    starts = np.flatnonzero(np.concatenate([[True] * min(1, len(g)), (g[1:] != g[:-1]) | (h[1:] != h[:-1])]).astype(bool))
    if not len(starts):
        return pd.DataFrame(columns=["host", "run", "has", "of"])
    again = np.concatenate([[False], owner[1:] == owner[:-1]])
    again[starts] = False
    has, of = np.add.reduceat((~again).astype(np.int64), starts), articles[h[starts]]
    border = (h[starts] == 0) | (h[starts] == len(hosts) - 1)
    live = np.where(border, 4 * has > of, (2 * has > of) & (has >= LEAST_ARTICLES))
    return pd.DataFrame({"host": hosts[h[starts[live]]], "run": run_values(hashes, own[starts[live]]), "has": has[live], "of": of[live]})


def _article_cuts(parsed: DataFrame, folder: str) -> DataFrame:
    """(page, cuts): starts of the runs in a page's article that more than half of the host's different articles have.

    Articles are sorted by suffix arrays in the order of their hosts, chunk by
    chunk.  A run is counted over all articles if those chunks where more than a
    quarter of the articles have it, and a quarter of the others, could make a half.
    """
    # words travel as hashes of 32 bits, ten of them in a run
    words = F.transform(F.split("main", " "), lambda w: F.hash(w))
    articles = parsed.filter("main IS NOT NULL").select("page", "host", F.xxhash64("main").alias("story"), words.alias("words"))
    hosts = articles.select("host", "story").distinct().groupBy("host").agg(F.count("*").alias("stories")).filter(F.col("stories") >= LEAST_ARTICLES)

    def chunks(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        streams, size, last = [], 0, None
        for df in frames:
            for host, story, words in zip(df["host"], df["story"], df["words"], strict=True):
                if (host, story) == last:
                    continue
                last = (host, story)
                streams.append((host, words))
                size += len(words)
                if size >= CHUNK_TOKENS:
                    yield article_candidates(streams)
                    streams, size = [], 0
        if streams:
            yield article_candidates(streams)

    sorted_ = articles.select("host", "story", "words").repartitionByRange("host", "story").sortWithinPartitions("host", "story")
    found = sorted_.mapInPandas(chunks, "host string, run long, has long, of long").groupBy("host", "run").agg(F.sum("has").alias("has"), F.sum("of").alias("of"))
    candidates = stored(found.join(hosts, "host").filter("4 * has + stories - of > 2 * stories").select("host", "run"), f"{folder}/candidates")

    def places(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in frames:
            for page, host, story, words in zip(df["page"], df["host"], df["story"], df["words"], strict=True):
                at = np.arange(len(words) - RUN + 1)
                yield pd.DataFrame({"page": page, "host": host, "story": story, "run": run_values(words.astype(np.uint64), at), "start": at})

    some = articles.join(candidates.select("host").distinct(), "host", "left_semi")
    placed = some.mapInPandas(places, "page long, host string, story long, run long, start long").join(candidates, ["host", "run"], "left_semi")
    placed = stored(placed, f"{folder}/placed")
    common = placed.groupBy("host", "run").agg(F.count_distinct("story").alias("has")).join(hosts, "host").filter((2 * F.col("has") > F.col("stories")) & (F.col("has") >= LEAST_ARTICLES))
    return stored(placed.join(common.select("host", "run"), ["host", "run"], "left_semi").groupBy("page").agg(F.collect_list("start").alias("cuts")), f"{folder}/cuts")


def kept_article(main: str, cuts: Sequence[int] | None) -> str:
    """An article without the shared runs that start at the given words; whole if they make more than half of it, as it is a copy then."""
    words = main.split(" ")
    free = np.ones(len(words), bool)
    for i in [] if cuts is None else cuts:
        free[i : i + RUN] = False
    return main if 2 * free.sum() < len(words) else " ".join(w for w, keep in zip(words, free, strict=True) if keep)


def _prose(text: str, linked: int) -> bool:
    """Whether a block has ten and more words, ends like a sentence, and is not mostly links."""
    return text.count(" ") >= 9 and 2 * linked < len(text) and text.rstrip("\"')\u201d\u00bb")[-1:] in (".", "!", "?", "\u2026", "\u3002")


def kept_blocks(texts: list[str], links: list[int], spans: np.ndarray, only: bool = False, cues: Sequence[bool] = ()) -> list[str]:
    """The words of the blocks that neither a shared run, given as (start, words), covers nor a cue leaves out.

    With ``only`` there is no other page to compare with: of a host's one
    content, what stands between its first and last prose stays, or all if it
    has none.
    """
    cues = list(cues) or [False] * len(texts)
    if only:
        texts, links = ([x for x, cue in zip(some, cues, strict=True) if not cue] for some in (texts, links))
        found = [i for i, (t, k) in enumerate(zip(texts, links, strict=True)) if _prose(t, k)]
        return texts[found[0] : found[-1] + 1] if found else texts
    words = [t.split(" ") for t in texts]
    change = np.zeros(sum(map(len, words)) + 1, np.int64)
    np.add.at(change, spans[:, 0], 1)
    np.subtract.at(change, spans.sum(axis=1), 1)
    free = iter((np.cumsum(change) == 0).tolist())
    left = [" ".join([w for w in own if next(free) and not cue]) for own, cue in zip(words, cues, strict=True)]
    return [t for t in left if t]


def main_texts(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars, n_shared) of every page; text is empty if nothing is left.

    Articles are the text, less the runs of RUN words that more than half of the
    host's articles have (LEAST_ARTICLES different ones at least); an article
    that is mostly such runs is a copy and stays.  Where the prose outside of
    them that no other page of the host has is OUTWEIGHED times as long, they
    are teasers, and that prose's page is treated as one without articles.
    ``n_shared`` counts the words outside of articles that the suffix arrays
    found on other pages of the host.  Null html and null urls count as empty;
    pages without a host share one.  Null or repeated ids and repeated rows each
    get their row.  Other columns of ``pages`` are not read.  No pages: no rows.
    """
    folder = shared_folder(pages.sparkSession, "boilerplate")
    parsed = stored(_parsed(pages), f"{folder}/parsed", compression="zstd").withColumn("content", F.xxhash64("host", F.array_join("texts", "\n")))
    covered = _covered(parsed, folder)
    shared = F.coalesce("shared", F.lit(0)).cast("long").alias("n_shared")
    cut = parsed.join(_article_cuts(parsed, folder), "page", "left")
    rest = cut.filter("main IS NULL OR doubtful OR cuts IS NOT NULL").join(covered, "content", "left")

    def finish(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in frames:
            texts = []
            for whole, own, links, cues, spans, only, cuts in zip(*(df[c] for c in ("main", "texts", "links", "cues", "spans", "only", "cuts")), strict=True):
                main = None if whole is None else kept_article(whole, cuts)
                at = np.asarray([] if spans is None else spans, np.int64).reshape(-1, 2)
                kept = kept_blocks(list(own), list(links), at, bool(only), list(cues)) if len(own) else []
                prose = sum(t.count(" ") + 1 for t in kept if _prose(t, 0))
                texts.append(main if main is not None and prose <= OUTWEIGHED * (main.count(" ") + 1) else " ".join(kept))
            yield pd.DataFrame({"page_id": df["page_id"].astype("Int64"), "url": df["url"], "text": texts, "n_shared": df["n_shared"]})

    undecided = rest.select("page_id", "url", "main", "texts", "links", "cues", "spans", F.coalesce("only", F.lit(False)).alias("only"), "cuts", shared).mapInPandas(finish, "page_id long, url string, text string, n_shared long")
    decided = cut.filter("main IS NOT NULL AND NOT doubtful AND cuts IS NULL").join(covered.select("content", "shared"), "content", "left").select("page_id", "url", F.col("main").alias("text"), shared)
    return decided.unionByName(undecided).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "n_shared")
