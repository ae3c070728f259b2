"""Links of captured web pages, what they lead to, and the walk over them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import matches_format, resolve_url, url_host, url_name, within_root
from ..plans.folders import shared_folder, stored

DEPTH, PAGES = 4, 10_000
OPAQUE = ("HTML", "DOCX", "MAP", "PDF", "TAB", "TIF", "TIFF")


def page_links(url: Column, html: Column) -> Column:
    """Addresses of the anchors of a page as absolute http(s) URLs without fragments, as often as they are there.

    A quoted address may hold blanks, which become %20; one without quotes ends at a blank.
    """
    hrefs = F.regexp_extract_all(html, F.lit(r"""(?is)<a\b[^>]*?\bhref\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""), 1)
    bare = lambda href: F.regexp_replace(F.regexp_replace(F.regexp_replace(href, r"""^["']|["']$""", ""), r"^\s+|\s+$|[\t\r\n]", ""), " ", "%20")
    target = lambda href: F.when(href != "", resolve_url(url, F.replace(href, F.lit("&amp;"), F.lit("&"))))
    return F.filter(F.transform(hrefs, lambda href: target(bare(href))), lambda x: x.isNotNull())


def extract_links(pages: DataFrame) -> DataFrame:
    """(url, target) of the links of pages (url, html), each once a page."""
    return pages.select("url", F.explode(page_links(F.col("url"), F.col("html"))).alias("target")).distinct()


def _directory(target: Column) -> Column:
    """Whether the name of a URL looks like a directory: it has no dot."""
    return ~F.contains(F.coalesce(url_name(target), F.lit("")), F.lit("."))


def classify_links(links: DataFrame, wanted: str, root: str | None = None) -> DataFrame:
    """(target, kind): archive, file of the wanted format, page to visit, or drop; each target once.

    A page is on the root's host and path (of the linking page, without a
    root), and its name looks like a directory.
    """
    name = F.coalesce(url_name(F.col("target")), F.lit(""))
    base = F.lit(root) if root is not None else F.col("url")
    inside = within_root(F.col("target"), base) if root is not None else url_host(F.col("target")) == url_host(base)
    kind = F.when(F.lower(name).endswith(".zip"), "archive").when(matches_format(name, wanted), "file").when(inside & _directory(F.col("target")), "page").otherwise("drop")
    return links.select("target", kind.alias("kind")).groupBy("target").agg(F.min("kind").alias("kind"))


def crawl_frontier(pages: DataFrame, roots: DataFrame, depth: int = DEPTH, most: int = PAGES) -> DataFrame:
    """(url, depth) of the captured pages that a bounded breadth-first walk from the roots (url) reaches.

    The walk stays on the host and below the directory of the root it came
    from, and visits only names that look like directories.  A page has its
    least depth from any root.  More than ``most`` pages is an error.  Each
    step is one join of links with the pages found last, and is written before
    the next.
    """
    folder = shared_folder(pages.sparkSession, "crawl")
    captured = pages.select(F.col("url").alias("target")).distinct()
    links = stored(extract_links(pages).filter(_directory(F.col("target"))).join(captured, "target", "left_semi"), f"{folder}/links")
    start = roots.select(F.col("url").alias("root"), "url").distinct().join(captured, F.col("url") == F.col("target"), "left_semi")
    found = now = stored(start.withColumn("depth", F.lit(0)), f"{folder}/0")
    for step in range(1, depth + 1):
        reached = links.join(now.select("root", "url"), "url").filter(within_root(F.col("target"), F.col("root"))).select("root", F.col("target").alias("url")).distinct()
        now = stored(reached.join(found.select("root", "url"), ["root", "url"], "left_anti").withColumn("depth", F.lit(step)), f"{folder}/{step}")
        found = found.unionByName(now)
    walked = found.groupBy("url").agg(F.min("depth").alias("depth"))
    if walked.limit(most + 1).count() > most:
        raise ValueError(f"the walk has more than {most} pages")
    return walked


def extract_drive_links(pages: DataFrame) -> DataFrame:
    """(url, kind, drive_id, resource_key) of links to shared folders and files, by their path or their id parameter.

    Ids in paths are letters, digits, hyphens and underscores; a path with any
    other is no link.  The key is null where a link has none.
    """
    links = extract_links(pages).filter(url_host(F.col("target")) == "drive.google.com")
    path = F.parse_url("target", F.lit("PATH"))
    parameter = lambda name: F.try_url_decode(F.try_parse_url("target", F.lit("QUERY"), F.lit(name)))
    inside = lambda pattern: F.nullif(F.regexp_extract(path, pattern, 1), F.lit(""))
    folder, file = inside("^/drive/(?:u/[^/]*/)?folders/([^/]+)"), inside("^/file/d/([^/]+)")
    named = F.coalesce(folder, file)
    found = links.select("url", F.when(folder.isNotNull(), "folder").otherwise("file").alias("kind"), F.coalesce(named, parameter("id")).alias("drive_id"), parameter("resourcekey").alias("resource_key"), named.alias("named"))
    return found.filter("drive_id IS NOT NULL").filter(F.col("named").isNull() | F.col("named").rlike("^[A-Za-z0-9_-]+$")).drop("named").distinct()


def file_references(resources: DataFrame) -> DataFrame:
    """(id, url, name) of resources (id, url, file_name, format) in opaque formats; the name is the URL's, else the file's, else made from the id."""
    kept = resources.filter(F.upper("format").isin(*OPAQUE))
    fallback = F.concat(F.col("id").cast("string"), F.lit("."), F.lower("format"))
    return kept.select("id", "url", F.coalesce(url_name(F.col("url")), F.col("file_name"), fallback).alias("name"))


def crawl_sources(pages: DataFrame, wanted: str) -> DataFrame:
    """(id, kind, target) of what the captured pages of resources (id, root, url, html) lead to: files of the wanted format, archives, and shared drive folders and files.

    A drive link keeps its id and resource key as they stand in its address.
    Every target counts once a resource.
    """
    links = pages.select("id", "root", F.explode(page_links(F.col("url"), F.col("html"))).alias("target")).distinct()
    name = F.coalesce(url_name(F.col("target")), F.lit(""))
    drive = (url_host(F.col("target")) == "drive.google.com") & F.col("target").rlike(r"/folders/|/file/d/|[?&]id=")
    kind = F.when(F.lower(name).endswith(".zip"), "archive").when(matches_format(name, wanted), "file").when(drive & F.contains("target", F.lit("/folders/")), "drive folder").when(drive, "drive file")
    return links.select("id", kind.alias("kind"), "target").filter("kind IS NOT NULL")
