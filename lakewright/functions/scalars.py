"""Column functions of the lakehouse: text, URLs, JSON, times, ids, sizes and labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

URL_NAMESPACE = "6ba7b8119dad11d180b400c04fd430c8"  # fixed value: the URL namespace of RFC 4122
STATUS_LABELS = {"pending": "Pending", "processing": "Processing", "completed": "Completed", "failed": "Failed", "deleted": "Deleted", "outdated": "Outdated"}


def clean_text(c: Column) -> Column:
    """Trimmed, with runs of blanks as one space, in lower case."""
    return F.lower(F.trim(F.regexp_replace(c, r"\s+", " ")))


def truncate_text(c: Column, n: int = 16000) -> Column:
    """At most ``n`` bytes; a text is cut between characters, so a multi-byte character is not split."""
    short = F.make_valid_utf8(F.substring(F.encode(c, "UTF-8"), 1, n).cast("string"))
    # what is left of a character that the cut has split is a replacement character
    return F.when(F.octet_length(c) <= n, c).otherwise(F.regexp_replace(short, "\uFFFD$", ""))


def like_any(term: str, *columns: Column) -> Column:
    """SQL LIKE %term% over any column; % and _ in the term stay wildcards."""
    found = F.lit(False)
    for c in columns:
        found = found | F.coalesce(c.like(f"%{term}%"), F.lit(False))
    return found


def fold_accents(c: Column) -> Column:
    """Lower case without accents, for the Latin letters of Western European languages."""
    return F.translate(F.lower(c), "áàâãäåçéèêëíìîïñóòôõöúùûüýÿ", "aaaaaaceeeeiiiinooooouuuuyy")


def parse_local_number(c: Column) -> Column:
    """1.234,56 as a double; null where it is no number."""
    return F.replace(F.replace(F.trim(c), F.lit("."), F.lit("")), F.lit(","), F.lit(".")).try_cast("double")


def url_host(c: Column) -> Column:
    """Host in lower case; null without one."""
    return F.nullif(F.lower(F.regexp_extract(c, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def url_path(c: Column) -> Column:
    return F.regexp_extract(c, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)", 1)


def url_name(c: Column) -> Column:
    """Last segment of the path, unquoted; null if it is empty."""
    name = F.element_at(F.split(url_path(c), "/"), -1)
    return F.nullif(F.coalesce(F.try_url_decode(F.replace(name, F.lit("+"), F.lit("%2B"))), name), F.lit(""))


def url_directory(c: Column) -> Column:
    """The URL without query and fragment, up to the last slash of its path."""
    return F.regexp_extract(c, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(?:/[^?#]*/|/)?)", 1)


def within_root(c: Column, root: Column) -> Column:
    """Whether a URL has the root's host and a path below the root's directory."""
    return F.coalesce((url_host(c) == url_host(root)) & F.startswith(c, url_directory(root)), F.lit(False))


def resolve_url(base: Column, link: Column) -> Column:
    """Absolute http(s) URL of a link on a page, without its fragment; null for anything else."""
    link = F.trim(link)
    bare = F.regexp_replace(link, "#.*$", "")
    scheme = F.regexp_extract(base, r"^([A-Za-z]+):", 1)
    origin = F.regexp_extract(base, r"^([A-Za-z]+://[^/?#]*)", 1)
    path = F.when(url_path(base) == "", "/").otherwise(url_path(base))
    folder = F.regexp_extract(path, "^(.*/)", 1)
    whole = (
        F.when(bare.rlike("(?i)^https?://"), bare)
        .when(bare.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), None)
        .when(bare.startswith("//"), F.concat(scheme, F.lit(":"), bare))
        .when(bare.startswith("/"), F.concat(origin, bare))
        .when(bare.startswith("?"), F.concat(origin, path, bare))
        .when(bare == "", F.regexp_replace(base, "#.*$", ""))
        .otherwise(F.concat(origin, folder, bare))
    )
    for _ in range(4):  # dot segments, up to four levels
        whole = F.regexp_replace(F.regexp_replace(whole, r"/\./", "/"), r"(://[^/]+(?:/[^/?#]+)*?)/(?!\.\./)[^/?#]+/\.\./", "$1/")
    return whole


def dataset_url(base: Column, dataset: Column) -> Column:
    return F.concat(F.rtrim(base, F.lit("/")), F.lit("/dataset/"), dataset)


def resource_url(base: Column, dataset: Column, resource: Column) -> Column:
    return F.concat(dataset_url(base, dataset), F.lit("/resource/"), resource)


def json_text(c: Column, path: str) -> Column:
    return F.get_json_object(c, path)


def canonical_json(c: Column) -> Column:
    """A flat JSON object with its keys sorted and its values as text."""
    parsed = F.from_json(c, "map<string,string>")
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(parsed))))


def json_key_count(c: Column) -> Column:
    return F.size(F.json_object_keys(c))


def as_json_text(c: Column, kind: str = "") -> Column:
    """Nested values as JSON; other values as text."""
    return F.to_json(c) if kind.startswith(("struct", "array", "map")) else c.cast("string")


def parse_rfc3339(c: Column) -> Column:
    """Timestamp of a text with date, time and zone; null if a part, the zone included, is missing."""
    return F.when(c.rlike(r"^\d{4}-\d{2}-\d{2}[Tt ]\d{2}:\d{2}:\d{2}(\.\d+)?([Zz]|[+-]\d{2}:\d{2})$"), F.try_to_timestamp(F.regexp_replace(F.upper(c), "T", " ")))


def parse_http_date(c: Column) -> Column:
    """Timestamp of e.g. Sun, 06 Nov 1994 08:49:37 GMT; null for other texts."""
    month = F.lpad(((F.instr(F.lit("JanFebMarAprMayJunJulAugSepOctNovDec"), F.regexp_extract(c, r"\d{2} ([A-Z][a-z]{2}) \d{4}", 1)) + 2) / 3).cast("int").cast("string"), 2, "0")
    day, year, time = (F.regexp_extract(c, r"^[A-Z][a-z]{2}, (\d{2}) [A-Z][a-z]{2} (\d{4}) (\d{2}:\d{2}:\d{2}) GMT$", i) for i in (1, 2, 3))
    return F.when(c.rlike("GMT$"), F.try_to_timestamp(F.concat(year, F.lit("-"), month, F.lit("-"), day, F.lit(" "), time, F.lit("Z"))))


def compact_id(c: Column) -> Column:
    return F.date_format(c, "yyyyMMdd'T'HHmmss")


def _micros(c: Column) -> Column:
    return F.unix_micros(c.cast("timestamp"))


def duration_us(start: Column, end: Column) -> Column:
    """Microseconds from start to end, not below 0."""
    return F.greatest(_micros(end) - _micros(start), F.lit(0))


def job_duration(status: Column, started: Column, completed: Column, now: Column) -> Column:
    """Duration of a job; one that is not over is measured to ``now``, one that has not started has none."""
    end = F.when(status.isin("completed", "failed"), completed).otherwise(now)
    return F.when(started.isNotNull(), duration_us(started, F.coalesce(end, now)))


def format_duration(us: Column) -> Column:
    """1h 2m 3s, without leading parts that are 0."""
    s = F.floor(us / 1_000_000)
    h, m = F.floor(s / 3600), F.floor(s % 3600 / 60)
    return F.concat_ws(" ", F.when(h > 0, F.concat(h, F.lit("h"))), F.when((h > 0) | (m > 0), F.concat(m, F.lit("m"))), F.concat((s % 60).cast("long"), F.lit("s")))


def older_than(c: Column, now: Column, hours: float) -> Column:
    return _micros(c) < _micros(now) - F.lit(int(hours * 3_600_000_000))


def stable_id(name: Column) -> Column:
    """UUID version 5 of a name in the URL namespace."""
    h = F.sha1(F.concat(F.unhex(F.lit(URL_NAMESPACE)), F.encode(name, "UTF-8")))
    part = lambda a, n: F.substring(h, a, n)
    variant = F.lower(F.conv((F.conv(part(17, 1), 16, 10).cast("int") % 4 + 8).cast("string"), 10, 16))
    return F.concat(part(1, 8), F.lit("-"), part(9, 4), F.lit("-5"), part(14, 3), F.lit("-"), variant, part(18, 3), F.lit("-"), part(21, 12))


def size_bucket(size: Column) -> Column:
    """small under 1 MB, medium under 1 GB, else large."""
    return F.when(size < 1 << 20, "small").when(size < 1 << 30, "medium").otherwise("large")


def size_text(size: Column) -> Column:
    """Size in KB, MB or GB with one decimal."""
    shown = lambda unit, name: F.concat(F.round(size / unit, 1).cast("decimal(20,1)").cast("string"), F.lit(name))
    return F.when(size < 1 << 20, shown(1 << 10, " KB")).when(size < 1 << 30, shown(1 << 20, " MB")).otherwise(shown(1 << 30, " GB"))


def rows_per_batch(width: Column, rows: int = 32768, cells: int = 4_194_304) -> Column:
    return F.greatest(F.lit(1), F.least(F.lit(rows), F.floor(F.lit(cells) / F.greatest(width, F.lit(1))))).cast("long")


def pick_fields(items: Column, keys: list[str]) -> Column:
    """Structs of an array with the chosen fields only."""
    return F.transform(items, lambda x: F.struct(*[x[k].alias(k) for k in keys]))


def is_uuid(c: Column) -> Column:
    return F.coalesce(c.rlike("^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$"), F.lit(False))


def first_text(*columns: Column) -> Column:
    """The first value that is neither null nor blank."""
    return F.coalesce(*[F.when(F.trim(c) != "", c) for c in columns])


# The characters that Windows-1252 has for the bytes 0x80 to 0x9F; the bytes left out are control characters, as in Latin-1.
WINDOWS_1252 = dict(zip(b"\x80\x82\x83\x84\x85\x86\x87\x88\x89\x8a\x8b\x8c\x8e\x91\x92\x93\x94\x95\x96\x97\x98\x99\x9a\x9b\x9c\x9e\x9f", "€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ", strict=True))
#: Names under which files of single bytes are published; on the web, Latin-1 means Windows-1252.
SINGLE_BYTES = ("windows-1252", "cp1252", "iso-8859-1", "latin1", "latin-1", "us-ascii", "ascii")


def _windows_1252(c: Column) -> Column:
    return F.translate(F.decode(c, "ISO-8859-1"), "".join(map(chr, WINDOWS_1252)), "".join(WINDOWS_1252.values()))


def decode_bytes(c: Column, encoding: str = "utf-8") -> Column:
    """Text of bytes without a byte order mark; what is no UTF-8 is read as Windows-1252 where UTF-8 was asked for."""
    name = encoding.lower().replace("_", "-")
    if name in ("utf8", "utf-8"):
        text = F.when(F.is_valid_utf8(c.cast("string")), F.decode(c, "UTF-8")).otherwise(_windows_1252(c))
    else:
        text = _windows_1252(c) if name in SINGLE_BYTES else F.decode(c, encoding.upper())
    return F.regexp_replace(text, "^\ufeff", "")


def status_label(c: Column) -> Column:
    label = F.lit(None).cast("string")
    for status, name in STATUS_LABELS.items():
        label = F.when(F.lower(c) == status, name).otherwise(label)
    return F.coalesce(label, c)


def format_suffixes(wanted: str) -> tuple[str, ...]:
    """Lower-case suffixes of the files of a format, or of all formats that a label names."""
    suffixes = {"csv": [".csv"], "json": [".json", ".geojson"], "tif": [".tif", ".tiff"], "tiff": [".tif", ".tiff"], "docx": [".docx"], "map": [".map"], "pdf": [".pdf"], "tab": [".tab"]}
    return tuple(end for key, ends in suffixes.items() if key in wanted.lower() for end in ends)


def matches_format(name: Column, wanted: str) -> Column:
    """Whether a file name has the suffix of a format; a label with several formats matches by any."""
    low, out = F.lower(name), F.lit(False)
    for end in format_suffixes(wanted):
        out = out | low.endswith(end)
    return F.coalesce(out, F.lit(False))


CONTENT_TYPES = {"text/csv": "CSV", "application/csv": "CSV", "application/json": "JSON", "application/geo+json": "GEOJSON", "application/zip": "ZIP", "application/pdf": "PDF", "text/html": "HTML", "image/tiff": "TIFF"}


def infer_format(content_type: Column, disposition: Column, known: Column) -> Column:
    """Format by content type, else by the extension of the file name in a content disposition; a known format stays."""
    kind = F.lower(F.trim(F.element_at(F.split(content_type, ";"), 1)))
    by_type = F.lit(None).cast("string")
    for key, value in CONTENT_TYPES.items():
        by_type = F.when(kind == key, value).otherwise(by_type)
    by_name = F.nullif(F.upper(F.regexp_extract(disposition, r"(?i)filename=\"?[^\";]*\.([A-Za-z0-9]+)\"?", 1)), F.lit(""))
    return F.coalesce(F.when(F.trim(known) != "", F.upper(known)), by_type, by_name)
