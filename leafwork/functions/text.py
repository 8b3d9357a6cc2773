"""Column builders for text: strings as Python's own methods see them, without a Python worker."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from leafwork.config import DEFAULTS

#: Unicode white space and the four separators that Python strips too.
_SPACE = r"[\s\x1c-\x1f\x85]"
_EDGES = rf"(?U)^{_SPACE}+|{_SPACE}+$"
#: Words that don't count in recall.
STOP_WORDS = ("the", "and", "for", "that", "with", "this", "from", "are", "was", "its", "has", "have", "not", "but", "you", "all", "can")
#: Raster types and their suffixes.
RASTER_MIME = (("image/png", "png"), ("image/jpeg", "jpg"), ("image/jpg", "jpg"), ("image/gif", "gif"), ("image/webp", "webp"), ("image/bmp", "bmp"))


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Without white space at both ends, all of Unicode's kinds; null stays null."""
    return F.regexp_replace(_col(c), _EDGES, "")


def non_empty(c: Column | str) -> Column:
    """True where something is left after ``strip``; null and blank are false."""
    return F.coalesce(F.length(strip(c)) > 0, F.lit(False))


def word_count(c: Column | str) -> Column:
    """Runs of anything but white space; 0 for null and ''."""
    return F.coalesce(F.regexp_count(_col(c), F.lit(r"(?U)[^\s\x1c-\x1f\x85]+")), F.lit(0))


def capped_word_count(c: Column | str, cap: int = DEFAULTS.word_cap) -> Column:
    return F.least(word_count(c), F.lit(cap))


def weight_tenths(placeholder: Column | str) -> Column:
    """The weight of a text container in tenths, so that sums are exact; null is a loose text box."""
    p = F.upper(_col(placeholder))
    some = lambda *names: F.coalesce(p.rlike("|".join(names)), F.lit(False))
    return F.when(p.isNull(), 8).when(some("SUBTITLE"), 12).when(some("TITLE"), 15).when(some("BODY", "OBJECT"), 10).when(some("FOOTER", "SLIDE_NUMBER", "DATE"), 0).otherwise(8)


def or_default(c: Column | str, default: str) -> Column:
    """The default for null and ''; blanks stay."""
    return F.coalesce(F.nullif(_col(c), F.lit("")), F.lit(default))


def xml_attr(c: Column | str) -> Column:
    """Ampersand, quote and angle brackets escaped, in that order; the apostrophe stays."""
    out = _col(c)
    for mark, entity in (("&", "&amp;"), ('"', "&quot;"), ("<", "&lt;"), (">", "&gt;")):
        out = F.replace(out, F.lit(mark), F.lit(entity))
    return out


def word_set(c: Column | str) -> Column:
    """Distinct small-letter runs of three ASCII letters or more, without stop words, sorted."""
    found = F.transform(F.regexp_extract_all(_col(c), F.lit("([a-zA-Z]{3,})"), F.lit(1)), F.lower)
    return F.array_sort(F.array_except(found, F.array(*map(F.lit, STOP_WORDS))))


def number_set(c: Column | str) -> Column:
    """Distinct numbers as written, sorted: 1 and 1.0 are two."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(_col(c), F.lit(r"((?U)\d+(?:\.\d+)?)"), F.lit(1))))


def suffix(c: Column | str) -> Column:
    """The last suffix of a path in small letters, '' without one."""
    return F.lower(F.regexp_extract(name(c), r"[^.](\.[^.]+)$", 1))


def name(c: Column | str) -> Column:
    return F.regexp_extract(_col(c), r"([^/\\]*)$", 1)


def stem(c: Column | str) -> Column:
    return F.regexp_replace(name(c), r"(?<=[^.])\.[^.]+$", "")


def ext_of(c: Column | str) -> Column:
    """What follows the last dot, in small letters."""
    return F.lower(F.substring_index(_col(c), ".", -1))


def ext_from_mime(c: Column | str) -> Column:
    """The suffix for a raster MIME type; null for any other, also for null."""
    mime = F.lower(strip(F.coalesce(_col(c), F.lit(""))))
    return F.element_at(F.create_map(*[F.lit(x) for pair in RASTER_MIME for x in pair]), mime)


def file_kind(c: Column | str, *, strict: bool = False) -> Column:
    """pdf, ppt or pptx by the suffix; null for any other, or an error with ``strict``."""
    s = suffix(c)
    kind = F.when(s.isin(".pdf", ".ppt", ".pptx"), F.substr(s, F.lit(2)))
    return kind.otherwise(F.raise_error(F.concat(F.lit("unsupported file: "), _col(c)))) if strict else kind


def data_url(blob: Column | str, ext: Column | str) -> Column:
    """A data URL; jpg is jpeg, and what isn't png, jpeg, gif or webp counts as png.  Null bytes give null."""
    e = F.lower(_col(ext))
    mime = F.when(e.isin("jpg", "jpeg"), "jpeg").when(e.isin("png", "gif", "webp"), e).otherwise("png")
    return F.concat(F.lit("data:image/"), mime, F.lit(";base64,"), F.regexp_replace(F.base64(_col(blob)), r"[\r\n]", ""))


def strip_fence(c: Column | str) -> Column:
    """A reply without its code fence."""
    return strip(F.regexp_replace(strip(c), r"^```(?:json)?|```$", ""))


def reply_int(reply: Column | str, path: str) -> Column:
    """The integer at a JSON path: 2.5 is 2, "2" is 2; missing, null, "x" and broken JSON are null."""
    return F.try_variant_get(F.try_parse_json(_col(reply)), path, "int")


def table_text(c: Column | str) -> Column:
    """Rows of a table given as lines of cells between bars: cells stripped, all-empty rows dropped; null if none is left."""
    rows = F.transform(F.split(_col(c), "\n"), lambda row: F.transform(F.split(row, r"\|"), strip))
    rows = F.filter(rows, lambda row: F.exists(row, lambda cell: cell != ""))
    return F.nullif(F.array_join(F.transform(rows, lambda row: F.array_join(row, " | ")), "\n"), F.lit(""))


def stripped_lines(c: Column | str) -> Column:
    """Each line stripped, empty ones dropped, joined again."""
    return F.array_join(F.filter(F.transform(F.split(_col(c), "\n"), strip), lambda s: s != ""), "\n")
