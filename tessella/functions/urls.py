"""URL and media-attribute functions (Column -> Column)."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessella.constants import IMAGE_SOURCE_ATTRIBUTES
from tessella.functions.text import strip_blanks

NETLOC_PATTERN = "^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)"
VALID_URL_PATTERN = (
    "(?i)^(?:http|ftp)s?://"
    "(?:(?:[A-Z0-9](?:[A-Z0-9-]{0,61}[A-Z0-9])?\\.)+(?:[A-Z]{2,6}\\.?|[A-Z0-9-]{2,}\\.?))"
    "(?:/?|[/?]\\S+)$"
)


def domain(url: Column) -> Column:
    """Network location of a URL, with port, user and case as written; '' if none."""
    return F.regexp_extract(url, NETLOC_PATTERN, 1)


def is_valid_url(url: Column) -> Column:
    return url.rlike(VALID_URL_PATTERN)


def absolutize(page_url: Column, src: Column) -> Column:
    """Absolute address of a media source.

    Not RFC resolution: dot segments are simply removed and the rest is put
    under the root of the page's host.
    """
    undotted = F.when(F.contains(src, F.lit("./")), F.regexp_replace(src, "\\.+/", "")).otherwise(src)
    rooted = F.when(undotted.startswith("/"), undotted).otherwise(F.concat(F.lit("/"), undotted))
    return (
        F.when(src.startswith("http"), src)
        .when(src.startswith("//"), F.concat(F.lit("http:"), src))
        .otherwise(F.concat(F.lit("https://"), domain(page_url), rooted))
    )


def _is_usable(value: Column) -> Column:
    return (value != "") & ~value.contains(",") & ~value.contains(" ")


def usable_source(value: Column) -> Column:
    """The value if it can be one address (no comma, no blank), else NULL."""
    return F.when(_is_usable(value), value)


def image_source(attrs: Column) -> Column:
    """First usable address among the known image attributes of an attribute map."""
    # A coalesce rather than a lambda over the names: used inside another lambda, a nested one
    # would keep the column from an Arrow function's input (see functions.intervals).
    return F.coalesce(*(usable_source(F.element_at(attrs, name)) for name in IMAGE_SOURCE_ATTRIBUTES))


def filename_text(src: Column) -> Column:
    """Readable words of the file name of an address; '' if nothing is left."""
    stem = F.regexp_extract(src, "(?s)([^/.]*)(?:\\.[^/]*)?$", 1)
    words = F.regexp_replace(stem, "[_-]", " ")
    words = F.regexp_replace(words, "%2[0]*", " ")
    words = F.regexp_replace(words, "[0-9]+x[0-9]+", "")
    words = F.regexp_replace(words, "[0-9]+", " ")
    words = F.regexp_replace(words, " {2,}", " ")
    words = F.replace(F.translate(words, "\n+", "  "), F.lit("%B"), F.lit(" "))
    words = strip_blanks(F.replace(words, F.lit("%"), F.lit(" ")))
    return F.when(stem.rlike("\\?[A-Za-z0-9]+="), F.lit("")).when(F.length(words) <= 1, F.lit("")).otherwise(words)


def _unquoted(size: Column) -> Column:
    return F.regexp_replace(size, '[”"<>]', "")


def size_px(size: Column) -> Column:
    """Pixels of a size attribute, NULL if it is a percentage or not understood."""
    text = _unquoted(size)
    plain = F.regexp_extract(text, "^\\s*([+-]?[0-9]+)\\s*$", 1)
    pixels = F.regexp_extract(F.regexp_replace(text, "[px;]", ""), "^\\s*([+-]?[0-9]+)\\s*$", 1)
    decimal = F.regexp_extract(text, "^\\s*([+-]?[0-9]*\\.[0-9]*)\\s*$", 1)
    return (
        F.when(plain != "", plain.try_cast("int"))
        .when(text.contains("px"), pixels.try_cast("int"))
        .when(text.contains("%"), F.lit(None).cast("int"))
        .otherwise(decimal.try_cast("double").try_cast("int"))
    )


def size_pct(size: Column) -> Column:
    """Percentage of a size attribute, NULL if it is none."""
    text = _unquoted(size)
    number = F.regexp_extract(F.replace(text, F.lit("%"), F.lit("")), "^\\s*([+-]?[0-9]+)\\s*$", 1)
    return F.when(text.isin("full-width", "auto"), F.lit(100)).when(
        text.contains("%") & ~text.contains("px"), number.try_cast("int")
    )
