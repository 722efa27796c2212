"""Text clean-up and word functions (Column -> Column)."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessella import constants as C
from tessella.functions.arrays import let


def char_class(chars: str, *, extra: str = "") -> str:
    """Body of a regular-expression class that holds exactly `chars`.

    Neighbouring code points are written as ranges, everything as \\x{...}, so that
    no character has a special meaning.
    """
    points = sorted(set(map(ord, chars + extra)))
    parts, start = [], 0
    for i in range(1, len(points) + 1):
        if i == len(points) or points[i] != points[i - 1] + 1:
            first, last = points[start], points[i - 1]
            parts.append(f"\\x{{{first:X}}}" if first == last else f"\\x{{{first:X}}}-\\x{{{last:X}}}")
            start = i
    return "".join(parts)


# What str.strip() removes: Java's \\s is ASCII only.
BLANK_CLASS = "[\\s\\x{1C}-\\x{1F}\\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]"


def strip_blanks(text: Column) -> Column:
    """Without the blanks at both ends; a text with none there is not scanned."""

    def stripped(t: Column) -> Column:
        ends = F.left(t, F.lit(1)).rlike(BLANK_CLASS) | F.right(t, F.lit(1)).rlike(BLANK_CLASS)
        return F.when(ends, F.regexp_replace(t, f"^{BLANK_CLASS}+|{BLANK_CLASS}+$", "")).otherwise(t)

    return let(text, stripped)


def collapse_linebreaks(html: Column) -> Column:
    return F.regexp_replace(html, "\n{2,}", "\n")


def collapse_spaces(text: Column) -> Column:
    return F.regexp_replace(text, " {2,}", " ")


def drop_comments(html: Column) -> Column:
    return F.regexp_replace(html, "(?s)<!--.*?-->", "")


def mark_line_breaks(html: Column) -> Column:
    # The four cannot overlap, and none can arise from the token.
    for tag in ("<br>", "<br/>", "<br />", "</br>"):
        html = F.replace(html, F.lit(tag), F.lit(C.LINE_BREAK_TOKEN))
    return html


def where_found(text: Column, part: str, change) -> Column:
    """`change(text)` for texts that hold `part`, which the change needs; a plain search spares others its scan."""
    return let(text, lambda t: F.when(F.contains(t, F.lit(part)), change(t)).otherwise(t))


def _not_ascii(text: Column, change) -> Column:
    """`change(text)`, which leaves ASCII alone, for texts that hold more."""
    return let(text, lambda t: F.when(F.octet_length(t) > F.length(t), change(t)).otherwise(t))


def format_text(text: Column) -> Column:
    """One text leaf of a page: blanks squeezed, line-break tokens turned into newlines.

    A blank at either end is kept as one space, because it decides how the text
    joins its neighbours.
    """
    flat = where_found(F.replace(F.replace(text, F.lit("\n"), F.lit(" ")), F.lit("\t"), F.lit(" ")), "  ", collapse_spaces)

    def shaped(t: Column) -> Column:
        parts = F.array_join(F.transform(F.split(t, C.LINE_BREAK_TOKEN), strip_blanks), "\n")
        lines = F.when(F.contains(t, F.lit(C.LINE_BREAK_TOKEN)), parts).otherwise(strip_blanks(t))
        head = F.when(t.startswith(" "), F.lit(" ")).otherwise(F.lit(""))
        tail = F.when(t.endswith(" ") & (F.length(t) > 1), F.lit(" ")).otherwise(F.lit(""))
        return F.concat(head, lines, tail)

    return let(flat, shaped)


def strip_diacritics(text: Column) -> Column:
    return F.regexp_replace(text, C.DIACRITICS_CLASS, "")


def strip_nonprinting(text: Column, keep_newlines: bool = False) -> Column:
    chars = "".join(chr(p) for p in C.NON_PRINTING_CODE_POINTS if not (keep_newlines and p == 10))
    return F.translate(text, chars, " " * len(chars))


def standardize_whitespace(text: Column) -> Column:
    return _not_ascii(text, lambda t: F.translate(t, C.SPACE_LIKE, " " * len(C.SPACE_LIKE)))


def clean_text(text: Column, keep_newlines: bool = True) -> Column:
    """The two character clean-ups that come before every text check.

    With `keep_newlines=False` a newline counts as non-printing, and no paragraph
    border survives the clean-up.
    """
    chars = "".join(chr(p) for p in C.NON_PRINTING_CODE_POINTS if not (keep_newlines and p == 10)) + C.SPACE_LIKE
    # Both make spaces, so one pass does for both.
    return F.translate(text, chars, " " * len(chars))


def split_ws(text: Column, newline: bool = False, tab: bool = False) -> Column:
    separators = " " + "\n" * newline + "\t" * tab
    return F.filter(F.split(text, f"[{separators}]"), lambda x: x != "")


# One character that may start or end a word. The full list is a long chain of
# comparisons for the regular-expression engine, so ASCII is decided before it: the
# lookahead rejects its special characters, and common letters come first in the union.
_EVERYDAY_LETTERS = "a-zß-öù-ÿ\\x{430}-\\x{44F}\\x{621}-\\x{63A}\\x{641}-\\x{64A}"
_WORD_EDGE = (
    "(?![\\t-\\r\\x20-@\\[-`{-~])"
    f"[{_EVERYDAY_LETTERS}[^{char_class(C.SPECIAL_CHARACTERS, extra=' ')}]]"
)
# A word holds no blank and has such characters at both ends; one scan finds what
# splitting on blanks and stripping each piece would give.
WORD_PATTERN = f"{_WORD_EDGE}(?:[^ \\n\\t]*{_WORD_EDGE})?"


def words(text: Column) -> Column:
    """Lower-cased words without the special characters around them."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD_PATTERN), F.lit(0))


def num_words(text: Column) -> Column:
    return F.regexp_count(F.lower(text), F.lit(WORD_PATTERN))


def normalize(
    text: Column,
    nonprinting: bool = True,
    strip: bool = True,
    lower: bool = False,
    whitespace: bool = True,
    digits: bool = True,
    punctuation: bool = True,
    keep_newlines: bool = False,
) -> Column:
    """Text as the language model sees it. The steps run in the order of the switches."""
    if nonprinting:
        text = strip_nonprinting(text, keep_newlines)
    if strip:
        text = strip_blanks(text)
    if lower:
        text = F.lower(text)
    if whitespace:
        text = standardize_whitespace(text)
    if digits:
        text = F.regexp_replace(text, "\\p{Nd}", "0")
    if punctuation:
        for mark, plain in C.UNICODE_PUNCTUATION.items():
            if len(plain) > 1:
                text = F.replace(text, F.lit(mark), F.lit(plain))
        single = {mark: plain for mark, plain in C.UNICODE_PUNCTUATION.items() if len(plain) == 1}
        text = _not_ascii(text, lambda t: F.translate(t, "".join(single), "".join(single.values())))
    return text


def paragraphs(text: Column, separator: str = C.PARAGRAPH_SEPARATOR) -> Column:
    return F.split(text, separator)
