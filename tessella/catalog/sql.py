"""SQL fragments of the text functions, written for DuckDB."""

from tessella import constants as C
from tessella.functions.text import char_class


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def tuple_of(words: list[str]) -> str:
    return "(" + ", ".join(map(quoted, words)) + ")"


_SPECIAL = f"[{char_class(C.SPECIAL_CHARACTERS)}]"


def words(text: str) -> str:
    """Split on blanks, then strip special characters from both ends of each piece."""
    pieces = f"string_split_regex(lower({text}), '[ \\n\\t]')"
    stripped = f"list_transform({pieces}, lambda x: regexp_replace(x, '^{_SPECIAL}+|{_SPECIAL}+$', '', 'g'))"
    return f"list_filter({stripped}, lambda x: x <> '')"


def bare(text: str) -> str:
    return f"regexp_replace({text}, '{C.DIACRITICS_CLASS}', '', 'g')"


def clean(text: str, keep_newlines: bool = True) -> str:
    chars = "".join(chr(p) for p in C.NON_PRINTING_CODE_POINTS if p and not (keep_newlines and p == 10))
    chars += C.SPACE_LIKE
    return f"translate({text}, {quoted(chars)}, {quoted(' ' * len(chars))})"


def special_ratio(text: str) -> str:
    kept = f"translate({text}, {quoted(C.SPECIAL_CHARACTERS)}, '')"
    return f"CASE WHEN length({text}) = 0 THEN 0 ELSE (length({text}) - length({kept})) / length({text}) END"


def listed_ratio(word_list: str, lexicon: list[str]) -> str:
    hits = f"list_transform({word_list}, lambda x: CASE WHEN x IN {tuple_of(lexicon)} THEN 1 ELSE 0 END)"
    return f"coalesce(list_avg({hits}), 0)"


def punctuation_ratio(text: str, min_words: int = -1) -> str:
    marks = f"[{C.PUNCTUATION}]"
    tokens = f"len(regexp_extract_all({text}, '[\\p{{L}}\\p{{N}}_'']+|{marks}'))"
    short = f"WHEN {tokens} < {min_words} THEN 1.0 " if min_words > 0 else ""
    return (
        f"CASE WHEN {tokens} = 0 THEN 0.0 {short}"
        f"ELSE len(regexp_extract_all({text}, '{marks}')) / {tokens} END"
    )


def char_grams(source: str, ids: str, text: str, n: int, name: str) -> str:
    """CTE `name` (ids, g): every window of n characters of a text."""
    window = " || ".join(["c", *[f"lead(c, {k}) OVER w" for k in range(1, n)]])
    return f"""
{name} AS (
  SELECT {ids}, g FROM (
    SELECT {ids}, {window} AS g
    FROM (SELECT {ids}, unnest(string_split({text}, '')) AS c,
                 generate_subscripts(string_split({text}, ''), 1) AS i FROM {source})
    WINDOW w AS (PARTITION BY {ids} ORDER BY i)) WHERE g IS NOT NULL)"""


def char_repetition(source: str, ids: str, text: str, n: int = 10, name: str = "char_rep") -> str:
    """Common table expressions ending in `name` (ids, ratio)."""
    return f"""{char_grams(source, ids, text, n, f"{name}_grams")},
{name}_counts AS (SELECT {ids}, g, count(*) AS c FROM {name}_grams GROUP BY ALL),
{name}_ranked AS (
  SELECT {ids}, c, row_number() OVER (PARTITION BY {ids} ORDER BY c DESC) AS rk,
         count(*) OVER (PARTITION BY {ids}) AS d,
         sum(CASE WHEN c = 1 THEN 1 ELSE 0 END) OVER (PARTITION BY {ids}) AS d1
  FROM {name}_counts),
{name} AS (
  SELECT {ids}, sum(CASE WHEN rk <= least(floor(sqrt(d)), d - d1) THEN c ELSE 0 END) / sum(c) AS ratio
  FROM {name}_ranked GROUP BY {ids})"""


def word_repetition(source: str, ids: str, word_list: str, n: int = 4, name: str = "word_rep") -> str:
    return f"""
{name}_grams AS (
  SELECT {ids}, unnest(CASE WHEN len({word_list}) >= {n}
    THEN list_transform(range(1, len({word_list}) - {n} + 2),
                        lambda i: array_to_string({word_list}[i:i + {n} - 1], ' ')) ELSE [] END) AS g
  FROM {source}),
{name}_counts AS (SELECT {ids}, g, count(*) AS c FROM {name}_grams GROUP BY ALL),
{name} AS (
  SELECT {ids}, sum(CASE WHEN c > 1 THEN c ELSE 0 END) / sum(c) AS ratio FROM {name}_counts GROUP BY {ids})"""


def metrics(source: str, ids: str, stop: list[str], flagged: list[str], common: list[str], punct_min: int) -> str:
    """CTEs ending in `metrics`: every text metric of a relation (ids, text), unrounded."""
    return (
        f"""
worded AS (
  SELECT {ids}, text, {bare("text")} AS bare, {words("text")} AS w, {words(bare("text"))} AS wb FROM {source}),"""
        + char_repetition("worded", ids, "bare")
        + ","
        + word_repetition("worded", ids, "w")
        + f""",
metrics AS (
  SELECT {ids}, text, len(w) AS n_words,
         coalesce(cr.ratio, 0) AS char_repetition, coalesce(wr.ratio, 0) AS word_repetition,
         {special_ratio("text")} AS special_chars,
         {listed_ratio("wb", stop)} AS stop_words, {listed_ratio("wb", flagged)} AS flagged_words,
         {punctuation_ratio("text", punct_min)} AS punctuation, {listed_ratio("wb", common)} AS common_words
  FROM worded LEFT JOIN char_rep cr USING ({ids}) LEFT JOIN word_rep wr USING ({ids}))"""
    )
