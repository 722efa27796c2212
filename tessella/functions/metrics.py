"""Text-quality metrics (Column -> DOUBLE), each computed inside its row.

Counting n-grams row by row keeps the work where the text already is (in Arrow batches,
see ngrams): an explode of one row per character would shuffle many times the input.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessella import constants as C
from tessella.functions import ngrams
from tessella.functions import text as T
from tessella.functions.arrays import let


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def char_repetition_ratio(text: Column, n: int = 10, depth: int = 0) -> Column:
    """Share of the most frequent n-grams of characters.

    With D distinct n-grams, R of them repeated, the min(floor(sqrt(D)), R) most
    frequent ones are added up and divided by the number of all n-grams. With `depth`,
    of every text in arrays of that depth. Stands in a projection, not in a lambda.
    """
    return ngrams.char_repetition(text, n, depth)


def word_repetition_ratio(words: Column, n: int = 4, depth: int = 0) -> Column:
    """Share of the word n-grams that occur more than once in the text; `depth` as above."""
    return ngrams.word_repetition(words, n, depth)


def special_char_ratio(text: Column, chars: str = C.SPECIAL_CHARACTERS) -> Column:
    return _share(F.length(text) - F.length(F.translate(text, chars, "")), F.length(text))


def listed_word_ratio(words: Column, listed: list[str]) -> Column:
    """Share of the words that are on a list (stop, flagged, common or spam words).

    The list goes into the plan as a literal set; entries of several words never match.
    """
    return let(words, lambda w: _share(F.size(F.filter(w, lambda x: x.isin(listed))), F.size(w)))


def punctuation_ratio(text: Column, min_words: int = -1, marks: str = C.PUNCTUATION) -> Column:
    """Share of punctuation among words and marks; 1.0 for texts under `min_words` tokens."""
    mark = f"[{T.char_class(marks)}]"
    # [\w'] spelled out: letters, numbers and the low line, but no combining marks.
    tokens = F.regexp_count(text, F.lit(f"[\\p{{L}}\\p{{N}}_']+|{mark}"))
    ratio = _share(F.regexp_count(text, F.lit(mark)), tokens)
    if min_words > 0:
        return F.when(tokens == 0, F.lit(0.0)).when(tokens < min_words, F.lit(1.0)).otherwise(ratio)
    return ratio


def spam_word_ratio(text: Column) -> Column:
    return listed_word_ratio(T.words(text), C.SPAM_WORDS)
