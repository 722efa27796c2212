"""Thresholds of the checks. None switches a check off; every bound is inclusive."""

from dataclasses import dataclass, field, fields, replace
from typing import Any

from tessella.constants import VALID_IMAGE_FORMATS


@dataclass(frozen=True)
class TextChecks:
    """Checks of one text, in the order in which they are made."""

    min_words: int | None = None
    max_words: int | None = None
    char_repetition_length: int = 10
    max_char_repetition: float | None = None
    word_repetition_length: int = 4
    max_word_repetition: float | None = None
    max_special_chars: float | None = None
    stop_words: tuple[str, ...] = ()
    min_stop_words: float | None = None
    flagged_words: tuple[str, ...] = ()
    max_flagged_words: float | None = None
    min_punctuation: float | None = None
    punctuation_min_words: int = -1
    common_words: tuple[str, ...] = ()
    min_common_words: float | None = None
    language: str = "ar"
    min_language_score: float | None = None
    max_perplexity: float | None = None

    def without_models(self) -> "TextChecks":
        return replace(self, min_language_score=None, max_perplexity=None)


PARAGRAPH_CHECKS = TextChecks(
    min_words=3,
    max_char_repetition=0.2,
    max_word_repetition=0.25,
    max_special_chars=0.25,
    max_flagged_words=0.01,
    punctuation_min_words=10,
    min_language_score=0.5,
    max_perplexity=2200,
)
DOCUMENT_CHECKS = TextChecks(
    min_words=8,
    max_special_chars=0.23,
    max_flagged_words=0.01,
    min_language_score=0.85,
    max_perplexity=1900,
)
# Bounds of the checks that are off by default.
OPTIONAL_PARAGRAPH_BOUNDS = {"min_stop_words": 0.16, "min_punctuation": 0.005, "min_common_words": 0.85}
OPTIONAL_DOCUMENT_BOUNDS = {
    "max_char_repetition": 0.25,
    "max_word_repetition": 0.3,
    "min_stop_words": 0.45,
    "min_punctuation": 0.02,
    "min_common_words": 0.85,
}


@dataclass(frozen=True)
class ImageChecks:
    check_format: bool = False
    formats: tuple[str, ...] = field(default=tuple(VALID_IMAGE_FORMATS))
    check_size: bool = False
    min_side: int = 150
    max_side: int = 20_000
    max_aspect_ratio: float = 2
    min_images: int | None = None
    max_images: int | None = None


def from_mapping(kind: type, values: dict[str, Any]) -> Any:
    """Options from a plain mapping, such as a parsed configuration file.

    The text 'None' means no bound; unknown names are an error.
    """
    known = {f.name for f in fields(kind)}
    unknown = set(values) - known
    if unknown:
        raise ValueError(f"unknown options: {sorted(unknown)}")
    clean = {k: None if v == "None" else tuple(v) if isinstance(v, (list, set)) else v for k, v in values.items()}
    return kind(**clean)


# Names of a configuration file. Stem of the switch, stem of the bound, and the
# options for its lower and upper cutoff.
_CONFIGURED = (
    ("number_words", "number_words", "min_words", "max_words"),
    ("character_repetition_ratio", "character_repetition", None, "max_char_repetition"),
    ("word_repetition_ratio", "word_repetition", None, "max_word_repetition"),
    ("special_character_ratio", "special_character_ratio", None, "max_special_chars"),
    ("stopword_ratio", "stopword_ratio", "min_stop_words", None),
    ("flagged_word_ratio", "flagged_word_ratio", None, "max_flagged_words"),
    ("punctuation_ratio", "punctuation_ratio", "min_punctuation", None),
    ("common_word_ratio", "common_word_ratio", "min_common_words", None),
    ("lang_id", "lang_id", "min_language_score", None),
    ("perplexity_score", "perplexity_score", None, "max_perplexity"),
)
_LENGTHS = {
    "char_repetition_length": "character_repetition_length_{level}",
    "word_repetition_length": "word_repetition_length_{level}",
    "punctuation_min_words": "min_number_words_to_check_punctuation_ratio_{level}",
}


@dataclass(frozen=True)
class Checks:
    """All checks of a configuration; `similarity` is None if similar texts stay."""

    paragraphs: TextChecks
    documents: TextChecks
    images: ImageChecks
    similarity: int | None


def from_configuration(values: dict[str, Any], **lists: Any) -> Checks:
    """Checks from a whole configuration: thresholds by level, each with a switch.

    A bound whose switch is off is no bound, and so is None or the text 'None'. `lists` are
    word lists and the language, for both levels. Names that say nothing are an error.
    """
    left = {k: None if v == "None" else v for k, v in values.items()}

    def level_checks(level: str) -> TextChecks:
        options = dict(lists)
        for switch, stem, low, high in _CONFIGURED:
            on = left.pop(f"cond_check_{switch}_{level}", False)
            for name, end in ((low, "min"), (high, "max")):
                bound = left.pop(f"{stem}_{level}_{end}_cutoff", None)
                if name and on:
                    options[name] = bound
        for name, key in _LENGTHS.items():
            length = left.pop(key.format(level=level), None)
            if length is not None:
                options[name] = length
        return TextChecks(**options)

    paragraphs, documents = level_checks("node_level"), level_checks("doc_level")
    sides = {
        end: {left.pop(f"{kind}_{side}_{end}_cutoff", None) for kind in ("original", "rendered") for side in ("width", "height")}
        for end in ("min", "max")
    }
    if any(len(s - {None}) > 1 for s in sides.values()):
        raise ValueError("all sides of images share one lower and one upper bound here")
    bounds = {f"{end}_side": next(iter(s - {None})) for end, s in sides.items() if s - {None}}
    formats, ratio = left.pop("valid_formats", None), left.pop("aspect_ratio_max_cutoff", None)
    counted = left.pop("cond_check_number_images", False)
    fewest, most = left.pop("number_images_min_cutoff", None), left.pop("number_images_max_cutoff", None)
    images = ImageChecks(
        check_format=left.pop("cond_check_format", False),
        check_size=left.pop("cond_check_size_image", False),
        min_images=fewest if counted else None,
        max_images=most if counted else None,
        **({"formats": tuple(formats)} if formats else {}),
        **({"max_aspect_ratio": ratio} if ratio is not None else {}),
        **bounds,
    )
    similar = left.pop("deduplication_max_cuttoff", None)
    similarity = similar if left.pop("cond_deduplicate_nodes_doc_level", False) else None
    for always in ("cond_remove_non_printing_characters", "cond_standardize_whitespace"):
        if not left.pop(always, True):
            raise ValueError(f"{always} cannot be switched off: texts are always cleaned")
    if left:
        raise ValueError(f"unknown options: {sorted(left)}")
    return Checks(paragraphs, documents, images, similarity)
