"""Lists, tables and tokens that decide the results.

Nothing here is computed from data. Long word lists (stop words, flagged words,
common words) are not part of the package; callers pass them as parameters.
"""

import string

# --- Fixed values -----------------------------------------------------------

# Paragraph that marks the end of a document inside a longer page.
END_OF_DOCUMENT = "END_OF_DOCUMENT_TOKEN_TO_BE_REPLACED"
PARAGRAPH_SEPARATOR = "\n\n"
LINE_BREAK_TOKEN = "#BR_TAG#"

# Arabic harakat, as a character class.
DIACRITICS_CLASS = "[\u064b-\u065f\u0670]"

# Code points 0-31 and 127-159.
NON_PRINTING_CODE_POINTS = list(range(0, 32)) + list(range(127, 160))

# Space-like characters that are turned into a plain space.
SPACE_LIKE = " \u2009\u200a\u202f\u2005\u3000\u2002\u2008\u2003\ufffc\x84\xa0"

# Unicode punctuation and its plain form.
UNICODE_PUNCTUATION = {
    "，": ",",
    "。": ".",
    "、": ",",
    "„": '"',
    "”": '"',
    "“": '"',
    "«": '"',
    "»": '"',
    "１": '"',
    "」": '"',
    "「": '"',
    "《": '"',
    "》": '"',
    "´": "'",
    "∶": ":",
    "：": ":",
    "？": "?",
    "！": "!",
    "（": "(",
    "）": ")",
    "；": ";",
    "–": "-",
    "—": " - ",
    "．": ". ",
    "～": "~",
    "’": "'",
    "…": "...",
    "━": "-",
    "〈": "<",
    "〉": ">",
    "【": "[",
    "】": "]",
    "％": "%",
    "►": "-",
}

# Marks counted by the punctuation ratio.
PUNCTUATION = ",;:?!.\u060c\u061b\u061f\u066b\u060d"

# Characters that are not part of a word (invisible ones are written as escapes).
MAIN_SPECIAL_CHARACTERS = string.punctuation + string.digits + string.whitespace
OTHER_SPECIAL_CHARACTERS = (
    "\x92\u2009\x93\x97\u200a\x9d\x99\u202f\x96\u2005\x95\x91\x9c\u3000\u2002 \u2008\x98\x81\u2003\x82\ufffc\x83\x84"
    "’“”–ー一▬…✦\ufffd\xad£\u200b•€«»°·═"
    "×士＾˘⇓↓↑←→（）§″′´¿−±∈\ufeff¢ø‚„½¼¾¹²³―⁃，ˌ¸‹›ʺˈʻ¦‐\u2800‰\x85\x85‑≤≥‖"
    "◆●■►▼▲▴∆▻¡★☆✱ːº。¯˜¥ɪ≈†上ン：∼⁄・♡✓⊕․．⋅÷１‟；،،¨\u093e\u093e\u0940\u094d\u0947◦˚"
    "゜ʼ≖ʼ¤ッツシ℃√！【】‿∞➤～π\u06e9☛₨➩☻๑٪♥ıॽ《‘©﴿٬？▷Г♫∟™ª₪®「—❖"
    "」﴾》"
    "٠١٢٣٤٥٦٧٨٩"
    "۴۵۶"
    "،؛؟"
    "‹›«»٪×÷§"
)

# Emoji that are one code point long: the Emoji_Presentation ranges of Unicode
# (without the regional indicators) and the hair components.
EMOJI_RANGES = (
    "231A-231B 23E9-23EC 23F0 23F3 25FD-25FE 2614-2615 2648-2653 267F 2693 26A1 26AA-26AB 26BD-26BE "
    "26C4-26C5 26CE 26D4 26EA 26F2-26F3 26F5 26FA 26FD 2705 270A-270B 2728 274C 274E 2753-2755 2757 "
    "2795-2797 27B0 27BF 2B1B-2B1C 2B50 2B55 1F004 1F0CF 1F18E 1F191-1F19A 1F201 1F21A 1F22F "
    "1F232-1F236 1F238-1F23A 1F250-1F251 1F300-1F320 1F32D-1F335 1F337-1F37C 1F37E-1F393 1F3A0-1F3CA "
    "1F3CF-1F3D3 1F3E0-1F3F0 1F3F4 1F3F8-1F43E 1F440 1F442-1F4FC 1F4FF-1F53D 1F54B-1F54E 1F550-1F567 "
    "1F57A 1F595-1F596 1F5A4 1F5FB-1F64F 1F680-1F6C5 1F6CC 1F6D0-1F6D2 1F6D5-1F6D7 1F6DC-1F6DF "
    "1F6EB-1F6EC 1F6F4-1F6FC 1F7E0-1F7EB 1F7F0 1F90C-1F93A 1F93C-1F945 1F947-1F9FF 1FA70-1FA7C "
    "1FA80-1FA88 1FA90-1FABD 1FABF-1FAC5 1FACE-1FADB 1FAE0-1FAE8 1FAF0-1FAF8"
)

# Site boilerplate words.
SPAM_WORDS = [
    "facebook",
    "twitter",
    "instagram",
    "reddit",
    "youtube",
    "pinterest",
    "flickr",
    "share",
    "tweet",
    "post",
    "comment",
    "subscribe",
    "newletter",
    "blogger",
    "bloggers",
    "interested",
    "might",
    "like",
    "sign-up",
    "sign",
    "log",
    "logged",
    "access",
    "contact",
    "content",
    "privacy",
    "policy",
    "website",
    "cookies",
    "cookie",
    "licensed",
    "password",
    "account",
    "follow",
    "terms",
    "mailing",
    "list",
    "download",
    "loading",
    "click",
]
SPAM_WORD_CUTOFF = 0.12

# Image URLs holding one of these are treated as not found.
BANNED_URL_WORDS = ["logo", "button", "icon", "plugin", "widget", "porn", "xxx", "sex"]

# Scores above which an image is unsafe.
UNSAFE_SCORE_CUTOFFS = {"hentai": 0.9, "porn": 0.85, "sexy": 1.0}

# Image URLs seen more often than this are removed.
FREQUENT_IMAGE_CUTOFF = 10

VALID_IMAGE_FORMATS = ["jpg", "jpeg", "png", "webp"]

# Tags that only change how text looks.
INLINE_TAGS = [
    "a",
    "abbr",
    "acronym",
    "b",
    "bdi",
    "bdo",
    "big",
    "cite",
    "code",
    "data",
    "dfn",
    "em",
    "font",
    "i",
    "ins",
    "kbd",
    "mark",
    "q",
    "s",
    "samp",
    "shadow",
    "small",
    "span",
    "strike",
    "strong",
    "sub",
    "sup",
    "time",
    "tt",
    "u",
    "var",
    "wbr",
]

# Tags that structure text, and what they put between two texts ("" = nothing).
TEXT_SEPARATORS = {
    "address": "\n",
    "article": "\n",
    "aside": "\n",
    "blink": "",
    "blockquote": "\n\n",
    "body": "",
    "caption": "",
    "center": "\n",
    "dd": "\n",
    "dl": "\n\n",
    "dt": "\n",
    "div": "\n",
    "figcaption": "\n",
    "h": "",
    "h1": "\n\n",
    "h2": "\n\n",
    "h3": "\n\n",
    "h4": "\n\n",
    "h5": "\n\n",
    "h6": "\n\n",
    "hgroup": "\n",
    "html": "",
    "legend": "\n",
    "main": "\n",
    "marquee": "\n",
    "ol": "\n\n",
    "p": "\n\n",
    "section": "\n",
    "summary": "\n",
    "title": "",
    "ul": "\n\n",
}
STRUCTURE_TAGS = [*TEXT_SEPARATORS, "br"]
MEDIA_TAGS = ["audio", "embed", "figure", "iframe", "img", "object", "picture", "video"]
SOURCE_TAGS = ["source"]
KEPT_TAGS = [*STRUCTURE_TAGS, *MEDIA_TAGS, *SOURCE_TAGS]

# Attributes that may hold an image address, best first.
IMAGE_SOURCE_ATTRIBUTES = [
    "src",
    "data-src",
    "data-src-fg",
    "data-scroll-image",
    "srcset",
    "data-lateloadsrc",
    "data-img-src",
    "data-original",
    "data-gt-lazy-src",
    "data-lazy",
    "data-lazy-src",
    "src2",
]

# Class words whose element is removed, or replaced by a text.
DROPPED_CLASSES = ["footer", "site-info"]
REPLACED_CLASSES = {"more-link": f"\n\n{END_OF_DOCUMENT}\n\n"}

# A div with one of these as its whole id, class or title is site furniture.
SPECIAL_DIV_NAMES = ["footer", "header", "navigation", "nav", "navbar", "menu"]

# --- Derived from the fixed values -------------------------------------------


def emoji_characters() -> str:
    """All characters of EMOJI_RANGES in one string."""
    chars = []
    for part in EMOJI_RANGES.split():
        first, _, last = part.partition("-")
        chars.extend(map(chr, range(int(first, 16), int(last or first, 16) + 1)))
    return "".join(chars) + "\U0001f9b0\U0001f9b1\U0001f9b2\U0001f9b3"


SPECIAL_CHARACTERS = "".join(
    dict.fromkeys(MAIN_SPECIAL_CHARACTERS + OTHER_SPECIAL_CHARACTERS + emoji_characters())
)
