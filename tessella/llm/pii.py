"""Personal data: high-recall generators propose overlapping spans, boosted trees choose among them.

Spans of the exact formats (email, ip, card, phone) are always kept. Other candidates are scored from
format and context features by trees. Rules label candidates in all documents: a value of a telling
name or of a format with a check sum is private, one that fails the checks of its format or looks like a
number, date or version is not. The trees are trained on a bounded sample of these, of every kind and
label alike; each kind has the smallest threshold that is precise enough on all labelled candidates
that the trees have not seen.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.llm.boosting import Boosted
from tessella.llm.components import cut
from tessella.llm.textkit import pieces, text_bytes

BASE = ("email", "ip", "card", "phone")
#: Candidates of a kind and label that the trees are trained on, at most.
TRAIN_CANDIDATES = 1500
PRECISION = 0.98
#: Private candidates of a kind that the trees have not seen, to set its threshold by.
MIN_EXAMPLES = 3
#: Width of a bin of scores, in log odds, and the log odds of the last bins.
BIN, LAST = 0.05, 12.0

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match can only begin where a run of digits begins, as the last part takes all digits there are.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

#: Generators of further candidates: kind, pattern, group that is the span.
GENERATORS = (
    ("secret", re.compile(r"(?<![0-9A-Za-z_-])(?=[A-Za-z_-]*[0-9])[0-9A-Za-z_-]{16,512}(?![0-9A-Za-z_-])")),
    ("contact", re.compile(r"(?<![\w.])[\w.+-]{1,64} ?(?:\[at\]|\(at\)| at ) ?[\w-]{1,64}(?: ?(?:\[dot\]|\(dot\)| dot ) ?[\w-]{1,64}){1,4}")),
    ("number", re.compile(r"(?<![0-9+])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])")),
    ("identity", re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")),
    ("account", re.compile(r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?: ?[0-9A-Z]{4}){3,7}(?: ?[0-9A-Z]{1,3})?(?![0-9A-Za-z])")),
    ("address", re.compile(r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){4,7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])")),
)
KINDS = (*BASE, *(kind for kind, _ in GENERATORS))
CONTACT = KINDS.index("contact")
#: What stands before a value and tells what it is.
_NAMES = {
    "secret": re.compile(r"(?i)(?:token|secret|passw(?:or)?d|api[ _-]?key|access[ _-]?key|key|bearer)\W{0,6}$"),
    "contact": re.compile(r"(?i)(?<![a-z])(?:e-?mail|mail|contact|write to|reach (?:me|us))(?: address)?(?: (?:is|me|us))?(?: at)?\W{0,6}$"),
    "number": re.compile(r"(?i)(?<![a-z])(?:(?:tele)?phone|tel|mobile|cell|fax|call|contact)(?: (?:number|no|is|me|us))*(?: (?:at|on))?\W{0,6}$"),
    "identity": re.compile(r"(?i)(?<![a-z])(?:ssn|social security|tax id|identity)(?: (?:number|no|is))*\W{0,6}$"),
    "account": re.compile(r"(?i)(?<![a-z])(?:iban|account)(?: (?:number|no|is))*\W{0,6}$"),
    "address": re.compile(r"(?i)(?<![a-z])(?:ip|ipv6|addr|address)(?: is)?\W{0,6}$"),
}
_OTHER = re.compile(r"(?i)(?<![a-z])(?:orders?|invoice|part|item|ref(?:erence)?|version|v|isbn|sku|case|model|serial|date|page)(?: (?:number|no|is))*\W{0,6}$")
_DATE = re.compile(
    r"(?:[12][0-9]{3}([./-])(?:0?[1-9]|1[0-2])\1(?:0?[1-9]|[12][0-9]|3[01])"
    r"|(?:0?[1-9]|[12][0-9]|3[01])([./-])(?:0?[1-9]|[12][0-9]|3[01])\2(?:[12][0-9])?[0-9]{2})"
)
_NOT_PRIVATE = re.compile(rf"[0-9]+(?:\.[0-9]+)?|[0-9]{{1,3}}(?:\.[0-9]{{1,3}}){{2}}|{_DATE.pattern}")
#: Last parts of written-out addresses that are not just words.
_DOMAINS = frozenset("com org net edu gov info biz io dev app co me us uk de fr es it nl eu ch at be se no pl pt br jp cn in ru ca au".split())

SPAN = "struct<kind:string,start:long,end:long,score:double,base:boolean>"


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if c in "0123456789")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from the @ outwards: the local part is the run before it."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        end = _DOMAIN.match(text, at + 1) if start < at else None
        if end:
            yield start, end.end()
            free = end.end()
        else:
            free = at + 1
        at = text.find("@", free)


def exact(text: str) -> list[tuple[int, int, int, bool]]:
    """(kind, start, end, valid) of every match of the exact formats, left to right in each kind."""
    out = [(0, a, b, True) for a, b in emails(text)]
    for m in _IP.finditer(text):
        out.append((1, *m.span(), all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))))
    for m in _CARD.finditer(text):
        digits = _digits(m[0]) if m.end() - m.start() < 40 else ""
        out.append((2, *m.span(), 13 <= len(digits) <= 19 and _luhn(digits)))
    for m in _PHONE.finditer(text):
        out.append((3, *m.span(), 9 <= len(_digits(m[0])) <= 15))
    return out


def candidates(text: str, found: list[tuple[int, int, int, bool]]) -> list[tuple[int, int, int]]:
    """Spans of the generators that no valid exact span overlaps."""
    taken = sorted((a, b) for _, a, b, valid in found if valid)
    out = []
    for kind, (_, pattern) in enumerate(GENERATORS, len(BASE)):
        i = 0
        for m in pattern.finditer(text):
            a, b = m.span()
            while i < len(taken) and taken[i][1] <= a:
                i += 1
            if i == len(taken) or taken[i][0] >= b:
                out.append((kind, a, b))
    return out


def named(text: str, kind: int, a: int) -> bool:
    """Does the text before say that the value is of this kind?"""
    return kind >= len(BASE) and bool(_NAMES[KINDS[kind]].search(text[max(0, a - 40) : a]))


def _valid_account(s: str) -> bool:
    s = s.replace(" ", "")
    return 15 <= len(s) <= 34 and int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def well_formed(kind: int, s: str) -> bool:
    """The checks of the kind's format that go beyond its pattern."""
    match KINDS[kind]:
        case "contact":
            return s.lower().replace("(", "[").count("[at") == 1 and len(s) - len(s.rstrip("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")) >= 2
        case "number":
            d = _digits(s)
            return d[0] > "1" and d[3] > "1"
        case "identity":
            return s[:3] not in ("000", "666") and s[0] != "9" and s[4:6] != "00" and s[7:] != "0000"
        case "account":
            return _valid_account(s)
        case "address":
            return s.count(":") == 7
    return not (s.isdigit() or re.fullmatch("[A-Z]{2}[0-9]{2}[0-9A-Z]{11,30}", s) and _valid_account(s))


def features(text: str, kind: int, a: int, b: int) -> list[float]:
    """Format: characters and their mix. Context: what stands beside the span."""
    s = text[a:b]
    n = len(s)
    digits = sum(c.isdigit() for c in s)
    letters = sum(c.isalpha() for c in s)
    counts = {c: s.count(c) for c in set(s)}
    before, after = text[max(0, a - 24) : a], text[b : b + 2]
    changes = sum(x.isdigit() != y.isdigit() for x, y in zip(s, s[1:], strict=False))
    return [
        kind,
        n,
        digits / n,
        letters / n,
        len(counts) / n,
        -sum(c / n * math.log2(c / n) for c in counts.values()),
        changes / n,
        sum(c.isupper() for c in s) / n,
        sum(c in "0123456789abcdefABCDEF" for c in s) / n,
        s.count("-") + s.count(" ") + s.count("."),
        float(s[0] == "+"),
        float("=" in before[-5:] or ":" in before[-3:]),
        float(before[-1:] in "\"'`" and bool(before)),
        float(before[-1:].isalnum()),
        float(after[:1].isalnum()),
        float(named(text, kind, a)),
        float(well_formed(kind, s)),
        float(bool(_OTHER.search(before))),
        float(kind != CONTACT or s.rpartition(" ")[2].rpartition("]")[2].rpartition(")")[2].lower() in _DOMAINS),
    ]


def _rule(text: str, kind: int, a: int, b: int) -> int | None:
    """The label that a rule gives a candidate, if any does."""
    s = text[a:b]
    digits = sum(c.isdigit() for c in s)
    fits = well_formed(kind, s)
    match KINDS[kind]:
        case "contact":
            # Brackets are never plain prose; " at " and " dot " need a name before them or a known last part.
            if fits or named(text, kind, a):
                return 1
            return None if s.rpartition(" ")[2].lower() in _DOMAINS else 0
        case "address" | "account":
            return int(fits or named(text, kind, a))
    if named(text, kind, a) and digits >= 3:
        return 1
    if _NOT_PRIVATE.fullmatch(s) or not fits or _OTHER.search(text[max(0, a - 24) : a]):
        return 0
    if KINDS[kind] == "secret" and (digits <= 2 or s.count("-") + s.count("_") > 4):
        return 0
    return None


def _bins(scores: np.ndarray) -> np.ndarray:
    p = np.clip(scores, 1e-9, 1 - 1e-9)
    return np.floor(np.clip(np.log(p / (1 - p)), -LAST, LAST) / BIN).astype(int)


class Selector:
    """The trees, and the lowest bin of scores of every kind that can be told apart well enough."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        self.trees = Boosted(x, y)
        self.thresholds: dict[int, int] = {}

    def set_thresholds(self, counts: list[tuple[int, int, int, int]], sizes: dict[tuple[int, int], int]) -> None:
        """counts: (kind, bin, label, n) of the labelled candidates that the trees have not seen.
        sizes: all candidates of a kind and label. As the trees have seen a larger share of the rare
        labels, the counts are weighted up to the sizes."""
        for k in range(len(BASE), len(KINDS)):
            own = [c for c in counts if c[0] == k]
            unseen = [sum(n for _, _, label, n in own if label == y) for y in (0, 1)]
            if unseen[1] < MIN_EXAMPLES:
                continue
            ranked = sorted({c[1] for c in own}, reverse=True)
            right = wrong = 0.0
            lowest = None
            for place, at in enumerate(ranked):
                here = [sum(n for _, bin_, label, n in own if (bin_, label) == (at, y)) for y in (0, 1)]
                right += here[1] * sizes[k, 1] / unseen[1]
                wrong += here[0] * sizes[k, 0] / unseen[0] if here[0] else 0
                if here[1] and right >= PRECISION * (right + wrong):
                    # Halfway to the next candidate below.
                    below = ranked[place + 1] if place + 1 < len(ranked) else -int(LAST / BIN)
                    lowest = max(0, (at + below + 1) // 2)
            if lowest is not None:
                self.thresholds[k] = lowest

    def choose(self, text: str, found: list[tuple[int, int, int]]) -> list[tuple[int, int, int, float]]:
        """Candidates above their threshold; of overlapping ones the best, then the leftmost, stays."""
        found = [c for c in found if c[0] in self.thresholds]
        if not found:
            return []
        scores = self.trees.predict(np.array([features(text, *c) for c in found]))
        enough = {c for c, n in zip(found, _bins(scores).tolist(), strict=True) if n >= self.thresholds[c[0]]}
        kept: list[tuple[int, int, int, float]] = []
        for (k, a, b), s in sorted(zip(found, scores.tolist(), strict=True), key=lambda x: (-x[1], x[0][1], x[0])):
            if (k, a, b) in enough and not any(p < b and a < q for _, p, q, _ in kept):
                kept.append((k, a, b, s))
        return kept


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[str | None]]]:
    """Pieces with their texts decoded; texts without a digit, an @ or a written-out one are None."""
    for batch in batches:
        for piece in pieces(batch, "text"):
            data, offsets = text_bytes(piece.column("text"))
            marks = np.concatenate([[0], np.cumsum(((data - np.uint8(48)) < 10) | (data == 64))])
            some = marks[offsets[1:]] > marks[offsets[:-1]]
            whole = data.tobytes()
            yield piece, [
                whole[a:b].decode() if m or b" at " in whole[a:b] or b"at]" in whole[a:b] or b"at)" in whole[a:b] else None
                for a, b, m in zip(offsets.tolist(), offsets[1:].tolist(), some.tolist(), strict=False)
            ]


def _labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece, texts in _texts(batches):
        rows = []
        for doc_id, text in zip(piece.column("doc_id").to_pylist(), texts, strict=True):
            if text is None:
                continue
            for k, a, b in candidates(text, exact(text)):
                label = _rule(text, k, a, b)
                if label is not None:
                    rows.append((doc_id, a, k, label, np.array(features(text, k, a, b)).tobytes()))
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["doc_id", "start", "kind", "label", "x"])


def _table(column: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(column)).reshape(len(column), -1)


def _scored(batches: Iterator[pa.RecordBatch], selector: Selector) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            bins = _bins(selector.trees.predict(_table(batch.column("x").to_pylist())))
            yield pa.RecordBatch.from_arrays([batch.column("kind"), pa.array(bins, pa.int32()), batch.column("label")], names=["kind", "bin", "label"])


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Selector | None:
    """The candidates of all documents that a rule labels, with their features, are written once. Of
    every kind and label the trees get those of the lowest hashes, two thirds of them or
    TRAIN_CANDIDATES; the thresholds come from the counts of all others."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    labelled = rows.mapInArrow(_labelled, "doc_id long, start long, kind int, label int, x binary")
    labelled = cut(labelled.select("kind", "label", "x", F.xxhash64("doc_id", "start", "kind", "x").alias("hash")))
    sizes = {(r["kind"], r["label"]): r["count"] for r in labelled.groupBy("kind", "label").count().collect()}
    if not any(label for _, label in sizes):
        return None

    def of(kind, label):
        return (F.col("kind") == kind) & (F.col("label") == label)

    # A share of the hash range with somewhat more than is needed, then the exact cut.
    few = F.lit(False)
    for (k, y), n in sizes.items():
        share = min(1.0, 1.5 * TRAIN_CANDIDATES / n)
        few |= of(k, y) & (F.col("hash") / float(1 << 64) + 0.5 <= share)
    found: dict[tuple[int, int], list] = {s: [] for s in sizes}
    for r in labelled.where(few).collect():
        found[r["kind"], r["label"]].append((r["hash"], r["x"]))
    seen = F.lit(False)
    x, y = [], []
    for s, own in sorted(found.items()):
        own = sorted(own)[: min(TRAIN_CANDIDATES, -(-2 * sizes[s] // 3))]
        x += [v for _, v in own]
        y += [s[1]] * len(own)
        seen |= of(*s) & (F.col("hash") <= own[-1][0])
    selector = Selector(_table(x), np.array(y))
    counts = labelled.where(~seen).mapInArrow(lambda b: _scored(b, selector), "kind int, bin int, label int")
    counts = counts.groupBy("kind", "bin", "label").agg(F.count("*").alias("n")).collect()
    selector.set_thresholds([(r["kind"], r["bin"], r["label"], r["n"]) for r in counts], sizes)
    return selector


def _find(batches: Iterator[pa.RecordBatch], selector: Selector | None) -> Iterator[pa.RecordBatch]:
    kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64()), ("base", pa.bool_())])
    for piece, texts in _texts(batches):
        out = []
        for text in texts:
            spans = []
            if text is not None:
                found = exact(text)
                spans = [(k, a, b, 1.0, True) for k, a, b, valid in found if valid]
                if selector:
                    spans += [(*s, False) for s in selector.choose(text, candidates(text, found))]
            out.append([dict(zip(("kind", "start", "end", "score", "base"), (KINDS[s[0]], *s[1:]), strict=True)) for s in sorted(spans)])
        yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(out, pa.list_(kind))], names=["doc_id", "spans"])


def find_private(docs: DataFrame, selector: Selector | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, spans), one row per row of `docs`; offsets are code points, by kind and start.

    The whole text is read where it stands; nothing is shuffled. Exact spans (`base`) do not depend on
    the selector; without one there are no others. A null text has no spans; a null id is passed on.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(lambda batches: _find(batches, selector), f"doc_id long, spans array<{SPAN}>")


def redact(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with <KIND> for every span; overlapping spans are covered together."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], f"<{kind.upper()}>"]
        at = max(at, b)
    return "".join(out) + text[at:]
