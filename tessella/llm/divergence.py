"""Source divergence audit by one-hot level products.

Every (lang, source) group prices each kept term of its language with a smoothed integer
probability p = 1 + floor(1e9 * (count + 5) / (N + 5 * V)); a source is compared with every other
source of its language (part `pair`) and with its language as a whole (part `term`).

The method. Write X for the matrix whose rows are the kept terms of a language and whose columns
are indicators of (group, count level): X[t, (g, a)] = 1 when group g holds term t `a` times.
X^T X holds every joint table n_{g,h}(a, b) = #terms with level a in g and b in h, and the
divergence of g and h is priced cell by cell: sum over (a, b) of n(a, b) * |p_g(a) - p_h(b)|.
Most cells have a zero level on one side, so the product is taken only over the nonzero
indicators (a join on the term, partially aggregated per task: the blocks of the product, summed
by the final aggregation), and the zero-level cells are priced from each group's level marginals (the nonzero cells are
priced as the product forms them, so no task ships more than one row per pair of groups):

    value(g, h) = S(g, h) + S(h, g) + (V - M_g - M_h) * |p_g(0) - p_h(0)|
                  + sum over nonzero cells n(a, b) * corr(a, b)
    S(g, h)     = sum over levels a > 0 of m_g(a) * |p_g(a) - p_h(0)|
    corr(a, b)  = |p_g(a) - p_h(b)| - |p_g(a) - p_h(0)| - |p_g(0) - p_h(b)| + |p_g(0) - p_h(0)|

with m_g(a) the number of terms at level a in g and M_g the number of terms with a level above 0.
S is a sum of distances to one point; it is taken for all h at once from running sums over g's
levels sorted by price (a range union and a window, no pairs of levels).

Rows and names. Null text, lang and source read as ''. Terms are the matches of
[^\x00-\x40\x5B-\x60\x7B-\x7F]+ (runs of ASCII letters and of any character beyond ASCII) with
A-Z lower-cased and nothing else changed. A language keeps the terms that occur in at least
MIN_DOCS of its rows (rows, not distinct ids: repeated rows count each time). Every (lang, source)
that occurs is a group, even one without any term or with an empty text; a language with V = 0
gives pair values of 0. Ranks are per (lang, source, part), value descending, item ascending in
UTF-8 byte order. Columns besides text, lang and source are never read, so clashing names do not
matter. Empty input gives an empty result. All arithmetic is in integers (decimal for 1e9 *
count, which may pass 2^63 on a large corpus).
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessella.sources.storage import settle

#: Fixed values of the contract: term pattern, minimum documents, smoothing, scale, ranks of part `term`.
TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_DOCS = 30
SMOOTH = 5
SCALE = 1_000_000_000
TOP_TERMS = 50
#: Part `term` is ranked first within these hash slices of a group's terms, then across them.
TERM_SLICES = 64

_D = "decimal(38,0)"


def _price(count: str, total: str, vocab: str):
    """1 + floor(SCALE * (count + SMOOTH) / (total + SMOOTH * vocab)), exact; `div` on decimals
    divides whole numbers and both sides are positive. A language without kept terms prices
    nothing; its groups' p0 is then 1 and never used."""
    return F.expr(
        f"CASE WHEN {vocab} > 0 THEN 1 + div(cast({SCALE} as {_D}) * cast({count} + {SMOOTH} as {_D}), "
        f"cast({total} + {SMOOTH} * {vocab} as {_D})) ELSE 1 END"
    )


#: Bytes of texts of terms become lower-cased, all others blanks. In UTF-8 the bytes above 127 are
#: those of the characters beyond ASCII.
_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b > 127 else 32 for b in range(256))
#: Different terms that a task holds before it ships their counts.
HELD_TERMS = 1 << 18


def count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, text) to (lang, source, term, count, rows), summed within a task; each group
    also has a row with a null term, so that one without terms is there."""
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def shipped() -> pa.RecordBatch:
        columns = [[], [], [], [], []]
        for (lang, source), (counts, rows) in held.items():
            n = len(counts) + 1
            columns[0] += [lang] * n
            columns[1] += [source] * n
            columns[2] += [None, *counts]
            columns[3] += [0, *counts.values()]
            columns[4] += [0, *(rows[t] for t in counts)]
        kinds = [pa.string(), pa.string(), pa.binary(), pa.int64(), pa.int64()]
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
        arrays[2] = arrays[2].cast(pa.string())
        held.clear()
        return pa.RecordBatch.from_arrays(arrays, names=["lang", "source", "term", "count", "rows"])

    size = 0
    for batch in batches:
        for lang, source, text in zip(*(batch.column(c).to_pylist() for c in ("lang", "source", "text")), strict=True):
            counts, rows = held.setdefault((lang, source), (Counter(), Counter()))
            terms = text.encode().translate(_TERM_BYTES).split()
            size -= len(counts)
            counts.update(terms)
            rows.update(set(terms))
            size += len(counts)
            if size >= HELD_TERMS:
                yield shipped()
                size = 0
    if held:
        yield shipped()


def prepare(documents: DataFrame, min_docs: int = MIN_DOCS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """groups (lang, source, N, V, p0), entries (lang, source, term, count > 0, p, the group's p0), and languages'
    kept terms (lang, term, lang_count, q)."""
    d = documents.select(
        F.coalesce(F.col("lang"), F.lit("")).alias("lang"),
        F.coalesce(F.col("source"), F.lit("")).alias("source"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    facts = (
        d.mapInArrow(count_terms, "lang string, source string, term string, count bigint, rows bigint")
        .groupBy("lang", "source", "term")
        .agg(F.sum("count").alias("count"), F.sum("rows").alias("rows"))
    )
    # Texts are read and split once: every later table derives from these counts, written as Parquet
    # in the shared folder, where the repeated langs, sources and terms take little room. A row
    # without terms leaves its group a row with a null term.
    facts = settle(facts)
    groups = facts.select("lang", "source").distinct()
    facts = facts.where(F.col("term").isNotNull())
    kept = (
        facts.groupBy("lang", "term")
        .agg(F.sum("rows").alias("rows"), F.sum("count").alias("lang_count"))
        .where(F.col("rows") >= min_docs)
        .drop("rows")
    )
    entries = facts.join(kept.select("lang", "term"), ["lang", "term"]).select("lang", "source", "term", "count")
    vocab = groups.select("lang").distinct().join(kept.groupBy("lang").agg(F.count("*").alias("V")), "lang", "left")
    totals = entries.groupBy("lang", "source").agg(F.sum("count").alias("N"))
    groups = (
        groups.join(totals, ["lang", "source"], "left")
        .join(vocab, "lang")
        .select("lang", "source", F.coalesce("N", F.lit(0)).alias("N"), F.coalesce("V", F.lit(0)).alias("V"))
        .withColumn("p0", _price("0", "N", "V"))
    )
    groups = settle(groups)
    langs = groups.groupBy("lang").agg(F.sum("N").alias("NL"), F.first("V").alias("V"))
    kept = kept.join(langs, "lang").select("lang", "term", "lang_count", _price("lang_count", "NL", "V").alias("q"))
    entries = entries.join(groups, ["lang", "source"]).select("lang", "source", "term", "count", _price("count", "N", "V").alias("p"), "p0")
    return groups, settle(entries), kept


def pair_part(groups: DataFrame, entries: DataFrame) -> DataFrame:
    """(lang, source, item, value): the priced joint tables of every ordered pair of groups."""
    g = groups.select("lang", "source", "V", "p0")
    h = groups.select("lang", F.col("source").alias("item"), F.col("p0").alias("h0"))
    pairs = g.join(h, "lang").where(F.col("source") != F.col("item"))
    # Level marginals m_g(a), their prices, and S(g, h) from running sums in price order.
    levels = entries.groupBy("lang", "source", "count", "p").agg(F.count("*").alias("m"))
    marks = levels.groupBy("lang", "source").agg(F.sum("m").alias("M"))
    points = levels.select(
        "lang", "source", F.col("p").alias("key"), F.lit(0).alias("kind"), "m", (F.col("m") * F.col("p")).alias("mp"),
        F.lit(None).cast("string").alias("item"),
    ).unionByName(
        pairs.select(
            "lang", "source", F.col("h0").alias("key"), F.lit(1).alias("kind"), F.lit(0).cast("long").alias("m"),
            F.lit(0).cast("long").alias("mp"), "item",
        )
    )
    upto = Window.partitionBy("lang", "source").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("lang", "source")
    c = F.col("key")
    spread = (
        points.select(
            "*",
            F.sum("m").over(upto).alias("cm"), F.sum("mp").over(upto).alias("cmp"),
            F.sum("m").over(whole).alias("tm"), F.sum("mp").over(whole).alias("tmp"),
        )
        .where("kind = 1")
        .select("lang", "source", "item", (c * F.col("cm") - F.col("cmp") + (F.col("tmp") - F.col("cmp")) - c * (F.col("tm") - F.col("cm"))).alias("S"))
    )
    # The product over nonzero indicators: a join on the term. Each joint-table cell (a, b) is
    # priced as the product forms it, so the partial aggregation of every task (a block of the
    # product) is one row per pair of groups, and the final aggregation sums the blocks.
    left = entries.select("lang", "term", "source", F.col("p").alias("pa"), "p0")
    right = entries.select("lang", "term", F.col("source").alias("item"), F.col("p").alias("pb"), F.col("p0").alias("h0"))
    fix = (
        left.join(right, ["lang", "term"])
        .where(F.col("source") != F.col("item"))
        .groupBy("lang", "source", "item")
        .agg(
            F.sum(
                F.abs(F.col("pa") - F.col("pb")) - F.abs(F.col("pa") - F.col("h0"))
                - F.abs(F.col("p0") - F.col("pb")) + F.abs(F.col("p0") - F.col("h0"))
            ).alias("C")
        )
    )
    back = spread.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), F.col("S").alias("S2"))
    mg = marks.select("lang", "source", F.col("M").alias("Mg"))
    mh = marks.select("lang", F.col("source").alias("item"), F.col("M").alias("Mh"))
    zero = F.lit(0)
    return (
        pairs.join(spread, ["lang", "source", "item"], "left")
        .join(back, ["lang", "source", "item"], "left")
        .join(fix, ["lang", "source", "item"], "left")
        .join(mg, ["lang", "source"], "left")
        .join(mh, ["lang", "item"], "left")
        .select(
            "lang", "source", "item",
            (
                F.coalesce("S", zero) + F.coalesce("S2", zero) + F.coalesce("C", zero)
                + (F.col("V") - F.coalesce("Mg", zero) - F.coalesce("Mh", zero)) * F.abs(F.col("p0") - F.col("h0"))
            ).cast("long").alias("value"),
        )
    )


def term_part(entries: DataFrame, kept: DataFrame, top: int = TOP_TERMS) -> DataFrame:
    """(lang, source, item, value, rank): the terms a group holds above its language, top `top`."""
    over = (
        entries.join(kept, ["lang", "term"])
        .where(F.col("p") > F.col("q"))
        .select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).cast("long").alias("value"))
    )
    order = [F.col("value").desc(), F.col("item").asc()]
    # A group's terms are ranked within hash slices first, so that no task holds all terms of a large group.
    sliced = Window.partitionBy("lang", "source", F.pmod(F.xxhash64("item"), F.lit(TERM_SLICES))).orderBy(*order)
    every = Window.partitionBy("lang", "source").orderBy(*order)
    return (
        over.withColumn("rank", F.row_number().over(sliced))
        .where(F.col("rank") <= top)
        .withColumn("rank", F.row_number().over(every))
        .where(F.col("rank") <= top)
    )


def divergence_audit(documents: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """lang, source, part ('pair' or 'term'), item, value long, rank int; see the module text."""
    groups, entries, kept = prepare(documents, min_docs)
    pairs = pair_part(groups, entries).withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item").asc()))
    )
    terms = term_part(entries, kept, top)
    return pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.col("rank").cast("int")).unionByName(
        terms.select("lang", "source", F.lit("term").alias("part"), "item", "value", F.col("rank").cast("int"))
    )
