"""Page operators: from the node array of a page to an interleaved document.

Each operator maps the `nodes` array of a page (see schema.DOM_NODE) to a new array
inside the row. Nothing here shuffles; the whole flow from HTML to documents is one
narrow stage however large the input is.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella import constants as C
from tessella import schema
from tessella.functions import intervals as IV
from tessella.functions import text as T
from tessella.functions import urls as U
from tessella.functions.arrays import let

TEXT_TAG = "-text"


def clean_html(html: Column) -> Column:
    """The four string rewrites that come before parsing."""
    html = T.where_found(html, "\n\n", T.collapse_linebreaks)
    html = T.where_found(html, "  ", T.collapse_spaces)
    return T.mark_line_breaks(T.where_found(html, "<!--", T.drop_comments))


# --- Selecting nodes ----------------------------------------------------------


def _no(node: Column) -> Column:
    return F.element_at(node["path"], -1)["no"]


def _parent_no(node: Column) -> Column:
    return F.try_element_at(node["path"], F.lit(-2))["no"]


def _is_text(node: Column) -> Column:
    return node["tag"] == TEXT_TAG


def _is_blank(text: Column) -> Column:
    return ~F.coalesce(text, F.lit("")).rlike("[^" + T.BLANK_CLASS[1:])


def _has_class(node: Column, words: list[str]) -> Column:
    classes = F.split(F.coalesce(F.element_at(node["attrs"], "class"), F.lit("")), "\\s+")
    return F.arrays_overlap(classes, F.array(*map(F.lit, words)))


def _numbers(nodes: Column, condition) -> Column:
    return F.transform(F.filter(nodes, condition), _no)


# Nodes carry their pre-order number and the number of their last descendant (`end`), so every
# "inside" or "parent" question is answered for a whole page at once by tessella.functions.intervals
# (one sweep over the page, never a search of one node in a list of others). Those are Arrow column
# functions; they take arrays of numbers and flags built here and are never called inside a lambda.


def _nos(nodes: Column) -> Column:
    return F.transform(nodes, _no)


def _ends(nodes: Column) -> Column:
    return F.transform(nodes, lambda n: F.coalesce(n["end"], _no(n)))


def _parents(nodes: Column) -> Column:
    return F.transform(nodes, _parent_no)


def _flags(nodes: Column, condition) -> Column:
    return F.transform(nodes, lambda n: F.coalesce(condition(n), F.lit(False)))


def _drop_flagged(nodes: Column, drop: Column) -> Column:
    """The nodes whose flag in the aligned array `drop` is false."""
    pairs = F.zip_with(nodes, drop, lambda n, d: F.struct(n.alias("n"), d.alias("d")))
    return F.transform(F.filter(pairs, lambda x: ~F.coalesce(x["d"], F.lit(False))), lambda x: x["n"])


def _without_subtrees(nodes: Column, condition) -> Column:
    """Nodes that are not, and are not inside, a node that meets the condition."""
    roots = _flags(nodes, condition)
    inside = IV.strictly_inside(_nos(nodes), _ends(nodes), roots)
    return _drop_flagged(nodes, F.zip_with(roots, inside, lambda r, i: r | i))


# --- Tree simplification --------------------------------------------------------


def drop_matching(nodes: Column, classes: list[str] = C.DROPPED_CLASSES) -> Column:
    """Remove every subtree whose root carries one of the class words."""
    return _without_subtrees(nodes, lambda n: _has_class(n, classes) & (n["tag"] != "html"))


def _replace_one(nodes: Column, word: str, text: str) -> Column:
    roots = _flags(nodes, lambda n: _has_class(n, [word]))
    inside = IV.strictly_inside(_nos(nodes), _ends(nodes), roots)

    def as_text(n: Column) -> Column:
        parent = F.slice(n["path"], 1, F.size(n["path"]) - 1)
        leaf = F.array(F.struct(F.lit(TEXT_TAG).alias("tag"), _no(n).alias("no")))
        return (
            n.withField("tag", F.lit(TEXT_TAG))
            .withField("path", F.concat(parent, leaf))
            .withField("text", F.lit(text))
            .withField("end", _no(n))
        )

    marked = F.zip_with(nodes, roots, lambda n, r: F.when(r, as_text(n)).otherwise(n))
    return _drop_flagged(marked, inside)


def replace_matching(nodes: Column, texts: dict[str, str] = C.REPLACED_CLASSES) -> Column:
    """Replace every subtree whose root carries a class word by a text leaf."""
    for word, text in texts.items():
        nodes = _replace_one(nodes, word, text)
    return nodes


def unwrap_inline(nodes: Column, tags: list[str] = C.INLINE_TAGS) -> Column:
    """Take inline elements out of the tree and keep what is in them."""
    return F.transform(
        F.filter(nodes, lambda n: ~n["tag"].isin(tags)),
        lambda n: n.withField("path", F.filter(n["path"], lambda e: ~e["tag"].isin(tags))),
    )


def _is_foreign(tag: Column, tags: list[str]) -> Column:
    return (tag != TEXT_TAG) & ~F.regexp_replace(tag, "[0-9]+", "").isin(tags)


def strip_uninteresting(nodes: Column, tags: list[str] = C.KEPT_TAGS, mode: str = "drop") -> Column:
    """Remove elements outside the list, with their content ('drop') or without ('unwrap')."""
    if mode == "unwrap":
        return F.transform(
            F.filter(nodes, lambda n: ~_is_foreign(n["tag"], tags)),
            lambda n: n.withField("path", F.filter(n["path"], lambda e: ~_is_foreign(e["tag"], tags))),
        )
    if mode != "drop":
        raise ValueError("mode must be 'drop' or 'unwrap'")
    return F.filter(nodes, lambda n: ~F.exists(n["path"], lambda e: _is_foreign(e["tag"], tags)))


def strip_special_divs(nodes: Column, names: list[str] = C.SPECIAL_DIV_NAMES) -> Column:
    """Remove divs whose whole id, class or title is a name of site furniture."""

    def special(n: Column) -> Column:
        hits = [F.coalesce(F.element_at(n["attrs"], a).isin(names), F.lit(False)) for a in ("id", "class", "title")]
        return (n["tag"] == "div") & (hits[0] | hits[1] | hits[2])

    return _without_subtrees(nodes, special)


def drop_date_text(nodes: Column) -> Column:
    """Remove the texts directly in a div whose class holds `date`."""
    dated = _flags(
        nodes, lambda n: (n["tag"] == "div") & F.coalesce(F.element_at(n["attrs"], "class").contains("date"), F.lit(False))
    )
    under = IV.parent_in(_parents(nodes), _nos(nodes), dated)
    return _drop_flagged(nodes, F.zip_with(nodes, under, lambda n, u: _is_text(n) & u))


def inner_sources(nodes: Column) -> Column:
    """For every node, the address of the first `source` element inside it with one, else NULL."""
    sources = _flags(nodes, lambda n: (n["tag"] == "source") & (F.element_at(n["attrs"], "src") != ""))
    first = IV.first_inside(_nos(nodes), _ends(nodes), sources)
    return F.transform(first, lambda k: F.when(k >= 0, F.element_at(F.get(nodes, k.cast("int"))["attrs"], "src")))


def media_source(node: Column, inner_src: Column) -> Column:
    """Address of a media node; NULL for anything else.

    Video and audio use their own `src`, else the first `source` element inside (`inner_src`,
    from inner_sources).
    """
    own = F.when(F.element_at(node["attrs"], "src") != "", F.element_at(node["attrs"], "src"))
    return F.when(node["tag"] == "img", U.image_source(node["attrs"])).when(
        node["tag"].isin("video", "audio"), U.usable_source(F.coalesce(own, inner_src))
    )


def drop_empty_leaves(nodes: Column, inner: Column) -> Column:
    """Remove elements with neither text nor sourced media in them.

    A blank text is kept only inside an element that stays, because it may separate
    its neighbours. Figures and pictures are looked into, other media are leaves.
    `inner` is inner_sources(nodes), made in an earlier projection (see drop_empty_nodes).
    """
    leaf_media = [t for t in C.MEDIA_TAGS if t not in ("figure", "picture")]
    alive = F.zip_with(
        nodes,
        inner,
        lambda n, src: F.coalesce((_is_text(n) & ~_is_blank(n["text"])) | media_source(n, src).isNotNull(), F.lit(False)),
    )
    codes = IV.live_codes(_nos(nodes), _ends(nodes), _parents(nodes), alive, _flags(nodes, lambda n: n["tag"].isin(leaf_media)))
    drop = F.zip_with(
        nodes,
        codes,
        lambda n, c: (c == 4) | ~F.when(_is_text(n), c >= 2).otherwise((c % 2 == 1) | (n["tag"] == "html")),
    )
    return _drop_flagged(nodes, drop)


def drop_empty_nodes(pages_nodes: DataFrame, column: str = "nodes") -> DataFrame:
    """drop_empty_leaves on a table: the inner sources first, in a projection of their own, as
    Catalyst does not take an Arrow function apart from another whose result it reads."""
    inner = pages_nodes.withColumn("_inner", inner_sources(F.col(column)))
    return inner.withColumn(column, drop_empty_leaves(F.col(column), F.col("_inner"))).drop("_inner")


def unnest_same_tag(nodes: Column) -> Column:
    """Collapse an element whose only content is one element of the same tag."""

    def code(n: Column) -> Column:
        same = F.when(n["tag"] == F.try_element_at(n["path"], F.lit(-2))["tag"], IV.ELEMENT | IV.SAME_AS_PARENT)
        return F.when(_is_text(n), F.when(_is_blank(n["text"]), 0).otherwise(IV.FILLED_TEXT)).otherwise(
            F.coalesce(same, F.lit(IV.ELEMENT))
        )

    hits = IV.collapsed(F.transform(nodes, lambda n: n["path"]["no"]), _nos(nodes), _parents(nodes), F.transform(nodes, code))

    def unwrapped(n: Column, h: Column) -> Column:
        entries = F.zip_with(n["path"], h, lambda e, f: F.struct(e.alias("e"), f.alias("f")))
        return n.withField("path", F.transform(F.filter(entries, lambda x: ~x["f"]), lambda x: x["e"]))

    # The last entry of a path is the node itself.
    pairs = F.filter(
        F.zip_with(nodes, hits, lambda n, h: F.struct(n.alias("n"), h.alias("h"))),
        lambda x: ~F.coalesce(F.element_at(x["h"], -1), F.lit(False)),
    )
    return F.transform(pairs, lambda x: F.when(x["h"].isNull(), x["n"]).otherwise(unwrapped(x["n"], x["h"])))


def _islands(nodes: Column, starts_new, build) -> Column:
    """Cut an array where `starts_new(node, i, nodes)` holds and build one value per piece."""

    def cut(all_nodes: Column) -> Column:
        starts = F.array_compact(
            F.transform(all_nodes, lambda n, i: F.when((i == 0) | starts_new(n, i, all_nodes), i))
        )
        return let(
            starts,
            lambda s: F.transform(
                s,
                lambda start, k: build(
                    F.slice(all_nodes, start + 1, F.coalesce(F.get(s, k + 1), F.size(all_nodes)) - start)
                ),
            ),
        )

    return let(nodes, cut)


def remerge_text(nodes: Column) -> Column:
    """Fuse neighbouring text leaves of the same parent."""

    def starts_new(n: Column, i: Column, all_nodes: Column) -> Column:
        before = F.get(all_nodes, i - 1)
        return ~(_is_text(n) & _is_text(before) & _parent_no(n).eqNullSafe(_parent_no(before)))

    def fused(piece: Column) -> Column:
        first = F.get(piece, F.lit(0))
        return F.when(F.size(piece) == 1, first).otherwise(
            first.withField("text", F.array_join(piece["text"], ""))
        )

    return _islands(nodes, starts_new, fused)


SIMPLIFICATIONS = (
    drop_matching,
    replace_matching,
    unwrap_inline,
    strip_uninteresting,
    strip_special_divs,
    drop_date_text,
    drop_empty_leaves,
    unnest_same_tag,
    remerge_text,
)


def _node_code(n: Column) -> Column:
    """What the steps up to drop_empty_leaves need to know of a node, as bits (see functions.intervals)."""
    classes = F.element_at(n["attrs"], "class")
    src = F.element_at(n["attrs"], "src")
    leaf_media = [t for t in C.MEDIA_TAGS if t not in ("figure", "picture")]
    special = [F.element_at(n["attrs"], a).isin(C.SPECIAL_DIV_NAMES) for a in ("id", "class", "title")]

    def bit(condition: Column, value: int) -> Column:
        return F.when(condition, value).otherwise(0)

    def classed(code: Column) -> Column:
        return F.when(classes.isNull(), 0).otherwise(code)

    filled = [word for word, text in C.REPLACED_CLASSES.items() if text.strip()]
    blank = [word for word, text in C.REPLACED_CLASSES.items() if not text.strip()]
    if blank and filled:
        raise ValueError("replacing texts must all be blank or all hold something")
    by_class = classed(
        bit(_has_class(n, C.DROPPED_CLASSES) & (n["tag"] != "html"), IV.DROPPED)
        + bit(_has_class(n, list(C.REPLACED_CLASSES)), IV.REPLACED | (IV.ALIVE_AS_TEXT if filled else 0))
        + bit((n["tag"] == "div") & classes.contains("date"), IV.DATED)
    )
    foreign = ~n["tag"].isin(C.KEPT_TAGS) & _is_foreign(n["tag"], C.KEPT_TAGS)
    film = (
        F.when(F.coalesce(src, F.lit("")) == "", IV.ASKS_INNER)
        .when(U.usable_source(src).isNotNull(), IV.ALIVE)
        .otherwise(0)
    )
    element = (
        F.when(classes.isNotNull() & _has_class(n, list(C.REPLACED_CLASSES)), 0)
        .when(n["tag"].isin(C.INLINE_TAGS), IV.UNWRAPPED)
        .when(foreign, IV.DROPPED)
        .when((n["tag"] == "div") & F.coalesce(F.greatest(*special), F.lit(False)), IV.DROPPED)
        .otherwise(0)
    )
    media = (
        F.when(n["tag"] == "img", bit(U.image_source(n["attrs"]).isNotNull(), IV.ALIVE))
        .when(n["tag"].isin("video", "audio"), film)
        .when(n["tag"] == "source", bit(src != "", IV.SOURCE) + bit(U.usable_source(src).isNotNull(), IV.USABLE))
        .when(n["tag"] == "html", IV.ROOT)
        .otherwise(0)
    )
    own = F.when(_is_text(n), bit(~_is_blank(n["text"]), IV.ALIVE) + IV.TEXT).otherwise(
        element + media + bit(n["tag"].isin(leaf_media), IV.LEAF)
    )
    return own.bitwiseOR(by_class)


def _replacing_text(n: Column) -> Column:
    """The text that takes the place of a node; the last class word counts."""
    return F.coalesce(*(F.when(_has_class(n, [w]), F.lit(t)) for w, t in reversed(C.REPLACED_CLASSES.items())))


def _simplified_nodes(nodes: Column, codes: Column, stays: Column) -> Column:
    """The nodes that stay, with the texts of replaced ones and paths without inline elements."""

    def path_without(path: Column) -> Column:
        return F.filter(path, lambda e: ~e["tag"].isin(C.INLINE_TAGS))

    def made(x: Column) -> Column:
        n = x["n"]
        leaf = F.array(F.struct(F.lit(TEXT_TAG).alias("tag"), _no(n).alias("no")))
        as_text = (
            n.withField("tag", F.lit(TEXT_TAG))
            .withField("path", F.concat(path_without(F.slice(n["path"], 1, F.size(n["path"]) - 1)), leaf))
            .withField("text", _replacing_text(n))
            .withField("end", _no(n))
        )
        return (
            F.when(x["c"].bitwiseAND(IV.REPLACED) != 0, as_text)
            .when(x["s"] == IV.INSIDE_UNWRAPPED, n.withField("path", path_without(n["path"])))
            .otherwise(n)
        )

    pairs = F.zip_with(nodes, codes, lambda n, c: F.struct(n.alias("n"), c.alias("c")))
    marked = F.zip_with(pairs, stays, lambda x, s: x.withField("s", s))
    return F.transform(F.filter(marked, lambda x: x["s"] != IV.GONE), made)


def simplify(pages_nodes: DataFrame) -> DataFrame:
    """All tree simplifications, with the result of SIMPLIFICATIONS one after the other.

    Every step up to drop_empty_leaves takes out whole subtrees or single nodes by what the nodes
    themselves are, so one sweep over the codes of a page's nodes decides for all of them.
    """
    nodes, codes = F.col("nodes"), F.col("_codes")
    coded = pages_nodes.withColumn("_codes", F.transform(nodes, _node_code))
    swept = coded.withColumn("_stays", IV.simplified(_nos(nodes), _ends(nodes), _parents(nodes), codes))
    left = swept.withColumn("nodes", _simplified_nodes(nodes, codes, F.col("_stays"))).drop("_codes", "_stays")
    left = left.withColumn("nodes", unnest_same_tag(nodes))
    return left.withColumn("nodes", remerge_text(nodes))


# --- Leaves to document nodes ------------------------------------------------------


def image_record(attrs: Column, page_url: Column, raw_src: Column) -> Column:
    """Record of an image, or NULL when its address is missing or not valid."""

    def record(src: Column) -> Column:
        def attr(name: str) -> Column:
            return F.element_at(attrs, name)

        return F.when(
            U.is_valid_url(src),
            F.struct(
                page_url.alias("document_url"),
                raw_src.alias("unformatted_src"),
                src.alias("src"),
                F.nullif(U.filename_text(src), F.lit("")).alias("formatted_filename"),
                F.nullif(attr("alt"), F.lit("")).alias("alt_text"),
                U.size_px(attr("width")).alias("rendered_width_px"),
                U.size_pct(attr("width")).alias("rendered_width_pct"),
                U.size_px(attr("height")).alias("rendered_height_px"),
                U.size_pct(attr("height")).alias("rendered_height_pct"),
            ),
        )

    return let(U.absolutize(page_url, raw_src), record)


def media_record(node: Column, page_url: Column, inner_src: Column) -> Column:
    """Record of an image, video or audio node, NULL without a valid address; `inner_src` is the
    node's entry of inner_sources."""
    raw = media_source(node, inner_src)
    src = U.absolutize(page_url, raw)
    return F.when(
        U.is_valid_url(src),
        F.struct(
            node["tag"].alias("tag"),
            page_url.alias("document_url"),
            src.alias("src"),
            F.when(node["tag"] == "video", F.element_at(node["attrs"], "width")).alias("width"),
            F.when(node["tag"] == "video", F.element_at(node["attrs"], "height")).alias("height"),
            F.when(node["tag"] == "img", image_record(node["attrs"], page_url, raw)).alias("image"),
        ),
    )


def caption(node: Column, figure_caption: Column) -> Column:
    """Caption of an image: that of its figure, else alt, else title, else ''."""
    return F.coalesce(
        figure_caption,
        F.nullif(F.element_at(node["attrs"], "alt"), F.lit("")),
        F.nullif(F.element_at(node["attrs"], "title"), F.lit("")),
        F.lit(""),
    )


def keep_text_and_images(nodes: Column, page_url: Column, captions: Column) -> Column:
    """Leaves of the document: formatted texts, and images that have a record.

    Gives structs of kind, text, src, caption, meta and path. Empty texts are gone. `captions`
    holds, aligned with the nodes, the figure caption of each (see with_captions).
    """

    def leaf(x: Column) -> Column:
        n = x["n"]
        record = let(U.image_source(n["attrs"]), lambda raw: image_record(n["attrs"], page_url, raw))
        meta = F.when(n["tag"] == "img", record)

        def made(m: Column) -> Column:
            is_text = _is_text(n)
            return F.struct(
                F.when(is_text, F.lit("text")).when(m.isNotNull(), F.lit("image")).alias("kind"),
                F.when(is_text, T.format_text(n["text"])).alias("text"),
                m["src"].alias("src"),
                F.when(m.isNotNull(), caption(n, x["c"])).alias("caption"),
                m.alias("meta"),
                n["path"].alias("path"),
            )

        return let(meta, made)

    pairs = F.zip_with(nodes, captions, lambda n, c: F.struct(n.alias("n"), c.alias("c")))
    candidates = F.filter(pairs, lambda x: _is_text(x["n"]) | (x["n"]["tag"] == "img"))
    return F.filter(
        F.transform(candidates, leaf),
        lambda n: (n["kind"] == "image") | ((n["kind"] == "text") & (n["text"] != "")),
    )


def with_captions(pages_nodes: DataFrame, column: str = "nodes", out: str = "_captions") -> DataFrame:
    """Adds `out`: the figure caption of every node, from one sweep over each page (B18)."""
    nodes = F.col(column)

    def holder(n: Column) -> Column:
        at = F.array_position(F.reverse(n["path"]["tag"]), "figure")
        figure = F.get(F.reverse(n["path"]["no"]), at.cast("int") - 1)
        return F.when(n["tag"] == "figcaption", F.coalesce(figure, _parent_no(n)))

    def caption_leaf(n: Column) -> Column:
        inside = F.when(_is_text(n), F.array_contains(n["path"]["tag"], "figcaption"))
        return F.when(inside, T.strip_blanks(n["text"]))

    texts = IV.figure_captions(_nos(nodes), _ends(nodes), F.transform(nodes, holder), F.transform(nodes, caption_leaf))
    return pages_nodes.withColumn(out, texts)


def _tag_strength(tag: Column) -> Column:
    strong = [t for t, s in C.TEXT_SEPARATORS.items() if s == "\n\n"]
    line = [t for t, s in C.TEXT_SEPARATORS.items() if s == "\n"]
    return F.when(tag.isin(strong), 3).when(tag.isin(line), 2).otherwise(0)


def _path_strength(left: Column, right: Column) -> Column:
    """Strongest separator of the tags that the two paths do not share."""
    apart = F.concat(F.array_except(left, right), F.array_except(right, left))
    return F.coalesce(F.array_max(F.transform(apart["tag"], _tag_strength)), F.lit(0))


def _blank_strength(blank: Column) -> Column:
    return (
        F.when(blank.contains("\n\n"), 3)
        .when(blank.contains("\n"), 2)
        .when(blank.contains(" "), 1)
        .otherwise(0)
    )


def _joined(left: Column, right: Column, strength: Column) -> Column:
    """Two texts with one separator between them.

    Up to a blank line, a newline and a space are taken off each side of the border;
    the strongest of these and of the tags is put back.
    """
    tail = F.regexp_extract(F.right(left, F.lit(4)), " ?\\n{0,3}\\z", 0)
    head = F.regexp_extract(F.left(right, F.lit(4)), "\\A\\n{0,3} ?", 0)

    def glue(t: Column, h: Column) -> Column:
        strongest = F.greatest(strength, _blank_strength(t), _blank_strength(h))
        separator = F.when(strongest == 3, "\n\n").when(strongest == 2, "\n").when(strongest == 1, " ").otherwise("")
        return F.concat(
            F.left(left, F.length(left) - F.length(t)), separator, F.substring(right, F.length(h) + 1, F.length(right))
        )

    return let(tail, lambda t: let(head, lambda h: glue(t, h)))


def merge_text_nodes(leaves: Column) -> Column:
    """Fold each run of text leaves into one text node; blank results are dropped."""

    def starts_new(n: Column, i: Column, all_leaves: Column) -> Column:
        return (n["kind"] == "image") | (F.get(all_leaves, i - 1)["kind"] == "image")

    def folded(piece: Column) -> Column:
        first = F.get(piece, F.lit(0))
        text = F.aggregate(
            F.slice(piece, 2, F.size(piece)),
            F.struct(first["text"].alias("text"), first["path"].alias("path")),
            lambda acc, n: F.struct(
                _joined(acc["text"], n["text"], _path_strength(acc["path"], n["path"])).alias("text"),
                n["path"].alias("path"),
            ),
            lambda acc: T.strip_blanks(acc["text"]),
        )
        return F.when(first["kind"] == "image", first).otherwise(first.withField("text", text))

    return F.filter(_islands(leaves, starts_new, folded), lambda n: (n["kind"] == "image") | (n["text"] != ""))


def document_nodes(leaves: Column) -> Column:
    """Leaves without their paths, as stored in a web document."""
    return F.transform(
        leaves,
        lambda n: F.struct(*[n[f.name].alias(f.name) for f in schema.DOC_NODE.fields]),
    )


def extract_leaves(pages_nodes: DataFrame) -> DataFrame:
    captioned = with_captions(pages_nodes)
    return captioned.withColumn("nodes", keep_text_and_images(F.col("nodes"), F.col("url"), F.col("_captions"))).drop("_captions")


def pack_documents(pages_nodes: DataFrame) -> DataFrame:
    """Web documents from pages with parsed nodes; a failed page stays as an empty one."""
    merged = extract_leaves(simplify(pages_nodes)).withColumn("nodes", merge_text_nodes(F.col("nodes")))
    return merged.withColumn("nodes", document_nodes(F.col("nodes"))).withColumn("domain", U.domain(F.col("url")))
