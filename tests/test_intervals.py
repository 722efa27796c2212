"""Interval functions of page trees against plain definitions, and linear work on large pages."""

import time

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tessella.functions import intervals as IV
from tessella.operators import html as H
from tessella.sources.dom import build_dom_nodes


def random_pages(rng, pages=6):
    nos, ends, parents, offsets = [], [], [], [0]
    for p in range(pages):
        n = int(rng.integers(0, 40))
        parent = [-1] + [int(rng.integers(0, i)) for i in range(1, n)]
        # Pre-order: number children after their parents depth first.
        children = {i: [] for i in range(n)}
        for i in range(1, n):
            children[parent[i]].append(i)
        order, stack = [], [0] if n else []
        while stack:
            x = stack.pop()
            order.append(x)
            stack.extend(reversed(children[x]))
        number = {x: k for k, x in enumerate(order)}
        end = {}
        for x in reversed(order):
            end[x] = max([number[x]] + [end[c] for c in children[x]])
        for x in order:
            nos.append(number[x])
            ends.append(end[x])
            parents.append(number[parent[x]] if parent[x] >= 0 else -1)
        offsets.append(offsets[-1] + n)
    return np.array(nos), np.array(ends), np.array(parents), np.array(offsets)


def test_kernels_match_definitions():
    rng = np.random.default_rng(5)
    for _ in range(30):
        no, end, parent, offsets = random_pages(rng)
        flag = rng.random(len(no)) < 0.3
        page = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
        idx = np.arange(len(no))
        same = page[:, None] == page[None, :]
        inside = same & (no[None, :] < no[:, None]) & (no[:, None] <= end[None, :])  # [y, x]: y inside x
        assert (IV.strictly_inside_np(no, end, flag, offsets) == (inside & flag[None, :]).any(axis=1)).all()
        within = same & (no[:, None] <= no[None, :]) & (no[None, :] <= end[:, None])  # [x, y]: y in [x.no, x.end]
        assert (IV.has_inside_np(no, end, flag, offsets) == (within & flag[None, :]).any(axis=1)).all()
        first = IV.first_inside_np(no, end, flag, offsets)
        for x in idx:
            hits = [y for y in idx if inside[y, x] and flag[y]]
            assert first[x] == (hits[0] - offsets[page[x]] if hits else -1)
        is_parent = same & (parent[:, None] == no[None, :])  # [x, y]: y is x's parent
        assert (IV.parent_in_np(parent, no, flag, offsets) == (is_parent & flag[None, :]).any(axis=1)).all()
        assert (IV.child_count_np(parent, no, flag, offsets) == (is_parent & flag[:, None]).sum(axis=0)).all()


def test_node_ends_are_subtree_ends():
    from tessella.sources.dom import parse_nodes

    rows = parse_nodes("<div><p>a<b>b</b></p><ul><li>x<li>y</ul></div>c")
    for r in rows:
        below = [s["pos"] for s in rows if r["pos"] in [e["no"] for e in s["path"]]]
        assert r["end"] == max(below)


def _page(n):
    # Unclosed paragraphs in dropped, kept and dated divs: many roots, deep and wide.
    parts = []
    for i in range(n // 8):
        kind = ("footer", "date", "x")[i % 3]
        parts.append(f'<div class="{kind}"><p>t{i}<span> s</span><div><div>u</div></div><video><source src="v{i}.mp4"></video></div>')
    return "<html><body>" + "".join(parts) + "</body></html>"


def test_work_grows_linearly(spark):
    def seconds(n):
        pages = spark.createDataFrame([(1, "https://h.org/d", _page(n))], "doc_id long, url string, html string")
        nodes = build_dom_nodes(pages).cache()
        count = nodes.select(F.size("nodes")).first()[0]
        best = None
        for _ in range(2):
            started = time.time()
            H.simplify(nodes).select(F.size("nodes")).collect()
            took = time.time() - started
            best = took if best is None else min(best, took)
        nodes.unpersist()
        return count, best

    small, t_small = seconds(8_000)
    large, t_large = seconds(32_000)
    assert large >= 3.9 * small
    assert t_large <= 4.5 * max(t_small, 0.5)


def test_captions_of_nested_figures(spark):
    html = (
        '<figure><p><img src="a.png" alt="A"></p><figcaption> </figcaption><figcaption>outer</figcaption>'
        '<figure><img src="b.png"><figcaption>inner</figcaption></figure></figure>'
        '<img src="c.png" title="T"><div><img src="d.png"><figcaption>div cap</figcaption></div>'
    )
    pages = spark.createDataFrame([(1, "https://h.org/d", html)], "doc_id long, url string, html string")
    leaves = H.extract_leaves(build_dom_nodes(pages)).first()["nodes"]
    got = {n["src"]: n["caption"] for n in leaves if n["kind"] == "image"}
    assert got == {
        "https://h.org/a.png": "outer",
        "https://h.org/b.png": "outer",
        "https://h.org/c.png": "T",
        "https://h.org/d.png": "div cap",
    }


def test_a_batch_is_worked_through_in_pieces(monkeypatch):
    """The kernels' working arrays were as large as a batch of pages."""
    pages = [[0, 1, 2], None, [], [0, 1], [0, 1, 2, 3]] * 20
    ends = [p and [p[-1]] + p[1:] for p in pages]
    flags = [p and [True] + [False] * (len(p) - 1) for p in pages]
    args = [pa.array(x, pa.list_(k)) for x, k in ((pages, pa.int64()), (ends, pa.int64()), (flags, pa.bool_()))]
    sizes = []

    def kernel(no, end, flag, offsets):
        sizes.append(len(no))
        return IV.strictly_inside_np(no, end, flag, offsets)

    run = IV._unary(kernel, pa.bool_())
    whole = run(*args)
    monkeypatch.setattr(IV, "PIECE", 8)
    assert run(*args).to_pylist() == whole.to_pylist() == [p and [i > 0 for i in range(len(p))] for p in pages]
    assert max(sizes[1:]) <= 8 < sizes[0]
