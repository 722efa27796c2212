import re
from collections import Counter, defaultdict

import pyarrow as pa

from tessella.llm import divergence as dv

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute(rows, min_docs, top=50):
    """Dense tables of every group and kept term, priced and compared term by term."""
    rows = [(t or "", lang or "", src or "") for t, lang, src in rows]
    terms = [TERM.findall(t.translate(str.maketrans(dv.UPPER, dv.LOWER))) for t, _, _ in rows]
    groups = sorted({(lang, src) for _, lang, src in rows})
    df, counts = Counter(), defaultdict(Counter)
    for (t, lang, src), ws in zip(rows, terms, strict=True):
        df.update((lang, w) for w in set(ws))
        counts[lang, src].update(ws)
    out = []
    for lang in sorted({g[0] for g in groups}):
        kept = sorted(w for (lg, w), n in df.items() if lg == lang and n >= min_docs)
        V = len(kept)
        mine = [s for lg, s in groups if lg == lang]
        N = {s: sum(counts[lang, s][w] for w in kept) for s in mine}
        p = {s: {w: 1 + 10**9 * (counts[lang, s][w] + 5) // (N[s] + 5 * V) for w in kept} for s in mine}
        NL = sum(N.values())
        q = {w: 1 + 10**9 * (sum(counts[lang, s][w] for s in mine) + 5) // (NL + 5 * V) for w in kept}
        for s in mine:
            pairs = sorted(((sum(abs(p[s][w] - p[o][w]) for w in kept), o) for o in mine if o != s), key=lambda x: (-x[0], x[1].encode()))
            out += [(lang, s, "pair", o, v, i + 1) for i, (v, o) in enumerate(pairs)]
            over = sorted(((p[s][w] - q[w], w) for w in kept if counts[lang, s][w] > 0 and p[s][w] > q[w]), key=lambda x: (-x[0], x[1].encode()))
            out += [(lang, s, "term", w, v, i + 1) for i, (v, w) in enumerate(over[:top])]
    return sorted(out)


WORDS = ["Alpha", "beta", "gamma", "delta", "épsilon", "zeta", "ETA", "theta", "iota", "kappa", "ßig", "日本"]


def fixture():
    rows = []
    for i in range(240):
        k = (i * 7) % len(WORDS)
        text = " ".join(WORDS[(k + j * (i % 5 + 1)) % len(WORDS)] for j in range(i % 9 + 1)) + f" x{i % 4}.42"
        rows.append((text, ["en", "de", None][i % 3], ["s1", "s2", "s3", None, "hot", "hot", "hot"][i % 7]))
    rows += [(None, "en", "s1"), ("", "en", "empty"), ("12 34 !!", "xx", "digits"), ("only one", "yy", "a"), ("one only", "yy", "b")]
    rows += [("Gamma GAMMA gamma", "en", "s2")] * 3
    rows += [("v" * 50_000, "en", "long")]
    return rows


def test_agrees_with_brute_force(spark):
    rows = fixture()
    df = spark.createDataFrame([(t, lg, s, i, "x") for i, (t, lg, s) in enumerate(rows)], "text string, lang string, source string, doc_id long, item string")
    for min_docs, top in [(5, 50), (30, 3), (1, 2)]:
        got = sorted(tuple(r) for r in dv.divergence_audit(df, min_docs, top).collect())
        assert got == brute(rows, min_docs, top)


def test_empty_table(spark):
    df = spark.createDataFrame([], "text string, lang string, source string")
    assert dv.divergence_audit(df).count() == 0


def test_no_kept_terms_gives_zero_pairs(spark):
    df = spark.createDataFrame([("a b", "en", "x"), ("c", "en", "y"), (None, None, None)], "text string, lang string, source string")
    got = sorted(tuple(r) for r in dv.divergence_audit(df, 5).collect())
    assert got == [("en", "x", "pair", "y", 0, 1), ("en", "y", "pair", "x", 0, 1)]


def test_counts_leave_a_task_summed(monkeypatch):
    """One row per distinct term of a row was exploded before anything was summed."""
    texts = ["b A-a Été", "", "a \x00B\x7fb", "\U0001f600x"] * 50
    batch = pa.RecordBatch.from_pydict({"lang": ["en"] * 200, "source": ["s", "t"] * 100, "text": texts})
    for held in (3, 1 << 18):
        monkeypatch.setattr(dv, "HELD_TERMS", held)
        out = [r for b in dv.count_terms(iter([batch])) for r in b.to_pylist()]
        total = {}
        for r in out:
            c, n = total.get((r["source"], r["term"]), (0, 0))
            total[r["source"], r["term"]] = (c + r["count"], n + r["rows"])
        assert total == {
            ("s", None): (0, 0), ("t", None): (0, 0), ("s", "a"): (150, 100), ("s", "b"): (150, 100),
            ("s", "Été"): (50, 50), ("t", "\U0001f600x"): (50, 50),
        }
    assert len(out) == 6
