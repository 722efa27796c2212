import hashlib
import random
import re

import __spark_entry__ as entry
from tessella.llm import pii


def luhn(d):
    return sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(d))) % 10 == 0


def brute(text):
    """The formats as they are written, by finditer over the whole text."""
    text = text or ""
    digits = lambda s: re.sub("[^0-9]", "", s)
    email = [m.span() for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    ip = [m.span() for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m[0].split("."))]
    card = [m.span() for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 13 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    phone = [m.span() for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(digits(m[0])) <= 15]
    spans = [f"{k}:{a}:{b}" for k, found in zip(pii.BASE, (email, ip, card, phone), strict=True) for a, b in found]
    return (len(email), len(ip), len(card), len(phone), hashlib.sha256(",".join(spans).encode()).hexdigest()), spans


def plain(text):
    order = sorted((k, a, b) for k, a, b, valid in pii.exact(text or "") if valid)
    return [f"{pii.BASE[k]}:{a}:{b}" for k, a, b in order]


def test_random_texts_agree_with_brute_force():
    rng = random.Random(8)
    for _ in range(4000):
        alphabet = rng.choice(["a@.-1", "0123456789 -", "+0123456789().- ", "1.2 256", "é@a.b 1+"])
        text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(0, 60)))
        assert plain(text) == brute(text)[1], text
    assert len(plain("a" * 200_000 + "@" + "1" * 200_000 + " " + "1." * 100_000)) == 25_000


def test_query_agrees_with_brute_force(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    rows = entry.queries()["op4_private_data"](spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == len(texts)
    secrets = added = 0
    for r in rows:
        digest, base = brute(texts[r["doc_id"]])
        assert tuple(r)[1:6] == digest
        spans = [s for s in r["spans"].split(",") if s]
        assert [s for s in spans if s.split(":")[0] in pii.BASE] == base
        text = texts[r["doc_id"]]
        secrets += len(re.findall(r'(?i)token = "[0-9a-f]{40}"', text))
        for s in spans[len(base) :]:
            kind, a, b = s.split(":")
            added += 1
            assert re.search(r"[0-9]", text[int(a) : int(b)])
            assert kind != "secret" or re.search(r'(?i)token = "$', text[: int(a)])
    assert secrets > 10 and added >= 0.9 * secrets


def test_edges(spark):
    rows = [(1, None), (2, ""), (None, "x@y.zz é 1.2.3.4"), (3, "ééé a.b@c.de and 1.2.3.400"), (3, "ééé a.b@c.de")]
    df = spark.createDataFrame([(a, b, "s") for a, b in rows], "doc_id long, text string, spans string")
    found = sorted((r["doc_id"] or 0, [(s["kind"], s["start"], s["end"]) for s in r["spans"]]) for r in pii.find_private(df, pii.train(df)).collect())
    email = ("email", 4, 12)
    assert found == [(0, [("email", 0, 6), ("ip", 9, 16)]), (1, []), (2, []), (3, [email]), (3, [email])]
    assert pii.find_private(df.limit(0), None).count() == 0
    assert pii.redact("ééé a.b@c.de!", [email]) == "ééé <EMAIL>!"


def test_trees_learn_and_thresholds_hold():
    import numpy as np

    rng = np.random.default_rng(0)
    x = rng.random((900, 4))
    y = ((x[:, 1] > 0.5) & (x[:, 2] > 0.3)).astype(int)
    trees = pii.Boosted(x[:600], y[:600])
    assert ((trees.predict(x[600:]) > 0.5) == y[600:]).mean() > 0.95


def iban(rng):
    body = "".join(rng.choice("0123456789") for _ in range(18))
    check = 98 - int(body + "131400") % 97
    return f"DE{check:02d}{body}"


def planted(seed, n):
    """(text, kind, span) with values of all six kinds under their names, and alike values that are none."""
    rng = random.Random(seed)
    d = lambda k: "".join(rng.choice("0123456789") for _ in range(k))
    x = lambda k: "".join(rng.choice("0123456789abcdef") for _ in range(k))
    valid = lambda: f"{rng.randrange(2, 10)}{d(2)}"
    kinds = {
        "secret": lambda: ("token = ", x(20) + "0123"),
        "contact": lambda: ("mail: ", f"{rng.choice(['john', 'ann', 'lee'])} at example{d(1)} dot com"),
        "number": lambda: ("phone: ", rng.choice(["{}.{}.{}", "{}-{}-{}", "({}) {}-{}"]).format(valid(), valid(), d(4))),
        "identity": lambda: ("ssn: ", f"{rng.randrange(100, 600)}-{rng.randrange(10, 99)}-{rng.randrange(1000, 9999)}"),
        "account": lambda: ("iban: ", iban(rng)),
        "address": lambda: ("host ", ":".join(x(4) for _ in range(8))),
    }
    none = [
        lambda: f"number {d(18)}",
        lambda: "we look at this dot here",
        lambda: f"order {valid()}-{valid()}-{d(4)}",
        lambda: f"part {rng.randrange(100, 600)}-{rng.randrange(10, 99)}-{rng.randrange(1000, 9999)}",
        lambda: f"code AB{rng.choice(['03', '41', '77'])} {d(4)} ABCD EFGH IJKL",
        lambda: ":".join(x(2) for _ in range(6)),
    ]
    out = []
    for _ in range(n):
        for kind, make in kinds.items():
            before, value = make()
            out.append((f"Words, {before}{value} and more.", kind, (7 + len(before), 7 + len(before) + len(value))))
        out += [(f"Words, {make()} and more.", None, None) for make in none]
    return out


def test_every_kind_is_found(spark):
    rows = planted(5, 40)
    df = spark.createDataFrame([(i, t) for i, (t, _, _) in enumerate(rows)], "doc_id long, text string")
    found = {r["doc_id"]: [(s["kind"], (s["start"], s["end"])) for s in r["spans"]] for r in pii.find_private(df, pii.train(df)).collect()}
    # An exact span (a valid card number) may take the place of another one.
    free = [i for i in range(len(rows)) if not any(k in pii.BASE for k, _ in found[i])]
    for kind in [k for k, _ in pii.GENERATORS]:
        own = [i for i in free if rows[i][1] == kind]
        assert len(own) > 20 and all(found[i] == [rows[i][1:]] for i in own), kind
    assert sum(bool(found[i]) for i in free if rows[i][1] is None) <= 2


def test_rare_kinds_have_thresholds_from_all_documents(spark, monkeypatch):
    """Thirty account numbers in 12,000 documents of other candidates, and few candidates to train on."""
    monkeypatch.setattr(pii, "TRAIN_CANDIDATES", 100)
    rng = random.Random(6)
    texts = [f"Words, order number {rng.randrange(10**17, 10**18)} and more." for _ in range(12_000)]
    for i in range(0, 12_000, 400):
        texts[i] = f"Words, iban: {iban(rng)} and more."
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: {s["kind"] for s in r["spans"]} for r in pii.find_private(df, pii.train(df)).collect()}
    rare = [i for i in range(0, 12_000, 400) if not found[i] & set(pii.BASE)]
    assert len(rare) > 20 and all(found[i] == {"account"} for i in rare)
    assert sum("account" in found[i] for i in range(12_000)) == len(rare)


def test_thresholds_weigh_the_labels_by_their_counts():
    import numpy as np

    k = pii.KINDS.index("account")
    selector = pii.Selector(np.zeros((10, 20)), np.arange(10) % 2)
    # Half of the private ones are unseen and nearly all of the others: 100 + 100 of 204 in truth.
    selector.set_thresholds([(k, 80, 1, 50), (k, 60, 1, 50), (k, 60, 0, 2), (k, 20, 0, 900)], {(k, 1): 200, (k, 0): 910})
    assert selector.thresholds == {k: 40}
    selector.set_thresholds([(k, 80, 1, 2)], {(k, 1): 6})
    assert selector.thresholds == {k: 40}
