import hashlib
import itertools
import re
import zlib

import pytest

from tessella.llm import conversation_repair as cr

ROLE_RE = re.compile(r"(s?(ua)+)?")


def exhaustive(rows):
    """Every edit sequence of up to two inserts per gap; the cheapest valid one, ASCII-least audit."""
    best = None
    n = len(rows)
    seen, faults = set(), []
    for role, text in rows:
        if not re.search(r"[^\x20\x09-\x0D]", text):
            faults.append("blank")
        elif (role, text) in seen:
            faults.append("duplicate")
        else:
            last = re.findall(r"[^\x20\x09-\x0D]", text)[-1]
            faults.append("truncated" if last not in ".!?" else None)
        seen.add((role, text))
    gaps = [["", "u", "a", "ua", "au"]] * (n + 1)
    for edits in itertools.product(*[["D"] if f in ("blank", "duplicate") else ["K", "R", "D"] for f in faults]):
        for fill in itertools.product(*[["", "I", "II"]] * (n + 1)):
            audit, cost = "", 0
            for i in range(n + 1):
                audit += fill[i]
                cost += 2 * len(fill[i])
                if i < n:
                    audit += edits[i]
                    cost += {"K": 0, "R": 2, "D": 3}[edits[i]] + (edits[i] != "D" and faults[i] == "truncated")
            if best is not None and (cost, audit) >= best[:2]:
                continue
            # Roles: kept rows fixed; inserted and rerole'd rows take whatever the grammar needs next.
            roles, ok = "", True
            at = 0
            for letter in audit:
                if letter == "D":
                    at += 1
                    continue
                nxt = "a" if roles.endswith("u") else "u"
                if letter == "K":
                    r = rows[at][0][:1]
                    at += 1
                    if r not in "sua" or not r:
                        ok = False
                        break
                    roles += r
                else:
                    at += letter == "R"
                    roles += nxt
            if ok and ROLE_RE.fullmatch(roles):
                best = (cost, audit, faults)
    return best


CASES = [
    [("user", "hi."), ("assistant", "yes.")],
    [("system", "s."), ("user", "q"), ("user", "q"), ("assistant", "a.")],
    [("assistant", "a."), ("user", "b.")],
    [("tool", "x."), ("user", " "), ("assistant", "ok")],
    [("system", "s."), ("system", "t.")],
    [("user", "a."), ("assistant", "b."), ("user", "c.")],
    [("assistant", "x"), ("assistant", "y"), ("system", "z.")],
    [("", "q."), (" ", "r.")],
    [],
]


@pytest.mark.parametrize("rows", CASES)
def test_matrices_agree_with_exhaustive_search(rows):
    want = exhaustive(rows)
    seq = []
    for (role, text), fault in zip(rows, want[2], strict=True):
        code = "sua".find(role[:1]) if role[:1] else -1
        code = code if code >= 0 else 3
        seq.append((0 if fault in ("blank", "duplicate") else 1 + 2 * code + (fault == "truncated"), 1))
    mats = cr.rule_matrices([(cr.TERMINALS, seq[0][0], seq[1][0])] if len(seq) > 1 else [])
    assert cr.solve(seq, mats) == want[:2]
    if len(seq) > 1:
        assert cr.solve([(cr.TERMINALS, 1)] + seq[2:], mats) == want[:2]


def test_power_of_deletes():
    m = cr.terminal(0)
    assert cr.power(m, 5)[0] == (15, "DDDDD")
    assert cr.solve([(1 + 2 * 1, 1), (0, 40), (1 + 2 * 2, 1)], cr.rule_matrices([])) == (120, "K" + "D" * 40 + "K")


def brute(rows):
    """The whole query in plain Python."""
    convs = {}
    for conv, turn, role, text in rows:
        convs.setdefault(conv, [])
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        hit = zlib.crc32(key.encode()) % 20
        role, text = role if role is not None else " ", text if text is not None else " "
        if hit == 0:
            continue
        text = "" if hit == 1 else re.sub("[.!?]", "", text) if hit == 2 else text
        role = "user" if hit == 4 else role
        convs[conv] += [(turn, role, text)] * (2 if hit == 3 else 1)
    out = []
    for conv, rs in convs.items():
        rs.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        turns = {t for t, _, _ in rs if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        pairs = [(r, t) for _, r, t in rs]
        if len(pairs) <= 5:
            cost, audit, faults = exhaustive(pairs)
        else:
            continue
        inits = [r[:1] for r, _ in pairs]
        illegal = sum(1 for x, y in zip(inits, inits[1:]) if x + y not in ("su", "ua", "au"))
        text = "\n".join(cr.replay(audit, pairs))
        out.append((conv, gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()))
    return out


def test_query_agrees_with_brute_force(spark):
    texts = ["Hello there.", "fine", "  ", None, "Why?", "ok!", "x" * 20_000 + ".", "same."]
    roles = ["user", "assistant", "system", None, "tool", "user"]
    rows = []
    for c in range(120):
        for t in range(c % 5):
            rows.append((c, t if (c + t) % 11 else None, roles[(c * 3 + t) % 6], texts[(c + 2 * t) % 8]))
    rows += [(500, 1, "user", "same."), (500, 1, "user", "same."), (500, 2, "assistant", "same.")]
    rows += [(None, 0, "user", "null conv."), (None, 1, "assistant", "fine.")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "conv_id long, turn long, role string, text string, audit string")
    got = {r["conv_id"]: tuple(r) for r in cr.repair(df).collect()}
    assert set(got) == {r[0] for r in rows}
    want = brute(rows)
    assert len(want) > 60
    for w in want:
        assert got[w[0]] == w
    for conv, g in got.items():
        if conv not in {w[0] for w in want} and not any(r[0] == conv for r in rows):
            raise AssertionError(conv)


def test_empty_table(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert cr.repair(df).count() == 0
