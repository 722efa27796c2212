"""Conversation structure repair by a grammar-compressed dynamic programme.

Damage (fixed by the contract): each row of `conversations` (null conv_id, turn, role and text
read as one space) is hit by crc32('conv_id:turn') % 20: 0 drops it, 1 empties its text, 2 removes
its '.', '!' and '?', 3 repeats it (same turn, adjacent), 4 sets its role to 'user'.

Faults, on the damaged rows of a conversation in order (turn, nulls first; ties by role, then text,
in UTF-8 byte order): a row's first fault is *blank* (no character outside blank, tab and line
breaks), else *duplicate* (the same role and text stand earlier in the conversation), else
*truncated* (its last such character is not '.', '!' or '?').

Repair: the roles must read (s?(ua)+)? by initials (s system, u user, a assistant; the initial is
a role's first character, so 'tool', ' ' or '' fit nowhere). Edits: keep (0), rerole to user or
assistant (2), delete (3; the only edit for a blank or duplicate row), insert an empty user or
assistant row anywhere (2); a truncated row that is not deleted adds 1. The audit is the cheapest
edit sequence by initials (K, R, D, I), the ASCII-least among equally cheap ones.

The method. A four-state automaton reads the roles; every kind of row is a symbol with one 4 x 4
min-plus transfer matrix whose entries carry (cost, audit). Row kinds are few (delete-only, and
role initial x truncated), so the symbol sequences of all conversations are compressed together by
Re-Pair: the most frequent adjacent pairs across all conversations become rules, round by round, in
Spark (pairs counted by a shuffle, rules applied in the tasks). Each rule gets one matrix, the
product of its children's, evaluated bottom-up once and shared by every conversation that uses
it; its audit rope is the concatenation of the children's. A conversation is then the product of
its top-level symbols. Ties stay exact: all audits of one matrix entry cover the same rows, so one
cannot be a proper prefix of another of equal cost, and (cost, audit) order survives concatenation
on either side. Identical rows are collapsed before the shuffle into one row with a count; a run
of delete-only copies is a matrix power.

Rows and names: columns besides conv_id, turn, role and text are not read. Every conv_id of the
input gets one row (null is one conversation); one without rows after damage has zero counts,
cost 0, an empty audit and the SHA-256 of the empty string. repaired_sha256 hashes the repaired
rows as 'role:text', joined by line feeds; inserted rows have empty text, rerole'd rows keep their
text. A conversation's rows are evaluated in one task (the hash is sequential), after identical
rows are collapsed; the audit string of a conversation is built by concatenation, quadratic in its
number of distinct rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.llm.components import cut

#: Fixed values of the contract: damage classes, edit costs, the role grammar's initials.
DROP, EMPTY, UNPUNCT, REPEAT, USER = 0, 1, 2, 3, 4
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
LEGAL_PAIRS = ("su", "ua", "au")

#: Re-Pair rounds and pairs made rules in each; a pair must occur this often.
ROUNDS, PAIRS_PER_ROUND, MIN_PAIRS = 4, 32, 2

# Symbols: 0 is a delete-only row; 1 + 2 * initial + truncated for the others.
INITIALS = "suax"
TERMINALS = 1 + 2 * len(INITIALS)
INF = None
#: States: 0 start, 1 after system, 2 after user, 3 after assistant; 0 and 3 accept.
ACCEPT = (0, 3)
_USER_FROM, _ASSISTANT_FROM = (0, 1, 3), (2,)


def _better(x, y):
    """The smaller of two (cost, audit) entries; None is infinite."""
    if x is None:
        return y
    if y is None:
        return x
    return x if (x[0], x[1]) <= (y[0], y[1]) else y


def mul(a: list, b: list) -> list:
    """Min-plus product of 4 x 4 matrices of (cost, audit) entries."""
    out = [None] * 16
    for i in range(4):
        for k in range(4):
            x = a[i * 4 + k]
            if x is None:
                continue
            for j in range(4):
                y = b[k * 4 + j]
                if y is not None:
                    out[i * 4 + j] = _better(out[i * 4 + j], (x[0] + y[0], x[1] + y[1]))
    return out


def vec_mul(v: list, m: list) -> list:
    out = [None] * 4
    for k in range(4):
        if v[k] is None:
            continue
        for j in range(4):
            y = m[k * 4 + j]
            if y is not None:
                out[j] = _better(out[j], (v[k][0] + y[0], v[k][1] + y[1]))
    return out


def power(m: list, n: int) -> list:
    result = [(0, "") if i % 5 == 0 else None for i in range(16)]
    while n:
        if n & 1:
            result = mul(result, m)
        n >>= 1
        if n:
            m = mul(m, m)
    return result


def _inserts() -> list:
    """Closure of empty inserted rows: an insert reads u from 0, 1, 3 and a from 2."""
    t = [(0, "") if i % 5 == 0 else None for i in range(16)]
    step = [None] * 16
    for q in _USER_FROM:
        step[q * 4 + 2] = (INSERT, "I")
    step[2 * 4 + 3] = (INSERT, "I")
    for _ in range(4):
        t = [_better(a, b) for a, b in zip(t, mul(t, step), strict=True)]
    return t


INSERTS = _inserts()


def terminal(symbol: int) -> list:
    """The row's own edits, then any inserts."""
    m = [None] * 16
    for q in range(4):
        m[q * 4 + q] = (DELETE, "D")
    if symbol:
        initial, truncated = INITIALS[(symbol - 1) // 2], (symbol - 1) % 2
        extra = TRUNCATED * truncated
        for q in _USER_FROM:
            m[q * 4 + 2] = _better(m[q * 4 + 2], (REROLE + extra, "R"))
        m[2 * 4 + 3] = _better(m[2 * 4 + 3], (REROLE + extra, "R"))
        if initial == "s":
            m[0 * 4 + 1] = (KEEP + extra, "K")
        elif initial == "u":
            for q in _USER_FROM:
                m[q * 4 + 2] = _better(m[q * 4 + 2], (KEEP + extra, "K"))
        elif initial == "a":
            m[2 * 4 + 3] = _better(m[2 * 4 + 3], (KEEP + extra, "K"))
    return mul(m, INSERTS)


def rule_matrices(rules: list[tuple[int, int, int]]) -> dict[int, list]:
    """Matrices of terminals and of rules (id, left, right), bottom-up in the order made."""
    mats = {s: terminal(s) for s in range(TERMINALS)}
    for rid, left, right in rules:
        mats[rid] = mul(mats[left], mats[right])
    return mats


def solve(seq: list[tuple[int, int]], mats: dict[int, list]) -> tuple[int, str]:
    """Cheapest (cost, audit) of a sequence of (symbol, repeats) from the start to an accepting state."""
    v = INSERTS[0:4]
    for symbol, reps in seq:
        v = vec_mul(v, mats[symbol] if reps == 1 else power(mats[symbol], reps))
    return min((v[q] for q in ACCEPT if v[q] is not None), key=lambda e: (e[0], e[1]))


def replay(audit: str, rows: list[tuple[str, str]]) -> list[str]:
    """The repaired 'role:text' lines: audit letters against the damaged rows in order."""
    out, q, at = [], 0, 0
    for letter in audit:
        if letter == "D":
            at += 1
            continue
        if letter == "K":
            role, text = rows[at]
            at += 1
        else:
            role = "user" if q in _USER_FROM else "assistant"
            text = rows[at][1] if letter == "R" else ""
            at += letter == "R"
        out.append(f"{role}:{text}")
        q = {"s": 1, "u": 2, "a": 3}[role[:1]] if letter == "K" else (2 if role == "user" else 3)
    return out


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows after damage, with their order key and fault flags' inputs."""
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
    )
    key = F.concat(
        F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" "))
    )
    hit = F.crc32(key) % 20
    return (
        rows.withColumn("hit", hit)
        .where(F.col("hit") != DROP)
        .withColumn("text", F.when(F.col("hit") == EMPTY, F.lit("")).when(F.col("hit") == UNPUNCT, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")))
        .withColumn("role", F.when(F.col("hit") == USER, F.lit("user")).otherwise(F.col("role")))
        .withColumn("copies", F.when(F.col("hit") == REPEAT, F.lit(2)).otherwise(F.lit(1)))
    )


def runs(rows: DataFrame) -> DataFrame:
    """Identical damaged rows collapsed, with their faults and symbol."""
    same = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("m"))
    # A join key that is never null: a null conv_id is a conversation of its own.
    same = same.withColumn("ck", F.coalesce(F.col("conv_id").cast("string"), F.lit("null")))
    order = F.struct(F.col("turn").isNotNull().alias("has_turn"), "turn", "role", "text")
    first = same.groupBy("ck", "role", "text").agg(F.min(order).alias("first"))
    blank = ~F.col("text").rlike("[^\\x20\\x09-\\x0D]")
    last = F.regexp_extract("text", "([^\\x20\\x09-\\x0D])[\\x20\\x09-\\x0D]*$", 1)
    truncated = ~last.isin(".", "!", "?")
    initial = F.substring("role", 1, 1)
    found = F.array_position(F.array(*[F.lit(c) for c in INITIALS[:3]]), initial)
    role_code = F.when(found > 0, found).otherwise(F.lit(len(INITIALS))) - 1
    return (
        same.join(first, ["ck", "role", "text"])
        .withColumn("order", order)
        .withColumn("is_first", F.col("order") == F.col("first"))
        .withColumn("blank", blank)
        .withColumn("truncated", ~blank & truncated)
        .withColumn(
            "symbol",
            F.when(F.col("blank") | ~F.col("is_first"), F.lit(0)).otherwise(1 + 2 * role_code + F.col("truncated").cast("int")),
        )
        .withColumn("initial", initial)
    )


def _pairs(seqs: DataFrame) -> DataFrame:
    pair = F.expr(
        "CASE WHEN size(syms) >= 2 THEN filter(transform(sequence(1, size(syms) - 1), "
        "i -> named_struct('a', syms[i - 1], 'b', syms[i], 'ok', reps[i - 1] = 1 AND reps[i] = 1)), x -> x.ok) "
        "ELSE array() END"
    )
    return seqs.select(F.explode(pair).alias("p")).groupBy(F.col("p.a").alias("a"), F.col("p.b").alias("b")).count()


def _replace(batches: Iterator[pa.RecordBatch], held) -> Iterator[pa.RecordBatch]:
    table = held.value
    for batch in batches:
        syms_out, reps_out = [], []
        for syms, reps in zip(batch.column("syms").to_pylist(), batch.column("reps").to_pylist(), strict=True):
            s, r, i = [], [], 0
            while i < len(syms):
                if i + 1 < len(syms) and reps[i] == 1 and reps[i + 1] == 1 and (syms[i], syms[i + 1]) in table:
                    s.append(table[syms[i], syms[i + 1]])
                    r.append(1)
                    i += 2
                else:
                    s.append(syms[i])
                    r.append(reps[i])
                    i += 1
            syms_out.append(s)
            reps_out.append(r)
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv_id"), pa.array(syms_out, pa.list_(pa.int32())), pa.array(reps_out, pa.list_(pa.int64()))],
            names=["conv_id", "syms", "reps"],
        )


def re_pair(seqs: DataFrame, rounds: int = ROUNDS, per_round: int = PAIRS_PER_ROUND) -> tuple[DataFrame, list]:
    """Sequences rewritten by rules of frequent adjacent pairs over all conversations, and the rules."""
    rules: list[tuple[int, int, int]] = []
    next_id = TERMINALS
    spark = seqs.sparkSession
    for _ in range(rounds):
        top = (
            _pairs(seqs).where(F.col("count") >= MIN_PAIRS)
            .orderBy(F.col("count").desc(), "a", "b").limit(per_round).collect()
        )
        if not top:
            break
        table, used = {}, set()
        for row in top:
            # Pairs of one round share no symbol, so that replacing them left to right is unambiguous.
            if row["a"] in used or row["b"] in used:
                continue
            used |= {row["a"], row["b"]}
            table[row["a"], row["b"]] = next_id
            rules.append((next_id, row["a"], row["b"]))
            next_id += 1
        held = spark.sparkContext.broadcast(table)
        seqs = cut(seqs.mapInArrow(lambda b, h=held: _replace(b, h), "conv_id long, syms array<int>, reps array<long>"))
    return seqs, rules


def _evaluate(batches: Iterator[pa.RecordBatch], held) -> Iterator[pa.RecordBatch]:
    mats = held.value
    for batch in batches:
        out = {k: [] for k in ("conv_id", "illegal", "cost", "audit", "repaired_sha256")}
        for conv, syms, reps, rows in zip(
            batch.column("conv_id").to_pylist(), batch.column("syms").to_pylist(),
            batch.column("reps").to_pylist(), batch.column("rows").to_pylist(), strict=True,
        ):
            cost, audit = solve(list(zip(syms or [], reps or [], strict=True)), mats)
            flat, initials = [], []
            for r in rows or []:
                flat += [(r["role"], r["text"])] * r["m"]
                initials += [r["initial"]] * r["m"]
            illegal = sum(1 for x, y in zip(initials, initials[1:]) if x + y not in LEGAL_PAIRS)
            text = "\n".join(replay(audit, flat))
            for k, v in zip(out, (conv, illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()), strict=True):
                out[k].append(v)
        yield pa.RecordBatch.from_arrays(
            [pa.array(out["conv_id"], pa.int64()), pa.array(out["illegal"], pa.int64()), pa.array(out["cost"], pa.int64()),
             pa.array(out["audit"], pa.string()), pa.array(out["repaired_sha256"], pa.string())],
            names=list(out),
        )


def repair(conversations: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost (longs), audit, repaired_sha256."""
    spark = conversations.sparkSession
    rows = damaged(conversations)
    r = cut(runs(rows))
    counts = r.groupBy("conv_id").agg(
        F.sum(F.when(F.col("blank"), F.col("m")).otherwise(0)).alias("blank"),
        F.sum(F.when(F.col("blank"), 0).otherwise(F.col("m") - F.col("is_first").cast("long"))).alias("duplicate"),
        F.sum(F.when(F.col("is_first") & F.col("truncated"), 1).otherwise(0)).alias("truncated"),
    )
    gaps = rows.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn"), F.lit(0)).alias("gaps")
    )
    item = F.struct("order", "role", "text", F.col("m").cast("int").alias("m"), "initial", "symbol")
    convs = r.groupBy("conv_id").agg(F.sort_array(F.collect_list(item)).alias("rows"))
    pieces = F.flatten(
        F.transform(
            "rows",
            lambda x: F.when(
                x["m"] > 1, F.array(F.struct(x["symbol"].alias("s"), F.lit(1).cast("long").alias("r")), F.struct(F.lit(0).alias("s"), (x["m"] - 1).cast("long").alias("r")))
            ).otherwise(F.array(F.struct(x["symbol"].alias("s"), F.lit(1).cast("long").alias("r")))),
        )
    )
    convs = cut(convs.withColumn("p", pieces))
    seqs, rules = re_pair(convs.select("conv_id", F.col("p.s").cast("array<int>").alias("syms"), F.col("p.r").alias("reps")))
    held = spark.sparkContext.broadcast(rule_matrices(rules))
    seqs = seqs.withColumnRenamed("conv_id", "k")
    solved = convs.select("conv_id", "rows").join(seqs, F.col("conv_id").eqNullSafe(F.col("k"))).select("conv_id", "syms", "reps", "rows")
    solved = solved.mapInArrow(lambda b: _evaluate(b, held), "conv_id long, illegal long, cost long, audit string, repaired_sha256 string")
    ids = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    empty = hashlib.sha256(b"").hexdigest()
    out = ids
    for part in (gaps, counts, solved):
        part = part.withColumnRenamed("conv_id", "k")
        out = out.join(part, F.col("conv_id").eqNullSafe(F.col("k")), "left").drop("k")
    zero = F.lit(0).cast("long")
    return out.select(
        "conv_id",
        *[F.coalesce(F.col(c).cast("long"), zero).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(empty)).alias("repaired_sha256"),
    )
