import random
import re

import numpy as np

import __spark_entry__ as entry
from tessella.llm import license_scan as ls

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def tokens(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(text):
    words = tokens(text)
    places = []
    for phrase, label in ls.PHRASES:
        p = phrase.split()
        places += [(i, label) for i in range(len(words)) if words[i : i + len(p)] == p]
    return (
        len(words),
        len(places),
        min(places)[0] if places else None,
        max(places)[0] if places else None,
        ",".join(sorted({x for _, x in places})),
    )


def test_query_agrees_with_brute_force(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{entry.SMOKE_DIR}/documents.parquet").collect()}
    rows = entry.queries()["op7_license_scan"](spark, entry.SMOKE_DIR).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert tuple(r)[1:6] == brute(texts[r["doc_id"]])
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))
        assert 0 <= r["score"] <= 1


def test_matching_statistics_agree_with_brute_force():
    rng = random.Random(2)
    for _ in range(60):
        lists = [[rng.randrange(3) for _ in range(rng.randrange(1, 12))] for _ in range(rng.randrange(1, 5))]
        automaton = ls.SuffixAutomaton(lists)
        text = [rng.randrange(4) for _ in range(30)]
        for i, (state, length) in enumerate(automaton.statistics(text)):
            run = text[: i + 1]
            longest = max(
                n for n in range(len(run) + 1)
                if any(n == 0 or x[p : p + n] == run[len(run) - n :] for x in lists for p in range(len(x) - n + 1))
            )
            assert length == longest
            if length:
                found = {(k, p + length) for k, x in enumerate(lists) for p in range(len(x) - length + 1) if x[p : p + length] == run[len(run) - length :]}
                assert set(automaton.ends[state]) == found


def test_random_phrases_agree_with_brute_force(spark):
    rng = random.Random(4)
    pool = "cc by by general public license all rights reserved x é the GNU".split()
    rows = [(i, rng.choice([" ", "-", ".\n"]).join(rng.choice(pool) for _ in range(rng.randrange(0, 60)))) for i in range(300)]
    rows += [(500, None), (501, ""), (None, "All Rights  Reserved!"), (502, "cc " * 5000 + "by")]
    df = spark.createDataFrame([(a, b, "x") for a, b in rows], "doc_id long, text string, score string")
    found = {r["doc_id"]: tuple(r)[1:6] for r in ls.scan_licenses(df).collect()}
    assert found == {i: brute(t) for i, t in rows}
    assert ls.scan_licenses(df.limit(0)).count() == 0


def test_template_spans(spark):
    notice = (
        "Intro. Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files. This work is licensed under the GNU General Public License, version 3. the end"
    )
    df = spark.createDataFrame([(1, notice), (2, "the license of the work, version 3"), (3, "Released under the MIT License.")], "doc_id long, text string")
    rows = {r["doc_id"]: r for r in ls.scan_licenses(df).collect()}
    assert rows[1]["labels"] == "gpl,gpl-3.0,mit" and rows[1]["score"] == 1.0
    span = next(s for s in rows[1]["spans"] if s["label"] == "mit")
    assert tokens(notice)[span["start"] : span["end"]] == tokens(ls.TEMPLATES[13][1]) and span["covered"] == 1.0
    assert rows[2]["labels"] == "" and rows[3]["labels"] == "mit"


def test_words_of_a_piece():
    data = np.frombuffer("Ab,c\x7fd éÉ9".encode(), np.uint8)
    hashes, first = ls.word_hashes(data, np.array([0, len(data)]))
    assert first.tolist() == [0, 4] and len(set(hashes.tolist())) == 4
