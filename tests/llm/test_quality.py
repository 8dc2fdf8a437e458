"""Line and document rules against a plain loop over lines."""

import re
from collections import Counter

from cellstride.llm import quality

SCHEMA = "doc_id bigint, text string, kept string, N_words int, clean_text string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed)


def rule(line, seen):
    words = WORD.findall(line)
    chars, n = sum(map(len, words)), len(words)
    sentence = re.search(quality.SENTENCE_MARKS, line)
    separators = len(re.findall(quality.SEPARATORS, line))
    if n >= 4 and 100 * len(re.findall(quality.ODD_MARKS, line)) > 15 * chars or n >= 30 and not sentence:
        return "punctuation"
    if separators >= 2 and 4 * separators >= n or n <= 8 and not sentence and re.search(quality.MENU, line):
        return "navigation"
    if line in seen or n <= 30 and re.search(quality.NOTICE.replace(r"\P{L}", r"[\W\d_]"), line):
        return "boilerplate"
    return None


def whole(text):
    text = text or ""
    seen, good, failures, lost = set(), [], Counter(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            why = rule(line, seen)
            seen.add(line)
            if why:
                failures[why] += 1
                lost += sum(map(len, WORD.findall(line)))
            else:
                good.append(line)
    return good, failures, lost


PROSE = "\n".join(" ".join([w.title(), *(f"{w}{k}" for k in range(8))]) + ", and no more." for w in (
    "river", "mill", "road", "hill", "pond", "barn", "gate", "wood"))
TEXTS = [
    None, "", " \n\t\n", "Of.", PROSE, PROSE + "\n" + PROSE, PROSE.replace("\n", "\r\n"),
    PROSE + "\nHome | News | Sport | Contact\nAll rights reserved.\nHome page\n© 2020 Somebody\nuncopyrighted, this line stays.",
    "\n".join(w.upper() + "!! " + "x!! y!! z!!" for w in PROSE.split()), "a b c " * 40, "a b c a b c d a b",
    " ".join(f"w{i}" for i in range(80)), " ".join(f"w{i}" for i in range(80)) + " " + " ".join(f"w{i}" for i in range(30)),
    "x y", "a a a a", "a a a", "﻿Second word third 𝒳𝒴 #tag &amp; $5 <b>|", "Login\n" * 60,
    " ".join(f"lang{i}" for i in range(20_000)) + ".", "a | b | c |\n" * 20 + PROSE,
]


def test_assess(spark):
    df = spark.createDataFrame([(i, t, "no", 7, "old") for i, t in enumerate(TEXTS)] * 2, SCHEMA).repartition(3)
    rows = quality.assess(df).collect()
    assert len(rows) == 2 * len(TEXTS)
    for r in rows:
        text = TEXTS[r.doc_id]
        found = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        assert found == base(text), r.doc_id
        good, failures, lost = whole(text)
        assert {k: v for k, v in r.failures.items() if v} == dict(failures), r.doc_id
        assert (r.clean_text, r.lost_chars, r.n_failed_lines) == ("\n".join(good), lost, sum(failures.values())), r.doc_id
        assert r.kept == (not r.base_failed and 100 * lost <= 40 * r.word_chars), r.doc_id
    assert {r.doc_id for r in rows if r.kept} >= {4, 6, 7, 18}


def test_clean(spark):
    df = spark.createDataFrame([(7, TEXTS[7], "a", 1, "b"), (8, TEXTS[8], "a", 1, "b"), (0, None, None, None, None)], SCHEMA)
    [row] = quality.clean(df).collect()
    assert row.doc_id == 7 and row.clean_text == "b" and row.kept == "a"
    assert row.text == PROSE + "\nuncopyrighted, this line stays."
    assert quality.assess(spark.createDataFrame([], SCHEMA)).collect() == []


def test_nothing_is_shuffled_and_no_python(spark, small):
    plan = quality.query(spark, small)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan


def test_labelled_documents(spark):
    """Documents labelled good that pass the base rules are kept, those labelled bad are not."""
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = quality.query(spark, sf).join(labels, "doc_id").where("not base_failed").collect()
    good, bad = [r.kept for r in rows if r.quality == 1], [r.kept for r in rows if r.quality == 0]
    assert sum(good) >= 0.99 * len(good) and sum(bad) <= 0.1 * len(bad) and len(bad) > 10
