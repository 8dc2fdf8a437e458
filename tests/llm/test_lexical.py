"""Ranked search against a plain loop over items and documents."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from cellstride.llm import lexical

DOCS = "doc_id bigint, text string, rank string, score int, item string"
ITEMS = "item_id bigint, text string, doc_id int"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(ASCII))


def brute(docs, items, k=20):
    cut = [(i, terms(t)) for i, t in docs]
    n_docs, total = sum(bool(t) for _, t in cut), sum(len(t) for _, t in cut)
    df = Counter(x for _, t in cut for x in set(t))
    out = []
    for item, text in items:
        scored = []
        for doc, found in cut:
            tf, score = Counter(found), 0
            for x in terms(text):
                if x in tf:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[x] + 1)))
                    m = 75 + 25 * len(found) * n_docs // total
                    score += w * (10 ** 9 * tf[x] // (1000 * tf[x] + 12 * m))
            if score > 0:
                scored.append((-score, doc is None, doc or 0))
        out += [(item, rank, None if none else doc, -s) for rank, (s, none, doc) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


def table(spark, docs, items):
    return (spark.createDataFrame([(i, t, "x", 1, "y") for i, t in docs], DOCS).repartition(4),
            spark.createDataFrame([(i, t, 3) for i, t in items], ITEMS))


def skewed(n=400, vocabulary=300, seed=5):
    rng = np.random.default_rng(seed)
    word = lambda: f"W{int(vocabulary * rng.random() ** 3)}"
    docs = [(i, " ".join(word() for _ in range(int(rng.integers(1, 60))))) for i in range(n)]
    docs += [(i + n, docs[7][1]) for i in range(60)]  # copies: ties by id
    items = [(i, " ".join(word() for _ in range(int(rng.integers(1, 25))))) for i in range(25)]
    return docs, items


AWKWARD = ([(1, None), (2, ""), (3, "… !"), (4, "Éa éa EA ea"), (5, "it's x_1 x-1 x1"), (6, "X1 x1 x1"), (None, "ea x1"), (7, "ea x1"),
            (7, "ea x1"), (None, None), (8, "K k K"), (9, "long " * 30_000 + "x1")],
           [(1, "EA ÉA"), (1, "x1 x1 ea"), (None, "it s"), (2, None), (3, ""), (4, "nowhere"), (5, "K"), (6, "long x1 ea it s k")])


@pytest.mark.parametrize("case", ["skewed", "awkward"])
@pytest.mark.parametrize("sizes", [(1 << 15, 1 << 20, 1 << 20, 1 << 20), (7, 40, 3, 64)])
def test_search(spark, monkeypatch, case, sizes):
    """Small groups, masks of several words, and blocks of items change nothing."""
    docs, items = skewed() if case == "skewed" else AWKWARD
    for name, value in zip(("GROUP_DOCS", "GROUP_POSTINGS", "GROUP_WORDS", "PIECE"), sizes):
        monkeypatch.setattr(lexical, name, value)
    got = lexical.rank_documents(*table(spark, docs, items), item_bytes=1 << 20 if sizes[0] > 7 else 500).collect()
    assert sorted([(r.item_id, r["rank"], r.doc_id, r.score) for r in got], key=repr) == brute(docs, items)


def test_long_items(spark):
    """More than 64 different terms: a mask has several words."""
    docs, _ = skewed(200)
    items = [(1, " ".join(f"w{i}" for i in range(250))), (2, " ".join(f"w{i}" for i in range(0, 250, 2)) * 3)]
    got = lexical.rank_documents(*table(spark, docs, items), k=5).collect()
    assert sorted([(r.item_id, r["rank"], r.doc_id, r.score) for r in got], key=repr) == brute(docs, items, 5)


def test_masks_save_work():
    """Documents that hold only frequent terms are not scored."""
    rng = np.random.default_rng(1)
    n = 5000
    ids = [np.unique(np.concatenate([[0], np.flatnonzero(rng.random(9) < 0.02) + 1])) for _ in range(n)]
    lengths = np.array([len(x) for x in ids])
    flat = np.concatenate(ids)
    group = lexical.Group.build(np.full(n, 50), lengths, flat, np.ones(len(flat), np.int64), 10, n, 50 * n)
    weights = np.array([1] + [5000] * 9)
    docs, scores, scored = group.search((np.arange(10), np.ones(10, np.int64)), weights, np.arange(n), 20, np.zeros(10, np.int64))
    exact = np.add.reduceat(weights[flat] * group.factor, group.start[:-1])
    order = np.lexsort((np.arange(n), -exact))[:20]
    assert docs.tolist() == order.tolist() and scores.tolist() == exact[order].tolist()
    assert scored < n / 20


def test_empty_tables(spark):
    docs, items = table(spark, [(1, "a b")], [(1, "a")])
    none_d, none_i = docs.where("false"), items.where("false")
    assert lexical.rank_documents(docs, none_i).collect() == []
    assert lexical.rank_documents(none_d, items).collect() == []
    assert lexical.rank_documents(none_d, none_i).collect() == []
    assert [(r.item_id, r["rank"], r.doc_id) for r in lexical.rank_documents(docs, items).collect()] == [(1, 1, 1)]
