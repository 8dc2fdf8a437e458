"""Exact and near duplicates against brute force, and on awkward rows."""

import hashlib
import re

import numpy as np
import pytest
import xxhash

from cellstride.llm import components, exactdedup, simhash

SCHEMA = "doc_id bigint, text string, mark string, fp string, recipe int"


def words(seed, n):
    rng = np.random.default_rng(seed)
    return [f"w{x}" for x in rng.integers(0, 4000, n)]


def near_texts():
    """Groups of long texts with one or two words changed, copies, blanks and odd ones out."""
    texts = []
    for g in range(12):
        base = words(g, 400 + 40 * g)
        texts.append(" ".join(base))
        for k in range(5):
            edited = list(base)
            for j in range(k // 2 + 1):
                edited[(37 * k + 91 * j) % len(edited)] = f"x{k}{j}"
            texts.append(("\t" if k % 2 else " ").join(edited).upper() if k == 3 else " ".join(edited))
    return texts + [texts[0]] * 40 + ["", None, "  \n", "one", "One", "one two", "a b c", "é è ê ë", "\x00 \x1f x"]


def slow_fingerprint(text, width=3):
    ws = [w for w in re.split(r"[\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")) if w]
    if not ws:
        return 0
    grams = [" ".join(ws[i:i + width]) for i in range(len(ws) - width + 1)] or [" ".join(ws)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(ids, fps):
    parent = list(range(len(ids)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(len(ids)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= 3:
                parent[find(i)] = find(j)
    least = {}
    for i, d in enumerate(ids):
        least[find(i)] = min(least.get(find(i), d), d)
    return {d: least[find(i)] for i, d in enumerate(ids)}


def test_fingerprints():
    for text in near_texts():
        for width in (1, 3, 5):
            assert simhash.fingerprint(text, width) == slow_fingerprint(text, width)


def test_fingerprint_blocks(monkeypatch):
    text = " ".join(words(3, 5000))
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "BLOCK", 17)
    assert simhash.fingerprint(text) == whole


def test_near_duplicates(spark):
    texts = near_texts()
    df = spark.createDataFrame([(i, t, "m", "f", 1) for i, t in enumerate(texts)], SCHEMA).repartition(3, "doc_id")
    got = simhash.near_duplicates(df, group_entries=5000).collect()
    fps = [slow_fingerprint(t) for t in texts]
    expected = brute_components(list(range(len(texts))), fps)
    assert {r.doc_id: r.component_id for r in got} == expected
    assert len(set(expected.values())) < len(texts) - 40
    assert {r.doc_id: r.fp % (1 << 64) for r in got} == dict(enumerate(fps))
    assert sorted(r.doc_id for r in got if r.kept) == sorted(set(expected.values()))


@pytest.mark.parametrize("bits", [1, 4, 9])
def test_links_of_all_groups(bits):
    """Chains of fingerprints one to three bits apart stay connected, whatever the number of groups."""
    rng = np.random.default_rng(bits)
    fps = []
    for x in rng.integers(0, 1 << 64, 30, dtype=np.uint64):
        for _ in range(4):
            fps.append(int(x))
            for b in rng.choice(64, rng.integers(1, 5), replace=False):
                x ^= np.uint64(1) << np.uint64(b)
    fps = sorted(set(fps))
    links = np.concatenate([simhash._links_of_group(np.array(fps, np.uint64), g, bits) for g in range(1 << bits)])
    assert all(bin(int(a) ^ int(b)).count("1") <= 3 for a, b in links)
    parent = {x: x for x in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in links:
        parent[find(int(a))] = find(int(b))
    expected = brute_components(fps, fps)
    groups = {}
    for x in fps:
        groups.setdefault(find(x), set()).add(expected[x])
    assert all(len(g) == 1 for g in groups.values())
    assert len(groups) == len(set(expected.values()))


def test_components(spark):
    rng = np.random.default_rng(1)
    links = [(i, i + 1) for i in range(100, 160)] + [(7, x) for x in range(1000, 1100)] + [(5, 5), (160, 3)]
    links += [(int(a), int(b)) for a, b in rng.integers(2000, 2100, (40, 2))]
    got = {r.node: r.root for r in components.connected_components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    parent = {x: x for l in links for x in l}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    expected = {x: find(x) for l in links if l[0] != l[1] for x in l}
    assert got == expected


def test_near_duplicates_of_awkward_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert simhash.near_duplicates(empty).collect() == []
    rows = [(None, "a b c", None, None, None), (None, None, None, None, None), (2, "a b c", "x", "x", 1), (2, "a b c", "x", "x", 1)]
    got = simhash.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.doc_id is None, r.component_id, r.kept) for r in got if r.fp) == [
        (False, 2, False), (False, 2, True), (True, 2, False)]
    assert [(r.doc_id, r.component_id, r.kept) for r in got if not r.fp] == [(None, None, True)]


def dedup_texts():
    long = " ".join(words(1, 30_000))
    other = long[:-1] + "z"
    return ([long, long.replace(" ", "\n", 5), other, long + " ", " " + long, "a  b", "a\tb", "a b", "a b ", "A b", "", None, " ", "\n\n",
             "\xa0", "x" * 20_000, "x" * 20_000, "x" * 19_999, "漢字" * 5000, "漢字" * 5000] + ["copy of copy"] * 30)


@pytest.mark.parametrize("bits", [64, 3])
def test_exact_duplicates(spark, bits):
    """With three hash bits nearly all chunks share identifiers and have to be told apart by content."""
    texts = dedup_texts()
    df = spark.createDataFrame([(i, t, "m", "f", 1) for i, t in enumerate(texts)], SCHEMA)
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for t in texts]
    got = {r.doc_id: r for r in exactdedup.exact_duplicates(df, hash_bits=bits).collect()}
    assert len(got) == len(texts)
    for i, n in enumerate(norm):
        same = [j for j, m in enumerate(norm) if m == n]
        assert (got[i].keep_id, got[i].group_size, got[i].kept) == (same[0], len(same), i == same[0])
        assert got[i].text_sha256 == hashlib.sha256(n.encode()).hexdigest()


def test_exact_duplicates_of_awkward_tables(spark):
    assert exactdedup.exact_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = [(None, "a", None, None, None), (3, "a", "x", "x", 1), (3, "a", "x", "x", 1), (None, None, None, None, None), (None, "", None, None, None)]
    got = exactdedup.exact_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.kept) for r in got) == sorted([
        ("None", "3", 3, False), ("3", "3", 3, True), ("3", "3", 3, False), ("None", "None", 2, True), ("None", "None", 2, False)])


def test_chunks_join_to_the_text(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(t,) for t in dedup_texts() if t], "text string")
    df = df.select("text", exactdedup.chunks(F.col("text"), 16, 64).alias("c"))
    for r in df.collect():
        assert "".join(r.c) == r.text and max(map(len, r.c)) <= 64 + 1
