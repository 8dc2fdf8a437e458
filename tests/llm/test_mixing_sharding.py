"""Mixing and sharding against their laws, on skewed and awkward rows."""

import re
import zlib

import pytest

from cellstride.llm import mixing, sharding

SCHEMA = "doc_id bigint, text string, source string, size string, shard int, slot int"


def table(spark, n=600):
    rows = [(i, " ".join(["w"] * (i * 7919 % 90)) or None, [None, "a", "é", "z", "hot", "hot", "hot", "B" if i < 60 else "hot"][i % 8], "x", 1, 2) for i in range(n)]
    return spark.createDataFrame(rows, SCHEMA).repartition(5, "doc_id")


def targets(sizes, weights=(5, 2, 1), most=3):
    """Round by round: share by weight, cap, share the excess again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + ([None] if None in sizes else [])
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    total, got, open_ = sum(sizes.values()), dict.fromkeys(names, 0.0), set(names)
    rest = float(total)
    while rest > 1e-9 and open_:
        each = rest / sum(w[s] for s in open_)
        for s in open_:
            got[s] += each * w[s]
        rest = 0.0
        for s in list(open_):
            if got[s] > most * sizes[s]:
                rest += got[s] - most * sizes[s]
                got[s] = most * sizes[s]
                open_.discard(s)
    return got


def test_mix(spark):
    df = table(spark)
    rows = mixing.mix(df).collect()
    assert len(rows) == 600 and set(rows[0].asDict()) == {
        "doc_id", "text", "source", "size", "shard", "slot", "source_size", "target", "passes", "taken"}
    sizes, taken = {}, {}
    for r in rows:
        assert r["size"] == len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
        assert r.taken == r.passes * r["size"] and 0 <= r.passes <= 3
        sizes[r.source] = sizes.get(r.source, 0) + r["size"]
        taken[r.source] = taken.get(r.source, 0) + r.taken
    expected = targets(sizes)
    for r in rows:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(expected[r.source])
    for s in sizes:
        assert abs(taken[s] - expected[s]) <= 90
    assert any(expected[s] == 3 * sizes[s] for s in sizes)
    again = mixing.mix(df.repartition(9)).collect()
    assert sorted((r.doc_id, r.passes) for r in again) == sorted((r.doc_id, r.passes) for r in rows)


def test_levels_refine_to_single_places(spark, monkeypatch):
    whole = {r.doc_id: r.passes for r in mixing.mix(table(spark)).collect()}
    monkeypatch.setattr(mixing, "LEVEL_BITS", 4)
    assert {r.doc_id: r.passes for r in mixing.mix(table(spark)).collect()} == whole


def test_mix_of_awkward_tables(spark):
    assert mixing.mix(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = [(1, None, "a", None, None, None), (2, "", None, None, None, None)]
    assert [(r["size"], r.target, r.taken) for r in mixing.mix(spark.createDataFrame(rows, SCHEMA)).collect()] == [(0, 0.0, 0)] * 2
    rows = [(None, "a b", None, None, None, None)] * 3 + [(7, "c " * 100_000, "s", None, None, None)]
    got = mixing.mix(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == 4 and all(r.taken <= 3 * r["size"] for r in got)
    assert len({r.passes for r in got if r.doc_id is None}) == 1


def test_shards(spark):
    rows = sharding.shard(table(spark), 7).collect()
    assert len(rows) == 600 and sorted(r.doc_id for r in rows) == list(range(600))
    slots = {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
    assert set(slots) == set(range(7))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    order = [r.doc_id for r in sorted(rows, key=lambda r: (r.slot, r.shard))]
    assert order != sorted(order) and sum(abs(a - b) > 20 for a, b in zip(order, order[1:])) > 400
    other = [r.doc_id for r in sorted(sharding.shard(table(spark), 7, seed=1).collect(), key=lambda r: (r.slot, r.shard))]
    assert other != order


def test_same_shards_whatever_the_session(spark, tmp_path):
    """Partitions of a shuffle, and whether small ones are joined, move no row; a bucket is one task's."""
    table(spark, 900).write.parquet(str(tmp_path / "docs"))
    docs, seen = spark.read.parquet(str(tmp_path / "docs")), []
    names = ["spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled"]
    before = [spark.conf.get(n) for n in names]
    try:
        for n, joined in ((4, "true"), (8, "true"), (16, "false"), (4, "false")):
            spark.conf.set(names[0], n)
            spark.conf.set(names[1], joined)
            seen.append(sorted((r.doc_id, r.shard, r.slot) for r in sharding.shard(docs, 8, bucket_bytes=4000).collect()))
    finally:
        for n, value in zip(names, before):
            spark.conf.set(n, value)
    assert all(s == seen[0] for s in seen)
    held = sharding.shard(docs, 8, bucket_bytes=4000)._jdf.queryExecution().executedPlan().toString()
    assert held.count("REPARTITION_BY_NUM") == 1 and "Python" not in held


def test_query_values(spark, small):
    rows = sharding.query(spark, small).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    for r in rows:
        data = (texts[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(data) + 1, zlib.crc32(data), "rows", None)
    again = sharding.query(spark, small).collect()
    assert sorted((r.doc_id, r.shard, r.slot) for r in again) == sorted((r.doc_id, r.shard, r.slot) for r in rows)


def test_shards_of_repeated_rows(spark):
    """Rows alike in all columns fill no bucket: they are scattered by their number."""
    df = spark.createDataFrame([(None, None, "s", "x", 1, 2)] * 300 + [(5, "t" * 100_000, "s", "x", 1, 2)], SCHEMA)
    rows = sharding.shard(df, 4, bucket_bytes=50).collect()
    assert sorted((r.shard, r.slot) for r in rows) == sorted((i % 4, i // 4) for i in range(301))
    assert sum(r.doc_id == 5 for r in rows) == 1
    assert sharding.shard(spark.createDataFrame([], SCHEMA)).collect() == []


def test_written_shards(spark, tmp_path):
    sharding.write_shards(table(spark, 50), str(tmp_path / "out"), 3)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 50 and {r.shard for r in back.select("shard").distinct().collect()} == {0, 1, 2}
