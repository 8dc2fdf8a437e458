"""Language model scores from a log-frequency Bloom filter of n-gram counts."""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, log

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..sources.staging import stage
from . import common

#: Counts are kept by level: level j says "at least BASE^(j-1)".
BASE = 1.5
PROBES = 6
BITS_PER_ENTRY = 14
#: Tokens of the texts for each block of the filter, roughly.
BLOCK_TOKENS = 2_000_000
#: Largest model that is broadcast; the blocks of a larger one stay on executors and the texts' n-grams go to them.
PASS_BYTES = 256 << 20
#: Weight of the words' own frequencies against those behind the context.
PRIOR = 300.0
REMEMBERED = 300_000
CHUNK = 200_000
#: Hash of the end of a text; no word holds a space.
END = xxhash.xxh64_intdigest(b" ", 42)
END_BYTES = END.to_bytes(8, "big")


class Words(dict):
    """Hashes of words as bytes; remembers the words of recent texts."""

    def __missing__(self, word: bytes) -> bytes:
        out = xxhash.xxh64_digest(word, 42)
        if len(word) <= 64:
            self[word] = out
        return out

    def hashes(self, text: str | None) -> bytes:
        """64-bit hashes, eight bytes each, of the lower-cased words and the end."""
        if len(self) > REMEMBERED:
            self.clear()
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()
        return b"".join(map(self.__getitem__, words)) + END_BYTES


def tokens(hashes: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(hashes), ">u8").astype(np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def before_of(words: np.ndarray) -> np.ndarray:
    """The word before each of a run of whole texts; a text's first word stands behind the end of some text."""
    return np.concatenate([[np.uint64(END)], words[:-1]])


def pairs(before: np.ndarray, words: np.ndarray) -> np.ndarray:
    return mix(before * np.uint64(0x9E3779B97F4A7C15) + words)


def levels_of(counts: np.ndarray) -> np.ndarray:
    """How many levels a count fills: the largest j with BASE^(j-1) <= count."""
    return np.floor(np.log(counts) / log(BASE) + 1e-9).astype(np.int64) + 1


def value_of(levels: np.ndarray) -> np.ndarray:
    """The middle of the whole counts that a level stands for; 0 for level 0."""
    low, high = np.ceil(BASE ** (levels - 1.0) - 1e-9), np.ceil(BASE ** (levels + 0.0) - 1e-9) - 1
    return np.where(levels > 0, (low + np.maximum(high, low)) / 2, 0.0)


def _positions(hashes: np.ndarray, level, probe: int, sizes) -> np.ndarray:
    a = mix(hashes + np.uint64(0x632BE59BD9B4E019) * np.asarray(level).astype(np.uint64))
    b = mix(a) | np.uint64(1)
    return (a + np.uint64(probe) * b) % sizes


def make_filter(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A block's bits, packed: each n-gram with every level up to that of its count."""
    levels = levels_of(counts)
    entries = np.repeat(hashes, levels)
    level = np.arange(len(entries)) - np.repeat(np.cumsum(levels) - levels, levels) + 1
    size = max(64, -(-len(entries) * BITS_PER_ENTRY // 8) * 8)
    bits = np.zeros(size, bool)
    for i in range(PROBES):
        bits[_positions(entries, level, i, np.uint64(size)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little")


class Filter:
    """Blocks of the filter end to end, with exact word counts beside them; views of plain bytes, which travel well."""

    def __init__(self, blocks: int, bits: dict[int, bytes], words: bytes, counts: bytes):
        self.blocks = blocks
        parts = [bits.get(i, bytes(8)) for i in range(blocks)]
        self.sizes = np.array([8 * len(p) for p in parts], np.uint64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.bits = b"".join(parts)
        self.words, self.counts = words, counts

    def view(self) -> Filter:
        """The same with arrays over the bytes, without a copy."""
        out = Filter.__new__(Filter)
        out.__dict__ = {**self.__dict__, "bits": np.frombuffer(self.bits, np.uint8),
                        "words": np.frombuffer(self.words, np.uint64), "counts": np.frombuffer(self.counts, np.int64)}
        return out

    def count(self, hashes: np.ndarray) -> np.ndarray:
        """Exact counts of words by binary search."""
        at = np.minimum(np.searchsorted(self.words, hashes), max(len(self.words) - 1, 0))
        return np.where(self.words[at] == hashes, self.counts[at], 0) if len(self.words) else np.zeros(len(hashes), np.int64)

    def level(self, hashes: np.ndarray, block: np.ndarray) -> np.ndarray:
        """Probe level after level until one is missing."""
        out, alive, level = np.zeros(len(hashes), np.int64), np.arange(len(hashes)), 1
        while len(alive):
            for i in range(PROBES):
                own = block[alive]
                at = _positions(hashes[alive], level, i, self.sizes[own]) + self.starts[own]
                alive = alive[(self.bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1]
            out[alive] = level
            level += 1
        return out


def block_of(hashes: np.ndarray, blocks: int) -> np.ndarray:
    """Blocks are ranges of hashes, of words as of pairs: what stands behind one frequent word is in all of them."""
    return ((hashes >> np.uint64(32)) * np.uint64(blocks) >> np.uint64(32)).astype(np.int64)


def _edges(hashes: np.ndarray, blocks: int) -> np.ndarray:
    """Where each block begins among sorted hashes, and the end."""
    return np.searchsorted(block_of(hashes, blocks), np.arange(blocks + 1))


def _cut(x: np.ndarray, edges: np.ndarray) -> list[bytes]:
    return [x[i:j].tobytes() for i, j in zip(edges[:-1], edges[1:])]


def _counted(batches: Iterator[pa.RecordBatch], blocks: int) -> Iterator[pa.RecordBatch]:
    """(block, words, word_counts, pairs, pair_counts): what a run of texts has for each block, summed, as packed arrays.

    Words and pairs are in the block of their own hash.
    """
    known, todo, held = Words(), [], 0

    def out() -> pa.RecordBatch:
        own = tokens(todo)
        u, n = np.unique(own, return_counts=True)
        g, m = np.unique(pairs(before_of(own), own), return_counts=True)
        at, by = _edges(u, blocks), _edges(g, blocks)
        n, m = n.astype(np.uint32), m.astype(np.uint32)
        return pa.RecordBatch.from_arrays([pa.array(np.arange(blocks, dtype=np.int32)), *[
            pa.array(_cut(x, e), pa.binary()) for x, e in ((u, at), (n, at), (g, by), (m, by))]], PACKED)

    for batch in batches:
        for text in batch.column(0):
            todo.append(known.hashes(text.as_py()))
            held += len(todo[-1]) // 8
            if held > 5 * CHUNK:
                yield out()
                todo, held = [], 0
    if todo:
        yield out()


#: What ``score`` adds.
NEW = {"n_tokens": "bigint", "n_known": "bigint", "train_tokens": "bigint", "base_score": "double", "score": "double"}
PACKED = ["block", "words", "word_counts", "pairs", "pair_counts"]


def _summed(hashes: pd.Series, counts: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    h, n = (np.frombuffer(b"".join(x), kind) for x, kind in ((hashes, np.uint64), (counts, np.uint32)))
    own, at = np.unique(h, return_inverse=True)
    return own, np.bincount(at, n, len(own)).astype(np.int64)


def count_model(df: DataFrame, text_col: str = "text", blocks: int | None = None) -> DataFrame:
    """(block, bits, words, counts): per block the packed filter of its pairs and the exact counts of its words.

    Counts cover all texts of ``df``.  They are summed by runs of about a million words before the one shuffle, which
    deals them out by block in packed form; a frequent pair costs one entry per run however often it occurs.
    """
    texts = df.select(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    if blocks is None:
        size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        blocks = max(4 * common.partitions(df.sparkSession), ceil(size / 6 / BLOCK_TOKENS))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _counted(batches, blocks)

    def build(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        words, counts = _summed(part["words"], part["word_counts"])
        grams, times = _summed(part["pairs"], part["pair_counts"])
        return pd.DataFrame({"block": [key[0]], "blocks": [blocks], "bits": [make_filter(grams, times).tobytes()],
                             "words": [words.tobytes()], "counts": [counts.tobytes()]})

    counted = texts.mapInArrow(count, "block int, words binary, word_counts binary, pairs binary, pair_counts binary")
    return stage(counted.groupBy("block").applyInPandas(
        build, "block int, blocks int, bits binary, words binary, counts binary"), "lm-blocks")


def _load(model: DataFrame, blocks: int) -> Filter:
    """The whole filter with the counts of all words; its size has been checked."""
    bits, words, counts = {}, [], []
    for r in model.orderBy("block").toLocalIterator():
        bits[r["block"]] = bytes(r["bits"])
        words.append(bytes(r["words"]))  # blocks are ranges of hashes: end to end they are in order
        counts.append(bytes(r["counts"]))
    return Filter(blocks, bits, b"".join(words), b"".join(counts))


def score(df: DataFrame, model: DataFrame, text_col: str = "text", prior: float = PRIOR,
          pass_bytes: int = PASS_BYTES) -> DataFrame:
    """Every row of ``df`` without its text, with n_tokens, n_known, train_tokens, base_score and score.

    Tokens are the lower-cased words and one end.  base_score sums log10((c+0.5)/(N+0.5(V+1))) over the tokens.  In ``score``
    a token's probability is (b + prior p) / (a + prior): p is the base probability, a the exact count of the word before
    it, b the count of the pair as the filter has it (no more than either word's).  A null or empty text is the end alone.
    Against an empty corpus N and V are 0.  Columns with the new names are replaced.

    The filter with the word counts is broadcast.  Where it is larger than ``pass_bytes``, nothing is: the different words
    and pairs of each run of texts are shuffled to their blocks, counts and levels come back by run and are summed by row.
    The texts are read once, and ``df`` must be a stored table then (``common.mark_rows``).
    """
    spark = df.sparkSession
    sizes = model.select("block", "blocks", (F.octet_length("bits") + F.octet_length("words") + F.octet_length("counts"))
                         .alias("bytes"), (F.octet_length("words") / 8).cast("long").alias("v")).collect()
    totals = model.select(F.col("block"), F.expr("counts")).mapInArrow(_sums, "n bigint").agg(F.sum("n")).first()[0]
    total, distinct = int(totals or 0), sum(r["v"] for r in sizes)
    blocks = sizes[0]["blocks"] if sizes else 1
    if sum(r["bytes"] for r in sizes) > pass_bytes:
        return _by_blocks(df, model, text_col, prior, total, distinct, blocks)
    return _one_pass(df, spark.sparkContext.broadcast(_load(model, blocks)), text_col, prior, total, distinct)


def _probes(batches: Iterator[pa.RecordBatch], blocks: int) -> Iterator[pa.RecordBatch]:
    """What a run of texts asks each block, and at block -1 how its answers make up the texts.

    ``words`` and ``pairs`` hold different hashes in order.  At block -1 they hold, for each pair, where its word and the
    word before are among the run's words; ``at`` has each token's pair, ``marks`` and ``starts`` the texts.
    """
    known, todo, marks, held = Words(), [], [], 0

    def out() -> pa.RecordBatch:
        own = tokens(todo)
        before = before_of(own)
        u, word = np.unique(own, return_inverse=True)
        g, first, at = np.unique(pairs(before, own), return_index=True, return_inverse=True)
        starts = np.cumsum([0] + [len(t) // 8 for t in todo[:-1]])
        rows = [(k, w, p, None, None, None) for k, (w, p) in enumerate(
            zip(_cut(u, _edges(u, blocks)), _cut(g, _edges(g, blocks)))) if w or p]
        rows.append((-1, word[first].astype(np.int32).tobytes(), np.searchsorted(u, before[first]).astype(np.int32).tobytes(),
                     at.astype(np.int32).tobytes(), np.array(marks, np.int64).tobytes(), starts.astype(np.int64).tobytes()))
        columns = list(zip(*rows))
        return pa.RecordBatch.from_arrays([pa.array([marks[0]] * len(rows), pa.int64()), pa.array(columns[0], pa.int32()),
                                           *[pa.array(c, pa.binary()) for c in columns[1:]]], [n.split()[0] for n in PROBE.split(", ")])

    for batch in batches:
        for mark, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            todo.append(known.hashes(text.as_py()))
            marks.append(mark)
            held += len(todo[-1]) // 8
            if held > 5 * CHUNK:
                yield out()
                todo, marks, held = [], [], 0
    if todo:
        yield out()


PROBE = "run bigint, block int, words binary, pairs binary, at binary, marks binary, starts binary"


def _split(answers: np.ndarray, asked: pd.Series, width: int = 8) -> list[bytes]:
    return _cut(answers, np.concatenate([[0], np.cumsum([len(x) // width for x in asked])]).astype(np.int64))


def _by_blocks(df: DataFrame, model: DataFrame, text_col: str, prior: float, total: int, distinct: int, blocks: int) -> DataFrame:
    marked = common.mark_rows(df, "__mark")
    texts = marked.select("__mark", F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    asked = stage(texts.mapInArrow(lambda batches: _probes(batches, blocks), PROBE), "lm-probes")

    def answer(key: tuple, part: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        """Counts of the words and levels of the pairs, for every run that asks this block."""
        made = pd.DataFrame({"run": part["run"], "block": part["block"]})
        has = len(own) > 0
        block = Filter(1, {0: own["bits"][0]} if has else {}, own["words"][0] if has else b"", own["counts"][0] if has else b"").view()
        w, w_at = np.unique(np.frombuffer(b"".join(part["words"]), np.uint64), return_inverse=True)
        g, g_at = np.unique(np.frombuffer(b"".join(part["pairs"]), np.uint64), return_inverse=True)
        made["counts"] = _split(block.count(w)[w_at].astype(np.int64), part["words"])
        made["levels"] = _split(block.level(g, np.zeros(len(g), np.int64))[g_at].astype(np.uint8), part["pairs"])
        return made

    floor = total + 0.5 * (distinct + 1)

    def sum_up(key: tuple, run: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        """The sums of each text of a run."""
        told = told.sort_values("block")  # blocks are ranges of hashes: end to end they are in the run's order
        c = np.frombuffer(b"".join(told["counts"]), np.int64)
        found = value_of(np.frombuffer(b"".join(told["levels"]), np.uint8).astype(np.int64))
        word, before, at = (np.frombuffer(run[n][0], np.int32) for n in ("words", "pairs", "at"))
        marks, starts = (np.frombuffer(run[n][0], np.int64) for n in ("marks", "starts"))
        p = (c + 0.5) / floor
        least = np.minimum(c[word], c[before])  # 0 where either word is unknown
        terms = ((c > 0)[word], np.log10(p)[word], np.log10((np.minimum(found, least) + prior * p[word]) / (c[before] + prior)))
        known, base, whole = (np.add.reduceat(t[at].astype(np.float64), starts) for t in terms)
        return pd.DataFrame({"__mark": marks, "n_tokens": np.diff(np.append(starts, len(at))), "n_known": known.astype(np.int64),
                             "train_tokens": total, "base_score": base, "score": whole})

    told = asked.where("block >= 0").select("run", "block", "words", "pairs").groupBy("block").cogroup(
        model.groupBy("block")).applyInPandas(answer, "run bigint, block int, counts binary, levels binary")
    sums = asked.where("block < 0").groupBy("run").cogroup(told.groupBy("run")).applyInPandas(
        sum_up, "__mark bigint, " + ", ".join(f"{n} {t}" for n, t in NEW.items()))
    return common.without(marked, text_col, *NEW).join(sums, "__mark").drop("__mark")


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array([int(np.frombuffer(x.as_py(), np.int64).sum())
                                                    for x in batch.column("counts")], pa.int64())], ["n"])


def _one_pass(df, shared, text_col, prior, total, distinct) -> DataFrame:
    kept = common.without(df, text_col, *NEW)
    names = kept.columns
    floor = total + 0.5 * (distinct + 1)

    def of_texts(model: Filter, own: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """(n_tokens, n_known, base, score) of each of a run of whole texts."""
        before = before_of(own)
        once, at = np.unique(own, return_inverse=True)
        c = model.count(once)[at]
        a = np.concatenate([model.count(before[:1]), c[:-1]])
        p = (c + 0.5) / floor
        b = np.zeros(len(own))
        able = np.flatnonzero((c > 0) & (a > 0))
        for i in range(0, len(able), CHUNK):
            part = able[i:i + CHUNK]
            grams, at = np.unique(pairs(before[part], own[part]), return_inverse=True)
            found = value_of(model.level(grams, block_of(grams, model.blocks)))[at]
            b[part] = np.minimum(found, np.minimum(c, a)[part])
        terms = (np.ones(len(own)), c > 0, np.log10(p), np.log10((b + prior * p) / (a + prior)))
        return np.stack([np.add.reduceat(np.asarray(t, np.float64), starts) for t in terms])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, known = shared.value.view(), Words()
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                texts, held, begin = [], 0, at
                while at < batch.num_rows and held < 8 * CHUNK:
                    texts.append(known.hashes(batch.column("__text")[at].as_py()))
                    held += len(texts[-1])
                    at += 1
                starts = np.cumsum([0] + [len(t) // 8 for t in texts[:-1]])
                sums = of_texts(model, tokens(texts), starts)
                part = batch.slice(begin, at - begin)
                columns = [pa.array(sums[0].astype(np.int64)), pa.array(sums[1].astype(np.int64)),
                           pa.array(np.full(len(texts), total, np.int64)), pa.array(sums[2]), pa.array(sums[3])]
                yield pa.RecordBatch.from_arrays([*[part.column(n) for n in names], *columns], [*names, *NEW])

    from pyspark.sql.types import _parse_datatype_string, StructType
    schema = StructType([*kept.schema.fields, *_parse_datatype_string(", ".join(f"{n} {t}" for n, t in NEW.items())).fields])
    return df.select(*[F.col(f"`{n}`") for n in names],
                     F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("__text")).mapInArrow(run, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    held = docs.select("doc_id", (common.crc_bucket("doc_id", 5) == 1).alias("held_out"), "text")
    return score(held, count_model(held.where("not held_out")))
