"""Near-duplicates by SimHash fingerprints and meet-in-the-middle ball hashing."""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, log2

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..sources.staging import stage
from . import common
from .components import connected_components

SEED = 42
RADIUS = 3
#: Variants that one group of the ball join may hold: about 100 MB while they are sorted.
GROUP_ENTRIES = 2_000_000
BLOCK = 200_000


def fingerprint(text: str | None, width: int = 3) -> int:
    """64-bit SimHash of the word shingles of a text, repeats included; 0 for a text without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined, digest = b" ".join(words), xxhash.xxh64_digest
    if len(words) < width:
        return int.from_bytes(digest(joined, SEED), "big")
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts, ends = (ends - sizes)[:len(words) - width + 1].tolist(), ends[width - 1:].tolist()
    ones = np.zeros(64, np.int64)
    for at in range(0, len(starts), BLOCK):
        hashes = b"".join([digest(joined[s:e], SEED) for s, e in zip(starts[at:at + BLOCK], ends[at:at + BLOCK])])
        ones += np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(starts)).tobytes(), "big")


def fingerprints(df: DataFrame, text_col: str = "text", width: int = 3, name: str = "fp") -> DataFrame:
    """``df`` without its text, with the fingerprint as a signed long."""
    kept = common.without(df, text_col, name)
    schema = f"{kept.schema.simpleString()[7:-1]}, {name} bigint" if kept.columns else f"{name} bigint"
    text, fields = "__text", kept.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = np.array([fingerprint(x.as_py(), width) for x in batch.column(text)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in fields], pa.array(made)], [*fields, name])

    from pyspark.sql.types import LongType, StructType
    schema = StructType([*kept.schema.fields]).add(name, LongType())
    return df.select(*[F.col(f"`{c}`") for c in fields], F.col(f"`{text_col}`").cast("string").alias(text)).mapInArrow(
        run, schema)


def _syndromes(bits: int) -> np.ndarray:
    """A random linear hash: the value of each of the 64 unit masks; a mask's value is the XOR over its bits."""
    return np.random.default_rng(SEED).integers(0, 1 << bits, 64, dtype=np.int64)


def _masks(bits: int, weights: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """All masks of these weights, sorted by their value under the linear hash; where each value starts."""
    unit, value = np.uint64(1) << np.arange(64, dtype=np.uint64), _syndromes(bits)
    i, j = np.triu_indices(64, 1)
    by_weight = {0: (np.zeros(1, np.uint64), np.zeros(1, np.int64)), 1: (unit, value),
                 2: (unit[i] | unit[j], value[i] ^ value[j])}
    masks, values = (np.concatenate(x) for x in zip(*[by_weight[w] for w in weights]))
    order = np.argsort(values, kind="stable")
    return masks[order], np.searchsorted(values[order], np.arange((1 << bits) + 1))


#: A pair within three bits shares a variant when fingerprints of even weight emit the balls of radius 0
#: and 1, those of odd weight the spheres of radius 1 and 2: an odd distance joins unlike weights (1 + 2 or
#: 0 + 1 bits), distance two joins like weights (1 + 1 bits).
WEIGHTS = {0: (0, 1), 1: (1, 2)}


def _hash_value(fp: Column, bits: int) -> Column:
    """The linear hash of a fingerprint in built-in functions."""
    value = _syndromes(bits)
    rows = [int(sum(1 << i for i in range(64) if value[i] >> j & 1)) for j in range(bits)]
    signed = [r - (1 << 64) if r >> 63 else r for r in rows]
    out = F.lit(0)
    for j, r in enumerate(signed):
        out = out + F.shiftleft(F.bit_count(fp.bitwiseAND(F.lit(r).cast("long"))) % 2, j)
    return out


def _expand(fps: np.ndarray, target: np.ndarray, masks: np.ndarray, offsets: np.ndarray):
    """Of each fingerprint, the variants that belong to the group; and whose they are."""
    first, n = offsets[target], offsets[target + 1] - offsets[target]
    owner = np.repeat(np.arange(len(fps)), n)
    at = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n) + first[owner]
    return fps[owner] ^ masks[at], fps[owner]


def _weight(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


def _links_of_group(fps: np.ndarray, group: int, bits: int) -> np.ndarray:
    """Links between the fingerprints that share a variant of this group: a star around one of them."""
    value, parts = _syndromes(bits), []
    fps = np.unique(fps)
    for odd in (0, 1):
        own = fps[_weight(fps) % 2 == odd]
        hashed = np.zeros(len(own), np.int64)
        for i in range(64):
            hashed ^= np.where((own >> np.uint64(i)) & np.uint64(1), value[i], 0)
        parts.append(_expand(own, hashed ^ group, *_masks(bits, WEIGHTS[odd])))
    variants, owners = (np.concatenate(x) for x in zip(*parts))
    if not len(variants):
        return np.zeros((0, 2), np.uint64)
    order = np.argsort(variants, kind="stable")  # even fingerprints first, each kind in its order
    variants, owners = variants[order], owners[order]
    new = np.concatenate([[True], variants[1:] != variants[:-1]])
    hub = owners[np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))]
    # Two odd fingerprints two bits away from an odd variant may be four apart; around an even hub all are within three.
    ok = ~new & ((_weight(variants) % 2 == 0) | (_weight(hub) % 2 == 0)) & (_weight(hub ^ owners) <= RADIUS)
    return np.unique(np.stack([hub[ok], owners[ok]], 1), axis=0) if ok.any() else np.zeros((0, 2), np.uint64)


def ball_links(spark: SparkSession, distinct: DataFrame, group_entries: int = GROUP_ENTRIES,
               min_bits: int = 7) -> DataFrame:
    """Links (a, b) between the different fingerprints in ``distinct`` (fp: long, unique) within three bits.

    Not all pairs within three bits come out, but enough of them to connect every such pair: of the
    fingerprints that share a variant, all are linked to one.  The variants are dealt out by a linear hash.
    A fingerprint travels once to each group that owns some of its variants, and the group rebuilds
    these from tables of masks by hash value; with more fingerprints there are more groups, so that none
    holds more than about ``group_entries`` variants.
    """
    n = distinct.count()
    bits = max(min_bits, min(24, ceil(log2(max(1, n * 1073 / group_entries)))))
    homes = []
    for odd in (0, 1):
        _, offsets = _masks(bits, WEIGHTS[odd])
        homes.append(F.array(*[F.lit(int(x)) for x in np.flatnonzero(np.diff(offsets))]))
    sent = (distinct.select("fp", _hash_value(F.col("fp"), bits).alias("s"))
            .select("fp", "s", F.explode(F.when(F.bit_count("fp") % 2 == 0, homes[0]).otherwise(homes[1])).alias("t"))
            .select("fp", F.col("t").bitwiseXOR(F.col("s")).alias("grp")))

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        links = _links_of_group(rows["fp"].to_numpy().view(np.uint64), int(key[0]), bits)
        return pd.DataFrame({"a": links[:, 0].view(np.int64), "b": links[:, 1].view(np.int64)})

    return sent.groupBy("grp").applyInPandas(run, "a bigint, b bigint").distinct()


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3,
                    group_entries: int = GROUP_ENTRIES) -> DataFrame:
    """Fingerprint and class of every row: ``id_col``, mark, fp (long), component_id, kept.

    Texts link when their fingerprints differ in three bits or fewer; a class is whatever links connect,
    named after its smallest id.  ``kept`` marks one row of each class: that with the smallest id, of rows
    with that id the first.  ``mark`` numbers the rows (see ``mark_rows``).  Null and empty texts and those of
    white space have fingerprint zero and are linked like any other.  Null ids come after all others; a
    class without an id has a null name.  Other columns are not looked at.  An empty table gives an empty result.

    Equal fingerprints are grouped first, so copies cost one row; only different fingerprints meet in the
    ball join.  What the joins work on is written to the shared folder.
    """
    spark = df.sparkSession
    rows = stage(fingerprints(common.mark_rows(
        df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")), "mark"), "text", width),
        "fingerprints")
    first = F.min(F.struct(F.col("id").isNull().alias("n"), "id", "mark")).alias("first")
    distinct = stage(rows.groupBy("fp").agg(first), "distinct-fingerprints")
    roots = connected_components(ball_links(spark, distinct.select("fp"), group_entries))
    rooted = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp"))
    heads = rooted.groupBy("root").agg(F.min("first").alias("head"))
    classes = rooted.join(heads, "root").select("fp", "head")
    return rows.join(classes, "fp").select(
        F.col("id").alias(id_col), "mark", "fp", F.col("head.id").alias("component_id"),
        (F.col("mark") == F.col("head.mark")).alias("kept"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(common.table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
