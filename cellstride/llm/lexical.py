"""Ranked lexical search: documents grouped by the mask of an item's terms they hold, best masks first."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..sources.staging import stage
from . import common

#: Terms of UTF-8 text: runs of letters and digits of ASCII and of any other character.
TERM = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
GAP = re.compile(rb"[^0-9A-Za-z\x80-\xff]")
TOP = 20
#: Texts are cut into terms by pieces of about this many bytes; items are searched in blocks of at most that many bytes.
PIECE, ITEM_BYTES = 1 << 20, 4 << 20
#: A group of documents searched at once: at most this many documents, postings and words of masks.
GROUP_DOCS, GROUP_POSTINGS, GROUP_WORDS = 1 << 15, 1 << 20, 1 << 20


def terms(data: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, only A to Z in lower case, in lists of bounded length."""
    start = 0
    while start < len(data):
        end = start + PIECE
        if end < len(data):  # not through a term
            found = GAP.search(data, end)
            end = found.start() if found else len(data)
        yield TERM.findall(data[start:end].lower())  # bytes.lower() knows ASCII only
        start = end


def _bytes(value) -> bytes:
    return (value or "").encode("utf-8", "surrogatepass")


@dataclass(frozen=True)
class Items:
    """A block of items: number, id, and per item its different terms with how often each occurs in it."""

    vocabulary: dict[bytes, int]
    numbers: np.ndarray
    of: list[tuple[np.ndarray, np.ndarray]]

    @staticmethod
    def read(numbers: list[int], texts: list[str | None]) -> Items:
        vocabulary: dict[bytes, int] = {}
        of = []
        for text in texts:
            counts: dict[int, int] = {}
            for part in terms(_bytes(text)):
                for term in part:
                    t = vocabulary.setdefault(term, len(vocabulary))
                    counts[t] = counts.get(t, 0) + 1
            of.append((np.fromiter(counts, np.int64, len(counts)), np.fromiter(counts.values(), np.int64, len(counts))))
        return Items(vocabulary, np.array(numbers, np.int64), of)


def postings(docs: DataFrame, vocabulary: dict[bytes, int], id_col: str, text_col: str) -> DataFrame:
    """(doc_id, n, ids, tfs) of every row: its number of terms, the vocabulary's terms in it, how often each occurs."""
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = known.value.get
        for batch in batches:
            n, ids, tfs = [], [], []
            for text in batch.column(1):
                total, seen = 0, {}
                for part in terms(_bytes(text.as_py())):
                    total += len(part)
                    for t in map(number, part):
                        if t is not None:
                            seen[t] = seen.get(t, 0) + 1
                n.append(total)
                ids.append(list(seen))
                tfs.append(list(seen.values()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.list_(pa.int32())),
                                              pa.array(tfs, pa.list_(pa.int64()))], ["doc_id", "n", "ids", "tfs"])

    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n bigint, ids array<int>, tfs array<bigint>")


def weight(n_docs: int, df: Column) -> Column:
    """floor(1000·ln((2N+2)/(2df+1))), in doubles."""
    return F.floor(1000 * F.log(F.lit(2.0 * n_docs + 2) / (2 * df + 1).cast("double"))).cast("long")


@dataclass(frozen=True)
class Group:
    """The postings of some documents: per document its slice of ``ids`` and ``factor``, and per term its documents."""

    start: np.ndarray
    ids: np.ndarray
    factor: np.ndarray
    order: np.ndarray
    doc_of: np.ndarray
    term_start: np.ndarray

    @staticmethod
    def build(n: np.ndarray, lengths: np.ndarray, ids: np.ndarray, tfs: np.ndarray, size: int, n_docs: int, total: int) -> Group:
        doc = np.repeat(np.arange(len(n)), lengths)
        # 25·n·N may exceed 64 bits in a large corpus, so the division is done by whole and remaining part.
        m = 75 + np.array([25 * int(x) * n_docs // max(total, 1) for x in n], np.int64)
        factor = (1_000_000_000 * tfs) // (1000 * tfs + 12 * m[doc])
        order = np.argsort(ids, kind="stable")
        return Group(np.concatenate([[0], np.cumsum(lengths)]), ids, factor, order, doc,
                     np.searchsorted(ids[order], np.arange(size + 1)))

    def search(self, found: tuple[np.ndarray, np.ndarray], weights: np.ndarray, doc_ids: np.ndarray, k: int, dense: np.ndarray
               ) -> tuple[np.ndarray, np.ndarray, int]:
        """Numbers and scores of the k best documents with a score above 0, and how many documents were scored.

        Each term of the item sets its bit in the masks of the documents that hold it.  Documents of one mask
        share the highest score the mask could have: the sum over its terms of the highest share any document gets from the
        term.  Masks are taken by falling highest score, and their documents scored exactly, until k scores exceed what the
        next mask could reach; a mask that could still tie is scored.  ``dense`` is a scratch array, zero by term.
        """
        term, repeats = found
        some = (weights[term] > 0) & (self.term_start[term + 1] > self.term_start[term])
        term, value = term[some], repeats[some] * weights[term[some]]
        none = np.zeros(0, np.int64)
        if not len(term):
            return none, none, 0
        held = [self.order[self.term_start[t]:self.term_start[t + 1]] for t in term]
        most = np.array([v * int(self.factor[at].max()) for v, at in zip(value, held)], np.int64)
        words = -(-len(term) // 64)
        masks = np.zeros((len(self.start) - 1, words), np.uint64)
        for bit, at in enumerate(held):
            masks[self.doc_of[at], bit // 64] |= np.uint64(1 << bit % 64)
        docs = np.flatnonzero(masks.any(1))
        masks = masks[docs]
        by_mask = np.lexsort(masks.T)
        sorted_masks = masks[by_mask]
        first = np.concatenate([[True], (sorted_masks[1:] != sorted_masks[:-1]).any(1)])
        begins = np.flatnonzero(first)
        bits = np.unpackbits(sorted_masks[begins].astype("<u8").view(np.uint8), axis=1, bitorder="little")[:, :len(term)]
        could = bits.astype(np.int64) @ most
        ends = np.append(begins[1:], len(docs))
        falling = np.argsort(-could, kind="stable")
        dense[term] = value
        best_docs, best, scored, at = none, none, 0, 0
        while at < len(falling) and (len(best) < k or could[falling[at]] >= best[k - 1]):
            # As many masks as hold a few times k documents, so that each step is one piece of array work.
            upto, here = at, 0
            while upto < len(falling) and here < 4 * k and (len(best) < k or could[falling[upto]] >= best[k - 1]):
                here += ends[falling[upto]] - begins[falling[upto]]
                upto += 1
            chosen = docs[np.concatenate([by_mask[begins[g]:ends[g]] for g in falling[at:upto]])]
            lengths = self.start[chosen + 1] - self.start[chosen]
            offsets = np.cumsum(lengths) - lengths
            where = np.repeat(self.start[chosen] - offsets, lengths) + np.arange(lengths.sum())
            scores = np.add.reduceat(dense[self.ids[where]] * self.factor[where], offsets)
            scored += len(chosen)
            best_docs, best = np.concatenate([best_docs, chosen]), np.concatenate([best, scores])
            keep = np.lexsort((doc_ids[best_docs], -best))[:k]
            best_docs, best = best_docs[keep], best[keep]
            at = upto
        dense[term] = 0
        return best_docs[best > 0], best[best > 0], scored


def _search_block(found: DataFrame, items: Items, weights: np.ndarray, n_docs: int, total: int, k: int) -> DataFrame:
    """(item, doc_id, score): per group of documents, the k best of each item."""
    sent = found.sparkSession.sparkContext.broadcast((items, weights))
    kind = found.schema["doc_id"].dataType.simpleString()
    longest = max((len(t) for t, _ in items.of), default=0)
    most_docs = max(1, min(GROUP_DOCS, GROUP_WORDS // max(1, -(-longest // 64))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, w = sent.value
        dense = np.zeros(len(w), np.int64)

        def answer(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
            table = pa.Table.from_batches(parts).combine_chunks()
            ids, tfs = (table[c].combine_chunks() for c in ("ids", "tfs"))
            group = Group.build(table["n"].to_numpy(), ids.value_lengths().to_numpy(), ids.flatten().to_numpy().astype(np.int64),
                                tfs.flatten().to_numpy(), len(w), n_docs, total)
            doc_ids = table["doc_id"].combine_chunks()
            # Rows without an id come last among equals.
            rank = np.empty(len(doc_ids), np.int64)
            rank[pa.compute.sort_indices(doc_ids, null_placement="at_end").to_numpy()] = np.arange(len(doc_ids))
            out_item, out_doc, out_score = [], [], []
            for number, terms_of in zip(asked.numbers, asked.of):
                docs, scores, _ = group.search(terms_of, w, rank, k, dense)
                out_item.append(np.full(len(docs), number))
                out_doc.append(docs)
                out_score.append(scores)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(out_item)), doc_ids.take(pa.array(np.concatenate(out_doc))),
                 pa.array(np.concatenate(out_score))], ["item", "doc_id", "score"])

        held, docs, entries = [], 0, 0
        for batch in batches:
            lengths = batch.column(2).value_lengths().to_numpy()
            begin = 0
            while begin < batch.num_rows:
                ends = np.cumsum(lengths[begin:])
                take = min(most_docs - docs, max(1, int(np.searchsorted(ends, GROUP_POSTINGS - entries, "right"))), len(ends))
                held.append(batch.slice(begin, take))
                docs, entries, begin = docs + take, entries + int(ends[take - 1]), begin + take
                if docs >= most_docs or entries >= GROUP_POSTINGS:
                    yield answer(held)
                    held, docs, entries = [], 0, 0
        if held:
            yield answer(held)

    # Documents without a term of the block take no part.
    return found.where(F.size("ids") > 0).mapInArrow(run, f"item bigint, doc_id {kind}, score bigint")


def rank_documents(docs: DataFrame, items: DataFrame, k: int = TOP, id_col: str = "doc_id", text_col: str = "text",
                   item_col: str = "item_id", item_text: str = "text", item_bytes: int = ITEM_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of each row of ``items`` with a score above 0.

    A score sums, over the item's terms with repeats, the term's weight (rarer terms weigh more) times a share that rises with
    its occurrences and falls with the document's length against the mean; all but the logarithm is 64-bit integer.

    One pass cuts the texts into terms and keeps, per document, the counts of the items' terms; sums over it give the
    corpus numbers.  A second works on groups of documents by presence masks (see ``Group.search``), each giving
    at most k rows an item.  Items are sent to all tasks in blocks whose texts hold at most ``item_bytes``; each further block
    reads the documents again (a longer item is a block of its own).

    Null and empty texts hold no terms: such items have no rows, such documents no rank.  Equal scores go by ascending
    id, null ids last; repeated documents are ranked each, repeated items (and null item ids) answered each.  Other columns are not
    looked at.  An empty table on either side gives an empty result.
    """
    spark = docs.sparkSession
    asked = stage(common.mark_rows(items.select(
        F.col(f"`{item_col}`").alias("item_id"), F.col(f"`{item_text}`").cast("string").alias("text")), "item"), "items")
    before = Window.partitionBy("split").orderBy("item")
    sizes = asked.select("item", F.shiftright("item", 33).alias("split"), F.coalesce(F.octet_length("text"), F.lit(0)).alias("size"))
    placed = stage(sizes.select("item", "split", F.floor((F.sum(F.col("size").cast("long")).over(before) - F.col("size")) / item_bytes)
                                .alias("part")), "item-blocks")
    out = None
    for block in placed.select("split", "part").distinct().orderBy("split", "part").toLocalIterator():
        chosen = asked.join(placed.where((F.col("split") == block["split"]) & (F.col("part") == block["part"])), "item")
        texts = chosen.select("item", "text").orderBy("item").collect()
        read = Items.read([t["item"] for t in texts], [t["text"] for t in texts])
        found = stage(postings(docs, read.vocabulary, id_col, text_col), "postings")
        corpus = found.agg(F.count(F.when(F.col("n") > 0, 1)).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
        known = found.select(F.explode("ids").alias("t")).groupBy("t").count().select("t", weight(corpus["docs"], F.col("count")).alias("w")).toArrow()
        weights = np.zeros(len(read.vocabulary), np.int64)
        weights[known["t"].to_numpy()] = known["w"].to_numpy()
        part = _search_block(found, read, weights, corpus["docs"], corpus["terms"], k)
        out = part if out is None else out.unionByName(part)
    if out is None:
        kind = docs.schema[id_col].dataType.simpleString()
        out = spark.createDataFrame([], f"item bigint, doc_id {kind}, score bigint")
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    best = out.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.join(asked.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_documents(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS mark, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
i AS (SELECT row_number() OVER () AS item, item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM benchmark),
c AS (SELECT count(*) FILTER (len(terms) > 0) AS N, sum(len(terms))::BIGINT AS L FROM d),
tf AS (SELECT mark, term, count(*) AS tf FROM (SELECT mark, unnest(terms) AS term FROM d) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * N + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM tf, c GROUP BY term, N),
q AS (SELECT item, term, count(*) AS r FROM (SELECT item, unnest(terms) AS term FROM i) GROUP BY ALL),
m AS (SELECT mark, doc_id, 75 + (25 * len(terms) * N) // L AS m FROM d, c WHERE L > 0),
s AS (SELECT item, doc_id, sum(r * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
      FROM q JOIN w USING (term) JOIN tf USING (term) JOIN m USING (mark) GROUP BY item, mark, doc_id),
k AS (SELECT item, doc_id, score, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
SELECT item_id, rank::INT AS rank, doc_id, score FROM k JOIN i USING (item) WHERE rank <= 20
"""
