"""Ranked lexical search: documents are scanned by an Aho-Corasick automaton of all item terms; nothing is indexed.

The terms of a block of items become one automaton. Every term is guarded by a space on both sides,
and of a text every character that belongs to no term becomes a space, so the automaton reports
whole terms only. The corpus is scanned twice: the first scan counts the statistics (all documents,
all terms, documents per item term), the second adds up scores. Automaton outputs are term numbers,
and a sparse table maps these to items. A task keeps the best few documents of each item, which is
all that leaves it; a ranked window picks the best over all tasks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from paceline.llm.common import in_pieces, with_row_id
from paceline.session import discard, stage

#: A term: a maximal run of ASCII letters and digits and of anything beyond ASCII. Only A-Z is lower-cased.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

TOP = 10
#: Bytes of item terms, and items, that one automaton and its broadcast hold on average; more items make more blocks.
BLOCK_BYTES, BLOCK_ITEMS = 1 << 20, 4096
#: Bytes of a text that are scanned at once.
PIECE = 1 << 20

_TO_TERMS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def item_terms(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(_item, item_id, term, k): how often each row of ``items`` holds each term; ``_item`` tells rows apart."""
    rows = with_row_id(items, "_item").select("_item", F.col(item_id).cast("long").alias("item_id"), F.col(text).alias("_text"))
    terms = F.regexp_extract_all(F.translate(F.coalesce("_text", F.lit("")), _UPPER, _LOWER), F.lit(f"({TERM})"), F.lit(1))
    return (rows.select("_item", "item_id", F.explode(terms).alias("term")).groupBy("_item", "item_id", "term")
            .agg(F.count(F.lit(1)).alias("k")))


class Block:
    """Automaton, and term by item counts in compressed rows, of a bounded block of items."""

    def __init__(self, rows: list) -> None:
        terms = sorted({r["term"] for r in rows})
        number = {t: i for i, t in enumerate(terms)}
        items = sorted({r["_item"] for r in rows})
        place = {x: i for i, x in enumerate(items)}
        names = {r["_item"]: r["item_id"] for r in rows}
        self.item_ids = [names[x] for x in items]
        self.size = len(terms)
        held = sorted((number[r["term"]], place[r["_item"]], r["k"]) for r in rows)
        self.term_start = np.searchsorted([h[0] for h in held], np.arange(self.size + 1))
        self.item = np.array([h[1] for h in held], np.int64)
        self.times = np.array([h[2] for h in held], np.int64)
        self.automaton = ahocorasick.Automaton()
        for t, i in number.items():
            self.automaton.add_word(f" {t} ".encode().decode("latin-1"), i)
        self.automaton.make_automaton()

    def count(self, text: str) -> tuple[int, np.ndarray]:
        """Number of terms of a whole text, and how often each item term occurs."""
        data = b" " + text.encode().translate(_TO_TERMS) + b" "
        n, at, last = 0, 0, len(data) - 1
        tf = np.zeros(self.size, np.int64)
        while at < last:
            end = last if last - at <= PIECE else data.find(b" ", at + PIECE)
            piece = data[at:end + 1]
            n += len(piece.split())
            hits = [i for _, i in self.automaton.iter(piece.decode("latin-1"))]
            if hits:
                tf += np.bincount(hits, minlength=self.size)
            at = end
        return n, tf

    def score(self, tf: np.ndarray, weight: np.ndarray, m: int) -> np.ndarray:
        """Score of one document for every item, in 64-bit integers."""
        found = np.flatnonzero(tf)
        times = tf[found]
        worth = weight[found] * ((1_000_000_000 * times) // (1000 * times + 8 * m))
        first, n = self.term_start[found], self.term_start[found + 1] - self.term_start[found]
        flat = np.repeat(first - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        out = np.zeros(len(self.item_ids), np.int64)
        np.add.at(out, self.item[flat], np.repeat(worth, n) * self.times[flat])
        return out


class Best:
    """The ``top`` best documents of each item so far: highest score first, then smallest id, NULL ids last."""

    def __init__(self, items: int, top: int) -> None:
        self.top, self.least, self.waiting = top, np.ones(items, np.int64), 0
        self.item, self.score, self.doc, self.null = ([np.empty(0, np.int64)] for _ in range(4))

    def add(self, doc: int | None, scores: np.ndarray) -> None:
        item = np.flatnonzero(scores >= self.least)
        if len(item):
            self.item.append(item)
            self.score.append(scores[item])
            self.doc.append(np.full(len(item), doc or 0, np.int64))
            self.null.append(np.full(len(item), doc is None, np.int64))
            self.waiting += len(item)
            if self.waiting > 16 * self.top * len(self.least):
                self.trim()

    def trim(self) -> tuple[np.ndarray, ...]:
        cols = [np.concatenate(c) for c in (self.item, self.score, self.doc, self.null)]
        order = np.lexsort((cols[2], cols[3], -cols[1], cols[0]))
        item = cols[0][order]
        rank = np.arange(len(item)) - np.searchsorted(item, item)
        keep = order[rank < self.top]
        full = order[rank == self.top - 1]
        self.least[cols[0][full]] = cols[1][full]
        kept = tuple(c[keep] for c in cols)
        self.item, self.score, self.doc, self.null = ([c] for c in kept)
        self.waiting = 0
        return kept


def _block_ranks(texts: DataFrame, block: Block, top: int) -> DataFrame:
    """(item, item_id, doc_id, score): the best documents of every task."""
    spark = texts.sparkSession
    shared = spark.sparkContext.broadcast(block)

    def survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, n, total = shared.value, 0, 0
        df = np.zeros(own.size, np.int64)
        for batch in batches:
            for text in batch.column("_text"):
                length, tf = own.count(text.as_py())
                n, total = n + (length > 0), total + length
                df += tf > 0
        held = np.flatnonzero(df)
        yield pa.RecordBatch.from_pydict({"term": np.concatenate([[-1, -2], held]), "n": np.concatenate([[n, total], df[held]])})

    read = in_pieces(texts)
    known = dict(read.select("_text").mapInArrow(survey, "term long, n long").groupBy("term").agg(F.sum("n")).collect())
    docs, total = known.pop(-1, 0), known.pop(-2, 0)
    weight = np.zeros(block.size, np.int64)
    for term, df in known.items():
        weight[term] = math.floor(1000 * math.log((2 * docs + 2) / (2 * df + 1)))
    worth = spark.sparkContext.broadcast(weight)

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, best = shared.value, Best(len(shared.value.item_ids), top)
        for batch in batches:
            for doc, text in zip(batch.column("_doc"), batch.column("_text")):
                n, tf = own.count(text.as_py())
                if tf.any():
                    best.add(doc.as_py(), own.score(tf, worth.value, 25 + (75 * n * docs) // total))
        item, score, doc, null = best.trim()
        yield pa.RecordBatch.from_arrays([pa.array(item), pa.array([own.item_ids[i] for i in item], pa.int64()),
                                          pa.array(doc, mask=null.astype(bool)), pa.array(score)], ["item", "item_id", "doc_id", "score"])

    return read.mapInArrow(rank, "item long, item_id long, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, top: int = TOP, doc_id: str = "doc_id", text: str = "text",
           item_id: str = "item_id", item_text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` best documents of every row of ``items``.

    A document's score for an item is ``sum(w * (10^9 tf div (1000 tf + 8 m)))`` over the item's
    terms, repeats included, with ``w = floor(1000 ln((2 N + 2) / (2 df + 1)))`` and ``m = 25 + (75 n N) div L``:
    N documents with a term, L terms in all, n terms in the document, df documents with the term.
    Equal scores are ranked by id, NULL ids last; scores of 0 are left out.

    Ids are integers. NULL and empty texts have no terms and count for nothing. Every row of either
    table stands for itself: repeated documents take several ranks, repeated items (and NULL ids)
    give repeated lists. Long texts are scanned in pieces that end between terms. Empty tables give
    an empty result. Other columns, whatever their names, are ignored.

    An automaton holds about ``block_bytes`` of terms and ``BLOCK_ITEMS`` items. Where there are
    more, items are dealt into blocks, and each block scans the corpus on its own.
    """
    texts = docs.select(F.col(doc_id).cast("long").alias("_doc"), F.col(text).alias("_text")).where(F.col("_text").isNotNull())
    terms = stage(item_terms(items, item_id, item_text), "item-terms")
    held = terms.agg(F.sum(F.octet_length("term") + 2), F.countDistinct("_item")).first()
    blocks = max(1, -(-(held[0] or 0) // block_bytes), -(-held[1] // BLOCK_ITEMS))
    found = []
    for b in range(blocks):
        rows = terms.where(F.pmod(F.xxhash64("_item"), F.lit(blocks)) == b).collect()
        if rows:
            found.append(_block_ranks(texts, Block(rows), top).withColumn("block", F.lit(b)))
    discard(terms)
    if not found:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    order = W.partitionBy("block", "item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    best = reduce(DataFrame.unionByName, found).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return best.select("item_id", "rank", "doc_id", "score")
