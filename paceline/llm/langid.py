"""Language identification by prediction by partial matching (PPM) over bytes.

Per language a variable-order context tree holds how often a symbol followed a context of up to
``ORDER`` symbols. A symbol that a context has not seen is reached by an escape to the context one
shorter (method C: a context with ``t`` symbols, ``d`` of them different, gives symbol ``s`` the
share ``n(s) / (t + d)`` and the escape ``d / (t + d)``; below order 0 all symbols are equal). The
statistics are frozen after learning, so every text gets an exact code length in bits under each
language, and the language with the shortest code wins.

Symbols are bytes of the lower-cased UTF-8 text: a to z, all bytes of other scripts, and one symbol
for any run of the rest.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paceline.llm.common import in_pieces

#: Symbols of context. A gram is a context and the symbol after it.
ORDER = 3
#: A gram counts when it makes up this share of its language, so a language has at most
#: ``1 / MIN_SHARE`` grams of each order however large the corpus: the model fits in memory.
MIN_SHARE = 4e-6

_SYMBOLS = 155
_TO_SYMBOL = bytes((b - 96) if 97 <= b <= 122 else (b - 101) if b >= 128 else 0 for b in range(256))
_PIECE = 1 << 18


def symbols(text: str | None) -> bytes:
    """Symbols of a whole text, led by a full context of separators; empty if the text has none but separators."""
    parts = [p for p in (text or "").lower().encode().translate(_TO_SYMBOL).split(b"\0") if p]
    return b"\0" * ORDER + b"\0".join(parts) + b"\0" if parts else b""


def grams(data: bytes) -> np.ndarray:
    """Code of the longest gram that ends at each symbol."""
    x = np.frombuffer(data, np.uint8).astype(np.int64)
    n = len(x) - ORDER
    out = x[:n].copy()
    for k in range(1, ORDER + 1):
        out *= _SYMBOLS
        out += x[k:n + k]
    return out


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


@dataclass
class ContextTrees:
    """Frozen code lengths: for each order, grams with their bits and contexts with their escape bits, by language."""

    labels: list[str] = field(default_factory=list)
    codes: list[np.ndarray] = field(default_factory=list)
    bits: list[np.ndarray] = field(default_factory=list)
    contexts: list[np.ndarray] = field(default_factory=list)
    escapes: list[np.ndarray] = field(default_factory=list)

    @classmethod
    def build(cls, counts: pd.DataFrame) -> ContextTrees:
        """From (label, size, code, n): ``size`` symbols of context, ``code`` of the gram."""
        out = cls(sorted(counts["label"].unique()))
        place = {name: i for i, name in enumerate(out.labels)}
        langs = len(out.labels)
        for k in range(ORDER + 1):
            part = counts[counts["size"] == k]
            code, lang = part["code"].to_numpy(np.int64), part["label"].map(place).to_numpy(np.int64)
            n = part["n"].to_numpy(float)
            known, row = np.unique(code, return_inverse=True)
            above, col = np.unique(code // _SYMBOLS, return_inverse=True)
            total, kinds = np.zeros((len(above), langs)), np.zeros((len(above), langs))
            np.add.at(total, (col, lang), n)
            np.add.at(kinds, (col, lang), 1.0)
            seen = total > 0
            mass = np.where(seen, total + kinds, 1.0)
            escape = np.where(seen, -np.log2(np.where(seen, kinds, 1.0) / mass), 0.0)
            # A language that has not seen the gram escapes; its cost below is the one of the shorter gram.
            below = out._below(known % _SYMBOLS ** k, k) if k else np.full((len(known), langs), np.log2(_SYMBOLS))
            cost = escape[np.searchsorted(above, known // _SYMBOLS)] + below
            cost[row, lang] = -np.log2(n / mass[col, lang])
            out.codes.append(known)
            out.bits.append(cost)
            out.contexts.append(above)
            out.escapes.append(escape)
        return out

    def _below(self, code: np.ndarray, orders: int) -> np.ndarray:
        """Bits by language of the last symbol of grams with fewer than ``orders`` symbols of context."""
        cost = np.zeros((len(code), len(self.labels)))
        open_ = np.arange(len(code))
        for k in range(orders - 1, -1, -1):
            want = code[open_] % _SYMBOLS ** (k + 1)
            at = _find(self.codes[k], want)
            hit = at >= 0
            cost[open_[hit]] += self.bits[k][at[hit]]
            open_, want = open_[~hit], want[~hit]
            ctx = _find(self.contexts[k], want // _SYMBOLS)
            cost[open_[ctx >= 0]] += self.escapes[k][ctx[ctx >= 0]]
        cost[open_] += np.log2(_SYMBOLS)
        return cost

    def total(self, data: bytes, index: Index | None = None) -> np.ndarray:
        """Code length in bits of a whole symbol string under each language."""
        index = index or Index(self)
        out = np.zeros(len(self.labels))
        for at in range(0, len(data) - ORDER, _PIECE):
            out += index.cost(grams(data[at:at + _PIECE + ORDER]))
        return out


def _find(keys: np.ndarray, want: np.ndarray) -> np.ndarray:
    """Positions of ``want`` in sorted ``keys``, -1 where absent."""
    if not len(keys):
        return np.full(len(want), -1)
    at = np.minimum(np.searchsorted(keys, want), len(keys) - 1)
    return np.where(keys[at] == want, at, -1)


class Index:
    """Hashed look-up of the longest grams; the few that are missing take the escape path."""

    def __init__(self, model: ContextTrees):
        self.model, self.longest = model, pd.Index(model.codes[ORDER])

    def cost(self, code: np.ndarray) -> np.ndarray:
        at = self.longest.get_indexer(code)
        hit = at >= 0
        times = np.bincount(at[hit], minlength=len(self.longest))
        used = np.flatnonzero(times)
        out = times[used] @ self.model.bits[ORDER][used]
        if not hit.all():
            rest = code[~hit]
            ctx = _find(self.model.contexts[ORDER], rest // _SYMBOLS)
            out = out + self.model.escapes[ORDER][ctx[ctx >= 0]].sum(0) + self.model._below(rest % _SYMBOLS ** ORDER, ORDER).sum(0)
        return out


def learn(df: DataFrame, text: str, label: str, min_share: float = MIN_SHARE) -> ContextTrees:
    """Count the grams of all rows with a text and a label, and freeze the trees.

    Every row is counted, in one pass with one aggregation; only grams above ``min_share`` of their
    language come to the driver. No usable row gives a model without languages.
    """
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, list] = {}
        size = 0

        def flush():
            for name, parts in held.items():
                code = np.concatenate([p[0] for p in parts])
                kinds, row = np.unique(code, return_inverse=True)
                yield pd.DataFrame({"label": name, "code": kinds,
                                    "n": np.bincount(row, np.concatenate([p[1] for p in parts])).astype(np.int64)})
            held.clear()

        for pdf in batches:
            for name, own in pdf.groupby("label")["text"]:
                data = [s for s in map(symbols, own) if s]
                # One text at a time may be huge; many short ones are counted together.
                buffer, waiting = [], 0
                for s in data + [b""]:
                    if buffer and (not s or waiting + len(s) > 4 * _PIECE):
                        kinds, n = np.unique(np.concatenate([grams(b) for b in buffer]), return_counts=True)
                        held.setdefault(name, []).append((kinds, n))
                        size += len(kinds)
                        buffer, waiting = [], 0
                    buffer.append(s)
                    waiting += len(s)
            if size > 2_000_000:
                yield from flush()
                size = 0
        yield from flush()

    rows = in_pieces(df.where(F.col(text).isNotNull() & F.col(label).isNotNull())
                     .select(F.col(label).cast("string").alias("label"), F.col(text).alias("text")))
    longest = rows.mapInPandas(count, "label string, code long, n long").groupBy("label", "code").agg(F.sum("n").alias("n"))
    longest = longest.persist()
    total = longest.groupBy("label").agg(F.sum("n").alias("total"))
    sizes = F.explode(F.array(*[F.struct(F.lit(k).alias("size"), (F.col("code") % _SYMBOLS ** (k + 1)).alias("code"))
                                for k in range(ORDER + 1)]))
    every = (longest.select("label", "n", sizes.alias("g")).groupBy("label", "g.size", "g.code").agg(F.sum("n").alias("n"))
             .join(total, "label").where(F.col("n") >= F.col("total") * min_share).select("label", "size", "code", "n"))
    counts = every.toPandas()
    longest.unpersist()
    return ContextTrees.build(counts.sort_values(["label", "size", "code"], ignore_index=True))


def predict(model: ContextTrees, spark, text: Column) -> Column:
    """Struct (lang_pred, score) of a whole text.

    ``score`` is the share of the best language when each language weighs 2 to the power of minus
    its code length. NULL texts, texts without a letter, and any text under a model without
    languages give ``und`` and 0. Texts in letters that only other scripts use are still assigned.
    """
    shared = spark.sparkContext.broadcast(model)

    def one(value: str | None, model: ContextTrees, index: Index) -> tuple[str, float]:
        if not model.labels or not has_letter(value):
            return "und", 0.0
        bits = model.total(symbols(value), index)
        best = int(bits.argmin())
        return model.labels[best], float(1 / np.exp2(np.maximum(bits[best] - bits, -1000)).sum())

    @F.pandas_udf(T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]))
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = shared.value
        index = Index(model) if model.labels else None
        for texts in batches:
            yield pd.DataFrame([one(t, model, index) for t in texts], columns=["lang_pred", "score"])

    return run(text)


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """True for ids whose CRC-32 as text is divisible by ``folds``; a NULL id is held out."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % folds == 0


def identify(docs: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "lang") -> DataFrame:
    """Append held_out, lang_pred and score; the model learns from the labelled rows that are not held out.

    Columns of these names in the input are replaced. An empty table gives an empty result; repeated
    rows are predicted alike and counted as often as they occur.
    """
    docs = docs.withColumn("held_out", held_out(F.col(id_col)))
    model = learn(docs.where(~F.col("held_out")), text, label)
    said = in_pieces(docs).withColumn("_said", predict(model, docs.sparkSession, F.col(text)))
    return said.withColumns({"lang_pred": F.col("_said.lang_pred"), "score": F.col("_said.score")}).drop("_said")
