"""Language identification by prediction by partial matching over bytes.

Each language has a context tree of orders 0 to `order`. A byte's code length in a context is that of
its share of the context's count (method C: count / (total + distinct)); a byte the context has not
seen costs the escape distinct / (total + distinct) and is coded in the next shorter context; below
order 0 every byte costs 8 bits. Contexts without statistics cost nothing to leave. The statistics are frozen
after fitting, so the code lengths of every (context, byte) seen in any language are tabulated once, as
a vector over languages, in fixed-point numbers whose sums do not depend on the order of addition.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .text import _LOWER, Chunk, chunks

SCALE = 1 << 12
UNKNOWN = "und"
_EMPTY = np.uint64(0xFFFF_FFFF_FFFF_FFFF)
#: Slices of a language whose rows are ranked together, step by step; each number divides the one before.
SLICES = (4096, 64, 8, 1)


class KeyTable:
    """Row of each 64-bit key in a half-empty hash table with linear probing."""

    def __init__(self, keys: np.ndarray):
        bits = max(4, int(4 * len(keys)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, _EMPTY, np.uint64)
        self.rows = np.full(1 << bits, -1, np.int32)
        slot, left = self._slots(keys), np.arange(len(keys))
        while len(left):
            free = np.flatnonzero(self.keys[slot] == _EMPTY)
            taken, first = np.unique(slot[free], return_index=True)
            at = free[first]
            self.keys[taken], self.rows[taken] = keys[left[at]], left[at]
            rest = np.ones(len(left), bool)
            rest[at] = False
            left, slot = left[rest], (slot[rest] + 1) & self.mask

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Row of each key, -1 where it is absent."""
        slot = self._slots(keys)
        held = self.keys[slot]
        rows = np.where(held == keys, self.rows[slot], -1)
        open_ = np.flatnonzero((held != keys) & (held != _EMPTY))
        slot = slot[open_]
        while len(open_):
            slot = (slot + 1) & self.mask
            held = self.keys[slot]
            hit = held == keys[open_]
            rows[open_[hit]] = self.rows[slot[hit]]
            more = ~hit & (held != _EMPTY)
            open_, slot = open_[more], slot[more]
        return rows


@dataclass
class ContextModel:
    """Code lengths of all languages. Per order: bytes seen in a context, and the cost to leave a context."""

    languages: list[str]
    seen: list[tuple[KeyTable, np.ndarray]]
    escapes: list[tuple[KeyTable, np.ndarray]]

    def code_lengths(self, chunk: Chunk) -> np.ndarray:
        """Code length of each row in each language, in bits times SCALE."""
        order, totals = len(self.seen) - 1, np.zeros((chunk.rows, len(self.languages)), np.int64)
        if not len(chunk.data):
            return totals
        keys, at = grams(chunk, order)
        cost = np.zeros((len(at), len(self.languages)), np.int32)
        left = np.arange(len(at))
        for k in range(order, -1, -1):
            own = keys[left] & np.uint64((1 << 8 * (k + 1)) - 1)
            table, lengths = self.seen[k]
            row = table.find(own)
            hit = row >= 0
            if len(left) == len(at):
                cost = lengths.take(np.maximum(row, 0), axis=0)
                cost[~hit] = 0
            else:
                cost[left[hit]] += lengths[row[hit]]
            left, own = left[~hit], own[~hit]
            table, lengths = self.escapes[k]
            row = table.find(own >> np.uint64(8))
            cost[left[row >= 0]] += lengths[row[row >= 0]]
        cost[left] += 8 * SCALE
        full = np.flatnonzero(np.diff(chunk.row_at) > 0)
        totals[full] = np.add.reduceat(cost, chunk.row_at[full], axis=0, dtype=np.int64)
        return totals


def grams(chunk: Chunk, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Each byte with the `order` bytes before it as one number; a text is taken to follow line breaks."""
    row = np.repeat(np.arange(chunk.rows), np.diff(chunk.row_at))
    at = np.arange(len(chunk.data)) + order * (row + 1)
    padded = np.full(len(chunk.data) + order * chunk.rows + order, 10, np.uint64)
    padded[at] = _LOWER[chunk.data]
    keys = np.zeros(len(at), np.uint64)
    for back in range(order, -1, -1):
        keys = keys << np.uint64(8) | padded[at - back]
    return keys, at


def fit_contexts(samples: dict[str, list[str]], order: int = 4) -> ContextModel:
    """Context trees from the sample texts of each language."""
    languages = sorted(samples)
    keys = [np.concatenate([np.zeros(0, np.uint64), *(grams(c, order)[0] for c in chunks(pa.array(samples[l], pa.large_string())))]) for l in languages]
    seen, escapes, shorter = [], [], None
    for k in range(order + 1):
        own = [np.unique(x & np.uint64((1 << 8 * (k + 1)) - 1), return_counts=True) for x in keys]
        union = np.unique(np.concatenate([u for u, _ in own])) if own else np.zeros(0, np.uint64)
        counts = np.zeros((len(union), len(languages)))
        for l, (u, c) in enumerate(own):
            counts[np.searchsorted(union, u), l] = c
        contexts, context = np.unique(union >> np.uint64(8), return_inverse=True)
        total, distinct = np.zeros((2, len(contexts), len(languages)))
        np.add.at(total, context, counts)
        np.add.at(distinct, context, counts > 0)
        leave = np.log2(np.maximum(total + distinct, 1) / np.maximum(distinct, 1))
        if shorter is None:
            below = np.full(counts.shape, 8.0)
        else:
            below = shorter[1][np.searchsorted(shorter[0], union & np.uint64((1 << 8 * k) - 1))]
        share = np.log2(np.maximum((total + distinct)[context], 1) / np.maximum(counts, 1))
        lengths = np.where(counts > 0, share, leave[context] + below)
        shorter = union, lengths
        seen.append((KeyTable(union), np.rint(lengths * SCALE).astype(np.int32)))
        escapes.append((KeyTable(contexts), np.rint(leave * SCALE).astype(np.int32)))
    return ContextModel(languages, seen, escapes)


def language_samples(docs: DataFrame, text: str, lang: str, key: str, rows: int, size: int) -> dict[str, list[str]]:
    """At most `rows` texts of each language, of smallest key hash, until they reach `size` bytes; copies of a key and text are one.

    Texts are whole, but the last is cut to as many characters as bytes are left. Keys may be null or repeated.
    """
    content = F.xxhash64(F.col(text))
    labelled = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull())
    one = labelled.select(F.col(key).alias("__key"), F.col(lang).alias("__lang"), content.alias("__content"), F.octet_length(text).alias("__bytes")).distinct()
    order = [F.xxhash64("__key"), "__key", "__content"]
    # the first of fewer and fewer slices, so that no task ranks what all tasks send for a language
    first, mixed = one, F.xxhash64("__content", "__key")
    for slices in SLICES:
        in_slice = Window.partitionBy("__lang", F.pmod(mixed, F.lit(slices))).orderBy(*order)
        first = first.withColumn("__rank", F.row_number().over(in_slice)).filter(F.col("__rank") <= rows)
    by_hash = Window.partitionBy("__lang").orderBy(*order)
    before = F.sum("__bytes").over(by_hash.rowsBetween(Window.unboundedPreceding, -1))
    picked = first.withColumn("__before", F.coalesce(before, F.lit(0))).filter(F.col("__before") < size).select("__key", "__lang", "__content", (F.lit(size) - F.col("__before")).cast("int").alias("__left"))
    same = F.col(key).eqNullSafe(F.col("__key")) & (F.col(lang) == F.col("__lang")) & (content == F.col("__content"))
    found = labelled.select(lang, text, key).join(F.broadcast(picked), same).select("__key", "__lang", "__content", F.substring(F.col(text), F.lit(1), F.col("__left")).alias("__text"))
    samples: dict[str, list[str]] = {}
    for l, t in sorted((r["__lang"], r["__text"]) for r in found.dropDuplicates(["__key", "__lang", "__content"]).collect()):
        samples.setdefault(l, []).append(t)
    return samples


def learn_languages(
    docs: DataFrame, learn_from: Column | None = None, text: str = "text", lang: str = "lang", key: str = "doc_id", order: int = 4, sample_rows: int = 400, sample_bytes: int = 2_000_000
) -> Broadcast[ContextModel]:
    """The model of a bounded sample of the rows with text and language for which `learn_from` holds, see language_samples. It is sent once for all uses."""
    train = docs if learn_from is None else docs.filter(learn_from)
    return docs.sparkSession.sparkContext.broadcast(fit_contexts(language_samples(train, text, lang, key, sample_rows, sample_bytes), order))


def score_languages(docs: DataFrame, shared: Broadcast[ContextModel], text: str = "text") -> DataFrame:
    """All columns of `docs` with lang_pred, score and bits_per_byte under a learned model, see identify_language. One map pass."""
    ours = docs.drop("lang_pred", "score", "bits_per_byte")
    if not shared.value.languages:
        return ours.withColumns({"lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0), "bits_per_byte": F.lit(None).cast("double")})
    names = ours.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for chunk in chunks(batch.column(len(names))):
                own = [c.slice(chunk.first_row, chunk.rows) for c in batch.columns]
                lettered = own.pop().is_valid().to_numpy(zero_copy_only=False)
                bits = model.code_lengths(chunk) / SCALE
                best = bits.argmin(axis=1)
                least = bits[np.arange(len(bits)), best]
                score = 1 / np.exp2(np.maximum(least[:, None] - bits, -1000)).sum(axis=1)
                rate = least / np.maximum(np.diff(chunk.row_at), 1)
                label = np.where(lettered, np.array(model.languages, object)[best], UNKNOWN)
                own += [pa.array(label, pa.string()), pa.array(np.where(lettered, score, 0.0)), pa.array(rate, mask=~lettered)]
                yield pa.RecordBatch.from_arrays(own, names=[*names, "lang_pred", "score", "bits_per_byte"])

    scored = F.when(F.col(text).rlike(r"\p{L}"), F.col(text)).alias("__scored")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ours.schema.fields)
    return ours.select("*", scored).mapInArrow(run, f"{kinds}, lang_pred string, score double, bits_per_byte double")


def language_limits(scored: DataFrame, text: str = "text", usual: float = 0.99, times: float = 1.5, high: float = 0.999) -> DataFrame:
    """(lang_pred, limit_rate, limit_bits), one row for each language: how far code lengths of its texts go.

    `scored` has texts that the model has not learned from, with lang_pred and bits_per_byte. limit_rate is `times` the quantile `usual` of
    bits a byte; limit_bits is the quantile `high` of the bits in all above that rate, 0 at least: short texts with a long
    name or number in them exceed it. Quantiles are approximate, from mergeable summaries.
    """
    quantile = lambda c, q: F.percentile_approx(c, F.lit(q), F.lit(10_000))
    sized = scored.filter("bits_per_byte IS NOT NULL").select("lang_pred", "bits_per_byte", F.octet_length(text).alias("n"))
    rates = sized.groupBy("lang_pred").agg((times * quantile("bits_per_byte", usual)).alias("limit_rate"))
    above = (F.col("bits_per_byte") - F.col("limit_rate")) * F.col("n")
    return sized.join(F.broadcast(rates), "lang_pred").groupBy("lang_pred").agg(F.first("limit_rate").alias("limit_rate"), F.greatest(quantile(above, high), F.lit(0.0)).alias("limit_bits"))


def identify_language(
    docs: DataFrame,
    learn_from: Column | None = None,
    text: str = "text",
    lang: str = "lang",
    key: str = "doc_id",
    order: int = 4,
    sample_rows: int = 400,
    sample_bytes: int = 2_000_000,
) -> DataFrame:
    """All columns of `docs` with lang_pred, score and bits_per_byte.

    Learns from a bounded sample of the rows with text and language for which `learn_from` holds:
    `sample_rows` texts of each language, fewer once they pass `sample_bytes`. lang_pred is the language of least code length (the first by
    name on ties); score its probability against the others if all are as likely before; bits_per_byte
    its code length. A null text, a text without a letter, and any text when nothing could be learned
    give `und`, score 0 and null bits_per_byte. Each row is judged for itself, so repeated rows agree.
    """
    ours = docs.drop("lang_pred", "score", "bits_per_byte")
    return score_languages(ours, learn_languages(ours, learn_from, text, lang, key, order, sample_rows, sample_bytes), text)
