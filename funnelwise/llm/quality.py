"""Quality rules on repetition: how much of a text lies in word n-grams and lines that it repeats."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import Chunk, by_row, chunks, group_by_row, span_hashes

SYMBOLS = "#*$%&|<>"
_IS_SYMBOL = np.isin(np.arange(256), list(SYMBOLS.encode()))


@dataclass(frozen=True)
class RepetitionRules:
    """Limits of a text's repetition. ngram_limits: lengths over 3, each with the largest share of word characters inside repeated n-grams."""

    min_words: int = 50
    max_repeat_words: float = 0.50
    ngram_limits: tuple[tuple[int, float], ...] = ((5, 0.25), (7, 0.22), (10, 0.20))
    max_line_chars: float = 0.25
    max_symbols_per_word: float = 0.3


def repeated_grams(chunk: Chunk, hashes: np.ndarray, n: int, shorter: tuple[np.ndarray, int] | None = None) -> np.ndarray:
    """Whether the n-gram starting at each word occurs twice or more in its row.

    shorter: the same for a smaller length, 3 or more, and that length; an n-gram can only repeat where all of those inside it do.
    """
    start, grams = chunk.windows(hashes, n)
    if shorter is not None:
        single = np.concatenate([[0], np.cumsum(~shorter[0])])
        possible = single[start + n - shorter[1] + 1] == single[start]
        start, grams = start[possible], grams[possible]
    rows = chunk.word_row[start]
    order = group_by_row(grams, rows)
    same = (grams[order][1:] == grams[order][:-1]) & (rows[order][1:] == rows[order][:-1])
    twice = np.zeros(len(start), bool)
    twice[1:] |= same
    twice[:-1] |= same
    out = np.zeros(len(hashes), bool)
    out[start[order[twice]]] = True
    return out


def covered(begins: np.ndarray, n: int) -> np.ndarray:
    """Whether each word lies in an n-gram that starts where `begins` is set."""
    depth = np.zeros(len(begins) + 1, np.int32)
    at = np.flatnonzero(begins)
    depth[at] += 1
    depth[at + n] -= 1
    return np.cumsum(depth[:-1]) > 0


def repeated_lines(chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Lines equal to an earlier one of their row, and the characters in those lines, per row."""
    breaks = np.flatnonzero(chunk.data == 10)
    start = np.union1d(chunk.row_at[:-1], breaks + 1)
    start = start[start < len(chunk.data)]
    row = np.searchsorted(chunk.row_at, start, "right") - 1
    next_break = np.append(breaks, len(chunk.data))[np.searchsorted(breaks, start)]
    end = np.minimum(next_break, chunk.row_at[row + 1])
    with_word = np.diff(np.searchsorted(chunk.spans[0], np.stack([start, end]), "left"), axis=0)[0] > 0
    start, end, row = start[with_word], end[with_word], row[with_word]
    hashes = span_hashes(chunk.data, start, end)
    order = group_by_row(hashes, row)
    again = np.zeros(len(start), bool)
    again[order[1:]] = (hashes[order][1:] == hashes[order][:-1]) & (row[order][1:] == row[order][:-1])
    chars = chunk.points[end] - chunk.points[start]
    return np.bincount(row[again], minlength=chunk.rows), np.bincount(row[again], chars[again], chunk.rows).astype(np.int64)


def measure(chunk: Chunk, rules: RepetitionRules) -> dict[str, np.ndarray]:
    """The measures and the verdict of each row of a chunk."""
    start, end = chunk.spans
    chars = chunk.points[end] - chunk.points[start]
    hashes = chunk.word_hashes()
    n_words, word_chars = chunk.n_words, by_row(chars, chunk.word_at)
    symbols = np.concatenate([[0], np.cumsum(_IS_SYMBOL[chunk.data])])
    dup_lines, dup_line_chars = repeated_lines(chunk)
    triples = repeated_grams(chunk, hashes, 3)
    out = {
        "n_words": n_words,
        "word_chars": word_chars,
        "n_symbols": np.diff(symbols[chunk.row_at]),
        "n_dup_lines": dup_lines,
        "n_repeat_words": by_row(covered(triples, 3).astype(np.int64), chunk.word_at),
        "dup_line_chars": dup_line_chars,
    }
    out["base_failed"] = (n_words < rules.min_words) | (100 * out["n_repeat_words"] > 100 * rules.max_repeat_words * n_words)
    worst = out["n_symbols"] / np.maximum(n_words, 1) / rules.max_symbols_per_word
    for n, limit in rules.ngram_limits:
        inside = covered(repeated_grams(chunk, hashes, n, (triples, 3)), n)
        out[f"chars_repeated_{n}"] = by_row(np.where(inside, chars, 0), chunk.word_at)
        worst = np.maximum(worst, out[f"chars_repeated_{n}"] / np.maximum(word_chars, 1) / limit)
    all_chars = np.diff(chunk.points[chunk.row_at])
    worst = np.maximum(worst, dup_line_chars / np.maximum(all_chars, 1) / rules.max_line_chars)
    return out | {"repetition": worst, "kept": ~out["base_failed"] & (worst <= 1)}


def repetition_quality(docs: DataFrame, text: str = "text", ids: tuple[str, ...] = ("doc_id",), rules: RepetitionRules = RepetitionRules()) -> DataFrame:
    """Repetition measures and verdict of each document: `ids`, the measures, base_failed, repetition, kept.

    `repetition` is the largest measure divided by its limit. Null and empty texts have zeros and fail
    min_words; repeated rows are measured each for itself; other columns are ignored. One map pass.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column(len(ids))):
                own = [c.slice(chunk.first_row, chunk.rows) for c in batch.columns[: len(ids)]]
                found = measure(chunk, rules)
                yield pa.RecordBatch.from_arrays(own + [pa.array(v) for v in found.values()], names=[*ids, *found])

    measures = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, dup_line_chars long, base_failed boolean"
    grams = "".join(f", chars_repeated_{n} long" for n, _ in rules.ngram_limits)
    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in ids)
    return docs.select(*ids, F.col(text)).mapInArrow(run, f"{kinds}, {measures}{grams}, repetition double, kept boolean")
