"""Packing tokenized examples into sequences by vector bin packing.

Each sequence has limits on tokens, segments and loss-bearing tokens. Examples longer than a sequence are cut
into full sequences and a rest; the rests are packed in groups of bounded size by the dot-product heuristic.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import keep

END_ID = 1
GROUP_PIECES = 4096


@dataclass(frozen=True)
class SequenceLimits:
    tokens: int = 2048
    segments: int = 256
    loss_tokens: int = 2048


class BytePairIds:
    """Ids of a `tokenizers` file; texts of plain Latin characters go through the same ranks in tiktoken.

    On other texts, and those that may hold a special token's string, the two libraries could differ,
    so these go to `tokenizers` itself.
    """

    PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
    UNUSUAL = re.compile("[^\t\n\r\x20-\x7e¡-ɏ]|<\\|")

    def __init__(self, json_path: str, ranks_path: str | None):
        from tokenizers import Tokenizer

        self.exact, self.fast = Tokenizer.from_file(json_path), None
        if ranks_path:
            import tiktoken

            with open(ranks_path, "rb") as lines:
                ranks = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}
            self.fast = tiktoken.Encoding("ranks", pat_str=self.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> np.ndarray:
        if self.fast is None or self.UNUSUAL.search(text):
            return np.array(self.exact.encode(text, add_special_tokens=False).ids, np.uint32)
        return self.fast.encode_to_numpy(text, disallowed_special=())


@lru_cache(maxsize=2)
def tokenizer(json_path: str, ranks_path: str | None) -> BytePairIds:
    """The tokenizer of two files, read once in each Python worker."""
    return BytePairIds(json_path, ranks_path)


def token_pieces(docs: DataFrame, json_path: str, ranks_path: str | None = None, text: str = "text", key: str = "doc_id", limit: int = 2048) -> DataFrame:
    """(key, start, length, ids_crc32, doc_tokens): each text's ids and an end id, cut every `limit` ids.

    Null texts are empty: their only id is the end. Repeated rows each give their pieces. One map pass;
    ids never leave their task.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokenizer(json_path, ranks_path)
        for batch in batches:
            row, start, length, crc, total = [], [], [], [], []
            for i, value in enumerate(batch.column(1)):
                ids = np.append(encoder.ids(value.as_py() or ""), np.uint32(END_ID)).astype("<u4")
                for at in range(0, len(ids), limit):
                    piece = ids[at : at + limit]
                    row.append(i)
                    start.append(at)
                    length.append(len(piece))
                    crc.append(zlib.crc32(piece.tobytes()))
                    total.append(len(ids))
            longs = [pa.array(v, pa.int64()) for v in (start, length, crc, total)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row, pa.int32())), *longs], names=[key, "start", "length", "ids_crc32", "doc_tokens"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, start long, length long, ids_crc32 long, doc_tokens long")


def fill_sequences(tokens: np.ndarray, loss: np.ndarray, limits: SequenceLimits) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each example, by the dot-product heuristic.

    Sequences are filled one after another: of the examples that fit, the one whose demand has the
    largest dot product with what is left of the limits goes in. Each limit is weighted by the mean
    demand on it. Equal examples count as one kind, so a step looks at kinds only.
    """
    most = np.array([limits.tokens, limits.segments, limits.loss_tokens], float)
    if len(tokens) and (tokens.max() > limits.tokens or loss.max() > limits.loss_tokens):
        raise ValueError("an example exceeds the limits of a sequence")
    kinds, kind = np.unique(np.stack([tokens, loss], axis=1), axis=0, return_inverse=True)
    left = np.bincount(kind, minlength=len(kinds))
    demand = np.stack([kinds[:, 0], np.ones(len(kinds)), kinds[:, 1]], axis=1) / most
    worth = demand * (left @ demand / max(1, len(tokens)))
    members = np.argsort(kind, kind="stable")
    nxt = np.concatenate([[0], np.cumsum(left)])[:-1]
    sequence, offset = np.empty(len(tokens), np.int64), np.empty(len(tokens), np.int64)
    placed, number = 0, 0
    open_, at = np.ones(3), 0
    while placed < len(tokens):
        fits = np.flatnonzero((left > 0) & (demand <= open_ + 1e-9).all(axis=1))
        if not len(fits):
            number, open_, at = number + 1, np.ones(3), 0
            continue
        best = fits[np.argmax(worth[fits] @ open_)]
        item = members[nxt[best]]
        nxt[best] += 1
        left[best] -= 1
        sequence[item], offset[item] = number, at
        at += int(kinds[best, 0])
        open_ = open_ - demand[best]
        placed += 1
    return sequence, offset


def pack_sequences(pieces: DataFrame, limits: SequenceLimits = SequenceLimits(), loss: str = "length", key: str = "doc_id", group_pieces: int = GROUP_PIECES) -> DataFrame:
    """All columns of `pieces` with sequence_id and offset.

    `loss` names the column of loss-bearing tokens. Pieces are dealt to groups of about `group_pieces`
    by a hash of all their columns and, where rows are equal, of their number among these; each group is packed alone, so no task
    grows with the table or with the rows of one key. Sequence ids are unique over
    the groups. Offsets of a sequence have no gaps. The same pieces give the same packing; repeated rows each have a
    place; an empty table gives an empty one. `pieces` is read twice: pass a table.
    """
    groups = max(1, -(-pieces.count() // group_pieces))
    names = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    equal = pieces.select(*names).groupBy(*names).agg(F.count("*").alias("__n"))
    upto = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), n))
    split = equal.withColumn("__run", upto(F.floor((F.col("__n") - 1) / group_pieces)))
    split = split.withColumn("__copy", upto(F.least(F.lit(group_pieces), F.col("__n") - F.col("__run") * group_pieces) - 1))
    dealt = split.withColumn("__group", F.pmod(F.xxhash64(*names, "__run", "__copy"), F.lit(groups))).select(*names, "__group")

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", key, "start", *[c for c in names if c not in ("length", key, "start")]], ascending=False, ignore_index=True)
        sequence, offset = fill_sequences(rows["length"].to_numpy(), rows[loss].to_numpy(), limits)
        rows["sequence_id"], rows["offset"] = rows["__group"] * (1 << 32) + sequence, offset
        return rows.drop(columns="__group")

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.select(*names).schema.fields)
    return dealt.groupBy("__group").applyInPandas(run, f"{kinds}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, json_path: str, ranks_path: str | None = None, text: str = "text", key: str = "doc_id", limits: SequenceLimits = SequenceLimits()) -> DataFrame:
    """Tokenize, cut and pack documents: (key, start, length, ids_crc32, doc_tokens, sequence_id, offset).

    Every token of a document bears loss, so a piece has at most the smaller of the two token limits.
    """
    pieces = token_pieces(docs, json_path, ranks_path, text, key, min(limits.tokens, limits.loss_tokens))
    return pack_sequences(keep(pieces), limits, key=key)
