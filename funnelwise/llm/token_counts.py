"""Token counts by byte-pair merging over a heap and a linked list, without making identifiers."""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
MEMO_ENTRIES = 1 << 19
_RUNS = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+$")


class MergeCounter:
    """Counts the pieces of a merge vocabulary with byte fallback.

    ranks: each piece's rank; lower ranks merge first, equal ranks from the left. A symbol that is no
    piece counts one for each of its UTF-8 bytes. Two characters that are neighbours in no piece can
    never merge, so a text is cut between them and each part counted alone and remembered; the memo
    only saves time and is emptied when it is full.
    """

    def __init__(self, ranks: dict[str, int]):
        self.ranks = ranks
        self.pairs = {p[i : i + 2] for p in ranks for i in range(len(p) - 1)}
        if any(pair[0] != SPACE and pair[1] == SPACE for pair in self.pairs):
            raise ValueError("a piece goes across the start of a word")
        self.words: dict[str, int] = {}
        self.parts: dict[str, int] = {}

    def merged(self, part: str) -> int:
        """Symbols left when no adjacent pair is a piece: initial symbols minus merges.

        The symbol at i is part[i:after[i]]; after[i] is 0 once it has been merged into another.
        """
        get, n = self.ranks.get, len(part)
        heap = [rank << 40 | i for i in range(n - 1) if (rank := get(part[i : i + 2])) is not None]
        after, before = list(range(1, n + 1)), list(range(-1, n))
        merges, heappop, heappush = 0, heapq.heappop, heapq.heappush
        heapq.heapify(heap)
        while heap:
            entry = heappop(heap)
            i = entry & 0xFF_FFFF_FFFF
            j = after[i]
            if not 0 < j < n or get(part[i : after[j]]) != entry >> 40:
                continue  # one of the two has been merged since
            k = after[i] = after[j]
            after[j] = 0
            merges += 1
            if k < n:
                before[k] = i
                if (rank := get(part[i : after[k]])) is not None:
                    heappush(heap, rank << 40 | i)
            if i and (rank := get(part[before[i] : k])) is not None:
                heappush(heap, rank << 40 | before[i])
        unknown = sum(len(c.encode()) - 1 for i, c in enumerate(part) if c not in self.ranks and after[i] == i + 1)
        return n - merges + unknown

    def part(self, part: str) -> int:
        count = self.parts.get(part)
        if count is None:
            count = self.merged(part)
            if len(self.parts) >= MEMO_ENTRIES:
                self.parts.clear()
            if len(part) < 100:
                self.parts[part] = count
        return count

    def run(self, run: str) -> int:
        """Tokens of a string that starts with its only spaces."""
        total, start, pairs = 0, 0, self.pairs
        for i in range(1, len(run)):
            if run[i - 1 : i + 1] not in pairs:
                total += self.part(run[start:i])
                start = i
        return total + self.part(run[start:])

    def word(self, word: str) -> int:
        count = self.words.get(word)
        if count is None:
            count = self.run(SPACE + word)
            if len(self.words) >= MEMO_ENTRIES:
                self.words.clear()
            if len(word) < 100:
                self.words[word] = count
        return count

    def count(self, text: str) -> int:
        """Tokens of a text to which the vocabulary's library adds one space in front."""
        if not text:
            return 0
        if SPACE in text:
            text = text.replace(SPACE, " ")
        if "  " in text or text[0] == " " or text[-1] == " ":
            return sum(map(self.run, _RUNS.findall(SPACE + text.replace(" ", SPACE))))
        return sum(map(self.word, text.split(" ")))


@lru_cache(maxsize=2)
def piece_counter(path: str) -> MergeCounter:
    """Counter for a sentencepiece model file, read once in each Python worker."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    probe = "  aéﬁ \t\n  b "
    if model.normalize(probe) != SPACE + probe.replace(" ", SPACE):
        raise ValueError("the model rewrites texts; only one added leading space is supported")
    plain = [i for i in range(model.vocab_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    if not any(model.is_byte(i) for i in range(model.vocab_size())):
        raise ValueError("the model has no byte pieces")
    scores = sorted({model.get_score(i) for i in plain}, reverse=True)
    rank = {score: k for k, score in enumerate(scores)}
    return MergeCounter({model.id_to_piece(i): rank[model.get_score(i)] for i in plain})


def count_tokens(docs: DataFrame, model_path: str, text: str = "text", ids: tuple[str, ...] = ("doc_id",), limit: int = 4096) -> DataFrame:
    """`ids`, n_bytes, n_tokens and over_limit of each document, as the model file's library counts tokens.

    Null texts count as empty and empty ones as 0 tokens; repeated rows each get a row; other columns
    are ignored. `model_path` must exist on every executor. One map pass.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = piece_counter(model_path)
        for batch in batches:
            counts = [counter.count(t or "") for t in batch.column(len(ids) + 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(ids) + 1], pa.array(counts, pa.int64())], names=[*ids, "n_bytes", "n_tokens"])

    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in ids)
    n_bytes = F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes")
    out = docs.select(*ids, n_bytes, F.col(text)).mapInArrow(run, f"{kinds}, n_bytes long, n_tokens long")
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
