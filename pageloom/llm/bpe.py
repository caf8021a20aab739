"""Token counts by heap-and-linked-list byte-pair merging.

The count of a piece is its number of byte symbols minus the number of merges. A heap holds the adjacent
pairs by rank, linked lists hold the neighbours, and no token identifier is ever made. Rules for cutting
a text into pieces and the merge ranks come from a tokenizer file whose path is a parameter; a file with
other cutting rules than the byte-level ones below is refused.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageloom.llm.common import Memo, hold_alone
from pageloom.llm.words import slices

#: Fixed value of byte-level tokenizers: how a text falls into pieces.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: No piece spans a white-space character that follows another kind of character, so a text whose only
#: white space is blanks and line feeds may be cut there, and equal parts of all texts counted once.
PARTS = re.compile(r"[ \n]*[^ \n]+|[ \n]+")
#: Anything the standard library or the tokenizer may take for other white space.
OTHER_SPACE = re.compile(r"[^\S \n]|[᠎​﻿]")


def byte_symbols() -> list[str]:
    """The character that stands for each byte in files of byte-level tokenizers: printable Latin-1
    characters stand for themselves, the others follow from 256 on."""
    kept = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in kept else chr(next(spare)) for b in range(256)]

#: Width of a symbol's number within one integer.
BITS = 24
SYMBOL = (1 << BITS) - 1


def byte_level(path: str) -> dict:
    """The content of a tokenizer file, if it cuts texts as this package does: byte-level pieces by the standard
    pattern, no normaliser, and no marks at the ends of words."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    cuts, model = spec.get("pre_tokenizer") or {}, spec["model"]
    plain = cuts.get("type") == "ByteLevel" and cuts.get("use_regex", True) and not cuts.get("add_prefix_space")
    odd = [k for k in ("continuing_subword_prefix", "end_of_word_suffix", "dropout", "ignore_merges") if model.get(k)]
    if model.get("type", "BPE") != "BPE" or spec.get("normalizer") or not plain or odd:
        raise ValueError(f"{path} is no byte-level pair tokenizer with the standard cutting rules")
    return spec


class MergeCounter:
    """Counts tokens of texts; one for each Python worker and tokenizer file."""

    def __init__(self, path: str, memo: int = 64 << 20):
        spec = byte_level(path)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        number = {symbol: b for b, symbol in enumerate(byte_symbols())}
        for rank, (a, b) in enumerate(pairs):
            number.setdefault(a + b, 256 + rank)
        #: (left, right), as one integer -> (rank, symbol after the merge), as one integer
        self.merges = {number[a] << BITS | number[b]: rank << BITS | number[a + b] for rank, (a, b) in enumerate(pairs)}
        self.pieces = regex.compile(PIECES)
        specials = [t["content"] for t in spec["added_tokens"]]
        self.special = re.compile("|".join(re.escape(s) for s in sorted(specials, key=len, reverse=True)) or r"(?!)")
        self.of_piece = Memo(self.count_piece, memo)
        self.of_part = Memo(self.count_part, memo)

    def count_piece(self, piece: str) -> int:
        """Symbols minus merges: pop the lowest-ranked adjacent pair, leftmost first, until none is left.

        A heap entry holds rank, merged symbol and place in one integer. A place that was merged away has
        no symbol (-1); an entry whose pair has changed since is passed over."""
        symbols = list(piece.encode("utf-8", "surrogatepass"))
        n = len(symbols)
        if n < 2:
            return n
        merges = self.merges
        width = n.bit_length()
        places = (1 << width) - 1
        heap = []
        left = symbols[0]
        for i in range(1, n):
            right = symbols[i]
            if (merge := merges.get(left << BITS | right)) is not None:
                heap.append(merge << width | i - 1)
            left = right
        heapify(heap)
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        count = n
        while heap:
            entry = heappop(heap)
            i = entry & places
            merge = entry >> width
            j = after[i]
            left = symbols[i]
            if left < 0 or j >= n or merges.get(left << BITS | symbols[j]) != merge:
                continue
            symbols[i] = left = merge & SYMBOL
            symbols[j] = -1
            count -= 1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (merge := merges.get(left << BITS | symbols[k])) is not None:
                    heappush(heap, merge << width | i)
            h = before[i]
            if h >= 0 and (merge := merges.get(symbols[h] << BITS | left)) is not None:
                heappush(heap, merge << width | h)
        return count

    def count_part(self, part: str) -> int:
        return sum(map(self.of_piece.__getitem__, self.pieces.findall(part)))

    def count(self, text: str) -> int:
        if self.special.search(text):
            plain = self.special.split(text)
            return len(plain) - 1 + sum(self.count_plain(x) for x in plain)
        return self.count_plain(text)

    def count_plain(self, text: str) -> int:
        if OTHER_SPACE.search(text):
            return self.count_part(text)
        return sum(map(self.of_part.__getitem__, PARTS.findall(text)))


@lru_cache(maxsize=4)
def counter(path: str) -> MergeCounter:
    return MergeCounter(path)


def token_counts(
    docs: DataFrame, tokenizer: str, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)``, one row per input row, without a shuffle.

    ``tokenizer`` is the path of a byte-level ``.json`` tokenizer, readable on every executor. A null text
    counts as empty: 0 bytes, 0 tokens. Null ids and repeated rows stay. Other columns are not read. An
    empty table gives an empty result. A text of any length is counted whole, texts of some MB one at a time. A special string of the tokenizer inside a text is one token."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold_alone("bpe", counter.cache_clear)
        tokens = counter(tokenizer).count
        for batch in batches:
            for part in slices(batch, 1):
                counts = pa.array([tokens(t) if t else 0 for t in part.column(1).to_pylist()], pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), counts], ["id", "n_bytes", "n_tokens"])

    rows = docs.select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"),
        F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(count, f"id {kind}, n_bytes long, n_tokens long").select(
        F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
