"""Token counting, truncation and overlapping windows.

Two tokenizers: ``word`` is a lossless SQL split (each token carries the blanks before it), ``bpe``
Arrow UDFs over a local byte-pair vocabulary, which hand on counts, leads and windows, never single tokens.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageloom.functions.sql import once

WORD_TOKEN = r"(?U)\s*\S+"
VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Characters of text whose windows a worker holds before they are handed on.
RUN = 1_000_000


def word_tokens(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(WORD_TOKEN), F.lit(0))


@lru_cache(1)
def _encoding(vocabulary: str):
    """Built once per worker. ``encode_ordinary`` is used so that text
    which happens to hold special-token strings is data and not an error."""
    import public_tokenizers
    import tiktoken
    from tiktoken.load import load_tiktoken_bpe

    ranks = load_tiktoken_bpe(public_tokenizers.path(vocabulary))
    return tiktoken.Encoding(vocabulary, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def _bpe_pieces(text: str, enc) -> list[str]:
    """Token strings whose concatenation is the text. A cut inside a character moves to the end of
    that character, so a token may come out empty but no piece is ever broken."""
    pieces, held = [], b""
    for token in enc.encode_ordinary(text):
        held += enc.decode_single_token_bytes(token)
        try:
            pieces.append(held.decode("utf-8"))
            held = b""
        except UnicodeDecodeError:
            pieces.append("")
    return pieces


@lru_cache(1)
def _token_bytes(vocabulary: str) -> np.ndarray:
    """UTF-8 bytes of each token."""
    enc = _encoding(vocabulary)
    sizes = np.zeros(enc.max_token_value + 1, np.int64)
    for token, number in enc._mergeable_ranks.items():
        sizes[number] = len(token)
    return sizes


def _bpe_edges(text: str, vocabulary: str) -> np.ndarray:
    """Character places of the token edges, from 0 to the text's length; the text between two of them is the
    token string of ``_bpe_pieces``. An edge inside a character stays at the edge before it."""
    data = np.frombuffer(text.encode(), np.uint8)
    begins = np.append((data & 0xC0) != 0x80, True)
    before = np.concatenate(([0], np.cumsum(begins[:-1])))
    sizes = _token_bytes(vocabulary)[np.array(_encoding(vocabulary).encode_ordinary(text), np.int64)]
    edges = np.concatenate(([0], np.cumsum(sizes)))
    return np.maximum.accumulate(np.where(begins[edges], before[edges], 0))


def _runs(most: int, *columns: pa.Array) -> Iterator[tuple[list, ...]]:
    """The columns as lists, in runs of rows whose first column, texts, has about ``most`` characters."""
    sizes = pc.fill_null(pc.binary_length(columns[0]), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64) // most
    cuts = [0, *(np.flatnonzero(np.diff(ends)) + 1).tolist(), len(sizes)]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield tuple(c.slice(a, b - a).to_pylist() for c in columns)


_WINDOW = pa.struct([("window", pa.int32()), ("text", pa.string()), ("n", pa.int64()), ("start", pa.int32()), ("end", pa.int32())])


def bpe_windows(c: Column, size: int, overlap: int, whole: Column | None = None, vocabulary: str = VOCABULARY) -> Column:
    """The array of ``windows_of`` over byte-pair tokens, made where the tokens are. A text that is ``whole`` is one
    entry without a window number, with all its tokens counted; a null text has no array."""
    step = step_of(size, overlap)

    @F.arrow_udf("array<struct<window: int, text: string, n: bigint, start: int, end: int>>")
    def cut(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        def entries(text: str | None, one: bool | None) -> list[dict] | None:
            if text is None:
                return None
            at = _bpe_edges(text, vocabulary)
            n = len(at) - 1
            if one:
                return [{"window": None, "text": text, "n": n, "start": 0, "end": len(text)}]
            firsts = range(0, max(0, -(-(n - size) // step)) * step + 1, step)
            return [
                {"window": i, "text": text[at[a] : at[min(n, a + size)]], "n": min(n, a + size) - a, "start": at[a], "end": at[min(n, a + size)]}
                for i, a in enumerate(firsts)
            ]

        for texts, ones in batches:
            for run in _runs(RUN, texts, ones):
                yield pa.array([entries(text, one) for text, one in zip(*run)], pa.list_(_WINDOW))

    return cut(c, F.lit(False) if whole is None else whole)


def bpe_counts_and_lead(texts: Column, c: Column, n: int, vocabulary: str = VOCABULARY) -> Column:
    """``(counts, lead)``: token counts of an array of texts, and ``truncate`` of another text, in one worker."""

    @F.arrow_udf("struct<counts: array<bigint>, lead: string>")
    def measure(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        enc = _encoding(vocabulary)
        kind = pa.struct([("counts", pa.list_(pa.int64())), ("lead", pa.string())])

        def lead(text: str | None) -> str | None:
            if text is None:
                return None
            at = _bpe_edges(text, vocabulary)
            return text if len(at) - 1 <= n else text[: at[n]]

        for lists, leads in batches:
            for some, parts in _runs(RUN, leads, lists):
                yield pa.array([
                    {"counts": None if ts is None else [0 if t is None else len(enc.encode_ordinary(t)) for t in ts], "lead": lead(text)}
                    for text, ts in zip(some, parts)], kind)

    return measure(texts, c)


def bpe_tokens(c: Column, vocabulary: str = VOCABULARY) -> Column:
    @F.pandas_udf("array<string>")
    def pieces(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = _encoding(vocabulary)
        for texts in batches:
            yield texts.map(lambda t: None if t is None else _bpe_pieces(t, enc))

    return pieces(c)


def bpe_count(c: Column, vocabulary: str = VOCABULARY) -> Column:
    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = _encoding(vocabulary)
        for texts in batches:
            yield texts.map(lambda t: 0 if t is None else len(enc.encode_ordinary(t)))

    return count(c)


def tokens(c: Column, tokenizer: str = "word") -> Column:
    if tokenizer == "word":
        return word_tokens(c)
    if tokenizer == "bpe":
        return bpe_tokens(c)
    raise ValueError(f"unknown tokenizer {tokenizer}")


def n_tokens(c: Column, tokenizer: str = "word") -> Column:
    if tokenizer == "word":
        return F.coalesce(F.regexp_count(c, F.lit(WORD_TOKEN)), F.lit(0)).cast("long")
    return bpe_count(c)


def truncate(c: Column, n: int, tokenizer: str = "word") -> Column:
    """Text unchanged when it has at most ``n`` tokens, else its first ``n`` tokens."""
    t = tokens(c, tokenizer)
    return F.when(F.size(t) <= n, c).otherwise(F.array_join(F.slice(t, 1, n), ""))


def step_of(size: int, overlap: int) -> int:
    step = size - overlap
    return step if step > 0 else max(1, size // 2)


def windows_of(tk: Column, size: int, overlap: int) -> Column:
    """Array of ``(window, text, n, start, end)`` over a token array; offsets count characters.

    Token text is measured once per step, so the work is linear in the text length."""
    return once(tk, lambda t: _windows(t, size, overlap))


def _windows(tk: Column, size: int, overlap: int) -> Column:
    step = step_of(size, overlap)
    n = F.size(tk)
    last = F.when(n <= size, F.lit(0)).otherwise(F.ceil((n - size) / F.lit(float(step))).cast("int"))
    index = F.sequence(F.lit(0), last)
    step_len = F.transform(index, lambda i: F.length(F.array_join(F.slice(tk, i * step + 1, step), "")))
    starts = F.aggregate(
        step_len,
        F.array(F.lit(0)),
        lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)),
    )

    def window(i, at):
        part = F.slice(tk, i * step + 1, size)
        return F.struct(
            i.alias("window"),
            F.array_join(part, "").alias("text"),
            F.size(part).cast("long").alias("n"),
            F.element_at(at, i + 1).alias("start"),
        )

    def close(w):
        return F.struct(
            w["window"].alias("window"), w["text"].alias("text"), w["n"].alias("n"),
            w["start"].alias("start"), (w["start"] + F.length(w["text"])).alias("end"),
        )

    return F.transform(once(starts, lambda at: F.transform(index, lambda i: window(i, at))), close)


def token_windows(df: DataFrame, text: str, size: int = 512, overlap: int = 64, tokenizer: str = "word") -> DataFrame:
    """One row per window of ``text``; no shuffle."""
    if overlap >= size:
        raise ValueError("overlap must be smaller than the window size")
    keep = [c for c in df.columns if c != text]
    filled = df.filter(F.col(text).rlike(r"(?U)\S"))
    if tokenizer == "bpe":
        windows = filled.select(*keep, bpe_windows(F.col(text), size, overlap).alias("_w"))
    else:
        tokenised = filled.select(*keep, tokens(F.col(text), tokenizer).alias("_tk"))
        windows = tokenised.select(*keep, windows_of(F.col("_tk"), size, overlap).alias("_w"))
    return windows.select(*keep, F.inline_outer("_w")).withColumnRenamed("n", "token_count")
