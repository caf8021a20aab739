"""Extraction by a model in buffers and several passes, with every answer placed in the text.

A model that answers with texts and without offsets becomes a function for ``extract_mentions_with``. An
article is read as a stream of buffers; its passes, the places of its answers and the choice between
overlapping answers all happen while a buffer is at hand, so nothing is shuffled and memory holds one
group of buffers.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import regex

EXACT, FUZZY, NONE = "match_exact", "match_fuzzy", "no_match"
#: ``model(texts, pass_no)``: for every text a list of ``(class, text, attributes)``, passes from 1.
Model = Callable[[list[str], int], list[list[tuple[str, str, dict | None]]]]

SENTENCE_END = regex.compile(r"[.!?]+[\"')\]]*\s+|\n+")
BLANK = regex.compile(r"\s+")
WORD_CHAR = regex.compile(r"\w")


def buffers(text: str, most: int) -> Iterator[tuple[int, int]]:
    """Ends of at most ``most`` characters each that cover the text: after the last sentence or line that
    ends in the second half of a buffer, else after its last white space, else at its limit."""
    start = 0
    while len(text) - start > most:
        end = start + most
        for rule, least in ((SENTENCE_END, start + most // 2), (BLANK, start)):
            cuts = [m.end() for m in rule.finditer(text, least, end) if m.end() > start]
            if cuts:
                end = cuts[-1]
                break
        yield start, end
        start = end
    if start < len(text):
        yield start, len(text)


def _codes(text: str) -> np.ndarray:
    """Lower-case code points, one for each character; a sigma does not look at its neighbours."""
    folded = text.lower()
    if len(folded) != len(text) or "\u03a3" in text:
        folded = "".join(low if len(low := c.lower()) == 1 else c for c in text)
    return np.frombuffer(folded.encode("utf-32-le", "surrogatepass"), np.uint32)


def _distances(wanted: np.ndarray, text: np.ndarray, anchored: bool) -> np.ndarray:
    """Edit distance of ``wanted`` to the best stretch of ``text`` that ends at each place (anchored: to the
    stretch from the first place on)."""
    steps = np.arange(len(text) + 1)
    row = steps.copy() if anchored else np.zeros(len(text) + 1, np.int64)
    for i, code in enumerate(wanted, 1):
        changed = np.minimum(row[1:] + 1, row[:-1] + (text != code))
        row = np.minimum.accumulate(np.concatenate(([i], changed)) - steps) + steps
    return row


def _ends(patterns: list[np.ndarray], codes: np.ndarray, most: int = 1 << 21) -> dict[int, tuple[int, int]]:
    """Per number of a pattern the first place of ``codes`` where its best stretch ends, and the distance, as of
    ``_distances``. Patterns of one length are worked side by side, at most ``most`` numbers at a time."""
    out: dict[int, tuple[int, int]] = {}
    by_size: dict[int, list[int]] = {}
    for i, pattern in enumerate(patterns):
        by_size.setdefault(len(pattern), []).append(i)
    for size, members in by_size.items():
        kind = np.int16 if len(codes) + size < 1 << 14 else np.int64
        steps = np.arange(len(codes) + 1, dtype=kind)
        at_once = max(1, most // (len(codes) + 1))
        for first in range(0, len(members), at_once):
            some = members[first : first + at_once]
            wanted = np.array([patterns[i] for i in some], np.uint32).reshape(len(some), size)
            row = np.zeros((len(some), len(codes) + 1), kind)
            for k in range(size):
                changed = np.minimum(row[:, 1:] + kind(1), row[:, :-1] + (codes != wanted[:, k : k + 1]))
                row[:, 0] = k + 1
                row[:, 1:] = changed
                row -= steps
                np.minimum.accumulate(row, axis=1, out=row)
                row += steps
            ends = row.argmin(axis=1)
            out |= {i: (int(e), int(d)) for i, e, d in zip(some, ends, row[np.arange(len(some)), ends])}
    return out


def nearest(
    text: str, wanted: str, share: float, codes: np.ndarray | None = None, known: tuple[int, int] | None = None
) -> tuple[int, int] | None:
    """``known`` is what ``_ends`` tells of the wanted text. The stretch of least edit distance, case aside, when that is at most ``share`` of the wanted
    length: the one that ends first, and of its starts the one nearest the wanted length, then the latest."""
    budget = int(len(wanted) * share)
    pattern, codes = _codes(wanted), _codes(text) if codes is None else codes
    end, least = known or _ends([pattern], codes)[0]
    if not len(wanted) or not end or least > budget or least >= len(wanted):
        return None
    back = _distances(pattern[::-1], codes[max(0, end - len(wanted) - budget) : end][::-1], True)
    sizes = np.flatnonzero(back == least)
    size = int(sizes[np.argmin(np.abs(sizes - len(wanted)), axis=0)])
    return (end - size, end) if size else None


def _occurrences(text: str, answer: str) -> list[tuple[int, int]]:
    """Places of the answer as whole words, none touching the one before. A plain search: a pattern for each answer would be
    compiled anew each time."""
    out, at = [], text.find(answer) if answer else -1
    while at >= 0:
        end = at + len(answer)
        whole = not (at and WORD_CHAR.match(text, at - 1)) and not WORD_CHAR.match(text, end)
        if whole:
            out.append((at, end))
        at = text.find(answer, end if whole else at + 1)
    return out


def place(text: str, answers: list[str], share: float = 0.25) -> list[tuple[int | None, int | None, str]]:
    """Place and status of each answer in order. The n-th time an answer is given it takes its n-th occurrence
    as whole words; an answer without an occurrence takes the nearest stretch; one that is given more
    often than it occurs, is empty, or is too far from all stretches has no place."""
    left: dict[str, list[tuple[int, int]]] = {}
    known: dict[str, tuple[int, int] | None] = {}
    for answer in answers:
        if answer not in left:
            left[answer] = _occurrences(text, answer)[::-1]
    if lost := [answer for answer, spans in left.items() if not spans]:
        codes = _codes(text)
        ends = _ends([_codes(answer) for answer in lost], codes)
        known = {answer: nearest(text, answer, share, codes, ends[i]) for i, answer in enumerate(lost)}
    out = []
    for answer in answers:
        if left[answer]:
            out.append((*left[answer].pop(), EXACT))
        elif known.get(answer):
            out.append((*known[answer], FUZZY))
            known[answer] = None
        else:
            out.append((None, None, NONE))
    return out


class Taken:
    """Disjoint stretches in order, for the question whether a stretch touches any of them."""

    def __init__(self):
        self.starts: list[int] = []
        self.ends: list[int] = []

    def touches(self, start: int, end: int) -> bool:
        at = bisect_left(self.starts, end)
        return at > 0 and self.ends[at - 1] > start

    def add(self, spans: list[tuple[int, int]]) -> None:
        starts, ends = [], []
        for start, end in sorted([*zip(self.starts, self.ends), *spans]):
            if ends and start < ends[-1]:
                ends[-1] = max(ends[-1], end)
            else:
                starts.append(start)
                ends.append(end)
        self.starts, self.ends = starts, ends


def merge_passes(text: str, answers: list[list[tuple[str, str, dict | None]]], share: float = 0.25) -> list[tuple]:
    """Answers of all passes over one buffer: a later pass adds what touches no stretch of an earlier
    one, and of its answers without a place those that no earlier pass gave."""
    taken, unplaced, kept = Taken(), set(), []
    for given in answers:
        spans, missing = [], set()
        for (kind, name, attributes), (start, end, status) in zip(given, place(text, [g[1] or "" for g in given], share)):
            if start is None:
                missing.add((kind, name))
                if (kind, name) in unplaced:
                    continue
            elif taken.touches(start, end):
                continue
            else:
                spans.append((start, end))
            kept.append((kind, name, start, end, status, attributes))
        taken.add(spans)
        unplaced |= missing
    return kept


COLUMNS = [
    "article_id", "chapter_number", "article_number", "position", "extraction_class", "extraction_text", "start_pos",
    "end_pos", "alignment_status", "attributes",
]


def _frame(rows: list[tuple]) -> pd.DataFrame:
    pdf = pd.DataFrame(rows, columns=COLUMNS)
    whole = ("chapter_number", "article_number", "position", "start_pos", "end_pos")
    return pdf.assign(**{c: pd.array(pdf[c], dtype="Int32") for c in whole})


def buffered(
    model: Model, passes: int = 2, max_chars: int = 1500, share: float = 0.25, group: int = 32, flush: int = 20_000
) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """A function for ``extract_mentions_with``: buffers of ``max_chars``, ``group`` of them a call of the
    model, ``passes`` calls each. ``share`` is the part of an answer's characters that may differ from the text.

    Null and empty texts have no rows. Rows are numbered per article in order of buffer, pass and answer. An
    article of any length is read in groups of buffers; rows leave every ``flush`` rows. Repeated articles are
    worked each. A model must answer alike when a lost task runs again."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows: list[tuple] = []
        for pdf in batches:
            for article, chapter, number, text in pdf[["article_id", "chapter_number", "article_number", "markdown_content"]].itertuples(index=False):
                if not isinstance(text, str):
                    continue
                keys = (article, chapter, number)
                position, cuts = 0, buffers(text, max_chars)
                while some := [cut for _, cut in zip(range(group), cuts)]:
                    parts = [text[a:b] for a, b in some]
                    answers = [model(parts, n) for n in range(1, passes + 1)]
                    for (at, _), part, *given in zip(some, parts, *answers):
                        for kind, name, start, end, status, attributes in merge_passes(part, given, share):
                            span = (None, None) if start is None else (at + start, at + end)
                            rows.append((*keys, position, kind, name, *span, status, attributes))
                            position += 1
                    if len(rows) >= flush:
                        yield _frame(rows)
                        rows = []
        if rows:
            yield _frame(rows)

    return run
