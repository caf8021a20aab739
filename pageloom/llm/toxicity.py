"""Toxicity by a subsequence string-kernel support vector machine with Nyström landmarks.

The kernel of two words sums, over all triples of letters, the weights with which the triple occurs in both
as a subsequence; every skipped character multiplies a weight by 0.6. So ``st.upid`` and ``stuXpid`` stay
close to ``stupid``. Landmark words are drawn from labelled training sentences. A sentence is the largest
normalised kernel value of its words at every landmark, mapped by the inverse square root of the landmark
kernel matrix; a linear machine on these vectors is the kernel machine in the landmarks' span. A text
scores as its worst sentence.
"""

from __future__ import annotations

import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain
from sys import getsizeof

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageloom.llm.common import SLOT, hold_alone, small_batches
from pageloom.llm.words import slices

DECAY = 0.6
#: Triples span so many characters at most; words are looked at in stretches of this many, half overlapping.
SPAN = 8
STRETCH = 16
LANDMARKS = 96
#: A word counts in a sentence if it comes so near to some landmark.
NEAR = 0.4
NOISE = 0.02
_CLASSES = 32
_GAP = 31
#: Characters that are written for letters.
_ALIKE = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}
_ENDS = (".", "!", "?")
_MANY = 32


class _Letters(dict):
    """Characters to one byte each: a-z by base letter, other letters in five classes, the rest is a gap."""

    def __missing__(self, code: int) -> str:
        c = chr(code)
        base = unicodedata.normalize("NFKD", c.lower())[0]
        base = _ALIKE.get(base, base)
        if not "a" <= base <= "z":
            base = chr(ord("a") + 26 + code % 5) if c.isalpha() else chr(ord("a") + _GAP)
        self[code] = base
        return base


_LETTERS = _Letters()
_LINES = _Letters({ord("\n"): "\n"})
_BLANK = bytes([ord("a") + _GAP])


@lru_cache(maxsize=64)
def _triples(length: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of all triples within the span, and their weights."""
    places = [(i, j, k) for i in range(length) for k in range(i + 2, min(length, i + SPAN)) for j in range(i + 1, k)]
    places = np.array(places, np.int64).reshape(-1, 3)
    return places, (DECAY ** (places[:, 2] - places[:, 0] - 2)).astype(np.float32)


def _cut(letters: bytes) -> tuple[bytes, ...]:
    if len(letters) <= STRETCH:
        return (letters,)
    return tuple(letters[a : a + STRETCH] for a in range(0, len(letters) - STRETCH // 2, STRETCH // 2))


def _stretches(word: str) -> tuple[bytes, ...]:
    """A word in classes of letters, in stretches of bounded length; gaps at its ends do not count."""
    return _cut(word.translate(_LETTERS).encode("latin-1", "replace").strip(_BLANK))


def _occurrences(group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Triple numbers and weights, a column for each stretch of one length."""
    places, weights = _triples(group.shape[1])
    codes = group.T.astype(np.int32) - ord("a")
    a, b, c = (codes[places[:, k]] for k in range(3))
    ids, weights = (a * _CLASSES + b) * _CLASSES + c, np.repeat(weights[:, None], len(group), 1)
    if (codes == _GAP).any():
        fine = (a != _GAP) & (b != _GAP) & (c != _GAP)
        return np.where(fine, ids, 0), np.where(fine, weights, 0).astype(np.float32)
    return ids, weights


def _norms(ids: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Square root of each column's kernel value with itself: weights of one triple add before they are squared."""
    ids, weights = np.ascontiguousarray(ids.T), np.ascontiguousarray(weights.T)
    n, t = ids.shape
    if not t:
        return np.zeros(n, np.float32)
    order = np.argsort(ids, axis=1, kind="stable")
    ids, weights = np.take_along_axis(ids, order, 1), np.take_along_axis(weights, order, 1)
    new = np.ones((n, t), bool)
    new[:, 1:] = ids[:, 1:] != ids[:, :-1]
    begin = np.flatnonzero(new.ravel())
    sums = np.add.reduceat(weights.ravel(), begin)
    return np.sqrt(np.bincount(begin // t, sums**2, minlength=n)).astype(np.float32)


def triple_vectors(words: list[str]) -> np.ndarray:
    """Normalised weights of all triples, a row for each word; for few words only."""
    out = np.zeros((len(words), _CLASSES**3), np.float32)
    for i, word in enumerate(words):
        for stretch in _stretches(word):
            ids, weights = _occurrences(np.frombuffer(stretch, np.uint8)[None])
            np.add.at(out[i], ids[:, 0], weights[:, 0])
    return out / np.maximum(np.sqrt((out**2).sum(1, keepdims=True)), 1e-9)


class Marks:
    """Landmarks by triple: for each triple the landmarks that hold it, one after the other. Few triples are in any."""

    def __init__(self, landmarks: np.ndarray):
        triples, self.columns = np.nonzero(landmarks)
        self.values = landmarks[triples, self.columns]
        self.many = np.bincount(triples, minlength=len(landmarks))
        self.begin = np.cumsum(self.many) - self.many
        self.held, self.width = self.many > 0, landmarks.shape[1]

    def sums(self, ids: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Products of columns of triples with all landmarks, a row for each; its triples are added in their order."""
        n = ids.shape[1]
        out = np.zeros(n * self.width, np.float32)
        at = np.flatnonzero(self.held[ids])
        found = ids.ravel()[at]
        many = self.many[found]
        ends = np.cumsum(many)
        entry = np.repeat(self.begin[found] - ends + many, many) + np.arange(ends[-1] if len(ends) else 0)
        np.add.at(out, np.repeat(at % n * self.width, many) + self.columns[entry], np.repeat(weights.ravel()[at], many) * self.values[entry])
        return out.reshape(n, self.width)


def stretch_values(cut: list[tuple[bytes, ...]], marks: Marks, least: float = 0.0) -> np.ndarray:
    """Normalised kernel of words, given by their stretches, with landmarks. Rows of words that come nowhere near
    ``least`` may be left zero: a norm is at least that of weights which never add up, so most need not be known."""
    out = np.zeros((len(cut), marks.width), np.float32)
    by: dict[tuple[int, bool], tuple[list[int], list[bytes]]] = {}
    for i, stretches in enumerate(cut):
        for stretch in stretches:
            if len(stretch) >= 3:
                owners, found = by.setdefault((len(stretch), len(stretches) == 1), ([], []))
                owners.append(i)
                found.append(stretch)
    for (length, alone), (owners, found) in by.items():
        for a in range(0, len(found), 2048):
            group = np.frombuffer(b"".join(found[a : a + 2048]), np.uint8).reshape(-1, length)
            own = np.array(owners[a : a + 2048])
            ids, weights = _occurrences(group)
            values = marks.sums(ids, weights)
            if alone:
                may = values.max(1, initial=0) >= 0.999 * least * np.sqrt((weights * weights).sum(0))
                own, ids, weights, values = own[may], ids[:, may], weights[:, may], values[may]
            values /= np.maximum(_norms(ids, weights), 1e-9)[:, None]
            if alone:
                out[own] = values
            else:
                np.maximum.at(out, own, values)
    return out


def similarities(words: list[str], landmarks: np.ndarray) -> np.ndarray:
    """Normalised kernel of words with landmarks, given as triples by landmarks; of a long word the largest."""
    return stretch_values([_stretches(w) for w in words], Marks(landmarks))


@dataclass
class Model:
    """Landmarks by triples; the machine in landmark values; the scale that makes a probability."""

    landmarks: np.ndarray
    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def probability(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -500, 500)))


class Reader:
    """Texts to sentence vectors at the landmarks. Words are remembered by value, in two generations of about
    ``room`` bytes each: a full young one becomes the old one, and what is asked for again comes back from it."""

    def __init__(self, landmarks: np.ndarray, room: int = 24 << 20):
        self.landmarks, self.room = landmarks, room
        self.marks = Marks(landmarks)
        self.near: dict[str, np.ndarray | None] = {}
        self.old: dict[str, np.ndarray | None] = {}
        self.held = 0

    def keep(self, word: str, value: np.ndarray | None) -> None:
        self.near[word] = value
        self.held += getsizeof(word) + SLOT + (0 if value is None else getsizeof(value))

    def learn(self, words: set[str]) -> None:
        if self.held > self.room:
            self.old, self.near, self.held = self.near, {}, 0
        new = []
        for w in words:
            if w in self.near:
                continue
            if w in self.old:
                self.keep(w, self.old[w])
            else:
                new.append(w)
        for a in range(0, len(new), 20_000):
            # words that differ in case, signs at their ends and the like only are one to the kernel
            kinds: dict[tuple[bytes, ...], list[str]] = defaultdict(list)
            some = new[a : a + 20_000]
            for word, letters in zip(some, "\n".join(some).translate(_LINES).encode("latin-1", "replace").split(b"\n")):
                kinds[_cut(letters.strip(_BLANK))].append(word)
            values = stretch_values(list(kinds), self.marks, NEAR)
            close = (values.max(1) >= NEAR).tolist()
            for i, same in enumerate(kinds.values()):
                for word in same:
                    # a copy, as a view would keep the values of all these words
                    self.keep(word, values[i].copy() if close[i] else None)

    def sentences(self, texts: list[str]) -> list[np.ndarray]:
        """For each text the vectors of its sentences that have a word near a landmark; all others are zero."""
        split = [spelled_out(t.lower().split()) for t in texts]
        flat = list(chain.from_iterable(split))
        words = set(flat)
        self.learn(words)
        close = [w for w in words if self.near[w] is not None]
        if not close:
            return [np.zeros((0, self.marks.width), np.float32) for _ in texts]
        table = np.stack([self.near[w] for w in close])
        # a word's number among the close ones or -1, twice, and 1 more if it ends a sentence
        number = dict.fromkeys(words, -2) | {w: 2 * i for i, w in enumerate(close)}
        number.update([(w, n + 1) for w, n in number.items() if w[-1] in _ENDS])
        numbers = np.fromiter(map(number.__getitem__, flat), np.int64, len(flat))
        bounds = np.cumsum([0, *map(len, split)])
        last = (numbers & 1).astype(bool)
        last[bounds[1:][bounds[1:] > 0] - 1] = True
        at = np.flatnonzero(numbers >= 0)
        begin = np.flatnonzero(np.diff((np.cumsum(last) - last)[at], prepend=-1))
        which, many = numbers[at] >> 1, np.diff(begin, append=len(at))
        rows = table[which[begin]]
        # the second words of all sentences, then the third ones and so on; the rest of a long sentence by itself
        for k in range(1, _MANY):
            on = np.flatnonzero(many > k)
            rows[on] = np.maximum(rows[on], table[which[begin[on] + k]])
        for i in np.flatnonzero(many > _MANY).tolist():
            for c in range(begin[i] + _MANY, begin[i] + many[i], 4096):
                np.maximum(rows[i], table[which[c : min(c + 4096, begin[i] + many[i])]].max(0), out=rows[i])
        cuts = np.searchsorted(at[begin], bounds)
        return [rows[a:b] for a, b in zip(cuts.tolist(), cuts[1:].tolist())]


def spelled_out(words: list[str]) -> list[str]:
    """With runs of three or more single letters joined to one word."""
    singles = [i for i, w in enumerate(words) if len(w) == 1]
    if len(singles) < 3 or not any(singles[k + 2] == singles[k] + 2 for k in range(len(singles) - 2)):
        return words
    out, i = [], 0
    while i < len(words):
        j = i
        while j < len(words) and len(words[j]) == 1:
            j += 1
        out += ["".join(words[i:j])] if j - i >= 3 else words[i : max(j, i + 1)]
        i = max(j, i + 1)
    return out


def choose_landmarks(texts: list[str], labels: np.ndarray, many: int) -> tuple[list[str], np.ndarray]:
    """Words that tell the classes apart most, none too near to one before it, and common words
    beside them; and 1 for the first kind, -1 for the other."""
    seen = {1: Counter(), 0: Counter()}
    for text, y in zip(texts, labels.tolist()):
        seen[y].update({w.strip(".,;:!?") for w in text.lower().split()})
    n = {y: max(1, int((labels == y).sum())) for y in (0, 1)}
    share = lambda w, y: (seen[y][w] + 0.5) / (n[y] + 1)
    told = {w: np.log(share(w, 1) / share(w, 0)) * np.sqrt(seen[1][w]) for w in seen[1] if len(w) >= 3 and seen[1][w] >= 3}
    ranked = sorted(told, key=lambda w: (-told[w], w))[: 12 * many]
    common = sorted((w for w in seen[0] if len(w) >= 3), key=lambda w: (-seen[0][w], w))[:many]
    chosen: list[str] = []
    vectors = np.zeros((0, _CLASSES**3), np.float32)
    telling = 0
    for words, most in ((ranked, many * 3 // 4), (common, many)):
        for word in words:
            if len(chosen) >= most:
                break
            v = triple_vectors([word])
            if v.any() and (vectors @ v[0] < 0.8).all():
                chosen.append(word)
                vectors = np.concatenate([vectors, v])
        telling = telling or len(chosen)
    return chosen, np.where(np.arange(len(chosen)) < telling, 1.0, -1.0)


def inserted(word: str) -> list[str]:
    """The word with one character put in, at every inner place: a sign and a letter."""
    return [word[:i] + c + word[i:] for i in range(1, len(word)) for c in "-x"]


def fit_machine(x: np.ndarray, y: np.ndarray, much: np.ndarray, cost: float = 64.0, rounds: int = 200) -> tuple[np.ndarray, float]:
    """A linear machine with squared hinge loss, both classes weighing the same and rows within a class as
    ``much`` says; accelerated gradient steps."""
    sign = np.where(y > 0, 1.0, -1.0)
    share = much * np.where(y > 0, 0.5 / much[y > 0].sum(), 0.5 / much[y <= 0].sum()) * cost
    z = np.concatenate([x, np.ones((len(x), 1))], 1).astype(np.float64)
    step = 1 / (1e-2 + 2 * np.linalg.eigvalsh((z * share[:, None]).T @ z)[-1] + 1e-9)
    w = v = np.zeros(z.shape[1])
    for k in range(rounds):
        slack = np.maximum(0, 1 - sign * (z @ v))
        grad = -2 * ((share * sign * slack) @ z)
        grad[:-1] += 1e-2 * v[:-1]
        new = v - step * grad
        v = new + k / (k + 3) * (new - w)
        w = new
    return w[:-1], float(w[-1])


def fit(texts: list[str], labels: np.ndarray, base_rate: float | None = None, many: int = LANDMARKS) -> Model:
    """A model from labelled texts. A toxic text teaches by its worst sentence, found anew in each round; a clean
    one by all its sentences that come near a landmark, and an empty sentence stands for the others."""
    if not len(texts) or len(set(labels.tolist())) < 2:
        rate = float(np.mean(labels)) if len(labels) else 0.0
        return Model(np.zeros((_CLASSES**3, 1), np.float32), np.zeros(1), 0.0, 0.0, float(np.log((rate + 0.01) / (1.01 - rate))))
    words, lead = choose_landmarks(texts, labels, many)
    own = triple_vectors(words or ["aaa"])
    reader = Reader(np.ascontiguousarray(own.T))
    values, axes = np.linalg.eigh((own @ own.T).astype(np.float64))
    root = axes @ np.diag(1 / np.sqrt(np.maximum(values, 1e-3))) @ axes.T
    zero = np.zeros((1, len(own)), np.float32)
    bags = [np.concatenate([s, zero]) for s in reader.sentences(texts)]
    clean = np.concatenate([b for b, y in zip(bags, labels) if y == 0]) @ root
    toxic = [b for b, y in zip(bags, labels) if y == 1]
    lead = lead if len(words) else np.zeros(1)
    worst = [b[np.argmax((b * lead).max(1))] for b in toxic]
    noisy = np.zeros((0, len(own)), np.float32)
    for _ in range(3):
        x = np.concatenate([np.stack(worst) @ root, noisy @ root, clean])
        y = np.concatenate([np.ones(len(worst) + len(noisy)), np.zeros(len(clean))])
        # the spoiled words together weigh little beside the sentences
        much = np.concatenate([np.ones(len(worst)), np.full(len(noisy), NOISE * len(worst) / max(1, len(noisy))), np.ones(len(clean))])
        inner, bias = fit_machine(x, y, much)
        weights = root @ inner
        worst = [b[np.argmax(b @ weights)] for b in toxic]
        # landmarks that are toxic by themselves teach with a character put in, too
        alone = similarities(words, reader.landmarks) @ weights + bias > 0 if words else []
        spoiled = [v for w, bad in zip(words, alone) if bad for v in inserted(w)]
        noisy = similarities(spoiled, reader.landmarks) if spoiled else noisy
    margins = np.array([(b @ weights).max() + bias for b in bags])
    rate = float(np.mean(labels)) if base_rate is None else base_rate
    slope, shift = _scale(margins, labels, rate)
    return Model(reader.landmarks, weights, bias, slope, shift)


def _scale(margins: np.ndarray, labels: np.ndarray, rate: float) -> tuple[float, float]:
    """Logistic scale of margins, classes weighted to the given share, by Newton steps."""
    n1, n0 = (labels == 1).sum(), (labels == 0).sum()
    target = np.where(labels == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    weight = np.where(labels == 1, rate / n1, (1 - rate) / n0)
    z, w = np.stack([margins, np.ones(len(margins))], 1), np.array([1.0, 0.0])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -50, 50)))
        grad = z.T @ (weight * (p - target)) + 1e-4 * np.array([w[0], 0])
        hess = (z * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ z + 1e-4 * np.eye(2)
        move = np.linalg.solve(hess, grad)
        w = w - move / max(1, np.abs(move).max())
    return float(max(w[0], 1e-3)), float(w[1])


_READERS: dict[int, tuple[Model, Reader]] = {}


def _scorer(model) -> object:
    """``(id, text)`` to ``(id, score)``."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        hold_alone("toxicity", _READERS.clear)
        if id(m) not in _READERS:
            _READERS.clear()
            _READERS[id(m)] = m, Reader(m.landmarks)
        reader = _READERS[id(m)][1]
        for batch in batches:
            for part in slices(batch, 1, 1 << 20):
                found = reader.sentences([t or "" for t in part.column(1).to_pylist()])
                margins = np.array([max(0.0, float((s @ m.weights).max(initial=0))) for s in found]) + m.bias
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(m.probability(margins))], [batch.schema.names[0], "score"])

    return score


def training_sample(docs: DataFrame, labels: DataFrame, most: int, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> tuple[list[str], np.ndarray, float]:
    """Up to ``most`` labelled texts of each class, by a hash of the id, and the share of label 1 among all."""
    told = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1)).groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).alias("label"))
    counts = {r["label"]: r["count"] for r in told.groupBy("label").count().collect()}
    picked = None
    for y in (0, 1):
        some = told.where(F.col("label") == y).orderBy(F.xxhash64("id"), "id").limit(most)
        picked = some if picked is None else picked.union(some)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("text is not null")
    rows = sorted(((r["id"], r["text"], r["label"]) for r in picked.join(texts, "id").select("id", "text", "label").toLocalIterator()))
    total = sum(counts.values())
    return [t for _, t, _ in rows], np.array([y for _, _, y in rows], int), counts.get(1, 0) / total if total else 0.0


def score_texts(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``(row, score)``: every row of ``docs`` as a struct and its probability of being toxic.

    Nothing but the text is read for the score. A null or empty text scores as one without any notable
    word. All rows and columns stay, repeated and null ones too; an empty table gives an empty result.
    There is no shuffle; the model is of fixed size."""
    from pyspark.sql import types as T

    small_batches(docs.sparkSession)
    df = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(text_col).alias("text"))
    shape = T.StructType([df.schema["row"], T.StructField("score", T.DoubleType())])
    return df.mapInArrow(_scorer(docs.sparkSession.sparkContext.broadcast(model)), shape)


def train_on(docs: DataFrame, labels: DataFrame, most: int = 2000, **columns) -> Model:
    """A model from up to ``most`` labelled texts of each class; without two classes, one that gives the share of label 1."""
    texts, y, rate = training_sample(docs, labels, most, **columns)
    return fit(texts, y, rate)
