"""Toxicity: a support vector machine over a gapped subsequence kernel, with Nyström landmarks.

Strings are letter windows of words. Their kernel counts shared subsequences of three letters within five, each
weighted by ``DECAY`` per letter skipped and scaled to 1 for equal windows, so a letter put into an insult or marks put
between its letters lower the kernel a little instead of hiding it. The kernel of two sentences is the sum over all
pairs of their windows of that kernel raised to ``POWER`` (again a kernel), and a landmark is a sentence of one window.
A sentence's Nyström features are its kernels with all landmarks times the inverse root of the landmarks' own, and the
machine is linear in them; so a sentence's value is a sum of its words' values.

Where toxic documents differ from clean ones not by a word but by how often words begin in some way,
no single sentence tells them. So a second kind of landmark is the start of a word, chosen by the
documents that repeat it, and a document is also scored by how often it has each.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lithos.llm._labels import calibrated, fold, isotonic, labelled_sample
from lithos.llm._text import ragged_take, raw, string_array, sums, text_slices

#: Labelled documents used at most, landmarks, and lengths of the letter windows that may become one.
TRAIN_LIMIT, LANDMARKS, LENGTHS = 12_000, 64, (4, 5, 6)
#: Decay per skipped letter, span of a subsequence, power of the windows' kernel, and lengths of a word's windows.
DECAY, SPAN, POWER, WINDOWS = 0.7, 5, 5, (5, 8)
#: Sentences of each labelled document that the machine is fitted on besides those that hold a landmark; kernels with a landmark from which on a sentence holds it, and holds it with a letter put in.
SENTENCES, HELD, HELD_ALTERED = 6, 0.9, 0.05
#: Strings that a task counts before it passes the counts on.
COUNTED = 50_000
#: Sentences that the driver's fit works through at once.
FIT_ROWS = 8_192
#: Bytes of text that are worked through at once.
SLICE_BYTES = 3 << 20
#: A landmark is met in so many toxic training documents at least, and so many times as often in them as in others.
LEAST_DOCS, LEAST_RATIO = 5, 12.0
#: Words of a document that begin with a start for the document to count for it, and lengths of starts; the same least numbers hold.
START_TIMES, START_LENGTHS = 3, (3, 4, 5, 6)

_GAPS = [(j, k) for k in range(2, SPAN) for j in range(1, k)]
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLD[[9, 10, 11, 12, 13]] = 32
_DIGITS = {ord("0"): "o", ord("1"): "i", ord("3"): "e", ord("4"): "a", ord("5"): "s", ord("7"): "t"}
_NOT_LETTER = re.compile(r"[^\w]|[\d_]")
#: The letter that an ASCII byte is read as; bytes with 0 are left out.
_PLAIN = np.zeros(256, np.uint8)
_PLAIN[65:91] = _PLAIN[97:123] = np.arange(97, 123)
for _d, _c in _DIGITS.items():
    _PLAIN[_d] = ord(_c)


@lru_cache(maxsize=50_000)
def letters(word: str) -> str:
    """Lower-case letters of a word; digits that stand for letters are read so where letters are beside them."""
    word = word.lower()
    if any(c.isalpha() for c in word):
        word = word.translate(_DIGITS)
    return _NOT_LETTER.sub("", word)


def _letter(c: str) -> int:
    """Letters beyond a-z share six classes."""
    return ord(c) - 97 if "a" <= c <= "z" else 26 + c.encode()[-1] % 6


def subsequences(window: str) -> dict[int, float]:
    """Weights of a window's gapped three-letter subsequences, scaled to a sum of squares of 1."""
    out: Counter[int] = Counter()
    own = [_letter(c) for c in window]
    for i, a in enumerate(own):
        for j, k in _GAPS:
            if i + k < len(own):
                out[(a << 10) | (own[i + j] << 5) | own[i + k]] += DECAY ** (k - 2)
    norm = math.sqrt(sum(v * v for v in out.values()))
    return {s: v / norm for s, v in out.items()} if norm else {}


def kernel(a: str, b: str) -> float:
    """Kernel of two windows."""
    one, two = subsequences(a), subsequences(b)
    return sum(v * two.get(s, 0.0) for s, v in one.items())


def windows(word: str) -> list[str]:
    """A word's windows: all of each length, and the word itself where it is shorter than a length."""
    return [word[i : i + n] for n in sorted({min(n, len(word)) for n in WINDOWS}) for i in range(len(word) - n + 1)] if word else []


@dataclass
class ToxicityModel:
    landmarks: list[str]
    whiten: np.ndarray
    weights: np.ndarray
    bias: float
    knots: tuple[np.ndarray, np.ndarray] = field(default_factory=lambda: isotonic(np.zeros(0), np.zeros(0)))
    #: Word starts, none of which begins another; how many of a document's words begin with each, in toxic and in clean documents; curves of their value and of both scores joined.
    starts: list[str] = field(default_factory=list)
    rates: np.ndarray = field(default_factory=lambda: np.ones((2, 0)))
    start_knots: tuple[np.ndarray, np.ndarray] | None = None
    both_knots: tuple[np.ndarray, np.ndarray] | None = None
    #: Starts that clean documents have too: only their rates count, and words with them are no part of sentences.
    left_out: list[str] = field(default_factory=list)

    def __post_init__(self) -> None:
        owners: dict[int, list[tuple[int, float]]] = {}
        for i, mark in enumerate(self.landmarks):
            for t, v in subsequences(mark).items():
                owners.setdefault(t, []).append((i, v))
        self.begin = np.zeros((1 << 15) + 1, np.int64)
        for c, own in owners.items():
            self.begin[c + 1] = len(own)
        self.begin = np.cumsum(self.begin)
        flat = [x for c in sorted(owners) for x in owners[c]]
        self.owner, self.value = np.array([i for i, _ in flat], np.int64), np.array([v for _, v in flat])

    def __reduce__(self):
        return ToxicityModel, (self.landmarks, self.whiten, self.weights, self.bias, self.knots, self.starts, self.rates, self.start_knots, self.both_knots, self.left_out)

    def word_kernels(self, plain: pa.Array, weights: np.ndarray | None = None) -> np.ndarray:
        """Of each word (as ``letters`` reads it) the sum over its windows of the powered kernel with each landmark, or with ``weights`` their weighted sum."""
        m = len(self.landmarks)
        out = np.zeros((len(plain), m if weights is None else 1))
        for a in range(0, len(plain), 4096):
            word, window, code, weight = _window_parts(plain.slice(a, 4096), np.diff(self.begin) > 0)
            count = np.diff(self.begin)[code]
            own = ragged_take(np.arange(len(self.owner)), self.begin[code], count)
            slot = np.repeat(window, count) * m + self.owner[own]
            own_kernels = np.bincount(slot, np.repeat(weight, count) * self.value[own], len(word) * m).reshape(len(word), m) ** POWER
            if weights is not None:
                own_kernels = (own_kernels @ weights)[:, None]
            first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]])) if len(word) else np.zeros(0, np.int64)
            if len(first):
                out[a + word[first]] = np.add.reduceat(own_kernels, first, axis=0)
        return out

    def decide(self, sentences: np.ndarray) -> np.ndarray:
        return sentences @ self.whiten @ self.weights + self.bias

    def start_value(self, hits: np.ndarray, n_words: np.ndarray) -> np.ndarray:
        """Log of the likelihood ratio of so many hits in so many words, for the start that tells most; 0 at least."""
        toxic, clean = self.rates
        return (hits * np.log(toxic / clean) - n_words[:, None] * (toxic - clean)).max(axis=1, initial=0.0)

    def either(self, best: np.ndarray, value: np.ndarray) -> np.ndarray:
        """Chance that the best sentence or the starts show it, taken as independent."""
        return 1 - (1 - calibrated(best, self.knots)) * (1 - calibrated(value, self.start_knots))

    def score(self, best: np.ndarray, value: np.ndarray) -> np.ndarray:
        return calibrated(self.either(best, value), self.both_knots) if self.starts else calibrated(best, self.knots)


def _plain(words: pa.Array) -> pa.Array:
    """``letters`` of every word: over all bytes at once where words are ASCII."""
    data, off = raw(words)
    upper = (data & 0xDF) - np.uint8(65)
    alpha = sums(upper < 26, off) > 0
    keep = (_PLAIN[data] > 0) & np.repeat(alpha, np.diff(off))
    plain = string_array(_PLAIN[data[keep]], np.concatenate([[0], np.cumsum(sums(keep, off))]))
    wide = pc.invert(pc.string_is_ascii(words))
    return pc.replace_with_mask(plain, wide, pa.array([letters(w) for w in words.filter(wide).to_pylist()], pa.large_string()))


def _spelled(split: _Split) -> list[tuple[int, str]]:
    """Words spelled out as single letters between blanks, signs beside them allowed: (index of the first chunk, the letters joined)."""
    chunks, starts = split.chunks, split.starts
    one = pc.or_(pc.equal(pc.utf8_length(split.words), 1), pc.and_(pc.equal(pc.utf8_length(split.plain), 1), pc.less_equal(pc.utf8_length(split.words), 2)))
    single = np.asarray(one).astype(bool)[split.code]
    cut = np.zeros(len(single) + 1, bool)
    cut[starts] = True
    edges = np.flatnonzero(np.diff(np.concatenate([[0], single.astype(np.int8), [0]])))
    out = []
    for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
        inner = [a, *[x for x in range(a + 1, b) if cut[x]], b]
        for x, y in zip(inner, inner[1:], strict=False):
            if y - x >= 4:
                out.append((x, "".join(chunks[x:y].to_pylist())))
    return out


#: Norm of a window of each length before it is scaled, where its letters all differ.
_NORMS = np.sqrt([sum(max(0, n - k) * DECAY ** (2 * (k - 2)) for _, k in _GAPS) for n in range(max(WINDOWS) + 1)])


def _window_parts(plain: pa.Array, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The word of each window (in order of words); and of each window's distinct subsequences: window, code, and weight scaled as in ``subsequences``.

    Of windows whose letters all differ only the ``wanted`` subsequences are worked out, as their norm is known.
    """
    data, off = raw(plain)
    code = np.zeros(256, np.int64)
    code[97:123] = np.arange(26)
    code[0x80:0xC0] = 26 + np.arange(0x80, 0xC0) % 6
    # A letter beyond ASCII counts by its last byte.
    last = np.ones(len(data), bool)
    last[:-1] = (data[1:] & 0xC0) != 0x80
    letter = code[data[last]]
    first = np.concatenate([[0], np.cumsum(last)])[off]
    size = np.diff(first)
    words, starts, lengths = [], [], []
    for k, n in enumerate(WINDOWS):
        width = np.minimum(size, n)
        # A word shorter than two lengths has one window of them.
        fresh = size > (WINDOWS[k - 1] if k else 0)
        many = np.where(fresh, size - width + 1, 0)
        word = np.repeat(np.arange(len(size)), many)
        words.append(word)
        starts.append(first[word] + np.arange(len(word)) - np.repeat(np.cumsum(many) - many, many))
        lengths.append(width[word])
    word, start, length = np.concatenate(words), np.concatenate(starts), np.concatenate(lengths)
    order = np.argsort(word, kind="stable")
    word, start, length = word[order], start[order], length[order]
    longest = max(WINDOWS)
    padded = np.concatenate([letter, np.zeros(longest, np.int64)])
    again = np.zeros(len(word), bool)
    for i in range(longest - 1):
        for j in range(i + 1, longest):
            again |= (padded[start + i] == padded[start + j]) & (j < length)
    keys, weights = [], []
    for j, k in _GAPS:
        spots = np.maximum(length - k, 0)
        window = np.repeat(np.arange(len(word)), spots)
        at = start[window] + np.arange(len(window)) - np.repeat(np.cumsum(spots) - spots, spots)
        triple = (letter[at] << 10) | (letter[at + j] << 5) | letter[at + k]
        needed = wanted[triple] | again[window]
        keys.append(((window << 15) | triple)[needed])
        weights.append(np.full(len(keys[-1]), DECAY ** (k - 2)))
    key, weight = np.concatenate(keys), np.concatenate(weights)
    order = np.argsort(key, kind="stable")
    key, weight = key[order], weight[order]
    begin = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    weight = np.add.reduceat(weight, begin) if len(begin) else weight
    window, triple = key[begin] >> 15, key[begin] & 0x7FFF
    norm = np.where(again, np.sqrt(np.bincount(window, weight * weight, len(word))), _NORMS[length])
    return word, window, triple, weight / norm[window]


@dataclass
class _Split:
    """Texts cut at blanks: all chunks, the texts' first ones (one more than texts), each chunk's number among the distinct words, and these."""

    chunks: pa.Array
    starts: np.ndarray
    code: np.ndarray
    words: pa.Array
    plain: pa.Array


def _split(texts: pa.Array) -> _Split:
    data, off = raw(texts)
    chunks = pc.split_pattern(string_array(_FOLD[data], off), " ")
    starts = np.asarray(chunks.offsets).astype(np.int64)
    starts -= starts[0]
    flat = chunks.flatten()
    index = flat.dictionary_encode()
    return _Split(flat, starts, np.asarray(index.indices), index.dictionary, _plain(index.dictionary))


def start_hits(split: _Split, starts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """For each text how many of its words begin with each start, and how many words it has."""
    own = np.full(len(split.words), -1)
    for n in {len(s) for s in starts}:
        which = [k for k, s in enumerate(starts) if len(s) == n]
        at = pc.index_in(pc.utf8_slice_codeunits(split.plain, 0, n), value_set=pa.array([starts[k] for k in which], pa.large_string()))
        found = np.asarray(at.is_valid())
        own[found] = np.array(which)[np.asarray(at.drop_null())]
    n_texts = len(split.starts) - 1
    text = np.repeat(np.arange(n_texts), np.diff(split.starts))
    hit = np.flatnonzero(own[split.code] >= 0)
    hits = np.bincount(text[hit] * len(starts) + own[split.code[hit]], minlength=n_texts * len(starts)).reshape(n_texts, len(starts))
    some = np.asarray(pc.greater(pc.binary_length(split.plain), 0)).astype(bool)
    return hits, sums(some[split.code], split.starts)


def _sentences(split: _Split) -> tuple[np.ndarray, np.ndarray]:
    """Each sentence's first chunk, and its text: sentences end with a chunk that ends so, and with the text."""
    stop = np.asarray(pc.match_substring_regex(split.words, r"[.!?]$").fill_null(False)).astype(bool)
    n = len(split.code)
    fresh = np.zeros(n + 1, bool)
    fresh[1:] = stop[split.code]
    fresh[split.starts] = True
    first = np.flatnonzero(fresh[:n])
    return first, np.searchsorted(split.starts, first, side="right") - 1


def sentence_sums(split: _Split, values: np.ndarray, spelled: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each sentence its text's index and the sum of its words' rows of ``values``; ``spelled`` has further words' rows, at their chunks."""
    first, text = _sentences(split)
    if not len(first):
        return text, np.zeros((0, values.shape[1]))
    # In steps of whole sentences, so that memory stays bounded.
    total = np.zeros((len(first), values.shape[1]))
    cuts = np.searchsorted(first, np.arange(0, len(split.code), 1 << 16))
    for a, b in zip(cuts, [*cuts[1:], len(first)], strict=True):
        if b > a:
            end = first[b] if b < len(first) else len(split.code)
            total[a:b] = np.add.reduceat(values[split.code[first[a] : end]], first[a:b] - first[a], axis=0)
    if len(at):
        np.add.at(total, np.searchsorted(first, at, side="right") - 1, spelled)
    return text, total


def sentence_kernels(split: _Split, model: ToxicityModel, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """For each sentence its text's index and its kernels with all landmarks, or with ``weights`` their weighted sum."""
    spelt = _spelled(split)
    others = pa.array([letters(w) for _, w in spelt], pa.large_string())
    values, extra = model.word_kernels(split.plain, weights), model.word_kernels(others, weights)
    values[_begins(split.plain, model.left_out)] = 0
    return sentence_sums(split, values, extra, np.array([p for p, _ in spelt], np.int64))


def _begins(plain: pa.Array, starts: list[str]) -> np.ndarray:
    """Which words begin with one of the starts."""
    out = np.zeros(len(plain), bool)
    for n in {len(s) for s in starts}:
        out |= np.asarray(pc.is_in(pc.utf8_slice_codeunits(plain, 0, n), value_set=pa.array([s for s in starts if len(s) == n], pa.large_string())))
    return out


def _document_windows(left_out: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Counts over a partition's toxic and clean documents of the letter windows in each, but for words with the starts that are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, Counter[str]] = {0: Counter(), 1: Counter()}

        def counted(label: int) -> pa.RecordBatch:
            n, none = pa.array(list(total[label].values()), pa.int64()), pa.array(np.zeros(len(total[label]), np.int64))
            return pa.RecordBatch.from_arrays([pa.array(list(total[label]), pa.string()), *((n, none) if label else (none, n))], ["w", "toxic", "clean"])

        for batch in batches:
            for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True):
                found: set[str] = set()
                for word in {letters(w) for w in set(text.split())}:
                    if not word.startswith(tuple(left_out)):
                        for n in LENGTHS:
                            found.update([word[i : i + n] for i in range(len(word) - n + 1)])
                total[label].update(found)
                if len(total[label]) > COUNTED:
                    yield counted(label)
                    total[label].clear()
        yield from map(counted, total)

    return run


def _telling(counted: DataFrame, toxic: int, clean: int) -> DataFrame:
    """``w, toxic, clean, ratio`` of strings met in enough toxic documents and, by share, so many times less in others."""
    ratio = (F.col("toxic") / toxic) / ((F.col("clean") + 0.5) / clean)
    return counted.withColumn("ratio", ratio).where((F.col("toxic") >= LEAST_DOCS) & (F.col("ratio") >= LEAST_RATIO))


def _counted(sample: DataFrame, counts) -> DataFrame:
    return sample.select("text", "label").mapInArrow(counts, "w string, toxic long, clean long").groupBy("w").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _choose_landmarks(sample: DataFrame, toxic: int, clean: int, left_out: list[str] | None = None) -> list[str]:
    """Letter windows that are met in toxic documents and hardly in others, most telling first, none much like one before.

    All windows are counted in all documents of the sample; only telling ones reach the driver.
    """
    telling = _telling(_counted(sample, _document_windows(left_out or [])), toxic, clean).collect()
    chosen: list[str] = []
    for r in sorted(telling, key=lambda r: (-r.toxic, -len(r.w), r.w)):
        if len(chosen) < LANDMARKS and all(kernel(r.w, c) < 0.5 for c in chosen):
            chosen.append(r.w)
    return chosen


def _document_starts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts over a partition's toxic and clean documents of the starts that ``START_TIMES`` words of one begin with."""
    total: dict[str, list[int]] = {}
    for batch in batches:
        for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True):
            found: Counter[str] = Counter()
            for word, k in Counter(map(letters, text.split())).items():
                for n in START_LENGTHS:
                    if len(word) >= n:
                        found[word[:n]] += k
            for w, k in found.items():
                if k >= START_TIMES:
                    total.setdefault(w, [0, 0])[label] += 1
    yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), *[pa.array([n[k] for n in total.values()], pa.int64()) for k in (1, 0)]], ["w", "toxic", "clean"])


def _choose_starts(sample: DataFrame, toxic: int, clean: int) -> list[str]:
    """Word starts that toxic documents repeat and others hardly do, most telling first, none the start of another."""
    telling = _telling(_counted(sample, _document_starts), toxic, clean).collect()
    chosen: list[str] = []
    for r in sorted(telling, key=lambda r: (-r.toxic * math.log(r.ratio), -len(r.w), r.w)):
        if len(chosen) < LANDMARKS and not any(r.w.startswith(c) or c.startswith(r.w) for c in chosen):
            chosen.append(r.w)
    return chosen


def _start_rates(hits: np.ndarray, n_words: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Share of words with each start in toxic documents that repeat it, and in clean ones that have it (in all where none does)."""
    rates = np.ones((2, hits.shape[1]))
    for k in range(hits.shape[1]):
        own = hits[:, k]
        clean = (label == 0) & (own > 0)
        for i, of in enumerate([(label == 1) & (own >= START_TIMES), clean if clean.any() else label == 0]):
            rates[i, k] = (own[of].sum() + 0.5) / (n_words[of].sum() + 1)
    rates[0] = np.maximum(rates[0], 1.01 * rates[1])
    return rates


def _kernel_blocks(kernels: np.ndarray, rows: np.ndarray) -> Iterator[np.ndarray]:
    """The chosen rows of the sentences' kernels as doubles, ``FIT_ROWS`` at a time: the kernels are held once, in single precision."""
    for a in range(0, len(rows), FIT_ROWS):
        yield kernels[rows[a : a + FIT_ROWS]].astype(float)


def _values(kernels: np.ndarray, rows: np.ndarray, weights: np.ndarray, bias: float) -> np.ndarray:
    """Values of the chosen rows."""
    return np.concatenate([np.zeros(0), *[part @ weights + bias for part in _kernel_blocks(kernels, rows)]])


def _fit_svm(kernels: np.ndarray, y: np.ndarray, gram: np.ndarray, balance: float, cost: float = 1.0, rounds: int = 200, use: np.ndarray | None = None) -> tuple[np.ndarray, float]:
    """A support vector machine with squared hinge loss whose landmarks all count for toxicity: weights of the landmarks and the bias.

    In Nyström features the weights are ``gram ** 0.5 @ raise``, so their length is ``raise @ gram @ raise``. Landmarks are
    chosen as what toxic documents hold, so none may lower a sentence: ``raise`` is kept at 0 or more, by Newton steps on
    the weights that are not held at 0. It is fitted on the rows ``use`` of ``kernels`` (None: all), whose labels are ``y``; sums run over blocks of them.
    """
    use = np.arange(len(kernels)) if use is None else use
    ridge = np.eye(kernels.shape[1] + 1)
    ridge[:-1, :-1] = gram + 1e-6 * np.eye(len(gram))
    sign = np.where(y > 0, 1.0, -1.0)
    c = np.where(y > 0, balance, 1.0) * cost
    w = np.zeros(len(ridge))

    def loss(w: np.ndarray) -> float:
        return 0.5 * w @ ridge @ w + float((c * np.maximum(0.0, 1 - sign * _values(kernels, use, w[:-1], w[-1])) ** 2).sum())

    for _ in range(rounds):
        inside = np.flatnonzero(sign * _values(kernels, use, w[:-1], w[-1]) < 1)
        slope, curve, at = ridge @ w, ridge.copy(), 0
        for part in _kernel_blocks(kernels, use[inside]):
            own = np.hstack([part, np.ones((len(part), 1))])
            rows = inside[at : at + len(part)]
            at += len(part)
            weight = 2 * c[rows]
            slope -= own.T @ (weight * (sign[rows] - own @ w))
            curve += (own.T * weight) @ own
        free = (w > 0) | (slope < 0)
        free[-1] = True
        step = np.zeros(len(w))
        step[free] = np.linalg.solve(curve[np.ix_(free, free)], slope[free])
        size, now, at = 1.0, loss(w), w
        while size > 1e-6:
            at = w - size * step
            at[:-1] = np.maximum(at[:-1], 0.0)
            if loss(at) <= now:
                break
            size /= 2
        else:
            break
        moved = np.abs(at - w).max()
        w = at
        if moved < 1e-8:
            break
    return w[:-1], float(w[-1])


def _single_kernels(column: pa.ChunkedArray, place: np.ndarray, width: int) -> np.ndarray:
    """The kernels held in a column's strings, each row at its place, without a copy beside the column's own."""
    x, at = np.zeros((len(place), width), "<f4"), 0
    for chunk in column.chunks:
        x[place[at : at + len(chunk)]] = raw(chunk)[0].view("<f4").reshape(-1, width)
        at += len(chunk)
    return x


def _with_a_letter_more(texts: pa.Array) -> pa.Array:
    """Each word of four letters or more with an x put in about its middle."""
    return pc.replace_substring_regex(texts, r"(\pL{5})(\pL{3,})|(\pL{2,3})(\pL{2,})", r"\1\3x\2\4")


def train_toxicity(docs: DataFrame, labels: DataFrame, *, label: str = "toxic", folds: int = 3, held_out: int | None = 1, limit: int = TRAIN_LIMIT, id_col: str = "doc_id", text_col: str = "text") -> ToxicityModel:
    """Fit on at most ``limit`` labelled documents outside the fold ``held_out`` (None: all).

    Of each document the sentences that hold a landmark are used, and the ``SENTENCES`` of largest kernel with any. A clean
    document's are all clean; of a toxic one those that hold a landmark are taken as toxic, and the one that scores highest, first
    by its largest kernel with a landmark and then by the machine itself, which is fitted twice more. Toxic documents are used once more with a letter
    put into every longer word, so that what hides an insult counts as one. Documents' best sentences, how often their
    words have the chosen starts, and both joined are calibrated on the sample. Without toxic or clean rows every score is 0.
    """
    keep = F.lit(True) if held_out is None else fold(id_col, folds) != held_out
    sample = labelled_sample(docs, labels, label, keep, limit, id_col=id_col, text_col=text_col).cache()
    sizes = {r.label: r["count"] for r in sample.groupBy("label").count().collect()}
    both = len(sizes) == 2
    starts = _choose_starts(sample, sizes[1], sizes[0]) if both else []

    def repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, limit=SLICE_BYTES):
                hits, n_words = start_hits(_split(part.column("text")), starts)
                rows = pa.array([x.tobytes() for x in hits.astype("<i4")], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("label"), pa.array(n_words, pa.int64()), rows], ["id", "label", "n_words", "hits"])

    # Sorted by id (rows that share one by content), so that a fit doesn't depend on order or layout.
    every = sample.mapInArrow(repeats, "id long, label int, n_words long, hits binary").toArrow()
    every = every.sort_by([(c, "ascending") for c in ("id", "label", "n_words", "hits")])
    ids, label = np.asarray(every["id"]), np.asarray(every["label"])
    hits, n_words = np.frombuffer(b"".join(every["hits"].to_pylist()), "<i4").reshape(len(ids), len(starts)).astype(np.int64), np.asarray(every["n_words"])
    had = hits > 0
    left_out = [s for k, s in enumerate(starts) if had[label == 0, k].mean() * LEAST_RATIO >= had[label == 1, k].mean()]
    marks = _choose_landmarks(sample, sizes[1], sizes[0], left_out) if both else []
    if not marks and not starts:
        sample.unpersist()
        return ToxicityModel([], np.zeros((0, 0)), np.zeros(0), -30.0, (np.array([-1.0, 1.0]), np.array([0.0, 1.0])))
    gram, whiten, root = (np.zeros((0, 0)) for _ in range(3))
    if marks:
        gram = np.array([[kernel(a, b) ** POWER for b in marks] for a in marks])
        values, vectors = np.linalg.eigh(gram)
        whiten, root = (vectors @ np.diag(np.maximum(values, 1e-6) ** p) @ vectors.T for p in (-0.5, 0.5))
    model = ToxicityModel(marks, whiten, np.zeros(len(marks)), 0.0, starts=starts, left_out=left_out)
    held = docs.sparkSession.sparkContext.broadcast(model)

    def sentences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, limit=SLICE_BYTES):
                for altered in (False, True):
                    if altered:
                        part = part.filter(pc.equal(part.column("label"), 1))
                    text = part.column("text")
                    row, own = sentence_kernels(_split(_with_a_letter_more(text) if altered else text), held.value)
                    order = np.lexsort((np.arange(len(row)), -own.max(axis=1, initial=0), row))
                    rank = np.arange(len(row)) - np.searchsorted(row[order], row[order])
                    chosen = np.sort(order[(rank < SENTENCES) | (own[order].max(axis=1, initial=0) >= HELD)])
                    kernels = pa.array([x.tobytes() for x in own[chosen].astype("<f4")], pa.binary())
                    at = pa.array(row[chosen])
                    yield pa.RecordBatch.from_arrays([part.column("id").take(at), part.column("label").take(at), pa.array(np.full(len(at), altered)), kernels], ["id", "label", "altered", "kernels"])

    rows = sample.mapInArrow(sentences, "id long, label int, altered boolean, kernels binary").toArrow() if marks else None
    sample.unpersist()
    best, more = np.full(len(ids), model.bias), np.zeros(0)
    if marks:
        order = np.asarray(pc.sort_indices(rows, [(c, "ascending") for c in ("id", "altered", "kernels")]))
        own_id, y, altered = (np.asarray(rows[c])[order] for c in ("id", "label", "altered"))
        x = _single_kernels(rows["kernels"], np.argsort(order), len(marks))
        del rows
        # An altered copy is a document of its own.
        doc = np.unique(np.stack([own_id, altered]), axis=1, return_inverse=True)[1].ravel()
        value = x.max(axis=1, initial=0)
        holds = (y == 1) & (value >= np.where(altered, HELD_ALTERED, HELD))
        for _ in range(3):
            top = np.zeros(len(x), bool)
            order = np.lexsort((value, doc))
            top[order[np.concatenate([doc[order][1:] != doc[order][:-1], np.ones(min(1, len(order)), bool)])]] = True
            use = np.flatnonzero((y == 0) | top | holds)
            raised, model.bias = _fit_svm(x, y[use], gram, balance=2.0, use=use)
            model.weights = root @ raised
            value = _values(x, np.arange(len(x)), raised, model.bias)
        highest = np.full(int(doc.max(initial=-1)) + 1, -np.inf)
        np.maximum.at(highest, doc, value)
        best_of = dict(zip(own_id[~altered].tolist(), highest[doc[~altered]].tolist(), strict=True))
        best = np.array([best_of.get(i, model.bias) for i in ids.tolist()])
        more = highest[np.unique(doc[altered])]
    model.knots = isotonic(np.concatenate([best, more]), np.concatenate([label, np.ones(len(more), label.dtype)]))
    if starts:
        model.rates = _start_rates(hits, n_words, label)
        value = model.start_value(hits, n_words)
        model.start_knots = isotonic(value, label)
        model.both_knots = isotonic(model.either(best, value), label)
    return model


def score_toxicity(docs: DataFrame, model: ToxicityModel, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score`` of every whole text, 0 to 1: by the highest of its sentences and by how often its words have the model's starts.

    Null and empty texts score as a sentence without words; null and repeated ids keep their rows;
    an empty table gives no rows; other columns are ignored.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, limit=SLICE_BYTES):
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(_scores(part.column("text"), held.value))], ["id", "score"])

    chosen = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return chosen.mapInArrow(run, "id long, score double").withColumnRenamed("id", id_col)


def _scores(texts: pa.Array, model: ToxicityModel) -> np.ndarray:
    best, value = np.full(len(texts), model.bias), np.zeros(len(texts))
    if model.landmarks or model.starts:
        split = _split(texts)
    if model.landmarks:
        row, sums_ = sentence_kernels(split, model, model.whiten @ model.weights)
        highest = np.full(len(texts), -np.inf)
        np.maximum.at(highest, row, sums_[:, 0] + model.bias)
        best = np.where(np.isfinite(highest), highest, model.bias)
    if model.starts:
        value = model.start_value(*start_hits(split, model.starts))
    return model.score(best, value)


def drop_toxic(docs: DataFrame, model: ToxicityModel, *, limit: float = 0.7, text_col: str = "text") -> DataFrame:
    """``docs`` with all its columns, whatever their names, without rows that score ``limit`` or more. Each row is judged by its own text."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, text_col, SLICE_BYTES):
                yield part.filter(pa.array(_scores(part.column(text_col), held.value) < limit))

    return docs.mapInArrow(run, docs.schema)
