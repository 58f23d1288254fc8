"""Language identification: a linear-chain conditional random field labels the words of a text.

Affix, n-gram and lexicon features of a word are hashed; the languages' weights and the transitions between
them are trained here. Forward-backward gives each word's probabilities, and a text's language is the one
with the largest share of them, so that code-switched text is judged by all its words.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import re
import sys
import unicodedata
import zlib
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import id_and_text, in_sample, map_texts, stretch

# Training reads about this many documents of each language, twice as many at most, and of each a stretch of at most
# so many characters.
SAMPLE_DOCS = 300
SAMPLE_CHARS = 20_000
SEQUENCES = 1_500  # code-switched sequences made of the sample's words
SEQUENCE_WORDS = 48
EPOCHS = 6
DIMENSIONS = 1 << 16
CACHED_WORDS = 300_000
HASHED_PARTS = 100_000
UNKNOWN = "und"


def ranges(held: Callable[[str], bool], end: int) -> str:
    """The characters below ``end`` that are held, for a class of a pattern."""
    found: list[list[int]] = []
    for c in (c for c in range(end) if held(chr(c))):
        if found and c == found[-1][1] + 1:
            found[-1][1] = c
        else:
            found.append([c, c])
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in found)


def is_mark(c: str) -> bool:
    """Vowel signs, accents and the joiners of letters: they belong to the word that they stand in."""
    return unicodedata.category(c)[0] == "M" or c in "\u200c\u200d"


def is_of_word(c: str) -> bool:
    return c.isalnum() and not c.isdecimal() or is_mark(c)


# Most texts have no marks. The class with them is a look-up up to U+FFFF and slow beyond, so it is kept for who needs it.
PLAIN = re.compile(r"[^\W\d_]+")
MARK = re.compile(f"[{ranges(is_mark, 0x10000)}]")
ASTRAL = re.compile("[\U00010000-\U0010ffff]")
MARKED = re.compile(f"[{ranges(is_of_word, 0x10000)}]+")


@functools.lru_cache(1)
def whole_class() -> re.Pattern:
    return re.compile(f"[{ranges(is_of_word, sys.maxunicode + 1)}]+")


def runs_of_letters(text: str) -> list[str]:
    if text.isascii():
        return PLAIN.findall(text)
    if ASTRAL.search(text):
        return whole_class().findall(text)
    return (MARKED if MARK.search(text) else PLAIN).findall(text)


PIECE = 24  # a longer run of letters, as in scripts without spaces, is a sequence of words of at most so many


def words_of(text: str) -> list[str]:
    """Runs of letters and their marks in lower case; a long one in pieces that share two letters, so that each trigram is in one of them."""
    runs = runs_of_letters(text.lower())
    if not runs or max(map(len, runs)) <= PIECE:
        return runs
    out = []
    for word in runs:
        if len(word) <= PIECE:
            out.append(word)
        else:
            out += [word[i : i + PIECE] for i in range(0, len(word) - 2, PIECE - 2)]
    return out


class Hashed(dict):
    """Numbers of a kind's parts of words; the same few come back in most words."""

    def __init__(self, kind: str):
        super().__init__()
        self.kind = kind

    def __missing__(self, part: str) -> int:
        if len(self) >= HASHED_PARTS:
            self.clear()
        number = self[part] = zlib.crc32((self.kind + part).encode()) % DIMENSIONS
        return number


TRIGRAM, PREFIX, SUFFIX = (Hashed(kind).__getitem__ for kind in "gps")


def features(word: str) -> list[int]:
    """Hashed lexicon entry, affixes up to four letters, and trigrams."""
    framed = f"^{word}$"
    found = [TRIGRAM(part) for part in sorted({framed[i : i + 3] for i in range(len(framed) - 2)})]
    found += [PREFIX(framed[:n]) for n in range(2, min(5, len(framed)) + 1)]
    found += [SUFFIX(part) for part in sorted(framed[-n:] for n in range(2, min(5, len(framed)) + 1))]
    found.append(zlib.crc32(f"w{word}".encode()) % DIMENSIONS)
    return found


@dataclass(frozen=True)
class WordField:
    languages: tuple[str, ...]
    weights: np.ndarray  # features x languages
    moves: np.ndarray  # from x to


def marginals(scores: np.ndarray, lengths: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probabilities of each word's labels, texts one after the other in ``scores``, longest first; expected moves.

    Scaled forward-backward: each step handles all texts that reach it.
    """
    begin = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    shown = np.exp(scores - scores.max(1, keepdims=True))
    step = np.exp(moves - moves.max())
    ahead = shown.copy()
    n_at = [len(lengths)]
    pairs = np.zeros_like(step)
    now = ahead[begin] / ahead[begin].sum(1, keepdims=True)
    ahead[begin] = now
    for t in range(1, int(lengths[0])):
        n = int(np.searchsorted(-lengths, -t, "left"))
        n_at.append(n)
        at = begin[:n] + t
        now = (now[:n] @ step) * shown[at]
        now /= now.sum(1, keepdims=True)
        ahead[at] = now
    after = np.ones((len(lengths), scores.shape[1]))
    for t in range(int(lengths[0]) - 2, -1, -1):
        n = n_at[t + 1]
        at = begin[:n] + t + 1
        then = after[:n] * shown[at]
        new = then @ step.T
        size = new.sum(1, keepdims=True)
        before = ahead[begin[:n] + t]
        pairs += (before / (before * new).sum(1, keepdims=True)).T @ then * step
        after[:n] = new / size
        ahead[begin[:n] + t] = before * after[:n]
    return ahead / ahead.sum(1, keepdims=True), pairs


MOST_DROP = 300.0  # by so many powers of e a row may fall before it is scaled again


def shares_of_texts(scores: np.ndarray, places: np.ndarray, lengths: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """The mean of each text's ``marginals``; ``places`` are its words' rows of ``scores``, texts one after the other, longest first.

    The words lie by their place in the text here, so that a step is a slice. A row is scaled only as often as it must be.
    """
    n, longest = len(lengths), int(lengths[0])
    width = np.searchsorted(-lengths, -np.arange(longest), "left")  # texts that reach a step
    start = np.concatenate([[0], np.cumsum(width)])
    begin = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    text = np.arange(start[-1]) - np.repeat(start[:-1], width)
    step = np.exp(moves - moves.max())
    every = max(1, int(MOST_DROP / max(1.0, moves.max() - moves.min())))
    words, place = np.unique(places[begin[text] + np.repeat(np.arange(longest), width)], return_inverse=True)
    likely = scores[words].astype(np.float64)
    shown = np.exp(likely - likely.max(1, keepdims=True))[place]
    ahead = np.empty_like(shown)
    bounds, widths = start.tolist(), width.tolist()
    ahead[:n] = now = shown[:n] / shown[:n].sum(1, keepdims=True)
    for t in range(1, longest):
        now = np.dot(now[: widths[t]], step, out=ahead[bounds[t] : bounds[t + 1]])
        now *= shown[bounds[t] : bounds[t + 1]]
        if t % every == 0:
            now /= now.sum(1, keepdims=True)
    after, back = np.ones((n, scores.shape[1])), np.ascontiguousarray(step.T)
    for t in range(longest - 1, 0, -1):
        then, m = shown[bounds[t] : bounds[t + 1]], widths[t]
        then *= after[:m]
        now = np.dot(then, back, out=after[:m])
        if t % every == 0:
            now /= now.sum(1, keepdims=True)
        ahead[bounds[t - 1] : bounds[t - 1] + m] *= now
    ahead /= ahead.sum(1, keepdims=True)
    return np.stack([np.bincount(text, ahead[:, k], n) for k in range(ahead.shape[1])], 1) / lengths[:, None]


def train_field(samples: dict[str, list[list[str]]], seed: int = 7) -> WordField:
    """Train on sequences made of runs of words from documents of one language each.

    The runs change language as code-switched text does, which is what the transitions learn from. Adagrad
    on the field's likelihood, whose slope is what is observed less what forward-backward expects.
    """
    languages = tuple(sorted(samples))
    n = len(languages)
    random = np.random.default_rng(seed)
    weights, moves = np.zeros((DIMENSIONS, n)), np.zeros((n, n))
    if n < 2:
        return WordField(languages, weights, moves)
    known: dict[str, list[int]] = {}
    sequences = []
    for _ in range(SEQUENCES):
        line, label = [], []
        while len(line) < SEQUENCE_WORDS:
            language = int(random.integers(n))
            texts = samples[languages[language]]
            text = texts[int(random.integers(len(texts)))]
            start = int(random.integers(len(text)))
            run = text[start : start + int(random.integers(3, SEQUENCE_WORDS))]
            line += run
            label += [language] * len(run)
        sequences.append(([known.setdefault(w, features(w)) for w in line[:SEQUENCE_WORDS]], label[:SEQUENCE_WORDS]))
    grown, grown_moves = np.full_like(weights, 1e-2), np.full_like(moves, 1e-2)
    size = 50
    lengths = np.full(size, SEQUENCE_WORDS)
    for _ in range(EPOCHS):
        order = random.permutation(len(sequences))
        for first in range(0, len(order) - size + 1, size):
            part = [sequences[i] for i in order[first : first + size]]
            hashed = [f for line, _ in part for f in line]
            counts = np.array([len(f) for f in hashed])
            flat = np.concatenate(hashed)
            starts = np.concatenate([[0], np.cumsum(counts)[:-1]])
            scores = np.add.reduceat(weights[flat], starts)
            gold = np.eye(n)[np.concatenate([label for _, label in part])]
            share, pairs = marginals(scores, lengths, moves)
            wrong = (gold - share) / len(gold)
            slope = np.stack([np.bincount(flat, np.repeat(wrong[:, k], counts), DIMENSIONS) for k in range(n)], 1)
            grown += slope**2
            weights += 0.5 * slope / np.sqrt(grown)
            g = gold.reshape(size, -1, n)
            slope = (np.einsum("kti,ktj->ij", g[:, :-1], g[:, 1:]) - pairs) / len(gold)
            grown_moves += slope**2
            moves += 0.5 * slope / np.sqrt(grown_moves)
    return WordField(languages, weights, moves)


def fit_word_field(docs: DataFrame, use: Column, *, id_col: str = "doc_id", text_col: str = "text",
                   lang_col: str = "lang", sample_docs: int = SAMPLE_DOCS) -> WordField:
    """Train on documents where ``use`` holds and the language is known: of each language about ``sample_docs``, by a
    hash of the id. A table without any gives a field without languages."""
    known = docs.where(use).where(F.col(f"`{lang_col}`").isNotNull()).select(
        F.col(f"`{lang_col}`").alias("lang"), F.col(f"`{text_col}`").alias("text"), F.col(f"`{id_col}`").cast("string").alias("id"),
    )
    counts = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    chosen = F.lit(False)
    for lang, count in sorted(counts.items()):
        chosen = chosen | ((F.col("lang") == lang) & in_sample(sample_docs, count, "id", "text"))
    part = stretch("text", SAMPLE_CHARS, "id").alias("text")
    rows = known.where(chosen & (F.length("text") > 0)).select("lang", "id", part).limit(2 * sample_docs * max(1, len(counts))).collect()
    samples: dict[str, list[list[str]]] = {}
    for row in sorted(rows, key=lambda r: (r.lang, r.id or "", r.text)):
        if line := words_of(row.text):
            samples.setdefault(row.lang, []).append(line)
    return train_field(samples)


@functools.lru_cache(1)
def worker_cache(languages: tuple[str, ...], content: bytes) -> list:
    """Places and scores of words that a worker has met, kept from one task of a field to the next."""
    return [{}, np.zeros((0, len(languages)), np.float32)]


def make_labeller(field: WordField):
    n = len(field.languages)
    weights = field.weights.astype(np.float32)
    known = worker_cache(field.languages, hashlib.sha256(weights.tobytes()).digest())

    def scored(words: list[str]) -> np.ndarray:
        """The places of the words in the scores, which new ones are added to."""
        places = known[0]
        numbers = list(map(places.get, words))
        if None in numbers:
            new = sorted(set(words).difference(places))
            blocks = [known[1]]
            for first in range(0, len(new), 50_000):
                hashed = [features(w) for w in new[first : first + 50_000]]
                starts = np.concatenate([[0], np.cumsum([len(f) for f in hashed])[:-1]])
                flat = np.fromiter(itertools.chain.from_iterable(hashed), np.int64)
                blocks.append(np.add.reduceat(weights[flat], starts))
            known[1] = np.concatenate(blocks)
            places.update(zip(new, range(len(places), len(places) + len(new)), strict=True))
            numbers = list(map(places.__getitem__, words))
        return np.array(numbers)

    def label(texts):
        lines = [words_of(t) for t in texts]
        # Some numerals are word characters too; they alone tell no language.
        lines = [x if any(c.isalpha() for w in x for c in w) else [] for x in lines]
        order = [i for i in sorted(range(len(lines)), key=lambda i: -len(lines[i])) if lines[i]]
        langs, shares = [UNKNOWN] * len(texts), [0.0] * len(texts)
        if not order or not n:
            return langs, shares
        if len(known[0]) > CACHED_WORDS:
            known[0].clear()
            known[1] = known[1][:0]
        lengths = np.array([len(lines[i]) for i in order])
        numbers = scored(list(itertools.chain.from_iterable(lines[i] for i in order)))
        mean = shares_of_texts(known[1], numbers, lengths, field.moves)
        for i, row in zip(order, mean, strict=True):
            best = int(row.argmax())
            langs[i], shares[i] = field.languages[best], float(min(row[best], 1.0))
        return langs, shares

    return label


def identify_language(docs: DataFrame, field: WordField, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, lang_pred, score (the language's mean share of words).

    A text that is null, empty or without letters is ``und`` with score 0, as is every text when the field knows no
    language. Equal shares go to the language first in the alphabet. Null ids stay null; other columns are ignored.
    """
    return map_texts(
        id_and_text(docs, id_col, text_col), ["id"], "text", "lang_pred string, score double", make_labeller, field
    ).withColumnRenamed("id", "doc_id")
