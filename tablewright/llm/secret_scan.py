"""Secret scans: base patterns, and values in credential contexts that cost many guesses.

The cost of a value is the smallest sum, over all ways to cut it into words, dates, repeats, keyboard
walks and brute-force spans, of the logarithms of guesses for the parts. Words are ranked: a fixed list of what
guessers try first, then the words that most documents hold.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import id_and_text, kept, map_texts, rewrite_rows

# Powers of ten of guesses from which a value counts as a secret: beyond common lists and their variations.
LEAST_COST = 9.0

KINDS = ("assign", "access", "hex", "credential")

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ASSIGN_STEMS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")

# Contexts in which a value may be a credential; the value is the last group.
CONTEXT_STEMS = ("pass", "pwd", "secret", "token", "key", "credential", "bearer", "://")
CONTEXTS = (
    re.compile(
        r"""(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|credentials?|(?:api|access|private|secret|signing|encryption)[ _-]?key)"""
        r"""(?:[_-][a-z0-9]{1,16}){0,3}["'`]?[ \t]{0,8}(?:=>|:=|[:=])[ \t]{0,8}["'`]?([^\s"'`,;<>(){}\[\]]{6,})""",
        re.ASCII | re.IGNORECASE,
    ),
    re.compile(r"\bbearer[ \t]{1,8}([A-Za-z0-9._~+/=-]{6,})", re.ASCII | re.IGNORECASE),
    re.compile(r"://[^\s:/@]{1,64}:([^\s:/@]{6,})@"),
)

# Words that guessers try first, the likeliest in front.
COMMON_WORDS = (
    "password passwd secret token admin root user test example sample changeme default login welcome "
    "letmein qwerty dragon monkey master shadow sunshine princess football baseball superman batman "
    "iloveyou trustno hunter hello freedom whatever ninja access server service system public private "
    "client database value string none null true false placeholder redacted your here insert replace "
    "demo dummy fake foo bar baz key api app auth pass word my the and for not this that with from"
).split()
RANKS = {word: rank for rank, word in enumerate(COMMON_WORDS, 1)}

WORD_END = "</w>"  # how the vocabulary marks a whole word
# The documents' own words: so many at most, of so many letters, each in so many documents at least.
MODEL_WORDS = 50_000
SHORTEST_WORD, LONGEST_WORD = 3, 24
LEAST_DOCS = 5
BINS = 8  # of the number of documents, for each doubling

# Rows of keys, and runs that are typed like them.
ROWS = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm", "abcdefghijklmnopqrstuvwxyz")
NEXT_KEYS = {a + b for row in ROWS for pair in zip(row, row[1:], strict=False) for a, b in (pair, pair[::-1])}

LEET = str.maketrans("@4310$5!7", "aaeiossit")
DATE = re.compile(
    r"(?:19|20)\d\d(?:([-/._]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01]))?"
    r"|(?:0[1-9]|[12]\d|3[01])([-/._]?)(?:0[1-9]|1[0-2])\2(?:19|20)\d\d"
)
SPAN_COST = 0.3  # for the choice of where the next part begins
BRUTE = {"digit": math.log10(10), "lower": math.log10(26), "upper": math.log10(26), "other": math.log10(33)}


def brute_cost(letter: str) -> float:
    kind = "digit" if letter.isdigit() else "lower" if letter.islower() else "upper" if letter.isupper() else "other"
    return BRUTE[kind]


def ranks_of(words: tuple[str, ...]) -> dict[str, int]:
    """Ranks of the fixed words and, behind them, of the given ones."""
    more = (word for word in words if word not in RANKS)
    return RANKS | {word: rank for rank, word in enumerate(more, len(RANKS) + 1)}


def case_cost(part: str) -> float:
    if part.islower():
        return 0.0
    return 0.3 if part.isupper() or part[1:].islower() else len(part) * math.log10(2)


def known_parts(value: str, lower: str, leet: str, start: int, ranks: dict[str, int]) -> Iterator[tuple[int, float]]:
    """Ends and costs of the words and dates that begin at ``start``."""
    for text, more in ((lower, 0.0), (leet, 0.5)) if leet != lower else ((lower, 0.0),):
        for end in range(start + SHORTEST_WORD, min(start + LONGEST_WORD, len(value)) + 1):
            if rank := ranks.get(text[start:end]):
                letters = "".join(c for c in value[start:end] if c.isalpha())
                yield end, math.log10(rank + 1) + more + (case_cost(letters) if letters else 0.0)
    if date := DATE.match(value, start):
        yield date.end(), math.log10(120 if date.end() - start == 4 else 120 * 366)


class Run:
    """Where the last part, inside one run, best begins: the least of cost before it + log10 of its length.

    Of two starts the later one is ahead at first or never, and falls behind once: a stack holds the starts in the
    order in which they will be the best, so that all ends of a run are found without trying all starts.
    """

    def __init__(self):
        self.begin, self.stack = 0, []

    def at(self, end: int, goes_on: bool, best: list[float]) -> float:
        """For the end after letter ``end - 1``, which goes on with the run or begins one; parts have three letters or more."""
        if not goes_on:
            self.begin, self.stack = end - 1, []
        if end - self.begin < 3:
            return math.inf
        self.drop(end)
        new = end - 3
        if not self.stack or best[new] + math.log10(3) < self.cost(self.stack[-1][0], end, best):
            until = math.inf
            while self.stack:
                until = self.behind(self.stack[-1][0], new, best)
                if until < self.stack[-1][1]:
                    break
                self.stack.pop()
                until = math.inf
            self.stack.append((new, until))
        return self.cost(self.stack[-1][0], end, best)

    def drop(self, end: int) -> None:
        while self.stack and self.stack[-1][1] <= end:
            self.stack.pop()

    @staticmethod
    def cost(start: int, end: int, best: list[float]) -> float:
        return best[start] + math.log10(end - start)

    @staticmethod
    def behind(old: int, new: int, best: list[float]) -> float:
        """The end from which the older start is no worse than the newer one."""
        ahead = best[new] - best[old]
        if ahead <= 0:
            return math.inf
        ratio = 10**ahead
        return (ratio * new - old) / (ratio - 1) if ratio > 1 else math.inf


def guess_cost(value: str, ranks: dict[str, int] = RANKS) -> float:
    """Logarithm (base 10) of the guesses for the cheapest segmentation; 0 for an empty value.

    Words may begin at each place, also in leet spelling; repeats and walks may begin and end at each place of a run.
    """
    lower = "".join(x if len(x := c.lower()) == 1 else c for c in value)
    leet = lower.translate(LEET)
    best = [0.0] + [math.inf] * len(value)
    brute = [math.inf] * (len(value) + 1)  # cheapest ways whose last part is brute force
    equal, walk = Run(), Run()
    walked = math.log10(len("".join(ROWS))) + 0.3
    for start in range(len(value) + 1):
        if start:
            last = brute_cost(value[start - 1])
            same = equal.at(start, start > 1 and value[start - 1] == value[start - 2], best)
            near = walk.at(start, start > 1 and lower[start - 2 : start] in NEXT_KEYS, best)
            best[start] = min(best[start], brute[start], SPAN_COST + last + same, SPAN_COST + walked + near)
        if start < len(value):
            here = best[start]
            brute[start + 1] = min(here + SPAN_COST, brute[start]) + brute_cost(value[start])
            for end, cost in known_parts(value, lower, leet, start, ranks):
                best[end] = min(best[end], here + SPAN_COST + cost)
    return best[-1]


def vocabulary_words(file: str) -> tuple[str, ...]:
    """The whole words of a public tokenizer's vocabulary in the order of their numbers, which is about that of their
    frequency in general text: the base of all rankings, whatever the documents."""
    with open(file, encoding="utf-8") as f:
        vocabulary = json.load(f)["model"]["vocab"]
    words = ((number, token.removesuffix(WORD_END)) for token, number in vocabulary.items() if token.endswith(WORD_END))
    return tuple(w for _, w in sorted(words) if SHORTEST_WORD <= len(w) <= LONGEST_WORD and w.isascii() and w.isalpha())


def ranked_words(docs: DataFrame, vocabulary: str | None, *, text_col: str = "text") -> tuple[str, ...]:
    """The vocabulary's words, then those that only the documents have, by their frequency there."""
    base = vocabulary_words(vocabulary) if vocabulary else ()
    return tuple(dict.fromkeys([*base, *fit_words(docs, text_col=text_col)]))


def fit_words(docs: DataFrame, *, text_col: str = "text") -> tuple[str, ...]:
    """The words that most documents hold, most frequent first: MODEL_WORDS at most, whole bins of frequency.

    Counted over all documents, outside the values of credential contexts: a secret does not become a word.
    """
    text = F.col(f"`{text_col}`").cast("string")
    stems = "(?i)" + "|".join(CONTEXT_STEMS)
    masked = text
    for pattern in CONTEXTS:
        masked = F.regexp_replace(masked, "(?i)" + pattern.pattern, " ")
    words = F.array_distinct(F.split(F.lower(F.when(text.rlike(stems), masked).otherwise(text)), r"[^\p{L}]+"))
    counts = kept(
        docs.select(F.explode(words).alias("word")).where(F.length("word").between(SHORTEST_WORD, LONGEST_WORD))
        .groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= LEAST_DOCS)
        .withColumn("bin", F.floor(F.log2("n") * BINS))
    )
    total, least = 0, None
    for row in sorted(counts.groupBy("bin").count().collect(), reverse=True):
        total += row["count"]
        if total > MODEL_WORDS:
            break
        least = row.bin
    if least is None:
        return ()
    rows = counts.where(F.col("bin") >= least).select("n", "word").collect()
    return tuple(r.word for r in sorted(rows, key=lambda r: (-r.n, r.word)))


def base_spans(text: str, lower: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base patterns."""
    out = []
    if any(s in lower for s in ASSIGN_STEMS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return out


def credential_spans(text: str, lower: str, least_cost: float, ranks: dict[str, int] = RANKS) -> list[tuple[int, int, int]]:
    out = set()
    if any(s in lower for s in CONTEXT_STEMS):
        for pattern in CONTEXTS:
            for m in pattern.finditer(text):
                value = m[1].rstrip(".!?:")
                if len(value) >= 6 and guess_cost(value, ranks) >= least_cost:
                    out.add((m.start(1), 3, m.start(1) + len(value)))
    return sorted(out)


def find(text: str, least_cost: float, ranks: dict[str, int] = RANKS) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Base spans, and the method's spans that no base span covers; both sorted by start and kind."""
    lower = text.lower()
    base = base_spans(text, lower)
    more = [x for x in credential_spans(text, lower, least_cost, ranks) if not any(b[0] <= x[0] and x[2] <= b[2] for b in base)]
    return sorted(base), more


def make_finder(least_cost, words=()):
    ranks = ranks_of(words)

    def run(texts):
        out = []
        for text in texts:
            base, more = find(text, least_cost, ranks)
            out.append(
                [{"kind": KINDS[k], "start": a, "end": b, "base": k < 3} for a, k, b in sorted(base + more)]
            )
        return [out]

    return run


def make_redactor(least_cost, mark, words=()):
    ranks = ranks_of(words)

    def run(texts):
        out = []
        for text in texts:
            base, more = find(text, least_cost, ranks)
            parts, end = [], 0
            for a, _, b in sorted(base + more):
                if a >= end:
                    parts += [text[end:a], mark]
                end = max(end, b)
            out.append("".join(parts) + text[end:] if parts else text)
        return [True] * len(texts), out

    return run


def scan_secrets(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", least_cost: float = LEAST_COST,
    words: tuple[str, ...] | None = None, vocabulary: str | None = None,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, spans (kind, start, end, base), by start, then kind.

    Offsets are code points, end exclusive. A null or empty text has no spans; repeated rows get a row
    each; null ids stay null; other columns are ignored. Texts of any length are read whole; an empty table gives no rows.
    Of spans with one start the base ones come first. ``words`` are ranked ones; unless given, those of the file
    ``vocabulary`` of a public tokenizer, and behind them those of ``docs``.
    """
    words = ranked_words(docs, vocabulary, text_col=text_col) if words is None else words
    return map_texts(
        id_and_text(docs, id_col, text_col), ["id"], "text",
        "spans array<struct<kind: string, start: long, end: long, base: boolean>>", make_finder, least_cost, words,
    ).withColumnRenamed("id", "doc_id")


def redact_secrets(docs: DataFrame, *, text_col: str = "text", mark: str = "[SECRET]", least_cost: float = LEAST_COST,
                   words: tuple[str, ...] | None = None, vocabulary: str | None = None) -> DataFrame:
    """All rows and columns of ``docs``; in their texts a mark takes the place of each secret.

    Overlapping spans share a mark. ``n_chars``, where there is such a column, follows a changed text. ``words``
    and ``vocabulary`` are as for ``scan_secrets``.
    """
    words = ranked_words(docs, vocabulary, text_col=text_col) if words is None else words
    return rewrite_rows(docs, text_col, make_redactor, least_cost, mark, words)
