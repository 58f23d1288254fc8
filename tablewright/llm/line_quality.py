"""Quality rules: a linear-chain conditional random field marks lines as content or boilerplate.

Viterbi decoding labels a text's lines; the share of its words in content lines decides whether it is
kept. The field is trained here, on a bounded sample of labelled documents.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import id_and_text, in_sample, map_texts, rewrite_rows, stretch

# Training reads about this many documents of either label, twice as many at most, of at most so many characters each.
SAMPLE_DOCS = 800
SAMPLE_CHARS = 10_000
TRAIN_STEPS = 100
LEAST_SHARE = 0.5
LEAST_WORDS = 50
MOST_REPEATED = 50  # percent of words

SYMBOLS = b"#*$%&|<>"
UPPER = bytes(range(65, 91))
DIGITS = bytes(range(48, 58))
ENDS = b".!?"
FEATURES = (
    "bias", "words", "short", "symbols", "some_symbols", "upper", "digits", "ends", "exclaims", "word_length",
    "repeats", "repeated_line", "first", "last", "only", "same_as_before",
)


def line_features(lines: list[bytes]) -> np.ndarray:
    """One row per line that holds a word."""
    out, seen, before = [], set(), None
    for line in lines:
        found = line.split()
        n, size = len(found), len(line)
        symbols = size - len(line.translate(None, SYMBOLS))
        repeats = 1 - len(set(found)) / n
        out.append((
            1, min(n, 60) / 60, n < 4, min(symbols / n, 3), symbols > 0, (size - len(line.translate(None, UPPER))) / size,
            (size - len(line.translate(None, DIGITS))) / size, line.rstrip()[-1] in ENDS, min(line.count(b"!") / n, 2),
            min(size / n, 20) / 10, repeats, line in seen, before is None, 0, 0, line == before,
        ))
        seen.add(line)
        before = line
    table = np.array(out, np.float64).reshape(-1, len(FEATURES))
    if len(table):
        table[-1, FEATURES.index("last")] = 1
        table[:, FEATURES.index("only")] = len(table) == 1
    return table


@dataclass(frozen=True)
class LineField:
    """Weights of two states (0 boilerplate, 1 content) and transitions [from, to]."""

    weights: np.ndarray
    moves: np.ndarray

    @staticmethod
    def all_content() -> LineField:
        weights = np.zeros((len(FEATURES), 2))
        weights[0, 1] = 1.0
        return LineField(weights, np.zeros((2, 2)))

    def decode(self, tables: list[np.ndarray]) -> list[np.ndarray]:
        """Viterbi labels per text. Texts go side by side, longest first: a step handles all that reach it."""
        order = sorted(range(len(tables)), key=lambda i: -len(tables[i]))
        out: list[np.ndarray] = [np.zeros(0, np.int8)] * len(tables)
        order = [i for i in order if len(tables[i])]
        if not order:
            return out
        lengths = np.array([len(tables[i]) for i in order])
        first = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        scores = np.concatenate([tables[i] for i in order]) @ self.weights
        state = scores[first].copy()
        back = np.zeros((len(scores), 2), np.int8)
        for step in range(1, lengths[0]):
            n = np.searchsorted(-lengths, -step, "left")  # texts longer than step
            ways = state[:n, :, None] + self.moves
            back[first[:n] + step] = ways.argmax(1)
            state[:n] = ways.max(1) + scores[first[:n] + step]
        for k, i in enumerate(order):
            label = int(state[k].argmax())
            path = np.zeros(lengths[k], np.int8)
            for step in range(lengths[k] - 1, -1, -1):
                path[step] = label
                label = back[first[k] + step, label]
            out[i] = path
        return out


def train_field(tables: list[np.ndarray], labels: list[np.ndarray], start: LineField | None = None,
                steps: int = TRAIN_STEPS, penalty: float = 1e-3) -> LineField:
    """Maximum likelihood by gradient ascent (Adam) with forward-backward; the objective is convex.

    Texts lie longest first, so that a step handles the first n of them, those that reach it.
    """
    order = sorted(range(len(tables)), key=lambda i: -len(tables[i]))
    lengths = np.array([len(tables[i]) for i in order])
    most = int(lengths[0])
    x = np.zeros((most, len(order), len(FEATURES)))
    y = np.zeros((most, len(order)), np.int64)
    for k, i in enumerate(order):
        x[: lengths[k], k], y[: lengths[k], k] = tables[i], labels[i]
    reach = [int((lengths > t).sum()) for t in range(most)]
    there = np.arange(most)[:, None] < lengths
    gold = np.eye(2)[y] * there[..., None]
    gold_moves = np.einsum("tki,tkj->ij", gold[:-1] * there[1:, :, None], gold[1:])
    total = there.sum()
    w, m = (start.weights.copy(), start.moves.copy()) if start else (np.zeros((len(FEATURES), 2)), np.zeros((2, 2)))
    means = [np.zeros_like(w), np.zeros_like(m)]
    squares = [np.zeros_like(w), np.zeros_like(m)]
    for step in range(1, steps + 1):
        s = x @ w
        ahead, after = s.copy(), np.zeros_like(s)
        for t in range(1, most):
            n, before = reach[t], ahead[t - 1]
            ahead[t, :n] += np.logaddexp(before[:n, :1] + m[0], before[:n, 1:] + m[1])
        for t in range(most - 2, -1, -1):
            n = reach[t + 1]
            then = s[t + 1, :n] + after[t + 1, :n]
            after[t, :n] = np.logaddexp(then[:, :1] + m[:, 0], then[:, 1:] + m[:, 1])
        whole = np.logaddexp(*(ahead[0] + after[0]).T)
        share = np.exp(np.minimum(ahead + after - whole[:, None], 0)) * there[..., None]
        then = (s[1:] + after[1:] - whole[:, None])[:, :, None, :]
        pair = np.exp(np.minimum(ahead[:-1, :, :, None] + m + then, 0)) * there[1:, :, None, None]
        slopes = (
            np.einsum("tkf,tks->fs", x, gold - share, optimize=True) / total - penalty * w,
            (gold_moves - pair.sum((0, 1))) / total - penalty * m,
        )
        for value, slope, mean, square in zip((w, m), slopes, means, squares, strict=True):
            mean += 0.1 * (slope - mean)
            square += 0.01 * (slope**2 - square)
            value += 0.2 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    return LineField(w, m)


def split_lines(text: str) -> list[bytes]:
    return [x for x in text.encode("utf-8", "surrogatepass").split(b"\n") if x.split()]


def fit_line_field(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                   label_col: str = "quality", sample_docs: int = SAMPLE_DOCS) -> LineField:
    """Train on the lines of labelled documents: about ``sample_docs`` of either label, by a hash of the id.

    A bad document's lines begin as boilerplate; those that a first fit finds to be content although
    the document is bad become content for the second. Without documents of both labels every line is content.
    """
    marked = labels.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{label_col}`").cast("int").alias("good"))
    counts = {r["good"]: r["count"] for r in marked.groupBy("good").count().collect()}
    chosen = F.lit(False)
    for good in (0, 1):
        chosen = chosen | ((F.col("good") == good) & in_sample(sample_docs, counts.get(good, 0), "id"))
    sample = marked.where(chosen).distinct().limit(4 * sample_docs)
    found = (
        id_and_text(docs, id_col, text_col).join(F.broadcast(sample), "id")  # at most 4 * sample_docs rows
        .where(F.length("text") > 0).select("id", "good", stretch("text", SAMPLE_CHARS, "id").alias("text"), "text")
        .toDF("id", "good", "part", "text").withColumn("cut", F.length("text") > SAMPLE_CHARS).drop("text")
        .limit(4 * sample_docs).collect()
    )
    found = sorted(found, key=lambda r: (r.id, r.good, r.part))
    tables, targets = [], []
    for row in found:
        lines = split_lines(row.part)
        # The first and the last line of a stretch may be parts of lines.
        lines = lines[1:-1] if row.cut and len(lines) > 2 else lines
        if lines:
            tables.append(line_features(lines))
            targets.append(np.full(len(lines), row.good, np.int64))
    if len({int(t[0]) for t in targets}) < 2:
        return LineField.all_content()
    first = train_field(tables, targets)
    bad = [i for i, t in enumerate(targets) if t[0] == 0]
    for i, path in zip(bad, first.decode([tables[i] for i in bad]), strict=True):
        if not path.all():  # a bad document keeps some boilerplate
            targets[i] = path.astype(np.int64)
    return train_field(tables, targets, first)


def repeated_words(numbers: np.ndarray) -> int:
    """Words inside a window of three that the text holds at least twice."""
    n = len(numbers) - 2
    if n < 2:
        return 0
    base = int(numbers.max()) + 1
    _, pair = np.unique(numbers[:-1] * base + numbers[1:], return_inverse=True)
    _, window, many = np.unique(pair[:n] * base + numbers[2:], return_inverse=True, return_counts=True)
    again = many[window] > 1
    covered = np.zeros(n + 2, bool)
    for k in range(3):
        covered[k : k + n] |= again
    return int(covered.sum())


def make_judge(field: LineField, least_share: float):
    def judge(texts):
        counts, tables, sizes = [], [], []
        for text in texts:
            raw = text.encode("utf-8", "surrogatepass")
            found = raw.split()
            places: dict[bytes, int] = {}
            numbers = np.array([places.setdefault(w, len(places)) for w in found], np.int64)
            lines = [x for x in raw.split(b"\n") if x.split()]
            counts.append((
                len(found), len(text) - sum(map(text.count, " \t\n\v\f\r")), len(raw) - len(raw.translate(None, SYMBOLS)),
                len(lines) - len(set(lines)), repeated_words(numbers),
            ))
            tables.append(line_features(lines))
            sizes.append(np.array([len(x.split()) for x in lines]))
        out = []
        for (n, *more), path, size in zip(counts, field.decode(tables), sizes, strict=True):
            failed = n < LEAST_WORDS or 100 * more[3] > MOST_REPEATED * n
            share = float((path * size).sum() / n) if n else 0.0
            out.append((n, *more, failed, share, not failed and share >= least_share))
        return [list(c) for c in zip(*out, strict=True)]

    return judge


def make_filter(field, least_share):
    judge = make_judge(field, least_share)
    return lambda texts: (judge(texts)[-1], None)


def judge_quality(docs: DataFrame, field: LineField, *, id_col: str = "doc_id", text_col: str = "text",
                  least_share: float = LEAST_SHARE) -> DataFrame:
    """One row per row of ``docs``: doc_id, the counts, base_failed, content_share, kept.

    Null and empty texts have no words and fail. Repeated rows get a row each; null ids stay null;
    other columns are ignored.
    """
    schema = (
        "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
        "base_failed boolean, content_share double, kept boolean"
    )
    return map_texts(
        id_and_text(docs, id_col, text_col), ["id"], "text", schema, make_judge, field, least_share
    ).withColumnRenamed("id", "doc_id")


def keep_good(docs: DataFrame, field: LineField, *, text_col: str = "text", least_share: float = LEAST_SHARE) -> DataFrame:
    """The rows of ``docs`` that are kept, all columns."""
    return rewrite_rows(docs, text_col, make_filter, field, least_share)
