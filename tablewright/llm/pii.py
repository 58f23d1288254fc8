"""Personal data: candidate spans from wide generators, judged by boosted trees on format and context.

Base patterns (email, ip, card, phone) always stand. Wider patterns propose more spans, which may overlap (each run of
neighbouring groups of digits is one); trees trained here score them, and a threshold per kind, set on held-out
candidates, selects what is added.
"""

from __future__ import annotations

import re
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import id_and_text, in_sample, map_texts, rewrite_rows

KINDS = ("email", "ip", "card", "phone")

# Training looks for an @ or digits in about this many documents; of a text above so many characters it takes
# a window around the first of them.
SAMPLE_DOCS = 10_000
SAMPLE_CHARS = 20_000
STRETCH, AHEAD = 2_000, 200
SOUGHT = "@|[0-9]{3}"
LEAST_PRECISION = 0.98
# Texts with made-up spans, and how much of a text lies on either side.
MADE_TEXTS, MADE_AROUND = 150, 150
TREES, DEPTH, RATE = 60, 4, 0.3
# Candidates that are described at a time.
BLOCK = 20_000

DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A lookbehind spares starts inside a run of digits, from which no other match could come.
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile("[0-9]")

# Wider: obfuscated addresses, and chains of digit groups with the marks that people put between them.
WIDE_EMAIL = re.compile(
    r"[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}\s?(?:@|[\[(]\s?at\s?[\])]|\bat\b)\s?[A-Za-z0-9-]{1,63}"
    r"(?:\s?(?:\.|[\[(]\s?dot\s?[\])]|\bdot\b)\s?[A-Za-z0-9-]{1,63}){1,4}", re.IGNORECASE
)
AT_MARK = re.compile(r"[\[(]\s?at\s?[\])]")
CHAIN = re.compile(r"[0-9]+(?:[\x20().\-/]{1,2}[0-9]+)*")
GROUP = re.compile("[0-9]+")
LEAST_DIGITS, MOST_DIGITS = 7, 19
# Matches are empty, so that each place may begin one.
WIDE_IP = re.compile(
    r"(?<![0-9A-Za-z])(?=([0-9]{1,3}(?:\s?(?:\.|[\[({]\s?(?:\.|dot)\s?[\])}]|dot)\s?[0-9]{1,3}){3})(?![0-9A-Za-z]))",
    re.ASCII | re.IGNORECASE,
)
BEFORE = re.compile(r"([0-9]+)([\x20().\-/]{1,2})$")
AFTER = re.compile(r"([\x20().\-/]{1,2})([0-9]+)")
CUES = {
    "phone": ("tel", "phone", "call", "fax", "mobile", "cell", "whatsapp", "ring"),
    "card": ("card", "visa", "mastercard", "amex", "credit", "debit", "cc"),
    "email": ("mail", "contact", "write", "reach"),
    "ip": ("ip", "host", "server", "address", "ping"),
    "other": ("isbn", "order", "invoice", "version", "date", "id", "no", "ref", "page", "total", "sku"),
}


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(DIGIT.findall(text))


def emails(text: str) -> list[tuple[int, int]]:
    """As the pattern would find from the left, without its retries: the local part is the whole run before the @."""
    out, last = [], 0
    for m in DOMAIN.finditer(text):
        start = m.start()
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        if start < m.start():
            out.append((start, m.end()))
            last = m.end()
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) by kind, then start."""
    out = [(0, a, b) for a, b in emails(text)] if "@" in text else []
    if not DIGIT.search(text):
        return out
    if "." in text:
        out += [(1, *m.span()) for m in IP.finditer(text) if all(len(p.lstrip("0")) < 4 and int(p) < 256 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = digits_of(m[0])
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append((2, *m.span()))
    if "+" in text:
        out += [(3, *m.span()) for m in PHONE.finditer(text) if 9 <= len(digits_of(m[0])) <= 15]
    return out


def digit_runs(text: str) -> Iterator[tuple[int, int, int]]:
    """Each run of neighbouring groups of a chain that has 7 to 19 digits, and how many it has; a letter may not touch it."""
    for chain in CHAIN.finditer(text):
        if chain.end() - chain.start() < LEAST_DIGITS:
            continue
        groups = [m.span() for m in GROUP.finditer(text, *chain.span())]
        for i, (start, _) in enumerate(groups):
            if start and text[start - 1].isascii() and text[start - 1].isalpha():
                continue
            n = 0
            for a, end in groups[i : i + MOST_DIGITS]:
                n += end - a
                if n > MOST_DIGITS:
                    break
                if n >= LEAST_DIGITS and not (text[end : end + 1].isascii() and text[end : end + 1].isalpha()):
                    opened = start and text[start - 1] == "(" and ")" in text[start:end]
                    yield start - bool(opened), end, n


def wide_spans(text: str) -> Iterator[tuple[int, int, int]]:
    """What the generators propose; the spans may overlap one another and the base."""
    low = text.lower()
    if "@" in text or "at" in low and ("dot" in low or AT_MARK.search(low)):
        yield from ((0, *m.span()) for m in WIDE_EMAIL.finditer(text))
    if DIGIT.search(text):
        if "." in text or "dot" in low:
            for m in WIDE_IP.finditer(text):
                if all(int(x) < 256 for x in GROUP.findall(m[1])):
                    yield (1, *m.span(1))
        for start, end, n in digit_runs(text):
            if n <= 15:
                yield 3, start, end
            if n >= 13:
                yield 2, start, end


def describe(kind: int, text: str, start: int, end: int) -> list[float]:
    """Format and context of a candidate; neither the plus of base phones nor the @ of base addresses is told."""
    span = text[start:end]
    digits = digits_of(span)
    groups = [len(g) for g in re.findall(r"[0-9]+", span)]
    before, after = text[max(0, start - 24) : start].lower(), text[end : end + 12].lower()
    words = re.findall(r"[a-z]+", before)
    marks = re.split("[0-9]+", span)[1:-1]
    left, right = BEFORE.search(before), AFTER.match(after)
    return [
        kind, len(span), len(digits), len(groups), groups[0] if groups else 0, groups[-1] if groups else 0,
        max(groups, default=0), groups[-2] if len(groups) > 1 else 0, span.count(" "), span.count("-"), span.count("."),
        span.count("/"), span.count("("), span.count(")"), float(13 <= len(digits) <= 19 and luhn(digits)),
        len(set(digits)), int(digits[0]) if digits else -1, float("(" in span or "[" in span),
        float(before.rstrip(" ")[-1:] in (":", "=")), float(before[-1:].isalnum()), float(before[-1:] in ("$", "€", "#", ".")),
        float(after[:1].isalnum()), float(after[:1] in ("%", "€", ",")), len(re.findall("[A-Za-z]{2,6}$", span)),
        *[float(any(w in words[-3:] for w in cue)) for cue in CUES.values()],
        float(digits[:2] in ("19", "20") and len(digits) == 8),
        len(left[1]) if left else 0, float(bool(left) and left[2] in marks), len(right[2]) if right else 0,
        float(bool(right) and right[1] in marks), len(set(marks)), min(groups, default=0), groups[1] if len(groups) > 1 else 0,
        span.lower().count("dot"), max((int(g[:4]) for g in re.findall("[0-9]+", span)), default=0),
    ]


@dataclass(frozen=True)
class Boosted:
    """Trees of fixed depth: feature and cut of each inner node, value of each leaf; a threshold per kind."""

    start: float
    columns: np.ndarray
    cuts: np.ndarray
    leaves: np.ndarray
    thresholds: tuple[float, ...]

    def score(self, table: np.ndarray) -> np.ndarray:
        total = np.full(len(table), self.start)
        for column, cut, leaf in zip(self.columns, self.cuts, self.leaves, strict=True):
            node = np.zeros(len(table), np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (table[np.arange(len(table)), column[node]] > cut[node])
            total += leaf[node - (2**DEPTH - 1)]
        return 1 / (1 + np.exp(-total))


def grow(table: np.ndarray, cuts: list[np.ndarray], slope: np.ndarray, bend: np.ndarray):
    """One tree: each node splits where the second-order gain is largest."""
    inner = 2**DEPTH - 1
    columns, where, leaves = np.zeros(inner, np.int64), np.full(inner, np.inf), np.zeros(2**DEPTH)
    node = np.zeros(len(table), np.int64)
    for at in range(inner):
        rows = np.flatnonzero(node == at)
        best = 0.0
        g, h = slope[rows], bend[rows]
        whole = g.sum() ** 2 / (h.sum() + 1)
        for column, some in enumerate(cuts):
            values = table[rows, column]
            for cut in some if len(rows) > 10 else ():
                left = values <= cut
                gl, hl = g[left].sum(), h[left].sum()
                gain = gl**2 / (hl + 1) + (g.sum() - gl) ** 2 / (h.sum() - hl + 1) - whole
                if gain > best + 1e-9:
                    best, columns[at], where[at] = gain, column, cut
        node[rows] = 2 * at + 1 + (table[rows, columns[at]] > where[at])
    for leaf in range(2**DEPTH):
        rows = node == inner + leaf
        leaves[leaf] = RATE * slope[rows].sum() / (bend[rows].sum() + 1)
    return columns, where, leaves


def train_trees(table: np.ndarray, target: np.ndarray, owner: np.ndarray, seed: int = 3) -> Boosted:
    """Logistic boosting on the candidates of two thirds of the texts; on those of the rest, per kind, the lowest threshold
    that keeps the precision. ``owner`` numbers the texts: all candidates of one are on one side.

    A kind without enough held-out candidates of both sorts adds nothing.
    """
    order = np.random.default_rng(seed).permutation(len(table))
    texts = np.unique(owner)
    held_texts = np.random.default_rng(seed + 1).permutation(texts)[2 * len(texts) // 3 :]
    apart = np.isin(owner[order], held_texts)
    fit, held = order[~apart], order[apart]
    cuts = [np.unique(np.quantile(table[fit, c], np.linspace(0.05, 0.95, 12)) if len(fit) else []) for c in range(table.shape[1])]
    rate = np.clip(target[fit].mean() if len(fit) else 0.5, 0.01, 0.99)
    start = float(np.log(rate / (1 - rate)))
    total, trees = np.full(len(fit), start), []
    for _ in range(TREES if len(fit) else 0):
        p = 1 / (1 + np.exp(-total))
        trees.append(grow(table[fit], cuts, target[fit] - p, p * (1 - p)))
        tree = Boosted(0.0, *(np.array([x]) for x in trees[-1]), ())
        raw = tree.score(table[fit])
        total += np.log(raw / (1 - raw))
    sizes = (2**DEPTH - 1, 2**DEPTH - 1, 2**DEPTH)
    model = Boosted(start, *(np.array([t[i] for t in trees]).reshape(len(trees), n) for i, n in enumerate(sizes)), ())
    model = Boosted(model.start, model.columns.astype(np.int64), model.cuts, model.leaves, ())
    thresholds = []
    score = model.score(table[held]) if len(held) else np.zeros(0)
    for kind in range(len(KINDS)):
        mine = table[held, 0] == kind
        s, t = score[mine], target[held][mine]
        best = 2.0
        if t.sum() >= 5 and (1 - t).sum() >= 5:
            for cut in np.unique(s)[::-1]:
                if t[s >= cut].mean() >= LEAST_PRECISION:
                    best = float(cut)
        thresholds.append(max(best, 0.5))
    return Boosted(model.start, model.columns, model.cuts, model.leaves, tuple(thresholds))


def examples(texts: list[str], seed: int = 5) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Labelled candidates and the number of the text of each. Good ones are base spans, and base spans respelled as people do to hide or shorten them, alone
    and beside other numbers; bad ones are numbers set in the same contexts (dates, amounts, versions, order numbers, numbers
    that fail a check) and, beside other numbers, the runs of groups that are cut short or go on."""
    random = np.random.default_rng(seed)
    table, target, owner = [], [], []

    def add(kind, text, start, end, span, good):
        new = text[:start] + span + text[end:]
        low, high = max(0, start - 30), start + len(span) + 15
        table.append(describe(kind, new[low:high], start - low, start - low + len(span)))
        target.append(good)

    def number(n):
        return "".join(map(str, random.integers(0, 10, n)))

    def beside(kind, text, start, end, spans):
        """The numbers in a row, some of which are whole spans of the kind: what the generators propose there."""
        mark, new, good = (" ", " ", "  ", ". ", "/", " (")[int(random.integers(6))], "", set()
        for span, own in spans:
            new += mark * bool(new)
            good |= {(len(new), len(new) + len(span))} if own else set()
            new += span
        low = max(0, start - 30)
        around = text[low:start] + new + text[end : end + 15]
        found = [c for c in wide_spans(around) if c[0] in (2, 3) and start - low <= c[1] and c[2] <= start - low + len(new)]
        true = [c[0] == kind and (c[1] - start + low, c[2] - start + low) in good for c in found]
        wrong = [i for i, own in enumerate(true) if not own]
        for i in [i for i, own in enumerate(true) if own] + [wrong[i] for i in random.permutation(len(wrong))[:12]]:
            table.append(describe(found[i][0], around, *found[i][1:]))
            target.append(true[i])

    def other():
        year, month, day = 1950 + int(random.integers(100)), int(random.integers(1, 13)), int(random.integers(1, 29))
        forms = (f"{year}", f"{year}-{month:02}-{day:02}", f"{day:02}.{month:02}.{year}", number(1), number(2), number(3), number(5), f"{number(2)}.{number(2)}")
        return forms[int(random.integers(len(forms)))], False

    def phone(digits):
        a, b, c = digits[:-7], digits[-7:-4], digits[-4:]
        forms = (f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"{a} {b} {c}", f"({a}){b}-{c}")
        # With the national 0, and the international prefix spelled as 00.
        return (*forms, f"0{a} {b}{c}", f"0{a}/{b}{c}", f"(0{a}) {b}{c}", f"0{a}-{b} {c}", f"00{int(random.integers(20, 99))} {a} {b}{c}")

    for number_of, text in enumerate(texts):
        owner += [number_of - 1] * (len(target) - len(owner))
        for kind, start, end in base_spans(text):
            span = text[start:end]
            if kind == 1:
                parts = span.split(".")
                for dot in ("[.]", "(.)", " dot ", "[dot]", " [dot] ", "(dot)", " . "):
                    add(1, text, start, end, dot.join(parts), 1)
                    low = [str(int(random.integers(0, 13))) for _ in range(4)]
                    add(1, text, start, end, dot.join(low), 0)
                    listed = text[:start] + ("version ", "section ", "chapter ")[int(random.integers(3))]
                    add(1, listed + text[start:], len(listed), len(listed) + end - start, dot.join(low), 0)
            if kind == 0:
                name, host = span.rsplit("@", 1)
                for at, dot in ((" at ", " dot "), ("(at)", "(dot)"), (" [at] ", " [dot] "), ("[at]", "."), (" (at) ", "."), (" @ ", ".")):
                    add(0, text, start, end, name + at + host.replace(".", dot), 1)
                # A time, a price, a place on the web that something is at.
                first, word = host.split(".")[0], ("us", "it", "them", "look", "online", "sold", "found")[int(random.integers(7))]
                for wrong in (f"{name} at {first}.{number(2)}", f"{word} at {number(1)}.{number(2)}", f"{word} at {host}", f"{word} at {first}.{first}", f"{name} at {host}"):
                    add(0, text, start, end, wrong, 0)
            elif kind == 2:
                add(2, text, start, end, span, 1)
                digits = digits_of(span)
                wrong = digits[:-1] + str((int(digits[-1]) + int(random.integers(1, 10))) % 10)
                for mark in (" ", ".", "/", "  ", "- "):
                    for own in (digits, wrong):
                        add(2, text, start, end, mark.join(own[i : i + 4] for i in range(0, len(own), 4)), own is digits)
                add(2, text, start, end, wrong, 0)
                add(3, text, start, end, wrong[:15], 0)
                spaced = " ".join(digits[i : i + 4] for i in range(0, len(digits), 4))
                beside(2, text, start, end, [[(spaced, True), other()], [other(), (spaced, True)], [(spaced, True), (spaced, True)]][int(random.integers(3))])
            elif kind == 3:
                digits = digits_of(span)[-10:]
                for form in phone(digits):
                    add(3, text, start, end, form, 1)
                for _ in range(3):
                    way, next_way = (int(x) for x in random.integers(0, len(phone(digits)), 2))
                    own, more = (phone(digits)[way], True), (phone(digits[:-7] + number(7))[next_way], True)
                    rows = [own, other()], [other(), own], [own, more], [other(), own, other()], [own, more, (phone(digits[:-7] + number(7))[way], True)]
                    beside(3, text, start, end, rows[int(random.integers(len(rows)))])
            year, month, day = 1950 + int(random.integers(100)), int(random.integers(1, 13)), int(random.integers(1, 29))
            for form in (
                f"{year}-{month:02}-{day:02}", f"{day:02}.{month:02}.{year}", f"{year}{month:02}{day:02}", number(8), number(12),
                f"{number(3)}.{number(3)}.{number(3)}", f"{number(2)}.{number(2)}.{number(4)}", f"{number(4)} {number(4)}",
                f"{number(3)}-{number(10)}", f"{number(5)}/{number(4)}", f"{number(2)} {number(2)} {number(3)}",
            ):
                add(3, text, start, end, form, 0)
    width = len(describe(0, "", 0, 0))
    owner += [len(texts) - 1] * (len(target) - len(owner))
    return np.array(table, np.float64).reshape(len(table), width), np.array(target, np.float64), np.array(owner, np.int64)


def made_texts(texts: list[str], seed: int = 7) -> list[str]:
    """Stretches of the texts (plain words where there are none) with made-up base spans of each kind set into them, so that
    every kind has examples however few the table holds."""
    random = np.random.default_rng(seed)

    def number(n):
        return str(random.integers(1, 10)) + "".join(map(str, random.integers(0, 10, n - 1)))

    def name():
        return "".join(random.choice(list("bcdfghklmnprstvw")) + random.choice(list("aeiou")) for _ in range(int(random.integers(2, 6))))

    def card():
        digits = str(random.choice(["4", "51", "34", "6011"]))
        digits += number(int(random.choice([15, 16])) - 1 - len(digits))
        return next(digits + str(d) for d in range(10) if luhn(digits + str(d)))

    out = []
    for _ in range(MADE_TEXTS):
        text = texts[int(random.integers(len(texts)))] if texts else "some words before it and some more behind it"
        at = int(random.integers(len(text) + 1))
        words = text[max(0, at - MADE_AROUND) : at + MADE_AROUND].split(" ")
        spans = (
            f"{name()}{random.choice(['', '.', '_'])}{name()}@{name()}.{random.choice(['com', 'org', 'net', 'de', 'co.uk'])}",
            ".".join(map(str, random.integers(11, 256, 4))), card(), f"+{random.integers(1, 99)} {number(3)} {number(3)} {number(4)}",
        )
        for kind, span in enumerate(spans):
            lead = [*CUES[KINDS[kind]], "", "", "is", "the"][int(random.integers(len(CUES[KINDS[kind]]) + 4))]
            words.insert(int(random.integers(len(words) + 1)), f"{lead}{random.choice([':', ''])} {span}" if lead else span)
        out.append(" ".join(words))
    return out


def fit_pii_trees(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", sample_docs: int = SAMPLE_DOCS) -> Boosted:
    """Train on those documents that hold an @ or three digits in a row among about ``sample_docs``, by a hash of the id,
    and on stretches of them with made-up spans."""
    texts = id_and_text(docs, id_col, text_col)
    first = F.length(F.regexp_extract("text", f"(?s)^(.*?)(?:{SOUGHT})", 1))
    around = F.substring("text", F.greatest(F.lit(1), first + 1 - AHEAD), F.lit(STRETCH))
    rows = (
        texts.where(in_sample(sample_docs, docs.count(), "id", "text"))
        .where(F.col("text").rlike(SOUGHT)).limit(2 * sample_docs)
        .select("id", F.when(F.length("text") <= SAMPLE_CHARS, F.col("text")).otherwise(around).alias("text")).collect()
    )
    rows = sorted(rows, key=lambda r: (r.id is not None, r.id, r.text))
    own = [r.text for r in rows]
    return train_trees(*examples(own + made_texts(own)))


def added_spans(text: str, base: list[tuple[int, int, int]], trees: Boosted) -> list[tuple[int, int, int]]:
    """Candidates above their kind's threshold, best first, that overlap no base span and no better one."""
    held: list[tuple[int, int]] = []  # no two of them overlap
    for _, a, b in sorted(base, key=lambda x: x[1:]):
        if held and a < held[-1][1]:
            held[-1] = (held[-1][0], max(b, held[-1][1]))
        else:
            held.append((a, b))

    def free(a, b):
        at = bisect_left(held, (b,))
        return not at or held[at - 1][1] <= a

    good: list[tuple[float, int, int, int]] = []
    block: list[tuple[int, int, int]] = []

    def judge():
        if block:
            scores = trees.score(np.array([describe(k, text, a, b) for k, a, b in block]))
            good.extend((-s, *c) for s, c in zip(scores.tolist(), block, strict=True) if s >= trees.thresholds[c[0]])
            block.clear()

    for kind, a, b in wide_spans(text):
        if trees.thresholds[kind] <= 1 and free(a, b):
            block.append((kind, a, b))
            if len(block) == BLOCK:
                judge()
    judge()
    taken: list[tuple[int, int, int]] = []
    for _, kind, a, b in sorted(good):
        if free(a, b):
            insort(held, (a, b))
            taken.append((kind, a, b))
    return taken


def make_finder(trees: Boosted):
    def run(texts):
        out = []
        for text in texts:
            base = base_spans(text)
            more = added_spans(text, base, trees)
            both = sorted([(k, a, b, True) for k, a, b in base] + [(k, a, b, False) for k, a, b in more])
            out.append([{"kind": KINDS[k], "start": a, "end": b, "base": own} for k, a, b, own in both])
        return [out]

    return run


def make_redactor(trees: Boosted):
    def run(texts):
        out = []
        for text in texts:
            base = base_spans(text)
            parts, end = [], 0
            for a, b, k in sorted((a, b, k) for k, a, b in base + added_spans(text, base, trees)):
                if a >= end:
                    parts += [text[end:a], f"[{KINDS[k].upper()}]"]
                end = max(end, b)
            out.append("".join(parts) + text[end:] if parts else text)
        return [True] * len(texts), out

    return run


def find_pii(docs: DataFrame, trees: Boosted, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, spans (kind, start, end, base) by kind, then start.

    Offsets are code points, end exclusive. Null and empty texts have none; repeated rows get a row each;
    null ids stay null; other columns are ignored.
    """
    return map_texts(
        id_and_text(docs, id_col, text_col), ["id"], "text",
        "spans array<struct<kind: string, start: long, end: long, base: boolean>>", make_finder, trees,
    ).withColumnRenamed("id", "doc_id")


def redact_pii(docs: DataFrame, trees: Boosted, *, text_col: str = "text") -> DataFrame:
    """All rows and columns; the kind's name in brackets takes the place of each span. Overlapping spans share one."""
    return rewrite_rows(docs, text_col, make_redactor, trees)
