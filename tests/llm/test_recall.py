"""Recall of the spans that the methods add to the base patterns, on planted values in forms that people write.

The forms are written here, apart from the training (UNLIKE: kinds of forms that it has none of); each is planted into whole given
documents without personal data, which the training did not see. Decoys in the same places measure what is added wrongly.
"""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablewright.llm import pii, secret_scan
from tablewright.llm.queries import tokenizer_file

PLANTED = 40  # of each form


def number(random, n: int, first: str = "123456789") -> str:
    return str(random.choice(list(first))) + "".join(map(str, random.integers(0, 10, n - 1)))


def name(random) -> str:
    return "".join(random.choice(list("bcdfghklmnprstvw")) + random.choice(list("aeiou")) for _ in range(int(random.integers(2, 5))))


def sixteen(random) -> str:
    digits = "4" + number(random, 14)
    return next(digits + str(d) for d in range(10) if pii.luhn(digits + str(d)))


def fours(digits: str, mark: str) -> str:
    return mark.join(digits[i : i + 4] for i in range(0, len(digits), 4))


def address(random) -> list[str]:
    return [str(x) for x in random.integers(11, 255, 4)]


# Form: (kind, value, words around it). The value is what a scan should report.
PERSONAL = {
    "email spelled": lambda r: (0, f"{name(r)} at {name(r)} dot com", "write to {} today"),
    "email brackets": lambda r: (0, f"{name(r)}.{name(r)}[at]{name(r)}[dot]org", "contact {} for it"),
    "email one bracket": lambda r: (0, f"{name(r)}{number(r, 2)} (at) {name(r)}.net", "reach me: {} or by post"),
    "ip brackets": lambda r: (1, "[.]".join(address(r)), "the host {} answered"),
    "ip spelled": lambda r: (1, " dot ".join(address(r)), "server {} is down"),
    "card slashes": lambda r: (2, fours(sixteen(r), "/"), "paid with card {} then"),
    "card dots": lambda r: (2, fours(sixteen(r), "."), "visa {} was charged"),
    "phone bracketed": lambda r: (3, f"({number(r, 3)}) {number(r, 3)}-{number(r, 4)}", "call {} after six"),
    "phone dashes": lambda r: (3, f"{number(r, 3)}-{number(r, 3)}-{number(r, 4)}", "my number is {} as before"),
    "phone dots": lambda r: (3, f"{number(r, 3)}.{number(r, 3)}.{number(r, 4)}", "tel. {} in the evening"),
    "phone national": lambda r: (3, f"0{number(r, 3)} {number(r, 7)}", "phone {} any time"),
    "phone two": lambda r: (3, f"{number(r, 3)} {number(r, 3)} {number(r, 4)}", "fax: {} or write"),
}
# Forms of which the training has none.
UNLIKE = {
    "email upper case": lambda r: (0, f"{name(r)} AT {name(r)} DOT com", "send {} a note"),
    "email spaced dots": lambda r: (0, f"{name(r)} [at] {name(r)} . org", "ask {} about it"),
    "ip braces": lambda r: (1, "{.}".join(address(r)), "ping {} again"),
    "card dashes spaced": lambda r: (2, fours(sixteen(r), " -"), "credit card {} used"),
    "phone pairs": lambda r: (3, f"0{number(r, 1)} {number(r, 2)} {number(r, 2)} {number(r, 2)} {number(r, 2)}", "ring {} then"),
    "phone slash dash": lambda r: (3, f"0{number(r, 2)}/{number(r, 3)}-{number(r, 4)}", "mobile {} only"),
}
NO_PERSONAL = {
    "date": lambda r: f"on {number(r, 4, '12')}-0{number(r, 1)}-1{number(r, 1)} the",
    "time stamp": lambda r: f"at 20{number(r, 2)}-0{number(r, 1)}-1{number(r, 1)} 1{number(r, 1)}:3{number(r, 1)} it",
    "version": lambda r: f"release {r.integers(0, 9)}.{r.integers(0, 9)}.{r.integers(0, 9)} of the",
    "order": lambda r: f"order no {number(r, 8)} was sent",
    "amount": lambda r: f"a total of {number(r, 3)},{number(r, 3)}.{number(r, 2)} in all",
    "years": lambda r: f"from 19{number(r, 2)}-20{number(r, 2)} they",
    "at": lambda r: f"we met at {name(r)} and {name(r)}",
    "site": lambda r: f"it is sold at {name(r)}.com and",
    "clock": lambda r: f"come at {r.integers(1, 12)}.{r.integers(10, 59)} or",
    "article": lambda r: f"article {number(r, 5)}-{number(r, 2)} in",
    "wrong card": lambda r: f"reference {(c := sixteen(r))[:-1]}{(int(c[-1]) + 3) % 10} of",
    "big": lambda r: f"some {number(r, 3)} {number(r, 3)} people",
}
SECRETS = {
    "is written out": lambda r, v: f"db_password => '{v}';",
    "yaml": lambda r, v: f"secret_key: \"{v}\"",
    "export": lambda r, v: f"export PWD_MAIN={v}",
    "bearer": lambda r, v: f"Authorization: Bearer {v}",
    "url": lambda r, v: f"postgres://{name(r)}:{v}@{name(r)}.example.com/main",
    "passphrase": lambda r, v: f"passphrase := {v}",
}
NO_SECRETS = ("changeme2019", "password123", "Welcome2020!", "aaaaaaaaaaaa", "qwertyuiop12", "your-token-here", "information", "19871204")


def carriers(spark, folder):
    rows = spark.read.parquet(f"{folder}/documents.parquet").where("text is not null").select("doc_id", "text").orderBy("doc_id").collect()
    return [r.text for r in rows if not pii.DIGIT.search(r.text) and "@" not in r.text and len(r.text.split(" ")) > 20]


def planted_into(text: str, what: str, random) -> tuple[str, int]:
    words = text.split(" ")
    at = int(random.integers(1, len(words)))
    before = " ".join(words[:at]) + " "
    return before + what + " " + " ".join(words[at:]), len(before)


@pytest.fixture(scope="module")
def trees(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    return pii.fit_pii_trees(docs.where(F.col("text").rlike("[0-9]|@")))


@pytest.mark.parametrize("forms, least", [(PERSONAL, 0.9), (UNLIKE, 0.7)])
def test_recall_of_added_personal_data(spark, folder, trees, forms, least):
    random, texts = np.random.default_rng(11), carriers(spark, folder)
    rows, wanted = [], []
    for form, make in forms.items():
        for _ in range(PLANTED):
            kind, value, around = make(random)
            text, at = planted_into(texts[int(random.integers(len(texts)))], around.replace("{}", value), random)
            start = at + around.index("{}")
            rows.append(text)
            wanted.append((form, kind, start, start + len(value)))
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    found = {r.doc_id: [(pii.KINDS.index(s.kind), s.start, s.end) for s in r.spans if not s.base] for r in pii.find_pii(docs, trees).collect()}
    exact = {form: sum((k, a, b) in found[i] for i, (f, k, a, b) in enumerate(wanted) if f == form) for form in forms}
    touched = {form: sum(any(x < b and y > a for _, x, y in found[i]) for i, (f, _, a, b) in enumerate(wanted) if f == form) for form in forms}
    print("exact", exact, "touched", touched, "of", PLANTED)
    assert sum(exact.values()) >= least * len(rows)


def test_added_personal_data_in_decoys(spark, folder, trees):
    random, texts = np.random.default_rng(12), carriers(spark, folder)
    rows = [
        (form, planted_into(texts[int(random.integers(len(texts)))], make(random), random)[0])
        for form, make in NO_PERSONAL.items() for _ in range(PLANTED)
    ]
    docs = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(rows)], "doc_id long, text string")
    found = {r.doc_id: len(r.spans) for r in pii.find_pii(docs, trees).collect()}
    wrong = {form: sum(found[i] > 0 for i, (f, _) in enumerate(rows) if f == form) for form in NO_PERSONAL}
    print("decoys reported", wrong, "of", PLANTED)
    assert sum(wrong.values()) <= 0.05 * len(rows)


def test_recall_of_added_secrets(spark, folder):
    random, texts = np.random.default_rng(13), carriers(spark, folder)
    letters = list("abcdefghijkmnopqrstuvwxyzABCDEFGHJKLMNPQRSTUVWXYZ23456789")
    rows, wanted = [], []
    for form, make in SECRETS.items():
        for i in range(PLANTED):
            value = "".join(random.choice(letters, 10 + i % 8))
            what = make(random, value)
            text, at = planted_into(texts[int(random.integers(len(texts)))], what, random)
            rows.append(text)
            wanted.append((form, at + what.index(value), value))
    for form, make in SECRETS.items():
        for value in NO_SECRETS:
            text, _ = planted_into(texts[int(random.integers(len(texts)))], make(random, value), random)
            rows.append(text)
            wanted.append((form, -1, value))
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    found = {r.doc_id: r.spans for r in secret_scan.scan_secrets(docs, vocabulary=tokenizer_file()).collect()}
    right = {form: 0 for form in SECRETS}
    wrong = []
    for i, (form, start, value) in enumerate(wanted):
        if start < 0:
            wrong += [(form, value) for s in found[i] if not s.base]
        else:
            right[form] += any(s.start <= start and s.end >= start + len(value) for s in found[i])
    print("secrets found", right, "of", PLANTED, "decoys reported", wrong, "of", len(SECRETS) * len(NO_SECRETS))
    assert sum(right.values()) >= 0.95 * PLANTED * len(SECRETS)
    assert len(wrong) <= 0.05 * len(SECRETS) * len(NO_SECRETS)
