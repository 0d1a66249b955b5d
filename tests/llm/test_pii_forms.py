"""The stored model on forms and lines written by hand, which no generator of training lines gives."""

import random

import pyarrow.parquet as pq
import pytest

from pagemill.llm import pii

NAMES = "alice bob.jones marta_k peterpan2 j.doe sandra max.mustermann info team-lead claire".split()
HOSTS, ENDS = "example mailbox uni-bonn acme nordwind freenet".split(), "com org net de".split()
FORMS = [("(at)", "(dot)"), ("[at]", "."), (" [at] ", " [dot] "), (" (at) ", "."), (" at ", " dot "), (" AT ", " DOT "), ("[at]", "[dot]"), (" (at) ", " (dot) ")]
LINES = ["please write to {} about it", "Kontakt: {}", "{} is my address, thanks", "send the forms to {}.", "or ask {} for a copy", "reach me under {}, any time"]
NEGATIVES = [
    "the cat sat at the dot", "look at me and dot the i", "we met at noon", "ISBN 978-3-16-148410-0", "order no. 123-456-7890", "Lotto 12 23 34 45 46 47 48", "he arrived at last", "at the end of line dot matrix printers", "see [3] at page 44",
    "version 1.2.3.4567 at work", "room 12 at floor 3", "(at) the moment", "staff [dot] notes", "scores 3-2, 4-1, 10-12", "ISBN 0-306-40615-2", "invoice no 2024-00017", "died 1899-1955 at home", "at 10:30 or at 11:45", "polka dot dress at the store",
    "part number 4711-0815-42", "look (at) this", "he is at school", "A at B dot product of vectors", "thth*** thesathe&&& at%%% nd,&&& eran",
]


@pytest.fixture(scope="module")
def model():
    return pii.default_tagger()


@pytest.mark.parametrize("at,dot", FORMS)
@pytest.mark.parametrize("where", ["alone", "line", "document"])
def test_forms(model, sf_dir, at, dot, where):
    """At least four of five are found in full, as a text of their own, in a line, and in the midst of a document."""
    r = random.Random(f"{at}{dot}{where}")
    docs = [t for t in pq.read_table(f"{sf_dir}/documents.parquet", columns=["text"]).column(0).to_pylist() if t]
    texts, gold = [], []
    for _ in range(40):
        s = r.choice(NAMES) + at + r.choice(HOSTS) + dot + r.choice(ENDS)
        line = "{}" if where == "alone" else r.choice(LINES)
        begin, text = line.index("{}"), line.replace("{}", s)
        if where == "document":
            d = r.choice(docs)
            cut = d.rfind(" ", 0, len(d) // 2) + 1
            text, begin = f"{d[:cut]}{text} {d[cut:]}", begin + cut
        texts.append(text)
        gold.append((begin, begin + len(s), "email"))
    found = pii.find_spans(model, texts)
    assert sum(g in spans for g, (_, spans) in zip(gold, found)) >= 0.8 * len(gold)
    assert all(not (t[a].isspace() or t[e - 1].isspace()) for t, (_, spans) in zip(texts, found) for a, e, _ in spans)


def test_negatives(model):
    texts = NEGATIVES + [line.replace("{}", n) for n in NEGATIVES for line in LINES] + [f"{a}. {b}" for a, b in zip(NEGATIVES, NEGATIVES[1:])]
    false = [(t[a:e], k) for t, (base, spans) in zip(texts, pii.find_spans(model, texts)) for a, e, k in set(spans) - set(base)]
    assert len(texts) > 180 and len(false) <= 0.02 * len(texts), false


def test_clean_documents_gain_nothing(model, sf_dir):
    texts = [t or "" for t in pq.read_table(f"{sf_dir}/documents.parquet", columns=["text"]).column(0).to_pylist()]
    assert sum(len(set(spans) - set(base)) for base, spans in pii.find_spans(model, texts)) <= 1


def test_trimmed():
    for text, kind, want in [("  45 46 47 48 ", "phone", "45 46 47 48"), ("mail a@b.c.", "email", "a@b.c"), (" ,. ", "phone", ""), ("x\nbob (at) ex.org", "email", "bob (at) ex.org")]:
        a, b, _ = pii.trimmed(text, (0, len(text), kind))
        assert text[a:b] == want
    for text, ok in [("a@b.c", True), ("a at b", False), ("a_at_b.de", True), ("a&#64;b.de", True), ("a (at) b [dot] c", True), ("cat", False), ("a at b dot c", True)]:
        assert pii.checked(text, (0, len(text), "email")) is ok
