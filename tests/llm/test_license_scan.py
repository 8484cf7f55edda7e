"""License scan against every rule tried at every word of a text, with no keyword prefilter."""

import random
import re
from collections import Counter

import pytest

from aislekit.llm import license_scan
from aislekit.llm.license_rules import REACH, RULES, parse

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
ODD = [(1, None), (2, ""), (3, " \n!"), (4, "All rights reserved. ALL RIGHTS-RESERVED all rights  all rights reserved"),
       (5, "Licensed under CC BY-NC 4.0."), (5, "Licensed under CC BY-NC 4.0."), (None, "MIT License"),
       (6, "under the GNU General Public License, version 3. Released under the MIT license."),
       (7, "GPL-2.0-or-later GPLv3 lgpl 2.1 or any later version apache 2"), (8, "cc by " * 3000),
       (9, "x " * 20000 + "under the apache license version 2.0"), (10, "license"), (11, "cc cc by by cc-by-sa 4.0"),
       (12, "@@ cc @ by general@public@license © copyright 2020 2021"), (13, "alle Rechte vorbehalten tous droits réservés")]


def words_of(text):
    return WORD.findall((text or "").translate(LOWER))


def scanned(text, rules=RULES):
    """Kept matches of a text: a list of (priority, label, first word, last word)."""
    w = words_of(text)
    found = []
    for r in rules:
        pattern = re.compile(f"(?:^| )({r.left}@{r.right})(?: |$)")
        for i, word in enumerate(w):
            if word == r.key:  # the rule's literal stands here; the whole text lies around it
                m = pattern.search(" ".join([*w[max(0, i - 60):i], "@", *w[i + 1:i + 61]]))
                if m:
                    left, right = m[1].split("@")
                    found.append((r.priority, r.label, i - left.count(" "), i + right.count(" "), r.rule))
    kept = []
    for p, label, a, b, rule in found:
        covers = any(q >= p and c <= a and d >= b and (c < a or d > b or q > p or other < rule)
                     for q, _, c, d, other in found)
        if p == 0 or not covers:
            kept.append((p, label, a, b))
    return kept


def expected(doc_id, text):
    w = words_of(text)
    places = {}  # the base phrases, straight from their words
    for phrase, label in BASE.items():
        p = phrase.split()
        for i in range(len(w) - len(p) + 1):
            if w[i:i + len(p)] == p:
                places[i, label] = label
    kept = scanned(text)
    labels = {m[1] for m in kept}
    strength = [license_scan.STRENGTH[m[0]] for m in kept]
    at = [i for i, _ in places]
    return (doc_id, len(w), len(places), min(at, default=None), max(at, default=None),
            ",".join(sorted(set(places.values()))), ",".join(sorted(labels | set(places.values()))),
            max(strength, default=0.0))


def test_there_are_hundreds_of_rules_within_reach():
    assert len(RULES) >= 300
    for r in RULES:
        assert "*" not in r.left + r.right and "{" not in r.left + r.right
        assert re.fullmatch("[^ @<>]+", r.key)
        assert max(r.left.count(" "), r.right.count(" ")) <= REACH  # no group repeats, so no match is longer


def test_odd_texts(make_docs):
    got = Counter(map(tuple, license_scan.op11_license_scan(make_docs(ODD)).collect()))
    assert got == Counter(expected(i, t) for i, t in ODD if i != 8) + Counter(
        [(8, 6000, 3000, 0, 5998, "cc-by", "cc-by", 0.75)])


def test_documents(documents):
    rows = documents.select("doc_id", "text").collect()
    got = Counter(map(tuple, license_scan.op11_license_scan(documents).collect()))
    assert got == Counter(expected(r["doc_id"], r["text"]) for r in rows)


def test_every_rule_can_match(make_docs, spark):
    """A text made from each rule, with all optional words, is found by that rule unless a wider one covers it."""
    texts = []
    for r in RULES:
        body = r.left + r.key + r.right
        while "(?:" in body:
            body = re.sub(r"\(\?:([^()|]*)(?:\|[^()]*)?\)\??", r"\1", body)
        body = re.sub(r"\[0-9\]\+?", "7", re.sub(r"licen\[sc\]e", "license", body))
        body = re.sub(r"\[\^ \]\+", "someone", body)
        texts.append((r.rule, re.sub(r"(.)\?", r"\1", body)))
    _, kept = license_scan.scan(make_docs(texts))
    found = Counter(r["rule"] for r in kept.collect())
    assert len(found) > 0.7 * len(RULES)


def test_suppression_by_priority_and_containment(make_docs):
    rules = parse("1 a <k>\n2 b x <k> y\n1 c w x <k> y z\n3 d <k>\n2 e <k> y\n0 f <k> y")
    rows, kept = license_scan.scan(make_docs([(1, "w x k y z"), (2, "k k y"), (3, "q")]), rules)
    ids = {r["row"]: r["id"] for r in rows.collect()}
    got = {(ids[r["row"]], r["label"], r["start"], r["end"], r["words"]) for r in kept.collect()}
    assert got == {(1, "c", 0, 4, "w x k y z"), (1, "b", 1, 3, "x k y"), (1, "d", 2, 2, "k"), (1, "f", 2, 3, "k y"),
                   (2, "d", 0, 0, "k"), (2, "d", 1, 1, "k"), (2, "e", 1, 2, "k y"), (2, "f", 1, 2, "k y")}


@pytest.mark.parametrize("seed", [1, 2])
def test_random_mixtures(make_docs, seed):
    rng = random.Random(seed)
    parts = ["cc by", "nc", "sa", "4.0", "general public license", "gnu", "version 3", "or later", "all rights",
             "reserved", "mit license", "apache", "license", "2.0", "under the", "copyright 2020", "word", "gpl"]
    texts = [(i, " ".join(rng.choice(parts) for _ in range(rng.randint(1, 40)))) for i in range(150)]
    got = Counter(map(tuple, license_scan.op11_license_scan(make_docs(texts)).collect()))
    assert got == Counter(expected(i, t) for i, t in texts)


def test_empty_table(make_docs):
    assert license_scan.op11_license_scan(make_docs([])).collect() == []
