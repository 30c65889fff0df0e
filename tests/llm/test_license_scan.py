import math
import random
import re

from pairscore.llm.license_scan import BASE, license_scan

from .helpers import ascii_lower, documents

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(text):
    w, places = WORD.findall(ascii_lower(text)), []
    for phrase, label in BASE.items():
        p = phrase.split()
        places += [(i, label) for i in range(len(w)) if w[i : i + len(p)] == p]
    starts = [i for i, _ in places]
    return len(w), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({lab for _, lab in places}))


FILLER = " ".join(f"w{i}" for i in range(31))
CASES = [
    (1, "Released under the MIT License."),
    (2, None),
    (3, ""),
    (4, "MIT mit license Apache-License, cc\nby; CC BY-NC 4.0"),
    (5, FILLER + " apache license " + FILLER + " apache license"),  # across and at block borders
    (6, "This work is licensed under the GNU General Public License, version 3."),
    (7, "license general gnu public"),  # the words, not in sequence
    (8, "mit license " * 500),
    (9, "éMIT license ÉMIT License mit licensé"),
    (1, "Released under the MIT License."),
    (None, "the apache license"),
    (10, FILLER * 300 + " gnu general public license"),
]


def test_places_match_brute_force(spark):
    got = license_scan(documents(spark, CASES)).collect()
    assert len(got) == len(CASES)
    want = sorted([(d, *brute(t)) for d, t in CASES], key=str)
    assert sorted([(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got], key=str) == want
    assert all(0 <= r.score <= 1 and (r.score > 0) == bool(r.labels) for r in got)


def test_templates_match_by_containment(spark):
    terms = "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"
    missing = terms.replace("hereby ", "").replace("granted", "given")
    far = " ".join(terms.split()[:9])
    rows = documents(spark, [(1, f"x y z {terms} a b"), (2, missing), (3, far), (4, "under license 2.0 the apache licensed version 0")])
    labels = {r.doc_id: r.labels for r in license_scan(rows).collect()}
    assert labels == {1: "mit-terms", 2: "mit-terms", 3: "", 4: "apache-2.0-notice"}


def test_empty_table_and_clashing_columns(spark):
    assert license_scan(documents(spark, [])).collect() == []
    rows = documents(spark, [(1, "mit license")]).selectExpr("*", "1 as words", "2 as rank", "3 as block", "4 as labels", "5 as row_key")
    assert license_scan(rows).first().base_labels == "mit"


def contained(text, share, template):
    """Whether any stretch of the template's reach holds that share of its distinct words."""
    w, own = WORD.findall(ascii_lower(text)), set(template.split())
    reach = math.ceil(len(template.split()) / share - 1e-9)
    return any(len(own & set(w[at : at + reach])) >= share * len(own) - 1e-9 for at in range(max(1, len(w))))


def test_whole_licences_at_any_place(spark):
    from pairscore.llm.license_scan import TEMPLATES, reach_of, step_of

    whole = next(t for label, _, t in TEMPLATES if label == "mit-text")
    assert len(whole.split()) > 128 and step_of(reach_of(whole.split(), 0.8)) == 256 and step_of(8) == 8 and step_of(9) == 16
    rows, n = [], 0
    for gap in (0, 1, 200, 255, 300):
        for keep in (1.0, 0.9, 0.75):
            words, n = whole.split(), n + 1
            cut = words[: int(keep * len(words))]
            rows.append((n, " ".join([f"w{i}" for i in range(gap)] + cut + [f"v{i}" for i in range(77)])))
    got = {r.doc_id: set(r.labels.split(",")) - {""} for r in license_scan(documents(spark, rows)).collect()}
    for doc_id, text in rows:
        assert got[doc_id] - {"mit"} == {label for label, share, t in TEMPLATES if contained(text, share, t)}, doc_id
    assert any("mit-text" in v for v in got.values()) and any("mit-text" not in v for v in got.values())


SCATTERED = "Copyright: you can get the software under terms of the license; the apache version is at 2 and line 0 is licensed"


def test_scattered_words_are_no_notice(spark):
    rows = [(i, " ".join(["w"] * i) + " " + SCATTERED) for i in range(20)] + [(99, SCATTERED + " licensed under the Apache License, Version 2.0")]
    labels = {r.doc_id: r.labels for r in license_scan(documents(spark, rows)).collect()}
    assert labels.pop(99) == "apache,apache-2.0-notice" and set(labels.values()) == {""}


def test_random_texts_against_brute_force(spark):
    """Templates of few words in texts of the same few, at all places relative to the blocks; starts are those of a stretch
    that meets the threshold, and the best score is found."""
    rnd = random.Random(11)
    templates = (("five", 0.8, "a b c d e"), ("all", 1.0, "a b a f"), ("long", 0.6, " ".join("a b c d e f g h i j k l".split())), ("one", 1.0, "z"))
    rows = [(i, " ".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rnd.randrange(0, 70)))) for i in range(150)]
    rows += [(200 + i, " ".join(rnd.choice("abcdefz") for _ in range(rnd.randrange(0, 40)))) for i in range(60)]
    for r, (_, text) in zip(license_scan(documents(spark, rows), templates, {}).orderBy("doc_id").collect(), rows):
        assert r.labels == ",".join(sorted(label for label, share, t in templates if contained(text, share, t)))
        w, best = text.split(), 0.0
        for label, share, t in templates:
            own, reach = set(t.split()), math.ceil(len(t.split()) / share - 1e-9)
            scores = [len(own & set(w[at : at + reach])) / len(own) for at in range(len(w))]
            best = max([best, *(x for x in scores if x >= share - 1e-9)])
            assert all(scores[p.start] == p.score and p.length == reach for p in r.places if p.label == label)
        assert r.score == best


def test_thresholds_are_the_templates_own(spark):
    rows = documents(spark, [(1, "alpha beta gamma delta"), (2, "alpha beta gamma delta epsilon")])
    templates = (("all", 1.0, "alpha beta gamma delta epsilon"), ("most", 0.8, "alpha beta gamma delta epsilon"), ("half", 0.5, "alpha beta zeta eta"))
    assert {r.doc_id: r.labels for r in license_scan(rows, templates, {}).collect()} == {1: "half,most", 2: "all,half,most"}
