"""The license scan against a plain search of every place of every text."""

import random
import re

from ridestat.llm import license_scan

LOWER = str.maketrans(license_scan.UPPER, license_scan.LOWER)


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute(text):
    w = words_of(text)
    places, base, labels, best = [], set(), set(), 0.0
    for t in license_scan.templates():
        m, cells = len(t.words), {}
        for p in range(len(w) - 2):
            for k in range(m - 2):
                if tuple(w[p : p + 3]) == t.words[k : k + 3]:
                    cells.setdefault(p - k, set()).update((k, k + 1, k + 2))
        for d in cells:
            near = [0] if t.is_phrase else range(license_scan.SHIFT + 1)
            covered = set().union(*(cells.get(d + s, set()) for s in near))
            best = max(best, len(covered) / m)
            if t.is_phrase and len(covered) == m:
                places.append(d)
                base.add(t.label)
                labels.add(t.label)
            elif not t.is_phrase and 5 * len(covered) >= 4 * m:
                labels.add(t.label)
    return len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), best


def test_equals_plain_search(spark, make_docs):
    rng = random.Random(3)
    vocabulary = ["the", "mit", "license", "under", "cc", "by", "nc", "apache", "version", "2", "of", "é", "Übung", "software", "in", "a"]
    texts = [None, "", "mit", "Under THE MIT-License.", "Kunder the mit license", "cc by nc cc by nc by nc", "under the mÏt license", "apache_license/version 2,0", "under the mit license\x00under the mit license"]
    texts += [" ".join(rng.choices(vocabulary, k=rng.choice((5, 40, 300)))) for _ in range(60)]
    for t in license_scan.templates():
        for edits in (0, 1, 2, 5):
            w = list(t.words)
            for _ in range(edits):
                at = rng.randrange(len(w))
                w[at : at + 1] = rng.choice(([], [w[at], "xx"], ["yy"]))
            texts.append("Lorem ipsum " + " ".join(x.title() for x in w) + ", dolor sit")
    texts.append("word " * 40_000 + "licensed under cc by nc 4.0 " * 3 + "x " * 10)
    texts += texts[3:6] * 30
    got = license_scan.scan(make_docs([(i, t, "en", "s") for i, t in enumerate(texts)])).collect()
    assert len(got) == len(texts)
    for r in got:
        assert tuple(r)[1:] == brute(texts[r["doc_id"]]), texts[r["doc_id"]]


def test_edited_notices_are_found_and_other_text_is_not(spark, make_docs):
    mit = next(t for t in license_scan.templates() if t.label == "mit" and len(t.words) > 40)
    w = list(mit.words)
    w[20:21] = ["fully", "new"]
    del w[35]
    mixed = list(mit.words)
    random.Random(1).shuffle(mixed)
    got = {r["doc_id"]: r for r in license_scan.scan(make_docs([(1, " ".join(w), "en", "s"), (2, " ".join(mixed), "en", "s"), (3, "free software of the people for the people", "en", "s")])).collect()}
    assert got[1]["labels"] == "mit" and got[1]["base_labels"] == "" and 0.8 <= got[1]["score"] < 1
    assert got[2]["labels"] == got[3]["labels"] == ""


def test_empty_table_and_repeated_rows(spark, make_docs):
    docs = make_docs([(1, "under the mit license", "en", "s"), (1, "under the mit license", "en", "s"), (None, "cc by nc", "en", "s")])
    assert license_scan.scan(docs.limit(0)).count() == 0
    got = sorted(map(repr, license_scan.scan(docs).collect()))
    assert len(got) == 3 and got[0] == got[1]
