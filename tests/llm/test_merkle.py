"""The Merkle manifest against a tree built in plain Python."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from ridestat.llm import merkle


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def brute_tree(leaves):
    """The root and each leaf's steps [(place, run)]."""
    steps, level, at = [[] for _ in leaves], list(leaves), list(range(len(leaves)))
    while len(level) > 1:
        for k, i in enumerate(at):
            steps[k].append((i % 16, level[i - i % 16 : i - i % 16 + 16]))
        level = [H(*level[i : i + 16]) for i in range(0, len(level), 16)]
        at = [i // 16 for i in at]
    return level[0], steps


def brute(rows):
    by_source = {}
    for i, text, lang, source, n_chars in rows:
        by_source.setdefault(source, []).append((i is not None, i or 0, H(*map(field, (i, source, lang, n_chars, text)))))
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: brute_tree([x[2] for x in sorted(by_source[s])]) for s in order}
    root, upper = brute_tree([trees[s][0] for s in order])
    out = []
    for s, above in zip(order, upper, strict=True):
        for (known, i, leaf), steps in zip(sorted(by_source[s]), trees[s][1], strict=True):
            siblings = [h for at, run in steps + above for k, h in enumerate(run) if k != at]
            out.append((i if known else None, leaf, trees[s][0], root, H(*siblings)))
    return root, out


def documents(make_docs, sizes, rng):
    rows = [(rng.randrange(10**6) * 7 + k, f"Text {k} É", "en", s) for s, n in sizes.items() for k in range(n)]
    rows += [(None, "x", None, "b"), (5, None, "en", "b"), (5, None, "en", "b"), (5, "", "en", "b"), (-3, "Same", "en", None), (-3, "Same", "en", None)]
    rng.shuffle(rows)
    return make_docs(rows), [(i, t, lang, s, None if t is None else len(t)) for i, t, lang, s in rows]


@pytest.mark.parametrize("height", [1, 2, 3])
def test_equals_plain_tree(spark, make_docs, height):
    """One-level blocks take the same documents through several rounds, with short last subtrees."""
    rng = random.Random(height)
    docs, rows = documents(make_docs, {"a": 1, "b": 700, "é": 17, "z": 16, "hot": 4500 if height == 1 else 300, **{f"s{i}": 2 for i in range(40)}}, rng)
    changed = F.when(F.col("doc_id") % 3 == 0, F.upper("text")).otherwise(F.col("text"))
    manifest = merkle.build(docs, height, now=merkle.leaf(docs, changed))
    root, want = brute(rows)
    got = manifest.check("now").collect()
    assert sorted(map(repr, want)) == sorted(repr((r["doc_id"], r["leaf"], r["subroot"], r["root"], r["proof_sha256"])) for r in got)
    for r in got:
        touched = r["doc_id"] is not None and r["doc_id"] % 3 == 0 and r["doc_id"] not in (-3, 5)
        if r["doc_id"] not in (-3, 5):
            assert r["verified"] == (not touched) == (r["folded_root"] == root)
    for r in manifest.proofs().limit(200).collect():
        node = r["leaf"]
        for step in r["proof"]:
            assert step["run"][step["at"]] == node
            node = H(*step["run"])
        assert node == root
    assert {r["source"] for r in manifest.roots().collect()} == {row[3] for row in rows}


def test_single_document_and_empty_table(spark, make_docs):
    one = make_docs([(1, "A", "en", "s")])
    (r,) = merkle.build(one, now=merkle.leaf(one)).check("now").collect()
    assert r["leaf"] == r["subroot"] == r["root"] == r["folded_root"] and r["verified"]
    assert r["proof_sha256"] == H("")
    none = one.limit(0)
    assert merkle.build(none, now=merkle.leaf(none)).check("now").count() == 0
