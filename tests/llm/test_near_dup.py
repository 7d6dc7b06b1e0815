"""Near-duplicate classes against all pairs."""

import numpy as np
import pyarrow as pa

from ridestat.llm import near_dup
from ridestat.llm.textarrays import chunks


def _all_pairs(texts, keys, idf):
    """The least id of each text's class, from the similarity of all pairs."""
    blobs = []
    for lo, hi, data, offsets in chunks(pa.array(texts)):
        h, row, times = near_dup.features(data, offsets)
        w = near_dup.weights(h, times, keys, idf)
        cuts = np.searchsorted(row, np.arange(hi - lo + 1))
        blobs += [h[s:e].tobytes() + w[s:e].astype("<f4").tobytes() for s, e in zip(cuts[:-1], cuts[1:], strict=True)]
    label = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if label[i] != label[j] and near_dup.weighted_jaccard(blobs[i], blobs[j]) >= near_dup.THRESHOLD:
                low, high = sorted((label[i], label[j]))
                label = [low if x == high else x for x in label]
    return label


def _family(rng, n_pairs):
    """Texts over one template that agree below the threshold, each with one near copy; copies' ids lie far apart."""
    shared = [f"s{i}" for i in range(160)]
    firsts, seconds = [], []
    for p in range(n_pairs):
        own = [f"o{p}x{i}" for i in range(40)]
        place = int(rng.integers(0, 160))
        first = shared[:place] + own + shared[place:]
        second = list(first)
        second[int(rng.integers(0, len(first)))] = f"e{p}"
        firsts.append(" ".join(first))
        seconds.append(" ".join(second))
    return firsts + seconds


def test_large_family_of_copies_equals_all_pairs(spark):
    texts = _family(np.random.default_rng(5), 200)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    keys, idf = near_dup.common_features(docs.select("text"))
    want = _all_pairs(texts, keys, idf)
    assert len(set(want)) == 200
    got = {r.doc_id: r.class_id for r in near_dup.classes(docs).collect()}
    assert [got[i] for i in range(len(texts))] == want


def test_rows_of_one_id_with_different_texts_are_judged_apart(spark, make_docs):
    one, two = (" ".join(f"{c}{i}" for i in range(60)) for c in "ab")
    near = two.replace("b30", "other")
    docs = make_docs([(1, one, "en", "s"), (1, two, "en", "s"), (2, two, "en", "s"), (3, near, "en", "s"), (4, "", "en", "s"), (4, " ", "en", "s"), (None, two, "en", "s"), (1, one, "en", "s")])
    named = near_dup.classes(docs).where("class_key is not null").collect()
    classes = {}
    for r in named:
        classes.setdefault(r["class_key"], set()).add((r["doc_id"], r["class_id"]))
    assert sorted(map(sorted, classes.values())) == [[(1, 1)], [(1, 1), (2, 1), (3, 1)]]
    kept = near_dup.drop_near_copies(docs)
    assert kept.columns == docs.columns and {r["key"] for r in kept.collect()} == {"k"}
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=repr) == sorted([(1, one), (1, two), (4, ""), (4, " "), (None, two)], key=repr)


def test_columns_with_the_operators_own_names_stay(spark):
    docs = spark.createDataFrame([(1, "a b", "mine", "own"), (2, "a c", "mine", "own")], "doc_id long, text string, text_key string, __text string")
    kept = near_dup.drop_near_copies(docs)
    assert kept.columns == docs.columns and {(r["text_key"], r["__text"]) for r in kept.collect()} == {("mine", "own")}
