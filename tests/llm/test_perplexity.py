"""Perplexity against probabilities computed in plain Python."""

import numpy as np
from pyspark.sql import functions as F

from ridestat.llm import perplexity


def _docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_every_ngram_has_its_own_probability(spark):
    """A hot language's n-grams do not displace those of a small one: its perplexity does not depend on the other's size."""
    rng = np.random.default_rng(3)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    small = [(i, " ".join("".join(rng.choice(letters, 7)) for _ in range(12)), "xx") for i in range(40)]
    hot = [(1000 + i, " ".join("".join(x) for x in rng.choice(letters, (4000, 12))), "en") for i in range(60)]
    alone = {r.doc_id: r.perplexity for r in perplexity.judge(_docs(spark, small)).collect()}
    both = {r.doc_id: r.perplexity for r in perplexity.judge(_docs(spark, small + hot)).where(F.col("doc_id") < 1000).collect()}
    assert len(both) == 40
    assert all(abs(both[i] - alone[i]) <= 1e-6 * alone[i] for i in alone)


def test_shuffled_words_score_worse_and_leave_the_band(spark):
    rng = np.random.default_rng(11)
    words = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 6)) for _ in range(80)]

    def text():
        at, out = int(rng.integers(0, len(words))), []
        for _ in range(70):
            out.append(words[at])
            at = (at + int(rng.choice([1, 7, 13]))) % len(words)
        return out

    texts = [text() for _ in range(300)]
    rows = [(i, " ".join(t), "en") for i, t in enumerate(texts)]
    rows += [(1000 + i, " ".join(rng.permutation(texts[i])), "en") for i in range(3)]
    out = {r.doc_id: r for r in perplexity.judge(_docs(spark, rows)).collect()}
    assert sum(out[i].kept for i in range(300)) > 270
    assert max(out[i].perplexity for i in range(300)) < min(out[1000 + i].perplexity for i in range(3))
    assert not any(out[1000 + i].base_failed or out[1000 + i].kept for i in range(3))


def test_every_language_has_a_model_of_its_own(spark):
    """Also languages whose names' crc32 agrees in its low bits, and none at all."""
    text = " ".join(f"word{i}" for i in range(30))
    rows = [(1, text, "abo"), (2, text.upper(), "agw"), (3, text.swapcase()[::-1], None), (4, text.title(), "")]
    each = {r.doc_id: r.perplexity for row in rows for r in perplexity.judge(_docs(spark, [row])).collect()}
    both = {r.doc_id: r.perplexity for r in perplexity.judge(_docs(spark, rows)).collect()}
    assert all(abs(both[i] - each[i]) <= 1e-6 * each[i] for i in each)


def test_rows_go_to_blocks_by_size_and_judgements_do_not_depend_on_them(spark, monkeypatch):
    rng = np.random.default_rng(8)
    words = ["".join(rng.choice(list("abcdefghij"), 5)) for _ in range(300)]
    rows = [(i, " ".join(rng.choice(words, int(rng.integers(0, 60)))), ["en", "fr", None][i % 3]) for i in range(200)]
    rows += [(500, "repeated row of words " * 3, "en")] * 50 + [(600, " ".join(words) * 20, "en"), (601, None, "en"), (602, "", "fr")]
    docs = _docs(spark, rows).repartition(4)

    def judged():
        return sorted((r.doc_id, r.n_words, r.base_failed, r.kept, None if r.perplexity is None else round(r.perplexity, 4)) for r in perplexity.judge(docs).collect())

    whole = judged()
    monkeypatch.setattr(perplexity, "BLOCK", 2000)
    sizes = [len(perplexity.unpacked(b)) for b in perplexity.packed(docs, 4).toArrow().column("texts")]
    assert sum(sizes) == len(rows) and len(sizes) > 20 and max(sizes) < len(rows) // 2
    assert judged() == whole and len(whole) == len(rows)
