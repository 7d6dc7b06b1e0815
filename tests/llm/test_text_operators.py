"""BPE, token files, line dedup, quality rules, mixing: hard rows against brute force."""

import random
import re
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ridestat.llm import bpe, line_dedup, mixing, perplexity, token_files
from ridestat.llm.queries import tokenizer_path
from ridestat.llm.textarrays import chunks, span_hashes, windows, words

WORD = re.compile(r"[^\x20\x09-\x0D]+")
HARD = ["", None, " ", "\n", "a", "it's we're I'll 's 'st ''s", "  two  spaces\n\n x", "<|endoftext|>", "a<|endoftext|> <|endof", "日本 語　é́ ﻿", "\x00\x1c\x85\u2028", "x" * 70_000, "ab cd " * 30_000, "é" * 9_000, "same", "same"]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


def test_words_and_windows_match_a_plain_split():
    rows = ["one two", "", "é\tà\n x  one two three four", "a b c d e f a b c d e"]
    seen = {}
    for _, _, data, offsets in chunks(pa.array(rows)):
        w = words(data, offsets)
        plain = [x for r in rows for x in WORD.findall(r)]
        assert [bytes(data[s:e]).decode() for s, e in zip(w.start, w.end, strict=True)] == plain
        for h, x in zip(w.hash.tolist(), plain, strict=True):
            assert seen.setdefault(x, h) == h
        h, at = windows(w, 5)
        assert len(set(h.tolist())) == len({tuple(plain[i : i + 5]) for i in at})
    assert len(set(seen.values())) == len(seen)


def test_hash_of_a_span_longer_than_a_block():
    data = np.frombuffer(b"q" * 3_000_000 + b" " + b"q" * 3_000_000, np.uint8)
    h = span_hashes(data, np.array([0, 3_000_001]), np.array([3_000_000, 6_000_001]))
    assert h[0] == h[1]


def test_bpe_equals_the_library_on_hard_and_random_texts(library):
    rng = random.Random(3)
    parts = ["'", "s", "t", "'re", "'ll", " ", "  ", "\n", "\t", "a", "Zé", "1", "²", "!", "…", "\u00a0", "日本", "😀", "<|endoftext|>", "aaa", "\u0301", "\r\n", "Ⅷ"]
    texts = HARD[:11] + ["".join(rng.choices(parts, k=rng.randint(0, 14))) for _ in range(3000)]
    vocabulary = bpe.Vocabulary(bpe.read_text(tokenizer_path()))
    encoder = bpe.Encoder(vocabulary)
    for lo, hi, data, offsets in chunks(pa.array(texts, pa.large_string()), bpe.CHUNK):
        ids, places = encoder(data, offsets)
        decoded = bpe.text_rows(*vocabulary.decode(ids, places)).to_pylist()
        for t, s, e, d in zip(texts[lo:hi], places[:-1], places[1:], decoded, strict=True):
            want = library.encode(t or "", add_special_tokens=False).ids
            assert ids[s:e].tolist() == want, t
            assert d == library.decode(want, skip_special_tokens=False)


def test_bpe_and_token_files_over_hard_rows(spark, make_docs, library):
    docs = make_docs([(i, t, "en", "s") for i, t in enumerate(HARD)])
    want = {i: library.encode(t or "", add_special_tokens=False).ids for i, t in enumerate(HARD)}
    for r in bpe.encode(docs, tokenizer_path(), decode=True).collect():
        assert np.frombuffer(r["token_ids"], "<u4").tolist() == want[r["doc_id"]]
        assert r["decoded"] == (HARD[r["doc_id"]] or "")
    root = token_files.new_root(spark)
    shards = token_files.write(docs, tokenizer_path(), root, sequence=64, per_batch=3)
    start = 0
    for r in token_files.read(shards, root).orderBy("doc_id").collect():
        ids = [*want[r["doc_id"]], 0]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    fs, _ = token_files.open_store(root)
    for shard in shards.collect():
        s = token_files.Sequences(fs, shard["path"])
        assert sum(int(s.mask(i).sum()) for i in range(-(-shard["tokens"] // 64))) == shard["tokens"]
        assert np.shares_memory(s.sequence(0), s.batches[0].column(0).values.to_numpy())


def test_bpe_memory_does_not_follow_the_batch():
    rng = np.random.default_rng(4)
    letters = rng.integers(97, 123, (2000, 350, 6), np.uint8)
    texts = [" ".join(bytes(w).decode() for w in row) for row in letters]  # 4.9 MB, nearly all words different
    batch = pa.RecordBatch.from_pydict({"text": texts})
    vocabulary = bpe.Vocabulary(bpe.read_text(tokenizer_path()))
    span_hashes(np.zeros(1, np.uint8), np.array([0]), np.array([1]))  # its tables stay
    tracemalloc.start()
    rows = peak = 0
    for out in bpe.encoded(iter([batch]), vocabulary, "text", ["text", "token_ids", "decoded"], True):
        assert out.column(2).to_pylist() == texts[rows : rows + out.num_rows]
        rows += out.num_rows
        peak = max(peak, tracemalloc.get_traced_memory()[1])
    tracemalloc.stop()
    assert rows == len(texts)
    assert peak < 100e6, peak


def test_empty_tables(spark, make_docs):
    docs = make_docs([])
    assert bpe.encode(docs, tokenizer_path()).count() == 0
    root = token_files.new_root(spark)
    assert token_files.read(token_files.write(docs, tokenizer_path(), root), root).count() == 0
    assert line_dedup.dedup(docs).count() == 0
    assert mixing.mix(docs).count() == 0
    assert mixing.take(docs, mixing.mix(docs)).columns == docs.columns
    assert perplexity.judge(docs).count() == 0


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def brute_line_dedup(rows):
    """{doc_id: remaining text} by comparing all pairs of lines."""
    lines = [(i, p, line, WORD.findall(line)) for i, t in sorted(rows.items()) if t is not None for p, line in enumerate(t.split("\n"))]
    gone = set()
    for n, (i, p, _, w) in enumerate(lines):
        for _, _, _, v in lines[:n]:
            near = len(w) >= line_dedup.NEAR_WORDS and len(v) >= line_dedup.NEAR_WORDS and abs(len(w) - len(v)) <= 1 and edit_distance(w, v) <= 1
            if (len(w) >= line_dedup.MIN_WORDS and w == v) or near:
                gone.add((i, p))
                break
    return {i: None if t is None else "\n".join(x for p, x in enumerate(t.split("\n")) if (i, p) not in gone) for i, t in rows.items()}


def test_line_dedup_against_all_pairs(make_docs):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(40)]
    base = [[rng.choice(vocabulary) for _ in range(rng.choice((1, 2, 3, 5, 8, 9, 12, 15)))] for _ in range(25)]

    def line():
        w = list(rng.choice(base))
        for _ in range(rng.choice((0, 0, 1, 1, 2))):
            k, at = rng.random(), rng.randrange(len(w) + 1)
            if k < 0.4:
                w.insert(at, rng.choice(vocabulary))
            elif w and k < 0.7:
                del w[at % len(w)]
            elif w:
                w[at % len(w)] = rng.choice(vocabulary)
        return rng.choice(("", " ")) + rng.choice((" ", "  ", "\t")).join(w)

    rows = {i: "\n".join(line() for _ in range(rng.randint(0, 9))) for i in range(60)}
    rows |= {100: None, 101: "", 102: "\n\n", 103: "all one line " * 3000, 104: rows[3]}
    docs = make_docs([(i, t, "en", "s") for i, t in rows.items()])
    got = {r["doc_id"]: r["text"] for r in line_dedup.dedup(docs).collect()}
    assert got == brute_line_dedup(rows)
    named = docs.withColumnRenamed("key", "n_lines")
    whole = line_dedup.documents_without_repeated_lines(named)
    assert whole.columns == named.columns
    kept = {r["doc_id"] for r in whole.where("n_lines = 'k'").collect()}
    assert {100, 101, 102} <= kept
    assert kept == {i for i, t in got.items() if t == rows[i] or WORD.search(t or "")}


def test_line_dedup_of_repeated_and_null_ids(make_docs):
    text = "this line has quite enough words to count here"
    docs = make_docs([(1, text, "en", "s"), (1, text, "en", "s"), (None, text, "en", "s"), (2, text, "en", "s")])
    got = [(r["doc_id"], r["text"], r["n_removed"]) for r in line_dedup.dedup(docs).collect()]
    assert sorted(got, key=str) == sorted([(None, text, 0), (1, "", 1), (1, "", 1), (2, "", 1)], key=str)


def test_within_one_edit_is_edit_distance(spark):
    rng = random.Random(9)
    pairs = [([rng.choice("ab") for _ in range(rng.randint(0, 6))], [rng.choice("ab") for _ in range(rng.randint(0, 6))]) for _ in range(400)]
    df = spark.createDataFrame(pairs, "a array<string>, b array<string>")
    for r in df.select("a", "b", line_dedup.within_one_edit(F.col("a"), F.col("b")).alias("near")).collect():
        assert r["near"] == (edit_distance(r["a"], r["b"]) <= 1), r


def base_counts(t):
    w, lines, again = WORD.findall(t or ""), (t or "").split("\n"), set()
    dup = sum(bool(WORD.search(x)) and x in lines[:i] for i, x in enumerate(lines))
    at = {}
    for i in range(len(w) - 4):
        at.setdefault(tuple(w[i : i + 5]), []).append(i)
    for places in at.values():
        if len(places) > 1:
            again |= {i + j for i in places for j in range(5)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), dup, len(again)


def test_quality_rules(spark, make_docs):
    rng = random.Random(1)
    clean = [" ".join("".join(rng.choices(["lo", "ka", "mi", "to", "ren"], k=rng.randint(1, 4))) for _ in range(60)) for _ in range(120)]
    junk = " ".join("".join(rng.choices("XQZJ#%0987", k=9)) for _ in range(60))
    hard = [*HARD[:11], "a b c d e f g " * 5, "x\nx\n y\nx \n", "ab cd " * 2000, junk, None]
    rows = [(i, t, "en" if i % 7 else None, "s") for i, t in enumerate(clean + hard)]
    got = {r["doc_id"]: r for r in perplexity.judge(make_docs(rows)).collect()}
    for i, t, _, _ in rows:
        r = got[i]
        counts = base_counts(t)
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == counts
        assert r["base_failed"] == (counts[0] < 10 or 100 * counts[4] > 20 * counts[0])
        assert not (r["base_failed"] and r["kept"])
    assert all(got[i]["kept"] for i in range(120))
    assert not got[len(clean) + len(hard) - 2]["kept"]


def brute_kneser_ney(corpus):
    """Bits of a text by the definition, for byte n-grams that run across words from the text's start on."""
    raw = {}
    for words in corpus:
        s = b"\n" + b" ".join(words) + b" "
        for e in range(1, len(s)):
            for n in range(1, 6):
                if n <= e + 1:
                    g = s[e + 1 - n : e + 1]
                    raw[g] = raw.get(g, 0) + 1
    counts = {5: {g: c for g, c in raw.items() if len(g) == 5}}
    for n in range(4, 0, -1):
        tails = {}
        for g in counts[n + 1]:
            tails[g[1:]] = tails.get(g[1:], 0) + 1
        if n > 1:
            tails |= {g: c for g, c in raw.items() if len(g) == n and g[:1] == b"\n"}
        counts[n] = tails
    off, total, free = {}, {}, {}
    for n, table in counts.items():
        k = [sum(c == i for c in table.values()) for i in range(5)]
        y = k[1] / (k[1] + 2 * k[2]) if k[1] + 2 * k[2] else 0

        def discount(i, k=k, y=y):
            d = i - (i + 1) * y * k[i + 1] / k[i] if k[1] and k[i] else 0
            return d if 0 < d < i else i / 2

        off[n] = [0, discount(1), discount(2), discount(3)]
        for g, c in table.items():
            total[n, g[:-1]] = total.get((n, g[:-1]), 0) + c
            free[n, g[:-1]] = free.get((n, g[:-1]), 0) + off[n][min(c, 3)]

    def p(h, s):
        n = len(h) + 1
        less = p(h[1:], s) if h else 1 / 256
        if (n, h) not in total:
            return less
        c = counts[n].get(h + s, 0)
        return (c - off[n][min(c, 3)] if c else 0) / total[n, h] + free[n, h] / total[n, h] * less

    def bits(words):
        s = b"\n" + b" ".join(words) + b" "
        return -sum(np.log2(p(s[max(0, e - 4) : e], s[e : e + 1])) for e in range(1, len(s)))

    return bits


def test_perplexity_equals_kneser_ney_by_definition(spark, make_docs):
    rng = random.Random(2)
    texts = [" ".join("".join(rng.choices("abcé", k=rng.randint(1, 7))) for _ in range(rng.randint(10, 30))) for _ in range(30)]
    got = perplexity.judge(make_docs([(i, t, "en", "s") for i, t in enumerate(texts)])).collect()
    bits = brute_kneser_ney([[w.encode() for w in t.split()] for t in texts])
    for r in got:
        w = [x.encode() for x in texts[r["doc_id"]].split()]
        want = bits(w) / sum(len(x) + 1 for x in w)
        assert np.log2(r["perplexity"]) == pytest.approx(want, rel=1e-4)


def shared(sizes, cap=3):
    """Targets by sharing the excess again and again."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: 1 + i % 3 for i, s in enumerate(order)}
    target, left, free = dict.fromkeys(order, 0.0), float(sum(sizes.values())), set(order)
    while left > 1e-9 and free:
        unit = left / sum(weight[s] for s in free)
        for s in free:
            target[s] += unit * weight[s]
        left = sum(max(0, target[s] - cap * sizes[s]) for s in free)
        for s in list(free):
            if target[s] >= cap * sizes[s]:
                target[s] = cap * sizes[s]
                free.discard(s)
    return target


def test_mixing(spark, make_docs):
    rng = random.Random(4)
    rows = [(i, " ".join(["w"] * rng.choice((0, 1, 3, 20, 90))), "en", rng.choice(("a", "a", "a", "a", "b", "é", None, "tiny"))) for i in range(900)]
    rows = [(i, t, lang, s) for i, t, lang, s in rows if s != "tiny" or i < 30] + [(7000, None, "en", "b"), (7001, "", "en", "a"), (8000, "x y", "en", "b"), (8000, "x y", "en", "b")]
    docs = make_docs(rows)
    got = mixing.mix(docs).collect()
    again = mixing.mix(docs.repartition(5)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    sizes, taken, target, most = {}, {}, {}, {}
    for r in got:
        s = r["source_key"]
        sizes[s] = sizes.get(s, 0) + r["size"] * r["rows"]
        taken[s] = taken.get(s, 0) + r["copies"] * r["size"] * r["rows"]
        target[s], most[s] = r["target"], max(most.get(s, 0), r["size"] * r["rows"])
        assert 0 <= r["copies"] <= 3
    assert sum(r["rows"] for r in got) == len(rows)
    want = shared(sizes)
    for s in sizes:
        assert target[s] == pytest.approx(want[s], rel=1e-9)
        assert abs(taken[s] - target[s]) <= most[s]
    mixed = mixing.take(docs, mixing.mix(docs))
    assert mixed.columns == docs.columns
    assert mixed.count() == sum(r["copies"] * r["rows"] for r in got)


def test_pivotal_rounding_keeps_expectations(spark, make_docs):
    docs = make_docs([(i, " ".join(["w"] * (1 + i % 5)), "en", "a" if i % 3 else "b") for i in range(300)])
    runs = [mixing.mix(docs, seed=k) for k in range(6)]
    mean = {}
    for m in runs:
        for r in m.collect():
            mean.setdefault(r["source_key"], []).append(r["copies"] - r["target"] / r["source_size"])
    for drift in mean.values():
        assert abs(np.mean(drift)) < 0.05
