"""Operators that work row by row on texts, against brute force."""

import hashlib
import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from transit_prices.llm import bpe, hmm, langid, quality, tokencount
from transit_prices.llm.common import remainder, shared_folder, written
from transit_prices.llm.queries import vocabulary_file

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def pairs(df, *cols):
    return sorted(((r["doc_id"], *(r[c] for c in cols)) for r in df.collect()), key=repr)


def test_language_id(spark, odd_docs, no_docs):
    train = odd_docs.where(remainder(F.col("doc_id"), 4) != 2)
    dictionaries = langid.sample_texts(train)
    assert set(dictionaries) == {"en", "fr"}
    assert all(len(d) <= 6 * langid.SAMPLES * langid.SLICE_CHARS for d in dictionaries.values())
    got = langid.identify(odd_docs, dictionaries)
    assert got.count() == odd_docs.count()
    by_text = {r["doc_id"]: r for r in got.collect()}
    for r in odd_docs.collect():
        if not r["text"] or not any(c.isalpha() for c in r["text"]):
            assert by_text[r["doc_id"]]["best"] == "und" and by_text[r["doc_id"]]["score"] == 0.0
        else:
            assert by_text[r["doc_id"]]["best"] in ("en", "fr") and 0 <= by_text[r["doc_id"]]["score"] <= 1
    assert langid.identify(no_docs, dictionaries).count() == 0
    assert {r["best"] for r in langid.identify(odd_docs, {}).collect()} == {"und"}
    assert langid.sample_texts(no_docs) == {}


def test_language_id_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held_out = remainder(F.col("doc_id"), 4) == 2
    got = langid.identify(docs, langid.sample_texts(docs.where(~held_out)))
    right = docs.where(held_out).select("doc_id", F.col("lang").alias("truth")).join(got, "doc_id").agg(F.avg((F.col("best") == F.col("truth")).cast("int"))).first()[0]
    assert right > 0.95


def test_bpe_equals_library(spark, odd_docs, no_docs):
    from tokenizers import Tokenizer

    path = vocabulary_file("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    for words in (0, 40, 10_000):  # an empty lexicon, a small one, all words
        lexicon = bpe.build_lexicon(odd_docs, path, words=words)
        got = bpe.encode_documents(odd_docs, path, lexicon)
        assert got.count() == odd_docs.count()
        texts = {r["doc_id"]: r["text"] for r in odd_docs.collect()}
        back = dict(map(tuple, bpe.decode_documents(got, path).collect()))
        for r in got.collect():
            want = tokenizer.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids
            assert r["ids"] == want and r["n_tokens"] == len(want)
            assert r["ids_sha256"] == hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest()
            decoded = tokenizer.decode(want, skip_special_tokens=False)
            assert r["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest() and back[r["doc_id"]] == decoded
    assert bpe.encode_documents(no_docs, path, bpe.build_lexicon(no_docs, path)).count() == 0


def test_lexicon_is_minimal_and_exact():
    vocabulary = bpe.Vocabulary(vocabulary_file("word_bpe_49k.json"))
    words = [b"walking", b"talking", b"stalking", b"walked", b"talked", b"stalked", "été".encode(), b"a"]
    lexicon = bpe.Lexicon(bpe.compile_lexicon(words, vocabulary))
    # equal suffixes are shared: distinct residual languages only
    residuals = {frozenset(w[len(p) :] for w in words if w.startswith(p)) for w in words for p in [w[:i] for i in range(len(w) + 1)]}
    assert len(lexicon.end) == len(residuals)
    probes = [*words, b"walk", b"walkings", b"", b"zebra", b"t"]
    numbers = lexicon.find(probes)
    assert [n >= 0 for n in numbers] == [p in words for p in probes]
    assert sorted(numbers[: len(words)]) == list(range(len(words)))
    for w, n in zip(words, numbers):
        ids, _ = lexicon.outputs(np.array([n]))
        assert ids.tolist() == vocabulary.merge_words([w])[0].tolist()


def forward(tokens, model):
    alpha, log = None, 0.0
    for t in tokens:
        alpha = (model.start if alpha is None else alpha @ model.moves) * model.emits[t]
        log += math.log(alpha.sum())
        alpha = alpha / alpha.sum()
    return log


def random_model(rng, k, symbols):
    return hmm.Model(rng.dirichlet(np.ones(k)), rng.dirichlet(np.ones(k), k), rng.dirichlet(np.ones(symbols), k).T)


def test_forward_and_expected_counts():
    rng = np.random.default_rng(1)
    model = random_model(rng, 3, 11)
    sizes = np.array([1, 5, hmm.SEGMENT, hmm.SEGMENT + 1, 400])
    ids = rng.integers(0, 11, sizes.sum())
    docs = np.split(ids, np.cumsum(sizes)[:-1])
    want = [forward(d, model) for d in docs]
    assert np.allclose(hmm.log_likelihoods(ids, sizes, model), want)
    moves, emits, log = hmm.Slice(ids, sizes, hmm.extended(model)).expected()
    assert np.isclose(log, sum(want)) and np.isclose(emits.sum(), sizes.sum())
    # forward-backward, one token at a time
    e, m, s = np.zeros((11, 3)), np.zeros((3, 3)), np.zeros(3)
    for d in docs:
        a = [model.start * model.emits[d[0]]]
        for t in d[1:]:
            a.append(a[-1] @ model.moves * model.emits[t])
            a[-1] /= a[-1].sum()
        b = [np.ones(3)]
        for t in d[:0:-1]:
            b.append(model.moves @ (model.emits[t] * b[-1]))
            b[-1] /= b[-1].sum()
        b.reverse()
        for i, t in enumerate(d):
            g = a[i] * b[i] / (a[i] * b[i]).sum()
            e[t] += g
            s += g * (i == 0)
            if i:
                x = a[i - 1][:, None] * model.moves * (model.emits[t] * b[i])
                m += x / x.sum()
    assert np.allclose(emits[:, 1:], e) and np.allclose(moves[1:, 1:], m) and np.allclose(moves[0, 1:], s)


def test_hmm_scores(spark, odd_docs, no_docs):
    held_out = remainder(F.col("doc_id"), 10) == 0
    got = hmm.score(odd_docs, held_out, own_words=25, start_words=12, states=3)
    rows = odd_docs.withColumn("held_out", held_out).collect()
    tokens = lambda t: [*WORD.findall((t or "").encode().lower()), None]
    c = Counter(w for r in rows if not r["held_out"] for w in tokens(r["text"]))
    n, v = sum(c.values()), len(c)
    want = sorted(
        (r["doc_id"] is None, r["doc_id"] or 0, len(tokens(r["text"])), sum(c[w] > 0 for w in tokens(r["text"])), n, sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens(r["text"])))
        for r in rows
    )
    have = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in got.collect())
    assert [x[:5] for x in have] == [x[:5] for x in want]
    assert np.allclose([x[5] for x in have], [x[5] for x in want])
    assert hmm.score(no_docs, held_out).count() == 0
    nothing = hmm.score(odd_docs.limit(4), F.lit(True)).collect()
    assert len(nothing) == 4 and all(r["n_known"] == 0 and r["train_tokens"] == 0 for r in nothing)


def test_hmm_learns_latent_states(spark):
    import random

    rng = random.Random(9)
    sides = [[f"{c}{i}" for i in range(40)] for c in "ab"]
    docs = [(i, " ".join(rng.choice(sides[i % 2]) for _ in range(60))) for i in range(200)]
    got = hmm.score(spark.createDataFrame(docs, "doc_id long, text string"), F.col("doc_id") >= 160, states=2, rounds=3, start_words=60).where("held_out")
    gain = got.agg(F.sum("score") - F.sum("base_score"), F.sum("n_tokens")).first()
    assert gain[0] / gain[1] > 0.25  # log10(2) = 0.30 is the most there is


def test_hmm_trains_six_states_by_default():
    import inspect

    assert inspect.signature(hmm.score).parameters["states"].default == 6


def test_hmm_scores_do_not_depend_on_the_bounded_table(spark, odd_docs):
    # words in the broadcast table and words of the joined table have the same emissions
    held_out = remainder(F.col("doc_id"), 10) == 0
    found = []
    for own_words in (20, 50, 100_000):
        rows = hmm.score(odd_docs, held_out, own_words=own_words, start_words=12, states=3, rounds=3).collect()
        found.append(sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_tokens"], r["n_known"], r["base_score"], r["score"]) for r in rows))
    for other in found[1:]:
        assert [x[:4] for x in other] == [x[:4] for x in found[0]]
        assert np.allclose([x[4:] for x in other], [x[4:] for x in found[0]], rtol=1e-4)


def test_hmm_training_with_shared_emissions(spark, odd_docs):
    # words beyond the table share emissions up to the last round; a table of all words leaves none to share
    held_out = remainder(F.col("doc_id"), 10) == 0
    score = lambda **kw: sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_known"], r["base_score"], r["score"]) for r in hmm.score(odd_docs, held_out, start_words=12, states=3, **kw).collect())
    whole = score(own_words=100_000, rounds=3, tolerance=0.0)
    assert np.allclose(whole, score(own_words=100_000, rounds=3, tolerance=0.0, part_each_round=False), rtol=1e-4)
    one = score(own_words=20, rounds=1)
    assert np.allclose(one, score(own_words=20, rounds=1, part_each_round=False), rtol=1e-6)
    some = score(own_words=20, rounds=3, tolerance=0.0, part_each_round=False)
    assert [x[:3] for x in some] == [x[:3] for x in whole] and np.allclose([x[3] for x in some], [x[3] for x in whole])
    assert not np.allclose(some, one, rtol=1e-6)


def test_hmm_with_shared_emissions_is_a_distribution(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(["a b", "a", "b b a", "a b", "c d", ""])], "doc_id long, text string")
    types = ["a", "b", "c", "d", "zz"]
    probe = [""] + types + [f"{x} {y}" for x in types for y in types] + [f"{x} {y} {w}" for x in types for y in types for w in types]
    every = docs.withColumn("h", F.lit(False)).union(spark.createDataFrame([(100 + i, t, True) for i, t in enumerate(probe)], "doc_id long, text string, h boolean"))
    got = {r["doc_id"]: r["score"] for r in hmm.score(every, F.col("h"), own_words=1, states=2, part_each_round=False).collect()}
    total = [sum(10 ** got[100 + i] for i, t in enumerate(probe) if len(t.split()) == n) for n in range(4)]
    assert all(x > 0 for x in total) and 0.7 < sum(total) < 1.0


def test_hmm_is_a_distribution(spark):
    # over all texts of up to two words, one of them unknown, the probabilities add up with those of longer ones
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(["a b", "a", "b b a", "a b", ""])], "doc_id long, text string")
    types = ["a", "b", "zz"]
    probe = [""] + types + [f"{x} {y}" for x in types for y in types]
    every = docs.withColumn("h", F.lit(False)).union(spark.createDataFrame([(100 + i, t, True) for i, t in enumerate(probe)], "doc_id long, text string, h boolean"))
    got = {r["doc_id"]: r["score"] for r in hmm.score(every, F.col("h"), own_words=1, states=2).collect()}
    total = sum(10 ** got[100 + i] for i in range(len(probe)))
    assert 0.5 < total < 1.0


def repeated_cover(words, n):
    grams = Counter(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
    hit = [False] * len(words)
    for i in range(len(words) - n + 1):
        if grams[tuple(words[i : i + n])] > 1:
            hit[i : i + n] = [True] * n
    return hit


def longest(words):
    n = 0
    while len({tuple(words[i : i + n + 1]) for i in range(len(words) - n)}) < len(words) - n:
        n += 1
    return n


def test_quality(spark, odd_docs, no_docs):
    got = quality.verdict(quality.repetition(odd_docs, min_repeat=4))
    texts = {r["doc_id"]: r["text"] or "" for r in odd_docs.collect()}
    assert got.count() == odd_docs.count()
    for r in got.collect():
        t = texts[r["doc_id"]]
        words = WORD.findall(t.encode())
        lines = [x for x in t.split("\n") if WORD.search(x.encode())]
        three, four = repeated_cover(words, 3), repeated_cover(words, 4)
        assert r["n_words"] == len(words) and r["word_chars"] == sum(len(w.decode()) for w in words)
        assert r["n_symbols"] == len(re.findall(r"[#*$%&|<>]", t)) and r["n_dup_lines"] == len(lines) - len(set(lines))
        assert r["n_repeat_words"] == sum(three) and r["covered_words"] == sum(four)
        spans = [i for s in r["spans"] for i in range(s["start"], s["end"])]
        assert spans == [i for i, x in enumerate(four) if x]
        if len(words) < 2000:
            assert r["longest_repeat"] == longest(words)
        assert r["base_failed"] == (len(words) < 50 or 100 * sum(three) > 50 * len(words))
        assert not (r["base_failed"] and r["kept"])
    kept = quality.keep_good(odd_docs)
    assert kept.columns == odd_docs.columns
    want = quality.verdict(quality.repetition(odd_docs)).where("kept")
    assert pairs(kept.select("doc_id")) == pairs(want.select("doc_id"))
    assert quality.keep_good(no_docs).count() == 0 and quality.repetition(no_docs).count() == 0


@pytest.mark.parametrize("block", [3, 1000])
def test_token_counts(spark, odd_docs, no_docs, block):
    import public_tokenizers
    import tiktoken

    ranks = tokencount.read_ranks(vocabulary_file("byte_bpe_50k.tiktoken"))
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    folder = shared_folder(spark)
    few = odd_docs.where("length(text) < 3000 or text is null") if block == 3 else odd_docs
    order = written(tokencount.write_flat(few, folder, ranks, public_tokenizers.PATTERN, 50256))
    files = tokencount.flat_files(spark, folder)
    counts = tokencount.count_tokens(files, folder, 50256, block_tokens=block)
    texts = {r["doc_id"]: r["text"] or "" for r in few.collect()}
    got = order.join(counts, ["file", "nth"]).collect()
    assert len(got) == few.count() and all(r["complete"] for r in got)
    assert all(r["n_tokens"] == len(encoding.encode_ordinary(texts[r["doc_id"]])) for r in got)
    assert written(tokencount.write_flat(no_docs, shared_folder(spark), ranks, public_tokenizers.PATTERN, 50256)).count() == 0


def test_token_file_without_last_separator(spark, tmp_path):
    ids = np.array([9, 1, 2, 9, 9, 3, 4, 5], dtype="<u2")
    (tmp_path / "x.bin").write_bytes(ids.tobytes())
    (tmp_path / "empty.bin").write_bytes(b"")
    folder = str(tmp_path)
    for block in (1, 2, 5, 100):
        got = tokencount.count_tokens(tokencount.flat_files(spark, folder), folder, 9, block_tokens=block).orderBy("nth").collect()
        assert [(r["nth"], r["n_tokens"], r["complete"]) for r in got] == [(0, 0, True), (1, 2, True), (2, 0, True), (3, 3, False)]


def test_most_frequent_equals_a_full_sort(spark):
    from transit_prices.llm.common import most_frequent

    rows = [(f"w{i}", 1 + 5000 // (i + 1)) for i in range(800)]
    counts = spark.createDataFrame(rows, "word string, n long").repartition(7)
    want = sorted(rows, key=lambda r: (-r[1], r[0]))
    for limit in (1, 10, 333, 800, 2000):
        assert [tuple(r) for r in most_frequent(counts, "word", "n", limit).collect()] == want[:limit]
    assert most_frequent(counts.where("n < 0"), "word", "n", 5).count() == 0


def test_hmm_symbols_travel_in_two_bytes(spark):
    """Also those of a bounded table that two bytes cannot number, and of words beyond it."""
    vocabulary = {b"w%d" % i: i for i in range((1 << 16) + 10)}
    end, rest = len(vocabulary), len(vocabulary) + 1
    texts = [None, "", "w0 none w65534 w65535 w65545 none w65536 été", "w7", "none"]
    rows = spark.createDataFrame([(i, i % 2 == 0, t) for i, t in enumerate(texts)], "doc_id long, held_out boolean, text string").coalesce(1)
    numbered = hmm._numbered(rows, vocabulary)
    found = numbered.orderBy("doc_id").select("ids", "exact", "others").toArrow().combine_chunks().to_batches()
    parts = [(ids, sizes) for _, ids, sizes in hmm._id_slices(iter([b.slice(1) for b in found]), 0, rest + 1, 3)]
    assert np.concatenate([s for _, s in parts]).tolist() == [1, 9, 2, 2]
    assert np.concatenate([i for i, _ in parts]).tolist() == [end, 0, rest, 65534, 65535, 65545, rest, 65536, rest, end, 7, end, rest, end]
    assert [len(x) for x in found[0].column(0).to_pylist()] == [2, 2, 18, 4, 4]  # bytes; before, a list of numbers
    words = sorted((r["row"], r["at"], bytes(r["word"])) for r in hmm.other_words(numbered).collect())
    assert [w for _, _, w in words] == [b"none", b"none", "été".encode(), b"none"] and [a for _, a, _ in words] == [0, 1, 2, 0]
