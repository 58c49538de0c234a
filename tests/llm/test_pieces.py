import hashlib
import random

import pytest
import sentencepiece

from transit_prices.llm import pieces
from transit_prices.llm.queries import op12_pieces, vocabulary_file

PATH = vocabulary_file("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.Pieces(PATH)


def strange_texts():
    rng = random.Random(5)
    out = ["", " ", "  a", "hi  there ", "a\tb\nc\x00", "ﬁ ＡＢ  ", "日本 😀", "▁x", "a▁ b", "<s> </s> <unk> <0x41>", "x" * 3000, "日本語" * 500, " " * 70]
    for _ in range(400):
        out.append("".join(rng.choice("abcdefghijklmnop  ▁\n\té日😀ﬁthein") for _ in range(rng.randrange(0, 120))))
        out.append("".join(chr(rng.choice([rng.randrange(0, 0xD800), rng.randrange(0xE000, 0x110000)])) for _ in range(rng.randrange(0, 60))))
    return out


def test_ids_and_texts_equal_the_library(vocabulary, library):
    encoder = pieces.Encoder(vocabulary, check=False)
    texts = strange_texts()
    found = [x.tolist() for x in encoder.encode(texts)]
    assert found == library.encode(texts)
    assert [vocabulary.decode(x) for x in found] == library.decode(found)


def test_heap_and_matrix_agree(vocabulary, monkeypatch):
    units = ["▁" + "".join(random.Random(i).choice("thein gaou") for _ in range(2 + i % 30)).replace(" ", "e") for i in range(300)]
    ids, lengths = vocabulary.merge(units)
    monkeypatch.setattr(pieces, "WIDTHS", ())
    long_ids, long_lengths = vocabulary.merge(units)
    assert ids.tolist() == long_ids.tolist() and lengths.tolist() == long_lengths.tolist()


def test_any_ids_decode_as_the_library_does(vocabulary, library):
    rng = random.Random(2)
    for _ in range(3000):
        ids = [rng.choice([rng.randrange(0, 32000), rng.randrange(0, 259), rng.randrange(0, 3), rng.randrange(259, 264)]) for _ in range(rng.randrange(0, 12))]
        assert vocabulary.decode(ids) == library.decode(ids)


def test_a_difference_from_the_library_is_seen(vocabulary, monkeypatch):
    encoder = pieces.Encoder(vocabulary)
    merge = vocabulary.merge
    monkeypatch.setattr(vocabulary, "merge", lambda units: (merge(units)[0] * 0 + 5, merge(units)[1]))
    with pytest.raises(ValueError, match="differ"):
        encoder.encode(["the river"])


def test_documents(spark, odd_docs, no_docs, library):
    rows = pieces.encode_documents(odd_docs, PATH).collect()
    texts = sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["text"] or "") for r in odd_docs.collect())
    assert len(rows) == len(texts)
    expected = []
    for doc_id, text in texts:
        ids = library.encode(text)
        expected.append((doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    assert sorted((r["doc_id"] if r["doc_id"] is not None else -1, *r[1:4]) for r in rows) == sorted(expected)
    assert pieces.encode_documents(no_docs, PATH).collect() == []


def test_round_trip(spark, odd_docs):
    encoded = pieces.encode_documents(odd_docs, PATH)
    back = pieces.decode_documents(encoded, PATH).where("doc_id is not null").dropDuplicates(["doc_id"]).collect()
    texts = {r["doc_id"]: r["text"] or "" for r in odd_docs.collect()}
    # U+2581 is read as a blank; no other character changes
    assert {r["doc_id"]: r["text"] for r in back} == {k: v.replace("▁", " ") for k, v in texts.items() if k is not None}
    no_ids = spark.createDataFrame([(1, None)], "doc_id long, ids array<int>")
    assert pieces.decode_documents(no_ids, PATH).collect()[0]["text"] == ""


def test_query(spark, library):
    rows = op12_pieces(spark, "/root/testdata/sf0.001").collect()
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
