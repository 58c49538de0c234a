import random

import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

CLASHES = ["copies", "copy", "cut", "__cut", "__doc", "digest", "__digest", "__check", "__id", "keep_id", "rows", "doc", "twin", "nth", "part", "id"]

DOCS = StructType(
    [
        StructField("doc_id", LongType()), StructField("text", StringType()), StructField("lang", StringType()),
        StructField("source", StringType()), StructField("n_chars", LongType()),
        # names that operators use inside or in their results
        StructField("fp", StringType()), StructField("size", StringType()), StructField("a.b c", StringType()), StructField("row", StringType()), StructField("word", StringType()),
        *(StructField(n, StringType()) for n in CLASHES),
    ]
)

WORDS = {
    "en": "the of and to in is that for with was stone river bridge winter morning quiet walked under open lantern".split(),
    "fr": "le la des une que dans pour avec était rivière pont hiver matin calme marche sous ouvert lanterne église forêt".split(),
}


def prose(rng, lang, n):
    return " ".join(rng.choice(WORDS[lang]) + (rng.choice(["", "", "", ",", "."])) + ("x" * (rng.random() < 0.1)) for _ in range(n))


def texts():
    """Ordinary texts and the awkward ones: null, empty, blank, one word, a very
    long one, exact and near copies, symbols, characters beyond the first plane."""
    rng = random.Random(3)
    out = [prose(rng, rng.choice(["en", "fr"]), rng.randrange(1, 400)) for _ in range(60)]
    out += [None, "", " \n\t ", "word", "É", "12 34 !!", "a\x1cb\x85c\xa0d", "日本語 😀 ﬁ Σσς ΑΣ", "x" * 5000, "it's we'll <|endoftext|> end <|startoftext|>"]
    out.append(prose(rng, "en", 30_000))
    out += [out[0], out[0], out[1] + " tail", out[2].replace("the", "a"), "line\n" * 90, out[5] + "\n" + out[5]]
    return out


def rows(n_null=1):
    found = []
    for i, t in enumerate(texts()):
        source = [None, "web", "book", "é", "Z"][i % 5]
        found.append((i, t, None if i % 7 == 0 else ["en", "fr"][i % 2], source, None if t is None else len(t), "x", None, "y", "z", None, *CLASHES))
    found += [(None, "text without an id, twice", "en", "web", 5, None, None, None, None, None, *CLASHES)] * 2
    found.append(found[3])  # a repeated row
    return found


@pytest.fixture(scope="session")
def odd_docs(spark):
    return spark.createDataFrame(rows(), DOCS).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
