import random

import pytest

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def prose(rng, n, words=4000):
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Documents with every odd case, over several partitions, with columns that clash with operators' own."""
    rng = random.Random(5)
    a, shared = prose(rng, 120), prose(rng, 60)
    b = a.split()
    b[7] = "changed"
    texts = [None, "", "   \n\t ", "one", "x " * 40, a, a, " ".join(b), a.upper(), shared + " " + prose(rng, 90),
             prose(rng, 70) + " " + shared, "é日𝄞 ünï " * 30, "A. b! <|endoftext|> </s> [INST] " * 5,
             "zz" * 3000, prose(rng, 20000), "line one two\n" * 30, "same same\n\nsame same  ", "\x00\x01 bad \x7f"]
    texts += [prose(rng, rng.randrange(1, 200)) for _ in range(40)]
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    rows += [(5, a, "en", "s", len(a)), (None, a, None, None, None), (None, "no id here", "en", "s", None), rows[20], rows[20]]
    df = spark.createDataFrame(rows, DOCS)
    for c in ("rid", "score", "n_words", "term", "text_", "class_rid", "items", "w"):
        df = df.selectExpr("*", f"'clash' AS `{c}`")
    return df


@pytest.fixture(scope="session")
def odd_path(spark, odd_docs, tmp_path_factory):
    """The same as a table read from several files."""
    path = str(tmp_path_factory.mktemp("odd") / "documents.parquet")
    odd_docs.repartition(5, "source", "n_chars").write.parquet(path)
    return path


@pytest.fixture(scope="session")
def odd(spark, odd_path):
    return spark.read.parquet(odd_path)


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
