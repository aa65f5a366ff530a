import pytest

LONG = "word " * 30_000 + "end of a very long text with mail a.b@c.org"

#: doc_id, text, lang: nulls in every column, empty and blank texts, a very long one, ties, repeated rows, special strings.
ROWS = [
    (1, "The quick brown fox jumps over the lazy dog and runs away from the old house on the hill.", "en"),
    (2, "The quick brown fox jumps over the lazy dog and runs away from the old house on the hill.", "en"),
    (2, "The quick brown fox jumps over the lazy dog and runs away from the old house on the hill.", "en"),
    (3, None, "en"),
    (4, "", None),
    (5, " \t\n\x0b\f\r ", "de"),
    (None, "No identity here, but text there is: ten words and some more of them.", "en"),
    (None, None, None),
    (6, LONG, "en"),
    (7, "Über J̌ Straße İstanbul ﬁn 日本語テキスト  　 é Ça va?", "fr"),
    (8, "special <|endoftext|> and <|ENDOFTEXT|> a<|startoftext|>b", "en"),
    (9, "x", "es"),
    (10, "one two three", "es"),
    (11, "one two three", "es"),
    (12, "\x00\x1c control \x85 signs \x7f", "xx"),
    (13, "same same same same same same same same same same same same", "en"),
    (14, "Released under the MIT License. Apache License, CC BY-NC 4.0; GNU General Public License!", "en"),
]
SCHEMA = "doc_id long, text string, lang string"


@pytest.fixture(scope="session")
def odd(spark):
    """The odd rows, beside columns named like ones that operators use."""
    rows = [(*r, f"s{k}", None if r[1] is None else len(r[1]), k, "x", 1.5) for k, r in enumerate(ROWS)]
    return spark.createDataFrame(rows, SCHEMA + ", source string, n_chars long, id long, digest string, n double").repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA + ", source string, n_chars long")


@pytest.fixture(scope="session")
def vocabulary_path():
    from assaylake.llm.registered import vocabulary_path

    return vocabulary_path()


@pytest.fixture(scope="session")
def library(vocabulary_path):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary_path)


@pytest.fixture(scope="session")
def ids_of(library):
    return lambda text: library.encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sample(spark, sf_dir):
    """All documents of the smallest test data."""
    return spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
