import pytest

from vitalspan.llm.queries import vocabulary

ODD_TEXTS = [
    None, "", " \t\n", "one", "two words", "three little words", "  lead and trail \n", "a  b\n\n c",
    "it's we'll  'tis don't!!'s\n's", "<|endoftext|> d <|EndOfText|><|startoftext|>", "tab\tb\r\nc \x0bd\x1ce",
    "x\u0085y 1234 ²½ _foo_ ª º µ × ÷ ß ÀÉÞ", "你好 world x　y é ΣΣ İ", "aaaa aaaaa aaa " * 9,
    "̀abc \ǹ ᠎a", "#1 $2 50% a|b <c> & *", "same line again\n" * 5,
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Odd texts, a very long one, null ids, repeated rows, and columns with names of results."""
    texts = [*ODD_TEXTS, "lorem ipsum dolor 12 " * 20_000, "Zoë said: no! " * 30]
    rows = [(i, t, "en" if i % 3 else None, f"s{i % 2}", i) for i, t in enumerate(texts)]
    rows += [rows[8], rows[8], (None, "no id at all", None, None, None), (None, None, None, None, 1)]
    columns = "doc_id long, text string, lang string, source string, n_chars long"
    df = spark.createDataFrame(rows, columns)
    clashing = ["kept", "score", "k", "n", "row", "s", "gone", "first", "component_id", "node",
                "word_length_low", "length", "ids", "predicted", "text_hash", "key", "i"]
    return df.selectExpr("*", *[f"'x' AS {name}" for name in clashing])


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)


@pytest.fixture(scope="session")
def byte_level():
    return vocabulary("byte_bpe_50k.json")


@pytest.fixture(scope="session")
def word_level():
    return vocabulary("word_bpe_49k.json")
