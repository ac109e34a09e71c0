import pytest

#: Texts that are awkward in some way; each test adds its own.
AWKWARD = [None, "", " ", "\n\n", "a", "a  b", " a b ", "x\n y", "x \ny", "é ß z", "İ Σς", "日本語 text",
           "<|endoftext|>", "a <|endoftext|> b", "a<|endoftext|>b <|startoftext|>", "it's 'tis we'll I'VE", "é café",
           "a\x1cb c\x1fd", "\U0001f600 ok \U0001f600\U0001f600", "tab\tand\x0bvt", "1234 5678 90", "??? ... !!!", "a b c d e " * 40,
           "word " * 3000, "x" * 5000, "​zero‍width", "a\r\nb\r\n\r\nc"]


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents with a clashing extra column, from texts; ids count up, the last is null."""
    def make(texts, extra=()):
        rows = [(i, t, None, f"s{i % 3}", None, i) for i, t in enumerate(texts)]
        rows += [(None, "no id here", "en", None, None, 1), *extra]
        return spark.createDataFrame(
            rows, "doc_id long, text string, lang string, source string, n_chars long, length long").repartition(3)
    return make


@pytest.fixture(scope="session")
def sample_texts():
    import pyarrow.parquet as pq
    got = pq.read_table("/root/testdata/sf0.001/documents.parquet", columns=["text"]).column(0).to_pylist()
    return AWKWARD + got[:60]
