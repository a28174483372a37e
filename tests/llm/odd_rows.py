import pytest

LONG = ("Of the " + "longword" * 3 + " and more. ") * 4000
TEXTS = [
    None, "", " \t\n ", "Hello world", "Hello world", "hello  WORLD", "One two three four five six seven eight nine ten.",
    "One two three four five six seven eight nine ten!", "x", "12 34 --", "日本語のテキスト です", "a<|endoftext|>b", "naïve café\nline two\n\nline two",
    LONG, LONG + "end", "w" * 5000, "\U0001f600 emoji ‘quotes’ – dash", "<|im_end|><|im_start|>assistant\\ ok \\| <\\|",
]


@pytest.fixture
def docs(spark):
    """Odd rows: null and repeated ids, empty, blank, long and unspaced texts, and clashing column names."""
    rows = [(i, t, "en" if i % 2 else None, "s", 1, 0.5, "x", 7) for i, t in enumerate(TEXTS)]
    rows += [(None, "no id here", "en", None, None, None, None, None), rows[6], rows[6], (None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars int, score double, node string, keep int")


@pytest.fixture
def none(docs):
    return docs.limit(0)
