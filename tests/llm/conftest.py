import pytest


@pytest.fixture
def edge(spark):
    """Rows that are hard for any operator, with extra columns that clash with results and inner names."""
    long = " ".join(f"w{k % 997}" for k in range(40_000))
    rows = [
        (None, "a text of a null key with a few words"), (None, None), (1, None), (2, ""), (3, " \t\n "), (4, "one"),
        (5, "the same row twice, word by word"), (5, "the same row twice, word by word"), (6, long), (7, long),
        (8, "é😀 日本語  x"), (9, "one"), (10, "line one\nline two\n\nline three\n"), (11, "x" * 100_000),
    ]
    names = "n_words long, n_removed long, kept boolean, kept_text string, items string, n_hit long, contaminated string, n_lines long, perplexity string, limit string, n_tokens string, component_id string, p_toxic string, toxic string, lang string, _text string, key string"
    extra = [None if k % 2 else (k if x.endswith("long") else True if x.endswith("boolean") else "v") for k, x in enumerate(names.split(", "))]
    return spark.createDataFrame([(*r, *extra) for r in rows], f"doc_id long, text string, {names}")


@pytest.fixture
def nothing(edge):
    return edge.limit(0)
