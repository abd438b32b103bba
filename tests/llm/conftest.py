import public_tokenizers
import pytest

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")

# Nulls, empty and blank texts, ties, repeated rows, special strings, and columns whose names the operators use.
ROWS = [
    (1, "a quick brown fox jumps over the lazy dog", "en", "s"),
    (1, "a quick brown fox jumps over the lazy dog", "en", "s"),
    (2, "a quick brown\nfox jumps  over the lazy dog", "en", "s"),
    (3, "", "en", "s"),
    (4, " \t\n", "de", None),
    (5, None, None, None),
    (None, "der schnelle braune Fuchs", "de", "t"),
    (None, None, None, None),
    (6, "mail jo@example.com or jane (at) example [dot] org, 10.0.0.1", "en", "t"),
    (7, "x<|endoftext|>y's ÉTÉ 中文 \U0001f600", "fr", "t"),
    (8, "word " * 3000, "en", "s"),
]
EXTRA = ("ids", "_key", "_set", "spans", "kept", "n_tokens", "_text", "_row")


@pytest.fixture(scope="session")
def awkward(spark):
    rows = [(*r, *["x"] * len(EXTRA)) for r in ROWS]
    names = ", ".join(f"{c} string" for c in EXTRA)
    return spark.createDataFrame(rows, f"doc_id bigint, text string, lang string, source string, {names}")


@pytest.fixture(scope="session")
def sample(spark):
    """Real documents, the whole small table."""
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="session")
def texts(sample):
    return {r["doc_id"]: r["text"] for r in sample.select("doc_id", "text").collect()}
