import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"word{i} of the very long text" for i in range(30_000))
SHARED = ("A passage that many documents share goes on for well over fifty words so that every rule of the "
          "tests can see it and no rule may miss it, with plain words here and plain words there, one after "
          "another until the passage has become quite long enough for all the thresholds in use, and it ends here.")


def awkward_rows():
    """Nulls in every column, empty, blank and long texts, ties and repeated rows."""
    near = SHARED.replace("plain words here", "simple words here")
    texts = [None, "", " \n\t ", "one", "same text", "same text", SHARED, SHARED, near, "Intro. " + SHARED + "\nend of it è é",
             LONG, "1234 !!", "a" * 1000, "ab" * 400 + "è" * 300, "line\nline\nline\n\n" + SHARED, "é" * 99 + "\n" + "é" * 120,
             SHARED + " " + SHARED, "\x00 zero\x00", "</s>[INST] ok [/INST] <|endoftext|> a  b \n c"]
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    return [*rows, rows[6], rows[2], (30, "text", None, None, None), (31, SHARED + " tail", "de", None, None)]


@pytest.fixture(scope="session")
def awkward(spark):
    return spark.createDataFrame(awkward_rows(), DOCS)


@pytest.fixture(scope="session")
def clashing(awkward):
    """Extra columns with names that operators use inside."""
    from pyspark.sql import functions as F
    names = ("id", "uid", "root", "cell", "rep", "h", "spots", "spans", "start", "end", "n_removed", "bands", "k1", "shard", "slot", "key", "x", "size", "n", "kept")
    return awkward.select("*", *(F.lit(7).alias(c) for c in names))


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def nameless(spark):
    """Rows without an id."""
    return spark.createDataFrame([(None, SHARED, "en", "s", 1), (None, SHARED, "en", "s", 1), (1, SHARED, "en", "s", 1), (None, None, None, None, None)], DOCS)


@pytest.fixture(scope="session")
def corpus(spark, small_dir):
    df = spark.read.parquet(f"{small_dir}/documents.parquet")
    return df, {r.doc_id: r for r in df.collect()}
