import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, id int, size int, a int, n int, score double"


def sentence(i: int, n: int) -> str:
    return " ".join(f"w{(i * 7919 + k * 104729) % 5000}" for k in range(n))


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, ties, repeats, clashing names of extra columns."""
    long_ = "\n".join(sentence(k, 40) + "." for k in range(120))
    texts = [None, "", " \n\t ", "x", "one two", sentence(1, 30) + ".", sentence(1, 30) + ".", sentence(1, 29) + " changed.", long_, long_ + " end", "ünï çödé ß 漢字 🙂\nline\nline", "<|endoftext|> it's 12 ²½"]
    rows = [(i, t, ["en", "de", None][i % 3], [None, "s0", "s1"][i % 3], None if t is None else len(t), "k", i, 7, 1, 2, 0.5) for i, t in enumerate(texts)]
    rows.append((None, "no key here", None, "s0", 11, "k", 0, 0, 0, 0, None))
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
