import os

import pytest

os.environ.setdefault("PYTHONPATH", os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

LONG = "Wörter über alles, the long text. " * 6000


@pytest.fixture()
def odd_docs(spark):
    """Nulls, empty and very long texts, rows stored twice, ids that are
    missing or carry two texts, and columns with clashing names."""
    rows = [(1, "a b c"), (2, None), (3, ""), (4, LONG), (5, "a b c"), (5, "a b c"), (None, "no id"), (6, "x"), (6, "y  z\n"),
            (7, " \t\n"), (8, "▁ \x00 İΣ <s> <|endoftext|> \U0001f642")]
    return spark.createDataFrame([(i, t, "en", None, 1, 2, "s", 0.5) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, row long, n long, blob string, score double")


@pytest.fixture()
def no_docs(odd_docs):
    return odd_docs.limit(0)


@pytest.fixture()
def as_table(tmp_path):
    """Writes a DataFrame as one table of a data folder."""
    def write(df, name, folder="data"):
        df.write.mode("overwrite").parquet(str(tmp_path / folder / f"{name}.parquet"))
        return str(tmp_path / folder)
    return write
