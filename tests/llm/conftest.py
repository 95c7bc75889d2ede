import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SF = "/root/testdata/sf0.001"
LONG = " ".join(f"word{i % 977} and{i % 13}" for i in range(30_000))


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with nulls, empty and very long texts, repeated rows and clashing columns."""
    rows = [(1, "one two three four", "a"), (1, "one two three four", "a"), (2, None, "b"), (3, "", None), (None, "no id", "c"),
            (None, None, None), (4, LONG, "d"), (5, "one two three four", "e"), (6, " \n\t ", "f"), (7, "<|endoftext|> x", "g")]
    extra = (", length long, start string, sequence_id int, v int, root string, _b int, slot string, shard string, entries int, "
             "doc string, xx int, _id int, _digest int, _own string, _key int, `odd``name.x` string")
    return spark.createDataFrame([(*r, 1, "s", 2, 3, "r", 4, "t", "h", 9, "d", 5, 6, 7, "o", 8, "q") for r in rows],
                                 "doc_id long, text string, source string" + extra)


@pytest.fixture(scope="session")
def none(odd):
    return odd.where("false")


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def texts(docs):
    return {r[0]: r[1] or "" for r in docs.select("doc_id", "text").collect()}


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path / "store")
