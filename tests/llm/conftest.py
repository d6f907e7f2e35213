import pytest

from edge_texts import EDGES


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def edges(spark):
    """Edge texts with repeated rows, a null id, and columns named like those the operators make."""
    rows = [(i, text, "en", "s", len(text or ""), -1, "clash") for i, text in enumerate(EDGES)]
    rows += [rows[3], rows[8], (None, "a null id", None, None, 9, -1, "clash")]
    schema = "doc_id long, text string, lang string, source string, n_chars long, tag long, _row string"
    return spark.createDataFrame(rows, schema).cache()


@pytest.fixture(scope="session")
def none(edges):
    return edges.where("doc_id > 1000")
