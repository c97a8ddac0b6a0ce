import pytest

LONG = " ".join(f"word{i % 5003} filler{i % 17}" for i in range(60_000))
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, h string, key int, pos int, seed int, fp string, c int, w int, label string"


def row(doc_id, text, lang="en", source="src1"):
    return (doc_id, text, lang, source, None, "x", "y", 1, 2, 3, "z", 4, 5, "l")


@pytest.fixture(scope="session")
def docs(spark):
    """Edge rows: nulls, blanks, a long text, repeated rows, a null id, clashing column names."""
    rows = [
        row(1, None),
        row(2, ""),
        row(3, " \t\n\x0b "),
        row(4, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon"),
        row(4, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon"),
        row(5, "Alpha  beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon", None, None),
        row(6, LONG, "de", "src2"),
        row(7, "123 456 !!", "fr", "src12"),
        row(None, "a text without an id, and with some words", "en", "src17"),
        row(8, "été où ça 漢字 \U0001f389 é", "fr", None),
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
