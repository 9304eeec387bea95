"""Small inputs for the tests."""

import random

import pytest

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()


def prose(seed, n):
    choice = random.Random(seed)
    return " ".join(choice.choice(WORDS) + str(choice.randrange(60)) for _ in range(n))


def odd(values):
    return sorted(values, key=repr)


# nulls, empty and blank texts, repeated rows, ties, one text under many ids
ODD_TEXTS = [
    None,
    "",
    " \n\t",
    "\n\n",
    "one",
    "One",
    "two words",
    "Ünïcödé wörds É É É É 𝒳𝒴 here",
    "line\nLINE \n line\nother",
    "a b c d e f g h i j k l m n o p q r s t u v w x y z",
    "a B c d e f g h i j k l m n o p q r s t u v w x y Z",
]


@pytest.fixture(scope="session")
def documents(spark):
    """(doc_id, text) pairs as the table ``documents`` with columns whose names clash."""

    def make(rows):
        full = [(i, t, None, f"src{k % 3}" if k % 5 else None, None) for k, (i, t) in enumerate(rows)]
        extra = ", ".join(f"{c} string" for c in ("_id", "_text", "_row_key", "_key", "c", "n", "id", "_place"))
        return spark.createDataFrame([(*r, *["x"] * 8) for r in full], f"{COLUMNS}, {extra}")

    return make


@pytest.fixture(scope="session")
def odd_rows():
    rows = list(enumerate(ODD_TEXTS * 2))
    return rows + rows[:6] + [(None, "null id alpha beta gamma delta"), (None, None)] + [(900, prose(1, 4000))] * 2
