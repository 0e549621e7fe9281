"""Small awkward inputs for the operators' tests."""

import random

DOC_SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, score string, size string, id string, _id string, last string"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def prose(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + rng.choice(["", "a", "ing", "s"]) for _ in range(n))


def awkward_documents(spark):
    """Nulls in every column, empty and long texts, copies, repeated rows, clashing extra columns."""
    rng = random.Random(3)
    long = prose(rng, 30_000)
    same = prose(rng, 40)
    rows = [
        (1, None, None, None, None), (None, "no id here at all", "en", "a", 5), (2, "", "en", "a", 0), (3, " \n\t ", "en", "b", 4),
        (4, long, "en", "a", len(long)), (5, same, "en", "b", 1), (6, same, "de", None, 1), (7, same, None, "b", 1),
        (8, "Ünï çødé 123 ###", "fr", "c", 3), (8, "Ünï çødé 123 ###", "fr", "c", 3), (9, "12 34 56", "en", "c", 8),
        (None, None, None, None, None), (10, "one\x00two", "en", "a", 7),
    ] + [(20 + i, prose(rng, 30 + i), "en", "hot", 9) for i in range(12)]
    return spark.createDataFrame([(*r, "s", "z", "i", "u", "l") for r in rows], DOC_SCHEMA)


def no_documents(spark):
    return spark.createDataFrame([], DOC_SCHEMA)
