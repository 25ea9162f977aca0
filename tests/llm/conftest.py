import random

import pytest

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega".split()


def texts(n=60, seed=5):
    rng = random.Random(seed)
    passage = " ".join(rng.choices(WORDS, k=40))
    out = []
    for i in range(n):
        words = rng.choices(WORDS, k=rng.choice([1, 2, 5, 30, 120]))
        t = " ".join(words)
        if i % 7 == 0:
            t = passage + ".\n" + t
        if i % 11 == 3 and i > 20:
            t = out[i - 11]
        out.append(t + (" é日本\t" if i % 5 == 0 else ""))
    return out


@pytest.fixture(scope="session")
def rows():
    """Documents with edge cases: null, empty and blank texts, a long one, a null id, repeated rows."""
    out = list(enumerate(texts()))
    out += [(100, None), (101, ""), (102, " \t\n"), (103, "Word " * 20_000), (104, "x" * 30_000), (None, out[0][1]), (7, out[7][1])]
    return out


def frame(spark, rows):
    """With further columns whose names the operators use inside."""
    full = [(i, t, "en", "s", len(t or ""), 1, "a", [1]) for i, t in rows]
    return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long, block int, fp string, spans array<int>").repartition(3)


@pytest.fixture(scope="session")
def docs(spark, rows):
    return frame(spark, rows).cache()


@pytest.fixture(scope="session")
def none(spark):
    return frame(spark, [(1, "a")]).where("doc_id > 1")


@pytest.fixture(scope="session")
def as_tables(spark, tmp_path_factory):
    def write(**tables):
        folder = tmp_path_factory.mktemp("tables")
        for name, df in tables.items():
            df.write.parquet(f"{folder}/{name}.parquet")
        return str(folder)

    return write
