import random

import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session", autouse=True)
def package_on_workers(spark):
    from learnlog.llm.queries import workers_find_package

    workers_find_package(spark)


@pytest.fixture(scope="session")
def edge_docs():
    """Texts with every special case: NULL, empty, blank, long, repeated, near copies, ties, odd characters."""
    rng = random.Random(7)
    vocabulary = ["".join(rng.choice("abcdefgéñß中") for _ in range(rng.randrange(1, 9))) for _ in range(300)]

    def prose(n):
        return " ".join(rng.choice(vocabulary) for _ in range(n))

    base, passage, long = prose(300), prose(80), prose(9000)
    edited = base.split()
    edited[150] = "changed"
    texts = [None, "", "   \n\t ", "one", "two words", "Two Words", base, base, " ".join(edited), base.upper(),
             prose(60) + "\n" + passage + "\n" + prose(60), passage + " " + prose(30), "a" * 3000, "ab " * 900, long,
             long + " tail", prose(200) + " " + passage, "\x0b\x0c\x1c\x85 x y", "😀 " * 60,
             "line\nline\n\n line\nline", prose(25), prose(19), prose(20)]
    texts += [base.replace(w, w + "x", 1) for w in edited[:20]]
    rows = [(i * 3, t, rng.choice(["en", "de", None]), "s", 0) for i, t in enumerate(texts)]
    rows += [(6 * 3, base, "en", "s", 0), (None, base, "en", None, None), (None, passage, None, "s", 0)]
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="session")
def edge_frame(spark, edge_docs):
    """The rows with extra columns whose names clash with the operators' own."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(edge_docs, DOC_SCHEMA).repartition(5)
    return df.withColumns({c: F.lit("x") for c in ("id", "_id", "_text", "_chunk", "n", "label", "kept", "node", "length", "score", "bucket")})


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOC_SCHEMA)
