import random

import duckdb
import pytest

from tests.conftest import SF_SMALL

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "th long, n long, token long, fp string, hash long, pos int, score double, ids string, start int, component string, ranges string")


def edge_rows() -> list[tuple]:
    """Small documents plus every odd case: nulls, empty and long texts, repeated rows and ids, ties."""
    rows = duckdb.sql(f"SELECT doc_id, text, lang FROM '{SF_SMALL}/documents.parquet' ORDER BY doc_id LIMIT 60").fetchall()
    benchmark = duckdb.sql(f"SELECT text FROM '{SF_SMALL}/benchmark.parquet' ORDER BY item_id LIMIT 3").fetchall()
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 6)))
    long = " ".join(word() for _ in range(20_000))
    near = rows[3][1].split(" ")
    rows += [
        (None, "A text without an id, and then some more of it.", "en"), (None, rows[0][1], None), (900, None, "en"), (901, "", None),
        (902, " \t\n ", "en"), (903, long, "en"), (904, long[5000:9000] + "ß" + long[:3000], "de"), (905, rows[5][1], "en"), (905, rows[5][1], "en"),
        (905, rows[6][1], "en"), (906, rows[5][1], "fr"), (907, "x" * 5000, None), (908, "ab " * 700, "en"), (909, "ab " * 700, "en"),
        (910, " ".join([*near[:-2], "zzz", "yyy"]), "en"), (911, " ".join(["new", *near[1:]]), "en"),
        (912, f"Licensed under the MIT License. MIT  license; GNU General Public License! cc-by cc by {benchmark[0][0].upper()}", "en"),
        (913, benchmark[1][0], "en"), (914, "a b c d", "en"), (915, "a b c d", "en"), (916, "A B c d", "en"), (917, "é" * 300, "fr"), (918, "é" * 299, "fr"),
        (919, "<|endoftext|> one<|endoftext|>\r\n\tTwo  three four \U0001f642", "en"), (920, "--- ... 12 34", "en"), (921, "\x00\x0b\x0c\x1f", "en"),
    ]
    return [(*r, "s", len(r[1]) if r[1] is not None else None, *[None] * 11) for r in rows]


@pytest.fixture(scope="session")
def rows():
    return edge_rows()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def benchmark(spark):
    rows = duckdb.sql(f"SELECT item_id, text FROM '{SF_SMALL}/benchmark.parquet'").fetchall()
    return spark.createDataFrame(rows + [(9001, "a b c d"), (9002, None), (9003, ""), (9003, ""), (None, "x y z"), (9004, "a b c d")], "item_id long, text string")


def got(frame, key="doc_id"):
    """Rows as sorted tuples, nulls first."""
    return sorted((tuple(r) for r in frame.collect()), key=lambda r: tuple((x is not None, str(type(x)), x) for x in r))
