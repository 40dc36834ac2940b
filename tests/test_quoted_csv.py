"""Records with newlines inside quotes, found by many tasks, equal Spark's own one-task reader."""

import os
import random

import pytest
from pyspark.sql import functions as F

from martforge.sources import csv_ingest as ci
from martforge.sources import quoted_csv
from martforge.sources.contracts import RAW_COLUMNS

HEAD = ["a", "b", "c"]


def slow_state(text: str, state: int) -> int:
    """The state after a line, one character at a time."""
    where = "in" if state == quoted_csv.IN else "start"
    i = 0
    while i < len(text):
        c = text[i]
        if where == "in":
            if c == '"':
                if text[i + 1 : i + 2] == '"':
                    i += 1
                else:
                    where = "plain"
        elif c == ",":
            where = "start"
        else:
            where = "in" if where == "start" and c == '"' else "plain"
        i += 1
    return quoted_csv.IN if where == "in" else quoted_csv.OUT


def test_state_of_a_line():
    rng = random.Random(1)
    for _ in range(20_000):
        text = "".join(rng.choice('"",a\r') for _ in range(rng.randint(0, 12)))
        for state in (quoted_csv.OUT, quoted_csv.IN):
            assert quoted_csv.quoted_after(text.encode(), state) == slow_state(text, state), text


def _field(rng):
    kind = rng.random()
    if kind < 0.3:
        return "".join(rng.choice("ab é") for _ in range(rng.randint(1, 9)))
    if kind < 0.4:
        return ""
    if kind < 0.5:
        return 'x"y'  # a quote that opens nothing
    inner = "".join(rng.choice(['a', '\n', ',', '""', '\n\n', 'é', ' ']) for _ in range(rng.randint(0, 30)))
    return f'"{inner}"'


def _file(rng, path, rows, end="\n", last=True):
    lines = []
    for _ in range(rows):
        n = 3 if rng.random() < 0.85 else rng.choice([1, 2, 4, 5])
        line = ",".join(_field(rng) for _ in range(n))
        lines.append(line)
        if rng.random() < 0.1:
            lines.append("")  # empty lines are no records
    text = "\n".join([",".join(HEAD), *lines]) + ("\n" if last else "")
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(text.replace("\n", end))


def _both(spark, path):
    """Rows of the reader under test and of Spark's multiLine reader."""
    files = sorted(f"{path}/{n}" for n in os.listdir(path)) if os.path.isdir(path) else [path]
    mine = quoted_csv.read(spark, files, HEAD, "_bad")
    one_task = (spark.read.option("header", True).option("quote", '"').option("escape", '"').option("multiLine", True).option("mode", "PERMISSIVE")
                .option("columnNameOfCorruptRecord", "_bad").schema("a string, b string, c string, _bad string").csv(files))
    key = lambda r: tuple((x is not None, x) for x in r)
    null = lambda df: df.select(*[F.when(F.col(c) != "", F.col(c)).alias(c) for c in df.columns])  # noqa: E731  as NULL tokens do
    return (sorted((tuple(r) for r in null(mine).collect()), key=key), sorted((tuple(r) for r in null(one_task).collect()), key=key))


@pytest.fixture()
def tiny_ranges(spark):
    """Byte ranges of some 128 bytes."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    for k in old:
        spark.conf.set(k, "128")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("seed", [1, 2])
def test_equal_to_the_one_task_reader(spark, tmp_dir, tiny_ranges, seed, end):
    rng = random.Random(seed)
    for n in range(3):
        _file(rng, f"{tmp_dir}/in/part-{n}.csv", 40, end, last=n != 1)
    assert quoted_csv._lines(spark, [f"{tmp_dir}/in/part-0.csv"]).rdd.getNumPartitions() > 10
    mine, want = _both(spark, f"{tmp_dir}/in")
    assert len(want) > 100 and mine == want


def test_a_record_over_many_ranges_and_an_open_quote(spark, tmp_dir, tiny_ranges):
    long = "line with, comma\n" * 40
    with open(f"{tmp_dir}/x.csv", "w") as f:
        f.write(f'a,b,c\n1,"{long}",z\n2,"short",y\n3,"{long}{long}",x\n4,5,6\n')
    mine, want = _both(spark, f"{tmp_dir}/x.csv")
    assert mine == want and len(mine) == 4 and max(len(r[1]) for r in mine) > 1000
    for text in ('a,b,c\n1,2,3\n4,"never closed\n5,6,7\n', "a,b,c\n", 'a,b,c\n"1","2","3"', 'a,b,c\n\n\n1,2,3\n\n'):
        with open(f"{tmp_dir}/y.csv", "w") as f:
            f.write(text)
        mine, want = _both(spark, f"{tmp_dir}/y.csv")
        ends = lambda rows: [tuple(x and x.rstrip("\n") for x in r[:3]) for r in rows]  # noqa: E731  an open quote keeps all but the last line end
        assert ends(mine) == ends(want), text


def test_one_reviews_file_is_read_by_many_tasks(spark, tmp_dir, tiny_ranges):
    path = f"{tmp_dir}/order_reviews.csv"
    with open(path, "w") as f:
        f.write(",".join(RAW_COLUMNS["order_reviews"]) + "\n")
        for n in range(60):
            f.write(f'r{n},o{n},5,"t ""{n}""","first line\n\nsecond, line",2018-01-01 00:00:00,\n')
        f.write("short,row\n")
    df = ci.read_raw_csv(spark, "order_reviews", path)
    rows = df.collect()
    assert len(rows) == 61 and sum(r["_bad"] == "short,row" for r in rows) == 1
    assert {r.review_comment_message for r in rows if r["_bad"] is None} == {"first line\n\nsecond, line"}
    assert quoted_csv._lines(spark, [path]).rdd.getNumPartitions() > 30


def test_part_files_with_their_own_headers(spark, tmp_dir):
    cols = RAW_COLUMNS["sellers"]
    base = f"{tmp_dir}/in"
    for t, c in RAW_COLUMNS.items():
        if t not in ("sellers", "order_reviews"):
            os.makedirs(base, exist_ok=True)
            open(f"{base}/{t}.csv", "w").write(",".join(c) + "\n")
    parts = {"sellers.csv/part-1.csv": ",".join(cols) + "\ns1,01037,a,SP\n",
             "sellers.csv/part-2.csv": ",".join(reversed(cols)) + "\nRJ,b,02000,s2\nRJ,b\n",
             "sellers.csv/part-3.csv": "seller_id,other\ns3,x\n", "sellers.csv/part-4.csv": "",
             "sellers.csv/_SUCCESS": "", "sellers.csv/_temporary/part-9.csv": "x\n",
             "sellers.csv/more/part-5.csv": ",".join(cols) + "\ns5,05000,e,MG\n",
             "order_reviews.csv/part-1.csv": ",".join(RAW_COLUMNS["order_reviews"]) + '\nr1,o1,5,t,"a\nb",2018-01-01,\n',
             "order_reviews.csv/part-2.csv": ",".join(reversed(RAW_COLUMNS["order_reviews"])) + '\n,2018-01-01,"c\nd",t,5,o2,r2\n',
             "order_reviews.csv/part-3.csv": "review\nr3\n"}
    for name, text in parts.items():
        os.makedirs(os.path.dirname(f"{base}/{name}"), exist_ok=True)
        open(f"{base}/{name}", "w").write(text)
    tables, report = ci.load_raw(spark, base, f"{tmp_dir}/raw")
    assert sorted(tuple(r) for r in tables["sellers"].collect()) == [
        ("s1", "01037", "a", "SP"), ("s2", "02000", "b", "RJ"), ("s5", "05000", "e", "MG")]
    assert sorted((r.review_id, r.review_comment_message) for r in tables["order_reviews"].collect()) == [("r1", "a\nb"), ("r2", "c\nd")]
    rep = {r.table_name: (r.rows_loaded, r.rows_rejected) for r in report.collect()}
    assert rep["sellers"] == (3, 1) and rep["order_reviews"] == (2, 0)
    out = [(r.table_name, os.path.basename(r.file), r.header) for r in ci.left_out(spark, f"{tmp_dir}/raw").collect()]
    assert out == [("order_reviews", "part-3.csv", "review"), ("sellers", "part-3.csv", "seller_id,other")]
    with pytest.raises(ci.ContractError):
        ci.read_raw_csv(spark, "order_reviews", f"{base}/order_reviews.csv")  # the strict reader takes one header only
