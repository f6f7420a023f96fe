"""Quoted newlines across byte ranges: equal to the reader that takes a file in one task."""

import csv
import io as text_io
import random

import pytest

from polyvox import schemas
from polyvox.sources.csvscan import read_csv, records

SCHEMA = schemas._schema("id bigint, body string, n int, note string")


@pytest.fixture(params=[48, 700, 1 << 20])
def ranges(spark, request):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    for k in old:
        spark.conf.set(k, str(request.param))
    yield request.param
    for k, v in old.items():
        spark.conf.set(k, v)


def rows(n, seed):
    rng = random.Random(seed)
    bits = ["plain", "a,b", 'say "no"', "two\nlines", '","', '""', '"', "\n", ",\n\"", "é ü", "x\n\n\ny", "tail,", 'end"\n"', "'"]
    return [(i, "".join(rng.choice(bits) for _ in range(rng.randrange(1, 6))) + "z", rng.randrange(9), rng.choice(["", "ok", 'q"', "a\nb"])) for i in range(n)]


def write(path, data, end="\n"):
    out = text_io.StringIO()
    w = csv.writer(out, lineterminator=end)
    w.writerow(["id", "body", "n", "note"])
    w.writerows(data)
    with open(path, "w", newline="") as fh:
        fh.write(out.getvalue())


def one_task(spark, path):
    df = spark.read.schema(SCHEMA).option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_ranges_equal_one_task(spark, tmp, ranges, end):
    for k in range(2):
        write(f"{tmp}/{k}.csv", rows(120, k), end)
    got = read_csv(spark, f"{tmp}/*.csv", SCHEMA)
    assert sorted(tuple(r)[1:] for r in got.collect()) == sorted(one_task(spark, f"{tmp}/0.csv") + one_task(spark, f"{tmp}/1.csv"))
    assert sorted(r["id"] for r in got.collect()) == sorted([*range(120)] * 2)
    if ranges == 48:
        assert records(spark, f"{tmp}/0.csv").select("block").distinct().count() > 20


def test_one_record_over_many_ranges(spark, tmp, ranges):
    data = [(1, "line\n" * 500 + "end", 2, ""), (2, 'x""\n' * 300, 3, "a")]
    write(f"{tmp}/a.csv", data)
    assert sorted((r["id"], r["body"], r["n"]) for r in read_csv(spark, f"{tmp}/a.csv", SCHEMA).collect()) == [d[:3] for d in data]


def test_a_wrong_quote_is_reported(spark, tmp):
    with open(f"{tmp}/bad.csv", "w") as fh:
        fh.write('id,body,n,note\n1,"open,2,x\n2,fine,3,y\n')
    with pytest.raises(Exception, match="never closed in .*bad.csv"):
        read_csv(spark, f"{tmp}/bad.csv", SCHEMA).collect()
    with open(f"{tmp}/type.csv", "w") as fh:
        fh.write("id,body,n,note\n1,a,many,x\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        read_csv(spark, f"{tmp}/type.csv", SCHEMA).collect()


def test_header_only_blank_lines_and_no_final_newline(spark, tmp):
    with open(f"{tmp}/h.csv", "w") as fh:
        fh.write("id,body,n,note\n")
    assert read_csv(spark, f"{tmp}/h.csv", SCHEMA).count() == 0
    with open(f"{tmp}/b.csv", "w") as fh:
        fh.write('id,body,n,note\n\n1,a,2,\n\n2,"b\n\nc",3,x')
    assert sorted((r["id"], r["body"], r["n"], r["note"]) for r in read_csv(spark, f"{tmp}/b.csv", SCHEMA).collect()) == [
        (1, "a", 2, None), (2, "b\n\nc", 3, "x")]
