"""CSV with line breaks inside quotes: by ranges of bytes, equal to reading each file in one task."""

import csv
import random

import pytest
from pyspark.sql import functions as F

from gridlark.sources.csv import read_csv
from gridlark.sources.records import quoted_records

TEXTS = ["plain", "two\nlines", 'a "quoted" word', "x,y", "", "\n\n", 'end"', '"', "é\nü\n", "tab\t", "much " * 30 + "\n" + "text " * 40, "a\r\nb"]


@pytest.fixture
def ranges(spark):
    """Files are cut into ranges of a few hundred bytes."""
    for key, value in (("spark.sql.files.maxPartitionBytes", "300"), ("spark.sql.files.openCostInBytes", "300")):
        spark.conf.set(key, value)
    yield
    for key in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
        spark.conf.unset(key)


def write(folder, seed, rows, end="\n"):
    rng = random.Random(seed)
    made = [(f"{seed}-{i}", str(rng.randrange(1000)), rng.choice(TEXTS)) for i in range(rows)]
    with open(folder / f"part-{seed}.csv", "w", newline="", encoding="utf-8") as out:
        writer = csv.writer(out, lineterminator=end, quoting=csv.QUOTE_MINIMAL if seed % 2 else csv.QUOTE_ALL)
        writer.writerow(["key", "n", "note\nof row"])
        writer.writerows(made)
    return made


def expected(made):
    return sorted((k, float(n), t or None) for k, n, t in made)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_ranges_give_whole_records(spark, ranges, tmp_path, end):
    made = [row for seed in range(4) for row in write(tmp_path, seed, 150 * seed + 1, end)]
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 50
    assert quoted_records(spark, str(tmp_path)).count() == len(made)
    df = read_csv(spark, str(tmp_path), multi_line=True)
    assert dict(df.dtypes) == {"key": "string", "n": "double", "note\nof row": "string"}
    assert sorted(str(tuple(r)) for r in df.collect()) == sorted(map(str, expected(made)))


def test_equal_to_one_task_a_file(spark, ranges, tmp_path):
    write(tmp_path, 1, 400)
    mine = read_csv(spark, str(tmp_path), multi_line=True)
    one = spark.read.csv(str(tmp_path), header=True, multiLine=True, quote='"', escape='"').toDF("key", "n", "note")
    assert sorted(str(tuple(r)) for r in mine.select("key", mine.columns[2]).collect()) == sorted(str((r[0], r[2] or None)) for r in one.collect())


def test_a_record_over_many_ranges(spark, ranges, tmp_path):
    long = "line of text\n" * 400
    with open(tmp_path / "a.csv", "w", newline="") as out:
        csv.writer(out, lineterminator="\n").writerows([["a", "b"], ["1", long], ["2", "x"], ["3", long + "end"]])
    rows = {r[0]: r[1] for r in read_csv(spark, str(tmp_path), multi_line=True).collect()}
    assert rows == {1.0: long, 2.0: "x", 3.0: long + "end"}


def test_a_header_over_many_ranges(spark, ranges, tmp_path):
    name = "a long name\n" * 60
    with open(tmp_path / "a.csv", "w", newline="") as out:
        csv.writer(out, lineterminator="\n").writerows([["a", name], ["1", "x\ny"], ["2", "z"]])
    assert sorted(r[0].partition(",")[0] for r in quoted_records(spark, str(tmp_path)).collect()) == ["1", "2"]


def test_empty_header_only_and_unended(spark, tmp_path):
    for name, text, rows in (("e.csv", "", 0), ("h.csv", 'a,"b\nc"\n', 0), ("u.csv", 'a,b\n1,"x\ny"', 1), ("blank.csv", "a,b\n\n1,2\n\n\n", 1)):
        (tmp_path / name).write_text(text)
        assert read_csv(spark, str(tmp_path / name), multi_line=True).count() == rows
    with pytest.raises(FileNotFoundError):
        read_csv(spark, str(tmp_path / "absent.csv"), multi_line=True)


def test_too_many_fields_fail_here_too(spark, tmp_path):
    (tmp_path / "w.csv").write_text('a,b\n1,"x\ny"\n1,2,3\n')
    with pytest.raises(Exception, match="more than 2 fields"):
        read_csv(spark, str(tmp_path / "w.csv"), multi_line=True).collect()
