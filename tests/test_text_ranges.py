"""Byte ranges of quoted text, and the index of file layouts."""

import csv
import io
import os
import random
import re
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from gridmart.session import read_version
from gridmart.sources import layouts, records
from gridmart.sources.tsv import scan_tsv

HEADER = "DateTime(UTC)\tName\tNote"


@contextmanager
def cut_into(spark, size):
    """Files are cut into ranges of ``size`` bytes."""
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(k) for k in keys]
    for k in keys:
        spark.conf.set(k, str(size))
    yield
    for k, v in zip(keys, before, strict=True):
        spark.conf.set(k, v)


def expected_records(text):
    """The records as Python's csv module ends them."""
    lines = text.split("\n")
    reader, out, at = csv.reader(io.StringIO(text), delimiter="\t"), [], 0
    for _ in reader:
        out.append("\n".join(lines[at:reader.line_num]))
        at = reader.line_num
    return out


def bytes_read(spark):
    """Bytes that this process's Hadoop file systems have read."""
    return sum(s.getBytesRead() for s in spark.sparkContext._jvm.org.apache.hadoop.fs.FileSystem.getAllStatistics())


def test_line_functions_equal_the_automaton(spark):
    """Every line over a small alphabet: the state after it, from either state before."""
    def after(line, inside):
        state = "in" if inside else "begin"
        for c in line:
            if state == "in":
                state = "quote" if c == '"' else "in"
            elif state == "quote":
                state = "in" if c == '"' else "begin" if c == "\t" else "plain"
            elif c == "\t":
                state = "begin"
            elif state == "begin":
                state = "in" if c == '"' else "plain"
        return state == "in"

    alphabet, lines = 'a"\t', [""]
    for line in lines:
        if len(line) < 7:
            lines += [line + c for c in alphabet]
    rows = spark.createDataFrame([(x,) for x in lines], "v string").select(
        "v", F.col("v").rlike(records.ENDS_FROM_OUTSIDE).alias("a"), F.col("v").rlike(records.ENDS_FROM_INSIDE).alias("b"))
    for r in rows.collect():
        assert (r["a"], r["b"]) == (not after(r["v"], False), not after(r["v"], True)), r["v"]


def test_very_long_lines_match(spark):
    long = "\t".join(['"x""y"'] * 20000)
    row = spark.createDataFrame([(long, 'z"\t' + long + '\t"')], "a string, b string").select(
        F.col("a").rlike(records.ENDS_FROM_OUTSIDE).alias("a"), F.col("b").rlike(records.ENDS_FROM_INSIDE).alias("b")).first()
    assert (row["a"], row["b"]) == (True, False)


@pytest.mark.parametrize("seed", range(4))
def test_ranges_give_the_records_of_the_whole_file(spark, tmp, seed):
    """Quoted tabs and newlines, escapes, stray quotes, long quoted cells over several ranges, an open end."""
    rng = random.Random(seed)
    texts = []
    for k in range(3):
        parts = ['"', '""', "a", "bc", "\t", "\n", "\n", "é", '\t"', '"\t', " "] + (['"' + "long\n" * 30 + '"\t'] if seed % 2 else [])
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 200)))
        texts.append(text + rng.choice(["", "\n", '"open\nend']))
        with open(f"{tmp}/f {k}.csv", "w", newline="") as out:
            out.write(texts[-1])
    want = sorted(r for t in texts for r in expected_records(t) if r)
    for size in (60, 10000):
        with cut_into(spark, size):
            rows = records.quoted_records(spark, [tmp])
            found = sorted(r["record"] for r in rows.collect())
            if size == 60 and sum(map(len, texts)) > 500:
                assert rows.select("record").rdd.getNumPartitions() > 5
        assert [r.rstrip("\n") for r in found if r.strip("\n")] == [r.rstrip("\n") for r in want if r.strip("\n")]


def test_scan_by_ranges_equals_one_task_a_file(spark, tmp):
    """Two layouts, quoted tabs, newlines and quotes; the plan has many tasks for one file."""
    def write(name, order, n):
        with open(f"{tmp}/{name}", "w", newline="") as out:
            w = csv.writer(out, delimiter="\t", lineterminator="\r\n" if n % 2 else "\n")
            head = HEADER.split("\t")
            w.writerow([head[k] for k in order])
            for k in range(n):
                row = [f"2026-09-01 00:00:{k % 60:02d}", f'n"{k}"\t{name}\nline {k}' + "\n" * (k % 3) + "x" * (k % 50), f"{k}"]
                w.writerow([row[k] for k in order])

    write("a.csv", (0, 1, 2), 400)
    write("b.csv", (2, 1, 0), 301)
    wanted = ["Name", "DateTime(UTC)", "Note", "Absent"]
    whole = sorted(map(tuple, scan_tsv(spark, tmp, wanted, multi_line=True).collect()))
    assert len(whole) == 701 and sum("\n" in r[0] for r in whole) == 701
    with cut_into(spark, 700):
        for mode in ("ranges", "auto"):
            rows = scan_tsv(spark, tmp, wanted, multi_line=mode)
            assert sorted(map(tuple, rows.collect())) == whole
        assert records.quoted_records(spark, [f"{tmp}/a.csv"]).rdd.getNumPartitions() >= 10
    with pytest.raises(ValueError, match="multi_line"):
        scan_tsv(spark, tmp, wanted, multi_line="lines")


def test_other_ranges_than_before_fail(spark, tmp):
    with open(f"{tmp}/x.csv", "w") as out:
        out.write('a\t"b\nc"\n' * 100)
    with cut_into(spark, 64):
        rows = records.quoted_records(spark, [tmp])
    with cut_into(spark, 96), pytest.raises(Exception, match="other ranges"):
        rows.collect()


def test_no_quotes_need_no_python(spark, tmp):
    with open(f"{tmp}/x.csv", "w") as out:
        out.write("a\tb\n" * 100)
    with cut_into(spark, 64):
        rows = records.quoted_records(spark, [tmp])
        assert rows.count() == 100
    assert "MapInArrow" not in rows._jdf.queryExecution().toString()


def big_file(path, note, n=60000):
    with open(path, "w") as out:
        out.write(f"\n{HEADER}\n")
        out.writelines(f"2026-09-01 00:00:00\tname {k}\t{note} {k}\n" for k in range(n))


def test_the_text_is_read_once(spark, tmp):
    """Bytes read stay within 1.1 times the files, without an index, with a new one and with a known one."""
    for k in range(3):
        big_file(f"{tmp}/f{k}.csv", "x" * 30)
    size = sum(os.path.getsize(f"{tmp}/f{k}.csv") for k in range(3))
    for index in (None, f"{tmp}-index", f"{tmp}-index"):
        before = bytes_read(spark)
        scan_tsv(spark, [f"{tmp}/f{k}.csv" for k in range(3)], ["Name", "Note"], index_path=index).write.format("noop").mode("overwrite").save()
        assert bytes_read(spark) - before <= 1.1 * size


def test_known_files_are_not_opened(spark, tmp, monkeypatch):
    opened = []
    real = layouts.first_line
    monkeypatch.setattr(layouts, "first_line", lambda s, p: opened.append(p.rsplit("/", 1)[1]) or real(s, p))
    index = f"{tmp}-layouts"
    for name in ("a b.csv", "c.csv"):
        big_file(f"{tmp}/{name}", name, 5)
    open(f"{tmp}/empty.csv", "w").close()

    def scan():
        opened.clear()
        rows = scan_tsv(spark, tmp, ["Note"], index_path=index)
        return sorted(opened), rows.count()

    assert scan() == (["a b.csv", "c.csv"], 10)
    assert scan() == ([], 10)
    big_file(f"{tmp}/c.csv", "changed", 7)
    os.utime(f"{tmp}/c.csv", (1, 1))
    assert scan() == (["c.csv"], 12)
    big_file(f"{tmp}/d.csv", "new", 2)
    assert scan() == (["d.csv"], 14)
    rows = read_version(spark, index).collect()
    assert len(rows) == len({r["file_path"] for r in rows}) == 3  # Spark lists no empty file
    # Files of another folder leave what is known of these.
    os.mkdir(f"{tmp}-other")
    big_file(f"{tmp}-other/e.csv", "e", 3)
    assert scan_tsv(spark, f"{tmp}-other", ["Note"], index_path=index).count() == 3
    assert scan() == ([], 14)


def test_heads_in_groups_and_odd_first_lines(spark, tmp, monkeypatch):
    monkeypatch.setattr(layouts, "GROUP", 2)
    for k in range(5):
        with open(f"{tmp}/f{k}.csv", "w", encoding="utf-8-sig") as out:
            out.write(f"  \n\n{HEADER}\n1\t2\t{k}\n")
    index = layouts.file_layouts(spark, [tmp])
    assert sorted(r["header"] for r in index.collect()) == [HEADER] * 5
    assert layouts.header_layouts(index, "Name") == [HEADER]
    with pytest.raises(layouts.MissingHeaderError, match=re.escape("f0.csv")):
        layouts.header_layouts(index, "Nothing")


def test_byte_order_mark_is_no_cell(spark, tmp):
    with open(f"{tmp}/f.csv", "w", encoding="utf-8-sig") as out:
        out.write(f"{HEADER}\n2026\tx\ty\n")
    for mode in (True, "ranges"):
        assert [tuple(r)[:2] for r in scan_tsv(spark, tmp, ["DateTime(UTC)", "Note"], multi_line=mode).collect()] == [("2026", "y")]
