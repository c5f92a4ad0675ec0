"""Multi-line CSV files and JSON arrays read in byte ranges, against the reader that takes a file as one task."""

import json
import random
from contextlib import contextmanager

import pytest

from quadspark.sources.splits import CsvPieces, JsonPieces, read_records
from quadspark.sources.tabular import read_csv_source, read_json_source


@contextmanager
def ranges_of(spark, size):
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    try:
        yield
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def bag(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def whole(spark, path, **options):
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", True)
    return reader.options(**options).csv(path)


VALUES = ["a", "", "b c", 'say "x"', "one\ntwo", "\n", '"', '""', "x,y", ",", "é𝄞\nü", "tail ", " lead", "a\n\n\nb", '"\n"', "',", "\\",
          "5\" disk"]


def write_csv(path, rows, line="\n", delimiter=",", quote='"', escape='"', bom="", last=True):
    def field(v):
        if any(c in v for c in (delimiter, quote, "\n", "\r", escape)) or v != v.strip():
            v = v.replace(escape, escape + escape) if escape != quote else v
            return quote + v.replace(quote, escape + quote) + quote
        return v

    text = line.join(delimiter.join(map(field, r)) for r in [["k", "first name", "v"], *rows])
    with open(path, "w", newline="", encoding="utf-8") as f:
        f.write(bom + text + (line if last else ""))


def random_rows(seed, n):
    rng = random.Random(seed)
    return [(f"k{i}", rng.choice(VALUES) * rng.choice([1, 1, 3]), rng.choice(VALUES)) for i in range(n)]


@pytest.mark.parametrize("size, form", [
    (9, {}), (80, {}), (100_000, {}), (70, {"line": "\r\n"}), (60, {"bom": "﻿", "last": False}),
    (50, {"delimiter": ";", "quote": "'"}), (90, {"escape": "\\"})])
def test_csv_equals_the_one_task_reader(spark, place, size, form):
    n = 25 if size < 20 else 120
    rows = [(k, a.replace("\n", form.get("line", "\n")), b) for k, a, b in random_rows(str(form), n)]
    write_csv(place + "/x.csv", rows, **form)
    options = {k: v for k, v in (("sep", form.get("delimiter")), ("quote", form.get("quote")), ("escape", form.get("escape"))) if v}
    want = whole(spark, place + "/x.csv", **options)
    with ranges_of(spark, size):
        found = read_csv_source(spark, place + "/x.csv", multiline=True, **options)
        assert found.columns == want.columns
        assert bag(found) == bag(want)
    assert want.count() == n


def test_csv_is_read_by_many_tasks(spark, place):
    write_csv(place + "/x.csv", random_rows(5, 400))
    with ranges_of(spark, 500):
        records = read_records(spark, place + "/x.csv", CsvPieces())
        found = read_csv_source(spark, place + "/x.csv", multiline=True)
        assert records.rdd.getNumPartitions() > 8 and found.rdd.getNumPartitions() > 8
        assert records.where("header").collect()[0].record == "k,first name,v"


def test_one_field_over_many_ranges(spark, place):
    rows = [("a", "line\n" * 200, "x"), ("b", "y", "z"), ("c", '"\n' * 100, ""), ("d", "", "end\n")]
    write_csv(place + "/x.csv", rows)
    with ranges_of(spark, 50):
        found = bag(read_csv_source(spark, place + "/x.csv", multiline=True))
    assert found == sorted([tuple(v or None for v in r) for r in rows], key=str)


def test_several_files_each_with_its_header(spark, place):
    for i in range(4):
        write_csv(f"{place}/{i}.csv", [(f"{i}-{k}", a, b) for k, a, b in random_rows(i, 30)], last=i % 2 == 0)
    write_csv(place + "/empty.csv", [])
    with ranges_of(spark, 64):
        assert bag(read_csv_source(spark, place, multiline=True)) == bag(whole(spark, place))


def test_malformed_csv(spark, place):
    """Quotes that do not open a field, rows of other lengths, blank lines, and a quote that is never closed."""
    text = 'k,first name,v\n1,5" disk,x\n2,a"b"c,y\n\n3\n4,a,b,c,d\n   \n5,"q",\n6,"never closed\nat all,1'
    with open(place + "/x.csv", "w") as f:
        f.write(text)
    with ranges_of(spark, 9):
        assert bag(read_csv_source(spark, place + "/x.csv", multiline=True)) == bag(whole(spark, place + "/x.csv"))
    # The line break at the end of a file is no part of a field, even if that was never closed.
    with open(place + "/y.csv", "w") as f:
        f.write('k,v\n1,"open\n')
    assert bag(read_csv_source(spark, place + "/y.csv", multiline=True)) == [("1", "open")]


def test_typed_csv_and_options_for_one_task(spark, place):
    write_csv(place + "/x.csv", [("1", "a\nb", "2.5"), ("2", "", "x")])
    schema = "k int, n string, v double"
    want = spark.read.schema(schema).option("header", True).option("multiLine", True).csv(place + "/x.csv")
    assert bag(read_csv_source(spark, place + "/x.csv", True, schema=schema)) == bag(want)
    assert bag(read_csv_source(spark, place + "/x.csv", True, comment="1")) == bag(whole(spark, place + "/x.csv", comment="1"))


def test_folders_that_give_columns(spark, place):
    df = spark.createDataFrame([("a\nb", 1), ("c", 2)], "v string, part int")
    df.write.partitionBy("part").option("header", True).csv(place + "/csv")
    assert bag(read_csv_source(spark, place + "/csv", multiline=True)) == [("a\nb", 1), ("c", 2)]
    df.write.partitionBy("part").json(place + "/json")
    assert bag(read_json_source(spark, place + "/json")) == [("a\nb", 1), ("c", 2)]


def json_rows(seed, n):
    rng = random.Random(seed)
    texts = ["", "plain", "} ] {", '"', '\\"', "\\", "a\nb", "[}", "é𝄞", '","', "x" * 50]
    return [{"k": i, "t": rng.choice(texts), "o": {"a": [rng.choice(texts), "}"], "e": {}}, "l": [{"x": j} for j in range(rng.randrange(3))]}
            for i in range(n)]


@pytest.mark.parametrize("size, form", [
    (60, {}), (150, {"indent": 2}), (700, {"indent": 1, "ensure_ascii": False}), (33, {"separators": (",", ":")}), (100_000, {})])
def test_json_array_equals_the_one_task_reader(spark, place, size, form):
    with open(place + "/x.json", "w", encoding="utf-8") as f:
        f.write(json.dumps(json_rows(str(form), 40), **form) + "\n")
    want = spark.read.option("multiLine", True).json(place + "/x.json")
    with ranges_of(spark, size):
        found = read_json_source(spark, place + "/x.json")
        assert found.schema == want.schema
        assert bag(found) == bag(want)
        if size == 60:
            assert read_records(spark, place + "/x.json", JsonPieces()).rdd.getNumPartitions() > 8


def test_json_files_of_other_forms(spark, place):
    """One object, an empty array, an array of one, a BOM, and schema given."""
    texts = {"one": '{"k": 1, "o": {"x": {"y": "}"}}}', "none": " [ ] \n", "single": '\n[{"k": 2}]', "bom": '﻿[{"k": 3},\r\n{"k": 4}]'}
    for name, text in texts.items():
        with open(f"{place}/{name}.json", "w", encoding="utf-8") as f:
            f.write(text)
    for size in (4, 1000):
        with ranges_of(spark, size):
            assert sorted(r.k for r in read_json_source(spark, place, schema="k int").collect()) == [1, 2, 3, 4]


def test_quote_state_under_both_assumptions():
    step = CsvPieces().step()
    assert [step(p, 0)[0] for p in ('a,b', 'a,"b', '"a","b"', '"a""', '"a"",', 'a"b,c', '"a"x,"', '', '""', '"""')] == [
        0, 1, 0, 1, 1, 0, 1, 0, 0, 1]
    assert [step(p, 1)[0] for p in ('a,b', 'a"', '""', 'a","b', 'a",b', '"', 'a""b', '"x,"', '')] == [1, 0, 1, 1, 0, 0, 1, 1, 1]
    step = JsonPieces().step()
    assert step('[{"a": "x', 0) == (1, 2) and step('", "b": {', 1) == (0, 0) and step(r'\" still', 1) == (1, 0)
