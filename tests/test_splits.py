"""Files read by byte ranges: the same rows as the plain readers, whatever strings hold."""

import json
import random

import pytest
from pyspark.sql import functions as F

from subjectflow.sources import dataset_json, splits, tables

SPLIT = "spark.sql.files.maxPartitionBytes"


@pytest.fixture
def small_splits(spark):
    old, opened = spark.conf.get(SPLIT), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set(SPLIT, "2000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield spark
    spark.conf.set(SPLIT, old)
    spark.conf.set("spark.sql.files.openCostInBytes", opened)


def _doc(rows, **extra):
    columns = [
        {"itemOID": "S", "name": "S", "label": "a [b] \"rows\":[[1]]", "dataType": "string"}, {"itemOID": "I", "name": "I", "label": "Whole", "dataType": "integer"},
        {"itemOID": "N", "name": "rows", "label": "Number", "dataType": "decimal"},
    ]
    return {"datasetJSONVersion": "1.1.0", "label": [], "note": "]]\\", **extra, "columns": columns, "rows": rows}


def _hard(chance):
    return "".join(chance.choice(["]", "[", "],[", '"', "\\", "\\\\", '\\"', "a", " ", "é", "\n", "{", "}", ",", '"rows":[[', "]]"]) for _ in range(chance.randint(0, 30)))


@pytest.mark.parametrize("layout", [{}, {"indent": 1}, {"separators": (",", ":")}])
def test_classic_file_by_ranges(small_splits, tmp_path, layout):
    spark, chance = small_splits, random.Random(7)
    rows = [[_hard(chance), chance.choice([i, f"{i}.0", None]), chance.choice([f" {i / 4}", i / 4, None])] for i in range(700)]
    path = tmp_path / "t.json"
    path.write_text(json.dumps(_doc(rows), **layout), encoding="utf-8")
    plain = dataset_json.read_dataset_json(spark, str(path))
    split = dataset_json.read_dataset_json_split(spark, str(path))
    assert splits.records(spark, str(path), "]").rdd.getNumPartitions() > 8
    assert split.schema == plain.schema
    assert sorted(map(str, split.collect())) == sorted(map(str, plain.collect())) and plain.count() == 700
    assert plain.filter("S is not null").count() == 700


def test_layouts_of_the_object(spark, tmp_path):
    whole = _doc([["x]", 1, "2"], [None, None, None]])
    for i, keys in enumerate((list(whole), list(reversed(whole)))):
        path = tmp_path / f"{i}.json"
        path.write_text(json.dumps({k: whole[k] for k in keys}) + "\n")
        assert sorted(map(str, dataset_json.read_dataset_json_split(spark, str(path)).collect())) == sorted(map(str, dataset_json.read_dataset_json(spark, str(path)).collect()))
    assert dataset_json.read_dataset_json_split(spark, str(tmp_path)).count() == 4
    (tmp_path / "none.json").write_text(json.dumps(_doc([])))
    assert dataset_json.read_dataset_json_split(spark, str(tmp_path / "none.json")).collect() == []
    (tmp_path / "other.json").write_text(json.dumps({"columns": [{"name": "Z", "dataType": "string"}], "rows": [["z"]]}))
    with pytest.raises(ValueError, match="different"):
        dataset_json.read_dataset_json_split(spark, str(tmp_path))


@pytest.mark.parametrize("reader", [dataset_json.read_dataset_json, dataset_json.read_dataset_json_split])
def test_integer_cells(spark, tmp_path, reader):
    def read(*cells):
        path = tmp_path / f"{abs(hash(cells))}-{reader.__name__}.json"
        path.write_text(json.dumps({"columns": [{"name": "I", "dataType": "integer"}], "rows": [[c] for c in cells]}))
        return [r.I for r in reader(spark, str(path)).collect()]

    assert sorted(read("1.0", " 2", "1e3", "4.", "-5.000", 6, 7.0)) == [-5, 1, 2, 4, 6, 7, 1000]
    assert read("NA") == [None] and read("") == [None] and read(None) == [None]
    for cell in ("1.5", "1e-3", "1e300"):
        with pytest.raises(Exception, match="can't hold the number"):
            read(cell)


def test_lines_of_split_files(small_splits, tmp_path):
    spark, chance = small_splits, random.Random(3)
    lines = {n: [chance.choice(["", "x" * chance.randint(0, 80), "tab\there", "é\rè"]) for _ in range(400)] for n in ("a.out", "b.out")}
    (tmp_path / "a.out").write_bytes("\n".join(lines["a.out"]).encode() + b"\n")
    (tmp_path / "b.out").write_bytes("\r\n".join(lines["b.out"]).encode() + b"\r\nlast")
    (tmp_path / "empty.out").write_text("")
    got = tables.read_lines(spark, str(tmp_path))
    assert splits.records(spark, str(tmp_path), "\n").rdd.getNumPartitions() > 4
    expected = [(n, i, x) for n, held in (("a.out", lines["a.out"]), ("b.out", [*lines["b.out"], "last"])) for i, x in enumerate(held, 1)]
    assert sorted((r.file, r.line_no, r.line) for r in got.collect()) == sorted(expected)


def test_larger_file(spark, tmp_path):
    path = tmp_path / "big.json"
    rows = ",".join(json.dumps([f"v{i}]" if i % 3 else f'["{i}', i, f"{i}.25"]) for i in range(200_000))
    head = json.dumps(_doc([]))[:-2]
    path.write_text(head + rows + "]}")
    found = dataset_json.read_dataset_json_split(spark, str(path))
    assert found.agg(F.count("*"), F.sum("I"), F.sum("rows"), F.count_distinct("S")).first()[:] == (200_000, 19999900000, 19999950000.0, 200_000)
