"""Reading and writing table files."""

import datetime as dt
import json
import re

from pyspark.sql import functions as F

from subjectflow.operators import spec
from subjectflow.sources import dataset_json, tables


def test_classic_file_casts_by_type(spark, tmp_path):
    doc = {
        "datasetJSONVersion": "1.1.0", "itemGroupOID": "tv", "records": 3, "name": "tv", "label": [],
        "columns": [
            {"dataType": "string", "length": 4, "itemOID": "A", "name": "A", "label": "Text"},
            {"dataType": "decimal", "itemOID": "N", "name": "N", "label": "Number", "targetDataType": "decimal"},
            {"dataType": "date", "itemOID": "D", "name": "D", "label": "Day", "displayFormat": "DATE9."},
            {"dataType": "integer", "itemOID": "I", "name": "I", "label": "Whole"},
        ],
        "rows": [["x", "  1.0", "2020-01-02", 3], ["", "NA", None, None], [None, " -7", "", "4"]],
    }
    path = tmp_path / "tv.json"
    path.write_text(json.dumps(doc))
    df = dataset_json.read_dataset_json(spark, str(path))
    assert [tuple(r) for r in df.collect()] == [("x", 1.0, dt.date(2020, 1, 2), 3), ("", None, None, None), (None, -7.0, None, 4)]
    assert df.schema["D"].metadata == {"label": "Day", "displayFormat": "DATE9."}
    assert dict(df.dtypes)["N"] == "double"
    exact = dataset_json.read_dataset_json(spark, str(path), decimals_as_floats=False)
    assert dict(exact.dtypes)["N"] == "decimal(38,18)"
    loaded = tables.load_tables(spark, str(tmp_path), ["tv", "tv"], "dataset-json", blanks_as_null=True, views=True)
    assert list(loaded) == ["tv"] and loaded["tv"].filter("A is null").count() == 2 and spark.table("tv").count() == 3


def test_line_delimited_round_trip(spark, tmp_path):
    df = spark.createDataFrame(
        [("a", 1, 0.1, dt.date(2020, 1, 1), dt.datetime(2020, 1, 1, 2, 3, 4, 500), True), ("", None, None, None, None, None), ('q"\n,', -5, 1e-17, None, None, False)],
        "s string, i long, f double, d date, t timestamp_ntz, b boolean",
    ).repartition(3)
    table = spec.TableSpec("demo", "Demo", (spec.ColumnSpec("s", label="Text", length=9, key=1), spec.ColumnSpec("d", format="DATE9.")))
    path = dataset_json.write_dataset_ndjson(df, str(tmp_path / "demo"), "demo", spec=table)
    back = dataset_json.read_dataset_ndjson(spark, path)
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))
    assert back.dtypes == df.dtypes
    meta = dataset_json.read_metadata(spark, path).first()
    assert (meta.records, meta.name, meta.label, meta.itemGroupOID) == (3, "DEMO", "Demo", "IG.DEMO")
    column = {c.name: c for c in meta.columns}
    assert (column["s"].itemOID, column["s"].label, column["s"].length, column["s"].keySequence) == ("IT.DEMO.s", "Text", 9, 1)
    assert (column["d"].dataType, column["d"].targetDataType, column["d"].displayFormat) == ("date", "integer", "DATE9")
    assert (column["f"].dataType, column["f"].length) == ("decimal", None)


def test_convert_folder_skips_and_profiles(spark, tmp_path):
    df = spark.createDataFrame([("ab", 1), ("abcd", 2)], "s string, i int")
    profile = tables.convert_folder(spark, {"DM": df, "TS": df}, str(tmp_path / "out"), {"dm": "Demographics"})
    assert {(r.dataset, r.name, r.data_type, r.length) for r in profile.collect()} == {("dm", "s", "string", 4), ("dm", "i", "integer", None)}
    assert not (tmp_path / "out" / "ts").exists()
    assert dataset_json.read_metadata(spark, str(tmp_path / "out" / "dm")).first().label == "Demographics"


def test_define_labels(spark, tmp_path):
    path = tmp_path / "define.xml"
    path.write_text(
        '<?xml version="1.0"?>\n<ODM xmlns:def="urn:def"><Study><MetaDataVersion>'
        '<ItemGroupDef OID="dm" Label="Demographics"><ItemRef ItemOID="x"/></ItemGroupDef>'
        '<ItemGroupDef OID="ae" def:Label="Adverse Events"><ItemRef ItemOID="x"/></ItemGroupDef></MetaDataVersion></Study></ODM>'
    )
    assert {tuple(r) for r in tables.define_labels(spark, str(path)).collect()} == {("dm", "Demographics"), ("ae", "Adverse Events")}


def test_read_lines(spark, tmp_path):
    (tmp_path / "a.out").write_text("one\n\nthree\n")
    got = tables.read_lines(spark, str(tmp_path)).orderBy("line_no").collect()
    assert [(r.file, r.line_no, r.line) for r in got] == [("a.out", 1, "one"), ("a.out", 2, ""), ("a.out", 3, "three")]


def test_profile_of_empty_table(spark):
    df = spark.createDataFrame([], "s string, d date")
    assert {(r.name, r.data_type, r.length) for r in spec.profile_columns(df).collect()} == {("s", "string", 1), ("d", "date", None)}


def test_conform_orders_labels_and_sorts(spark):
    table = spec.TableSpec("T", "Label", (
        spec.ColumnSpec("b", label="Bee", format="DATE9.", key=2), spec.ColumnSpec("a", label="Ay", key=1, codelist=("x", "y")), spec.ColumnSpec("none"),
    ))
    df = spark.createDataFrame([("y", 1, 5), (None, 2, 6), ("x", 3, 7), ("q", 4, 8)], "a string, b int, extra int")
    out = spec.conform(df, table, sort=True)
    assert out.columns == ["b", "a"] and [r.a for r in out.collect()] == ["", "q", "x", "y"]
    assert out.schema["b"].metadata["label"] == "Bee" and out.schema["b"].metadata["displayFormat"] == "DATE9"
    assert [tuple(r) for r in spec.codelist_check(df, table).collect()] == [("a", "q", 1)]
    assert {tuple(r) for r in spec.codelist_check(df, table, missing_allowed=False).collect()} == {("a", "q", 1), ("a", None, 1)}


def test_select_dataset(spark):
    df = spark.createDataFrame([("ADSL", "x"), ("adae", "y")], "dataset string, variable string")
    assert [r.variable for r in spec.select_dataset(df, "ADAE").collect()] == ["y"]


def test_cells_survive_dataset_written_blank(spark, tmp_path):
    df = spark.createDataFrame([("x", None), ("", 1.5)], "s string, v double").withColumn("k", F.monotonically_increasing_id())
    path = dataset_json.write_dataset_ndjson(df, str(tmp_path / "b"), "b", records=2)
    assert sorted(r.s for r in dataset_json.read_dataset_ndjson(spark, path).collect()) == ["", "x"]


def test_plain_whole_numbers_are_cast_first_and_odd_ones_as_before(spark, tmp_path):
    cells = ["7", " 8 ", "9.0", "-3.000", "2e3", "9007199254740993", "9223372036854775807", "12345678901234567.0", None, "x", ""]
    columns = [{"itemOID": "IT.N", "name": "N", "label": "n", "dataType": "integer"}]
    (tmp_path / "whole.json").write_text(json.dumps({"columns": columns, "rows": [[c] for c in cells]}))
    df = dataset_json.read_dataset_json(spark, str(tmp_path / "whole.json"))
    assert [r.N for r in df.collect()] == [7, 8, 9, -3, 2000, 9007199254740993, 9223372036854775807, 12345678901234567, None, None, None]
    # the pattern for odd ones comes after the plain cast
    assert re.search(r"coalesce\(try_cast\(_r#\d+\[0\] as bigint\), .*regexp_replace", df._jdf.queryExecution().optimizedPlan().toString())
