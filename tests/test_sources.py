import gzip

import pytest
from frames import sales
from pyspark.sql import functions as F

from tillmart.fixture.queries import registry
from tillmart.schema import SALES, SALES_COLUMNS, jdbc_column_types
from tillmart.sources import csv_feed
from tillmart.sources.csv_feed import CORRUPT, SOURCE_FILE, decimals, reject_rows, scan_csv_folder
from tillmart.sources.tables import Target

COLUMNS = list(SALES_COLUMNS)


def write_csv(folder, name, header, *rows):
    lines = [",".join(header)] + [",".join("" if r.get(c) is None else str(r[c]) for c in header) for r in rows]
    (folder / name).write_text("\n".join(lines) + "\n")


@pytest.fixture
def row(spark):
    return sales(spark, {}).collect()[0].asDict()


def test_codes_stay_text(spark, tmp_path, row):
    write_csv(tmp_path, "a.csv", COLUMNS, {**row, "customer_postal_code": "00123"})
    write_csv(tmp_path, "b.csv", COLUMNS, {**row, "customer_postal_code": "AB-1"})
    write_csv(tmp_path, "notes.txt", ["id"], {"id": 9})
    read = scan_csv_folder(spark, str(tmp_path))
    assert read.schema == SALES
    assert sorted(r["customer_postal_code"] for r in read.collect()) == ["00123", "AB-1"]


def test_inference_covers_all_files(spark, tmp_path, row):
    write_csv(tmp_path, "a.csv", COLUMNS, {**row, "customer_postal_code": "123"})
    write_csv(tmp_path, "b.csv", COLUMNS, {**row, "customer_postal_code": "AB-1"})
    read = scan_csv_folder(spark, str(tmp_path), infer=True)
    assert dict(read.dtypes)["customer_postal_code"] == "string"
    assert dict(read.dtypes)["customer_age"] == "int"
    assert sorted(r["customer_postal_code"] for r in read.collect()) == ["123", "AB-1"]


def test_columns_are_found_by_name_and_others_ignored(spark, tmp_path, row):
    header = ["customer_pet", *reversed(COLUMNS)]
    write_csv(tmp_path, "a.csv", header, {**row, "customer_pet": "cat"})
    assert scan_csv_folder(spark, str(tmp_path)).collect()[0].asDict() == row


def test_different_headers_fail_unless_mixed(spark, tmp_path, row):
    write_csv(tmp_path, "a.csv", COLUMNS, row)
    write_csv(tmp_path, "b.csv", COLUMNS[::-1], {**row, "id": 2})
    write_csv(tmp_path, "c.csv", [c for c in COLUMNS if c != "store_state"], {**row, "id": 3})
    with pytest.raises(Exception, match="CSV header"):
        scan_csv_folder(spark, str(tmp_path)).collect()
    read = {r["id"]: r for r in scan_csv_folder(spark, str(tmp_path), mixed=True).collect()}
    assert read[1].asDict() == row
    assert read[2].asDict() == {**row, "id": 2}
    assert read[3].asDict() == {**row, "id": 3, "store_state": None}


def test_source_file_and_malformed_lines(spark, tmp_path, row):
    write_csv(tmp_path, "a.csv", COLUMNS, row)
    (tmp_path / "a.csv").open("a").write("2,only,three\n")
    read = scan_csv_folder(spark, str(tmp_path), source_file=True, corrupt_row=True, rejects=True).cache()
    by_id = {r["id"]: r for r in read.collect()}
    assert by_id[1][SOURCE_FILE].endswith("a.csv")
    assert by_id[1][CORRUPT] is None and by_id[1]["rejected"] == []
    assert by_id[2]["customer_age"] is None and by_id[2][CORRUPT] == "2,only,three"
    assert [tuple(r)[1:] for r in reject_rows(read).collect()] == [(2, CORRUPT, "2,only,three", "malformed")]


@pytest.mark.parametrize("mixed", [False, True])
def test_values_that_fit_are_taken_and_others_told(spark, tmp_path, row, mixed):
    money = {"product_price": "123456789.00", "sale_total_price": "1234567890123456.78"}
    write_csv(tmp_path, "a.csv", COLUMNS, {**row, "customer_age": "34.0", "sale_quantity": " 3.0 ", **money})
    write_csv(tmp_path, "b.csv", COLUMNS, {**row, "id": 2, "customer_age": "old", "sale_quantity": "2.5", "sale_total_price": "1.005"})
    write_csv(tmp_path, "c.csv", COLUMNS, {**row, "id": "x", "customer_age": " ", "product_price": "1e2", "sale_total_price": "12345678901234567"})
    read = scan_csv_folder(spark, str(tmp_path), mixed=mixed, source_file=True, rejects=True).cache()
    by_id = {r["id"]: r for r in read.collect()}
    assert (by_id[1]["customer_age"], by_id[1]["sale_quantity"]) == (34, 3)
    assert {k: str(by_id[1][k]) for k in money} == money
    assert str(by_id[None]["product_price"]) == "100.00" and by_id[None]["customer_age"] is None
    told = {(r["id"], r["column_name"], r["value"], r["reason"]) for r in reject_rows(read).collect()}
    assert told == {
        (2, "customer_age", "old", "unreadable"),
        (2, "sale_quantity", "2.5", "unreadable"),
        (2, "sale_total_price", "1.005", "rounded"),
        (None, "id", "x", "unreadable"),
        (None, "sale_total_price", "12345678901234567", "unreadable"),
    }


@pytest.mark.parametrize(("text", "needed"), [
    ("1.25", 2), ("1.250", 2), ("125e-2", 2), ("0.0125E2", 2), ("34.0", 0), ("34.", 0), ("5e3", 0), ("100e-4", 2), ("-1.00000000001", 11),
    ("1e-11", 11), ("0e-30", 0), ("0.000", 0), (".5", 1), ("+7", 0), ("10", 0), ("x", None), ("1e", None), ("1.2.3", None), ("1" * 30 + ".5", 1),
    ("12345.678e3", 0), ("12345.6789e3", 1), ("1e99999999999", 0),
])
def test_decimals_of_a_text(spark, text, needed):
    assert spark.range(1).select(decimals(F.lit(text)).alias("d")).first()["d"] == needed


def test_every_rounded_value_is_told(spark, tmp_path, row):
    texts = ["1.00000000001", "1.005", "1e-11", "1.000000000000", "100e-4", "2.50"]
    whole = ["3.00000000001", "3.0", "30e-1", "3", "3.000000000000", "35e-1"]
    for n, (money, count) in enumerate(zip(texts, whole, strict=True)):
        write_csv(tmp_path, f"{n}.csv", COLUMNS, {**row, "id": n, "sale_total_price": money, "sale_quantity": count})
    read = scan_csv_folder(spark, str(tmp_path), source_file=True, rejects=True).cache()
    told = {(r["id"], r["column_name"], r["reason"]) for r in reject_rows(read).collect()}
    assert told == {(n, "sale_total_price", "rounded") for n in (0, 1, 2)} | {(n, "sale_quantity", "unreadable") for n in (0, 5)}
    taken = {r["id"]: (str(r["sale_total_price"]), r["sale_quantity"]) for r in read.collect()}
    assert taken == {0: ("1.00", None), 1: ("1.01", 3), 2: ("0.00", 3), 3: ("1.00", 3), 4: ("0.01", 3), 5: ("2.50", None)}


def test_reading_first_lines_leaves_the_session_alone(spark, tmp_path, row, monkeypatch):
    write_csv(tmp_path, "a.csv", COLUMNS, row)
    write_csv(tmp_path, "b.csv", COLUMNS[::-1], {**row, "id": 2})
    touched = []
    kind, put, drop = type(spark.conf), type(spark.conf).set, type(spark.conf).unset
    monkeypatch.setattr(kind, "set", lambda conf, key, value: (touched.append((conf, key)), put(conf, key, value))[1])
    monkeypatch.setattr(kind, "unset", lambda conf, key: (touched.append((conf, key)), drop(conf, key))[1])
    before = dict(spark.conf.getAll)
    assert scan_csv_folder(spark, str(tmp_path), mixed=True).count() == 2
    assert dict(spark.conf.getAll) == before and touched and all(conf is not spark.conf for conf, _ in touched)


def test_types_are_inferred_over_all_layouts(spark, tmp_path, row):
    write_csv(tmp_path, "a.csv", COLUMNS, {**row, "customer_postal_code": "123", "sale_quantity": "1"})
    write_csv(tmp_path, "b.csv", COLUMNS[::-1], {**row, "id": 2**40, "customer_postal_code": "AB-1", "sale_quantity": "1.5"})
    read = scan_csv_folder(spark, str(tmp_path), mixed=True, infer=True)
    kinds = dict(read.dtypes)
    assert [kinds[c] for c in ("id", "customer_postal_code", "sale_quantity", "customer_age")] == ["bigint", "string", "double", "int"]
    assert sorted(r["customer_postal_code"] for r in read.collect()) == ["123", "AB-1"]


def test_headers_are_read_by_one_job(spark, tmp_path, row):
    for n in range(30):
        write_csv(tmp_path, f"{n}.csv", COLUMNS if n % 2 else COLUMNS[::-1], {**row, "id": n})
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("headers", "headers")
    read = scan_csv_folder(spark, str(tmp_path), mixed=True)
    jobs = len(tracker.getJobIdsForGroup("headers"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs <= 4
    assert sorted(r["id"] for r in read.collect()) == list(range(30))


@pytest.mark.parametrize("mixed", [False, True])
def test_empty_folder_gives_no_rows(spark, tmp_path, mixed):
    read = scan_csv_folder(spark, str(tmp_path), mixed=mixed, source_file=True)
    assert read.columns == [*COLUMNS, SOURCE_FILE] and read.count() == 0


def test_jdbc_options():
    target = Target("jdbc:x", "jdbc", {"createTableOptions": "ENGINE = E()", "driver": "d"}, "star_schema.")
    options = target.write_options("dim_seller")
    assert options["url"] == "jdbc:x" and options["dbtable"] == "star_schema.dim_seller"
    assert options["createTableOptions"] == "ENGINE = E()" and options["driver"] == "d"
    assert options["createTableColumnTypes"] == jdbc_column_types("dim_seller")
    assert "email VARCHAR(200)" in options["createTableColumnTypes"]
    assert "createTableColumnTypes" not in target.write_options("top_products")


def test_cheap_checks_tell_what_taking_texts_apart_tells(spark):
    """Texts that the short ways take or leave alone need as many decimals as ``decimals`` says."""
    texts = ["34", "34.0", "34.", "+5.000", "-0", "007", "5e3", "5E-3", "1.25", "1.250", "1.255", "1.00000000001", ".5", ".", "", "e", "1.2.3",
             "x1.2345", "12a", "1,5", "12345678901.0", "2.5", "0.0125e2", "125e-4"]
    rows = spark.createDataFrame([(t,) for t in texts], "value string")
    needs = csv_feed.decimals(F.col("value"))
    found = rows.select(
        "value", needs.alias("needs"), F.col("value").rlike(csv_feed._PLAIN_WHOLE).alias("plain"), csv_feed._long(F.col("value"), 2).alias("long")
    ).collect()
    assert all(r["needs"] == 0 for r in found if r["plain"]) and sum(r["plain"] for r in found) == 7
    assert all(r["long"] for r in found if r["needs"] is not None and r["needs"] > 2) and sum(not r["long"] for r in found) > 10


def test_absent_columns_are_not_counted(spark, tmp_path):
    (tmp_path / "a.csv").write_text("nothing,known\n1,2\n")
    found = scan_csv_folder(spark, str(tmp_path), mixed=True, infer=True)
    assert len(found.collect()) == 1 and {k for _, k in found.dtypes} == {"string"}
    texts = spark.createDataFrame([("1",)], "id string")
    assert csv_feed.inferred_types(texts, ["id"])["id"].simpleString() == "int"


def test_rejects_are_no_interpreted_filter(spark, tmp_path):
    """A filter of an array is interpreted, and so was every conversion in it."""
    (tmp_path / "a.csv").write_text("id,product_price\n1,1.005\n")
    scan = scan_csv_folder(spark, str(tmp_path), rejects=True)
    assert "lambda" not in scan._jdf.queryExecution().executedPlan().toString()
    assert [(r["column_name"], r["reason"]) for r in scan.first()["rejected"]] == [("product_price", "rounded")]


def test_packed_files_are_read(spark, tmp_path, row):
    """Files that are packed, beside plain ones."""
    write_csv(tmp_path, "a.csv", COLUMNS, row)
    write_csv(tmp_path, "b.csv", COLUMNS[::-1], {**row, "id": 2})
    (tmp_path / "b.csv.gz").write_bytes(gzip.compress((tmp_path / "b.csv").read_bytes()))
    (tmp_path / "b.csv").unlink()
    read = {r["id"]: r.asDict() for r in scan_csv_folder(spark, str(tmp_path), mixed=True).collect()}
    assert read == {row["id"]: row, 2: {**row, "id": 2}}


@pytest.mark.parametrize("name", ["scan_csv_folder", "union_sales_files", "ingest_rejects", "scan_csv_inferred"])
def test_feeds_are_packed(spark, folder, name):
    """As plain text a feed is several times its tables, and the largest part of what such a query writes."""
    files = registry()[name](spark, folder).inputFiles()
    assert files and all(f.endswith(".csv.gz") for f in files)
