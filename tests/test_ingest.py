import datetime as dt
import re

import pytest

from tallyframe.catalog.ingest import HEADER
from tallyframe.plans.ingest_report import ingest_report, reject_samples
from tallyframe.sources.sales_csv import (
    SALES_COLUMNS,
    csv_scan,
    header_contract,
    ingest_outcome_counts,
    parse_lines,
    read_sales,
    typed_ingest,
)
from tallyframe.sources.sinks import read_csv_result, write_csv, write_parquet_checked

GOOD = {
    "index": "1", "Order ID": "O-1", "Date": "04-30-22", "Status": "Shipped",
    "Fulfilment": "Merchant", "ship-service-level": "Standard", "Style": "ST", "SKU": "sk-1",
    "Size": "3xl", "Courier Status": "Shipped", "Qty": "2", "Amount": "10.5",
    "ship-city": "New  York", "ship-state": "ny", "promotion-ids": '"A, b,A,"',
}


def line(**changes):
    cells = {**GOOD, **{k.replace("_", " "): v for k, v in changes.items()}}
    return ",".join(cells.get(name, "") for name in SALES_COLUMNS)


def lines(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_valid_row(spark):
    valid, rejects = typed_ingest(lines(spark, line()))
    row = valid.first()
    assert rejects.isEmpty()
    assert (row.record_id, row.order_id, row.order_date, row.month) == (
        1, "O-1", dt.date(2022, 4, 30), "2022-04")
    assert (row.status, row.size, row.city, row.state, row.sku) == (
        "SHIPPED", "3XL", "NEW YORK", "NY", "SK-1")
    assert (row.qty, row.amount, row.promotion_ids, row.is_bought) == (2, 10.5, ["A", "b"], True)


BAD = {
    "23 columns": (",".join(line().split(",")[:-1]), "csv", "structure"),
    "25 columns": (line() + ",", "csv", "structure"),
    "blank line": ("", "csv", "structure"),
    "open quote": (line(Style='"open'), "csv", "structure"),
    "text after quote": (line(Style='"a"b'), "csv", "structure"),
    "index text": (line(index="x"), "index", "invalid"),
    "index blank": (line(index=" "), "index", "missing"),
    "order id": (line(Order_ID="\t"), "Order ID", "missing"),
    "no date": (line(Date=""), "Date", "missing"),
    "no such day": (line(Date="02-30-22"), "Date", "invalid"),
    "unpadded": (line(Date="4-5-22"), "Date", "invalid"),
    "long year": (line(Date="04-30-2022"), "Date", "invalid"),
    "status": (line(Status=""), "Status", "missing"),
    "fulfilment": (line(Fulfilment=" "), "Fulfilment", "missing"),
    "service": (line(**{"ship-service-level": ""}), "ship-service-level", "missing"),
    "qty": (line(Qty="1.5"), "Qty", "invalid"),
    "no qty": (line(Qty=""), "Qty", "missing"),
    "amount": (line(Amount="ten"), "Amount", "invalid"),
    "NaN": (line(Amount="NaN"), "Amount", "invalid"),
    "infinite": (line(Amount="Infinity"), "Amount", "invalid"),
    "first failure wins": (line(Date="x", Qty="y"), "Date", "invalid"),
}


def test_rejects(spark):
    _, rejects = typed_ingest(lines(spark, *[text for text, _, _ in BAD.values()]))
    found = {r.line: (r.reject_field, r.reject_reason) for r in rejects.collect()}
    assert found == {text: (field, reason) for text, field, reason in BAD.values()}


ACCEPTED = {
    "quoted comma": line(Style='"a,b"'), "escaped quote": line(Style='"a ""b"""'),
    "escaped quote before comma": line(Style='"a"",b"'), "quote inside": line(Style='5" pipe'),
    "no amount": line(Amount=""), "blank after quote": line(Style='"a" '),
    "empty quotes": line(Style='""'), "tabs": line(Status="\tShipped\t", Qty=" 2\t"),
    "comma then quote end": line(Style='"x,"'),
}


def test_accepted_spellings(spark):
    valid, rejects = typed_ingest(lines(spark, *ACCEPTED.values()))
    assert rejects.collect() == []
    assert valid.count() == len(ACCEPTED)


def test_outcomes(spark):
    frame = lines(
        spark, HEADER, line(), line(Status="Shipping"), line(Qty="0"), line(Qty="-1"),
        line(**{"ship-state": " "}), line(Date="x"), "",
    )
    counts = ingest_outcome_counts(parse_lines(frame), ["state"]).collect()
    assert {r.outcome: r.rows for r in counts} == {
        "rows_read": 8, "header": 1, "accepted": 1, "not_bought": 3, "missing_key": 1,
        "rejected:Date": 1, "rejected:csv": 1,
    }


def test_header_contract(spark):
    frame = lines(spark, HEADER, "﻿" + HEADER, HEADER.replace("B2B", "b2b"), HEADER + ",x", line())
    matches = {r.header_line: r.matches for r in header_contract(frame).collect()}
    assert matches == {
        HEADER: True, "﻿" + HEADER: True, HEADER.replace("B2B", "b2b"): False, HEADER + ",x": False,
    }


def test_lenient_read_keeps_bad_rows_with_nulls(spark, tmp_path):
    path = tmp_path / "sales.csv"
    path.write_text("\n".join([
        "﻿" + HEADER, line(), line(index="x", Date="02-30-22", Amount="NaN", Status=""), "7,short",
    ]) + "\n")
    rows = read_sales(spark, str(path)).collect()
    assert [r.record_id for r in rows] == [1, None, 7]
    assert (rows[1].order_date, rows[1].amount, rows[1].status) == (None, None, None)
    assert rows[0].promotion_ids_raw == "A, b,A,"


def test_scan_refuses_another_header(spark, tmp_path):
    path = tmp_path / "sales.csv"
    path.write_text(HEADER.replace("Status", "State", 1) + "\n" + line() + "\n")
    with pytest.raises(Exception, match="(?i)header"):
        csv_scan(spark, str(path)).collect()


def test_ingest_report(spark):
    frame = lines(
        spark, HEADER, line(), line(index="2", Amount=""), line(index="3", Order_ID="O-2"),
        line(Date="x"), line(index="4", Order_ID="O-3", Date="05-01-22", SKU=""),
    )
    report = {(r.section, r.metric): r.value for r in ingest_report(frame, ["state"]).collect()}
    assert report["outcome", "rows_read"] == "6" and report["outcome", "rejected:Date"] == "1"
    quality = {metric: value for (section, metric), value in report.items() if section == "quality"}
    assert quality["rows"] == "4" and quality["null_amount"] == "1" and quality["null_sku"] == "1"
    assert (quality["first_date"], quality["last_date"]) == ("2022-04-30", "2022-05-01")
    assert (quality["repeated_order_ids"], quality["largest_order_rows"]) == ("1", "2")
    assert (quality["largest_group_rows"], quality["large_groups"]) == ("3", "0")
    assert [r.reject_field for r in reject_samples(frame).collect()] == ["Date"]


def test_report_of_nothing(spark):
    report = {r.metric: r.value for r in ingest_report(lines(spark), ["state"]).collect()}
    assert report["rows"] == "0" and report["largest_order_rows"] == "0"


AWKWARD = [(1, ' a, "q"\nb ', 1.5), (2, None, None), (3, "plain", -0.25)]


def test_csv_round_trip(spark, tmp_path):
    frame = spark.createDataFrame(AWKWARD, "id bigint, cell string, price double")
    path = str(tmp_path / "out")
    write_csv(frame, path, single_file=True)
    assert len(list((tmp_path / "out").glob("part-*"))) == 1
    schema = "id bigint, cell string, price double"
    back = read_csv_result(spark, path, schema, multi_line=True)
    assert sorted(map(tuple, back.collect())) == AWKWARD
    with pytest.raises(Exception, match="(?i)exist"):
        write_csv(frame, path)
    write_csv(frame.limit(1), path, overwrite=True)
    assert read_csv_result(spark, path, schema, multi_line=True).count() == 1
    with pytest.raises(Exception, match="(?i)header"):
        read_csv_result(spark, path, "id bigint, other string, price double").collect()


def test_parquet_round_trip(spark, tmp_path):
    frame = spark.createDataFrame(AWKWARD, "id bigint, cell string, price double")
    path = str(tmp_path / "out")
    assert sorted(map(tuple, write_parquet_checked(frame, path).collect())) == AWKWARD
    with pytest.raises(Exception, match="(?i)exist"):
        write_parquet_checked(frame, path)
    assert write_parquet_checked(frame.limit(2), path, overwrite=True).count() == 2


def test_counts_ride_on_the_write(spark, tmp_path, monkeypatch):
    from tallyframe.sources import observed_ingest
    from tallyframe.sources.sales_csv import ingest_outcome_counts, parse_lines, typed_ingest
    from tallyframe.sources.star_schema import table
    from tallyframe.catalog.ingest import sales_lines

    lines = sales_lines(spark, "/root/testdata/sf0.001")
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    expected = sorted(map(tuple, ingest_outcome_counts(parse_lines(lines), ["state"]).collect()))
    watched = lines.mapInArrow(counted, lines.schema)
    path = str(tmp_path / "valid")
    result = observed_ingest.write_valid_rows(watched, path, ["state"])
    assert sorted(map(tuple, result.collect())) == expected
    assert read.value == lines.count()  # one pass counts and writes
    valid, _ = typed_ingest(lines, staged=False)
    written = spark.read.parquet(path)
    assert written.columns == valid.columns and written.count() == valid.count()
    assert table(spark, "/root/testdata/sf0.001", "orders").count() > written.count() > 0
    # counts that a retried task could have doubled are noticed and taken anew
    monkeypatch.setattr(observed_ingest, "_agree", lambda *_: False)
    again = observed_ingest.write_valid_rows(lines, str(tmp_path / "again"), ["state"])
    assert sorted(map(tuple, again.collect())) == expected


def test_doubled_counts_are_noticed(spark, tmp_path):
    from tallyframe.sources.observed_ingest import OUTCOMES, _agree

    path = str(tmp_path / "rows")
    spark.range(5).write.parquet(path)
    counts = dict.fromkeys(OUTCOMES, 0) | {"accepted": 3, "not_bought": 2, "header": 1}
    assert _agree(spark, path, counts | {"rows_read": 6})
    assert not _agree(spark, path, counts | {"rows_read": 7})
    assert not _agree(spark, path, counts | {"accepted": 8, "rows_read": 11})


def test_no_lines(spark, tmp_path):
    from tallyframe.sources.observed_ingest import write_valid_rows

    nothing = spark.createDataFrame([], "value string")
    counts = write_valid_rows(nothing, str(tmp_path / "rows"), ["state"]).collect()
    assert [tuple(r) for r in counts] == [("rows_read", 0)]


def test_every_generated_method_of_the_parse_can_be_compiled(spark, tmp_path, capsys):
    """The JVM interprets methods of more than 8000 bytes, which takes the parse twice as long."""
    (tmp_path / "sales.csv").write_text("a,b\n")
    lines = spark.read.text(str(tmp_path))
    parse_lines(lines).where("NOT is_header").explain("codegen")
    sizes = [int(size) for size in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert sizes and max(sizes) <= 8000
