"""Commands over committed tables: an import that fails rows, dies, and runs again; exports."""

import datetime as dt

import pytest

from entitymill.plans import call_import, export
from entitymill.sources import commits, readers

HEAD = "company_name,sales_rep_name,called_at,phone_number,phone_status,product_name,discovered_person_chuto,notes\n"
ROWS = (
    "甲社,佐藤,2025-01-15 14:30,03-1,該当,製品,田中,\n"
    " 甲社 ,佐藤,2025/1/16,03-1,AI対応,,,\"二行\nの 注\"\n"
    "乙社,鈴木,2025-01-15,06-2,該当,,,\n"
    ",鈴木,2025-01-15,06-2,該当,,,\n"
    "甲社,佐藤,15 Jan,03-1,該当,,,\n"
    "甲社,佐藤,2025-01-15,03-1,謎,,,\n"
)


@pytest.fixture
def folder(spark, tmp_path):
    where = f"file://{tmp_path}/tables"
    commits.Table(spark, f"{where}/companies").append(spark.createDataFrame([("1", "甲社", None, dt.datetime(2024, 1, 1))], call_import.TABLES["companies"]))
    commits.Table(spark, f"{where}/products").append(spark.createDataFrame([(5, "製品")], call_import.TABLES["products"]))
    (tmp_path / "calls.csv").write_text("﻿" + HEAD + ROWS)
    return where


def held(spark, folder):
    return {n: sorted(map(str, call_import.stored(spark, folder, n).collect())) for n in call_import.TABLES}


def test_import(spark, tmp_path, folder, monkeypatch):
    path, before = f"file://{tmp_path}/calls.csv", held(spark, folder)
    assert call_import.run(spark, path, folder, dry_run=True, error_out=f"file://{tmp_path}/bad.csv") == call_import.Outcome(3, 3)
    bad = readers.csv_file(spark, f"file://{tmp_path}/bad.csv").orderBy("row_no").collect()
    assert [r.row for r in bad] == ["5", "6", "7"] and "company_name" in bad[0].message and "15 Jan" in bad[1].message and "謎" in bad[2].message
    assert held(spark, folder) == before
    whole, stopped = commits.Table.overwrite, []

    def dies(self, df, run_id=None):
        if self.root.endswith("/persons") and not stopped:
            stopped.append(1)
            raise RuntimeError("lost")
        return whole(self, df, run_id)

    monkeypatch.setattr(commits.Table, "overwrite", dies)
    with pytest.raises(RuntimeError):
        call_import.run(spark, path, folder)
    assert call_import.run(spark, path, folder) == call_import.Outcome(3, 3, 2, 1)
    after = held(spark, folder)
    assert [len(after[n]) for n in ("sales_reps", "phone_numbers", "persons", "call_logs")] == [1, 1, 1, 2]
    phone = call_import.stored(spark, folder, "phone_numbers").first()
    assert (phone.number, phone.status, phone.source) == ("03-1", "AI対応", "架電")
    notes = {r.pos: r.notes for r in call_import.stored(spark, folder, "call_logs").collect()}
    assert notes == {2: None, 3: "二行\nの 注"}
    assert call_import.run(spark, path, folder) == call_import.Outcome(3, 3, 0, 0) and held(spark, folder) == after


def test_missing_columns_and_empty_files(spark, tmp_path, folder):
    for text, errors in (("a,b\n1,2\n", 1), (HEAD, 0)):
        (tmp_path / "odd.csv").write_text(text)
        assert call_import.run(spark, f"file://{tmp_path}/odd.csv", folder) == call_import.Outcome(0, errors)


def test_exports(spark, tmp_path, folder):
    call_import.run(spark, f"file://{tmp_path}/calls.csv", folder)
    out = f"file://{tmp_path}/out"
    assert export.run(spark, folder, out, ["call_logs", "phones"]) == [f"{out}/call_logs_export.csv", f"{out}/phone_numbers_export.csv"]
    rows = readers.csv_file(spark, f"{out}/call_logs_export.csv").orderBy("row_no").collect()
    assert [(r.company_name, r.sales_rep_name, r.product_name, r.called_at) for r in rows] == [("甲社", "佐藤", None, "2025-01-15 15:00"), ("甲社", "佐藤", "製品", "2025-01-15 05:30")]
    assert len(export.run(spark, folder, out)) == 5 and readers.csv_file(spark, f"{out}/deals_export.csv").count() == 0
    assert readers.csv_file(spark, f"{out}/companies_export.csv").count() == 1
