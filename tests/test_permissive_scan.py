"""Scoring files with broken lines and without the target."""

import pytest

from riskframe.sources.tables import read_csv_permissive

SCHEMA = "id long, age int, city string, left int"


def test_broken_lines_come_back_whole(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,age,city\n1,30,"Oslo, N"\n2,old,Rome\n3,,\n4,41\n5,50,Lima,extra\nx,1,Bonn\n')
    rows, rejected = read_csv_permissive(spark, str(tmp_path / "a.csv"), SCHEMA, label_optional=True)
    assert rows.columns == ["id", "age", "city", "left"]
    assert sorted(tuple(r) for r in rows.collect()) == [(1, 30, "Oslo, N", None), (3, None, None, None)]
    assert sorted(r["line"] for r in rejected.collect()) == ["2,old,Rome", "4,41", "5,50,Lima,extra", "x,1,Bonn"]
    assert {r["file"].rsplit("/", 1)[1] for r in rejected.collect()} == {"a.csv"}
    # counts alone see the same lines, and values of columns that are not asked for are checked too
    assert (rows.count(), rejected.count(), rows.select("city").count()) == (2, 4, 2)


def test_declared_columns_and_other_orders(spark, tmp_path):
    (tmp_path / "b.csv").write_text("city,left,id,more,age\nRome,1,7,x,20\n")
    rows, rejected = read_csv_permissive(spark, str(tmp_path / "b.csv"), SCHEMA)
    assert [tuple(r) for r in rows.collect()] == [(7, 20, "Rome", 1)]
    assert rejected.count() == 0
    (tmp_path / "c.csv").write_text("id,age\n1,2\n")
    with pytest.raises(ValueError, match="city"):
        read_csv_permissive(spark, str(tmp_path / "c.csv"), SCHEMA)


def test_header_only(spark, tmp_path):
    (tmp_path / "d.csv").write_text("id,age,city\n")
    rows, rejected = read_csv_permissive(spark, str(tmp_path / "d.csv"), SCHEMA, label_optional=True)
    assert (rows.count(), rejected.count()) == (0, 0)
