"""Licence scans: SQL without size bounds agrees, and odd texts."""

import duckdb
import pytest

from tallyweek.llm import licences, queries
from tests.llm.test_pipeline import SF

ORACLES = {name: sql for name, sql in queries.ORACLE_SQL.items()}


@pytest.mark.parametrize("name", ORACLES)
def test_sql(spark, name):
    db = duckdb.connect()
    for table in ("documents", "pages"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    df = queries.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    expected = db.execute(f"SELECT {', '.join(columns)} FROM ({ORACLES[name]})").fetchall()
    assert sorted(map(tuple, df.select(*columns).collect()), key=str) == sorted(expected, key=str)


def test_units(texts):
    rows = [
        (1, "RELEASED!! UNDER!! the\tMIT License\nother\nReleased under the MIT License."), (2, None), (3, ""), (None, licences.TEMPLATES["MIT-grant"].replace(" ", "\n")),
        (1, "Licensed under CC BY-NC 4.0 only"), (4, "the the " * 50_000), (5, "Licensed"), (6, "été ééé\n!!!\n"),
    ]
    got = {(r.id, tuple((m.licence, round(m.dice, 3)) for m in r.matches)) for r in licences.scan(texts(rows)).collect()}
    assert got == {
        (1, (("MIT", 1.0),)), (2, ()), (3, ()), (None, (("MIT-grant", 1.0),)), (1, (("CC-BY-NC-4.0", 0.923),)), (4, ()), (5, ()), (6, ()),
    }
    assert licences.scan(texts([])).collect() == []


def test_whole_licence_files(texts):
    mit = licences.TEXTS["MIT-text"].replace("<year> <copyright holders>", "2021 Ada Lovelace and others")
    rows = [(i, text) for i, text in enumerate([mit, *licences.TEXTS.values()])]
    got = {r.id: {m.licence: m.dice for m in r.matches} for r in licences.scan(texts(rows)).collect()}
    for i, name in enumerate(["MIT-text", *licences.TEXTS]):
        assert got[i][name] > 0.95, name
