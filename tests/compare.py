"""Run a registered query and its SQL on the same tables and compare whole results."""

from __future__ import annotations

import os

import duckdb
import pandas as pd


def oracle_frame(sql: str, sf_dir: str) -> pd.DataFrame:
    with duckdb.connect() as db:
        for file in sorted(os.listdir(sf_dir)):
            name = file.removesuffix(".parquet")
            db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{file}'")
        return db.execute(sql).df()


def _kind(dtype) -> str:
    return {"i": "int", "f": "float", "b": "bool", "M": "time"}.get(dtype.kind, "other")


def _rows(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]
    plain = []
    for row in frame.itertuples(index=False, name=None):
        plain.append(tuple(None if pd.isna(v) else _plain(v) for v in row))
    return sorted(plain, key=lambda r: tuple((v is not None, str(v)) for v in r))


def _plain(value):
    if hasattr(value, "isoformat"):
        text = value.isoformat()
        return text.removesuffix("T00:00:00")
    return value.item() if hasattr(value, "item") else value


def assert_same(result: pd.DataFrame, expected: pd.DataFrame) -> None:
    assert sorted(result.columns) == sorted(expected.columns)
    assert len(result) == len(expected)
    got, want = _rows(result), _rows(expected)
    different = [(g, w) for g, w in zip(got, want) if g != w]
    assert not different, f"{len(different)} rows differ, first: {different[0]}"
