import datetime as dt
import math

import duckdb
import pytest

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"
TABLES = ("documents", "embeddings", "pages", "benchmark", "labels")


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls in every column, empty, blank and long texts, repeated rows and ids, clashing extra columns."""
    long = " ".join(f"w{i % 977}x{i}" for i in range(40_000))
    passage = " ".join(f"common{i}" for i in range(60))
    rows = [
        (1, passage + " tail one", "en"), (2, "head two " + passage, "en"), (3, None, "en"), (4, "", None),
        (5, " \t\n ", "de"), (6, long, "en"), (7, long, "en"), (8, "short text", "fr"), (8, "short text", "fr"),
        (9, "Short TEXT", "fr"), (None, passage, None), (None, None, None), (10, "a <|endoftext|> b", "en"),
        (11, "Released under the MIT License.\nanything else", "en"), (12, "é ü 中文 \U0001f600 naïve", "en"),
        (13, "one", "en"), (14, "one", "en"), (8, "another text under the same id", "fr"),
    ]
    rows = [(i, t, lang, 0.5, i, t, "x", -1, True, None) for i, t, lang in rows]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, score double, id long, w string, "
                                       "bucket string, n_words int, kept boolean, item_id string")


def value(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    return v.isoformat() if isinstance(v, (dt.date, dt.datetime)) else v


def multiset(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr([value(r[i]) for i in order]) for r in rows)


def run_sql(sql, folder, tables=TABLES):
    con = duckdb.connect()
    for t in tables:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    found = con.execute(sql)
    return [d[0] for d in found.description], found.fetchall()


def auc(score, label):
    pairs = sorted(zip(score, label))
    ranks = sum(i for i, (_, y) in enumerate(pairs, 1) if y)
    ones = sum(y for _, y in pairs)
    return (ranks - ones * (ones + 1) / 2) / (ones * (len(pairs) - ones))
