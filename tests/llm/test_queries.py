"""Every registered query over the smallest data set, by its SQL or its own rules."""

import hashlib
import os
from collections import defaultdict

import pytest

from evlake.llm.entries import ORACLES, QUERIES

DATA = os.environ.get("EVLAKE_TEST_DATA", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.exists(DATA), reason="no test data")


@pytest.mark.parametrize("name", sorted(n for n, sql in ORACLES.items() if sql))
def test_against_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for table in ("documents", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    df = QUERIES[name](spark, DATA)
    cursor = con.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(df.columns)

    def in_order(rows):
        return sorted(rows, key=lambda r: [(v is not None, v) for v in r])

    assert in_order(tuple(r[c] for c in names) for r in df.collect()) == in_order(cursor.fetchall())


def test_whole_tables(spark):
    count = {t: spark.read.parquet(f"{DATA}/{t}.parquet").count() for t in ("documents", "pages")}
    for name, table in (("op1_sharding", "documents"), ("op2_mixing", "documents"), ("op3_pii", "documents"), ("op4_html_extraction", "pages")):
        assert QUERIES[name](spark, DATA).count() == count[table], name


def test_chat_digests(spark):
    said = "</s>[INST] ok [/INST]"
    turns = defaultdict(list, {-7: [(0, "user", said), (1, "assistant", said)]})
    for r in spark.read.parquet(f"{DATA}/conversations.parquet").collect():
        turns[r.conv_id].append((r.turn, r.role, r.text or ""))
    got = {r.conv_id: r for r in QUERIES["op9_chat_formatting"](spark, DATA).collect()}
    assert set(got) == set(turns)
    for c, rows in turns.items():
        whole = "".join(f"{role}\n{text}\n" for _, role, text in sorted(rows))
        assert got[c].turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
