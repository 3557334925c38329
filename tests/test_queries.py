"""Registered queries against their SQL twins, and the entry's behaviour without the corpus operators."""

from __future__ import annotations

import os
import subprocess
import sys

import duckdb
import pytest
from conftest import ROOT, SMALL

from turnweave.plans import catalog, oracle

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{SMALL}/{t}.parquet'")
    return con


def canonical(rows):
    return sorted(tuple(repr(round(v, 9) + 0.0) if isinstance(v, float) else repr(v) for v in r) for r in rows)


def test_every_query_has_a_twin():
    assert set(catalog.queries()) == set(oracle.sql())


@pytest.mark.parametrize("name", sorted(oracle.sql()))
def test_twin(spark, duck, name):
    df = catalog.queries()[name](spark, SMALL)
    columns = sorted(df.columns)
    want = duck.sql(oracle.sql()[name])
    assert columns == sorted(want.columns)
    at = [want.columns.index(c) for c in columns]
    assert canonical(df.select(*columns).collect()) == canonical([tuple(r[i] for i in at) for r in want.fetchall()])


@pytest.mark.parametrize("name", ["edge_midpoint", "turn_csv", "turn_geometry"])
def test_twin_where_the_half_falls_on_a_point(spark, tmp_path, name):
    """The middle one of three points halves its way, but the two steps differ in the last bits."""
    lines = [(o, n, (node - 1) // 16, (node - 1) % 16) for o, nodes in {0: (441151, 509579, 578007), 1: (578007, 421352)}.items() for n, node in enumerate(nodes)]
    con = duckdb.connect()
    con.execute("create table orders as select * from (values (0::bigint, '1-URGENT', 'O'), (1::bigint, '2-HIGH', 'O')) t(o_orderkey, o_orderpriority, o_orderstatus)")
    con.execute("create table lineitem (l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint, l_shipdate timestamp default '2000-01-01', l_extendedprice double default 1)")
    con.executemany("insert into lineitem (l_orderkey, l_linenumber, l_partkey, l_suppkey) values (?, ?, ?, ?)", lines)
    for t in ("orders", "lineitem"):
        con.execute(f"copy {t} to '{tmp_path}/{t}.parquet'")
    df = catalog.queries()[name](spark, str(tmp_path))
    want = con.sql(f"select {', '.join(df.columns)} from ({oracle.sql()[name]})").fetchall()
    assert want and canonical(df.collect()) == canonical(want)


def test_known_number_of_turns(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 11_257


def test_entry_without_the_corpus_operators(tmp_path):
    for name in ("turnweave", "__spark_entry__.py"):
        os.symlink(f"{ROOT}/{name}", tmp_path / name)
    code = "import sys; sys.modules['turnweave.llm'] = None; import __spark_entry__ as e; assert not any(k.startswith('op') for k in e.queries()); assert set(e.oracle_sql()) == set(e.queries())"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env=os.environ | {"PYTHONPATH": str(tmp_path)})
