"""The inputs of the edge queries have both sides of each predicate: their SQL
gives other rows when the predicate is left out."""

import duckdb
import pytest

from termflow.plans import ORACLE_SQL

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "pages", "events", "conversations", "labels"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def rows(con, sql):
    return sorted(con.execute(sql).fetchall(), key=str)


@pytest.mark.parametrize("name, predicate", [
    ("edge_doc_filter", "AND regexp_matches(text, '[^\\x00-\\x20]')"),
    ("edge_arrival_notices", "AND page_id % 3 <> 0"),
])
def test_without_the_predicate_other_rows(con, name, predicate):
    sql = ORACLE_SQL[name]
    assert predicate in sql
    assert rows(con, sql) != rows(con, sql.replace(predicate, ""))


def test_last_and_largest_differ(con):
    last, most = (dict(con.execute(ORACLE_SQL[f"source_scores_{k}"]).fetchall()) for k in ("last", "max"))
    assert last.keys() == most.keys() and sum(last[t] != most[t] for t in last) > 5


def test_line_and_space_rules_matter(con):
    """Without the carriage returns and the doubled spaces the results are others."""
    plain = dict(rows(con, ORACLE_SQL["normalized_docs"]))
    edge = dict(rows(con, ORACLE_SQL["edge_normalized_docs"]))
    assert None in edge.values() and any("  " in (t or "") for t in edge.values())
    # A carriage return ends a line as a line feed does.
    assert all(edge[d] == plain[d] for d in plain if d % 7 in (2, 3))
    words = dict(con.execute(ORACLE_SQL["edge_word_count_raw"]).fetchall())
    assert words[""] > dict(con.execute(ORACLE_SQL["word_count_raw"]).fetchall()).get("", 0)


def test_good_and_bad_messages(con):
    got = con.execute(f"SELECT count(*), count(n_scores), count(score) FROM ({ORACLE_SQL['score_messages']}) m").fetchone()
    assert got[0] > got[1] > got[2] > 0
