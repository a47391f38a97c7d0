"""Registered queries: SQL where there is some, else brute force, over the smallest tables."""

import os
import re

import duckdb
import pytest

import __spark_entry__ as entry
from tests import parity
from tests.llm.helpers import near_classes
from tidemark.llm.queries import QUERIES, SQL

SF_DIR = f"{parity.TESTDATA}/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")


def rows(sql):
    return duckdb.sql(sql.format(sf=SF_DIR)).fetchall()


def test_registered():
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES if n != "pipeline") == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, name):
    good, note = parity.compare(spark, parity.connect(SF_DIR), name, SF_DIR)
    assert good, note


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL) - {"op5_host_paths", "op10_collision_counts", "pipeline"}))
def test_query_has_a_row_for_each_document(spark, name):
    ids = [r.doc_id for r in QUERIES[name](spark, SF_DIR).select("doc_id").collect()]
    assert sorted(ids) == [i for (i,) in rows("SELECT doc_id FROM '{sf}/documents.parquet' ORDER BY 1")]


def test_near_duplicates_of_the_table(spark):
    want = near_classes(rows("SELECT doc_id, text FROM '{sf}/documents.parquet'"))
    assert {r.doc_id: r.component_id for r in QUERIES["op7_signature_tree_jaccard"](spark, SF_DIR).collect()} == want


def test_pages_and_vectors_of_the_table(spark):
    pages = QUERIES["op5_host_paths"](spark, SF_DIR).collect()
    assert sorted(r.page_id for r in pages) == [i for (i,) in rows("SELECT page_id FROM '{sf}/pages.parquet' ORDER BY 1")]
    assert all(r.n_chars == len(r.text) and r.text for r in pages)
    vectors = QUERIES["op10_collision_counts"](spark, SF_DIR).collect()
    assert sorted(r.vec_id for r in vectors) == [i for (i,) in rows("SELECT vec_id FROM '{sf}/embeddings.parquet' ORDER BY 1")]
