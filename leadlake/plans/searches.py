"""Queries over written indexes and large rule packs."""

from __future__ import annotations

from pyspark.sql import functions as F

from leadlake import rules as R
from leadlake.functions.automaton import tagged
from leadlake.plans.registry import query
from leadlake.scratch import fresh_path
from leadlake.sources import search as X

WORDS = ("license", "the and", "###", "ation", "e")


@query(" UNION ALL ".join(f"SELECT '{w}' AS query, doc_id FROM documents WHERE contains(lower(text), '{w}') OR contains(lower(source), '{w}')" for w in (*WORDS, "src1", "no such text")))
def indexed_search(t):
    """Substring search over two columns by the index; a query of one letter scans. (FLT-01, FLT-03)"""
    docs = t("documents").select("doc_id", "text", "source")
    path = fresh_path(docs.sparkSession, "trigrams")
    X.write_index(docs, "doc_id", ["text", "source"], path)
    found = [X.indexed_search(docs, "doc_id", ["text", "source"], path, w).select(F.lit(w).alias("query"), "doc_id") for w in (*WORDS, "src1", "no such text")]
    out = found[0]
    for f in found[1:]:
        out = out.union(f)
    return out


@query("""
WITH n AS (SELECT item_id, lower(left(text, 24)) AS needle FROM benchmark WHERE text <> '')
SELECT doc_id, coalesce((SELECT string_agg(item_id::VARCHAR, ',' ORDER BY item_id) FROM n WHERE contains(lower(d.text), needle)), 'none') AS tags FROM documents d""")
def pack_tags(t):
    """Documents tagged by the beginnings of all benchmark passages, a pack made from a table. (TXT-01, UDF-02)"""
    rows = t("benchmark").filter("text <> ''").select(F.col("item_id").alias("position"), F.lower(F.left("text", F.lit(24))).alias("needle"), F.col("item_id").cast("string").alias("tag"))
    docs = t("documents").select("doc_id", "text")
    return tagged(docs, F.col("text"), R.tag_rules(rows, "none"), "tags").select("doc_id", F.array_join("tags", ",").alias("tags"))


@query("SELECT * FROM (SELECT 3 AS page, o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 40 OFFSET 80) UNION ALL SELECT * FROM (SELECT 25, o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 40 OFFSET 960)")
def sorted_pages(t):
    """Two pages of the orders, each read from its own range; pages are the feature. (SRT-02)"""
    orders = t("orders").select("o_orderkey", "o_totalprice")
    path = fresh_path(orders.sparkSession, "sorted")
    X.write_sorted(orders, [F.col("o_totalprice").desc(), F.col("o_orderkey").asc()], path)
    page = lambda k: X.sorted_page(orders.sparkSession, path, k, 40).select(F.lit(k).alias("page"), "o_orderkey", "o_totalprice")
    return page(3).union(page(25))
