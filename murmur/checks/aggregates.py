"""Keys, limits and the crawl frontier."""

from __future__ import annotations

from pyspark.sql import functions as F

from murmur.checks import inputs as src
from murmur.checks.registry import query
from murmur.operators import frontier as fr
from murmur.operators import tables


@query("SELECT DISTINCT url FROM pages")
def distinct_urls(spark, sf):
    return tables.distinct_urls(src.table(spark, sf, "pages"))


@query("""SELECT doc_id, n_chars FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
AND lang <> 'de'""")
def unprocessed_anti_join(spark, sf):
    docs = src.table(spark, sf, "documents").withColumn("processed", F.col("lang") == "de")
    todo = tables.unprocessed(docs, src.table(spark, sf, "labels"), "doc_id", "processed")
    return todo.select("doc_id", "n_chars")


@query("""SELECT doc_id, CASE WHEN doc_id IN (SELECT doc_id FROM labels) THEN 'update' ELSE 'insert' END AS action
FROM documents""")
def exists_lookup(spark, sf):
    docs = src.table(spark, sf, "documents").select("doc_id")
    known, new = tables.exists_lookup(docs, src.table(spark, sf, "labels"), "doc_id")
    return known.withColumn("action", F.lit("update")).unionAll(new.withColumn("action", F.lit("insert")))


@query("SELECT doc_id, source FROM documents ORDER BY n_chars DESC, doc_id LIMIT 100")
def limit_records(spark, sf):
    docs = src.table(spark, sf, "documents")
    return tables.take(docs, [F.desc("n_chars"), "doc_id"], 100).select("doc_id", "source")


def _seeded(spark, sf):
    found = src.found_urls(spark, sf)
    return fr.seed(fr.empty_frontier(found), found)


def _settled(spark, sf):
    return fr.apply_events(_seeded(spark, sf), src.crawl_events(spark, sf))


SETTLED = src.CRAWL + """,
settled AS (
  SELECT id, date, url, coalesce(t.first_crawl, s.first_crawl) AS first_crawl,
         coalesce(t.confirm_num, s.confirm_num) AS confirm_num, coalesce(t.last_update, s.last_update) AS last_update
  FROM seeded s LEFT JOIN states t USING (url))
"""


@query(f"WITH {src.CRAWL} SELECT id, date, url, first_crawl, confirm_num, last_update FROM seeded")
def frontier_seed(spark, sf):
    return _seeded(spark, sf)


@query(f"WITH {SETTLED} SELECT * FROM settled")
def frontier_apply(spark, sf):
    return _settled(spark, sf)


@query(f"WITH {SETTLED} SELECT url FROM settled WHERE first_crawl = 0")
def frontier_pending(spark, sf):
    return fr.pending(_settled(spark, sf)).select("url")


@query(f"WITH {SETTLED} SELECT url, confirm_num FROM settled WHERE confirm_num > 0 ORDER BY confirm_num, url")
def frontier_order(spark, sf):
    return fr.recheck(_settled(spark, sf)).select("url", "confirm_num")


@query(f"WITH {src.CRAWL} SELECT c.url, c.seq, c.kind, c.date FROM crawl c JOIN first_fail USING (url) WHERE seq > failed")
def frontier_late_events(spark, sf):
    return fr.late_events(src.crawl_events(spark, sf)).select("url", "seq", "kind", "date")
