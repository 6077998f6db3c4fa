"""Links and result rows of pages, and names matched against them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from regtables.checks.registry import check, table
from regtables.functions.html import all_links_by_href, anchors, link_by_href, link_by_text, link_preferred
from regtables.operators.changes import changed_sources
from regtables.operators.match import match_contains_all, match_exact_first, orphan_keys, orphan_rows
from regtables.sources.documents import page_links, page_table_rows

# Some links of each page become files: those to words in a get a class, all of a to m a suffix.
_FILES = r"""
  regexp_replace(regexp_replace(html, '<a href="/([aA][^"]*)"', '<a class="x excel" href="files/{0}.xlsx"'{g}),
                 '<a href="/([b-mB-M][^"]*)"', '<a href="../All-CASES/{0}.zip"'{g})
"""
_SPARK_FILES = _FILES.format("$1", g="")
_DUCK_FILES = _FILES.format(r"\1", g=", 'g'")

_LINKS = r"""
WITH h AS (SELECT page_id, url, regexp_extract_all(regexp_replace(HTML,
             '(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>', '', 'g'), '(?is)<a\s[^>]*>.*?</a\s*>') AS tags FROM pages),
     t AS (SELECT page_id, url, unnest(tags) AS tag, unnest(range(len(tags))) AS pos FROM h),
     a AS (SELECT page_id, url, CAST(pos AS INTEGER) AS pos, regexp_extract(tag, 'href="([^"]*)"', 1) AS href, tag LIKE '%class="x excel"%' AS excel,
             replace(regexp_replace(tag, '<[^>]*>', '', 'g'), '&amp;', '&') AS link_text FROM t),
     l AS (SELECT *, CASE WHEN href LIKE '/%' THEN regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) || href
             WHEN href LIKE '../%' THEN regexp_replace(regexp_replace(url, '[?#].*$', ''), '[^/]*/[^/]*$', '') || substr(href, 4)
             ELSE regexp_replace(regexp_replace(url, '[?#].*$', ''), '[^/]*$', '') || href END AS link_url FROM a)
"""


@check("page_links", _LINKS.replace("HTML", "html") + "SELECT page_id, url, pos, href, link_url, link_text FROM l")
def page_anchor_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_links(table(spark, sf_dir, "pages"))


_PICK = """
SELECT p.page_id, {0} AS link FROM pages p LEFT JOIN (SELECT page_id, {1} AS link FROM l {2} GROUP BY page_id) q ON p.page_id = q.page_id
"""


def _page_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", anchors(F.expr(_SPARK_FILES), F.col("url")).alias("links"))


@check("link_by_text", _LINKS.replace("HTML", _DUCK_FILES) + _PICK.format("link", "arg_min(link_url, pos)", "WHERE contains(link_text, 'er')"))
def link_by_text_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _page_anchors(spark, sf_dir).select("page_id", link_by_text(F.col("links"), "er").alias("link"))


@check("link_by_exact_text", _LINKS.replace("HTML", _DUCK_FILES) + _PICK.format("link", "arg_min(link_url, pos)", "WHERE link_text = 'the'"))
def link_by_exact_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _page_anchors(spark, sf_dir).select("page_id", link_by_text(F.col("links"), "the", exact=True).alias("link"))


@check(
    "link_preferred",
    _LINKS.replace("HTML", _DUCK_FILES)
    + _PICK.format("link", "arg_min(link_url, CASE WHEN excel THEN 0 ELSE 1000 END + pos)", "WHERE contains(href, 'e')")
)
def link_preferred_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _page_anchors(spark, sf_dir).select("page_id", link_preferred(F.col("links"), "e", "excel").alias("link"))


@check(
    "link_by_href",
    _LINKS.replace("HTML", _DUCK_FILES)
    + _PICK.format("link", "arg_min(link_url, pos)", "WHERE contains(lower(href), 'cases') AND ends_with(href, '.zip')")
)
def link_by_href_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _page_anchors(spark, sf_dir).select("page_id", link_by_href(F.col("links"), "Cases", ".zip").alias("link"))


@check(
    "links_by_suffix",
    _LINKS.replace("HTML", _DUCK_FILES)
    + _PICK.format("coalesce(link, '')", "string_agg(link_url, ' ' ORDER BY pos)", "WHERE ends_with(href, '.xlsx')")
)
def links_by_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = all_links_by_href(F.col("links"), suffix=".xlsx")
    return _page_anchors(spark, sf_dir).select("page_id", F.array_join(links, " ").alias("link"))


@check("changed_sources", """
WITH s AS (SELECT page_id, url, sha256(html) AS etag FROM pages)
SELECT s.page_id, s.url, s.etag FROM s JOIN pages p ON s.page_id = p.page_id WHERE NOT contains(p.url, '/en/')
""")
def changed_source_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """English pages are known with the same token, French ones with another, the others were never seen."""
    pages = table(spark, sf_dir, "pages")
    sources = pages.select("page_id", "url", F.sha2("html", 256).alias("etag"), F.lit(None).cast("string").alias("last_modified"))
    known = pages.where(F.col("url").contains("/en/") | F.col("url").contains("/fr/")).select(
        "url", F.when(F.col("url").contains("/en/"), F.sha2("html", 256)).otherwise("old").alias("etag"),
        F.lit(None).cast("string").alias("last_modified"),
    )
    return changed_sources(sources, known).drop("last_modified")


# --- result pages: twenty parts a page, in the markup of the search results ------------------------


def _result_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "part").selectExpr(
        "p_partkey", "p_partkey div 20 AS page_id",
        """concat('<tr><td> ', p_name, ' </td><td>', p_type, '</td>', '<td><b>', p_brand, '</b></td>',
                  if(p_size = 7, '', concat('<td><a href="detail/', p_partkey, '">Detail</a></td>')),
                  '<td><a href="/pdf/', p_partkey div 2, if(p_type = 'PROMO', '.html', '.pdf'), '">', if(p_size > 25, '審査報告書 (1)', 'IF'), '</a><br>',
                  '<a href=\\'https://x.org/', p_partkey, '.pdf\\'>RMP &amp; ', p_size, '</a></td></tr>') AS tr""",
    )
    # A page has twenty parts by construction.
    pages = rows.groupBy("page_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("p_partkey", "tr"))), lambda r: r["tr"]), "\n").alias("trs"))
    return pages.selectExpr(
        "page_id", "concat('https://site.example.org/search/', page_id, '?q=1') AS url",
        """concat('<html><table class="result_list_table"><tr><td>a<td>b</tr></table><!-- <div id="ContentMainArea"> -->',
                  '<div class="a" id="ContentMainArea"><div><form></form></div><table class="other"><tr><td>1</td></tr></table>',
                  '<table id="t" class="wide result_list_table"><thead><tr><th>Brand</th></tr></thead><tbody>', trs,
                  '</tbody></table></div></html>') AS html""",
    )


_RESULT_ROWS = """
WITH r AS (SELECT p.*, p_partkey // 20 AS page_id, row_number() OVER (PARTITION BY p_partkey // 20 ORDER BY p_partkey) - 1 AS row_no FROM part p),
     k AS (SELECT * FROM r WHERE p_size <> 7),
     l AS (SELECT p_name AS brand, page_id, row_no, 0 AS link_no, CASE WHEN p_size > 25 THEN '審査報告書 (1)' ELSE 'IF' END AS text,
             '/pdf/' || (p_partkey // 2) || CASE WHEN p_type = 'PROMO' THEN '.html' ELSE '.pdf' END AS href,
             'https://site.example.org/pdf/' || (p_partkey // 2) || CASE WHEN p_type = 'PROMO' THEN '.html' ELSE '.pdf' END AS url FROM k
           UNION ALL SELECT p_name, page_id, row_no, 1, 'RMP & ' || p_size, 'https://x.org/' || p_partkey || '.pdf', 'https://x.org/' || p_partkey || '.pdf' FROM k)
"""


@check("page_table_rows", _RESULT_ROWS + """
SELECT k.page_id, CAST(k.row_no AS INTEGER) AS row_no, p_name || '|' || p_type || '|' || p_brand || '|Detail|' || l.text || 'RMP & ' || p_size AS cells,
       l.url || ' https://x.org/' || p_partkey || '.pdf' AS urls
FROM k JOIN l ON k.page_id = l.page_id AND k.row_no = l.row_no AND l.link_no = 0
""")
def result_table_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = page_table_rows(_result_pages(spark, sf_dir))
    urls = F.array_join(F.transform("links", lambda a: a["url"]), " ")
    return rows.select("page_id", "row_no", F.array_join("cells", "|").alias("cells"), urls.alias("urls"))


def _result_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = page_table_rows(_result_pages(spark, sf_dir))
    return rows.select("page_id", "row_no", F.col("cells")[0].alias("brand"), F.explode("links").alias("a")).select(
        "page_id", "row_no", F.col("a.pos").alias("link_no"), "brand", "a.text", "a.href", "a.url"
    )


@check("match_exact_first", _RESULT_ROWS + """
SELECT brand AS name, arg_min(url, page_id * 100000 + row_no * 10 + link_no) AS url FROM l
WHERE contains(href, '.pdf') GROUP BY brand
""")
def exact_name_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Every part name is looked for, and every maker, which names no row.
    names = table(spark, sf_dir, "part").select(F.explode(F.array("p_name", "p_brand")).alias("name"))
    return match_exact_first(_result_links(spark, sf_dir), names, order=("page_id", "row_no", "link_no"))


@check("match_contains_all", _RESULT_ROWS + """
, n AS (SELECT DISTINCT w AS name FROM (SELECT unnest(string_split(p_name, ' ')) AS w FROM part)),
  i AS (SELECT name, row_number() OVER (ORDER BY name) AS name_no FROM n),
  m AS (SELECT url, min((name_no, page_id, row_no, link_no, name)) AS b FROM l JOIN i ON contains(l.brand, i.name)
        WHERE contains(text, '審査報告書') GROUP BY url)
SELECT m.url, i.name, j.page_id, j.row_no, j.link_no FROM m JOIN i ON i.name_no = (SELECT min(i2.name_no) FROM l l2 JOIN i i2 ON contains(l2.brand, i2.name)
  WHERE l2.url = m.url AND contains(l2.text, '審査報告書'))
JOIN LATERAL (SELECT page_id, CAST(row_no AS INTEGER) AS row_no, link_no FROM l l3 WHERE l3.url = m.url AND contains(l3.brand, i.name)
  AND contains(l3.text, '審査報告書') ORDER BY page_id, row_no, link_no LIMIT 1) j ON true
""")
def contained_name_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = table(spark, sf_dir, "part").select(F.explode(F.split("p_name", " ")).alias("name")).distinct()
    # The names come in alphabetical order: the rank of a name is the name.
    names = words.select(F.col("name").alias("name_no"), "name")
    order = ("page_id", "row_no", "link_no")
    return match_contains_all(_result_links(spark, sf_dir), names, order=order).drop("name_no")


@check("orphan_keys", """
SELECT l_orderkey, count(*) AS n_rows FROM lineitem
WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P') GROUP BY l_orderkey
""")
def orphaned_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    parents = table(spark, sf_dir, "orders").where("o_orderstatus <> 'P'").select("o_orderkey")
    return orphan_keys(table(spark, sf_dir, "lineitem"), parents, "l_orderkey", "o_orderkey")


@check("orphan_rows", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')
""")
def orphaned_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    children = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    parents = table(spark, sf_dir, "orders").where("o_orderstatus <> 'P'").select("o_orderkey")
    return orphan_rows(children, parents, "l_orderkey", "o_orderkey")
