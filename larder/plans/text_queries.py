"""Text expressions over documents and pages, with SQL that must agree."""

from __future__ import annotations

from pyspark.sql import functions as F

from larder.functions import text as T
from larder.plans.registry import query
from larder.plans.tables import table
from larder.plans.views import lines

LINES = "SELECT doc_id, CAST(generate_subscripts(string_split(text, chr(10)), 1) - 1 AS INTEGER) AS line, unnest(string_split(text, chr(10))) AS text FROM documents"


def _on_docs(spark, sf_dir, **columns):
    return table(spark, sf_dir, "documents").select("doc_id", *(c.alias(n) for n, c in columns.items()))


@query("txt_one_space", r"SELECT doc_id, md5(trim(regexp_replace(text, '\s+', ' ', 'g'))) AS t FROM documents")
def txt_one_space(spark, sf_dir):
    return _on_docs(spark, sf_dir, t=F.md5(T.one_space(F.col("text"))))


@query("txt_standard_whitespace", r"SELECT doc_id, md5(trim(regexp_replace(regexp_replace(regexp_replace(replace(text, chr(160), ' '), '\r\n?', chr(10), 'g'), '[ \t\x0B\f]+', ' ', 'g'), ' ?\n ?', chr(10), 'g'))) AS t FROM documents")
def txt_standard_whitespace(spark, sf_dir):
    return _on_docs(spark, sf_dir, t=F.md5(T.standard_whitespace(F.col("text"))))


@query("txt_joined_hyphens", r"SELECT doc_id, length(regexp_replace(replace(text, ', ', '-' || chr(10)), '-\n(\p{Ll})', '\1', 'g')) AS n FROM documents")
def txt_joined_hyphens(spark, sf_dir):
    return _on_docs(spark, sf_dir, n=F.char_length(T.joined_hyphens(F.replace("text", F.lit(", "), F.lit("-\n")))).cast("long"))


@query("txt_excerpt", r"WITH t AS (SELECT doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS t FROM documents) SELECT doc_id, CASE WHEN length(t) > 120 THEN rtrim(left(t, 117)) || '...' ELSE t END AS t FROM t")
def txt_excerpt(spark, sf_dir):
    return _on_docs(spark, sf_dir, t=T.excerpt(F.col("text")))


@query("txt_slug", "SELECT p_partkey, coalesce(nullif(regexp_replace(regexp_replace(lower(trim(p_name)), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g'), ''), 'unknown') AS slug, regexp_replace(regexp_replace(lower(trim(p_type)), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') AS tag FROM part")
def txt_slug(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", T.slug(F.col("p_name")).alias("slug"), T.tag_key(F.col("p_type")).alias("tag"))


@query("txt_title_pattern", f"SELECT doc_id, line, trim(regexp_replace(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g'), ' +', ' ', 'g')) AS t FROM ({LINES})")
def txt_title_pattern(spark, sf_dir):
    return lines(spark, sf_dir).select("doc_id", "line", T.title_pattern(F.col("text")).alias("t"))


@query("txt_token_estimate", "SELECT doc_id, CAST(ceil(length(text) / 4.0) AS BIGINT) AS n FROM documents")
def txt_token_estimate(spark, sf_dir):
    return _on_docs(spark, sf_dir, n=T.token_estimate(F.col("text")))


@query("txt_sentences", r"WITH t AS (SELECT doc_id, regexp_replace(trim(regexp_replace(text, '\s+', ' ', 'g')), '([.!?]) ', '\1' || chr(10), 'g') AS t FROM documents) SELECT doc_id, CAST(len(list_filter(string_split(t, chr(10)), lambda s: s <> '')) AS INTEGER) AS n FROM t")
def txt_sentences(spark, sf_dir):
    return _on_docs(spark, sf_dir, n=F.size(T.sentences(F.col("text"))))


@query("txt_keyword_score", r"SELECT doc_id, round(greatest(0, least(1, least(0.6, len(regexp_extract_all(text, '\bthe\b')) * 0.02 * 500.0 / greatest(length(text), 1)) + least(0.5, len(regexp_extract_all(text, '[.]')) * 0.1 * 500.0 / greatest(length(text), 1)))), 6) AS s FROM documents")
def txt_keyword_score(spark, sf_dir):
    return _on_docs(spark, sf_dir, s=F.round(T.keyword_score(F.col("text"), {r"\bthe\b": (0.02, 0.6), "[.]": (0.1, 0.5)}), 6))


@query("txt_jaccard", "WITH w AS (SELECT doc_id, list_distinct(string_split(left(text, length(text) // 2), ' ')) AS a, list_distinct(string_split(substr(text, length(text) // 2 + 1), ' ')) AS b FROM documents) SELECT doc_id, round(len(list_intersect(a, b)) / len(list_distinct(list_concat(a, b))), 6) AS j FROM w")
def txt_jaccard(spark, sf_dir):
    middle = F.floor(F.char_length("text") / 2).cast("int")
    a, b = F.split(F.substring("text", F.lit(1), middle), " "), F.split(F.substring("text", middle + 1, F.char_length("text")), " ")
    return _on_docs(spark, sf_dir, j=F.round(T.jaccard(a, b), 6))


@query("txt_celsius", "SELECT p_partkey, round_even((p_size * 10 - 32) * 5 / 9, 0) AS c FROM part")
def txt_celsius(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", T.celsius(F.col("p_size").cast("double") * 10).alias("c"))


@query("txt_duration", "SELECT p_partkey, 'PT' || CASE WHEN m // 60 > 0 THEN (m // 60) || 'H' ELSE '' END || CASE WHEN m % 60 > 0 THEN (m % 60) || 'M' ELSE '' END AS d FROM (SELECT p_partkey, (p_size % 4) * 60 + p_size AS m FROM part)")
def txt_duration(spark, sf_dir):
    text = F.concat((F.col("p_size") % 4).cast("string"), F.lit(" hrs "), F.col("p_size").cast("string"), F.lit(" min"))
    return table(spark, sf_dir, "part").select("p_partkey", T.duration_iso(text).alias("d"))


@query("txt_title_like", r"WITH t AS (SELECT doc_id, line, regexp_replace(trim(text), '^(#+\s*|\d+[.)]\s*)', '') AS t FROM (" + LINES + r")) SELECT doc_id, line FROM t WHERE length(t) BETWEEN 1 AND 90 AND len(regexp_split_to_array(t, '\s+')) <= 12 AND regexp_matches(t, '^\p{Lu}') AND NOT ends_with(t, '.')")
def txt_title_like(spark, sf_dir):
    return lines(spark, sf_dir).filter(T.title_like(F.col("text"))).select("doc_id", "line")


@query("txt_contents_score", r"""WITH t AS (SELECT doc_id, line, trim(text) AS t, len(regexp_split_to_array(trim(text), '\s+')) AS w FROM (""" + LINES + r""")),
s AS (SELECT doc_id, line, w, CASE WHEN regexp_matches(t, '(?i)^(table of )?contents$') THEN 1.0 ELSE 0 END AS h, CASE WHEN regexp_matches(t, '\.{3,}|(\. ){3,}') THEN 0.6 ELSE 0 END + CASE WHEN regexp_matches(t, '\s\d{1,4}$') THEN 0.35 ELSE 0 END + CASE WHEN regexp_matches(t, '(?i)^(part|chapter|section|index|appendix)\b') THEN 0.25 ELSE 0 END
+ CASE WHEN w BETWEEN 2 AND 16 THEN 0.15 ELSE 0 END + CASE WHEN length(t) <= 120 THEN 0.1 ELSE 0 END AS r FROM t)
SELECT doc_id, line, CAST(round(least(1.6, CASE WHEN w = 1 AND h = 0 THEN (h + r) * 0.4 ELSE h + r END), 4) AS DOUBLE) AS s FROM s""")
def txt_contents_score(spark, sf_dir):
    return lines(spark, sf_dir).select("doc_id", "line", F.round(T.contents_score(F.col("text")), 4).alias("s"))


@query("txt_urn", "SELECT doc_id, 'urn:doc:' || sha256(text) || ':' || doc_id AS id FROM documents")
def txt_urn(spark, sf_dir):
    return _on_docs(spark, sf_dir, id=T.urn("doc", F.sha2(F.col("text").cast("binary"), 256), F.col("doc_id").cast("string")))


@query("txt_first_by_priority", "SELECT user_id, CASE WHEN bool_or(event_type = 'purchase') THEN 'purchase' WHEN bool_or(event_type = 'click') THEN 'click' ELSE 'OTHER' END AS label FROM events GROUP BY user_id")
def txt_first_by_priority(spark, sf_dir):
    e = table(spark, sf_dir, "events").groupBy("user_id").agg(F.collect_set("event_type").alias("s"))
    return e.select("user_id", T.first_by_priority(F.col("s"), ["purchase", "click"]).alias("label"))


@query("dup_lines_health", """WITH l AS (SELECT doc_id, trim(text) AS t FROM (""" + LINES + """)), c AS (SELECT doc_id, lower(t) AS k, count(*) AS n FROM l WHERE t <> '' GROUP BY ALL),
d AS (SELECT doc_id, sum(n - 1) AS again FROM c GROUP BY doc_id) SELECT l.doc_id, count(*) AS total, count(*) FILTER (t <> '') AS filled, CAST(sum(length(t)) AS BIGINT) AS chars, count(*) FILTER (length(t) BETWEEN 1 AND 3) AS tiny, count(*) FILTER (length(t) > 2000) AS long,
round(coalesce(any_value(again), 0) / greatest(1, count(*) FILTER (t <> '')), 6) AS duplicate_rate FROM l LEFT JOIN d USING (doc_id) GROUP BY l.doc_id""")
def dup_lines_health(spark, sf_dir):
    """Counts, short and long lines, and the share of lines that repeat another, of every document."""
    rows = lines(spark, sf_dir).select("doc_id", F.trim("text").alias("t"))
    n = F.char_length("t")
    counted = rows.groupBy("doc_id", F.lower("t").alias("k")).agg(F.count("*").alias("n"), F.sum(n).alias("chars"), F.count_if(n.between(1, 3)).alias("tiny"), F.count_if(n > 2000).alias("long"))
    some = F.col("k") != ""
    out = counted.groupBy("doc_id").agg(F.sum("n").alias("total"), F.sum(F.when(some, F.col("n")).otherwise(0)).alias("filled"), F.sum("chars").alias("chars"), F.sum("tiny").alias("tiny"), F.sum("long").alias("long"), F.sum(F.when(some, F.col("n") - 1).otherwise(0)).alias("_again"))
    return out.withColumn("duplicate_rate", F.round(F.col("_again") / F.greatest(F.lit(1), F.col("filled")), 6)).drop("_again")


@query("src_html_title", r"SELECT page_id, coalesce(nullif(trim(regexp_replace(regexp_replace(regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1), '<[^>]+>', '', 'g'), '\s+', ' ', 'g')), ''), nullif(trim(regexp_replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '\s+', ' ', 'g')), ''), 'untitled') AS title FROM pages")
def src_html_title(spark, sf_dir):
    from larder.sources.html import title

    return table(spark, sf_dir, "pages").select("page_id", title(F.col("html")).alias("title"))


@query("src_html_blocks")
def src_html_blocks(spark, sf_dir):
    from larder.sources.html import blocks

    return blocks(table(spark, sf_dir, "pages"), "page_id", "html")


@query("src_html_links", r"SELECT page_id, CAST(len(regexp_extract_all(html, '(?i)<a\s[^>]*href=\"([^\"]*)\"', 1)) AS INTEGER) AS n, nullif(regexp_extract(html, '(?is)<link[^>]*rel=\"canonical\"[^>]*href=\"([^\"]*)\"', 1), '') AS canonical FROM pages".replace('\\"', '"'))
def src_html_links(spark, sf_dir):
    from larder.sources.html import canonical, links

    return table(spark, sf_dir, "pages").select("page_id", F.size(links(F.col("html"))).alias("n"), canonical(F.col("html")).alias("canonical"))


@query("src_markdown_blocks")
def src_markdown_blocks(spark, sf_dir):
    from larder.sources.lines import markdown_blocks

    return markdown_blocks(table(spark, sf_dir, "documents"), "doc_id", "text")


@query("src_line_ranges", r"SELECT doc_id, CAST(length(left(text, length(text) // 3)) - length(replace(left(text, length(text) // 3), chr(10), '')) + 1 AS INTEGER) AS first_line, CAST(length(left(text, length(text) // 3 * 2)) - length(replace(left(text, length(text) // 3 * 2), chr(10), '')) + 1 AS INTEGER) AS last_line FROM documents")
def src_line_ranges(spark, sf_dir):
    from larder.sources.lines import line_at

    third = F.floor(F.char_length("text") / 3).cast("int")
    return _on_docs(spark, sf_dir, first_line=line_at(F.col("text"), third), last_line=line_at(F.col("text"), third * 2))


@query("src_wrapped_lines", r"""WITH l AS (SELECT doc_id, line, trim(text) AS t FROM (""" + LINES + r""") WHERE trim(text) <> ''), s AS (SELECT *, CASE WHEN lag(t) OVER w IS NULL OR regexp_matches(lag(t) OVER w, '[.!?]$') OR regexp_matches(t, '^(\d+[.)]|[-*•])') THEN 1 ELSE 0 END AS b FROM l WINDOW w AS (PARTITION BY doc_id ORDER BY line)),
g AS (SELECT *, sum(b) OVER (PARTITION BY doc_id ORDER BY line) AS g FROM s) SELECT doc_id, CAST(g - 1 AS INTEGER) AS block, md5(string_agg(t, ' ' ORDER BY line)) AS t FROM g GROUP BY doc_id, g""")
def src_wrapped_lines(spark, sf_dir):
    from larder.sources.lines import unwrapped

    return unwrapped(lines(spark, sf_dir), "doc_id", "line", "text").select("doc_id", "block", F.md5("text").alias("t"))
