"""Audit, redaction, addressing and page reading over the supplied documents and pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from noticelake.functions import redact
from noticelake.operators import quality
from noticelake.sources import artifacts, html

from .derive import base, spark_sql
from .registry import Registry

c = F.col
query = Registry()

AUDIT = r"""
rules AS (SELECT doc_id, source, rule FROM (
  SELECT doc_id, source, 'Supabase service key' AS rule, regexp_matches(text, '(?i)SUPABASE_SERVICE_ROLE_KEY\s*=|service_role["'']?\s*[:=]\s*["''][A-Za-z0-9._-]{20,}') AS hit FROM documents
  UNION ALL SELECT doc_id, source, 'JWT-like secret', regexp_matches(text, 'eyJ[A-Za-z0-9_-]{20,}\.[A-Za-z0-9_-]{20,}\.[A-Za-z0-9_-]{10,}') FROM documents
  UNION ALL SELECT doc_id, source, 'private environment owner', regexp_matches(text, '(?i)OWNER_EMAIL\s*=|owner@example\.com') FROM documents
  UNION ALL SELECT doc_id, source, 'Taiwan national ID', regexp_matches(text, '(?i)\b[A-Z][12]\d{8}\b') FROM documents
  UNION ALL SELECT doc_id, source, 'role-labelled person name', regexp_matches(text, '(義務人|債務人|所有人|車主|被告|受刑人|保管人|姓名)\s*[:：]?\s*[一-龥○ＯO·．・]{2,6}') FROM documents
  UNION ALL SELECT doc_id, source, 'phone number', regexp_matches(text, '\b(?:09\d{2}[- ]?\d{3}[- ]?\d{3}|0\d{1,2}[- ]\d{6,8})\b') FROM documents
  UNION ALL SELECT doc_id, source, 'email address', regexp_matches(text, '(?i)\b[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{2,}\b') FROM documents
  UNION ALL SELECT doc_id, source, 'vehicle plate', regexp_matches(regexp_replace(text, '\b(WEB|ERR)-', '', 'g'), '\b(?:[A-Z]{2,3}-\d{4}|\d{3}-[A-Z]{3})\b') FROM documents
  UNION ALL SELECT doc_id, source, 'official attachment deep link', regexp_matches(text, '(?i)(?:DO_VIEWPDF\.htm|AUID=\d+|readOneAspamDetailOld\?|/Detail/Chattel\?NO=)') FROM documents
) x WHERE hit)"""


def findings(spark, sf_dir):
    return quality.audit(base(spark, sf_dir, "documents").select("doc_id", "source", "text"))


@query("audit_documents", f"WITH {AUDIT} SELECT doc_id, source, rule FROM rules")
def audit_documents(spark, sf_dir):
    return findings(spark, sf_dir)


@query("audit_counts", f"WITH {AUDIT} SELECT source, rule, count(*) AS findings FROM rules GROUP BY source, rule")
def audit_counts(spark, sf_dir):
    return quality.audit_counts(findings(spark, sf_dir), ["source"])


# RE2 has no lookaround: boundaries are captured and put back. Two passes cover tokens that share one boundary character.
VIN_RE = r"(^|[^A-Za-z0-9])[A-HJ-NPR-Za-hj-npr-z0-9]{17}([^A-Za-z0-9]|$)"
PHONE_RE = r"(^|[^0-9])(?:09[0-9]{2}(?:[-－ ]?[0-9]{3}){2}|0[0-9]{1,2}[-－ ]?[0-9]{6,8})(?:\s*(?:#|分機)\s*[0-9]+)?([^0-9]|$)"
ID_RE = r"(^|[^A-Za-z0-9])[A-Za-z][12][0-9]{8}([^A-Za-z0-9]|$)"


def twice(expression: str, pattern: str, word: str) -> str:
    once = f"regexp_replace({expression}, '{pattern}', '\\1{word}\\2', 'g')"
    return f"regexp_replace({once}, '{pattern}', '\\1{word}\\2', 'g')"


_SANITIZED = twice("text", VIN_RE, "車身識別碼已隱藏")
_SANITIZED = f"regexp_replace({_SANITIZED}, '((?:引擎|車身|車架|VIN)(?:號碼|號|碼)?\\s*[:：]?\\s*)[A-Za-z0-9-]{{5,}}', '\\1已隱藏', 'gi')"
_SANITIZED = twice(_SANITIZED, PHONE_RE, "聯絡電話已隱藏")
_SANITIZED = f"regexp_replace({_SANITIZED}, '[A-Z0-9._%+-]+@[A-Z0-9.-]+\\.[A-Z]{{2,}}', '聯絡信箱已隱藏', 'gi')"
_SANITIZED = twice(_SANITIZED, ID_RE, "身分證字號已隱去")


@query("sanitize_documents", f"""
SELECT doc_id, md5(safe) AS digest, safe <> text AS changed, contains(safe, '聯絡信箱已隱藏') AS had_email, contains(safe, '聯絡電話已隱藏') AS had_phone
FROM (SELECT doc_id, text, {_SANITIZED} AS safe FROM documents) x""")
def sanitize_documents(spark, sf_dir):
    docs = base(spark, sf_dir, "documents").select("doc_id", "text").withColumn("safe", redact.sanitize(c("text")))
    return docs.select(
        "doc_id", F.md5("safe").alias("digest"), (c("safe") != c("text")).alias("changed"), c("safe").contains("聯絡信箱已隱藏").alias("had_email"),
        c("safe").contains("聯絡電話已隱藏").alias("had_phone"))


@query("artifact_addressing", """
SELECT checksum_sha256, substr(checksum_sha256, 1, 2) || '/' || checksum_sha256 || '.txt' AS storage_path, min(doc_id) AS first_doc,
  CAST(max(strlen(text)) AS BIGINT) AS content_length
FROM (SELECT doc_id, text, sha256(text) AS checksum_sha256 FROM documents) x GROUP BY 1, 2""")
def artifact_addressing(spark, sf_dir):
    from noticelake.operators.dedupe import first_per_key

    docs = base(spark, sf_dir, "documents").select("doc_id", c("text").alias("content"), F.lit("text/plain").alias("mime_type"))
    stored = artifacts.with_checksum(docs)
    return first_per_key(stored, ["checksum_sha256", "storage_path"], c("doc_id")).select(
        "checksum_sha256", "storage_path", c("doc_id").alias("first_doc"), "content_length")


@query("mime_headers", """
SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'application/pdf' WHEN 1 THEN 'text/html' WHEN 2 THEN 'application/octet-stream' ELSE 'image/png' END AS mime_type,
  page_id % 4 <> 2 AS allowed, 'content-type,etag' AS kept FROM pages""")
def mime_headers(spark, sf_dir):
    rows = spark_sql(spark, sf_dir, "", """SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'application/octet-stream; x' WHEN 1 THEN 'Text/HTML; charset=utf-8'
        WHEN 2 THEN 'application/octet-stream' ELSE 'image/png' END AS declared, CASE page_id % 4 WHEN 0 THEN '%PDF-1.4 ' ELSE '' END || url AS body,
        map('ETag', url, 'Content-Type', 'a', 'Set-Cookie', 'secret') AS headers FROM pages""")
    kind = artifacts.sniffed_type(c("declared"), F.encode("body", "utf-8"))
    names = F.array_sort(F.map_keys(artifacts.kept_headers(c("headers"), "moj_auction")))
    return rows.select("page_id", kind.alias("mime_type"), artifacts.is_allowed_type(kind, "moj_auction").alias("allowed"),
                       F.array_join(names, ",").alias("kept"))


@query("url_sanitize", """
SELECT page_id, CASE WHEN page_id % 3 = 0 THEN regexp_extract(url, '^[a-z]+://[^/?#]*') || '/' ELSE url || '&n=' || page_id END AS public_url FROM pages""")
def url_sanitize(spark, sf_dir):
    rows = spark_sql(spark, sf_dir, "", """SELECT page_id, url || CASE WHEN page_id % 3 = 0 THEN '&id=%41123456789' ELSE '&n=' || CAST(page_id AS STRING) END AS u
        FROM pages""")
    return rows.select("page_id", redact.sanitize_url(c("u")).alias("public_url"))


def parsed(spark, sf_dir):
    return html.with_page(base(spark, sf_dir, "pages").select("page_id", "url", "html"), "html")


@query("page_links", """
SELECT page_id, len(hrefs) AS links, array_to_string(hrefs, ' ') AS hrefs
FROM (SELECT page_id, regexp_extract_all(html, '<a\\s+href="([^"]*)"', 1) AS hrefs FROM pages) x""".replace("\\\\", "\\"))
def page_links(spark, sf_dir):
    p = html.Page()
    hrefs = F.transform(p.select("a", where=lambda n: n["attr_href"].isNotNull()), lambda n: n["attr_href"])
    return parsed(spark, sf_dir).select("page_id", F.size(hrefs).cast("bigint").alias("links"), F.array_join(hrefs, " ").alias("hrefs"))


@query("page_link_rows")
def page_link_rows(spark, sf_dir):
    return html.page_links(parsed(spark, sf_dir))


@query("page_nodes", r"""
SELECT page_id, CAST(len(regexp_extract_all(bare, '<li[ >]')) AS BIGINT) AS items, CAST(len(regexp_extract_all(bare, '<meta[ >]')) AS BIGINT) AS metas,
  CAST(len(regexp_extract_all(bare, '<h1[ >]')) AS BIGINT) AS headings, CAST(len(regexp_extract_all(bare, '<article[ >]')) AS BIGINT) AS articles
FROM (SELECT page_id, regexp_replace(regexp_replace(html, '(?s)<script.*?</script>', '', 'g'), '(?s)<!--.*?-->', '', 'g') AS bare FROM pages) x""")
def page_nodes(spark, sf_dir):
    nodes = html.page_nodes(parsed(spark, sf_dir))
    return nodes.groupBy("page_id").agg(
        F.count_if(c("tag") == "li").alias("items"), F.count_if(c("tag") == "meta").alias("metas"),
        F.count_if(c("tag") == "h1").alias("headings"), F.count_if(c("tag") == "article").alias("articles"))


@query("page_meta", r"""
SELECT page_id, coalesce(nullif(regexp_extract(html, '<meta\s+name="description"\s+content="([^"]*)"', 1), ''), '') AS description,
  regexp_extract(html, '<html lang="([^"]*)"', 1) <> '' AS has_lang FROM pages""")
def page_meta(spark, sf_dir):
    p = html.Page()
    return parsed(spark, sf_dir).select(
        "page_id", F.coalesce(p.meta("description"), F.lit("")).alias("description"), p.first("html").isNotNull().alias("has_lang"))


@query("page_text")
def page_text(spark, sf_dir):
    p = html.Page()
    scope = html.article_scope(p)
    return parsed(spark, sf_dir).select(
        "page_id", F.when(scope.isNotNull(), p.text(scope)).otherwise(p.all_text()).alias("text"), p.text(p.first("h1")).alias("heading"))
