"""Discovery: official list and search pages -> candidate rows.

Each reader takes landed pages (one row per page, parsed by ``with_page``) and returns
one row per candidate; rejected rows come back as a second frame with a reason.
Repeated ids keep the last row in page order unless stated otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import dates, facts, urls
from ..functions import patterns as P
from ..functions.text import blank_to_null, clean, nfkc_clean
from ..operators.dedupe import first_per_key, last_per_key, top_per_key
from ..operators.unnest import unnest
from .html import Page, has_class

# Detail routes of the procurement search and the sites' URL shapes.
PROCUREMENT_BASE = "https://web.pcc.gov.tw"
PROCUREMENT_ROUTES = {
    "formViewNew": "/opas/aspam/public/readOneAspamDetailOld",
    "formViewOld": "/opas/aspam/public/readOneAspamDetailNew",
    "formViewNormal": "/opas/aspam/public/readOneAspamDetail",
}
CENTRAL_ORIGIN = "https://auction.moj.gov.tw"
CENTRAL_HOSTS = ["auction.moj.gov.tw"]
SALE_DETAIL = "https://shwoo.gov.taipei/shwoo/newproduct/newproduct00/product?AUID="
CUSTOMS_HOSTS = ["web.customs.gov.tw"]
LOOK_BACK_DAYS = 90


def _is_title_cell(n: Column) -> Column:
    return n["attr_data_title"] == "標題"


def _arrival(*columns: str) -> Column:
    return F.struct(*[F.col(c) for c in columns]).alias("arrival")


def search_rows(pages: DataFrame, order: str = "page_no") -> DataFrame:
    """Search-result rows: six or more cells and a ``formViewX(key, ...)`` option."""
    p = Page()
    option = lambda r: F.get(
        p.inside(r, "option", where=lambda n: n["attr_value"].contains("formView")), F.lit(0)
    )["attr_value"]
    raw = F.transform(
        p.select("tr"), lambda r: F.struct(F.transform(p.inside(r, "td"), p.text).alias("cells"), option(r).alias("action"))
    )
    rows = unnest(pages, raw, "x", order, position="row_no").filter(F.size("x.cells") >= 6)
    cell = lambda i: nfkc_clean(F.get("x.cells", F.lit(i)))
    call = r"(formView(?:New|Old|Normal))\((\d+),"
    routes = F.create_map(*[F.lit(x) for pair in PROCUREMENT_ROUTES.items() for x in pair])
    shaped = rows.select(
        _arrival(order, "row_no"),
        blank_to_null(F.regexp_extract("x.action", call, 2)).alias("source_record_id"),
        F.regexp_extract("x.action", call, 1).alias("function"),
        cell(1).alias("organization"), cell(2).alias("case_number"), cell(3).alias("announcement_count"),
        cell(4).alias("title"), cell(5).alias("announcement_date"),
    ).filter(F.col("source_record_id").isNotNull() & facts.is_procurement_vehicle(F.col("title")))
    latest = last_per_key(shaped, ["source_record_id"], F.col("arrival"))
    return latest.withColumn(
        "official_url",
        F.concat(
            F.lit(PROCUREMENT_BASE), F.try_element_at(routes, F.col("function")), F.lit("?pk="), F.col("source_record_id")
        ),
    ).drop("arrival", "function")


def central_list(pages: DataFrame, order: str = "page_no") -> DataFrame:
    """Seized-property list rows; the id comes from one of three URL shapes."""
    p = Page()

    def row(r: Column) -> Column:
        cells = p.inside(r, "td", where=lambda n: n["attr_data_title"].isNotNull())
        title_cell = F.get(F.filter(cells, _is_title_cell), F.lit(0))
        link = F.get(p.inside(title_cell, "a", where=lambda n: n["attr_href"].isNotNull()), F.lit(0))

        def named(label: str) -> Column:
            return p.text(F.try_element_at(F.filter(cells, lambda n: n["attr_data_title"] == label), F.lit(-1)))

        return F.struct(
            link["attr_href"].alias("href"), p.text(link).alias("title"), named("單位").alias("organization"),
            named("張貼日").alias("published_date"),
        )

    rows = F.flatten(F.transform(
        p.select("table", where=lambda n: has_class(n, "table_list")), lambda t: F.transform(p.inside(t, "tr"), row)
    ))
    url = urls.join_url(F.lit(CENTRAL_ORIGIN), F.col("x.href"))
    listed = (
        unnest(pages, rows, "x", order, position="row_no")
        .filter(F.col("x.href").isNotNull() & facts.is_central_list_vehicle(F.col("x.title")))
        .select(_arrival(order, "row_no"), url.alias("official_url"), "x.title", "x.organization", "x.published_date")
        .filter(urls.host(F.col("official_url")).isin(CENTRAL_HOSTS))
        .withColumn("source_record_id", central_record_id(F.col("official_url")))
        .filter(F.col("source_record_id").isNotNull())
    )
    return last_per_key(listed, ["source_record_id"], F.col("arrival")).drop("arrival")


def central_record_id(url: Column) -> Column:
    """Post number, else node number, else media folder and file name."""
    where = urls.path(url)
    post = blank_to_null(F.regexp_extract(where, r"/1724/1726/(\d+)(?:/post)?", 1))
    node = F.get(urls.query_values(url, "nodeId"), F.lit(0))
    folder = blank_to_null(F.regexp_extract(where, r"/media/([^/]+)/(.+)", 1))
    name = F.regexp_extract(where, r"([^/]*)/*$", 1)
    return F.coalesce(
        post, F.concat(F.lit("node-"), node), F.concat(F.lit("media-"), folder, F.lit("-"), name)
    )


def exact_rows(pages: DataFrame, content: str = "content", order: str = "page_no") -> DataFrame:
    """Every raw ``<tr>`` slice of a landed list as its own artifact with checksum."""
    raw = F.regexp_extract_all(F.col(content), F.lit(r"(?is)<tr\b[^>]*>.*?</tr\s*>"), F.lit(0))
    return unnest(pages, raw, "row_html", order, position="row_no").withColumn(
        "checksum_sha256", F.sha2("row_html", 256)
    )


def sale_links(pages: DataFrame) -> DataFrame:
    """Sale-page links of one landed page set: id, title by three fallbacks, page flags.

    Pages carry ``page_no``, ``recycler_only`` and ``result_record``.
    """
    p = Page()

    def link(a: Column) -> Column:
        own = p.text(a)
        row = F.try_element_at(
            F.filter(p.select("tr"), lambda r: (r["pos"] < a["pos"]) & (a["pos"] < r["end"])), F.lit(-1)
        )
        sixth = F.get(p.inside(row, "td"), F.lit(5))
        alt = clean(F.get(p.inside(a, "img"), F.lit(0))["attr_alt"])
        shown = F.when(F.col("result_record") & sixth.isNotNull(), p.text(sixth)).otherwise(own)
        return F.struct(
            blank_to_null(F.regexp_extract(a["attr_href"], r"AUID=(\d+)", 1)).alias("source_record_id"),
            F.coalesce(blank_to_null(shown), blank_to_null(alt)).alias("title"),
        )

    anchors = p.select("a", where=lambda n: n["attr_href"].contains("AUID="))
    return (
        unnest(pages, F.transform(anchors, link), "x", "page_no", "recycler_only", "result_record", position="link_no")
        .filter(F.col("x.source_record_id").isNotNull() & F.col("x.title").isNotNull())
        .select("x.source_record_id", "x.title", "recycler_only", "result_record", "page_no", "link_no")
    )


def merge_sale_links(links: DataFrame, keywords: list[str]) -> DataFrame:
    """Browse pages: the last sighting wins. Result pages only add ids not browsed.

    Within one result page a later link replaces an earlier one, across result pages the
    first page wins, and a result title must contain a keyword.
    """
    wanted = F.col("title").rlike("|".join(keywords))
    usable = links.filter(~F.col("result_record") | wanted)
    order = [
        F.col("result_record").asc(),
        F.when(F.col("result_record"), F.col("page_no")).otherwise(-F.col("page_no")).asc(),
        F.col("link_no").desc(),
    ]
    merged = top_per_key(usable, ["source_record_id"], order)
    return merged.select(
        "source_record_id", F.concat(F.lit(SALE_DETAIL), F.col("source_record_id")).alias("official_url"), "title",
        "recycler_only", "result_record",
    )


def office_candidates(pages: DataFrame, per_page: int | None = None) -> DataFrame:
    """Office list rows: same channel, exactly one ``cntId``; all of a page unless ``per_page`` asks for its first ones.

    Pages carry ``office``, ``organization``, ``list_url``, ``current_url``, ``page_no``.
    """
    p = Page()
    in_body = F.flatten(F.transform(p.select("tbody"), lambda b: p.inside(b, "tr")))
    all_rows = F.flatten(F.transform(p.select("table"), lambda t: p.inside(t, "tr")))
    shown = F.when(F.size(in_body) > 0, in_body).otherwise(all_rows)
    if per_page is not None:
        shown = F.slice(shown, 1, per_page)

    def row(r: Column) -> Column:
        link = F.get(p.inside(r, "a", where=lambda n: n["attr_href"].contains("cntId=")), F.lit(0))
        return F.struct(link["attr_href"].alias("href"), p.text(link).alias("title"), p.text(r).alias("text"))

    rows = unnest(
        pages, F.transform(shown, row), "x", "office", "organization", "list_url", "current_url", "page_no", position="row_no"
    ).filter(F.col("x.href").isNotNull() & (F.col("x.title") != ""))
    target = F.col("official_url")
    detail_path = F.replace(urls.path(F.col("list_url")), F.lit("/multiplehtml/"), F.lit("/singlehtml/"))
    kept = (
        rows.withColumn("official_url", urls.join_url(F.col("current_url"), F.col("x.href")))
        .withColumn("ids", urls.query_values(target, "cntId"))
        .filter(
            (urls.scheme(target) == "https") & urls.host(target).isin(CUSTOMS_HOSTS)
            & (urls.path(target) == detail_path) & (F.size("ids") == 1)
        )
    )
    shaped = kept.select(
        _arrival("page_no", "row_no"),
        F.concat(F.col("office"), F.lit("-"), F.get("ids", F.lit(0))).alias("source_record_id"),
        "official_url", F.col("x.title").alias("title"), "organization",
        F.regexp_extract("x.text", r"\d{4}-\d{1,2}-\d{1,2}|\d{2,3}-\d{1,2}-\d{1,2}", 0).alias("published_date"),
    )
    return last_per_key(shaped, ["source_record_id"], F.col("arrival")).drop("arrival")


def office_page_links(pages: DataFrame) -> DataFrame:
    """Pagination targets on the same channel, distinct per page."""
    p = Page()
    numbered = p.select("a", where=lambda n: n["attr_href"].isNotNull() & p.text(n).rlike(r"^(\d+|下一頁|最後一頁)$"))
    targets = F.transform(numbered, lambda n: urls.join_url(F.col("current_url"), n["attr_href"]))
    same = F.filter(
        F.array_sort(F.array_distinct(targets)),
        lambda u: (urls.scheme(u) == "https") & urls.host(u).isin(CUSTOMS_HOSTS)
        & (urls.path(u) == urls.path(F.col("list_url"))),
    )
    return unnest(pages, same, "target_url", "office", "page_no")


def branch_lists(pages: DataFrame, per_branch: int | None = None) -> DataFrame:
    """Announcement lists of each branch home page, best first; all unless ``per_branch`` asks for the first ones.

    Pages carry ``branch`` and ``host``. Immovable-only labels are out; labels rank by
    the order of the known markers, then by position; equal targets count once.
    """
    p = Page()
    anchors = F.transform(
        p.select("a", where=lambda n: n["attr_href"].isNotNull()),
        lambda n: F.struct(
            clean(F.concat_ws(" ", n["attr_title"], p.text(n))).alias("label"), n["attr_href"].alias("href")
        ),
    )
    rest = F.replace(F.col("label"), F.lit(P.IMMOVABLE_LABEL), F.lit(""))
    immovable_only = F.col("label").contains(P.IMMOVABLE_LABEL) & ~rest.contains("動產拍賣")
    priority = F.coalesce(*[F.when(F.col("label").contains(m), F.lit(i)) for i, m in enumerate(P.LIST_LABELS)])
    url = urls.join_url(F.concat(F.lit("https://"), F.col("host")), F.col("href"))
    where = urls.path(F.col("url"))
    ranked = (
        unnest(pages, anchors, "x", "branch", "host", position="position")
        .select("branch", "host", "position", "x.label", "x.href")
        .withColumn("priority", priority)
        .filter(F.col("priority").isNotNull() & ~immovable_only)
        .withColumn("url", url)
        .filter((urls.scheme(F.col("url")) == "https") & (urls.host(F.col("url")) == F.col("host")))
        .filter(~where.startswith("/umbraco/surface/") & ~where.contains("/post"))
        .withColumn(
            "list_url", F.concat(F.lit("https://"), F.col("host"), F.regexp_replace(where, "Lpsimplelist$", ""))
        )
    )
    best = ranked.groupBy("branch", "list_url").agg(F.min(F.struct("priority", "position")).alias("rank"))
    order = [F.col("rank").asc(), F.col("list_url").asc()]
    if per_branch is not None:
        return top_per_key(best, ["branch"], order, per_branch, "list_no").select("branch", "list_no", "list_url")
    numbered = best.withColumn("list_no", F.row_number().over(Window.partitionBy("branch").orderBy(*order)))
    return numbered.select("branch", "list_no", "list_url")


def recent_notices(pages: DataFrame, as_of) -> tuple[DataFrame, DataFrame]:
    """Branch list rows of the last ninety days whose title names a vehicle auction.

    Pages carry ``branch``, ``organization``, ``host``, ``page_url``. The second frame
    holds rows given up with the reason.
    """
    p = Page()

    def row(r: Column) -> Column:
        title_cell = p.inside(r, "td", where=_is_title_cell)
        link = F.get(F.flatten(F.transform(
            title_cell, lambda c: p.inside(c, "a", where=lambda n: n["attr_href"].isNotNull()))), F.lit(0))
        date = F.get(p.inside(r, "td", where=lambda n: n["attr_data_title"].contains("日期") | has_class(n, "date")), F.lit(0))
        title = F.coalesce(blank_to_null(p.text(link)), clean(link["attr_title"]))
        return F.struct(link["attr_href"].alias("href"), title.alias("title"), p.text(date).alias("date"),
                        date.isNotNull().alias("dated"))

    rows = F.flatten(F.transform(
        p.select("table", where=lambda n: has_class(n, "table_list")), lambda t: F.transform(p.inside(t, "tr"), row)
    ))
    listed = (
        unnest(pages, rows, "x", "branch", "organization", "host", "page_url", position="row_no")
        .filter(F.col("x.href").isNotNull() & F.col("x.dated"))
        .withColumn("published_at", dates.roc_list_date(F.col("x.date")))
        .withColumn("official_url", urls.join_url(F.col("page_url"), F.col("x.href")))
    )
    url = F.col("official_url")
    recent = F.col("published_at") >= dates.instant(as_of) - F.make_dt_interval(F.lit(LOOK_BACK_DAYS))
    wanted = recent & facts.is_vehicle_auction(F.col("x.title"))
    same_host = F.coalesce(
        (urls.scheme(url) == "https") & (urls.host(url) == F.col("host")) & urls.path(url).endswith("/post"), F.lit(False)
    )
    reason = F.when(F.col("published_at").isNull(), "publication date is not an ROC date").when(
        wanted & ~same_host, "vehicle row without a same-host HTML post"
    )
    labelled = listed.withColumn("error", reason)
    number = blank_to_null(F.regexp_extract(urls.path(url), r"/(\d+)/post/?$", 1))
    key = F.coalesce(number, F.substring(F.sha2(url, 256), 1, 24))
    items = labelled.filter(wanted & same_host).select(
        F.concat(F.col("branch"), F.lit("-"), key).alias("source_record_id"), "official_url",
        F.col("x.title").alias("title"), "organization", "published_at", "branch", F.col("page_url").alias("discovery_url"),
    )
    given_up = labelled.filter(F.col("error").isNotNull()).select("branch", "page_url", "row_no", "error")
    return items, given_up


def has_next_page() -> Column:
    p = Page()
    pager = p.select("ul", where=lambda n: has_class(n, "page"))
    links = F.flatten(F.transform(pager, lambda u: p.inside(u, "a", where=lambda n: n["attr_title"] == "下一頁")))
    return F.size(links) > 0


# --- attachments ---------------------------------------------------------------------
def _region_links(p: Page, region, *tags: str) -> Column:
    zones = p.select(where=region)
    return F.flatten(F.transform(zones, lambda z: p.inside(z, *tags)))


def attachment_urls(source: str, base: Column, page: str = "page", limit: int | None = None) -> Column:
    """Distinct absolute attachment links of a detail page, in page order; all unless ``limit`` asks for the first ones."""
    p = Page(page)
    if source == "moj_enforcement_cms":
        nodes = _region_links(p, lambda n: has_class(n, "file_download"), "a")
        nodes = F.filter(nodes, lambda n: F.lower(F.concat_ws(" ", n["attr_title"], p.text(n))).contains(".pdf")
                         | F.lower(urls.path(n["attr_href"])).endswith(".pdf"))
    elif source == "moj_auction":
        nodes = p.select(where=lambda n: in_region(p, n, "file_download", "a") | in_region(p, n, "cp", "img")
                         | in_region(p, n, "cp_slider", "img"))
    elif source == "moj_enforcement":
        nodes = p.select(where=lambda n: ((n["tag"] == "a") & n["attr_href"].contains("/File/Download"))
                         | ((n["tag"] == "img") & in_id(p, n, "slider", "carousel")))
    else:
        nodes = p.select(where=lambda n: ((n["tag"] == "a") & n["attr_href"].contains("imageResize"))
                         | ((n["tag"] == "img") & n["attr_src"].contains("/image?")))
    targets = F.transform(nodes, lambda n: urls.join_url(base, F.coalesce(blank_to_null(n["attr_href"]), n["attr_src"])))
    kept = F.filter(targets, lambda u: u.isNotNull() & (urls.host(u) == urls.host(base)))
    if source == "moj_enforcement_cms":
        kept = F.filter(kept, lambda u: urls.scheme(u) == "https")
    if source == "shwoo":
        kept = F.filter(targets, lambda u: u.isNotNull())
    links = F.array_distinct(kept)
    return links if limit is None else F.slice(links, 1, limit)


def in_region(p: Page, n: Column, region_class: str, tag: str) -> Column:
    zone = F.exists(
        p.nodes, lambda z: has_class(z, region_class) & (z["pos"] < n["pos"]) & (n["pos"] < z["end"])
    )
    return (n["tag"] == tag) & zone


def in_id(p: Page, n: Column, *ids: str) -> Column:
    return F.exists(p.nodes, lambda z: z["attr_id"].isin(*ids) & (z["pos"] < n["pos"]) & (n["pos"] < z["end"]))

