"""URL filter: host and path rules, propagated over redirect and canonical-link equivalence.

A rule names a host, which stands for all its subdomains too, and a beginning of the path; the longest rule that fits a URL
decides, and of equally long ones an allowing rule goes first.  A URL without a rule takes the decision of its aliases.

URLs are aliases when they have one normal form (no scheme, no fragment, no tracking parameters, no slash at the end), or
when a page's canonical link, its refresh tag or a row of ``redirects`` leads from one to the other, over any number of
steps: normal forms are the nodes of a graph, and the decisions of a connected component meet in one row.  There an explicit
allow goes before any block; a component without a decision is allowed.

Only normal forms that have a rule or an edge are aggregated and joined back; pages travel without their html.

Defined results: a url that is null or has no ``://`` has empty host and path, no rule, no alias, and is allowed; repeated
rows and null ids get a row each; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, stored
from .components import connected_components

# The rules of the registered query, as (verdict, host, path).
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)

#: Query parameters that do not tell pages apart.
TRACKING = r"^(utm_[a-z]+|ref|gclid|fbclid)(=|\z)"
#: The tags that name another URL of the page, and the URL in them.
CANONICAL_TAG = r"(?is)<link\b[^>]*\brel\s*=\s*[\x22\x27]?canonical\b[^>]*>"
CANONICAL_HREF = r"(?is)\bhref\s*=\s*[\x22\x27]?([^\x22\x27\s>]+)"
REFRESH_TAG = r"(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*[\x22\x27]?refresh\b[^>]*>"
REFRESH_HREF = r"(?is)\burl\s*=\s*[\x22\x27]?([^\x22\x27\s>]+)"


def _rest(url: Column) -> Column:
    """What follows the first ``://``; empty without it."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def url_host(url: Column) -> Column:
    """The host, A-Z lower-cased."""
    return ascii_lower(F.regexp_extract(_rest(url), r"^[^/?#]*", 0))


def url_path(url: Column) -> Column:
    """The path, with its first slash, without query and fragment."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def normal_form(url: Column) -> Column:
    """The node that a URL is in the alias graph; null without a host."""
    query = F.regexp_extract(_rest(url), r"^[^?#]*\?([^#]*)", 1)
    kept = F.array_join(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING)), "&")
    host = url_host(url)
    form = F.concat(host, F.regexp_replace(url_path(url), r"/+\z", ""), F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise(F.lit("")))
    return F.when(host != "", form)


def rule_of(host: Column, path: Column, rules: tuple[tuple[str, str, str], ...] = RULES) -> Column:
    """struct<rule, verdict> of the longest rule that fits, or null."""
    fits = F.lit(None).cast("struct<rule:string,verdict:string>")
    # The first that fits is taken, so the best is put outermost.
    for verdict, h, p in sorted(rules, key=lambda r: (len(r[1]) + len(r[2]), r[0] == "allow", r[1])):
        here = ((host == h) | F.endswith(host, F.lit(f".{h}"))) & F.startswith(path, F.lit(p))
        fits = F.when(here, F.struct(F.lit(f"{h}{p}").alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(fits)
    return fits


def _resolved(target: Column, url: Column) -> Column:
    """A link's target as a whole URL, seen from the page it stands on."""
    root = F.concat(F.lit("http://"), url_host(url))
    folder = F.regexp_extract(url_path(url), r"^(.*/)", 1)
    return (
        F.when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), target)
        .when(F.startswith(target, F.lit("//")), F.concat(F.lit("http:"), target))
        .when(F.startswith(target, F.lit("/")), F.concat(root, target))
        .otherwise(F.concat(root, F.when(folder == "", F.lit("/")).otherwise(folder), target))
    )


def page_links(pages: DataFrame, *, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """src, dst: from each page's url to the targets of its canonical link and refresh tag."""
    found = []
    for word, tag, href in (("canonical", CANONICAL_TAG, CANONICAL_HREF), ("refresh", REFRESH_TAG, REFRESH_HREF)):
        rows = pages.select(F.col(url_col).cast("string").alias("src"), F.col(html_col).cast("string").alias("html"))
        rows = rows.where(F.col("html").rlike(f"(?i){word}")).select("src", F.regexp_extract(F.regexp_extract("html", tag, 0), href, 1).alias("to"))
        found.append(rows.where("to <> ''").select("src", _resolved(F.col("to"), F.col("src")).alias("dst")))
    return found[0].union(found[1])


def filter_urls(
    pages: DataFrame,
    *,
    rules: tuple[tuple[str, str, str], ...] = RULES,
    redirects: DataFrame | None = None,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str | None = "html",
) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, propagated (whether an alias decided).

    redirects: rows src, dst of URLs; html_col: None where pages have no html.
    """
    url = F.col("url")
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"))
    rows = rows.select("page_id", url_host(url).alias("host"), url_path(url).alias("path"), normal_form(url).alias("node"))
    rows = rows.withColumns({"host": F.coalesce("host", F.lit("")), "path": F.coalesce("path", F.lit(""))}).withColumn("fit", rule_of(F.col("host"), F.col("path"), rules))

    links = redirects.select(F.col("src").cast("string"), F.col("dst").cast("string")) if redirects is not None else None
    if html_col is not None:
        own = page_links(pages, url_col=url_col, html_col=html_col)
        links = own if links is None else links.union(own)

    said = rows.where("node is not null and fit is not null").select("node", F.col("fit.verdict").alias("verdict"))
    component = None
    if links is not None:
        links = stored(links.where("src is not null and dst is not null"), "links")
        nodes = links.select(normal_form(F.col("src")).alias("u"), normal_form(F.col("dst")).alias("v"))
        component = connected_components(nodes)
        # A URL that is only linked to has a rule as well.
        ends = links.select(F.explode(F.array("src", "dst")).alias("url")).distinct()
        ends = ends.select(normal_form(url).alias("node"), rule_of(url_host(url), url_path(url), rules)["verdict"].alias("verdict"))
        said = said.union(ends.where("node is not null and verdict is not null"))
    # 'allow' sorts before 'block': the least verdict is the one that goes first.
    said = said.groupBy("node").agg(F.min("verdict").alias("verdict"))
    if component is not None:
        component = component.select(F.col("node").alias("c_node"), "component")
        placed = said.join(component, F.col("node") == F.col("c_node"), "left").select(F.coalesce("component", "node").alias("group"), "verdict")
        decided = placed.groupBy("group").agg(F.min("verdict").alias("verdict"))
        members = component.join(decided, F.col("component") == F.col("group")).select(F.col("c_node").alias("node"), "verdict")
        alone = said.join(component, F.col("node") == F.col("c_node"), "left_anti").select("node", "verdict")
        said = members.union(alone)
    aliases = stored(said, "alias-verdicts").select(F.col("node").alias("a_node"), F.col("verdict").alias("alias_verdict"))
    joined = rows.join(aliases, F.col("node") == F.col("a_node"), "left")
    return joined.select(
        "page_id",
        "host",
        "path",
        F.col("fit.rule").alias("rule"),
        F.coalesce("fit.verdict", "alias_verdict", F.lit("allow")).alias("verdict"),
        (F.col("fit").isNull() & F.col("alias_verdict").isNotNull()).alias("propagated"),
    )


def drop_blocked(pages: DataFrame, **options: object) -> DataFrame:
    """The rows of ``pages`` that are not blocked, with all their columns; rows that share an id are judged each by its url.

    Takes the options of ``filter_urls``.
    """
    url_col = options.get("url_col", "url")
    keyed = filter_urls(pages, **{**options, "id_col": url_col}).where("verdict = 'block'").select(F.col("page_id").alias("_blocked")).distinct()
    return pages.join(keyed, pages[url_col] == F.col("_blocked"), "left_anti")
