"""URL filters with redirect equivalence.

A rule names a host and the start of a path, and allows or blocks. It fits a URL
whose host is the rule's or below it and whose path starts with the rule's; the
longest rule that fits decides. URLs that no rule fits take the decision of
their aliases: connected components over redirect and canonical-link edges, in
which an explicit allow goes before a block, and a URL without either is
allowed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import connected_components, table

#: (rule, verdict) of the registered query.
RULES = (
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
)
URL_PARTS = r"^(?s:.*?)://([^/?#]*)([^?#]*)(\??[^#]*)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MOST_INLINE_RULES = 500
#: Where tags are text: comments, and elements whose content is none.
UNSEEN = r"(?is)<!--.*?(?:-->|\z)|" + "|".join(rf"<{name}\b.*?(?:</{name}\b|\z)" for name in ("script", "style", "textarea", "title", "template"))


def host(url: Column) -> Column:
    """Text after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(F.translate(F.regexp_extract(url, URL_PARTS, 1), UPPER, LOWER), F.lit(""))


def path(url: Column) -> Column:
    """Text after the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, URL_PARTS, 2), F.lit(""))


def node(url: Column) -> Column:
    """What a URL is called among aliases: host, path and query; null if it has no host."""
    name = F.concat(host(url), path(url), F.regexp_extract(url, URL_PARTS, 3))
    return F.when(host(url) != "", name)


def inline_rule(host_column: str, path_column: str, rules) -> Column:
    """Struct (rule, verdict) of the longest of a short list of rules, null if none fits."""
    if len(rules) > MOST_INLINE_RULES:
        raise ValueError(f"over {MOST_INLINE_RULES} rules: join them with match_rules()")
    h, p = F.col(host_column), F.col(path_column)
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule, verdict in sorted(rules, key=lambda x: (len(x[0]), x[0])):
        of_host, slash, rest = rule.partition("/")
        fits = ((h == of_host) | h.endswith("." + of_host)) & p.startswith(slash + rest)
        found = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def match_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(url, rule, verdict) of the distinct non-null URLs that a rule fits, for rule tables of any size.

    ``urls`` has url; ``rules`` has rule and verdict. Each URL meets the rules of its
    host's suffixes in one equi-join.
    """
    labels = F.split(F.col("host"), r"\.")
    suffix = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    named = urls.select("url").where("url is not null").distinct().withColumns({"host": host(F.col("url")), "path": path(F.col("url"))})
    parts = rules.select("rule", "verdict", F.substring_index("rule", "/", 1).alias("suffix")).withColumn(
        "start", F.expr("substr(rule, length(suffix) + 1)")
    )
    return (
        named.withColumn("suffix", F.explode(suffix))
        .join(parts, "suffix")
        .where(F.col("path").startswith(F.col("start")))
        .groupBy("url")
        .agg(F.max(F.struct(F.length("rule").alias("n"), "rule", "verdict")).alias("best"))
        .select("url", "best.rule", "best.verdict")
    )


def decoded(reference: Column) -> Column:
    """A reference in an attribute with its usual character references decoded, the ampersand last."""
    for pattern, char in ((r"&(?:quot|#34|#[xX]22);", '"'), (r"&(?:apos|#39|#[xX]27);", "'"), (r"&(?:sol|#47|#[xX]2[fF]);", "/"), (r"&(?:amp|#38|#[xX]26);", "&")):
        reference = F.regexp_replace(reference, pattern, char)
    return reference


def without_dots(name: Column) -> Column:
    """A path without its segments ``.`` and ``..``, and what those take back."""
    part = F.split(name, "/")
    kept = F.aggregate(
        part,
        F.array().cast("array<string>"),
        lambda out, x: F.when(x == "..", F.slice(out, 1, F.greatest(F.size(out) - 1, F.lit(1)))).when(x == ".", out).otherwise(F.array_append(out, x)),
    )
    ends = F.element_at(part, -1).isin(".", "..")
    return F.concat(F.array_join(kept, "/"), F.when(ends, "/").otherwise(""))


def resolved(url: Column, reference: Column) -> Column:
    """The URL that a reference in the page ``url`` means; null if it has another scheme than one with ``://``."""
    scheme = F.regexp_extract(url, r"^((?s:.*?)://)", 1)
    home = F.concat(scheme, host(url))
    folder = F.regexp_extract(path(url), r"^((?s:.*)/)", 1)
    folder = F.when(folder == "", "/").otherwise(folder)
    of_path, rest = F.regexp_extract(reference, r"^([^?#]*)", 1), F.regexp_extract(reference, r"^[^?#]*((?s:.*))$", 1)
    return (
        F.when(reference.startswith("//"), F.concat(F.regexp_replace(scheme, "//$", ""), reference))
        .when(reference.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*://"), reference)
        .when(reference.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), F.lit(None).cast("string"))
        .when(reference.startswith("?"), F.concat(home, path(url), reference))
        .when(reference.startswith("#"), url)
        .otherwise(F.concat(home, without_dots(F.when(of_path.startswith("/"), of_path).otherwise(F.concat(folder, of_path))), rest))
    )


def links(pages: DataFrame) -> DataFrame:
    """Edges (a, b) between the nodes of pages and the targets of all their canonical links and refreshes.

    References are decoded and resolved against the page's URL. Tags in comments and in the text of scripts, styles, titles, templates and
    text fields link nothing.
    """
    html = F.col("html")
    value = r"""(?:"([^"]*)"|'([^']*)'|["']?([^\s"'>]+))"""
    some = pages.where("url is not null and html is not null").where(html.rlike(r"(?i)\b(?:canonical|refresh)\b"))
    # With quotes that do not match, a tag ends at the next >.
    tag = r"""(?is)<(?:link|meta)\b(?:(?:[^>"']++|"[^"]*+"|'[^']*+'){0,500}+>|[^>]*+>)"""
    tags = some.select("url", F.explode(F.array_distinct(F.regexp_extract_all(F.regexp_replace("html", UNSEEN, " "), F.lit(tag), F.lit(0)))).alias("__tag"))

    def attribute(name: str) -> Column:
        start = rf"(?is)\s{name}\s*=\s*{value}"
        return F.concat(*(F.regexp_extract("__tag", start, i) for i in (1, 2, 3)))

    canonical = F.col("__tag").rlike(r"(?i)^<link") & attribute("rel").rlike(r"(?i)(^|\s)canonical(\s|$)")
    refresh = F.col("__tag").rlike(r"(?i)^<meta") & attribute("http-equiv").rlike(r"(?i)^\s*refresh\s*$")
    content = decoded(attribute("content"))
    after = r"""(?is)^[\s\d.]*[;,\s]\s*(?:url\s*=\s*)?(?:"([^"]*)"?.*|'([^']*)'?.*|([^\s"'].*))$"""
    target = F.trim(F.when(canonical, decoded(attribute("href"))).when(refresh, F.concat(*(F.regexp_extract(content, after, i) for i in (1, 2, 3)))))
    found = tags.select("url", target.alias("__to")).where("__to <> ''")
    return (
        found.select(node(F.col("url")).alias("a"), node(resolved(F.col("url"), F.col("__to"))).alias("b"))
        .where("a is not null and b is not null and a <> b")
        .distinct()
    )


def judge_urls(pages: DataFrame, edges: DataFrame, rules=RULES) -> DataFrame:
    """Adds host, path, rule (null if none fits) and verdict to every row of ``pages``.

    ``edges`` has the columns a and b of node() names. Null URLs and URLs without ``://`` have an
    empty host and path, fit no rule and are allowed. Rows are never dropped, and repeated URLs
    get the same verdict; without edges a URL that no rule fits is allowed. URLs may be of any length; of rules of one length that fit
    the last by name counts; an empty table stays empty. Columns of ``pages`` that have
    the added names are replaced.
    """
    pages = pages.drop("host", "path", "rule", "verdict")
    judged = (
        pages.withColumns({"host": host(F.col("url")), "path": path(F.col("url"))})
        .withColumn("__rule", inline_rule("host", "path", rules))
        .withColumn("rule", F.col("__rule.rule"))
    )
    members = connected_components(edges)
    named = members.withColumns({"__url": F.concat(F.lit("x://"), "node")})
    named = named.withColumns({"host": host(F.col("__url")), "path": path(F.col("__url"))})
    own = inline_rule("host", "path", rules)["verdict"]
    votes = named.groupBy("component").agg(
        F.max((own == "allow").cast("int")).alias("allows"), F.max((own == "block").cast("int")).alias("blocks")
    )
    blocked = votes.where("blocks = 1 and coalesce(allows, 0) = 0").select("component")
    aliases = members.join(blocked, "component", "left_semi").select(F.col("node").alias("__node"), F.lit("block").alias("__alias"))
    return (
        judged.withColumn("__node", F.when(F.col("rule").isNull(), node(F.col("url"))))
        .join(aliases, "__node", "left")
        .withColumn("verdict", F.coalesce("__rule.verdict", "__alias", F.lit("allow")))
        .select(*pages.columns, "host", "path", "rule", "verdict")
    )


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, host, path, rule and verdict of every page, whose aliases are those of its canonical links and refreshes.

    URLs of any length are read whole; null and odd ones fit no rule and have no alias.
    """
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return judge_urls(pages.drop("html"), links(pages)).select("page_id", "host", "path", "rule", "verdict")
