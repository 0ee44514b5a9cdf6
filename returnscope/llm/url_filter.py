"""URL rules that follow redirects and canonical links. DataFrame functions only.

1. A rule is a host and a path prefix that block or allow; it fits the host and its subdomains. The
   longest fitting rule judges a url. Rules are a parameter and become one expression.
2. Pages name aliases of themselves: a canonical link, or a redirect by refresh. Urls linked so are
   equivalent; equivalence classes are the connected components of those links.
3. A url without a fitting rule takes the decision of its class: blocked when a member is blocked,
   unless a member is allowed explicitly: allow takes precedence. Without either it is allowed.

Urls are the same node when equal after dropping the fragment and lower-casing scheme and host; an empty
path is ``/``. Aliases are resolved as browsers do: against the page's url, or its <base> if it has one,
with ``.`` and ``..`` taken out of the path, spaces escaped and references of usual marks decoded.

Cases: a null url, or one without ``://``, has empty host and path, fits no rule, belongs to no class
and is allowed. Null html names no alias. Repeated pages each get a row. Empty tables and empty rule
lists work. Aliases of a page without ``://``, and those of schemes without it (mailto:), are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from returnscope.llm.common import ascii_lower
from returnscope.llm.components import components
from returnscope.sources.tables import stage

Rule = tuple[str, str, str]  # verdict, host, path
LINK = r"(?is)<link\b[^>]*\brel\s*=\s*[\"']?canonical\b[^>]*>"
REFRESH = r"(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b[^>]*>"
BASE = r"(?is)<base\b[^>]*>"
VALUE = r"(?is)(?<![\w-]){}\s*=\s*(?:\"([^\"]*)|'([^']*)|([^\s\"'>]+))"
TARGET = r"(?is)^\s*(?:[0-9][0-9.]*\s*[;,\s]\s*(?:url\s*=)?|[;,\s]*url\s*=)\s*(.*)$"
BARE = r"(?s)^(?:\"([^\"]*)|'([^']*)|(.*))"
# Character references that urls are written with; & last, so that nothing is decoded twice.
REFERENCES = {"/": "#0*47|#x0*2f|sol", ":": "#0*58|#x0*3a|colon", "=": "#0*61|#x0*3d|equals", "?": "#0*63|#x0*3f|quest", "'": "#0*39|#x0*27|apos", '"': "#0*34|#x0*22|quot", "&": "#0*38|#x0*26|amp"}


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def node_of(url: Column) -> Column:
    """A url as a node of the alias graph; null without ``://``."""
    scheme = F.lower(F.regexp_extract(url, r"(?s)^(.*?)://", 1))
    rest = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^#]*)", 1)
    return F.when(F.instr(url, "://") > 0, F.concat(scheme, F.lit("://"), host_of(url), F.when(F.startswith(rest, F.lit("/")), rest).otherwise(F.concat(F.lit("/"), rest))))


def _groups(text: Column, pattern: str) -> Column:
    """The one of three groups that has matched."""
    return F.concat(*[F.regexp_extract(text, pattern, i) for i in (1, 2, 3)])


def _attribute(tag: Column, name: str) -> Column:
    value = _groups(tag, VALUE.format(name))
    for mark, names in REFERENCES.items():
        value = F.regexp_replace(value, f"(?i)&(?:{names});", mark)
    return value


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is worked out once; repeating it would multiply nested expressions."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _plain(path: Column) -> Column:
    """A path without ``.`` and ``..``."""
    parts = F.split(path, "/")
    left = F.aggregate(
        parts,
        F.array().cast("array<string>"),
        lambda done, x: F.when(x == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(1)))).when(x == ".", done).otherwise(F.concat(done, F.array(x))),
    )
    ends = F.when(F.element_at(parts, -1).isin(".", ".."), F.lit("/")).otherwise(F.lit(""))
    return F.when(F.rlike(path, F.lit(r"/\.\.?(?:/|$)")), F.concat(F.array_join(left, "/"), ends)).otherwise(path)


def _joined(target: Column, base: Column) -> Column:
    scheme, path = F.regexp_extract(base, r"(?s)^(.*?)://", 1), path_of(base)
    root = F.concat(scheme, F.lit("://"), host_of(base))
    folder = F.regexp_extract(path, r"(?s)^(.*/)", 1)
    return (
        F.when(target == "", base)
        .when(F.rlike(target, F.lit(r"^[A-Za-z][A-Za-z0-9+.\-]*:")), target)
        .when(F.startswith(target, F.lit("//")), F.concat(scheme, F.lit(":"), target))
        .when(F.startswith(target, F.lit("/")), F.concat(root, target))
        .when(F.startswith(target, F.lit("#")), F.concat(F.regexp_extract(base, r"(?s)^([^#]*)", 1), target))
        .when(F.startswith(target, F.lit("?")), F.concat(root, F.when(path == "", "/").otherwise(path), target))
        .otherwise(F.concat(root, F.when(folder == "", "/").otherwise(folder), target))
    )


def _tidied(full: Column) -> Column:
    head, rest = F.regexp_extract(full, r"(?s)^(.*?://[^/?#]*)", 1), F.regexp_extract(full, r"(?s)^.*?://[^/?#]*[^?#]*(.*)$", 1)
    return F.when(F.rlike(full, F.lit(r"^[A-Za-z][A-Za-z0-9+.\-]*://")), F.concat(head, _let(path_of(full), _plain), rest))


def resolved(target: Column, base: Column) -> Column:
    """A reference as it is written on a page with the url ``base``, as a full url; null without ``://``."""
    target = F.replace(F.trim(F.regexp_replace(target, r"[\t\r\n]", "")), F.lit(" "), F.lit("%20"))
    return _let(target, lambda t: _let(base, lambda b: _let(_joined(t, b), _tidied)))


def judged(urls: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Adds ``rule`` and ``rule_verdict`` of the longest fitting rule to rows with ``host`` and ``path``."""
    if not rules:
        return urls.withColumn("rule", F.lit(None).cast("string")).withColumn("rule_verdict", F.lit(None).cast("string"))
    best = None
    for verdict, host, path in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1], r[2], r[0])):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        value = F.struct(F.lit(host + path).alias("rule"), F.lit(verdict).alias("verdict"))
        best = F.when(fits, value) if best is None else best.when(fits, value)
    return urls.withColumn("_best", best).withColumn("rule", F.col("_best.rule")).withColumn("rule_verdict", F.col("_best.verdict")).drop("_best")


def alias_links(pages: DataFrame, url_column: str = "url", html_column: str = "html") -> DataFrame:
    """``a, b``: a page's node and the node of each alias it names."""
    url, html = F.col(url_column), F.col(html_column)
    # Most pages name none; a plain search is far cheaper than the patterns.
    lower = F.lower(html)
    may = F.contains(lower, F.lit("canonical")) | F.contains(lower, F.lit("refresh"))
    canonical = F.transform(F.regexp_extract_all(html, F.lit(LINK), F.lit(0)), lambda t: _attribute(t, "href"))
    refresh = F.transform(
        F.regexp_extract_all(html, F.lit(REFRESH), F.lit(0)), lambda t: _groups(F.regexp_extract(_attribute(t, "content"), TARGET, 1), BARE)
    )
    bases = F.filter(F.transform(F.regexp_extract_all(html, F.lit(BASE), F.lit(0)), lambda t: _attribute(t, "href")), lambda t: t != "")
    named = pages.filter(may).select(url.alias("u"), F.get(bases, F.lit(0)).alias("base"), F.explode(F.concat(canonical, refresh)).alias("t"))
    named = named.filter("trim(t) != ''").withColumn("base", F.when(F.col("base").isNull(), F.col("u")).otherwise(resolved(F.col("base"), F.col("u"))))
    full = resolved(F.col("t"), F.coalesce("base", "u"))
    return named.select(node_of(F.col("u")).alias("a"), _let(full, node_of).alias("b")).filter("a != b")


def verdicts(
    pages: DataFrame, rules: Sequence[Rule], redirects: DataFrame | None = None,
    id_column: str = "page_id", url_column: str = "url", html_column: str = "html",
) -> DataFrame:
    """``id, host, path, rule, verdict, class_url`` for every page.

    ``redirects`` adds observed redirects as url columns ``a`` and ``b``. ``class_url`` is the
    smallest url of the page's class, null for a page without aliases.
    """
    url = F.col(url_column)
    rows = pages.select(F.col(id_column).alias("id"), host_of(url).alias("host"), path_of(url).alias("path"), node_of(url).alias("node"))
    rows = judged(rows, rules)
    links = alias_links(pages, url_column, html_column)
    if redirects is not None:
        links = links.unionByName(redirects.select(node_of(F.col("a")).alias("a"), node_of(F.col("b")).alias("b")))
    links = stage(links.distinct(), "aliases")
    default = F.lit("allow")
    if links.isEmpty():
        return rows.select("id", "host", "path", "rule", F.coalesce("rule_verdict", default).alias("verdict"), F.lit(None).cast("string").alias("class_url"))
    found = stage(components(links, "a", "b"), "classes")
    members = judged(found.select("node", "component", host_of(F.col("node")).alias("host"), path_of(F.col("node")).alias("path")), rules)
    decided = members.groupBy("component").agg(
        F.max(F.col("rule_verdict") == "allow").alias("allowed"), F.max(F.col("rule_verdict") == "block").alias("blocked")
    )
    spread = found.join(decided, "component").select(
        "node", "component", F.when(F.col("allowed"), "allow").when(F.col("blocked"), "block").alias("class_verdict")
    )
    return rows.join(spread, "node", "left").select(
        "id", "host", "path", "rule", F.coalesce("rule_verdict", "class_verdict", default).alias("verdict"), F.col("component").alias("class_url")
    )
