"""URL filter that follows redirects.

Rules name a host and the start of a path. Pages are linked to the addresses
they name as canonical and to those they redirect to, and an address is linked
to its plain form (without scheme, ``www.``, fragment, tracking parameters or a
closing slash), to which servers redirect. Connected components over these
links are the aliases of a page. A page's own rule comes first, so an explicit
allow stands; a page without a rule is blocked if one of its aliases is blocked
by a rule.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.components import connected_components
from strata.llm.tables import sized, written


@dataclass(frozen=True)
class Rule:
    verdict: str  # allow or block
    text: str  # host and the start of a path, such as org/ or example.org/es/

    @property
    def host(self) -> str:
        return self.text.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.text.partition("/")[2]


RULES = (
    Rule("allow", "org/"),
    Rule("block", "example.org/es/"),
    Rule("block", "example.org/en/1"),
    Rule("allow", "com/fr/"),
    Rule("block", "com/de/"),
)

_TAG = r"(?is)<(?:link|meta)\b[^>]*>"
_CANONICAL = r"(?is)\brel\s*=\s*[\"']?canonical\b"
_HREF = r"(?is)\bhref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))"
_REFRESH = r"(?is)\bhttp-equiv\s*=\s*[\"']?refresh\b"
#: In the value of content: in quotes of its own, or up to the end of the value, whose quotes may be left out.
_TARGET = r"(?is)\burl\s*=\s*(?:\"([^\"]*)|'([^']*)|([^'\"\s>]+))"
_TRACKING = r"(?:utm_[a-z]+|ref|fbclid|gclid)=[^&#]*"


def _ascii_lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lowered; empty without ``://`` or for null."""
    return F.coalesce(_ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """The longest rule that fits; of rules of one length the first given."""
    found = F.lit(None).cast("string")
    for r in sorted(reversed(rules), key=lambda r: len(r.text)):
        fits = ((host == r.host) | host.endswith(f".{r.host}")) & path.startswith(r.path)
        found = F.when(fits, F.lit(r.text)).otherwise(found)
    return found


def verdict_of(rule: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    verdict = F.lit(None).cast("string")
    for r in rules:
        verdict = F.when(rule == r.text, F.lit(r.verdict)).otherwise(verdict)
    return verdict


def plain(url: Column) -> Column:
    """The form that servers redirect to: what two spellings of an address have in common. Null without ``://``."""
    rest = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*(.*)$", 1)
    rest = F.regexp_replace(rest, r"(?s)#.*$", "")
    rest = F.regexp_replace(rest, rf"(?<=[?&]){_TRACKING}(?:&|$)", "")
    rest = F.regexp_replace(rest, r"[?&]$", "")
    rest = F.regexp_replace(rest, r"/(\?|$)", "$1")
    return F.when(url.contains("://"), F.concat(F.regexp_replace(host_of(url), r"^www\.", ""), rest))


def resolve(url: str | None, target: str | None) -> str | None:
    """The address that a link on the page at ``url`` names: character references decoded, relative to the page.

    Null for links within the page, for other schemes than the web's and for
    what is no address.
    """
    target = html.unescape(target or "").strip()
    if not target or target.startswith("#") or url is None:
        return None
    try:
        found = urljoin(url, target)
    except ValueError:  # such as an unclosed bracket in a host
        return None
    return found if re.match("(?i)https?://[^/?#]", found) else None


@F.pandas_udf(T.StringType())
def _resolved(url: pd.Series, target: pd.Series) -> pd.Series:
    return pd.Series([resolve(u, t) for u, t in zip(url, target, strict=True)], dtype=object)


def alias_links(pages: DataFrame) -> DataFrame:
    """``url, target``: canonical links and redirects that pages state, relative ones resolved."""
    tags = F.explode(F.regexp_extract_all("html", F.lit(_TAG), F.lit(0)))
    rows = pages.where("url is not null and html is not null").select("url", tags.alias("tag"))
    tag = F.col("tag")
    href = F.concat(*(F.regexp_extract(tag, _HREF, k) for k in (1, 2, 3)))
    refresh = F.concat(*(F.regexp_extract(tag, _TARGET, k) for k in (1, 2, 3)))
    target = F.when(tag.rlike(_CANONICAL), href).when(tag.rlike(_REFRESH), refresh)
    stated = rows.select("url", target.alias("target")).where("target is not null and target != ''")
    return stated.select("url", _resolved("url", "target").alias("target")).where("target is not null")


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES, redirects: DataFrame | None = None) -> DataFrame:
    """``page_id, host, path, rule, verdict`` for every row of ``pages``.

    ``redirects(url, target)``, such as a crawler's log of redirects, adds links
    between addresses to those that the pages state; rows with a null are
    ignored. A url that is null or has no ``://`` has no host, path, rule or aliases
    and is allowed. Repeated rows are judged alike. Columns other than
    ``page_id, url, html`` are not read.
    """
    url = F.col("url")
    rows = pages.select("page_id", "url", "html")
    judged = rows.select(
        "page_id", host_of(url).alias("host"), path_of(url).alias("path"), rule_of(host_of(url), path_of(url), rules).alias("rule"), plain(url).alias("node")
    )
    links = alias_links(rows)
    if redirects is not None:
        links = links.unionByName(redirects.select("url", "target").where("url is not null and target is not null"))
    links = written(links, "alias-links")
    ends = [links.select(F.col(c).alias("url")) for c in ("url", "target")]
    edges = links.select(plain(F.col("url")).alias("a"), plain(F.col("target")).alias("b"))
    component = written(connected_components(edges), "aliases")

    # Addresses that a rule blocks, pages or only named by pages; their components are blocked.
    named = rows.select("url").unionByName(ends[0]).unionByName(ends[1]).where("url is not null")
    blocked = named.where(verdict_of(rule_of(host_of(url), path_of(url), rules), rules) == "block").select(plain(url).alias("node")).distinct()
    blocked = blocked.join(component, "node", "left").select(F.coalesce("component", "node").alias("component")).distinct()
    blocked = written(blocked.withColumn("bad", F.lit(True)), "blocked-aliases")
    own = verdict_of(F.col("rule"), rules)
    return (
        judged.join(sized(component), "node", "left")
        .withColumn("component", F.when(F.col("rule").isNull(), F.coalesce("component", "node")))
        .join(sized(blocked), "component", "left")
        .select("page_id", "host", "path", "rule", F.coalesce(own, F.when(F.col("bad"), "block"), F.lit("allow")).alias("verdict"))
    )
