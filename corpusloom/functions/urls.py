"""Identity of pages by their URLs, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Query or path parts that mark an article page.
ARTICLE_MARKS = ["id=kb_article", "id=kb_article_view", "sys_kb_id="]


def kb_id(url: Column) -> Column:
    """The article key in a URL, its case kept: `sys_kb_id=` before `sysparm_article=KB...`; null without one."""
    first = F.nullif(F.regexp_extract(url, r"(?i)sys_kb_id=([a-f0-9]+)", 1), F.lit(""))
    return F.coalesce(first, F.nullif(F.regexp_extract(url, r"(?i)sysparm_article=(KB[0-9]+)", 1), F.lit("")))


def normalized_url(url: Column) -> Column:
    """`sys_kb_id:<key>` where there is a key, else the URL without closing slashes and fragment (slashes go first)."""
    plain = F.substring_index(F.regexp_replace(url, "/+$", ""), "#", 1)
    return F.coalesce(F.concat(F.lit("sys_kb_id:"), kb_id(url)), plain)


def denormalized_url(normal: Column, base: str = "https://kb.example/kb?id=kb_article_view&sys_kb_id=") -> Column:
    """A page's URL from its normalized form."""
    return F.when(normal.startswith("sys_kb_id:"), F.concat(F.lit(base), F.regexp_replace(normal, "^sys_kb_id:", ""))).otherwise(normal)


def is_article_link(url: Column, domain: str = ".example") -> Column:
    """True for URLs of the domain whose query or path has an article mark; false for malformed or null ones."""
    host, query, path = (F.try_parse_url(url, F.lit(p)) for p in ("HOST", "QUERY", "PATH"))
    where = F.concat_ws(" ", F.lower(query), F.lower(path))
    marked = F.lit(False)
    for m in ARTICLE_MARKS:
        marked = marked | where.contains(m)
    return F.coalesce(host.contains(domain), F.lit(False)) & marked
