"""Problem 5: template residue, filler and error-page text in titles and contents.

Units are titles and content lines. Numbers, addresses and dates in a unit are masked, and units are grouped by the
exact hash of their masked text across sources (hosts). Each group that recurs is classified once, by what its pages
have besides it and by phrase rules. A page is bare if all of its sentences recur over many sources. A group is

* filler, if it reads wholly as such and most of its pages are bare;
* furniture, if less than BARE of its pages are bare (cookie notices stand on pages with an article);
* a message, if nearly all of them are and a phrase rule speaks for it, or if it stands under many titles, on very many
  sources, on pages of two or three sentences: then no wording is needed;
* an explanation, if nearly all of its pages are bare and it stands under many titles;
* else a copy: text of an article that is republished.

A content is a case if it holds filler, or if it holds a message and each of its sentences is a message, an explanation or furniture.
A title is one if its group is a message or filler in contents, or recurs and a phrase rule speaks for it. No wording counts by
itself: without recurrence there is no message. Placeholders, pseudo-Latin and crawler markers need none; rules find
them in the unit, outside quotations and page trails.

Defined cases: null, empty and `Pending` are never cases; an empty table gives no rows; the source of a null url is
empty; repeated rows are judged alike; extra columns are ignored; texts are read whole, whatever their length.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.session import broadcast_if_small, ship_package, written

#: A group recurs on so many sources; one that reads wholly as a message on SURE; one without such wording on PLAIN.
RECURS, SURE, PLAIN = 5, 3, 10
#: Share of bare pages from which a group stands in place of the article.
BARE = 0.8
#: Sentences of a page on which a group without wording is a message, at most, on the average.
SHORT_PAGE = 3

#: Bits of a unit's flags.
PLAIN, STRONG, PREV, NEXT = range(4)

#: Wording of a whole unit that is filler.
FILLER = (
    r"^(?:(?:insert|enter|add|your) (?:\w+ )?(?:title|name|text)|(?:\w+ ){1,3}goes here\.?|untitled(?: \w+)?|new page|test test|(?:tbd\W*){2,}|(?:x{3,}\W*)+|content coming soon|lorem ipsum"
    r"|placeholder (?:copy|text)\b.*|(?:write|add|put|insert|enter) .{2,40}\b(?:here|in this place)\.?|((?:\w+ ){0,2}\w+)(?:[. ]+\1)+(?: \w+)?\.?)$"
)
#: Wording of a whole unit that is a message.
SURELY = (
    r"^(?:(?:http )?(?:error|status|fehler|erreur)?:? ?0|(?:(?:http )?(?:error |status )?0 )?(?:not found|internal server error|service (?:temporarily )?unavailable|forbidden|bad request|bad gateway|gateway time-?out|unauthorized)"
    r"|(?:page|seite|file|site|record|document|article)s? (?:was )?(?:not found|nicht gefunden|introuvable|no encontrad[ao])|(?:this |the |that )?(?:page|record|article|document|file)? ?(?:does not exist|no longer (?:available|exists))\.?"
    r"|(?:access|permission) denied|zugriff verweigert|accès refusé|acceso denegado|(?:proxy|server|database|connection|internal|unexpected|unknown) (?:error|connection failed|connection error)|error (?:inesperado|interno)"
    r"|too many requests|(?:your |the )?session (?:has )?expired|just a moment\W*|something went wrong\W*|we (?:can't|can’t|cannot|could not) find (?:that|this|the) page|(?:oops\W* )?this link is broken"
    r"|(?:the |this )?(?:site|server|service) (?:is )?(?:under|down for) maintenance|undefined|null|nan|\[object object\]|loading\W*"
    r"|(?:please |you (?:need|have) to )?(?:enable|turn on|activate|allow) (?:java)?script(?:s|ing)?\b(?: [\w,]+){0,8}\.?|your browser (?:does not|doesn't|can't|cannot) (?:support|run) (?:java)?script(?:s|ing)?\b(?: [\w,]+){0,8}\.?|(?:java)?scripts? (?:is|are) (?:required|needed|disabled|switched off)\b(?: [\w,]+){0,6}\.?)$"
)
#: Wording that speaks for a message or filler in a unit.
MAYBE = (
    r"\b(?:error|fehler|erreur|denied|expired|unavailable|forbidden|unauthorized|time[ds]? ?out|not found|nicht gefunden|introuvable|captcha|not a robot|bad request|try again|(?:un|not )?available|maintenance|went wrong)\b"
    r"|(?:enable|turn|activ|aktiv|requir|need|support|switch|loads|erlaub)\w*\b.{0,60}\b(?:java)?scripts?\b|(?:java)?scripts?\b.{0,60}\b(?:enable|turn|activ|aktiv|requir|need|support|switch|loads)\w*"
    r"|\b(?:verify|prove|confirm|checking)\b.{0,30}\b(?:human|browser|robot)\b|^(?:request|reference:?|incident id|code) 0$"
)
# Words of pseudo-Latin filler.
LATIN = (
    "lorem ipsum dolor sit amet dorem valum sedo sitra irura labor tador enima ullam tempra nostru sunto proiden pariat offic cupid culpa incid conseq "
    "mollit ametis animo commo minis quisto fugia occae exerci aliqua velita elis eius nisi except duisa sintor venar auter repreh deser magnu nulla"
).split()

_ID = r"[A-Za-z][\w.-]*(?: [\w.-]+){0,2}"
#: A placeholder: `{{x}} ${x} {% x %} {$x} %%x%% [[x]] [Insert x here] [YOUR x] <%= x %> <<x>> #{x} @@x@@ &lt;x&gt; {0} __x__ $x$ XX_x_XX`.
PLACEHOLDER = (
    rf"(?i)(?:\{{\{{\s*{_ID}\s*\}}\}}|[$#]\{{\s*{_ID}\s*\}}|\{{%\s*{_ID}\s*%\}}|\{{\$\s*{_ID}\s*\}}|%%{_ID}%%|\[\[\s*{_ID}\s*\]\]|\[insert\s+{_ID}\s+here\]|(?-i:\[(?:YOUR|ENTER|INSERT|ADD)(?:[ _][A-Z]+)+\])"
    rf"|<%=\s*{_ID}\s*%>|<<\s*{_ID}\s*>>|@@{_ID}@@|&lt;\s*{_ID}\s*&gt;|(?<![\w$}}])\{{\d{{1,2}}\}}(?!\}})"
    r"|(?<![\w.])__(?!(?:init|main|name|file|all|doc|dict|class|str|repr|call)__|(?-i:[A-Z][a-z]+__))[A-Za-z][\w.]*[A-Za-z]__(?![\w(]|\.\w)|(?<![\w$])\$[A-Za-z][\w.]{2,}\$|XX_[A-Za-z][\w.]*_XX)"
)
#: What is cut before looking for one: a tag or variable that the text explains, environment variables and command templates.
QUOTED = (
    rf"(?i)(?:\b(?:tags?|tag\s+such\s+as|tags\s+such\s+as|such\s+as|placeholders?|patterns?|variables?|marks?|fields?\s+like)\s+(?:\[[^\]]*\]|\{{\{{\s*{_ID}\s*\}}\}}|[$#]\{{\s*{_ID}\s*\}}|\{{%[^%]*%\}}|%%{_ID}%%|\[\[\s*{_ID}\s*\]\])"
    rf"|\$?\$\{{\{{?(?:HOME|PATH|USER|SHELL|TMPDIR|LANG|PWD)\}}\}}?|\{{?\{{%\s*\w+\s+\w[^%]*%\}}\}}?)"
)
#: A page trail ("Labs > Printing > title"), which repeats the title.
TRAIL = r"^\s*[^>»:/.]{1,24}\s(?:>|»|::|/)\s[^>»:/.]{1,24}\s(?:>|»|::|/)\s"
MARKER = r"^\s*\[(?:MINIMAL CONTENT|BROKEN ARTICLE):"
#: How a placeholder or a marker begins.
SIGNS = r"(?i)\{[{%$\d]|[$#]\{|%%|\[(?:\[|insert|your|enter|add|minimal|broken)|<[%<]|@@|&lt;|__|\$[a-z]|xx_"
#: A site's name, or a status number, behind a message in a title.
SUFFIX = r"(?: ?\(\d+\)| [|–—-](?: \p{Lu}\S*){1,5})$"


def squeezed(c: Column) -> Column:
    """White space of any kind as single blanks, none outside."""
    return F.trim(F.regexp_replace(c, r"[\s\x{a0}]+", " "))


def _numbered(c: Column) -> Column:
    c = F.when(c.contains("@") | c.contains("://"), F.regexp_replace(c, r"https?://\S+|\S+@\S+\.\w+", "@")).otherwise(c)
    return F.regexp_replace(c, r"\d+", "0")


def _coded(c: Column) -> Column:
    coded = F.substring_index(c, " ", 1).isin("request", "reference:", "reference", "incident", "code")
    return F.when(coded & c.rlike(r"^(?:request|reference:?|incident id|code) [0-9a-f]+$"), "code 0").otherwise(c)


def masked(c: Column) -> Column:
    """Lower-cased, with numbers, dates, addresses and ids masked."""
    return _coded(_numbered(F.lower(F.trim(c))))


def with_mask(units: DataFrame) -> DataFrame:
    """`units` with `m`, the masked() `text`; each step is a column, as Spark makes a nested one anew wherever it is named."""
    return units.withColumn("m", F.lower(F.trim("text"))).withColumn("m", _numbered(F.col("m"))).withColumn("m", _coded(F.col("m")))


def is_sentence(text: Column) -> Column:
    """Reads as a sentence, a step or a list item: five words or more and a closing mark, but no question (titles end in those)."""
    t = F.rtrim(text)
    closed = reduce(lambda c, x: c | t.endswith(x), "!:…", t.endswith("."))
    # four blanks: something is behind the fourth
    return closed & (F.substring_index(t, " ", 4) != t)


def has_placeholder(c: Column) -> Column:
    return F.regexp_replace(c, QUOTED, " ").rlike(PLACEHOLDER)


def is_latin(m: Column) -> Column:
    """Begins with pseudo-Latin filler, and at least half of its words, and two, are such."""
    # counted by patterns, as a lambda would take the whole step out of generated code
    words = F.regexp_count(m, F.lit(r"\p{L}+"))
    latin = F.regexp_count(m, F.lit(rf"(?<!\p{{L}})(?:{'|'.join(LATIN)})(?!\p{{L}})"))
    # the test of the first word keeps the others from most lines
    return F.when(F.substring_index(m, " ", 1).isin(LATIN), (latin >= 2) & (latin * 2 >= words)).otherwise(False)


def by_rule(text: Column, m: Column) -> Column:
    """A marker, placeholder or pseudo-Latin: a case wherever it stands. The cheap tests go first."""
    # one of these signs, and one of SIGNS, stands in every marker and placeholder
    signed = text.rlike(r"[\[{$<_%@&]") & text.rlike(SIGNS)
    return F.when(~signed, is_latin(m)).when(text.rlike(MARKER), True).when(has_placeholder(squeezed(text)), ~text.rlike(TRAIL)).otherwise(is_latin(m))


def wording(m: Column) -> Column:
    """3 for a masked unit that reads wholly as filler, 2 as a message, 1 for one with such wording, else 0."""
    return F.when(m.rlike(FILLER), 3).when(m.rlike(SURELY), 2).when(m.rlike(MAYBE), 1).otherwise(0)


def _lines(articles: DataFrame, *columns: Column) -> tuple[DataFrame, DataFrame]:
    """(id, field, the columns given, at, text) of each title, without the site's name, and of each line of each content, counted from 0."""
    title = F.col("text")
    # one of these stands in every suffix
    marked = reduce(lambda c, x: c | title.contains(x), (" |", " –", " —", " -"), title.contains(")"))
    stripped = F.when(marked, reduce(lambda c, _: F.regexp_replace(c, SUFFIX, ""), range(2), title)).otherwise(title)
    titles = articles.where("title is not null and trim(title) <> '' and title <> 'Pending'").select("id", F.lit("title").alias("field"), *columns, F.lit(0).alias("at"), squeezed(F.col("title")).alias("text"))
    titles = titles.withColumn("text", stripped)
    # the columns are made of the record, not of each of its lines; split() stays within posexplode(), else Spark tests its size by splitting again
    lines = articles.where("content is not null and content <> ''").select("id", F.lit("content").alias("field"), *columns, "content")
    lines = lines.select(*lines.columns[:-1], F.posexplode(F.split("content", "\n")).alias("at", "text"))
    return titles, lines


def flag(bit: int) -> Column:
    """0 or 1: one of PLAIN, STRONG, PREV and NEXT in the `flags` of text_units()."""
    return F.shiftright("flags", bit).bitwiseAND(1)


def _beside(lines: DataFrame) -> DataFrame:
    """`lines` with PREV and NEXT in their flags; the lines of a text follow one another, at 0 a text begins."""
    ship_package(lines.sparkSession)

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.RecordBatch | None = None  # the last row, as the row after it isn't known yet
        before = 0
        for part in batches:
            if not part.num_rows:
                continue
            rows = part if held is None else pa.concat_batches([held, part])
            flags, first = rows.column("flags").to_numpy(), rows.column("at").to_numpy() == 0
            plain = flags & 1
            prev = np.where(first, 0, np.concatenate([[before], plain[:-1]]))
            after = np.append(np.where(first[1:], 0, plain[1:]), 0)
            made = (flags | (prev << PREV) | (after << NEXT)).astype(np.int32)
            yield rows.set_column(rows.schema.get_field_index("flags"), "flags", pa.array(made)).slice(0, rows.num_rows - 1)
            held = rows.slice(rows.num_rows - 1)
            # the row before the one that is held
            before = plain[-2] if len(plain) > 1 else before
        if held is not None:
            prev = 0 if held.column("at")[0].as_py() == 0 else int(before)
            made = pa.array([held.column("flags")[0].as_py() | prev << PREV], pa.int32())
            yield held.set_column(held.schema.get_field_index("flags"), "flags", made)

    return lines.mapInArrow(go, ", ".join(f"{name} {kind}" for name, kind in lines.dtypes))


def text_units(articles: DataFrame) -> DataFrame:
    """(id, source, title, at, h, flags, field) of each title and line of content, with hashes of the source, the title and the unit.

    Flags: PLAIN, it reads as a sentence; STRONG, it is a case by rule; PREV and NEXT, the line before or after it is PLAIN.
    Lines are judged where they are read: there is no shuffle.
    """
    host = F.lower(F.coalesce(F.regexp_extract("url", "^[a-zA-Z]+://([^/?#]+)", 1), F.lit("")))
    keys = ["id", "source", "title", "at"]
    strong = by_rule(F.col("text"), F.col("m")).cast("int").alias("strong")

    titles, lines = _lines(articles, F.xxhash64(host).alias("source"), F.xxhash64(F.lower(F.coalesce("title", F.lit("")))).alias("title"))
    titles = with_mask(titles.select(*keys, "text")).select(*keys, F.xxhash64("m").alias("h"), F.shiftleft(strong, STRONG).alias("flags"))
    lines = with_mask(lines.select(*keys, "text")).select(*keys, "text", F.xxhash64("m").alias("h"), strong)
    flags = F.when(F.col("strong") == 1, 1 << STRONG).when(is_sentence(F.col("text")), (~F.col("text").rlike(TRAIL)).cast("int")).otherwise(0)
    lines = _beside(lines.select(*keys, "h", flags.alias("flags")))
    return titles.withColumn("field", F.lit("title")).unionByName(lines.withColumn("field", F.lit("content")))


def recurring(units: DataFrame) -> DataFrame:
    """(h, sources, titles, id) of the groups of `units` (h, source, title, id) that stand on SURE sources or more.

    Titles are counted one a source; `id` is a record that holds one of the units.
    """
    per_source = units.groupBy("h", "source").agg(F.min("title").alias("title"), F.min("id").alias("id"))
    # one shuffle for the titles and the groups; a group has a row for each source here
    per_source = per_source.repartition("h")
    by = per_source.groupBy("h").agg(F.count("*").alias("sources"), F.countDistinct("title").alias("titles"), F.min("id").alias("id"))
    return by.where(F.col("sources") >= SURE)


def worded(articles: DataFrame, groups: DataFrame) -> DataFrame:
    """(h, sources, titles, wording) of `groups`, read in one record each; those on fewer than RECURS sources only if they read wholly as a message."""
    titles, lines = _lines(articles.join(groups.select("id").distinct(), "id", "left_semi"))
    units = with_mask(titles.unionByName(lines).select("id", "text")).select("id", "m", F.xxhash64("m").alias("h"))
    both = units.join(groups, ["id", "h"]).groupBy("h", "sources", "titles").agg(F.min("m").alias("m"))
    return both.select("h", "sources", "titles", wording(F.col("m")).alias("wording")).where((F.col("sources") >= RECURS) | (F.col("wording") >= 2))


def grouped(pages: DataFrame, groups: DataFrame) -> DataFrame:
    """(h, kind) of `groups` (h, sources, titles, wording) by their `pages` (id, bare, sentences, hits): filler, message, explanation, furniture or copy."""
    hits = pages.select("bare", "sentences", F.explode("hits").alias("hit")).select("bare", "sentences", "hit.h")
    by = hits.groupBy("h").agg(F.avg("bare").alias("share"), F.avg(F.when(F.col("bare") == 1, F.col("sentences"))).alias("length")).join(groups, "h")
    by = by.withColumnRenamed("wording", "w")
    stands = F.col("share") >= BARE
    many = F.col("titles") >= RECURS
    kind = (
        F.when((F.col("w") == 3) & (F.col("share") >= 0.5), "filler")
        .when(~stands, "furniture")
        .when((F.col("w") == 2) | ((F.col("w") == 1) & (F.col("titles") >= SURE)), "message")
        .when(many & (F.col("sources") >= PLAIN) & (F.col("titles") >= PLAIN) & (F.col("length") <= SHORT_PAGE), "message")
        .when(many, "explanation")
        .otherwise("copy")
    )
    return by.select("h", kind.alias("kind"))


def residue(articles: DataFrame, texts: DataFrame | None = None) -> DataFrame:
    """(id, field) of every title and content of `articles` (id, url, title, content) that is residue or a notice. `texts`: their written text_units()."""
    texts = written(text_units(articles), "units") if texts is None else texts
    plain, strong = flag(PLAIN).alias("plain"), flag(STRONG)
    each = texts.where(strong == 0).select("id", "field", "source", "title", "h", plain)
    groups = broadcast_if_small(worded(articles, broadcast_if_small(recurring(each), name="recurring")), name="worded")
    hits = each.select("id", "field", "h", "plain").join(groups.select("h"), "h").groupBy("id", "field").agg(F.sum("plain").alias("recurs"), F.collect_list(F.struct("h", "plain")).alias("hits"))
    pages = texts.groupBy("id", "field").agg(F.sum(flag(PLAIN)).alias("sentences"), F.max(strong).alias("strong")).where("strong = 0").join(hits, ["id", "field"])
    pages = written(pages.select("id", "field", "sentences", (F.col("recurs") == F.col("sentences")).cast("int").alias("bare"), "hits"), "pages")
    kinds = grouped(pages.where("field = 'content'"), groups)
    kinds = broadcast_if_small(groups.select("h", "wording").join(kinds, "h", "left"), name="kinds")
    judged = pages.select("id", "field", "sentences", F.explode("hits").alias("hit")).select("id", "field", "sentences", "hit.*").join(kinds, "h")
    known = F.col("kind").isin("message", "filler", "explanation", "furniture")
    message = F.when(F.col("field") == "content", F.col("kind").isin("message", "filler")).otherwise(F.col("kind").isin("message", "filler") | ((F.col("wording") > 0) & F.coalesce(F.col("kind") != "furniture", F.lit(True))))
    by = judged.groupBy("id", "field").agg(F.max(message.cast("int")).alias("message"), F.sum(F.when(known, F.col("plain")).otherwise(0)).alias("known"), F.max("sentences").alias("sentences"), F.max((F.col("kind") == "filler").cast("int")).alias("filler"))
    found = by.where((F.col("message") == 1) & ((F.col("filler") == 1) | (F.col("field") == "title") | (F.col("known") == F.col("sentences"))))
    return texts.where(strong == 1).select("id", "field").distinct().unionByName(found.select("id", "field"))
