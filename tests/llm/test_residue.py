import re

import pytest

from corpusloom.llm import residue as R

TEXT = "You should open the panel before you close the old window.\nWhat changes\nThe limit of 5 seats applies to every shared room."
RULED_TITLES = [
    "{{title}}", "Fix a {% BODY_TEXT %} folder", "__link__", "[Insert contact here]", "$version$ - Foo Desk", "Lorem dorem valum", "__invoice_id__", "$customer$", "{{ customer-name }}", "[YOUR NAME]", "{0}", "XX_owner_XX", "&lt;date&gt;",
]
FINE_TITLES = [
    "Template tags such as {{ name }} in the editor", "TEMPLATE  TAGS\tSUCH\xa0AS {{ NAME }} in the agent", "Using ${HOME} with Foo", 'Why "Page not found" appears in Foo', "Error 500 in Foo: restart the queue", "About.the__Foo__cluster", "__Foo__ bar", "__init__ of a class",
    "Pending", "", None, "Lorem ipsum drafts: cleaning a notebook", "About the firewall [2025]", "The pattern [YOUR NAME] in a form", "Page not found",
]
RULED = ["{{title}}\n[[link]]", TEXT + "\nSee %%department%% for the full list.", "Dorem valum sedo sitra irura labor tador enima.", "[MINIMAL CONTENT: 5 chars]", "[BROKEN ARTICLE: x]", TEXT + "\nThis page was last checked by __date__."]
FINE = [
    TEXT, TEXT + "\nPlease enable JavaScript to view this page.", TEXT + "\nIn a mail template, the tag {{first_name}} is replaced by the name.", TEXT + "\nWrap repeated parts in {{% block body %}} so that it works.",
    TEXT + "\nAuthors sometimes leave lorem ipsum in a draft; look for it.", "Labs > Help > {{title}}\n" + TEXT, "", None, TEXT + " word" * 100000,
]
SCHEMA = "id int, url string, title string, content string, source string, plain int, h int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "s", 0, 0) for r in rows], SCHEMA)


def cases(df):
    return {(r.id, r.field) for r in R.residue(df).collect()}


def test_what_rules_find_in_a_unit(spark):
    rows = [(i, "https://h/a", t, TEXT) for i, t in enumerate(RULED_TITLES + FINE_TITLES)] + [(1000 + i, None, "Fine title", c) for i, c in enumerate(RULED + FINE)] * 2
    assert cases(frame(spark, rows)) == {(i, "title") for i in range(len(RULED_TITLES))} | {(1000 + i, "content") for i in range(len(RULED))}
    assert R.residue(frame(spark, rows).limit(0)).isEmpty()


MESSAGE = "The gears of this place are stuck, so nobody can read on."
LONG = "We are very sorry to tell you that the gears of the machine that turns our pages have come to a halt, and that our people are looking for the missing spare part."


def corpus(hosts=40):
    """Articles of their own on each host, a notice beside them, error pages that no list knows, a listed message, filler, and one article copied to many hosts."""
    cookie = "This place keeps small crumbs on your desk and counts them."
    rows = []
    for k in range(hosts):
        host = f"https://h{k}.example/"
        for j in range(5):
            rows.append((len(rows), host + "a", f"Article {chr(97 + j)} of place {k}x", f"{cookie}\nThe {k}th shelf of hall {'abcde'[j]}{k}x holds the {chr(97 + k % 26)}{k}q books.\nTurn left at the {'abcde'[j]}{k}y stairs and then go up."))
        rows.append((len(rows), host + "e", f"Something about {k}z", f"{cookie}\n{MESSAGE}\n{LONG}"))
        rows.append((len(rows), host + "f", f"Other thing {k}z", "Menu\nPage not found\nIt may have been moved, renamed or removed."))
        rows.append((len(rows), host + "g", "Access denied | Foo Bar Office" if k % 2 else "Access denied (452)", f"The {k}th window of room {k}w looks out to the {k}v yard."))
        rows.append((len(rows), host + "h", f"Draft {k}z", f"The {k}th box {k}u goes to the long hall.\nTBD TBD TBD"))
        rows.append((len(rows), host + "c", "How the shared boat is rowed", "The shared boat is rowed by four people.\nAn error message shows that one of them fell asleep.\nWake them with a long stick."))
    return rows


def expected(rows):
    kind = {r[0]: r[1][-1] for r in rows}
    return {(i, "content") for i, k in kind.items() if k in "efh"} | {(i, "title") for i, k in kind.items() if k == "g"}


def test_recurring_messages_are_found_whether_listed_or_not(spark):
    rows = corpus()
    assert cases(frame(spark, rows)) == expected(rows)


def test_without_groups_across_sources_no_message_is_found(spark, monkeypatch):
    rows = corpus()
    assert cases(frame(spark, [(i, "https://one.example/a", t, c) for i, _, t, c in rows])) == set()
    monkeypatch.setattr(R, "recurring", lambda units: units.selectExpr("h", "1L as sources", "1L as titles", "id").limit(0))
    assert cases(frame(spark, rows)) == set()


@pytest.mark.parametrize("text", ["404", "404 Not Found", "HTTP Status 503", "Your session has expired", "[object Object]", "Loading...", "Please enable JavaScript to view this page.", "Page introuvable", "Bad gateway"])
def test_wording_of_whole_messages(spark, text):
    assert spark.createDataFrame([(text,)], "t string").select(R.wording(R.masked(R.F.col("t"))).alias("w")).first().w == 2


@pytest.mark.parametrize("text", ["Heading one goes here", "TBD TBD TBD", "blah blah blah", "Sample paragraph. Sample paragraph. Sample paragraph.", "Untitled page", "xxxxx xxxxx xxx xxxxxx"])
def test_wording_of_filler(spark, text):
    assert spark.createDataFrame([(text,)], "t string").select(R.wording(R.masked(R.F.col("t"))).alias("w")).first().w == 3


def test_units_are_made_without_a_shuffle_and_know_the_lines_beside_them(spark):
    step, head = "Turn left at the stairs.", "Menu"
    pages = [[step], [head, step, head], [step, step, head, step, "See {{name}} on the next page.", step], [head], [step] * 7, [step, head]] * 3
    rows = [(i, "https://h/a", "A title", "\n".join(p)) for i, p in enumerate(pages)]
    plain = [[int(x == step) for x in p] for p in pages]
    want = {(i, k): (p[k], p[k - 1] if k else 0, p[k + 1] if k + 1 < len(p) else 0) for i, p in enumerate(plain) for k in range(len(p))}
    asked = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for batch in (1, 2, 3, 1000):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
            units = R.text_units(frame(spark, rows).coalesce(2))
            assert "Exchange" not in units._jdf.queryExecution().executedPlan().toString()
            got = units.where("field = 'content'").select("id", "at", R.flag(R.PLAIN), R.flag(R.PREV), R.flag(R.NEXT)).collect()
            assert len(got) == len(want) and {(r[0], r[1]): tuple(r[2:]) for r in got} == want
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", asked)
    assert units.where(R.flag(R.STRONG) == 1).select("id").distinct().count() == 3
    assert units.where("field = 'title'").count() == len(rows)


def test_every_placeholder_and_marker_begins_with_a_sign():
    more = ["${owner}", "#{owner}", "<%= owner %>", "<<owner>>", "@@owner@@", "[[ owner ]]", "[insert a name here]", "{$owner}", "{% owner %}", "xx_owner_xx", "&LT;owner&GT;", *RULED[3:5]]
    for text in [x for x in RULED_TITLES if "dorem" not in x] + more:
        assert re.search(R.PLACEHOLDER, text) or re.search(R.MARKER, text)
        assert re.search(R.SIGNS, text), text
