from corpusloom.functions import pages as P
from corpusloom.functions import replies as R

HTML = "<title>T</title><body><nav>menu</nav><article><h1 class='article-title'> Head </h1><p>One<p>Two <b>three</b><script>x()</script></article><a href='/k?id=1'>k</a><a href='#t'>t</a><footer>f</footer>"


def test_parse(spark):
    assert P.parse(HTML, "https://h/a/b") == ("Head", "Head\nOne\nTwo\nthree", ["https://h/k?id=1"], None, None)
    assert P.parse("", "")[0] == "Untitled Article"
    df = spark.createDataFrame([(1, "https://h/", HTML), (2, None, None)], "id int, url string, html string")
    assert [r.title for r in P.parse_pages(df).orderBy("id").collect()] == ["Head", "Untitled Article"]


def test_replies(spark):
    rows = [
        (1, '{"canonical_topic":" SLURM ","keywords":["a","b"],"intent":"HowTo","audience":"Faculty","complexity":"EXPERT","prerequisites":[]}'), (2, '{"canonical_topic":"X","keywords":"a, b","prerequisites":"p ,q"}'),
        (3, '{"canonical_topic":""}'), (4, "{}"), (5, "no json"), (6, '{"canonical_topic":"X","intent":null}'), (7, None),
    ]
    got = {r.id: r for r in R.parse_replies(spark.createDataFrame(rows, "id int, reply string")).collect()}
    assert (got[1].canonical_topic, got[1].intent, got[1].audience, got[1].complexity) == ("SLURM", "how-to", "faculty", "expert")
    assert got[2].keywords == ["a", "b"] and got[2].prerequisites == ["p", "q"] and got[2].intent == "unknown"
    assert [got[i].ok for i in range(1, 8)] == [True, True, False, False, False, False, False]
    asked = R.ask(spark.createDataFrame([(1, "p")], "id int, prompt string"), lambda ps: ["{}" for _ in ps])
    assert [tuple(r) for r in asked.collect()] == [(1, "{}")]
