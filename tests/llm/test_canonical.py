from itertools import product

import pytest

from corpusloom.llm import canonical as C

CATALOG = [(1, "Server Accounts", []), (2, "Payroll Automation", ["RynxHub"]), (3, "Digital Asset Library", ["DAL", None]), (4, "Single Sign On", None), (5, "Desktop Hosting", []), (6, "Faculty Directory", []), (7, "Mailing Lists", [])]
NAMES = {i: n for i, n, _ in CATALOG}
CASES = {
    "Server Accounts": 1, " server_accounts!": 1, "Accounts, Server": 1, "Sever Acounts": 1, "Server Account guide": 1, "SERVERACCOUNTS": 1, "Intro to Server Accounts FAQ": 1, "Accountsfor Server": 1, "Introto Server Accounts": 1,
    "rynxhub": 2, "RynxHub help": 2, "PayrollAutomation": 2, "dal": 3, "Digital Asset Libary": 3, "Single-Sign On": 4, "desktop hostings": 5, "Faculty Directorys": 6, "Fcaulty Directory (Norwick)": 6,
    "Pyarol Automation": 2, "Payroll Autmatin": 2, "Server Accounts at Norwick": 1, "Mailing Lists tutorial": 7, "Overview of Payroll Automation": 2,
    "Server Hosting": -1, "Desktop Gardening": -1, "help": -1, "n/a": -1, "": -1, "???": -1, "Digital Asset": -1, "x" * 5000: -1, "Server Accounts shuttle timetable": -1,
}
#: What people of this place add to subjects, seen with several of them.
ADDED = ["{} help", "{} guide", "Intro to {}", "{} FAQ", "{} (Norwick)", "{} at Norwick", "{} tutorial", "Overview of {}"]
CONTEXT = [a.format(n) for a, n in product(ADDED, NAMES.values())]


def frame(spark, values):
    return spark.createDataFrame([(i, v, 1, "w") for i, v in enumerate(values)], "id int, canonical_topic string, ref_id int, word string")


def catalog(spark):
    return spark.createDataFrame(CATALOG, "ref_id int, name string, aliases array<string>")


def test_cases(spark):
    cat, values = catalog(spark), [*CASES, *CONTEXT, "Server Accounts", None]
    df = frame(spark, values)
    got = {r.id: r.ref_id for r in C.map_values(df, cat).collect()}
    assert {v: got[i] for i, v in enumerate(CASES)} == CASES
    assert got[len(values) - 2] == 1 and got[len(values) - 1] == -1 and len(got) == len(values)
    assert {r.ref_id for r in C.map_values(df, cat.limit(0)).collect()} == {-1}
    assert C.map_values(df.limit(0), cat).isEmpty()


def test_a_word_is_added_only_beside_several_entries(spark):
    few = [f"{n} zebra" for n in list(NAMES.values())[: C.ADDED_WITH - 1]]
    many = [f"{n} zebra" for n in list(NAMES.values())[: C.ADDED_WITH]]
    for values, want in ((few, {-1}), (many, {1, 2, 3, 4})):
        assert {r.ref_id for r in C.map_values(frame(spark, values), catalog(spark)).collect()} == want
    # a frequent typing error of a word is no added word
    typos = [f"Servr {w}" for w in ("Accounts", "Accounts!", "Account", "accounts?", "ACCOUNTS")]
    assert {r.ref_id for r in C.map_values(frame(spark, typos), catalog(spark)).collect()} == {1}


@pytest.mark.parametrize("a, b, n", [("payroll", "payroll", 0), ("pyaroll", "payroll", 1), ("payrol", "payroll", 1), ("pyarol", "payroll", 2), ("autmatin", "automation", 2), ("apyrlol", "payroll", 2), ("x", "payroll", None), ("ab", "", 2), ("", "", 0)])
def test_edits(spark, a, b, n):
    assert spark.createDataFrame([(a, b)], "a string, b string").select(C._edits("a", "b").alias("n")).first().n == n


def test_every_pair_within_the_bound_meets(spark):
    """Deletion variants against brute force over all pairs."""
    words = [("automation",), ("utomation",), ("autoation",), ("uatomation",), ("autmatin",), ("mailing",), ("mialnig",), ("mail",), ("mial",), ("mai",), ("lists",), ("list",)]
    w = spark.createDataFrame(words, "w string")
    v = C._deletions(w, "w")
    met = {(r.a, r.b) for r in v.selectExpr("w as a", "variant").join(v.selectExpr("w as b", "variant"), "variant").collect()}
    pairs = w.selectExpr("w as a").crossJoin(w.selectExpr("w as b"))
    bound = lambda a, b: 2 if min(len(a), len(b)) >= C.TWICE_FROM else 1 if min(len(a), len(b)) >= C.REPAIR_FROM else 0
    near = {(r.a, r.b) for r in pairs.withColumn("n", C._edits("a", "b")).collect() if r.n is not None and r.n <= bound(r.a, r.b)}
    assert len(near) > 20 and near <= met
