"""Problem 3: free-entered values to entries of a reference list, by token repair and soft TF-IDF.

The work is done on distinct values and distinct tokens. Each distinct token is joined to the reference vocabulary by
edit distance: both sides are expanded to the token and its deletions and equi-joined, which finds every pair within the
bound; the pair is then verified. The bound grows with the length: tokens of REPAIR_FROM letters may have one edit,
those of TWICE_FROM two (a swap of neighbours is one edit). Corrected tokens are weighted by TF-IDF and combined per
entry; the best entry at or above the threshold wins, else the value is reported as -1.

Words that people add without changing the subject ("help with", the organisation's name) are in no list: a word of no
entry that stands beside all words of an entry, for ADDED_WITH different entries or more, is an added word and weighs
nothing. Counts are taken over all distinct values.

A value and an entry can only be as similar as the threshold if they share one of the value's rarer words (those before
which the more frequent ones can't reach it), so candidates meet by these alone and frequent words pair nothing.

Defined cases: null, empty and unmatched values get -1; ties go to the smallest entry id; a null alias list or alias is
ignored; an empty reference list gives -1 everywhere; clashing extra columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.session import broadcast_if_small, written

#: A word of no entry counts as added where it stands beside so many different entries.
ADDED_WITH = 4
#: Words of entries that carry little of the subject.
JOINT_WORDS = ["in", "on", "over", "of", "and", "for", "the", "to"]
#: Least cosine between corrected value and entry. An entry of three words with one missing scores 0.82 at equal weights.
THRESHOLD = 0.9
#: Lengths from which a token may have one and two edits. A shorter one that is no known word may be anything.
REPAIR_FROM, TWICE_FROM = 4, 6


def tokens(c: Column) -> Column:
    """Lower-cased runs of letters or digits, with humps split ("LabHosting"); empty for null."""
    humps = F.regexp_replace(F.coalesce(c, F.lit("")), r"(\p{Ll})(\p{Lu})(?=\p{Ll})", "$1 $2")
    return F.filter(F.split(F.lower(humps), r"[^\p{L}\p{N}]+"), lambda t: t != "")


def squashed(c: Column) -> Column:
    return F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"[^\p{L}\p{N}]+", "")


def _deletions(df: DataFrame, word: str) -> DataFrame:
    """df with one row per word and each of its deletions within the bound, as `variant`.

    A longer word may lose one letter more than a short one may, as the other side may be the shorter one.
    """
    once = lambda w: f"transform(sequence(1, length({w})), i -> concat(left({w}, i - 1), substring({w}, i + 1)))"
    df = df.withColumn("_one", F.expr(f"case when length({word}) >= {REPAIR_FROM - 1} then array_distinct({once(word)}) else array() end"))
    df = df.withColumn("_two", F.expr(f"case when length({word}) >= {TWICE_FROM - 1} then array_distinct(flatten(transform(_one, w -> {once('w')}))) else array() end"))
    return df.withColumn("variant", F.explode(F.array_distinct(F.concat(F.array(word), "_one", "_two")))).drop("_one", "_two")


def _edits(a: str, b: str) -> Column:
    """Insertions, deletions, replacements and swaps of neighbours that turn a into b: 0, 1, 2, or null beyond."""
    swaps = lambda x: f"transform(sequence(1, greatest(length({x}) - 1, 1)), i -> concat(left({x}, i - 1), substring({x}, i + 1, 1), substring({x}, i, 1), substring({x}, i + 2)))"
    return F.expr(
        f"case when {a} = {b} then 0 when levenshtein({a}, {b}) <= 1 or array_contains({swaps(a)}, {b}) then 1 "
        f"when levenshtein({a}, {b}) <= 2 or exists({swaps(a)}, s -> levenshtein(s, {b}) <= 1) or arrays_overlap({swaps(a)}, {swaps(b)}) then 2 end"
    )


def vocabulary(catalog: DataFrame, added: DataFrame | None = None) -> DataFrame:
    """(term, words, extra): words of the entries, and joined runs of them ("domainname", whole names, aliases) with the words they stand for.

    An alias stands for one word of its own, `@` and the entry's id; an added word (term) for the empty word. A word with a
    joint word at its side costs half an edit extra.
    """
    names = catalog.select("ref_id", tokens(F.col("name")).alias("w"))
    single = names.select(F.explode("w").alias("term")).select("term", F.array("term").alias("words"))
    runs = F.expr(
        "flatten(transform(sequence(1, greatest(size(w) - 1, 1)), i -> transform(sequence(2, greatest(size(w) - i + 1, 2)), n -> slice(w, i, n))))"
    )
    joined = names.where("size(w) > 1").select(F.explode(runs).alias("words")).union(
        names.where("size(w) = 2").select(F.reverse("w").alias("words"))
    ).where("size(words) > 1").select(F.array_join("words", "").alias("term"), "words")
    # the blank beside a joint word left out ("Securityfor Mobile")
    joints = F.array(*map(F.lit, JOINT_WORDS))
    glued = names.select(F.explode("w").alias("word"), joints.alias("joints")).select("word", F.explode("joints").alias("joint")).select(
        F.explode(F.array(F.concat("word", "joint"), F.concat("joint", "word"))).alias("term"), F.array("word").alias("words")
    )
    alias = catalog.select("ref_id", F.explode("aliases").alias("alias")).where("alias is not null").select(
        squashed(F.col("alias")).alias("term"), F.array(F.concat(F.lit("@"), F.col("ref_id").cast("string"))).alias("words")
    )
    # terms of names go before glued ones, and all of these before added words
    both = single.union(joined).union(alias).withColumn("place", F.lit(0)).union(glued.withColumn("place", F.lit(1)))
    if added is not None:
        both = both.union(added.select("term", F.array(F.lit("")).alias("words"), F.lit(2).alias("place")))
    best = both.where("term <> ''").groupBy("term").agg(F.min(F.struct("place", F.size("words").alias("size"), F.concat_ws(" ", "words").alias("text"), "words")).alias("b"))
    return best.select("term", "b.words", F.when(F.col("b.place") == 1, 0.5).otherwise(0.0).alias("extra"))


def repaired(distinct_tokens: DataFrame, vocab: DataFrame) -> DataFrame:
    """(token, words, cost): for each token the vocabulary terms at its least cost: exact 0, number 0.5, an edit 1, two 2, these with number or a joint word 0.5 more."""
    stem = "case when length({0}) > 2 and endswith({0}, 's') then left({0}, length({0}) - 1) else {0} end"
    exact = distinct_tokens.join(broadcast_if_small(vocab, name="vocabulary"), F.col("token") == F.col("term")).select("token", "words", F.col("extra").alias("cost"))
    other = distinct_tokens.join(vocab.select("term"), F.col("token") == F.col("term"), "left_anti")
    left = other.select("token", F.explode(F.expr(f"array_distinct(array(token, {stem.format('token')}))")).alias("form"))
    right = vocab.select("term", "words", "extra", F.explode(F.expr(f"array_distinct(array(term, {stem.format('term')}))")).alias("stem"))
    near = _deletions(left, "form").join(broadcast_if_small(_deletions(right, "stem"), name="variants"), "variant").select("token", "form", "term", "stem", "words", "extra").distinct()
    near = near.select("token", "form", "term", "stem", "words", "extra", _edits("form", "stem").alias("edits"))
    least = F.least(F.length("token"), F.length("term"))
    bound = F.when(least >= TWICE_FROM, 2).when(least >= REPAIR_FROM, 1).otherwise(0)
    number = F.when((F.col("form") == F.col("token")) & (F.col("stem") == F.col("term")), 0.0).otherwise(0.5)
    found = near.where(F.col("edits") <= bound).groupBy("token", "term").agg(F.first("words").alias("words"), F.min(F.col("edits") + number + F.col("extra")).alias("cost"))
    first = Window.partitionBy("token").orderBy("cost")
    return exact.unionByName(found.withColumn("r", F.rank().over(first)).where("r = 1").select("token", "words", "cost"))


def added_words(typed: DataFrame, fixes: DataFrame, catalog: DataFrame) -> DataFrame:
    """(term): words of no entry that stand beside all words of an entry in values of ADDED_WITH entries or more, and joined pairs and triples of them.

    `typed`: (value, reading, at, token). Such a token may have been corrected to a word, but is neither that word nor its other number.
    """
    sure = fixes.where("cost < 1").select("token", "words")
    entry = catalog.select("ref_id", F.array_distinct(tokens(F.col("name"))).alias("need"))
    sized = entry.select("ref_id", F.size("need").alias("size"), F.explode("need").alias("word"))
    words = typed.join(fixes, "token").select("value", "reading", F.explode("words").alias("word")).distinct()
    # entries are met by the rarest of their words, then tested whole
    rare = sized.join(sized.groupBy("word").agg(F.count("*").alias("df")), "word").groupBy("ref_id").agg(F.min(F.struct("df", "word"))["word"].alias("word")).join(entry, "ref_id")
    have = words.groupBy("value", "reading").agg(F.collect_set("word").alias("have"))
    held = words.join(rare, "word").join(have, ["value", "reading"]).where(F.size(F.array_except("need", "have")) == 0).select("value", "reading", "ref_id", "need")
    # a token that itself was corrected to one of the entry's words doesn't stand beside them
    means = fixes.groupBy("token").agg(F.flatten(F.collect_list("words")).alias("means"))
    rest = typed.join(sure, "token", "left_anti").join(means, "token", "left")
    apart = ~F.coalesce(F.arrays_overlap("means", "need"), F.lit(False))
    beside = rest.join(held, ["value", "reading"]).where(apart).groupBy("token").agg(F.countDistinct("ref_id").alias("n")).where(F.col("n") >= ADDED_WITH).select("token")
    beside = written(beside, "added")
    single = beside.select(F.col("token").alias("term"))
    # runs typed without blanks ("howto"), of neighbours as they stand in values
    order = Window.partitionBy("value", "reading").orderBy("at")
    known = typed.join(broadcast_if_small(beside.withColumn("added", F.lit(True)), name="added"), "token", "left")
    after = lambda n: F.when(F.lead("added", n).over(order), F.lead("token", n).over(order))
    runs = known.select("added", "token", after(1).alias("b"), after(2).alias("c")).where("added and b is not null").select("token", "b", "c").distinct()
    return single.union(runs.select(F.explode(F.array(F.concat("token", "b"), F.concat("token", "b", "c"))).alias("term")).where("term is not null")).distinct()


def match_values(values: DataFrame, catalog: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(value, ref_id, score) of each distinct non-null value of `values.value`; -1 and null where none is meant."""
    distinct = values.where("value is not null").select("value").distinct()
    # the humped reading and the plain one ("SolgadexLine" is one alias, "LabHosting" two words)
    plain = F.filter(F.split(F.lower("value"), r"[^\p{L}\p{N}]+"), lambda t: t != "")
    read = distinct.select("value", F.explode(F.array_distinct(F.array(tokens(F.col("value")), plain))).alias("toks"))
    read = read.select("value", F.xxhash64("toks").alias("reading"), "toks")
    typed = written(read.select("value", "reading", F.posexplode("toks").alias("at", "token")), "typed")
    found = written(typed.select("token").distinct(), "tokens")
    added = written(added_words(typed, written(repaired(found, vocabulary(catalog)), "fixes"), catalog), "added")
    fixes = written(repaired(found, vocabulary(catalog, added)), "fixes")
    # an unknown token stands for itself and weighs in full
    words = typed.join(fixes, "token", "left").select(
        "value", "reading", "at", F.explode(F.coalesce("words", F.array(F.concat(F.lit("?"), F.col("token"))))).alias("word"), (1 - 0.05 * F.coalesce("cost", F.lit(0.0))).alias("sim")
    ).where("word <> ''")
    entries = catalog.select("ref_id", F.explode(tokens(F.col("name"))).alias("word")).distinct().withColumn("form", F.lit(0)).unionByName(
        catalog.where("exists(aliases, a -> a is not null)").select("ref_id", F.concat(F.lit("@"), F.col("ref_id").cast("string")).alias("word"), F.lit(1).alias("form"))
    )
    n = catalog.count()
    idf = entries.where("form = 0").groupBy("word").agg(F.count("*").alias("df")).select(
        "word", F.when(F.col("word").isin(JOINT_WORDS), 0.3).otherwise(F.log(1 + n / F.col("df"))).alias("weight")
    )
    # a word that no entry has weighs as much as the rarest that one has
    top = F.lit(math.log(1.0 + n))
    weighed = written(entries.join(idf, "word", "left").select("ref_id", "form", "word", F.coalesce("weight", top).alias("weight")), "weighed")
    entry = weighed.groupBy("ref_id", "form").agg(F.sqrt(F.sum(F.col("weight") ** 2)).alias("entry_norm"), F.map_from_entries(F.collect_list(F.struct("word", "weight"))).alias("weights"))
    # a token with several corrections of equal cost counts once in the norm, by its heaviest
    said = words.join(broadcast_if_small(idf, name="idf"), "word", "left").select("value", "reading", "at", "word", "sim", F.coalesce("weight", top).alias("w"))
    options = fixes.groupBy("token").agg(F.count("*").alias("options"))
    options = typed.join(options, "token", "left").select("value", "reading", "at", F.coalesce("options", F.lit(1)).alias("options"))
    once = said.groupBy("value", "reading", "at", "word").agg(F.max("w").alias("w"), F.max("sim").alias("sim")).join(options, ["value", "reading", "at"])
    whole = once.groupBy("value", "reading", "word").agg(F.max("w").alias("w"), F.max("sim").alias("sim"), F.sum(F.col("w") ** 2 / F.col("options")).alias("part"))
    by = Window.partitionBy("value", "reading")
    # what a word and all more frequent ones can add to the product at most
    reach = F.sum(F.col("w") ** 2).over(by.orderBy("w", "word").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    whole = whole.select("value", "reading", "word", "w", F.col("sim"), F.sum("part").over(by).alias("norm2"), reach.alias("reach"))
    meet = whole.where(F.col("reach") >= 0.999 * threshold**2 * F.col("norm2")).select("value", "reading", "word").join(weighed.select("word", "ref_id", "form"), "word").select("value", "reading", "ref_id", "form").distinct()
    values_of = whole.groupBy("value", "reading").agg(F.sqrt(F.max("norm2")).alias("value_norm"), F.collect_list(F.struct("word", "sim")).alias("said"))
    both = meet.join(values_of, ["value", "reading"]).join(broadcast_if_small(entry, name="entries"), ["ref_id", "form"])
    dot = F.aggregate("said", F.lit(0.0), lambda s, x: s + x["sim"] * F.pow(F.coalesce(F.try_element_at("weights", x["word"]), F.lit(0.0)), F.lit(2.0)))
    scored = both.select("value", "ref_id", (dot / (F.col("entry_norm") * F.col("value_norm"))).alias("score"))
    best = scored.where(F.col("score") >= threshold).groupBy("value").agg(F.max(F.struct(F.col("score"), (-F.col("ref_id")).alias("neg"))).alias("b"))
    return distinct.join(best, "value", "left").select("value", F.coalesce(-F.col("b.neg"), F.lit(-1)).alias("ref_id"), F.col("b.score").alias("score"))


def map_values(records: DataFrame, catalog: DataFrame, value: str = "canonical_topic", id_col: str = "id") -> DataFrame:
    """(id, ref_id) of every record; -1 where its value is null, empty or means no entry."""
    narrow = records.select(F.col(id_col).alias("id"), F.col(value).alias("value"))
    matched = match_values(narrow, catalog.select("ref_id", "name", "aliases"))
    return narrow.join(matched.where("ref_id <> -1"), "value", "left").select("id", F.coalesce("ref_id", F.lit(-1)).alias("ref_id"))
