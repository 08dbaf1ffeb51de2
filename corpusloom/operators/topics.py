"""Topics built from enrichments, their distributions, and the relations between them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions import rules
from corpusloom.functions.topics import fallback_category, normalized_topic
from corpusloom.operators.names import holding
from corpusloom.operators.numbering import numbered
from corpusloom.session import written

DIMENSIONS = ("intent", "complexity", "audience")
#: Shares of the dimensions in the similarity of two profiles.
PROFILE_WEIGHTS = {"audience": 0.5, "intent": 0.3, "complexity": 0.2}


def assigned(enrichment: DataFrame, least: int = 2, strict: bool = False, organisation: tuple[str, str] = rules.ORGANISATION) -> DataFrame:
    """(id, article_id, topic, raw, specific, the dimensions): each enrichment under its topic.

    A topic of fewer than `least` articles gives way to its broader category. Where such a topic is named like a
    category that an earlier enrichment brought up, the enrichment is lost, unless `strict`; only names of categories
    can be, so what each category needs is the least id that brings it up, and these are settled in id order.
    """
    rows = enrichment.select("id", "article_id", F.col("canonical_topic").alias("raw"), normalized_topic(F.col("canonical_topic"), organisation=organisation).alias("normal"), *DIMENSIONS)
    sizes = rows.groupBy("normal").agg(F.countDistinct("article_id").alias("n"))
    sizes = written(sizes.select("normal", (F.col("n") >= least).alias("specific"), fallback_category(F.col("normal")).alias("fallback")), "sizes")
    rows = written(rows.join(sizes, "normal"), "assigned")
    kept = rows.where("specific").withColumn("topic", F.col("normal"))
    moved = rows.where("not specific")
    if not strict:
        names = sizes.select(F.col("fallback").alias("name")).distinct().join(sizes.where("specific").select(F.col("normal").alias("name")), "name", "left_anti")
        # rows under a dropped topic named like a category
        risky = moved.join(names, moved.normal == names.name, "left_semi")
        safe = moved.join(names.withColumnRenamed("name", "normal"), "normal", "left_anti")
        # one row a category: where each is brought up, and the first row of each name in doubt
        created = {r["fallback"]: r["first"] for r in safe.groupBy("fallback").agg(F.min("id").alias("first")).collect()}
        doubt = risky.groupBy("normal", "fallback").agg(F.min("id").alias("first")).collect()
        for r in sorted(doubt, key=lambda r: r["first"]):
            if created.get(r["normal"], r["first"]) >= r["first"]:
                created[r["fallback"]] = min(created.get(r["fallback"], r["first"]), r["first"])
        before = F.create_map(*[F.lit(x) for kv in created.items() for x in kv]) if created else None
        moved = moved.withColumn("up", F.try_element_at(before, F.col("normal"))).where("up is null or up >= id").drop("up") if created else moved
    return kept.unionByName(moved.withColumn("topic", F.col("fallback"))).select("id", "article_id", "topic", "raw", "specific", *DIMENSIONS)


def build_topics(rows: DataFrame) -> DataFrame:
    """(topic_id, normalized_name, name, total_articles) of assigned(); ids follow the first enrichment, specific topics before categories that gathered others."""
    by = rows.groupBy("topic").agg(
        F.max("specific").alias("own"), F.min("id").alias("first"), F.min_by(F.when(F.col("specific"), F.col("raw")), F.when(F.col("specific"), F.col("id"))).alias("raw_name"), F.countDistinct("article_id").alias("total_articles")
    )
    return numbered(by, [F.desc("own"), F.asc("first")], "topic_id").select(
        "topic_id", F.col("topic").alias("normalized_name"), F.coalesce("raw_name", "topic").alias("name"), "total_articles"
    )


def distributions(rows: DataFrame) -> DataFrame:
    """(topic, dimension, value, n): how often each value occurs in each topic of assigned(); null and empty values don't count."""
    long = rows.select("topic", F.explode(F.create_map(*[x for d in DIMENSIONS for x in (F.lit(d), F.col(d))])).alias("dimension", "value"))
    return long.where("value is not null and value <> ''").groupBy("topic", "dimension", "value").agg(F.count("*").alias("n"))


def as_maps(long: DataFrame) -> DataFrame:
    """distributions() as one map column for each dimension; a topic has as many entries as the domains have values."""
    by = long.groupBy("topic", "dimension").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("value", "n")))).alias("m"))
    return by.groupBy("topic").agg(*[F.first(F.when(F.col("dimension") == d, F.col("m")), ignorenulls=True).alias(f"{d}_distribution") for d in DIMENSIONS])


def placed_articles(rows: DataFrame, built: DataFrame) -> DataFrame:
    """(topic_id, article_id), distinct, of assigned() under the topics of build_topics()."""
    t = built.select("topic_id", F.col("normalized_name").alias("topic"))
    return rows.join(t, "topic").select("topic_id", "article_id").distinct()


def name_words(c: Column) -> Column:
    return F.array_distinct(F.filter(F.split(F.lower(c), r"\s+"), lambda w: w != ""))


def subtopic_edges(topics: DataFrame) -> DataFrame:
    """(source_id, target_id, weight): source's words are a strict subset of target's, and source comes first by id.

    Each name is filed once, under the rarest of its words; each longer name looks under all of its own. So a frequent
    word gathers only names that have no rarer one, and no pair of names that merely share it is ever made.
    """
    t = topics.select("id", name_words(F.col("normalized_name")).alias("words")).where("size(words) > 0")
    each = t.select("id", "words", F.explode("words").alias("word"))
    freq = each.groupBy("word").agg(F.count("*").alias("df"))
    filed = each.join(freq, "word").groupBy("id").agg(F.min(F.struct("df", "word")).alias("r"), F.first("words").alias("parent_words")).select(F.col("id").alias("source_id"), F.col("r.word").alias("word"), "parent_words")
    pairs = each.select(F.col("id").alias("target_id"), "words", "word").join(filed, "word")
    pairs = pairs.where((F.col("source_id") < F.col("target_id")) & (F.size("parent_words") < F.size("words")) & (F.size(F.array_except("parent_words", "words")) == 0))
    return pairs.select("source_id", "target_id", (F.size("parent_words") / F.size("words")).alias("weight"))


def topic_of_article(topic_articles: DataFrame) -> DataFrame:
    """(article_id, topic_id): the first topic by id of each article."""
    return topic_articles.groupBy("article_id").agg(F.min("topic_id").alias("topic_id"))


def linked_topics(links: DataFrame, topic_articles: DataFrame, sources: bool = False) -> DataFrame:
    """(source_topic, target_topic, n): links between articles of different topics, or their distinct source articles.

    Links are counted by source topic and target article before the second join, so the rows of the hottest target
    shrink to one for each topic that links to it.
    """
    s = topic_articles.select(F.col("article_id").alias("source_id"), F.col("topic_id").alias("source_topic")).distinct()
    t = topic_of_article(topic_articles).select(F.col("article_id").alias("target_id"), F.col("topic_id").alias("target_topic"))
    pairs = links.select("source_id", "target_id").distinct()
    if sources:
        out = pairs.join(s, "source_id").join(t, "target_id").where("source_topic <> target_topic")
        return out.groupBy("source_topic", "target_topic").agg(F.countDistinct("source_id").alias("n"))
    out = pairs.join(s, "source_id").groupBy("source_topic", "target_id").agg(F.count("*").alias("n")).join(t, "target_id")
    return out.where("source_topic <> target_topic").groupBy("source_topic", "target_topic").agg(F.sum("n").alias("n"))


def unordered(a: str, b: str) -> Column:
    return F.struct(F.least(a, b).alias("x"), F.greatest(a, b).alias("y"))


def link_pattern_edges(links: DataFrame, topic_articles: DataFrame, existing: DataFrame | None = None, least: int = 3) -> DataFrame:
    """(source_id, target_id, weight, link_count): `related_to` edges of topics with `least` links or more.

    Pairs with an edge in `existing` (source_id, target_id), in either direction, are left out; of the two directions of
    a pair, the one from the lower id stays.
    """
    n = linked_topics(links, topic_articles).where(F.col("n") >= least).withColumn("pair", unordered("source_topic", "target_topic"))
    if existing is not None:
        n = n.join(existing.select(unordered("source_id", "target_id").alias("pair")).distinct(), "pair", "left_anti")
    best = n.groupBy("pair").agg(F.min(F.struct("source_topic", "target_topic", "n")).alias("e"))
    return best.select(F.col("e.source_topic").alias("source_id"), F.col("e.target_topic").alias("target_id"), F.least(F.col("e.n") / 10, F.lit(1.0)).alias("weight"), F.col("e.n").alias("link_count"))


def cooccurrence_edges(links: DataFrame, topic_articles: DataFrame, least: int = 3) -> DataFrame:
    """(source_id, target_id, sources): topic pairs with `least` or more distinct linking articles."""
    n = linked_topics(links, topic_articles, sources=True)
    return n.where(F.col("n") >= least).select(F.col("source_topic").alias("source_id"), F.col("target_topic").alias("target_id"), F.col("n").alias("sources"))


def overlap_edges(topic_articles: DataFrame, least: int = 1) -> DataFrame:
    """(source_id, target_id, shared, weight): topics that share articles, by Jaccard similarity.

    Pairs arise from the topics of one article; an article is in few topics, so this is no product over a topic.
    """
    rows = topic_articles.select("topic_id", "article_id").distinct()
    size = rows.groupBy("topic_id").agg(F.count("*").alias("n"))
    a = rows.select(F.col("topic_id").alias("source_id"), "article_id")
    b = rows.select(F.col("topic_id").alias("target_id"), "article_id")
    shared = a.join(b, "article_id").where("source_id < target_id").groupBy("source_id", "target_id").agg(F.count("*").alias("shared")).where(F.col("shared") >= least)
    out = shared.join(size.select(F.col("topic_id").alias("source_id"), F.col("n").alias("ns")), "source_id").join(size.select(F.col("topic_id").alias("target_id"), F.col("n").alias("nt")), "target_id")
    return out.select("source_id", "target_id", "shared", (F.col("shared") / (F.col("ns") + F.col("nt") - F.col("shared"))).alias("weight"))


def prerequisite_edges(enrichment: DataFrame, topics: DataFrame, least: int = 1, organisation: tuple[str, str] = rules.ORGANISATION) -> DataFrame:
    """(source_id, target_id, mentions, weight): source is named as a prerequisite by articles of target; loops are kept.

    Mentions are counted by the raw pair of names first, so names are normalised once and hot topics shrink before the joins.
    """
    raw = enrichment.select("canonical_topic", F.explode("prerequisites").alias("prerequisite")).groupBy("canonical_topic", "prerequisite").agg(F.count("*").alias("n"))
    normal = lambda c: normalized_topic(F.col(c), organisation=organisation)
    raw = raw.select(normal("canonical_topic").alias("target_name"), normal("prerequisite").alias("source_name"), "n")
    t = topics.select("id", "normalized_name")
    out = raw.join(t.select(F.col("id").alias("target_id"), F.col("normalized_name").alias("target_name")), "target_name")
    out = out.join(t.select(F.col("id").alias("source_id"), F.col("normalized_name").alias("source_name")), "source_name")
    out = out.groupBy("source_id", "target_id").agg(F.sum("n").alias("mentions")).where(F.col("mentions") >= least)
    return out.select("source_id", "target_id", "mentions", F.least(F.col("mentions") / 5, F.lit(1.0)).alias("weight"))


def relation(label: Column) -> Column:
    """A relationship label without case and outer spaces."""
    return F.lower(F.trim(label))


def known_edges(relationships: DataFrame, topics: DataFrame) -> DataFrame:
    """Distinct (source_id, target_id, relation) whose ends are both topics."""
    ids = topics.select("id")
    e = relationships.select(F.col("source_topic_id").alias("source_id"), F.col("target_topic_id").alias("target_id"), relation(F.col("relationship_type")).alias("relation")).distinct()
    return e.join(ids, e.source_id == ids.id, "left_semi").join(ids, e.target_id == ids.id, "left_semi")


def upsert_relationships(families: list[DataFrame]) -> DataFrame:
    """Edge families (source_id, target_id, relation, weight, support) in one table; of equal keys the later family wins."""
    out = None
    for i, f in enumerate(families):
        f = f.select("source_id", "target_id", "relation", "weight", "support", F.lit(i).alias("family"))
        out = f if out is None else out.unionByName(f)
    best = out.groupBy("source_id", "target_id", "relation").agg(F.max(F.struct("family", "weight", "support")).alias("b"))
    return best.select("source_id", "target_id", "relation", "b.weight", "b.support")


def degrees(edges: DataFrame, topics: DataFrame) -> DataFrame:
    """(topic_id, indegree, outdegree, prerequisite_count) of every topic: subtopic edges by end, prerequisite edges by source.

    Both ends are counted in one aggregate, so each edge is shuffled as a count, not as a row.
    """
    ends = edges.where("relation in ('subtopic_of', 'prerequisite_of')").select(
        F.explode(F.array(F.struct(F.col("source_id").alias("topic_id"), F.lit(True).alias("out")), F.struct(F.col("target_id").alias("topic_id"), F.lit(False).alias("out")))).alias("e"), (F.col("relation") == "subtopic_of").alias("sub")
    ).select("e.topic_id", "e.out", "sub")
    by = ends.groupBy("topic_id").agg(
        F.count_if(F.col("sub") & ~F.col("out")).alias("i"), F.count_if(F.col("sub") & F.col("out")).alias("o"), F.count_if(~F.col("sub") & F.col("out")).alias("p")
    )
    t = topics.select(F.col("id").alias("topic_id"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return t.join(by, "topic_id", "left").select("topic_id", zero("i").alias("indegree"), zero("o").alias("outdegree"), zero("p").alias("prerequisite_count"))


def adjacency(edges: DataFrame, topics: DataFrame, parent_first: bool = True) -> DataFrame:
    """(topic_id, parents, children, related, prerequisites, dependents): sizes of each topic's neighbour sets.

    `parent_first`: the source of a subtopic edge is the parent. `related` counts outgoing edges only.
    """
    up, down = ("parents", "children") if parent_first else ("children", "parents")
    role = lambda rel, end, name: (F.col("relation") == rel, end, name)
    roles = [role("subtopic_of", "target_id", up), role("subtopic_of", "source_id", down), role("related_to", "source_id", "related"), role("prerequisite_of", "target_id", "prerequisites"), role("prerequisite_of", "source_id", "dependents")]
    ends = edges.select(F.explode(F.array(*[F.when(c, F.struct(F.col(e).alias("topic_id"), F.lit(n).alias("role"))) for c, e, n in roles])).alias("r")).where("r is not null").select("r.*")
    by = ends.groupBy("topic_id").agg(*[F.count_if(F.col("role") == n).alias(n) for n in ("parents", "children", "related", "prerequisites", "dependents")])
    t = topics.select(F.col("id").alias("topic_id"))
    return t.join(by, "topic_id", "left").fillna(0)


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two value counts; 0 if one is null or empty."""
    dot = F.aggregate(F.map_keys(a), F.lit(0.0), lambda s, k: s + F.coalesce(F.try_element_at(a, k), F.lit(0)) * F.coalesce(F.try_element_at(b, k), F.lit(0)))
    norm = lambda m: F.sqrt(F.aggregate(F.map_values(m), F.lit(0.0), lambda s, v: s + v.cast("double") * v))
    both = norm(a) * norm(b)
    return F.coalesce(F.when(both > 0, dot / both), F.lit(0.0))


def profile_similarity(pairs: DataFrame, topics: DataFrame) -> DataFrame:
    """(source_id, target_id, similarity) of the topic pairs given: 0.5 audience, 0.3 intent, 0.2 complexity."""
    side = lambda p: topics.select(F.col("id").alias(f"{p}_id"), *[F.col(f"{m}_distribution").alias(f"{p}_{m}") for m in PROFILE_WEIGHTS])
    both = pairs.join(side("source"), "source_id").join(side("target"), "target_id")
    score = sum((cosine(F.col(f"source_{m}"), F.col(f"target_{m}")) * w for m, w in PROFILE_WEIGHTS.items()), F.lit(0.0))
    return both.select("source_id", "target_id", score.alias("similarity"))


#: Profiles in a block of the search by profile.
PROFILE_BLOCK = 5_000


def similar_profiles(topics: DataFrame, asked: DataFrame, least: float = 0.7) -> DataFrame:
    """(source_id, target_id, similarity): for each topic of `asked` (id) all other topics whose profiles are at least so similar.

    Equal profiles are compared once. The asked profiles and all profiles are cut into blocks; a task compares a block with
    another, and topics meet only where their profiles are similar.
    """
    maps = [f"{d}_distribution" for d in DIMENSIONS]
    keyed = topics.select("id", *maps, F.struct(*[F.array_sort(F.map_entries(m)).alias(m) for m in maps]).alias("key"))
    profiles = written(keyed.groupBy("key").agg(F.min("id").alias("profile")), "profiles")
    member = written(keyed.join(profiles, keyed.key.eqNullSafe(profiles.key)).select("profile", keyed.id.alias("topic"), *maps), "members")
    one = member.where("profile = topic").drop("topic")
    questions = written(member.select("profile", F.col("topic").alias("id")).join(asked.select("id"), "id", "left_semi"), "asked")
    wanted = one.join(questions.select("profile"), "profile", "left_semi")
    blocks = max(1, -(-one.count() // PROFILE_BLOCK))
    asked_blocks = max(1, -(-wanted.count() // PROFILE_BLOCK))
    place = lambda n: F.pmod(F.xxhash64("profile"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    side = lambda df, p: df.select("i", "j", F.col("profile").alias(f"{p}_id"), *[F.col(m).alias(f"{p}_{m}") for m in maps])
    x = side(wanted.withColumn("i", place(asked_blocks)).withColumn("j", every(blocks)), "source")
    y = side(one.withColumn("j", place(blocks)).withColumn("i", every(asked_blocks)), "target")
    score = sum((cosine(F.col(f"source_{d}_distribution"), F.col(f"target_{d}_distribution")) * w for d, w in PROFILE_WEIGHTS.items()), F.lit(0.0))
    similar = written(x.join(y, ["i", "j"]).select("source_id", "target_id", score.alias("similarity")).where(F.round("similarity", 9) >= least), "similar")
    a = questions.select(F.col("profile").alias("source_id"), F.col("id").alias("x"))
    b = member.select(F.col("profile").alias("target_id"), F.col("topic").alias("y"))
    return similar.join(a, "source_id").join(b, "target_id").where("x <> y").select(F.col("x").alias("source_id"), F.col("y").alias("target_id"), "similarity")


def related_by_profile(topics: DataFrame, edges: DataFrame, asked: DataFrame, least: float = 0.7) -> DataFrame:
    """similar_profiles() without the pairs that an edge of `edges` (source_id, target_id) relates already, in either direction."""
    known = edges.select("source_id", "target_id").union(edges.select("target_id", "source_id")).distinct()
    return similar_profiles(topics, asked, least).join(known, ["source_id", "target_id"], "left_anti")


def _rarest(each: DataFrame, keep: Column) -> DataFrame:
    """Rows (id, word, size, ...) of `each` of the `keep` rarest words of each id."""
    freq = each.groupBy("word").agg(F.count("*").alias("df"))
    order = F.row_number().over(Window.partitionBy("id").orderBy("df", "word"))
    return each.join(freq, "word").withColumn("place", order).where(F.col("place") <= keep).drop("place", "df")


def _overlapping(few: DataFrame, many: DataFrame, share: float, least_of: str) -> DataFrame:
    """(a, b) of the rows of `few` and `many` (id, words) whose common words are at least `share` of a's, or of the smaller side's, words.

    Names meet by their rarer words only: of n words, at least one of the n - need + 1 rarest must be common.
    """
    need = lambda n: F.ceil(F.lit(share) * n - 1e-9)
    each = lambda df: df.select("id", "words", F.size("words").alias("size"), F.explode("words").alias("word"))
    x = _rarest(each(few), F.col("size") - need(F.col("size")) + 1)
    met = x.select(F.col("id").alias("a"), F.col("words").alias("aw"), "word").join(each(many).select(F.col("id").alias("b"), F.col("words").alias("bw"), "word"), "word")
    if least_of == "either":
        y = _rarest(each(many), F.col("size") - need(F.col("size")) + 1)
        other = each(few).select(F.col("id").alias("a"), F.col("words").alias("aw"), "word").join(y.select(F.col("id").alias("b"), F.col("words").alias("bw"), "word"), "word")
        met = met.unionByName(other)
    size = F.size("aw") if least_of == "a" else F.least(F.size("aw"), F.size("bw"))
    return met.where(F.size(F.array_intersect("aw", "bw")) / size >= share).select("a", "b").distinct()


def suggest_merges(topics: DataFrame, least: int = 3) -> DataFrame:
    """(topic_id, target_id, score): for topics of fewer than `least` articles, the best larger topic, else the longest similar small one.

    10 if one name holds the other, 5 if 60 % of the small topic's words are shared, 2 if any is; ties go to the lower id. A
    topic without such a target is grouped with the small topics that share half of the words of the shorter name (score 1):
    all of them but the longest, the lowest id among equals, are to be merged into that one.
    """
    t = topics.select("id", F.lower("normalized_name").alias("name"), name_words(F.col("normalized_name")).alias("words"), (F.col("total_articles") < least).alias("low"))
    t = written(t.where("name <> ''"), "names")
    low, high = t.where("low"), t.where("not low")
    a, b = low.select(F.col("id").alias("a"), "name"), high.select(F.col("id").alias("b"), "name")
    held = holding(a, b).union(holding(b.select(F.col("b").alias("a"), "name"), a.select(F.col("a").alias("b"), "name")).select(F.col("b").alias("a"), F.col("a").alias("b")))
    worded = t.where("size(words) > 0")
    most = _overlapping(worded.where("low").select("id", "words"), worded.where("not low").select("id", "words"), 0.6, "a")
    # any shared word: the lowest id of each word is enough
    word = lambda df: df.select("id", F.explode("words").alias("word"))
    first = word(worded.where("not low")).groupBy("word").agg(F.min("id").alias("b"))
    some = word(worded.where("low")).join(first, "word").groupBy(F.col("id").alias("a")).agg(F.min("b").alias("b"))
    scored = held.withColumn("score", F.lit(10)).unionByName(most.withColumn("score", F.lit(5))).unionByName(some.withColumn("score", F.lit(2)))
    best = written(scored.groupBy("a").agg(F.max(F.struct("score", (-F.col("b")).alias("neg"))).alias("m")).select(F.col("a").alias("topic_id"), (-F.col("m.neg")).alias("target_id"), "m.score"), "merges")
    alone = worded.where("low").join(best.select(F.col("topic_id").alias("id")), "id", "left_anti").select("id", "words")
    near = _overlapping(alone, worded.where("low").select("id", "words"), 0.5, "either").where("a <> b")
    group = near.union(near.select("a", F.col("a").alias("b"))).distinct()
    longest = group.join(t.select(F.col("id").alias("b"), F.length("name").alias("size")), "b").groupBy("a").agg(F.max(F.struct("size", (-F.col("b")).alias("neg"))).alias("m")).select("a", (-F.col("m.neg")).alias("target_id"))
    small = group.join(longest, "a").where("b <> target_id").select(F.col("b").alias("topic_id"), "target_id", F.lit(1).alias("score")).distinct()
    return best.unionByName(small)
