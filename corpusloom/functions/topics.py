"""Normalisation of topic names and their broader categories, as column expressions."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.functions import rules


def squeeze(c: Column) -> Column:
    """White space as single blanks, none outside."""
    return F.regexp_replace(F.regexp_replace(c, r"\s+", " "), "^ | $", "")


def normalized_topic(
    raw: Column,
    consolidation: dict[str, str] = rules.CONSOLIDATION,
    suffixes: list[str] = rules.SUFFIXES,
    organisation: tuple[str, str] = rules.ORGANISATION,
) -> Column:
    """The topic that a raw name stands for; `General` for null and empty names."""
    long, short = organisation[0].replace(" ", r"\s+"), organisation[1]
    ends = ([(rf"\bat\s+{long}\b", ""), (rf"\b{long}\b", "")] if long else []) + (
        [(rf"\bat\s+{short}\b", ""), (rf"^{short}\s+", ""), (rf"\s+{short}$", ""), (rf"\s+{short}\s+", " "), (rf"\s+on\s+{short}\b", "")] if short else []
    )
    t = squeeze(F.lower(raw))
    t = F.regexp_replace(t, r"^(accessing|using|managing|configuring)\s+", "")
    t = F.regexp_replace(t, r"\s+my\s+", " ")
    t = squeeze(F.regexp_replace(t, r"\s*\([^)]+\)\s*", " "))
    known = F.create_map(*[F.lit(x) for x in chain.from_iterable(consolidation.items())])
    rest = t
    for pattern, to in ends:
        rest = F.regexp_replace(rest, pattern, to)
    rest = F.regexp_replace(squeeze(rest), rf" (?:{'|'.join(suffixes)})$", "")
    return F.when(raw.isNull() | (raw == ""), "General").otherwise(F.coalesce(F.try_element_at(known, t), F.initcap(rest)))


def category_scores(topic: Column, categories: dict[str, list[str]] = rules.CATEGORIES) -> Column:
    """Array of (score, rank, category): 10 for a keyword that is the topic, 5 for one of its words, 2 within it; earlier categories rank higher."""
    low = F.lower(topic)
    words = F.split(low, " ")
    table = F.array(*[F.struct(F.lit(-i).alias("rank"), F.lit(c).alias("category"), F.array(*map(F.lit, ks)).alias("keywords")) for i, (c, ks) in enumerate(categories.items())])
    points = lambda k: F.when(low == k, 10).when(F.array_contains(words, k), 5).when(F.contains(low, k), 2).otherwise(0)
    return F.transform(table, lambda c: F.struct(F.aggregate(c["keywords"], F.lit(0), lambda s, k: s + points(k)).alias("score"), c["rank"].alias("rank"), c["category"].alias("category")))


def fallback_category(topic: Column, categories: dict[str, list[str]] = rules.CATEGORIES) -> Column:
    """The best category of a normalized topic, the first on ties; `General` below a score of 2."""
    best = F.array_max(category_scores(topic, categories))
    return F.when(best["score"] >= 2, F.initcap(best["category"])).otherwise("General")
