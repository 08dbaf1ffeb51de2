"""Prompts for an extractor and the validation of its JSON replies, as column expressions."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import rules

PROMPT = "Classify the article below. Reply with JSON: canonical_topic, keywords, intent, audience, prerequisites, complexity.\nTitle: %s\nText: %s"


def excerpt(content: Column, n: int = 500) -> Column:
    """The first n signs without outer white space; this is what the prompt shows, not a cap on stored text."""
    return F.regexp_replace(F.substring(content, 1, n), r"^\s+|\s+$", "")


def prompt(title: Column, content: Column) -> Column:
    return F.format_string(PROMPT, F.coalesce(title, F.lit("")), F.coalesce(excerpt(content), F.lit("")))


def _list(reply: Column, field: str) -> Column:
    """A field that is an array of strings, or one string of parts between commas."""
    raw = F.get_json_object(reply, f"$.{field}")
    parsed = F.from_json(raw, "array<string>")
    split = F.filter(F.transform(F.split(raw, ","), lambda x: F.trim(x)), lambda x: x != "")
    return F.coalesce(F.when(raw.startswith("["), parsed).otherwise(split), F.array().cast("array<string>"))


def _enum(reply: Column, field: str, domain: list[str]) -> Column:
    v = F.lower(F.get_json_object(reply, f"$.{field}"))
    v = F.when(v == "howto", "how-to").otherwise(v)
    return F.when(v.isin(domain), v).otherwise("unknown")


def parse_replies(replies: DataFrame) -> DataFrame:
    """(id, ok, canonical_topic, intent, audience, complexity, keywords, prerequisites) of `replies` (id, reply).

    A reply that is no JSON object, lacks a topic, or has an explicit null in a typed field is rejected (ok is false).
    """
    r = F.col("reply")
    parsed = F.from_json(r, "map<string,string>")
    topic = F.trim(F.get_json_object(r, "$.canonical_topic"))
    nulls = F.lit(False)
    for f in ("intent", "audience", "complexity"):
        nulls = nulls | (F.coalesce(F.map_contains_key(parsed, f), F.lit(False)) & F.try_element_at(parsed, F.lit(f)).isNull())
    ok = F.coalesce(parsed.isNotNull() & (topic != "") & ~nulls, F.lit(False))
    keep = lambda c: F.when(ok, c)
    return replies.select(
        "id", ok.alias("ok"), keep(topic).alias("canonical_topic"), keep(_enum(r, "intent", rules.INTENTS)).alias("intent"), keep(_enum(r, "audience", rules.AUDIENCES)).alias("audience"),
        keep(_enum(r, "complexity", rules.COMPLEXITIES)).alias("complexity"), keep(_list(r, "keywords")).alias("keywords"), keep(_list(r, "prerequisites")).alias("prerequisites"),
    )


def ask(prompts: DataFrame, extractor: Callable[[list[str]], list[str | None]]) -> DataFrame:
    """(id, reply) of `prompts` (id, prompt): `extractor` gets each Arrow batch of prompts in a task; a client brings its own limits and waits."""
    import pyarrow as pa

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(extractor(b.column("prompt").to_pylist()), pa.string())], names=["id", "reply"])

    return prompts.select("id", "prompt").mapInArrow(go, f"id {prompts.schema['id'].dataType.simpleString()}, reply string")
