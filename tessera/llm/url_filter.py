"""URL filter: host and path rules, then a weighted vocabulary.

A rule names a host, with its subdomains, and a start of the path; the longest
fitting one decides. Other URLs are judged by words: one Aho-Corasick pass finds
all vocabulary terms, hits inside longer words are dropped, and a URL is blocked
on one strict term or when the weights of its distinct soft terms reach a limit.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
#: One of these blocks a URL.
STRICT = ("casino", "escort", "porn", "spam", "viagra", "xxx")
#: Weights of terms of which several distinct ones block a URL.
SOFT = {"adult": 1.0, "bet": 1.0, "bets": 1.0, "betting": 1.0, "cheap": 1.0, "farm": 0.5, "free": 0.5, "loan": 1.0, "pills": 1.0, "poker": 1.0, "prize": 1.0, "slots": 1.0, "win": 1.0}
SOFT_LIMIT = 2.0
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: Column) -> Column:
    """After the first ://, up to /, ?, # or the end, A-Z lower-cased; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def url_path(url: Column) -> Column:
    """What follows the host, up to ? or # or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _judge(strict: tuple[str, ...], soft: dict[str, float], limit: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ahocorasick

        automaton = ahocorasick.Automaton()
        for term in {*strict, *soft}:
            automaton.add_word(term, term)
        if len(automaton):
            automaton.make_automaton()
        sure = set(strict)
        for batch in batches:
            hits, blocked = [], []
            for url in batch.column(0).to_pylist():
                text, found = (url or "").lower(), set()
                for end, term in automaton.iter(text) if len(automaton) else ():
                    start = end - len(term) + 1
                    if not (start and text[start - 1].isalnum()) and not text[end + 1 : end + 2].isalnum():
                        found.add(term)
                hits.append(sorted(found))
                blocked.append(bool(found & sure) or sum(soft.get(t, 0) for t in found) >= limit)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(hits, pa.list_(pa.string())), pa.array(blocked, pa.bool_())], names=[*batch.schema.names, "terms", "blocked"])

    return run


def judge_urls(
    pages: DataFrame,
    rules: tuple[tuple[str, str], ...] = RULES,
    strict: tuple[str, ...] = STRICT,
    soft: dict[str, float] | None = None,
    soft_limit: float = SOFT_LIMIT,
) -> DataFrame:
    """One row per row of ``pages``: page_id, host, path, rule (the longest
    fitting one, else null), verdict (``allow`` or ``block``), terms (the
    distinct vocabulary terms of the URL, sorted).

    A URL that is null or has no ``://`` has an empty host and path and no rule;
    a null one has no terms. Terms are lower-case and count between characters
    that are neither letters nor digits, anywhere in the URL, in either case. Of
    equally long fitting rules the first in the list decides. Only page_id and
    url are read. An empty table gives an empty result.
    """
    judged = pages.select(F.col("url").alias("url"), F.col("page_id").alias("page_id"))
    schema = f"url string, page_id {judged.schema['page_id'].dataType.simpleString()}, terms array<string>, blocked boolean"
    judged = judged.mapInArrow(_judge(tuple(strict), dict(SOFT if soft is None else soft), soft_limit), schema)
    judged = judged.select("*", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    rule = verdict = None
    for action, text in sorted(rules, key=lambda r: -len(r[1])):
        host, slash, path = text.partition("/")
        fits = ((F.col("host") == host) | F.endswith("host", F.lit("." + host))) & F.startswith("path", F.lit(slash + path))
        rule = F.when(fits, text) if rule is None else rule.when(fits, text)
        verdict = F.when(fits, action) if verdict is None else verdict.when(fits, action)
    own = F.when(F.col("blocked"), "block").otherwise("allow")
    return judged.select(
        "page_id", "host", "path",
        (F.lit(None).cast("string") if rule is None else rule).alias("rule"),
        (own if verdict is None else verdict.otherwise(own)).alias("verdict"),
        "terms",
    )
