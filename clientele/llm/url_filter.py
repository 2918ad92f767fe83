"""URL filters: host and path rules, and a weighted vocabulary of URL terms.

A rule decides where one fits. For all other URLs an Aho-Corasick automaton
finds the terms of the vocabulary; a find counts if no ASCII letter or digit
touches it. One strict term, or several distinct soft terms, reject the URL.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientele.llm.common import ascii_lower

STRICT = ("porn", "xxx", "hentai", "warez", "phishing", "malware", "escort")
SOFT = (
    "adult", "bet", "casino", "cheap", "crack", "dating", "free-download", "gambling",
    "keygen", "loan", "lottery", "pills", "poker", "serial", "torrent", "viagra",
)
#: A URL is rejected when its distinct terms weigh so much together.
LIMIT = 2
VOCABULARY = {**{t: LIMIT for t in STRICT}, **{t: 1 for t in SOFT}}

AUTHORITY = r"(?s)^.*?://([^/?#]*)"
PATH = r"(?s)^.*?://[^/?#]*([^?#]*)"


@dataclass(frozen=True)
class Rule:
    """Fits ``host`` and its subdomains where the path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        return ((host == self.host) | host.endswith("." + self.host)) & path.startswith(self.path)


@lru_cache(maxsize=8)
def automaton(terms: tuple[tuple[str, int], ...]) -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for term, weight in terms:
        found.add_word(term, (term, weight))
    found.make_automaton()
    return found


def weight(url: str | None, terms: tuple[tuple[str, int], ...]) -> int:
    """Weight of the distinct terms of a lower-cased URL that nothing touches."""
    if not url or not terms:
        return 0
    edge = lambda i: not (0 <= i < len(url) and url[i].isascii() and url[i].isalnum())
    return sum(
        w
        for _, w in {
            (term, w)
            for end, (term, w) in automaton(terms).iter(url)
            if edge(end - len(term)) and edge(end + 1)
        }
    )


def url_weight(url: Column, vocabulary: Mapping[str, int]) -> Column:
    terms = tuple(sorted(vocabulary.items()))

    @F.pandas_udf("long")
    def weights(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for urls in batches:
            yield pd.Series([weight(u, terms) for u in urls], dtype="int64")

    return weights(ascii_lower(url))


def judge_urls(
    pages: DataFrame,
    rules: Sequence[Rule] = (),
    vocabulary: Mapping[str, int] = VOCABULARY,
    limit: int = LIMIT,
    url: str = "url",
) -> DataFrame:
    """Add ``host``, ``path``, ``rule``, ``term_weight`` and ``verdict``.

    Host and path of a URL that is null or has no ``://`` are empty. The
    longest fitting rule decides; ``rule`` is null where none fits, and then
    the vocabulary decides. A null URL is allowed. Columns of these names that
    ``pages`` has already are replaced. Terms are lower-case ASCII.
    """
    whole = F.col(url)
    host = ascii_lower(F.coalesce(F.regexp_extract(whole, AUTHORITY, 1), F.lit("")))
    path = F.coalesce(F.regexp_extract(whole, PATH, 1), F.lit(""))
    judged = pages.withColumns({"host": host, "path": path})
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: len(r.text)):  # the longest comes outermost
        fits = r.fits(F.col("host"), F.col("path"))
        rule = F.when(fits, F.lit(r.text)).otherwise(rule)
        verdict = F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    by_terms = F.when(F.col("term_weight") >= limit, F.lit("block")).otherwise(F.lit("allow"))
    return judged.withColumn("term_weight", url_weight(whole, vocabulary)).withColumns(
        {"rule": rule, "verdict": F.coalesce(verdict, by_terms)}
    )
