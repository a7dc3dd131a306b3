"""URL filter: fixed host and path rules first, then a weighted vocabulary found by an Aho-Corasick automaton.

A *strict* term rejects by one hit.  *Soft* terms reject when at least ``soft_needed`` distinct ones occur.
A hit counts only between boundaries: the bytes before and after it are no ASCII letters or digits.

Null urls and urls without ``://`` have an empty host and path; the vocabulary is still searched in what
there is, so a null url is allowed.  Repeated rows and ties need no rule: rows are judged one by one.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class Vocabulary:
    """Terms in lower case and the number of distinct soft terms that rejects."""

    strict: Sequence[str] = ("porn", "xxx", "casino", "warez", "phishing", "escort", "viagra")
    soft: Sequence[str] = ("adult", "bet", "cheap", "crack", "free", "loan", "nude", "pills", "poker", "sex", "torrent", "win")
    soft_needed: int = 2
    weights: dict[str, float] = field(default_factory=lambda: {"strict": 1.0, "soft": 0.4})


RULES = (
    Rule("block", "net", "/"),
    Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"),
)


def ascii_lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path): the host from after the first ``://`` to ``/``, ``?``, ``#`` or the end; then the path to ``?`` or ``#``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return ascii_lower(host), path


def matching_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """Name and verdict of the longest rule that fits, or null."""
    longest_first = sorted(rules, key=lambda r: (-len(r.name), r.name))
    fits = [
        F.when(
            ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path),
            F.struct(F.lit(r.name).alias("rule"), F.lit(r.verdict).alias("verdict")),
        )
        for r in longest_first
    ]
    return F.coalesce(*fits, F.lit(None).cast("struct<rule:string,verdict:string>"))


def automaton(vocabulary: Vocabulary) -> ahocorasick.Automaton:
    out = ahocorasick.Automaton()
    for kind in ("soft", "strict"):  # a term in both lists is strict
        for term in getattr(vocabulary, kind):
            if term:
                out.add_word(term, (kind, term))
    if len(out):
        out.make_automaton()
    return out


def term_hits(url: str, machine: ahocorasick.Automaton) -> tuple[int, list[str]]:
    """(strict hits, distinct soft terms) between boundaries."""
    strict, soft = 0, set()
    if url and len(machine):
        for end, (kind, term) in machine.iter(url):
            start = end - len(term) + 1
            before, after = url[start - 1 : start] if start else "", url[end + 1 : end + 2]
            if (before.isascii() and before.isalnum()) or (after.isascii() and after.isalnum()):
                continue
            if kind == "strict":
                strict += 1
            else:
                soft.add(term)
    return strict, sorted(soft)


def filter_urls(
    pages: DataFrame,
    rules: Sequence[Rule] = RULES,
    vocabulary: Vocabulary | None = None,
    id_col: str = "page_id",
    url_col: str = "url",
) -> DataFrame:
    """(page_id, host, path, rule, verdict, strict_hits, soft_terms, weight) of every row."""
    vocabulary = vocabulary or Vocabulary()
    url = F.col("url")
    host, path = url_parts(url)
    judged = (
        pages.select(F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url_col}`").cast("string").alias("url"))
        .select("page_id", host.alias("host"), path.alias("path"), F.coalesce(ascii_lower(url), F.lit("")).alias("lowered"))
        .withColumn("fit", matching_rule(F.col("host"), F.col("path"), rules))
        .select("page_id", "host", "path", F.col("fit.rule").alias("rule"), F.col("fit.verdict").alias("ruled"), "lowered")
    )
    schema = "page_id bigint, host string, path string, rule string, verdict string, strict_hits bigint, soft_terms string, weight double"

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton(vocabulary)
        for batch in batches:
            found = [term_hits(u, machine) for u in batch["lowered"].to_pylist()]
            verdicts = [
                r or ("block" if strict or len(soft) >= vocabulary.soft_needed else "allow")
                for r, (strict, soft) in zip(batch["ruled"].to_pylist(), found, strict=True)
            ]
            weight = [
                vocabulary.weights.get("strict", 1.0) * strict + vocabulary.weights.get("soft", 0.0) * len(soft)
                for strict, soft in found
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch["page_id"].cast(pa.int64()),
                    batch["host"],
                    batch["path"],
                    batch["rule"],
                    pa.array(verdicts, pa.string()),
                    pa.array([s for s, _ in found], pa.int64()),
                    pa.array([",".join(soft) for _, soft in found], pa.string()),
                    pa.array(weight, pa.float64()),
                ],
                names=["page_id", "host", "path", "rule", "verdict", "strict_hits", "soft_terms", "weight"],
            )

    return judged.mapInArrow(search, schema)
