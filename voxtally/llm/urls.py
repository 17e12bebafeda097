"""URL filtering by pattern rules that are indexed under their rarest literal token.

A rule lists the literal tokens that every URL it fits must contain. It is filed
under the one that is rarest among the URLs at hand; a URL's tokens fetch the
rules filed under them, and only those run their regular expression.
"""

from __future__ import annotations

import re
import string
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_RULES = 10_000  # up to so many rules the index is broadcast, else joined by token
SPLIT = "[^A-Za-z0-9]+"


@dataclass(frozen=True)
class Rule:
    """``pattern`` is searched in host and path; ``tokens`` are runs of letters and digits it needs whole.

    ``firm`` rules decide by themselves, the longest name first; the others
    decide only where no firm rule fits.
    """

    name: str
    pattern: str
    tokens: tuple[str, ...]
    action: str
    firm: bool = False


def host_rule(name: str, action: str) -> Rule:
    """The rule for a host with its subdomains and a path prefix, written ``host/path``."""
    pattern = r"^(?:[^/]*\.)?" + name.replace(".", r"\.")
    return Rule(name, pattern, tuple(t for t in re.split(SPLIT, name) if t), action, firm=True)


def word_rule(*tokens: str) -> Rule:
    """Block hosts in which these tokens follow each other."""
    inner = "[^A-Za-z0-9/]+".join(tokens)
    return Rule("-".join(tokens), rf"^(?:[^/]*[^A-Za-z0-9/])?{inner}(?:[^A-Za-z0-9/][^/]*)?(?:/|$)", tokens, "block")


HOST_RULES = (host_rule("net/", "block"), host_rule("example.net/en/", "allow"), host_rule("example.com/de/", "block"), host_rule("org/fr/", "allow"))
WORD_RULES = (
    word_rule("casino"), word_rule("free", "bets"), word_rule("cheap", "pills"), word_rule("spam"), word_rule("adult"), word_rule("ads"), word_rule("track"),
)


def with_host_and_path(pages: DataFrame, url: str = "url", host: str = "host", path: str = "path") -> DataFrame:
    """Host (A-Z lower-cased) and path; both empty for a null url or one without ``://``."""
    parts = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    found = F.coalesce(F.col(url), F.lit(""))
    lowered = F.translate(F.regexp_extract(found, parts, 1), string.ascii_uppercase, string.ascii_lowercase)
    return pages.withColumns({host: lowered, path: F.regexp_extract(found, parts, 2)})


def judge(pages: DataFrame, rules: tuple[Rule, ...] = HOST_RULES + WORD_RULES, url: str = "url", default: str = "allow") -> DataFrame:
    """All pages with ``host``, ``path``, ``rule``, ``verdict`` and ``fired`` (names of the other rules that fit).

    ``rule`` is the longest firm rule that fits, with its action as verdict; else
    null, with ``block`` if any other rule fits and ``default`` if none. Each
    distinct url is judged once, so repeats cost nothing; a null or empty url
    fits no rule. Columns of ``pages`` with the five names are replaced. An empty
    table gives an empty one.
    """
    made = ("host", "path", "rule", "verdict", "fired")
    pages = with_host_and_path(pages.drop(*[c for c in made if c != url]), url)
    spark = pages.sparkSession
    targets = pages.filter("host <> '' or path <> ''").select(F.concat("host", "path").alias("__target")).distinct()
    tokens = targets.withColumn("__token", F.explode(F.array_distinct(F.split("__target", SPLIT))))

    rows = [(i, r.name, r.pattern, list(r.tokens), r.action, r.firm) for i, r in enumerate(rules)]
    table = spark.createDataFrame(rows, "__id int, __name string, __pattern string, __tokens array<string>, __action string, __firm boolean")
    near = F.broadcast if len(rules) <= BROADCAST_RULES else lambda df: df
    named = table.select("__id", F.explode("__tokens").alias("__token"))
    frequency = tokens.join(near(named.select("__token").distinct()), "__token").groupBy("__token").agg(F.count("*").alias("__n"))
    # A token that no url has comes first of all: its rules then fetch nothing, as they must.
    rarest = named.join(frequency, "__token", "left").groupBy("__id").agg(F.min_by("__token", F.struct(F.coalesce("__n", F.lit(0)), "__token")).alias("__token"))
    index = rarest.join(table, "__id").drop("__tokens", "__id")

    fits = tokens.join(near(index), "__token").filter(F.regexp_like("__target", F.col("__pattern")))
    firm, length = F.col("__firm"), F.length("__name")
    judged = fits.groupBy("__target").agg(
        F.max_by(F.when(firm, F.col("__name")), F.when(firm, F.struct(length, "__name"))).alias("rule"),
        F.max_by(F.when(firm, F.col("__action")), F.when(firm, F.struct(length, "__name"))).alias("__firm_action"),
        F.sort_array(F.collect_set(F.when(~firm, F.col("__name")))).alias("fired"),
    )
    joined = pages.withColumn("__target", F.concat("host", "path")).join(judged, "__target", "left")
    verdict = F.coalesce("__firm_action", F.when(F.size("fired") > 0, F.lit("block")), F.lit(default))
    kept = [c for c in pages.columns if c not in made or c == url]
    return joined.select(*kept, "host", "path", "rule", verdict.alias("verdict"), F.coalesce("fired", F.array().cast("array<string>")).alias("fired"))
