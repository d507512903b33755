"""Page addresses judged by pattern rules that are fetched by their rarest literal token.

Every rule is a regular expression with the literal tokens that an address must have for
it to match. Tokens are counted over all addresses, and a rule is filed under its rarest
one. An address fetches the rules filed under its own tokens and runs only those; rules
without a literal token always run. Host and path rules are patterns like all others.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

# The rules are a parameter; every worker holds them.
MOST_RULE_BYTES = 64_000_000
_TOKEN = re.compile("[a-z0-9]+")
_UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@dataclass(frozen=True)
class Rule:
    """``pattern`` is searched in ``://host`` and all that follows, the host in lower case.

    ``tokens`` are runs of a-z and 0-9 that stand alone, in any case, in every address the
    pattern matches. ``name`` is what a decision by the rule reports. Among matching rules
    the highest ``weight`` decides, then the earlier rule.
    """

    verdict: str
    pattern: str
    tokens: tuple[str, ...] = ()
    name: str | None = None
    weight: int = 0


def site_rule(verdict: str, site: str) -> Rule:
    """``host/path``: fits the host and its subdomains, and paths that begin so."""
    host, slash, path = site.partition("/")
    # the last token of a path may go on in an address
    closed = re.sub("[a-z0-9]+$", "", (slash + path).translate(_UPPER))
    tokens = (*_TOKEN.findall(host), *_TOKEN.findall(closed))
    pattern = rf"^://([^/?#]*\.)?{re.escape(host)}{re.escape(slash + path)}"
    return Rule(verdict, pattern, tokens, site, len(site))


# The rules by host and path.
SITE_RULES = (
    site_rule("allow", "org/"),
    site_rule("block", "example.org/es/"),
    site_rule("block", "example.org/en/1"),
    site_rule("allow", "com/fr/"),
    site_rule("block", "com/de/"),
)
# What decides where no rule by host and path fits: words of unwanted sites, and pages that
# are forms or carry a session.
UNWANTED = ("ads", "adult", "bets", "betting", "casino", "pills", "poker", "porn", "spam", "warez")
PATTERN_RULES = tuple(
    Rule("block", rf"^://([^/?#]*[.-])?{word}[.-]", (word,), weight=-1) for word in UNWANTED
) + (
    Rule("block", r"^://[^/?#]*/([^?#]*/)?(login|signin|cart|checkout)([/?#.]|$)", weight=-1),
    Rule("block", r"[?&](sessionid|phpsessid|sid)=", weight=-1),
)


def token_counts(pages: DataFrame, rules: Sequence[Rule]) -> dict[str, int]:
    """In how many addresses each token of the rules stands: no more rows than tokens."""
    tokens = sorted({t for rule in rules for t in rule.tokens})
    if not tokens:
        return {}
    spark = pages.sparkSession
    wanted = spark.createDataFrame([(t,) for t in tokens], "token string")
    found = pages.select(F.explode(F.array_distinct(F.split(F.lower("url"), "[^a-z0-9]+"))).alias("token"))
    counted = found.join(F.broadcast(wanted), "token").groupBy("token").count().collect()
    return {r["token"]: r["count"] for r in counted}


def file_rules(rules: Sequence[Rule], counts: dict[str, int]) -> tuple[dict[str, list[int]], list[int]]:
    """The rules' numbers by their rarest token, and those that have none."""
    index: dict[str, list[int]] = {}
    always: list[int] = []
    for number, rule in enumerate(rules):
        if rule.tokens:
            rarest = min(rule.tokens, key=lambda t: (counts.get(t, 0), t))
            index.setdefault(rarest, []).append(number)
        else:
            always.append(number)
    return index, always


def parse(url: str | None) -> tuple[str, str, str]:
    """Host, path, and the text that patterns are searched in."""
    before, mark, rest = (url or "").partition("://")
    if not mark:
        return "", "", before
    end = re.search("[/?#]", rest)
    host = rest[: end.start()] if end else rest
    tail = rest[len(host) :]
    host = host.translate(_UPPER)
    return host, re.split("[?#]", tail, maxsplit=1)[0], f"://{host}{tail}"


def judge(
    spark: SparkSession,
    pages: DataFrame,
    rules: Sequence[Rule] = SITE_RULES + PATTERN_RULES,
    default: str = "allow",
) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict.

    The host stands after the first ``://``, up to a slash, question mark, hash sign or the
    end; the path goes on from there up to a question mark, hash sign or the end. Both are
    empty for a null url or one without ``://``; patterns are then searched in the url as it
    is. ``rule`` is the deciding rule's name; it is null if a rule without a name or
    ``default`` decides. Repeated rows are judged each. Other columns are not read.
    """
    if sum(len(r.pattern) + len(r.name or "") for r in rules) > MOST_RULE_BYTES:
        raise ValueError(f"more than {MOST_RULE_BYTES} bytes of rules")
    index, always = file_rules(rules, token_counts(pages, rules))
    shared = spark.sparkContext.broadcast(([(r.pattern, r.weight, r.name, r.verdict) for r in rules], index, always))

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, filed, unfiled = shared.value
        compiled: dict[int, re.Pattern] = {}

        def matches(number: int, text: str) -> bool:
            if number not in compiled:
                compiled[number] = re.compile(held[number][0])
            return compiled[number].search(text) is not None

        for batch in batches:
            hosts, paths, names, verdicts = [], [], [], []
            for url in batch.column("url").to_pylist():
                host, path, text = parse(url)
                numbers = {n for t in set(_TOKEN.findall(text.lower())) for n in filed.get(t, ())}
                fit = [n for n in (*numbers, *unfiled) if matches(n, text)]
                best = max(fit, key=lambda n: (held[n][1], -n), default=None)
                hosts.append(host)
                paths.append(path)
                names.append(None if best is None else held[best][2])
                verdicts.append(default if best is None else held[best][3])
            columns = [pa.array(x, pa.string()) for x in (hosts, paths, names, verdicts)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), *columns], ["page_id", "host", "path", "rule", "verdict"]
            )

    page_id = pages.schema["page_id"].dataType.simpleString()
    schema = f"page_id {page_id}, host string, path string, rule string, verdict string"
    return pages.select("page_id", "url").mapInArrow(judged, schema)
