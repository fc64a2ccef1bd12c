"""URL filters: pattern rules behind an index of their rarest literal token.

A rule is compiled to a regular expression and to the literal tokens (runs of a-z, 0-9, %)
that stand whole in every URL it fits: both neighbours in the pattern are an anchor, a
separator or a literal that is no token character. The rule is filed under the rarest of
them, by counts over the whole table of URLs. A URL's tokens then look up their buckets, and
only the rules found there run their expression. Rules without such a token run on every URL.

Kinds of rules:

* site rules ``(action, host, path)``: the host and all its subdomains, path by prefix;
* patterns ``(action, text)`` in the public filter-list syntax, on the URL with A-Z
  lower-cased: ``||`` start of a host or of one of its labels, ``|`` start or end, ``*`` any
  text, ``^`` a separator or the end.

The longest fitting site rule decides. Without one, an allowing pattern, then a blocking
pattern, then ``allow``.

All is one projection over the table: the buckets are a literal of the plan, looked up by hash, so
no row moves and no key can be hot. The rules are a job's parameter, given or read from a list's file
(``read_rules``); their number, at most ``MAX_RULES``, is bounded by the size of the literal (some 100 bytes a rule).

Cases: a null URL or one without ``://`` has an empty host and path and no site rule; a null
URL fits no pattern; repeated rows are judged alike; an empty table gives no rows; columns of
the table with the names of results are not read.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from affinity.llm.common import ascii_lower, free_names

MAX_RULES = 200_000
_TOKEN = re.compile(r"[a-z0-9%]+")

SITE_RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
#: Default patterns: spam hosts by the words in their labels, and addresses that hold no article.
PATTERNS = (
    ("block", "-pills."),
    ("block", "://casino-"),
    ("block", ".casino-"),
    ("block", "-casino."),
    ("block", "-bets."),
    ("block", "://spam-"),
    ("block", "||xxx."),
    ("block", "/wp-login.php"),
    ("block", "/cgi-bin/*.exe|"),
    ("block", "^sessionid="),
    ("allow", "||*.gov^"),
    ("allow", "/robots.txt|"),
)


def _java_quote(text: str) -> str:
    return re.sub(r"([^A-Za-z0-9_])", r"\\\1", text) if text.isascii() else "\\Q" + text.replace("\\E", "\\E\\\\E\\Q") + "\\E"


@dataclass(frozen=True)
class Rule:
    action: str
    text: str
    regex: str
    site: bool
    tokens: tuple[str, ...]


def site_rule(action: str, host: str, path: str) -> Rule:
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    regex = r"(?s)^(?:[^/]*\.)?" + _java_quote(host + path) + ("" if path else "(?:/|$)")
    literal = host + (path or "/")
    whole = [m[0] for m in _TOKEN.finditer(literal.lower()) if m.end() < len(literal)]
    # A label that other characters than token characters adjoin outside ASCII is still whole: they separate.
    return Rule(action, host + path, regex, True, tuple(whole))


def pattern_rule(action: str, text: str) -> Rule:
    rest, regex, start = text.lower(), "(?s)", "*"
    if rest.startswith("||"):
        rest, regex, start = rest[2:], regex + r"^[^:/?#]*://(?:[^/?#]*\.)?", "^"
    elif rest.startswith("|"):
        rest, regex, start = rest[1:], regex + "^", "^"
    end = rest.endswith("|")
    rest = rest[:-1] if end else rest
    for part in re.split(r"([*^])", rest):
        regex += {"*": ".*", "^": "(?:[^0-9a-z_.%-]|$)"}.get(part) or _java_quote(part)
    # Open ends act as a wildcard: a token there may go on in the URL.
    framed = start + rest + ("^" if end else "*")
    tokens = [m[0] for m in _TOKEN.finditer(framed) if framed[m.start() - 1] != "*" and framed[m.end()] != "*"]
    return Rule(action, text, regex + ("$" if end else ""), False, tuple(tokens))


def compile_rules(site_rules=SITE_RULES, patterns=PATTERNS) -> list[Rule]:
    """All rules in the order in which they decide: the first that fits wins."""
    sites = sorted((site_rule(*r) for r in site_rules), key=lambda r: (-len(r.text), r.text))
    others = sorted((pattern_rule(*r) for r in patterns), key=lambda r: (r.action != "allow", r.text))
    rules = sites + others
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules; at most {MAX_RULES} fit the literal index")
    return rules


def read_rules(spark: SparkSession, path: str) -> tuple[tuple[tuple[str, str], ...], int]:
    """The patterns of a filter list's file (``@@`` allows), and how many of its lines are rules of other kinds.

    Those are rules on elements of a page (``##`` and the like), regular expressions between slashes, and rules with
    options behind ``$``, which depend on more than the URL.
    """
    lines = [r["value"].strip() for r in spark.read.text(path).limit(2 * MAX_RULES + 1).collect()]
    if len(lines) > 2 * MAX_RULES:
        raise ValueError(f"{path} has over {2 * MAX_RULES} lines")
    patterns, others = [], 0
    for line in lines:
        if not line or line[0] in "!#[":
            continue
        allow = line.startswith("@@")
        text = line[2:] if allow else line
        if re.search(r"#[@?$%]?#|\$", text) or re.fullmatch(r"/.+/", text) or not text.strip("*|^"):
            others += 1
        else:
            patterns.append(("allow" if allow else "block", text))
    return tuple(dict.fromkeys(patterns)), others


def _tokens(url: Column) -> Column:
    return F.array_distinct(F.split(ascii_lower(url), "[^a-z0-9%]+"))


class Buckets:
    """Entries filed by the hash of a token, in a literal of the plan."""

    def __init__(self, spark: SparkSession, entries: dict[str, list[int]]):
        self.n = 1 << max(1, len(entries).bit_length())
        buckets: list[list] = [[] for _ in range(self.n)]
        if entries:
            named = spark.createDataFrame([(t,) for t in entries], "token string")
            for r in named.select("token", self._place(F.col("token")).alias("b")).collect():
                buckets[r["b"]].append({"token": r["token"], "rules": entries[r["token"]]})
        self._rows = F.from_json(F.lit(json.dumps(buckets)), "array<array<struct<token:string,rules:array<int>>>>")

    def _place(self, token: Column) -> Column:
        return F.pmod(F.xxhash64(token), F.lit(self.n)).cast("int")

    def _found(self, token: Column) -> Column:
        return F.filter(F.get(self._rows, self._place(token)), lambda e: e["token"] == token)

    def has(self, token: Column) -> Column:
        return F.size(self._found(token)) > 0

    def rules(self, token: Column) -> Column:
        return F.flatten(F.transform(self._found(token), lambda e: e["rules"]))


def token_counts(urls: DataFrame, url: str, vocabulary: list[str]) -> dict[str, int]:
    """In how many URLs of the whole table each token of the rules occurs."""
    if not vocabulary:
        return {}
    known = Buckets(urls.sparkSession, {t: [] for t in vocabulary})
    found = urls.select(F.explode(F.filter(_tokens(F.col(url)), known.has)).alias("token"))
    # At most one row for each token of the rules.
    return {r["token"]: r["count"] for r in found.groupBy("token").count().collect()}


def rarest(rule: Rule, counts: dict[str, int]) -> str | None:
    return min(rule.tokens, key=lambda t: (counts.get(t, 0), -len(t), t), default=None)


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    part = lambda k: F.coalesce(F.regexp_extract(url, pattern, k), F.lit(""))
    return ascii_lower(part(1)), part(2)


def _literals(values: list[str]) -> Column:
    return F.from_json(F.lit(json.dumps(values)), "array<string>")


def filter_urls(pages: DataFrame, url: str = "url", site_rules=SITE_RULES, patterns=PATTERNS) -> DataFrame:
    """The table with url_host, url_path, url_rule (of a site rule), url_verdict, url_pattern and url_candidates.

    ``url_candidates`` is the number of rules whose expressions were run.
    """
    rules = compile_rules(site_rules, patterns)
    counts = token_counts(pages, url, sorted({t for r in rules for t in r.tokens}))
    filed: dict[str, list[int]] = {}
    for i, r in enumerate(rules):
        if t := rarest(r, counts):
            filed.setdefault(t, []).append(i)
    index = Buckets(pages.sparkSession, filed)
    always = F.from_json(F.lit(json.dumps([i for i, r in enumerate(rules) if not r.tokens])), "array<int>")
    regex, text, action = (_literals([getattr(r, a) for r in rules]) for a in ("regex", "text", "action"))
    n_sites = sum(r.site for r in rules)

    host, path = url_parts(F.col(url))
    lower = ascii_lower(F.coalesce(F.col(url), F.lit("")))
    ours = ["url_host", "url_path", "url_rule", "url_verdict", "url_pattern", "url_candidates"]
    met, best = free_names([*pages.columns, *ours], ["url_met", "url_best"])
    df = pages.withColumns({"url_host": host, "url_path": path})
    subject = F.concat("url_host", "url_path")
    hits = F.flatten(F.transform(_tokens(F.coalesce(F.col(url), F.lit(""))), index.rules))
    df = df.withColumn(met, F.concat(hits, always))
    fits = F.filter(
        met,
        lambda i: F.rlike(F.when(i < n_sites, subject).otherwise(lower), F.get(regex, i))
        & ((i >= n_sites) | F.col(url).contains("://"))
        & F.col(url).isNotNull(),
    )
    df = df.withColumn(best, F.array_min(fits))
    is_site = F.col(best) < n_sites
    return df.withColumns(
        {
            "url_rule": F.when(is_site, F.get(text, F.col(best))),
            "url_verdict": F.coalesce(F.get(action, F.col(best)), F.lit("allow")),
            "url_pattern": F.when(~is_site, F.get(text, F.col(best))),
            "url_candidates": F.size(met),
        }
    ).drop(met, best)
