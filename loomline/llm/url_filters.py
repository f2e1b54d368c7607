"""URL filters: rules indexed by their rarest literal token.

A rule is a host rule (a host with all its subdomains and a path prefix) or a
pattern rule (a regular expression over the lower-cased URL).  For each rule
the literal tokens (runs of a-z and 0-9) are found that any fitting URL must
hold as whole tokens.  The rule is filed under the rarest of them, by counts
over all URLs.  The tokens of a URL fetch candidate rules, and only those are
tried.  Alternatives of a pattern are filed apart, so that a pattern that
begins with a choice of words has a token too; a rule of which an alternative
has none is tried on every URL.

The longest fitting host rule decides; else a fitting pattern rule blocks
(or allows, the first in the list winning); else the URL is allowed.

Defined results: a null URL or one without ``://`` has empty host and path, so
no host rule fits it.  Very long URLs are judged whole, repeated rows one by
one; an empty table gives no row; columns of the result's names are replaced.  The rules are a
parameter on the driver; ``MAX_RULES`` bounds what is broadcast.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from re import _constants as sre
from re import _parser as sre_parser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import fresh

MAX_RULES = 1_000_000
MAX_ALTERNATIVES = 64
TOKEN = re.compile(r"[a-z0-9]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path of a URL."""
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    m = re.match(r"([^/?#]*)([^?#]*)", rest, re.S)
    return m[1].translate(LOWER), m[2]


def _clean(items: list, last: bool) -> bool:
    """Whether the neighbouring side of ``items`` can't be a token's character."""
    if not items:
        return False
    op, arg = items[-1 if last else 0]
    if op is sre.LITERAL:
        return not TOKEN.fullmatch(chr(arg).lower())
    if op is sre.AT:
        return arg in (sre.AT_BEGINNING, sre.AT_BEGINNING_STRING, sre.AT_END, sre.AT_END_STRING)
    if op is sre.IN:
        return all(o is sre.LITERAL and not TOKEN.fullmatch(chr(a).lower()) for o, a in arg)
    if op is sre.SUBPATTERN:
        return _clean(list(arg[3]), last)
    if op is sre.BRANCH:
        return all(_clean(list(x), last) for x in arg[1])
    return False


def _flat(items: list) -> list:
    """``items`` with plain groups opened."""
    out = []
    for op, arg in items:
        if op is sre.SUBPATTERN and not arg[1] and not arg[2]:
            out += _flat(list(arg[3]))
        else:
            out.append((op, arg))
    return out


def alternatives(pattern: str) -> list[list]:
    """The parsed pattern as up to ``MAX_ALTERNATIVES`` sequences, of which each match fits one."""
    done: list[list] = [[]]
    waiting = _flat(list(sre_parser.parse(pattern)))
    while waiting:
        op, arg = waiting.pop(0)
        if op is sre.BRANCH and len(done) * len(arg[1]) <= MAX_ALTERNATIVES:
            done = [d + _flat(list(way)) for d in done for way in arg[1]]
        else:
            done = [[*d, (op, arg)] for d in done]
    return done


def pattern_tokens(pattern: str) -> list[set[str]]:
    """For each alternative of ``pattern``: tokens that every string matched by it holds as whole tokens."""
    return list(map(set, dict.fromkeys(frozenset(_whole_tokens(items)) for items in alternatives(pattern))))


def _whole_tokens(items: list) -> set[str]:
    out, i = set(), 0
    while i < len(items):
        j = i
        while j < len(items) and items[j][0] is sre.LITERAL and TOKEN.fullmatch(chr(items[j][1]).lower()):
            j += 1
        if j > i and _clean(items[:i], True) and _clean(items[j:], False):
            out.add("".join(chr(a) for _, a in items[i:j]).lower())
        i = max(j, i + 1)
    return out


@dataclass(frozen=True)
class HostRule:
    verdict: str
    host: str
    path: str = "/"

    @property
    def name(self) -> str:
        return self.host + self.path

    def tokens(self) -> list[set[str]]:
        whole = self.path.lower() if not TOKEN.search(self.path.lower()[-1:]) else self.path.lower().rpartition(TOKEN.findall(self.path.lower())[-1])[0]
        return [{*TOKEN.findall(self.host), *TOKEN.findall(whole)}]

    def fits(self, url: str, host: str, path: str) -> bool:
        return (host == self.host or host.endswith("." + self.host)) and path.startswith(self.path)


@dataclass(frozen=True)
class PatternRule:
    verdict: str
    pattern: str

    @property
    def name(self) -> str:
        return self.pattern

    def tokens(self) -> list[set[str]]:
        return pattern_tokens(self.pattern)

    def fits(self, url: str, host: str, path: str) -> bool:
        return re.search(self.pattern, url) is not None


#: Pattern rules of the method, over lower-cased URLs: sessions, logins, carts, archives and programs, trackers, forms.
PATTERNS = (
    PatternRule("block", r"/wp-login\.php(?:[?#]|$)"),
    PatternRule("block", r"[?&]phpsessionid="),
    PatternRule("block", r"[?&]jsessionid="),
    PatternRule("block", r"/cgi-bin/"),
    PatternRule("block", r"/checkout/cart(?:[/?#]|$)"),
    PatternRule("block", r"\.exe(?:[?#]|$)"),
    PatternRule("block", r"[./]doubleclick\.net/"),
    PatternRule("block", r"/(?:ad|ads)/(?:click|track)"),
    PatternRule("block", r"/wp-admin/"),
    PatternRule("block", r"/xmlrpc\.php(?:[?#]|$)"),
    PatternRule("block", r"[?&](?:sessionid|phpsessid|replytocom)="),
    PatternRule("block", r"/(?:signin|signup|login|logout|register)(?:[/?#]|$)"),
    PatternRule("block", r"/cart/(?:add|remove)(?:[/?#]|$)"),
    PatternRule("block", r"\.(?:zip|rar|iso|apk|dmg|msi)(?:[?#]|$)"),
    PatternRule("block", r"[./](?:googlesyndication|adnxs|scorecardresearch)\.com/"),
    PatternRule("block", r"/(?:print|email)-this-page(?:[/?#]|$)"),
)


@dataclass
class RuleIndex:
    """Rules filed under one token each."""

    by_token: dict[str, list] = field(default_factory=dict)
    always: list = field(default_factory=list)
    order: dict = field(default_factory=dict)

    @classmethod
    def build(cls, rules: list, counts: dict[str, int]) -> RuleIndex:
        out = cls()
        for n, rule in enumerate(rules):
            out.order[rule] = n
            ways = rule.tokens()
            if all(ways):
                for token in {min(way, key=lambda t: (counts.get(t, 0), t)) for way in ways}:
                    out.by_token.setdefault(token, []).append(rule)
            else:
                out.always.append(rule)
        return out

    def judge(self, url: str | None) -> tuple[str, str, str | None, str]:
        """Host, path, the deciding host rule or None, and the verdict."""
        host, path = split_url(url)
        low = (url or "").lower()
        tried = list(self.always)
        for token in set(TOKEN.findall(low)):
            tried += self.by_token.get(token, ())
        fitting = [r for r in dict.fromkeys(tried) if r.fits(low, host, path)]
        hosts = [r for r in fitting if isinstance(r, HostRule)]
        if hosts:
            best = max(hosts, key=lambda r: (len(r.name), -self.order[r]))
            return host, path, best.name, best.verdict
        patterns = [r for r in fitting if isinstance(r, PatternRule)]
        return host, path, None, min(patterns, key=self.order.__getitem__).verdict if patterns else "allow"


def token_counts(urls: DataFrame, url: str, rules: list) -> dict[str, int]:
    """How many URL tokens of the whole table equal each literal token of the rules."""
    wanted = sorted({t for r in rules for way in r.tokens() for t in way})
    if not wanted:
        return {}
    spark = urls.sparkSession
    tokens = urls.select(F.explode(F.split(F.lower(F.col(url).cast("string")), "[^a-z0-9]+")).alias("token"))
    known = spark.createDataFrame([(t,) for t in wanted], "token string")
    return {r["token"]: r["n"] for r in tokens.join(F.broadcast(known), "token").groupBy("token").agg(F.count("*").alias("n")).collect()}


def judge_urls(urls: DataFrame, rules: list, url: str = "url") -> DataFrame:
    """``urls`` with the columns host, path, rule and verdict (replaced if there)."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    index = urls.sparkSession.sparkContext.broadcast(RuleIndex.build(rules, token_counts(urls, url, rules)))

    @F.pandas_udf("host string, path string, rule string, verdict string")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([index.value.judge(None if pd.isna(u) else u) for u in batch], columns=["host", "path", "rule", "verdict"])

    at = fresh(urls, "judged")
    out = urls.withColumn(at, judge(F.col(url).cast("string")))
    for name in ("host", "path", "rule", "verdict"):
        out = out.withColumn(name, F.col(at)[name])
    return out.drop(at)
