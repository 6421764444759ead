"""URL rules behind an index of their rarest literal tokens, in DataFrame functions only.

Each rule is a regular expression with the literal tokens that every match contains. A rule is filed under the one of its
tokens that the fewest URLs contain. A URL's tokens fetch the rules filed under them, and only these expressions run.

Two kinds of rules share the index. Place rules (a host and a path prefix, block or allow) fit a host with all its subdomains; the longest that fits
decides, and among equally long ones block. Where none fits, the URL is blocked if any pattern rule matches, and allowed otherwise.

Rules are constants of the plan: their number is bounded by MOST_RULES and checked, the data decide nothing but the choice of tokens.

Defined results: a missing url, and one without `://`, has empty host and path, fits no place rule and is allowed unless a pattern
rule matches. Repeated rows are judged alike. An empty table gives an empty table.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MOST_RULES = 2000
#: What the expressions ask for beside a literal; letters beyond ASCII end a token too.
_TOKENS = "[^a-z0-9]+"


@dataclass(frozen=True)
class Rule:
    name: str
    verdict: str
    pattern: str
    tokens: tuple[str, ...]
    placed: bool


def tokens_of(text: str) -> list[str]:
    return [t for t in re.split(_TOKENS, text.lower()) if t]


def place_rule(verdict: str, name: str) -> Rule:
    """`host/path`: matched against lower-cased host, then path."""
    host, _, path = name.partition("/")
    return Rule(name, verdict, rf"^(?:[^/]*\.)?{_quote(host)}{_quote('/' + path)}", tuple(tokens_of(name)), True)


def _quote(text: str) -> str:
    return re.sub(r"([^A-Za-z0-9/])", r"\\\1", text)


def pattern_rule(name: str, pattern: str, *tokens: str) -> Rule:
    """A pattern on the lower-cased URL, and whole tokens that each match contains."""
    return Rule(name, "block", pattern, tuple(t.lower() for t in tokens), False)


PLACES = [place_rule("block", "net/"), place_rule("allow", "example.net/en/"), place_rule("block", "example.com/de/"), place_rule("allow", "org/fr/")]

#: Hosts of gambling, pills, adult, spam, tracking and phishing pages.
PATTERNS = [
    pattern_rule("casino", r"(?:^|[^a-z0-9])casino[-.]", "casino"),
    pattern_rule("bets", r"://(?:[^/?#]*[.-])?(?:free|live)-bets[.-]", "bets"),
    pattern_rule("poker", r"://(?:[^/?#]*[.-])?poker[.-]", "poker"),
    pattern_rule("pills", r"://(?:[^/?#]*[.-])?(?:cheap|buy|online)-pills[.-]", "pills"),
    pattern_rule("viagra", r"[^a-z0-9]viagra[^a-z0-9]", "viagra"),
    pattern_rule("xxx", r"://(?:[^/?#]*\.)?xxx[.-]", "xxx"),
    pattern_rule("adult", r"://(?:[^/?#]*[.-])?adult-[a-z]+\.", "adult"),
    pattern_rule("porn", r"[^a-z0-9]porn[^a-z0-9]", "porn"),
    pattern_rule("loans", r"://(?:[^/?#]*[.-])?(?:payday|fast|easy)-loans[.-]", "loans"),
    pattern_rule("spam", r"://(?:[^/?#]*[.-])?spam-[a-z]+[.-]", "spam"),
    pattern_rule("tracking", r"://(?:[^/?#]*[.-])?ads-track[.-]", "ads", "track"),
    pattern_rule("phishing", r"://(?:[^/?#]*[.-])?(?:login|verify)-account[.-]", "account"),
]


def host_of(url):
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(url, instr(url, '://') + 3)"))
    return F.coalesce(F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url):
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(url, instr(url, '://') + 3)"))
    return F.coalesce(F.regexp_extract(rest, r"^[^/?#]*(/[^?#]*)", 1), F.lit(""))


def _frequencies(rows: DataFrame, rules: list[Rule]) -> dict[str, int]:
    """How many URLs contain each literal token of the rules."""
    literal = sorted({t for r in rules for t in r.tokens})
    if not literal:
        return {}
    met = F.explode(F.array_intersect("tokens", F.array(*map(F.lit, literal))))
    return {r[0]: r[1] for r in rows.select(met.alias("t")).groupBy("t").count().collect()}


def index(rules: list[Rule], frequencies: dict[str, int]) -> dict[str, list[Rule]]:
    """Rules by the rarest of their tokens; the first in the alphabet among equally rare ones."""
    found: dict[str, list[Rule]] = {}
    for rule in rules:
        if not rule.tokens:
            raise ValueError(f"rule {rule.name} has no literal token")
        found.setdefault(min(rule.tokens, key=lambda t: (frequencies.get(t, 0), t)), []).append(rule)
    return found


def judge(pages: DataFrame, places: list[Rule] = PLACES, patterns: list[Rule] = PATTERNS) -> DataFrame:
    """page_id, host, path, rule and verdict of each row of pages (page_id, url)."""
    rules = [*places, *patterns]
    if len(rules) > MOST_RULES:
        raise ValueError(f"{len(rules)} rules; the index is a constant of the plan and holds at most {MOST_RULES}")
    url = F.col("url")
    rows = pages.select("page_id", "url").withColumns({"host": host_of(url), "path": path_of(url), "tokens": F.split(F.lower("url"), _TOKENS)})
    filed = index(rules, _frequencies(rows, rules))
    order = {r.name: (-len(r.name), r.verdict != "block") if r.placed else (1, 0) for r in rules}
    ranked = sorted(rules, key=lambda r: order[r.name])
    entry = lambda r: F.struct(F.lit(ranked.index(r)).alias("rank"), F.lit(r.pattern).alias("pattern"), F.lit(r.placed).alias("placed"),
                               F.lit(r.name).alias("name"), F.lit(r.verdict).alias("verdict"))
    table = F.create_map(*[c for t, rs in sorted(filed.items()) for c in (F.lit(t), F.array(*[entry(r) for r in rs]))])
    # a rule is fetched once: it is filed under one token, and array_intersect gives each token once
    fetched = F.flatten(F.transform(F.array_intersect("tokens", F.array(*map(F.lit, sorted(filed)))), lambda t: F.element_at(table, t)))
    placed, low = F.concat("host", "path"), F.lower("url")
    hits = F.filter(F.col("fetched"), lambda r: F.when(r["placed"], F.rlike(placed, r["pattern"])).otherwise(F.rlike(low, r["pattern"])))
    best = F.array_min(F.transform(hits, lambda r: F.struct(r["rank"].alias("rank"), r["placed"].alias("placed"), r["name"].alias("name"), r["verdict"].alias("verdict"))))
    return (rows.withColumn("fetched", F.coalesce(fetched, F.array().cast("array<struct<rank:int,pattern:string,placed:boolean,name:string,verdict:string>>")))
            .withColumn("best", best)
            .select("page_id", "host", "path", F.when(F.col("best.placed"), F.col("best.name")).alias("rule"),
                    F.coalesce("best.verdict", F.lit("allow")).alias("verdict"), F.when(~F.col("best.placed"), F.col("best.name")).alias("pattern_rule")))
