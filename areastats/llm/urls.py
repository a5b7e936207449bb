"""URL filters: pattern rules indexed by their rarest literal token."""

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

TOKEN = "[a-z0-9]+"


@dataclass(frozen=True)
class Rule:
    """A verdict for urls whose `host + path` the pattern finds.

    `tokens` are literal runs of a-z0-9 that every such url holds whole (in lower case).
    """

    name: str
    verdict: str
    pattern: str
    tokens: tuple[str, ...]


def prefix_rule(verdict: str, host: str, path: str) -> Rule:
    """Fits a host and its subdomains where the url's path starts with `path`."""
    whole = re.findall(TOKEN, host) + re.findall(TOKEN, re.sub(r"[A-Za-z0-9]+$", "", path).lower())
    return Rule(host + path, verdict, rf"^(?:[^/]*\.)?{re.escape(host)}{re.escape(path)}", tuple(whole))


def host_rule(word: str, verdict: str = "block") -> Rule:
    """Fits hosts with this word between dots or dashes."""
    return Rule(word, verdict, rf"^(?:[^/]*[.-])?{re.escape(word)}(?:[.-][^/]*)?(?:/|$)", (word,))


#: The rules that have the last word.
PREFIX_RULES = (
    prefix_rule("allow", "org", "/"),
    prefix_rule("block", "example.org", "/es/"),
    prefix_rule("block", "example.org", "/en/1"),
    prefix_rule("allow", "com", "/fr/"),
    prefix_rule("block", "com", "/de/"),
)
#: Words in host names that block a url no prefix rule judges.
BLOCKED = ("spam", "casino", "bets", "poker", "jackpot", "porn", "xxx", "escort", "viagra", "pills", "warez", "torrent", "malware", "phishing", "payday")
HOST_RULES = tuple(host_rule(w) for w in BLOCKED)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path; both empty for null and without `://`."""
    rest = F.when(F.contains(url, F.lit("://")), F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(host, upper, upper.lower()), path


class Index:
    """Rules by the token that the fewest urls hold; rules without a token are tried always."""

    def __init__(self, rules: tuple[Rule, ...], frequency: dict[str, int]):
        self.by_token: dict[str, list[tuple[Rule, re.Pattern]]] = {}
        self.always: list[tuple[Rule, re.Pattern]] = []
        for rule in rules:
            entry = (rule, re.compile(rule.pattern))
            if rule.tokens:
                rarest = min(rule.tokens, key=lambda t: (frequency.get(t, 0), t))
                self.by_token.setdefault(rarest, []).append(entry)
            else:
                self.always.append(entry)

    def longest(self, target: str) -> Rule | None:
        """The rule with the longest name of those that fit; the first by name of equals."""
        fits = [rule for rule, pattern in self.always if pattern.search(target)]
        for token in set(re.findall(TOKEN, target.lower())):
            fits += [rule for rule, pattern in self.by_token.get(token, ()) if pattern.search(target)]
        return min(fits, key=lambda r: (-len(r.name), r.name)) if fits else None


def token_frequency(urls: DataFrame, rules: tuple[Rule, ...]) -> dict[str, int]:
    """In how many urls each token of the rules occurs; one row per token reaches the driver."""
    wanted = sorted({t for r in rules for t in r.tokens})
    if not wanted:
        return {}
    tokens = F.regexp_extract_all(F.lower(F.concat("host", "path")), F.lit(TOKEN), F.lit(0))
    listed = F.array_intersect(tokens, F.array(*[F.lit(t) for t in wanted]))
    return {r[0]: r[1] for r in urls.select(F.explode(listed).alias("token")).groupBy("token").count().collect()}


def judged(
    pages: DataFrame, rules: tuple[Rule, ...] = PREFIX_RULES, others: tuple[Rule, ...] = HOST_RULES, default: str = "allow",
    id_col: str = "page_id", url_col: str = "url",
) -> DataFrame:
    """(page_id, host, path, rule, verdict, matched) of every page.

    `rule` is the longest of `rules` that fits, and gives the verdict. Without one the longest of
    `others` does, or the default; `matched` names the rule of either kind. Null urls and urls without `://`
    have an empty host and path, which no rule fits. Repeated rows give repeated results. Only the url
    column is read, twice: to find the rarest tokens, and to judge.
    """
    host, path = host_and_path(F.col(url_col).cast("string"))
    urls = pages.select(F.col(id_col).cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    frequency = token_frequency(urls, rules + others)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = Index(rules, frequency), Index(others, frequency)
        for batch in batches:
            names, verdicts, matched = [], [], []
            for target_host, target_path in zip(batch.column("host").to_pylist(), batch.column("path").to_pylist(), strict=True):
                rule = first.longest(target_host + target_path)
                other = rule or second.longest(target_host + target_path)
                names.append(rule.name if rule else None)
                verdicts.append(other.verdict if other else default)
                matched.append(other.name if other else None)
            columns = [*batch.columns, pa.array(names, pa.string()), pa.array(verdicts, pa.string()), pa.array(matched, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "host", "path", "rule", "verdict", "matched"])

    return urls.mapInArrow(run, "page_id long, host string, path string, rule string, verdict string, matched string")


#: The result of `judged` with its defaults.
URLS_SQL = r"""
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut
), rules(verdict, rule_host, rule_path) AS (
  VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
), words(word) AS (
  SELECT unnest([{words}])
), fits AS (
  SELECT p.*, r.rule_host || r.rule_path AS rule, r.verdict FROM parts p LEFT JOIN rules r
    ON (p.host = r.rule_host OR ends_with(p.host, '.' || r.rule_host)) AND starts_with(p.path, r.rule_path)
), best AS (
  SELECT * FROM fits QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(rule) DESC NULLS LAST, rule) = 1
)
SELECT page_id, host, path, rule, CASE WHEN rule IS NOT NULL THEN verdict
  WHEN list_has_any(string_split_regex(host, '[.-]'), (SELECT list(word) FROM words)) THEN 'block' ELSE 'allow' END AS verdict
FROM best
""".replace("{words}", ", ".join(f"'{w}'" for w in BLOCKED))
