"""URL filters: rules indexed by their rarest literal token.

A rule is a regular expression over a URL's subject (lower-case host, then
the rest as it is).  It names literal tokens that every match must hold as
whole tokens.  The rule is filed under the one that is rarest in the URLs at
hand; a URL's own tokens fetch its candidate rules, and only those run their
regular expression.  A rule without such a token is filed under the empty
token, which every URL has.

DataFrame functions only.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aislekit.llm._common import ascii_lower

#: An index of so many rules (a few hundred bytes each) may be broadcast; a larger one is joined by a shuffle.
BROADCAST_RULES = 50_000


@dataclass(frozen=True)
class Rule:
    name: str
    verdict: str
    regex: str
    tokens: tuple[str, ...]
    host_path: bool
    length: int


def host_path_rule(name: str, verdict: str) -> Rule:
    """``host/path``: the host and its subdomains, where the URL's path starts with the rule's."""
    host, slash, path = name.partition("/")
    if not slash:
        raise ValueError(f"{name}: a rule has a host and a path that starts with /")
    # the host's labels and the path's closed segments are whole tokens; an open last segment may go on
    closed = re.findall(r"[a-z0-9]+(?=[^a-z0-9])", path.lower())
    return Rule(name, verdict, rf"^(?:[^/?#]*\.)?{_quote(host.lower())}{_quote(slash + path)}",
                tuple(re.findall(r"[a-z0-9]+", host.lower())) + tuple(closed), True, len(name))


def pattern_rule(name: str, verdict: str) -> Rule:
    """A pattern: ``||`` is the start of the host or of one of its labels, ``^`` a separator or the end, ``*`` anything.

    Letters match in either case.
    """
    body = re.sub(r"\*+", "*", name.removeprefix("||")).rstrip("*")
    if not name.startswith("||"):
        body = body.lstrip("*")
    parts = {"*": ".*", "^": r"(?:[^A-Za-z0-9_.%-]|$)"}
    regex = "".join(parts.get(x) or _quote(x) for x in re.split(r"([*^])", body) if x)
    start = r"^(?:[^/?#]*\.)?" if name.startswith("||") else ""
    left = r"(?:^|(?<=[^a-z0-9*]))" if start else r"(?<=[^a-z0-9*])"
    return Rule(name, verdict, f"(?si){start}{regex}",
                tuple(re.findall(left + r"[a-z0-9]+(?=[^a-z0-9*])", body.lower())), False, len(name))


def _quote(s: str) -> str:
    return re.sub(r"([^A-Za-z0-9])", r"\\\1", s)


#: Fixed by the task.
TASK_RULES = [host_path_rule(n, v) for n, v in (
    ("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"),
    ("com/de/", "block"))]
#: Patterns of unwanted sites, this operator's own default list.
DEFAULT_PATTERNS = [pattern_rule(n, "block") for n in (
    "||spam-farm.", "||cheap-pills.", "||casino-win.", "||adult-x.", "||free-bets.", "||ads-track.",
    "/wp-login.php", "/phishing/", "/malware/*.exe^", "||doubleclick.", "||popunder-*.")]


def host_of(url: Column | str) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; empty without ://."""
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://([^/?#]*)", 1))


def path_of(url: Column | str) -> Column:
    """After the host up to ?, # or the end; empty without ://."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://[^/?#]*([^?#]*)", 1)


def subject_of(url: Column | str) -> Column:
    """What rules match: the lower-case host and all behind it."""
    return F.concat(host_of(url), F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://[^/?#]*((?s:.*))", 1))


def tokens_of(subject: Column | str) -> Column:
    """Distinct runs of letters a-z and digits, and the empty token."""
    return F.array_union(F.split(ascii_lower(subject), "[^a-z0-9]+"), F.array(F.lit("")))


def rule_table(spark: SparkSession, rules: list[Rule]) -> DataFrame:
    """The rules as rows."""
    rows = [F.struct(F.lit(i).alias("rule_id"), F.lit(r.name).alias("name"), F.lit(r.verdict).alias("verdict"),
                     F.lit(r.regex).alias("regex"), F.array(*map(F.lit, r.tokens or ("",))).alias("tokens"),
                     F.lit(r.host_path).alias("host_path"), F.lit(r.length).alias("length"))
            for i, r in enumerate(rules)]
    return spark.range(1).select(F.inline(F.array(*rows)))


def index_rules(rules: DataFrame, tokens: DataFrame) -> DataFrame:
    """Each rule under the token that the fewest URLs have; ``tokens`` is (subject, token)."""
    own = rules.select("rule_id", F.explode("tokens").alias("token"))
    seen = tokens.join(F.broadcast(own.select("token").distinct()), "token").groupBy("token").count()
    return (own.join(seen, "token", "left").groupBy("rule_id")
            .agg(F.min(F.struct(F.coalesce("count", F.lit(0)).alias("n"), "token")).alias("best"))
            .join(rules.drop("tokens"), "rule_id").withColumn("token", F.col("best.token")).drop("best"))


def judge(pages: DataFrame, rules: list[Rule], default: str = "allow", id_col: str = "page_id", url: str = "url") -> DataFrame:
    """Per page: id_col, host, path, rule, verdict, pattern.

    The longest fitting host/path rule decides; without one the longest
    fitting pattern; without that ``default``.  Of equally long rules the
    first given wins.  Null URLs and URLs without :// have an empty host and
    path and fit no host/path rule.
    """
    spark = pages.sparkSession
    pages = pages.select(F.col(id_col).alias("__id"), F.col(url).alias("__url"))
    # a verdict belongs to a URL, so each different one is judged once
    subjects = pages.where("__url is not null").select("__url").distinct().select("__url", subject_of("__url").alias("subject"))
    tokens = subjects.select("__url", "subject", F.explode(tokens_of("subject")).alias("token"))
    index = index_rules(rule_table(spark, rules), tokens)
    if len(rules) <= BROADCAST_RULES:
        index = F.broadcast(index)
    best = F.struct("host_path", "length", (-F.col("rule_id")).alias("order"), "name", "verdict")
    fits = (tokens.join(index, "token").where(F.regexp_like("subject", F.col("regex")))
            .groupBy("__url").agg(F.max(best).alias("best")))
    judged = pages.join(fits, "__url", "left")
    return judged.select(
        F.col("__id").alias(id_col), host_of("__url").alias("host"), path_of("__url").alias("path"),
        F.when(F.col("best.host_path"), F.col("best.name")).alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
        F.when(~F.col("best.host_path"), F.col("best.name")).alias("pattern"))


def op6_url_filters(pages: DataFrame) -> DataFrame:
    return judge(pages, [*TASK_RULES, *DEFAULT_PATTERNS])


ORACLE_SQL = r"""
WITH p AS (
  SELECT page_id, coalesce(url, '') AS url, strpos(coalesce(url, ''), '://') AS pos FROM pages
), q AS (
  SELECT page_id, CASE WHEN pos > 0 THEN substr(url, pos + 3) ELSE '' END AS rest FROM p
), r AS (
  SELECT page_id, rest, lower(regexp_extract(rest, '^[^/?#]*')) AS host,
         regexp_replace(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '[?#](.|\n)*$', '') AS path
  FROM q
), rules(rule, host_rule, path_rule, verdict) AS (
  VALUES ('org/', 'org', '/', 'allow'), ('example.org/es/', 'example.org', '/es/', 'block'),
         ('example.org/en/1', 'example.org', '/en/1', 'block'), ('com/fr/', 'com', '/fr/', 'allow'),
         ('com/de/', 'com', '/de/', 'block')
), patterns(pattern, expression) AS (
  VALUES ('||spam-farm.', '^(.*\.)?spam-farm\.'), ('||cheap-pills.', '^(.*\.)?cheap-pills\.'),
         ('||casino-win.', '^(.*\.)?casino-win\.'), ('||adult-x.', '^(.*\.)?adult-x\.'),
         ('||free-bets.', '^(.*\.)?free-bets\.'), ('||ads-track.', '^(.*\.)?ads-track\.'),
         ('||doubleclick.', '^(.*\.)?doubleclick\.'), ('||popunder-*.', '^(.*\.)?popunder-.*\.')
), fit AS (
  SELECT page_id, max_by(rule, length(rule)) AS rule, max_by(rules.verdict, length(rule)) AS verdict
  FROM r JOIN rules ON (host = host_rule OR ends_with(host, '.' || host_rule)) AND starts_with(path, path_rule)
  GROUP BY page_id
), hit AS (
  SELECT page_id, max_by(pattern, length(pattern)) AS pattern
  FROM r JOIN patterns ON regexp_matches(host || '/', expression) GROUP BY page_id
  UNION ALL
  SELECT page_id, '/wp-login.php' FROM r WHERE contains(lower(rest), '/wp-login.php')
)
SELECT r.page_id, r.host, r.path, fit.rule, CASE WHEN fit.rule IS NULL THEN hit.pattern END AS pattern,
       coalesce(fit.verdict, CASE WHEN hit.pattern IS NOT NULL THEN 'block' END, 'allow') AS verdict
FROM r LEFT JOIN fit USING (page_id) LEFT JOIN hit USING (page_id)
"""
