"""URL filters: pattern rules indexed by their rarest literal token.

A rule is a regular expression over ``host + path`` together with the literal
tokens any matching URL must hold whole. Token frequencies over all pages pick
each rule's rarest token; a URL's tokens fetch its candidate rules by an
equality join on that token, and only candidates run their expression.

Rules come from lists in the program (``rule_table``) or from rule files of any
length (``read_rules``), which Spark reads and translates itself. Among patterns
that fit, exceptions come before the rest, then the first by name.

Defined results: a null URL, or one without ``://``, has an empty host and path
and gets the default verdict; URLs of any length are judged whole; repeated rows
are judged as often as they occur, repeated rules count once; other columns are
ignored.
"""

from __future__ import annotations

import re
import string
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, table

# Rules up to this many go to every task; beyond it the token join shuffles.
BROADCAST_RULES = 50_000

ALLOW, BLOCK = "allow", "block"


class Rule(NamedTuple):
    name: str        # shown in the result
    pattern: str     # over host + path
    tokens: tuple    # literal tokens that stand whole in every match
    verdict: str
    path_rule: bool  # host and path rules come before patterns; longest first


# Host and path rules (fixed values).
PATH_RULES = [
    (ALLOW, "org", "/"),
    (BLOCK, "example.org", "/es/"),
    (BLOCK, "example.org", "/en/1"),
    (ALLOW, "com", "/fr/"),
    (BLOCK, "com", "/de/"),
]

# Words that stand next to each other in the host of unwanted sites.
HOST_WORDS = [
    ("spam", "farm"), ("casino",), ("adult",), ("cheap", "pills"), ("ads", "track"),
    ("free", "bets"), ("porn",), ("xxx",), ("viagra",), ("payday", "loans"),
    ("escort",), ("warez",),
]


def words_of(literal: str) -> list[str]:
    return [w for w in re.split(r"[^0-9A-Za-z\x80-\U0010ffff]+", literal) if w]


def path_rule(verdict: str, host: str, path: str) -> Rule:
    """Fits ``host`` and its subdomains where the path starts with ``path``."""
    whole = words_of(path if not path[-1:].isalnum() else path[:len(path.rstrip(
        string.ascii_letters + string.digits))])
    return Rule(host + path, f"^(?:[^/]*\\.)?{_quote(host)}{_quote(path)}",
                tuple(words_of(host) + whole), verdict, True)


def host_rule(words: tuple, verdict: str = BLOCK) -> Rule:
    """Fits hosts in which ``words`` follow each other, between dots or hyphens."""
    return Rule("-".join(words),
                "^(?:[^/]*[.-])?" + "[.-]".join(map(_quote, words)) + "(?:[.-][^/]*)?(?:/|$)",
                tuple(words), verdict, False)


def _quote(literal: str) -> str:
    return re.sub(r"([^0-9A-Za-z/])", r"\\\1", literal)


RULES = [path_rule(*r) for r in PATH_RULES] + [host_rule(w) for w in HOST_WORDS]


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path): the host with A-Z lower-cased; both empty without ``://``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.char_length(url))).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    low = F.translate(host, string.ascii_uppercase, string.ascii_lowercase)
    return F.coalesce(low, F.lit("")), F.coalesce(path, F.lit(""))


def url_tokens(place: Column) -> Column:
    """Distinct tokens of ``host + path``; always holds the empty one, under
    which rules without a whole literal token are filed."""
    found = F.split(place, r"[^0-9A-Za-z\x{80}-\x{10FFFF}]+")
    return F.array_distinct(F.concat(found, F.array(F.lit(""))))


def rule_table(spark, rules: list[Rule]) -> DataFrame:
    rows = [(r.name, r.pattern, list(dict.fromkeys(r.tokens)) or [""], r.verdict, r.path_rule)
            for r in rules]
    return spark.createDataFrame(rows, "name string, pattern string, tokens array<string>, "
                                       "rule_verdict string, path_rule boolean")


TOKEN = r"0-9A-Za-z\x{80}-\x{10FFFF}"
#: What ``^`` stands for in a rule file: a separator or the end.
SEPARATOR = rf"(?:[^_.%{TOKEN}-]|\z)"


def read_rules(spark, path: str) -> DataFrame:
    """The rules of filter lists or hosts files (a file, a folder or a glob)."""
    return rules_of(spark.read.text(path))


def rules_of(lines: DataFrame, col: str = "value") -> DataFrame:
    """One rule per line, as ``rule_table`` gives them, named by the line.

    ``||host/path`` fits the host and its subdomains, ``|`` marks the start of
    the host or the end of the path, ``*`` is any text, ``^`` a separator or the
    end, ``@@`` an exception, ``/.../`` a regular expression over host and path
    (one that Java cannot read is an error); ``0.0.0.0 host`` lines block the
    host. Hosts are compared in lower case, paths as they stand. Left out are
    empty lines, comments (``!``, ``#``, ``[``), rules about page elements
    (``##``) and rules with options (``$``), which speak of single requests."""
    line = F.trim(F.regexp_replace(col, r"[\t\r]+", " "))
    rows = lines.select(line.alias("name")).where(
        (F.col("name") != "") & ~F.col("name").rlike(r"^[!#\[]|#@?#|\$[~0-9a-z_,=|.-]+$")).distinct()
    body = F.regexp_replace(F.regexp_replace("name", "^@@", ""),
                            r"^(?:0\.0\.0\.0|127\.0\.0\.1|::1?) +([^ #]+).*$", r"||$1^")
    rows = rows.withColumn("body", body).withColumns({
        "expression": F.col("body").rlike("^/.+/$"), "domain": F.startswith("body", F.lit("||")),
        "start": F.startswith("body", F.lit("|")), "end": F.col("body").rlike(r".\|$")})
    head = F.when(F.col("start"), F.regexp_extract("core", "^[^/^*?:]*", 0)).otherwise("")
    core = F.concat(F.translate(head, string.ascii_uppercase, string.ascii_lowercase),
                    F.substring("core", F.char_length(head) + 1, F.char_length("core")))
    rows = rows.withColumn("core", F.regexp_replace(
        "body", r"^\|\|?(?:[A-Za-z]+://)?|\|$", "")).withColumn("core", core)
    text = F.regexp_replace("core", r"([\\.+?()\[\]{}$|])", r"\\$1")
    text = F.replace(F.replace(text, F.lit("*"), F.lit(".*")), F.lit("^"), F.lit(SEPARATOR))
    pattern = F.concat(
        F.lit("(?s)"),
        F.when(F.col("domain"), r"^(?:[^/]*\.)?").when(F.col("start"), "^").otherwise(""),
        text, F.when(F.col("end"), r"\z").otherwise(""))
    # A token stands whole in every match if literal text bounds it on both sides.
    bounded = F.concat(F.when(F.col("start"), "/").otherwise("*"), "core",
                       F.when(F.col("end"), "/").otherwise("*"))
    tokens = F.array_distinct(F.regexp_extract_all(
        bounded, F.lit(f"(?<=[^*{TOKEN}])[{TOKEN}]+(?=[^*{TOKEN}])"), F.lit(0)))
    none = F.col("expression") | (F.size(tokens) == 0)
    return rows.select(
        "name", F.when(F.col("expression"), F.expr("substring(body, 2, char_length(body) - 2)"))
        .otherwise(pattern).alias("pattern"),
        F.when(none, F.array(F.lit(""))).otherwise(tokens).alias("tokens"),
        F.when(F.startswith("name", F.lit("@@")), ALLOW).otherwise(BLOCK).alias("rule_verdict"),
        F.lit(False).alias("path_rule"))


def judge(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
          default: str = ALLOW, broadcast_rules: int = BROADCAST_RULES) -> DataFrame:
    """``id_col``, ``host``, ``path``, ``rule`` (the host and path rule that
    decides, else null), ``pattern_rule`` (the pattern that comes first, else
    null), ``verdict``. ``rules``: as from ``rule_table`` or ``read_rules``."""
    host, path = split_url(F.col(url_col))
    keyed = materialize(
        pages.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"),
                     host.alias("host"), path.alias("path")), "urls")
    place = F.concat("host", "path")
    tokens = keyed.select("row", place.alias("place"),
                          F.explode(url_tokens(place)).alias("token"))
    few = rules.limit(broadcast_rules + 1).count() <= broadcast_rules

    def small(df):
        return F.broadcast(df) if few else df

    literals = rules.select("*", F.explode("tokens").alias("token"))
    frequency = (tokens.join(small(literals.select("token").distinct()), "token", "left_semi")
                 .groupBy("token").agg(F.count(F.lit(1)).alias("pages")))
    index = (literals.join(frequency, "token", "left")
             .groupBy("name", "pattern", "rule_verdict", "path_rule")
             .agg(F.min(F.struct(F.coalesce("pages", F.lit(0)), "token"))["token"].alias("token")))
    hits = (tokens.join(small(materialize(index, "url-index")), "token")
            .where(F.expr("place rlike pattern")))
    best = hits.groupBy("row").agg(
        F.max(F.when(F.col("path_rule"), F.struct(
            F.char_length("name").alias("n"), "name", "rule_verdict"))).alias("path_hit"),
        F.min(F.when(~F.col("path_rule"), F.struct(
            (F.col("rule_verdict") != ALLOW).alias("no_exception"), "name", "rule_verdict")))
        .alias("other"))
    return (keyed.join(best, "row", "left")
            .select(F.col("id").alias(id_col), "host", "path",
                    F.col("path_hit.name").alias("rule"),
                    F.col("other.name").alias("pattern_rule"),
                    F.coalesce("path_hit.rule_verdict", "other.rule_verdict", F.lit(default))
                    .alias("verdict")))


def op4_url_filter(spark, sf_dir):
    """Host, path, deciding rule and verdict of every page's URL."""
    return judge(table(spark, sf_dir, "pages"), rule_table(spark, RULES))


def _sql() -> str:
    low = f"translate(host, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
    ordered = sorted(PATH_RULES, key=lambda r: -len(r[1] + r[2]))
    fits = {h + p: f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')"
            for _, h, p in ordered}
    verdict = {h + p: v for v, h, p in ordered}
    rule = " ".join(f"WHEN {c} THEN '{n}'" for n, c in fits.items())
    judged = " ".join(f"WHEN rule = '{n}' THEN '{v}'" for n, v in verdict.items())
    other = ", ".join(f"CASE WHEN regexp_matches(host || path, '{r.pattern}') "
                      f"THEN '{r.name}' END" for r in RULES if not r.path_rule)
    return f"""
WITH a AS (SELECT page_id, CASE WHEN position('://' IN url) > 0
                  THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages),
b AS (SELECT page_id, regexp_extract(rest, '^[^/?#]*', 0) AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM a),
c AS (SELECT page_id, {low} AS host, path FROM b),
d AS (SELECT page_id, host, path, CASE {rule} END AS rule, least({other}) AS pattern_rule FROM c)
SELECT page_id, host, path, rule, pattern_rule,
       CASE {judged} WHEN pattern_rule IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict
FROM d"""


ORACLE_SQL = {"op4_url_filter": _sql()}
