"""URL rules and a list of URLs behind a blocked Bloom filter (operator 5).

Rules decide first: a rule ``host/path`` fits its host and all subdomains if
the URL's path starts with the rule's; the longest one wins. URLs without a
rule are looked up in the list by canonical form (host without ``www.`` or
``m.``, path without a last slash or ``.html``; scheme, query and fragment do
not count). The blocked Bloom filter gives each listed form one block of 256
bits, held as four longs, and sets two bits in each. Forms that the filter
passes go to an exact hash join with the list, which removes its false
positives.

The filter is broadcast while it has at most ``BROADCAST_BLOCKS`` blocks and
joined by block number beyond. Null URLs and such without ``://`` have empty
host and path, fit no rule and no list entry. Repeated rows stay; equal URLs
get equal answers. Null and empty list entries count for nothing.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablefit.llm.common import materialize, table

#: The rules of the query, fixed.
RULES = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block"))
#: The query's list: of the pages' own canonical URLs those whose MD5 digest begins
#: with these digits (an eighth), so that hosts have listed and unlisted ones.
LISTED_DIGITS = "01"

BITS_PER_ENTRY = 16
BROADCAST_BLOCKS = 1_000_000
_LONGS = 4
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: str) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(F.col(url), "://([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: str) -> Column:
    return F.coalesce(F.regexp_extract(F.col(url), "://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(host: Column, path: Column) -> Column:
    """Null without a host."""
    bare = F.regexp_replace(host, "^(?:www|m)\\.", "")
    page = F.regexp_replace(F.regexp_replace(path, "/+$", ""), "\\.html?$", "")
    return F.when(host != "", F.concat(bare, page))


def rule_for(host: Column, path: Column, rules: tuple[tuple[str, str], ...]) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict; null without one."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule, says in sorted(rules, key=lambda r: (len(r[0]), r[0])):  # longer rules wrap the shorter
        rule_host, slash, rest = rule.partition("/")
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(slash + rest)
        name, verdict = F.when(fits, rule).otherwise(name), F.when(fits, says).otherwise(verdict)
    return name, verdict


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def _masks(key: Column) -> list[Column]:
    """The bits that a form sets in the longs of its block."""
    h = F.xxhash64(key, F.lit(1))
    one = F.lit(1).cast("long")

    def bit(i: int) -> Column:
        return F.call_function("shiftleft", one, F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63)).cast("int"))

    return [bit(2 * w).bitwiseOR(bit(2 * w + 1)) for w in range(_LONGS)]


def bloom(listed: DataFrame, blocks: int) -> DataFrame:
    """``block, f0..f3`` of ``listed(form)``."""
    bits = listed.select(_block(F.col("form"), blocks).alias("block"), *[m.alias(f"m{w}") for w, m in enumerate(_masks(F.col("form")))])
    return bits.groupBy("block").agg(*[F.bit_or(f"m{w}").alias(f"f{w}") for w in range(_LONGS)])


def possible(forms: DataFrame, listed: DataFrame) -> DataFrame:
    """The rows of ``forms(form)`` that the Bloom filter of ``listed(form)`` passes."""
    count = listed.count()
    blocks = max(1, -(-count * BITS_PER_ENTRY // (64 * _LONGS)))
    table_ = bloom(listed, blocks)
    table_ = F.broadcast(table_) if blocks <= BROADCAST_BLOCKS else materialize(table_)
    inside = reduce(
        lambda a, b: a & b, [m.bitwiseAND(F.col(f"f{w}")) == m for w, m in enumerate(_masks(F.col("form")))]
    )
    return forms.withColumn("block", _block(F.col("form"), blocks)).join(table_, "block").where(inside).select("form")


def judge(pages: DataFrame, listed_urls: DataFrame, rules: tuple[tuple[str, str], ...] = RULES, url: str = "url") -> DataFrame:
    """``pages`` with ``host, path, rule, verdict``; ``listed_urls(url)`` are blocked."""
    listed = materialize(
        listed_urls.select(canonical(host_of("url"), path_of("url")).alias("form")).where("form IS NOT NULL").distinct()
    )
    split = pages.withColumns({"host": host_of(url), "path": path_of(url)})
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    split = split.withColumns({"rule": rule, "_said": verdict, "_form": canonical(F.col("host"), F.col("path"))})
    asked = split.where("rule IS NULL AND _form IS NOT NULL").select(F.col("_form").alias("form")).distinct()
    hits = possible(asked, listed)
    confirmed = materialize(hits.join(listed, "form", "left_semi").select(F.col("form").alias("_listed")))
    judged = split.join(confirmed, split["_form"] == confirmed["_listed"], "left")
    says = F.coalesce("_said", F.when(F.col("_listed").isNotNull(), "block").otherwise("allow"))
    return judged.withColumn("verdict", says).drop("_said", "_form", "_listed")


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    form = canonical(host_of("url"), path_of("url"))
    on_list = F.substring(F.md5(form.cast("binary")), 1, 1).isin(*LISTED_DIGITS)
    return judge(pages, pages.where(on_list).select("url")).select("page_id", "host", "path", "rule", "verdict")


_RULE = "CASE " + " ".join(
    f"WHEN (host = '{r.partition('/')[0]}' OR ends_with(host, '.{r.partition('/')[0]}')) AND starts_with(path, '/{r.partition('/')[2]}') "
    f"THEN '{r}'" for r, _ in sorted(RULES, key=lambda r: -len(r[0]))
) + " END"
_VERDICT = "CASE rule " + " ".join(f"WHEN '{r}' THEN '{v}'" for r, v in RULES) + " END"
_CANONICAL = r"regexp_replace(regexp_replace(regexp_replace(host, '^(?:www|m)\.', '') || path, '/+$', ''), '\.html?$', '')"
OP5_SQL = f"""
WITH s AS (
  SELECT page_id, coalesce(translate(regexp_extract(url, '://([^/?#]*)', 1), '{_UPPER}', '{_LOWER}'), '') AS host,
         coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
), r AS (SELECT *, {_RULE} AS rule, {_CANONICAL} AS form FROM s),
listed AS (SELECT DISTINCT form FROM r WHERE host <> '' AND contains('{LISTED_DIGITS}', left(md5(form), 1)))
SELECT page_id, host, path, rule,
       coalesce({_VERDICT}, CASE WHEN host <> '' AND form IN (SELECT form FROM listed) THEN 'block' ELSE 'allow' END) AS verdict
FROM r
"""
