"""URL filters: a blocked Bloom filter before an exact hash join, and longest-match rules. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORDS = 8  # 64-bit words of a block; a key sets one bit in each
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FILTER_BLOCKS = 1 << 16  # 4 MB: the largest filter that is broadcast
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without one."""
    return F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def canonical(url: Column) -> Column:
    """The form in which URLs are listed: host without ``www.``, path without its last ``/``, query without utm_ and ref arguments; no scheme, no fragment; null without a host."""
    host = F.regexp_replace(host_of(url), r"^www\.", "")
    path = F.regexp_replace(path_of(url), "/$", "")
    query = F.regexp_extract(_rest(url), r"^[^?#]*\?([^#]*)", 1)
    query = F.array_join(F.filter(F.split(query, "&"), lambda q: ~q.rlike("^(utm_[^=]*|ref)(=|$)") & (q != "")), "&")
    return F.when(host != "", F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise("")))


def bloom_filter(listed: DataFrame, url: str, blocks: int) -> DataFrame:
    """(block, w0..w7): each listed URL sets a bit in every word of its one block."""
    key = F.col(url)
    bits = [F.expr(f"shiftleft(1L, cast(pmod(xxhash64({i}, `{url}`), 64) as int))").alias(f"w{i}") for i in range(WORDS)]
    rows = listed.select(F.pmod(F.xxhash64(F.lit("block"), key), F.lit(blocks)).alias("filter_block"), *bits)
    return rows.groupBy("filter_block").agg(*(F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)))


def listed_urls(pages: DataFrame, listed: DataFrame, url: str = "url", bits_per_url: int = 16) -> DataFrame:
    """pages plus ``canonical_url`` and ``is_listed``: whether its canonical URL is on the list.

    listed: one column ``url``, of any size; those without a host are dropped and repeats count once. A blocked
    Bloom filter of about ``bits_per_url`` bits a URL passes possible hits; only these rows meet
    the list, in an exact hash join that removes false positives. Rows that the filter stops
    go past the join. The filter is broadcast up to FILTER_BLOCKS blocks of 64 bytes; beyond that
    its blocks are joined by a shuffle. A url without a host is on no list.
    """
    keys = listed.select(canonical(F.col("url")).alias("listed_url")).where("listed_url is not null").distinct()
    n = keys.count()
    blocks = max(1, -(-n * bits_per_url // (64 * WORDS)))
    bloom = bloom_filter(keys, "listed_url", blocks)
    if blocks <= FILTER_BLOCKS:
        bloom = F.broadcast(bloom)
    key = canonical(F.col(f"`{url}`"))
    rows = pages.select(F.struct(*[F.col(f"`{c}`") for c in pages.columns]).alias("page"), key.alias("canonical_url"), F.pmod(F.xxhash64(F.lit("block"), key), F.lit(blocks)).alias("filter_block"))
    tests = [f"(w{i} & shiftleft(1L, cast(pmod(xxhash64({i}, canonical_url), 64) as int))) <> 0" for i in range(WORDS)]
    rows = rows.join(bloom, "filter_block", "left").select("page", "canonical_url", F.coalesce(F.expr(" and ".join(tests)), F.lit(False)).alias("may_hit"))
    hits = rows.where("may_hit").join(keys.hint("shuffle_hash"), F.col("canonical_url") == F.col("listed_url"), "left")
    found = hits.select("page", "canonical_url", F.col("listed_url").isNotNull().alias("is_listed"))
    found = found.unionByName(rows.where("not may_hit").select("page", "canonical_url", F.lit(False).alias("is_listed")))
    return found.select(*_fields("page", pages.columns, ("canonical_url", "is_listed")), "canonical_url", "is_listed")


def _fields(struct: str, columns: list[str], but: tuple) -> list[Column]:
    return [F.col(f"{struct}.`{c}`").alias(c) for c in columns if c not in but]


def rule_for(host: Column, path: Column, rules=RULES) -> Column:
    """The rule that fits: struct(rule, action), or null.

    rules: (action, host, path prefix), a bounded list. A rule fits its host and all
    subdomains where the path starts with its own. The rule whose host and path are longest
    together wins, then the one with the longer host.
    """
    found = F.lit(None).cast("struct<rule:string,action:string>")
    for action, rule_host, prefix in sorted(rules, key=lambda r: (len(r[1] + r[2]), len(r[1]))):
        fits = ((host == rule_host) | F.endswith(host, F.lit("." + rule_host))) & F.startswith(path, F.lit(prefix))
        found = F.when(fits, F.struct(F.lit(rule_host + prefix).alias("rule"), F.lit(action).alias("action"))).otherwise(found)
    return found


def judge(pages: DataFrame, listed: DataFrame, rules=RULES, url: str = "url") -> DataFrame:
    """pages plus host, path, rule and verdict: the rule's action, else block for a listed URL and allow for the rest.

    A null url, or one without ``://``, has an empty host and path, no rule, and is allowed.
    Columns of pages with these names are replaced.
    """
    rows = listed_urls(pages, listed, url)
    host, path = F.coalesce(host_of(F.col(f"`{url}`")), F.lit("")), F.coalesce(path_of(F.col(f"`{url}`")), F.lit(""))
    rows = rows.select(F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("page"), host.alias("host"), path.alias("path"))
    judged = rows.select("page", "host", "path", rule_for(F.col("host"), F.col("path"), rules).alias("found"))
    listed_verdict = F.when(F.col("page.is_listed"), "block").otherwise("allow")
    new = [F.col("host"), F.col("path"), F.col("found.rule").alias("rule"), F.coalesce("found.action", listed_verdict).alias("verdict")]
    columns = [*(c for c in pages.columns if c not in ("canonical_url", "is_listed")), "canonical_url", "is_listed"]
    return judged.select(*_fields("page", columns, ("host", "path", "rule", "verdict")), *new)


#: The list of the query below: English pages of hosts that advertise gambling, pills or trackers. Other pages of these hosts aren't listed.
LISTED_HOSTS, LISTED_PATH = "(^|[.])(casino-win|free-bets|cheap-pills|ads-track)[.]", "^/en/"


def block_list(pages: DataFrame) -> DataFrame:
    """The list for the query, in the spelling of such lists: another scheme, capital hosts with ``www.``, a last ``/`` and a tracking argument.

    So only the canonical form of a listed URL equals that of its page, and of any other page that differs in these respects.
    """
    url = F.col("url")
    host, path, query = host_of(url), path_of(url), F.regexp_extract(_rest(url), r"^[^?#]*\?([^#]*)", 1)
    listed = pages.where(host.rlike(LISTED_HOSTS) & path.rlike(LISTED_PATH))
    name = F.concat(F.lit("WWW."), F.translate(F.regexp_replace(host, r"^www\.", ""), LOWER, UPPER))
    return listed.select(F.concat(F.lit("ftp://"), name, F.regexp_replace(path, "/$", ""), F.lit("/?utm_source=list&"), query).alias("url"))


def op9_url_filter(spark, sf_dir: str) -> DataFrame:
    """Contract query: all pages; the rules are RULES, the list is ``block_list``."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return judge(pages, block_list(pages)).select("page_id", "host", "path", "rule", "verdict")


OP9_SQL = f"""
with u as (
  select page_id, url, case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end as rest from pages),
h as (
  select page_id, translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'), '{UPPER}', '{LOWER}') as host,
         regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) as path, regexp_extract(coalesce(rest, ''), '^[^?#]*\\?([^#]*)', 1) as query from u),
c as (
  select *, case when host <> '' then regexp_replace(host, '^www[.]', '') || regexp_replace(path, '/$', '')
    || coalesce('?' || nullif(array_to_string(list_filter(string_split(query, '&'), lambda q: q <> '' and not regexp_matches(q, '^(utm_[^=]*|ref)(=|$)')), '&'), ''), '') end as form from h),
l as (select distinct form as listed from c where regexp_matches(host, '{LISTED_HOSTS}') and regexp_matches(path, '{LISTED_PATH}')),
r as (
  select page_id, host, path, listed, case
    when (host = 'example.net' or ends_with(host, '.example.net')) and starts_with(path, '/en/') then 'example.net/en/'
    when (host = 'example.com' or ends_with(host, '.example.com')) and starts_with(path, '/de/') then 'example.com/de/'
    when (host = 'org' or ends_with(host, '.org')) and starts_with(path, '/fr/') then 'org/fr/'
    when (host = 'net' or ends_with(host, '.net')) and starts_with(path, '/') then 'net/' end as rule from c left join l on c.form = l.listed)
select page_id, host, path, rule, case
  when rule in ('net/', 'example.com/de/') then 'block' when rule is not null then 'allow'
  when listed is not null then 'block' else 'allow' end as verdict
from r
"""
