"""URL filters: listed rules, and a tree of path templates for everything the rules do not reach.

Paths are cut into segments.  A place in a path, told by host and by the shapes of the segments up to it, is
variable when it holds many different values or hardly repeats any; its segments become wildcards.  What is left is a
template per host.  Pages that a rule decides serve as labels: templates that differ in their last literal only are merged
unless their share of blocked labels differs significantly from that of their siblings, and a template is rejected by its
share of blocked labels, smoothed by that of its host, which is smoothed by that of all pages.

Edge cases: a null url, or one without `://`, has empty host and path; pages of equal urls get equal results; repeated rows
are returned as often as they occur; an empty table gives no rows; without any label the verdict is allow.
"""

from pyspark.sql import Column, DataFrame, functions as F

from gridlake.llm.common import LOWER, UPPER, read_table

#: Host, path and verdict.  A rule holds for its host and all subdomains, the longest rule that fits wins.
RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
         ("com", "/fr/", "allow"), ("com", "/de/", "block"))
#: A place is variable with so many values of at most so many pages each in the mean ...
MIN_VALUES, MAX_PAGES_PER_VALUE = 10, 20
#: ... or with more than half as many values as pages, from so many pages on.
MIN_PAGES = 4
#: Templates whose share of blocked labels lies within so many standard errors of their siblings' are merged.
SIMILAR = 2.0
#: Weight of the wider group in a smoothed share, in pages, and the share from which a template is rejected.
WEIGHT, REJECT = 10.0, 0.5


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + F.lit(3))).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + F.lit(1)), "^[^?#]*", 0)
    return F.translate(host, UPPER, LOWER), path


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, as a struct of its text and verdict; null without any."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule_host, rule_path, verdict in sorted(rules, key=lambda r: len(r[0]) + len(r[1])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        found = F.when(fits, F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))
                       ).otherwise(found)
    return found


def shape(segment: Column) -> Column:
    """Letters as `a`, digits as `0`, runs of either as one."""
    return F.regexp_replace(F.regexp_replace(segment, "\\p{L}+", "a"), "[0-9]+", "0")


def parsed(pages: DataFrame, rules=RULES) -> DataFrame:
    """Distinct urls with their pages, host, path, segments and rule."""
    urls = pages.groupBy(F.coalesce("url", F.lit("")).alias("url")).agg(F.count(F.lit(1)).alias("n"))
    host, path = host_and_path(F.col("url"))
    urls = urls.select("url", "n", host.alias("host"), path.alias("path"))
    return urls.withColumns({
        "rule": rule_of(F.col("host"), F.col("path"), rules), "segments": F.split("path", "/")})


def templates(urls: DataFrame) -> DataFrame:
    """Url, host, pages, label and template; the template is the array of segments with wildcards as `*`."""
    shapes = urls.withColumn("shapes", F.transform("segments", shape))
    segments = shapes.select(
        "url", "host", "n", "rule", "shapes", F.posexplode("segments").alias("place", "segment")
    ).withColumn("context", F.xxhash64(F.slice("shapes", F.lit(1), F.col("place") + 1))).drop("shapes")
    values = segments.groupBy("host", "context", "segment").agg(F.sum("n").alias("n"))
    places = values.groupBy("host", "context").agg(
        F.count(F.lit(1)).alias("n_values"), F.sum("n").alias("n_pages"))
    variable = places.where(
        ((F.col("n_values") >= MIN_VALUES) & (F.col("n_pages") < MAX_PAGES_PER_VALUE * F.col("n_values")))
        | ((F.col("n_pages") >= MIN_PAGES) & (2 * F.col("n_values") > F.col("n_pages")))
    ).select("host", "context", F.lit(True).alias("variable"))
    known = segments.join(variable, ["host", "context"], "left")
    general = F.when(F.col("variable"), "*").otherwise(F.col("segment"))
    return known.groupBy("url").agg(
        F.first("host").alias("host"), F.first("n").alias("n"), F.first("rule").alias("rule"),
        F.sort_array(F.collect_list(F.struct("place", general.alias("segment")))).alias("parts")
    ).select("url", "host", "n", "rule", F.transform("parts", lambda p: p["segment"]).alias("template"))


def last_literal_open(template: Column) -> Column:
    """The template with its last literal as a wildcard; unchanged without one."""
    at = F.array_max(F.transform(template, lambda s, i: F.when((s != "*") & (s != ""), i)))
    return F.when(at.isNull(), template).otherwise(
        F.transform(template, lambda s, i: F.when(i == at, "*").otherwise(s)))


def judged(found: DataFrame) -> DataFrame:
    """Host, template, the branch it was merged into and the smoothed share of blocked labels."""
    labelled = F.when(F.col("rule").isNotNull(), F.col("n")).otherwise(0)
    blocked = F.when(F.col("rule.verdict") == "block", F.col("n")).otherwise(0)
    leaves = found.groupBy("host", "template").agg(
        F.sum(labelled).alias("labelled"), F.sum(blocked).alias("blocked")
    ).withColumn("merged", last_literal_open(F.col("template")))
    pools = leaves.groupBy("host", "merged").agg(
        F.sum("labelled").alias("pool_labelled"), F.sum("blocked").alias("pool_blocked"))
    compared = leaves.join(pools, ["host", "merged"])
    rest_n, rest_b = F.col("pool_labelled") - F.col("labelled"), F.col("pool_blocked") - F.col("blocked")
    share = F.col("pool_blocked") / F.greatest(F.col("pool_labelled"), F.lit(1))
    # Squared, so that no root is needed: the difference of two shares against its variance under a common share.
    gap = F.col("blocked") * rest_n - rest_b * F.col("labelled")
    variance = share * (1 - share) * F.col("labelled") * rest_n * F.col("pool_labelled")
    differs = (F.col("labelled") > 0) & (rest_n > 0) & (
        gap.cast("double") * gap > SIMILAR * SIMILAR * variance)
    branches = compared.withColumn("branch", F.when(differs, F.col("template")).otherwise(F.col("merged")))
    per_branch = branches.groupBy("host", "branch").agg(
        F.sum("labelled").alias("branch_labelled"), F.sum("blocked").alias("branch_blocked"))
    per_host = leaves.groupBy("host").agg(
        F.sum("labelled").alias("host_labelled"), F.sum("blocked").alias("host_blocked"))
    # A few sums a host, added up once more: all labels.
    every = per_host.agg((F.coalesce(F.sum("host_blocked"), F.lit(0))
                          / F.greatest(F.coalesce(F.sum("host_labelled"), F.lit(0)), F.lit(1))).alias("share"))

    def smooth(b, n, wider):
        return (F.col(b) + WEIGHT * wider) / (F.col(n) + WEIGHT)

    wide = per_host.select("host", smooth("host_blocked", "host_labelled", every.scalar()).alias("host_share"))
    scored = per_branch.join(wide, "host").select(
        "host", "branch", smooth("branch_blocked", "branch_labelled", F.col("host_share")).alias("blocked_share"))
    return branches.select("host", "template", "branch").join(scored, ["host", "branch"])


def url_filters(pages: DataFrame, rules=RULES, reject: float = REJECT) -> DataFrame:
    """page_id, host, path, rule, verdict, template (the branch of the tree) and blocked_share of every page."""
    urls = parsed(pages, rules)
    found = templates(urls)
    verdicts = found.select("url", "host", "template").join(judged(found), ["host", "template"]).select(
        "url", F.array_join("branch", "/").alias("template"), "blocked_share")
    host, path = host_and_path(F.col("address"))
    listed = rule_of(F.col("host"), F.col("path"), rules)
    rows = pages.select("page_id", F.coalesce("url", F.lit("")).alias("address"))
    return rows.join(verdicts, rows["address"] == verdicts["url"]).select(
        "page_id", host.alias("host"), path.alias("path"), "template", "blocked_share"
    ).withColumn("listed", listed).select(
        "page_id", "host", "path", F.col("listed.rule").alias("rule"),
        F.coalesce(F.col("listed.verdict"), F.when(F.col("blocked_share") >= reject, "block").otherwise("allow"))
        .alias("verdict"), "template", F.round("blocked_share", 9).alias("blocked_share"))


def op4_url_filters(spark, sf_dir):
    return url_filters(read_table(spark, sf_dir, "pages"))


ORACLE_SQL = f"""
with urls as (
  select url, n, translate(host, '{UPPER}', '{LOWER}') as host,
         regexp_extract(substr(rest, length(host) + 1), '^[^?#]*') as path
  from (
    select *, regexp_extract(rest, '^[^/?#]*') as host
    from (select coalesce(url, '') as url, count(*) as n,
                 case when instr(coalesce(url, ''), '://') > 0
                      then substr(coalesce(url, ''), instr(coalesce(url, ''), '://') + 3) else '' end as rest
          from pages group by all))),
rules(rule, rule_host, rule_path, verdict) as (values
  {", ".join(f"('{h}{p}', '{h}', '{p}', '{v}')" for h, p, v in RULES)}),
ruled as (
  select urls.*, rule, verdict
  from urls left join rules
    on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path)
  qualify row_number() over (partition by url order by length(rule) desc nulls last) = 1),
segments as (
  select url, host, n, rule, verdict, place, segment,
         list_transform(parts[1:place], lambda s: regexp_replace(
           regexp_replace(s, '\\p{{L}}+', 'a', 'g'), '[0-9]+', '0', 'g')) as context
  from (select *, unnest(parts) as segment, unnest(range(1, len(parts) + 1)) as place
        from (select *, string_split(path, '/') as parts from ruled))),
variable as (
  select host, context
  from (select host, context, segment, sum(n) as n from segments group by all)
  group by host, context
  having (count(*) >= {MIN_VALUES} and sum(n) < {MAX_PAGES_PER_VALUE} * count(*))
      or (sum(n) >= {MIN_PAGES} and 2 * count(*) > sum(n))),
found as (
  select url, any_value(s.host) as host, any_value(n) as n, any_value(rule) as rule, any_value(verdict) as verdict,
         list(case when v.host is not null then '*' else segment end order by place) as template
  from segments s left join variable v on s.host = v.host and s.context = v.context group by url),
leaves as (
  select *, case when spot = 0 then template
                 else list_transform(template, lambda s, i: case when i = spot then '*' else s end) end as merged
  from (select *, coalesce(list_max(list_transform(template, lambda s, i:
                    case when s <> '*' and s <> '' then i else 0 end)), 0) as spot
        from (select host, template, sum(case when rule is not null then n else 0 end) as labelled,
                     sum(case when verdict = 'block' then n else 0 end) as blocked
              from found group by host, template))),
branches as (
  select *, case when labelled > 0 and pool_n > labelled and
      power(blocked * (pool_n - labelled) - (pool_b - blocked) * labelled, 2) >
      {SIMILAR * SIMILAR} * (pool_b / pool_n) * (1 - pool_b / pool_n) * labelled * (pool_n - labelled) * pool_n
    then template else merged end as branch
  from (select *, sum(labelled) over (partition by host, merged) as pool_n,
               sum(blocked) over (partition by host, merged) as pool_b from leaves)),
hosts as (
  select host, (sum(blocked) + {WEIGHT} * share) / (sum(labelled) + {WEIGHT}) as host_share
  from leaves, (select coalesce(sum(blocked), 0) / greatest(coalesce(sum(labelled), 0), 1) as share from leaves)
  group by host, share),
scored as (
  select host, branch, (sum(blocked) + {WEIGHT} * any_value(host_share)) / (sum(labelled) + {WEIGHT}) as blocked_share
  from branches join hosts using (host) group by host, branch)
select p.page_id, u.host, u.path, u.rule,
       coalesce(u.verdict, case when blocked_share >= {REJECT} then 'block' else 'allow' end) as verdict,
       array_to_string(b.branch, '/') as template, round(blocked_share, 9) as blocked_share
from pages p join ruled u on coalesce(p.url, '') = u.url
join found f on f.url = u.url
join branches b on b.host = f.host and b.template = f.template
join scored s on s.host = b.host and s.branch = b.branch
"""
