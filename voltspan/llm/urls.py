"""URL filter: hand-written host and path rules, and association rules mined from labelled URLs beyond them.

Hand-written rules come first: a rule fits its host and all subdomains, if the path starts with the rule's;
the longest that fits decides. What no rule covers is judged by combinations of URL tokens. Spark's FP-growth
mines the frequent combinations of tokens and verdicts over labelled URLs; a combination becomes a rule for a
verdict if the share of its URLs with this verdict (its confidence) is high enough, its count passes the
support, and it is surer than every rule with one token less. The rules are kept in an inverted index under
their rarest token: a URL looks up its own tokens and checks the few rules found there. Among rules that match,
the surest decides, then the one with more support, then the longer, then by name; without any, URLs are allowed.

Labels are the verdicts of the hand-written rules, and, where none fits, the ``labels`` row with the page's id:
toxic 1 is ``block``, anything else ``allow``. Several label rows of one id block if any does.

Defined results: a null URL or one without ``://`` has an empty host and path, no tokens, and is allowed; a null
page_id has no label of the table; repeated rows count and are judged each; without labels no rules are mined;
ties between rules go by the order above. Extra columns of the pages are ignored.

Scale: only ids and URLs are read. All labelled URLs and all their frequent tokens are mined. FP-growth lists every
frequent combination, so it takes baskets of at most ``BASKET`` frequent tokens, of which 2**BASKET / MIN_SUPPORT are
frequent at most. Where a URL has more, equal baskets are counted together and the combinations grow level by level
(``by_levels``): one that always has the same verdict, or as many URLs as with a token less, is not extended, as
no longer rule could be surer. Both ways give the same rules. Matching covers all URLs and all their tokens and
shuffles nothing; rules are broadcast in blocks of ``BLOCK_RULES``, with one more scan for each further block.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

from voltspan.llm.common import append_columns
from voltspan.session import fits_broadcast, stage

MIN_SUPPORT = 0.005
# a rule needs as many URLs even where that is a larger share
LEAST_COUNT = 5
MIN_CONFIDENCE = 0.8
# the longest baskets that FP-growth takes
BASKET = 12
BLOCK_RULES = 50_000
_HASHES = 1 << 20
_CAPITALS, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Rule(NamedTuple):
    """A verdict for a host with its subdomains, below a path."""

    verdict: str
    host: str
    path: str


RULES = (
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)


def url_parts(url: Column) -> dict[str, Column]:
    """host (A-Z lowered) and path; both empty for a null URL or one without ``://``."""
    url = F.coalesce(url, F.lit(""))
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    return {
        "host": F.translate(F.regexp_extract(url, pattern, 1), _CAPITALS, _SMALL),
        "path": F.regexp_extract(url, pattern, 2),
    }


def listed(host: Column, path: Column, rules: Sequence[Rule] = RULES) -> Column:
    """The longest rule that fits, as a struct (rule, verdict), or null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: (len(r.host) + len(r.path), len(r.host))):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        out = F.when(fits, F.struct(F.lit(rule.host + rule.path).alias("rule"), F.lit(rule.verdict).alias("verdict"))).otherwise(out)
    return out


def tokens(url: Column, host: Column, path: Column) -> Column:
    """Distinct tokens: scheme, host labels, the last two labels, path words with digits as 0, names of parameters."""
    def named(prefix: str, words: Column) -> Column:
        return F.transform(F.filter(words, lambda w: w != ""), lambda w: F.concat(F.lit(prefix), w))

    given = F.coalesce(url, F.lit(""))
    query = F.regexp_extract(given, r"(?s)^.*?://[^?#]*\?([^#]*)", 1)
    found = F.concat(
        named("scheme ", F.array(F.substring_index(given, "://", 1))),
        named("host ", F.split(host, r"\.")),
        named("site ", F.array(F.substring_index(host, ".", -2))),
        named("path ", F.split(F.regexp_replace(F.lower(path), "[0-9]+", "0"), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")),
        named("query ", F.transform(F.split(query, "&"), lambda p: F.substring_index(p, "=", 1))),
    )
    return F.when(given.contains("://"), F.array_sort(F.array_distinct(found))).otherwise(F.array().cast("array<string>"))


def prepared(pages: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """page_id, host, path, tokens, and the verdict of the hand-written rules."""
    parts = pages.select("page_id", "url", *[c.alias(n) for n, c in url_parts(F.col("url")).items()])
    rows = parts.select(
        "page_id",
        "host",
        "path",
        tokens(F.col("url"), F.col("host"), F.col("path")).alias("tokens"),
        listed(F.col("host"), F.col("path"), rules).alias("by_list"),
    )
    return rows.select("page_id", "host", "path", "tokens", "by_list.rule", F.col("by_list.verdict").alias("listed"))


def labelled(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(page_id, tokens, verdict) of ``prepared`` pages whose verdict is known."""
    known = labels.filter("doc_id is not null").groupBy(F.col("doc_id").alias("page_id")).agg(
        F.max(F.when(F.col("toxic") == 1, "block").otherwise("allow")).alias("labelled")
    )
    by_rule = pages.filter("listed is not null").select("page_id", "tokens", F.col("listed").alias("verdict"))
    by_label = pages.filter("listed is null").join(known, "page_id").select("page_id", "tokens", F.col("labelled").alias("verdict"))
    return by_rule.unionByName(by_label).filter(F.size("tokens") > 0)


def _by_growth(baskets: DataFrame, least: int) -> DataFrame:
    """(tokens, verdict, support, seen) of all combinations of ``baskets`` with ``least`` URLs of a verdict, by FP-growth."""
    items = baskets.select(F.concat("tokens", F.array(F.concat(F.lit("="), "verdict"))).alias("items"))
    # support is a share of the mined rows; half a row less keeps ``least`` rows on the right side of rounding
    miner = FPGrowth(itemsCol="items", minSupport=(least - 0.5) / max(1, baskets.count()), minConfidence=1.0)
    sets = miner.fit(items).freqItemsets.select(F.array_sort("items").alias("items"), F.col("freq").alias("seen"))
    sets = stage(sets, "url-itemsets")
    with_verdict = sets.filter("exists(items, x -> startswith(x, '='))").select(
        F.filter("items", lambda x: ~x.startswith("=")).alias("tokens"),
        F.expr("substring(filter(items, x -> startswith(x, '='))[0], 2)").alias("verdict"),
        F.col("seen").alias("support"),
    )
    without = sets.filter("not exists(items, x -> startswith(x, '='))").select(F.col("items").alias("tokens"), "seen")
    return with_verdict.filter(F.size("tokens") > 0).join(without, "tokens").select("tokens", "verdict", "support", "seen")


def by_levels(baskets: DataFrame, least: int) -> DataFrame:
    """(tokens, verdict, support, seen) of the combinations of ``baskets`` (tokens, verdict) that can be rules.

    These are the combinations with ``least`` URLs of a verdict of which every part has more URLs, and not all of
    them of one verdict: any other is beaten by one of its parts.
    """
    rows = baskets.groupBy("tokens", "verdict").agg(F.count("*").alias("times")).withColumn("key", F.monotonically_increasing_id())
    # a combination is its first tokens and its last one; it is held by the baskets that have them all
    holds = stage(rows, "url-shapes").select(
        "key", "verdict", "times", F.array().cast("array<string>").alias("head"), F.explode("tokens").alias("last")
    )
    found, alive = [], None
    while True:
        counts = holds.groupBy("head", "last", "verdict").agg(F.sum("times").alias("support"))
        sets = counts.groupBy("head", "last").agg(
            F.sum("support").alias("seen"), F.max("support").alias("most"), F.collect_list(F.struct("verdict", "support")).alias("by_verdict")
        ).filter(F.col("most") >= least).withColumn("tokens", F.concat("head", F.array("last")))
        if alive is not None:
            parts = sets.select("tokens", "seen", F.explode(F.transform("tokens", lambda t: F.array_except("tokens", F.array(t)))).alias("part"))
            more = alive.select(F.col("tokens").alias("part"), F.col("seen").alias("larger"))
            whole = parts.join(more, "part").filter("larger > seen").groupBy("tokens").count().filter(F.col("count") == F.size("tokens"))
            sets = sets.join(whole.select("tokens"), "tokens", "left_semi")
        sets = stage(sets, "url-sets")
        found.append(sets.select("tokens", "seen", F.inline("by_verdict")).filter(F.col("support") >= least))
        alive = sets.filter("most < seen")
        if alive.isEmpty():
            return reduce(DataFrame.unionByName, found).select("tokens", "verdict", "support", "seen")
        held = holds.join(alive.select("head", "last"), ["head", "last"], "left_semi")
        after = held.select("key", "head", F.col("last").alias("next"))
        holds = stage(
            held.join(after, ["key", "head"]).filter("last < next").select(
                "key", "verdict", "times", F.concat("head", F.array("last")).alias("head"), F.col("next").alias("last")
            ),
            "url-holds",
        )


RULE_COLUMNS = "tokens array<string>, verdict string, support long, confidence double, rarest string"


def mine(
    labelled: DataFrame,
    min_support: float = MIN_SUPPORT,
    least_count: int = LEAST_COUNT,
    min_confidence: float = MIN_CONFIDENCE,
    sample_rows: int | None = None,
    basket: int = BASKET,
) -> DataFrame:
    """Association rules (tokens, verdict, support, confidence, rarest) of a table with tokens and verdict.

    All rows are mined, unless ``sample_rows`` asks for about as many of them; other columns, say an id, only take
    part in drawing that sample. Baskets of up to ``basket`` frequent tokens are mined by FP-growth, longer by levels.
    """
    draw = F.pmod(F.xxhash64(*labelled.columns), F.lit(_HASHES))
    given = stage(labelled.select(F.array_sort("tokens").alias("tokens"), "verdict", draw.alias("draw")), "labelled-urls")
    share = 1.0 if sample_rows is None else min(1.0, sample_rows / max(1, given.count()))
    train = given.filter(F.col("draw") < round(share * _HASHES)).drop("draw")
    n = train.count()
    if not n:
        return train.sparkSession.createDataFrame([], RULE_COLUMNS)
    least = max(least_count, math.ceil(min_support * n))
    counts = train.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("seen")).filter(F.col("seen") >= least)
    # a token in a share of min_support of all baskets: as many as tokens per URL / min_support
    frequent = stage(counts, "url-tokens")
    keyed = stage(train.withColumn("key", F.monotonically_increasing_id()), "url-baskets")
    cells = keyed.select("key", "verdict", F.explode("tokens").alias("token")).join(
        F.broadcast(frequent) if fits_broadcast(frequent) else frequent, "token"
    )
    baskets = stage(
        cells.groupBy("key").agg(F.first("verdict").alias("verdict"), F.array_sort(F.collect_list("token")).alias("tokens")).drop("key"),
        "url-items",
    )
    longest = baskets.agg(F.max(F.size("tokens"))).first()[0] or 0
    counted = by_levels(baskets, least) if longest > basket else _by_growth(baskets, least)
    sure = stage(
        counted.select("tokens", "verdict", "support", (F.col("support") / F.col("seen")).alias("confidence"))
        .filter(F.col("confidence") >= min_confidence),
        "url-rules",
    )
    shorter = sure.select(
        F.col("tokens").alias("all"), "verdict", "confidence",
        F.explode(F.transform("tokens", lambda t: F.array_except("tokens", F.array(t)))).alias("tokens"),
    )
    beaten = shorter.join(
        sure.select("tokens", "verdict", F.col("confidence").alias("shorter")), ["tokens", "verdict"]
    ).filter("shorter >= confidence").select(F.col("all").alias("tokens"), "verdict")
    pruned = sure.join(beaten.distinct(), ["tokens", "verdict"], "left_anti")
    rare = pruned.select("*", F.explode("tokens").alias("token")).join(frequent, "token")
    return rare.groupBy("tokens", "verdict", "support", "confidence").agg(
        F.min(F.struct("seen", "token")).getField("token").alias("rarest")
    )


_FOUND = StructType(
    [
        StructField("confidence", DoubleType()),
        StructField("support", LongType()),
        StructField("mined", ArrayType(StringType())),
        StructField("mined_verdict", StringType()),
    ]
)


def match(rows: DataFrame, rules: DataFrame, block_rules: int = BLOCK_RULES) -> DataFrame:
    """``rows`` with the surest rule that their tokens hold: confidence, support, mined (its tokens), mined_verdict."""
    spark = rows.sparkSession
    rules = stage(rules.select("tokens", "verdict", "support", "confidence", "rarest"), "mined-rules")
    blocks = max(1, math.ceil(rules.count() / block_rules))
    out = rows
    for block in range(blocks):
        part = rules.filter(F.pmod(F.xxhash64("tokens", "verdict"), F.lit(blocks)) == block).collect()
        index: dict[str, list] = {}
        for r in part:
            rule = (r.confidence, r.support, len(r.tokens), r.tokens, r.verdict)
            index.setdefault(r.rarest, []).append((rule, frozenset(r.tokens)))
        shared = spark.sparkContext.broadcast({t: sorted(found, key=lambda x: x[0], reverse=True) for t, found in index.items()})

        def judge(token_lists, *earlier, shared=shared):
            postings = shared.value
            for i, own in enumerate(token_lists):
                best = None
                if earlier and earlier[0][i] is not None:
                    confidence, support, mined, verdict = (column[i] for column in earlier)
                    best = (confidence, support, len(mined), mined, verdict)
                held = frozenset(own)
                for token in own:
                    for rule, needed in postings.get(token, ()):
                        if best is not None and rule <= best:
                            break
                        if needed <= held:
                            best = rule
                            break
                yield (best[0], best[1], best[3], best[4]) if best else (None, None, None, None)

        out = append_columns(out, ["tokens"] + (list(_FOUND.names) if block else []), _FOUND, judge)
        if block + 1 < blocks:
            out = stage(out, "matched-block")
    return out


def judged(pages: DataFrame, labels: DataFrame, rules: Sequence[Rule] = RULES, **options) -> DataFrame:
    """Every page's host, path, rule and verdict; ``mined`` names the mined rule where one decided."""
    rows = prepared(pages, rules)
    found = match(rows, mine(labelled(rows, labels), **options))
    own = F.col("listed").isNull()
    return found.select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("listed", "mined_verdict", F.lit("allow")).alias("verdict"),
        F.when(own, F.array_join("mined", " + ")).alias("mined"),
        F.when(own, F.col("confidence")).alias("confidence"),
    )


def _oracle() -> str:
    rules = " union all ".join(f"select '{r.verdict}' as verdict, '{r.host}' as host, '{r.path}' as path" for r in RULES)
    pattern = "(?s)^.*?://([^/?#]*)([^?#]*)"
    return rf"""
with listing as ({rules}),
cut as (
  select row_number() over () as key, page_id, coalesce(url, '') as u,
         translate(regexp_extract(u, '{pattern}', 1), '{_CAPITALS}', '{_SMALL}') as host,
         regexp_extract(u, '{pattern}', 2) as path from pages),
fits as (
  select key, arg_max(l.host || l.path, length(l.host || l.path)) as rule, arg_max(l.verdict, length(l.host || l.path)) as listed
  from cut c join listing l on (c.host = l.host or ends_with(c.host, '.' || l.host)) and starts_with(c.path, l.path)
  group by key),
known as (select doc_id as page_id, case when bool_or(toxic = 1) then 'block' else 'allow' end as labelled
          from labels where doc_id is not null group by doc_id),
raw as (
  select key, unnest(
    ['scheme ' || split_part(u, '://', 1)]
    || ['host ' || x for x in string_split(host, '.') if x <> '']
    || ['site ' || array_to_string(list_slice(string_split(host, '.'), -2, -1), '.')]
    || ['path ' || x for x in regexp_split_to_array(regexp_replace(lower(path), '[0-9]+', '0', 'g'),
                                                    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') if x <> '']
    || ['query ' || split_part(x, '=', 1)
        for x in string_split(regexp_extract(u, '(?s)^.*?://[^?#]*\?([^#]*)', 1), '&') if split_part(x, '=', 1) <> '']) as token
  from cut where contains(u, '://')),
tok as (select distinct key, token from raw where token not in ('scheme ', 'site ')),
train as (select key, coalesce(listed, labelled) as verdict
          from cut left join fits using (key) left join known using (page_id)
          where coalesce(listed, labelled) is not null and key in (select key from tok)),
least as (select greatest({LEAST_COUNT}, cast(ceil({MIN_SUPPORT} * count(*)) as bigint)) as least from train),
frequent as (select token, count(*) as seen from tok join train using (key) group by token having count(*) >= (select least from least)),
best as (select key, verdict, token from tok join train using (key) join frequent using (token)
         qualify row_number() over (partition by key order by seen desc, token) <= {BASKET}),
baskets as (select key, verdict, list(token order by token) as items from best group by all),
subsets as (select verdict, [items[i] for i in range(1, len(items) + 1) if (mask >> (i - 1)) & 1 = 1] as tokens
            from (select verdict, items, unnest(range(1, cast(1 as bigint) << len(items))) as mask from baskets)),
pairs as (select tokens, verdict, count(*) as support from subsets group by tokens, verdict),
sets as (select tokens, verdict, support, sum(support) over (partition by tokens) as seen from pairs),
sure as (select tokens, verdict, support, cast(support as double) / cast(seen as double) as confidence from sets
         where support >= (select least from least) and cast(support as double) / cast(seen as double) >= {MIN_CONFIDENCE}),
shorter as (select s.tokens, s.verdict from
            (select tokens, verdict, confidence, [t for t in tokens if t <> gone] as fewer
             from (select *, unnest(tokens) as gone from sure)) s
            join sure b on b.tokens = s.fewer and b.verdict = s.verdict and b.confidence >= s.confidence),
kept as (select * from sure anti join shorter using (tokens, verdict)),
need as (select tokens, verdict, support, confidence, unnest(tokens) as token from kept),
hits as (select key, tokens, n.verdict, support, confidence from tok join need n using (token)
         group by key, tokens, n.verdict, support, confidence having count(*) = len(tokens)),
won as (select key, tokens, verdict as mined_verdict, confidence from hits
        qualify row_number() over (partition by key order by confidence desc, support desc, len(tokens) desc, tokens desc, verdict desc) = 1)
select page_id, host, path, rule, coalesce(listed, mined_verdict, 'allow') as verdict,
       case when listed is null then array_to_string(tokens, ' + ') end as mined,
       case when listed is null then confidence end as confidence
from cut left join fits using (key) left join won using (key)
"""


ORACLE = _oracle()
