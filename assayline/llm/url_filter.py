"""URL verdicts: rules by host and path, then a list behind a blocked Bloom filter."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayline.llm.common import lower_ascii, stage

TRACKING = r"^(utm_[a-z]+|ref|fbclid|gclid)="


@dataclass(frozen=True)
class Rule:
    action: str  # block or allow
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


# The rules of the query.
RULES = (
    Rule("block", "net", "/"),
    Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"),
)
# A block is 8 words of 32 bits; a key sets one bit in each of them.
WORDS = 8
BITS_PER_KEY = 16


def host_of(url: Column) -> Column:
    """Between the first :// and the next of / ? # or the end."""
    return lower_ascii(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """From the end of the host up to ? or # or the end."""
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """Spelling under which a page is listed: no scheme, fragment, tracking
    parameter, ``www.`` or default port; no closing slash or index page; the
    other parameters sorted. Null without ``://``."""
    host = F.regexp_replace(host_of(url), r"^www\.|:(80|443)$", "")
    path = F.regexp_replace(path_of(url), r"/(index\.html?)?$", "")
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    kept = F.array_sort(
        F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING))
    )
    tail = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")
    return F.when(url.contains("://"), F.concat(host, path, tail))


def rule_of(host: Column, path: Column, rules: tuple[Rule, ...]) -> tuple[Column, Column]:
    """Name and action of the longest fitting rule, null without one."""
    name = action = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.name), len(r.host), r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        name = F.when(fits, F.lit(rule.name)).otherwise(name)
        action = F.when(fits, F.lit(rule.action)).otherwise(action)
    return name, action


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("long")


def _bit(key: Column, word: int) -> Column:
    place = F.shiftright(F.xxhash64(key, F.lit(1)), 5 * word).bitwiseAND(F.lit(31).cast("long"))
    return F.call_function("shiftleft", F.lit(1), place.cast("int"))


def bloom_filter(listed: DataFrame, key: str, keys: int) -> DataFrame:
    """One row per non-empty block: its number and its words. Built in one
    grouping by block, combined in the map tasks."""
    blocks = max(1, -(-keys * BITS_PER_KEY // (32 * WORDS)))
    k = F.col(key)
    return (
        listed.filter(k.isNotNull())
        .select(_block(k, blocks).alias("__block"), *[_bit(k, i).alias(f"__b{i}") for i in range(WORDS)])
        .groupBy("__block")
        .agg(*[F.bit_or(f"__b{i}").alias(f"__b{i}") for i in range(WORDS)])
    )


def possible(df: DataFrame, key: str, bloom: DataFrame, keys: int) -> DataFrame:
    """``df`` with ``__possible``: false only for keys that aren't listed. The
    blocks are joined by number; Spark broadcasts them while their stored size
    is below its threshold and shuffles both sides beyond it."""
    blocks = max(1, -(-keys * BITS_PER_KEY // (32 * WORDS)))
    k = F.col(key)
    hit = F.lit(True)
    for i in range(WORDS):
        hit = hit & (F.col(f"__b{i}").bitwiseAND(_bit(k, i)) != 0)
    # A null key gets no block; rows without one are spread, not gathered.
    place = F.when(k.isNotNull(), _block(k, blocks)).otherwise(
        -1 - F.pmod(F.xxhash64(*df.columns), F.lit(4096))
    )
    joined = df.withColumn("__at", place).join(bloom, F.col("__at") == F.col("__block"), "left")
    return joined.select(*df.columns, F.coalesce(hit, F.lit(False)).alias("__possible"))


def filter_urls(
    pages: DataFrame,
    listed: DataFrame,
    rules: tuple[Rule, ...] = RULES,
    id_col: str = "page_id",
    url_col: str = "url",
    listed_col: str = "url",
) -> DataFrame:
    """Verdict of each page's address.

    The longest rule that fits host (subdomains included) and path decides.
    Without a rule, an address is blocked when its canonical spelling is that
    of a listed one: the canonical list is folded into a blocked Bloom filter;
    addresses that cannot be listed leave there, and the possible hits go to
    an exact join with the list, which removes the false positives. ``listed``
    may be of any size and may hold nulls and repeats.

    A null address and one without ``://`` have empty host and path, fit no
    rule, are never listed and are allowed. Repeated rows are judged one by
    one. Hot addresses move only as the distinct keys of possible hits; the
    join back is split by AQE. Empty tables give no rows.

    Columns: id, host, path, rule, verdict, canonical, listed.
    """
    keys = stage(
        listed.select(canonical(F.col(listed_col).cast("string")).alias("__key"))
        .filter(F.col("__key").isNotNull())
        .distinct(),
        "url-list",
    )
    n = keys.count()
    bloom = stage(bloom_filter(keys, "__key", n), "url-bloom")
    url = F.col(url_col).cast("string")
    host, path = host_of(url), path_of(url)
    name, action = rule_of(F.col("host"), F.col("path"), rules)
    judged = (
        pages.select(
            F.col(id_col).alias("__id"),
            host.alias("host"),
            path.alias("path"),
            canonical(url).alias("canonical"),
        )
        .withColumn("rule", name)
        .withColumn("action", action)
    )
    seen = stage(possible(judged, "canonical", bloom, n), "url-possible")
    hits = (
        seen.filter("__possible")
        .select(F.col("canonical").alias("__key"))
        .distinct()
        .join(keys, "__key", "left_semi")
        .withColumn("__listed", F.lit(True))
    )
    maybe = seen.filter("__possible").join(
        hits, F.col("canonical") == F.col("__key"), "left"
    ).drop("__key")
    rest = seen.filter("NOT __possible").withColumn("__listed", F.lit(False))
    is_listed = F.coalesce("__listed", F.lit(False))
    return maybe.unionByName(rest).select(
        F.col("__id").alias(id_col),
        "host",
        "path",
        "rule",
        F.coalesce(
            F.col("action"), F.when(is_listed, F.lit("block")).otherwise(F.lit("allow"))
        ).alias("verdict"),
        "canonical",
        is_listed.alias("listed"),
    )
