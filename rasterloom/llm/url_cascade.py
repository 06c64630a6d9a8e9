"""URL filtering with a Bloom filter cascade, in DataFrame functions only.

Over the corpus's complete set of hosts, level 1 encodes the listed hosts,
level 2 the unlisted ones that level 1 lets through, level 3 the listed ones
that level 2 lets through, and so on until a level has no false positive. For
any host of the corpus the first level that rejects it tells, without error,
whether it is listed; judging a URL needs no join.

A level is a blocked Bloom filter: a key sets and tests a few bits of one 64-bit
word. Its words are aggregated from the keys into one array, written as a table of
one row and read by a scalar subquery, so they neither pass through Python nor
stand in the plan. Their size follows from the number of keys; where it would
pass its bound, keys and rows are dealt out once by a hash of the host, and each
part has a cascade of its own.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rasterloom.session import delete, shared_path, written

#: Largest filter that is sent to the executors, over all levels.
MAX_BYTES = 16 << 20
#: Keys of a 64-bit word on average, and bits of a key. With 4 and 4 about one foreign key in 150 passes.
KEYS_A_WORD, BITS = 4, 4
#: Of foreign keys that pass a level, for sizes only; taken on the safe side.
RATE = 1 / 64
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/ ? #``, ASCII lower case; '' if there is none."""
    return F.translate(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ``?`` or ``#``."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    return F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise(F.lit(""))


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


@dataclass
class Level:
    """``n_words`` words of 64 bits, the only cell of ``table``."""

    table: DataFrame
    n_words: int
    seed: int

    def passes(self, key: Column) -> Column:
        mask = _mask(key, self.seed)
        return F.get(self.table.scalar(), _word(key, self.n_words, self.seed)).bitwiseAND(mask) == mask


def _word(key: Column, n_words: int, seed: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(n_words)).cast("int")


def _mask(key: Column, seed: int) -> Column:
    """BITS bits of the key's word; some may fall together."""
    places = F.xxhash64(F.lit(seed), key)
    found = None
    for k in range(BITS):
        place = F.shiftrightunsigned(places, 6 * k).bitwiseAND(F.lit(63)).cast("int")
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), place)
        found = bit if found is None else found.bitwiseOR(bit)
    return found


@dataclass
class Cascade:
    levels: list[Level] = field(default_factory=list)

    def contains(self, key: Column) -> Column:
        """Exact for every key of the universe it was built over."""
        listed = F.lit(len(self.levels) % 2 == 1)
        for n in reversed(range(len(self.levels))):
            listed = F.when(self.levels[n].passes(key), listed).otherwise(F.lit(n % 2 == 1))
        return listed

    def size(self) -> int:
        return sum(8 * x.n_words for x in self.levels)


def _level(keys: DataFrame, count: int, seed: int, room: int) -> Level:
    n_words = max(1, math.ceil(count / KEYS_A_WORD))
    if 8 * n_words > room:
        raise ValueError("the cascade outgrows its bound; judge() splits larger lists")
    set_by = keys.select(_word(F.col("key"), n_words, seed).cast("long").alias("at"), _mask(F.col("key"), seed).alias("bits"))
    every = keys.sparkSession.range(n_words).select(F.col("id").alias("at"), F.lit(0).cast("long").alias("bits"))
    words = set_by.unionByName(every).groupBy("at").agg(F.bit_or("bits").alias("bits"))
    # One cell of at most MAX_BYTES.
    row = words.agg(F.sort_array(F.collect_list(F.struct("at", "bits"))).alias("words")).select(F.col("words.bits").alias("words"))
    return Level(written(row, "url-level"), n_words, seed)


def distinct_keys(hosts: DataFrame, listed: Column | DataFrame) -> DataFrame:
    """``key, listed``: each ``host`` once, as a written table; null hosts are in no list.

    ``listed`` is a predicate over ``host`` or a table with a column ``host``,
    which meets the distinct hosts once, here.
    """
    keys = hosts.select("host").where(F.col("host").isNotNull()).distinct()
    if isinstance(listed, Column):
        keys = keys.select(F.col("host").alias("key"), F.coalesce(listed, F.lit(False)).alias("listed"))
    else:
        names = listed.select(F.col("host").cast("string").alias("name")).distinct()
        keys = keys.join(names, F.col("host") == F.col("name"), "left").select(F.col("host").alias("key"), F.col("name").isNotNull().alias("listed"))
    return written(keys, "url-keys")


def build_cascade(keys: DataFrame, max_bytes: int | None = None) -> Cascade:
    """From ``key`` and ``listed``, each key once.

    Without listed keys the cascade has no level and lists nothing.
    """
    max_bytes = max_bytes or MAX_BYTES
    cascade = Cascade()
    members = keys.where("listed").select("key")
    others = keys.where("not listed").select("key")
    while True:
        count = members.count()
        if count == 0:
            return cascade
        level = _level(members, count, len(cascade.levels) + 1, max_bytes - cascade.size())
        cascade.levels.append(level)
        members, others = others.where(level.passes(F.col("key"))), members


def parts_needed(listed: int, unlisted: int, max_bytes: int) -> int:
    """In how many parts by hash the keys must be judged for each part's cascade to keep its bound, with a fifth to spare."""
    # Each further level holds the false positives of the one before.
    keys = (listed + unlisted * RATE) / (1 - RATE)
    return max(1, math.ceil(keys * 8 / KEYS_A_WORD / (0.8 * max_bytes)))


def rule_column(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The longest rule that fits as struct<rule, verdict>, else null. A rule fits its host and all subdomains."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: (len(r.name), len(r.host), r.name)):
        fits = (host == rule.host) | host.endswith("." + rule.host)
        named = F.struct(F.lit(rule.name).alias("rule"), F.lit(rule.verdict).alias("verdict"))
        found = F.when(fits & path.startswith(rule.path), named).otherwise(found)
    return found


def judge(pages: DataFrame, listed: Column | DataFrame, rules: list[Rule], max_bytes: int | None = None) -> DataFrame:
    """``page_id, host, path, rule, verdict`` per row.

    ``listed`` defines the block list on the corpus's hosts: a predicate over
    ``host``, null for no, or a table with a column ``host`` of lower-case host
    names, where nulls and repeats do not matter. The longest fitting rule
    decides; else the cascade: block if the host is listed, allow if not. Null
    URLs and those without ``://`` have empty host and path and are judged like
    any other. URLs of any length are read whole. Rows that repeat are judged
    each on its own, an empty table gives no rows, other columns are not read.
    """
    max_bytes = max_bytes or MAX_BYTES
    url = F.col("url").cast("string")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    keys = distinct_keys(rows, listed)
    counts = {r.listed: r["count"] for r in keys.groupBy("listed").count().collect()}  # two rows
    parts = parts_needed(counts.get(True, 0), counts.get(False, 0), max_bytes)
    if parts == 1:
        return _judged(rows, build_cascade(keys, max_bytes), rules)
    spark, path = pages.sparkSession, shared_path(pages.sparkSession, "judged")

    def dealt(table: DataFrame, name: str, column: str) -> str:
        to = shared_path(spark, name)
        part = F.pmod(F.xxhash64(F.lit("part"), F.col(column)), F.lit(parts))
        table.withColumn("part", part).write.partitionBy("part").parquet(to)
        return to

    rows_at, keys_at = dealt(rows, "url-rows", "host"), dealt(keys, "url-parts", "key")
    for part in spark.read.parquet(keys_at).select("part").distinct().collect():  # parts that have a key
        mine = [spark.read.schema(t.schema).parquet(f"{at}/part={part.part}") for t, at in ((rows, rows_at), (keys, keys_at))]
        _judged(mine[0], build_cascade(mine[1], max_bytes), rules).write.mode("append").parquet(path)
    for left in (rows_at, keys_at):
        delete(spark, left)
    return spark.read.parquet(path)


def _judged(rows: DataFrame, cascade: Cascade, rules: list[Rule]) -> DataFrame:
    rows = rows.withColumn("fit", rule_column(F.col("host"), F.col("path"), rules))
    by_list = F.when(cascade.contains(F.col("host")), "block").otherwise("allow")
    return rows.select("page_id", "host", "path", F.col("fit.rule").alias("rule"), F.coalesce("fit.verdict", by_list).alias("verdict"))
