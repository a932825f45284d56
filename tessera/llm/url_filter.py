"""URL filter: a Bloom filter cascade gives exact rule membership without joins.

Rules are ``(host, path, action)``.  A rule fits its host and all subdomains if
the url's path starts with the rule's path, so each url has a short list of
*keys* (host suffix + path prefix) that a rule could be written as.  All keys
of the corpus are the universe.  Level 1 of the cascade encodes the listed
keys, level 2 the unlisted keys of the universe that level 1 lets through,
level 3 the listed keys that level 2 lets through, and so on until a level has
no false positive left.  Since every key that can be asked for is in the
universe, the answer is exact; each url is judged where it is scanned.

Size: level 1 takes a false-positive rate near ``listed / universe``, so that
about as many unlisted keys pass as there are listed ones, and the other levels
one half.  The whole cascade is linear in the listed keys (about
``1.44 log2(universe / listed) + 4`` bits a key), however large the corpus is;
``max_bits`` is checked.  The bitmaps reach the scan as scalar subqueries.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import ascii_lower, staged

MAX_BITS = 1 << 31


@dataclass(frozen=True)
class Level:
    """One Bloom filter: a one-row table holding ``words`` (array of longs)."""

    words: DataFrame
    bits: int
    hashes: int
    seed: int

    def positions(self, key: Column) -> list[Column]:
        return [F.pmod(F.xxhash64(key, F.lit(self.seed * 64 + j)), F.lit(self.bits)) for j in range(self.hashes)]

    def holds(self, key: Column, words: Column) -> Column:
        """Whether all bits of ``key`` are set."""
        found = F.lit(True)
        for pos in self.positions(key):
            word = F.element_at(words, (F.floor(pos / 64) + 1).cast("int"))
            found = found & (F.getbit(word, F.pmod(pos, F.lit(64)).cast("int")) == 1)
        return found


def build_level(keys: DataFrame, count: int, rate: float, seed: int, max_bits: int = MAX_BITS) -> Level:
    """A Bloom filter over ``keys(key)`` with false-positive rate ``rate``."""
    bits = max(64, math.ceil(-count * math.log(rate) / math.log(2) ** 2 / 64) * 64)
    if bits > max_bits:
        raise ValueError(f"{count} listed keys need {bits} bits, more than max_bits={max_bits}")
    hashes = max(1, round(bits / max(count, 1) * math.log(2))) if count else 1
    empty = Level(keys, bits, min(hashes, 24), seed)
    slots = keys.select(F.explode(F.array(*empty.positions(F.col("key")))).alias("p"))
    words = (slots.select(F.floor(F.col("p") / 64).alias("w"), F.expr("shiftleft(1L, cast(pmod(p, 64) as int))").alias("b"))
                  .unionByName(keys.sparkSession.range(bits // 64).select(F.col("id").alias("w"), F.lit(0).cast("long").alias("b")))
                  .groupBy("w").agg(F.bit_or("b").alias("b"))
                  .agg(F.array_sort(F.collect_list(F.struct("w", "b"))).alias("all"))
                  .select(F.transform("all", lambda x: x["b"]).alias("words")))
    return Level(staged(words, "bloom"), bits, empty.hashes, seed)


@dataclass(frozen=True)
class Cascade:
    levels: list[Level]
    name: str

    def columns(self) -> dict[str, Column]:
        """The bitmaps, as columns to add to the scan before asking ``holds``."""
        return {f"_{self.name}{i}": lv.words.scalar() for i, lv in enumerate(self.levels)}

    def holds(self, key: Column) -> Column:
        """Exact membership of a key of the universe."""
        answer = F.lit(False)
        for i in reversed(range(len(self.levels))):
            hit = self.levels[i].holds(key, F.col(f"_{self.name}{i}"))
            answer = hit if i == len(self.levels) - 1 else hit & ~answer
        return answer


def build_cascade(listed: DataFrame, universe: DataFrame, name: str, seed: int = 1,
                  max_levels: int = 64, max_bits: int = MAX_BITS) -> Cascade:
    """Cascade for ``listed(key)`` over ``universe(key)``; repeats and nulls are allowed in both.

    The universe is scanned twice (its approximate size, then what passes
    level 1); the other levels work on tables of about the listed size.
    """
    keys = staged(listed.where("key is not null").select("key").distinct(), "listed")
    n = keys.count()
    size = universe.agg(F.approx_count_distinct("key")).first()[0]
    rate = min(0.5, max(1e-7, 0.7 * n / max(size, 1)))
    first = build_level(keys, n, rate, seed, max_bits)
    probe = universe.select("key", first.words.scalar().alias("_w")).where("key is not null")
    passed = probe.where(first.holds(F.col("key"), F.col("_w"))).select("key").distinct()
    known = staged(passed.withColumn("listed", F.lit(False)).unionByName(keys.withColumn("listed", F.lit(True)))
                         .groupBy("key").agg(F.max("listed").alias("listed")), "known")
    levels, encode, against = [first], known.where(~F.col("listed")).select("key"), known.where("listed").select("key")
    for i in range(1, max_levels):
        # 'encode' holds what wrongly passed the last level; once it is empty the cascade is exact
        left = encode.count()
        if not left:
            return Cascade(levels, name)
        level = build_level(encode, left, 0.5, seed + i, max_bits)
        levels.append(level)
        wrong = against.select("key", level.words.scalar().alias("_w"))
        wrong = staged(wrong.where(level.holds(F.col("key"), F.col("_w"))).select("key"), "wrong")
        encode, against = wrong, encode
    raise RuntimeError(f"no exact cascade in {max_levels} levels")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty without ``://``."""
    u = F.coalesce(url, F.lit(""))
    at = F.locate("://", u)
    rest = F.when(at > 0, u.substr(at + 3, F.length(u))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest.substr(F.length(host) + 1, F.length(u)), r"^[^?#]*", 0)
    return ascii_lower(host), path


def rule_keys(host: Column, path: Column, lengths: list[int]) -> Column:
    """Every key a rule for this url could have: host suffixes, longest first,
    each with the path prefixes of the given lengths, longest first."""
    labels = F.split(host, r"\.", -1)
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)),
                           lambda i: F.concat_ws(".", F.slice(labels, i, F.size(labels))))
    wanted = F.array(*[F.lit(n) for n in sorted(lengths, reverse=True)]) if lengths else F.array().cast("array<int>")
    fits = F.filter(wanted, lambda n: n <= F.length(path))
    return F.flatten(F.transform(suffixes, lambda h: F.transform(fits, lambda n: F.concat(h, path.substr(F.lit(1), n)))))


def judge_urls(pages: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url",
               unlisted: str = "allow", max_bits: int = MAX_BITS) -> DataFrame:
    """Verdict of ``rules(host, path, action)`` for every row of ``pages``.

    Returns ``key, host, path, rule, verdict``: the longest rule that fits
    (its host plus its path) with its action, or null and ``unlisted`` when the
    cascade finds no listed key.  Among keys of equal length the one with the
    longer host wins; of equal rules with different actions, block wins.

    A null url or one without ``://`` has empty host and path.  Repeated rows
    are judged one by one, rows of an empty table give an empty result, rules
    with a null part fit nothing, other columns of ``pages`` are not read.
    """
    rules = rules.where("host is not null and path is not null and action is not null").select(
        F.concat(ascii_lower(F.col("host")), "path").alias("key"), F.length("path").alias("len"), "action")
    rules = staged(rules, "rules")
    lengths = sorted(r["len"] for r in rules.select("len").distinct().collect())  # at most one a path length
    host, path = host_and_path(F.col(url))
    parts = pages.select(F.col(key), host.alias("host"), path.alias("path"))
    cands = parts.select("*", rule_keys(F.col("host"), F.col("path"), lengths).alias("_keys"))
    listed = build_cascade(rules, cands.select(F.explode("_keys").alias("key")), "l", 1, max_bits=max_bits)
    blocked = build_cascade(rules.where("action = 'block'"), rules, "b", 101, max_bits=max_bits)
    found = cands.select("*", *[c.alias(n) for n, c in {**listed.columns(), **blocked.columns()}.items()])
    fits = F.filter("_keys", lambda k: listed.holds(k))
    best = F.reduce(fits, F.lit(None).cast("string"),
                    lambda a, k: F.when(a.isNull() | (F.length(k) > F.length(a)), k).otherwise(a))
    judged = found.select(key, "host", "path", best.alias("rule"), *blocked.columns())
    verdict = (F.when(F.col("rule").isNull(), F.lit(unlisted))
                .when(blocked.holds(F.col("rule")), F.lit("block")).otherwise("allow"))
    return judged.select(key, "host", "path", "rule", verdict.alias("verdict"))
