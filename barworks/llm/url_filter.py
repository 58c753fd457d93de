"""URL rules behind a blocked Bloom filter, in DataFrame operations only.

A url is looked up under the suffixes of its host and the leading folders of its
path, as far as the rules reach. A Bloom filter of the listed keys, cut into blocks of one 64-bit word,
passes the keys that may be listed; a hash join with the rules removes the false
positives. Each distinct (host, path) is judged once.
"""

from functools import reduce

from pyspark.sql import functions as F

from barworks.llm.common import fresh
from barworks.session import scratch_path, write_and_reread

#: Words of the filter: 8 bytes each, so 512 KiB are broadcast, however long the list is.
BLOCKS = 1 << 16
#: Bits set for a key in its word.
PROBES = 4

UPPER, LOWERED = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url):
    """What is after the first :// up to / ? # or the end, A-Z in lower case; empty where there is no ://."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, UPPER, LOWERED)


def path_of(url):
    """What follows the host up to ? # or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _let(value, body):
    """body(value) with value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _folder(path):
    """The path up to its last slash: rules are filed under it."""
    return F.regexp_extract(path, r"(?s)^(.*/)?", 1)


def _labels(host):
    return F.size(F.split(host, r"\."))


def _depth(folder):
    return F.size(F.split(folder, "/")) - 1


def _suffixes(host, most):
    """The host and its parent domains of at most ``most`` labels."""
    return _let(F.split(host, r"\."), lambda parts: F.transform(
        F.sequence(F.lit(1), F.least(F.size(parts), F.lit(most))),
        lambda k: F.array_join(F.slice(parts, F.size(parts) - k + 1, k), ".")))


def _folders(path, most):
    """Leading parts of the path that end with a slash, down to a depth of ``most``, and the empty one."""
    return _let(F.split(_folder(path), "/"), lambda parts: F.transform(
        F.sequence(F.lit(0), F.least(F.size(parts) - 1, F.lit(most))),
        lambda k: F.when(k == 0, F.lit("")).otherwise(F.concat(F.array_join(F.slice(parts, 1, k), "/"), F.lit("/")))))


def _key(host, folder):
    """64-bit hash of a filed key; hosts hold no slash, so the two parts stay apart."""
    return F.xxhash64(F.concat(host, F.lit("\n"), folder))


def _block(key, blocks):
    return F.pmod(key, F.lit(blocks))


def _bits(key):
    """The word with a key's bits, from bits of the hash that do not choose the block."""
    places = [F.shiftright(key, 40 - 6 * k).bitwiseAND(F.lit(63)).cast("int") for k in range(PROBES)]
    ones = [F.call_function("shiftleft", F.lit(1).cast("bigint"), p) for p in places]
    return reduce(lambda a, b: a.bitwiseOR(b), ones)


def bloom_filter(keys, blocks=BLOCKS):
    """(block, word) of a column ``key``: at most ``blocks`` rows."""
    return keys.groupBy(_block(F.col("key"), blocks).alias("block")).agg(F.bit_or(_bits(F.col("key"))).alias("word"))


def filter_urls(urls, rules, url_col="url", default="allow", blocks=BLOCKS):
    """The urls with ``host``, ``path``, ``rule`` and ``verdict``.

    ``rules`` has ``host``, ``path`` and ``verdict``. A rule fits its host and all
    subdomains where the url's path starts with the rule's. Of fitting rules the
    longest (host and path together) wins, then the one of longer host, then
    the least verdict. ``rule`` is its host and path. Without a rule, a url that the filter
    stops or the join finds no rule for has the verdict ``default``.

    A null url, or one without ://, has an empty host and path. Rules with a null
    part fit nothing; repeated rules count once. Repeated urls are judged alike.
    Input columns of the four names are replaced.
    """
    urls = urls.drop("host", "path", "rule", "verdict")
    listed = (rules.filter("host IS NOT NULL AND path IS NOT NULL AND verdict IS NOT NULL")
              .select(F.translate("host", UPPER, LOWERED).alias("rule_host"), F.col("path").alias("rule_path"), F.col("verdict").alias("rule_verdict"))
              .groupBy("rule_host", "rule_path").agg(F.min("rule_verdict").alias("rule_verdict"))
              .withColumn("folder", _folder(F.col("rule_path"))))
    word_of = bloom_filter(listed.select(_key(F.col("rule_host"), F.col("folder")).alias("key")), blocks)

    # What is longer than any rule can't be one's host or folder, so a url makes no more keys than the rules' own depths.
    labels, depth = listed.agg(F.max(_labels(F.col("rule_host"))), F.max(_depth(F.col("folder")))).first()
    split = urls.select(host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path")).distinct()
    keys = (split.withColumn("suffix", F.explode(_suffixes(F.col("host"), labels or 1))).withColumn("under", F.explode(_folders(F.col("path"), depth or 0)))
            .withColumn("key", _key(F.col("suffix"), F.col("under"))))
    maybe = (keys.join(F.broadcast(word_of), _block(F.col("key"), blocks) == F.col("block"))
             .filter(F.col("word").bitwiseAND(_bits(F.col("key"))) == _bits(F.col("key"))).drop("block", "word", "key"))
    hits = (maybe.join(listed, (F.col("suffix") == F.col("rule_host")) & (F.col("under") == F.col("folder")))
            .filter(F.startswith(F.col("path"), F.col("rule_path"))))
    size = F.length("rule_host") + F.length("rule_path")
    best = hits.groupBy("host", "path").agg(F.max(F.struct(
        size.alias("size"), F.length("rule_host").alias("host_size"), F.concat("rule_host", "rule_path").alias("rule"),
        F.col("rule_verdict").alias("verdict"))).alias("best"))
    own_host, own_path = fresh("host"), fresh("path")
    best = best.select(F.col("host").alias(own_host), F.col("path").alias(own_path), F.col("best.rule").alias("rule"), F.col("best.verdict").alias("verdict"))
    # A written table joins row by row with the urls, so that a hot url's rows can be split.
    best = write_and_reread(best, scratch_path(urls.sparkSession, "url-rules"))
    judged = urls.withColumns({"host": host_of(F.col(url_col)), "path": path_of(F.col(url_col))}).join(
        best.hint("merge"), (F.col("host") == F.col(own_host)) & (F.col("path") == F.col(own_path)), "left").drop(own_host, own_path)
    return judged.withColumn("verdict", F.coalesce("verdict", F.lit(default)))
