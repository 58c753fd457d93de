import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from barworks.llm import simhash
from barworks.llm.components import connected_components
from barworks.llm.simhash import drop_near_duplicates, near_components, near_links


def brute_fingerprint(text, words=3):
    w = [x for x in re.split("[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if x]
    if not w:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(w[i:i + words]).encode(), 42) for i in range(max(1, len(w) - words + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_classes(fps):
    """The smallest fingerprint (signed) reachable."""
    out, left = {}, set(fps)
    while left:
        group, queue = set(), [left.pop()]
        while queue:
            a = queue.pop()
            group.add(a)
            near = {b for b in left if ((a ^ b) & (1 << 64) - 1).bit_count() <= 3}
            left -= near
            queue += near
        out.update({f: min(group) for f in group})
    return out


def signed(x):
    return x - (1 << 64) if x >> 63 else x


@pytest.mark.parametrize("blocks", [3, 4, 8])
def test_links_reach_what_all_pairs_reach(spark, blocks):
    source = random.Random(7)
    fps = {0, (1 << 64) - 1}
    for _ in range(12):
        center = source.getrandbits(64)
        for _ in range(25):
            near = center
            for b in source.sample(range(64), source.randint(0, 4)):
                near ^= 1 << b
            fps.add(near)
        fps |= {center ^ 0b111, center ^ (0b111 << 61), center ^ (0b1111 << 30)}
        chain = center
        for _ in range(6):
            chain ^= sum(1 << b for b in source.sample(range(64), 3))
            fps.add(chain)
    fps = {signed(f) for f in fps}
    df = spark.createDataFrame([(f,) for f in fps], "fp bigint")
    got = {r.node: r.component for r in connected_components(near_links(df, blocks)).collect()}
    assert {f: got.get(f, f) for f in fps} == brute_classes(fps)


def near_texts():
    source = random.Random(8)
    base = [" ".join(source.choices(["w%d" % k for k in range(500)], k=120)) for _ in range(6)]
    rows = [(k, t) for k, t in enumerate(base)] + [(50 + k, t.upper() + " ") for k, t in enumerate(base)]
    for k in range(60):
        w = base[k % 6].split()
        w[source.randrange(120)] = "changed"
        rows.append((100 + k, " ".join(w)))
    return rows + [(7, None), (8, ""), (9, " \n"), (3, base[3]), (3, base[3]), (400, "one"), (401, "one two")]


def test_query_against_brute_force(docs):
    rows = near_texts()
    fps = {t: signed(brute_fingerprint(t)) for _, t in rows}
    classes = brute_classes(set(fps.values()))
    least = {}
    for doc, t in rows:
        c = classes[fps[t]]
        least[c] = min(doc, least.get(c, doc))
    want = sorted((doc, f"{fps[t] % (1 << 64):016x}", least[classes[fps[t]]]) for doc, t in rows)
    assert sorted(tuple(r) for r in near_components(docs(rows)).collect()) == want
    kept = [r.doc_id for r in drop_near_duplicates(docs(rows)).collect()]
    assert sorted(kept) == sorted(set(least.values()))


def test_odd_rows(docs, odd_rows):
    df = docs(odd_rows).withColumn("fp", F.lit(1)).withColumn("component_id", F.lit(2))
    out = near_components(df).collect()
    assert len(out) == len(odd_rows)
    by = {(r.doc_id, r.fingerprint): r.component_id for r in out}
    assert by[(1, "0" * 16)] == by[(2, "0" * 16)] == by[(3, "0" * 16)] == 1
    assert {r.component_id for r in out if r.doc_id in (4, 5)} == {4}
    kept = drop_near_duplicates(df)
    assert kept.columns == df.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(None) == 2 and ids.count(7) == 1 and 5 not in ids and 4 in ids
    assert near_components(docs([])).count() == 0 and drop_near_duplicates(docs([])).count() == 0


def test_fingerprints_of_long_texts():
    text = " ".join(f"w{k % 977}" for k in range(70_000))
    assert simhash.fingerprint(simhash.shingle_hashes(text.encode(), 3)) == signed(brute_fingerprint(text))


def test_components_of_chains_and_stars(spark):
    chain = [(k, k + 1) for k in range(70)]
    star = [(1000, 1000 + k) for k in range(1, 200)]
    links = spark.createDataFrame(chain + star + [(5, 5), (1, 0), (2000, 1999), (-5, -9)], "a bigint, b bigint")
    got = {r.node: r.component for r in connected_components(links).collect()}
    assert got == {**{k: 0 for k in range(71)}, **{1000 + k: 1000 for k in range(200)}, 2000: 1999, 1999: 1999, -5: -9, -9: -9}
    assert connected_components(links.limit(0)).count() == 0


def test_rows_of_a_fingerprint_do_not_depend_on_its_neighbours(spark, monkeypatch):
    """One near neighbour or a thousand: whoever has any emits the same ball, and links stay in proportion."""
    source = random.Random(10)
    center = source.getrandbits(63)
    crowd = {center} | {center ^ (1 << a) ^ (1 << b) for a in range(40) for b in range(40)}
    pairs = [x for _ in range(20) for c in [source.getrandbits(63)] for x in (c, c ^ 0b111)]
    lonely = [source.getrandbits(63) for _ in range(500)]
    balls = []
    ball = simhash._ball_variants
    monkeypatch.setattr(simhash, "_ball_variants", lambda fps: (balls.append(fps.count()), ball(fps))[1])
    df = spark.createDataFrame([(f,) for f in {*crowd, *pairs, *lonely}], "fp bigint")
    links = near_links(df)
    assert balls == [len(crowd) + len(pairs)]
    assert links.count() < 100 * len(crowd)
    groups = connected_components(links).groupBy("component").count().collect()
    assert sorted(r["count"] for r in groups) == [2] * 20 + [len(crowd)]


def test_hot_variants_are_counted_by_aggregates(spark, plan):
    df = spark.createDataFrame([(f,) for f in range(50)], "fp bigint")
    text = plan(simhash._meeting(simhash._sieve_variants(df, 3)))
    assert "Window" not in text and "collect_" not in text and "HashAggregate" in text


def test_unlike_texts_of_one_fingerprint_or_one_id(docs):
    """Texts that share a fingerprint are one group; unlike texts under one id are two, and each keeps a row."""
    one, two = "w1 w2 w3", "W1  w2 w3"
    texts = near_texts()
    unlike = [(70, texts[0][1]), (70, texts[1][1]), (70, texts[1][1]), (71, texts[1][1] + " "), (69, texts[2][1]), (72, texts[2][1])]
    kept = sorted((r.doc_id, r.text) for r in drop_near_duplicates(docs([(5, one), (4, two), (6, one), *unlike])).collect())
    assert kept == sorted([(4, two), (70, texts[0][1]), (70, texts[1][1]), (69, texts[2][1])])


def test_ids_of_another_type(spark):
    df = spark.createDataFrame([("b", "one two three four"), ("a", "One two three four"), ("c", "quite another text here")], "doc_id string, text string")
    assert {(r.doc_id, r.component_id) for r in near_components(df).collect()} == {("a", "a"), ("b", "a"), ("c", "c")}
    assert {r.doc_id for r in drop_near_duplicates(df).collect()} == {"a", "c"}
