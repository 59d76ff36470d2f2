"""The audits of filters, sources and URLs against brute force, and their edge cases."""

import collections
import itertools
import random
import re
from fractions import Fraction

import numpy as np
import pytest

from voltspan.llm import divergence, interactions, queries, urls

RNG = random.Random(12)
LONG = "lorem ipsum, dolor sit amet " * 4000


@pytest.fixture(scope="module")
def odd(docs_of):
    """Nulls in every column, empty and long texts, ties, repeated rows, and columns named like the operators' own."""
    rows = [
        (1, "der die das und nicht ein haus", "de", "a"), (1, "der die das und nicht ein haus", "de", "a"),
        (2, None, "en", "b"), (3, "", None, None), (None, "text without an id", "en", "a"), (None, "text without an id", "en", "a"),
        (4, LONG, "en", "b"), (5, "the cat and the dog of the house", "en", None), (6, "?! 12", "de", "c"), (7, "ok", "en", "c"),
        (8, "the cat and the dog of the house", "en", "c"), (9, "The cat! The DOG of $ the house", "en", ""), (8, "OK", "en", "b"),
        (None, "the cat and the dog of the house", "en", "b"), (10, "the dog", "", "a"), (11, "the dog", "", "b"), (12, "the dog", "", ""),
    ]
    return docs_of(rows).selectExpr(
        "*", "1 as n", "'x' as part", "2 as digest", "3 as first", "4 as good", "5 as failed", "6 as term", "7 as value", "8 as p", "9 as id"
    )


@pytest.fixture(scope="module")
def marks(spark):
    rows = [(1, 1, 0), (1, 0, 1), (2, 1, 1), (4, 0, 1), (8, 1, 0), (None, 1, 1), (5, None, None), (99, 1, 1)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int").selectExpr("*", "1 as spread", "2 as id")


def brute_steps(rows, marks):
    """Every order of the filters, applied document by document."""
    docs = []
    for i, text, source in rows:
        t = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {
            "A": len(words) < 50,
            "B": 100 * len(set(words)) < 65 * len(words),
            "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t),
            "D": bool(re.search("[#$%&*|]", t)),
            "E": i is not None and any(j is not None and j < i and (other or "") == t for j, other, _ in rows),
        }
        own = [m for m in marks if m[0] is not None and m[0] == i]
        docs.append((source or "", fails, any(m[1] == 1 for m in own), any(m[2] == 1 for m in own)))
    out, shapley = {}, collections.Counter()
    for part in {d[0] for d in docs}:
        for order in itertools.permutations("ABCDE"):
            left = [d for d in docs if d[0] == part]
            gone = []
            for step, c in enumerate(order, 1):
                removed = [d for d in left if d[1][c]]
                redundant = sum(d[1][c] for d in gone)
                left = [d for d in left if not d[1][c]]
                gone += removed
                sole = sum(d[0] == part and d[1][c] and sum(d[1].values()) == 1 for d in docs)
                shapley[part, c] += len(removed)
                out[part, "".join(order), step] = (len(left), len(removed), redundant, sole, sum(d[2] for d in removed), sum(d[3] for d in removed))
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def test_filter_steps_against_brute_force(odd, marks):
    got = interactions.audited(odd, marks).collect()
    want = brute_steps([(r.doc_id, r.text, r.source) for r in odd.collect()], [(r.doc_id, r.quality, r.toxic) for r in marks.collect()])
    assert {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in got} == want
    assert len(got) == 600 * 4


def test_filter_steps_of_nothing(odd, marks):
    assert interactions.audited(odd.limit(0), marks).count() == 0
    rows = interactions.audited(odd.filter("doc_id = 7"), marks.limit(0)).collect()
    assert len(rows) == 600 and {r.part for r in rows} == {"c"} and {r.good_lost for r in rows} == {0}


@pytest.mark.parametrize("n", [1, 2, 3, 5])
def test_least_squares_gives_shapley_values(n):
    value = [0] + [RNG.randrange(-99, 99) for _ in range(2**n - 1)]
    want = [0] * n
    for order in itertools.permutations(range(n)):
        held = 0
        for i in order:
            want[i] += value[held | 1 << i] - value[held]
            held |= 1 << i
    assert [sum(a * b for a, b in zip(row, value)) for row in interactions.shapley_operator(n)] == want


def test_any_filters_can_be_audited(spark):
    from pyspark.sql import functions as F

    rows = spark.range(100).selectExpr("id", "id % 2 = 0 as g", "cast(id % 3 as string) as part")
    sets = interactions.failure_sets_of(rows, F.col("part"), {"X": F.col("id") % 5 == 0, "Y": F.col("id") < 30}, F.col("g"), ~F.col("g"))
    got = interactions.audit(sets, "XY").collect()
    assert len(got) == 3 * 2 * 2
    for r in got:
        own = [i for i in range(100) if str(i % 3) == r.part]
        x, y = {i for i in own if i % 5 == 0}, {i for i in own if i < 30}
        first, second = (x, y) if r.filter_order == "XY" else (y, x)
        removed = first if r.step == 1 else second - first
        assert (r.removed, r.kept) == (len(removed), len(own) - len(first if r.step == 1 else x | y))
        assert (r.good_lost, r.toxic_lost) == (sum(i % 2 == 0 for i in removed), sum(i % 2 for i in removed))


def brute_divergence(rows, least, listed):
    docs = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))) for text, lang, source in rows]
    out = set()
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        seen = collections.Counter(t for d in own for t in set(d[2]))
        kept = sorted((t for t, n in seen.items() if n >= least), key=lambda t: t.encode())

        def shares(words):
            count = collections.Counter(t for t in words if t in seen and seen[t] >= least)
            total = sum(count.values()) + len(kept)
            return count, {t: 1 + (10**9 * (count[t] + 1)) // total for t in kept}

        _, whole = shares([t for d in own for t in d[2]])
        groups = {s: shares([t for d in own if d[1] == s for t in d[2]]) for s in {d[1] for d in own}}
        for s, (count, p) in groups.items():
            pairs = [(x, sum((p[t] - q[t]) ** 2 // q[t] for t in kept)) for x, (_, q) in groups.items() if x != s]
            terms = [(t, (p[t] - whole[t]) ** 2 // whole[t]) for t in kept if count[t] and p[t] > whole[t]]
            for part, items, most in (("pair", pairs, None), ("term", terms, listed)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out |= {(lang, s, part, item, value, rank) for rank, (item, value) in enumerate(items[:most], 1)}
    return out


def rows_of(df):
    return [tuple(r) for r in df.collect()]


def test_divergence_against_brute_force(odd):
    got = rows_of(divergence.audited(odd))
    assert len(got) == len(set(got)) and set(got) == brute_divergence([(r.text, r.lang, r.source) for r in odd.collect()], 3, 200)
    assert {g[0] for g in got} >= {"", "en"}
    assert divergence.audited(odd.limit(0)).count() == 0


def test_divergence_of_many_sources_and_small_limits(spark, docs_of, monkeypatch):
    words = ["w" + "abcdefghij"[i % 10] + "klmnopqrst"[i // 10] for i in range(100)] + ["éa", "Éa", "ZZ", "日本"]
    rows = [
        (i, " ".join(RNG.choices(words[: RNG.choice([5, 40, 104])], k=RNG.randrange(60))), RNG.choice(["en", "de", None]), f"s{RNG.randrange(7)}")
        for i in range(300)
    ]
    docs = docs_of(rows)
    want = brute_divergence([r[1:] for r in rows], 3, 5)
    assert set(rows_of(divergence.audited(docs, listed=5))) == want
    # tasks hand on their counts and corrections after every few
    counts, tree = divergence.term_counts, divergence.tree_corrections
    monkeypatch.setattr(divergence, "term_counts", lambda d: counts(d, held=10))
    monkeypatch.setattr(divergence, "tree_corrections", lambda p: tree(p, pairs=8))
    monkeypatch.setattr(divergence, "maybe_broadcast", lambda df: df)
    assert set(rows_of(divergence.audited(docs, listed=5))) == want


def test_shares_do_not_overflow(spark):
    big = 10**13
    row = spark.range(1).selectExpr(f"{big} as n", f"{3 * big} as total", "7L as terms")
    from pyspark.sql import functions as F

    got = row.select(divergence.share(F.col("n"), F.col("total"), F.col("terms"))).first()[0]
    assert got == 1 + 10**9 * (big + 1) // (3 * big + 7)


def test_tree_counts_a_shared_path_once():
    tree, names = divergence.Tree(), {"a": 0, "b": 1, "c": 2}
    rows = [([("a", 9, 1), ("b", 7, 2)], 2), ([("a", 9, 1), ("b", 7, 2), ("c", 5, 3)], 4), ([("a", 9, 1), ("c", 5, 3)], 1), ([("b", 8, 2), ("c", 5, 3)], 3)]
    want = collections.Counter()
    for path, times in rows:
        tree.insert(np.array([names[s] << 31 | p for s, p, _ in path]), np.array([z for _, _, z in path]), times)
        for (s, p, p0), (t, q, q0) in itertools.permutations(path, 2):
            f = lambda a, b: Fraction((a - b) ** 2, b).__floor__()
            want[names[s], names[t]] += times * (f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0))
    tree.leave(0)
    # the nodes ab, abc, ac and bc meet 1 + 2 + 1 + 1 ancestors
    assert tree.waiting == 5 == sum(len(x[0]) for x in tree.pairs)
    a, b, value = (x.tolist() for x in tree.sums())
    assert dict(zip(zip(a, b), value)) == dict(want)


def test_sums_are_exact():
    codes = np.array([1, 2, 1, 1, 2] * 1000)
    values = np.array([2**52 + 1, -3, -(2**51) - 1, 7, 2**53 - 1] * 1000)
    keys, out = divergence.totals(codes, values)
    assert keys.tolist() == [1, 2] and out.tolist() == [1000 * (2**52 + 1 - 2**51 - 1 + 7), 1000 * (2**53 - 4)]


PAGES = [
    (1, "http://a.example.com/en/x"), (2, "http://WWW.example.COM/en/x?q=1"), (3, "http://example.com/EN/x"), (4, "https://x.net/es/1"),
    (5, "https://x.net/fr/1#f"), (6, "https://net/es/"), (7, "https://xnet/es/"), (8, "http://com"), (9, "http://com/"), (10, None),
    (11, "no scheme"), (12, "x://y://z.net/es/"), (13, "http://badexample.com/en/"), (14, ""), (None, "http://b.www.example.com/en/"),
    (15, "http://x.net?/es/"), (16, "http://x.net:80/es/"), (4, "https://x.net/es/1"), (17, "://x.net/es/"), (18, "http:///es/"),
]


@pytest.fixture(scope="module")
def odd_pages(spark):
    return spark.createDataFrame([(*r, "x", 5) for r in PAGES], "page_id long, url string, tokens string, verdict int")


def test_listed_rules(spark, odd_pages, marks):
    got = {(r.page_id, r.host, r.path): (r.rule, r.verdict) for r in urls.judged(odd_pages, marks).collect()}
    assert len(got) == len(PAGES) - 1
    assert got[1, "a.example.com", "/en/x"] == ("example.com/en/", "block")
    assert got[2, "www.example.com", "/en/x"] == ("www.example.com/en/", "allow")
    assert got[3, "example.com", "/EN/x"] == ("com/", "allow")
    assert got[4, "x.net", "/es/1"] == got[6, "net", "/es/"] == got[17, "x.net", "/es/"] == ("net/es/", "block")
    assert got[5, "x.net", "/fr/1"] == ("net/fr/", "block")
    assert got[9, "com", "/"] == got[13, "badexample.com", "/en/"] == ("com/", "allow")
    assert got[None, "b.www.example.com", "/en/"] == ("www.example.com/en/", "allow")
    for key in ((7, "xnet", "/es/"), (8, "com", ""), (10, "", ""), (11, "", ""), (14, "", ""), (12, "y:", "//z.net/es/"), (15, "x.net", ""), (16, "x.net:80", "/es/"), (18, "", "/es/")):
        assert got[key][0] is None
    assert got[10, "", ""] == got[11, "", ""] == got[14, "", ""] == (None, "allow")


def test_nothing_to_learn_from(spark, odd_pages, marks):
    assert urls.judged(odd_pages.limit(0), marks).count() == 0
    only = urls.judged(odd_pages, marks.limit(0), rules=())
    assert {(r.rule, r.verdict, r.mined) for r in only.collect()} == {(None, "allow", None)}


def brute_rules(rows, min_support, min_confidence):
    """All combinations of each basket counted, then pruned."""
    least = max(urls.LEAST_COUNT, -(-round(min_support * 1000) * len(rows) // 1000))
    single = collections.Counter(t for tokens, _ in rows for t in set(tokens))
    seen, both = collections.Counter(), collections.Counter()
    for tokens, verdict in rows:
        own = sorted(sorted((t for t in set(tokens) if single[t] >= least), key=lambda t: (-single[t], t))[: urls.BASKET])
        for k in range(1, len(own) + 1):
            for items in itertools.combinations(own, k):
                seen[items] += 1
                both[items, verdict] += 1
    sure = {k: n / seen[k[0]] for k, n in both.items() if n >= least and n / seen[k[0]] >= min_confidence}
    return {
        (items, verdict): (both[items, verdict], conf)
        for (items, verdict), conf in sure.items()
        if not any(sure.get((items[:i] + items[i + 1 :], verdict), -1) >= conf for i in range(len(items)))
    }


def test_mined_rules_against_brute_force(spark):
    words = "abcdefgh"
    rows = []
    for _ in range(400):
        tokens = sorted(set(RNG.choices(words, k=RNG.randrange(1, 7))))
        bad = {"a", "b"} <= set(tokens) or "h" in tokens and RNG.random() < 0.9
        rows.append((tokens, "block" if bad else "allow"))
    table = spark.createDataFrame(rows, "tokens array<string>, verdict string")
    got = urls.mine(table, min_support=0.02, min_confidence=0.8)
    want = brute_rules(rows, 0.02, 0.8)
    assert {(tuple(r.tokens), r.verdict): (r.support, r.confidence) for r in got.collect()} == want
    assert (("a", "b"), "block") in want
    best = lambda own: max(
        ((c, n, len(i), list(i), v) for (i, v), (n, c) in want.items() if set(i) <= set(own)), default=None
    )
    asked = spark.createDataFrame([(i, sorted(RNG.sample(words, RNG.randrange(0, 8)))) for i in range(50)], "k long, tokens array<string>")
    for blocks in (10**6, 7):
        for r in urls.match(asked, got, block_rules=blocks).collect():
            assert (best(r.tokens) or (None,) * 5)[0::4] == (r.confidence, r.mined_verdict)
            assert (best(r.tokens) or (None,) * 5)[3] == r.mined


def test_tokens_beyond_the_basket_are_mined(spark, monkeypatch):
    """URLs of 14 to 16 frequent tokens, whose rules need the rarer ones."""
    words = [f"w{i:02}" for i in range(13)]
    rows = []
    for i in range(300):
        tokens = sorted({*words[: 11 + i % 3], *RNG.sample(["x", "y", "z"], RNG.randrange(0, 4))})
        bad = {"x", "y"} <= set(tokens) and RNG.random() < 0.95
        rows.append((tokens, "block" if bad else "allow"))
    table = spark.createDataFrame(rows, "tokens array<string>, verdict string")
    capped = brute_rules(rows, 0.02, 0.8)
    monkeypatch.setattr(urls, "BASKET", 16)
    want = brute_rules(rows, 0.02, 0.8)
    got = urls.mine(table, min_support=0.02, min_confidence=0.8)
    assert {(tuple(r.tokens), r.verdict): (r.support, r.confidence) for r in got.collect()} == want
    assert (("x", "y"), "block") in want and want != capped


def test_both_ways_of_mining_agree(spark):
    rows = []
    for _ in range(300):
        tokens = sorted(set(RNG.choices("abcdefgh", k=RNG.randrange(1, 9))))
        rows.append((tokens, RNG.choice(["allow", "block", "other"]) if "c" in tokens else "block" if {"a", "b"} <= set(tokens) else "allow"))
    table = spark.createDataFrame(rows, "tokens array<string>, verdict string")
    grown, levels = (sorted(map(tuple, urls.mine(table, 0.02, 3, 0.5, basket=n).collect())) for n in (12, 0))
    assert grown == levels and len(grown) > 10


def test_all_labelled_urls_are_mined(spark):
    table = spark.range(210_000).selectExpr("id", "array('a', concat('b', id % 2)) as tokens", "if(id % 2 = 0, 'block', 'allow') as verdict")
    assert sorted(r.support for r in urls.mine(table).collect()) == [105_000, 105_000]


def test_training_is_bounded_and_matching_is_not(spark):
    table = spark.range(3000).selectExpr("id", "array('a', concat('b', id % 3)) as tokens", "if(id % 3 = 0, 'block', 'allow') as verdict")
    got = {(tuple(r.tokens), r.verdict): r.support for r in urls.mine(table, sample_rows=600).collect()}
    assert set(got) == {(("b0",), "block"), (("b1",), "allow"), (("b2",), "allow")}
    assert 450 < sum(got.values()) < 750


def test_queries_are_registered():
    assert {"op11_interactions", "op12_divergence", "op13_url_rules"} <= set(queries.QUERIES) & set(queries.ORACLES)
