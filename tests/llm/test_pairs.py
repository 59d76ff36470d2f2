"""Near duplicates, components and substrings against brute force."""

import random

import numpy as np
import pytest

from voltspan.llm import chunks, near
from voltspan.llm.components import connected_components

RNG = random.Random(5)
WORDS = ["".join(RNG.choice("abcdefghijklmnop") for _ in range(RNG.randint(2, 8))) for _ in range(900)]


def prose(n, rng=RNG):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def changed(text, n, rng=RNG):
    words = text.split()
    for _ in range(n):
        words[rng.randrange(len(words))] = rng.choice(WORDS)
    return " ".join(words)


def test_components_match_union_find(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 460)]
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = {r.node: r.label for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: find(x) for x in linked}


def test_no_edges_no_components(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def jaccard(a, b):
    a, b = set(near.shingles(a).tolist()), set(near.shingles(b).tolist())
    return (len(a & b), len(a | b))


def test_near_duplicates_match_all_pairs(spark, docs_of, monkeypatch):
    monkeypatch.setattr(near, "BLOCK", 4)  # several blocks a group
    base = prose(120)
    texts = [changed(base, RNG.randint(0, 3)) for _ in range(25)] + [base] * 3
    texts += [prose(RNG.randint(1, 90)) for _ in range(25)]
    texts += [changed(t, 1) for t in texts[30:40]]
    texts += ["", None, "!?", "one two", "one two", "ONE, two."]
    rows = list(enumerate(texts))
    got = {r.doc_id: r for r in near.near_duplicates(docs_of(rows)).collect()}
    words = [bool(near.shingles(t).size) for _, t in rows]
    links = {i: set() for i, _ in rows}
    for i, a in rows:
        for j, b in rows[:i]:
            both, either = jaccard(a, b)
            if words[i] and words[j] and both * 10 >= either * 8:
                links[i].add(j)
                links[j].add(i)
    seen, classes = set(), {}
    for i in links:
        todo = [] if i in seen else [i]
        group = set(todo)
        while todo:
            new = links[todo.pop()] - group
            group |= new
            todo += new
        seen |= group
        classes |= {x: min(group) for x in group}
    assert {i: (r.n_links, r.class_id) for i, r in got.items()} == {i: (len(links[i]), classes[i]) for i in links}
    assert {i for i, r in got.items() if r.stays} == {classes[i] for i in links}


def test_one_per_class_keeps_columns_and_one_of_repeated_rows(spark):
    text = prose(60)
    rows = [(1, text, "x"), (1, text, "x"), (2, text.upper(), "y"), (3, prose(60), "z"), (4, None, "n"), (None, text + " end", "w")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, node string")
    out = near.one_per_class(docs)
    assert out.columns == docs.columns
    assert sorted((r.doc_id, r.node) for r in out.collect()) == [(1, "x"), (3, "z"), (4, "n")]


def test_empty_table(spark, docs_of):
    assert near.near_duplicates(docs_of([])).count() == 0
    assert chunks.deduplicated(docs_of([])).count() == 0


def test_runs_reach_recall():
    met = 1 - np.exp(-near.CHOICE * 0.7968)
    assert (1 - met) ** near.runs_needed() <= near.MISS


def test_large_buckets_are_split(spark):
    rng = np.random.default_rng(1)
    sig = rng.integers(0, 2**32, size=(40, near.TOKENS), dtype=np.uint32)
    sig[:, :60] = sig[0, :60]  # all share a good part, no pair is near
    sig[1] = sig[0]
    nodes = spark.createDataFrame([(bytes([i]) * 16, sig[i].tobytes()) for i in range(40)], "node binary, signature binary")
    met = near.buckets(nodes, block=8).collect()
    first = {r.path for r in met if r.node == bytes([0]) * 16} & {r.path for r in met if r.node == bytes([1]) * 16}
    assert first and max(r.n for r in met) <= 40


def test_chunks_resist_insertions():
    text = prose(800)
    later = "inserted words here " + text
    own = {tuple(x) for x in chunks.digests(chunks.code_points(text), chunks.borders(chunks.code_points(text))).tolist()}
    points = chunks.code_points(later)
    moved = [tuple(x) in own for x in chunks.digests(points, chunks.borders(points)).tolist()]
    assert sum(moved) >= len(moved) - 3


def test_passages_are_cut_out_of_all_but_the_first(spark, docs_of):
    passage = prose(60)
    rows = [(i, prose(150)) for i in range(12)]
    rows[2], rows[7] = (2, rows[2][1] + " " + passage + " " + prose(50)), (7, prose(30) + " " + passage + " " + rows[7][1])
    rows += [(20, rows[4][1]), (21, None), (22, ""), (None, prose(80))]
    got = {r.doc_id: r for r in chunks.dedup_substrings(docs_of(rows)).collect()}
    texts = dict(rows)
    for i, r in got.items():
        text = texts[i] or ""
        assert r.n_chars == len(text) == len(r.kept_text) + r.removed_chars
        assert all(0 <= s < e <= len(text) for s, e in zip(r.removed_starts, r.removed_ends))
        if i in (2, 4, 7, 20):
            assert r.repeated_chars >= 100
        else:
            assert r.repeated_chars == 0 and r.kept_text == text
    assert got[7].kept_in == [2] and got[2].removed_chars == 0 and got[7].removed_chars > 100
    assert got[20].kept_text == "" and got[4].removed_chars == 0


def test_passages_of_one_phrase_are_found(spark, docs_of):
    rows = []
    for i, n in enumerate((2, 3, 5, 8, 12)):
        passage = " ".join(([f"phrase{i}{chr(97 + j)}" for j in range(n)] * 60)[:51])
        rows += [(2 * i, prose(40 + i) + " " + passage + " " + prose(30)), (2 * i + 1, prose(25) + "\n" + passage + "\n" + prose(50 + i))]
    got = {r.doc_id: r for r in chunks.dedup_substrings(docs_of(rows)).collect()}
    assert all(r.repeated_chars >= 100 for r in got.values())
    assert all(got[i].kept_in == [i - 1] and got[i - 1].removed_chars == 0 for i in range(1, 10, 2))


@pytest.mark.parametrize("text", ["a" * 3000, "word", " " * 900, "日本語" * 500, "ab cd " * 2000])
def test_borders_cover_the_text(text):
    cuts = chunks.borders(chunks.code_points(text))
    assert cuts[0] == 0 and cuts[-1] == len(text) and (np.diff(cuts) > 0).all() and np.diff(cuts).max() <= chunks.MOST


def unspaced(n, rng):
    return "".join(chr(rng.randint(0x4E00, 0x57FF)) for _ in range(n))


def test_passages_are_found_however_words_are_parted(spark, docs_of):
    rng = random.Random(17)
    signs = ["\t", "\r", "\u00a0", "\u2003", "\u3000"]
    cases = [(sign.join(prose(51, rng).split()), lambda sign=sign: sign.join(prose(90, rng).split())) for sign in signs]
    cases += [(" ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(3)) for _ in range(51)), lambda: prose(90, rng))]
    cases += [(unspaced(300, rng), lambda: unspaced(400, rng)) for _ in range(5)]
    cases += [((unspaced(7, rng) * 50)[:300], lambda: unspaced(400, rng))]
    rows = [(2 * i + j, around() + passage + around()) for i, (passage, around) in enumerate(cases) for j in (0, 1)]
    got = {r.doc_id: r for r in chunks.dedup_substrings(docs_of(rows)).collect()}
    assert [i for i, r in got.items() if r.repeated_chars < 100] == []
    assert all(got[i].kept_in == [i - 1] and got[i - 1].removed_chars == 0 for i in range(1, len(rows), 2))


def brute_repeats(rows, least):
    """Per row, its repeated and its removed code points, from all other rows' chunks."""
    cut = [(chunks.code_points(t), chunks.borders(chunks.code_points(t))) for _, t in rows]
    own = [[tuple(x) for x in chunks.digests(p, c).tolist()] if len(p) else [] for p, c in cut]
    out = []
    for n, (doc_id, _) in enumerate(rows):
        holders = [
            {rows[m][0] for m in range(len(rows)) if m != n and x in own[m]} | ({doc_id} if any(x in own[m] for m in range(len(rows)) if m != n) else set())
            for x in own[n]
        ]
        shared = [len(h) > 1 or h == {None} for h in holders]
        size, repeated, removed, i = np.diff(cut[n][1]), 0, 0, 0
        while i < len(shared):
            j = i
            while j < len(shared) and shared[j]:
                j += 1
            if j > i and sum(size[i:j]) >= least:
                repeated += sum(size[i:j])
                for x in range(i, j):
                    first = min((h for h in holders[x] if h is not None), default=None)
                    removed += size[x] if first != doc_id else 0
            i = max(j, i + 1)
        out.append((doc_id, int(repeated), int(removed)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("bits", [1 << 27, 64])
def test_shared_runs_against_brute_force(spark, docs_of, monkeypatch, bits):
    monkeypatch.setattr(chunks, "shared_bits", lambda shared, f=chunks.shared_bits: f(shared, bits))
    rng = random.Random(31)
    parts = [prose(rng.randint(5, 60), rng) for _ in range(12)]
    rows = []
    for i in range(60):
        text = " ".join(rng.choice([rng.choice(parts), prose(rng.randint(1, 50), rng)]) for _ in range(rng.randint(0, 5)))
        rows.append((rng.choice([None, i, i % 7]), rng.choice([text, text, text, None])))
    rows += rows[:10]
    got = [(r.doc_id, r.repeated_chars, r.removed_chars) for r in chunks.dedup_substrings(docs_of(rows)).collect()]
    assert sorted(got, key=repr) == brute_repeats(rows, chunks.PASSAGE)
    assert any(r[1] > r[2] > 0 for r in got) or any(r[2] for r in got)


def test_rows_without_an_id_do_not_meet_in_one_list(spark, docs_of):
    passage = prose(60)
    rows = [(None, f"{prose(40)} {passage} {prose(20)}") for _ in range(300)] + [(1, passage)]
    out = chunks.dedup_substrings(docs_of(rows))
    got = out.collect()
    assert len(got) == 301 and all(r.removed_chars >= 100 and r.kept_in == [1] for r in got if r.doc_id is None)
