"""Edge cases and brute force for the operators that work document by document."""

import base64
import hashlib
import random
import re
import zlib

import pytest

from voltspan.llm import archives, chat, decontamination, extraction, language, mixing, queries, sharding, winnowing

LONG = "lorem ipsum, dolor sit amet " * 4000
RNG = random.Random(2)


@pytest.fixture(scope="module")
def odd(docs_of):
    """Nulls in every column, empty and long texts, ties and repeated rows."""
    rows = [
        (1, "der die das und nicht ein haus", "de", "a"), (1, "der die das und nicht ein haus", "de", "a"),
        (2, None, "en", "b"), (3, "", None, None), (None, "text without an id", "en", "a"),
        (4, LONG, "en", "b"), (5, "the cat and the dog of the house", "en", None), (6, "?! 12", "de", "c"), (7, "ok", "en", "c"),
    ]
    return docs_of(rows).selectExpr("*", "1 as size", "'x' as `text_crc32`", "2 as positions", "true as rejected")


@pytest.fixture(scope="module")
def empty(odd):
    return odd.limit(0)


def test_extraction_of_broken_markup():
    page = (
        "<html><body><nav>menu</nav><header><h1>Site</h1></header><div class='cookie-notice'>ok?</div>"
        "<article><h1>Title &amp; more</h1><p>One, <a href=x>two</a>&nbsp;three<br>four<p>Five &lt;b&gt;<form><p>mail</p></form>"
        "<script>var a='</p>'</script><!-- no --></article><section id=comments><article><p>nice, very, nice, indeed</p></article></section>"
        "<aside>side</aside><footer>foot</footer>"
    )
    assert extraction.main_text(page) == "Title & more\nOne, two three four\nFive <b>"


@pytest.mark.parametrize("page", [None, "", "<", "<!--", "<p", "<script>x", "<div>" * 3000, "</p></div>", "<a href='x"])
def test_extraction_never_fails(page):
    assert extraction.main_text(page) in ("", "<")


def test_extraction_scores_unmarked_containers(spark):
    body = "".join(f"<p>Sentence number {i}, with commas, and enough words to count.</p>" for i in range(6))
    html = f"<body><div><a href=1>one</a> <a href=2>two</a></div><div><h2>Head</h2>{body}</div></body>"
    pages = spark.createDataFrame([(1, "u", html, "kept"), (2, None, None, None)], "page_id long, url string, html string, text string")
    got = {r.page_id: r for r in extraction.extract(pages).collect()}
    assert got[1].text.startswith("Head\nSentence number 0") and got[1].text.count("\n") == 6 and got[1].n_chars == len(got[1].text)
    assert (got[2].text, got[2].n_chars) == ("", 0)


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ('<article><p><span data-html="<p>Advert text</p>">shown</span></p></article>', "shown"),
        ("<article><p>one <img alt='a <b> c'> two</p></article>", "one two"),
        ("<!--><article><p>one</p><!---><p>two</p><!-- x --!><p>three</p><!----><p>four</p></article>", "one\ntwo\nthree\nfour"),
        ("<article><p>one <![CDATA[ gone ]]> two</p></article>", "one two"),
        ("<article><ul><li class=ad>Buy" + "<b>" * 110 + "<li>Real item, kept</ul></article>", "Real item, kept"),
        ("<article><p>one" + "<i>" * 300 + "<p>two</article>", "one\ntwo"),
        ("<article><div class='notice-period'>Three months, at least.</div><h2 class='social-policy'>Policy</h2><p>Text.</p></article>",
         "Three months, at least.\nPolicy\nText."),
        ("<article><p>Text.</p><div class='cookie-notice'>We use them</div><div class='ad-slot-1'>Buy</div><div class='share-this'><a href=x>Send"
         "</a></div><ul class='related-articles'><li>More</ul></article>", "Text."),
        ('<article><p title="a>b" class=x/y data-q=\'1 "2" <3\' checked>one</p ><p =odd="v">two</p></article>', "one\ntwo"),
        ('<article><p class="never closed>one</p><p>two</p></article>', "one\ntwo"),
    ],
)
def test_extraction_reads_markup_as_browsers_do(page, text):
    assert extraction.main_text(f"<body><nav>menu</nav>{page}<footer>foot</footer></body>") == text


def test_extraction_of_generated_pages():
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 8)))
    noise = ["<!-- a <p>b</p> -->", "<!-->", "<!-- x --!>", "<script>if (a<b) '</p>'</script>", "<style>p{}</style>", "<![CDATA[x]]>", "<?php x ?>"]
    marks = ["", " class=x", " id='a>b'", ' title="<p>no</p>"', " data-a=1/2", " checked", ' alt="&lt;"', " class='notice-board'"]

    def inline(text):
        tag = rng.choice(["b", "i", "em", "span", "a"])
        return rng.choice([text, f"<{tag}{rng.choice(marks)}>{text}</{tag}>", text + rng.choice(noise)])

    for _ in range(300):
        blocks = [" ".join(word() for _ in range(rng.randint(20, 60))) + "." for _ in range(rng.randint(1, 8))]
        body = ""
        for block in blocks:
            inner = rng.choice([" ", "\n ", "\t"]).join(inline(w) for w in block.split())
            open_, close = rng.choice([("<p{}>", "</p>"), ("<p{}>", ""), ("<div{}><p>", "</div>"), ("<ul><li{}>", "</ul>"), ("<blockquote{}>", "</blockquote>")])
            body += open_.format(rng.choice(marks)) + inner + close + rng.choice(["", *noise])
        page = f"<body{rng.choice(marks)}><nav>x</nav>{rng.choice(noise)}<article{rng.choice(marks)}>{body}</article><aside>y</aside><footer>z"
        assert extraction.main_text(page) == "\n".join(blocks), page


PROSE = "".join(f"<p>Sentence number {i}, with commas, and enough words to count.</p>" for i in range(6))
LINKS = "<div class='nav'><a href=1>one</a> <a href=2>two</a></div>"


@pytest.mark.parametrize(
    "page",
    [
        f"<body><form id=aspnetForm>{LINKS}<label>Find</label><input><div id=content>{PROSE}</div><div class=sidebar><p>aside</p></div></form></body>",
        f"<body><form id=aspnetForm><div class=sidebar>{'<p>A side matter of some length, told twice.</p>' * 15}</div><div>{PROSE}</div></form></body>",
        f"<body>{LINKS}<div class='layout sidebar-right'><div>{PROSE}</div><div class=sidebar><p>aside</p></div></div></body>",
        f"<body><div id='page' class='left-sidebar'>{LINKS}{PROSE}</div><div><p>Imprint</p></div></body>",
        f"<body><div class='content-related'>{PROSE}<div id=comments>{'<p>Nice, very, nice, indeed, says a reader.</p>' * 20}</div></div></body>",
        f"<body><main class='sidebar-right'>{PROSE}</main></body>",
        f"<body><main class='sidebar-right'><article>{PROSE}</article><div class=sidebar><p>aside</p></div></main></body>",
        f"<body><main></main><form>{PROSE}</form><aside><article><p>Promoted</p></article></aside></body>",
    ],
)
def test_extraction_keeps_forms_and_wrappers_of_the_page(page):
    assert extraction.main_text(page).split("\n") == [f"Sentence number {i}, with commas, and enough words to count." for i in range(6)]


@pytest.mark.parametrize("name", ["id=comments", "class=cookie-notice", "class=sidebar", "role=complementary"])
def test_extraction_drops_marked_parts_longer_than_the_main_text(name):
    page = f"<body><div>{PROSE}</div><div {name}>{'<p>Nice, very, nice, indeed, says a reader.</p>' * 20}</div></body>"
    assert extraction.main_text(page).count("\n") == 5 and "Nice" not in extraction.main_text(page)


def brute_winnow(text, k, w):
    points = [ord(c) for c in text]
    hashes = winnowing.gram_hashes(winnowing.np.array(points, winnowing.np.uint32), k).tolist()
    w = min(w, len(hashes))
    return sorted({max(j for j in range(i, i + w) if hashes[j] == min(hashes[i : i + w])) for i in range(len(hashes) - w + 1)})


@pytest.mark.parametrize("text", ["a", "abcab" * 20, "".join(RNG.choice("ab ") for _ in range(300)), "é日本" * 50])
def test_winnowing_keeps_the_rightmost_minimum(text):
    positions, _ = winnowing.winnow(text, 5, 7)
    assert positions.tolist() == brute_winnow(text, 5, 7)


def test_winnowing_against_next(spark, odd, empty):
    rows = [tuple(r) for r in winnowing.against_next(odd).collect()]
    order = sorted(((r.doc_id is not None, r.doc_id or 0), r.text or "") for r in odd.collect())
    assert len(rows) == 9 and sorted(r[1] for r in rows) == sorted(len(t) for _, t in order)
    by_id = {r[0]: r for r in rows}
    ok, first = by_id[7], by_id[None]
    assert ok[2] == hashlib.sha256(b"ok").hexdigest() and ok[5] == 1.0
    changed = winnowing.edited("text without an id", order[1][1])
    assert first[2] == hashlib.sha256(changed.encode()).hexdigest() and by_id[2][3] == "" and by_id[2][6] == 1.0
    assert winnowing.against_next(empty).count() == 0
    assert "positions" in winnowing.fingerprints(odd).columns


def test_language(spark, odd, empty):
    held = language.learn(odd.select("text", "lang"))
    assert set(held) == {"de", "en"}
    got = language.identify(odd, held).collect()
    assert all(r.lang_pred == "und" and r.score == 0 and r.rejected for r in got if r.text in (None, "", "?! 12"))
    assert all(r.lang_pred == r.lang and 0 <= r.score <= 1 for r in got if r.doc_id in (1, 4, 5))
    assert language.learn(empty) == {} and language.identify(empty, {}).count() == 0
    assert {r.lang_pred for r in language.identify(odd, {}).collect()} == {"und"}


def test_language_held_out_accuracy(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = language.predicted(docs).filter("held_out").join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert sum(r.lang == r.lang_pred for r in got) >= 0.9 * len(got)


def test_languages_of_any_number(spark, odd):
    own = "abcdefghijklmnopqrst"
    rows = [(f"{own[i % 20]}{own[i // 20]}x{own[i // 20]}{own[i % 20]} " * 9, f"l{i}") for i in range(230)]
    held = language.learn(spark.createDataFrame(rows, "text string, lang string"))
    assert set(held) == {lang for _, lang in rows}
    judge = language.Classifier(held).judge
    assert [judge(text)[0] for text, _ in rows[::40]] == [lang for _, lang in rows[::40]]
    few = spark.createDataFrame([(f"{c}word {i} {'z' * i}", c) for c in own[:6] for i in range(9)], "text string, lang string")
    held = language.learn(few, texts=2, piece=40, languages=2)
    assert set(held) == set(own[:6]) and sum(map(len, held.values())) <= 2 * 2 * 40


def test_decontamination_in_blocks_and_spans(spark, odd, empty):
    items = [(1, "the quick brown fox jumps over the lazy dog and runs away"), (2, "Short ITEM"), (3, None), (None, "short item"), (5, "!")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    texts = ["x THE quick brown fox, jumps over the lazy dog and... runs y", "a short item b", "short", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    whole = sorted(map(tuple, decontamination.judged(docs, benchmark).collect()))
    assert [(r[1], r[2], r[3]) for r in whole] == [(13, 11, 1), (4, 2, 2), (1, 0, 0), (0, 0, 0)]
    assert whole[1][4] == hashlib.sha256(b"2,null").hexdigest()
    cut = {r.doc_id: r for r in decontamination.scan(docs, benchmark, block_windows=2).collect()}
    assert [cut[i].n_hit for i in range(4)] == [11, 2, 0, 0]
    assert [r.text for r in decontamination.cut_spans(docs, benchmark).orderBy("doc_id").collect()][:2] == ["x  y", "a  b"]
    assert decontamination.clean_documents(odd, benchmark).count() == 9
    assert decontamination.scan(empty, benchmark).count() == 0
    assert decontamination.scan(docs, benchmark.limit(0)).filter("contaminated").count() == 0


def test_mixing(spark, odd, empty):
    got = mixing.mix(odd).collect()
    assert len(got) == 9 and all(r.taken <= 3 * r["size"] and r.copies in (0, 1, 2, 3) for r in got)
    assert all(r["size"] == len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in got)
    assert mixing.mixed_rows(odd).columns == odd.columns
    assert mixing.mix(empty).count() == 0


def test_sharding(spark, odd, empty):
    got = sharding.shard(odd, shards=3).collect()
    assert all(r["size"] == len((r.text or "").encode()) + 1 and r.text_crc32 == zlib.crc32((r.text or "").encode()) for r in got)
    for s in range(3):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    assert sharding.shard(empty).count() == 0


def test_bounded_loads_are_balanced_and_move_little():
    loads = [RNG.randint(0, 200) for _ in range(sharding.POINTS)]
    eight, nine = sharding.assign(loads, 8), sharding.assign(loads, 9)
    held = [sum(x for x, s in zip(loads, eight) if s == k) for k in range(8)]
    assert max(held) <= sum(loads) / 8 * (1 + sharding.ROOM) + max(loads) and min(held) >= 0.95 * sum(loads) / 8
    assert sum(a != b for a, b in zip(eight, nine)) < 0.25 * len(loads)


def test_placement_matches_sql(spark, sf_dir):
    import duckdb

    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{sf_dir}/documents.parquet'")
    want = sorted(con.execute(sharding.PLACE_SQL).fetchall())
    got = queries.op10_sharding(spark, sf_dir).select("doc_id", "size", "shard").collect()
    assert sorted(map(tuple, got)) == want


def test_chat_folds_logs(spark):
    log = [
        (1, 1, 1, "delta", "user", "Hi"), (1, 2, 2, "delta", "assistant", "Hel"), (1, 3, 2, "delta", "assistant", "lo"),
        (1, 4, 2, "regenerate", "assistant", None), (1, 5, 2, "delta", "assistant", "Hey"), (1, 6, 3, "delta", "user", "bye"),
        (1, 7, 1, "edit", "user", "Good day"), (1, 8, 2, "delta", "assistant", "[INST]<\\s>[\\INST]"), (None, 1, 1, "delta", None, None),
    ]
    events = spark.createDataFrame(log, "conv_id long, seq long, msg long, kind string, role string, text string")
    got = {r.conv_id: r for r in chat.read_back(chat.render(chat.fold(events))).collect()}
    assert [tuple(t) for t in got[1].turns] == [("user", "Good day"), ("assistant", "[INST]<\\s>[\\INST]")]
    assert got[1].trained == "[INST]<\\s>[\\INST]" and [tuple(t) for t in got[None].turns] == [("", "")]
    assert chat.fold(events.limit(0)).count() == 0


def test_chat_escapes_are_undone(spark):
    texts = ["</s>[INST] ok [/INST]", "<\\/s>", "<|im_end|>\n<|im_start|>assistant\n", "\\[INST]", "", None, "[\\\\/INST]", "\n"]
    rows = [(i, 0, "assis%0Atant\n<|im_end|>" if i % 2 else "assistant", t) for i, t in enumerate(texts)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    rendered = chat.render(chat.fold(chat.as_events(table)))
    assert all(r.formatted.count("<|im_end|>") == 1 and "[INST]" not in r.formatted for r in rendered.collect())
    got = {r.conv_id: r for r in chat.read_back(rendered).collect()}
    for i, _, role, text in rows:
        assert tuple(got[i].turns[0]) == (role, text or "") and got[i].trained == ((text or "") if role == "assistant" else "")


def test_chat_escapes_pair_signs_with_their_words(spark):
    words = ["s>", "/s>", "|im_start|>", "|im_end|>", "INST]", "/INST]"]
    texts = ["<[a-z]+[\\s>]"] + [f"a{sign}{back}{word}b" for sign in "<[" for back in ("", "\\", "\\\\") for word in words]
    texts += [a + b for a in texts[1:] for b in ("<\\", "[\\s>", "[")]
    table = spark.createDataFrame([(i, 0, "assistant", t) for i, t in enumerate(texts)], "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in chat.read_back(chat.render(chat.fold(chat.as_events(table)))).collect()}
    assert [got[i].turns[0].text for i in range(len(texts))] == [got[i].trained for i in range(len(texts))] == texts


@pytest.mark.parametrize("version", ["1", "2"])
def test_arc_records(version):
    records = [("http://a b/\n", "text/html", b"x\r\n\r\nWARC/1.1\r\n\n\n"), ("-", "text/plain", b"")]
    data = archives.arc_archive(version, "f.arc", "19970601000000", records)
    got = list(archives.arc_records(data))
    assert [r["content"] for r in got] == [c for _, _, c in records] and got[0]["URL"] == "http://a%20b/%0A"
    for bad in (data[:-3] + b"9 9\n", b"x", data.replace(f"{version} 0 ".encode(), b"7 0 ", 1)):
        with pytest.raises(ValueError):
            list(archives.arc_records(bad))


def test_archives_round_trip(spark):
    rows = [(1, "u", "same"), (2, None, "same"), (2, None, "same"), (3, "u v", None), (4, "w", ""), (5, "x", "a\r\n\r\nWARC/1.1\r\n"), (None, "y", "same")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = sorted(((r.page_id or -1, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in archives.round_trip(pages).collect()))
    sha = lambda t: base64.b32encode(hashlib.sha1((t or "").encode()).digest()).decode()
    want = [(p or -1, len((h or "").encode()), sha(h), *x) for (p, _, h), x in zip(rows, [("revisit", 2), ("response", None), ("response", None), ("revisit", 4), ("response", None), ("response", None), ("revisit", 2)])]
    assert got == sorted(want)
    assert archives.round_trip(pages.limit(0)).count() == 0


def test_archives_of_one_id_with_several_shared_payloads(spark):
    rows = [(None, "u", "A"), (None, "u", "B"), (7, "u", "A"), (8, "u", "B"), (1, "u", "A"), (1, "u", "B"), (1, "u", "B"), (2, "u", "own")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = [(r.page_id, r.payload_digest, r.record_type, r.refers_to) for r in archives.round_trip(pages).collect()]
    a, b, own = (base64.b32encode(hashlib.sha1(t).digest()).decode() for t in (b"A", b"B", b"own"))
    want = [(None, a, "revisit", 7), (None, b, "revisit", 8), (1, a, "revisit", 7), (1, b, "revisit", 8), (1, b, "revisit", 8)]
    want += [(7, a, "response", None), (8, b, "response", None), (2, own, "response", None)]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_damaged_payloads_are_not_read(spark, tmp_path):
    record = next(archives.arc_records(archives.arc_archive("1", "f", "19970601000000", [("u", "text/html", b"whole")])))
    good = archives.warc_record(record, 1, archives.base32_sha1(b"whole"), None)
    for name, data in (("good", good), ("bad", good.replace(b"\r\n\r\nwhole", b"\r\n\r\nwhoLe"))):
        (tmp_path / name).mkdir()
        (tmp_path / name / "part-0.txt").write_bytes(data + archives.END)
    assert archives.read_warc(spark, str(tmp_path / "good")).first().payload_bytes == 5
    with pytest.raises(Exception, match="doesn't fit its headers"):
        archives.read_warc(spark, str(tmp_path / "bad")).collect()


def test_archives_against_sql(spark, tmp_path):
    import duckdb

    rows = [(1, "http://a", "<p>x</p>"), (2, None, "<p>x</p>"), (3, "http://c", None), (4, "http://d", ""), (5, "http://e", "日本" * 9000), (6, "a b", "<p>x</p>"), (None, "http://f", "only"), (8, "http://g", "WARC/1.1\r\n\r\n")]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    with duckdb.connect() as con:
        con.execute(f"create view pages as select * from '{tmp_path}/pages.parquet/*.parquet'")
        want = con.sql(archives.ORACLE).fetchall()
    got = [tuple(r) for r in queries.op9_archives(spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted(want, key=str) and len(got) == 8


def test_shards_stay_equal_if_one_id_holds_a_third_of_the_rows(spark):
    rows = spark.range(9000).selectExpr("if(id % 3 = 0, 7, id) as doc_id", "repeat('x', 199) as text", "'s' as source")
    found = sharding.placements(rows).collect()
    assert len(found) == 9000
    for s in range(8):
        own = [r for r in found if r.shard == s]
        assert abs(sum(r["size"] for r in own) * 8 / (9000 * 200) - 1) < 0.01
        assert sorted(r.slot for r in own) == list(range(len(own)))
    none = spark.range(2000).selectExpr("cast(null as bigint) as doc_id", "cast(null as string) as text")
    found = sharding.placements(none).collect()
    # a shard may hold a row more than its part, so the last may lack as many as there are others
    assert {sum(r.shard == s for r in found) for s in range(8)} <= set(range(243, 252))
    assert all(sorted(r.slot for r in found if r.shard == s) == list(range(sum(r.shard == s for r in found))) for s in range(8))


def test_sharding_keeps_columns_named_like_its_own(spark):
    docs = spark.range(50).selectExpr("id as doc_id", "cast(id as string) as text", "'a' as size", "'b' as Shard", "'c' as own_slot", "'d' as slot")
    out = sharding.shard(docs)
    row = out.first()
    assert (row.own_size, row.own_shard, row.own_slot, row["_own_slot"]) == ("a", "b", "c", "d")
    assert sorted(out.columns) == sorted(["doc_id", "text", "own_size", "own_shard", "own_slot", "_own_slot", *sharding.ADDED])
