import hashlib
import html
import os
import re
import textwrap
import time
from collections import Counter

import duckdb
import pytest
from conftest import rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sigtrack.llm import chat, licenses, mixing, webpage


def van_der_corput(k):
    return int(format(k, "048b")[::-1], 2)


def test_points_below(spark):
    bounds = [0, 1, 5 << 40, (1 << 48) // 3, 1 << 47, 1 << 48]
    df = spark.createDataFrame([(n, b) for n in range(70) for b in bounds], "n long, b long")
    for r in df.withColumn("x", mixing.points_below(F.col("n"), 7, F.col("b"))).collect():
        assert r.x == sum(van_der_corput(k) < r.b for k in range(r.n))


def test_slots_are_ranked_and_proportional(spark):
    sources = spark.createDataFrame([("a", 0, 6400.0), ("b", 1, 2000.0), ("c", 2, 0.0), ("d", 3, 100.0)], "source string, s int, target double")
    got = mixing.slots(sources, 10).orderBy("slot").collect()
    seen = {}
    for r in got:
        assert r.rank == seen.get(r.s, 0)
        seen[r.s] = r.rank + 1
    assert len(got) == 850 and all(abs(seen[s] - n) <= 3 for s, n in ((0, 640), (1, 200), (3, 10)))
    for a in range(0, 800, 100):
        assert abs(sum(r.s == 0 for r in got[a : a + 100]) - 75.3) < 6


DOCS = "doc_id long, text string, source string, row string, size string, target string"


def mixed_docs(spark):
    data = [(i, f"w{i} " * (i % 13), ("a", "b", None, "c")[i % 4] if i % 3 else "a") for i in range(150)]
    data += [(500, None, "z"), (501, "", "z"), (502, "x " * 30000, "big"), (None, "no id here", "a")]
    return spark.createDataFrame([(*r, "x", "y", "z") for r in data], DOCS)


def test_mix_equals_sql(spark):
    docs = mixed_docs(spark)
    for df in (docs, docs.where("source = 'z'"), docs.limit(0), docs.where("source is null")):
        documents = df.select("doc_id", "text", "source").toPandas()
        con = duckdb.connect()
        con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
        con.executemany("INSERT INTO documents VALUES (?, ?, ?)", [[None if x != x else x for x in r] for r in documents.itertuples(index=False)]) if len(documents) else None
        want = sorted(map(repr, con.execute(mixing.oracle(4)).fetchall()))
        names = ("doc_id", "size", "source_size", "target", "taken", "first_slot", "first_place", "last_slot", "n_pieces")
        got = sorted(repr(tuple(-1 if r[n] is None and n.endswith(("slot", "place")) else r[n] for n in names)) for r in mixing.mix(df, 4).collect())
        assert got == want
    found = mixing.mix(docs, 4).collect()
    assert all(r.taken <= 2 * r.size and r.taken == r.taken_0 + r.taken_1 for r in found)


def test_the_schedule_decides_the_mix(spark, monkeypatch):
    docs = mixed_docs(spark).where("source <> 'big'").select("doc_id", "text", "source")
    slots = lambda: {r.doc_id: (r.first_slot, r.last_slot) for r in mixing.mix(docs, 4).collect()}
    total = sum(r.target for r in mixing.targets(mixing.sized(docs)).collect())
    share = {r.source: r.target / total for r in mixing.targets(mixing.sized(docs)).collect()}
    parts = mixing.blocks(docs, 4).collect()
    for n in (50, 100, 200):  # every prefix of the mix holds the sources near their shares
        words = Counter()
        for r in parts:
            if r.slot < n:
                words[r.source] += r.words
        assert all(abs(words[s] / sum(words.values()) - x) < 0.06 for s, x in share.items())
    other = slots()
    monkeypatch.setattr(mixing, "_reversed_bits", lambda n: (n * 7919 * 4096) % F.lit(1 << 48))
    assert slots() != other


def test_documents_without_an_id_are_spread(spark):
    docs = spark.range(100_000).select(F.lit(None).cast("long").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"), F.lit("s").alias("source"))
    cells = mixing.sized(docs).groupBy(F.substring("draw", 1, 2)).count().collect()
    assert len(cells) == 256 and max(r["count"] for r in cells) < 600


def test_mixed_keeps_columns_of_any_name(spark):
    docs = spark.createDataFrame([(i, f"a b c d {i}", f"s{i % 2}", f"row {i}", 7, i, None) for i in range(40)], "doc_id long, text string, source string, _mix_row string, c1 int, row long, slot string")
    got = mixing.mixed(docs, 4)
    assert got.columns == docs.columns and got.count() > 20 and all(r._mix_row == f"row {r.doc_id}" and r.c1 == 7 and r.row == r.doc_id for r in got.collect())


def test_mixed_texts(spark):
    docs = mixed_docs(spark).withColumn("taken_0", F.lit(5)).withColumn("n_chars", F.length("text").cast("long"))
    out = mixing.mixed(docs, 4)
    taken = {r.doc_id: r.taken for r in mixing.mix(docs, 4).collect() if r.taken}
    assert out.columns == docs.columns
    got = out.collect()
    assert {r.doc_id: len(r.text.split()) for r in got} == taken and all(r.n_chars == len(r.text) for r in got)


def brute_mix(spark, docs, n):
    """(slot, place, source, doc_id, copy, first word, words, text) of the mix in slot order, a word at a time."""
    data = {(r.doc_id, r.source): r.text or "" for r in docs.collect()}
    md5 = lambda t: hashlib.md5(t.encode()).hexdigest()
    draw = lambda s: lambda d: (md5(f"mix{'' if d is None else d}|{md5(data[d, s])}"), d)
    target = {r.source: r.target for r in mixing.targets(mixing.sized(docs)).collect()}
    order = sorted(target, key=lambda s: (s is None, s or ""))
    cut = {}
    for s in order:
        words = [(copy, d, i) for copy in (0, 1) for d in sorted((d for d, x in data if x == s), key=draw(s)) for i in range(len(data[d, s].split()))][: int(target[s] + 0.5)]
        cut[s] = [words[i : i + n] for i in range(0, len(words), n)]
    total, at, upper = sum(map(len, cut.values())), 0, []
    for s in order:
        at += len(cut[s])
        upper.append((int(at / total * (1 << 48)), s))
    left, mix = {s: list(b) for s, b in cut.items()}, []
    for k in range(total):
        s = next(s for u, s in upper if van_der_corput(k) < u)
        mix += [(k, s, left[s].pop(0))] if left[s] else []
    mix += [(total + i, s, b) for i, (s, b) in enumerate((s, b) for s in order for b in left[s])]
    out = []
    for slot, s, block in mix:
        place = 0
        while place < len(block):
            copy, d, first = block[place]
            size = sum(1 for c, e, _ in block if (c, e) == (copy, d))
            out.append((slot, place, s, d, copy, first, size, " ".join(data[d, s].split()[first : first + size])))
            place += size
    return out


def test_blocks_in_slot_order_equal_brute_force(spark):
    docs = mixed_docs(spark)
    for df, n in ((docs.where("source <> 'big'"), 4), (docs.where("source <> 'big'"), 7), (docs, 256)):
        want = brute_mix(spark, df.select("doc_id", "source", "text"), n)
        got = mixing.blocks(df, n).collect()
        assert [(*r[:-1], " ".join(r.text.split())) for r in got] == want
        if n == 4:
            size = {r.doc_id: r.text for r in df.collect()}
            for d in (7, 11, None):
                assert "".join(r.text for r in sorted((r for r in got if r.doc_id == d and r.copy == 0), key=lambda r: r.first_word)) == size[d]
        first = {}
        for r in want:
            first.setdefault(r[3], []).append(r[0])
        found = {r.doc_id: r for r in mixing.mix(df, n).collect() if r.taken}
        assert {d: (r.first_slot, r.last_slot, r.n_pieces) for d, r in found.items()} == {d: (x[0], x[-1], len(x)) for d, x in first.items()}
        assert [r.doc_id for r in mixing.mixed(df, n).collect()] == list(first)
    assert mixing.blocks(docs.limit(0)).count() == 0


def test_blocks_of_files_equal_those_of_stored_rows(spark, tmp_path):
    docs = mixed_docs(spark).unionByName(mixed_docs(spark).limit(3))
    docs.repartition(3).write.parquet(str(tmp_path / "docs"))
    files = spark.read.parquet(str(tmp_path / "docs"))
    parts = lambda df: [tuple(r) for r in df.collect()]
    got = parts(mixing.blocks(files, 7, row=mixing.file_row()))
    assert got == sorted(got, key=lambda r: r[:2]) and got == parts(mixing.blocks(files, 7))
    assert [(slot, place) for slot, place, *_ in got] == sorted({(slot, place) for slot, place, *_ in got})


def test_blocks_without_a_slot_are_numbered_on(spark):
    sources = spark.createDataFrame([("a", 0, 6400.0), ("b", 1, 2000.0), ("c", 2, 0.0), ("d", 3, 100.0), ("e", 4, 30.0)], "source string, s int, target double")
    got = {(r.s, r["rank"]) for r in mixing.slots(sources, 10).collect()}
    rest = [(s, k) for s, n in ((0, 640), (1, 200), (3, 10), (4, 3)) for k in range(n) if (s, k) not in got]
    assert rest and [tuple(r) for r in mixing.tail(sources, 10).orderBy("slot").collect()] == [(853 + i, *x) for i, x in enumerate(rest)]


@settings(max_examples=300, deadline=None)
@given(st.sampled_from(["user", "assistant", "system", "tool", "", "[AS]", "\\"]), st.lists(st.sampled_from([*chat.CONTROL, "\\", "\n", " ", "<", "[", "/", "a", "é", "</", "[/IN"]), max_size=8).map("".join))
def test_turns_round_trip(role, text):
    out, start, length = chat.formatted_turn(role, text)
    parser, got = chat.Parser(), []
    for c in out + chat.formatted_turn("user", "x")[0]:
        got += parser.feed(c)
    assert got == [(role, text), ("user", "x")] and not parser.rest
    if role == "assistant":
        assert "".join(t for _, t in chat.Parser().feed(" " + out[start : start + length] + "</s>")) == text
    else:
        assert length == 0
    if not any(c in text for c in (*chat.CONTROL, "\\")) and role in chat.OPEN:
        assert out == chat.OPEN[role] + text + chat.CLOSE[role]


def test_parser_refuses_what_is_not_in_the_grammar():
    for bad in ("x", "[INST] a <s> [/INST]", "[INST] a [INST] b [/INST]"):
        with pytest.raises(ValueError):
            chat.Parser().feed(bad)


def test_conversations_read_back(spark):
    data = [(1, 1, "assistant", "yes </s>"), (1, 0, "user", "a\\b"), (1, 1, "assistant", "twin"), (2, 0, None, None), (2, None, "system", ""), (None, 0, "assistant", "x" * 100_000), (3, 5, "tool", "[INST]")]
    df = spark.createDataFrame([(*r, 1) for r in data], "conv_id long, turn long, role string, text string, formatted int")
    got = {r.conv_id: r for r in chat.read_back(chat.format_turns(df)).collect()}
    sha = lambda *turns: hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
    assert got[1].n_turns == 3 and got[1].turns_sha256 == sha(("user", "a\\b"), ("assistant", "twin"), ("assistant", "yes </s>"))
    assert got[1].loss_chars == 12 and got[1].loss_sha256 == hashlib.sha256(b"twinyes </s>").hexdigest()
    assert got[2].turns_sha256 == sha(("system", ""), ("", "")) and got[2].loss_chars == 0
    assert got[None].loss_chars == 100_000 and got[3].turns_sha256 == sha(("tool", "[INST]"))
    assert chat.read_back(chat.format_turns(df.limit(0))).count() == 0


ARTICLE = "<article><header><h1>Title &amp; more</h1></header><p>One&nbsp;<b>two\n three<br>four<p>Five<ul><li>a<li>b</ul><div class='comments'><p>nice!</div><aside>x</aside></article>"


def test_page_markup():
    page = f"<html><head><title>t</title><style>p{{}}</style></head><body class='has-sidebar'><header>top</header><nav><a>m</a></nav><div id='cookie-notice'>c</div><!-- x > y -->{ARTICLE}<div class='sidebar'>s</div><form>f<input></form><script>if (a<b) x('</p>')</script><footer>&copy;</footer>"
    lines = webpage.lines_of(page)
    assert [t for t, sure in lines if sure] == ["Title & more", "One two three four", "Five", "a", "b"]
    assert [t for t, sure in lines if not sure] == []
    assert webpage.lines_of("") == [] and webpage.lines_of("a < b <p>&lt;p&gt;") == [("a < b", False), ("<p>", False)]
    assert webpage.lines_of("<p title='a>b'>x</p><script>never closed") == [("x", False)]
    assert webpage.lines_of("<DIV>A<SPAN>b</SPAN>c</DIV>") == [("Abc", False)]


def test_page_markup_by_whole_names():
    page = "<article class='social-science ads-law'><p class='share-price'>kept</p><div class='ad'>gone</div><div id='Sidebar'>gone</div></article><div role='main'>m</div>"
    assert webpage.lines_of(page) == [("kept", True), ("m", True)]


def test_page_markup_by_parts_of_names():
    page = "<div class='site-footer'>f</div><div id='ad-slot'>a</div><div class='with-sidebar'>w</div><div class='user-comments'>c</div><div class='notice'>n</div><main><div class='notice'>Correction</div><div class='article-footer'>By me</div><div class='ad-slot-1'>a</div><p class='no-ads'>kept</p><div class='reader_comments'>c</div></main>"
    assert webpage.lines_of(page) == [("w", False), ("Correction", True), ("By me", True), ("kept", True)]


def test_titles_and_headings_are_marked():
    page = "<title>Two  &amp; one</title><h2>Out</h2><p>Two & one</p><article><h1>First</h1><p>First</p><h3>Part</h3><p>Part</p><p>x</p></article><p>First</p><p>Part</p>"
    assert [(t, named) for t, _, named in webpage.marked_lines(page)] == [("Out", False), ("Two & one", True), ("First", True), ("First", True), ("Part", True), ("Part", True), ("x", False), ("First", True), ("Part", False)]


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_no_line_of_a_given_article_is_lost(spark, sf):
    """The given pages hold one article each, of a heading and paragraphs: texts taken from these by patterns alone."""
    path = f"/root/testdata/{sf}/pages.parquet"
    if not os.path.exists(path):
        pytest.skip("the synthetic tables are not here")
    pages = spark.read.parquet(path)
    want = {}
    for r in pages.collect():
        article = re.search(r"<article[^>]*>(.*?)</article>", r.html or "", re.S)
        blocks = re.findall(r"<(h1|p)\b[^>]*>(.*?)(?=</(?:h1|p)>|<p\b|$)", article[1] if article else "", re.S)
        lines = [" ".join(html.unescape(re.sub(r"<[^>]*>", lambda m: " " if m[0].startswith("<br") else "", b)).split()) for _, b in blocks]
        want[r.page_id] = "\n".join(x for x in lines if x)
    got = {r.page_id: r.text for r in webpage.main_text(pages).collect()}
    assert got == want and sum(map(bool, want.values())) > 0.9 * len(want)


def test_two_pages_of_four_tell_nothing(spark):
    page = lambda i: f"<title>T{i}</title><main><h1>{'Same' if i < 4 else i}</h1><p>{'Shared passage' if i % 4 < 2 else i}</p><p>Own {i}</p><p>Our offer</p></main>"
    data = [(i, f"http://q.org/{i}", page(i)) for i in range(4)] + [(10 + i, f"http://r.org/{i}", page(i + 2)) for i in range(2)]
    got = {r.page_id: r.text for r in webpage.main_text(spark.createDataFrame(data, "page_id long, url string, html string")).collect()}
    assert got[0] == "Same\nShared passage\nOwn 0" and got[2] == "Same\n2\nOwn 2"  # headings stay, what all four share goes
    assert got[10] == "Same\n2\nOwn 2\nOur offer"


def test_odd_markup_takes_linear_time():
    for page in ("<a " * 350_000, "<a x='" * 150_000, "<div>" * 50_000 + "</span>" * 50_000, "<b>" * 30_000 + "<li></li>" * 30_000, "<!-- " * 200_000, "<a  b = " * 100_000):
        start = time.process_time()
        webpage.lines_of(page)
        assert time.process_time() - start < 5


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from("abc"), max_size=9), st.lists(st.sampled_from("abc"), max_size=9))
def test_common_lines(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
    for most_pairs in (1000, 2):
        found = webpage.common_lines(a, b, most_pairs)
        assert len(found) == best[-1][-1] and found == sorted(set(found))
        it = iter(b)
        assert all(a[i] in it for i in found)


def brute_text(pages):
    """Texts by (page_id, url, html), every step in plain Python and all pages of a host at once."""
    split = lambda u: webpage._URL.match(u or "")
    order = sorted((split(u)[1].lower().removeprefix("www."), re.sub(r"(\.html?|/)+$", "", split(u)[2]), i, k) for k, (i, u, h) in enumerate(pages))
    lines = [webpage.lines_of(h or "") for *_, h in pages]
    titles = [{t for t, _, named in webpage.marked_lines(h or "") if named} for *_, h in pages]
    order = [o for o in order if lines[o[3]]]
    shared, hosts = {}, Counter(o[0] for o in order)
    for n, (host, path, _, k) in enumerate(order):
        near = [order[m] for m in (n - 1, n + 1) if 0 <= m < len(order) and order[m][0] == host]
        for o in sorted(near, key=lambda o: len(os.path.commonprefix([o[1], path])), reverse=True):
            common = webpage.common_lines([t for t, _ in lines[k]], [t for t, _ in lines[o[3]]])
            if 0 < len(common) < len(lines[k]):
                shared[k] = host, common
                break
    shared = {k: (host, [i for i in c if lines[k][i][0] not in titles[k]]) for k, (host, c) in shared.items()}
    votes = Counter((host, t) for k, (host, c) in shared.items() for t in {lines[k][i][0] for i in c if lines[k][i][1]})
    gone = {k: {i for i in c if not lines[k][i][1] or (votes[host, lines[k][i][0]] >= 4 and 2 * votes[host, lines[k][i][0]] >= hosts[host])} for k, (host, c) in shared.items()}
    return [(i, u, "\n".join(t for n, (t, _) in enumerate(lines[k]) if n not in gone.get(k, ()))) for k, (i, u, _) in enumerate(pages)]


def test_pages_of_a_site(spark):
    plain = lambda i: f"<body><div>Home page of us</div><p>Story {i} begins.</p><p>And ends {i}.</p><div>Call us now</div>"
    data = [(i, f"http://www.site.org/a/{i:03}.html?x={i}", plain(i)) for i in range(40)]
    data += [(100, None, None), (101, "http://b.org/x", ""), (102, "http://c.org/", "<p>Alone here"), (103, "http://d.org/1", plain(1)), (104, "http://d.org/1", plain(1)), (0, "http://www.site.org/a/zzz.html", ARTICLE)]
    pages = spark.createDataFrame([(*r, "x", 1, ["l"]) for r in data], "page_id long, url string, html string, text string, row int, lines array<string>")
    got = webpage.main_text(pages)
    by = {}
    for r in got.collect():
        by.setdefault(r.page_id, set()).add(r.text)
    assert all(by[i] == {f"Story {i} begins.\nAnd ends {i}."} for i in range(1, 40))
    assert by[0] == {"Story 0 begins.\nAnd ends 0.", "Title & more\nOne two three four\nFive\na\nb"}
    assert by[100] == by[101] == {""} and by[102] == {"Alone here"}
    assert by[103] == by[104] == {"Home page of us\nStory 1 begins.\nAnd ends 1.\nCall us now"}
    assert sorted(map(repr, brute_text(data))) == sorted(repr((r.page_id, r.url, r.text)) for r in got.collect())
    assert got.where("n_chars <> length(text)").count() == 0 and webpage.main_text(pages.limit(0)).count() == 0
    found = webpage.differences(webpage.neighbours(webpage.extracted(pages)))
    assert found.where("other is not null").count() == 43 and found.where("other is null").count() == 1  # all pages with lines and a neighbour
    spark.conf.set("spark.sql.shuffle.partitions", "11")
    try:
        assert rows(webpage.main_text(pages)) == rows(got)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_shared_lines_of_articles_go_by_their_rate(spark):
    card = lambda i: f"<body><div>Home page of us</div><article><h3>Card {i}</h3></article><div>Body {i} is long.</div><div>Call us now</div>"
    story = lambda i: f"<body><div>Home page of us</div><article><p>{'Quote' if i < 12 else 'Story %d' % i}</p><p>Text {i}</p><p>Read more like this</p></article><div>Call us now</div>"
    data = [(i, f"http://t.org/{i:03}", card(i)) for i in range(30)] + [(100 + i, f"http://s.org/{i:03}", story(i)) for i in range(30)]
    data += [(200, "http://c.org/1", card(1)), (201, "http://c.org/1", card(1)), (202, "http://d.org/1", card(1))]
    data += [(300, "http://e.org/1", story(1)), (301, "http://e.org/2", story(2))]
    got = {r.page_id: r.text for r in webpage.main_text(spark.createDataFrame(data, "page_id long, url string, html string")).collect()}
    assert all(got[i] == f"Card {i}\nBody {i} is long." for i in range(30))
    assert all(got[100 + i] == ("Quote" if i < 12 else f"Story {i}") + f"\nText {i}" for i in range(30))
    assert got[200] == got[201] == got[202] == "Home page of us\nCard 1\nBody 1 is long.\nCall us now"
    assert got[300] == "Quote\nText 1\nRead more like this"  # two pages tell nothing about articles
    assert sorted(map(repr, brute_text(data))) == sorted(repr((i, u, got[i])) for i, u, _ in data)


def test_license_scan(spark):
    mit, apache = "Released under the MIT License.", "some code\nLicensed under the Apache License, Version 2.0.\nmore"
    data = [("p/LICENSE", mit), ("p/a.c", "x"), ("p/q/b.c", apache), ("p/q/r/c.c", None), ("p/q/COPYING.txt", "Licensed under CC BY-NC 4.0."), ("top.c", ""), ("z/d.c", "we licensed a song"), ("z/d.c", "long " * 50000), (None, mit), ("/abs/e.c", "y"), ("pq/f.c", "x")]
    files = spark.createDataFrame([(*r, "c", 1) for r in data], "path string, text string, license string, row int").withColumn("dir", F.lit("d"))
    got = {(r.path, r.own_license): (r.license, r.from_dir) for r in licenses.scan(files).collect()}
    assert got["p/a.c", None] == ("MIT", "p") and got["p/q/b.c", "Apache-2.0"] == ("Apache-2.0", None) and got["p/q/r/c.c", None] == ("CC-BY-NC-4.0", "p/q")
    assert got["top.c", None] == got["z/d.c", None] == got["/abs/e.c", None] == got["pq/f.c", None] == (None, None) and got[None, "MIT"] == ("MIT", None)
    assert licenses.scan(files).count() == len(data) and licenses.scan(files.limit(0)).count() == 0
    root = files.select("path", "text").union(spark.createDataFrame([("LICENSE", mit)], "path string, text string"))
    assert {r.license for r in licenses.scan(root).where("own_license is null and path is not null and path not like 'p/q%' ").collect()} == {"MIT"}
    assert {r.given_license for r in licenses.scan(files).collect()} == {"c"}  # given columns are kept


def test_licence_files_and_wrapped_headers(spark):
    texts = dict(licenses.TEXTS)
    comment = lambda t, lead, width: "\n".join(lead + x for x in textwrap.wrap(t, width))
    header = {lic: t for lic, t in licenses.NOTICES if len(t) > 150}
    code = "\nimport sys\n\ndef main(argv):\n    return len(argv)\n"
    data = [(f"{lic}/LICENSE", t.replace("<year> <copyright holders>", "2021 Ada Example and contributors").replace("copyright holder", "copyright owner"), lic) for lic, t in texts.items()]
    data += [(f"{lic}/src/x.py", code, None) for lic in texts]
    data += [(f"w/{lic}{k}.c", f"// Copyright 2020 Somebody\n//\n{comment(t, lead, width)}\n{code}", lic) for lic, t in header.items() for k, (lead, width) in enumerate([("// ", 72), (" * ", 100), ("# ", 60)])]
    data += [("n/a.txt", "The license of this software is a matter of taste.\n" * 40, None), ("n/LICENSE", "All rights reserved, and more of the kind.", None)]
    got = {r.path: r for r in licenses.scan(spark.createDataFrame([d[:2] for d in data], "path string, text string")).collect()}
    assert {p: got[p].own_license for p, _, _ in data} == {p: lic for p, _, lic in data}
    assert all(got[f"{lic}/src/x.py"].license == lic and got[f"{lic}/src/x.py"].from_dir == lic for lic in texts) and got["n/a.txt"].license is None


def test_licence_parts_are_those_of_all_runs(spark):
    """Against every run of every length: a key term in one of its lines, and as many terms of some notice as the notice needs."""
    notice = [t for _, t in licenses.NOTICES][2]
    words = notice.split(" ")
    wrapped = "\n".join(" ".join(words[i : i + 9]) for i in range(0, len(words), 9))
    texts = [None, "", "\n\n", "plain words only", f"code\n{wrapped}\ncode", f"{wrapped}\n{wrapped}", "x\nReleased under\nthe MIT License\ny", "MIT license\n" * 40, "long " * 20000 + "\nSPDX-License-Identifier: MIT"]
    vectors = licenses._weights({w: 1 + len(w) / 10 for *_, t in licenses.TEMPLATES for w in licenses._terms(t)})
    notices = [v for (kind, *_), v in zip(licenses.TEMPLATES, vectors) if kind == "header"]
    keys = set().union(*(licenses._key_terms(v, licenses.LEAST) for v in notices))
    needs = [(set(v), licenses._fewest_terms(v, licenses.LEAST)) for v in notices]

    def wanted(text):
        lines = (text or "").split("\n")
        runs = [lines[i : i + k] for k in licenses.RUNS for i in range(len(lines) - k + 1)]
        held = lambda run: set(licenses._terms("\n".join(run)))
        return sorted({"\n".join(r) for r in runs if held(r) & keys and any(len(held(r) & v) >= n for v, n in needs)})

    rows = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    got = {r.id: sorted(p.part for p in r.parts if p.kind == "header") for r in licenses.with_parts(rows, vectors).collect()}
    assert got == {i: wanted(t) for i, t in enumerate(texts)}
    assert got[4] and got[6] and not got[0] and not got[3]
