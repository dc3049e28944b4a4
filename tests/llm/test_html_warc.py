import gzip
import hashlib

import pytest

from kinfold.llm import html_template as ht
from kinfold.llm import warc

PAGES = [
    ("<article><h1>T</h1><p>a&amp;b &lt;c&gt;<p>d<br>e</article>", "T a&b <c> d e"),
    ("<nav>menu</nav><main><p>x</p><aside>side</aside><p>y <b>bo</b>ld</p></main><footer>f</footer>", "x y bold"),
    ("<div class='sidebar'>no</div><div id=content><p>yes</p><form>f<input></form></div><div class=\"comments\"><article>reader</article></div>", "yes"),
    ("<body class='with-sidebar'><article>kept</article></body>", "kept"),
    ("<header>top</header><p>one\n\n two</p><script>var a='<p>no</p>'</script><style>p{}</style><div class=cookie-notice>c</div>three<!-- c -->", "one two three"),
    ("<p>un<i>clo</b>sed <ul><li>a<li>b</ul> tail", "unclosed a b tail"),
    ("plain &copy; &#233; &#x41; &am", "plain © é A &am"),
    (None, ""), ("", ""), ("<", "<"), ("a < b <3", "a < b <3"), ("<p hidden>x</p><p>y", "y"), ("<div>" * 3000 + "deep", "deep"), ("<!-- open", ""), ('<a href="x>y', "y"),
]


@pytest.mark.parametrize(("page", "want"), PAGES)
def test_main_text(page, want):
    assert ht.main_text(page) == want


def test_templates_of_a_host_go_and_its_articles_stay(spark):
    box = "<div><p>Subscribe 10 now</p><span>to this</span></div>"
    page = lambda i: f"{box}<p>Story number {i} of the day</p><div><p>All rights kept</p></div>"
    rows = [(i, f"https://A.example:80/{i}", page(i)) for i in range(30)]
    rows += [(100 + i, f"http://b.example/{i}", page(i)) for i in range(4)]
    rows += [(200 + i, f"http://c.example/{i}", f"<article><p>Quoted by all</p><p>{i}</p></article>{box}") for i in range(30)]
    rows += [(300, None, "<p>x</p>"), (None, "::", None), (300, None, "<p>x</p>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in ht.extract(df).collect()}
    assert got[5] == "Story number 5 of the day"
    assert got[101] == "Subscribe 10 now to this Story number 1 of the day All rights kept"  # few pages: no template
    assert got[207] == "Quoted by all 7"
    assert got[300] == "x" and got[None] == "" and ht.extract(df).count() == len(rows)
    assert ht.extract(df.where("false")).count() == 0


def test_boxes_within_articles_go_and_passages_stay(spark):
    box = "<div><p>By our staff</p><p>More of this</p></div><p class='x1'>Printed on paper</p>"
    page = lambda i: f"<article><h1>Daily</h1><p>Quoted by all</p><div><p>Body {i}</p></div>{box}</article>"
    df = spark.createDataFrame([(i, f"http://d.example/{i}", page(i)) for i in range(30)], "page_id long, url string, html string")
    assert {r.page_id: r.text for r in ht.extract(df).collect()} == {i: f"Daily Quoted by all Body {i}" for i in range(30)}


@pytest.mark.parametrize("broadcast", [10_000, 0])
def test_templates_are_counted_over_different_pages(spark, broadcast):
    menu = "<div><p>Home</p><p>News</p></div>"
    rows = [(i, "http://copied.example/a", f"<div><p>One text copied</p></div><em>{i % 2}</em>") for i in range(12)]
    rows += [(100 + i, f"http://copied.example/{i}", f"<p>Text {i}</p>") for i in range(20)]
    rows += [(200 + i, f"http://hot.example/{i}", f"{menu if i < 12 else ''}<p>{'Quoted' if i < 12 else ''}</p><p>Text {i}</p>") for i in range(100)]
    rows += [(400 + i, f"http://small.example/{i}", f"{menu}<p>Text {i}</p>") for i in range(6)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in ht.extract(df, broadcast=broadcast).collect()}
    assert [got[i] for i in range(12)] == ["One text copied 0", "One text copied 1"] * 6
    assert got[201] == "Quoted Text 1" and got[250] == "Text 50" and got[401] == "Text 1" and len(got) == len(rows)


def plain_extract(rows):
    """Texts of well-formed pages of div, p and em elements, without article: subtrees are
    nested tuples, counted over the different texts of a host."""
    import xml.etree.ElementTree as ET
    from collections import defaultdict

    def form(e):
        return (e.tag, tuple(sorted(e.attrib.items())), (e.text or "").strip(), tuple((form(k), (k.tail or "").strip()) for k in e))

    def blocks(e):
        return [x for x in e.iter() if x is not e and x.tag in ("div", "p") and ("".join(x.itertext()).strip() or len(x))]

    def text(e, gone):
        parts = [e.text or ""]
        for k in e:
            if k.tag in ("div", "p") and form(k) in gone:
                parts.append(" ")
            else:
                parts += [" " if k.tag != "em" else "", text(k, gone), " " if k.tag != "em" else ""]
            parts.append(k.tail or "")
        return "".join(parts)

    trees = {i: ET.fromstring(f"<x>{h}</x>") for i, _, h in rows}
    squeeze = lambda t: " ".join(t.split())
    pages, holds = defaultdict(set), defaultdict(set)
    for i, host, _ in rows:
        page = squeeze(text(trees[i], set()))
        pages[host].add(page)
        for b in blocks(trees[i]):
            holds[host, form(b)].add(page)
    gone = defaultdict(set)
    for (host, f), of in holds.items():
        least = max(ht.FEW_PAGES, min(ht.MIN_PAGES, -(-len(pages[host]) // 2)))
        bare = f[0] == "p" and not f[1]
        if len(of) >= least and (not bare or len(of) >= ht.MIN_SHARE * len(pages[host])):
            gone[host].add(f)
    return {i: squeeze(text(trees[i], gone[host])) for i, host, _ in rows}


def test_extraction_against_brute_force(spark):
    import random

    r = random.Random(4)
    common = ["<div><p>Home</p><p>News</p></div>", "<p>All rights kept</p>", "<div id='t7'>By <em>our</em> staff</div>", "<div><div><p>More</p></div><p>of this</p></div>"]
    own = lambda i: r.choice([f"<p>Story {i} {r.random()}</p>", f"<div><p>Part {i}</p><em>{r.random()}</em></div>"])
    rows = []
    for i in range(150):
        host = r.choice(["a", "a", "b", "c"]) + ".example"
        rows.append((i, host, "".join(r.choice([own(i), own(i), *common[: 4 if host[0] != "c" else 2]]) for _ in range(r.randint(1, 7)))))
    rows += [(500 + k, *rows[k][1:]) for k in range(20)]
    df = spark.createDataFrame([(i, f"http://{h}/{i}", t) for i, h, t in rows], "page_id long, url string, html string")
    got = {x.page_id: x.text for x in ht.extract(df).collect()}
    want = plain_extract(rows)
    assert got == want
    without = {i: ht.main_text(t) for i, _, t in rows}
    assert sum(got[i] != without[i] for i in got) > 0.5 * len(got)  # the counts decide, not the names


def test_very_long_and_clashing_pages(spark):
    long = "<p>" + "word " * 400_000 + "</p>"
    df = spark.createDataFrame([(1, "http://x/1", long, "h", 3), (2, "http://x/2", "<div>" * 20_000 + "in", "k", 4)], "page_id long, url string, html string, host string, code int")
    got = {x.page_id: x.text for x in ht.extract(df).collect()}
    assert len(got[1]) == 5 * 400_000 - 1 and got[2] == "in"


def records(n=6):
    out = []
    for i in range(n):
        payload = (f"<p>{i} é</p>" * 30).encode()
        out.append(warc.record(i, f"http://x/{i}", payload, hashlib.sha1(payload).hexdigest(), "response"))
    return out


def kinds(data):
    return [(k, x["warc-record-id"] if k == "record" else None) for k, _, _, x in warc.salvage(data)]


@pytest.mark.parametrize("zipped", [True, False])
def test_salvage(zipped):
    parts = [warc.member(r) if zipped else r for r in records()]
    clean = b"".join(parts)
    all_ = [("record", f"<urn:page:{i}>") for i in range(6)]
    assert kinds(clean) == all_
    at = len(parts[0]) + len(parts[1]) + len(parts[2]) // 2
    flipped = clean[:at] + bytes([clean[at] ^ 0xFF]) + clean[at + 1 :]
    assert kinds(flipped) == all_[:2] + [("gap", None)] + all_[3:]
    cut = clean[: len(parts[0]) + 40] + clean[len(parts[0]) + len(parts[1]) :]
    assert kinds(cut) == all_[:1] + [("gap", None)] + all_[2:]
    assert kinds(b"junk" * 5 + clean) == [("gap", None), *all_]
    assert kinds(clean[:-30]) == all_[:5] + [("gap", None)]
    # gaps and records cover every byte, in order
    spans = [(s, s + n) for _, s, n, _ in warc.salvage(flipped)]
    assert spans[0][0] == 0 and spans[-1][1] == len(flipped) and all(a[1] == b[0] for a, b in zip(spans, spans[1:], strict=False))
    assert kinds(b"") == []


def test_a_member_of_several_records():
    r = records(3)
    assert kinds(gzip.compress(r[0] + r[1][:-60] + r[2])) == [("record", "<urn:page:0>"), ("gap", None), ("record", "<urn:page:2>")]


def test_round_trip_with_revisits(spark, tmp_path):
    big, small = "x" * 999 + "é", "short"
    rows = [(1, "u", big), (2, "u", big), (7, None, big), (3, "http://a b\n", small), (4, "", small), (5, "u", None), (None, "u", big), (7, "u", big)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    archives = warc.write_archives(pages)
    got = warc.read_archives(archives)
    assert got.where("kind = 'gap'").count() == 0
    r = sorted((x.record_id, x.record_type, x.refers_to_id, x.payload_bytes, x.payload_digest) for x in got.collect())
    sha = lambda t: hashlib.sha1((t or "").encode()).hexdigest()
    assert r == sorted(
        [("<urn:page:1>", "revisit", "<urn:page:7>", 1001, sha(big)), ("<urn:page:2>", "revisit", "<urn:page:7>", 1001, sha(big)), ("<urn:page:7>", "response", None, 1001, sha(big)), ("<urn:page:7>", "response", None, 1001, sha(big)), ("<urn:page:none>", "revisit", "<urn:page:7>", 1001, sha(big))]
        + [(f"<urn:page:{i}>", "response", None, 5, sha(small)) for i in (3, 4)]
        + [("<urn:page:5>", "response", None, 0, sha(""))]
    )
    assert warc.write_archives(pages.where("false")).count() == 0
    (tmp_path / "a.warc.gz").write_bytes(b"bad" + bytes(archives.first()["content"]))
    files = warc.read_files(spark, str(tmp_path / "a.warc.gz"))
    assert files.where("kind = 'gap'").first()["length"] == 3


def test_pages_with_other_columns_and_archives_with_gaps(spark, tmp_path, monkeypatch):
    pages = spark.createDataFrame([(i, "u", f"<p>{i}</p>" * 300, "a", "b") for i in range(5)], "page_id long, url string, html string, sha1 string, winner string")
    pages.write.parquet(f"{tmp_path}/pages.parquet")
    assert warc.op7_warc(spark, str(tmp_path)).count() == 5
    archives = warc.write_archives(pages)
    broken = bytes(archives.first()["content"])
    df = spark.createDataFrame([("x", bytearray(broken[:60] + b"?" + broken[61:]))], "archive_id string, content binary")
    lost = warc.gaps(warc.read_archives(df)).collect()
    assert len(lost) == 1 and lost[0].start == 0 and lost[0].length > 60
    monkeypatch.setattr(warc, "write_archives", lambda p: df)
    with pytest.raises(RuntimeError, match="read back"):
        warc.op7_warc(spark, str(tmp_path))


def test_foreign_members_and_long_headers():
    r = records(3)
    inner = gzip.compress(b"no record here")
    found = kinds(warc.member(r[0]) + inner + warc.member(r[1]))
    assert found == [("record", "<urn:page:0>"), ("gap", None), ("record", "<urn:page:1>")]
    # plain records that hold gzip bytes, the first of them far from the start
    payload = b"x" * 100_000 + inner
    plain = warc.record(7, "u", payload, hashlib.sha1(payload).hexdigest(), "response")
    assert kinds(plain + r[1]) == [("record", "<urn:page:7>"), ("record", "<urn:page:1>")]
    assert kinds(plain[:50_000] + r[1] + plain[-3000:] + r[2])[1:] == [("record", "<urn:page:1>"), ("gap", None), ("record", "<urn:page:2>")]
    assert kinds(b"WARC/1.1\r\n" + b"a" * (warc.HEADER_BYTES + 9) + r[0]) == [("gap", None), ("record", "<urn:page:0>")]


def test_members_that_inflate_without_end_are_quarantined():
    with pytest.raises(warc.zlib.error):
        warc.inflate(memoryview(gzip.compress(bytes(3 << 20))), 1 << 20)
