import base64
import gzip
import hashlib
import io
import os
import random
import re
import time
import uuid
from html import unescape

import pytest
from pyspark.sql import functions as F

from tideline.llm import html_extraction as H
from tideline.llm import url_filters as U
from tideline.llm import warc

PAGES = "page_id long, url string, html string, host string, payload int, digest string, own_judged string, size string, refers_to string, features string"


def table(spark, rows):
    return spark.createDataFrame([(*r, "h", 1, *"dabcd") for r in rows], PAGES)


# --- url filters -------------------------------------------------------------------------------------


def brute_fit(rules, host, path):
    fits = [(h.count(".") + bool(h), len(p), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits, default=None, key=lambda x: (x[0], x[1]))


def test_trie_is_brute_force():
    r = random.Random(1)
    host = lambda: ".".join(r.choice(("a", "b", "com")) for _ in range(r.randint(1, 4)))
    path = lambda: "".join(r.choice(("/", "/x", "/xy", "y")) for _ in range(r.randint(0, 4)))
    rules = list({(h, p): (r.choice(("allow", "block")), h, p) for h, p in ((host(), path()) for _ in range(60))}.values())
    trie = U.RuleTrie(rules)
    for _ in range(3000):
        h, p = host(), path()
        want = brute_fit(rules, h, p)
        assert trie.fit(h, p) == (want and (want[2], want[3]))


def test_many_rules_on_a_host_cost_no_more():
    rules = [("block", "a.com", f"/x/{i}") for i in range(100_000)] + [("allow", "a.com", "/x/77777/y")]
    trie = U.RuleTrie(rules)

    def seconds(of):
        began = time.process_time()
        for i in range(2000):
            assert of.fit("www.a.com", f"/x/{i}z")[1] == "block"
        return time.process_time() - began

    assert seconds(trie) < 20 * max(0.01, seconds(U.RuleTrie(rules[:2000])))  # fifty times the rules
    assert trie.fit("a.com", "/x/77777/yy") == ("a.com/x/77777/y", "allow") and trie.fit("a.com", "/x") is None
    assert trie.fit("a" * 100_000 + ".com", "/" * 100_000) is None


def test_columns_of_other_case_are_replaced(spark):
    df = spark.createDataFrame([(1, "http://a.net/es/", "x", "y", 3)], "page_id long, url string, Host string, VERDICT string, Own_Judged int")
    out = U.judge(df, U.RULES)
    assert out.columns == ["page_id", "url", "Own_Judged", "host", "path", "rule", "verdict"] and out.first().verdict == "block" and out.select("host").first()[0] == "a.net"


def test_verdicts(spark):
    urls = {1: "http://WWW.Example.com/en/1?x", 2: "https://blog.x.example.com/en/#t", 3: "http://q.net/es/a", 4: "http://org/en/", 5: None, 6: "no scheme", 7: "http://com", 8: "x://net?/es/", 9: "http://example.com/EN/"}
    df = table(spark, [(i, u, "") for i, u in urls.items()] + [(1, urls[1], "")])
    rows = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in U.judge(df, U.RULES).collect()}
    assert rows[1] == ("www.example.com", "/en/1", "www.example.com/en/", "allow") and rows[2][2:] == ("example.com/en/", "block")
    assert rows[3][2:] == ("net/es/", "block") and rows[4] == ("org", "/en/", None, "allow") and rows[5] == rows[6] == ("", "", None, "allow")
    assert rows[7] == ("com", "", None, "allow") and rows[8] == ("net", "", None, "allow") and rows[9][2] == "com/"
    assert U.judge(df, U.RULES).count() == 10 and U.judge(df.limit(0), U.RULES).collect() == []
    assert {r.verdict for r in U.judge(df, [], default="block").collect()} == {"block"}
    with pytest.raises(ValueError):
        U.judge(df, U.RULES, max_rules=2)
    assert U.RuleTrie([("block", "a", "/"), ("allow", "a", "/")]).fit("a", "/") == ("a/", "allow")


# --- html --------------------------------------------------------------------------------------------

SHELL = "<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{{}}</style><script>var x='</p>';</script></head><body><header>Site name here</header><nav><ul><li><a href='/'>Home page</a></li></ul></nav><div class=\"ad\">Buy now, buy this</div>{}<aside>Other stories to read</aside><div id='comments'><p>first! I like this very much</p></div><form>Search <input name=q> <button>Go</button></form><footer><p>&copy; nobody at all</p></footer></body></html>"
BODY = "<h1>A  title &amp;\n more</h1><p>One <b>bold</b>\tword<br>and a line.<p>Two &lt;tags&gt;<div class='advert'>cheap things</div><p>Three <!-- not this --> words here, <a href='#'>linked</a> once."
TEXT = "A title & more\n\nOne bold word and a line.\n\nTwo <tags>\n\nThree words here, linked once."


@pytest.fixture(scope="module")
def weights(spark):
    return H.learn(table(spark, [(i, "u", SHELL.format(f"<article>{BODY}</article>")) for i in range(20)]))


def article(html: str) -> str:
    """The article of a test table's page, read in another way: by its marks alone."""
    inner = re.sub("</?b>", "", html[html.index("<article>") + 9 : html.index("</article>")]).replace("<br>", " ")
    blocks = (" ".join(unescape(x).split()) for x in re.split("</?(?:p|h1)>", inner))
    return "\n\n".join(x for x in blocks if x)


def test_weights_tell_content_from_the_rest(weights):
    assert all(v < 0 for v in weights.cuts.values()) and all(v < 0 for v in weights.tags.values())
    assert {"in a ad", "in nav", "in footer", "in aside"} <= set(weights.cuts) and weights.parents["at p"] > 1 and not {"in article", "at article", "in main"} & {*weights.cuts, *weights.parents}


def test_all_pages_of_a_table_give_their_articles(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    want = {r.page_id: article(r.html) for r in pages.collect()}
    learnt = H.learn(pages, training_pages=100)
    assert {r.page_id: r.text for r in H.extract(pages, learnt).collect()} == want
    # neither attributes nor the article element are needed
    bare = pages.withColumn("html", F.regexp_replace("html", ' (class|id|role)="[^"]*"', ""))
    assert {r.page_id: r.text for r in H.extract(bare, H.learn(bare)).collect()} == want
    boxes = pages.withColumn("html", F.regexp_replace("html", "(</?)article>", "$1div>"))
    assert {r.page_id: r.text for r in H.extract(boxes, learnt).collect()} == want


def test_a_heading_after_the_text(weights):
    assert H.Page("<nav>Menu</nav><p>One two.</p><p>Three.</p><footer><h1>Site</h1></footer>").text(weights) == "One two.\n\nThree."


@pytest.mark.parametrize("depth", [1, 60, 5000])
def test_a_menu_goes_however_deep_it_is(weights, depth):
    deep = "<div>" * depth + "{}" + "</div>" * depth
    page = f"<nav>{deep.format('Menu words')}</nav><article><h1>Title</h1><p>One.</p><div><p>Two.</p></div></article><footer>{deep.format('Rights')}</footer>"
    assert H.Page(page).text(weights) == "Title\n\nOne.\n\nTwo."


@pytest.mark.parametrize("box", ["<article>{}</article>", "<div>{}</div>", "<article><section>{}</section></article>"])
@pytest.mark.parametrize("heading", ["<h1>Title</h1>", "<hgroup><h1>Title</h1></hgroup>"])
def test_a_lead_before_the_heading_stays(weights, box, heading):
    inside = box.format(f"<p>A lead.</p>{heading}<p>One.</p>")
    page = f"<body><nav>Menu</nav><div><p>Welcome to the site</p></div>{inside}<footer>Rights</footer></body>"
    assert H.Page(page).text(weights) == "A lead.\n\nTitle\n\nOne."


def test_names_that_nobody_lists_are_learnt(spark):
    box = "<html><body><div class=qq1>menu words</div>{}<h1>Title here</h1><p>Some words.</p>{}<p>More words.</p>{}<div class=zz9><p>below</p></div></body></html>"
    rows = [(i, "u", box.format("<article>", "", "</article><section class='k77x'><p>Odd words</p></section>")) for i in range(30)]
    learnt = H.learn(table(spark, rows))
    page = box.format("<div class=main>", "<section class='k77x'><p>Odd words</p></section>", "</div>")
    assert H.Page(page).text(learnt) == "Title here\n\nSome words.\n\nMore words."
    assert "Odd words" in H.Page(page).text(H.fit([H.examples()]))


def test_shuffled_weights_give_something_else(weights):
    page = SHELL.format(f"<div>{BODY}</div>")
    keys, values = [*weights.cuts, *weights.parents], [*weights.cuts.values(), *weights.parents.values()]
    random.Random(3).shuffle(values)
    mixed = dict(zip(keys, values, strict=True))
    other = H.Weights({k: mixed[k] for k in weights.cuts}, {k: mixed[k] for k in weights.parents}, weights.other, weights.tags)
    assert H.Page(page).text(weights) == TEXT != H.Page(page).text(other)


def test_the_run_of_the_largest_sum_is_the_content():
    weights = H.Weights({"in nav": -3.0, "in aside": -0.5}, {"at p": 1.0}, 1.0, {})
    page = "<p>a b c</p><nav>x x x x x x</nav><p>d e f g h i j k</p><aside>y y</aside><p>l m n</p>"
    assert H.Page(page).text(weights) == "d e f g h i j k\n\nl m n"


@pytest.mark.parametrize("inside", [True, False])
@pytest.mark.parametrize("furniture", ["<div class='comments'><p>first! nice words</p></div>", "<section id='comments'><ol><li><p>Nice</p></li></ol></section>", "<div id=cookie-banner>We use cookies</div>", "<aside>Other</aside>", "<p class=ad>Buy</p>", "<section class='related'><h2>See</h2><p>Other</p></section>", "<form><p>Mail</p><button>Go</button></form>", "<div role='navigation'>Home</div>", "<noscript>Please</noscript>", "<textarea>Type</textarea>", "<div class='notice'>Note</div>"])
def test_furniture_goes_wherever_it_stands(weights, furniture, inside):
    page = f"<body><header>Name</header><article><h1>A title</h1><p>One two.</p>{furniture * inside}<p>Three <a>four</a>.</p></article>{furniture * (not inside)}<footer>Rights</footer></body>"
    assert H.Page(page).text(weights) == "A title\n\nOne two.\n\nThree four."


@pytest.mark.parametrize("content", ["<p>Plain</p>", "<ul><li>Point</li></ul>", "<blockquote><p>Words</p></blockquote>", "<h3>Part</h3>", "<pre>code</pre>", "<table><tr><td>cell</td></tr></table>", "<section><p>Text</p></section>", "<p><a>Linked</a></p>", "<div class='zork'>Text</div>"])
def test_content_of_all_kinds_stays(weights, content):
    for box in ("article", "div"):
        page = f"<body><nav>Menu</nav><{box}><h1>A title</h1><p>One two.</p>{content}<p>Three.</p></{box}><footer>Rights</footer></body>"
        assert H.Page(page).text(weights) == f"A title\n\nOne two.\n\n{re.sub('<[^>]*>', '', content)}\n\nThree."


def test_extraction(spark, weights):
    pages = {1: SHELL.format(f"<article>{BODY}</article>"), 2: SHELL.format(f"<div>{BODY}</div>"), 3: None, 4: "", 5: "<p>", 6: "plain words only", 7: f"<article>{BODY}", 8: f"</p></b>< p>{BODY}</main></i>"}
    rows = {r.page_id: r.text for r in H.extract(table(spark, [(i, "u", h) for i, h in pages.items()] + [(1, "u", pages[1])]), weights).collect()}
    assert rows[1] == rows[2] == rows[7] == TEXT and rows[8] == TEXT
    assert rows[3] == rows[4] == rows[5] == "" and rows[6] == "plain words only"
    twice = spark.createDataFrame([(1, "u", pages[1], "f", True, "t")] * 2, "page_id long, url string, html string, features string, inside boolean, text string")
    assert [r.text for r in H.extract(twice, H.learn(twice)).collect()] == [TEXT] * 2
    nothing = table(spark, [(1, "u", pages[1])]).limit(0)
    assert H.extract(nothing, weights).collect() == [] and H.learn(nothing) == H.learn(table(spark, [(1, "u", "<p>x")])) == H.fit([H.examples()])


@pytest.mark.parametrize("page", ["<p " * 400_000, '<a "' * 300_000, '<a x="' * 200_000 + ">", "<b>x" * 100_000, "<!--" * 300_000, "<" * 1_000_000, "</p>" * 200_000, '<p class="' * 100_000 + ">", "<a x='\">" * 100_000])
def test_malformed_pages_are_linear(weights, page):
    def seconds(source):
        began = time.process_time()
        H.Page(source).text(weights)
        return time.process_time() - began

    seconds(page[: len(page) // 8])
    assert seconds(page) < 24 * max(0.05, seconds(page[: len(page) // 8]))  # eight times as long: quadratic work would take 64 times


def test_tags_end_where_they_end():
    assert list(H.tags("a<p x='>'>b<br/>c<!-- <p> -->d<!x>e<3<q")) == [("a", "p", " x='>'"), ("b", "br", "/"), ("c", "!", ""), ("d", "!", ""), ("e<3<q", "", "")]
    assert list(H.tags("<SCRIPT>a<b></script >c")) == [("", "script", ""), ("", "/script", " "), ("c", "", "")]
    assert list(H.tags("<a x='>b<i>c")) == [("", "a", " x='"), ("b", "i", ""), ("c", "", "")]


def test_long_pages_are_linear(weights):
    long = SHELL.format("<article><h1>Start</h1>" + "<p>word one two three" * 20_000 + "</article>")
    assert H.Page(long).text(weights).count("\n\n") == 20_000


# --- warc --------------------------------------------------------------------------------------------


def archive(*pages):
    out = []
    for i, url, payload, refers in pages:
        out.append(warc.record_bytes(i, url, payload, hashlib.sha256(payload).hexdigest(), len(payload), refers))
    return b"".join(out)


@pytest.mark.parametrize("chunk", [1, 7, 1000, 1 << 20])
def test_reader_is_sequential_and_exact(chunk):
    pages = [(1, "http://a/é ?x=%41", b"", None), (2, None, os.urandom(5000), None), (3, "u", b"\r\n\r\nWARC/1.1\r\n" * 90, None), (4, "u", b"z" * 300_000, 3)]
    found = list(warc.ArchiveReader(io.BytesIO(archive(*pages)), chunk))
    assert [p for _, _, p in found] == [pages[0][2], pages[1][2], pages[2][2], b""]
    assert [h["warc-type"] for h, _, _ in found] == ["response"] * 3 + ["revisit"] and found[3][1]["content-length"] == "300000"
    assert gzip.decompress(archive(*pages)).count(b"WARC/1.1\r\nWARC-Type") == 4


def test_damage_raises():
    good = archive((1, "u", b"x" * 500, None), (2, "u", b"y" * 500, None))
    plain = gzip.decompress(archive((1, "u", b"x" * 500, None)))
    broken = [good[:-5], good[:40], b"junk", gzip.compress(plain.replace(b"xxx", b"xyx", 1)), gzip.compress(plain[:-4]), gzip.compress(plain + b"more"), gzip.compress(b"no header")]
    for data in broken:
        with pytest.raises(ValueError):
            list(warc.ArchiveReader(io.BytesIO(data)))
    assert list(warc.ArchiveReader(io.BytesIO(b""))) == []


@pytest.mark.parametrize("url", ["http://x.org/a%2Fb?q=%20c", "http://x.org/%252F%zz", "http://ü.org/é?x=ß#漢", "http://x.org/[a]|{b}^`\"<>", "http://x.org/\u00a0", ""])
def test_urls_are_kept_as_they_are(url):
    (headers, _, _), *more = warc.ArchiveReader(io.BytesIO(archive((1, url, b"p", None))))
    assert headers["warc-target-uri"] == url and not more
    (headers, _, _), *_ = warc.ArchiveReader(io.BytesIO(record("response", b"x", [f"WARC-Target-URI: {url}"])))
    assert headers["warc-target-uri"] == url
    (headers, _, _), *_ = warc.ArchiveReader(io.BytesIO(archive((1, f"{url}\r\nX: y z\x7f", b"p", None))))
    assert headers["warc-target-uri"] == f"{url}%0D%0AX:%20y%20z%7F" and "x" not in headers


def test_folded_lines_go_on():
    (headers, http, _), *_ = warc.ArchiveReader(io.BytesIO(record("response", b"HTTP/1.1 200 OK\r\nX-Long: a\r\n\tb\r\n\r\n", ["WARC-Filename: one", "  two", "\tthree", "WARC-Other: x"])))
    assert (headers["warc-filename"], headers["warc-other"], http["x-long"]) == ("one two three", "x", "a b")


def test_headers_without_an_end_are_refused_early():
    endless = gzip.compress(b"WARC/1.1\r\n" + b"x" * 60_000_000)
    reader = warc.ArchiveReader(io.BytesIO(endless))
    with pytest.raises(ValueError, match="end of its header"):
        list(reader)
    assert len(reader.plain) <= warc.HEADER_BYTES + 2 * warc.READ_BYTES
    (headers, _, _), *_ = warc.ArchiveReader(io.BytesIO(record("response", b"x", [f"X-Long: {'y' * 900_000}"])), 1000)
    assert len(headers["x-long"]) == 900_000


def record(kind, block, more=(), content="application/http; msgtype=response"):
    lines = ["WARC/1.0", f"WARC-Type: {kind}", "WARC-Record-ID: <urn:uuid:1-2>", f"Content-Type: {content}", f"Content-Length: {len(block)}", *more]
    return gzip.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n")


def test_archives_of_others(spark, tmp_path):
    body = b"<p>hello</p>"
    sha1 = base64.b32encode(hashlib.sha1(body).digest()).decode()
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n"
    chunked = http + b"Transfer-Encoding: chunked\r\n\r\n5\r\n<p>he\r\n7;x=y\r\nllo</p>\r\n0\r\n\r\n"
    records = [
        record("warcinfo", b"software: x\r\n", content="application/warc-fields"),
        record("request", b"GET / HTTP/1.1\r\nHost: a\r\n\r\n", content="application/http; msgtype=request"),
        record("response", http + b"\r\n" + body, [f"WARC-Payload-Digest: sha1:{sha1}"]),
        record("response", http + b"Content-Length: 99\r\n\r\n" + body, [f"WARC-Payload-Digest: md5:{hashlib.md5(body).hexdigest()}", "WARC-Block-Digest: crc9:zzz"]),
        record("response", chunked, [f"warc-payload-digest: SHA-256:{hashlib.sha256(body).hexdigest()}"]),
        record("resource", body, content="text/html"),
        record("revisit", http + b"\r\n", [f"WARC-Payload-Digest: sha1:{sha1}", "WARC-Refers-To: <urn:uuid:1-2>"]),
    ]
    found = list(warc.ArchiveReader(io.BytesIO(b"".join(records))))
    assert [h["warc-type"] for h, _, _ in found] == ["warcinfo", "request", "response", "response", "response", "resource", "revisit"]
    assert [p for _, _, p in found] == [b"software: x\r\n", b"", body, body, body, body, b""] and found[0][1] == {}
    for bad in (record("response", http + b"\r\n" + body, [f"WARC-Payload-Digest: sha1:{base64.b32encode(b'0' * 20).decode()}"]), record("resource", body, ["WARC-Block-Digest: md5:" + "0" * 32], "text/html"), gzip.compress(b"WARC/1.0\r\nWARC-Type: response\r\n\r\n")):
        with pytest.raises(ValueError):
            list(warc.ArchiveReader(io.BytesIO(bad)))
    (tmp_path / "a.warc.gz").write_bytes(b"".join(records))
    rows = warc.read_archives(spark.createDataFrame([(str(tmp_path / "a.warc.gz"),)], "path string"), str(tmp_path)).collect()
    assert [(r.record_type, r.page_id, r.payload_bytes) for r in rows][2:] == [("response", None, 12)] * 3 + [("resource", None, 12), ("revisit", None, None)]
    assert rows[6].payload_digest == hashlib.sha1(body).hexdigest() and rows[6].refers_to_record == "<urn:uuid:1-2>"


def test_round_trip(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 2000)
    copy = "the same page " * 20
    rows = [(9, "http://h/1", copy), (4, "http://h/2", copy), (7, None, copy), (1, "http://h/3", "tiny"), (2, "http://h/4", "tiny"), (3, "http://h/5", None), (5, "http://h/6", ""), (6, "http://h/ü x", "é" * 70), (4, "http://h/2", copy), (8, "u", "z" * 500_000)]
    folder = str(tmp_path / uuid.uuid4().hex)
    archives = warc.write_archives(warc.with_revisits(table(spark, rows)), folder)
    assert archives.count() > 1 and archives.agg(F.sum("records")).first()[0] == len(rows)
    assert sorted(os.path.basename(r.path) for r in archives.collect()) == sorted(os.listdir(folder))
    whole = {(r.page_id, r.payload) for r in warc.with_payloads(warc.read_archives(archives, folder)).collect()}
    assert whole == {(i, (h or "").encode()) for i, _, h in rows}
    found = warc.read_archives(archives, folder).collect()
    assert len(found) == len(rows)
    for r in found:
        payload = (next(h for i, _, h in rows if i == r.page_id) or "").encode()
        assert (r.payload_bytes, r.payload_digest) == (len(payload), hashlib.sha256(payload).hexdigest())
        url = next(u for i, u, _ in rows if i == r.page_id)
        assert r.url == (url and url.replace(" ", "%20"))  # what a header can't hold stays escaped
        assert (r.record_type, r.refers_to) == (("revisit", 4) if r.page_id in (7, 9) else ("response", None))
        assert r.payload == (b"" if r.record_type == "revisit" else payload)
    unnamed = warc.write_archives(warc.with_revisits(table(spark, [(None, "u", copy), (4, "v", copy), (None, None, None)])), folder + "n")
    found = warc.read_archives(unnamed, folder + "n", payloads=False).collect()
    assert sorted((r.page_id or 0, r.record_type, r.refers_to, r.payload_bytes) for r in found) == [(0, "response", None, 0), (0, "response", None, len(copy)), (4, "response", None, len(copy))]
    nothing = warc.write_archives(warc.with_revisits(table(spark, rows).limit(0)), folder + "x")
    assert warc.read_archives(nothing, folder + "x").collect() == []
