"""Archives by exact round trip, page texts by plain rules and hand-made pages."""

import gzip
import hashlib
import html
import random
import re
import zlib

import pytest
from llm_cases import rows_of

from tagloom.llm import html_text, warc
from tagloom.llm.shared import open_store, work_folder

PAGES = "page_id long, url string, html string, digest string, payload string, score double"


def odd_pages(spark):
    rng = random.Random(2)
    long = "<p>" + " ".join(rng.choice(["un", "deux", "été", "&amp;"]) for _ in range(3000)) + "</p>"
    texts = [None, "", "short", "short", long, long, "x" * 999, "x" * 999, "x" * 1000, "x" * 1000, "é" * 500, "é" * 500, "日" * 40_000, long + "!", long]
    rows = [(i, None if i % 5 == 0 else f"http://example.com/ü {i}\r\nX: y", t, "d", "p", 0.0) for i, t in enumerate(texts)]
    rows += [(None, "u", long, None, None, None), rows[4]]
    return spark.createDataFrame(rows, PAGES).repartition(4)


def plain_records(rows):
    keeper = {}
    for i, t in rows:
        if i is not None:
            keeper[t or ""] = max(keeper.get(t or "", i), i)
    out = []
    for i, t in rows:
        data = (t or "").encode()
        other = len(data) >= 1000 and i is not None and i < keeper[t or ""]
        out.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if other else "response", keeper[t or ""] if other else None))
    return sorted(out, key=str)


def test_round_trip(spark):
    pages = odd_pages(spark)
    assert rows_of(warc.archive_round_trip(pages)) == plain_records([(r.page_id, r.html) for r in pages.collect()])


@pytest.mark.parametrize("split", [300, 5000, 8 << 20])
def test_ranges_give_each_record_once(spark, split):
    pages = odd_pages(spark)
    files = warc.write_archives(warc.mark_revisits(pages), work_folder(spark, "warc"))
    got = warc.read_archives(spark, files, split).drop("url")
    assert rows_of(got) == plain_records([(r.page_id, r.html) for r in pages.collect()])


def test_no_pages(spark):
    assert warc.archive_round_trip(spark.createDataFrame([], PAGES)).count() == 0


def test_archive_is_plain_gzip(spark):
    pages = odd_pages(spark).where("page_id < 9")
    (path, size), *_ = warc.write_archives(warc.mark_revisits(pages).coalesce(1), work_folder(spark, "warc"))
    store, inner = open_store(path)
    with store.open_input_file(inner) as source:
        data = source.read()
    assert len(data) == size
    text = gzip.decompress(data)
    assert text.count(b"WARC/1.1\r\n") == pages.count() and b"\r\nX: y" not in text
    assert text.count(b"WARC-Type: revisit") == sum(r[3] == "revisit" for r in plain_records([(r.page_id, r.html) for r in pages.collect()]))


class Memory:
    def __init__(self, data):
        self.data, self.at = data, 0

    def seek(self, at):
        self.at = at

    def read(self, n):
        out = self.data[self.at : self.at + n]
        self.at += n
        return out


def test_false_magic_is_passed_over():
    fake = b"\x1f\x8b\x08" + bytes(20)
    other = gzip.compress(b"not an archive")
    good = [warc.record_bytes(i, "u", bytes([i]) * (40 * i), hashlib.sha1(bytes([i]) * (40 * i)).hexdigest(), None) for i in range(1, 30)]
    stored = zlib.compressobj(0, zlib.DEFLATED, 31)
    data = fake + good[0] + other + b"".join(good[1:9]) + fake + stored.compress(b"\x1f\x8b\x08" * 50) + stored.flush() + b"".join(good[9:])
    for step in (7, 100, 10**6):
        ids = [warc.parse_record(r)[0] for start in range(0, len(data), step) for r in warc.MemberScan(Memory(data), len(data), start, min(len(data), start + step))]
        assert ids == list(range(1, 30))


def test_broken_record_is_an_error():
    record = gzip.decompress(warc.record_bytes(1, "u", b"payload", hashlib.sha1(b"payload").hexdigest(), None))
    with pytest.raises(ValueError):
        warc.parse_record(record.replace(b"payload", b"payroll"))
    with pytest.raises(ValueError):
        warc.parse_record(record.replace(b"payload", b"pay"))


@pytest.fixture(scope="module")
def forest(spark):
    return html_text.train(spark.read.parquet("/root/testdata/sf0.001/pages.parquet"))


def plain_text(source):
    inner = re.search(r"<article>(.*?)</article>", source, re.S)[1]
    parts = re.split(r"</?(?:p|h1)>", re.sub("<br>", " ", re.sub("</?b>", "", inner)))
    return "\n".join(x for x in (" ".join(html.unescape(p).split()) for p in parts) if x)


def test_table_pages(spark, forest):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r for r in html_text.main_texts(pages, forest).collect()}
    rows = pages.collect()
    assert len(got) == len(rows)
    for r in rows:
        assert got[r.page_id].text == plain_text(r.html) and got[r.page_id].n_chars == len(got[r.page_id].text) and got[r.page_id].url == r.url


def words(rng, n):
    return " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "epsilon", "zeta"]) for _ in range(n)).capitalize() + "."


def test_other_layouts(forest):
    """Pages laid out like none of the table: side column, notice, form, comments, menus."""
    right = total = 0
    for seed in range(40):
        rng = random.Random(seed)
        paragraphs = [words(rng, rng.randint(15, 60)) for _ in range(rng.randint(3, 8))]
        page = (
            f"<html><body><header class='masthead'><a href=/>Site name</a></header><nav class=menu><ul><li><a href=a>One</a><li><a href=b>Two</a></ul></nav>"
            f"<div class='cookie-notice'><p>{words(rng, 12)}</p><button>Agree</button></div>"
            f"<div id=wrap><{'article' if seed % 2 else 'div class=entry-content'}><h1>Title here</h1>"
            + "".join(f"<p>{p}" for p in paragraphs)
            + f"</{'article' if seed % 2 else 'div'}><aside class=sidebar><h3>Related</h3><ul><li><a href=1>{words(rng, 4)}</a></li><li><a href=2>{words(rng, 5)}</a></li></ul></aside></div>"
            f"<section class=comments><h2>Comments</h2><div class=comment><p>{words(rng, 14)}</p></div></section>"
            f"<form class=search><label>Search</label><input></form><footer>&copy; someone</footer></body></html>"
        )
        total += 1
        right += html_text.extract([page], forest)[0] == "\n".join(["Title here", *paragraphs])
    assert right >= 0.9 * total


def test_page_edges(spark, forest):
    pages = spark.createDataFrame(
        [(1, None, None), (2, "u", ""), (3, "u", "<p"), (4, "u", "<script>var a = '<p>x</p>'"), (None, "u", "<!-- open"), (5, "u", "<div>" * 3000 + "x")],
        "page_id long, url string, html string",
    )
    got = html_text.main_texts(pages, forest).collect()
    assert len(got) == 6 and all(r.text is not None and r.n_chars == len(r.text) for r in got)
    assert {r.text for r in got if r.page_id != 5} == {""}
    assert html_text.main_texts(pages.limit(0), None).count() == 0
    assert html_text.train(pages.where("page_id < 3")) is None


def test_decoding_is_consistent(forest):
    rng = random.Random(3)
    for _ in range(50):
        source = "".join(rng.choice(["<div>", "</div>", "<p>", "<article>", "</article>", "<ul><li>", "text of it, ", "<a href=x>link</a>", "</ul>"]) for _ in range(60))
        nodes, pieces = html_text.parse(source)
        taken = html_text.decode(nodes, forest.margin(html_text.measure(nodes, pieces)))
        assert all(taken[i] or not taken[n.parent] for i, n in enumerate(nodes) if n.parent >= 0)


def test_parser_closes_tags():
    nodes, pieces = html_text.parse("<ul><li>a<li>b</ul><p>c<div>d</div>e<b>f<p>g</b>h<br>i")
    assert [b for _, b in html_text._blocks(nodes, pieces, None)] == ["a", "b", "c", "d", "ef", "gh i"]
    assert [n.tag for n in nodes].count("li") == 2 and nodes[2].parent == nodes[3].parent == 1
