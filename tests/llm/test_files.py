"""WARC bundles, main text and segmentation."""

import base64
import hashlib
import html as entities
import io
import random
import re
import time
from collections import Counter
from urllib.parse import unquote, urlparse

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseloom.llm import arrow, segment, warc, wrapper
from caseloom.operators.scaling import Staging

PAGES = "page_id bigint, url string, html string"
SF = "/root/testdata/sf0.01"


# ---------------------------------------------------------------------------
# WARC
# ---------------------------------------------------------------------------
ARCHIVED = [
    (7, "http://a/7", "<p>same</p>"),
    (3, "http://a/3", "<p>same</p>"),
    (9, "http://a/9 \r\nX: y", "ünï\r\n\r\nWARC/1.1\r\n"),
    (4, None, None),
    (5, "http://a/5", ""),
    (1, "http://a/1", "x" * 3_000_000),
    (2, "http://a/2", "x" * 3_000_000),
    (None, "http://a/n", "<p>same</p>"),
    (None, "http://a/n", "only without id"),
    (6, "http://a/6", "twice"),
    (6, "http://a/6", "twice"),
]


def plain_archive(rows, least=0):
    first = {}
    for page, _, text in rows:
        if page is not None:
            first[text or ""] = min(page, first.get(text or "", page))
    out = []
    for page, _, text in rows:
        data = (text or "").encode()
        f = first.get(text or "") if len(data) >= least else None
        revisit = f is not None and f != page
        sha = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((page, len(data), sha, "revisit" if revisit else "response", f if revisit else None))
    return Counter(out)


@pytest.mark.parametrize("least", [0, 8])
def test_archives_hold_what_was_put_in(spark, tmp_path, least):
    staging = Staging(spark, f"file://{tmp_path}")
    pages = spark.createDataFrame([(*r, 1) for r in ARCHIVED], PAGES + ", refers_to int")
    bundling = warc.Bundling(frame_bytes=4000, bundle_bytes=8000)
    index = staging.table(warc.write_bundles(pages, staging.path("bundles"), least, bundling), "index")
    got = warc.read_bundles(index).collect()
    fields = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert Counter(tuple(r[f] for f in fields) for r in got) == plain_archive(ARCHIVED, least)
    assert all(r["intact"] for r in got)
    stored = {r["page_id"]: r["payload"] for r in got if r["record_type"] == "response"}
    assert bytes(stored[9]) == ARCHIVED[2][2].encode() and len(stored[1]) == 3_000_000


def test_a_bundle_is_plain_zstandard_and_can_be_sought(spark, tmp_path):
    staging = Staging(spark, f"file://{tmp_path}")
    pages = spark.createDataFrame([(i, f"http://h/{i}", f"<p>{i}</p>" * 40) for i in range(200)], PAGES).coalesce(1)
    index = staging.table(
        warc.write_bundles(pages, staging.path("bundles"), bundling=warc.Bundling(frame_bytes=9000)), "index"
    ).collect()
    for name in {r["bundle"] for r in index}:
        system, path = warc._open(name)
        with system.open_input_file(path) as file:
            table = warc.seek_table(file)
            frames = b"".join(warc.read_frame(file, e) for e in table)
            file.seek(0)
            packed = file.read()
        plain = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(packed), read_across_frames=True).read()
        assert plain == frames and plain.startswith(b"WARC/1.1\r\n")
        at, seen = 0, 0
        while at < len(plain):
            _, _, at = warc.parse(plain, at)
            seen += 1
        own = [r for r in index if r["bundle"] == name]
        assert seen == len(own) and {r["frame"] for r in own} == set(range(len(table)))
        assert all(table[r["frame"]][0] == r["frame_offset"] for r in own)


def test_no_pages_make_no_records(spark, tmp_path):
    staging = Staging(spark, f"file://{tmp_path}")
    index = staging.table(warc.write_bundles(spark.createDataFrame([], PAGES), staging.path("b")), "index")
    assert warc.read_bundles(index).count() == 0


def test_archive_of_the_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url", "html").collect()]
    got = warc.op5_warc_bundles(spark, SF).collect()
    assert Counter(tuple(r)[:5] for r in got) == plain_archive(rows) and all(r["intact"] for r in got)


# ---------------------------------------------------------------------------
# Main text
# ---------------------------------------------------------------------------
def test_main_text_of_the_table(spark):
    got = {r["page_id"]: r["text"] for r in wrapper.op6_wrapper(spark, SF).collect()}
    for page, text in spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "html").collect():
        article = re.search(r"<article>(.*?)</article>", text, re.S).group(1)
        blocks = re.split(r"</?(?:p|h1)[^>]*>", article)
        plain = [" ".join(entities.unescape(re.sub(r"<[^>]*>", "", b.replace("<br>", " "))).split()) for b in blocks]
        assert got[page] == "\n".join(b for b in plain if b)


def page(title, *paragraphs, before="", after=""):
    body = "".join(f"<p>{p}</p>" for p in paragraphs)
    return (
        f"<html><head><title>{title}</title></head><body><header>Site</header><nav><a>Home</a></nav>{before}"
        f"<article><h1>{title}</h1>{body}<div class='comments'><p>First!</p></div></article>{after}"
        "<aside>More</aside><form><input>Search <button>Go</button></form><footer>&copy; us</footer></body></html>"
    )


def test_named_parts_template_and_markup_go(spark):
    rows = [
        (i, f"https://h.example/{i}", page(f"Title {i}", f"Text &amp; <b>bold {i}</b>&nbsp;here", "Shared line of the site"))
        for i in range(30)
    ]
    bare = "<div><h2>Head {0}</h2><div>Body {0}.</div><div>Always the same here</div></div>"
    rows += [(100 + i, f"http://bare.example/{i}", bare.format(i)) for i in range(20)]
    rows += [
        (200, None, None),
        (201, "not a url", ""),
        (202, "http://x.example", "<p>One<p>Two<br>lines<script>var a = '<p>no</p>';"),
        (203, "http://x.example", "<div class='cookie-notice'>We</div><ul><li>a<li>b</ul>tail <!-- no -->end < 3 &lt;p&gt;"),
        (204, "http://y.example", "<div>" * 2000 + "deep"),
        (205, "http://y.example", "<p>" + "word " * 100_000),
        (1, "https://h.example/1", rows[1][2]),
    ]
    got = {}
    for r in wrapper.main_text(spark.createDataFrame(rows, PAGES), Staging(spark)).collect():
        assert r["n_chars"] == len(r["text"])
        assert got.setdefault(r["page_id"], r["text"]) == r["text"]
    assert all(got[i] == f"Title {i}\nText & bold {i} here" for i in range(30))
    assert all(got[100 + i] == f"Head {i}\nBody {i}." for i in range(20))
    assert (got[200], got[201]) == ("", "")
    assert got[202] == "One\nTwo lines" and got[203] == "a\nb\ntail end < 3 <p>" and got[204] == "deep"
    assert len(got[205]) == 499_999
    assert wrapper.main_text(spark.createDataFrame([], PAGES), Staging(spark)).count() == 0


def test_hosts_are_read_from_urls(spark):
    urls = ["http://A.example/x", "https://u@b.example:8080/?q", "ftp://c#f", "/path", "", None]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    assert [r[0] for r in df.select(wrapper.host_of(df["url"])).collect()] == ["a.example", "b.example", "c", "", "", ""]
    assert urlparse(urls[1]).hostname == "b.example" and unquote("") == ""


def best_alignment(a, b):
    """Simple tree matching by the textbook recurrence."""
    if a.label != b.label:
        return 0.0
    if a.tag == "#text":
        return 1.5 if a.text == b.text else 1.0
    x, y = a.children, b.children
    m = [[0.0] * (len(y) + 1) for _ in range(len(x) + 1)]
    for i in range(len(x)):
        for j in range(len(y)):
            m[i + 1][j + 1] = max(m[i][j + 1], m[i + 1][j], m[i][j] + best_alignment(x[i], y[j]))
    return 1.0 + m[-1][-1]


def test_alignment_has_the_weight_of_the_recurrence():
    rng = np.random.default_rng(6)

    def grow(depth):
        if depth == 0 or rng.random() < 0.3:
            return f"<p>{rng.integers(0, 3)}</p>"
        tag = rng.choice(["div", "section", "ul"])
        return f"<{tag}>" + "".join(grow(depth - 1) for _ in range(rng.integers(0, 4))) + f"</{tag}>"

    for _ in range(150):
        a, b = wrapper.parse(grow(3)), wrapper.parse(grow(3))
        found = {}
        assert wrapper.align(a, b, found) == pytest.approx(best_alignment(a, b))
        assert len(set(map(id, found.values()))) == len(found)


def extracted(spark, rows, **induction):
    df = spark.createDataFrame(rows, PAGES)
    got = wrapper.main_text(df, Staging(spark), wrapper.Induction(**induction)).collect()
    return {r["page_id"]: r["text"] for r in got}


def site(n, furniture=lambda i: "", start=0, host="w.example", notice=lambda i: ""):
    """Pages without a telling tag or class: a menu, a varying body, a foot."""
    return [
        (
            start + i,
            f"http://{host}/{i}",
            f"<div class='a'><ul><li>Home</li><li>News</li></ul></div>{notice(i)}<div class='b'>{furniture(i)}<h2>Head {i}</h2>"
            f"<p>Body {i} is here.</p></div><div class='c'><p>All about us</p></div>",
        )
        for i in range(n)
    ]


def test_induction_alone_finds_what_varies(spark):
    want = {i: f"Head {i}\nBody {i} is here." for i in range(12)}
    assert extracted(spark, site(12), names=False) == want
    # eight pages are enough, and two layouts of a host do not disturb each other
    other = [
        (100 + i, f"http://w.example/o{i}", f"<section><table><tr><td>Old menu</td></tr></table><form></form><p>Text {i}.</p><p>Old foot</p></section>")
        for i in range(9)
    ]
    got = extracted(spark, site(8) + other, names=False)
    assert got == {i: want[i] for i in range(8)} | {100 + i: f"Text {i}." for i in range(9)}


def test_copies_and_a_reference_without_the_notice(spark):
    rows = site(30)
    # four more copies of the reference, and a great many of one other page
    copies = [(200 + k, "http://w.example/c", rows[0][2]) for k in range(4)]
    copies += [(300 + k, "http://w.example/d", rows[7][2]) for k in range(300)]
    got = extracted(spark, rows + copies, names=False)
    assert all(got[i] == f"Head {i}\nBody {i} is here." for i in range(30))
    assert all(got[300 + k] == got[7] for k in range(300)) and got[200] == got[0]
    # a notice on every page but the reference
    noted = site(20, notice=lambda i: "<p>Closed on Monday</p>" if i else "")
    got = extracted(spark, noted, names=False)
    assert all(got[i] == f"Head {i}\nBody {i} is here." for i in range(20))


def test_names_give_way_to_what_varies(spark):
    for around in ("layout has-sidebar", "post form-letter", "share"):
        rows = [
            (i, "http://n.example/", f"<div class='{around}'><h2>Head {i}</h2><p>Body {i} is a long text.</p></div><div class='sidebar'>More {i}</div>")
            for i in range(10)
        ]
        assert extracted(spark, rows) == {i: f"Head {i}\nBody {i} is a long text." for i in range(10)}


def test_alignment_is_the_same_however_many_siblings(monkeypatch):
    """All pairs tried, or by shapes as with very many: one weight and one set of pairs."""

    def page(rng):
        def word():
            return rng.choice(["a", "b", "more", f"u{rng.randrange(30)}", f"z{rng.random()}"])

        shapes = (word, lambda: f"<h3>{word()}</h3><p>{word()}</p>", lambda: f"<ul><li>{word()}<li>{word()}</ul>", str)
        tags = [rng.choice(("li", "div", "section")) for _ in range(rng.randrange(1, 40))]
        return wrapper.parse("<div>" + "".join(f"<{t}>{rng.choice(shapes)()}</{t}>" for t in tags) + "</div>")

    for seed in range(30):
        rng = random.Random(seed)
        a, b = page(rng), page(rng)
        got = []
        for most in (10**9, 0):
            monkeypatch.setattr(wrapper, "_MOST_PAIRS", most)
            found = {}
            got.append((wrapper.align(a, b, found), found))
        assert got[0] == got[1], seed


def test_quotes_depth_and_siblings_of_any_number(spark):
    deep = "<div>" * 3000 + "<p>deep {0}</p><p>same</p>" + "</div>" * 3000
    many = "<ul>" + "".join(f"<li>item {k} {{0}}</li>" for k in range(5000)) + "</ul>"
    rows = [(i, "http://deep.example/", deep.format(i)) for i in range(9)]
    rows += [(100 + i, "http://many.example/", many.format(i)) for i in range(3)]
    rows += [(200, "http://q.example/", "<p title=it's>one</p><div class=\"x\"\">two</div>" + "<a '" * 20_000)]
    start = time.time()
    got = extracted(spark, rows)
    assert time.time() - start < 30
    assert all(got[i] == f"deep {i}" for i in range(9))
    assert got[100].count("\n") == 4999 and got[200] == "one\ntwo"


# ---------------------------------------------------------------------------
# Segmentation
# ---------------------------------------------------------------------------
@pytest.fixture(scope="module")
def vocabulary():
    return segment.Vocabulary.load(segment.MODEL_PATH)


def all_paths(vocabulary, text):
    """Every segmentation of a short text with its log-probability."""
    marked = "▁" + text.replace(" ", "▁")
    score = {}
    for i, piece in enumerate(vocabulary.pieces):
        node = 0
        for c in piece:
            key = node * vocabulary.width + int(vocabulary.chars[ord(c)])
            node = int(vocabulary.steps(np.array([key]))[0])
            if vocabulary.chars[ord(c)] < 0 or node < 0:
                break
        else:
            if vocabulary.piece_at[node] == i:
                score[piece] = (i, float(vocabulary.log_at[node]))

    def grow(at):
        if at == len(marked):
            return [((), 0.0)]
        out = []
        for end in range(at + 1, len(marked) + 1):
            if marked[at:end] in score:
                i, s = score[marked[at:end]]
                out += [((i, *rest), s + t) for rest, t in grow(end)]
        if marked[at] not in score:
            raw = marked[at].encode()
            own = tuple(int(vocabulary.byte_ids[b]) for b in raw)
            out += [((*own, *rest), len(raw) * vocabulary.byte_log + t) for rest, t in grow(at + 1)]
        return out

    found = dict(grow(0))
    total = np.logaddexp.reduce(list(found.values()))
    return {k: v - total for k, v in found.items()}


@pytest.mark.parametrize("text", ["ab", "the cat", "a\nb", "  x ", "é☃"])
def test_probabilities_are_those_of_the_lattice(vocabulary, text):
    want = all_paths(vocabulary, text)
    k = min(len(want) + 5, 300)
    got = segment.sample(vocabulary, [text], np.array([3]), k)[0]
    assert len({tuple(s[0].tolist()) for s in got}) == len(got) == min(len(want), k)
    for ids, log_p, _, inclusion in got:
        assert log_p == pytest.approx(want[tuple(ids.tolist())], abs=1e-7)
        assert inclusion <= 0 and (len(want) > k or inclusion == 0)
    values = [s[2] for s in got]
    assert values == sorted(values, reverse=True)


def test_samples_are_drawn_without_replacement(vocabulary):
    text, n = "ten", 5000
    p = {k: np.exp(v) for k, v in all_paths(vocabulary, text).items()}
    got = segment.sample(vocabulary, [text] * n, np.arange(n), 2)
    first = Counter(tuple(r[0][0].tolist()) for r in got)
    both = Counter((tuple(r[0][0].tolist()), tuple(r[1][0].tolist())) for r in got)
    for path, share in p.items():
        assert first[path] / n == pytest.approx(share, abs=4 * np.sqrt(share / n) + 1e-3)
        for other, then in p.items():
            if other != path:
                want = share * then / (1 - share)
                assert both[path, other] / n == pytest.approx(want, abs=4 * np.sqrt(want / n) + 1e-3)
    inside = np.mean([np.exp(s[3]) > 0 for r in got for s in r])
    weights = np.mean([sum(np.exp(s[1] - s[3]) for s in r) for r in got])
    assert inside == 1 and weights == pytest.approx(1, abs=0.05)


def test_segments_come_back_as_text_wherever_they_are_made(spark):
    texts = [None, "", " ", "a", "  two  spaces ", "tab\tand\nlines\r\n", "日本 ☃ é \U0001f600", "\x00", "x" * 3000, "lorem ipsum " * 9000, "▁"]
    rows = [(i, t, 0) for i, t in enumerate(texts)] + [(5, texts[5], 0), (None, "the cat", 0), (None, "the cat", 0)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, samples int")
    once = segment.segmentations(df.coalesce(1), k=3).collect()
    again = segment.segmentations(df.repartition(7), k=3).collect()
    key = lambda r: (r["doc_id"] is None, r["doc_id"], r["text"])
    assert len(once) == len(rows)
    assert [tuple(r) for r in sorted(once, key=key)] == [tuple(r) for r in sorted(again, key=key)]
    for r in once:
        assert r["round_trip"] == (r["text"] != "▁")
        assert len({tuple(s["ids"]) for s in r["samples"]}) == len(r["samples"])
        assert (len(r["samples"]) == 0) == (not r["text"])
    assert segment.segmentations(df.limit(0)).count() == 0


def test_lattices_asked_for_again_are_kept_when_others_are_forgotten(vocabulary, monkeypatch):
    built = []

    class Counted(segment.Lattice):
        def __init__(self, vocabulary, units):
            built.extend(units)
            super().__init__(vocabulary, units)

    texts = [f"often seen  words\n{'x' * n} new{n}é {chr(0x4E00 + n)} end" for n in range(1, 40)]
    monkeypatch.setattr(segment, "Lattice", Counted)
    store = segment.Store(vocabulary, 300)
    got = [segment.sample(vocabulary, [t], np.array([i]), 3, store) for i, t in enumerate(texts)]
    assert len(store.final) <= 300 + len(texts[-1]) * 2
    assert built.count(segment._MARK + "often") == 1
    monkeypatch.undo()
    for i, (t, rows) in enumerate(zip(texts, got, strict=True)):
        for a, b in zip(rows[0], segment.sample(vocabulary, [t], np.array([i]), 3)[0], strict=True):
            assert a[0].tolist() == b[0].tolist() and a[1:] == b[1:]


@pytest.mark.parametrize("k", [1, 2, 5])
def test_regions_opened_together_are_those_opened_alone(vocabulary, monkeypatch, k):
    words = ["the", "thereof", "ñandú", "x", "  ", "abc\nabc", "中文"]
    texts = [" ".join(words[(i * j) % 7] for j in range(n)) for i, n in enumerate([1, 3, 40, 700, 2, 300])]
    seeds = np.arange(len(texts))
    together = segment.sample(vocabulary, texts, seeds, k)

    def alone(turns, lattice, wanted):
        for row, since, excluded in turns:
            segment._open(row, lattice, wanted, since, excluded)

    monkeypatch.setattr(segment, "_open_all", alone)
    for a, b in zip(together, segment.sample(vocabulary, texts, seeds, k), strict=True):
        assert [(x[0].tolist(), *x[1:]) for x in a] == [(x[0].tolist(), *x[1:]) for x in b]


def test_texts_are_cut_together_as_each_alone(vocabulary):
    texts = ["a b", None, "", "  two  runs ", "▁mark▁ed", " ", "a\n b", "b a", "half \ud800 pair"]
    for rows in (texts, texts[:-1]):
        counts, distinct, code = segment._split(rows)
        units = [segment.units_of(t) if t else [] for t in rows]
        assert counts.tolist() == [len(u) for u in units]
        assert [distinct[c] for c in code] == [u for row in units for u in row]
        assert len(set(distinct)) == len(distinct)


def test_batches_of_texts_are_bounded_by_bytes(spark):
    """Ten thousand rows were one batch, held by executor and worker, whatever they take."""

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"rows": [b.num_rows], "size": [b.nbytes]})

    schema = T.StructType([T.StructField("rows", T.LongType()), T.StructField("size", T.LongType())])
    texts = spark.range(0, 6000, 1, 1).select(F.repeat(F.lit("ab "), 1000).alias("text"))
    got = arrow.map_batches(texts, sizes, schema).collect()
    assert sum(r["rows"] for r in got) == 6000
    assert max(r["size"] for r in got) < 2 * arrow.BATCH_BYTES
