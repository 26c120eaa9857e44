"""Filter audit, vector codes and page texts against brute force and awkward tables."""

import hashlib
import itertools
import math
import random
import sys
from collections import Counter, defaultdict
from fractions import Fraction
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from trafficloom.llm import codebooks, filter_audit, page_diff, page_lines  # noqa: E402

SF = "/root/testdata/sf0.001"


# -- filter audit

def brute_audit(docs, labels):
    import re

    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    rows = []
    for doc, text, lang in docs:
        t = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {
            "A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t),
            "D": any(c in t for c in "#$%&*|"),
            "E": doc is not None and any(o is not None and o < doc and (x or "") == t for o, x, _ in docs),
        }
        rows.append((lang or "", {k for k, v in fails.items() if v}, doc in good, doc in toxic))
    out = {}
    for part in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == part]
        shapley = Counter()
        for order in map("".join, itertools.permutations("ABCDE")):
            left, gone = mine, []
            for step, f in enumerate(order, 1):
                hit = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                out[part, order, step] = [
                    len(left), len(hit), sum(f in r[1] for r in gone), sum(r[1] == {f} for r in mine),
                    sum(r[2] for r in hit), sum(r[3] for r in hit),
                ]
                gone = gone + hit
                shapley[f] += len(hit)
        for (p, order, step), row in out.items():
            if p == part:
                row.append(shapley[order[step - 1]])
    return out


def found_audit(df):
    names = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    return {(r.part, r.filter_order, r.step): [r[n] for n in names] for r in df.collect()}


def test_audit_against_every_order_applied(spark):
    rng = random.Random(2)
    texts = [" ".join(rng.choices(["a", "b", "Cd", "x#", "é"] + [str(i) for i in range(n)], k=k))
             for n, k in itertools.product((0, 3, 300), (1, 150, 250, 600))] + ["", None, " \t\n", "AB", "  "]
    docs = [(rng.choice((None, rng.randrange(40))), rng.choice(texts), rng.choice((None, "", "en", "de")), 1, "s") for _ in range(300)]
    labels = [(rng.choice((None, rng.randrange(40))), rng.choice((0, 1, None)), rng.choice((0, 1, None)), 1) for _ in range(60)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, n int, fails string")
    marked = spark.createDataFrame(labels, "doc_id long, quality int, toxic int, part int")
    want = brute_audit([d[:3] for d in docs], [x[:3] for x in labels])
    got = filter_audit.audit(df, marked)
    assert found_audit(got) == want and got.count() == len(want) == 3 * 600
    # The folded removals of all steps are what the last step does not keep.
    ends = got.groupBy("part", "filter_order").agg(F.sum("removed").alias("r"), F.min(F.when(F.col("step") == 5, F.col("kept"))).alias("k"))
    assert ends.select((F.col("r") + F.col("k")).alias("n"), "part").distinct().count() == 3
    assert filter_audit.audit(df.filter("1 = 0"), marked).count() == 0
    assert found_audit(filter_audit.audit(df, marked.filter("1 = 0"))) == brute_audit([d[:3] for d in docs], [])


def test_audit_of_one_very_long_text(spark):
    long_text = " ".join(str(i % 70_000) for i in range(300_000))
    df = spark.createDataFrame([(1, long_text, "en"), (2, long_text, "en"), (3, "short", "en")], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(2, 1, 1)], "doc_id long, quality int, toxic int")
    got = found_audit(filter_audit.audit(df, labels))
    assert got["en", "BEACD", 1] == [1, 2, 0, 1, 1, 1, 2 * 120 - 60]
    assert got == brute_audit([(1, long_text, "en"), (2, long_text, "en"), (3, "short", "en")], [(2, 1, 1)])


# -- vector codes

def brute_codes(rows):
    """rows: id, label, vector; by length, as (id, label, code, error) and the books' digest."""
    out = []
    fine = [r for r in rows if r[2] is not None and all(x is not None and math.isfinite(x) for x in r[2])]
    for dim in {len(v) for _, _, v in fine}:
        mine = sorted((r for r in fine if len(r[2]) == dim), key=lambda r: (r[0] is None, r[0] or 0, r[2]))
        whole = [[math.floor(256 * Fraction(x)) for x in v] for _, _, v in mine]
        cut = [p * dim // 16 for p in range(17)]
        books = [[w[cut[p] : cut[p + 1]] for w in whole[:64]] for p in range(16)]

        def assign():
            made = []
            for w in whole:
                d = [[sum((x - y) ** 2 for x, y in zip(w[cut[p] : cut[p + 1]], e)) for e in books[p]] for p in range(16)]
                made.append([(min(x), x.index(min(x))) for x in d])
            return made

        for _ in range(2):
            made = assign()
            for p in range(16):
                for e in range(len(books[p])):
                    own = [w[cut[p] : cut[p + 1]] for w, m in zip(whole, made) if m[p][1] == e]
                    if own:
                        books[p][e] = [sum(x) // len(own) for x in zip(*own)]
        digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
        for (i, label, _), m in zip(mine, assign()):
            out.append((i, label, "".join(f"{e:02x}" for _, e in m), sum(d for d, _ in m), digest))
    totals = defaultdict(int)
    for _, label, _, error, _ in out:
        totals[label] += error
    most = 2**63 - 1
    return sorted(((i, c, min(e, most), min(totals[label], most), h) for i, label, c, e, h in out), key=str)


def found_codes(df):
    names = ("vec_id", "code", "error", "label_error", "codebooks_sha256")
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=str)


@pytest.mark.parametrize("block", [4096, 37])
def test_codes_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(codebooks, "BLOCK", block)
    table = pq.read_table(f"{SF}/embeddings.parquet").to_pandas()
    rows = [(int(i), int(c), [float(x) for x in v]) for i, v, c in zip(table["vec_id"], table["embedding"], table["label"])]
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    assert found_codes(codebooks.compress(df)) == brute_codes(rows)


def test_codes_of_awkward_vectors(spark):
    rng, nan = random.Random(7), float("nan")
    rows = [(rng.choice((None, rng.randrange(90))), rng.choice((None, 0, 1)), [rng.gauss(0, 1) for _ in range(32)]) for _ in range(150)]
    rows += [(1000 + i, 5, rows[0][2]) for i in range(80)]  # one vector many times
    rows += [(2000, None, None), (2001, 1, []), (2002, 1, [nan] * 32), (2003, 1, [float("-inf")] * 32), (2004, 0, [None] * 32)]
    rows += [(3000 + i, 2, [rng.choice((-1, 1)) * 10.0 ** rng.randrange(-3, 12) for _ in range(20)]) for i in range(70)]
    rows += [(4000 + i, 3, [rng.choice((-1.0, 1.0)) * rng.random() * 1.7e308 for _ in range(16)]) for i in range(70)]
    rows += [(5000, 4, [0.001]), (5001, 4, [-0.001])]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, label int, embedding array<double>, dim int, code string")
    got = found_codes(codebooks.compress(df))
    assert got == brute_codes(rows) and any(e == 2**63 - 1 for _, _, e, _, _ in got)
    assert codebooks.compress(df.filter("1 = 0")).count() == 0


# -- page texts

def length_of_common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = row[:]
        for j, y in enumerate(b):
            row[j + 1] = last[j] + 1 if x == y else max(last[j + 1], row[j])
    return row[-1]


@pytest.mark.parametrize("cells", [1 << 26, 1, 300])
def test_alignment_is_a_longest_common_subsequence(monkeypatch, cells):
    monkeypatch.setattr(page_diff, "_CELLS", cells)
    rng = random.Random(11)
    for _ in range(400):
        a = [rng.randrange(rng.choice((2, 6, 40))) for _ in range(rng.randrange(40))]
        b = [rng.randrange(rng.choice((2, 6, 40))) for _ in range(rng.randrange(40))]
        if rng.random() < 0.3:
            b = a[:10] + b + a[-7:]
        pairs = page_diff.common(a, b)
        assert all(a[i] == b[j] for i, j in pairs) and len(pairs) == length_of_common(a, b)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))


PAGE = """<!DOCTYPE html><html><head><title>t &amp; t</title><style>p{{}}</style></head><body class="has-sidebar">
<header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a><li>News</ul></nav><div class="cookie-notice">We use cookies</div>
{body}
<section id="comments"><p>first!</p><form><input value="x"><button>Send</button></form></section>
<div class="adBox">Buy <b>now</b></div><aside>Other</aside><footer>&copy; site</footer><script>var a = "</p>"; if (a < 1) {{}}</script></body></html>"""
KEPT = "Title & more\nFirst bold text with a break.\nItem\nx < y"
BODY = """<{0}><header><h1>Title &amp; more</h1></header><p>First <b>bo</b>ld
  text<br>with a <i>break</i>.<p class="notice">Log in<p hidden>no<ul><li>Item</ul><!-- <p>gone</p> -->
<script type="x">document.write("<p>no</p>")</script><p>x &lt; y</p><div class="share-buttons"><span>Share</span></div></{1}>"""


def text_of(html):
    found, marks = page_lines.lines(html)
    return "\n".join(t for t, m in zip(found, marks) if m)


@pytest.mark.parametrize("tag", ["article", "main", "div class='entry-content'", "div itemprop=articleBody", "section role=\"main\""])
def test_containers(tag):
    html = PAGE.format(body=BODY.format(tag, tag.split()[0]))
    assert text_of(html) == KEPT
    # Where nothing declares the article, its header can't be told from the site's.
    assert text_of(PAGE.format(body=BODY.format("div", "div"))) == KEPT.split("\n", 1)[1]


def test_lines_of_broken_markup():
    cases = {
        None: "", "": "", " \n ": "", "just text": "just text", "a<b": "a", "1 < 2 > 0": "1 < 2 > 0", "<p>a<p>b": "a\nb",
        "<div><article>x</div>y</article>z": "x", "</div>x</p>": "x", "<p>a<!-- b": "a", "<p>a<script>b": "a",
        "<a href='x>y'>k</a>": "k", "<a href=\"x>k</a> <p>m": "k\nm", "<td>1</td><td>2</td>": "1\n2", "&amp&#x41;&bogus;&nbsp;b": "&A&bogus; b",
        "<nav>a<p>b</nav>c": "c", "<span class=ad>x</span>y": "y", "<p class=ad>x<p>y": "y", "<style>a</STYLE >b": "b",
        "<article>a</article><article>b</article>c": "a\nb", "<main><article>a</article>b</main>": "a\nb", "<b>x</b>y z": "xy z",
        "<template><p>a</template><noscript>b</noscript>c": "c", "<div style='display: none'>a</div>b": "b",
    }
    assert {h: text_of(h) for h in cases} == cases
    deep = "<div>" * 50_000 + "x" + "</span>" * 50_000
    assert text_of(deep) == "x" and text_of("<p>a" * 30_000).count("\n") == 29_999 and text_of('<a b="' * 20_000 + ">") is not None


def page_rows(rng):
    """Pages of two hosts without telling containers: a frame per section, own lines, copies."""
    rows, want, i = [], {}, 0
    for host, section in (("a.example", "en"), ("a.example", "fr"), ("b.example", "x")):
        frame = [f"{host} {section} {k}" for k in range(6)]
        for n in range(12):
            own = [f"{host} {section} page {n} line {k} " + "words " * 20 for k in range(rng.randint(1, 30))]
            own.insert(rng.randrange(len(own) + 1), "a line that every page has in its text " * (n % 2))
            own = [t.strip() for t in own if t]
            body = frame[:4] + own + frame[4:]
            html = "".join(f"<div class='c{k}'>{t}</div>" for k, t in enumerate(body))
            for copy in range(3 if n == 5 else 1):
                rows.append((i, f"https://{host}/{section}/{n}{'?copy=' * copy}#top", html, "h", 1))
                want[i] = "\n".join(own)
                i += 1
    return rows, want


def test_frames_go_and_own_lines_stay(spark):
    rows, want = page_rows(random.Random(4))
    ddl = "page_id long, url string, html string, host string, content int"
    got = {r.page_id: r for r in page_diff.main_text(spark.createDataFrame(rows, ddl).repartition(5)).collect()}
    assert len(got) == len(rows)
    same = sum(got[i].text == t for i, t in want.items())
    print("pages whose text is exactly their own", same, "of", len(want))
    assert same == len(want) and all(r.n_shared == 6 and r.n_chars == len(r.text) for r in got.values())


def brute_page_texts(rows):
    """The rule of main_text by a plain loop over all pages of a host."""
    parsed = [(i, page_diff.host_and_path(u), page_lines.lines(h)) for i, u, h in rows]
    pages: dict = {}
    for _, (host, path), (found, marks) in parsed:
        if 1 in marks:
            left = tuple(t for t, m in zip(found, marks) if m)
            pages[host, left] = min(pages.get((host, left), path), path)
    out = []
    order = sorted(((h, p.encode(), left) for (h, left), p in pages.items()), key=lambda x: x[:2])
    for i, (host, _), (found, marks) in parsed:
        left = tuple(t for t, m in zip(found, marks) if m)
        gone: set = set()
        if 1 in marks:
            at = next(k for k, o in enumerate(order) if (o[0], o[2]) == (host, left))
            near = [(k, o) for k, o in enumerate(order) if 0 < abs(k - at) <= 2 and o[0] == host]
            near = [{"host": host, "path": o[1].decode(), "at": k, "hashes": list(o[2]), "lengths": [len(t) for t in o[2]]} for k, o in near]
            me = {"host": host, "path": order[at][1].decode(), "at": at, "hashes": list(left), "lengths": [len(t) for t in left]}
            gone = set(page_diff.shared_lines(me, near))
        out.append((i, "\n".join(t for k, t in enumerate(left) if k not in gone)))
    return sorted(out, key=str)


def test_page_texts_against_a_plain_loop(spark):
    rows, _ = page_rows(random.Random(8))
    rows = [r[:3] for r in rows] + [
        (None, None, None), (900, None, "<div>x</div>"), (900, None, "<div>x</div>"), (901, "", ""), (902, "no url", "<div>y</div><div>x</div>"),
        (903, "HTTP://u:p@A.example/en/3", "<div>a.example en 0</div><div>z</div>"), (904, "//b.example", "<article>b.example x 0</article>"),
        (905, "https://b.example/x/5", "<div>" + "long " * 100_000 + "</div>" + "<p>k</p>" * 3000),
    ]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = page_diff.main_text(df)
    assert sorted(((r.page_id, r.text) for r in got.collect()), key=str) == brute_page_texts(rows)
    assert page_diff.main_text(df.filter("1 = 0")).count() == 0


def test_pages_that_declare_their_article_are_aligned_too(spark):
    """The alignment meets every page and all its lines; the containers have the last word."""
    rows = [
        (i, f"https://a.example/{i}", f"<nav>Home</nav><nav>menu {i}</nav><article><p>own {i} {'words ' * 9}</p><p>As ever.</p>"
         f"<p>more {i}</p></article><footer>a.example</footer>")
        for i in range(8)
    ]
    rows += [(8 + i, f"https://b.example/{i}", f"<div>Home</div><p>own {i} {'words ' * 9}</p><div>a.example</div>") for i in range(3)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    frames = [(r.host, r.frame) for r in page_diff.frame_lines(df.select("url", "html")).collect()]
    assert sorted(frames) == [("a.example", [False, True, False])] * 8 + [("b.example", [True, False, True])] * 3
    got = {r.page_id: r for r in page_diff.main_text(df).collect()}
    for i in range(8):
        assert got[i].text == f"own {i} {'words ' * 9}".strip() + f"\nAs ever.\nmore {i}"
        assert (got[i].n_shared, got[i].n_kept) == (0, 1)
    assert all(got[8 + i].text.startswith(f"own {i}") and (got[8 + i].n_shared, got[8 + i].n_kept) == (2, 0) for i in range(3))
    # Of a page's lines the alignment sees those too that the check takes away.
    narrow = page_diff._parse(iter([pa.RecordBatch.from_pylist([{"url": None, "html": rows[0][2]}])]), pa.schema(
        {"hashes": pa.list_(pa.int64()), "lengths": pa.list_(pa.int32()), "is_open": pa.bool_()}), False)
    (row,) = next(narrow).to_pylist()
    assert len(set(row["hashes"])) == 6 and [n > 0 for n in row["lengths"]] == [False, False, True, True, True, False]
    assert not row["is_open"]


def test_a_neighbours_advert_takes_no_line(spark):
    advert = "<div class='ad'>As ever.</div>"
    rows = [(i, f"//a.example/{i}", f"<div>Frame</div>{advert if i != 2 else '<p>As ever.</p>'}<p>own {i} {'words ' * 9}</p>") for i in range(5)]
    got = page_diff.main_text(spark.createDataFrame(rows, "page_id long, url string, html string"))
    own = {i: f"own {i} {'words ' * 9}".strip() for i in range(5)}
    assert {r.page_id: r.text for r in got.collect()} == own | {2: f"As ever.\n{own[2]}"}


@pytest.mark.parametrize("bits", [0, 1, 2])
def test_neighbours_meet_across_blocks(spark, monkeypatch, bits):
    monkeypatch.setattr(page_diff, "_BLOCK", bits)
    rows = [r[:3] for r in page_rows(random.Random(15))[0]]
    got = page_diff.main_text(spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert sorted(((r.page_id, r.text) for r in got.collect()), key=str) == brute_page_texts(rows)


def test_given_pages_hold_their_documents(spark):
    """Menus, adverts and footers out, the article in, also where a sentence is on many pages."""
    import html as h
    import re

    df = spark.read.parquet(f"{SF}/pages.parquet")
    own = {r.page_id: r for r in page_diff.main_text(df).collect()}
    for r in df.collect():
        inside = re.search(r"<article>(.*)</article>", r.html, re.S)[1]
        blocks = [" ".join(h.unescape(re.sub("<br>", " ", re.sub("</?b>", "", b))).split()) for b in re.split(r"</?p>|</?h1>", inside)]
        assert own[r.page_id].text == "\n".join(b for b in blocks if b)
