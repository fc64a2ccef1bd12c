"""Operators on pages and vectors, and the pipeline, against brute force."""

from __future__ import annotations

import html
import re
import time
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from affinity.llm.catalog import LLM_QUERIES
from affinity.llm.common import read_table
from affinity.llm.decontam import expected_rows
from affinity.llm.embed_dedup import embedding_components, spherical_kmeans
from affinity.llm.html_parse import read_page
from affinity.llm.html_template import deduce_templates, extract_main_text, main_text
from affinity.llm.url_filter import PATTERNS, SITE_RULES, compile_rules, filter_urls, read_rules
from affinity.session import write_stage
from test_text_ops import brute_simhash, check_packing, redacted

SF = "/root/testdata/sf0.001"

# ---------------------------------------------------------------------------------- URL filters

URLS = [
    None,
    "",
    "no scheme/net/",
    "http://a.net",
    "http://a.net/",
    "HTTP://A.Example.NET/en/x?y#z",
    "http://example.net/en",
    "http://badexample.com/de/x",
    "http://x.example.com/de/?q",
    "http://example.com/DE/",
    "http://cheap-pills.example.com/fr/",
    "https://xxx.site.io/",
    "https://site.xxx.io/robots.txt",
    "https://casino-win.io/robots.txt",
    "https://casino-win.io/robots.txt?x",
    "http://a.gov/-bets.",
    "http://agency.gov",
    "http://h.org/cgi-bin/a/b.exe",
    "http://h.org/cgi-bin/a/b.exe?x",
    "http://h.io/?SessionID=4",
    "http://h.io/a.sessionid=4",
    "a://b://c.org/fr/",
    "http://é.org/fr/ü",
    "http://host.io:80/" + "a/" * 5000 + "wp-login.php",
]


def fits(pattern: str, url: str) -> bool:
    """A filter-list pattern by hand: try every start, wildcards by recursion."""
    url = re.sub("[A-Z]", lambda m: m[0].lower(), url)

    def at(p, i):
        if not p:
            return True
        if p == "|":
            return i == len(url)
        if p[0] == "*":
            return any(at(p[1:], j) for j in range(i, len(url) + 1))
        if p[0] == "^":
            return (i == len(url) and at(p[1:], i)) or (i < len(url) and not re.match(r"[0-9a-z_.%-]", url[i]) and at(p[1:], i + 1))
        return i < len(url) and url[i] == p[0] and at(p[1:], i + 1)

    if pattern.startswith("||"):
        m = re.match(r"[^:/?#]*://([^/?#]*)", url)
        starts = [] if not m else [m.start(1)] + [m.start(1) + k + 1 for k, c in enumerate(m[1]) if c == "."]
        return any(at(pattern[2:], i) for i in starts)
    return any(at(pattern, i) for i in range(len(url) + 1))


def judge(url):
    if url is None:
        return "", "", None, "allow"
    host, path = "", ""
    if "://" in url:
        rest = url.split("://", 1)[1]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), re.split("[/?#]", rest)[0])
        path = re.split("[?#]", rest[len(host) :])[0]
    sites = [r for r in SITE_RULES if "://" in url and (host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])]
    if sites:
        best = max(sites, key=lambda r: len(r[1] + r[2]))
        return host, path, best[1] + best[2], best[0]
    found = {a for a, p in PATTERNS if fits(p, url)}
    return host, path, None, "block" if found == {"block"} else "allow"


def test_urls_match_brute_force(spark):
    rows = [(i, u, "old") for i, u in enumerate(URLS + URLS[:3])]
    pages = spark.createDataFrame(rows, "page_id long, url string, url_rule string")
    got = filter_urls(pages).collect()
    cols = ("url_host", "url_path", "url_rule", "url_verdict")
    assert {r["page_id"]: tuple(r[c] for c in cols) for r in got} == {i: judge(u) for i, u, _ in rows}
    assert filter_urls(pages.limit(0)).collect() == []


def test_rules_without_tokens_and_without_rules(spark):
    pages = spark.createDataFrame([(1, "http://a.io/x"), (2, "http://b.io/y")], "page_id long, url string")
    got = filter_urls(pages, site_rules=(), patterns=(("block", "*/x"),)).collect()
    assert [r["url_verdict"] for r in sorted(got)] == ["block", "allow"]
    assert {r["url_verdict"] for r in filter_urls(pages, site_rules=(), patterns=()).collect()} == {"allow"}


def filter_list(n):
    """Lines of a filter list: hosts, paths, wildcards, exceptions, comments and rules of other kinds."""
    rng = np.random.default_rng(6)
    out = ["! Title: a list", "[Adblock Plus 2.0]", "example.com##.advert", "||x.com^$third-party", "/banner[0-9]+/", "*", ""]
    for i in range(n):
        kind = i % 5
        host = f"ads{i}.site{int(rng.integers(0, n))}.com"
        out.append([f"||{host}^", f"/banner/{i}/*.gif|", f"&track{i}=", f"@@||ok{i}.net/ads/", f"|http://{host}/pop*up"][kind])
    return out


def test_rules_of_a_list_in_a_file(spark, tmp_path):
    """Tens of thousands of rules: planned in seconds, few of them run for a URL, the same verdicts as all of them."""
    path = tmp_path / "list.txt"
    path.write_text("\n".join(filter_list(30_000)))
    patterns, others = read_rules(spark, str(path))
    assert len(patterns) == 30_000 and others == 4
    urls = [f"http://www.ads{i}.site{j}.com/banner/{i}/x.gif" for i, j in ((0, 1), (5, 7), (11, 3), (21, 9), (99, 99))]
    urls += [p[2:-1].join(["https://sub.", "/page?id=1"]) for a, p in patterns[::3000] if p.startswith("||") and a == "block"]
    urls += ["http://ok3.net/ads/banner/6/y.gif", "http://q.org/?a=1&track7=8", "http://a.b/banner/26/z.gif", "http://plain.org/", None]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    started = time.time()
    judged = filter_urls(pages, site_rules=(), patterns=patterns)
    assert time.time() - started < 20
    rows = {r["page_id"]: r for r in judged.collect()}
    rules = [(r, re.compile(re.sub(r"\\Q|\\E", "", r.regex))) for r in compile_rules((), patterns)]
    for i, u in enumerate(urls):
        fit = next((r for r, x in rules if u is not None and x.search(u.lower())), None)
        assert (rows[i]["url_verdict"], rows[i]["url_pattern"]) == ((fit.action, fit.text) if fit else ("allow", None)), u
    assert {r["url_verdict"] for r in rows.values()} == {"allow", "block"}
    # Of 30,000 rules a URL meets a handful.
    assert max(r["url_candidates"] for r in rows.values()) < 20


def test_index_tokens_stand_whole():
    rules = {r.text: r.tokens for r in compile_rules()}
    assert rules["net/"] == ("net",) and rules["example.com/de/"] == ("example", "com", "de")
    assert rules["-pills."] == ("pills",) and rules["/cgi-bin/*.exe|"] == ("cgi", "bin", "exe")
    assert rules["://casino-"] == ("casino",)


# ---------------------------------------------------------------------------------- HTML


def test_article_text_of_the_table(spark):
    got = {r["page_id"]: r for r in LLM_QUERIES["op4_html_extraction"](spark, SF).collect()}
    pages = read_table(spark, SF, "pages").collect()
    assert len(got) == len(pages)
    for p in pages:
        article = re.search(r"<article>(.*?)(</article>|$)", p["html"] or "", re.S)
        blocks = re.split("</?(?:h1|p)>", article[1]) if article else []
        blocks = [re.sub("<(b|/b|br)>|<[^>]*$", lambda m: " " if m[0] == "<br>" else "", b) for b in blocks]
        blocks = [" ".join(html.unescape(b).split()) for b in blocks]
        want = "\n\n".join(b for b in blocks if b)
        assert got[p["page_id"]]["text"] == want and got[p["page_id"]]["n_chars"] == len(want)


@pytest.mark.parametrize(
    "page, text",
    [
        ("", ""),
        ("plain &lt; text\n two", "plain < text two"),
        ("<p>a<p>b<br>c</p>d", "a\n\nb c\n\nd"),
        ("<nav>n</nav><article><p>x <b>y</b>z</p><aside>s</aside></article><footer>f</footer>", "x yz"),
        ("<main><form>f</form><p>a</p></main><p>b</p>", "a"),
        ('<div class="Cookie-Notice"><p>c</p></div><p>a</p>', "a"),
        ('<div id="sidebar">s</div><div class="post-body"><p>a</p><div class="comments"><p>no</p></div></div><p>tail</p>', "a"),
        ("<article><h1>T</h1><ul><li>1<li>2</ul><table><tr><td>3<td>4</table></article>", "T\n\n1\n\n2\n\n3\n\n4"),
        ("<article>a<script>if (x < y) '</p>'</script><style>p{}</style><!-- c --><noscript>n</noscript>b", "a\n\nb"),
        ("<article><p>cut <b", "cut"),
        ("<article><p>&amp;amp; &#233;&nbsp;x &am", "&amp; é x &am"),
        ('<article><p title="a>b">t</p><section class="reader-comments"><p>c</p></section></article>', "t"),
        ("<article><header><h1>T</h1></header><p>a</p></article><header>site</header>", "T\n\na"),
        ("<article><p>x</p><div role=alert>w</div><div hidden>h</div></article>", "x"),
        ("<script>never closed <article>x", ""),
        ("<!-- never closed <article>x", ""),
        ("<div><p>a</div></div></p>b", "a\n\nb"),
    ],
)
def test_main_text(page, text):
    assert main_text(read_page(page), frozenset()) == text


@pytest.mark.parametrize(
    "page, text",
    [
        *(
            (f'<div class="{c}"><nav>n</nav><article><p>a</p><p>b</p></article></div><footer>f</footer>', "a\n\nb")
            for c in ("site no-sidebar", "has-sidebar", "overflow-hidden", "elementor-widget-container", "content-overlay", "sidebar")
        ),
        ('<form id="aspnetForm"><div class="menu">m</div><main><p>a</p><form>f</form></main></form>', "a"),
        ('<form><div class="menu">m</div><p>a long text</p><p>in a form</p></form><p>tail</p>', "a long text\n\nin a form\n\ntail"),
        ('<article><div class="overflow-hidden"><p>a</p></div><p>b</p><div class="elementor-widget x"><p>c</p></div></article>', "a\n\nb\n\nc"),
        ('<article><p>a</p></article><div class="related-posts"><article><p>a card with more text</p></article></div>', "a"),
        ('<article><p>a</p></article><div class="comments"><p>a very long comment</p></div>', "a"),
    ],
)
def test_names_of_wrappers_leave_the_article(page, text):
    assert main_text(read_page(page), frozenset()) == text


def test_all_named_elements_with_a_slot_stay(spark):
    head = '<div class="post-title"><h1>T</h1></div><div class="post-body"><p>body text</p></div>'
    halves = '<div class="entry-content"><p>one</p></div><div class="ad">x</div><div class="entry-content"><p>two, longer</p></div>'
    assert main_text(read_page(head), frozenset()) == "T\n\nbody text"
    assert main_text(read_page(halves), frozenset()) == "one\n\ntwo, longer"
    box = '<div class="content"><p>Read us</p><p>every day</p></div>'
    rows = [(i, "http://h.io/", f'{box}<div class="story"><p>Story {i}</p></div>') for i in range(8)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r["page_id"]: r["text"] for r in extract_main_text(pages).collect()} == {i: f"Story {i}" for i in range(8)}


def test_template_of_a_host_drops_what_its_pages_repeat(spark):
    def page(i):
        return f"<div><p>Welcome to our site</p></div><div><p>Story {i}</p><p>More of {i * 7}</p></div><div><p>All rights kept</p></div>"

    rows = [(i, f"http://h.io/{i}", page(i)) for i in range(8)] + [(50, "http://one.io/", page(0)), (51, None, None), (52, "x", "")]
    pages = spark.createDataFrame(rows + rows[:1], "page_id long, url string, html string").withColumn("host", F.lit(1))
    got = {r["page_id"]: r["text"] for r in extract_main_text(pages).collect()}
    assert all(got[i] == f"Story {i}\n\nMore of {i * 7}" for i in range(8))
    assert got[50].startswith("Welcome to our site\n\nStory 0") and got[51] == got[52] == ""
    assert extract_main_text(pages.limit(0)).collect() == []


def test_repeated_paragraphs_inside_articles_stay(spark):
    rows = [(i, "http://h.io/", "<nav>menu</nav><article><p>same</p><p>same too</p></article>") for i in range(9)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r["text"] for r in extract_main_text(pages).collect()} == {"same\n\nsame too"}
    assert deduce_templates(pages).count() == 1


# ---------------------------------------------------------------------------------- vectors


def brute_vectors(rows, threshold=0.93):
    good = []
    for r in rows:
        v = None if r[1] is None or r[2] is None or any(x is None for x in r[1]) else np.array(r[1], dtype=float)
        ok = v is not None and len(v) and np.isfinite(v).all() and v.any()
        good.append(v / np.linalg.norm(v / np.abs(v).max()) / np.abs(v).max() if ok else None)
    parent, links = list(range(len(rows))), [0] * len(rows)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(good):
        for j in range(i):
            b = good[j]
            if a is not None and b is not None and len(a) == len(b) and rows[i][2] == rows[j][2] and a @ b >= threshold:
                links[i] += 1
                links[j] += 1
                parent[max(find(i), find(j))] = min(find(i), find(j))
    low = defaultdict(list)
    for i, r in enumerate(rows):
        low[find(i)].append(r[0])
    known = {k: min([x for x in v if x is not None], default=None) for k, v in low.items()}
    return Counter((r[0], links[i], known[find(i)], r[0] is not None and r[0] == known[find(i)]) for i, r in enumerate(rows))


SIZES = [
    {},
    {"cell_rows": 12, "block_rows": 5, "max_centres": 7},
    {"cell_rows": 1, "block_rows": 1, "sample_rows": 9},
    {"cell_rows": 2, "block_rows": 3, "max_centres": 4},
    {"cell_rows": 3, "block_rows": 200, "max_centres": 2},
]


@pytest.mark.parametrize("sizes", SIZES)
def test_vectors_match_brute_force(spark, sizes):
    rng = np.random.default_rng(11)
    rows = []
    for c in range(6):
        centre = rng.normal(size=8)
        for _ in range(14):
            rows.append((len(rows), (centre + rng.normal(size=8) * rng.choice([0.05, 0.3, 0.6])).tolist(), c % 2))
    rows += [(500 + i, rows[3][1], 0) for i in range(12)] + [(3, rows[3][1], 0), (None, rows[3][1], 0)]
    rows += [(600, None, 0), (601, [], 0), (602, [0.0] * 8, 0), (603, [float("nan")] + [1.0] * 7, 0), (604, rows[3][1], None)]
    rows += [(605, [None] + [1.0] * 7, 0), (606, [float("inf")] + [1.0] * 7, 0), (607, rows[3][1][:4], 0), (None, None, 1)]
    rows += [(608, [x * 1e200 for x in rows[3][1]], 0), (609, rows[3][1], 1)]
    table = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<double>, label int, node int, n int")
    got = embedding_components(table, **sizes).collect()
    assert Counter(map(tuple, got)) == brute_vectors(rows)


def test_over_64_cells_of_one_label_in_two_levels(spark):
    from affinity.llm import embed_dedup

    rng = np.random.default_rng(8)
    centres = rng.normal(size=(40, 6))
    x = centres[rng.integers(0, 40, 700)] + rng.normal(size=(700, 6)) * rng.choice([0.05, 0.2, 0.5], (700, 1))
    rows = [(i, v.tolist(), 1) for i, v in enumerate(x)]
    fitted, fit = [], embed_dedup.fit_cells
    embed_dedup.fit_cells = lambda *a: fitted.append(fit(*a)) or fitted[-1]
    try:
        got = embedding_components(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), cell_rows=7).collect()
    finally:
        embed_dedup.fit_cells = fit
    assert fitted[0].lower is not None and len(fitted[0]) > 64
    assert Counter(map(tuple, got)) == brute_vectors(rows)


def test_each_vector_of_a_cell_of_one_block_is_sent_once():
    """Residents at home, guests where a plane is near; nothing else, in either number of levels."""
    from affinity.llm.embed_dedup import fit_cells

    rng = np.random.default_rng(3)
    x = rng.normal(size=(50, 1, 8)) + rng.normal(size=(50, 40, 8)) * 0.02
    x = (x / np.linalg.norm(x, axis=2, keepdims=True)).reshape(-1, 8)
    for most in (64, 5):
        row, cell, guest = fit_cells(x, 50, most).place(x, float(np.arccos(0.99)))
        assert Counter(row[~guest].tolist()) == Counter(range(2000))
        assert len(np.unique(cell[~guest])) > 20 and guest.sum() < 2000


def test_no_vectors(spark):
    table = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert embedding_components(table).collect() == []


def test_kmeans_finds_far_centres():
    rng = np.random.default_rng(2)
    centres = np.eye(5)
    x = np.repeat(centres, 40, axis=0) + rng.normal(size=(200, 5)) * 0.05
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    found = spherical_kmeans(x, 5)
    assert np.allclose(np.sort((found @ centres.T).max(axis=1)), 1, atol=0.01) and len(found) == 5


# ---------------------------------------------------------------------------------- pipeline


def test_pipeline_matches_brute_force(spark):
    docs = read_table(spark, SF, "documents").collect()
    items = [tuple(r) for r in read_table(spark, SF, "benchmark").select("item_id", "text").collect()]
    kept = [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in docs if re.search(r"[^\W\d_]", r["text"] or "")]
    component = {i: c for (i, _, c), _ in brute_simhash(kept).items()}
    kept = [r for r in kept if component[r[0]] == r[0]]
    hit = {r[0] for r in expected_rows([r[:2] for r in kept], items) if r[5]}
    kept = [(i, redacted(t), lang, s) for i, t, lang, s in kept if i not in hit]
    assert 0 < len(kept) < len(docs) and hit
    pieces = corpus_pipeline.run(spark, SF).collect()
    assert {p["doc_id"] for p in pieces} == {r[0] for r in kept}
    check_packing(pieces, kept)


def test_pipeline_stages_keep_columns_and_edge_cases(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, spans int"
    rows = [
        (1, "the and of with this that " * 9, "en", "a", None, 1),
        (2, "the and of with this that " * 9, "en", "a", 3, 1),
        (None, "the and of with this that " * 9, "en", "a", 3, 1),
        (4, None, "en", "a", 0, 1),
        (5, "", None, "a", 0, 1),
        (6, "12 34 !", "en", "a", 7, 1),
        (7, "der die und mit token=abcdefgh nicht ein " * 3, None, None, 4, 1),
        (8, "der die das und mit nicht ein " * 12, "de", "b", 4, 1),
    ]
    for data in (rows, []):
        docs = spark.createDataFrame(data, schema)
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, SF)
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "spans"], name
        got = {r["doc_id"]: r for r in docs.collect()}
        if data:
            assert set(got) == {1, 7, 8}
            assert "abcdefgh" not in got[7]["text"] and got[7]["n_chars"] == len(got[7]["text"]) and got[7]["lang"] == "de"
        else:
            assert got == {}


def test_pipeline_languages_reject_by_the_model(spark):
    rng = np.random.default_rng(8)
    stems = {"en": "the and of with this that from have been which their", "de": "der die und mit nicht ein wurde auch sich nach"}
    langs = list(stems) * 200
    rows = [(i, " ".join(rng.choice(stems[x].split(), 40)), x, "s", 0) for i, x in enumerate(langs)]
    noise = " ".join("".join(rng.choice(list("bcdfghjklmnpqrstvwxz"), 6)) for _ in range(60))
    finnish = "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto."
    rows += [(1000, noise, None, "s", 0), (1001, noise, "en", "s", 0), (1002, finnish, None, "s", 0), (1003, "und", None, "s", 0)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    got = corpus_pipeline.language_id(spark, spark.createDataFrame(rows, schema), SF).collect()
    assert {r["doc_id"] for r in got} == {*range(400), 1003}
    # Nothing to learn from: all with a letter pass on.
    unlabelled = [(i, t, None, s, n) for i, t, _, s, n in rows[:9]] + [(9, "12", None, "s", 0), (10, None, None, "s", 0)]
    got = corpus_pipeline.language_id(spark, spark.createDataFrame(unlabelled, schema), SF).collect()
    assert {(r["doc_id"], r["lang"]) for r in got} == {(i, None) for i in range(9)}


#: Names that stages and operators use inside, and those of their results.
INNER = """lang_pred score lang_fits held_out secret_key secret_rules secret_m0 secret_t1 secret_s2 secret_spans secret_merged
key rules gram folded pipeline_row pipeline_text_key component_id kept fingerprint code row root node a b u v m c x n h
queue part start ids spans block span bits word words n_words n_hit n_items items_sha256 contaminated near_items
value position item_id freq rank bin offset room gap rn __rn __part before own""".split()


def test_stages_carry_columns_of_any_name(spark):
    fields = ", ".join(f"`{c}` int" for c in INNER)
    rows = [r[:5] for r in read_table(spark, SF, "documents").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    values = list(range(len(INNER)))
    docs = spark.createDataFrame(
        [(*r, *values) for r in rows], f"doc_id long, text string, lang string, source string, n_chars long, {fields}"
    )
    plain = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs, plain = write_stage(stage(spark, docs, SF), "named"), write_stage(stage(spark, plain, SF), "plain")
        assert docs.columns == [*plain.columns, *INNER], name
        got = [tuple(r) for r in docs.collect()]
        assert all(list(r[5:]) == values for r in got), name
        assert Counter(r[:5] for r in got) == Counter(tuple(r) for r in plain.collect()), name
    pieces = [corpus_pipeline.STAGES[-1][1](spark, d, SF).select("doc_id", "start", "length", "ids_crc32") for d in (docs, plain)]
    assert Counter(map(tuple, pieces[0].collect())) == Counter(map(tuple, pieces[1].collect()))
