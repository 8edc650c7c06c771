"""Operators against brute force on a small fixture with awkward rows, and on empty tables."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabrisk.llm import bpe, components, embed_dedup, fingerprint, html_extract, language, lm_score, ngram_join, packing, quality, secret_scan
from tests.llm.conftest import crc


def union_min(links, ids):
    up = {i: i for i in ids}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


# --- op1 -----------------------------------------------------------------------------------------------

VECS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("label", T.IntegerType()), T.StructField("low", T.StringType())])


def test_embeddings_match_brute_force(spark):
    rng = np.random.default_rng(3)
    centre = rng.standard_normal((4, 16))
    rows = []
    for i in range(300):
        v = centre[i % 4] + (0.05 if i < 200 else 1.0) * rng.standard_normal(16)
        rows.append((i, [float(x) for x in v], i % 3))
    rows += [(300 + k, rows[4][1], rows[4][2]) for k in range(40)]  # a large group of copies
    rows += [(400, None, 1), (401, [0.0] * 16, 1), (402, [1.0] + [float("nan")] * 15, 1), (403, rows[0][1], None), (404, [], 1), (405, [1.0, None] + [0.0] * 14, 1),
             (406, [float("inf")] * 16, 1), (407, [2 * x for x in rows[0][1]], rows[0][2]), (None, rows[0][1], rows[0][2])]
    df = spark.createDataFrame([(*r, "x") for r in rows], VECS)
    got = {r["vec_id"]: r for r in embed_dedup.near_duplicates(df, block=16).collect()}
    good = {i: (np.array(np.float32(v), float), lab) for i, v, lab in rows if i is not None and lab is not None and v and None not in v and np.isfinite(v).all() and np.any(v)}
    links = []
    for a, (x, la) in good.items():
        for b, (y, lb) in good.items():
            if a < b and la == lb and x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.98:
                links.append((a, b))
    n = Counter(i for pair in links for i in pair)
    comp = union_min(links, [r[0] for r in rows if r[0] is not None])
    assert len(links) > 500
    for i, c in comp.items():
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (n[i], c, c == i), i
    assert got[None]["n_links"] == 0 and got[None]["kept"] is False
    assert embed_dedup.near_duplicates(spark.createDataFrame([], VECS)).count() == 0


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 160)] + [(200, 200), (301, 300), (300, 301)]
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(links, "a bigint, b bigint").repartition(5)).collect()}
    want = union_min(links, {x for p in links for x in p})
    assert got == {i: c for i, c in want.items() if i != c}


# --- op2 -----------------------------------------------------------------------------------------------

def test_fingerprints(docs, data, no_docs):
    out = fingerprint.compare_with_next(docs).collect()
    rows = sorted(((r[0], r[1] or "") for r in data), key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    texts = [t for _, t in rows]
    edit = [fingerprint.edited(t, u) for t, u in zip(texts, texts[1:] + texts[:1])]
    want = Counter((i, len(t), hashlib.sha256(e.encode()).hexdigest()) for (i, t), e in zip(rows, edit))
    assert Counter((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in out) == want
    by_id = {r["doc_id"]: r for r in out}
    text = {r[0]: r[1] or "" for r in data}
    same = {}
    for i, r in by_id.items():
        if i not in (5, 108):
            assert same.setdefault(text[i], r["fingerprint"]) == r["fingerprint"]
    err = []
    for (i, t), e in zip(rows, edit):
        if i not in (5, 108):
            a, b = Counter(t.split()), Counter(e.split())
            true = sum((a & b).values()) / max(1, sum((a | b).values())) if a or b else 1.0
            err.append(by_id[i]["near_edited"] - true)
    assert abs(np.mean(err)) < 0.02 and np.std(err) < 0.06
    assert fingerprint.compare_with_next(no_docs).count() == 0


def test_one_document_is_its_own_next(spark):
    r = fingerprint.compare_with_next(spark.createDataFrame([(1, "abcdef")], "doc_id bigint, text string")).collect()
    assert len(r) == 1 and r[0]["near_next"] == 1.0 and r[0]["edited_sha256"] == hashlib.sha256(b"abcabc").hexdigest()


# --- op3 -----------------------------------------------------------------------------------------------

def test_language_model(docs, data, no_docs):
    from tabrisk.llm.common import crc_fold

    out = lm_score.score(docs, crc_fold(F.col("doc_id"), 7) == 2).collect()
    assert len(out) == len(data)
    toks = [[*(r[1] or "").encode().lower().split(), b"\n"] for r in data]
    count = Counter(w for r, ws in zip(data, toks) if crc(r[0], 7) != 2 for w in ws)
    n, v = sum(count.values()), len(count)
    want = Counter((r[0], crc(r[0], 7) == 2, len(ws), sum(w in count for w in ws), n, round(sum(np.log10((count[w] + 1) / (n + v + 1)) for w in ws), 4)) for r, ws in zip(data, toks))
    assert Counter((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 4)) for r in out) == want
    assert all(r["score"] < 0 for r in out)
    assert lm_score.score(no_docs, F.lit(False)).count() == 0


def test_held_out_score_beats_base_score(spark):
    rows = lm_score.op3(spark, "/root/testdata/sf0.001").where("held_out").collect()
    assert len(rows) > 20 and sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows)


def test_token_probabilities_sum_to_one():
    m = lm_score.Model(np.arange(1.0, 60.0))
    t = lm_score.Trainer(m, 1)
    rng = np.random.default_rng(2)
    ids = np.tile([3, 7, 11, 20], 800)
    near, far = lm_score.contexts(ids, np.array([0]), 0)
    before = np.mean([m.noise[i] for i in ids])
    for _ in range(60):
        pick = rng.permutation(len(ids))[:1000]
        t.step(ids[pick], near[pick], far[pick])
    a, b, z = m.tables()
    p = np.exp(a[:, None, :] + b[None, :, :] - z[:, :, None])
    assert np.allclose(p.sum(axis=2), 1, atol=1e-4)
    assert np.exp(a[near, ids] + b[far, ids] - z[near, far]).mean() > 5 * before


def test_contexts_stop_at_texts():
    near, far = lm_score.contexts(np.array([5, 6, 9, 9, 7, 8, 9]), np.array([0, 3, 4]), 9)
    assert near.tolist() == [9, 5, 6, 9, 9, 7, 8] and far.tolist() == [9, 9, 5, 9, 9, 9, 7]


# --- op4 -----------------------------------------------------------------------------------------------

def shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}


def brute_classes(data):
    sets = [shingles(r[1]) for r in data]
    links = [(i, j) for i in range(len(data)) for j in range(i) if sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    return sets, links, union_min(links, range(len(data)))


def test_ngram_join_parity_counts_sign_bits(spark, monkeypatch):
    """Pairs that differ in the highest bit of a parity word are no further apart than others."""
    bits = [np.array([0, np.iinfo(np.int64).min + 1]), *[np.zeros(2, np.int64)] * 3]
    a, _, _ = ngram_join._pairs(np.array([1]), np.array([0]), np.array([5, 9]), np.array([100 << 12 | 1] * 2), np.array([5, 9]), bits, 80)
    assert a.tolist() == [5]

    rng = np.random.default_rng(7)
    rows = []
    for family in range(150):
        words = [f"w{v}" for v in rng.integers(0, 10**9, 60)]
        near = words[:59] + [f"w{family}x"] if family % 2 else words[:30] + ["z"] + words[31:]
        rows += [(2 * family, " ".join(words)), (2 * family + 1, " ".join(near))]
    monkeypatch.setattr(ngram_join, "SEEDS", 1)  # more pairs are left to the prefix join
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.join(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: i - i % 2 for i, _ in rows}


def test_ngram_join_matches_brute_force(docs, data, no_docs, monkeypatch):
    sets, links, comp = brute_classes(data)
    assert len(links) > 50
    least = {}
    for i, c in comp.items():
        if data[i][0] is not None:
            least[c] = min(least.get(c, 1 << 60), data[i][0])
    want = Counter((r[0], len(s), least.get(comp[i]) if s else r[0]) for i, (r, s) in enumerate(zip(data, sets)))
    assert Counter(tuple(r) for r in ngram_join.join(docs).collect()) == want
    # The same with every shared shingle split, and without the help of leaders.
    monkeypatch.setattr(ngram_join, "RUN", 2)
    monkeypatch.setattr(ngram_join, "SEEDS", 1)
    assert Counter(tuple(r) for r in ngram_join.join(docs).collect()) == want
    assert ngram_join.join(no_docs).count() == 0


def test_one_per_class(docs, data):
    sets, _, comp = brute_classes(data)
    got = ngram_join.one_per_class(docs).collect()
    assert got and set(got[0].asDict()) == set(docs.columns)
    named = [i for i in range(len(data)) if data[i][0] is not None and sets[i]]
    assert sum(r["doc_id"] is not None and bool(shingles(r["text"])) for r in got) == len({comp[i] for i in named})
    assert sum(not shingles(r["text"]) for r in got) == sum(not s for s in sets)


def test_match_numbers_grow_with_cost():
    s = np.sort(np.random.default_rng(0).integers(-2**62, 2**62, 400))
    cheap = np.ones(ngram_join.CELLS, np.int32)
    match, p = ngram_join.prefix(s, cheap)
    assert match == 1 and len(p) == 400 - 320 + 1
    match, p = ngram_join.prefix(s, cheap * 5000)
    assert match > 1 and len(p) == 400 - 320 + match


# --- op5 -----------------------------------------------------------------------------------------------

def test_html():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><nav><ul><li><a href=x>Menu, a, b</a></li></ul></nav>
<!-- c --><div class="ad">Buy, now, cheap, today.</div><article><h1>Head &amp; line</h1><p><b>First   part,
 of it.<br><p>Second <i>em</i>phasis, &eacute; here.</p><aside>Side, bar</aside><form>Your mail</form><script>var t="</p>";</script><p>Last one.</article>
<div id="comments"><p>A reader says, well, something, long enough to score, perhaps.</p></div><footer>&copy; me</footer></body></html>"""
    assert html_extract.extract(page) == "Head & line First part, of it. Second emphasis, é here. Last one."
    plain = "<div><div id=sidebar><p>links, links, links</p></div><div class=post><p>" + "Real text, with commas, goes on. " * 8 + "</p><p>More, of it, here.</p></div></div>"
    assert html_extract.extract(plain) == " ".join(("Real text, with commas, goes on. " * 8 + "More, of it, here.").split())
    for broken in ("", "<", "<p", "text only", "<!-- open", "<script>x", "</div></p>", "<p>a<p>b", "<a href='x>y", "&amp;&#x41;&bogus;"):
        html_extract.extract(broken)
    assert html_extract.extract("text only") == "text only"


PROSE = "Real text, with commas, that goes on for a while, as texts do. " * 6


@pytest.mark.parametrize("mark", [
    'style="overflow:hidden"', 'data-state="hidden"', 'data-id="login"', 'data-role="banner"', 'title="id=comments"', 'class="content has-sidebar"',
    'class="no-sidebar"', 'id="side-effects"', 'class="sidebar"', 'id="comments"', 'class="login"'])
def test_wrapper_with_the_article_stays(mark):
    want = " ".join(("Head " + PROSE).split())
    for a, b in (("<article>", "</article>"), ("<main>", "</main>"), ("", "")):
        assert html_extract.extract(f"<body><div {mark}>{a}<h1>Head</h1><p>{PROSE}</p>{b}</div></body>") == want


def test_names_inside_the_article():
    page = f"""<article><p>{PROSE}</p><h2 id="side-effects">Effects</h2><h2 id="related">Kin</h2><section id="related-work"><p>{PROSE}</p></section>
<p id="share-prices">Prices rose.</p><p>See <a href="?id=comments">these</a> now<a class="share" href="/s">Share</a>.</p><section class="menu"><p>{PROSE}</p></section>
<div class="share-buttons">Tell friends</div><ul class="related"><li><a href=x>{PROSE}</a></li></ul><div id="comments"><p>{PROSE}</p></div><form>Your mail</form></article>"""
    want = f"{PROSE} Effects Kin {PROSE} Prices rose. See these now. {PROSE}"
    assert html_extract.extract(page) == " ".join(want.split())


def test_form_around_the_page():
    assert html_extract.extract(f'<body><form id="aspnetForm"><p>{PROSE}</p></form></body>') == PROSE.strip()


@pytest.mark.parametrize("page", [
    "<html><head><title>T</title><meta charset=utf-8><body>{a}", "<head><title>T</title><article>{0}</article>",
    "<body><article><svg viewBox='0 0 1 1'/>{0}</article><svg><text>Not this</text></svg>", "<article><object data=x>{0}</article><p>",
    "<article><audio src=x>{0}</article>", "<article><video src=x>{0}</article><video><p>Not this</p></video>", "<article><canvas>{0}</article>",
    "<article><select>{0}</article>", "<article><iframe src=x>{0}</article>", "<title>T<article>{0}</article>", "<article><textarea>T{0}</article>",
    "<article><object>No<object>No</object>no, not this</object>{0}</article>", "<article><svg><svg>No</svg><title>No</title>no</svg>{0}</article>",
    "<article><template><p>No</p><template>No</template>no</template>{0}</article>", "<article><script>var s='<svg><video>'</script>{0}</article>",
    "<article>{0}<script>var s='{0}'"])
def test_elements_left_open_or_nested(page):
    body = f"<p>{PROSE}</p><p>More, of it, here.</p>"
    assert html_extract.extract(page.replace("{a}", "<article>{0}</article>").replace("{0}", body)) == f"{PROSE}More, of it, here."


@pytest.mark.parametrize("open_, close", [("<section>", "</section>"), ("<div><section>", "</section></div>"), ("<div><div><div>", "</div></div></div>")])
def test_short_sections_without_an_article(open_, close):
    short = "A paragraph of about a hundred characters stands here, it is a real part of the text of this page."
    menu = "<ul><li><a href=a>Home, home</a></li><li><a href=b>About, us</a></li></ul>"
    page = f"""<body><div>{menu}<h3>Elsewhere</h3>{open_}<h1>Head</h1>{f'<p>{PROSE}</p>' * 4}{close}{open_}<h2>Two</h2><p>{short}</p><p>{short}</p>{close}
{open_}<p>Three.</p><ul><li>An item</li><li>See <a href=c>this</a></li></ul>{close}<div><h3>Categories</h3>{menu}</div><p>The end.</p></div>
<div class="sidebar"><p>{short}</p></div><div>{menu}</div></body>"""
    want = f"Elsewhere Head {PROSE * 4}Two {short} {short} Three. An item See this The end."
    assert html_extract.extract(page) == want


def test_math_is_text():
    assert html_extract.extract(f"<article><p>{PROSE}<math><mi>x</mi><mspace/><mo>=</mo><mn>2</mn></math>, so.</p></article>") == f"{PROSE}x=2, so."


def test_pages(spark):
    df = spark.createDataFrame([(1, "u", None, "x"), (2, "v", "<p>a</p>", "y"), (2, "v", "<p>a</p>", "y"), (None, None, "", "z")], "page_id bigint, url string, html string, text string")
    out = sorted(html_extract.extract_pages(df, ["page_id", "url"]).collect(), key=str)
    assert [(r["page_id"], r["text"], r["n_chars"]) for r in out] == [(1, "", 0), (2, "a", 1), (2, "a", 1), (None, "", 0)]


def test_html_reader_comments_go_however_long():
    talk = "I read this twice, and then again, and I disagree with most of it. " * 12
    for name in ("comment", "user-comments", "reader-comments", "comments"):
        for tag in ("article", "div"):
            page = f'<body><{tag}><h1>Head</h1><p>{PROSE}</p><p>{PROSE}</p><div class="{name}"><p>{talk}</p></div></{tag}></body>'
            assert html_extract.extract(page) == " ".join(f"Head {PROSE} {PROSE}".split())


def test_html_named_notice_is_never_the_best_container():
    legal = "<p>" + "We and our partners store cookies, measure visits, and share data, as our policy says. " * 6 + "</p>"
    story = "<p>One day the river rose, slowly.</p><p>People went up the hill, and waited there.</p><p>In the morning the water had gone.</p>"
    want = "One day the river rose, slowly. People went up the hill, and waited there. In the morning the water had gone."
    for page in (f'<body><div class="cookie-notice">{legal * 3}</div><div>{story}</div></body>', f'<body><div>{story}</div><div id="consent">{legal * 3}</div></body>'):
        assert html_extract.extract(page) == want
    # A page whose whole text is inside such an element keeps it.
    assert html_extract.extract(f'<body><div class="popup"><p>{PROSE}</p></div></body>') == " ".join(PROSE.split())


def test_html_empty_table(spark):
    df = spark.createDataFrame([], "page_id bigint, url string, html string, text int, n_chars string")
    assert html_extract.extract_pages(df, ["page_id", "url"]).count() == 0


# --- op6 -----------------------------------------------------------------------------------------------

def brute_grams(text):
    words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    n = Counter()
    for w in words:
        w = f" {w} "
        n.update(g for k in (1, 2, 3) for i in range(len(w) - k + 1) if (g := w[i:i + k]) != " " and " " not in g[1:-1])
    return n


def unpacked(code):
    out = ""
    while code:
        out = (" " if code & 0x1FFFFF == language.BOUNDARY else chr(code & 0x1FFFFF)) + out
        code >>= 21
    return out


def test_language(docs, data, no_docs):
    for t in ("Été 12 à l'été, a-b", "a", "", "12", data[0][1]):
        grams = Counter(unpacked(g) for g in language.ngrams(t).tolist())
        want = brute_grams(t)
        assert grams == want, t
    profiles = language.fit(docs)
    assert sorted(profiles) == ["en", "fr"]
    for lang, p in profiles.items():
        assert 0 < len(p) <= language.PROFILE and len(set(p.tolist())) == len(p)
    got = {(r["doc_id"], r["text"]): r for r in language.predict(docs.select("doc_id", "text", "lang"), profiles).collect()}
    for i, text, lang, *_ in data:
        r = got[(i, text)]
        assert 0 <= r["score"] <= 1
        if not text or not any(c.isalpha() for c in text):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
    long = [(r[0], r[1], r[2]) for r in data if r[1] and len(r[1].split()) > 30 and r[2]]
    assert sum(got[(i, t)]["lang_pred"] == lang for i, t, lang in long) >= 0.95 * len(long)
    assert language.fit(no_docs) == {}
    assert {r["lang_pred"] for r in language.predict(docs.select("doc_id", "text"), {}).collect()} == {"und"}


def test_language_distances_plain(docs, data):
    """Every score again by the definition: rank differences summed, PROFILE for an n-gram that a profile lacks."""
    profiles = language.fit(docs)
    clash = docs.select("doc_id", "text").withColumn("score", F.lit("mine")).withColumn("lang_pred", F.lit(3))
    rows = language.predict(clash, profiles).collect()
    assert len(rows) == len(data)
    place = {k: {g: i for i, g in enumerate(v.tolist())} for k, v in profiles.items()}
    for r in rows:
        own = language.ranked(language.ngrams(r["text"]), language.PROFILE).tolist() if r["text"] else []
        if not own:
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
            continue
        far = {k: sum(abs(p[g] - i) if g in p else language.PROFILE for i, g in enumerate(own)) for k, p in place.items()}
        best = min(sorted(far), key=far.get)
        assert r["lang_pred"] == best and abs(r["score"] - (1 - far[best] / (language.PROFILE * len(own)))) < 1e-12


def test_out_of_place_distance():
    a, b = language.ranked(language.ngrams("aa aa ab"), 400), language.ranked(language.ngrams("zz zy"), 400)
    r = language.Ranker({"a": a, "b": b})
    assert r.predict("aa aa ab") == ("a", 1.0)
    assert r.predict("zz zy")[0] == "b" and r.predict("123") == ("und", 0.0)


# --- op7 -----------------------------------------------------------------------------------------------

BASE = {"assign": (re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 6),
        "access": (re.compile("AKIA[A-Z0-9]+"), 0, 20), "hex": (re.compile("[0-9a-f]+"), 0, 24)}


def brute_secrets(t):
    found = [(m.start(), k, m.end()) for k, (kind, (rx, g, n)) in enumerate(BASE.items()) for m in rx.finditer(t) if len(m[g]) >= n]
    return sorted(found)


def test_secrets(docs, data):
    import random

    rng = random.Random(2)
    bits = ["token", "Secret", "api_key", "APIKEY", "password", "passwd", "=", ":", " ", '"', "'", "abc123", "AKIA", "ABCDEFGH12345678", "0123456789ab", "é", "日", "\n", "-", "==", "x"]
    for _ in range(4000):
        t = "".join(rng.choice(bits) for _ in range(rng.randint(0, 14)))
        assert [s for s in secret_scan.spans(t) if s[1] < 3] == brute_secrets(t), t
    body = "Zz" * 15
    n, sum6 = zlib.crc32(body.encode()), ""
    while n:
        n, d = divmod(n, 62)
        sum6 = secret_scan.BASE62[d] + sum6
    good = f"é ghp_{body}{sum6.rjust(6, '0')} and npm_{body}000000"
    assert secret_scan.described(secret_scan.spans(good)) == "github:2:42"
    assert secret_scan.masked("é token=abcdefg z") == "é [SECRET] z" and secret_scan.masked(None) is None
    out = secret_scan.mask(docs).collect()
    assert Counter((r["doc_id"], r["text"]) for r in out) == Counter((r[0], secret_scan.masked(r[1])) for r in data)
    assert all(r["text"] is None or r["n_chars"] == len(r["text"]) for r in out)


# --- op8 -----------------------------------------------------------------------------------------------

def test_packing(docs, data, no_docs):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    out = packing.pack(docs, path, 256).collect()
    want = Counter()
    for r in data:
        ids = [*tok.encode(r[1] or "", add_special_tokens=False).ids, 0]
        for k in range(0, len(ids), 256):
            part = np.array(ids[k:k + 256], "<u4")
            want[(r[0], k // 256, k, len(part), zlib.crc32(part.tobytes()))] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in out) == want
    by = {}
    for r in out:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by.values():
        at = 0
        for o, n in sorted(places):
            assert o == at
            at += n
        assert at <= 256
    total = sum(r["length"] for r in out)
    assert len(by) <= 1.03 * -(-total // 256) + 1
    assert packing.pack(no_docs, path).count() == 0


def test_plan_places_every_piece_once():
    rng = np.random.default_rng(1)
    for kind in range(4):
        h = np.zeros(2049, np.int64)
        lengths = [rng.integers(1, 2049, 5000), rng.integers(600, 1400, 3000), np.full(777, 683), rng.integers(1, 30, 2000)][kind]
        np.add.at(h, lengths, 1)
        for groups in (0, 5, 160):
            p = packing.Plan(h, groups=groups)
            used = np.zeros(p.bins, np.int64)
            seen = np.zeros_like(h)
            for length, rank, count, first, _ in sorted(p.runs, key=lambda r: r[4]):
                assert (used[first:first + count] == _).all()
                used[first:first + count] += length
                seen[length] += count
            assert (seen == h).all() and (used <= 2048).all() and (used > 0).all()


# --- op9 -----------------------------------------------------------------------------------------------

def test_quality_learns_and_handles_odd_rows(spark, docs, data, no_docs):
    rng = np.random.default_rng(0)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 500, 40)) if i % 3 else " ".join(["BUY!!"] * 30 + [f"NOW{i}!!"]) for i in range(600)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(i % 3 > 0), None) for i in range(600)] + [(7, None, 1), (None, 1, 1), (3, 0, 0)], "doc_id bigint, quality int, toxic int")
    x = quality.with_stats(df, ["doc_id"])
    got = quality.apply(x, quality.fit(quality.training_rows(x, labels)), ["doc_id"]).collect()
    held = [r for r in got if crc(r["doc_id"], 5) == 0]
    assert len(got) == 600 and all(0 <= r["score"] <= 1 for r in got)
    assert sum(r["predicted"] == int(r["doc_id"] % 3 > 0) for r in held) >= 0.97 * len(held)
    model = quality.fit(quality.training_rows(x, labels))
    odd = quality.apply(quality.with_stats(docs, ["doc_id"]), model, ["doc_id"]).collect()
    assert len(odd) == len(data) and all(0 <= r["score"] <= 1 for r in odd)
    assert quality.apply(quality.with_stats(no_docs, ["doc_id"]), model, ["doc_id"]).count() == 0
    assert quality.fit(quality.training_rows(x, labels.where("false"))) is None
    assert {r["score"] for r in quality.apply(x, None, ["doc_id"]).collect()} == {0.5}
    quality.fit(quality.training_rows(x, labels.where("quality = 1")))


def test_isotonic_is_monotone():
    at, p = quality.isotonic(np.array([0, 3, 1, 4, 9.0]), np.array([5, 5, 5, 5, 10.0]), np.arange(5.0))
    assert (np.diff(p) >= 0).all() and (np.diff(at) > 0).all() and len(p) == 4


# --- op10 ----------------------------------------------------------------------------------------------

def test_bpe_is_exact(docs, data, no_docs):
    import random

    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    rng = random.Random(4)
    own = bpe.Encoder(path)
    for _ in range(3000):
        t = "".join(rng.choice("abcde  \n\t'sté日½1#%!") for _ in range(rng.randint(0, 25)))
        ids = tok.encode(t, add_special_tokens=False).ids
        assert own.encode(t) == (",".join(map(str, ids)), tok.decode(ids, skip_special_tokens=False))
    want = Counter()
    for r in data:
        ids = tok.encode(r[1] or "", add_special_tokens=False).ids
        want[(r[0], len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(tok.decode(ids, skip_special_tokens=False).encode()).hexdigest())] += 1
    assert Counter(tuple(r) for r in bpe.digests(docs, path).collect()) == want
    assert bpe.digests(no_docs, path).count() == 0
