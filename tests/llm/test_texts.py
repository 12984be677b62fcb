import hashlib
import math
import random
import re
import unicodedata
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from papyrix.llm import html_text as H
from papyrix.llm import language_id as L
from papyrix.llm import queries as Q
from papyrix.llm import secret_scan as S
from papyrix.llm import substring_dedup as C
from papyrix.llm import suffix_tree_lm as T

DOC = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark, texts, lang="en"):
    return spark.createDataFrame([(i, t, lang, "s", 0) for i, t in enumerate(texts)], DOC)


# Secrets

_ASSIGN = re.compile(r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def brute_spans(text):
    out = [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[1]) >= 12]
    out += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    out += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    for rule in S.RULES[3:]:
        out += [(rule.kind, *m.span()) for m in re.finditer(rule.pattern, text)]
    order = [r.kind for r in S.RULES]
    return sorted(out, key=lambda x: (x[1], order.index(x[0])))


PIECES = ["token", "secret", "password", "PassWd", "api_key", "APIKEY", "=", ":", '"', "'", " ", "AKIA", "ABCDEFGH", "0123456789abcdef", "abc", "deadbeef", "é", "ghp_", "x" * 12, "eyJ", ".", "-----BEGIN ", "PRIVATE KEY-----", "xoxb-", "sk_live_", "_", "-", "12345678", "\n", "\U0001f600"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=14).map("".join))
def test_spans_equal_regular_expressions(text):
    assert S.scanner().spans(text) == brute_spans(text)


def test_secret_query(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = {r["doc_id"]: r for r in Q.op3_secret_scan(spark, small).collect()}
    assert len(rows) == docs.count()
    for r in docs.collect():
        spans = brute_spans(r["text"])
        shown = lambda of: ",".join(f"{k}:{a}:{b}" for k, a, b in of)
        base = [s for s in spans if s[0] in ("assign", "access", "hex")]
        got = rows[r["doc_id"]]
        assert got["spans"] == shown(spans) and got["base_sha256"] == hashlib.sha256(shown(base).encode()).hexdigest()
        assert [got[f"n_{k}"] for k in ("assign", "access", "hex")] == [sum(s[0] == k for s in base) for k in ("assign", "access", "hex")]


def test_secret_long_runs():
    scanner = S.scanner()
    positions, states = scanner.marked(b"0123456789abcdef" * 20_000)
    assert len(positions) > 300_000 and positions.itemsize + states.itemsize == 16
    assert scanner.spans("x" + "0123456789abcdef" * 20_000 + "-" + "ab" * 8) == [("hex", 1, 320_001), ("hex", 320_002, 320_018)]


def test_secret_rows(spark):
    """Rows that repeat are scanned each; other columns may be named like the operator's own."""
    row = (1, "token=abcdefghijkl", "s", "k", 2)
    docs = spark.createDataFrame([row, row, (None, None, None, None, None)], "doc_id long, text string, secrets string, key string, start int")
    assert [(r["doc_id"], [tuple(x) for x in r["secrets"]]) for r in S.scan(docs).orderBy("doc_id").collect()] == [(None, []), (1, [("assign", 0, 18)]), (1, [("assign", 0, 18)])]
    assert S.redact(docs).columns == docs.columns
    assert S.scan(docs.limit(0)).count() == 0


def test_secret_edges(spark):
    key = "token = 'abcdefghijklmnop'"
    out = {r["doc_id"]: r for r in S.digest(S.scan(docs_of(spark, [None, "", f"é {key}", "a" * 100_000 + key]))).collect()}
    assert out[0]["spans"] == out[1]["spans"] == "" and out[2]["spans"] == "assign:2:27" and out[3]["n_assign"] == 1
    clean = S.redact(docs_of(spark, [None, f"x {key} y", "plain"]))
    assert [r["text"] for r in clean.orderBy("doc_id").collect()] == [None, "x [secret]' y", "plain"]
    assert S.scan(docs_of(spark, [])).count() == 0


# Language


def test_language_held_out(spark, small):
    got = {r["doc_id"]: r for r in Q.op2_language_id(spark, small).collect()}
    docs = spark.read.parquet(f"{small}/documents.parquet").collect()
    assert len(got) == len(docs)
    held = [r for r in docs if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert {r["doc_id"] for r in held} == {k for k, v in got.items() if v["held_out"]}
    assert sum(got[r["doc_id"]]["lang_pred"] == r["lang"] for r in held) >= 0.97 * len(held)
    assert all(0 <= v["score"] <= 1 for v in got.values())


def test_language_edges(spark):
    docs = spark.createDataFrame([(i, t, lang, "s", 0) for i, (t, lang) in enumerate([("the cat and the dog", "en"), ("le chat et le chien", "fr"), (None, "en"), ("123 --", "fr"), ("the cat", None), ("漢字", None), ("cat " * 50_000, None), ("chatty", None)])], DOC)
    model = L.train(docs)
    out = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in L.predict(docs, model).collect()}
    assert out[0][0] == "en" and out[1][0] == "fr" and out[2] == out[3] == ("und", 0.0) and out[6][0] == "en" and out[5][0] in ("en", "fr")
    kept = L.keep_identified(docs)
    assert kept.columns == docs.columns and {2, 3}.isdisjoint(r["doc_id"] for r in kept.collect())
    nothing = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in L.predict(docs, L.train(nothing)).collect()} == {"und"}
    assert L.identify(docs.limit(0)).count() == 0


def brute_words(text):
    """Runs of letters and marks that begin with a letter."""
    out, word = [], ""
    for c in text.lower():
        kind = unicodedata.category(c)[0]
        if kind == "L" or (kind == "M" and word):
            word += c
        elif word:
            out.append(word)
            word = ""
    return out + [word] if word else out


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(), st.sampled_from("ab é½②³Ⅷ1_\u0301\u093f\u0939İ\U0001d400\U000e0101")), max_size=40))
def test_words_are_letters(text):
    assert L.words_of_letters(text) == brute_words(text)


def test_no_letters(spark):
    model = L.LanguageModel({"en": {"the": 2}})
    out = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in L.predict(docs_of(spark, ["½ ②", "³ Ⅷ 12", "", None, "the ½"]), model).collect()}
    assert out == {0: ("und", 0.0), 1: ("und", 0.0), 2: ("und", 0.0), 3: ("und", 0.0), 4: ("en", 1.0)}


def test_every_language_is_sampled(spark):
    rows = [(i, f"the cat {i % 7} sat", "en", "s", 0) for i in range(300)] + [(1000, "y gath oedd yno", "cy", "s", 0), (None, "y gath", "cy", "s", 0)]
    docs = spark.createDataFrame(rows, DOC)
    some = L.sampled(docs, "doc_id", "lang", 5).collect()
    assert Counter(r["lang"] for r in some) == {"en": 5, "cy": 2}
    model = L.train(docs, max_docs=5)
    assert model.languages == ["cy", "en"] and set(model.words[0]) == {"the", "cat", "sat", "y", "gath"}
    assert {r["lang_pred"] for r in L.predict(docs.filter("doc_id = 1000"), model).collect()} == {"cy"}


def test_grams_equal_parts(spark):
    words = {"en": {"the": 3, "a": 2}, "de": {"der": 4, "über": 1}}
    rows = [(lang, w, n) for lang, of in words.items() for w, n in of.items()]
    got = [{} for _ in range(L.LONGEST)]
    for r in L.gram_counts(spark.createDataFrame(rows, "lang string, word string, n long")).collect():
        got[r["size"] - 1].setdefault(r["lang"], {})[r["part"]] = r["n"]
    direct, counted = L.LanguageModel(words), L.LanguageModel(words, got)
    for a, b in zip(direct.grams, counted.grams):
        assert a[0] == b[0] and np.allclose(a[1], b[1])


def test_unseen_words_back_off():
    model = L.LanguageModel({"en": {"thing": 5, "the": 9}, "de": {"ding": 5, "der": 9}})
    scores = L.TextScores(model)
    en, de = model.languages.index("en"), model.languages.index("de")
    text = lambda t: scores.of([t])[0]
    assert text("thin")[en] > text("thin")[de] and text("dinge")[de] > text("dinge")[en]
    batch = scores.of(["thin", None, "dinge thin", "!"])
    assert batch[1] is None and batch[3] is None and np.allclose(batch[0], text("thin"))


# Language model


def test_suffix_tree_base_score(spark, small):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    count = Counter()
    for k, text in docs.items():
        if zlib.crc32(str(k).encode()) % 7 != 2:
            count.update([*text.encode().lower().split(), b"\n"])
    total, kinds = sum(count.values()), len(count)
    got = {r["doc_id"]: r for r in Q.op4_suffix_tree_lm(spark, small).collect()}
    for k, text in docs.items():
        tokens = [*text.encode().lower().split(), b"\n"]
        r = got[k]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(tokens), sum(t in count for t in tokens), total)
        assert r["base_score"] == pytest.approx(sum(math.log10((count[t] + 1) / (total + kinds + 1)) for t in tokens))
        assert r["score"] < 0 and r["held_out"] == (zlib.crc32(str(k).encode()) % 7 == 2)


def test_rare_words_are_joined(spark):
    docs = docs_of(spark, ["a a a b b c d", "a c e", None, ""])
    whole = sorted(map(tuple, T.score(docs, docs).collect()))
    for a, b in zip(whole, sorted(map(tuple, T.score(docs, docs, frequent=1).collect()))):
        assert a == pytest.approx(b)


def naive_tree(texts, min_gain):
    """Counts of all contexts, retained ones, and probabilities by recursion."""
    counts = {}
    for text in texts:
        body = b" ".join((text or "").encode().lower().split()) + b"\n"
        data = b"\n" * T.DEPTH + body
        for i in range(T.DEPTH, len(data)):
            for d in range(T.DEPTH + 1):
                counts.setdefault(data[i - d : i], Counter())[data[i]] += 1
    keep = {b""}
    for s, c in counts.items():
        if s:
            n, up = sum(c.values()), counts[s[1:]]
            m = sum(up.values())
            if sum(k * math.log((k / n) / (up[x] / m)) for x, k in c.items()) >= min_gain:
                keep |= {s[i:] for i in range(len(s))}

    def p(s, x):
        while s not in keep:
            s = s[1:]
        shorter = p(s[1:], x) if s else 1 / 256
        c = counts[s]
        return (c[x] + len(c) * shorter) / (sum(c.values()) + len(c))

    def score(text):
        data = b"\n" * T.DEPTH + b" ".join((text or "").encode().lower().split()) + b"\n"
        return sum(math.log10(p(data[i - T.DEPTH : i], data[i])) for i in range(T.DEPTH, len(data)))

    return score


def test_suffix_tree_equals_recursion(spark):
    rng = random.Random(4)
    texts = [" ".join(rng.choices(["the", "then", "Café", "x", "abab"], k=rng.randint(0, 30))) for _ in range(40)] + [None]
    train, other = docs_of(spark, texts), docs_of(spark, [*texts[:5], "zebra é", None, ""])
    want = naive_tree(texts, 3.0)
    got = T.score(other, train, min_gain=3.0).collect()
    for r in got:
        text = [*texts[:5], "zebra é", None, ""][r["doc_id"]]
        assert r["score"] == pytest.approx(want(text))
    untrained = T.score(other, train.limit(0)).collect()
    assert {r["n_known"] for r in untrained} == {0} and all(r["score"] < 0 for r in untrained)
    assert T.score(other.limit(0), train).count() == 0


def test_every_context_that_passes_is_retained(spark):
    # behind each of 70,000 contexts of 2 bytes stands a byte that its suffix of 1 byte doesn't tell
    pairs = spark.range(70_000).select((F.col("id") % 256).alias("b"), F.expr("id div 256").alias("a"))
    rows = pairs.select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("side"))
    value = F.expr("(a * 256 + b) * 256 + CASE WHEN side = 0 THEN a % 256 ELSE (a * 7 + b) % 256 END")
    entries, gains = T.context_gains(rows.select(value.cast("bigint").alias("value"), F.lit(100).cast("bigint").alias("n")))
    passing = {(r["d"], r["context"]) for r in gains.filter(F.col("gain") >= 12.0).collect()}
    assert len(passing) > 1 << 16
    grams = rows.select(value.cast("bigint").alias("value"), F.lit(100).cast("bigint").alias("n"))
    [(_, _, tree)] = T.grow(grams, 12.0)
    kept = {(d, int(c)) for d, of in enumerate(tree().contexts) for c in of}
    assert passing <= kept
    parts = [(low, high, tree()) for low, high, tree in T.grow(grams, 12.0, slice_entries=60_000)]
    assert len(parts) > 2 and all(sum(map(len, t.keys[2:])) <= 60_000 for _, _, t in parts)
    assert kept == {(d, int(c)) for _, _, t in parts for d, of in enumerate(t.contexts) for c in of}


def test_slices_of_the_tree_score_as_the_whole(spark):
    rng = random.Random(5)
    texts = [" ".join(rng.choices(["the", "then", "Café", "x", "abab"], k=rng.randint(0, 30))) for _ in range(60)] + [None, "", "the then" * 400]
    docs = docs_of(spark, texts)
    whole = sorted(map(tuple, T.score(docs, docs, min_gain=3.0).collect()))
    for most in (1, 40):
        parts = T.grow(T.counts(docs, "text").filter("kind = 0").select("value", "n"), 3.0, most)
        assert len(parts) > 2 and parts[0][0] == 0 and parts[-1][1] == T.PAIRS and all(a[1] == b[0] for a, b in zip(parts, parts[1:]))
    # few slices, since each is a pass
    most = max(40, sum(len(k) for k in T.grow(T.counts(docs, "text").filter("kind = 0").select("value", "n"), 3.0)[0][2]().keys) // 3)
    sliced = sorted(map(tuple, T.score(docs, docs, min_gain=3.0, slice_entries=most).collect()))
    assert len(sliced) == len(whole)
    for a, b in zip(whole, sliced):
        assert a == pytest.approx(b)


# Pages

STORY = "This is the story of a man and his dog, and of the house that they had built in the wood by the river with their own hands over the years. It was not a large house but it was theirs and they were happy in it."


def test_main_text_of_an_article():
    page = f"""<html><head><title>T</title><style>p{{}}</style><script>var a="</p>";</script></head><body><header><p>Site</p></header><nav><ul><li><a href=x>Home</a></ul></nav>
    <div class="ad">{STORY}</div><article><h1>Head &amp; line</h1><p><b>{STORY}<br><p>Short &lt;b&gt;.</p><aside>{STORY}</aside><form>{STORY}</form><!-- {STORY} --><p hidden>{STORY}</p></article>
    <div id="comments"><article><p>{STORY}</p></article></div><footer>{STORY}</footer>"""
    assert H.main_text(page) == f"Head & line\n\n{STORY}\n\nShort <b>."


@pytest.mark.parametrize("script", ["for(var i=0;i<n;i++)a[i]=f('x');", "a<b&&c", "it's \"<b", "x='</scripts>';i<n", "<!-- i<n"])
@pytest.mark.parametrize("end", ["</script>", "</SCRIPT >"])
def test_raw_elements_end_at_their_end_tag(script, end):
    assert H.main_text(f"<script>{script}{end}<article><p>{STORY}</p></article><script>{script}{end}<p>After</p>") == STORY
    assert H.main_text(f"<article><p>{STORY}</p></article><script>{script}") == STORY


def test_main_text_without_an_article():
    page = f"<div><a href=x>Home</a> <a href=y>News of the day</a></div><div><h2>Title here</h2><p>{STORY}</p><p>Short.</p><p>{STORY}</p></div><div>Impressum</div><p>kwd1 kwd2 {'foo ' * 40}</p>"
    assert H.main_text(page) == f"Title here\n\n{STORY}\n\nShort.\n\n{STORY}"
    unclosed = f"<div class=ad>Buy now<p>{STORY}</p><p>{STORY}</p>"
    assert H.main_text(unclosed) == f"{STORY}\n\n{STORY}"


def brute_keep(found):
    """The two passes, block by block as the docstring says them."""

    def words(b):
        out = []
        for w in re.findall(r"[^\W\d_]+", b.text.lower()):
            out += list(w) if re.search("[\u3040-\u30ff\u3400-\u9fff]", w) else [w]
        return out

    texts = [[] if b.linked > 0.33 * len(b.text) else words(b) for b in found]
    every = [w for t in texts for w in t]
    best = max(H.STOPS, key=lambda s: sum(w in s for w in every))
    if sum(w in best for w in every) < 0.05 * len(every):
        often = [w for w in set(every) if sum(w in t for t in texts) >= 3]
        best = sorted(often, key=lambda w: (-every.count(w), w))[:30]
    first = []
    for b, t in zip(found, texts):
        z = (sum(w in best for w in t) - 0.15 * len(t)) / math.sqrt(0.15 * 0.85 * len(t)) if t else 0
        first.append(False if b.linked > 0.33 * len(b.text) else True if t and z >= 1.64 else "thin" if t and z <= -1.64 else "near" if z > 0 else "short")
    out = []
    for i, (b, mine) in enumerate(zip(found, first)):
        sides = [next((k for k in order if isinstance(first[k], bool)), None) for order in (range(i - 1, -1, -1), range(i + 1, len(found)))]
        left, right = (k is not None and first[k] for k in sides)
        article = any(x.in_article for x in found)
        if isinstance(mine, bool):
            out.append(mine)
        elif True not in first:
            out.append(b.in_article if article else mine == "near")
        elif left == right:
            out.append(left)
        elif article:
            out.append(b.in_article)
        else:
            beside = found[sides[0] if left else sides[1]]
            out.append(mine != "thin" and (b.container == beside.container or (b.heading and right)))
    return out


_PROSE = ["the of and to in", "river house", "the man was in the house by the river and he was happy to be there with all of them", "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma", "Он не был в доме", "и в на не что он"]
_BLOCKS = st.lists(st.builds(lambda t, k, linked, h, a, c: H.Block(" ".join([t] * k), len(t) * k if linked else 0, h, a, c), st.sampled_from(_PROSE), st.integers(1, 9), st.sampled_from([False, False, False, True]), st.booleans(), st.sampled_from([False, True]), st.integers(0, 2)), max_size=12)


@settings(max_examples=400, deadline=None)
@given(_BLOCKS)
def test_two_passes_equal_brute_force(found):
    assert H.final_labels(found, H.first_labels(found)) == brute_keep(found)


def test_two_passes_on_all_pages(spark, small):
    pages = [r["html"] for r in spark.read.parquet(f"{small}/pages.parquet").collect()]
    same = 0
    for page in pages:
        found = H.blocks(page)
        assert H.main_text(page) == "\n\n".join(b.text for b, good in zip(found, brute_keep(found)) if good)
        same += H.main_text(page) == H.main_text(page, tags=False)
    assert len(pages) / 2 < same < len(pages)


RUSSIAN = "Он не знал, что это было в доме, и не хотел идти. Но в доме он был не один, и это он знал."


def test_other_scripts_have_stop_words_of_their_own():
    page = f"<ul><li><a href=x>Главная</a><li><a href=y>Новости</a></ul>{''.join(f'<p>{RUSSIAN}</p>' for _ in range(4))}<div>{'товар цена скидка ' * 12}</div><div><a href=z>Контакты</a></div>"
    assert H.main_text(page) == "\n\n".join([RUSSIAN] * 4)
    han = "我们的人在这里,他是我的朋友,也是你的朋友。"
    assert H.main_text("".join(f"<p>{han}{i}</p>" for i in range(5))) == "\n\n".join(f"{han}{i}" for i in range(5))


def test_names_and_teasers_do_not_hide_a_page():
    assert H.main_text(f'<div class="social policy"><p>{STORY}</p></div>') == STORY
    assert H.main_text(f'<article><h3><a href=x>Teaser</a></h3></article><div><p>{STORY}</p><p>{STORY}</p></div>') == f"{STORY}\n\n{STORY}"
    for raw in ("iframe src=x", "object data=x", "template", "svg", "noscript", "script"):
        assert H.main_text(f"<{raw}><p>{STORY}</p>") == STORY


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["<p>", "</p>", "<article>", "</article>", "<div class='ad'>", "</div>", "<a>", "</a>", "<", ">", "<!--", "-->", "<script>", "</script>", "&amp;", "word ", "<br/>", "<p", '"', "<li>"]), max_size=25).map("".join))
def test_any_page_has_a_text(page):
    text = H.main_text(page)
    assert text == text.strip() and "\n\n\n" not in text


def test_pages(spark, small):
    out = Q.op5_html_text(spark, small)
    assert out.filter("n_chars <> length(text) or text is null").count() == 0
    pages = spark.createDataFrame([(1, "u", None), (2, None, ""), (None, "u", "<p>" * 5000)], "page_id long, url string, html string")
    assert [r["text"] for r in H.extract(pages).collect()] == ["", "", ""] and H.extract(pages.limit(0)).count() == 0


# Substrings


def rolled(symbols):
    h, out = 0, []
    for s in symbols:
        h = ((h << 1) + int(C.GEAR[(s ^ (s >> 8)) & 0xFF])) & 0xFFFFFFFF
        out.append(h)
    return out


def test_gear_hash_rolls():
    rng = np.random.default_rng(1)
    symbols = rng.integers(0, 3000, 500).astype(np.uint32)
    assert C.gear_hashes(symbols)[32:].tolist() == rolled(symbols.tolist())[32:]


@settings(max_examples=100, deadline=None)
@given(st.text(max_size=1500))
def test_chunks_cover_a_text(text):
    ends = C.cuts(text)
    sizes = np.diff([0, *ends])
    assert (ends[-1] if ends else 0) == len(text) and all(0 < s <= C.MAX for s in sizes) and all(s >= C.MIN for s in sizes[:-1])


def test_repeats(spark):
    rng = random.Random(2)
    words = lambda n: " ".join("".join(rng.choices("abcdefghij", k=rng.randint(2, 9))) for _ in range(n))
    passage = words(60)
    texts = [f"{words(80)} {passage} {words(70)}", f"{words(33)} {passage} {words(20)}", words(100), None, "", "short", "short"]
    docs = docs_of(spark, texts)
    spans = C.repeated_spans(docs).collect()
    assert {r["doc_id"] for r in spans} == {0, 1} and {(r["doc_id"], r["removed"]) for r in spans} == {(0, False), (1, True)}
    for r in spans:
        assert texts[r["doc_id"]][r["start"] : r["end"]] in passage and r["copies"] == 2
    out = {r["doc_id"]: r["text"] for r in C.remove_repeats(docs).collect()}
    gone = next(r for r in spans if r["removed"])
    assert out[1] == texts[1][: gone["start"]] + texts[1][gone["end"] :] and all(out[i] == texts[i] for i in (0, 2, 3, 4, 5, 6))
    assert C.repeated_spans(docs.limit(0)).count() == 0
    same = C.repeated_spans(docs_of(spark, [passage] * 5)).collect()
    assert sorted((r["doc_id"], r["start"], r["end"], r["removed"]) for r in same) == [(i, 0, len(passage), i > 0) for i in range(5)]


def test_least_counts_whole_regions(spark):
    rng = random.Random(5)
    words = lambda n: " ".join("".join(rng.choices("abcdefghij", k=rng.randint(2, 9))) for _ in range(n))
    x, y = words(60), words(60)
    docs = docs_of(spark, [f"{words(40)} {x} {words(40)}", f"{words(30)} {x} {y} {words(30)}", f"{words(50)} {x} {y} {words(50)}"])
    spans = C.repeated_spans(docs, least=400).collect()
    # x and y are too short alone; in document 1 x is a repeat, y is not, and both together are long enough
    assert {(r["doc_id"], r["removed"]) for r in spans} == {(1, True), (1, False), (2, True)}


def brute_repeats(rows, least):
    """rows: (key, text). Spans by a dictionary of chunk texts; which of equal rows is the first is left open."""
    places = {}
    for row, (key, text) in enumerate(rows):
        ends = C.cuts(text) if text else []
        for a, b in zip([0, *ends], ends):
            places.setdefault(text[a:b], []).append((key is not None, key or 0, a, row, b))
    hits = {}
    for of in places.values():
        if len(of) > 1:
            for place in of:
                hits.setdefault(place[3], []).append((place[2], place[4], len(of), place != min(of)))
    out = []
    for row, of in hits.items():
        regions = []
        for h in sorted(of):
            if regions and regions[-1][-1][1] == h[0]:
                regions[-1].append(h)
            else:
                regions.append([h])
        for region in regions:
            if region[-1][1] - region[0][0] >= least:
                spans = []
                for h in region:
                    if spans and spans[-1][-1][3] == h[3]:
                        spans[-1].append(h)
                    else:
                        spans.append([h])
                out += [(rows[row][0], s[0][0], s[-1][1], max(h[2] for h in s), s[0][3]) for s in spans]
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_repeats_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    words = lambda n: " ".join("".join(rng.choices("abcdeé", k=rng.randint(2, 9))) for _ in range(n))
    passages = [words(rng.choice([5, 30, 60])) for _ in range(6)]
    rows = []
    for i in range(40):
        body = [words(rng.randint(0, 30)), *rng.choices(passages, k=rng.randint(0, 3)), words(rng.randint(0, 20))]
        rows.append((rng.choice([i, i, i, 7, None]), " ".join(body)))
    rows += [rows[3], rows[3], (None, rows[5][1]), (None, None), (8, ""), (9, "x" * 700), (10, "short text again"), (11, "short text again")]
    docs = spark.createDataFrame([(k, t, "en", "s", 0) for k, t in rows], DOC).coalesce(1)
    got = sorted((tuple(r) for r in C.repeated_spans(docs).collect()), key=repr)
    assert got == brute_repeats(rows, C.LEAST) and got


def test_equal_rows_and_null_keys_are_documents_of_their_own(spark):
    rng = random.Random(3)
    text = " ".join("".join(rng.choices("abcdefghij", k=rng.randint(2, 9))) for _ in range(60))
    for keys in ((1, 1), (None, None), (1, None)):
        rows = [(k, text, "en", "s", 0) for k in keys]
        out = sorted((r["start"], r["end"], r["removed"]) for r in C.repeated_spans(spark.createDataFrame(rows, DOC)).collect())
        assert out == [(0, len(text), False), (0, len(text), True)]
        left = sorted(r["text"] for r in C.remove_repeats(spark.createDataFrame(rows, DOC)).collect())
        assert left == ["", text]


def test_short_texts_are_cut_too(spark):
    assert any(len(C.cuts("".join(random.Random(i).choices("abcdefghij ", k=32)))) > 1 for i in range(40))
    clash = spark.createDataFrame([(1, "a b", 5, "x"), (2, None, 6, "y")], "row long, text string, start int, copies string")
    assert C.repeated_spans(clash, "row").count() == 0 and C.remove_repeats(clash, "row").columns == clash.columns
