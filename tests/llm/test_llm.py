"""The numbered operators against brute force, and their edge cases on small fixtures."""

import collections
import hashlib
import math
import random
import re
import time
import zlib

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from skyledger.llm import bpe, common, exact_dedup, html_text, jaccard, licenses, maxent, mixing, quality, queries, sharding, url_filter
from skyledger.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BASE = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty"
#: Extra columns bear names that operators use themselves.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, row string, kept boolean, digest string"


def document(i, text, source="a", lang="en"):
    return (i, text, lang, source, None, -1, "x", None, "d")


ROWS = [
    document(1, BASE),
    document(2, BASE.replace(" ", "  ") + "\n"),
    document(3, BASE + " more"),
    document(4, BASE.upper()),
    document(5, None),
    document(6, ""),
    document(7, " \t\n", None),
    document(8, "One.", "b"),
    document(9, "é ü 日本 Straße Σας", "b", None),
    document(10, "a b c d e " * 30, "b"),
    document(11, "line here now\n" * 4 + BASE, "c"),
    document(12, " ".join(f"w{i}" for i in range(20000)), "c"),
    document(None, BASE + " nobody", None, None),
    document(1, BASE),
    document(13, "Released under the\nMIT License. Licensed under the Apache License, Version 2.0.", "c"),
]


@pytest.fixture(scope="module")
def docs(spark):
    common.ship(spark)
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_empty_tables(spark, nothing):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    for name in ("op1_license_scan", "op3_byte_shards", "op5_word_bpe", "op6_jaccard_join", "op7_balanced_mix", "op8_maxent_lm", "op9_adaptive_quality", "op10_exact_dedup"):
        assert getattr(queries, name.split("_")[0])(nothing).collect() == [], name
    assert queries.op2(pages).collect() == [] and queries.op4(pages).collect() == []


def test_exact_dedup(docs):
    got = rows(queries.op10(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256"))
    groups = collections.defaultdict(list)
    for i, t, *_ in ROWS:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((-len(t or ""), i is None, i if i is not None else 0, i))
    want = []
    for body, members in groups.items():
        best, seen = min(members), False
        for m in members:
            kept = m == best and not seen
            seen = seen or kept
            want.append((m[3], best[3], len(members), kept, hashlib.sha256(body.encode()).hexdigest()))
    assert got == sorted(want, key=str)
    kept = exact_dedup.keep_one(docs)
    assert kept.columns == docs.columns and kept.count() == len(groups)


def test_shards(docs):
    out = queries.op3(docs).collect()
    assert collections.Counter(r["doc_id"] for r in out) == collections.Counter(i for i, *_ in ROWS)
    assert all(r["size"] == len((t or "").encode()) + 1 for r in out for i, t, *_ in ROWS if i == r["doc_id"] and i != 1)
    assert all(r["text_crc32"] == zlib.crc32((t or "").encode()) for r in out for i, t, *_ in ROWS if i == r["doc_id"])
    for shard in {r["shard"] for r in out}:
        assert sorted(r["slot"] for r in out if r["shard"] == shard) == list(range(sum(r["shard"] == shard for r in out)))
    even = sharding.shard_by_bytes(docs.sparkSession.range(10000), F.lit(10), 8, order=("id",)).groupBy("shard").count().collect()
    assert len(even) == 8 and {r["count"] for r in even} == {1250}


def test_quality_counts(docs):
    for r in queries.op9(docs).collect():
        text = next(t for i, t, *_ in ROWS if i == r["doc_id"]) or ""
        words = WORD.findall(text)
        windows = collections.Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
        covered = {i + k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(5)}
        lines = [line for line in text.split("\n") if WORD.search(line)]
        want = (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
        assert r["base_failed"] == failed and not (failed and r["kept"])


def test_thresholds_adapt(spark):
    clean = [(i, " ".join(f"word{(i * 7 + k) % 97}" for k in range(40)), "en", "s", "x") for i in range(60)]
    junk = [(100 + i, " ".join(f"#$%{k}{i}" for k in range(40)), "en", "s", "x") for i in range(3)]
    df = spark.createDataFrame(clean + junk, "doc_id long, text string, lang string, source string, kept string")
    assert {r["doc_id"] for r in quality.judged(df).where("kept").select("row.doc_id").collect()} == set(range(60))
    noisy = spark.createDataFrame([(i, t, g, s, k) for i, t, g, s, k in junk * 20], df.schema)
    assert quality.judged(noisy).where("kept").count() == 60, "a source of nothing but symbols sets its own cutoff"


def brute_components(rule, texts):
    sets = {}
    for i, t in texts:
        w = (t or "").encode().lower().split()
        n = rule.width
        sets[i] = frozenset(tuple(w[k : k + n]) for k in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])
    root = {i: i for i in sets}

    def find(x):
        return x if root[x] == x else find(root[x])

    ids = list(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            common_ = len(sets[a] & sets[b])
            if common_ and 100 * common_ >= rule.percent * (len(sets[a]) + len(sets[b]) - common_):
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize("side", [300, 4_000_000])
def test_jaccard(spark, monkeypatch, side):
    monkeypatch.setattr(jaccard, "SIDE", side)
    r, texts = random.Random(5), [(0, None), (1, "  "), (2, "a b"), (3, "A  b")]
    while len(texts) < 240:
        if r.random() < 0.5 and len(texts) > 10:
            words = (r.choice(texts[4:])[1]).split()
            for _ in range(r.randint(0, max(1, len(words) // 12))):
                at = r.randrange(len(words))
                words[at : at + r.randint(0, 1)] = [f"v{r.randint(0, 9)}"]
        else:
            words = [f"v{r.randint(0, 300)}" for _ in range(r.choice([1, 3, 5, 9, 40, 120]))]
        texts.append((len(texts), " ".join(words)))
    rule = jaccard.Jaccard(80, 3)
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(5)
    got = {x["doc_id"]: (x["n_shingles"], x["component_id"]) for x in jaccard.jaccard_components(df, rule).collect()}
    assert got == brute_components(rule, texts)


def test_jaccard_edges(docs):
    got = {r["doc_id"]: r for r in queries.op6(docs).collect()}
    assert got[None]["n_shingles"] == 18 and got[5]["n_shingles"] == 0 and got[7]["component_id"] == 7
    assert got[2]["component_id"] == got[4]["component_id"] == got[3]["component_id"] == 1


def test_components_of_a_choice_made_twice(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)], "a long, b long")
    turned = links.select(F.when(F.rand() < 0.5, F.col("a")).otherwise(F.col("b")).alias("a"), F.lit(20).cast("long").alias("b"))
    assert components(links).select("component").distinct().count() == 1
    assert components(turned.unionByName(links)).select("component").distinct().count() == 1


def test_mix(spark, docs):
    out = queries.op7(docs).collect()
    assert sum(r["taken"] for r in out if r["doc_id"] in (5, 6, 7)) == 0 and all(0 <= r["taken"] <= 3 * r["size"] for r in out)
    r = random.Random(2)
    many = [(i, " ".join(["w"] * r.randint(1, 60)), None if i % 4 == 3 else f"s{i % 4}") for i in range(3000)]
    out = queries.op7(spark.createDataFrame(many, "doc_id long, text string, source string")).collect()
    again = queries.op7(spark.createDataFrame(many, "doc_id long, text string, source string").repartition(4)).collect()
    assert sorted(out) == sorted(again)
    by = {i: s for i, _, s in many}
    total = sum(len(t.split()) for _, t, _ in many)
    assert abs(sum({by[x["doc_id"]]: x["target"] for x in out}.values()) - total) < 1e-6 * total
    for source in set(by.values()):
        mine = [x for x in out if by[x["doc_id"]] == source]
        assert abs(sum(x["taken"] for x in mine) - mine[0]["target"]) <= 0.01 * mine[0]["target"]


@pytest.mark.parametrize(("weights", "wanted"), [((7, 13), 1400), ((7, 33), 700), ((11, 9), 2200), ((5, 3), 2500)])
def test_mix_beside_a_document_of_half_the_words(spark, weights, wanted):
    texts = [(i, "w " * 10, "a") for i in range(100)] + [(1000, "w " * 1000, "a")] + [(2000 + i, "w " * 10, "b") for i in range(200)]
    rows_ = mixing.mixed(spark.createDataFrame(texts, "doc_id long, text string, source string"), weights, carry=("doc_id", "source")).collect()
    for source in "ab":
        mine = [x for x in rows_ if x["row"]["source"] == source]
        assert abs(sum(x["size"] * x["copies"] for x in mine) - mine[0]["target"]) <= 10 and all(0 <= x["copies"] <= 3 for x in mine)
    assert {round(x["target"]) for x in rows_ if x["row"]["source"] == "a"} == {wanted}


def test_targets_stop_and_share(spark):
    df = spark.createDataFrame([("a", 10), ("b", 100), (None, 100)], "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.targets(df, (5, 2, 1), 3.0).collect()}
    assert got == {"a": 30.0, "b": 120.0, None: 60.0}


def test_url_rules(spark, tmp_path):
    urls = [None, "", "nothing", "http://A.Example.COM/en/x?q", "https://www.example.com/en/", "x://net/es/", "http://a.net/fr", "http://xnet/es/", "http://example.com", "http://com/#f", "http://a.com/e\nn"]
    df = spark.createDataFrame([(i, u, "v") for i, u in enumerate(urls)], "page_id long, url string, verdict string")
    got = [(r["host"], r["path"], r["rule"], r["verdict"]) for r in queries.op2(df).orderBy("page_id").collect()]
    assert got == [
        ("", "", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"), ("a.example.com", "/en/x", "example.com/en/", "block"),
        ("www.example.com", "/en/", "www.example.com/en/", "allow"), ("net", "/es/", "net/es/", "block"), ("a.net", "/fr", None, "allow"),
        ("xnet", "/es/", None, "allow"), ("example.com", "", None, "allow"), ("com", "/", "com/", "allow"), ("a.com", "/e\nn", "com/", "allow"),
    ]
    rules = [url_filter.UrlRule("block" if i % 2 else "allow", f"h{i}.org", "/") for i in range(200)]
    for hash_of in (xxhash.xxh64_intdigest, lambda b: xxhash.xxh64_intdigest(b) % 7):
        url_filter.write_index(rules, str(tmp_path / "i"), hash_of)
        index = url_filter.Index(str(tmp_path / "i"), hash_of)
        assert [index.text(e).decode() if e >= 0 else None for e in index.best([f"a.h{i}.org" for i in range(201)], ["/p"] * 201)] == [*(rule.text for rule in rules), None]


def test_bpe(spark, docs):
    path = public_tokenizers.path("word_bpe_49k.json")
    theirs, ours = Tokenizer.from_file(path), bpe.WordBpe(path)
    r = random.Random(1)
    texts = ["".join(r.choice("abcdefgh theringΣσéèß'sdllm123!?#\n\tİ\x00日") for _ in range(r.randint(0, 40))) for _ in range(800)]
    texts += ["a<|endoftext|>b <|startoftext|>", "", "ab" * 3000, "'ll don't 12 3", *(t or "" for _, t, *_ in ROWS)]
    for text, ids in zip(texts, ours.encode_all(texts), strict=True):
        want = theirs.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want
        assert ours.decode(ids) == theirs.decode(want, skip_special_tokens=False)
    for x in queries.op5(docs).collect():
        ids = theirs.encode(next(t for i, t, *_ in ROWS if i == x["doc_id"]) or "", add_special_tokens=False).ids
        assert x["n_tokens"] == len(ids) and x["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()


def test_language_model(spark):
    r = random.Random(3)
    texts = [(i, None if i == 0 else " ".join(r.choice(["the cat sat", "der hund lief", "A Cat"]) for _ in range(r.randint(0, 30))), 1.0) for i in range(300)]
    texts += [(None, "the cat", 0.0), (5, texts[5][1], 0.0)]
    out = maxent.scored(spark.createDataFrame(texts, "doc_id long, text string, score double")).collect()
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1
    split = lambda t: [*(t or "").lower().split(), ""]
    counts = collections.Counter(w for i, t, _ in texts if not held(i) for w in split(t))
    n, v = sum(counts.values()), len(counts)
    assert len(out) == len(texts) and all(x["train_tokens"] == n and x["held_out"] == held(x["doc_id"]) for x in out)
    for x in out:
        words = split(next(t for i, t, _ in texts if i == x["doc_id"]))
        base = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words)
        assert x["n_tokens"] == len(words) and x["n_known"] == sum(counts[w] > 0 for w in words) and x["base_score"] == pytest.approx(base)
    unseen = [x for x in out if x["held_out"]]
    assert sum(x["score"] for x in unseen) > sum(x["base_score"] for x in unseen)


def test_language_model_with_a_small_head(spark, monkeypatch):
    r = random.Random(4)
    texts = [(i, " ".join(r.choice([f"w{k}" for k in range(40)]) for _ in range(200))) for i in range(20)]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    columns = ("doc_id", "n_known", "base_score", "score")
    full = maxent.scored(df, rounds=1).select(*columns).orderBy("doc_id").collect()
    monkeypatch.setattr(maxent, "HEAD", 3)
    small = maxent.scored(df, rounds=1).select(*columns).orderBy("doc_id").collect()
    counts = collections.Counter(w for i, t in texts if zlib.crc32(str(i).encode()) % 5 != 1 for w in [*t.split(), ""])
    n, v = sum(counts.values()), len(counts)
    for got, want, (_, text) in zip(small, full, texts):
        words = [*text.split(), ""]
        assert got["n_known"] == want["n_known"] == sum(counts[w] > 0 for w in words)
        base = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words)
        assert got["base_score"] == pytest.approx(base) and want["base_score"] == pytest.approx(base)


def test_pages(spark):
    same = "<div>Home About Us Contact Products Services Blog Careers Help Press</div>"
    html = [None, "", "<p", "a<b>c</b> &lt; 5 &nbsp; x <!-- c"]
    html += ["<nav>n</nav><article><h1>T &amp; U</h1><p>x  y<script>'</p>'</script><p>z<div class='comments'>no</div></article><footer>f</footer>"] * 2
    html += [f"{same}<p>alpha{i} beta{i}</p><aside>s</aside><form>f</form><div id='cookie-notice'>c</div>" for i in range(4)]
    df = spark.createDataFrame([(i, "http://h/x" if i > 5 else None, h, "t") for i, h in enumerate(html)], "page_id long, url string, html string, text string")
    got = [(r["text"], r["n_chars"]) for r in queries.op4(df).orderBy("page_id").collect()]
    want = ["", "", "", "ac < 5 x", "T & U\nx y\nz", "T & U\nx y\nz", *(f"alpha{i} beta{i}" for i in range(4))]
    assert got == [(w, len(w)) for w in want]


@pytest.mark.parametrize("bin_pages", [2, 256])
def test_repeats_of_a_host_of_any_size(spark, monkeypatch, bin_pages):
    monkeypatch.setattr(html_text, "BIN_PAGES", bin_pages)
    notice = "<div>our office moves next week and phones may stay silent</div>"
    html = [f"{notice if i < 15 else ''}<p>alpha{i} beta{i}</p>" for i in range(250)]
    html += ["<p>one page that two urls of the host serve stays whole</p>"] * 2
    df = spark.createDataFrame([(i, "http://h/x", h) for i, h in enumerate(html)], "page_id long, url string, html string").repartition(6, "page_id")
    got = {r["page_id"]: r["text"] for r in html_text.extracted(df).collect()}
    assert got == {i: f"alpha{i} beta{i}" if i < 250 else "one page that two urls of the host serve stays whole" for i in range(252)}


def test_pages_with_articles(spark):
    body = "a long report that no article element holds but every reader wants to see in full"
    menu = "home news sport weather travel money culture science video contact"
    html = [
        f"<div>{body}</div><article>related story teaser</article>",
        "<div class='has-sidebar'><article>inside</article></div>",
        "<article class='no-sidebar'><p>named</p></article>",
        "<div class='sidebar'><p>gone</p></div><article>kept<div class='related'><h3>see also</h3>more</div><div class='share'>tweet</div></article>",
        f"<div>{menu}</div><article>one two three four five six seven eight nine ten eleven twelve</article>",
        f"<nav>{menu}</nav><article>nav</article>",
        f"<p>{menu}</p><p>alone here</p>",
        f"<article>text<div id='search'><h2>{menu}</h2>find</div></article>",
        "<div>open one</div><article>an article of more words than open blocks have</article>",
    ]
    df = spark.createDataFrame([(i, "http://h/x", h) for i, h in enumerate(html)], "page_id long, url string, html string").repartition(3)
    got = [r["text"] for r in html_text.extracted(df).orderBy("page_id").collect()]
    assert got == [
        f"{body}\nrelated story teaser", "inside", "named", "kept\nsee also\nmore", "one two three four five six seven eight nine ten eleven twelve",
        "nav", "alone here", "text\nfind", "an article of more words than open blocks have",
    ]


def test_licenses(docs):
    got = {r["doc_id"]: r for r in queries.op1(docs).collect()}
    assert got[13]["notices"] == "MIT; Apache-2.0" and got[13]["n_notices"] == 2 and got[13]["license"] == "Apache-2.0"
    assert got[5]["license"] is None and got[12]["coverage"] == 0.0
    scanner = licenses.Scanner(licenses.TEMPLATES)
    for name, text in licenses.TEMPLATES.items():
        assert [m[0] for m in scanner.scan(f"filler words {text.upper()} filler")] == [name]
        assert len(scanner.scan(f"{text} {text}")) == 2
    assert licenses.align("x a b c y".split(), "a q b c".split()) == [(1, 0), (2, 2), (3, 3)]


def test_reworded_and_whole_licenses():
    scanner = licenses.Scanner(licenses.TEMPLATES)
    found = lambda text: [m[0] for m in scanner.scan(f"some words before {text} and after")]
    assert found("Distributed under the MIT License") in (["MIT"], ["MIT notice"])
    assert found("Creative Commons Attribution-NonCommercial 4.0") == ["CC-BY-NC-4.0 name"]
    assert found("Licensed under CC BY-NC-SA 4.0") == ["CC-BY-NC-SA-4.0 notice"]
    assert found("This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License") == ["CC-BY-NC-4.0 sentence"]
    assert found("licensed under the Mozilla Public License v. 2.0") == ["MPL-2.0 notice"]
    assert found("licensed under the Apache License, Version 1.1") == [] and found("released under the new License") == []
    words = licenses.TEMPLATES["GPL-3.0 text"].split()
    assert found(" ".join(w for i, w in enumerate(words) if i % 20)) == ["GPL-3.0 text"]


def test_tokenized_like_the_library(docs):
    """The ids of whole texts, in frames of their own, with digests as the query has them."""
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    library.no_truncation()
    got = bpe.tokenized(docs, queries.WORD_BPE, carry=("doc_id", "text")).collect()
    plain = {(r["row"]["doc_id"], r["ids_sha256"], r["decoded_sha256"], r["n_tokens"]) for r in bpe.encoded(docs, queries.WORD_BPE).collect()}
    assert len(got) == len(ROWS) and {(r["row"]["doc_id"], r["ids_sha256"], r["decoded_sha256"], r["n_tokens"]) for r in got} == plain
    for r in got:
        assert r["ids"] == library.encode(r["row"]["text"] or "", add_special_tokens=False).ids


def test_pipeline(spark, docs, tmp_path):
    docs.select("doc_id", "text", "lang", "source", "n_chars").write.parquet(str(tmp_path / "documents.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    stay = {r["doc_id"] for r in out}
    assert stay <= {2, 11, 12, 13, None} and {2, 12} & stay, "rejected, equal and similar documents go"
    for r in out:
        assert len(r["ids"]) == r["n_tokens"] and hashlib.sha256(np.array(r["ids"], dtype="<u4").tobytes()).hexdigest() == r["ids_sha256"]
    table = docs.select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        table = stage(spark, table, "")
        assert set(table.columns) == {"doc_id", "text", "lang", "source", "n_chars"}


def test_blocks_take_time_with_the_length_of_a_page():
    inline = "<i>" * 12
    page = f"<nav><p>n{inline}</nav><p class='menu'>m{inline}<div>after</div>"
    assert html_text.blocks(page) == [("noise", "n"), ("noise", "m"), ("open", "after")]
    for page in ("<i>" * 150_000 + "</u>" * 150_000, "<i class='menu'>" * 40_000 + "<h1>t</h1>" * 20_000, "<div class='menu'>x<h2>y</h2>" * 20_000, "<p><i>" * 100_000):
        start = time.perf_counter()
        html_text.blocks(page + "z")
        assert time.perf_counter() - start < 10


REMARK = "<section id='comments'><h2>2 comments</h2><ol class='comment-list'><li class='comment'><article class='comment-body'><p>first!</p></article></ol></section>"


@pytest.mark.parametrize(
    "page, text",
    [
        (f"<article><p>story</p>{REMARK}</article>", "story"),
        (f"<main><article><p>story</p></article>{REMARK}<article class='comment'>me too</article></main>", "story"),
        ("<article>story</article><article class='related teaser'>other story</article>", "story"),
        ("<main>story<article class='related teaser'>other story</article></main>", "story"),
        ("<article>story<div class='share'><article>other story</article></div></article>", "story"),
        ("<main><div class='has-sidebar'><article>story</article></div></main>", "story"),
        ("<h1>Title</h1><p>story of six or more plain words</p><div class='cookie-notice'><h2>Cookies</h2>we use them</div>", "Title\nstory of six or more plain words"),
        ("<p>story</p><div class='sidebar'><h3>About</h3>us</div>", "story"),
        ("<div class='page has-sidebar'><h2>Title</h2><p>story</p></div>", "Title\nstory"),
        ("<div class='menu'><h1>Title</h1><p>story</p></div>", "Title\nstory"),
        ("<p>story</p><div class='has-sidebar'><div class='sidebar'><h3>About</h3>us</div></div>", "story"),
        ("<article>story<p class='ad'>buy</p><div class='siteFooter'>imprint</div><ul class='share-buttons'><li>tweet</ul></article>", "story"),
        *(
            (f"<article>story<p class='{name}'>paragraph</p></article>", "story\nparagraph")
            for name in ("share-price", "search-results", "related-work", "promotion-result", "ad-hoc", "menu-of-the-day", "reply", "copyright")
        ),
        ("<p class='share-price'>story</p>", "story"),
        ("<article class='post comments-open'>story</article>", "story"),
    ],
)
def test_names_of_elements(page, text):
    found = html_text.blocks(page)
    settled = html_text.settled(found)
    if settled is None:
        roles, texts = zip(*found)
        settled = html_text.unrepeated(roles, texts, np.zeros(1000, dtype=bool))
    assert settled == text


def test_doubtful_names_within_articles_are_settled_by_repeats(spark):
    offer = "<p class='share-offer'>tell all of your friends about this page and win a prize</p>"
    html = [f"<article>story {i}{offer if i < 2 else ''}<p class='share-price'>price {i} fell</p></article>" for i in range(3)]
    df = spark.createDataFrame([(i, "http://h/x", h) for i, h in enumerate(html)], "page_id long, url string, html string")
    got = [r["text"] for r in queries.op4(df).orderBy("page_id").collect()]
    assert got == [f"story {i}\nprice {i} fell" for i in range(3)]


def test_fringes_of_runs_stay():
    def text(roles, blocks, run):
        tokens = " ".join(blocks).split()
        start = next(i for i in range(len(tokens)) if tokens[i : i + len(run.split())] == run.split())
        covered = np.zeros(len(tokens), dtype=bool)
        covered[start : start + len(run.split())] = True
        return html_text.unrepeated(roles, blocks, covered)

    offer = "one two three four five six seven eight"
    assert text(["doubt", "doubt"], [offer, "price fell"], offer + " price") == "price fell"
    assert text(["doubt"], [f"a {offer} b"], offer) == "a b"
    assert text(["open"] * 3, ["Home About", "Us Contact Help", "the story begins here"], "Home About Us Contact Help the story") == "the story begins here"


def test_shards_against_prefix_sums(spark):
    r = random.Random(5)
    sizes = [(i, r.choice([1, 7, 50, 50, 3000 if i % 90 == 0 else 9])) for i in r.sample(range(5000), 900)] + [(5001, 40000)]
    out = sharding.shard_by_bytes(spark.createDataFrame(sizes, "id long, bytes long").repartition(7), F.col("bytes"), 8, order=("id",)).collect()
    total, start, want, slots = sum(s for _, s in sizes), 0, set(), collections.Counter()
    for i, size in sorted(sizes):
        shard = start * 8 // total
        want.add((i, size, start, shard, slots[shard]))
        slots[shard] += 1
        start += size
    assert {(x["row"]["id"], x["size"], x["start"], x["shard"], x["slot"]) for x in out} == want and len(out) == len(want)


def test_tilts_against_bisection(spark):
    r = random.Random(6)
    table = [(s, r.randint(1, 400) if s != "even" else 20, r.randint(1, 9)) for s in ("a", "b", None) for _ in range(40)] + [("even", 20, 50)]
    cells = spark.createDataFrame(table, "source string, size long, n long").groupBy("source", "size").agg(F.sum("n").alias("n"))
    sizes = {s: sum(x * n for t, x, n in table if t == s) for s in ("a", "b", None, "even")}
    wanted = {"a": 0.3, "b": 2.9, None: 1.0, "even": 2.0}
    goals = spark.createDataFrame([(s, sizes[s], wanted[s] * sizes[s]) for s in sizes], "source string, source_size long, target double")
    for row in mixing.tilts(cells, goals, 3.0).collect():
        mine = [(x, n) for s, x, n in table if s == row["source"]]
        mean = sum(x * n for x, n in mine) / sum(n for _, n in mine)
        low, high = -1000.0, 1000.0
        for _ in range(200):
            tilt = (low + high) / 2
            words = sum(x * n * math.exp(min(tilt * x / mean, math.log(3))) for x, n in mine)
            low, high = (low, tilt) if words > row["target"] else (tilt, high)
        assert row["tilt"] == pytest.approx(low, rel=1e-4, abs=1e-6), row["source"]
    with pytest.raises(RuntimeError, match="no mix"):
        mixing.tilts(cells, goals, 3.0, rounds=1)


@pytest.mark.parametrize("table", [[(1, "a b", "s"), (2, "c", "s")], [(1, "", "s"), (2, None, None)], [(1, "a b", "s"), (1, "a b", "s"), (2, " ", "s"), (3, None, "t")]])
def test_mix_of_few_words(spark, table):
    out = mixing.mixed(spark.createDataFrame(table, "doc_id long, text string, source string"), carry=("doc_id",)).collect()
    assert collections.Counter(x["row"]["doc_id"] for x in out) == collections.Counter(i for i, *_ in table)
    total = sum(len((t or "").split()) for _, t, _ in table)
    assert sum(x["size"] * x["copies"] for x in out) == total and all(x["copies"] == 0 for x in out if x["size"] == 0)


def test_one_of_repeated_rows_stays_whatever_their_order(spark):
    table = [(1, BASE, f"l{i}", {"k": i}) for i in range(10)] + [(2, BASE, "z", {})]
    kept = set()
    for order in (table, table[::-1], table[5:] + table[:5]):
        df = spark.createDataFrame(order, "doc_id long, text string, lang string, extra map<string,int>").repartition(4)
        kept |= {r["lang"] for r in exact_dedup.keep_one(df).collect()}
    assert len(kept) == 1


def _common_words(a, b):
    last = [0] * (len(b) + 1)
    for x in a:
        now = [0]
        for j, y in enumerate(b):
            now.append(last[j] + 1 if x == y else max(last[j + 1], now[j]))
        last = now
    return last[-1]


def test_licenses_against_longest_common_subsequences():
    """Every notice planted with up to 5 percent of its words lacking is found, and what is found matches that many words."""
    r = random.Random(7)
    scanner = licenses.Scanner(licenses.TEMPLATES)
    size = dict(zip(scanner.names, scanner.words))
    names = [n for n in scanner.names if len(size[n]) < 400]
    for trial in range(120):
        name = names[trial % len(names)]
        words = [w.decode() for w in size[name]]
        if len(words) >= licenses.SHORT:
            for k in sorted(r.sample(range(len(words)), len(words) // 20), reverse=True):
                del words[k]
        before, after = ([f"zz{r.randint(0, 50)}" for _ in range(r.randint(0, 80))] for _ in range(2))
        whole = licenses.license_words(" ".join(before + words + after))
        found = scanner.scan(" ".join(before + words + after))
        assert [m[0] for m in found] == [name]
        for kind, coverage, first, last in found:
            matched = round(coverage * len(size[kind]))
            assert matched <= _common_words(whole[first : last + 1], size[kind]) and coverage >= 0.75
            assert len(before) <= first <= last < len(before) + len(words)


def test_license_with_most_words_and_short_forms(spark):
    words = licenses.TEMPLATES["GPL-3.0 text"].split()
    text = " ".join(words[:40] + words[41:90] + words[91:]) + "\nLicensed under CC BY 4.0"
    texts = [text, "SPDX-License-Identifier: MIT", "under the Apache-2.0 license, free", "code licensed under GPLv3", "// SPDX-License-Identifier: GPL-2.0", "Apache 2.0"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = [r["license"] for r in queries.op1(df).orderBy("doc_id").collect()]
    assert got == ["GPL-3.0 text", "MIT tag", "Apache-2.0 short", "GPL-3.0 short", None, None]
