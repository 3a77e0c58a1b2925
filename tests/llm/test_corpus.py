"""Corpus operators against brute force, round trips and held-out rows, and on awkward rows."""

import hashlib
import html
import random
import re
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
from check import compare, connect
from pyspark.sql import functions as F

import __spark_entry__ as contract
from salesline.llm import (
    components, decontaminate, extract, jaccard, langid, negatives, periods, perspectives, sentencepieces, shards, suffixes, topk, toxicity, warc,
)
from salesline.llm import plans as llm_plans

SF = "/root/testdata/sf0.01"
MODEL = public_tokenizers.path("piece_bpe_32k.model")
LONG = "lorem ipsum dolor " * 20_000
AWKWARD = [
    (1, None, "x"), (2, "", "x"), (3, "   \n\t ", "x"), (4, "a", None), (None, "no id at all but some words here", "x"),
    (5, "zwei gleiche Zeilen " * 12, "x"), (5, "zwei gleiche Zeilen " * 12, "x"), (6, LONG, "x"), (7, "<s> ▁ \u0000 日本語 🙂", "x"),
]


def frame(spark, rows, schema="doc_id long, text string, hits string"):
    return spark.createDataFrame(rows, schema)


def rows_of(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


@pytest.mark.parametrize("name", sorted(llm_plans.SQL))
def test_matches_sql(spark, name):
    result = compare(llm_plans.QUERIES[name](spark, SF).toPandas(), connect(SF).execute(llm_plans.SQL[name]).df())
    assert result.startswith("ok"), result


def test_registered():
    ops = {q.split("_")[0] for q in contract.queries() if q.startswith("op")}
    assert ops == {f"op{n}" for n in range(1, 14)} and "pipeline" in contract.queries()


# 1 toxicity


def char_model():
    words = "you are an idiot and a loser stupid clown that is the moron with worthless trash of all people here ".split()
    rng = random.Random(3)
    return toxicity.CharModel(toxicity.trigram_counts([" ".join(rng.choices(words, k=4000))]))


@pytest.mark.parametrize(
    "read, meant",
    [("an 1d10t", "an idiot"), ("l.o.s.e.r", "loser"), ("c l o w n", "clown"), ("stuuuupid", "stupid"), ("$tup1d!", "stupid!"), ("m0r0n", "moron"),
     ("", ""), (None, ""), ("plain text, 12 words.", "plain text, 12 words.")],
)
def test_restores(read, meant):
    assert toxicity.Restorer(char_model()).restore([read]) == [meant]


def test_stretches_lose_no_span():
    rng, model = random.Random(5), char_model()
    texts = ["".join(rng.choices("ab 1$.e\noo!", k=rng.randint(0, 60))) for _ in range(300)]
    restorer = toxicity.Restorer(model)
    assert restorer.restore(texts) == [toxicity.SPAN.sub(restorer._one, t.lower()) for t in texts]


def test_viterbi_is_the_best_path():
    model = char_model()

    def cost(options):  # every choice for "1d10t"
        best = None
        for a in "il1":
            for b in "il1":
                for c in "o0":
                    text = f"{a}d{b}{c}t"
                    total = sum(toxicity.COST_KEEP if x in "10" else toxicity.COST_SIGN for x in (a, b, c))
                    s = [0, 0, *map(toxicity.symbol, text), 0]
                    total += sum(model.costs[s[i]][s[i + 1]][s[i + 2]] for i in range(len(s) - 2))
                    best = min(best or (total, text), (total, text))
        return best[1]

    assert model.decode("1d10t") == cost(None)


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    scored = llm_plans.QUERIES["op1_restored_toxicity"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out")
    n = {(r.toxic, r.predicted): r.n for r in scored.groupBy("toxic", "predicted").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert n[1, 1] / (n[1, 1] + n.get((1, 0), 0)) > 0.7 and n.get((0, 1), 0) / n[0, 0] < 0.01


def test_toxicity_awkward(spark):
    model, terms = toxicity.fit(frame(spark, []), spark.createDataFrame([], "doc_id long, toxic int"))
    found = toxicity.score_toxicity(frame(spark, AWKWARD), model, terms, keep_restored=True).collect()
    assert len(found) == len(AWKWARD) and {r.toxicity for r in found} == {0.5}


# 2 suffixes


def naive_order(s):
    ends, n = [0] * len(s), len(s)
    for i in range(len(s) - 1, -1, -1):
        n = i if s[i] == 0 else n
        ends[i] = n
    return sorted(range(len(s)), key=lambda i: ([*s[i : ends[i]], 0], ends[i]))


def test_linear_grouping():
    rng = random.Random(1)
    for _ in range(2000):
        s = [rng.randint(0, rng.choice([1, 2, 5])) for _ in range(rng.randint(0, 30))] + [0]
        assert suffixes.suffix_order(s) == naive_order(s), s


def brute_cut(texts):
    seen, out = set(), []
    for t in texts:
        raw = (t or "").encode()
        gone = np.zeros(len(raw) + 1, int)
        for a in range(len(raw) - 99):
            if raw[a : a + 100] in seen:
                gone[a] += 1
                gone[a + 100] -= 1
            seen.add(raw[a : a + 100])
        hit = np.cumsum(gone)[: len(raw)] > 0
        spans = int(((np.diff(np.concatenate(([0], hit.astype(int))))) == 1).sum())
        out.append((len(raw), int(hit.sum()), spans, hashlib.sha256(np.frombuffer(raw, np.uint8)[~hit].tobytes()).hexdigest()))
    return out


def repetitive_texts(rng, n):
    shared = ["".join(rng.choices("abcdé ", k=rng.randint(80, 400))) for _ in range(6)]
    texts = []
    for _ in range(n):
        t = "".join(rng.choice([rng.choice(shared), "".join(rng.choices("abcxyz ", k=rng.randint(1, 150)))]) for _ in range(rng.randint(1, 5)))
        i = rng.randrange(len(t))
        texts.append(rng.choice([t, t[:i] + "#" + t[i + 1 :], t * 2, "a" * 250, "ab" * 130, ""]))
    return texts


@pytest.mark.parametrize("hot", [suffixes.HOT, 1])
def test_cut_repeats(spark, monkeypatch, hot):
    monkeypatch.setattr(suffixes, "HOT", hot)
    monkeypatch.setattr(suffixes, "FLUSH", 20)
    monkeypatch.setattr(suffixes, "CHUNK", 150)  # also cuts single texts into pieces
    texts = repetitive_texts(random.Random(hot), 120)
    cut = suffixes.cut_repeats(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3))
    assert [r[1:] for r in rows_of(suffixes.digest(cut), "doc_id")] == brute_cut(texts)


def test_cut_repeats_awkward(spark):
    docs = frame(spark, AWKWARD)
    found = suffixes.digest(suffixes.cut_repeats(docs.withColumnRenamed("hits", "_DOC"))).collect()
    order = sorted(AWKWARD, key=lambda r: (r[0] is None, r[0] or 0))
    want = sorted(zip([r[0] for r in order], brute_cut([r[1] for r in order]), strict=True), key=str)
    assert sorted([(r.doc_id, (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)) for r in found], key=str) == want
    assert suffixes.cut_repeats(frame(spark, [])).count() == 0


def test_cut_texts_replaced_in_the_same_pass(spark):
    shared = "".join(f"é{i} " for i in range(60))
    texts = {1: shared, 2: f"日本 {shared} 🙂", 3: None, 4: "", 5: "alone �", 6: "ĩ" + shared[1:]}
    docs = spark.createDataFrame([*texts.items()], "doc_id long, text string").repartition(3)
    plain = {r.doc_id: r for r in suffixes.cut_repeats(docs).collect()}
    found = suffixes.cut_repeats(docs, replace=True)
    assert found.columns == suffixes.cut_repeats(docs).columns
    for r in found.collect():
        p = plain[r.doc_id]
        assert p.text == texts[r.doc_id] and (r.kept, r.n_removed, r.n_spans) == (p.kept, p.n_removed, p.n_spans)
        assert r.text == (bytes(r.kept).decode("utf-8", "ignore") if r.n_removed else texts[r.doc_id])
    assert {d for d, p in plain.items() if p.n_removed} == {2, 6} and plain[6].kept.decode("utf-8", "ignore") != plain[6].kept.decode("utf-8", "replace")


def python_passes(plan):
    """The most MapInArrow that follow each other in a plan without an exchange: a task has a Python worker for each."""
    most, above = 0, []
    for line in plan.splitlines():
        if name := re.search(r"[A-Za-z]", line):
            above = [x for x in above if x[0] < name.start()]
            passes = above[-1][1] if above else 0
            node = re.sub(r"^\*?\(\d+\) ", "", line[name.start() :])
            above.append((name.start(), 0 if "Exchange" in node.split()[0] else passes + node.startswith("MapInArrow")))
            most = max(most, above[-1][1])
    return most


def test_suffix_stage_runs_one_python_worker_a_task(spark, capsys):
    import corpus_pipeline as p

    text = " ".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame([(1, text, "en", "s", 9), (2, f"own {text}", "en", "s", 9)], "doc_id long, text string, lang string, source string, n_chars long")
    out = p.suffix_dedup(spark, docs, SF)
    out.explain()
    assert python_passes(capsys.readouterr().out) == 1
    got = {r.doc_id: r.text for r in out.collect()}
    assert got == {1: text, 2: "own "} or got == {1: text, 2: "own"}


# 3 search


def test_top_k(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in np.round(rng.normal(0, 0.4, 8), 2)]) for i in range(300)]
    rows += [(300 + i, rows[7][1]) for i in range(40)] + [(400, None), (401, [float("nan")] * 8), (402, [1.0]), (403, []), (None, rows[0][1]), (7, rows[7][1])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = rows_of(topk.top_k(vectors, vectors.where("vec_id % 50 = 0"), query_block=3), "query_id", "rank")
    good = [(i, np.floor(256 * np.array(np.float32(x), np.float64)).astype(int)) for i, x in rows if i is not None and x is not None and np.isfinite(x).all()]
    want = []
    for q, x in good:
        if q % 50 == 0:
            scores = sorted((-int(x @ y), i) for i, y in good if i != q and len(x) == len(y))
            want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:5])]
    assert got == sorted(want)
    assert topk.top_k(vectors.where("false"), vectors.where("false")).count() == 0


# 4 pages


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header>Head</header><nav><ul><li><a href=x>Home</a><li>News</ul></nav><div class="cookie-notice">We use cookies</div>
%s<aside>Side</aside><form><p>Name</p></form><div id="comments"><p>first!</p></div><footer>&copy; me</footer></body></html>"""


def test_extracts_article(spark):
    body = "<article><h1>A &amp; B</h1><p><b>One\n two&nbsp;<br>three<p>Four<!-- no --> <i>five</i></p><div class=ad>Buy</div></article>"
    open_page = '<div><p>%s</p><p>Read all our terms and conditions before you go</p></div>'
    pages = [(1, "http://h.org/1", PAGE % body), (2, "http://h.org/2", PAGE % (open_page % "One thing is only said by the second page itself")), (3, "http://h.org/3", PAGE % (open_page % "Other words fill a third page which nobody has used")),
             (4, None, None), (5, "::", "text <b>only"), (6, "http://h.org/6", "<article>cut o")]
    for shard in (500, 1):  # one shard, and one page per shard
        got = {r.page_id: r.text for r in extract.extract_main_text(spark.createDataFrame(pages, "page_id long, url string, html string"), shard_pages=shard).collect()}
        assert got[1] == "A & B\nOne two three\nFour five"
        assert got[2] == "One thing is only said by the second page itself"
        assert (got[4], got[5], got[6]) == ("", "text only", "cut o")
    assert extract.extract_main_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


@pytest.mark.parametrize("shard", [500, 1])
def test_extract_keeps_what_few_pages_repeat(spark, shard):
    rng = random.Random(11)
    own = lambda: " ".join(f"w{rng.randrange(10**6)}" for _ in range(12))
    plain = [(i, f"<p>{own()}</p>", "") for i in range(12)]
    quote, headline, footer = own(), own(), own()
    plain[0], plain[1] = ((i, f"{b}<p>{quote}</p>", n) for i, b, n in plain[:2])  # two pages quote the same
    plain[2], plain[3] = (2, f"<h1>{headline}</h1>{plain[2][1]}", ""), (3, plain[3][1], headline)  # in another page's menu
    plain += [(12, plain[4][1], ""), (13, plain[4][1], "")]  # copies
    plain.append((14, "<article><p>short lead</p></article><p>the rest stands outside of it</p>", ""))
    rows = [(i, f"http://q.org/{i}", f"<body><nav>{n}</nav>{b}<div>{footer}</div></body>") for i, b, n in plain]
    twins = [(100 + i, f"http://t.org/{i}", f"<body><p>{own() if i == 2 else quote}</p></body>") for i in range(3)]
    pages = spark.createDataFrame(rows + twins, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in extract.extract_main_text(pages, shard_pages=shard).collect()}
    for i, body, _ in plain:
        assert got[i] == "\n".join(re.findall(r"<(?:p|h1)>(.*?)</", body)), i
    assert got[100] == got[101] == quote and got[102]


@pytest.mark.parametrize(
    "body, text",
    [('<div class="content has-sidebar"><p>The whole text.</p></div>', "The whole text."),
     ('<div id="main" class="layout-no-sidebar"><article><p>All of it.</p></article></div>', "All of it."),
     ('<article><div class="entry-header"><h1>Headline</h1></div><p>Body.</p></article>', "Headline\nBody."),
     ('<p class="share-price">Ten pounds.</p>', "Ten pounds."),
     ('<div class="sidebar wide"><article><p>Kept below a name.</p></article></div>', "Kept below a name."),
     ('<div class="site-footer"><p>Gone.</p></div><p>Stays.</p>', "Stays."),
     ('<section class="comments-list"><article><p>first!</p></article></section><p>Stays.</p>', "Stays."),
     ('<aside><article><p>Other news</p></article></aside><div id="main-content"><p>Main.</p></div>', "Main.")],
)
def test_names_are_whole_tokens(body, text):
    blocks = extract.page_blocks(f"<html><body>{body}</body></html>")
    kept = [t for k, t in blocks if k == "article"] or [t for k, t in blocks if k == "other"]
    assert "\n".join(kept) == text


def test_dealing_changes_no_page(spark):
    rng = random.Random(4)
    rows = []
    for host, n in (("a", 90), ("b", 25), ("c", 3), ("d", 1)):
        shared = [" ".join(f"{host}{rng.randrange(60)}" for _ in range(rng.randrange(5, 14))) for _ in range(14)]
        for i in range(n):
            body = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(9)), *rng.sample(shared, rng.randrange(0, 9))]
            nav = rng.choice(shared)
            rows.append((len(rows), f"http://{host}/{i}", f"<nav>{nav}</nav>" + "".join(f"<p>{t}</p>" for t in rng.sample(body, len(body)))))
        rows += [(len(rows) + k, f"http://{host}/copy{k}", rows[-1][2]) for k in range(4)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = [rows_of(extract.extract_main_text(pages, shard_pages=k), "page_id") for k in (1, 20, 500)]
    assert got[0] == got[1] == got[2] and sum(r[4] > 0 for r in got[0]) > 60
    # brute force: a window of six tokens is boilerplate if enough contents of its host have it
    parsed = {i: ([(k, t) for k, t in extract.page_blocks(h)], u.split("/")[2]) for i, u, h in rows}
    seen: dict = {}
    for blocks, host in parsed.values():
        tokens = [(w, k == "dropped") for k, t in blocks for w in t.split(" ")]
        content = "\n".join(t for k, t in blocks if k != "dropped")
        seen.setdefault(host, {}).setdefault(None, set()).add(content)
        for j in range(len(tokens) - 5):
            seen[host].setdefault(tuple(tokens[j : j + 6]), set()).add(content)
    for i, (blocks, host) in parsed.items():
        tokens = [(w, k == "dropped") for k, t in blocks for w in t.split(" ")]
        need, cover = extract.needed(len(seen[host][None])), set()
        for j in range(len(tokens) - 5):
            if len(seen[host][tuple(tokens[j : j + 6])]) >= need:
                cover |= set(range(j, j + 6))
        kept, at = [], 0
        for k, t in blocks:
            n = len(t.split(" "))
            hit = sum(j in cover for j in range(at, at + n))
            if k == "other" and not (hit and hit >= extract.COVERED * n):
                kept.append(t)
            at += n
        assert got[0][i][2] == "\n".join(kept or [t for k, t in blocks if k == "other"]) and got[0][i][4] == len(cover)


def test_extracts_all_articles(spark):
    got = {r.page_id: r.text for r in llm_plans.QUERIES["op4_host_extract"](spark, SF).collect()}
    for r in spark.read.parquet(f"{SF}/pages.parquet").collect():
        inner = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        parts = [" ".join(html.unescape(re.sub(r"<[^>]+>", "", x)).split()) for x in re.split(r"</?(?:p|h1|h2|li|ul|div)\b[^>]*>", inner)]
        assert got[r.page_id] == "\n".join(x for x in parts if x)


def test_suffix_array_and_repeats():
    rng = np.random.default_rng(4)
    for _ in range(100):
        stream = rng.integers(0, 3, rng.integers(1, 40)).astype(np.uint64)
        page = np.sort(rng.integers(0, 4, len(stream)))
        assert extract.suffix_array(stream).tolist() == sorted(range(len(stream)), key=lambda i: stream[i:].tolist())
        at = {}
        for i in range(len(stream) - 2):
            if page[i] == page[i + 2]:
                at.setdefault(tuple(stream[i : i + 3]), set()).add(page[i])
        want = [i + 3 <= len(stream) and page[i] == page[min(i + 2, len(stream) - 1)] and len(at.get(tuple(stream[i : i + 3]), ())) > 1 for i in range(len(stream))]
        assert extract.repeated_starts(stream, page, 3).tolist() == want


# 5 languages


def test_languages_held_out(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = llm_plans.QUERIES["op5_language_filters"](spark, SF).join(docs, "doc_id").where("held_out")
    assert found.where("lang_pred = lang").count() >= 0.98 * found.count()


def test_rare_languages_are_learned(spark):
    rows = [(i, f"common words number {i}", "aa") for i in range(3000)] + [(-1 - i, "zeldzame taal hier", "zz") for i in range(2)]
    model = langid.fit_languages(spark.createDataFrame(rows, "doc_id long, text string, lang string"), rows=20)
    assert model.languages == ["aa", "zz"] and model.score(["zeldzame taal"])[0] == ["zz"]
    assert langid.quota([2, 50, 3000, 9000], 1052) == 500 and langid.quota([5, 6], 20) == float("inf")


def test_languages_awkward(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.fit_languages(docs)
    found = langid.identify(frame(spark, AWKWARD).withColumnRenamed("hits", "lang_pred"), model).collect()
    assert len(found) == len(AWKWARD)
    assert all((r.lang_pred == "und") == (not any(c.isalpha() for c in r.text or "")) for r in found)
    none = langid.fit_languages(docs.where("false"))
    assert {r.lang_pred for r in langid.identify(frame(spark, AWKWARD), none).collect()} == {"und"}


def test_false_positives_are_corrected():
    masks = np.zeros((1 << 8, 1), np.uint64)
    masks[::2] = 1  # half of all positions are set without any n-gram
    model = langid.LanguageFilters(["xx"], 4, 8, 1, masks, np.array([0.5]))
    _, _, cover = model.score(["".join(random.Random(1).choices("abcdefgh", k=5000))])
    assert cover[0] < 0.05


# 6 dialogues


def test_perspectives(spark):
    turns = [(1, 0, "system", "be kind"), (1, 1, "ann", "hi"), (1, 2, "bob <|", "yo <|end|>"), (1, 3, None, None), (2, 0, "system", "alone"), (None, 0, "cy", "x")]
    got = perspectives.rotate_perspectives(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")).collect()
    assert len(got) == 4 * 3 + 1
    ann = sorted((r.turn, r.segment, r.trained) for r in got if r.conv_id == 1 and r.perspective == "ann")
    assert ann == [
        (0, "<|system|>\nbe kind<|end|>\n", False), (1, "<|assistant|>\nhi<|end|>\n", True),
        (2, "<|user name=bob __|>\nyo <\\|end|><|end|>\n", False), (3, "<|user name=|>\n<|end|>\n", False),
    ]
    for r in got:
        assert r.segment[r.mask_start : r.mask_end] == (r.segment.split("\n", 1)[1] if r.trained else "")


# 7 pieces


def test_pieces_match_the_library(spark):
    found = sentencepieces.encode_decode(frame(spark, AWKWARD).withColumnRenamed("hits", "ids"), MODEL).collect()
    library = sentencepieces.Vocabulary(MODEL).library
    assert len(found) == len(AWKWARD)
    for r in found:
        assert list(r.ids) == library.encode(r.text or "", add_eos=True)
        assert r.decoded == library.decode(list(r.ids))


def test_workers_collect_garbage_after_encoding(spark):
    import gc

    def collects(batches):
        import gc

        import pyarrow as pa

        for b in batches:
            yield b.set_column(0, "id", pa.array([int(gc.isenabled())] * b.num_rows, pa.int64()))

    docs = spark.range(64).selectExpr("id as doc_id", "concat('text ', id) as text").repartition(16)
    assert sentencepieces.encode_decode(docs, MODEL).count() == 64
    assert spark.range(0, 64, 1, 16).mapInArrow(collects, "id long").where("id = 0").count() == 0 and gc.isenabled()


def test_agenda_on_random_text():
    encoder, rng = sentencepieces.Encoder(MODEL), random.Random(6)
    texts = ["".join(rng.choices("abcdefghinorst  ▁\n.é日🙂0", k=rng.randint(0, 80))) for _ in range(1000)]
    library = encoder.vocabulary.library
    for text, units in zip(texts, encoder.batch(texts), strict=True):
        assert " ".join(u[0] for u in units) == " ".join(map(str, library.encode(text)))
        assert "".join(u[2] for u in units).removeprefix(" ") == library.decode(library.encode(text))


def test_wrong_ids_are_reported():
    vocabulary = sentencepieces.Vocabulary(MODEL)
    with pytest.raises(ValueError):
        vocabulary.compare(["▁the"], [[5]])


# 8 contamination


def brute_hits(text, items, n=10):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    hit, found = set(), set()
    for item, t in items:
        own = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        size = min(n, len(own))
        windows = {tuple(own[i : i + size]) for i in range(len(own) - size + 1)} if size else set()
        for i in range(len(words) - size + 1):
            if size and tuple(words[i : i + size]) in windows:
                hit.update(range(i, i + size))
                found.add(str(item))
    return len(words), len(hit), sorted(found)


@pytest.mark.parametrize("item_bytes", [1 << 20, 60])
def test_contamination(spark, item_bytes):
    rng = random.Random(8)
    items = [(i, " ".join(rng.choices("ab Cd é 9 x-y".split(), k=rng.randint(0, 14)))) for i in range(12)] + [(99, None), (3, "Ab, cd")]
    texts = [" ".join(rng.choices("AB cd É 9 x".split(), k=rng.randint(0, 30)) + [rng.choice(items)[1] or ""]) for _ in range(60)]
    docs = frame(spark, [(100 + i, t, "") for i, t in enumerate(texts)] + AWKWARD)
    found = decontaminate.find_contamination(docs, spark.createDataFrame(items, "item_id long, text string"), item_bytes=item_bytes)
    for r in decontaminate.digest(found).join(docs.select("doc_id", "text").distinct(), "doc_id").collect():
        n, hit, names = brute_hits(r.text, items)
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256) == (n, hit, len(names), hashlib.sha256(",".join(names).encode()).hexdigest())
    left = decontaminate.find_contamination(decontaminate.remove_spans(found).drop("hits"), spark.createDataFrame([], "item_id long, text string"))
    assert left.where("size(hits.runs) > 0").count() == 0 and left.count() == docs.count()


# 9 archives


def test_archives(spark):
    big = "<p>" + "x" * 200
    pages = [(3, "http://a.org/x", big), (2, "http://b.a.org:8080/y?z=1#f", big), (9, None, big), (4, "http://a.org/x", None), (5, "no url", "small"),
             (6, "http://a.org/\r\nx", "small"), (None, "http://n.org", big), (2, "http://b.a.org:8080/y?z=1#f", big), (7, "", "WARC/1.1\r\n\r\n" * 20)]
    got = {(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.archive_and_read(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    digest = lambda x: hashlib.sha256((x or "").encode()).hexdigest()
    want = {(i, len(h or ""), digest(h), "revisit" if h == big and i != 2 else "response", 2 if h == big and i != 2 else None) for i, _, h in pages}
    assert got == want
    assert warc.archive_and_read(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_index_lookup(spark, tmp_path):
    rows = [(f"org,a)/{i % 40:03d}", i, "f", i * 10, 10) for i in range(400)]
    warc.build_index(spark.createDataFrame(rows, "surt string, page_id long, file string, offset long, length long"), str(tmp_path / "i"), lines=7)
    wanted = spark.createDataFrame([("org,a)/003",), ("org,a)/039",), ("none",), ("",)], "surt string")
    for size in (3, 1000):  # the directory in many parts, and in one
        got = rows_of(warc.lookup(spark, str(tmp_path / "i"), wanted, directory_rows=size), "page_id")
        assert got == sorted((r for r in rows if r[0] in ("org,a)/003", "org,a)/039")), key=lambda r: r[1])


def test_reversed_host():
    assert warc.reversed_host_key("https://M.b.Com:81/x?y#z") == "com,b,m:81)/x?y"
    assert [warc.reversed_host_key(x) for x in (None, "", "no url", "http://[")] == ["", "", "no url", "http://["]


# 10 similarity


def brute_groups(rows):
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[i : i + 4]) for i in range(len(w) - 3)} if len(w) > 3 else {tuple(w)} if w else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 85 * len(a | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted([(d, len(s), least.get(find(i))) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))], key=str)


@pytest.mark.parametrize("flush", [jaccard.FLUSH, 50])
def test_similar_groups(spark, monkeypatch, flush):
    monkeypatch.setattr(jaccard, "FLUSH", flush)
    rng, texts = random.Random(flush), []
    passage = [f"p{i}" for i in range(40)]
    for _ in range(25):
        words = [f"w{rng.randrange(3000)}" for _ in range(rng.choice([1, 3, 5, 9, 20, 60, 200]))] + rng.choice([[], passage])
        for _ in range(rng.randint(1, 8)):
            edited = list(words)
            for _ in range(rng.randint(0, 1 + len(words) // 30)):
                i = rng.randrange(len(edited))
                edited[i : i + 1] = rng.choice([[], ["new"], [edited[i], "in"]])
                edited = edited or ["x"]
            texts.append(" ".join(edited))
    rows = [(i, t) for i, t in enumerate(texts)] + [r[:2] for r in AWKWARD]
    got = jaccard.similar_groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    assert sorted([tuple(r) for r in got.collect()], key=str) == brute_groups(rows)


def test_similar_groups_empty(spark):
    assert jaccard.similar_groups(frame(spark, [])).count() == 0


def test_every_similar_pair_shares_an_active_subset():
    rng, bands = np.random.default_rng(9), jaccard.Bands(85)
    sketch = np.zeros(jaccard.SKETCH, np.int64)
    for n in (7, 8, 13, 14, 27, 28, 100, 400):
        for _ in range(60):
            a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64) * np.uint64(2))
            gone = rng.integers(0, max(1, int(0.16 * n)) + 1)
            b = np.unique(np.concatenate((rng.permutation(a)[gone:], rng.integers(0, 1 << 63, rng.integers(0, 3)).astype(np.uint64))))
            common, union = len(np.intersect1d(a, b)), len(np.union1d(a, b))
            assert jaccard.sketch_distance(jaccard.parity_sketch(a), jaccard.parity_sketch(b)) <= union - common
            if 100 * common >= 85 * union and common < union:
                (sa, fa), (sb, fb) = (jaccard.signatures(x, bands, sketch) for x in (a, b))
                for s, f, t, g in ((sa, fa, sb, fb), (sb, fb, sa, fa)):  # either side finds the other by itself
                    plain, other = set(s[(f & 1 > 0) & (f < 2)]), set(t)
                    without_one, whole = set(s[f == 3]), set(t[g < 2])
                    assert plain & other or without_one & whole


def test_components(spark):
    rng = random.Random(7)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(330)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5, 5)]
    got = dict(rows_of(components.connected_components(spark.createDataFrame(edges, "a long, b long")), "node"))
    label = {x: x for e in edges for x in e if e[0] != e[1]}
    for _ in range(100):
        for a, b in edges:
            if a != b:
                label[a] = label[b] = min(label[a], label[b])
    assert got == label


def test_undivided_runs_end():
    """Units longer than the queue's limit, against the library: ``batch`` compares and raises."""
    encoder = sentencepieces.Encoder(MODEL)
    rng = random.Random(1)
    mixed = "".join(rng.choice("abcdethn") for _ in range(20_000))
    texts = ["a" * 300_000, " " * 100_000, "=" * 500, "ab" * 300, mixed, "é" * 90, "あ" * 100, "aé" * 300, "a" * 64, "a" * 65]
    found = encoder.batch(texts)
    decoded = ["".join(d for _, _, d in units).removeprefix(" ") for units in found]
    assert decoded == texts


# 11 periodic runs


def brute_runs(words):
    ids = np.array([{w: i for i, w in enumerate(dict.fromkeys(words))}[w] for w in words], np.int64) if len(words) < 50 else np.unique(words, return_inverse=True)[1]
    n, found = len(words), []
    for q in range(1, n // 3 + 1):
        equal = np.concatenate(([False], ids[:-q] == ids[q:], [False])).astype(np.int8)
        edge = np.diff(equal)
        for a, b in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True):
            length = b - a + q
            if length >= max(24, 3 * q):
                smaller = any(q % p == 0 and np.array_equal(ids[a : a + length - p], ids[a + p : a + length]) for p in range(1, q))
                if not smaller:
                    found.append((a, q, length))
    return [(a, length, q) for a, q, length in sorted(found)]


def brute_collapsed(words, runs):
    gone = {i for a, length, q in runs for i in range(a + q, a + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def run_texts(rng):
    words = [f"w{i}" for i in range(6)]
    for n in (0, 1, 23, 24, 25, 60, 200, 700, 2000):
        for period in (1, 2, 3, 7, 8, 9, 15, 16, 17, 40, 65, n // 3, n // 4):
            free = [rng.choice(words) + str(rng.randrange(50)) for _ in range(n)]
            if period and n:
                a = rng.randrange(max(1, n // 3))
                for i in range(a + period, n - rng.randrange(0, n // 6 + 1)):
                    free[i] = free[i - period]
            yield free
    for n in (300, 1500):
        yield ["a"] * n
        yield (["a"] * 30 + ["b"]) * (n // 31)
        yield ["ab"[bin(i).count("1") % 2] for i in range(n)]
        yield [rng.choice("ab") for _ in range(n)]
        fib = ["a"], ["b", "a"]
        while len(fib[1]) < n:
            fib = fib[1], fib[1] + fib[0]
        yield fib[1]
        yield (["x", "y"] * 15 + ["z"]) * (n // 31)


@pytest.mark.parametrize("long, tile", [(1 << 16, 8192), (0, 64), (500, 256)])
def test_word_runs(spark, long, tile, monkeypatch):
    monkeypatch.setattr(periods, "LONG", long)
    monkeypatch.setattr(periods, "TILE", tile)
    texts = [" ".join(w) for w in run_texts(random.Random(tile))] + [None, "", " \t\n\x0b ", "ü\xa0ü\u2003 " * 30, "one  two\r\n" * 40]
    rows = [(i % 50 if i % 7 else None, t, "x", "y") for i, t in enumerate([*texts, *texts[30:60]])]
    df = spark.createDataFrame(rows, "doc_id long, text string, runs string, _key string")
    got = periods.collapse_runs(df).drop("doc_id")
    expected = []
    for _, t, _, _ in rows:
        words = [w for w in re.split("[ \t-\r]+", t or "") if w]
        runs = brute_runs(words)
        expected.append((t or "", str(runs), brute_collapsed(words, runs), t is None))
    found = [(r.text or "", str([(x.start, x.length, x.period) for x in r.runs]), r.collapsed, r.text is None) for r in got.collect()]
    assert sorted(found) == sorted(expected) and sum(r != "[]" for _, r, _, _ in expected) > 40
    assert periods.collapse_runs(df.where("false")).count() == 0


def test_word_runs_query(spark):
    import zlib

    rows = {r.doc_id: r for r in llm_plans.QUERIES["op11_word_runs"](spark, "/root/testdata/sf0.001").collect()}
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    assert len(rows) == len(docs)
    planted = 0
    for r in docs:
        words = [w for w in re.split("[ \t-\r]+", r.text or "") if w]
        n, h = len(words), zlib.crc32(str(r.doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[a + (i - a) % p] if i >= a else words[i] for i in range(n)]
        runs, got = brute_runs(words), rows[r.doc_id]
        planted += bool(h % 10 == 0 and runs)
        best = max(runs, key=lambda x: (Fraction(x[1], x[2]), -x[0], -x[2]), default=None)
        assert got.n_runs == len(runs)
        assert (got.start, got.length, got.period) == (best or (None,) * 3) and got.exponent_milli == (best and 1000 * best[1] // best[2])
        assert got.runs_sha256 == hashlib.sha256("".join(f"{a},{m},{q}\n" for a, m, q in runs).encode()).hexdigest()
        assert got.collapsed_sha256 == hashlib.sha256(brute_collapsed(words, runs).encode()).hexdigest()
    assert planted > 5


# 12 hard negatives


def brute_negatives(rows, anchors, positives=5, negatives=3):
    out = []
    for a, label, x in anchors:
        scored = [(-sum(p * q for p, q in zip(x, y, strict=True)), d, other) for d, other, y in rows if d != a and len(y) == len(x)]
        for s, d, _ in sorted(r for r in scored if r[2] == label)[:positives]:
            near = sorted(r[:2] for r in scored if r[2] != label and 50 * -s <= 100 * -r[0] <= 95 * -s)[:negatives]
            out += [(a, d, n, row, -s, -score) for n, (score, row) in enumerate(near, 1)]
    return sorted(out)


@pytest.mark.parametrize("block", [3, 8192])
def test_hard_negatives(spark, block, monkeypatch):
    monkeypatch.setattr(negatives, "CHUNK", 4)
    rng = np.random.default_rng(block)
    shared = rng.normal(size=(4, 20))
    rows = [(i, int(rng.integers(0, 3)), (rng.normal(size=20) + 2 * shared[rng.integers(0, 4)]).tolist()) for i in range(300)]
    rows += [(400 + i, i % 2, rows[5][2]) for i in range(40)]  # one very common vector
    rows += [(500, 1, [1.0, 2.0]), (501, 1, [1.0, 1.9]), (502, 0, [1.0, 1.5]), (503, 2, [0.0] * 20), (5, rows[5][1], rows[5][2])]
    bad = [(600, None, [1.0] * 20), (601, 1, None), (602, 1, [float("nan")] * 20), (603, 1, [None] * 20), (None, 1, [1.0] * 20), (604, 1, [])]
    df = spark.createDataFrame([(*r, "x") for r in [*rows, *bad]], "vec_id long, label int, embedding array<double>, score string")
    whole = [(d, label, [int(np.floor(256 * v)) for v in x]) for d, label, x in rows]
    asked = [r for i, r in enumerate(whole) if r[0] % 50 == 0 or r[0] in (5, 501) and i < 350]
    got = negatives.hard_negatives(df, df.where("vec_id % 50 = 0 or vec_id in (5, 501)"), anchor_block=block)
    expected = brute_negatives(whole, {(d, label, tuple(x)): (d, label, x) for d, label, x in [*asked, whole[341]]}.values())
    assert sorted(map(tuple, got.collect())) == expected and len(expected) > 60
    assert negatives.hard_negatives(df.where("false"), df).count() == negatives.hard_negatives(df, df.where("false")).count() == 0


def test_omitted_suffixes_never_matter():
    rng = np.random.default_rng(2)
    x = rng.integers(-60, 61, (500, 32)) * np.repeat([4, 2, 1, 1], 8)
    q = x[:40].astype(np.float64)
    scores, norms = q @ x.T, np.linalg.norm(q, axis=1)
    need = np.quantile(scores, 0.99, axis=1)
    index = negatives.SuffixIndex(np.arange(500), x, float((need / norms).min()))
    assert index.posted.max() > index.posted.min()  # suffixes are omitted
    i, j = index.candidates(q, np.ones((40, len(index.ids)), bool), need)
    found = set(zip(i.tolist(), index.ids[j].tolist(), strict=True))
    assert set(zip(*map(np.ndarray.tolist, np.nonzero(scores >= need[:, None])), strict=True)) <= found and len(found) < 0.5 * scores.size


# 13 shards


def brute_best_fit(sizes, capacity):
    free, out = [], []
    for size in sizes:
        fits = [(f, i) for i, f in enumerate(free) if f >= size]
        if fits:
            i = min(fits)[1]
        else:
            i = len(free)
            free.append(max(capacity, size))
        free[i] -= size
        out.append(i)
    return out


def test_best_fit_takes_the_tightest_bin():
    rng = random.Random(5)
    for n, top, capacity in ((0, 9, 10), (400, 90, 100), (3000, 40, 100), (2000, 120, 100), (900, 1, 7)):
        sizes = sorted((rng.randint(1, top) for _ in range(n)), reverse=True)
        assert shards.best_fit(sizes, capacity) == brute_best_fit(sizes, capacity)
    sizes = sorted((int(rng.paretovariate(1.2) * 100) for _ in range(5000)), reverse=True)
    bins = np.array(shards.balanced(sizes, 24))
    loads = np.bincount(bins, np.array(sizes), 24)
    own = np.bincount(bins, minlength=24) == 1
    assert loads[~own].max() <= 1.005 * loads[~own].mean() and loads[own].min(initial=1 << 60) >= loads[~own].mean()
    assert shards.balanced([], 24) == [] and shards.balanced([5], 24) == [0] and sorted(shards.balanced([3, 3, 2], 24)) == [0, 1, 2]
    assert shards.balanced([4, 3, 2], 1) == [0, 0, 0]


def test_shards_query(spark):
    import zlib

    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    texts = {r.doc_id: (r.text or "").encode() for r in docs}
    rows = llm_plans.QUERIES["op13_best_fit_shards"](spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts) and {r.law for r in rows} == {"bytes"} and {r.grown_shard for r in rows} == {None}
    assert all(r.size == len(texts[r.doc_id]) + 8 and r.text_crc32 == zlib.crc32(texts[r.doc_id]) for r in rows)
    home, load, slots = {}, [0] * 24, [[] for _ in range(24)]
    for r in rows:
        assert home.setdefault(texts[r.doc_id], r.shard) == r.shard
        load[r.shard] += r.size
        slots[r.shard].append((r.slot, r.doc_id))
    assert all(sorted(s) == list(enumerate(sorted(d for _, d in s))) for s in slots)
    assert max(load) - min(load) < 0.02 * sum(load) / 24


def test_shards_of_awkward_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(shards, "ITEMS", 16)  # most groups are dealt into parcels
    hot = "one text that is a third of all rows"
    rows = [(d, t, h, 1) for d, t, h in AWKWARD] + [(None if i % 3 else i, hot, "x", 2) for i in range(400)] + [(i, f"text {i} " * (i % 9), "x", 3) for i in range(800)]
    df = spark.createDataFrame(rows, "doc_id long, text string, slot string, shard int")
    placed = shards.place(df, 5)
    got = shards.with_slots(placed).collect()
    assert len(got) == len(rows) and sorted(str((r.doc_id, r.text)) for r in got) == sorted(str(r[:2]) for r in rows)
    for number in range(5):
        assert sorted(r.slot for r in got if r.shard == number) == list(range(sum(r.shard == number for r in got)))
    assert len({r.shard for r in got if r.text == hot}) == len({r.shard for r in got if not r.text}) == 1
    alone = {r.shard for r in got if r.text == LONG}
    assert len(alone) == 1 and sum(r.shard in alone for r in got) == 1  # the huge text has a shard of its own
    filled = shards.place(df, None, 4000)
    loads = {r.shard: r.bytes for r in shards.shard_summary(filled).collect()}
    assert sum(b > 4000 for b in loads.values()) == 2 and len(loads) <= 2 + 1.1 * (sum(b for b in loads.values() if b <= 4000) / 4000) + 1
    shards.write_shards(placed, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == len(rows) and {r.shard for r in back.select("shard").distinct().collect()} == {r.shard for r in got}
    assert shards.with_slots(shards.place(df.where("false"))).count() == 0


# pipeline


def test_pipeline(spark):
    import corpus_pipeline as p

    docs, sf = spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), "/root/testdata/sf0.001"
    stages = dict(p.STAGES)
    kept = stages["language_id"](spark, docs, sf).cache()
    assert kept.columns == docs.columns and kept.count() == docs.where("text rlike '\\\\p{L}'").count()
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    roots = sorted({c for d, _, c in brute_groups(rows)})
    one = stages["similarity_join"](spark, kept, sf).cache()
    assert sorted(r.doc_id for r in one.collect()) == roots
    texts = [(r.doc_id, r.text) for r in one.orderBy("doc_id").collect()]
    cut = {r.doc_id: r for r in stages["suffix_dedup"](spark, one, sf).collect()}
    for (d, t), (n, removed, _, sha) in zip(texts, brute_cut([t for _, t in texts]), strict=True):
        if d in cut and not removed:
            assert cut[d].text == t
        elif d in cut:
            assert len(cut[d].text.encode()) <= n - removed and cut[d].n_chars == len(cut[d].text)
    last = p.run(spark, sf)
    assert {r.doc_id for r in last.select("doc_id").collect()} <= set(roots) and last.where("n_tokens <> size(ids)").count() == 0
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    clean = stages["decontamination"](spark, spark.createDataFrame([*cut.values()], docs.schema), sf)
    assert all(r.text == cut[r.doc_id].text for r in clean.collect() if brute_hits(cut[r.doc_id].text, items)[1] == 0)


def test_similar_rows_go_by_id_and_text(spark):
    import corpus_pipeline as p

    copy, own, free = (" ".join(f"{c}{i}" for i in range(30)) for c in "abc")
    rows = [(1, copy), (2, copy), (2, own), (3, "x"), (3, "x"), (None, free), (None, free)]
    docs = spark.createDataFrame([(d, t, "en", "s", len(t)) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = sorted([(r.doc_id, r.text) for r in p.similarity_join(spark, docs, SF).collect()], key=str)
    assert got == sorted([(1, copy), (2, own), (3, "x"), (None, free), (None, free)], key=str)


def test_stages_on_awkward_rows(spark):
    import corpus_pipeline as p

    rows = [(d, t, None, "s", None, "more") for d, t, _ in AWKWARD]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, hits string")
    for _, stage in p.STAGES:
        assert stage(spark, docs, SF).count() <= len(rows)
        assert stage(spark, docs.where("false"), SF).count() == 0


def test_decontamination_runs_one_python_worker_a_task(spark, capsys):
    import corpus_pipeline as p

    item = spark.read.parquet(f"{SF}/benchmark.parquet").where("length(text) > 60").first().text
    rows = [(1, f"§ {item} é!", "en", "s", 9), (2, "é kept", "en", "s", 6), (3, item, "en", "s", 9), (4, None, "en", "s", None)]
    out = p.decontamination(spark, spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"), SF)
    got = {r.doc_id: r.text for r in out.collect()}
    assert sorted(got) == [1, 2, 4] and got[2] == "é kept" and got[4] is None and len(got[1]) < len(rows[0][1])
    out.explain()
    assert capsys.readouterr().out.count("MapInArrow") == 1
