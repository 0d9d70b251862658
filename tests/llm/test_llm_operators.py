"""The ten operators against plain versions on small rows: nulls, empty and long texts, ties, repeats, clashing names."""

import hashlib
import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from starmart.llm import bpe, brown, decontamination, html, langid, neardup, quality, secrets, topk, warc
from starmart.llm.queries import vocabulary_path

RNG = random.Random(3)
WORDS = ["alpha", "Beta", "gamma", "delta", "über", "eps", "zeta", "eta", "theta", "iota", "kappa", "mu"]


def text(n, rng=RNG):
    return " ".join(rng.choice(WORDS) + str(rng.randrange(9)) for _ in range(n))


@pytest.fixture(scope="module")
def docs(spark):
    base = text(200)
    near = base.replace("alpha", "ALPHA", 3)
    far = base.split()
    far[5], far[100] = "changed", "words"
    rows = [
        (1, base), (2, base), (2, base), (3, near), (4, " ".join(far)), (5, None), (6, ""), (7, text(30)), (8, text(2)), (9, "!?"),
        (10, text(20000)), (None, text(40)), (None, None),
    ]
    data = [(k, t, "clash", 5, [1], "en") for k, t in rows]
    return spark.createDataFrame(data, "doc_id long, text string, n_words string, score int, benchmark array<int>, lang string")


def empty(df):
    return df.limit(0)


def test_decontamination(spark, docs):
    found = [r for r in docs.collect() if r.doc_id == 7][0].text
    items = [
        (1, " ".join(found.upper().split()[3:18])), (2, "!?"), (3, None), (None, " ".join(found.split()[20:])), (11, found.split()[0]), (11, "none such"),
    ]
    benchmark = spark.createDataFrame(items, "item_id long, text string")

    def plain(t):
        words, hit, ids = decontamination.plain_words(t), set(), set()
        for key, item in items:
            for w in decontamination.windows(decontamination.plain_words(item), 10):
                for i in range(len(words) - len(w) + 1):
                    if tuple(words[i : i + len(w)]) == w:
                        hit |= set(range(i, i + len(w)))
                        ids |= {str(key)} if key is not None else set()
        return len(words), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)

    for block_bytes in (decontamination.BLOCK_BYTES, 40):  # one block of items, and several
        out = decontamination.find_benchmark(docs, benchmark, block_bytes=block_bytes)
        assert sorted(out.columns) == sorted(docs.columns)  # the column of that name is replaced
        got = Counter(map(tuple, decontamination.digest(out).collect()))
        assert got == Counter((r.doc_id, *plain(r.text)) for r in docs.collect())
        for r in out.where("size(benchmark.spans) > 0").collect():
            for s, w in zip(r.benchmark.spans, r.benchmark.word_spans, strict=True):
                own = decontamination.plain_words(r.text[s.start : s.end])
                assert own == decontamination.plain_words(r.text)[w.start : w.end]
    assert decontamination.digest(decontamination.find_benchmark(docs, empty(benchmark))).where("n_hit > 0").isEmpty()
    assert decontamination.find_benchmark(empty(docs), benchmark).isEmpty()


def test_bpe_equals_the_library(spark, docs):
    tokenizers = pytest.importorskip("tokenizers")
    path = vocabulary_path()
    library = tokenizers.Tokenizer.from_file(path)
    library.no_truncation()
    odd = ["É é Σ don't 12½ <|endoftext|>x<|startoftext|>", "a\x1cb\x85c　d", "<|ENDOFTEXT|>", "﻿İ!!''s 漢字 🙂", "x" * 300]
    more = spark.createDataFrame([(100 + i, t) for i, t in enumerate(odd)], "doc_id long, text string")
    both = docs.select("doc_id", "text").unionByName(more)
    for r in bpe.encode(both.withColumn("bpe", F.lit(1)), path).collect():
        want = library.encode(r.text or "", add_special_tokens=False).ids
        assert list(r.bpe.ids) == want
        assert r.bpe.decoded == library.decode(want, skip_special_tokens=False)
    for r in bpe.digest(bpe.encode_digest(both, path)).join(both, "doc_id").collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest() and r.n_tokens == len(ids)
    assert bpe.encode(empty(docs), path).isEmpty()


def test_warc_round_trip(spark, tmp_path):
    big, tricky = "x" * 2000, "a\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nabc" + "\r\n" * 5 + "é" * 800
    rows = [(1, "http://a/1", big), (2, None, big), (3, "http://a/ b\r\nc", big), (3, "http://a/3", big), (4, "u", None), (5, "u", "short"),
            (6, "u", "short"), (7, "http://b", tricky), (None, "v", big), (8, "v", tricky)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("size", F.lit(0))
    path = str(tmp_path / "warc")
    warc.write_archives(pages.repartition(3), path)
    records = warc.read_records(spark, path)
    assert records.groupBy("record_type").count().count() == 4 and records.count() == 30
    found = warc.captures(records)
    got = Counter(map(tuple, warc.digest(found).collect()))
    want = Counter()
    for key, _, page in rows:
        raw = (page or "").encode()
        top = max(k for k, _, p in rows if p == page and k is not None) if len(raw) >= 1000 else key
        again = len(raw) >= 1000 and key != top
        want[key, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if again else "response", top if again else None] += 1
    assert got == want
    kept = {bytes(r.response.block).partition(b"\r\n\r\n")[2] for r in found.collect() if r.response.record_type == "response"}
    assert kept == {(p or "").encode() for _, _, p in rows}
    assert found.where("size(requests) <> 1 or size(metadata) <> 1").isEmpty()
    # a record tied to the response through another one, and one that is tied to nothing
    loose = records.where("record_type = 'metadata'").limit(1).withColumn("concurrent_to", F.array(F.lit("nowhere"))).withColumn("record_id", F.lit("z"))
    one = records.where("record_type = 'request'").first()
    chained = records.where("record_type = 'metadata'").limit(1).withColumn("concurrent_to", F.array(F.lit(one.record_id))).withColumn("record_id", F.lit("y"))
    found = warc.captures(records.unionByName(loose).unionByName(chained))
    assert found.count() == 11 and found.where("response is null").count() == 1 and found.where("size(metadata) = 2").count() == 1
    warc.write_archives(empty(pages), str(tmp_path / "none"))
    assert warc.captures(warc.read_records(spark, str(tmp_path / "none"))).isEmpty()


def test_trigram_queries():
    assert secrets.trigram_query(r"[0-9a-f]{24,}") == secrets.ANY and secrets.trigram_query("ab|abcd") == secrets.ANY
    assert secrets.trigram_query("(abc|XYZ)+d?efg") == {frozenset({"abc", "efg"}), frozenset({"xyz", "efg"})}
    for rule in secrets.BASE + secrets.MORE:
        assert secrets.trigram_query(rule.pattern) != frozenset()


def test_secrets(spark, docs):
    import re

    rng = random.Random(8)
    bits = ["token", "TOKEN=", "secret", " : ", "=", '"', "'", "api_key", "apikey", "passwd", "AKIA", "ABCDEFGH12345678", "deadbeef" * 3, "abcdef", "é", " ", "x" * 9, "ſecret"]
    rows = [(100 + i, "".join(rng.choice(bits) for _ in range(rng.randrange(1, 30)))) for i in range(300)]
    more = spark.createDataFrame(rows, "doc_id long, text string")
    both = docs.select("doc_id", "text").unionByName(more).withColumn("secrets", F.lit(1))

    def plain(t):
        out = []
        for place, r in enumerate(secrets.BASE + secrets.MORE):
            pattern = r.pattern.replace("(?i:password|passwd|secret|token|api_?key)", "(?ai:password|passwd|secret|token|api_?key)")
            out += [(m.start(), place, r.kind, m.end()) for m in re.finditer(pattern, t or "") if len(m[r.group]) >= r.least]
        return sorted(out)

    found = secrets.find_secrets(both)
    for r in found.withColumn("clean", secrets.redacted(F.coalesce("text", F.lit("")), F.col("secrets"))).collect():
        assert [tuple(s) for s in r.secrets] == plain(r.text)
        assert not any(r.text[s.start : s.end] in r.clean for s in r.secrets if s.kind == "hex")
        assert r.secrets or r.clean == (r.text or "")
    plan = found._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert secrets.digest(secrets.find_secrets(empty(docs))).isEmpty()


def shingles(t, size):
    words = (t or "").encode().lower().split()
    size = min(size, len(words))
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if words else set()


def near_plain(rows, size, percent):
    sets = [shingles(t, size) for _, t in rows]
    place = list(range(len(rows)))

    def root(i):
        while place[i] != i:
            i = place[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        a, b = sets[i], sets[j]
        if a and b and 100 * len(a & b) >= percent * len(a | b):
            place[root(i)] = root(j)
    out = []
    for i, (key, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root(j) == root(i) and rows[j][0] is not None]
        name = (min(ids) if ids else None) if sets[i] else key
        out.append((key, len(sets[i]), name, key == name))
    return Counter(out)


def test_parity_bounds_the_difference():
    rng = np.random.default_rng(1)
    for size in (0, 1, 40, 5000):
        a = np.unique(rng.integers(0, 2**63, size, dtype=np.uint64))
        b = np.unique(np.concatenate([a[size // 5 :], rng.integers(0, 2**63, size // 4, dtype=np.uint64)]))
        turned = sum((x ^ y).bit_count() for x, y in zip(*(np.array(neardup.parity(s)).view(np.uint64).tolist() for s in (a, b))))
        assert turned <= len(np.setxor1d(a, b))


def test_near_duplicates(spark, docs):
    rng = random.Random(5)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    for group in range(12):  # copies of an original at growing distances, which mostly are not near each other
        words = [f"w{group}x{rng.randrange(10**6)}" for _ in range(120)]
        for copy in range(8):
            changed = list(words)
            for i in rng.sample(range(120), copy):
                changed[i] = f"c{rng.randrange(10**6)}"
            rows.append((1000 + rng.randrange(10**6), " ".join(changed)))
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("component", F.lit("x"))
    for size in (4, 5):
        got = neardup.digest(neardup.near_duplicates(df.repartition(5), shingle=size))
        assert Counter(map(tuple, got.collect())) == near_plain(rows, size, 80)
    assert neardup.near_duplicates(empty(df)).isEmpty()


def test_components_of_chains(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 90), (95, 100), (7, 7)]
    got = dict(map(tuple, neardup.components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {i: 0 for i in range(41)} | {90: 90, 95: 90, 100: 90}


def test_brown(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    kept = docs.where("doc_id is null or doc_id <> 4").select("text")
    model = brown.train(kept, units=20, head=30, size=4, rounds=2)
    own = [brown.tokens_of(t) for k, t in rows if k != 4]
    c = Counter(itertools.chain.from_iterable(own))
    n, v = sum(c.values()) + len(own), len(c) + 1
    # the model's probabilities, word by word
    of, log_class = np.append(model.classes, model.size), model.log_class
    assert np.allclose((10**log_class).sum(1), 1)
    mass, types = np.zeros(4), np.zeros(4)
    for w, k in c.items():
        mass[model.classes[model.units(w)]] += k
        types[model.classes[model.units(w)]] += 1
    assert (mass == model.mass).all() and (types == model.types).all()
    want = Counter()
    for key, t in rows:
        words, last, base, score = brown.tokens_of(t), 4, math.log10((len(own) + 1) / (n + v + 1)), 0.0
        for w in words:
            g = of[model.units(w)]
            score += log_class[last, g] + math.log10((c[w] + brown.ALPHA) / (mass[g] + brown.ALPHA * (types[g] + 1)))
            base += math.log10((c[w] + 1) / (n + v + 1))
            last = g
        score += log_class[last, 4]
        want[key, len(words) + 1, sum(c[w] > 0 for w in words) + 1, n, round(base, 6), round(score, 6)] += 1
    got = brown.score(docs, model).collect()
    assert Counter((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in got) == want
    none = brown.train(empty(kept), units=20, head=30, size=4, rounds=1)
    assert {r.n_known for r in brown.score(docs, none).collect()} == {0}
    assert brown.score(empty(docs), model).isEmpty()


def test_brown_clusters_rare_words_by_their_contexts(spark):
    # rare words in two kinds of places; endings do not tell the kind
    rng = random.Random(9)
    names = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(120)]
    rows = [f"the {a} runs . we {b} it ." for a, b in zip(names[:60], names[60:], strict=True)] * 2
    train = spark.createDataFrame([(t,) for t in rows], "text string")
    model = brown.train(train, units=6, head=8, size=8, rounds=3)
    assert model.words.count() == 125 and model.words.where("g is null or g < 0 or g >= 8").isEmpty()
    of = {r.word: r.g for r in model.words.collect()}
    assert {of[a] for a in names[:60]}.isdisjoint({of[b] for b in names[60:]})


def test_brown_tables_and_likelihood(spark):
    rng = random.Random(4)
    rows = [(" ".join(rng.choice(WORDS[i % 3 :: 3]) + str(rng.randrange(4)) for i in range(rng.randrange(9))),) for _ in range(200)] + [(None,), ("",)]
    texts = spark.createDataFrame(rows, "text string").repartition(5)
    ranked, size = [b"alpha0", b"beta1", b"mu3", b"eta2", b"gamma0"], 3
    end = len(ranked)
    number = {w: i for i, w in enumerate(ranked)}
    classes = np.array([0, 1, 2, 0, 1, size, *(i % size for i in range(brown.TAILS))])
    numbered = brown.streams(texts, ranked)

    def plain(classes):
        table, pairs = np.zeros((len(classes), 2 * (size + 1)), dtype=int), Counter()
        for (t,) in rows:
            ids = [end, *(number.get(w, end + 1 + brown.tail(w)) for w in brown.tokens_of(t)), end]
            for a, b in zip(ids, ids[1:]):
                table[a, classes[b]] += 1
                table[b, size + 1 + classes[a]] += 1
                pairs[classes[a], classes[b]] += 1
        first, second = Counter(), Counter()
        for (a, b), n in pairs.items():
            first[a] += n
            second[b] += n
        return table, sum(n * math.log(n / first[a] / second[b]) for (a, b), n in pairs.items())

    table, known = plain(classes)
    assert (brown.context_table(numbered, classes, size) == table).all()
    found, kept, steps = brown.exchange(numbered, classes, size, 6)
    table, reached = plain(found)
    assert (kept == table).all() and math.isclose(steps[0], known) and math.isclose(steps[-1], reached)
    assert len(steps) > 1 and all(a < b for a, b in zip(steps, steps[1:]))
    # a step by hand: each number moves to the class under which its counts are likeliest
    logs = brown._logs(brown._by_class(table, found, size), size)
    moved = brown.moves(table, found, size, 1)
    for u in range(len(found)):
        costs = [sum(n * logs[g, cell] for cell, n in enumerate(table[u])) for g in range(size)]
        assert moved[u] == (found[u] if u == end or not table[u].any() else int(np.argmax(costs)))
    for values, kind in ((np.array([0, 7, 2**31 - 1]), "<i4"), (np.array([], dtype=int), "<i8"), (np.array([2**62]), "<i8")):
        assert (brown.unpack(brown.pack(values, kind), len(values), kind) == values).all()


def test_html(spark):
    page = (
        "<!DOCTYPE html><html><head><title>T</title><script>var t='</p>';</script></head><body><header>Top</header><nav><ul><li><a>Home</a></ul></nav>"
        "<div class='ad'>Buy</div><article><header><h1>Title &amp; more</h1></header><p><b>One.<br>two<p>Three&nbsp;four &lt;b&gt;<!-- no --> "
        "<form>Mail</form><section id=comments><p>Me too</section>\n <p>five\n  six</article><aside>Side</aside><footer>&copy;</footer>"
    )
    menu = "<div>" + " ".join(f"menu{i}" for i in range(20)) + "</div>"
    rows = [(1, "http://h/1", page), (2, "http://h/2", None), (3, None, ""), (4, "http://k/1", menu + "<p>only here</p>"),
            (5, "http://k/2", menu + "<p>and there</p>"), (5, "http://k/2", menu + "<p>and there</p>"), (6, "http://l/1", menu)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("x")).withColumn("host", F.lit(1))
    got = Counter((r.page_id, r.text, r.n_chars) for r in html.digest(html.extract(pages)).collect())
    texts = {1: "Title & more\nOne. two\nThree four <b>\nfive six", 2: "", 3: "", 4: "only here", 5: "and there", 6: menu[5:-6]}
    assert got == Counter((k, texts[k], len(texts[k])) for k, _, _ in rows)
    assert html.extract(empty(pages)).isEmpty()


def test_html_text_does_not_depend_on_shards(spark):
    rng = random.Random(6)
    runs = [" ".join(f"r{i}x{j}" for j in range(15)) for i in range(40)]
    rows = []
    for i in range(80):  # each run stands on two pages of the host
        own = [f"<p>own{i}w{j} {rng.randrange(10**6)}</p>" for j in range(3)]
        rows.append((i, "http://big/x", f"{own[0]}<p>{runs[i % 40]}</p>{own[1]}{own[2]}"))
    rows += [(3, "http://big/x", rows[3][2]), (90, "http://small/x", f"<p>{runs[0]}</p>"), (None, "http://big/y", f"<p>{runs[1]}</p>"), (91, "http://big/x", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    texts = [Counter(map(tuple, html.extract(pages, shard_bytes=n).collect())) for n in (1 << 30, 2000, 1)]
    assert texts[0] == texts[1] == texts[2]
    assert all("r" not in t for (k, _, t) in texts[0] if k != 90) and len([1 for k, *_ in texts[0] if k == 90]) == 1


def test_html_of_malformed_pages_is_read_once():
    import time

    start = time.perf_counter()
    for piece in ("<a ", '<a "', "<", "<p ='", "<script>", "<svg>", "<!--", "a<b ", '<a ="x', "<div>", "</section><div>", "<![CDATA["):
        html.blocks_of(piece * (1_000_000 // len(piece)))
    assert time.perf_counter() - start < 30
    assert html.blocks_of("a <b>x</b> 1 < 2 > 0 <p title='a>b'>t</p><p it's>u<p>v") == [(1, "a x 1 < 2 > 0"), (1, "t"), (1, "u"), (1, "v")]
    assert html.blocks_of("<head><title>t</title><body>x <svg>y <p>z") == [(1, "x y"), (1, "z")]
    assert html.blocks_of("<article>x</article><p>y <a href='u") == [(0, "x"), (1, "y")]


def test_html_hosts_whose_markup_tells_are_not_searched(spark, monkeypatch):
    marked = [(i, f"http://a.io/{i}", f"<p>menu {i}</p><article>text {i}</article>") for i in range(5)]
    monkeypatch.setattr(html, "_by_repeats", None)
    pages = spark.createDataFrame(marked, "page_id long, url string, html string")
    assert {r.text for r in html.extract(pages).collect()} == {f"text {i}" for i in range(5)}


def test_html_repeats_are_searched_for_on_marked_hosts_too(spark, monkeypatch):
    exchanged, real = [], html._by_repeats
    monkeypatch.setattr(html, "_by_repeats", lambda *given: exchanged.append(real(*given)) or exchanged[-1])
    notice = " ".join(f"n{i}" for i in range(14))
    rows = [(i, f"http://a.io/{i}", f"<p>{notice}</p><article>text {i}</article>") for i in range(6)]
    rows.append((9, "http://b.io/1", f"<p>{notice}</p><article>text 9</article>"))
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    for size in (1 << 30, 1):
        found = html.extract(pages, shard_bytes=size)
        # every page is in a suffix array of its host
        assert "FlatMapCoGroupsInPandas" in found._jdf.queryExecution().executedPlan().toString()
        assert {(r.page_id, r.text) for r in found.collect()} == {(i, f"text {i}") for i in (*range(6), 9)}
    marks = exchanged[0].collect()
    hashes = {h for r in marks for h in html._unpacked(r.hashes, r.n).tolist()}
    given = np.array([-(2**63), -5, 0, 7, 2**63 - 1, 3])
    assert (html._unpacked(html._packed(given), 6) == given).all()
    # three windows of the notice and the one that ends with the article's first word, not those of another host
    assert len(exchanged) == 1 and len(hashes) == 4 and len({r.shard for r in marks}) > 1


def test_covered_tokens_against_all_windows():
    rng = np.random.default_rng(2)
    for _ in range(60):
        tokens, pages = rng.integers(0, 3, 60), np.sort(rng.integers(0, 5, 60))
        w, want = int(rng.integers(2, 6)), np.zeros(60, dtype=bool)
        at = [i for i in range(61 - w) if pages[i] == pages[i + w - 1]]
        for i, j in itertools.combinations(at, 2):
            if pages[i] != pages[j] and (tokens[i : i + w] == tokens[j : j + w]).all():
                want[i : i + w] = want[j : j + w] = True
        assert (html.covered(pages, tokens, w) == want).all()


def test_language(spark, docs):
    words = {"aa": ["lorem", "ipsum", "dolor"], "bb": ["krasna", "zvezda", "mrak"]}
    rows = [(i, " ".join(RNG.choice(words[g]) for _ in range(9)), g) for i, g in enumerate(["aa", "bb"] * 40)]
    train = spark.createDataFrame([*rows, (900, None, "aa"), (901, "x", None), (None, "x", "aa")], "doc_id long, text string, lang string")
    model = langid.train(train)
    asked = spark.createDataFrame([(1, "lorem dolorum"), (2, "ZVEZDA"), (3, "krasny"), (4, None), (5, "12 ..."), (6, "")], "doc_id long, text string")
    got = {r.doc_id: r.language for r in langid.predict(asked.withColumn("language", F.lit(1)), model).collect()}
    assert [got[i].lang_pred for i in range(1, 7)] == ["aa", "bb", "bb", "und", "und", "und"]
    assert all(0 <= r.score <= 1 for r in got.values())
    nothing = langid.train(empty(train))
    assert {r.language.lang_pred for r in langid.predict(asked, nothing).collect()} == {"und"}
    assert langid.predict(empty(docs), model).isEmpty()


def test_language_learns_a_rare_language_above_the_bound(spark):
    rows = [(i, "lorem ipsum dolor", "aa") for i in range(6000)] + [(7000 + i, "krasna zvezda", "bb") for i in range(6)] + [(8000, "12", "cc")]
    train = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(train, rows=20)
    assert model.langs == ["aa", "bb"] and np.allclose(np.exp(model.prior), [6000 / 6006, 6 / 6006])
    asked = spark.createDataFrame([(1, "zvezda krasna zvezda"), (2, "ipsum")], "doc_id long, text string")
    assert {r.doc_id: r.language.lang_pred for r in langid.predict(asked, model).collect()} == {1: "bb", 2: "aa"}
    assert langid.parts_of({"a": 10, "b": 10**6, "c": 10**7}, 20_000) == {"a": 10, "b": 9995, "c": 9995}
    assert langid.parts_of({"a": 10, "b": 30}, 100) == {"a": 10, "b": 30}


def test_topk(spark):
    rng = np.random.default_rng(4)
    vectors = [(int(i), [float(x) for x in rng.normal(size=6)]) for i in range(300)] + [(i, [0.5] * 6) for i in range(300, 420)]
    vectors += [(500, None), (501, [float("nan")] * 6), (502, [1.0, None] * 3), (503, [float("inf")] * 6), (None, [1.0] * 6), (550, [1.0, 2.0]),
                (551, [3.0, -1.0]), (7, [0.1] * 6), (600, []), (601, [])]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>").withColumn("v", F.lit(1))
    fine = [(k, tuple(math.floor(256 * x) for x in v)) for k, v in vectors if k is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    want = set()
    for k, q in {x for x in fine if x[0] % 50 == 0}:
        scored = sorted((-sum(a * b for a, b in zip(q, v, strict=True)), c) for c, v in fine if c != k and len(v) == len(q))
        want |= {(k, i + 1, c, -s) for i, (s, c) in enumerate(scored[:5])}
    for block in (4096, 2):
        got = topk.top_k(df.repartition(4), F.col("id") % 50 == 0, pivots=8, block=block, probes=40)
        assert {tuple(r) for r in got.collect()} == want
    assert topk.top_k(empty(df), F.col("id") % 50 == 0).isEmpty()


def test_quality(spark, docs):
    good = [(i, text(60) + ".") for i in range(120)]
    bad = [(200 + i, " ".join(w + RNG.choice(["###", "$$$"]) for w in text(60).split())) for i in range(120)]
    rows = spark.createDataFrame(good + bad, "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k < 200)) for k, _ in good + bad if zlib.crc32(str(k).encode()) % 5] + [(None, 1), (5, None), (10**6, 1)], "doc_id long, quality int")
    model = quality.fit(rows, labels, trees=4)
    assert model.rules and all(w for _, w in model.rules)
    scored = quality.score(rows.withColumn("quality_score", F.lit("x")), model)
    assert scored.where("(quality_score >= 0.3) <> (doc_id < 200)").isEmpty()
    every = quality.score(docs, model).collect()
    assert len(every) == docs.count() and all(0 <= r.quality_score <= 1 for r in every)
    assert quality.score(docs, quality.fit(rows, empty(labels))).where("quality_score <> 0.5").isEmpty()
    assert quality.score(empty(docs), model).isEmpty()
