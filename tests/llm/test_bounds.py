"""Long texts, samples and switches: what must not change with size."""

import math
import random
import re
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from starmart.llm import common, decontamination, html, langid, neardup, quality, secrets, topk, warc


def plain_redacted(text, spans):
    out, at = [], 0
    for s in spans:
        if s.start >= at:
            out += [text[at : s.start], "[secret]"]
        at = max(at, s.end)
    return "".join(out) + text[at:]


def test_secrets_of_a_text_with_many_matches(spark):
    rng = random.Random(2)
    many = " ".join("%030x" % rng.getrandbits(120) for _ in range(100_000))
    mixed = "ü😀".join(rng.choice(["password = abcdefgh12", "token: short", "AKIA" + "Z" * 20, "secret=AKIA" + "Q" * 20, "plain"]) for _ in range(1500))
    few = "é" + mixed[:2000]
    docs = spark.createDataFrame([(1, many), (2, mixed), (3, few), (4, ""), (5, None)], "doc_id long, text string")
    start = time.perf_counter()
    found = secrets.find_secrets(docs).withColumn("clean", secrets.redacted(F.col("text"), F.col("secrets"))).collect()
    assert time.perf_counter() - start < 120
    for r in found:
        text = r.text or ""
        spans = sorted(
            (m.start(), place, rule.kind, m.end()) for place, rule in enumerate(secrets.BASE + secrets.MORE)
            for m in re.finditer(rule.pattern, text) if len(m.group(rule.group)) >= rule.least
        )
        assert [tuple(s) for s in r.secrets] == spans
        assert r.clean == (None if r.text is None else plain_redacted(text, r.secrets))
    assert max(len(r.secrets) for r in found) >= 100_000


def test_at_most_takes_a_share_of_any_size(spark):
    df = spark.range(20_000)
    assert common.at_most(df, 20_000, "id").count() == 20_000
    for rows in (10_000, 100, 5):
        assert abs(common.at_most(df, rows, "id").count() - rows) < 5 * rows**0.5
    assert (20_000 << 40) // (3 * 10**13) > 0  # a share that millionths would round to nothing


def test_quality_learns_a_bounded_sample_of_repeated_keys(spark):
    rows = [(i % 7, "good words here." if i % 7 < 4 else "### $$$") for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k < 4)) for k in range(7)] + [(1, 7), (2, -1)], "doc_id long, quality int")
    model = quality.fit(docs, labels, rows=50, trees=2)
    scored = quality.score(docs, model)
    assert scored.where("(quality_score >= 0.5) <> (doc_id < 4)").isEmpty()


@pytest.mark.parametrize("words", [10, 20, 21, 400])
def test_language_of_long_texts_follows_the_evidence(words):
    """A prior does not gain on the words of a text beyond some length."""
    # one word is a little likelier in the rarer language; from some length on that decides
    model = langid.Model(["aa", "bb"], [999, 1], [("aa", "w", 100), ("bb", "w", 120)], [], {("aa", 0): 1000, ("bb", 0): 1000})
    found, score = langid.Predictor(model)(" ".join(["w"] * words))
    assert found == ("bb" if words > 100 else "aa") and 0 <= score <= 1


def test_alike_classes_of_a_bucket_with_a_large_pivot(spark):
    """Two alike sets that share buckets with a much larger text that holds both."""
    rng = random.Random(9)
    x = [f"w{rng.randrange(10**6)}" for _ in range(60)]
    y = [*x[:30], "other", *x[31:]]
    z = [*x, *y, *(f"v{i}" for i in range(3000))]
    docs = spark.createDataFrame([(1, " ".join(z)), (2, " ".join(x)), (3, " ".join(y))], "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(docs, shingle=4, percent=80).collect()}
    assert got == {1: 1, 2: 2, 3: 2}


def test_top_k_of_sums_beyond_a_float(spark):
    rng = random.Random(12)
    big = 2**19  # products of about 2^54
    rows = [(i, [big + rng.randrange(-9, 10) / 256 for _ in range(3)]) for i in range(60)]
    rows += [(100 + i, [rng.uniform(-1, 1) for _ in range(3)]) for i in range(40)] + [(200 + i, [0.5, -0.5]) for i in range(20)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    whole = {k: [math.floor(256 * x) for x in v] for k, v in rows}
    want = set()
    for q in range(0, 220, 5):
        if q in whole:
            scores = [(-sum(a * b for a, b in zip(whole[q], v)), k) for k, v in whole.items() if k != q and len(v) == len(whole[q])]
            want |= {(q, r, k, -s) for r, (s, k) in enumerate(sorted(scores)[:5], 1)}
    assert max(s for *_, s in want) > 2**53
    for block in (4, 4096):  # many blocks and one
        got = topk.top_k(table, F.col("id") % 5 == 0, pivots=4, block=block, probes=16).collect()
        assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_captures_through_many_records(spark, tmp_path):
    warc.write_archives(spark.createDataFrame([(1, "http://a/", "x" * 1500), (2, "http://b/", "y")], "page_id long, url string, html string"), str(tmp_path / "w"))
    records = warc.read_records(spark, str(tmp_path / "w"))
    one = records.where("record_type = 'request'").orderBy("record_id").first()

    def linked(name, to):
        return records.where("record_type = 'metadata'").limit(1).withColumn("record_id", F.lit(name)).withColumn("concurrent_to", F.array(F.lit(to)))

    chain, last = records, one.record_id
    for name in ("b", "c", "d", "e"):
        chain, last = chain.unionByName(linked(name, last)), name
    chain = chain.unionByName(linked("p", "q")).unionByName(linked("q", "p"))
    found = {r.capture_id: {m.record_id for m in r.metadata} for r in warc.captures(chain).collect()}
    own = one.concurrent_to[0]
    assert {"b", "c", "d", "e"} <= found[own] and len(found[own]) == 5
    assert len(found) == 4 and found["p"] == {"p"} and found["q"] == {"q"}


def test_revisits_refer_to_the_record_that_holds_the_payload(spark, tmp_path):
    same, other = "s" * 1200, "o" * 1200
    rows = [(1, "http://a/", same), (2, "http://b/", other), (3, "http://c/", same), (4, "http://d/", same), (4, "http://e/", same), (None, None, other), (7, "http://f/", "x")]
    warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3), str(tmp_path / "w"))
    records = warc.read_records(spark, str(tmp_path / "w"))
    by_id = {r.record_id: r for r in records.collect()}
    revisits = [r for r in by_id.values() if r.record_type == "revisit"]
    assert len(revisits) == 3 and all(by_id[r.refers_to].record_type == "response" and by_id[r.refers_to].payload_digest == r.payload_digest for r in revisits)
    assert all(r.refers_to is None for r in by_id.values() if r.record_type != "revisit")
    found = Counter((r.page_id, r.record_type, r.refers_to) for r in warc.digest(warc.captures(records)).collect())
    assert found == Counter({(1, "revisit", 4): 1, (2, "response", None): 1, (3, "revisit", 4): 1, (4, "response", None): 2, (None, "revisit", 2): 1, (7, "response", None): 1})


def test_a_task_holds_one_automaton_at_a_time(spark):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(300)]
    items = [(i, " ".join(rng.choices(words, k=14))) for i in range(40)]
    texts = [(i, " ".join([*rng.choices(words, k=5), *(items[rng.randrange(40)][1].split()[rng.randrange(3):] if i % 3 else []), *rng.choices(words, k=4)])) for i in range(120)]
    docs = spark.createDataFrame([*texts, (500, None), (501, ""), (3, texts[3][1])], "doc_id long, text string").withColumn("benchmark", F.lit(1)).repartition(4)
    bench = spark.createDataFrame([*items, (None, items[0][1])], "item_id long, text string")
    one = decontamination.find_benchmark(docs, bench)
    many = decontamination.find_benchmark(docs, bench, block_bytes=400)
    assert many.columns == one.columns
    assert Counter(map(str, one.collect())) == Counter(map(str, many.collect()))
    assert many._jdf.queryExecution().executedPlan().toString().count("MapInArrow") <= 2


def test_copies_of_a_page_without_markup_keep_their_text(spark):
    menu = "<div>" + " ".join(f"menu{i}" for i in range(20)) + "</div>"
    text = " ".join(f"news{i}" for i in range(40))
    rows = [(1, "http://k/1", f"{menu}<p>{text}</p>"), (2, "http://k/2", f"{menu}<p>{text}</p>"), (3, "http://k/3", f"<head><title>t</title></head>{menu}<p>{text}</p>"),
            (4, "http://k/4", f"{menu}<p>another one</p>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    for size in (1 << 30, 50):
        got = {r.page_id: r.text for r in html.extract(pages, shard_bytes=size).collect()}
        assert got == {1: text, 2: text, 3: text, 4: "another one"}


def test_names_tell_asides_by_their_last_word():
    page = (
        "<article><p>a</p><div class='share-price'><p>b</p></div><div class='share-buttons x'>c</div><p class='related'>d</p><p>e</p>"
        "<div id='ad_300x250'>f</div><div class='comment-list-2'>g</div><p class='notice-of-court-text'>h</p><div class='main-content'>i</div></article>"
    )
    assert "".join(t for k, t in html.blocks_of(page) if k == 0) == "abehi"


def test_ids_without_strings_and_few_remembered_words():
    from starmart.llm import bpe
    from starmart.llm.queries import vocabulary_path

    with open(vocabulary_path(), encoding="utf-8") as file:
        spec = file.read()
    plain, small = bpe.Codec(spec), bpe.Codec(spec, decoded=False, memo=20)
    texts = [" ".join(f"word{i * 7 + j} thing-{j}<|endoftext|>" for j in range(12)) for i in range(50)]
    for text in texts:
        assert small.encode(text) == plain.encode(text)
        # what is over the bound goes when the next text comes
        assert len(small.memo) <= 20 + 25 and not any(strings for _, strings, _ in small.memo.values())
