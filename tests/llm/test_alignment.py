"""Aligned tokens against the two libraries and plain loops."""

import hashlib
import itertools
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from starmart.llm import alignment
from starmart.llm.queries import QUERIES, vocabulary_path

A, B = "byte_bpe_50k.json", "piece_bpe_32k.model"
SMALL = "/root/testdata/sf0.001"
RNG = random.Random(5)
TEXTS = [
    None, "", " ", "  ", "a", "a  b ", " lead", "x▁y", "<|endoftext|> <s> </s> <unk>", "naïve café 北京 \U0001f600 ﬁ ½", "\x00\t\r\n　 ​",
    "the the the the", "don't we'll 123456 --- ...", "a" * 3000, "1" * 2000, " " * 500 + "x", "=" * 700, "" * 40, "é" * 50 + " " * 7,
    "".join(RNG.choice("abcdefgh   .,1") for _ in range(4000)), "It was a dark and stormy night; " * 40,
    " " * 1_000_000 + "x y",
]


def sides():
    import sentencepiece
    import tokenizers

    one = tokenizers.Tokenizer.from_file(vocabulary_path(A))
    one.encode_special_tokens = True
    two = sentencepiece.SentencePieceProcessor(model_file=vocabulary_path(B))
    value = {c: b for b, c in enumerate(alignment.byte_alphabet())}

    def first(t):
        got = one.encode(" " + t, add_special_tokens=False)
        return got.ids, [bytes(value[c] for c in s) for s in got.tokens]

    def second(t):
        ids = two.encode(t)
        names = [two.id_to_piece(i) for i in ids]
        return ids, [bytes([int(s[3:5], 16)]) if two.is_byte(i) else s.replace("▁", " ").encode() for i, s in zip(ids, names, strict=True)]

    return first, second


def plain(rows):
    first, second = sides()
    kept, count = [], Counter()
    for key, t in rows:
        groups = []
        if t:
            (ids, x), (others, y) = first(t), second(t)
            raw = (" " + t).encode()
            if b"".join(x) == raw == b"".join(y):
                ends, tails = (list(itertools.accumulate(map(len, s))) for s in (x, y))
                common = sorted(set(ends) & set(tails))
                i = j = 0
                for c in common:
                    k, m = ends.index(c, i) + 1, tails.index(c, j) + 1
                    groups.append((ids[i:k], others[j:m]))
                    i, j = k, m
        pairs = Counter(p for g in groups for p in itertools.product(*g))
        count.update(pairs.keys())
        kept.append((key, groups, pairs))
    top = defaultdict(int)
    for (a, _), n in count.items():
        top[a] = max(top[a], n)
    for key, groups, pairs in kept:
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        yield (
            key, sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), sum(pairs.values()),
            sum(n for p, n in pairs.items() if count[p] == top[p[0]]), sum(n * count[p] for p, n in pairs.items()),
            hashlib.sha256(text.encode()).hexdigest() if groups else "",
        )


def rows_of(found):
    names = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    return sorted(map(repr, ((r.doc_id, *(r[n] for n in names)) for r in found.collect())))


def test_query_against_the_libraries(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    assert rows_of(QUERIES["op12_alignment"](spark, SMALL)) == sorted(map(repr, plain([tuple(r) for r in docs])))


def test_cases(spark, monkeypatch):
    data = [(i if i != 7 else None, t) for i, t in enumerate(TEXTS)] + [(3, TEXTS[-2])] * 2 + [(3, TEXTS[5])]
    docs = spark.createDataFrame([(*r, 1, "b") for r in data], "doc_id long, text string, n_a int, pairs string").repartition(2)
    want = sorted(map(repr, plain(data)))
    files = vocabulary_path(A), vocabulary_path(B)
    for head in (0, 5, alignment.HEAD):
        assert rows_of(alignment.align(docs, *files, head=head)) == want
    assert alignment.align(docs.limit(0), *files).isEmpty()


def test_links_in_several_rows(spark, monkeypatch):
    """Texts whose links fill several blocks count each pair once."""
    base = alignment.Aligner(open(vocabulary_path(A), encoding="utf-8").read(), open(vocabulary_path(B), "rb").read())
    text = TEXTS[-3]
    a, b, p, q = base.groups(*base.encoded([text])[0])
    whole = Counter()
    for pairs, n in alignment.links(a, b, p, q):
        whole.update(dict(zip(pairs.tolist(), n.tolist(), strict=True)))
    monkeypatch.setattr(alignment, "LINKS", 64)
    parts = list(alignment.links(a, b, p, q))
    assert len(parts) > 5
    found = Counter()
    for pairs, n in parts:
        assert len(set(pairs.tolist())) == len(pairs)
        found.update(dict(zip(pairs.tolist(), n.tolist(), strict=True)))
    assert found == whole and sum(whole.values()) == int((p * q).sum())
    # one large group
    rng = np.random.default_rng(1)
    x, y = rng.integers(0, 40, 300), rng.integers(0, 40, 200)
    found = Counter()
    for pairs, n in alignment.links(x, y, np.array([300]), np.array([200])):
        found.update(dict(zip(pairs.tolist(), n.tolist(), strict=True)))
    assert found == Counter((i << 32) + j for i in x.tolist() for j in y.tolist())
    rows = [(0, 0, True, [1, 1], [2, 3], [1, 1]), (1, 1, False, [1], [2], [1]), (1, None, False, [1, 5], [2, 6], [4, 1])]
    stored = spark.createDataFrame(rows, "row long, n_a long, whole boolean, a array<int>, b array<int>, times array<long>")
    got = {(r.a, r.b): (r.n, r.best) for r in alignment.pair_counts(stored).collect()}
    assert got == {(1, 2): (2, True), (1, 3): (1, False), (5, 6): (1, True)}


@pytest.mark.parametrize("seed", range(30))
def test_gallop(seed):
    rng = random.Random(seed)
    x, y = (sorted(rng.sample(range(400), rng.randrange(1, 200))) for _ in range(2))
    here, there = alignment.gallop(x, y)
    assert [x[i] for i in here] == sorted(set(x) & set(y)) == [y[i] for i in there]
