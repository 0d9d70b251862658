"""Fill-in-the-middle against slices of Python strings."""

import hashlib

from starmart.llm import infilling

TEXTS = [
    None, "", "a", "ab", "ä€😀x" * 50, "with <P> mark", "<S>", "<M", "<P", "P>S>M>" * 9, "\x00\x01é\r\n" * 20, "word " * 40_000, "é‍" * 7,
    "<" * 60, "plain words here", "S>" * 40,
]


def plain(key, t, seed="1", percent=90, spm=20):
    t = t or ""
    h = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    h = [int(h[i : i + 8], 16) for i in (0, 8, 16, 24)]
    n = len(t)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not t or any(m in t for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= percent:
        return t, "plain", n, None, None, None
    x, y, z = t[:a], t[a:b], t[b:]
    form = "spm" if h[3] % 100 < spm else "psm"
    out = f"<P>{x}<S>{z}<M>{y}" if form == "psm" else f"<S>{z}<P>{x}<M>{y}"
    return out, form, n, a, b - a, n - b


def test_outputs(spark):
    data = [(k, t, "clash", 1, 2) for k in range(12) for t in TEXTS] + [(None, "no key", None, 1, 2), (3, "twice", "", 1, 2), (3, "twice", "", 1, 2)]
    docs = spark.createDataFrame(data, "doc_id long, text string, fim string, _text int, form int").repartition(3)
    for slice_bytes in (infilling.SLICE, 50):
        found = infilling.fill_in_middle(docs, slice_bytes=slice_bytes)
        assert found.columns == ["doc_id", "text", "_text", "form", "fim"]
        rows = found.collect()
        assert sorted(map(repr, ((r.doc_id, r.text) for r in rows))) == sorted(map(repr, ((k, t) for k, t, *_ in data)))
        for r in rows:
            f = r.fim
            assert (f.output, f.form, f.n, f.prefix_chars, f.middle_chars, f.suffix_chars) == plain(r.doc_id, r.text)
        assert {r.fim.form for r in rows} == {"plain", "psm", "spm"}
    kept = infilling.fill_in_middle(docs, seed="x", percent=100, spm_percent=0).select("text", "doc_id", "fim").collect()
    assert all(tuple(r.fim)[:2] == plain(r.doc_id, r.text, "x", 100, 0)[:2] for r in kept)
    again = found.select("text", infilling.restored(found.fim.output, found.fim.form).alias("back")).collect()
    assert all((r.text or "") == r.back for r in again)
    assert infilling.fill_in_middle(docs.limit(0)).isEmpty()
    digest = infilling.digest(found).collect()
    assert {(r.doc_id, r.restored_sha256) for r in digest} == {(k, hashlib.sha256((t or "").encode()).hexdigest()) for k, t, *_ in data}
