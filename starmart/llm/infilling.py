"""Fill-in-the-middle texts: a text is cut into prefix, middle and suffix, and the parts are put in another order behind marks.

The units are code points. A batch of texts becomes a list array of units; its flat values carry the index of their text (parent) and, from
the offsets of the lists, their ordinal in it. The ordinals against the text's two cuts give each unit its role; the units are filtered
by role, rebuilt into lists by their parents, and ``binary_join`` makes a string of each list. ``binary_join_element_wise`` then puts marks
and parts together in the order of the text's form.

Form and cuts come from the hash of a seed and the row's key, as DataFrame functions, so a repeated task gives the same. A batch is worked
on in slices of at most ``SLICE`` bytes of text, or one text: what a task holds is bounded by the longest text.

Cases: a null text is empty. An empty text, and one that holds a mark, is plain: it stays as it is, and its parts are null. A null key is hashed
as the seed alone. Equal keys get equal hashes; cuts at the same place give an empty middle. Repeated rows are handled one by one.
Other columns are handed through; a column with the name of the result is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SLICE = 4 << 20
_RESULT = T.StructType([
    T.StructField("output", T.StringType()), T.StructField("form", T.StringType()), T.StructField("n", T.LongType()),
    *(T.StructField(f"{part}_chars", T.LongType()) for part in ("prefix", "middle", "suffix")),
])


def units(texts: pa.Array) -> pa.LargeListArray:
    """Each text as a list of its code points, without a copy of the bytes."""
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    body = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.empty(0, np.uint8)
    starts = np.flatnonzero((body & 0xC0) != 0x80) + offsets[0]
    chars = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(np.append(starts, offsets[-1])), data if data is not None else pa.py_buffer(b""))
    return pa.LargeListArray.from_arrays(pa.array(np.searchsorted(starts, offsets)), chars)


def parts(texts: pa.Array, first: pa.Array, last: pa.Array) -> list[pa.Array]:
    """Prefix, middle and suffix of each text, cut before its units ``first`` and ``last``."""
    lists = units(texts)
    flat, parent = lists.flatten(), pc.list_parent_indices(lists)
    begin = lists.offsets.slice(0, len(lists))
    ordinal = pc.subtract(pa.array(np.arange(len(flat))), begin.take(parent))
    in_prefix, in_suffix = pc.less(ordinal, first.take(parent)), pc.greater_equal(ordinal, last.take(parent))
    roles = (in_prefix, pc.and_(pc.invert(in_prefix), pc.invert(in_suffix)), in_suffix)
    out = []
    for role in roles:
        counts = np.bincount(parent.filter(role).to_numpy(zero_copy_only=False), minlength=len(lists))
        rebuilt = pa.LargeListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts))), flat.filter(role))
        out.append(pc.binary_join(rebuilt, pa.scalar("", pa.large_string())))
    return out


def arranged(form: pa.Array, pieces: list[pa.Array], texts: pa.Array) -> pa.Array:
    """The outputs: marks and pieces in the order of the form."""
    prefix, middle, suffix = pieces
    mark = [pa.scalar(m, pa.large_string()) for m in (PREFIX, SUFFIX, MIDDLE, "")]
    psm = pc.binary_join_element_wise(mark[0], prefix, mark[1], suffix, mark[2], middle, mark[3])
    spm = pc.binary_join_element_wise(mark[1], suffix, mark[0], prefix, mark[2], middle, mark[3])
    return pc.if_else(pc.equal(form, "plain"), texts.cast(pa.large_string()), pc.if_else(pc.equal(form, "psm"), psm, spm))


def _slices(batch: pa.RecordBatch, column: int, size: int) -> Iterator[pa.RecordBatch]:
    ends = np.cumsum(np.asarray(pc.binary_length(batch.column(column)).fill_null(0), dtype=np.int64))
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + size, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def _group(key: Column, seed: str, place: int) -> Column:
    """The ``place``-th group of eight digits, from 1, of the hash of seed and key, as a number."""
    digits = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return F.conv(F.substring(digits, 8 * place - 7, 8), 16, 10).cast("long")


def fill_in_middle(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", result: str = "fim", seed: str = "1", percent: int = 90,
    spm_percent: int = 20, slice_bytes: int = SLICE,
) -> DataFrame:
    """``docs`` with a struct of the output, its form (plain, psm or spm), the text's length and the lengths of its parts.

    ``percent`` of the texts are cut, and of these ``spm_percent`` have the suffix first.
    """
    names = [c for c in docs.columns if c.lower() != result.lower()]
    body = F.coalesce(docs[text].cast("string"), F.lit(""))
    h = [_group(docs[key], seed, i) for i in (1, 2, 3, 4)]
    n = F.length(body).cast("long")
    cuts = [x % (n + 1) for x in h[:2]]
    plain = (n == 0) | (h[2] % 100 >= percent)
    for mark in (PREFIX, SUFFIX, MIDDLE):
        plain = plain | F.contains(body, F.lit(mark))
    form = F.when(plain, "plain").when(h[3] % 100 < spm_percent, "spm").otherwise("psm")
    rows = docs.select(
        F.struct(*(docs[c] for c in names)).alias("own"), body.alias("text"), form.alias("form"), n.alias("n"),
        F.least(*cuts).alias("first"), F.greatest(*cuts).alias("last"),
    )
    schema = T.StructType([rows.schema["own"], T.StructField("made", _RESULT)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch, 1, slice_bytes):
                own, texts, form, n, first, last = part.columns
                output = arranged(form, parts(texts, first, last), texts).cast(pa.string())
                cut = pc.not_equal(form, "plain")
                lengths = (first, pc.subtract(last, first), pc.subtract(n, last))
                lengths = [pc.if_else(cut, x, pa.scalar(None, pa.int64())) for x in lengths]
                made = pa.StructArray.from_arrays([output, form, n, *lengths], names=_RESULT.names)
                yield pa.RecordBatch.from_arrays([own, made], names=schema.names)

    return rows.mapInArrow(run, schema).select("own.*", F.col("made").alias(result))


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made from."""
    piece = F.split(output, "<[PSM]>", -1)
    psm = F.concat(F.get(piece, F.lit(1)), F.get(piece, F.lit(3)), F.get(piece, F.lit(2)))
    spm = F.concat(F.get(piece, F.lit(2)), F.get(piece, F.lit(3)), F.get(piece, F.lit(1)))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def digest(found: DataFrame, key: str = "doc_id", result: str = "fim") -> DataFrame:
    """Form, lengths and the hashes of the outputs and of the texts rebuilt from them."""
    output, form = F.col(result)["output"], F.col(result)["form"]
    return found.select(
        F.col(key), F.col(result)["n"].alias("n"), form.alias("form"), *(F.col(result)[c].alias(c) for c in ("prefix_chars", "middle_chars")),
        F.sha2(output, 256).alias("output_sha256"), F.sha2(restored(output, form), 256).alias("restored_sha256"),
    )
