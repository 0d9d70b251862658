"""Adding a batch to a written table: rows of known keys are replaced, ids continue, history stays."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..contracts import TableContract
from ..operators.keys import number_staged, tag_rows
from ..session import remove_path
from ..sinks.aligned import append_aligned, layout_of, read_aligned
from ..sinks.stage import drop_steps, stage
from ..sinks.tables import refresh_partitions, write_table
from ..sinks.versions import Ranges, current_version, files_of, key_ranges, publish, read_files
from ..sources.files import read_table

#: Partition values up to which a filter lists them.
_LITERALS = 10_000


def _match(left: DataFrame, right: DataFrame, columns: Sequence[str], how: str, present: bool = False) -> DataFrame:
    """Join by equal columns, where NULL equals NULL; the right side's copies are dropped.

    With ``present`` the right side lacks none of them: plain equality finds the same rows, and sides that
    are dealt or grouped by the columns are not shuffled again.
    """
    names = {c: f"__right_{c}" for c in columns}
    on = reduce(lambda a, b: a & b, [F.col(c) == F.col(n) if present else F.col(c).eqNullSafe(F.col(n)) for c, n in names.items()])
    return left.join(right.withColumnsRenamed(names), on, how).drop(*names.values())


def _added(
    batch: DataFrame, replaced: DataFrame, contract: TableContract, key: Sequence[str], first_id: int, folder: str | None,
    clean: bool = False,
) -> DataFrame:
    """The rows that a batch brings in, with the ids of the rows they replace or new ones from ``first_id``; made of stored rows."""
    name = contract.id_column
    same = list(key) or [c for c in contract.columns if c != name]
    # NULL ids are those still to be given
    if key and name:
        ids = replaced.groupBy(*same).agg(F.min(name).alias(name))
        placed = stage(_match(batch.drop(name), ids, same, "left", clean), f"placed-{contract.name}", folder)
        known, new = placed.filter(F.col(name).isNotNull()), placed.filter(F.col(name).isNull()).drop(name)
    elif key:
        known, new = batch, None
    else:
        known, new = None, _match(batch, replaced.select(*same).distinct(), same, "left_anti")
        new = new.drop(name) if name else new
    if name and new is not None:
        tagged = stage(tag_rows(new, same, order_is_unique=bool(key)), f"new-{contract.name}", folder)
        new = number_staged(tagged, name).withColumn(name, F.col(name) + first_id)
    added = reduce(DataFrame.unionByName, [d.select(*contract.columns) for d in (known, new) if d is not None])
    # known rows and numbered ones are stored already, and read again without a shuffle
    return added if key or name else stage(added, f"added-{contract.name}", folder)


def _batch_and_keys(
    batch: DataFrame, contract: TableContract, same: Sequence[str], folder: str | None, clean: bool
) -> tuple[DataFrame, DataFrame]:
    """The batch as stored rows, and the distinct values that its rows are told by."""
    if clean:
        return batch, batch.select(*same)
    batch = stage(batch, f"batch-{contract.name}", folder)
    return batch, batch.select(*same).distinct()


def merge_batch(
    batch: DataFrame, path: str, contract: TableContract, key: Sequence[str], folder: str | None = None, clean: bool = False
) -> dict[str, int]:
    """Bring ``batch`` (the contract's columns, its ids ignored) into the table at ``path``; counts of written and known rows.

    With a key, a row of the batch replaces the stored rows of its key and takes over their id. Without
    one, rows that are stored already are known and the others are added. New ids follow the
    largest stored one. Only partitions that hold a row of the batch, or held a row that it
    replaces, are read in full and written; a table without partitions is rewritten. All is
    computed from a stored copy before anything is overwritten, and a batch brought in twice changes nothing.
    Finding the replaced rows reads the key, id and partition of the whole table; :func:`merge_version` reads less.
    A ``clean`` batch is read from stored rows without a shuffle and has a key, each one once and none missing, so it is not
    stored again, and keys are compared as they are.
    """
    spark = batch.sparkSession
    old = read_table(spark, path, schema=contract.schema)
    name, parts = contract.id_column, list(contract.partition_by)
    same = list(key) or [c for c in contract.columns if c != name]
    batch, keys = _batch_and_keys(batch, contract, same, folder, clean)
    # of the replaced rows what the merge needs, so that no whole row of the table is shuffled to find them
    narrow = dict.fromkeys([*same, *([name] if name else []), *parts])
    replaced = stage(_match(old.select(*narrow), keys, same, "left_semi", clean), f"replaced-{contract.name}", folder)
    first_id = old.agg(F.coalesce(F.max(name) + 1, F.lit(0))).first()[0] if name else 0
    added = _added(batch, replaced, contract, key, first_id, folder, clean)

    kept = old
    if parts:
        kept = _in_partitions(old, added.select(*parts).union(replaced.select(*parts)).distinct(), parts)
    if key:
        known = replaced.select(*same)
        kept = _match(kept, known if clean else known.distinct(), same, "left_anti", clean)
    merged = stage(kept.select(*contract.columns).unionByName(added), f"merged-{contract.name}", folder)
    if parts:
        gone = _match(replaced.select(*parts).distinct(), merged.select(*parts).distinct(), parts, "left_anti")
        gone = stage(gone, f"gone-{contract.name}", folder)
        empty = [] if gone.isEmpty() else _folders(old, parts, gone)
        refresh_partitions(merged, path, parts)
        for folder_of_value in empty:
            remove_path(spark, _plain(spark, folder_of_value))
    else:
        write_table(merged, path)
    n_batch, n_added = batch.count(), added.count()
    drop_steps(spark, folder, *(f"{step}-{contract.name}" for step in ("batch", "replaced", "placed", "new", "added", "merged", "gone")))
    return {"known": n_batch - n_added, "written": n_added}


def _in_partitions(rows: DataFrame, values: DataFrame, parts: Sequence[str]) -> DataFrame:
    """Rows of some partitions, as a literal filter, which prunes folders; a join when there are very many."""
    found = values.limit(_LITERALS + 1).collect()
    if len(found) > _LITERALS:
        return _match(rows, values, parts, "left_semi")
    hit = F.lit(False)
    if len(parts) == 1:
        given = [r[0] for r in found if r[0] is not None]
        hit = F.col(parts[0]).isin(*given) if given else hit
        return rows.where(hit | F.col(parts[0]).isNull() if len(given) < len(found) else hit)
    for r in found:
        hit = hit | reduce(lambda a, b: a & b, [F.col(p).eqNullSafe(F.lit(v)) for p, v in zip(parts, r, strict=True)])
    return rows.where(hit)


@dataclass
class Change:
    """What a batch did to a versioned or aligned table: stored rows before and after, and how many files were looked at or parts there are."""

    added: DataFrame
    replaced: DataFrame
    ranges: Ranges | None
    counts: dict[str, int]
    files: dict[str, int]


def merge_version(
    batch: DataFrame, path: str, contract: TableContract, key: Sequence[str], folder: str | None = None, clean: bool = False
) -> Change:
    """As :func:`merge_batch`, for a table kept as versions; the result is a new version.

    The batch's keys are summed up in ranges, and only files whose range of the first key column meets one are read. Of these,
    files that hold a replaced row are written anew without it, the others are taken over as they are. New ids follow the
    largest one in the list of files. Tables without a key compare whole rows, so all their files are read.
    """
    spark = batch.sparkSession
    since, name = current_version(spark, path), contract.id_column
    files = files_of(spark, path, since)
    same = list(key) or [c for c in contract.columns if c != name]
    batch, keys = _batch_and_keys(batch, contract, same, folder, clean)
    ranges = key_ranges(batch, key[0]) if key else None
    near = files.where(ranges.meets(F.col("low"), F.col("high"), F.col("keyless"))) if ranges else files
    old = read_files(spark, path, contract.schema, near, with_file=True)
    found = _match(old, keys, same, "left_semi", clean)
    found = stage(found, f"replaced-{contract.name}", folder)
    replaced = found.drop("__file")
    top = files.agg(F.max("top_id")).first()[0]
    added = _added(batch, replaced, contract, key, 0 if top is None else top + 1, folder, clean)
    if key:
        hit = found.select(F.col("__file").alias("file")).distinct()
    else:
        hit = found.select(F.col("__file").alias("file")).limit(0)
    hit = stage(hit, f"hit-{contract.name}", folder)
    rest = read_files(spark, path, contract.schema, hit)
    known = replaced.select(*same)
    rest = _match(rest, known if clean else known.distinct(), same, "left_anti", clean).select(*contract.columns)
    n_added = added.count()
    counts = {"known": batch.count() - n_added, "written": n_added}
    numbers = {"listed": files.count(), "read": near.count(), "rewritten": hit.count()}
    if n_added:
        # stored, since a sort by ranges reads its rows twice
        publish(
            stage(rest, f"rest-{contract.name}", folder).unionByName(added), path, (list(key) or same)[0], contract.partition_by, name,
            kept=files.join(hit, "file", "left_anti"), since=since,
        )
        drop_steps(spark, folder, f"rest-{contract.name}")
    return Change(added, replaced, ranges, counts, numbers)


def merge_aligned(
    batch: DataFrame, path: str, contract: TableContract, key: Sequence[str], folder: str | None = None, clean: bool = False
) -> Change:
    """As :func:`merge_batch`, for a table in buckets of its key; the result is one more part.

    The batch alone is shuffled: it meets the stored rows bucket by bucket. New ids follow the largest one entered for a part.
    """
    spark, layout = batch.sparkSession, layout_of(batch.sparkSession, path)
    if not clean:
        batch = stage(batch, f"batch-{contract.name}", folder)
    keys = batch.select(*key)  # plain equality, since no key is missing: the stored side stays where it is
    replaced = stage(read_aligned(spark, path, contract.schema).join(keys, list(key), "left_semi"), f"replaced-{contract.name}", folder)
    first_id = 0 if layout.top_id is None else layout.top_id + 1
    added = _added(batch, replaced.select(*contract.columns), contract, key, first_id, folder, clean)
    n_added = append_aligned(added, path, contract.id_column) if not added.isEmpty() else 0
    return Change(added, replaced, None, {"known": batch.count() - n_added, "written": n_added}, {"parts": len(layout.parts) + bool(n_added)})


def _folders(table: DataFrame, parts: Sequence[str], values: DataFrame) -> list[str]:
    """Folders of partition values, at most one each."""
    place = F.regexp_replace(F.input_file_name(), "/[^/]*$", "")
    found = _match(table.select(*parts, place.alias("__folder")), values, parts, "left_semi")
    return [r[0] for r in found.select("__folder").distinct().collect()]


def _plain(spark: SparkSession, uri: str) -> str:
    """A file name as Spark reports it has its special characters escaped."""
    return spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(uri)).toString()
