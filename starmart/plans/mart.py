"""Building the mart: one table from its recipe, the code tables, the whole run."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DataType, IntegerType, LongType, StringType, StructType

from ..contracts import CONTRACTS, TableContract
from ..functions import cast_column, day_number_to_date, sas_day_number, to_date
from ..operators.keys import number_staged, tag_rows, tagged_counts
from ..operators.rows import dedupe, dedupe_in_ranges, distinct_rows, drop_missing, frequent_keys, in_range, missing_counts
from ..quality.checks import report_row
from ..quality.report import check_mart
from ..session import enough_partitions, new_path, path_exists, remove_path, shuffles_dropped, stored_bytes
from ..sinks.aligned import layout_of, write_aligned
from ..sinks.stage import drop_steps, stage
from ..sinks.tables import refresh_partitions, write_table
from ..sinks.versions import current_version, publish
from ..sources.files import land, land_apart, read_source, read_table, source_path, stored_schema
from ..sources.labels import LABEL_SECTIONS, label_rejects, parse_labels, read_lines
from .recipes import FACT, RECIPES, Recipe
from .refresh import Change, merge_aligned, merge_batch, merge_version

_OK = "__ok"
_BAD = "__bad"


class QualityError(RuntimeError):
    """A check that a run was told to stop at has failed; the report is written."""


@dataclass
class Built:
    """A written table and what became of its source rows."""

    contract: TableContract
    path: str
    counts: dict[str, int] = field(default_factory=dict)
    missing: dict[str, int] = field(default_factory=dict)
    quarantine: str | None = None
    bad_keys: str | None = None
    change: Change | None = None

    def read(self, spark: SparkSession) -> DataFrame:
        return read_table(spark, self.path, schema=self.contract.schema)

    def written_schema(self, spark: SparkSession) -> StructType:
        """The types found in the files; a partition column is text in a path and has the contract's."""
        by_path = self.contract.partition_by
        return StructType([
            self.contract.schema[f.name] if f.name in by_path else f
            for f in stored_schema(spark, self.path).fields
        ])

    @property
    def balanced(self) -> bool:
        gone = sum(n for step, n in self.counts.items() if step not in ("read", "written"))
        return self.counts["read"] - gone == self.counts["written"]

    def report_rows(self) -> list[tuple]:
        name = self.contract.name
        rows = [(name, "rows", step, n, "ok") for step, n in self.counts.items()]
        rows += [(name, "missing", c, n, "ok") for c, n in self.missing.items()]
        status = "ok" if self.balanced else "failed"
        return [*rows, (name, "row_balance", "", int(not self.balanced), status)]


def typed_columns(
    recipe: Recipe, df: DataFrame, date_policy: str, keep_raw: bool = False
) -> DataFrame:
    """The recipe's columns under their table names and contract types.

    Dates listed in ``late_dates`` stay text until the missing values are out.
    ``keep_raw`` adds each source value as ``raw_<name>``.
    """
    out = []
    for source, name in recipe.columns.items():
        c = F.col(f"`{source}`")
        found = df.schema[source].dataType
        if keep_raw:
            out.append(c.alias(f"raw_{name}"))
        if name in recipe.sas_dates:
            c = sas_day_number(c, found, date_policy)
        elif name in recipe.late_dates:
            c = c.cast(StringType())
        else:
            c = cast_column(c, found, recipe.contract.type_of(name))
        out.append(c.alias(name))
    typed = df.select(*out)
    # a step of its own, so that a day number is parsed once and not per use
    return typed.withColumns({c: day_number_to_date(c) for c in recipe.sas_dates})


def _is_bad_key(raw: Column, found: DataType, typed: Column) -> Column:
    """A key that is present but not held by the column's type without loss; blank text is a missing one."""
    present = F.trim(raw) != "" if isinstance(found, StringType) else raw.isNotNull()
    exact = raw.try_cast("decimal(38,10)")
    lossy = exact != typed.cast("decimal(38,10)")
    if isinstance(found, StringType):
        # text of at most 15 characters without letters is the number when its double is, and needs no decimals
        plain = (F.length(raw) <= 15) & (F.upper(raw) == F.lower(raw))
        same = F.when(plain & typed.isNotNull(), raw).try_cast("double") == typed.cast("double")
        lossy = F.when(same, F.lit(False)).otherwise(lossy)
    return F.coalesce(present & (typed.isNull() | lossy), F.lit(False))


def split_bad_keys(
    df: DataFrame, recipe: Recipe, date_policy: str, folder: str | None = None
) -> tuple[DataFrame, DataFrame | None]:
    """The typed rows, and apart from them those whose key is no number of its type, with the key as text.

    Without this all such rows would share the key NULL, and one of them would stand for all. The typed rows are
    stored, so that ``df`` is read and its text parsed once; a raw key is kept of the bad rows alone.
    """
    name = f"typed-{recipe.name}"
    numbers = {
        name: source for source, name in recipe.columns.items()
        if name in recipe.key and isinstance(recipe.contract.type_of(name), (IntegerType, LongType))
    }
    if not numbers:
        return stage(typed_columns(recipe, df, date_policy), name, folder), None
    both = typed_columns(recipe, df, date_policy, keep_raw=True)
    bad = F.lit(False)
    for n, source in numbers.items():
        bad = bad | _is_bad_key(F.col(f"raw_{n}"), df.schema[source].dataType, F.col(n))
    names = list(recipe.columns.values())
    both = both.withColumn(_BAD, bad)
    raw = [F.when(F.col(_BAD), F.col(f"raw_{n}").cast("string")).alias(f"raw_{n}") for n in numbers]
    both = stage(both.select(*names, *raw, _BAD), name, folder)
    shown = [F.col(f"raw_{n}").alias(n) if n in numbers else F.col(n) for n in names]
    return both.filter(~F.col(_BAD)).select(*names), both.filter(_BAD).select(*shown)


def check_casts(df: DataFrame, recipe: Recipe, date_policy: str = "lenient") -> DataFrame:
    """Report rows: source values per column that its contract type cannot hold. One scan."""
    both = typed_columns(recipe, df, date_policy, keep_raw=True)
    both = both.withColumns({c: to_date(c) for c in recipe.late_dates})
    names = list(recipe.columns.values())
    lost = both.agg(*[
        F.count_if(F.col(f"raw_{c}").isNotNull() & F.col(c).isNull()).alias(c) for c in names
    ])
    return lost.select(F.inline(F.array(*[
        report_row(recipe.name, "cast", c, F.col(c)) for c in names
    ])))


def _complete(columns: Iterable[str]) -> Column:
    ok = F.lit(True)
    for c in columns:
        ok = ok & F.col(c).isNotNull()
    return ok


def _reduce(df: DataFrame, recipe: Recipe) -> DataFrame:
    if "dedupe" in recipe.cleaning:
        return dedupe(df, recipe.key, prefer_complete=recipe.critical)
    return distinct_rows(df)


def _reduce_in_order(df: DataFrame, recipe: Recipe, n_rows: int) -> DataFrame:
    """As :func:`_reduce` for stored rows with a key of one number, in ranges of it; complete rows first in each partition."""
    key = recipe.key[0]
    found = dedupe_in_ranges(df, key, frequent_keys(df, key, n_rows), prefer_complete=recipe.critical)
    found = found.withColumn(_OK, _complete(recipe.critical))
    # one number to sort by, which takes no comparison of rows
    return found.sortWithinPartitions(F.when(F.col(_OK), F.col(key)).asc_nulls_last())


def _finish(df: DataFrame, recipe: Recipe) -> DataFrame:
    """Derived columns that need no row to be compared."""
    changed = {c: to_date(c) for c in recipe.late_dates} | {c: F.upper(c) for c in recipe.upper}
    if changed:
        df = df.withColumns(changed)
    added = {c: F.lit(v) for c, v in recipe.constants.items()}
    if recipe.calendar_of:
        added |= {"year": F.year(recipe.calendar_of), "month": F.month(recipe.calendar_of)}
    return df.withColumns(added) if added else df


def build_table(
    df: DataFrame,
    recipe: Recipe,
    path: str,
    ids: str = "dense",
    date_policy: str = "lenient",
    reject_bad_dates: bool = False,
    quarantine: str | None = None,
    folder: str | None = None,
    refresh: bool = False,
    versioned: bool = False,
    malformed: int | None = None,
    keyless_apart: bool = False,
    buckets: int | None = None,
) -> Built:
    """Clean ``df`` by the recipe, write the table to ``path`` and count every row's fate.

    ``df`` is read once and stored with its types. The rows of a frequent key, or of a missing one, are reduced before the
    shuffle. The reduced rows are stored once, all later steps read that copy: counts are exact whatever was retried,
    ids do not change, and nothing is parsed or shuffled a second time. ``dense`` ids need the stored copy in key
    order: rows are then shuffled by ranges of the key, and ordered and reduced there; ``sparse`` ones need no order.
    With ``refresh`` the rows are merged into the table found at ``path`` (see :func:`merge_batch` and, for
    one kept as versions, :func:`merge_version`), and ``written`` counts those of this batch. ``versioned``
    writes a new version; a table kept as versions stays one. ``malformed`` is the number of source lines that were
    set apart before. With ``keyless_apart`` rows without a key are set apart before rows are compared: each is
    counted as missing and goes to quarantine, where otherwise one stands for all and the others count as removed.
    With ``buckets`` the table is written in so many hash buckets of its key (see :mod:`starmart.sinks.aligned`); a table in
    buckets keeps their number, and a refresh of it adds a part.
    """
    if buckets and (versioned or len(recipe.key) != 1 or recipe.key[0] not in recipe.critical):
        raise ValueError("buckets need a key of one column without gaps, and no versions")
    if ids not in ("dense", "sparse"):
        raise ValueError(f"unknown kind of ids {ids!r}")
    contract, built = recipe.contract, Built(recipe.contract, path)
    spark = df.sparkSession
    counts = built.counts
    rows, bad_rows = split_bad_keys(df, recipe, date_policy, folder)
    n_rows = rows.count() + (bad_rows.count() if bad_rows is not None else 0)
    counts["read"] = n_rows + (malformed or 0)
    if malformed is not None:
        counts["malformed"] = malformed
    if recipe.only:
        column, values = recipe.only
        rows = rows.filter(F.col(column).isin(*values))
        bad_rows = bad_rows.filter(F.col(column).isin(*values)) if bad_rows is not None else None
    if bad_rows is not None and quarantine:
        # stored, so that keys are parsed once for the count and the quarantine
        bad_rows = stage(bad_rows, f"bad-keys-{recipe.name}", folder)
    counts["bad_keys"] = bad_rows.count() if bad_rows is not None else 0

    missing_first = recipe.cleaning[0] == "missing"
    if missing_first or recipe.only:
        # one pass over the critical columns
        first = rows.agg(F.count(F.lit(1)).alias("__n"), *missing_counts(recipe.critical)).first()
        counts["filtered"] = n_rows - counts["bad_keys"] - first["__n"]
    else:
        counts["filtered"] = 0
    if missing_first:
        built.missing = {c: first[c] for c in recipe.critical}
        rejected = rows.filter(~_complete(recipe.critical))
        rows = drop_missing(rows, recipe.critical)

    lacking = [c for c in recipe.key if c in recipe.critical] if keyless_apart and not missing_first else []
    keyless = None
    if lacking:
        keyless = rows.filter(~_complete(lacking))
        without_key = keyless.agg(*missing_counts(lacking)).first()
        rows = drop_missing(rows, lacking)

    name = f"cleaned-{recipe.name}"
    one_number = (
        "dedupe" in recipe.cleaning and len(recipe.key) == 1 and recipe.key[0] in recipe.critical
        and isinstance(contract.type_of(recipe.key[0]), (IntegerType, LongType))
    )
    if contract.id_column and ids == "dense" and one_number:
        staged = stage(tag_rows(_reduce_in_order(rows, recipe, n_rows), None), name, folder)
    elif contract.id_column:
        reduced = _reduce(rows, recipe).withColumn(_OK, _complete(recipe.critical))
        order = [F.col(_OK).desc(), *recipe.key] if ids == "dense" else None
        staged = stage(tag_rows(reduced, order, order_is_unique=bool(recipe.key)), name, folder)
    else:
        staged = stage(_reduce(rows, recipe).withColumn(_OK, _complete(recipe.critical)), name, folder)

    # the typed rows are read no more, once those for the quarantine are apart
    if missing_first and quarantine:
        rejected = stage(rejected, f"missing-{recipe.name}", folder)
    if keyless is not None and quarantine:
        keyless = stage(keyless, f"keyless-{recipe.name}", folder)
    drop_steps(spark, folder, f"typed-{recipe.name}")

    totals = [F.count(F.lit(1)).alias("__n"), *missing_counts(recipe.critical)]
    by_part = None
    if contract.id_column and ids == "dense":
        # by sort partition, so that one pass serves the counts and the ids
        by_part = stage(tagged_counts(staged, F.count_if(_OK).alias(_OK), *totals), f"counts-{recipe.name}", folder)
        totals = [F.coalesce(F.sum(f"`{c}`"), F.lit(0)).alias(c) for c in ("__n", *recipe.critical)]
    after = (staged if by_part is None else by_part).agg(*totals).first()
    if not missing_first:
        built.missing = {c: after[c] for c in recipe.critical}
        rejected = staged.filter(~F.col(_OK))
    if keyless is not None:
        built.missing |= {c: without_key[c] for c in lacking}  # none of the reduced rows lacks them
        rejected = rejected.unionByName(keyless, allowMissingColumns=True)
    counts["missing"] = sum(built.missing.values())
    entered = n_rows - counts["bad_keys"] - counts["filtered"] - (counts["missing"] if missing_first else 0)
    counts["removed"] = entered - after["__n"] - (sum(without_key) if keyless is not None else 0)

    good = staged.filter(F.col(_OK))
    kept, layout = current_version(spark, path), layout_of(spark, path)
    merges = refresh and (layout is not None or kept is not None or path_exists(spark, path))
    # reduced to one row for each key, none missing, so a merge reads the stored rows as they are
    clean = bool(recipe.key) and "dedupe" in recipe.cleaning and set(recipe.key) <= set(recipe.critical)
    if contract.id_column and merges:
        good = good.withColumn(contract.id_column, F.lit(None).cast("long"))  # the merge gives ids
    elif contract.id_column:
        # complete rows come first in each partition, so the ids count them alone
        known = by_part.select("__part", F.col(_OK).alias("__n")) if by_part is not None else None
        good = number_staged(good, contract.id_column, dense=ids == "dense", counts=known)
    finished = _finish(good, recipe)
    counts["bad_dates"] = 0
    if reject_bad_dates and recipe.late_dates:
        bad = F.lit(False)
        for c in recipe.late_dates:
            bad = bad | to_date(c).isNull()
        counts["bad_dates"] = good.filter(bad).count()
        rejected = rejected.unionByName(good.filter(bad), allowMissingColumns=True)
        finished = drop_missing(finished, recipe.late_dates)
    if merges and layout is not None:
        built.change = merge_aligned(finished.select(*contract.columns), path, contract, recipe.key, folder, clean)
        counts |= built.change.counts
    elif layout is not None or (buckets and not refresh):
        dealt = layout.buckets if layout is not None else buckets
        counts["written"] = write_aligned(finished.select(*contract.columns), path, recipe.key[0], dealt, contract.id_column)
    elif merges and kept is not None:
        built.change = merge_version(finished.select(*contract.columns), path, contract, recipe.key, folder, clean)
        counts |= built.change.counts
    elif versioned or kept is not None:
        first = (recipe.key or [c for c in contract.columns if c != contract.id_column])[0]
        publish(finished.select(*contract.columns), path, first, contract.partition_by, contract.id_column, since=kept)
        counts["written"] = built.read(spark).count()
    elif merges:
        counts |= merge_batch(finished.select(*contract.columns), path, contract, recipe.key, folder, clean)
    else:
        write_table(finished.select(*contract.columns), path, contract.partition_by)
        counts["written"] = built.read(spark).count()

    if quarantine:
        # written even when empty, so that nothing of an earlier run stays behind
        rejected.select(*recipe.columns.values()).write.mode("overwrite").parquet(quarantine)
        built.quarantine = quarantine
        if bad_rows is not None:
            built.bad_keys = f"{quarantine}_bad_keys"
            bad_rows.write.mode("overwrite").parquet(built.bad_keys)
    if built.change is None or contract.id_column:
        # without ids the rows of a change are those of the batch
        drop_steps(spark, folder, *(f"{step}-{recipe.name}" for step in ("cleaned", "counts", "missing", "keyless")))
    return built


def build_labels(
    spark: SparkSession, path: str, dst: str, sections: Mapping = LABEL_SECTIONS,
    folder: str | None = None,
) -> dict[str, Built]:
    """The code tables of one label file (or several: later files replace earlier ones)."""
    lines = read_lines(spark, path, folder)
    out = {}
    for name, section in sections.items():
        built = Built(CONTRACTS[name], f"{dst}/{name}")
        write_table(parse_labels(lines, section), built.path)
        in_section = in_range(lines, "pos", section.start, section.stop)
        n_lines, n_rejects = in_section.count(), label_rejects(lines, section).count()
        written = built.read(spark).count()
        built.counts = {
            "read": n_lines, "filtered": n_rejects, "missing": 0, "bad_dates": 0,
            "removed": n_lines - n_rejects - written, "written": written,
        }
        out[name] = built
    return out


def run(
    spark: SparkSession,
    src: str,
    dst: str,
    tables: Iterable[str] | None = None,
    formats: Mapping[str, str] | None = None,
    paths: Mapping[str, str] | None = None,
    recipes: Mapping[str, Recipe] = RECIPES,
    countries: Iterable[str] | None = ("United States",),
    ids: str = "dense",
    date_policy: str = "lenient",
    reject_bad_dates: bool = False,
    checks: bool = True,
    parallel: int = 3,
    source_options: Mapping[str, Mapping] | None = None,
    keep_steps: bool = False,
    fail_on: Iterable[str] = (),
    mode: str = "overwrite",
    versioned: bool = False,
    lines_apart: bool = False,
    keyless_apart: bool = False,
    aligned: int | None = None,
) -> dict[str, Built]:
    """Build the whole mart, or the named tables of it, below ``dst``.

    ``src`` is a base path under which the default file names are looked up; ``paths`` gives
    other locations per source and ``formats`` other formats (``sas`` for the arrivals' binary
    files, ``parquet`` for landed ones), ``source_options`` further arguments of the reader, such
    as ``{"airport": {"null_values": ["NA"]}}``. ``countries=None`` keeps all temperatures. Rows
    dropped for missing values go to ``dst/quarantine/<table>``, rows whose key is present but no number
    of its type to ``dst/quarantine/<table>_bad_keys``; the counts and, with
    ``checks``, the report of all quality checks to ``dst/qc_report``, where each table's rows
    replace those of its last run and other tables' stay. Foreign keys are checked against tables
    of this run or, where it does not build the parent, an earlier one. When a check named in
    ``fail_on`` (such as ``primary_key_unique``) has failed, :class:`QualityError` is raised after that. With
    ``mode="refresh"`` the sources are a batch that is merged into the tables at ``dst`` by key; code tables are
    always written anew from their one file, and quarantine and report describe the batch. ``versioned`` keeps the tables
    of the recipes as versions (see :mod:`starmart.sinks.versions`): readers see the old one until the new one is whole. With ``lines_apart`` the lines
    of a CSV source that have more or fewer cells than its header are counted as ``malformed`` by its tables and go as they are to
    ``dst/quarantine/<source>_lines``; ``keyless_apart`` is that of :func:`build_table`. With
    ``aligned`` the tables keyed by the arrival number are written in so many hash buckets of it instead of folders, and join
    without a shuffle; take the partitions that ``conf_for`` gives for their size. Sources and tables do not
    depend on each other: up to ``parallel`` are worked on at a time, which fills the cluster
    while the last tasks of one finish. The stored steps are removed when no later one reads them, the last when all is written; with
    ``keep_steps`` those stay that a table's ``change`` or quarantine is read from. A run that fails leaves what it has.
    """
    if mode not in ("overwrite", "refresh"):
        raise ValueError(f"unknown mode {mode!r}")
    folder = new_path(spark, "run")
    dst = dst.rstrip("/")
    wanted = set(CONTRACTS) if tables is None else set(tables)
    if unknown := wanted - set(CONTRACTS):
        raise ValueError(f"unknown tables {sorted(unknown)}")
    formats, paths = dict(formats or {}), dict(paths or {})
    recipes = dict(recipes)
    if "dim_temperature" in recipes:
        only = ("country", tuple(countries)) if countries is not None else None
        recipes["dim_temperature"] = replace(recipes["dim_temperature"], only=only)

    def location(name: str) -> str:
        default = "immigration_sas" if name == "immigration" and formats.get(name) == "sas" else name
        return paths.get(name) or source_path(src, default)

    def source(name: str) -> DataFrame:
        fmt = formats.get(name, "csv")
        options = {"sep": ";"} if name == "demography" and fmt == "csv" else {}
        options |= (source_options or {}).get(name, {})
        used = list(dict.fromkeys(c for r in todo if r.source == name for c in r.columns))
        if lines_apart and fmt == "csv":
            whole, lines = land_apart(spark, location(name), used, name, folder, **options)
            lines.write.mode("overwrite").parquet(f"{dst}/quarantine/{name}_lines")
            malformed[name] = lines.count()
            return whole
        df = read_source(spark, location(name), fmt, **options)
        absent = [c for c in used if c not in df.columns]
        if absent:
            raise ValueError(f"source {name} lacks the columns {absent}")
        if fmt == "parquet" or not checks and sum(r.source == name for r in todo) == 1:
            return df  # its one table reads it once
        return land(df, used, name, folder)

    todo = [r for r in recipes.values() if r.name in wanted]
    malformed: dict[str, int] = {}  # by source, filled before its tables are built
    sections = {k: v for k, v in LABEL_SECTIONS.items() if k in wanted}

    def labels() -> dict[str, Built]:
        if not sections:
            return {}
        path = paths.get("labels") or source_path(src, "labels")
        return build_labels(spark, path, dst, sections, folder)

    def table(recipe: Recipe) -> Built:
        return build_table(
            sources[recipe.source], recipe, f"{dst}/{recipe.name}", ids, date_policy,
            reject_bad_dates, f"{dst}/quarantine/{recipe.name}", folder, mode == "refresh", versioned,
            malformed.get(recipe.source), keyless_apart, aligned if recipe.key == FACT.key else None,
        )

    names = list(dict.fromkeys(r.source for r in todo))
    size = sum(stored_bytes(spark, location(n)) for n in names)
    with enough_partitions(spark, size), shuffles_dropped(spark), ThreadPoolExecutor(parallel) as pool:
        code_tables = pool.submit(labels)
        sources = dict(zip(names, pool.map(source, names)))
        made = dict(zip([r.name for r in todo], pool.map(table, todo))) | code_tables.result()
    built = {name: made[name] for name in CONTRACTS if name in made}

    report = spark.createDataFrame(
        [row for b in built.values() for row in b.report_rows()],
        "table_name string, check_name string, column_name string, value bigint, status string",
    )
    if checks:
        for recipe in todo:
            report = report.unionByName(check_casts(sources[recipe.source], recipe, date_policy))
        report = report.unionByName(check_mart(
            {n: b.read(spark) for n, b in built.items()},
            written={n: b.written_schema(spark) for n, b in built.items()},
            parents={
                n: read_table(spark, f"{dst}/{n}", schema=c.schema)
                for n, c in CONTRACTS.items() if n not in built and path_exists(spark, f"{dst}/{n}")
            },
        ))
    refresh_partitions(report.coalesce(1), f"{dst}/qc_report", ["table_name"])
    if not keep_steps:
        remove_path(spark, folder)
    if fail_on := list(fail_on):
        found = spark.read.parquet(f"{dst}/qc_report").filter(
            F.col("table_name").isin(*built) & F.col("check_name").isin(*fail_on) & (F.col("status") == "failed")
        )
        failed = found.sort("table_name", "check_name", "column_name").collect()  # at most one row per check
        if failed:
            raise QualityError("; ".join(f"{r.table_name}: {r.check_name} {r.column_name} ({r.value})" for r in failed))
    return built
