"""Publishing a table under its contract, and merging a batch into a published one.

``publish_version`` and ``upsert_version`` keep a table as numbered versions
(``refinery.sources.versions``): for tables that are read while they change, or written by
several. ``publish`` and ``upsert_table`` keep a plain folder, for consumers that know of no
versions, and want a single writer and no reader meanwhile.
"""

from __future__ import annotations

import contextvars
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DateType, StringType, StructField, StructType, TimestampType

from refinery.operators.checks import loses
from refinery.operators.quarantine import ACCEPTED, REJECTED, REJECTS, judged
from refinery.operators.cleaning import keep_one_per_key
from refinery.operators.in_place import IN_PLACE_ROWS, addressed, bits_of, chosen
from refinery.operators.fingerprint import as_table, fingerprint, observed
from refinery.schemas import BUSINESS_KEY, FINGERPRINT, PARTITION_COLUMNS
from refinery.session import CODEC, delete, file_system, temporary
from refinery.session import packed as materialize
from refinery.sources import versions
from refinery.sources.files import read_table, write_table
from refinery.sources.versions import MAIN, Version

# How Spark names the folder of a null partition value.
_NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"

#: The table of a version that holds its fingerprint, and of which columns that is.
MARK = "fingerprint"
MARKED = StructType([*FINGERPRINT.fields, StructField("columns", ArrayType(StringType()))])

#: Different values of the first key up to which a probe names them to the reader, which
#: then passes over row groups that hold none of them.
NAMED_KEYS = 1_000

#: Rows of a batch beyond which it is joined to the table as a whole: up to that its keys are
#: joined first, as they may be small enough to be sent to where the table is.
SMALL_BATCH = 1_000_000

#: Rows of a bucket up to which ``buckets_for`` adds no buckets.
BUCKET_ROWS = 500_000


def conform(df: DataFrame, contract: StructType, allow_undeclared: bool = False) -> DataFrame:
    """``df`` in the contract's columns, order and types, matched by name.

    Drift in names fails here. A value that does not cast or that a cast would change (a
    fraction to an integer, a time to a date), or a null in a required column, fails the job that writes the result: the test is part of its projection
    and costs no pass of its own.
    """
    missing = [c for c in contract.names if c not in df.columns]
    undeclared = [c for c in df.columns if c not in contract.names]
    if missing or (undeclared and not allow_undeclared):
        raise ValueError(f"columns missing: {missing}, undeclared: {undeclared}")
    return df.select(*[_checked(df, field).alias(field.name) for field in contract])


def _checked(df: DataFrame, field: StructField) -> Column:
    column = F.col(field.name)
    cast = column
    if df.schema[field.name].dataType != field.dataType:
        cast = column.try_cast(field.dataType)
        broken = F.raise_error(F.concat(F.lit(f"{field.name} does not cast: "), column.cast("string")))
        lost = loses(df.schema[field.name].dataType, column, cast)
        cast = F.when((cast.isNull() & column.isNotNull()) | lost, broken).otherwise(cast)
    if not field.nullable:
        cast = F.coalesce(cast, F.raise_error(F.lit(f"{field.name} is required")))
    return cast.cast(field.dataType)


@contextmanager
def replacing(spark: SparkSession, path: str) -> Iterator[str]:
    """A folder beside ``path`` to fill; when the block ends it takes the place of ``path``.

    If the block fails, the folder goes and ``path`` stays as it was. The old folder is
    moved aside first and deleted last; should the driver be lost between the two moves,
    the next ``replacing`` or ``restore`` brings the old one back.
    """
    restore(spark, path)
    staged, aside = f"{path}.staged-{uuid.uuid4().hex}", f"{path}.replaced"
    try:
        yield staged
    except BaseException:
        delete(spark, staged)
        raise
    system, at = file_system(spark, path)
    old, new = file_system(spark, aside)[1], file_system(spark, staged)[1]
    if system.exists(at):
        _move(system, at, old)
    _move(system, new, at)
    system.delete(old, True)
    spark.catalog.refreshByPath(path)


def restore(spark: SparkSession, path: str) -> None:
    """Bring back a table that was moved aside by a replacement that never ended."""
    system, at = file_system(spark, path)
    aside = file_system(spark, f"{path}.replaced")[1]
    if system.exists(aside):
        if system.exists(at):
            system.delete(aside, True)
        else:
            _move(system, aside, at)


def _move(system, source, target) -> None:
    if not system.rename(source, target):
        raise OSError(f"could not move {source.toString()} to {target.toString()}")


def publish(
    df: DataFrame, contract: StructType, path: str, partition_by: Sequence[str] = (), dealt: bool = False
) -> DataFrame:
    """Replace the table at ``path``, creating it if absent; returns the stored table.

    The new table is written beside the old one, which stays until all of it is there.
    ``dealt`` says that rows are brought together by partition already.
    """
    with replacing(df.sparkSession, path) as staged:
        write_table(conform(df, contract), staged, partition_by, dealt=dealt)
    return read_table(df.sparkSession, path, contract)


def publish_all(
    tables: Mapping[str, Callable[[], DataFrame]], contracts: Mapping[str, StructType], root: str
) -> dict[str, DataFrame]:
    """Build and store independent tables under ``root``, which is new, at the same time."""

    def one(name: str) -> DataFrame:
        df = tables[name]()
        write_table(conform(df, contracts[name]), f"{root}/{name}")
        return read_table(df.sparkSession, f"{root}/{name}", contracts[name])

    return at_once({name: lambda name=name: one(name) for name in tables})


def at_once(work: Mapping[str, Callable[[], DataFrame]]) -> dict[str, DataFrame]:
    """The results of independent functions that start Spark jobs, run side by side."""
    with ThreadPoolExecutor(len(work)) as pool:
        running = {k: pool.submit(contextvars.copy_context().run, f) for k, f in work.items()}
        return {name: result.result() for name, result in running.items()}


def publish_to_catalog(
    df: DataFrame, contract: StructType, table: str, partition_by: Sequence[str] = ()
) -> DataFrame:
    """As ``publish``, into a table of the session's catalog: a new table is filled under
    another name, which it then exchanges for that of the old one."""
    spark = df.sparkSession
    rows = conform(df, contract)
    if partition_by:
        rows = rows.hint("rebalance", *partition_by)
    mark = uuid.uuid4().hex
    staged, aside = f"{table}__staged_{mark}", f"{table}__replaced_{mark}"
    writer = rows.write.format("parquet").option("compression", CODEC)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    try:
        writer.saveAsTable(staged)
    except BaseException:
        spark.sql(f"DROP TABLE IF EXISTS {staged}")
        raise
    exists = spark.catalog.tableExists(table)
    if exists:
        spark.sql(f"ALTER TABLE {table} RENAME TO {aside}")
    try:
        spark.sql(f"ALTER TABLE {staged} RENAME TO {table}")
    except BaseException:
        if exists:
            spark.sql(f"ALTER TABLE {aside} RENAME TO {table}")
        raise
    if exists:
        spark.sql(f"DROP TABLE {aside}")
    return spark.table(table).select(*contract.names)


def buckets_for(df: DataFrame, least: int) -> int:
    """How many buckets a stored table needs, so that a task reads no more as it grows."""
    return max(least, -(-df.count() // BUCKET_ROWS))


def publish_bucketed(
    df: DataFrame, contract: StructType, table: str, bucket_by: str, buckets: int
) -> DataFrame:
    """As a table of the session's catalog, dealt to ``buckets`` by a hash of one column.

    Two tables that are bucketed alike are joined on that column without moving either. Rows
    are dealt out before they are written, so that a bucket is one sorted file, and an id
    with very many rows is in one task: for such ids join plain tables, which Spark splits.
    One task writes or reads a whole bucket, so name as many as the larger table needs
    (``buckets_for``).
    """
    rows = conform(df, contract).repartition(buckets, bucket_by)
    writer = rows.write.format("parquet").mode("overwrite").bucketBy(buckets, bucket_by)
    writer.option("compression", CODEC).sortBy(bucket_by).saveAsTable(table)
    return df.sparkSession.table(table).select(*contract.names)


def newest_of(
    existing: DataFrame, batch: DataFrame, keys: Sequence[str], order_by: str | None
) -> DataFrame:
    """The latest row of ``batch``, stored if there is an order, for each key, if ``existing`` has none that
    is later.

    Stored, as it is used twice. At equal times the batch counts as the later load.
    """
    if order_by is None:
        return materialize(keep_one_per_key(batch, keys), "newest")
    newest = keep_one_per_key(batch, keys, latest_by=order_by)
    held = existing.select(*keys, F.col(order_by).alias("_held"))
    if batch.count() > SMALL_BATCH:
        return _not_surpassed(newest, held, keys, order_by).select(*newest.columns)
    newest = materialize(newest, "newest")
    later = newest.join(held, list(keys)).filter(F.col("_held") > F.col(order_by))
    return newest.join(later.select(*keys), list(keys), "left_anti").select(*newest.columns)


def _not_surpassed(
    newest: DataFrame, held: DataFrame, keys: Sequence[str], order_by: str | None
) -> DataFrame:
    """The rows of ``newest`` (one per key) but those of which ``held`` has a later version in
    ``_held``, with the other columns of ``held``; stored. ``newest`` comes out of the shuffle
    that made it one row per key, so that only ``held`` is moved."""
    met = newest.join(held, list(keys), "left")
    if order_by is not None:
        met = met.filter(~F.coalesce(F.col("_held") > F.col(order_by), F.lit(False))).drop("_held")
    return materialize(met, "newest")


def upsert(
    existing: DataFrame,
    batch: DataFrame,
    keys: Sequence[str] = tuple(BUSINESS_KEY),
    order_by: str | None = "processed_at",
    stored: bool = False,
) -> DataFrame:
    """``existing`` with the latest rows of ``batch`` in place of those with the same key.

    The order is that of ``order_by``, over both; without it any row of the batch replaces.
    ``existing`` holds one row per key, so it only has to be probed: with a batch small
    enough to broadcast, which Spark decides by its size, the large table is not moved.
    ``stored`` says that ``existing`` is a stored Parquet table: then a large batch moves keys
    and addresses of both, and no rows.
    """
    if stored or order_by is not None:
        batch = materialize(batch, "batch")
    if stored and _in_place([existing], batch, order_by):
        untouched, newest, _ = merged_in_place([existing], batch, keys, order_by)
        return untouched[0].unionByName(newest).select(*existing.columns)
    newest = newest_of(existing, batch, keys, order_by)
    untouched = existing.join(newest, list(keys), "left_anti")
    return untouched.unionByName(newest).select(*existing.columns)


def _in_place(parts: Sequence[DataFrame], batch: DataFrame, order_by: str | None) -> bool:
    """Whether a stored batch is large, and it and the table are what ``merged_in_place`` takes."""
    times = [] if order_by is None else [rows.schema[order_by].dataType for rows in (*parts, batch)]
    if not all(isinstance(t, (TimestampType, DateType)) for t in times):
        return False
    in_all = batch.count()
    return in_all > SMALL_BATCH and in_all + sum(rows.count() for rows in parts) <= IN_PLACE_ROWS


def merged_in_place(
    parts: Sequence[DataFrame],
    batch: DataFrame,
    keys: Sequence[str],
    order_by: str | None,
    where: Column | None = None,
) -> tuple[list[DataFrame], DataFrame, list[str]]:
    """What ``batch`` leaves of the ``parts`` of a table, its latest rows that the table has no
    later version of, and the values of ``where`` among the rows that they replace. All are
    stored Parquet tables, projected or filtered, and so are read where they lie.

    Keys, times and addresses of both are moved. A key's row in the batch is known by its time;
    only rows that share it with others are moved, to be compared by all their columns.
    """

    def age(column: str) -> Column:
        return -F.unix_micros(F.col(column).cast("timestamp"))

    times = [] if order_by is None else [F.isnull(order_by).alias("_undated"), age(order_by).alias("_age")]
    first = F.min(F.struct(*times, "_file", "_row"))
    last = F.min(F.struct(*times, F.bitwise_not("_file").alias("_file"), F.bitwise_not("_row").alias("_row")))
    heads = addressed(batch).groupBy(*keys).agg(first.alias("_first"), last.alias("_last"))
    held = [
        addressed(part).select(
            *keys,
            *[age(c).alias("_held") for c in ([] if order_by is None else [order_by])],
            F.col("_file").alias("_old_file"),
            F.col("_row").alias("_old_row"),
            (F.lit(None).cast("string") if where is None else where).alias("_where"),
        )
        for part in parts
    ]
    met = heads.join(reduce(DataFrame.unionByName, held), list(keys), "left")
    later = F.lit(False) if order_by is None else F.coalesce(F.col("_held") < F.col("_first._age"), F.lit(False))
    alone = (F.col("_first._file") == F.bitwise_not("_last._file")) & (F.col("_first._row") == F.bitwise_not("_last._row"))
    met = met.select(
        *[F.when(~alone, F.col(key)).alias(key) for key in keys],
        alone.alias("_alone"),
        F.col("_first._file").alias("_file"),
        F.col("_first._row").alias("_row"),
        "_old_file",
        "_old_row",
        "_where",
        F.max(later).over(Window.partitionBy(*keys)).alias("_later"),
    )
    met = materialize(met, "newest").filter("NOT _later")

    newest = chosen(batch, bits_of(met.filter("_alone").select("_file", "_row")))
    shared = met.filter("NOT _alone").select(*[F.col(key).alias(f"_{i}") for i, key in enumerate(keys)])
    if not shared.isEmpty():
        same = reduce(Column.__and__, [F.col(key).eqNullSafe(F.col(f"_{i}")) for i, key in enumerate(keys)])
        found = addressed(batch).select(*keys, "_file", "_row").join(shared, same, "left_semi")
        several = chosen(batch, bits_of(found.select("_file", "_row")))
        newest = newest.unionByName(keep_one_per_key(several, keys, latest_by=order_by))
    replaced = met.filter(F.col("_old_row").isNotNull())
    gone = bits_of(replaced.select(F.col("_old_file").alias("_file"), F.col("_old_row").alias("_row")))
    left = [] if where is None else _values(replaced.select("_where"))
    return [chosen(part, gone, keep=False) for part in parts], newest, left


def probe(
    existing: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    order_by: str | None,
    where: Column,
    stored: DataFrame | None = None,
) -> tuple[DataFrame, list[str]]:
    """The rows of ``batch`` (one per key) that ``existing`` has no later version of, stored,
    and the values of ``where`` among the rows that they replace.

    One pass over the keys, times and folders of the table. The row groups that a small
    batch cannot meet are not read. ``stored`` is the table that ``batch`` was made one row per
    key from; beyond ``SMALL_BATCH`` rows of it the batch is not stored before it is joined.
    """
    stored = batch if stored is None else stored
    first = keys[0]
    values = _values(stored.select(first).distinct().limit(NAMED_KEYS + 1))
    if len(values) <= NAMED_KEYS:
        existing = existing.filter(F.col(first).isin(values))
    times = [] if order_by is None else [order_by]
    held = existing.select(*keys, *[F.col(c).alias("_held") for c in times], where.alias("_where"))
    if stored.count() > SMALL_BATCH:
        met = _not_surpassed(batch, held, keys, order_by)
        left = _values(met.filter(F.col("_where").isNotNull()).select("_where"))
        return met.select(*batch.columns), left
    if batch is not stored:
        batch = materialize(batch, "batch")
    later = F.lit(False) if order_by is None else F.col("_held") > F.col(order_by)
    met = batch.select(*keys, *times).join(held, list(keys))
    met = materialize(met.select(*keys, "_where", F.coalesce(later, F.lit(False)).alias("_later")), "met")
    newest = batch.join(met.filter("_later").select(*keys), list(keys), "left_anti").select(*batch.columns)
    return materialize(newest, "newest"), _values(met.filter("NOT _later").select("_where"))


def upsert_table(
    spark: SparkSession,
    path: str,
    contract: StructType,
    batch: DataFrame,
    keys: Sequence[str] = tuple(BUSINESS_KEY),
    partition_by: Sequence[str] = tuple(PARTITION_COLUMNS),
    order_by: str | None = "processed_at",
) -> DataFrame:
    """Merge ``batch`` into a partitioned table, rewriting only the partitions it touches.

    Those are the partitions the new rows go to and the ones their old versions leave;
    no other is read beyond its keys. The driver sees the folder names of the touched
    partitions, of which a table has few. Partition values are numbers or dates, whose
    folder name is their text.
    """
    with temporary(spark):
        existing = read_table(spark, path, contract)
        batch = materialize(conform(batch, contract), "batch")
        if _in_place([existing], batch, order_by):
            rest, newest, left = merged_in_place([existing], batch, keys, order_by, _folder(partition_by))
            touched = sorted({*left, *_values(newest.select(_folder(partition_by)))})
            untouched = rest[0].filter(_folder(partition_by).isin(touched))
        else:
            one = keep_one_per_key(batch, keys, latest_by=order_by)
            newest, left = probe(existing, one, keys, order_by, _folder(partition_by), batch)
            touched = sorted({*left, *_values(newest.select(_folder(partition_by)))})
            affected = existing.filter(_folder(partition_by).isin(touched))
            untouched = affected.join(newest, list(keys), "left_anti")
        merged = conform(untouched.unionByName(newest).select(*existing.columns), contract)
        staged = f"{path}.staged-{uuid.uuid4().hex}"
        try:
            write_table(merged, staged, partition_by)
            _replace_partitions(spark, path, staged, touched, merged.drop(*partition_by).schema)
        finally:
            delete(spark, staged)
    spark.catalog.refreshByPath(path)
    return read_table(spark, path, contract)


def _replace_partitions(
    spark: SparkSession, path: str, staged: str, touched: Sequence[str], schema: StructType
) -> None:
    """Move the partitions of ``staged`` over those of ``path``, one after the other. Of those
    touched, one that ``staged`` lacks is left without rows."""
    for folder in touched:
        system, old = file_system(spark, f"{path}/{folder}")
        new = file_system(spark, f"{staged}/{folder}")[1]
        if not system.exists(new):
            spark.createDataFrame([], schema).write.mode("overwrite").parquet(f"{path}/{folder}")
            continue
        system.delete(old, True)
        system.mkdirs(old.getParent())
        _move(system, new, old)


def publish_version(
    df: DataFrame,
    contract: StructType,
    path: str,
    partition_by: Sequence[str] = (),
    sort_by: Sequence[str] = (),
    bloom_filter: Sequence[str] = (),
    quarantine: bool = False,
    also: Mapping[str, DataFrame] | None = None,
    mark: Sequence[str] | bool = False,
) -> DataFrame:
    """Make ``df`` the next version of the table at ``path``; returns the stored table.

    With ``quarantine`` rows that break the contract are stored beside the others in the same
    job, with what is wrong with them, and ``read_rejects`` gives them; without it they fail
    the job. ``also`` names further tables of the same version. ``mark`` (all columns, or those
    named) takes the table's fingerprint in the writing job, for ``check_mark``.
    """
    spark = df.sparkSession
    if quarantine and mark:
        raise ValueError("the fingerprint of a split table would hold the rejects")

    def make(folder: str) -> versions.Tables:
        seen, watch = None, None
        if mark:
            columns = contract.names if mark is True else list(mark)

            def watch(rows: DataFrame) -> DataFrame:
                nonlocal seen
                rows, seen = observed(rows, columns)
                return rows

        tables = write_part(
            df, contract, path, folder, MAIN, partition_by, sort_by, bloom_filter, quarantine, watch
        )
        if mark:
            found = as_table(spark, seen).withColumn("columns", F.array(*map(F.lit, columns)))
            tables[MARK] = versions.appended(spark, path, versions.EMPTY, folder, found, MARK)
        for name, rows in (also or {}).items():
            tables[name] = versions.appended(spark, path, versions.EMPTY, folder, rows, name)
        return tables

    version = versions.replace(spark, path, make)
    return versions.read_version(spark, path, contract, version=version)


def write_part(
    df: DataFrame,
    contract: StructType,
    path: str,
    folder: str,
    name: str,
    partition_by: Sequence[str] = (),
    sort_by: Sequence[str] = (),
    bloom_filter: Sequence[str] = (),
    quarantine: bool = False,
    watch: Callable[[DataFrame], DataFrame] | None = None,
    dealt: bool = False,
) -> versions.Tables:
    """Write ``df`` to a data folder of a versioned path; what the version says of table ``name``.

    In quarantine accepted and rejected rows are two partitions of the one table that the job
    writes, and two tables of the version."""
    target = f"{folder}/{name}"
    if not quarantine:
        rows = conform(df, contract)
        write_table(rows, f"{path}/{target}", partition_by, sort_by=sort_by, bloom_filter=bloom_filter, watch=watch, dealt=dealt)
        return {name: {target: None}}
    parts = ["verdict", *partition_by]
    write_table(judged(df, contract), f"{path}/{target}", parts, sort_by=sort_by, bloom_filter=bloom_filter)
    tables = {}
    for table, verdict in ((name, ACCEPTED), (f"{name}.{REJECTED}", REJECTED)):
        part = f"{target}/verdict={verdict}"
        tables[table] = {part: None} if versions.exists(df.sparkSession, f"{path}/{part}") else {}
    return tables


def read_rejects(spark: SparkSession, path: str, table: str = MAIN) -> DataFrame:
    """What the newest version at ``path`` has refused: problems, and the record as JSON."""
    return versions.read_version(spark, path, REJECTS, f"{table}.{REJECTED}")


def check_mark(spark: SparkSession, path: str, contract: StructType) -> DataFrame:
    """One row: rows and digest of the newest version at ``path`` as it reads now, and whether
    they are those taken when it was written (null if none were)."""
    version = versions.current(spark, path) or versions.EMPTY
    taken = versions.read_version(spark, path, MARKED, MARK, version).first()
    rows = versions.read_version(spark, path, contract, version=version)
    found = fingerprint(rows, taken["columns"] if taken else None)
    same = F.lit(None).cast("boolean")
    if taken:
        same = (F.col("rows") == taken["rows"]) & (F.col("digest") == taken["digest"])
    return found.withColumn("as_written", same)


def upsert_version(
    spark: SparkSession,
    path: str,
    contract: StructType,
    batch: DataFrame,
    keys: Sequence[str] = tuple(BUSINESS_KEY),
    partition_by: Sequence[str] = tuple(PARTITION_COLUMNS),
    order_by: str | None = "processed_at",
    sort_by: Sequence[str] = (),
    bloom_filter: Sequence[str] = (),
    also: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """As ``upsert_table``, as the next version of the table at ``path``.

    The touched partitions are written to a new folder and the others stay where they are;
    the new version names both. Should another writer be quicker, the batch is merged again
    into what that one left. A plain folder is taken as the version before the first.
    """

    def make(base: Version, folder: str) -> versions.Tables:
        base = base if base.number else _adopted(spark, path)
        existing = versions.read_version(spark, path, contract, version=base)
        parts = versions.read_parts(spark, path, contract, version=base)
        in_place = bool(parts) and _in_place(parts, rows, order_by)
        if in_place:
            rest, newest, left = merged_in_place(parts, rows, keys, order_by, _folder(partition_by))
        else:
            one = keep_one_per_key(rows, keys, latest_by=order_by)
            newest, left = probe(existing, one, keys, order_by, _folder(partition_by), rows)
        held = {
            k: versions.partitions_of(spark, f"{path}/{k}", len(partition_by)) if v is None else v
            for k, v in base.folders().items()
        }
        touched = {*left, *_values(newest.select(_folder(partition_by)))}
        for old in sorted(held, key=lambda k: len(held[k]))[: max(0, len(held) + 1 - versions.MAX_FOLDERS)]:
            touched |= set(held[old])  # the smallest folders are written anew
        affected = _folder(partition_by).isin(sorted(touched))
        if in_place:
            untouched = reduce(DataFrame.unionByName, [part.filter(affected) for part in rest])
        else:
            untouched = existing.filter(affected).join(newest, list(keys), "left_anti")
        merged = untouched.unionByName(newest).select(*existing.columns)
        target = f"{folder}/{MAIN}"
        write_table(conform(merged, contract), f"{path}/{target}", partition_by, sort_by=sort_by, bloom_filter=bloom_filter)
        kept = {k: [p for p in v if p not in touched] for k, v in held.items()}
        kept[target] = versions.partitions_of(spark, f"{path}/{target}", len(partition_by))
        tables = {**base.tables, MAIN: {k: v for k, v in kept.items() if v}}
        tables.pop(MARK, None)  # it was that of the whole table before
        for name, more in (also or {}).items():
            tables[name] = versions.appended(spark, path, base, folder, more, name)
        return tables

    if not partition_by:
        raise ValueError("an upsert needs partitions, or it rewrites the whole table")
    with temporary(spark):
        rows = materialize(conform(batch, contract), "batch")
        version = versions.change(spark, path, make)
    return versions.read_version(spark, path, contract, version=version)


def _adopted(spark: SparkSession, path: str) -> Version:
    return Version(0, {MAIN: {"": None}}) if versions.exists(spark, path) else versions.EMPTY


def _folder(partition_by: Sequence[str]) -> Column:
    """The folder of a row's partition; a filter on it prunes partitions when planned."""
    parts = [
        F.concat(F.lit(f"{c}="), F.coalesce(F.col(c).cast("string"), F.lit(_NULL_PARTITION)))
        for c in partition_by
    ]
    return F.concat_ws("/", *parts)


def _values(one_column: DataFrame) -> list[str]:
    return [row[0] for row in one_column.distinct().collect()]
