"""Tables in key ranges: corrections merged by key, small files packed, pages found by a directory.

All three work on a versioned folder (``manifests``): the files that a change touches are rewritten, all others are
named again by the next version.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from cardmill.operators.paging import total_order
from cardmill.operators.sizing import MIB, output_partitions
from cardmill.session import materialize
from cardmill.sinks.manifests import DATA, file_names, latest_version, manifest, publish, read_files, write_files

FILE_MB = 128


def write_ranges(df: DataFrame, path: str, key: str, files: int | None = None) -> int:
    """Write ``df`` as a new version whose files hold ranges of ``key``, sorted; returns the version.

    ``key`` is not NULL and tells rows apart. Without ``files`` their number follows the size of what ``df`` reads.
    """
    spark = df.sparkSession
    before = latest_version(spark, path)
    parts = files or output_partitions(df, FILE_MB)
    ranged = df.repartitionByRange(parts, key).sortWithinPartitions(key)
    return publish(write_files(ranged, path, F.col(f"`{key}`")), path, before)


def range_place(value: Column, lows: Column) -> Column:
    """How many of the rising ``lows`` (an array) are at most ``value``: by halving, so a hundred thousand cost 17 steps."""
    bounds = F.struct(F.lit(0).alias("a"), F.size(lows).alias("b"))
    steps = F.sequence(F.lit(1), F.ceil(F.log2(F.size(lows) + 1)).cast("int") + 1)

    def halve(span: Column, _: Column) -> Column:
        middle = F.floor((span["a"] + span["b"]) / 2).cast("int")
        is_open = span["a"] < span["b"]
        right = is_open & (F.get(lows, middle) <= value)
        return F.struct(
            F.when(right, middle + 1).otherwise(span["a"]).alias("a"),
            F.when(is_open & ~right, middle).otherwise(span["b"]).alias("b"),
        )

    return F.aggregate(steps, bounds, halve)["a"]


def _ranges(files: DataFrame) -> DataFrame:
    """The files of a manifest, numbered from 1 in the order of their lowest key: one row a file."""
    return files.withColumn("place", F.row_number().over(Window.orderBy("low")).cast("int"))


def newest_by_key(corrections: DataFrame, key: str, newest_by: Sequence[str] = ()) -> DataFrame:
    """One row a key: the last by ``newest_by``, and by all columns where that leaves several."""
    rest = [c for c in corrections.columns if c not in (key, *newest_by)]
    order = F.struct(*[F.col(f"`{c}`") for c in (*newest_by, *rest)])
    last = corrections.groupBy(key).agg(F.max_by(F.struct("*"), order).alias("_row"))
    return last.select("_row.*").select(*[F.col(f"`{c}`") for c in corrections.columns])


def merge_corrections(
    spark: SparkSession, path: str, corrections: DataFrame, key: str, newest_by: Sequence[str] = ()
) -> int:
    """Rows of ``corrections`` replace rows with the same ``key``; new keys are added. Returns the new version.

    Only the files whose key range holds a correction are read and written again. A key between two ranges belongs to the
    lower file, one below all ranges to the first, so ranges stay apart. Of several corrections of a key the last
    by ``newest_by`` counts. Corrections without a key are an error. The changed rows of a file are written to as
    many files as its size asks for.
    """
    before = latest_version(spark, path)
    files = _ranges(manifest(spark, path, before))
    lows = files.agg(F.array_sort(F.collect_list("low")).alias("lows")).scalar()

    def placed(rows: DataFrame) -> DataFrame:
        # A subquery may not stand inside a higher-order function, so it becomes a column first.
        place = F.greatest(F.lit(1), range_place(F.col(key), F.col("_lows")))
        return rows.withColumn("_lows", lows).withColumn("_place", place).drop("_lows")

    known = F.when(F.col(key).isNull(), F.raise_error(F.lit(f"a correction has no {key}"))).otherwise(F.col(key))
    fixes = newest_by_key(corrections.withColumn(key, known), key, newest_by)
    fixes = materialize(placed(fixes), "corrections")
    hit = fixes.select(F.col("_place").alias("place")).distinct()
    names = file_names(files.join(hit, "place", "left_semi"))
    if not names:
        return before
    old = read_files(spark, path, names)
    columns = old.columns
    old = placed(old.join(fixes.select(key), key, "left_anti"))
    merged = old.unionByName(fixes).select(*[F.col(f"`{c}`") for c in columns], "_place")
    merged = merged.hint("rebalance", "_place").sortWithinPartitions("_place", key)
    new = write_files(merged, path, F.col(f"`{key}`"), split_by=["_place"])
    kept = files.join(hit, "place", "left_anti").select(*new.columns)
    return publish(kept.unionByName(new), path, before)


def pack(sizes: Sequence[tuple[str, int]], target: int) -> list[list[str]]:
    """Bins of names, the largest first and each into the first bin with room; files of at least ``target`` stay out."""
    bins: list[tuple[int, list[str]]] = []
    for name, size in sorted(sizes, key=lambda x: (-x[1], x[0])):
        if size >= target:
            continue
        for i, (used, names) in enumerate(bins):
            if used + size <= target:
                bins[i] = (used + size, [*names, name])
                break
        else:
            bins.append((size, [name]))
    return [names for _, names in bins]


def compact(
    spark: SparkSession,
    path: str,
    key: str,
    where: Column | None = None,
    target_bytes: int = FILE_MB * MIB,
    sort_by: Sequence[str] = (),
) -> int:
    """Pack small files, of those ``where`` selects from the manifest, into files of up to ``target_bytes``.

    ``key`` is the column whose range the manifest has. Each bin of two or more files becomes one file, written by one
    task and sorted by ``sort_by`` or else the key; all other files stay as they are. Returns the new version, or the current one if there is nothing to pack. Sizes are those of the compressed files, so that
    a packed file may come out smaller.
    """
    before = latest_version(spark, path)
    files = manifest(spark, path, before)
    small = files.where(F.col("n_bytes") < target_bytes)
    small = small if where is None else small.where(where)
    # Names and sizes of files; the listing of a scan is of the same size.
    bins = [names for names in pack([(r["file"], r["n_bytes"]) for r in small.collect()], target_bytes) if len(names) > 1]
    if not bins:
        return before
    number = {name: i for i, names in enumerate(bins) for name in names}
    packed = spark.createDataFrame(list(number.items()), "file string, _bin int")
    rows = read_files(spark, path, list(number))
    name = F.substring_index(F.col("_metadata.file_path"), f"/{DATA}/", -1)
    rows = rows.select("*", name.alias("file")).join(F.broadcast(packed), "file").drop("file")
    rows = rows.repartition(len(bins), "_bin").sortWithinPartitions("_bin", *(sort_by or [key]))
    new = write_files(rows, path, F.col(f"`{key}`"), split_by=["_bin"])
    kept = files.join(F.broadcast(packed), "file", "left_anti")
    return publish(kept.select(*new.columns).unionByName(new), path, before)


def write_pages(df: DataFrame, path: str, order_by: Sequence[str], files: int | None = None) -> int:
    """Write ``df`` in a total order, with a directory of its files: first and last key and the rows before each.

    The order is ``order_by`` (``"name"`` or ``"name desc"``) and all other columns behind it. Returns the version.
    """
    spark = df.sparkSession
    before = latest_version(spark, path)
    parts = files or output_partitions(df, FILE_MB)
    order = [F.col(f"`{n}`").desc() if down else F.col(f"`{n}`").asc() for n, down in total_order(df, order_by)]
    ranged = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    new = write_files(ranged, path, F.col(f"`{order_by[0].split()[0]}`"))
    # Spark numbers files by the range that they hold.
    part = F.regexp_extract("file", r"part-(\d+)", 1).cast("int")
    upto = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    return publish(new.withColumn("rows_before", F.coalesce(F.sum("n_rows").over(upto), F.lit(0))), path, before)


def page_by_directory(
    spark: SparkSession, path: str, page: int, size: int, version: int | None = None
) -> DataFrame:
    """A page of a table written by ``write_pages``: the directory names the files that hold it, and the places in them.

    No other file is opened, nothing is counted, and what is sorted is the page.
    """
    if page < 1 or size < 1:
        raise ValueError("page and size must be at least 1")
    first, files = (page - 1) * size, manifest(spark, path, version)
    holds = (F.col("rows_before") < first + size) & (F.col("rows_before") + F.col("n_rows") > first)
    hit = {r["file"]: r["rows_before"] for r in files.where(holds).select("file", "rows_before").collect()}
    if not hit:
        return read_files(spark, path, file_names(files.limit(1))).limit(0)
    rows = read_files(spark, path, sorted(hit))
    name = F.substring_index(F.col("_metadata.file_path"), f"/{DATA}/", -1)
    starts = F.create_map(*[F.lit(x) for pair in hit.items() for x in pair])
    at = starts[name] + F.col("_metadata.row_index")
    columns = rows.columns
    return rows.withColumn("_at", at).where(F.col("_at").between(first, first + size - 1)).orderBy("_at").select(*columns)
