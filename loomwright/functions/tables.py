"""Written steps, row ids that hold across reads, exact global ranks and quantiles without a single-task sort."""

from __future__ import annotations

import tempfile
import uuid
from urllib.parse import urlsplit

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Low bits of monotonically_increasing_id that count rows of a partition (fixed by Spark).
ROW_BITS = 33
#: Low bits of a row id that count rows of a file; the bits above number the files.
FILE_ROW_BITS = 40


def shared_dir(spark: SparkSession) -> str:
    """Folder for written steps: spark.checkpoint.dir where it is set; else the warehouse, and only in local mode a temporary folder.

    On a cluster a warehouse in the machines' own folders is refused: each executor would write to its own disk.
    """
    if named := spark.conf.get("spark.checkpoint.dir", None):
        return named.rstrip("/")
    sc = spark.sparkContext
    if (known := sc.getCheckpointDir()) is not None:
        return known.rstrip("/")
    if sc.master == "local" or sc.master.startswith("local["):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="loomwright-"))
        return sc.getCheckpointDir().rstrip("/")
    return _on_all_machines(spark.conf.get("spark.sql.warehouse.dir")).rstrip("/") + "/loomwright-steps"


def _on_all_machines(folder: str) -> str:
    if urlsplit(folder).scheme in ("", "file"):
        raise ValueError(f"{folder} may be another folder on each machine: set spark.checkpoint.dir to one that all of them share")
    return folder


def written(df: DataFrame) -> DataFrame:
    """``df`` as Parquet in the shared folder, read back: a lost executor costs no recomputation, and nothing before it is computed twice."""
    path = f"{shared_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def quoted(name: str) -> Column:
    """The column of that name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while stem.lower() in taken:
        stem = f"_{stem}"
    return stem


def plain_scan(df: DataFrame) -> bool:
    """True where ``df`` is one scan of files under projections and filters of deterministic expressions: each read gives the same rows."""

    def plain(node) -> bool:
        kids = node.children()
        if kids.size() == 0:
            return node.nodeName() == "LogicalRelation"
        return node.nodeName() in ("Project", "Filter", "SubqueryAlias") and node.deterministic() and kids.size() == 1 and plain(kids.apply(0))

    return plain(df._jdf.queryExecution().analyzed())


def _located(df: DataFrame, path: str, place: str) -> DataFrame:
    where = df.metadataColumn("_metadata")
    return df.select("*", where["file_path"].alias(path), where["row_index"].alias(place))


def settled(df: DataFrame) -> DataFrame:
    """``df`` itself where it is a plain scan of files that know their row numbers (Parquet), else a written copy with the same columns."""
    if plain_scan(df):
        try:
            _located(df, fresh(df, "path"), fresh(df, "place"))
            return df
        except AnalysisException:  # files of another kind
            pass
    plain = written(df.toDF(*(f"c{k}" for k in range(len(df.columns)))))  # Parquet takes no odd or repeated names
    return plain.toDF(*df.columns)


def with_row_ids(df: DataFrame, name: str) -> DataFrame:
    """``df`` with a long that identifies each row and is the same in every read, however the files are split over tasks.

    The id is the number of the row's file, in the order of paths, and the
    row's place in it. The driver lists the files for the scan anyway; rows
    find their file's number by a hash of the path in a broadcast of 16
    bytes a file, so no row is moved. Two calls agree where both get the
    same settled table (:func:`settled`).
    """
    df = settled(df)
    path, place, key, number = (fresh(df, f"{name}_{x}") for x in ("path", "place", "key", "file"))
    rows = _located(df, path, place).withColumn(key, F.xxhash64(path)).drop(path)
    found = rows.join(F.broadcast(_file_numbers(df, key, number)), key, "left")
    known = F.when(F.col(number).isNull(), F.raise_error(F.lit("a row's file is none of those listed for the scan")).cast("long")).otherwise(F.col(number))
    return found.withColumn(name, F.shiftleft(known, FILE_ROW_BITS) + F.col(place)).select(*(quoted(c) for c in df.columns), name)


def _file_numbers(df: DataFrame, key: str, number: str) -> DataFrame:
    """Hash of each file's path, with and without an empty authority, and its number in the order of paths, for the files that the driver has listed."""
    files = sorted(set(df.inputFiles()))
    spelt = {x: k for k, path in enumerate(files) for x in (path.replace(":///", ":/", 1), path)}
    listed = df.sparkSession.createDataFrame(pa.table({"path": pa.array(list(spelt), pa.string()), number: pa.array(list(spelt.values()), pa.int64())}))
    hashed = listed.select(F.xxhash64("path").alias(key), number).toArrow()
    if len(pc.unique(hashed[key])) < hashed.num_rows:
        raise ValueError("two files' paths share a 64-bit hash: write the table anew")
    return df.sparkSession.createDataFrame(hashed)


def with_rank(df: DataFrame, order: list[Column], name: str, first: int = 1) -> DataFrame:
    """Global row number in ``order`` from ``first`` on: a range sort, then one offset for each partition.

    Only one count per partition is gathered, never the rows. ``order`` must
    be total for the ranks to be the same in each run. The range sort reads
    its input twice, so what is not yet a table is written first.
    """
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    part, start = fresh(df, "_part"), fresh(df, "_start")
    df = df if plain_scan(df) else written(df)
    done = written(df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn(name, F.monotonically_increasing_id()))
    of = F.shiftright(F.col(name), ROW_BITS)
    rows, at = [], first
    for p, m in sorted((r[0], r[1]) for r in done.groupBy(of.alias("p")).count().collect()):
        rows.append((p, at))
        at += m
    offsets = F.broadcast(spark.createDataFrame(rows, f"{part} long, {start} long"))  # a row for each partition
    return done.join(offsets, of == F.col(part)).withColumn(name, F.col(start) + F.col(name).bitwiseAND((1 << ROW_BITS) - 1)).drop(part, start)


def quantiles(df: DataFrame, column: str, points: list[float]) -> list[float] | None:
    """Exact interpolated quantiles of a whole column; None without values."""
    values = df.select(F.col(column).cast("double").alias("v")).where("v is not null")
    ranks = with_rank(values, [F.col("v")], "_r")
    n = ranks.count()
    if not n:
        return None
    places = {p: p * (n - 1) for p in points}
    wanted = sorted({k for x in places.values() for k in (int(x) + 1, min(int(x) + 2, n))})
    at = {r["_r"]: r["v"] for r in ranks.where(F.col("_r").isin(wanted)).collect()}
    return [at[int(x) + 1] + (x - int(x)) * (at[min(int(x) + 2, n)] - at[int(x) + 1]) for x in places.values()]


#: Of the quantile sketches: ranks are off by at most this part of a group.
SKETCH = 100_000


def group_quantiles(rows: DataFrame, by: list[str], wanted: dict[str, tuple[str, float, bool]]) -> DataFrame:
    """Exact quantiles of each group: ``wanted`` gives for each name (column, point, interpolated or by nearest rank).

    Sketches of bounded error give two values that hold the wanted ranks
    between them; a second pass counts what lies under the first and, value
    by value, what lies between. So no rows are sorted or moved, and of a
    group only a few in 100,000 of its distinct values meet in one task. Null
    values do not count; groups without values of a column have null there.
    """
    columns = list(dict.fromkeys(c for c, _, _ in wanted.values()))
    keys = [f"_k{n}" for n in range(len(by))]
    named = rows.select(*(quoted(c).alias(k) for c, k in zip(by, keys, strict=True)), *(F.col(c).cast("double").alias(f"_v{k}") for k, c in enumerate(columns)))
    named = named if plain_scan(named) else written(named)
    off = 4.0 / SKETCH  # a rank, and the error of both sketches
    sketched = []
    for j, (c, p, _) in enumerate(wanted.values()):
        v = F.col(f"_v{columns.index(c)}")
        near = F.percentile_approx(v, F.array(F.lit(max(0.0, p - off)), F.lit(min(1.0, p + off))), SKETCH)
        # all values of a small group count, as one rank is more than the error there
        sketched.append(F.when(F.count(v) <= SKETCH, F.array(F.min(v), F.max(v))).otherwise(near).alias(f"_q{j}"))
    bounds = written(named.groupBy(*keys).agg(*(F.count(f"_v{k}").alias(f"_n{k}") for k in range(len(columns))), *sketched))
    parts = []
    for j, (c, _, _) in enumerate(wanted.values()):
        v, q = F.col(f"_v{columns.index(c)}"), F.col(f"_q{j}")
        parts.append(F.when(v <= q[1], F.struct(F.lit(j).alias("j"), F.when(v >= q[0], v).alias("v"))))
    near = joined_by(named, bounds, keys).select(*keys, F.explode(F.array_compact(F.array(*parts))).alias("c"))
    counts = near.groupBy(*keys, F.col("c.j").alias("j"), F.col("c.v").alias("v")).agg(F.count("*").alias("m"))
    upto = F.sum("m").over(Window.partitionBy(*keys, "j").orderBy(F.col("v").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0))
    ranked = joined_by(counts.withColumn("_upto", upto), bounds, keys)
    out = []
    for j, (name, (c, point, between)) in enumerate(wanted.items()):
        n = F.max(f"_n{columns.index(c)}")
        count = F.col(f"_n{columns.index(c)}")
        x = (count - 1) * F.lit(point)
        low, high = (F.floor(x), F.ceil(x)) if between else (F.greatest(F.ceil(count * F.lit(point)) - 1, F.lit(0)),) * 2
        mine = F.col("j") == j
        at = lambda place, mine=mine: F.min(F.when(mine & (F.col("_upto") > place) & F.col("v").isNotNull(), F.col("v")))
        outside = F.max(F.when(mine & F.col("v").isNull(), F.col("_upto") > low)) | (F.max(F.when(mine, F.col("_upto"))) <= F.max(high))
        value = at(low) + (at(high) - at(low)) * (F.max(x) - F.floor(F.max(x))) if between else at(low)
        out.append(F.when(n == 0, F.lit(None)).when(F.coalesce(outside, F.lit(False)), F.raise_error(F.lit("a quantile lies outside its sketch")).cast("double")).otherwise(value).alias(name))
    found = ranked.groupBy(*keys).agg(*out)
    return joined_by(bounds.select(*keys), found, keys).select(*(F.col(k).alias(c) for c, k in zip(by, keys, strict=True)), *wanted)


def spread(df: DataFrame, *by: str) -> DataFrame:
    """Rows of a key in one task, in as many tasks as the session shuffles to.

    Left alone, Spark joins parts by their compressed bytes, and narrow rows
    that are sorted again and again in a task take many times those.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *by)


def sorted_sides(df: DataFrame) -> DataFrame:
    """``df`` for joins that sort and merge both sides.

    Without column statistics Spark judges a table by the bytes of its
    compressed files, which a row for each character or frame exceeds many
    times over; it would be broadcast from the driver's memory.
    """
    return df.hint("merge")


def joined_by(left: DataFrame, right: DataFrame, by: list[str]) -> DataFrame:
    """Left join on columns of the same names; nulls are equal."""
    names = {c: f"_j{n}" for n, c in enumerate(by)}
    on = F.lit(True)
    for c, n in names.items():
        on &= quoted(c).eqNullSafe(F.col(n))
    return left.join(right.withColumnsRenamed(names), on, "left").drop(*names.values())
