"""Table reads and writes on plain Parquet folders.

A *table* is a folder ``<root>/<name>/`` holding version folders
``v=<run_id>/`` and a ``_CURRENT`` pointer file naming the published one.
``publish`` writes a new version and then moves the pointer, so readers see
either the old or the new table, never a half-written one, and a retry after
a crash just writes its version again.  Appends (metrics, quarantine) go to
``<root>/<name>/`` as extra files.
"""

from __future__ import annotations

import json
import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from strata.operators import zorder
from strata.sources.schemas import SERVICE_TABLES, conform

POINTER = "_CURRENT"
UNDATED = "9999-12-31"


def _hadoop_fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p, _ = _hadoop_fs(spark, path)
    return fs.exists(p)


def _read_text(spark: SparkSession, path: str) -> str | None:
    fs, p, jvm = _hadoop_fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
        return reader.readLine()
    finally:
        stream.close()


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write to a temp file, then one overwriting rename: the pointer is the old or the new
    one at every moment (atomic on HDFS-like stores)."""
    fs, p, jvm = _hadoop_fs(spark, path)
    p, tmp = fs.makeQualified(p), fs.makeQualified(jvm.org.apache.hadoop.fs.Path(path + ".tmp"))
    out = fs.create(tmp, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.valueOf("OVERWRITE")
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri(), conf).rename(tmp, p, options)


def version_path(table: str, run_id: str) -> str:
    return f"{table.rstrip('/')}/v={run_id}"


def write_version(spark: SparkSession, df: DataFrame, table: str, run_id: str) -> str:
    """Write version ``run_id``; a retry of an unpublished run rewrites it,
    the published version is never overwritten under its readers."""
    if current_version(spark, table) == run_id:
        raise ValueError(f"{table}: version {run_id} is published; start a new run id")
    path = version_path(table, run_id)
    df.write.mode("overwrite").parquet(path)
    return path


def set_current(spark: SparkSession, table: str, run_id: str) -> None:
    _write_text(spark, f"{table.rstrip('/')}/{POINTER}", run_id)


def _pointer(spark: SparkSession, table: str) -> dict | None:
    """The pointer of a table: plain text (a version) or JSON (a dimension)."""
    txt = _read_text(spark, f"{table.rstrip('/')}/{POINTER}")
    if txt is None:
        return None
    return json.loads(txt) if txt.lstrip().startswith("{") else {"version": txt.strip()}


def current_version(spark: SparkSession, table: str) -> str | None:
    p = _pointer(spark, table)
    return None if p is None else p["version"]


def read_current(spark: SparkSession, table: str) -> DataFrame | None:
    """The published table (a dimension: history + current rows)."""
    p = _pointer(spark, table)
    if p is None:
        return None
    if "runs" in p:
        return read_dimension(spark, table)
    return spark.read.parquet(version_path(table, p["version"]))


def publish(spark: SparkSession, df: DataFrame, table: str, run_id: str,
            cluster_by: list[str] | None = None) -> str:
    """Write ``df`` as version ``run_id`` of ``table`` and make it current.

    Never overwrites what it reads: a job that reads version A writes B.
    ``cluster_by`` clusters the rows on write: by range for one column (``layout``), by interleaved ranks for several
    (``zorder``)."""
    if cluster_by:
        df = layout(df, cluster_by) if len(cluster_by) == 1 else zorder.cluster(df, cluster_by)
    path = write_version(spark, df, table, run_id)
    set_current(spark, table, run_id)
    return path


def exists(spark: SparkSession, table: str) -> bool:
    return current_version(spark, table) is not None


def append(df: DataFrame, path: str, schema: T.StructType | None = None, part: str | None = None,
           run_date=None) -> None:
    """Add rows to an appended table, conformed to its declared schema.

    Tables with a declared schema, and all appends with a ``part``, have one layout:
    ``run_date=<yyyy-mm-dd>/_part=<part>``.  A ``part`` (e.g. run id + stage) is
    replaced as a whole: a rerun of a crashed job rewrites its own rows instead of
    adding them twice; without one the rows get a part of their own.  Date-bounded
    reports prune whole days; rows without ``run_date`` lie under ``UNDATED``, which
    no lower bound prunes.  Files at the root (plain appends) move into the layout
    first, since Spark reads either the root's files or its partition folders.
    Readers see ``run_date`` / ``_part`` as extra columns."""
    name = os.path.basename(path.rstrip("/"))
    schema = schema or SERVICE_TABLES.get(name)
    out = conform(df, schema) if schema is not None else df
    if part is None and schema is None and not _children(df.sparkSession, path, "run_date="):
        out.write.mode("append").parquet(path)
        return
    _lay_out_root_files(df.sparkSession, path)
    safe = "".join(ch if ch.isalnum() or ch in "-_." else "_" for ch in part or uuid.uuid4().hex)
    day = run_date.isoformat()[:10] if run_date is not None else UNDATED
    out.write.mode("overwrite").parquet(f"{path.rstrip('/')}/run_date={day}/_part={safe}")


def _children(spark: SparkSession, path: str, prefix: str) -> list:
    """The Hadoop paths right below ``path`` whose names start with ``prefix``."""
    fs, p, _ = _hadoop_fs(spark, path)
    found = [st.getPath() for st in fs.listStatus(p)] if fs.exists(p) else []
    return [c for c in found if c.getName().startswith(prefix)]


def _lay_out_root_files(spark: SparkSession, path: str) -> None:
    files = [c for c in _children(spark, path, "part-") if c.getName().endswith(".parquet")]
    if files:
        fs, folder, jvm = _hadoop_fs(spark, f"{path.rstrip('/')}/run_date={UNDATED}/_part=root")
        fs.mkdirs(folder)
        for f in files:
            fs.rename(f, jvm.org.apache.hadoop.fs.Path(folder, f.getName()))


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def create_service_tables(spark: SparkSession, root: str) -> list[str]:
    """Create the seven service tables (empty, declared schema) if missing."""
    made = []
    for name, schema in SERVICE_TABLES.items():
        path = f"{root.rstrip('/')}/{name}"
        fs, p, _ = _hadoop_fs(spark, path)
        if not fs.exists(p):
            spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)
            made.append(name)
    return made


def layout(df: DataFrame, cluster_by: list[str], partitions: int | None = None) -> DataFrame:
    """Cluster rows by key before a write (the z-order hint re-aimed): range
    partitioning + sort within partitions, so key lookups prune row groups."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartitionByRange(n, *cluster_by).sortWithinPartitions(*cluster_by)


def purge(spark: SparkSession, path: str, ts_col: str, now, days: int, run_id: str | None = None) -> int:
    """Retention for an appended table: rows younger than ``days`` stay; returns their number.

    Parts without such rows are deleted, parts with both kinds are rewritten by Spark's dynamic partition overwrite, all others
    are not touched.  Parts keep their names, so a rerun of the run that wrote one still replaces it.  A purge that
    is cut off is finished by the next one."""
    from pyspark.sql import functions as F
    _lay_out_root_files(spark, path)
    infer = "spark.sql.sources.partitionColumnTypeInference.enabled"
    before = spark.conf.get(infer)
    spark.conf.set(infer, "false")  # a part named 002 stays 002
    try:
        df = spark.read.parquet(path)
    finally:
        spark.conf.set(infer, before)
    young = F.coalesce(F.col(ts_col) >= F.lit(now).cast("timestamp") - F.make_dt_interval(F.lit(days)), F.lit(False))
    parts = df.groupBy("run_date", "_part").agg(F.count(F.lit(1)).alias("n"), F.count_if(young).alias("kept")).collect()  # one row a run
    mixed = [(r["run_date"], r["_part"]) for r in parts if 0 < r["kept"] < r["n"]]
    if mixed:
        some = F.struct("run_date", "_part").isin(*[F.struct(F.lit(d), F.lit(p)) for d, p in mixed])
        (df.where(some & young).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("run_date", "_part").parquet(path))
    if parts and not any(r["kept"] for r in parts):  # the table stays readable
        df.drop("run_date", "_part").limit(0).write.mode("overwrite").parquet(f"{path.rstrip('/')}/run_date={UNDATED}/_part=empty")
    for r in parts:
        if not r["kept"]:
            fs, folder, _ = _hadoop_fs(spark, f"{path.rstrip('/')}/run_date={r['run_date']}/_part={r['_part']}")
            fs.delete(folder, True)
    return sum(r["kept"] for r in parts)


def inventory(spark: SparkSession, root: str) -> DataFrame:
    """Tables under ``root``: name, kind (versioned / appended), current
    version and column list (metadata only; the listing is one level deep)."""
    fs, p, jvm = _hadoop_fs(spark, root)
    rows = []
    if fs.exists(p):
        for st in fs.listStatus(p):
            if not st.isDirectory():
                continue
            name = st.getPath().getName()
            path = f"{root.rstrip('/')}/{name}"
            v = current_version(spark, path)
            try:
                cols = ",".join(spark.read.parquet(version_path(path, v) if v else path).columns)
            except Exception:  # noqa: BLE001 - not a parquet table
                continue
            rows.append((name, "versioned" if v else "appended", v, cols))
    schema = "table_name string, kind string, current_version string, columns string"
    return spark.createDataFrame(rows, schema)


def preview(df: DataFrame, columns: list[str] | None = None, n: int = 3) -> DataFrame:
    """A few rows for a look (a sample preview; not for results)."""
    return (df.select(*columns) if columns else df).limit(n)


def typed_frame(spark: SparkSession, schema: T.StructType, data: list) -> DataFrame:
    """A DataFrame with a declared schema (test data; no inference)."""
    return spark.createDataFrame(data, schema)


# --------------------------------------------------------------------------- type-2 dimensions
#
# A dimension is ``<table>/run=<run_id>/is_current=<bool>/``: each run writes the
# current rows it leaves (kept + new versions) and the rows it closed; closed
# rows are immutable, so history is never rewritten.  ``_CURRENT`` holds JSON
# {"version": run, "max_sk": n, "runs": [published runs]}: the dimension is the
# current rows of ``version`` plus the closed rows of every published run.  A
# crashed run's folder is not in ``runs`` and stays invisible; its retry
# overwrites it.


def dimension_meta(spark: SparkSession, table: str) -> dict | None:
    p = _pointer(spark, table)
    return p if p is not None and "runs" in p else None


def write_dimension_run(spark: SparkSession, rows: DataFrame, table: str, run_id: str,
                        is_current: str = "is_current") -> str:
    meta = dimension_meta(spark, table)
    if meta and run_id in meta["runs"]:
        raise ValueError(f"{table}: run {run_id} is published; start a new run id")
    path = f"{table.rstrip('/')}/run={run_id}"
    rows.write.mode("overwrite").partitionBy(is_current).parquet(path)
    if not _children(spark, path, f"{is_current}=true"):  # a run without current rows still says what its columns are
        rows.limit(0).drop(is_current).write.mode("overwrite").parquet(f"{path}/{is_current}=true")
    return path


def publish_dimension_run(spark: SparkSession, table: str, run_id: str, max_sk: int,
                          is_current: str = "is_current") -> dict:
    meta = dimension_meta(spark, table) or {"runs": []}
    meta = {"version": run_id, "max_sk": int(max_sk), "runs": list(meta["runs"]) + [run_id], "is_current": is_current}
    _write_text(spark, f"{table.rstrip('/')}/{POINTER}", json.dumps(meta))
    return meta


def read_dimension_run(spark: SparkSession, path: str, is_current: str = "is_current") -> DataFrame:
    """The rows one run wrote (partition values come back as text: typed again)."""
    from pyspark.sql import functions as F
    return spark.read.parquet(path).withColumn(is_current, F.col(is_current).cast("boolean"))


def read_dimension(spark: SparkSession, table: str, is_current: str = "is_current") -> DataFrame | None:
    """The published dimension: history of published runs + current rows of the latest, read from the
    folders that the pointer names (the pointer's column name, where it has one, goes before ``is_current``)."""
    from pyspark.sql import functions as F
    meta = dimension_meta(spark, table)
    if meta is None:
        return None
    column = meta.get("is_current", is_current)
    base = table.rstrip("/")
    folders = [(run, flag) for run in meta["runs"] for flag in ("false", "true") if flag == "false" or run == meta["version"]]
    parts = []
    for flag in ("false", "true"):
        paths = [f"{base}/run={run}/{column}={flag}" for run, own in folders if own == flag]
        paths = [p for p in paths if _children(spark, p, "")]
        if paths:
            parts.append(spark.read.parquet(*paths).withColumn(column, F.lit(flag == "true")))
    if not parts:  # a dimension without rows
        return read_dimension_run(spark, f"{base}/run={meta['version']}", column)
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def read_dimension_current(spark: SparkSession, table: str, is_current: str = "is_current") -> DataFrame | None:
    """Current rows only (partition pruning: one run, one is_current folder)."""
    meta = dimension_meta(spark, table)
    if meta is None:
        return None
    path = f"{table.rstrip('/')}/run={meta['version']}/{is_current}=true"
    from pyspark.sql import functions as F
    if not _children(spark, path, ""):  # the last run left no current row
        return read_dimension(spark, table, is_current).where(F.col(is_current))
    return spark.read.parquet(path).withColumn(is_current, F.lit(True))


def input_bytes(spark: SparkSession, paths: list[str]) -> int:
    """Total size of the files under ``paths`` (file-system metadata only)."""
    total = 0
    for path in paths:
        fs, p, _ = _hadoop_fs(spark, path)
        if fs.exists(p):
            total += fs.getContentSummary(p).getLength()
    return total


# --------------------------------------------------------------------------- catalog tables
#
# For deployments that keep layers as catalog tables (``namespace.table``)
# rather than folders.


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table by name, or a folder table by path (published version)."""
    if "/" in name:
        df = read_current(spark, name)
        return df if df is not None else spark.read.parquet(name)
    return spark.table(name)


def save_table(spark: SparkSession, df: DataFrame, name: str, mode: str = "append",
               schema: T.StructType | None = None) -> None:
    """Write to a catalog table.  Rows are conformed to the declared service
    schema or to the existing table's schema first (append matches columns
    by name and would otherwise narrow or reject types).  Overwriting a table
    the frame reads from is refused by Spark: publish a new table instead."""
    short = name.split(".")[-1]
    target = schema or SERVICE_TABLES.get(short)
    if target is None and spark.catalog.tableExists(name):
        target = spark.table(name).schema
    out = conform(df, target) if target is not None else df
    out.write.mode(mode).format("parquet").saveAsTable(name)


def catalog_inventory(spark: SparkSession, database: str | None = None) -> DataFrame:
    """Tables of a catalog database with their columns (SHOW TABLES + DESCRIBE)."""
    rows = []
    for t in spark.catalog.listTables(database):
        full = f"{t.database}.{t.name}" if t.database else t.name
        cols = ",".join(c.name for c in spark.catalog.listColumns(full))
        rows.append((full, t.tableType, cols))
    return spark.createDataFrame(rows, "table_name string, table_type string, columns string")


# --------------------------------------------------------------------------- retention of versions


def vacuum(spark: SparkSession, table: str, keep: int = 2) -> list[str]:
    """Delete superseded copies inside one table folder; returns what went.

    Versioned tables: all ``v=<run>`` folders but the ``keep`` newest and the
    published one.  Dimensions: the ``is_current=true`` folders of runs older
    than the published run (their rows live on in later runs); closed history
    (``is_current=false``) is never deleted."""
    fs, root, jvm = _hadoop_fs(spark, table)
    if not fs.exists(root):
        return []
    p = _pointer(spark, table) or {}
    gone = []
    names = sorted(st.getPath().getName() for st in fs.listStatus(root) if st.isDirectory())
    if "runs" in p:
        current = p.get("is_current", "is_current")
        for n in names:
            run = n.split("=", 1)[1] if n.startswith("run=") else None
            if run and run in p["runs"] and run != p["version"]:
                cur = jvm.org.apache.hadoop.fs.Path(f"{table.rstrip('/')}/{n}/{current}=true")
                if fs.exists(cur):
                    fs.delete(cur, True)
                    gone.append(f"{n}/{current}=true")
        return gone
    versions = [n for n in names if n.startswith("v=")]
    for n in versions[:-keep] if keep > 0 else versions:
        if n == f"v={p.get('version')}":
            continue
        fs.delete(jvm.org.apache.hadoop.fs.Path(f"{table.rstrip('/')}/{n}"), True)
        gone.append(n)
    return gone
