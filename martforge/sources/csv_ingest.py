"""Raw CSV ingest (IO1-IO7).

* every table is read as text, never inferred (a zip like ``01037`` stays text);
* the header decides the column names (trimmed, BOM removed) and must match
  the declared contract (SRC1), in any order; a load reads every part file's
  header first, each file by its own, and leaves out, by name, files with
  other columns;
* the dialect is comma separated, optional ``"`` quoting with doubled quotes;
  tables with free text may hold newlines inside quotes: ``quoted_csv`` finds
  their records in every byte range of a file at once;
* ``''``, ``NULL``, ``null``, ``NA``, ``N/A`` and empty fields become NULL;
* malformed rows (too few / too many fields) are kept out of the table and
  sent to a quarantine with the raw line, not dropped silently;
* all inputs are checked for existence before any is read.

``load_raw`` writes each table once to parquet, good and rejected rows in one
pass (``partitionBy`` on the status), and takes the load report from
``observe`` metrics of that same pass; later reads use the parquet copy with
partition pruning and column pruning.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType
from pyspark.errors import AnalysisException

from martforge.functions.text import null_tokens_to_null
from martforge.sources import quoted_csv
from martforge.sources.contracts import MULTILINE_TABLES, RAW_COLUMNS, default_path
from martforge.sources.inputs import InputFile, Inventory, clean_name, inventory, list_files
from martforge.sources.sinks import folder_set
from martforge.sources.snapshots import Publication

BAD = "_bad"
STATUS = "_status"


class MissingInputError(FileNotFoundError):
    pass


class ContractError(ValueError):
    pass


def _reader(spark: SparkSession, table: str, multiline: bool | None = None):
    r = (spark.read.option("header", True).option("sep", ",").option("quote", '"').option("escape", '"')
         .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", BAD).option("encoding", "UTF-8"))
    if multiline if multiline is not None else table in MULTILINE_TABLES:
        r = r.option("multiLine", True)
    return r


def inputs_present(spark: SparkSession, paths: Mapping[str, str]) -> dict[str, bool]:
    """IO7: whether each input exists."""
    present = {}
    for table, path in paths.items():
        try:
            spark.read.schema("x string").csv(path)  # resolves the file listing only
            present[table] = True
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e) and "Path does not exist" not in str(e):
                raise
            present[table] = False
    return present


def check_inputs(spark: SparkSession, paths: Mapping[str, str]) -> None:
    """IO7: every input must exist; raise once with the full list of missing ones."""
    missing = [f"{table}: {paths[table]}" for table, there in inputs_present(spark, paths).items() if not there]
    if missing:
        raise MissingInputError("missing raw inputs:\n  " + "\n  ".join(missing))


def raw_header(spark: SparkSession, table: str, path: str, multiline: bool | None = None) -> list[str]:
    """The header line's column names exactly as written (first file)."""
    return _reader(spark, table, multiline).csv(path).columns  # reads the first line only


def header_columns(spark: SparkSession, table: str, path: str, multiline: bool | None = None) -> list[str]:
    """IO4: column names from the header line, BOM and spaces stripped."""
    return [clean_name(n) for n in raw_header(spark, table, path, multiline)]


def validate_header(table: str, names: list[str]) -> None:
    """SRC1: the header must hold exactly the declared columns."""
    declared = RAW_COLUMNS[table]
    if sorted(names) != sorted(declared):
        raise ContractError(
            f"{table}: header {names} does not match the declared columns {declared} "
            f"(missing {sorted(set(declared) - set(names))}, unexpected {sorted(set(names) - set(declared))})")


def _contract(df: DataFrame, table: str, written: Sequence[str]) -> DataFrame:
    """Declared columns in declared order, NULL tokens as NULL, and ``_bad``."""
    by_name = {clean_name(n): n for n in written}
    return df.select(*[null_tokens_to_null(F.col(f"`{by_name[n]}`")).alias(n) for n in RAW_COLUMNS[table]], F.col(BAD))


def _quoted(table: str, multiline: bool | None) -> bool:
    return multiline if multiline is not None else table in MULTILINE_TABLES


def read_raw_csv(spark: SparkSession, table: str, path: str, multiline: bool | None = None) -> DataFrame:
    """One raw table with every declared column as text plus ``_bad`` (the
    raw line of a malformed row, NULL for good rows).  Lazy.

    Every part file must have the same header.  Tables that may hold newlines
    inside quotes are cut into records by ``quoted_csv``; a file of theirs is
    read by many tasks like any other.

    Spark refuses a query whose only column read is ``_bad`` (e.g. a bare
    ``good_rows(df).count()``): detecting malformed rows needs the whole row
    parsed.  Count through ``load_raw``'s report, or with a data column selected."""
    if _quoted(table, multiline):
        found = inventory(spark, list_files(spark, path), RAW_COLUMNS[table])
        _require(table, found)
        if found.deviating or len(found.groups) > 1:
            raise ContractError(f"{table}: part files of {path} have different headers")
        return _read_group(spark, table, *next(iter(found.groups.items())), quoted=True)
    written = raw_header(spark, table, path, multiline)
    names = [clean_name(n) for n in written]
    validate_header(table, names)
    # The schema carries the header exactly as written, and every file's header
    # is checked against it (enforceSchema off): a part file with other or
    # reordered columns fails the read instead of being read out of place.
    schema = StructType([StructField(n, StringType(), True) for n in written] + [StructField(BAD, StringType(), True)])
    df = _reader(spark, table, multiline).option("enforceSchema", False).schema(schema).csv(path)
    return _contract(df, table, written)


def _require(table: str, found: Inventory) -> None:
    """SRC1: some file must hold exactly the declared columns."""
    if not found.groups:
        validate_header(table, [clean_name(n) for n in found.deviating[0][1]] if found.deviating else [])


def _read_group(spark: SparkSession, table: str, written: tuple[str, ...], files: Sequence[InputFile], quoted: bool) -> DataFrame:
    """Files with one and the same header, known to hold the declared columns."""
    paths = [f.path for f in files]
    if quoted:
        return _contract(quoted_csv.read(spark, paths, written, BAD), table, written)
    schema = StructType([StructField(n, StringType(), True) for n in written] + [StructField(BAD, StringType(), True)])
    return _contract(_reader(spark, table, False).schema(schema).csv(paths), table, written)


def read_by_header(spark: SparkSession, table: str, found: Inventory) -> DataFrame:
    """IO4: ``read_raw_csv`` over part files that order their columns differently, each by its own header."""
    _require(table, found)
    groups = [_read_group(spark, table, written, files, _quoted(table, None)) for written, files in found.groups.items()]
    return reduce(DataFrame.unionByName, groups)


def good_rows(df: DataFrame) -> DataFrame:
    return df.filter(F.col(BAD).isNull()).drop(BAD)


def rejected_rows(df: DataFrame) -> DataFrame:
    return df.filter(F.col(BAD).isNotNull()).select(BAD)


@dataclass
class LoadReport:
    table: str
    rows_loaded: int
    rows_rejected: int


LOAD_FORMAT = 1  # raise it when the same input loads to other rows


def source_key(files: Sequence[InputFile]) -> str:
    """A key of an input's contents: names, sizes and times of its files."""
    return hashlib.sha256(json.dumps([LOAD_FORMAT, [[f.path, f.length, f.modified] for f in files]]).encode()).hexdigest()


def _stored_schema(table: str) -> StructType:
    return StructType([StructField(c, StringType(), True) for c in [*RAW_COLUMNS[table], BAD, STATUS]])


def loaded(spark: SparkSession, out_dir: str, version: int | None = None) -> dict[str, DataFrame]:
    """The good rows of the raw tables that ``load_raw`` published under ``out_dir``, all of one load."""
    stored = folder_set(spark, out_dir)
    now = stored.current() if version is None else stored.at(version)
    if now is None:
        raise MissingInputError(f"no raw tables under {out_dir}: load them first")
    return {t: stored.read(t, now.version).filter(F.col(STATUS) == "ok").select(*RAW_COLUMNS[t]) for t in now.tables}


def loaded_keys(spark: SparkSession, out_dir: str) -> dict[str, str]:
    """A key of the contents of each published raw table: the folder it was written to, which is never written again."""
    now = folder_set(spark, out_dir).current()
    return {t: str(entry["path"]) for t, entry in now.tables.items()} if now else {}


def left_out(spark: SparkSession, out_dir: str) -> DataFrame:
    """IO5: the part files that the current load left out because of their header: ``(table_name, file, header)``."""
    now = folder_set(spark, out_dir).current()
    rows = [(t, path, header) for t, entry in sorted(now.tables.items()) for path, header in entry.get("left_out", [])] if now else []
    return spark.createDataFrame(rows, "table_name string, file string, header string")


def load_raw(spark: SparkSession, base_dir: str, out_dir: str, paths: Mapping[str, str] | None = None,
             refresh: bool = False) -> tuple[dict[str, DataFrame], DataFrame]:
    """IO1-IO7 end to end: check inputs, read each table, write it once as
    parquet under ``out_dir/<table>/<load>`` split into ``_status=ok|rejected``, and
    return the good rows (read back from parquet) with the load report
    ``(table_name, rows_loaded, rows_rejected)`` as a DataFrame.

    All tables become current together, by one commit file (``snapshots``): a
    load that fails leaves the raw tables of the load before.  A table whose
    input files are those of the current load (names, sizes, times) is kept,
    not read again, unless ``refresh``.

    Part files may order their columns differently.  A file with other columns
    is left out and named by ``left_out``; a table all of whose files have other
    columns stops the load (``ContractError``)."""
    paths = dict(paths or {t: default_path(base_dir, t) for t in RAW_COLUMNS})
    check_inputs(spark, paths)
    stored = folder_set(spark, out_dir)
    before = stored.current()

    def load_one(new: Publication, table: str, path: str) -> LoadReport:
        files = list_files(spark, path)
        key = source_key(files)
        entry = before.tables.get(table) if before else None
        if entry and entry.get("source") == key and not refresh:
            new.keep(table, entry)
            return LoadReport(table, entry["loaded"], entry["rejected"])
        found = inventory(spark, files, RAW_COLUMNS[table])
        df = read_by_header(spark, table, found)
        obs = Observation(f"load_{table}")
        status = F.when(F.col(BAD).isNull(), F.lit("ok")).otherwise(F.lit("rejected"))
        out = df.withColumn(STATUS, status).observe(
            obs, F.count_if(F.col(BAD).isNull()).alias("ok"), F.count_if(F.col(BAD).isNotNull()).alias("bad"))
        out.write.partitionBy(STATUS).parquet(new.path(table))
        m = obs.get
        report = LoadReport(table, int(m["ok"]), int(m["bad"]))
        new.wrote(table, _stored_schema(table), source=key, loaded=report.rows_loaded, rejected=report.rows_rejected,
                  left_out=[[f.path, ",".join(names)] for f, names in found.deviating])
        return report

    # The tables are independent: load them as concurrent jobs.
    with stored.begin() as new:
        with ThreadPoolExecutor(max_workers=min(len(paths), 9)) as pool:
            jobs = [pool.submit(load_one, new, t, p) for t, p in paths.items()]
        reports = [job.result() for job in jobs]
        done = new.commit()
    stored.expire()
    tables = loaded(spark, out_dir, done.version)
    report = spark.createDataFrame(
        [(r.table, r.rows_loaded, r.rows_rejected) for r in reports],
        "table_name string, rows_loaded long, rows_rejected long")
    return {t: tables[t] for t in paths}, report


def read_raw(spark: SparkSession, base_dir: str, paths: Mapping[str, str] | None = None) -> dict[str, DataFrame]:
    """Lazy variant: the good rows of every raw table, straight from CSV."""
    paths = dict(paths or {t: default_path(base_dir, t) for t in RAW_COLUMNS})
    check_inputs(spark, paths)
    return {t: good_rows(read_raw_csv(spark, t, p)) for t, p in paths.items()}
