"""Raw file scans (S1, S2) and Parquet reads."""

from __future__ import annotations

import re
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from vaultline.session import ensure_checkpoint_dir, scratch_path

_READS: dict[tuple[int, str], DataFrame] = {}


def read_parquet(spark: SparkSession, path: str, reuse: bool = False) -> DataFrame:
    """Parquet scan.  ``reuse`` keeps one DataFrame per (session, path) so
    repeated reads of an immutable input skip the file listing."""
    if not reuse:
        return spark.read.parquet(path)
    key = (id(spark), path)
    df = _READS.get(key)
    if df is None or df.sparkSession is not spark:
        df = spark.read.parquet(path)
        _READS[key] = df
    return df


CORRUPT = "_corrupt_record"
FILE, BLOCK = "_source_file", "_source_block"


def _with_source(raw: DataFrame) -> DataFrame:
    """The file a row was read from and where its block begins there."""
    own = F.col("_metadata.file_path")
    known = F.coalesce(F.col(FILE), own) if FILE in raw.columns else own
    block = F.col("_metadata.file_block_start")
    block = F.when(F.col(FILE).isNull(), block) if FILE in raw.columns else block
    return raw.select(*(F.col(f"`{c}`") for c in raw.columns if c != FILE), known.alias(FILE), block.alias(BLOCK))


def _typed(raw: DataFrame, schema: StructType | None) -> DataFrame:
    """Declared columns first, by name and with their type; the other columns
    stay as read.  A declared column that the input lacks is NULL.  A value
    that its type cannot take becomes NULL and is named in CORRUPT."""
    declared = schema.fields if schema is not None else []
    at = {c.lower(): c for c in raw.columns if c != CORRUPT}
    cols, bad = [], []
    for f in declared:
        own = at.pop(f.name.lower(), None)
        if own is None:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        value = F.col(f"`{own}`")
        typed = value.try_cast(f.dataType)
        cols.append(typed.alias(f.name))
        bad.append(F.when(value.isNotNull() & typed.isNull(), F.concat(F.lit(f"{f.name}="), value)))
    cols += [F.col(f"`{c}`") for c in raw.columns if c.lower() in at]
    wrong = F.concat_ws("; ", *bad) if bad else F.lit("")
    return raw.select(*cols, F.coalesce(CORRUPT, F.when(wrong != "", wrong)).alias(CORRUPT))


def read_csv(spark: SparkSession, path: str, schema: StructType | None = None, infer: bool = False, provenance: bool = False) -> DataFrame:
    """CSV with a header line, bound by the header's names.

    Columns of ``schema`` come first, whatever their place in the file, and
    further columns are kept (as text, or inferred).  Lines with too few or
    too many fields, and fields that their declared type cannot take, stay in
    the result with NULL there; column CORRUPT then holds the line or the
    fields (NULL for good rows).  Files of one folder must agree on the
    header: a differing one fails the read instead of shifting its columns.
    ``provenance`` adds FILE and BLOCK.
    """
    options = {"header": True, "mode": "PERMISSIVE", "enforceSchema": False, "columnNameOfCorruptRecord": CORRUPT}
    found = spark.read.options(**{**options, "inferSchema": infer}).csv(path)
    fields = [f for f in found.schema.fields if f.name != CORRUPT]
    if schema is not None and not infer:
        fields = [StructField(f.name, StringType()) for f in fields]
    raw = spark.read.options(**options).schema(StructType([*fields, StructField(CORRUPT, StringType())])).csv(path)
    raw = _with_source(raw) if provenance else raw
    return _typed(raw, None if infer else schema)


#: how indented arrays close a record and open the next one, by the lines that
#: stand at the left edge: the brackets alone with records indented, or both on one line
_ALONE, _JOINED = ("[", "]"), ("[ {", "}, {", "} ]")
_BOM, _SPACE = "\ufeff", " \t\n\x0b\f\r"
#: stands in no document (JSON has no bare NUL): a reader of lines that end with it takes a file as one line
_NEVER = "\0vaultline: no document holds this\0"


def _json_forms(spark: SparkSession, path: str) -> tuple[list[str], list[tuple[str, int, str | None]]]:
    """JSON files with one value a line, and files that are one document each:
    (file, bytes, text between two records, if the document can be cut there).
    Both are empty where no file is a document, so that a folder of lines is
    not listed on the driver however many files it has.

    All lines of a file count: it is a document if none is a complete value,
    or if there are fewer of those than pieces of one (lines that open, go on
    or close; the last row of an indented array is complete by itself).  A
    document is cut between records if its lines at the left edge are the
    array's brackets and nothing else, and those of the next indent are a
    record's braces and nothing else: a string cannot hold a line end."""
    raw = F.when(F.startswith(F.col("value"), F.lit(_BOM)), F.expr("substring(value, 2)")).otherwise(F.col("value"))
    line = F.rtrim(F.ltrim("value", F.lit(_SPACE + _BOM)), F.lit(_SPACE + "\u0085\u2028\u2029"))
    whole = F.when(line.startswith("{") & line.endswith("}"), F.from_json(line, "map<string,string>").isNotNull())
    whole = whole.when(line.startswith("[") & line.endswith("]"), F.from_json(line, "array<string>").isNotNull()).otherwise(False)
    piece = F.substring(line, -1, 1).isin(",", ":", "[", "{") | F.substring(line, 1, 1).isin("]", "}")
    indent = F.left(raw, F.length(raw) - F.length(F.ltrim(raw, F.lit(" \t"))))
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes"), line.alias("line"), whole.alias("whole"), piece.alias("piece"), indent.alias("indent")).where("line != ''")
    count = lambda c: F.sum(F.coalesce(c, F.lit(False)).cast("long"))
    at_edge = lambda values: count((F.col("indent") == "") & F.col("line").isin(*values))
    per = lines.groupBy("file", "indent").agg(
        F.max("bytes").alias("bytes"), F.count("*").alias("n"), count(F.col("whole")).alias("whole"), count(F.col("piece") & ~F.col("whole")).alias("piece"),
        at_edge(_ALONE).alias("alone"), at_edge(_JOINED).alias("joined"), at_edge((_ALONE[0], _JOINED[0])).alias("begins"),
        count(F.col("line").isin("{", "}", "},")).alias("braces"),
    )
    edge = F.col("indent") == ""
    inner = F.min(F.when(~edge, F.struct(F.length("indent").alias("size"), "indent", "n", "braces"))).alias("inner")
    files = per.groupBy("file").agg(
        *(F.sum(c).alias(c) for c in ("whole", "piece", "alone", "joined", "begins")), F.max("bytes").alias("bytes"), F.sum(F.when(edge, F.col("n")).otherwise(0)).alias("edge"), inner
    )
    document = (F.col("whole") == 0) | (F.col("piece") > F.col("whole"))
    ensure_checkpoint_dir(spark)
    files = files.select("file", "bytes", document.alias("document"), "alone", "joined", "edge", "begins", "inner").checkpoint()  # asked twice
    documents = files.where("document").collect()
    if not documents:
        return [], []

    def between(r) -> str | None:
        if r["begins"] != 1 or r["inner"] is None:
            return None
        if r["edge"] == r["joined"]:
            return "\n}, {"
        return f"\n{r['inner']['indent']}}}," if r["edge"] == r["alone"] and r["inner"]["n"] == r["inner"]["braces"] else None

    lined = sorted(r["file"] for r in files.where("not document").select("file").collect())
    return lined, sorted((r["file"], r["bytes"], between(r)) for r in documents)


def _records(spark: SparkSession, files: list[str], between: str, provenance: bool) -> DataFrame:
    """Records of indented arrays as one line each (column ``value``): Spark's
    line reader cuts the files between records, in as many tasks as they have
    splits."""
    joined = between.endswith("{")
    raw = F.regexp_replace("value", r"^\x{FEFF}", "")
    indent = "" if joined else between[1:-2]
    last = raw.rlike(rf"(?s)(^|\n){indent}\}}\s*\]\s*$")
    text = F.trim(F.regexp_replace(raw, r"[\r\n]+", " "))
    first = text.startswith("[")
    body = F.when(first, F.substring(text, F.lit(2), F.length(text))).otherwise(F.concat(F.lit("{ "), text) if joined else text)
    body = F.when(last, F.regexp_replace(body, r"\s*\]\s*$", "")).otherwise(F.concat(body, F.lit(" }")))
    if provenance:  # the record's first field: a file URI holds no sign that JSON escapes
        rest = F.regexp_replace(body, r"^\s*\{\s*", "")
        comma = F.when(rest.startswith("}"), "").otherwise(", ")
        body = F.concat(F.lit(f'{{"{FILE}": "'), F.col("_metadata.file_path"), F.lit('"'), comma, rest)
    return spark.read.option("lineSep", between).text(files).where(F.trim("value") != "").select(body.alias("value"))


def _literal(uri: str) -> str:
    """A file's URI as a path to read, with no sign left to expand."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", unquote(uri))


def read_json(
    spark: SparkSession, path: str, schema: StructType | None = None, multiline: bool | None = None, split_over: int | None = None,
    provenance: bool = False, undeclared: bool = True,
) -> DataFrame:
    """JSON scan.  ``multiline=True`` reads whole-file documents (one task per
    file), ``False`` JSON Lines, which split across tasks; by default the
    lines of each file tell which it is, and a folder may hold both.  Declared
    columns have their declared type, further ones are inferred and kept (as
    text where the two kinds of files differ).  A value that cannot be read
    that way has NULL fields and its text in column CORRUPT.

    A document of more than ``split_over`` bytes (by default the size of one
    scan task) that is an indented array is read by many tasks: cut between
    records, which are written as lines to the shared scratch folder first; a
    bad record then costs itself only.  Other documents are one task each; up to
    that size a document is parsed from memory, as one long line: Spark's
    multi-line parser opens the file again for each number that a declared text
    column takes.
    ``provenance`` adds FILE and BLOCK (no block for records of a cut document).
    ``undeclared=False`` reads the declared columns alone, without the pass over
    the files that looks for others."""
    parts: list[tuple[bool, str | list[str], dict]] = [(bool(multiline), path, {})]
    in_memory = False
    if multiline is None:
        lines, found = _json_forms(spark, path)
        inside = path.rstrip("/") + "/"
        if split_over is None:
            split_over = int(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())
        # folders that name a partition column are read as they are
        plain = [f for f, *_ in found if "=" in unquote(f).rpartition(inside)[2].rpartition("/")[0] and inside in unquote(f)]
        cut: dict[str, list[str]] = {}
        for f, size, between in found:
            if between is not None and size > split_over and f not in plain:
                cut.setdefault(between, []).append(f)
        gone = {f for files in cut.values() for f in files}
        documents = [f for f, *_ in found if f not in gone]
        most = int(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())
        in_memory = all(size <= most for f, size, _ in found if f not in gone)
        parts = [(bool(documents), path, {})]
        if cut:
            folders = [scratch_path(spark, "json-records") for _ in cut]
            for folder, (between, files) in zip(folders, cut.items(), strict=True):
                _records(spark, [_literal(f) for f in files], between, provenance).write.text(folder)
            parts = [(False, folders, {})]
            parts += [(False, [_literal(f) for f in lines], {})] if lines else []
            parts += [(True, [_literal(f) for f in documents], {})] if documents else []
        elif lines and documents:
            base = {"basePath": path} if all(inside in unquote(f) for f in lines + documents) else {}
            parts = [(False, [_literal(f) for f in lines], base), (True, [_literal(f) for f in documents], base)]
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    reader = lambda many, more: spark.read.options(**options, **more, multiLine=many)
    declared = list(schema.fields) if schema is not None else []
    names = {f.name for f in declared} | {CORRUPT, FILE}
    further: dict[str, StructField] = {}
    for many, files, more in parts if undeclared or schema is None else []:
        for f in reader(many, more).json(files).schema.fields:
            if f.name not in names:
                known = further.setdefault(f.name, f)
                further[f.name] = f if known.dataType == f.dataType else StructField(f.name, StringType())
    full = StructType([*declared, *further.values(), *([StructField(FILE, StringType())] if provenance else []), StructField(CORRUPT, StringType())])
    options_of = lambda many, more: (False, {**more, "lineSep": _NEVER}) if many and in_memory else (many, more)
    read = [reader(*options_of(many, more)).schema(full).json(files) for many, files, more in parts]
    return reduce(DataFrame.unionByName, (_with_source(df) if provenance else df for df in read))


def accepted(df: DataFrame) -> DataFrame:
    """Rows that were read without fault, without what the reader added."""
    good = df.where(F.col(CORRUPT).isNull()) if CORRUPT in df.columns else df
    return good.drop(CORRUPT, FILE, BLOCK)


def rejected(df: DataFrame) -> DataFrame:
    """Rows that could not be read as declared: (source_file, source_block,
    reason, record), the record as JSON of what could be read.  ``df`` was read
    with ``provenance``."""
    rest = [c for c in df.columns if c not in (CORRUPT, FILE, BLOCK)]
    record = F.to_json(F.struct(*(F.col(f"`{c}`") for c in rest)))
    bad = df.where(F.col(CORRUPT).isNotNull())
    return bad.select(F.col(FILE).alias("source_file"), F.col(BLOCK).alias("source_block"), F.col(CORRUPT).alias("reason"), record.alias("record"))
