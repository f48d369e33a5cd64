"""Landing files: newline-delimited JSON, read as strings with nothing lost."""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from boardweave.operators.typed import INPUT_CONTRACT
from boardweave.sources import files

# fields the feeds are known to carry; others arrive by schema evolution
BRONZE_FIELDS = {
    **INPUT_CONTRACT,
    **dict.fromkeys("Category RoleType CompanyType RequiredCertifications MinYearsExperience Vertical".split(),
                    "string"),
}
PROVENANCE = ("_source_file", "_source_file_modified", "_ingested_at")
UNSEEN = "fields not in the recorded schema: "
MOST_FIELDS = 10_000  # new names of one stop
FILES_AT_ONCE = 10_000
DEPTH = 50  # levels of objects and arrays in a field's value; lines with deeper ones are kept whole
_STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
_PLAIN = r'[^\[\]{}"]*+'


def _value_pattern() -> str:
    """Regular expression of a JSON value as it stands in a line, for lines known to be JSON."""
    nested = _STRING
    for _ in range(DEPTH):
        nested = f"{_STRING}|[\\[{{]{_PLAIN}(?:(?:{nested}){_PLAIN})*+[\\]}}]"
    return rf'(?:{nested}|[^\s",:\[\]{{}}]++)'


_VALUE = _value_pattern()
# What a match takes is consumed with all it holds, so the next one begins at the next field, or item, of the same level.
_FIELD = rf"({_STRING})\s*+:\s*+({_VALUE})"
_ITEM = rf"(?:^\[|,)\s*+({_VALUE})"
PLAIN_BYTES = 1_000_000  # longer lines are not read by a scan, whose parser has limits of its own


def _plain_pattern(fields: dict[str, str]) -> str:
    """Regular expression of a line whose values a JSON scan gives as they are written: one flat object of
    known names, with strings, short whole numbers, truth values and nulls, and lists of strings in array fields."""
    w = r"[ \t\r]*+"
    text = r'"[^"\\\x00-\x1f]*+(?:\\(?:["\\/bfnrt]|u[0-9a-fA-F]{4})[^"\\\x00-\x1f]*+)*+"'
    single = rf"(?:{text}|null|true|false|0|-?[1-9][0-9]{{0,17}}+)"
    several = rf"(?:null|\[{w}(?:{text}{w}(?:,{w}{text}{w})*+)?+\])"

    def field(kind_is_string: bool, value: str) -> list[str]:
        names = [re.escape(n) for n, kind in fields.items()
                 if (kind == "string") == kind_is_string and not re.search(r'["\\\x00-\x1f]', n) and len(n) < 1000]
        return [rf'"(?:{"|".join(names)})"{w}:{w}{value}'] if names else []
    one = rf"(?:{'|'.join(field(True, single) + field(False, several))})"
    return rf"\A{w}\{{{w}{one}{w}(?:,{w}{one}{w})*+\}}{w}\z"


# --- reading --------------------------------------------------------------------

def text_options(glob: str) -> dict[str, str]:
    """Records end at a line feed only: other separators may occur in text."""
    return {"lineSep": "\n", "pathGlobFilter": glob, "recursiveFileLookup": "true"}


def with_provenance(lines: DataFrame) -> DataFrame:
    return lines.select(
        "value",
        F.col("_metadata.file_path").alias("_source_file"),
        F.col("_metadata.file_modification_time").alias("_source_file_modified"),
        F.current_timestamp().alias("_ingested_at"),
    )


def _ddl(fields: dict[str, str]) -> str:
    return ", ".join(f"`{name.replace('`', '``')}` {kind}" for name, kind in fields.items())


def _unquoted(text: Column) -> Column:
    """What a JSON string says."""
    bare = F.substring(text, 2, F.length(text) - 2)
    return F.when(F.contains(text, F.lit("\\")), F.try_variant_get(F.try_parse_json(text), "$", "string")).otherwise(bare)


def _as_text(written: Column) -> Column:
    """A value as text: strings without their quotes, null as NULL, all others as they are written."""
    return F.when(F.startswith(written, F.lit('"')), _unquoted(written)).when(written != "null", written)


def _field(name: str) -> Column:
    """A field's value as it is written; of a repeated name the last."""
    return F.get("_written", F.array_position("_names", name).cast("int") - 1)


def _column(name: str, kind: str) -> Column:
    if kind == "string":
        return _as_text(_field(name))
    items = F.transform(F.regexp_extract_all(_field(name), F.lit(_ITEM), F.lit(1)), _as_text)
    return F.when(F.startswith(_field(name), F.lit("[")), items)


def _misfits(fields: dict[str, str]) -> Column:
    """Places of the fields that no column can hold: unknown names, and anything
    but an array under the name of an array field."""
    arrays = [name for name, kind in fields.items() if kind != "string"]
    places = F.filter(F.sequence(F.lit(0), F.size("_names") - 1), lambda i: i >= 0)

    def unfit(i: Column) -> Column:
        name, value = F.get("_names", i.cast("int")), F.get("_written", i.cast("int"))
        no_array = name.isin(*arrays) & (value != "null") & ~F.startswith(value, F.lit("["))
        return ~name.isin(*fields) | no_array
    return F.filter(places, unfit)


def _scannable(fields: dict[str, str]) -> bool:
    """Can one schema hold the fields? Names that differ in case only, it cannot tell apart."""
    return bool(fields) and len({n.lower() for n in fields} | {"_corrupt_record"}) > len(fields)


def _is_plain(fields: dict[str, str]) -> Column:
    """Does a JSON scan give this line's values as they are written, with nothing left over? Most lines are so,
    and a scan costs a fraction of what the text of any value costs."""
    if not _scannable(fields):
        return F.lit(False)
    names = F.json_object_keys("value")
    return F.coalesce((F.octet_length("value") < PLAIN_BYTES) & F.col("value").rlike(_plain_pattern(fields))
                      & (F.size(F.array_distinct(names)) == F.size(names)), F.lit(False))


def parse_lines(lines: DataFrame, fields: dict[str, str], stop_on_unseen: bool = False) -> DataFrame:
    """JSON text in ``value`` -> one string (or string array) column per field.

    Values are the text of the line: numbers and nested objects and arrays are
    kept as they are written, as a JSON scan keeps them. What does not fit the
    fields stays as JSON in ``_rescued_data``, in order of name; a line that is
    no JSON object stays there as a whole, and so does one that repeats a name,
    whose columns have the last value, or that nests deeper than ``DEPTH``, whose
    columns are empty. With ``stop_on_unseen`` an unknown field fails the job instead.
    Lines that a plain scan reads alike are read by one, see ``_is_plain``.
    """
    lines.sparkSession.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    others = [c for c in lines.columns if c != "value"]
    # A variant tells what is JSON, and how many fields an object has.
    parsed = (
        lines.filter(F.trim("value") != "")
        .select("*", _is_plain(fields).alias("_plain"))
        .select("*", (F.when(F.col("_plain"), F.from_json("value", _ddl(fields))) if _scannable(fields) else F.lit(None)).alias("_scan"),
                F.when(~F.col("_plain"), F.try_variant_get(F.try_parse_json("value"), "$", "map<string,variant>")).alias("_m"))
        .select("*", *[F.when(F.col("_m").isNotNull(), F.reverse(F.regexp_extract_all("value", F.lit(_FIELD), F.lit(part)))).alias(name)
                       for part, name in ((1, "_quoted"), (2, "_written"))])
        .select("*", F.transform("_quoted", _unquoted).alias("_names"))
    )
    if stop_on_unseen:
        unseen = F.array_distinct(F.filter("_names", lambda k: ~k.isin(*fields)))
        fine = F.col("_m").isNull() | (F.size(unseen) == 0)
        stop = F.raise_error(F.concat(F.lit(UNSEEN), F.array_join(F.sort_array(unseen), ", "))).cast("boolean")
        parsed = parsed.filter(F.when(fine, True).otherwise(stop))
    parsed = parsed.select("*", _misfits(fields).alias("_rest"))
    whole = F.col("_m").isNull() | (F.size("_names") != F.size("_m")) | (F.size(F.json_object_keys("value")) != F.size("_m"))
    rest = F.sort_array(F.transform("_rest", lambda i: F.struct(
        F.get("_names", i.cast("int")).alias("name"), F.get("_quoted", i.cast("int")).alias("key"), F.get("_written", i.cast("int")).alias("value"))))
    rest = F.array_join(F.transform(rest, lambda e: F.concat(e["key"], F.lit(":"), e["value"])), ",")
    rescued = F.when(F.col("_plain"), None).when(whole, F.col("value")).when(F.size("_rest") > 0, F.concat(F.lit("{"), rest, F.lit("}")))
    columns = {n: _column(n, k) for n, k in fields.items()}
    if _scannable(fields):
        columns = {n: F.when(F.col("_plain"), F.col("_scan").getField(n)).otherwise(c) for n, c in columns.items()}
    return parsed.select(*[c.alias(n) for n, c in columns.items()], rescued.alias("_rescued_data"), *others)


def read_landing(spark: SparkSession, path: str, fields: dict[str, str] | None = None,
                 glob: str = "*.ndjson") -> DataFrame:
    """Batch read of landed files in bronze form."""
    lines = spark.read.options(**text_options(glob)).text(path)
    return parse_lines(with_provenance(lines), fields or BRONZE_FIELDS)


def read_json_strings(spark: SparkSession, path: str, fields: dict[str, str] | None = None) -> DataFrame:
    """Plain JSON scan of the given fields: every primitive a string as it is written, arrays kept."""
    return spark.read.schema(_ddl(fields or BRONZE_FIELDS)).json(path)


# --- schema history -----------------------------------------------------------------

def recorded_fields(spark: SparkSession, schema_dir: str) -> dict[str, str] | None:
    """Newest recorded schema, or None before the first run."""
    if not files.exists(spark, schema_dir):
        return None
    newest = spark.read.text(schema_dir).orderBy(F.desc("version")).first()
    return json.loads(newest["value"])


def record_fields(spark: SparkSession, schema_dir: str, fields: dict[str, str]) -> None:
    """Append a schema version; earlier versions stay as history."""
    version = 0
    if files.exists(spark, schema_dir):
        version = spark.read.text(schema_dir).agg(F.max("version")).first()[0] + 1
    row = spark.createDataFrame([(json.dumps(fields),)], "value string")
    row.coalesce(1).write.text(f"{schema_dir}/version={version}")


def pending_files(spark: SparkSession, path: str, glob: str, bronze_dir: str) -> list[str]:
    """Landed files of which the bronze table has no row, whatever their age: names are listed, no landed file is read."""
    landed = (spark.read.format("binaryFile").options(pathGlobFilter=glob, recursiveFileLookup="true").load(path)
              .select("path", F.col("_metadata.file_path").alias("name")))
    if files.exists(spark, f"{bronze_dir}/_spark_metadata"):
        loaded = spark.read.parquet(bronze_dir).select(F.col("_source_file").alias("name")).distinct()
        landed = landed.join(loaded, "name", "left_anti")
    return sorted(r["path"] for r in landed.select("path").collect())


def unseen_fields(spark: SparkSession, paths: list[str], known: dict[str, str]) -> list[str]:
    """Field names in these files that ``known`` lacks. Names come to the driver, not
    rows; more than ``MOST_FIELDS`` of them are an error."""
    found: set[str] = set()
    for begin in range(0, len(paths), FILES_AT_ONCE):
        lines = spark.read.option("lineSep", "\n").text(paths[begin : begin + FILES_AT_ONCE])
        names = lines.select(F.explode(F.json_object_keys("value")).alias("name")).distinct()
        found.update(r["name"] for r in names.filter(~F.col("name").isin(*known)).limit(MOST_FIELDS + 1).collect())
        if len(found) > MOST_FIELDS:
            raise ValueError(f"over {MOST_FIELDS} new field names: these are no fields of a record")
    return sorted(found)


# --- landing ------------------------------------------------------------------------

def land(records: DataFrame, landing: str, batch: str, boards: list[str]) -> list[str]:
    """Write records of ``boards`` as JSON lines under new names; boards that
    already landed in this batch are skipped. Returns the boards written.

    A marker written after the job tells a landed feed from one whose job
    died: what such a job left is removed and written anew.
    """
    spark = records.sparkSession
    target = f"{landing}/batch={batch}"
    todo = [b for b in boards if not files.exists(spark, f"{target}/_landed/{b}")]
    for board in todo:
        files.remove(spark, f"{target}/feed={board}")
    if todo:
        (records.filter(F.col("board").isin(*todo))
         .select(F.to_json(F.struct("*")).alias("value"), F.col("board").alias("feed"))
         .write.mode("append").partitionBy("feed").text(target))
    for board in todo:
        files.touch(spark, f"{target}/_landed/{board}")
    return todo


def reset_bronze(spark: SparkSession, bronze_dir: str, checkpoint: str, schema_dir: str,
                 confirm: bool = False) -> bool:
    """Remove table, checkpoint and schema history together, or nothing: a
    checkpoint without its table would skip every file it has seen."""
    if not confirm:
        return False
    for path in (bronze_dir, checkpoint, schema_dir):
        files.remove(spark, path)
    return True
