"""Files of JSON lines into a table whose schema follows what comes.

Lines travel as text until their batch is handled, so no delivery can break the stream. The columns of the table are what the
deliveries so far have had; a value that does not fit its column is null there and kept in ``rescued``.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyweave.sources.sinks import delete
from skyweave.streaming.run import each_batch
from skyweave.streaming.tables import stored_table

RESCUED = "rescued"
_BATCH = "ingest_batch"

# The column type of what a JSON value looks like; everything else, nested values included, is kept as text.
_WHOLE, _NUMBER, _TRUTH, _TEXT = "bigint", "double", "boolean", "string"


def _column_type(kinds: set[str]) -> str:
    """The type that holds all of these kinds of values."""
    plain = {_WHOLE if k == "BIGINT" else _NUMBER if k.startswith(("DECIMAL", "DOUBLE", "FLOAT")) else _TRUTH if k == "BOOLEAN" else _TEXT for k in kinds}
    if plain == {_WHOLE, _NUMBER}:
        return _NUMBER
    return plain.pop() if len(plain) == 1 else _TEXT


def line_fields(lines: DataFrame) -> DataFrame:
    """``key``, ``kind``: the fields of the JSON objects in ``value`` and what their values look like, nulls left out."""
    lines.select(F.expr("try_parse_json(value)").alias("line")).createOrReplaceTempView("__lines")
    fields = lines.sparkSession.sql(
        """SELECT DISTINCT f.key, schema_of_variant(f.value) AS kind FROM __lines, LATERAL variant_explode(line) AS f
        WHERE schema_of_variant(line) LIKE 'OBJECT%' AND f.key IS NOT NULL"""
    )
    return fields.where("kind <> 'VOID'")


def widened(known: dict[str, str], fields: list) -> dict[str, str]:
    """The columns with those that are new; a column keeps the type it has. Names that differ only in case are one column, the first;
    a name with both kinds of quotes is none."""
    found: dict[str, set[str]] = {}
    for row in fields:
        found.setdefault(row.key, set()).add(row.kind)
    columns = dict(known)
    taken = {c.lower() for c in [*known, RESCUED, _BATCH]}
    for name, kinds in sorted(found.items()):
        if name.lower() not in taken and _has_path(name):
            columns[name] = _column_type(kinds)
            taken.add(name.lower())
    return columns


def _path(name: str) -> str:
    return f"$['{name}']" if "'" not in name else f'$["{name}"]'


def _has_path(name: str) -> bool:
    return "'" not in name or '"' not in name


def _as_text(name: str) -> Column:
    if _has_path(name):
        return F.try_variant_get("line", _path(name), "string")
    return F.from_json("value", "map<string,string>").getItem(name)


def _fit(name: str, kind: str) -> Column:
    """A field as its column's type. Text stays text: a number does not become one, nor the other way round."""
    value = F.try_variant_get("line", _path(name), "variant")
    shape = F.schema_of_variant(value)
    typed = F.try_variant_get("line", _path(name), kind)
    if kind == _WHOLE:
        return F.when(shape == "BIGINT", typed)
    if kind == _NUMBER:
        return F.when((shape == "BIGINT") | shape.rlike("^(DECIMAL|DOUBLE|FLOAT)"), typed)
    if kind == _TRUTH:
        return F.when(shape == "BOOLEAN", typed)
    return typed


def shaped(lines: DataFrame, columns: dict[str, str], strays: list[str] = ()) -> DataFrame:
    """The lines as rows of the columns. ``rescued`` has, as a JSON object, the fields whose values do not fit, those of ``strays``,
    fields without a column, and under ``_line`` a line that is no object; null if there is nothing to rescue."""
    parsed = lines.select("value", F.expr("try_parse_json(value)").alias("line"))
    is_object = F.coalesce(F.schema_of_variant("line").startswith("OBJECT"), F.lit(False))
    fits = {name: _fit(name, kind) for name, kind in columns.items()}
    lost = []
    for name, kind in columns.items():
        raw = _as_text(name)
        if kind != _TEXT:
            lost.append(F.when(raw.isNotNull() & fits[name].isNull(), F.struct(F.lit(name).alias("key"), raw.alias("value"))))
    for name in strays:
        raw = _as_text(name)
        lost.append(F.when(raw.isNotNull(), F.struct(F.lit(name).alias("key"), raw.alias("value"))))
    spoilt = F.when(~is_object & (F.trim("value") != ""), F.struct(F.lit("_line").alias("key"), F.col("value").alias("value")))
    entries = F.array_compact(F.array(*lost, spoilt))
    rescued = F.when(F.size(entries) > 0, F.to_json(F.map_from_entries(entries)))
    return parsed.where(F.trim("value") != "").select(*[c.alias(n) for n, c in fits.items()], rescued.alias(RESCUED))


class EvolvingTable:
    """A table in a folder with its schema versions and its checkpoint."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def versions(self) -> DataFrame:
        """``columns`` as a JSON object, from the batch ``ingest_batch`` on."""
        like = T.StructType([T.StructField("columns", T.StringType()), T.StructField(_BATCH, T.LongType())])
        return stored_table(self.spark, f"{self.root}/versions", like)

    def columns(self, before: int | None = None) -> dict[str, str]:
        """The columns as of the newest version, or of the newest before a batch."""
        known = self.versions() if before is None else self.versions().where(F.col(_BATCH) < before)
        row = known.orderBy(F.desc(_BATCH)).limit(1).collect()
        return json.loads(row[0]["columns"]) if row else {}

    def _take(self, batch: DataFrame, batch_id: int) -> None:
        # A batch that runs again starts from the schema it started from before, and replaces what it wrote.
        known = self.columns(before=batch_id)
        fields = line_fields(batch).collect()
        columns = widened(known, fields)
        strays = sorted({r.key for r in fields} - set(columns))
        version = f"{self.root}/versions/{_BATCH}={batch_id}"
        if columns != known:
            session = batch.sparkSession
            session.createDataFrame([(json.dumps(columns),)], "columns string").coalesce(1).write.mode("overwrite").parquet(version)
        else:
            delete(batch.sparkSession, version)
        shaped(batch, columns, strays).write.mode("overwrite").parquet(f"{self.root}/table/{_BATCH}={batch_id}")

    def ingest(self, landing: str, files_per_batch: int | None = None) -> DataFrame:
        """Take all files of JSON lines that have come to ``landing`` since the last run; the whole table.

        Types are found in all values of the first batch a field is in, on the cluster; the driver gets a row for each field and kind
        of value. Fields that have only been null have no column yet.
        """
        reader = self.spark.readStream.schema("value string")
        if files_per_batch:
            reader = reader.option("maxFilesPerTrigger", files_per_batch)
        each_batch(reader.text(landing), self._take, f"{self.root}/checkpoint")
        return self.read()

    def read(self) -> DataFrame:
        """All rows under the newest schema; rows from before a column are null there."""
        fields = [T.StructField(n, T._parse_datatype_string(k)) for n, k in self.columns().items()]
        schema = T.StructType([*fields, T.StructField(RESCUED, T.StringType()), T.StructField(_BATCH, T.LongType())])
        return stored_table(self.spark, f"{self.root}/table", schema).drop(_BATCH)
